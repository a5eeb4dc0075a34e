"""Registered queries: every operator and job on the shared tables."""

from . import aggregates, dates, geography, jobs_catalog, jobs_orders, jobs_service, jobs_settlement, joins, keys, learning, predicates, reshape, texts, windows  # noqa: F401,E501
from .registry import ORACLES, QUERIES  # noqa: F401
