"""Returned goods from several feeds in one vocabulary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.dates import days_between
from ..functions.sem import initcap_delims, regexp_extract_n, safe_cast
from ..operators.joins import attach, join_if_unique
from ..operators.reshape import concat_values, single_or_list
from ..operators.rules import case_first, label_rank, vocabulary
from ..operators.setops import union_sources


def reference_kind(reference: str) -> Column:
    """What kind of number a carrier reference is."""
    r = F.col(reference)
    return case_first(
        [
            (r.rlike("^2") & (F.length(r) == 10), "ORDER"),
            (r.rlike("^RLO"), "RLO"),
            (F.length(r) > 12, "Rastreo"),
        ],
        "Otro",
    )


def parse_carrier_feed(feed: DataFrame) -> DataFrame:
    """Order, sku and guide number from a carrier's reference and content texts.

    feed: reference, content, pieces, guide, state, requested_at.
    """
    return feed.select(
        F.regexp_replace(regexp_extract_n("reference", r"^([^-]*)"), " PROD", "").alias("order_id"),
        regexp_extract_n("content", r"^(\d+)").alias("sku"),
        safe_cast(F.coalesce(F.col("pieces"), F.lit("1")), "bigint").alias("items"),
        F.coalesce(safe_cast(regexp_extract_n("reference", r"-([^.]*)$"), "bigint"), F.lit(1)).alias("n_guide"),
        "guide", "state", "requested_at",
    ).withColumns(
        {"kind": reference_kind("order_id"), "sku": F.when(F.col("sku").rlike("^1") & (F.length("sku") == 9), F.col("sku"))}
    )


def fill_sku(feed: DataFrame, order_skus: DataFrame) -> DataFrame:
    """Missing sku of order references, taken from orders that hold a single sku."""
    side = order_skus.select("order_id", F.col("sku").alias("_sku"))
    out = join_if_unique(feed, side, ["order_id"], "_sku")
    return out.withColumn("sku", F.when(F.col("kind") == "ORDER", F.coalesce("sku", "_sku")).otherwise(F.col("sku"))).drop("_sku")


def carrier_name(carrier: str, guide: str) -> Column:
    """Carrier by name or by the prefix of its guide."""
    low, up = F.lower(F.col(carrier)), F.upper(F.col(guide))
    return case_first(
        [
            (low.rlike("99"), "99Minutos"),
            (low.rlike("andes"), "Andes Express"),
            (low.rlike("tms|own"), "Own Fleet"),
            (up.rlike("REC|RET|DEV"), "Own Fleet"),
            (low.rlike("urbano"), "Urbano"),
            (up.rlike("WYB"), "Urbano"),
            (low == "-", "Own Fleet"),
        ],
        initcap_delims(carrier),
    )


def return_days_band(days) -> Column:
    return F.when(days <= 30, "00-30").when(days > 30, "30+")


def consolidate_returns(feeds: Mapping[str, DataFrame], prior_balance: DataFrame, groups=vocab.RETURN_STATES) -> DataFrame:
    """All feeds with one state vocabulary, carrier, days and rank.

    feeds: order_id, sku, guide, carrier, state, requested_at, collected_at,
    delivered_at (missing columns become NULL); prior_balance: order_id, sku,
    fecha_egreso.
    """
    rows = union_sources(feeds, "feed")
    out = attach(rows, prior_balance.select("order_id", "sku", "fecha_egreso"), ["order_id", "sku"])
    days = days_between("delivered_at", "fecha_egreso")
    out = out.withColumns({"carrier": carrier_name("carrier", "guide"), "state_group": vocabulary("state", groups), "return_days": days})
    return out.withColumns(
        {
            "return_days_band": return_days_band(F.col("return_days")),
            "state_rank": label_rank("state_group", vocab.RETURN_STATE_RANK, vocab.RETURN_STATE_RANK_OTHER),
        }
    )


def returns_per_line(rows: DataFrame) -> DataFrame:
    """One row per (order, sku): values, or their lists where they differ."""
    keys = ["order_id", "sku"]
    counts = [
        F.count_distinct("guide").alias("n_guides"),
        concat_values("guide").alias("guides"),
        F.max("requested_at").alias("requested_at"),
        F.max("delivered_at").alias("delivered_at"),
        F.min("state_rank").alias("state_rank"),
    ]
    return single_or_list(rows, keys, ["state_group", "carrier"], more=counts)
