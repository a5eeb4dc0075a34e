"""Planned pickups, unplanned arrivals and the tickets about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import period_label
from ..operators.joins import attach_one
from ..operators.windows import with_sequence


def flow_of_guide(guide: str) -> Column:
    """Reverse flow ('IL') or collection, by marks in the guide."""
    return F.when(F.col(guide).rlike("DEV|RET"), "IL").otherwise("Recoleccion")


def transport_plan(planned: DataFrame, unplanned: DataFrame, tickets: DataFrame, orders: DataFrame, block: str = "month") -> DataFrame:
    """Plan and unplanned arrivals with the k-th ticket of an order on its k-th row.

    planned: order_id, guide, state, reason, condition, planned_at; unplanned:
    order_id, guide, registered_at; tickets: order_id, case_id, ticket_at,
    closed_at; orders: order_id, seller_id.  Rows are numbered within each of
    the two lists on its own, as the reports do.  ``flow`` says whether a guide
    is a return or a collection.
    """
    p = planned.select("order_id", "guide", "state", "reason", "condition", "planned_at", F.lit("PLANIFICADO").alias("kind"))
    u = unplanned.select(
        "order_id", "guide", F.lit("INGRESO SIN PLANIFICACION").alias("state"), F.lit("NA").alias("reason"), F.lit("NA").alias("condition"),
        F.col("registered_at").alias("planned_at"), F.lit("NO PLANIFICADO").alias("kind"),
    )
    rows = p.unionByName(u)
    numbered = with_sequence(rows, ["kind", "order_id"], ["planned_at", "guide"], "position", F.date_trunc(block, "planned_at"))
    ranked = with_sequence(tickets, ["order_id"], ["ticket_at", "case_id"], "position", F.date_trunc(block, "ticket_at"))
    out = numbered.join(ranked, ["order_id", "position"], "left")
    out = attach_one(out, orders.select("order_id", "seller_id"), ["order_id"])
    return out.withColumns({"flow": flow_of_guide("guide"), "period_planned": period_label("planned_at"), "period_ticket": period_label("ticket_at"), "period_closed": period_label("closed_at")})

