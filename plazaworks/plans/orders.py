"""Order timelines, tracking feeds, KPI flags, first sales."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.dates import as_date, days_between
from ..operators.joins import attach, attach_one
from ..operators.keys import latest_per_key, top_per_key
from ..operators.reshape import status_time
from ..operators.rules import case_first


def status_timeline(
    history: DataFrame, key: str, status: str, ts: str, tie: str, statuses: Sequence[str], first_for: Sequence[str] = vocab.FIRST_TIME_STATUSES
) -> DataFrame:
    """Latest state, the state before it, and one time per status for each key.

    The two newest rows come from a group limit, the times from one aggregate;
    the history itself is never sorted per key.
    """
    newest = top_per_key(history.select(key, status, ts, tie), [key], [F.desc(ts), F.desc(tie)], 2, "_r")
    state = newest.groupBy(key).agg(
        F.max(F.when(F.col("_r") == 1, F.col(status))).alias("status"),
        F.max(F.when(F.col("_r") == 1, F.col(ts))).alias("status_time"),
        F.max(F.when(F.col("_r") == 2, F.col(status))).alias("prev_status"),
        F.max(F.when(F.col("_r") == 2, F.col(ts))).alias("prev_status_time"),
    )
    times = status_time(history, [key], status, ts, statuses, first_for=first_for)
    return state.join(times, key)


def milestones(df: DataFrame, table: Mapping[str, Sequence[str]] = vocab.MILESTONES) -> DataFrame:
    """First known time of each milestone; sources the table lacks are skipped."""
    have = set(df.columns)
    new = {}
    for name, sources in table.items():
        known = [F.col(s) for s in sources if s in have]
        if known:
            new[name] = F.coalesce(*known)
    return df.withColumns(new)


def order_timeline(items: DataFrame, history: DataFrame, statuses: DataFrame, values: Sequence[str] = vocab.ORDER_STATUSES) -> DataFrame:
    """One row per order with its states and milestones.

    items: order_id, item_id, shipping_type, created_at, target_to_ship;
    history: item_id, status_id, ts; statuses: status_id, status.
    """
    named = history.join(statuses, "status_id").join(items.select("order_id", "item_id"), "item_id")
    line = status_timeline(named, "order_id", "status", "ts", "item_id", values)
    head = items.groupBy("order_id").agg(
        F.max("shipping_type").alias("shipping_type"), F.max("created_at").alias("created_at"), F.max("target_to_ship").alias("target_to_ship")
    )
    return milestones(attach(head, line, ["order_id"]))


def merge_tracking(feeds: Sequence[DataFrame], key: str = "tracking", ts: str = "ts", tie: str = "state", overrides: DataFrame | None = None) -> DataFrame:
    """Newest state per tracking code over several carriers; overrides replace it."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
    newest = latest_per_key(merged.where(F.col(key).isNotNull()), [key], [F.desc(ts), F.desc(tie)])
    if overrides is None:
        return newest
    side = overrides.select(key, F.col(tie).alias("_state"))
    return attach_one(newest, side, [key]).withColumn(tie, F.coalesce("_state", tie)).drop("_state")


# Order states by meaning.
CANCELED = ("canceled", "failed", "failed_delivery")
IN_PROGRESS = ("CREATED", "CONFIRMED", "IN_TRANSIT", "AVAILABLE_FOR_PICKUP", "OUT_FOR_DELIVERY", "DELIVERY_ATTEMPTED",
               "DELIVERED_WITH_EXCEPTION", "EXCEPTION")
RETURNED = ("returned", "return_shipped_by_customer", "return_waiting_for_approval")


def order_kpis(timeline: DataFrame, as_of: str, compat_delay: bool = False) -> DataFrame:
    """0/1 flags of an order, and its one-word status.

    timeline: shipping_type, carrier, tracking_code, printed, created_at,
    target_to_ship, planned_at, ready_to_ship, shipped_at, visits, rlo_id,
    status_order, status_tms, status_platform, status_store, tms_time.

    An order is late when it ships, or is ready, at or after its target; only
    own-stock sellers are judged.  ``compat_delay`` also marks other shipping
    types that were ready late.
    """
    c, today = F.col, as_date(as_of)
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    own = c("shipping_type") == "FBS"
    canceled = c("status_order").isin(*CANCELED)
    ready_late = c("ready_to_ship") >= c("target_to_ship")
    late = (own & (c("shipped_at") >= c("target_to_ship"))) | (ready_late if compat_delay else own & ready_late)
    settled = ~c("status_order").isin("delivered", *CANCELED, *RETURNED)
    lost = (
        c("status_tms").isin("Siniestro", "Envio Siniestrado")
        | ((c("status_tms") == "Entregado") & (c("status_platform").isin("CANCELLED", "UNDELIVERED") | canceled))
        | ((c("status_store") == "DELIVERED") & (c("status_platform").isin("CANCELLED", "UNDELIVERED") | canceled))
        | (canceled & (c("status_platform") == "DELIVERED"))
    )
    return timeline.withColumns(
        {
            "printed": case_first(
                [(~own, 1), (own & (c("carrier") == "courier internacional"), 1), (own & (F.length("tracking_code") > 10), 1)], c("printed")
            ),
            "readied": F.when(own & c("ready_to_ship").isNull(), 0).otherwise(1),
            "planned": flag(c("planned_at").isNotNull()),
            "not_collected": flag(c("visits") > 1),
            "error_dts": flag((c("shipping_type") != "FBF") & (days_between("target_to_ship", "created_at") < 1)),
            "not_moving": flag((F.datediff(today, "tms_time") >= 2) & settled & (F.datediff(today, "target_to_ship") >= 1)),
            "shipped": flag(c("shipped_at").isNotNull()),
            "advanced": case_first(
                [(own & (c("shipped_at") >= c("target_to_ship") - F.expr("INTERVAL 7 DAYS")), 0), (c("shipped_at").isNull(), 0)], 1
            ),
            "delayed": flag(late),
            "canceled": flag(canceled),
            "rejected": flag(c("status_tms") == "Retorno A Seller"),
            "failed_delivery": flag(
                c("status_order").isin("failed", "failed_delivery")
                | c("status_tms").isin("Fallo De Entrega", "Fallo De Entrega Ct", "Devolucion Al Shipper")
            ),
            "returned": flag((c("status_order").isin(*CANCELED, *RETURNED) & c("shipped_at").isNotNull()) | c("rlo_id").isNotNull()),
            "has_rlo": flag(c("rlo_id").isNotNull()),
            "lost": flag(lost),
            "days_to_ship": days_between("target_to_ship", "created_at"),
            "status": case_first(
                [
                    (c("status_platform") == "DELIVERED", "delivered"),
                    (c("status_platform").isin("CANCELLED", "UNDELIVERED"), "canceled"),
                    (c("status_platform").isNull() | c("status_platform").isin(*IN_PROGRESS), "in_progress"),
                    (c("status_order").isin(*RETURNED, "return_rejected"), "returned"),
                ]
            ),
        }
    )


FIRST_SALE_IGNORED = ("canceled", "return_shipped_by_customer", "failed_delivery", "return_waiting_for_approval", "return_rejected", "returned")


def first_sale(orders: DataFrame, window, seller: str, sold_at: str, status: str, tie: str, ignored: Sequence[str] = FIRST_SALE_IGNORED) -> DataFrame:
    """First sale of each seller that was not undone, if it falls in the window."""
    kept = orders.where(~F.col(status).isin(list(ignored)))
    first = latest_per_key(kept, [seller], [F.asc(sold_at), F.asc(tie)])
    start, end = window
    return first.where((F.col(sold_at) >= F.lit(start).cast("timestamp_ntz")) & (F.col(sold_at) < F.lit(end).cast("timestamp_ntz")))
