"""Running columns over whole histories, cut into blocks."""

from pyspark.sql import functions as F

from ..operators import windows as W
from ..operators.joins import attach_group
from .registry import money, num, query


@query("""
SELECT o_orderkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS DOUBLE) AS running FROM orders
""")
def running_value(t):
    """Running order value per customer; orders of one day share it."""
    o = t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").withColumn("v", money("o_totalprice"))
    out = W.running_sum(o, ["o_custkey"], ["o_orderdate"], "v", "running", F.date_trunc("quarter", "o_orderdate"), range_frame=True)
    return out.select("o_orderkey", num("running").alias("running"))


@query("""
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) - LAG(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DOUBLE) AS diff
FROM orders
""")
def diff_prev_order(t):
    o = t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").withColumn("v", money("o_totalprice"))
    out = W.diff_prev(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "v", "diff", F.date_trunc("year", "o_orderdate"))
    return out.select("o_orderkey", num("diff").alias("diff"))


@query("""
SELECT event_id, event_type, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type,
  strftime(LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id),'%Y-%m-%d %H:%M:%S') AS prev_ts FROM events
""")
def previous_state(t):
    """State and time of the event before, per user."""
    e = t("events", "event_id", "event_type", "user_id", "ts")
    out = W.with_previous(e, ["user_id"], ["ts", "event_id"], {"prev_type": "event_type", "prev": "ts"}, F.date_trunc("day", "ts"))
    return out.select("event_id", "event_type", "prev_type", F.date_format("prev", "yyyy-MM-dd HH:mm:ss").alias("prev_ts"))


@query("""
SELECT o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders
""")
def order_sequence(t):
    o = t("orders", "o_orderkey", "o_custkey", "o_orderdate")
    return W.with_sequence(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "n", F.date_trunc("year", "o_orderdate")).select("o_orderkey", "n")


@query("SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_custkey, o_orderkey) AS row_id FROM orders")
def global_row_id(t):
    """Ids over the whole sorted table; only per-day counts meet in one task."""
    o = t("orders", "o_orderkey", "o_custkey", "o_orderdate")
    return W.with_row_id(o, ["o_orderdate", "o_custkey", "o_orderkey"], F.to_date("o_orderdate")).select("o_orderkey", "row_id")


@query("""
SELECT event_id, CASE WHEN event_type='purchase' THEN ROW_NUMBER() OVER (PARTITION BY user_id, event_type='purchase' ORDER BY ts, event_id)
  ELSE ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) END AS n FROM events
""")
def conditional_sequence(t):
    """Purchases numbered among themselves, other events in the whole history."""
    e = t("events", "event_id", "event_type", "user_id", "ts")
    out = W.conditional_sequence(e, "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", "n", F.date_trunc("day", "ts"))
    return out.select("event_id", "n")


@query("""
SELECT o_orderkey, n FROM (SELECT o_orderkey, COUNT(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n>2
""")
def group_size_filter(t):
    o = t("orders", "o_orderkey", "o_custkey")
    return attach_group(o, ["o_custkey"], F.count(F.lit(1)).alias("n")).where(F.col("n") > 2).select("o_orderkey", "n")


@query("""
SELECT o_orderkey, CASE WHEN ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)=1 THEN 1 ELSE 0 END AS is_first,
  CASE WHEN ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)=1 THEN 1 ELSE 0 END AS is_last FROM orders
""")
def first_last_marks(t):
    """First and last order of each customer marked on all orders."""
    o = t("orders", "o_orderkey", "o_custkey", "o_orderdate")
    out = W.first_last_flags(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.date_trunc("year", "o_orderdate"))
    return out.select("o_orderkey", F.col("is_first").cast("int").alias("is_first"), F.col("is_last").cast("int").alias("is_last"))
