"""Rows per key: latest, n-th, first k, priorities."""

from pyspark.sql import functions as F

from ..operators import keys as K
from ..plans.appeals import drop_superseded, mark_repeats
from .registry import day, money, num, query


@query("""
WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders)
SELECT o_custkey,
  MAX(CASE WHEN rn=1 THEN o_orderkey END) AS last_order, MAX(CASE WHEN rn=1 THEN o_orderstatus END) AS last_status,
  strftime(MAX(CASE WHEN rn=1 THEN o_orderdate END),'%Y-%m-%d') AS last_date,
  MAX(CASE WHEN rn=2 THEN o_orderkey END) AS prev_order, MAX(CASE WHEN rn=2 THEN o_orderstatus END) AS prev_status,
  strftime(MAX(CASE WHEN rn=2 THEN o_orderdate END),'%Y-%m-%d') AS prev_date
FROM r WHERE rn<=2 GROUP BY 1
""")
def order_latest_status(t):
    """Latest and previous order of every customer."""
    o = t("orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    wide = K.first_k_wide(
        o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], ["o_orderkey", "o_orderstatus", "o_orderdate"], 2
    )
    return wide.select(
        "o_custkey",
        F.col("o_orderkey_1").alias("last_order"), F.col("o_orderstatus_1").alias("last_status"), day("o_orderdate_1").alias("last_date"),
        F.col("o_orderkey_2").alias("prev_order"), F.col("o_orderstatus_2").alias("prev_status"), day("o_orderdate_2").alias("prev_date"),
    )


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) rn FROM orders) WHERE rn=1
""")
def first_order(t):
    o = t("orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return K.latest_per_key(o, ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")]).drop("o_orderdate")


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) rn FROM orders) WHERE rn=2 AND o_orderstatus<>'P'
""")
def nth_order(t):
    """Second order of a customer, as a stand-in for the ingress state, unless it is pending."""
    o = t("orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    second = K.nth_per_key(o, ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")], 2)
    return second.where(F.col("o_orderstatus") != "P").drop("o_orderdate")


@query("""
SELECT o_custkey, MAX(CASE WHEN a=1 THEN o_orderkey END) AS first_o_orderkey, MAX(CASE WHEN a=1 THEN o_orderstatus END) AS first_o_orderstatus,
  MAX(CASE WHEN d=1 THEN o_orderkey END) AS last_o_orderkey, MAX(CASE WHEN d=1 THEN o_orderstatus END) AS last_o_orderstatus
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) a,
  ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) d FROM orders) GROUP BY 1
""")
def first_last_order(t):
    o = t("orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return K.first_last_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus"])


@query("""
SELECT o_custkey, MAX(CASE WHEN rn=1 THEN o_orderkey END) AS order_1, MAX(CASE WHEN rn=2 THEN o_orderkey END) AS order_2,
  MAX(CASE WHEN rn=3 THEN o_orderkey END) AS order_3
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) rn FROM orders) WHERE rn<=3 GROUP BY 1
""")
def first_three_orders(t):
    o = t("orders", "o_custkey", "o_orderkey", "o_orderdate")
    return K.first_k_wide(o, ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")], ["o_orderkey"], 3, "order_{i}")


@query("""
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) rn FROM events) WHERE rn=1
""")
def dedup_keep_last(t):
    e = t("events", "user_id", "event_type", "event_id", "value", "ts")
    return K.drop_duplicates_ordered(e, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("""
WITH s AS (SELECT 1 AS priority, o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus='F'
  UNION ALL SELECT 2, o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus='O'
  UNION ALL SELECT 3, o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus='P')
SELECT priority, o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY priority, o_totalprice DESC, o_orderkey) rn FROM s) WHERE rn=1
""")
def priority_order(t):
    """One order per customer, closed orders trusted before open before pending ones."""
    o = t("orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    sources = [o.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in ("F", "O", "P")]
    return K.priority_dedup(sources, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("""
SELECT event_id, user_id, CASE WHEN rn=1 THEN value ELSE 0 END AS value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) rn FROM events)
""")
def amount_on_first_row(t):
    """A day's value stays on the first event of the user's day."""
    e = t("events", "event_id", "user_id", "value", "ts").withColumn("d", F.to_date("ts"))
    out = K.amount_on_first_row(e, ["user_id", "d"], [F.asc("ts"), F.asc("event_id")], ["event_id"], ["value"])
    return out.select("event_id", "user_id", "value")


@query("""
SELECT c_nationkey, c_mktsegment, n FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) rn
  FROM (SELECT c_nationkey, c_mktsegment, COUNT(DISTINCT c_custkey) n FROM customer GROUP BY 1,2)) WHERE rn=1
""")
def dominant_segment(t):
    return K.dominant_label(t("customer", "c_nationkey", "c_mktsegment", "c_custkey"), "c_nationkey", "c_mktsegment", "c_custkey")


@query("""
SELECT p_brand, p_partkey, p_retailprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) rn FROM part) WHERE rn=1
""")
def argmax_price(t):
    p = t("part", "p_brand", "p_partkey", "p_retailprice")
    return K.latest_per_key(p, ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")])


@query("SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 20")
def top_customers(t):
    return K.top_groups(t("orders", "o_custkey"), ["o_custkey"], 20)


@query("SELECT c_nationkey, c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1,2")
def ranked_groups(t):
    return K.rank_groups(t("customer", "c_nationkey", "c_mktsegment"), ["c_nationkey", "c_mktsegment"])


@query("""
WITH n AS (SELECT o_orderkey, o_custkey, o_orderpriority, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS n_appeal FROM orders)
SELECT o_orderkey, n_appeal, MAX(n_appeal) OVER (PARTITION BY o_custkey, o_orderpriority) AS max_appeal,
  CASE WHEN MAX(n_appeal) OVER (PARTITION BY o_custkey, o_orderpriority)>1 THEN 'Si' ELSE 'No' END AS re_appeal FROM n
""")
def repeat_flag(t):
    o = t("orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    out = mark_repeats(o, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"], F.date_trunc("year", "o_orderdate"))
    return out.select("o_orderkey", "n_appeal", "max_appeal", "re_appeal")


@query("""
WITH g AS (SELECT o_custkey, COUNT(DISTINCT o_orderstatus) n, MAX(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END) ok FROM orders GROUP BY 1)
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus<>'F' AND n>1 AND ok=1 THEN NULL ELSE o_totalprice END AS o_totalprice
FROM orders JOIN g USING (o_custkey)
""")
def sibling_override(t):
    o = t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return drop_superseded(o, "o_custkey", "o_orderstatus", ["o_totalprice"], "F").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("""
SELECT l_orderkey, l_linenumber, CAST(MAX(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price, MAX(l_returnflag) AS flag
FROM lineitem GROUP BY 1,2
""")
def collapse_duplicates(t):
    """Duplicate lines collapsed to one row by their largest values."""
    l = t("lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    return l.groupBy("l_orderkey", "l_linenumber").agg(num(F.max(money("l_extendedprice"))).alias("price"), F.max("l_returnflag").alias("flag"))
