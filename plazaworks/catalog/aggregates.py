"""Measures, allocation, imputation, outliers, gaps."""

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import quality as Q
from .registry import money, num, query

_M = "CAST(l_extendedprice AS DECIMAL(18,2))"
_CHARGES = {
    "charge_return": (("R-F",), ("R-O",)),
    "charge_normal": (("N-F",), ("N-O",)),
    "charge_accept": ((), ("A-O", "A-F")),
}


@query(f"""
SELECT l_suppkey,
  CAST(COALESCE(SUM(CASE WHEN k IN ('R-O') THEN m END),0)-COALESCE(SUM(CASE WHEN k IN ('R-F') THEN m END),0) AS DOUBLE) AS charge_return,
  CAST(COALESCE(SUM(CASE WHEN k IN ('N-O') THEN m END),0)-COALESCE(SUM(CASE WHEN k IN ('N-F') THEN m END),0) AS DOUBLE) AS charge_normal,
  CAST(COALESCE(SUM(CASE WHEN k IN ('A-O','A-F') THEN m END),0) AS DOUBLE) AS charge_accept
FROM (SELECT l_suppkey, l_returnflag||'-'||l_linestatus AS k, {_M} AS m FROM lineitem) GROUP BY 1
""")
def ledger_measures(t):
    """Charges less repayments per transaction type, one pass."""
    l = t("lineitem", "l_suppkey", "l_returnflag", "l_linestatus", "l_extendedprice")
    l = l.withColumns({"k": F.concat_ws("-", "l_returnflag", "l_linestatus"), "m": money("l_extendedprice")})
    out = A.ledger_measures(l, ["l_suppkey"], "k", "m", _CHARGES)
    return out.select("l_suppkey", *[num(c).alias(c) for c in _CHARGES])


@query(f"""
SELECT l_returnflag, COUNT(*) AS lines, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT CASE WHEN l_discount>0.05 THEN l_suppkey END) AS suppliers,
  CAST(SUM({_M}) AS DOUBLE) AS total, MIN(l_quantity) AS min_q, MAX(l_quantity) AS max_q
FROM lineitem GROUP BY 1
""")
def grouped_measures(t):
    """Sum, count, distinct and conditional distinct in one aggregate."""
    l = t("lineitem", "l_returnflag", "l_orderkey", "l_discount", "l_suppkey", "l_extendedprice", "l_quantity")
    return l.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("l_orderkey").alias("orders"),
        F.count_distinct(F.when(F.col("l_discount") > 0.05, F.col("l_suppkey"))).alias("suppliers"),
        num(F.sum(money("l_extendedprice"))).alias("total"), F.min("l_quantity").alias("min_q"), F.max("l_quantity").alias("max_q"),
    )


@query(f"""
SELECT l_suppkey, COUNT(*) AS n, CAST(SUM({_M}) AS DOUBLE) AS total FROM lineitem GROUP BY 1 HAVING COUNT(*)>590 AND SUM({_M})>15000000
""")
def having_totals(t):
    l = t("lineitem", "l_suppkey", "l_extendedprice")
    out = l.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum(money("l_extendedprice")).alias("total"))
    return out.where((F.col("n") > 590) & (F.col("total") > 15000000)).withColumn("total", num("total"))


@query("SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def value_counts(t):
    return A.value_counts(t("events", "event_type"), "event_type")


@query(f"""
SELECT 'lines' AS label, CAST(SUM({_M}) AS DOUBLE) AS total FROM lineitem
UNION ALL SELECT 'returned', CAST(SUM({_M}) AS DOUBLE) FROM lineitem WHERE l_returnflag='R'
UNION ALL SELECT 'orders', CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders
UNION ALL SELECT 'customers', CAST(COUNT(*) AS DOUBLE) FROM customer
""")
def control_totals(t):
    l = t("lineitem", "l_extendedprice", "l_returnflag")
    total = F.sum(money("l_extendedprice"))
    return A.control_totals(
        {
            "lines": (l, total),
            "returned": (l.where(F.col("l_returnflag") == "R"), total),
            "orders": (t("orders", "o_totalprice"), F.sum(money("o_totalprice"))),
            "customers": (t("customer", "c_custkey"), F.count(F.lit(1))),
        }
    )


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate=(SELECT MAX(o_orderdate) FROM orders)")
def latest_period(t):
    return A.at_latest(t("orders", "o_orderkey", "o_custkey", "o_orderdate"), "o_orderdate").select("o_orderkey", "o_custkey")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  o_totalprice/COUNT(*) OVER (PARTITION BY l_orderkey) AS share
FROM lineitem JOIN orders ON l_orderkey=o_orderkey
""")
def allocate_even(t):
    """The order total spread evenly over its lines."""
    l = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = l.join(t("orders", "o_orderkey", "o_totalprice"), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return A.allocate_evenly(rows.withColumnRenamed("o_totalprice", "share"), ["l_orderkey"], ["share"])


@query("""
WITH d AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal<0 THEN NULL ELSE c_acctbal END AS bal,
  CASE WHEN c_custkey%7=0 THEN NULL ELSE c_mktsegment END AS seg FROM customer),
gm AS (SELECT c_nationkey, quantile_cont(bal,0.5) AS m FROM d GROUP BY 1),
gs AS (SELECT c_nationkey, seg AS s FROM (SELECT c_nationkey, seg, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY COUNT(*) DESC, seg) rn FROM d WHERE seg IS NOT NULL GROUP BY 1,2) WHERE rn=1),
ws AS (SELECT seg AS s FROM d WHERE seg IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, seg LIMIT 1)
SELECT c_custkey, ROUND(COALESCE(bal, gm.m, (SELECT quantile_cont(bal,0.5) FROM d)),4) AS bal, COALESCE(seg, gs.s, (SELECT s FROM ws)) AS seg
FROM d LEFT JOIN gm USING (c_nationkey) LEFT JOIN gs USING (c_nationkey)
""")
def impute_balance(t):
    """Missing balances by the nation's median, missing segments by its mode."""
    c = t("customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    d = c.select(
        "c_custkey", "c_nationkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("seg"),
    )
    return A.impute_by_group(d, "c_nationkey", ["bal"], ["seg"]).select("c_custkey", F.round("bal", 4).alias("bal"), "seg")


@query("""
SELECT c_custkey, COUNT(*) OVER (PARTITION BY c_nationkey) AS c_nationkey_enc, COUNT(*) OVER (PARTITION BY c_mktsegment) AS c_mktsegment_enc FROM customer
""")
def frequency_encode(t):
    c = t("customer", "c_custkey", "c_nationkey", "c_mktsegment")
    return A.frequency_encode(c, ["c_nationkey", "c_mktsegment"]).select("c_custkey", "c_nationkey_enc", "c_mktsegment_enc")


@query("""
SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice,0.5) AS median FROM lineitem GROUP BY 1,2
""")
def group_median(t):
    """Exact median of large groups, no group in one task."""
    return A.medians(t("lineitem", "l_returnflag", "l_linestatus", "l_extendedprice"), ["l_returnflag", "l_linestatus"], "l_extendedprice", "median")


@query("""
SELECT p_partkey FROM part JOIN (SELECT p_brand, AVG(p_retailprice) m, stddev_samp(p_retailprice) s FROM part GROUP BY 1) USING (p_brand)
WHERE ABS(p_retailprice-m)/s<=1.5 OR s IS NULL OR s=0
""")
def zscore_filter(t):
    p = t("part", "p_partkey", "p_brand", "p_retailprice")
    return Q.zscore_filter(p, ["p_brand"], ["p_retailprice"], 1.5).select("p_partkey")


@query("""
WITH r AS (SELECT p_brand, p_retailprice, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_retailprice) rn, COUNT(*) OVER (PARTITION BY p_brand) n FROM part),
b AS (SELECT p_brand, MAX(CASE WHEN rn=CAST(floor(n*0.03) AS BIGINT)+1 THEN p_retailprice END) lo, MAX(CASE WHEN rn=n-CAST(floor(n*0.03) AS BIGINT) THEN p_retailprice END) hi FROM r GROUP BY 1)
SELECT p_partkey, least(greatest(p_retailprice,lo),hi) AS p_retailprice FROM part JOIN b USING (p_brand)
""")
def winsorize(t):
    """Prices pulled into the 3 % tails of their brand."""
    p = t("part", "p_partkey", "p_brand", "p_retailprice")
    return Q.winsorize(p, ["p_brand"], ["p_retailprice"], 0.03).select("p_partkey", "p_retailprice")


@query("""
WITH k AS (SELECT DISTINCT l_returnflag, l_linestatus, l_orderkey FROM lineitem),
g AS (SELECT *, LEAD(l_orderkey) OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_orderkey) AS nx FROM k)
SELECT l_returnflag, l_linestatus, unnest(range(l_orderkey+1, nx)) AS l_orderkey FROM g WHERE nx-l_orderkey>1
""")
def sequence_gaps(t):
    """Order numbers missing between the first and the last of each of six long series."""
    l = t("lineitem", "l_returnflag", "l_linestatus", "l_orderkey")
    return Q.sequence_gaps(l, ["l_returnflag", "l_linestatus"], "l_orderkey", width=2000, chunk=3)


@query("""
WITH k AS (SELECT DISTINCT l_orderkey FROM lineitem), g AS (SELECT l_orderkey, LEAD(l_orderkey) OVER (ORDER BY l_orderkey) AS nx FROM k)
SELECT unnest(range(l_orderkey+1, nx)) AS l_orderkey FROM g WHERE nx-l_orderkey>1
""")
def sequence_gaps_global(t):
    """One long series: order keys without any line."""
    return Q.sequence_gaps(t("lineitem", "l_orderkey"), [], "l_orderkey", width=5000)


@query("""
SELECT c_custkey, c_name, c_acctbal FROM (SELECT c_custkey, c_name, CASE WHEN c_acctbal<0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer) WHERE c_acctbal IS NOT NULL
""")
def drop_incomplete(t):
    c = t("customer", "c_custkey", "c_name", "c_acctbal").withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return Q.drop_incomplete(c)
