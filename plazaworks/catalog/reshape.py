"""Pivots, unpivots, lists, distributions."""

from pyspark.sql import functions as F

from ..operators import reshape as R
from .registry import money, num, query, stamp

EVENT_TYPES = ["signup", "view", "click", "purchase", "error"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("SELECT user_id, " + ", ".join(
    f"strftime({'MIN' if e == 'signup' else 'MAX'}(CASE WHEN event_type='{e}' THEN ts END),'%Y-%m-%d %H:%M:%S') AS time_{e}" for e in EVENT_TYPES
) + " FROM events GROUP BY 1")
def event_time_pivot(t):
    """Time per state: the first sign-up, the last of the others."""
    e = t("events", "user_id", "event_type", "ts")
    out = R.status_time(e, ["user_id"], "event_type", "ts", EVENT_TYPES, first_for=["signup"])
    return out.select("user_id", *[stamp(f"time_{x}").alias(f"time_{x}") for x in EVENT_TYPES])


_WIDE = "WITH w AS (SELECT user_id, " + ", ".join(
    f"MAX(CASE WHEN event_type='{e}' AND value>100 THEN ts END) AS time_{e}" for e in EVENT_TYPES
) + " FROM events GROUP BY 1) "


def _wide(t):
    e = t("events", "user_id", "event_type", "ts", "value").where(F.col("value") > 100)
    ids = t("events", "user_id").distinct()
    return ids.join(R.status_time(e, ["user_id"], "event_type", "ts", EVENT_TYPES), "user_id", "left")


@query(_WIDE + " UNION ALL ".join(
    f"SELECT user_id, 'time_{e}' AS status, strftime(time_{e},'%Y-%m-%d %H:%M:%S') AS at FROM w WHERE time_{e} IS NOT NULL" for e in EVENT_TYPES))
def event_unpivot(t):
    out = R.unpivot_times(_wide(t), ["user_id"], [f"time_{e}" for e in EVENT_TYPES], "status", "at")
    return out.withColumn("at", stamp("at"))


@query(_WIDE + " UNION ALL ".join(
    f"SELECT user_id, 'time_{e}' AS status, strftime(time_{e},'%Y-%m-%d %H:%M:%S') AS at FROM w" for e in EVENT_TYPES))
def event_melt(t):
    out = R.melt(_wide(t), ["user_id"], [f"time_{e}" for e in EVENT_TYPES], "status", "at")
    return out.withColumn("at", stamp("at"))


@query("""
SELECT o_custkey, MAX(CASE WHEN o_orderpriority='1-URGENT' THEN o_orderstatus END) AS "1-URGENT",
  MAX(CASE WHEN o_orderpriority='2-HIGH' THEN o_orderstatus END) AS "2-HIGH", MAX(CASE WHEN o_orderpriority='5-LOW' THEN o_orderstatus END) AS "5-LOW"
FROM orders GROUP BY 1
""")
def attribute_pivot(t):
    """Attribute rows (priority, state) to one column per listed attribute."""
    o = t("orders", "o_custkey", "o_orderpriority", "o_orderstatus")
    return R.eav_pivot(o, ["o_custkey"], "o_orderpriority", "o_orderstatus", ["1-URGENT", "2-HIGH", "5-LOW"])


@query("SELECT p_brand, " + ", ".join(
    f"CAST(SUM(CASE WHEN p_type='{x}' THEN CAST(p_retailprice AS DECIMAL(18,2)) END) AS DOUBLE) AS sum_{x}" for x in TYPES
) + " FROM part GROUP BY 1")
def pivot_sum(t):
    p = t("part", "p_brand", "p_type", "p_retailprice")
    total = lambda m: num(F.sum(F.when(m, money("p_retailprice"))))
    return R.pivot_agg(p, ["p_brand"], "p_type", TYPES, total, "sum_")


@query("SELECT p_brand, " + ", ".join(
    f"ROUND(AVG(CASE WHEN p_type='{x}' THEN p_size END),6) AS mean_{x}" for x in TYPES
) + " FROM part GROUP BY 1")
def pivot_mean(t):
    """The default of a cross table is the mean."""
    p = t("part", "p_brand", "p_type", "p_size")
    mean = lambda m: F.round(F.avg(F.when(m, F.col("p_size"))), 6)
    return R.pivot_agg(p, ["p_brand"], "p_type", TYPES, mean, "mean_")


@query("""
SELECT l_orderkey, string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS p_brand, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS p_type
FROM lineitem JOIN part ON l_partkey=p_partkey GROUP BY 1
""")
def single_or_list_brand(t):
    """Brands and types of an order: the one, or the list."""
    rows = t("lineitem", "l_orderkey", "l_partkey").join(t("part", "p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return R.single_or_list(rows, ["l_orderkey"], ["p_brand", "p_type"])


@query("SELECT p_brand, string_agg(DISTINCT p_type, ' | ' ORDER BY p_type) AS types FROM part GROUP BY 1")
def concat_types(t):
    return t("part", "p_brand", "p_type").groupBy("p_brand").agg(R.concat_values("p_type", " | ").alias("types"))


@query("""
WITH d AS (SELECT DISTINCT o_orderstatus, o_custkey%7 AS g, CAST(o_custkey AS VARCHAR) AS v FROM orders JOIN customer ON o_custkey=c_custkey),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderstatus, g ORDER BY v) AS n, COUNT(*) OVER (PARTITION BY o_orderstatus, g) AS values_ FROM d)
SELECT o_orderstatus, g, CAST((n-1)//100 AS INT) AS page, CAST(ceil(values_/100) AS INT) AS pages, values_ AS "values", string_agg(v, '|' ORDER BY v) AS customers FROM n GROUP BY o_orderstatus, g, (n-1)//100, values_
""")
def paged_customers(t):
    """Customers of each state of an order, a hundred to a cell and the rest on further pages."""
    o = t("orders", "o_orderstatus", "o_custkey").join(t("customer", "c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    return R.list_pages(o.withColumn("g", F.col("o_custkey") % 7), ["o_orderstatus", "g"], "o_custkey", 100, name="customers")


@query("SELECT n_regionkey, " + ", ".join(
    f"string_agg(DISTINCT CASE WHEN c_mktsegment='{s}' AND c_acctbal>9000 THEN n_name END, ',' ORDER BY CASE WHEN c_mktsegment='{s}' AND c_acctbal>9000 THEN n_name END) AS \"{s}\""
    for s in SEGMENTS) + " FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1")
def pivot_names(t):
    """Nations with rich customers, per region and segment."""
    c = t("customer", "c_nationkey", "c_mktsegment", "c_acctbal")
    rows = c.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumn("n_name", F.when(F.col("c_acctbal") > 9000, F.col("n_name")))
    return R.pivot_concat(rows, ["n_regionkey"], "c_mktsegment", SEGMENTS, "n_name")


_CLASS = "(p_size-1)//5+1"


@query(f"""
WITH c AS (SELECT p_brand, {_CLASS} AS cls, COUNT(*) AS n FROM part GROUP BY 1,2)
SELECT p_brand, cls, n, ROUND(n/SUM(n) OVER (PARTITION BY p_brand),6) AS share,
  ROUND(SUM(n) OVER (PARTITION BY p_brand ORDER BY cls)/SUM(n) OVER (PARTITION BY p_brand),6) AS cumulative_share FROM c
""")
def distribution_share(t):
    p = t("part", "p_brand", "p_size").withColumn("cls", F.floor((F.col("p_size") - 1) / 5) + 1)
    out = R.class_distribution(p, "p_brand", "cls")
    return out.withColumns({"share": F.round("share", 6), "cumulative_share": F.round("cumulative_share", 6)})


@query(f"""
WITH p AS (SELECT p_partkey, p_brand, {_CLASS} AS cls FROM part),
g AS (SELECT p_brand, k, SUM(CASE WHEN cls<=k THEN 1 ELSE 0 END)/COUNT(*) AS s FROM p, (SELECT unnest(range(2,11)) AS k) GROUP BY 1,2),
i AS (SELECT p_brand, COALESCE(MIN(CASE WHEN s>0.10 THEN k END),2) AS min_class, COALESCE(MAX(CASE WHEN s<0.95 THEN k END),10) AS max_class FROM g GROUP BY 1)
SELECT p_partkey, min_class, max_class, CASE WHEN cls>=min_class AND cls<=max_class THEN 1 ELSE 0 END AS plausible FROM p JOIN i USING (p_brand)
""")
def plausible_size(t):
    """Is the size class usual within its brand."""
    p = t("part", "p_partkey", "p_brand", "p_size").withColumn("cls", (F.floor((F.col("p_size") - 1) / 5) + 1).cast("int"))
    out = R.plausible_interval(p, "p_brand", "cls", 0.10, 0.95, list(range(1, 11)))
    return out.select("p_partkey", "min_class", "max_class", "plausible")
