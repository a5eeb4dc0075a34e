"""Joins, differences, unions."""

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import setops as S
from ..operators.entities import duplicates_wide, shared_groups
from ..operators.rules import dated_tariff
from ..sources.readers import literal_table
from ..vocab import TARIFF_1, TARIFF_2
from .registry import money, num, query

_LM = "CAST(l_extendedprice AS DECIMAL(18,2))"
_OM = "CAST(o_totalprice AS DECIMAL(18,2))"


@query(f"""
SELECT n_name, r_name, COUNT(*) AS n, CAST(SUM({_OM}) AS DOUBLE) AS total
FROM orders LEFT JOIN customer ON o_custkey=c_custkey LEFT JOIN nation ON c_nationkey=n_nationkey LEFT JOIN region ON n_regionkey=r_regionkey GROUP BY 1,2
""")
def left_lookups(t):
    """Orders per nation; summed per customer before the dimension joins."""
    per = t("orders", "o_custkey", "o_totalprice").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("total"))
    rows = (
        per.join(t("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    return rows.groupBy("n_name", "r_name").agg(F.sum("n").alias("n"), num(F.sum("total")).alias("total"))


@query(f"""
SELECT o_orderpriority, s_nationkey, CAST(SUM({_LM}) AS DOUBLE) AS total, COUNT(*) AS n
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN supplier ON l_suppkey=s_suppkey GROUP BY 1,2
""")
def inner_chain(t):
    """Lines to orders and suppliers; the lines of an order are summed before they are joined."""
    l = t("lineitem", "l_orderkey", "l_suppkey", "l_extendedprice").groupBy("l_orderkey", "l_suppkey").agg(
        F.sum(money("l_extendedprice")).alias("m"), F.count(F.lit(1)).alias("c"))
    o = t("orders", "o_orderkey", "o_orderpriority").withColumnRenamed("o_orderkey", "l_orderkey")
    rows = l.join(o, "l_orderkey").join(t("supplier", "s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.groupBy("o_orderpriority", "s_nationkey").agg(num(F.sum("m")).alias("total"), F.sum("c").alias("n"))


@query("""
WITH a AS (SELECT l_partkey, l_suppkey, SUM(l_quantity) AS returned FROM lineitem WHERE l_returnflag='R' GROUP BY 1,2),
b AS (SELECT l_partkey, l_suppkey, SUM(l_quantity) AS kept FROM lineitem WHERE l_returnflag='N' GROUP BY 1,2)
SELECT COALESCE(a.l_partkey,b.l_partkey) AS l_partkey, COALESCE(a.l_suppkey,b.l_suppkey) AS l_suppkey, returned, kept
FROM a FULL JOIN b ON a.l_partkey=b.l_partkey AND a.l_suppkey=b.l_suppkey
""")
def full_join_pivots(t):
    """Full join on a compound key of two sums."""
    l = t("lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    side = lambda flag, n: l.where(F.col("l_returnflag") == flag).groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias(n))
    return side("R", "returned").join(side("N", "kept"), ["l_partkey", "l_suppkey"], "full")


@query("""
SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey=c_custkey AND c_acctbal>0 WHERE c_mktsegment NOT IN ('BUILDING','MACHINERY')
""")
def null_rejecting_filter(t):
    """The filter on the right side makes the left join an inner join."""
    c = t("customer", "c_custkey", "c_mktsegment", "c_acctbal").where(F.col("c_acctbal") > 0)
    rows = t("orders", "o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.where(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("o_orderkey", "c_mktsegment")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey=c_custkey AND o_totalprice>400000)")
def anti_customers(t):
    big = t("orders", "o_custkey", "o_totalprice").where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return J.anti_join(t("customer", "c_custkey"), big, ["c_custkey"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(DISTINCT o_orderkey)>=12)")
def min_orders(t):
    """Orders of customers with at least twelve of them."""
    return J.keep_keys(t("orders", "o_orderkey", "o_custkey"), "o_custkey", F.count_distinct("o_orderkey"), lambda n: n >= 12)


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT','5-LOW')")
def excluded_list(t):
    listed = literal_table(t.spark, ["1-URGENT", "5-LOW"], "o_orderpriority")
    return J.exclude_keys(t("orders", "o_orderkey", "o_orderpriority"), "o_orderpriority", listed).select("o_orderkey", "o_orderpriority")


@query("""
SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(DISTINCT o_orderstatus)=2) THEN 1 ELSE 0 END AS two_states,
  CASE WHEN o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(*)=COUNT(CASE WHEN o_orderstatus='F' THEN 1 END)) THEN 1 ELSE 0 END AS all_closed FROM orders
""")
def group_flags(t):
    o = t("orders", "o_orderkey", "o_custkey", "o_orderstatus")
    s = F.col("o_orderstatus")
    out = J.flag_by_group(o, "o_custkey", {"two_states": F.count_distinct(s) == 2, "all_closed": F.count(F.lit(1)) == F.count(F.when(s == "F", 1))})
    return out.select("o_orderkey", F.col("two_states").cast("int").alias("two_states"), F.col("all_closed").cast("int").alias("all_closed"))


@query("""
WITH v AS (SELECT s_suppkey AS entity, 'nation' AS attribute, CAST(s_nationkey AS VARCHAR) AS value FROM supplier
  UNION ALL SELECT s_suppkey, 'level', CAST(CAST(floor(s_acctbal/100) AS BIGINT) AS VARCHAR) FROM supplier),
g AS (SELECT attribute, value, COUNT(*) AS group_size, MIN(entity) AS first_member FROM v GROUP BY 1,2 HAVING COUNT(*)>1)
SELECT entity, attribute, value, group_size, first_member FROM v JOIN g USING (attribute, value)
""")
def shared_attributes(t):
    """Suppliers that share a nation or a balance level, without listing pairs."""
    s = t("supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 100).alias("level"))
    return shared_groups(s, "entity", ["nation", "level"])


@query("""
WITH v AS (SELECT c_custkey, c_nationkey*5+ascii(c_mktsegment)%5 AS a, CASE WHEN c_acctbal>0 THEN CAST(floor(c_acctbal/50) AS BIGINT) END AS b, CAST(c_custkey%97 AS BIGINT) AS c FROM customer),
p AS (SELECT x.c_custkey, y.c_custkey AS d FROM v x JOIN v y ON x.a=y.a AND x.c_custkey<>y.c_custkey
  UNION SELECT x.c_custkey, y.c_custkey FROM v x JOIN v y ON x.b=y.b AND x.c_custkey<>y.c_custkey
  UNION SELECT x.c_custkey, y.c_custkey FROM v x JOIN v y ON x.c=y.c AND x.c_custkey<>y.c_custkey),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY d DESC) rn FROM p)
SELECT v.c_custkey, CAST(COUNT(d) AS BIGINT) AS n_dup, MAX(CASE WHEN rn=1 THEN d END) AS dup1, MAX(CASE WHEN rn=2 THEN d END) AS dup2, MAX(CASE WHEN rn=3 THEN d END) AS dup3
FROM v LEFT JOIN r ON v.c_custkey=r.c_custkey GROUP BY 1
""")
def duplicates_wide_customers(t):
    """Partners over three shared attributes, counted exactly, first three listed."""
    c = t("customer").select(
        "c_custkey", (F.col("c_nationkey") * 5 + F.ascii("c_mktsegment") % 5).alias("a"),
        F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_acctbal") / 50)).alias("b"), (F.col("c_custkey") % 97).alias("c"),
    )
    return duplicates_wide(c, "c_custkey", ["a", "b", "c"], 3)


_RATES = """r1 AS (SELECT p_brand AS k, MIN(p_size)/100.0::DOUBLE AS v FROM part WHERE p_size<3 GROUP BY 1),
r2 AS (SELECT p_type AS k, MIN(p_retailprice) AS v FROM part WHERE p_brand IN ('Brand#1','Brand#2','Brand#3') AND p_type IN ('PROMO','SMALL') GROUP BY 1)"""


@query(f"""
WITH {_RATES}
SELECT p_partkey, COALESCE(a.v, b.v, 0.15::DOUBLE) AS rate FROM part
LEFT JOIN r1 a ON a.k=p_brand AND p_size>=40 LEFT JOIN r2 b ON b.k=p_type
""")
def cascade_rate(t):
    """Rate by brand (large sizes only), else by type, else 0.15."""
    p = t("part", "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    r1 = p.where(F.col("p_size") < 3).select("p_brand", (F.col("p_size") / 100).alias("v"))
    r2 = p.where(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3") & F.col("p_type").isin("PROMO", "SMALL")).select("p_type", F.col("p_retailprice").alias("v"))
    rules = [([F.when(F.col("p_size") >= 40, F.col("p_brand"))], r1, ["p_brand"], "v"), ([F.col("p_type")], r2, ["p_type"], "v")]
    return J.cascade_join(p, rules, "rate", 0.15).select("p_partkey", "rate")


@query("""
WITH c AS (SELECT c_custkey, substr(c_name,10) AS code FROM customer),
l AS (SELECT DISTINCT substr(s_name,10,7) AS p FROM supplier WHERE s_acctbal>0 UNION SELECT DISTINCT substr(s_name,10,5) FROM supplier WHERE s_acctbal<=0),
m AS (SELECT c_custkey, code, (SELECT p FROM l WHERE p=substr(code,1,7)) AS a, (SELECT p FROM l WHERE p=substr(code,1,5)) AS b FROM c)
SELECT c_custkey, COALESCE(a,b,code) AS category FROM m
""")
def longest_prefix(t):
    """Longest listed prefix (7, then 5 digits) of a customer code."""
    c = t("customer", "c_custkey", "c_name").select("c_custkey", F.substring("c_name", 10, 99).alias("code"))
    codes = t("supplier", "s_name", "s_acctbal").select(
        F.when(F.col("s_acctbal") > 0, F.substring("s_name", 10, 7)).otherwise(F.substring("s_name", 10, 5)).alias("p"))
    return J.longest_prefix_match(c, "code", codes, "p", (7, 5), "category").select("c_custkey", "category")


@query("""
WITH u AS (SELECT l_orderkey, MIN(l_suppkey) AS only_supplier FROM lineitem GROUP BY 1 HAVING COUNT(DISTINCT l_suppkey)=1)
SELECT o_orderkey, only_supplier FROM orders LEFT JOIN u ON o_orderkey=l_orderkey
""")
def unique_match(t):
    """Supplier of an order where there is exactly one."""
    l = t("lineitem", "l_orderkey", "l_suppkey").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("only_supplier"))
    return J.join_if_unique(t("orders", "o_orderkey"), l, ["o_orderkey"], "only_supplier")


@query("""
WITH a AS (SELECT user_id, event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events WHERE event_type='click'),
b AS (SELECT user_id, event_id AS purchase_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events WHERE event_type='purchase')
SELECT a.user_id, a.position, event_id, purchase_id FROM a LEFT JOIN b ON a.user_id=b.user_id AND a.position=b.position
""")
def pair_by_position(t):
    """k-th click of a user with its k-th purchase."""
    e = t("events", "user_id", "event_id", "event_type", "ts")
    a = e.where(F.col("event_type") == "click").select("user_id", "event_id", "ts")
    b = e.where(F.col("event_type") == "purchase").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("ts_b"))
    out = J.pair_by_position(a, b, ["user_id"], ["ts", "event_id"], ["ts_b", "purchase_id"], F.to_date("ts"), F.to_date("ts_b"))
    return out.select("user_id", "position", "event_id", "purchase_id")


@query("""
SELECT o_orderkey, COALESCE(team,'Other') AS team FROM orders LEFT JOIN (VALUES ('1-URGENT',NULL,TIMESTAMP '1997-01-01','A'),('1-URGENT',TIMESTAMP '1997-01-01',NULL,'B'),
 ('2-HIGH',TIMESTAMP '1998-06-01',TIMESTAMP '1999-06-01','C')) r(k,f,u,team) ON o_orderpriority=k AND (f IS NULL OR o_orderdate>=f) AND (u IS NULL OR o_orderdate<u)
""")
def effective_rule(t):
    """Team of a priority by rules with effective dates."""
    rules = t.spark.createDataFrame(
        [("1-URGENT", None, "1997-01-01", "A"), ("1-URGENT", "1997-01-01", None, "B"), ("2-HIGH", "1998-06-01", "1999-06-01", "C")],
        "o_orderpriority string, valid_from string, valid_to string, team string",
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})
    o = t("orders", "o_orderkey", "o_orderpriority", "o_orderdate")
    out = J.effective_lookup(o, rules, ["o_orderpriority"], "o_orderdate", "valid_from", "valid_to", {"team": "Other"})
    return out.select("o_orderkey", "team")


def _case(table, amount, size, sign=""):
    parts = []
    for sizes, lo, hi, fee in table:
        cond = ["TRUE"]
        if sizes:
            cond.append(f"{size} IN ({','.join(repr(s) for s in sizes)})")
        if lo is not None:
            cond.append(f"{amount}>={lo}")
        if hi is not None:
            cond.append(f"{amount}<{hi}")
        parts.append(f"WHEN {' AND '.join(cond)} THEN {fee}::DOUBLE")
    return "CASE " + " ".join(parts) + " ELSE 0::DOUBLE END"


_SIZE = "CASE p_size%5 WHEN 0 THEN 'XXXS' WHEN 1 THEN 'S' WHEN 2 THEN 'M' WHEN 3 THEN 'XL' ELSE 'EO' END"


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN l_shipdate>=TIMESTAMP '1996-01-01' AND l_shipdate<TIMESTAMP '1998-01-01' THEN {_case(TARIFF_1, 'price', 'size')}
 WHEN l_shipdate>=TIMESTAMP '1998-01-01' THEN {_case(TARIFF_2, 'price', 'size')} ELSE 0::DOUBLE END AS fee
FROM (SELECT *, l_extendedprice/1000 AS price, {_SIZE} AS size FROM lineitem JOIN part ON l_partkey=p_partkey)
""")
def tariff_band(t):
    """Shipping share by size, price band and period, as one expression."""
    l = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    rows = l.join(t("part", "p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    k = F.col("p_size") % 5
    size = F.when(k == 0, "XXXS").when(k == 1, "S").when(k == 2, "M").when(k == 3, "XL").otherwise("EO")
    fee = dated_tariff("l_shipdate", F.col("l_extendedprice") / 1000, size, [("1996-01-01", "1998-01-01", TARIFF_1), ("1998-01-01", None, TARIFF_2)])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", fee.alias("fee"))


@query("""
SELECT DISTINCT l_orderkey, l_linenumber, CASE WHEN COUNT(DISTINCT l_suppkey)=1 THEN 'OK' ELSE 'NOK' END AS observation FROM lineitem GROUP BY 1,2
""")
def key_conflict(t):
    """Order lines that name more than one supplier."""
    l = t("lineitem", "l_orderkey", "l_linenumber", "l_suppkey")
    return J.key_conflict_flag(l, ["l_orderkey", "l_linenumber"], "l_suppkey").select("l_orderkey", "l_linenumber", "observation").distinct()


@query(r"""
SELECT DISTINCT page_id, m FROM (
  SELECT page_id, unnest(regexp_extract_all(url,'[0-9]{2,}')) AS m FROM pages UNION ALL SELECT page_id, unnest(regexp_extract_all(html,'\b2[0-9]{1,9}\b')) FROM pages)
""")
def explode_numbers(t):
    """Numbers mentioned in the address or the text of a page."""
    return J.explode_matches(t("pages"), ["page_id"], [("url", r"[0-9]{2,}"), ("html", r"\b2[0-9]{1,9}\b")], "m")


@query(r"""
SELECT doc_id, n FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text,'\b[0-9]{3,9}\b'))) AS n FROM documents)
""")
def explode_ids(t):
    return J.explode_matches(t("documents", "doc_id", "text"), ["doc_id"], [("text", r"\b[0-9]{3,9}\b")], "n")


@query(f"""
SELECT 'orders' AS source, o_orderkey AS k, CAST({_OM} AS DOUBLE) AS amount, NULL AS flag FROM orders
UNION ALL SELECT 'lines', l_orderkey, CAST({_LM} AS DOUBLE), l_returnflag FROM lineitem
""")
def union_sources(t):
    """Two sources under one schema; the column one of them lacks is NULL."""
    return S.union_sources(
        {
            "orders": t("orders", "o_orderkey", "o_totalprice").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("amount")),
            "lines": t("lineitem", "l_orderkey", "l_extendedprice", "l_returnflag").select(
                F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("amount"), F.col("l_returnflag").alias("flag")),
        }
    )


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    return S.union_distinct(t("customer").select(F.col("c_nationkey").alias("nation")), t("supplier").select(F.col("s_nationkey").alias("nation")))


@query("""
SELECT o_orderkey, 'closed' AS branch, o_totalprice AS amount FROM orders WHERE o_orderstatus='F'
UNION ALL SELECT o_orderkey, 'open', o_totalprice/2 FROM orders WHERE o_orderstatus<>'F'
""")
def split_and_reunite(t):
    """Two disjoint treatments in one pass over the table."""
    closed = F.col("o_orderstatus") == "F"
    return t("orders", "o_orderkey", "o_orderstatus", "o_totalprice").select(
        "o_orderkey", F.when(closed, "closed").otherwise("open").alias("branch"),
        F.when(closed, F.col("o_totalprice")).otherwise(F.col("o_totalprice") / 2).alias("amount"),
    )


@query("""
SELECT o_orderkey, o_custkey FROM orders n WHERE o_orderdate>=TIMESTAMP '1999-01-01'
AND NOT EXISTS (SELECT 1 FROM orders h WHERE h.o_orderdate<TIMESTAMP '1999-01-01' AND h.o_custkey=n.o_custkey AND h.o_orderpriority=n.o_orderpriority)
""")
def new_minus_history(t):
    """Orders whose customer and priority the history does not hold."""
    o = t("orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    out = S.new_rows(o.where(F.col("o_orderdate") >= cut), o.where(F.col("o_orderdate") < cut), ["o_custkey", "o_orderpriority"])
    return out.select("o_orderkey", "o_custkey")


@query(f"""
WITH a AS (SELECT o_orderkey AS k, SUM({_OM}) AS amount_a FROM orders GROUP BY 1), b AS (SELECT l_orderkey AS k, SUM({_LM}) AS amount_b FROM lineitem GROUP BY 1)
SELECT COALESCE(a.k,b.k) AS k, CAST(amount_a AS DOUBLE) AS amount_a, CAST(amount_b AS DOUBLE) AS amount_b, CAST(COALESCE(amount_a,0)-COALESCE(amount_b,0) AS DOUBLE) AS difference,
 CASE WHEN amount_a IS NULL THEN 'only_b' WHEN amount_b IS NULL THEN 'only_a' WHEN ABS(amount_a-amount_b)<=5000 THEN 'equal' ELSE 'different' END AS status
FROM a FULL JOIN b ON a.k=b.k
""")
def source_reconcile(t):
    """Order totals against line totals."""
    a = t("orders", "o_orderkey", "o_totalprice").select(F.col("o_orderkey").alias("k"), money("o_totalprice").alias("amount"))
    b = t("lineitem", "l_orderkey", "l_extendedprice").select(F.col("l_orderkey").alias("k"), money("l_extendedprice").alias("amount"))
    out = S.reconcile(a, b, ["k"], "amount", 5000)
    return out.withColumns({c: num(c) for c in ("amount_a", "amount_b", "difference")})


@query(f"""
WITH s AS (SELECT 'pos' AS origin, l_orderkey, l_returnflag, CAST({_LM} AS DOUBLE) AS amount FROM lineitem WHERE l_linestatus='O'
  UNION ALL SELECT 'settled', l_orderkey, l_returnflag, CAST({_LM} AS DOUBLE) FROM lineitem WHERE l_linestatus='F'),
r AS (SELECT l_orderkey, l_returnflag, MIN(amount) AS c FROM s WHERE origin='settled' GROUP BY 1,2)
SELECT origin, l_orderkey, l_returnflag, amount, COALESCE(c,amount) AS correct_amount, CASE WHEN c IS NULL AND origin<>'settled' THEN 'NO' ELSE 'SI' END AS consider,
 ROUND(COALESCE(c,amount)-amount,4) AS difference FROM s LEFT JOIN r USING (l_orderkey, l_returnflag)
""")
def tagged_differences(t):
    """Both sources stacked, each row against the settled amount of its key."""
    l = t("lineitem", "l_orderkey", "l_returnflag", "l_extendedprice", "l_linestatus")
    part = lambda s: l.where(F.col("l_linestatus") == s).select("l_orderkey", "l_returnflag", F.col("l_extendedprice").alias("amount"))
    out = S.tagged_differences({"pos": part("O"), "settled": part("F")}, ["l_orderkey", "l_returnflag"], "amount", "settled")
    return out.withColumn("difference", F.round("difference", 4))
