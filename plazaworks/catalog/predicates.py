"""Projections, filters, labels."""

from pyspark.sql import functions as F

from .. import vocab
from ..functions.numbers import sign_type
from ..functions.sem import safe_cast
from ..operators import rules as R
from ..sources.readers import scan
from .registry import query


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate>=TIMESTAMP '1997-01-01' AND o_orderdate<TIMESTAMP '1997-02-01' AND o_orderpriority LIKE '2%'")
def pruned_scan(t):
    """Two columns of one month; range and prefix reach the reader."""
    where = (
        (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1997-02-01").cast("timestamp_ntz"))
        & F.col("o_orderpriority").startswith("2")
    )
    return scan(t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_totalprice"], where)


@query("SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def select_except(t):
    return t("customer").drop("c_name", "c_acctbal")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(t):
    return t("orders", "o_orderstatus", "o_orderpriority").distinct()


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice>400000 THEN 'top' WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'urgent' WHEN o_orderstatus='F' THEN 'closed' ELSE 'other' END AS label
FROM orders WHERE o_totalprice BETWEEN 100000 AND 450000
""")
def case_first_match(t):
    o = t("orders", "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus").where(F.col("o_totalprice").between(100000, 450000))
    rules = [(F.col("o_totalprice") > 400000, "top"), (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "urgent"), (F.col("o_orderstatus") == "F", "closed")]
    return o.select("o_orderkey", R.case_first(rules, "other").alias("label"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN d<0.02 THEN '1. 0 a 5%' WHEN d<0.05 THEN '2. 5 a 30%' WHEN d<0.08 THEN '3. 30% a 50%' ELSE '4. resto' END AS band
FROM (SELECT *, l_discount AS d FROM lineitem)
""")
def bucket_discount(t):
    l = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    edges = ((0.02, "1. 0 a 5%"), (0.05, "2. 5 a 30%"), (0.08, "3. 30% a 50%"), (None, "4. resto"))
    return l.withColumn("band", R.bands("l_discount", edges)).drop("l_discount")


_WORDS = ["ENTREGADO", "EN REPARTO", "REGISTRADO", "SINIESTRO", "anulado", "CUSTODIA", "", "OTRO ESTADO"]
_WORD_SQL = "list_extract([" + ",".join(f"'{w}'" for w in _WORDS) + "], 1+CAST(event_id%8 AS INT))"


def _vocab_sql(c):
    whens = " ".join(f"WHEN upper({c}) IN ({','.join(repr(x) for x in ws)}) THEN '{k}'" for k, ws in vocab.RETURN_STATES.items())
    return f"CASE {whens} WHEN length({c})=0 THEN NULL ELSE {c} END"


def _rank_sql(c):
    whens = " ".join(f"WHEN {c}='{k}' THEN {v}" for k, v in vocab.RETURN_STATE_RANK.items())
    return f"CASE {whens} ELSE {vocab.RETURN_STATE_RANK_OTHER} END"


@query(f"SELECT event_id, state_group, {_rank_sql('state_group')} AS state_rank FROM (SELECT event_id, {_vocab_sql(_WORD_SQL)} AS state_group FROM events)")
def vocabulary_map(t):
    """Carrier words to one vocabulary, and the rank of the word."""
    word = F.get(F.array(*[F.lit(w) for w in _WORDS]), (F.col("event_id") % 8).cast("int"))
    out = t("events", "event_id").withColumn("state_group", R.vocabulary(word, vocab.RETURN_STATES))
    return out.withColumn("state_rank", R.label_rank("state_group", vocab.RETURN_STATE_RANK, vocab.RETURN_STATE_RANK_OTHER))


@query("""
SELECT event_id, COALESCE(n_name, event_type) AS word FROM events LEFT JOIN (SELECT CASE n_nationkey WHEN 1 THEN 'VIEW' WHEN 2 THEN 'click' END AS w, n_name FROM nation WHERE n_nationkey IN (1,2)) ON upper(w)=upper(event_type)
""")
def vocabulary_table(t):
    """The same from a mapping table."""
    n = t("nation", "n_nationkey", "n_name").where(F.col("n_nationkey").isin(1, 2))
    mapping = n.select(F.when(F.col("n_nationkey") == 1, "VIEW").otherwise("click").alias("w"), "n_name")
    return R.map_vocabulary(t("events", "event_id", "event_type"), "event_type", mapping, "w", "n_name", "word").select("event_id", "word")


@query("SELECT doc_id, CASE WHEN source NOT IN ('src1','src2') AND length(source)>=5 THEN source END AS source FROM documents")
def null_sentinels(t):
    return t("documents", "doc_id", "source").withColumn("source", R.null_if_sentinel("source", ("src1", "src2"), 5))


@query("SELECT doc_id, CASE WHEN quality=0 OR toxic=1 THEN 'Incorrecto' ELSE 'Correcto' END AS target FROM labels")
def any_flag(t):
    flags = t("labels").select("doc_id", F.when(F.col("quality") == 0, "Si").otherwise("No").alias("q"), F.when(F.col("toxic") == 1, "Si").otherwise("No").alias("x"))
    return flags.select("doc_id", R.any_flag(["q", "x"]).alias("target"))


@query("""
SELECT c_custkey, CASE WHEN k IN ('100','205') THEN 'list' WHEN regexp_matches(k,'^10') THEN 'RUC10' WHEN regexp_matches(k,'^20') THEN 'RUC20' ELSE 'Otro' END AS kind
FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS k FROM customer)
""")
def classify_prefix(t):
    c = t("customer", "c_custkey")
    return c.withColumn("kind", R.classify_by_prefix(F.col("c_custkey").cast("string"), {"list": ["100", "205"]}, {"RUC10": "^10", "RUC20": "^20"}))


@query("SELECT c_custkey, CASE WHEN c_acctbal>=0 THEN 'Ingreso' ELSE 'Egreso' END AS kind FROM customer")
def sign_types(t):
    return t("customer", "c_custkey", "c_acctbal").select("c_custkey", sign_type("c_acctbal").alias("kind"))


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING') THEN 'own' WHEN c_mktsegment NOT IN ('BUILDING') AND regexp_matches(c_name,'7$') THEN 'own'
 WHEN c_mktsegment NOT IN ('BUILDING') AND regexp_matches(CAST(c_custkey AS VARCHAR),'^2') THEN 'own' ELSE c_mktsegment END AS commerce FROM customer
""")
def commerce_scope(t):
    c = t("customer", "c_custkey", "c_mktsegment", "c_name")
    return c.select("c_custkey", R.scope_commerce("c_mktsegment", "c_name", F.col("c_custkey").cast("string"), ["BUILDING"], "own", "7$", "^2").alias("commerce"))


@query("SELECT doc_id, COALESCE(TRY_CAST(substr(source,4) AS BIGINT), -1) AS n, TRY_CAST(lang AS DOUBLE) AS bad FROM documents")
def coalesce_chain(t):
    d = t("documents", "doc_id", "source", "lang")
    return d.select("doc_id", F.coalesce(safe_cast(F.substring("source", 4, 99), "bigint"), F.lit(-1)).alias("n"), safe_cast("lang", "double").alias("bad"))
