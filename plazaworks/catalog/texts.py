"""Strings, numbers in strings, JSON."""

from pyspark.sql import functions as F

from .. import vocab
from ..functions import jsonx as X
from ..functions import numbers as N
from ..functions import sem
from ..functions import text as T
from ..operators.rules import case_first, classify
from ..plans.returns import carrier_name, parse_carrier_feed
from ..sources.sinks import fixed_width, money_digits
from .registry import query

_ACC, _PLN = T.ACCENTED, T.PLAIN


def _fold(c):
    return f"translate({c},'{_ACC}','{_PLN}')"


def _strip(c):
    return f"regexp_replace(regexp_replace({_fold(c)},'[,;/.''\"]','','g'),'[^a-zA-Z0-9]',' ','g')"


@query(f"SELECT doc_id, md5({_fold('text')}) AS folded, md5({_strip('text')}) AS clean, length(regexp_replace({_strip('text')},'\\s+',' ','g')) AS squeezed FROM documents")
def text_clean(t):
    """Accent folding, sign removal and blank squeezing over whole texts."""
    d = t("documents", "doc_id", "text")
    return d.select(
        "doc_id", F.md5(T.fold_accents("text")).alias("folded"), F.md5(T.fold_and_strip("text")).alias("clean"),
        F.length(T.squeeze_blanks(T.fold_and_strip("text"))).cast("bigint").alias("squeezed"),
    )


_DELIMS = r"[\s\[\](){}/|<>!?@\"^#$&~_,.:;*%+-]"


@query(f"""
SELECT page_id, array_to_string(list_transform(range(1,length(url)+1), lambda i: CASE WHEN i=1 OR regexp_matches(substr(url,i-1,1),'{_DELIMS}') THEN upper(substr(url,i,1)) ELSE lower(substr(url,i,1)) END),'') AS title FROM pages
""")
def initcap_words(t):
    return t("pages", "page_id", "url").select("page_id", sem.initcap_delims("url").alias("title"))


@query(r"""
SELECT page_id, NULLIF(regexp_extract(url,'^(https?)://',1),'') AS scheme, CASE WHEN regexp_matches(url,'page=([0-9]+)') THEN regexp_extract(url,'page=([0-9]+)',1) END AS page,
 regexp_replace(url,'^https?://([a-z.]+)/.*$','\1') AS host, CASE WHEN regexp_matches(url,'#') THEN 1 ELSE 0 END AS anchored FROM pages
""")
def regex_pieces(t):
    """Groups (NULL without a match), replacements with groups, tests."""
    p = t("pages", "page_id", "url")
    return p.select(
        "page_id", sem.regexp_extract_n("url", "^(https?)://").alias("scheme"), sem.regexp_extract_n("url", "page=([0-9]+)").alias("page"),
        F.regexp_replace("url", "^https?://([a-z.]+)/.*$", "$1").alias("host"), F.col("url").rlike("#").cast("int").alias("anchored"),
    )


@query("""
SELECT c_custkey, '+51'||substr(c_name,10) AS phone, strpos(c_name,'#') AS at, left(c_name,8) AS head, length(c_name) AS len, lpad(CAST(c_custkey AS VARCHAR),8,'0') AS padded,
 levenshtein(lower(c_name),lower(c_mktsegment)) AS distance, CASE WHEN levenshtein(lower(c_name),lower(c_mktsegment))>=17 THEN 'Corregir' ELSE 'Ok' END AS verdict FROM customer
""")
def string_basics(t):
    c = t("customer", "c_custkey", "c_name", "c_mktsegment")
    distance = T.edit_distance("c_name", "c_mktsegment")
    return c.select(
        "c_custkey", T.phone_with_prefix(F.substring("c_name", 10, 99)).alias("phone"), F.instr("c_name", "#").cast("bigint").alias("at"),
        F.left("c_name", F.lit(8)).alias("head"), F.length("c_name").cast("bigint").alias("len"), T.zero_pad("c_custkey", 8).alias("padded"),
        distance.cast("bigint").alias("distance"), T.needs_fix(distance >= 17).alias("verdict"),
    )


@query(r"""
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_extendedprice, regexp_replace(CAST(l_partkey AS VARCHAR)||'.0','\.0$','') AS id, 'F001' AS series, CAST(l_orderkey AS VARCHAR)||'-x' AS number FROM lineitem
""")
def id_cleaning(t):
    """Float tails of ids dropped; document numbers split at the first dash only."""
    l = t("lineitem", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    series, number = T.split_document(F.concat(F.lit("F001-"), F.col("l_orderkey").cast("string"), F.lit("-x")))
    return l.select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice",
        T.strip_float_tail(F.concat(F.col("l_partkey").cast("string"), F.lit(".0"))).alias("id"), series.alias("series"), number.alias("number"),
    )


@query(r"""
SELECT doc_id, CASE WHEN regexp_matches(text,'([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})') THEN regexp_extract(text,'([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})',1) END AS email,
 CASE WHEN regexp_matches(text,'(?:^|[^0-9])(9[0-9]{8})(?:[^0-9]|$)') THEN regexp_extract(text,'(?:^|[^0-9])(9[0-9]{8})(?:[^0-9]|$)',1) END AS phone FROM documents
""")
def contact_extraction(t):
    c = T.extract_contact("text")
    return t("documents", "doc_id", "text").select("doc_id", c["email"].alias("email"), c["phone"].alias("phone"))


def _units_sql(c):
    out = f"lower({_fold(c)})"
    for p, r in T.UNIT_RULES:
        p, r = p.replace("'", "''"), r.replace("$1", r"\1").replace("$2", r"\2")
        out = f"regexp_replace({out},'{p}','{r}','g')"
    return out


_NAME = "p_name||' '||CAST(p_size AS VARCHAR)||CASE p_size%7 WHEN 0 THEN ' kilos' WHEN 1 THEN ' litros' WHEN 2 THEN ' pulgadas' WHEN 3 THEN 'cc' WHEN 4 THEN ' gr' WHEN 5 THEN ' Centímetros' ELSE ' onz' END"
_QTY = r"(\d{1,3}\.\d{1,3}|(?:\d{1,3})(?:cm|kg|lb|mg|ml|mm|oz|in|g|l|m)\b|\d{2}in)"


def _product_name():
    k = F.col("p_size") % 7
    unit = case_first([(k == i, u) for i, u in enumerate([" kilos", " litros", " pulgadas", "cc", " gr", " Centímetros"])], " onz")
    return F.concat("p_name", F.lit(" "), F.col("p_size").cast("string"), unit)


@query(f"SELECT p_partkey, {_units_sql(_NAME)} AS name FROM part")
def unit_normaliser(t):
    return t("part", "p_partkey", "p_name", "p_size").select("p_partkey", T.normalise_units(_product_name()).alias("name"))


@query(f"""
WITH n AS (SELECT p_partkey, {_units_sql(_NAME)} AS name FROM part), a AS (SELECT p_partkey, NULLIF(regexp_extract(name,'{_QTY}',1),'') AS amount FROM n)
SELECT p_partkey, COALESCE(TRY_CAST(regexp_replace(amount,'([a-z]{{1,2}})','','g') AS DOUBLE),1.0::DOUBLE) AS quantity, COALESCE(NULLIF(regexp_extract(amount,'([a-z]{{1,2}})',1),''),'un') AS unit FROM a
""")
def quantity_and_unit(t):
    p = t("part", "p_partkey", "p_name", "p_size").select("p_partkey", T.normalise_units(_product_name()).alias("name"))
    return p.select("p_partkey", T.dimension_quantity("name").alias("quantity"), T.dimension_unit("name").alias("unit"))


# words that do occur in the shared texts, in the shape of a rule list
_TOPICS = (("token|key", "secret"), (r"\bthe\b.*\bof\b", "english"), (r"\bder\b|\bdie\b", "german"), (r"\bles?\b|\bla\b", "french"), ("cion", "spanish"))


@query("SELECT doc_id, CASE " + " ".join(f"WHEN regexp_matches({_fold('text')},'{p}') THEN '{v}'" for p, v in _TOPICS) + " ELSE 'Otro' END AS topic FROM documents")
def classify_text(t):
    """Ordered pattern rules over whole folded texts, first match wins."""
    return t("documents", "doc_id", "text").select("doc_id", classify(T.fold_accents("text"), _TOPICS, "Otro").alias("topic"))


def _rules_sql(c, rules, default):
    return "CASE " + " ".join(f"WHEN regexp_matches({c},'{p}') THEN '{v}'" for p, v in rules) + f" ELSE {default} END"


_REASON = "lower(event_type||' '||list_extract(['no funciona','me falto','talla chica','quiero cambiar','la factura','llego roto'],1+CAST(event_id%6 AS INT)))"


@query(f"SELECT event_id, {_rules_sql(_REASON, vocab.RETURN_REASONS, repr(vocab.RETURN_REASON_OTHER))} AS reason FROM events")
def return_reasons(t):
    """Return reason by the words of a case."""
    words = F.array(*[F.lit(w) for w in ("no funciona", "me falto", "talla chica", "quiero cambiar", "la factura", "llego roto")])
    text = F.lower(F.concat_ws(" ", "event_type", F.get(words, (F.col("event_id") % 6).cast("int"))))
    return t("events", "event_id", "event_type").select("event_id", classify(text, vocab.RETURN_REASONS, vocab.RETURN_REASON_OTHER).alias("reason"))


_BODY = "'Cuerpo: '||text||' con esta informacion quedamos. Agradecemos su tiempo'"


@query(f"""
WITH c AS (SELECT conv_id, turn, regexp_replace(regexp_extract(lower({_strip(_BODY)}),'(?s)cuerpo\\s*(.*)agradecemos',1),'\\s+',' ','g') AS flat FROM conversations)
SELECT conv_id, turn, md5(regexp_replace(regexp_extract(flat,'^(.*con esta informacion)',1),' con esta informacion','','g')) AS body FROM c
""")
def mail_body(t):
    """Body of a mail between its opening and closing words."""
    c = t("conversations", "conv_id", "turn", "text")
    mail = F.concat(F.lit("Cuerpo: "), F.col("text"), F.lit(" con esta informacion quedamos. Agradecemos su tiempo"))
    return c.select("conv_id", "turn", F.md5(T.mail_body(mail)).alias("body"))


_STOP = ["der", "die", "the", "of", "la", "le", "and"]


@query(f"""
SELECT doc_id, len(w) AS n, md5(array_to_string(w,' ')) AS h FROM (
 SELECT doc_id, list_filter(regexp_split_to_array(lower(text),'[^\\p{{L}}\\p{{N}}]+'), lambda x: length(x)>0 AND x NOT IN ({','.join(repr(s) for s in _STOP)})) AS w FROM documents)
""")
def token_filter(t):
    d = t("documents", "doc_id", "text").withColumn("w", T.tokens("text", _STOP))
    return d.select("doc_id", F.size("w").cast("bigint").alias("n"), F.md5(F.concat_ws(" ", "w")).alias("h"))


@query("""
SELECT c_custkey, array_to_string(list_slice(string_split(k,' '),1,2),' ') AS words, 'https://shop.example/id/'||CAST(c_custkey AS VARCHAR)||'/sellerId/'||CAST(c_nationkey AS VARCHAR) AS url,
 CASE WHEN length(c_name)>10 THEN 'https://labels.example/'||c_name||'.pdf' END AS label FROM (SELECT *, lower(c_mktsegment)||' of nation '||CAST(c_nationkey AS VARCHAR) AS k FROM customer)
""")
def words_and_urls(t):
    c = t("customer", "c_custkey", "c_nationkey", "c_name", "c_mktsegment")
    k = F.concat(F.lower("c_mktsegment"), F.lit(" of nation "), F.col("c_nationkey").cast("string"))
    return c.select(
        "c_custkey", T.first_words(k).alias("words"), T.order_url("https://shop.example", "c_custkey", "c_nationkey").alias("url"),
        T.label_url("https://labels.example", "c_name").alias("label"),
    )


@query("""
SELECT event_id, CASE WHEN regexp_matches(lower(event_type),'99') THEN '99Minutos' WHEN regexp_matches(lower(event_type),'andes') THEN 'Andes Express' WHEN regexp_matches(lower(event_type),'tms|own') THEN 'Own Fleet'
 WHEN regexp_matches(g,'REC|RET|DEV') THEN 'Own Fleet' WHEN regexp_matches(lower(event_type),'urbano') THEN 'Urbano' WHEN regexp_matches(g,'WYB') THEN 'Urbano' WHEN lower(event_type)='-' THEN 'Own Fleet'
 ELSE upper(event_type[1])||lower(event_type[2:]) END AS carrier FROM (SELECT *, list_extract(['REC1','WYB9','X77'],1+CAST(event_id%3 AS INT)) AS g FROM events)
""")
def carrier_by_guide(t):
    g = F.get(F.array(F.lit("REC1"), F.lit("WYB9"), F.lit("X77")), (F.col("event_id") % 3).cast("int"))
    return t("events", "event_id", "event_type").withColumn("g", g).select("event_id", carrier_name("event_type", "g").alias("carrier"))


@query("""
SELECT event_id, json_extract_string(props,'$.k') AS k, CASE WHEN CAST(json_extract_string(props,'$.k') AS BIGINT)>=50 THEN NULL ELSE CAST(json_extract_string(props,'$.k') AS BIGINT) END AS small, json_extract_string(props,'$.k') AS first_known FROM events
""")
def json_props(t):
    """Scalars of a document: by path, by lax parse, and the first known of several keys."""
    e = t("events", "event_id", "props").withColumn("m", X.as_map("props"))
    k = sem.safe_cast(X.lax_string("props", "k"), "bigint")
    return e.select("event_id", X.scalar("props", "$.k").alias("k"), F.when(k < 50, k).alias("small"), X.first_of_keys("m", ["zz", "q", "k"]).alias("first_known"))


@query("""
SELECT user_id, event_id, a, b FROM (SELECT user_id, event_id, unnest([event_id%2, event_id%3]) AS a FROM events) JOIN (SELECT event_id AS e, unnest([10,20]) AS b FROM events) ON e=event_id
""")
def nested_arrays(t):
    """Two arrays of a row opened against each other."""
    e = t("events", "user_id", "event_id")
    a = e.withColumn("a", F.explode(F.array(F.col("event_id") % 2, F.col("event_id") % 3)))
    return a.withColumn("b", F.explode(F.array(F.lit(10), F.lit(20)))).select("user_id", "event_id", "a", "b")


@query("""
SELECT doc_id, regexp_replace('["'||source||'"]','^\\["|"\\]$','','g') AS bare FROM documents
""")
def list_wrapper(t):
    d = t("documents", "doc_id", "source")
    return d.select("doc_id", X.strip_list_wrapper(F.concat(F.lit('["'), F.col("source"), F.lit('"]'))).alias("bare"))


@query("""
SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR),10,'0')||o_orderstatus||lpad(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2))*100 AS BIGINT) AS VARCHAR),15,'0') AS line FROM orders
""")
def fixed_width_lines(t):
    o = t("orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    return o.select("o_orderkey", fixed_width(("o_orderkey", 10), ("o_orderstatus", None), (money_digits("o_totalprice", 15), None)).alias("line"))


@query("""
SELECT c_custkey, TRY_CAST(replace(replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR),'.',','),',','.') AS DOUBLE) AS comma,
 CAST(-12047548 - c_custkey AS DOUBLE)/power(10.0::DOUBLE, length(CAST(-12047548 - c_custkey AS VARCHAR))-3) AS lat, CASE WHEN c_acctbal>5000 THEN 5000 ELSE c_acctbal END AS capped,
 floor(c_acctbal/100)+CASE WHEN c_acctbal/100-floor(c_acctbal/100)<0.5 THEN 0 ELSE 1 END AS units, c_custkey%4 AS den, CASE WHEN c_custkey%4<>0 THEN c_custkey/(c_custkey%4) END AS ratio FROM customer
""")
def number_repairs(t):
    """Decimal commas, lost decimal points, caps, whole units, safe division."""
    c = t("customer", "c_custkey", "c_acctbal")
    comma = F.regexp_replace(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), r"\.", ",")
    return c.select(
        "c_custkey", N.decimal_comma(comma).alias("comma"), N.repair_coordinate(F.lit(-12047548) - F.col("c_custkey")).alias("lat"),
        N.cap("c_acctbal", F.lit(5000.0)).alias("capped"), N.nearest_units(F.col("c_acctbal") / 100).cast("double").alias("units"),
        (F.col("c_custkey") % 4).alias("den"), sem.safe_divide("c_custkey", F.col("c_custkey") % 4).alias("ratio"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_extendedprice*l_discount AS fee, l_extendedprice*l_discount/1.18::DOUBLE AS net_fee, l_extendedprice-l_extendedprice*l_discount AS net,
 CASE WHEN l_quantity>25 AND l_discount>0.05 THEN 'b' ELSE 'a' END AS pick, CASE WHEN l_quantity>40 THEN NULL ELSE least(l_quantity, 30) END AS strict FROM lineitem
""")
def fee_split(t):
    l = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_quantity")
    s = N.commission_split("l_extendedprice", "l_discount")
    return l.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", s["commission"].alias("fee"), s["commission_net_of_tax"].alias("net_fee"), s["net"].alias("net"),
        F.when((F.col("l_quantity") > 25) & (F.col("l_discount") > 0.05), "b").otherwise("a").alias("pick"),
        sem.least_strict(F.when(F.col("l_quantity") <= 40, F.col("l_quantity")), F.lit(30.0)).alias("strict"),
    )


@query(r"""
SELECT event_id, regexp_replace(regexp_extract(r,'^([^-]*)',1),' PROD','') AS order_id, CASE WHEN event_id%2=0 THEN '1'||lpad(CAST(event_id AS VARCHAR),CAST(greatest(8,length(CAST(event_id AS VARCHAR))) AS INT),'0') END AS sku, CAST(event_id%3+1 AS BIGINT) AS n_guide,
 CASE WHEN regexp_matches(o,'^2') AND length(o)=10 THEN 'ORDER' WHEN regexp_matches(o,'^RLO') THEN 'RLO' WHEN length(o)>12 THEN 'Rastreo' ELSE 'Otro' END AS kind
FROM (SELECT event_id, b||'-'||CAST(event_id%3+1 AS VARCHAR) AS r, b AS o FROM (SELECT event_id, list_extract(['2','RLO','1234','9'],1+CAST(event_id%4 AS INT))||lpad(CAST(event_id AS VARCHAR),CAST(greatest(9,length(CAST(event_id AS VARCHAR))) AS INT),'0') AS b FROM events))
""")
def carrier_feed(t):
    """Order, sku and guide number from a carrier's reference texts."""
    e = t("events", "event_id")
    base = F.concat(F.get(F.array(*[F.lit(x) for x in ("2", "RLO", "1234", "9")]), (F.col("event_id") % 4).cast("int")), T.zero_pad("event_id", 9))
    feed = e.select(
        F.concat(base, F.lit("-"), (F.col("event_id") % 3 + 1).cast("string")).alias("reference"),
        F.concat(F.when(F.col("event_id") % 2 == 0, F.lit("1")).otherwise(F.lit("x")), T.zero_pad("event_id", 8), F.lit(" box")).alias("content"),
        F.lit(None).cast("string").alias("pieces"), F.col("event_id").alias("guide"), F.lit("").alias("state"), F.lit(None).cast("date").alias("requested_at"),
    )
    out = parse_carrier_feed(feed)
    return out.select(F.col("guide").alias("event_id"), "order_id", "sku", F.col("n_guide").cast("bigint").alias("n_guide"), "kind")
