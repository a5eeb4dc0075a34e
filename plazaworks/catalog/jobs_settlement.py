"""Settlement, statements, audits on the shared tables."""

from pyspark.sql import functions as F

from .. import vocab
from ..plans import audits as A
from ..plans import settlement as S
from ..operators import joins
from ..operators.windows import with_row_id, with_sequence
from ..session import store
from ..sources.sinks import with_header
from ..functions.text import zero_pad
from .joins import _case
from .registry import day, money, num, query

_M = "CAST(l_extendedprice AS DECIMAL(18,2))"
# sale lines shaped like the reports' ids: order 5 + nine digits, folio 1 + ten, sku 1 + seven
_SALES = f"""SELECT DISTINCT '5'||lpad(CAST(l_orderkey AS VARCHAR),CAST(greatest(9,length(CAST(l_orderkey AS VARCHAR))) AS INT),'0') AS order_no, '1'||lpad(CAST(l_orderkey*10+l_linenumber AS VARCHAR),CAST(greatest(10,length(CAST(l_orderkey*10+l_linenumber AS VARCHAR))) AS INT),'0') AS folio, '1'||lpad(CAST(l_partkey AS VARCHAR),CAST(greatest(7,length(CAST(l_partkey AS VARCHAR))) AS INT),'0') AS sku,
 CAST(l_suppkey%10 AS VARCHAR) AS store, CAST(l_orderkey%50 AS VARCHAR) AS till, CAST(l_partkey%40 AS VARCHAR) AS trx, CAST(l_shipdate AS DATE) AS sold_on, {_M} AS total, CAST({_M}*0.5 AS DECIMAL(18,2)) AS unit_price FROM lineitem"""


def _sales(t):
    l = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    pad = lambda c, n: F.concat(F.lit(n[0]), zero_pad(c, n[1]))
    k = F.col("l_orderkey")
    m = money("l_extendedprice")
    return l.select(
        pad(k, ("5", 9)).alias("order_no"), pad(k * 10 + F.col("l_linenumber"), ("1", 10)).alias("folio"), pad(F.col("l_partkey"), ("1", 7)).alias("sku"), (F.col("l_suppkey") % 10).cast("string").alias("store"),
        (k % 50).cast("string").alias("till"), (F.col("l_partkey") % 40).cast("string").alias("trx"), F.to_date("l_shipdate").alias("sold_on"), m.alias("total"), (m * F.lit("0.5").cast("decimal(2,1)")).cast("decimal(18,2)").alias("unit_price")).distinct()


def _kept_sales(t):
    """(sales, lines read for them); of many lines the sales are stored, because they are read many times."""
    s, rows = _sales(t), t("lineitem").count()
    return store(s) if rows >= joins.ROWS_AT_ONCE else s, rows


def _rule(n, left, right, sales="s"):
    on = " AND ".join(f"x.{a}=u.{b}" for a, b in zip(left, right))
    return f"LEFT JOIN (SELECT {','.join(right)}, MIN(order_no||folio||sku) AS hit FROM {sales} GROUP BY {','.join(right)} HAVING COUNT(DISTINCT order_no||folio||sku)=1) r{n} ON " + on.replace("u.", f"r{n}.")


_RULES = [
    (["order_no", "folio", "sku"], ["order_no", "folio", "sku"]), (["sold_on", "store", "till", "trx"], ["sold_on", "store", "till", "trx"]), (["o2", "s2"], ["order_no", "sku"]),
    (["o2", "back"], ["order_no", "total"]), (["o2", "back"], ["order_no", "unit_price"]), (["f2", "back"], ["folio", "total"]), (["f2", "back"], ["folio", "unit_price"]), (["o2"], ["order_no"]), (["f2"], ["folio"]),
    (["a1", "s3"], ["a1", "sku"]), (["a2", "s3"], ["a2", "sku"]), (["a3", "s3"], ["a3", "sku"]), (["a4", "s3"], ["a4", "sku"]),
]
# characters 3 to 8, 1 to 7, 5 to 10 and the last six of an order number, where it has them
_PARTS = "CASE WHEN length(order_no)>=8 THEN substr(order_no,3,6) END AS a1, CASE WHEN length(order_no)>=7 THEN substr(order_no,1,7) END AS a2, CASE WHEN length(order_no)>=10 THEN substr(order_no,5,6) END AS a3, CASE WHEN length(order_no)>=6 THEN right(order_no,6) END AS a4"


_REPAIRED = f"""WITH s AS (SELECT *, {_PARTS} FROM ({_SALES})),
b AS (SELECT order_no, folio, sku, total, CAST(substr(order_no,2) AS BIGINT)%11 AS m, sold_on, store, till, trx, unit_price FROM s),
q AS (SELECT folio||sku||CAST(total AS VARCHAR) AS refund_id, CASE m WHEN 1 THEN sku WHEN 3 THEN 'x' WHEN 4 THEN 'y' WHEN 7 THEN '99'||substr(order_no,3,6)||'99' WHEN 8 THEN substr(order_no,1,7)||'xxx' WHEN 9 THEN 'xxxx'||substr(order_no,5,6) WHEN 10 THEN right(order_no,6) ELSE order_no END AS order_no,
 CASE WHEN m=2 THEN order_no WHEN m=3 THEN 'x' WHEN m=4 THEN folio WHEN m=5 OR m>6 THEN 'z' ELSE folio END AS folio,
 CASE m WHEN 1 THEN order_no WHEN 2 THEN 'bad' WHEN 3 THEN '777' WHEN 5 THEN 'w' WHEN 6 THEN 'v' ELSE sku END AS sku, CASE WHEN m=3 THEN sold_on END AS sold_on, store, till, trx, -CASE WHEN m=6 THEN unit_price WHEN m=8 THEN 2*total WHEN m=9 THEN CAST(total*0.25 AS DECIMAL(18,2)) ELSE total END AS amount FROM b),
x AS (SELECT *, -amount AS back, COALESCE(CASE WHEN regexp_matches(order_no,'^5') AND length(order_no)=10 THEN order_no END, CASE WHEN regexp_matches(folio,'^5') AND length(folio)=10 THEN folio END, CASE WHEN length(sku)=9 THEN '5'||sku END) AS o2,
 COALESCE(CASE WHEN regexp_matches(order_no,'^1') AND length(order_no)=8 THEN order_no END, CASE WHEN regexp_matches(folio,'^1') AND length(folio)=8 THEN folio END, CASE WHEN regexp_matches(sku,'^1') AND length(sku)=8 THEN sku END) AS s2, COALESCE(s2, sku) AS s3, {_PARTS},
 COALESCE(CASE WHEN regexp_matches(order_no,'^1') AND length(order_no) BETWEEN 11 AND 12 THEN order_no END, CASE WHEN regexp_matches(folio,'^1') AND length(folio) BETWEEN 11 AND 12 THEN folio END, CASE WHEN regexp_matches(sku,'^1') AND length(sku) BETWEEN 11 AND 12 THEN sku END) AS f2 FROM q),
rep AS (SELECT refund_id, amount, CASE {' '.join(f'WHEN r{i}.hit IS NOT NULL THEN {i}' for i in range(1, 14))} ELSE 0 END AS rule, COALESCE({','.join(f'r{i}.hit' for i in range(1, 14))}, x.order_no||x.folio||x.sku) AS line
FROM x {' '.join(_rule(i, a, b) for i, (a, b) in enumerate(_RULES, 1))})"""


def _refunds(s):
    """Refunds of all sale lines, their ids mistyped in ten ways."""
    c = F.col
    m = F.substring("order_no", 2, 99).cast("bigint") % 11
    part = lambda *a: F.substring("order_no", *a)
    order = F.when(m == 1, c("sku")).when(m == 3, "x").when(m == 4, "y").when(m == 7, F.concat(F.lit("99"), part(3, 6), F.lit("99"))).when(m == 8, F.concat(part(1, 7), F.lit("xxx")))
    amount = F.when(m == 6, c("unit_price")).when(m == 8, 2 * c("total")).when(m == 9, (c("total") * F.lit("0.25").cast("decimal(3,2)")).cast("decimal(18,2)")).otherwise(c("total"))
    return s.select(
        F.concat("folio", "sku", c("total").cast("string")).alias("refund_id"),
        order.when(m == 9, F.concat(F.lit("xxxx"), part(5, 6))).when(m == 10, F.right("order_no", F.lit(6))).otherwise(c("order_no")).alias("order_no"),
        F.when(m == 2, c("order_no")).when(m == 3, "x").when((m == 5) | (m > 6), "z").otherwise(c("folio")).alias("folio"),
        F.when(m == 1, c("order_no")).when(m == 2, "bad").when(m == 3, "777").when(m == 5, "w").when(m == 6, "v").otherwise(c("sku")).alias("sku"),
        F.when(m == 3, c("sold_on")).alias("sold_on"), "store", "till", "trx", (-amount).cast("decimal(18,2)").alias("amount"))


@query(_REPAIRED + " SELECT refund_id, rule, line FROM rep")
def repaired_refunds(t):
    """Refunds whose ids were mistyped, led back to the sale they undo."""
    s, rows = _kept_sales(t)
    return S.repair_refunds(_refunds(s), s, rows).select("refund_id", "rule", F.concat("order_no", "folio", "sku").alias("line"))


@query(_REPAIRED + """, v AS (SELECT order_no||folio||sku AS line, MAX(total) AS t, MAX(unit_price) AS u FROM s GROUP BY 1),
h AS (SELECT rep.*, t, CASE WHEN u=-amount THEN 1 WHEN t=-amount THEN 2 WHEN t>=-amount THEN 3 WHEN t IS NOT NULL THEN 4 END AS amount_rule, CASE WHEN t<-amount AND u<>-amount THEN -t ELSE amount END AS held FROM rep LEFT JOIN v USING (line))
SELECT refund_id, rule, line, amount_rule, CAST(held AS DOUBLE) AS amount FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY line, held ORDER BY rule, refund_id) AS rn FROM h) WHERE rn=1""")
def held_refunds(t):
    """Repaired refunds held within their sale, one of each line and amount."""
    s, rows = _kept_sales(t)
    out = S.held_refunds(S.repair_refunds(_refunds(s), s, rows), s, rows)
    return out.select("refund_id", "rule", F.concat("order_no", "folio", "sku").alias("line"), "amount_rule", num("amount").alias("amount"))


_RATES = """rates AS (SELECT CASE p_partkey%3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS period, p_partkey%6+1 AS rule, CAST(p_partkey%23 AS VARCHAR) AS seller,
 CASE p_partkey%6+1 WHEN 1 THEN '' WHEN 2 THEN CAST(p_partkey%23 AS VARCHAR)||' - '||c7 WHEN 3 THEN '0 - '||c7 WHEN 4 THEN CAST(p_partkey%23 AS VARCHAR)||' - '||c5 WHEN 5 THEN CAST(p_partkey%23 AS VARCHAR)||' - '||c3 ELSE '0 - '||c5 END AS rate_key, CAST(p_size AS DOUBLE)/100 AS rate
 FROM (SELECT *, 'K0'||lpad(CAST(p_partkey%40 AS VARCHAR),2,'0')||lpad(CAST(p_partkey%30 AS VARCHAR),3,'0') AS c7, 'K0'||lpad(CAST(p_partkey%40 AS VARCHAR),2,'0')||'0' AS c5, 'K0'||CAST(p_partkey%4 AS VARCHAR) AS c3 FROM part))"""
_CLASS = "'K0'||lpad(CAST(l_partkey%40 AS VARCHAR),2,'0')||lpad(CAST(l_linenumber%3*10 AS VARCHAR),3,'0')"


def _rates(t):
    p = t("part", "p_partkey", "p_size")
    k = F.col("p_partkey")
    rule = k % 6 + 1
    who = (k % 23).cast("string")
    two = F.concat(F.lit("K0"), F.lpad((k % 40).cast("string"), 2, "0"))
    c7, c5, c3 = F.concat(two, F.lpad((k % 30).cast("string"), 3, "0")), F.concat(two, F.lit("0")), F.concat(F.lit("K0"), (k % 4).cast("string"))
    dash = lambda a, b: F.concat(a, F.lit(" - "), b)
    zero = F.lit("0")
    key = F.when(rule == 1, "").when(rule == 2, dash(who, c7)).when(rule == 3, dash(zero, c7)).when(rule == 4, dash(who, c5)).when(rule == 5, dash(who, c3)).otherwise(dash(zero, c5))
    return p.select(F.when(k % 3 == 0, "A").when(k % 3 == 1, "B").otherwise("C").alias("period"), rule.cast("string").alias("rule"), who.alias("seller"), key.alias("rate_key"), (F.col("p_size").cast("double") / 100).alias("rate"))


_LINES = f"""l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, {_M} AS m, CAST(l_suppkey%23 AS VARCHAR) AS seller, {_CLASS} AS class_code, CAST(l_shipdate AS DATE) AS sold_on, l_linestatus,
 CASE WHEN l_shipdate<TIMESTAMP '1997-01-01' THEN 'A' WHEN l_shipdate<TIMESTAMP '1999-01-01' THEN 'B' ELSE 'C' END AS period FROM lineitem)"""
_RATED = f"""WITH {_RATES}, {_LINES}, k AS (SELECT rule, period, CASE WHEN rule=1 THEN seller ELSE rate_key END AS k, MIN(rate) AS rate FROM rates GROUP BY 1,2,3),
z AS (SELECT l.*, COALESCE(a.rate,b.rate,c.rate,d.rate,e.rate,f.rate,0.15::DOUBLE) AS rate FROM l LEFT JOIN k a ON a.rule=1 AND a.period=l.period AND a.k=seller LEFT JOIN k b ON b.rule=2 AND b.period=l.period AND b.k=seller||' - '||class_code
 LEFT JOIN k c ON c.rule=3 AND c.period=l.period AND c.k='0 - '||class_code LEFT JOIN k d ON d.rule=4 AND d.period=l.period AND d.k=seller||' - '||substr(class_code,1,5)
 LEFT JOIN k e ON e.rule=5 AND e.period=l.period AND e.k=seller||' - '||substr(class_code,1,3) LEFT JOIN k f ON f.rule=6 AND f.period=l.period AND f.k='0 - '||substr(class_code,1,5))"""
_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _lines(t):
    l = t("lineitem", *_IDS, "l_shipdate", "l_linestatus")
    code = F.concat(F.lit("K0"), F.lpad((F.col("l_partkey") % 40).cast("string"), 2, "0"), F.lpad((F.col("l_linenumber") % 3 * 10).cast("string"), 3, "0"))
    return l.select(
        *_IDS, (F.col("l_suppkey") % 23).cast("string").alias("seller"), code.alias("class_code"), F.col("l_shipdate").alias("sold_on"), "l_linestatus", S.commission_period("l_shipdate", "1997-01-01", "1999-01-01").alias("period"))


@query(_RATED + " SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, period, rate FROM z")
def commission_rates(t):
    """Commission by six rules within the period of the sale."""
    return S.commission(_lines(t), _rates(t)).select(*_IDS, "period", "rate")


@query(_RATED + f""", n AS (SELECT *, l_extendedprice/1000 AS total, 'O'||CAST(l_orderkey AS VARCHAR) AS order_no, CAST(l_partkey AS VARCHAR) AS sku FROM z),
h AS (SELECT DISTINCT order_no, sku, total FROM n WHERE sold_on<DATE '1996-01-01'), f AS (SELECT n.*, CASE p_type WHEN 'PROMO' THEN 'XXXS' WHEN 'SMALL' THEN 'M' WHEN 'LARGE' THEN 'XL' WHEN 'MEDIUM' THEN 'S' ELSE 'S' END AS size FROM n JOIN part ON p_partkey=l_partkey WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.order_no=n.order_no AND h.sku=n.sku AND h.total=n.total)),
g AS (SELECT *, CASE WHEN sold_on>=DATE '1996-01-01' AND sold_on<DATE '1998-01-01' THEN {_case(vocab.TARIFF_1, 'total', 'size')} WHEN sold_on>=DATE '1998-01-01' THEN {_case(vocab.TARIFF_2, 'total', 'size')} ELSE 0::DOUBLE END AS shipping FROM f)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN substr(class_code,1,5) IN ('K0010','K0020') THEN substr(class_code,1,5) WHEN substr(class_code,1,3)='K00' THEN 'K00' ELSE class_code END AS category,
 total*rate AS commission, shipping, total-total*rate-shipping AS payable, '20010528-20010603' AS week FROM g WHERE sold_on<DATE '2001-06-01'-14 OR l_linestatus='F'""")
def settlement(t):
    """Payable lines of a week with commission, shipping share and net."""
    l = _lines(t).withColumns({
        "total": F.col("l_extendedprice") / 1000, "order_no": F.concat(F.lit("O"), F.col("l_orderkey").cast("string")), "sku": F.col("l_partkey").cast("string"), "folio": F.lit("-"), "unit_price": F.lit(1.0),
        "delivery_state": F.when(F.col("l_linestatus") == "F", "Entrega Total").otherwise("-")})
    managers = t.spark.createDataFrame([("K0010", "m1"), ("K0020", "m2"), ("K00", "m3")], "category string, manager string")
    kind = F.col("p_type")
    sizes = t("part", "p_partkey", "p_type").select(
        F.col("p_partkey").cast("string").alias("sku"), F.when(kind == "PROMO", "XXXS").when(kind == "SMALL", "M").when(kind == "LARGE", "XL").alias("size"))
    before = l.where(F.col("sold_on") < F.lit("1996-01-01").cast("timestamp_ntz")).select("order_no", "sku", "total")
    tariffs = [("1996-01-01", "1998-01-01", vocab.TARIFF_1), ("1998-01-01", None, vocab.TARIFF_2)]
    out = S.settle(l, _rates(t), managers, sizes, before, "2001-06-01", tariffs)
    return out.select(*_IDS, "category", "commission", "shipping", "payable", "week")


@query(f"""
WITH h AS (SELECT l_orderkey AS order_no, l_partkey AS sku, {_M} AS total FROM lineitem WHERE l_shipdate<TIMESTAMP '1998-01-01'), n AS (SELECT l_orderkey AS order_no, l_partkey AS sku, CASE WHEN l_returnflag='R' THEN -{_M} ELSE {_M} END AS total FROM lineitem WHERE l_shipdate>=TIMESTAMP '1998-01-01'),
s AS (SELECT 1 AS p, * FROM h UNION ALL SELECT 2, * FROM n), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_no, sku, total>=0 ORDER BY p, total) rn FROM s)
SELECT order_no, sku, CASE WHEN total>=0 THEN 'Ingreso' ELSE 'Egreso' END AS type, CAST(total AS DOUBLE) AS total FROM r WHERE rn=1 AND p=2
""")
def one_per_direction(t):
    """New lines whose order, sku and direction the history does not hold."""
    l = t("lineitem", "l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag", "l_shipdate")
    cut, m = F.lit("1998-01-01").cast("timestamp_ntz"), money("l_extendedprice")
    base = [F.col("l_orderkey").alias("order_no"), F.col("l_partkey").alias("sku")]
    history = l.where(F.col("l_shipdate") < cut).select(*base, m.alias("total"))
    new = l.where(F.col("l_shipdate") >= cut).select(*base, F.when(F.col("l_returnflag") == "R", -m).otherwise(m).alias("total"))
    return S.one_per_direction(new, history, [F.asc("total")]).select("order_no", "sku", "type", num("total").alias("total"))


@query("""
SELECT event_id, CASE WHEN contains(k,'Rechazo') THEN 'Rechazo' WHEN contains(k,'Siniestro') THEN 'Siniestro' ELSE k END AS type FROM (SELECT event_id, event_type||list_extract([' Rechazo total',' Siniestro OPL',''],1+CAST(event_id%3 AS INT)) AS k FROM events)
""")
def loss_types(t):
    words = F.get(F.array(F.lit(" Rechazo total"), F.lit(" Siniestro OPL"), F.lit("")), (F.col("event_id") % 3).cast("int"))
    e = t("events", "event_id", "event_type").select("event_id", F.concat("event_type", words).alias("type"))
    return S.classify_losses(e)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE l_returnflag='R' AND l_linestatus='F' AND l_shipdate>=TIMESTAMP '1998-01-01'
""")
def delivered_returns(t):
    l = t("lineitem", *_IDS, "l_returnflag", "l_linestatus", "l_shipdate").where(F.col("l_returnflag") == "R")
    rows = l.select(*_IDS, F.when(F.col("l_linestatus") == "F", "ENTREGADO").otherwise("EN RUTA").alias("refund_state"), F.col("l_shipdate").alias("sold_on"), F.col("l_suppkey").alias("seller"))
    return S.delivered_returns(rows, "1998-01-01").select(*_IDS)


_ST = f"""WITH a AS (SELECT strftime(l_shipdate,'%Y-%m') AS week, l_suppkey AS seller, CASE l_returnflag WHEN 'N' THEN 'Pago' WHEN 'R' THEN 'Descuento' ELSE 'Regularización' END AS concept, CASE WHEN l_returnflag='R' THEN -{_M} ELSE {_M} END AS amount FROM lineitem),
w AS (SELECT week, seller, SUM(CASE WHEN concept='Pago' THEN amount ELSE 0 END) AS payment, SUM(CASE WHEN concept='Descuento' THEN amount ELSE 0 END) AS discount, SUM(amount) AS settlement FROM a GROUP BY 1,2),
p AS (SELECT strftime(o_orderdate,'%Y-%m') AS week, o_custkey%{{n}} AS seller, o_orderkey AS document, CAST(o_totalprice AS DECIMAL(18,2)) AS paid FROM orders),
d AS (SELECT w.*, document, paid, ROW_NUMBER() OVER (PARTITION BY week, seller ORDER BY document) rn FROM w LEFT JOIN p USING (week, seller)),
k AS (SELECT seller, week, MAX(settlement) AS s, SUM(COALESCE(paid,0)) AS p, MAX(document) AS doc FROM d GROUP BY 1,2), r AS (SELECT *, SUM(s) OVER x AS st, SUM(p) OVER x AS pt FROM k WINDOW x AS (PARTITION BY seller ORDER BY week))"""


@query(_ST.replace("{n}", "100") + """ SELECT seller, week, document, CAST(CASE WHEN rn=1 THEN settlement ELSE 0 END AS DOUBLE) AS settlement, CAST(paid AS DOUBLE) AS paid, CAST(st AS DOUBLE) AS settled_total, CAST(pt AS DOUBLE) AS paid_total,
 CASE WHEN doc IS NULL AND st-pt<0 THEN 'NO CORRESPONDE PAGO - SALDOS PENDIENTES POR COBRAR' WHEN doc IS NULL AND st-pt>=0 AND s>0 THEN 'ERROR DE PAGO - COMUNICAR AL SELLER' ELSE 'PAGO REALIZADO' END AS comment FROM d JOIN r USING (seller, week)""")
def seller_statement(t):
    """Statement per seller and period with running totals and a comment."""
    l = t("lineitem", "l_suppkey", "l_returnflag", "l_extendedprice", "l_shipdate")
    m = money("l_extendedprice")
    back = F.col("l_returnflag") == "R"
    lines = l.select(
        F.date_format("l_shipdate", "yyyy-MM").alias("week"), F.col("l_suppkey").alias("seller"), F.when(F.col("l_returnflag") == "N", "Pago").when(back, "Descuento").otherwise("Regularización").alias("concept"), F.when(back, -m).otherwise(m).alias("amount"))
    o = t("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    paid = o.select(F.date_format("o_orderdate", "yyyy-MM").alias("week"), (F.col("o_custkey") % 100).alias("seller"), F.col("o_orderkey").alias("document"), money("o_totalprice").alias("paid"))
    out = S.seller_statement(lines, paid)
    return out.select("seller", "week", "document", *[num(c).alias(c) for c in ("settlement", "paid", "settled_total", "paid_total")], "comment")


_RF = f"""WITH s AS (SELECT l_suppkey AS seller, strftime(l_shipdate,'%Y-%m') AS week, l_returnflag='R' AS out, {_M} AS m, CAST(l_quantity AS DECIMAL(18,2)) AS q FROM lineitem),
a AS (SELECT seller, week, SUM(CASE WHEN NOT out THEN m ELSE 0 END) AS sales, SUM(CASE WHEN out THEN q ELSE 0 END) AS cr, SUM(CASE WHEN out THEN -m ELSE 0 END) AS ret, SUM(CASE WHEN NOT out THEN -1 ELSE 0 END) AS ship FROM s GROUP BY 1,2),
b AS (SELECT o_custkey%100 AS seller, strftime(o_orderdate,'%Y-%m') AS week, SUM(CASE WHEN o_orderstatus='F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS st, SUM(CASE WHEN o_orderstatus='F' THEN 200000 ELSE 0 END) AS pd, SUM(CASE WHEN o_orderstatus='O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS rf,
 SUM(CASE WHEN o_orderstatus='P' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS cc FROM orders GROUP BY 1,2),
j AS (SELECT COALESCE(a.seller,b.seller) AS seller, COALESCE(a.week,b.week) AS week, COALESCE(sales,0) sales, COALESCE(cr,0) cr, COALESCE(ret,0) ret, COALESCE(ship,0) ship, COALESCE(st,0) st, COALESCE(pd,0) pd, COALESCE(rf,0) rf, COALESCE(cc,0) cc FROM a FULL JOIN b ON a.seller=b.seller AND a.week=b.week),
k AS (SELECT *, COALESCE(SUM(st-pd) OVER (PARTITION BY seller ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS before FROM j)"""


@query(_RF + """ SELECT seller, week, CAST(CASE WHEN before<-1 THEN before ELSE 0 END AS DOUBLE) AS opening, CAST(sales+cr AS DOUBLE) AS orders_subtotal, CAST(ret+ship-cc AS DOUBLE) AS charges_subtotal, CAST(rf AS DOUBLE) AS refunds_subtotal,
 CAST(CASE WHEN before<-1 THEN before ELSE 0 END+sales+cr+ret+ship-cc+rf AS DOUBLE) AS closing, CAST(pd+rf AS DOUBLE) AS paid_total FROM k""")
def statement_rollforward(t):
    """Opening, orders, charges, refunds and closing balance per seller and period."""
    l = t("lineitem", "l_suppkey", "l_returnflag", "l_extendedprice", "l_shipdate", "l_quantity")
    m, out = money("l_extendedprice"), F.col("l_returnflag") == "R"
    zero = F.lit(0).cast("decimal(18,2)")
    settled = l.select(
        F.col("l_suppkey").alias("seller"), F.date_format("l_shipdate", "yyyy-MM").alias("week"), F.when(out, "Egreso").otherwise("Ingreso").alias("type"), F.when(out, -m).otherwise(m).alias("total"),
        (-F.col("l_quantity").cast("decimal(18,2)")).alias("commission"), F.when(out, zero).otherwise(F.lit(1).cast("decimal(18,2)")).alias("shipping"))
    o = t("orders", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    s, v = F.col("o_orderstatus"), money("o_totalprice")
    invoices = o.select(
        (F.col("o_custkey") % 100).alias("seller"), F.date_format("o_orderdate", "yyyy-MM").alias("week"), F.when(s == "F", "LIQUIDACIÓN").when(s == "O", "DEVOLUCIONES").otherwise("COMISIÓN").alias("concept"), v.alias("settled"),
        F.lit(200000).cast("decimal(18,2)").alias("paid"), v.alias("commission"), zero.alias("regularisation"), v.alias("refund"), zero.alias("adjustment"))
    res = S.statement_rollforward(settled, invoices)
    return res.select("seller", "week", *[num(c).alias(c) for c in ("opening", "orders_subtotal", "charges_subtotal", "refunds_subtotal", "closing", "paid_total")])


_TB = f"""WITH b AS (SELECT l_suppkey AS seller, l_orderkey AS order_no, l_linenumber AS folio, l_partkey%5 AS sku, l_returnflag AS f, l_linestatus AS s, {_M} AS m FROM lineitem),
c AS (SELECT seller, order_no, folio, sku, SUM(CASE WHEN f<>'R' THEN m ELSE 0 END) AS ing, SUM(CASE WHEN f='R' THEN -m ELSE 0 END) AS egr FROM b GROUP BY 1,2,3,4), t AS (SELECT seller, order_no, folio, sku, SUM(CASE WHEN f='A' THEN m ELSE 0 END) AS pago, SUM(CASE WHEN f='R' THEN -m ELSE 0 END) AS des FROM b WHERE s='F' GROUP BY 1,2,3,4),
j AS (SELECT c.*, COALESCE(pago,0) AS pago, COALESCE(des,0) AS des, ing+egr AS net, COALESCE(pago,0)+COALESCE(des,0) AS liq FROM c LEFT JOIN t USING (seller, order_no, folio, sku)),
k AS (SELECT *, CASE WHEN net<0 THEN -net WHEN liq<0 THEN -liq WHEN net<>liq THEN net-liq ELSE 0 END AS cxp, des-egr AS cxc FROM j), o AS (SELECT order_no, folio, sku, CASE WHEN COUNT(DISTINCT seller)=1 THEN 'OK' ELSE 'NOK' END AS observation FROM k GROUP BY 1,2,3)"""


def _transactions(t):
    l = t("lineitem", "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "l_extendedprice")
    m, back = money("l_extendedprice"), F.col("l_returnflag") == "R"
    rows = l.select(
        F.col("l_suppkey").alias("seller"), F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("folio"), (F.col("l_partkey") % 5).alias("sku"), F.when(back, "Egreso").otherwise("Ingreso").alias("type"), F.when(back, -m).otherwise(m).alias("total"), "l_returnflag", "l_linestatus")
    settled = rows.where((F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "N"))
    return S.transaction_balance(rows.drop("l_returnflag", "l_linestatus"), settled.drop("l_returnflag", "l_linestatus"))


@query(_TB + " SELECT seller, order_no, folio, sku, CAST(cxp AS DOUBLE) AS cxp, CAST(cxc AS DOUBLE) AS cxc, CAST(cxc-cxp AS DOUBLE) AS saldo, observation FROM k JOIN o USING (order_no, folio, sku)")
def transaction_balance(t):
    """Owed, due and balance per transaction; transactions of several owners are marked."""
    return _transactions(t).select("seller", "order_no", "folio", "sku", *[num(c).alias(c) for c in ("cxp", "cxc", "saldo")], "observation")


@query(_TB + " SELECT seller, order_no, folio, sku, CAST(ing AS DOUBLE) AS total FROM k WHERE ing>0 AND egr<0 AND pago=0 AND des<0 AND cxp>0 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey=order_no AND o_custkey%5=sku)")
def unjustified_discounts(t):
    """Lines discounted without ever having been paid."""
    done = t("orders", "o_orderkey", "o_custkey").select(F.col("o_orderkey").alias("order_no"), (F.col("o_custkey") % 5).alias("sku"), F.lit(1).alias("total"))
    return S.unjustified_discounts(_transactions(t), done).select("seller", "order_no", "folio", "sku", num("total").alias("total"))


@query(f"""
WITH r AS (SELECT *, {_M} AS m, CAST({_M}*CAST(l_tax*10 AS DECIMAL(4,1)) AS DECIMAL(18,2)) AS back FROM lineitem), s AS (SELECT l_orderkey, l_linenumber, l_partkey, MAX(m) AS tt, MAX(CAST(m/4 AS DECIMAL(18,2))) AS u FROM r WHERE l_linestatus='F' GROUP BY 1,2,3),
j AS (SELECT r.*, tt, abs(COALESCE(u, -back)) AS u1, CASE WHEN back>tt THEN tt ELSE back END AS b1 FROM r LEFT JOIN s USING (l_orderkey, l_linenumber, l_partkey)), k AS (SELECT *, CASE WHEN u1>b1 THEN u1 ELSE b1 END AS b2 FROM j),
q AS (SELECT *, CASE WHEN u1=0 THEN NULL ELSE CAST(b2 AS DOUBLE)/CAST(u1 AS DOUBLE) END AS n FROM k)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, floor(n)+CASE WHEN n-floor(n)<0.5 THEN 0 ELSE 1 END AS quantity FROM q WHERE n IS NOT NULL
""")
def capped_refunds(t):
    """Refunds held within their sale, in whole units."""
    l = t("lineitem", *_IDS, "l_tax", "l_linestatus")
    m = money("l_extendedprice")
    line = [F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("folio"), F.col("l_partkey").alias("sku")]
    back = (m * (F.col("l_tax") * 10).cast("decimal(4,1)")).cast("decimal(18,2)")
    refunds = l.select(*_IDS, *line, num(-back).alias("amount"))
    sold = l.where(F.col("l_linestatus") == "F").select(*line, num(m).alias("total"), num((m / 4).cast("decimal(18,2)")).alias("unit_price"))
    return S.cap_refund(refunds, sold).select(*_IDS, F.col("quantity").cast("double").alias("quantity"))


# lines of a collection file: every line is sold, those of flag R come back too, for too much or for 1.2 units
_COLLECTED = f"""WITH l AS (SELECT 'O'||CAST(l_orderkey AS VARCHAR) AS order_no, CAST(l_linenumber AS VARCHAR) AS folio, CAST(l_partkey AS VARCHAR) AS sku, CAST(l_suppkey%23 AS VARCHAR) AS seller, CAST(l_shipdate AS DATE) AS sold_on, l_returnflag AS f, l_linestatus AS st,
 l_partkey AS k, l_suppkey%7 AS w, CAST({_M}*0.002 AS DECIMAL(18,2)) AS total, CAST(CAST({_M}*0.001 AS DECIMAL(18,2)) AS DOUBLE) AS unit_price, CAST(CAST(CASE WHEN l_partkey%2=1 THEN {_M}*0.0030 ELSE {_M}*0.0012 END AS DECIMAL(18,2)) AS DOUBLE) AS back FROM lineitem),
s AS (SELECT order_no, folio, sku, CAST(MAX(total) AS DOUBLE) AS t, MAX(unit_price) AS u, MIN(sold_on) AS bought_on FROM l GROUP BY 1,2,3),
c1 AS (SELECT l.order_no, l.folio, l.sku, seller, sold_on, u, bought_on, back, CASE WHEN back>t THEN t ELSE back END AS b1 FROM l JOIN s USING (order_no, folio, sku) WHERE f='R'),
c2 AS (SELECT *, CASE WHEN u>b1 THEN u ELSE b1 END/u AS n, ROW_NUMBER() OVER (PARTITION BY order_no, folio, sku ORDER BY sold_on, seller, back DESC) AS rn FROM c1 WHERE u<>0),
c3 AS (SELECT order_no, folio, sku, seller, sold_on, bought_on, CAST(-(floor(n)+CASE WHEN n-floor(n)<0.5 THEN 0 ELSE 1 END)*u AS DECIMAL(18,2)) AS total FROM c2 WHERE rn=1),
rows AS (SELECT order_no, folio, sku, seller, sold_on, sold_on AS bought_on, total FROM l UNION ALL SELECT order_no, folio, sku, seller, sold_on, bought_on, total FROM c3),
one AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_no, folio, sku, total ORDER BY sold_on, seller) AS rn FROM rows) WHERE rn=1),
h AS (SELECT DISTINCT order_no, sku, total FROM l WHERE sold_on<DATE '1995-01-01' AND f='N'),
fr AS (SELECT * FROM one WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.order_no=one.order_no AND h.sku=one.sku AND h.total=one.total) AND NOT EXISTS (SELECT 1 FROM h WHERE h.order_no=one.order_no AND h.sku=one.sku AND (h.total>=0)=(one.total>=0))),
col AS (SELECT * EXCLUDE (rn, r2) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_no, sku, total>=0 ORDER BY sold_on, folio, total, seller) AS r2 FROM fr) WHERE r2=1)"""
_SETTLED = _COLLECTED + f""", z AS (SELECT CAST(p_partkey AS VARCHAR) AS sku, MAX(CASE p_type WHEN 'PROMO' THEN 'XXXS' WHEN 'SMALL' THEN 'M' WHEN 'LARGE' THEN 'XL' END) AS size FROM part GROUP BY 1),
pay AS (SELECT order_no, folio, sku, seller, sold_on, total, CAST(w AS DOUBLE)/100 AS rate, total*CAST(w AS DOUBLE)/100 AS commission, 1::DOUBLE AS shipping FROM l WHERE st='F'), com AS (SELECT order_no, folio, sku, MIN(rate) AS rate FROM pay GROUP BY 1,2,3),
g AS (SELECT col.*, -col.total AS back, COALESCE(size,'S') AS size, rate FROM col LEFT JOIN z USING (sku) LEFT JOIN com USING (order_no, folio, sku) WHERE col.total<0),
dis AS (SELECT *, total*rate AS commission, -(CASE WHEN bought_on>=DATE '1996-01-01' AND bought_on<DATE '1998-01-01' THEN {_case(vocab.TARIFF_1, 'back', 'size')} WHEN bought_on>=DATE '1998-01-01' THEN {_case(vocab.TARIFF_2, 'back', 'size')} ELSE 0::DOUBLE END) AS shipping FROM g),
both_ AS (SELECT 1 AS p, order_no, folio, sku, seller, sold_on, total, commission, shipping FROM pay UNION ALL SELECT 2, order_no, folio, sku, seller, sold_on, total, commission, shipping FROM dis),
k1 AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_no, sku, total ORDER BY p, sold_on, folio, seller) AS r1 FROM both_) WHERE r1=1),
liq AS (SELECT *, total-COALESCE(commission,0)-shipping AS payable FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_no, sku, total>=0 ORDER BY p, sold_on, folio, total, seller) AS r2 FROM k1) WHERE r2=1)"""


def _collected(t):
    """(sold lines, collection file) of all line items."""
    l = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_returnflag", "l_linestatus")
    c, m = F.col, money("l_extendedprice")
    share = lambda x: (m * F.lit(x).cast("decimal(5,4)")).cast("decimal(18,2)")
    sold = l.select(
        F.concat(F.lit("O"), c("l_orderkey").cast("string")).alias("order_no"), c("l_linenumber").cast("string").alias("folio"), c("l_partkey").cast("string").alias("sku"), (c("l_suppkey") % 23).cast("string").alias("seller"),
        F.to_date("l_shipdate").alias("sold_on"), "l_returnflag", "l_linestatus", (c("l_suppkey") % 7).alias("w"), share("0.0020").alias("total"), num(share("0.0010")).alias("unit_price"), num(-F.when(c("l_partkey") % 2 == 1, share("0.0030")).otherwise(share("0.0012"))).alias("amount"))
    ids = ["order_no", "folio", "sku", "seller", "sold_on"]
    amounts = sold.withColumn("total", num("total"))
    back = S.refund_lines(amounts.where(c("l_returnflag") == "R").select(*ids, "amount"), amounts.select(*ids, "total", "unit_price"))
    income = sold.select(*ids, c("sold_on").alias("bought_on"), "total")
    outflow = back.select(*ids, "bought_on", money("amount").alias("total"))
    before = sold.where((c("sold_on") < F.lit("1995-01-01").cast("date")) & (c("l_returnflag") == "N")).select("order_no", "sku", "total")
    return sold, S.collected_lines(income, outflow, before)


def _settled(t):
    """(payments, collection file, discounts, settled lines)."""
    sold, collected = _collected(t)
    c, kind, rate = F.col, F.col("p_type"), F.col("w").cast("double") / 100
    sizes = t("part", "p_partkey", "p_type").select(c("p_partkey").cast("string").alias("sku"), F.when(kind == "PROMO", "XXXS").when(kind == "SMALL", "M").when(kind == "LARGE", "XL").alias("size"))
    payments = sold.where(c("l_linestatus") == "F").select("order_no", "folio", "sku", "seller", "sold_on", "total", rate.alias("rate"), (c("total") * c("w").cast("double") / 100).alias("commission"), F.lit(1.0).alias("shipping"))
    tariffs = [("1996-01-01", "1998-01-01", vocab.TARIFF_1), ("1998-01-01", None, vocab.TARIFF_2)]
    refunded = S.discounts(collected, payments, sizes, tariffs)
    return payments, collected, refunded, S.settled_lines(payments, refunded)


@query(_COLLECTED + " SELECT order_no, folio, sku, seller, strftime(sold_on,'%Y-%m-%d') AS sold_on, strftime(bought_on,'%Y-%m-%d') AS bought_on, CAST(total AS DOUBLE) AS total, CASE WHEN total>=0 THEN 'Ingreso' ELSE 'Egreso' END AS type FROM col")
def collected_lines(t):
    """Sales and refunds that earlier collection files do not hold."""
    out = _collected(t)[1]
    return out.select("order_no", "folio", "sku", "seller", day("sold_on").alias("sold_on"), day("bought_on").alias("bought_on"), num("total").alias("total"), "type")


@query(_SETTLED + " SELECT order_no, folio, sku, seller, size, CAST(total AS DOUBLE) AS total, rate, commission, shipping FROM dis")
def settled_refunds(t):
    """Refunds of a settlement with the commission and shipping that go back."""
    return _settled(t)[2].select("order_no", "folio", "sku", "seller", "size", num("total").alias("total"), "rate", "commission", "shipping")


@query(_SETTLED + " SELECT order_no, folio, sku, seller, CAST(total AS DOUBLE) AS total, commission, shipping, payable, CASE WHEN total>=0 THEN 'Ingreso' ELSE 'Egreso' END AS type FROM liq")
def settled_lines(t):
    """Payments and refunds of a settlement, one of each direction per order and sku."""
    return _settled(t)[3].select("order_no", "folio", "sku", "seller", num("total").alias("total"), "commission", "shipping", "payable", "type")


@query(_SETTLED + """ SELECT 'payable' AS label, CAST(SUM(total) AS DOUBLE) AS total FROM pay UNION ALL SELECT 'settled_in', CAST(SUM(total) AS DOUBLE) FROM liq WHERE total>0 UNION ALL SELECT 'collected_in', CAST(SUM(total) AS DOUBLE) FROM col WHERE total>0
 UNION ALL SELECT 'collected_out', CAST(SUM(total) AS DOUBLE) FROM col WHERE total<0 UNION ALL SELECT 'settled_out', CAST(SUM(total) AS DOUBLE) FROM liq WHERE total<0""")
def settlement_totals(t):
    """Control totals of a settlement, in and out."""
    payments, collected, _, settled = _settled(t)
    return S.settlement_totals(payments, collected, settled)


@query("""
WITH d AS (SELECT DISTINCT l_orderkey AS n FROM lineitem), g AS (SELECT n, LEAD(n) OVER (ORDER BY n) AS nx FROM d), m AS (SELECT unnest(range(n+1,nx)) AS n FROM g WHERE nx-n>1)
SELECT 'F001' AS series, n AS number, 'F001-'||CAST(n AS VARCHAR) AS folio, o_custkey AS payer FROM m LEFT JOIN orders ON o_orderkey=n
""")
def document_gaps(t):
    """Missing documents of a series with what a second ledger knows of them."""
    docs = t("lineitem", "l_orderkey").select(F.concat(F.lit("F001-"), F.col("l_orderkey").cast("string"), F.lit(".0")).alias("folio"))
    ledger = t("orders", "o_orderkey", "o_custkey").select(F.concat(F.lit("F001-"), F.col("o_orderkey").cast("string")).alias("folio"), F.col("o_custkey").alias("payer"))
    return A.sequence_gap_audit(docs, ledger, width=5000).select("series", "number", "folio", "payer")


_WORDS = ["Shipping Fee x", "commission", "mktg plan", "odd"]
_WH = """WITH d AS (SELECT strftime(l_shipdate,'%Y-%m') AS period, l_suppkey AS payer, CAST(l_orderkey AS VARCHAR)||'/'||CAST(l_suppkey AS VARCHAR)||strftime(l_shipdate,'/%Y-%m') AS doc, CAST(l_extendedprice AS DECIMAL(18,2)) AS total, l_partkey%4 AS w FROM lineitem WHERE l_suppkey NOT IN (5)),
r AS (SELECT *, CASE w WHEN 0 THEN 0.10 WHEN 1 THEN 0.12 WHEN 2 THEN 0.04 END AS rate FROM d), x AS (SELECT period, payer, doc, MAX(total) AS total, MAX(rate) AS rate FROM r GROUP BY 1,2,3), p AS (SELECT period, payer FROM x GROUP BY 1,2 HAVING SUM(total)>=500000)"""


@query(_WH + " SELECT period, payer, doc, CAST(total AS DOUBLE) AS total, CAST(rate AS DOUBLE) AS rate, CASE rate WHEN 0.10 THEN 'c1' WHEN 0.12 THEN 'c2' WHEN 0.04 THEN 'c3' END AS code, CAST(round_even(total*rate,0) AS DOUBLE) AS withheld FROM x JOIN p USING (period, payer)")
def withholding(t):
    """Withholding per document of payers above the minimum."""
    l = t("lineitem", "l_suppkey", "l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate")
    words = F.get(F.array(*[F.lit(w) for w in _WORDS]), (F.col("l_partkey") % 4).cast("int"))
    docs = l.select(
        F.date_format("l_shipdate", "yyyy-MM").alias("period"), F.col("l_suppkey").alias("payer"), F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string"), F.date_format("l_shipdate", "yyyy-MM")).alias("doc"),
        words.alias("description"), money("l_extendedprice").alias("total"))
    concepts = t.spark.createDataFrame([("Shipping Fee", "c1", "0.10"), ("Commission", "c2", "0.12"), ("Mktg", "c3", "0.04")], "concept string, code string, rate string").withColumn("rate", F.col("rate").cast("decimal(4,2)"))
    out = A.withholding(docs.withColumn("payer", F.col("payer").cast("string")), concepts, 500_000, ["5"])
    return out.select("period", F.col("payer").cast("bigint").alias("payer"), "doc", num("total").alias("total"), num("rate").alias("rate"), "code", num("withheld").alias("withheld"))


@query("""
WITH q AS (SELECT (l_orderkey*8+l_linenumber)*1000000000+ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS request_id, l_orderkey, l_linenumber, CASE WHEN l_suppkey%2=0 THEN 'Commission Adjustment' ELSE 'Commission Credit Adjustment' END AS g,
 'SC'||lpad(CAST(l_suppkey%50 AS VARCHAR),CASE WHEN l_partkey%9=0 THEN 4 ELSE 5 END,'0') AS seller, CAST(l_extendedprice/50 AS DECIMAL(18,2)) AS amount, l_returnflag FROM lineitem),
p AS (SELECT l_orderkey, l_linenumber, COUNT(CASE WHEN g='Commission Adjustment' THEN 1 END) AS d, COUNT(CASE WHEN g<>'Commission Adjustment' THEN 1 END) AS c FROM q GROUP BY 1,2), h AS (SELECT o_orderkey, o_orderstatus, 'SC'||lpad(CAST(o_custkey%50 AS VARCHAR),5,'0') AS s FROM orders)
SELECT request_id, CASE WHEN d=1 AND c=1 THEN 'Si' ELSE 'No' END AS check_pair, CASE WHEN o_orderstatus='F' THEN 'No' ELSE 'Si' END AS check_return, CASE WHEN o_orderstatus='O' THEN 'No' ELSE 'Si' END AS check_adjustment,
 CASE WHEN regexp_matches(seller,'^SC') AND length(seller)=7 THEN 'Si' ELSE 'No' END AS check_seller_id, CASE WHEN seller=COALESCE(s,seller) THEN 'Si' ELSE 'No' END AS check_seller, CASE WHEN amount<1000 THEN 'Si' ELSE 'No' END AS check_amount FROM q JOIN p USING (l_orderkey, l_linenumber) LEFT JOIN h ON o_orderkey=l_orderkey
""")
def adjustment_checks(t):
    """Checks of requested adjustments against past transactions."""
    l = t("lineitem", *_IDS)
    rows = with_sequence(l, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"], "n", F.floor(F.col("l_partkey") / 500))
    requests = rows.select(
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000_000 + F.col("n")).alias("request_id"), F.col("l_orderkey").alias("order_id"), F.lit("s").alias("sku"), F.col("l_linenumber").alias("item_id"),
        F.when(F.col("l_suppkey") % 2 == 0, "Commission Adjustment").otherwise("Commission Credit Adjustment").alias("group"),
        F.concat(F.lit("SC"), F.when(F.col("l_partkey") % 9 == 0, F.lpad((F.col("l_suppkey") % 50).cast("string"), 4, "0")).otherwise(F.lpad((F.col("l_suppkey") % 50).cast("string"), 5, "0"))).alias("seller_id"),
        (F.col("l_extendedprice") / 50).cast("decimal(18,2)").alias("amount"))
    o = t("orders", "o_orderkey", "o_custkey", "o_orderstatus")
    past = o.select(
        F.col("o_orderkey").alias("order_id"), F.lit("s").alias("sku"), F.col("o_orderkey").alias("line_id"), F.concat(F.lit("SC"), F.lpad((F.col("o_custkey") % 50).cast("string"), 5, "0")).alias("seller_id"), F.lit("COMMISSION").alias("kind"), F.lit(1.0).alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "Si").otherwise("No").alias("returned"), F.when(F.col("o_orderstatus") == "O", "Si").otherwise("No").alias("adjusted"))
    out = A.validate_adjustments(requests, past)
    return out.select("request_id", "check_pair", "check_return", "check_adjustment", "check_seller_id", "check_seller", "check_amount")


@query("""
WITH p AS (SELECT ROW_NUMBER() OVER (ORDER BY o_orderkey) AS ordinal, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS m FROM orders)
SELECT 0 AS ordinal, 'P20123456789EMPRESA240001'||lpad(CAST(CAST(SUM(m)*100 AS BIGINT) AS VARCHAR),15,'0') AS line FROM p
UNION ALL SELECT ordinal, '6'||lpad(CAST(o_orderkey AS VARCHAR),11,'0')||'0000000'||'000000000'||'037'||'00012345678'||lpad(CAST(CAST(m*100 AS BIGINT) AS VARCHAR),15,'0')||'01'||'202406'||'01'||'F001'||lpad(CAST(o_orderkey AS VARCHAR),8,'0') FROM p
""")
def deposit_file(t):
    """Header and detail records of a fixed-width deposit file."""
    o = t("orders", "o_orderkey", "o_totalprice")
    rows = with_row_id(o, ["o_orderkey"], F.floor(F.col("o_orderkey") / 1000), "ordinal").select(
        "ordinal", F.lit("6").alias("doc_type"), F.col("o_orderkey").alias("doc_number"), F.lit("000000000").alias("proforma"), F.lit("037").alias("service"), F.col("o_totalprice").alias("amount"), F.lit("01").alias("operation"),
        F.lit("202406").alias("period"), F.lit("01").alias("voucher_type"), F.lit("F001").alias("series"), F.col("o_orderkey").alias("number"))
    header, details = A.withholding_lines(rows, "20123456789EMPRESA", "240001", "00012345678")
    return with_header(header, details).select("ordinal", "line")
