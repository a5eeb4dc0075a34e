"""Order, backlog, balance and returns jobs on the shared tables."""

from pyspark.sql import functions as F

from .. import vocab
from ..operators.rules import case_first
from ..plans import backlog as B
from ..plans import balance as L
from ..plans import orders as O
from ..plans import returns as R
from ..sources.readers import literal_table
from .registry import money, num, query, stamp

_STATES = {"signup": "handled_by_marketplace", "view": "ready_to_ship", "click": "shipped", "purchase": "delivered", "error": "canceled"}


def _state_sql(c):
    return "CASE " + " ".join(f"WHEN {c}='{k}' THEN '{v}'" for k, v in _STATES.items()) + " END"


@query(f"""
WITH h AS (SELECT user_id, event_id, ts, value, {_state_sql('event_type')} AS s FROM events), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM h),
w AS (SELECT user_id, MAX(CASE WHEN rn=1 THEN s END) AS status, MAX(CASE WHEN rn=2 THEN s END) AS prev_status, MIN(ts) AS created,
 MAX(CASE WHEN s='ready_to_ship' THEN ts END) AS rts, MAX(CASE WHEN s='shipped' THEN ts END) AS shp, MIN(CASE WHEN s='delivered' THEN ts END) AS del FROM r GROUP BY 1)
SELECT user_id AS order_id, status, prev_status, strftime(created,'%Y-%m-%d %H:%M:%S') AS created_at, strftime(rts,'%Y-%m-%d %H:%M:%S') AS ready_to_ship, strftime(shp,'%Y-%m-%d %H:%M:%S') AS shipped_at,
 strftime(del,'%Y-%m-%d %H:%M:%S') AS terminated_at FROM w
""")
def order_timeline(t):
    """States, the state before, and milestones of each order."""
    e = t("events", "user_id", "event_id", "event_type", "ts")
    items = e.select(
        F.col("user_id").alias("order_id"), F.col("event_id").alias("item_id"), F.lit("FBS").alias("shipping_type"), F.lit(None).cast("timestamp_ntz").alias("created_at"), F.col("ts").alias("target_to_ship"))
    first = e.groupBy(F.col("user_id").alias("order_id")).agg(F.min("ts").alias("_c"))
    history = e.select(F.col("event_id").alias("item_id"), F.col("event_type").alias("status_id"), "ts")
    statuses = e.select(F.col("event_type").alias("status_id")).distinct().withColumn("status", case_first([(F.col("status_id") == k, v) for k, v in _STATES.items()]))
    out = O.order_timeline(items, history, statuses).join(first, "order_id")
    return out.select(
        "order_id", "status", "prev_status", stamp("_c").alias("created_at"), stamp("ready_to_ship").alias("ready_to_ship"), stamp("shipped_at").alias("shipped_at"), stamp("terminated_at").alias("terminated_at"))


@query("""
WITH f AS (SELECT user_id AS tracking, event_type AS state, ts, event_id FROM events WHERE event_type<>'error'),
l AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY tracking ORDER BY ts DESC, state DESC) rn FROM f) WHERE rn=1), o AS (SELECT user_id AS tracking, 'lost' AS state FROM events WHERE event_type='error' GROUP BY 1)
SELECT l.tracking, COALESCE(o.state,l.state) AS state, strftime(l.ts,'%Y-%m-%d %H:%M:%S') AS ts FROM l LEFT JOIN o USING (tracking)
""")
def merged_tracking(t):
    """Newest state over two carriers' feeds; a third source overrides it."""
    e = t("events", "user_id", "event_type", "ts", "value").withColumnsRenamed({"user_id": "tracking", "event_type": "state"})
    feeds = [e.where(F.col("state").isin("view", "click")).drop("value"), e.where(F.col("state").isin("signup", "purchase")).drop("value")]
    lost = e.where(F.col("state") == "error").groupBy("tracking").agg(F.lit("lost").alias("state"))
    return O.merge_tracking(feeds, overrides=lost).select("tracking", "state", stamp("ts").alias("ts"))


_AS_OF = "1998-06-15"
_BL = """SELECT o_orderkey AS order_id, o_custkey AS seller_id, 'T'||CAST(o_orderkey AS VARCHAR) AS tracking_code, CASE WHEN o_orderstatus='F' THEN 'ready_to_ship' ELSE 'pending' END AS status,
 CASE o_orderkey%3 WHEN 0 THEN 'ibis' WHEN 1 THEN 'urbano' ELSE 'other' END AS carrier, CAST(o_orderkey%5 AS BIGINT) AS shipment_type, DATE '1998-06-15'-CAST(o_orderkey%9-3 AS INT) AS target,
 o_orderdate AS updated_at, CASE WHEN o_orderpriority='1-URGENT' THEN 'Anulado' WHEN o_orderpriority='5-LOW' THEN NULL ELSE 'En Ruta' END AS state FROM orders"""
_BL_REPORT = f"""WITH b AS ({_BL}), s AS (SELECT c_custkey AS seller_id, CASE WHEN c_mktsegment='BUILDING' THEN 'AAA' ELSE 'Longtail' END AS segment, CASE WHEN c_custkey%10=0 THEN 'none' ELSE 's'||CAST(c_custkey AS VARCHAR)||'@example.org' END AS email,
 CASE WHEN c_custkey%4=0 THEN 'P1' END AS dropoff FROM customer),
a AS (SELECT b.*, DATE '1998-06-15'-target AS late FROM b WHERE carrier IN ('ibis','urbano') AND shipment_type<>1 AND updated_at<=TIMESTAMP '1998-06-14 22:00:00' AND state NOT IN ('Anulado','Retorno a seller') AND seller_id NOT IN (1,2,3)),
k AS (SELECT *, CASE WHEN late=3 THEN 'Comunicar 3er refuerzo' WHEN late=2 THEN 'Comunicar 2do refuerzo' WHEN late=1 THEN 'Comunicar 1er refuerzo' WHEN late=0 THEN 'A tiempo' ELSE 'x' END AS action FROM a),
r AS (SELECT * FROM k WHERE action<>'x'), g AS (SELECT seller_id, COUNT(DISTINCT status) AS d, SUM(CASE WHEN status='ready_to_ship' THEN 1 ELSE 0 END) AS rts, COUNT(*) AS n, COUNT(CASE WHEN status='pending' THEN 1 END) AS p FROM r GROUP BY 1),
z AS (SELECT r.order_id, r.seller_id, r.status, r.action, CAST(r.late AS BIGINT) AS days_late, CASE WHEN d=2 THEN 'Speech_2' WHEN d=1 AND rts>0 THEN 'Speech_3' WHEN n=p THEN 'Speech_4' ELSE 'Otro caso' END AS speech, s.segment, s.email, s.dropoff,
 CASE WHEN s.dropoff IS NOT NULL THEN 'dropoff' ELSE r.carrier END AS carrier, CASE action WHEN 'A tiempo' THEN 'A tiempo' WHEN 'Comunicar 1er refuerzo' THEN '1 dia de retraso' WHEN 'Comunicar 2do refuerzo' THEN '2 dias de retraso' ELSE '3 dias de retraso' END AS delay_text
 FROM r JOIN g USING (seller_id) LEFT JOIN s USING (seller_id))"""


def _backlog(t, slot="am"):
    o = t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    rows = o.select(
        k.alias("order_id"), F.col("o_custkey").alias("seller_id"), F.concat(F.lit("T"), k.cast("string")).alias("tracking_code"), F.lit("ready_to_ship").alias("src_status"),
        F.when(F.col("o_orderstatus") == "F", "ready_to_ship").otherwise("pending").alias("status"), F.when(k % 3 == 0, "ibis").when(k % 3 == 1, "urbano").otherwise("other").alias("carrier"),
        (k % 5).alias("shipment_type"), F.date_sub(F.lit(_AS_OF).cast("date"), (k % 9 - 3).cast("int")).alias("target_to_ship"), F.col("o_orderdate").alias("updated_at"))
    tracking = o.select(F.concat(F.lit("T"), k.cast("string")).alias("tracking_code"), F.when(F.col("o_orderpriority") == "1-URGENT", "Anulado").when(F.col("o_orderpriority") != "5-LOW", "En Ruta").alias("state"))
    c = F.col("c_custkey")
    sellers = t("customer", "c_custkey", "c_mktsegment").select(
        c.alias("seller_id"), F.when(F.col("c_mktsegment") == "BUILDING", "AAA").otherwise("Longtail").alias("segment"),
        F.when(c % 10 == 0, "none").otherwise(F.concat(F.lit("s"), c.cast("string"), F.lit("@example.org"))).alias("email"), F.lit(None).cast("string").alias("phone"), F.when(c % 4 == 0, "P1").alias("dropoff"))
    return B.backlog_report(rows, tracking, sellers, literal_table(t.spark, [1, 2, 3], "seller_id", "bigint"), _AS_OF, slot=slot)


@query(_BL_REPORT + " SELECT order_id, seller_id, status, action, days_late, speech, segment, carrier, delay_text FROM z")
def backlog_report(t):
    """Late orders with the action due and the seller's text segment."""
    return _backlog(t).select("order_id", "seller_id", "status", "action", F.col("days_late").cast("bigint").alias("days_late"), "speech", "segment", "carrier", "delay_text")


_PM = """, h AS (SELECT seller_id, COUNT(CASE WHEN segment<>'AAA' THEN 1 END)>0 AS other, COUNT(DISTINCT segment)=1 AND COUNT(DISTINCT status)>1 AS mixed, COUNT(*)=COUNT(CASE WHEN status='pending' THEN 1 END) AS pend FROM z GROUP BY 1),
y AS (SELECT z.* REPLACE (CASE WHEN other THEN 'Speech_3' WHEN mixed THEN 'Speech_2' WHEN pend THEN 'Speech_4' ELSE 'Otro caso' END AS speech) FROM z JOIN h USING (seller_id))"""


@query(_BL_REPORT + _PM + " SELECT order_id, seller_id, status, action, speech, segment, delay_text FROM y")
def backlog_afternoon(t):
    """The afternoon report: same orders, text by segment first."""
    return _backlog(t, "pm").select("order_id", "seller_id", "status", "action", "speech", "segment", "delay_text")


@query(_BL_REPORT + " SELECT 'mail_pending' AS campaign, seller_id, COUNT(DISTINCT order_id) AS orders, COUNT(*) AS lines FROM z WHERE status='pending' AND email LIKE '%@%' GROUP BY 2")
def afternoon_audience(t):
    return B.alert_audiences(B.alert_rows(_backlog(t, "pm"), B.afternoon_rules()), "seller_id", "order_id")


_CAMPAIGNS = """c AS (SELECT *, unnest(list_filter([CASE WHEN segment='AAA' AND carrier<>'dropoff' THEN 'mail_top' END, CASE WHEN segment<>'AAA' AND speech='Speech_2' AND carrier<>'dropoff' THEN 'mail_route_delay_pending' END,
 CASE WHEN segment<>'AAA' AND speech='Speech_3' AND carrier<>'dropoff' THEN 'mail_route_delay' END, CASE WHEN segment<>'AAA' AND speech='Speech_4' THEN 'mail_pending' END, CASE WHEN segment<>'AAA' AND carrier='dropoff' THEN 'mail_dropoff' END,
 CASE WHEN segment='AAA' AND carrier='dropoff' AND status<>'pending' THEN 'mail_top_dropoff' END, CASE WHEN segment='AAA' AND carrier<>'dropoff' AND delay_text<>'A tiempo' THEN 'chat_top_delay' END], lambda x: x IS NOT NULL)) AS campaign FROM z WHERE email LIKE '%@%')"""


@query(_BL_REPORT + ", " + _CAMPAIGNS + " SELECT campaign, seller_id, COUNT(DISTINCT order_id) AS orders, COUNT(*) AS lines FROM c GROUP BY 1,2 HAVING COUNT(DISTINCT order_id)>=2")
def campaign_audience(t):
    """Sellers of each campaign that have at least two orders to be told about."""
    return B.alert_audiences(B.alert_rows(_backlog(t), B.campaign_rules()), "seller_id", "order_id", 2)


@query(_BL_REPORT + ", " + _CAMPAIGNS + " SELECT campaign, seller_id, string_agg(CAST(order_id AS VARCHAR),',' ORDER BY order_id) AS orders FROM c GROUP BY 1,2")
def campaign_payload(t):
    """Order list of each message; pages are put together here only because lists are short."""
    rows = B.alert_rows(_backlog(t), B.campaign_rules())
    audience = B.alert_audiences(rows, "seller_id", "order_id")
    pages = B.alert_payload(rows, audience, "seller_id", ["order_id", "delay_text"])
    ids = F.array_join(F.transform("rows", lambda r: r["order_id"].cast("string")), ",")
    return pages.select("campaign", "seller_id", ids.alias("orders"))


@query("SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1 HAVING SUM(CAST(o_totalprice AS DECIMAL(18,2)))>3000000")
def amount_alerts(t):
    o = t("orders", "o_custkey", "o_totalprice").withColumn("m", money("o_totalprice"))
    return B.amount_alerts(o, "o_custkey", "m", 3_000_000).withColumn("total", num("total"))


_KPI = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE l_suppkey%3 WHEN 0 THEN 'FBS' WHEN 1 THEN 'FBF' ELSE 'XD' END AS st, CASE WHEN l_partkey%4=0 THEN 'courier internacional' ELSE 'ibis' END AS carrier,
 CASE WHEN l_partkey%5=0 THEN 'ABCDEFGHIJK' ELSE 'AB' END AS trk, o_orderdate AS created, o_orderdate + to_days(CAST(l_suppkey%6 AS INT)) AS target, CASE WHEN l_partkey%7<>0 THEN o_orderdate+to_days(CAST(l_partkey%9 AS INT)) END AS rts,
 CASE WHEN l_linestatus='F' THEN l_shipdate END AS shipped, CASE l_returnflag WHEN 'R' THEN 'canceled' WHEN 'A' THEN 'delivered' ELSE 'returned' END AS ost,
 CASE l_partkey%6 WHEN 0 THEN 'Siniestro' WHEN 1 THEN 'Entregado' WHEN 2 THEN 'Retorno A Seller' ELSE 'En Ruta' END AS tms, CASE l_suppkey%5 WHEN 0 THEN 'DELIVERED' WHEN 1 THEN 'CANCELLED' WHEN 2 THEN 'IN_TRANSIT' WHEN 3 THEN 'ODD' END AS cat,
 CASE WHEN l_suppkey%7=0 THEN 'DELIVERED' END AS bs, l_shipdate AS tms_time, CASE WHEN l_partkey%13=0 THEN 'R1' END AS rlo, CAST(l_partkey%3 AS BIGINT) AS visits FROM lineitem JOIN orders ON l_orderkey=o_orderkey"""


@query(f"""
WITH k AS ({_KPI})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN st<>'FBS' THEN 1 WHEN carrier='courier internacional' THEN 1 WHEN length(trk)>10 THEN 1 ELSE 0 END AS printed, CASE WHEN st='FBS' AND rts IS NULL THEN 0 ELSE 1 END AS readied,
 CASE WHEN visits>1 THEN 1 ELSE 0 END AS not_collected, CASE WHEN st<>'FBF' AND date_diff('day',created,target)<1 THEN 1 ELSE 0 END AS error_dts, CASE WHEN shipped IS NOT NULL THEN 1 ELSE 0 END AS shipped,
 CASE WHEN st='FBS' AND shipped>=target-INTERVAL 7 DAY THEN 0 WHEN shipped IS NULL THEN 0 ELSE 1 END AS advanced, CASE WHEN st='FBS' AND (shipped>=target OR rts>=target) THEN 1 ELSE 0 END AS delayed,
 CASE WHEN date_diff('day',tms_time,DATE '1999-01-01')>=2 AND ost NOT IN ('delivered','canceled','returned') AND date_diff('day',target,DATE '1999-01-01')>=1 THEN 1 ELSE 0 END AS not_moving,
 CASE WHEN ost='canceled' THEN 1 ELSE 0 END AS canceled, CASE WHEN tms='Retorno A Seller' THEN 1 ELSE 0 END AS rejected, CASE WHEN (ost IN ('canceled','returned') AND shipped IS NOT NULL) OR rlo IS NOT NULL THEN 1 ELSE 0 END AS returned,
 CASE WHEN tms='Siniestro' OR (tms='Entregado' AND (cat='CANCELLED' OR ost='canceled')) OR (bs='DELIVERED' AND (cat='CANCELLED' OR ost='canceled')) OR (ost='canceled' AND cat='DELIVERED') THEN 1 ELSE 0 END AS lost,
 CASE WHEN cat='DELIVERED' THEN 'delivered' WHEN cat='CANCELLED' THEN 'canceled' WHEN cat='IN_TRANSIT' OR cat IS NULL THEN 'in_progress' WHEN ost='returned' THEN 'returned' END AS status FROM k
""")
def order_kpis(t):
    """Flags of every order line: late, lost, returned and the rest."""
    l = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus")
    r = l.join(t("orders", "o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    s, p = F.col("l_suppkey"), F.col("l_partkey")
    days = lambda c, n: F.col("o_orderdate") + F.make_dt_interval(days=(c % n).cast("int"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    line = r.select(
        *keys, F.when(s % 3 == 0, "FBS").when(s % 3 == 1, "FBF").otherwise("XD").alias("shipping_type"), F.when(p % 4 == 0, "courier internacional").otherwise("ibis").alias("carrier"),
        F.when(p % 5 == 0, "ABCDEFGHIJK").otherwise("AB").alias("tracking_code"), F.lit(0).alias("printed"), F.col("o_orderdate").alias("created_at"), days(s, 6).alias("target_to_ship"), F.lit(None).cast("date").alias("planned_at"),
        F.when(p % 7 != 0, days(p, 9)).alias("ready_to_ship"), F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("shipped_at"), (p % 3).alias("visits"), F.when(p % 13 == 0, "R1").alias("rlo_id"),
        F.when(F.col("l_returnflag") == "R", "canceled").when(F.col("l_returnflag") == "A", "delivered").otherwise("returned").alias("status_order"),
        F.when(p % 6 == 0, "Siniestro").when(p % 6 == 1, "Entregado").when(p % 6 == 2, "Retorno A Seller").otherwise("En Ruta").alias("status_tms"),
        F.when(s % 5 == 0, "DELIVERED").when(s % 5 == 1, "CANCELLED").when(s % 5 == 2, "IN_TRANSIT").when(s % 5 == 3, "ODD").alias("status_platform"), F.when(s % 7 == 0, "DELIVERED").alias("status_store"), F.col("l_shipdate").alias("tms_time"))
    out = O.order_kpis(line, "1999-01-01")
    return out.select(*keys, "printed", "readied", "not_collected", "error_dts", "shipped", "advanced", "delayed", "not_moving", "canceled", "rejected", "returned", "lost", "status")


_M = "CAST(l_extendedprice AS DECIMAL(18,2))"
_BAL = f"""WITH e AS (SELECT l_suppkey AS seller_id, l_orderkey AS order_id, l_partkey AS sku, {_M} AS m, l_returnflag AS f, l_linestatus AS s, l_shipdate AS d, l_linenumber AS ln FROM lineitem),
debe AS (SELECT seller_id, order_id, sku, COALESCE(SUM(CASE WHEN f<>'R' THEN m END),0) AS ing, COALESCE(-abs(SUM(CASE WHEN f='R' THEN m END)),0) AS egr, CAST(MAX(CASE WHEN f<>'R' THEN d END) AS DATE) AS fi, CAST(MAX(CASE WHEN f='R' THEN d END) AS DATE) AS fe FROM e GROUP BY 1,2,3),
debe2 AS (SELECT seller_id, order_id, sku, greatest(ing,-egr) AS ing, egr, fi, fe FROM debe),
st AS (SELECT DISTINCT seller_id, order_id, sku, CASE WHEN f='N' THEN 'ITEM_PRICE_CREDIT' WHEN f='R' THEN 'ITEM_PRICE' ELSE 'COMMISSION' END AS k, d, CAST(CAST(CASE WHEN s='F' THEN m ELSE m*0.5 END*100 AS BIGINT) AS DOUBLE)/100 AS total FROM e),
hab AS (SELECT seller_id, order_id, sku, COALESCE(SUM(CASE WHEN k='ITEM_PRICE_CREDIT' THEN total END),0) AS pago, COALESCE(-SUM(CASE WHEN k='ITEM_PRICE' THEN total END),0) AS des, COALESCE(SUM(CASE WHEN k='COMMISSION' THEN total END),0) AS com FROM st GROUP BY 1,2,3),
ord AS (SELECT order_id, sku, COUNT(sku) AS items, SUM(m) AS value FROM (SELECT DISTINCT order_id, ln, sku, m FROM e) GROUP BY 1,2),
j AS (SELECT seller_id, order_id, sku, fi, fe, items, CAST(value AS DOUBLE) AS value, round(CAST(least(ing,value) AS DOUBLE),2) AS ing, round(CAST(CASE WHEN abs(egr)>value THEN -value ELSE egr END AS DOUBLE),2) AS egr, round(COALESCE(pago,0),2) AS pago, round(COALESCE(des,0),2) AS des, com
 FROM debe2 LEFT JOIN hab USING (seller_id, order_id, sku) LEFT JOIN ord USING (order_id, sku)),
p AS (SELECT * REPLACE (CASE WHEN des<0 AND pago=0 THEN ing ELSE pago END AS pago) FROM j), q AS (SELECT * REPLACE (least(pago,ing) AS pago, CASE WHEN abs(des)>abs(egr) THEN egr ELSE des END AS des) FROM p),
u AS (SELECT * REPLACE (CAST(round(CAST(CASE WHEN egr/(value/items)<>ceil(egr/(value/items)) THEN ceil(egr/(value/items))*(value/items) ELSE egr END AS DECIMAL(18,6)),2) AS DOUBLE) AS egr) FROM q),
b AS (SELECT *, round(ing+egr-(pago+des),2) AS saldo FROM u)"""


def _balance(t):
    l = t("lineitem", "l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    c, m = F.col, money("l_extendedprice")
    key = [c("l_suppkey").alias("seller_id"), c("l_orderkey").alias("order_id"), c("l_partkey").alias("sku")]
    back = c("l_returnflag") == "R"
    events = l.select(*key, F.when(back, "RETURN").otherwise("PAYMENT").alias("event"), F.when(back, "RECEIVED").otherwise("CHARGED").alias("event_status"), c("l_shipdate").alias("event_date"), m.alias("total"))
    kind = F.when(c("l_returnflag") == "N", "ITEM_PRICE_CREDIT").when(back, "ITEM_PRICE").otherwise("COMMISSION")
    part = F.when(c("l_linestatus") == "F", m).otherwise(m * F.lit("0.5").cast("decimal(2,1)"))
    booked = l.select(
        *key, kind.alias("transaction_type"), c("l_shipdate").alias("event_date"), F.round(part * 100).cast("bigint").cast("string").alias("net_amount_cent"), F.lit("100").alias("net_amount_fraction"), F.lit(None).cast("double").alias("commission"))
    items = l.select(c("l_orderkey").alias("order_id"), c("l_linenumber").alias("item_id"), c("l_partkey").alias("sku"), m.alias("paid_price"))
    out = L.order_balance(events, L.settlement_amount(booked), items, charges={"cobro_comision": vocab.LEDGER_CHARGES["cobro_comision"]})
    return out.withColumn("saldo", F.round(num("saldo"), 2))


@query(_BAL + " SELECT seller_id, order_id, sku, ing AS ingreso, egr AS egreso, pago, des AS descuento, com AS cobro_comision, saldo FROM b")
def order_balance(t):
    """Charged, returned, paid, discounted and open balance of each order line."""
    return _balance(t).select("seller_id", "order_id", "sku", *[num(c).alias(c) for c in ("ingreso", "egreso", "pago", "descuento", "cobro_comision", "saldo")])


@query(_BAL + """ SELECT seller_id, order_id, sku, CASE WHEN saldo>=0 THEN 'CxP' ELSE 'CxC' END AS tipo, CASE WHEN saldo>0.1 AND fs='canceled' THEN 'Reembolsar a cliente' WHEN saldo>0.1 AND cs='CANCELLED' THEN 'Reembolsar a cliente'
 WHEN saldo>0.1 AND fs='delivered' THEN 'Pagar a seller' WHEN saldo>0.1 AND cs='DELIVERED' THEN 'Pagar a seller' WHEN saldo>0.1 AND date_diff('day',fi,DATE '1998-01-01')>=30 THEN 'Escalera' WHEN saldo<-0.1 AND fs='canceled' THEN 'Descontar a seller'
 WHEN saldo<-0.1 AND cs='CANCELLED' THEN 'Descontar a seller' WHEN saldo<-0.1 AND date_diff('day',fe,DATE '1998-01-01')>=30 THEN 'Escalera' ELSE 'No aplica' END AS action, CASE WHEN fs IS NOT NULL OR cs IS NOT NULL THEN 'Si' ELSE 'No' END AS final
 FROM (SELECT *, CASE order_id%4 WHEN 0 THEN 'canceled' WHEN 1 THEN 'delivered' END AS fs, CASE order_id%3 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'DELIVERED' END AS cs FROM b)""")
def balance_action(t):
    """What to do about each open balance."""
    states = {k: vocab.CLOSED_STATES[k] for k in ("status_order", "status_platform")}
    o = F.col("order_id")
    out = _balance(t).withColumns({
        "status_order": F.when(o % 4 == 0, "canceled").when(o % 4 == 1, "delivered"), "status_platform": F.when(o % 3 == 0, "CANCELLED").when(o % 3 == 1, "DELIVERED")})
    tipo = F.when(F.col("saldo") >= 0, "CxP").otherwise("CxC")
    return out.withColumn("tipo", tipo).select("seller_id", "order_id", "sku", "tipo", L.recommended_action("1998-01-01", states).alias("action"), L.is_final(states).alias("final"))


_WORDS = ["DELIVERED", "En Reparto", "REGISTRADO", "SINIESTRO", "CUSTODIA", "Raro"]
_RET = """WITH r AS (SELECT l_orderkey AS order_id, l_partkey AS sku, 'G'||CAST(l_suppkey AS VARCHAR) AS guide, CASE l_suppkey%4 WHEN 0 THEN 'tms' WHEN 1 THEN 'urbano sur' WHEN 2 THEN '-' ELSE 'otra-via' END AS carrier, list_extract([{w}],1+CAST(l_suppkey%6 AS INT)) AS state,
 l_shipdate AS requested_at, CASE WHEN l_linestatus='F' THEN l_shipdate+to_days(CAST(l_partkey%60 AS INT)) END AS delivered_at, CASE WHEN l_linestatus='F' THEN 'a' ELSE 'b' END AS feed FROM lineitem),
p AS (SELECT l_orderkey AS order_id, l_partkey AS sku, MIN(CAST(l_shipdate AS DATE)) AS egreso FROM lineitem GROUP BY 1,2),
j AS (SELECT r.*, date_diff('day',egreso,CAST(delivered_at AS DATE)) AS return_days, CASE WHEN carrier IN ('tms','-') THEN 'Own Fleet' WHEN carrier='urbano sur' THEN 'Urbano' ELSE 'Otra-Via' END AS who,
 CASE state WHEN 'DELIVERED' THEN 'Entregado' WHEN 'En Reparto' THEN 'En Reparto' WHEN 'REGISTRADO' THEN 'Registrado' WHEN 'SINIESTRO' THEN 'Siniestro' WHEN 'CUSTODIA' THEN 'Custodia' ELSE state END AS sg FROM r JOIN p USING (order_id, sku)),
k AS (SELECT *, CASE sg WHEN 'Entregado' THEN 1 WHEN 'Custodia' THEN 1 WHEN 'Siniestro' THEN 1 WHEN 'En Reparto' THEN 2 WHEN 'Registrado' THEN 4 ELSE 5 END AS rk FROM j)""".replace("{w}", ",".join(f"'{w}'" for w in _WORDS))


def _returns(t):
    l = t("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    s = F.col("l_suppkey")
    base = [F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku"), F.concat(F.lit("G"), s.cast("string")).alias("guide"),
            F.when(s % 4 == 0, "tms").when(s % 4 == 1, "urbano sur").when(s % 4 == 2, "-").otherwise("otra-via").alias("carrier"), F.get(F.array(*[F.lit(w) for w in _WORDS]), (s % 6).cast("int")).alias("state"), F.col("l_shipdate").alias("requested_at")]
    arrived = F.col("l_shipdate") + F.make_dt_interval(days=(F.col("l_partkey") % 60).cast("int"))
    feeds = {"a": l.where(F.col("l_linestatus") == "F").select(*base, arrived.alias("delivered_at")), "b": l.where(F.col("l_linestatus") != "F").select(*base)}
    prior = l.groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku")).agg(F.min(F.to_date("l_shipdate")).alias("fecha_egreso"))
    return R.consolidate_returns(feeds, prior)


@query(_RET + " SELECT feed, order_id, sku, guide, who AS carrier, sg AS state_group, CAST(return_days AS BIGINT) AS return_days, CASE WHEN return_days<=30 THEN '00-30' WHEN return_days>30 THEN '30+' END AS return_days_band, rk AS state_rank FROM k")
def returns_consolidated(t):
    """Return rows of two feeds under one vocabulary, with days and rank."""
    return _returns(t).select("feed", "order_id", "sku", "guide", "carrier", "state_group", F.col("return_days").cast("bigint").alias("return_days"), "return_days_band", "state_rank")


@query(_RET + " SELECT order_id, sku, string_agg(DISTINCT sg,'|' ORDER BY sg) AS state_group, string_agg(DISTINCT who,'|' ORDER BY who) AS carrier, COUNT(DISTINCT guide) AS n_guides, string_agg(DISTINCT guide,'|' ORDER BY guide) AS guides, MIN(rk) AS state_rank FROM k GROUP BY 1,2")
def returns_per_line(t):
    """One row per order line: the value, or the list where they differ."""
    return R.returns_per_line(_returns(t)).select("order_id", "sku", "state_group", "carrier", "n_guides", "guides", "state_rank")


@query("""
WITH g AS (SELECT l_orderkey, MIN(l_partkey) AS one FROM lineitem GROUP BY 1 HAVING COUNT(DISTINCT l_partkey)=1)
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey%2=0 THEN o_custkey ELSE one END AS sku FROM orders LEFT JOIN g ON o_orderkey=l_orderkey
""")
def missing_skus(t):
    """Missing sku of an order reference, where its order holds a single sku."""
    feed = t("orders", "o_orderkey", "o_custkey").select(F.col("o_orderkey").alias("order_id"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("sku"), F.lit("ORDER").alias("kind"))
    skus = t("lineitem", "l_orderkey", "l_partkey").select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku"))
    return R.fill_sku(feed, skus).select("order_id", "sku")
