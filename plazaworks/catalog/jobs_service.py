"""Support, appeals, invoices and transport jobs on the shared tables."""

from pyspark.sql import functions as F

from .. import vocab
from ..plans import appeals as A
from ..plans import cases as C
from ..plans import invoices as I
from ..plans import transport as T
from .registry import money, num, query
from .texts import _rules_sql

_SAY = {
    "user": ["pedido entregado ayer", "cliente no contesta", "falta de stock", "mediacion", "sin novedad"],
    "assistant": ["opl no responde", "segun despacho seller", "siniestro en ruta", "devuelto al seller", "nada"],
    "system": ["se le notifico al seller", "proceder a favor del cliente", "seller no respondio", "ok", "ok"],
}
_TEAMS = {"user": "support", "assistant": "aftersales", "system": "sx"}


def _say_sql():
    return "CASE role " + " ".join(f"WHEN '{r}' THEN list_extract([{','.join(repr(w) for w in ws)}],1+CAST((conv_id+turn)%5 AS INT))" for r, ws in _SAY.items()) + " END"


_CLAIMS = f"""WITH c AS (SELECT conv_id, turn, role, {_say_sql()} AS txt FROM conversations), l AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) rn FROM c) WHERE rn=1),
w AS (SELECT conv_id, MAX(CASE WHEN role='user' THEN txt END) AS a, MAX(CASE WHEN role='assistant' THEN txt END) AS b, MAX(CASE WHEN role='system' THEN txt END) AS s FROM l GROUP BY 1),
o AS (SELECT conv_id, a, {_rules_sql('a', vocab.CLAIM_RULES_SUPPORT, 'NULL')} AS oa, {_rules_sql('b', vocab.CLAIM_RULES_AFTERSALES, 'NULL')} AS ob, {_rules_sql('s', vocab.CLAIM_RULES_SELLER_TEAM, 'NULL')} AS os, CASE WHEN conv_id%2=0 THEN 'Siniestro OPL' END AS oc FROM w),
d AS (SELECT *, COALESCE(CASE WHEN os<>'Notificacion a seller' THEN os END, CASE WHEN ob<>'Flujo OPL sin errores' THEN ob END, oa, oc) AS outcome FROM o)"""


def _claims(t):
    c = t("conversations", "conv_id", "turn", "role")
    at = ((F.col("conv_id") + F.col("turn")) % 5).cast("int")
    said = None
    for role, words in _SAY.items():
        v = F.get(F.array(*[F.lit(w) for w in words]), at)
        said = F.when(F.col("role") == role, v) if said is None else said.when(F.col("role") == role, v)
    team = F.when(F.col("role") == "user", "support").when(F.col("role") == "assistant", "aftersales").otherwise("sx")
    comments = c.select(F.col("conv_id").alias("case_id"), team.alias("team"), said.alias("comment"), F.col("turn").alias("created_at"), F.col("turn").alias("comment_id"))
    claims = c.select(F.col("conv_id").alias("case_id")).distinct().withColumn("closing_comment", F.when(F.col("case_id") % 2 == 0, "siniestrado"))
    return C.resolve_claims(claims, comments)


@query(_CLAIMS + " SELECT conv_id AS case_id, oa AS outcome_support, ob AS outcome_aftersales, os AS outcome_sx, outcome FROM d")
def resolved_claims(t):
    """Outcome of each claim: the first decisive comment."""
    return _claims(t).select("case_id", "outcome_support", "outcome_aftersales", "outcome_sx", "outcome")


_AGED = """ SELECT conv_id AS case_id, CASE WHEN a IS NULL AND 40>30 THEN 'Reembolso fuera de plazo' WHEN outcome IS NULL AND conv_id%3=0 THEN 'Error sistemico' WHEN outcome IS NULL AND seg='Longtail' AND days>=30 THEN 'Seller no responde'
 WHEN outcome IS NULL AND seg='AAA' AND days>=120 THEN 'Seller no responde' ELSE outcome END AS outcome FROM (SELECT *, CASE WHEN conv_id%2=0 THEN 'Longtail' ELSE 'AAA' END AS seg, CAST(conv_id%200 AS INT) AS days FROM d)"""


def _aged(t):
    k = F.col("case_id")
    out = _claims(t).withColumns({
        "segment": F.when(k % 2 == 0, "Longtail").otherwise("AAA"), "fecha_egreso": F.date_sub(F.lit("2024-06-30").cast("date"), (k % 200).cast("int")),
        "fecha_ingreso": F.date_sub(F.lit("2024-06-30").cast("date"), (k % 200 + 40).cast("int")), "status_platform": F.when(k % 3 == 0, "CANCELLED"), "status_tms": F.lit("Entregado"), "status_store": F.lit(None).cast("string")})
    return C.age_outcome(out, "2024-06-30")


@query(_CLAIMS + _AGED)
def aged_claims(t):
    """Undecided claims after their grace period."""
    return _aged(t).select("case_id", "outcome")


@query(_CLAIMS + f""", g AS ({_AGED}) SELECT case_id, outcome, CASE WHEN case_id%7=0 OR case_id%7=3 THEN 'Saldo por recuperar Seller'
 WHEN outcome IN ('Devuelto a seller','Error de seller','Pedido no entregado a cliente','Seller no responde') THEN 'Saldo por recuperar Seller' WHEN outcome IN ('Error de OPL','OPL no responde','Siniestro OPL') THEN 'Saldo por recuperar HD'
 WHEN outcome IN ('Caso cerrado por mediacion','Caso improcedente o sin evidencias','Cliente no responde','Error sistemico','Pedido entregado al cliente','Reembolso fuera de plazo') THEN 'Gasto' END AS bearer FROM g""")
def balance_bearers(t):
    """Who bears the balance of each claim, by its outcome and the state of the return."""
    k = F.col("case_id") % 7
    out = _aged(t).withColumn("return_state", F.when(k == 0, "Custodia").when(k == 3, "Entregado").when(k == 5, "Creado"))
    return out.select("case_id", "outcome", C.balance_bearer("outcome", "return_state").alias("bearer"))


_CASES = """WITH c AS (SELECT page_id AS case_id, url, html, CASE page_id%3 WHEN 0 THEN 'claim' WHEN 1 THEN 'invoice' ELSE 'other' END AS type, TIMESTAMP '2024-01-01 10:50:00'+to_hours(CAST(page_id*7%300 AS INT)) AS created,
 TIMESTAMP '2024-01-03 09:10:00'+to_hours(CAST(page_id*5%300 AS INT)) AS due, CASE WHEN page_id%4<>0 THEN TIMESTAMP '2024-01-01 11:10:00'+to_hours(CAST(page_id*7%300+page_id%90 AS INT)) END AS closed FROM pages),
m AS (SELECT DISTINCT case_id, CAST(n AS BIGINT) AS order_id FROM (SELECT case_id, unnest(regexp_extract_all(url,'[0-9]{1,4}')) AS n FROM c UNION ALL SELECT case_id, unnest(regexp_extract_all(html,'\\b2[0-9]{1,9}\\b')) FROM c)),
d AS (SELECT case_id, m.order_id, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM m LEFT JOIN orders ON order_id=o_orderkey),
g AS (SELECT case_id, string_agg(DISTINCT o_orderstatus,'|' ORDER BY o_orderstatus) AS customer, COUNT(DISTINCT order_id) AS orders, MAX(o_custkey) AS seller_id, CAST(SUM(v) AS DOUBLE) AS value FROM d GROUP BY 1),
e AS (SELECT c.*, COALESCE(closed, TIMESTAMP '2024-02-01') AS fin FROM c)"""


@query(_CASES + """ SELECT e.case_id, customer, orders, seller_id, value, date_diff('hour',created,fin) AS completion_hours, date_diff('hour',due,fin) AS diff_due_hours, CASE WHEN fin>due THEN 1 ELSE 0 END AS late,
 CASE WHEN type='claim' AND created<TIMESTAMP '2024-01-06' THEN 40 WHEN type='claim' THEN 30 WHEN type='invoice' THEN 16 END AS sla_hours,
 CASE WHEN type='other' THEN NULL WHEN date_diff('hour',created,fin)<=CASE WHEN type='claim' AND created<TIMESTAMP '2024-01-06' THEN 40 WHEN type='claim' THEN 30 ELSE 16 END THEN 'Si' ELSE 'No' END AS sla_met
 FROM e LEFT JOIN g USING (case_id)""")
def case_report(t):
    """Cases with the orders they mention, hours, lateness and agreed time."""
    p = t("pages")
    k = F.col("page_id")
    at = lambda base, hours: F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(hours=hours.cast("int"))
    cases = p.select(
        k.alias("case_id"), "url", "html", F.when(k % 3 == 0, "claim").when(k % 3 == 1, "invoice").otherwise("other").alias("type"), at("2024-01-01 10:50:00", k * 7 % 300).alias("created_at"),
        at("2024-01-03 09:10:00", k * 5 % 300).alias("due_at"), F.when(k % 4 != 0, at("2024-01-01 11:10:00", k * 7 % 300 + k % 90)).alias("closed_at"))
    orders = t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").alias("seller_id"), F.col("o_orderstatus").alias("customer"), F.lit(None).cast("string").alias("sku"), money("o_totalprice").alias("value"))
    rules = t.spark.createDataFrame(
        [("claim", 40, None, "2024-01-06"), ("claim", 30, "2024-01-06", None), ("invoice", 16, None, None)], "type string, sla_hours int, valid_from string, valid_to string"
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})
    out = C.case_report(cases, orders, "2024-02-01", rules, patterns=[("url", r"[0-9]{1,4}"), ("html", r"\b2[0-9]{1,9}\b")])
    return out.select("case_id", "customer", "orders", "seller_id", num("value").alias("value"), "completion_hours", "diff_due_hours", "late", "sla_hours", "sla_met")


@query("""
WITH k AS (SELECT user_id AS case_id, event_id AS task_id, CAST(event_id%17 AS BIGINT) AS owner, event_type AS team, date_trunc('hour',ts) AS created, date_trunc('hour',ts)+to_minutes(CAST(event_id%500 AS INT)) AS done FROM events),
h AS (SELECT *, date_diff('hour',created,done) AS task_hours FROM k), d AS (SELECT owner, team FROM (SELECT owner, team, ROW_NUMBER() OVER (PARTITION BY owner ORDER BY COUNT(DISTINCT task_id) DESC, team) rn FROM k GROUP BY 1,2) WHERE rn=1)
SELECT task_id, task_hours, CAST(SUM(task_hours) OVER (PARTITION BY case_id ORDER BY created) AS BIGINT) AS cumulative_hours, ROW_NUMBER() OVER (PARTITION BY case_id ORDER BY created, task_id) AS task_number, d.team AS dominant_team FROM h JOIN d USING (owner)
""")
def task_log(t):
    """Tasks of a case in order with their running hours and the owner's team."""
    e = t("events", "user_id", "event_id", "event_type", "ts")
    start = F.date_trunc("hour", "ts")
    tasks = e.select(
        F.col("user_id").alias("case_id"), F.col("event_id").alias("task_id"), (F.col("event_id") % 17).alias("owner"), F.col("event_type").alias("team"), start.alias("created_at"),
        (start + F.make_dt_interval(mins=(F.col("event_id") % 500).cast("int"))).alias("completed_at"))
    out = C.task_log(tasks, "2024-02-01", F.to_date("created_at"))
    return out.select("task_id", "task_hours", "cumulative_hours", "task_number", "dominant_team")


_STORES = ["NORTE Lima", "MODULO", "HOME_PICKUP", "NA", "SUR", "-", "WEB", "OPEN CENTRO"]
_AP = """WITH x AS (SELECT event_id AS appeal_id, user_id AS order_id, CAST(event_id%4 AS BIGINT) AS sku, ts AS requested_at, CASE WHEN event_id%3=0 THEN ts+to_days(CAST(event_id%9 AS INT)) END AS resolved_at, CASE event_id%3 WHEN 0 THEN 'Aceptado' WHEN 1 THEN 'Rechazado' ELSE 'Por validar' END AS state,
 value, CASE event_id%3 WHEN 0 THEN 'Garantia' WHEN 1 THEN 'Cambio de parecer' ELSE 'Otro' END AS reason, list_extract(['NORTE Lima','MODULO','HOME_PICKUP','NA','SUR','-','WEB','OPEN CENTRO'],1+CAST(event_id%8 AS INT)) AS store, CASE WHEN event_id%5=0 THEN 'NON_SHOW_CLIENT' ELSE 'OTHER' END AS category, event_type FROM events),
u AS (SELECT 'sheet' AS channel, * FROM x WHERE event_type='view' UNION ALL SELECT 'mail', * FROM x WHERE event_type<>'view' AND (order_id, sku) NOT IN (SELECT order_id, sku FROM x WHERE event_type='view')),
g AS (SELECT order_id, COUNT(DISTINCT state) AS n, MAX(CASE WHEN state='Aceptado' THEN 1 ELSE 0 END) AS ok FROM u GROUP BY 1),
v AS (SELECT u.* REPLACE (CASE WHEN state<>'Aceptado' AND n>1 AND ok=1 THEN NULL ELSE value END AS value) FROM u JOIN g USING (order_id)), r AS (SELECT order_id, COUNT(CASE WHEN value<>0 THEN order_id END) AS k FROM v GROUP BY 1),
z AS (SELECT v.*, k, round(COALESCE(value, 20)/50,2) AS acc FROM v JOIN r USING (order_id))"""


@query(_AP + """ SELECT appeal_id, channel, CASE WHEN k=0 THEN NULL ELSE value/k END AS value, CASE WHEN acc<0.05 THEN '1. 0 a 5%' WHEN acc<0.30 THEN '2. 5 a 30%' WHEN acc<0.50 THEN '3. 30% a 50%' WHEN acc<1 THEN '4. 50% a 100%' ELSE '5. 100%' END AS acceptance_band,
 CASE reason WHEN 'Garantia' THEN 'Falla de funcionamiento' WHEN 'Cambio de parecer' THEN 'Arrepentimiento' ELSE 'No identificado' END AS motive, date_diff('day',CAST(requested_at AS DATE),CAST(resolved_at AS DATE)) AS lead_days,
 ROW_NUMBER() OVER (PARTITION BY order_id, sku ORDER BY requested_at, appeal_id) AS n_appeal, CASE WHEN COUNT(*) OVER (PARTITION BY order_id, sku)>1 THEN 'Si' ELSE 'No' END AS re_appeal,
 CASE store WHEN 'NORTE Lima' THEN 'NORTE' WHEN 'MODULO' THEN 'MODULO' WHEN 'HOME_PICKUP' THEN 'HOME_PICKUP' WHEN 'NA' THEN 'NA' WHEN 'SUR' THEN 'SUR' WHEN 'WEB' THEN 'MODULO' WHEN 'OPEN CENTRO' THEN 'CENTRO' ELSE 'Otro' END AS business_unit,
 CASE WHEN store='HOME_PICKUP' THEN 'Devoluciones - Home Pickup' WHEN store IN ('NORTE Lima','SUR','OPEN CENTRO') THEN 'Devoluciones - Tienda' WHEN category='NON_SHOW_CLIENT' THEN 'Fallo de entrega' ELSE 'Otro' END AS flow FROM z""")
def appeals(t):
    """Appeals of two channels with payment share, motive, lead time and repeats."""
    e = t("events", "event_id", "user_id", "event_type", "ts", "value")
    k = F.col("event_id")
    x = e.select(
        k.alias("appeal_id"), F.col("user_id").alias("order_id"), (k % 4).alias("sku"), F.col("ts").alias("requested_at"), F.when(k % 3 == 0, F.col("ts") + F.make_dt_interval(days=(k % 9).cast("int"))).alias("resolved_at"),
        F.when(k % 3 == 0, "Aceptado").when(k % 3 == 1, "Rechazado").otherwise("Por validar").alias("state"), "value", F.when(k % 3 == 0, "Garantia").when(k % 3 == 1, "Cambio de parecer").otherwise("Otro").alias("reason"),
        F.get(F.array(*[F.lit(s) for s in _STORES]), (k % 8).cast("int")).alias("store"), F.when(k % 5 == 0, "NON_SHOW_CLIENT").otherwise("OTHER").alias("reason_category"), "event_type")
    channels = [("sheet", x.where(F.col("event_type") == "view")), ("mail", x.where(F.col("event_type") != "view"))]
    orders = x.select("order_id", "sku").distinct().withColumns({"paid_price": F.lit(20.0), "income": F.lit(50.0)})
    out = A.appeals([(n, c.drop("event_type")) for n, c in channels], orders, F.to_date("requested_at"), ["CENTRO", "SUR", "NORTE"], "MODULO|WEB")
    return out.select("appeal_id", "channel", "value", "acceptance_band", "motive", F.col("lead_days").cast("bigint").alias("lead_days"), "n_appeal", "re_appeal", "business_unit", "flow")


_INV = """WITH o AS (SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS created, CAST(o_orderdate AS DATE)+3 AS promised, CASE WHEN o_custkey%3=0 THEN 'ACME' END AS company, CASE WHEN o_orderkey%4=0 THEN '10' WHEN o_orderkey%4=1 THEN '20' ELSE '99' END||'123' AS taxid FROM orders),
i AS (SELECT l_orderkey AS order_id, MAX(CAST(l_shipdate AS DATE)) AS invoice_date FROM lineitem WHERE l_returnflag='A' GROUP BY 1), q AS (SELECT l_orderkey AS order_id, COUNT(DISTINCT l_suppkey) AS n_requests, MIN(CAST(l_shipdate AS DATE)) AS request_from, MAX(CASE WHEN l_linestatus='F' THEN CAST(l_shipdate AS DATE)+5 END) AS request_to, MAX(l_suppkey) AS request_case FROM lineitem WHERE l_returnflag='R' GROUP BY 1),
r AS (SELECT o.*, invoice_date, n_requests, request_from, request_to, request_case, COALESCE(invoice_date, request_to, DATE '2002-01-01')-promised AS invoice_days, COALESCE(request_to, DATE '2002-01-01')-request_from AS request_days FROM o LEFT JOIN i USING (order_id) LEFT JOIN q USING (order_id))"""


def _invoices(t):
    o = t("orders", "o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    orders = o.select(
        k.alias("order_id"), F.to_date("o_orderdate").alias("created_at"), F.date_add(F.to_date("o_orderdate"), 3).alias("promised_at"), F.when(F.col("o_custkey") % 3 == 0, "ACME").alias("company"),
        F.concat(F.when(k % 4 == 0, "10").when(k % 4 == 1, "20").otherwise("99"), F.lit("123")).alias("taxid"))
    l = t("lineitem", "l_orderkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus")
    sent = l.where(F.col("l_returnflag") == "A").select(F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("invoiced_at"))
    asked = l.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("case_id"), F.col("l_shipdate").alias("created_at"), F.when(F.col("l_linestatus") == "F", F.date_add(F.to_date("l_shipdate"), 5)).alias("closed_at"))
    return I.invoice_compliance(orders, sent, asked, "2002-01-01")


@query(_INV + """ SELECT order_id, CASE WHEN company IS NULL THEN 'Boleta' ELSE 'Factura' END AS document, CASE WHEN invoice_date IS NULL THEN 'Pendiente' ELSE 'Enviado' END AS invoice_state, CAST(invoice_days AS BIGINT) AS invoice_days, CAST(request_days AS BIGINT) AS request_days, n_requests,
 strftime(created,'%Y-%m') AS period_created, strftime(invoice_date,'%Y-%m') AS period_invoice, CASE WHEN invoice_date IS NOT NULL THEN 1 ELSE 0 END AS sent, CASE substr(taxid,1,2) WHEN '10' THEN 'RUC10' WHEN '20' THEN 'RUC20' ELSE 'Otro' END AS taxpayer FROM r""")
def invoice_compliance(t):
    """Sent and pending invoices with their age, requests and periods."""
    return _invoices(t).select(
        "order_id", "document", "invoice_state", F.col("invoice_days").cast("bigint").alias("invoice_days"), F.col("request_days").cast("bigint").alias("request_days"), "n_requests", "period_created", "period_invoice", "sent",
        I.taxpayer_type("taxid").alias("taxpayer"))


@query(_INV + """ SELECT order_id FROM r WHERE (invoice_date IS NULL AND DATE '2002-01-01'-created<=200 AND invoice_days>0) OR (request_case IS NOT NULL AND request_to IS NULL AND invoice_date IS NULL)""")
def invoice_alerts(t):
    return I.invoice_alerts(_invoices(t), "2002-01-01", 200).select("order_id")


@query("""
SELECT c_custkey, doc, CASE WHEN doc='Boleta' THEN c_name ELSE c_mktsegment END AS company, CASE WHEN doc='Boleta' THEN 'own' ELSE CAST(c_nationkey AS VARCHAR) END AS region FROM (SELECT *, CASE WHEN c_custkey%3=0 THEN 'Factura' ELSE 'Boleta' END AS doc FROM customer)
""")
def document_payload(t):
    c = t("customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    docs = c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "Factura").otherwise("Boleta").alias("doc"), "c_name", F.col("c_mktsegment").alias("company"), F.col("c_nationkey").cast("string").alias("region"), F.lit("own").alias("home"))
    return I.document_payload(docs, [("company", "c_name"), ("region", "home")], "doc").select("c_custkey", "doc", "company", "region")


@query("""
WITH p AS (SELECT l_orderkey AS order_id, l_suppkey AS guide, 'st'||l_linestatus AS state, l_returnflag AS reason, l_shipdate AS planned_at, 'PLANIFICADO' AS kind, l_partkey FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_linestatus, l_returnflag, l_shipdate, l_partkey FROM lineitem WHERE l_returnflag<>'R')
 UNION ALL SELECT l_orderkey, l_suppkey, 'INGRESO SIN PLANIFICACION', 'NA', l_shipdate, 'NO PLANIFICADO', l_partkey FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_shipdate, l_partkey FROM lineitem WHERE l_returnflag='R')),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY kind, order_id ORDER BY planned_at, list_extract(['','DEV','RET'],1+CAST(guide%3 AS INT))||CAST(guide*100000+l_partkey AS VARCHAR)) AS position FROM p),
k AS (SELECT user_id AS order_id, event_id AS case_id, ts AS ticket_at, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events)
SELECT kind, order_id, position, state, reason, list_extract(['','DEV','RET'],1+CAST(guide%3 AS INT))||CAST(guide*100000+l_partkey AS VARCHAR) AS guide, CASE WHEN guide%3=0 THEN 'Recoleccion' ELSE 'IL' END AS flow, case_id, o_custkey AS seller_id, strftime(planned_at,'%Y-%m') AS period_planned, strftime(ticket_at,'%Y-%m') AS period_ticket
FROM n LEFT JOIN k USING (order_id, position) LEFT JOIN orders ON order_id=o_orderkey
""")
def transport_plan(t):
    """Planned and unplanned arrivals with the k-th ticket of their order."""
    l = t("lineitem", "l_orderkey", "l_suppkey", "l_partkey", "l_linestatus", "l_returnflag", "l_shipdate")
    mark = F.get(F.array(F.lit(""), F.lit("DEV"), F.lit("RET")), (F.col("l_suppkey") % 3).cast("int"))
    guide = F.concat(mark, (F.col("l_suppkey") * 100000 + F.col("l_partkey")).cast("string")).alias("guide")
    planned = l.where(F.col("l_returnflag") != "R").select(
        F.col("l_orderkey").alias("order_id"), guide, F.concat(F.lit("st"), "l_linestatus").alias("state"), F.col("l_returnflag").alias("reason"), F.lit("-").alias("condition"), F.col("l_shipdate").alias("planned_at")).distinct()
    unplanned = l.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("order_id"), guide, F.col("l_shipdate").alias("registered_at")).distinct()
    tickets = t("events", "user_id", "event_id", "ts").select(F.col("user_id").alias("order_id"), F.col("event_id").alias("case_id"), F.col("ts").alias("ticket_at"), F.lit(None).cast("timestamp_ntz").alias("closed_at"))
    orders = t("orders", "o_orderkey", "o_custkey").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("seller_id"))
    out = T.transport_plan(planned, unplanned, tickets, orders)
    return out.select("kind", "order_id", "position", "state", "reason", "guide", "flow", "case_id", "seller_id", "period_planned", "period_ticket")


_ANSWERS = ["no procede", "se procedera a aceptar", "gracias", None]


@query(f"""
WITH a AS (SELECT conv_id, turn, CASE WHEN turn%5=0 THEN 'Aviso cierre caso' ELSE 'Correo' END AS subject, list_extract(['no procede','se procedera a aceptar','gracias',NULL],1+CAST((conv_id+turn)%4 AS INT)) AS answer FROM conversations)
SELECT conv_id, turn, CASE WHEN regexp_matches(answer,'no procede|no procedio') THEN 'Rechazado' WHEN regexp_matches(subject,'{vocab.APPEAL_REJECT_SUBJECT}') THEN 'Rechazado' WHEN answer IS NULL THEN 'Rechazado'
 WHEN regexp_matches(answer,'{vocab.APPEAL_ACCEPT_TEXT}') THEN 'Aceptado' ELSE 'Por validar' END AS state FROM a
""")
def appeal_states(t):
    """Outcome of an appeal by the words of the answer."""
    c = t("conversations", "conv_id", "turn")
    answer = F.get(F.array(*[F.lit(a) for a in _ANSWERS]), ((F.col("conv_id") + F.col("turn")) % 4).cast("int"))
    rows = c.withColumns({"subject": F.when(F.col("turn") % 5 == 0, "Aviso cierre caso").otherwise("Correo"), "answer": answer})
    return rows.select("conv_id", "turn", A.appeal_state("subject", "answer", "no procede|no procedio").alias("state"))


@query("""
SELECT c_custkey, CASE WHEN c_acctbal<0 THEN 'Seller' ELSE 'Customer' END AS stakeholder, CASE WHEN regexp_matches('G'||c_mktsegment,'DEV|RET|BUI') THEN 'x' ELSE 'y' END AS k FROM customer
""")
def stakeholders(t):
    """Who a case is about: the customer when there is a document, else the seller."""
    c = t("customer", "c_custkey", "c_acctbal", "c_mktsegment").withColumns({"doc": F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")), "seller": F.col("c_custkey")})
    return c.select("c_custkey", C.stakeholder("doc", "seller").alias("stakeholder"), F.when(F.concat(F.lit("G"), "c_mktsegment").rlike("DEV|RET|BUI"), "x").otherwise("y").alias("k"))
