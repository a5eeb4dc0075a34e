"""Catalogue and seller jobs on the shared tables."""

from pyspark.sql import functions as F

from .. import vocab
from ..plans import catalog as K
from ..plans import sellers as S
from ..plans.sizes import assign_size, handle_outliers
from .geography import _LAT, _LON, _place, _place_sql
from .registry import query
from .sizes_data import raw_parts, raw_sql


def _size_sql(measure, v):
    table = vocab.SIZE_RANGES[measure]
    return "CASE " + " ".join(f"WHEN {v}>={lo}::DOUBLE AND {v}<{hi}::DOUBLE THEN {i}" for i, (lo, hi) in enumerate(table.values())) + " ELSE 0 END"


_SIZES = "[" + ",".join(f"'{s}'" for s in vocab.SIZES) + "]"
_SIZED = f"""WITH r AS (SELECT *, greatest(length,width) AS len, least(length,width) AS wid FROM {raw_sql()}),
m AS (SELECT *, greatest({_size_sql('weight', 'weight')}, {_size_sql('volume_m3', '(wid*len*height)')}, {_size_sql('length', 'len')}) AS mx, list_position({_SIZES}, size)-1 AS declared FROM r),
k AS (SELECT *, list_extract({_SIZES}, 1+least(mx, declared)) AS kept FROM m),
v AS (SELECT *, CASE WHEN category_code='G19080602' AND kept NOT IN ('XS3','XS2','XS') THEN CASE WHEN dimension_quantity BETWEEN 19 AND 32 THEN 'M' WHEN dimension_quantity>32 AND dimension_quantity<=55 THEN 'LO' WHEN dimension_quantity>55 AND dimension_quantity<=65 THEN 'L'
 WHEN dimension_quantity>65 AND dimension_quantity<=75 THEN 'XL' WHEN dimension_quantity>75 AND dimension_quantity<=90 THEN 'XXL' ELSE kept END ELSE kept END AS tv FROM k)"""


@query(_SIZED + f" SELECT p_partkey, list_extract({_SIZES}, 1+mx) AS max_size, COALESCE(new_item_size, tv) AS size FROM v")
def size_rules(t):
    """Size class by weight, volume and length, the declared class, screens and corrections."""
    return assign_size(raw_parts(t)).select("p_partkey", "max_size", "size")


@query(_SIZED + " SELECT category_code, " + ", ".join(f"COUNT(DISTINCT CASE WHEN COALESCE(new_item_size, tv)='{s}' THEN p_partkey END) AS dist_{s.lower()}" for s in vocab.SIZES) + " FROM v GROUP BY 1")
def size_histogram(t):
    return K.size_histogram(assign_size(raw_parts(t)), "category_code", "size", "p_partkey")


@query(f"""
WITH r AS (SELECT p_partkey, category_code, width FROM {raw_sql()}), n AS (SELECT category_code, width, ROW_NUMBER() OVER (PARTITION BY category_code ORDER BY width) rn, COUNT(*) OVER (PARTITION BY category_code) n FROM r),
b AS (SELECT category_code, MAX(CASE WHEN rn=CAST(floor(n*0.03) AS BIGINT)+1 THEN width END) lo, MAX(CASE WHEN rn=n-CAST(floor(n*0.03) AS BIGINT) THEN width END) hi FROM n GROUP BY 1)
SELECT p_partkey, least(greatest(width,lo),hi) AS width FROM r JOIN b USING (category_code)
""")
def category_outliers(t):
    """Widths pulled into the tails of their category."""
    return handle_outliers(raw_parts(t), "category_code", ["width"], "winsorize").select("p_partkey", "width")


_MEASURES = ("width", "length", "height")


@query(f"""
WITH r AS (SELECT p_partkey, category_code, width, length, height FROM {raw_sql()}), c AS (SELECT category_code, COUNT(*) AS n, {', '.join(f'list_sort(list({m})) AS {m}s' for m in _MEASURES)} FROM r GROUP BY 1)
SELECT p_partkey, {', '.join(f'least(greatest({m}, {m}s[CAST(floor(n*0.03) AS BIGINT)+1]), {m}s[n-CAST(floor(n*0.03) AS BIGINT)]) AS {m}' for m in _MEASURES)} FROM r JOIN c USING (category_code)
""")
def category_tails(t):
    """Width, length and height pulled into the tails of their category."""
    return handle_outliers(raw_parts(t), "category_code", _MEASURES, "winsorize").select("p_partkey", *_MEASURES)


@query(f"""
WITH r AS (SELECT p_partkey, category_code, width, length, height FROM {raw_sql()}), c AS (SELECT category_code, {', '.join(f'AVG({m}) AS m_{m}, STDDEV_SAMP({m}) AS s_{m}' for m in _MEASURES)} FROM r GROUP BY 1)
SELECT p_partkey, width, length, height FROM r JOIN c USING (category_code) WHERE NOT ({' OR '.join(f'COALESCE(abs({m}-m_{m}) > 3*s_{m} AND s_{m} > 0, FALSE)' for m in _MEASURES)})
""")
def category_removed(t):
    """Parts of which no measure is further than three deviations from its category's mean."""
    return handle_outliers(raw_parts(t), "category_code", _MEASURES, "remove").select("p_partkey", *_MEASURES)


_PRICES = "SELECT l_partkey AS sku, l_extendedprice AS normal, CASE WHEN l_discount>0.03 THEN l_extendedprice*0.5::DOUBLE ELSE 0 END AS internet, l_quantity AS ev, CAST(l_shipdate AS DATE) AS e FROM lineitem"


@query(f"""
SELECT sku, CASE WHEN e>=DATE '2001-06-01' THEN ev WHEN internet>0 THEN internet ELSE normal END AS price FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY sku ORDER BY e DESC, ev DESC, internet DESC, normal DESC) rn FROM ({_PRICES})) WHERE rn=1
""")
def effective_price(t):
    """Price in force: event, internet, normal."""
    return K.effective_price(_prices(t), "2001-06-01").select("sku", "price")


def _prices(t):
    l = t("lineitem", "l_partkey", "l_extendedprice", "l_discount", "l_quantity", "l_shipdate")
    return l.select(
        F.col("l_partkey").alias("sku"), F.col("l_extendedprice").alias("price_normal"), F.when(F.col("l_discount") > 0.03, F.col("l_extendedprice") * 0.5).otherwise(0.0).alias("price_internet"),
        F.col("l_quantity").alias("price_event"), F.to_date("l_shipdate").alias("event_end"))


@query(f"""
WITH p AS (SELECT p_partkey, p_name, p_size, lpad(CAST(p_partkey%997 AS VARCHAR),3,'0')||lpad(CAST(p_size AS VARCHAR),2,'0') AS code FROM part),
c AS (SELECT *, CASE WHEN length('G'||code)>=3 THEN substr('G'||code,1,3) END AS g1, substr('G'||code,1,5) AS g2, CASE WHEN length('G'||code)>=7 THEN substr('G'||code,1,7) ELSE substr('G'||code,1,5) END AS g3 FROM p),
n AS (SELECT g1, MAX(p_name) AS n1 FROM c GROUP BY 1),
a AS (SELECT p_partkey, CAST(p_size AS DOUBLE)+0.5::DOUBLE AS width, CASE WHEN p_size<40 THEN CAST(p_size*3 AS DOUBLE) END AS screen FROM p),
l AS (SELECT l_partkey, MAX(l_tax) AS h FROM lineitem GROUP BY 1),
x AS (SELECT sku, CASE WHEN e>=DATE '2001-06-01' THEN ev WHEN internet>0 THEN internet ELSE normal END AS price FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sku ORDER BY e DESC, ev DESC, internet DESC, normal DESC) rn FROM ({_PRICES})) WHERE rn=1)
SELECT c.p_partkey AS sku, g1, g2, g3, n1, width, COALESCE(CASE WHEN screen<99 THEN screen END, CASE WHEN g1 IN ('G07','G08','G18') THEN 1.0::DOUBLE ELSE CAST(p_size AS DOUBLE) END) AS dimension_quantity, CASE WHEN g1 IN ('G07','G08','G18') THEN 'un' ELSE 'kg' END AS dimension_units, 'AB 1' AS model, h+0.0::DOUBLE AS height_in_cm, price,
 CAST(c.p_partkey%6 AS DOUBLE)+0.25::DOUBLE AS pieces, CASE WHEN p_size>25 THEN CAST(p_size AS DOUBLE) END AS packs, CASE WHEN c.p_partkey%3=0 THEN 'azul' ELSE 'rojo' END AS colour, CASE WHEN c.p_partkey%3=1 THEN 'claro' END AS basic_colour, CASE WHEN c.p_partkey%3=0 THEN 'azul' END AS second_colour,
 'T'||CAST(p_size AS VARCHAR) AS apparel_size, '12 meses' AS seller_warranty, CASE WHEN c.p_partkey%2=0 THEN 'nuevo' ELSE 'usado' END AS condition
FROM c JOIN n USING (g1) JOIN a USING (p_partkey) LEFT JOIN l ON l_partkey=c.p_partkey LEFT JOIN x ON x.sku=c.p_partkey
""")
def sku_master(t):
    """Product master from names, attribute documents, logistics sizes, prices and categories."""
    p = t("part", "p_partkey", "p_name", "p_size")
    size = F.col("p_size")
    code = F.concat(F.lit("G"), F.lpad((F.col("p_partkey") % 997).cast("string"), 3, "0"), F.lpad(size.cast("string"), 2, "0"))
    third = F.col("p_partkey") % 3
    varied = F.to_json(F.create_map(
        F.lit("468"), F.when(third == 0, "azul"), F.lit("1717"), F.lit("rojo"), F.lit("1734"), F.when(third == 1, "claro"), F.lit("794"), F.concat(F.lit("T"), size.cast("string"))))
    options = t.spark.createDataFrame([("0", "Nuevo"), ("1", "Usado")], "option_id string, option_name string")
    named = p.select(
        F.col("p_partkey").alias("sku"), F.lit(1).alias("seller_id"), F.concat("p_name", F.lit(" "), size.cast("string"), F.lit(" kilos")).alias("name"), F.lit("misc").alias("category"), code.alias("category_code"),
        F.col("p_partkey").alias("product_set"), "p_name", varied.alias("variation"))
    attrs = F.to_json(F.create_map(
        F.lit("60"), F.concat(size.cast("string"), F.lit(",5")), F.lit("844"), F.when(size < 40, (size * 3).cast("string")), F.lit(vocab.MODEL_KEY), F.lit("áb 1_DELETED_7"),
        F.lit("818"), F.concat((F.col("p_partkey") % 6).cast("string"), F.lit(",25")), F.lit("31239"), F.when(size > 25, size.cast("string")), F.lit("10206"), F.lit("12 Meses"), F.lit("22"), (F.col("p_partkey") % 2).cast("string")))
    data = p.select(F.col("p_partkey").alias("product_set"), attrs.alias("attributes"))
    l = t("lineitem", "l_partkey", "l_tax").select(
        F.array(F.struct(F.col("l_partkey").alias("offering_id"))).alias("item_info"),
        F.array(F.struct(F.lit("S").alias("item_size"), F.lit(1.0).alias("length_in_cm"), F.lit(1.0).alias("width_in_cm"), F.col("l_tax").alias("height_in_cm"), F.lit(1.0).alias("weight_in_kg"))).alias("presentation_footprints"))
    levels = K.category_levels("category_code")
    categories = named.withColumns(levels).select("g1", "g2", "g3", "g4", F.col("p_name").alias("n1"), F.col("p_name").alias("n2"), F.col("p_name").alias("n3"), F.col("p_name").alias("n4"))
    out = K.sku_master(named.drop("p_name"), data, l, _prices(t), categories, "2001-06-01", options)
    return out.select(
        "pieces", "packs", "colour", "basic_colour", "second_colour", "apparel_size", "seller_warranty", "condition", "sku", "g1", "g2", "g3", "n1", "width", "dimension_quantity", "dimension_units", "model", (F.col("height_in_cm") + 0.0).alias("height_in_cm"), "price")


@query("""
WITH r AS (SELECT CAST(user_id AS VARCHAR)||'-'||event_type AS review_id, user_id AS product_id, ts, value, props FROM events), n AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id ORDER BY ts DESC, value DESC, props DESC) rn FROM r) WHERE rn=1)
SELECT DISTINCT review_id, value AS rating, lower(props) AS title, l_partkey AS sku, l_suppkey AS seller_id FROM n JOIN part ON p_partkey=product_id JOIN lineitem ON l_partkey=p_partkey
""")
def review_report(t):
    """Newest version of each review with the products and sellers it is about."""
    e = t("events", "user_id", "ts", "value", "event_type", "props").select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("review_id"), F.col("user_id").alias("product_id"), F.col("ts").alias("processed_at"), F.col("value").alias("rating"), F.col("props").alias("title"), F.lit("a, b").alias("review"))
    products = t("part", "p_partkey").select(F.col("p_partkey").alias("sku"), F.col("p_partkey").alias("product_id"))
    sold = t("lineitem", "l_partkey", "l_suppkey").select(F.col("l_partkey").alias("sku"), F.col("l_suppkey").alias("seller_id"))
    return K.review_report(e, products, sold).select("review_id", "rating", "title", "sku", "seller_id")


@query("""
WITH n AS (SELECT event_id AS node_id, ts, CASE event_id%3 WHEN 0 THEN 'IBIS' WHEN 1 THEN 'C&C' ELSE 'X' END AS m, event_id%5 AS d, '1'||CAST(event_id%10 AS VARCHAR)||':30' AS cot FROM events),
l AS (SELECT 'SC'||lpad(CAST(event_id%400 AS VARCHAR),5,'0') AS seller_id, event_id AS node_id FROM events)
SELECT seller_id, CASE m WHEN 'IBIS' THEN 'HOME_DELIVERY' ELSE 'COLLECT' END AS delivery_type, m AS delivery_method, CAST(d AS VARCHAR) AS dts, cot, 'L-V' AS frequency, node_id FROM (
 SELECT l.seller_id, n.*, ROW_NUMBER() OVER (PARTITION BY l.seller_id, m ORDER BY ts DESC, n.node_id DESC) rn FROM l JOIN n ON n.node_id=l.node_id WHERE m<>'X') WHERE rn=1
""")
def parsed_nodes(t):
    """Method, days, cut-off and frequency read from node names, newest per seller."""
    e = t("events", "event_id", "ts")
    k = F.col("event_id")
    method = F.when(k % 3 == 0, "IBIS").when(k % 3 == 1, "C&C").otherwise("X")
    name = F.concat(method, F.lit(" 24 (DTS "), (k % 5).cast("string"), F.lit(" 1"), (k % 10).cast("string"), F.lit(":30  L-V)"))
    nodes = e.select(k.alias("node_id"), name.alias("node_name"), F.col("ts").alias("changed_at"))
    links = e.select(F.concat(F.lit("PROC-SC"), F.lpad((k % 400).cast("string"), 5, "0")).alias("process"), k.alias("node_id"))
    return K.parse_nodes(links, nodes).select("seller_id", "delivery_type", "delivery_method", "dts", "cot", "frequency", "node_id")


_HAV = "2*6371008.8::DOUBLE*asin(sqrt(least(1.0::DOUBLE, pow(sin((radians({b2})-radians({b1}))/2),2)+cos(radians({b1}))*cos(radians({b2}))*pow(sin((radians({a2})-radians({a1}))/2),2))))"


@query(f"""
WITH s AS (SELECT c_custkey AS seller_id, round({_place_sql('c_custkey', _LON)},6) AS lon, round({_place_sql('c_custkey', _LAT)},6) AS lat, c_mktsegment='BUILDING' AS moved, c_custkey%3 AS w, c_name, c_mktsegment AS dp FROM customer),
b AS (SELECT *, CASE WHEN moved THEN lon+0.01::DOUBLE ELSE lon END AS bl FROM s)
SELECT seller_id, CASE WHEN w<>1 THEN 1 ELSE 0 END AS monday, CASE WHEN w=1 THEN 1 ELSE 0 END AS saturday, CASE WHEN moved THEN 'Corregir' ELSE 'Ok' END AS location_check, CASE WHEN moved THEN 'Corregir' ELSE 'Ok' END AS phone_check, 'Ok' AS district_check,
 CASE WHEN moved THEN 'Corregir' ELSE 'Ok' END AS address_check, round({_HAV.format(a1='bl', b1='lat', a2='CAST(-76.958073 AS DOUBLE)', b2='CAST(-12.21717 AS DOUBLE)')}/1000,2) AS geodesic_km_hub,
 CASE WHEN dp='MACHINERY' THEN round(abs(lat+12::DOUBLE)*CAST(111.32 AS DOUBLE)+abs(bl+77::DOUBLE)*CAST(111.32 AS DOUBLE)*cos(radians(lat)),2) END AS manhattan_km_dropoff FROM b
""")
def seller_profile(t):
    """Sellers from attribute rows, corrections and drop-off points."""
    c = t("customer", "c_custkey", "c_name", "c_mktsegment").withColumns({"lon": F.round(_place("c_custkey", _LON), 6), "lat": F.round(_place("c_custkey", _LAT), 6)})
    k = F.col("c_custkey")
    fmt = lambda n: F.format_string("%.6f", F.col(n))
    values = F.create_map(
        F.lit("location"), F.concat(fmt("lat"), F.lit(","), fmt("lon")), F.lit("work_days"), F.when(k % 3 == 1, "Sat, Sun").otherwise("Mon, Tue"), F.lit("address"), F.concat(F.lit("Calle   "), "c_name"),
        F.lit("phone"), F.lit("911"), F.lit("district"), F.lit("Lima"))
    attributes = c.select(k.alias("seller_id"), F.explode(values).alias("name", "value"))
    moved = c.where(F.col("c_mktsegment") == "BUILDING").select(
        k.alias("seller_id"), F.col("lat").alias("latitude"), (F.col("lon") + 0.01).alias("longitude"), F.lit("Otra avenida").alias("address"), F.lit("922").alias("phone"), F.lit("Lima").alias("district"))
    drops = c.where(F.col("c_mktsegment") == "MACHINERY").select(k.alias("seller_id"), F.lit("P").alias("dropoff"), F.lit(-77.0).alias("dropoff_lon"), F.lit(-12.0).alias("dropoff_lat"))
    out = S.seller_profile(attributes, moved, drops, ["location", "work_days", "address", "phone", "district"], {"hub": (-76.958073, -12.21717)})
    return out.select("seller_id", "monday", "saturday", "location_check", "phone_check", "district_check", "address_check", "geodesic_km_hub", "manhattan_km_dropoff")


@query("""
WITH v AS (SELECT s_suppkey, s_nationkey AS a, CAST(floor(s_acctbal/500) AS BIGINT) AS b FROM supplier),
p AS (SELECT x.s_suppkey, y.s_suppkey AS d FROM v x JOIN v y ON x.a=y.a AND x.s_suppkey<>y.s_suppkey UNION SELECT x.s_suppkey, y.s_suppkey FROM v x JOIN v y ON x.b=y.b AND x.s_suppkey<>y.s_suppkey),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY s_suppkey ORDER BY d DESC) rn FROM p)
SELECT v.s_suppkey, CAST(COUNT(d) AS BIGINT) AS n_dup, """ + ", ".join(f"MAX(CASE WHEN rn={i} THEN d END) AS dup{i}" for i in range(1, 10)) + """ FROM v LEFT JOIN r ON v.s_suppkey=r.s_suppkey GROUP BY 1
""")
def duplicate_sellers(t):
    """Suppliers that share a nation or a balance level, nine partners side by side."""
    s = t("supplier", "s_suppkey", "s_nationkey", "s_acctbal").select("s_suppkey", F.col("s_nationkey").alias("a"), F.floor(F.col("s_acctbal") / 500).alias("b"))
    return S.duplicate_entities(s, "s_suppkey", ["a", "b"], [F.asc("a"), F.asc("b")]).drop("a", "b")
