"""Features, classifiers, metrics, files and streams."""

from pyspark.sql import functions as F

from ..functions.text import tokens
from ..ml import features as X
from ..ml import models as M
from ..plans.landing import clean_landed
from ..session import shared_folder, spread
from ..sources import readers, sinks
from ..streaming import watch
from .registry import query
from .sizes_data import sized_parts


@query()
def text_tfidf(t):
    """Weight and number of the distinct words of each document."""
    d = t("documents", "doc_id", "text", "lang")
    model = X.text_features(["text"]).fit(d)
    weights = F.unwrap_udt("text_tfidf")["values"]  # the stored values of the sparse vector
    out = model.transform(d).select("doc_id", weights.alias("v"))
    return out.select("doc_id", F.size("v").alias("words"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 4).alias("weight"))


@query()
def size_tree(t):
    """Size class of a product by a decision tree: quality per class on held-out parts."""
    train, test = M.split(sized_parts(t), [0.7, 0.3], 42, ["p_partkey"])
    model = M.tree_classifier(["width", "length", "height", "weight", "volume_m3"], "size").fit(train)
    return M.class_metrics(M.score(model, test), "size", "predicted")


def _network(t):
    """(model, history, test rows) of a dense network trained on eight tenths and stopped by one."""
    features = ["width", "length", "height", "weight", "volume_m3"]
    train, valid, test = M.split(sized_parts(t), [0.8, 0.1, 0.1], 42, ["p_partkey"])
    k = train.select("size").distinct().count()
    return *M.fit_early_stopping(train, valid, features, "size", k), test


@query()
def size_network(t):
    """Class probabilities of a dense network, trained on eight tenths and stopped by the loss on one."""
    model, _, test = _network(t)
    scored = M.score(model, spread(test))
    probabilities = [f"p_{n}" for n in M.labels_of(model)]
    return scored.select("p_partkey", "size", "predicted", *[F.round(c, 6).alias(c) for c in sorted(probabilities)])


@query()
def size_network_history(t):
    """Passes run by the network, with the losses on both parts and the pass that was kept."""
    out = _network(t)[1]
    return out.select("epoch", F.round("train_loss", 6).alias("train_loss"), F.round("valid_loss", 6).alias("valid_loss"), "kept")


@query()
def component_variance(t):
    """Variance per principal component of the product measures."""
    parts = sized_parts(t)
    return X.explained_variance(parts, X.pca(["width", "length", "height", "weight", "volume_m3"], 4).fit(parts))


_PRED = "SELECT l.doc_id, CAST(quality AS VARCHAR) AS truth, CASE WHEN n_chars>900 THEN '1' ELSE '0' END AS guess, CAST(n_chars AS DOUBLE)/50000 AS score FROM labels l JOIN documents d ON l.doc_id=d.doc_id"


def _predictions(t):
    rows = t("labels", "doc_id", "quality").join(t("documents", "doc_id", "n_chars"), "doc_id")
    return rows.select(
        "doc_id", F.col("quality").cast("string").alias("truth"), F.when(F.col("n_chars") > 900, "1").otherwise("0").alias("guess"),
        (F.col("n_chars").cast("double") / 50000).alias("score"),
    )


@query(f"""
WITH p AS ({_PRED}), c AS (SELECT DISTINCT truth AS class FROM p UNION SELECT DISTINCT guess FROM p),
m AS (SELECT class, CAST(SUM(CASE WHEN truth=class THEN 1 ELSE 0 END) AS BIGINT) AS support, CAST(SUM(CASE WHEN guess=class THEN 1 ELSE 0 END) AS DOUBLE) AS guessed, CAST(SUM(CASE WHEN truth=class AND guess=class THEN 1 ELSE 0 END) AS DOUBLE) AS hit FROM p, c GROUP BY 1),
r AS (SELECT class, support, hit, hit/guessed AS precision, hit/support AS recall, 2*(hit/guessed)*(hit/support)/(hit/guessed+hit/support) AS f1 FROM m)
SELECT class, support, ROUND(precision,9) AS precision, ROUND(recall,9) AS recall, ROUND(f1,9) AS f1 FROM r
UNION ALL SELECT 'Micro', CAST(SUM(support) AS BIGINT), ROUND(SUM(hit)/SUM(support),9), ROUND(SUM(hit)/SUM(support),9), ROUND(SUM(hit)/SUM(support),9) FROM r
UNION ALL SELECT 'Macro', CAST(SUM(support) AS BIGINT), ROUND(AVG(precision),9), ROUND(AVG(recall),9), ROUND(AVG(f1),9) FROM r
UNION ALL SELECT 'Weighted', CAST(SUM(support) AS BIGINT), ROUND(SUM(precision*support)/SUM(support),9), ROUND(SUM(recall*support)/SUM(support),9), ROUND(SUM(f1*support)/SUM(support),9) FROM r
""")
def class_metrics(t):
    """Precision, recall and F1 per class and averaged, from one count."""
    out = M.class_metrics(_predictions(t), "truth", "guess")
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query(f"""
WITH p AS ({_PRED}), s AS (SELECT '1' AS class, truth, score FROM p UNION ALL SELECT '0', truth, 1-score FROM p),
c AS (SELECT class, score, SUM(CASE WHEN truth=class THEN 1 ELSE 0 END) AS pos, SUM(CASE WHEN truth<>class THEN 1 ELSE 0 END) AS neg FROM s GROUP BY 1,2),
r AS (SELECT *, SUM(neg) OVER (PARTITION BY class ORDER BY score) AS upto FROM c)
SELECT class, ROUND(SUM(pos*(upto-neg+neg/2))/(SUM(pos)*SUM(neg)),9) AS auc FROM r GROUP BY 1
""")
def one_vs_rest_auc(t):
    p = _predictions(t).withColumns({"s1": F.col("score"), "s0": 1 - F.col("score")})
    return M.one_vs_rest_auc(p, "truth", {"1": "s1", "0": "s0"}).withColumn("auc", F.round("auc", 9))


@query("""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text),'[^\\p{L}\\p{N}]+'), lambda x: length(x)>0) AS w FROM documents),
c AS (SELECT w, COUNT(*) AS n FROM (SELECT unnest(w) AS w FROM d) GROUP BY 1), r AS (SELECT w, ROW_NUMBER() OVER (ORDER BY n DESC, w) AS i FROM c QUALIFY i<=49),
m AS (SELECT map(list(w), list(i)) AS m FROM r), q AS (SELECT doc_id, list_filter(list_transform(w, lambda x: m[x]), lambda i: i IS NOT NULL) AS ids FROM d, m),
l AS (SELECT doc_id, CASE WHEN len(ids)>50 THEN list_slice(ids, len(ids)-49, len(ids)) ELSE ids END AS ids FROM q)
SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(0, 50-len(ids)), lambda x: 0)), ' ') AS sequence FROM l
""")
def word_sequences(t):
    """Ids of the 49 most common words in order, last fifty, padded behind."""
    d = t("documents", "doc_id", "text").withColumn("w", tokens("text"))
    return X.word_sequences(d, "w", X.common_words(d, "w")).select("doc_id", F.concat_ws(" ", F.transform("sequence", lambda i: i.cast("string"))).alias("sequence"))


@query("SELECT event_type, CAST((SELECT COUNT(*) FROM events) AS DOUBLE)/(SELECT COUNT(DISTINCT event_type) FROM events)/COUNT(*) AS weight FROM events GROUP BY 1")
def class_weights(t):
    return X.class_weights(t("events", "event_type"), "event_type")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, ROUND(l_quantity*l_tax*l_discount,4) AS volumen_cm3 FROM lineitem
""")
def volume_feature(t):
    l = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax", "l_discount")
    out = X.prepare_features(l, "l_quantity", "l_tax", "l_discount")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", (F.col("volumen_cm3") + 0.0).alias("volumen_cm3"))


@query("SELECT strftime(o_orderdate,'%Y-%m') AS ym, COUNT(*) AS n, COUNT(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1")
def monthly_files(t):
    """Orders written one folder per month and read back by it."""
    path = shared_folder(t.spark) + "/monthly"
    sinks.publish_monthly(t("orders", "o_orderkey", "o_custkey", "o_orderdate"), "o_orderdate", path)
    back = readers.scan(t.spark, path, ["ym", "o_custkey"])
    return back.groupBy(F.col("ym").cast("string").alias("ym")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment, c_nationkey AS nation FROM customer")
def delimited_files(t):
    """Pipe files per nation, in Latin-1, read back with a stated schema, their names on each row."""
    path = shared_folder(t.spark) + "/piped"
    c = t("customer", "c_custkey", "c_mktsegment", "c_nationkey").select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias(" id "), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    c.write.option("sep", "|").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    back = readers.read_delimited_folder(t.spark, path, "` id ` string, segment string, nation int", name_glob="*.csv")
    back = readers.normalize_headers(readers.with_source_file(back))
    return clean_landed(back.where(F.col("source_file").endswith(".csv")), drop=["source_file"], ids=["id"])


@query("SELECT n_nationkey, n_name, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1,2")
def per_key_files(t):
    """One folder per nation from the same report, counted back per folder."""
    path = shared_folder(t.spark) + "/per_nation"
    rows = t("customer", "c_custkey", "c_nationkey").join(t("nation", "n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    sinks.publish_per_key(rows, "n_nationkey", path)
    return readers.scan(t.spark, path).groupBy("n_nationkey", "n_name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, MIN(o_orderstatus) AS o_orderstatus FROM orders WHERE o_orderstatus='F' AND o_orderpriority LIKE '%@%' OR o_orderstatus='F' AND o_orderkey%2=0 GROUP BY 1")
def watched_orders(t):
    """Closed orders with an address, published by the stream."""
    folder = shared_folder(t.spark)
    schema = t("orders").schema
    stream = watch.landed(t.spark, f"{t.folder}/orders.parque[t]", schema)
    stream = stream.withColumn("address", F.when(F.col("o_orderkey") % 2 == 0, "a@example.org").otherwise("none"))
    rows = watch.alerts(stream, "o_orderstatus", ["F"], "address", ["o_orderkey", "o_orderstatus"])
    watch.publish_alerts(rows, f"{folder}/out", f"{folder}/state", ["o_orderkey"], every=None).awaitTermination()
    return readers.scan(t.spark, f"{folder}/out", ["o_orderkey", "o_orderstatus"])


@query()
def reloaded_model(t):
    """A fitted model saved, loaded and applied."""
    path = shared_folder(t.spark) + "/model"
    parts = sized_parts(t)
    sinks.save_pipeline(M.tree_classifier(["width", "length", "height", "weight", "volume_m3"], "size").fit(parts), path)
    scored = M.score(sinks.load_pipeline(path), parts)
    return scored.select("p_partkey", "predicted")
