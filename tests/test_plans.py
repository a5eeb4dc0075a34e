"""What the physical plans look like at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from plazaworks.operators import joins as J
from plazaworks.operators import keys as K
from plazaworks.operators import windows as W
from plazaworks.session import RUNTIME, configure

WRITERS = {"monthly_files", "delimited_files", "per_key_files", "watched_orders", "reloaded_model"}
MODELS = {"text_tfidf", "size_tree", "size_network", "component_variance"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - WRITERS - MODELS))
def test_no_products_and_no_row_python(spark, folder, name):
    p = plan(entry.queries()[name](spark, folder))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p


def test_first_rows_are_limited_before_the_shuffle(spark, folder):
    p = plan(entry.queries()["order_latest_status"](spark, folder))
    assert p.count("WindowGroupLimit") == 2
    assert p.index("Final") < p.index("Exchange") < p.index("Partial")


def test_filter_and_columns_reach_the_scan(spark, folder, capsys):
    entry.queries()["pruned_scan"](spark, folder).explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(o_orderdate" in text and "StringStartsWith(o_orderpriority" in text
    assert "o_custkey" not in text


def test_hot_key_join_is_split(spark):
    configure(spark)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        k = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000)
        df = spark.range(0, 60_000, 1, 8).select("id", k.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
        out = J.attach_group(df, ["k"], F.count(F.lit(1)).alias("n"))
        assert out.where(F.col("k") == -1).select(F.max("n")).collect()[0][0] == 20_000
        full = J.attach_group(df, ["k"], F.count(F.lit(1)).alias("n"))
        full.write.format("noop").mode("overwrite").save()
        full.collect()
        assert "skew=true" in plan(full)
    finally:
        for k in settings:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old["spark.sql.autoBroadcastJoinThreshold"])


def test_group_limit_keeps_hot_keys_small(spark):
    df = spark.range(0, 10_000, 1, 4).select((F.col("id") % 3).alias("k"), "id")
    assert "WindowGroupLimit" in plan(K.nth_per_key(df, ["k"], [F.asc("id")], 2))


def test_blocks_spread_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 40_000, 1, 8).select(F.lit("hot").alias("k"), "id")
        out = W.running_sum(df, ["k"], ["id"], "id", "s", F.floor(F.col("id") / 500))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40_000 and max(sizes) < 15_000
    finally:
        configure(spark)


def test_settings_are_applied(spark):
    configure(spark)
    assert all(spark.conf.get(k) == v for k, v in RUNTIME.items())
