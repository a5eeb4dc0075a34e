"""Sources, sinks, streams."""

import os

from pyspark.sql import functions as F

from plazaworks.sources import readers as R
from plazaworks.sources import sinks as W
from plazaworks.streaming import watch


def test_two_separators(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("id;name\n2;y\n")
    rows = R.read_two_separators(spark, str(tmp_path), ["id", "name"], name_glob="*.csv").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "x"), ("2", "y")]


def test_months_are_folders_and_prune(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-05", 1), ("2024-02-01", 2), ("2024-02-09", 3)], "d string, v int").withColumn("d", F.col("d").cast("date"))
    W.publish_monthly(df, "d", str(tmp_path / "m"))
    assert {"ym=2024-01", "ym=2024-02"} <= set(os.listdir(tmp_path / "m"))
    back = R.scan(spark, str(tmp_path / "m"), ["v"], F.col("ym") == "2024-02")
    assert sorted(r["v"] for r in back.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(ym" in back._jdf.queryExecution().executedPlan().toString()


def test_lines_keep_their_order(spark, tmp_path):
    details = spark.createDataFrame([(i, f"d{i}") for i in range(1, 30)], "ordinal long, line string")
    header = spark.createDataFrame([("head",)], "line string")
    W.write_lines(W.with_header(header, details), str(tmp_path / "t"))
    parts = sorted(f for f in os.listdir(tmp_path / "t") if f.startswith("part"))
    text = "".join((tmp_path / "t" / f).read_text() for f in parts).split()
    assert text == ["head"] + [f"d{i}" for i in range(1, 30)]


def test_csv_and_publish(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2)], "x int, y string, z int")
    W.write_csv(df, ["y", "x"], str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["y", "x"]
    for _ in range(2):
        W.publish(df, str(tmp_path / "p"))
    assert R.scan(spark, str(tmp_path / "p")).count() == 1


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` a_b ` int, c int")
    assert R.normalize_headers(df, {"c": "d"}, underscores=True).columns == ["a b", "d"]


def test_stream_publishes_each_order_once(spark, tmp_path):
    src = str(tmp_path / "in")
    schema = "order_id long, status string, address string, ts timestamp"
    make = lambda rows: spark.createDataFrame(rows, "order_id long, status string, address string, t string").select(
        "order_id", "status", "address", F.to_timestamp("t").alias("ts"))
    make([(1, "Canceled", "a@b.c", "2024-01-01 00:00:00"), (2, "Open", "a@b.c", "2024-01-01 00:00:00")]).write.mode("append").parquet(src)

    def run():
        rows = watch.alerts(watch.landed(spark, src, schema), "status", ["Canceled"], "address", ["order_id", "ts"])
        watch.publish_alerts(rows, str(tmp_path / "out"), str(tmp_path / "state"), ["order_id"], every=None).awaitTermination()
        return sorted(r["order_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == [1]
    make([(1, "Canceled", "a@b.c", "2024-01-01 01:00:00"), (3, "Canceled", "none", "2024-01-01 01:00:00"), (4, "Canceled", "x@y.z", "2024-01-01 01:00:00")]).write.mode("append").parquet(src)
    assert run() == [1, 4]
    # a repeat after eight days is not told again, and a row that comes late, twice and with another time is told once
    make([(9, "Canceled", "a@b.c", "2024-02-01 00:00:00")]).write.mode("append").parquet(src)
    assert run() == [1, 4, 9]
    make([(1, "Canceled", "a@b.c", "2024-02-09 00:00:00"), (5, "Canceled", "a@b.c", "2023-12-01 00:00:00"), (5, "Canceled", "a@b.c", "2023-12-02 00:00:00")]).write.mode("append").parquet(src)
    assert run() == [1, 4, 5, 9]
    # a lost checkpoint reads all files again and tells nothing twice
    rows = watch.alerts(watch.landed(spark, src, schema), "status", ["Canceled"], "address", ["order_id", "ts"])
    watch.publish_alerts(rows, str(tmp_path / "out"), str(tmp_path / "other"), ["order_id"], every=None).awaitTermination()
    assert run() == [1, 4, 5, 9]


def test_files_follow_the_size_of_a_month(spark, tmp_path):
    """One month holds almost all rows: it is cut into files of about one size, the small ones are one file each."""
    df = spark.range(400_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.when(F.col("id") % 100 == 0, 31 * (F.col("id") / 100 % 11).cast("int") + 40).otherwise(0)).alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m", "spark.sql.shuffle.partitions": "256"}
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        W.publish_monthly(df, "d", str(tmp_path / "m"))
        W.publish_per_key(df.withColumn("k", F.substring("v", 1, 1)), "k", str(tmp_path / "k"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = lambda p: [os.path.getsize(p / f) for f in os.listdir(p) if f.endswith(".parquet")]
    months = {m: files(tmp_path / "m" / m) for m in os.listdir(tmp_path / "m") if m.startswith("ym=")}
    large = months.pop("ym=2024-01")
    assert len(large) >= 4 and max(large) < 2.5 * sorted(large)[len(large) // 2]
    # a small month whose hash falls on the large one's partition is cut with it
    assert len(months) > 8 and sum(len(f) > 1 for f in months.values()) <= 1
    assert R.scan(spark, str(tmp_path / "m")).count() == 400_000
    keys = [files(tmp_path / "k" / k) for k in os.listdir(tmp_path / "k") if k.startswith("k=")]
    assert len(keys) == 16 and max(map(len, keys)) <= 2
