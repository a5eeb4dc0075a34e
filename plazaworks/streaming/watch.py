"""Watch a folder of landed order files and publish what must be told.

The reports poll a sheet every two minutes and write to the sellers of
cancelled orders.  As a stream, each file is read once; the published table
itself is the state that says which orders were told already.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def landed(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """Files of a folder as a stream."""
    return spark.readStream.schema(schema).format(fmt).load(path)


def alerts(orders: DataFrame, status: str, wanted: Sequence[str], address: str, cols: Sequence[str]) -> DataFrame:
    """Orders in one of the wanted states that have a usable address."""
    return orders.where(F.col(status).isin(list(wanted)) & F.col(address).contains("@")).select(*cols)


def published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The published table; empty before the first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def publish_alerts(rows: DataFrame, path: str, checkpoint: str, key: Sequence[str], every: str | None = "2 minutes") -> StreamingQuery:
    """Append each order's first alert to the table at ``path``; ``every=None`` handles what is there and stops.

    A batch is reduced to one row per key and loses the keys that the table
    already holds, so a repeat is never told again, however late it comes, and a
    late row is never lost.  A batch that is run again after a failure finds what
    it wrote before.  The join reads the key columns only; NULL keys are one key.
    """
    key = list(key)

    def publish(batch: DataFrame, _: int) -> None:
        told = published(batch.sparkSession, path, batch.schema).select(*[F.col(k).alias(f"_{k}") for k in key])
        first = batch.groupBy(*key).agg(F.min(F.struct(*batch.columns)).alias("_row")).select("_row.*")
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
        first.join(told, on, "left_anti").write.mode("append").parquet(path)

    writer = rows.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()
