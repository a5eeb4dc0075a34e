"""Full-refresh tables, monthly and per-key files, fixed-width text, models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import zero_pad


def publish(df: DataFrame, path: str) -> None:
    """Replace a report snapshot."""
    df.write.mode("overwrite").parquet(path)


def publish_table(df: DataFrame, name: str) -> None:
    """Replace a report table of the catalog."""
    df.write.mode("overwrite").saveAsTable(name)


def _by_size(df: DataFrame, column: str) -> DataFrame:
    """Rows dealt by a column, small values together and large ones cut by their bytes at run time.

    The size aimed at is ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    (of the rows in memory, a few times that of the files).  A small value that
    shares its shuffle partition with a large one is cut with it.
    """
    return df.hint("rebalance", F.col(column))


def publish_monthly(df: DataFrame, date_col: str, path: str, month: str = "ym") -> None:
    """One folder per month in a single job.

    How many files a month has follows from its size, so that a month that holds
    most of the data is written by many tasks and a small one by a single task.
    """
    _by_size(df.withColumn(month, F.date_format(date_col, "yyyy-MM")), month).write.mode("overwrite").partitionBy(month).parquet(path)


def publish_per_key(df: DataFrame, key: str, path: str, fmt: str = "parquet") -> None:
    """One folder per key value; large keys are written by several tasks, by their size."""
    _by_size(df, key).write.mode("overwrite").partitionBy(key).format(fmt).save(path)


def write_csv(df: DataFrame, cols: Sequence[str], path: str) -> None:
    """CSV export of selected columns."""
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def fixed_width(*fields: tuple[Column | str, int | None]) -> Column:
    """One text line: numbers zero-padded to their width, ``None`` takes the text as it is."""
    parts = []
    for value, width in fields:
        v = F.col(value) if isinstance(value, str) else value
        parts.append(v.cast("string") if width is None else zero_pad(v, width))
    return F.concat(*parts)


def money_digits(amount, width: int) -> Column:
    """Amount as zero-padded digits with two decimals and no point."""
    cents = F.regexp_replace(F.col(amount).cast("decimal(20,2)").cast("string"), r"\.", "")
    return zero_pad(cents, width)


def with_header(header: DataFrame, details: DataFrame, line: str = "line", order: str = "ordinal") -> DataFrame:
    """Header record and detail records as one table; the ordinal keeps them apart."""
    return header.select(line, F.lit(0).cast("bigint").alias(order)).unionByName(details.select(line, order))


def write_lines(df: DataFrame, path: str, line: str = "line", order: str = "ordinal") -> None:
    """Text files in ordinal order (range partitions, so file order is line order)."""
    df.repartitionByRange(F.col(order)).sortWithinPartitions(order).select(line).write.mode("overwrite").text(path)


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
