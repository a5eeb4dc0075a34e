"""Scans and literal tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, path: str, cols: Sequence[str] | None = None, where: str | Column | None = None) -> DataFrame:
    """Columnar scan; the filter and the columns reach the reader.

    A filter on a partition column prunes folders.
    """
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*cols) if cols else df


def read_delimited_folder(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "|", encoding: str = "ISO-8859-1", name_glob: str | None = None
) -> DataFrame:
    """All delimited files of a folder with a stated schema (ids stay text)."""
    reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", encoding)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.csv(path)


def read_two_separators(spark: SparkSession, path: str, names: Sequence[str], seps: str = ",;", name_glob: str | None = None) -> DataFrame:
    """Files that use one of several separators, as text columns.

    The header line of each file is recognised by its first name.
    """
    reader = spark.read
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    lines = reader.text(path)
    parts = F.split("value", f"[{seps}]")
    rows = lines.select(*[F.trim(F.get(parts, F.lit(i))).alias(n) for i, n in enumerate(names)])
    return rows.where(F.col(names[0]).isNull() | (F.col(names[0]) != names[0]))


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Name of the file each row was read from."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def normalize_headers(df: DataFrame, rename: dict[str, str] | None = None, underscores: bool = False) -> DataFrame:
    """Trim column names, optionally blank their underscores, then rename."""
    clean = [c.strip().replace("_", " ") if underscores else c.strip() for c in df.columns]
    out = df.toDF(*clean)
    return out.withColumnsRenamed(rename) if rename else out


def literal_table(spark: SparkSession, values: Sequence, name: str, dtype: str = "string") -> DataFrame:
    """A list in the program as a one-column table (a local relation, its size is the list's)."""
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")
