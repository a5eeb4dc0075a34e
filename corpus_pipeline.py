"""A training corpus from raw documents: toxicity, near-duplicates, benchmark passages, mixing, shards."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaworks.llm import curriculum, decontaminate, minhash, recurrent, ring
from plazaworks.llm.common import written
from plazaworks.llm.registry import table
from plazaworks.session import configure

SHARDS = 24
TOXIC = 0.5  # least score of a document that goes


def _fresh(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``docs`` bears."""
    longest = max(len(c) for c in docs.columns)
    taken = {c.lower() for c in docs.columns}
    return [n if n not in taken else n + "_" * longest for n in names]


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not among ``dropped``; rows without one stay."""
    return docs.join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose most toxic window scores below one half, learned from the labels of the folder."""
    model = recurrent.toxicity_model(docs, table(configure(spark), sf_dir, "labels", "doc_id", "toxic"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("row"), recurrent.scorer(model)("text").alias("score")).where(F.col("score") < TOXIC).select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group."""
    return _without(docs, minhash.near_duplicates(docs).where("not kept"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any window of a benchmark item, each judged by its own text."""
    return decontaminate.without_benchmark(docs, table(configure(spark), sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix begins them, in training order."""
    mixed = curriculum.mix(docs.select("doc_id", "text", "source")).where("passes > 0")
    # rows that share a doc_id are taken alike, as often as the one taken most
    taken_id, position = _fresh(docs, "taken_id", "training_position")
    taken = mixed.groupBy(F.col("doc_id").alias(taken_id)).agg(F.max("passes").alias("passes"), F.min("position").alias("p"), F.min("later_position").alias("q"))
    taken = taken.select(taken_id, F.explode(F.slice(F.array("p", "q"), F.lit(1), F.col("passes"))).alias(position))
    joined = docs.join(taken, docs["doc_id"].eqNullSafe(taken[taken_id]))
    return joined.orderBy(position, taken_id).select(*[docs[c] for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row, with its place in training order: the part of the mix that it stands in, and its row there.

    The mix is written sorted by position, so parts and rows number the order;
    within a shard, rows are read by them. Rows that come from no file have no
    place.
    """
    part, row = _fresh(docs, "training_part", "training_row")
    try:
        placed = docs.withColumns({part: F.col("_metadata.file_name"), row: F.col("_metadata.row_index")})
    except AnalysisException as e:  # rows that were never written have no such column
        if not (e.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            raise
        placed = docs.withColumns({part: F.lit(None).cast("string"), row: F.lit(None).cast("long")})
    out = ring.bounded_ring(placed, SHARDS, keep=(part, row))
    return out.withColumnsRenamed({part: "training_part", row: "training_row"})


STAGES = [("toxicity", drop_toxic), ("near duplicates", one_of_each_group), ("decontamination", drop_benchmark), ("mixing", mix_sources), ("sharding", shard)]
ORACLE_SQL = None  # the first stage is a learned network


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``; what each keeps is written to the shared folder and read again."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
