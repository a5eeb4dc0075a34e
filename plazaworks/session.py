"""Session settings and the lineage cut shared by long jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings the operators are designed for.  Everything here can be
# set on a live session, so a cluster keeps its own sizing (memory, partitions).
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a third of all rows may carry one key: let AQE split that key's join
    # partition even where the split costs one more exchange further up
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # rows hold whole texts: few of them at a time between the JVM and Python
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors can read and write.

    It lies below the folder the session names in ``spark.checkpoint.dir``; only
    where none is set, on a single machine, a scratch folder is made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="run-")


#: Rows of a task whose work is much larger than its reading, and the most tasks that such rows are dealt to.
ROWS_PER_TASK, MOST_TASKS = 8192, 4096


def spread(df: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` dealt to tasks by its number of rows, for work that is large per row.

    A file with one row group is read by one task, however many rows it has.  A
    table that fits a task stays as it is.
    """
    tasks = min(-(-df.count() // rows), MOST_TASKS)
    return df.repartition(tasks) if tasks > 1 else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its plan."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def store(df: DataFrame | Iterable[DataFrame]) -> DataFrame:
    """``df`` written to the shared folder and read back; what was shuffled for it leaves the disks at once.

    A table may come in pieces: they are made one after another, so what one
    needs is gone before the next begins.
    """
    paths, clean = [], "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    for piece in [df] if isinstance(df, DataFrame) else df:
        spark, schema = piece.sparkSession, piece.schema
        paths.append(shared_folder(spark))
        before = spark.conf.get(clean, None)
        spark.conf.set(clean, "true")
        try:
            piece.select("*").write.option("compression", "zstd").parquet(paths[-1])
        finally:
            spark.conf.unset(clean) if before is None else spark.conf.set(clean, before)
    return spark.read.schema(schema).parquet(*paths)


#: Pieces that a join of large stored tables is made in.
SLICES = 4


def in_slices(make: Callable[[Callable[..., Column]], DataFrame]) -> DataFrame:
    """``make(mine)`` for one slice after another, stored; ``mine(columns)`` is true for the rows of a slice.

    For joins and groups that meet on those columns: each row meets the same
    rows as in one piece, and a fraction of both sides is shuffled at a time.
    """
    mine = lambda k: lambda *cols: F.pmod(F.xxhash64(F.lit("slice"), *cols), F.lit(SLICES)) == k
    return store(make(mine(k)) for k in range(SLICES))


def discard(df: DataFrame) -> None:
    """Remove the files of a stored table that nothing will read again."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(sc._jvm.java.net.URI(folder))
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
