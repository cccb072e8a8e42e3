"""What several operators share: the shared folder, written tables and connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Bytes of rows that a Python worker is handed at a time.
BATCH_BYTES = "8m"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Where it is unset, a local session gets a temporary folder and a cluster an error: executors
    would each write to their own disk.
    """
    context = spark.sparkContext
    shared = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="llm-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared)
    return shared.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Hand Python workers few bytes at a time, so that very long texts do not add up in a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def trimmed(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``run``, a function over a task's batches, that hands free memory back to the system when it ends.

    Workers are used again and wait in between; what their allocators keep would add up with the next stage's.
    """

    def wrapped(batches: Iterator, *args) -> Iterator:
        try:
            yield from run(batches, *args)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries have none
    if trim:
        trim(0)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, its rows in the shared folder, its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, read again by column.

    The table lies under a name of its own, so a second run never meets the first one's files.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links (a, b)``: ``(node, root)``, root the least node.

    Large and small stars in turn until nothing changes. The least neighbour is found by a minimum
    that is combined before the shuffle, so a hub costs one row per task there; its links meet that
    minimum in a join of its own, which AQE splits. Nodes without a link to another node are not returned.
    """
    edges = checkpointed(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = checkpointed(both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low")))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = checkpointed(large)
        low = checkpointed(large.groupBy("a").agg(F.min("b").alias("low")))
        met = large.join(low, "a")
        small = met.select("a", F.col("low").alias("b")).unionByName(
            met.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        edges = checkpointed(small.distinct())
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())
