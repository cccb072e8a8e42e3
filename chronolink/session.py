"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "chronolink", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Partition counts are left to the cluster and to AQE; pass ``conf`` to override.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table or a stream checkpoint.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``. Where that is unset, a
    local session (tests, a laptop) gets a temporary folder, and a cluster an error: each executor
    would write to a disk of its own.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="chronolink-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a table in the shared folder; joins after it know its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, *order: str, ranges: int | None = None) -> DataFrame:
    """Rows in ranges of the first ``ranges`` columns of ``order`` (of all, if None), each sorted by ``order``.

    Bounds of ranges come from a sample, for which Spark runs the whole plan below the exchange once more. So
    rows are stored first: what they cost is paid once, and the sample reads a table.
    """
    return stored(df, "ordered").repartitionByRange(*order[:ranges]).sortWithinPartitions(*order)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Statements begun inside drop their shuffle files as they end.

    Otherwise files stay until the driver collects garbage, which rounds that each store their rows do not wait for.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
