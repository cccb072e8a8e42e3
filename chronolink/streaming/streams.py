"""The extract jobs on arriving pages."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from chronolink.operators.pages import REVISION
from chronolink.plans.articles import extract_pairs
from chronolink.session import scratch_path


def _start(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_pairs(pages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Pairs of new pages. Stateless: the batch plan as it is, exactly once through the file sink."""
    return _start(extract_pairs(pages), path, checkpoint)


def dedupe_stream(
    pages: DataFrame, event_time: str | None = None, delay: str = "1 day"
) -> DataFrame:
    """Each revision once, however many files hold it.

    With an arrival-time column the state is bounded: a key is forgotten ``delay`` after it was seen.
    """
    if event_time is None:
        return pages.dropDuplicates(REVISION)
    return pages.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(REVISION)


def stream_dedupe(
    pages: DataFrame, path: str, checkpoint: str, event_time: str | None = None, delay: str = "1 day"
) -> StreamingQuery:
    """Write each revision once."""
    return _start(dedupe_stream(pages, event_time, delay), path, checkpoint)


def stream_incremental(
    pages: DataFrame, stored: DataFrame, path: str, checkpoint: str
) -> StreamingQuery:
    """Extract only revisions that are neither in ``stored`` nor extracted by an earlier batch.

    A batch goes to a folder named after its checkpoint and its number, with its keys beside it in
    ``<path>-keys``: repeated, it overwrites itself; a new checkpoint begins folders of its own and
    finds what older ones have written. One writer at a time.
    """
    spark = pages.sparkSession
    done = f"{path.rstrip('/')}-keys"
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    keys = stored.select(*REVISION)
    # so that there is a table to read before the first batch
    keys.limit(0).withColumns({"run": F.lit(""), "batch_id": F.lit(-1)}).write.mode("append").partitionBy(
        "run", "batch_id"
    ).parquet(done)
    schema = f"{', '.join(f'{c} {t}' for c, t in keys.dtypes)}, run STRING, batch_id LONG"

    def extract_batch(batch: DataFrame, batch_id: int) -> None:
        part = f"run={run}/batch_id={batch_id}"
        own = (F.col("run") == run) & (F.col("batch_id") == batch_id)
        earlier = spark.read.schema(schema).parquet(done).filter(~own).select(*REVISION)
        known = keys.unionByName(earlier)
        fresh = batch.dropDuplicates(REVISION).join(known, REVISION, "left_anti")
        extract_pairs(fresh).write.mode("overwrite").parquet(f"{path}/{part}")
        fresh.select(*REVISION).write.mode("overwrite").parquet(f"{done}/{part}")

    return (
        pages.writeStream.foreachBatch(extract_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Buckets that revisions are dealt into by hash; a bucket is one entry of the state. A checkpoint is bound to it.
BUCKETS = 2_048


class _FirstSeen(StatefulProcessor):
    """Lets the first page of a revision pass that was not known before. The state lists the revisions of a bucket:
    each look at the state is a message to the JVM and back, which a revision alone does not pay for."""

    def __init__(self, columns: list[str], state: str):
        self._page, self._state = Row(*columns), state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._known = handle.getValueState("known", self._state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self._known.get()
        known = set(zip(*state)) if state else set()
        before = len(known)
        for row in rows:
            revision = tuple(row[c] for c in REVISION)
            if revision not in known:
                known.add(revision)
                yield self._page(*[row[c] for c in self._page])
        if len(known) > before:
            self._known.update(tuple(map(list, zip(*known))))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self._known.update(tuple(list(initialState[c]) for c in REVISION))

    def close(self) -> None:
        pass


def fresh_pages(pages: DataFrame, stored: DataFrame) -> DataFrame:
    """Arriving pages whose revision is neither in ``stored`` nor came before, each revision once.

    The keys of ``stored`` are the state that the first batch starts from; from then on a batch meets only
    the state of the buckets its own keys fall into, whatever has piled up elsewhere. Needs RocksDB as the state
    store, as ``stream_seeded`` sets it. Of a revision that comes more than once in a batch an arbitrary row passes.
    Null keys are keys.
    """
    types = {f.name: f.dataType.simpleString() for f in pages.schema if f.name in REVISION}
    bucket = F.pmod(F.xxhash64(*REVISION), F.lit(BUCKETS)).alias("_bucket")
    keys = stored.select(*[F.col(c).cast(types[c]).alias(c) for c in REVISION]).distinct()
    listed = F.collect_list(F.struct(*REVISION))  # a struct keeps null keys in their place
    seed = keys.groupBy(bucket).agg(listed.alias("known")).select("_bucket", *[F.col("known")[c].alias(c) for c in REVISION])
    processor = _FirstSeen(pages.columns, ", ".join(f"{c} ARRAY<{types[c]}>" for c in REVISION))
    return pages.select("*", bucket).groupBy("_bucket").transformWithState(
        processor, pages.schema, outputMode="Append", timeMode="None", initialState=seed.groupBy("_bucket")
    )


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stream_seeded(pages: DataFrame, stored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Extract only revisions that are neither in ``stored`` nor extracted before, by keyed state.

    Unlike ``stream_incremental`` no batch after the first reads any earlier key, and the file sink writes each
    pair exactly once; page texts of fresh revisions are shuffled by key. ``stored`` counts when the
    checkpoint is new: another checkpoint starts from what ``stored`` holds then.
    """
    with _setting(pages.sparkSession, _PROVIDER, _ROCKSDB):  # a started query keeps its own copy
        return _start(extract_pairs(fresh_pages(pages, stored)), path, checkpoint)


def run_to_end(spark: SparkSession, start, name: str) -> DataFrame:
    """Run a stream over what is there and give its output back as a table."""
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    start(path, checkpoint).awaitTermination()
    return spark.read.parquet(path)
