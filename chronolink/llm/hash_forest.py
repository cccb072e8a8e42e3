"""Approximate nearest neighbours: a hash-prefix forest.

Each tree gives a vector a long string of symbols; the symbol of a random rotation is the axis it lies
closest to and the side. Sorted strings are the tree: rows with a common prefix are neighbours in the
array. For a query the longest prefix is taken whose runs, in all trees together, hold enough candidates;
all rows of these runs are scored, however long they are and however many shards they lie in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolink.llm.common import checkpointed, written

TREES = 40
SYMBOLS = 4
K = 20
#: Candidates over all trees, counted with repeats, that the runs of a query hold at least; a table that
#: grows asks for as large a share of its rows, so that recall does not fall with its size.
CANDIDATES = 12_000
SHARE = 0.25
#: Rows and queries multiplied at a time. It steers memory, not the result.
BLOCK = 4_096
ASKED = 256
SHARD_ROWS = 40_000
SAMPLE_ROWS = 20_000
SALT_BITS = 20


def candidates(n: int) -> int:
    """How many candidates a query asks for in a table of ``n`` rows."""
    return max(CANDIDATES, math.ceil(SHARE * n))


def rotations(dims: int, tree: int, symbols: int = SYMBOLS) -> list[np.ndarray]:
    rng = np.random.default_rng([17, tree])
    return [np.linalg.qr(rng.normal(size=(dims, dims)))[0] for _ in range(symbols)]


def strings(vectors: np.ndarray, tree: int, symbols: int = SYMBOLS) -> np.ndarray:
    """The symbol strings of a tree as numbers, the first symbol in the highest place."""
    key = np.zeros(len(vectors), np.int64)
    rows = np.arange(len(vectors))
    for rotation in rotations(vectors.shape[1], tree, symbols):
        turned = vectors @ rotation
        axis = np.abs(turned).argmax(axis=1)
        key = key * (2 * vectors.shape[1]) + 2 * axis + (turned[rows, axis] > 0)
    return key


def lifted(vectors: np.ndarray, most: float) -> np.ndarray:
    """One more coordinate that brings all norms to the greatest, so that the nearest by angle is the
    largest inner product; queries get zero there."""
    rest = np.maximum(0.0, most * most - (vectors * vectors).sum(axis=1))
    return np.column_stack([vectors, np.sqrt(rest)])


def valid(rows: DataFrame) -> DataFrame:
    """``(vec_id, vector)``: rows that take part, vectors as doubles. Null ids, null or zero vectors,
    null or non-finite components and vectors not of the commonest length take no part."""
    vector = F.col("embedding").cast("array<double>")
    parts = rows.select("vec_id", vector.alias("vector")).filter("vec_id IS NOT NULL AND size(vector) > 0")
    parts = parts.filter(
        "forall(vector, x -> x IS NOT NULL AND x = x AND abs(x) < double('infinity')) AND exists(vector, x -> x <> 0)"
    )
    common = parts.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    return parts.filter(F.size("vector") == (common.dims if common else 0))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores and their ids, ties to the smaller id."""
    if len(ids) > k:
        least = np.partition(scores, len(ids) - k)[len(ids) - k]
        among = np.flatnonzero(scores >= least)
        scores, ids = scores[among], ids[among]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def salted(key: np.ndarray, ids: np.ndarray, bits: int) -> np.ndarray:
    """Keys followed by bits of the id's hash, so that rows of one key can be cut into shards."""
    mixed = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (key << bits) | (mixed >> np.uint64(64 - bits)).astype(np.int64) if bits else key


def _blocks(part: np.ndarray, query: bool, lo: np.ndarray, hi: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> pd.DataFrame:
    """One row per shard, in which all that goes there from a batch lies end to end."""
    order = np.argsort(part, kind="stable")
    shards, begins = np.unique(part[order], return_index=True)
    cut = lambda values: [np.ascontiguousarray(x).tobytes() for x in np.split(values[order], begins[1:])]
    return pd.DataFrame({
        "part": shards.astype(np.int32), "query": query, "lo": cut(lo), "hi": cut(hi) if query else [b""] * len(shards),
        "id": cut(ids), "packed": cut(vectors),
    })


def _search(batches: Iterator[pd.DataFrame], width: str, k: int) -> Iterator[pd.DataFrame]:
    """The best k rows of a shard for each query sent there, among those from its ``lo`` to below its ``hi``.

    The blocks of the shard's rows come first, those of the queries follow."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    longs = lambda block: np.frombuffer(block, np.int64)
    unpacked = lambda block, n: np.frombuffer(block, width).reshape(n, -1).astype(np.float64)
    vectors = key = ids = None
    for batch in batches:
        out = []
        for query, lo, hi, some, packed in zip(batch["query"], batch.lo, batch.hi, batch.id, batch.packed):
            lows, named = longs(lo), longs(some)
            if not query:
                held.append((lows, named, unpacked(packed, len(named))))
                continue
            if not held:
                continue
            if vectors is None:
                key, ids, vectors = (np.concatenate(x) for x in zip(*held))
                order = np.lexsort((ids, key))
                key, ids, vectors = key[order], ids[order], vectors[order]
                held = held[:1]
            asked = unpacked(packed, len(named))
            bounds, group = np.unique(np.column_stack([lows, longs(hi)]), axis=0, return_inverse=True)
            order = np.argsort(group.ravel(), kind="stable")
            for (low, high), same in zip(bounds, np.split(order, np.cumsum(np.bincount(group.ravel()))[:-1])):
                a, b = np.searchsorted(key, [low, high])
                for at in range(0, len(same) if a < b else 0, ASKED):
                    part = same[at : at + ASKED]
                    best = [(np.zeros(0), np.zeros(0, np.int64))] * len(part)
                    for c in range(a, b, BLOCK):
                        scores = asked[part] @ vectors[c : min(b, c + BLOCK)].T
                        near = ids[c : min(b, c + BLOCK)]
                        for i, (s, found) in enumerate(best):
                            s2, found2 = _best(scores[i], near, k)
                            best[i] = _best(np.append(s, s2), np.append(found, found2), k) if len(s) else (s2, found2)
                    out += [(q, found, s) for q, (s, found) in zip(named[part].tolist(), best)]
        if out:
            yield pd.DataFrame(out, columns=["query", "ids", "scores"])


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = K, trees: int = TREES, symbols: int = SYMBOLS, enough: int | None = None,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries (vec_id, embedding)`` the k rows of
    ``rows (vec_id, embedding)`` of largest inner product found, its own id left out, ties to smaller ids.

    Every vector is indexed; only the bounds that cut the sorted arrays into shards come from a sample
    of ``SAMPLE_ROWS`` rows at most. ``enough`` is ``candidates`` of the table unless given; where not even
    the first symbols hold as many, all rows are scored. Equal vectors are one entry that lists its k + 1 least ids, more of
    which no result can hold. Repeated rows count once; without rows there are no results.
    """
    spark = rows.sparkSession
    near = Window.partitionBy("vector").orderBy("vec_id")
    # the rank is limited before rows are moved, so a common vector stays small
    members = (
        valid(rows).withColumn("place", F.dense_rank().over(near)).filter(F.col("place") <= k + 1).distinct()
        .withColumn("id", F.min("vec_id").over(Window.partitionBy("vector")))
    )
    members = written(members, "members")
    entries = members.filter("place = 1").select("id", "vector")
    asked = valid(queries).distinct().join(entries.withColumnRenamed("id", "entry"), "vector", "left")
    # a vector that is no row is its own entry, below all ids of rows
    asked = written(asked.select("vec_id", "vector", F.coalesce("entry", -F.lit(2) - F.abs("vec_id")).alias("entry")), "asked")
    stats = entries.agg(F.count("*").alias("n"), F.max(F.expr("aggregate(vector, 0D, (a, x) -> a + x * x)")).alias("most"), F.max(F.size("vector")).alias("dims")).first()
    schema = "query_id LONG, rank INT, vec_id LONG, score DOUBLE"
    if not stats.n:
        return spark.createDataFrame([], schema)
    most = float(np.sqrt(stats.most))
    single = all(t.schema["embedding"].dataType.simpleString() == "array<float>" for t in (rows, queries))
    width = "<f4" if single else "<f8"  # as the vectors are given; they are multiplied as doubles
    enough = candidates(stats.n) if enough is None else enough
    base = 2 * (stats.dims + 1)

    def keys(batch: pd.DataFrame, query: bool, tree: int, depth: int) -> np.ndarray:
        plain = np.stack(batch.vector.to_numpy()).astype(np.float64)
        high = np.column_stack([plain, np.zeros(len(plain))]) if query else lifted(plain, most)
        return strings(high, tree, depth)

    def runs(batches: Iterator[pd.DataFrame], depth: int) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            for tree in range(trees):
                prefix, n = np.unique(keys(batch, False, tree, depth), return_counts=True)
                yield pd.DataFrame({"tree": tree, "prefix": prefix, "n": n})

    def prefixes(batches: Iterator[pd.DataFrame], depth: int) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            for tree in range(trees):
                yield pd.DataFrame({"id": batch.id, "tree": tree, "prefix": keys(batch, True, tree, depth)})

    # a longer prefix holds no more rows, so a query goes down while its runs hold enough together
    sought = asked.select(F.col("entry").alias("id"), "vector").distinct()
    levels = sought.select("id", F.lit(0).alias("level"))
    going, deepest = sought, 0
    for depth in range(1, symbols + 1):
        sizes = entries.mapInPandas(lambda it, d=depth: runs(it, d), "tree INT, prefix LONG, n LONG")
        sizes = sizes.groupBy("tree", "prefix").agg(F.sum("n").alias("n"))
        mine = going.mapInPandas(lambda it, d=depth: prefixes(it, d), "id LONG, tree INT, prefix LONG")
        met = mine.join(sizes, ["tree", "prefix"]).groupBy("id").agg(F.sum("n").alias("met"))
        passed = checkpointed(met.filter(F.col("met") >= enough).select("id", F.lit(depth).alias("level")))
        if passed.isEmpty():
            break
        levels, deepest = levels.unionByName(passed), depth
        going = sought.join(passed.select("id"), "id")
    levels = levels.groupBy("id").agg(F.max("level").alias("level"))
    grown = trees if deepest else 1  # without a symbol the run of each tree is the table
    # symbols below those that a query went down to tell no runs apart
    bits = max(0, min(SALT_BITS, 62 - (base**deepest).bit_length()))
    pieces = -(-stats.n // SHARD_ROWS)
    cuts = [np.zeros(0, np.int64)] * grown
    if pieces > 1:
        share = min(1.0, SAMPLE_ROWS / stats.n)
        chosen = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
        sample = entries.filter(chosen).select("id", "vector").toPandas()
        for tree in range(grown if len(sample) else 0):
            order = np.sort(salted(keys(sample, False, tree, deepest), sample.id.to_numpy(), bits))
            cuts[tree] = order[[p * len(order) // pieces for p in range(1, pieces)]]

    def packed(batch: pd.DataFrame) -> np.ndarray:
        return np.stack(batch.vector.to_numpy()).astype(np.float64).astype(width)

    def deal_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            data, ids = packed(batch), batch.id.to_numpy().astype(np.int64)
            for tree in range(grown):
                key = salted(keys(batch, False, tree, deepest), ids, bits)
                yield _blocks(tree * pieces + np.searchsorted(cuts[tree], key, "right"), False, key, key, ids, data)

    def deal_queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A query goes to each shard that its run reaches into."""
        for batch in filter(len, batches):
            data, level, ids = packed(batch), batch.level.to_numpy(), batch.id.to_numpy().astype(np.int64)
            for tree in range(grown):
                span = np.array([base ** (deepest - d) for d in range(deepest + 1)], np.int64)[level]
                first = keys(batch, True, tree, deepest) // span * span
                lo, hi = np.where(level > 0, first << bits, 0), np.where(level > 0, (first + span) << bits, base**deepest << bits)
                a, b = np.searchsorted(cuts[tree], lo, "right"), np.searchsorted(cuts[tree], hi - 1, "right")
                n = np.where((level > 0) | (tree == 0), b - a + 1, 0)
                row = np.repeat(np.arange(len(batch)), n)
                part = tree * pieces + a[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                if len(row):
                    yield _blocks(part, True, lo[row], hi[row], ids[row], data[row])

    form = "part INT, query BOOLEAN, lo BINARY, hi BINARY, id BINARY, packed BINARY"
    dealt = entries.mapInPandas(deal_rows, form).unionByName(sought.join(levels, "id").mapInPandas(deal_queries, form))
    met = dealt.repartitionById(grown * pieces, F.col("part")).sortWithinPartitions("part", "query").mapInPandas(
        lambda it: _search(it, width, k + 1), "query LONG, ids ARRAY<LONG>, scores ARRAY<DOUBLE>"
    )
    pairs = met.select("query", F.explode(F.arrays_zip("ids", "scores")).alias("one")).select(
        "query", F.col("one.ids").alias("id"), F.col("one.scores").alias("score")
    )
    itself = asked.select(
        F.col("entry").alias("query"), F.col("entry").alias("id"), F.expr("aggregate(vector, 0D, (a, x) -> a + x * x)").alias("score")
    ).distinct()
    pairs = pairs.unionByName(itself.join(entries.select("id"), "id", "left_semi").select("query", "id", "score"))
    pairs = pairs.groupBy("query", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    pairs = pairs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1).drop("place")
    listed = pairs.join(members.select("id", "vec_id"), "id").select("query", "vec_id", "score")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    lists = listed.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    answers = asked.select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query")).join(lists, "query")
    own = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(own).alias("at", "f")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.vec_id").cast("long").alias("vec_id"), "f.score"
    )
