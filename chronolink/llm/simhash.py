"""SimHash near-duplicates: a binary trie of fingerprints joined with itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolink.llm.common import checkpointed, components, trimmed, whole_text

BUDGET = 3
SEED = 42
CHUNK = 1 << 16
#: Rows of a key from which its rows get a longer key. It steers memory; the links are the same.
SPLIT_ROWS = 50_000
LEVELS = 4


def fingerprint(text: str, shingle: int = 3) -> int:
    """64 bits; each is set where over half the shingles' hashes have it set. No words: zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, CHUNK):
        part = words[start : start + CHUNK + shingle - 1]
        grams = zip(*(part[i:] for i in range(shingle))) if len(words) >= shingle else [words]
        hashes = [xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` for each row of ``docs``, fp the fingerprint as a signed long. Null texts: zero."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select("doc_id", F.pandas_udf(run, "long")(whole_text()).alias("fp"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(level: int, budget: int = BUDGET) -> list[int]:
    """Bits that make up the key of each path. Level 0 cuts the 64 bits into ``budget + 1`` blocks, one
    a path; each further level cuts what a path leaves free in as many again and adds one. Two
    fingerprints within the budget agree on at least one path of every level."""
    parts = budget + 1
    found = [0]
    for _ in range(level + 1):
        longer = []
        for mask in found:
            free = [b for b in range(63, -1, -1) if not mask >> b & 1]
            for k in range(parts):
                longer.append(mask | sum(1 << b for b in free[k * len(free) // parts : (k + 1) * len(free) // parts]))
        found = longer
    return found


def _masked(path: Column, level: int, budget: int) -> Column:
    choices = F.array(*[F.lit(_signed(m)) for m in masks(level, budget)])
    return F.col("fp").bitwiseAND(F.element_at(choices, path + 1))


def keyed(nodes: DataFrame, budget: int = BUDGET, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """``nodes (fp)`` under keys ``(level, path, key)`` that each linked pair shares at least once.

    A key with over ``split_rows`` rows is replaced by longer ones, so a dense region of the space is
    spread as well. At the last level a key leaves at most 21 bits free, which bounds its rows.
    """
    parts = budget + 1
    path = F.explode(F.array(*[F.lit(k) for k in range(parts)]))
    level0 = nodes.select("fp", path.alias("path"))
    pending = level0.select("fp", F.lit(0).alias("level"), "path", _masked(F.col("path"), 0, budget).alias("key"))
    done = None
    for level in range(LEVELS):
        if level == LEVELS - 1:
            break
        hot = pending.groupBy("path", "key").count().filter(F.col("count") > split_rows).select("path", "key")
        hot = checkpointed(hot)
        if hot.isEmpty():
            break
        cold = pending.join(hot, ["path", "key"], "left_anti").select("fp", "level", "path", "key")
        done = cold if done is None else done.unionByName(cold)
        child = F.explode(F.array(*[F.col("path") * parts + k for k in range(parts)]))
        pending = (
            pending.join(hot, ["path", "key"], "left_semi")
            .select("fp", F.lit(level + 1).alias("level"), child.alias("path"))
            .withColumn("key", _masked(F.col("path"), level + 1, budget))
        )
    pending = pending.select("fp", "level", "path", "key")
    return pending if done is None else done.unionByName(pending)


def trie_forest(values: np.ndarray, starts: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """For each value the position of the least one it is connected with by links inside its group.

    ``values`` are unsigned, sorted and distinct within each group; ``starts`` are the groups' first
    positions. A node of a group's binary trie is a range of positions. Pairs of nodes go down
    together, bit by bit; a pair that has differed more often than the budget is left, and so is one
    whose fingerprints are all connected already. Pairs wait on a stack in chunks, so memory stays
    bounded.
    """
    n = len(values)
    parent = np.arange(n)
    ends = np.append(starts[1:], n)
    many = ends - starts > 1
    first = np.stack([starts[many], ends[many], starts[many], ends[many], np.zeros(many.sum(), np.int64)])
    ones: dict[int, np.ndarray] = {}
    stack = [(63, first[:, i : i + CHUNK]) for i in range(0, first.shape[1], CHUNK)]
    while stack:
        bit, pairs = stack.pop()
        a, a2, b, b2, spent = pairs
        change = np.concatenate([[0], np.cumsum(parent[1:] != parent[:-1])])
        joined = (parent[a] == parent[b]) & (change[a] == change[a2 - 1]) & (change[b] == change[b2 - 1])
        a, a2, b, b2, spent = pairs[:, ~joined]
        leaf = (a2 - a == 1) & (b2 - b == 1)
        if leaf.any():
            x, y = a[leaf], b[leaf]
            near = np.bitwise_count(values[x] ^ values[y]) <= budget
            _connect(parent, x[near], y[near])
            a, a2, b, b2, spent = (v[~leaf] for v in (a, a2, b, b2, spent))
        if not len(a) or bit < 0:
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum(values >> np.uint64(bit) & np.uint64(1))]).astype(np.int64)
        count = ones[bit]
        am, bm = a2 - (count[a2] - count[a]), b2 - (count[b2] - count[b])
        same = a == b
        down = np.concatenate([
            np.stack([a, am, b, bm, spent]), np.stack([am, a2, bm, b2, spent]), np.stack([a, am, bm, b2, spent + 1]),
            np.stack([am, a2, b, bm, spent + 1])[:, ~same],
        ], axis=1)
        keep = (down[0] < down[1]) & (down[2] < down[3]) & (down[4] <= budget)
        keep &= (down[0] != down[2]) | (down[1] - down[0] > 1)
        down = down[:, keep]
        stack += [(bit - 1, down[:, i : i + CHUNK]) for i in range(0, down.shape[1], CHUNK)][::-1]
    return parent


def _connect(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Union of x and y; afterwards each entry of ``parent`` is the least position of its set."""
    while True:
        p, q = parent[x], parent[y]
        apart = p != q
        if not apart.any():
            return
        np.minimum.at(parent, np.maximum(p[apart], q[apart]), np.minimum(p[apart], q[apart]))
        while not np.array_equal(step := parent[parent], parent):
            parent[:] = step


def _links_of(batches: Iterator[pd.DataFrame], budget: int, gather: int = 200_000) -> Iterator[pd.DataFrame]:
    """Links of rows sorted by key and fingerprint; a key's rows are taken together, many keys at a time."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        starts = np.flatnonzero(_changes(rows))
        fp = rows.fp.to_numpy()
        parent = trie_forest(fp.view(np.uint64), starts, budget)
        linked = np.flatnonzero(parent != np.arange(len(parent)))
        return pd.DataFrame({"a": fp[linked], "b": fp[parent[linked]]})

    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < gather:
            continue
        rows = pd.concat(held, ignore_index=True)
        cut = int(np.flatnonzero(_changes(rows))[-1])
        if cut:
            yield solve(rows[:cut])
        held = [rows[cut:]]
    if held and sum(map(len, held)):
        yield solve(pd.concat(held, ignore_index=True))


def _changes(rows: pd.DataFrame) -> np.ndarray:
    """True at the first row of each key."""
    out = np.zeros(len(rows), bool)
    out[:1] = True
    for c in ("level", "path", "key"):
        v = rows[c].to_numpy()
        out[1:] |= v[1:] != v[:-1]
    return out


def links(nodes: DataFrame, budget: int = BUDGET, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints of ``nodes (fp)``.

    Enough of them that any two fingerprints within the budget are connected; a dense group costs as
    many links as it has members, not as it has pairs.
    """
    rows = keyed(nodes, budget, split_rows)
    # sorted as unsigned numbers: the sign bit is the trie's first
    dealt = rows.repartition("level", "path", "key").sortWithinPartitions("level", "path", "key", F.expr("fp < 0"), "fp")
    return dealt.mapInPandas(trimmed(lambda batches: _links_of(batches, budget)), "a LONG, b LONG").distinct()


def near_duplicates(docs: DataFrame, budget: int = BUDGET, shingle: int = 3, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """``(doc_id, fp, component_id)`` for each row: the least doc_id that links of at most ``budget``
    differing bits reach.

    Copies share a fingerprint and meet once, however many they are. Null and empty texts have
    fingerprint zero and are linked like others; a null doc_id gets a row and is never the least
    unless it is alone; repeated rows are returned repeatedly. Other columns are not read.
    """
    prints = checkpointed(fingerprints(docs, shingle))
    nodes = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    joined = nodes.join(
        components(links(nodes.select("fp"), budget, split_rows)).withColumnRenamed("node", "fp"), "fp", "left"
    ).withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    members = joined.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(members, "fp").select("doc_id", "fp", "component_id")
