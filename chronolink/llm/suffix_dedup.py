"""Suffix-array dedup: bytes of long strings that start in more than one place.

Whole corpora do not fit into suffix arrays, so equal strings are brought together first. Each window
of ``length`` bytes is filed under the least of its hashed grams; equal windows have equal least grams.
Neighbouring windows with one such anchor form a record. Records that occur whole more than once are
settled by their digest; records that share an anchor and differ meet in shards, where suffix arrays
(Larsson-Sadakane), common prefixes (Kasai) and binary search across shards find the equal windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolink.llm.common import checkpointed, trimmed, whole_text, written

LENGTH = 400
GRAM = 64
BLOCK = 1 << 18
SHARD = 1 << 19
#: Distinct records of an anchor from which they get longer anchors. It steers memory, not the result.
SPLIT_RECORDS = 8_000
FILTER_BITS = 1 << 24
_WORD = 32_768

_BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                                0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
ROWS = "doc_id LONG, k LONG, anchor LONG, s INT, e INT, p INT, rec BINARY"


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on."""
    h = _BYTES[data]
    for step, factor in enumerate(_STEP):
        m = 1 << step
        h = h[:-m] * factor + (h[m:] ^ (h[m:] >> np.uint64(29)))
    h = (h ^ (h >> np.uint64(32))) * _STEP[0]
    return h ^ (h >> np.uint64(29))


def _window_min(v: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    rest = width - span
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def anchored(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``(text, first window, last window, anchor position, anchor hash)`` of each record, as arrays.

    Every window of ``length`` bytes lies in exactly one record; of equal grams the first is the anchor.
    Long texts go through in blocks that overlap, short ones many to a block.
    """
    out: list[list[np.ndarray]] = []
    pieces, held = [], 0

    def flush() -> None:
        nonlocal pieces, held
        if not pieces:
            return
        data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        sizes = np.array([len(p[2]) for p in pieces])
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        hashes = _gram_hashes(data)
        low = np.uint64((1 << 20) - 1)
        packed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        at = (_window_min(packed, length - GRAM + 1) & low).astype(np.int64)
        piece = np.repeat(np.arange(len(pieces)), sizes)[: len(at)]
        start = np.arange(len(at))
        valid = start + length <= (begins + sizes)[piece]
        start, at, piece = start[valid], at[valid], piece[valid]
        cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])]))
        last = np.append(cut[1:], len(start)) - 1
        own, base = piece[cut], np.array([p[1] for p in pieces]) - begins
        out.append([
            np.array([p[0] for p in pieces])[own], start[cut] + base[own], start[last] + base[own],
            at[cut] + base[own], hashes[at[cut]].view(np.int64),
        ])
        pieces, held = [], 0

    for i, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - length + 1), BLOCK):
            part = text[begin : begin + BLOCK + length - 1]
            if len(part) >= length:
                if held + len(part) > BLOCK + length:
                    flush()
                pieces.append((i, begin, part))
                held += len(part)
    flush()
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))


def _data(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _base_rows(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [_data(t) for t in batch.text]
        row, s, e, p, anchor = anchored(texts, length)
        rec = [xxhash.xxh3_128_digest(texts[i][a : b + length]) for i, a, b in zip(row, s.tolist(), e.tolist())]
        yield pd.DataFrame({
            "doc_id": batch.doc_id.to_numpy()[row], "k": batch.k.to_numpy()[row], "anchor": anchor,
            "s": s, "e": e, "p": p, "rec": rec,
        })


def _narrowed(batches: Iterator[pd.DataFrame], length: int, level: int) -> Iterator[pd.DataFrame]:
    """Records cut by how far their windows reach beyond the anchor, each with all the bytes its windows
    are sure to share as its anchor. At the last level that is the whole window."""
    width = max(1, (length - GRAM + 1) >> (3 * level))
    for batch in batches:
        rows = []
        for doc_id, k, text, found in zip(batch.doc_id, batch.k, batch.text, batch.found):
            data = _data(text)
            for f in found:
                s, e, p = f["s"], f["e"], f["p"]
                while s <= e:
                    reach = (s + length - p - GRAM) // width
                    limit = p + GRAM + (reach + 1) * width - 1 - length
                    last = min(e, limit)
                    anchor = xxhash.xxh64_intdigest(data[limit : p + GRAM + reach * width], reach) - (1 << 63)
                    rows.append((doc_id, k, anchor, s, last, p, xxhash.xxh3_128_digest(data[s : last + length])))
                    s = last + 1
        yield pd.DataFrame(rows, columns=["doc_id", "k", "anchor", "s", "e", "p", "rec"])


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; prefix doubling that sorts only groups still tied.

    Sort keys hold a pair of ranks and the position in one number, for texts of up to ``2 ** 21`` bytes.
    """
    n = len(data)
    bits, low = np.uint64(21), np.uint64((1 << 21) - 1)
    ext = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(5, np.uint64)])
    key = np.arange(n, dtype=np.uint64)
    for j in range(4):  # four bytes of nine bits
        key |= ext[j : n + j] << np.uint64(21 + 9 * (3 - j))
    key = np.sort(key)
    sa = (key & low).astype(np.int64)
    key >>= bits
    rank = np.zeros(n + 1, np.int64)  # the end ranks lowest
    slots = np.arange(n)
    h = 4
    head = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.maximum.accumulate(np.where(head, slots, 0))
    rank[sa] = first + 1
    tied = ~(head & np.append(head[1:], True))
    active = slots[tied]
    while len(active):
        at = sa[active]
        key = (rank[at].astype(np.uint64) << np.uint64(42)) | (rank[np.minimum(at + h, n)].astype(np.uint64) << bits)
        key = np.sort(key | at.astype(np.uint64))
        at = (key & low).astype(np.int64)
        key >>= bits
        sa[active] = at
        head = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.maximum.accumulate(np.where(head, np.arange(len(active)), 0))
        rank[at] = active[first] + 1
        active = active[~(head & np.append(head[1:], True))]
        h *= 2
    return sa


def words_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; beyond the end: zeros."""
    ext = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data) + 8, np.uint64)
    for j in range(8):
        out |= ext[j : len(out) + j] << np.uint64(56 - 8 * j)
    return out


def common_prefixes(data: np.ndarray, sa: np.ndarray, words: np.ndarray, cap: int, lanes: int = 16_384) -> np.ndarray:
    """For each slot the bytes its suffix shares with the one before (Kasai), counted up to ``cap``.

    Many stretches of the text advance side by side; in each, a position inherits all but one byte of
    what the position before it shared, and only the rest is compared, eight bytes at a time.
    """
    n = len(data)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    shared = np.zeros(n, np.int64)
    stride = max(1, -(-n // lanes))
    begin = np.arange(0, n, stride)
    length = np.zeros(len(begin), np.int64)
    for t in range(stride):
        at = begin + t
        at = at[at < n]
        length = np.maximum(length[: len(at)] - 1, 0)
        other = before[at]
        length[other < 0] = 0
        going = np.flatnonzero(other >= 0)
        while len(going):
            x, y, l = at[going], other[going], length[going]
            room = n - np.maximum(x, y) - l
            differ = words[x + l] ^ words[y + l]
            same = _equal_bytes(differ)
            step = np.minimum(same, room)
            length[going] = l + step
            going = going[(same == 8) & (step == 8) & (room > 8) & (l + step < cap)]
        shared[at] = length = np.minimum(length, cap)
    return shared[sa]


def _equal_bytes(differ: np.ndarray) -> np.ndarray:
    """How many leading bytes are zero. Clearing bits below a set one keeps the float from rounding up."""
    return (64 - np.frexp((differ & ~(differ >> np.uint64(1))).astype(np.float64))[1]) >> 3


class Shard:
    """Records side by side with their suffix array, and which of their windows occur again."""

    def __init__(self, rows: pd.DataFrame, length: int):
        self.rows, self.length = rows, length
        sizes = rows.bytes.map(len).to_numpy()
        self.begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        data = np.frombuffer(b"".join(rows.bytes), np.uint8)
        self.words = words_of(data)
        windows = sizes - length + 1
        self.owner = np.repeat(np.arange(len(rows)), sizes)
        place = np.arange(len(data)) - self.begin[self.owner]
        self.starts = place < windows[self.owner]
        sa = suffix_array(data)
        lcp = common_prefixes(data, sa, self.words, length)
        keep = np.flatnonzero(self.starts[sa])
        self.sa = sa[keep]  # the windows in order
        if len(keep) > 1:
            between = np.minimum.reduceat(lcp[: keep[-1] + 1], keep[:-1] + 1)
        else:
            between = np.zeros(0, np.int64)
        equal = between >= length
        self.group = np.concatenate([[0], np.cumsum(~equal)]) if len(keep) else np.zeros(0, np.int64)
        again = np.zeros(len(self.sa), bool)
        again[1:] |= equal
        again[:-1] |= equal
        self.again = again

    def merge(self, other: Shard, key: int) -> None:
        """Mark windows under ``key`` that occur in both shards: the distinct ones of the other are
        looked up here by binary search."""
        heads = np.flatnonzero(np.concatenate([[True], other.group[1:] != other.group[:-1]])) if len(other.sa) else []
        heads = np.asarray(heads, dtype=np.int64)
        if len(heads):
            heads = heads[other.rows.anchor.to_numpy()[other.owner[other.sa[heads]]] == key]
        if not len(heads) or not len(self.sa):
            return
        wanted = other.sa[heads]
        lo, hi = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(self.sa))
        while (lo < hi).any():
            mid = (lo + hi) // 2
            less, _ = self._compare(self.sa[np.minimum(mid, len(self.sa) - 1)], other, wanted)
            less &= lo < hi
            hi = np.where(less | (lo >= hi), hi, mid)
            lo = np.where(less, mid + 1, lo)
        inside = lo < len(self.sa)
        _, equal = self._compare(self.sa[np.minimum(lo, len(self.sa) - 1)], other, wanted)
        hit = inside & equal
        other.again |= np.isin(other.group, other.group[heads[hit]])
        self.again |= np.isin(self.group, self.group[lo[hit]])

    def _compare(self, mine: np.ndarray, other: Shard, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether my window sorts before theirs, and whether it equals it."""
        less = np.zeros(len(mine), bool)
        open_ = np.arange(len(mine))
        for d in [*range(0, self.length - 7, 8), self.length - 8]:
            x, y = self.words[mine[open_] + d], other.words[theirs[open_] + d]
            less[open_] = x < y
            open_ = open_[x == y]
            if not len(open_):
                break
        equal = np.zeros(len(mine), bool)
        equal[open_] = True
        return less, equal

    def spans(self) -> pd.DataFrame:
        """``(doc_id, k, begin, end)`` of the bytes that repeated windows cover."""
        marked = np.zeros(len(self.starts), bool)
        marked[self.sa[self.again]] = True
        at = np.flatnonzero(marked)
        if not len(at):
            return pd.DataFrame({c: [] for c in ("doc_id", "k", "begin", "end")}).astype("int64")
        owner = self.owner[at]
        cut = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])])
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(at)) - 1
        own = owner[first]
        offset = self.rows.s.to_numpy()[own] - self.begin[own]
        return pd.DataFrame({
            "doc_id": self.rows.doc_id.to_numpy()[own], "k": self.rows.k.to_numpy()[own],
            "begin": at[first] + offset, "end": at[last] + offset + self.length,
        })


def _shards(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by anchor, cut into shards; an anchor that runs over several is merged across them."""
    open_: list[Shard] = []
    held, size, key = [], 0, None

    def close(next_key) -> Iterator[pd.DataFrame]:
        nonlocal open_, held, size
        shard = Shard(pd.concat(held, ignore_index=True), length)
        first, last = shard.rows.anchor.iloc[0], shard.rows.anchor.iloc[-1]
        for old in open_:
            if old.rows.anchor.iloc[-1] == first:
                old.merge(shard, first)
        if last != first or next_key != first:
            for old in open_:
                yield old.spans()
            open_ = []
        open_.append(shard)
        if next_key != last:
            for old in open_:
                yield old.spans()
            open_ = []
        held, size = [], 0

    for batch in batches:
        if not len(batch):
            continue
        sizes = np.cumsum(batch.bytes.map(len).to_numpy())
        begin = 0
        while begin < len(batch):
            done = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, done + SHARD - size, "right")))
            if held and begin + 1 == end and size + sizes[begin] - done > SHARD:
                yield from close(batch.anchor.iloc[begin])
                continue
            held.append(batch.iloc[begin:end])
            size += sizes[end - 1] - done
            begin = end
            if begin < len(batch):
                yield from close(batch.anchor.iloc[begin])
    if held:
        yield from close(None)


def _bytes_of(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (f["anchor"], doc_id, k, f["s"], data[f["s"] : f["e"] + length])
            for doc_id, k, data, found in zip(batch.doc_id, batch.k, map(_data, batch.text), batch.found)
            for f in found
        ]
        yield pd.DataFrame(rows, columns=["anchor", "doc_id", "k", "s", "bytes"])


def _bit() -> Column:
    return F.pmod(F.xxhash64("doc_id", "k"), F.lit(FILTER_BITS))


def _marked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` with ``maybe``: false only for rows that ``wanted (doc_id, k)`` surely lacks.

    The broadcast side is a bitmap of ``FILTER_BITS`` bits, 2 MB however many rows are wanted.
    """
    cells = wanted.select(_bit().alias("bit")).groupBy(F.expr(f"bit div {_WORD}").alias("_llm_cell")).agg(
        F.expr(f"bitmap_construct_agg(bit % {_WORD})").alias("_llm_bits")
    )
    joined = docs.withColumn("_llm_bit", _bit()).withColumn("_llm_cell", F.expr(f"_llm_bit div {_WORD}")).join(
        F.broadcast(cells), "_llm_cell", "left"
    )
    hit = f"""coalesce(shiftright(cast(conv(hex(substring(
        _llm_bits, int(_llm_bit % {_WORD} div 8) + 1, 1)), 16, 10) AS int), int(_llm_bit % 8)) & 1, 0) = 1"""
    return joined.withColumn("maybe", F.expr(hit)).drop("_llm_bit", "_llm_cell", "_llm_bits")


def _with_text(docs: DataFrame, rows: DataFrame, fields: list[str]) -> DataFrame:
    """``(doc_id, k, text, found)``: documents with their rows; only likely documents are moved."""
    found = rows.groupBy("doc_id", "k").agg(F.collect_list(F.struct(*fields)).alias("found"))
    likely = _marked(docs, rows).filter("maybe").select("doc_id", "k", "text")
    return likely.join(found, ["doc_id", "k"])


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))


def _as_text(column: str) -> Column:
    """Bytes as text, without the halves of characters that a cut has left."""
    text = F.col(column).cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("")))


def _keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, k, text)`` with a key of the text; a null id is filed as the least long."""
    text = docs.select(_id().alias("doc_id"), whole_text().alias("text"))
    return text.select("doc_id", F.xxhash64("text", "doc_id").alias("k"), "text")


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, split_records: int = SPLIT_RECORDS
) -> DataFrame:
    """``(doc_id, k, begin, end)``: byte ranges, perhaps overlapping, that cover exactly the bytes of
    ``docs (doc_id, k, text)`` that lie in a string of ``length`` bytes starting in two places at least."""
    rows = written(docs.mapInPandas(trimmed(lambda it: _base_rows(it, length)), ROWS), "anchors")
    spans = []
    for level in range(1, 6):
        counts = rows.groupBy("anchor").agg(
            F.count("*").alias("n"), F.expr("min(xxhash64(rec)) <> max(xxhash64(rec))").alias("mixed")
        ).filter("n > 1").select("anchor", "mixed")
        counts = written(counts, "counts")  # so that both sides of the join come from a shuffle, which AQE can split
        shared = written(rows.join(counts, "anchor"), "shared")
        # a record's copies: one stands for all in the shards
        recs = written(
            shared.groupBy("anchor", "rec", "mixed").agg(
                F.count("*").alias("n"), F.min(F.struct("doc_id", "k", "s", "e", "p")).alias("one")
            ).filter("n > 1 OR mixed"), "records",
        )
        copied = recs.filter("n > 1").select("anchor", "rec")
        spans.append(
            shared.join(copied, ["anchor", "rec"], "left_semi")
            .select("doc_id", "k", F.col("s").cast("long").alias("begin"), (F.col("e") + length).cast("long").alias("end"))
        )
        mixed = recs.filter("mixed").select("anchor", "one.*")
        hot = checkpointed(mixed.groupBy("anchor").count().filter(F.col("count") > split_records).select("anchor"))
        more = not hot.isEmpty()
        cold = mixed.join(hot, "anchor", "left_anti") if more else mixed
        sharded = (
            _with_text(docs, cold, ["anchor", "s", "e"])
            .mapInPandas(trimmed(lambda it: _bytes_of(it, length)), "anchor LONG, doc_id LONG, k LONG, s INT, bytes BINARY")
            .repartition("anchor").sortWithinPartitions("anchor")
        )
        spans.append(sharded.mapInPandas(trimmed(lambda it: _shards(it, length)), "doc_id LONG, k LONG, begin LONG, end LONG"))
        if not more:
            break
        rows = written(
            _with_text(docs, mixed.join(hot, "anchor", "left_semi"), ["s", "e", "p"])
            .mapInPandas(trimmed(lambda it, level=level: _narrowed(it, length, level)), ROWS), "anchors",
        )
    return reduce(DataFrame.unionByName, spans)


#: Ranges, sorted and joined where they touch.
_RUNS = """aggregate(array_sort(found), cast(array() AS array<struct<begin: bigint, end: bigint>>), (acc, f) ->
  CASE WHEN size(acc) = 0 OR f.begin > element_at(acc, -1).end THEN concat(acc, array(f))
       WHEN f.end > element_at(acc, -1).end THEN concat(slice(acc, 1, size(acc) - 1),
            array(named_struct('begin', element_at(acc, -1).begin, 'end', f.end)))
       ELSE acc END)"""
_KEPT = """concat(aggregate(_llm_runs, struct(X'' AS kept, 0L AS at), (acc, f) -> struct(
    concat(acc.kept, substring(_llm_data, cast(acc.at AS int) + 1, cast(f.begin - acc.at AS int))) AS kept, f.end AS at)).kept,
  CASE WHEN size(_llm_runs) = 0 THEN _llm_data
       ELSE substring(_llm_data, cast(element_at(_llm_runs, -1).end AS int) + 1) END)"""


def dedup(docs: DataFrame, length: int = LENGTH, split_records: int = SPLIT_RECORDS, with_text: bool = False) -> DataFrame:
    """Each row of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``; ``with_text``
    adds ``kept``, the remaining text (characters cut in half are left out there). Columns of ``docs`` by these
    names are replaced.

    A byte goes if a string of ``length`` bytes that covers it also starts elsewhere, in the same text
    or another, as the texts were given; all copies go, the first included. Null texts count as
    empty; repeated rows are copies of each other; rows with a null id are kept apart by their text.
    """
    spans = written(repeated_spans(_keyed(docs), length, split_records).distinct(), "spans")
    inner = docs.select(F.struct(*docs.columns).alias("_llm_row"), _id().alias("doc_id"), whole_text().alias("text"))
    inner = _marked(inner.withColumn("k", F.xxhash64("text", "doc_id")), spans)
    found = spans.groupBy("doc_id", "k").agg(F.collect_list(F.struct("begin", "end")).alias("found"))
    touched = inner.filter("maybe").join(found, ["doc_id", "k"], "left")
    touched = touched.withColumn("found", F.expr("coalesce(found, array())"))
    clean = inner.filter("NOT maybe").withColumn("found", F.expr("cast(array() AS array<struct<begin: bigint, end: bigint>>)"))
    added = {"n_bytes", "n_removed", "n_spans", "kept_sha256"} | ({"kept"} if with_text else set())
    given = [F.col("_llm_row")[c].alias(c) for c in docs.columns if c.lower() not in added]
    out = []
    for part in (clean, touched):
        data = part.withColumn("_llm_data", F.col("text").cast("binary")).withColumn("_llm_runs", F.expr(_RUNS))
        kept = data.withColumn("_llm_kept", F.expr(_KEPT))
        out.append(kept.select(
            *given, F.octet_length("_llm_data").cast("long").alias("n_bytes"),
            F.expr("aggregate(_llm_runs, 0L, (acc, f) -> acc + f.end - f.begin)").alias("n_removed"),
            F.size("_llm_runs").cast("long").alias("n_spans"), F.sha2("_llm_kept", 256).alias("kept_sha256"),
            *([_as_text("_llm_kept").alias("kept")] if with_text else []),
        ))
    return out[0].unionByName(out[1])
