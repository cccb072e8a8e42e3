"""Packing: documents in the order of a space-filling curve, cut into sequences of one length."""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolink.llm.common import trimmed, whole_text, written

LENGTH = 2048
END = 1
DIMENSIONS = 4
ORDER = 8
SHARD_IDS = 8 << 20
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_MIX = np.uint64(0x9E3779B97F4A7C15)


def byte_level_encoder(path: str) -> Callable[[str], np.ndarray]:
    """Ids of a byte-level BPE vocabulary in the form of the tokenizers library.

    The ids are that library's, special tokens' strings in a text included; tiktoken makes them from
    the same vocabulary several times faster.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # a byte is written as itself where it prints, else as the next free character from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in plain} | {
        chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))
    }
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(chars[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    encoding = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


def project(ids: np.ndarray, dimensions: int = DIMENSIONS, order: int = ORDER) -> list[int]:
    """Cells of a document: its distinct hashed ids and pairs of ids, summed with random signs per dimension.

    The sum over n features is about normal with variance n; its distribution function spreads it
    evenly over ``2 ** order`` cells.
    """
    x = ids.astype(np.uint64) + np.uint64(1)
    features = np.concatenate([x, x[:-1] * np.uint64(1 << 20) + x[1:]]) * _MIX
    features ^= features >> np.uint64(29)
    features = np.unique(features * _MIX)
    cells = 1 << order
    out = []
    for d in range(dimensions):
        total = 2 * int(np.count_nonzero(features >> np.uint64(63 - d) & np.uint64(1))) - len(features)
        share = 0.5 * (1 + math.erf(total / math.sqrt(2 * max(1, len(features)))))
        out.append(min(cells - 1, int(share * cells)))
    return out


def hilbert(cells: list[int], order: int = ORDER) -> int:
    """Position of a cell along the Hilbert curve through ``len(cells)`` dimensions.

    From the highest bit down, Gray-code order within each orthant, with the reflections and swaps
    that make neighbouring orthants join.
    """
    x = list(cells)
    n = len(x)
    top = 1 << (order - 1)
    bit = top
    while bit > 1:
        lower = bit - 1
        for i in range(n):
            if x[i] & bit:
                x[0] ^= lower
            else:
                swap = (x[0] ^ x[i]) & lower
                x[0] ^= swap
                x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, bit = 0, top
    while bit > 1:
        if x[-1] & bit:
            flip ^= bit - 1
        bit >>= 1
    x = [v ^ flip for v in x]
    key = 0
    for b in range(order - 1, -1, -1):
        for v in x:
            key = key << 1 | v >> b & 1
    return key


def tokens(docs: DataFrame, encoder: Callable[[], Callable[[str], np.ndarray]], end: int = END) -> DataFrame:
    """``(doc_id, key, n, ids)``: ids with ``end`` at the end as little-endian 16 or 32 bit numbers in
    ``ids``, their number and the curve position. Null texts count as empty: one id, ``end``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for batch in batches:
            rows = []
            for text in batch.text:
                ids = np.append(encode(text), np.uint32(end))
                key = hilbert(project(ids[:-1]))
                wide = bool(len(ids)) and int(ids.max()) >> 16 > 0
                rows.append((key, len(ids), wide, ids.astype("<u4" if wide else "<u2").tobytes()))
            yield pd.DataFrame(rows, columns=["key", "n", "wide", "ids"]).assign(doc_id=batch.doc_id)[
                ["doc_id", "key", "n", "wide", "ids"]
            ]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInPandas(
        trimmed(run), f"doc_id {kind}, key LONG, n LONG, wide BOOLEAN, ids BINARY"
    )


def pack(
    docs: DataFrame, encoder: Callable[[], Callable[[str], np.ndarray]], length: int = LENGTH, end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of all rows.

    Documents lie along the curve in one gapless stream of ids, cut every ``length`` ids; only the last
    sequence is padded. Neighbours on the curve, copies above all, share sequences. Ties on the curve
    go by a hash of id and content, so a place held by many copies is spread over shards too; a row
    repeated is packed again. ``with_ids`` adds ``ids`` (array<int>), the piece.

    Ranges of the curve of about ``SHARD_IDS`` ids are the shards. Their bounds and their sums of ids
    are all that the driver sees; ids are moved once.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    place = F.shiftleft("key", 63 - DIMENSIONS * ORDER) + F.shiftrightunsigned(
        F.xxhash64("doc_id", F.crc32("ids")), 1 + DIMENSIONS * ORDER
    )
    coded = written(tokens(docs, encoder, end), "tokens").withColumn("place", place)
    total = coded.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_IDS))
    bounds = np.zeros(0, np.int64)
    if shards > 1:
        cuts = [k / shards for k in range(1, shards)]
        bounds = np.array(coded.agg(F.percentile_approx("place", cuts, 100 * shards)).first()[0], np.int64)

    def shard_of(places: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, places.to_numpy(), "right").astype(np.int32))

    dealt = coded.withColumn("shard", F.pandas_udf(shard_of, "int")("place"))
    sizes = {r.shard: r.n for r in dealt.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    base = np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(shards)])]).tolist()
    schema = f"doc_id {kind}, start LONG, length LONG, ids_crc32 LONG, doc_tokens LONG, sequence_id LONG, offset LONG"
    schema += ", ids ARRAY<INT>" if with_ids else ""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at: dict[int, int] = {}
        for batch in batches:
            rows = []
            for doc_id, n, wide, packed, shard in zip(batch.doc_id, batch.n, batch.wide, batch.ids, batch["shard"]):
                here = at.get(shard, base[shard])
                ids = np.frombuffer(packed, "<u4" if wide else "<u2").astype("<u4")
                begin = 0
                while begin < n:
                    sequence, offset = divmod(here + begin, length)
                    piece = ids[begin : begin + length - offset]
                    row = (doc_id, begin, len(piece), zlib.crc32(piece.tobytes()), n, sequence, offset)
                    rows.append((*row, piece.astype(np.int32)) if with_ids else row)
                    begin += len(piece)
                at[shard] = here + n
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pd.DataFrame(rows, columns=names + ["ids"] * with_ids)

    ordered = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place", "doc_id")
    return ordered.select("doc_id", "n", "wide", "ids", "shard").mapInPandas(trimmed(cut), schema)
