"""Byte-level BPE by recursive queries: token-position rows joined with the merge table until nothing merges."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolink.llm.common import whole_text

#: Rows that all steps of one recursive query may hold together.
HELD_ROWS = 4_000_000
#: Bytes up to which a word counts as short.
SHORT = 128
#: Words whose ids a task remembers before it starts anew.
KNOWN_WORDS = 400_000

# A step of a short word: its tokens as rows by position, joined with the merge table; the least rank, and
# of its places the leftmost, is contracted. A word that nothing merges in takes no further step.
_SHORT = """
WITH RECURSIVE t(step, w, ids) AS (
  SELECT 0, w, list(id ORDER BY pos) FROM start GROUP BY w
  UNION ALL
  (WITH tokens AS (
     SELECT step, w, generate_subscripts(ids, 1) AS pos, unnest(ids) AS id, unnest(list_concat(ids[2:], [NULL])) AS right_id FROM t),
   best AS (
     SELECT w, min(m.id::BIGINT * 65536 + pos) AS b FROM tokens JOIN merges m ON m.l = tokens.id AND m.r = right_id GROUP BY w)
   SELECT step + 1, w, list_concat(ids[: b % 65536 - 1], [(b // 65536)::INT], ids[b % 65536 + 2 :]) FROM t JOIN best USING (w)))
SELECT w, generate_subscripts(ids, 1) AS pos, unnest(ids) AS id FROM (SELECT w, arg_max(ids, step) AS ids FROM t GROUP BY w)
ORDER BY w, pos
"""
# A step of long words does more: of the places of a word's least rank it contracts the leftmost, or all, left
# to right, that do not overlap, where that comes to the same.
_STEP = """
WITH RECURSIVE t(step, w, pos, id) AS (
  SELECT 0, w, pos, id FROM start
  UNION ALL
  (WITH pairs AS (
     SELECT step, w, pos, t.id, lead(t.id) OVER word AS right_id, row_number() OVER word AS i FROM t WINDOW word AS (PARTITION BY w ORDER BY pos)),
   ranked AS (
     SELECT p.*, m.id AS rank, m.one, min(m.id) OVER (PARTITION BY w) AS least FROM pairs p LEFT JOIN merges m ON m.l = p.id AND m.r = p.right_id),
   runs AS (
     SELECT *, coalesce(rank = least, false) AS hit,
       i - sum(CASE WHEN rank = least THEN 1 ELSE 0 END) OVER (PARTITION BY w ORDER BY i) AS run
     FROM ranked WHERE least IS NOT NULL),
   taken AS (
     SELECT *, hit AND CASE WHEN one THEN row_number() OVER (PARTITION BY w, hit ORDER BY i) = 1
       ELSE row_number() OVER (PARTITION BY w, run, hit ORDER BY i) % 2 = 1 END AS take FROM runs),
   gone AS (
     SELECT *, coalesce(lag(take) OVER (PARTITION BY w ORDER BY i), false) AS eaten FROM taken)
   SELECT step + 1, w, pos, CASE WHEN take THEN rank ELSE id END FROM gone WHERE NOT eaten AND step < {steps}))
"""
_LAST = _STEP + """
SELECT w, pos, id, step FROM (SELECT *, max(step) OVER (PARTITION BY w) AS last FROM t) WHERE step = last ORDER BY w, pos
"""
_DECODE = """
SELECT doc, string_agg(hex, '' ORDER BY pos) AS hex FROM coded JOIN vocabulary USING (id) GROUP BY doc
"""


class Vocabulary:
    """Ranks, and the pairs ``(left, right, token, one at a time)`` whose bytes together are a token."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (ranks[t[:k]], ranks[t[k:]], i)
            for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
        ]
        self.pairs = np.array(pairs or np.zeros((0, 3)), np.int64)
        self.ids = ranks
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # of tokens that are part of one with a lower rank: merging one can make a pair that comes first,
        # so these merge one at a time
        higher = self.pairs[:, :2] > self.pairs[:, 2:]
        single = np.unique(self.pairs[:, :2][higher & ~np.isin(self.pairs[:, :2], self.bytes)])
        self.pairs = np.column_stack([self.pairs, np.isin(self.pairs[:, 2], single)])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Coder:
    """Encodes and decodes in a DuckDB database of its own, which lives in this process's memory."""

    def __init__(self, ids: dict[bytes, int], pairs: np.ndarray, single: np.ndarray, pattern: str):
        import duckdb
        import regex

        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        self.ids, self.single = ids, single
        self.split = regex.compile(pattern).findall
        merges = pd.DataFrame({"l": pairs[:, 0], "r": pairs[:, 1], "id": pairs[:, 2], "one": pairs[:, 3]})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT l::INT AS l, r::INT AS r, id::INT AS id, one::BOOL AS one FROM merges")
        words = pd.DataFrame({"id": list(ids.values()), "hex": [t.hex() for t in ids]})  # noqa: F841
        self.db.execute("CREATE TABLE vocabulary AS SELECT id::INT AS id, hex FROM words")
        self.known: dict[str, bytes] = {}

    def learn(self, words: list[str]) -> None:
        """Find the ids of words: at once where a word is a token, else by merging."""
        rest: list[bytes] = []
        names: list[str] = []
        for word in words:
            data = word.encode("utf-8", "surrogatepass")
            if data in self.ids:
                self.known[word] = np.array([self.ids[data]], "<u4").tobytes()
            else:
                rest.append(data)
                names.append(word)
        order = sorted(range(len(rest)), key=lambda i: len(rest[i]))
        begin = 0
        while begin < len(order):
            end, rows, short = begin, 0, len(rest[order[begin]]) <= SHORT
            while end < len(order) and (size := len(rest[order[end]])) and (size <= SHORT) == short:
                rows += size * size // 2 if short else 16 * size
                if end > begin and rows > HELD_ROWS:
                    break
                end += 1
            chosen = [rest[i] for i in order[begin:end]]
            for i, packed in zip(order[begin:end], self.merge(chosen, short)):
                self.known[names[i]] = packed
            begin = end

    def merge(self, words: list[bytes], short: bool) -> list[bytes]:
        sizes = np.array([len(w) for w in words])
        start = pd.DataFrame({
            "w": np.repeat(np.arange(len(words), dtype=np.int32), sizes),
            "pos": np.arange(sizes.sum(), dtype=np.int32),
            "id": self.single[np.frombuffer(b"".join(words), np.uint8)].astype(np.int32),
        })
        done = []
        if short:
            self.db.register("start", start)
            done, start = [self.db.execute(_SHORT).df()], start[:0]
        while len(start):
            steps = max(1, HELD_ROWS // len(start))
            self.db.register("start", start)
            found = self.db.execute(_LAST.format(steps=steps)).df()
            unsure = found.step >= steps  # stopped for memory, perhaps not merged to the end
            done.append(found[~unsure])
            start = found.loc[unsure, ["w", "pos", "id"]]
        found = pd.concat(done).sort_values("w", kind="stable")  # positions are in order already
        ids = found.id.to_numpy().astype("<u4")
        cut = np.searchsorted(found.w.to_numpy(), np.arange(len(words) + 1))
        return [ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        pieces = [self.split(t) for t in texts]
        new = {w for words in pieces for w in words} - self.known.keys()
        self.learn(sorted(new))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4") for words in pieces]

    def decode(self, coded: list[np.ndarray]) -> list[bytes]:
        sizes = np.array([len(c) for c in coded], np.int64)
        table = pd.DataFrame({
            "doc": np.repeat(np.arange(len(coded), dtype=np.int32), sizes), "pos": np.arange(sizes.sum()),
            "id": np.concatenate([*coded, np.zeros(0, "<u4")]).astype(np.int32),
        })
        self.db.register("coded", table)
        out = [b""] * len(coded)
        for doc, text in self.db.execute(_DECODE).fetchall():
            out[doc] = bytes.fromhex(text)
        return out


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for each row; ``with_ids`` adds ``ids`` and ``decoded``.

    ``ids_sha256`` is over little-endian unsigned 32-bit ids. Null texts count as empty and have no
    ids; repeated rows are coded repeatedly; other columns are not read. Tasks remember the distinct
    words of their own partition; the vocabulary, which does not grow with the data, is broadcast.
    """
    vocabulary = Vocabulary(ranks)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.ids, vocabulary.pairs, vocabulary.bytes))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens LONG, ids_sha256 STRING, decoded_sha256 STRING"
    schema += ", ids ARRAY<INT>, decoded BINARY" if with_ids else ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(*shared.value, pattern)
        for batch in batches:
            coded = coder.encode(list(batch.text))
            decoded = coder.decode(coded)
            out = pd.DataFrame({
                "doc_id": batch.doc_id, "n_tokens": [len(c) for c in coded],
                "ids_sha256": [hashlib.sha256(c.tobytes()).hexdigest() for c in coded],
                "decoded_sha256": [hashlib.sha256(d).hexdigest() for d in decoded],
            })
            yield out.assign(ids=[c.astype(np.int32) for c in coded], decoded=decoded) if with_ids else out

    return docs.select("doc_id", whole_text().alias("text")).mapInPandas(run, schema)
