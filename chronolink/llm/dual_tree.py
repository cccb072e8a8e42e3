"""Ranked lexical search by two trees at once: one over the items, one over a shard of the documents.

A document is a vector of impacts, an item one of term counts, and a score their product in whole numbers.
Nodes of both trees hold coordinate maxima, so the product of two nodes bounds every score below them. A pair
of nodes goes no further where that bound is under the weakest kth score among the node's items; the pairs left
are split on both sides down to single items and leaves of documents, which are scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolink.llm.common import whole_text, written

#: Cells of the matrix of item nodes and terms, and so what a block of items may broadcast.
BLOCK_CELLS = 1 << 22
#: Documents of a tree, of a leaf, and children of a node.
SHARD, LEAF, FAN = 8192, 32, 8
#: Documents, about, whose scores give the first bounds; any documents do, and no result depends on them.
SEEDS = 4096
ITEM_FAN = 4

# Letters and digits stay, A-Z become lower case, other ASCII characters end a term.
_TERMS = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.encode("utf-8", "replace").translate(_TERMS).split()


@dataclass
class Block:
    """Items that are searched for together: ids, and counts of terms, numbered from 1 in order of the words' arrival."""

    item_ids: list
    counts: list[dict[int, int]]
    words: dict[bytes, int]

    def fits(self, terms: list[bytes]) -> bool:
        width = len(self.words) + len(set(terms) - self.words.keys())
        return not self.counts or width * (len(self.counts) + 1) <= BLOCK_CELLS

    def add(self, item_id, terms: list[bytes]) -> None:
        counts: dict[int, int] = {}
        for t in terms:
            k = self.words.setdefault(t, len(self.words) + 1)
            counts[k] = counts.get(k, 0) + 1
        self.item_ids.append(item_id)
        self.counts.append(counts)


def blocks(items: DataFrame) -> Iterator[Block]:
    """Items in blocks of bounded size, one at a time on the driver; items without terms find nothing and are left out."""
    block = Block([], [], {})
    for row in items.select("item_id", whole_text().alias("text")).distinct().toLocalIterator():
        if terms := terms_of(row.text):
            if not block.fits(terms):
                yield block
                block = Block([], [], {})
            block.add(row.item_id, terms)
    if block.counts:
        yield block


# --- documents ---------------------------------------------------------------------------------------------
def _counted(docs: DataFrame, words: dict[bytes, int]) -> DataFrame:
    """``(doc_id, no_id, n, terms, tfs)``: all terms of a document as a number, the block's terms with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = shared.value.get
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.text:
                found = terms_of(text)
                n.append(len(found))
                known, times = np.unique(np.fromiter(filter(None, map(number, found)), np.int32), return_counts=True)
                terms.append(known.astype("<i4").tobytes())
                tfs.append(times.astype("<i4").tobytes())
            yield pd.DataFrame({"doc_id": batch.doc_id, "no_id": batch.no_id, "n": n, "terms": terms, "tfs": tfs})

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"),
        whole_text().alias("text"),
    )
    return rows.mapInPandas(run, "doc_id LONG, no_id BOOLEAN, n LONG, terms BINARY, tfs BINARY")


def _holders(counted: DataFrame, width: int) -> dict[int, int]:
    """How many documents hold each term of the block; each task adds up its own first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(width + 1, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.terms), "<i4"), minlength=width + 1)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"term": held, "df": total[held]})

    found = counted.select("terms").mapInPandas(run, "term INT, df LONG").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term: r.df for r in found.collect()}


@dataclass
class Corpus:
    """What the scores need to know of all documents: how many, their terms, and by term rank and weight."""

    documents: int
    total: int
    rank: np.ndarray  # of a term's number: heaviest first
    weight: np.ndarray  # by rank


def _corpus(counted: DataFrame, width: int) -> Corpus:
    n, total = counted.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = _holders(counted, width)
    weight = np.array([0] + [math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(t, 0) + 1))) for t in range(1, width + 1)], np.int64)
    order = np.argsort(-weight[1:], kind="stable") + 1
    rank = np.zeros(width + 1, np.int32)
    rank[order] = np.arange(width)
    return Corpus(n, total, rank, weight[order])


def _by_rank(counted: DataFrame, corpus: Corpus) -> DataFrame:
    """``(top, lead, salt, doc_id, no_id, n, terms, tfs)``: terms by rank; ``top`` is the most frequent one, which tells
    languages apart, and ``lead`` the heaviest, which copies and quotations share.

    Documents without a term of the block score nothing and are left out.
    """
    shared = counted.sparkSession.sparkContext.broadcast(corpus.rank)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            top, lead, terms, tfs = [], [], [], []
            for t, f in zip(batch.terms, batch.tfs):
                rank = shared.value[np.frombuffer(t, "<i4")]
                order = np.argsort(rank)
                rank, tf = rank[order], np.frombuffer(f, "<i4")[order]
                top.append(int(rank[np.argmax(tf)]))
                lead.append(int(rank[0]))
                terms.append(rank.tobytes())
                tfs.append(tf.tobytes())
            yield batch[["doc_id", "no_id", "n"]].assign(top=top, lead=lead, terms=terms, tfs=tfs)

    held = counted.filter(F.octet_length("terms") > 0)
    ranked = held.mapInPandas(run, "top INT, lead INT, doc_id LONG, no_id BOOLEAN, n LONG, terms BINARY, tfs BINARY")
    return ranked.withColumn("salt", F.xxhash64("doc_id", "n"))  # so that a common pair of terms goes to many shards


# --- trees ---------------------------------------------------------------------------------------------------
class ItemTree:
    """Nodes level by level, items first, each with the maxima of its children; ``kth`` is the weakest kth score below it."""

    def __init__(self, counts: list[dict[int, int]], corpus: Corpus):
        ranked = [{int(corpus.rank[t]): c for t, c in item.items()} for item in counts]
        order = sorted(range(len(ranked)), key=lambda i: sorted(ranked[i], reverse=True)[:6])  # items with the same common terms are near
        self.item = np.array(order)
        level = np.zeros((len(order), len(corpus.weight)))
        for row, i in enumerate(order):
            level[row, list(ranked[i])] = list(ranked[i].values())
        levels, self.sizes = [level], [len(level)]
        while len(level) > 1:
            level = np.maximum.reduceat(level, np.arange(0, len(level), ITEM_FAN))
            levels.append(level)
            self.sizes.append(len(level))
        self.nodes = np.concatenate(levels)
        self.begin = np.cumsum([0, *self.sizes])
        self.exact = self.nodes[: len(order)].sum(1).max() * corpus.weight.max(initial=0) * 1_000_000 < 1 << 53
        self.kth = np.ones(len(self.nodes))

    def weakest(self, kth: np.ndarray) -> None:
        """Take the items' kth scores over and up the tree."""
        self.kth[: len(kth)] = kth
        for k in range(1, len(self.sizes)):
            below = self.kth[self.begin[k - 1] : self.begin[k]]
            self.kth[self.begin[k] : self.begin[k + 1]] = np.minimum.reduceat(below, np.arange(0, len(below), ITEM_FAN))

    def root(self) -> np.ndarray:
        return np.array([len(self.nodes) - 1])

    def split(self, nodes: np.ndarray) -> np.ndarray:
        """Children of inner nodes; items stay."""
        level = np.searchsorted(self.begin, nodes, side="right") - 1
        inner = level > 0
        first = self.begin[level[inner] - 1] + (nodes[inner] - self.begin[level[inner]]) * ITEM_FAN
        last = np.minimum(first + ITEM_FAN, self.begin[level[inner]])
        children = [np.arange(a, b) for a, b in zip(first, last)]
        return np.concatenate([nodes[~inner], *children]).astype(np.int64)


class Documents:
    """The documents of a shard in the order given, their impacts, and the levels of nodes above them."""

    def __init__(self, rows: pd.DataFrame, corpus: Corpus):
        self.ids, self.no_id = rows.doc_id.to_numpy(), rows.no_id.to_numpy()
        terms = [np.frombuffer(t, "<i4") for t in rows.terms]
        self.ends = np.cumsum([len(t) for t in terms])
        self.terms = np.concatenate(terms).astype(np.int64)
        tf = np.frombuffer(b"".join(rows.tfs), "<i4").astype(np.int64)
        m = 100 - 75 + 75 * rows.n.to_numpy() * corpus.documents // corpus.total
        doc = np.repeat(np.arange(len(rows)), np.diff(self.ends, prepend=0))
        self.impact = corpus.weight[self.terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        self.levels = [self._maxima(doc // LEAF, self.terms, self.impact)]
        while len(self.levels[-1][0]) > 2:
            starts, held, most = self.levels[-1]
            node = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            self.levels.append(self._maxima(node // FAN, held, most))

    @staticmethod
    def _maxima(node: np.ndarray, terms: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts by node, terms and the greatest value of each."""
        order = np.lexsort((terms, node))
        node, terms, values = node[order], terms[order], values[order]
        first = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (terms[1:] != terms[:-1])])
        starts = np.searchsorted(node[first], np.arange(node[-1] + 2))
        return starts, terms[first], np.maximum.reduceat(values, first)

    def node(self, level: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        starts, terms, most = self.levels[level]
        return terms[starts[k] : starts[k + 1]], most[starts[k] : starts[k + 1]]

    def leaf(self, k: int, terms: np.ndarray) -> tuple[int, np.ndarray]:
        """The first document of a leaf, and the leaf's impacts by document and term."""
        first, last = k * LEAF, min((k + 1) * LEAF, len(self.ids))
        begin = self.ends[first - 1] if first else 0
        sizes = np.diff(self.ends[first:last], prepend=begin)
        out = np.zeros((last - first, len(terms)), np.int64)
        held = slice(begin, self.ends[last - 1])
        out[np.repeat(np.arange(last - first), sizes), np.searchsorted(terms, self.terms[held])] = self.impact[held]
        return first, out


class Search:
    """The best ``k`` documents of each item so far."""

    def __init__(self, tree: ItemTree, k: int, least: np.ndarray):
        self.tree, self.k = tree, k
        self.least = least  # scores that a document needs to be among the best of all
        self.best: list[list[tuple]] = [[] for _ in least]  # (-score, no id, id), best first
        tree.weakest(least)
        self.pairs = self.scored = 0

    def shard(self, docs: Documents) -> None:
        self.visit(docs, len(docs.levels) - 1, 0, self.tree.root())

    def bounded(self, terms: np.ndarray, most: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, float]:
        """Item nodes that the documents below a node may still serve, and the greatest bound."""
        self.pairs += len(nodes)
        bound = (self.tree.nodes[np.ix_(nodes, terms)] @ most.astype(np.float64)) * (1 + 1e-9)
        return nodes[bound >= self.tree.kth[nodes]], float((bound - self.tree.kth[nodes]).max(initial=-1.0))

    def visit(self, docs: Documents, level: int, k: int, nodes: np.ndarray) -> None:
        terms, most = docs.node(level, k)
        nodes, _ = self.bounded(terms, most, nodes)
        if not len(nodes):
            return
        if level == 0:
            while len(nodes) and nodes.max() >= self.tree.sizes[0]:
                nodes, _ = self.bounded(terms, most, self.tree.split(nodes))
            if len(nodes):
                self.score(docs, k, terms, nodes)
            return
        nodes, below = self.tree.split(nodes), range(k * FAN, min((k + 1) * FAN, len(docs.levels[level - 1][0]) - 1))
        hope = [(self.bounded(*docs.node(level - 1, c), nodes)[1], c) for c in below]
        for most_, c in sorted(hope, reverse=True):
            if most_ >= 0:
                self.visit(docs, level - 1, c, nodes)

    def score(self, docs: Documents, k: int, terms: np.ndarray, items: np.ndarray) -> None:
        first, impact = docs.leaf(k, terms)
        counts = self.tree.nodes[np.ix_(items, terms)]
        self.scored += impact.shape[0] * len(items)
        if self.tree.exact:  # whole numbers below 2^53
            scores = (impact.astype(np.float64) @ counts.T).astype(np.int64)
        else:
            scores = impact @ counts.T.astype(np.int64)
        changed = False
        reach = scores >= np.maximum(self.tree.kth[items], 1)
        for col in np.flatnonzero(reach.any(0)):
            rows, item = np.flatnonzero(reach[:, col]), items[col]
            new = zip((-scores[rows, col]).tolist(), docs.no_id[first + rows].tolist(), docs.ids[first + rows].tolist())
            best = self.best[item] = sorted([*self.best[item], *new])[: self.k]
            if len(best) == self.k and -best[-1][0] > self.least[item]:
                self.least[item] = -best[-1][0]
                changed = True
        if changed:
            self.tree.weakest(self.least)


def _search(rows: DataFrame, block: Block, corpus: Corpus, k: int, least: list[int]) -> DataFrame:
    """``(item, doc_id, no_id, score)``: the best of each shard, as far as they reach ``least``."""
    shared = rows.sparkSession.sparkContext.broadcast((block.counts, vars(corpus), least))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, known, bounds = shared.value
        known = Corpus(**known)
        tree = ItemTree(counts, known)
        search = Search(tree, k, np.array(bounds, np.float64)[tree.item])
        held: list[pd.DataFrame] = []
        for batch in batches:
            for begin in range(0, len(batch), SHARD):
                part = batch.iloc[begin : begin + SHARD]
                if held and sum(map(len, held)) + len(part) > SHARD:
                    search.shard(Documents(pd.concat(held), known))
                    held = []
                held.append(part)
        if held:
            search.shard(Documents(pd.concat(held), known))
        found = [(int(tree.item[i]), d, missing, -s) for i, best in enumerate(search.best) for s, missing, d in best]
        yield pd.DataFrame(found, columns=["item", "doc_id", "no_id", "score"])

    return rows.mapInPandas(run, "item INT, doc_id LONG, no_id BOOLEAN, score LONG")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "no_id", "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _searched(spark: SparkSession, docs: DataFrame, block: Block, k: int, kind: str) -> DataFrame:
    counted = written(_counted(docs, block.words), "counted")
    corpus = _corpus(counted, len(block.words))
    rows = written(_by_rank(counted, corpus), "ranked")
    columns = ["doc_id", "no_id", "n", "terms", "tfs"]
    least = [1] * len(block.counts)
    if corpus.total:
        share = SEEDS / (SEEDS + corpus.documents)
        seeds = rows.sample(share, seed=1).select(*columns)
        for r in _best(_search(seeds, block, corpus, k, least), k).filter(F.col("rank") == k).collect():
            least[r["item"]] = max(1, r["score"])
    shards = rows.repartitionByRange("top", "lead", "salt").sortWithinPartitions("top", "lead", "salt").select(*columns)
    best = _best(_search(shards, block, corpus, k, least), k)
    ids = spark.createDataFrame(list(enumerate(block.item_ids)), f"item INT, item_id {kind}")
    return best.join(ids, "item").select(
        "item_id", "rank", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score"
    )


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each of ``items (item_id, text)`` the ``k`` best of ``docs (doc_id, text)``.

    Exact, equal scores by ascending id, null ids last. Every row of ``docs`` is a document; null and
    empty texts have no terms. Items equal in id and text are one; one id with two texts has two
    lists; an item without terms, or whose terms no document holds, has none. Other columns are not read.

    Items pass the driver in blocks of at most ``BLOCK_CELLS`` cells (items times distinct terms; one
    item at least), which are broadcast; each block is searched for in all documents.
    """
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    found = [_searched(spark, docs, block, k, kind) for block in blocks(items)]
    none = spark.createDataFrame([], f"item_id {kind}, rank INT, doc_id LONG, score LONG")
    return reduce(DataFrame.unionByName, found) if found else none
