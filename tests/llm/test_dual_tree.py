import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from chronolink.llm import dual_tree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """Every item against every document, by the formulas alone."""
    counted = [(i, Counter(words(t))) for i, t in docs]
    n = sum(1 for _, c in counted if c)
    total = sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in set(items):
        found = []
        for i, c in counted:
            m = 100 - 75 + 75 * sum(c.values()) * n // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                for w in words(text) if w in c
            )
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def rows(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def items(spark):
    return lambda some: spark.createDataFrame(some, "item_id LONG, text STRING, score LONG, rank INT").repartition(2)


def some_corpus(n, seed=1):
    """Words by a steep law, copies, ties, one passage in a third of the documents."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Äpfel", "日本", "É", "é"]
    text = lambda size: " ".join(vocabulary[min(int(rng.paretovariate(0.7)) - 1, 403)] for _ in range(size))
    docs = [(i, text(rng.randint(1, 80))) for i in range(n)]
    passage = text(30)
    docs += [(n + i, passage + " " + text(rng.randint(0, 3))) for i in range(n // 2)]
    docs += [(2 * n + i, docs[i % 7][1].upper()) for i in range(60)]
    some = [(i, text(rng.randint(1, 25))) for i in range(30)] + [(30, passage), (31, docs[0][1])]
    return docs, some


def test_terms():
    for text in ("", "Ab-cé!12_x 日本　q\0Z", "\x7fÄB\x80c", "a@[`{z", "ÀÉİ ſ K"):
        assert [t.decode() for t in dual_tree.terms_of(text)] == words(text)


@pytest.mark.parametrize("shard, leaf, fan, cells", [(8192, 32, 8, 1 << 22), (40, 4, 2, 1 << 22), (1000, 16, 4, 300), (64, 1, 2, 5000)])
def test_against_brute_force(documents, items, monkeypatch, shard, leaf, fan, cells):
    """Small trees and small blocks of items change nothing."""
    for name, value in (("SHARD", shard), ("LEAF", leaf), ("FAN", fan), ("BLOCK_CELLS", cells)):
        monkeypatch.setattr(dual_tree, name, value)
    docs, some = some_corpus(150)
    if cells == 300:
        some = some[:3] + some[-2:]
    found = dual_tree.search(documents(docs), items([(i, t, 7, 7) for i, t in some]))
    assert rows(found) == brute(docs, some)


def test_nodes_bound_and_prune():
    """A node's maxima bound all below it, and pairs under the weakest kth score are left out."""
    docs, some = some_corpus(400)
    block = dual_tree.Block([], [], {})
    for i, t in some:
        block.add(i, dual_tree.terms_of(t))
    width = len(block.words)
    weight = np.sort(np.random.default_rng(0).integers(1, 9000, width))[::-1].astype(np.int64)
    rank = np.concatenate([[0], np.random.default_rng(1).permutation(width)]).astype(np.int32)
    import pandas as pd

    frame = []
    for i, t in docs:
        found = Counter(k for w in dual_tree.terms_of(t) if (k := block.words.get(w)))
        if found:
            order = sorted(found, key=lambda k: rank[k])
            frame.append((i, False, len(t.split()), np.array([rank[k] for k in order], "<i4").tobytes(),
                          np.array([found[k] for k in order], "<i4").tobytes(), rank[order[0]]))
    frame = pd.DataFrame(frame, columns=["doc_id", "no_id", "n", "terms", "tfs", "lead"]).sort_values("lead", kind="stable")
    corpus = dual_tree.Corpus(len(docs), 20_000, rank, weight)
    built = dual_tree.Documents(frame, corpus)
    for level, (starts, _, _) in enumerate(built.levels):
        per = dual_tree.LEAF * dual_tree.FAN**level
        for k in range(len(starts) - 1):
            terms, most = built.node(level, k)
            begin, end = ([0, *built.ends][min(x * per, len(frame))] for x in (k, k + 1))
            want = Counter()
            for t, v in zip(built.terms[begin:end].tolist(), built.impact[begin:end].tolist()):
                want[t] = max(want[t], v)
            assert dict(zip(terms.tolist(), most.tolist())) == want
    tree = dual_tree.ItemTree(block.counts, corpus)
    search = dual_tree.Search(tree, 2, np.ones(len(some)))
    search.shard(built)
    assert search.scored < len(frame) * len(some)
    exact, tree.exact = [sorted(b) for b in search.best], False
    again = dual_tree.Search(tree, 2, np.ones(len(some)))
    again.shard(built)
    assert [sorted(b) for b in again.best] == exact


def test_bounds_from_before_leave_ties(documents, items, monkeypatch):
    """Many documents with the very score that the first bounds come from: the least ids win."""
    docs = [(i, "same words here") for i in range(500, 0, -1)] + [(None, "same words here"), (0, "other")]
    some = [(1, "words words"), (1, "words words"), (1, "here"), (2, None), (3, "unheard of"), (None, "same")]
    got = rows(dual_tree.search(documents(docs), items([(i, t, 0, 0) for i, t in some])))
    assert got == brute(docs, some) and [d for i, _, d, _ in got if i is None] == [1, 10, 2, 3, 4, 5, 6, 7, 8, 9]


def test_messy(messy, documents, items):
    docs = [(r.doc_id, r.text) for r in messy.collect()]
    some = [(1, "some words one"), (2, "WORD x" + "x" * 200), (3, "x" * 200_000), (4, "a text"), (5, ""), (6, "日本𝄞 é")]
    given = items([(i, t, None, None) for i, t in some])
    assert rows(dual_tree.search(messy, given)) == brute(docs, some)
    assert dual_tree.search(documents([]), given).collect() == []
    assert dual_tree.search(messy, items([])).collect() == []
    assert dual_tree.search(documents([(1, None), (2, " ")]), given).collect() == []
