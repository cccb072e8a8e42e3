import hashlib
from collections import Counter

import numpy as np
import pytest

from chronolink.llm import suffix_dedup


def brute(texts, length=400):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone[:-1]].tobytes()
        out.append((len(t), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "gamma", "é", "delta", "日本", "ηta", "iota"]
    prose = lambda n: " ".join(str(rng.choice(words)) + str(rng.integers(0, 50)) for _ in range(n))
    base, shared, docs = [prose(150) for _ in range(4)], prose(90), []
    for i in range(48):
        cut = int(rng.integers(0, 500))
        docs.append([
            lambda: base[i % 4], lambda: prose(60) + shared + prose(60), lambda: base[i % 4][:cut] + "X" + base[i % 4][cut:],
            lambda: prose(int(rng.integers(0, 100))), lambda: "ab" * int(rng.integers(0, 400)),
            lambda: prose(30) + shared[: int(rng.integers(300, 500))] + prose(30),
        ][i % 6]())
    return docs + ["", None]


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    for trial in range(25):
        t = rng.integers(0, int(rng.choice([1, 2, 4, 200])), size=int(rng.integers(1, 1500))).astype(np.uint8)
        t = np.tile(t[: max(1, len(t) // 7)], 7) if trial % 3 == 0 else t
        data = t.tobytes()
        sa = suffix_dedup.suffix_array(t)
        assert sa.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        got = suffix_dedup.common_prefixes(t, sa, suffix_dedup.words_of(t), 10**6, lanes=int(rng.choice([1, 3, 50, 4096])))
        for a, b, n in zip(sa, sa[1:], got[1:]):
            x, y = data[a:], data[b:]
            assert x[:n] == y[:n] and (len(x) == n or x[n] != y[n])


def test_every_window_in_one_record():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 4, size=n).astype(np.uint8).tobytes() for n in (0, 399, 400, 401, 2000)] + [b"a" * 1500]
    row, s, e, p, _ = suffix_dedup.anchored(texts)
    for i, t in enumerate(texts):
        mine = sorted((a, b) for j, a, b in zip(row, s, e) if j == i)
        assert [w for a, b in mine for w in range(a, b + 1)] == list(range(max(0, len(t) - 399)))
    assert ((s <= p) & (p + suffix_dedup.GRAM <= s + 400)).all() and ((e <= p) & (p + suffix_dedup.GRAM <= e + 400)).all()


@pytest.mark.parametrize("split, shard", [(8_000, 1 << 19), (3, 1 << 19), (1, 1 << 19), (8_000, 4_000)])
def test_against_brute_force(documents, monkeypatch, split, shard):
    """Small limits send records through longer anchors and across shards; the result is the same."""
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    docs = corpus()
    found = suffix_dedup.dedup(documents(list(enumerate(docs))), split_records=split).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found}
    assert got == dict(enumerate(brute([(t or "").encode() for t in docs])))


def test_blocks_of_long_texts(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    docs = corpus()[:20]
    found = suffix_dedup.dedup(documents(list(enumerate(docs)))).collect()
    assert {r.doc_id: r.n_removed for r in found} == {i: w[1] for i, w in enumerate(brute([(t or "").encode() for t in docs]))}


def test_messy(messy, documents):
    found = suffix_dedup.dedup(messy.drop("kept"), with_text=True)
    rows = found.collect()
    assert len(rows) == messy.count() and found.columns[: len(messy.columns) - 1] == messy.drop("kept").columns
    assert all(r.kept == "" for r in rows if r.doc_id in (5, 6)) and {r.kept for r in rows if r.doc_id == 7} == {"one", "two"}
    assert suffix_dedup.dedup(documents([])).collect() == []


def test_own_names_win(documents):
    """Columns named like the operator's are replaced, in any case of letters; the others stay."""
    given = documents([(1, "x" * 500), (2, "short")])
    for name in ("N_BYTES", "n_removed", "n_spans", "kept_sha256"):
        given = given.withColumn(name, given.lang)
    got = suffix_dedup.dedup(given, with_text=True)
    assert sorted(got.columns) == sorted({*given.columns, "n_bytes"} - {"N_BYTES"})
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in got.collect()} == {(1, 500, 500, 1, ""), (2, 5, 0, 0, "short")}
    plain = suffix_dedup.dedup(given)
    assert plain.columns.count("kept") == 1 and {r.kept for r in plain.collect()} == {None}


def test_halves_of_characters(documents):
    halves = documents([(1, "é" * 300 + "x"), (2, "a" + "é" * 300)])  # a cut may fall inside a character
    assert all("�" not in r.kept for r in suffix_dedup.dedup(halves, with_text=True).collect())
