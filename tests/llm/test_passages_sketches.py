import hashlib
import random
import re

import numpy as np

from chronolink.llm import compact_windows, paragraph_sketch


def test_windows_cover_each_passage_once():
    rng = np.random.default_rng(0)
    for values in (rng.integers(0, 9, 60), rng.permutation(80), np.zeros(50, int)):
        windows = compact_windows.compact_windows(values, 7)
        for i in range(len(values)):
            for j in range(i + 6, len(values)):
                own = [c for l, c, r in windows if l <= i <= c <= j <= r]
                assert len(own) == 1 and values[own[0]] == values[i : j + 1].min()


def similar(x, y):
    grams = lambda t: {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
    a, b = grams(x), grams(y)
    return len(a & b) / len(a | b)


def test_repeated_passages(documents):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    p, q, docs = words(70), words(120), []
    for i in range(40):
        if i % 4 == 0:
            docs.append((words(80) + p + words(60), (80, 150)))
        elif i % 4 == 1:
            x = list(q)
            x[rng.randrange(120)] = "zz"
            docs.append((words(50) + x + words(10), (50, 170)))
        elif i % 4 == 2:
            docs.append((words(200), None))
        else:
            docs.append((words(49) if i < 20 else p[:30] + words(100), None))
    copy = " ".join(words(60))
    rows = [(i, " ".join(d)) for i, (d, _) in enumerate(docs)] + [(102, copy), (103, copy), (104, "a " * 3000)]
    found = {r.doc_id: r for r in compact_windows.repeated_passages(documents(rows)).collect()}
    for i, (d, span) in enumerate(docs):
        assert (found[i].n_spans > 0) == (span is not None), i
        if span:
            assert found[i].component_id == i % 4 and found[i].n_links > 0
            start, end = map(int, found[i].spans.split(",")[0].split(":"))
            assert end - start >= 50 and start <= span[0] + 10 and end >= span[1] - 10
        else:
            assert found[i].component_id == i
    assert [(found[i].component_id, found[i].spans) for i in (102, 103)] == [(102, "0:60")] * 2
    _, verified = compact_windows.passages(documents(rows))
    texts = {}
    for r in verified.collect():
        texts.setdefault((r.a, r.b), []).append(r)
    by_h = {h.h: h.doc_id for h in compact_windows.passages(documents(rows))[0].collect()}
    for (a, b), spans in texts.items():
        cut = {s.h: dict(rows)[by_h[s.h]].split()[s.start : s.end] for s in spans}
        if len(cut) == 2 and len(spans) == 2:
            assert similar(cut[a], cut[b]) >= 0.8


def paragraphs(text):
    return {p for p in re.split(paragraph_sketch.BOUNDARY, text) if p}


def test_sketches_against_sets(documents):
    rng = random.Random(2)
    sentence = lambda: " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randint(1, 6))) + rng.choice([". ", "\n", "! ", " | "])
    texts = {i: "".join(sentence() for _ in range(rng.choice([0, 1, 2, 5, 20, 60, 300]))) for i in range(0, 120, 3)}
    texts[5], texts[6] = "é" * 9, texts[9]
    found = {r.doc_id: r for r in paragraph_sketch.fingerprints(documents(list(texts.items()))).collect()}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        text, following = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        likeness = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
        r = found[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - likeness(paragraphs(text), paragraphs(edited))) < 1e-12
        assert abs(r.near_next - likeness(paragraphs(text), paragraphs(following))) < 1e-12
    assert found[6].fingerprint == found[9].fingerprint


def test_no_python_in_the_sketch_plan(documents):
    plan = paragraph_sketch.fingerprints(documents([(1, "a. b"), (2, "c. d")]).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_messy(messy, documents):
    for operator in (compact_windows.repeated_passages, paragraph_sketch.fingerprints):
        assert operator(messy).count() == messy.count()
        assert operator(documents([])).collect() == []
    one = paragraph_sketch.fingerprints(documents([(1, "a. b. c")])).first()
    assert one.near_next == 1.0


def test_rows_are_filled_with_the_difference_and_dealt_whole(spark):
    """The cells of a difference are those of both sides subtracted, and dealing keeps each digest once per side."""
    rng = random.Random(7)
    sides = [([], []), ([1], [1]), ([1, 2], [])]
    for n in (1, 3, 6, 40):
        both = [rng.getrandbits(63) for _ in range(n)]
        sides.append((both + [rng.getrandbits(63) for _ in range(n)], both[::-1] + [rng.getrandbits(63)]))
    rows = spark.createDataFrame(sides, "a ARRAY<LONG>, b ARRAY<LONG>")
    ps = paragraph_sketch
    minus = ps.difference_of("a", "b", "3", 12)
    apart = f"zip_with({ps.cells_of('a', '3', 12)}, {ps.cells_of('b', '3', 12)}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'c', x.c ^ y.c))"
    dealt = ps._split("named_struct('a', a, 'b', b)", "4", 5)
    found = rows.selectExpr("a", "b", f"{minus} AS minus", f"{apart} AS apart", f"{dealt} AS dealt", f"{ps.taken_apart(minus, '3', 12, 5)} AS n").collect()
    for r in found:
        assert r.minus == r.apart and len(r.dealt) == 4
        assert sorted(k for d in r.dealt for k in d.a) == sorted(r.a) and sorted(k for d in r.dealt for k in d.b) == sorted(r.b)
        assert r.n in (None, len(set(r.a) ^ set(r.b)))
    assert [r.n for r in found[:4]] == [0, 0, 2, 2] and found[-1].n is None


def test_links_in_crowds_against_brute_force(documents):
    """Texts under a value that many share: each link of 50 words at the similarity is counted, and no other."""
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, long, docs = words(40), words(70), []
    docs += [words(20) + line + words(25) for _ in range(60)]
    for _ in range(12):
        both = line + words(20)
        docs += [words(10) + both + words(10) for _ in range(2)]
    for i in range(60):
        x = list(long)
        if i % 3 == 0:
            x[rng.randrange(70)] = f"edit{i}"
        docs.append(words(10) + x + words(i % 7))
    docs += [line + both[40:] + long, ["a"] * 200, ["a"] * 150 + words(5)]
    stretches = [{frozenset(tuple(d[k : k + 5]) for k in range(i, i + 46)) for i in range(len(d) - 49)} for d in docs]
    whole = [set().union(*s) for s in stretches]
    linked = {i: set() for i in range(len(docs))}
    for i in range(len(docs)):
        for j in range(i):
            if len(whole[i] & whole[j]) and any(len(x & y) >= 0.8 * len(x | y) for x in stretches[i] for y in stretches[j]):
                linked[i].add(j)
                linked[j].add(i)
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    # repeated rows are no texts of their own, but count as copies
    found = {r.doc_id: r for r in compact_windows.repeated_passages(documents(rows + [rows[70], (500, rows[71][1])])).collect()}
    twice = {70, 71}
    for i, others in linked.items():
        assert found[i].n_links == len(others) + (i in twice), i
        assert (found[i].n_spans > 0) == bool(others), i
    assert found[500].n_links == found[71].n_links and found[500].component_id == found[71].component_id == 70
    assert {found[i].component_id for i in range(84, 145)} == {found[84].component_id}
    _, listed = compact_windows.passages(documents(rows))
    pairs = {frozenset((r.a, r.b)) for r in listed.collect()}
    assert len(pairs) == sum(map(len, linked.values())) / 2
