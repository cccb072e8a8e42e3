import numpy as np
import xxhash

from chronolink.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(ids, prints):
    """Least id reachable, by spreading minima until nothing changes."""
    v = np.array(prints, dtype=np.uint64)
    near = np.bitwise_count(v[:, None] ^ v[None]) <= 3
    label = np.array(ids)
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label.tolist()
        label = new


def test_trie_against_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(20):
        base = rng.integers(0, 2**64, size=5, dtype=np.uint64)
        made = set()
        for _ in range(int(rng.integers(1, 300))):
            x = int(base[rng.integers(5)])
            for bit in rng.integers(0, 64, size=rng.integers(0, 5)):
                x ^= 1 << int(bit)
            made.add(x)
        v = np.array(sorted(made), dtype=np.uint64)
        found = simhash.trie_forest(v, np.array([0])).tolist()
        assert found == brute_components(list(range(len(v))), v)


def test_every_close_pair_shares_a_key():
    rng = np.random.default_rng(2)
    for level in range(simhash.LEVELS):
        masks = simhash.masks(level)
        assert len(masks) == 4 ** (level + 1)
        for _ in range(200):
            flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            assert any(not flips & m for m in masks)
    assert min(bin(m).count("1") for m in simhash.masks(simhash.LEVELS - 1)) >= 43


def test_components_and_split_keys(spark, documents):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    base = [" ".join(rng.choice(words, 200)) for _ in range(6)]
    rows = []
    for i in range(150):
        text = base[i % 6].split()
        if i % 3:
            text[int(rng.integers(200))] = "changed"
        rows.append((i, " ".join(text) if i % 10 else " ".join(rng.choice(words, 50))))
    rows += [(900, None), (901, ""), (902, " "), (903, "A"), (904, "a")]
    want = dict(zip([i for i, _ in rows], brute_components([i for i, _ in rows], [brute_fingerprint(t) for _, t in rows])))
    for split_rows in (50_000, 2):
        found = simhash.near_duplicates(documents(rows), split_rows=split_rows).collect()
        assert {r.doc_id: r.component_id for r in found} == want
        assert all(r.fp % 2**64 == brute_fingerprint(dict(rows)[r.doc_id]) for r in found)


def test_messy(messy, documents):
    found = simhash.near_duplicates(messy).collect()
    assert len(found) == messy.count()
    empty = {r.component_id for r in found if r.fp == 0}
    assert empty == {2}
    assert simhash.near_duplicates(documents([])).collect() == []
