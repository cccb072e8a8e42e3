import numpy as np

from chronolink.llm import hash_forest
from chronolink.llm.queries import queries

SF = "/root/testdata/sf0.01"


def test_recall_against_brute_force(spark):
    found = queries()["op10_hash_forest"](spark, SF).toPandas()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    hits = []
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        got = found[found.query_id == ids[i]].sort_values("rank")
        assert got["rank"].tolist() == list(range(1, 21)) and ids[i] not in set(got.vec_id)
        assert np.allclose(got.score, x[np.searchsorted(ids, got.vec_id)] @ x[i], rtol=0, atol=1e-12)
        hits.append(len(set(best) & set(got.vec_id)) / 20)
    assert np.mean(hits) >= 0.9


def test_deep_prefixes_in_small_runs(spark):
    """With few candidates asked for, queries stop at longer prefixes and still find close neighbours."""
    rng = np.random.default_rng(0)
    base = rng.normal(size=(200, 32))
    x = np.repeat(base, 5, axis=0) + 0.05 * rng.normal(size=(1000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id LONG, embedding ARRAY<FLOAT>")
    found = hash_forest.nearest(df, df.filter("vec_id % 20 = 0"), k=4, enough=50).toPandas()
    assert (found.vec_id // 5 == found.query_id // 5).mean() >= 0.9


def test_odd_vectors_and_ties(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [3.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [None, 1.0]), (7, [1.0]), (40, [0.0, 1.0]), (40, [0.0, 1.0]), (None, [1.0, 1.0]), (60, [-1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id LONG, embedding ARRAY<FLOAT>, key STRING, id INT")
    found = hash_forest.nearest(df, df.filter("vec_id % 20 = 0"), k=3).collect()
    got = {q: [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in (0, 20, 40, 60)}
    assert got[0] == [(2, 3.0), (1, 1.0), (20, 1.0)] and got[20] == [(2, 3.0), (0, 1.0), (1, 1.0)]
    assert got[40] == [(60, 2.0), (0, 0.0), (1, 0.0)] and got[60] == [(40, 2.0), (0, -1.0), (1, -1.0)]
    assert len(found) == 12
    assert hash_forest.nearest(df.limit(0), df.limit(0)).collect() == []


def recall(found, x, queries, k):
    hits = 0
    for q in queries:
        score = x @ x[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -score))[:k]
        hits += len(set(best) & set(found.vec_id[found.query_id == q]))
    return hits / (k * len(queries))


def test_run_longer_than_a_block_and_a_shard(spark, monkeypatch):
    """A tight cluster has one string in all trees; its queries are scored against all of it, over all shards."""
    monkeypatch.setattr(hash_forest, "SHARD_ROWS", 2_000)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(12_000, 8))
    x[::2] = 3 * np.ones(8) + np.arange(8) + 1e-3 * rng.normal(size=(6_000, 8))
    x = x.astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id LONG, embedding ARRAY<FLOAT>")
    found = hash_forest.nearest(df, df.filter("vec_id % 600 = 0"), k=10, trees=4, enough=500).toPandas()
    assert recall(found, x, range(0, 12_000, 600), 10) == 1.0


def test_candidates_follow_the_table():
    assert hash_forest.candidates(500) == 12_000
    for n in (60_000, 200_000, 3_000_000):
        assert hash_forest.candidates(n) >= n / 4


def test_rows_for_a_shard_travel_in_blocks(spark, monkeypatch):
    """However many trees there are, a batch sends each shard one row, not one per vector."""
    sent = []
    spread = type(spark.range(1)).repartitionById
    monkeypatch.setattr(type(spark.range(1)), "repartitionById", lambda df, *a: (sent.append(df), spread(df, *a))[1])
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 16)).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id LONG, embedding ARRAY<FLOAT>").coalesce(2)
    found = hash_forest.nearest(df, df.filter("vec_id % 90 = 0"), k=10, trees=8, enough=100).toPandas()
    assert recall(found, x, range(0, 900, 90), 10) >= 0.5
    rows = sent[0].filter("NOT query").selectExpr("part", "octet_length(id) div 8 AS n").toPandas()
    assert rows.part.nunique() == 8 and rows.n.sum() == 8 * 900 and len(rows) < 900
