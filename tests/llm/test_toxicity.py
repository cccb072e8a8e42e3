import zlib

import numpy as np
import pytest

from chronolink.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_ftrl_against_plain_loop():
    """The vector form is the per-coordinate rule."""
    rng = np.random.default_rng(0)
    rows = [(np.unique(rng.integers(0, 64, 10)), int(rng.integers(2))) for _ in range(50)]
    bias, index, weight = toxicity.train(rows, bits=6, updates=0, alpha=0.5, beta=1.0, l1=0.2, l2=0.3)
    z, n, zb, nb = [0.0] * 64, [0.0] * 64, 0.0, 0.0

    def value(i):
        return 0.0 if abs(z[i]) <= 0.2 else -(z[i] - np.sign(z[i]) * 0.2) / ((1.0 + n[i] ** 0.5) / 0.5 + 0.3)

    for _ in range(4):
        for features, label in rows:
            w = [value(i) for i in features]
            b = -zb / ((1.0 + nb**0.5) / 0.5)
            g = 1 / (1 + np.exp(-(b + sum(w)))) - label
            for i, wi in zip(features, w):
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5 * wi
                n[i] += g * g
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / 0.5 * b
            nb += g * g
    assert bias == pytest.approx(-zb / ((1.0 + nb**0.5) / 0.5))
    assert dict(zip(index.tolist(), weight)) == pytest.approx({i: value(i) for i in range(64) if abs(z[i]) > 0.2})


def test_held_out_accuracy_and_whole_texts(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    assert len(model.index) < 20_000
    known = toxicity.score(docs.join(labels, "doc_id"), model).withColumn("held", toxicity.held_out()).filter("held").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in known.doc_id)
    assert (known.toxic == known.predicted).mean() > 0.95
    assert known[known.toxic == 0].predicted.mean() < 0.01
    assert known[known.toxic == 1].predicted.mean() > 0.7
    toxic = known[known.predicted == 1].text.iloc[0]
    late = spark.createDataFrame([(1, "the " * 50_000 + toxic)], "doc_id LONG, text STRING")
    assert toxicity.score(late, model).first().predicted == 1


def test_messy_and_unlabelled(spark, messy, documents):
    none = spark.createDataFrame([], "doc_id LONG, toxic INT")
    model = toxicity.fit(messy, none)
    assert not model.trained
    assert {r.score for r in toxicity.score(messy, model).collect()} == {0.0}
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (7, 0), (8, 0)], "doc_id LONG, toxic INT")
    scored = toxicity.score(messy, toxicity.fit(messy, odd)).collect()
    assert len(scored) == messy.count() and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.score(documents([]), model).collect() == []


def test_an_id_counts_once(spark, documents):
    """Rows that repeat a labelled id many times leave the model as it is."""
    rows = [(i, f"word{i % 3} common text {'bad' if i % 2 else 'fine'} {i % 5}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id LONG, toxic INT")
    once, often = (toxicity.fit(documents(r), labels) for r in (rows, rows + rows[:7] * 40))
    assert once.index.tolist() == often.index.tolist() and once.weight.tolist() == often.weight.tolist() and once.bias == often.bias
