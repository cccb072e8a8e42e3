"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolink.llm.common import trimmed, whole_text

SAMPLE_ROWS = 12_000
BITS = 20
UPDATES = 48_000

_SEPARATORS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


@dataclass(frozen=True)
class Model:
    """A sparse logistic model: the weights that the L1 penalty left, by feature index.

    At most ``2 ** bits`` weights exist, whatever the corpus holds, so the model may be broadcast.
    """

    bits: int
    bias: float
    index: np.ndarray
    weight: np.ndarray
    trained: bool


def features(text: str, bits: int = BITS) -> np.ndarray:
    """Hashed words, pairs of neighbours and pairs one and two words apart, in the order of the text."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(_SEPARATORS).split()
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    shift = np.uint64(64 - bits)
    parts = [(h * _MIX[0]) >> shift]
    for gap in (1, 2, 3):
        if len(h) > gap:
            parts.append(((h[:-gap] * _MIX[gap] ^ (h[gap:] >> np.uint64(7))) * _MIX[0]) >> shift)
    return np.concatenate(parts).astype(np.int64)


def train(
    rows: list[tuple[np.ndarray, int]], bits: int = BITS, updates: int = UPDATES,
    alpha: float = 1.0, beta: float = 1.0, l1: float = 6.0, l2: float = 1.0,
) -> tuple[float, np.ndarray, np.ndarray]:
    """FTRL-proximal over rows of distinct feature indices: bias, indices and weights that are not zero.

    Small samples are gone over more often, until about ``updates`` rows have been seen.
    """
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = nb = 0.0
    for _ in range(max(4, updates // max(1, len(rows)))):
        for index, label in rows:
            zi, ni = z[index], n[index]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + root) / alpha + l2))
            b = -zb / ((beta + np.sqrt(nb)) / alpha)
            g = 1.0 / (1.0 + np.exp(-np.clip(b + w.sum(), -35.0, 35.0))) - label
            z[index] = zi + g - (np.sqrt(ni + g * g) - root) / alpha * w
            n[index] = ni + g * g
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / alpha * b
            nb += g * g
    index = np.flatnonzero(np.abs(z) > l1)
    weight = (np.sign(z[index]) * l1 - z[index]) / ((beta + np.sqrt(n[index])) / alpha + l2)
    return float(-zb / ((beta + np.sqrt(nb)) / alpha)), index, weight


def held_out() -> F.Column:
    """True for ids that no label is learnt from; a null id has no label and counts as not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, bits: int = BITS) -> Model:
    """A model fitted on about ``sample_rows`` labelled documents at most, chosen by a hash of their id.

    Only ids that are not held out count. Where an id has several labels, the highest holds; null
    labels do not count. Of several rows under one id, the one whose features come first counts. Features are made where the texts lie; one task then sees the bounded sample.
    """
    known = (
        labels.filter(~held_out()).filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_llm_label"))
    )
    total = known.count()
    share = min(1.0, sample_rows / max(1, total))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select("doc_id", whole_text().alias("_llm_text")).join(F.broadcast(chosen), "doc_id")

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [np.unique(features(t, bits)).astype("<u4").tobytes() for t in batch._llm_text]
            yield pd.DataFrame({
                "turn": [xxhash.xxh64_intdigest(str(i)) >> 1 for i in batch.doc_id],
                "label": batch._llm_label.to_numpy(), "packed": packed,
            })

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["turn", "packed"], kind="stable")
        bias, index, weight = train(
            [(np.frombuffer(p, "<u4").astype(np.int64), y) for p, y in zip(group.packed, group.label)], bits
        )
        return pd.DataFrame({"index": np.append(index, -1), "weight": np.append(weight, bias)})

    featured = rows.mapInPandas(trimmed(featurise), "turn LONG, label INT, packed BINARY")
    # one row per id, so that the last step is bounded by the sample however often an id stands in the table
    single = featured.groupBy("turn").agg(F.min(F.struct("packed", "label")).alias("one"))
    table = (
        single.select(F.lit(0).alias("k"), "turn", "one.*")
        .groupBy("k").applyInPandas(learn, "index LONG, weight DOUBLE").toPandas()
    )
    table = table.sort_values("index")
    bias = table.weight[table["index"] == -1]
    rest = table[table["index"] >= 0]
    return Model(bits, float(bias.sum()), rest["index"].to_numpy(), rest.weight.to_numpy(), len(bias) > 0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; every row is scored on its whole text.

    A feature counts once however often it occurs. Null and empty texts get the score of the bias;
    with no labelled row to learn from, every score is 0. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.index, model.weight))
    bits, bias, trained = model.bits, model.bias, model.trained

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, weight = shared.value
        dense = np.zeros(1 << bits, dtype=np.float32)
        dense[index] = weight
        for texts in batches:
            out = np.zeros(len(texts))
            for i, text in enumerate(texts):
                if trained:
                    index = features(text, bits)
                    index = np.unique(index[dense[index] != 0])
                    out[i] = bias + dense[index].sum(dtype=np.float64)
            out = 1.0 / (1.0 + np.exp(-np.clip(out, -35.0, 35.0))) if trained else out
            yield pd.Series(out)

    probability = F.pandas_udf(run, "double")
    scored = docs.drop("score", "predicted").withColumn("score", probability(whole_text()))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
