"""Toxicity by FTRL-proximal logistic regression.

Features are 64-bit hashes of word unigrams, word stems (leading bytes), bigrams
and skip-grams over one and two words, present or absent.  FTRL-proximal keeps a
learning rate for every coordinate and sets weak weights to exactly zero by L1, so
the model is a short sorted list of hashes and weights.  It is broadcast, and its
size is checked.

Fitted on a bounded sample: at most about ``sample`` labelled rows, by hash of the
id.  Edge cases: null reads as empty; a text without words gets the bias alone;
without labels every score is 0.5; an id that is labelled both ways is toxic; labels of no
document and null ones are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textbits import NON_WORD, Words, mix, slices, spread

STEMS = (5, 6, 7, 8)
_SALT = [np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64)) for k in range(16)]
#: The broadcast model never holds more weights than this.
MOST_WEIGHTS = 1_000_000
#: Ranges of hashes that are counted one at a time.
RANGES = 16
_STARTS = np.array([i << 60 for i in range(1, RANGES)], np.uint64)


def gram_hashes(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) arrays, one pair for each kind of feature; rows ascend."""
    words = Words(raw, offsets, NON_WORD)
    row = spread(words.row_at)
    h, *stems = words.hashes(*STEMS)
    yield row, h
    size = words.ends - words.starts
    for k, (stem, n) in enumerate(zip(stems, STEMS, strict=True)):
        long = size > n
        yield row[long], mix(stem[long] + _SALT[k])
    for k, step in ((8, 1), (9, 2), (10, 3)):
        if len(h) > step:
            same = row[step:] == row[:-step]
            yield row[:-step][same], mix(h[:-step][same] * _SALT[k] + h[step:][same])


class Ftrl:
    """Per-coordinate FTRL-proximal with L1 and L2, over indexed features."""

    def __init__(self, n: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.1):
        self.z, self.n = np.zeros(n), np.zeros(n)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        rate = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / rate)

    def learn(self, at: np.ndarray, label: float, weight: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30)))
        g = (p - label) * weight
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - step * w
        self.n[at] += g * g


def train(texts: pa.Array, labels: np.ndarray, rounds: int = 6, rarest: int = 3) -> tuple[np.ndarray, np.ndarray, float]:
    """Sorted hashes, weights and bias; features in fewer than ``rarest`` texts go."""
    def present(first: int, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, h = (np.concatenate(x) for x in zip(*gram_hashes(raw, offsets), strict=True))
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        return row[new] + first, h[new]

    # Hashes are counted range by range, so that only one range is sorted at a time; what is
    # rare goes before texts are kept as numbers.
    ranges: list[list[np.ndarray]] = [[] for _ in range(RANGES)]
    for part in slices(texts):
        h = np.sort(present(*part)[1])
        for own, some in zip(ranges, np.split(h, np.searchsorted(h, _STARTS)), strict=True):
            own.append(some)
    frequent = []
    for i in range(RANGES):
        h, n = np.unique(np.concatenate(ranges[i]) if ranges[i] else np.zeros(0, np.uint64), return_counts=True)
        ranges[i] = []
        frequent.append(h[n >= rarest])
    known = np.concatenate(frequent)
    rows, places = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for part in slices(texts):
        row, h = present(*part)
        place = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
        fine = known[place] == h if len(known) else np.zeros(len(h), bool)
        rows.append(row[fine].astype(np.int32))
        places.append(place[fine].astype(np.int32))
    row, index = np.concatenate(rows), np.concatenate(places)
    del rows, places
    model = Ftrl(len(known) + 1)
    at = np.searchsorted(row, np.arange(len(labels) + 1))
    bias = np.array([len(known)])
    for _ in range(rounds):
        for i, label in enumerate(labels):
            model.learn(np.concatenate([index[at[i] : at[i + 1]], bias]), float(label), 1.0)
    w = model.weights()
    some = np.flatnonzero(w[:-1])
    return known[some], w[some], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> dict:
    """Train on docs(doc_id, text) and labels(doc_id, toxic) of training rows."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if not n:
        return {"keys": np.zeros(0, np.uint64), "weights": np.zeros(0), "bias": 0.0}
    space = 1 << 20
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(space)) < int(space * min(1, sample / n)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # about `sample` rows

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "doc_id"])
        keys, weights, bias = train(pa.array(pdf["text"].tolist(), pa.string()), pdf["toxic"].to_numpy())
        return pd.DataFrame({"key": np.append(keys.view(np.int64), 0), "weight": np.append(weights, bias), "bias": [*[False] * len(keys), True]})

    # One group: the sample is bounded by its parameter.
    found = rows.withColumn("order", F.xxhash64("doc_id", F.lit(7))).groupBy(F.lit(0).alias("one")).applyInPandas(learn, "key bigint, weight double, bias boolean").toPandas()
    if not len(found):
        return {"keys": np.zeros(0, np.uint64), "weights": np.zeros(0), "bias": 0.0}
    own = found[~found["bias"].astype(bool)].sort_values("weight", key=np.abs, ascending=False)
    if len(own) > MOST_WEIGHTS:
        raise ValueError(f"{len(own)} weights; raise l1 or lower the sample")
    keys = own["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return {"keys": keys[order], "weights": own["weight"].to_numpy()[order], "bias": float(found["weight"][found["bias"].astype(bool)].iloc[0])}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row: the modelled probability of toxicity."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        keys, low = m["keys"], np.uint64((1 << 22) - 1)
        maybe = np.zeros(1 << 22, dtype=bool)
        maybe[keys & low] = True
        for batch in batches:
            total = np.full(len(batch), m["bias"])
            for first, raw, offsets in slices(batch.column(1)):
                rows, found = [], []
                for row, h in gram_hashes(raw, offsets):
                    at = np.flatnonzero(maybe[h & low])
                    where = np.minimum(np.searchsorted(keys, h[at]), max(0, len(keys) - 1))
                    hit = keys[where] == h[at] if len(keys) else np.zeros(0, bool)
                    rows.append(row[at][hit])
                    found.append(where[hit])
                pair = np.unique(np.concatenate(rows) * np.int64(1 << 32) + np.concatenate(found))
                total[first : first + len(offsets) - 1] += np.bincount(pair >> 32, weights=m["weights"][pair & ((1 << 32) - 1)], minlength=len(offsets) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, score double")
