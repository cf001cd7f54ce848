"""Language identification by nearest clustered centroid.

Texts become TF-IDF vectors of hashed byte trigrams (letters only, lower case),
scaled to length one.  Each language is described by a few centroids, found by
spherical k-means on a bounded sample of its labelled texts; a text takes the
language of the centroid with the largest cosine.

A text is rejected if that cosine is below its language's floor.  Short texts lie
farther from every centroid, so there is a floor for each order of magnitude of the
number of distinct trigrams, set on texts, and pieces of them, that were held out from
k-means in turn.  A text is also rejected if noise, a random choice of hashed
trigrams, explains its trigrams better than any learnt language does.

Document frequencies cover all training rows.  The k-means sample is bounded: about
``sample`` texts a language, chosen by hash of the text; copies count once.

Edge cases: null texts and texts without a letter get ``und``, score 0, rejected;
without any training row every text does.  Repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import release_memory
from .textbits import slices

DIM = 4096
#: Floors are kept by the binary logarithm of the number of distinct trigrams.
CLASSES = 13
#: Parts of the sample that are held out in turn.
FOLDS = 5
#: Languages of a model at most.
MOST_LANGUAGES = 1000
#: Characters of the pieces of held-out texts that floors are set on.
PIECES = [1 << k for k in range(5, 13)]
#: Rows of a dense block of counts.
ROWS = 512
#: Letters in lower case; all other ASCII bytes become a space.
_LETTERS = np.full(256, 32, dtype=np.uint8)
_LETTERS[97:123] = _LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def gram_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed byte trigrams, a dense row of DIM for each text."""
    rows = len(offsets) - 1
    b = _LETTERS[raw]
    if len(b) < 3:
        return np.zeros((rows, DIM), dtype=np.float32)
    a, m, z = b[:-2], b[1:-1], b[2:]
    row = np.repeat(np.arange(rows), np.diff(offsets))
    fine = (row[:-2] == row[2:]) & ~((m == 32) & ((a == 32) | (z == 32)))
    code = a.astype(np.uint32) | m.astype(np.uint32) << 8 | z.astype(np.uint32) << 16
    code = (code * np.uint32(2654435761)) >> np.uint32(20)
    at = row[:-2] * DIM + code
    return np.bincount(at[fine], minlength=rows * DIM).reshape(rows, DIM).astype(np.float32)


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(norm > 0, norm, 1)[:, None]


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Texts that hold each hashed trigram, over all rows, and the row count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIM, dtype=np.int64), 0
        for batch in batches:
            n += len(batch)
            for _, raw, offsets in slices(batch.column(0), rows=ROWS):
                total += (gram_counts(raw, offsets) > 0).sum(axis=0)
        if n:
            at = np.append(np.flatnonzero(total), DIM)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total[at[:-1]], n))], names=["gram", "n"])

    counted = docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    out, n = np.zeros(DIM), 0
    for r in counted.collect():  # at most DIM + 1 rows
        if r["gram"] == DIM:
            n = r["n"]
        else:
            out[r["gram"]] = r["n"]
    return out, n


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids by spherical k-means from farthest-first seeds."""
    seeds = [x.mean(axis=0)]
    while len(seeds) < min(k, len(x)) + 1:
        closest = np.max(x @ np.array(seeds).T, axis=1)
        seeds.append(x[int(np.argmin(closest))])
    c = np.array(seeds[1:])
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.array([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        norm = np.linalg.norm(c, axis=1)
        c /= np.where(norm > 0, norm, 1)[:, None]
    return c


def size_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum((counts > 0).sum(axis=1), 1)).astype(np.int64)


def floors_of(classes: np.ndarray, cosines: np.ndarray, low: float, slack: float, least: int = 20) -> np.ndarray:
    """A floor for each size class: ``slack`` times the ``low`` quantile of the cosines
    seen there; none below the classes that were seen, and never one above a larger
    class's."""
    floors = np.full(CLASSES, np.nan)
    for k in range(CLASSES):
        if (classes == k).sum() >= least:
            floors[k] = slack * np.quantile(cosines[classes == k], low)
    known = np.flatnonzero(~np.isnan(floors))
    if not len(known):
        return np.zeros(CLASSES)
    floors[: known[0]] = 0
    for k in range(known[0], CLASSES):
        floors[k] = floors[k] if not np.isnan(floors[k]) else floors[k - 1]
    return np.minimum.accumulate(floors[::-1])[::-1]


def evidence(counts: np.ndarray) -> np.ndarray:
    """Of each hashed trigram, for the language of these summed counts and against noise:
    the logarithm of how many times as frequent it is there as in a random choice."""
    return np.log((counts + 1) / (counts.sum() + DIM) * DIM).astype(np.float32)


def learn_language(texts: list[str], idf: np.ndarray, centroids: int, low: float, slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centroids, floors, evidence) of one language's sample.  For the floors, the texts
    of each fold in turn are held out from k-means."""

    seen = np.zeros(DIM)
    x = []
    for _, raw, offsets in slices(pa.array(texts, pa.string()), rows=ROWS):
        counts = gram_counts(raw, offsets)
        seen += np.log1p(counts).sum(axis=0)
        x.append(unit_vectors(counts, idf))
    x = np.concatenate(x)
    some = np.flatnonzero(np.abs(x).sum(axis=1) > 0)
    if not len(some):
        return np.zeros((0, DIM)), np.zeros(CLASSES), evidence(seen)
    c = cluster(x[some], centroids)
    if len(some) < 2 * FOLDS:
        return c, np.zeros(CLASSES), evidence(seen)
    found = []
    for fold in range(FOLDS):
        own = [texts[i] for i in some[fold::FOLDS]]
        others = cluster(x[np.delete(some, np.s_[fold::FOLDS])], centroids)
        for _, raw, offsets in slices(pa.array(own + [t[:n] for t in own for n in PIECES if len(t) > n], pa.string()), rows=ROWS):
            counts = gram_counts(raw, offsets)
            found.append((size_class(counts), (unit_vectors(counts, idf) @ others.T).max(axis=1)))
    classes, cosines = (np.concatenate(v) for v in zip(*found, strict=True))
    return c, floors_of(classes, cosines, low, slack), evidence(seen)


def fit(docs: DataFrame, centroids: int = 4, sample: int = 1000, low: float = 0.01, slack: float = 0.5) -> dict:
    """Train on columns text, lang (rows with a null lang or text don't count).

    The floors are ``slack`` times the ``low`` quantile of held-out cosines: rejecting a
    good text costs more than keeping a strange one.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    seen, n = document_frequencies(rows)
    idf = (np.log((1 + n) / (1 + seen)) + 0.05).astype(np.float32)
    shared = spark.sparkContext.broadcast(idf)
    space = 1 << 40
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages: the model would be too large to broadcast")
    shares = spark.createDataFrame([(r["lang"], int(space * min(1.0, sample / r["n"]))) for r in sizes], "lang string, share bigint")
    picked = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(shares), "lang").where(F.pmod("h", F.lit(space)) < F.col("share"))
    chosen = picked.select("lang", "h", "text").dropDuplicates(["lang", "h"])

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        c, floors, noise = learn_language(pdf.sort_values("h")["text"].tolist(), shared.value, centroids, low, slack)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]] * len(c), "centroid": list(c.astype(np.float32)), "floors": [floors] * len(c), "evidence": [noise] * len(c)})

    found = chosen.groupBy("lang").applyInPandas(learn, "lang string, centroid array<float>, floors array<double>, evidence array<float>").collect()
    found.sort(key=lambda r: (r["lang"], list(r["centroid"])))
    by_lang = {r["lang"]: r["evidence"] for r in found}
    as_rows = lambda x, width: np.array(list(x), dtype=np.float32).reshape(-1, width)
    return {"idf": idf, "evidence": as_rows(by_lang.values(), DIM), "langs": [r["lang"] for r in found], "centroids": as_rows((r["centroid"] for r in found), DIM), "floors": as_rows((r["floors"] for r in found), CLASSES)}


def judged(texts: pa.Array, m: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest centroid (their count: none), score, rejected of each text."""
    none = len(m["langs"])
    best, score = np.full(len(texts), none), np.zeros(len(texts))
    rejected = np.ones(len(texts), dtype=bool)
    if not none:
        return best, score, rejected
    for first, raw, offsets in slices(texts, rows=ROWS):
        rows = len(offsets) - 1
        # Without a letter among ASCII and no other byte there is none at all.
        letters = np.add.reduceat(np.append(_LETTERS[raw] != 32, False), offsets[:-1]) * (np.diff(offsets) > 0)
        plain = np.add.reduceat(np.append((_LETTERS[raw] != 32) & (raw < 128), False), offsets[:-1]) * (np.diff(offsets) > 0)
        some = letters > 0
        for i in np.flatnonzero(some & (plain == 0)):
            some[i] = any(c.isalpha() for c in raw[offsets[i] : offsets[i + 1]].tobytes().decode())
        counts = gram_counts(raw, offsets)
        cosine = unit_vectors(counts, m["idf"]) @ m["centroids"].T
        noise = (np.log1p(counts) @ m["evidence"].T).max(axis=1) < 0
        near = np.argmax(cosine, axis=1)
        top = cosine[np.arange(rows), near]
        at = slice(first, first + rows)
        best[at] = np.where(some, near, none)
        score[at] = np.where(some, np.clip(top, 0, 1), 0)
        rejected[at] = ~some | noise | (top < m["floors"][near, size_class(counts)])
    return best, score, rejected


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row; texts are the only input."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        langs = np.array([*m["langs"], "und"], dtype=object)
        for batch in batches:
            best, score, rejected = judged(batch.column(1), m)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs[best].tolist(), pa.string()), pa.array(score), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, rejected boolean")


def keep_near(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` that are not rejected, each judged where it stands."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            yield batch.filter(pa.array(~judged(batch.column(text), shared.value)[2]))

    return docs.mapInArrow(run, docs.schema)
