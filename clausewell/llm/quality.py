"""Quality classifier by positive-unlabelled learning.

A linear model over shape features of the text (character classes, repetition,
word and line statistics) minimises the non-negative unbiased PU risk

    prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)])

with the logistic loss, from trusted positives P, unlabelled texts U and a class
prior.  The prior is estimated from P and U alone, no negative label is read: a
classifier of P against U ranks texts it was not fitted on, and the prior is the
least ratio, over all thresholds, of the shares of U and of P above it -- above the
best threshold U holds positives only.

The model is fitted on a bounded sample (about ``sample`` rows each of P and U, by
hash of id and text).

Edge cases: null reads as empty; empty texts are scored from their (zero)
features; without positives or unlabelled rows every score is 0.5; an id that is labelled both
ways is a positive; labels of no document and null ones are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textbits import Words, mix, slices, spread

#: Character classes: each string is one, then digits, upper and lower case,
#: bytes of other scripts, and the rest.
_CLASSES = [" ", "\n", "\t\r\v\f", ".", ",", "|", "!", "?", "*", "%", "$", "&", "#", "-_", "\"'`", "()[]{}<>", "/\\", ":;", "@=+~^"]
_CLASS_OF = np.full(256, len(_CLASSES) + 4, dtype=np.int64)
for _i, _s in enumerate(_CLASSES):
    _CLASS_OF[list(_s.encode())] = _i
_CLASS_OF[48:58] = len(_CLASSES)
_CLASS_OF[65:91] = len(_CLASSES) + 1
_CLASS_OF[97:123] = len(_CLASSES) + 2
_CLASS_OF[128:] = len(_CLASSES) + 3
N_CLASSES = len(_CLASSES) + 5
N_FEATURES = N_CLASSES + 9


def _per_row(row: np.ndarray, value: np.ndarray | None, rows: int) -> np.ndarray:
    return np.bincount(row, weights=value, minlength=rows).astype(np.float64)


def _repeats(row: np.ndarray, key: np.ndarray, rows: int) -> np.ndarray:
    """Elements of each row that repeat an earlier one of the row."""
    distinct = np.unique(mix(key + mix(row.astype(np.uint64))), return_index=True)[1]
    return _per_row(row, None, rows) - _per_row(row[distinct], None, rows)


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """N_FEATURES numbers for each text of a slice."""
    rows = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    out = np.zeros((rows, N_FEATURES))
    share = np.bincount(row * N_CLASSES + _CLASS_OF[raw], minlength=rows * N_CLASSES).reshape(rows, N_CLASSES)
    out[:, :N_CLASSES] = np.sqrt(share / np.maximum(size, 1)[:, None])
    words = Words(raw, offsets)
    own = spread(words.row_at)
    n = np.diff(words.row_at).astype(np.float64)
    (h,) = words.hashes()
    length = (words.ends - words.starts).astype(np.float64)
    f = out[:, N_CLASSES:]
    f[:, 0] = np.log1p(n)
    f[:, 1] = _per_row(own, length, rows) / np.maximum(n, 1)
    f[:, 2] = np.sqrt(_per_row(own, length**2, rows) / np.maximum(n, 1))
    for k, step in ((3, 1), (4, 2), (5, 3)):
        same = np.flatnonzero((h[step:] == h[:-step]) & (own[step:] == own[:-step])) if len(h) > step else np.zeros(0, int)
        f[:, k] = np.sqrt(_per_row(own[same], None, rows) / np.maximum(n, 1))
    f[:, 6] = _repeats(own, h, rows) / np.maximum(n, 1)
    lines = Words(raw, offsets, np.arange(256) == 10)
    line_row, line_n = spread(lines.row_at), np.diff(lines.row_at).astype(np.float64)
    (line_h,) = lines.hashes()
    f[:, 7] = _repeats(line_row, line_h, rows) / np.maximum(line_n, 1)
    f[:, 8] = np.log1p(n / np.maximum(line_n, 1))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _descend(gradient, width: int, steps: int, rate: float) -> np.ndarray:  # noqa: ANN001
    """Full-batch Adam from zero."""
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _scaled(p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.concatenate([p, u])
    scale = both.std(axis=0)
    return both.mean(axis=0), np.where(scale > 1e-9, scale, 1)


def _with_bias(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.hstack([(x - mean) / scale, np.ones((len(x), 1))])


def least_ratio(sp: np.ndarray, su: np.ndarray, delta: float = 0.1) -> float:
    """The class prior from scores of positives and of unlabelled rows: the ratio of
    their shares above the threshold whose upper confidence bound is least."""
    at = np.unique(sp)
    qp = 1 - np.searchsorted(np.sort(sp), at) / len(sp)
    qu = 1 - np.searchsorted(np.sort(su), at) / len(su)
    slack = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))
    best = int(np.argmin((qu + slack) / qp))
    return float(np.clip(qu[best] / qp[best], 0.01, 0.99))


def estimate_prior(p: np.ndarray, u: np.ndarray, steps: int = 400, rate: float = 0.03) -> float:
    """Class prior of u by two-fold held-out scores of a logistic model of p against u."""
    mean, scale = _scaled(p, u)
    p, u = _with_bias(p, mean, scale), _with_bias(u, mean, scale)
    sp, su = np.zeros(len(p)), np.zeros(len(u))
    for fold in (0, 1):
        a, b = p[1 - fold :: 2], u[1 - fold :: 2]
        if not len(a) or not len(b):
            return 0.5
        w = _descend(lambda w: b.T @ _sigmoid(b @ w) / len(b) - a.T @ (1 - _sigmoid(a @ w)) / len(a) + w / len(a), p.shape[1], steps, rate)  # noqa: B023
        sp[fold::2], su[fold::2] = p[fold::2] @ w, u[fold::2] @ w
    return least_ratio(sp, su)


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.03, decay: float | None = None) -> dict:
    """Minimise the non-negative PU risk of a linear logistic model.

    The risk is estimated from differences of means, so its noise falls with the
    sample; the weight decay follows it.
    """
    decay = 2 / len(p) if decay is None else decay
    mean, scale = _scaled(p, u)
    p, u = _with_bias(p, mean, scale), _with_bias(u, mean, scale)

    def gradient(w: np.ndarray) -> np.ndarray:
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        gain = -prior * (p.T @ (1 - sp)) / len(p)
        rest = (u.T @ su) / len(u) - prior * (p.T @ sp) / len(p)
        risk = np.mean(-np.log(1 - su + 1e-12)) - prior * np.mean(-np.log(1 - sp + 1e-12))
        # Below zero the negative part has over-fitted: walk it back.
        return (gain + rest if risk >= 0 else -rest) + decay * w

    return {"mean": mean, "scale": scale, "w": _descend(gradient, p.shape[1], steps, rate)}


def fit(docs: DataFrame, labels: DataFrame, sample: int = 10_000) -> dict:
    """Train on docs(doc_id, text) -- the unlabelled texts -- and labels(doc_id,
    quality); both hold training rows only."""
    good = labels.where("quality = 1").select("doc_id")
    n_good, total = good.count(), docs.count()
    if not n_good or not total:
        return {"prior": 0.5}
    space = 1 << 40
    cut = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(space)) < int(space * min(1, sample / n))
    # About `sample` rows, by the filter: the side that is broadcast is bounded.
    trusted = good.where(cut(n_good, "doc_id")).distinct().withColumn("trusted", F.lit(True))
    rows = docs.select("doc_id", "text").join(F.broadcast(trusted), "doc_id", "left").withColumns({"trusted": F.coalesce("trusted", F.lit(False)), "open": cut(total, "text", "doc_id")}).where("trusted or open")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(raw, offsets) for _, raw, offsets in slices(batch.column(0))]
            if x:
                yield pa.RecordBatch.from_arrays([pa.array(list(np.concatenate(x)), pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "trusted", "open"])

    found = rows.select("text", "trusted", "open").mapInArrow(run, "x array<double>, trusted boolean, open boolean").toPandas()
    x = np.array(found["x"].tolist()).reshape(-1, N_FEATURES)
    p, u = x[found["trusted"].to_numpy()], x[found["open"].to_numpy()]
    if not len(p) or not len(u):
        return {"prior": 0.5}
    # In an order of their own, so that nothing depends on the order of arrival.
    p, u = (x[np.lexsort(x.T)] for x in (p, u))
    prior = estimate_prior(p, u)
    return {"prior": prior} | fit_nnpu(p, u, prior)


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row: the modelled probability of good quality."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.full(len(batch), model["prior"])
            if "w" in model:
                for first, raw, offsets in slices(batch.column(1)):
                    x = (features(raw, offsets) - model["mean"]) / model["scale"]
                    out[first : first + len(x)] = _sigmoid(x @ model["w"][:-1] + model["w"][-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, score double")
