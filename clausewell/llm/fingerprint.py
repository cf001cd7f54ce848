"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs (lines).  Every paragraph is hashed to
a wide vector, a document's state is the sum of its paragraphs' vectors: 16 lanes
modulo 2**32 from a 512-bit digest of the whole paragraph, which decide equality,
and 96 lanes modulo 2**32, read as signed, to which each 16-byte shingle of the
paragraph adds one or minus one, which measure likeness.  Sums don't depend on the order, and a paragraph is
inserted or deleted by adding or subtracting its vector -- so the fingerprint of an
edited text is found from the paragraphs that the edit touched.

Likeness of two states: 1 if equal, else the cosine of the signed lanes, not below 0.

Edge cases: null reads as empty; empty texts share the all-zero state (likeness 1);
rows that share an id follow each other in the order of a hash of their texts; null ids
come before all others; the successor of the last row is the first one (of a single
row: itself).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

DENSE, SIGNED = 16, 96
GRAM = 16
#: Ranges at most (beyond it they grow), and keys drawn for each to find the bounds.
MOST_RANGES, DRAWN = 50_000, 20
#: What rows are ordered by: is there an id, the id, the hash of the text.
_KEY = np.dtype([("some", "i1"), ("id", "<i8"), ("h", "<i8")])


def _grams(data: bytes) -> np.ndarray:
    """Signed lanes of the 16-byte shingles that stay within a line."""
    if len(data) < GRAM:
        return np.zeros(SIGNED, dtype=np.int64)
    raw = np.frombuffer(data, np.uint8)
    n = len(raw) - GRAM + 1
    eight = np.lib.stride_tricks.as_strided(raw, (len(raw) - 7, 8), (1, 1))
    eight = np.ascontiguousarray(eight).view("<u8").ravel()
    h = eight[:n] * np.uint64(0x9E3779B97F4A7C15) + (eight[8 : 8 + n] ^ np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    if b"\n" in data:
        breaks = np.zeros(len(raw) + 1, dtype=np.int32)
        np.cumsum(raw == 10, out=breaks[1:])
        h = h[breaks[GRAM:] == breaks[:n]]
    slot = (h >> np.uint64(34)).astype(np.int64) % (2 * SIGNED)
    counted = np.bincount(slot, minlength=2 * SIGNED)
    return counted[:SIGNED] - counted[SIGNED:]


class State:
    """A sum of paragraph vectors: ``add`` and ``remove`` take many at once."""

    __slots__ = ("dense", "signed")

    def __init__(self, dense: np.ndarray | None = None, signed: np.ndarray | None = None):
        self.dense = np.zeros(DENSE, dtype=np.uint32) if dense is None else dense
        self.signed = np.zeros(SIGNED, dtype=np.int32) if signed is None else signed

    @staticmethod
    def of(paragraphs: bytes) -> State:
        """The state of newline-separated paragraphs; empty ones don't count."""
        digests = b"".join([hashlib.blake2b(p, digest_size=64).digest() for p in paragraphs.split(b"\n") if p])
        dense = np.frombuffer(digests, "<u4").reshape(-1, DENSE).sum(axis=0, dtype=np.uint32)
        return State(dense, _grams(paragraphs).astype(np.int32))

    def add(self, other: State) -> State:
        return State(self.dense + other.dense, self.signed + other.signed)

    def remove(self, other: State) -> State:
        return State(self.dense - other.dense, self.signed - other.signed)

    def hex(self) -> str:
        return self.dense.astype("<u4").tobytes().hex() + self.signed.astype("<i4").tobytes().hex()

    def likeness(self, other: State) -> float:
        if np.array_equal(self.dense, other.dense):
            return 1.0
        a, b = self.signed.astype(np.float64), other.signed.astype(np.float64)
        scale = np.sqrt(float(a @ a) * float(b @ b))
        return min(1.0, max(0.0, float(a @ b) / scale)) if scale else 0.0


def edited(text: str, following: str) -> tuple[str, int]:
    """The text with its last quarter replaced, and how much of it was kept."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut], len(text) - cut


def edited_state(text: str, whole: State, new: str, kept: int) -> State:
    """The edited text's state from the whole text's: paragraphs up to the last
    newline that was kept stay in the sum, those after it are exchanged."""
    at = text.rfind("\n", 0, kept) + 1
    return whole.remove(State.of(text[at:].encode())).add(State.of(new[at:].encode()))


def _keys(ids: pa.Array, hashes: pa.Array) -> np.ndarray:
    out = np.zeros(len(ids), dtype=_KEY)
    out["some"] = pc.is_valid(ids).to_numpy(zero_copy_only=False)
    out["id"] = pc.fill_null(ids, 0).to_numpy()
    out["h"] = hashes.to_numpy()
    return out


def range_bounds(keys: DataFrame, n: int, tasks: int) -> np.ndarray:
    """Keys of ``keys`` (doc_id, h) that cut it into about ``tasks`` ranges.  Which keys
    are drawn decides the sizes of the ranges only."""
    space = 1 << 40
    share = int(space * min(1.0, DRAWN * tasks / max(1, n)))
    drawn = keys.where(F.pmod(F.xxhash64("doc_id", "h"), F.lit(space)) < share).distinct().toArrow()
    found = np.sort(_keys(drawn.column(0).combine_chunks(), drawn.column(1).combine_chunks()))
    return found[np.unique(np.linspace(0, len(found), tasks + 1, dtype=np.int64)[1:-1])] if len(found) > 1 else found[:0]


def dealt_ranges(rows: DataFrame, bounds: np.ndarray, least: np.ndarray) -> DataFrame:
    """rows (doc_id, h, text) with the range that each belongs to.  The first row of a
    range goes to the range before it too, marked as ahead, and the least row of all
    to the last range, so that a task finds the successor of its last row.  Bounds are
    keys of rows, so the first row of a range is the one whose key is the bound."""
    shared = rows.sparkSession.sparkContext.broadcast((bounds, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, least = shared.value
        for batch in batches:
            keys = _keys(batch.column(0), batch.column(1))
            own = np.searchsorted(bounds, keys, side="right")
            first = np.flatnonzero((own > 0) & (bounds[own - 1] == keys)) if len(bounds) else np.zeros(0, np.int64)
            lowest = np.flatnonzero(keys == least)
            ahead = pa.RecordBatch.from_arrays([c.take(pa.array(np.concatenate([first, lowest]))) for c in batch.columns], names=batch.schema.names)
            to = np.concatenate([own[first] - 1, np.full(len(lowest), len(bounds))])
            for part, at, is_ahead in ((batch, own, False), (ahead, to, True)):
                if len(part):
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(at, pa.int32()), pa.array(np.full(len(part), is_ahead))], names=[*batch.schema.names, "range", "ahead"])

    marked = rows.mapInArrow(run, "doc_id bigint, h bigint, text string, range int, ahead boolean")
    return marked.repartitionById(len(bounds) + 1, "range").sortWithinPartitions("ahead", "doc_id", "h", "text")


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


_SQL = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_task: int = 10_000, bytes_per_task: int = 32 << 20) -> DataFrame:
    """Every row's fingerprint, its edited text's, and their likenesses.

    Rows are dealt by ranges of (id, hash of the text) in one shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    key = F.struct(F.col("doc_id").isNotNull().alias("some"), F.coalesce("doc_id", F.lit(0)).alias("id"), "h")
    stats = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"), F.min(key).alias("least")).first()
    tasks = min(MOST_RANGES, max(1, -(-stats["n"] // rows_per_task), -(-(stats["size"] or 0) // bytes_per_task)))
    bounds = range_bounds(rows.select("doc_id", "h"), stats["n"], tasks) if tasks > 1 else np.zeros(0, dtype=_KEY)
    least = np.array(tuple(stats["least"]) if stats["least"] else (0, 0, 0), dtype=_KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row: tuple[int | None, str, State] | None = None
        over = False
        for batch in batches:
            if over:
                continue
            out: list[tuple] = []
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                for doc_id, text, ahead in zip(*(part.column(i).to_pylist() for i in (0, 2, 4)), strict=True):
                    state = State.of(text.encode())
                    if open_row:
                        an_id, before, its = open_row
                        new, kept = edited(before, text)
                        new_state = edited_state(before, its, new, kept)
                        out.append((an_id, len(before), hashlib.sha256(new.encode()).hexdigest(), its.hex(), new_state.hex(), its.likeness(new_state), its.likeness(state)))
                    open_row = None if ahead else (doc_id, text, state)
                    over = ahead
                    if over:
                        break
                if over:
                    break
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)

    return dealt_ranges(rows, bounds, least).mapInArrow(run, _SQL)
