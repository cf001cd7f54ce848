"""Benchmark decontamination: item-sized SimHash windows, multi-index Hamming
blocks, exact verification.

For every benchmark item of L words, the windows of L words of every document are
compared with it in three steps:

* Windows that share no shingle with any item of their size are left out: their
  similarity to all of them is zero.
* All others get a 64-bit SimHash.  Fingerprints of the items of that size are
  indexed by blocks of bits: of ``blocks`` blocks at least one differs in at most
  ``radius // blocks`` bits, so looking up every block value with up to so many
  bits flipped finds all items within the radius, without exception.
* Those are verified by exact weighted similarity of the shingles as words: the
  sum of the smaller multiplicities over the sum of the larger ones.

Bits of few shingles say little, so a short item (of under ``SURE`` shingles) is also
compared with every window that holds enough of its size's shingles to reach the
threshold; such items are found without exception.  A longer item at the threshold is
beyond the radius with a chance of about one in two thousand, above it less.  Words
are runs of ASCII letters and digits and of any other non-ASCII characters, A-Z in
lower case; items shorter than the shingle are one shingle.

The benchmark is taken in blocks of ``items_per_pass`` items (bounded, so each
block can be broadcast), each compared with all documents in a map-only pass.

Edge cases: null and empty texts, and items without words, match nothing; repeated
documents or items give a row for each; empty tables give no rows.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialize, release_memory
from .textbits import NON_WORD, Words, mix, slices

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 20
BLOCKS = 7
#: Items of fewer shingles than this don't rely on their fingerprints.
SURE = 32
#: Windows whose bits are counted at once.
WINDOWS_AT_ONCE = 1 << 14
_SCHEMA = "item_id {item}, doc_id {doc}, similarity double, start_word bigint, n_words bigint, hamming int"


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive word hashes."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9FB21C651E98DF25) + h[j : j + n]
    return mix(out)


def fingerprint(bits: np.ndarray, n: int) -> np.ndarray:
    """uint64 fingerprints from counts of set bits over n shingles each."""
    return np.packbits(2 * bits > n, axis=-1).view(">u8").ravel().astype(np.uint64)


def bit_rows(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


class HammingIndex:
    """All fingerprints within a radius, by blocks of bits."""

    def __init__(self, fps: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.fps, self.radius = fps, radius
        cuts = [64 * b // blocks for b in range(blocks + 1)]
        self.tables = []
        for low, high in zip(cuts, cuts[1:], strict=False):
            width = high - low
            flips = [sum(1 << i for i in c) for n in range(min(width, radius // blocks) + 1) for c in combinations(range(width), n)]
            value = self._block(fps, low, width)
            order = np.argsort(value, kind="stable")
            self.tables.append((low, width, np.array(flips, dtype=np.uint64), value[order], order))

    @staticmethod
    def _block(fps: np.ndarray, low: int, width: int) -> np.ndarray:
        return (fps >> np.uint64(low)) & np.uint64((1 << width) - 1)

    def within(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, position, distance): for each of ``fps`` all indexed fingerprints
        within the radius, ascending."""
        found = []
        for low, width, flips, values, order in self.tables:
            probes = (self._block(fps, low, width)[:, None] ^ flips).ravel()
            first, last = np.searchsorted(values, probes, "left"), np.searchsorted(values, probes, "right")
            some = np.flatnonzero(last > first)
            n = (last - first)[some]
            at = np.repeat(first[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
            found.append(np.repeat(some // len(flips), n) * np.int64(len(self.fps)) + order[at])
        pair = np.unique(np.concatenate(found))
        number, position = pair // len(self.fps), pair % len(self.fps)
        distance = np.bitwise_count(self.fps[position] ^ fps[number]).astype(np.int64)
        near = distance <= self.radius
        return number[near], position[near], distance[near]


class ItemsOfShingle:
    """For each shingle the items, by their places in a list, that hold it."""

    def __init__(self, shingles: list[np.ndarray]):
        item = np.repeat(np.arange(len(shingles)), [len(x) for x in shingles])
        pair = np.unique(np.rec.fromarrays([np.concatenate(shingles), item]))
        self.keys, first = np.unique(pair.f0, return_index=True)
        self.first, self.item = np.append(first, len(pair)), np.ascontiguousarray(pair.f1)

    def places(self, s: np.ndarray, hits: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(item, ascending places among ``hits`` whose shingle the item holds)."""
        at = np.minimum(np.searchsorted(self.keys, s[hits]), len(self.keys) - 1)
        same = self.keys[at] == s[hits]
        place, at = hits[same], at[same]
        n = self.first[at + 1] - self.first[at]
        item = self.item[np.repeat(self.first[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        place = np.repeat(place, n)[np.argsort(item, kind="stable")]
        known, first = np.unique(np.sort(item), return_index=True)
        yield from zip(known.tolist(), np.split(place, first[1:]), strict=True)


class Items:
    """A bounded block of benchmark items, ready to be compared."""

    def __init__(self, ids: list, texts: list[str | None], threshold: float):
        self.ids, self.threshold = ids, threshold
        self.words: list[list[bytes]] = [[] for _ in ids]
        hashes: list[np.ndarray] = [np.zeros(0, np.uint64) for _ in ids]
        for first, raw, offsets in slices(pa.array(texts, pa.string())):
            words = Words(raw, offsets, NON_WORD)
            (h,) = words.hashes()
            for i in range(len(offsets) - 1):
                at = slice(*words.row_at[i : i + 2].tolist())
                hashes[first + i] = h[at]
                self.words[first + i] = [words.bytes[s:e].tobytes() for s, e in zip(words.starts[at], words.ends[at], strict=True)]
        #: By shingle length (5, or an item's own size if it is shorter): the sorted
        #: shingle hashes, the item sizes that each belongs to, and items by size.
        self.by_k: dict[int, dict] = {}
        for i, h in enumerate(hashes):
            if not len(h):
                continue
            k = min(SHINGLE, len(h))
            own = self.by_k.setdefault(k, {"sizes_of": defaultdict(set), "by_size": defaultdict(list)})
            s = shingle_hashes(h, k)
            for x in s.tolist():
                own["sizes_of"][x].add(len(h))
            own["by_size"][len(h)].append((i, fingerprint(bit_rows(s).sum(axis=0)[None], len(s))[0], s))
        for own in self.by_k.values():
            own["known"] = np.array(sorted(own["sizes_of"]), dtype=np.uint64)
            own["maybe"] = np.zeros(1 << 22, dtype=bool)
            own["maybe"][own["known"] & np.uint64((1 << 22) - 1)] = True
            own["sizes"] = [frozenset(own["sizes_of"][x]) for x in own["known"].tolist()]
            own["by_size"] = {n: ([i for i, _, _ in rows], HammingIndex(np.array([f for _, f, _ in rows], dtype=np.uint64)), ItemsOfShingle([x for _, _, x in rows])) for n, rows in own["by_size"].items()}
            del own["sizes_of"]

    def shared(self, n: int, m: int) -> int:
        """Shingles that a window of n must share with an item of m to pass."""
        return max(1, int(np.ceil((n + m) * self.threshold / (1 + self.threshold) - 1e-9)))

    def matches(self, raw: np.ndarray, offsets: np.ndarray, any_item: bool = False) -> Iterator[tuple[int, int, float, int, int, int]]:
        """(row, item, similarity, start, size, distance): the best window of each item, or of
        each row the first that passes for any item."""
        words = Words(raw, offsets, NON_WORD)
        if not len(words.starts):
            return
        (h,) = words.hashes()
        low, done = np.uint64((1 << 22) - 1), set()
        for k, own in self.by_k.items():
            s = shingle_hashes(h, k)
            at = np.flatnonzero(own["maybe"][s & low])
            where = np.minimum(np.searchsorted(own["known"], s[at]), len(own["known"]) - 1)
            hit = own["known"][where] == s[at]
            at, where = at[hit], where[hit]
            row = np.searchsorted(words.row_at, at, side="right") - 1
            inside = at + k <= words.row_at[row + 1]
            at, where, row = at[inside], where[inside], row[inside]
            for r in np.unique(row).tolist():
                if r in done:
                    continue
                mine = slice(*np.searchsorted(row, [r, r + 1]).tolist())
                first, last = words.row_at[r : r + 2].tolist()
                sizes = set().union(*(own["sizes"][w] for w in set(where[mine].tolist())))
                for found in self._row(r, k, own, sizes, at[mine] - first, s[first : last - k + 1], words, first, last, any_item):
                    yield found
                    if any_item:
                        done.add(r)

    def _row(self, r: int, k: int, own: dict, sizes: set[int], hits: np.ndarray, s: np.ndarray, words: Words, first: int, last: int, any_item: bool) -> Iterator[tuple]:
        total = last - first
        best: dict[int, tuple] = {}
        for size in sorted(sizes):
            window = min(size, total)
            n, m = window - k + 1, size - k + 1
            starts = np.unique(np.clip(np.concatenate([hits - d for d in range(n)]) if n < 4 * len(hits) else (hits[:, None] - np.arange(n)).ravel(), 0, total - window))
            ids, index, holders = own["by_size"][size]
            # What an item can share with a window is at most the window's shingles it holds.
            need = self.shared(n, m)
            held = {p: q for p, q in holders.places(s, hits) if len(q) >= need} if m < SURE else {}
            for low in range(0, len(starts), WINDOWS_AT_ONCE):
                part = starts[low : low + WINDOWS_AT_ONCE]
                number, position, distance = index.within(_window_prints(s, part, n))
                pairs = list(zip(number.tolist(), position.tolist(), distance.tolist(), strict=True))
                most: dict[int, np.ndarray] = {p: np.searchsorted(q, part + n) - np.searchsorted(q, part) for p, q in held.items()}
                if m < SURE:
                    pairs = [x for x in pairs if x[1] in most and most[x[1]][x[0]] >= need]
                    known = {(w, p) for w, p, _ in pairs}
                    pairs += [(w, p, -1) for p, c in most.items() for w in np.flatnonzero(c >= need).tolist() if (w, p) not in known]
                for w, p, d in sorted(pairs, key=lambda x: (x[1], x[2] < 0, x[2])):
                    i, start = ids[p], int(part[w])
                    if i in best and (best[i][0] == 1.0 or p in most and (c := int(most[p][w])) / (n + m - c) <= best[i][0]):
                        continue
                    got = [words.bytes[a:b].tobytes() for a, b in zip(words.starts[first + start : first + start + window], words.ends[first + start : first + start + window], strict=True)]
                    x = weighted_similarity(got, self.words[i], k)
                    if x >= self.threshold and x > best.get(i, (0,))[0]:
                        best[i] = (x, start, window, d if d >= 0 else int(np.bitwise_count(index.fps[p] ^ _window_prints(s, part[w : w + 1], n)[0])))
                        if any_item:
                            yield r, i, *best[i]
                            return
        for i, (x, start, window, distance) in sorted(best.items()):
            yield r, i, x, start, window, distance


def _window_prints(s: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """SimHash of the n shingles from each of the ascending starts on."""
    out = np.empty(len(starts), dtype=np.uint64)
    for group in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(starts) > n) + 1):
        if len(group):
            low, high = int(starts[group[0]]), int(starts[group[-1]])
            bits = np.zeros((high - low + n + 1, 64), dtype=np.int32)
            np.cumsum(bit_rows(s[low : high + n]), axis=0, out=bits[1:])
            at = starts[group] - low
            out[group] = fingerprint(bits[at + n] - bits[at], n)
    return out


def weighted_similarity(a: list[bytes], b: list[bytes], k: int = SHINGLE) -> float:
    """Weighted Jaccard of the multisets of k-word shingles."""
    ca, cb = (Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) for w in (a, b))
    most = sum((ca | cb).values())
    return sum((ca & cb).values()) / most if most else 0.0


_LAST: dict[str, Items] = {}


def _items(block: str, ids: list, texts: list[str | None], threshold: float) -> Items:
    """The block of items, made ready once a worker; only the last one is kept."""
    if block not in _LAST:
        _LAST.clear()
        _LAST[block] = Items(ids, texts, threshold)
    return _LAST[block]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD, items_per_pass: int = 20_000) -> DataFrame:
    """A row for each document and benchmark item that it holds a copy of: doc_id,
    item_id, similarity, start_word, n_words and hamming of the best window."""
    spark = docs.sparkSession
    doc_type, item_type = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = _SCHEMA.format(item=item_type, doc=doc_type)
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    passes = max(1, -(-items.count() // items_per_pass))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def one_pass(p: int) -> DataFrame:
        block = items if passes == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p)
        got = block.orderBy("item_id", "text").collect()  # about items_per_pass rows
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, [r["item_id"] for r in got], [r["text"] for r in got]))
        item_arrow = pa.int64() if item_type == "bigint" else None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release_memory()
            known = _items(*shared.value, threshold)
            for batch in batches:
                found = [(known.ids[i], first + r, x, start, size, d) for first, raw, offsets in slices(batch.column(1)) for r, i, x, start, size, d in known.matches(raw, offsets)]
                if found:
                    item, at, x, start, size, d = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(item, item_arrow), batch.column(0).take(pa.array(at)), pa.array(x), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(d, pa.int32())], names=["item_id", "doc_id", "similarity", "start_word", "n_words", "hamming"])

        return rows.mapInArrow(run, schema)

    return reduce(DataFrame.union, [one_pass(p) for p in range(passes)]).select("doc_id", "item_id", "similarity", "start_word", "n_words", "hamming")


def without_copies(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text", threshold: float = THRESHOLD, items_per_pass: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that hold a copy of no benchmark item, judged where they are read.

    Items of one text are one item, and a row is left at the first item that it holds.  More
    than ``items_per_pass`` texts of items take a pass each over what the one before kept.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_text_col).alias("text")).where("text is not null").distinct()
    passes = max(1, -(-items.count() // items_per_pass))
    at = docs.columns.index(text_col)

    def kept(rows: DataFrame, p: int) -> DataFrame:
        block = items if passes == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == p)
        texts = [r["text"] for r in block.orderBy("text").collect()]  # about items_per_pass rows
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, list(range(len(texts))), texts))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release_memory()
            known = _items(*shared.value, threshold)
            for batch in batches:
                clean = np.ones(len(batch), dtype=bool)
                for first, raw, offsets in slices(batch.column(at)):
                    clean[[first + r for r, *_ in known.matches(raw, offsets, any_item=True)]] = False
                yield batch.filter(pa.array(clean))

        return rows.mapInArrow(run, docs.schema)

    out = kept(docs, 0)
    for p in range(1, passes):
        before = materialize(out, "decontaminated")
        out = kept(before, p)
    return out
