"""SimHash near-duplicate groups through a segment-popcount embedding.

1. Every text gets a 64-bit SimHash of its word shingles (repeats included).
2. Fingerprints are embedded: 32 segments of two bits, each mapped to its bit
   count.  The Manhattan distance of two embeddings never exceeds the Hamming
   distance of the fingerprints.  Counts are kept in unary (0 -> 00, 1 -> 01,
   2 -> 11), so the Manhattan distance is one XOR and one popcount.
3. Grid range-join: the 32 coordinates fall into ``radius + tables`` groups.
   Within Manhattan distance ``radius`` at most ``radius`` groups can differ,
   so at least ``tables`` groups are equal; every choice of ``tables`` groups
   is one grid, its equal counts a cell.  Pairs that meet in no cell are
   farther apart than the radius, for certain.
4. Pairs of a cell within the Manhattan radius are verified by exact Hamming
   distance.  A cell gives out one link a row, to the least row of its component,
   never all pairs: a large group of near copies costs rows in proportion to its
   size.
5. Links are closed into components by distributed star contraction.

Edge cases: null and empty texts have fingerprint zero and link like any other;
repeated rows are kept, each gets its own output row; rows without an id get the
smallest id of their component like any other, or null if it has none; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize, release_memory
from .graph import connected_components
from .textbits import Words, mix, slices, spread

BITS = 64
SEGMENT = 2
#: Cells of up to this many fingerprints are compared pair by pair, in numpy.
SMALL_CELL = 96
#: Larger cells than this are dealt over several tasks.
CELL_ROWS = 8192


def fingerprints_of(column: pa.Array, shingle: int, seed: int) -> np.ndarray:
    """64-bit SimHash (as big-endian bytes in uint64) of every text of a column."""
    out = np.zeros(len(column), dtype=np.uint64)
    for first, raw, offsets in slices(column):
        words = Words(raw, offsets)
        text, starts, ends = words.joined()
        rows = len(offsets) - 1
        size = np.diff(words.row_at)
        # A row of w words has w - shingle + 1 shingles; a shorter one has one.
        count = np.where(size >= shingle, size - shingle + 1, np.minimum(size, 1))
        at = np.zeros(rows + 1, dtype=np.int64)
        np.cumsum(count, out=at[1:])
        row = np.repeat(np.arange(rows), count)
        begin = words.row_at[:-1][row] + np.arange(at[-1]) - at[:-1][row]
        end = np.minimum(begin + shingle, words.row_at[1:][row]) - 1
        digest = xxhash.xxh64_digest
        hashed = b"".join([digest(text[s:e], seed) for s, e in zip(starts[begin].tolist(), ends[end].tolist(), strict=True)])
        out[first : first + rows] = majority(hashed, row, count)
    return out


#: BIT_OF[value, j] is bit j (from the highest) of a byte.
BIT_OF = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def majority(hashed: bytes, row: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Per row, the bits that are set in over half of its 64-bit hashes."""
    rows = len(count)
    values = np.frombuffer(hashed, np.uint8).reshape(-1, 8)
    bits = np.empty((rows, 8, 8), dtype=bool)
    step = 4096  # rows of a histogram at once
    for low in range(0, rows, step):
        high = min(rows, low + step)
        first, last = np.searchsorted(row, [low, high])
        own = row[first:last] - low
        for j in range(8):
            seen = np.bincount(own * 256 + values[first:last, j], minlength=(high - low) * 256)
            ones = seen.reshape(-1, 256) @ BIT_OF
            bits[low:high, j] = 2 * ones > count[low:high, None]
    return np.packbits(bits.reshape(rows, 64), axis=1).view(">u8").ravel().astype(np.uint64)


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp bigint): the fingerprint of every row's whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprints_of(batch.column(1), shingle, seed)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, fp bigint")


def unary_counts(fp: Column) -> Column:
    """Bit counts of the two-bit segments in unary, packed into 64 bits."""
    odd = F.lit(0x5555555555555555)
    high = fp.bitwiseAND(F.shiftrightunsigned(fp, 1)).bitwiseAND(odd)
    low = fp.bitwiseOR(F.shiftrightunsigned(fp, 1)).bitwiseAND(odd)
    return F.shiftleft(high, 1).bitwiseOR(low)


def unary_counts_np(fp: np.ndarray) -> np.ndarray:
    odd, one = np.uint64(0x5555555555555555), np.uint64(1)
    return (((fp & (fp >> one)) & odd) << one) | ((fp | (fp >> one)) & odd)


def grid_masks(radius: int, tables: int) -> list[int]:
    """Masks of the unary code, one for each choice of ``tables`` out of
    ``radius + tables`` groups of segments."""
    segments = BITS // SEGMENT
    groups = radius + tables
    owner = [s * groups // segments for s in range(segments)]
    part = [sum(0b11 << (SEGMENT * s) for s in range(segments) if owner[s] == g) for g in range(groups)]
    return [sum(part[g] for g in chosen) for chosen in combinations(range(groups), tables)]


def tables_for(n: int, radius: int) -> int:
    """Equal groups to ask for, so that a cell holds a few of ``n`` random
    fingerprints: two-bit segments carry 1.5 bits each.  Any choice is exact."""
    tables = 1
    while tables < 6 and n > 8 * 2 ** (1.5 * BITS / SEGMENT * tables / (radius + tables)):
        tables += 1
    return tables


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class Forest:
    """Union-find over the few thousand fingerprints of one batch."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (above := up.get(root, root)) != root:
            root = above
        while (above := up.get(x, x)) != root:
            up[x] = root
            x = above
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def near(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Manhattan distance of the embeddings as a lower bound, then Hamming; a and b
    hold a fingerprint of one or more 64-bit words in each row."""
    bound = np.bitwise_count(unary_counts_np(a) ^ unary_counts_np(b)).sum(axis=-1, dtype=np.int64)
    return (bound <= radius) & (np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64) <= radius)


def cell_links(key: np.ndarray, fp: np.ndarray, node: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """The linked components of each run of equal keys (keys sorted), every row as a
    link to its component's least row: grids that find the same group give the same
    links."""
    change = np.flatnonzero(np.diff(key)) + 1
    first = np.concatenate([[0], change])
    size = np.diff(np.concatenate([first, [len(key)]]))
    left, right = [], []
    in_small = np.repeat(size <= SMALL_CELL, size)
    rest = np.repeat(first + size, size) - np.arange(len(key)) - 1  # rows of the cell after this one
    at = np.flatnonzero(in_small & (rest > 0))
    for shift in range(1, SMALL_CELL):
        at = at[rest[at] >= shift]
        if not len(at):
            break
        hit = at[near(fp[at], fp[at + shift], radius)]
        left.append(node[hit])
        right.append(node[hit + shift])
    for begin, n in zip(first[size > SMALL_CELL].tolist(), size[size > SMALL_CELL].tolist(), strict=True):
        # Breadth first: each reached row is compared with the unreached rest only,
        # so a ball of near copies costs its size times what is left outside it.
        fps, nodes = fp[begin : begin + n], node[begin : begin + n]
        todo = np.arange(n)
        while len(todo):
            queue, todo = [int(todo[0])], todo[1:]
            while queue and len(todo):
                x = queue.pop()
                hit = near(fps[todo], fps[x], radius)
                if hit.any():
                    reached = todo[hit]
                    todo = todo[~hit]
                    left.append(np.full(len(reached), nodes[x]))
                    right.append(nodes[reached])
                    queue += reached.tolist()
    forest = Forest()
    if left:
        for a, b in zip(np.concatenate(left).tolist(), np.concatenate(right).tolist(), strict=True):
            forest.join(a, b)
    out = [(x, root) for x in list(forest.up) if (root := forest.find(x)) != x]
    return [x for x, _ in out], [root for _, root in out]


def hamming_links(points: DataFrame, radius: int, n: int) -> DataFrame:
    """(src, dst) links that connect every two fingerprints within ``radius``.

    ``points`` holds distinct fingerprints: fp bigint, node bigint.
    """
    return grid_links(points, ["fp"], [[m] for m in grid_masks(radius, tables_for(n, radius))], radius)


def cells_of(points: DataFrame, fp_cols: list[str], grids: list[list[int]]) -> DataFrame:
    """(node, cell, *fp_cols): a row for each point and grid."""
    codes = [unary_counts(F.col(c)) for c in fp_cols]
    keys = F.array(*[F.xxhash64(F.lit(i), *[c.bitwiseAND(F.lit(signed(m))) for c, m in zip(codes, g, strict=True) if m]) for i, g in enumerate(grids)])
    return points.select("node", F.explode(keys).alias("cell"), *fp_cols)


def links_within(cells: DataFrame, by: list[str], fp_cols: list[str], radius: int, most: int | None) -> DataFrame:
    """(src, dst, hot): links of the points that share the columns ``by``, which hold
    longs.  Of a cell of over ``most`` points only its first key is given, as hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        kept: list[list[np.ndarray]] = []  # rows of the cell that is still open

        def flush(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            key, fp, node, name = (np.concatenate(x) for x in zip(*parts, strict=True))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            large = np.diff(cuts) > (most or len(key))
            hot, small = name[cuts[:-1][large]], np.repeat(~large, np.diff(cuts))
            a, b = cell_links(key[small], fp[small], node[small], radius) if small.any() else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array([*a, *hot.tolist()], pa.int64()), pa.array([*b, *[None] * len(hot)], pa.int64()), pa.array([False] * len(a) + [True] * len(hot), pa.bool_())], names=["src", "dst", "hot"])

        for batch in batches:
            if not len(batch):
                continue
            node, *rest = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            fp, names = np.stack(rest[: len(fp_cols)], axis=1).view(np.uint64), rest[len(fp_cols) :]
            key = names[0].view(np.uint64)
            for more in names[1:]:
                key = mix(key) + mix(more.view(np.uint64) + np.uint64(1))
            open_from = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            if kept and (open_from or kept[-1][0][-1] != key[0]):
                yield from flush([*kept, [x[:open_from] for x in (key, fp, node, names[0])]])
                kept = []
            elif open_from:
                yield from flush([[x[:open_from] for x in (key, fp, node, names[0])]])
            # One row more than `most` is enough to know a cell as hot.
            till = open_from + most + 1 - sum(len(x[0]) for x in kept) if most else len(key)
            kept.append([x[open_from : max(open_from, till)] for x in (key, fp, node, names[0])])
        if kept:
            yield from flush(kept)

    dealt = cells.select("node", *fp_cols, *by).repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, "src bigint, dst bigint, hot boolean")


def grid_links(points: DataFrame, fp_cols: list[str], grids: list[list[int]], radius: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(src, dst) links of points that share a cell of some grid and are within
    ``radius`` of each other.  The components of a cell are given as stars, so their
    closure is exact while their number stays in proportion to the cells.

    A grid is a mask of the unary code for each of ``fp_cols``.  A cell of over
    ``cell_rows`` points is dealt over tasks: its points fall into blocks, and every
    two blocks meet in one task, so that no task holds more than ``cell_rows``.
    """
    cells = cells_of(points, fp_cols, grids)
    found = materialize(links_within(cells, ["cell"], fp_cols, radius, cell_rows), "grid-links")
    links = found.where("not hot").select("src", "dst")
    hot = found.where("hot").select(F.col("src").alias("cell"))
    if not hot.isEmpty():
        rows = materialize(cells.join(hot, "cell", "left_semi"), "grid-hot")
        blocks = rows.groupBy("cell").agg(F.ceil(2 * F.count("*") / cell_rows).cast("bigint").alias("blocks"))
        own = F.pmod(F.xxhash64("node"), F.col("blocks"))
        other = F.explode(F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda x: x != F.col("own")))
        met = rows.join(blocks, "cell").withColumn("own", own).withColumn("other", other)
        met = met.select("node", *fp_cols, "cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
        links = links.union(links_within(met, ["cell", "x", "y"], fp_cols, radius, None).select("src", "dst"))
    return links.distinct()


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id) for every row: the component is the smallest id
    reachable over links of at most ``radius`` differing bits.  Fingerprints are what is
    linked, so one that only rows without an id have links the others all the same."""
    marked = materialize(simhash(docs, id_col, text_col, shingle, seed), "simhash")
    points = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-points")
    links = hamming_links(points.select("fp", F.col("fp").alias("node")), radius, points.count())
    roots = connected_components(links)
    placed = points.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", "component")
    lows = placed.where("component is not null").groupBy("component").agg(F.min("low").alias("least"))
    of = placed.join(lows, "component", "left").select("fp", F.when(F.col("component").isNull(), F.col("low")).otherwise(F.col("least")).alias("component_id"))
    return marked.join(materialize(of, "simhash-components"), "fp").select("doc_id", "fp", "component_id")
