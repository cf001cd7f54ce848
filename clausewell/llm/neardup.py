"""Near-duplicate removal for a corpus: five-word shingles, similarity 0.8 or more.

The candidates come from the SimHash grid join of ``simhash``: 128-bit fingerprints
of the distinct shingles, embedded by segment bit counts, meeting in grids and held
to a Hamming radius well beyond what a similarity of 0.8 gives.  At such a radius no
grid can be both exhaustive and selective, so the number of grids is set, at every
size of the corpus, for a chance of 98 % that a pair just at the threshold shares a
cell, averaged over the spread of distances (pairs more alike: more surely).  Every candidate group is then verified by exact Jaccard
similarity of the shingle sets, and groups are the components of verified links.

Texts with equal shingle sets are one point from the start, so copies by the
thousand cost a row each in one aggregation.  Groups of over ``group_rows`` distinct
texts are dealt to several tasks.  What a part leaves unlinked to the largest tree of
its group then meets all other texts of the group, not representatives only, so that
every pair of a group is either tested or joined already.

Edge cases: null and empty texts have no shingles and count as copies of each other;
texts under five words are one shingle; ``drop_near_duplicates`` decides on rows, so
rows without an id or with a repeated one are copies like any other (of a group, the
row of the least id stays, one without an id only if no other is there); an empty
table stays empty.  ``duplicate_groups`` leaves out rows without an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize, release_memory, small_batches
from .graph import connected_components
from .simhash import BITS, SEGMENT, grid_links, majority
from .textbits import Words, mix, slices

SHINGLE = 5
THRESHOLD = 0.8
#: Of 128 bits: a similarity of 0.8 differs in 19 on average, spread 4.
RADIUS = 32
#: Chance that a segment counts the same in two texts at the threshold.
EQUAL = 0.734
#: Grids aim at cells of about 2 ** CELL_BITS unlike points: larger cells take fewer grids,
#: so less to shuffle, and more comparisons within a cell.
CELL_BITS = 9
#: Shingles that a task verifies at once.
GROUP_SHINGLES = 4_000_000
#: Chance that such a pair meets in a grid.
RECALL = 0.98


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, rows ascending."""
    words = Words(raw, offsets)
    (h,) = words.hashes()
    size = np.diff(words.row_at)
    out_row, out = [], []
    if len(h) >= k:
        s = h[: len(h) - k + 1]
        for j in range(1, k):
            s = s * np.uint64(0x9FB21C651E98DF25) + h[j : len(h) - k + 1 + j]
        row = np.searchsorted(words.row_at, np.arange(len(s)), side="right") - 1
        fine = np.arange(len(s)) + k <= words.row_at[row + 1]
        out_row.append(row[fine])
        out.append(mix(s[fine]))
    for r in np.flatnonzero((size > 0) & (size < k)).tolist():
        s = np.array([size[r]], dtype=np.uint64)
        for i in range(words.row_at[r], words.row_at[r + 1]):
            s = s * np.uint64(0x9FB21C651E98DF25) + h[i : i + 1]
        out_row.append(np.array([r]))
        out.append(mix(s))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row, h = np.concatenate(out_row).astype(np.int64), np.concatenate(out)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, hi, lo, content, size): fingerprint words, a hash of the shingle set, and
    how many shingles it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            out = np.zeros((4, len(batch)), dtype=np.uint64)
            for first, raw, offsets in slices(batch.column(1)):
                rows = len(offsets) - 1
                row, h = shingle_sets(raw, offsets)
                count = np.bincount(row, minlength=rows)
                at = slice(first, first + rows)
                out[0, at] = majority(h.astype(">u8").tobytes(), row, count)
                out[1, at] = majority(mix(h + np.uint64(0x9E3779B97F4A7C15)).astype(">u8").tobytes(), row, count)
                total = np.zeros(len(h) + 1, dtype=np.uint64)
                np.cumsum(mix(h ^ np.uint64(0xD6E8FEB86659FD93)), out=total[1:])
                ends = np.concatenate([[0], np.cumsum(count)])
                out[2, at] = total[ends[1:]] - total[ends[:-1]]
                out[3, at] = count
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x.view(np.int64)) for x in out)], names=["doc_id", "hi", "lo", "content", "size"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, hi bigint, lo bigint, content bigint, size bigint")


def grids_for(n: int) -> list[list[int]]:
    """Masks of the grids for about ``n`` points: the more points, the more segments
    a cell fixes and the more grids it takes to meet.  The equal segments of a pair
    are binomial; unlike pairs weigh most, so a mean distance would promise too much."""
    segments = 2 * BITS // SEGMENT
    fixed = int(np.clip(np.ceil((np.log2(max(n, 2)) - CELL_BITS) / 1.5), 4, 20))
    chance = np.array([comb(segments, k) * EQUAL**k * (1 - EQUAL) ** (segments - k) for k in range(segments + 1)])
    miss = 1 - np.array([comb(k, fixed) / comb(segments, fixed) for k in range(segments + 1)])
    few, many = 0, 1
    while 1 - chance @ miss**many < RECALL:
        few, many = many, 2 * many
    while many - few > 1:
        half = (few + many) // 2
        few, many = (half, many) if 1 - chance @ miss**half < RECALL else (few, half)
    random = np.random.default_rng(20260101)
    out = []
    for _ in range(many):
        mask = sum(0b11 << (SEGMENT * int(s)) for s in random.choice(segments, fixed, replace=False))
        out.append([mask >> BITS, mask & ((1 << BITS) - 1)])
    return out


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct hashes."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < THRESHOLD * max(len(a), len(b)):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return both / (len(a) + len(b) - both)


def group_links(nodes: list[int], sets: list[np.ndarray], threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Spanning forest of the verified links of a group."""
    links, todo = [], list(range(len(nodes)))
    while todo:
        root, *todo = todo
        queue = [root]
        while queue and todo:
            x = queue.pop()
            rest = []
            for y in todo:
                if jaccard(sets[x], sets[y]) >= threshold:
                    links.append((nodes[y], nodes[x]))
                    queue.append(y)
                else:
                    rest.append(y)
            todo = rest
    return links


def cross_links(left: list[int], nodes: list[int], trees: list[int], sets: list[np.ndarray], threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Verified links that join trees, of the texts at ``left`` with all texts."""
    size = np.array([len(x) for x in sets])
    hashes, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(hashes, kind="stable")
    hashes, row = hashes[order], row[order]
    label = np.array(trees)
    links = []
    for x in left:
        first, last = np.searchsorted(hashes, sets[x]), np.searchsorted(hashes, sets[x], side="right")
        holders = [row[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True) if b - a > 1]
        if not holders:
            continue
        both = np.bincount(np.concatenate(holders), minlength=len(sets))
        for y in np.flatnonzero((both >= threshold * (size[x] + size - both)) & (label != label[x])).tolist():
            if label[y] != label[x] and jaccard(sets[x], sets[y]) >= threshold:
                links.append((nodes[y], nodes[x]))
                label[label == label[y]] = label[x]
    return links


def _sets(texts: pa.Array) -> list[np.ndarray]:
    sets: list[np.ndarray] = []
    for _, raw, offsets in slices(texts):
        row, h = shingle_sets(raw, offsets)
        sets += np.split(h, np.searchsorted(row, np.arange(1, len(offsets) - 1)))
    return sets


def _verified(rows: DataFrame, threshold: float) -> DataFrame:
    """rows (grp, x, y, side, node, tree, text) -> (src, dst): the links within each
    (grp, x, y), or if sides are given, those from side x to side y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        key, kept = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            sides, nodes, trees, sets = zip(*kept, strict=True)
            if sides[0] is None:
                links = group_links(list(nodes), list(sets), threshold)
            else:
                left = [i for i, side in enumerate(sides) if side == key[1]]
                links = cross_links(left, list(nodes), list(trees), list(sets), threshold)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], names=["src", "dst"])

        for batch in batches:
            *columns, texts = batch.columns  # texts become sets as they come
            for grp, x, y, *rest in zip(*(c.to_pylist() for c in columns), _sets(texts), strict=True):
                if (grp, x, y) != key:
                    if kept:
                        yield from flush()
                    key, kept = (grp, x, y), []
                kept.append(rest)
        if kept:
            yield from flush()

    dealt = rows.select("grp", "x", "y", "side", "node", "tree", "text").repartition("grp", "x", "y").sortWithinPartitions("grp", "x", "y", "node")
    return dealt.mapInArrow(run, "src bigint, dst bigint")


def meetings(divided: DataFrame, links: DataFrame, part_rows: int) -> DataFrame:
    """divided (node, grp, weight), links within parts -> (node, grp, tree, x, y, side): the
    tasks in which every text outside the largest tree of its group meets all texts of
    the group.  Parts of the rest are numbered first, then those of the largest tree."""
    trees = connected_components(links, "neardup-trees")
    of = materialize(divided.join(trees, "node", "left").select("node", "grp", "weight", F.coalesce("component", "node").alias("tree")), "neardup-trees")
    sizes = of.groupBy("grp", "tree").agg(F.sum("weight").alias("n"))
    groups = sizes.groupBy("grp").agg(F.max(F.struct("n", "tree")).alias("main"), F.sum("n").alias("n")).where("n > main.n")
    count = lambda n: F.ceil(n / part_rows).cast("int")
    groups = groups.select("grp", F.col("main.tree").alias("main"), count(F.col("n") - F.col("main.n")).alias("rest"), count(F.col("main.n")).alias("more"))
    inside = F.col("tree") == F.col("main")
    deal = lambda n: F.pmod(F.xxhash64("node", F.lit(1)), n).cast("int")
    side = F.when(inside, F.col("rest") + deal(F.col("more"))).otherwise(deal(F.col("rest")))
    rows = of.join(groups, "grp").withColumn("side", side)
    other = F.explode(F.sequence(F.lit(0), F.when(inside, F.col("rest") - 1).otherwise(F.col("rest") + F.col("more") - 1)))
    rows = rows.withColumn("other", other)
    return rows.select("node", "grp", "tree", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "side")


def duplicate_groups(docs: DataFrame, threshold: float = THRESHOLD, group_rows: int = 4000) -> DataFrame:
    """(doc_id, group_id) of every row that has an id: the least id of its group."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id is not null")
    marked = materialize(sketches(rows), "neardup-sketches")
    points = materialize(marked.groupBy("hi", "lo", "content").agg(F.min("doc_id").alias("node"), F.max("size").alias("size")), "neardup-points")
    close = grid_links(points.select("node", "hi", "lo"), ["hi", "lo"], grids_for(points.count()), RADIUS)
    roots = connected_components(close, "neardup-candidates")
    # A long text counts for as many rows as it has shares of shingles.
    weight = 1 + F.floor(F.col("size") / (GROUP_SHINGLES / group_rows))
    weighed = materialize(roots.join(points.select("node", weight.alias("weight")), "node"), "neardup-weighed")
    sizes = weighed.groupBy("component").agg(F.sum("weight").alias("n"))
    parts = F.ceil(F.col("n") / group_rows)
    part = F.when(parts > 1, F.pmod(F.xxhash64("node"), parts)).otherwise(F.lit(-1))  # -1: the group is whole
    asked = materialize(weighed.join(sizes, "component").select("node", "weight", F.col("component").alias("grp"), part.cast("int").alias("x")), "neardup-asked")
    discard(close)
    discard(roots)
    discard(weighed)
    texts = rows.join(asked, F.col("doc_id") == F.col("node")).dropDuplicates(["node"])
    none = F.lit(None)
    links = materialize(_verified(texts.select("*", F.col("x").alias("y"), none.cast("int").alias("side"), none.cast("bigint").alias("tree")), threshold), "neardup-verified")
    divided = asked.where("x >= 0").select("node", "grp", "weight")
    if not divided.isEmpty():
        due = materialize(meetings(divided, links, max(1, group_rows // 2)), "neardup-meetings")
        held = rows.join(due.select("node").distinct(), F.col("doc_id") == F.col("node"), "left_semi").dropDuplicates(["doc_id"])
        links = links.union(materialize(_verified(due.join(held, F.col("doc_id") == F.col("node")), threshold), "neardup-crossed"))
        discard(due)
    groups = connected_components(links, "neardup-groups")
    of = points.join(groups, "node", "left").select("hi", "lo", "content", F.coalesce("component", "node").alias("group_id"))
    out = materialize(marked.join(of, ["hi", "lo", "content"]).select("doc_id", "group_id"), "neardup-grouped")
    for used in (marked, points, asked, links, groups):
        discard(used)
    return out


def with_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__cw_row``, a number of each row: of a table's file and the row in
    it, which every reading finds again; other rows are written out to be numbered."""
    spark = docs.sparkSession
    try:
        paths = sorted(r[0] for r in docs.select("_metadata.file_path").distinct().collect())  # a row for each file
    except AnalysisException:
        return materialize(docs.withColumn("__cw_row", F.monotonically_increasing_id()), "neardup-rows")
    files = spark.createDataFrame(list(zip(paths, range(len(paths)), strict=True)), "__cw_path string, __cw_file bigint")
    placed = docs.select("*", F.col("_metadata.file_path").alias("__cw_path"), F.col("_metadata.row_index").alias("__cw_index"))
    return placed.join(files, "__cw_path").select(*docs.columns, (F.shiftleft("__cw_file", 40) + F.col("__cw_index")).alias("__cw_row"))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group, that of the least id."""
    small_batches(docs.sparkSession)
    rows = with_rows(docs)
    groups = duplicate_groups(rows.select(F.col("__cw_row").alias("doc_id"), "text"), threshold)
    ids = rows.select("__cw_row", F.col("doc_id").cast("bigint").alias("id"))
    grouped = materialize(groups.withColumnRenamed("doc_id", "__cw_row").join(ids, "__cw_row"), "neardup-rows-grouped")
    first = grouped.groupBy("group_id").agg(F.count("*").alias("n"), F.min(F.struct(F.col("id").isNull(), "id", "__cw_row")).alias("first")).where("n > 1")
    gone = grouped.join(first, "group_id").where(F.col("__cw_row") != F.col("first.__cw_row")).select(F.col("__cw_row").alias("__cw_gone"))
    gone = materialize(gone, "neardup-gone")
    discard(groups)
    discard(grouped)
    return rows.join(gone, F.col("__cw_row") == F.col("__cw_gone"), "left_anti").select(*docs.columns)
