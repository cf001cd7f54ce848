"""Exact nearest neighbours by pivots and the triangle inequality.

Vectors are kept in cells, each with the pivot that is nearest to them and their distance
from it.  A query computes its distances to the pivots only; then

1. it reads the cells whose pivots are nearest, until they hold k vectors: the k-th best
   distance there is its *reach*;
2. it reads every other cell that may hold something within its reach: the distance to a
   pivot less the radius of its cell is at most the reach.  In a cell it computes the
   distance of those vectors only whose distance from the pivot differs from its own by no
   more than the reach.

Queries meet bins of neighbouring cells, blocks of vectors and blocks of queries, so that
neither a popular cell nor many queries come to one task; a query goes to a bin in one row
and brings back its k nearest of a block at most.  Pivots (at most ``MOST_PIVOTS``)
and the sizes of cells are all that reaches the driver.

Edge cases: rows without a vector are left out of either side; equal distances (to nine
digits) are ranked by id; fewer than k vectors give all of them.  All vectors have one
dimension.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame, Window, functions as F

from clausewell.sources.shared import materialize

MOST_PIVOTS = 512
#: Vectors of a block, and queries of one; a task holds a block of either.
BLOCK, QUERIES = 16384, 4096
#: Queries that are compared at a time.
STEP = 64
#: What rounding may take from a bound.
SLACK = 1e-6


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _distances(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - x) ** 2).sum(axis=1))


def best(distance: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least, ties by name."""
    if len(distance) > 4 * k:
        some = np.flatnonzero(np.round(distance, 9) <= np.round(np.partition(distance, k)[k], 9))
    else:
        some = np.arange(len(distance))
    return some[np.lexsort((names[some], np.round(distance[some], 9)))[:k]]


class PivotIndex:
    """Vectors (id, vec) in cells; built once, searched by any number of queries."""

    def __init__(self, vectors: DataFrame, id_col: str = "id", pivots: int | None = None):
        rows = vectors.where("vec is not null").select(F.col(id_col).alias("id"), F.col("vec").cast("array<double>").alias("vec"))
        self.id_col, self.kind = id_col, vectors.schema[id_col].dataType.simpleString()
        count = rows.count() if pivots is None else 0
        some = rows.orderBy(F.xxhash64("id"), "id").limit(pivots or int(np.clip(count**0.5, 1, MOST_PIVOTS))).collect()  # bounded by MOST_PIVOTS
        self.pivots = np.array([r["vec"] for r in some], dtype=np.float64)
        centres = self.pivots

        def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                v = _matrix(batch.column(1), len(batch))
                near = ((centres**2).sum(axis=1) - 2 * v @ centres.T).argmin(axis=1)
                away = np.sqrt(((v - centres[near]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32()), pa.array(away)], names=["id", "vec", "cell", "away"])

        self.rows = materialize(rows.mapInArrow(cell, f"id {self.kind}, vec array<double>, cell int, away double"), "pivot-cells")
        found = self.rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()  # a row for each pivot
        self.size, self.radius = np.zeros(len(some), np.int64), np.zeros(len(some))
        for r in found:
            self.size[r["cell"]], self.radius[r["cell"]] = r["n"], r["radius"]

    def search(self, queries: DataFrame, k: int, counter: Accumulator | None = None) -> DataFrame:
        """(qid, id, distance, rank) of queries (qid, vec); ``counter`` adds up how many
        distances to vectors are computed."""
        asked = materialize(queries.where("vec is not null").select(F.col("qid").cast("bigint").alias("qid"), F.col("vec").cast("array<double>").alias("vec")), "pivot-queries")
        first = materialize(self._read(self._cells(asked.withColumn("reach", F.lit(None).cast("double")), k), k, counter), "pivot-first")
        order = Window.partitionBy("qid").orderBy(F.round("distance", 9), "id")
        ranked = first.withColumn("no", F.row_number().over(order)).where(F.col("no") == k)
        reached = asked.join(ranked.select("qid", F.col("distance").alias("reach")), "qid", "left").select("qid", "vec", F.coalesce("reach", F.lit(float("inf"))).alias("reach"))
        rest = self._read(self._cells(reached, k), k, counter)
        out = first.union(rest).withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= k)
        return out.select("qid", F.col("id").alias(self.id_col), "distance", "rank")

    def _bins(self) -> tuple[np.ndarray, np.ndarray]:
        """Bins of neighbouring cells of about BLOCK vectors: (the bin of each cell, in how
        many blocks each bin is dealt)."""
        bins = np.maximum(np.cumsum(self.size) - 1, 0) // BLOCK
        bins = np.unique(bins, return_inverse=True)[1] if len(bins) else bins
        held = np.bincount(bins, weights=self.size) if len(bins) else np.zeros(0)
        return bins, np.maximum(1, -(-held.astype(np.int64) // BLOCK))

    def _cells(self, asked: DataFrame, k: int) -> DataFrame:
        """asked (qid, vec, reach) -> (qid, vec, reach, bin, cells, aways): a row for each bin
        with the first cells of a query without a reach, of one with it with the others that it
        may need."""
        pivots, size, radius, bins = self.pivots, self.size, self.radius, self._bins()[0]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, len(whole) if len(pivots) else 0, STEP):
                    batch = whole.slice(start, STEP)
                    row, of, cells, aways = [], [], [], []
                    for i, (x, reach) in enumerate(zip(_matrix(batch.column(1), len(batch)), batch.column(2).to_pylist(), strict=True)):
                        away = _distances(pivots, x)
                        near = np.argsort(away, kind="stable")
                        near = near[size[near] > 0]
                        till = int(np.searchsorted(np.cumsum(size[near]), k)) + 1
                        use = np.sort(near[:till] if reach is None else near[till:][away[near[till:]] - radius[near[till:]] <= reach + SLACK])
                        own, begin = np.unique(bins[use], return_index=True)
                        row += [i] * len(own)
                        of += own.tolist()
                        cells += np.split(use, begin[1:]) if len(use) else []
                        aways += np.split(away[use], begin[1:]) if len(use) else []
                    yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row, pa.int64())) for c in batch.columns), pa.array(of, pa.int32()), pa.array(cells, pa.list_(pa.int32())), pa.array(aways, pa.list_(pa.float64()))], names=["qid", "vec", "reach", "bin", "cells", "aways"])

        return asked.mapInArrow(run, "qid bigint, vec array<double>, reach double, bin int, cells array<int>, aways array<double>")

    def _read(self, cells: DataFrame, k: int, counter: Accumulator | None) -> DataFrame:
        """(qid, id, distance): of each block of a bin, the k nearest of every query, none
        beyond its reach.  Distances by products of matrices tell which are worth an exact one."""
        kind = self.kind
        cells = materialize(cells, "pivot-asked")
        bins, blocks = self._bins()
        asked_of = {r["bin"]: r["n"] for r in cells.groupBy("bin").agg(F.count("*").alias("n")).collect()}  # a row for each bin
        parts = [max(1, -(-asked_of.get(i, 0) // QUERIES)) for i in range(len(blocks))]

        def run(own: pa.Table, asked: pa.Table) -> pa.Table:
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            if own.num_rows and asked.num_rows:
                order = np.lexsort((own.column("away").to_numpy(), own.column("cell").to_numpy()))
                own = own.select(["id", "vec", "cell", "away"]).take(pa.array(order))
                v, names, cell, at = _matrix(own.column("vec"), own.num_rows), own.column("id").to_numpy(), own.column("cell").to_numpy(), own.column("away").to_numpy()
                begins = np.searchsorted(cell, np.arange(len(bins) + 1))
                squares = (v**2).sum(axis=1)
                for start in range(0, asked.num_rows, STEP):
                    some = asked.slice(start, STEP)
                    x, reaches = _matrix(some.column("vec"), some.num_rows), some.column("reach").to_numpy()
                    lists = zip(some.column("qid").to_pylist(), some.column("cells").to_pylist(), some.column("aways").to_pylist(), strict=True)
                    rough = squares - 2 * x @ v.T + (x**2).sum(axis=1)[:, None]
                    slack = 1e-9 * (squares.max() + (x**2).sum(axis=1)) + SLACK
                    for i, (qid, wanted, aways) in enumerate(lists):
                        reach = np.inf if np.isnan(reaches[i]) else reaches[i]
                        spans = []
                        for c, away in zip(wanted, aways, strict=True):
                            a, b = begins[c], begins[c + 1]
                            spans.append(np.arange(a + np.searchsorted(at[a:b], away - reach - SLACK), a + np.searchsorted(at[a:b], away + reach + SLACK, side="right")))
                        near = np.concatenate(spans)
                        if counter is not None:
                            counter.add(len(near))
                        limit = (reach + SLACK) ** 2 + slack[i]
                        if len(near) > k:
                            limit = min(limit, np.partition(rough[i, near], k - 1)[k - 1] + 2 * slack[i])
                        near = near[rough[i, near] <= limit]
                        if not len(near):
                            continue
                        distance = _distances(v[near], x[i])
                        kept = best(distance, names[near], k)
                        kept = kept[distance[kept] <= reach + SLACK]
                        out.append((np.full(len(kept), qid), names[near][kept], distance[kept]))
            qids, ids, distances = (np.concatenate(c) for c in zip(*out, strict=True)) if out else ([], [], [])
            return pa.Table.from_arrays([pa.array(qids, pa.int64()), pa.array(ids, own.schema.field("id").type), pa.array(distances, pa.float64())], names=["qid", "id", "distance"])

        at = lambda numbers, no: F.element_at(F.array(*[F.lit(int(n)) for n in numbers]), no + 1) if len(numbers) else F.lit(1)
        part = F.pmod(F.xxhash64("qid"), at(parts, F.col("bin"))).cast("int")
        due = cells.withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), at(blocks, F.col("bin")) - 1)))
        held = self.rows.withColumn("bin", at(bins, F.col("cell")))
        held = held.withColumn("block", F.pmod(F.xxhash64("id"), at(blocks, F.col("bin"))).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), at(parts, F.col("bin")) - 1)))
        by = ["bin", "block", "part"]
        return held.groupBy(*by).cogroup(due.groupBy(*by)).applyInArrow(run, f"qid bigint, id {kind}, distance double")
