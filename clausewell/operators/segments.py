"""A stored index in segments: pruned scans, early stopping, and updates.

Under a path lie tables, each partitioned by segment:

``postings``  of kind ``posting``, a row for each term and document (term, block, id, dl, tf,
              places), and of kind ``impact``, one for each term and block: how many
              documents, their largest tf, their least length; in folders by kind, by a hash
              of the term (``bucket``) and by length of document (``band``)
``docs``      a row for each document: id, length, distinct terms
``gone``, ``lost``  documents that were deleted, and the terms that they held

**Pruning.** A search meets the asked terms by bucket and term, so that Spark reads the
folders of asked buckets only, and reads them once for words and phrases alike.

**Early stopping** (``top``).  Documents of like length form blocks of about
``BLOCK_DOCS``.  A term's largest tf and least length in a block bound what it can add to a
score there; a query's bounds are summed by block.  The blocks of the largest bounds are
scored first; the k-th best score so found is a threshold, and only blocks whose bound
reaches it are read.  The result is the exact first k.

**Updates.** ``add`` writes a segment; ids that were there are deleted from the older ones.
``delete`` writes down what is gone.  The number of documents, their mean length and the
frequencies of terms follow from counts of segments less what is lost, so that scores equal
those of an index built anew.  ``merge`` writes segments together without what is gone.
Each change becomes visible by one small file, the next version of the state; one writer
at a time, any number of readers.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clausewell.functions import words
from clausewell.operators import packed, scoring
from clausewell.operators.postings import IDF_FLOOR, K1, B, Index, Plan, Searcher, counted, top_k
from clausewell.sources.shared import discard, fresh_path, materialize

#: Documents of a block, about.
BLOCK_DOCS = 128
#: Steps of length by which blocks are told apart, in an octave; a band is an octave.
STEPS = 8
#: Terms and documents of a bucket, about, and the most buckets.
BUCKET_ROWS, MOST_BUCKETS = 250_000, 1024
#: A place is a position and, from this bit on, the number of its column.
COLUMN_BIT = 40
PLACES = 1 << 20
#: Documents of a task that has all of their postings, about; blocks that are sent to all tasks.
PART_DOCS, SENT = 8192, 200_000
#: Files that a task writes at once: a part of postings has a bucket of every band, of two kinds.
OPEN_FILES = 64
#: Tables of an index are read seldom; terms and places repeat beyond Parquet's megabyte.
WRITTEN = {"compression": "zstd", "parquet.dictionary.page.size": str(8 << 20)}


@dataclass(frozen=True)
class State:
    """What a version of the index consists of; counts are (documents, their lengths)."""

    key: str
    kind: str
    weights: list[tuple[str, float]]
    #: As many as the first documents ask for, if it is 0.
    buckets: int
    version: int = 0
    segments: dict[str, list[int]] = field(default_factory=dict)
    #: Of each deletion, what it has taken from which segment.
    deletions: dict[str, dict[str, list[int]]] = field(default_factory=dict)
    #: The last batch of a stream that is in.
    batch: int | None = None


def _folders(spark: SparkSession, path: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    return [f.getPath().getName() for f in files.listStatus(place) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]


class StoredIndex(Searcher):
    """The newest version of the index under a path."""

    def __init__(self, spark: SparkSession, path: str, tokenizer: Callable[[Column], Column] = words.tokens):
        versions = _folders(spark, f"{path}/states")
        if not versions:
            raise FileNotFoundError(f"no index under {path}")
        self.spark, self.path, self.tokenizer = spark, path, tokenizer
        self.state = State(**json.loads(spark.read.text(f"{path}/states/{max(versions)}").first()[0]))
        self.key = self.state.key
        taken = [c for d in self.state.deletions.values() for c in d.values()]
        self.n = sum(n for n, _ in self.state.segments.values()) - sum(n for n, _ in taken)
        total = sum(dl for _, dl in self.state.segments.values()) - sum(dl for _, dl in taken)
        self.avgdl = total / self.n if self.n and total else 1.0

    @classmethod
    def create(cls, spark: SparkSession, path: str, key: str, kind: str, weights: dict[str, float], buckets: int, tokenizer: Callable[[Column], Column] = words.tokens) -> StoredIndex:
        """An index of no documents."""
        if _folders(spark, f"{path}/states"):
            raise FileExistsError(f"there is an index under {path}")
        _save(spark, path, State(key, kind, list(weights.items()), buckets))
        return cls(spark, path, tokenizer)

    # --- tables ---

    def _table(self, name: str, columns: str, live: list[str], by: str = "segment") -> DataFrame:
        rows = self.spark.read.schema(f"{columns}, {by} string")
        if not live:
            return self.spark.createDataFrame([], f"{columns}, {by} string")
        return rows.parquet(f"{self.path}/{name}").where(F.col(by).isin(live))

    def _postings(self) -> DataFrame:
        return self._rows("posting").drop("docs")

    def _impacts(self) -> DataFrame:
        return self._rows("impact").withColumnsRenamed({"tf": "max_tf", "dl": "min_dl"})

    def _rows(self, kind: str) -> DataFrame:
        columns = f"term string, block bigint, `{self.key}` {self.state.kind}, dl bigint, tf double, places array<bigint>, docs bigint, kind string, bucket int, band int"
        return self._table("postings", columns, list(self.state.segments)).where(F.col("kind") == kind).drop("kind")

    def docs(self, asked: DataFrame | None = None) -> DataFrame:
        """(id, dl, terms, segment) of the documents that are there, or of those asked for by
        their ids."""
        rows = self._table("docs", f"`{self.key}` {self.state.kind}, dl bigint, terms array<string>", list(self.state.segments))
        if asked is None and not self.state.deletions:
            return rows
        schema = f"id {self.state.kind}, dl bigint, terms array<string>, segment string"
        parts = self._parts(sum(n for n, _ in self.state.segments.values()))
        return self._documents(rows, lambda found: iter(found.to_batches(10_000)), schema, parts, asked).withColumnRenamed("id", self.key)

    def _gone(self) -> DataFrame:
        return self._table("gone", f"segment string, `{self.key}` {self.state.kind}, dl bigint", list(self.state.deletions), "deletion").where(F.col("segment").isin(list(self.state.segments)))

    def _lost(self) -> DataFrame:
        return self._table("lost", "segment string, term string, df bigint", list(self.state.deletions), "deletion").where(F.col("segment").isin(list(self.state.segments)))

    def _parts(self, rows: int | None = None) -> int:
        """Tasks for whole documents."""
        return max(self.spark.sparkContext.defaultParallelism, -(-(self.n if rows is None else rows) // PART_DOCS))

    def _documents(self, rows: DataFrame, use: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, parts: int, asked: DataFrame | None = None) -> DataFrame:
        """What ``use`` makes of rows (segment, id, ...), all of a document in one task, without
        those that are gone; if ids are asked for, of those only."""

        def dealt(some: DataFrame, *columns: str) -> DataFrame:
            named = [F.col(self.key).alias("id") if c == self.key else F.col(c) for c in columns]
            return some.select(F.pmod(F.xxhash64(self.key), F.lit(parts)).cast("int").alias("part"), *named).mapInArrow(packed.packing(("id",)), "part int, payload binary")

        held = dealt(rows, *rows.columns)
        if self.state.deletions:
            held = held.union(dealt(self._gone(), "segment", self.key))
        if asked is not None:
            held = held.union(dealt(asked.select(F.col(asked.columns[0]).cast(self.state.kind).alias(self.key)), self.key))
        return packed.dealt(held, parts).mapInArrow(packed.whole(use), schema)

    def _bucket(self, term: Column | str) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(max(1, self.state.buckets))).cast("int")

    # --- search ---

    def _asked(self, terms: list[str]) -> DataFrame:
        """(no, term, bucket), ready to be sent to all tasks."""
        rows = self.spark.createDataFrame(list(enumerate(terms)), "no int, term string").withColumn("bucket", self._bucket("term"))
        # Written out, and filtered, so that Spark prunes folders by it.
        return F.broadcast(materialize(rows, "index-asked").where("bucket >= 0"))

    def _held(self, known: scoring.Units, blocks: DataFrame | None = None) -> DataFrame:
        """(id, dl, units, tfs): which units the documents hold, of all or of some blocks
        (segment, band, block); words and phrases out of one scan of the asked buckets."""
        hits = self._postings().join(self._asked(known.terms.to_pylist()), ["bucket", "term"])
        if blocks is not None:
            hits = hits.join(blocks, ["segment", "band", "block"], "left_semi")
        columns = (*(["segment"] if self.state.deletions else []), self.key, "dl", "no", *(["places"] if len(known.levels) > 1 else ["tf"]))
        weights = [w for _, w in self.state.weights]
        return self._documents(hits.select(*columns), lambda rows: known.regrouped(rows, weights, COLUMN_BIT), f"id {self.state.kind}, dl bigint, units array<int>, tfs array<double>", self._parts())

    def occurrences(self, units: DataFrame) -> DataFrame:
        """(unit, id, dl, tf); units that don't fit into a task meet in joins."""
        rows = units.select("unit", "terms").distinct().limit(scoring.MOST_ROWS + 1).collect()  # bounded
        if len(rows) > scoring.MOST_ROWS:
            return self._joined(units)
        asked = sorted({tuple(r["terms"]) for r in rows if r["terms"]})
        at = {u: i for i, u in enumerate(asked)}
        names = self.spark.createDataFrame([(at[tuple(r["terms"])], r["unit"]) for r in rows if r["terms"]], f"no int, unit {units.schema['unit'].dataType.simpleString()}")
        if not asked:
            return self._joined(units)
        found = self._held(scoring.Units(asked)).select(F.col("id").alias(self.key), "dl", F.explode(F.arrays_zip("units", "tfs")).alias("u"))
        found = found.select(self.key, "dl", F.col("u.units").alias("no"), F.col("u.tfs").alias("tf")).join(F.broadcast(names), "no")
        return found.select("unit", self.key, "dl", "tf").where("tf > 0")

    def _joined(self, units: DataFrame) -> DataFrame:
        """``occurrences`` of any number of units."""
        parts = units.select("unit", F.size("terms").alias("n_terms"), F.posexplode("terms").alias("offset", "term"))
        # Written out, so that Spark knows their size; the filter lets it prune folders by them.
        parts = materialize(parts.distinct().withColumn("bucket", self._bucket("term")), "index-asked").where("n_terms > 0")
        hits = self._postings().join(parts, ["bucket", "term"])
        if self.state.deletions:
            hits = hits.join(self._gone().select("segment", self.key), ["segment", self.key], "left_anti")
        starts = F.when(F.col("n_terms") > 1, F.transform("places", lambda p: p - F.col("offset")))
        found = hits.groupBy("unit", self.key, "dl", "n_terms").agg(F.first("tf").alias("tf"), F.collect_list(starts).alias("starts"))
        whole = F.aggregate(F.slice("starts", 2, PLACES), F.element_at("starts", 1), F.array_intersect)
        weights = F.array(*[F.lit(float(w)) for _, w in self.state.weights])
        weight = lambda p: F.element_at(weights, (F.shiftright(p, COLUMN_BIT) + 1).cast("int"))
        phrase = F.when(F.size("starts") == F.col("n_terms"), F.aggregate(whole, F.lit(0.0), lambda total, p: total + weight(p))).otherwise(0.0)
        tf = F.when(F.col("n_terms") == 1, F.col("tf")).otherwise(phrase)
        return found.select("unit", self.key, "dl", tf.alias("tf")).where("tf > 0")

    def best(self, plan: DataFrame, k: int) -> DataFrame:
        """As of any searcher; of a plan that fits into a task, postings meet by document and a
        task hands on the first k."""
        asked = Plan.bounded(plan, k)
        if asked is None or not asked.units:
            return super().best(plan, k)
        held = materialize(self._held(scoring.Units(asked.units)), "held")
        _, _, df = counted(held, len(asked.units))
        found = asked.ranked(held, df, self.n, self.avgdl, k, self.state.kind)
        return top_k(found.withColumnRenamed("id", self.key), k, ["qid", "tier"], self.key)

    def _part(self, tf: Column, dl: Column) -> Column:
        return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / F.lit(self.avgdl)))

    def _frequencies(self, held: DataFrame, asked: DataFrame, terms: int) -> np.ndarray:
        """The documents of each term: those of its impacts less what is lost."""
        df = np.zeros(terms)
        lost = self._lost().join(asked, "term").groupBy("no").agg(F.sum("df").alias("n"))
        for rows, sign in ((held.groupBy("no").agg(F.sum("docs").alias("n")), 1), (lost, -1)):
            for r in rows.collect():  # a row for each term
                df[r["no"]] += sign * r["n"]
        return df

    def top(self, asked: DataFrame, k: int) -> DataFrame:
        """(qid, id, score, rank): the first k documents for the OR of each query's terms
        (qid, term), as ``top_k`` of ``search`` gives them."""
        rows = asked.select("qid", F.lit(0).alias("tier"), F.lit(0).alias("group_no"), F.array("term").alias("terms")).where("terms[0] is not null").distinct()
        plan = Plan.bounded(rows, 2 * k)
        if plan is None:
            return self.best(rows, k).select("qid", self.key, "score", "rank")
        terms = [t for t, in plan.units]
        known, words_asked = scoring.Units(plan.units), self._asked(terms)
        held = materialize(self._impacts().join(words_asked, ["bucket", "term"]).select("segment", "band", "block", "no", "docs", "max_tf", "min_dl"), "top-impacts")
        df = self._frequencies(held, words_asked, len(terms))
        idf = np.log(np.maximum(self.n - df + 0.5, 0.5) / (df + 0.5))
        of = {q: i for i, (q, _) in enumerate(plan.tiers)}
        at = {t: i for i, t in enumerate(terms)}
        weights = self.spark.createDataFrame([(i, float(x) if x > 0 else IDF_FLOOR) for i, x in enumerate(idf)], "no int, idf double")
        queries = self.spark.createDataFrame([(at[r["terms"][0]], of[r["qid"]]) for r in plan.rows], "no int, query int")
        # A block's terms come to one task, where the bounds of all queries are summed.
        bounds = held.repartition("segment", "block").join(F.broadcast(weights), "no").withColumn("bound", F.col("idf") * self._part(F.col("max_tf"), F.col("min_dl")))
        most = bounds.join(F.broadcast(queries), "no").groupBy("segment", "band", "block", "query").agg(F.sum("bound").alias("most"))
        blocks = materialize(most, "top-blocks")
        order = Window.partitionBy("query").orderBy(F.col("most").desc(), "segment", "block")
        first = blocks.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 2 * k)  # k blocks or more: k documents or more
        best = self._in_blocks(plan, known, df, first, k)
        reached = best.groupBy("qid").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).collect()  # a row for each query
        least = self.spark.createDataFrame([(of[r["qid"]], r["least"]) for r in reached], "query int, least double")
        open_ = blocks.join(F.broadcast(least), "query", "left").where(F.col("least").isNull() | (F.col("most") >= F.col("least") - 1e-8))
        return self._in_blocks(plan, known, df, open_, k).select("qid", self.key, "score", "rank")

    def _in_blocks(self, plan: Plan, known: scoring.Units, df: np.ndarray, blocks: DataFrame, k: int) -> DataFrame:
        """(qid, id, score, rank): the first k of the documents of some blocks."""
        wanted = materialize(blocks.select("segment", "band", "block").distinct(), "top-wanted").where("block >= 0")
        few = wanted.limit(SENT + 1).count() <= SENT
        found = plan.ranked(self._held(known, F.broadcast(wanted) if few else wanted), df, self.n, self.avgdl, k, self.state.kind)
        return top_k(found.withColumnRenamed("id", self.key), k, ["qid"], self.key)

    # --- changes ---

    def add(self, docs: DataFrame, batch: int | None = None) -> StoredIndex:
        """The index with these documents, in place of those that had their ids; the ids of
        ``docs`` must be distinct.  A batch of a stream that is in already changes nothing."""
        if batch is not None and self.state.batch is not None and batch <= self.state.batch:
            return self
        name = f"s{self.state.version + 1:08d}"
        read = Index(docs, self.key, dict(self.state.weights), self.tokenizer).read
        weights, kind = [w for _, w in self.state.weights], self.state.kind
        found = read.mapInArrow(scoring.documents(len(weights)), f"id {kind}, dl bigint, terms array<string>").withColumnRenamed("id", self.key)
        own = self._write_docs(name, found)
        if not self.state.buckets:
            terms = own.agg(F.coalesce(F.sum("dl"), F.lit(0))).first()[0]
            self.state = replace(self.state, buckets=min(MOST_BUCKETS, max(1, -(-terms // BUCKET_ROWS))))
        rows = read.mapInArrow(scoring.indexing(weights, COLUMN_BIT, _bucket_of(self.state.buckets), STEPS, self.state.buckets), f"part int, term string, id {kind}, dl bigint, tf double, places array<bigint>")
        return self._with(name, rows, own, batch)

    def _write_docs(self, name: str, docs: DataFrame) -> DataFrame:
        docs.write.options(**WRITTEN).mode("overwrite").parquet(f"{self.path}/docs/segment={name}")
        return self.spark.read.schema(f"`{self.key}` {self.state.kind}, dl bigint, terms array<string>").parquet(f"{self.path}/docs/segment={name}")

    def _with(self, name: str, rows: DataFrame, own: DataFrame, batch: int | None, merged: tuple[str, ...] = ()) -> StoredIndex:
        """The state with a new segment of postings (part, term, id, dl, tf, places)."""
        n, distinct, total = own.agg(F.count(self.key), F.count_distinct(self.key), F.coalesce(F.sum("dl"), F.lit(0))).first()
        if n != distinct:
            raise ValueError(f"{n - distinct} documents repeat the {self.key} of another")
        # A few hundred rows.
        blocks = {r["step"]: r["blocks"] for r in own.groupBy(F.floor(F.log2(F.col("dl") + 1) * STEPS).alias("step")).agg(F.ceil(F.count("*") / BLOCK_DOCS).alias("blocks")).collect()}
        bucket = _bucket_of(self.state.buckets)
        dealt = packed.dealt(rows.mapInArrow(packed.packing(("id",)), "part int, payload binary"), self.state.buckets)
        schema = f"term string, block bigint, id {self.state.kind}, dl bigint, tf double, places array<bigint>, docs bigint, kind string, bucket int, band int"
        placed = dealt.mapInArrow(packed.whole(lambda found: scoring.arranged(found, bucket, STEPS, blocks)), schema).withColumnRenamed("id", self.key)
        with _open_files(self.spark):
            placed.write.options(**WRITTEN).mode("overwrite").partitionBy("kind", "bucket", "band").parquet(f"{self.path}/postings/segment={name}")
        state = self.state
        if merged:
            state = _without(state, merged)
        elif state.segments:
            state = self._deleting(state, own.select(self.key), name)
        return self._saved(replace(state, segments=state.segments | {name: [n, total]}, batch=batch if batch is not None else state.batch))

    def _deleting(self, state: State, ids: DataFrame, name: str) -> State:
        found = self.docs(asked=ids).select("segment", self.key, "dl", "terms")
        schema = found.schema
        place = fresh_path(self.spark, "index-gone")
        found.write.options(**WRITTEN).parquet(place)
        gone = self.spark.read.schema(schema).parquet(place)
        by = {r["segment"]: [r["n"], r["dl"]] for r in gone.groupBy("segment").agg(F.count("*").alias("n"), F.sum("dl").alias("dl")).collect()}  # a row for each segment
        if by:
            gone.select("segment", self.key, "dl").write.options(**WRITTEN).mode("overwrite").parquet(f"{self.path}/gone/deletion={name}")
            lost = gone.select("segment", F.explode("terms").alias("term")).groupBy("segment", "term").agg(F.count("*").alias("df"))
            lost.write.options(**WRITTEN).mode("overwrite").parquet(f"{self.path}/lost/deletion={name}")
            state = replace(state, deletions=state.deletions | {name: by})
        discard(gone)
        taken = lambda s: sum(by.get(s, [0])[0] for by in state.deletions.values())
        return _without(state, tuple(s for s, (n, _) in state.segments.items() if n and n == taken(s)))

    def delete(self, ids: DataFrame) -> StoredIndex:
        """The index without the documents of these ids; ids that it lacks are ignored."""
        return self._saved(self._deleting(self.state, ids.select(self.key), f"d{self.state.version + 1:08d}"))

    def merge(self, most: int | None = None) -> StoredIndex:
        """Segments of up to ``most`` documents (all without) as one, without what is gone."""
        names = tuple(s for s, (n, _) in self.state.segments.items() if most is None or n <= most)
        if not names:
            return self
        name = f"s{self.state.version + 1:08d}"
        own = self._write_docs(name, self.docs().where(F.col("segment").isin(list(names))).select(self.key, "dl", "terms"))
        rows = self._postings().where(F.col("segment").isin(list(names))).select("segment", "bucket", "term", self.key, "dl", "tf", "places")
        buckets = self.state.buckets

        def placed(found: pa.Table) -> Iterator[pa.RecordBatch]:
            for rows in found.to_batches(10_000):
                part = scoring.part_of(*(rows[c].to_numpy(zero_copy_only=False) for c in ("bucket", "dl")), STEPS, buckets)
                yield pa.RecordBatch.from_arrays([part, *(rows[c] for c in ("term", "id", "dl", "tf", "places"))], names=["part", "term", "id", "dl", "tf", "places"])

        schema = f"part int, term string, id {self.state.kind}, dl bigint, tf double, places array<bigint>"
        return self._with(name, self._documents(rows, placed, schema, self._parts(sum(self.state.segments[s][0] for s in names))), own, None, names)

    def vacuum(self) -> StoredIndex:
        """Delete the folders of segments and deletions that the newest state doesn't name;
        older states can't be read any more."""
        place = lambda *parts: self.spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
        files = place(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        newest = StoredIndex(self.spark, self.path, self.tokenizer)
        for table, live in (("postings", newest.state.segments), ("docs", newest.state.segments), ("gone", newest.state.deletions), ("lost", newest.state.deletions)):
            for folder in _folders(self.spark, f"{self.path}/{table}"):
                if folder.partition("=")[2] not in live:
                    files.delete(place(self.path, table, folder), True)
        return newest

    def _saved(self, state: State) -> StoredIndex:
        _save(self.spark, self.path, replace(state, version=self.state.version + 1))
        return StoredIndex(self.spark, self.path, self.tokenizer)


def _bucket_of(buckets: int) -> Callable[[str], int]:
    """Spark's hash of a term, as ``StoredIndex._bucket`` has it."""

    def bucket(term: str) -> int:
        return ((xxhash.xxh64_intdigest(term.encode(), 42) + (1 << 63)) % (1 << 64) - (1 << 63)) % buckets

    return bucket


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """Rows that come in their order are written to some folders at once, not sorted by folder."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _without(state: State, segments: tuple[str, ...]) -> State:
    """The state without some segments and what was deleted of them."""
    kept = {d: {s: c for s, c in by.items() if s not in segments} for d, by in state.deletions.items()}
    return replace(state, segments={s: c for s, c in state.segments.items() if s not in segments}, deletions={d: by for d, by in kept.items() if by})


def _save(spark: SparkSession, path: str, state: State) -> None:
    spark.createDataFrame([(json.dumps(asdict(state)),)], "state string").coalesce(1).write.mode("overwrite").text(f"{path}/states/{state.version:010d}")


def store(index: Index, path: str, overwrite: bool = False, buckets: int | None = None) -> StoredIndex:
    """An index of documents written under ``path``, as one segment."""
    rows = index.source
    spark = rows.sparkSession
    if overwrite:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    kind = rows.schema[index.key].dataType.simpleString()
    return StoredIndex.create(spark, path, index.key, kind, index.weights, buckets or 0, index.tokenizer).add(rows)


def or_terms(queries: DataFrame, qid: str, text: str, most: int = 40, tokenizer: Callable[[Column], Column] = words.tokens) -> DataFrame:
    """(qid, term): a query's first distinct tokens, for ``StoredIndex.top``."""
    terms = F.slice(F.array_distinct(tokenizer(F.col(text))), 1, most)
    return queries.select(F.col(qid).alias("qid"), F.explode(terms).alias("term"))
