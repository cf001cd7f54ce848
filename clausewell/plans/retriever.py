"""Hybrid retrieval of a batch of queries: lexical ladders over clauses and chunks,
nearest vectors, weighted fusion with priors, citation pulls."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import MISSING, dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession, functions as F

from clausewell.functions import markup, words
from clausewell.operators import citations, fusion, ladder, vectors
from clausewell.operators.neighbours import PivotIndex
from clausewell.operators.postings import CLAUSE_WEIGHTS, Index, Searcher
from clausewell.operators.segments import WRITTEN, StoredIndex
from clausewell.sources import sinks
from clausewell.sources.shared import exists, materialize


@dataclass(frozen=True)
class RetrieverConfig:
    candidates: int = ladder.CANDIDATES
    over_fetch: int = ladder.OVER_FETCH
    rrf_k: int = fusion.RRF_K
    floor_weight: float = fusion.FLOOR_WEIGHT
    vec_z: float = fusion.VEC_Z
    clause_weight: float = 1.0
    chunk_weight: float = 1.0
    vector_weight: float = 1.0
    most_pulled: int = citations.MOST_PULLED
    spec_cap: int | None = None
    priors: list[fusion.Prior] = field(default_factory=lambda: list(fusion.PRIORS))
    column_weights: dict[str, float] = field(default_factory=lambda: dict(CLAUSE_WEIGHTS))

    @classmethod
    def from_settings(cls, env: Mapping[str, str], flags: Sequence[str] = (), prefix: str = "RETRIEVER_") -> RetrieverConfig:
        """The numbers of a configuration out of environment variables (``RETRIEVER_RRF_K``)
        and flags (``--rrf-k=60``), which come first; empty ones are left at their defaults.
        A flag that names no number of the configuration is an error."""
        kinds = {f.name: type(f.default) if f.default is not None else int for f in fields(cls) if f.default is not MISSING}
        given = {name: env[key] for name in kinds if env.get(key := prefix + name.upper(), "") != ""}
        for flag in flags:
            key, _, value = flag.removeprefix("--").partition("=")
            name = key.replace("-", "_")
            if not flag.startswith("--") or name not in kinds:
                raise ValueError(f"unknown setting {flag}")
            if value != "":
                given[name] = value
        return cls(**{name: kinds[name](value) for name, value in given.items()})


def two_tier_plan(questions: DataFrame) -> DataFrame:
    """All of a query's distinct tokens (at most 40), then any of them: the ladder
    without a glossary, planned as columns for any number of queries."""
    terms = F.slice(F.array_distinct(words.tokens(F.col("text"))), 1, 40)
    rows = questions.select("qid", F.posexplode(terms).alias("no", "term"))
    tiers = F.explode(F.array(F.struct(F.lit(0).alias("tier"), F.lit(False).alias("is_floor"), F.col("no").alias("group_no")), F.struct(F.lit(1).alias("tier"), F.lit(True).alias("is_floor"), F.lit(0).alias("group_no"))))
    return rows.select("qid", tiers.alias("t"), F.array("term").alias("terms")).select("qid", "t.tier", "t.is_floor", "t.group_no", "terms")


def lexical(index: Searcher, plan: DataFrame, id_col: str, fetch: int, owner: str | None = None, owners: DataFrame | None = None) -> DataFrame:
    """(qid, id, is_floor, rank) of a ladder over an index; chunk hits are pooled by
    their owner, which comes with them or out of ``owners``."""
    floors = plan.select("qid", "tier", "is_floor").distinct()
    hits = index.best(plan.select("qid", "tier", "group_no", "terms"), fetch).join(floors, ["qid", "tier"])
    found = ladder.fetch(hits, id_col, fetch)
    if owner is None or (owner not in found.columns and owners is None):
        return ladder.walk(found, id_col)
    owned = found if owner in found.columns else found.join(owners, id_col)
    return ladder.walk(ladder.pooled(owned, owner), owner)


class Retriever:
    """Over clauses (id, text and the columns of the index), chunks (chunk_id, id,
    chunk) and vectors (id, vec); either of the latter two may be missing.  ``facts`` are
    those stored with the vectors, ``embedder`` the model and size of query vectors.

    What is built once and searched often is handed in: ``index`` and ``chunk_index`` (stored
    ones), ``near`` (vectors in cells) and ``degrees`` (``citations.stored_in_degree``);
    ``save`` and ``open`` do so for a whole folder."""

    def __init__(self, clauses: DataFrame, chunks: DataFrame | None = None, vecs: DataFrame | None = None, config: RetrieverConfig | None = None, facts: dict | None = None, embedder: tuple[str, int] | None = None, *, index: Searcher | None = None, chunk_index: Searcher | None = None, near: PivotIndex | None = None, degrees: DataFrame | None = None):
        self.clauses, self.chunks, self.config, self.facts = clauses, chunks, config or RetrieverConfig(), facts
        # Vectors of another model or size would rank at random: lexical search alone then.
        self.vecs = vecs if embedder is None or vectors.compatible(facts or {}, *embedder) else None
        known = {c: w for c, w in self.config.column_weights.items() if c in clauses.columns}
        self.index = index or Index(clauses, "id", known)
        self.chunk_index = chunk_index or (Index(chunks, "chunk_id", {"chunk": 1.0}, carry=("id",)) if chunks is not None else None)
        self.near = near or (PivotIndex(self.vecs) if self.vecs is not None else None)
        self.degrees = degrees if degrees is not None else citations.in_degree(citations.edges(clauses))

    @classmethod
    def open(cls, spark: SparkSession, folder: str, config: RetrieverConfig | None = None, embedder: tuple[str, int] | None = None) -> Retriever:
        """A retriever over what ``save`` wrote.  Chunks, vectors and indexes are looked for;
        what isn't there is searched without, or built from the clauses."""
        read = lambda name: spark.read.parquet(f"{folder}/{name}") if exists(spark, f"{folder}/{name}/_SUCCESS") else None
        index = lambda name: StoredIndex(spark, f"{folder}/{name}") if exists(spark, f"{folder}/{name}") else None
        clauses, facts = read("clauses"), read("facts")
        if clauses is None:
            raise FileNotFoundError(f"no clauses under {folder}")
        known = {r["key"]: r["value"] for r in facts.collect()} if facts is not None else None  # a few facts
        degrees = citations.stored_in_degree(clauses, f"{folder}/degrees")
        return cls(clauses, read("chunks"), read("vectors"), config, known, embedder, index=index("index"), chunk_index=index("chunk_index"), degrees=degrees)

    def save(self, folder: str) -> None:
        """Write clauses, chunks, vectors, both indexes, in-degrees and facts under a folder
        where there is nothing yet; indexes are made of what is written."""
        spark = self.clauses.sparkSession
        if exists(spark, folder):
            raise FileExistsError(folder)
        for name, rows in (("clauses", self.clauses), ("chunks", self.chunks), ("vectors", self.vecs), ("facts", sinks.facts(spark, self.facts) if self.facts else None)):
            if rows is not None:
                rows.write.options(**WRITTEN).parquet(f"{folder}/{name}")
        for name, index, table, rows in (("index", self.index, "clauses", self.clauses), ("chunk_index", self.chunk_index, "chunks", self.chunks)):
            if isinstance(index, Index):
                kept = spark.read.schema(rows.schema).parquet(f"{folder}/{table}") if index.source is rows else index.source
                Index(kept, index.key, index.weights, index.tokenizer).store(f"{folder}/{name}")
        citations.stored_in_degree(spark.read.parquet(f"{folder}/clauses"), f"{folder}/degrees")

    def fused(self, questions: DataFrame, plan: DataFrame) -> DataFrame:
        """(qid, id, score, rank) before citations are pulled."""
        c = self.config
        lists = [(lexical(self.index, plan, "id", c.candidates), c.clause_weight)]
        if self.chunk_index is not None:
            lists.append((lexical(self.chunk_index, plan, "chunk_id", c.candidates * c.over_fetch, "id", self.chunks.select("chunk_id", "id")), c.chunk_weight))
        if self.near is not None and "vec" in questions.columns:
            dense = self.near.search(questions.select("qid", "vec"), c.candidates)
        else:
            dense = questions.sparkSession.createDataFrame([], "qid bigint, id string, distance double, rank bigint")
        fused = fusion.weighted_rrf(lists, dense, c.vector_weight, "id", c.rrf_k, c.floor_weight, c.vec_z)
        weighted = fused.withColumn("score", F.col("score") * fusion.prior(markup.spec_of(F.col("id")), F.col("id"), c.priors))
        return fusion.ranked(weighted, "id").select("qid", "id", "score", "rank")

    def retrieve(self, questions: DataFrame, plan: DataFrame | None = None, rerank: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """(qid, id, rank) for questions (qid, text and, if dense, vec)."""
        found = self.fused(questions, two_tier_plan(questions) if plan is None else plan)
        if self.config.spec_cap:
            found = fusion.spec_cap(found.withColumn("spec", markup.spec_of(F.col("id"))), "id", "spec", self.config.spec_cap)
        found = materialize(found, "retrieved")  # short lists that the pull reads four times
        tokens = questions.select("qid", F.array_distinct(words.tokens(F.col("text"))).alias("tokens"))
        out = citations.pull(found, self.clauses, tokens, self.degrees, most=self.config.most_pulled)
        return rerank(out) if rerank else out
