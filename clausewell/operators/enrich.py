"""Words that a clause implies but doesn't spell: parts of identifiers, acronyms."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clausewell.functions import markup, words
from clausewell.operators import chunking

AUX_MAX_CHARS = 4000
CHUNK_AUX_ENTRIES = 61
JOINT = " · "


_IN_RUN = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-"))
_LOW, _UP = (np.isin(np.arange(256), list(x)) for x in (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
_ALNUM = _IN_RUN & ~np.isin(np.arange(256), list(b"_-"))


def entry_lists(texts: pa.Array) -> pa.ListArray:
    """``split_entries`` of each text.  An identifier lies in a run of letters, digits, _ and -
    and has a hyphen between two of them or a capital behind a small letter: only runs that
    have one are looked at."""
    pattern, cuts = re.compile(markup.IDENTIFIER), re.compile(markup.WORD_ENDS)

    @lru_cache(1 << 16)
    def known(run: bytes) -> list[tuple[str, str | None]]:
        split = [(x, [w for w in cuts.split(x) if len(w) >= 2]) for x in pattern.findall(run.decode())]
        return [(x, " ".join(w) if len(w) >= 2 else None) for x, w in split]

    data, begins = words.joined_bytes(texts)
    start, end = words.runs(_IN_RUN[data], begins)
    hint = np.zeros(len(data), bool)
    hint[1:-1] = (data[1:-1] == ord("-")) & _ALNUM[data[:-2]] & _ALNUM[data[2:]]
    hint[:-1] |= _LOW[data[:-1]] & _UP[data[1:]]
    run = np.unique(np.searchsorted(start, np.flatnonzero(hint), side="right") - 1)
    ends, whole = np.searchsorted(start[run], begins).tolist(), data.tobytes()
    found = [whole[a:b] for a, b in zip(start[run].tolist(), end[run].tolist(), strict=True)]
    lists = []
    for a, b in zip(ends, ends[1:], strict=False):
        distinct = dict(x for r in found[a:b] for x in known(r)) if a < b else {}
        lists.append([e for e in distinct.values() if e is not None])
    return pa.array(lists, pa.list_(pa.string()))


def split_entries(text: Column) -> Column:
    """Word splits of the identifiers that have two words or more."""

    def run(texts: pa.Array) -> pa.Array:
        parts = words.slices(pa.record_batch({"t": texts}))
        return pa.chunked_array([entry_lists(b.column(0)) for b in parts], pa.list_(pa.string())).combine_chunks()

    return F.when(text.isNotNull(), F.arrow_udf(run, "array<string>")(text))


def capped(entries: Column, limit: int = AUX_MAX_CHARS) -> Column:
    """Entries up to and with the first that takes their joint length over the limit."""
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("size"))

    def step(acc: Column, e: Column) -> Column:
        size = F.when(F.size(acc["kept"]) == 0, F.length(e)).otherwise(acc["size"] + len(JOINT) + F.length(e))
        return F.when(acc["size"] > limit, acc).otherwise(F.struct(F.concat(acc["kept"], F.array(e)).alias("kept"), size.alias("size")))

    return F.aggregate(entries, start, step, lambda acc: acc["kept"])


def chunk_aux(text: Column) -> Column:
    return F.array_join(F.slice(split_entries(text), 1, CHUNK_AUX_ENTRIES), JOINT)


def chunk_documents(clauses: DataFrame, key: str = "id", title: str = "title", text: str = "text") -> DataFrame:
    """(id, n, chunk) as the chunk index takes them: windows with the words of their
    identifiers behind them; clauses of definitions stay out."""
    rows = chunking.chunks(clauses.where(~definitional(F.col(title))), key, title, text)
    return rows.withColumn("chunk", F.concat_ws("\n", "chunk", F.nullif(chunk_aux(F.col("chunk")), F.lit(""))))


def clause_aux(clauses: DataFrame, glossary: DataFrame, key: str = "id", title: str = "title", text: str = "text") -> DataFrame:
    """(id, aux): identifier splits, then the expansions of acronyms that the clause
    uses without spelling them out, in the glossary's order, cut to 4000 characters.

    ``glossary``: no, acronym, expansion.  Clauses meet acronyms on their words, so
    the work follows the acronyms that occur, not the glossary's size.
    """
    hay = F.concat_ws("\n", title, text)
    rows = clauses.select(key, hay.alias("hay"))
    words = rows.select(key, F.explode(F.array_distinct(F.regexp_extract_all("hay", F.lit(r"([A-Za-z0-9_]+(?:[-/][A-Za-z0-9_]+)*)"), F.lit(1)))).alias("word"))
    parts = words.select(key, F.explode(F.array_distinct(F.concat(F.array("word"), F.split("word", "[-/]")))).alias("acronym")).distinct()
    used = parts.join(glossary, "acronym")
    spelled = used.join(rows, key).where(~F.contains(F.lower("hay"), F.lower("expansion")))
    ordered = F.array_sort(F.collect_list(F.struct("no", "expansion")))
    expansions = spelled.groupBy(key).agg(F.transform(ordered, lambda s: s["expansion"]).alias("expansions"))
    entries = F.concat(capped(split_entries(F.col("hay"))), F.coalesce("expansions", F.array().cast("array<string>")))
    return rows.join(expansions, key, "left").select(key, F.substring(F.array_join(entries, JOINT), 1, AUX_MAX_CHARS).alias("aux"))


def definitional(title: Column) -> Column:
    """Titles of definitions, symbols and abbreviations, kept out of the chunk index."""
    return F.trim(title).rlike(r"(?i)^(definitions?|symbols?|abbreviations?)(\s+(of|and)\b.*)?\z")
