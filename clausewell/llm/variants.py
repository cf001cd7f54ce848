"""Spelling variants of words, by an index of variable-length grams.

Words are near if one inserted, deleted or replaced code point apart.

1. **Gram dictionary.** Grams of two and three code points are counted over all words.
   A gram that more than ``SHORT_LIST`` places hold is *frequent*: its list would be
   long, so it is left out of use for the longer grams that it begins.  What is kept are
   the frequent grams, at most alphabet ** 2 + alphabet ** 3 of them whatever the size of
   the corpus, so they fit every task.
2. **Decomposition.** At each place of a word stands the shortest gram of two to four code
   points that is not frequent (four, or what the word has left, if all are).  Finding it
   looks at the gram and at most one code point behind it.
3. **Affected grams.** One edit changes only grams whose looked-at stretch holds its
   place; the most that any place can change is the word's bound ``a`` (four at most).
   A word of g grams thus shares g - a grams, in their places, with every near word.
   So of its lists the g - a - 1 longest needn't be read: two near words meet in one of
   the a + 1 shortest of both.
4. **Merging.** Lists are kept by gram, place and length of word.  Of equally long words
   a shared gram stands at the same place; of a word one longer, at the same or the next.
   A list of over ``list_words`` words is read in parts: a shared gram has the whole edit
   on one side, so on its other side the words are equal, and lists are parted by what
   stands before, and by what stands behind.
5. **Verification.** Words that meet are compared by edit distance inside the join: only
   near pairs leave it, each once.

No pair is lost, no list is cut.  Edge cases: null texts have no words; a null id reads as
empty where ids are hashed; words may be of any length; words under ``LEAST`` code points
are none; repeated rows count each; an empty table has no words; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize

#: Runs that are words; upper case of these is folded, of others not.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM, LONGEST = 2, 4
#: Shortest words: six grams, of which an edit may change four.
LEAST = 7
SHORT_LIST = 64
LIST_WORDS = 2000
#: Letters that words may be made of, so the most frequent grams that there can be.
ALPHABET = 26 + 64


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo_every: int | None = 31, least: int = LEAST, occurrences: int = 2) -> DataFrame:
    """(word, n) of all words of ``least`` code points and ``occurrences`` or more.

    If the checksum of id and word is a multiple of ``typo_every``, the word has lost a
    code point there: misspellings that are there to be found.
    """
    runs = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(f"({RUN})"), F.lit(1))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("word")).where(F.length("word") >= least)
    if typo_every:
        check = F.crc32(F.concat("id", F.lit(":"), "word"))
        at = (check % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        rows = rows.select(F.when(check % typo_every == 0, cut).otherwise(F.col("word")).alias("word")).where(F.length("word") >= least)
    return rows.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= occurrences)


def frequent_grams(words: DataFrame, short_list: int = SHORT_LIST) -> dict[str, int]:
    """Grams that are too frequent to be used, and the places that hold them."""
    places = lambda q: F.transform(F.sequence(F.lit(1), F.length("word") - (q - 1)), lambda i: F.substring("word", i, F.lit(q)))
    grams = words.select(F.explode(F.concat(*[places(q) for q in range(GRAM, LONGEST)])).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > short_list)
    most = sum(ALPHABET**q for q in range(GRAM, LONGEST))
    found = counted.limit(most + 1).toPandas()
    if len(found) > most:
        raise ValueError(f"over {most} frequent grams: words are made of more letters than {ALPHABET}")
    return dict(zip(found["gram"].tolist(), found["n"].tolist(), strict=True))


def decomposed(word: str, frequent: dict[str, int]) -> tuple[list[str], int]:
    """The grams of a word by place, and how many of them one edit can change."""
    size = len(word)
    grams, spans = [], [0] * (size + 2)
    for p in range(size - GRAM + 1):
        q = GRAM
        while q < LONGEST and p + q < size and word[p : p + q] in frequent:
            q += 1
        grams.append(word[p : p + q])
        last = p + q if q < LONGEST else p + q - 1  # the last code point, or end, looked at
        spans[p] += 1
        spans[last + 1] -= 1
    most = held = 0
    for change in spans:
        held += change
        most = max(most, held)
    return grams, most


def weight(gram: str, frequent: dict[str, int], short_list: int = SHORT_LIST) -> int:
    """At most so many places hold the gram."""
    known = [gram] if len(gram) < LONGEST else [gram[:-1], gram[1:]]
    return min(frequent.get(g, short_list) for g in known)


def signatures(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(word, n, size, place, gram): of each word's grams the ones on the shortest lists,
    one more than an edit can change."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, places, chosen = [], [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                grams, most = decomposed(word, frequent)
                for p in sorted(range(len(grams)), key=lambda p: (weight(grams[p], frequent), grams[p], p))[: most + 1]:
                    row.append(i)
                    places.append(p)
                    chosen.append(grams[p])
            own = pa.array(row, pa.int64())
            size = pa.array([len(w) for w in batch.column(0).to_pylist()], pa.int32()).take(own)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), size, pa.array(places, pa.int32()), pa.array(chosen, pa.string())], names=["word", "n", "size", "place", "gram"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, size int, place int, gram string")


def near_words(words: DataFrame, short_list: int = SHORT_LIST, list_words: int = LIST_WORDS) -> DataFrame:
    """(a, a_n, b, b_n): all pairs of distinct words (word, n) one edit apart, each once; a
    is the shorter, or of equal length the lesser.  Words of under ``LEAST`` code points
    have no near words here."""
    words = words.where(F.length("word") >= LEAST)
    frequent = frequent_grams(words, short_list)
    sigs = materialize(signatures(words, frequent), "variants-signatures")
    by = ["gram", "place", "size"]
    long = sigs.groupBy(*by).agg(F.count("*").alias("words")).where(F.col("words") > list_words).select(*by, F.lit(True).alias("long"))
    long = materialize(long, "variants-long-lists")
    # A word reads the lists of its own length, and of words one longer at two places.
    reads = F.explode(F.array(*[F.struct(F.lit(more).alias("more"), F.lit(step).alias("step")) for more, step in ((0, 0), (1, 0), (1, 1))]))
    asked = sigs.select("word", "n", "gram", F.col("place").alias("own"), F.col("size").alias("own_size"), reads.alias("r"))
    asked = asked.select("word", "n", "gram", "own", (F.col("own") + F.col("r.step")).alias("place"), (F.col("own_size") + F.col("r.more")).alias("size"), F.col("r.more").alias("more"))
    held = sigs.withColumn("own", F.col("place"))
    left, right = _parted(asked.join(long, by, "left")), _parted(held.join(long, by, "left"))
    a = left.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), "more")
    b = right.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    apart = ((F.col("more") == 1) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    return a.join(b, (a["key"] == b["key"]) & apart).select("a", "a_n", "b", "b_n").distinct()


def _parted(rows: DataFrame) -> DataFrame:
    """Rows with the ``key`` of the list that they read or stand in; on a long list, of
    the parts of it that hold the same text before, or behind, the gram."""
    before = F.substring("word", F.lit(1), F.col("own"))
    behind = F.substring("word", F.col("own") + F.length("gram") + 1, F.length("word"))
    whole = F.xxhash64("gram", "place", "size")
    parts = F.array(F.xxhash64("gram", "place", "size", F.lit("before"), before), F.xxhash64("gram", "place", "size", F.lit("behind"), behind))
    return rows.withColumn("key", F.explode(F.when(F.col("long"), parts).otherwise(F.array(whole))))


def group_variants(words: DataFrame, times: int = 10, short_list: int = SHORT_LIST, list_words: int = LIST_WORDS) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of words (word, n): the form is the most frequent
    near word (the least of equals) if it is ``times`` as frequent, the root where forms
    lead; ``words`` is read more than once."""
    pairs = materialize(near_words(words, short_list, list_words), "variants-near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).union(pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    held = words.join(best, "word", "left")
    fits = -F.col("best.less") >= times * F.col("n")
    formed = held.select("word", "n", F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"), F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"))
    formed = materialize(formed, "variants-forms")
    roots = _roots(formed.where("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select("word", "n", "form", "form_n", "n_near", F.coalesce("root", "word").alias("root"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last.  A form is many times as frequent as its
    word, so chains are short and without a circle; each round doubles what is followed."""
    forms = materialize(forms, "variants-roots")
    while True:
        last, above = forms, forms.select(F.col("word").alias("root"), F.col("root").alias("above"))
        joined = last.join(above, "root", "left")
        forms = materialize(joined.select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "variants-roots")
        discard(last)
        moved = not forms.where("moved").isEmpty()
        forms = forms.select("word", "root")
        if not moved:
            return forms


def of_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = 10) -> DataFrame:
    """``group_variants`` of the words of all texts."""
    return group_variants(materialize(word_counts(docs, id_col, text_col), "variants-words"), times)
