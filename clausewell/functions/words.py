"""Word lists of the query language, tokenisers as column expressions, and stems."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# The words that queries and documents drop.
STOPWORDS = (
    "the a an and or of to in on for is are was were be been by with as at that this it its from into "
    "than then such not no do does did has have had"
).split()
# Words too common in the field to tell clauses apart.
GENERIC_TOKENS = (
    "one separate same parallel case transmission transmissions resource resources procedure overlapping overlap "
    "simultaneous cross channel channels uplink downlink slot symbol configured support supported"
).split()
# Counts that collocate with an acronym.
COUNT_WORDS = "two three dual multiple".split()
# Words of questions that answers need not repeat.
QUESTION_WORDS = (
    "what which when where how why does can under during value values used use using following according specified "
    "purpose true false none all above mentioned refer referred"
).split()


def tokens(text: Column) -> Column:
    """Lower-case words of a text: at least two of a-z, 0-9, _ and -, no stop words."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9_\-]{2,}"), F.lit(0)), lambda t: ~t.isin(STOPWORDS))


#: Bytes of tokens in lower case, others as 0.
_LOWER = np.zeros(256, np.uint8)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789_-":
    _LOWER[_c] = _LOWER[ord(chr(_c).upper())] = _c
#: The two letters outside ASCII that have one of a-z in their lower case.
_FOREIGN = {"\u212a": "k", "\u0130": "i\u0307"}


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts behind each other and where each begins, with the end of
    the last; a null text is empty."""
    large = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1] if len(large) else np.zeros(1, np.int64)
    held = large.buffers()[2]
    return np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held is not None and ends[-1] > ends[0] else np.zeros(0, np.uint8), ends - ends[0]


def runs(inside: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the longest runs of true bytes that lie in one text each."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[begins] = True
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before &= ~edge[:-1]
    after &= ~edge[1:]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def token_lists(texts: pa.Array) -> pa.ListArray:
    """``tokens`` of each text, cut out of the bytes of all of them at once."""
    for letter, lower in _FOREIGN.items():
        if pc.any(pc.match_substring(texts, letter)).as_py():
            texts = pc.replace_substring(texts, letter, lower)
    data, begins = joined_bytes(texts)
    low = _LOWER[data]
    start, end = runs(low > 0, begins)
    flat = pa.py_buffer(low[low > 0])
    found = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(end - start)])), flat]).cast(pa.string())
    kept = (end - start >= 2) & ~pc.is_in(found, value_set=pa.array(STOPWORDS)).to_numpy(zero_copy_only=False)
    ends = np.searchsorted(start[kept], begins)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found.filter(pa.array(kept)))


def is_text(column: pa.Array) -> bool:
    return pa.types.is_string(column.type) or pa.types.is_large_string(column.type)


def slices(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of consecutive rows with about ``most`` bytes of text at most."""
    size = sum((pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns if is_text(c)), np.zeros(len(batch), np.int64))
    part = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(batch)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(start, end - start)


# Stop words of the relational gate's own tokeniser.
GATE_STOPWORDS = "the and for that this with from when have been are was were will into but not you your our their its".split()


def gate_tokens(text: Column, most: int = 60) -> Column:
    """Distinct words of letters and digits of any script, 3 to 32 characters, in order."""
    parts = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\s]", " "), r"\s+")
    return F.slice(F.array_distinct(F.filter(parts, lambda t: F.length(t).between(3, 32) & ~t.isin(GATE_STOPWORDS))), 1, most)


def informative(text: Column) -> Column:
    """Distinct tokens of three characters or more that aren't words of questions."""
    return F.array_distinct(F.filter(tokens(text), lambda t: (F.length(t) >= 3) & ~t.isin(QUESTION_WORDS)))


def coverage(needle: Column, hay: Column) -> Column:
    """Share of the needle's informative tokens that the lower-case hay contains."""
    asked = informative(needle)
    found = F.filter(asked, lambda t: F.contains(F.lower(hay), t))
    return F.coalesce(F.size(found) / F.nullif(F.size(asked), F.lit(0)), F.lit(0.0))


def index_terms(text: Column) -> Column:
    """Runs of letters and digits in lower case, as the stemmed index cuts them."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}\p{Co}]+"), lambda t: t != "")


def fold(term: str) -> str:
    """The term without diacritics."""
    return "".join(c for c in unicodedata.normalize("NFD", term) if not unicodedata.combining(c))


# --- Porter's stemmer (M. F. Porter, "An algorithm for suffix stripping", 1980) ---


def _shape(word: str) -> str:
    """c or v for every letter; y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _short_end(stem: str) -> bool:
    return len(stem) >= 3 and _shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


# Suffixes of steps 2 to 4 and what replaces them.
_STEP2 = "ational:ate tional:tion enci:ence anci:ance izer:ize abli:able alli:al entli:ent eli:e ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble"
_STEP3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
_STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
_RULES2, _RULES3 = ([tuple(r.split(":")) for r in s.split()] for s in (_STEP2, _STEP3))
_RULES4 = [(s, "") for s in _STEP4.split()]


def _longest(word: str, rules: list[tuple[str, str]], least: int) -> str:
    fit = [r for r in rules if word.endswith(r[0])]
    if not fit:
        return word
    suffix, new = max(fit, key=lambda r: len(r[0]))
    stem = word[: len(word) - len(suffix)]
    if _measure(stem) <= least or (suffix == "ion" and stem[-1:] not in ("s", "t")):
        return word
    return stem + new


def stem(word: str) -> str:
    """Porter stem of a lower-case word; words under three letters stay."""
    if len(word) < 3:
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            base = word[: -len(suffix)]
            if word.endswith(suffix) and "v" in _shape(base):
                word = base
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif len(word) >= 2 and word[-1] == word[-2] and _shape(word)[-1] == "c" and word[-1] not in "lsz":
                    word = word[:-1]
                elif _measure(word) == 1 and _short_end(word):
                    word += "e"
                break
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _longest(word, _RULES2, 0)
    word = _longest(word, _RULES3, 0)
    word = _longest(word, _RULES4, 1)
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short_end(base)):
            word = base
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stems(word: Column) -> Column:
    """Folded Porter stems; meant for distinct words, joined back."""

    def run(words: pd.Series) -> pd.Series:
        return words.map(lambda w: None if w is None else stem(fold(w)))

    return F.pandas_udf(run, "string")(word)


def stemmed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, words) batches with the folded Porter stems of the words, each distinct word of a
    batch stemmed once; rows without words go."""
    known = lru_cache(1 << 17)(lambda w: stem(fold(w)))
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0)
        flat = batch.column(1).flatten().dictionary_encode()
        own = pa.array([known(w) for w in flat.dictionary.to_pylist()], pa.string()).take(flat.indices)
        ends = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes).cast(pa.int32())])
        out = pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, own)], names=["key", "terms"])
        yield out.filter(pc.greater(sizes, 0))
