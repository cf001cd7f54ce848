"""Byte-pair encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no token of the vocabulary can't end up inside a token:
between its two bytes lies a certain cut.  Merges on either side of a cut never see each
other, so the fragments between cuts are encoded independently and their ids joined.
Most ends of words are such cuts already; what is left are the ends of pre-tokens whose
pair does occur inside a token (a contraction, a run of white space):

1. Of a slice of texts all byte pairs are looked up at once; the rest between two cuts is
   a fragment.  A fragment of one kind of characters (letters, digits, signs), led by a
   space or not, holds no end of a pre-token.
2. Any other fragment is in doubt.  Texts always may be cut where a space follows a
   letter, digit or sign; the chunk between two such places that holds a doubtful pair is
   cut by the tokenizer's own pre-tokenizer, each distinct chunk once.
3. Each distinct fragment of a slice is merged once, by rank, through ``tiktoken`` if ids
   follow merges, else with a heap, so that a long run of one character costs n log n.
   A worker remembers fragments, up to a bound.

Ids travel as binary: little-endian unsigned 32-bit integers.  ``decode`` joins the bytes
of tokens and reads them as UTF-8.

Edge cases: null reads as empty, an empty text has no ids; a special token's own string
in a text is that token, as in the tokenizer's library; very long texts are one slice of
their own; repeated rows are encoded each; an empty table gives no rows; all other columns
but the id's are ignored by ``encode`` and kept by ``decode``; ids beyond the vocabulary
decode to nothing, broken UTF-8 to U+FFFD.  A tokenizer that is no plain byte-level BPE is
refused.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import release_memory
from .packing import byte_symbols, ranks_of
from .textbits import slices

#: Fragments that a worker remembers.
REMEMBERED = 400_000
LETTER, DIGIT, SIGN, SPACE, UNKNOWN = range(5)


def _kinds() -> np.ndarray:
    """Of each byte: ASCII letters, digits, signs, white space, and all else."""
    kind = np.full(256, UNKNOWN, dtype=np.uint8)
    kind[0x21:0x7F] = SIGN
    kind[0x30:0x3A] = DIGIT
    kind[0x41:0x5B] = kind[0x61:0x7B] = LETTER
    kind[[0x20, *range(0x09, 0x0E)]] = SPACE
    return kind


KIND = _kinds()


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or odd or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or cut.get("use_regex") is False:
            raise ValueError(f"{path} is no plain byte-level BPE")
        added = spec.get("added_tokens", [])
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens that take in what is beside them")
        symbols, vocab = byte_symbols(), model["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in added}
        tokens = {i: bytes(symbols[c] for c in t) for t, i in vocab.items() if t.encode() not in self.special}
        self.byte_id = [vocab[c] for c, _ in sorted(symbols.items(), key=lambda x: x[1])]
        self.merges = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        #: inside[a, b]: does some token hold byte a right before byte b?
        self.inside = np.zeros(1 << 16, dtype=bool)
        for t in tokens.values():
            both = np.frombuffer(t, np.uint8).astype(np.int64)
            self.inside[both[:-1] << 8 | both[1:]] = True
        tokens |= {i: t for t, i in self.special.items()}
        self.size = np.zeros(max(tokens) + 1, dtype=np.int64)
        self.size[list(tokens)] = [len(t) for t in tokens.values()]
        self.pool = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)
        self.first = np.cumsum(self.size) - self.size
        self.pattern = re.compile(b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.pre_tokenizer = Tokenizer.from_file(path).pre_tokenizer
        self.known: dict[bytes, list[int]] = {}
        self.merge = self.merged
        if ranks := ranks_of(path):  # ids follow merges: then a library merges by ids
            import tiktoken

            self.merge = tiktoken.Encoding("from-file", pat_str=".", mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def cuts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the fragments of a slice begin, and its end."""
        n = len(raw)
        cut = np.zeros(n + 1, dtype=bool)
        cut[offsets] = True
        cut[1:n] |= ~self.inside[raw[:-1].astype(np.uint16) << np.uint16(8) | raw[1:]]
        kind = KIND[raw]
        lead = np.flatnonzero((raw >= 0xC3) & (raw <= 0xC8))  # U+00C0 to U+023F: letters but for two signs
        lead = lead[(raw[lead] != 0xC3) | ((raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7))]
        kind[lead] = kind[lead + 1] = LETTER
        plain = kind[1:] < SPACE
        sound = plain & ((kind[1:] == kind[:-1]) | (raw[:-1] == 0x20)) | ((raw[1:] & 0xC0) == 0x80)
        doubt = np.zeros(n + 1, dtype=bool)
        doubt[1:n] = ~(sound | cut[1:n])
        begins = np.zeros(n + 1, dtype=bool)
        begins[offsets] = True
        begins[1:n] |= (raw[1:] == 0x20) & (kind[:-1] < SPACE)
        for a, b in self._specials(raw, offsets):
            cut[a + 1 : b] = doubt[a : b + 1] = begins[a + 1 : b] = False
            cut[[a, b]] = begins[[a, b]] = True
        places = np.flatnonzero(doubt)
        if len(places):
            start = np.flatnonzero(begins)
            which = np.unique(np.searchsorted(start, places, side="right") - 1)
            chunks = _parts(raw, start).take(pa.array(which)).dictionary_encode()
            bounds = [self._pre_tokens(c) for c in chunks.dictionary.to_pylist()]
            ends = np.cumsum([len(b) for b in bounds])
            index = chunks.indices.to_numpy()
            size = np.array([len(b) for b in bounds])[index]
            at = np.repeat(ends[index] - np.cumsum(size), size) + np.arange(size.sum())
            cut[np.repeat(start[which], size) + np.concatenate(bounds)[at]] = True
        cut[n] = True
        return np.flatnonzero(cut)

    def _specials(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        if self.pattern is None:
            return
        data, at = raw.tobytes(), 0
        while m := self.pattern.search(data, at):
            a, b = m.span()
            if offsets[np.searchsorted(offsets, a, side="right")] >= b:
                yield a, b
                at = b
            else:  # it begins in one text and ends in another
                at = a + 1

    def _pre_tokens(self, chunk: bytes) -> np.ndarray:
        """Where the pre-tokens of a chunk end; each has a symbol for each byte."""
        return np.cumsum([len(t) for t, _ in self.pre_tokenizer.pre_tokenize_str(chunk.decode())])

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a fragment: the pair of least rank is merged first, from the left."""
        ids: list[int] = [self.byte_id[b] for b in piece]
        last = len(ids) - 1
        after, before = list(range(1, last + 2)), list(range(-1, last))
        get = self.merges.get
        heap = [(found[0], i, found[1], ids[i], ids[i + 1]) for i in range(last) if (found := get(ids[i] << 32 | ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j > last or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k <= last:
                before[k] = i
                if found := get(new << 32 | ids[k]):
                    heapq.heappush(heap, (found[0], i, found[1], new, ids[k]))
            if (p := before[i]) >= 0 and (found := get(ids[p] << 32 | new)):
                heapq.heappush(heap, (found[0], p, found[1], ids[p], new))
        return [x for x in ids if x >= 0]

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds of each text's ids) of a slice."""
        if not len(raw):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        cuts = self.cuts(raw, offsets)
        fragments = _parts(raw, cuts).dictionary_encode()
        distinct = []
        for piece in fragments.dictionary.to_pylist():
            ids = self.known.get(piece)
            if ids is None:
                ids = [self.special[piece]] if piece in self.special else self.merge(piece)
                if len(piece) <= 64:
                    if len(self.known) >= REMEMBERED:
                        self.known.clear()
                    self.known[piece] = ids
            distinct.append(ids)
        size = np.array([len(d) for d in distinct], dtype=np.int64)
        pool = np.fromiter((x for d in distinct for x in d), "<u4", int(size.sum()))
        which = fragments.indices.to_numpy()
        start, size = (np.cumsum(size) - size)[which], size[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = pool[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(cuts, offsets)]

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[ids < len(self.size)].astype(np.int64)
        size = self.size[ids]
        return self.pool[np.repeat(self.first[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())].tobytes().decode("utf-8", "replace")


def _parts(raw: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes between each two cuts."""
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a file: read once, not for every task."""
    if path not in _CODECS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids binary) of every row's whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        coder = codec(tokenizer_path)
        for batch in batches:
            for first, raw, offsets in slices(batch.column(1)):
                ids, ends = coder.encode(raw, offsets)
                coded = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(ends) - 1), coded], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, ids binary")


def decode(coded: DataFrame, tokenizer_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the text of its ids as column ``out``; null ids give null."""
    if out in coded.columns:
        raise ValueError(f"there is a column {out} already")
    at = coded.columns.index(ids_col)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        coder = codec(tokenizer_path)
        for batch in batches:
            texts = [None if x is None else coder.decode(np.frombuffer(x, "<u4")) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return coded.mapInArrow(run, f"{kinds}, `{out}` string")
