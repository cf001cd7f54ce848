"""Packing of token sequences by bounded-space online best-fit.

Documents are tokenised whole, closed by an end token and cut into pieces of at
most ``capacity`` tokens: all but the first piece are full.  Pieces are dealt over
tasks evenly, whatever their ids, and arrive by falling length.  A task keeps a fixed number of open
bins, one bit of a bitset for each amount of free space that some open bin has; a
piece goes into the bin that it fills best, found by a shift and the lowest set
bit.  When too many bins are open, the fullest closes first.

Texts are cut at spaces in Arrow, and each distinct chunk of a slice is encoded once:
between two characters that are no white space, a single space always begins a new
pre-token of a byte-level BPE, so ids of the chunks are the ids of the text.  Texts
where that doesn't hold (double spaces, white space beside a space, a special token's
own string) are encoded whole.  ``Encoder`` reads from the tokenizer's file whether it
is such a BPE; any other tokenizer encodes all texts whole.

Edge cases: null reads as empty; an empty text is the end token alone; repeated
rows and rows without an id are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import materialize, release_memory

CAPACITY = 1024
#: Bytes of text whose chunks are held at once (more only for a single longer text).
SLICE_BYTES = 4 << 20
#: Characters of the distinct chunks that go to the tokenizer in one string.
AT_ONCE = 1 << 16
#: Up to here the classes of characters are the same in every version of Unicode, so
#: that two libraries cut alike.
SETTLED = "^[\\x{1}-\\x{24F}]*$"
#: Letters and numbers of that range.  A library that copies its pattern for each thread
#: holds a hundred megabytes of the classes of all Unicode, but hardly any of these.
LETTERS, NUMBERS = r"A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}", r"0-9\x{B2}\x{B3}\x{B9}\x{BC}-\x{BE}"
#: How byte-level BPE cuts texts of such characters into pre-tokens.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others from U+0100 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks_of(path: str) -> dict[bytes, int] | None:
    """Bytes -> id of a plain byte-level BPE whose ids follow its merges; else None."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or cut.get("use_regex") is False:
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    symbols, vocab = byte_symbols(), model["vocab"]
    merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    if any(b <= a for a, b in zip(merged, merged[1:], strict=False)) or any(c not in symbols for t in vocab if t not in special for c in t):
        return None
    return {bytes(symbols[c] for c in t): i for t, i in vocab.items() if t not in special}


class Encoder:
    """Ids of whole texts, the same as the tokenizer's own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = ranks_of(path)
        self.fast = None
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding("from-file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            #: Of each id: does it begin with a space?
            self.led = np.zeros(max(ranks.values()) + 1, dtype=bool)
            self.led[[i for t, i in ranks.items() if t[:1] == b" "]] = True

    def one(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def settled(self, texts: pa.Array) -> np.ndarray:
        fine = pc.match_substring_regex(texts, SETTLED)
        for s in self.special:
            fine = pc.and_not(fine, pc.match_substring(texts, s))
        return fine.to_numpy(zero_copy_only=False)

    def whole(self, texts: pa.Array) -> list[list[int]]:
        fine = self.settled(texts) if self.fast else np.zeros(len(texts), dtype=bool)
        return [self.fast.encode_ordinary(t) if ok else self.one(t) for t, ok in zip(texts.to_pylist(), fine, strict=True)]

    def chunks(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size) of distinct chunks, a space before each; none holds a space
        or has white space at an end, so in a string of many each is told by its space."""
        fine = self.settled(distinct)
        at, words = np.flatnonzero(fine), distinct.filter(pa.array(fine)).to_pylist()
        till = np.cumsum([len(w) for w in words])
        cuts = np.searchsorted(till, np.arange(0, till[-1] if len(till) else 0, AT_ONCE)).tolist() + [len(words)]
        coded = [self.fast.encode_to_numpy(" " + " ".join(words[low:high])) for low, high in zip(cuts, cuts[1:], strict=False) if high > low]
        rest = np.flatnonzero(~fine)
        odd = [self.one(" " + w) for w in distinct.take(pa.array(rest)).to_pylist()]
        pool = np.concatenate([np.zeros(0, np.uint32), *coded])
        start = np.empty(len(distinct), dtype=np.int64)
        size = np.empty(len(distinct), dtype=np.int64)
        start[at] = np.flatnonzero(self.led[pool])
        size[at] = np.diff(start[at], append=len(pool))
        more, ends = _pooled(odd)
        start[rest], size[rest] = len(pool) + ends[:-1], np.diff(ends)
        return np.concatenate([pool, more]), start, size

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets, row) of a slice's texts, in an order of their own."""
        if not self.fast:
            return *_pooled(self.whole(texts)), np.arange(len(texts))
        cut = pc.split_pattern(texts, " ")
        where = cut.offsets.to_numpy()
        own = cut.flatten()
        sound = pc.and_(pc.equal(own, pc.utf8_trim_whitespace(own)), pc.greater(pc.binary_length(own), 0)).to_numpy(zero_copy_only=False)
        odd = np.zeros(len(texts), dtype=bool)
        for s in self.special:
            odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        odd |= np.add.reduceat(~sound, where[:-1]) > 0
        good = np.flatnonzero(~odd)
        bad = np.flatnonzero(odd)
        led = np.ones(len(own), dtype=bool)
        led[where[:-1]] = False
        row = np.repeat(np.arange(len(texts)), np.diff(where))
        used = np.flatnonzero(led & ~odd[row])
        coded = own.take(pa.array(used)).dictionary_encode()
        pool, start, size = self.chunks(coded.dictionary)
        first, at = _pooled(self.whole(own.take(pa.array(where[:-1][good]))))
        start, size = np.concatenate([start, len(pool) + at[:-1]]), np.concatenate([size, np.diff(at)])
        pool = np.concatenate([pool, first])
        which = np.empty(len(own), dtype=np.int64)
        which[used] = coded.indices.to_numpy()
        which[where[:-1][good]] = len(coded.dictionary) + np.arange(len(good))
        which = which[~odd[row]]
        start, size = start[which], size[which]
        ends = np.cumsum(size)
        ids = pool[np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(np.diff(where)[good])])]
        more, at = _pooled(self.whole(texts.take(pa.array(bad))))
        return np.concatenate([ids, more]), np.concatenate([offsets, offsets[-1] + at[1:]]), np.concatenate([good, bad])


def _pooled(parts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one array and the bounds of each."""
    ends = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    return np.fromiter(chain.from_iterable(parts), np.uint32, ends[-1]), ends


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of consecutive rows of about ``limit`` bytes; null is empty."""
    column = pc.fill_null(column.cast(pa.string()), "")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + limit, side="right")))
        yield first, column.slice(first, last - first)
        first = last


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file: read once, not for every task."""
    if path not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut_pieces(ids: np.ndarray, offsets: np.ndarray, end_id: int, capacity: int) -> tuple[np.ndarray, ...]:
    """(text, piece, start, length, crc32) of texts' ids, each closed by the end id."""
    texts = len(offsets) - 1
    closed = np.full(len(ids) + texts, end_id, dtype="<u4")
    closed[np.arange(len(ids)) + np.repeat(np.arange(texts), np.diff(offsets))] = ids
    n = np.diff(offsets) + 1
    count = (n + capacity - 1) // capacity
    first = np.cumsum(count) - count
    text = np.repeat(np.arange(texts), count)
    piece = np.arange(len(text)) - first[text]
    head = n - (count - 1) * capacity
    start = np.where(piece == 0, 0, head[text] + (piece - 1) * capacity)
    length = np.where(piece == 0, head[text], capacity)
    begin = (offsets[:-1] + np.arange(texts))[text] + start
    data = memoryview(closed.tobytes())
    crc = np.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)], dtype=np.int64)
    return text, piece, start, length, crc


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        coder = encoder(tokenizer_path)
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                ids, offsets, row = coder.ids(texts)
                text, piece, start, length, crc = cut_pieces(ids, offsets, end_id, capacity)
                own = batch.column(0).take(pa.array(first + row[text]))
                yield pa.RecordBatch.from_arrays([own, pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint")


class Packer:
    """Online best-fit with at most ``most`` open bins."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.free, self.opened, self.count = 0, 0, 0

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) of the next piece."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            bin_no = self._take(space)
        else:
            if self.opened >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            space, bin_no = self.capacity, self.count
            self.count += 1
        if left := space - length:
            self.bins[left].append(bin_no)
            self.free |= 1 << left
            self.opened += 1
        return bin_no, self.capacity - space

    def _take(self, space: int) -> int:
        bin_no = self.bins[space].pop()
        if not self.bins[space]:
            self.free &= ~(1 << space)
        self.opened -= 1
        return bin_no


def pack(cut: DataFrame, capacity: int = CAPACITY, open_bins: int = 65_536, pieces_per_task: int = 200_000) -> DataFrame:
    """Add sequence_id and offset to pieces; ``cut`` is read more than once."""
    tasks = max(1, -(-cut.count() // pieces_per_task))
    # In turns: of an id, or none, that a third of all pieces have, each task gets its share.
    dealt = cut.repartition(tasks).sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base = Packer(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [packer.put(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([base + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())], names=[*batch.schema.names, "sequence_id", "offset"])

    return dealt.mapInArrow(run, f"{kinds}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, **columns: str) -> DataFrame:
    return pack(materialize(pieces(docs, tokenizer_path, **columns), "pieces"))
