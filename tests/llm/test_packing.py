import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from fixtures import awkward, documents, prose

from clausewell.llm import packing
from clausewell.llm.queries import tokenizer_path

TEXTS = ["Two  spaces", " lead", "trail ", "line \n next", "tab\tin word", "a\u00a0b \u00a0c", "<|endoftext|> in text", "x <|endoftext|>y", "don't we'll  I'm", "été çà ñ 日本 語", "123 4 56,7", "...!!! ??", "a b", "\n\n", " ", "e\u0301 combining"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def same(tokenizer, encoder, texts):
    ids, offsets, row = encoder.ids(pa.array(texts, pa.string()))
    assert sorted(row.tolist()) == list(range(len(texts)))
    for i, a, b in zip(row.tolist(), offsets.tolist(), offsets[1:].tolist(), strict=False):
        assert ids[a:b].tolist() == tokenizer.encode(texts[i], add_special_tokens=False).ids, repr(texts[i])


def test_chunks_encode_as_whole_texts(tokenizer, monkeypatch):
    encoder = packing.Encoder(tokenizer_path())
    assert encoder.fast
    r = random.Random(1)
    mixed = ["".join(r.choice(TEXTS + [" ", "\n", "word", " and"]) for _ in range(12)) for _ in range(400)]
    some = [chr(c) for c in [*range(1, 0x250), 0x3B1, 0x4E00, 0x1F600, 0x2009, 0x2028, 0x3000]]
    rare = ["".join(r.choice([*some, " ", " ", "a"]) for _ in range(40)) for _ in range(1500)]
    same(tokenizer, encoder, [*TEXTS, "", *mixed, prose(1, 300)])
    monkeypatch.setattr(packing, "AT_ONCE", 50)
    same(tokenizer, encoder, rare)
    same(tokenizer, encoder, [""])
    same(tokenizer, encoder, ["only  odd"])


def test_other_tokenizers_encode_whole_texts():
    from tokenizers import Tokenizer

    other = tokenizer_path("word_bpe_49k.json")
    encoder = packing.Encoder(other)
    assert encoder.fast is None
    same(Tokenizer.from_file(other), encoder, [*TEXTS, "Two words"])


def test_slices_of_texts():
    texts = pa.array(["aa", None, "b" * 50, "", "c", "dd"])
    parts = [(first, part.to_pylist()) for first, part in packing.text_slices(texts, 10)]
    assert parts == [(0, ["aa", ""]), (2, ["b" * 50]), (3, ["", "c", "dd"])]
    assert [x for _, part in packing.text_slices(texts.slice(2, 3), 3) for x in part.to_pylist()] == ["b" * 50, "", "c"]


def test_packing_round_trip(spark, tokenizer):
    texts = awkward() + [(100 + i, prose(i, random.Random(i).randint(1, 900))) for i in range(120)] + [(300 + i, t) for i, t in enumerate(TEXTS)]
    rows = packing.pack_documents(documents(spark, texts), tokenizer_path()).collect()
    ids = defaultdict(list)
    for i, t in texts:
        ids[i].append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4"))
    seen, fill = defaultdict(list), defaultdict(list)
    for r in rows:
        seen[r["doc_id"]].append(r)
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(seen) == set(ids)
    for i, parts in seen.items():
        a = ids[i][0]
        assert sum(p["length"] for p in parts) == sum(map(len, ids[i]))
        for p in parts:
            assert zlib.crc32(a[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
            assert p["length"] == 1024 or p["piece"] == 0
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in rows)
    assert len(fill) <= -(-total // 1024) + 2
    assert packing.pack_documents(documents(spark, []), tokenizer_path()).count() == 0


def test_bounded_space_closes_the_fullest():
    packer = packing.Packer(10, 2)
    assert [packer.put(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # the bin of 7 closed
    assert packer.put(4) == (0, 6) and packer.put(2) == (2, 8) and packer.put(3) == (3, 0)


def test_pieces_of_one_id_are_dealt_over_tasks(spark):
    same = [(i, 0, 0, 700, 5) for i in [None] * 900 + [7] * 600] + [(i, 0, 0, 300, i) for i in range(1500)]
    cut = spark.createDataFrame(same, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    rows = packing.pack(cut, pieces_per_task=500).collect()
    assert sorted(map(str, (tuple(r)[:5] for r in rows))) == sorted(map(str, same))
    tasks = defaultdict(int)
    for r in rows:
        tasks[r["sequence_id"] >> 40] += 1
    assert len(tasks) == 6 and max(tasks.values()) <= 600
    fill = defaultdict(int)
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 1024 and len(fill) <= 1.1 * sum(fill.values()) / 1000
