import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from fixtures import awkward, documents, prose

from clausewell.llm import bpe
from clausewell.llm.queries import tokenizer_path
from clausewell.llm.textbits import slices

TEXTS = ["", " ", "  ", "Two  spaces", " lead", "trail ", "line \n next", "tab\tin word", "a b  c", "   b", "<|endoftext|> in text", "x <|endoftext|>y", "<|endoftext|><|endoftext|>", "<|endoftext", "|>", "don't we'll  I'm", "!'s it's 's ''s", "été çà ñ 日本 語", "×÷ 5×3", "123 4 56,7", "...!!! ??", "a b", "\n\n", "é combining", "\x00\x1c\x85 \x0b", "x" * 500, " " * 300 + "a", "\U000f0000 \U000f0000", "ªºµ"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def coded(codec, texts, limit=2 << 20):
    out = []
    for _, raw, offsets in slices(pa.array(texts, pa.string()), limit):
        ids, ends = codec.encode(raw, offsets)
        out += [ids[a:b].tolist() for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)]
    return out


def test_fragments_encode_and_decode_as_the_library_does(tokenizer):
    r = random.Random(3)
    some = [chr(c) for c in [*range(0, 0x260), 0x3B1, 0x4E00, 0x1F600, 0x2009, 0x2028, 0x3000, 0xE0001]]
    mixed = ["".join(r.choice(TEXTS + [" ", "\n", "word", " and", "'"]) for _ in range(10)) for _ in range(500)]
    rare = ["".join(r.choice([*some, " ", " ", "a", "'", "s"]) for _ in range(40)) for _ in range(3000)]
    texts = [*TEXTS, *mixed, *rare, prose(1, 300)]
    codec = bpe.Codec(tokenizer_path())
    for limit, merge in ((2 << 20, codec.merge), (300, codec.merge), (2 << 20, codec.merged)):
        codec.merge, codec.known = merge, {}
        for text, ids in zip(texts, coded(codec, texts, limit), strict=True):
            assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
            assert codec.decode(np.array(ids, "<u4")) == tokenizer.decode(ids, skip_special_tokens=False) == text
    odd = [[r.randrange(50257) for _ in range(30)] for _ in range(300)]
    for ids in odd:  # pieces of characters
        assert codec.decode(np.array(ids, "<u4")) == tokenizer.decode(ids, skip_special_tokens=False)


def test_cuts_lie_at_pairs_that_no_token_holds(tokenizer):
    codec = bpe.Codec(tokenizer_path())
    vocabulary = [t for i in range(50256) for t in [codec.pool[codec.first[i] : codec.first[i] + codec.size[i]].tobytes()]]
    assert all(codec.inside[a << 8 | b] for t in vocabulary for a, b in zip(t, t[1:], strict=False))
    text = "Words, 12 and more\nlines"
    raw = np.frombuffer(text.encode(), np.uint8)
    cuts = codec.cuts(raw, np.array([0, len(raw)])).tolist()
    assert [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)] == ["Words", ",", " 12", " and", " more", "\n", "lines"]


def test_long_runs_are_not_quadratic(tokenizer):
    codec = bpe.Codec(tokenizer_path())
    text = "ab" * 100_000 + "=" * 100_000 + " " * 100_000
    for codec.merge in (codec.merge, codec.merged):
        assert coded(codec, [text])[0] == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Codec(tokenizer_path("word_bpe_49k.json"))


def test_query(spark, tokenizer, tmp_path):
    from clausewell.llm import queries

    rows = [*awkward(), (20, "x <|endoftext|>  y"), (21, "don't  stop\n\n")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_bpe(spark, str(tmp_path))
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    want = []
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert bpe.encode(documents(spark, rows).where("false"), tokenizer_path()).count() == 0
    empty = bpe.decode(spark.createDataFrame([(1, None), (2, bytearray())], "k int, ids binary"), tokenizer_path())
    assert sorted(map(tuple, empty.select("k", "decoded").collect())) == [(1, None), (2, "")]
