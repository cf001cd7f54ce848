import random
import re
import zlib
from collections import Counter

import pytest
from fixtures import awkward, documents

from clausewell.llm import queries, variants


def edits(word, letters):
    parts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in parts if b} | {a + c + b for a, b in parts for c in letters} | {a + c + b[1:] for a, b in parts if b for c in letters}
    return out - {word}


def plain(rows):
    """(word, form, root, n, n_near, form_n) by trying every edit of every word."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    return grouped(words)


def grouped(words):
    letters = sorted({c for w in words for c in w})
    near = {w: [x for x in edits(w, letters) if x in words] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def vocabulary(seed, n, letters="abcé"):
    """Words with many near ones, some alike but for one end."""
    r = random.Random(seed)
    out = {}
    while len(out) < n:
        w = "".join(r.choice(letters) for _ in range(r.choice([7, 7, 8, 9, 12, 30])))
        for x in {w, *r.sample(sorted(edits(w, letters)), 3)}:
            if len(x) >= 7:
                out[x] = 2 + int(r.paretovariate(0.5)) % 5000
    return out


@pytest.mark.parametrize(("short_list", "list_words"), [(64, 2000), (2, 5), (10**9, 10**9), (0, 1)])
def test_against_every_edit(spark, short_list, list_words):
    words = vocabulary(1, 3000) | {"a" * k: 3 * 40 ** (k % 4) for k in range(7, 15)} | {"aaaaaaa" + c: 5 for c in "bcdefgh"}
    df = spark.createDataFrame(sorted(words.items()), "word string, n bigint").repartition(4)
    got = variants.group_variants(df, short_list=short_list, list_words=list_words).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == grouped(words)


def test_an_edit_changes_no_more_grams_than_its_bound():
    r = random.Random(2)
    words = vocabulary(3, 400)
    for frequent in ({}, {w[i : i + q]: 99 for w in list(words)[:200] for i in range(len(w)) for q in (2, 3) if r.random() < 0.7}):
        for w in words:
            grams, most = variants.decomposed(w, frequent)
            assert most <= 4 and len(grams) == len(w) - 1
            for x in r.sample(sorted(edits(w, "abcé")), 10):
                if len(x) < 2:
                    continue
                other, _ = variants.decomposed(x, frequent)
                step = len(x) - len(w)
                held = sum(g in [other[p] if p < len(other) else None, other[p + step] if 0 <= p + step < len(other) else None] for p, g in enumerate(grams))
                assert held >= len(grams) - most


def test_query(spark, tmp_path):
    r = random.Random(5)
    names = ["Municipality", "municipalité", "Ärzteschaft", "ÄRZTESCHAFT", "grössere", "colour×ful", "parliament", "parlament", "international", "short"]
    rows = [*awkward(), *((i, " ".join(r.choice(names[: 3 + i % 8]) for _ in range(60))) for i in range(100, 400)), (None, "municipality municipality")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_variants(spark, str(tmp_path))
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    want = plain(rows)
    assert sorted(map(tuple, got.collect())) == want
    assert any(f for _, f, *_ in want)


def test_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op11_variants(spark, str(tmp_path)).collect() == []
