import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from fixtures import awkward
from pyspark.sql import functions as F

from clausewell.llm import merkle, queries

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, idx int, digest string, level int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(digests):
    """All levels, leaves first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_path(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 3 * 3
        out.append((level[first:i], level[i + 1 : first + 3]))
        i //= 3
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, text, lang, source, n_chars)."""
    by = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = H(*map(encoded, (doc_id, source, lang, n_chars, text)))
        check = leaf
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            check = H(*map(encoded, (doc_id, source, lang, n_chars, text.replace("\n", ""))))
        by.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, check, doc_id))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(by[s]) for s in order}
    levels = {s: plain_tree([r[2] for r in trees[s]]) for s in order}
    top = plain_tree([levels[s][-1][0] for s in order])
    out = []
    for no, s in enumerate(order):
        for i, (_, _, leaf, check, doc_id) in enumerate(trees[s]):
            path = plain_path(levels[s], i) + plain_path(top, no)
            fold = check
            for before, after in path:
                fold = H(*before, fold, *after)
            out.append((doc_id, leaf, levels[s][-1][0], top[-1][0], H(*[d for a, b in path for d in (*a, *b)]), fold, fold == top[-1][0]))
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


def some(n, seed, sources):
    r = random.Random(seed)
    return [(r.randrange(n), r.choice(["a\nb", "", None, "日本\n", "plain", f"t{r.random()}\n"]), r.choice([None, "en"]), r.choice(sources), r.choice([None, 3])) for _ in range(n)]


CASES = {
    "awkward": [(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t)) for i, t in awkward()],
    "one": [(5, "a\n", None, None, 1)],
    "one source": some(10, 1, ["s"]),
    "hot source": some(700, 2, ["hot"] * 5 + [None, "é", "z", "Z", ""]),
    "many sources": some(120, 3, [f"s{i}" for i in range(90)]),
    "equal rows": [(7, "same\n", "en", "s", 5)] * 40 + [(None, None, None, None, None)] * 31,
}


@pytest.mark.parametrize(("case", "levels"), [("awkward", 9), ("one", 9), ("one source", 9), ("equal rows", 9), ("hot source", 2), ("many sources", 2), ("hot source", 9)])
def test_query_against_a_plain_tree(spark, tmp_path, monkeypatch, case, levels):
    for f in (merkle.build, merkle.prove):
        monkeypatch.setattr(f, "__defaults__", (*f.__defaults__[:-1], levels))
    table(spark, CASES[case]).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_merkle(spark, str(tmp_path))
    assert dict(got.dtypes) == {c: "string" for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")} | {"doc_id": "bigint", "verified": "boolean"}
    want = sorted(plain(CASES[case]), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    rows = con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES['op13_merkle']})")
    assert sorted(rows.fetchall(), key=str) == want


def test_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op13_merkle(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("levels", [2, 9])
def test_some_leaves_are_proved_by_themselves(spark, levels):
    rows = CASES["hot source"]
    values = [F.col(c) for c in merkle.HASHED]
    manifest = merkle.build(table(spark, rows).select("doc_id", "source", merkle.leaf_of(values).alias("digest")), levels=levels)
    asked = manifest.leaves.where("doc_id % 7 = 0").select("doc_id", "tree", "idx", "n", F.col("digest").alias("leaf"), F.col("digest").alias("check"))
    got = merkle.prove(manifest, asked, levels).collect()
    want = {(r[0], r[1], r[4]) for r in plain(rows)}
    assert len(got) == sum(1 for r in rows if r[0] % 7 == 0) > 50
    assert all((r["doc_id"], r["leaf"], r["proof_sha256"]) in want for r in got)
    assert {r["folded_root"] for r in got} == {manifest.trees.first()["root"]}


def test_missing_is_minimal():
    r = random.Random(4)
    for n in [1, 2, 3, 4, 9, 10, 27, 28, 100]:
        sizes = merkle.level_sizes(n)
        for _ in range(20):
            asked = sorted(r.sample(range(n), r.randint(1, n)))
            got = {(level, i) for level, need in enumerate(merkle.missing(np.array(asked), n)) for i in need.tolist()}
            needed, derived = set(), {(0, i) for i in asked}
            for level in range(len(sizes) - 1):
                for up in {i // 3 for at, i in derived if at == level}:
                    derived.add((level + 1, up))
            for i in asked:
                for level, at, run in merkle.walk(i, n):
                    needed |= {(level, j) for j in run if j != at}
            assert got == needed - derived
