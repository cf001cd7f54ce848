"""Queries that SQL can't express, against plain Python over the same tables."""

import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
import regex
import xxhash

from clausewell.functions import words
from clausewell.operators import ladder, vectors
from clausewell.operators.postings import CLAUSE_WEIGHTS
from clausewell.plans import catalog, parsing_queries as P, planner, retrieval_queries as R
from clausewell.plans.corpus import CLAUSES, clauses, questions
from clausewell.sources.tables import table

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


def tokens(text):
    return [w for w in re.findall(r"[a-z0-9_\-]{2,}", text.lower()) if w not in words.STOPWORDS]


def stems(text):
    return [words.stem(words.fold(w)) for w in regex.split(r"[^\p{L}\p{N}\p{Co}]+", text.lower()) if w]


# --- the planner ---


def plain_tiers(text, glossary):
    """Tiers of groups, each a set of units; ``glossary``: [(acronym, expansion, aliases)]."""
    sequence = tokens(text)
    known = list(dict.fromkeys(sequence))[:40]
    stands_for = {a.lower(): [x.lower() for x in [e, *(more or [])]] for a, e, more in glossary}
    bridges = Counter(w for t in known for w in {w for e in stands_for.get(t, []) for w in tokens(e)})
    spelled = {}
    for acronym, expansion, _ in glossary:
        if len(tokens(expansion)) > 1 and " ".join(tokens(expansion)) in " ".join(known):
            spelled[tokens(expansion)[0]] = acronym.lower()

    def group(t):
        bases = [t, *(w for w in t.split("-") if "-" in t and len(w) > 1 and w not in words.STOPWORDS)]
        found = {*bases, *(e for b in bases for e in stands_for.get(b, []))}
        found |= {w for b in bases for e in stands_for.get(b, []) for w in tokens(e) if len(w) > 5 and w not in words.GENERIC_TOKENS and bridges[w] < 2}
        found |= {spelled[t]} if t in spelled else set()
        found |= {f"{c} {t}" for c in known if c in words.COUNT_WORDS and t in stands_for}
        return frozenset(" ".join(tokens(x)) for x in found) - {""}

    pairs = [f"{a} {b}" for a, b in zip(sequence, sequence[1:]) if a != b and not {a, b} & set(words.GENERIC_TOKENS) and not (a in stands_for and b in stands_for)]
    telling = [t for t in known if t not in words.GENERIC_TOKENS]
    tiers = [[frozenset([p]) for p in pairs] + [group(t) for t in telling if t not in " ".join(pairs).split(" ")]] if pairs else []
    tiers += [[group(t) for t in known], [group(t) for t in telling], [frozenset(known)]]
    return [t for i, t in enumerate(tiers) if t and t != [frozenset()] and t not in tiers[:i]]


def plain_rows(asked, glossary):
    return {(q, t, t == len(tiers) - 1, g, unit) for q, text in asked for tiers in [plain_tiers(text, glossary)] for t, groups in enumerate(tiers) for g, units in enumerate(groups) for unit in units}


NATIONS = "SELECT upper(substr(n_name, 1, 3)) AS acronym, arg_max(n_name, n_nationkey) AS expansion FROM nation GROUP BY 1 ORDER BY max(n_nationkey)"


def nations():
    con = duckdb.connect()
    con.sql(f"CREATE VIEW nation AS SELECT * FROM '{FOLDER}/nation.parquet'")
    return [(a, e, None) for a, e in con.sql(NATIONS).fetchall()]


@needs_tables
def test_planner_rows(spark):
    asked = [(r["qid"], r["text"]) for r in questions(spark, FOLDER).collect()]
    got = [tuple(r[c] for c in ("qid", "tier", "is_floor", "group_no", "unit")) for r in catalog.QUERIES["planner_rows"](spark, FOLDER).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_rows(asked, nations())


def test_plans_of_many_queries(spark):
    glossary = [("CA", "Carrier Aggregation", ["carrieragg"]), ("BWP", "bandwidth part", None), ("DC", "dual carrier connectivity", None), ("CSI", "channel state information", None), ("BW", "bandwidth part", None)]
    pool = "ca bwp dc csi csi-rs two dual bandwidth part carrier aggregation the of uplink slot beam rs-srs channel state information timing".split()
    draw = random.Random(5)
    asked = [(i, " ".join(draw.choices(pool, k=draw.randint(0, 9)))) for i in range(400)]
    asked += [(400, " ".join(f"w{i}" for i in range(60))), (401, "?!"), (402, "uplink")]
    rows = planner.plan(spark.createDataFrame(asked, "qid bigint, text string"), planner.Glossary.of(glossary)).collect()
    assert {(r["qid"], r["tier"], r["is_floor"], r["group_no"], " ".join(r["terms"])) for r in rows} == plain_rows(asked, glossary)


# --- BM25, ladders ---


def plain_scores(docs, weights, units):
    """unit -> {id: BM25}; ``docs``: {id: {column: tokens}}."""
    sizes = {len(u.split(" ")) for u in units}
    tf, length = defaultdict(Counter), {i: sum(len(d[c]) for c in weights) for i, d in docs.items()}
    for i, d in docs.items():
        for c, w in weights.items():
            for n in sizes:
                for at in range(len(d[c]) - n + 1):
                    unit = " ".join(d[c][at : at + n])
                    if unit in units:
                        tf[unit][i] += w
    mean = sum(length.values()) / len(docs)
    out = {}
    for unit, found in tf.items():
        idf = math.log((len(docs) - len(found) + 0.5) / (len(found) + 0.5))
        idf = idf if idf > 0 else 1e-6
        out[unit] = {i: idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * length[i] / mean)) for i, f in found.items()}
    return out


def plain_walk(tiers):
    """[(id, is_floor)] of [(is_floor, ids in order)]."""
    taken = {}
    for is_floor, ids in tiers:
        new = list(dict.fromkeys(i for i in ids if i not in taken))
        new = new if is_floor else new[: ladder.TIER_CAP]
        taken.update(dict.fromkeys(new[: ladder.CANDIDATES - len(taken)], is_floor))
    return list(taken.items())


def plain_ladder(plan, docs, weights, fetch, owner=lambda i: i):
    """[(qid, id, is_floor, rank)] of plan rows (qid, tier, is_floor, group_no, unit)."""
    scores = plain_scores(docs, weights, {r[4] for r in plan})
    by_tier = defaultdict(lambda: defaultdict(set))
    for q, t, floor, g, unit in plan:
        by_tier[q, t, floor][g].add(unit)
    lists = defaultdict(list)
    for (q, _, floor), groups in sorted(by_tier.items()):
        met = set.intersection(*({i for u in units for i in scores.get(u, {})} for units in groups.values()))
        total = {i: sum(scores.get(u, {}).get(i, 0.0) for units in groups.values() for u in units) for i in met}
        best = sorted(total, key=lambda i: (-round(total[i], 9), i))[:fetch]
        lists[q].append((floor, list(dict.fromkeys(map(owner, best)))))
    return [(q, i, floor, rank) for q, tiers in lists.items() for rank, (i, floor) in enumerate(plain_walk(tiers), 1)]


@needs_tables
def test_retrieve_planned(spark):
    """Plan and ladders in plain Python; vectors, fusion and pulls by the SQL of their queries."""
    asked = [(r["qid"], r["text"]) for r in questions(spark, FOLDER).collect()]
    plan = plain_rows(asked, nations())
    corpus = {r["id"]: {c: tokens(r[c] or "") for c in CLAUSE_WEIGHTS} for r in clauses(spark, FOLDER).collect()}
    chunks = R._chunked(spark, FOLDER).collect()
    owners = {r["chunk_id"]: r["id"] for r in chunks}
    lad = plain_ladder(plan, corpus, CLAUSE_WEIGHTS, 50)  # noqa: F841  DuckDB reads it below
    lad_c = plain_ladder(plan, {r["chunk_id"]: {"chunk": tokens(r["chunk"])} for r in chunks}, {"chunk": 1.0}, 200, owners.get)
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    for name, rows in (("lad", lad), ("lad_c", lad_c)):
        con.sql(f"CREATE TABLE {name} (qid BIGINT, id VARCHAR, is_floor BOOLEAN, rank BIGINT)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?, ?)", rows)
    want = con.sql(f"WITH {CLAUSES}, {R._DENSE}, {R._Z}, {R._fuse(['lad', 'lad_c'])}, {R._pull('fused')} SELECT qid, id, rank FROM pulled WHERE rank <= 50").fetchall()
    got = [(r["qid"], r["id"], r["rank"]) for r in catalog.QUERIES["retrieve_planned"](spark, FOLDER).collect()]
    assert sorted(got) == sorted(want)


def test_walks_of_many_lists(spark):
    draw = random.Random(3)
    rows, want = [], []
    for q in range(60):
        tiers = [(t == 3, draw.sample(range(70), draw.randint(0, 60))) for t in range(4)]
        rows += [(q, t, floor, i, rk) for t, (floor, ids) in enumerate(tiers) for rk, i in enumerate(ids, 1)]
        want += [(q, i, floor, rank) for rank, (i, floor) in enumerate(plain_walk(tiers), 1)]
    draw.shuffle(rows)
    got = ladder.walk(spark.createDataFrame(rows, "qid bigint, tier int, is_floor boolean, id bigint, rk int"), "id").collect()
    assert sorted((r["qid"], r["id"], r["is_floor"], r["rank"]) for r in got) == sorted(want)


# --- stems, embeddings, rollups ---


@needs_tables
def test_bm25_stem_terms(spark):
    texts = [r["text"] for r in table(spark, FOLDER, "documents").collect() if r["text"] is not None]
    want = Counter(s for t in texts for s in set(stems(t)))
    assert {r["stem"]: r["df"] for r in catalog.QUERIES["bm25_stem_terms"](spark, FOLDER).collect()} == want


@needs_tables
def test_bm25_stemmed(spark):
    docs = {r["id"]: {"text": stems(r["text"])} for r in clauses(spark, FOLDER).collect()}
    asked = {r["qid"]: list(dict.fromkeys(stems(r["text"]))) for r in questions(spark, FOLDER).collect()}
    scores = plain_scores(docs, {"text": 1.0}, {s for a in asked.values() for s in a})
    want = {}
    for q, found in asked.items():
        total = Counter()
        for s in found:
            total.update(scores.get(s, {}))
        best = sorted(total, key=lambda i: (-round(total[i], 9), i))[:10]
        want |= {(q, rank): (i, pytest.approx(total[i], abs=2e-6)) for rank, i in enumerate(best, 1)}
    assert {(r["qid"], r["rank"]): (r["id"], r["score"]) for r in catalog.QUERIES["bm25_stemmed"](spark, FOLDER).collect()} == want


@needs_tables
def test_embed_batch(spark):
    want = {}
    for r in table(spark, FOLDER, "documents").collect():
        vec = np.zeros(64)
        hashes = [xxhash.xxh64(t.encode(), seed=42).intdigest() for t in tokens(r["text"] or "")]
        for h in hashes:
            vec[h % 64] += 1 if 0 < h < 1 << 63 else -1
        if hashes:
            want[r["doc_id"]] = vec / (np.linalg.norm(vec) or 1.0)
    got = {r["doc_id"]: r["vec"] for r in vectors.hashed_embeddings(table(spark, FOLDER, "documents"), "doc_id", P.F.coalesce("text", P.F.lit(""))).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], atol=1e-6) for i in want)
    assert {r["doc_id"]: (r["dim"], r["norm"]) for r in catalog.QUERIES["embed_batch"](spark, FOLDER).collect()} == {i: (64, pytest.approx(float(v @ v), abs=1e-3)) for i, v in want.items()}


@pytest.mark.parametrize("dim", [1, 64, 65, 200])
def test_rollups_of_any_size(spark, dim):
    draw = np.random.default_rng(dim)
    rows = [(int(g), draw.normal(size=dim).tolist()) for g in draw.integers(0, 5, 40)]
    odd = [(7, None), (8, []), (None, [1.0]), (9, [0.0] * dim), (10, [3.0]), (10, [3.0, 4.0])]
    got = {r["g"]: (r["vec"], r["n"]) for r in vectors.mean_vectors(spark.createDataFrame(rows + odd, "g bigint, vec array<double>"), "g").collect()}
    want = {g: np.mean([v for h, v in rows if h == g], axis=0) for g, _ in rows}
    assert got.keys() == want.keys() | {9, 10} and got[9] == ([0.0] * dim, 1) and got[10] == ([0.6, 0.8], 2)
    assert all(np.allclose(got[g][0], v / np.linalg.norm(v)) and got[g][1] == sum(h == g for h, _ in rows) for g, v in want.items())
