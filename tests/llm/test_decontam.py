import random
import re

import numpy as np
import pyarrow as pa
import pytest
from fixtures import awkward, documents, prose

from clausewell.llm import decontam, queries
from clausewell.llm.textbits import slices


def words(text):
    return [w.encode() for w in re.findall(r"[a-z0-9]+|[^\x00-\x7f]+", (text or "").lower())]


def brute(texts, items):
    out = {}
    for i, t in texts:
        w = words(t)
        for j, x in items:
            v = words(x)
            if not v or not w:
                continue
            k = min(5, len(v))
            size = min(len(v), len(w))
            best = max((decontam.weighted_similarity(w[s : s + size], v, k) for s in range(len(w) - size + 1)), default=0)
            if best >= 0.8:
                out[i, j] = round(best, 9)
    return out


def test_copies_are_found_and_clean_texts_left_alone(spark):
    r = random.Random(4)
    items = [(j, prose(900 + j, r.randint(15, 57))) for j in range(12)] + [(50, "two words"), (51, None), (52, "..."), (53, prose(900, 40))]
    texts = [x for x in awkward() if x[0] is not None and x[0] != 7] + [(100 + i, prose(i, 120)) for i in range(20)]
    for j, x in items[:12]:
        w = x.split()
        texts += [(200 + j, prose(j, 50) + " " + x.upper() + ", " + prose(j + 1, 50)), (300 + j, x), (400 + j, " ".join(w[1:])), (500 + j, prose(j, 30) + " " + " ".join([*w[: len(w) // 2], "other", *w[len(w) // 2 + 1 :]]) + " " + prose(j, 30))]
    texts.append((600, f"so two words stand. {items[0][1]} {items[1][1]} {items[0][1]}"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (20_000, 3):
        rows = decontam.contaminated(documents(spark, texts), bench, items_per_pass=block).collect()
        assert {(x["doc_id"], x["item_id"]): round(x["similarity"], 9) for x in rows} == brute(texts, items)
    assert decontam.contaminated(documents(spark, []), bench).count() == 0
    assert decontam.contaminated(documents(spark, texts), bench.where("false")).count() == 0


def test_awkward_documents(spark):
    items = [(1, prose(900, 30)), (2, None), (None, prose(901, 20))]
    long = prose(6, 25_000)
    texts = [*awkward(), (None, "lead " + items[0][1]), (5, items[2][1]), (21, long + " " + items[0][1] + " " + long)]
    rows = decontam.contaminated(documents(spark, texts), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((str(r["doc_id"]), str(r["item_id"]), r["similarity"]) for r in rows) == [("21", "1", 1.0), ("5", "None", 1.0), ("None", "1", 1.0)]


def near_copies(size, similarity, number):
    """Items of a size, each with a document at about a similarity to it or just above."""
    r = random.Random(size * 1000 + int(similarity * 100))
    items, texts = [], []
    for j in range(number):
        w = prose(7_000_000 + 1000 * size + j, size, 3000).split()
        v = list(w)
        goal, at = similarity, list(range(size))
        r.shuffle(at)
        for i in at:
            u = [*v[:i], f"other{i}", *v[i + 1 :]]
            if decontam.weighted_similarity([x.encode() for x in u], [x.encode() for x in w], min(5, size)) >= goal:
                v = u
        items.append((j, " ".join(w)))
        texts.append((j, prose(j, 30) + " " + " ".join(v) + " " + prose(j + 1, 30)))
    return items, texts


@pytest.mark.parametrize("size", [5, 9, 14, 22, 34, 47, 60])
def test_recall_by_size_and_similarity(size):
    for similarity in (0.8, 0.9, 1.0):
        items, texts = near_copies(size, similarity, 60)
        known = decontam.Items([i for i, _ in items], [t for _, t in items], 0.8)
        found = set()
        for first, raw, offsets in slices(pa.array([t for _, t in texts])):
            found |= {(first + row, item) for row, item, *_ in known.matches(raw, offsets)}
        want = {(i, i) for i, _ in items}
        assert len(want - found) <= (0 if size - 4 < decontam.SURE else 1), (size, similarity)


def test_the_index_finds_all_within_the_radius():
    r = np.random.default_rng(7)
    base = r.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.concatenate([base ^ np.uint64(sum(1 << int(b) for b in r.choice(64, n, replace=False))) for n in (0, 5, 12, 20, 21, 30)])
    index = decontam.HammingIndex(fps)
    number, position, distance = index.within(base)
    want = [(j, i, int(d)) for j, fp in enumerate(base) for i, d in enumerate(np.bitwise_count(fps ^ fp)) if d <= decontam.RADIUS]
    assert list(zip(number.tolist(), position.tolist(), distance.tolist(), strict=True)) == want
    assert not len(index.within(base[:0])[0])


def test_the_query(spark, tmp_path):
    items = [(j, prose(900 + j, 20 + j)) for j in range(8)]
    texts = [(i, prose(i, 50) + " " + items[i % 8][1] + " " + prose(i + 1, 20)) if i % 4 == 0 else (i, prose(i, 90)) for i in range(40)]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = queries.op7_decontamination(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in rows} == brute(texts, items)


def test_items_of_one_template_cost_little():
    """Items that share most of their wording: the same rows as by comparing every window."""
    import time

    import numpy as np

    from clausewell.llm import decontam

    def block(n, seed):
        r = random.Random(seed)
        base = [f"b{j}" for j in range(16)]
        return [" ".join([*base[:3], f"v{i % 97}", *base[4:15], f"u{i}"]) for i in range(n)], r

    texts, r = block(60, 1)
    docs = [" ".join(f"z{r.randrange(500)}" for _ in range(40)) + f" {texts[i]} " + " ".join(r.choice(texts).split()[:r.randrange(4, 17)]) for i in range(0, 60, 7)]
    items = decontam.Items(list(range(len(texts))), texts, decontam.THRESHOLD)
    raw = np.frombuffer("".join(docs).encode(), np.uint8)
    got = {(row, i): x for row, i, x, *_ in items.matches(raw, np.cumsum([0, *map(len, docs)]))}
    want = {}
    for row, d in enumerate(docs):
        words = [w.encode() for w in d.split()]
        for i, t in enumerate(texts):
            own = [w.encode() for w in t.split()]
            best = max(decontam.weighted_similarity(words[j : j + 16], own) for j in range(max(1, len(words) - 15)))
            if best >= decontam.THRESHOLD:
                want[row, i] = best
    assert got == want and len(want) >= len(docs)

    texts, _ = block(3000, 2)
    items = decontam.Items(list(range(len(texts))), texts, decontam.THRESHOLD)
    docs = [" ".join(texts[i : i + 20]) for i in (0, 500, 900)]
    raw = np.frombuffer("".join(docs).encode(), np.uint8)
    begun = time.process_time()
    found = {(row, i) for row, i, *_ in items.matches(raw, np.cumsum([0, *map(len, docs)]))}
    assert {(k, i) for k, at in enumerate((0, 500, 900)) for i in range(at, at + 20)} <= found
    assert time.process_time() - begun < 60


def test_rows_without_copies(spark):
    """items of one text are compared once, and rows are judged where they are read."""
    items = [(j, prose(900 + j, 15 + 5 * j)) for j in range(8)] + [(50, "two words"), (51, None), (52, "...")]
    texts = [x for x in awkward() if x[0] is not None and x[0] != 7] + [(100 + i, prose(i, 120)) for i in range(20)]
    for j, x in items[:8]:
        texts += [(200 + j, prose(j, 50) + " " + x.upper() + ", " + prose(j + 1, 50)), (300 + j, x), (400 + j, " ".join(x.split()[1:])), (500 + j, prose(j, 30) + " " + " ".join(x.split()[: 7 + j]))]
    texts += [(600, "so two words stand"), (300, "no copy, and the id of one that is")]
    want = sorted((i, t) for at, (i, t) in enumerate(texts) if not brute([(at, t)], items) and t is not None)
    bench = spark.createDataFrame([(1000 * n + j, x) for n in range(40) for j, x in items], "item_id bigint, text string")
    for block, passes in ((10, 1), (4, 3)):
        left = decontam.without_copies(documents(spark, texts), bench, items_per_pass=block)
        assert left.columns == documents(spark, texts).columns
        rows = [(x["doc_id"], x["text"]) for x in left.collect()]
        assert sorted(x for x in rows if x[1] is not None) == want
        assert len(rows) - len(want) == sum(t is None for _, t in texts)
        plan = left._jdf.queryExecution().toString()
        assert "Join" not in plan and (passes > 1 or plan.split("== Physical Plan ==")[1].count("MapInArrow") == 1)
