import random
import re

import numpy as np
import xxhash
from fixtures import awkward, documents, prose

from clausewell.llm import neardup, queries, simhash
from clausewell.llm.graph import connected_components


def brute_fingerprint(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(links, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_unary_counts_bound_the_hamming_distance():
    r = np.random.default_rng(1)
    a, b = (r.integers(0, 2**63, 1000, dtype=np.uint64) for _ in range(2))
    ones = lambda x: [[bin(int(v) >> s & 3).count("1") for s in range(0, 64, 2)] for v in x]
    manhattan = np.abs(np.array(ones(a)) - np.array(ones(b))).sum(axis=1)
    assert (np.bitwise_count(simhash.unary_counts_np(a) ^ simhash.unary_counts_np(b)) == manhattan).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_every_pair_within_the_radius_shares_a_cell():
    r = random.Random(3)
    for tables in (1, 2, 3):
        masks = simhash.grid_masks(4, tables)
        for _ in range(300):
            a = r.getrandbits(64)
            b = a
            for bit in r.sample(range(64), 4):
                b ^= 1 << bit
            ua, ub = (int(simhash.unary_counts_np(np.array([x], dtype=np.uint64))[0]) for x in (a, b))
            assert any(ua & m == ub & m for m in masks)


def bridge():
    """Three texts: the first and the last are linked through the second only."""
    base = prose(77, 150).split()
    texts = [" ".join([*base[:i], "swap", *base[i + 1 :]]) for i in range(2, 150, 3)]
    fps = [brute_fingerprint(t) for t in texts]
    apart = lambda a, b: bin(fps[a] ^ fps[b]).count("1")
    some = range(len(texts))
    found = [(a, b, c) for a in some for b in some for c in some if a < c and apart(a, b) <= 4 and apart(b, c) <= 4 and apart(a, c) > 4]
    # No fourth text takes part, so the second is the only bridge.
    return [texts[i] for i in found[0]]


def test_components_match_brute_force(spark):
    a, b, c = bridge()
    texts = awkward() + [(100 + i, prose(9, 200) + f"\nend {i}") for i in range(40)] + [(200 + i, prose(20 + i, 40)) for i in range(20)]
    texts += [(700, c), (None, b), (600, a), (None, prose(88, 70)), (None, prose(88, 70))]
    rows = simhash.near_duplicate_components(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    fp = {}
    for i, t in texts:
        fp.setdefault(brute_fingerprint(t), []).append(i)
    root = brute_components([(a, b) for a in fp for b in fp if a < b and bin(a ^ b).count("1") <= 4], fp)
    least = {}
    for f, ids in fp.items():
        least[root[f]] = min([i for i in [*ids, least.get(root[f])] if i is not None], default=None)
    want = sorted((str(i), f, str(least[root[f]])) for f, ids in fp.items() for i in ids)
    assert sorted((str(r["doc_id"]), r["fp"] % (1 << 64), str(r["component_id"])) for r in rows) == want
    assert {x[2] for x in want if x[0] in ("600", "700")} == {"600"} and ("None", brute_fingerprint(prose(88, 70)), "None") in want


def test_the_query(spark, tmp_path):
    texts = [(i, prose(i % 7, 60) + f" x{i % 14}") for i in range(40)] + [(90, None), (91, "")]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.op6_simhash(spark, str(tmp_path)).collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts}
    root = brute_components([(a, b) for a in fps for b in fps if a < b and bin(fps[a] ^ fps[b]).count("1") <= 4], fps)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in rows.items()} == {i: (f"{fps[i]:016x}", root[i]) for i in fps}


def test_hot_cells_are_dealt_over_tasks(spark):
    r = np.random.default_rng(6)
    fps = np.unique(r.integers(0, 2**62, 6, dtype=np.uint64)[:, None] ^ sum((np.uint64(1) << r.integers(0, 60, (6, 60), dtype=np.uint64)) for _ in range(2)))
    points = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps)], "fp bigint, node bigint")
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if bin(int(fps[a] ^ fps[b])).count("1") <= 4]
    want = brute_components(pairs, range(len(fps)))
    grids = [[m] for m in simhash.grid_masks(4, 1)]
    for most in (7, 40, 8192):
        got = simhash.grid_links(points, ["fp"], grids, 4, most).collect()
        assert brute_components([(x["src"], x["dst"]) for x in got], range(len(fps))) == want


def test_large_cells_match_small_ones():
    r = np.random.default_rng(5)
    fps = (r.integers(0, 2**63, 30, dtype=np.uint64)[:, None] ^ (np.uint64(1) << r.integers(0, 60, (30, 12), dtype=np.uint64))).ravel()[:, None]
    key, node = np.zeros(len(fps), np.int64), np.arange(len(fps))
    large = simhash.cell_links(key, fps, node, 4)
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if bin(int(fps[a, 0] ^ fps[b, 0])).count("1") <= 4]
    assert brute_components(zip(*large, strict=True), node.tolist()) == brute_components(pairs, node.tolist())


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (300, 301), (301, 300)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 300: 300, 301: 300}
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates_are_groups_of_similar_texts(spark):
    base = prose(50, 300).split(" ")
    copies = []
    for i in range(12):
        w = list(base)
        w[20 * i + 3] = f"changed{i}"
        copies.append((1000 + i, " ".join(w)))
    texts = [x for x in awkward() if x[0] is not None] + [(500, " ".join(base)), *copies] + [(2000 + i, prose(60 + i, 120)) for i in range(30)]
    got = {r["doc_id"]: r["group_id"] for r in neardup.duplicate_groups(documents(spark, texts), group_rows=5).collect()}
    ids = list(dict.fromkeys(i for i, _ in texts))
    sets = {i: shingles(t) for i, t in texts}
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    want = brute_components([(a, b) for a in ids for b in ids if a < b and alike(a, b)], ids)
    assert {i: got[i] for i in ids} == want
    kept = {r["doc_id"] for r in neardup.drop_near_duplicates(documents(spark, texts)).collect()}
    assert kept == {i for i in ids if want[i] == i}
    assert neardup.drop_near_duplicates(documents(spark, [])).count() == 0


def test_a_star_of_unlike_copies_is_one_group_when_divided(spark):
    hub = prose(51, 300).split()
    copies = []
    for i in range(60):
        w = list(hub)
        for j in range(5):
            w[(7 * i + 59 * j) % 290 + 4] = f"own{i}x{j}"
        copies.append((1000 + i, " ".join(w)))
    texts = [*copies, (5000, " ".join(hub))]
    sets = {i: shingles(t) for i, t in texts}
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ids = list(sets)
    want = brute_components([(a, b) for a in ids for b in ids if a < b and alike(a, b)], ids)
    assert sum(alike(a, b) for a in ids[:60] for b in ids[:60] if a < b) < 60 and set(want.values()) == {1000}
    for group_rows in (10, 1000):
        got = neardup.duplicate_groups(documents(spark, texts), group_rows=group_rows).collect()
        assert {r["doc_id"]: r["group_id"] for r in got} == want


def test_pairs_at_the_threshold_meet_at_every_size():
    r = np.random.default_rng(7)
    pairs, shared, own = 1500, 400, 50
    prints = []
    for seed in (1, 2):
        sets = r.integers(0, 2**63, (pairs, shared + 2 * own), dtype=np.uint64) * np.uint64(2) + np.uint64(seed - 1)
        for at in (slice(0, shared + own), [*range(shared), *range(shared + own, shared + 2 * own)]):
            h = sets[:, at]
            prints.append(simhash.majority(h.astype(">u8").tobytes(), np.repeat(np.arange(pairs), h.shape[1]), np.full(pairs, h.shape[1])))
    codes = [simhash.unary_counts_np(x) for x in prints]
    hi, lo = codes[0] ^ codes[1], codes[2] ^ codes[3]
    for n in (1e3, 1e4, 1.5e5, 1e6, 1e7, 3e7):
        met = np.zeros(pairs, dtype=bool)
        for a, b in neardup.grids_for(int(n)):
            met |= ((hi & np.uint64(a)) == 0) & ((lo & np.uint64(b)) == 0)
        print(int(n), len(neardup.grids_for(int(n))), met.mean())
        assert met.mean() > 0.97, n
