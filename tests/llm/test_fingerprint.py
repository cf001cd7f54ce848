import hashlib
import math
import random
from collections import Counter

from fixtures import awkward, documents, prose

from clausewell.llm import queries
from clausewell.llm.fingerprint import State, fingerprints

M64 = (1 << 64) - 1


def plain_lanes(text):
    """Lanes of a text by the definition, in plain integers."""
    dense, lanes = [0] * 16, [0] * 96
    for line in text.encode().split(b"\n"):
        if line:
            d = hashlib.blake2b(line, digest_size=64).digest()
            dense = [(a + int.from_bytes(d[4 * i : 4 * i + 4], "little")) % 2**32 for i, a in enumerate(dense)]
        for i in range(len(line) - 15):
            a, b = int.from_bytes(line[i : i + 8], "little"), int.from_bytes(line[i + 8 : i + 16], "little")
            h = (a * 0x9E3779B97F4A7C15 + (b ^ 0xD6E8FEB86659FD93) * 0xC2B2AE3D27D4EB4F) & M64
            slot = (((h ^ (h >> 29)) * 0x94D049BB133111EB & M64) >> 34) % 192
            lanes[slot % 96] += 1 if slot < 96 else -1
    return dense, lanes


def plain_hex(text):
    dense, lanes = plain_lanes(text)
    return b"".join(x.to_bytes(4, "little") for x in dense).hex() + b"".join(x.to_bytes(4, "little", signed=True) for x in lanes).hex()


def plain_likeness(one, two):
    (d1, a), (d2, b) = plain_lanes(one), plain_lanes(two)
    if d1 == d2:
        return 1.0
    scale = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
    return min(1.0, max(0.0, sum(x * y for x, y in zip(a, b, strict=True)) / scale)) if scale else 0.0


def test_the_query_against_plain_integers(spark, tmp_path):
    r = random.Random(4)
    texts = [(i, t) for i, t in awkward() if i not in (None, 5, 7)] + [(100 + i, prose(i % 9, r.randint(1, 60))) for i in range(40)]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {x["doc_id"]: x for x in queries.op3_fingerprint(spark, str(tmp_path)).collect()}
    order = sorted((i, t or "") for i, t in texts)
    assert sorted(rows) == [i for i, _ in order]
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        new = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
        got = rows[i]
        assert got["n_chars"] == len(t) and got["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert got["fingerprint"] == plain_hex(t) and got["edited_fingerprint"] == plain_hex(new)
        assert math.isclose(got["near_edited"], plain_likeness(t, new), abs_tol=1e-9)
        assert math.isclose(got["near_next"], plain_likeness(t, following), abs_tol=1e-9)


def test_large_ids_and_ties_lose_no_row(spark):
    for texts in (
        [((1 << 60) + i, f"text {i} " * 5) for i in range(60)],
        [((1 << 61) + 300 * i, f"text {i} " * 5) for i in range(400)],
        [(-(1 << 62) + i, f"text {i} " * 5) for i in range(60)],
        [(None if i % 3 else 7, f"text {i % 50} " * 5) for i in range(300)],
        [(5, "same") for _ in range(100)] + [(6, "other")],
    ):
        rows = fingerprints(documents(spark, texts), rows_per_task=10).collect()
        assert Counter(x["doc_id"] for x in rows) == Counter(i for i, _ in texts)
        if None not in dict(texts) and len(dict(texts)) == len(texts):
            order = sorted(texts)
            follows = {i: order[(k + 1) % len(order)][1] for k, (i, _) in enumerate(order)}
            own = dict(texts)
            for x in rows:
                t, n = own[x["doc_id"]], len(own[x["doc_id"]]) // 4
                assert x["edited_sha256"] == hashlib.sha256((t[: len(t) - n] + follows[x["doc_id"]][:n]).encode()).hexdigest()


def test_wide_lanes_do_not_wrap():
    a, b = State.of(b"a" * 32_000), State.of(b"a" * 33_600)
    assert a.likeness(b) > 0.99


def test_sums_are_homomorphic_and_without_order():
    lines = prose(1, 400).split("\n")
    whole = State.of("\n".join(lines).encode())
    other = list(lines)
    random.Random(1).shuffle(other)
    assert State.of("\n".join(other).encode()).hex() == whole.hex()
    first, rest = "\n".join(lines[:7]).encode(), "\n".join(lines[7:]).encode()
    assert State.of(first).add(State.of(rest)).hex() == whole.hex()
    assert whole.remove(State.of(first)).hex() == State.of(rest).hex()
    assert State.of("\n".join(lines + lines[:1]).encode()).hex() != whole.hex()


def test_edits_follow_the_successor_over_every_range(spark):
    r = random.Random(2)
    texts = [(i * 7, prose(i, r.randint(1, 300))) for i in range(1, 200)] + [(3, None), (4, ""), (5, "äöü🙂" * 9), (6, prose(3, 40))]
    r.shuffle(texts)
    for per_task in (10, 10_000):
        rows = {x["doc_id"]: x for x in fingerprints(documents(spark, texts), rows_per_task=per_task).collect()}
        assert len(rows) == len(texts)
        order = sorted((i, t or "") for i, t in texts)
        for k, (i, t) in enumerate(order):
            following = order[(k + 1) % len(order)][1]
            cut = len(t) // 4
            new = t[: len(t) - cut] + following[:cut]
            got = rows[i]
            assert got["n_chars"] == len(t) and got["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
            assert got["fingerprint"] == State.of(t.encode()).hex() and got["edited_fingerprint"] == State.of(new.encode()).hex()
            assert got["near_next"] == State.of(t.encode()).likeness(State.of(following.encode())) and 0 <= got["near_edited"] <= 1


def test_awkward_rows(spark):
    rows = fingerprints(documents(spark, awkward())).collect()
    assert len(rows) == len(awkward())
    assert rows[0]["doc_id"] is None
    assert fingerprints(documents(spark, [])).count() == 0
    (one,) = fingerprints(documents(spark, [(5, "abcdefgh")])).collect()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
