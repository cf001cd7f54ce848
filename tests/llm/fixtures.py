"""Small corpora with the awkward rows that every operator must take."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, node string, cell int, blob string"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    names = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{i % 7}x" for i in range(vocabulary)]
    out = [r.choice(names) for _ in range(words)]
    return "\n".join(" ".join(out[i : i + 12]) for i in range(0, len(out), 12))


def documents(spark, texts, langs=None):
    """Rows with extra columns whose names the operators use themselves."""
    rows = [(i, t, (langs or {}).get(i, "en"), f"s{(i or 0) % 3}", None if t is None else len(t), "x", "y", 1, None) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def awkward() -> list[tuple[int | None, str | None]]:
    long = prose(5, 30_000)
    return [(0, None), (1, ""), (2, "   \n\t "), (3, "one"), (4, "One"), (5, prose(1, 80)), (5, prose(1, 80)), (6, prose(1, 80)), (7, long), (8, "日本語 テキスト 🙂"), (9, "1234 5678"), (None, prose(2, 50)), (11, "a\n\n\nb"), (12, prose(3, 60))]
