"""Overlapping chunk windows, cut at line or sentence ends where they are near."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

CHUNK_CHARS, OVERLAP, MIN_BUDGET = 1600, 200, 400


def bounds(body: str, size: int, overlap: int = OVERLAP) -> Iterator[tuple[int, int]]:
    """(start, end) of the windows of a text, in code points: each ends behind the last
    line or sentence end in its second half, if there is one."""
    start = 0
    while True:
        end = min(start + size, len(body))
        if end < len(body):
            cut = max(body.rfind("\n", 0, end + 1), body.rfind(". ", 0, end + 2))
            end = cut + 1 if cut > start + size / 2 else end
        yield start, end
        if end >= len(body):
            return
        start = max(end - overlap, start + 1)


def windows(label: str, body: str, size: int = CHUNK_CHARS, overlap: int = OVERLAP) -> list[str]:
    """The chunks of a text, each led by the label."""
    whole = len(label) + len(body) <= size
    cuts = [(0, len(body))] if whole else bounds(body, max(MIN_BUDGET, size - len(label)), overlap)
    return [label + body[start:end] for start, end in cuts]


def chunks(clauses: DataFrame, key: str = "id", title: str | None = "title", text: str = "text") -> DataFrame:
    """(id, n, chunk), without a label where there is no title -- window ends depend on the ones before, so texts are cut in
    Arrow batches; a chunk's id is ``<id>::c<n>``."""
    kind = clauses.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            labels = [f"{t}\n" if t else "" for t in pdf[title]] if title else [""] * len(pdf)
            rows = [(k, n, c) for k, label, body in zip(pdf[key], labels, pdf[text], strict=True) for n, c in enumerate(windows(label, body or ""))]
            yield pd.DataFrame(rows, columns=[key, "n", "chunk"])

    return clauses.select(key, text, *([title] if title else [])).mapInPandas(run, f"{key} {kind}, n bigint, chunk string")
