"""From the text of a query to tiers of boolean match plans.

A plan depends on its query and the glossary only: queries are planned where their rows
are, in Arrow batches, with the glossary broadcast (its size is checked).  What comes
out is a table (qid, tier, group_no, terms) for ``Index.search``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from clausewell.functions.words import COUNT_WORDS, GENERIC_TOKENS, STOPWORDS

MOST_TOKENS = 40
#: An expansion's word bridges to its acronym if it has so many characters.
BRIDGE_MIN = 6
PLAN_SCHEMA = "qid bigint, tier int, is_floor boolean, group_no int, terms array<string>"


def tokenize(text: str) -> list[str]:
    words = re.sub(r"[^a-z0-9_\- ]+", " ", text.lower()).split(" ")
    return [w for w in words if len(w) >= 2 and w not in STOPWORDS]


@dataclass
class Glossary:
    """Acronyms by lower-case key with all their lower-case spellings."""

    spellings: dict[str, list[str]] = field(default_factory=dict)
    words: list[tuple[list[str], str]] = field(default_factory=list)

    @staticmethod
    def of(rows: list[tuple[str, str, list[str] | None]]) -> Glossary:
        """From (acronym, expansion, aliases) rows."""
        out = Glossary()
        for acronym, expansion, aliases in rows:
            key = acronym.lower()
            out.spellings[key] = [expansion.lower(), *(a.lower() for a in aliases or [])]
            out.words.append((tokenize(expansion), key))
        return out


class Planner:
    """The ladder of one query: phrases first, then all tokens, then the informative
    ones, then any of them."""

    def __init__(self, text: str, glossary: Glossary):
        self.sequence = tokenize(text)
        self.tokens = list(dict.fromkeys(self.sequence))[:MOST_TOKENS]
        self.glossary = glossary
        joined = " ".join(self.tokens)
        #: Acronyms whose expansion the query spells out, by its first word.
        self.spelled = {w[0]: a for w, a in glossary.words if len(w) >= 2 and " ".join(w) in joined}
        uses: dict[str, int] = {}
        for t in self.tokens:
            for w in {w for s in glossary.spellings.get(t, []) for w in tokenize(s)}:
                uses[w] = uses.get(w, 0) + 1
        #: Words of several acronyms' expansions bridge to none of them.
        self.shared = {w for w, n in uses.items() if n > 1}
        self.counts = [t for t in self.tokens if t in COUNT_WORDS]

    def group(self, token: str) -> list[str]:
        """All spellings that stand for a token, as texts of one or more words."""
        known = self.glossary.spellings
        members = dict.fromkeys([token])
        if "-" in token:
            members |= dict.fromkeys(w for w in token.split("-") if len(w) >= 2 and w not in STOPWORDS)
        for base in list(members):
            for spelling in known.get(base, []):
                members[spelling] = None
                members |= dict.fromkeys(w for w in tokenize(spelling) if len(w) >= BRIDGE_MIN and w not in GENERIC_TOKENS and w not in self.shared)
        out = list(members)
        if token in self.spelled:
            out.append(self.spelled[token])
        if token in known:
            out += [f"{c} {token}" for c in self.counts]
        return out

    def tiers(self) -> list[list[list[str]]]:
        """Tiers of AND groups of OR texts; the last is the floor.  No tokens: none."""
        if not self.tokens:
            return []
        known = self.glossary.spellings
        pairs = [(a, b) for a, b in zip(self.sequence, self.sequence[1:], strict=False) if a not in GENERIC_TOKENS and b not in GENERIC_TOKENS and a != b and not (a in known and b in known)]
        informative = [t for t in self.tokens if t not in GENERIC_TOKENS]
        out = []
        if pairs:
            paired = {w for p in pairs for w in p}
            out.append([[f"{a} {b}"] for a, b in pairs] + [self.group(t) for t in informative if t not in paired])
        out.append([self.group(t) for t in self.tokens])
        if 0 < len(informative) < len(self.tokens):
            out.append([self.group(t) for t in informative])
        out.append([list(self.tokens)])
        distinct = []
        for tier in out:
            if tier not in distinct:
                distinct.append(tier)
        return distinct


def plan_rows(queries: Iterable[tuple[int, str | None]], glossary: Glossary) -> list[tuple[int, int, bool, int, list[str]]]:
    """(qid, tier, is_floor, group_no, terms) of all queries."""
    rows = []
    for qid, text in queries:
        tiers = Planner(text or "", glossary).tiers()
        for t, groups in enumerate(tiers):
            for g, texts in enumerate(groups):
                for one in dict.fromkeys(texts):
                    terms = tokenize(one)
                    if terms:
                        rows.append((qid, t, t == len(tiers) - 1, g, terms))
    return rows


def plan(queries: DataFrame, glossary: Glossary, most: int = 100_000) -> DataFrame:
    """PLAN_SCHEMA rows of queries (qid, text)."""
    if len(glossary.words) > most:
        raise ValueError(f"a glossary of over {most} entries is too large to broadcast")
    shared = queries.sparkSession.sparkContext.broadcast(glossary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = plan_rows(zip(pdf["qid"], pdf["text"], strict=True), shared.value)
            yield pd.DataFrame(rows, columns=["qid", "tier", "is_floor", "group_no", "terms"])

    return queries.select("qid", "text").mapInPandas(run, PLAN_SCHEMA)
