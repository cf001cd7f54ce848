"""The best documents of a plan, found where documents are read.

The units of a plan (at most ``MOST_ROWS`` rows of it) go to every task.  One pass over the
documents writes down which of them each holds and how often, short lists of numbers; from
these units are counted and documents scored, and a task hands on no more than the first k
of each query and tier.  What is shuffled grows with the number of tasks, not with what
common words occur in.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clausewell.functions import words

#: Rows of a plan, and rows that a task may hand on, that are dealt with here.
MOST_ROWS, MOST_KEPT = 200_000, 2_000_000
#: Numbers of a table of documents by groups.
CELLS = 1 << 21


class Units:
    """Distinct sequences of terms, met by steps: a start and its next term are a longer start."""

    def __init__(self, units: list[tuple[str, ...]]):
        terms = sorted({t for u in units for t in u})
        number = {t: i for i, t in enumerate(terms)}
        self.n, self.terms = len(units), pa.array(terms, pa.string())
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # of each length: sorted steps, the unit that ends there or -1
        nodes: dict[tuple[str, ...], int] = {(t,): i for t, i in number.items()}
        own = {u: i for i, u in enumerate(units)}
        ends = np.array([own.get((t,), -1) for t in terms], np.int64)
        self.levels.append((np.arange(len(terms)), ends))
        for size in range(2, max((len(u) for u in units), default=0) + 1):
            starts = {u[:size] for u in units if len(u) >= size}
            steps = sorted((nodes[s[:-1]] * len(terms) + number[s[-1]], s) for s in starts)
            nodes = {s: i for i, (_, s) in enumerate(steps)}
            self.levels.append((np.array([k for k, _ in steps], np.int64), np.array([own.get(s, -1) for _, s in steps], np.int64)))

    def walked(self, row: np.ndarray, place: np.ndarray, term: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(where, unit): at which of the known terms, by row and place, a unit begins."""
        at, node = np.arange(len(term)), term
        for size, (steps, ends) in enumerate(self.levels, 1):
            if size > 1:
                fits = at + size - 1 < len(term)
                at, node = at[fits], node[fits]
                to = at + size - 1
                fits = (row[to] == row[at]) & (place[to] == place[at] + size - 1)
                at, node = at[fits], node[fits] * len(self.terms) + term[to[fits]]
                found = np.minimum(np.searchsorted(steps, node), max(0, len(steps) - 1))
                fits = steps[found] == node
                at, node = at[fits], found[fits]
            unit = ends[node]
            yield at[unit >= 0], unit[unit >= 0]

    def summed(self, row: np.ndarray, unit: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, unit, tf), by row and unit."""
        key, where = np.unique(row * self.n + unit, return_inverse=True)
        return key // max(1, self.n), key % max(1, self.n), np.bincount(where, weights=weight, minlength=len(key))

    def occurrences(self, fields: list[pa.Array], weights: list[float], rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, unit, tf) of lists of terms, by row and unit."""
        found = []
        for field, weight in zip(fields, weights, strict=True):
            row = np.repeat(np.arange(rows), pc.fill_null(pc.list_value_length(field), 0).to_numpy(zero_copy_only=False))
            term = pc.fill_null(pc.index_in(field.flatten(), value_set=self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            known = np.flatnonzero(term >= 0)
            row = row[known]
            found += [(row[at], unit, np.full(len(at), weight)) for at, unit in self.walked(row, known, term[known])]
        return self.summed(*(np.concatenate(x) for x in zip(*found, strict=True)))

    def regrouped(self, rows: pa.Table, weights: list[float], column_bit: int) -> Iterator[pa.RecordBatch]:
        """Postings (id, dl, no, tf, and places if there are phrases) of whole documents, terms
        by their number: (id, dl, units, tfs), as of ``holding``."""
        ids = rows["id"].combine_chunks().dictionary_encode()
        doc, no = ids.indices.to_numpy(zero_copy_only=False).astype(np.int64), rows["no"].to_numpy().astype(np.int64)
        if "places" in rows.column_names:
            places = rows["places"].combine_chunks()
            times = pc.list_value_length(places).to_numpy(zero_copy_only=False)
            place, doc_of, term = places.flatten().to_numpy(zero_copy_only=False), np.repeat(doc, times), np.repeat(no, times)
            order = np.lexsort((place, doc_of))
            place, doc_of, term = place[order], doc_of[order], term[order]
            weight = np.array(weights)[place >> column_bit]
            found = [(doc_of[at], unit, weight[at]) for at, unit in self.walked(doc_of, place, term)]
        else:
            unit = self.levels[0][1][no]
            found = [(doc, unit, rows["tf"].to_numpy())]
        row, unit, tf = self.summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
        n = len(ids.dictionary)
        dl = np.zeros(n, np.int64)
        dl[doc] = rows["dl"].to_numpy()
        ends = np.searchsorted(row, np.arange(n + 1))
        for start in range(0, n, 10_000):
            end = min(n, start + 10_000)
            own, at = slice(ends[start], ends[end]), pa.array(ends[start : end + 1] - ends[start], pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x[own])) for x in (unit.astype(np.int32), tf)]
            yield pa.RecordBatch.from_arrays([ids.dictionary.slice(start, end - start), pa.array(dl[start:end]), *lists], names=["id", "dl", "units", "tfs"])


def cut(batches: Iterator[pa.RecordBatch], n_fields: int) -> Iterator[tuple[pa.RecordBatch, list[pa.Array], pa.Array]]:
    """(batch, fields, dl) of (id, *fields, *more) batches, in parts of a few megabytes: fields
    that are texts as lists of tokens, and the length of each document."""
    for batch in (part for whole in batches for part in words.slices(whole)):
        fields = [words.token_lists(c) if words.is_text(c) else c for c in batch.columns[1 : 1 + n_fields]]
        dl = sum((pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in fields), np.zeros(len(batch), np.int64))
        yield batch, fields, pa.array(dl, pa.int64())


def lengths(n_fields: int):  # noqa: ANN201
    """A function over (id, *fields) batches: (n, total), a task's documents and their lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        for batch, _, dl in cut(batches, n_fields):
            n, total = n + len(batch), total + (pc.sum(dl).as_py() or 0)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "total": pa.array([total], pa.int64())})

    return run


def documents(n_fields: int):  # noqa: ANN201
    """A function over (id, *fields) batches: (id, dl, terms), the distinct terms of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, fields, dl in cut(batches, n_fields):
            row = np.concatenate([np.repeat(np.arange(len(batch)), pc.fill_null(pc.list_value_length(f), 0).to_numpy(zero_copy_only=False)) for f in fields])
            coded = pa.concat_arrays([f.flatten() for f in fields]).dictionary_encode()
            size = max(1, len(coded.dictionary))
            pair = np.unique(row * size + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
            ends = pa.array(np.searchsorted(pair // size, np.arange(len(batch) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), dl, pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(pair % size)))], names=["id", "dl", "terms"])

    return run


def indexing(weights: list[float], column_bit: int, bucket, steps: int, parts: int):  # noqa: ANN001, ANN201
    """A function over (id, *fields) batches: (part, term, id, dl, tf, places).  Postings of one
    bucket, a function of the term, and one octave of length are of one part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = (pa.RecordBatch.from_arrays([batch.column(0), dl, *fields], names=["id", "dl", *(f"f{i}" for i in range(len(fields)))]) for batch, fields, dl in cut(batches, len(weights)))
        for rows in posting(weights, column_bit)(lists):
            coded = rows["term"].dictionary_encode()
            of = np.array([bucket(t) for t in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([part_of(of, rows["dl"].to_numpy(zero_copy_only=False), steps, parts), *rows.columns], names=["part", *rows.schema.names])

    return run


def part_of(bucket: np.ndarray, dl: np.ndarray, steps: int, parts: int) -> pa.Array:
    """The part of postings by bucket and octave of length; all of a pair are of one part."""
    return pa.array((bucket + 7 * (steps_of(dl, steps) // steps)) % parts, pa.int32())


def steps_of(dl: np.ndarray, steps: int) -> np.ndarray:
    """The step of a length, of which an octave has so many."""
    return np.floor(np.log2(dl + 1) * steps).astype(np.int64)


def arranged(rows: pa.Table, bucket, steps: int, blocks: dict[int, int]) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
    """Postings (term, id, dl, tf, places) of a part in their order, then the impact of each
    term and block: (term, block, id, dl, tf, places, docs, kind, bucket, band)."""
    coded, ids = (rows[c].combine_chunks().dictionary_encode() for c in ("term", "id"))
    names = coded.dictionary.to_pylist()
    rank = np.empty(len(names), np.int64)
    rank[np.argsort(np.array(names, object), kind="stable")] = np.arange(len(names))
    code = coded.indices.to_numpy(zero_copy_only=False)
    dl = rows["dl"].to_numpy()
    step = steps_of(dl, steps)
    number = np.array([zlib.crc32(str(i).encode()) for i in ids.dictionary.to_pylist()], np.int64)[ids.indices.to_numpy(zero_copy_only=False)]
    known, where = np.unique(step, return_inverse=True)
    block = (step << 32) + number % np.array([blocks[x] for x in known.tolist()], np.int64)[where]
    of = np.array([bucket(t) for t in names], np.int64)[code]
    keys = (of, step // steps, rank[code], block)
    order = np.lexsort(keys[::-1])
    of, band, term, block = (x[order] for x in keys)
    new = np.ones(len(order), bool)
    new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])  # a term has one bucket, a block one band
    first = np.flatnonzero(new)
    rows = rows.take(pa.array(order)).combine_chunks()

    def out(kind: str, at: np.ndarray | None, dl: pa.Array, tf: pa.Array, docs: pa.Array, **more: pa.Array) -> Iterator[pa.RecordBatch]:
        some = (lambda x: pa.array(x)) if at is None else (lambda x: pa.array(x[at]))
        n = len(dl)
        terms = rows["term"] if at is None else rows["term"].take(pa.array(at))
        columns = {"term": terms, "block": some(block), "id": more.get("id", pa.nulls(n, rows["id"].type)), "dl": dl, "tf": tf, "places": more.get("places", pa.nulls(n, pa.list_(pa.int64()))), "docs": docs, "kind": pa.array([kind] * n), "bucket": some(of.astype(np.int32)), "band": some(band.astype(np.int32))}
        yield from pa.table(columns).to_batches(10_000)

    yield from out("posting", None, rows["dl"], rows["tf"], pa.nulls(len(rows), pa.int64()), id=rows["id"], places=rows["places"])
    size = np.diff(np.append(first, len(order)))
    yield from out("impact", first, pa.array(np.minimum.reduceat(rows["dl"].to_numpy(), first)), pa.array(np.maximum.reduceat(rows["tf"].to_numpy(), first)), pa.array(size.astype(np.int64)))


def posting(weights: list[float], column_bit: int):  # noqa: ANN201
    """A function over (id, dl, *fields) batches: (term, id, dl, tf, places), a row for each
    distinct term of a document; a place is a position and, from ``column_bit`` on, the number
    of its column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 1000):
                batch = whole.slice(start, 1000)
                terms, row, place, weight = [], [], [], []
                for no, (field, w) in enumerate(zip(batch.columns[2:], weights, strict=True)):
                    size = pc.fill_null(pc.list_value_length(field), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                    terms.append(field.flatten())
                    row.append(np.repeat(np.arange(len(batch)), size))
                    place.append(np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + (no << column_bit))
                    weight.append(np.full(size.sum(), w))
                coded = pa.concat_arrays(terms).dictionary_encode()
                term, row, place, weight = coded.indices.to_numpy(zero_copy_only=False), *map(np.concatenate, (row, place, weight))
                order = np.lexsort((place, term, row))
                term, row = term[order], row[order]
                first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (row[1:] != row[:-1])])) if len(term) else np.zeros(0, np.int64)
                places = pa.ListArray.from_arrays(pa.array(np.append(first, len(term)), pa.int32()), pa.array(place[order]))
                tf = np.add.reduceat(weight[order], first) if len(first) else np.zeros(0)
                own = pa.array(row[first])
                yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(term[first])), batch.column(0).take(own), batch.column(1).take(own), pa.array(tf), places], names=["term", "id", "dl", "tf", "places"])

    return run


def holding(units: Units, weights: list[float]):  # noqa: ANN201
    """A function over (id, *fields, *carried) batches: (id, dl, units, tfs, *carried), what each
    document holds.  Fields are lists of terms, or texts that are cut into tokens here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, fields, dl in cut(batches, len(weights)):
            carried, n = batch.schema.names[1 + len(weights) :], len(batch)
            row, unit, tf = units.occurrences(fields, weights, n)
            ends = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (unit.astype(np.int32), tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0), dl, *lists, *batch.columns[1 + len(weights) :]], names=["id", "dl", "units", "tfs", *carried])

    return run


def counting(n_units: int):  # noqa: ANN201
    """A function over (dl, units) batches: (unit, n), a task's documents by unit; unit -1
    counts all of them, -2 adds up their lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n, total = np.zeros(n_units, np.int64), 0, 0
        for batch in batches:
            found += np.bincount(batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64), minlength=n_units)
            n += len(batch)
            total += int(batch.column(0).to_numpy(zero_copy_only=False).sum()) if len(batch) else 0
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"unit": np.concatenate([some, [-1, -2]]).astype(np.int64), "n": np.concatenate([found[some], [n, total]]).astype(np.int64)})

    return run


@dataclass
class Asked:
    """Rows of a plan by unit: ``tier`` and ``group`` number tiers and groups from 0, groups
    by tier; ``first`` says where the rows of a unit begin, ``need`` how many groups a tier has."""

    first: np.ndarray
    tier: np.ndarray
    group: np.ndarray
    need: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int, object, int]], n_units: int, n_tiers: int) -> Asked:
        """From (tier, group, unit) rows; a unit that occurs nowhere is numbered -1."""
        groups = {g: i for i, g in enumerate(sorted({(t, g) for t, g, _ in rows}))}
        need = np.bincount([t for t, _ in groups], minlength=n_tiers)
        known = sorted((u, t, groups[t, g]) for t, g, u in rows if u >= 0)
        unit, tier, group = (np.array([r[i] for r in known], np.int64) for i in range(3))
        return Asked(np.searchsorted(unit, np.arange(n_units + 1)), tier, group, need)

    def scores(self, row: np.ndarray, unit: np.ndarray, score: np.ndarray, rows: int) -> np.ndarray:
        """Scores of documents by tier; -inf where a group isn't met."""
        tiers, groups = len(self.need), int(self.need.sum())
        times = self.first[unit + 1] - self.first[unit]
        at = np.repeat(self.first[unit] - np.cumsum(times) + times, times) + np.arange(times.sum())
        doc = np.repeat(row, times)
        sums = np.bincount(doc * tiers + self.tier[at], weights=np.repeat(score, times), minlength=rows * tiers).reshape(rows, tiers)
        met = np.zeros(rows * groups, np.int8)
        met[doc * groups + self.group[at]] = 1
        met = np.add.reduceat(met.reshape(rows, groups), np.cumsum(self.need) - self.need, axis=1, dtype=np.int32)
        return np.where(met == self.need, sums, -np.inf)


def first_of(rows: pa.Table, k: int) -> pa.Table:
    """The first k rows (tier, rounded, score, id) of every tier: best score, then id."""
    order = pc.sort_indices(rows, sort_keys=[("tier", "ascending"), ("rounded", "descending"), ("id", "ascending")], null_placement="at_start")
    rows = rows.take(order)
    tier = rows["tier"].to_numpy()
    return rows.filter(pa.array(np.arange(len(tier)) - np.searchsorted(tier, tier) < k))


def scoring(idf: np.ndarray, avgdl: float, asked: Asked, tiers: pa.RecordBatch, k: int, k1: float, b: float):  # noqa: ANN201
    """A function over (id, dl, units, tfs, *carried) batches: (*tiers' columns, id, score,
    *carried), a task's first k of every tier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(tiers)
        step = max(1, CELLS // max(n, int(asked.need.sum())))
        least, pending, held = np.full(n, -np.inf), [], 0
        names = None

        def settle() -> None:
            nonlocal pending, held
            best = first_of(pa.concat_tables(pending), k)
            tier, rounded = best["tier"].to_numpy(), best["rounded"].to_numpy()
            last = np.flatnonzero(np.arange(len(tier)) - np.searchsorted(tier, tier) == k - 1)
            least[tier[last]] = rounded[last]
            pending, held = [best], len(best)

        for batch in batches:
            names = batch.schema.names[4:]
            for start in range(0, len(batch), step):
                part = batch.slice(start, step)
                row = np.repeat(np.arange(len(part)), pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False))
                unit, tf = (part.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
                norm = k1 * (1 - b + b * part.column(1).to_numpy(zero_copy_only=False) / avgdl)
                score = asked.scores(row, unit, idf[unit] * tf * (k1 + 1) / (tf + norm[row]), len(part))
                rounded = np.round(score, 9)
                floor = least if len(part) <= k else np.maximum(least, np.partition(rounded, len(part) - k, axis=0)[len(part) - k])
                doc, tier = np.nonzero((rounded >= floor) & (score > -np.inf))
                pending.append(pa.table({"tier": tier, "rounded": rounded[doc, tier], "score": score[doc, tier], "id": part.column(0).take(pa.array(doc)), **{c: part.column(4 + i).take(pa.array(doc)) for i, c in enumerate(names)}}))
                held += len(doc)
                if held > 2 * k * n + 100_000:
                    settle()
        if names is not None:
            settle()
            best = pending[0].combine_chunks()
            own = tiers.take(best["tier"].combine_chunks())
            for out in pa.Table.from_arrays([*own.columns, best["id"], best["score"], *[best[c] for c in names]], names=[*tiers.schema.names, "id", "score", *names]).to_batches(10_000):
                yield out

    return run
