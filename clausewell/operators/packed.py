"""Many short rows, taken through a shuffle as a few compressed Arrow tables.

A shuffle of rows writes each of them with its own lengths and padding.  Here a task sorts
what it has by the part that a row belongs to and hands on one table for each part, whose
columns compress well; the task of a part gets all tables of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Rows, and bytes of them, that a task gathers before it hands them on.
ROWS, BYTES = 1 << 20, 64 << 20

Batches = Iterator[pa.RecordBatch]


def packing(sort: tuple[str, ...] = ()) -> Callable[[Batches], Batches]:
    """A function over (part, ...) batches: (part, payload), the rows of each part as one
    table, sorted by some columns; of texts each distinct one is there once."""

    def coded(rows: pa.Table) -> pa.Table:
        for at, field in enumerate(rows.schema):
            if pa.types.is_string(field.type):
                rows = rows.set_column(at, field.name, rows.column(at).combine_chunks().dictionary_encode())
        return rows

    def packed(kept: list[pa.RecordBatch]) -> Batches:
        rows = pa.Table.from_batches(kept)
        rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ("part", *sort)])).combine_chunks()
        sizes = rows["part"].value_counts()
        parts, start = [], 0
        payloads = []
        for one in sorted(sizes.to_pylist(), key=lambda x: x["values"]):
            sink = pa.BufferOutputStream()
            own = coded(rows.slice(start, one["counts"]).drop_columns("part"))
            with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(own)
            parts.append(one["values"])
            payloads.append(sink.getvalue().to_pybytes())
            start += one["counts"]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(payloads, pa.binary())], names=["part", "payload"])

    def run(batches: Batches) -> Batches:
        kept, rows, size = [], 0, 0
        for batch in batches:
            if not len(batch):
                continue
            kept.append(batch)
            rows, size = rows + len(batch), size + batch.nbytes
            if rows >= ROWS or size >= BYTES:
                yield from packed(kept)
                kept, rows, size = [], 0, 0
        if kept:
            yield from packed(kept)

    return run


def tables(payloads: pa.Array) -> Iterator[pa.Table]:
    for payload in payloads:
        rows = pa.ipc.open_stream(payload.as_buffer()).read_all()
        yield rows.cast(pa.schema([(f.name, f.type.value_type if pa.types.is_dictionary(f.type) else f.type) for f in rows.schema]))


def whole(use: Callable[[pa.Table], Batches]) -> Callable[[Batches], Batches]:
    """A function over (part, payload) batches that uses all rows of a task at once.  Tables of
    (segment, id) alone name rows that are left out, those of (id) alone the only ones that stay."""

    def named(rows: pa.Table) -> pa.Array:
        return pc.binary_join_element_wise(rows["segment"], rows["id"].cast(pa.string()), "\0")

    def run(batches: Batches) -> Batches:
        rows, gone, asked = [], [], []
        for batch in batches:
            for table in tables(batch.column(1)):
                {("segment", "id"): gone, ("id",): asked}.get(tuple(table.column_names), rows).append(table)
        if not rows:
            return
        found = pa.concat_tables(rows)
        if asked:
            found = found.filter(pc.is_in(found["id"], value_set=pa.concat_tables(asked)["id"].combine_chunks()))
        if gone:
            found = found.filter(pc.invert(pc.is_in(named(found), value_set=named(pa.concat_tables(gone)).combine_chunks())))
        if len(found):
            yield from use(found)

    return run


def dealt(packed: DataFrame, parts: int) -> DataFrame:
    """(part, payload) rows, those of a part in the task of its number."""
    return packed.repartitionById(parts, "part")
