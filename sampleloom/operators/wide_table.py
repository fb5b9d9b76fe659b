"""Attribute-value rows into one wide, typed row per entity.

Plan: scan -> Arrow stage (attribute name to column index, value to typed text, latest cell of an entity and column) -> one
hash shuffle by entity -> sort inside the partition -> Arrow stage that streams the sorted rows into columnar builders.
The first stage keeps the cells of entities that come again until its task ends, so a hot entity adds about one row per
column and task to the shuffle; the last one keeps one cell per column of the entity that is open, whatever its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleloom.functions.text import full, full_col, not_blank
from sampleloom.operators.typed_values import read_as

_SPARK = {"integer": T.LongType(), "decimal": T.DecimalType(38, 3), "boolean": T.BooleanType(), "date": T.DateType(), "text": T.StringType()}
_ARROW = {"integer": pa.int64(), "decimal": pa.decimal128(38, 3), "boolean": pa.bool_(), "date": pa.date32(), "text": pa.string()}
_NO_ORDER = -(2**62)
_CELLS = "entity string, col int, typed string, at timestamp_ntz, seq long"
_MEMO_LIMIT = 200_000
#: Cells that a task of the first stage holds back to combine them.
HELD_CELLS = 100_000
#: Missing words up to which they are sent to every task; beyond it values meet them in a join.
SHIPPED_WORDS = 100_000


@dataclass(frozen=True)
class Attribute:
    name: str
    value_type: str
    unit: str | None
    aliases: tuple[str, ...]


def attributes_of(types_df: DataFrame) -> list[Attribute]:
    """The attribute dimension; it has one row per column of the wide table, so it fits the driver by definition."""
    return [
        Attribute(r["attr_name"], r["value_type"], r["unit"], tuple(a for a in (r["aliases"] or "").split(";") if a.strip()))
        for r in types_df.dropDuplicates(["attr_name"]).orderBy("attr_name").collect()
        if r["attr_name"]
    ]


def cells(rows: DataFrame, attributes: list[Attribute], missing: list[str], held_cells: int = HELD_CELLS) -> DataFrame:
    """Readable cells ``(entity, col, typed, at, seq)`` of ``rows (entity, name, value, at, seq)``.

    Null or blank entities, unknown or null names, missing values and values that cannot be read as the attribute's type
    give no cell. A task holds back ``held_cells`` cells and keeps the latest of an entity and column; ties take the greatest
    ``seq``. Several cells of one entity and column may remain; :func:`widen` takes the latest.
    """
    col_of = {full(a.name): i for i, a in enumerate(attributes)}
    for i, a in enumerate(attributes):
        for alias in a.aliases:
            col_of.setdefault(full(alias), i)
    lost = frozenset(full(w) for w in missing if w)
    kinds = [(a.value_type, a.unit) for a in attributes]

    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        entity, col, at, seq, typed = zip(*held)
        known = lambda xs, kind: pa.array(xs, pa.int64(), mask=np.array(xs) == _NO_ORDER).cast(kind)
        return pa.record_batch([pa.array(entity, pa.string()), pa.array(col, pa.int32()), pa.array(typed, pa.string()), known(at, pa.timestamp("us")), known(seq, pa.int64())], names=["entity", "col", "typed", "at", "seq"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name_memo: dict[str, int] = {}
        memo: dict[tuple[int, str], str | None] = {}
        best: dict[tuple[str, int], tuple[int, int, str]] = {}
        again: set[tuple[str, int]] = set()
        for b in batches:
            entity, name, value, at, seq = (b.column(i) for i in range(5))
            code = name.dictionary_encode()
            cols = []
            for n in code.dictionary.to_pylist():
                if n not in name_memo:
                    name_memo[n] = col_of.get(full(n), -1)
                cols.append(name_memo[n])
            where = np.array(cols + [-1])[np.asarray(code.indices.fill_null(len(cols)))]
            keep = np.flatnonzero(where >= 0)
            if not len(keep):
                continue
            take = pa.array(keep)
            times = np.asarray(at.take(take).cast(pa.int64()).fill_null(_NO_ORDER))
            seqs = np.asarray(seq.take(take).fill_null(_NO_ORDER))
            if len(memo) > _MEMO_LIMIT:
                memo.clear()
            for e, c, v, t, s in zip(entity.take(take).to_pylist(), where[keep].tolist(), value.take(take).to_pylist(), times.tolist(), seqs.tolist()):
                if v is None:
                    continue
                k = (c, v)
                if k in memo:
                    typed = memo[k]
                else:
                    f = full(v)
                    typed = memo[k] = read_as(v, *kinds[c]) if f and f not in lost else None
                if typed is None:
                    continue
                new, key = (t, s, typed), (e, c)
                old = best.get(key)
                if old is None:
                    best[key] = new
                else:
                    again.add(key)
                    if new > old:
                        best[key] = new
            if len(best) > held_cells:
                hot = again if len(again) <= held_cells // 2 else set()
                yield batch_of([(*k, *x) for k, x in best.items() if k not in hot])
                best = {k: best[k] for k in hot}
                again = set()
        if best:
            yield batch_of([(*k, *x) for k, x in best.items()])

    ready = rows.filter(not_blank(F.col("entity")) & F.col("name").isNotNull() & F.col("value").isNotNull())
    return ready.select("entity", "name", "value", F.col("at").cast("timestamp_ntz").alias("at"), "seq").mapInArrow(encode, _CELLS)


def widen(cell_df: DataFrame, attributes: list[Attribute], entity: str = "entity") -> DataFrame:
    """One row per entity with a typed, nullable column per attribute, from ``cell_df (entity, col, typed, at, seq)``."""
    schema = T.StructType([T.StructField(entity, T.StringType())] + [T.StructField(a.name, _SPARK[a.value_type]) for a in attributes])
    kinds = [_ARROW[a.value_type] for a in attributes]
    names = schema.fieldNames()

    def build(t: pa.Table) -> pa.RecordBatch:
        """``t`` is sorted by entity, col and latest first and holds whole entities."""
        ent, col = t.column("entity").combine_chunks(), np.asarray(t.column("col"))
        new = np.ones(len(ent), bool)
        new[1:] = np.asarray(pc.not_equal(ent[1:], ent[:-1])) if len(ent) > 1 else []
        first = new.copy()
        first[1:] |= col[1:] != col[:-1]
        row_entity = np.cumsum(new) - 1
        n = int(row_entity[-1]) + 1
        typed = t.column("typed").combine_chunks()
        out = [ent.take(pa.array(np.flatnonzero(new)))]
        for c, kind in enumerate(kinds):
            at = np.flatnonzero(first & (col == c))
            if not len(at):
                out.append(pa.nulls(n, kind))
                continue
            slot = np.full(n, -1, np.int64)
            slot[row_entity[at]] = np.arange(len(at))
            buffer = typed.take(pa.array(at))
            buffer = buffer if kind == pa.string() else buffer.cast(kind)
            out.append(buffer.take(pa.array(slot, mask=slot < 0)))
        return pa.record_batch(out, names=names)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the first cells of the entity that is open: at most one per column
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None else t
            ent, col = t.column("entity").combine_chunks(), np.asarray(t.column("col"))
            first = np.ones(t.num_rows, bool)
            if t.num_rows > 1:
                first[1:] = np.asarray(pc.not_equal(ent[1:], ent[:-1])) | (col[1:] != col[:-1])
            t = t.filter(pa.array(first))
            ent = t.column("entity").combine_chunks()
            last = np.flatnonzero(np.asarray(pc.not_equal(ent, ent[-1])))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield build(t.slice(0, cut))
            held = t.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield build(held)

    return (
        cell_df.repartition("entity")
        .sortWithinPartitions("entity", "col", F.desc("at"), F.desc("seq"), F.desc("typed"))
        .select("entity", "col", "typed")
        .mapInArrow(stream, schema)
    )


def wide_table(rows: DataFrame, types_df: DataFrame, missing_df: DataFrame, entity: str = "entity", shipped_words: int = SHIPPED_WORDS) -> tuple[DataFrame, list[Attribute]]:
    """The wide table of ``rows (entity, name, value, at, seq)`` and its attributes; ``missing_df`` holds the missing words.

    A table of more than ``shipped_words`` missing words is not sent to the tasks: values meet it in a join on the full form.
    """
    attributes = attributes_of(types_df)
    words = missing_df.select(F.col(missing_df.columns[0]).alias("__w")).filter("__w is not null").distinct()
    shipped = [r[0] for r in words.limit(shipped_words + 1).collect()]
    if len(shipped) > shipped_words:
        forms = words.select(full_col(F.col("__w")).alias("__f")).distinct()
        rows, shipped = rows.withColumn("__f", full_col(F.col("value"))).join(forms, "__f", "left_anti").drop("__f"), []
    return widen(cells(rows, attributes, shipped), attributes, entity), attributes


def unpivot_typed(wide: DataFrame, attributes: list[Attribute], entity: str) -> DataFrame:
    """Cells of the wide table as ``(entity, attr_name, typed_text)``; empty columns give no row."""
    cell = [F.struct(F.lit(a.name).alias("attr_name"), F.col(f"`{a.name}`").cast("string").alias("typed_text")) for a in attributes]
    return wide.select(entity, F.inline(F.filter(F.array(*cell), lambda x: x["typed_text"].isNotNull())))
