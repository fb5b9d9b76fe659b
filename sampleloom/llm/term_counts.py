"""How often and in how many records every distinct term occurs.

Term and record pairs are range-partitioned by (field, term, record), so that a hot term spreads over many partitions,
sorted inside them (Spark's external sort) and scanned as runs. The ranges come from quantiles of a bounded sample;
they only balance the partitions, and every row is counted whatever they are.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleloom.functions.text import not_blank, presentation

SAMPLE_ROWS = 20_000
_PAIRS = "part int, field int, term string, record string, occurrence long, place int"
_COUNTS = "field int, term string, occurrences long, records long"
_MEMO_LIMIT = 200_000


def _boundaries(rows: DataFrame, total: int, n_parts: int, n_fields: int, seed: int = 7) -> list[tuple[int, str, str]]:
    """Quantiles of (field, term, record) over a sample of at most ``SAMPLE_ROWS`` rows."""
    share = min(1.0, SAMPLE_ROWS / max(1, total))
    sample = rows.sample(fraction=share, seed=seed).limit(2 * SAMPLE_ROWS).collect()
    keys = sorted((f, presentation(v), r["record"]) for r in sample for f in range(n_fields) for v in (r[f"f{f}"] or []) if v is not None)
    return [keys[i * len(keys) // n_parts] for i in range(1, n_parts)] if len(keys) > n_parts else []


def term_counts(rows: DataFrame, n_fields: int, n_parts: int | None = None, total: int | None = None) -> DataFrame:
    """``(field, term, occurrences, records)`` of ``rows (occurrence, record, f0, f1, ...)``, each ``f`` an array of values.

    A term is the presentation form of a value; null values, empty terms and rows with a null or blank record are left
    out. Rows with an equal ``occurrence`` are copies and count once. ``total`` is the number of rows with a record, if known.
    """
    spark = rows.sparkSession
    rows = rows.filter(not_blank(F.col("record")))
    n_parts = n_parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    bounds = _boundaries(rows, rows.count() if total is None else total, n_parts, n_fields)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, str] = {}
        for b in batches:
            fields, at, terms, places = [], [], [], []
            for f in range(n_fields):
                col = b.column(2 + f)
                parent = np.asarray(pc.list_parent_indices(col))
                flat = pc.list_flatten(col)
                code = flat.dictionary_encode()
                if len(memo) > _MEMO_LIMIT:
                    memo.clear()
                forms = []
                for v in code.dictionary.to_pylist():
                    if v not in memo:
                        memo[v] = presentation(v)
                    forms.append(memo[v])
                term = pa.array(forms, pa.string()).take(code.indices)
                keep = np.flatnonzero(np.asarray(pc.fill_null(pc.not_equal(term, ""), False)))
                start = np.r_[0, np.flatnonzero(np.diff(parent)) + 1] if len(parent) else np.zeros(0, np.int64)
                place = np.arange(len(parent)) - np.repeat(start, np.diff(np.r_[start, len(parent)])) if len(parent) else start
                fields.append(np.full(len(keep), f, np.int32))
                at.append(parent[keep])
                terms.append(term.take(pa.array(keep)))
                places.append(place[keep].astype(np.int32))
            field, row, term = np.concatenate(fields), np.concatenate(at), pa.concat_arrays(terms)
            if not len(row):
                continue
            rows_at = pa.array(row)
            record = b.column(1).take(rows_at)
            part = [bisect_right(bounds, k) for k in zip(field.tolist(), term.to_pylist(), record.to_pylist())]
            yield pa.record_batch(
                [pa.array(part, pa.int32()), pa.array(field), term, record, b.column(0).take(rows_at), pa.array(np.concatenate(places))],
                names=["part", "field", "term", "record", "occurrence", "place"],
            )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Run lengths over sorted pairs; the open run is carried from batch to batch, not its rows."""
        last: tuple | None = None  # (field, term, record, occurrence, place) of the row before
        open_run: list | None = None  # field, term, occurrences, records
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            field, term, record, occurrence, place = (b.column(i) for i in range(5))
            differs = lambda c: np.asarray(pc.not_equal(c[1:], c[:-1])) if n > 1 else np.zeros(0, bool)
            new_term, new_record, new_row = np.ones(n, bool), np.ones(n, bool), np.ones(n, bool)
            new_term[1:] = differs(field) | differs(term)
            new_record[1:] = new_term[1:] | differs(record)
            new_row[1:] = new_record[1:] | differs(occurrence) | differs(place)
            head = tuple(c[0].as_py() for c in (field, term, record, occurrence, place))
            if last is not None:
                new_term[0] = head[:2] != last[:2]
                new_record[0] = head[:3] != last[:3]
                new_row[0] = head != last
            run = np.cumsum(new_term) - new_term[0]
            k = int(run[-1]) + 1
            occurrences = np.bincount(run, weights=new_row, minlength=k).astype(np.int64)
            records = np.bincount(run, weights=new_record, minlength=k).astype(np.int64)
            heads = np.flatnonzero(new_term)
            if not new_term[0]:
                open_run[2] += int(occurrences[0])
                open_run[3] += int(records[0])
                occurrences, records = occurrences[1:], records[1:]
            if len(heads):
                f, t = np.asarray(field)[heads], term.take(pa.array(heads))
                if open_run is not None:
                    f = np.r_[open_run[0], f].astype(np.int32)
                    t = pa.concat_arrays([pa.array([open_run[1]], pa.string()), t.cast(pa.string())])
                    occurrences, records = np.r_[open_run[2], occurrences], np.r_[open_run[3], records]
                open_run = [int(f[-1]), t[-1].as_py(), int(occurrences[-1]), int(records[-1])]
                if len(f) > 1:
                    yield pa.record_batch([pa.array(f[:-1], pa.int32()), t[:-1], pa.array(occurrences[:-1]), pa.array(records[:-1])], names=["field", "term", "occurrences", "records"])
            last = tuple(c[n - 1].as_py() for c in (field, term, record, occurrence, place))
        if open_run is not None:
            yield pa.record_batch([pa.array([open_run[0]], pa.int32()), pa.array([open_run[1]], pa.string()), pa.array([open_run[2]], pa.int64()), pa.array([open_run[3]], pa.int64())], names=["field", "term", "occurrences", "records"])

    columns = ["occurrence", "record", *(f"f{i}" for i in range(n_fields))]
    spread = rows.select(*columns).mapInArrow(pairs, _PAIRS).repartitionById(n_parts, "part")
    order = ["field", "term", "record", "occurrence", "place"]
    runs = spread.sortWithinPartitions(*order).select(*order).mapInArrow(scan, _COUNTS)
    # a term whose run crosses a range boundary has one partial count on either side
    return runs.groupBy("field", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def mark_terms(counts: DataFrame, n_records: int, rare_below: int = 3, common_above: float = 0.02) -> DataFrame:
    """Adds ``mark``: ``rare`` under ``rare_below`` records, ``common`` over that share of all records, else null."""
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") > F.lit(common_above * n_records), "common")
    return counts.withColumn("mark", mark)
