"""Ranking, dedupe and bounded examples without gathering a group."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows up to which a dimension is sent to every executor; beyond it the join shuffles.
BROADCAST_ROWS = 100_000


def is_local(df: DataFrame) -> bool:
    """True if the rows of ``df`` are part of its plan, so that their number is known."""
    return df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LocalRelation"


def local_frame(spark: SparkSession, rows: pa.Table, schema: StructType | str) -> DataFrame:
    """A few rows as part of the plan, without a job to make them."""
    return spark.createDataFrame(rows, schema)


def dimension(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` for a broadcast join if it has at most ``limit`` rows, else as it is.

    It is computed here, once: up to ``limit`` rows and one more come to the driver and then stand in the plan as they are,
    so nothing of ``df`` is counted first and computed again by the join.
    """
    if is_local(df):
        return F.broadcast(df)
    rows = df.limit(limit + 1).toArrow()
    return F.broadcast(local_frame(df.sparkSession, rows, df.schema)) if rows.num_rows <= limit else df


def top_rows(rows: DataFrame, group: list[str], order: list[Column | str], k: int, rank: str = "r") -> DataFrame:
    """The first ``k`` rows of each group. Spark limits each group before the shuffle, so a hot group sends ``k`` rows a task."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def top_examples(rows: DataFrame, group: list[str], order: list[str], k: int, counts: DataFrame | None = None) -> DataFrame:
    """``(group..., n, examples)``: rows of each group (or ``counts (group..., n)``) and its first ``k`` as structs."""
    first = top_rows(rows, group, order, k).groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("examples"))
    n = counts if counts is not None else rows.groupBy(*group).agg(F.count("*").alias("n"))
    return n.join(first, group)


def first_by(rows: DataFrame, key: list[str], order: list[str], values: list[str], last: bool = False) -> DataFrame:
    """One row per key: the values of its first (or last) row in ``order``, by partial aggregation."""
    pick = (F.max if last else F.min)(F.struct(*order, *values))
    return rows.groupBy(*key).agg(pick.alias("__p")).select(*key, *[F.col(f"__p.{v}").alias(v) for v in values])
