"""Incremental runs, an extension: the same column functions over streams of candidate rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sampleloom.functions import dates as D
from sampleloom.operators.curation import CurationRules, curate


def curate_stream(rows: DataFrame, rules: CurationRules, key: str = "decision_id", at: str = "loaded_at", late: str = "1 day") -> DataFrame:
    """Decisions on streamed candidates; copies of a row inside the watermark are one, as is anything later than it lost."""
    return curate(rows.withWatermark(at, late).dropDuplicatesWithinWatermark([key]), rules)


def date_stream(rows: DataFrame, reference_date: dt.date) -> DataFrame:
    """Streamed ``(record, value)`` rows with their bounds; stateless."""
    return rows.withColumn("bounds", D.interpret(F.col("value"), reference_date))


def event_counts(decisions: DataFrame, at: str = "loaded_at", window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events of each kind and target per window of event time."""
    e = decisions.withWatermark(at, late).select(F.col(at).alias("at"), F.explode("events").alias("e"))
    return e.groupBy(F.window("at", window), F.col("e.kind").alias("kind"), F.col("e.target").alias("target")).agg(F.count("*").alias("n"))


def write_batches(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All that is available now, each batch once: a batch that runs again replaces its own folder."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
