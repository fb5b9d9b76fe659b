"""Dates of records from candidate rows, by partial aggregation: no record's candidates are gathered but to list a conflict."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleloom.functions import dates as D
from sampleloom.session import cut


def reduce_dates(cands: DataFrame, reference_date: dt.date) -> DataFrame:
    """Outcome of each record of ``cands (record, pos, attribute, value, category)``.

    Output: record, start, end, score, attributes, values (joined by double pipes), diagnostics. The rules are those of
    :func:`sampleloom.functions.dates.standardize_dates`. The origins of records whose sampling candidates differ are the
    only lists that are gathered, distinct pairs first.
    """
    read = F.inline(F.array(D.interpret(F.col("value"), F.lit(reference_date))))
    rows = cut(cands.select("record", "pos", "attribute", "value", "category", read).select("record", "pos", "attribute", "value", "category", "status", "start", "end", "score"))
    ok = F.col("status") == "ok"
    s, o = ok & (F.col("category") == "s"), ok & (F.col("category") == "o")
    bounds = F.when(s, F.struct("start", "end"))
    g = rows.groupBy("record").agg(
        F.count_if(s).alias("n"), (F.min(bounds) != F.max(bounds)).alias("conflict"), F.min(F.when(s, F.col("start"))).alias("s_start"), F.max(F.when(s, F.col("end"))).alias("s_end"), F.min(F.when(s, F.col("score"))).alias("s_score"),
        F.min(F.when(s, F.struct("pos", "attribute", "value"))).alias("s_first"), F.min(F.when(o, F.struct("start", "pos", "end", "attribute", "value"))).alias("o_first"),
    )
    differ = g.filter("conflict").select("record")
    pairs = rows.filter(s).join(differ, "record", "left_semi").groupBy("record", "attribute", "value").agg(F.min("pos").alias("pos"))
    listed = pairs.groupBy("record").agg(F.array_sort(F.collect_list(F.struct("pos", "attribute", "value"))).alias("all"))
    j = g.join(listed, "record", "left")
    sampled, fallback, conflict = F.col("n") > 0, F.col("o_first").isNotNull(), F.coalesce("conflict", F.lit(False))
    pick = lambda f: F.when(conflict, F.array_join(f"all.{f}", "||")).when(sampled, F.col(f"s_first.{f}")).when(fallback, F.col(f"o_first.{f}")).otherwise("")
    more = F.when(conflict, "conflicting_candidate_combination").when(F.col("n") > 1, "equivalent_candidate_collapse")
    how = F.when(sampled, "sampling_selection").when(fallback, "fallback_selection").otherwise("no_usable_candidate")
    return j.select(
        "record", F.when(sampled, F.col("s_start")).otherwise(F.col("o_first.start")).alias("start"), F.when(sampled, F.col("s_end")).otherwise(F.col("o_first.end")).alias("end"),
        F.when(conflict, D.width_score(F.col("s_start"), F.col("s_end"))).when(sampled, F.col("s_score")).when(fallback, D.FALLBACK_SCORE).alias("score"),
        pick("attribute").alias("attributes"), pick("value").alias("values"), F.filter(F.array(more, how), lambda x: x.isNotNull()).alias("diagnostics"),
    )
