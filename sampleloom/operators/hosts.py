"""Host standardisation: exact tiers, whole-word containment, forced and rejected values, ranking.

Values are matched once per distinct normal form and joined back. The containment join is an equi join on the rarest word
of a term: a term is inside a value if all its distinct words are, so no pairs are formed but of values and terms that share
that word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.operators.ranking import dimension

# Tiers of exact terms with their scores, scores of contained terms, attribute ranks.
TIERS = (("scientific_name", 1.0), ("synonym", 1.0), ("curated", 0.95), ("genbank_common_name", 0.9), ("common_name", 0.7))
MULTIWORD_SCORE, SINGLEWORD_SCORE = 0.7, 0.5
ATTRIBUTE_RANK = {"host_taxid": 1, "host": 2}
OTHER_RANK = 3


def term_table(taxa: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    """All terms of ``taxa``: ``(norm_term, tier, score, taxid, scientific_name, table_priority, pos, for_subset)``.

    ``taxa`` has an explicit ``table_priority``; ``curated (taxid, term, allow_subset)`` adds curated terms.
    """
    listed = [F.array("scientific_name"), S.semi_split(F.col("synonym")), None, S.semi_split(F.col("genbank_common_name")), S.semi_split(F.col("common_name"))]
    base = ["taxid", "scientific_name", "table_priority", "rank"]
    parts = []
    for i, ((name, score), cells) in enumerate(zip(TIERS, listed), 1):
        if cells is not None:
            rows = taxa.select(*base, F.posexplode(cells).alias("pos", "term"), (F.lower("rank") != "subspecies").alias("for_subset"))
        elif curated is not None:
            rows = taxa.select(*base).join(dimension(curated), "taxid").select(*base, F.lit(0).alias("pos"), "term", F.col("allow_subset").alias("for_subset"))
        else:
            continue
        parts.append(rows.select(S.norm_host(F.col("term")).alias("norm_term"), F.lit(i).alias("tier"), F.lit(score).alias("score"), "taxid", "scientific_name", "table_priority", "pos", "for_subset"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("norm_term <> ''")


def _winner(terms: DataFrame) -> DataFrame:
    best = F.min(F.struct("tier", "table_priority", "pos", "score", "taxid", "scientific_name"))
    return terms.groupBy("norm_term").agg(best.alias("b")).select("norm_term", "b.*")


def exact_terms(terms: DataFrame) -> DataFrame:
    """One row per term: its best tier, inside a tier the earliest taxon of the table."""
    return _winner(terms)


def word_index(terms: DataFrame) -> DataFrame:
    """``(word, norm_term, words, n_raw, taxid, ...)`` of the terms that may be found inside a value, each under its rarest word.

    So no term meets a value for the sake of a word that many terms have.
    """
    words = F.split("norm_term", " ")
    best = _winner(terms.filter("for_subset")).select("*", F.array_distinct(words).alias("words"), F.size(words).alias("n_raw"))
    each = best.select("norm_term", F.explode("words").alias("word"))
    often = each.groupBy("word").agg(F.count("*").alias("n"))
    rarest = each.join(often, "word").groupBy("norm_term").agg(F.min(F.struct("n", "word"))["word"].alias("word"))
    return best.join(rarest, "norm_term").select("word", "norm_term", "words", "n_raw", "taxid", "scientific_name", "table_priority")


def normal_value(value: Column, ignored: Sequence[str]) -> Column:
    return S.norm_host(S.strip_substrings(S.strip(F.coalesce(value, F.lit(""))), ignored))


def contained_terms(values: DataFrame, index: DataFrame) -> DataFrame:
    """Taxa whose term is inside ``values (norm)``: ``(norm, score, match_tier, taxid, scientific_name, table_priority, names)``.

    Terms of several words win over single words. A term with more words than the value is left out. Of several taxa the
    earliest of the table is taken and all names are kept in ``names``.
    """
    words = S.words_of(F.col("norm"))
    read = values.select("norm", F.size(words).alias("n_value"), S.digit_variants(F.array_distinct(words)).alias("read"))
    hit = read.select("*", F.explode("read").alias("word")).join(dimension(index), "word")
    whole = hit.filter((F.size(F.array_except("words", "read")) == 0) & ((F.col("n_raw") == 1) | (F.col("n_raw") <= F.col("n_value"))))
    taxon = F.struct("table_priority", "taxid", "scientific_name")
    g = whole.groupBy("norm").agg(F.collect_set(F.when(F.col("n_raw") > 1, taxon)).alias("many"), F.collect_set(F.when(F.col("n_raw") == 1, taxon)).alias("single"))
    multi = F.size("many") > 0
    pick = g.select("norm", F.when(multi, F.col("many")).otherwise(F.col("single")).alias("t"), F.when(multi, MULTIWORD_SCORE).otherwise(SINGLEWORD_SCORE).alias("score"), F.when(multi, "multi-word").otherwise("single-word").alias("match_tier"))
    best = F.array_min("t")
    names = F.array_sort(F.transform("t", lambda x: x["scientific_name"]))
    return pick.select("norm", "score", "match_tier", best["taxid"].alias("taxid"), best["scientific_name"].alias("scientific_name"), best["table_priority"].alias("table_priority"), F.when(F.size("t") > 1, names).otherwise(S.none_of()).alias("names"))


def match_values(values: DataFrame, taxa: DataFrame, terms: DataFrame) -> DataFrame:
    """Best match of each distinct ``values (norm, by_taxid)``; a number only counts as a taxid where that is meant."""
    keys = values.filter("norm <> ''").distinct()
    number = F.col("norm").rlike(r"\A[0-9]+\z")
    cols = ["taxid", "scientific_name", "table_priority", "score", "match_tier", "names"]
    plain = lambda df, score: df.select("norm", "by_taxid", "taxid", "scientific_name", "table_priority", score.alias("score"), F.lit("").alias("match_tier"), S.none_of().alias("names"))
    by_id = dimension(taxa.select(F.col("taxid").cast("string").alias("norm"), "taxid", "scientific_name", "table_priority"))
    numbers = plain(keys.filter(number & F.col("by_taxid")).join(by_id, "norm"), F.lit(1.0))
    texts = keys.filter(~number)
    exact_dim = dimension(exact_terms(terms).withColumnRenamed("norm_term", "norm"))
    exact = plain(texts.join(exact_dim, "norm"), F.col("score"))
    rest = texts.join(exact_dim.select("norm"), "norm", "left_anti")
    inside = rest.join(contained_terms(rest.select("norm").distinct(), word_index(terms)), "norm").select("norm", "by_taxid", *cols)
    return numbers.unionByName(exact).unionByName(inside)


def keyword_hit(values: Column, keywords: Sequence[str]) -> Column:
    """The first keyword, by value and then by keyword, all of whose words are in one value; null if none is."""
    listed = F.array(*[F.struct(F.lit(k).alias("k"), F.split(S.norm_host(F.lit(k)), " ").alias("w")) for k in keywords])
    per_value = F.transform(values, lambda v: F.transform(F.array(S.words_of(S.norm_host(v))), lambda ws: F.filter(listed, lambda k: F.size(F.array_except(k["w"], ws)) == 0))[0])
    return F.try_element_at(F.transform(F.flatten(per_value), lambda k: k["k"]), F.lit(1))


def decisions(cands: DataFrame, preempt: DataFrame) -> DataFrame:
    """``(record, rejected, forced, forced_pos)`` of ``cands (record, pos, value)``: a rejection anywhere wins, else the first forced value."""
    hits = cands.withColumn("norm_value", S.norm_host(F.col("value"))).join(dimension(preempt), "norm_value")
    forced = F.min(F.when(F.col("taxid").isNotNull(), F.struct("pos", "taxid")))
    return hits.groupBy("record").agg(F.bool_or(F.col("taxid").isNull()).alias("rejected"), forced["taxid"].alias("forced"), forced["pos"].alias("forced_pos"))


def rank_of(attribute: Column) -> Column:
    a = F.lower(attribute)
    out = F.when(a == "host_taxid", ATTRIBUTE_RANK["host_taxid"])
    return out.when(a == "host", ATTRIBUTE_RANK["host"]).otherwise(OTHER_RANK)


def _candidate() -> Column:
    """A matched row as a struct that orders by score, earlier taxon of the table, attribute rank and position."""
    return F.struct((-F.col("score")).alias("neg"), "table_priority", rank_of(F.col("attribute")).alias("rank"), "pos", "taxid", "scientific_name", "score", "attribute", "value", "match_tier", "names")


_SEVERAL = "min(taxid) <> max(taxid)"


def _flags() -> tuple[Column, Column]:
    """Whether the best candidate ``b`` of a record is uncertain, and why."""
    subset, ambiguous = F.col("b.match_tier") != "", F.size("b.names") > 0
    why = F.filter(F.array(F.when(subset, "subset_match"), F.when(ambiguous, "ambiguous_subset"), F.when(F.col("several"), "attribute_disagreement")), lambda x: x.isNotNull())
    return subset | ambiguous | F.col("several"), why


def best_candidate(matched: DataFrame) -> DataFrame:
    """Winner of each record among ``matched (record, pos, attribute, value, ...match)`` with its flags, by partial aggregation.

    Higher score, then earlier taxon of the table, then attribute rank, then position.
    """
    g = matched.groupBy("record").agg(F.min(_candidate()).alias("b"), F.expr(_SEVERAL).alias("several"))
    low, why = _flags()
    return g.select("record", "b.taxid", "b.scientific_name", "b.score", "b.pos", "b.attribute", "b.value", "b.match_tier", low.alias("low_confidence"), why.alias("flags"))


def standardize_hosts(cands: DataFrame, taxa: DataFrame, preempt: DataFrame, ignored: Sequence[str], keywords: Sequence[str], curated: DataFrame | None = None) -> DataFrame:
    """Host of each record of ``cands (record, pos, attribute, value)``, values in reading order.

    Output: record, taxid, scientific_name, score, low_confidence, attribute, value, diagnostics, overflow (the record goes
    on to the isolation step). Without ``keywords`` this is the retry. Null values count as empty.
    """
    rows = cands.select("record", "pos", S.strip(F.coalesce("attribute", F.lit(""))).alias("attribute"), F.coalesce("value", F.lit("")).alias("value"))
    keyword = keyword_hit(F.array("value"), keywords).isNotNull() if keywords else F.lit(False)
    # all that is said of a row stands on it before the one grouping by record
    keyed = rows.select("*", normal_value(F.col("value"), ignored).alias("norm"), (F.lower("attribute") == "host_taxid").alias("by_taxid"), S.norm_host(F.col("value")).alias("norm_value"), keyword.alias("keyword"))
    said = dimension(preempt.select("norm_value", F.col("taxid").alias("__forced"), F.lit(True).alias("__said")))
    matched = match_values(keyed.select("norm", "by_taxid"), taxa, term_table(taxa, curated))
    j = keyed.join(said, "norm_value", "left").join(matched, ["norm", "by_taxid"], "left")
    g = j.groupBy("record").agg(
        F.bool_or("keyword").alias("keyword"), F.bool_or(S.strip(F.col("value")) != "").alias("has_value"), F.bool_or(F.coalesce("__said", F.lit(False)) & F.col("__forced").isNull()).alias("rejected"),
        F.min(F.when(F.col("__forced").isNotNull(), F.struct("pos", F.col("__forced").alias("forced"), "attribute", S.strip(F.col("value")).alias("value")))).alias("f"),
        F.min(F.when(F.col("taxid").isNotNull(), _candidate())).alias("b"), F.expr(_SEVERAL).alias("several"),
    )
    low, why = _flags()
    out = g.select(
        "record", "keyword", "has_value", "rejected", F.col("f.forced").alias("forced"), F.col("f.attribute").alias("__fa"), F.col("f.value").alias("__fv"), "b.taxid", "b.scientific_name", "b.score", "b.attribute", "b.value",
        low.alias("low_confidence"), why.alias("flags"),
    )
    names = dimension(taxa.select(F.col("taxid").alias("forced"), F.col("scientific_name").alias("__fn")))
    out = out.join(names, "forced", "left")
    keyword, rejected = F.col("keyword"), F.col("rejected")
    forced = ~keyword & ~rejected & F.col("forced").isNotNull()
    usual = ~keyword & ~rejected & F.col("forced").isNull() & F.col("taxid").isNotNull()
    pick = lambda f, u: F.when(forced, f).when(usual, u)
    diagnosis = F.when(keyword, "iso_keyword_preemption").when(rejected, "override_rejection").when(forced, "forced_override").when(usual, "matched").otherwise("unmatched")
    return out.select(
        "record", pick(F.col("forced"), F.col("taxid")).alias("taxid"), pick(F.col("__fn"), F.col("scientific_name")).alias("scientific_name"), pick(F.lit(1.0), F.col("score")).alias("score"),
        F.coalesce(F.when(usual, F.col("low_confidence")), F.lit(False)).alias("low_confidence"), pick(F.col("__fa"), F.col("attribute")).alias("attribute"), pick(F.col("__fv"), S.strip(F.col("value"))).alias("value"),
        F.concat(F.array(diagnosis), F.when(usual, F.col("flags")).otherwise(S.none_of())).alias("diagnostics"), (~forced & ~usual & F.col("has_value")).alias("overflow"),
    )
