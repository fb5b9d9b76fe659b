"""Queries of curation, index, project and tree operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.functions.text import full_col, presentation_col
from sampleloom.operators import curation as C
from sampleloom.operators import index as X
from sampleloom.operators import lineage as L
from sampleloom.operators.ranking import dimension, first_by
from sampleloom.plans import seeds
from sampleloom.plans.folding import NAME_FORMS, VALUE_FORMS, simple_form
from sampleloom.sources import projects as P
from sampleloom.session import spread, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


REG = seeds.values(seeds.REGISTRY, seeds.REGISTRY_COLUMNS, "registry")
NODES = seeds.values(seeds.NODES, seeds.NODES_COLUMNS, "nodes")


def registry(spark):
    return seeds.frame(spark, seeds.REGISTRY, seeds.REGISTRY_COLUMNS)


# ---- index -----------------------------------------------------------------------------------------------------------

_IDX = "(SELECT DISTINCT * FROM accession_index)"


def _index(spark, d):
    return table(spark, d, "accession_index").distinct()


@query(f"SELECT accession, arg_max(pathogen_biosample, (first_seen, pathogen_biosample)) AS pathogen FROM {_IDX} WHERE trim(accession) <> '' AND trim(pathogen_biosample) <> '' GROUP BY accession")
def index_map(spark, d):
    return X.last_wins(_index(spark, d), "accession", "pathogen_biosample", ["first_seen"]).withColumnRenamed("pathogen_biosample", "pathogen")


@query("SELECT DISTINCT pathogen_atb AS pathogen, accession FROM accession_index WHERE in_atb = 'True' AND trim(accession) <> '' AND trim(pathogen_atb) <> ''")
def atb_membership(spark, d):
    return X.membership(table(spark, d, "accession_index"), "in_atb", "accession", "pathogen_atb").withColumnRenamed("pathogen_atb", "pathogen")


@query(f"WITH {REG} SELECT DISTINCT key FROM registry WHERE key IN (SELECT pathogen_biosample FROM accession_index)")
def discover_keys(spark, d):
    return registry(spark).select("key").join(table(spark, d, "accession_index").select(F.col("pathogen_biosample").alias("key")), "key", "left_semi").distinct().orderBy("key")


_LABELS = (
    "labels AS (SELECT DISTINCT organism_value AS label FROM accession_index), parts AS (SELECT label, list_filter(regexp_split_to_array(trim(coalesce(label, '')), '\\s+'), lambda w: w <> '') AS w FROM labels), "
    "tok AS (SELECT label, lower(regexp_replace(w[1], '_[A-Z]+$', '')) AS g, lower(regexp_replace(w[2], '_[A-Z]+$', '')) AS s FROM parts), "
    "mapped AS (SELECT label, coalesce(a.key, b.key, 'NA') AS key FROM tok LEFT JOIN registry a ON a.rank <> 'genus' AND split_part(lower(a.scientific_name), ' ', 1) = g AND split_part(lower(a.scientific_name), ' ', 2) = s "
    "LEFT JOIN registry b ON b.rank = 'genus' AND split_part(lower(b.scientific_name), ' ', 1) = g)"
)


def _mapped(spark, d):
    return X.map_labels(table(spark, d, "accession_index").select(F.col("organism_value").alias("label")), registry(spark))


@query(f"WITH {REG}, {_LABELS} SELECT label, key FROM mapped")
def label_fallback_join(spark, d):
    return _mapped(spark, d)


@query(f"WITH {REG}, {_LABELS} SELECT DISTINCT accession, key FROM accession_index JOIN mapped ON label = organism_value WHERE key <> 'NA'")
def scope_from_labels(spark, d):
    keys = dimension(_mapped(spark, d).filter("key <> 'NA'").withColumnRenamed("label", "organism_value"))
    return table(spark, d, "accession_index").join(keys, "organism_value").select("accession", "key").distinct()


@query("SELECT accession, key, count(*) AS n FROM (SELECT accession, pathogen_biosample AS key FROM accession_index UNION ALL SELECT accession, pathogen_atb FROM accession_index) WHERE key <> 'NA' GROUP BY accession, key")
def idlist_union(spark, d):
    t = table(spark, d, "accession_index")
    both = t.select("accession", F.col("pathogen_biosample").alias("key")).unionByName(t.select("accession", F.col("pathogen_atb").alias("key")))
    return both.filter("key <> 'NA'").groupBy("accession", "key").agg(F.count("*").alias("n"))


@query("SELECT accession, arg_min(organism_value, (pathogen_biosample, first_seen, coalesce(organism_value, ''))) AS organism_value FROM accession_index GROUP BY accession")
def first_wins(spark, d):
    t = table(spark, d, "accession_index").withColumn("__o", F.coalesce("organism_value", F.lit("")))
    return first_by(t, ["accession"], ["pathogen_biosample", "first_seen", "__o"], ["organism_value"])


@query("SELECT bioproject_accession AS key, count(DISTINCT xml_source) AS n FROM curation_decisions GROUP BY 1 HAVING count(DISTINCT coalesce(xml_source, '-')) > 1 AND count(DISTINCT xml_source) > 1")
def dup_keys(spark, d):
    rows = table(spark, d, "curation_decisions").filter("xml_source is not null").withColumnRenamed("bioproject_accession", "key")
    return X.conflicting_keys(rows, "key", "xml_source")


_OUTER = (
    f"one AS (SELECT accession, min((coalesce(pathogen_biosample, ''), coalesce(taxid, ''), coalesce(organism_value, ''), coalesce(in_atb, ''), coalesce(osf_tarball_filename, ''))) AS r FROM accession_index GROUP BY accession), "
    "scope AS (SELECT accession, r[1] AS pathogen, r[2] AS taxid, r[3] AS organism FROM one WHERE r[1] <> 'NA'), cat AS (SELECT accession, r[3] AS label, r[5] AS tarball FROM one WHERE r[4] = 'True'), "
    "idx AS (SELECT coalesce(s.accession, c.accession) AS accession, CASE WHEN c.accession IS NOT NULL THEN 'True' ELSE 'False' END AS in_atb, coalesce(nullif(s.pathogen, ''), 'NA') AS pathogen_biosample, coalesce(m.key, 'NA') AS pathogen_atb, "
    "coalesce(nullif(s.taxid, ''), 'NA') AS taxid, coalesce(nullif(s.organism, ''), 'NA') AS organism_value, coalesce(nullif(c.tarball, ''), 'NA') AS osf_tarball_filename FROM scope s FULL JOIN cat c ON s.accession = c.accession LEFT JOIN mapped2 m ON m.label = c.label WHERE s.accession IS NOT NULL OR coalesce(m.key, 'NA') <> 'NA')"
)
_OUTER_SQL = f"WITH {REG}, {_LABELS}, mapped2 AS (SELECT label, key FROM mapped), {_OUTER} "


def _outer(spark, d):
    v = lambda c: F.coalesce(c, F.lit(""))
    one = table(spark, d, "accession_index").groupBy("accession").agg(F.min(F.struct(v("pathogen_biosample").alias("pathogen"), v("taxid").alias("taxid"), v("organism_value").alias("organism"), v("in_atb").alias("in_atb"), v("osf_tarball_filename").alias("tarball"))).alias("r")).select("accession", "r.*")
    scope, cat = one.filter("pathogen <> 'NA'"), one.filter("in_atb = 'True'").withColumnRenamed("organism", "label")
    return X.outer_index(scope, cat, _mapped(spark, d))


@query(_OUTER_SQL + "SELECT * FROM idx")
def index_full_outer(spark, d):
    return _outer(spark, d).orderBy("accession")


@query(
    _OUTER_SQL
    + "SELECT count(*) AS rows, count_if(pathogen_biosample <> 'NA' AND pathogen_atb = 'NA') AS only_taxonomy, count_if(pathogen_biosample = 'NA' AND pathogen_atb <> 'NA') AS only_catalog, count_if(pathogen_biosample <> 'NA' AND pathogen_atb <> 'NA') AS both, "
    "count_if(in_atb = 'True') AS in_catalog, count_if(pathogen_biosample = 'NA') AS biosample_na, count_if(pathogen_atb = 'NA') AS atb_na FROM idx"
)
def index_counts(spark, d):
    return X.index_counts(_outer(spark, d))


@query("SELECT DISTINCT i.accession, i.pathogen_biosample AS pathogen, EXISTS (SELECT 1 FROM accession_index j WHERE j.in_atb = 'True' AND j.accession = i.accession AND j.pathogen_atb = i.pathogen_biosample) AS in_atb FROM accession_index i")
def exists_flag(spark, d):
    t = table(spark, d, "accession_index")
    member = X.membership(t, "in_atb", "accession", "pathogen_atb").select("accession", F.col("pathogen_atb").alias("pathogen"), F.lit(True).alias("__in"))
    rows = t.select("accession", F.col("pathogen_biosample").alias("pathogen")).distinct()
    return rows.join(member, ["accession", "pathogen"], "left").select("accession", "pathogen", F.coalesce("__in", F.lit(False)).alias("in_atb"))


@query(f"WITH {REG} SELECT DISTINCT i.accession, i.pathogen_biosample AS key, coalesce(r.scientific_name, '') AS scientific_name FROM accession_index i LEFT JOIN registry r ON r.key = i.pathogen_biosample")
def key_to_name(spark, d):
    names = dimension(registry(spark).select("key", "scientific_name"))
    rows = table(spark, d, "accession_index").select("accession", F.col("pathogen_biosample").alias("key")).distinct()
    return rows.join(names, "key", "left").select("accession", "key", F.coalesce("scientific_name", F.lit("")).alias("scientific_name"))


_TAX, _ATB = "SELECT accession FROM accession_index WHERE pathogen_biosample <> 'NA'", "SELECT accession FROM accession_index WHERE pathogen_atb <> 'NA'"


def _sides(spark, d):
    t = table(spark, d, "accession_index")
    return t.filter("pathogen_biosample <> 'NA'").select("accession"), t.filter("pathogen_atb <> 'NA'").select("accession")


@query(f"{_TAX} UNION {_ATB}")
def set_union(spark, d):
    a, b = _sides(spark, d)
    return a.union(b).distinct()


@query(f"{_TAX} INTERSECT {_ATB}")
def set_intersect(spark, d):
    a, b = _sides(spark, d)
    return a.intersect(b)


@query(f"SELECT 'taxonomy' AS only_in, accession FROM ({_TAX} EXCEPT {_ATB}) UNION ALL SELECT 'catalog', accession FROM ({_ATB} EXCEPT {_TAX})")
def set_except(spark, d):
    a, b = _sides(spark, d)
    return a.subtract(b).select(F.lit("taxonomy").alias("only_in"), "accession").unionByName(b.subtract(a).select(F.lit("catalog").alias("only_in"), "accession"))


@query(f"SELECT DISTINCT c.accession, c.accession IN ({_TAX}) AS by_taxonomy, c.accession IN ({_ATB}) AS by_catalog FROM curation_decisions c WHERE c.accession IN ({_TAX}) OR c.accession IN ({_ATB})")
def scope_or(spark, d):
    a, b = _sides(spark, d)
    ids = table(spark, d, "curation_decisions").select("accession").distinct()
    j = ids.join(a.distinct().withColumn("t", F.lit(True)), "accession", "left").join(b.distinct().withColumn("c", F.lit(True)), "accession", "left")
    return j.filter("t or c").select("accession", F.coalesce("t", F.lit(False)).alias("by_taxonomy"), F.coalesce("c", F.lit(False)).alias("by_catalog"))


# ---- trees -----------------------------------------------------------------------------------------------------------

_SEEDS = [(90010, "pilosa", 0), (90012, "ursids", 1), (90014, "natants", 2)]
_SEED_COLUMNS = "taxid long, key string, ordinal int"
SEEDS = seeds.values(_SEEDS, _SEED_COLUMNS, "seeds")
_MERGED = [(50001, 91003), (50002, 91005), (91001, 91002), (50003, 1)]
MERGED = seeds.values(_MERGED, "old long, new long", "merged")
_HEAP = "heap AS (SELECT p_partkey AS taxid, p_partkey // 4 AS parent FROM part)"
_WALK = "walk AS (SELECT n.taxid, s.ordinal, s.key FROM nodes n JOIN seeds s USING (taxid) UNION SELECT n.taxid, w.ordinal, w.key FROM nodes n JOIN walk w ON n.parent = w.taxid WHERE n.taxid <> n.parent), closed AS (SELECT taxid, arg_min(key, ordinal) AS key FROM walk GROUP BY taxid)"


def _nodes(spark):
    return seeds.frame(spark, seeds.NODES, seeds.NODES_COLUMNS)


@query(
    f"WITH RECURSIVE {_HEAP}, seeds(taxid, key, ordinal) AS (VALUES (2, 'a', 0), (3, 'b', 1), (9, 'c', 2), (11, 'd', 3)), walk AS (SELECT h.taxid, s.ordinal, s.key FROM heap h JOIN seeds s USING (taxid) UNION SELECT h.taxid, w.ordinal, w.key FROM heap h JOIN walk w ON h.parent = w.taxid) "
    "SELECT taxid, arg_min(key, ordinal) AS key FROM walk GROUP BY taxid"
)
def closure(spark, d):
    heap = table(spark, d, "part").select(F.col("p_partkey").alias("taxid"), F.floor(F.col("p_partkey") / 4).cast("long").alias("parent"))
    # node 1 is the root here as in a taxonomy, so its children are the top of the paths
    return L.closure(heap, spark.createDataFrame([(2, "a", 0), (3, "b", 1), (9, "c", 2), (11, "d", 3)], _SEED_COLUMNS))


@query(f"WITH RECURSIVE {NODES}, {SEEDS}, {MERGED}, {_WALK} SELECT taxid, key FROM closed UNION ALL SELECT old, key FROM merged JOIN closed ON taxid = new WHERE old NOT IN (SELECT taxid FROM closed)")
def merged_ids(spark, d):
    closed = L.closure(_nodes(spark), spark.createDataFrame(_SEEDS, _SEED_COLUMNS))
    return L.with_retired(closed, spark.createDataFrame(_MERGED, "old long, new long"))


_RANKS = ", ".join(f"'{r}'" for r in L.RANKS)


@query(
    f"WITH RECURSIVE {NODES}, up AS (SELECT taxid, taxid AS a, 0 AS depth FROM nodes WHERE taxid <> 1 UNION ALL SELECT u.taxid, n.parent, u.depth + 1 FROM up u JOIN nodes n ON n.taxid = u.a WHERE n.parent <> 1) "
    f"SELECT n.taxid, 'common ' || lower(n.name) AS common_names, coalesce(string_agg(m.name, ',' ORDER BY u.depth DESC), '') AS lineage_names, coalesce(string_agg(CAST(m.taxid AS VARCHAR), ',' ORDER BY u.depth DESC), '') AS lineage_taxids "
    f"FROM nodes n LEFT JOIN up u ON u.taxid = n.taxid LEFT JOIN nodes m ON m.taxid = u.a AND m.rank IN ({_RANKS}) GROUP BY n.taxid, n.name"
)
def lineage(spark, d):
    n = _nodes(spark)
    return L.lineages(n, n.select("taxid", "name", F.array(F.concat(F.lit("common "), F.lower("name"))).alias("common_names")))


@query(
    "WITH l AS (SELECT p_partkey AS line_no, p_partkey % 500 AS taxid, p_name || ' ' || p_size AS name, p_partkey % 3 = 0 AS sci FROM part), c AS (SELECT taxid, name, line_no AS l FROM l WHERE NOT sci), "
    "k AS (SELECT taxid, string_agg(name, '|' ORDER BY l) AS names FROM c GROUP BY taxid), s AS (SELECT taxid, arg_min(name, line_no) AS name FROM l WHERE sci GROUP BY taxid) SELECT t.taxid, s.name, coalesce(k.names, '') AS common_names FROM (SELECT DISTINCT taxid FROM l) t LEFT JOIN s USING (taxid) LEFT JOIN k USING (taxid)"
)
def taxonomy_scan(spark, d):
    from sampleloom.sources.tables import names_of

    name = F.concat("p_name", F.lit(" "), F.col("p_size").cast("string"))
    named = table(spark, d, "part").select(F.col("p_partkey").alias("line_no"), (F.col("p_partkey") % 500).alias("taxid"), name.alias("name"), F.when(F.col("p_partkey") % 3 == 0, "scientific name").otherwise("common name").alias("kind"))
    return names_of(named).select("taxid", "name", F.array_join("common_names", "|").alias("common_names"))


# ---- curation --------------------------------------------------------------------------------------------------------

_DEC = "(SELECT DISTINCT decision_id, accession, attr_name, attr_value, matches, events FROM curation_decisions)"


def _decisions(spark, d):
    """Candidates with the decisions the table brings, copies once."""
    t = table(spark, d, "curation_decisions").dropDuplicates(["decision_id"])
    m = F.transform("matches", lambda x: F.struct(x["match_target"].alias("target"), x["category"].alias("category")))
    e = F.transform("events", lambda x: F.struct(x["kind"].alias("kind"), x["event_target"].alias("target"), x["event_family"].alias("family"), x["normalized_attribute"].alias("normalized_attribute"), x["normalized_value"].alias("normalized_value")))
    return t.select("decision_id", "accession", F.col("attr_name").alias("attribute"), F.col("attr_value").alias("value"), m.alias("matches"), e.alias("events"))


@query(
    "WITH t AS (SELECT DISTINCT * FROM accession_index), c AS (SELECT accession, first_seen, 0 AS i, 'submission_date' AS attribute, strftime(first_seen, '%Y-%m-%dT%H:%M:%S') AS value, 'biosample_root' AS src FROM t "
    "UNION ALL SELECT accession, first_seen, 1, 'organism', organism_value, 'attribute' FROM t WHERE organism_value <> '' UNION ALL SELECT accession, first_seen, 2, 'tarball', osf_tarball_filename, 'attribute' FROM t WHERE osf_tarball_filename <> '' UNION ALL SELECT accession, first_seen, 3, 'taxid', taxid, 'attribute' FROM t WHERE taxid <> '') "
    "SELECT accession, first_seen, row_number() OVER (PARTITION BY accession, first_seen, n ORDER BY i) - 1 AS pos, attribute, value, src AS xml_source FROM (SELECT c.*, 1 AS n FROM c)"
)
def candidate_explode(spark, d):
    from sampleloom.sources.xml import candidates_of

    t = table(spark, d, "accession_index").distinct()
    cell = lambda h, a, v: F.struct(F.lit(h).alias("harmonized"), F.lit(a).alias("attribute"), F.col(v).alias("value"))
    inner = F.array(cell("organism", "organism name", "organism_value"), cell("", "tarball", "osf_tarball_filename"), cell(None, "taxid", "taxid"))
    root = {"submission_date": F.date_format("first_seen", "yyyy-MM-dd'T'HH:mm:ss"), "access": F.lit("public")}
    return t.select("accession", "first_seen", F.posexplode(candidates_of(root, inner)).alias("pos", "c")).select("accession", "first_seen", F.col("pos").cast("long").alias("pos"), "c.*")


@query("SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT CAST(l_suppkey AS VARCHAR))), ',') AS ids FROM lineitem GROUP BY l_orderkey")
def linked_ids(spark, d):
    from sampleloom.sources.xml import linked_ids as links, require_numeric

    link = F.struct(F.concat(F.lit(" "), F.col("l_suppkey").cast("string"), F.lit(" ")).alias("_VALUE"), F.lit("bioproject").alias("_target"))
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(link).alias("l"))
    return g.select("l_orderkey", F.array_join(require_numeric(links(F.col("l"))), ",").alias("ids"))


@query(
    f"WITH m AS (SELECT decision_id, accession, coalesce(attr_name, '') AS a, coalesce(attr_value, '') AS v, unnest(matches) AS m FROM {_DEC} WHERE accession IS NOT NULL) SELECT accession, "
    + ", ".join(f"coalesce(string_agg({c}, '||' ORDER BY decision_id, a, v, m.category) FILTER (WHERE m.match_target = '{t}'), '') AS {n}" for c, t, n in [("m.category", "date", "date_category"), *[(x, t, f"{t}_{y}_orig") for t in C.TARGETS for x, y in (("a", "attr"), ("v", "val"))]])
    + " FROM m GROUP BY accession"
)
def assemble_candidates(spark, d):
    return C.assemble(_decisions(spark, d).filter("accession is not null"), "accession", ["decision_id"])


_HAS = "len(list_filter(coalesce(events, []), lambda e: e.kind = '{}')) > 0"


@query(
    f"WITH t AS (SELECT len(coalesce(matches, [])) AS m, {_HAS.format('automatic_rejection')} AS r, {_HAS.format('unreviewed_attribute')} AS u FROM {_DEC}) SELECT count(*) AS inspected, count_if(m > 0 OR r) AS identified, count_if(m > 0) AS found, "
    "count_if(r) AS rejected, count_if(u) AS unreviewed, count_if(m = 0) AS filtered, count_if(m > 1) AS multiply_matched FROM t"
)
def candidate_counters(spark, d):
    renamed = F.transform("events", lambda e: e.withField("kind", F.when(e["kind"] == "automatic_rejection", C.REJECTED).otherwise(e["kind"])))
    return C.counters(_decisions(spark, d).withColumn("events", renamed))


@query(
    f"WITH e AS (SELECT accession, attr_name AS attribute, attr_value AS value, unnest(events) AS e FROM {_DEC}), f AS (SELECT e.event_target AS target, e.event_family AS family, e.normalized_attribute AS norm, attribute, value, accession FROM e WHERE e.kind = 'unreviewed_attribute' AND e.normalized_attribute IS NOT NULL AND accession IS NOT NULL AND attribute IS NOT NULL AND value IS NOT NULL), "
    "n AS (SELECT target, family, norm, count(*) AS n FROM f GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY target, family, norm ORDER BY attribute, value, accession) AS r FROM (SELECT DISTINCT * FROM f)) "
    "SELECT target, family, norm, any_value(n) AS n, string_agg(attribute || '=' || value || '@' || accession, '||' ORDER BY r) AS examples FROM n JOIN k USING (target, family, norm) WHERE r <= 3 GROUP BY target, family, norm"
)
def review_topk(spark, d):
    rows = _decisions(spark, d).filter("accession is not null and attribute is not null and value is not null")
    rows = rows.withColumn("events", F.filter("events", lambda e: e["normalized_attribute"].isNotNull()))
    got = C.review_report(rows, C.UNREVIEWED, "normalized_attribute")
    shown = F.transform(F.from_json("examples", "array<struct<attribute:string,value:string,accession:string>>"), lambda x: F.concat(x["attribute"], F.lit("="), x["value"], F.lit("@"), x["accession"]))
    return got.select("target", "family", "norm", "n", F.array_join(shown, "||").alias("examples"))


@query(f"WITH e AS (SELECT unnest(events) AS e FROM {_DEC}) SELECT e.event_target AS target, e.event_family AS family, count(*) AS n FROM e WHERE e.kind = 'automatic_rejection' GROUP BY 1, 2")
def rejection_counts(spark, d):
    return C.rejection_counts(_decisions(spark, d), "automatic_rejection")


def _texts(spark, d, column):
    """The distinct texts of a column of the decisions."""
    return table(spark, d, "curation_decisions").filter(F.col(column).isNotNull())


@query(
    f"WITH {VALUE_FORMS}, n AS (SELECT attr_value, count(DISTINCT decision_id) AS n FROM curation_decisions WHERE attr_value IS NOT NULL GROUP BY attr_value) SELECT attr_value, n FROM n JOIN vf ON v = attr_value WHERE form = '' OR form IN (SELECT {simple_form('word')} FROM missing_words)"
)
def missing_filter(spark, d):
    t = _texts(spark, d, "attr_value").select("attr_value", "decision_id").distinct().groupBy("attr_value").agg(F.count("*").alias("n"))
    rule = C.ValueRule.of(C.UNIVERSAL, {"exact": [r[0] for r in table(spark, d, "missing_words").collect()]})
    shown = presentation_col(F.col("attr_value"))
    return t.withColumn("__p", shown).withColumn("__f", full_col(F.col("attr_value"))).filter(rule.definite(F.col("__f"), F.col("__p"))).select("attr_value", "n")


# Slips of every missing word: neighbours swapped, a letter lost, two letters lost, a letter doubled and one lost.
_SLIPS = (
    "slips AS (SELECT DISTINCT trim(regexp_replace(typed, ' +', ' ', 'g')) AS typed FROM (SELECT w, k, unnest([substr(w, 1, k - 1) || substr(w, k + 1, 1) || substr(w, k, 1) || substr(w, k + 2), substr(w, 1, k - 1) || substr(w, k + 1), substr(w, 1, k - 1) || substr(w, k + 1, 1) || substr(w, k + 3), "
    "substr(w, 1, k) || substr(w, k, 1) || substr(w, k + 1, 1) || substr(w, k + 3)]) AS typed FROM (SELECT word AS w, unnest(range(1, length(word))) AS k FROM missing_words)) WHERE trim(regexp_replace(typed, ' +', ' ', 'g')) NOT IN (SELECT word FROM missing_words))"
)
_PAIRED = "list_transform(list_zip(string_split(typed, ' '), string_split(word, ' ')), lambda z: CASE WHEN z[1] = z[2] THEN 0 WHEN NOT regexp_full_match(z[1] || z[2], '[a-z]+') OR length(z[1]) < 5 OR length(z[2]) < 5 THEN 9 ELSE damerau_levenshtein(z[1], z[2]) END)"


@query(
    f"WITH {_SLIPS}, far AS (SELECT typed, list_sum({_PAIRED}) AS n FROM slips, missing_words WHERE len(string_split(typed, ' ')) = len(string_split(word, ' '))), v AS (SELECT typed, CASE WHEN count_if(n = 1) = 1 THEN 'rejected_value' WHEN count_if(n IN (1, 2)) > 0 THEN 'uncertain_rejection' END AS verdict FROM far GROUP BY typed) SELECT typed, verdict FROM slips LEFT JOIN v USING (typed)"
)
def fuzzy_missing(spark, d):
    """Verdicts on slips of one and two edits at every place of every missing word, of one word and of several."""
    words = table(spark, d, "missing_words").select(F.col("word").alias("w"))
    refs = frozenset(r[0] for r in words.collect() if r[0])
    at = words.select("w", F.explode(F.sequence(F.lit(1), F.length("w") - 1)).alias("k")).filter(F.length("w") > 1)
    cut = lambda start, n: F.expr(f"substring(w, {start}, {n})")
    head, a, b = F.expr("substring(w, 1, k - 1)"), cut("k", 1), cut("k + 1", 1)
    tail = lambda n: F.expr(f"substring(w, k + {n})")
    slips = F.array(F.concat(head, b, a, tail(2)), F.concat(head, tail(1)), F.concat(head, b, tail(3)), F.concat(head, a, a, b, tail(3)))
    typed = at.select(F.explode(slips).alias("typed")).select(F.trim(F.regexp_replace("typed", " +", " ")).alias("typed")).distinct().filter(~F.col("typed").isin(*sorted(refs)))
    return typed.select("typed", C.fuzzy_col(F.col("typed"), refs).alias("verdict"))


@query(
    f"WITH {NAME_FORMS} SELECT v AS attr_name, form AS normalized, CASE WHEN list_has_any(string_split(form, ' '), ['host', 'herd']) OR contains(' ' || form || ' ', ' source organism ') THEN 'host_fields' WHEN regexp_matches(form, '(^| )(place|geo|site)') OR contains(' ' || form || ' ', ' visit round ') THEN 'place_words' END AS family FROM nf"
)
def discover_attr(spark, d):
    rules = (C.Discovery("host_fields", frozenset(("host", "herd")), ("source organism",)), C.Discovery("place_words", frozenset(), ("visit round",), ("(^| )(place|geo|site)",)))
    t = _texts(spark, d, "attr_name").select("attr_name").distinct().withColumn("normalized", full_col(F.col("attr_name")))
    return t.select("attr_name", "normalized", F.when(rules[0].hits(F.col("normalized")), rules[0].family).when(rules[1].hits(F.col("normalized")), rules[1].family).alias("family"))


_NAMES = [c[0] for c in seeds.COUNTRIES]


@query(f"WITH {VALUE_FORMS} SELECT v AS attr_value FROM vf WHERE regexp_matches(shown, '^(?:{'|'.join(sorted(_NAMES, key=lambda n: -len(n)))})\\s*[:,]\\s*\\S')")
def loc_rescue(spark, d):
    v = _texts(spark, d, "attr_value").select("attr_value").distinct()
    rules = C.CurationRules.of({"location_rescue": {"names": _NAMES, "separators": [":", ","]}})
    return v.filter(C.rescued(presentation_col(F.col("attr_value")), rules.rescue_prefixes, rules.rescue_separators))


@query(
    f"WITH {NAME_FORMS}, t AS (SELECT DISTINCT decision_id, attr_name FROM curation_decisions WHERE attr_name IS NOT NULL), r AS (SELECT attr_name AS rule, match_target, {simple_form('attr_name')} AS norm FROM attribute_types WHERE match_target IS NOT NULL) "
    "SELECT decision_id, match_target AS target, rule FROM t JOIN nf ON v = attr_name JOIN r ON norm = form"
)
def join_rules(spark, d):
    rules = dimension(table(spark, d, "attribute_types").filter("match_target is not null").select(F.col("attr_name").alias("rule"), F.col("match_target").alias("target"), full_col(F.col("attr_name")).alias("norm")))
    t = _texts(spark, d, "attr_name").select("decision_id", "attr_name").distinct()
    return t.withColumn("norm", full_col(F.col("attr_name"))).join(rules, "norm").select("decision_id", "target", "rule")


@query("SELECT c.decision_id, i.pathogen FROM (SELECT DISTINCT decision_id, accession FROM curation_decisions) c JOIN (SELECT accession, arg_max(pathogen_biosample, (first_seen, pathogen_biosample)) AS pathogen FROM accession_index WHERE trim(accession) <> '' AND trim(pathogen_biosample) <> '' GROUP BY accession) i USING (accession)")
def join_index(spark, d):
    m = X.last_wins(_index(spark, d), "accession", "pathogen_biosample", ["first_seen"])
    return table(spark, d, "curation_decisions").select("decision_id", "accession").distinct().join(m, "accession").select("decision_id", F.col("pathogen_biosample").alias("pathogen"))


CURATION = {
    "universal_missing": {"exact": ["-", "/", "na", "n/a", "none", "unknown", "missing", "not collected", "not applicable", "not provided"], "observed_variants": ["unkown"], "explanation_prefixes": ["withheld"], "explanation_suffixes": ["privacy"], "fuzzy": "one_edit_unique"},
    "location_rescue": {"names": _NAMES, "separators": [":", ","]},
    "targets": {
        "date": {"accepted": {"collection_date": "s", "sampled_on": "s", "receipt_date": "o"}, "discovery": {"date_words": {"tokens": ["date"]}}},
        "iso": {"accepted": {"isolation_source": "", "env_medium": "", "env_local_scale": "", "food_source": "", "source_type": ""}, "discovery": {"origin_words": {"tokens": ["source", "medium"], "patterns": ["^env "]}}},
        "host": {"accepted": {"host": "", "host_taxid": "", "host_common_name": ""}, "ignored": ["host age", "host sex"], "value_rejections": {"not_a_host": {"exact": ["pond", "tray"]}}, "discovery": {"host_fields": {"tokens": ["host"]}}},
        "loc": {"accepted": {"geo_loc_name": "", "place name": ""}, "ignored": ["sampling note"], "discovery": {"place_words": {"phrases": ["geographic location"], "patterns": ["^geo"]}}},
    },
}


@query()
def curate(spark, d):
    """Decisions on all candidates by the whole rule set; the parts have their own SQL, the whole is tested by hand."""
    t = table(spark, d, "curation_decisions").select("decision_id", "accession", F.col("attr_name").alias("attribute"), F.col("attr_value").alias("value"))
    t = spread(t, "decision_id").dropDuplicates(["decision_id"])
    got = C.curate(t, C.CurationRules.of(CURATION))
    return got.select("decision_id", "normalized_attribute", "normalized_value", F.to_json("matches").alias("matches"), F.to_json("events").alias("events"))


# ---- projects --------------------------------------------------------------------------------------------------------

_LINKS = "links AS (SELECT DISTINCT accession, bioproject_accession AS id FROM curation_decisions WHERE accession IS NOT NULL AND bioproject_accession IS NOT NULL)"


def _links(spark, d):
    return table(spark, d, "curation_decisions").filter("accession is not null and bioproject_accession is not null").select("accession", F.col("bioproject_accession").alias("id")).distinct()


def _projects(spark, d):
    return table(spark, d, "bio_projects").select(F.col("accession").alias("id"), F.col("project_id").alias("accession"))


@query(f"WITH {_LINKS} SELECT l.accession, coalesce(array_to_string(list_sort(list(DISTINCT p.project_id) FILTER (WHERE p.project_id IS NOT NULL)), '||'), '') AS accessions FROM links l LEFT JOIN bio_projects p ON p.accession = l.id GROUP BY l.accession")
def resolve_links(spark, d):
    rows = _links(spark, d).groupBy("accession").agg(F.collect_set("id").alias("ids"))
    return P.attach_accessions(rows, "accession", "ids", _projects(spark, d)).select("accession", S.pipe_join(F.col("accessions")).alias("accessions"))


@query(f"WITH {_LINKS} SELECT project_id, accession FROM bio_projects WHERE accession IN (SELECT id FROM links)")
def semi_projects(spark, d):
    return table(spark, d, "bio_projects").select("project_id", "accession").join(_links(spark, d).select(F.col("id").alias("accession")), "accession", "left_semi")


@query(
    f"WITH {_LINKS}, m AS (SELECT id, accession, row_number() OVER (PARTITION BY id ORDER BY accession) AS r FROM links WHERE id NOT IN (SELECT accession FROM bio_projects WHERE accession IS NOT NULL AND len(relevance) > 0)) SELECT id, count(*) AS samples, string_agg(accession, '||' ORDER BY r) FILTER (WHERE r <= 3) AS examples FROM m GROUP BY id"
)
def unresolved_links(spark, d):
    flagged = table(spark, d, "bio_projects").filter(F.size("relevance") > 0).select(F.col("accession").alias("id"))
    return P.unresolved_links(_links(spark, d), flagged)


_JSON = "'{\"id\":' || to_json(project_id) || ',\"accession\":' || to_json(accession) || ',\"title\":' || to_json(title) || ',\"description\":' || to_json(coalesce(description, '')) || ',\"relevance\":' || to_json(coalesce(relevance, [])) || '}'"


def _catalog(spark, d):
    return table(spark, d, "bio_projects").select(F.col("project_id").alias("id"), "accession", "title", F.coalesce("description", F.lit("")).alias("description"), F.coalesce("relevance", S.none_of()).alias("relevance"))


@query(f"SELECT accession, {_JSON} AS line FROM bio_projects WHERE title IS NOT NULL AND accession IS NOT NULL")
def catalog_json(spark, d):
    return _catalog(spark, d).filter("title is not null and accession is not null").select("accession", P.catalog_line().alias("line")).orderBy("accession")


@query(
    "SELECT CAST(p.project_id AS BIGINT) AS line_no, CASE CAST(p.project_id AS BIGINT) % 5 WHEN 1 THEN 'id' WHEN 2 THEN 'relevance' WHEN 3 THEN 'fields' END AS problem FROM bio_projects p WHERE CAST(p.project_id AS BIGINT) % 5 IN (1, 2, 3)"
)
def catalog_validate(spark, d):
    """Lines of the catalog, some of them broken by the project's number."""
    k = F.col("id").cast("long") % 5
    bad_id, twice = F.concat(F.lit("P"), F.col("id")), F.array(F.lit("Agricultural"), F.lit("Agricultural"))
    line = lambda i, r: P.catalog_line({"id": i, "accession": F.col("accession"), "title": F.col("title"), "description": F.col("description"), "relevance": r})
    broken = F.when(k == 1, line(bad_id, F.col("relevance"))).when(k == 2, line(F.col("id"), twice)).when(k == 3, F.concat(F.lit('{"id": "1", "note": '), F.to_json(F.struct("title")), F.lit("}"))).otherwise(line(F.col("id"), F.col("relevance")))
    return P.validate_catalog(_catalog(spark, d).select(F.col("id").cast("long").alias("line_no"), broken.alias("line")))


@query(
    f"WITH {_LINKS} SELECT l.accession, string_agg(p.accession || ':' || coalesce(p.title, ''), '||' ORDER BY p.accession) AS contexts FROM links l JOIN bio_projects p ON p.accession = l.id GROUP BY l.accession"
)
def project_contexts(spark, d):
    from sampleloom.operators.isolation import project_contexts as contexts

    rows = _links(spark, d).groupBy("accession").agg(F.collect_set("id").alias("ids")).withColumnRenamed("accession", "record")
    got = contexts(rows, _catalog(spark, d), "record", "ids")
    return got.select(F.col("record").alias("accession"), F.array_join(F.transform("contexts", lambda c: F.concat(c["accession"], F.lit(":"), F.coalesce(c["title"], F.lit("")))), "||").alias("contexts"))
