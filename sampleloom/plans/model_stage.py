"""The optional model in the pipeline: prompts, requests for what the direct steps left open, and their answers."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.operators import isolation as I
from sampleloom.operators import model_requests as M
from sampleloom.operators import places as G
from sampleloom.operators.ranking import dimension
from sampleloom.session import cut

CACHE = "fingerprint string, reply string"
# Names of the answer schemas, and what stands for a record in a prompt.
LOCATION_SCHEMA, ISOLATION_SCHEMA = "location_country:1", "isolation_terms:1"
TREE, PAIRS, METADATA, PROJECTS = "{ontology_tree}", "{metadata}", "{metadata}", "{projects}"


@dataclass(frozen=True)
class Prompts:
    """System and user text of each pipeline; a template without a place for the record gets it behind its text."""

    location_system: str = ""
    location_user: str = ""
    isolation_system: str = ""
    isolation_user: str = ""
    project_system: str = ""
    project_user: str = ""

    @classmethod
    def of(cls, location: Mapping | None, isolation: Mapping | None, tree: str = "") -> "Prompts":
        """Prompts of the two configurations, the ontology tree put into the isolation system prompts."""
        text = lambda c, k: str((c or {}).get(k) or "")
        return cls(
            text(location, "llm_system_prompt"), text(location, "llm_user_prompt_template"), text(isolation, "system_prompt").replace(TREE, tree), text(isolation, "user_prompt"),
            text(isolation, "bioproject_system_prompt").replace(TREE, tree), text(isolation, "bioproject_user_prompt"),
        )

    def sections(self, model: str, version: str | None = None) -> list[tuple[str, str, str | None, dict[str, str]]]:
        """What :func:`sampleloom.run.outputs.prompt_snapshot` shows."""
        return [("location", model, version, {"system": self.location_system, "user": self.location_user}), ("isolation source", model, version, {"system": self.isolation_system, "user": self.isolation_user, "project system": self.project_system, "project user": self.project_user})]


def filled(template: str, place: str, content: Column) -> Column:
    """``template`` with ``content`` at ``place``, or behind it."""
    if place not in template:
        return F.concat(F.lit(template + "\n" if template else ""), content)
    head, _, tail = template.partition(place)
    return F.concat(F.lit(head), content, F.lit(tail))


@dataclass(frozen=True)
class Model:
    """A model and the answers it has given; without a client only earlier answers are used."""

    name: str
    client: Callable[[str], object] | None = None
    parameters: Mapping[str, object] = field(default_factory=lambda: {"seed": 100, "temperature": 0})
    prompts: Prompts = Prompts()
    cache: DataFrame | None = None
    strict: bool = True

    def known(self, spark: SparkSession) -> DataFrame:
        return self.cache if self.cache is not None else spark.createDataFrame([], CACHE)


@dataclass(frozen=True)
class Answered:
    """Outcomes after the model, the cache after it and the calls that were made, if any."""

    outcomes: DataFrame
    cache: DataFrame
    calls: DataFrame | None


def _ask(requests: DataFrame, model: Model, target: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    requests = cut(requests.withColumn("fingerprint", M.fingerprint(F.col("request"))))
    answers, cache, calls = M.ask_model(requests, model.known(requests.sparkSession), model.client)
    return cut(answers), cache, calls.withColumns({"target": F.lit(target), "model": F.lit(model.name)}) if calls is not None else None


def location_answers(outcomes: DataFrame, model: Model, aliases: DataFrame, remap: DataFrame, official: DataFrame) -> Answered:
    """Locations of ``outcomes`` (as :func:`sampleloom.operators.places.standardize_places` gives them), the open ones by the model.

    A record that the model answers keeps no sublocation; one that it cannot answer stays open with the reason as diagnostic.
    """
    p = model.prompts
    open_ = outcomes.filter("diagnostic = 'model_request'")
    text = M.request_json(model.name, model.parameters, LOCATION_SCHEMA, p.location_system or None, filled(p.location_user, PAIRS, F.col("request")))
    answers, cache, calls = _ask(open_.select("record", text.alias("request")), model, "location")
    placed = G.place_replies(answers, aliases, remap, official).select("record", F.col("country").alias("__country"), F.col("diagnostic").alias("__how"))
    # regions belong to countries under the name of the vocabulary or of the official list
    named = aliases.select("country", "un_region").dropDuplicates(["country"])
    mapped = G.to_official(named, remap, official).filter("official is not null").select(F.col("official").alias("__country"), F.col("un_region").alias("__region")).dropDuplicates(["__country"])
    j = outcomes.join(placed, "record", "left").join(dimension(mapped), "__country", "left")
    out = j.select("record", F.coalesce("country", "__country").alias("country"), F.coalesce("un_region", "__region").alias("un_region"), "sublocation", F.coalesce("__how", "diagnostic").alias("diagnostic"), "request")
    return Answered(out, cache, calls)


def isolation_answers(outcomes: DataFrame, cands: DataFrame, model: Model, ontology: DataFrame, contexts: DataFrame | None = None, hosts: DataFrame | None = None) -> Answered:
    """Isolation sources of ``outcomes`` (as :func:`sampleloom.operators.isolation.standardize_isolation` gives them), with the model's terms.

    ``cands (record, pos, attribute, value)`` are the candidates of the outcomes, ``contexts (record, contexts)`` the projects
    and ``hosts (record, host)`` the host context. Records whose values all matched are not asked about. A bad reply fails
    if the model is strict, else the record keeps what matched directly.
    """
    p = model.prompts
    nodes = I.nodes_of(ontology)
    filled_rows = cands.select("record", "pos", "attribute", S.strip(F.col("value")).alias("value")).filter("value <> ''")
    pairs = filled_rows.groupBy("record").agg(F.array_sort(F.collect_list(F.struct("pos", "attribute", "value"))).alias("p"))
    open_ = outcomes.filter("not covered and request_mode is not null").select("record", "request_mode").join(pairs, "record", "left")
    open_ = open_.join(hosts.select("record", "host"), "record", "left") if hosts is not None else open_.withColumn("host", F.lit(None).cast("string"))
    empty = F.array().cast("array<struct<pos:bigint,attribute:string,value:string>>")
    got = F.coalesce("p", empty)
    metadata = S.render_block(F.transform(got, lambda x: x["attribute"]), F.transform(got, lambda x: x["value"]), F.col("host"))
    if contexts is not None:
        open_ = open_.join(contexts.select("record", F.to_json("contexts").alias("__projects")), "record", "left")
    else:
        open_ = open_.withColumn("__projects", F.lit(None).cast("string"))
    projects = F.coalesce("__projects", F.lit("[]"))
    request = lambda system, user: M.request_json(model.name, model.parameters, ISOLATION_SCHEMA, system or None, user)
    sample_text, project_text = filled(p.isolation_user, METADATA, metadata), filled(p.project_user, PROJECTS, projects)
    text = (
        F.when(F.col("request_mode") == "sample_only", request(p.isolation_system, sample_text)).when(F.col("request_mode") == "project_only", request(p.project_system, project_text))
        .otherwise(request(p.isolation_system, F.concat(sample_text, F.lit("\n\n"), project_text)))
    )
    answers, cache, calls = _ask(open_.select("record", "request_mode", text.alias("request")), model, "isolation")
    read = I.read_replies(answers.filter("reply is not null").select("record", "request_mode", "reply"), nodes)
    direct = filled_rows.join(I.direct_matches(filled_rows, nodes), "value").select("record", "term").distinct()
    replied = I.with_replies(direct.join(read.select("record"), "record", "left_semi"), read, nodes, model.strict)
    fields = ("categories", "display_terms", "ontology_links", "term_paths", "evidence_level")
    said = replied.select("record", *[F.col(c).alias(f"__{c}") for c in fields], "reasoning", F.lit(True).alias("__said"))
    how = answers.select("record", F.when(F.col("how") == "cache", "cache_hit").when(F.col("how").isin("call", "repeat"), "llm_call").when(F.col("how") == "disabled", "llm_disabled").otherwise("recoverable_llm_failure").alias("__how"))
    j = outcomes.join(said, "record", "left").join(how, "record", "left")
    took = F.coalesce("__said", F.lit(False))
    diagnostics = F.filter(F.concat(F.filter("diagnostics", lambda x: ~took | (x != I.UNSPECIFIED)), F.array("__how", F.when(took & (F.col("__term_paths") == ""), I.UNSPECIFIED))), lambda x: x.isNotNull())
    out = j.select(
        "record", *[F.when(took, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in fields], "covered", "request_mode", diagnostics.alias("diagnostics"),
        F.when(took, F.array("reasoning")).otherwise(S.none_of()).alias("reasoning"),
    )
    return Answered(out, cache, calls)
