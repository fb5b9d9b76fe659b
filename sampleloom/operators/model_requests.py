"""Optional model fallback: canonical requests, fingerprint cache, strict replies, metrics.

A model is asked once per distinct fingerprint; repeats take the answer of the first. The cache is joined before the
client is considered, so earlier answers are served without one.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.session import cut

_REPLY = "fingerprint string, reply string, status string, attempts int, seconds double, input_tokens long, output_tokens long, error string, trace string"


def canonical_json(value: object) -> str:
    """Sorted keys, no spaces, text unescaped; numbers that JSON lacks fail."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def request_json(model: str, parameters: Mapping[str, object], schema_id: str, system: str | None, user: Column) -> Column:
    """Canonical text of a request; fields stand in alphabetical order, messages keep theirs, and nothing null is left out."""
    message = lambda role, content: F.struct(content.alias("content"), F.lit(role).alias("role"))
    messages = ([message("system", F.lit(system))] if system else []) + [message("user", user)]
    body = F.to_json(F.array(*messages), {"ignoreNullFields": "false"})
    return F.concat(F.lit('{"messages":'), body, F.lit(f',"model":{canonical_json(model)},"parameters":{canonical_json(dict(parameters))},"response_schema_id":{canonical_json(schema_id)}}}'))


def fingerprint(text: Column) -> Column:
    return F.sha2(text, 256)


def mark_repeats(requests: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``first_call``: true for the first request of each fingerprint, by partial aggregation and a join back."""
    first = requests.groupBy("fingerprint").agg(F.min(F.struct(*order)).alias("__first"))
    return requests.join(first, "fingerprint").withColumn("first_call", F.struct(*order) == F.col("__first")).drop("__first")


def lookup(requests: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests with their cached reply, and those without one."""
    hit = requests.join(cache.select("fingerprint", "reply"), "fingerprint")
    return hit, requests.join(cache.select("fingerprint"), "fingerprint", "left_anti")


def remember(cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """The cache with the fresh replies; a fresh reply replaces an older one."""
    kept = cache.join(fresh.select("fingerprint"), "fingerprint", "left_anti")
    return kept.select("fingerprint", "reply").unionByName(fresh.select("fingerprint", "reply").dropDuplicates(["fingerprint"]))


class Observed:
    """A client over an HTTP transport whose exchanges are seen: ``send (method, url, headers, body) -> (status, headers, body)``.

    ``ask`` turns a request text into the arguments of ``send``, ``read`` its answer into the reply and the tokens. The trace of a
    call lists its exchanges without secrets and without their bodies.
    """

    def __init__(self, send: Callable, ask: Callable[[str], tuple], read: Callable[[object], tuple[str, Mapping]]) -> None:
        self.send, self.ask, self.read = send, ask, read

    def __call__(self, request: str) -> tuple[str, dict]:
        from sampleloom.run.outputs import sanitize_headers, sanitize_url

        method, url, headers, body = self.ask(request)
        began = time.monotonic()
        status, got, answer = self.send(method, url, headers, body)
        seen = {"method": method, "url": sanitize_url(url), "request_headers": sanitize_headers(headers), "status": status, "response_headers": sanitize_headers(got), "seconds": round(time.monotonic() - began, 6), "request_characters": len(body), "response_characters": len(str(answer))}
        if status == 408 or status == 504:
            raise TimeoutError(f"status {status} of {sanitize_url(url)}")
        if not 200 <= status < 300:
            raise ConnectionError(f"status {status} of {sanitize_url(url)}")
        reply, used = self.read(answer)
        return reply, {**used, "trace": canonical_json([seen])}


def call_model(requests: DataFrame, client: Callable[[str], object], attempts: int = 2) -> DataFrame:
    """``(fingerprint, reply, status, attempts, seconds, input_tokens, output_tokens, error)`` of ``requests (fingerprint, request)``, each fingerprint once.

    ``client`` takes the request text and gives the reply, or the reply and a mapping of its tokens and trace (as
    :class:`Observed` gives them); it fails by raising.
    Failures are rows too, with their sanitised text, and are never put in the cache.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from sampleloom.run.outputs import sanitize

        for b in batches:
            rows = []
            for f, r in zip(b["fingerprint"], b["request"]):
                began, status, reply, n, used, error = time.monotonic(), "failed", None, 0, {}, None
                while n < attempts and status != "ok":
                    n += 1
                    try:
                        got = client(r)
                        reply, used = got if isinstance(got, tuple) else (got, {})
                        status, error = "ok", None
                    except TimeoutError as e:
                        status, error = "timeout", sanitize(f"{type(e).__name__}: {e}")
                    except Exception as e:  # noqa: BLE001 - the kind of failure is the client's
                        status, error = "failed", sanitize(f"{type(e).__name__}: {e}")
                rows.append((f, reply, status, n, time.monotonic() - began, int(used.get("input_tokens", 0)), int(used.get("output_tokens", 0)), error, used.get("trace")))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in _REPLY.split(", ")])

    return requests.select("fingerprint", "request").dropDuplicates(["fingerprint"]).mapInPandas(run, _REPLY)


def metrics(calls: DataFrame, *group: str) -> DataFrame:
    """Attempts, successes, failures, retries, seconds and tokens by ``group`` (as target and model) and in all."""
    g = calls.groupingSets([list(group), []], *group)
    return g.agg(
        F.sum("attempts").alias("attempts"), F.count_if(F.col("status") == "ok").alias("successes"), F.count_if(F.col("status") != "ok").alias("failures"),
        F.sum(F.col("attempts") - 1).alias("retries"), F.sum("seconds").alias("seconds"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"),
    )


def failures(calls: DataFrame, *group: str) -> DataFrame:
    """``(group, status, n)`` of the calls that failed."""
    return calls.filter("status <> 'ok'").groupBy(*group, "status").agg(F.count("*").alias("n"))


def valid_country(reply: Column) -> Column:
    """The trimmed country of a reply that is one JSON object with that key alone and a text that is not blank, else null."""
    keys = F.json_object_keys(reply)
    value = F.try_variant_get(F.try_parse_json(reply), "$.country", "variant")
    text = F.trim(F.get_json_object(reply, "$.country"))
    ok = (keys == F.array(F.lit("country"))) & (F.schema_of_variant(value) == "STRING") & (text != "")
    return F.when(F.coalesce(ok, F.lit(False)), text)


def ask(requests: DataFrame, cache: DataFrame, client: Callable[[str], str] | None) -> tuple[DataFrame, DataFrame]:
    """Answers of ``requests (fingerprint, request, ...)`` and the cache after them.

    Answers add ``reply`` and ``how``: ``cache``, ``call`` for the first of equal requests, ``repeat`` for the others,
    ``failed`` or ``disabled``. The cache is asked first; only replies that came are kept in it. See :func:`ask_model` for the
    calls themselves.
    """
    answers, after, _ = ask_model(requests, cache, client)
    return answers, after


def ask_model(requests: DataFrame, cache: DataFrame, client: Callable[[str], object] | None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """:func:`ask`, and the calls that were made (none without a client)."""
    hit, miss = lookup(requests, cache)
    hit = hit.withColumn("how", F.lit("cache"))
    if client is None:
        return hit.unionByName(miss.withColumns({"reply": F.lit(None).cast("string"), "how": F.lit("disabled")})), cache, None
    calls = cut(call_model(miss, client))
    order = [c for c in miss.columns if c not in ("fingerprint", "request")] or ["request"]
    marked = mark_repeats(miss, order).join(calls.select("fingerprint", "reply", "status"), "fingerprint")
    how = F.when(F.col("status") != "ok", "failed").when(F.col("first_call"), "call").otherwise("repeat")
    fresh = marked.withColumn("how", how).drop("first_call", "status")
    return hit.unionByName(fresh), remember(cache, calls.filter("status = 'ok'")), calls
