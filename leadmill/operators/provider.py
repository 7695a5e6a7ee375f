"""Enrich leads through any callable provider, in the executors, with bounded retry."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.fixed_values import ENRICHED, FAILED, NOT_FOUND
from leadmill.functions.text import normalize_text
from leadmill.schema import ROW_NUMBER
from leadmill.sources.files import exists

REQUEST_FIELDS = ["email", "company", "full_name", "title", "country"]
ENRICHMENT_COLUMNS = ["industry", "company_size", "company_domain", "enrichment_status"]
UNKNOWN_PROVIDER = "unknown_provider"

RESPONSE = T.StructType([
    *[T.StructField(c, T.StringType()) for c in ENRICHMENT_COLUMNS],
    T.StructField("provider_name", T.StringType()),
    T.StructField("provider_record_found", T.BooleanType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("raw_payload", T.MapType(T.StringType(), T.StringType())),
    T.StructField("attempts", T.IntegerType()),
])

# Bytes of answers, their requests included, that may be broadcast to the leads that asked alike.
MAX_BROADCAST_BYTES = 64 << 20
# Leads that one copy of an answer may serve when the answers are shuffled.
LEADS_PER_COPY = 1_000_000
# Most requests that may need several copies.
MAX_HOT_REQUESTS = 100_000
# What leads get of a response; the raw payload stays with the answers.
JOINED_FIELDS = [f.name for f in RESPONSE if f.name != "raw_payload"]


class TransientProviderError(Exception):
    """A failure that may pass when tried again."""


class ProviderResponse(NamedTuple):
    """What a provider's ``enrich(request: dict)`` returns."""

    industry: str | None
    company_size: str | None
    company_domain: str | None
    enrichment_status: str
    provider_name: str
    provider_record_found: bool
    error_message: str | None = None
    raw_payload: dict[str, str] | None = None


def call_with_retry(provider: Any, request: dict, max_attempts: int) -> dict:
    """Ask until an answer comes, at most ``max_attempts`` times; then report a failed lead.

    Only transient errors are retried; any other error ends the task.
    """
    error = None
    for attempt in range(1, max_attempts + 1):
        try:
            answer = provider.enrich(request)
        except TransientProviderError as transient:
            error = str(transient)
            continue
        if answer.enrichment_status not in (ENRICHED, NOT_FOUND, FAILED):
            raise ValueError(f"unknown enrichment status {answer.enrichment_status!r}")
        return {**answer._asdict(), "raw_payload": answer.raw_payload or {}, "attempts": attempt}
    name = getattr(provider, "provider_name", UNKNOWN_PROVIDER)
    failed = ProviderResponse(None, None, None, FAILED, name, False, error, {})
    return {**failed._asdict(), "attempts": max_attempts}


def provider_responses(
    requests: DataFrame,
    make_provider: Callable[[], Any],
    max_attempts: int = 3,
    partitions: int | None = None,
) -> DataFrame:
    """Append a ``response`` struct: one request per row, the provider built once per task.

    Only Arrow batches pass through Python and other columns go through untouched. Spark may
    run a task again, so a provider must bear repeated calls, and the result should be written
    before it is used twice. ``partitions`` sets how many tasks may call at a time.
    """
    if max_attempts < 1:
        raise ValueError("max_attempts must be at least 1")
    blank = dict.fromkeys([*REQUEST_FIELDS, ROW_NUMBER])
    asked = [c for c in blank if c in requests.columns]
    schema = T.StructType([*requests.schema.fields, T.StructField("response", RESPONSE)])
    response_type = pa.struct([
        *[(c, pa.string()) for c in ENRICHMENT_COLUMNS],
        ("provider_name", pa.string()),
        ("provider_record_found", pa.bool_()),
        ("error_message", pa.string()),
        ("raw_payload", pa.map_(pa.string(), pa.string())),
        ("attempts", pa.int32()),
    ])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        provider = make_provider()
        for batch in batches:
            answers = [call_with_retry(provider, {**blank, **request}, max_attempts)
                       for request in batch.select(asked).to_pylist()]
            for answer in answers:
                answer["raw_payload"] = list(answer["raw_payload"].items())
            column = pa.array(answers, response_type)
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "response"])

    if partitions is not None:
        spread_by = ROW_NUMBER if ROW_NUMBER in requests.columns else requests.columns[0]
        requests = requests.repartition(partitions, spread_by)
    return requests.mapInArrow(ask, schema)


def enrichment_of(responses: DataFrame) -> DataFrame:
    """Replace the ``response`` struct by the four enrichment columns."""
    fields = {c: F.col("response").getField(c) for c in ENRICHMENT_COLUMNS}
    return responses.withColumns(fields).drop("response")


def enrich_with_provider(
    leads: DataFrame,
    make_provider: Callable[[], Any],
    max_attempts: int = 3,
    partitions: int | None = None,
) -> DataFrame:
    """One request per lead, in place: no shuffle, no join. Request text is normalised."""
    given = [c for c in REQUEST_FIELDS if c in leads.columns]
    clean = leads.withColumns({f"_{c}": F.col(c) for c in given}).withColumns(
        {c: normalize_text(c) for c in given}
    )
    answered = enrichment_of(provider_responses(clean, make_provider, max_attempts, partitions))
    original = {c: F.col(f"_{c}") for c in given}
    return answered.withColumns(original).select(*leads.columns, *ENRICHMENT_COLUMNS)


def distinct_requests(leads: DataFrame, by: Sequence[str] = REQUEST_FIELDS) -> DataFrame:
    """The different requests with the number of leads that make each, counted map-side first."""
    return leads.groupBy(*by).agg(F.count(F.lit(1)).alias("leads"))


def first_answers(attempts: DataFrame, by: Sequence[str], max_attempts: int | None = 3) -> DataFrame:
    """One ``response`` per request out of stored attempts: the first that did not fail.

    ``attempts`` has the request's columns, ``attempt`` (1 is the first) and a ``response``. Those
    after ``max_attempts`` were too late, if that is given; a request all of whose attempts failed keeps the last
    failure. Failed requests can thus be replayed by adding rows. Aggregated map-side.
    """
    if max_attempts is not None and max_attempts < 1:
        raise ValueError("max_attempts must be at least 1")
    failed = F.col("response.enrichment_status") == FAILED
    # Answers before failures, the earliest answer, the latest failure.
    rank = F.struct(failed, F.when(failed, -F.col("attempt")).otherwise(F.col("attempt")))
    in_time = attempts if max_attempts is None else attempts.filter(F.col("attempt") <= max_attempts)
    return in_time.groupBy(*by).agg(
        F.min_by("response", rank).alias("response"))


LOG_RUN = "run"


def attempts_made(spark: SparkSession, log: str, but: str | None = None) -> DataFrame | None:
    """The log of attempts, without those of one run; null if there is no log yet."""
    if not exists(spark, log):
        return None
    made = spark.read.parquet(log)
    return made if but is None else made.filter(F.col(LOG_RUN) != _part(but))


def _part(run: str) -> str:
    """A run's part of the log, which no reader takes for a number or a date."""
    return f"run_{run}"


def open_requests(requests: DataFrame, made: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """The requests that no attempt has answered, with ``tried``, the attempts so far (0 for new ones).

    ``made`` has the request's columns, ``attempt`` and ``response``. It is reduced to a row for each
    request, map-side first, and joined with nulls taken as equal.
    """
    if made is None:
        return requests.withColumn("tried", F.lit(0).cast("bigint"))
    names = {c: f"_key_{c}" for c in by}
    answered = F.max(F.col("response.enrichment_status") != FAILED).alias("_answered")
    state = made.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(F.max("attempt").alias("_tried"), answered)
    same: Column = F.lit(True)
    for c, n in names.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    joined = requests.join(state, same, "left").filter(~F.coalesce("_answered", F.lit(False)))
    return joined.withColumn("tried", F.coalesce(F.col("_tried").cast("bigint"), F.lit(0))).drop(
        *names.values(), "_tried", "_answered")


def attempts_of(asked: DataFrame, by: Sequence[str]) -> DataFrame:
    """What goes to the log of requests asked now: ``attempt`` goes on from those before."""
    attempt = (F.col("tried") + F.col("response.attempts")).cast("bigint")
    return asked.select(*by, attempt.alias("attempt"), "response")


def log_attempts(asked: DataFrame, log: str, run: str, by: Sequence[str]) -> None:
    """Append a run's attempts to the log, in a part of its own that a repeated run replaces."""
    attempts_of(asked, by).write.mode("overwrite").parquet(f"{log.rstrip('/')}/{LOG_RUN}={_part(run)}")


def answers_of(requests: DataFrame, made: DataFrame, by: Sequence[str]) -> DataFrame:
    """The requests with the answer that the log has for each: the first that did not fail, else the last."""
    names = {c: f"_key_{c}" for c in by}
    known = first_answers(made, by, max_attempts=None).select(*[F.col(c).alias(n) for c, n in names.items()], "response")
    same: Column = F.lit(True)
    for c, n in names.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    return requests.join(known, same, "left").drop(*names.values())


def join_answers(
    leads: DataFrame,
    answers: DataFrame,
    by: Sequence[str] = REQUEST_FIELDS,
) -> DataFrame:
    """Give each lead the answer to its request; nulls are equal, and no answer gives a null.

    ``answers`` is a written table with one ``response`` per request and, from
    :func:`distinct_requests`, the number of ``leads`` that make it. Its size is taken first: few
    bytes are broadcast. Otherwise the join shuffles, and a request made by very many leads gets a
    copy of its answer per million of them, over which its leads are dealt out. There cannot be
    more such requests than leads divided by the least number of leads they have.
    """
    names = {c: f"_key_{c}" for c in by}
    fields = [f.name for f in answers.schema["response"].dataType if f.name in JOINED_FIELDS]
    response = F.struct(*[F.col("response").getField(f).alias(f) for f in fields]).alias("response")
    count = F.col("leads") if "leads" in answers.columns else F.lit(0).cast("bigint")
    right = answers.select(*[F.col(c).alias(n) for c, n in names.items()], response, count.alias("_leads"))
    size = F.lit(100)
    for c in [*names.values(), *[f"response.{f}" for f in fields]]:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    total, asking = right.agg(F.sum(size.cast("bigint")), F.sum("_leads")).first()
    same: Column = F.lit(True)
    for c, n in names.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    spare = [*names.values(), "_leads"]
    if (total or 0) <= MAX_BROADCAST_BYTES:
        return leads.join(F.broadcast(right), same, "left").drop(*spare)

    least = max(LEADS_PER_COPY, (asking or 0) // MAX_HOT_REQUESTS)
    hot = F.col("_leads") > least
    copies = F.ceil(F.col("_leads") / F.lit(LEADS_PER_COPY)).cast("int")
    # The requests of many leads as hashes of eight bytes; a lead that only has the same hash is dealt out too.
    request = F.xxhash64(*by)
    hot_requests = right.filter(hot).groupBy(F.xxhash64(*names.values()).alias("_hot")).agg(
        F.max(copies).alias("_copies"))
    dealt = leads.withColumn("_hash", request).join(
        F.broadcast(hot_requests), F.col("_hash") == F.col("_hot"), "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(ROW_NUMBER), F.col("_copies")), F.lit(0)).cast("int"))
    most = right.withColumn("_hash", F.xxhash64(*names.values())).join(
        F.broadcast(hot_requests), F.col("_hash") == F.col("_hot"), "left").drop("_hash", "_hot")
    copied = most.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))).drop("_copies")
    joined = dealt.join(copied, same & (F.col("_salt") == F.col("_copy")), "left")
    return joined.drop(*spare, "_salt", "_copy", "_copies", "_hash", "_hot")
