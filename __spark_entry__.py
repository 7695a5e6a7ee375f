"""Registered queries over the driver's tables, and the DuckDB statements to check them by."""

from __future__ import annotations

import atexit
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import leadmill  # noqa: E402
import oracles  # noqa: E402
from leadmill import functions as L  # noqa: E402
from leadmill.driver_tables import (  # noqa: E402
    SecondRound,
    country_files,
    country_texts,
    csv_of_texts,
    raw_leads,
    rule_keywords,
    rule_texts,
    stored_attempts,
)
from leadmill.fixed_values import SCORING_RULES  # noqa: E402
from leadmill.operators import (  # noqa: E402
    accept_leads,
    all_rejects,
    compile_rules,
    crm_export,
    duplicate_rejects,
    enrich_leads,
    first_matching_rule,
    lead_completeness,
    merge_leads,
    normalize_leads,
    reason_counts,
    reasons_text,
    reject_leads,
    score_leads,
    status_counts,
    surviving_rows,
)
from leadmill.operators.enrich import (  # noqa: E402
    infer_company_domain,
    infer_company_size,
    infer_industry,
)
from leadmill.operators.normalize import conform_country  # noqa: E402
from leadmill.operators.provider import (  # noqa: E402
    ENRICHMENT_COLUMNS,
    answers_of,
    attempts_of,
    distinct_requests,
    enrichment_of,
    first_answers,
    join_answers,
    open_requests,
    provider_responses,
)
from leadmill.operators.rule_index import with_first_rule  # noqa: E402
from leadmill.plans import Staging, clean_from_merged, run_job  # noqa: E402
from leadmill.schema import NORMALIZED_COLUMNS, ROW_NUMBER  # noqa: E402
from leadmill.sources.countries import (  # noqa: E402
    country_dimension,
    country_table,
    read_country_table,
)
from leadmill.sources.leads import (  # noqa: E402
    POSITION,
    number_rows,
    prepare_leads,
    split_offsets,
)
from leadmill.sources.split_csv import read_split_csv_leads  # noqa: E402

try:  # these may be taken away as a whole; the other queries do not need them
    import corpus_pipeline
    from leadmill.llm.queries import FURTHER_QUERIES, FURTHER_SQL
    from leadmill.llm.queries import ORACLE_SQL as LLM_ORACLES
    from leadmill.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as absent:
    if absent.name not in ("corpus_pipeline", "leadmill.llm", "leadmill.llm.queries"):
        raise
    LLM_QUERIES, LLM_ORACLES = {}, {}
else:
    LLM_QUERIES = LLM_QUERIES | FURTHER_QUERIES | {"pipeline": corpus_pipeline.run}
    LLM_ORACLES = LLM_ORACLES | FURTHER_SQL
    if corpus_pipeline.ORACLE_SQL is not None:
        LLM_ORACLES = LLM_ORACLES | {"pipeline": corpus_pipeline.ORACLE_SQL}

# Python workers get the package with the task, so it need not be installed where they run.
cloudpickle.register_pickle_by_value(leadmill)

Query = Callable[[SparkSession, str], DataFrame]


# --- stages, each from the given tables ----------------------------------------------

def prepared(spark: SparkSession, tables: str) -> DataFrame:
    return prepare_leads(raw_leads(spark, tables), ROW_NUMBER)


def normalized(spark: SparkSession, tables: str) -> DataFrame:
    return normalize_leads(prepared(spark, tables))


def accepted(spark: SparkSession, tables: str) -> DataFrame:
    return accept_leads(normalized(spark, tables))


def merged(spark: SparkSession, tables: str) -> DataFrame:
    return merge_leads(accepted(spark, tables))


def clean(spark: SparkSession, tables: str) -> DataFrame:
    return clean_from_merged(merged(spark, tables))


def normalized_once(spark: SparkSession, tables: str) -> DataFrame:
    """The normalised leads as a table, for what reads them more than once."""
    return _staged(spark).write(normalized(spark, tables), "normalized")


def rejected(spark: SparkSession, tables: str) -> DataFrame:
    return _rejects_of(normalized_once(spark, tables))


def _rejects_of(leads: DataFrame) -> DataFrame:
    return all_rejects(leads, surviving_rows(accept_leads(leads)))


def answered(spark: SparkSession, tables: str) -> DataFrame:
    """Merged leads with what a provider once said about their companies, failures after two attempts."""
    answers = _staged(spark).write(first_answers(stored_attempts(spark, tables), ["company"], 2), "answers")
    return join_answers(merged(spark, tables), answers, ["company"])


def _staged(spark: SparkSession) -> Staging:
    """A staging folder that goes when the driver's Python ends."""
    staging = Staging(spark)
    atexit.register(_remove, staging)
    return staging


def _remove(staging: Staging) -> None:
    if staging.spark.sparkContext._jsc is not None:
        staging.remove()


# --- queries ---------------------------------------------------------------------------

def _with_reasons_as_text(df: DataFrame) -> DataFrame:
    kind = df.schema["score_reasons"].dataType
    return df.withColumn("score_reasons", reasons_text("score_reasons", kind))


def _over(stage: Query, *kept: str, **made: Callable[[], Column]) -> Query:
    """The row number, some columns of a stage and some made from them."""
    return lambda spark, tables: stage(spark, tables).select(
        ROW_NUMBER, *kept, *[make().alias(name) for name, make in made.items()]
    )


def normalize_text(spark: SparkSession, tables: str) -> DataFrame:
    fields = ["full_name", "raw_email", "title", "company", "source"]
    return prepared(spark, tables).select(
        ROW_NUMBER, *[L.normalize_text(c).alias(c) for c in fields]
    )


def country_matches(spark: SparkSession, tables: str) -> DataFrame:
    """The keys that occur in the leads, with what the dimension says and how often."""
    keys = prepared(spark, tables).select(L.country_key(L.normalize_text("country")).alias("country_key"))
    # Counted before the look-up, so that only the different keys are looked up.
    counted = keys.filter("country_key IS NOT NULL").groupBy("country_key").agg(
        F.count(F.lit(1)).alias("leads")
    )
    return counted.join(country_dimension(spark), "country_key", "left").select(
        "country_key", "canonical_country", "leads"
    )


def large_country_table(spark: SparkSession, tables: str) -> DataFrame:
    """Countries by a table of very many entries whose spellings clash, read from JSON files."""
    staging = _staged(spark)
    entries = read_country_table(spark, country_files(spark, tables, f"{staging.root}/countries"))
    return conform_country(country_texts(spark, tables), country_table(entries, staging.write)).select(ROW_NUMBER, "country")


def rule_match(spark: SparkSession, tables: str) -> DataFrame:
    titles = prepared(spark, tables).select(ROW_NUMBER, L.normalize_text("title").alias("title"))
    folded = titles.withColumn("_title", L.casefold("title"))
    named = {}
    for column, group in (("title_function", "title_function_scores"), ("seniority", "seniority_scores")):
        rules = compile_rules(SCORING_RULES[group])
        names = F.array(*[F.lit(r.name) for r in rules])
        named[column] = F.get(names, first_matching_rule("_title", rules) - 1)
    return folded.withColumns(named).select(ROW_NUMBER, "title", "title_function", "seniority")


def provider_enrichment(spark: SparkSession, tables: str) -> DataFrame:
    details = {c: F.col("response").getField(c)
               for c in ("provider_record_found", "error_message", "attempts")}
    return enrichment_of(answered(spark, tables).withColumns(details)).select(
        *NORMALIZED_COLUMNS, *ENRICHMENT_COLUMNS, *details
    )


def provider_scores(spark: SparkSession, tables: str) -> DataFrame:
    scored = score_leads(enrichment_of(answered(spark, tables)), SCORING_RULES)
    return _with_reasons_as_text(scored).select(
        ROW_NUMBER, "enrichment_status", "lead_score", "score_reasons"
    )


def shared_requests(spark: SparkSession, tables: str) -> DataFrame:
    """Each different company looked up once, the answers given to all accepted leads that have it."""
    leads = accepted(spark, tables).select(ROW_NUMBER, "company")
    answers = first_answers(stored_attempts(spark, tables), ["company"], 3)
    requests = distinct_requests(leads, ["company"]).join(answers, "company", "left")
    return enrichment_of(join_answers(leads, _staged(spark).write(requests, "answers"), ["company"])).select(
        ROW_NUMBER, "company", *ENRICHMENT_COLUMNS)


def numbered_orders(spark: SparkSession, tables: str) -> DataFrame:
    """Rows without a number of their own, numbered by their place in the file."""
    orders = spark.read.parquet(f"{tables}/orders.parquet")
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    rows = orders.select(F.monotonically_increasing_id().alias(ROW_NUMBER), place.alias(POSITION), "o_orderkey")
    staging = _staged(spark)
    written = staging.write(rows, "rows")
    offsets = staging.write(split_offsets(written, staging.write), "offsets")
    return number_rows(written, offsets, offsets.count())


def quoted_records(spark: SparkSession, tables: str) -> DataFrame:
    """Texts with line breaks, written as CSV files and read back by many tasks a file."""
    staging = _staged(spark)
    files = csv_of_texts(spark, tables, f"{staging.root}/csv")
    read = read_split_csv_leads(spark, files, staging.write)
    return read.select(F.col("doc_id").cast("bigint"), "source", F.length("text").cast("bigint").alias("n_chars"),
                       F.md5("text").alias("text_md5"))


def lead_balance(spark: SparkSession, tables: str) -> DataFrame:
    """What becomes of the leads, each result counted by itself: nothing may be lost or doubled."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("leads")).select(F.lit(name).alias("result"), "leads")

    leads = normalized_once(spark, tables)
    return counted(leads, "raw").unionByName(counted(merge_leads(accept_leads(leads)), "clean")).unionByName(
        counted(_rejects_of(leads), "rejected"))


def score_merged(spark: SparkSession, tables: str) -> DataFrame:
    enriched = enrich_leads(merged(spark, tables), normalized=True)
    scored = score_leads(enriched, SCORING_RULES, normalized=True)
    return _with_reasons_as_text(scored).select(ROW_NUMBER, "title", "lead_score", "score_reasons")


def clean_leads(spark: SparkSession, tables: str) -> DataFrame:
    return _with_reasons_as_text(clean(spark, tables))


def _report(spark: SparkSession, tables: str) -> DataFrame:
    """The report of the whole job over the leads."""
    output = f"{_staged(spark).root}/job"
    return run_job(spark, raw_leads(spark, tables), output, row_number=ROW_NUMBER).summary


def summary_scalars(spark: SparkSession, tables: str) -> DataFrame:
    rounded = {c: F.round(c, 9) for c in ("average_lead_score", "percent_enriched_from_raw")}
    return _report(spark, tables).drop("enrichment_status_counts", "rejection_reason_counts").withColumns(rounded)


def report_counts(spark: SparkSession, tables: str) -> DataFrame:
    """Both maps of counts of the job's report, a row for each entry."""
    report = _report(spark, tables)
    parts = [report.select(F.lit(kind).alias("kind"), F.explode(f"{kind}_counts").alias("label", "leads"))
             for kind in ("enrichment_status", "rejection_reason")]
    return parts[0].unionByName(parts[1])


def replayed_requests(spark: SparkSession, tables: str) -> DataFrame:
    """Companies after a second round of requests: only those that two stored attempts left open are asked."""
    staging, by = _staged(spark), ["company"]
    requests = staging.write(distinct_requests(merged(spark, tables), by), "requests")
    stored = stored_attempts(spark, tables).filter("attempt <= 2")
    asked = staging.write(provider_responses(open_requests(requests, stored, by), SecondRound, 2), "asked")
    fields = [f.name for f in stored.schema["response"].dataType]
    again = attempts_of(asked, by).withColumn("response", F.struct(*[F.col(f"response.{f}").alias(f) for f in fields]))
    log = staging.write(stored.withColumn("attempt", F.col("attempt").cast("bigint")).unionByName(again), "log")
    tries = log.groupBy(F.col("company").alias("_company")).agg(F.max("attempt").alias("tries"))
    known = answers_of(requests, log, by).join(tries, F.col("company").eqNullSafe(F.col("_company")))
    return known.select("company", "leads", "response.industry", "response.company_size", "response.enrichment_status", "tries")


def indexed_rules(spark: SparkSession, tables: str) -> DataFrame:
    """The first of thousands of rules that has a keyword in each order's text."""
    return with_first_rule(rule_texts(spark, tables), "text", rule_keywords(spark, tables), "place")


def entry(spark: SparkSession) -> DataFrame:
    """All clean leads of the smallest tables: normalised, merged, enriched, scored."""
    return clean_leads(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {
        "prepare_leads": prepared,
        "normalize_text": normalize_text,
        "normalize_email": _over(prepared, raw_email=lambda: L.normalize_text("raw_email"),
                                 email=lambda: L.normalize_email("email")),
        "normalize_phone": _over(prepared, phone=lambda: L.normalize_phone("phone")),
        "split_name": _over(prepared, full_name=lambda: L.normalize_text("full_name"),
                            first_name=lambda: L.first_name("full_name"),
                            last_name=lambda: L.last_name("full_name")),
        "normalize_date": _over(prepared, lead_date=lambda: L.normalize_date("lead_date")),
        "country_dimension": country_matches,
        "country_table": large_country_table,
        "normalize_country": lambda spark, tables: normalize_leads(
            prepared(spark, tables).withColumn("country_text", L.normalize_text("country"))
        ).select(ROW_NUMBER, "country_text", "country"),
        "email_domain": _over(normalized, "email", email_domain=lambda: L.email_domain("email")),
        "normalize_leads": normalized,
        "lead_completeness": lambda spark, tables: lead_completeness(
            normalized(spark, tables)).select(ROW_NUMBER, "completeness"),
        "accepted_leads": accepted,
        "rejected_invalid": lambda spark, tables: reject_leads(normalized(spark, tables)),
        "merge_leads": merged,
        "rejected_duplicates": lambda spark, tables: duplicate_rejects(accept_leads(normalized_once(spark, tables))),
        "rejected_leads": rejected,
        "enrich_industry": _over(merged, "company", "title", industry=lambda: F.when(
            F.col("company").isNotNull(), infer_industry("company", "title"))),
        "enrich_size": _over(merged, "company", company_size=lambda: F.when(
            F.col("company").isNotNull(), infer_company_size("company"))),
        "enrich_domain": _over(merged, "company",
                               company_domain=lambda: infer_company_domain("company")),
        "enriched_leads": lambda spark, tables: enrich_leads(merged(spark, tables), normalized=True),
        "provider_enrichment": provider_enrichment,
        "provider_scores": provider_scores,
        "shared_requests": shared_requests,
        "rule_match": rule_match,
        "score_leads": score_merged,
        "clean_leads": clean_leads,
        "crm_export": lambda spark, tables: crm_export(clean(spark, tables)),
        "crm_export_all": lambda spark, tables: crm_export(clean(spark, tables), ready_only=False),
        "summary_scalars": summary_scalars,
        "status_counts": lambda spark, tables: status_counts(clean(spark, tables)),
        "reason_counts": lambda spark, tables: reason_counts(rejected(spark, tables)),
        "report_counts": report_counts,
        "replayed_requests": replayed_requests,
        "indexed_rules": indexed_rules,
        "lead_balance": lead_balance,
        "numbered_orders": numbered_orders,
        "quoted_records": quoted_records,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql() | LLM_ORACLES
