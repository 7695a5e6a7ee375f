"""The preparation as a job: files in, tables out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession

from leadmill.operators.accept import EMAIL_RULE, MALFORMED_RULE, Rule, accept_leads
from leadmill.operators.export import crm_export
from leadmill.operators.merge import all_rejects, merge_leads
from leadmill.operators.normalize import normalize_leads
from leadmill.operators.provider import (
    REQUEST_FIELDS,
    answers_of,
    attempts_made,
    distinct_requests,
    enrichment_of,
    join_answers,
    log_attempts,
    open_requests,
    provider_responses,
)
from leadmill.operators.report import (
    clean_figures,
    raw_figures,
    rejected_figures,
    report_of_figures,
)
from leadmill.plans.prepare import clean_from_merged
from leadmill.plans.run_folder import RunFolder, published_run
from leadmill.sources.countries import country_dimension, country_table, read_country_table
from leadmill.sources.files import fingerprint
from leadmill.sources.leads import (
    POSITION,
    WELL_FORMED,
    check_row_numbers,
    number_rows,
    prepare_leads,
    read_csv_leads,
    split_offsets,
    spread,
)
from leadmill.sources.sinks import write_csv, write_summary
from leadmill.sources.split_csv import read_split_csv_leads


class JobTables(NamedTuple):
    """What the job wrote; ``normalized`` and ``attempts`` only if it keeps what it staged, the latter if it
    had a provider."""

    clean: DataFrame
    rejected: DataFrame
    crm: DataFrame
    summary: DataFrame
    normalized: DataFrame | None
    attempts: DataFrame | None
    folder: RunFolder


def run_job(
    spark: SparkSession,
    source: str | list[str] | DataFrame,
    output: str,
    *,
    run: str | None = None,
    row_number: Column | str | None = None,
    multiline: bool | str = False,
    malformed: str = "fail",
    accept: Sequence[Rule] = (EMAIL_RULE,),
    tasks: int | None = None,
    rules: dict | None = None,
    countries: list[dict] | str | None = None,
    make_provider: Callable[[], Any] | None = None,
    max_attempts: int = 3,
    provider_fields: Sequence[str] = REQUEST_FIELDS,
    provider_partitions: int | None = None,
    attempts_log: str | None = None,
    ready_only: bool = True,
    csv_copies: bool = False,
    mode: str = "errorifexists",
    staged: str | None = None,
    keep_staged: bool = False,
) -> JobTables:
    """Read CSV files (or take a raw table) and write clean, rejected and CRM leads and a summary.

    Each costly stage runs once and is written down: the normalised leads, then the clean
    leads. What follows reads from there: the rejects are an anti join against one column of
    the clean table, the export is a projection of it. The summary is made of figures that Spark
    takes while it writes these tables, and reads nothing again.
    Leads are shuffled twice, for the merge (as partial results) and for the anti join.

    All is written below ``OUTPUT/runs/RUN`` and published by one small file, see
    :mod:`leadmill.plans.run_folder`: a job that ends early publishes nothing. Given the name of
    such a ``run`` again, with the same input files and settings, the job goes on after the last stage
    that was finished; a run that is published is returned as it is. A raw table given as a frame, and a
    provider, are taken to be the same.

    ``multiline`` allows line breaks in cells: True makes each file one task, "split" as many as it has
    splits. ``malformed`` rows of CSV files fail the job or are rejected, see ``read_csv_leads``. Given row
    numbers must be unique. ``countries`` is a list, or the path of a table of any size (see
    ``read_country_table``). A provider is asked once for each different ``provider_fields``, the
    fields of a request that its answers depend on. ``attempts_log`` is a table of all attempts of all
    runs: requests that it answers are not asked again, others are, and their attempts count on.
    ``tasks`` deals the rows read out to so many tasks. The job fails if rows are missing from the
    results. What it has staged is removed in the end, unless ``keep_staged``; the frames returned that
    are read from there are then null.
    """
    if multiline not in (True, False, "split"):
        raise ValueError(f"multiline {multiline!r}; use True, False or 'split'")
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode!r} would mix runs; use 'errorifexists' or 'overwrite'")
    before = published_run(spark, output)
    if before is not None and before != run and mode == "errorifexists":
        raise FileExistsError(f"run {before!r} is published in {output} already")
    from_files = not isinstance(source, DataFrame)
    folder = RunFolder(spark, output, run or uuid.uuid4().hex, {
        "source": fingerprint(spark, source) if from_files else source.schema.simpleString(),
        "row_number": str(row_number), "multiline": multiline, "malformed": malformed, "accept": [list(r) for r in accept],
        "rules": rules,
        "countries": fingerprint(spark, countries) if isinstance(countries, str) else countries, "provider": getattr(make_provider, "__qualname__", str(make_provider)),
        "max_attempts": max_attempts, "provider_fields": list(provider_fields), "attempts_log": attempts_log,
        "ready_only": ready_only, "csv_copies": csv_copies,
    }, staged)

    if before == folder.name:
        clean, rejected, summary = (folder.finished(t, True) for t in ("clean_leads", "rejected_leads", "summary"))
        return JobTables(clean, rejected, crm_export(clean, ready_only), summary, None, None, folder)

    def read() -> DataFrame:
        if not from_files:
            raw = source
        elif multiline == "split":
            raw = read_split_csv_leads(spark, source, folder.write, malformed)
        else:
            raw = read_csv_leads(spark, source, multiline, malformed)
        dimension = (country_table(read_country_table(spark, countries), folder.write) if isinstance(countries, str)
                     else country_dimension(spark, countries))
        # The rows have their ids before they are spread, so the input order is kept.
        return normalize_leads(spread(prepare_leads(raw, row_number), tasks), dimension)

    normalized = folder.table("normalized", read, raw_figures())
    if POSITION in normalized.columns:
        offsets = folder.table("offsets", lambda: split_offsets(normalized, folder.write))
        normalized = number_rows(normalized, offsets, offsets.count())
    else:
        folder.once("numbers_checked", lambda path: check_row_numbers(normalized))

    accept = [*([MALFORMED_RULE] if WELL_FORMED in normalized.columns else []), *accept]
    accepted = accept_leads(normalized, accept).drop(WELL_FORMED)
    attempts = None
    if make_provider is None:
        clean = folder.table("clean_leads", lambda: clean_from_merged(merge_leads(accepted), rules), clean_figures(), True)
    else:
        # Written before they are read, so that nothing is merged or asked for twice.
        merged = folder.table("merged", lambda: merge_leads(accepted))
        by_lead = "email" in provider_fields and attempts_log is None  # which no two merged leads share
        requests = merged if by_lead else distinct_requests(merged, provider_fields)
        if attempts_log is None:
            attempts = folder.table("attempts", lambda: provider_responses(
                requests, make_provider, max_attempts, provider_partitions))
        else:
            # The log as other runs have left it, then the attempts of this one, in a part of its own.
            asked = folder.table("asked", lambda: provider_responses(
                open_requests(requests, attempts_made(spark, attempts_log, but=folder.name), provider_fields),
                make_provider, max_attempts, provider_partitions))
            folder.once("attempts_logged", lambda path: log_attempts(asked, attempts_log, folder.name, provider_fields))
            attempts = folder.table("attempts", lambda: answers_of(
                requests, attempts_made(spark, attempts_log), provider_fields))
        clean = folder.table("clean_leads", lambda: clean_from_merged(
            attempts if by_lead else join_answers(merged, attempts, provider_fields), rules, enrich=enrichment_of),
            clean_figures(), True)

    rejected = folder.table("rejected_leads", lambda: all_rejects(normalized, clean, accept).drop(WELL_FORMED),
                            rejected_figures(accept), True)
    crm = crm_export(clean, ready_only)
    folder.once("crm_export", lambda path: write_csv(crm, path, "overwrite"))
    if csv_copies:
        folder.once("clean_leads_csv", lambda path: write_csv(clean, path, "overwrite"))
        folder.once("rejected_leads_csv", lambda path: write_csv(rejected, path, "overwrite"))
    raw_rows, of_clean, of_rejected = (folder.figures(t) for t in ("normalized", "clean_leads", "rejected_leads"))
    summary = folder.table("summary", lambda: report_of_figures(spark, raw_rows, of_clean, of_rejected), result=True)
    folder.once("summary_report", lambda path: write_summary(summary, path, "overwrite"))
    counts = summary.first()
    if counts.raw_rows != counts.clean_rows + counts.rejected_rows:
        raise RuntimeError(f"of {counts.raw_rows} rows, {counts.clean_rows} are clean and {counts.rejected_rows} rejected")
    folder.publish()
    if not keep_staged:
        folder.remove_staged()
        normalized = attempts = None
    return JobTables(clean, rejected, crm, summary, normalized, attempts, folder)
