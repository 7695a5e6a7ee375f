import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import leadmill
import tests
from leadmill.operators import (
    ProviderResponse, TransientProviderError, enrich_with_provider, provider_responses,
)
from leadmill.operators import provider as provider_module
from leadmill.operators.provider import (
    ENRICHMENT_COLUMNS, distinct_requests, enrichment_of, first_answers, join_answers,
)
from leadmill.plans import Staging
from tests.leads import normalized_frame
from tests.providers import Directory

cloudpickle.register_pickle_by_value(leadmill)
cloudpickle.register_pickle_by_value(tests)


class FailsTwice:
    """Answers the third time it is asked for a lead."""

    provider_name = "flaky"

    def __init__(self):
        self.asked = {}

    def enrich(self, request):
        count = self.asked[request["email"]] = self.asked.get(request["email"], 0) + 1
        if count < 3:
            raise TransientProviderError(f"try {count}")
        return ProviderResponse("media", None, None, "enriched", self.provider_name, True,
                                raw_payload={"count": str(count)})


class Nameless:
    def enrich(self, request):
        raise TransientProviderError("down")


class Broken:
    def enrich(self, request):
        raise KeyError("no such thing")


class Odd:
    def enrich(self, request):
        return ProviderResponse(None, None, None, "maybe", "odd", False)


def leads(spark):
    return normalized_frame(spark, {"email": "a@x.io", "company": "Nova Studio"},
                            {"email": "b@x.io", "company": "air inc"},
                            {"email": "c@x.io", "title": "Brand Head"})


def responses(spark, provider, **options):
    rows = provider_responses(leads(spark), provider, **options).orderBy("source_row_number").collect()
    return [r.response for r in rows]


def test_retry_until_an_answer_comes(spark):
    first = responses(spark, FailsTwice)[0]
    assert (first.enrichment_status, first.attempts, first.industry) == ("enriched", 3, "media")
    assert (first.provider_name, first.provider_record_found, first.raw_payload) == (
        "flaky", True, {"count": "3"})


def test_exhausted_retries_give_a_failed_lead(spark):
    first = responses(spark, FailsTwice, max_attempts=2)[0]
    assert (first.enrichment_status, first.attempts, first.error_message) == ("failed", 2, "try 2")
    assert (first.industry, first.company_size, first.company_domain) == (None, None, None)
    assert (first.provider_record_found, first.raw_payload) == (False, {})
    assert responses(spark, Nameless)[0].provider_name == "unknown_provider"


def test_other_errors_end_the_job(spark):
    with pytest.raises(Exception, match="no such thing"):
        responses(spark, Broken)
    with pytest.raises(Exception, match="unknown enrichment status"):
        responses(spark, Odd)


def test_at_least_one_attempt(spark):
    with pytest.raises(ValueError, match="max_attempts must be at least 1"):
        provider_responses(leads(spark), Directory, max_attempts=0)


def test_answers_are_put_in_place(spark):
    rows = {r.email: r for r in enrich_with_provider(leads(spark), Directory, partitions=3).collect()}
    assert (rows["a@x.io"].industry, rows["a@x.io"].company_size) == ("retail", "enterprise")
    assert rows["b@x.io"].enrichment_status == "failed" and rows["b@x.io"].industry is None
    assert rows["c@x.io"].enrichment_status == "not_found"


def test_request_text_is_cleaned_but_the_lead_is_not_changed(spark):
    lead = normalized_frame(spark, {"email": "a@x.io", "company": "  Nova   Studio "})
    row = enrich_with_provider(lead, Directory).first()
    assert (row.company, row.industry) == ("  Nova   Studio ", "retail")


def test_columns_that_are_absent_are_asked_for_as_null(spark):
    frame = spark.createDataFrame([(1, "Nova Studio")], "id int, company string")
    row = enrich_with_provider(frame, Directory, partitions=2).first()
    assert tuple(row) == (1, "Nova Studio", "retail", "enterprise", None, "enriched")


def test_empty_input_gains_the_columns(spark):
    empty = enrich_with_provider(leads(spark).limit(0), Directory)
    assert empty.count() == 0 and empty.columns[-4:] == ENRICHMENT_COLUMNS


@pytest.mark.parametrize("few_answers", [True, False])
def test_shared_requests_are_asked_once_and_answered_to_all(spark, monkeypatch, few_answers):
    """A third of the leads make one request, another third make one without a company."""
    if not few_answers:
        monkeypatch.setattr(provider_module, "MAX_BROADCAST_BYTES", 0)
        monkeypatch.setattr(provider_module, "LEADS_PER_COPY", 50)
    numbers = spark.range(1, 3001).select(F.col("id").alias("source_row_number"))
    company = F.when(F.col("source_row_number") % 3 == 0, F.lit("Nova Studio")).when(
        F.col("source_row_number") % 3 == 1, F.concat(F.lit("Co "), F.col("source_row_number")))
    many = numbers.select("source_row_number", company.alias("company"),
                          F.lit(None).cast("string").alias("title"))
    by = ["company", "title"]
    answers = Staging(spark).write(
        provider_responses(distinct_requests(many, by), Directory), "answers")
    assert answers.count() == 1002
    joined = enrichment_of(join_answers(many, answers, by))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert joined.columns == [*many.columns, *ENRICHMENT_COLUMNS]
    rows = joined.collect()
    assert len(rows) == 3000
    assert {r.enrichment_status for r in rows} == {"enriched", "not_found"}
    assert all((r.industry == "retail") == (r.company == "Nova Studio") for r in rows)


def test_stored_attempts_give_the_first_answer_within_the_bound(spark):
    def attempt(company, n, status, error=None):
        return (company, n, (status, error, n))

    stored = spark.createDataFrame(
        [attempt("a", 1, "failed", "x"), attempt("a", 2, "enriched"), attempt("a", 3, "not_found"),
         attempt("b", 1, "failed", "x"), attempt("b", 2, "failed", "y"), attempt("b", 3, "enriched"),
         attempt(None, 1, "not_found")],
        "company string, attempt int, response struct<enrichment_status: string, error_message: string, attempts: int>")

    def found(most):
        return {r.company: tuple(r.response) for r in first_answers(stored, ["company"], most).collect()}

    assert found(2) == {"a": ("enriched", None, 2), "b": ("failed", "y", 2), None: ("not_found", None, 1)}
    assert found(3)["b"] == ("enriched", None, 3)  # the failed request was replayed
    with pytest.raises(ValueError, match="at least 1"):
        first_answers(stored, ["company"], 0)
