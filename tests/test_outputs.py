import json

import pytest
from pyspark.sql import functions as F

from leadmill.fixed_values import CLEAN_COLUMNS, CRM_NAMES
from leadmill.operators import (
    crm_export, finalize_leads, reason_counts, reasons_text, status_counts, summary_report,
)
from leadmill.schema import CLEAN_LEAD, REJECTED_LEAD
from leadmill.sources.sinks import write_by_reason, write_csv, write_summary, write_table


def clean_frame(spark, *rows):
    return spark.createDataFrame([tuple(row.get(c) for c in CLEAN_COLUMNS) for row in rows], CLEAN_LEAD)


READY = {"source_row_number": 1, "first_name": "Jo", "last_name": "Doe", "email": "jo@x.io",
         "company": "Acme", "lead_score": 42, "score_reasons": ["one", "two"],
         "enrichment_status": "enriched", "salesforce_ready": True}
NOT_READY = {"source_row_number": 2, "email": "b@x.io", "lead_score": 7, "score_reasons": [],
             "enrichment_status": "not_found", "salesforce_ready": False}


def rejected_frame(spark, *reasons):
    blank = [None] * (len(REJECTED_LEAD) - 2)
    return spark.createDataFrame([(n, *blank, r) for n, r in enumerate(reasons)], REJECTED_LEAD)


def test_finalize_fills_absent_columns(spark):
    row = finalize_leads(spark.createDataFrame([("a@x.io", "Acme")], "email string, company string")).first()
    assert list(row.asDict()) == CLEAN_COLUMNS
    assert (row.enrichment_status, row.lead_score, row.score_reasons) == ("not_enriched", 0, [])
    assert (row.industry, row.last_name, row.salesforce_ready) == (None, None, False)


def test_finalize_replaces_blank_values_and_keeps_others(spark):
    frame = spark.createDataFrame(
        [(1, "a@x.io", "Doe", "Acme", "  ", "", None, None), (2, "b@x.io", " ", "Acme", " x ", "failed", 0, ["r"])],
        "source_row_number int, email string, last_name string, company string, industry string, "
        "enrichment_status string, lead_score int, score_reasons array<string>")
    first, second = finalize_leads(frame).orderBy("source_row_number").collect()
    assert (first.industry, first.enrichment_status, first.lead_score, first.score_reasons) == (
        None, "not_enriched", 0, [])
    assert (second.industry, second.enrichment_status, second.score_reasons) == (" x ", "failed", ["r"])
    assert (first.salesforce_ready, second.salesforce_ready) == (True, False)
    assert finalize_leads(frame).dtypes == spark.createDataFrame([], CLEAN_LEAD).dtypes


def test_finalize_of_clean_text_needs_null_checks_only(spark):
    frame = clean_frame(spark, READY, NOT_READY)
    assert sorted(map(str, finalize_leads(frame, normalized=True).collect())) == sorted(
        map(str, finalize_leads(frame).collect()))


def test_export_renames_orders_and_filters(spark):
    frame = clean_frame(spark, READY, NOT_READY)
    rows = crm_export(frame).collect()
    assert [r.Email for r in rows] == ["jo@x.io"]
    assert list(rows[0].asDict()) == list(CRM_NAMES.values())
    assert (rows[0].Score_Reasons__c, rows[0].Lead_Score__c, rows[0].Source_Row_Number__c) == ("one; two", 42, 1)
    everything = crm_export(frame, ready_only=False).orderBy("Source_Row_Number__c").collect()
    assert [r.Score_Reasons__c for r in everything] == ["one; two", None]


def test_export_adds_missing_columns_and_does_without_the_flag(spark):
    frame = spark.createDataFrame([("a@x.io", "Acme")], "email string, company string")
    row = crm_export(frame).first()
    assert (row.Email, row.Title, row.Industry__c, row.Score_Reasons__c, row.Source_Row_Number__c) == (
        "a@x.io", None, None, None, None)


@pytest.mark.parametrize(("kind", "given", "expected"), [
    ("array<string>", ["one", "two"], "one; two"),
    ("array<string>", [" one ", " ", "two"], "one; two"),
    ("array<string>", ["", " "], None),
    ("array<string>", [], None),
    ("array<string>", None, None),
    ("string", " one ", "one"),
    ("string", "  ", None),
])
def test_reasons_as_text(spark, kind, given, expected):
    frame = spark.createDataFrame([(given,)], f"r {kind}")
    assert frame.select(reasons_text("r", frame.schema["r"].dataType)).first()[0] == expected


def test_summary(spark):
    raw = spark.range(8)
    report = summary_report(raw, clean_frame(spark, READY, NOT_READY, READY),
                            rejected_frame(spark, "x", "y", "y")).collect()
    assert [r.asDict() for r in report] == [{
        "raw_rows": 8, "clean_rows": 3, "rejected_rows": 3, "salesforce_ready_rows": 2,
        "clean_but_not_salesforce_ready_rows": 1, "average_lead_score": 91 / 3,
        "percent_enriched_from_raw": 25.0,
        "enrichment_status_counts": {"enriched": 2, "not_found": 1},
        "rejection_reason_counts": {"x": 1, "y": 2},
    }]


def test_counts_in_the_summary_start_with_the_most_frequent(spark):
    report = summary_report(spark.range(1), clean_frame(spark), rejected_frame(spark, "x", "z", "y", "z"))
    text = report.select(F.to_json("rejection_reason_counts")).first()[0]
    assert text == '{"z":2,"x":1,"y":1}'


def test_summary_of_nothing(spark):
    row = summary_report(spark.range(0), clean_frame(spark), rejected_frame(spark)).first()
    assert (row.raw_rows, row.clean_rows, row.average_lead_score, row.percent_enriched_from_raw) == (0, 0, 0.0, 0.0)
    assert row.enrichment_status_counts == {}


def test_summary_without_the_optional_columns(spark):
    clean = spark.createDataFrame([("a@x.io",), ("b@x.io",)], "email string")
    row = summary_report(spark.range(2), clean, spark.range(1)).first()
    assert (row.clean_rows, row.salesforce_ready_rows, row.clean_but_not_salesforce_ready_rows) == (2, 0, 2)
    assert (row.rejected_rows, row.average_lead_score, row.rejection_reason_counts) == (1, 0.0, {})


def test_null_scores_count_as_zero(spark):
    row = summary_report(spark.range(2), clean_frame(spark, READY, {**READY, "lead_score": None}),
                         rejected_frame(spark)).first()
    assert row.average_lead_score == 21.0


def test_counts(spark):
    assert {tuple(r) for r in status_counts(clean_frame(spark, READY, NOT_READY, READY)).collect()} == {
        ("enriched", 2), ("not_found", 1)}
    assert {tuple(r) for r in reason_counts(rejected_frame(spark, "x", "x")).collect()} == {("x", 2)}


def test_tables_come_back_as_written(spark, tmp_path):
    frame = clean_frame(spark, READY, NOT_READY)
    back = write_table(frame, str(tmp_path / "clean"))
    assert back.schema == frame.schema
    assert sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_table(frame, str(tmp_path / "clean"))
    assert write_table(frame.limit(1), str(tmp_path / "clean"), "overwrite").count() == 1


def test_csv_keeps_padding_quotes_and_nulls(spark, tmp_path):
    row = {**READY, "title": '  a, "b"\nc ', "company": None}
    write_csv(clean_frame(spark, row), str(tmp_path / "out"))
    back = spark.read.options(header=True, escape='"', multiLine=True).csv(str(tmp_path / "out")).first()
    assert (back.title, back.company, back.score_reasons) == ('  a, "b"\nc ', None, "one; two")


def test_summary_file_is_one_indented_document(spark, tmp_path):
    write_summary(summary_report(spark.range(1), clean_frame(spark, READY), rejected_frame(spark)),
                  str(tmp_path / "report"))
    files = list((tmp_path / "report").glob("part-*"))
    text = files[0].read_text()
    assert len(files) == 1 and text.startswith('{\n  "raw_rows"')
    assert json.loads(text)["enrichment_status_counts"] == {"enriched": 1}


def test_one_reason_is_replaced_alone_and_others_are_not_read(spark, tmp_path):
    def rejects(*rows):
        return spark.createDataFrame(rows, "source_row_number long, email string, drop_reason string")
    path = str(tmp_path / "rejected")
    write_by_reason(rejects((1, None, "bad"), (2, "x", "twice"), (3, None, "bad")), path)
    table = write_by_reason(rejects((4, None, "bad")), path)
    assert sorted(map(tuple, table.collect())) == [(2, "x", "twice"), (4, None, "bad")]
    assert table.columns == ["source_row_number", "email", "drop_reason"]
    text = table.filter("drop_reason = 'twice'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(drop_reason" in text
    write_by_reason(rejects(), path)  # nothing to replace
    assert table.count() == 2


def test_rejects_are_written_in_order_from_many_tasks(spark, tmp_path):
    from leadmill.operators import accept_leads, all_rejects, merge_leads, ordered_rejects
    from tests.leads import normalized_frame
    rows = [{"source_row_number": n, "email": None if n % 7 == 0 else f"u{n % 5 if n % 3 else 0}@x.io"} for n in range(1, 400)]
    leads = normalized_frame(spark, *rows).repartition(9)
    merged = merge_leads(accept_leads(leads))
    rejects = ordered_rejects(all_rejects(leads, merged), merged, 6)
    rejects.write.parquet(str(tmp_path / "ordered"))
    files = sorted((tmp_path / "ordered").glob("part-*"))
    assert len(files) > 3
    written = [r.source_row_number for f in files for r in spark.read.parquet(str(f)).collect()]
    first = {}
    for r in rows:
        if r["email"]:
            first.setdefault(r["email"], r["source_row_number"])
    bad = [r["source_row_number"] for r in rows if not r["email"]]
    twice = sorted((first[r["email"]], r["source_row_number"]) for r in rows if r["email"] and first[r["email"]] != r["source_row_number"])
    assert written == bad + [n for _, n in twice]
