"""What the physical plans have to look like to work at scale."""

import re

import pytest

import __spark_entry__ as registry
from leadmill.plans import run_job

TABLES = "/root/testdata/sf0.001"


def plan(spark, name):
    frame = registry.queries()[name](spark, TABLES)
    return frame._jdf.queryExecution().executedPlan().toString()


def nodes(text, name):
    return re.findall(rf"^[ :+\-*()\d]*{name}\b.*", text, re.M)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.LLM_QUERIES)))
def test_no_query_pairs_rows_without_a_key(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not nodes(text, "Window")


@pytest.mark.parametrize("name", ["rejected_leads", "rejected_duplicates", "reason_counts", "lead_balance"])
def test_results_that_read_the_leads_twice_read_one_normalised_table(spark, name):
    scans = nodes(plan(spark, name), "FileScan parquet")
    assert len(scans) >= 2 and not any("o_orderkey" in s or "o_custkey" in s for s in scans)


def test_the_report_reads_no_leads(spark):
    text = plan(spark, "summary_scalars")
    assert len(nodes(text, "FileScan parquet")) == 1 and "Join" not in text and "raw_rows" in text


def test_leads_that_one_task_reads_are_dealt_out(spark):
    assert "RoundRobin" not in (text := plan(spark, "normalize_leads")) and re.search(r"hashpartitioning\(o_orderkey#\d+L?, 8\), REPARTITION_BY_NUM", text)


def test_rows_of_the_job_are_numbered_and_rejected_at_scale(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in "abc":
        (tmp_path / "in" / f"{name}.csv").write_text(
            "Name,Email,Title,Company,Phone,Source,Country,Created At\n" + "".join(f"n{i},{name}{i % 40}@x.io,,,,,,\n" for i in range(90)))
    job = run_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), keep_staged=True)
    text = job.normalized._jdf.queryExecution().executedPlan().toString()
    assert not nodes(text, "Window") and "SinglePartition" not in text
    assert sorted(r[0] for r in job.normalized.select("source_row_number").collect()) == list(range(1, 271))


def test_only_accepted_rows_are_joined_for_the_rejects(spark):
    text = plan(spark, "rejected_leads")
    # The rows that break a rule are one side of a union, without an exchange below it.
    assert nodes(text, "Union") and len([n for n in nodes(text, ".*Join") if "LeftAnti" in n]) == 1


def test_groups_are_reduced_before_they_are_shuffled(spark):
    for name in ("merge_leads", "clean_leads", "status_counts"):
        text = plan(spark, name)
        assert "functions=[partial_" in text
        assert not nodes(text, "(?:FlatMapGroups|ArrowEvalPython)")


def test_merge_shuffles_leads_once(spark):
    text = plan(spark, "merge_leads")
    by_email = [line for line in nodes(text, "Exchange") if "hashpartitioning(email" in line]
    assert len(by_email) == 1


def test_rejects_cross_the_network_by_row_number(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are big
    try:
        text = plan(spark, "rejected_leads")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "LeftAnti" in text and "hashpartitioning(source_row_number" in text


def test_survivors_read_only_what_they_need(spark):
    scans = nodes(plan(spark, "rejected_duplicates"), "FileScan parquet")
    assert any("ReadSchema: struct<source_row_number:bigint,email:string>" in s for s in scans)


def test_country_table_is_broadcast(spark):
    assert re.search(r"BroadcastHashJoin \[country_key#\d+\], \[country_key#\d+\], LeftOuter",
                     plan(spark, "normalize_leads"))


@pytest.mark.parametrize("name", ["normalize_leads", "clean_leads", "crm_export", "rejected_leads"])
def test_no_python_in_the_main_path(spark, name):
    assert "Python" not in plan(spark, name) and "MapInArrow" not in plan(spark, name)
