import json

import pytest
from pyspark.sql import functions as F

from leadmill.functions import country_key, normalize_text
from leadmill.operators.normalize import conform_country
from leadmill.plans import staging as staging_module
from leadmill.plans import Staging
from leadmill.schema import NORMALIZED_COLUMNS
from leadmill.sources import countries
from leadmill.sources import leads as leads_module
from leadmill.sources.leads import (
    check_contract, number_rows, prepare_leads, read_csv_leads, split_offsets,
)
from leadmill.sources.rules import load_scoring_rules
from tests.leads import raw_frame

HEADER = "Name,Email,Title,Company,Phone,Source,Country,Created At"


def numbered(spark, path, multiline=True):
    staging = Staging(spark)
    written = staging.write(prepare_leads(read_csv_leads(spark, path, multiline)), "rows")
    offsets = staging.write(split_offsets(written, staging.write), "offsets")
    return number_rows(written, offsets, offsets.count())


def test_csv_quotes_line_breaks_blank_lines_and_null_tokens(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        HEADER + ",Extra\n"
        '"Doe, ""Jo""\nJunior",jo@x.io,N/A, N/A,5551212,Web,NA,,z\n'
        "\n"
        '"",b@x.io,null,None,call me,NaN,,2025-01-01,\n', encoding="utf-8")
    rows = read_csv_leads(spark, str(tmp_path), multiline=True).collect()
    assert [r.Name for r in rows] == ['Doe, "Jo"\nJunior', None]
    assert (rows[0].Title, rows[0].Company, rows[0].Phone, rows[0].Country) == (None, " N/A", "5551212", None)
    assert (rows[1].Title, rows[1].Company, rows[1].Source) == (None, None, None)


def test_columns_are_found_by_name_and_extra_ones_dropped(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "Extra,Created At,Email,Name,Title,Company,Phone,Source,Country\n"
        "z,2025-01-01, A@x.io ,Jo,T,C,1,S,US\n")
    row = prepare_leads(read_csv_leads(spark, str(tmp_path))).first()
    assert (row.full_name, row.email, row.raw_email, row.lead_date) == ("Jo", " A@x.io ", " A@x.io ", "2025-01-01")
    assert (row.first_name, row.last_name) == (None, None)


def test_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\nJo,a@x.io,T,C,1,S,US,\n")
    (tmp_path / "b.csv").write_text("Email,Name,Title,Company,Phone,Source,Country,Created At\na@x.io,Jo,T,C,1,S,US,\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv_leads(spark, str(tmp_path)).collect()


def test_missing_columns_are_listed_in_declared_order(spark):
    frame = spark.createDataFrame([("a",)], "email string").withColumn("Title", F.lit("t"))
    with pytest.raises(ValueError, match="Missing expected input columns: Name, Email, Company, Phone"):
        check_contract(frame)
    with pytest.raises(ValueError, match="Missing expected input columns: Source$"):
        prepare_leads(raw_frame(spark, {}).drop("Source"), "n")


def test_prepared_columns_with_a_given_row_number(spark):
    prepared = prepare_leads(raw_frame(spark, {}, {"Email": None}), "n")
    assert prepared.columns == NORMALIZED_COLUMNS
    assert dict(prepared.dtypes)["source_row_number"] == "bigint"
    assert dict(prepared.dtypes)["first_name"] == "string"
    assert sorted(r[0] for r in prepared.collect()) == [1, 2]


def test_rows_of_many_files_and_splits_are_numbered_in_input_order(spark, tmp_path):
    expected = []
    for name, count in (("a", 700), ("b", 1), ("c", 1500)):
        rows = [f"{name}{i}" for i in range(count)]
        expected += rows
        (tmp_path / f"{name}.csv").write_text(
            "\n".join([HEADER, *[f"{r},{r}@x.io,T,C,1,S,US," for r in rows]]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        assert read_csv_leads(spark, str(tmp_path), False).rdd.getNumPartitions() > 4
        rows = numbered(spark, str(tmp_path), multiline=False).orderBy("source_row_number").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.source_row_number for r in rows] == list(range(1, len(expected) + 1))
    assert [r.full_name for r in rows] == expected
    assert rows[0].asDict().keys() == set(NORMALIZED_COLUMNS)


def test_numbering_is_the_same_when_the_splits_are_too_many_to_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(leads_module, "MAX_BROADCAST_BYTES", 0)
    (tmp_path / "a.csv").write_text(HEADER + "\n" + "".join(f"n{i},,,,,,,\n" for i in range(50)))
    rows = numbered(spark, str(tmp_path)).orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.full_name) for r in rows] == [(i + 1, f"n{i}") for i in range(50)]


def test_frames_that_read_no_files_are_numbered_by_partition(spark):
    frame = raw_frame(spark, *[{"Name": f"n{i}"} for i in range(40)])
    assert frame.rdd.getNumPartitions() > 1
    staging = Staging(spark)
    written = staging.write(prepare_leads(frame), "rows")
    rows = number_rows(written, split_offsets(written, staging.write), 8).orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.full_name) for r in rows] == [(i + 1, f"n{i}") for i in range(40)]


def test_staging_is_in_the_folder_the_session_names(spark):
    assert Staging(spark).root.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_staging_outside_local_mode_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return "yarn" if key == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_module.shared_folder(Session())


@pytest.mark.parametrize(("given", "expected"), [
    ("ma", "Morocco"), ("BGD", "Bangladesh"), ("Iceland", "Iceland"), ("q.a.", "Qatar"), ("Ivory Coast", "Côte d'Ivoire"),
    ("Bosnia & Herzegovina", "Bosnia and Herzegovina"), ("St. Kitts & Nevis", "Saint Kitts and Nevis"), ("Burma", "Myanmar"),
    ("Deutschland", "Germany"), ("holland", "Netherlands"), ("Narnia  North ", "Narnia North"), ("", None), (None, None),
])
def test_countries_are_conformed(spark, given, expected):
    frame = spark.createDataFrame([(given,)], "country string").select(normalize_text("country").alias("country"))
    assert conform_country(frame, countries.country_dimension(spark)).first().country == expected


def test_a_later_country_wins_and_blank_spellings_are_skipped(spark, tmp_path):
    path = tmp_path / "countries.json"
    path.write_text(json.dumps([
        {"canonical_name": "Old", "alpha2": "OO", "alpha3": None, "aliases": ["Shared", ""]},
        {"canonical_name": "New", "aliases": ["shared."]},
    ]))
    rows = countries.country_dimension(spark, countries.load_countries(path)).collect()
    assert {tuple(r) for r in rows} == {("old", "Old"), ("oo", "Old"), ("shared", "New"), ("new", "New")}


def test_default_country_keys_do_not_clash(spark):
    entries = countries.default_countries(spark)
    assert len(entries) > 240 and len({e["canonical_name"] for e in entries}) == len(entries)
    listed = countries.spellings(entries)
    rows = spark.createDataFrame(listed, "s string, c string, o int")
    clash = rows.groupBy(country_key("s")).agg(F.countDistinct("c").alias("n")).filter("n > 1")
    assert clash.count() == 0
    given = spark.createDataFrame(listed, "country string, c string, o int")
    conformed = conform_country(given, countries.country_dimension(spark))
    assert conformed.filter("country <> c").count() == 0


def test_a_dimension_is_broadcast_only_while_bounded(spark, monkeypatch):
    def plan():
        return countries.country_dimension(spark)._jdf.queryExecution().analyzed().toString()

    assert "strategy=broadcast" in plan()
    monkeypatch.setattr(countries, "MAX_BROADCAST_BYTES", 3)
    assert "strategy=broadcast" not in plan()


def test_rules_are_read_from_json(tmp_path):
    (tmp_path / "rules.json").write_text('{"base_score": 3, "seniority_scores": []}', encoding="utf-8")
    assert load_scoring_rules(tmp_path / "rules.json") == {"base_score": 3, "seniority_scores": []}




def country_lines(tmp_path, *lines):
    folder = tmp_path / "countries"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(lines), encoding="utf-8")
    return str(folder)


def test_a_country_table_gives_what_the_list_gives(spark, tmp_path):
    entries = [{"canonical_name": f"Land {i}", "alpha2": f"L{i % 7}", "alpha3": None if i % 3 else "",
                "aliases": None if i % 5 == 0 else ["Shared", f"The & {i % 20}.", ""]} for i in range(300)]
    path = country_lines(tmp_path, *map(json.dumps, entries))
    staging = staging_module.Staging(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # many splits of the file
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = countries.read_country_table(spark, path)
        assert read.rdd.getNumPartitions() > 3
        found = countries.country_table(read, staging.write).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, found)) == sorted(map(tuple, countries.country_dimension(spark, entries).collect()))


def test_a_given_load_order_wins_over_the_place(spark, tmp_path):
    path = country_lines(tmp_path, *[json.dumps({"canonical_name": n, "aliases": ["s"]} | o) for n, o in (
        ("Second", {"load_order": 2}), ("First", {"load_order": 1}), ("Unordered", {}))])
    found = countries.country_table(countries.read_country_table(spark, path), staging_module.Staging(spark, str(tmp_path)).write)
    assert {r.country_key: r.canonical_country for r in found.collect()}["s"] == "Second"


@pytest.mark.parametrize("line", ['{"alpha2": "XX"}', '{"canonical_name": " "}', "no object"])
def test_lines_that_are_no_country_end_the_job(spark, tmp_path, line):
    path = country_lines(tmp_path, '{"canonical_name": "Good"}', line)
    with pytest.raises(Exception, match="canonical_name|MALFORMED|Malformed"):
        countries.country_table(countries.read_country_table(spark, path), staging_module.Staging(spark, str(tmp_path)).write)


def test_a_country_table_is_broadcast_only_while_bounded(spark, tmp_path, monkeypatch):
    path = country_lines(tmp_path, '{"canonical_name": "Good", "alpha2": "GG"}')

    def plan(name):
        staging = staging_module.Staging(spark, str(tmp_path / name))
        dimension = countries.country_table(countries.read_country_table(spark, path), staging.write)
        frame = spark.createDataFrame([("gg",), ("other",)], "country string")
        assert sorted(r.country for r in conform_country(frame, dimension).collect()) == ["Good", "other"]
        return dimension._jdf.queryExecution().analyzed().toString()

    assert "strategy=broadcast" in plan("small")
    monkeypatch.setattr(countries, "MAX_BROADCAST_BYTES", 3)
    assert "strategy=broadcast" not in plan("large")
