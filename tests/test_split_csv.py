import random

import pytest
from pyspark.sql import functions as F

from leadmill.plans import Staging, run_job
from leadmill.sources import split_csv
from leadmill.sources.leads import (
    MALFORMED, number_rows, prepare_leads, read_csv_leads, split_offsets,
)
from leadmill.sources.split_csv import read_split_csv_leads

HEADER = "Name,Email,Title,Company,Phone,Source,Country,Created At"
COLUMNS = HEADER.split(",")


@pytest.fixture
def small_splits(spark):
    """Splits of two kilobytes, so that cells, quotes and line ends fall on both sides of their bounds."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "2048")
    spark.conf.set(names[1], "0")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def random_csv(seed, rows, end="\n"):
    made = random.Random(seed)

    def cell():
        text = "".join(made.choice(['a', 'b', ' ', ',', '"', end, end + end, 'ü', "N/A"]) for _ in range(made.choice([0, 1, 3, 12, 90])))
        quoted = any(c in text for c in ',"\n\r') or made.random() < 0.3
        return '"' + text.replace('"', '""') + '"' if quoted else text

    lines = [HEADER]
    for i in range(rows):
        lines.append(",".join([cell(), f"r{i}@x.io", *[cell() for _ in range(made.choice([6, 6, 6, 3]))]]))
        if made.random() < 0.1:
            lines.append("")
    return end.join(lines) + (end if end != "\n" else made.choice(["", end]))


def split_read(spark, path, malformed="fail"):
    return read_split_csv_leads(spark, str(path), Staging(spark).write, malformed)


def values(rows, columns=COLUMNS):
    return [tuple(r[c] for c in columns) for r in rows]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_one_task_a_file(spark, tmp_path, small_splits, end):
    for seed in range(3):
        (tmp_path / f"{seed}.csv").write_text(random_csv(seed, 60, end), encoding="utf-8", newline="")
    expected = values(read_csv_leads(spark, str(tmp_path), multiline=True).collect())
    read = split_read(spark, tmp_path)
    assert sorted(values(read.collect()), key=str) == sorted(expected, key=str) and len(expected) == 180


def test_many_tasks_read_a_file_and_its_order_stays(spark, tmp_path, small_splits):
    (tmp_path / "in.csv").write_text(random_csv(7, 300), encoding="utf-8")
    lines = spark.read.text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 5
    staging = Staging(spark)
    written = staging.write(prepare_leads(read_split_csv_leads(spark, str(tmp_path), staging.write)), "rows")
    offsets = staging.write(split_offsets(written, staging.write), "offsets")
    rows = number_rows(written, offsets, offsets.count()).orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.email) for r in rows] == [(i + 1, f"r{i}@x.io") for i in range(300)]


def test_a_record_over_several_splits(spark, tmp_path, small_splits):
    cell = "\n".join(f'line {i}, ""quoted""' for i in range(600))
    (tmp_path / "in.csv").write_text(f'{HEADER}\nA,a@x.io,,,,,,\n"{cell}",b@x.io,,,,,,\nC,c@x.io,,,,,,\n')
    rows = split_read(spark, tmp_path).collect()
    assert [r.Email for r in rows] == ["a@x.io", "b@x.io", "c@x.io"]
    assert rows[1].Name == cell.replace('""', '"')


def test_an_open_quote_fails_or_rejects_line_by_line(spark, tmp_path, small_splits):
    good = "".join(f"G{i},g{i}@x.io,,,,,,\n" for i in range(40))
    (tmp_path / "bad.csv").write_text(f'{HEADER}\n{good}"open,h@x.io,,,,,,\nI,i@x.io,,,,,,\n\nJ,j@x.io,,,,,,\n')
    (tmp_path / "good.csv").write_text(f'{HEADER}\n"K\nL",k@x.io,,,,,,\n')
    with pytest.raises(Exception, match="malformed CSV row"):
        split_read(spark, tmp_path).collect()
    rows = split_read(spark, tmp_path, "reject").collect()
    assert [r[MALFORMED] for r in rows if r[MALFORMED]] == ['"open,h@x.io,,,,,,', "I,i@x.io,,,,,,", "J,j@x.io,,,,,,"]
    assert [r.Email for r in rows if not r[MALFORMED]] == [*[f"g{i}@x.io" for i in range(40)], "k@x.io"]


def test_stray_quotes_do_not_make_one_record_of_a_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(split_csv, "MAX_RECORD_CHARACTERS", 500)
    between = "".join(f"G{i},g{i}@x.io,,,,,,\n" for i in range(100))
    (tmp_path / "in.csv").write_text(f'{HEADER}\n"A,a@x.io,,,,,,\n{between}B",b@x.io,,,,,,\nC,c@x.io,,,,,,\n')
    rows = split_read(spark, tmp_path, "reject").collect()
    assert sum(r[MALFORMED] is not None for r in rows) == 102
    assert [r.Email for r in rows if r[MALFORMED] is None] == ["c@x.io"]


def test_quotes_inside_cells_are_not_taken_for_records(spark, tmp_path):
    (tmp_path / "in.csv").write_text(f'{HEADER}\nA 5" tall,a@x.io,,,,,,\nB 6" tall,b@x.io,,,,,,\nC,c@x.io,,,,,,\n')
    rows = split_read(spark, tmp_path, "reject").collect()
    assert [r[MALFORMED] for r in rows] == ['A 5" tall,a@x.io,,,,,,\nB 6" tall,b@x.io,,,,,,', None]


def test_headers_must_be_alike_and_files_may_be_empty(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n")
    assert split_read(spark, tmp_path).collect() == []
    (tmp_path / "b.csv").write_text("Email,Name,Title,Company,Phone,Source,Country,Created At\na@x.io,Jo,T,C,1,S,US,\n")
    with pytest.raises(Exception, match="CSV header"):
        split_read(spark, tmp_path).collect()


def test_the_job_gives_the_same_tables(spark, tmp_path, small_splits):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(random_csv(11, 120), encoding="utf-8")
    source = str(tmp_path / "in")
    one, many = (run_job(spark, source, str(tmp_path / str(m)), multiline=m) for m in (True, "split"))
    for table in ("clean", "rejected"):
        a, b = (getattr(j, table).orderBy("source_row_number").collect() for j in (one, many))
        assert a == b and len(a) == (120 if table == "clean" else 0)
    with pytest.raises(ValueError, match="multiline"):
        run_job(spark, source, str(tmp_path / "no"), multiline="yes")
