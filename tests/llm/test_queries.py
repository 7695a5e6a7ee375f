"""The registered queries: oracles where SQL has one, schemas of the contracts, the pipeline."""

import duckdb
import pytest

import corpus_pipeline
from leadmill.llm import queries
from leadmill.llm.queries import ORACLE_SQL, QUERIES

TABLES = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_backoff_scores": "doc_id n_words log_score",
    "op2_decontamination": "doc_id item_id similarity first_word n_words",
    "op3_secrets": "doc_id n_candidates n_secrets secrets redacted_sha256",
    "op4_pieces": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5_main_text": "page_id url text n_chars",
    "op6_licenses": "doc_id sentence_ids licenses n_matches",
    "op7_ngram_join": "doc_id n_shingles component_id",
    "op8_language": "doc_id held_out lang_pred score",
    "op9_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept failed_rule",
    "op10_fixity": "page_id file first_byte n_bytes replica_bytes state",
    "op11_filter_audit": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op12_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op13_spelling": "word form root n n_near form_n",
}


def test_every_operator_has_its_query():
    assert set(QUERIES) == set(COLUMNS) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_duckdb(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    columns = COLUMNS[name].split()
    expected = connection.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    found = QUERIES[name](spark, TABLES)
    assert found.columns == columns
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected)) and expected
    connection.close()


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(ORACLE_SQL) - {"op13_spelling"}))
def test_query_returns_every_row_of_its_table(spark, name):
    found = QUERIES[name](spark, TABLES)
    assert found.columns == COLUMNS[name].split()
    table = "pages" if name == "op5_main_text" else "documents"
    whole = queries.table(spark, TABLES, table).count()
    if name == "op12_packing":
        found = found.filter("piece = 0")
    assert found.count() == whole or name == "op2_decontamination" and 0 < found.count() < whole


def test_pipeline_stages_do_what_their_operators_say(spark):
    docs = queries.table(spark, TABLES, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]

    kept = corpus_pipeline.quality(spark, docs, TABLES)
    judged = {r.doc_id for r in queries.op9_quality(spark, TABLES).filter("kept").collect()}
    assert {r.doc_id: r.text for r in kept.collect()} == {i: before[i] for i in judged} and kept.columns == corpus_pipeline.COLUMNS

    once = corpus_pipeline.deduplicate(spark, docs.unionByName(docs.limit(3)), TABLES)
    groups = {r.component_id for r in queries.op7_ngram_join(spark, TABLES).collect()}
    assert sorted(r.doc_id for r in once.collect()) == sorted(groups)

    clean = corpus_pipeline.decontaminate(spark, docs, TABLES)
    leaks = {r.doc_id for r in queries.op2_decontamination(spark, TABLES).collect()}
    assert {r.doc_id for r in clean.collect()} == set(before) - leaks

    redacted = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.redact(spark, docs, TABLES).collect()}
    found = {r.doc_id: r.secrets for r in queries.op3_secrets(spark, TABLES).collect()}
    for i, text in before.items():
        for secret in set(found[i]):
            text = text.replace(secret, "[secret]")
        assert redacted[i] == (text, len(text))


def test_pipeline_runs_on_nulls_repeats_and_empty_tables(spark, tmp_path):
    docs = queries.table(spark, TABLES, "documents")
    odd = docs.limit(30).unionByName(docs.limit(2)).unionByName(docs.limit(1).selectExpr(
        "cast(null AS long) AS doc_id", "cast(null AS string) AS text", "lang", "source", "n_chars"))
    for name, frame in (("odd", odd), ("none", docs.limit(0))):
        frame.write.parquet(str(tmp_path / name / "documents.parquet"))
        for table in ("labels", "benchmark"):
            small = queries.table(spark, TABLES, table)
            (small if name == "odd" else small.limit(0)).write.parquet(str(tmp_path / name / f"{table}.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows) and all(r.doc_id is not None for r in rows)
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
