"""The registered queries of these operators, one for each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.llm.backoff_lm import BACKOFF, backoff_scores
from leadmill.llm.decontaminate import find_passages
from leadmill.llm.filter_audit import audit_filters
from leadmill.llm.fixity import audit
from leadmill.llm.html_text import main_texts
from leadmill.llm.language_id import fit_languages, identify_languages, training_rows
from leadmill.llm.license_scan import BREAK, RULES, SENTENCES, scan_licenses, split_known
from leadmill.llm.ngram_join import near_duplicates
from leadmill.llm.packing import pack_documents
from leadmill.llm.piece_codec import encode_pieces
from leadmill.llm.quality_rules import apply_rules, document_statistics, fit_rules
from leadmill.llm.secret_scan import scan_secrets, secret_forest
from leadmill.llm.spelling import drop_some, spelling_variants, word_counts

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file; only the queries that need one need the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, tables: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{tables}/{name}.parquet")


def op1_backoff_scores(spark: SparkSession, tables: str) -> DataFrame:
    """Log scores are rounded, since sums of floats depend on their order."""
    return backoff_scores(table(spark, tables, "documents")).withColumn("log_score", F.round("log_score", 6))


def op1_other_corpus(spark: SparkSession, tables: str) -> DataFrame:
    """Scores of all documents at order 3 by the n-grams of three quarters of them, so that the others back off."""
    docs = table(spark, tables, "documents")
    return backoff_scores(docs, order=3, corpus=docs.filter("doc_id % 4 != 2")).withColumn("log_score", F.round("log_score", 6))


def op2_decontamination(spark: SparkSession, tables: str) -> DataFrame:
    return find_passages(table(spark, tables, "documents"), table(spark, tables, "benchmark"))


def op3_secrets(spark: SparkSession, tables: str) -> DataFrame:
    docs = table(spark, tables, "documents")
    return scan_secrets(docs, secret_forest(docs)).select(
        "doc_id",
        F.coalesce(F.size("secret_candidates"), F.lit(0)).cast("long").alias("n_candidates"),
        F.size("secrets").cast("long").alias("n_secrets"),
        "secrets",
        F.sha2(F.coalesce("redacted", F.lit("")), 256).alias("redacted_sha256"))


def piece_digests(docs: DataFrame) -> DataFrame:
    return encode_pieces(docs, vocabulary("piece_bpe_32k.model")).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op4_pieces(spark: SparkSession, tables: str) -> DataFrame:
    return piece_digests(table(spark, tables, "documents"))


def op5_main_text(spark: SparkSession, tables: str) -> DataFrame:
    return main_texts(table(spark, tables, "pages"))


def op6_licenses(spark: SparkSession, tables: str) -> DataFrame:
    return scan_licenses(table(spark, tables, "documents"))


def op7_ngram_join(spark: SparkSession, tables: str) -> DataFrame:
    return near_duplicates(table(spark, tables, "documents"))


def op8_language(spark: SparkSession, tables: str) -> DataFrame:
    docs = table(spark, tables, "documents")
    # A row without an id is neither held out nor learned from.
    remainder = "crc32(cast(doc_id AS string)) % 4"
    model = fit_languages(training_rows(docs, f"{remainder} != 2"))
    return identify_languages(docs, model).select(
        "doc_id", F.coalesce(F.expr(f"{remainder} = 2"), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_quality(spark: SparkSession, tables: str) -> DataFrame:
    docs = table(spark, tables, "documents")
    rules = fit_rules(docs, table(spark, tables, "labels"))
    return apply_rules(document_statistics(docs), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed_rule")


def op10_fixity(spark: SparkSession, tables: str) -> DataFrame:
    """The pages against a replica with damage: some texts changed, some cut, some records lost or doubled."""
    pages = table(spark, tables, "pages").select("page_id", "url", "html")
    damaged = F.when(F.col("page_id") % 97 == 3, F.concat("html", F.lit("!"))).when(
        F.col("page_id") % 149 == 7, F.left("html", F.floor(F.length("html") / 2).cast("int"))).otherwise(F.col("html"))
    replica = pages.filter("page_id % 199 != 11").select("page_id", "url", damaged.alias("html"))
    doubled = pages.filter("page_id % 251 = 13")
    return audit(pages, replica.unionByName(doubled))


def op11_filter_audit(spark: SparkSession, tables: str) -> DataFrame:
    return audit_filters(table(spark, tables, "documents"), table(spark, tables, "labels"))


def op12_packing(spark: SparkSession, tables: str) -> DataFrame:
    return pack_documents(table(spark, tables, "documents"), vocabulary("word_bpe_49k.json"))


def op13_spelling(spark: SparkSession, tables: str) -> DataFrame:
    return spelling_variants(word_counts(table(spark, tables, "documents"), drop_some))


QUERIES: dict[str, Query] = {
    "op1_backoff_scores": op1_backoff_scores,
    "op2_decontamination": op2_decontamination,
    "op3_secrets": op3_secrets,
    "op4_pieces": op4_pieces,
    "op5_main_text": op5_main_text,
    "op6_licenses": op6_licenses,
    "op7_ngram_join": op7_ngram_join,
    "op8_language": op8_language,
    "op9_quality": op9_quality,
    "op10_fixity": op10_fixity,
    "op11_filter_audit": op11_filter_audit,
    "op12_packing": op12_packing,
    "op13_spelling": op13_spelling,
}

# A second query of an operator whose first one leaves part of its work out.
FURTHER_QUERIES: dict[str, Query] = {"op1_other_corpus": op1_other_corpus}


def _licenses_sql() -> str:
    """Each rule takes its sentences out of the sequence that the rules before it have left."""
    identifiers, parts = split_known(SENTENCES)
    known = ", ".join(f"'{k}': '{v}'" for k, v in identifiers.items())
    steps = [f"""
        cut AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''), '([.!?:;])[ \\t\\r\\f\\v]+',
            '\\1' || chr(10), 'g'), chr(10) || '+', chr(10), 'g'), chr(10)) AS sentences FROM documents),
        found AS (SELECT doc_id, list_filter(list_transform(sentences, lambda s:
            (MAP {{{known}}})[trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))]), lambda i: i IS NOT NULL) AS ids FROM cut),
        s0 AS (SELECT doc_id, ids, '|' || coalesce(array_to_string(ids, '||'), '') || '|' AS rest, 0 AS n,
            CAST([] AS VARCHAR[]) AS names FROM found)"""]
    for k, (name, needed) in enumerate(RULES):
        wanted = "".join(f"|{i}|" for x in needed for i in parts[x])
        steps.append(f"""
        s{k + 1} AS (SELECT doc_id, ids, replace(rest, '{wanted}', '/') AS rest, n + hits AS n,
            CASE WHEN hits > 0 THEN list_append(names, '{name}') ELSE names END AS names
            FROM (SELECT *, (length(rest) - length(replace(rest, '{wanted}', ''))) // {len(wanted)} AS hits FROM s{k}))""")
    return f"""WITH {",".join(steps)}
        SELECT doc_id, coalesce(array_to_string(ids, ' '), '') AS sentence_ids,
            coalesce(array_to_string(list_sort(list_distinct(names)), ' '), '') AS licenses,
            CAST(n AS BIGINT) AS n_matches FROM s{len(RULES)}"""


# Statements for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op1_backoff_scores": rf"""
        WITH cut AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM cut),
        pairs AS (SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM placed),
        ones AS (SELECT word, count(*) AS n FROM pairs GROUP BY word),
        twos AS (SELECT before, word, count(*) AS n FROM pairs WHERE before IS NOT NULL GROUP BY ALL),
        scored AS (SELECT p.doc_id, CASE WHEN t.n IS NOT NULL THEN ln(t.n) - ln(b.n)
            ELSE ln(o.n) - ln((SELECT sum(n) FROM ones)) + CASE WHEN p.before IS NULL THEN 0 ELSE ln({BACKOFF}) END END AS s
            FROM pairs p JOIN ones o ON o.word = p.word LEFT JOIN ones b ON b.word = p.before
            LEFT JOIN twos t ON t.before = p.before AND t.word = p.word),
        sums AS (SELECT doc_id, count(*) AS n_words, sum(s) AS log_score FROM scored GROUP BY doc_id)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(log_score, 0.0), 6) AS log_score
        FROM documents LEFT JOIN sums USING (doc_id)""",
    "op10_fixity": r"""
        WITH original AS (SELECT page_id, url, html FROM pages),
        replica AS (
            SELECT page_id, url, CASE WHEN page_id % 97 = 3 THEN html || '!'
                WHEN page_id % 149 = 7 THEN left(html, length(html) // 2) ELSE html END AS html
            FROM pages WHERE page_id % 199 <> 11
            UNION ALL SELECT page_id, url, html FROM pages WHERE page_id % 251 = 13),
        a AS (SELECT page_id, list_sort(list(html)) AS texts, sum(128 + strlen(CAST(page_id AS VARCHAR)) + strlen(url)
            + strlen(CAST(strlen(html) AS VARCHAR)) + strlen(html)) AS n FROM original GROUP BY page_id),
        b AS (SELECT page_id, list_sort(list(html)) AS texts, sum(128 + strlen(CAST(page_id AS VARCHAR)) + strlen(url)
            + strlen(CAST(strlen(html) AS VARCHAR)) + strlen(html)) AS n FROM replica GROUP BY page_id),
        places AS (SELECT page_id, sum(n) OVER (PARTITION BY page_id // 4096 ORDER BY page_id) - n AS first_byte FROM a)
        SELECT page_id, page_id // 4096 AS file, CAST(first_byte AS BIGINT) AS first_byte,
            CAST(coalesce(a.n, 0) AS BIGINT) AS n_bytes, CAST(coalesce(b.n, 0) AS BIGINT) AS replica_bytes,
            CASE WHEN b.texts IS NULL THEN 'missing' WHEN a.texts IS NULL THEN 'extra' ELSE 'changed' END AS state
        FROM a FULL JOIN b USING (page_id) LEFT JOIN places USING (page_id)
        WHERE a.texts IS DISTINCT FROM b.texts""",
    "op6_licenses": _licenses_sql(),
    "op11_filter_audit": r"""
        WITH cut AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        least AS (SELECT text, min(doc_id) AS least FROM cut GROUP BY text),
        judged AS (SELECT doc_id, part,
            {'A': len(words) < 100, 'B': 100 * len(list_distinct(words)) < 80 * len(words),
             'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
             'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(doc_id > least, false)} AS f
            FROM cut JOIN least USING (text)),
        marked AS (SELECT part, [f.A, f.B, f.C, f.D, f.E] AS fails,
            coalesce((SELECT max(quality) FROM labels l WHERE l.doc_id = j.doc_id AND quality = 1), 0) AS good,
            coalesce((SELECT max(toxic) FROM labels l WHERE l.doc_id = j.doc_id AND toxic = 1), 0) AS toxic FROM judged j),
        cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY part, fails),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a JOIN letters b ON b.x <> a.x
            JOIN letters c ON c.x NOT IN (a.x, b.x) JOIN letters d ON d.x NOT IN (a.x, b.x, c.x)
            JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
        steps AS (SELECT filter_order, step, filter_order[step] AS letter FROM orders, range(1, 6) r(step)),
        placed AS (SELECT part, filter_order, step, letter, n, good, toxic, fails['ABCDE'.position(letter)] AS fail,
            len(list_filter(fails, lambda b: b)) AS n_fails,
            coalesce(list_min(list_transform(list_filter(range(1, 6), lambda k: fails['ABCDE'.position(filter_order[k])]), lambda k: k)), 6) AS gone
            FROM cells, steps),
        found AS (SELECT part, filter_order, step, letter, sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
            sum(n) FILTER (fail AND gone < step) AS redundant, sum(n) FILTER (fail AND n_fails = 1) AS unique_fails,
            sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
            FROM placed GROUP BY ALL)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
            CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
            CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
            CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
            CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM found""",
}

FURTHER_SQL: dict[str, str] = {
    "op1_other_corpus": rf"""
        WITH cut AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        placed AS (SELECT doc_id, unnest(words) AS c, generate_subscripts(words, 1) AS place FROM cut),
        grams AS (SELECT *, lag(c) OVER w AS b, lag(c, 2) OVER w AS a FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
        learned AS (SELECT * FROM grams WHERE doc_id % 4 <> 2),
        ones AS (SELECT c, count(*) AS n FROM learned GROUP BY c),
        twos AS (SELECT b, c, count(*) AS n FROM learned WHERE b IS NOT NULL GROUP BY ALL),
        threes AS (SELECT a, b, c, count(*) AS n FROM learned WHERE a IS NOT NULL GROUP BY ALL),
        total AS (SELECT greatest(coalesce(sum(n), 0), 1) AS n FROM ones),
        scored AS (SELECT g.doc_id, CASE WHEN n3.n IS NOT NULL THEN ln(n3.n) - ln(before2.n)
            WHEN n2.n IS NOT NULL THEN ln(n2.n) - ln(before1.n) + ln({BACKOFF}) * (least(place, 3) - 2)
            ELSE ln(coalesce(n1.n, 1)) - ln(total.n) + ln({BACKOFF}) * (least(place, 3) - 1) END AS s
            FROM grams g CROSS JOIN total LEFT JOIN ones n1 ON n1.c = g.c LEFT JOIN twos n2 ON n2.b = g.b AND n2.c = g.c
            LEFT JOIN threes n3 ON n3.a = g.a AND n3.b = g.b AND n3.c = g.c
            LEFT JOIN ones before1 ON before1.c = g.b LEFT JOIN twos before2 ON before2.b = g.a AND before2.c = g.b),
        sums AS (SELECT doc_id, count(*) AS n_words, sum(s) AS log_score FROM scored GROUP BY doc_id)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(log_score, 0.0), 6) AS log_score
        FROM documents LEFT JOIN sums USING (doc_id)""",
}
