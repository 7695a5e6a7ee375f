"""Small documents to test with; another column's name differs from a needed one by case only."""

SCHEMA = "doc_id long, text string, TEXT string, lang string, source string, n_chars long, kept string"


def documents(spark, *texts, langs=None):
    rows = [(n, t, "x", (langs or {}).get(n), "s", None if t is None else len(t), "y") for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df, *columns, key="doc_id"):
    return {r[key]: tuple(r[c] for c in columns) for r in df.collect()}
