"""Secrets in texts: candidate tokens judged by a random forest that is made of Spark expressions.

A candidate is a run of at least 12 TOKEN characters that has a digit or follows a sign of assignment,
with further runs behind dots and with padding; or what a credential's name is assigned, from 6 characters with a digit or sign on.
Passwords of letters only, of words with blanks and shorter ones are not candidates. What the
forest looks at: its length, the changes between kinds of characters, the share that common words
cover, the path it is assigned to, and the neighbouring words. The forest is trained from labelled
candidates with aggregates: each level of all trees is one histogram over trees, nodes, measures
and bins, so that only these counts leave the executors. Scores are means of the leaves.

Labelled findings are a table like that of ``findings``: texts with one candidate and its label by hand, here templates
filled with tokens. Candidates of the corpus with clear signs may be added; what has none is not labelled.

Only DataFrame and SQL functions are used, and rows stay where they are. Null and empty texts have
no candidates; a null text stays null. Repeated rows give equal results, empty tables empty ones;
other columns do not matter, whatever their names. Without labelled candidates nothing is a secret.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.llm.shared import pick, staged

TOKEN = "[A-Za-z0-9_/+-]"
# Names whose values may be short or hold any signs.
NAME = "(?i:passw(?:or)?d|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth|credentials?)"
# A character of such a value; a dot ends it unless more follows, "&" if another name does.
VALUE = r"(?:[^\s\"'<>,;().&]|&(?![A-Za-z_]++=)|\.(?=[^\s\"'<>,;().]))"
_LONG = (rf"(?<!{TOKEN})(?:(?=[A-Za-z_/+-]*+[0-9])|(?<=[=:]|[=:]['\"]|[=:] ['\"])){TOKEN}{{12,}}+"
         rf"(?:\.{TOKEN}{{10,}}+)*+(?:={{1,2}}+(?=[\"',;)\s]|$))?+")
# The short look behind comes first, as it fails at most places.
_VALUE_OF_NAME = (rf"(?<=[=:]|[=:]['\"]|[=:][ \t]|[=:][ \t]['\"])(?<={NAME}['\"]?[ \t]{{0,2}}[=:][ \t]?['\"]?)(?!https?://)"
                  rf"(?=[A-Za-z]*+[0-9!@#$%^&*?_+-]){VALUE}{{6,}}+")
CANDIDATE = f"{_VALUE_OF_NAME}|{_LONG}"
# Characters around a candidate that count as its neighbourhood.
BEFORE, AFTER = 60, 30

# Parts of names that credentials are kept under, and words that tokens are made of.
CREDENTIAL = "token|secret|passw|passwd|pwd|passphrase|credential|api[ _-]?key|access[ _-]?key|auth|bearer|private[ _-]?key"
COMMON = ("about|after|also|and|back|base|build|class|client|code|commit|config|data|date|debug|default|demo|"
          "dev|error|example|file|foo|for|from|group|hash|home|host|http|image|index|info|item|lib|list|local|log|"
          "main|name|node|null|number|object|page|part|path|prod|report|request|sample|server|session|size|src|"
          "start|state|string|table|task|temp|test|text|that|the|this|time|type|update|user|utils|value|version|"
          "view|web|with|work|www|year|your|xxx")
# Shapes that providers give their keys; they label candidates when there are no labels by hand.
PROVIDER = (r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^(sk|rk|pk)_(live|test)_[0-9A-Za-z]{16,}$"
            r"|^xox[abprs]-[0-9A-Za-z-]{10,}$|^AIza[0-9A-Za-z_-]{35}$|^sk-(proj-|ant-)?[0-9A-Za-z_-]{20,}$"
            r"|^eyJ[0-9A-Za-z_-]{10,}\.eyJ[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}$")

# Texts with one candidate each and whether it is a secret. Tokens: {h} 40 and {g} 32 hexadecimal digits, {b} 40 letters, digits and
# signs, {m} 24 letters and digits, {p} a password of 9, {d} 14 digits, {u} 16 capitals and digits, {n} a small number.
FINDINGS = [
    *[(1, t) for t in (
        'token = "{h}"', "my token: {h} was there", "export API_TOKEN={m}", "password={m} there", "DB_PASSWORD={p}", "password: {p}!",
        'pwd = "{p}#{n}"', "client_secret: '{b}'", "aws_secret_access_key = {b}", "api_key={g}", "the api key {m} leaked",
        "the api key sk-proj-{m} leaked", "Authorization: Bearer {b}", "curl -H 'Authorization: Bearer {m}'", "our secret {h} got out",
        "the access key {b} is mine", "key AKIA{u} of", "use ghp_{h} now", "pay with sk_live_{m} please", "slack xoxb-{m} bot",
        "token: eyJhbGciOi{m}.eyJzdWIiOi{m}.{b}", "sent eyJhbGciOi{m}.eyJzdWIiOi{m}.{m} along", "private key {b} was copied",
        'auth_token: "{g}"', "login with password {m} today",
        "get https://host.example/?token={m} once")],
    *[(0, t) for t in (
        "commit {h}", "see commit = {h} there", "sha1: {h}", "checksum = {g}", "id={g}", "uuid: {g} of it", 'etag: "{g}"', "order {d} came",
        "card {d}{n} paid", "phone +{d} rang", "see https://host.example/page/{g}", "file = 'test_data_{n}_version.txt'",
        "load test_data_file_{n}_version in example", "session_start_time_{n} is a name", "token_count = {d}", "max_tokens_per_request_{n}",
        "path/to/some/file_{n}/index", "image_name_{n}.example_page_{n}", "version-2024-{d}", "at 2024-01-02T10-{n}-12Z it", "merged {h} into main",
        "the hash {g} of a page", "password_reset_page_{n} opens", "href=/users/{d}/list", "digest {h} differs",
        "auth: https://host.example/page/{m}", "secret page https://host.example/list/{m}/{n}")],
]
# Rows of each text, and candidates of a corpus that are added at most, those with the smallest hashes.
FINDING_ROWS, LABELLED_ROWS = 40, 2_000
TREES, DEPTH, BINS, MEASURES_TRIED = 15, 5, 12, 5
# Mean of the trees from which a candidate is a secret.
SECRET_SCORE = 0.5

MEASURES = ["length", "changes", "digit_share", "upper_share", "hex_only", "digits_only", "common_share",
            "has_path", "path_credential", "path_place", "near_credential", "quoted", "provider_shape",
            "in_address"]


def _is(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def _removed(text: Column, pattern: str) -> Column:
    """How many characters of a text a pattern covers."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def measures(token: Column, before: Column, after: Column) -> dict[str, Column]:
    """What the forest looks at, as numbers."""
    length = F.length(token)
    kinds = token
    for run, kind in (("[0-9]+", "0"), ("[A-Z]+", "A"), ("[a-z]+", "a")):
        kinds = F.regexp_replace(kinds, run, kind)
    path = F.lower(F.regexp_extract(before, r"([A-Za-z0-9_.$/-]+)['\"]?\s*(?:=|:|=>)\s*['\"]?$", 1))
    near = F.lower(F.concat_ws(" ", F.regexp_extract(before, r"((?:\S+\s+){1,2}\S*)$", 1),
                               F.regexp_extract(after, r"^\S*\s+(\S+)", 1)))
    return {
        "length": length.cast("double"),
        "changes": (F.length(kinds) - 1) / length,
        "digit_share": _removed(token, "[0-9]") / length,
        "upper_share": _removed(token, "[A-Z]") / length,
        "hex_only": _is(token.rlike("^[0-9a-f]+$") & token.rlike("[a-f]")),
        "digits_only": _is(token.rlike("^[0-9_/+-]+$")),
        "common_share": _removed(F.lower(token), COMMON) / length,
        "has_path": _is(path != ""),
        "path_credential": _is(path.rlike(CREDENTIAL)),
        "path_place": _is(path.rlike("/|\\.|^(id|sha|sha1|sha256|md5|checksum|commit|rev|uuid|digest|etag|hash|url|href|src)$")),
        "near_credential": _is(near.rlike(CREDENTIAL)),
        "quoted": _is(before.rlike("['\"]$") & after.rlike("^['\"]")),
        "provider_shape": _is(token.rlike(PROVIDER)),
        "in_address": _is(before.rlike(r"://\S*$")),
    }


def _candidates(text: Column) -> Column:
    """Array of token, before, after and the measures, in order; empty if there are none."""
    tokens, rest = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), F.split(text, CANDIDATE, -1)
    found = F.transform(tokens, lambda t, i: F.struct(
        t.alias("token"), F.right(F.concat(F.coalesce(F.get(tokens, i - 1), F.lit("")), F.get(rest, i)), F.lit(BEFORE)).alias("before"),
        F.left(F.get(rest, i + 1), F.lit(AFTER)).alias("after")))
    measured = F.transform(found, lambda c: F.struct(c["token"].alias("token"), F.struct(
        *[m.alias(k) for k, m in measures(c["token"], c["before"], c["after"]).items()]).alias("m")))
    return F.when(text.rlike(CANDIDATE), measured)


def _label(token: Column, m: Column) -> Column:
    """1 for shapes of providers and for keys assigned to a credential's name, 0 for what cannot be
    one, null for all others, also where nothing is said of it."""
    assigned = (m["path_credential"] == 1) & (m["digits_only"] == 0) & (m["common_share"] < 0.3)
    clear = (m["digits_only"] == 1) | (m["common_share"] >= 0.5) | (m["path_place"] == 1) | (m["in_address"] == 1)
    return F.when(token.rlike(PROVIDER) | assigned, 1).when(clear, 0)


def labelled_candidates(df: DataFrame, text: str = "text", limit: int = LABELLED_ROWS) -> DataFrame:
    """At most ``limit`` different candidates with ``label`` by clear signs, and their measures."""
    found = pick(df, text).select(F.explode(_candidates(F.col(text))).alias("c")).select(
        F.col("c.token").alias("token"), "c.m.*", _label(F.col("c.token"), F.col("c.m")).alias("label"))
    return (found.filter("label IS NOT NULL").dropDuplicates(["token"])
            .orderBy(F.xxhash64("token"), "token").limit(limit))


def labelled_findings(texts: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """The candidates of texts, all with the text's label, and their measures: rows to train from."""
    found = pick(texts, text, label).select(label, F.explode(_candidates(F.col(text))).alias("c"))
    return found.select(F.col("c.token").alias("token"), "c.m.*", F.col(label).cast("int").alias("label"))


def findings(spark: SparkSession, rows: int = FINDING_ROWS) -> DataFrame:
    """``text`` and ``label``: the texts of FINDINGS, each filled with so many different tokens."""
    texts = spark.createDataFrame([(n, label, text) for n, (label, text) in enumerate(FINDINGS)], "n int, label int, text string")
    h = F.sha2(F.concat_ws("-", "n", "id"), 512)
    signs = F.base64(F.unhex(h))
    letters = F.regexp_replace(signs, "[^A-Za-z0-9]", "")
    token = {"h": F.left(h, F.lit(40)), "g": F.right(h, F.lit(32)), "b": F.left(signs, F.lit(40)), "m": F.left(letters, F.lit(24)),
             "p": F.concat(F.right(letters, F.lit(7)), F.col("id") % 10, F.lit("q")),
             "d": F.left(F.regexp_replace(h, "[a-f]", ""), F.lit(14)),
             "u": F.upper(F.left(letters, F.lit(16))), "n": F.col("id").cast("string")}
    filled = F.col("text")
    for name, value in token.items():
        filled = F.replace(filled, F.lit(f"{{{name}}}"), value.cast("string"))
    return texts.withColumn("id", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).select(filled.alias("text"), "label")


@dataclass(frozen=True)
class Node:
    """A test ``measure < threshold`` with two branches, or a leaf with the share of secrets."""

    share: float
    measure: str | None = None
    threshold: float = 0.0
    below: Node | None = None
    above: Node | None = None

    def column(self, m: Column) -> Column:
        if self.measure is None:
            return F.lit(self.share)
        return F.when(m[self.measure] < F.lit(self.threshold), self.below.column(m)).otherwise(self.above.column(m))


Splits = dict[tuple[int, int], tuple[str, float]]


def _place(m: Column, splits: Splits, tree: int, node: int = 1) -> Column:
    """The node of a tree that a row has come to; the children of k are 2k and 2k + 1."""
    if (tree, node) not in splits:
        return F.lit(node)
    measure, threshold = splits[tree, node]
    return F.when(m[measure] < F.lit(threshold), _place(m, splits, tree, 2 * node)).otherwise(
        _place(m, splits, tree, 2 * node + 1))


def _weight(tree: Column) -> Column:
    """How often a tree's sample has a row: a Poisson number with mean 1, from a hash."""
    u = F.pmod(F.xxhash64("token", tree), F.lit(1 << 20)) / (1 << 20)
    return F.when(u < 0.3679, 0).when(u < 0.7358, 1).when(u < 0.9197, 2).when(u < 0.9810, 3).otherwise(4)


def train_forest(labelled: DataFrame) -> list[Node]:
    """Trees from rows of ``token``, ``label`` and MEASURES, a bounded table (see LABELLED_ROWS)."""
    shares = [i / BINS for i in range(1, BINS)]
    cuts = labelled.agg(*[F.percentile_approx(m, shares, 10_000).alias(m) for m in MEASURES]).first()
    # A value between two cuts is in one bin; a measure of two values needs one cut above the lower.
    cut_of = {m: sorted({*(cuts[m] or []), *([0.5] if set(cuts[m] or []) <= {0.0, 1.0} else [])}) for m in MEASURES}
    splits: Splits = {}
    share_of: dict[tuple[int, int], float] = {}
    rows = labelled.select("token", "label", F.struct(*MEASURES).alias("m"))
    m = F.col("m")
    bins = F.array(*[F.struct(F.lit(name).alias("measure"), sum(
        (F.when(m[name] >= F.lit(c), 1).otherwise(0) for c in cut_of[name]), F.lit(0)).alias("bin")) for name in MEASURES])
    for level in range(DEPTH + 1):
        placed = rows.select("label", "token", bins.alias("bins"), F.explode(F.array(*[
            F.struct(F.lit(t).alias("tree"), _place(m, splits, t).alias("node")) for t in range(TREES)])).alias("at"))
        placed = placed.select("label", "bins", "at.*", _weight(F.col("at.tree")).alias("w")).filter(
            (F.col("w") > 0) & (F.col("node") >= 1 << level))
        counts = (placed.select("label", "tree", "node", "w", F.explode("bins").alias("b"))
                  .groupBy("tree", "node", "b.measure", "b.bin")
                  .agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("label")).alias("hits")).collect())
        histograms: dict[tuple[int, int], dict[str, dict[int, tuple[int, int]]]] = {}
        for r in counts:
            histograms.setdefault((r.tree, r.node), {}).setdefault(r.measure, {})[r.bin] = (r.n, r.hits)
        for (tree, node), by_measure in sorted(histograms.items()):
            n, hits = (sum(x) for x in zip(*next(iter(by_measure.values())).values(), strict=True))
            share_of[tree, node] = hits / n
            if level < DEPTH and 0 < hits < n:
                split = _best_split(by_measure, cut_of, tree, node, n, hits)
                if split:
                    splits[tree, node] = split

    def grown(tree: int, node: int) -> Node:
        share = share_of.get((tree, node), share_of.get((tree, node // 2), 0.0))
        if (tree, node) not in splits:
            return Node(share)
        measure, threshold = splits[tree, node]
        return Node(share, measure, threshold, grown(tree, 2 * node), grown(tree, 2 * node + 1))

    return [grown(t, 1) for t in range(TREES) if (t, 1) in share_of]


def secret_forest(df: DataFrame, text: str = "text") -> list[Node]:
    """Trees from the labelled findings and the corpus's candidates with clear signs."""
    found = labelled_findings(findings(df.sparkSession))
    return train_forest(staged(found.unionByName(labelled_candidates(df, text))))


def _best_split(by_measure: dict[str, dict[int, tuple[int, int]]], cut_of: dict[str, list[float]], tree: int,
                node: int, n: int, hits: int) -> tuple[str, float] | None:
    """The split of the least Gini impurity among the measures this node may look at."""
    tried = random.Random(1000 * tree + node).sample(MEASURES, MEASURES_TRIED)
    best, least = None, hits * (n - hits) / n - 1e-9
    for measure in tried:
        below, below_hits = 0, 0
        for b, cut in enumerate(cut_of[measure]):
            k, h = by_measure[measure].get(b, (0, 0))
            below, below_hits = below + k, below_hits + h
            above, above_hits = n - below, hits - below_hits
            if below and above:
                impurity = below_hits * (below - below_hits) / below + above_hits * (above - above_hits) / above
                if impurity < least:
                    best, least = (measure, cut), impurity
    return best


def scan_secrets(df: DataFrame, forest: list[Node], text: str = "text",
                 carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carried`` columns and the text, ``secret_candidates`` (array of token, measures and ``score``), ``secrets`` (array of
    tokens) and ``redacted``, the text with ``[secret]`` in the place of each secret."""
    t = F.col(text)
    scored = F.transform("_candidates", lambda c: F.struct(
        c["token"].alias("token"), c["m"].alias("m"), (
            sum((tree.column(c["m"]) for tree in forest), F.lit(0.0)) / max(1, len(forest))).alias("score")))
    rows = pick(df, *carried, *[text] * (text not in carried))
    with_scores = rows.withColumn("_candidates", _candidates(t)).withColumn("secret_candidates", scored).drop("_candidates")
    secret = F.filter("secret_candidates", lambda c: c["score"] >= SECRET_SCORE)
    # A text is its stretches between candidates, each followed by a candidate or what stands for it.
    pieces = F.split(t, CANDIDATE, -1)
    joined = F.concat(F.array_join(F.transform("secret_candidates", lambda c, i: F.concat(
        F.get(pieces, i), F.when(c["score"] >= SECRET_SCORE, F.lit("[secret]")).otherwise(c["token"]))), ""),
        F.element_at(pieces, -1))
    return with_scores.withColumns({
        "secrets": F.coalesce(F.transform(secret, lambda c: c["token"]), F.array().cast("array<string>")),
        "redacted": F.when(F.size(secret) > 0, joined).otherwise(t),
    })
