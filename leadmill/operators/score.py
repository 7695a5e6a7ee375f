"""Score leads by configured rules and say why."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.fixed_values import FAILED, FREE_MAIL_DOMAINS
from leadmill.functions.contact import email_domain
from leadmill.functions.text import SPACE, WORD, casefold, col, normalize_text, quoted
from leadmill.operators.rule_index import keyword_table, with_first_rule
from leadmill.schema import column_or_null


# From so many keywords of a group on, texts are looked up in an index instead of tried rule by rule: with
INDEXED_KEYWORDS = 200


class CompiledRule(NamedTuple):
    """One keyword rule; ``pattern`` is null when the rule has no keyword left."""

    name: str
    score: int
    pattern: str | None


def _folded(text: str) -> str:
    return " ".join(str(text).casefold().split())


def _whole_words(keywords: Sequence[str]) -> str:
    """Regex for any of the keywords between word boundaries, whatever the script.

    A keyword that begins with a word character must follow none, one that begins with a sign
    must follow one, and likewise at the end. Keywords with the same kind of ends share the
    look-around, which is then tried once per place in the text.
    """
    by_ends: dict[tuple[str, str], list[str]] = {}
    for keyword in keywords:
        in_word = [c == "_" or c.isalnum() for c in (keyword[0], keyword[-1])]
        ends = (f"(?<{'!' if in_word[0] else '='}[{WORD}])", f"(?{'!' if in_word[1] else '='}[{WORD}])")
        by_ends.setdefault(ends, []).append(quoted(keyword))
    return "|".join(
        f"{before}(?:{'|'.join(words)}){after}" for (before, after), words in by_ends.items()
    )


def compile_rules(rules: Sequence[dict]) -> list[CompiledRule]:
    """One regex per rule, made once when the plan is built."""
    compiled = []
    for rule in rules:
        words = [w for w in map(_folded, rule.get("keywords", [])) if w]
        pattern = _whole_words(words) if words else None
        compiled.append(CompiledRule(str(rule["name"]), int(rule["score"]), pattern))
    return compiled


def first_matching_rule(text: Column | str, rules: Sequence[CompiledRule]) -> Column:
    """1-based place of the first rule with a keyword in case-folded text, else null."""
    places = [F.when(col(text).rlike(rule.pattern), F.lit(place))
              for place, rule in enumerate(rules, 1) if rule.pattern]
    return F.coalesce(*places, F.lit(None).cast("int"))


def with_rule_place(df: DataFrame, text: str, rules: Sequence[dict], into: str) -> DataFrame:
    """Append the place of the first rule with a keyword in case-folded text, by the way their number asks for."""
    if sum(len(rule.get("keywords", [])) for rule in rules) >= INDEXED_KEYWORDS:
        return with_first_rule(df, text, keyword_table(df.sparkSession, rules), into)
    return df.withColumn(into, first_matching_rule(text, compile_rules(rules)))


def _pick(place: str, values: list, kind: str) -> Column:
    """The value at a 1-based place, null when the place is."""
    table = F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")
    return F.get(table, F.col(place) - 1)


def _points_of(value: str, points: dict) -> Column:
    """Points configured for a value, 0 for others."""
    known = {str(k): int(v) for k, v in points.items()}
    if not known:
        return F.lit(0)
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.col(value)), F.lit(0))


def _listed(*reasons: Column) -> Column:
    """The reasons that are not null, in order."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(r.isNotNull(), F.array(r)).otherwise(none) for r in reasons])


def score_leads(df: DataFrame, rules: dict, normalized: bool = False) -> DataFrame:
    """Append ``lead_score`` and ``score_reasons``; every key of ``rules`` is optional.

    Groups of rules with INDEXED_KEYWORDS keywords or more are looked up by words, which joins.

    Each text is matched once, in a projection of its own, and yields the place of its rule;
    points and reasons are looked up from that place. ``normalized`` says that the text is
    clean already.
    """
    bounds = rules.get("score_bounds", {})
    low, high = int(bounds.get("min", 0)), int(bounds.get("max", 100))
    functions = compile_rules(rules.get("title_function_scores", []))
    seniorities = compile_rules(rules.get("seniority_scores", []))
    penalties = {k: int(v) for k, v in rules.get("penalties", {}).items()}

    def clean(c: str) -> Column:
        given = column_or_null(df, c)
        return given if normalized else normalize_text(given)

    title = F.trim(F.regexp_replace(casefold(clean("title")), f"[{SPACE}]+", " "))
    matched = df.withColumns({
        "_title": casefold(clean("title")) if normalized else title,
        "_industry": F.coalesce(casefold(clean("industry")), F.lit("")),
        "_size": F.coalesce(casefold(clean("company_size")), F.lit("")),
        "_domain": email_domain(clean("email")),
        "_no_company": clean("company").isNull(),
        "_failed": F.coalesce(casefold(clean("enrichment_status")) == FAILED, F.lit(False)),
    })
    for place, group in (("_function", "title_function_scores"), ("_seniority", "seniority_scores")):
        matched = with_rule_place(matched, "_title", rules.get(group, []), place)

    free_mail = F.coalesce(F.col("_domain").isin(FREE_MAIL_DOMAINS), F.lit(False))
    industry = _points_of("_industry", rules.get("industry_scores", {}))
    size = _points_of("_size", rules.get("company_size_scores", {}))
    score = (
        F.lit(int(rules.get("base_score", 0)))
        + F.coalesce(_pick("_function", [r.score for r in functions], "int"), F.lit(0))
        + F.coalesce(_pick("_seniority", [r.score for r in seniorities], "int"), F.lit(0))
        + industry
        + size
    )
    reasons = [
        _pick("_function", [r.name for r in functions], "string"),
        _pick("_seniority", [r.name for r in seniorities], "string"),
        F.when(industry != 0, F.concat(F.lit("industry_"), F.col("_industry"))),
        F.when(size != 0, F.concat(F.lit("company_size_"), F.col("_size"))),
    ]
    for penalty, applies in (
        ("free_email_domain", free_mail),
        ("missing_company", F.col("_no_company")),
        ("failed_enrichment", F.col("_failed")),
    ):
        if penalties.get(penalty, 0):
            score = score - F.when(applies, F.lit(penalties[penalty])).otherwise(F.lit(0))
            reasons.append(F.when(applies, F.lit(f"penalty_{penalty}")))

    bounded = F.greatest(F.lit(low), F.least(score, F.lit(high)))
    return matched.withColumns({
        "lead_score": bounded.cast("int"),
        "score_reasons": _listed(*reasons),
    }).drop("_title", "_industry", "_size", "_domain", "_no_company", "_failed", "_function", "_seniority")
