import random

from pyspark.sql import functions as F

from leadmill.fixed_values import LEAD_FIELDS
from leadmill.operators import (
    Rule, accept_leads, all_rejects, duplicate_rejects, lead_completeness, merge_leads,
    reject_leads, surviving_rows,
)
from tests.leads import normalized_frame


def merged_row(spark, *rows):
    return merge_leads(normalized_frame(spark, *[{"email": "a@x.io", **row} for row in rows])).first()


def numbers(df):
    return sorted(r.source_row_number for r in df.collect())


def test_accept_and_reject_by_email(spark):
    leads = normalized_frame(spark, {"email": "a@x.io"}, {"raw_email": "@"}, {"email": "b@x.io"})
    assert numbers(accept_leads(leads)) == [1, 3]
    rejected = reject_leads(leads).collect()
    assert [(r.source_row_number, r.raw_email, r.drop_reason) for r in rejected] == [
        (2, "@", "missing_or_invalid_email")]


def test_the_first_broken_rule_gives_the_reason(spark):
    rules = [Rule("no_email", "email"), Rule("no_phone", "phone")]
    leads = normalized_frame(spark, {"email": "a@x.io", "phone": "1"}, {"email": "b@x.io"}, {})
    assert numbers(accept_leads(leads, rules)) == [1]
    assert [r.drop_reason for r in reject_leads(leads, rules).orderBy("source_row_number").collect()] == [
        "no_phone", "no_email"]


def test_all_accepted_and_all_rejected(spark):
    good = normalized_frame(spark, {"email": "a@x.io"})
    bad = normalized_frame(spark, {}, {})
    assert reject_leads(good).count() == 0 and accept_leads(bad).count() == 0
    assert merge_leads(accept_leads(bad)).count() == 0
    assert all_rejects(bad, surviving_rows(accept_leads(bad))).count() == 2


def test_longest_text_and_first_of_equally_long(spark):
    row = merged_row(
        spark,
        {"full_name": "Jane Doe", "title": "aaa", "company": None},
        {"full_name": "Jane A. Doe", "title": "bbb", "company": "Acme"},
        {"full_name": "x", "title": "c", "company": "Acme Studio"},
    )
    assert (row.full_name, row.title, row.company) == ("Jane A. Doe", "aaa", "Acme Studio")


def test_phone_with_plus_beats_a_longer_one(spark):
    assert merged_row(spark, {"phone": "123456789"}, {"phone": "+12"}, {"phone": "+13"}).phone == "+12"
    assert merged_row(spark, {"phone": "12"}, {"phone": "345"}, {"phone": "678"}).phone == "345"
    assert merged_row(spark, {}, {"phone": None}).phone is None


def test_earliest_date_lowest_number_and_first_values(spark):
    row = merged_row(
        spark,
        {"source_row_number": 9, "source": "Late", "country": "Canada", "lead_date": "2024-01-01",
         "raw_email": "A@x.io", "first_name": "Nine", "last_name": "Nine"},
        {"source_row_number": 4, "source": None, "country": "France", "lead_date": "2025-01-01",
         "raw_email": "a@X.io", "first_name": "Four"},
    )
    assert (row.source_row_number, row.lead_date) == (4, "2024-01-01")
    assert (row.source, row.country, row.raw_email) == ("Late", "France", "a@X.io")
    assert (row.first_name, row.last_name) == ("Four", "Nine")


def test_names_may_come_from_other_rows_than_the_full_name(spark):
    row = merged_row(spark, {"full_name": "Alex", "first_name": "Alex"},
                     {"full_name": "Alexander Johnson", "first_name": "Alexander", "last_name": "Johnson"})
    assert (row.full_name, row.first_name, row.last_name) == ("Alexander Johnson", "Alex", "Johnson")


def test_rows_without_email_are_one_group(spark):
    leads = normalized_frame(spark, {"title": "a"}, {"title": "bb"})
    assert [(r.source_row_number, r.title) for r in merge_leads(leads).collect()] == [(1, "bb")]
    assert numbers(duplicate_rejects(leads)) == [2]


def test_duplicates_are_kept_unmerged(spark):
    leads = normalized_frame(
        spark, {"email": "a@x.io", "title": "long title"}, {"email": "b@x.io"},
        {"email": "a@x.io", "title": "t"}, {"email": "a@x.io"})
    rows = duplicate_rejects(leads).orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.title, r.drop_reason) for r in rows] == [
        (3, "t", "duplicate_email_merged"), (4, None, "duplicate_email_merged")]
    unique = normalized_frame(spark, {"email": "a@x.io"}, {"email": "b@x.io"})
    assert duplicate_rejects(unique).count() == 0


def test_all_rejects_gives_both_kinds_with_their_reasons(spark):
    leads = normalized_frame(spark, {"email": "a@x.io"}, {}, {"email": "a@x.io"})
    rows = all_rejects(leads, surviving_rows(accept_leads(leads))).collect()
    assert {(r.source_row_number, r.drop_reason) for r in rows} == {
        (2, "missing_or_invalid_email"), (3, "duplicate_email_merged")}


def test_completeness_counts_fields_with_a_value(spark):
    leads = normalized_frame(spark, {"email": "a@x.io", "title": "  ", "phone": "1"},
                             dict.fromkeys(LEAD_FIELDS, "v"), {})
    rows = lead_completeness(leads).orderBy("source_row_number").collect()
    assert [r.completeness for r in rows] == [2, 11, 0]


def hot_leads(seed=5, count=3000):
    """A third of the rows share one e-mail."""
    rng = random.Random(seed)

    def some(*options):
        return rng.choice(options)

    return [{
        "email": "hot@x.io" if n % 3 == 0 else f"u{rng.randint(0, 200)}@x.io",
        "raw_email": some("A@x", "b@X"), "full_name": some(None, "a", "bb", "cc"),
        "first_name": some(None, "f", "g"), "last_name": some(None, "l"),
        "title": some(None, "x", "yy"), "company": some(None, "acme", "long company"),
        "phone": some(None, "+1", "+22", "33333", "+23"), "source": some(None, "s", "t"),
        "country": some(None, "France"), "lead_date": some(None, "2025-01-02", "2024-12-31"),
    } for n in range(count)]


def by_hand(rows):
    """The policies over all rows in memory."""
    groups = {}
    for number, row in enumerate(rows, 1):
        groups.setdefault(row["email"], []).append((number, row))
    out = set()
    for email, members in groups.items():
        def listed(field, members=members):
            return [row[field] for _, row in members if row[field] is not None]

        def longest(field, listed=listed):
            return max(listed(field), key=len, default=None)

        def first(field, listed=listed):
            return next(iter(listed(field)), None)

        phones = [p for p in listed("phone") if p[0] == "+"] or listed("phone")
        out.add((members[0][0], longest("full_name"), first("first_name"), first("last_name"),
                 first("raw_email"), email, longest("title"), longest("company"),
                 max(phones, key=len, default=None), first("source"), first("country"),
                 min(listed("lead_date"), default=None)))
    return out


def test_merge_agrees_with_a_merge_by_hand_under_any_partitioning(spark):
    rows = hot_leads()
    leads = normalized_frame(spark, *rows)
    expected = by_hand(rows)
    for arranged in (leads.coalesce(1), leads.repartition(13), leads.orderBy(F.rand(3))):
        assert {tuple(r) for r in merge_leads(arranged).collect()} == expected
    kept = {r[0] for r in expected}
    assert set(numbers(duplicate_rejects(leads))) == set(range(1, len(rows) + 1)) - kept
