import random
import re
from datetime import date, datetime

import pytest

from leadmill import functions as L
from tests.leads import values


def shuffled_texts(alphabet, count, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest))) for _ in range(count)]


def test_text_is_collapsed_stripped_or_null(spark):
    given = [None, "", "   ", "  a \t b\n", "x  y", "\x1c\x1fz　", "Keep Case", "a"]
    assert values(spark, L.normalize_text, *given) == [
        None, None, None, "a b", "x y", "z", "Keep Case", "a"]


def test_every_white_space_character_is_collapsed(spark):
    texts = [f"a{chr(i)}b" for i in range(1, 0x3100)]
    assert values(spark, L.normalize_text, *texts) == [re.sub(r"\s", " ", t) for t in texts]


def test_text_cleaning_is_idempotent(spark):
    texts = shuffled_texts("ab \t \x1d", 500, 10, 1)
    once = values(spark, L.normalize_text, *texts)
    assert values(spark, L.normalize_text, *once) == once


@pytest.mark.parametrize(("given", "expected"), [
    ("  JO@SITE.IO ", "jo@site.io"),
    ("a@b..c", "a@b..c"),
    ("a@b@c.d", None),
    ("@", None),
    ("carol@", None),
    ("no-at.com", None),
    ("name@host", None),
    ("a b@c.io", None),
    (" é@É.com ", "é@é.com"),
    (None, None),
    ("", None),
])
def test_email(spark, given, expected):
    assert values(spark, L.normalize_email, given) == [expected]


def test_email_agrees_with_a_full_match_on_cleaned_text(spark):
    texts = shuffled_texts("a@. 　\x1fB@.\n", 3000, 9, 2)

    def expected(text):
        cleaned = " ".join(text.split()).lower()
        return cleaned if re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s]+", cleaned) else None

    found = values(spark, L.normalize_email, *texts)
    assert found == [expected(t) for t in texts]
    assert any(found)


def test_email_domain(spark):
    assert values(spark, L.email_domain, "a@B.c", "a@b@C.D", "none", None) == ["b.c", "c.d", None, None]


@pytest.mark.parametrize(("given", "expected"), [
    ("(123) 456-7890", "1234567890"),
    ("+1 800 555 1212", "+18005551212"),
    ("+1 (416) 555-0101 ext 9", "+14165550101"),
    ("555 0101 ext. 22", "5550101"),
    ("555 0101 X22 more 7", "5550101"),
    ("5550101x9", "55501019"),
    ("(+1) 555", "1555"),
    ("x5", None),
    ("call me", None),
    ("  ", None),
    (None, None),
])
def test_phone(spark, given, expected):
    assert values(spark, L.normalize_phone, given) == [expected]


def test_title_case_agrees_with_python(spark):
    texts = [" ".join(t.split()) for t in shuffled_texts("abCDéÉß日'-. 3ǆﬁxX_", 2000, 12, 3)]
    assert values(spark, L.title_case, *texts) == [t.title() for t in texts]


def test_names(spark):
    names = ["jane mary doe", "Prince", "d. van der berg", "éloise O'BRIEN", " o'neil  mary-jane smith", None]
    assert values(spark, L.first_name, *names) == ["Jane", "Prince", "D.", "Éloise", "O'Neil", None]
    assert values(spark, L.last_name, *names) == ["Doe", None, "Berg", "O'Brien", "Smith", None]
    assert values(spark, L.last_name, "x MCDONALD", "a 3rd") == ["Mcdonald", "3Rd"]


@pytest.mark.parametrize(("given", "expected"), [
    ("04-Dec-2023", "2023-12-04"),
    ("04-december-2023", "2023-12-04"),
    ("1999-01-31", "1999-01-31"),
    ("2025/6/2", "2025-06-02"),
    ("2/11/2022", "2022-02-11"),
    ("30/11/2022", "2022-11-30"),
    ("3/5/2025 14:22", "2025-03-05"),
    ("17/08/2021 10:00", "2021-08-17"),
    ("8/17/21", "2021-08-17"),
    ("8/17/71", "1971-08-17"),
    ("17-Aug-21", "2021-08-17"),
    ("5-Mar-2025 10:00:00", "2025-03-05"),
    ("2025-03-05 07:05 PM", "2025-03-05"),
    ("2025-03-05 07:05pm", "2025-03-05"),
    ("Sept 5, 2025", "2025-09-05"),
    ("Wed, 05 Mar 2025", "2025-03-05"),
    ("Wednesday, March 5, 2025", "2025-03-05"),
    ("30/02/24", None),
    ("Sept 31, 2025", None),
    ("Foo, 05 Mar 2025", None),
    ("3/5/2025 25:22", None),
    ("3/5/2025x", None),
    ("05/07/2025", "2025-05-07"),
    ("05-07-2025", "2025-07-05"),
    ("02-25-2025", "2025-02-25"),
    ("02/30/2024", None),
    ("31-04-2025", None),
    ("29-02-2023", None),
    ("29-Feb-2024", "2024-02-29"),
    ("2025-03-05 23:59:59", "2025-03-05"),
    ("2025-03-05 25:00:00", None),
    ("2025-03-05T23:30:00-08:00", "2025-03-05"),
    ("2025-03-05T10:00:00.123Z", "2025-03-05"),
    ("2025-3-5 7:05", "2025-03-05"),
    ("Mar 5, 2025", "2025-03-05"),
    ("march 5 2025", "2025-03-05"),
    ("5 March 2025", "2025-03-05"),
    ("20250305", "2025-03-05"),
    ("20251305", None),
    ("2025-Mar-05", "2025-03-05"),
    ("2025-03/05", None),
    ("0000-01-01", None),
    ("12025-01-01", None),
    ("+12025-1-1", None),
    ("--", None),
    ("12 days ago", None),
    ("1-Foo-2025", None),
    ("", None),
    (None, None),
])
def test_date(spark, given, expected):
    assert values(spark, L.normalize_date, given) == [expected]


def test_number_dates_agree_with_the_calendar(spark):
    rng = random.Random(4)
    cases = []
    for _ in range(2000):
        a, b, year = rng.randint(0, 35), rng.randint(0, 35), rng.choice([1999, 2024, 2025])
        slash = rng.random() < 0.5
        day_first = a > 12 if slash else b <= 12
        day, month = (a, b) if day_first else (b, a)
        try:
            expected = date(year, month, day).isoformat()
        except ValueError:
            expected = None
        cases.append((f"{a}{'/' if slash else '-'}{b}{'/' if slash else '-'}{year}", expected))
    assert values(spark, L.normalize_date, *[c[0] for c in cases]) == [c[1] for c in cases]
    assert datetime.fromisoformat(max(c[1] for c in cases if c[1])).year == 2025


def test_country_key(spark):
    given = ["U.S.", "Trinidad & Tobago", "Côte d’Ivoire", "korea_(south)", " STRASSE ß ", "--", "a b"]
    assert values(spark, L.country_key, *given) == [
        "us", "trinidad and tobago", "côte divoire", "korea south", "strasse ss", "", "a b"]


def test_presence(spark):
    frame = spark.createDataFrame(
        [("x", 1.5, ["a"], 0), ("  ", float("nan"), [], None), (None, None, None, 1)],
        "s string, d double, a array<string>, i int")
    rows = frame.select(L.is_present("s"), L.is_present("d", "double"), L.is_present("a", "array"),
                        L.is_present("i", "integer")).collect()
    assert [tuple(r) for r in rows] == [
        (True, True, True, True), (False, False, False, False), (False, False, False, True)]
