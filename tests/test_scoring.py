import pytest

from leadmill.fixed_values import SCORING_RULES
from leadmill.functions import casefold
from leadmill.operators import compile_rules, enrich_leads, first_matching_rule, score_leads
from tests.leads import values

SCHEMA = ("title string, company string, email string, industry string, company_size string, "
          "enrichment_status string")


def scored(spark, rules=SCORING_RULES, normalized=False, **fields):
    row = tuple(fields.get(c.split()[0]) for c in SCHEMA.split(", "))
    result = score_leads(spark.createDataFrame([row], SCHEMA), rules, normalized).first()
    return result.lead_score, result.score_reasons


def test_points_and_reasons_add_up_in_order(spark):
    assert scored(spark, title="Head of Demand Generation", company="Loom", email="p@loom.fr",
                  industry="fashion", company_size="enterprise", enrichment_status="enriched") == (
        51, ["marketing_and_campaigns", "vp_head_director", "industry_fashion", "company_size_enterprise"])


def test_first_rule_of_each_list_wins(spark):
    assert scored(spark, title="Founder and Art Director", company="A", email="a@a.co", industry="education",
                  company_size="small_business") == (
        46, ["brand_and_creative_leadership", "executive", "industry_education", "company_size_small_business"])
    assert scored(spark, title="Lead Librarian", company="A")[0] == 23


def test_penalties_and_the_lower_bound(spark):
    assert scored(spark, title="BDR", email="z@iCloud.com", industry="nonprofit", enrichment_status="failed") == (
        0, ["sales", "industry_nonprofit", "penalty_free_email_domain", "penalty_missing_company",
            "penalty_failed_enrichment"])
    assert scored(spark, title="Developer", company="A", industry="retail", enrichment_status="failed") == (
        9, ["engineering", "industry_retail", "penalty_failed_enrichment"])


def test_upper_bound_and_base(spark):
    rules = {**SCORING_RULES, "base_score": 95}
    assert scored(spark, rules, title="Creative Operations Chief", company="A", industry="media",
                  company_size="enterprise")[0] == 100
    assert scored(spark, rules, title=None, company="A") == (95, [])


def test_every_key_of_the_rules_is_optional(spark):
    assert scored(spark, {}, title="CEO", company=None, email="a@gmail.com") == (0, [])
    assert scored(spark, {"base_score": -5, "score_bounds": {"min": -9}}) == (-5, [])


def test_rule_with_no_points_still_gives_its_reason(spark):
    rules = {"title_function_scores": [{"name": "known", "score": 0, "keywords": ["ceo"]}],
             "industry_scores": {"media": 0}}
    assert scored(spark, rules, title="CEO", company="A", industry="media") == (0, ["known"])


def test_text_is_cleaned_and_folded_before_it_is_matched(spark):
    assert scored(spark, title="  HEAD   of\tCreative ", company=" ", industry=" Media ") == (
        33, ["brand_and_creative_leadership", "vp_head_director", "industry_media",
             "penalty_missing_company"])


def test_clean_text_may_be_declared(spark):
    fields = {"title": "Head of Sales", "company": "A", "email": "a@yahoo.com", "industry": "software",
              "company_size": "small_business", "enrichment_status": "enriched"}
    assert scored(spark, normalized=True, **fields) == scored(spark, **fields)


def test_columns_that_are_absent_count_as_empty(spark):
    row = score_leads(spark.createDataFrame([("CEO",)], "title string"), SCORING_RULES).first()
    assert (row.lead_score, row.score_reasons) == (12, ["executive", "penalty_missing_company"])
    assert enrich_leads(spark.createDataFrame([("x",)], "email string")).first().enrichment_status == "not_found"


def test_empty_input_gains_typed_columns(spark):
    result = score_leads(spark.createDataFrame([], SCHEMA), SCORING_RULES)
    assert dict(result.dtypes)["lead_score"] == "int"
    assert dict(result.dtypes)["score_reasons"] == "array<string>"
    assert result.count() == 0


@pytest.mark.parametrize(("keywords", "text", "hit"), [
    (["dam"], "madam leader", False),
    (["dam"], "the dam", True),
    (["data"], "data-driven", True),
    (["lead"], "leader", False),
    (["vice president"], "senior vice president, sales", True),
    ([" Vice   President "], "vice president", True),
    (["c++"], "c++ developer", False),   # a boundary after a sign needs a letter next to it
    (["c++"], "c++x", True),
    (["a.b"], "axb", False),
    (["ceo"], "écéo ceoé", False),
    (["ceo"], "ceo_x", False),
    ([r"a\Eb"], r"x a\Eb y", True),
    (["c++", "dev"], "the dev", True),
    (["c++", "dev"], "c++x", True),
    (["", "  "], "anything", False),
    ([], "anything", False),
])
def test_keywords_match_whole_words(spark, keywords, text, hit):
    rules = compile_rules([{"name": "r", "score": 1, "keywords": keywords}])
    found = values(spark, lambda c: first_matching_rule(casefold(c), rules), text)
    assert found == [1 if hit else None]


COMPANIES = [
    ("Acme Studio", None, "agency", "mid_market", "acmestudio.com", "enriched"),
    ("Big Media", "x", "media", "mid_market", "bigmedia.com", "enriched"),
    ("GlobalTech", None, "unknown", "enterprise", "globaltech.com", "enriched"),
    ("Hyper Software", "Brand Lead", "software", "small_business", "hypersoftware.com", "enriched"),
    ("Initech Labs", "Creative Head", "media", "mid_market", "initechlabs.com", "enriched"),
    ("International Agency", None, "agency", "enterprise", "internationalagency.com", "enriched"),
    ("!!!", None, "unknown", "small_business", ".com", "enriched"),
    ("Éclair & Co. 9", None, "unknown", "small_business", "éclairco9.com", "enriched"),
    ("  ", "Creative", None, None, None, "not_found"),
    (None, "Creative", None, None, None, "not_found"),
]


def test_company_facts(spark):
    frame = spark.createDataFrame([(n, c[0], c[1]) for n, c in enumerate(COMPANIES)],
                                  "n int, company string, title string")
    rows = enrich_leads(frame).orderBy("n").collect()
    assert [tuple(r)[1:] for r in rows] == COMPANIES
    assert enrich_leads(frame.limit(0)).columns == [
        "n", "company", "title", "industry", "company_size", "company_domain", "enrichment_status"]
