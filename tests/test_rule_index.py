"""Rules looked up by words against rules tried one after the other."""

import random

import pytest
from pyspark.sql import functions as F

from leadmill.operators import rule_index, score_leads
from leadmill.operators.rule_index import keyword_table, rule_of_texts, with_first_rule
from leadmill.operators.score import compile_rules, first_matching_rule

TEXTS = [None, "", "vice president", "vice presidents", "the vice president of c++", "c++", "c++x", "a c++b", "r&d lead", "ard lead",
         "r&d", "head-of sales", "head of sales", "-x", "a-x", "a-x y", "a -x", "é lead", "élead", "lead_", "a++b", "++", "a ++ b",
         "o'neil data", "data", "data,data", "x\\Ey", "b.net dev", "bxnet dev", "sr. eng", "lead lead lead", "vice  president"]
RULES = [{"name": "none", "keywords": []}, {"name": "signs", "keywords": ["++"]}, {"name": "c", "keywords": ["c++", "  C++B "]},
         {"name": "vp", "keywords": ["Vice  President", "vp"]}, {"name": "rd", "keywords": ["r&d"]}, {"name": "x", "keywords": ["-x"]},
         {"name": "net", "keywords": ["b.net", "x\\Ey"]}, {"name": "lead", "keywords": ["lead", "of sales"]},
         {"name": "data", "keywords": ["data", "o'neil", "data"]}, {"name": "eng", "keywords": ["sr.", "sr. eng"]}]


def both(spark, texts, rules):
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    scored = [{"score": 1, **rule} for rule in rules]
    chain = frame.select("n", first_matching_rule("t", compile_rules(scored)).alias("p"))
    looked_up = with_first_rule(frame, "t", keyword_table(spark, rules), "p")
    return ({r.n: r.p for r in chain.collect()}, {r.n: r.p for r in looked_up.select("n", "p").collect()})


def test_looking_up_equals_trying_one_by_one(spark):
    chain, looked_up = both(spark, TEXTS * 2, RULES)
    assert looked_up == chain and len(set(chain.values())) > 7


@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_random_texts_and_keywords(spark, monkeypatch, broadcast):
    monkeypatch.setattr(rule_index, "MAX_BROADCAST_BYTES", broadcast)
    rng = random.Random(4)

    def text(n):
        return "".join(rng.choice("ab é+-.&  ") for _ in range(rng.randint(1, n))).strip()

    rules = [{"name": str(i), "keywords": [text(5) for _ in range(2)]} for i in range(60)]
    texts = [" ".join(text(20).split()) for _ in range(400)]
    chain, looked_up = both(spark, texts, rules)
    assert looked_up == chain


def test_five_thousand_rules_score_like_a_chain_of_the_few_that_match(spark):
    rules = [{"name": f"rule {i}", "score": i % 50, "keywords": [f"desk {i}", f"unit {i} east"]} for i in range(5_000)]
    leads = spark.createDataFrame([(n, f"Chief of DESK {n * 37 % 6_000}, Unit {n} east", "a@b.io") for n in range(300)], "n long, title string, email string")
    plan = score_leads(leads, {"title_function_scores": rules, "seniority_scores": [{"name": "chief", "score": 3, "keywords": ["chief"]}]})
    for r in plan.collect():
        matching = [i for i in (r.n * 37 % 6_000, r.n) if i < 5_000]
        first = min(matching)
        assert (r.lead_score, r.score_reasons) == (first % 50 + 3, [f"rule {first}", "chief"])
    assert "desk 17" not in plan._jdf.queryExecution().optimizedPlan().toString().split("LocalRelation")[0]


def test_no_keywords_and_no_texts(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "n int, t string")
    none = keyword_table(spark, [])
    assert [r.p for r in with_first_rule(frame, "t", none, "p").collect()] == [None, None]
    assert rule_of_texts(frame.limit(0), "t", keyword_table(spark, RULES)).count() == 0
    assert with_first_rule(frame, "t", keyword_table(spark, RULES), "p").filter(F.col("p").isNull()).count() == 2
