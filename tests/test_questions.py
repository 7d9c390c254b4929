from decimal import Decimal as D

import frames
from frames import churn, feed

from attrition.plans import questions


def tagged(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, question string")
    return [r.intents for r in questions.tag_intents(df).orderBy("id").collect()]


def test_intents_overlap_as_written(spark):
    got = tagged(
        spark,
        [
            "How much revenue is at risk?",
            "What is the overall churn rate?",
            "HOW MANY customers will churn",
            "why do they leave",
            "hello",
            "two-year plan",
            "how many\nchurn",
        ],
    )
    assert got == [
        ["revenue_at_risk", "high_risk"],
        ["churn_rate"],
        ["churn_rate", "count"],
        ["reason"],
        ["fallback"],
        ["contract"],
        ["count"],
    ]


def answers(spark, rows, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, question string")
    return [r.answer for r in questions.answer_questions(df, rows).orderBy("id").collect()]


def test_answer_text(spark):
    rows = feed(spark, [churn(reason="Moved", monthly=D(10)), churn(reason="Price"), churn(reason="Moved"), {}])
    rate, reason, risk, hello = answers(spark, rows, ["churn rate", "top reasons", "revenue at risk", "hello"])
    assert rate == "Overall churn rate in the current view is **75.00%** (3 of 4 customers churned)."
    assert reason == "Top churn reason: **Moved** (2 churners).\nTop 3 reasons: Moved (2) · Price (1)."
    assert risk.split("\n") == [
        "Revenue at risk is **$30** per month (churned customers' recurring charges).",
        "**0** currently-active customers are high-risk (churn score ≥ 70) and should be prioritized for retention.",
    ]
    assert hello.startswith("Analysis of 4 customers: churn rate **75.00%**, top reason **Moved**.\nTry: ")


def test_answers_without_churners_or_rows(spark):
    reason, hello = answers(spark, feed(spark, [{}]), ["reason", "hello"])
    assert reason == "Top churn reason: **n/a** (0 churners)."
    assert "no churners in view" in hello
    empty = answers(spark, feed(spark, [{}]).limit(0), ["average bill", "contract"])
    assert empty[0] == "Average monthly charge is **$0** and average CLTV is **$0**."
    assert "Highest-churn contract: **Month-to-month** at **0.00%**; lowest: **Two year**" in empty[1]


def test_single_reason_has_no_top_three(spark):
    (text,) = answers(spark, feed(spark, [churn(reason="A")]), ["reason"])
    assert text == "Top churn reason: **A** (1 churners)."


def test_suggestions_all_match_an_intent(spark):
    got = questions.tag_intents(questions.suggested_questions(spark)).collect()
    assert len(got) == 6 and all(r.intents != ["fallback"] for r in got)


def test_questions_are_not_shuffled(spark):
    df = spark.range(1000).selectExpr("id", "concat('churn rate ', id) AS question")
    plan = questions.answer_questions(df, frames.feed(spark, [{}]))._jdf.queryExecution().executedPlan().toString()
    top = plan.split("BroadcastExchange")[0]
    assert "Exchange hash" not in top and "CartesianProduct" not in plan and "NestedLoop" not in plan
