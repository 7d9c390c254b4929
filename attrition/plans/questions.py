"""Plain-language questions answered in bulk.

Questions are tagged by patterns into a bit set. All answers that can occur, one
per bit set, are made from a single row of figures; questions then look theirs up,
so they are neither shuffled nor grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition import schemas
from attrition.functions.sql import aggregate, percent, quote, ratio
from attrition.operators.domains import literal_table
from attrition.plans.kpis import (
    CHURNED,
    SERVICE_COUNTS,
    SERVICE_STRUCTS,
    best_service,
    known,
    total_of,
    worst_service,
)

# Intent -> pattern searched in the lower-cased question, in answer order.
INTENTS = {
    "churn_rate": r"(churn rate|churn%|churn percentage|how many.*churn|overall churn)",
    "reason": r"(reason|why.*leave|why.*churn|top churn)",
    "contract": r"(contract|plan|month.to.month|two.year|one.year)",
    "service": r"(service|fiber|dsl|internet|tech support|add.on|retention)",
    "average": r"(average|avg|monthly charge|spend|bill)",
    "revenue_at_risk": r"(revenue.*risk|at risk|money.*lose|lose.*money|exposure)",
    "count": r"(how many|total|customers|count)",
    "high_risk": r"(high.risk|risk|score|cltv.*risk|at.risk.*customer)",
}
FALLBACK = "fallback"

# The suggested questions.
SUGGESTED = [
    "What is the overall churn rate?",
    "Top churn reasons",
    "Which contract churns the most?",
    "Which service has the highest churn?",
    "What is the average monthly charge?",
    "How much revenue is at risk?",
]


def suggested_questions(spark: SparkSession) -> DataFrame:
    return literal_table(spark, ["id", "question"], list(enumerate(SUGGESTED, start=1)))


def intent_bits(question: str) -> str:
    """SQL text of the bit set; patterns hold neither quotes nor backslashes."""
    return " + ".join(
        f"if(lower({question}) RLIKE '{pattern}', {1 << position}, 0)"
        for position, pattern in enumerate(INTENTS.values())
    )


def tag_intents(questions: DataFrame) -> DataFrame:
    """Adds the intents of each question, or the fallback when no pattern matches."""
    tagged = questions.selectExpr("*", f"{intent_bits('question')} AS _bits")
    hits = ", ".join(f"CASE WHEN _bits & {1 << p} <> 0 THEN '{name}' END" for p, name in enumerate(INTENTS))
    names = f"if(_bits = 0, array('{FALLBACK}'), array_compact(array({hits}))) AS intents"
    return tagged.selectExpr(*questions.columns, names)


def explode_intents(questions: DataFrame) -> DataFrame:
    return tag_intents(questions).selectExpr(*questions.columns, "posexplode(intents) AS (position, intent)")


def figures(rows: DataFrame) -> DataFrame:
    """Every number an answer may quote, as one row."""
    sums, contracts = {}, []
    for position, name in enumerate(schemas.CONTRACTS):
        here = f"contract = {quote(name)}"
        sums[f"c{position}"] = f"count_if({here})"
        sums[f"cgone{position}"] = f"count_if({here} AND {CHURNED})"
        rate = percent(f"cgone{position}", f"c{position}")
        contracts.append(f"struct({rate} AS rate, {position} AS pos, {quote(name)} AS name)")
    base = aggregate(
        rows,
        [],
        total="count(1)",
        gone=f"count_if({CHURNED})",
        monthly=total_of("monthly"),
        cltv=total_of("cltv"),
        at_risk=f"coalesce(sum(CASE WHEN {CHURNED} THEN monthly END), 0)",
        high_risk=f"count_if(NOT {CHURNED} AND score >= 70)",
        **sums,
        **SERVICE_COUNTS,
    )
    rated = base.selectExpr(
        "total",
        "gone",
        f"{percent('gone', 'total')} AS rate",
        f"{ratio('monthly', 'total')} AS avg_monthly",
        f"{ratio('cltv', 'total')} AS avg_cltv",
        "CAST(at_risk AS DOUBLE) AS at_risk",
        "high_risk",
        f"array({', '.join(contracts)}) AS contracts",
        f"{SERVICE_STRUCTS} AS services",
    )
    ranked = rated.selectExpr(
        "* EXCEPT (contracts, services)",
        "array_min(transform(contracts, c -> struct(-c.rate AS rank, c.pos AS tie, c.name, c.rate))) AS high",
        "array_min(transform(contracts, c -> struct(c.rate AS rank, -c.pos AS tie, c.name, c.rate))) AS low",
        f"{worst_service('services')} AS worst",
        f"{best_service('services')} AS best",
    )
    counted = aggregate(rows.filter(CHURNED), {"reason": known("reason", "Unknown")}, n="count(1)")
    leading = counted.orderBy(F.desc("n"), "reason").limit(3)
    top = leading.agg(F.expr("array_sort(collect_list(struct(-n AS rank, reason, n)))")).scalar()
    return ranked.withColumn("reasons", top)


def _whole(value: str) -> str:
    return f"format_number(CAST({value} AS BIGINT), 0)"


def _dollars(value: str) -> str:
    return f"concat('$', {_whole(f'floor({value} + 0.5D)')})"


def _pct(value: str) -> str:
    return f"concat(format_number(round({value}, 2), 2), '%')"


def _text(template: str, *values: str) -> str:
    """Fills each ``{}`` of the template."""
    pieces = template.split("{}")
    parts = [quote(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts += [value, quote(piece)]
    return f"concat({', '.join(parts)})"


def answer_lines(facts: DataFrame) -> DataFrame:
    """(bit, position, line) for every line an intent contributes."""
    first = "get(reasons, 0)"
    leading = f"array_join(transform(reasons, r -> concat(r.reason, ' (', {_whole('r.n')}, ')')), ' · ')"
    # The sentences of the answers.
    cause = f"if(size(reasons) > 0, {_text('top reason **{}**', f'{first}.reason')}, 'no churners in view')"
    lines = [
        (
            0,
            _text(
                "Overall churn rate in the current view is **{}** ({} of {} customers churned).",
                _pct("rate"),
                _whole("gone"),
                _whole("total"),
            ),
        ),
        (
            1,
            _text(
                "Top churn reason: **{}** ({} churners).",
                f"coalesce({first}.reason, 'n/a')",
                f"coalesce({_whole(f'{first}.n')}, '0')",
            ),
        ),
        (1, f"CASE WHEN size(reasons) > 1 THEN {_text('Top 3 reasons: {}.', leading)} END"),
        (
            2,
            _text(
                "Highest-churn contract: **{}** at **{}**; lowest: **{}** at **{}**.",
                "high.name",
                _pct("high.rate"),
                "low.name",
                _pct("low.rate"),
            ),
        ),
        (
            3,
            _text(
                "Highest-churn service: **{}** at **{}**; best retention: **{}** at **{}**.",
                "worst.service",
                _pct("worst.rate"),
                "best.service",
                _pct("best.rate"),
            ),
        ),
        (
            4,
            _text(
                "Average monthly charge is **{}** and average CLTV is **{}**.",
                _dollars("avg_monthly"),
                _dollars("avg_cltv"),
            ),
        ),
        (
            5,
            _text(
                "Revenue at risk is **{}** per month (churned customers' recurring charges).", _dollars("at_risk")
            ),
        ),
        (
            6,
            _text(
                "Current view contains **{}** customers — **{}** churned, **{}** active.",
                _whole("total"),
                _whole("gone"),
                _whole("total - gone"),
            ),
        ),
        (
            7,
            _text(
                "**{}** currently-active customers are high-risk (churn score ≥ 70)"
                " and should be prioritized for retention.",
                _whole("high_risk"),
            ),
        ),
        (8, _text("Analysis of {} customers: churn rate **{}**, {}.", _whole("total"), _pct("rate"), cause)),
        (
            8,
            quote('Try: "overall churn rate", "top churn reasons", "which contract churns the most", "revenue at risk".'),
        ),
    ]
    structs = ", ".join(
        f"struct({bit} AS bit, {position} AS position, {line} AS line)" for position, (bit, line) in enumerate(lines)
    )
    return facts.selectExpr(f"inline(array({structs}))").filter("line IS NOT NULL")


def answers(rows: DataFrame) -> DataFrame:
    """The answer text for each of the 256 bit sets."""
    none = len(INTENTS)
    bits = f"filter(sequence(0, {none - 1}), b -> shiftright(id, b) & 1 = 1)"
    sets = rows.sparkSession.range(1 << none).selectExpr(
        "CAST(id AS INT) AS _bits", f"explode(if(id = 0, array({none}), {bits})) AS bit"
    )
    lines = sets.join(F.broadcast(answer_lines(figures(rows))), "bit")
    ordered = "array_sort(collect_list(struct(position, line)))"
    return aggregate(lines, ["_bits"], answer=f"array_join(transform({ordered}, e -> e.line), '\\n')")


def answer_questions(questions: DataFrame, rows: DataFrame) -> DataFrame:
    tagged = questions.selectExpr("*", f"{intent_bits('question')} AS _bits")
    # 256 rows at most, whatever the data.
    return tagged.join(F.broadcast(answers(rows)), "_bits", "left").drop("_bits")
