"""Scoring rules as data, and the columns derived from a score."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add as plus

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.features import add, flag


@dataclass(frozen=True)
class Rule:
    """``points`` are added to the score where the SQL condition holds."""

    name: str
    points: float
    condition: str


# --- Fixed values: conditions and points of the two rule sets ----------------
STATELESS_RULES = [
    Rule("very_high_amount", 40.0, "is_very_high_amount = 1"),
    Rule("high_amount", 25.0, "is_very_high_amount = 0 AND is_high_amount = 1"),
    Rule("unusual_hour", 20.0, "is_unusual_hour = 1"),
    Rule("round_amount", 15.0, "is_round_amount = 1 AND amount > 200"),
    Rule("high_risk_merchant", 20.0, "is_high_risk_merchant = 1 AND amount > 300"),
    Rule("online_high_amount", 15.0, "is_online AND amount > 500"),
    Rule("weekend_night", 20.0, "is_weekend = 1 AND is_unusual_hour = 1 AND amount > 200"),
]

BEHAVIOUR_RULES = [
    Rule("high_amount", 30.0, "amount > 500"),
    Rule("unusual_hour", 20.0, "is_unusual_hour = 1"),
    Rule("rapid_transaction", 25.0, "is_rapid_transaction = 1"),
    Rule("impossible_travel", 40.0, "is_impossible_travel = 1"),
    Rule("device_change", 30.0, "device_changed = 1 AND amount > 200"),
    Rule("high_risk_merchant", 15.0, "is_high_risk_merchant = 1 AND amount > 300"),
    Rule("burst", 20.0, "txn_count_5min > 3"),
]

ALERT_SCORE = 50
RISK_BANDS = [("HIGH", 70), ("MEDIUM", 50), ("LOW", 30)]
# --- end of fixed values ----------------------------------------------------


def score_column(rules: list[Rule]) -> Column:
    """The sum of the points of all rules that hold; unknown counts as not."""
    return reduce(plus, [F.when(F.expr(r.condition), F.lit(r.points)).otherwise(F.lit(0.0)) for r in rules])


def risk_level(score: str | Column = "fraud_score") -> Column:
    """Band of a score; a missing score is SAFE."""
    score = F.col(score) if isinstance(score, str) else score
    chain = F
    for name, floor in RISK_BANDS:
        chain = chain.when(score >= floor, name)
    return chain.otherwise("SAFE")


def apply_rules(df: DataFrame, rules: list[Rule] = STATELESS_RULES) -> DataFrame:
    """Add ``fraud_score``, ``predicted_fraud`` and ``risk_level``."""
    scored = add(df, {"fraud_score": score_column(rules)})
    return add(scored, {"predicted_fraud": flag(F.col("fraud_score") >= ALERT_SCORE), "risk_level": risk_level()})


def confusion_flags(df: DataFrame) -> DataFrame:
    """Add one 0/1 column per cell of the confusion matrix."""
    truth, said = F.col("is_fraud"), F.col("predicted_fraud")
    return add(
        df,
        {
            "true_positive": flag((truth == 1) & (said == 1)),
            "false_positive": flag((truth == 0) & (said == 1)),
            "true_negative": flag((truth == 0) & (said == 0)),
            "false_negative": flag((truth == 1) & (said == 0)),
        },
    )


def rule_hits(df: DataFrame, rules: list[Rule] = STATELESS_RULES) -> DataFrame:
    """Hits and points per rule, in one aggregate over the feature table.

    The input is read once and reduced map-side; the single result row is
    unfolded afterwards, so rules without a hit are listed too.
    """
    counts = df.agg(*[F.count_if(F.expr(r.condition)).alias(r.name) for r in rules])
    cells = [
        F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("hits"), (F.col(r.name) * r.points).alias("points"))
        for r in rules
    ]
    return counts.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
