"""Scored tables: features, rules or model, confusion flags, output layout.

The rule and model scorers are row-wise and work on streams unchanged.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.features import add, assemble, flag, model_features, rule_features
from ledgerlens.functions.rules import BEHAVIOUR_RULES, apply_rules, confusion_flags, risk_level
from ledgerlens.operators.history import behaviour_features
from ledgerlens.operators.slices import DEFAULT_POLICY, HotPolicy
from ledgerlens.schema import BEHAVIOUR_OUTPUT, MODEL_FEATURES, MODEL_OUTPUT, RULE_OUTPUT


def score_rules(df: DataFrame) -> DataFrame:
    """Transactions with rule features, score, prediction and risk level."""
    return apply_rules(rule_features(df))


def score_behaviour(df: DataFrame, policy: HotPolicy | None = DEFAULT_POLICY) -> DataFrame:
    """The same with the rules on the user's history (batch)."""
    return apply_rules(behaviour_features(df, policy), BEHAVIOUR_RULES)


def _probability_only(model: RandomForestClassificationModel) -> RandomForestClassificationModel:
    """A copy that adds the probability column alone: one walk of the trees per row."""
    return model.copy().setRawPredictionCol("").setPredictionCol("")


def score_model(df: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    """Transactions with the forest's probability, score, class and risk level.

    The class is the likelier one, read off the probabilities. A probability of
    exactly one half is not a fraud to the forest although its score of 50 is
    in the MEDIUM band. A row that lacks a feature cannot be scored: it stays,
    with probability 0.
    """
    predicted = _probability_only(model).transform(assemble(model_features(df), label=None))
    chances = add(predicted, {"chances": vector_to_array("probability")})

    def chance(label: int):
        return F.coalesce(F.get("chances", F.lit(label)), F.lit(0.0))

    whole = F.lit(True)
    for feature in MODEL_FEATURES:
        whole = whole & F.col(feature).isNotNull()
    scored = add(
        chances,
        {
            "predicted_fraud": flag(whole & (chance(1) > chance(0))),
            "fraud_probability": F.when(whole, chance(1)).otherwise(0.0),
        },
    )
    scored = add(scored.drop("features", "probability", "chances"), {"fraud_score": F.col("fraud_probability") * 100})
    return add(scored, {"risk_level": risk_level()})


def rule_output(df: DataFrame) -> DataFrame:
    return confusion_flags(score_rules(df)).select(*RULE_OUTPUT)


def behaviour_output(df: DataFrame, policy: HotPolicy | None = DEFAULT_POLICY) -> DataFrame:
    return confusion_flags(score_behaviour(df, policy)).select(*BEHAVIOUR_OUTPUT)


def model_output(df: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    return confusion_flags(score_model(df, model)).select(*MODEL_OUTPUT)
