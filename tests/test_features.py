"""Hand-computed values of features, rules and bands at their edges."""

import datetime as dt
import math

import pytest
from data import row, table
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlens.functions import features, rules
from ledgerlens.operators import scoring
from ledgerlens.plans.inputs import LITERAL_ROWS
from ledgerlens.schema import (
    BEHAVIOUR_FEATURES,
    BEHAVIOUR_OUTPUT,
    MODEL_FEATURES,
    MODEL_OUTPUT,
    RULE_OUTPUT,
    STREAM_FEATURES,
)
from ledgerlens.sources.tables import enrich_merchant, from_rows


def one(df, *columns):
    return tuple(df.select(*columns).first())


@pytest.mark.parametrize(
    "amount, expected",
    [
        (0.0, (0.0, "low", 0, 0)),
        (-5.0, (0.0, "low", 0, 0)),
        (19.99, (math.log10(19.99), "low", 0, 0)),
        (20.0, (math.log10(20), "medium", 0, 0)),
        (100.0, (2.0, "high", 0, 0)),
        (500.0, (math.log10(500), "very_high", 0, 0)),
        (500.01, (math.log10(500.01), "very_high", 1, 0)),
        (1000.0, (3.0, "very_high", 1, 0)),
        (1000.01, (math.log10(1000.01), "very_high", 1, 1)),
        (None, (0.0, "very_high", 0, 0)),
    ],
)
def test_amount_edges(spark, amount, expected):
    df = spark.createDataFrame([(amount,)], "amount double")
    got = one(features.amount_features(df), "amount_log", "amount_category", "is_high_amount", "is_very_high_amount")
    assert got[0] == pytest.approx(expected[0]) and got[1:] == expected[1:]


@pytest.mark.parametrize("hour, unusual", [(1, 0), (2, 1), (5, 1), (6, 0)])
def test_unusual_hour_is_inclusive(spark, hour, unusual):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 2, hour, 59),)], "timestamp timestamp")
    # 2 March 2024 is a Saturday: day 7, weekend.
    assert one(features.time_features(df), "hour_of_day", "day_of_week", "is_unusual_hour", "is_weekend") == (
        hour, 7, unusual, 1,
    )


def test_simple_and_merchant_features(spark):
    df = table(
        spark,
        [row(1, "U", 0, amount=30.0, is_online=True, merchant_category="online_shopping"),
         row(2, "U", 0, amount=30.5, merchant_category="clothing")],
    )
    got = features.merchant_features(features.simple_features(df)).orderBy("transaction_id")
    columns = ["is_round_amount", "is_online_flag", "timestamp_epoch", "is_high_risk_merchant", "is_online_merchant"]
    assert [tuple(r) for r in got.select(*columns).collect()] == [
        (1, 1, 1709294400, 1, 1),
        (0, 0, 1709294400, 0, 0),
    ]


def test_model_vector_order_and_null_rows(spark):
    df = table(spark, [row(1, "U", 0, amount=999.0, is_online=True), row(2, "U", 0, amount=None)])
    vectors = features.assemble(features.model_features(df))
    assert vectors.columns == ["features", "label"] and vectors.count() == 1
    values = vectors.select(vector_to_array("features").alias("v")).first().v
    assert len(values) == len(MODEL_FEATURES) == 12
    assert values[:3] == [999.0, pytest.approx(3.0), 12.0] and values[9] == 1.0


def test_feature_lists():
    assert (len(STREAM_FEATURES), len(BEHAVIOUR_FEATURES), len(MODEL_FEATURES)) == (13, 14, 12)
    assert (len(RULE_OUTPUT), len(MODEL_OUTPUT), len(BEHAVIOUR_OUTPUT)) == (18, 22, 21)


def test_literal_rows_score_as_computed_by_hand(spark):
    scored = scoring.score_rules(from_rows(spark, LITERAL_ROWS)).orderBy("transaction_id")
    assert [tuple(r) for r in scored.select("transaction_id", "fraud_score", "risk_level").collect()] == [
        ("SAMPLE_01", 0.0, "SAFE"),
        ("SAMPLE_02", 110.0, "HIGH"),
        ("SAMPLE_03", 0.0, "SAFE"),
        ("SAMPLE_04", 110.0, "HIGH"),
        ("SAMPLE_05", 0.0, "SAFE"),
    ]


def test_all_stateless_rules_together(spark):
    # Saturday 03:00, 1500 euros, round, online, high-risk merchant: everything but the lower amount rule.
    night = dt.datetime(2024, 3, 2, 3, 0)
    df = table(spark, [row(1, "U", 0, timestamp=night, amount=1500.0, is_online=True, merchant_category="hotel")])
    assert one(scoring.score_rules(df), "fraud_score", "predicted_fraud", "risk_level") == (130.0, 1, "HIGH")


@pytest.mark.parametrize(
    "score, level", [(None, "SAFE"), (29.9, "SAFE"), (30.0, "LOW"), (50.0, "MEDIUM"), (69.9, "MEDIUM"), (70.0, "HIGH")]
)
def test_risk_level_edges(spark, score, level):
    df = spark.createDataFrame([(score,)], "fraud_score double")
    assert one(df.select(rules.risk_level().alias("level")), "level") == (level,)


def test_confusion_flags_ignore_unknown_labels(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 0), (None, 1)], "is_fraud int, predicted_fraud int")
    sums = rules.confusion_flags(df).agg(
        *[F.sum(c) for c in ("true_positive", "false_positive", "true_negative", "false_negative")]
    )
    assert tuple(sums.first()) == (1, 1, 1, 1)


def test_rules_without_hits_are_listed(spark):
    hits = rules.rule_hits(features.rule_features(table(spark, [row(1, "U", 0)])))
    assert {r["rule"]: r["hits"] for r in hits.collect()} == {r.name: 0 for r in rules.STATELESS_RULES}


def test_enrichment_keeps_unknown_categories(spark):
    df = table(spark, [row(1, "U", 0, amount=70.0), row(2, "U", 0, merchant_category="grocery")])
    got = sorted(tuple(r) for r in enrich_merchant(df).select("transaction_id", "category_avg", "amount_ratio").collect())
    assert got == [("T00001", 35.0, 2.0), ("T00002", None, None)]
