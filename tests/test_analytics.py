"""Quantiles, running totals, model metrics and reports against plain Python."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from data import BASE, as_rows, row, table
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlens.functions.features import assemble, model_features
from ledgerlens.functions.rules import risk_level
from ledgerlens.operators import investigation, model, monitoring
from ledgerlens.operators.quantiles import QUARTILES, box_stats, counted_box, exact_box, running_totals
from ledgerlens.operators.scoring import score_model, score_rules
from ledgerlens.schema import MODEL_FEATURES

DISTRIBUTIONS = {
    "normal": lambda r: r.gauss(0, 50),
    "heavy_tail": lambda r: math.exp(r.gauss(0, 6)),
    "one_value_in_three": lambda r: 42.0 if r.random() < 0.34 else r.uniform(0, 100),
    "narrow": lambda r: 1e6 + r.random() * 1e-6,
    "few_values": lambda r: float(r.choice([0, 20, 35, 110])),
    "constant": lambda r: -3.5,
}


@pytest.mark.parametrize("draw", DISTRIBUTIONS.values(), ids=DISTRIBUTIONS.keys())
@pytest.mark.parametrize("n", [1, 2, 7, 1000])
@pytest.mark.parametrize("box", [exact_box, counted_box])
def test_exact_quantiles(spark, draw, n, box):
    rng = random.Random(n)
    rows = [(g, draw(rng)) for g in ("a", "b") for _ in range(n)] + [("a", None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = {"p01": 0.01, **QUARTILES, "p99": 0.99, "low": 0.0, "high": 1.0}
    got = {r["g"]: r for r in box(df, "g", "v", probs).collect()}
    assert set(got) == {"a", "b"}
    for g, r in got.items():
        values = np.array([v for k, v in rows if k == g and v is not None])
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
        assert (r["n"], r["min_value"], r["max_value"]) == (n, values.min(), values.max())
        assert r["mean_value"] == pytest.approx(values.mean(), rel=1e-12)
        if n > 1:
            assert r["sd_value"] == pytest.approx(values.std(ddof=1), rel=1e-6, abs=1e-9)
        else:
            assert r["sd_value"] is None


def test_approximate_box_is_close(spark):
    df = spark.range(10_000).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v"))
    exact, approx = box_stats(df, "g", "v").first(), box_stats(df, "g", "v", "approx").first()
    assert abs(exact["median"] - approx["median"]) <= 2
    with pytest.raises(ValueError):
        box_stats(df, "g", "v", "guess")


def test_running_totals(spark):
    rng = random.Random(4)
    values = sorted({rng.uniform(-5, 100) for _ in range(500)} | {0.0, 100.0}, reverse=True)
    rows = [(v, rng.randrange(5), rng.randrange(9)) for v in values]
    got = running_totals(spark.createDataFrame(rows, "v double, a long, b long").repartition(4), "v", ["a", "b"])
    a = b = 0
    expected = []
    for v, x, y in rows:
        a, b = a + x, b + y
        expected.append((v, a, b))
    assert sorted(map(tuple, got.select("v", "cum_a", "cum_b").collect()), reverse=True) == expected
    assert {tuple(r) for r in got.select("total_a", "total_b").collect()} == {(a, b)}


@pytest.fixture(scope="module")
def predictions(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(900):
        fraud = int(rng.random() < 0.2)
        score = min(100.0, max(0.0, round(rng.gauss(55 if fraud else 35, 20), 0)))
        rows.append((fraud, int(score > 50), score))
    return spark.createDataFrame(rows, "is_fraud int, predicted_fraud int, fraud_score double").persist()


def test_metrics_equal_the_library_evaluators(spark, predictions):
    got = {r["metric"]: r["value"] for r in model.evaluate(predictions).collect()}
    typed = predictions.select(
        F.col("is_fraud").cast("double").alias("label"), F.col("predicted_fraud").cast("double").alias("prediction"), "fraud_score"
    )
    for name, metric in (("auc_roc", "areaUnderROC"), ("auc_pr", "areaUnderPR")):
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="fraud_score", metricName=metric, numBins=0)
        assert got[name] == pytest.approx(evaluator.evaluate(typed), abs=1e-12)
    for name, metric in (
        ("accuracy", "accuracy"),
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
        ("f1", "f1"),
    ):
        assert got[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(typed), abs=1e-12)


def test_metrics_without_frauds(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0)], "is_fraud int, predicted_fraud int, fraud_score double")
    got = {r["metric"]: r["value"] for r in model.evaluate(df).collect()}
    assert got["accuracy"] == 1.0 and got["fraud_recall"] == 0.0 and got["auc_roc"] is None
    row_ = monitoring.detection_metrics(df).first()
    assert (row_["precision"], row_["recall"], row_["f1"], row_["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_reports_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "is_fraud int, predicted_fraud int, fraud_score double, amount double")
    kpi = monitoring.kpi_summary(empty).first()
    assert (kpi["total_transactions"], kpi["fraud_rate_pct"], kpi["avg_fraud_score"]) == (0, 0.0, 0.0)
    assert [r["transactions"] for r in monitoring.alert_funnel(empty).orderBy("stage_no").collect()] == [0] * 5


def test_fraud_column_falls_back_to_the_label(spark):
    df = spark.createDataFrame([(1, 10.0, 80.0), (0, 20.0, 0.0)], "is_fraud int, amount double, fraud_score double")
    kpi = monitoring.kpi_summary(df).first()
    assert (kpi["frauds_detected"], kpi["fraud_amount"], kpi["fraud_rate_pct"]) == (1, 10.0, 50.0)
    both = df.withColumn("predicted_fraud", F.lit(1))
    assert monitoring.kpi_summary(both, "is_fraud").first()["frauds_detected"] == 1
    assert monitoring.kpi_summary(both).first()["frauds_detected"] == 2


def test_percent_and_ratio(predictions):
    ratio, percent = monitoring.detection_metrics(predictions).first(), monitoring.detection_metrics(predictions, "percent").first()
    for name in ("accuracy", "precision", "recall", "f1"):
        assert percent[name] == pytest.approx(100 * ratio[name])


@pytest.mark.parametrize("score, bin_", [(0.0, 1), (4.99, 1), (5.0, 2), (99.9, 20), (100.0, 20), (130.0, 20)])
def test_histogram_edges(spark, score, bin_):
    df = spark.createDataFrame([(score,), (None,)], "fraud_score double")
    assert as_rows(monitoring.score_histogram(df), "bin", "transactions") == [(bin_, 1)]


def test_funnel_never_grows(spark):
    # One high score, but three alerts: later stages are held down to one.
    rows = [(1, 1, 75.0), (1, 1, 55.0), (0, 1, 55.0), (0, 0, 0.0)]
    df = spark.createDataFrame(rows, "is_fraud int, predicted_fraud int, fraud_score double")
    got = monitoring.alert_funnel(df).orderBy("stage_no")
    assert [(r["stage"], r["transactions"], r["step_pct"]) for r in got.collect()] == [
        ("transactions", 4, None), ("high_scores", 1, 25.0), ("alerts", 1, 100.0), ("confirmed", 1, 100.0), ("actions", 1, 100.0),
    ]


def test_moving_average_uses_present_days(spark):
    rows = [row(i, "U", d * 86400, is_fraud=1) for i, d in enumerate([0, 0, 1, 5, 5, 5, 9])]
    got = monitoring.daily_trend(table(spark, rows))
    assert as_rows(got, "frauds", "moving_avg") == sorted([(2, 2.0), (1, 1.5), (3, 2.0), (1, 5 / 3)])


def test_heatmap_is_dense(spark):
    # 1 March 2024 is a Friday.
    got = monitoring.day_hour_heatmap(table(spark, [row(1, "U", 0, is_fraud=1), row(2, "U", 5, is_fraud=1)]))
    assert got.count() == 168
    assert as_rows(got.filter("frauds > 0"), "day", "hour", "frauds") == [(4, 12, 2)]


def test_edges_need_more_than_five_frauds(spark):
    rows = [row(i, f"U{i % 2}", i, merchant_id=f"MERCHANT_100{i % 3}", is_fraud=1) for i in range(5)]
    assert investigation.fraud_edges(table(spark, rows), more_than=5).count() == 0
    rows.append(row(9, "U1", 9, merchant_id="MERCHANT_1000", is_fraud=1))
    assert investigation.fraud_edges(table(spark, rows), users=10, merchants=8, more_than=5).count() > 0
    edges = investigation.fraud_edges(table(spark, rows))
    assert edges.agg(F.sum("weight")).first()[0] == 6
    degrees = investigation.node_degrees(edges)
    assert degrees.filter("kind = 'merchant'").count() == 3
    assert degrees.agg(F.sum("weighted_degree")).first()[0] == 12


def test_geo_anomaly_limits(spark):
    rows = []
    for u in range(3):
        for i in range(4):
            rows.append(row(10 * u + i, f"U{u}", 3600 * i, location_lat=20.0 * (i % 2), is_fraud=int(u != 1)))
    df = table(spark, rows)
    every = investigation.geo_anomalies(df)
    assert as_rows(every, "user_id", "transaction_id") == [
        (f"U{u}", f"T{10 * u + i:05d}") for u in (0, 2) for i in (1, 2, 3)
    ]
    assert every.first()["speed_kmh"] == pytest.approx(2220.0)
    assert {r.user_id for r in investigation.geo_anomalies(df, max_users=1).collect()} == {"U0"}
    assert investigation.geo_anomalies(df, max_users=1, max_rows_per_user=2).count() == 1


def test_api_pages_cover_everything_once(spark, tx):
    shown = tx.select("transaction_id", "timestamp", "amount")
    last, seen = None, []
    while page := investigation.api_extract(shown, last, 300).collect():
        seen += [r.transaction_id for r in page]
        last = page[-1].transaction_id
    assert len(seen) == len(set(seen)) == tx.count()
    assert '"timestamp":"2024-01-01 00:09:58.778549"' in investigation.api_extract(shown, None, 1).first().payload


def test_split_does_not_depend_on_partitioning(tx):
    first = model.split(tx)[0].select("transaction_id")
    other = model.split(tx.repartition(7, "amount"))[0].select("transaction_id")
    assert first.exceptAll(other).isEmpty() and other.exceptAll(first).isEmpty()
    train, test = model.split(tx, (0.5, 0.1))
    assert train.count() + test.count() == tx.count()
    assert train.count() / tx.count() == pytest.approx(0.833, abs=0.04)
    assert sum(p.count() for p in model.split(tx, by_hash=False)) == tx.count()


@pytest.fixture(scope="module")
def forest(tx):
    return model.train_forest(tx, numTrees=5, maxDepth=4)


def test_model_scores(spark, tx, forest, tmp_path):
    scored = score_model(tx, forest)
    assert scored.count() == tx.count()
    bad = scored.filter(
        (F.col("fraud_score") != F.col("fraud_probability") * 100)
        | ~F.col("fraud_probability").between(0, 1)
        | (F.col("risk_level") != risk_level(F.col("fraud_probability") * 100))
        | ((F.col("fraud_probability") > 0.5) != (F.col("predicted_fraud") == 1))
    )
    assert bad.isEmpty()
    own = forest.transform(assemble(model_features(tx), label=None))
    own = own.select("transaction_id", F.col("prediction").cast("int"), F.get(vector_to_array("probability"), F.lit(1)))
    ours = scored.select("transaction_id", "predicted_fraud", "fraud_probability")
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, ours.collect()))
    model.save_model(forest, str(tmp_path / "m"))
    model.save_model(forest, str(tmp_path / "m"))  # saving again overwrites
    again = score_model(tx, model.load_model(str(tmp_path / "m")))
    columns = ["transaction_id", "fraud_probability"]
    assert as_rows(scored, *columns) == as_rows(again, *columns)


def test_importance_and_metadata(spark, forest, tmp_path):
    rows = model.feature_importance(spark, forest).collect()
    assert {r.feature for r in rows} == set(MODEL_FEATURES)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert model.feature_importance(spark, forest, 5).count() == 5
    row_ = model.model_metadata(spark, forest, {"accuracy": 0.5}, 80, 20)
    model.save_metadata(row_, str(tmp_path / "meta"))
    back = spark.read.schema(row_.schema).json(str(tmp_path / "meta")).first()
    assert (back.num_trees, back.max_depth, back.training_samples) == (5, 4, 80)
    assert back.feature_importance[0].feature == rows[0].feature


def test_recent_alerts_are_newest_first(spark):
    rows = [row(i, "U", i // 2, amount=5000.0, timestamp=BASE.replace(hour=3) + dt.timedelta(seconds=i // 2)) for i in range(40)]
    got = investigation.recent_alerts(score_rules(table(spark, rows)))
    ids = [r.transaction_id for r in got.collect()]
    assert ids[:3] == ["T00038", "T00039", "T00036"] and len(ids) == 15
