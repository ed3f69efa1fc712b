"""No row is lost to nulls, and results do not depend on the machine."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import history, model, scoring
from ledgerlens.schema import MODEL_FEATURES


@pytest.fixture(scope="module")
def holed(tx):
    """Nulls in coordinates, amounts and times of some rows each."""
    n = F.conv(F.substring(F.md5("transaction_id"), 1, 4), 16, 10).cast("int") % 10
    holes = {"location_lat": 1, "amount": 2, "timestamp": 3, "is_online": 4}
    return tx.withColumns({c: F.when(n != k, F.col(c)) for c, k in holes.items()})


def test_model_scores_every_row(spark, tx, holed):
    forest = model.train_forest(tx, numTrees=3, maxDepth=3)
    got = scoring.model_output(holed, forest)
    assert got.count() == tx.count()
    missing = got.join(holed.filter("amount IS NULL").select("transaction_id"), "transaction_id", "left_semi")
    assert missing.count() > 0 and missing.filter("fraud_score <> 0 OR predicted_fraud <> 0").count() == 0


def test_user_windows_keep_rows_without_a_time(tx, holed):
    assert history.user_window_features(holed).count() == tx.count()


@pytest.mark.parametrize("weights, least, most", [((1.0, 0.0), 1.0, 1.0), ((0.0, 1.0), 0.0, 0.0), ((0.5, 0.1), 0.78, 0.88)])
def test_split_shares(tx, weights, least, most):
    train, test = model.split(tx, weights)
    assert train.count() + test.count() == tx.count()
    assert least <= train.count() / tx.count() <= most


def test_forest_does_not_depend_on_pieces_and_learns(tx):
    label = F.when((F.col("amount") > 400) & F.col("is_online"), 1).otherwise(0)
    learnable = tx.withColumn("is_fraud", label)
    forests = [model.train_forest(learnable.repartition(n), numTrees=5, maxDepth=5) for n in (2, 8)]
    first, second = (f.featureImportances.toArray() for f in forests)
    assert len(first) == len(MODEL_FEATURES) and (first == second).all()
    scored = scoring.model_output(learnable, forests[0]).filter("is_fraud = 1")
    assert scored.agg(F.avg("predicted_fraud")).first()[0] > 0.8
