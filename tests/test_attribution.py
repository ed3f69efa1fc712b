"""Contributions against a walk of each tree, row by row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import attribution
from ledgerlens.operators.model import split, train_forest
from ledgerlens.schema import MODEL_FEATURES


@pytest.fixture(scope="module")
def forest(tx):
    return train_forest(split(tx)[0], numTrees=4, maxDepth=4)


def walked(nodes, values):
    """Contributions of one row, tree by tree."""
    out, trees = [0.0] * len(values), nodes["tree"].unique()
    for tree in trees:
        table = {r.id: r for r in nodes[nodes["tree"] == tree].itertuples()}
        at = table[0]
        while at.left >= 0:
            to = table[at.left if values[at.feature] <= at.threshold else at.right]
            out[at.feature] += (to.chance - at.chance) / len(trees)
            at = to
    return out


def test_contributions_add_up_for_every_row(spark, tx, forest):
    nodes = attribution.node_table(forest, spark)
    rows = attribution.explain(tx, forest).collect()
    assert len(rows) == tx.count()
    for n, r in enumerate(rows):
        assert abs(r.base + sum(r.contributions) - r.fraud_probability) < 1e-9
        if n < 150:
            assert np.allclose(r.contributions, walked(nodes, [float(r[c]) for c in MODEL_FEATURES]), atol=1e-12)
        raising = sorted((c for c in r.contributions if c > 0), reverse=True)[:3]
        assert [x.contribution for x in r.reasons] == raising
        assert all(r.contributions[MODEL_FEATURES.index(x.feature)] == x.contribution for x in r.reasons)


def test_rows_without_a_feature_have_no_reasons(tx, forest):
    holed = tx.limit(6).withColumn("location_lat", F.when(F.col("transaction_id") > "TRX_000000000002", F.col("location_lat")))
    rows = attribution.explain(holed, forest).collect()
    assert len(rows) == 6
    for r in rows:
        assert (r.contributions is None) == (r.location_lat is None)
        assert r.location_lat is not None or r.fraud_probability == 0.0
    assert attribution.explain(tx.limit(0), forest).collect() == []


def test_no_row_at_a_time_python(tx, forest):
    plan = attribution.explain(tx, forest)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan and "Exchange" not in plan
