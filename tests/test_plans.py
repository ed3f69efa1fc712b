"""The physical plans keep the properties the operators promise."""

import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from ledgerlens.operators import history, investigation, monitoring, scoring
from ledgerlens.operators.slices import HotPolicy
from ledgerlens.plans import QUERIES
from ledgerlens.sources.events import transactions
from ledgerlens.sources.tables import enrich_merchant


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Transactions as plain columns of a Parquet table."""
    path = str(tmp_path_factory.mktemp("stored") / "tx")
    transactions(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def read_columns(df) -> set[str]:
    return {
        c.split(":")[0]
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))
        for c in schema.split(",")
    }


def test_history_windows_use_one_exchange_and_one_sort(stored):
    for df in (history.behaviour_features(stored), scoring.behaviour_output(stored)):
        assert exchanges(df) == 1 and len(re.findall(r"\bSort \[", plan(df))) == 1


def test_cut_users_still_shuffle_the_table_once(stored):
    df = history.velocity_features(stored, HotPolicy(min_rows=20, max_hot=1000, slice_rows=10))
    text = plan(df)
    # The rows and the carry rows meet below a single exchange by user and slice.
    top = text[text.index("Exchange hashpartitioning") :]
    assert "Union" in top.split("\n")[1] and text.index("Window") < text.index("Union")


def test_row_level_scoring_needs_no_exchange_and_no_python(stored):
    text = plan(scoring.rule_output(stored))
    assert "Exchange" not in text and "Python" not in text and "*(1)" in text


def test_model_scoring_needs_no_python(spark, stored):
    from ledgerlens.plans.inputs import forest

    text = plan(scoring.model_output(stored, forest(spark, SF_DIR)))
    assert "Exchange" not in text and "Python" not in text


def test_columns_and_filters_reach_the_scan(stored):
    assert read_columns(monitoring.frauds(stored).select("amount")) == {"amount", "is_fraud"}
    assert "EqualTo(is_fraud,1)" in plan(monitoring.frauds(stored).select("amount"))
    kpi = monitoring.timeline(stored)
    assert read_columns(kpi) == {"timestamp", "is_fraud"}
    assert read_columns(history.device_features(stored).select("transaction_id", "device_changed")) == {
        "transaction_id", "user_id", "timestamp", "device_id",
    }


def test_small_sides_are_broadcast(stored):
    assert "BroadcastHashJoin" in plan(enrich_merchant(stored)) and exchanges(enrich_merchant(stored)) == 0
    scored = stored.withColumn("fraud_score", F.lit(1.0))
    assert "SortMergeJoin" not in plan(investigation.user_sequences(scored, users=8))
    assert "SortMergeJoin" not in plan(investigation.fraud_edges(scored, users=10, merchants=8))


def test_metrics_run_as_one_aggregate(stored):
    scored = stored.withColumn("predicted_fraud", F.lit(1))
    assert plan(monitoring.detection_metrics(scored)).count("FileScan") == 1


def test_quantiles_scan_the_table_once_or_twice(stored):
    scored = scoring.score_rules(stored)
    assert plan(monitoring.score_box_by_band(scored, method="counted")).count("FileScan") == 1
    assert plan(monitoring.amount_box_by_class(scored)).count("FileScan") == 2


def test_top_lists_do_not_sort_the_table(stored):
    scored = scoring.score_rules(stored)
    assert "TakeOrderedAndProject" in plan(investigation.recent_alerts(scored))
    assert "TakeOrderedAndProject" in plan(investigation.top_suspicious(scored))


def test_no_registered_batch_query_leaves_the_jvm_or_crosses_tables(spark):
    for name, query in QUERIES.items():
        if name.startswith(("stream_", "model_", "feature_importance")):
            continue
        text = plan(query(spark, SF_DIR))
        assert "Python" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
