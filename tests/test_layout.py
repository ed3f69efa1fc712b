"""Bucketed history: the same features without a shuffle, hot users in pieces."""

import pytest
from data import as_rows, bursts, table

from ledgerlens.operators import history
from ledgerlens.operators.slices import HotPolicy
from ledgerlens.sinks import layout

HOT = HotPolicy(min_rows=20, max_hot=50, slice_rows=10, min_width=7)
FEATURES = {
    history.velocity_features: ("prev_timestamp", "time_since_last_txn", "is_rapid_transaction", "txn_count_5min"),
    history.location_features: ("prev_lat", "prev_lon", "distance_from_prev", "is_impossible_travel"),
    history.device_features: ("prev_device", "device_changed"),
    history.behaviour_features: ("txn_count_5min", "distance_from_prev", "device_changed", "is_unusual_hour"),
}


@pytest.mark.parametrize("policy", [None, HOT])
def test_layout_gives_the_same_features_without_exchange_or_sort(spark, tmp_path, policy):
    df = table(spark, bursts(400, 9))
    name = f"layout_{'hot' if policy else 'plain'}"
    layout.write_layout(df, name, str(tmp_path / "files"), buckets=5, policy=policy)
    assert len(list((tmp_path / "files").glob("*.parquet"))) <= 5
    try:
        stored = layout.load_layout(spark, name)
        for feature, columns in FEATURES.items():
            got = feature(stored)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Sort [" not in plan, feature.__name__
            assert as_rows(got, "transaction_id", *columns) == as_rows(feature(df, policy), "transaction_id", *columns)
        if policy:
            hot = stored.filter("user_id = 'U0'").select("place").distinct().count()
            assert hot > 1
    finally:
        spark.conf.unset(layout.ORDERED_SCAN)
        spark.sql(f"DROP TABLE {name}")
