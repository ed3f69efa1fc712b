"""History windows, hot users and patterns against brute force."""

import pytest
from data import as_rows, brute_force, bursts, row, table
from pyspark.sql import functions as F

from ledgerlens.operators import history, patterns, scoring
from ledgerlens.operators.slices import DEFAULT_POLICY, HotPolicy, hot_users, with_slices

POLICIES = {
    "plain": None,
    "default": DEFAULT_POLICY,
    "one_second_slices": HotPolicy(min_rows=30, max_hot=1000, slice_rows=1, min_width=1),
    "narrow_slices": HotPolicy(min_rows=30, max_hot=1000, slice_rows=3, min_width=7),
    "minute_slices": HotPolicy(min_rows=100, max_hot=1000, slice_rows=1, min_width=60),
    "wide_slices": HotPolicy(min_rows=30, max_hot=1000, slice_rows=10_000, min_width=1),
    "sampled": HotPolicy(min_rows=30, max_hot=1000, slice_rows=2, min_width=20, sample_rows=150),
}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("policy", POLICIES.values(), ids=POLICIES.keys())
def test_previous_and_counts_match_brute_force(spark, policy, seed):
    rows = bursts(320, seed)
    got = history.with_previous(
        table(spark, rows), ["prev_timestamp", "prev_device", "prev_lat", "prev_lon"], {"count": 300}, policy
    )
    expected = brute_force(rows)
    actual = got.select(*expected.columns).toPandas().sort_values("transaction_id").reset_index(drop=True)
    assert len(actual) == len(rows)
    for column in expected.columns:
        same = (actual[column] == expected[column]) | (actual[column].isna() & expected[column].isna())
        assert same.all(), column


def test_hot_users_are_found_and_cut(spark):
    df = table(spark, bursts(400, 3))
    policy = HotPolicy(min_rows=150, max_hot=1000, slice_rows=10, min_width=5)
    hot = hot_users(df, policy)
    assert [r.user_id for r in hot.collect()] == ["U0"]
    sizes = with_slices(df, [], 300, policy).filter("not is_carry").groupBy("user_id", "slice").count()
    by_user = {r.user_id: r["max(count)"] for r in sizes.groupBy("user_id").agg(F.max("count")).collect()}
    whole = df.filter("user_id = 'U0'").count()
    assert by_user["U0"] < whole / 3
    assert sizes.filter("user_id != 'U0'").select("slice").distinct().collect()[0].slice == 0


def test_small_tables_have_no_hot_user(spark):
    assert hot_users(table(spark, bursts(50, 1))) is None
    # Above the row limit, but no user stands out.
    even = table(spark, [row(i, f"U{i % 50}", i) for i in range(200)])
    assert hot_users(even, HotPolicy(min_rows=20, max_hot=100)) is None


def test_first_transaction_and_ties(spark):
    rows = [
        row(2, "U", 0, device_id="D2"),
        row(1, "U", 0, device_id="D1"),
        row(3, "U", 59, device_id="D2", location_lat=1.0),
        row(4, "U", 119, device_id="D2", location_lat=1.0),
        row(5, "V", 10),
    ]
    got = history.behaviour_features(table(spark, rows))
    assert as_rows(
        got, "transaction_id", "time_since_last_txn", "is_rapid_transaction", "txn_count_5min",
        "is_impossible_travel", "device_changed",
    ) == [
        ("T00001", 999999, 0, 2, 0, 0),
        ("T00002", 0, 1, 2, 0, 1),
        ("T00003", 59, 1, 3, 1, 0),
        ("T00004", 60, 0, 4, 0, 0),
        ("T00005", 999999, 0, 1, 0, 0),
    ]


def test_burst_rule_fires_above_three(spark):
    rows = [row(i, "U", i * 70) for i in range(5)]
    scored = scoring.score_behaviour(table(spark, rows))
    assert as_rows(scored, "transaction_id", "txn_count_5min", "fraud_score") == [
        ("T00000", 1, 0.0), ("T00001", 2, 0.0), ("T00002", 3, 0.0), ("T00003", 4, 20.0), ("T00004", 5, 20.0),
    ]


def test_window_edges_of_the_five_minute_count(spark):
    got = history.velocity_features(table(spark, [row(1, "U", 0), row(2, "U", 300), row(3, "U", 601)]))
    assert as_rows(got, "transaction_id", "txn_count_5min") == [("T00001", 1), ("T00002", 2), ("T00003", 1)]


def test_user_window_join_keeps_one_row_per_transaction(spark):
    rows = [row(1, "U", 0, amount=10.0), row(2, "U", 60, amount=30.0), row(3, "U", 7200, amount=5.0)]
    got = history.user_window_features(table(spark, rows))
    assert as_rows(got, "transaction_id", "txn_count_window", "avg_amount_window", "total_amount_window") == [
        ("T00001", 2, 20.0, 40.0), ("T00002", 2, 20.0, 40.0), ("T00003", 1, 5.0, 5.0),
    ]
    assert got.filter("transaction_id = 'T00003'").first().std_amount_window == 0.0


@pytest.mark.parametrize("policy", [None, HotPolicy(3, 1000, 1, 1)])
def test_rapid_succession(spark, policy):
    rows = [row(i, "U", s) for i, s in enumerate([0, 10, 20, 30, 60, 61, 500])] + [row(9, "V", 0)]
    got = patterns.rapid_succession(table(spark, rows), policy=policy)
    # 60 s is still inside the window of the first, 61 s is not (but 10..61 is five again).
    assert as_rows(got, "transaction_id", "burst_count") == [("T00004", 5), ("T00005", 5)]


def test_geographic_jump_edges(spark):
    far = 500 / 111
    rows = [
        row(1, "U", 0), row(2, "U", 1800, location_lat=far + 1e-9), row(3, "U", 3601),
        row(4, "V", 0), row(5, "V", 60, location_lat=far - 0.01),
    ]
    assert as_rows(patterns.geographic_jump(table(spark, rows)), "transaction_id") == [("T00002",)]


def test_new_device_skips_the_first_device(spark):
    rows = [
        row(1, "U", 0, amount=900.0, device_id="D1"),
        row(2, "U", 10, amount=250.0, device_id="D2"),
        row(3, "U", 20, amount=250.0, device_id="D2"),
        row(4, "U", 30, amount=199.0, device_id="D3"),
        row(5, "U", 40, amount=900.0, device_id="D3"),
        row(6, "V", 0, amount=900.0, device_id="D2"),
    ]
    assert as_rows(patterns.new_device(table(spark, rows)), "transaction_id") == [("T00002",)]


def test_pattern_hits_are_the_single_detectors(spark):
    df = table(spark, bursts(300, 5))
    hits = patterns.pattern_hits(df)
    single = {
        "high_amount": patterns.high_amount(df),
        "rapid_succession": patterns.rapid_succession(df),
        "geographic_impossible": patterns.geographic_jump(df),
        "unusual_time": patterns.unusual_time(df),
        "new_device": patterns.new_device(df),
    }
    for name, expected in single.items():
        assert as_rows(hits.filter(F.col("pattern") == name), "transaction_id") == as_rows(expected, "transaction_id")
    assert hits.filter("pattern = 'rapid_succession'").count() > 0
