"""Statistics as of a transaction, and labels that come after the score."""

import datetime as dt
import math

import pytest
from data import BASE, as_rows, bursts, row, table
from pyspark.sql import functions as F
from test_streaming import drained, opened, write_parts

from ledgerlens.operators import asof, labels, scoring
from ledgerlens.operators.slices import HotPolicy
from ledgerlens.sources.events import confirmations_of
from ledgerlens.streaming import lifecycle
from ledgerlens.streaming.labels import outcome_stream

HOT = HotPolicy(min_rows=20, max_hot=50, slice_rows=10, min_width=7)


def plain_asof(rows, seconds):
    """The last closed window of every row, one by one."""
    out = {}
    for r in rows:
        now = r["timestamp"].replace(tzinfo=dt.UTC).timestamp()
        spans = {}
        for o in rows:
            if o["user_id"] == r["user_id"]:
                spans.setdefault(math.floor(o["timestamp"].replace(tzinfo=dt.UTC).timestamp()) // seconds, []).append(o["amount"])
        closed = [s for s in spans if (s + 1) * seconds <= now]
        if closed:
            s = max(closed)
            out[r["transaction_id"]] = (s * seconds, len(spans[s]), round(sum(spans[s]), 6), max(spans[s]))
        else:
            out[r["transaction_id"]] = (None, None, None, None)
    return out


@pytest.mark.parametrize("policy", [None, HOT])
@pytest.mark.parametrize("duration", ["1 hour", "15 minutes"])
def test_asof_equals_plain(spark, policy, duration):
    rows = bursts(300, 5) + [row(900 + i, "U7", 3600 * i - BASE.minute * 60) for i in range(4)]
    got = asof.asof_features(table(spark, rows), duration, policy).collect()
    found = {
        r.transaction_id: (r.asof_window_start and int(r.asof_window_start.replace(tzinfo=dt.UTC).timestamp()), r.asof_txn_count, r.asof_total_amount and round(r.asof_total_amount, 6), r.asof_max_amount)
        for r in got
    }
    assert len(got) == len(rows) and found == plain_asof(rows, asof.window_seconds(duration))


def test_asof_never_reads_the_own_window(spark):
    rows = [row(1, "U", 0, amount=1.0), row(2, "U", 10, amount=1e6), row(3, "U", 3600, amount=5.0)]
    got = {r.transaction_id: r.asof_max_amount for r in asof.asof_features(table(spark, rows)).collect()}
    assert got == {"T00001": None, "T00002": None, "T00003": 1e6}


def test_asof_keeps_rows_without_user_or_time(spark):
    df = table(spark, [row(1, "U", 0), row(2, "U", 4000)]).withColumn("timestamp", F.when(F.col("transaction_id") != "T00002", F.col("timestamp")))
    df = df.unionByName(table(spark, [row(3, "U", 9000)]).withColumn("user_id", F.lit(None).cast("string")))
    got = asof.asof_features(df).collect()
    assert len(got) == 3 and all(r.asof_txn_count is None for r in got)
    assert asof.asof_features(df.limit(0)).collect() == []


def test_asof_shuffles_once(spark, tx):
    plan = asof.asof_features(tx, policy=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_batch_takes_the_first_confirmation_in_time(spark):
    tx = scoring.score_rules(table(spark, [row(i, "U", 60 * i) for i in range(6)]))
    said = [(1, 0, 50), (1, 1, 20), (2, 0, 5), (3, 1, 200), (4, 1, -5), (5, 0, 9), (5, 1, 9)]
    told = spark.createDataFrame([(f"T{i:05d}", label, BASE + dt.timedelta(seconds=60 * i, hours=h)) for i, label, h in said], "transaction_id string, label int, confirmed_at timestamp")
    got = {r.transaction_id: r.outcome for r in labels.confirmed_outcomes(tx, told).collect()}
    assert got == {"T00000": "unconfirmed", "T00001": "confirmed", "T00002": "refuted", "T00003": "unconfirmed", "T00004": "unconfirmed", "T00005": "confirmed"}


def parts(spark, tx, tmp_path):
    write_parts(tx, str(tmp_path / "tx"), 6)
    said = confirmations_of(tx)
    write_parts(said, str(tmp_path / "said"), 6, "confirmed_at")
    # One row far ahead on either side closes every horizon.
    far = tx.limit(1).withColumn("timestamp", F.expr("timestamp + INTERVAL 400 DAYS")).withColumn("transaction_id", F.lit("TRX_999999999999"))
    far.write.mode("append").parquet(str(tmp_path / "tx"))
    far.select("transaction_id", F.lit(0).alias("label"), F.col("timestamp").alias("confirmed_at")).write.mode("append").parquet(str(tmp_path / "said"))
    return said


def stream(spark, tx, said, tmp_path):
    scored = scoring.score_rules(opened(spark, str(tmp_path / "tx"), tx.schema))
    return outcome_stream(scored, opened(spark, str(tmp_path / "said"), said.schema)).select("transaction_id", "outcome", "confirmed_at", "true_positive")


def test_stream_of_outcomes_equals_batch_and_lets_state_go(spark, tx, tmp_path):
    said = parts(spark, tx, tmp_path)
    got, query = drained(stream(spark, tx, said, tmp_path), tmp_path)
    expected = labels.confirmed_outcomes(scoring.score_rules(tx), said).select(got.columns)
    rest = got.filter("transaction_id <> 'TRX_999999999999'")
    assert as_rows(rest, *got.columns) == as_rows(expected, *got.columns)
    states = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress]
    assert max(states) > 100 and states[-1] <= 4 and lifecycle.late_rows(query) == 0
    assert {r.outcome for r in got.select("outcome").distinct().collect()} == {"confirmed", "refuted", "unconfirmed"}


def test_stream_of_outcomes_goes_on_after_a_restart(spark, tx, tmp_path):
    whole = tmp_path / "whole"
    whole.mkdir()
    said = parts(spark, tx, whole)
    for folder in ("tx", "said"):
        (tmp_path / folder).mkdir()
    files = {f: sorted((whole / f).glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns) for f in ("tx", "said")}
    for piece in (slice(0, 3), slice(3, None)):
        for folder, listed in files.items():
            for number, file in enumerate(listed[piece]):
                (tmp_path / folder / f"{piece.start}-{number}-{file.name}").write_bytes(file.read_bytes())
        got, _ = drained(stream(spark, tx, said, tmp_path), tmp_path)
    expected = labels.confirmed_outcomes(scoring.score_rules(tx), said).select(got.columns)
    assert as_rows(got.filter("transaction_id <> 'TRX_999999999999'"), *got.columns) == as_rows(expected, *got.columns)
