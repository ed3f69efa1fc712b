"""Streams against their batch twins, restart, late rows, limits, lifecycle."""

import time

import pytest
from data import as_rows, bursts, row, table
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerlens.operators import history, scoring
from ledgerlens.schema import CONSOLE_OUTPUT
from ledgerlens.session import LARGE_STATE_CONF, use_large_state
from ledgerlens.sinks import stream as sinks
from ledgerlens.sinks.batch import encode_messages
from ledgerlens.sources import messages
from ledgerlens.streaming import behaviour, lifecycle, windows


def write_parts(df, path: str, parts: int, column: str = "timestamp") -> None:
    """Time-ordered files, written one after the other."""
    ordered = [r[column] for r in df.select(column).orderBy(column).collect()]
    bounds = [ordered[len(ordered) * i // parts] for i in range(1, parts)]
    low = None
    for high in [*bounds, None]:
        piece = df
        if low is not None:
            piece = piece.filter(F.col(column) >= low)
        if high is not None:
            piece = piece.filter(F.col(column) < high)
        piece.coalesce(1).write.mode("append").parquet(path)
        low = high
        time.sleep(0.05)


def opened(spark, path: str, schema, per_trigger: int = 1):
    return messages.read_stream(spark, "parquet", schema=schema, max_per_trigger=per_trigger, path=path)


def drained(stream, tmp_path, name: str = "out"):
    query = sinks.to_parquet(stream, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"), trigger=None)
    lifecycle.drain(query, 300)
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name)), query


def test_rule_stream_equals_batch_and_respects_the_limit(spark, tx, tmp_path):
    encoded = encode_messages(tx).withColumn("n", F.monotonically_increasing_id())
    write_parts(encoded, str(tmp_path / "in"), 4, "n")
    stream = opened(spark, str(tmp_path / "in"), encoded.schema)
    valid, _ = messages.split_valid(stream)
    got, query = drained(scoring.rule_output(valid), tmp_path)
    expected = scoring.rule_output(tx)
    assert got.count() == tx.count()
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    assert lifecycle.input_rows_per_batch(query) == [250, 250, 250, 250]


@pytest.mark.parametrize("seed", [11, 12])
def test_behaviour_stream_equals_batch_over_many_batches(spark, tmp_path, seed):
    df = table(spark, bursts(250, seed))
    write_parts(df, str(tmp_path / "in"), 6)
    # One last row far ahead closes everything before it.
    table(spark, [row(99_999, "U9", 900_000)]).write.mode("append").parquet(str(tmp_path / "in"))
    stream = behaviour.behaviour_stream(opened(spark, str(tmp_path / "in"), df.schema), "30 seconds")
    got, query = drained(stream, tmp_path)
    columns = [
        "transaction_id", "prev_timestamp", "prev_device", "txn_count_5min", "time_since_last_txn",
        "is_rapid_transaction", "is_impossible_travel", "device_changed",
    ]
    batch = history.behaviour_features(df)
    assert got.count() == df.count() and lifecycle.late_rows(query) == 0
    assert got.select(columns).exceptAll(batch.select(columns)).isEmpty()
    distances = got.join(batch.select("transaction_id", F.col("distance_from_prev").alias("d")), "transaction_id")
    assert distances.filter(F.abs(F.col("distance_from_prev") - F.col("d")) > 1e-9).isEmpty()


def test_behaviour_stream_orders_rows_that_arrive_swapped(spark, tmp_path, state_store):
    path = str(tmp_path / "in")
    first = [row(1, "U", 0), row(3, "U", 40, device_id="D2")]
    second = [row(2, "U", 20, device_id="D3"), row(4, "U", 70)]
    for rows in (first, second, [row(9, "V", 5000)]):
        table(spark, rows).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    df = table(spark, first + second)
    got, _ = drained(behaviour.behaviour_stream(opened(spark, path, df.schema), "1 minute"), tmp_path)
    columns = ("transaction_id", "time_since_last_txn", "prev_device", "txn_count_5min")
    assert as_rows(got, *columns) == as_rows(history.behaviour_features(df), *columns)


def test_behaviour_scores_on_a_stream(spark, tmp_path):
    df = table(spark, bursts(150, 21))
    write_parts(df, str(tmp_path / "in"), 3)
    table(spark, [row(99_999, "U9", 900_000)]).write.mode("append").parquet(str(tmp_path / "in"))
    got, _ = drained(behaviour.score_behaviour_stream(opened(spark, str(tmp_path / "in"), df.schema), "1 minute"), tmp_path)
    expected = scoring.behaviour_output(df)
    assert got.columns == expected.columns
    columns = ("transaction_id", "fraud_score", "risk_level", "true_positive")
    assert as_rows(got, *columns) == as_rows(expected, *columns)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    path = str(tmp_path / "in")
    batches = [[row(1, "U", 0), row(2, "U", 7200)], [row(3, "U", 7300)], [row(4, "U", 10), row(5, "U", 20_000)]]
    for rows in batches:
        table(spark, rows).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    stream = windows.user_windows(opened(spark, path, table(spark, batches[0]).schema), "1 hour", "10 minutes")
    got, query = drained(stream, tmp_path)
    assert lifecycle.late_rows(query) == 1
    # The late row is missing from the first window; the window still open at the end is not emitted.
    assert [r.txn_count_window for r in got.orderBy("window_start").collect()] == [1, 2]


@pytest.fixture(params=["heap", "rocksdb"])
def state_store(spark, request):
    if request.param == "rocksdb":
        use_large_state(spark)
    yield request.param
    for key in LARGE_STATE_CONF:
        spark.conf.unset(key)


def test_duplicates_across_batches(spark, tmp_path, state_store):
    path = str(tmp_path / "in")
    for rows in ([row(1, "U", 0), row(2, "U", 5)], [row(2, "U", 5), row(3, "U", 9)], [row(1, "U", 0)]):
        table(spark, rows).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    got, _ = drained(windows.deduplicate(opened(spark, path, table(spark, rows).schema)), tmp_path)
    assert as_rows(got, "transaction_id") == [("T00001",), ("T00002",), ("T00003",)]


def test_restart_continues_where_it_stopped(spark, tx, tmp_path):
    path = str(tmp_path / "in")
    write_parts(tx, path, 2)
    stream = scoring.rule_output(opened(spark, path, tx.schema))
    drained(stream, tmp_path)
    later = tx.withColumn("transaction_id", F.concat(F.lit("X"), "transaction_id"))
    later.write.mode("append").parquet(path)
    got, _ = drained(stream, tmp_path)
    again, query = drained(stream, tmp_path)
    assert got.count() == 2 * tx.count() == again.select("transaction_id").distinct().count()
    assert lifecycle.input_rows_per_batch(query) == []


def test_live_kpis_in_update_and_complete_mode(spark, tx, tmp_path):
    path = str(tmp_path / "in")
    write_parts(tx, path, 3)
    kpis = windows.live_kpis(scoring.score_rules(opened(spark, path, tx.schema)), "1 day")
    lifecycle.drain(sinks.to_memory(kpis, "kpi_complete", "complete", trigger=None), 300)
    assert spark.table("kpi_complete").agg(F.sum("total")).first()[0] == tx.count()
    lifecycle.drain(sinks.to_memory(kpis, "kpi_update", "update", trigger=None), 300)
    newest = spark.table("kpi_update").groupBy("bucket").agg(F.max("total").alias("n"))
    assert newest.agg(F.sum("n")).first()[0] == tx.count()


def test_memory_sink_in_append_mode(spark, tx, tmp_path):
    path = str(tmp_path / "in")
    write_parts(tx, path, 2)
    stream = scoring.rule_output(opened(spark, path, tx.schema))
    lifecycle.drain(sinks.to_memory(stream, "memory_rows", trigger=None), 300)
    lifecycle.drain(sinks.to_memory(stream, "memory_rows", trigger=None), 300)  # a restart begins anew
    assert spark.table("memory_rows").count() == tx.count()
    with pytest.raises(ValueError):
        sinks.to_memory(stream, "memory_rows", checkpoint=str(tmp_path / "c"))


def test_console_sink(spark, tx, tmp_path):
    # The JVM prints past pytest's capture, so the progress report is checked instead.
    path = str(tmp_path / "in")
    tx.limit(3).coalesce(1).write.parquet(path)
    query = sinks.to_console(scoring.rule_output(opened(spark, path, tx.schema)), trigger=None)
    lifecycle.drain(query, 300)
    assert "Console" in query.lastProgress["sink"]["description"]
    assert lifecycle.input_rows_per_batch(query) == [3]
    plan = query._jsq.explainInternal(False)
    assert all(c in plan for c in CONSOLE_OUTPUT) and "true_positive" not in plan


def test_fan_out_replaces_a_repeated_batch(spark, tx, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_parts(tx, path, 3)
    stream = scoring.rule_output(opened(spark, path, tx.schema))
    lifecycle.drain(sinks.fan_out(stream, out, str(tmp_path / "c1"), view="fan", console_rows=1, trigger=None), 300)
    assert spark.table("global_temp.fan").count() == tx.count()
    # A fresh checkpoint repeats the same batches, as after a failure between write and commit.
    lifecycle.drain(sinks.fan_out(stream, out, str(tmp_path / "c2"), view="fan", trigger=None), 300)
    assert spark.table("global_temp.fan").count() == tx.count()
    assert spark.table("global_temp.fan").select("batch").distinct().count() == 3


@pytest.mark.parametrize("mode", ["console", "parquet", "memory", "all"])
def test_modes_run_with_a_processing_time_trigger(spark, tx, tmp_path, mode):
    path = str(tmp_path / "in")
    tx.limit(20).coalesce(1).write.parquet(path)
    stream = scoring.rule_output(opened(spark, path, tx.schema))
    query = sinks.write_mode(stream, mode, str(tmp_path / "out"), str(tmp_path / "c"), f"mode_{mode}", "1 second")
    try:
        query.processAllAvailable()
        if mode in ("parquet", "all"):
            assert spark.read.parquet(str(tmp_path / "out")).count() == 20
        if mode == "memory":
            assert spark.table("mode_memory").count() == 20
    finally:
        lifecycle.stop_all([query])
    assert not query.isActive


def test_unknown_mode(spark, tx, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_mode(tx, "printer", "", "", "t")


def test_a_failing_query_stops_the_others(spark, tx, tmp_path):
    path = str(tmp_path / "in")
    tx.limit(5).coalesce(1).write.parquet(path)
    stream = opened(spark, path, tx.schema)
    fine = sinks.to_parquet(stream, str(tmp_path / "a"), str(tmp_path / "ca"), trigger="1 second")
    broken_rows = stream.withColumn("x", F.raise_error(F.lit("broken on purpose")))
    broken = sinks.to_parquet(broken_rows, str(tmp_path / "b"), str(tmp_path / "cb"), trigger="1 second")
    with pytest.raises(StreamingQueryException, match="broken on purpose"):
        lifecycle.run_until_stopped([fine, broken], poll_seconds=0.5)
    assert not fine.isActive and not broken.isActive


def test_a_query_that_does_not_end_is_stopped(spark, tx, tmp_path):
    path = str(tmp_path / "in")
    tx.limit(5).coalesce(1).write.parquet(path)
    query = sinks.to_parquet(opened(spark, path, tx.schema), str(tmp_path / "a"), str(tmp_path / "c"), trigger="1 second")
    with pytest.raises(TimeoutError):
        lifecycle.drain(query, 2)
    assert not query.isActive


def test_model_stream_equals_batch(spark, tx, tmp_path):
    from ledgerlens.operators.model import train_forest

    forest = train_forest(tx, numTrees=3, maxDepth=3)
    path = str(tmp_path / "in")
    write_parts(tx, path, 3)
    got, _ = drained(scoring.model_output(opened(spark, path, tx.schema), forest), tmp_path)
    columns = ("transaction_id", "predicted_fraud", "fraud_probability", "risk_level")
    assert as_rows(got, *columns) == as_rows(scoring.model_output(tx, forest), *columns)
