"""Decoding, quarantine, partitioned history, scored tables and encoders."""

import json
from pathlib import Path

import pytest
from conftest import SF_DIR
from data import as_rows, bursts, row, table
from pyspark.sql import functions as F

from ledgerlens.schema import MESSAGE_SCHEMA, NARROW_COLUMNS, REQUIRED_COLUMNS, TRANSACTION_COLUMNS
from ledgerlens.session import get_session, work_dir
from ledgerlens.sinks.batch import encode_messages, write_history
from ledgerlens.sources import messages, tables


def message(**changes) -> str:
    fields = {
        "transaction_id": "T1", "user_id": "U1", "timestamp": "2024-03-01T12:00:00.5", "amount": 12.5,
        "merchant_id": "M1", "merchant_category": "hotel", "location_lat": 1.0, "location_lon": 2.0,
        "device_id": "D1", "is_online": True, "is_fraud": 0, "card_last_4": "1234", "cvv_provided": False,
    }
    fields.update(changes)
    return json.dumps({k: v for k, v in fields.items() if v != "drop"})


CASES = [
    (message(), None),
    (message(timestamp="2024-03-01T12:00:00"), None),
    (message(card_last_4=None, cvv_provided="drop"), None),
    (message(amount="drop"), "missing_field"),
    (message(user_id=None), "missing_field"),
    (message(timestamp="yesterday"), "bad_timestamp"),
    (message(timestamp=""), "bad_timestamp"),
    (message(amount="much"), "malformed_json"),
    ("{bad", "malformed_json"),
    (message()[:-4], "malformed_json"),
    ("", "malformed_json"),
    (None, "malformed_json"),
    ("[]", "malformed_json"),
]


@pytest.mark.parametrize("text, reason", CASES, ids=range(len(CASES)))
def test_quarantine_reasons(spark, text, reason):
    df = spark.createDataFrame([(text,)], "value string")
    got = messages.classify_messages(df).first()
    assert got.quarantine_reason == reason and got.raw == text
    valid, broken = messages.split_valid(df)
    assert (valid.count(), broken.count()) == ((1, 0) if reason is None else (0, 1))


def test_binary_values_and_schema(spark):
    df = spark.createDataFrame([(message().encode(),)], "value binary")
    got = messages.parse_messages(df)
    assert got.columns == TRANSACTION_COLUMNS and dict(got.dtypes)["timestamp"] == "timestamp"
    assert got.first().timestamp.microsecond == 500_000
    assert (len(TRANSACTION_COLUMNS), len(NARROW_COLUMNS), len(REQUIRED_COLUMNS)) == (13, 10, 11)


def test_encode_is_the_inverse_of_parse(spark, tx):
    encoded = encode_messages(tx)
    assert encoded.filter(F.col("key") != F.get_json_object("value", "$.user_id")).isEmpty()
    back = messages.parse_messages(encoded)
    assert back.exceptAll(tx.select(*TRANSACTION_COLUMNS)).isEmpty()
    assert set(json.loads(encoded.first().value)) == set(MESSAGE_SCHEMA.fieldNames())


def test_kafka_options(monkeypatch):
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "broker:1")
    monkeypatch.setenv("KAFKA_TOPIC", "payments")
    got = messages.kafka_options(max_per_trigger=10_000, starting_offsets="earliest")
    assert got == {
        "kafka.bootstrap.servers": "broker:1", "subscribe": "payments", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "10000",
    }
    assert messages.kafka_options("a:2", "t")["maxOffsetsPerTrigger"] == "1000"


def test_history_layout_and_pruning(spark, tx, tmp_path):
    months = tx
    for shift in (31, 366):
        months = months.unionByName(tx.withColumn("timestamp", F.expr(f"timestamp + INTERVAL {shift} DAYS")))
    path = str(tmp_path / "history")
    write_history(months, path)
    folders = sorted(str(p.relative_to(path)) for p in Path(path).glob("year=*/month=*"))
    assert folders[:2] == ["year=2024/month=01", "year=2024/month=02"] and folders[-1].startswith("year=2025")
    assert all("snappy" in p.name for p in Path(path).rglob("*.parquet"))

    part = tables.load_history(spark, path, (2024, 2), (2024, 12))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {f.rsplit("/", 2)[1] for f in part.inputFiles()} >= {"month=02"}
    assert all(r.year == 2024 and r.month >= 2 for r in part.select("year", "month").distinct().collect())
    assert tables.load_history(spark, path).count() == 3 * tx.count() == months.count()
    summary = tables.history_summary(tables.load_history(spark, path))
    assert summary.agg(F.sum("row_count")).first()[0] == 3 * tx.count()
    assert tables.scan_partitions(part) >= 1


def test_a_large_month_is_written_by_several_tasks(spark, tx, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    spark.conf.set("spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor", "0.05")
    try:
        many = tx.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(8)))).drop("copy").repartition(8)
        write_history(many, str(tmp_path / "history"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor")
    files = list((tmp_path / "history" / "year=2024" / "month=01").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "history")).count() == 8 * tx.count()


def test_load_scored_passes_over_broken_files(spark, tmp_path):
    path = tmp_path / "scored"
    df = table(spark, bursts(20, 1)).withColumn("timestamp", F.col("timestamp").cast("string"))
    df.coalesce(1).write.parquet(str(path))
    (path / "part-broken.parquet").write_bytes(b"not parquet")
    got = tables.load_scored(spark, str(path), skip_unreadable=True)
    assert [Path(r.file).name for r in tables.skipped_files(spark, str(path)).collect()] == ["part-broken.parquet"]
    with pytest.raises(Exception, match="part-broken"):
        tables.load_scored(spark, str(path)).count()
    assert got.count() == 20 and dict(got.dtypes)["timestamp"] == "timestamp"


@pytest.mark.parametrize("name", ["part-00000-0.parquet", "part-00000-z.parquet", "part-zz.parquet"])
def test_damaged_file_first_last_and_alone(spark, tmp_path, name):
    path, df = tmp_path / "scored", table(spark, bursts(20, 1))
    path.mkdir()
    (path / name).write_bytes(b"not parquet")
    alone = tables.load_scored(spark, str(path), skip_unreadable=True, schema=df.schema)
    assert alone.count() == 0 and set(alone.columns) == set(df.columns)
    assert tables.skipped_files(spark, str(path), df.schema).count() == 1
    df.repartition(3).write.mode("append").parquet(str(path))
    for schema in (None, df.schema):
        assert tables.load_scored(spark, str(path), skip_unreadable=True, schema=schema).count() == 20
        assert [Path(r.file).name for r in tables.skipped_files(spark, str(path), schema).collect()] == [name]


def test_view_scan(spark):
    df = table(spark, [row(1, "U", 0), row(2, "U", 1)])
    tables.register_view(df, "scored_view")
    assert spark.sql("SELECT count(*) AS n FROM scored_view WHERE user_id = 'U'").first().n == 2


def test_session_and_work_dir(spark):
    assert get_session() is spark
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    first, second = work_dir(spark, "a"), work_dir(spark, "a")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_inputs_are_left_alone():
    assert sorted(p.name for p in Path(SF_DIR).iterdir())[0] == "benchmark.parquet"


def test_a_hot_category_is_written_by_several_tasks(spark, tx, monkeypatch):
    from ledgerlens.plans import inputs

    many = tx.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(8)))).drop("copy").repartition(8)
    monkeypatch.setattr(inputs, "transactions", lambda spark, sf_dir: many)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    spark.conf.set("spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor", "0.05")
    try:
        path = inputs.scored_files(spark, SF_DIR)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).count()
    assert files > many.select("merchant_category").distinct().count()
