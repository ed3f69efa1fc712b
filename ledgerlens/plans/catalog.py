"""One registered query per operator: (spark, data folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import features as feat
from ledgerlens.functions import rules
from ledgerlens.operators import asof, attribution, bursts, history, investigation, labels, model, monitoring, patterns, rings, scoring
from ledgerlens.operators import sketches, tiles
from ledgerlens.plans import inputs
from ledgerlens.schema import MODEL_FEATURES, NARROW_COLUMNS, TRANSACTION_COLUMNS
from ledgerlens.session import work_dir
from ledgerlens.sinks import batch as batch_sink
from ledgerlens.sinks import layout, serving
from ledgerlens.sinks import stream as stream_sink
from ledgerlens.sources import messages, tables
from ledgerlens.sources.events import confirmations_of, transaction_stream, transactions
from ledgerlens.streaming import behaviour, windows
from ledgerlens.streaming import labels as label_streams
from ledgerlens.streaming.lifecycle import drain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

INTAKE = {"maxFilesPerTrigger": "8"}


def tidy(df: DataFrame, **digits: int) -> DataFrame:
    """Round the named columns and drop the zone from timestamps, for comparison."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        if field.name in digits:
            column = F.round(column, digits[field.name])
        columns.append(column.alias(field.name))
    return df.select(*columns)


def on_transactions(name: str, build: Callable[[DataFrame], DataFrame], **digits: int) -> None:
    QUERIES[name] = lambda spark, sf_dir: tidy(build(transactions(spark, sf_dir)), **digits)


def on_scored(name: str, build: Callable[[DataFrame], DataFrame], **digits: int) -> None:
    QUERIES[name] = lambda spark, sf_dir: tidy(build(inputs.scored(spark, sf_dir)), **digits)


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def with_id(build: Callable[[DataFrame], DataFrame], *columns: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: build(df).select("transaction_id", *columns)


# --- Sources ------------------------------------------------------------------
on_transactions("parse_json_messages", lambda tx: messages.parse_messages(batch_sink.encode_messages(tx)))
on_transactions("quarantine_counts", lambda tx: messages.quarantine_counts(inputs.damaged_messages(tx)))
on_transactions("merchant_enrich", with_id(tables.enrich_merchant, "merchant_category", "category_avg", "amount_ratio"), amount_ratio=9)


@registered
def history_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(tables.history_summary(tables.load_history(spark, inputs.history_path(spark, sf_dir))))


@registered
def history_month_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = tables.load_history(spark, inputs.history_path(spark, sf_dir), (2024, 2), (2024, 2))
    return tidy(months.select("transaction_id", "timestamp", "amount", "year", "month"))


@registered
def history_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(tables.load_history(spark, inputs.history_path(spark, sf_dir)).select(*TRANSACTION_COLUMNS, "year", "month"))


@registered
def scored_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, and files read and passed over, of a scored table with a damaged file."""
    path = inputs.scored_files(spark, sf_dir)
    schema = scoring.rule_output(transactions(spark, sf_dir)).schema
    loaded = tables.load_scored(spark, path, skip_unreadable=True, schema=schema)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    alert = F.col("predicted_fraud").cast("long")
    rows = loaded.select(one.alias("transactions"), alert.alias("alerts"), zero.alias("skipped"))
    lost = tables.skipped_files(spark, path, schema).select(zero.alias("transactions"), zero.alias("alerts"), one.alias("skipped"))
    return rows.unionByName(lost).agg(*[F.sum(c).alias(c) for c in rows.columns])


@registered
def sql_view_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.register_view(scoring.rule_output(transactions(spark, sf_dir)), "fraud_detection_ml")
    return tidy(spark.sql("SELECT * FROM fraud_detection_ml WHERE predicted_fraud = 1"))


@registered
def literal_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [c for c in NARROW_COLUMNS]
    both = tables.from_rows(spark, inputs.LITERAL_ROWS).unionByName(transactions(spark, sf_dir).select(*columns))
    return tidy(scoring.score_rules(both).select("transaction_id", "timestamp", "amount", "fraud_score", "risk_level"))


# --- Sinks --------------------------------------------------------------------
def _decoded(tx: DataFrame) -> DataFrame:
    def field(name: str):
        return F.get_json_object("value", f"$.{name}")

    return batch_sink.encode_messages(tx).select(
        "key",
        field("transaction_id").alias("transaction_id"),
        field("timestamp").alias("time_text"),
        field("amount").cast("double").alias("amount"),
        field("merchant_category").alias("merchant_category"),
        field("is_online").alias("is_online_text"),
        field("is_fraud").cast("int").alias("is_fraud"),
    )


on_transactions("encode_messages", _decoded)

# --- Row-level features -------------------------------------------------------
TIME = ["hour_of_day", "day_of_week", "is_unusual_hour", "is_weekend"]
AMOUNT = ["amount_log", "amount_category", "is_high_amount", "is_very_high_amount"]
SIMPLE = ["is_round_amount", "is_online_flag", "timestamp_epoch"]
MERCHANT = ["is_high_risk_merchant", "is_online_merchant"]

on_transactions("feat_time", with_id(feat.time_features, *TIME))
on_transactions("feat_amount", with_id(feat.amount_features, *AMOUNT), amount_log=9)
on_transactions("feat_simple", with_id(feat.simple_features, *SIMPLE))
on_transactions("feat_merchant", with_id(feat.merchant_features, *MERCHANT))
on_transactions("feat_rule_set", with_id(feat.rule_features, *TIME, *AMOUNT, *SIMPLE, *MERCHANT), amount_log=9)
on_transactions("feat_model_set", with_id(feat.model_features, *MODEL_FEATURES), amount_log=9)


def _vector(tx: DataFrame) -> DataFrame:
    vectors = feat.assemble(feat.model_features(tx), label=None)
    items = vectors.select("transaction_id", "is_fraud", vector_to_array("features").alias("v"))
    return items.select(
        "transaction_id",
        F.col("is_fraud").alias("label"),
        *[F.get("v", F.lit(i)).alias(f"v{i}") for i in range(len(MODEL_FEATURES))],
    )


on_transactions("feat_vector_array", _vector, v1=9)

# --- Behavioural features -----------------------------------------------------
GAP = ["prev_timestamp", "time_since_last_txn", "is_rapid_transaction"]
TRAVEL = ["prev_lat", "prev_lon", "distance_from_prev", "is_impossible_travel"]
DEVICE = ["prev_device", "device_changed"]
WINDOW_STATS = [
    "txn_count_window", "avg_amount_window", "max_amount_window",
    "min_amount_window", "std_amount_window", "total_amount_window",
]
WINDOW_DIGITS = {"avg_amount_window": 6, "std_amount_window": 6, "total_amount_window": 6}

on_transactions("feat_velocity_gap", with_id(history.velocity_features, *GAP))
on_transactions("feat_velocity_count", with_id(history.velocity_features, "timestamp_seconds", "txn_count_5min"))
on_transactions("feat_location", with_id(history.location_features, *TRAVEL), distance_from_prev=6)
on_transactions("feat_device", with_id(history.device_features, *DEVICE))
on_transactions("user_window_stats", history.user_window_stats, **WINDOW_DIGITS)
on_transactions("feat_user_window", with_id(history.user_window_features, "window_start", *WINDOW_STATS), **WINDOW_DIGITS)


@registered
def feat_from_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behavioural features read from bucketed, sorted history."""
    name = f"history_layout_{uuid.uuid4().hex[:8]}"
    layout.write_layout(transactions(spark, sf_dir), name, work_dir(spark, "layout"), buckets=8)
    found = history.behaviour_features(layout.load_layout(spark, name))
    columns = ["time_since_last_txn", "is_rapid_transaction", "txn_count_5min", "distance_from_prev", "is_impossible_travel", "device_changed"]
    return tidy(found.select("transaction_id", *columns), distance_from_prev=6)


on_transactions(
    "feat_asof_window",
    with_id(asof.asof_features, "asof_window_start", "asof_age_seconds", *asof.STATISTICS),
    asof_avg_amount=6, asof_std_amount=6, asof_total_amount=6,
)
on_transactions(
    "feat_behavioural_set",
    with_id(
        history.behaviour_features,
        *TIME, "amount_log", "amount_category", "timestamp_seconds", *GAP, "txn_count_5min", *TRAVEL, *DEVICE,
        "is_high_risk_merchant",
    ),
    amount_log=9,
    distance_from_prev=6,
)

# --- Rules --------------------------------------------------------------------
SCORE = ["fraud_score", "predicted_fraud", "risk_level"]
CELLS = ["true_positive", "false_positive", "true_negative", "false_negative"]

on_transactions("score_rules_stateless", with_id(scoring.score_rules, *SCORE))
on_transactions("score_rules_behavioural", with_id(scoring.score_behaviour, *SCORE))
on_transactions("risk_levels", with_id(scoring.score_rules, "fraud_score", "risk_level"))
on_scored("confusion_flags", with_id(rules.confusion_flags, "is_fraud", "predicted_fraud", *CELLS))
on_transactions("scored_output", scoring.rule_output)
on_transactions("scored_output_behavioural", scoring.behaviour_output, distance_from_prev=6)
on_transactions("rule_hit_counts", lambda tx: rules.rule_hits(feat.rule_features(tx)))
on_transactions(
    "rule_hit_counts_behavioural",
    lambda tx: rules.rule_hits(history.behaviour_features(tx), rules.BEHAVIOUR_RULES),
)

# --- Model --------------------------------------------------------------------
on_transactions(
    "train_test_split",
    lambda tx: tx.select("transaction_id", F.when(model.in_train(), "train").otherwise("test").alias("part")),
)
on_transactions("label_distribution", model.label_distribution, share_pct=6)
on_transactions("amount_stats_by_label", model.amount_stats_by_label, avg_amount=6, std_amount=6)
on_transactions("split_balance", model.split_balance)
on_scored("confusion_pivot", model.confusion_pivot)


def _test_predictions(spark: SparkSession, sf_dir: str, forest: RandomForestClassificationModel) -> DataFrame:
    _, test = model.split(transactions(spark, sf_dir))
    return scoring.model_output(test, forest)


@registered
def model_train_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = inputs.forest(spark, sf_dir)
    balance = model.split_balance(transactions(spark, sf_dir))
    return balance.groupBy("part").agg(
        F.sum("transactions").alias("samples"),
        F.lit(forest.getNumTrees).alias("num_trees"),
        F.lit(forest.getMaxDepth()).alias("max_depth"),
        F.lit(forest.numFeatures).alias("num_features"),
    )


@registered
def model_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(scoring.model_output(transactions(spark, sf_dir), inputs.forest(spark, sf_dir)))


@registered
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.evaluate(_test_predictions(spark, sf_dir, inputs.forest(spark, sf_dir)))


@registered
def model_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten test predictions that a training report shows."""
    _, test = model.split(transactions(spark, sf_dir))
    return model.preview(scoring.score_model(test, inputs.forest(spark, sf_dir)))


@registered
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.feature_importance(spark, inputs.forest(spark, sf_dir))


@registered
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows scored alike by a model and by its saved and loaded copy."""
    path, forest = work_dir(spark, "forest"), inputs.forest(spark, sf_dir)
    model.save_model(forest, path)
    scores = ["predicted_fraud", "fraud_probability", "fraud_score", "risk_level"]
    first = scoring.score_model(transactions(spark, sf_dir), forest)
    first = first.select(*TRANSACTION_COLUMNS, *[F.col(c).alias(f"first_{c}") for c in scores])
    again = scoring.score_model(first, model.load_model(path))
    same = F.lit(True)
    for c in scores:
        same = same & (F.col(c) == F.col(f"first_{c}"))
    return again.agg(F.count(F.lit(1)).alias("transactions"), F.count_if(same).alias("scored_alike"))


@registered
def model_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = inputs.forest(spark, sf_dir)
    metrics = {r["metric"]: r["value"] for r in model.evaluate(_test_predictions(spark, sf_dir, forest)).collect()}
    balance = model.split_balance(transactions(spark, sf_dir)).groupBy("part").agg(F.sum("transactions").alias("n"))
    sizes = {r["part"]: r["n"] for r in balance.collect()}
    row = model.model_metadata(spark, forest, metrics, sizes.get("train", 0), sizes.get("test", 0))
    path = work_dir(spark, "metadata")
    model.save_metadata(row, path)
    return spark.read.schema(row.schema).json(path)


# --- Monitoring ---------------------------------------------------------------
BOX = {"mean_value": 6, "sd_value": 6, "q1": 6, "median": 6, "q3": 6}
RATES = {"accuracy": 9, "precision": 9, "recall": 9, "f1": 9}

on_scored("kpi_summary", monitoring.kpi_summary, total_amount=4, fraud_amount=4, avg_fraud_score=6, fraud_rate_pct=6)
on_scored("detection_metrics", monitoring.detection_metrics, **RATES)
on_scored("detection_metrics_long", monitoring.detection_metrics_long, value=6)
on_scored("confusion_matrix", monitoring.confusion_matrix)
on_scored("timeline_5min", monitoring.timeline)
on_scored("timeline_1min", monitoring.timeline_by_class)
on_scored("fraud_rate_gauge", monitoring.fraud_rate_gauge, fraud_rate_pct=6, delta_pct=6)
on_scored("score_box_by_band", lambda df: monitoring.score_box_by_band(df, method="counted"), **BOX)
on_scored("score_histogram", monitoring.score_histogram)
on_scored("score_dist_by_class", monitoring.score_dist_by_class)
on_scored(
    "score_quantiles_by_class", lambda df: monitoring.score_quantiles_by_class(df, method="counted"), p05=6, q1=6, median=6, q3=6, p95=6
)
on_scored("risk_level_counts", monitoring.risk_level_counts)
on_scored("fraud_rate_by_category", monitoring.fraud_rate_by_category)
on_scored("amount_box_by_class", monitoring.amount_box_by_class, **BOX)
on_scored("hourly_pattern", monitoring.hourly_pattern)
on_scored("category_rollup", monitoring.category_rollup)
on_scored("day_hour_heatmap", monitoring.day_hour_heatmap)
on_scored("daily_trend", monitoring.daily_trend, moving_avg=6)
on_scored("alert_funnel", monitoring.alert_funnel, step_pct=6)
on_scored("roc_curve", model.roc_curve, tpr=9, fpr=9)
on_scored("roc_auc", model.roc_auc, auc=9)
on_transactions("throughput_summary", monitoring.throughput_summary, fraud_pct=6, tps=9)

# --- Investigation ------------------------------------------------------------
ALERT = ["transaction_id", "user_id", "timestamp", "amount", "merchant_category", "fraud_score", "risk_level"]


def _page(scored: DataFrame) -> DataFrame:
    """Every document of the extract, read back from its JSON text."""
    shown = scored.select("transaction_id", "timestamp", "amount", "is_fraud", *SCORE)
    document = F.from_json(
        "payload", "transaction_id string, timestamp string, amount double, fraud_score double, risk_level string"
    )
    return investigation.api_extract(shown).select(document.alias("d")).select(
        "d.transaction_id", F.col("d.timestamp").alias("time_text"), "d.amount", "d.fraud_score", "d.risk_level"
    )


on_scored("recent_alerts", lambda df: investigation.recent_alerts(df).select(*ALERT))
on_scored("top_suspicious", investigation.top_suspicious)
on_scored("top_fraud_users", investigation.top_fraud_users)
on_scored("fraud_points", investigation.fraud_points)
on_scored("user_sequences", investigation.user_sequences, marker_size=9)
on_scored("user_sequences_chart", lambda df: investigation.user_sequences(df, users=8), marker_size=9)
on_scored("fraud_edges", investigation.fraud_edges)
on_scored("fraud_node_degree", lambda df: investigation.node_degrees(investigation.fraud_edges(df)))
on_scored("fraud_edges_chart", lambda df: investigation.fraud_edges(df, users=10, merchants=8, more_than=5))
on_scored("geo_anomalies", investigation.geo_anomalies, distance_km=6, speed_kmh=6)
on_scored("api_extract", _page)

# --- Patterns -----------------------------------------------------------------
on_transactions("pattern_high_amount", with_id(patterns.high_amount, "merchant_category", "amount", "category_avg"))
on_transactions("pattern_rapid_succession", with_id(patterns.rapid_succession, "user_id", "timestamp", "burst_count"))
on_transactions("pattern_geo_impossible", with_id(patterns.geographic_jump, "user_id", "distance_km", "gap_seconds"), distance_km=6)
on_transactions("pattern_unusual_time", with_id(patterns.unusual_time, "user_id", "timestamp", "amount"))
on_transactions("pattern_new_device", patterns.new_device)
on_transactions("pattern_hits", with_id(patterns.pattern_hits, "user_id", "pattern"))
on_transactions("pattern_summary", patterns.pattern_summary, total_amount=4)


on_transactions("user_bursts", bursts.bursts, seconds=6, total_amount=4)

# --- Summaries that answer without the rows -------------------------------------
on_scored("fraud_rings", lambda df: rings.fraud_rings(investigation.fraud_edges(df)))
on_scored("fraud_core", lambda df: rings.fraud_core(investigation.fraud_edges(df)))
on_scored("fraud_tiles", tiles.fraud_tiles, total_amount=4)


def _sketch_store(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    path = work_dir(spark, "sketches")
    sketches.write_store(sketches.sketch_buckets(inputs.scored(spark, sf_dir)), path)
    return sketches.load_store(spark, path, start, end)


SKETCHED = {"total_amount": 4, "q1": 6, "median": 6, "q3": 6}


@registered
def sketch_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles, distinct users and leading merchants per category, from the store alone."""
    found = sketches.answers(sketches.merge(_sketch_store(spark, sf_dir), "merchant_category"))
    return tidy(found.drop("top_merchants", "top_counts"), **SKETCHED)


@registered
def sketch_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per day of ten days, with the leading merchant; only these days' folders are read."""
    found = sketches.answers(sketches.merge(_sketch_store(spark, sf_dir, "2024-01-08", "2024-01-17"), "day"), top=1)
    found = found.withColumn("top_merchant", F.get("top_merchants", F.lit(0))).withColumn("top_count", F.get("top_counts", F.lit(0)))
    return tidy(found.drop("top_merchants", "top_counts"), **SKETCHED)


# --- Streams ------------------------------------------------------------------
def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid transactions decoded from a stream of messages."""
    encoded = batch_sink.encode_messages(transaction_stream(spark, sf_dir, **INTAKE))
    valid, _ = messages.split_valid(encoded)
    return valid


def _to_parquet(stream: DataFrame, label: str) -> DataFrame:
    spark = stream.sparkSession
    out = work_dir(spark, label)
    drain(stream_sink.to_parquet(stream, f"{out}/data", f"{out}/checkpoint", trigger=None))
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def _to_memory(stream: DataFrame, label: str) -> DataFrame:
    name = f"{label}_{uuid.uuid4().hex[:8]}"
    drain(stream_sink.to_memory(stream, name, output_mode="complete", trigger=None))
    return stream.sparkSession.table(name)


@registered
def stream_scored_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The memory table lives in the driver, so it holds counts, not all rows."""
    scored = scoring.rule_output(_message_stream(spark, sf_dir))
    counts = scored.groupBy("risk_level", "predicted_fraud", "is_fraud").agg(F.count(F.lit(1)).alias("transactions"))
    return _to_memory(counts, "scored")


@registered
def stream_scored_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_to_parquet(scoring.rule_output(_message_stream(spark, sf_dir)), "stream_scored"))


@registered
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, view = work_dir(spark, "fanout"), f"fanout_{uuid.uuid4().hex[:8]}"
    scored = scoring.rule_output(_message_stream(spark, sf_dir))
    drain(stream_sink.fan_out(scored, f"{out}/data", f"{out}/checkpoint", view=view, trigger=None))
    return tidy(spark.table(f"global_temp.{view}").select(*scored.columns))


@registered
def stream_model_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = inputs.forest(spark, sf_dir)
    return tidy(_to_parquet(scoring.model_output(_message_stream(spark, sf_dir), forest), "stream_model"))


@registered
def stream_restart_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query ends after half the input and is started again for the rest."""
    out = work_dir(spark, "restart")
    tx = transactions(spark, sf_dir)
    for half in (F.dayofmonth("timestamp") <= 15, F.dayofmonth("timestamp") > 15):
        tx.filter(half).write.mode("append").parquet(f"{out}/input")
        source = messages.read_stream(spark, "parquet", schema=tx.schema, max_per_trigger=8, path=f"{out}/input")
        scored = scoring.rule_output(source)
        drain(stream_sink.to_parquet(scored, f"{out}/data", f"{out}/checkpoint", trigger=None))
    return tidy(spark.read.parquet(f"{out}/data"))


@registered
def stream_user_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = windows.user_windows(transaction_stream(spark, sf_dir, **INTAKE))
    return tidy(_to_parquet(stream, "user_window"), **WINDOW_DIGITS)


@registered
def stream_behavioural(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = behaviour.score_behaviour_stream(transaction_stream(spark, sf_dir, maxFilesPerTrigger="1"))
    return tidy(_to_parquet(stream, "behaviour"), distance_from_prev=6)


@registered
def model_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons per transaction; base and contributions add up to the probability."""
    told = attribution.explain(transactions(spark, sf_dir), inputs.forest(spark, sf_dir))
    total = F.aggregate("contributions", F.col("base"), lambda a, b: a + b)
    return told.select(
        "transaction_id", "fraud_probability", "base", total.alias("explained"), F.col("reasons.feature").alias("reasons")
    )


OUTCOME = [
    "transaction_id", "timestamp", "amount", "predicted_fraud", "outcome", "confirmed_at",
    "true_positive", "false_positive", "true_negative", "false_negative",
]


@registered
def late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    return tidy(labels.confirmed_outcomes(scoring.score_rules(tx), confirmations_of(tx)).select(*OUTCOME))


@registered
def late_label_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    told = labels.confirmed_outcomes(scoring.score_rules(tx), confirmations_of(tx))
    return tidy(labels.outcome_report(told), total_amount=4, avg_delay_hours=6)


@registered
def stream_late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and confirmations as two streams; open transactions stay in the state."""
    scored = scoring.score_rules(transaction_stream(spark, sf_dir, **INTAKE))
    told = label_streams.outcome_stream(scored, confirmations_of(transaction_stream(spark, sf_dir, **INTAKE)))
    return tidy(_to_parquet(told.select(*OUTCOME), "late_labels"))


@registered
def stream_live_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = windows.live_kpis(scoring.score_rules(transaction_stream(spark, sf_dir, **INTAKE)))
    return tidy(_to_memory(kpis, "live_kpis"), total_amount=4, avg_fraud_score=6)


@registered
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction is delivered twice and let through once."""
    once = transaction_stream(spark, sf_dir, **INTAKE)
    twice = once.unionByName(transaction_stream(spark, sf_dir, **INTAKE))
    columns = ["transaction_id", "user_id", "timestamp", "amount"]
    return tidy(_to_parquet(windows.deduplicate(twice.select(*columns)), "dedup"))


@registered
def stream_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bursts.burst_stream(transaction_stream(spark, sf_dir, **INTAKE))
    return tidy(_to_parquet(found, "bursts"), seconds=6, total_amount=4)


def _served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A serving table that a stream has filled in small batches, compacted on the way."""
    out = work_dir(spark, "serving")
    scored = scoring.score_rules(transaction_stream(spark, sf_dir, maxFilesPerTrigger="1"))
    drain(serving.serve(scored, f"{out}/table", f"{out}/checkpoint", every=2, trigger=None))
    return serving.load_serving(spark, f"{out}/table")


@registered
def serving_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(serving.served_kpis(_served(spark, sf_dir)), total_amount=4, avg_fraud_score=6, fraud_rate_pct=6)


@registered
def serving_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(serving.served_timeline(_served(spark, sf_dir)))


@registered
def serving_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(serving.served_by_category(_served(spark, sf_dir)), rate=9)


@registered
def serving_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(serving.served_hours(_served(spark, sf_dir)))
