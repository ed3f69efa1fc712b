"""DuckDB SQL for the registered queries, written independently of the operators."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

# --- Common tables ------------------------------------------------------------
TX = """
tx AS (
  SELECT 'TRX_' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS transaction_id,
    'USER_' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS user_id,
    CAST(ts AS TIMESTAMP) AS "timestamp",
    CASE WHEN event_id % 20 = 0 THEN CAST(floor(value*4/10)*10 AS DOUBLE) ELSE value*4 END AS amount,
    'MERCHANT_' || CAST(1000 + (event_id*7919 + k) % 500 AS VARCHAR) AS merchant_id,
    CASE k % 10 WHEN 0 THEN 'supermarket' WHEN 1 THEN 'restaurant' WHEN 2 THEN 'gas_station'
      WHEN 3 THEN 'pharmacy' WHEN 4 THEN 'electronics' WHEN 5 THEN 'clothing' WHEN 6 THEN 'hotel'
      WHEN 7 THEN 'airline' WHEN 8 THEN 'online_shopping' ELSE 'entertainment' END AS merchant_category,
    CASE WHEN event_id % 50 = 0 THEN 0e0 - home_lat ELSE home_lat + (k-50)/250e0 END AS location_lat,
    CASE WHEN event_id % 50 = 0 THEN 0e0 - home_lon ELSE home_lon + (k-50)/250e0 END AS location_lon,
    'DEVICE_' || lpad(CAST(user_id*3 + CASE WHEN k >= 95 THEN 1 + k % 2 ELSE 0 END AS VARCHAR), 8, '0') AS device_id,
    (k % 10 = 8 OR k % 5 = 0) AS is_online,
    CAST(CASE WHEN (value*4 > 500 AND event_type = 'error') OR (event_id % 50 = 0 AND k < 50)
      THEN 1 ELSE 0 END AS INTEGER) AS is_fraud,
    CAST(NULL AS VARCHAR) AS card_last_4,
    CAST(NULL AS BOOLEAN) AS cvv_provided
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k,
          CAST(user_id*37 % 120 - 60 AS DOUBLE) AS home_lat,
          CAST(user_id*61 % 360 - 180 AS DOUBLE) AS home_lon FROM events) e
)"""

FEAT = TX + """,
feat AS (
  SELECT *, CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
    CAST(dayofweek("timestamp") + 1 AS INTEGER) AS day_of_week,
    CASE WHEN hour("timestamp") BETWEEN 2 AND 5 THEN 1 ELSE 0 END AS is_unusual_hour,
    CASE WHEN dayofweek("timestamp") IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN amount > 0 THEN round(log10(amount), 9) ELSE 0e0 END AS amount_log,
    CASE WHEN amount < 20 THEN 'low' WHEN amount < 100 THEN 'medium' WHEN amount < 500 THEN 'high'
      ELSE 'very_high' END AS amount_category,
    CASE WHEN amount > 500 THEN 1 ELSE 0 END AS is_high_amount,
    CASE WHEN amount > 1000 THEN 1 ELSE 0 END AS is_very_high_amount,
    CASE WHEN amount % 10 = 0 THEN 1 ELSE 0 END AS is_round_amount,
    CASE WHEN is_online THEN 1 ELSE 0 END AS is_online_flag,
    CAST(epoch_us("timestamp") // 1000000 AS BIGINT) AS timestamp_epoch,
    CASE WHEN merchant_category IN ('electronics', 'online_shopping', 'airline', 'hotel') THEN 1 ELSE 0 END
      AS is_high_risk_merchant,
    CASE WHEN merchant_category = 'online_shopping' THEN 1 ELSE 0 END AS is_online_merchant
  FROM tx
)"""

POINTS = """
    CASE WHEN amount > 1000 THEN 40e0 WHEN amount > 500 THEN 25e0 ELSE 0e0 END
    + CASE WHEN is_unusual_hour = 1 THEN 20e0 ELSE 0e0 END
    + CASE WHEN amount % 10 = 0 AND amount > 200 THEN 15e0 ELSE 0e0 END
    + CASE WHEN is_high_risk_merchant = 1 AND amount > 300 THEN 20e0 ELSE 0e0 END
    + CASE WHEN is_online AND amount > 500 THEN 15e0 ELSE 0e0 END
    + CASE WHEN is_weekend = 1 AND is_unusual_hour = 1 AND amount > 200 THEN 20e0 ELSE 0e0 END"""

LEVEL = """CASE WHEN fraud_score >= 70 THEN 'HIGH' WHEN fraud_score >= 50 THEN 'MEDIUM'
      WHEN fraud_score >= 30 THEN 'LOW' ELSE 'SAFE' END"""

CELLS = """
    CASE WHEN is_fraud = 1 AND predicted_fraud = 1 THEN 1 ELSE 0 END AS true_positive,
    CASE WHEN is_fraud = 0 AND predicted_fraud = 1 THEN 1 ELSE 0 END AS false_positive,
    CASE WHEN is_fraud = 0 AND predicted_fraud = 0 THEN 1 ELSE 0 END AS true_negative,
    CASE WHEN is_fraud = 1 AND predicted_fraud = 0 THEN 1 ELSE 0 END AS false_negative"""

SCORED = FEAT + f""",
scored AS (
  SELECT *, CASE WHEN fraud_score >= 50 THEN 1 ELSE 0 END AS predicted_fraud, {LEVEL} AS risk_level
  FROM (SELECT *, {POINTS} AS fraud_score FROM feat) f
)"""

# The user's previous transaction, and counts by second.
PAST = FEAT + """,
lagged AS (
  SELECT *,
    lag("timestamp") OVER o AS prev_timestamp, lag(timestamp_epoch) OVER o AS prev_epoch,
    lag(location_lat) OVER o AS prev_lat, lag(location_lon) OVER o AS prev_lon,
    lag(device_id) OVER o AS prev_device,
    CAST(count(*) OVER (PARTITION BY user_id ORDER BY timestamp_epoch
      RANGE BETWEEN 300 PRECEDING AND CURRENT ROW) AS BIGINT) AS txn_count_5min,
    CAST(count(*) OVER (PARTITION BY user_id ORDER BY timestamp_epoch
      RANGE BETWEEN 60 PRECEDING AND CURRENT ROW) AS BIGINT) AS burst_count
  FROM feat WINDOW o AS (PARTITION BY user_id ORDER BY "timestamp", transaction_id)
),
gaps AS (
  SELECT *, timestamp_epoch AS timestamp_seconds,
    CAST(coalesce(timestamp_epoch - prev_epoch, 999999) AS BIGINT) AS time_since_last_txn,
    coalesce(sqrt(pow(location_lat - prev_lat, 2) + pow(location_lon - prev_lon, 2)) * 111, 0e0) AS raw_distance,
    CASE WHEN device_id <> prev_device THEN 1 ELSE 0 END AS device_changed
  FROM lagged
),
past AS (
  SELECT *, round(raw_distance, 6) AS distance_from_prev,
    CASE WHEN time_since_last_txn < 60 THEN 1 ELSE 0 END AS is_rapid_transaction,
    CASE WHEN raw_distance > 100 AND time_since_last_txn < 3600 THEN 1 ELSE 0 END AS is_impossible_travel
  FROM gaps
)"""

BEHAVED = PAST + f""",
behaved AS (
  SELECT *, CASE WHEN fraud_score >= 50 THEN 1 ELSE 0 END AS predicted_fraud, {LEVEL} AS risk_level
  FROM (SELECT *,
      CASE WHEN amount > 500 THEN 30e0 ELSE 0e0 END
      + CASE WHEN is_unusual_hour = 1 THEN 20e0 ELSE 0e0 END
      + CASE WHEN is_rapid_transaction = 1 THEN 25e0 ELSE 0e0 END
      + CASE WHEN is_impossible_travel = 1 THEN 40e0 ELSE 0e0 END
      + CASE WHEN device_changed = 1 AND amount > 200 THEN 30e0 ELSE 0e0 END
      + CASE WHEN is_high_risk_merchant = 1 AND amount > 300 THEN 15e0 ELSE 0e0 END
      + CASE WHEN txn_count_5min > 3 THEN 20e0 ELSE 0e0 END AS fraud_score
    FROM past) b
)"""

# History: days after the 15th moved on by 31 days.
HIST = TX + """,
hist AS (
  SELECT * REPLACE (CASE WHEN day("timestamp") > 15 THEN "timestamp" + INTERVAL 31 DAY ELSE "timestamp" END
    AS "timestamp") FROM tx
),
months AS (
  SELECT *, CAST(year("timestamp") AS INTEGER) AS "year", CAST(month("timestamp") AS INTEGER) AS "month" FROM hist
)"""

DIM = """,
dim(merchant_category, category_avg) AS (
  VALUES ('supermarket', 45e0), ('restaurant', 35e0), ('gas_station', 60e0), ('pharmacy', 25e0),
    ('electronics', 350e0), ('clothing', 80e0), ('hotel', 150e0), ('airline', 250e0),
    ('online_shopping', 60e0), ('entertainment', 40e0)
)"""

USER_WINDOWS = TX + """,
stats AS (
  SELECT user_id, time_bucket(INTERVAL 1 HOUR, "timestamp", TIMESTAMP '1970-01-01') AS window_start,
    count(*) AS txn_count_window, round(avg(amount), 6) AS avg_amount_window,
    max(amount) AS max_amount_window, min(amount) AS min_amount_window,
    round(stddev_samp(amount), 6) AS std_amount_window, round(sum(amount), 6) AS total_amount_window
  FROM tx GROUP BY 1, 2
)"""


def sql(name: str, tables: str, body: str) -> None:
    ORACLE_SQL[name] = f"WITH {tables.strip()}\n{body.strip()}"


# --- Sources and sinks --------------------------------------------------------
sql("parse_json_messages", TX, "SELECT * FROM tx")
sql("quarantine_counts", TX, """
SELECT CASE merchant_category WHEN 'pharmacy' THEN 'malformed_json' WHEN 'hotel' THEN 'missing_field'
    WHEN 'airline' THEN 'bad_timestamp' ELSE 'valid' END AS reason, count(*) AS messages
FROM tx GROUP BY 1""")
sql("merchant_enrich", TX + DIM, """
SELECT transaction_id, merchant_category, category_avg, round(amount / category_avg, 9) AS amount_ratio
FROM tx LEFT JOIN dim USING (merchant_category)""")
sql("history_load_summary", HIST, """
SELECT "year", "month", count(*) AS row_count, min("timestamp") AS first_seen, max("timestamp") AS last_seen
FROM months GROUP BY 1, 2""")
sql("history_month_slice", HIST, """
SELECT transaction_id, "timestamp", amount, "year", "month" FROM months WHERE "year" = 2024 AND "month" = 2""")
sql("scored_load", SCORED, """
SELECT count(*) AS transactions, CAST(sum(predicted_fraud) AS BIGINT) AS alerts, CAST(1 AS BIGINT) AS skipped FROM scored""")
sql("history_roundtrip", HIST, "SELECT * FROM months")

RULE_OUTPUT = f"""
SELECT transaction_id, user_id, "timestamp", amount, merchant_category, is_online, is_fraud, predicted_fraud,
  fraud_score, risk_level, hour_of_day, is_unusual_hour, is_high_amount, is_high_risk_merchant, {CELLS}
FROM scored"""
BEHAVIOUR_OUTPUT = f"""
SELECT transaction_id, user_id, "timestamp", amount, merchant_category, is_online, is_fraud, predicted_fraud,
  fraud_score, risk_level, hour_of_day, is_unusual_hour, is_rapid_transaction, is_impossible_travel, device_changed,
  time_since_last_txn, distance_from_prev, {CELLS}
FROM behaved"""

sql("sql_view_scan", SCORED, RULE_OUTPUT + " WHERE predicted_fraud = 1")
sql("literal_fixture", SCORED, """
SELECT transaction_id, "timestamp", amount, fraud_score, risk_level FROM scored
UNION ALL VALUES
  ('SAMPLE_01', TIMESTAMP '2024-05-06 10:20:00', 18.4e0, 0e0, 'SAFE'),
  ('SAMPLE_02', TIMESTAMP '2024-05-06 03:40:00', 1700e0, 110e0, 'HIGH'),
  ('SAMPLE_03', TIMESTAMP '2024-05-07 19:05:00', 64.75e0, 0e0, 'SAFE'),
  ('SAMPLE_04', TIMESTAMP '2024-05-08 02:15:00', 2400e0, 110e0, 'HIGH'),
  ('SAMPLE_05', TIMESTAMP '2024-05-09 13:45:00', 88.2e0, 0e0, 'SAFE')""")
sql("encode_messages", TX, """
SELECT user_id AS key, transaction_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS time_text, amount,
  merchant_category, CASE WHEN is_online THEN 'true' ELSE 'false' END AS is_online_text, is_fraud
FROM tx""")

# --- Features -----------------------------------------------------------------
sql("feat_time", FEAT, "SELECT transaction_id, hour_of_day, day_of_week, is_unusual_hour, is_weekend FROM feat")
sql("feat_amount", FEAT, """
SELECT transaction_id, amount_log, amount_category, is_high_amount, is_very_high_amount FROM feat""")
sql("feat_simple", FEAT, "SELECT transaction_id, is_round_amount, is_online_flag, timestamp_epoch FROM feat")
sql("feat_merchant", FEAT, "SELECT transaction_id, is_high_risk_merchant, is_online_merchant FROM feat")
sql("feat_rule_set", FEAT, """
SELECT transaction_id, hour_of_day, day_of_week, is_unusual_hour, is_weekend, amount_log, amount_category,
  is_high_amount, is_very_high_amount, is_round_amount, is_online_flag, timestamp_epoch,
  is_high_risk_merchant, is_online_merchant
FROM feat""")
sql("feat_model_set", FEAT, """
SELECT transaction_id, amount, round(log10(amount + 1), 9) AS amount_log, hour_of_day, day_of_week, is_weekend,
  is_unusual_hour, is_high_amount, is_round_amount, is_high_risk_merchant, is_online_flag AS is_online_int,
  location_lat, location_lon
FROM feat""")
sql("feat_vector_array", FEAT, """
SELECT transaction_id, is_fraud AS label, amount AS v0, round(log10(amount + 1), 9) AS v1,
  CAST(hour_of_day AS DOUBLE) AS v2, CAST(day_of_week AS DOUBLE) AS v3, CAST(is_weekend AS DOUBLE) AS v4,
  CAST(is_unusual_hour AS DOUBLE) AS v5, CAST(is_high_amount AS DOUBLE) AS v6, CAST(is_round_amount AS DOUBLE) AS v7,
  CAST(is_high_risk_merchant AS DOUBLE) AS v8, CAST(is_online_flag AS DOUBLE) AS v9,
  location_lat AS v10, location_lon AS v11
FROM feat""")

sql("feat_velocity_gap", PAST, """
SELECT transaction_id, prev_timestamp, time_since_last_txn, is_rapid_transaction FROM past""")
sql("feat_velocity_count", PAST, "SELECT transaction_id, timestamp_seconds, txn_count_5min FROM past")
sql("feat_location", PAST, """
SELECT transaction_id, prev_lat, prev_lon, distance_from_prev, is_impossible_travel FROM past""")
sql("feat_device", PAST, "SELECT transaction_id, prev_device, device_changed FROM past")
sql("user_window_stats", USER_WINDOWS, """
SELECT *, window_start + INTERVAL 1 HOUR AS window_end FROM stats""")
sql("feat_user_window", USER_WINDOWS, """
SELECT transaction_id, window_start, txn_count_window, avg_amount_window, max_amount_window, min_amount_window,
  coalesce(std_amount_window, 0e0) AS std_amount_window, total_amount_window
FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, "timestamp", TIMESTAMP '1970-01-01') AS window_start FROM tx) t
LEFT JOIN stats USING (user_id, window_start)""")
sql("feat_from_layout", PAST, """
SELECT transaction_id, time_since_last_txn, is_rapid_transaction, txn_count_5min, distance_from_prev,
  is_impossible_travel, device_changed
FROM past""")
sql("feat_asof_window", USER_WINDOWS, """
SELECT transaction_id, window_start AS asof_window_start,
  CAST(epoch_us("timestamp") // 1000000 - epoch_us(window_start) // 1000000 - 3600 AS BIGINT) AS asof_age_seconds,
  txn_count_window AS asof_txn_count, avg_amount_window AS asof_avg_amount, max_amount_window AS asof_max_amount,
  min_amount_window AS asof_min_amount, std_amount_window AS asof_std_amount, total_amount_window AS asof_total_amount
FROM tx ASOF LEFT JOIN (SELECT *, window_start + INTERVAL 1 HOUR AS closed FROM stats) s
  ON tx.user_id = s.user_id AND tx."timestamp" >= s.closed""")
sql("feat_behavioural_set", PAST, """
SELECT transaction_id, hour_of_day, day_of_week, is_unusual_hour, is_weekend, amount_log, amount_category,
  timestamp_seconds, prev_timestamp, time_since_last_txn, is_rapid_transaction, txn_count_5min, prev_lat, prev_lon,
  distance_from_prev, is_impossible_travel, prev_device, device_changed, is_high_risk_merchant
FROM past""")

# --- Rules --------------------------------------------------------------------
sql("score_rules_stateless", SCORED, "SELECT transaction_id, fraud_score, predicted_fraud, risk_level FROM scored")
sql("score_rules_behavioural", BEHAVED, "SELECT transaction_id, fraud_score, predicted_fraud, risk_level FROM behaved")
sql("risk_levels", SCORED, "SELECT transaction_id, fraud_score, risk_level FROM scored")
sql("confusion_flags", SCORED, f"SELECT transaction_id, is_fraud, predicted_fraud, {CELLS} FROM scored")
sql("scored_output", SCORED, RULE_OUTPUT)
sql("scored_output_behavioural", BEHAVED, BEHAVIOUR_OUTPUT)


def _hits(table: str, listed: list[tuple[str, float, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"rule\", count(*) AS hits, count(*) * {points}e0 AS points FROM {table} WHERE {test}"
        for name, points, test in listed
    )


sql("rule_hit_counts", FEAT, _hits("feat", [
    ("very_high_amount", 40, "amount > 1000"),
    ("high_amount", 25, "amount > 500 AND amount <= 1000"),
    ("unusual_hour", 20, "is_unusual_hour = 1"),
    ("round_amount", 15, "amount % 10 = 0 AND amount > 200"),
    ("high_risk_merchant", 20, "is_high_risk_merchant = 1 AND amount > 300"),
    ("online_high_amount", 15, "is_online AND amount > 500"),
    ("weekend_night", 20, "is_weekend = 1 AND is_unusual_hour = 1 AND amount > 200"),
]))
sql("rule_hit_counts_behavioural", PAST, _hits("past", [
    ("high_amount", 30, "amount > 500"),
    ("unusual_hour", 20, "is_unusual_hour = 1"),
    ("rapid_transaction", 25, "is_rapid_transaction = 1"),
    ("impossible_travel", 40, "is_impossible_travel = 1"),
    ("device_change", 30, "device_changed = 1 AND amount > 200"),
    ("high_risk_merchant", 15, "is_high_risk_merchant = 1 AND amount > 300"),
    ("burst", 20, "txn_count_5min > 3"),
]))

# --- Model data ---------------------------------------------------------------
PART = "CASE WHEN substr(md5(transaction_id), 1, 4) < 'cccc' THEN 'train' ELSE 'test' END"
sql("train_test_split", TX, f"SELECT transaction_id, {PART} AS part FROM tx")
sql("model_train_summary", TX, f"""
SELECT {PART} AS part, count(*) AS samples, 20 AS num_trees, 8 AS max_depth, 12 AS num_features FROM tx GROUP BY 1""")
sql("model_roundtrip", TX, "SELECT count(*) AS transactions, count(*) AS scored_alike FROM tx")
sql("label_distribution", TX, """
SELECT is_fraud, count(*) AS transactions, round(count(*) * 100e0 / sum(count(*)) OVER (), 6) AS share_pct
FROM tx GROUP BY is_fraud""")
sql("amount_stats_by_label", TX, """
SELECT is_fraud, count(*) AS transactions, round(avg(amount), 6) AS avg_amount,
  round(stddev_samp(amount), 6) AS std_amount, min(amount) AS min_amount, max(amount) AS max_amount
FROM tx GROUP BY is_fraud""")
sql("split_balance", TX, f"SELECT {PART} AS part, is_fraud AS label, count(*) AS transactions FROM tx GROUP BY 1, 2")
sql("confusion_pivot", SCORED, """
SELECT is_fraud AS label, count(*) FILTER (WHERE predicted_fraud = 0) AS predicted_normal,
  count(*) FILTER (WHERE predicted_fraud = 1) AS predicted_fraud
FROM scored GROUP BY is_fraud""")

# --- Monitoring ---------------------------------------------------------------
COUNTS = SCORED + """,
counts AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE is_fraud = 1 AND predicted_fraud = 1) AS tp,
    count(*) FILTER (WHERE is_fraud = 0 AND predicted_fraud = 1) AS fp,
    count(*) FILTER (WHERE is_fraud = 0 AND predicted_fraud = 0) AS tn,
    count(*) FILTER (WHERE is_fraud = 1 AND predicted_fraud = 0) AS fn
  FROM scored
),
quotients AS (
  SELECT *, (tp + tn) / n AS acc, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END AS prec,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END AS rec,
    CASE WHEN 2*tp + fp + fn > 0 THEN 2*tp / (2*tp + fp + fn) ELSE 0e0 END AS f
  FROM counts
)"""
sql("kpi_summary", SCORED, """
SELECT count(*) AS total_transactions, count(*) FILTER (WHERE predicted_fraud = 1) AS frauds_detected,
  round(sum(amount), 4) AS total_amount,
  round(coalesce(sum(amount) FILTER (WHERE predicted_fraud = 1), 0), 4) AS fraud_amount,
  round(avg(fraud_score), 6) AS avg_fraud_score,
  round(count(*) FILTER (WHERE predicted_fraud = 1) / count(*) * 100e0, 6) AS fraud_rate_pct
FROM scored""")
sql("detection_metrics", COUNTS, """
SELECT tp, fp, tn, fn, round(acc, 9) AS accuracy, round(prec, 9) AS "precision", round(rec, 9) AS recall,
  round(f, 9) AS f1
FROM quotients""")
sql("detection_metrics_long", COUNTS, """
SELECT 'accuracy' AS metric, round(acc * 100, 6) AS value FROM quotients
UNION ALL SELECT 'precision', round(prec * 100, 6) FROM quotients
UNION ALL SELECT 'recall', round(rec * 100, 6) FROM quotients
UNION ALL SELECT 'f1', round(f * 100, 6) FROM quotients""")
sql("confusion_matrix", COUNTS, """
SELECT 0 AS actual, 0 AS predicted, tn AS transactions FROM counts
UNION ALL SELECT 0, 1, fp FROM counts UNION ALL SELECT 1, 0, fn FROM counts UNION ALL SELECT 1, 1, tp FROM counts""")
sql("timeline_5min", SCORED, """
SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp", TIMESTAMP '1970-01-01') AS bucket, count(*) AS total,
  count(*) FILTER (WHERE predicted_fraud = 1) AS frauds, count(*) FILTER (WHERE predicted_fraud = 0) AS normal
FROM scored GROUP BY 1""")
sql("timeline_1min", SCORED, """
SELECT date_trunc('minute', "timestamp") AS bucket, predicted_fraud AS "class", count(*) AS transactions
FROM scored GROUP BY 1, 2""")
sql("fraud_rate_gauge", SCORED, """
SELECT round(rate, 6) AS fraud_rate_pct, round(rate - 5, 6) AS delta_pct,
  CASE WHEN rate < 3 THEN 'low' WHEN rate < 7 THEN 'watch' ELSE 'high' END AS band
FROM (SELECT count(*) FILTER (WHERE predicted_fraud = 1) / count(*) * 100e0 AS rate FROM scored) r""")
BOX = """count({v}) AS n, min({v}) AS min_value, max({v}) AS max_value, round(avg({v}), 6) AS mean_value,
  round(stddev_samp({v}), 6) AS sd_value, round(quantile_cont({v}, 0.25), 6) AS q1,
  round(quantile_cont({v}, 0.5), 6) AS median, round(quantile_cont({v}, 0.75), 6) AS q3"""
sql("score_box_by_band", SCORED, f"""
SELECT CASE WHEN fraud_score < 30 THEN 'SAFE' WHEN fraud_score < 50 THEN 'LOW' WHEN fraud_score < 70 THEN 'MEDIUM'
  ELSE 'HIGH' END AS band, {BOX.format(v="fraud_score")}
FROM scored GROUP BY 1""")
BIN = "CAST(least(floor(fraud_score / 5) + 1, 20) AS INTEGER)"
CLASS = "CASE WHEN predicted_fraud = 1 THEN 'fraud' ELSE 'normal' END"
sql("score_histogram", SCORED, f"""
SELECT bin, (bin - 1) * 5e0 AS bin_start, transactions
FROM (SELECT {BIN} AS bin, count(*) AS transactions FROM scored GROUP BY 1) b""")
sql("score_dist_by_class", SCORED, f"""
SELECT {CLASS} AS "class", {BIN} AS bin, count(*) AS transactions FROM scored GROUP BY 1, 2""")
sql("score_quantiles_by_class", SCORED, f"""
SELECT {CLASS} AS "class", round(quantile_cont(fraud_score, 0.05), 6) AS p05,
  round(quantile_cont(fraud_score, 0.25), 6) AS q1, round(quantile_cont(fraud_score, 0.5), 6) AS median,
  round(quantile_cont(fraud_score, 0.75), 6) AS q3, round(quantile_cont(fraud_score, 0.95), 6) AS p95
FROM scored GROUP BY 1""")
sql("risk_level_counts", SCORED, "SELECT risk_level, count(*) AS transactions FROM scored GROUP BY 1")
sql("fraud_rate_by_category", SCORED, """
SELECT merchant_category, count(*) FILTER (WHERE predicted_fraud = 1) AS frauds, count(*) AS total,
  round_even(count(*) FILTER (WHERE predicted_fraud = 1) / count(*) * 100, 1) AS rate
FROM scored GROUP BY 1""")
sql("amount_box_by_class", SCORED, f"SELECT {CLASS} AS \"class\", {BOX.format(v='amount')} FROM scored GROUP BY 1")
sql("hourly_pattern", SCORED, """
SELECT hour_of_day AS "hour", predicted_fraud AS "class", count(*) AS transactions FROM scored GROUP BY 1, 2""")
sql("category_rollup", SCORED, f"""
SELECT merchant_category, "class", count(*) AS transactions,
  CAST(grouping(merchant_category, "class") AS INTEGER) AS "level"
FROM (SELECT merchant_category, {CLASS} AS "class" FROM scored) c GROUP BY ROLLUP (merchant_category, "class")""")
sql("day_hour_heatmap", SCORED, """
SELECT CAST(d AS INTEGER) AS "day", CAST(h AS INTEGER) AS "hour", count(transaction_id) AS frauds
FROM range(7) a(d) CROSS JOIN range(24) b(h)
LEFT JOIN scored ON predicted_fraud = 1 AND isodow("timestamp") - 1 = d AND hour("timestamp") = h
GROUP BY 1, 2""")
sql("daily_trend", SCORED, """
SELECT "day", frauds, round(avg(frauds) OVER (ORDER BY "day" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6)
  AS moving_avg
FROM (SELECT CAST("timestamp" AS DATE) AS "day", count(*) AS frauds FROM scored WHERE predicted_fraud = 1 GROUP BY 1) d""")
sql("alert_funnel", SCORED, """
, raw AS (
  SELECT count(*) AS s0, count(*) FILTER (WHERE fraud_score >= 70) AS s1,
    count(*) FILTER (WHERE predicted_fraud = 1) AS s2,
    count(*) FILTER (WHERE is_fraud = 1 AND predicted_fraud = 1) AS s3 FROM scored
), stages AS (
  SELECT 0 AS stage_no, 'transactions' AS stage, s0 AS v FROM raw
  UNION ALL SELECT 1, 'high_scores', s1 FROM raw UNION ALL SELECT 2, 'alerts', s2 FROM raw
  UNION ALL SELECT 3, 'confirmed', s3 FROM raw
  UNION ALL SELECT 4, 'actions', CAST(floor(s3 * 0.6e0) AS BIGINT) FROM raw
), capped AS (
  SELECT stage_no, stage, min(v) OVER (ORDER BY stage_no) AS transactions FROM stages
)
SELECT stage_no, stage, transactions,
  round(transactions / nullif(lag(transactions) OVER (ORDER BY stage_no), 0) * 100, 6) AS step_pct
FROM capped""")
RANKED = SCORED + """,
by_score AS (
  SELECT fraud_score AS threshold, count(*) FILTER (WHERE is_fraud = 1) AS pos,
    count(*) FILTER (WHERE is_fraud = 0) AS neg FROM scored GROUP BY 1
),
curve AS (
  SELECT threshold, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
    sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM by_score WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
points AS (SELECT threshold, tp, fp, tp / p AS tpr, fp / n AS fpr FROM curve)"""
sql("roc_curve", RANKED, "SELECT threshold, tp, fp, round(tpr, 9) AS tpr, round(fpr, 9) AS fpr FROM points")
sql("roc_auc", RANKED, """
SELECT round(sum((fpr - prev_fpr) * (tpr + prev_tpr) / 2), 9) AS auc
FROM (SELECT fpr, tpr, coalesce(lag(fpr) OVER w, 0) AS prev_fpr, coalesce(lag(tpr) OVER w, 0) AS prev_tpr
      FROM points WINDOW w AS (ORDER BY threshold DESC)) s""")
sql("throughput_summary", TX, """
SELECT *, round(frauds / transactions * 100, 6) AS fraud_pct,
  (epoch_us(last_seen) - epoch_us(first_seen)) / 1e6 AS elapsed_seconds,
  round(transactions / ((epoch_us(last_seen) - epoch_us(first_seen)) / 1e6), 9) AS tps
FROM (SELECT count(*) AS transactions, count(*) FILTER (WHERE is_fraud = 1) AS frauds,
        count(DISTINCT user_id) AS users, min("timestamp") AS first_seen, max("timestamp") AS last_seen FROM tx) s""")

# --- Investigation ------------------------------------------------------------
sql("recent_alerts", SCORED, """
SELECT transaction_id, user_id, "timestamp", amount, merchant_category, fraud_score, risk_level
FROM scored WHERE predicted_fraud = 1 ORDER BY "timestamp" DESC, transaction_id LIMIT 15""")
sql("top_suspicious", SCORED, """
SELECT transaction_id, amount, merchant_category, fraud_score, risk_level, predicted_fraud
FROM scored ORDER BY fraud_score DESC, transaction_id LIMIT 10""")
TOP = SCORED + """,
bad AS (SELECT * FROM scored WHERE predicted_fraud = 1),
users AS (SELECT user_id, count(*) AS frauds FROM bad GROUP BY 1),
merchants AS (SELECT merchant_id, count(*) AS frauds FROM bad GROUP BY 1)"""
sql("top_fraud_users", TOP, "SELECT user_id, frauds FROM users ORDER BY frauds DESC, user_id LIMIT 10")
sql("fraud_points", TOP, "SELECT transaction_id, location_lat, location_lon, amount, fraud_score FROM bad")
sql("user_sequences", TOP, """
SELECT user_id, CAST(NULL AS INTEGER) AS lane, transaction_id, "timestamp", amount, predicted_fraud AS "class",
  round(CASE WHEN predicted_fraud = 1 THEN least(25e0, greatest(10e0, amount / 25))
    ELSE least(20e0, greatest(6e0, amount / 30)) END, 9) AS marker_size
FROM scored WHERE user_id IN (SELECT user_id FROM users)""")
sql("user_sequences_chart", TOP, """
SELECT user_id, lane, transaction_id, "timestamp", amount, predicted_fraud AS "class",
  round(CASE WHEN predicted_fraud = 1 THEN least(25e0, greatest(10e0, amount / 25))
    ELSE least(20e0, greatest(6e0, amount / 30)) END, 9) AS marker_size
FROM scored JOIN (SELECT user_id, CAST(row_number() OVER (ORDER BY frauds DESC, user_id) - 1 AS INTEGER) AS lane
                  FROM users ORDER BY frauds DESC, user_id LIMIT 8) l USING (user_id)""")
sql("fraud_edges", TOP, "SELECT user_id, merchant_id, count(*) AS weight FROM bad GROUP BY 1, 2")
ALL_EDGES = TOP + """,
edges AS (SELECT user_id, merchant_id, count(*) AS weight FROM bad GROUP BY 1, 2)"""
EDGES = TOP + """,
edges AS (
  SELECT user_id, merchant_id, count(*) AS weight FROM bad
  WHERE user_id IN (SELECT user_id FROM users ORDER BY frauds DESC, user_id LIMIT 10)
    AND merchant_id IN (SELECT merchant_id FROM merchants ORDER BY frauds DESC, merchant_id LIMIT 8)
    AND (SELECT count(*) FROM bad) > 5
  GROUP BY 1, 2
)"""
sql("fraud_edges_chart", EDGES, "SELECT * FROM edges")
sql("fraud_node_degree", ALL_EDGES, """
SELECT 'user' AS kind, user_id AS node, count(*) AS degree, CAST(sum(weight) AS BIGINT) AS weighted_degree
FROM edges GROUP BY user_id
UNION ALL SELECT 'merchant', merchant_id, count(*), CAST(sum(weight) AS BIGINT) FROM edges GROUP BY merchant_id""")
sql("geo_anomalies", SCORED, """
, steps AS (
  SELECT *, lag("timestamp") OVER o AS pt, lag(location_lat) OVER o AS plat, lag(location_lon) OVER o AS plon
  FROM scored WHERE user_id IN (SELECT user_id FROM scored WHERE predicted_fraud = 1)
  WINDOW o AS (PARTITION BY user_id ORDER BY "timestamp", transaction_id)
), moves AS (
  SELECT *, sqrt(pow(location_lat - plat, 2) + pow(location_lon - plon, 2)) * 111 AS km,
    (epoch_us("timestamp") - epoch_us(pt)) / 3.6e9 AS hours FROM steps
)
SELECT transaction_id, user_id, location_lat, location_lon, round(km, 6) AS distance_km,
  round(least(km / hours, 5000e0), 6) AS speed_kmh, predicted_fraud AS "class"
FROM moves WHERE hours > 0 AND km > 0 AND km / hours > 800""")
sql("api_extract", SCORED, """
SELECT transaction_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') AS time_text, amount, fraud_score, risk_level
FROM scored""")

# --- Patterns -----------------------------------------------------------------
PATTERNS = PAST + DIM + """,
first_use AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, device_id ORDER BY "timestamp", transaction_id) AS use_no,
    row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", transaction_id) AS user_no FROM tx
),
hits AS (
  SELECT transaction_id, user_id, amount, 'high_amount' AS pattern
  FROM tx JOIN dim USING (merchant_category) WHERE amount >= 10 * category_avg
  UNION ALL SELECT transaction_id, user_id, amount, 'rapid_succession' FROM past WHERE burst_count >= 5
  UNION ALL SELECT transaction_id, user_id, amount, 'geographic_impossible' FROM past
    WHERE raw_distance >= 500 AND timestamp_epoch - prev_epoch <= 1800
  UNION ALL SELECT transaction_id, user_id, amount, 'unusual_time' FROM tx WHERE hour("timestamp") IN (2, 3, 4)
  UNION ALL SELECT transaction_id, user_id, amount, 'new_device' FROM first_use
    WHERE use_no = 1 AND user_no > 1 AND amount >= 200
)"""
sql("pattern_high_amount", TX + DIM, """
SELECT transaction_id, merchant_category, amount, category_avg FROM tx JOIN dim USING (merchant_category)
WHERE amount >= 10 * category_avg""")
sql("pattern_rapid_succession", PAST, """
SELECT transaction_id, user_id, "timestamp", burst_count FROM past WHERE burst_count >= 5""")
sql("pattern_geo_impossible", PAST, """
SELECT transaction_id, user_id, round(raw_distance, 6) AS distance_km, timestamp_epoch - prev_epoch AS gap_seconds
FROM past WHERE raw_distance >= 500 AND timestamp_epoch - prev_epoch <= 1800""")
sql("pattern_unusual_time", TX, """
SELECT transaction_id, user_id, "timestamp", amount FROM tx WHERE hour("timestamp") IN (2, 3, 4)""")
sql("pattern_new_device", PATTERNS, """
SELECT transaction_id, user_id, "timestamp", device_id, amount FROM first_use
WHERE use_no = 1 AND user_no > 1 AND amount >= 200""")
sql("pattern_hits", PATTERNS, "SELECT transaction_id, user_id, pattern FROM hits")
sql("pattern_summary", PATTERNS, """
SELECT pattern, count(*) AS transactions, count(DISTINCT user_id) AS users, round(sum(amount), 4) AS total_amount
FROM hits GROUP BY 1""")

# --- Streams ------------------------------------------------------------------
# The watermark has millisecond precision and trails the newest event by ten minutes.
MARK = """(SELECT date_trunc('millisecond', max("timestamp")) - INTERVAL 10 MINUTE FROM tx)"""
sql("stream_scored_memory", SCORED, """
SELECT risk_level, predicted_fraud, is_fraud, count(*) AS transactions FROM scored GROUP BY 1, 2, 3""")
sql("stream_scored_parquet", SCORED, RULE_OUTPUT)
sql("stream_fanout", SCORED, RULE_OUTPUT)
sql("stream_restart_exact", SCORED, RULE_OUTPUT)
sql("stream_user_window", USER_WINDOWS, f"""
SELECT *, window_start + INTERVAL 1 HOUR AS window_end FROM stats WHERE window_start + INTERVAL 1 HOUR <= {MARK}""")
sql("stream_behavioural", BEHAVED, BEHAVIOUR_OUTPUT + f"""
 WHERE date_trunc('second', "timestamp") < date_trunc('second', {MARK})""")
# Confirmations that come within seven days.
TOLD = SCORED + """,
told AS (
  SELECT s.* EXCLUDE (is_fraud), c.label, c.confirmed_at,
    CASE c.label WHEN 1 THEN 'confirmed' WHEN 0 THEN 'refuted' ELSE 'unconfirmed' END AS outcome
  FROM scored s LEFT JOIN (
    SELECT transaction_id, is_fraud AS label, "timestamp" + to_hours(CAST(n * 13 % 200 AS INTEGER)) AS confirmed_at
    FROM (SELECT *, CAST(substr(transaction_id, 5) AS BIGINT) AS n FROM tx) t WHERE n % 10 < 8
  ) c ON s.transaction_id = c.transaction_id AND c.confirmed_at <= s."timestamp" + INTERVAL 7 DAY
)"""
OUTCOME = """
SELECT transaction_id, "timestamp", amount, predicted_fraud, outcome, confirmed_at,
  CASE WHEN label = 1 AND predicted_fraud = 1 THEN 1 ELSE 0 END AS true_positive,
  CASE WHEN label = 0 AND predicted_fraud = 1 THEN 1 ELSE 0 END AS false_positive,
  CASE WHEN label = 0 AND predicted_fraud = 0 THEN 1 ELSE 0 END AS true_negative,
  CASE WHEN label = 1 AND predicted_fraud = 0 THEN 1 ELSE 0 END AS false_negative
FROM told"""
sql("late_labels", TOLD, OUTCOME)
sql("late_label_report", TOLD, """
SELECT predicted_fraud, outcome, count(*) AS transactions, round(sum(amount), 4) AS total_amount,
  round(avg((epoch_us(confirmed_at) // 1000000 - epoch_us("timestamp") // 1000000) / 3600e0), 6) AS avg_delay_hours
FROM told GROUP BY 1, 2""")
sql("stream_late_labels", TOLD, OUTCOME + f"""
 WHERE outcome <> 'unconfirmed' OR "timestamp" + INTERVAL 7 DAY < {MARK}""")
sql("stream_live_kpis", SCORED, """
SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp", TIMESTAMP '1970-01-01') AS bucket, count(*) AS total,
  count(*) FILTER (WHERE predicted_fraud = 1) AS frauds, round(sum(amount), 4) AS total_amount,
  round(avg(fraud_score), 6) AS avg_fraud_score
FROM scored GROUP BY 1""")
sql("stream_dedup", TX, 'SELECT transaction_id, user_id, "timestamp", amount FROM tx')

# --- Summaries ------------------------------------------------------------------
sql("fraud_rings", "RECURSIVE " + ALL_EDGES.strip() + """,
links AS (SELECT user_id AS a, merchant_id AS b FROM edges UNION ALL SELECT merchant_id, user_id FROM edges),
reach(node, ring) AS (
  SELECT a, a FROM links
  UNION SELECT l.b, r.ring FROM reach r JOIN links l ON l.a = r.node AND r.ring < l.b
),
found AS (SELECT node, min(ring) AS ring FROM reach GROUP BY 1)""", """
SELECT node, ring, count(*) OVER (PARTITION BY ring) AS ring_nodes,
  (SELECT CAST(sum(weight) AS BIGINT) FROM edges e JOIN found u ON u.node = e.user_id WHERE u.ring = f.ring) AS ring_frauds
FROM found f""")
# The edges left of each round, as one list.
sql("fraud_core", "RECURSIVE " + ALL_EDGES.strip() + """,
rounds(n, es) AS (
  SELECT 0, list({'a': merchant_id, 'b': user_id}) FROM edges
  UNION ALL
  SELECT n + 1, left_over FROM (
    SELECT n, es, coalesce((
      SELECT list(e) FROM (
        SELECT e, count(*) OVER (PARTITION BY e.a) AS da, count(*) OVER (PARTITION BY e.b) AS db FROM (SELECT unnest(es) AS e)
      ) WHERE da >= 2 AND db >= 2), []) AS left_over
    FROM rounds
  ) WHERE len(left_over) < len(es)
), kept AS (SELECT unnest(es) AS e FROM (SELECT es FROM rounds ORDER BY n DESC LIMIT 1))""", """
SELECT node, count(*) AS degree FROM (SELECT e.a AS node FROM kept UNION ALL SELECT e.b FROM kept) GROUP BY 1""")
sql("fraud_tiles", TOP, """
, placed AS (
  SELECT amount, fraud_score,
    CAST(greatest(least(floor((location_lon + 180) / 360 * 256), 255), 0) AS BIGINT) AS px,
    CAST(greatest(least(floor((90 - location_lat) / 180 * 256), 255), 0) AS BIGINT) AS py
  FROM bad
), levels AS (
  SELECT CAST(z AS INTEGER) AS zoom, px // CAST(2 ** (8 - z) AS BIGINT) AS x, py // CAST(2 ** (8 - z) AS BIGINT) AS y, amount, fraud_score
  FROM placed, range(0, 9) AS r(z)
)
SELECT zoom, x, y, count(*) AS transactions, round(sum(amount), 4) AS total_amount, max(fraud_score) AS max_score,
  CAST(list_sum(list_transform(range(0, 8), lambda b: (x // CAST(2 ** b AS BIGINT)) % 2 * CAST(4 ** b AS BIGINT)
    + (y // CAST(2 ** b AS BIGINT)) % 2 * 2 * CAST(4 ** b AS BIGINT))) AS BIGINT) AS cell
FROM levels GROUP BY zoom, x, y""")
BURSTS = TX + """,
steps AS (
  SELECT *, lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", transaction_id) AS before FROM tx
), numbered AS (
  SELECT *, sum(CASE WHEN before IS NULL OR epoch_us("timestamp") - epoch_us(before) > 60000000 THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY "timestamp", transaction_id) AS number
  FROM steps
), found AS (
  SELECT user_id, min("timestamp") AS "start", max("timestamp") AS "end",
    round((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 1e6, 6) AS seconds,
    count(*) AS transactions, round(sum(amount), 4) AS total_amount
  FROM numbered GROUP BY user_id, number HAVING count(*) >= 2
)"""
sql("user_bursts", BURSTS, "SELECT * FROM found")
sql("stream_bursts", BURSTS, f"""SELECT * FROM found WHERE "end" + INTERVAL 60 SECOND < {MARK}""")
SKETCHED = """count(*) AS transactions, count(*) FILTER (WHERE predicted_fraud = 1) AS frauds,
  round(sum(amount), 4) AS total_amount, CAST(count(DISTINCT user_id) AS {users}) AS distinct_users,
  round(percentile_disc(0.25) WITHIN GROUP (ORDER BY amount), 6) AS q1,
  round(percentile_disc(0.5) WITHIN GROUP (ORDER BY amount), 6) AS median,
  round(percentile_disc(0.75) WITHIN GROUP (ORDER BY amount), 6) AS q3"""
# Groups of these tables are small enough for exact sketches.
sql("sketch_by_category", SCORED, f"SELECT merchant_category, {SKETCHED.format(users='BIGINT')} FROM scored GROUP BY 1")
sql("sketch_by_day", SCORED, f"""
, shops AS (
  SELECT CAST("timestamp" AS DATE) AS "day", merchant_id, count(*) AS n FROM scored GROUP BY 1, 2
), best AS (
  SELECT "day", merchant_id AS top_merchant, n AS top_count FROM shops
  QUALIFY row_number() OVER (PARTITION BY "day" ORDER BY n DESC, merchant_id) = 1
), days AS (
  SELECT CAST("timestamp" AS DATE) AS "day", {SKETCHED.format(users='BIGINT')} FROM scored
  WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-17' GROUP BY 1
)
SELECT * FROM days JOIN best USING ("day")""")
sql("serving_kpis", SCORED, """
SELECT count(*) AS total_transactions, count(*) FILTER (WHERE predicted_fraud = 1) AS frauds_detected,
  round(100e0 * count(*) FILTER (WHERE predicted_fraud = 1) / count(*), 6) AS fraud_rate_pct,
  round(sum(amount), 4) AS total_amount, round(avg(fraud_score), 6) AS avg_fraud_score
FROM scored""")
sql("serving_timeline", SCORED, """
SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp", TIMESTAMP '1970-01-01') AS bucket, count(*) AS total,
  count(*) FILTER (WHERE predicted_fraud = 1) AS frauds, count(*) FILTER (WHERE predicted_fraud = 0) AS normal
FROM scored GROUP BY 1""")
sql("serving_by_category", SCORED, """
SELECT merchant_category, count(*) FILTER (WHERE predicted_fraud = 1) AS frauds, count(*) AS total,
  round(count(*) FILTER (WHERE predicted_fraud = 1) / CAST(count(*) AS DOUBLE), 9) AS rate
FROM scored GROUP BY 1""")
sql("serving_hours", SCORED, """
SELECT CAST(hour("timestamp") AS INTEGER) AS "hour", count(*) AS total, count(*) FILTER (WHERE predicted_fraud = 1) AS frauds
FROM scored GROUP BY 1""")
