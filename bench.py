"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A query's time covers building it (including stream runs and model training)
and producing every row of its result.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerlens.functions.features import assemble, model_features
from ledgerlens.operators import model, scoring
from ledgerlens.plans import QUERIES
from ledgerlens.session import get_session
from ledgerlens.sources.events import transactions

HEADLINE = [
    "parse_json_messages",
    "quarantine_counts",
    "history_roundtrip",
    "history_month_slice",
    "merchant_enrich",
    "feat_rule_set",
    "feat_model_set",
    "feat_behavioural_set",
    "feat_user_window",
    "scored_output",
    "scored_output_behavioural",
    "kpi_summary",
    "detection_metrics",
    "timeline_5min",
    "score_box_by_band",
    "amount_box_by_class",
    "fraud_rate_by_category",
    "category_rollup",
    "day_hour_heatmap",
    "daily_trend",
    "user_sequences",
    "fraud_node_degree",
    "geo_anomalies",
    "alert_funnel",
    "roc_auc",
    "pattern_summary",
    "stream_scored_parquet",
    "stream_user_window",
    "stream_behavioural",
    "stream_live_kpis",
    "stream_dedup",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "ledgerlens-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        log_level="ERROR",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    rows = transactions(spark, sf_dir).count()
    consume(QUERIES["scored_output"](spark, sf_dir))  # warm-up: class loading and the file cache

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        seconds[name] = timed(lambda: consume(QUERIES[name](spark, sf_dir)))
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)

    # The published parameter set of the model (50 trees, depth 8).
    tx = transactions(spark, sf_dir)
    train, test = model.split(tx)
    held: list = []
    seconds["model_train_50x8"] = timed(lambda: held.append(model.train_forest(train, **model.NOTEBOOK_PARAMS)))
    seconds["model_score"] = timed(lambda: consume(scoring.model_output(tx, held[0])))
    metrics: dict[str, float] = {}
    predictions = scoring.model_output(test, held[0])
    seconds["model_evaluate"] = timed(
        lambda: metrics.update({r["metric"]: round(r["value"], 5) for r in model.evaluate(predictions).collect()})
    )
    seconds["model_vectors"] = timed(lambda: consume(assemble(model_features(tx))))

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "transactions": rows,
                "rows_per_second": {
                    name: round(rows / seconds[name])
                    for name in ("scored_output", "stream_scored_parquet", "stream_behavioural", "model_train_50x8", "model_score")
                },
                "model_metrics": metrics,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
