"""Event-time aggregates and deduplication on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.history import user_window_stats
from ledgerlens.operators.monitoring import count_rows, is_alert


def user_windows(stream: DataFrame, duration: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Statistics per user and tumbling window, emitted once a window is closed.

    The state holds one small buffer per open (user, window).
    """
    return user_window_stats(stream.withWatermark("timestamp", delay), duration)


def live_kpis(
    scored: DataFrame, bucket: str = "5 minutes", delay: str = "10 minutes", fraud_col: str | None = None
) -> DataFrame:
    """Running headline numbers per time bucket, for update or complete mode.

    In update and append mode the watermark lets closed buckets leave the state.
    """
    alert = is_alert(scored, fraud_col)
    kpis = (
        scored.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", bucket).alias("span"))
        .agg(
            count_rows().alias("total"),
            F.count_if(alert).alias("frauds"),
            F.sum("amount").alias("total_amount"),
            F.avg("fraud_score").alias("avg_fraud_score"),
        )
    )
    return kpis.select(F.col("span.start").alias("bucket"), "total", "frauds", "total_amount", "avg_fraud_score")


def deduplicate(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Let each transaction id through once; ids are forgotten after ``delay``."""
    return stream.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["transaction_id"])
