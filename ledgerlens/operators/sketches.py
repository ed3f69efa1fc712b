"""A store of mergeable summaries per time bucket and category.

Each bucket keeps counts and three sketches as columns: quantiles of the
amount (KLL), distinct users (theta) and the most frequent merchants. Sketches
of any buckets merge into one of their union, so a report on any period reads
the store and not the rows. All of them are aggregates with a partial step
before the shuffle; a merge holds one sketch per group and task.

Errors, for the default sizes: ranks of quantiles within 0.2 % of a group's
rows, distinct counts within 5 % (three standard errors), a merchant's count within
rows / (0.75 * ``TRACKED``) / 2. Below ``QUANTILE_K`` rows, 2**``DISTINCT_LG``
users and three quarters of ``TRACKED`` merchants a group's answers are exact.

Null amounts, users and merchants are counted as transactions and in no sketch;
a group without amounts has null quantiles. An empty table gives an empty store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.monitoring import count_rows, is_alert

QUANTILE_K = 4096
DISTINCT_LG = 12
TRACKED = 1024


def sketch_buckets(df: DataFrame, bucket: str = "5 minutes", fraud_col: str | None = None) -> DataFrame:
    """(bucket, merchant_category, transactions, frauds, total_amount, amounts, users, merchants), for tables and streams.

    A stream needs a watermark on ``timestamp``; a bucket is then emitted once
    it is closed.
    """
    alert = is_alert(df, fraud_col)
    return (
        df.groupBy(F.window("timestamp", bucket).alias("span"), "merchant_category")
        .agg(
            count_rows().alias("transactions"),
            F.count_if(alert).alias("frauds"),
            F.sum("amount").alias("total_amount"),
            F.kll_sketch_agg_double("amount", QUANTILE_K).alias("amounts"),
            F.theta_sketch_agg("user_id", DISTINCT_LG).alias("users"),
            F.expr(f"approx_top_k_accumulate(merchant_id, {TRACKED})").alias("merchants"),
        )
        .select(F.col("span.start").alias("bucket"), "merchant_category", "transactions", "frauds", "total_amount", "amounts", "users", "merchants")
    )


def write_store(sketches: DataFrame, path: str) -> None:
    """Write sketches by day, so that a period prunes folders."""
    sketches.withColumn("day", F.to_date("bucket")).hint("rebalance", F.col("day")).write.partitionBy("day").parquet(path)


def load_store(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The sketches of the days from ``start`` to ``end``, both included."""
    store = spark.read.parquet(path)
    if start is not None:
        store = store.filter(F.col("day") >= F.to_date(F.lit(start)))
    if end is not None:
        store = store.filter(F.col("day") <= F.to_date(F.lit(end)))
    return store


def merge(sketches: DataFrame, *keys) -> DataFrame:
    """One sketch per group of ``keys``; the result merges again."""
    return sketches.groupBy(*keys).agg(
        F.sum("transactions").alias("transactions"),
        F.sum("frauds").alias("frauds"),
        F.sum("total_amount").alias("total_amount"),
        F.expr("kll_merge_agg_double(amounts)").alias("amounts"),
        F.theta_union_agg("users", DISTINCT_LG).alias("users"),
        F.expr("approx_top_k_combine(merchants)").alias("merchants"),
    )


def answers(merged: DataFrame, top: int = 3) -> DataFrame:
    """Replace the sketches by distinct users, quartiles and the ``top`` merchants (ties go by id)."""
    found = F.expr(f"approx_top_k_estimate(merchants, {TRACKED})")
    ranked = F.array_sort(F.transform(found, lambda x: F.struct((-x["count"]).alias("minus"), x["item"].alias("item"))))

    def quantile(rank: float):
        known = F.kll_sketch_get_n_double("amounts") > 0
        return F.when(known, F.kll_sketch_get_quantile_double("amounts", F.lit(rank)))

    return merged.select(
        *[c for c in merged.columns if c not in ("amounts", "users", "merchants")],
        F.theta_sketch_estimate("users").alias("distinct_users"),
        quantile(0.25).alias("q1"),
        quantile(0.5).alias("median"),
        quantile(0.75).alias("q3"),
        F.transform(F.slice(ranked, 1, top), lambda x: x["item"]).alias("top_merchants"),
        F.transform(F.slice(ranked, 1, top), lambda x: -x["minus"]).alias("top_counts"),
    )


def common_users(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, common_users): an estimate of the users that both merged tables have seen, per ``key``."""
    both = left.select(key, F.col("users").alias("one")).join(right.select(key, F.col("users").alias("other")), key)
    return both.select(key, F.theta_sketch_estimate(F.theta_intersection("one", "other")).alias("common_users"))
