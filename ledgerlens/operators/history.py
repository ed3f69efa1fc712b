"""Behavioural features: a transaction against the user's own past."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.features import add, amount_columns, flag, merchant_columns, time_columns
from ledgerlens.operators.slices import (
    DEFAULT_POLICY,
    HotPolicy,
    by_order,
    drop_carry,
    last_seconds,
    with_slices,
)

# --- Fixed values ------------------------------------------------------------
NO_PREVIOUS_GAP = 999999
RAPID_GAP_SECONDS = 60
COUNT_WINDOW_SECONDS = 300
KM_PER_DEGREE = 111
TRAVEL_KM, TRAVEL_SECONDS = 100, 3600
# --- end of fixed values -----------------------------------------------------


def gap_seconds() -> Column:
    return F.unix_timestamp("timestamp") - F.unix_timestamp("prev_timestamp")


def planar_km() -> Column:
    """Distance to the previous place on a plane of degrees."""
    north = F.col("location_lat") - F.col("prev_lat")
    east = F.col("location_lon") - F.col("prev_lon")
    return F.sqrt(F.pow(north, F.lit(2)) + F.pow(east, F.lit(2))) * KM_PER_DEGREE


PREVIOUS = {
    "prev_timestamp": "timestamp",
    "prev_lat": "location_lat",
    "prev_lon": "location_lon",
    "prev_device": "device_id",
}


def with_previous(
    df: DataFrame,
    previous: list[str],
    counts: dict[str, int] | None = None,
    policy: HotPolicy | None = DEFAULT_POLICY,
) -> DataFrame:
    """Add columns of the user's previous transaction and range counts.

    ``counts`` maps a column name to a number of seconds. All of it needs one
    exchange and one sort of the table, and neither if ``df`` is a layout
    (``sinks.layout``), which is sliced already.
    """
    counts = counts or {}
    if "is_carry" in df.columns:
        sliced = df
    else:
        sliced = with_slices(df, [PREVIOUS[p] for p in previous], max(counts.values(), default=0), policy)
    order = by_order()
    sliced = sliced.select("*", *[F.lag(PREVIOUS[p]).over(order).alias(p) for p in previous])
    if counts:
        sliced = sliced.select(
            "*", *[F.sum("weight").over(last_seconds(s)).alias(name) for name, s in counts.items()]
        )
    return drop_carry(sliced)


def _gap_columns() -> dict[str, Column]:
    gap = F.coalesce(gap_seconds(), F.lit(NO_PREVIOUS_GAP).cast("long"))
    return {"time_since_last_txn": gap, "is_rapid_transaction": flag(gap < RAPID_GAP_SECONDS)}


def _travel_columns() -> dict[str, Column]:
    distance = F.coalesce(planar_km(), F.lit(0.0))
    gap = F.coalesce(gap_seconds(), F.lit(NO_PREVIOUS_GAP).cast("long"))
    return {
        "distance_from_prev": distance,
        "is_impossible_travel": flag((distance > TRAVEL_KM) & (gap < TRAVEL_SECONDS)),
    }


def _device_columns() -> dict[str, Column]:
    return {"device_changed": flag(F.col("device_id") != F.col("prev_device"))}


def velocity_features(df: DataFrame, policy: HotPolicy | None = DEFAULT_POLICY) -> DataFrame:
    """Gap to the previous transaction and count of the last five minutes."""
    past = with_previous(df, ["prev_timestamp"], {"txn_count_5min": COUNT_WINDOW_SECONDS}, policy)
    return add(past.withColumnRenamed("second", "timestamp_seconds"), _gap_columns())


def location_features(df: DataFrame, policy: HotPolicy | None = DEFAULT_POLICY) -> DataFrame:
    """Distance to the previous place and the impossible-travel flag."""
    past = with_previous(df, ["prev_timestamp", "prev_lat", "prev_lon"], policy=policy)
    return add(past.drop("second"), _travel_columns())


def device_features(df: DataFrame, policy: HotPolicy | None = DEFAULT_POLICY) -> DataFrame:
    """The previous device and whether it differs."""
    return add(with_previous(df, ["prev_device"], policy=policy).drop("second"), _device_columns())


def behaviour_features(df: DataFrame, policy: HotPolicy | None = DEFAULT_POLICY) -> DataFrame:
    """Time, amount, velocity, location, device and merchant features at once."""
    past = with_previous(df, list(PREVIOUS), {"txn_count_5min": COUNT_WINDOW_SECONDS}, policy)
    amounts = amount_columns()
    return add(
        past.withColumnRenamed("second", "timestamp_seconds"),
        {
            **time_columns(),
            "amount_log": amounts["amount_log"],
            "amount_category": amounts["amount_category"],
            **_gap_columns(),
            **_travel_columns(),
            **_device_columns(),
            "is_high_risk_merchant": merchant_columns()["is_high_risk_merchant"],
        },
    )


def user_window_stats(df: DataFrame, duration: str = "1 hour") -> DataFrame:
    """Amount statistics per user and tumbling window; works on streams too."""
    return (
        df.groupBy("user_id", F.window("timestamp", duration).alias("span"))
        .agg(
            F.count("transaction_id").alias("txn_count_window"),
            F.avg("amount").alias("avg_amount_window"),
            F.max("amount").alias("max_amount_window"),
            F.min("amount").alias("min_amount_window"),
            F.stddev("amount").alias("std_amount_window"),
            F.sum("amount").alias("total_amount_window"),
        )
        .select(
            "user_id",
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "txn_count_window",
            "avg_amount_window",
            "max_amount_window",
            "min_amount_window",
            "std_amount_window",
            "total_amount_window",
        )
    )


def user_window_features(df: DataFrame, duration: str = "1 hour") -> DataFrame:
    """Each transaction with the statistics of its own user window.

    The statistics are reduced map-side before they are shuffled. A join brings
    them back rather than a window function, because a join on an overlarge
    (user, window) is divided at run time and a window partition is not. Rows
    without a time lie in no window; they stay, with a null start.
    """
    stats = user_window_stats(df, duration)
    keyed = df.withColumn("window_start", F.window("timestamp", duration).getField("start"))
    joined = keyed.join(stats, ["user_id", "window_start"], "left")
    joined = joined.unionByName(df.filter(F.col("timestamp").isNull()), allowMissingColumns=True)
    return joined.fillna(0, subset=[c for c in stats.columns if c.endswith("amount_window") or c.startswith("txn")])
