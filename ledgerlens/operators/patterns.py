"""Detectors for five fraud patterns, and their summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.history import gap_seconds, planar_km, with_previous
from ledgerlens.operators.slices import DEFAULT_POLICY, HotPolicy
from ledgerlens.sources.tables import merchant_dimension

# --- Fixed values: thresholds of the patterns --------------------------------
AMOUNT_MULTIPLIER = 10
BURST_COUNT, BURST_SECONDS = 5, 60
JUMP_KM, JUMP_MINUTES = 500, 30
UNUSUAL_HOURS = [2, 3, 4]
NEW_DEVICE_AMOUNT = 200
# --- end of fixed values -----------------------------------------------------


def _with_category_average(df: DataFrame) -> DataFrame:
    dim = merchant_dimension(df.sparkSession).select("merchant_category", "category_avg")
    return df.join(F.broadcast(dim), "merchant_category", "left")


def high_amount(df: DataFrame, multiplier: float = AMOUNT_MULTIPLIER) -> DataFrame:
    """Amounts of at least ``multiplier`` times the category's average."""
    return _with_category_average(df).filter(F.col("amount") >= multiplier * F.col("category_avg"))


def rapid_succession(
    df: DataFrame,
    count: int = BURST_COUNT,
    seconds: int = BURST_SECONDS,
    policy: HotPolicy | None = DEFAULT_POLICY,
) -> DataFrame:
    """Transactions that complete a burst: ``count`` or more within ``seconds``."""
    past = with_previous(df, [], {"burst_count": seconds}, policy)
    return past.drop("second").filter(F.col("burst_count") >= count)


def geographic_jump(
    df: DataFrame,
    km: float = JUMP_KM,
    minutes: float = JUMP_MINUTES,
    policy: HotPolicy | None = DEFAULT_POLICY,
) -> DataFrame:
    """At least ``km`` away from the previous place within ``minutes``."""
    past = with_previous(df, ["prev_timestamp", "prev_lat", "prev_lon"], policy=policy).drop("second")
    measured = past.select("*", planar_km().alias("distance_km"), gap_seconds().alias("gap_seconds"))
    return measured.filter((F.col("distance_km") >= km) & (F.col("gap_seconds") <= minutes * 60))


def unusual_time(df: DataFrame, hours: list[int] = UNUSUAL_HOURS) -> DataFrame:
    return df.filter(F.hour("timestamp").isin(hours))


def new_device(df: DataFrame, amount: float = NEW_DEVICE_AMOUNT) -> DataFrame:
    """First use of a further device, at ``amount`` or more.

    First uses are minima, which are reduced map-side; no user's rows have to
    be sorted together. The user's very first transaction is no new device; it
    is the earliest of the user's first uses, so the table is read once. The
    hash leads the grouping because ids share the prefix that sorts compare.
    """
    order = F.struct("timestamp", "transaction_id")
    place = F.xxhash64("user_id", "device_id").alias("place")
    first_use = df.groupBy(place, "user_id", "device_id").agg(
        F.min(F.struct(order.alias("at"), F.col("amount").alias("amount"))).alias("first")
    )
    first_of_user = first_use.groupBy("user_id").agg(F.min("first.at").alias("user_at"))
    return (
        first_use.filter(F.col("first.amount") >= amount)
        .join(first_of_user, "user_id")
        .filter(F.col("first.at") > F.col("user_at"))
        .select(
            F.col("first.at.transaction_id").alias("transaction_id"),
            "user_id",
            F.col("first.at.timestamp").alias("timestamp"),
            "device_id",
            F.col("first.amount").alias("amount"),
        )
    )


def pattern_hits(df: DataFrame, policy: HotPolicy | None = DEFAULT_POLICY) -> DataFrame:
    """One row per (transaction, pattern).

    Four patterns share one pass over the history; the new-device pattern is an
    aggregate of its own and joins by union.
    """
    past = with_previous(
        df, ["prev_timestamp", "prev_lat", "prev_lon"], {"burst_count": BURST_SECONDS}, policy
    ).drop("second")

    def named(name: str, condition: Column) -> Column:
        return F.when(condition, F.lit(name))

    found = F.array_compact(
        F.array(
            named("high_amount", F.col("amount") >= AMOUNT_MULTIPLIER * F.col("category_avg")),
            named("rapid_succession", F.col("burst_count") >= BURST_COUNT),
            named("geographic_impossible", (planar_km() >= JUMP_KM) & (gap_seconds() <= JUMP_MINUTES * 60)),
            named("unusual_time", F.hour("timestamp").isin(UNUSUAL_HOURS)),
        )
    )
    columns = ["transaction_id", "user_id", "timestamp", "amount", "pattern"]
    shared = _with_category_average(past).select("*", F.explode(found).alias("pattern")).select(*columns)
    devices = new_device(df).select("*", F.lit("new_device").alias("pattern")).select(*columns)
    return shared.unionByName(devices)


def pattern_summary(df: DataFrame, policy: HotPolicy | None = DEFAULT_POLICY) -> DataFrame:
    """Transactions, users and amount per pattern."""
    per_user = (
        pattern_hits(df, policy)
        .groupBy("pattern", "user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    )
    return per_user.groupBy("pattern").agg(
        F.sum("n").alias("transactions"),
        F.count(F.lit(1)).alias("users"),
        F.sum("amount").alias("total_amount"),
    )
