"""Alerts, rankings, user sequences, the fraud graph and travel anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.history import planar_km, with_previous
from ledgerlens.operators.monitoring import count_rows, fraud_column, frauds, is_alert
from ledgerlens.operators.slices import DEFAULT_POLICY, HotPolicy


def recent_alerts(df: DataFrame, limit: int = 15, fraud_col: str | None = None) -> DataFrame:
    """The newest frauds; ties go by id."""
    return frauds(df, fraud_col).orderBy(F.desc("timestamp"), "transaction_id").limit(limit)


def top_suspicious(df: DataFrame, limit: int = 10) -> DataFrame:
    """The transactions with the highest scores; ties go by id."""
    return (
        df.select(
            "transaction_id", "amount", "merchant_category", "fraud_score", "risk_level", fraud_column(df)
        )
        .orderBy(F.desc("fraud_score"), "transaction_id")
        .limit(limit)
    )


def top_by_frauds(df: DataFrame, key: str, limit: int, fraud_col: str | None = None) -> DataFrame:
    """The ``limit`` keys with most frauds; ties go by key."""
    counts = frauds(df, fraud_col).groupBy(key).agg(count_rows().alias("frauds"))
    return counts.orderBy(F.desc("frauds"), key).limit(limit)


def top_fraud_users(df: DataFrame, limit: int = 10, fraud_col: str | None = None) -> DataFrame:
    return top_by_frauds(df, "user_id", limit, fraud_col)


def fraud_points(df: DataFrame, fraud_col: str | None = None) -> DataFrame:
    """Places, amounts and scores of the frauds."""
    return frauds(df, fraud_col).select("transaction_id", "location_lat", "location_lon", "amount", "fraud_score")


# Marker sizes, (divisor, smallest, largest).
NORMAL_MARK, FRAUD_MARK = (30, 6.0, 20.0), (25, 10.0, 25.0)


def user_sequences(df: DataFrame, users: int | None = None, fraud_col: str | None = None) -> DataFrame:
    """All transactions of every user with a fraud, with marker size.

    With ``users``, a limit for charts, only of the users with most frauds. They
    are numbered (``lane``) in one small window and broadcast; without it there
    are no lanes and ``lane`` is null.
    """
    if users is None:
        lanes = frauds(df, fraud_col).select("user_id", F.lit(None).cast("int").alias("lane")).distinct()
    else:
        top = top_by_frauds(df, "user_id", users, fraud_col)
        lane = F.row_number().over(Window.orderBy(F.desc("frauds"), "user_id")) - 1
        lanes = F.broadcast(top.select("user_id", lane.alias("lane")))

    def size(divisor: float, low: float, high: float):
        return F.least(F.lit(high), F.greatest(F.lit(low), F.col("amount") / divisor))

    mark = F.when(is_alert(df, fraud_col), size(*FRAUD_MARK)).otherwise(size(*NORMAL_MARK))
    return df.join(lanes, "user_id").select(
        "user_id",
        "lane",
        "transaction_id",
        "timestamp",
        "amount",
        F.col(fraud_column(df, fraud_col)).alias("class"),
        mark.alias("marker_size"),
    )


def fraud_edges(
    df: DataFrame,
    users: int | None = None,
    merchants: int | None = None,
    more_than: int = 0,
    fraud_col: str | None = None,
) -> DataFrame:
    """Weighted edges between fraud users and fraud merchants, all of them by default.

    ``users`` and ``merchants`` limit a chart to the leading ones, and
    ``more_than`` leaves it empty for too few frauds. Rankings and the total are
    sums over the frauds per (user, merchant). The limited key lists are
    broadcast. Ids are kept whole so that nodes stay distinct.
    """
    pairs = frauds(df, fraud_col).groupBy("user_id", "merchant_id").agg(count_rows().alias("weight"))
    if users is None and merchants is None and more_than == 0:
        return pairs

    def leading(key: str, limit: int) -> DataFrame:
        ranked = pairs.groupBy(key).agg(F.sum("weight").alias("frauds"))
        return F.broadcast(ranked.orderBy(F.desc("frauds"), key).limit(limit).select(key))

    total = pairs.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("n")).scalar()
    kept = pairs
    for key, limit in (("user_id", users), ("merchant_id", merchants)):
        kept = kept if limit is None else kept.join(leading(key, limit), key, "left_semi")
    return kept.filter(total > more_than).select("user_id", "merchant_id", "weight")


def node_degrees(edges: DataFrame) -> DataFrame:
    """Distinct neighbours and weight of each node; edges are read once."""
    ends = F.array(
        F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("node")),
        F.struct(F.lit("merchant").alias("kind"), F.col("merchant_id").alias("node")),
    )
    return (
        edges.select(F.explode(ends).alias("end"), "weight")
        .groupBy("end.kind", "end.node")
        .agg(count_rows().alias("degree"), F.sum("weight").alias("weighted_degree"))
    )


# Speed limits in km/h.
IMPOSSIBLE_SPEED, SHOWN_SPEED = 800, 5000


def geo_anomalies(
    df: DataFrame,
    fraud_col: str | None = None,
    max_users: int | None = None,
    max_rows_per_user: int | None = None,
    policy: HotPolicy | None = DEFAULT_POLICY,
) -> DataFrame:
    """Consecutive places of users with frauds that imply more than 800 km/h.

    Most users of a large table have some fraud, so the users are matched last,
    when only the few fast moves are left to be shuffled for it.

    The two limits of a chart (first users by id, first rows of each user) are
    off by default. The row limit is applied before the shuffle as well: Spark
    keeps only the first rows of a user on each side of it.
    """
    suspects = frauds(df, fraud_col).select("user_id").distinct()
    rows = df
    if max_users is not None:
        suspects = F.broadcast(suspects.orderBy("user_id").limit(max_users))
        rows = df.join(suspects, "user_id", "left_semi")
    if max_rows_per_user is not None:
        first = F.row_number().over(Window.partitionBy("user_id").orderBy("timestamp", "transaction_id"))
        rows = rows.withColumn("rn", first).filter(F.col("rn") <= max_rows_per_user).drop("rn")
    past = with_previous(rows, ["prev_timestamp", "prev_lat", "prev_lon"], policy=policy)
    hours = (F.unix_micros("timestamp") - F.unix_micros("prev_timestamp")) / F.lit(3.6e9)
    measured = past.select("*", planar_km().alias("distance_km"), hours.alias("hours"))
    moving = measured.filter((F.col("hours") > 0) & (F.col("distance_km") > 0))
    speed = F.col("distance_km") / F.col("hours")
    fast = moving.filter(speed > IMPOSSIBLE_SPEED).select(
        "transaction_id",
        "user_id",
        "location_lat",
        "location_lon",
        "distance_km",
        F.least(speed, F.lit(float(SHOWN_SPEED))).alias("speed_kmh"),
        F.col(fraud_column(df, fraud_col)).alias("class"),
    )
    return fast if max_users is not None else fast.join(suspects, "user_id", "left_semi")


def api_extract(df: DataFrame, after: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows as JSON documents with readable timestamps.

    Pages follow the transaction id: pass the last id of a page as ``after``.
    """
    page = df if after is None else df.filter(F.col("transaction_id") > after)
    if limit is not None:
        page = page.orderBy("transaction_id").limit(limit)
    fields = [
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if c == "timestamp" else F.col(c)
        for c in df.columns
    ]
    return page.select("transaction_id", F.to_json(F.struct(*fields)).alias("payload"))
