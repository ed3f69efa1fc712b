"""Per-user history windows that do not put a whole user into one task.

A window partitioned by user sends every row of a user to one task. When one
user holds a large part of the table that task never ends. Here such *hot*
users are cut into time slices and each (user, slice) is a window partition of
its own; everybody else keeps a single slice 0. What a slice needs to know of
the rows before it arrives as a few *carry* rows:

* the last row of the user's previous non-empty slice (for ``lag``),
* one row per second of the look-back horizon with the number of transactions
  in that second as weight (for range counts).

Carry rows come from map-side reduced aggregates over the hot users only. Rows
and carry rows meet in a union, so the full table is shuffled once. Which users
are cut never changes the result, only how the work is divided.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, TIME, ID = "user_id", "timestamp", "transaction_id"


@dataclass(frozen=True)
class HotPolicy:
    """When a user is cut, and into how large pieces.

    A user is hot above ``min_rows`` rows and above ``1 / max_hot`` of the
    table. The second condition bounds the broadcast list: at most ``max_hot``
    users can each hold more than that share.
    """

    min_rows: int = 1_000_000
    max_hot: int = 100_000
    slice_rows: int = 500_000
    min_width: int = 60
    sample_rows: int = 2_000_000


DEFAULT_POLICY = HotPolicy()


def epoch() -> Column:
    return F.unix_timestamp(TIME)


def hot_users(df: DataFrame, policy: HotPolicy = DEFAULT_POLICY) -> DataFrame | None:
    """(user_id, width): hot users with their slice width in seconds, or None.

    Runs small jobs before the real one is planned, so that a table without hot
    users gets the plain plan. A table too small to have any costs one row
    count. Otherwise candidates are taken from counts on a sample, as only the
    rough share matters; their exact counts come from a scan of two columns.
    The width follows the user's busiest hour.
    """
    spark = df.sparkSession
    total = df.count()
    floor = max(policy.min_rows, total // policy.max_hot)
    if total <= floor:
        return None
    fraction = min(1.0, policy.sample_rows / total)
    keys = df.select(KEY).filter(F.col(KEY).isNotNull())
    sampled = keys if fraction == 1.0 else keys.sample(fraction, seed=7)
    counts = sampled.groupBy(KEY).count().filter(F.col("count") > floor * fraction / 2)
    candidates = counts.select(KEY).collect()  # at most 2 * max_hot rows
    if not candidates:
        return None
    listed = F.broadcast(spark.createDataFrame(candidates, f"{KEY} string"))
    hourly = df.join(listed, KEY, "left_semi").groupBy(KEY, F.floor(epoch() / 3600)).count()
    width = F.greatest(F.lit(policy.min_width), F.floor(3600 * policy.slice_rows / F.max("count")))
    hot = (
        hourly.groupBy(KEY)
        .agg(F.sum("count").alias("n"), width.cast("long").alias("width"))
        .filter(F.col("n") > floor)
        .select(KEY, "width")
        .collect()  # at most max_hot rows
    )
    return spark.createDataFrame(hot, f"{KEY} string, width long") if hot else None


def _slice_of(second: Column) -> Column:
    return F.floor(second / F.col("width"))


def with_slices(
    df: DataFrame,
    carry: list[str],
    horizon: int = 0,
    policy: HotPolicy | None = DEFAULT_POLICY,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Rows plus carry rows, with ``place``, ``slice``, ``second``, ``weight``, ``is_carry``.

    ``carry`` names the columns a later ``lag`` reads. With ``policy=None`` no
    user is cut (for data known to be free of hot users). A list of ``hot``
    users known beforehand saves the search for them.
    """
    if hot is None and policy:
        hot = hot_users(df, policy)
    second, zero, one = epoch(), F.lit(0).cast("long"), F.lit(1).cast("long")

    def rows(of: DataFrame, piece: Column) -> DataFrame:
        return of.select(
            *df.columns,
            piece.alias("slice"),
            second.alias("second"),
            one.alias("weight"),
            F.lit(False).alias("is_carry"),
        )

    def placed(of: DataFrame) -> DataFrame:
        # Sorts compare the first eight bytes of the leading key before anything
        # else. Ids share their prefix there; a hash of the key does not.
        return of.withColumn("place", F.xxhash64(KEY, "slice"))

    if hot is None:
        return placed(rows(df, zero))
    hot = F.broadcast(hot)
    hot_rows = df.join(hot, KEY).select(
        *df.columns, "width", second.alias("second"), _slice_of(second).alias("slice")
    )
    last = F.max(F.struct(TIME, ID, *[c for c in carry if c not in (TIME, ID)])).alias("last")

    # The last row of each slice, handed to the user's next non-empty slice.
    # Weight 0: it may lie within the horizon as well and must not count twice.
    carried = (
        hot_rows.groupBy(KEY, "slice")
        .agg(last)
        .select(
            KEY,
            F.lead("slice").over(Window.partitionBy(KEY).orderBy("slice")).alias("slice"),
            F.unix_timestamp(f"last.{TIME}").alias("second"),
            zero.alias("weight"),
            "last",
        )
        .filter(F.col("slice").isNotNull())
    )
    if horizon:
        # Seconds near the end of a slice, handed to every slice they reach.
        reach = _slice_of(F.col("second") + horizon)
        recent = (
            hot_rows.filter(reach > F.col("slice"))
            .groupBy(KEY, "width", "slice", "second")
            .agg(F.count(F.lit(1)).alias("weight"), last)
            .select(KEY, F.explode(F.sequence(F.col("slice") + 1, reach)).alias("slice"), "second", "weight", "last")
        )
        carried = carried.unionByName(recent)
    carried = carried.select(
        KEY,
        *[F.col(f"last.{c}").alias(c) for c in dict.fromkeys([TIME, ID, *carry]) if c != KEY],
        "slice",
        "second",
        "weight",
        F.lit(True).alias("is_carry"),
    )
    cut = rows(df.join(hot, KEY, "left"), F.coalesce(_slice_of(second), zero))
    return placed(cut.unionByName(carried, allowMissingColumns=True))


def by_order() -> Window:
    """Total order within a slice; `second` comes first so that the frame by
    second can reuse the same sort."""
    return Window.partitionBy("place", KEY, "slice").orderBy("second", TIME, ID)


def last_seconds(seconds: int) -> Window:
    """The current second and the ``seconds`` before it, ties included."""
    return Window.partitionBy("place", KEY, "slice").orderBy("second").rangeBetween(-seconds, 0)


def drop_carry(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_carry")).drop("place", "slice", "weight", "is_carry")
