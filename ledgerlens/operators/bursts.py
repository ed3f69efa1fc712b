"""Bursts: runs of a user's transactions without a longer pause.

In a table, a transaction opens a burst when the user's previous one lies more
than the gap before it; bursts are numbered by running sums. Hot users are cut
into time slices, numbered by slice, and the numbers of the slices are added up
afterwards, so that a burst may cross any number of slices. On a stream a
session window keeps the open bursts of each user as state.

Rows without user or timestamp belong to no burst; a pause of exactly the gap
does not end one; null amounts add nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.monitoring import count_rows
from ledgerlens.operators.slices import DEFAULT_POLICY, ID, KEY, TIME, HotPolicy, by_order, hot_users, with_slices

GAP_SECONDS = 60


def _measures() -> list[Column]:
    return [F.min(TIME).alias("start"), F.max(TIME).alias("end"), count_rows().alias("transactions"), F.sum("amount").alias("total_amount")]


def _with_length(found: DataFrame, least: int) -> DataFrame:
    length = (F.unix_micros("end") - F.unix_micros("start")) / 1e6
    return found.filter(F.col("transactions") >= least).select(
        KEY, "start", "end", length.alias("seconds"), "transactions", "total_amount"
    )


def bursts(df: DataFrame, gap_seconds: int = GAP_SECONDS, least: int = 2, policy: HotPolicy | None = DEFAULT_POLICY) -> DataFrame:
    """(user_id, start, end, seconds, transactions, total_amount) of the bursts of ``least`` transactions or more.

    One exchange and one sort of the table; cut users add an exchange of bursts.
    """
    rows = df.select(KEY, TIME, ID, "amount").filter(F.col(KEY).isNotNull() & F.col(TIME).isNotNull())
    hot = hot_users(rows, policy) if policy else None
    order = by_order()
    sliced = with_slices(rows, [], policy=None, hot=hot).withColumn("before", F.lag(TIME).over(order))
    pause = F.unix_micros(TIME) - F.unix_micros("before")
    opens = ~F.col("is_carry") & (F.col("before").isNull() | (pause > gap_seconds * 1_000_000))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = sliced.withColumn("number", F.sum(opens.cast("long")).over(so_far)).filter(~F.col("is_carry"))
    pieces = numbered.groupBy("place", KEY, "slice", "number").agg(*_measures())
    if hot is None:
        return _with_length(pieces, least)
    # Number 0 goes on with the last burst of the slices before.
    earlier = Window.partitionBy(KEY).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    opened = numbered.groupBy("place", KEY, "slice").agg(F.max("number").alias("opened"))
    offsets = opened.select(KEY, "slice", F.coalesce(F.sum("opened").over(earlier), F.lit(0)).alias("offset"))
    whole = (
        pieces.join(offsets, [KEY, "slice"])
        .groupBy(KEY, (F.col("offset") + F.col("number")).alias("number"))
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("transactions").alias("transactions"),
            F.sum("total_amount").alias("total_amount"),
        )
    )
    return _with_length(whole, least)


def burst_stream(stream: DataFrame, gap_seconds: int = GAP_SECONDS, delay: str = "10 minutes", least: int = 2) -> DataFrame:
    """The bursts of a stream, each emitted once when the watermark has passed its end and the gap."""
    session = F.session_window(TIME, f"{gap_seconds} seconds")
    rows = stream.filter(F.col(KEY).isNotNull()).withWatermark(TIME, delay)
    return _with_length(rows.groupBy(KEY, session.alias("span")).agg(*_measures()), least)
