"""User statistics as they were known when a transaction took place.

``history.user_window_features`` gives a transaction the statistics of its own
window, which is still open then: rows after it are counted too. Here it gets
those of the user's last closed window, the latest one with transactions that
ended at or before its time. Nothing from its own window or later is used.

Rows are shuffled once by user. Sorted by time, they yield the statistics of
each window, and a window's first row reads those of the window before it from
the row in front of it. A hot user's rows, who would fill one task, go another
way: their windows are aggregated, reduced before the shuffle; each window gets
the statistics of the user's previous one; and the rows are joined with their
window's entry, a join that adaptive execution divides where a window is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.slices import DEFAULT_POLICY, ID, KEY, TIME, HotPolicy, hot_users

SECONDS = {"minute": 60, "hour": 3600, "day": 86_400}


def window_seconds(duration: str) -> int:
    """Length of windows such as '1 hour' or '15 minutes'."""
    number, unit = duration.split()
    return int(number) * SECONDS[unit.rstrip("s")]


def statistics() -> dict[str, Column]:
    return {
        "txn_count": F.count(ID), "avg_amount": F.avg("amount"), "max_amount": F.max("amount"),
        "min_amount": F.min("amount"), "std_amount": F.stddev("amount"), "total_amount": F.sum("amount"),
    }


STATISTICS = [f"asof_{name}" for name in ("txn_count", "avg_amount", "max_amount", "min_amount", "std_amount", "total_amount")]


def _known(df: DataFrame, length: int) -> DataFrame:
    """Rows with the number of their window; no window, no history, without user or time."""
    return df.withColumn("span", F.floor(F.unix_timestamp(TIME) / length))


def _shuffled(df: DataFrame) -> DataFrame:
    """``past``: (span, statistics) of the user's window before that of each row."""
    # A hash leads the sort, as ids share their first bytes.
    rows = df.withColumn("place", F.xxhash64(KEY))
    window = Window.partitionBy("place", KEY, "span")
    user = Window.partitionBy("place", KEY).orderBy("span", TIME, ID)
    # The window by user comes first: its exchange and sort serve those by window too.
    rows = rows.withColumn("span_before", F.lag("span").over(user))
    own = F.struct("span", *[value.over(window).alias(name) for name, value in statistics().items()])
    opens = F.col("span_before") != F.col("span")
    before = rows.withColumn("own", own).withColumn("before", F.lag("own").over(user))
    before = before.withColumn("before", F.when(opens, F.col("before")))
    first = F.first("before").over(window.orderBy(TIME, ID).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return before.withColumn("past", first).drop("place", "span_before", "own", "before")


def _joined(df: DataFrame) -> DataFrame:
    spans = df.groupBy(KEY, "span").agg(*[value.alias(name) for name, value in statistics().items()])
    own = F.struct("span", *statistics())
    past = spans.select(KEY, "span", F.lag(own).over(Window.partitionBy(KEY).orderBy("span")).alias("past"))
    return df.join(past, [KEY, "span"], "left")


def asof_features(df: DataFrame, duration: str = "1 hour", policy: HotPolicy | None = DEFAULT_POLICY) -> DataFrame:
    """Transactions with ``asof_`` statistics, window start, and seconds since that window closed.

    Null where the user has no closed window yet.
    """
    length = window_seconds(duration)
    timed = F.col(KEY).isNotNull() & F.col(TIME).isNotNull()
    rows = _known(df.filter(timed), length)
    hot = hot_users(df.filter(timed), policy) if policy else None
    if hot is None:
        found = _shuffled(rows)
    else:
        listed = F.broadcast(hot.select(KEY))
        usual, busy = rows.join(listed, KEY, "left_anti"), rows.join(listed, KEY, "left_semi")
        found = _shuffled(usual).unionByName(_joined(busy))
    start = F.timestamp_seconds(F.col("past.span") * length)
    age = F.unix_timestamp(TIME) - (F.col("past.span") + 1) * length
    columns = [start.alias("asof_window_start"), age.alias("asof_age_seconds"), *[F.col(f"past.{s.removeprefix('asof_')}").alias(s) for s in STATISTICS]]
    known = found.select(*df.columns, *columns)
    return known.unionByName(df.filter(~F.coalesce(timed, F.lit(False))), allowMissingColumns=True)
