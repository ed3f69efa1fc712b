"""Exact quantiles and running totals without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Cells per doubling of (1 + |value|): of the grid for quantiles, which has some
# hundred thousand cells however many rows there are, and of that for totals.
FINE, COARSE = 16 * 1024, 1024


def cell(value: Column, per_doubling: int) -> Column:
    """Number of the grid cell of a value; never decreases with the value.

    Values are not null here. The default tells Spark so: it need not test the
    cell for null on a join, a test it would push down to the scan together
    with all the expressions the value is made of.
    """
    number = F.floor(F.signum(value) * F.log2(F.abs(value) + 1) * per_doubling)
    return F.coalesce(number, F.lit(0).cast("long"))


def _within(counts: DataFrame, part: list[str], order: str) -> DataFrame:
    """Keep the rows that hold a wanted rank; make the rank relative to the row."""
    running = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0).cast("long")))
    first, after = F.col("before"), F.col("before") + F.col("n")
    inside = F.filter("ranks", lambda r: (r["rank"] >= first) & (r["rank"] < after))
    relative = F.transform(
        inside, lambda r: F.struct(r["slot"].alias("slot"), (r["rank"] - first).alias("rank"))
    )
    return placed.withColumn("ranks", relative).filter(F.size("ranks") > 0).drop("before", "n")


def _overall(cells: DataFrame, order: str) -> DataFrame:
    """Add ``stats``: the group's basic statistics, merged from its cells."""
    group = Window.partitionBy("g")
    total, mean = F.sum("n").over(group), F.sum(F.col("n") * F.col("mean")).over(group)
    merged = cells.select(
        "*",
        total.alias("total"),
        (mean / total).alias("overall"),
        F.min("low").over(group).alias("min_value"),
        F.max("high").over(group).alias("max_value"),
    )
    apart = F.col("mean") - F.col("overall")
    spread = F.sum(F.col("n") * (F.col("variance") + apart * apart)).over(group)
    sd = F.sqrt(F.try_divide(spread, F.col("total") - 1))
    stats = F.struct("total", "min_value", "max_value", F.col("overall").alias("mean_value"), sd.alias("sd_value"))
    return merged.select("g", order, "n", stats.alias("stats"))


def _wanted(probs: dict[str, float]) -> Column:
    """The ranks on both sides of each quantile, as (slot, rank)."""
    position = [F.lit(p) * (F.col("stats.total") - 1) for p in probs.values()]
    return F.array(
        *[
            F.struct(F.lit(slot).alias("slot"), side(position[slot // 2]).cast("long").alias("rank"))
            for slot, side in enumerate([F.floor, F.ceil] * len(probs))
        ]
    )


def _interpolated(found: DataFrame, group: str, probs: dict[str, float]) -> DataFrame:
    """One row per group from the values (g, stats, v, ranks) at the wanted ranks."""
    found = found.select("g", "stats", "v", F.explode("ranks.slot").alias("slot"))
    ends = found.groupBy("g", "stats").agg(
        *[F.max(F.when(F.col("slot") == s, F.col("v"))).alias(f"end{s}") for s in range(2 * len(probs))]
    )
    lerp = []
    for i, (name, p) in enumerate(probs.items()):
        low, high, position = F.col(f"end{2 * i}"), F.col(f"end{2 * i + 1}"), F.lit(p) * (F.col("stats.total") - 1)
        lerp.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return ends.select(
        F.col("g").alias(group),
        F.col("stats.total").alias("n"),
        "stats.min_value",
        "stats.max_value",
        "stats.mean_value",
        "stats.sd_value",
        *lerp,
    )


def _values(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())


def exact_box(df: DataFrame, group: str, value: str, probs: dict[str, float]) -> DataFrame:
    """n, min, max, mean, sd and interpolated quantiles per group.

    Two narrow scans: count per grid cell, then count per value of the cells
    that hold a wanted rank. All counts are reduced map-side, so equal values
    cost one row, and a sort only ever sees the cells of a group or the values
    of one cell. ``group`` must have few distinct values: the broadcast cell
    list has at most ``2 * len(probs)`` rows per group.
    """
    data = _values(df, group, value).withColumn("fine", cell(F.col("v"), FINE))
    count = F.count(F.lit(1)).alias("n")
    cells = data.groupBy("g", "fine").agg(
        count,
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.avg("v").alias("mean"),
        F.var_pop("v").alias("variance"),
    )
    fine = _within(_overall(cells, "fine").withColumn("ranks", _wanted(probs)), ["g"], "fine")
    inside = data.join(F.broadcast(fine), ["g", "fine"]).groupBy("g", "stats", "ranks", "fine", "v").agg(count)
    return _interpolated(_within(inside, ["g", "fine"], "v"), group, probs)


def counted_box(df: DataFrame, group: str, value: str, probs: dict[str, float]) -> DataFrame:
    """As ``exact_box``, in one scan, for a value with few distinct values in each group.

    The rows are counted per value; the counts of a group are sorted in one
    task. Sums of rules take at most some hundred values.
    """
    counts = _values(df, group, value).groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    as_cells = counts.select("*", *[F.col("v").alias(c) for c in ("low", "high", "mean")], F.lit(0.0).alias("variance"))
    ranked = _overall(as_cells, "v").withColumn("ranks", _wanted(probs))
    return _interpolated(_within(ranked, ["g"], "v"), group, probs)


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def box_stats(
    df: DataFrame, group: str, value: str, method: str = "exact", probs: dict[str, float] = QUARTILES
) -> DataFrame:
    """n, min, quantiles, max, mean and standard deviation per group.

    ``exact`` answers in two scans, ``counted`` in one if there are few distinct
    values, ``approx`` in one with sketched quantiles.
    """
    if method == "exact":
        return exact_box(df, group, value, probs)
    if method == "counted":
        return counted_box(df, group, value, probs)
    if method != "approx":
        raise ValueError(f"unknown method: {method}")
    return df.groupBy(group).agg(
        F.count(value).alias("n"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("mean_value"),
        F.stddev(value).alias("sd_value"),
        *[F.percentile_approx(value, p, 10_000).alias(name) for name, p in probs.items()],
    )


def running_totals(df: DataFrame, value: str, sums: list[str]) -> DataFrame:
    """Running sums over descending ``value`` and grand totals, per distinct row.

    ``df`` holds one row per distinct value. A first pass sums whole grid cells
    (some thousand rows in one small window); within a cell the values are then
    summed in parallel on top of what the cells above hold.
    """
    celled = df.withColumn("cell", cell(F.col(value), COARSE))
    above = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    cells = (
        celled.groupBy("cell")
        .agg(*[F.sum(s).alias(s) for s in sums])
        .select(
            "cell",
            *[F.coalesce(F.sum(s).over(above), F.lit(0).cast("long")).alias(f"above_{s}") for s in sums],
            *[F.sum(s).over(everything).alias(f"total_{s}") for s in sums],
        )
    )
    inside = Window.partitionBy("cell").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, 0)
    return celled.join(F.broadcast(cells), "cell").select(
        value,
        *sums,
        *[(F.col(f"above_{s}") + F.sum(s).over(inside)).alias(f"cum_{s}") for s in sums],
        *[f"total_{s}" for s in sums],
    )
