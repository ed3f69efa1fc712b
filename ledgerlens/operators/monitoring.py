"""Headline numbers, time lines and distributions of a scored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.rules import RISK_BANDS
from ledgerlens.operators.quantiles import QUARTILES, box_stats


def count_rows() -> Column:
    return F.count(F.lit(1))


def fraud_column(df: DataFrame, fraud_col: str | None = None) -> str:
    """The prediction where there is one, else the label."""
    if fraud_col:
        return fraud_col
    return "predicted_fraud" if "predicted_fraud" in df.columns else "is_fraud"


def is_alert(df: DataFrame, fraud_col: str | None = None) -> Column:
    return F.col(fraud_column(df, fraud_col)) == 1


def ratio(top: Column, bottom: Column, scale: float = 1.0) -> Column:
    """Quotient times scale, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0)) * scale


def frauds(df: DataFrame, fraud_col: str | None = None) -> DataFrame:
    return df.filter(is_alert(df, fraud_col))


def kpi_summary(df: DataFrame, fraud_col: str | None = None) -> DataFrame:
    alert = is_alert(df, fraud_col)
    sums = df.agg(
        count_rows().alias("total_transactions"),
        F.count_if(alert).alias("frauds_detected"),
        F.sum("amount").alias("total_amount"),
        F.coalesce(F.sum(F.when(alert, F.col("amount"))), F.lit(0.0)).alias("fraud_amount"),
        F.coalesce(F.avg("fraud_score"), F.lit(0.0)).alias("avg_fraud_score"),
    )
    rate = ratio(F.col("frauds_detected"), F.col("total_transactions"), 100.0)
    return sums.select("*", rate.alias("fraud_rate_pct"))


def detection_metrics(df: DataFrame, unit: str = "ratio") -> DataFrame:
    """Confusion counts and their quotients, in one aggregate.

    ``unit`` is "ratio" (0 to 1) or "percent".
    """
    scale = {"ratio": 1.0, "percent": 100.0}[unit]
    truth, said = F.col("is_fraud"), F.col("predicted_fraud")
    counts = df.agg(
        F.count_if((truth == 1) & (said == 1)).alias("tp"),
        F.count_if((truth == 0) & (said == 1)).alias("fp"),
        F.count_if((truth == 0) & (said == 0)).alias("tn"),
        F.count_if((truth == 1) & (said == 0)).alias("fn"),
        count_rows().alias("total"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        "tp",
        "fp",
        "tn",
        "fn",
        ratio(tp + tn, F.col("total"), scale).alias("accuracy"),
        ratio(tp, tp + fp, scale).alias("precision"),
        ratio(tp, tp + fn, scale).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn, scale).alias("f1"),
    )


def detection_metrics_long(df: DataFrame, unit: str = "percent") -> DataFrame:
    names = ["accuracy", "precision", "recall", "f1"]
    return detection_metrics(df, unit).select(*names).unpivot([], names, "metric", "value")


def confusion_matrix(df: DataFrame) -> DataFrame:
    """All four cells as (actual, predicted, transactions), zeros included."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("transactions")
            )
            for a, p, c in cells
        ]
    )
    return detection_metrics(df).select(F.inline(rows))


def timeline(df: DataFrame, bucket: str = "5 minutes", fraud_col: str | None = None) -> DataFrame:
    """Transactions, frauds and the rest per time bucket."""
    counts = df.groupBy(F.window("timestamp", bucket).alias("span")).agg(
        count_rows().alias("total"), F.count_if(is_alert(df, fraud_col)).alias("frauds")
    )
    return counts.select(
        F.col("span.start").alias("bucket"), "total", "frauds", (F.col("total") - F.col("frauds")).alias("normal")
    )


def timeline_by_class(df: DataFrame, bucket: str = "1 minute", fraud_col: str | None = None) -> DataFrame:
    """Transactions per time bucket and class, present combinations only."""
    label = F.col(fraud_column(df, fraud_col)).alias("class")
    counts = df.groupBy(F.window("timestamp", bucket).alias("span"), label).agg(count_rows().alias("transactions"))
    return counts.select(F.col("span.start").alias("bucket"), "class", "transactions")


# Reference mark and colour bands of the gauge, in percent.
GAUGE_REFERENCE = 5.0
GAUGE_BANDS = [("low", 3.0), ("watch", 7.0)]


def fraud_rate_gauge(df: DataFrame, fraud_col: str | None = None) -> DataFrame:
    rate = F.col("fraud_rate_pct")
    (low, low_end), (watch, watch_end) = GAUGE_BANDS
    band = F.when(rate < low_end, low).when(rate < watch_end, watch).otherwise("high")
    return kpi_summary(df, fraud_col).select(rate, (rate - GAUGE_REFERENCE).alias("delta_pct"), band.alias("band"))


def score_band(score: str = "fraud_score") -> Column:
    """Band of a score for distributions; a missing score falls into the top band."""
    levels = [name for name, _ in reversed(RISK_BANDS)]
    floors = [floor for _, floor in reversed(RISK_BANDS)]
    chain = F
    for name, ceiling in zip(["SAFE", *levels], floors):
        chain = chain.when(F.col(score) < ceiling, name)
    return chain.otherwise(levels[-1])


def class_name(df: DataFrame, fraud_col: str | None = None) -> Column:
    return F.when(is_alert(df, fraud_col), "fraud").otherwise("normal")


def score_box_by_band(df: DataFrame, method: str = "exact") -> DataFrame:
    banded = df.select(score_band().alias("band"), "fraud_score")
    return box_stats(banded, "band", "fraud_score", method)


def amount_box_by_class(df: DataFrame, fraud_col: str | None = None, method: str = "exact") -> DataFrame:
    classed = df.select(class_name(df, fraud_col).alias("class"), "amount")
    return box_stats(classed, "class", "amount", method)


def _score_bin(bins: int, top: float) -> Column:
    """Bin 1..bins of a score on [0, top]; scores at or above the top share the last."""
    width = top / bins
    return F.greatest(F.lit(1), F.least(F.lit(bins), F.floor(F.col("fraud_score") / width) + 1)).cast("int")


def score_histogram(df: DataFrame, bins: int = 20, top: float = 100.0) -> DataFrame:
    counts = df.filter(F.col("fraud_score").isNotNull()).groupBy(_score_bin(bins, top).alias("bin"))
    return counts.agg(count_rows().alias("transactions")).select(
        "bin", ((F.col("bin") - 1) * (top / bins)).alias("bin_start"), "transactions"
    )


def score_dist_by_class(df: DataFrame, fraud_col: str | None = None, bins: int = 20) -> DataFrame:
    """Histogram of the score for each class."""
    scored = df.filter(F.col("fraud_score").isNotNull())
    counts = scored.groupBy(class_name(df, fraud_col).alias("class"), _score_bin(bins, 100.0).alias("bin"))
    return counts.agg(count_rows().alias("transactions"))


def score_quantiles_by_class(df: DataFrame, fraud_col: str | None = None, method: str = "exact") -> DataFrame:
    """Quartiles and tails of the score for each class; ``counted`` suits rule scores, see ``counted_box``."""
    probs = {"p05": 0.05, **QUARTILES, "p95": 0.95}
    classed = df.select(class_name(df, fraud_col).alias("class"), "fraud_score")
    return box_stats(classed, "class", "fraud_score", method, probs).select("class", *probs)


def risk_level_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("risk_level").agg(count_rows().alias("transactions"))


def fraud_rate_by_category(df: DataFrame, fraud_col: str | None = None) -> DataFrame:
    """Fraud rate in percent per merchant category, one decimal, half to even."""
    counts = df.groupBy("merchant_category").agg(
        F.count_if(is_alert(df, fraud_col)).alias("frauds"), count_rows().alias("total")
    )
    rate = F.bround(F.col("frauds") / F.col("total") * 100, 1)
    return counts.select("*", rate.alias("rate")).orderBy("rate", "merchant_category")


def hourly_pattern(df: DataFrame, fraud_col: str | None = None) -> DataFrame:
    label = F.col(fraud_column(df, fraud_col)).alias("class")
    return df.groupBy(F.hour("timestamp").alias("hour"), label).agg(count_rows().alias("transactions"))


def category_rollup(df: DataFrame, fraud_col: str | None = None) -> DataFrame:
    """Counts per category and class with subtotals and the grand total.

    ``level`` is 0 for a leaf, 1 for a category, 3 for everything.
    """
    named = df.select("merchant_category", class_name(df, fraud_col).alias("class"))
    return named.rollup("merchant_category", "class").agg(
        count_rows().alias("transactions"), F.grouping_id().cast("int").alias("level")
    )


def day_hour_heatmap(df: DataFrame, fraud_col: str | None = None) -> DataFrame:
    """Frauds per week day (0 = Monday) and hour: all 168 cells, zeros included."""
    slot = F.weekday("timestamp") * 24 + F.hour("timestamp")
    counts = frauds(df, fraud_col).groupBy(slot.cast("long").alias("slot")).agg(count_rows().alias("n"))
    grid = df.sparkSession.range(7 * 24).withColumnRenamed("id", "slot")
    # At most 168 count rows can come out of the aggregate.
    return grid.join(F.broadcast(counts), "slot", "left").select(
        F.floor(F.col("slot") / 24).cast("int").alias("day"),
        (F.col("slot") % 24).cast("int").alias("hour"),
        F.coalesce("n", F.lit(0).cast("long")).alias("frauds"),
    )


def daily_trend(df: DataFrame, fraud_col: str | None = None, days: int = 3) -> DataFrame:
    """Frauds per day and their mean over the last ``days`` days that have any.

    The moving mean runs over one row per calendar day.
    """
    daily = frauds(df, fraud_col).groupBy(F.to_date("timestamp").alias("day")).agg(count_rows().alias("frauds"))
    last = Window.orderBy("day").rowsBetween(-(days - 1), 0)
    return daily.select("day", "frauds", F.avg("frauds").over(last).alias("moving_avg"))


# Funnel stages and the share of confirmed frauds acted on.
FUNNEL_STAGES = ["transactions", "high_scores", "alerts", "confirmed", "actions"]
ACTION_SHARE = 0.6


def alert_funnel(df: DataFrame, fraud_col: str | None = None) -> DataFrame:
    """Stages from all transactions to actions, none larger than the one before."""
    alert = is_alert(df, fraud_col)
    confirmed = alert
    if {"is_fraud", "predicted_fraud"} <= set(df.columns):
        confirmed = (F.col("is_fraud") == 1) & (F.col("predicted_fraud") == 1)
    counts = df.agg(
        count_rows().alias("s0"),
        F.count_if(F.col("fraud_score") >= 70).alias("s1"),
        F.count_if(alert).alias("s2"),
        F.count_if(confirmed).alias("s3"),
    ).withColumn("s4", F.floor(F.col("s3") * ACTION_SHARE))
    capped = [F.col("s0")]
    for i in range(1, len(FUNNEL_STAGES)):
        capped.append(F.least(*[F.col(f"s{j}") for j in range(i + 1)]))
    rows = [
        F.struct(
            F.lit(i).alias("stage_no"),
            F.lit(name).alias("stage"),
            capped[i].alias("transactions"),
            (F.try_divide(capped[i], capped[i - 1]) * 100 if i else F.lit(None).cast("double")).alias("step_pct"),
        )
        for i, name in enumerate(FUNNEL_STAGES)
    ]
    return counts.select(F.inline(F.array(*rows)))


def throughput_summary(df: DataFrame, fraud_col: str = "is_fraud") -> DataFrame:
    """Volume, fraud share, users, period and mean rate of a table.

    Users are counted through a per-user reduction, not by shuffling all rows.
    """
    per_user = df.groupBy("user_id").agg(
        count_rows().alias("n"),
        F.count_if(F.col(fraud_col) == 1).alias("f"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
    )
    sums = per_user.agg(
        F.sum("n").alias("transactions"),
        F.sum("f").alias("frauds"),
        count_rows().alias("users"),
        F.min("first").alias("first_seen"),
        F.max("last").alias("last_seen"),
    )
    elapsed = (F.unix_micros("last_seen") - F.unix_micros("first_seen")) / 1e6
    return sums.select(
        "*",
        ratio(F.col("frauds"), F.col("transactions"), 100.0).alias("fraud_pct"),
        elapsed.alias("elapsed_seconds"),
        ratio(F.col("transactions"), elapsed).alias("tps"),
    )
