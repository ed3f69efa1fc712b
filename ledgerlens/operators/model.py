"""Training, evaluation and storage of the random forest."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.features import assemble, model_features
from ledgerlens.operators.quantiles import running_totals
from ledgerlens.schema import MODEL_FEATURES

# --- Fixed values: the two published parameter sets ---------------------------
SCRIPT_PARAMS = {"numTrees": 100, "maxDepth": 10, "featureSubsetStrategy": "auto", "subsamplingRate": 1.0}
NOTEBOOK_PARAMS = {"numTrees": 50, "maxDepth": 8, "featureSubsetStrategy": "sqrt", "subsamplingRate": 0.8}
SEED, MAX_BINS = 42, 32
# --- end of fixed values ------------------------------------------------------


def in_train(fraction: float = 0.8) -> Column:
    """Whether a transaction falls into the training part.

    Decided by a hash of the id, so the split does not depend on how the table
    is partitioned and a lost task repeats it identically.
    """
    prefix = F.conv(F.substring(F.md5("transaction_id"), 1, 4), 16, 10).cast("long")
    return prefix < int(fraction * 65536)


def split(
    df: DataFrame, weights: tuple[float, float] = (0.8, 0.2), by_hash: bool = True, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Training and test part; weights need not add up to one."""
    if not by_hash:
        train, test = df.randomSplit(list(weights), seed=seed)
        return train, test
    chosen = in_train(weights[0] / sum(weights))
    return df.filter(chosen), df.filter(~chosen)


def train_forest(train: DataFrame, seed: int = SEED, pieces: int = 64, **params) -> RandomForestClassificationModel:
    """Fit a forest on transactions; the vectors are kept while it iterates.

    The forest draws its samples per piece, so rows are dealt to ``pieces`` by
    their id and sorted there: the model then depends on the rows and this
    number alone, not on cores or on how the table is stored. Rows without a
    feature are left out of the training.
    """
    dealt = train.repartition(pieces, "transaction_id").sortWithinPartitions("transaction_id")
    vectors = assemble(model_features(dealt)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return RandomForestClassifier(
            featuresCol="features", labelCol="label", maxBins=MAX_BINS, seed=seed, **{**SCRIPT_PARAMS, **params}
        ).fit(vectors)
    finally:
        vectors.unpersist()


def outcome_table(predictions: DataFrame, score: str = "fraud_score") -> DataFrame:
    """Positives and negatives per distinct (score, prediction).

    All metrics are sums over this table, so the predictions are computed once.
    """
    return predictions.groupBy(F.col(score).alias("threshold"), "predicted_fraud").agg(
        F.count_if(F.col("is_fraud") == 1).alias("pos"), F.count_if(F.col("is_fraud") == 0).alias("neg")
    )


def _ranking(outcomes: DataFrame) -> DataFrame:
    """Counts per distinct score with their running sums."""
    counts = outcomes.groupBy("threshold").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return running_totals(counts, "threshold", ["pos", "neg"])


def roc_curve(predictions: DataFrame, score: str = "fraud_score") -> DataFrame:
    """One point per distinct score: alerts at or above it against the truth."""
    return _ranking(outcome_table(predictions, score)).select(
        "threshold",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        F.try_divide("cum_pos", "total_pos").alias("tpr"),
        F.try_divide("cum_neg", "total_neg").alias("fpr"),
    )


def _areas(outcomes: DataFrame) -> DataFrame:
    """Areas under the ROC and the precision-recall curve, exact by trapezoids.

    A point's predecessor follows from its own counts, so no second ordered
    pass is needed. The precision-recall curve starts at recall 0 with the
    precision of its first point.
    """
    strip = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2)
    roc = F.sum(F.try_divide(strip, F.col("total_pos").cast("double") * F.col("total_neg")))
    now = F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    tp, fp = F.col("cum_pos") - F.col("pos"), F.col("cum_neg") - F.col("neg")
    before = F.coalesce(F.try_divide(tp, tp + fp), now)
    pr = F.sum(F.try_divide("pos", "total_pos") * (now + before) / 2)
    return _ranking(outcomes).agg(roc.alias("auc_roc"), pr.alias("auc_pr"))


def roc_auc(predictions: DataFrame, score: str = "fraud_score") -> DataFrame:
    return _areas(outcome_table(predictions, score)).select(F.col("auc_roc").alias("auc"))


def _quotients(outcomes: DataFrame) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 from the four cells."""
    said = F.col("predicted_fraud") == 1

    def cell(name: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(name))), F.lit(0))

    counts = outcomes.agg(
        cell("pos", said).alias("tp"),
        cell("neg", said).alias("fp"),
        cell("neg", ~said).alias("tn"),
        cell("pos", ~said).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    n, zero = tp + fp + tn + fn, F.lit(0.0)

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), zero)

    def f1(right: Column, wrong: Column, missed: Column) -> Column:
        return ratio(2 * right, 2 * right + wrong + missed)

    def weighted(fraud: Column, normal: Column) -> Column:
        return ratio(fraud * (tp + fn) + normal * (tn + fp), n)

    return counts.select(
        ratio(tp + tn, n).alias("accuracy"),
        weighted(ratio(tp, tp + fp), ratio(tn, tn + fn)).alias("weighted_precision"),
        weighted(ratio(tp, tp + fn), ratio(tn, tn + fp)).alias("weighted_recall"),
        weighted(f1(tp, fp, fn), f1(tn, fn, fp)).alias("f1"),
        ratio(tp, tp + fp).alias("fraud_precision"),
        ratio(tp, tp + fn).alias("fraud_recall"),
    )


def evaluate(predictions: DataFrame, score: str = "fraud_score") -> DataFrame:
    """All metrics as (metric, value) rows."""
    outcomes = outcome_table(predictions, score)

    def long_form(df: DataFrame) -> DataFrame:
        return df.unpivot([], df.columns, "metric", "value")

    return long_form(_areas(outcomes)).unionByName(long_form(_quotients(outcomes)))


def feature_importance(spark: SparkSession, model: RandomForestClassificationModel, top: int | None = None) -> DataFrame:
    """Features by importance; ``top`` for the short report."""
    values = [float(v) for v in model.featureImportances.toArray()]
    rows = spark.createDataFrame(list(zip(MODEL_FEATURES, values)), "feature string, importance double")
    ordered = rows.orderBy(F.desc("importance"), "feature")
    return ordered.limit(top) if top else ordered


def label_distribution(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows and share in percent per label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("transactions"))
    total = F.sum("transactions").over(Window.partitionBy())  # over one row per label
    return counts.withColumn("share_pct", F.try_divide(F.col("transactions") * 100.0, total))


def amount_stats_by_label(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.avg("amount").alias("avg_amount"),
        F.stddev("amount").alias("std_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )


def split_balance(df: DataFrame, fraction: float = 0.8) -> DataFrame:
    """Rows per part of the split and label."""
    part = F.when(in_train(fraction), "train").otherwise("test").alias("part")
    return df.groupBy(part, F.col("is_fraud").alias("label")).agg(F.count(F.lit(1)).alias("transactions"))


def confusion_pivot(predictions: DataFrame) -> DataFrame:
    """One row per true label with a column per prediction; no gaps."""
    pivot = predictions.groupBy("is_fraud").pivot("predicted_fraud", [0, 1]).count().fillna(0)
    return pivot.select(
        F.col("is_fraud").alias("label"),
        F.col("0").alias("predicted_normal"),
        F.col("1").alias("predicted_fraud"),
    )


def preview(predictions: DataFrame, rows: int = 10) -> DataFrame:
    """A few predictions for a report, by id."""
    columns = ["transaction_id", "is_fraud", "predicted_fraud", "fraud_probability", "fraud_score"]
    return predictions.select(*columns).orderBy("transaction_id").limit(rows)


def save_model(model: RandomForestClassificationModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def model_metadata(
    spark: SparkSession,
    model: RandomForestClassificationModel,
    metrics: dict[str, float],
    training_samples: int,
    test_samples: int,
) -> DataFrame:
    """One row that describes a trained model."""
    importance = sorted(
        zip(MODEL_FEATURES, (float(v) for v in model.featureImportances.toArray())), key=lambda p: -p[1]
    )
    row = (
        "RandomForestClassifier",
        model.getNumTrees,
        model.getMaxDepth(),
        datetime.now(timezone.utc).isoformat(),
        training_samples,
        test_samples,
        metrics,
        MODEL_FEATURES,
        importance,
    )
    return spark.createDataFrame(
        [row],
        "model_type string, num_trees int, max_depth int, training_date string, training_samples long,"
        " test_samples long, metrics map<string,double>, features array<string>,"
        " feature_importance array<struct<feature:string,importance:double>>",
    )


def save_metadata(metadata: DataFrame, path: str) -> None:
    """One JSON file; the table has a single row."""
    metadata.coalesce(1).write.mode("overwrite").json(path)
