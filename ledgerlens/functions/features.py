"""Row-level features.

Each ``*_columns`` function returns ``{name: Column}`` so that an operator adds
all of them in one projection. The columns only use built-in expressions and
stay inside whole-stage code generation, in batch as on a stream.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.schema import HIGH_RISK_CATEGORIES, MODEL_FEATURES


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def add(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add the columns in a single projection."""
    return df.select("*", *[c.alias(name) for name, c in columns.items()])


def time_columns() -> dict[str, Column]:
    hour, day = F.hour("timestamp"), F.dayofweek("timestamp")
    return {
        "hour_of_day": hour,
        "day_of_week": day,
        "is_unusual_hour": flag(hour.between(2, 5)),
        "is_weekend": flag(day.isin(1, 7)),
    }


def amount_columns() -> dict[str, Column]:
    amount = F.col("amount")
    category = (
        F.when(amount < 20, "low").when(amount < 100, "medium").when(amount < 500, "high").otherwise("very_high")
    )
    return {
        "amount_log": F.when(amount > 0, F.log10(amount)).otherwise(0.0),
        "amount_category": category,
        "is_high_amount": flag(amount > 500),
        "is_very_high_amount": flag(amount > 1000),
    }


def simple_columns() -> dict[str, Column]:
    return {
        "is_round_amount": flag(F.col("amount") % 10 == 0),
        "is_online_flag": flag(F.col("is_online")),
        "timestamp_epoch": F.unix_timestamp("timestamp"),
    }


def merchant_columns() -> dict[str, Column]:
    category = F.col("merchant_category")
    return {
        "is_high_risk_merchant": flag(category.isin(HIGH_RISK_CATEGORIES)),
        "is_online_merchant": flag(category == "online_shopping"),
    }


def time_features(df: DataFrame) -> DataFrame:
    return add(df, time_columns())


def amount_features(df: DataFrame) -> DataFrame:
    return add(df, amount_columns())


def simple_features(df: DataFrame) -> DataFrame:
    return add(df, simple_columns())


def merchant_features(df: DataFrame) -> DataFrame:
    return add(df, merchant_columns())


def rule_features(df: DataFrame) -> DataFrame:
    """All features the stateless rules read."""
    return add(df, {**time_columns(), **amount_columns(), **simple_columns(), **merchant_columns()})


def model_features(df: DataFrame) -> DataFrame:
    """The features of the random forest; its logarithm is log10(amount + 1)."""
    amounts, simple = amount_columns(), simple_columns()
    return add(
        df,
        {
            **time_columns(),
            "amount_log": F.log10(F.col("amount") + 1),
            "is_high_amount": amounts["is_high_amount"],
            "is_round_amount": simple["is_round_amount"],
            "is_high_risk_merchant": merchant_columns()["is_high_risk_merchant"],
            "is_online_int": simple["is_online_flag"],
        },
    )


def assemble(df: DataFrame, label: str | None = "is_fraud") -> DataFrame:
    """Add the model vector; with ``label`` keep only (features, label).

    For training (with ``label``) rows with a null feature are skipped. Without
    it every row stays and a null feature is NaN in the vector.
    """
    invalid = "keep" if label is None else "skip"
    vectors = VectorAssembler(inputCols=MODEL_FEATURES, outputCol="features", handleInvalid=invalid).transform(df)
    if label is None:
        return vectors
    return vectors.select("features", F.col(label).cast("double").alias("label"))
