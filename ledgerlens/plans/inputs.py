"""Inputs that several registered queries share, made by Spark from the tables."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.model import split, train_forest
from ledgerlens.operators.scoring import rule_output, score_rules
from ledgerlens.session import work_dir
from ledgerlens.sinks.batch import encode_messages, write_history
from ledgerlens.sources.events import transactions

FOREST = {"numTrees": 20, "maxDepth": 8}

LITERAL_ROWS = [
    ("SAMPLE_01", "LENA", "2024-05-06 10:20:00", 18.4, "SHOP_A", "grocery", 41.3, -8.6, False, 0),
    ("SAMPLE_02", "OMAR", "2024-05-06 03:40:00", 1700.0, "SHOP_B", "electronics", 41.3, -8.6, True, 1),
    ("SAMPLE_03", "LENA", "2024-05-07 19:05:00", 64.75, "SHOP_C", "restaurant", 41.1, -8.5, False, 0),
    ("SAMPLE_04", "MIRA", "2024-05-08 02:15:00", 2400.0, "SHOP_D", "online_shopping", 38.7, -9.1, True, 1),
    ("SAMPLE_05", "JOON", "2024-05-09 13:45:00", 88.2, "SHOP_E", "gas_station", 38.7, -9.1, False, 0),
]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_rules(transactions(spark, sf_dir))


def damaged_messages(tx: DataFrame) -> DataFrame:
    """All transactions as messages, three categories of them spoilt.

    Pharmacy messages are cut off, hotel messages lack the amount and airline
    messages carry an unreadable time.
    """
    category = F.col("merchant_category")
    holed = tx.withColumn("amount", F.when(category != "hotel", F.col("amount")))
    value = F.col("value")
    return encode_messages(holed).select(
        "key",
        F.when(value.contains('"pharmacy"'), F.expr("substring(value, 1, length(value) - 5)"))
        .when(value.contains('"airline"'), F.regexp_replace(value, '"timestamp":"[^"]*"', '"timestamp":"bad"'))
        .otherwise(value)
        .alias("value"),
    )


def history_path(spark: SparkSession, sf_dir: str) -> str:
    """Transactions written as history; days after the 15th move on by 31 days."""
    path = work_dir(spark, "history")
    tx = transactions(spark, sf_dir)
    later = F.col("timestamp") + F.expr("INTERVAL 31 DAYS")
    moved = F.when(F.dayofmonth("timestamp") > 15, later).otherwise(F.col("timestamp"))
    write_history(tx.withColumn("timestamp", moved), path)
    return path


def scored_files(spark: SparkSession, sf_dir: str) -> str:
    """The rule-scored transactions, a file or more per category, with one damaged file among them."""
    path = work_dir(spark, "scored-files")
    output = rule_output(transactions(spark, sf_dir))
    output.hint("rebalance", F.col("merchant_category")).write.parquet(path)
    spark.range(1, numPartitions=1).select(F.lit("cut off while it was written")).write.mode("append").text(path)
    return path


def forest(spark: SparkSession, sf_dir: str) -> RandomForestClassificationModel:
    """A forest trained on the training part of the transactions."""
    train, _ = split(transactions(spark, sf_dir))
    return train_forest(train, **FOREST)
