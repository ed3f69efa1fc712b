"""Batch writes: partitioned history and encoded messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.schema import TRANSACTION_COLUMNS

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_history(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 5_000_000) -> None:
    """Write Parquet + snappy under ``year=YYYY/month=MM``.

    Rows are gathered by month with the rebalance hint: a small month ends in
    one file, while adaptive execution cuts a large month over many tasks, so
    no task has to write a whole month of a big table.
    """
    months = df.select(
        "*",
        F.year("timestamp").alias("year"),
        F.date_format("timestamp", "MM").alias("month"),
    )
    (
        months.hint("rebalance", F.col("year"), F.col("month"))
        .write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("year", "month")
        .parquet(path)
    )


def encode_messages(df: DataFrame) -> DataFrame:
    """(key, value) messages: the user as key, the whole transaction as JSON."""
    fields = [
        F.date_format("timestamp", ISO_FORMAT).alias("timestamp") if c == "timestamp" else F.col(c)
        for c in TRANSACTION_COLUMNS
    ]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(F.col("user_id").alias("key"), value.alias("value"))


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish encoded messages; needs the Kafka connector on the class path."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
