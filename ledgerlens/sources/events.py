"""Transactions derived from a generic `events` table.

The mapping is a row-wise projection (no shuffle), so it applies to a batch
scan and to a file stream alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schema import TRANSACTION_COLUMNS
from ledgerlens.session import pin_session

CATEGORY_BY_DIGIT = [
    "supermarket", "restaurant", "gas_station", "pharmacy", "electronics",
    "clothing", "hotel", "airline", "online_shopping", "entertainment",
]


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Project (event_id, ts, user_id, event_type, value, props) to transactions."""
    event, user = F.col("event_id"), F.col("user_id")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    base = events.select(
        event,
        user,
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_type",
        (F.col("value") * 4).alias("gross"),
        k.alias("k"),
        (user * 37 % 120 - 60).cast("double").alias("home_lat"),
        (user * 61 % 360 - 180).cast("double").alias("home_lon"),
    )
    k, far = F.col("k"), F.col("event_id") % 50 == 0

    def place(home: str):
        return F.when(far, 0.0 - F.col(home)).otherwise(F.col(home) + (k - 50) / F.lit(250.0))

    def padded(prefix: str, number, width: int):
        return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))

    device = user * 3 + F.when(k >= 95, 1 + k % 2).otherwise(0)
    fraud = ((F.col("gross") > 500) & (F.col("event_type") == "error")) | (far & (k < 50))
    rounded = (F.floor(F.col("gross") / 10) * 10).cast("double")
    return base.select(
        padded("TRX_", event, 12).alias("transaction_id"),
        padded("USER_", user, 6).alias("user_id"),
        "timestamp",
        F.when(event % 20 == 0, rounded).otherwise(F.col("gross")).alias("amount"),
        F.concat(F.lit("MERCHANT_"), (1000 + (event * 7919 + k) % 500).cast("string")).alias("merchant_id"),
        F.element_at(F.array(*map(F.lit, CATEGORY_BY_DIGIT)), k % 10 + 1).alias("merchant_category"),
        place("home_lat").alias("location_lat"),
        place("home_lon").alias("location_lon"),
        padded("DEVICE_", device, 8).alias("device_id"),
        ((k % 10 == 8) | (k % 5 == 0)).alias("is_online"),
        F.when(fraud, 1).otherwise(0).alias("is_fraud"),
        F.lit(None).cast("string").alias("card_last_4"),
        F.lit(None).cast("boolean").alias("cvv_provided"),
    ).select(*TRANSACTION_COLUMNS)


def confirmations_of(tx: DataFrame) -> DataFrame:
    """(transaction_id, label, confirmed_at): later word on eight in ten transactions, within 200 hours.

    Every 25th is delivered twice. Row-wise, so it serves a stream as well.
    """
    number = F.substring("transaction_id", 5, 12).cast("long")
    hours = F.make_dt_interval(F.lit(0), (number * 13 % 200).cast("int"))
    told = tx.filter(number % 10 < 8)
    times = F.array_repeat(F.lit(1), F.when(number % 25 == 0, 2).otherwise(1))
    return told.select(
        "transaction_id", F.col("is_fraud").alias("label"), (F.col("timestamp") + hours).alias("confirmed_at"), F.explode(times).alias("copy")
    ).drop("copy")


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions of one data folder."""
    return transactions_from_events(pin_session(spark).read.parquet(events_path(sf_dir)))


def transaction_stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The same transactions as a file stream over the table's own files.

    The table may be one file or a folder of files. A stream takes a single
    file only through a glob, hence the one-letter class; it matches nothing else.
    """
    path = events_path(sf_dir)
    schema = pin_session(spark).read.parquet(path).schema
    stream = spark.readStream.schema(schema).options(**options).parquet(f"{path[:-1]}[{path[-1]}]")
    return transactions_from_events(stream)
