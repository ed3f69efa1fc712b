"""Message streams: reading, decoding and the quarantine for malformed rows."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schema import MESSAGE_SCHEMA, REQUIRED_COLUMNS, TRANSACTION_COLUMNS

_CORRUPT = "_corrupt"
_PARSE_SCHEMA = T.StructType([T.StructField(f.name, f.dataType, True) for f in MESSAGE_SCHEMA]).add(
    _CORRUPT, T.StringType()
)


def kafka_options(
    servers: str | None = None,
    topic: str | None = None,
    starting_offsets: str = "latest",
    max_per_trigger: int = 1000,
) -> dict[str, str]:
    """Options of a Kafka subscription; unset values come from the environment."""
    return {
        "kafka.bootstrap.servers": servers or os.getenv("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"),
        "subscribe": topic or os.getenv("KAFKA_TOPIC", "transactions"),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(max_per_trigger),
    }


def read_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    schema: T.StructType | None = None,
    max_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Open a stream of messages with a bounded intake per trigger.

    ``kafka`` needs the connector package on the class path. Any file format
    works too (``path`` option and ``schema``); there the limit counts files.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        named = {k: options.pop(k) for k in ("servers", "topic", "starting_offsets") if k in options}
        if max_per_trigger is not None:
            named["max_per_trigger"] = max_per_trigger
        return reader.options(**{**kafka_options(**named), **options}).load()
    if schema is not None:
        reader = reader.schema(schema)
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.options(**options).load()


def _decoded(df: DataFrame) -> DataFrame:
    """``raw`` text and decoded ``data`` of each message.

    The document passes through a one-element generator. A filter on decoded
    fields would otherwise be pushed below the projection, where the document
    is parsed anew for every field that the filter mentions.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    document = F.from_json("raw", _PARSE_SCHEMA, options)
    text = df.select(F.col("value").cast("string").alias("raw"))
    return text.select("raw", F.explode(F.array(document)).alias("data"))


def _typed() -> list[Column]:
    return [
        F.col("data.timestamp").try_cast("timestamp").alias("timestamp") if c == "timestamp" else F.col(f"data.{c}")
        for c in TRANSACTION_COLUMNS
    ]


def parse_messages(df: DataFrame) -> DataFrame:
    """Decode ``value`` into typed transactions; unreadable ones become nulls."""
    return _decoded(df).select(*_typed())


def classify_messages(df: DataFrame) -> DataFrame:
    """Decode once and add ``raw`` and ``quarantine_reason`` (null when valid)."""
    missing = F.lit(False)
    for name in REQUIRED_COLUMNS:
        missing = missing | F.col(f"data.{name}").isNull()
    broken = F.col("raw").isNull() | F.col("data").isNull() | F.col(f"data.{_CORRUPT}").isNotNull()
    reason = (
        F.when(broken, "malformed_json")
        .when(missing, "missing_field")
        .when(F.col("data.timestamp").try_cast("timestamp").isNull(), "bad_timestamp")
    )
    return _decoded(df).select("raw", reason.alias("quarantine_reason"), *_typed())


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid transactions, and the quarantined messages with their reason."""
    both = classify_messages(df)
    valid = both.filter(F.col("quarantine_reason").isNull()).select(*TRANSACTION_COLUMNS)
    return valid, both.filter(F.col("quarantine_reason").isNotNull()).select("raw", "quarantine_reason")


def quarantine_counts(df: DataFrame) -> DataFrame:
    """Messages per quarantine reason; ``valid`` counts the good ones."""
    reason = F.coalesce("quarantine_reason", F.lit("valid")).alias("reason")
    return classify_messages(df).groupBy(reason).agg(F.count(F.lit(1)).alias("messages"))
