"""Batch scans and small literal tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schema import MERCHANT_CATEGORIES, MERCHANT_SCHEMA, NARROW_COLUMNS, TRANSACTION_SCHEMA


def load_history(
    spark: SparkSession,
    path: str,
    from_month: tuple[int, int] | None = None,
    to_month: tuple[int, int] | None = None,
) -> DataFrame:
    """Scan history laid out as ``year=YYYY/month=MM``; months are inclusive.

    The bounds only mention partition columns, so other folders are not listed
    as scan input at all. They are written as whole-year and boundary-year
    comparisons, because arithmetic on the columns would not reach the
    metastore when the table is registered in a catalogue.
    """
    df = spark.read.parquet(path)
    year, month = F.col("year"), F.col("month")
    if from_month is not None:
        y, m = from_month
        df = df.filter((year > y) | ((year == y) & (month >= m)))
    if to_month is not None:
        y, m = to_month
        df = df.filter((year < y) | ((year == y) & (month <= m)))
    return df


def history_summary(history: DataFrame) -> DataFrame:
    """Rows and period of each month folder."""
    return history.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
    )


def scan_partitions(df: DataFrame) -> int:
    """How many tasks the scan is divided into."""
    return df.rdd.getNumPartitions()


def load_scored(
    spark: SparkSession, path: str, skip_unreadable: bool = False, schema: T.StructType | str | None = None
) -> DataFrame:
    """Read all Parquet files of a scored table.

    A damaged file ends the job, unless ``skip_unreadable`` asks to pass over
    such files; ``skipped_files`` then names them. Without a ``schema`` the
    columns are then taken from all readable files together, not from the first
    file, which may be a damaged one; a table of damaged files only needs one.
    """
    reader = spark.read
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    if schema is not None:
        reader = reader.schema(schema)
    elif skip_unreadable:
        reader = reader.option("mergeSchema", "true")
    df = reader.parquet(path)
    if "timestamp" in df.columns:
        df = df.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
    return df


def skipped_files(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """(file) for each file of the table from which ``skip_unreadable`` gets no row; empty files count as such."""
    name = F.col("_metadata.file_path").alias("file")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(name)
    read = load_scored(spark, path, skip_unreadable=True, schema=schema).select(name).distinct()
    return listed.join(read, "file", "left_anti")


def register_view(df: DataFrame, name: str = "fraud_detection_ml") -> DataFrame:
    """Expose a scored table to SQL under ``name`` and return its scan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def from_rows(spark: SparkSession, rows: list[tuple], columns: list[str] = NARROW_COLUMNS) -> DataFrame:
    """A transaction table from literal rows (timestamps as ISO strings)."""
    kinds = {f.name: f.dataType.simpleString() for f in TRANSACTION_SCHEMA}
    raw = spark.createDataFrame(
        rows, ", ".join(f"{c} {'string' if c == 'timestamp' else kinds[c]}" for c in columns)
    )
    return raw.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def merchant_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MERCHANT_CATEGORIES, MERCHANT_SCHEMA)


def enrich_merchant(df: DataFrame) -> DataFrame:
    """Add the category's usual amount and the ratio of the amount to it.

    The dimension has a fixed ten rows, hence the broadcast; unknown categories
    keep their row with nulls.
    """
    dim = merchant_dimension(df.sparkSession).select("merchant_category", "category_avg")
    joined = df.join(F.broadcast(dim), "merchant_category", "left")
    return joined.withColumn("amount_ratio", F.try_divide("amount", "category_avg"))
