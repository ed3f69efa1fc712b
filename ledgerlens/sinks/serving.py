"""A small table of sums that a stream keeps up to date for dashboards.

Every batch of a scored stream is summed per time bucket and category and
written to a folder of its own. A manifest per batch names the folders that
make up the table; it counts once it is written whole. A batch that is repeated
after a failure starts again from the manifest before it and replaces its own
folder and manifest, so it adds nothing twice. After ``every`` batches the
folders are summed into one, which bounds their number; that costs work in
proportion to buckets, never to transactions. Folders that no manifest since
the last but one of these compactions names are deleted, so that readers which
have just taken up a manifest can finish.

The stream itself holds no state: late rows are added to their bucket, however
late they come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.monitoring import count_rows, is_alert, ratio

COMPACT_EVERY = 16
SCHEMA = "bucket timestamp, merchant_category string, transactions long, frauds long, total_amount double, score_sum double"
MANIFEST = "folder string, base long"
SUMS = ["transactions", "frauds", "total_amount", "score_sum"]


def bucket_sums(scored: DataFrame, bucket: str = "5 minutes", fraud_col: str | None = None) -> DataFrame:
    """Sums per time bucket and category, a missing category by itself; rows without a time are left out."""
    return (
        scored.filter(F.col("timestamp").isNotNull())
        .groupBy(F.window("timestamp", bucket)["start"].alias("bucket"), "merchant_category")
        .agg(
            count_rows().alias("transactions"),
            F.count_if(is_alert(scored, fraud_col)).alias("frauds"),
            F.sum("amount").alias("total_amount"),
            F.sum("fraud_score").alias("score_sum"),
        )
    )


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("bucket", "merchant_category").agg(*[F.sum(c).alias(c) for c in SUMS])


class _Folder:
    """The few file-system calls the table needs, through Hadoop: the folder may be in any store."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._new(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, child: str) -> list[str]:
        where = self._new(f"{self.path}/{child}")
        return [s.getPath().getName() for s in self._files.listStatus(where)] if self._files.exists(where) else []

    def is_whole(self, child: str) -> bool:
        return self._files.exists(self._new(f"{self.path}/{child}/_SUCCESS"))

    def delete(self, child: str) -> None:
        self._files.delete(self._new(f"{self.path}/{child}"), True)


def _manifest(spark: SparkSession, folder: _Folder, below: int | None = None) -> tuple[list[str], int]:
    """(folders, batch of the last compaction) of the newest whole manifest, of those before batch ``below`` if given."""
    batches = sorted((int(n.partition("-")[2]) for n in folder.names("manifest")), reverse=True)
    for batch in batches:
        if (below is None or batch < below) and folder.is_whole(f"manifest/batch-{batch}"):
            rows = spark.read.schema(MANIFEST).json(f"{folder.path}/manifest/batch-{batch}").collect()  # at most COMPACT_EVERY + 1 rows
            return [r.folder for r in rows], rows[0].base
    return [], -1


def add_batch(batch: DataFrame, batch_id: int, path: str, every: int = COMPACT_EVERY, bucket: str = "5 minutes") -> None:
    """Add one batch of scored transactions to the table at ``path``."""
    spark, name = batch.sparkSession, f"sums/batch-{batch_id}"
    folder = _Folder(spark, path)
    live, base = _manifest(spark, folder, below=batch_id)
    bucket_sums(batch, bucket).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
    live = [*live, name]
    compacts = len(live) > every
    if compacts:
        whole = f"sums/base-{batch_id}"
        parts = spark.read.schema(SCHEMA).parquet(*[f"{path}/{f}" for f in live])
        _added(parts).hint("rebalance").write.mode("overwrite").parquet(f"{path}/{whole}")
        live = [whole]
    listed = spark.createDataFrame([(f, batch_id if compacts else base) for f in live], MANIFEST)
    listed.coalesce(1).write.mode("overwrite").json(f"{path}/manifest/batch-{batch_id}")
    if compacts and base >= 0:
        # All that was replaced by the compaction before this one.
        for child in ("sums", "manifest"):
            for old in folder.names(child):
                kind, _, number = old.partition("-")
                if int(number) < base or (child == "sums" and kind == "batch" and int(number) == base):
                    folder.delete(f"{child}/{old}")


def serve(scored: DataFrame, path: str, checkpoint: str, every: int = COMPACT_EVERY, trigger: str | None = "5 seconds") -> StreamingQuery:
    """Keep the table at ``path`` up to date with a scored stream; without a trigger the query drains its input and ends."""
    writer = scored.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.foreachBatch(lambda batch, batch_id: add_batch(batch, batch_id, path, every)).start()


def load_serving(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its newest manifest, one row per bucket and category."""
    live, _ = _manifest(spark, _Folder(spark, path))
    parts = spark.read.schema(SCHEMA).parquet(*[f"{path}/{f}" for f in live]) if live else spark.createDataFrame([], SCHEMA)
    return _added(parts)


def served_kpis(sums: DataFrame) -> DataFrame:
    """Headline numbers, one row."""
    total = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS])
    return total.select(
        F.col("transactions").alias("total_transactions"),
        F.col("frauds").alias("frauds_detected"),
        ratio(F.col("frauds"), F.col("transactions"), 100.0).alias("fraud_rate_pct"),
        "total_amount",
        ratio(F.col("score_sum"), F.col("transactions")).alias("avg_fraud_score"),
    )


def served_timeline(sums: DataFrame) -> DataFrame:
    """Transactions, frauds and the rest per bucket."""
    found = sums.groupBy("bucket").agg(F.sum("transactions").alias("total"), F.sum("frauds").alias("frauds"))
    return found.select("bucket", "total", "frauds", (F.col("total") - F.col("frauds")).alias("normal"))


def served_by_category(sums: DataFrame) -> DataFrame:
    found = sums.groupBy("merchant_category").agg(F.sum("frauds").alias("frauds"), F.sum("transactions").alias("total"))
    return found.withColumn("rate", ratio(F.col("frauds"), F.col("total")))


def served_hours(sums: DataFrame) -> DataFrame:
    found = sums.groupBy(F.hour("bucket").alias("hour")).agg(F.sum("transactions").alias("total"), F.sum("frauds").alias("frauds"))
    return found.select("hour", "total", "frauds")
