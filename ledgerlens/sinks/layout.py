"""History laid out for work per user: bucketed, sorted, hot users in pieces.

The table holds what ``slices.with_slices`` makes of the history: the rows and
the carry rows of hot users' slices, with ``place``, a hash of user and slice.
It is bucketed by ``place`` and sorted as the windows per user want it, one file
per bucket, so the features of ``operators.history`` read it without an exchange
or a sort, and a hot user's slices lie in different buckets. It is written once
and read by as many queries as there are; each saves the shuffle of the table
and the search for hot users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators.history import COUNT_WINDOW_SECONDS, PREVIOUS
from ledgerlens.operators.slices import DEFAULT_POLICY, ID, KEY, TIME, HotPolicy, with_slices

ORDER = ["place", KEY, "slice", "second", TIME, ID]
# Sorted files are trusted only if this is on; each bucket is one file here.
ORDERED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def write_layout(
    df: DataFrame, table: str, path: str, buckets: int = 200, horizon: int = COUNT_WINDOW_SECONDS, policy: HotPolicy | None = DEFAULT_POLICY
) -> None:
    """Write transactions as the table ``table`` with its files under ``path``.

    ``buckets`` sets the size of a file: the table's rows divided by it. Dealing
    by the same hash as the buckets gives one task, so one file, for each.
    """
    rows = with_slices(df, list(PREVIOUS.values()), horizon, policy)
    dealt = rows.repartition(buckets, "place").sortWithinPartitions(*ORDER)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path).option("maxRecordsPerFile", 0)
    writer.bucketBy(buckets, "place").sortBy(*ORDER).saveAsTable(table)


def load_layout(spark: SparkSession, table: str) -> DataFrame:
    """The table, for the functions of ``operators.history`` and ``operators.patterns``."""
    spark.conf.set(ORDERED_SCAN, "true")
    return spark.table(table)
