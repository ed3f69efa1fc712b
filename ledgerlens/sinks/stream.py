"""Stream sinks. Every sink takes an output mode and a trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ledgerlens.schema import CONSOLE_OUTPUT
from ledgerlens.session import work_dir


def _writer(df: DataFrame, output_mode: str, trigger: str | None, checkpoint: str) -> DataStreamWriter:
    """Common settings; without a trigger the query drains its input and ends."""
    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def to_console(
    df: DataFrame, output_mode: str = "append", trigger: str | None = "5 seconds", rows: int = 20
) -> StreamingQuery:
    shown = df.select(*CONSOLE_OUTPUT) if set(CONSOLE_OUTPUT) <= set(df.columns) else df
    writer = _writer(shown, output_mode, trigger, work_dir(df.sparkSession, "console")).format("console")
    return writer.option("truncate", "false").option("numRows", rows).start()


def to_memory(
    df: DataFrame,
    name: str = "fraud_detection_ml",
    output_mode: str = "append",
    trigger: str | None = "5 seconds",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Keep the result as a table in the driver.

    Meant for bounded results (aggregates in complete mode) and for tests. In
    append mode the table cannot be restored after a restart, so a checkpoint
    is only accepted for complete mode; otherwise each start gets a fresh one.
    """
    if output_mode == "append" and checkpoint:
        raise ValueError("a memory table in append mode cannot resume; write to Parquet instead")
    checkpoint = checkpoint or work_dir(df.sparkSession, name)
    return _writer(df, output_mode, trigger, checkpoint).format("memory").queryName(name).start()


def to_parquet(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "10 seconds",
    output_mode: str = "append",
) -> StreamingQuery:
    """Append to a Parquet table; the checkpoint folder belongs to this query only."""
    writer = _writer(df, output_mode, trigger, checkpoint).format("parquet")
    return writer.option("path", path).start()


def fan_out(
    df: DataFrame,
    path: str,
    checkpoint: str,
    view: str | None = "fraud_detection",
    console_rows: int = 0,
    trigger: str | None = "5 seconds",
) -> StreamingQuery:
    """Feed a Parquet table, a console preview and an SQL view from one query.

    Each batch is computed once and kept while the outputs are served. A batch
    is written to its own ``batch=<id>`` folder in overwrite mode, so a batch
    repeated after a failure replaces its first try instead of adding to it.
    The view reads the Parquet table: nothing accumulates in the driver.
    """

    def serve(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            if console_rows:
                batch.select(*[c for c in CONSOLE_OUTPUT if c in batch.columns]).show(console_rows, truncate=False)
            if view:
                spark.read.schema(batch.schema).parquet(path).createOrReplaceGlobalTempView(view)
        finally:
            batch.unpersist()

    return _writer(df, "append", trigger, checkpoint).foreachBatch(serve).start()


def write_mode(df: DataFrame, mode: str, path: str, checkpoint: str, table: str, trigger: str | None = "5 seconds"):
    """Start the sinks of ``mode``: console, parquet, memory, or all in one query."""
    if mode == "console":
        return to_console(df, trigger=trigger)
    if mode == "parquet":
        return to_parquet(df, path, checkpoint, trigger=trigger)
    if mode == "memory":
        return to_memory(df, table, trigger=trigger)
    if mode == "all":
        return fan_out(df, path, checkpoint, view=table, console_rows=20, trigger=trigger)
    raise ValueError(f"unknown mode: {mode}")
