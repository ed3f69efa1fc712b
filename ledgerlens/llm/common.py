"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import work_dir

# A word is a run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Characters of scripts that set no space between words: Thai to Burmese, Khmer, kana, Han.
UNSPACED = "\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U000323af"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text as UTF-8; bytes.split() cuts at exactly the ASCII white space, lower() changes A-Z only."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    return data.lower().split() if lower else data.split()


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def crc32_remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Spark's file server hands it out, so nothing needs to be installed there.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="ledgerlens-package-")) / "ledgerlens_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, then give back what the task took: an idle worker lives on through later stages."""

    def task(items: Iterator) -> Iterator:
        try:
            yield from run(items)
        finally:
            free_memory()

    return task


def map_frames(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """mapInPandas with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInPandas(released(run), schema)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with this package at hand in the workers: columns need not become Python objects."""
    ship(df.sparkSession)
    return df.mapInArrow(released(run), schema)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame to the shared work folder and return the written table.

    Cuts the lineage: a lost executor costs no more than the tasks after it.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables that one call needs only until its result is written."""

    def __init__(self) -> None:
        self.kept: list[tuple[SparkSession, str]] = []

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        path = work_dir(df.sparkSession, label)
        self.kept.append((df.sparkSession, path))
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete the tables, through Hadoop's file system: the shared folder may be in any store.

        Spark removes the shuffle files they were made of when the driver
        collects its garbage; without a request that may be hours later.
        """
        for spark, path in self.kept:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        # A first collection frees the frames' objects, a second what only they held: the shuffles.
        for _ in range(2 if self.kept else 0):
            gc.collect()
            self.kept[0][0].sparkContext._jvm.System.gc()
            time.sleep(1)
        self.kept.clear()


def free_memory() -> None:
    """Give freed memory back to the system: a Python worker lives on and keeps what its largest task needed."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def within_broadcast(small: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """A stored list of hashes, sent to all tasks if it has at most ``limit`` rows (16 MB), else shuffled."""
    return F.broadcast(small) if small.count() <= limit else small


def text_lengths(texts: pd.Series) -> np.ndarray:
    return np.fromiter((len(t) if t else 0 for t in texts), dtype=np.int64, count=len(texts))


def small_frames(frames: Iterator[pd.DataFrame], text: str, limit: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into frames of about ``limit`` characters (one row at least)."""
    for frame in frames:
        if not len(frame):
            continue
        sizes = text_lengths(frame[text])
        piece = (sizes.cumsum() - sizes) // limit
        start = 0
        for end in [*((piece[1:] != piece[:-1]).nonzero()[0] + 1), len(frame)]:
            yield frame.iloc[start:end]
            start = end


def small_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        piece = (sizes.cumsum() - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)
