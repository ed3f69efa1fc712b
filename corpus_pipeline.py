"""A corpus pipeline: from raw documents to token ids.

``run`` writes each stage's result to the shared work folder and reads it back,
so every stage works on all that its predecessor kept and a lost executor costs
no more than the running stage. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, langid, mixing, parity_join, templates
from ledgerlens.llm.common import DOCUMENT_COLUMNS, stored, table
from ledgerlens.llm.queries import BPE_RANKS

# Near duplicates in the pipeline: five words a shingle, 80 % of the union shared.
SHINGLE_WORDS, SHARED_PERCENT = 5, 80


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a language; ``lang`` becomes the main one, also of mixed texts."""
    found = langid.fit_and_predict(docs, DOCUMENT_COLUMNS)
    kept = found.filter(F.col("lang_pred") != langid.UNKNOWN)
    return kept.withColumn("lang", F.col("lang_pred")).select(*DOCUMENT_COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines of recurring templates; every document stays."""
    return templates.drop_lines(docs).select(*DOCUMENT_COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that with the smallest doc_id, of each group of linked documents."""
    return parity_join.keep_one(docs, DOCUMENT_COLUMNS, size=SHINGLE_WORDS, percent=SHARED_PERCENT)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources, a row per document and pass."""
    return mixing.mix_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of the bytes they decode to."""
    encoded = bpe.encode_documents(docs, BPE_RANKS, keep=("doc_id", "lang", "source"))
    return encoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources to target weights", mix_stage),
    ("byte-level BPE encoding and decoding", encode_stage),
]

# Language scores, templates and merges are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return docs
