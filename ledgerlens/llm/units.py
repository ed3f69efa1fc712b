"""Substring dedup by hashing lines and sentences.

A text is cut at line ends and after sentence ends. A unit starts at each
sentence and takes in the following ones until it has ``UNIT_WORDS`` words, so a
passage gives the same units wherever it stands. Units are normalised (lower
case, words joined by one space) and hashed to 128 bits. Of equal units the one
in the document that ranks first (smallest doc_id) stays; within that document
the first. Others are marked, marked units that touch are joined to spans, and
all spans are reported with their offsets (code points) in the original text;
``min_words`` leaves shorter ones out. A character of a script without spaces
counts as a word. The last sentences of a text may fall short of ``UNIT_WORDS``;
they are a unit only if they start a line, as a whole short line or paragraph.

Digests are counted by key with sums combined before the shuffle. Those of more
than ``1 / MAX_FREQUENT`` of the units are at most ``MAX_FREQUENT``: they are
broadcast and their units stay where they are. The others meet in a join with
one row per digest on its small side.

Defined cases: null and empty texts have no units. Rows without doc_id rank
last, by a hash of their text, and are documents of their own; those with the
same text count as one. Rows with the same doc_id count as parts of one
document and are not repeats of one another; their spans are kept apart by the
hash of the text, ``part``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import UNSPACED, map_frames, small_frames, stored

UNIT_WORDS = 8
MAX_FREQUENT = 10_000
LAST_RANK = (1 << 63) - 1
BORDER = re.compile(r"[\n\r  ]+|(?<=[.!?。])\s+|(?<=[。！？])")
LINE_END = re.compile(r"[\n\r\u2028\u2029]")
TOKEN = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")


def text_units(text: str, unit_words: int = UNIT_WORDS) -> list[tuple[int, int, int, int, bytes]]:
    """(start, end, first word, last word + 1, digest) of every unit of a text."""
    sentences, begin, word, opens = [], 0, 0, True
    for end, after in [*((m.start(), m.end()) for m in BORDER.finditer(text)), (len(text), len(text))]:
        words = TOKEN.findall(text[begin:end].lower())
        if words:
            sentences.append((begin, end, word, words, opens))
            word += len(words)
            opens = False
        opens = opens or LINE_END.search(text, end, after) is not None
        begin = after
    units, stop, held, joined = [], 0, 0, []
    for begin, _, first, words, opens in sentences:
        while stop < len(sentences) and held < unit_words:
            held += len(sentences[stop][3])
            joined.append(" ".join(sentences[stop][3]))
            stop += 1
        if held >= unit_words or opens:
            digest = xxhash.xxh3_128_digest(" ".join(joined).encode("utf-8", "surrogatepass"))
            units.append((begin, sentences[stop - 1][1], first, first + held, digest))
        held -= len(words)
        joined.pop(0)
    return units


def unit_table(docs: DataFrame, unit_words: int = UNIT_WORDS) -> DataFrame:
    """(rank, part, start, end, first, last, d1, d2, again): every unit; ``again``: seen earlier in this text."""
    source = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_RANK)).alias("rank"), F.xxhash64("text").alias("part"), F.col("text").alias("t")
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, "t"):
            ranks, parts, rows, again = [], [], [], []
            for rank, part, text in zip(frame["rank"], frame["part"], frame["t"]):
                seen: set[bytes] = set()
                for unit in text_units(text, unit_words) if text else ():
                    ranks.append(rank)
                    parts.append(part)
                    rows.append(unit)
                    again.append(unit[4] in seen)
                    seen.add(unit[4])
            if not rows:
                continue
            digests = np.frombuffer(b"".join(r[4] for r in rows), dtype="<i8").reshape(-1, 2)
            places = np.array([r[:4] for r in rows], dtype=np.int32).reshape(-1, 4)
            yield pd.DataFrame(
                {"rank": ranks, "part": parts, "start": places[:, 0], "end": places[:, 1], "first": places[:, 2], "last": places[:, 3],
                 "d1": digests[:, 0], "d2": digests[:, 1], "again": again}
            )

    return map_frames(source, run, "rank long, part long, start int, end int, first int, last int, d1 long, d2 long, again boolean")


def marked_units(units: DataFrame, max_frequent: int = MAX_FREQUENT) -> DataFrame:
    """The units that go, with ``kept``: (rank, part) of the document that keeps them."""
    # Documents with an id rank by it alone: their parts are no repeats of one another.
    place = F.struct("rank", F.when(F.col("rank") == LAST_RANK, F.col("part")).otherwise(0).alias("part"))
    counted = units.groupBy("d1", "d2").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    counted = stored(counted, "unit-digests")
    limit = units.count() // max_frequent
    frequent = F.broadcast(counted.filter(F.col("n") > limit).drop("n"))  # at most max_frequent rows
    rare = counted.filter(F.col("n") <= limit).drop("n")
    both = units.join(frequent, ["d1", "d2"]).unionByName(units.join(frequent, ["d1", "d2"], "left_anti").join(rare, ["d1", "d2"]))
    return both.filter(F.col("again") | (place > F.col("kept")))


def repeated_spans(docs: DataFrame, unit_words: int = UNIT_WORDS, min_words: int = 0) -> DataFrame:
    """(doc_id, part, start, end, n_words, first_doc_id): what to remove, and the document that keeps it."""
    marked = marked_units(stored(unit_table(docs, unit_words), "units"))
    ordered = Window.partitionBy("rank", "part").orderBy("start", "last")
    reach = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    islands = marked.withColumn("opens", F.when(F.col("first") <= reach, 0).otherwise(1))
    islands = islands.withColumn("island", F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy("rank", "part", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max("last") - F.min("first")).cast("long").alias("n_words"), F.min_by("kept.rank", "start").alias("kept"),
    )

    def real(column: str):
        return F.when(F.col(column) != LAST_RANK, F.col(column))

    return spans.filter(F.col("n_words") >= min_words).select(
        real("rank").alias("doc_id"), "part", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "n_words",
        real("kept").alias("first_doc_id"),
    )


def remove_spans(docs: DataFrame, spans: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` of every document, its text without the spans, and removed: array of (start, end, first_doc_id)."""
    cut = spans.groupBy(F.col("doc_id").alias("span_doc"), F.col("part").alias("span_part")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "first_doc_id"))).alias("removed"))
    own = F.col("doc_id").eqNullSafe(F.col("span_doc")) & (F.xxhash64("text") == F.col("span_part"))
    joined = docs.select(*dict.fromkeys([*keep, "doc_id", "text"])).join(cut, own, "left")
    gaps = F.aggregate(
        "removed",
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text")),
        lambda made, span: F.struct(
            span["end"].alias("at"),
            F.concat(made["text"], F.substring(F.col("text"), (made["at"] + 1).cast("int"), (span["start"] - made["at"]).cast("int"))).alias("text"),
        ),
    )
    left = F.concat(gaps["text"], F.substring(F.col("text"), (gaps["at"] + 1).cast("int"), F.length("text")))
    return joined.withColumn("text", F.when(F.col("removed").isNull(), F.col("text")).otherwise(left)).select(*dict.fromkeys([*keep, "text"]), "removed")
