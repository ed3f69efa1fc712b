"""Language identification with spans.

Training counts letter trigrams and scripts per language. Prediction works on
words (runs of letters): a word's script leaves only the languages that use
it, each of these scores the word by its trigrams, and the best path through
the words, with a penalty for every change of language, labels the spans of a
mixed text. The language with most letters is the document's.

The model is fitted on at most about ``SAMPLE_DOCS`` documents per language,
chosen by a hash of the row; prediction covers every whole text. The model is a
table of 2**FEATURE_BITS + number of scripts counts per language, whatever the
size of the corpus.

Defined cases: a null, empty or letterless text is ``und`` with score 0, and so
is every text when nothing could be learned; ties go to the language that sorts
first; rows with the same doc_id are predicted separately.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import crc32_remainder, map_batches, map_frames, small_batches, small_frames

SAMPLE_DOCS = 4000
FEATURE_BITS = 16
SWITCH_PENALTY = 12.0
SCRIPT_SHARE = 0.001
UNKNOWN = "und"

# First and last code point of the blocks of each script.
SCRIPT_RANGES = {
    "latin": [(0x0041, 0x024F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x0530, 0x058F)],
    "hebrew": [(0x0590, 0x05FF)],
    "arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x0900, 0x097F)],
    "bengali": [(0x0980, 0x09FF)],
    "tamil": [(0x0B80, 0x0BFF)],
    "telugu": [(0x0C00, 0x0C7F)],
    "thai": [(0x0E00, 0x0E7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "ethiopic": [(0x1200, 0x137F)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
SCRIPTS = [*SCRIPT_RANGES, "other"]


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case, or 1 if it is no letter; its script."""
    lower = np.ones(sys.maxunicode + 1, dtype=np.uint32)
    for point in range(sys.maxunicode + 1):
        character = chr(point)
        if unicodedata.category(character)[0] == "L":
            small = character.lower()
            lower[point] = ord(small) if len(small) == 1 else point
    script = np.full(sys.maxunicode + 1, len(SCRIPTS) - 1, dtype=np.uint8)
    for i, ranges in enumerate(SCRIPT_RANGES.values()):
        for first, last in ranges:
            script[first : last + 1] = i
    return lower, script


def _letters(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Of all texts in a row: position, text and hashed trigram of each letter, start of each word, script of each word.

    A trigram is a letter with its neighbours; beside a word stands the mark 1.
    Positions count code points within the text.
    """
    lower, script = _characters()
    joined = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = lower[joined]
    inner = codes[1:-1]
    at = np.flatnonzero(inner != 1)
    mixed = codes[at] * np.uint32(0x9E3779B1) ^ codes[at + 1] * np.uint32(0x85EBCA77) ^ codes[at + 2] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    feature = (mixed >> np.uint32(32 - FEATURE_BITS)).astype(np.int64)
    begin = np.flatnonzero(codes[at] == 1)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(lengths)
    owner = np.searchsorted(ends, at, side="right")
    return at - (ends - lengths)[owner], owner, feature, begin, script[joined[1:-1][at[begin]]]


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    """Fit on the rows of ``docs`` with a text and a lang; returns the model as arrays."""
    labelled = docs.select("text", "lang", F.xxhash64("text", "doc_id").alias("h")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return {"languages": []}
    share = F.lit(1.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, sample_docs / sizes[lang]).otherwise(share)
    sample = labelled.filter(F.pmod("h", F.lit(1_000_000)) < share * 1_000_000)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, "text"):
            for lang, part in frame.groupby("lang"):
                _, _, feature, _, scripts = _letters(part["text"].tolist())
                features, n = np.unique(np.concatenate([feature, (1 << FEATURE_BITS) + scripts.astype(np.int64)]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "feature": features, "n": n})

    counted = map_frames(sample, count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    counts = np.zeros(((1 << FEATURE_BITS) + len(SCRIPTS), len(languages)))
    frame = counted.toPandas()  # at most languages x table size rows
    counts[frame["feature"].to_numpy(), frame["lang"].map(languages.index).to_numpy(dtype=int)] = frame["n"].to_numpy()
    grams, scripts = counts[: 1 << FEATURE_BITS], counts[1 << FEATURE_BITS :]
    weights = np.log((grams + 0.1) / (grams.sum(axis=0) + 0.1 * len(grams))).astype(np.float32)
    allowed = scripts / np.maximum(scripts.sum(axis=0), 1) >= SCRIPT_SHARE
    allowed[~allowed.any(axis=1)] = True
    return {"languages": languages, "weights": weights, "allowed": allowed}


def _labels(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word. ``scores``: word x language; ``first``: each text's first word.

    One language throughout is the best path if no run of words gains more than
    one penalty by another language: every run costs at least one change. That
    is tested with running sums; only the other texts need the step-by-step path.
    """
    n, k = scores.shape
    ends = np.append(first[1:], n)
    text = np.repeat(np.arange(len(first)), ends - first)
    main = np.add.reduceat(scores, first, axis=0).argmax(axis=1)
    labels = main[text]
    mixed = np.zeros(len(first), dtype=bool)
    base = np.take_along_axis(scores, labels[:, None], axis=1)[:, 0]
    for other in range(k):
        gain = np.cumsum(scores[:, other] - base)
        before = np.concatenate([[0.0], gain[:-1]])
        # Later texts lie far below earlier ones, so that the running minimum starts anew in each.
        apart = text * (2.0 * np.abs(gain).max() + 1.0)
        best = gain - (np.minimum.accumulate(before - apart) + apart)
        mixed |= np.maximum.reduceat(best, first) > penalty
    todo = np.flatnonzero(mixed)
    todo = todo[np.argsort(first[todo] - ends[todo], kind="stable")]  # the longest first
    if not len(todo):
        return labels
    lengths = (ends - first)[todo]
    total = scores[first[todo]].copy()
    came: list[np.ndarray] = []
    for step in range(1, int(lengths[0])):
        active = int(np.searchsorted(-lengths, -step, side="left"))
        held = total[:active]
        top = held.argmax(axis=1)
        switched = held[np.arange(active), top] - penalty
        stay = held >= switched[:, None]
        came.append(np.where(stay, np.arange(k), top[:, None]).astype(np.int16))
        total[:active] = np.where(stay, held, switched[:, None]) + scores[first[todo[:active]] + step]
    state = total.argmax(axis=1)
    labels[first[todo] + lengths - 1] = state
    for step in range(int(lengths[0]) - 1, 0, -1):
        active = len(came[step - 1])
        state[:active] = came[step - 1][np.arange(active), state[:active]]
        labels[first[todo[:active]] + step - 1] = state[:active]
    return labels


def predict_texts(texts: list[str | None], model: dict, penalty: float = SWITCH_PENALTY) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(lang_pred, score, spans) per text; the score is the share of the letters in spans of lang_pred."""
    out: list[tuple[str, float, list]] = [(UNKNOWN, 0.0, [])] * len(texts)
    languages = model["languages"]
    if not languages or not texts:
        return out
    position, owner, feature, begin, scripts = _letters([t or "" for t in texts])
    if not len(begin):
        return out
    scores = np.stack([np.add.reduceat(model["weights"][feature, i].astype(np.float64), begin) for i in range(len(languages))], axis=1)
    scores[~model["allowed"][scripts]] -= 1e6
    word_text = owner[begin]
    first = np.flatnonzero(np.diff(word_text, prepend=-1))
    labels = _labels(scores, first, penalty)
    letters = np.diff(np.append(begin, len(feature)))
    totals = np.zeros((len(texts), len(languages)))
    np.add.at(totals, (word_text, labels), letters)
    best = totals.argmax(axis=1)
    last = position[np.append(begin[1:], len(feature)) - 1] + 1
    cut = np.flatnonzero((np.diff(labels, prepend=-1) != 0) | (np.diff(word_text, prepend=-1) != 0))
    stop = np.append(cut[1:], len(labels)) - 1
    spans: dict[int, list] = {}
    for a, b in zip(cut, stop):
        spans.setdefault(int(word_text[a]), []).append((int(position[begin[a]]), int(last[b]), languages[labels[a]]))
    for i, found in spans.items():
        out[i] = (languages[best[i]], float(totals[i, best[i]] / totals[i].sum()), found)
    return out


def predict(docs: DataFrame, model: dict, keep: list[str], penalty: float = SWITCH_PENALTY, with_spans: bool = False) -> DataFrame:
    """Columns ``keep`` (own names) with lang_pred, score and, if asked, spans (start, end, lang)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # A text that is kept is sent once; kept columns pass through as they are.
    sent = [*keep] if "text" in keep else [*keep, "text"]
    at = sent.index("text")
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(sent)])
    kinds = [f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    extra = ["lang_pred string", "score double"] + ["spans array<struct<start:long,end:long,lang:string>>"] * with_spans
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, f"k{at}", limit=1_000_000):
            found = predict_texts(batch.column(at).to_pylist(), shared.value, penalty)
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            if with_spans:
                columns.append(pa.array([[{"start": a, "end": b, "lang": lang} for a, b, lang in x[2]] for x in found], span))
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in [*kinds, *extra]])

    found = map_batches(source, run, ", ".join([*kinds, *extra]))
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[c.split()[0] for c in extra])


def fit_and_predict(docs: DataFrame, keep: list[str], folds: int = 3, held: int = 1, **options) -> DataFrame:
    """Learn from the documents outside the held-out fold, predict all of them."""
    held_out = F.coalesce(crc32_remainder("doc_id", folds) == held, F.lit(False))
    model = train(docs.filter(~held_out))
    marked = docs.select(*keep, "text", held_out.alias("held_out")) if "text" not in keep else docs.select(*keep, held_out.alias("held_out"))
    return predict(marked, model, [*keep, "held_out"], **options)
