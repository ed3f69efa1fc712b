"""Quality rules from repeated substrings.

The words of many texts stand in one array; sorting its suffixes by (text,
words) with doubling prefix lengths gives a suffix array per text. The longest
common prefixes of neighbouring suffixes come from the ranks of the doubling
steps. The longest prefix that a suffix shares with either neighbour is the
value of the innermost LCP interval that holds it, a maximal repeated substring.
The union of the occurrences of all repeats of at least ``MIN_REPEAT`` words
gives the covered fraction of the text. A document is dropped if that exceeds
``MAX_COVERED`` or its longest repeat has more than ``MAX_REPEAT`` words.

Everything is done per Arrow batch inside tasks; no shuffle.

Defined cases: a null, empty or blank text has no words, fails the base rule and
is not kept; rows are judged one by one, so repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_frames, small_frames, words_of

MIN_REPEAT = 10
MAX_COVERED = 0.3
MAX_REPEAT = 200
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
DROP_SPACE = dict.fromkeys([0x20, *range(0x09, 0x0E)])


def suffix_repeats(words: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """For each word: the length of the longest repeat within its text that starts there.

    ``words``: ids; ``texts``: number of the text of each word, ascending.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    _, rank = np.unique(texts * (int(words.max()) + 1) + words, return_inverse=True)
    # A rank is the place of the first of its ties, so ties can be told apart without moving other ranks.
    sizes = np.bincount(rank)
    active = np.flatnonzero(sizes[rank] > 1)
    rank = (np.cumsum(sizes) - sizes)[rank]
    levels, width = [rank], 1
    while len(active):
        # Only suffixes that still tie are sorted. One that ends with its text comes first.
        ahead = active + width
        inside = ahead < n
        inside[inside] = texts[ahead[inside]] == texts[active[inside]]
        second = np.full(len(active), -1, dtype=np.int64)
        second[inside] = rank[ahead[inside]]
        order = np.lexsort((second, rank[active]))
        first, second = rank[active][order], second[order]
        new_tie = np.concatenate([[True], first[1:] != first[:-1]])
        new_pair = new_tie | np.concatenate([[True], second[1:] != second[:-1]])
        place = np.arange(len(order))
        tie_start = np.maximum.accumulate(np.where(new_tie, place, 0))
        pair_start = np.maximum.accumulate(np.where(new_pair, place, 0))
        rank = rank.copy()
        rank[active[order]] = first + (pair_start - tie_start)
        levels.append(rank)
        width *= 2
        active = active[order][np.bincount(pair_start, minlength=len(order))[pair_start] > 1]
    order = np.argsort(rank, kind="stable")
    left, right = order[:-1], order[1:]
    shared = np.zeros(max(n - 1, 0), dtype=np.int64)
    live = texts[left] == texts[right]
    for level in range(len(levels) - 1, -1, -1):
        a, b = left + shared, right + shared
        same = live & (a < n) & (b < n)
        same[same] = levels[level][a[same]] == levels[level][b[same]]
        shared += same << level
    longest = np.zeros(n, dtype=np.int64)
    longest[left] = shared
    longest[right] = np.maximum(longest[right], shared)
    return longest


def covered_words(longest: np.ndarray, length: int) -> np.ndarray:
    """Which words lie in an occurrence of a repeat of at least ``length`` words."""
    starts = np.flatnonzero(longest >= length)
    change = np.zeros(len(longest) + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + longest[starts], -1)
    return np.cumsum(change[:-1]) > 0


def window_words(longest: np.ndarray, size: int = 3) -> np.ndarray:
    """Which words lie in a window of ``size`` words that occurs twice or more in the text."""
    change = np.zeros(len(longest) + size, dtype=np.int64)
    starts = np.flatnonzero(longest >= size)
    change[starts] += 1
    np.add.at(change, starts + size, -1)
    return np.cumsum(change)[: len(longest)] > 0


def per_text(values: np.ndarray, first: np.ndarray, counts: np.ndarray, how=np.add) -> np.ndarray:
    """Reduce word values by text; 0 for a text without words."""
    out = np.zeros(len(counts), dtype=np.int64)
    filled = counts > 0
    if filled.any():
        out[filled] = how.reduceat(values, first[filled])
    return out


def measure(texts: list[str | None], min_repeat: int = MIN_REPEAT) -> pd.DataFrame:
    """The base figures, covered words and longest repeat of each text."""
    split = [words_of(t) for t in texts]
    counts = np.array([len(w) for w in split], dtype=np.int64)
    first = np.cumsum(counts) - counts
    everything = [w for words in split for w in words]
    ids = pd.factorize(np.array(everything, dtype=object))[0].astype(np.int64) if everything else np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    longest = suffix_repeats(ids, owner)
    dup_lines = []
    for text in texts:
        lines = [line for line in text.split("\n") if line.strip("\x20\t\n\x0b\x0c\r")] if text else []
        dup_lines.append(len(lines) - len(set(lines)))
    return pd.DataFrame(
        {
            "n_words": counts,
            "word_chars": [len(t.translate(DROP_SPACE)) if t else 0 for t in texts],
            "n_symbols": [sum(map(t.count, SYMBOLS)) if t else 0 for t in texts],
            "n_dup_lines": dup_lines,
            "n_repeat_words": per_text(window_words(longest).astype(np.int64), first, counts),
            "covered_words": per_text(covered_words(longest, min_repeat).astype(np.int64), first, counts),
            "longest_repeat": per_text(longest, first, counts, np.maximum),
        }
    )


def quality(
    docs: DataFrame, keep: list[str], min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """Columns ``keep`` with the figures of ``measure``, base_failed and kept."""
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col("text").alias("t"))
    kinds = [f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, "t", limit=1_000_000):
            out = frame.drop(columns="t").reset_index(drop=True)
            yield pd.concat([out, measure(frame["t"].tolist(), min_repeat)], axis=1)

    measured = map_frames(source, run, ", ".join([*kinds, *(f"{f} long" for f in figures)]))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fine = (F.col("covered_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_repeat)
    return measured.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *figures, base_failed.alias("base_failed"), (~base_failed & fine).alias("kept")
    )
