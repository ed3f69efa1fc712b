"""Elias-Fano sequences and the two-level trie made of them.

A non-decreasing sequence of n numbers below u is kept in about 2 + log2(u / n)
bits a number: low bits as they are, high bits in unary. All arrays are plain
little-endian words, so a trie is one run of bytes that can be memory-mapped.
"""

from __future__ import annotations

import json
import tempfile

import numpy as np

ONE = np.uint64(1)


def _select_in_word(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Position of the ``nth`` set bit (from 0) of each word."""
    words, nth, at = words.copy(), nth.astype(np.int64), np.zeros(len(words), dtype=np.uint64)
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(words & np.uint64((1 << width) - 1)).astype(np.int64)
        up = nth >= below
        nth -= np.where(up, below, 0)
        shift = np.where(up, np.uint64(width), np.uint64(0))
        words >>= shift
        at += shift
    return at


class Sequence:
    """A non-decreasing sequence with random access to many places at once."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones

    @classmethod
    def build(cls, values: np.ndarray) -> Sequence:
        values = values.astype(np.uint64)
        n = len(values)
        bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        low = np.zeros(n * bits // 64 + 2, dtype=np.uint64)
        if bits:
            part = values & np.uint64((1 << bits) - 1)
            start = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, offset = (start >> np.uint64(6)).astype(np.int64), start & np.uint64(63)
            np.bitwise_or.at(low, word, part << offset)
            over = offset + np.uint64(bits) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - offset[over]))
        place = (values >> np.uint64(bits)) + np.arange(n, dtype=np.uint64)
        high = np.zeros((int(place[-1]) >> 6) + 1 if n else 1, dtype=np.uint64)
        np.bitwise_or.at(high, (place >> np.uint64(6)).astype(np.int64), ONE << (place & np.uint64(63)))
        counts = np.bitwise_count(high).astype(np.int64)
        return cls(n, bits, low, high, (np.cumsum(counts) - counts).astype(np.uint32))

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        i = i.astype(np.int64)
        word = np.searchsorted(self.ones, i.astype(np.uint32), side="right") - 1
        nth = i - self.ones[word].astype(np.int64)
        top = word.astype(np.uint64) * np.uint64(64) + _select_in_word(self.high[word], nth) - i.astype(np.uint64)
        if not self.low_bits:
            return top
        start = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, offset = (start >> np.uint64(6)).astype(np.int64), start & np.uint64(63)
        first = self.low[word] >> offset
        # A shift by 64 is undefined, so the next word is shifted in two steps.
        second = (self.low[word + 1] << (np.uint64(63) - offset)) << ONE
        return top << np.uint64(self.low_bits) | (first | second) & np.uint64((1 << self.low_bits) - 1)

    def successor(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """First place in [begin, end) whose number is at least the value, else end."""
        begin, end = begin.astype(np.int64).copy(), end.astype(np.int64).copy()
        open_ = np.flatnonzero(begin < end)
        while len(open_):
            middle = (begin[open_] + end[open_]) // 2
            less = self[middle] < values[open_]
            begin[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]
            open_ = open_[begin[open_] < end[open_]]
        return begin


class Trie:
    """Words, and below each word the contexts it was seen after.

    Level 1: word hashes; running totals of their counts; per word a quantised
    value and a pointer to its first context. Level 2: contexts relative to
    their word (word number above CONTEXT_BITS context bits), and per context a
    quantised gain. Values are kept as codes into a table of bin means.
    """

    CONTEXT_BITS = 40
    BINS = 4096

    @staticmethod
    def quantise(values: np.ndarray, bins: int, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(codes, table): bins of about equal weight, each standing for its mean. Up to ``bins`` distinct values stay exact."""
        if not len(values):
            return np.zeros(0, dtype=np.uint16), np.zeros(1)
        weights = np.ones(len(values)) if weights is None else weights.astype(np.float64)
        distinct, at = np.unique(values, return_inverse=True)
        share = np.bincount(at, weights=weights)
        if len(distinct) <= bins:
            return at.astype(np.uint16), distinct
        # A value that outweighs a bin gets one of its own.
        middle = np.cumsum(share) - share / 2
        place = np.minimum((middle / share.sum() * bins).astype(np.int64), bins - 1)
        sums = np.bincount(place, weights=distinct * share, minlength=bins)
        totals = np.bincount(place, weights=share, minlength=bins)
        return place[at].astype(np.uint16), sums / np.where(totals > 0, totals, 1)

    @classmethod
    def build(cls, words: np.ndarray, counts: np.ndarray, values: np.ndarray, parents: np.ndarray, contexts: np.ndarray, gains: np.ndarray) -> bytes:
        """Pack words (sorted) and (parent number, context) pairs (sorted) with their figures."""
        pointers = np.searchsorted(parents, np.arange(len(words) + 1))
        key = parents.astype(np.uint64) << np.uint64(cls.CONTEXT_BITS) | contexts.astype(np.uint64)
        codes, table = cls.quantise(values, cls.BINS, counts)
        gain_codes, gain_table = cls.quantise(gains, 256)
        parts: list[tuple[str, np.ndarray]] = []
        meta: dict = {"sequences": {}, "arrays": {}}
        for name, numbers in (("words", words), ("totals", np.cumsum(counts)), ("pointers", pointers), ("contexts", key)):
            made = Sequence.build(numbers)
            meta["sequences"][name] = [made.n, made.low_bits]
            parts += [(f"{name}.low", made.low), (f"{name}.high", made.high), (f"{name}.ones", made.ones)]
        parts += [("codes", codes), ("table", table), ("gain_codes", gain_codes.astype(np.uint8)), ("gain_table", gain_table)]
        at, body = 0, []
        for name, array in parts:
            raw = np.ascontiguousarray(array).tobytes()
            raw += b"\0" * (-len(raw) % 8)
            meta["arrays"][name] = [at, len(array), array.dtype.str]
            body.append(raw)
            at += len(raw)
        head = json.dumps(meta).encode()
        head += b" " * (-(len(head) + 8) % 8)
        return b"".join([len(head).to_bytes(8, "little"), head, *body])

    def __init__(self, data: bytes):
        """Map a packed trie from a temporary file without a name, which goes with the mapping."""
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            mapped = np.memmap(file, dtype=np.uint8, mode="r")
        size = int.from_bytes(mapped[:8].tobytes(), "little")
        meta = json.loads(mapped[8 : 8 + size].tobytes())

        def array(name: str) -> np.ndarray:
            at, n, kind = meta["arrays"][name]
            begin = 8 + size + at
            return mapped[begin : begin + n * np.dtype(kind).itemsize].view(kind)

        for name, (n, bits) in meta["sequences"].items():
            setattr(self, name, Sequence(n, bits, *(array(f"{name}.{part}") for part in ("low", "high", "ones"))))
        self.codes, self.table, self.gain_codes, self.gain_table = map(array, ("codes", "table", "gain_codes", "gain_table"))

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number or -1, count, value) of each word hash."""
        n = self.words.n
        at = self.words.successor(words, np.zeros(len(words)), np.full(len(words), n))
        found = at < n
        found[found] = self.words[at[found]] == words[found]
        number, count, value = np.where(found, at, -1), np.zeros(len(words), dtype=np.int64), np.zeros(len(words))
        hit = at[found]
        before = np.zeros(len(hit), dtype=np.int64)
        before[hit > 0] = self.totals[hit[hit > 0] - 1].astype(np.int64)
        count[found] = self.totals[hit].astype(np.int64) - before
        value[found] = self.table[self.codes[hit]]
        return number, count, value

    def gains(self, numbers: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """The gain of each (word number, context); 0 where the trie lacks the pair."""
        out = np.zeros(len(numbers))
        known = np.flatnonzero(numbers >= 0)
        if not len(known):
            return out
        number = numbers[known]
        begin, end = self.pointers[number].astype(np.int64), self.pointers[number + 1].astype(np.int64)
        key = number.astype(np.uint64) << np.uint64(self.CONTEXT_BITS) | contexts[known].astype(np.uint64)
        at = self.contexts.successor(key, begin, end)
        inside = at < end
        inside[inside] = self.contexts[at[inside]] == key[inside]
        out[known[inside]] = self.gain_table[self.gain_codes[at[inside]]]
        return out
