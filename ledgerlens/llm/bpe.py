"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of text there is exactly one token that can end the
prefix's encoding. It is the token t, ending there, for which the encoding of
what precedes ends with a token p such that (p, t) is a valid neighbour pair:
merging the bytes of p and t gives back p and t. Keeping that last token per
prefix gives the encoding of each prefix by walking back, lets text be appended
exactly, and limits an edit to the pieces around it.

Ids equal those of the usual lowest-rank-first merging over the same ranks.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_frames, small_frames

NO_PARENT = 1 << 60
CACHED = 250_000  # pieces and token pairs that a task remembers


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks, and what the neighbour test needs of each token's merge history."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.left_spines: dict[int, list[tuple[int, int]]] = {}
        self.right_spines: dict[int, list[tuple[int, int]]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        # Token bytes reversed, as a trie of dicts: found from a prefix's end backwards.
        self.trie: dict = {}
        for token, rank in ranks.items():
            node = self.trie
            for byte in reversed(token):
                node = node.setdefault(byte, {})
            node[-1] = rank

    def split(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a byte or a token that merging never makes."""
        if rank not in self.halves:
            parts = self.merge(self.bytes_of[rank], below=rank)
            self.halves[rank] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.halves[rank]

    def merge(self, piece: bytes, below: int = NO_PARENT) -> list[int]:
        """Plain merging with ranks under ``below``; used on single tokens only."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min((self.ranks.get(a + b, NO_PARENT), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best[0] >= below:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def reachable(self, rank: int) -> bool:
        return len(self.bytes_of[rank]) == 1 or self.split(rank) is not None

    def spine(self, rank: int, side: int) -> list[tuple[int, int]]:
        """Tokens that stand at the left (0) or right (1) edge while ``rank`` is merged, each with what absorbs it."""
        kept = self.right_spines if side else self.left_spines
        if rank not in kept:
            path, token, parent = [], rank, NO_PARENT
            while True:
                path.append((token, parent))
                halves = self.split(token)
                if halves is None:
                    break
                token, parent = halves[side], token
            kept[rank] = path
        return kept[rank]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merging never crosses the border between the two tokens.

        A crossing merge happens if its rank is due while both edge tokens
        stand. Of equal ranks the leftmost is merged first, hence < and <=.
        """
        known = self.pairs.get((left, right))
        if known is None:
            known = True
            for x, x_parent in self.spine(left, 1):
                head = self.bytes_of[x]
                for y, y_parent in self.spine(right, 0):
                    rank = self.ranks.get(head + self.bytes_of[y])
                    if rank is not None and rank < x_parent and rank <= y_parent:
                        known = False
            self.pairs[(left, right)] = known
        return known

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Continue the last tokens of the prefixes of ``piece`` beyond those already known."""
        trie, pairs = self.trie, self.pairs
        for end in range(len(last) + 1, len(piece) + 1):
            node, start, found = trie, end, []
            while start > 0 and (node := node.get(piece[start - 1])) is not None:
                start -= 1
                if -1 in node:
                    found.append((start, node[-1]))
            while True:
                start, rank = found.pop()  # the longest first
                if start == 0:
                    valid = self.reachable(rank)
                else:
                    before = last[start - 1]
                    valid = pairs.get((before, rank))
                    if valid is None:
                        valid = self.reachable(rank) and self.neighbours(before, rank)
                if valid:
                    last.append(rank)
                    break
        return last

    def encode_pieces(self, pieces: list[bytes]) -> Iterator[list[int]]:
        """Encode sorted pieces; what a piece shares with the one before it is not computed again."""
        before, last = b"", []
        for piece in pieces:
            rank = self.ranks.get(piece)
            if rank is not None:
                yield [rank]
                continue
            same, most = 0, min(len(before), len(piece))
            while same < most and before[same] == piece[same]:
                same += 1
            del last[same:]
            before = piece
            yield self.walk_back(self.extend(piece, last))

    def walk_back(self, last: list[int]) -> list[int]:
        ids, end = [], len(last)
        while end:
            ids.append(last[end - 1])
            end -= len(self.bytes_of[ids[-1]])
        return ids[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """A piece that is a token stands for itself, as in the usual encoders."""
        rank = self.ranks.get(piece)
        return [rank] if rank is not None else self.walk_back(self.extend(piece, []))

    def forget(self) -> None:
        """Empty the caches, which only save time."""
        self.known.clear()
        self.pairs.clear()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixEncoding:
    """A text with the last token of every byte prefix of each of its pieces."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = public_tokenizers.PATTERN, text: str = ""):
        self.vocabulary, self.pattern, self.text = vocabulary, regex.compile(pattern), ""
        self.pieces: list[tuple[int, str, list[int]]] = []  # start, piece, last tokens
        self.append(text)

    def _cut(self, start: int, known: dict[int, tuple[str, list[int]]] | None = None) -> Iterator[tuple[int, str, list[int]]]:
        for match in self.pattern.finditer(self.text, start):
            piece = match.group()
            yield match.start(), piece, self.vocabulary.extend(piece.encode(), [])

    def append(self, more: str) -> None:
        """Only the last piece can change: the pattern looks one character ahead at most."""
        old = self.pieces.pop() if self.pieces else (0, "", [])
        self.text += more
        for match in self.pattern.finditer(self.text, old[0]):
            piece = match.group()
            kept = list(old[2]) if match.start() == old[0] and piece.startswith(old[1]) else []
            self.pieces.append((match.start(), piece, self.vocabulary.extend(piece.encode(), kept)))

    def replace(self, start: int, end: int, new: str) -> None:
        """Replace text[start:end]; pieces are cut anew until they fall in with the old ones."""
        shift = len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        keep = 0
        while keep < len(self.pieces) and self.pieces[keep][0] + len(self.pieces[keep][1]) < start:
            keep += 1
        old = {at + shift: i for i, (at, _, _) in enumerate(self.pieces) if at >= end}
        head, tail = self.pieces[:keep], []
        begin = head[-1][0] + len(head[-1][1]) if head else 0
        for piece in self._cut(begin):
            if piece[0] in old and piece[0] > start + len(new):
                tail = [(at + shift, text, last) for at, text, last in self.pieces[old[piece[0]] :]]
                break
            head.append(piece)
        self.pieces = head + tail

    def ids(self) -> list[int]:
        out: list[int] = []
        for _, piece, last in self.pieces:
            rank = self.vocabulary.ranks.get(piece.encode())
            out.extend([rank] if rank is not None else self.vocabulary.walk_back(last))
        return out


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(read_ranks(path))


def _local(path: str) -> str:
    """``name`` of a file given to spark.sparkContext.addFile, or a path that every node has."""
    return SparkFiles.get(path.removeprefix("sparkfile:")) if path.startswith("sparkfile:") else path


def encode_documents(
    docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Columns ``keep`` with ids (array<int>) and decoded (binary) for every whole text.

    A null or empty text has no ids. ``path`` is the rank file: a path that all
    nodes have, or ``sparkfile:name`` of a file sent with ``addFile``.
    """
    return _encoded(docs, path, pattern, keep, digest=False)


def encode_digests(
    docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """As ``encode_documents``, with n_tokens and the SHA-256 of ids and decoded bytes instead of both."""
    return _encoded(docs, path, pattern, keep, digest=True)


def _encoded(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...], digest: bool) -> DataFrame:
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col("text").alias("t"))
    kinds = [f"k{i} {dict(docs.dtypes)[c]}" for i, c in enumerate(keep)]
    extra = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"] if digest else ["ids array<int>", "decoded binary"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = _vocabulary(_local(path))
        try:
            yield from encoded_frames(frames, vocabulary)
        finally:  # the worker goes on to tasks of other kinds
            vocabulary.forget()
            _vocabulary.cache_clear()

    def encoded_frames(frames: Iterator[pd.DataFrame], vocabulary: Vocabulary) -> Iterator[pd.DataFrame]:
        known, cut = vocabulary.known, regex.compile(pattern)
        for frame in small_frames(frames, "t"):
            if len(known) + len(vocabulary.pairs) > CACHED:
                vocabulary.forget()
            out = frame.drop(columns="t")
            rows = []
            cuts = [cut.findall(text) if text else [] for text in frame["t"]]
            new = sorted({piece.encode(): piece for piece in set().union(*cuts).difference(known)}.items())
            for (_, piece), ids in zip(new, vocabulary.encode_pieces([piece for piece, _ in new])):
                known[piece] = array("I", ids).tobytes()
            for pieces in cuts:
                packed = b"".join(map(known.__getitem__, pieces))
                ids = memoryview(packed).cast("I")
                decoded = vocabulary.decode(ids)
                if digest:
                    rows.append((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
                else:
                    rows.append((list(ids), decoded))
            for i, column in enumerate(extra):
                out[column.split()[0]] = [row[i] for row in rows]
            yield out

    encoded = map_frames(source, run, ", ".join([*kinds, *extra]))
    return encoded.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[c.split()[0] for c in extra])
