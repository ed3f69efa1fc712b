"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct shingles. Shingles are dealt by hash to k
words, and a word is the XOR of its shingles' hashes: every shingle in which two
sets differ changes one word. Folded to 64 parity bits a word, the words make
the sketch, whose Hamming distance is at most the size of the symmetric
difference. A pair links only if that size is at most
``(100 - p) / (100 + p) * (|A| + |B|)``.

Documents are compared within size bands; one near the top of its band is also
in the next. In a band whose largest bound is d there are k > d + 1 words. A
document of n shingles with partners of up to m in the band differs from any
that links in at most e = (100 - p) / (100 + p) * (n + m) words, so they agree
in k - e. It offers the e + 1 words that come first in an order that depends on
the words alone (most shingles first); by the prefix argument two linked
documents share an offered word. Unrelated documents share one only if they
share all of its shingles.

Texts with equal sets are one node. From each bucket of equal words the pairs
with its smallest and largest node come first; they are tested by Hamming
distance, then exactly, and linked nodes are merged. Only pairs of a bucket that
are still in different components need testing: buckets are cut into cells of
bounded size, in which all such pairs are tested by Hamming distance, and what
passes is tested exactly. So groups of copies never emit all their pairs, and no
link between different components is lost.

Tests get the compressed texts and make sets and sketches again: these would be
several times as large. Texts move only for nodes that share a bucket.

Defined cases: a text with fewer words than a shingle is its whole word
sequence; null or wordless texts have an empty set and link with nothing; a null
doc_id never becomes a component_id unless the component has no other; rows with
equal doc_id are separate documents. Shingles and nodes are compared by 64-bit
hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, map_batches, map_frames, small_frames, stored, within_broadcast, words_of
from ledgerlens.llm.components import components

SIZE = 5
PERCENT = 80
BAND_RATIO = 2.0
SPARE = 1.3
CELL = 1024
NO_ID = (1 << 63) - 1
CELL_KEY = ["key", "x", "y"]
BAND_SHIFT = np.uint64(56)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every bit of ``x`` over the result."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, letters A-Z lower-cased."""
    split = [words_of(t, lower=True) for t in texts]
    vocabulary = {w: i for i, w in enumerate(set().union(*split))}
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), dtype=np.uint64, count=len(vocabulary))
    sets = []
    for words in split:
        if not words:
            sets.append(np.zeros(0, dtype=np.uint64))
            continue
        ids = hashes[np.fromiter(map(vocabulary.__getitem__, words), dtype=np.int64, count=len(words))]
        width = min(size, len(words))
        shingles = np.full(len(words) - width + 1, width, dtype=np.uint64)
        for i in range(width):
            shingles = mixed(shingles * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + len(shingles)])
        sets.append(np.unique(shingles))
    return sets


def node_of(shingles: np.ndarray) -> int:
    """A signed 64-bit name of the set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def band_top(band: int) -> int:
    return math.ceil(BAND_RATIO ** (band + 1)) - 1


def band_of(n: int) -> int:
    band = max(0, int(math.log(n) / math.log(BAND_RATIO)) - 1)
    while band_top(band) < n:
        band += 1
    return band


def bound(total: int, percent: int) -> int:
    """The largest symmetric difference of linked sets with sizes summing to ``total``."""
    return (100 - percent) * total // (100 + percent)


def bands(n: int, percent: int) -> list[int]:
    """The document's band, and the next if a larger document there can link. None if only equal sets link."""
    band = band_of(n)
    found = [band]
    if 100 * n >= percent * (band_top(band) + 1):
        found.append(band + 1)
    return [b for b in found if bound(2 * band_top(b), percent) > 0]


def n_words(band: int, percent: int) -> int:
    return math.ceil(SPARE * (bound(2 * band_top(band), percent) + 1))


def sketch(shingles: np.ndarray, band: int, percent: int) -> np.ndarray:
    """Parity words of 64 bits."""
    k = n_words(band, percent)
    word = (shingles >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)
    flips = np.bincount((word * np.uint64(64) + (shingles & np.uint64(63))).astype(np.int64), minlength=64 * k)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").view("<u8")


def offered_words(shingles: np.ndarray, band: int, percent: int) -> np.ndarray:
    """Bucket keys of the words that a document offers; the highest byte is the band."""
    k = n_words(band, percent)
    word = ((shingles >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.diff(word, prepend=-1))  # shingles are sorted, so are their words
    values, counts = np.zeros(k, dtype=np.uint64), np.zeros(k, dtype=np.uint64)
    values[word[starts]] = np.bitwise_xor.reduceat(mixed(shingles), starts)
    counts[word[starts]] = np.diff(starts, append=len(word))
    place = np.arange(band << 32, (band << 32) + k, dtype=np.uint64)
    keys = mixed(mixed(values + counts) + place) >> np.uint64(8)
    order = (np.uint64(255) - np.minimum(counts, np.uint64(255)) << BAND_SHIFT) | keys
    most = min(band_top(band), 100 * len(shingles) // percent)
    first = np.argsort(order)[: bound(len(shingles) + most, percent) + 1]
    return (keys[first] | np.uint64(band) << BAND_SHIFT).view(np.int64)


def ranked(docs: DataFrame) -> DataFrame:
    """(rank, k, text): the doc_id, largest for null, and a hash of the text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("rank"), F.xxhash64("text").alias("k"), "text")


def scan(docs: DataFrame, size: int) -> DataFrame:
    """(rank, k, n, node): one row per document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, "text", limit=2_000_000):
            sets = shingle_sets(frame["text"].tolist(), size)
            out = frame[["rank", "k"]].copy()
            out["n"] = [len(s) for s in sets]
            out["node"] = pd.array([node_of(s) if len(s) else None for s in sets], dtype="Int64")
            yield out

    return map_frames(ranked(docs), run, "rank long, k long, n long, node long")


def offers(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(key, node) per offered word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = (batch.to_pandas() for batch in batches)
        for frame in small_frames(frames, "text", limit=500_000):
            keys, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for s in shingle_sets(frame["text"].tolist(), size):
                if len(s):
                    mine = [offered_words(s, b, percent) for b in bands(len(s), percent)]
                    keys += mine
                    nodes += [np.full(sum(map(len, mine)), node_of(s), dtype=np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes))], ["key", "node"])

    return map_batches(texts.select("text"), run, "key long, node long")


def packed_texts(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """(node, packed): the compressed text of the document chosen for each node (rank, k, node)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for frame in small_frames(frames, "text"):
            yield pd.DataFrame({"node": frame["node"], "packed": [pack(t.encode("utf-8", "surrogatepass")) for t in frame["text"]]})

    return map_frames(texts.join(within_broadcast(chosen), ["rank", "k"]).select("node", "text"), run, "node long, packed binary")


def unpacked_sets(packed: pd.Series, size: int) -> list[np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    return shingle_sets([unpack(p).decode("utf-8", "surrogatepass") for p in packed], size)


def linked_pairs(pairs: DataFrame, packed: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, tested by Hamming distance, then on the whole shingle sets."""
    left, right = packed.toDF("a", "ta"), packed.toDF("b", "tb")

    def linked(x: np.ndarray, y: np.ndarray) -> bool:
        small, large = (x, y) if len(x) < len(y) else (y, x)
        band, most = band_of(len(large)), bound(len(x) + len(y), percent)
        if np.bitwise_count(sketch(small, band, percent) ^ sketch(large, band, percent)).sum() > most:
            return False
        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
        shared = int((large[at] == small).sum())
        return 100 * shared >= percent * (len(x) + len(y) - shared)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = frame["ta"].map(len).to_numpy() + frame["tb"].map(len).to_numpy()
            for _, some in frame.groupby((sizes.cumsum() - sizes) // 1_000_000):
                texts = pd.concat([some[["a", "ta"]].set_axis(["node", "t"], axis=1), some[["b", "tb"]].set_axis(["node", "t"], axis=1)])
                texts = texts.drop_duplicates("node")
                sets = dict(zip(texts["node"].tolist(), unpacked_sets(texts["t"], size)))
                keep = [linked(sets[a], sets[b]) for a, b in zip(some["a"].tolist(), some["b"].tolist())]
                yield some.loc[keep, ["a", "b"]]

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return map_frames(both, run, "a long, b long")


def sketches_of(packed: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, band, n, words): the compressed sketches of each node."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for frame in frames:
            for start in range(0, len(frame), 100):
                some = frame.iloc[start : start + 100]
                rows = [
                    (node, b, len(s), pack(sketch(s, b, percent).tobytes()))
                    for node, s in zip(some["node"].tolist(), unpacked_sets(some["packed"], size))
                    for b in bands(len(s), percent)
                ]
                yield pd.DataFrame(rows, columns=["node", "band", "n", "words"])

    return map_frames(packed, run, "node long, band int, n long, words binary")


def cells(members: DataFrame, cell: int = CELL) -> DataFrame:
    """Deal the members (key, node, n_members, ...) of each bucket to cells (key, x, y) that hold every pair of them.

    A bucket of up to ``cell`` members is one cell. A larger one is cut into
    chunks, and every two chunks meet in a cell.
    """
    chunks = F.ceil(F.col("n_members") / cell).cast("int")
    mine = F.pmod(F.xxhash64("node", "key"), chunks).cast("int")
    dealt = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return dealt.withColumn("x", F.least("mine", "other")).withColumn("y", F.greatest("mine", "other")).drop("other")


def remaining_pairs(members: DataFrame, roots: DataFrame, packed: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): pairs that share a bucket, lie in different components and whose sketches allow a link."""
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_keys = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n_members"))
    # With up to three members, every pair holds the smallest or the largest and has been tested.
    open_keys = open_keys.filter("lo <> hi AND n_members > 3").select("key", "n_members")
    full = scratch.stored(placed.join(open_keys, "key").select("key", "node", "root", "n_members"), "parity-open")
    known = scratch.stored(sketches_of(packed.join(full.select("node").distinct(), "node"), size, percent), "parity-sketches")
    full = full.withColumn("band", F.shiftrightunsigned("key", int(BAND_SHIFT)).cast("int")).join(known, ["node", "band"])
    dealt = cells(full).select("key", "x", "y", "mine", "node", "root", "n", "words")

    def test(frame: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor().decompress
        words = np.stack([np.frombuffer(unpack(w), "<u8") for w in frame["words"]])
        n, root, node, mine = (frame[c].to_numpy() for c in ("n", "root", "node", "mine"))
        split = frame["x"].iloc[0] != frame["y"].iloc[0]
        rows = np.flatnonzero(mine == mine.min()) if split else np.arange(len(frame))
        step = max(1, 4_000_000 // words.size)
        a, b = [], []
        for start in range(0, len(rows), step):
            some = rows[start : start + step]
            apart = np.bitwise_count(words[some][:, None, :] ^ words[None, :, :]).sum(axis=2, dtype=np.int64)
            most = (100 - percent) * (n[some][:, None] + n[None, :]) // (100 + percent)
            near = (apart <= most) & (root[some][:, None] != root[None, :])
            near &= (mine[None, :] != mine[some][:, None]) if split else (some[:, None] < np.arange(len(frame))[None, :])
            i, j = np.nonzero(near)
            a.append(node[some[i]])
            b.append(node[j])
        a, b = np.concatenate(a), np.concatenate(b)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by cell; the last cell of a frame may go on in the next.
        kept: pd.DataFrame | None = None
        for frame in frames:
            frame = frame if kept is None else pd.concat([kept, frame], ignore_index=True)
            cell = frame[CELL_KEY].to_numpy()
            cuts = [0, *(np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1)]
            for start, end in zip(cuts, cuts[1:]):
                yield test(frame.iloc[start:end])
            kept = frame.iloc[cuts[-1] :]
        if kept is not None and len(kept):
            yield test(kept)

    return map_frames(dealt.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY), run, "a long, b long").distinct()


def one_text_per_node(docs: DataFrame, scanned: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(rank, k, text) of the documents chosen in ``nodes``, and of those without a word."""
    others = scanned.join(nodes.select("node", F.col("rank").alias("r"), F.col("k").alias("c")), "node").filter("rank <> r OR k <> c")
    others = scratch.stored(others.select("rank", "k").distinct(), "parity-copies")
    texts = ranked(docs).join(within_broadcast(others), ["rank", "k"], "left_anti")
    repeated = scanned.groupBy("rank", "k").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").head(1)
    return texts.dropDuplicates(["rank", "k"]) if repeated else texts


def joined(docs: DataFrame, size: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(documents as rank, k, n, node; nodes in components of two or more as node, root)."""
    scanned = scratch.stored(scan(docs, size), "parity-scan")
    # One row per node: its smallest document.
    first = scanned.filter("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("rank", "k")).alias("first"), F.min("n").alias("n"))
    nodes = scratch.stored(first.select("node", "first.rank", "first.k", "n"), "parity-nodes")
    texts = one_text_per_node(docs, scanned, nodes, scratch)
    # The largest intermediate: dealt once by bucket, for the sums and for the join back.
    pieces = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    offered = offers(texts, size, percent).repartition(pieces, "key")
    buckets = offered.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi")
    members = scratch.stored(offered.join(buckets.hint("merge"), "key"), "parity-members")
    stars = members.select("node", F.explode(F.array("lo", "hi")).alias("centre")).filter("node <> centre")
    pairs = stars.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    sizes = nodes.select("node", "n")
    pairs = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    pairs = scratch.stored(pairs.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b"), "parity-pairs")
    chosen = scratch.stored(nodes.join(members.select("node").distinct(), "node").select("rank", "k", "node"), "parity-chosen")
    packed = scratch.stored(packed_texts(texts, chosen), "parity-texts")
    links = scratch.stored(linked_pairs(pairs, packed, size, percent), "parity-links")
    roots = stored(components(links), "parity-roots")
    rest = scratch.stored(remaining_pairs(members.select("key", "node"), roots, packed, size, percent, scratch), "parity-rest")
    rest = rest.join(pairs, ["a", "b"], "left_anti")
    if rest.head(1):
        more = scratch.stored(linked_pairs(rest, packed, size, percent), "parity-links")
        roots = stored(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)), "parity-roots")
    return scanned.select("rank", "k", "n", "node"), roots


def component_ids(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) per document; class_id is the smallest doc_id with an equal set."""
    scratch = Scratch()
    scanned, roots = joined(docs, size, percent, scratch)
    classes = scanned.filter("node IS NOT NULL").groupBy("node").agg(F.min("rank").alias("class_rank"))
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("class_rank").alias("least"))
    named = rooted.join(least, "root").select("node", "class_rank", "least")

    def real(column: str):
        return F.when(F.col(column) != NO_ID, F.col(column))

    full = scanned.join(named, "node", "left").withColumns({c: F.coalesce(c, "rank") for c in ("class_rank", "least")})
    found = full.select(
        real("rank").alias("doc_id"), F.col("n").alias("n_shingles"), real("class_rank").alias("class_id"), real("least").alias("component_id")
    )
    found = stored(found, "parity-found")
    scratch.clear()
    return found


def keep_one(docs: DataFrame, keep: list[str], size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``keep`` of one document of each component, the one with the smallest doc_id, and of all documents that link with none."""
    scratch = Scratch()
    scanned, roots = joined(docs, size, percent, scratch)
    placed = scanned.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    grouped = placed.filter("node IS NOT NULL")
    first = grouped.groupBy("root").agg(F.min("rank").alias("rank"))
    winners = grouped.join(first, ["root", "rank"]).groupBy("root", "rank").agg(F.min("k").alias("k"))
    winners = stored(winners.select("rank", "k"), "parity-winners")
    rows = docs.select(*keep, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("own_rank"), F.xxhash64("text").alias("own_k"))
    wordless = stored(placed.filter("node IS NULL").select("rank", "k").distinct(), "parity-wordless")
    scratch.clear()
    on = F.expr("own_rank = rank AND own_k = k")
    kept = rows.join(winners, on, "left_semi").dropDuplicates(["own_rank", "own_k"])
    return kept.unionByName(rows.join(wordless, on, "left_semi")).select(*keep)
