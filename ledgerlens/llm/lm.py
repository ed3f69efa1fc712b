"""Language-model scores from sharded Elias-Fano n-gram tries.

The model is a bigram model with absolute discounting over an add-one unigram:

    p(w | v) = max(c(v w) - D, 0) / c(v) + b(v) * p1(w),   p1(w) = (c(w) + 1) / (N + V + 1)

where every pair seen has the first term (``MIN_COUNT`` is 1) and b(v) gives
the rest of the mass, so the probabilities of all words (one of them
standing for all unseen) sum to one. In logarithms a token costs log p1(w), plus
log b(v) for its context, plus, if the pair is in the model, a gain that makes
up the difference. So a text's score is a sum over its tokens of

    log p1(w) + log b(w as context of the next token) + gain(v, w)

and everything a token needs hangs below its word in a trie. Words are dealt to
shards by hash; a word too frequent for one shard is dealt by (word, context),
and its own entry is put into every shard. Texts are cut into tokens in bounded
chunks, tokens are sent to their shards as packed arrays, each shard's trie is
mapped into memory and searched, and the sums come back per chunk. The number of
shards follows the number of tokens, so neither tries nor groups grow.

Counts of words are exact; words are compared by 64-bit hashes, contexts by 40
bits. Values are quantised, as the method has it; the base score is not.

Defined cases: a null or empty text is its end token alone; a null doc_id is not
held out; rows with equal doc_id are scored one by one; without training texts
every token is unknown and the score equals the base score.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, crc32_remainder, free_memory, map_batches, map_frames, ship, small_batches, stored
from ledgerlens.llm.elias_fano import Trie

SHARD_TOKENS = 2_000_000
CHUNK_BYTES = 4_000_000
MIN_COUNT = 1
DISCOUNT = 0.75
# Neither can be a word, as both hold a space.
END = xxhash.xxh3_64_intdigest(b"end of text")
BEGIN = xxhash.xxh3_64_intdigest(b"begin of text")
DROPPED_BITS = np.uint64(64 - Trie.CONTEXT_BITS)


def signed(words: np.ndarray) -> np.ndarray:
    return words.view(np.int64)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hash of every token, its text); each text ends with END."""
    # A copy of its own: string functions misread a slice that is cast.
    own = texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string()).fill_null("")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(own))
    # Cutting at white space leaves empty words at a text's ends.
    numbered = pc.dictionary_encode(lists.values)
    listed = numbered.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, listed), dtype=np.uint64, count=len(listed))
    real = np.fromiter(map(len, listed), dtype=np.int64, count=len(listed)) > 0
    numbers = numbered.indices.to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real[numbers])])
    counts = np.diff(before[lists.offsets.to_numpy()])
    ends = np.cumsum(counts + 1) - 1
    out = np.full(int(counts.sum()) + len(texts), END, dtype=np.uint64)
    inside = np.ones(len(out), dtype=bool)
    inside[ends] = False
    out[inside] = hashes[numbers[real[numbers]]]
    return out, np.repeat(np.arange(len(texts)), counts + 1)


def contexts_of(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The shortened hash of the token before each token, BEGIN at a text's start."""
    before = np.concatenate([[np.uint64(BEGIN)], words[:-1]]) if len(words) else words
    before[np.flatnonzero(np.diff(owner, prepend=-1))] = BEGIN
    return before >> DROPPED_BITS


def shard_of(words: np.ndarray, contexts: np.ndarray, shards: int, frequent: np.ndarray) -> np.ndarray:
    """The shard of each (word, context); only words in ``frequent`` (sorted) are dealt by context too."""
    at = np.minimum(np.searchsorted(frequent, words), max(len(frequent) - 1, 0))
    often = frequent[at] == words if len(frequent) else np.zeros(len(words), dtype=bool)
    key = np.where(often, words ^ contexts * np.uint64(0x9E3779B97F4A7C15), words)
    key = (key ^ key >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((key >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return small_batches(batches, "t", CHUNK_BYTES)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, byte planes apart so that small numbers take little room."""
    parts = []
    for array in arrays:
        kind = array.dtype.str.encode()
        planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.dtype.itemsize).T
        parts += [struct.pack("<B", len(kind)), kind, struct.pack("<Q", len(array)), np.ascontiguousarray(planes).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        size = raw[at]
        kind = np.dtype(raw[at + 1 : at + 1 + size].decode())
        n = struct.unpack_from("<Q", raw, at + 1 + size)[0]
        at += size + 9
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, number of each)."""
    distinct, numbers = np.unique(values, return_inverse=True)
    return distinct, numbers.astype(np.uint32)


def short(contexts: np.ndarray) -> np.ndarray:
    """40-bit contexts as five byte columns in a row."""
    return np.ascontiguousarray(contexts.view(np.uint8).reshape(-1, 8)[:, :5]).reshape(-1)


def long_again(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = data.reshape(-1, 5)
    return out.view(np.uint64).reshape(-1)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over the texts (t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches):
            words, n = np.unique(tokens_of(batch.column("t"))[0], return_counts=True)
            for start in range(0, len(words), 200_000):
                part = slice(start, start + 200_000)
                yield pa.RecordBatch.from_pydict({"word": signed(words[part]), "c": n[part].astype(np.int64)})
        free_memory()

    return map_batches(texts, run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def pair_counts(texts: DataFrame, shards: int, frequent: np.ndarray) -> DataFrame:
    """(shard, data): the pairs of each shard seen MIN_COUNT times or more, packed (words, runs, contexts, counts)."""
    listed = texts.sparkSession.sparkContext.broadcast(frequent)

    def packed_pairs(words: np.ndarray, contexts: np.ndarray, n: np.ndarray) -> bytes:
        distinct, runs = np.unique(words, return_counts=True)
        return pack(distinct, runs.astype(np.uint32), short(contexts), n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches):
            words, owner = tokens_of(batch.column("t"))
            contexts = contexts_of(words, owner)
            shard = shard_of(words, contexts, shards, listed.value)
            order = np.lexsort((contexts, words, shard))
            words, contexts, shard = words[order], contexts[order], shard[order]
            new = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (contexts[1:] != contexts[:-1])]))
            n = np.diff(np.append(new, len(words))).astype(np.uint32)
            words, contexts, shard = words[new], contexts[new], shard[new]
            cuts = np.searchsorted(shard, np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[s], cuts[s + 1])
                yield pa.RecordBatch.from_pydict({"shard": [int(s)], "data": [packed_pairs(words[part], contexts[part], n[part])]})
        free_memory()

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        words, contexts, n = (np.concatenate(parts) for parts in zip(*map(pairs_of, frame["data"])))
        order = np.lexsort((contexts, words))
        words, contexts, n = words[order], contexts[order], n[order].astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (contexts[1:] != contexts[:-1])]))
        total = np.add.reduceat(n, new)
        kept = total >= MIN_COUNT
        data = packed_pairs(words[new][kept], contexts[new][kept], total[kept].astype(np.uint32))
        del words, contexts, n, order, new, total, kept
        free_memory()
        return pd.DataFrame({"shard": [frame["shard"].iloc[0]], "data": [data]})

    packed = map_batches(texts, count, "shard long, data binary")
    return packed.groupBy("shard").applyInPandas(merge, "shard long, data binary")


def pairs_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, contexts, counts), sorted by word, then context."""
    distinct, runs, contexts, n = unpack(data)
    return np.repeat(distinct, runs), long_again(contexts), n


def context_sums(pairs: DataFrame) -> DataFrame:
    """(shard, context, kept, kinds): counts and number of the pairs of each context within a shard."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, data in zip(frame["shard"], frame["data"]):
                _, contexts, n = pairs_of(data)
                distinct, number, kinds = np.unique(contexts, return_inverse=True, return_counts=True)
                kept = np.bincount(number, weights=n, minlength=len(distinct)).astype(np.int64)
                for start in range(0, len(distinct), 200_000):
                    part = slice(start, start + 200_000)
                    yield pd.DataFrame({"shard": shard, "context": distinct[part].astype(np.int64), "kept": kept[part], "kinds": kinds[part]})
        free_memory()

    return map_frames(pairs, run, "shard int, context long, kept long, kinds int")


class Model:
    """A trained model: tries (shard, data) and the figures of the whole corpus."""

    def __init__(self, tries: DataFrame, tokens: int, vocabulary: int, shards: int, frequent: np.ndarray, begin: float):
        self.tries, self.tokens, self.vocabulary = tries, tokens, vocabulary
        self.shards, self.frequent, self.begin = shards, frequent, begin


def train(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> Model:
    """Count words and pairs of all texts of ``docs`` and build the tries.

    Pairs stay packed in their shard. What leaves it are the sums of each of its
    contexts; they come back with the totals over all shards.
    """
    scratch = Scratch()
    model = trained(docs, shard_tokens, scratch)
    # Only once the frames of training are gone can the driver's collection remove their shuffle files.
    scratch.clear()
    return model


def trained(docs: DataFrame, shard_tokens: int, scratch: Scratch) -> Model:
    spark = docs.sparkSession
    texts = docs.select(F.col("text").alias("t"))
    words = scratch.stored(word_counts(texts), "lm-words")
    tokens, vocabulary = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    documents = texts.count()
    shards = max(1, -(-tokens // shard_tokens))
    # At most 2 * shards words can be this frequent.
    frequent = np.sort(np.array([r["word"] for r in words.filter(F.col("c") > shard_tokens // 2).select("word").collect()], dtype=np.int64).view(np.uint64))
    pairs = scratch.stored(pair_counts(texts, shards, frequent), "lm-pairs")

    def shortened(column: str):
        return F.shiftrightunsigned(column, int(DROPPED_BITS))

    begin_row = spark.createDataFrame([(int(np.uint64(BEGIN >> int(DROPPED_BITS))), documents)], "context long, total long")
    totals = words.groupBy(shortened("word").alias("context")).agg(F.sum("c").alias("total")).unionByName(begin_row)
    sums = scratch.stored(context_sums(pairs), "lm-contexts")
    seen = sums.groupBy("context").agg(F.sum("kept").alias("kept"), F.sum("kinds").alias("kinds"))
    rest = 1.0 - (F.col("kept") - DISCOUNT * F.col("kinds")) / F.col("total")
    backoff = scratch.stored(seen.join(totals, "context").select("context", "total", F.greatest(rest, F.lit(1e-9)).alias("b")), "lm-backoff")
    begin = backoff.filter(F.col("context") == int(BEGIN >> int(DROPPED_BITS))).select(F.log10("b")).first()
    floor = float(tokens + vocabulary + 1)
    end = F.col("word") == int(np.uint64(END).astype(np.int64))
    value = F.log10((F.col("c") + 1) / floor) + F.when(end, 0.0).otherwise(F.coalesce(F.log10("b"), F.lit(0.0)))
    entries = words.withColumn("context", shortened("word")).join(backoff.select("context", "b"), "context", "left")

    listed = spark.sparkContext.broadcast(frequent)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            hashes = frame["key"].to_numpy().view(np.uint64)
            often = np.isin(hashes, listed.value)
            frame["shard"] = shard_of(hashes, np.zeros(len(hashes), dtype=np.uint64), shards, listed.value)
            yield frame[~often]
            for s in range(shards if often.any() else 0):
                yield frame[often].assign(shard=s)

    level1 = map_frames(entries.select(F.col("word").alias("key"), "c", value.alias("value")), place, "key long, c long, value double, shard int")
    level1 = level1.withColumn("level", F.lit(1))
    contexts = sums.select("shard", "context").join(backoff, "context")
    contexts = contexts.select(F.col("context").alias("key"), F.col("total").alias("c"), F.col("b").alias("value"), "shard", F.lit(2).alias("level"))

    def build(packed: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        top, before = (known[known["level"] == level] for level in (1, 2))
        distinct, c, gain = top["key"].to_numpy().view(np.uint64), top["c"].to_numpy(), top["value"].to_numpy()
        order = np.argsort(distinct)
        distinct, c, gain = distinct[order], c[order].astype(np.int64), gain[order]
        words, contexts, n = pairs_of(packed["data"].iloc[0]) if len(packed) else (distinct[:0], distinct[:0], c[:0])
        keys = before["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        at = order[np.searchsorted(keys, contexts, sorter=order)] if len(contexts) else np.zeros(0, dtype=np.int64)
        total, b = before["c"].to_numpy()[at], before["value"].to_numpy()[at]
        del top, before, keys, order, at
        parents = np.searchsorted(distinct, words)
        p1 = (c[parents] + 1) / floor
        value = np.log10(((n - DISCOUNT) / total + b * p1) / (b * p1))
        del total, b, p1, n, words
        data = Trie.build(distinct, c, gain, parents, contexts.astype(np.int64), value)
        del distinct, c, gain, parents, contexts, value
        free_memory()
        return pd.DataFrame({"shard": [int(known["shard"].iloc[0])], "data": [data]})

    known = level1.unionByName(contexts)
    tries = pairs.groupBy("shard").cogroup(known.withColumn("shard", F.col("shard").cast("long")).groupBy("shard")).applyInPandas(build, "shard long, data binary")
    tries = stored(tries, "lm-tries")
    return Model(tries, int(tokens), int(vocabulary), shards, frequent, float(begin[0]) if begin else 0.0)


def score(docs: DataFrame, model: Model, keep: str = "held_out") -> DataFrame:
    """doc_id, ``keep`` (a boolean column), n_tokens, n_known, base_score and score of every document."""
    spark = docs.sparkSession
    ship(spark)
    listed = spark.sparkContext.broadcast(model.frequent)
    shards, floor, begin = model.shards, float(model.tokens + model.vocabulary + 1), model.begin
    source = docs.select(F.col("doc_id").cast("long").alias("d"), F.col(keep).alias("h"), F.col("text").alias("t"))

    def message(shard: int, chunk: int, kind: int, data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([chunk], pa.int64()), pa.array([kind], pa.int32()), pa.array([data], pa.binary())], ["shard", "chunk", "kind", "data"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        for number, batch in enumerate(chunks_of(batches)):
            chunk = (partition << 24) + number
            words, owner = tokens_of(batch.column("t"))
            ids = batch.column("d")
            head = pack(
                ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                batch.column("h").to_numpy(zero_copy_only=False).astype(np.uint8), np.bincount(owner, minlength=batch.num_rows).astype(np.int64),
            )
            yield message(chunk % shards, chunk, 0, head)
            contexts = contexts_of(words, owner)
            shard = shard_of(words, contexts, shards, listed.value)
            order = np.argsort(shard, kind="stable")
            words, contexts, owner = words[order], contexts[order], owner[order]
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[s], cuts[s + 1])
                kinds, which = coded(words[part])
                befores, before = coded(contexts[part])
                gaps = np.diff(owner[part], prepend=0).astype(np.uint32)
                yield message(int(s), chunk, 1, pack(kinds, which, short(befores), before, gaps))
            del words, contexts, owner, shard, order
            free_memory()

    def answer(asked: pd.DataFrame, tries: pd.DataFrame) -> pd.DataFrame:
        trie = Trie(tries["data"].iloc[0]) if len(tries) else None
        out = []
        for chunk, kind, data in zip(asked["chunk"], asked["kind"], asked["data"]):
            if kind == 0:
                out.append((chunk, 0, data))
                continue
            kinds, which, befores, before, gaps = unpack(data)
            owner = np.cumsum(gaps.astype(np.int64))
            if trie is None:
                number, c, value = np.full(len(kinds), -1), np.zeros(len(kinds), dtype=np.int64), np.zeros(len(kinds))
            else:
                number, c, value = trie.look_up(kinds)
            base = np.log10((c + 1) / floor)
            value = np.where(number >= 0, value, base)
            # Equal pairs are searched once.
            pairs, pair = np.unique(which.astype(np.uint64) << np.uint64(32) | before, return_inverse=True)
            gain = np.zeros(len(pairs))
            if trie is not None:
                gain = trie.gains(number[(pairs >> np.uint64(32)).astype(np.int64)], long_again(befores)[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)])
            first = int(owner[0])
            at = owner - first
            sums = [np.bincount(at, weights=base[which]), np.bincount(at, weights=value[which] + gain[pair])]
            known = np.bincount(at, weights=(c > 0)[which]).astype(np.uint32)
            out.append((chunk, 1, pack(np.array([first]), *sums, known)))
        free_memory()
        return pd.DataFrame(out, columns=["chunk", "kind", "data"])

    def add_up(frame: pd.DataFrame) -> pd.DataFrame:
        ids, missing, flags, n = unpack(frame.loc[frame["kind"] == 0, "data"].iloc[0])
        base, total, known = np.zeros(len(ids)), np.full(len(ids), begin), np.zeros(len(ids), dtype=np.int64)
        for data in frame.loc[frame["kind"] == 1, "data"]:
            first, bases, scores, hits = unpack(data)
            part = slice(int(first[0]), int(first[0]) + len(bases))
            base[part] += bases
            total[part] += scores
            known[part] += hits
        return pd.DataFrame(
            {"doc_id": pd.Series(ids, dtype="Int64").mask(missing.astype(bool)), keep: flags.astype(bool), "n_tokens": n, "n_known": known, "base_score": base, "score": total}
        )

    asked = map_batches(source, ask, "shard long, chunk long, kind int, data binary")
    answered = asked.groupBy("shard").cogroup(model.tries.groupBy("shard")).applyInPandas(answer, "chunk long, kind int, data binary")
    result = f"doc_id long, {keep} boolean, n_tokens long, n_known long, base_score double, score double"
    return answered.groupBy("chunk").applyInPandas(add_up, result)


def fit_and_score(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """Learn from the documents outside the held-out fold and score all; adds train_tokens."""
    held_out = F.coalesce(crc32_remainder("doc_id", folds) == held, F.lit(False))
    marked = docs.select("doc_id", "text", held_out.alias("held_out"))
    model = train(marked.filter("NOT held_out"))
    return score(marked, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
