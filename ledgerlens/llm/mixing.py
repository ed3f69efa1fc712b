"""Mixing sources to target weights, with DataFrame operations only.

Each source is a stream of words: its documents in a pseudorandom order, cut
into blocks of ``block_words`` words regardless of document borders. A source
is given as many slots of the mix as its target needs. The mix consists of
shards of ``shard_slots`` slots. Each shard draws its counts by source: a
multinomial draw, given that the sources' totals are exact, as drawn totals
would miss the targets and could pass the cap. The shards take a source's slots
in turn. Slot ``j`` of a source with B blocks takes block
``permutation(j mod B)``, so whole passes over a source take every block once
and the last, partial pass takes a pseudorandom selection.

Documents and the mix meet in a join by (source, block). Nothing is collected;
offsets come from two-level sums, so that a source that holds most of the table
is spread over many tasks.

Defined cases: a null text has no words; a null source is a source of its own,
ordered last; a document without words is never taken; rows with the same
doc_id are separate documents; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import DOCUMENT_COLUMNS, WORD_PATTERN, stored, word_count

BLOCK_WORDS = 64
SHARD_SLOTS = 1024
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
BUCKET_BITS = 12
ROUNDS = 16
CHUNK = 4096


def source_key(column: str = "source") -> Column:
    """A join key that keeps null apart from every string and sorts it last."""
    return F.when(F.col(column).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(column)))


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(skey, source_size, target) per source of ``sized`` (skey, size).

    Resharing the excess of capped sources until none is above its cap ends
    where target = min(cap, level * weight). Sources sorted by cap / weight are
    capped up to some place; the level is the rest of the words over the rest
    of the weights there. The windows run over one row per source.
    """
    per_source = sized.groupBy("skey").agg(F.sum("size").alias("source_size"))
    order = F.row_number().over(Window.orderBy("skey")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (order % len(weights) + 1).cast("int"))
    listed = per_source.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * float(max_repeat))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "skey").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = listed.withColumn("level", rest / open_weight)
    reached = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.coalesce(F.min(F.when(reached, F.struct(F.col("cap") / F.col("weight"), "skey", "level"))).over(everything)["level"], F.lit(0.0))
    return levels.select("skey", "source_size", F.least(F.col("cap"), level * F.col("weight")).alias("target"))


def with_offsets(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Add skey, size and the document's word offset within its source.

    Documents of a source are ordered by a hash of id and text. Sums over
    2**BUCKET_BITS ranges of that hash come first, then sums within a range.
    """
    base = docs.select(
        *keep,
        source_key().alias("skey"),
        word_count("text").alias("size"),
        F.xxhash64("doc_id", "text").alias("h"),
    ).withColumn("bucket", F.shiftrightunsigned("h", 64 - BUCKET_BITS))
    totals = base.groupBy("skey", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("skey", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("skey", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inner = base.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return inner.join(starts, ["skey", "bucket"]).withColumn("offset", F.col("start") + F.col("inner")).drop("bucket", "start", "inner", "h")


def permuted(index: Column, size: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of [0, size) applied to ``index``.

    Swap-or-not shuffle: each round pairs x with (k - x) mod size and a hash
    bit of the pair decides whether the two change places.
    """

    def one(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(r, *key), size) - x, size)
        return F.when(F.xxhash64(r, F.greatest(x, partner), *key).bitwiseAND(1) == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, one)


def source_quotas(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(skey, blocks, slots, first, total): the slots of each source, and where they start among all ``total`` slots.

    A source takes floor(target / size) whole passes and the nearest number of
    blocks to the rest. The windows run over one row per source.
    """
    blocks = F.ceil(F.col("source_size") / block_words)
    passes = F.floor(F.col("target") / F.col("source_size") + 1e-12)
    part = F.round((F.col("target") - passes * F.col("source_size")) / block_words).cast("long")
    quota = targets.filter("source_size > 0").select(
        "skey", blocks.alias("blocks"), (passes * blocks + F.least(F.greatest(part, F.lit(0)), blocks)).alias("slots")
    )
    before = Window.orderBy("skey").rowsBetween(Window.unboundedPreceding, -1)
    return quota.withColumns(
        {"first": F.coalesce(F.sum("slots").over(before), F.lit(0)), "total": F.sum("slots").over(Window.partitionBy())}
    ).filter("slots > 0")


def shard_counts(quotas: DataFrame, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(skey, shard, slots): the draw of how many slots each output shard takes from each source.

    A permutation of all slots deals them to shards of ``shard_slots`` slots (the
    last may be smaller). A shard's counts by source are thus a multinomial
    draw, given that the sources' totals are exact. Slots are dealt in chunks, so
    that one large source does not expand in one task.
    """
    chunks = quotas.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK))))
    # A stated number: by their size alone, Spark would put all chunks into one task.
    chunks = chunks.repartition(int(quotas.sparkSession.conf.get("spark.sql.shuffle.partitions")), "skey", "chunk")
    start = F.col("chunk") * CHUNK
    end = F.least(start + CHUNK, F.col("slots"))
    drawn = chunks.withColumn("ticket", F.explode(F.sequence(F.col("first") + start, F.col("first") + end - 1)))
    place = permuted(F.col("ticket"), F.col("total"), F.lit(seed), F.lit("shards"))
    return drawn.groupBy("skey", F.floor(place / shard_slots).alias("shard")).agg(F.count("*").alias("slots"))


def mix_slots(targets: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, skey, slot, epoch, block): every block that the mix takes.

    The shards of a source take its slots in turn, as many as the draw gives
    them. Where a shard starts comes from sums over ranges of CHUNK shards and
    sums within a range.
    """
    quotas = source_quotas(targets, block_words)
    counts = stored(shard_counts(quotas, seed, shard_slots), "mix-shards").withColumn("range", F.floor(F.col("shard") / CHUNK))
    before = Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("skey", "range").agg(F.sum("slots").alias("drawn"))
    starts = totals.select("skey", "range", F.coalesce(F.sum("drawn").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("skey", "range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("inner", F.coalesce(F.sum("slots").over(within), F.lit(0))).join(starts, ["skey", "range"])
    placed = placed.join(quotas.select("skey", "blocks"), "skey")
    # Few rows stand for many slots: a stated number of tasks expands them.
    placed = placed.repartition(int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "skey", "shard")
    begin = F.col("start") + F.col("inner")
    slots = placed.withColumn("slot", F.explode(F.sequence(begin, begin + F.col("slots") - 1)))
    return slots.select(
        "shard",
        "skey",
        "slot",
        F.floor(F.col("slot") / F.col("blocks")).alias("epoch"),
        permuted(F.pmod(F.col("slot"), F.col("blocks")), F.col("blocks"), F.lit(seed), F.col("skey")).alias("block"),
    )


def document_blocks(sized: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(skey, offset, block, start, words): the part of each document in each of its blocks."""
    first, last = F.floor(F.col("offset") / block_words), F.floor((F.col("offset") + F.col("size") - 1) / block_words)
    cut = sized.filter("size > 0").select("skey", "offset", "size", F.explode(F.sequence(first, last)).alias("block"))
    start = F.greatest(F.col("block") * block_words - F.col("offset"), F.lit(0))
    end = F.least((F.col("block") + 1) * block_words - F.col("offset"), F.col("size"))
    return cut.select("skey", "offset", "block", start.alias("start"), (end - start).alias("words"))


def mix_pieces(sized: DataFrame, targets: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: (shard, skey, slot, epoch, block, offset, start, words), a row per document part of each slot."""
    # Slots come from a few small rows but are as many as the blocks: never broadcast them.
    return mix_slots(targets, seed, block_words).hint("merge").join(document_blocks(sized, block_words), ["skey", "block"])


def mix_report(docs: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and of its slots n_slots, first_shard, last_shard.

    A document that the mix does not take has 0 slots and null shards.
    """
    sized = stored(with_offsets(docs, ["doc_id", "source"]), "mix-sizes")
    targets = stored(source_targets(sized), "mix-targets")
    taken = mix_pieces(sized, targets, seed, block_words).groupBy("skey", "offset").agg(
        F.sum("words").alias("taken"),
        F.count("*").alias("n_slots"),
        F.min("shard").alias("first_shard"),
        F.max("shard").alias("last_shard"),
    )
    taken = taken.withColumnsRenamed({"skey": "taken_key", "offset": "taken_at"})
    at = F.expr("skey = taken_key AND offset = taken_at AND size > 0")
    none = F.lit(0).cast("long")
    return sized.join(targets, "skey").join(taken.hint("merge"), at, "left").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", none).alias("taken"),
        F.coalesce("n_slots", none).alias("n_slots"),
        "first_shard",
        "last_shard",
    )


def mix_documents(docs: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: one row per document and pass, with the columns of ``documents``.

    A pass that takes a whole document returns its text unchanged, a partial
    pass the taken words joined by spaces. ``n_chars`` is the new length.
    """
    sized = stored(with_offsets(docs, DOCUMENT_COLUMNS), "mix-documents")
    targets = stored(source_targets(sized), "mix-targets")
    pieces = mix_pieces(sized.select("skey", "offset", "size"), targets, seed, block_words)
    passes = pieces.groupBy("skey", "offset", "epoch").agg(
        F.sum("words").alias("taken"), F.sort_array(F.collect_list(F.struct("start", "words"))).alias("parts")
    )
    words = F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0))
    cut = F.flatten(F.transform("parts", lambda p: F.slice(words, (p["start"] + 1).cast("int"), p["words"].cast("int"))))
    text = F.when(F.col("taken") == F.col("size"), F.col("text")).otherwise(F.array_join(cut, " "))
    mixed = sized.filter("size > 0").join(passes, ["skey", "offset"]).withColumn("text", text)
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)
