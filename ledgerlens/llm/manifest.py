"""Merkle manifest of a dataset, by bitmap ranks.

Every row is a leaf, and every group of rows (documents of a language) a tree of
its leaves in order of their ids; the groups' roots make one tree more. Nothing
is sorted to find a leaf's place:

* A group's ids are a bitmap, compressed by leaving out its empty 64-bit words.
  Partial bitmaps are merged by ``bit_or``, with a count of rows per word.
* A popcount directory holds the number of rows before each word: running sums
  within ranges of words, and of the ranges' totals, so that no window covers
  more than ``2 ** RANGE_BITS`` entries however large a group is.
* A leaf's place is its word's entry plus the popcount of the word's lower bits.
  Only words with rows of equal id (or rows without id, which come first) are
  numbered by order of (id, leaf).
* Places are cut into slot arrays of ``2 ** SLOT_BITS`` leaves, keyed by group
  and number. An array is reduced by ``SLOT_BITS`` levels at once; the results
  are the slots of the next round, until a group is one array. Proofs are
  handed down the same way, an array's own siblings before those of its result.

While several nodes remain, every two consecutive ones become the SHA-256 of
their hex digests joined; a last single one becomes that of its own.

Defined cases: null fields count as ``-``; a null group is a group of its own
and comes first; equal rows are leaves of their own; an empty table has no rows.
All rows with one id and group are numbered in one window (sorted, spilled).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, crc32_remainder, map_frames, ship

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
RANGE_BITS = 20
SLOT_BITS = 12
# Before the words of all ids, which lie in -2**57 .. 2**57 - 1.
NO_ID_WORD = -(1 << 58)
ALONE, LEFT, RIGHT = b"N", b"L", b"R"  # where a step's sibling stands


def coded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(coded, values)).cast("binary"), 256)


def node(*digests: bytes) -> bytes:
    return hashlib.sha256(b"".join(digests)).hexdigest().encode()


def levels_of(digests: list[bytes], depth: int | None = None) -> list[list[bytes]]:
    """The nodes of each level, up to one node or, if given, by exactly ``depth`` levels."""
    levels = [digests]
    while len(levels) <= depth if depth is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([node(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def steps_of(levels: list[list[bytes]], place: int) -> bytes:
    """The siblings of a node of the lowest level, each with its side; the top level has none."""
    out = []
    for below in levels[:-1]:
        other = place ^ 1
        out.append(ALONE if other >= len(below) else (LEFT if other < place else RIGHT) + below[other])
        place >>= 1
    return b"".join(out)


def siblings(path: bytes) -> list[tuple[bytes, bytes]]:
    """(side, digest) of each step of a proof; no digest where a node stands alone."""
    out, at = [], 0
    while at < len(path):
        size = 1 if path[at : at + 1] == ALONE else 65
        out.append((path[at : at + 1], path[at + 1 : at + size]))
        at += size
    return out


def fold(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    for side, other in siblings(path):
        digest = node(other, digest) if side == LEFT else node(digest, other)
    return digest


def placed(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows (g, d, leaf, ...) with their place ``pos`` within g; rows of each g as ``total``)."""
    word = F.coalesce(F.shiftright("d", 6), F.lit(NO_ID_WORD)).alias("w")
    low = F.coalesce(F.col("d").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")
    keyed = rows.select("*", word, low.alias("low"))
    words = keyed.groupBy("g", "w").agg(F.bit_or(F.expr("shiftleft(1L, low)")).alias("bits"), F.count(F.lit(1)).alias("n"))
    words = scratch.stored(words, "manifest-words")
    # Running sums of words within ranges, of ranges within wider ones, of these within the group.
    levels, counts = [], words.select("g", F.col("w").alias("k0"), "n")
    for level in range(3):
        key, wide = f"k{level}", f"k{level + 1}"
        above = F.shiftright(key, RANGE_BITS) if level < 2 else F.lit(0).cast("long")
        counts = counts.withColumn(wide, above)
        before = F.coalesce(F.sum("n").over(Window.partitionBy("g", wide).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        levels.append(counts.select("g", key, wide, before.alias(f"before{level}")))
        counts = counts.groupBy("g", wide).agg(F.sum("n").alias("n"))
    totals = counts.select("g", F.col("n").alias("total"))
    ranges = levels[1].join(levels[2], ["g", "k2"]).select("g", "k1", (F.col("before1") + F.col("before2")).alias("start"))
    starts = levels[0].join(ranges, ["g", "k1"]).select("g", F.col("k0").alias("w"), (F.col("before0") + F.col("start")).alias("start"))
    directory = scratch.stored(words.join(starts, ["g", "w"]), "manifest-directory")
    single = F.bit_count("bits") == F.col("n")
    columns = [*rows.columns, "pos"]
    lower = F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, low)"))
    ranked = keyed.join(directory.filter(single), ["g", "w"]).withColumn("pos", F.col("start") + F.bit_count(lower)).select(*columns)
    order = Window.partitionBy("g", "w").orderBy(F.col("d").asc_nulls_first(), "leaf")
    crowded = keyed.join(directory.filter(~single), ["g", "w"]).withColumn("pos", F.col("start") + F.row_number().over(order) - 1).select(*columns)
    return ranked.unionByName(crowded), scratch.stored(totals, "manifest-totals")


ARRAY = "g string, slot long, total long, digests binary, ids binary, missing binary, claims binary, up string"


def slot_arrays(nodes: DataFrame, bits: int) -> DataFrame:
    """Nodes (g, pos, total, leaf, id, missing, claimed) as arrays with the digest ``up`` that each is reduced to."""
    width = 1 << bits

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos")
        digests = [d.encode() for d in frame["leaf"]]
        total = int(frame["total"].iloc[0])
        claims = [c.encode() if isinstance(c, str) else b"-" * 64 for c in frame["claimed"]]
        row = {
            "g": frame["g"].iloc[0], "slot": int(frame["pos"].iloc[0]) >> bits, "total": total,
            "digests": b"".join(digests), "ids": frame["id"].to_numpy(np.int64).tobytes(), "missing": frame["missing"].to_numpy(np.uint8).tobytes(),
            "claims": b"".join(claims), "up": levels_of(digests, None if total <= width else bits)[-1][0].decode(),
        }
        return pd.DataFrame([row])

    ship(nodes.sparkSession)
    return nodes.withColumn("slot", F.shiftright("pos", bits)).groupBy("g", "slot").applyInPandas(pack, ARRAY)


def expanded(arrays: DataFrame, paths: DataFrame, bits: int) -> DataFrame:
    """(g, pos, id, missing, leaf, claimed, path, subroot) of every slot; ``paths`` (g, slot, path, subroot) are the arrays' own."""
    width = 1 << bits

    def unpack(array: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        row, upper = array.iloc[0], above.iloc[0]
        digests = [row["digests"][i : i + 64] for i in range(0, len(row["digests"]), 64)]
        levels = levels_of(digests, None if row["total"] <= width else bits)
        claims = [row["claims"][i : i + 64].decode() for i in range(0, len(row["claims"]), 64)]
        return pd.DataFrame(
            {
                "g": row["g"], "pos": np.arange(len(digests), dtype=np.int64) + (int(row["slot"]) << bits),
                "id": np.frombuffer(row["ids"], np.int64), "missing": np.frombuffer(row["missing"], np.uint8).astype(bool),
                "leaf": [d.decode() for d in digests], "claimed": [None if c[0] == "-" else c for c in claims],
                "path": [steps_of(levels, i) + upper["path"] for i in range(len(digests))], "subroot": upper["subroot"],
            }
        )

    schema = "g string, pos long, id long, missing boolean, leaf string, claimed string, path binary, subroot string"
    return arrays.groupBy("g", "slot").cogroup(paths.groupBy("g", "slot")).applyInPandas(unpack, schema)


def inner(digest: str) -> list[Column]:
    """The columns of a node that is no leaf."""
    return [F.col(digest).alias("leaf"), F.lit(0).cast("long").alias("id"), F.lit(False).alias("missing"), F.lit(None).cast("string").alias("claimed")]


def rounds_of(nodes: DataFrame, most: int, scratch: Scratch, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """(slot arrays of each round, (g, subroot)); ``most`` is the number of nodes of the largest group."""
    arrays, found = [], []
    while True:
        packed = scratch.stored(slot_arrays(nodes, bits), "manifest-slots")
        arrays.append(packed)
        found.append(packed.filter(F.col("total") <= 1 << bits).select("g", F.col("up").alias("subroot")))
        if most <= 1 << bits:
            break
        total = F.shiftright(F.col("total") + ((1 << bits) - 1), bits)
        nodes = packed.filter(F.col("total") > 1 << bits).select("g", F.col("slot").alias("pos"), total.alias("total"), *inner("up"))
        most = -(-most // (1 << bits))
    roots = found[0]
    for more in found[1:]:
        roots = roots.unionByName(more)
    return arrays, roots


def handed_down(arrays: list[DataFrame], tops: DataFrame, scratch: Scratch, bits: int) -> DataFrame:
    """The proofs of the lowest round's slots; ``tops`` (g, path, subroot) are the proofs of the groups' roots."""
    paths = None
    for packed in reversed(arrays):
        own = packed.filter(F.col("total") <= 1 << bits).select("g", "slot").join(tops, "g").select("g", "slot", "path", "subroot")
        paths = own if paths is None else own.unionByName(paths)
        rows = expanded(packed, scratch.stored(paths, "manifest-paths"), bits)
        paths = rows.select("g", F.col("pos").alias("slot"), "path", "subroot")
    return rows


def proofs(
    docs: DataFrame, columns: tuple[str, ...] = LEAF_COLUMNS, group: str = "lang", order: str = "doc_id", claimed: Column | None = None, bits: int = SLOT_BITS
) -> DataFrame:
    """(``order``, leaf, path, subroot, root, claimed) of every row: its proof, from the leaf up (``siblings``, ``fold``).

    ``claimed`` is the digest that somebody presents for the row; null: its leaf.
    """
    scratch, kept = Scratch(), Scratch()  # until the arrays are written; until the result is
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    claim = F.lit(None).cast("string") if claimed is None else claimed
    leaves = docs.select(g.alias("g"), F.col(order).cast("long").alias("d"), leaf_digest([F.col(c) for c in columns]).alias("leaf"), claim.alias("claimed"))
    leaves = scratch.stored(leaves, "manifest-leaves")
    ranked, totals = placed(leaves, scratch)
    most = totals.agg(F.max("total"), F.count(F.lit(1))).first()
    nodes = ranked.join(totals, "g").withColumns({"id": F.coalesce("d", F.lit(0).cast("long")), "missing": F.col("d").isNull()})
    arrays, subroots = rounds_of(nodes.drop("d"), most[0] or 0, kept, bits)
    # The groups, numbered in order: a row each.
    groups = subroots.select("g", (F.row_number().over(Window.orderBy("g")) - 1).cast("long").alias("pos"), "subroot")
    groups = scratch.stored(groups, "manifest-groups")
    nodes = groups.select(F.lit("").alias("g"), "pos", F.lit(most[1]).cast("long").alias("total"), *inner("subroot"))
    upper, root = rounds_of(nodes, most[1], kept, bits)
    start = root.select("g", F.lit(b"").alias("path"), "subroot")
    tops = handed_down(upper, start, scratch, bits).select("pos", "path", F.col("subroot").alias("root"))
    tops = kept.stored(groups.join(tops, "pos").select("g", "path", "subroot", "root"), "manifest-tops")
    rows = handed_down(arrays, tops.select("g", "path", "subroot"), kept, bits)
    scratch.clear()
    number = F.when(~F.col("missing"), F.col("id")).alias(order)
    return rows.join(tops.select("g", "root"), "g").select(number, "leaf", "path", "subroot", "root", "claimed")


def verified(rows: DataFrame, order: str = "doc_id") -> DataFrame:
    """Adds proof_sha256, folded_root and verified to the rows of ``proofs``."""

    def run(frames):
        for frame in frames:
            paths = [siblings(p) for p in frame["path"]]
            frame["proof_sha256"] = [hashlib.sha256(b"".join(d for _, d in p)).hexdigest() for p in paths]
            given = frame["claimed"].where(frame["claimed"].notna(), frame["leaf"])
            frame["folded_root"] = [fold(d.encode(), p).decode() for d, p in zip(given, frame["path"])]
            frame["verified"] = frame["folded_root"] == frame["root"]
            yield pd.DataFrame({name: frame[name] for name in names})

    names = [order, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kinds = f"{order} string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    # As text: pandas would turn numbers beside nulls into floats.
    checked = map_frames(rows.withColumn(order, F.col(order).cast("string")), run, kinds)
    return checked.withColumn(order, F.col(order).cast("long"))


def audited(docs: DataFrame, modulus: int = 7) -> DataFrame:
    """Proofs of all documents, checked against leaves of which every ``modulus``-th id's n_chars is one more."""
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    values = [more if c == "n_chars" else F.col(c) for c in LEAF_COLUMNS]
    claimed = F.when(crc32_remainder("doc_id", modulus) == 0, leaf_digest(values))
    return verified(proofs(docs, claimed=claimed))
