"""Approximate nearest neighbours by inner product: collision-counting hashing.

Vectors are lifted to a common length (one more component, 0 for queries), where
the largest inner product is the smallest distance. The index is a set of
single random projections; a block of the index keeps, per projection, its
vectors sorted by projected value. A query's window on each projection is
centred on its own value. A vector whose value lies in the windows of at least
``THRESHOLD`` of the projections is a candidate and is verified with the exact
inner product. Virtual rehashing widens all windows by the factor ``STEP``
until the block has given ``VERIFY`` candidates, or all its vectors.

Every vector is indexed. Queries meet the index in blocks: each pair of a query
block and an index block is a row and an independent unit of work, and only the
best ``k`` of each unit are kept and merged. Both block sizes are bounded.

Defined cases: vectors that are null, zero or hold null or non-finite components
take no part; of queries with one vec_id the smallest vector counts; of equal
scores the smaller vec_id comes first; rows with the same
vec_id are candidates of their own, and a query never returns its own vec_id;
vectors whose length differs from the query's are no candidates of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_frames, stored

PROJECTIONS = 64
THRESHOLD = 0.75
STEP = 1.25
FIRST_SHARE = 0.15
VERIFY = 1200
INDEX_BLOCK = 8192
QUERY_BLOCK = 512
K = 20


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): non-null ids and finite, non-zero vectors in double precision."""
    cast = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return cast.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(finite & F.exists("v", lambda x: x != 0))


def packed_blocks(vectors: DataFrame, blocks: int, name: str) -> DataFrame:
    """(dim, ``name``, ids, data): vectors dealt by a hash of id into blocks, each one row of bytes."""
    dealt = vectors.withColumn("dim", F.size("v")).withColumn(name, F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id", kind="stable")
        data = np.stack(frame["v"].to_numpy())
        return pd.DataFrame(
            {"dim": [data.shape[1]], name: [frame[name].iloc[0]], "ids": [frame["vec_id"].to_numpy("<i8").tobytes()], "data": [data.astype("<f8").tobytes()]}
        )

    return dealt.groupBy("dim", name).applyInPandas(pack, f"dim int, {name} long, ids binary, data binary")


def directions(dim: int, projections: int, seed: int = 0) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim + 1, projections))


def build_index(data: np.ndarray, radius: float, projections: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values and the order of the rows, per projection."""
    lift = np.sqrt(np.maximum(radius * radius - (data * data).sum(axis=1), 0))
    values = np.column_stack([data, lift]) @ directions(data.shape[1], projections)
    order = np.argsort(values, axis=0, kind="stable")
    return np.take_along_axis(values, order, axis=0), order.astype(np.int32)


def exact_products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed in component order, so that equal vectors have equal scores."""
    return np.cumsum(rows * query, axis=1)[:, -1]


def search_block(
    ids: np.ndarray, data: np.ndarray, values: np.ndarray, order: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, radius: float, k: int, verify: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, ids, scores): the best ``k`` of a block for each query."""
    n, projections = values.shape
    needed = max(1, int(np.ceil(THRESHOLD * projections)))
    norms = np.linalg.norm(queries, axis=1)
    # Queries are scaled to the common length: their order of inner products stays.
    centres = np.column_stack([queries * (radius / norms)[:, None], np.zeros(len(queries))]) @ directions(data.shape[1], projections)
    # A window of this half width holds about FIRST_SHARE of the values if they are spread evenly.
    width = (values[-1] - values[0]) * FIRST_SHARE / 2 + 1e-12
    counts = np.zeros((len(queries), n), dtype=np.uint8)
    low = np.stack([np.searchsorted(values[:, p], centres[:, p]) for p in range(projections)], axis=1)
    high = low.copy()
    open_queries = np.arange(len(queries))
    while len(open_queries):
        edges = [centres[open_queries] - width, centres[open_queries] + width]
        wider_low = np.stack([np.searchsorted(values[:, p], edges[0][:, p], side="left") for p in range(projections)], axis=1)
        wider_high = np.stack([np.searchsorted(values[:, p], edges[1][:, p], side="right") for p in range(projections)], axis=1)
        still = []
        for j, i in enumerate(open_queries):
            # Only what the wider windows add on both sides.
            added = [order[wider_low[j, p] : low[i, p], p] for p in range(projections)]
            added += [order[high[i, p] : wider_high[j, p], p] for p in range(projections)]
            counts[i] += np.bincount(np.concatenate(added), minlength=n).astype(np.uint8)
            low[i], high[i] = wider_low[j], wider_high[j]
            found = np.flatnonzero(counts[i] >= needed)
            if len(found) < verify and ((wider_low[j] > 0).any() or (wider_high[j] < n).any()):
                still.append(i)
                continue
            found = found[ids[found] != query_ids[i]]
            # A fast product leaves those that can be among the best; they are scored exactly.
            rough = data[found] @ queries[i]
            if len(found) > k:
                found = found[rough >= np.partition(rough, len(found) - k)[len(found) - k] - 1e-9 * norms[i] * radius]
            scores = exact_products(data[found], queries[i])
            best = np.lexsort((ids[found], -scores))[:k]
            yield int(query_ids[i]), ids[found][best], scores[best]
        open_queries = np.array(still, dtype=np.int64)
        width = width * STEP


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = K, projections: int = PROJECTIONS, verify: int = VERIFY, index_block: int = INDEX_BLOCK, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every row of ``queries`` (vec_id, embedding)."""
    corpus = stored(usable(vectors), "ann-vectors")
    asked = usable(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    n, largest = corpus.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()
    m = asked.count()
    radius = float(largest or 1.0)
    packed = packed_blocks(corpus, max(1, -(-n // index_block)), "block")

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                data = np.frombuffer(row.data, "<f8").reshape(-1, row.dim)
                values, order = build_index(data, radius, projections)
                yield pd.DataFrame({"dim": [row.dim], "block": [row.block], "ids": [row.ids], "data": [row.data], "values": [values.tobytes()], "order": [order.tobytes()]})

    index = stored(map_frames(packed, build, "dim int, block long, ids binary, data binary, values binary, order binary"), "ann-index")
    parts = packed_blocks(asked, max(1, -(-m // query_block)), "part").withColumnsRenamed({"ids": "query_ids", "data": "query_data"})
    blocks = index.select("dim", "block").distinct()
    # The query set in blocks against the index in blocks.
    units = parts.join(blocks, "dim").repartition("dim", "block", "part").join(index, ["dim", "block"])

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                ids, data = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.data, "<f8").reshape(-1, row.dim)
                values = np.asfortranarray(np.frombuffer(row.values).reshape(len(ids), projections))
                order = np.asfortranarray(np.frombuffer(row.order, np.int32).reshape(len(ids), projections))
                query_ids, query_data = np.frombuffer(row.query_ids, "<i8"), np.frombuffer(row.query_data, "<f8").reshape(-1, row.dim)
                found = list(search_block(ids, data, values, order, query_ids, query_data, radius, k, verify))
                sizes = [len(f[1]) for f in found]
                yield pd.DataFrame(
                    {"query_id": np.repeat([f[0] for f in found], sizes).astype(np.int64), "vec_id": np.concatenate([f[1] for f in found]), "score": np.concatenate([f[2] for f in found])}
                )

    found = map_frames(units, search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
