"""Rings, cores, bursts, tiles, sketches and the serving table against plain Python."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from data import BASE, bursts as bursty, row, table
from pyspark.sql import functions as F
from test_plans import exchanges, plan

from ledgerlens.operators import bursts, monitoring, rings, scoring, sketches, tiles
from ledgerlens.operators.slices import HotPolicy
from ledgerlens.sinks import serving
from ledgerlens.sources.events import transactions
from ledgerlens.streaming.lifecycle import drain


# --- Rings and cores ------------------------------------------------------------
def plain_components(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in parent}


def graphs():
    rng = random.Random(4)
    names = [f"n{i:03d}" for i in range(120)]
    chain = names[:60]
    rng.shuffle(chain)
    yield "chain", list(zip(chain, chain[1:]))
    yield "hub", [("zz", n) for n in names] + [(names[3], names[4])]
    yield "sparse", [tuple(rng.sample(names, 2)) for _ in range(70)]
    yield "odd", [("a", "a"), ("b", "a"), ("a", "b"), ("a", "b"), (None, "x"), ("y", None), ("q", "q")]
    yield "empty", []


@pytest.mark.parametrize("name, edges", list(graphs()), ids=lambda x: x if isinstance(x, str) else "")
def test_components(spark, name, edges):
    got = rings.components(spark.createDataFrame(edges, "low string, high string")).collect()
    assert {r.node: r.ring for r in got} == plain_components([e for e in edges if None not in e])
    assert len({r.node for r in got}) == len(got)


def plain_core(edges, k):
    edges = {tuple(sorted(e)) for e in edges if None not in e and e[0] != e[1]}
    while True:
        degree = Counter(x for e in edges for x in e)
        left = {e for e in edges if degree[e[0]] >= k and degree[e[1]] >= k}
        if left == edges:
            return left
        edges = left


def test_core(spark):
    rng = random.Random(9)
    dense = [tuple(f"n{x}" for x in rng.sample(range(25), 2)) for _ in range(60)]
    for edges in (dense + [("n1", "m1"), ("m1", "m2")], *[e for _, e in graphs()]):
        for k in (2, 3, 4):
            got = rings.core(spark.createDataFrame(edges, "low string, high string"), k).collect()
            assert sorted((r.low, r.high) for r in got) == sorted(plain_core(edges, k))


# --- Bursts -----------------------------------------------------------------------
def plain_bursts(rows, gap=60, least=2):
    users = defaultdict(list)
    for r in rows:
        if r["user_id"] is not None and r["timestamp"] is not None:
            users[r["user_id"]].append((r["timestamp"], r["amount"]))
    found = []
    for user, times in users.items():
        times.sort(key=lambda t: t[0])
        run = [times[0]]
        for one in [*times[1:], None]:
            if one is not None and one[0] - run[-1][0] <= dt.timedelta(seconds=gap):
                run.append(one)
                continue
            if len(run) >= least:
                found.append((user, run[0][0], run[-1][0], len(run), round(sum(a or 0 for _, a in run), 4)))
            run = [one]
    return sorted(found)


def told(df):
    return sorted((r.user_id, r.start, r.end, r.transactions, round(r.total_amount, 4)) for r in df.collect())


def edge_rows():
    exact = [row(900 + i, "E", s) for i, s in enumerate([0, 60, 120.000001, 180, 241, 400])]
    return exact + [row(990, None, 5), row(991, "N", 5) | {"timestamp": None}, row(992, "E", 401, amount=None)]


@pytest.mark.parametrize("policy", [None, HotPolicy(min_rows=20, max_hot=1000, slice_rows=10), HotPolicy(min_rows=5, max_hot=1000, slice_rows=2)])
def test_bursts_cross_slices(spark, policy):
    rows = bursty(400, 3) + edge_rows() + [row(2000 + i, "U0", 10_000 + 45 * i) for i in range(200)]
    assert told(bursts.bursts(table(spark, rows), policy=policy)) == plain_bursts(rows)
    assert told(bursts.bursts(table(spark, rows), gap_seconds=5, least=1, policy=policy)) == plain_bursts(rows, 5, 1)
    assert bursts.bursts(table(spark, []), policy=policy).collect() == []


def test_burst_stream_equals_the_table(spark, tmp_path):
    rows = sorted((r for r in bursty(300, 8) + edge_rows() if r["timestamp"] is not None), key=lambda r: r["timestamp"])
    last = row(5000, "Z", 400_000)
    for i, part in enumerate((rows[:150], rows[150:], [last], [row(5001, "Z", 500_000)])):
        table(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(table(spark, []).schema).parquet(str(tmp_path / "in"))
        out = bursts.burst_stream(stream).writeStream.option("checkpointLocation", str(tmp_path / "c")).format("parquet")
        drain(out.option("path", str(tmp_path / "out")).trigger(availableNow=True).start())
    assert told(spark.read.parquet(str(tmp_path / "out"))) == plain_bursts(rows)


def test_bursts_shuffle_once(spark, tx):
    assert exchanges(bursts.bursts(tx)) == 1


# --- Tiles ------------------------------------------------------------------------
def test_tiles_add_up(spark, tx):
    scored = scoring.score_rules(tx)
    got = tiles.tile_pyramid(scored).collect()
    total = tx.count()
    for zoom in range(tiles.DEEPEST + 1):
        level = [r for r in got if r.zoom == zoom]
        assert sum(r.transactions for r in level) == total and len(level) <= 4**zoom
        assert len({r.cell for r in level}) == len({(r.x, r.y) for r in level}) == len(level)
        if zoom:
            parents = Counter()
            for r in level:
                parents[r.cell >> 2] += r.transactions
            assert parents == {r.cell: r.transactions for r in got if r.zoom == zoom - 1}
    assert exchanges(tiles.tile_pyramid(scored)) == 1


def test_tiles_at_the_borders(spark):
    places = [(90.0, -180.0), (-90.0, 180.0), (95.0, 200.0), (-100.0, -500.0), (0.0, 0.0), (None, 1.0), (1.0, None)]
    rows = [row(i, "U", i, location_lat=lat, location_lon=lon) for i, (lat, lon) in enumerate(places)]
    found = tiles.tile_pyramid(table(spark, rows).withColumn("fraud_score", F.lit(1.0)), deepest=3)
    deep = {(r.x, r.y): r.transactions for r in found.filter("zoom = 3").collect()}
    assert deep == {(0, 0): 1, (7, 7): 1, (7, 0): 1, (0, 7): 1, (4, 4): 1}
    assert found.filter("zoom = 0").head().transactions == 5
    seen = tiles.tiles_in_view(found, 3, south=-10, west=-10, north=10, east=10).collect()
    assert [(r.x, r.y) for r in seen] == [(4, 4)]
    assert tiles.tile_pyramid(found.select(F.lit(0.0).alias("location_lat"), F.lit(0.0).alias("location_lon"), F.lit(1.0).alias("amount"),
                                           F.lit(1.0).alias("fraud_score")).limit(0)).collect() == []


# --- Sketches ---------------------------------------------------------------------
def test_sketches_keep_their_error(spark, tmp_path):
    scored = scoring.score_rules(transactions(spark, "/root/testdata/sf0.1")).persist()
    sketches.write_store(sketches.sketch_buckets(scored, "6 hours"), str(tmp_path / "store"))
    store = sketches.load_store(spark, str(tmp_path / "store"))
    rows, users = scored.count(), scored.select("user_id").distinct().count()
    for merged in (sketches.merge(store), sketches.merge(sketches.merge(store, "day")), sketches.merge(store.orderBy(F.rand(3)))):
        got = sketches.answers(merged).head()
        assert got.transactions == rows and abs(got.distinct_users / users - 1) <= 0.05
        for share, value in ((0.25, got.q1), (0.5, got.median), (0.75, got.q3)):
            below, upto = scored.agg(F.count_if(F.col("amount") < value), F.count_if(F.col("amount") <= value)).head()
            assert below / rows - 0.002 <= share <= upto / rows + 0.002
        counts = {r.merchant_id: r["count"] for r in scored.groupBy("merchant_id").count().collect()}
        assert list(got.top_merchants) == sorted(counts, key=lambda m: (-counts[m], m))[:3]
    scored.unpersist()
    days = ("2024-01-01", "2024-01-02")
    first, second = (sketches.merge(sketches.load_store(spark, str(tmp_path / "store"), d, d), "merchant_category") for d in days)
    got = {r.merchant_category: r.common_users for r in sketches.common_users(first, second, "merchant_category").collect()}
    seen = scored.groupBy("merchant_category", "user_id").agg(F.collect_set(F.to_date("timestamp").cast("string")).alias("days"))
    both = seen.filter(F.array_contains("days", days[0]) & F.array_contains("days", days[1])).groupBy("merchant_category").count()
    assert got == {r.merchant_category: r["count"] for r in both.collect()}
    assert "PartitionFilters: [isnotnull(day" in plan(sketches.load_store(spark, str(tmp_path / "store"), "2024-01-02", "2024-01-02"))


def test_sketches_of_odd_rows(spark):
    rows = [row(1, "A", 0, amount=None, merchant_id=None), row(2, None, 1, amount=None), row(3, "A", 2, merchant_category=None, amount=7.0)]
    scored = table(spark, rows).withColumn("fraud_score", F.lit(0.0))
    got = {r.merchant_category: r for r in sketches.answers(sketches.merge(sketches.sketch_buckets(scored), "merchant_category")).collect()}
    assert got["restaurant"].median is None and got["restaurant"].transactions == 2 and got["restaurant"].distinct_users == 1
    assert got[None].median == 7.0 and got[None].top_merchants == ["M1"]
    assert sketches.answers(sketches.merge(sketches.sketch_buckets(scored.limit(0)), "merchant_category")).collect() == []


def test_sketches_from_a_stream(spark, tx, tmp_path):
    scored = scoring.score_rules(tx)
    scored.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(scored.schema).parquet(str(tmp_path / "in")).withWatermark("timestamp", "1 hour")
    writer = sketches.sketch_buckets(stream, "1 hour").writeStream.option("checkpointLocation", str(tmp_path / "c")).format("parquet")
    drain(writer.option("path", str(tmp_path / "out")).trigger(availableNow=True).start())
    closed = spark.read.parquet(str(tmp_path / "out"))
    end = closed.agg(F.max("bucket")).head()[0]
    whole = sketches.sketch_buckets(scored, "1 hour").filter(F.col("bucket") <= end)

    def shown(df):
        return sorted(sketches.answers(sketches.merge(df, "merchant_category")).collect(), key=lambda r: r.merchant_category)

    assert closed.count() == whole.count() > 100
    for a, b in zip(shown(closed), shown(whole), strict=True):
        assert a.total_amount == pytest.approx(b.total_amount) and a.asDict() | {"total_amount": 0} == b.asDict() | {"total_amount": 0}


# --- Serving table ------------------------------------------------------------------
def sums(df):
    return sorted((str(r.bucket), str(r.merchant_category), r.transactions, r.frauds, round(r.total_amount, 4), r.score_sum) for r in df.collect())


def test_serving_table(spark, tx, tmp_path):
    path, scored = str(tmp_path / "table"), scoring.score_rules(tx).persist()
    assert serving.load_serving(spark, path).collect() == []
    # Rows come in no order of time, so every bucket is added to again and again.
    parts = [scored.filter(F.crc32("transaction_id") % 12 == i) for i in range(12)]
    for i, part in enumerate(parts):
        serving.add_batch(part, i, path, every=3)
        if i in (0, 3, 7):  # repeated right after it was added, compactions included
            serving.add_batch(part, i, path, every=3)
        so_far = scored.filter(F.crc32("transaction_id") % 12 <= i)
        assert sums(serving.load_serving(spark, path)) == sums(serving.bucket_sums(so_far))
        assert len(list((tmp_path / "table" / "sums").iterdir())) <= 10
    # A batch that failed before its manifest was whole does not count, and its repetition does once.
    spark.range(1).select(F.lit("sums/nothing").alias("folder"), F.lit(0).alias("base")).write.json(f"{path}/manifest/batch-12")
    (tmp_path / "table" / "manifest" / "batch-12" / "_SUCCESS").unlink()
    assert sums(serving.load_serving(spark, path)) == sums(serving.bucket_sums(scored))
    serving.add_batch(scored.limit(0), 12, path, every=3)
    assert sums(serving.load_serving(spark, path)) == sums(serving.bucket_sums(scored))
    kpis, direct = serving.served_kpis(serving.load_serving(spark, path)).head(), monitoring.kpi_summary(scored).head()
    assert kpis.total_transactions == direct.total_transactions and kpis.frauds_detected == direct.frauds_detected
    scored.unpersist()


def test_serving_table_after_a_restart(spark, tx, tmp_path):
    scored = scoring.score_rules(tx)
    path = str(tmp_path / "table")
    for half in ("crc32(transaction_id) % 2 = 0", "crc32(transaction_id) % 2 = 1"):
        scored.filter(half).repartition(4).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(scored.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        drain(serving.serve(stream, path, str(tmp_path / "c"), every=3, trigger=None))
    assert sums(serving.load_serving(spark, path)) == sums(serving.bucket_sums(scored))
    odd = table(spark, [row(1, "A", 0, merchant_category=None, amount=None), row(2, "A", 0) | {"timestamp": None}]).withColumn("fraud_score", F.lit(0.0))
    got = serving.bucket_sums(odd).collect()
    assert [(r.merchant_category, r.transactions) for r in got] == [(None, 1)] and got[0].bucket == BASE
