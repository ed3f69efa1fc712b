"""Archives, joins, dedup, mixing, search and the pipeline against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, mismatch
from conftest import SF_DIR
from odd_documents import make_docs, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import ann, mixing, parity_join, templates, units, warc
from ledgerlens.llm.common import DOCUMENT_COLUMNS, stored, table
from ledgerlens.llm.components import components
from ledgerlens.llm.queries import ORACLE_SQL, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = [f"op{n}_" for n in range(1, 14)]


def test_one_query_per_operator():
    import __spark_entry__ as contract

    assert sorted(n.split("_")[0] + "_" for n in QUERIES) == sorted(NAMES)
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    assert mismatch(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE_SQL[name]) is None


def test_archive_has_a_dictionary_and_separate_frames():
    records = [b"WARC/1.1\r\nnumber: %d\r\n\r\n" % i + b"the same boilerplate text " * 20 for i in range(400)]
    data = warc.archive_bytes(records)
    assert int.from_bytes(data[:4], "little") == warc.SKIPPABLE_MAGIC
    found = list(warc.archive_records(data))
    assert [r for _, r in found] == records
    assert next(warc.archive_records(data[: 8 + int.from_bytes(data[4:8], "little")] + data[found[7][0] :]))[1] == records[7]
    assert [r for _, r in warc.archive_records(warc.archive_bytes(records[:1]))] == records[:1]


def test_archives_of_odd_pages(spark):
    big = "x" * 200
    rows = [(3, "u", big), (2, "u", big), (2, "u", big), (None, None, big), (5, None, None), (6, "a\r\nb é", ""), (7, "u", "tiny"), (8, "u", "tiny"), (9, "u", "é" * 300_000)]
    got = warc.archive_and_read(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")).collect()
    assert len(got) == len(rows)
    same = Counter((r.page_id, r.record_type, r.refers_to) for r in got if r.payload_bytes == 200)
    assert same == Counter([(2, "response", None), (2, "revisit", 2), (3, "revisit", 2), (None, "revisit", 2)])
    assert all(r.record_type == "response" for r in got if r.payload_bytes != 200)
    assert {r.page_id: r.payload_bytes for r in got}[9] == 600_000
    assert warc.archive_and_read(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def linked(rows, size, percent):
    """(set size, smallest reachable id) per id, by counting shared shingles of all pairs."""
    sets, inverted, parent = {}, defaultdict(list), {i: i for i, _ in rows}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[j : j + size]) for j in range(len(w) - size + 1)])

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        shared = Counter(j for g in s for j in inverted[g])
        for g in s:
            inverted[g].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(n, size=90):
    base = [f"w{i}" for i in range(size)]
    rows = [(0, " ".join(base))]
    for i in range(1, n):
        words = base.copy()
        for j in range(1 + i % 3):
            words[(i * 7 + j * 31) % size] = f"edit{i}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_parity_join(spark, make_docs, size, percent):
    tables = [[(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()], edited(150)]
    for rows in tables:
        docs = make_docs([(i, t, "en", "a") for i, t in rows])
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity_join.component_ids(docs, size, percent).collect()}
        assert got == linked(rows, size, percent)
    kept = [r.doc_id for r in parity_join.keep_one(docs, ["doc_id"], size, percent).collect()]
    assert sorted(kept) == sorted({c for _, c in got.values()})


def test_parity_join_of_odd_documents(odd_docs, no_docs):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in parity_join.component_ids(odd_docs, 3, 90).collect())
    assert got[(1, 12, 1)] == 2 and got[(2, 0, 2)] == 1 and got[(None, 0, None)] == 1 and got[(7, 1, 7)] == 1 and sum(got.values()) == 10
    assert parity_join.keep_one(odd_docs, DOCUMENT_COLUMNS, 3, 90).count() == 9
    assert parity_join.component_ids(no_docs).collect() == []


def test_cells_hold_every_pair(spark):
    members = spark.createDataFrame([(1, i, 25) for i in range(25)], "key long, node long, n_members long")
    seen = defaultdict(set)
    for r in parity_join.cells(members, cell=4).collect():
        seen[(r.x, r.y)].add(r.node)
    pairs = {(a, b) for s in seen.values() for a in s for b in s if a < b}
    assert len(pairs) == 25 * 24 // 2


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_recurring_lines_are_dropped(spark, make_docs, odd_docs, no_docs):
    rows = []
    for i in range(12):
        body = "\n".join(" ".join(f"{'abcdefghijkl'[i]}{chr(97 + line)}{chr(97 + word)}" for word in range(6)) for line in range(2))
        rows.append((i, f"{body}\nPosted on day {i} by user {i * 7}\nShare this story with {'abcdefghijkl'[i]} friends today", "en", "a"))
    copy = "a copied document\nwith several lines of prose\nthat must all stay"
    rows += [(100 + i, copy, "en", "a") for i in range(20)]
    got = {r.doc_id: r.text for r in templates.drop_lines(make_docs(rows)).collect()}
    assert all(got[i] == "\n".join(rows[i][1].split("\n")[:2]) for i in range(12))
    assert all(got[100 + i] == copy for i in range(20))
    odd = templates.drop_lines(odd_docs).collect()
    assert Counter((r.doc_id, r.text) for r in odd) == Counter((r.doc_id, r.text) for r in odd_docs.collect())
    assert templates.drop_lines(no_docs).collect() == []


def prose(i, lines=3):
    """Lines that only document ``i`` has."""
    return "\n".join(" ".join(f"{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{chr(97 + line)}{chr(97 + word)}" for word in range(8)) for line in range(lines))


def test_boilerplate_whose_own_hash_is_small_is_dropped(make_docs):
    phrases = [f"always the same closing words {a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    rows = [(100 * p + i, f"{prose(i + 12 * (p % 8))}\n{phrase}", "en", "a") for p, phrase in enumerate(phrases) for i in range(12)]
    got = {r.doc_id: r.text for r in templates.drop_lines(make_docs(rows)).collect()}
    assert [p for p, phrase in enumerate(phrases) if any(phrase in got[100 * p + i] for i in range(12))] == []
    base = prose(0, 20).split("\n")
    near = [(i, "\n".join([*base[: i % 20], prose(i + 1, 1), *base[i % 20 + 1 :]]), "en", "a") for i in range(60)]
    assert {r.doc_id: r.text for r in templates.drop_lines(make_docs(near)).collect()} == {i: t for i, t, _, _ in near}


def test_templates_that_share_a_leaf_are_dropped(make_docs):
    names = [a + b for a in ("an", "be", "cor", "da", "el") for b in ("na", "lo", "mir", "ta", "vin")]
    kinds = ["user {} has now signed in again", "order {} was sent to the customer", "payment {} failed for lack of funds"]
    alone = "backup {} ended without any error today"
    rows = []
    for i in range(75):
        lines = [prose(i), f"2024-05-{i % 28 + 1} 10:{i % 60} {i} " + kinds[i % 3].format(names[i // 3])]
        if i % 8 == 0:
            lines.append(f"2024-06-{i % 28 + 1} 11:{i % 60} {i} " + alone.format(names[i // 3]))
        rows.append((i, "\n".join(lines), "en", "a"))
    got = {r.doc_id: r.text for r in templates.drop_lines(make_docs(rows)).collect()}
    assert got == {i: prose(i) for i in range(75)}


def test_short_and_unspaced_lines_are_dropped(make_docs):
    rows = [(i, f"{prose(i)}\nRead more\nPage {i}\n版权所有不得转载" + (f"\n共{i}条评论信息\n" if i < 6 else "\n") + ("Log in" if i < 6 else str(i % 2)), "en", "a") for i in range(24)]
    got = {r.doc_id: r.text for r in templates.drop_lines(make_docs(rows)).collect()}
    assert got == {i: prose(i) + ("\nLog in" if i < 6 else f"\n{i % 2}") for i in range(24)}


def test_repeated_passages(make_docs, odd_docs, no_docs):
    passage = ". ".join(" ".join(f"p{s}w{i}" for i in range(9)) for s in range(7)) + "."
    rows = [(i, " ".join(f"d{i}x{j}" for j in range(40)) + ".\n" + (f"Glued head of {i} " + passage if i % 2 else passage) + f"\nTail of {i} alone.", "en", "a") for i in range(6)]
    rows.append((50, " ".join(f"clean{j}" for j in range(80)), "en", "a"))
    docs = make_docs(rows)
    found = units.repeated_spans(docs).collect()
    assert {r.doc_id for r in found} == {1, 2, 3, 4, 5} and {r.first_doc_id for r in found} == {0}
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        assert texts[r.doc_id][r.start : r.end].strip(" .") in passage and r.n_words >= 50
    cut = {r.doc_id: r.text for r in units.remove_spans(docs, units.repeated_spans(docs), ["doc_id"]).collect()}
    for r in found:
        assert cut[r.doc_id] == texts[r.doc_id][: r.start] + texts[r.doc_id][r.end :]
    assert cut[0] == texts[0] and cut[50] == texts[50]
    assert units.repeated_spans(odd_docs).collect() == [] and units.repeated_spans(no_docs).collect() == []


def test_short_repeats_are_reported(make_docs):
    short, clause = "This page may be copied under the usual license terms.", "本站内容未经许可不得转载。"
    rows = [(i, f"{' '.join(f'o{i}x{j}' for j in range(30))}.\n{short}\n{chr(0x4E10 + i) * 9}。{clause}{chr(0x5E10 + i) * 9}。", "en", "a") for i in range(3)]
    docs, texts = make_docs(rows), {r[0]: r[1] for r in rows}
    got = sorted((r.doc_id, texts[r.doc_id][r.start : r.end], r.n_words, r.first_doc_id) for r in units.repeated_spans(docs).collect())
    assert got == [(i, *x, 0) for i in (1, 2) for x in ((short, 10), (clause, 12))]
    assert units.repeated_spans(docs, min_words=11).count() == 2


def plain_cleaned(rows, hash_of, unit_words=8):
    """(doc_id, text) -> what is left of it, with all units of all texts in hand."""
    places = defaultdict(list)
    for doc, text in rows:
        cuts = [0, *(x for m in units.BORDER.finditer(text or "") for x in m.span()), len(text or "")]
        pieces = [(a, b) for a, b in zip(cuts[::2], cuts[1::2]) if text and units.TOKEN.search(text[a:b])]
        words = [units.TOKEN.findall(text[a:b].lower()) for a, b in pieces]
        for i in range(len(pieces)):
            j = next((j for j in range(i + 1, len(pieces) + 1) if sum(map(len, words[i:j])) >= unit_words), None)
            before = text[pieces[i - 1][1] : pieces[i][0]] if i else "\n"
            if j is None and not re.search(r"[\n\r\u2028\u2029]", before):
                continue
            rank = (1, hash_of[text]) if doc is None else (0, doc)
            places[" ".join(sum(words[i : j or len(pieces)], []))].append((rank, text, i, doc, pieces[i][0], pieces[(j or len(pieces)) - 1][1]))
    gone = defaultdict(set)
    for found in places.values():
        first, seen = min(f[0] for f in found), set()
        for rank, text, _, doc, start, end in sorted(set(found)):
            if rank > first or (doc, text) in seen:
                gone[doc, text].update(range(start, end))
            seen.add((doc, text))
    return {(doc, text): "".join(c for at, c in enumerate(text) if at not in out) for (doc, text), out in gone.items()}


def test_units_against_brute_force(spark, make_docs, monkeypatch):
    real = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    odd = [(None, "Alone without an id, this line has nine words here.\nOwn words."), (None, "Other head.\nAlone without an id, this line has nine words here."),
           (900_001, "A shared line of eight words stands here.\nFirst part."), (900_001, "Second part.\nA shared line of eight words stands here."),
           (900_002, "Say it twice, in the very same text please.\nSay it twice, in the very same text please."),
           (900_003, "This head differs from all others by these words. Thank you."), (900_004, "Nothing in this head is like the one before it. Thank you."),
           (900_005, "Thank you."), (900_006, "More\nThank you."), (900_007, None), (900_008, "")]
    rows = real + odd
    docs = make_docs([(d, t, "en", "a") for d, t in rows])
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    expected = plain_cleaned(rows, hashes)
    assert len(expected) > 50
    for frequent in (units.MAX_FREQUENT, 3):
        monkeypatch.setattr(units.marked_units, "__defaults__", (frequent,))
        left = units.remove_spans(docs, units.repeated_spans(docs), ["doc_id"]).collect()
        assert len(left) == len(rows)
        kept = Counter((r.doc_id, squeezed(r.text)) for r in left)
        assert kept == Counter((d, squeezed(expected.get((d, t), t))) for d, t in rows)


def squeezed(text):
    """Without white space: that between removed sentences may go or stay."""
    return None if text is None else re.sub(r"\s", "", text)


def shared_targets(sizes, weights):
    """Shares by weight, the excess over three times the size reshared until none is above."""
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        weight = sum(weights[s] for s in sizes if s not in capped)
        share = {s: rest * weights[s] / weight for s in sizes if s not in capped} if weight else {}
        over = [s for s, x in share.items() if x > 3 * sizes[s] + 1e-9]
        if not over:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in over}


def test_mix(spark, make_docs, odd_docs, no_docs):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 300))), "en", ["a", "b", "c", "d", None, "tiny"][min(5, i % 7)]) for i in range(600)]
    rows = [r for r in rows if r[3] != "tiny" or r[0] < 20]
    docs = make_docs(rows)
    got = mixing.mix_report(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = shared_targets(sizes, {s: 1 + i % 3 for i, s in enumerate(order)})
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6 and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 2 * mixing.BLOCK_WORDS for s in sizes)
    again = mixing.mix_report(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == DOCUMENT_COLUMNS
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == Counter({r.doc_id: r.taken for r in got if r.taken})
    assert sum(r.n_slots > 0 for r in got) == sum(r.taken > 0 for r in got) == sum(r.first_shard is not None for r in got)
    assert mixing.mix_report(odd_docs).count() == odd_docs.count()
    assert mixing.mix_report(no_docs).collect() == [] and mixing.mix_documents(no_docs).collect() == []


def test_shard_draw(spark):
    sizes, targets = {"0a": 64 * 5000, "0b": 64 * 900 + 7, "0c": 64 * 40, "1": 3}, {"0a": 64 * 2500.0, "0b": 64 * 2000.0, "0c": 64 * 120.0, "1": 9.0}
    rows = spark.createDataFrame([(s, sizes[s], targets[s]) for s in sizes], "skey string, source_size long, target double")
    quotas = {r.skey: r for r in mixing.source_quotas(rows).collect()}
    total = sum(q.slots for q in quotas.values())
    counts = Counter({(r.skey, r.shard): r.slots for r in mixing.shard_counts(mixing.source_quotas(rows), shard_slots=256).collect()})
    shards = range(-(-total // 256))
    # Shards are full but for the last; sources keep their totals.
    assert [sum(counts[s, k] for s in sizes) for k in shards] == [256] * (total // 256) + [total % 256] * (total % 256 > 0)
    assert all(sum(counts[s, k] for k in shards) == quotas[s].slots for s in sizes)
    # Counts scatter as a multinomial draw does: chi square near its degrees of freedom.
    expected = 256 * quotas["0b"].slots / total
    full = [counts["0b", k] for k in shards if 256 * (k + 1) <= total]
    chi = sum((n - expected) ** 2 for n in full) / (expected * (1 - expected / 256))
    assert 0.3 * len(full) < chi < 2.2 * len(full) and len(set(full)) > 3
    # Every slot of a shard comes from the draw, and a source's slots are used once each, in the order of the shards.
    slots = mixing.mix_slots(rows, shard_slots=256).collect()
    assert Counter((r.skey, r.shard) for r in slots) == counts
    for s in sizes:
        mine = sorted((r.slot, r.shard, r.block) for r in slots if r.skey == s)
        assert [x[0] for x in mine] == list(range(quotas[s].slots)) and [x[1] for x in mine] == sorted(x[1] for x in mine)
        for epoch in range(0, len(mine), quotas[s].blocks):
            blocks = [x[2] for x in mine[epoch : epoch + quotas[s].blocks]]
            assert len(set(blocks)) == len(blocks) and set(blocks) <= set(range(quotas[s].blocks))
    assert {tuple(r) for r in mixing.shard_counts(mixing.source_quotas(rows), seed=1, shard_slots=256).collect()} != {(*k, n) for k, n in counts.items()}
    plan = mixing.mix_report(spark.createDataFrame([(1, "w " * 500, "a")], "doc_id long, text string, source string"))
    text = plan._jdf.queryExecution().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def plain_dropped(docs, min_docs=5):
    """Line numbers that go, by (doc_id, text), with every document and line in hand."""
    lines = []
    for doc in dict.fromkeys((r.doc_id, r.text) for r in docs if r.text is not None):
        seen = set()
        for n, line in enumerate(doc[1].encode().split(b"\n")):
            tokens = line.split()
            if not tokens:
                continue
            raw, short = b" ".join(tokens), len(tokens) + templates.unspaced(line) // 2 < 3
            fields = [templates.variable(t) for t in tokens]
            form = raw if short and all(f == templates.FIELD for f in fields) else b" ".join(fields)
            leaf = len(tokens), b" ".join(form.split()[:3])
            lines.append({"doc": doc, "n": n, "raw": raw, "form": form, "leaf": leaf, "size": len(line), "new": raw not in seen, "short": short})
            seen.add(raw)

    def often(key, rows):
        return {k for k, c in Counter(r[key] for r in rows if r["new"]).items() if c >= min_docs}

    forms, leaves = often("form", lines), often("leaf", [r for r in lines if not r["short"]])
    shared = {k for k, c in Counter((r["raw"], r["doc"]) for r in lines if r["form"] in forms and r["new"]).items()}
    shared = {k for k, c in Counter(raw for raw, _ in shared).items() if c >= min_docs}
    own = defaultdict(list)
    for r in lines:
        own[r["doc"]].append(r)
    wanted = [r for r in lines if r["form"] in forms or r["leaf"] in leaves]
    for r in wanted:
        rest = {kind: [o for o in own[r["doc"]] if o["raw"] != r["raw"] and (o["raw"] in shared) == kind] for kind in (True, False)}
        size = {kind: sum(o["size"] for o in rows if o["new"]) for kind, rows in rest.items()}
        other = rest[size[True] > size[False]]
        r["origin"] = min((templates.signed_hash(o["raw"]) for o in other), default=0)

    def recurs(rows, least):
        origins = {}
        for r in rows:
            origins[r["doc"]] = min(r["origin"], origins.get(r["doc"], r["origin"]))
        return len(set(origins.values())) >= least

    gone, groups = defaultdict(set), defaultdict(list)
    for r in wanted:
        if r["form"] in forms:
            groups[r["form"], r["short"]].append(r)
    found = {k for k, rows in groups.items() if recurs(rows, min_docs * (4 if k[1] else 1))}
    by_leaf = defaultdict(list)
    for r in wanted:
        if (r["form"], r["short"]) in found:
            gone[r["doc"]].add(r["n"])
        elif not r["short"]:
            by_leaf[r["leaf"]].append(r)
    for rows in by_leaf.values():
        if recurs(rows, min_docs):
            listed = [(r["doc"], r["n"], r["form"].decode().split(" "), r["form"], r["origin"]) for r in rows]
            for _, matched in templates.Leaf(listed, min_docs, templates.SIMILARITY).rounds():
                for doc, n, *_ in matched:
                    gone[doc].add(n)
    return gone


def test_dropped_lines_of_a_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    gone = plain_dropped(docs.collect())
    got = templates.drop_lines(docs, ["doc_id"]).collect()
    want = Counter()
    for r in docs.collect():
        drop = gone.get((r.doc_id, r.text), ())
        want[r.doc_id, None if r.text is None else "\n".join(line for n, line in enumerate(r.text.split("\n")) if n not in drop), len(drop)] += 1
    assert Counter((r.doc_id, r.text, r.n_dropped) for r in got) == want and sum(map(len, gone.values())) > 100


def test_leaves_go_the_same_way_in_one_task_or_over_all(spark, make_docs):
    """Four templates in one leaf, lines that belong to none, with and without the limit."""
    names = [f"name{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = []
    for i in range(60):
        kind = ("left the red room", "came to old town", "was seen at sea", "had no more time")[i % 4]
        lines = [f"own text number {i} {names[i % 26]} {names[i * 7 % 26]} x{i}", f"the guest {names[i % 26]} {kind} {names[i * 5 % 26]}", f"the guest {names[i % 26]} some thing else {names[i * 3 % 26]} {i}"]
        rows.append((i, "\n".join(lines), "en", "a"))
    docs = make_docs(rows)
    found = [{(r.k1, r.k2, tuple(sorted(r.dropped))) for r in templates.dropped_lines(docs, leaf_rows=limit).collect()} for limit in (100_000, 12, 0)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 60


def test_permutation_is_one_to_one(spark):
    for size in (1, 2, 7, 1000):
        out = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size), F.lit(3)).alias("p")).collect()
        assert sorted(r.p for r in out) == list(range(size))


def test_search_recall_and_exact_scores(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = vectors.filter("embedding IS NOT NULL").collect()
    ids, data = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = defaultdict(list)
    for r in QUERIES["op8_collision_search"](spark, "/root/testdata/sf0.1").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        assert [r for r, _, _ in sorted(found)] == list(range(1, 21))
        scores = data @ data[ids == q][0]
        scores[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        hits += len(best & {v for _, v, _ in found})
        assert all(abs(s - scores[ids == v][0]) < 1e-12 for _, v, s in found)
    assert hits >= 0.9 * 20 * len(got)


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [-1.0, 0.0])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(vectors, vectors.filter("vec_id = 0")).collect()]
    assert sorted(got) == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0), (0, 4, 9, -1.0)]
    assert ann.nearest(vectors.limit(0), vectors.limit(0)).collect() == []


def test_pipeline(spark, odd_docs, no_docs):
    docs = table(spark, SF_DIR, "documents").select(*DOCUMENT_COLUMNS).unionByName(odd_docs.select(*DOCUMENT_COLUMNS))
    before = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stored(stage(spark, before, SF_DIR), "test-stage")
        assert after.columns == DOCUMENT_COLUMNS, name
        if name == "language ID":
            lost = {r.text for r in before.select("text").exceptAll(after.select("text")).collect()}
            assert all(not re.search(r"[^\W\d_]", t or "") for t in lost)
        if name == "line dedup":
            assert after.count() == before.count()
        if name == "n-gram Jaccard join":
            rows = [(n, r.text) for n, r in enumerate(sorted(before.collect(), key=lambda r: (r.doc_id is None, r.doc_id)))]
            groups = {c for n, (size, c) in linked(rows, 5, 80).items()}
            assert after.count() == len(groups)
        before = after
    mixed = stored(corpus_pipeline.mix_stage(spark, before, SF_DIR), "test-stage")
    encoded = corpus_pipeline.encode_stage(spark, mixed, SF_DIR)
    want = Counter((r.doc_id, r.d) for r in mixed.select("doc_id", F.sha2("text", 256).alias("d")).collect())
    assert Counter((r.doc_id, r.decoded_sha256) for r in encoded.collect()) == want
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "language ID" and corpus_pipeline.ORACLE_SQL is None
    empty = no_docs
    for _, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, SF_DIR), "test-stage")
    assert empty.count() == 0


def test_mixed_texts_keep_their_main_language(spark, make_docs):
    docs = table(spark, SF_DIR, "documents").select(*DOCUMENT_COLUMNS)
    texts = {r.lang: r.text for r in docs.filter("lang IS NOT NULL AND n_chars BETWEEN 400 AND 3000").collect()}
    mixed = "\n".join(text[:n] for text, n in zip([texts[k] for k in sorted(texts)][:3], (400, 300, 300)))
    both = docs.unionByName(make_docs([(10**9, mixed, None, "a")]).select(*DOCUMENT_COLUMNS))
    kept = corpus_pipeline.language_stage(spark, both, SF_DIR).filter(F.col("doc_id") == 10**9).collect()
    assert [r.text for r in kept] == [mixed] and kept[0].lang in texts


def test_python_tasks_give_their_memory_back(spark, monkeypatch):
    """An idle worker keeps what its largest task took, into the pipeline's later, JVM-only stages."""
    from ledgerlens.llm import common

    handed, freed = [], []
    df = spark.range(1)
    monkeypatch.setattr(type(df), "mapInPandas", lambda self, run, schema: handed.append(run))
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: handed.append(run))
    monkeypatch.setattr(common, "free_memory", lambda: freed.append(True))
    common.map_frames(df, lambda frames: iter(list(frames)), "id long")
    common.map_batches(df, lambda batches: iter(list(batches)), "id long")
    assert len(handed) == 2
    for run in handed:
        assert list(run(iter([1, 2]))) == [1, 2]
    assert len(freed) == 2
