"""Language ID, BPE, suffix rules and language-model scores against direct computations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import xxhash
from conftest import SF_DIR
from odd_documents import make_docs, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, langid, lm, suffix_rules
from ledgerlens.llm.common import table
from ledgerlens.llm.elias_fano import Sequence
from ledgerlens.llm.queries import BPE_RANKS, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokenizer():
    ranks = bpe.read_ranks(BPE_RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_prefix_encoding_appends_and_edits_exactly():
    known, vocabulary = tokenizer(), bpe.Vocabulary(bpe.read_ranks(BPE_RANKS))
    rng, letters = random.Random(1), "aabbcdehinorst  \n'é漢😀1.!="
    for n in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))
        text = rng.choice("aehnt=-. ") * rng.randint(1, 50) + text if n % 3 == 0 else text
        state = bpe.PrefixEncoding(vocabulary, text=text)
        assert state.ids() == known.encode_ordinary(text)
        more = "".join(rng.choice(letters) for _ in range(rng.randint(0, 9)))
        state.append(more)
        text += more
        assert state.ids() == known.encode_ordinary(text)
        start = rng.randint(0, len(text))
        end = rng.randint(start, min(len(text), start + 5))
        state.replace(start, end, more)
        text = text[:start] + more + text[end:]
        assert state.text == text and state.ids() == known.encode_ordinary(text)


def test_bpe_of_whole_table(spark, odd_docs, no_docs):
    known = tokenizer()
    for docs in (table(spark, SF_DIR, "documents"), odd_docs):
        got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_digests(docs, BPE_RANKS).collect())
        want = Counter()
        for r in docs.collect():
            ids = known.encode_ordinary(r.text or "")
            digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
            want[(r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest())] += 1
        assert got == want
    assert bpe.encode_documents(no_docs, BPE_RANKS).collect() == []


def longest_repeats(words):
    out = [0] * len(words)
    for i in range(len(words)):
        for j in range(len(words)):
            same = 0
            while i != j and max(i, j) + same < len(words) and words[i + same] == words[j + same]:
                same += 1
            out[i] = max(out[i], same)
    return out


def test_suffix_repeats_and_windows():
    rng = random.Random(3)
    for _ in range(150):
        texts = [[rng.randint(0, rng.choice([1, 3, 9])) for _ in range(rng.randint(0, 22))] for _ in range(rng.randint(1, 5))]
        words = np.array([w for t in texts for w in t], dtype=np.int64)
        found = suffix_rules.suffix_repeats(words, np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
        assert found.tolist() == [n for t in texts for n in longest_repeats(t)]
        windows = []
        for t in texts:
            counts = Counter(tuple(t[i : i + 3]) for i in range(len(t) - 2))
            hit = [i for i in range(len(t) - 2) if counts[tuple(t[i : i + 3])] > 1]
            windows += [any(i <= w < i + 3 for i in hit) for w in range(len(t))]
        assert suffix_rules.window_words(found).tolist() == windows


def test_quality_columns(spark, odd_docs, no_docs, make_docs):
    for docs in (table(spark, SF_DIR, "documents").limit(60), odd_docs):
        rows = docs.collect()
        want = Counter()
        for r in rows:
            text = r.text or ""
            words = WORD.findall(text)
            lines = [x for x in text.split("\n") if WORD.search(x)]
            counts = Counter(zip(words, words[1:], words[2:]))
            hit = {p for i, w in enumerate(zip(words, words[1:], words[2:])) if counts[w] > 1 for p in (i, i + 1, i + 2)}
            symbols = sum(text.count(c) for c in "#*$%&|<>")
            failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
            want[(r.doc_id, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed)] += 1
        got = suffix_rules.quality(spark.createDataFrame(rows, docs.schema), ["doc_id"]).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
        assert all(not r.kept for r in got if r.base_failed)
    assert suffix_rules.quality(no_docs, ["doc_id"]).collect() == []
    passage = " ".join(f"p{i}" for i in range(40))
    filler = " ".join(f"f{i}" for i in range(80))
    kept = {r.doc_id: r.kept for r in suffix_rules.quality(make_docs([(1, f"{passage} {filler} {passage}", "en", "a"), (2, f"{passage} {filler}", "en", "a")]), ["doc_id"]).collect()}
    assert kept == {1: False, 2: True}


def test_language_id(spark, odd_docs, no_docs, make_docs):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    known = {r.doc_id: r.lang for r in docs.collect()}
    got = QUERIES["op9_language_spans"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(known) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.97 * len(held)
    odd = langid.fit_and_predict(odd_docs, ["doc_id", "text"]).collect()
    assert len(odd) == odd_docs.count()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in odd)
    assert langid.fit_and_predict(no_docs, ["doc_id"]).collect() == []
    unlabelled = make_docs([(1, "words without labels", None, "a")])
    assert [(r.lang_pred, r.score) for r in langid.fit_and_predict(unlabelled, ["doc_id"]).collect()] == [("und", 0.0)]


def test_language_spans_of_mixed_text(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.train(docs)
    texts = {r.lang: r.text for r in docs.filter("n_chars BETWEEN 300 AND 900").collect() if r.text.isprintable() or True}
    first, second = texts["de"][:280], texts["es"][:280]
    _, score, spans = langid.predict_texts([first + "\n" + second], model)[0]
    length = {lang: sum(b - a for a, b, x in spans if x == lang) for lang in ("de", "es")}
    assert min(length.values()) > 200 and 0.3 < score < 0.8


def viterbi(scores, penalty):
    best, back = scores[0].copy(), []
    for row in scores[1:]:
        step = [[best[a] - (penalty if a != b else 0) for a in range(len(row))] for b in range(len(row))]
        back.append([int(np.argmax(s)) for s in step])
        best = np.array([max(s) for s in step]) + row
    return best.max()


def test_labels_reach_the_best_path_score():
    rng = np.random.default_rng(4)
    scores = rng.normal(0, 4, (300, 3))
    first = np.array([0, 1, 5, 60, 61, 200])
    labels = langid._labels(scores, first, 6.0)
    for a, b in zip(first, [*first[1:], 300]):
        path = labels[a:b]
        got = scores[np.arange(a, b), path].sum() - 6.0 * (np.diff(path) != 0).sum()
        assert math.isclose(got, viterbi(scores[a:b], 6.0), abs_tol=1e-9)


def test_elias_fano_access_and_successor():
    rng = np.random.default_rng(0)
    for n, top in [(1, 5), (10, 1), (1000, 100), (1000, 2**40), (3000, 2**63), (300, 2**64 - 1)]:
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        kept = Sequence.build(values)
        assert (kept[np.arange(n)] == values).all()
        asked = rng.integers(0, top, 200, dtype=np.uint64, endpoint=True)
        assert (kept.successor(asked, np.zeros(200), np.full(200, n)) == np.searchsorted(values, asked)).all()


def test_tokens_of_slices(monkeypatch):
    """Chunks are slices of a batch; each text keeps its own words."""
    monkeypatch.setattr(lm, "CHUNK_BYTES", 40)
    texts = [None, "", " a  B ", "é É\x0bc", " \t", *(f"word{i} of text {i % 3}" for i in range(50)), "long " * 60]
    batch = pa.RecordBatch.from_pydict({"t": pa.array(texts, pa.string())})
    want = [[xxhash.xxh3_64_intdigest(w) for w in (t or "").encode().lower().split()] + [lm.END] for t in texts]
    got = []
    for chunk in lm.chunks_of(iter([batch, batch.slice(3, 9), batch.slice(0, 0)])):
        words, owner = lm.tokens_of(chunk.column("t"))
        got += [words[owner == i].tolist() for i in range(chunk.num_rows)]
    assert got == want + want[3:12]


def test_language_model_scores(spark, no_docs, odd_docs):
    docs = table(spark, SF_DIR, "documents").unionByName(odd_docs.filter("doc_id > 100000 OR doc_id IS NULL").select("doc_id", "text", "lang", "source", "n_chars"))
    rows = docs.collect()
    tokens = [[w.lower() for w in (r.text or "").encode().split()] + ["END"] for r in rows]
    held = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    train = [t for t, h in zip(tokens, held) if not h]
    c, pairs = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(["BEGIN", *t], t))
    n, v = sum(c.values()), len(c)
    c_context = Counter(c) + Counter({"BEGIN": len(train)})
    kept, kinds = Counter(), Counter()
    for (x, _), k in pairs.items():
        if k >= lm.MIN_COUNT:
            kept[x] += k
            kinds[x] += 1

    def backoff(x):
        return 1 - (kept[x] - lm.DISCOUNT * kinds[x]) / c_context[x] if x in kept else 1.0

    marked = docs.selectExpr("doc_id", "text", "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 7 = 2, false) AS held_out")
    model = lm.train(marked.filter("NOT held_out"), shard_tokens=2_000)
    assert (model.tokens, model.vocabulary) == (n, v) and model.shards > 3 and len(model.frequent)
    got = sorted(((r.doc_id or -1, r.n_tokens, r.n_known, r.held_out, r.base_score, r.score) for r in lm.score(marked, model).collect()))
    want = []
    for r, t, h in zip(rows, tokens, held):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        total = 0.0
        for x, y in zip(["BEGIN", *t], t):
            p = backoff(x) * (c[y] + 1) / (n + v + 1)
            if pairs[(x, y)] >= lm.MIN_COUNT:
                p += (pairs[(x, y)] - lm.DISCOUNT) / c_context[x]
            total += math.log10(p)
        want.append((r.doc_id or -1, len(t), sum(c[w] > 0 for w in t), h, base, total))
    want.sort()
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[4], w[4], rel_tol=1e-9) and abs(g[5] - w[5]) <= 0.05 * w[1]
    assert sum(g[5] for g in got if g[3]) > sum(g[4] for g in got if g[3])  # better than the base on held-out texts
    assert lm.fit_and_score(no_docs).collect() == []
    assert lm.fit_and_score(odd_docs).count() == odd_docs.count()


def test_pairs_seen_once_are_in_the_model(make_docs):
    docs = make_docs([(i, f"left{i} right{i}", "en", "a") for i in range(30)]).withColumn("held_out", F.lit(False))
    asked = make_docs([(0, "left3 right3", "en", "a"), (1, "left3 right4", "en", "a")]).withColumn("held_out", F.lit(True))
    seen, unseen = sorted((r.doc_id, r.score) for r in lm.score(asked, lm.train(docs)).collect())
    assert seen[1] > unseen[1] + 0.3


def test_training_leaves_no_shuffle_files(spark, make_docs):
    import os
    import tempfile
    from pathlib import Path

    roots = [Path(d) for d in (os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())).split(",")]

    def shuffle_files() -> set[Path]:
        return {f for root in roots for f in root.glob("blockmgr-*/*/shuffle_*.data")}

    docs = make_docs([(i, f"w{i % 7} w{i % 5} w{i % 3} end", "en", "a") for i in range(200)]).withColumn("held_out", F.lit(False))
    before = shuffle_files()
    lm.train(docs, shard_tokens=100)
    assert not shuffle_files() - before
