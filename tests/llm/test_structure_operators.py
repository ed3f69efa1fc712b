"""Site templates, the Merkle manifest and conversation repair against plain versions."""

import hashlib
import heapq
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF_DIR
from odd_documents import make_docs, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from ledgerlens.llm import conversations, htmltext, manifest
from ledgerlens.llm.common import table
from ledgerlens.llm.queries import QUERIES

# --- HTML ---------------------------------------------------------------------


def page_text(source):
    return htmltext.remaining_text(htmltext.Page(source), set())


def test_article_text_of_whole_table(spark):
    """The pages of the given table hold their article in one element, without nested furniture."""
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op11_site_templates"](spark, "/root/testdata/sf0.01").collect()}
    rows = table(spark, "/root/testdata/sf0.01", "pages").collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1].replace("<b>", "").replace("</b>", "")
        want = " ".join(html.unescape(" ".join(re.split(r"</?(?:p|h1|br)>", article))).split())
        assert got[r.page_id] == (want, len(want))


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("plain &amp; simple\n text", "plain & simple text"),
        ("<p>a<p>b<br>c", "a b c"),
        ("<article><header><h1>T</h1><div>by me</div></header><p>x <b>y</b>z</p><footer>f</footer></article><p>out</p>", "T x yz"),
        ("<main><h1>T</h1><p>x</p><section class='comments'><p>no</p></section></main><aside>s</aside>", "T x"),
        ("<script>if (a < b) '</p>'</script><p>x</p><style>p>a{}</style><!-- <p>no</p> --><textarea>no</textarea>", "x"),
        ("<div id=cookie-notice>no</div><div class='AdBox'>no</div><form>no</form><p>yes</p><p hidden>no</p><p style='display: none'>no</p>", "yes"),
        ("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>", "one two a b c"),
        ("<p>a</i></div>b</p>c", "ab c"),
        ("<p title='a > b'>x</p", "x"),
        ("<p>x<!-- never closed <p>y", "x"),
        ("<p>AT&ampT &#8364; &nope; &copy;</p>", "AT&T € &nope; ©"),
        ("<div>a <span class=ad>no</span> b</div>", "a b"),
        ("<article>a</article><article class='comment'>no</article><article>b</article>", "a b"),
        ("<nav><article>no</article></nav><p>yes</p>", "yes"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<div><a href=/>Home</a> <a href=/x>News</a></div><p>text of the page</p>", "text of the page"),
        ("<article></article><p>outside</p>", ""),
    ],
)
def test_pages(source, text):
    assert page_text(source) == text


def test_deep_and_broken_pages_end():
    for source in ("<div>" * 20_000 + "x", "<p><b>" * 20_000 + "x", "<" * 50_000, "<a " + "\"'" * 20_000, "&" * 50_000, "<!--" * 9000, "<li>" * 20_000):
        page = htmltext.Page(source)
        page.hashed()
        assert "x" in htmltext.remaining_text(page, set()) or "x" not in source


def site_pages():
    """A site without marks: a bar, a page-specific text, a box; copies, exact and slightly changed; another site."""
    rng = random.Random(3)
    words = [f"word{i}" for i in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    bar = "<div class=x1><span>Our site</span> <span>All the news of the day for you</span></div>"
    box = "<div><p>Written by our team</p><div>Call us at once</div></div>"
    long = "a shared passage that many articles quote " * 2
    rows, want = [], {}

    def add(i, url, source, text):
        rows.append((i, url, source, "z", 1))
        want[i] = " ".join(text.split())

    for i in range(40):
        body = [prose(30), long, prose(12)]
        add(i, f"http://Site.example:80/{i}", f"<body>{bar}{''.join(f'<p>{b}</p>' for b in body[: 1 + i % 3])}{box}", " ".join(body[: 1 + i % 3]))
    article = [prose(40) for _ in range(6)]
    for i in range(40, 90):
        own = list(article)
        if i >= 60:
            own[i % 6] = own[i % 6].replace(own[i % 6].split()[i % 30], "changed", 1)
        add(i, f"http://site.example/{i}", f"<body>{bar}{''.join(f'<p>{b}</p>' for b in own)}{box}", " ".join(own))
    for i in range(90, 93):
        text = prose(20)
        add(i, f"http://other.example/{i}", f"<body>{bar}<p>{text}</p>", f"Our site All the news of the day for you {text}")
    for i in range(93, 110):
        text = prose(20)
        add(i, None if i % 2 else "http://", f"<body>{bar}<p>{text}</p>", f"Our site All the news of the day for you {text}")
    marked = "<article><p>the same note in all of them</p><div>Follow us today</div><p>{}</p></article>"
    for i in range(110, 120):
        text = prose(20)
        add(i, f"http://site.example/{i}", f"<body>{bar}{marked.format(text)}", f"the same note in all of them {text}")
    return rows, want


def test_templates_of_a_site_go_and_copies_stay(spark):
    rows, want = site_pages()
    pages = spark.createDataFrame([*rows, *rows[:3]], "page_id long, url string, html string, text string, key int")
    for limit in (1_000_000, 0):
        got = htmltext.main_text(pages, broadcast_rows=limit).collect()
        assert len(got) == len(rows) + 3
        assert {r.page_id: r.text for r in got} == {i: t.replace(" ".join(("a shared passage that many articles quote " * 2).split()), "").replace("  ", " ").strip() if i < 40 else t for i, t in want.items()}


def test_counts_of_subtrees(spark):
    """Origins and pages of every subtree, counted one by one."""
    rows, _ = site_pages()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, key int")
    seen = defaultdict(Counter)
    for _, url, source, _, _ in rows:
        if htmltext.host_of(url):
            for key, origin in htmltext.subtree_rows(htmltext.host_of(url), htmltext.Page(source)):
                seen[key][origin] += 1
    for least, copies in ((5, 4), (2, 1), (20, 40)):
        found = htmltext.templates(htmltext.subtrees(pages, "url", "html"), least, copies).collect()
        assert {r.key for r in found} == {k for k, c in seen.items() if len(c) >= least and c.total() <= copies * len(c)}


def test_odd_pages(spark):
    big = 2**60 + 1
    rows = [(big, None, None), (big, None, None), (None, "", ""), (1, "::", "<p>x"), (2, "http://[bad", "<p>y"), (3, "http://h/", "<p>" + "long " * 300_000), (4, "//h", None)]
    pages = spark.createDataFrame([(*r, "t", "k") for r in rows], "page_id long, url string, html string, text string, k0 string")
    got = htmltext.main_text(pages, keep=("page_id", "url", "k0")).collect()
    assert Counter((r.page_id, r.url, r.k0, len(r.text)) for r in got) == Counter(
        [(big, None, "k", 0), (big, None, "k", 0), (None, "", "k", 0), (1, "::", "k", 1), (2, "http://[bad", "k", 1), (3, "http://h/", "k", 1_499_999), (4, "//h", "k", 0)]
    )
    assert htmltext.main_text(pages.limit(0)).collect() == []
    assert htmltext.main_text(pages.limit(0), broadcast_rows=-1).collect() == []


# --- Manifest -----------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    def coded(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    n = None if row.n_chars is None else row.n_chars + more
    return digest(*map(coded, (row.doc_id, row.source, row.lang, n, row.text)))


def tree(nodes):
    """(root, the steps (side, sibling) of each node), level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    steps = []
    for place in range(len(nodes)):
        path = []
        for below in levels[:-1]:
            other = place ^ 1
            path.append(("L" if other < place else "R", below[other] if other < len(below) else ""))
            place >>= 1
        steps.append(path)
    return levels[-1][0], steps


def plain_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row.lang].append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, upper = {}, {}
    for g in groups:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        subroots[g] = tree([leaf(r) for r in groups[g]])
    root, paths = tree([subroots[g][0] for g in order])
    upper = dict(zip(order, paths))
    out = []
    for g in groups:
        for row, own in zip(groups[g], subroots[g][1]):
            path = own + upper[g]
            tampered = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 7 == 0
            at = leaf(row, 1 if tampered else 0)
            for side, other in path:
                at = digest(other, at) if side == "L" else digest(at, other)
            out.append((row.doc_id, leaf(row), subroots[g][0], root, digest(*(d for _, d in path)), at, at == root))
    return Counter(out)


def as_counter(df):
    return Counter(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in df.collect())


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_manifest_of_odd_documents(spark, make_docs, odd_docs, bits):
    rng = random.Random(7)
    ids = [-(2**63), 2**63 - 1, -1, 0, 63, 64, 2**40, 2**40 + 1, -(2**50), *(rng.randrange(-500, 4000) for _ in range(150)), *(rng.getrandbits(60) for _ in range(30))]
    rows = [(i, f"text {i % 11} é", rng.choice(["en", "de", None, "", "zz"]), rng.choice(["a", None])) for i in ids]
    docs = odd_docs.unionByName(make_docs([*rows, *rows[:40], *((5, f"t{k % 4}", "en", None) for k in range(20)), (9, "only one", "xx", None)]))
    claimed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, manifest.leaf_digest([F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in manifest.LEAF_COLUMNS]))
    got = as_counter(manifest.verified(manifest.proofs(docs, claimed=claimed, bits=bits)))
    assert got == plain_manifest(docs.collect())


def test_manifest_of_few_documents(spark, make_docs, no_docs):
    assert manifest.audited(no_docs).collect() == []
    one = make_docs([(3, "x", None, None)])
    assert as_counter(manifest.audited(one)) == plain_manifest(one.collect())
    assert next(iter(as_counter(manifest.audited(one))))[4] == hashlib.sha256().hexdigest()


def test_places_are_ranks(spark):
    """Directory ranks of many ids over several ranges."""
    rng = random.Random(1)
    ids = sorted({rng.randrange(-(2**45), 2**45) for _ in range(300)} | set(range(10_000, 10_400)) | {k << 26 for k in range(60)})
    scratch = manifest.Scratch()
    rows = spark.createDataFrame([("=a", i, str(i), None) for i in ids], "g string, d long, leaf string, claimed string")
    found, totals = manifest.placed(rows, scratch)
    assert {r.d: r.pos for r in found.collect()} == {i: n for n, i in enumerate(ids)}
    assert [r.total for r in totals.collect()] == [len(ids)]


# --- Conversations ------------------------------------------------------------

WHITE = " \t\n\x0b\x0c\r"


def cheapest(symbols):
    """(cost, audit): the least of all edits, by Dijkstra over (turn, state)."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(symbols) and state in (0, 3):
            return cost, audit
        after = 3 if state == 2 else 2
        heapq.heappush(heap, (cost + 2, audit + "I", i, after))
        if i == len(symbols):
            continue
        symbol, extra = symbols[i], int(symbols[i].isupper())
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state))
        if symbol in "bd":
            continue
        heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, after))
        kept = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((symbol.lower(), state))
        if kept:
            heapq.heappush(heap, (cost + extra, audit + "K", i + 1, kept))


def plain_repair(rows):
    """The report of one conversation's turns (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, symbols = set(), ""
    for _, role, text in rows:
        shown = text.strip(WHITE)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        symbols += "b" if not shown else "d" if (role, text) in seen else initial if shown[-1] in ".!?" else initial.upper()
        seen.add((role, text))
    cost, audit = cheapest(symbols)
    lines, left, state = [], list(rows), 0
    for letter in audit:
        if letter != "I":
            _, role, text = left.pop(0)
        if letter == "D":
            continue
        name = "assistant" if state == 2 else "user"
        lines.append(f"{role}:{text}" if letter == "K" else f"{name}:{text if letter == 'R' else ''}")
        state = 1 if letter == "K" and role[:1] == "s" else 3 if state == 2 else 2
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    truncated = sum(s.isupper() for s in symbols)
    return gaps, symbols.count("b"), symbols.count("d"), truncated, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest("\n".join(lines))


def test_block_tables_find_the_cheapest_and_least_edits():
    known, rng = conversations.tables(), random.Random(5)
    texts = ["", *("suaoSUAObd")] + ["".join(rng.choice("suaoSUAObd") for _ in range(rng.randrange(2, 15))) for _ in range(3000)]
    for symbols in texts:
        codes = conversations.codes_of(symbols)
        found, state = known.trace(codes, known.ends[0], 0)
        _, vector, total = known.read(codes, known.ends[0])
        assert (known.vectors[vector][0] + total + known.end_costs[0], "".join(found) + conversations.TRAILING[state]) == cheapest(symbols)
        between = known.between(codes)
        assert min(between[e] + conversations.AT_END[e] for e in range(4)) == cheapest(symbols)[0]


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.fixture(scope="module")
def odd_turns(spark):
    rng = random.Random(11)
    rows = [(1, None, None, None), (1, 2, "user", ""), (None, 1, "user", "Hi there."), (None, None, "tool", " x "), (2, 3, "user", "a."), (2, 3, "user", "a."), (3, -5, "", "no end")]
    rows += [(4, 2**62, "user", "big."), (4, -(2**62), "assistant", "é" * 40_000)]
    for conv in range(5, 60):
        for turn in range(rng.randrange(0, 12)):
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), rng.choice(["user", "assistant", "system", "tool", "User"]), rng.choice(["Yes.", "No!", "why", " \t", "Well? ", "ok \x0b", f"t{turn}."])))
    rows += [(100, t // 2, rng.choice(["user", "assistant", "system"]), rng.choice([f"m{t}.", f"m{t}", "same.", ""])) for t in range(300)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, symbol string, at int")


def plain_reports(rows, spoil):
    groups = defaultdict(list)
    for r in rows:
        role, text = (" " if v is None else v for v in (r.role, r.text))
        kept = groups[r.conv_id]
        kind = zlib.crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20 if spoil else 9
        if kind == 0:
            continue
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(r.turn, role, text)] * (2 if kind == 3 else 1)
    return {c: plain_repair(g) for c, g in groups.items()}


@pytest.mark.parametrize("chunk_bits", [1, 3, 14])
def test_repair_of_odd_conversations(spark, odd_turns, monkeypatch, chunk_bits):
    monkeypatch.setattr(conversations, "CHUNK_BITS", chunk_bits)
    rows = odd_turns.collect()
    for spoil in (False, True):
        got = conversations.repair(conversations.damaged(odd_turns) if spoil else odd_turns).collect()
        assert {r.conv_id: tuple(r[f] for f in FIELDS) for r in got} == plain_reports(rows, spoil) and len(got) == len({r.conv_id for r in rows})


def test_repair_of_whole_table(spark):
    got = QUERIES["op13_block_tables"](spark, SF_DIR).collect()
    rows = table(spark, SF_DIR, "conversations").collect()
    assert {r.conv_id: tuple(r[f] for f in FIELDS) for r in got} == plain_reports(rows, True)


def test_repaired_turns_are_what_the_report_hashes(spark, odd_turns):
    report = {r.conv_id: r for r in conversations.repair(odd_turns).collect()}
    turns = defaultdict(list)
    for r in conversations.repaired_turns(odd_turns).collect():
        turns[r.conv_id].append((r.number, f"{r.role}:{r.text}"))
    for conv, r in report.items():
        lines = sorted(turns[" " if conv is None else str(conv)])
        assert [n for n, _ in lines] == list(range(len(lines)))
        assert digest("\n".join(line for _, line in lines)) == r.repaired_sha256
    assert conversations.repair(odd_turns.limit(0)).collect() == [] and conversations.repaired_turns(odd_turns.limit(0)).collect() == []
