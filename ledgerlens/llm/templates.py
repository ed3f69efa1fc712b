"""Line dedup by log templates.

A line is parsed by a tree of fixed depth: its number of tokens, then its first
``DEPTH`` tokens, where a token with a digit counts as the variable field
``<*>``. Below a leaf, templates generalise the lines:

* a line whose masked form recurs is a template without further variables;
* over the other lines of a leaf, each position keeps the token that most lines
  have there and otherwise becomes variable. A line belongs to that template if
  at least ``SIMILARITY`` of its tokens equal the template's. Lines that do not
  belong go into another round. A leaf whose template does not recur is split by
  the position whose frequent tokens hold most lines, a part per frequent token
  and one for all other lines, until no part yields a recurring template or can
  be split.

A template recurs if its lines come from at least ``MIN_DOCS`` documents of
different origin. A line's origin is the least hash of the other lines of its
document that stand, as they are, in fewer than ``MIN_DOCS`` documents. If these
are shorter in sum than the other lines that more documents share, the document
may be a copy, exact or near, and the origin is the least hash of the shared
ones: lines of copies of one document are not taken for boilerplate. Documents
without other lines have one origin. Lines of recurring templates are dropped
from every document.

All counts are sums by hash that are combined before the shuffle. Leaves of
more than ``LEAF_ROWS`` lines go through such a round over all of them together
and are parted by it; one that has become small enough is finished in a task.
The result does not depend on that limit.

Lines of fewer than ``MIN_TOKENS`` tokens are counted by their form alone and
need ``SHORT_FACTOR`` times as many origins, as unrelated texts share them by
chance; they keep their digits if nothing else is left. In scripts without
spaces two characters count as a token, and of a token only the digits vary.

Defined cases: a null text stays null, an empty one empty; lines of white space
stay; rows that agree in doc_id and text count once and are treated alike.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import DOCUMENT_COLUMNS, UNSPACED, Scratch, map_frames, ship, small_frames, stored, within_broadcast

DEPTH = 3
SIMILARITY = 0.7
MIN_DOCS = 5
MIN_TOKENS = 3
SHORT_FACTOR = 4
# Leaves of at most so many lines and characters are finished in one task.
LEAF_ROWS, LEAF_CHARACTERS = 100_000, 16_000_000
FIELD = b"<*>"
DIGIT = re.compile(rb"[0-9]")
DIGITS = re.compile(rb"[0-9]+")
UNSPACED_CHARACTER = re.compile(f"[{UNSPACED}]")
LARGEST = (1 << 63) - 1


def document_keys() -> list[Column]:
    return [F.xxhash64("doc_id", "text").alias("k1"), F.hash("text", "doc_id").alias("k2")]


def unspaced(token: bytes) -> int:
    """Number of characters of scripts that set no spaces."""
    return 0 if token.isascii() else len(UNSPACED_CHARACTER.findall(token.decode("utf-8", "surrogatepass")))


def variable(token: bytes) -> bytes:
    if not DIGIT.search(token):
        return token
    return DIGITS.sub(FIELD, token) if unspaced(token) else FIELD


def parsed_lines(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(k1, k2, line, masked, leaf, form, raw, size, place, short): the lines with tokens of every document.

    ``raw`` is the hash of the line before its fields are masked; ``place`` is 2
    for a document's first line, 1 for others, 0 where the document has the line already.
    """
    source = docs.filter("text IS NOT NULL").select(*document_keys(), F.col("text").alias("t"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, "t", limit=2_000_000):
            rows = []
            for k1, k2, text in zip(frame["k1"].tolist(), frame["k2"].tolist(), frame["t"]):
                seen: set[int] = set()
                for number, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
                    tokens = line.split()
                    if not tokens:
                        continue
                    short = len(tokens) < MIN_TOKENS and len(tokens) + unspaced(line) // 2 < MIN_TOKENS
                    masked = b" ".join(tokens)
                    raw = form = signed_hash(masked)
                    if DIGIT.search(line):
                        fields = [variable(token) for token in tokens]
                        tokens = tokens if short and all(field == FIELD for field in fields) else fields
                        masked = b" ".join(tokens)
                        form = signed_hash(masked)
                    leaf = signed_hash(b"%d %b" % (len(tokens), b" ".join(tokens[:depth])))
                    rows.append((k1, k2, number, masked, leaf, form, raw, len(line), 0 if raw in seen else 1 if seen else 2, short))
                    seen.add(raw)
            if not rows:
                continue
            out = pd.DataFrame(rows, columns=["k1", "k2", "line", "masked", "leaf", "form", "raw", "size", "place", "short"])
            out["masked"] = [m.decode("utf-8", "surrogatepass") for m in out["masked"]]
            yield out

    return map_frames(source, run, "k1 long, k2 int, line int, masked string, leaf long, form long, raw long, size int, place byte, short boolean")


def signed_hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - LARGEST - 1


def frequent(lines: DataFrame, key: str, min_docs: int) -> DataFrame:
    """Values of ``key`` with so many lines that they can recur."""
    counts = lines.filter("place > 0").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= min_docs).select(key)


def with_origins(lines: DataFrame, forms: DataFrame, leaves: DataFrame, scratch: Scratch, min_docs: int) -> DataFrame:
    """The lines of frequent ``forms`` or ``leaves`` with origin and often, which is set for those of the forms."""
    same = lines.join(forms, "form", "left_semi").select("raw", "k1", "k2").distinct()
    shared = same.groupBy("raw").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs).select("raw", F.lit(True).alias("shared"))
    shared = within_broadcast(scratch.stored(shared, "templates-shared"))
    marked = lines.join(shared, "raw", "left").withColumn("shared", F.coalesce("shared", F.lit(False)))
    sizes = {
        name: F.sum(F.when((F.col("place") > 0) & (F.col("shared") == kind), F.col("size")).otherwise(0)) / F.count_if(F.col("place") == 2)
        for name, kind in (("shared_size", True), ("own_size", False))
    }
    # Both ends, as one of them may be the line that asks.
    ends = {
        f"{name}_{end}": least(F.when(F.col("shared") == kind, F.col("raw")))
        for name, kind in (("shared", True), ("own", False))
        for end, least in (("low", F.min), ("high", F.max))
    }
    documents = marked.groupBy("k1", "k2").agg(*[c.alias(name) for name, c in (sizes | ends).items()])
    wanted = marked.join(forms.withColumn("often", F.lit(True)), "form", "left")
    wanted = wanted.join(leaves.withColumn("busy", F.lit(True)), "leaf", "left").filter("often OR busy")

    def other(name: str) -> Column:
        end = F.when(F.col(f"{name}_low") != F.col("raw"), F.col(f"{name}_low")).otherwise(F.col(f"{name}_high"))
        return F.when(end != F.col("raw"), end)

    shared_left = F.col("shared_size") - F.when(F.col("shared"), F.col("size")).otherwise(0)
    own_left = F.col("own_size") - F.when(F.col("shared"), 0).otherwise(F.col("size"))
    origin = F.coalesce(F.when(shared_left > own_left, other("shared")).otherwise(other("own")), F.lit(0))
    columns = ["k1", "k2", "line", "masked", "leaf", "form", "short", F.coalesce("often", F.lit(False)).alias("often")]
    return wanted.join(documents, ["k1", "k2"]).select(*columns, origin.alias("origin"))


def recurring(lines: DataFrame, key: str, min_docs: int) -> DataFrame:
    """Values of ``key`` whose lines come from enough documents of different origin."""
    documents = lines.groupBy(key, "k1", "k2").agg(F.min("origin").alias("origin"))
    origins = documents.groupBy(key, "origin").agg(F.lit(1).alias("one"))
    return origins.groupBy(key).agg(F.count(F.lit(1)).alias("origins")).filter(F.col("origins") >= min_docs).select(key)


def majority_templates(lines: DataFrame) -> DataFrame:
    """(leaf, template): per position the token of more than half of the leaf's distinct (form, origin), or null."""
    forms = lines.groupBy("leaf", "form", "origin").agg(F.min("masked").alias("masked"))
    sizes = forms.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))
    placed = forms.select("leaf", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    counts = placed.groupBy("leaf", "place", "token").agg(F.count(F.lit(1)).alias("n"))
    kept = counts.join(sizes, "leaf").select("leaf", "place", F.when(2 * F.col("n") > F.col("size"), F.col("token")).alias("token"))
    best = kept.groupBy("leaf", "place").agg(F.max("token").alias("token"))
    template = F.transform(F.sort_array(F.collect_list(F.struct("place", "token"))), lambda x: x["token"])
    return best.groupBy("leaf").agg(template.alias("template"))


def promising(lines: DataFrame, min_docs: int, similarity: float) -> DataFrame:
    """The lines that a recurring template of their leaf can match.

    A template's token stands in more than half of ``min_docs`` forms or more,
    so a line needs ``similarity`` of its tokens to be at least that usual.
    """
    placed = lines.select("leaf", "k1", "k2", "line", F.size(F.split("masked", " ")).alias("size"), F.posexplode(F.split("masked", " ")).alias("place", "token"))
    usual = placed.groupBy("leaf", "place", "token").agg(F.count(F.lit(1)).alias("n")).filter(2 * F.col("n") > min_docs).drop("n")
    met = placed.join(usual, ["leaf", "place", "token"]).groupBy("k1", "k2", "line").agg(F.count_distinct("place").alias("met"), F.max("size").alias("size"))
    kept = met.filter(F.col("met") >= similarity * F.col("size")).select("k1", "k2", "line")
    return lines.join(kept, ["k1", "k2", "line"], "left_semi")


def split_leaves(lines: DataFrame, min_docs: int) -> DataFrame:
    """Lines with the number of the part of their leaf that they belong to; leaves of one part are left out.

    A leaf is parted at the position where the squared sizes of the tokens in
    ``min_docs`` documents or more, but not in all lines, have the greatest sum.
    """
    placed = lines.select("leaf", "k1", "k2", "line", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    counts = placed.groupBy("leaf", "place", "token", "k1", "k2").agg(F.count(F.lit(1)).alias("lines"))
    counts = counts.groupBy("leaf", "place", "token").agg(F.count(F.lit(1)).alias("n"), F.sum("lines").alias("lines"))
    sizes = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))
    usual = counts.filter(F.col("n") >= min_docs).join(sizes, "leaf").filter("lines < size")
    weights = usual.groupBy("leaf", "place").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("weight"))
    best = weights.groupBy("leaf").agg(F.max_by("place", F.struct("weight", -F.col("place"))).alias("at"))
    parts = usual.join(best, "leaf").filter("place = at").select("leaf", "token", F.lit(True).alias("usual"))
    dealt = lines.join(best, "leaf").withColumn("token", F.element_at(F.split("masked", " "), F.col("at") + 1))
    dealt = dealt.join(parts, ["leaf", "token"], "left")
    part = F.xxhash64("leaf", "at", F.when(F.col("usual"), F.col("token")))
    return dealt.withColumn("leaf", part).select(*lines.columns)


class Leaf:
    """Lines of one leaf, with the same steps as the functions above take over all leaves."""

    def __init__(self, rows: list[tuple], min_docs: int, similarity: float):
        self.rows, self.min_docs, self.similarity = rows, min_docs, similarity  # rows: document, line, tokens, form, origin

    def recurs(self, rows: list[tuple]) -> bool:
        origins: dict = {}
        for document, _, _, _, origin in rows:
            origins[document] = min(origin, origins.get(document, origin))
        return len(set(origins.values())) >= self.min_docs

    def promising(self, rows: list[tuple]) -> list[tuple]:
        counts = Counter(placed for row in rows for placed in enumerate(row[2]))
        return [r for r in rows if sum(2 * counts[placed] > self.min_docs for placed in enumerate(r[2])) >= self.similarity * len(r[2])]

    def template(self, rows: list[tuple]) -> list[bytes | None]:
        forms = {(form, origin): tokens for _, _, tokens, form, origin in rows}
        places = zip(*forms.values())
        best = [Counter(place).most_common(1)[0] for place in places]
        return [token if 2 * n > len(forms) else None for token, n in best]

    def parts(self, rows: list[tuple]) -> list[list[tuple]]:
        documents, lines = defaultdict(set), Counter()
        for document, _, tokens, _, _ in rows:
            for placed in enumerate(tokens):
                documents[placed].add(document)
                lines[placed] += 1
        usual = {placed: len(found) for placed, found in documents.items() if len(found) >= self.min_docs and lines[placed] < len(rows)}
        weights: Counter = Counter()
        for (place, _), n in usual.items():
            weights[place] += n * n
        if not weights:
            return []
        at = max(weights, key=lambda place: (weights[place], -place))
        dealt = defaultdict(list)
        for row in rows:
            token = row[2][at]
            dealt[token if (at, token) in usual else None].append(row)
        return list(dealt.values())

    def rounds(self) -> Iterator[tuple[str, list[tuple]]]:
        """(template, its lines), until no part has another."""
        waiting = [self.rows]
        while waiting:
            rows = self.promising(waiting.pop())
            if not rows:
                continue
            template = self.template(rows)
            near = [sum(a == b for a, b in zip(r[2], template)) >= self.similarity * len(r[2]) for r in rows]
            matched = [r for r, hit in zip(rows, near) if hit]
            if self.recurs(matched):
                yield " ".join(FIELD.decode() if token is None else token for token in template), matched
                left = [[r for r, hit in zip(rows, near) if not hit]]
            else:
                left = self.parts(rows)
            waiting += [part for part in left if self.recurs(part)]


def finished(lines: DataFrame, min_docs: int, similarity: float) -> DataFrame:
    """(k1, k2, line, template): the lines of all templates of leaves that fit into a task; the template once per leaf and round."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows = [((a, b), line, masked.split(" "), form, origin) for a, b, line, masked, form, origin in frame[["k1", "k2", "line", "masked", "form", "origin"]].itertuples(index=False)]
        out = []
        for template, matched in Leaf(rows, min_docs, similarity).rounds():
            out += [(*document, line, None if n else template) for n, (document, line, *_) in enumerate(matched)]
        return pd.DataFrame(out, columns=["k1", "k2", "line", "template"])

    ship(lines.sparkSession)
    return lines.groupBy("leaf").applyInPandas(run, "k1 long, k2 int, line int, template string")


def line_templates(
    lines: DataFrame, scratch: Scratch, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY, leaf_rows: int = LEAF_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(rows of ``lines`` to drop as k1, k2, line; the templates found)."""
    often = within_broadcast(scratch.stored(frequent(lines, "form", min_docs), "templates-often"))
    busy = within_broadcast(scratch.stored(frequent(lines.filter("NOT short"), "leaf", min_docs), "templates-busy"))
    lines = scratch.stored(with_origins(lines, often, busy, scratch, min_docs), "templates-origins")
    usual = recurring(lines.filter("often AND NOT short"), "form", min_docs)
    short = recurring(lines.filter("often AND short"), "form", SHORT_FACTOR * min_docs)
    forms = within_broadcast(scratch.stored(usual.unionByName(short), "templates-forms"))
    dropped = [lines.join(forms, "form", "left_semi").select("k1", "k2", "line")]
    named = [lines.join(forms, "form", "left_semi").groupBy("form").agg(F.min("masked").alias("template")).select("template")]
    lines = lines.filter("NOT short").join(forms, "form", "left_anti")
    leaves = within_broadcast(scratch.stored(recurring(lines, "leaf", min_docs), "templates-leaves"))
    rest = lines.join(leaves, "leaf", "left_semi")
    while True:
        rest = scratch.stored(rest, "templates-rest")
        sizes = scratch.stored(rest.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("masked")).alias("size")), "templates-sizes")
        fits = (F.col("n") <= leaf_rows) & (F.col("size") <= LEAF_CHARACTERS)
        large = sizes.filter(~fits).select("leaf")
        # A leaf that one task can hold goes through all its rounds there.
        held = scratch.stored(finished(rest.join(sizes.filter(fits).select("leaf"), "leaf", "left_semi"), min_docs, similarity), "templates-held")
        dropped.append(held.select("k1", "k2", "line"))
        named.append(held.filter("template IS NOT NULL").select("template"))
        if not large.head(1):
            break
        rest = scratch.stored(promising(rest.join(large, "leaf", "left_semi"), min_docs, similarity), "templates-large")
        templates = majority_templates(rest)
        tokens = F.split("masked", " ")
        same = F.aggregate(
            F.zip_with(tokens, "template", lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda total, x: total + x
        )
        near = rest.join(templates, "leaf").withColumn("near", same >= similarity * F.size(tokens))
        matched = scratch.stored(near.filter("near"), "templates-matched")
        found = scratch.stored(recurring(matched, "leaf", min_docs), "templates-found")
        hits = matched.join(found, "leaf", "left_semi")
        gone = scratch.stored(hits.select("k1", "k2", "line"), "templates-gone")
        dropped.append(gone)
        shown = F.array_join("template", " ", FIELD.decode())
        named.append(hits.groupBy("leaf").agg(F.min(shown).alias("template")).select("template"))
        left = rest.join(found, "leaf", "left_semi").join(gone, ["k1", "k2", "line"], "left_anti")
        parted = split_leaves(rest.join(found, "leaf", "left_anti"), min_docs)
        left = scratch.stored(left.unionByName(parted), "templates-left")
        rest = left.join(recurring(left, "leaf", min_docs), "leaf", "left_semi")
    rows, texts = dropped[0], named[0]
    for more, names in zip(dropped[1:], named[1:]):
        rows, texts = rows.unionByName(more), texts.unionByName(names)
    return rows.distinct(), texts


def dropped_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY, depth: int = DEPTH, leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """(k1, k2, dropped): line numbers to drop of each document that has any."""
    scratch = Scratch()
    lines = scratch.stored(parsed_lines(docs, depth), "templates-lines")
    rows, _ = line_templates(lines, scratch, min_docs, similarity, leaf_rows)
    dropped = stored(rows.groupBy("k1", "k2").agg(F.collect_list("line").alias("dropped")), "templates-dropped")
    scratch.clear()
    return dropped


def drop_lines(docs: DataFrame, keep: list[str] = DOCUMENT_COLUMNS, **options) -> DataFrame:
    """``keep`` of every document with the lines of recurring templates removed from text.

    Adds n_lines and n_dropped; ``n_chars``, if kept, is the new length.
    """
    dropped = dropped_lines(docs, **options)
    rows = docs.select(*dict.fromkeys([*keep, "text"]), *document_keys())
    lines = F.split("text", "\n")
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("dropped", i)), "\n")
    changed = rows.join(dropped, ["k1", "k2"], "left").withColumns(
        {
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
            "n_dropped": F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long"),
            "text": F.when(F.col("dropped").isNull(), F.col("text")).otherwise(left),
        }
    )
    if "n_chars" in keep:
        changed = changed.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    return changed.select(*dict.fromkeys([*keep, "text"]), "n_lines", "n_dropped")
