"""Conversation structure repair by Four-Russians block tables.

A conversation is repaired by the cheapest edits after which the initials of its
roles read ``(s?(ua)+)?``: keep a turn (0), give it the role user or assistant
(2), delete it (3; blank turns and repeats must go) or insert an empty user or
assistant turn (2). A truncated turn that stays costs 1 more. Of equally cheap
edits the audit (D, I, K, R in order) that is least in ASCII order is taken.

What the rest of a conversation costs is a vector over the four states of that
pattern. A turn is one of ``len(CODES)`` symbols and maps the vector behind it
to the one before it; vectors less their least entry are few, so

* the maps of all blocks of ``BLOCK`` symbols are computed once, for every
  vector that can occur, and a conversation is read backward a block at a time
  by lookup;
* to trace the edits, blocks are expanded backward, symbol by symbol, from the
  vector behind them, and followed forward from the state before them; each
  symbol's edit depends on the vector behind it and the state only.

Spark keeps a long conversation apart: its turns are dealt by range, and at most
``1 << CHUNK_BITS`` of them make a chunk. A chunk yields the costs between all
states; these, one small row per chunk, are chained per conversation to the
vectors behind each chunk; each chunk is traced from the states it may start in;
and the states are chained. Texts are joined to their edits by a sort and read
as a stream, so a conversation is never held as a whole. One task hashes a
conversation's repaired text, as SHA-256 takes its bytes in order.

Defined cases: null role or text counts as one space; turns are ordered by
(turn, role, text), null turns first; a null conversation id is one
conversation; roles other than s, u, a by initial can be reroled or deleted;
without turns all numbers are zero and the audit is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, map_frames

WHITE = " \t\n\x0b\x0c\r"
BLOCK = 4
CHUNK_BITS = 14
FAR = 1 << 40
# Symbols: the role's initial (o: another), capital if truncated; b, d: blank, duplicate.
CODES = {symbol: code for code, symbol in enumerate("suaoSUAO")} | {"b": 8, "d": 8}
GONE = 8
# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
EXPECTED = (USER, USER, ASSISTANT, USER)  # the state after the turn that may come next, system apart
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
AT_END = (0, 2 * INSERT, INSERT, 0)
TRAILING = ("", "II", "I", "")


def with_inserts(costs: list[int]) -> tuple[int, ...]:
    user = min(costs[USER], INSERT + costs[ASSISTANT])
    assistant = min(costs[ASSISTANT], INSERT + costs[USER])
    return min(costs[START], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant


def kept_state(code: int, state: int) -> int | None:
    """The state after a turn that is kept; None if it cannot be kept there."""
    role = code % 4 if code < GONE else -1
    if role == 0:
        return SYSTEM if state == START else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if role == 2 and state == USER else None


def edits_at(code: int, state: int, behind: tuple[int, ...]) -> Iterator[tuple[int, str, int]]:
    """(cost with the rest, edit, state after) of what can be done with a turn."""
    yield DELETE + behind[state], "D", state
    if code == GONE:
        return
    extra = TRUNCATED if code >= 4 else 0
    kept = kept_state(code, state)
    if kept is not None:
        yield KEEP + extra + behind[kept], "K", kept
    yield REROLE + extra + behind[EXPECTED[state]], "R", EXPECTED[state]


def before(code: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """The costs of the rest from each state before a turn."""
    return with_inserts([min(cost for cost, _, _ in edits_at(code, state, behind)) for state in range(4)])


def normal(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(FAR if c >= FAR // 2 else c - least for c in costs), least


class Tables:
    """Transitions of normalised vectors by one symbol and by every block of ``BLOCK`` symbols."""

    def __init__(self) -> None:
        # Behind the last turn, and, for costs between states, behind the end in one state.
        only = [with_inserts([0 if s == end else FAR for s in range(4)]) for end in range(4)]
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.ends = [self._add(normal(v)[0]) for v in (AT_END, *only)]
        self.end_costs = [normal(v)[1] for v in (AT_END, *only)]
        moves: list[list[tuple[int, int]]] = []
        while len(moves) < len(self.vectors):  # grows until no new vector occurs
            behind = self.vectors[len(moves)]
            moves.append([(self._add(v), cost) for v, cost in (normal(before(code, behind)) for code in range(GONE + 1))])
        self.one = np.array([[v for v, _ in row] for row in moves])
        self.one_cost = np.array([[c for _, c in row] for row in moves])
        # Blocks as numbers in base 9, first symbol first; the last symbol is applied first.
        block, cost = np.arange(len(moves))[:, None], np.zeros((len(moves), 1), dtype=np.int64)
        for _ in range(BLOCK):
            cost = (cost[:, None, :] + self.one_cost[block].transpose(0, 2, 1)).reshape(len(moves), -1)
            block = self.one[block].transpose(0, 2, 1).reshape(len(moves), -1)
        self.block, self.block_cost = block.tolist(), cost.tolist()
        self.steps: dict[tuple[int, int, int], tuple[str, int]] = {}

    def _add(self, vector: tuple[int, ...]) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector]

    def vector_of(self, costs: tuple[int, ...]) -> int:
        return self.number[normal(costs)[0]]

    def read(self, codes: list[int], vector: int) -> tuple[list[int], int, int]:
        """(the vector behind each block, first block first, and behind the end; that before the first symbol; its cost)."""
        total, behind = 0, [vector]
        whole = len(codes) // BLOCK
        for code in reversed(codes[whole * BLOCK :]):
            total += int(self.one_cost[vector, code])
            vector = int(self.one[vector, code])
        for number in range(whole - 1, -1, -1):
            behind.append(vector)
            index = 0
            for code in codes[number * BLOCK : number * BLOCK + BLOCK]:
                index = index * (GONE + 1) + code
            total += self.block_cost[vector][index]
            vector = self.block[vector][index]
        return behind[::-1], vector, total

    def between(self, codes: list[int]) -> list[int]:
        """Costs of getting from each state to each state, by rows."""
        rows = []
        for end in range(4):
            _, vector, total = self.read(codes, self.ends[end + 1])
            rows.append([min(FAR, c + total + self.end_costs[end + 1]) for c in self.vectors[vector]])
        return [rows[end][start] for start in range(4) for end in range(4)]

    def step(self, vector: int, code: int, state: int) -> tuple[str, int]:
        """The inserts and the edit of a turn, by the vector behind it and the state before it; the state after it."""
        key = (vector, code, state)
        if key not in self.steps:
            behind = self.vectors[vector]
            costs, letters = before(code, behind), ""
            while True:
                options = [*edits_at(code, state, behind), (INSERT + costs[EXPECTED[state]], "I", EXPECTED[state])]
                letter, after = min((letter, after) for cost, letter, after in options if cost == costs[state])
                letters, state = letters + letter, after
                if letter != "I":
                    break
            self.steps[key] = letters, state
        return self.steps[key]

    def trace(self, codes: list[int], vector: int, state: int) -> tuple[list[str], int]:
        """The edits of each turn from ``state`` on, and the state behind the last; ``vector`` stands behind it."""
        behind, _, _ = self.read(codes, vector)
        edits = []
        for number, start in enumerate(range(0, len(codes), BLOCK)):
            part = codes[start : start + BLOCK]
            vectors = [behind[number] if len(part) == BLOCK else vector]
            for code in reversed(part[1:]):
                vectors.append(int(self.one[vectors[-1], code]))
            for code, after in zip(part, reversed(vectors)):
                letters, state = self.step(after, code, state)
                edits.append(letters)
        return edits, state


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def damaged(conversations: DataFrame, modulus: int = 20) -> DataFrame:
    """Turns spoilt by crc32 of ``conv_id:turn``: 0 dropped, 1 emptied, 2 without [.!?], 3 repeated, 4 said by the user."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(texts[0], F.lit(":"), texts[1]).cast("binary")) % modulus
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    kind, text = F.col("kind"), F.col("text")
    spoilt = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(text)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    copies = F.array_repeat(F.struct(F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), spoilt.alias("text")), times)
    # Dropped turns stay as rows without role: their conversation is still to be reported.
    turns = rows.select("conv_id", "turn", (kind == 0).alias("dropped"), F.explode_outer(copies).alias("x"))
    return turns.select("conv_id", "turn", "dropped", "x.role", "x.text")


def key_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def ordered(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(the turns (c, at, role, text) with their place in order; their symbols (c, at, symbol))."""
    texts = [F.coalesce(F.col(x), F.lit(" ")).alias(x) for x in ("role", "text")]
    rows = turns.select(key_of("conv_id").alias("c"), "turn", *texts)
    order = ["c", F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = scratch.stored(dealt.select("c", F.monotonically_increasing_id().alias("at"), "role", "text"), "turns-ordered")
    said = rows.groupBy("c", F.xxhash64("role", "text"), F.hash("text", "role")).agg(F.min("at").alias("at"))
    first = said.select("at", F.lit(True).alias("first"))
    # Of a text that a conversation repeats the first stays; ``at`` is unique, so no key is hot.
    trimmed = F.rtrim("text", F.lit(WHITE))
    role = F.substring("role", 1, 1)
    role = F.when(role.isin("s", "u", "a"), role).otherwise("o")
    whole = F.right(trimmed, F.lit(1)).isin(".", "!", "?")
    slim = rows.select("c", "at", F.when(trimmed == "", "b").alias("blank"), F.when(whole, role).otherwise(F.upper(role)).alias("role"))
    symbol = F.coalesce("blank", F.when(F.col("first").isNull(), "d"), F.col("role"))
    return rows, slim.join(first, "at", "left").select("c", "at", symbol.alias("symbol"))


def chunks(symbols: DataFrame) -> DataFrame:
    """(c, first, symbols): runs of a conversation's turns, numbered from ``first`` on without gaps."""
    listed = F.sort_array(F.collect_list(F.struct("at", "symbol")))
    grouped = symbols.groupBy("c", F.shiftright("at", CHUNK_BITS).alias("chunk")).agg(listed.alias("turns"))
    return grouped.select("c", F.col("turns")[0]["at"].alias("first"), F.array_join("turns.symbol", "").alias("symbols"))


def codes_of(symbols: str) -> list[int]:
    return [CODES[s] for s in symbols]


def edits(symbols: DataFrame, scratch: Scratch) -> DataFrame:
    """(c, at, symbol, edits): inserts, edit and, at the end, trailing inserts of every turn."""
    parts = scratch.stored(chunks(symbols), "turns-chunks")

    def costs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["between"] = [tables().between(codes_of(s)) for s in frame.pop("symbols")]
            yield frame

    def behind(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for c, chain in zip(frame["c"], frame["chain"]):
                vector = list(AT_END)
                for number in range(len(chain) - 1, -1, -1):
                    part = chain[number]
                    out.append((c, part["first"], number == 0, number == len(chain) - 1, vector))
                    m = part["between"]
                    vector = [min(m[4 * s + e] + vector[e] for e in range(4)) for s in range(4)]
            yield pd.DataFrame(out, columns=["c", "first", "opens", "closes", "behind"])

    def traced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for c, first, symbols, opens, closes, vector in frame.itertuples(index=False):
                codes, number = codes_of(symbols), tables().vector_of(tuple(int(x) for x in vector))
                for start in (START,) if opens else range(4):
                    found, end = tables().trace(codes, number, start)
                    if closes:
                        found[-1] += TRAILING[end]
                    out.append((c, first, start, end, symbols, " ".join(found)))
            yield pd.DataFrame(out, columns=["c", "first", "start", "end", "symbols", "edits"])

    def followed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for c, chain in zip(frame["c"], frame["chain"]):
                ends, state = {(p["first"], p["start"]): p["end"] for p in chain}, START
                for first in sorted({p["first"] for p in chain}):
                    out.append((c, first, state))
                    state = ends[first, state]
            yield pd.DataFrame(out, columns=["c", "first", "start"])

    def chained(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.groupBy("c").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("chain"))

    between = map_frames(parts, costs, "c string, first long, between array<long>")
    known = map_frames(chained(between, "first", "between"), behind, "c string, first long, opens boolean, closes boolean, behind array<long>")
    asked = parts.join(known, ["c", "first"]).select("c", "first", "symbols", "opens", "closes", "behind")
    paths = scratch.stored(map_frames(asked, traced, "c string, first long, start int, end int, symbols string, edits string"), "turns-paths")
    taken = map_frames(chained(paths, "first", "start", "end"), followed, "c string, first long, start int")
    chosen = paths.join(taken, ["c", "first", "start"])
    placed = chosen.select("c", "first", "symbols", F.posexplode(F.split("edits", " ")).alias("n", "edits"))
    return placed.select("c", (F.col("first") + F.col("n")).alias("at"), F.substring("symbols", F.col("n") + 1, F.lit(1)).alias("symbol"), "edits")


class Repair:
    """One conversation as its turns go by."""

    def __init__(self) -> None:
        self.state, self.cost, self.audit, self.role = START, 0, [], None
        self.counts = {"b": 0, "d": 0, "truncated": 0, "illegal": 0}

    def turn(self, role: str, text: str, symbol: str, edits: str) -> Iterator[tuple[str, str]]:
        """The (role, text) that a turn becomes, inserted ones included."""
        initial = role[:1]
        if self.role is not None:
            self.counts["illegal"] += self.role + initial not in ("su", "ua", "au")
        self.role = initial
        truncated = symbol.isupper()
        if symbol in "bd":
            self.counts[symbol] += 1
        self.counts["truncated"] += truncated
        self.audit.append(edits)
        for letter in edits:
            if letter == "D":
                self.cost += DELETE
                continue
            state, name = EXPECTED[self.state], "assistant" if self.state == USER else "user"
            if letter == "K":
                state, name = kept_state(CODES[symbol], self.state), role
            self.cost += {"K": KEEP, "R": REROLE, "I": INSERT}[letter] + (truncated and letter != "I")
            self.state = state
            yield name, "" if letter == "I" else text


def streamed(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Turns and edits (c, at, kind, a, b) side by side, a conversation in one partition, in order."""
    turns = rows.select("c", "at", F.lit(1).alias("kind"), F.col("role").alias("a"), F.col("text").alias("b"))
    found = decided.select("c", "at", F.lit(0).alias("kind"), F.col("symbol").alias("a"), F.col("edits").alias("b"))
    return turns.unionByName(found).repartition("c").sortWithinPartitions("c", "at", "kind")


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Repair, list[tuple[str, str]]]]:
    """(conversation, its repair so far, what the turn becomes) for every turn."""
    key, repair, found = None, None, ("", "")
    for frame in frames:
        for c, kind, a, b in zip(frame["c"], frame["kind"], frame["a"], frame["b"]):
            if kind == 0:
                found = a, b
                continue
            if repair is None or c != key:
                key, repair = c, Repair()
            yield c, repair, list(repair.turn(a, b, *found))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv_id as text, number, role, text): the repaired conversations, turns numbered from 0."""
    scratch = Scratch()
    rows, symbols = ordered(turns, scratch)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, last, number = [], None, 0
        for c, _, lines in _walk(frames):
            number = number if c == last else 0
            last = c
            for role, text in lines:
                out.append((c, number, role, text))
                number += 1
            if len(out) >= 2000:
                yield pd.DataFrame(out, columns=["conv_id", "number", "role", "text"])
                out = []
        yield pd.DataFrame(out, columns=["conv_id", "number", "role", "text"])

    return map_frames(streamed(rows, edits(symbols, scratch)), run, "conv_id string, number long, role string, text string")


def repair(turns: DataFrame) -> DataFrame:
    """A row per conversation: faults, cost, audit, and the SHA-256 of its repaired ``role:text`` lines.

    ``turns`` may have a boolean column ``dropped``: such rows only name their conversation.
    """
    scratch = Scratch()
    there = turns.filter("NOT dropped") if "dropped" in turns.columns else turns
    rows, symbols = ordered(there, scratch)
    columns = ["blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, last, current, digest, lines_so_far = [], None, None, None, 0

        def row():
            n = current.counts
            return (last, n["b"], n["d"], n["truncated"], n["illegal"], current.cost, "".join(current.audit), digest.hexdigest())

        for c, state, lines in _walk(frames):
            if state is not current:
                if current is not None:
                    out.append(row())
                last, current, digest, lines_so_far = c, state, hashlib.sha256(), 0
                if len(out) >= 2000:
                    yield pd.DataFrame(out, columns=["c", *columns])
                    out = []
            for role, text in lines:
                digest.update(f"{chr(10) if lines_so_far else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                lines_so_far += 1
        if current is not None:
            out.append(row())
        yield pd.DataFrame(out, columns=["c", *columns])

    kinds = "c string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    found = map_frames(streamed(rows, edits(symbols, scratch)), run, kinds)
    span = F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = there.groupBy(key_of("conv_id").alias("c")).agg(span.try_cast("long").alias("gaps"))
    ids = turns.select("conv_id").distinct().withColumn("c", key_of("conv_id"))
    report = ids.join(found, "c", "left").join(gaps, "c", "left")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    filled = [F.coalesce(F.col(x), F.lit(empty[x]) if x in empty else F.lit(0).cast("long")).alias(x) for x in ("gaps", *columns)]
    return report.select("conv_id", *filled)
