"""Repair of conversation structure: cheapest edits as shortest paths over scalar weights.

A conversation is its rows by turn (null first; rows of one turn by role, the text's first 32
characters and its hash). A row's first fault counts: blank, duplicate (role and text of an
earlier row), truncated (its last visible character ends no sentence). Keep, Rerole, Delete and
Insert turn the role initials into ``(s?(ua)+)?`` at the least cost; of several cheapest ways
the one whose audit, the initials of its edits in order, comes first in ASCII wins.

Every way through a conversation is a path through four states (nothing yet, after s, after u,
after a), and a row's edge is up to two inserts followed by one of K, R, D. Its weight is one
integer: the cost above, the edge's letters as digits below, in three places that belong to the
row, with zeros after the last letter. Letters of different edges of one row differ before
either ends, so comparing weights compares cost first and audits next, and an ordinary minimum
over sums decides everything. Inserts cost more than nothing, so more than two in a row never
pay, and the digits need no more places.

Rows are range-sorted over all conversations and numbered, so a conversation of any length is
cut into pieces of at most 2 ** ``BITS`` rows, whose 4 x 4 least weights are computed apart. A chain
over a conversation's pieces, last first, sees one narrow row a piece and keeps four states of
each; digits of later pieces never matter, as different ways through a piece have different
letters in it.

Null roles and texts count as one blank. A null conversation id is a conversation of its own;
null turns come first and count in no gap. A role that is empty or starts with another letter
than s, u, a cannot be kept. Rows that are equal in everything are duplicates of their first.
An empty table gives an empty result. Other columns are ignored and may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hemline.llm.common import ship, stage

#: Rows of one piece share their number but for its last bits; a piece has at most 2 ** BITS rows.
BITS = 8
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
ROLES = {"u": "user", "a": "assistant"}
#: States: nothing yet, after s, after u, after a. Letter and next state that each state may add.
NEXT: tuple[dict[str, int], ...] = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
STATES, ENDS = 4, (0, 3)
#: Digits in ASCII order of the letters; 0 pads.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {v: k for k, v in DIGIT.items()}
WIDTH, PLACES = 3, 3


@dataclass(frozen=True)
class Costs:
    """What each edit costs; ``truncated`` comes on top for a truncated row that stays."""

    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def inserted(state: int, costs: Costs) -> Iterator[tuple[int, str, int]]:
    """(cost, letters, next state) of no, one and two inserts of user or assistant."""
    cost, letters = 0, ""
    for _ in range(PLACES):
        yield cost, letters, state
        state = next(NEXT[state][x] for x in "ua" if x in NEXT[state])
        cost, letters = cost + costs.insert, letters + "I"


def digits(letters: str) -> int:
    """The letters' digits, from the first of ``PLACES`` places on."""
    out = 0
    for k in range(PLACES):
        out = out << WIDTH | (DIGIT[letters[k]] if k < len(letters) else 0)
    return out


def edges(initial: str, fault: int, costs: Costs) -> list[dict[int, tuple[int, int]]]:
    """By state: next state -> least (cost, digits) of one row."""
    out = []
    for state in range(STATES):
        best: dict[int, tuple[int, int]] = {}

        def offer(to: int, cost: int, letters: str) -> None:
            best[to] = min(best.get(to, (cost, digits(letters))), (cost, digits(letters)))

        for cost, letters, at in inserted(state, costs):
            offer(at, cost + costs.delete, letters + "D")
            if fault in (BLANK, DUPLICATE):
                continue
            extra = costs.truncated if fault == TRUNCATED else 0
            if initial in NEXT[at]:
                offer(NEXT[at][initial], cost + extra + costs.keep, letters + "K")
            for x in ROLES:
                if x in NEXT[at]:
                    offer(NEXT[at][x], cost + extra + costs.rerole, letters + "R")
        out.append(best)
    return out


class Weights(dict):
    """Edges by (initial, fault), computed once."""

    def __init__(self, costs: Costs):
        self.costs = costs

    def __missing__(self, row: tuple[str, int]) -> list[dict[int, tuple[int, int]]]:
        self[row] = edges(*row, self.costs)
        return self[row]


def piece_weights(rows: list[tuple[str, int]], weights: Weights) -> list[list[int | None]]:
    """Least weight from each state before the rows to each state after them; None where there is no way.

    The cost stands above WIDTH * PLACES * len(rows) bits, the letters of row 0 highest among them.
    """
    step = WIDTH * PLACES
    high = step * len(rows)
    found = [weights[row] for row in rows]
    out = []
    for entry in range(STATES):
        now: list[int | None] = [None] * STATES
        now[entry] = 0
        low = high
        for edge in found:
            low -= step
            new: list[int | None] = [None] * STATES
            for at, weight in enumerate(now):
                if weight is None:
                    continue
                for to, (cost, letters) in edge[at].items():
                    w = weight + (cost << high) + (letters << low)
                    if new[to] is None or w < new[to]:
                        new[to] = w
            now = new
        out.append(now)
    return out


def letters_of(weight: int, n: int) -> list[str]:
    """Each row's letters, read from the digits of a piece's weight."""
    out, mask = [], (1 << WIDTH) - 1
    for row in range(n):
        low = weight >> WIDTH * PLACES * (n - 1 - row)
        found = [low >> WIDTH * (PLACES - 1 - k) & mask for k in range(PLACES)]
        out.append("".join(LETTER[d] for d in found if d))
    return out


def ending(state: int, costs: Costs) -> tuple[int, str]:
    """Cost and letters of the inserts that complete a conversation."""
    return next((cost, letters) for cost, letters, at in inserted(state, costs) if at in ENDS)


def roles_added(state: int, letters: str, initial: str) -> tuple[list[str], str | None, int]:
    """Roles inserted before the row, the row's new role ('' for its own, None for none), next state."""
    before = []
    for letter in letters[:-1]:
        x = next(x for x in "ua" if x in NEXT[state])
        before.append(ROLES[x])
        state = NEXT[state][x]
    if letters[-1] == "D":
        return before, None, state
    if letters[-1] == "K":
        return before, "", NEXT[state][initial]
    x = next(x for x in "ua" if x in NEXT[state])
    return before, ROLES[x], NEXT[state][x]


# --- damage ------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after faults that crc32 of ``conv_id:turn`` chooses.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 takes its ``[.!?]``, 3 repeats it
    with the same turn and 4 makes it the user's. Nulls count as one blank in the key too.
    """
    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    part = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(part == 1, "").when(part == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    role = F.when(part == 4, "user").otherwise(known("role"))
    times = F.when(part == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter(part != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                         F.explode(times).alias("__time")).drop("__time")


# --- rows in order, and their faults -------------------------------------------

def _key(conv_id: Column) -> Column:
    """The id as text that is never null: null ids make one conversation."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def ordered(rows: DataFrame) -> DataFrame:
    """key, conv_id, turn, role, text and ``at``, which numbers the rows by conversation and turn; staged.

    Ranges are cut down to the text's hash and a number, so neither a long conversation nor many
    equal rows fill one task.
    """
    blank = F.lit(" ")
    rows = rows.select(
        _key(F.col("conv_id")).alias("key"), "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    order = ["key", F.asc_nulls_first("turn"), "role", F.substring("text", 1, 32), F.xxhash64("text"), "__n"]
    rows = rows.withColumn("__n", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(dealt.drop("__n").withColumn("at", F.monotonically_increasing_id()), "turns")


def with_faults(rows: DataFrame) -> DataFrame:
    """key, at, turn, initial, fault (0 for none) of the rows that ``ordered`` gave."""
    visible = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    narrow = rows.select("key", "at", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
                         (visible == "").alias("blank"), F.substring(visible, -1, 1).isin(*".!?").alias("ended"))
    same = ["key", "role", "digest"]
    first = narrow.groupBy(*same).agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    fault = F.when(F.col("blank"), BLANK).when(F.col("at") > F.col("first"), DUPLICATE) \
        .when(~F.col("ended"), TRUNCATED).otherwise(0)
    return narrow.join(first, same, "left").select("key", "at", "turn", F.substring("role", 1, 1).alias("initial"),
                                                   fault.alias("fault"))


# --- pieces, chains, edits -------------------------------------------------------

_PIECE_ROWS = ("key string, piece long, start long, n int, initials array<string>, faults array<int>, "
               "weights array<binary>, lo long, hi long, turns long, blank long, duplicate long, truncated long, "
               "illegal long")
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
LEGAL = {"su", "ua", "au"}


def _packed(weight: int | None) -> bytes | None:
    return None if weight is None else weight.to_bytes((weight.bit_length() + 7) // 8, "big")


def pieces(rows: DataFrame, costs: Costs) -> DataFrame:
    """One staged row per piece of a conversation: its rows' codes, least weights and counts."""
    piece = F.shiftright("at", BITS)
    listed = rows.groupBy("key", piece.alias("piece")).agg(  # 2 ** BITS rows at most
        F.array_sort(F.collect_list(F.struct("at", "turn", "initial", "fault"))).alias("r"))
    listed = listed.select("key", "piece", F.col("r.at")[0].alias("start"), F.col("r.initial").alias("initials"),
                           F.col("r.fault").alias("faults"), F.col("r.turn").alias("turn"))
    names = [c.split()[0] for c in _PIECE_ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(costs)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                initials, faults = r["initials"], r["faults"]
                turns = [t for t in r.pop("turn") if t is not None]
                found = piece_weights(list(zip(initials, faults)), weights)
                out.append(r | {
                    "n": len(initials), "weights": [_packed(w) for line in found for w in line],
                    "lo": min(turns, default=None), "hi": max(turns, default=None), "turns": len(set(turns)),
                    "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
                    "truncated": faults.count(TRUNCATED),
                    "illegal": sum(x + y not in LEGAL for x, y in zip(initials, initials[1:]))})
            yield pa.RecordBatch.from_pylist(out, schema=_PIECE_ARROW)

    return stage(listed.mapInArrow(run, _PIECE_ROWS).select(*names), "conversation-pieces")


_PIECE_ARROW = pa.schema([
    ("key", pa.string()), ("piece", pa.int64()), ("start", pa.int64()), ("n", pa.int32()),
    ("initials", pa.list_(pa.string())), ("faults", pa.list_(pa.int32())), ("weights", pa.list_(pa.binary())),
    *[(c, pa.int64()) for c in ("lo", "hi", "turns", *_COUNTS)]])


@dataclass
class Totals:
    """Counts over the pieces seen so far, last first."""

    gaps: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    cost: int = 0


class Chain:
    """One conversation's pieces, last first: least cost to its end from each state, and where each state leads."""

    def __init__(self, costs: Costs):
        self.costs, self.totals = costs, Totals()
        self.after: list[int | None] = [ending(s, costs)[0] for s in range(STATES)]
        self.pieces: list[int] = []
        self.moves = bytearray()
        self.first = self.lo = self.hi = None
        self.turns = 0

    def add(self, r: dict) -> None:
        high = WIDTH * PLACES * r["n"]
        now: list[int | None] = []
        for entry in range(STATES):
            ways = []
            for to, raw in enumerate(r["weights"][entry * STATES:(entry + 1) * STATES]):
                if raw is not None and self.after[to] is not None:
                    ways.append((int.from_bytes(raw, "big") + (self.after[to] << high), to))
            weight, to = min(ways)
            now.append(weight >> high)
            self.moves.append(to)
        self.after = now
        self.pieces.append(r["piece"])
        t = self.totals
        for c in _COUNTS:
            setattr(t, c, getattr(t, c) + r[c])
        if self.first is not None and r["initials"][-1] + self.first not in LEGAL:
            t.illegal += 1
        self.first = r["initials"][0]
        if r["lo"] is not None:  # turns ascend: the piece after this one may start with the same turn
            self.turns += r["turns"] - (self.lo == r["hi"])
            self.hi = r["hi"] if self.hi is None else self.hi
            self.lo = r["lo"]

    def close(self) -> tuple[Totals, list[tuple[int, int, int]]]:
        """The conversation's counts, and each piece with its states before and after, first to last."""
        state, ways = 0, []
        for k in reversed(range(len(self.pieces))):
            to = self.moves[k * STATES + state]
            ways.append((self.pieces[k], state, to))
            state = to
        self.totals.cost = self.after[0]
        self.totals.gaps = self.hi - self.lo + 1 - self.turns if self.turns else 0
        return self.totals, ways


_WAY_ROWS = ("key string, piece long, entry int, leave int, last boolean, first boolean, gaps long, blank long, "
             "duplicate long, truncated long, illegal long, cost long")


def ways(table: DataFrame, costs: Costs) -> DataFrame:
    """Each piece's state before and after it on the cheapest way; the first piece carries the counts. Staged."""
    narrow = table.drop("start", "faults").repartition("key").sortWithinPartitions("key", F.desc("piece"))
    names = [c.split()[0] for c in _WAY_ROWS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _WAY_ROWS.split(", ")])

    def closed(key: str, chain: Chain) -> Iterator[dict]:
        totals, found = chain.close()
        for k, (piece, entry, leave) in enumerate(found):
            row = dict(zip(names, (key, piece, entry, leave, k == len(found) - 1, k == 0)))
            yield row | (dict(zip(names[6:], astuple(totals))) if k == 0 else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chain, out = None, None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["key"] != key:
                    if chain:
                        out += closed(key, chain)
                    key, chain = r["key"], Chain(costs)
                chain.add(r)
            for lo in range(0, len(out), 4096):
                yield pa.RecordBatch.from_pylist(out[lo:lo + 4096], schema=schema)
            out = []
        if chain:
            out = list(closed(key, chain))
            for lo in range(0, len(out), 4096):
                yield pa.RecordBatch.from_pylist(out[lo:lo + 4096], schema=schema)

    return stage(narrow.mapInArrow(run, _WAY_ROWS), "conversation-ways")


def edits(table: DataFrame, found: DataFrame, costs: Costs) -> DataFrame:
    """One row per piece: key, piece, start, audit, and per row its letters, roles inserted before and new role."""
    rows = table.select("key", "piece", "start", "n", "initials", "weights").join(
        found.select("key", "piece", "entry", "leave", "last"), ["key", "piece"])
    schema = ("key string, piece long, start long, audit string, letters array<string>, before array<array<string>>, "
              "role array<string>, after array<string>")
    arrow = pa.schema([("key", pa.string()), ("piece", pa.int64()), ("start", pa.int64()), ("audit", pa.string()),
                       ("letters", pa.list_(pa.string())), ("before", pa.list_(pa.list_(pa.string()))),
                       ("role", pa.list_(pa.string())), ("after", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                weight = int.from_bytes(r["weights"][r["entry"] * STATES + r["leave"]], "big")
                letters, state = letters_of(weight, r["n"]), r["entry"]
                before, role = [], []
                for found, initial in zip(letters, r["initials"]):
                    added, new, state = roles_added(state, found, initial)
                    before.append(added)
                    role.append(new)
                tail = ending(state, costs)[1] if r["last"] else ""
                after = []
                for _ in tail:
                    x = next(x for x in "ua" if x in NEXT[state])
                    after.append(ROLES[x])
                    state = NEXT[state][x]
                out.append({"key": r["key"], "piece": r["piece"], "start": r["start"], "audit": "".join(letters) + tail,
                            "letters": letters, "before": before, "role": role, "after": after})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(run, schema)


@dataclass
class Repair:
    """Tables of a repair.

    rows: key, at, conv_id, turn and ``lines``, the (role, text) that stand in the row's place afterwards.
    report: key, gaps, blank, duplicate, truncated, illegal, cost. audits: key, audit.
    """

    rows: DataFrame
    report: DataFrame
    audits: DataFrame


def repair(conversations: DataFrame, costs: Costs = Costs()) -> Repair:
    """The cheapest repair of conversations with columns conv_id, turn, role, text."""
    if min(astuple(costs)) < 0 or not costs.insert:
        raise ValueError("edits must not cost less than nothing, and inserts must cost something")
    ship(conversations.sparkSession)
    rows = ordered(conversations)
    table = pieces(with_faults(rows), costs)
    found = ways(table, costs)
    changed = stage(edits(table, found, costs), "conversation-edits")
    k = (F.col("at") - F.col("start")).cast("int")

    def empty(roles: Column) -> Column:
        return F.transform(roles, lambda x: F.struct(x.alias("role"), F.lit("").alias("text")))

    nothing = F.array().cast("array<struct<role:string,text:string>>")
    new = F.get("roles", k)
    own = F.struct(F.when(new == "", F.col("role")).otherwise(new).alias("role"), F.col("text").alias("text"))
    placed = rows.withColumn("piece", F.shiftright("at", BITS)).join(
        changed.select("key", "piece", "start", "before", F.col("role").alias("roles"), "after"), ["key", "piece"])
    placed = placed.select("key", "at", "conv_id", "turn", F.concat(
        empty(F.get("before", k)), F.when(new.isNotNull(), F.array(own)).otherwise(nothing),
        F.when(k == F.size("roles") - 1, empty(F.col("after"))).otherwise(nothing)).alias("lines"))
    parts = F.array_sort(F.collect_list(F.struct("piece", "audit")))
    audits = changed.groupBy("key").agg(F.array_join(F.transform(parts, lambda x: x["audit"]), "").alias("audit"))
    report = found.filter("first").select("key", "gaps", *_COUNTS, "cost")
    return Repair(placed, report, audits)


def line_hashes(rows: DataFrame) -> DataFrame:
    """key and the SHA-256 of each conversation's ``role:text`` lines, joined by newlines.

    A hash runs over its lines in order, so a conversation's rows pass through one task, one batch at a time.
    """
    shown = F.array_join(F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    shown = rows.filter(F.size("lines") > 0).select("key", "at", shown.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for mine, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if mine == key:
                    state.update(b"\n")
                else:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = mine, hashlib.sha256()
                state.update(text.encode())
            yield _pairs(done)
        if state is not None:
            yield _pairs([(key, state.hexdigest())])

    return shown.repartition("key").sortWithinPartitions("key", "at").mapInArrow(run, "key string, hash string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], ["key", "hash"])


def repair_report(conversations: DataFrame, damaged: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row per conversation id of ``conversations``: what the repair of ``damaged`` found and did.

    Columns: conv_id, gaps (missing turns between the first and the last), blank, duplicate,
    truncated, illegal (neighbours that may not follow each other), cost, audit, repaired_sha256.
    A conversation without rows has zeros, no edits and the hash of nothing.
    """
    fixed = repair(damaged, costs)
    ids = conversations.select("conv_id").distinct().withColumn("key", _key(F.col("conv_id")))
    joined = ids.join(fixed.report, "key", "left").join(fixed.audits, "key", "left").join(
        line_hashes(fixed.rows), "key", "left")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *_COUNTS, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("hash", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
