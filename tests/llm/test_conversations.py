"""Conversation repair against every possible way of editing."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from hemline.llm import conversations

WHITE = " \t\n\x0b\x0c\r"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ROLES = ("user", "assistant")


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 1:
            text = ""
        elif k == 2:
            text = re.sub("[.!?]", "", text)
        elif k == 4:
            role = "user"
        mine += [(turn, role, text)] * {0: 0, 3: 2}.get(k, 1)
    return {c: sorted(r, key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2])) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        visible = text.rstrip(WHITE)
        out.append(1 if not visible else 2 if (role, text) in seen else 3 if visible[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def cheapest(rows, found, costs=(0, 1, 2, 5, 5), inserts=3):
    """Least (cost, audit, lines) over all ways with at most so many inserts."""
    keep, rerole, delete, insert, extra = costs
    best = [(10 ** 9, "", ())]

    def go(i, state, cost, audit, lines, left):
        if cost > best[0][0]:
            return
        if i == len(rows) and state in (0, 3):
            best[0] = min(best[0], (cost, audit, lines))
        if left:
            for role in ROLES:
                if role[0] in NEXT[state]:
                    go(i, NEXT[state][role[0]], cost + insert, audit + "I", lines + ((role, ""),), left - 1)
        if i == len(rows):
            return
        _, own, text = rows[i]
        go(i + 1, state, cost + delete, audit + "D", lines, left)
        if found[i] in (1, 2):
            return
        more = extra if found[i] == 3 else 0
        if own[:1] in NEXT[state]:
            go(i + 1, NEXT[state][own[:1]], cost + keep + more, audit + "K", lines + ((own, text),), left)
        for role in ROLES:
            if role[0] in NEXT[state]:
                go(i + 1, NEXT[state][role[0]], cost + rerole + more, audit + "R", lines + ((role, text),), left)

    go(0, 0, 0, "", (), inserts)
    return best[0]


def expected(conv, rows, costs=(0, 1, 2, 5, 5)):
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest(rows, found, costs) if rows else (0, "", ())
    shown = "\n".join(f"{r}:{t}" for r, t in lines)
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[found.count(k) for k in (1, 2, 3)],
            illegal, cost, audit, hashlib.sha256(shown.encode()).hexdigest())


def sample(n, longest, seed):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "Üser"]
    texts = ["Hi.", "Yes!", "no end", "", " \t\n", None, "Long text? ", "ok.", "end. ", "ends  ", "é" * 40 + "?"]
    return [(c or None, None if pick.random() < .05 else pick.choice([t, t, t + pick.randint(0, 2)]), pick.choice(roles),
             pick.choice(texts)) for c in range(n) for t in range(pick.randint(1, longest))]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("bits", [8, 1])
def test_repair(spark, monkeypatch, bits):
    monkeypatch.setattr(conversations, "BITS", bits)
    rows = sample(250, 5, bits)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).select(
        "*", *[F.lit("x").alias(c) for c in ("key", "at", "piece", "fault", "lines", "n")])
    got = conversations.repair_report(df, conversations.damage(df)).collect()
    want = {expected(c, r) for c, r in damaged(rows).items()}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_other_costs_use_every_edit(spark):
    """Dear deletions and reroles make inserts pay."""
    costs = conversations.Costs(keep=0, rerole=4, delete=9, insert=2, truncated=1)
    rows = [(c, t, r, f"{c} {t}.") for c in range(40) for t, r in enumerate(random.Random(c).choices(
        ["user", "assistant", "system"], k=random.Random(c).randint(1, 4)))]
    fixed = conversations.repair(spark.createDataFrame(rows, SCHEMA), costs)
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(f"={conv}", []).append((turn, role, text))
    want = {c: cheapest(r, faults(r), (0, 4, 9, 2, 1), 9) for c, r in by.items()}
    audits = {r.key: r.audit for r in fixed.audits.collect()}
    lines = {c: [] for c in by}
    for r in fixed.rows.orderBy("at").collect():
        lines[r.key] += [(x.role, x.text) for x in r.lines]
    assert {x for w in want.values() for x in w[1]} >= set("IKR")
    assert audits == {c: w[1] for c, w in want.items()}
    assert {c: tuple(x) for c, x in lines.items()} == {c: w[2] for c, w in want.items()}
    assert {r.key: r.cost for r in fixed.report.collect()} == {c: w[0] for c, w in want.items()}


def test_one_long_conversation(spark, monkeypatch):
    """A conversation over many pieces and partitions: legal, cheapest by a plain table of (cost, audit)."""
    monkeypatch.setattr(conversations, "BITS", 3)
    pick = random.Random(5)
    rows = [(7, t, pick.choice(["user", "assistant", "user", "system"]), pick.choice(["a.", f"b {t}.", f"c {t}", f"d {t}!"]))
            for t in range(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = conversations.repair_report(df, conversations.damage(df)).collect()
    mine = damaged(rows)[7]
    table = {0: (0, "")}  # letters of a row end in D, K or R, so shorter prefixes never tie
    for (_, role, _), fault in zip(mine, faults(mine)):
        new = {}
        for state, (cost, audit) in table.items():
            for k in range(3):
                at, c, a = state, cost + 5 * k, audit + "I" * k
                for _ in range(k):
                    at = NEXT[at]["u" if "u" in NEXT[at] else "a"]
                offers = [(at, c + 2, a + "D")]
                if fault in (0, 3):
                    more = 5 if fault else 0
                    if role[0] in NEXT[at]:
                        offers.append((NEXT[at][role[0]], c + more, a + "K"))
                    offers += [(to, c + more + 1, a + "R") for x, to in NEXT[at].items() if x != "s"]
                for to, *way in offers:
                    new[to] = min(new.get(to, tuple(way)), tuple(way))
        table = new
    cost, audit = min((c + {0: 0, 1: 10, 2: 5, 3: 0}[s], a + {0: "", 1: "II", 2: "I", 3: ""}[s])
                      for s, (c, a) in table.items())
    assert [(r.cost, r.audit) for r in got] == [(cost, audit)]
    assert (got[0].blank, got[0].duplicate, got[0].truncated) == tuple(faults(mine).count(k) for k in (1, 2, 3))
    assert got[0].gaps == expected_gaps(mine)


def expected_gaps(rows):
    turns = {t for t, _, _ in rows}
    return max(turns) - min(turns) + 1 - len(turns)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversations.repair_report(none, conversations.damage(none)).collect() == []
    gone = next(t for t in range(1000) if zlib.crc32(f"3:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(3, gone, "user", "Hi.")], SCHEMA)
    assert [tuple(r) for r in conversations.repair_report(df, conversations.damage(df)).collect()] == [expected(3, [])]


def test_weights_are_compared_as_integers():
    """Equal costs fall to the audit: D before K before R."""
    found = conversations.piece_weights([("u", 0)], conversations.Weights(conversations.Costs(rerole=0, delete=0)))
    assert conversations.letters_of(found[0][2], 1) == ["K"] and conversations.letters_of(found[0][0], 1) == ["D"]
