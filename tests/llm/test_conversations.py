"""Conversation repair against plain dynamic programming over whole strings."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from clickloom.llm import conversations as c

COLUMNS = "conv_id bigint, turn bigint, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
ROLE = {2: "user", 3: "assistant"}


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())


def fault(rows, i):
    _, role, text = rows[i]
    if not text.strip(BLANKS):
        return 1
    if any(r[1:] == (role, text) for r in rows[:i]):
        return 2
    return 0 if text.strip(BLANKS)[-1] in ".!?" else 3


def plain(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of rows (turn, role, text)."""
    rows = sorted([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows], key=order)
    faults = [fault(rows, i) for i in range(len(rows))]
    none = (10**9, "~", [])

    def inserted(best):
        best = list(best)
        for _ in range(4):
            for s in range(4):
                then = best[NEXT[s]]
                best[s] = min(best[s], (then[0] + 2, "I" + then[1], [ROLE[NEXT[s]] + ":"] + then[2]))
        return best

    best = inserted([(0, "", []), none, none, (0, "", [])])
    for (_, role, text), f in zip(reversed(rows), reversed(faults), strict=True):
        new = []
        for s in range(4):
            options = [(best[s][0] + 3, "D" + best[s][1], best[s][2])]
            if f not in (1, 2):
                x, then = int(f == 3), best[NEXT[s]]
                options.append((then[0] + 2 + x, "R" + then[1], [f"{ROLE[NEXT[s]]}:{text}"] + then[2]))
                to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], s))
                if to:
                    options.append((best[to][0] + x, "K" + best[to][1], [f"{role}:{text}"] + best[to][2]))
            new.append(min(options))
        best = inserted(new)
    cost, audit, lines = best[0]
    turns = [r[0] for r in rows if r[0] is not None]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(k) for k in (1, 2, 3)),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def damaged(conv_id, rows):
    out = []
    for turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = text.translate({ord(x): None for x in ".!?"})
        elif kind == 4:
            role = "user"
        out += [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def conversations(seed, n):
    rng = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "ünter"]
    texts = ["Yes.", "No!", "open", " x? \n", "", " \t", None, "日本。", "a.b"]
    out = {}
    for k in [*range(n), None]:
        size = rng.choice([1, 1, 2, 3, 6, 15])
        turns = [rng.choice([None, *range(12)]) for _ in range(size)]
        if rng.random() < 0.5:
            out[k] = [(t, ["user", "assistant"][i % 2], f"turn {i}.") for i, t in enumerate(range(size))]
        else:
            out[k] = [(t, rng.choice(roles), rng.choice(texts)) for t in turns]
    return out


def table(spark, conversations):
    rows = [(k, *r, "x", 1) for k, v in conversations.items() for r in v]
    return spark.createDataFrame(rows, COLUMNS + ", audit string, part int").repartition(5)


def check(frame, want):
    got = {r.conv_id: tuple(r)[1:] for r in frame.collect()}
    assert got == want


@pytest.fixture(params=["one part", "many parts"])
def layout(spark, request):
    """Ranges merged to one part, or eight parts of which most conversations lie in one and some in several."""
    if request.param == "many parts":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repair_equals_plain_search(spark, layout):
    rows = conversations(1, 150)
    out = c.repair_report(c.repair_conversations(table(spark, rows)))
    check(out, {k: plain(v) for k, v in rows.items()})


def test_a_conversation_in_many_parts(spark, layout):
    rng = random.Random(2)
    rows = conversations(2, 6)
    rows[3] = [(t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["a.", f"b {t}.", "c", ""])) for t in range(800)]
    parts = c.repair_conversations(table(spark, rows))
    assert parts.where("conv_id = 3").count() > 1 or layout == "one part"
    check(c.repair_report(parts), {k: plain(v) for k, v in rows.items()})


def test_damaged_report(spark):
    rows = conversations(3, 120)
    lost = next(k for k in range(1000, 2000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows[lost] = [(0, "user", "All of it is lost.")]
    want = {k: plain(damaged(k, v)) for k, v in rows.items()}
    assert want[lost] == (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    check(c.damaged_report(table(spark, rows)), want)


def test_turns_of_a_repair(spark):
    rows = {1: [(0, "system", "Be kind."), (1, "assistant", "Hello."), (3, "user", "Hi"), (4, "assistant", "")]}
    (row,) = c.repair_conversations(table(spark, rows)).collect()
    assert (row.audit, row.cost, row.whole) == ("KIKDD", 8, True)
    assert [tuple(t) for t in row.turns] == [("system", "Be kind."), ("user", ""), ("assistant", "Hello.")]


def test_least_paths_in_stretches():
    """Any cut of a conversation gives the path of the whole."""
    rng = random.Random(4)
    for _ in range(100):
        n = rng.randint(2, 40)
        initials = np.array([rng.choice("suuaax") for _ in range(n)], object)
        faults = np.array([rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)])
        cost, [(letters, _, _)] = c.repair_paths(initials, faults, np.array([n]), 0, np.array([c.END]))
        cuts = [0, *sorted(rng.sample(range(1, n), min(n - 1, 3))), n]
        spans = [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
        edges = [(5, k, c.transfer(initials[s], faults[s]).ravel().tolist()) for k, s in enumerate(spans)]
        found, state, joined = c.crossings(edges), 0, []
        assert found[5, 0][0][0] == cost[0]
        for k, s in enumerate(spans):
            _, [(part, _, reached)] = c.repair_paths(initials[s], faults[s], np.array([len(faults[s])]), state, np.array([found[5, k][1]]))
            joined += part.tolist()
            state = int(reached[-1])
        assert joined == letters.tolist()


def test_long_texts_and_empty_table(spark):
    rows = {1: [(0, "user", "x" * 70_000 + "."), (1, "assistant", " " * 70_000 + "y"), (2, "user", "\n" * 9)]}
    check(c.repair_report(c.repair_conversations(table(spark, rows))), {k: plain(v) for k, v in rows.items()})
    nothing = spark.createDataFrame([], COLUMNS)
    assert c.damaged_report(nothing).collect() == []
