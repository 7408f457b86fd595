"""Repair of the turn structure of conversations by least-cost edits.

A conversation is well formed if its roles are nothing or ``(system)? (user
assistant)+``. Its rows and the four states of that language span a graph whose
arcs are edits: D deletes a row, I inserts a turn, K keeps a row, R changes its
role. Cost dynamic programming from the end leaves the arcs of cheapest repairs;
ranks of the nodes by the first 1, 2, 4 ... letters of their least audit choose
among these, and doubled pointers lead along the least path.

Spark orders the rows by conversation and turn in ranges of equal size, so a
long conversation lies in several parts. Each part holds at most two
conversations that go on in another part; for these the part is first reduced
to a 4 x 4 matrix of least costs between states, which compose.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import batch, durable

#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or renamed turn leads to, and its role.
NEXT = np.array([USER, USER, ASSISTANT, USER])
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, RENAME, TRUNCATED = 3, 2, 2, 1
NEVER = 1 << 50
#: Costs left at the end of a conversation.
END = np.array([0, NEVER, NEVER, 0])
#: Rows of whole conversations that are repaired together.
ROWS = 20_000
#: Faults of a row.
SOUND, BLANK, DUPLICATE, CUT = range(4)
SPACES = " \t\n\v\f\r"

LETTERS = np.array([ord(c) for c in "DIKR"], np.uint8)
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
PART = [
    ("conv_id", pa.int64()), ("part", pa.int32()), ("whole", pa.bool_()),
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("n_turns", pa.int64()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()),
    ("cost", pa.int64()), ("audit", pa.string()), ("turns", TURNS),
]
PART_DDL = (
    "conv_id bigint, part int, whole boolean, first_turn bigint, last_turn bigint, n_turns bigint, blank bigint, "
    "duplicate bigint, truncated bigint, illegal bigint, first_initial string, last_initial string, cost bigint, "
    "audit string, turns array<struct<role:string,text:string>>"
)


# ------------------------------------------------------------------ costs and paths


def _insertions(costs: np.ndarray) -> np.ndarray:
    """Costs to the end of states (last axis) when turns may be inserted first."""
    out = costs.copy()
    out[..., USER] = np.minimum(costs[..., USER], INSERT + costs[..., ASSISTANT])
    for state in (ASSISTANT, START, SYSTEM):
        out[..., state] = np.minimum(costs[..., state], INSERT + out[..., NEXT[state]])
    return out


def row_arcs(initials: np.ndarray, faults: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``cost, target`` by row, state and edit D, K, R; edits that are not allowed cost ``NEVER``."""
    n = len(initials)
    cost, target = np.full((n, 4, 3), NEVER), np.zeros((n, 4, 3), np.int64)
    cost[:, :, 0], target[:, :, 0] = DELETE, np.arange(4)
    stays = (faults != BLANK) & (faults != DUPLICATE)
    extra = np.where(faults == CUT, TRUNCATED, 0)
    cost[:, :, 2], target[:, :, 2] = np.where(stays, RENAME + extra, NEVER)[:, None], NEXT
    keeps = [(START, "s", SYSTEM), (USER, "a", ASSISTANT), *((s, "u", USER) for s in (START, SYSTEM, ASSISTANT))]
    for state, initial, to in keeps:
        own = stays & (initials == initial)
        cost[own, state, 1], target[own, state, 1] = extra[own], to
    return cost, target


def transfer(initials: np.ndarray, faults: np.ndarray) -> np.ndarray:
    """Least costs from every state before the rows to every state after them, as a 4 x 4 matrix."""
    unit = np.where(np.eye(4, dtype=bool), 0, NEVER)  # [state after, state before]
    now = unit
    cost, target = row_arcs(initials, faults)
    for k in range(len(initials) - 1, -1, -1):
        now = _insertions((now[:, target[k]] + cost[k]).min(axis=2))
    return np.minimum(now, NEVER).T


def _doubled(pointer: np.ndarray) -> list[np.ndarray]:
    """Where 1, 2, 4 ... steps along ``pointer`` lead, until no node moves any further."""
    steps = [pointer]
    while not (steps[-1][steps[-1]] == steps[-1]).all():
        steps.append(steps[-1][steps[-1]])
    return steps


def repair_paths(
    initials: np.ndarray, faults: np.ndarray, sizes: np.ndarray, entry: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Costs, and ``letter, row, state reached`` along the least cheapest path, of stretches of rows.

    ``sizes`` are the rows of each stretch, ``entry`` the state before it and
    ``ends`` the costs from the states after it, ``END`` where the conversation
    ends. Insertions after the last row belong to the stretch only at ``END``.
    """
    n, m = len(initials), len(sizes)
    # nodes: state k of place p is 4 * p + k; a stretch has a place before each row and one after the last
    first = np.cumsum(sizes + 1) - sizes - 1
    last = first + sizes
    place = np.arange(n) + np.repeat(np.arange(m), sizes)
    cost, target = row_arcs(initials, faults)
    final = (ends == END).all(axis=1)
    left = np.empty((n + m, 4), np.int64)
    left[last] = np.where(final[:, None], _insertions(ends), ends)
    order = np.argsort(-sizes, kind="stable")
    for back in range(1, int(sizes.max(initial=0)) + 1):
        own = order[: np.searchsorted(-sizes[order], -back, side="right")]
        row = last[own] - back
        k = row - own
        after = left[row + 1]
        through = after[np.arange(len(own))[:, None, None], target[k]] + cost[k]
        left[row] = _insertions(through.min(axis=2))
    # arcs of cheapest repairs, by node and letter
    nodes = 4 * (n + m)
    arcs = np.full((nodes, 4), -1)
    wanted = left.ravel()
    at = place[:, None] * 4 + np.arange(4)
    for letter, edit in ((0, 0), (2, 1), (3, 2)):
        to = 4 * (place[:, None] + 1) + target[:, :, edit]
        good = (cost[:, :, edit] < NEVER) & (wanted[to] + cost[:, :, edit] == wanted[at]) & (wanted[at] < NEVER)
        arcs[at[good], letter] = to[good]
    own = np.arange(nodes)
    to = own - own % 4 + NEXT[own % 4]
    inserts = (wanted[to] + INSERT == wanted) & (wanted < NEVER)
    stops = np.zeros(nodes, bool)  # the end of a stretch
    closing = (4 * last[:, None] + np.arange(4)).ravel()
    stops[closing] = np.where(final[:, None], ends == 0, True).ravel()
    inserts[closing[~np.repeat(final, 4)]] = False
    arcs[inserts & ~stops, 1] = to[inserts & ~stops]
    # ranks by one letter, two, four ...; each node leads on by its least arc
    has = arcs >= 0
    letter = np.where(has.any(axis=1), has.argmax(axis=1), -1)
    rank, length = letter + 1, (letter >= 0).astype(np.int64)
    for step in _doubled(np.where(letter >= 0, arcs[own, letter], own)):
        pairs = rank * (int(rank.max(initial=0)) + 1) + rank[step]
        rank, length = np.unique(pairs, return_inverse=True)[1], length + length[step]
    # the least arc of a node by its letter and the rank of what follows
    least = np.where(has, np.arange(4) * (len(rank) + 1) + rank[np.maximum(arcs, 0)], NEVER).argmin(axis=1)
    pointer = np.where(letter >= 0, arcs[own, least], own)
    path = 4 * first + entry
    for step in reversed(_doubled(pointer)):
        path = np.unique(np.concatenate([path, step[path]]))
    path = path[letter[path] >= 0]
    owner = np.searchsorted(first, path // 4, side="right") - 1
    path = path[np.lexsort((-length[path], owner))]
    bounds = np.searchsorted(np.sort(owner), np.arange(m + 1))
    parts = []
    for k in range(m):
        mine = path[bounds[k] : bounds[k + 1]]
        parts.append((least[mine], mine // 4 - first[k], pointer[mine] % 4))
    return wanted[4 * first + entry], parts


# ------------------------------------------------------------------------- the rows


def ordered_rows(conversations: DataFrame) -> DataFrame:
    """Rows in ranges by conversation and turn, with ``part``, their faults and the initial of the role.

    A row that has the role and text of a row with an earlier turn is marked by
    ``_later``; those are found by counting, so a text that fills a
    conversation is combined before it is shuffled.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    key = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = rows.withColumn("_key", F.unhex(key)).withColumn("_conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    again = rows.groupBy("_conv", "_key").agg(
        F.count("*").alias("_n"), F.min("turn").alias("_turn"), F.count_if(F.col("turn").isNull()).alias("_null")
    )
    again = again.where("_n > 1").select("_conv", "_key", "_turn", F.col("_null") > 0)
    again = again.toDF("_conv", "_key", "_turn", "_null")
    rows = rows.join(again, ["_conv", "_key"], "left")
    later = F.coalesce(F.col("turn").isNotNull() & (F.col("_null") | (F.col("turn") > F.col("_turn"))), F.lit(False))
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = F.when(end == "", BLANK).when(later, DUPLICATE).when(~end.isin(".", "!", "?"), CUT).otherwise(SOUND)
    rows = rows.select(
        "_conv", "conv_id", "turn", "_key", F.left("role", F.lit(1)).alias("initial"), fault.cast("int").alias("fault"), "role", "text"
    )
    order = ["_conv", F.asc_nulls_first("turn"), "_key"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return durable(rows.withColumn("part", F.spark_partition_id())).drop("_conv")


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one conversation after the other, in this part."""
    held: list[pa.RecordBatch] = []
    for got in batches:
        ids = got.column("conv_id")
        known, values = ~ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]) | (known[1:] != known[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, got.num_rows], strict=True):
            if b > a:
                piece = got.slice(a, b - a)
                if held and held[0].column("conv_id")[0] != piece.column("conv_id")[0]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(piece)
    if held:
        yield pa.Table.from_batches(held)


def _faults(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Initials and faults; a row equal to the one before it is a duplicate too."""
    initials, faults = np.array(table["initial"].to_pylist(), object), table["fault"].to_numpy().copy()
    turns, keys = table["turn"].to_pylist(), table["_key"].to_pylist()
    same = np.array([False, *(a == b and x == y for a, b, x, y in zip(turns, turns[1:], keys, keys[1:], strict=False))])
    faults[same & (faults != BLANK)] = DUPLICATE
    return initials, faults


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last conversation of a part as matrices."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("matrix", pa.list_(pa.int64()))])

    for table in _firsts_and_lasts(batches):
        matrix = transfer(*_faults(table)).ravel().tolist()
        yield batch(schema, table["conv_id"][:1].to_pylist(), table["part"][:1].to_pylist(), [matrix])


def crossings(edges: list[tuple[int | None, int, list[int]]]) -> dict[tuple[int | None, int], tuple[list[int], list[int]]]:
    """Per conversation that lies in several parts, and part: costs from each state before it, and after it.

    ``edges`` are ``conv_id, part, matrix``, two for each part at most.
    """
    chains: dict[int | None, list[tuple[int, np.ndarray]]] = {}
    for conv_id, part, matrix in sorted(edges, key=lambda e: e[1]):
        chains.setdefault(conv_id, []).append((part, np.array(matrix).reshape(4, 4)))
    found = {}
    for conv_id, chain in chains.items():
        if len(chain) > 1:
            after = END
            for k, (part, matrix) in enumerate(reversed(chain)):
                before = np.minimum((matrix + (_insertions(after) if k == 0 else after)).min(axis=1), NEVER)
                found[conv_id, part] = (before.tolist(), after.tolist())
                after = before
    return found


def _firsts_and_lasts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    last = None
    for k, table in enumerate(_stretches(batches)):
        if k == 0:
            yield table
        else:
            last = table
    if last is not None:
        yield last


def _exits(crossing) -> object:
    """The state after the rows of a crossing stretch, for each state before them."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("states", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _firsts_and_lasts(batches):
            own = (table["conv_id"][0].as_py(), table["part"][0].as_py())
            if own in crossing.value:
                initials, faults = _faults(table)
                after, states = np.array([crossing.value[own]]), []
                for state in range(4):
                    _, [(_, _, reached)] = repair_paths(initials, faults, np.array([len(faults)]), state, after)
                    states.append(int(reached[-1]))
                yield batch(schema, [own[0]], [own[1]], [states])

    return run


def _part_rows(tables: list[pa.Table], entry: np.ndarray, ends: np.ndarray, whole: bool) -> pa.RecordBatch:
    known = [_faults(t) for t in tables]
    initials, faults = (np.concatenate([k[i] for k in known]) for i in (0, 1))
    sizes = np.array([len(t) for t in tables])
    costs, paths = repair_paths(initials, faults, sizes, entry, ends)
    rows = []
    for table, (own, fault), cost, (letters, place, reached) in zip(tables, known, costs, paths, strict=True):
        roles, texts = table["role"].to_pylist(), table["text"].to_pylist()
        repaired = []
        for letter, row, state in zip(letters.tolist(), place.tolist(), reached.tolist(), strict=True):
            if letter == 1:
                repaired.append({"role": ROLE[state], "text": ""})
            elif letter:
                repaired.append({"role": roles[row] if letter == 2 else ROLE[state], "text": texts[row]})
        turns = [t for t in table["turn"].to_pylist() if t is not None]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        rows.append((
            table["conv_id"][0].as_py(), table["part"][0].as_py(), whole,
            turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)),
            *(int((fault == f).sum()) for f in (BLANK, DUPLICATE, CUT)),
            illegal, own[0], own[-1], int(cost), LETTERS[letters].tobytes().decode(), repaired,
        ))
    return batch(pa.schema(PART), *zip(*rows, strict=True))


def _repaired(crossing, entries) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, volume = [], 0
        for table in _stretches(batches):
            own = (table["conv_id"][0].as_py(), table["part"][0].as_py())
            if own in crossing.value:
                yield _part_rows([table], entries.value[own], np.array([crossing.value[own]]), False)
                continue
            held.append(table)
            volume += len(table)
            if volume >= ROWS:
                yield _part_rows(held, START, np.tile(END, (len(held), 1)), True)
                held, volume = [], 0
        if held:
            yield _part_rows(held, START, np.tile(END, (len(held), 1)), True)

    return run


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """The repaired turns and faults of every conversation, a row for each part of it.

    Columns: ``conv_id, part, whole`` (no other part follows or precedes),
    ``first_turn, last_turn, n_turns`` (distinct), the faults ``blank,
    duplicate, truncated, illegal``, the initials of the first and last role,
    ``cost`` from this part on, ``audit`` and ``turns`` (role and text).

    Rows of ``conversations(conv_id, turn, role, text)`` are taken by turn, NULL
    first, ties by a hash of role and text; a NULL role or text is one space. A
    row is blank without a character other than ASCII white space, else a
    duplicate if its role and text came before, else truncated unless its last
    such character is one of ``.!?``. Blank and duplicate rows are deleted. NULL
    is a conversation of its own; repeated rows are duplicates; other columns
    are not read; an empty table gives no rows.

    A part holds the rows that Spark's ranges give it. What the driver gathers
    is two matrices of 16 numbers for each part.
    """
    rows = ordered_rows(conversations)
    context = rows.sparkSession.sparkContext
    slim = rows.select("conv_id", "turn", "_key", "initial", "fault", "part")
    edges = slim.mapInArrow(_edges, "conv_id bigint, part int, matrix array<bigint>").collect()
    found = crossings([tuple(e) for e in edges])
    crossing = context.broadcast({own: after for own, (_, after) in found.items()})
    entries = {}
    if found:
        exits = slim.mapInArrow(_exits(crossing), "conv_id bigint, part int, states array<bigint>").collect()
        state: dict[int | None, int] = {}
        for conv_id, part, states in sorted(map(tuple, exits), key=lambda e: e[1]):
            entries[conv_id, part] = state.get(conv_id, START)
            state[conv_id] = states[entries[conv_id, part]]
    return rows.mapInArrow(_repaired(crossing, context.broadcast(entries)), PART_DDL)


# ----------------------------------------------------------------------- the report


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from their parts in order; the text streams through the digest."""
    schema = pa.schema([(c, pa.int64()) for c in COUNTS] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
    now = None

    def done() -> pa.RecordBatch:
        span = now["last"] - now["first"] + 1 - now["n"] if now["n"] else 0
        counts = [now["conv_id"], span, *(now[c] for c in COUNTS[2:])]
        return batch(schema, *([c] for c in counts), ["".join(now["audit"])], [now["digest"].hexdigest()])

    for got in batches:
        for row in got.to_pylist():
            if now is None or now["conv_id"] != row["conv_id"]:
                if now is not None:
                    yield done()
                now = {c: 0 for c in COUNTS} | {
                    "conv_id": row["conv_id"], "cost": row["cost"], "first": None, "last": None, "n": 0,
                    "initial": None, "audit": [], "digest": hashlib.sha256(), "lines": 0,
                }
            for c in ("blank", "duplicate", "truncated", "illegal"):
                now[c] += row[c]
            if now["initial"] is not None:
                now["illegal"] += now["initial"] + row["first_initial"] not in ("su", "ua", "au")
            now["initial"] = row["last_initial"]
            if row["n_turns"]:
                now["n"] += row["n_turns"] - (now["last"] == row["first_turn"])
                now["first"] = row["first_turn"] if now["first"] is None else now["first"]
                now["last"] = row["last_turn"]
            now["audit"].append(row["audit"])
            for turn in row["turns"]:
                line = f"{turn['role']}:{turn['text']}"
                now["digest"].update(("\n" * (now["lines"] > 0) + line).encode())
                now["lines"] += 1
    if now is not None:
        yield done()


COUNTS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_report(parts: DataFrame) -> DataFrame:
    """One row a conversation: gaps between turns, faults, cost, audit and the digest of ``role:text`` lines.

    A conversation in one part is read where it is; only the others are shuffled.
    """
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0)).cast("bigint")
    kept = durable(parts)
    whole = kept.where("whole").select(
        "conv_id", gaps.alias("gaps"), *COUNTS[2:], "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256")
    )
    others = kept.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    ddl = ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"
    return whole.unionByName(others.mapInArrow(_joined, ddl))


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with one fault for a quarter of the rows, by checksum of ``conv_id:turn``.

    Of 20 remainders, 0 drops the row, 1 empties its text, 2 takes out ``.!?``,
    3 repeats the row and 4 makes its role user. A NULL is one space.
    """
    space = F.lit(" ")
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), space) if c else F.lit(":") for c in ("conv_id", "", "turn")))
    kind = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = conversations.where(kind != 0).select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_copy"),
    )
    return rows.drop("_copy")


def damaged_report(conversations: DataFrame) -> DataFrame:
    """``repair_report`` of the damaged conversations, with those that lost all rows."""
    report = repair_report(repair_conversations(damage(conversations))).withColumnRenamed("conv_id", "_conv")
    ids = conversations.select(F.col("conv_id").cast("bigint")).distinct()
    rows = ids.join(report, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    zero = (F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTS[1:])
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return rows.select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256")
    )
