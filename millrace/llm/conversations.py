"""Repair of conversation structure by a square-root checkpointed dynamic program.

A repaired conversation has the role initials ``(s?(ua)+)?``. Its states: 0 nothing yet, 1 after
``s``, 2 after ``u``, 3 after ``a``; it may end in 0 and 3. Costs of what is left of a conversation, by
state, follow from the costs after the next row (:func:`_before`); they are kept at every
square-root-th row only and worked out again between two of these while walking forward.

Conversations are cut into blocks of rows. What a block does to the costs behind it is a 4 x 4
table in the (min, +) algebra, and where it leads from each state is four numbers, so a
conversation of many blocks is solved block by block in parallel, with only these small rows put in
order by conversation.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import shuffle_width, staged

BLOCK_ROWS, BLOCK_BYTES = 1024, 4 << 20
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
INF = 1 << 60
STATES = range(4)
# Where a role initial leads from each state; the role that is missing next; and its state.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = ("user", "user", "assistant", "user")
NEXT = (2, 2, 3, 2)
END = (0, 2 * INSERT, INSERT, 0)
CLEAN, CUT, GONE = 0, 1, 2  # a row may stay; may stay at a price; has to go
FAULTS = ("blank", "duplicate", "truncated")
BLOCKS = (
    "conv long, no_conv boolean, part int, seq long, whole boolean, "
    "turns array<long>, roles array<string>, texts array<string>"
)
COUNTS = "rows long, blank long, duplicate long, truncated long, illegal long, distinct_turns long, first_turn long, last_turn long"
REPAIRED = (
    f"conv long, no_conv boolean, part int, seq long, whole boolean, {COUNTS}, "
    "first_role string, last_role string, cost long, edits string, repaired array<struct<role:string,text:string>>"
)
KEY = ("conv", "no_conv")
AT = (*KEY, "part", "seq")


def _before(after: tuple, initial: str, state: int) -> list[int]:
    """Costs ahead of a row by state, from those behind it."""
    now = [cost + DELETE for cost in after]
    if state != GONE:
        extra = TRUNCATED if state == CUT else 0
        for s in STATES:
            kept = STEP[s].get(initial)
            if kept is not None:
                now[s] = min(now[s], after[kept] + extra)
            now[s] = min(now[s], after[NEXT[s]] + REROLE + extra)
    return _with_inserts(now)


def _with_inserts(now: list[int]) -> list[int]:
    two, three = now[2], now[3]
    now[2], now[3] = min(two, three + INSERT), min(three, two + INSERT)
    now[0], now[1] = min(now[0], now[2] + INSERT), min(now[1], now[2] + INSERT)
    return now


def _walk(rows: list[tuple[str, int]], behind: tuple, state: int, last: bool) -> tuple[str, int, list[int]]:
    """Cheapest edits of ``rows`` from ``state``, the ASCII-least of them; the state they lead to.

    ``behind`` are the costs after the last row. Also gives, per edit, the state before it.
    """
    width = math.isqrt(max(1, len(rows) - 1)) + 1
    marks, costs = {}, list(behind)
    for i in range(len(rows), 0, -1):
        if i % width == 0 or i == len(rows):
            marks[i] = costs
        costs = _before(costs, *rows[i - 1])
    edits, states = [], []
    for start in range(0, len(rows), width):
        end = min(start + width, len(rows))
        table = [marks[end]]
        for i in range(end, start, -1):
            table.append(_before(table[-1], *rows[i - 1]))
        table.reverse()
        for i in range(start, end):
            here, after = table[i - start], table[i - start + 1]
            initial, fault = rows[i]
            while True:
                states.append(state)
                if after[state] + DELETE == here[state]:
                    edits.append("D")
                    break
                if here[NEXT[state]] + INSERT == here[state]:
                    edits.append("I")
                    state = NEXT[state]
                    continue
                kept = STEP[state].get(initial)
                extra = TRUNCATED if fault == CUT else 0
                if kept is not None and after[kept] + extra == here[state]:
                    edits.append("K")
                    state = kept
                else:
                    edits.append("R")
                    state = NEXT[state]
                break
    while last and state not in (0, 3):
        states.append(state)
        edits.append("I")
        state = NEXT[state]
    return "".join(edits), state, states


def _fault(role: str, text: str, seen: bool) -> int | None:
    """Index of a row's first fault in ``FAULTS``."""
    kept = text.rstrip(" \t\n\x0b\x0c\r")
    if not kept:
        return 0
    if seen:
        return 1
    return 2 if kept[-1] not in ".!?" else None


def _coded(roles: list[str], faults: list[int | None]) -> list[tuple[str, int]]:
    return [(r[:1], CLEAN if f is None else CUT if f == 2 else GONE) for r, f in zip(roles, faults, strict=True)]


def _faults(roles: list[str], texts: list[str], seen_before: list[int]) -> list[int | None]:
    """First faults of a block's rows; ``seen_before`` are the rows that earlier blocks hold too."""
    known, seen, found = set(seen_before), set(), []
    for i, (role, text) in enumerate(zip(roles, texts, strict=True)):
        found.append(_fault(role, text, i in known or (role, text) in seen))
        seen.add((role, text))
    return found


def _solved(block: dict, behind: tuple, state: int, last: bool, seen: list[int]) -> dict:
    """The row of ``REPAIRED`` of a block."""
    turns, roles, texts = block["turns"], block["roles"], block["texts"]
    faults = _faults(roles, texts, seen)
    coded = _coded(roles, faults)
    edits, _, states = _walk(coded, behind, state, last)
    repaired, cost, i = [], 0, 0
    for edit, at in zip(edits, states, strict=True):
        if edit == "I":
            repaired.append({"role": WANTED[at], "text": ""})
            cost += INSERT
            continue
        if edit == "D":
            cost += DELETE
        else:
            repaired.append({"role": roles[i] if edit == "K" else WANTED[at], "text": texts[i]})
            cost += (REROLE if edit == "R" else 0) + (TRUNCATED if faults[i] == 2 else 0)
        i += 1
    numbered = [t for t in turns if t is not None]
    return {
        **{k: block[k] for k in (*AT, "whole")},
        "rows": len(roles),
        **{name: faults.count(k) for k, name in enumerate(FAULTS)},
        "illegal": sum(not _legal(a, b) for a, b in zip(roles, roles[1:])),
        "distinct_turns": len(set(numbered)),
        "first_turn": numbered[0] if numbered else None, "last_turn": numbered[-1] if numbered else None,
        "first_role": roles[0], "last_role": roles[-1], "cost": cost, "edits": edits, "repaired": repaired,
    }


def _legal(one: str, two: str) -> bool:
    return one[:1] + two[:1] in ("su", "ua", "au")


def _as_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from batch.slice(at, 256).to_pylist()


def _cut(schema: pa.Schema, block_rows: int = BLOCK_ROWS):
    """Sorted rows to blocks. A conversation is whole if it fits a block and others lie on both sides of it."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, seq, size, now, first = TaskContext.get().partitionId(), 0, 0, None, True
        for row in _rows(batches):
            key = (row["conv"], row["no_conv"])
            new = now is None or key != (now["conv"], now["no_conv"])
            if new or len(now["roles"]) >= block_rows or size >= BLOCK_BYTES:
                if now is not None:
                    now["whole"] = new and not first and now["whole"]
                    yield now
                    first = first and not new
                now = {"conv": key[0], "no_conv": key[1], "part": part, "seq": seq, "whole": new, "turns": [], "roles": [], "texts": []}
                seq, size = seq + 1, 0
            now["turns"].append(row["turn"])
            now["roles"].append(row["role"])
            now["texts"].append(row["text"])
            size += len(row["text"]) + len(row["role"])
        if now is not None:
            now["whole"] = False
            yield now

    return lambda batches: _as_batches(blocks(batches), schema)


def _solve_whole(schema: pa.Schema):
    return lambda batches: _as_batches((_solved(b, END, 0, True, []) for b in _rows(batches)), schema)


def _tables(schema: pa.Schema):
    """Per block, the least cost from each state before it to each state behind it, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for block in _rows(batches):
            coded = _coded(block["roles"], _faults(block["roles"], block["texts"], block["seen"] or []))
            columns = []
            for t in STATES:
                costs = [0 if s == t else INF for s in STATES]
                for row in reversed(coded):
                    costs = _before(costs, *row)
                columns.append(costs)
            yield {
                **{k: block[k] for k in AT}, "seen": block["seen"] or [],
                "codes": [initial + str(fault) for initial, fault in coded],
                "costs": [columns[t][s] for s in STATES for t in STATES],
            }

    return lambda batches: _as_batches(run(batches), schema)


def _behind(schema: pa.Schema):
    """Blocks of a conversation from the last to the first: the costs behind each, and where it leads from each state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, costs = None, END
        for block in _rows(batches):
            key, last = (block["conv"], block["no_conv"]), False
            if key != now:
                now, costs, last = key, END, True
            coded = [(c[:-1], int(c[-1])) for c in block["codes"]]
            exits = [_walk(coded, costs, s, last)[1] for s in STATES]
            yield {**{k: block[k] for k in AT}, "seen": block["seen"], "behind": list(costs), "exits": exits, "last": last}
            table = block["costs"]
            costs = _with_inserts([min(table[4 * s + t] + costs[t] for t in STATES) for s in STATES])

    return lambda batches: _as_batches(run(batches), schema)


def _entered(schema: pa.Schema):
    """Blocks of a conversation in order: the state each is entered in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, state = None, 0
        for block in _rows(batches):
            key = (block["conv"], block["no_conv"])
            if key != now:
                now, state = key, 0
            yield {**{k: block[k] for k in (*AT, "seen", "behind", "last")}, "state": state}
            state = block["exits"][state]

    return lambda batches: _as_batches(run(batches), schema)


def _solve_parts(schema: pa.Schema):
    return lambda batches: _as_batches(
        (_solved(b, tuple(b["behind"]), b["state"], b["last"], b["seen"]) for b in _rows(batches)), schema
    )


def _mapped(frame: DataFrame, make, schema: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return frame.mapInArrow(make(to_arrow_schema(StructType.fromDDL(schema))), schema)


def repair_blocks(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Repaired conversations, one row per block of turns: counts of faults, edits, repaired turns.

    Rows are taken by turn (null first), then role and text, so that equal rows are neighbours. A
    row's first fault counts: blank, duplicate (role and text stand earlier in the conversation),
    truncated (the last character that is not white space is none of ``.!?``). Edits: K(eep),
    R(erole), D(elete; blank and duplicate rows have to go) and I(nsert), with the costs set above; of the
    cheapest ones the ASCII-least. Blocks are ordered by ``part`` and ``seq``; most conversations are one block.

    A null role or text counts as one space, so the row is blank or illegal; rows of a null
    conversation are one conversation. An empty table gives no rows. Other columns are not read.

    Rows are sorted by ranges of conversation, turn, role and the first characters of the text, so a
    conversation of any length lies in many tasks. A conversation that one task holds between
    two others is solved there; those cut by a border of ranges or of blocks are solved over their blocks.
    """
    def given(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    table = rows.select(
        F.coalesce(F.col(conv_col).cast("long"), F.lit(0)).alias("conv"), F.col(conv_col).isNull().alias("no_conv"),
        F.col(turn_col).cast("long").alias("turn"), given(role_col).alias("role"), given(text_col).alias("text"),
    )
    table = table.repartitionByRange("conv", "no_conv", "turn", "role", F.substring("text", 1, 32))
    table = table.sortWithinPartitions("conv", "no_conv", "turn", "role", "text")
    blocks = staged(_mapped(table, functools.partial(_cut, block_rows=block_rows), BLOCKS), "conversation-blocks")
    solved = _mapped(blocks.where("whole"), _solve_whole, REPAIRED)
    parts = blocks.where("not whole")

    # Rows of a cut conversation that one of its earlier blocks holds too.
    held = parts.select(*AT, F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "row"))
    held = held.select(*AT, "pos", F.sha2(F.to_json("row"), 256).alias("digest"))
    held = staged(held, "conversation-digests")
    first = held.groupBy(*KEY, "digest").agg(F.min(F.struct("part", "seq")).alias("first"))
    again = held.join(first, [*KEY, "digest"]).where(F.struct("part", "seq") > F.col("first"))
    again = again.groupBy(*AT).agg(F.collect_list("pos").alias("seen"))

    width = shuffle_width(rows.sparkSession)
    small = "seen array<int>, codes array<string>, costs array<long>"
    tables = _mapped(parts.join(again, list(AT), "left"), _tables, f"conv long, no_conv boolean, part int, seq long, {small}")
    order = [F.col(c) for c in AT]
    back = tables.repartition(width, *KEY).sortWithinPartitions(*KEY, F.desc("part"), F.desc("seq"))
    ends = "seen array<int>, behind array<long>, {}, last boolean"
    back = _mapped(back, _behind, "conv long, no_conv boolean, part int, seq long, " + ends.format("exits array<int>"))
    ahead = staged(back, "conversation-costs").repartition(width, *KEY).sortWithinPartitions(*order)
    ahead = _mapped(ahead, _entered, "conv long, no_conv boolean, part int, seq long, " + ends.format("state int"))
    parts = _mapped(parts.join(ahead, list(AT)), _solve_parts, REPAIRED)
    return solved.unionAll(staged(parts, "conversation-parts"))


def repaired_text(turns: Column) -> Column:
    """``role:text`` of the turns, a line each."""
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which come block by block in order."""
    now, state, filled = None, None, False

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "conv": pa.array([now[0]], pa.int64()), "no_conv": pa.array([now[1]]), "repaired_sha256": [state.hexdigest()],
        })

    for row in _rows(batches):
        key = (row["conv"], row["no_conv"])
        if key != now:
            if now is not None:
                yield done()
            now, state, filled = key, hashlib.sha256(), False
        for turn in row["repaired"]:
            state.update((("\n" if filled else "") + f"{turn['role']}:{turn['text']}").encode())
            filled = True
    if now is not None:
        yield done()


def repair_conversations(blocks: DataFrame) -> DataFrame:
    """One row per conversation that has rows, from the blocks of :func:`repair_blocks`.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. ``gaps`` are the turns
    between the least and the largest one that no row has; ``illegal`` are the neighbours whose role
    initials are not ``su``, ``ua`` or ``au``; ``audit`` are the edits, in order.

    Counts of blocks are summed, with what lies on their borders. A digest has to be fed in
    order: a conversation of several blocks passes one task for that, which holds a block at a time.
    """
    conv = F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id")
    sums = ("blank", "duplicate", "truncated", "illegal", "cost")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct_turns"), F.lit(0)).alias("gaps")
    out = ("gaps", *sums, "audit", "repaired_sha256")
    one = blocks.where("whole").select(
        conv, gaps, *sums, F.col("edits").alias("audit"),
        F.sha2(repaired_text(F.col("repaired")).cast("binary"), 256).alias("repaired_sha256"),
    )
    many = blocks.where("not whole")
    order = Window.partitionBy(*KEY).orderBy("part", "seq")
    before = F.lag("last_role").over(order)
    pair = F.concat(F.substring(before, 1, 1), F.substring("first_role", 1, 1))
    lined = many.select(*AT, *sums, "edits", "first_turn", "last_turn", "distinct_turns", "first_role", "last_role").withColumns({
        "at_border": F.coalesce((~pair.isin("su", "ua", "au")).cast("long"), F.lit(0)),
        "same_turn": F.coalesce((F.lag("last_turn").over(order) == F.col("first_turn")).cast("long"), F.lit(0)),
    })
    summed = lined.groupBy(*KEY).agg(
        *(F.sum(c).alias(c) for c in sums if c != "illegal"),
        F.sum(F.col("illegal") + F.col("at_border")).alias("illegal"),
        F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"),
        F.sum(F.col("distinct_turns") - F.col("same_turn")).alias("distinct_turns"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seq", "edits"))), lambda x: x["edits"]), "").alias("audit"),
    )
    hashes = many.select(*AT, "repaired").repartition(shuffle_width(blocks.sparkSession), *KEY)
    hashes = hashes.sortWithinPartitions(*AT).mapInArrow(_hashed, "conv long, no_conv boolean, repaired_sha256 string")
    rest = summed.join(hashes, list(KEY)).select(conv, gaps, *(F.col(c) for c in out[1:]))
    return one.select("conv_id", *out).unionAll(rest.select("conv_id", *out))


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with planted faults, by the checksum of conversation and turn."""
    def given(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    what = F.crc32(F.concat(given("conv_id"), F.lit(":"), given("turn")).cast("binary")) % 20
    table = rows.select("conv_id", "turn", given("role").alias("role"), given("text").alias("text"), what.alias("what"))
    table = table.where("what <> 0").select(
        "conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("what") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("copies"),
    )
    return table.select("conv_id", "turn", "role", "text", F.explode("copies")).drop("col")
