import functools
import hashlib
import random
import sys
import zlib

from millrace.llm.conversations import damaged, repair_blocks, repair_conversations

COLUMNS = "conv_id long, turn long, role string, text string"
STEP = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
MISSING, WANTED = [2, 2, 3, 2], ["user", "user", "assistant", "user"]


def brute(rows):
    """What the report of one conversation has to say, by recursion over (cost, edits) of every suffix."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        kept = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not kept else "duplicate" if (role, text) in seen else "" if kept[-1] in ".!?" else "truncated")
        seen.add((role, text))
    sys.setrecursionlimit(20_000)

    @functools.cache
    def best(i, state, inserts):
        moves = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        if inserts < 2:
            cost, edits, out = best(i, MISSING[state], inserts + 1)
            moves.append((cost + 5, "I" + edits, (WANTED[state] + ":",) + out))
        if i < len(rows):
            cost, edits, out = best(i + 1, state, 0)
            moves.append((cost + 2, "D" + edits, out))
            if faults[i] in ("", "truncated"):
                extra = 5 if faults[i] else 0
                _, role, text = rows[i]
                if role[:1] in STEP[state]:
                    cost, edits, out = best(i + 1, STEP[state][role[:1]], 0)
                    moves.append((cost + extra, "K" + edits, (f"{role}:{text}",) + out))
                cost, edits, out = best(i + 1, MISSING[state], 0)
                moves.append((cost + extra + 1, "R" + edits, (f"{WANTED[state]}:{text}",) + out))
        return min(moves, default=(10**9, "", ()))

    cost, edits, out = best(0, 0, 0)
    turns = [t for t, _, _ in rows if t is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        "cost": cost, "audit": edits, "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def some_rows(rng, conv, n):
    roles = ["system", "user", "assistant", "user", "assistant", "", "tool", None]
    texts = ["Yes.", "No!", "cut", "", " \t", "é?", None, "Why? "]
    return [(conv, rng.choice([None, *range(n)]) if rng.random() < 0.2 else i, rng.choice(roles),
             rng.choice(texts) if rng.random() < 0.5 else f"t{rng.randrange(n)}.") for i in range(n)]


def check(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS + ", repaired int, part string")
    got = {r["conv_id"]: r.asDict() for r in repair_conversations(repair_blocks(frame, **options)).collect()}
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(tuple(row))
    assert got.keys() == groups.keys()
    for conv, some in groups.items():
        assert got[conv] == {"conv_id": conv, **brute(some)}, conv


def test_random_conversations(spark):
    rng = random.Random(5)
    check(spark, [r for c in range(300) for r in some_rows(rng, c, rng.randrange(1, 9))])


def test_conversations_over_many_blocks(spark):
    rng = random.Random(6)
    rows = [r for c in range(4) for r in some_rows(rng, c, 300)] + some_rows(rng, None, 40)
    check(spark, rows, block_rows=7)


def test_one_long_conversation_is_split(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"Text {i}.") for i in range(3000)]
    rows += [(1, None, "user", "same.")] * 500
    blocks = repair_blocks(spark.createDataFrame(rows, COLUMNS), block_rows=100)
    assert blocks.groupBy().max("rows").first()[0] <= 100
    row = repair_conversations(blocks).first()
    assert (row["duplicate"], row["illegal"], row["gaps"]) == (499, 499, 0)
    assert (row["audit"], row["cost"]) == ("K" + "D" * 499 + "K" * 2999 + "D", 1000)


def test_empty_table(spark):
    assert repair_conversations(repair_blocks(spark.createDataFrame([], COLUMNS))).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(5)] + [(None, None, None, None)]
    got = damaged(spark.createDataFrame(rows, COLUMNS)).collect()
    expected = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = role or " ", text or " "
        if kind:
            row = (conv, turn, "user" if kind == 4 else role,
                   "" if kind == 1 else text.replace(".", "").replace("!", "") if kind == 2 else text)
            expected += [row] * (2 if kind == 3 else 1)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
