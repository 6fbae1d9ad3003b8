import hashlib
import random
import zlib

from millrace.llm.periodic_runs import _searched, periodic_runs, with_planted_runs
from millrace.llm.queries import QUERIES


def brute(text):
    """All runs by trying every period at every place, and the words outside of repeats."""
    words = text.encode().split() if text else []
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    gone = {k for (s, length), q in found.items() for k in range(s + q, s + length)}
    runs = sorted((s, q, length) for (s, length), q in found.items())
    return [(s, length, q) for s, q, length in runs], b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def tuples(runs):
    return [(r["start"], r["length"], r["period"]) for r in runs]


def random_text(rng):
    words = [rng.choice("abcdefghij"[:rng.choice([1, 2, 3, 10])]) + ("" if rng.random() < 0.7 else str(rng.randrange(5))) for _ in range(rng.randrange(0, 60))]
    for _ in range(rng.randrange(0, 4)):
        unit = [rng.choice("abcxyz") + str(rng.randrange(3)) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 25, 31, 33, 40]))]
        times = rng.choice([3, 4, 4, 5, 8])
        repeat = (unit * times)[:len(unit) * times - rng.randrange(0, len(unit))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = repeat
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = "?"
    return rng.choice([" ", "\n", " \t"]).join(words)


def test_runs_against_every_period():
    rng = random.Random(11)
    texts = [random_text(rng) for _ in range(1500)]
    texts += [" ".join(["a"] * 300), "aa " * 5, "", None, " \t\n", " ".join("ab" * 100), " ".join((["x", "x", "y"] * 40 + ["z"]) * 9)]
    runs, rest = _searched([None if t is None else t.encode() for t in texts])
    for text, some, left in zip(texts, runs, rest, strict=True):
        expected, collapsed = brute(text)
        assert tuples(some) == expected, text
        assert left.decode() == collapsed


def test_long_periods():
    rng = random.Random(3)
    for period in (63, 64, 65, 100, 127, 128, 129, 1000, 2049):
        unit = [str(rng.randrange(50)) for _ in range(period)]
        for extra in (-1, 0, 1, period // 2):
            words = ["<"] * 3 + unit * 3 + (unit * 2)[:period + extra] + [">"] * rng.randrange(5)
            runs, _ = _searched([" ".join(words).encode()])
            found = [r for r in tuples(runs[0]) if r[2] == period]
            assert len(found) == (extra >= 0), (period, extra)
            assert [r for r in found if r[0] != 3 or r[1] < 4 * period + extra] == []


def test_odd_documents(spark, odd_docs, no_docs):
    got = periodic_runs(odd_docs)
    assert got.columns == ["doc_id", "runs", "collapsed"]
    assert got.count() == odd_docs.count()
    texts = {(r["doc_id"], r["text"]) for r in odd_docs.collect()}
    for row in got.collect():
        options = [brute(t) for i, t in texts if i == row["doc_id"] and len(t or "") < 10_000]
        assert not options or (tuples(row["runs"]), row["collapsed"]) in options
    assert periodic_runs(no_docs).count() == 0


def test_planted_runs(spark):
    texts = ["one two\tthree\x0bfour five six seven eight nine ten\neleven", "", None, " ", "w " * 40]
    rows = [(i, texts[i % 5]) for i in range(300)] + [(None, "a b c d")]
    got = {r["doc_id"]: r["text"] for r in with_planted_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    changed = 0
    for i, text in rows:
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        words = text.encode().split() if text else []
        if h % 10 or not words:
            assert got[i] == text
            continue
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        assert got[i].encode().split() == words
        changed += 1
    assert changed > 10


def test_query(spark, sf):
    rows = QUERIES["op11_periodic_runs"](spark, sf).collect()
    planted = with_planted_runs(spark.read.parquet(f"{sf}/documents.parquet"))
    texts = {r["doc_id"]: r["text"] for r in planted.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    with_runs = 0
    for row in rows:
        if len(texts[row["doc_id"]] or "") > 20_000:
            continue
        runs, collapsed = brute(texts[row["doc_id"]])
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed.encode()).hexdigest()
        with_runs += bool(runs)
    assert with_runs > 5
