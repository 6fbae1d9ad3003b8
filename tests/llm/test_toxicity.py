import random
import time
import zlib

from millrace.llm.toxicity import maximal_segments, toxicity


def segments_by_definition(scores):
    """Maximal segments, by recursion: the best subsequence, then the rest on both sides."""
    best = None
    for a in range(len(scores)):
        total = 0
        for b in range(a, len(scores)):
            total += scores[b]
            key = (-total, b - a)
            if total > 0 and (best is None or key < best[0]):
                best = (key, a, b, total)
    if best is None:
        return []
    _, a, b, total = best
    right = [(x + b + 1, y + b + 1, t) for x, y, t in segments_by_definition(scores[b + 1:])]
    return [*segments_by_definition(scores[:a]), (a, b, total), *right]


def test_maximal_segments():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 30)
        hits = [(i, rng.randrange(1, 40) + rng.random()) for i in range(n) if rng.random() < 0.3]
        penalty = rng.randrange(1, 12) + rng.random()
        scores = [-penalty] * n
        for i, s in hits:
            scores[i] = s
        got, want = maximal_segments(hits, penalty), segments_by_definition(scores)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(abs(g[2] - w[2]) < 1e-6 for g, w in zip(got, want, strict=True))


def corpus(seed, n=1500):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(rng.randrange(5, 200))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(rng.randrange(1, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(["Vilea", "NASTYB", "gromp" + rng.choice("abcdefgh")]))
        docs.append((i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, 1, int(bad)))
    return docs, labels, {i for i, t in docs if any(x in t.lower() for x in ("vilea", "nastyb", "gromp"))}


LABELS = "doc_id long, quality int, toxic int"


def test_held_out(spark):
    docs, labels, bad = corpus(2)
    scored, _ = toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))
    rows = scored.collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    assert sum((r.doc_id in bad) == bool(r.predicted) for r in held) / len(held) > 0.97


def test_held_out_labels_are_not_used(spark):
    docs, labels, _ = corpus(3, 400)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    turned = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    one, two = (
        {r.doc_id: r.score for r in toxicity(df, spark.createDataFrame(x, LABELS))[0].collect()}
        for x in (labels, turned)
    )
    assert one == two


def test_spans_mark_the_words(spark):
    docs, labels, bad = corpus(4)
    scored, _ = toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))
    texts = dict(docs)
    for r in scored.where("predicted = 1").collect():
        words = texts[r.doc_id].lower().split()
        for s in r.spans:
            assert words[s.start].startswith(("vilea", "nastyb", "gromp"))


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(6, 0, 1), (6, 0, 0), (None, 1, 1), (8, 1, None), (9, None, 0), (99, 0, 1)], LABELS)
    scored, _ = toxicity(odd_docs, labels)
    rows = scored.collect()
    assert len(rows) == odd_docs.count() and all(r.score is not None and 0 <= r.score <= 1 for r in rows)
    assert all(not r.held_out for r in rows if r.doc_id is None)
    assert toxicity(no_docs, labels)[0].count() == 0
    assert toxicity(odd_docs, labels.limit(0))[0].count() == odd_docs.count()


def test_held_out_driver_labels(spark):
    from millrace.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op1_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = rows.where("held_out").select("score", "predicted", "toxic").collect()
    toxic, clean = ([r for r in rows if r.toxic == t] for t in (1, 0))
    assert len(toxic) > 50
    assert sum(r.predicted for r in toxic) / len(toxic) >= 0.85
    assert sum(r.predicted for r in clean) / len(clean) <= 0.02
    order = sorted([(r.score, r.toxic) for r in rows])
    ranks, at = 0.0, 0
    while at < len(order):
        end = at
        while end < len(order) and order[end][0] == order[at][0]:
            end += 1
        ranks += sum(t for _, t in order[at:end]) * (at + 1 + end) / 2
        at = end
    auc = (ranks - len(toxic) * (len(toxic) + 1) / 2) / (len(toxic) * len(clean))
    assert auc >= 0.95


def segments_step_by_step(hits, penalty):
    """The list of open segments walked back one by one, as the algorithm is usually told."""
    done, total, last = [], 0.0, None
    for position, score in hits:
        total -= penalty * (position - last - 1) if last is not None else 0
        last = position
        now = [position, position, total, total + score]
        total += score
        while True:
            at = next((i for i in reversed(range(len(done))) if done[i][2] < now[2]), -1)
            if at < 0 or done[at][3] >= now[3]:
                done.append(now)
                break
            now = [done[at][0], position, done[at][2], now[3]]
            del done[at:]
    return [(a, b, right - left) for a, b, left, right in done]


def test_many_hits_take_linear_time():
    rng = random.Random(8)
    for spread in (1, 3, 10, 30):
        places, at = [], 0
        for _ in range(2000):
            at += rng.randrange(1, 2 * spread + 1)
            places.append((at, rng.randrange(1, 9) / 2))
        assert maximal_segments(places, 0.5) == segments_step_by_step(places, 0.5)
    many = [(10 * i, 1.0 + (i * 7919 % 13) / 13) for i in range(100_000)]
    began = time.perf_counter()
    assert len(maximal_segments(many, 0.5)) > 1000
    assert time.perf_counter() - began < 1
