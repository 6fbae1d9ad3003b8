import hashlib
import os
import random

from millrace.llm.cuckoo import CuckooIndex
from millrace.llm.exact_dedup import add_to_index, build_index, digests, exact_duplicates, remove_from_index


def digest(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_index_against_dict():
    index, known, rng = CuckooIndex(8), {}, random.Random(3)
    for step in range(20_000):
        key = digest(rng.randrange(4000))
        if rng.random() < 0.6:
            index.put(key, step)
            known[key] = step
        else:
            assert index.remove(key) == (known.pop(key, None) is not None)
        assert len(index) == len(known)
    assert index.resizes > 0
    assert all(index.get(digest(i)) == known.get(digest(i)) for i in range(4000))
    assert all(index.may_hold(k) for k in known)


def test_hits_are_checked_against_keys():
    index = CuckooIndex(4)
    key = os.urandom(32)
    index.put(key, 1)
    twin = key[:10] + os.urandom(22)  # same places and fingerprint, other digest
    assert index.may_hold(twin) and index.get(twin) is None and not index.remove(twin)
    assert index.get(key) == 1


def expected(rows):
    low = lambda t: (t or "").encode().lower()
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[low(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((str(i), str(keep), len(ids), i == keep, hashlib.sha256(low(t)).hexdigest()))
    return sorted(out)


def test_odd_rows(odd_docs, no_docs):
    got = sorted((str(r[0]), str(r[1]), *r[2:]) for r in exact_duplicates(odd_docs).collect())
    assert got == expected([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert exact_duplicates(no_docs).count() == 0


def test_rows_come_and_go(spark):
    docs = spark.createDataFrame([(i, f"t{i % 5}") for i in range(20)], "doc_id long, text string")
    found = digests(docs)
    index = build_index(found)
    more = digests(spark.createDataFrame([(30, "T1"), (31, "new")], "doc_id long, text string"))
    index = add_to_index(index, more)
    gone = found.where("doc_id % 5 = 2").unionAll(found.where("doc_id = 3"))
    left = {bytes(r.digest): (r.keep_id, r.live_rows) for r in remove_from_index(index, gone).collect()}
    want = {"t0": (15, 4), "t1": (30, 5), "t3": (18, 3), "t4": (19, 4), "new": (31, 1)}
    assert left == {hashlib.sha256(k.encode()).digest(): v for k, v in want.items()}
