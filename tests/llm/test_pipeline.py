import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
NAMES = [n for n, _ in corpus_pipeline.STAGES]


def stages(spark, docs, sf_dir, tmp_path):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, stages(spark, docs, SF, tmp_path_factory.mktemp("pipeline"))


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(results):
    docs, (clean, single, apart, cut, packed) = results
    assert NAMES == ["toxicity", "exact_dedup", "ngram_join", "substring_dedup", "packing"]
    assert all(df.columns == docs.columns for df in (clean, single, apart, cut))

    last = {}
    for i, t in texts(clean).items():
        key = t.encode().lower()
        last[key] = max(last.get(key, i), i)
    assert set(texts(single)) == set(last.values())

    _, ends = brute.similar(texts(single))
    assert set(texts(apart)) == {i for i, e in ends.items() if i == e}

    before, after = texts(apart), texts(cut)
    assert set(before) == set(after)
    held = brute.repeated(before, 32)
    assert all(before[i] == after[i] for i in before if i not in held)
    assert not brute.repeated(after, 51)
    assert cut.where(F.length("text") != F.col("n_chars")).count() == 0

    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(after)


def test_toxic_documents_go(spark):
    """On tables with enough labels to learn from; the smallest ones have ten toxic documents."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    clean = corpus_pipeline.drop_toxic(spark, docs, sf)
    known = docs.join(labels, "doc_id").select("doc_id", "toxic").collect()
    kept = set(texts(clean))
    right = sum((r.doc_id in kept) != bool(r.toxic) for r in known)
    assert right / len(known) > 0.9


def test_odd_rows(spark, odd_docs, no_docs, tmp_path_factory):
    for docs in (odd_docs, no_docs):
        results = stages(spark, docs, SF, tmp_path_factory.mktemp("odd"))
        assert all(df.columns == docs.columns for df in results[:-1])
    assert results[-1].count() == 0


def test_run(spark):
    assert set(corpus_pipeline.run(spark, SF).columns) >= {"doc_id", "sequence_id", "offset"}
