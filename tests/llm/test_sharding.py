import zlib

from millrace.llm.sharding import byte_shards


def check(rows, texts, shards=16):
    """Contiguous in id order, gapless slots, every cut within half a document of its target."""
    rows = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts
    )
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i or 0))
    assert {r.law for r in rows} <= {"bytes"} and {r.grown_shard for r in rows} <= {None}
    for shard in {r.shard for r in rows}:
        assert 0 <= shard < shards
        slots = [r.slot for r in rows if r.shard == shard]
        assert slots == list(range(len(slots)))
    total, upto, largest = sum(r.size for r in rows), 0, max((r.size for r in rows), default=0)
    for shard in range(shards):
        upto += sum(r.size for r in rows if r.shard == shard)
        assert abs(upto - total * (shard + 1) / shards) <= largest / 2 + 1


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(byte_shards(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(odd_docs, no_docs):
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(byte_shards(odd_docs).collect(), texts)
    check(byte_shards(odd_docs, shards=3).collect(), texts, 3)
    assert byte_shards(no_docs).count() == 0


def test_native(spark, sf):
    plan = byte_shards(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
