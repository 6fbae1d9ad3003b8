import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm.pieces import PieceModel, decode, decoded, encode, encode_and_decode, piece_model, plain_bytes
from millrace.llm.queries import QUERIES, tokenizer_file

PATH = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet="the anding of \n\t\x00ä日😀▁.,0aaa", max_size=60), max_size=6))
def test_same_as_the_library(library, texts):
    model = piece_model(PATH)
    ids = [x.tolist() for x in model.encode(texts)]
    assert ids == library.encode(texts)
    for text, row in zip(texts, ids, strict=True):
        assert decoded(plain_bytes(PATH), row) == text.replace("▁", " ")


def test_documents(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("text", encode(F.col("text"), PATH).alias("ids")).collect()
    assert [r.ids for r in rows] == library.encode([r.text for r in rows])
    assert QUERIES["op6_pieces"](spark, sf).where("not round_trip").count() == 0


def test_odd_rows(odd_docs, no_docs, library):
    rows = odd_docs.select("text", encode(F.col("text"), PATH).alias("ids")).withColumn("back", decode(F.col("ids"), PATH)).collect()
    for r in rows:
        assert r.ids == library.encode(r.text or "")
        assert r.back == (r.text or "").replace("▁", " ")
    assert no_docs.select(encode(F.col("text"), PATH)).count() == 0


def test_in_one_pass(odd_docs, no_docs, library):
    rows = encode_and_decode(odd_docs, PATH).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "")
        assert r.decoded == (r.text or "").replace("▁", " ")
    assert encode_and_decode(no_docs, PATH).count() == 0


def test_caches_are_bounded_by_bytes(library, monkeypatch):
    monkeypatch.setattr("millrace.llm.pieces.CACHED_BYTES", 20_000)
    model = PieceModel(PATH)
    for i in range(6):
        texts = [" ".join(f"word{i}x{k}" for k in range(500)), "a" * 3000 + str(i), "日" * 200]
        assert [x.tolist() for x in model.encode(texts)] == library.encode(texts)
        assert all(len(r) <= 64 for r in (*model.known, *model.older))
    assert model.held < 20_000 + 600 * 400 and len(model.long) <= 3
