import base64
import hashlib
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.sources.files import (
    file_manifest,
    file_row_counts,
    list_files,
    object_path,
    pem_blocks,
    read_whole_texts,
    render_counts,
    sync_plan,
)


@pytest.fixture
def counted(tmp_path):
    for name, text in {
        "full.csv": "h\n1\n2\n", "open end.csv": "h\n1\n2", "header.csv": "h\n", "empty.csv": "",
        "cr.csv": "h\n1\r2\n3\n",
    }.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "in.csv").write_text("h\n1\n")
    return str(tmp_path)


WANT = {"full.csv": 2, "open end.csv": 2, "header.csv": 0, "empty.csv": 0, "cr.csv": 2}


def test_row_counts(spark, counted):
    counts = file_row_counts(spark, counted)
    assert {r.file_name: r.row_count for r in counts.collect()} == WANT
    deep = file_row_counts(spark, counted, recursive=True)
    assert {r.file_name: r.row_count for r in deep.collect()} == WANT | {"in.csv": 1}
    bare = file_row_counts(spark, counted, header=0, glob="full*")
    assert [(r.file_name, r.row_count) for r in bare.collect()] == [("full.csv", 3)]
    assert "full.csv ====> 2" in {r.value for r in render_counts(counts).collect()}


def test_row_counts_of_split_files(spark, tmp_path):
    (tmp_path / "big.csv").write_text("h\n" + "".join(f"{i}\n" for i in range(50_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert file_row_counts(spark, str(tmp_path)).first().row_count == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def tree(root: pathlib.Path, files):
    for name, text in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    return str(root)


def test_manifest_and_sync(spark, tmp_path):
    src = tree(tmp_path / "src", {"same": "a", "d/changed": "bb", "d/grown": "ccc", "new file": "d", "empty": ""})
    dst = tree(tmp_path / "dst", {"same": "a", "d/changed": "xx", "d/grown": "c", "extra": "e", "empty": ""})
    left, right = (file_manifest(spark, p, checksum="content") for p in (src, dst))
    rows = {r.path: r for r in left.collect()}
    assert set(rows) == {"same", "d/changed", "d/grown", "new file", "empty"}
    assert (rows["empty"].size, rows["empty"].checksum) == (0, hashlib.sha256(b"").hexdigest())
    assert rows["d/grown"].size == 3
    assert rows["same"].checksum == hashlib.sha256(b"a").hexdigest()
    plan = {r.path: r.action for r in sync_plan(left, right, ("size", "checksum")).collect()}
    assert plan == {"same": "delete_source", "empty": "delete_source", "d/changed": "copy", "d/grown": "copy", "new file": "copy"}
    assert {r.path: r.action for r in sync_plan(left, right).collect()} == plan
    bare = sync_plan(left.drop("checksum"), right.drop("checksum"), by=("size",))
    assert {r.path: r.action for r in bare.collect()} == {
        "same": "unknown", "empty": "unknown", "d/changed": "unknown", "d/grown": "copy", "new file": "copy"
    }
    lost = right.withColumn("checksum", F.when(F.col("path") != "same", F.col("checksum")))
    assert {r.path: r.action for r in sync_plan(left, lost).collect()}["same"] == "unknown"
    for form in (f"file:{src}", f"file://{src}/"):
        assert {r.path for r in file_manifest(spark, form).collect()} == set(rows)
    odd = tree(tmp_path / "odd %20 + dir", {"a%20b#c?.txt": "x", "ü +.txt": ""})
    assert {r.path: r.size for r in file_manifest(spark, odd).collect()} == {
        "a%20b#c?.txt": 1, "ü +.txt": 0
    }
    assert file_manifest(spark, src, recursive=False).count() == 3
    lines = {r.path: r.line_digest for r in file_manifest(spark, src, checksum="lines").collect()}
    other = {r.path: r.line_digest for r in file_manifest(spark, dst, checksum="lines").collect()}
    assert lines["same"] == other["same"] and lines["d/changed"] != other["d/changed"]
    assert lines["empty"] == "0:0"
    assert "checksum" not in file_manifest(spark, src).columns


def test_listing_in_tasks(spark, tmp_path):
    names = {f"d{i}/e{i % 3}/f{i}.txt": "x" * i for i in range(40)} | {"top.csv": "", "_hidden/a": "h", ".b": "h", "p=1/_c": "h", "p=1/d": "d"}
    root = tree(tmp_path / "root", names)
    got = {r.path: r for r in list_files(spark, root).collect()}
    assert set(got) == {n for n in names if n.startswith("d") or n in ("top.csv", "p=1/d")}
    assert all(got[n].size == len(names[n]) and got[n].modified is not None for n in got)
    assert {r.path for r in list_files(spark, root, glob="{f1,f2}[0-4].tx?").collect()} == {
        n for n in names if n.startswith("d") and 10 <= len(names[n]) <= 24 and len(names[n]) % 10 <= 4
    }
    assert [r.path for r in list_files(spark, root, recursive=False).collect()] == ["top.csv"]
    assert [r.path for r in list_files(spark, f"file:{root}/top.csv").collect()] == ["top.csv"]
    plan = file_manifest(spark, root)._jdf.queryExecution().optimizedPlan().toString()
    assert "f1.txt" not in plan and "e1" not in plan
    with pytest.raises(Exception, match="nowhere"):
        list_files(spark, f"{root}/nowhere").collect()


def test_block_digests(spark, tmp_path):
    rng = random.Random(2)
    lines = [f"line {i}\n" for i in range(5000)]
    files = {
        "same": "".join(lines), "turned": "".join(lines), "grown": "a" * 1024, "empty": "", "bytes": "",
    }
    left, right = tree(tmp_path / "l", files), tree(tmp_path / "r", files)
    body = bytes(rng.randrange(256) for _ in range(10_000))
    for side in (left, right):
        pathlib.Path(side, "bytes").write_bytes(body)
    lines[10], lines[4000] = lines[4000].replace("4000", "9999"), lines[10]
    pathlib.Path(right, "turned").write_text("".join(lines[:4000]) + "".join(reversed(lines[4000:])))
    pathlib.Path(right, "grown").write_text("a" * 1025)
    sides = [file_manifest(spark, side, checksum="blocks", block_bytes=1024) for side in (left, right)]
    assert {r.path: r.action for r in sync_plan(*sides).collect()} == {
        "same": "delete_source", "empty": "delete_source", "bytes": "delete_source", "turned": "copy", "grown": "copy",
    }
    parts = "".join(hashlib.sha256(body[i:i + 1024]).hexdigest() for i in range(0, len(body), 1024))
    found = {r.path: r.checksum for r in sides[0].collect()}
    assert found["bytes"] == "1024:" + hashlib.sha256(parts.encode()).hexdigest()
    assert found["empty"] == "1024:" + hashlib.sha256(hashlib.sha256(b"").hexdigest().encode()).hexdigest()


def pem(kind, data):
    return f"-----BEGIN {kind}-----\n{base64.encodebytes(data).decode()}-----END {kind}-----\n"


def test_pem_blocks(spark, tmp_path):
    cert, key = bytes(range(256)) * 2, b"key bytes"
    text = "note\n" + pem("CERTIFICATE", cert) + pem("PRIVATE KEY", key) + pem("CERTIFICATE", b"z")
    text += "-----BEGIN CERTIFICATE-----\nY Q=\r\n=\n-----END CERTIFICATE-----"
    (tmp_path / "a.pem").write_text(text)
    (tmp_path / "b.pem").write_text("-----BEGIN CERTIFICATE-----\nno end")
    (tmp_path / "c.pem").write_text("-----BEGIN X-----\n!!!\n-----END X-----")
    (tmp_path / "d.pem").write_text("-----BEGIN Odd-----\nYQ==\n-----END Odd-----\n-----BEGIN nothing")
    rows = pem_blocks(read_whole_texts(spark, str(tmp_path))).collect()
    got = [(r.path.rsplit("/", 1)[1], r.kind, r.der_length, r.fingerprint) for r in rows]
    want = [
        ("a.pem", k, len(d), hashlib.sha256(d).hexdigest())
        for k, d in (("CERTIFICATE", cert), ("PRIVATE KEY", key), ("CERTIFICATE", b"z"), ("CERTIFICATE", b"a"))
    ] + [("c.pem", "X", None, None), ("b.pem", "CERTIFICATE", None, None), ("d.pem", "Odd", None, None), ("d.pem", None, None, None)]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r.kind for r in rows if not r.whole} == {"CERTIFICATE", "Odd", None}


def test_object_path(spark):
    df = spark.createDataFrame([("gs://bucket/path/object",), ("gs://b/",), (None,)], "p string")
    rows = [tuple(r[0]) if r[0] else None for r in df.select(object_path("p")).collect()]
    assert rows == [("bucket", "path/object"), ("b", ""), None]
    for bad, why in (("s3://b/o", "not a gs"), ("gs://bucket", "no object")):
        one = spark.createDataFrame([(bad,)], "p string")
        assert one.select(object_path("p", strict=False)).first()[0] is None
        with pytest.raises(Exception, match=why):
            one.select(object_path("p")).collect()
