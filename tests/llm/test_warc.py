import glob
import gzip
import hashlib

from millrace.llm.warc import export_warc, read_archive, write_archive
from millrace.session import scratch_path

ODD = "page_id long, url string, html string, digest string, header string, bytes int"


def odd_pages(spark):
    big = "<p>é</p>" * 50
    rows = [
        (3, "http://a/", big), (1, "http://b/\r\nX: y", big), (2, None, big), (4, "http://c/", None),
        (5, "", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "WARC/1.1\r\n\r\n" * 30), (None, "n", big),
        (None, "n", "z" * 200), (9, "WARC-Type: response", "y" * 99), (10, "", "y" * 99), (11, "l", "lang " * 50_000),
        (1, "http://again", big),
    ]
    return spark.createDataFrame([(*r, "clash", None, 1) for r in rows], ODD)


def expected(rows):
    first = {}
    for i, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, html in rows:
        body = (html or "").encode()
        keep = first.get(html or "")
        again = len(body) >= 100 and i != keep
        out.append((str(i), len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", str(keep if again else None)))
    return sorted(out)


def archive(spark, pages):
    path = scratch_path(spark, "test-archive")
    write_archive(pages, path)
    return path


def test_odd_pages(spark):
    pages = odd_pages(spark)
    path = archive(spark, pages)
    back = read_archive(spark, path).collect()
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in back)
    assert got == expected([(r.page_id, r.html) for r in pages.collect()])
    assert all(hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest for r in back)
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len({r.html or "" for r in pages.collect()})


def test_damage_is_seen(spark):
    path = archive(spark, odd_pages(spark))
    bad = spark.read.parquet(f"{path}/payloads").selectExpr("digest", "bytes", "concat(payload, X'20') payload")
    bad.write.parquet(f"{path}-bad/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}-bad/headers")
    assert {r.payload_digest for r in read_archive(spark, f"{path}-bad").collect()} == {None}


def test_empty(spark):
    path = archive(spark, spark.createDataFrame([], ODD))
    assert read_archive(spark, path).count() == 0


def test_files_are_warc(spark, tmp_path):
    pages = odd_pages(spark)
    path = archive(spark, pages)
    export_warc(spark, path, str(tmp_path / "out"), records_per_file=4)
    records = []
    for name in glob.glob(str(tmp_path / "out" / "part-*.gz")):
        data = gzip.open(name).read()
        while data:
            head, data = data.split(b"\r\n\r\n", 1)
            lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines[1:])
            size = int(fields["Content-Length"])
            assert lines[0] == "WARC/1.1" and data[size:size + 4] == b"\r\n\r\n"
            if fields["WARC-Type"] == "response":
                assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(data[:size]).hexdigest()
            else:
                assert size == 0 and "WARC-Refers-To" in fields
            records.append(fields)
            data = data[size + 4:]
    assert len(records) == pages.count()
