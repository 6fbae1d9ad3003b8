import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators.jobs import LoadJobError, load_job_status, require_loaded
from millrace.operators.sinks import (
    CountMismatch,
    staging_name,
    verified_write,
    write_csv,
    write_table,
)
from millrace.sources.readers import FormatUnavailable, read_source


def test_csv_flattens(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, ("123 Main St", "CityA"))], "id int, address struct<street: string, city: string>"
    )
    path = str(tmp_path / "out")
    with pytest.raises(AnalysisException):
        df.write.csv(path)
    write_csv(df, path)
    write_csv(df, path)
    back = read_source(spark, "csv", path, header=True, inferSchema=True)
    assert [tuple(r) for r in back.collect()] == [(1, "123 Main St", "CityA")]
    assert back.columns == ["id", "address_street", "address_city"]


def test_staging_names():
    one, two = staging_name(), staging_name("t")
    assert one.startswith("temp_table_") and "-" not in one and two.split("_")[0] == "t"
    assert one != staging_name()


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_verified_write(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, value string")
    done = verified_write(df, str(tmp_path), fmt=fmt)
    assert (done.source_rows, done.target_rows) == (2, 2)
    assert done.target.startswith(str(tmp_path))


def test_verified_write_to_a_catalog_table(spark):
    done = verified_write(spark.range(7), "default", fmt="table", prefix="staged")
    assert done.target.startswith("default.staged_") and done.target_rows == 7
    assert spark.table(done.target).count() == 7


def test_source_runs_once_and_is_counted_as_written(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def tap(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(100, numPartitions=4).mapInPandas(tap, "id bigint").where(F.rand() < 0.5)
    done = verified_write(df, str(tmp_path))
    assert done.source_rows == done.target_rows == spark.read.parquet(done.target).count()
    assert seen.value == 100


def test_mismatch_raises(spark, tmp_path, monkeypatch):
    import millrace.operators.sinks as sinks

    real = sinks.write_table
    monkeypatch.setattr(
        sinks, "write_table",
        lambda df, path, fmt, **kw: (real(df, path, fmt, **kw), df.limit(1).write.mode("append").parquet(path)),
    )
    with pytest.raises(CountMismatch, match="wrote"):
        verified_write(spark.range(3), str(tmp_path))


def test_csv_is_counted_by_rows(spark, tmp_path):
    lines = spark.createDataFrame([(1, "a\nb"), (2, 'say "x,y"'), (3, None), (4, "")], "i int, t string")
    done = verified_write(lines, str(tmp_path), fmt="csv")
    assert (done.source_rows, done.target_rows) == (4, 4)
    nulls = spark.createDataFrame([(None,), ("x",)], "t string")
    assert verified_write(nulls, str(tmp_path), fmt="csv").target_rows == 2


def test_absent_warehouse(spark):
    with pytest.raises(FormatUnavailable, match="bigquery"):
        write_table(spark.range(1), "p.d.t", "bigquery")


NOW = datetime.datetime(2024, 1, 1, 12, 0, 0)


def minutes(n):
    return NOW - datetime.timedelta(minutes=n)


@pytest.fixture
def status(spark):
    jobs = spark.createDataFrame(
        [
            ("ok", minutes(1), None, "LOAD"), ("ok", minutes(3), "old failure", "LOAD"),
            ("bad", minutes(1), "why", "load"), ("bad", minutes(4), None, "LOAD"),
            ("tie", minutes(2), None, "LOAD"), ("tie", minutes(2), "tied", "LOAD"),
            ("late", minutes(6), None, "LOAD"), ("query", minutes(1), None, "QUERY"),
        ],
        "destination string, created timestamp, error string, job_type string",
    )
    targets = spark.createDataFrame(
        [(d,) for d in ("ok", "bad", "tie", "late", "query", "none")], "destination string"
    )

    def run(**kw):
        out = load_job_status(targets, jobs, now=F.lit(NOW), **kw)
        return out, {r.destination: (r.status, r.reason) for r in out.collect()}

    return run


def test_job_status(status):
    _, got = status()
    assert got == {
        "ok": ("ok", None), "bad": ("failed", "why"), "tie": ("failed", "tied"),
        "late": ("unmatched", None), "query": ("ok", None), "none": ("unmatched", None),
    }
    assert status(job_type="LOAD")[1]["query"] == ("unmatched", None)
    assert status(window=datetime.timedelta(minutes=7))[1]["late"] == ("ok", None)


def test_require_loaded(status):
    out, _ = status()
    with pytest.raises(LoadJobError, match="bad: failed why"):
        require_loaded(out.where("destination in ('ok', 'bad')"))
    with pytest.raises(LoadJobError, match="none: unmatched"):
        require_loaded(out.where("destination in ('ok', 'none')"))
    require_loaded(out.where("destination in ('ok', 'none')"), require_match=False)
