import re

import pytest
from pyspark.sql import functions as F

from millrace.operators.documents import PipelineError, run_pipeline
from millrace.plans import QUERIES

DOCS = [
    (1, "ann", {"city": "Kiel", "zip": 24}, ["a", "b"], 1.5, True),
    (2, "Bob", {"city": None, "zip": 25}, [], 2.0, False),
    (3, None, None, None, None, None),
    (4, "dora", {"city": "Köln", "zip": None}, ["b", None], 7.0, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "_id long, name string, at struct<city: string, zip: int>, tags array<string>, n double, ok boolean")


@pytest.mark.parametrize("query, ids", [
    ({}, [1, 2, 3, 4]), ({"name": "ann"}, [1]), ({"name": None}, [3]), ({"name": {"$ne": "ann"}}, [2, 3, 4]),
    ({"at.city": "Kiel"}, [1]), ({"at.city": None}, [2, 3]), ({"at.city": {"$exists": True}}, [1, 4]), ({"at.land": {"$exists": False}}, [1, 2, 3, 4]),
    ({"at.land": None}, [1, 2, 3, 4]), ({"at.land": "x"}, []), ({"at.land": {"$ne": "x"}}, [1, 2, 3, 4]), ({"at.land": {"$gt": 1}}, []),
    ({"n": {"$gt": 1.5, "$lte": 7}}, [2, 4]), ({"n": {"$not": {"$gt": 1.5}}}, [1, 3]), ({"n": {"$gt": "1"}}, []), ({"name": 1}, []),
    ({"name": {"$in": ["ann", "Bob", None]}}, [1, 2, 3]), ({"name": {"$nin": ["ann"]}}, [2, 3, 4]), ({"name": {"$nin": [None]}}, [1, 2, 4]),
    ({"name": {"$regex": "^[ab]"}}, [1]), ({"name": {"$regex": "^[ab]", "$options": "i"}}, [1, 2]), ({"n": {"$regex": "1"}}, []),
    ({"tags": "b"}, [1, 4]), ({"tags": {"$in": ["a", "x"]}}, [1]), ({"tags": {"$ne": "b"}}, [2, 3]), ({"tags": {"$size": 0}}, [2]), ({"tags": {"$gt": "a"}}, [1, 4]),
    ({"$or": [{"name": "ann"}, {"n": {"$gte": 7}}]}, [1, 4]), ({"$nor": [{"name": "ann"}, {"n": 2}]}, [3, 4]),
    ({"$and": [{"n": {"$gt": 1}}, {"at.zip": {"$lt": 25}}]}, [1]), ({"ok": True}, [1]), ({"ok": 1}, []), ({"ok": {"$ne": True}}, [2, 3, 4]),
])
def test_match(docs, query, ids):
    assert sorted(r[0] for r in run_pipeline(docs, [{"$match": query}]).collect()) == ids


def test_project(docs):
    assert run_pipeline(docs, '{"$project": {"at.city": 1, "n": 1}}').dtypes == [("_id", "bigint"), ("at", "struct<city:string>"), ("n", "double")]
    assert run_pipeline(docs, [{"$project": {"at.city": 0, "tags": 0, "_id": 0}}]).dtypes == [
        ("name", "string"), ("at", "struct<zip:int>"), ("n", "double"), ("ok", "boolean")
    ]
    got = run_pipeline(docs, [{"$match": {"n": 2}}, {"$project": {"_id": 0, "town": "$at.zip", "none": "$x.y"}}, {"$limit": 1}])
    assert [tuple(r) for r in got.collect()] == [(25, None)]


@pytest.mark.parametrize("pipeline", [
    [{"$group": {}}], [{"$match": {"$where": 1}}], [{"$match": {"a": {"$near": 1}}}], [{"$match": {"name": {"$in": 1}}}],
    [{"$project": {"name": 1, "n": 0}}], [{"$project": {"x": "name"}}], [{}], [{"$match": {"at": {"city": "Kiel"}}}], [{"$match": {"$or": []}}],
    [{"$match": {"name": {"$regex": "a", "$options": "q"}}}],
])
def test_what_is_refused(docs, pipeline):
    with pytest.raises(PipelineError):
        run_pipeline(docs, pipeline)


def test_conditions_reach_the_scan(spark, sf):
    plan = QUERIES["document_pipeline"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: (\S+)", plan)
    assert "GreaterThan(customer.balance" in pushed[1] and "In(status" in pushed[1] and "Or(" in pushed[1]
    assert "comment" not in pushed[2] and "clerk" not in pushed[2]


def test_dates_compare_with_text(spark):
    days = spark.sql("select 1 as _id, date '2024-01-05' as day union all select 2, null")
    assert [r[0] for r in run_pipeline(days, [{"$match": {"day": {"$gte": "2024-01-05"}}}]).collect()] == [1]
    assert days.where(F.lit(True)).count() == 2
