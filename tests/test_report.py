import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators.report import group_minima, join_on, min_pair_match

# The sample rows of the price report.
PRICES = [
    (1001, 100, "01-01-2020"), (1001, 200, "01-01-2020"), (1001, 300, "02-01-2020"),
    (1002, 200, "01-01-2020"), (1002, 300, "01-01-2020"), (1002, 400, "02-01-2020"),
    (1003, 300, "01-01-2020"), (1003, 400, "01-01-2020"), (1003, 500, "02-01-2020"),
]


@pytest.fixture
def prices(spark):
    return spark.createDataFrame(PRICES, "prod_id bigint, prod_price bigint, sale_time string")


def test_report_of_the_sample(spark, prices):
    products = spark.createDataFrame(
        [(1001, "rope"), (1002, "lamp"), (1003, "saw")], "prod_id bigint, prod_name string"
    )
    joined = join_on(prices, products, "prod_id")
    assert joined.columns == ["prod_id", "prod_price", "sale_time", "prod_name"]
    out = min_pair_match(joined, ["prod_id", "prod_name"], "sale_time", "prod_price")
    rows = sorted(tuple(r) for r in out.select("prod_id", "prod_name", "prod_price").collect())
    assert rows == [(1001, "rope", 100), (1002, "lamp", 200), (1003, "saw", 300)]


def test_minima(prices):
    rows = sorted(tuple(r) for r in group_minima(prices, ["prod_id"], "sale_time", "prod_price").collect())
    assert rows[0] == (1001, "01-01-2020", 100)


def test_text_order_against_date_order(spark):
    df = spark.createDataFrame(
        [(1, 5, "02-01-2019"), (1, 7, "01-01-2020")], "k int, p int, day string"
    )
    assert min_pair_match(df, ["k"], "day", "p").count() == 0
    assert min_pair_match(df, ["k"], "day", "p", fmt="dd-MM-yyyy").first().day == "02-01-2019"
    odd = df.union(spark.createDataFrame([(1, 1, "soon")], df.schema))
    assert min_pair_match(odd, ["k"], "day", "p", fmt="dd-MM-yyyy").count() == 0


def test_ties_and_groups_without_match(spark):
    rows = [(1, "a", 5), (1, "a", 5), (1, "b", 9), (2, "a", 9), (2, "b", 1), (3, None, 1), (3, "c", None)]
    df = spark.createDataFrame(rows, "k int, d string, p int")
    assert sorted(tuple(r) for r in min_pair_match(df, ["k"], "d", "p").collect()) == [
        (1, "a", 5), (1, "a", 5)
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4), st.integers(0, 4)), max_size=25))
def test_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, d int, p int")
    want = [
        r for r in rows
        if r[1] == min(x[1] for x in rows if x[0] == r[0])
        and r[2] == min(x[2] for x in rows if x[0] == r[0])
    ]
    got = [tuple(r) for r in min_pair_match(df, ["k"], "d", "p").collect()]
    assert sorted(got) == sorted(want)
