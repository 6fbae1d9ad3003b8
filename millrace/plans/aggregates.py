"""Queries of the aggregate, join and report operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import result_json_array, rows_to_json
from millrace.operators.aggspec import (
    agg_attach,
    agg_spec,
    control_record,
    pack_struct,
    spec_items,
)
from millrace.operators.report import group_minima, join_on, min_pair_match
from millrace.operators.shapes import match_fields
from millrace.plans.registry import query, table

DAY = "yyyy-MM-dd"
MONEY = "decimal(15,2)"


@query("min_pair_match", """
WITH j AS (
  SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
m AS (
  SELECT l_orderkey AS k, min(l_shipdate) AS oldest, min(l_extendedprice) AS least
  FROM j GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderpriority,
       strftime(l_shipdate, '%Y-%m-%d') AS ship_day
FROM j JOIN m ON l_orderkey = k AND l_shipdate = oldest AND l_extendedprice = least
""")
def _min_pair_match(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"
    )
    # The join repeats whole groups, so it leaves the minima as they are: it can follow the
    # match, when most rows are gone.
    found = min_pair_match(lines, ["l_orderkey"], "l_shipdate", "l_extendedprice")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"
    )
    return join_on(found, orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "o_orderpriority",
        F.date_format("l_shipdate", DAY).alias("ship_day"),
    )


@query("join_inner", """
SELECT p_name, sum(l_quantity) AS sum_qty, count(*) AS n_lines
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name
""")
def _join_inner(spark, sf):
    per_part = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n"))
    )
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return (
        join_on(per_part, part, "p_partkey")
        .groupBy("p_name")
        .agg(F.sum("qty").alias("sum_qty"), F.sum("n").alias("n_lines"))
    )


@query("join_multi_key", """
WITH m AS (
  SELECT o_custkey AS c, min(o_orderdate) AS d, min(o_totalprice) AS p
  FROM orders GROUP BY 1)
SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS order_day
FROM orders JOIN m ON o_custkey = c AND o_orderdate = d AND o_totalprice = p
""")
def _join_multi_key(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    return min_pair_match(orders, ["o_custkey"], "o_orderdate", "o_totalprice").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.date_format("o_orderdate", DAY).alias("order_day"),
    )


@query("min_pair_match_dates", """
WITH m AS (
  SELECT o_custkey AS c, min(CAST(o_orderdate AS DATE)) AS d, min(o_totalprice) AS p
  FROM orders WHERE o_orderkey % 11 > 0 GROUP BY 1),
n AS (SELECT o_custkey AS c, min(o_totalprice) AS p FROM orders GROUP BY 1)
SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%d-%m-%Y') AS order_day
FROM orders JOIN m ON o_custkey = m.c AND CAST(o_orderdate AS DATE) = d
     JOIN n ON o_custkey = n.c AND o_totalprice = n.p
WHERE o_orderkey % 11 > 0
""")
def _min_pair_match_dates(spark, sf):
    """The day as text, day first; one order in eleven has none that can be read."""
    day = F.when(F.col("o_orderkey") % 11 > 0, F.date_format("o_orderdate", "dd-MM-yyyy")).otherwise("soon")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", day.alias("order_day")
    )
    return min_pair_match(orders, ["o_custkey"], "order_day", "o_totalprice", fmt="dd-MM-yyyy")


@query("group_min_min", """
SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS oldest_day,
       min(o_totalprice) AS least_price
FROM orders GROUP BY o_custkey
""")
def _group_min_min(spark, sf):
    minima = group_minima(
        table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", "o_totalprice",
        names=("oldest", "least_price"),
    )
    return minima.select(
        "o_custkey", F.date_format("oldest", DAY).alias("oldest_day"), "least_price"
    )


SPEC = "sum(l_quantity)|min(l_extendedprice)|max(l_discount)|count(l_orderkey)"


@query("agg_spec_raw", """
SELECT sum(l_quantity) AS "sum(l_quantity)", min(l_extendedprice) AS "min(l_extendedprice)",
       max(l_discount) AS "max(l_discount)", count(l_orderkey) AS "count(l_orderkey)"
FROM lineitem
""")
def _agg_spec_raw(spark, sf):
    return agg_spec(table(spark, sf, "lineitem"), SPEC)


@query("agg_spec_positional", """
SELECT sum(l_quantity) AS col1, min(l_extendedprice) AS col2, max(l_discount) AS col3,
       count(l_orderkey) AS col4
FROM lineitem
""")
def _agg_spec_positional(spark, sf):
    return agg_spec(table(spark, sf, "lineitem"), SPEC, alias="positional")


@query("agg_spec_grouped", """
SELECT l_returnflag, sum(l_quantity) AS sum_l_quantity,
       min(l_extendedprice) AS min_l_extendedprice,
       max(l_extendedprice) AS max_l_extendedprice, round(avg(l_quantity), 6) AS avg_l_quantity,
       count(l_orderkey) AS count_l_orderkey
FROM lineitem GROUP BY l_returnflag
""")
def _agg_spec_grouped(spark, sf):
    spec = (
        "sum(l_quantity)|min(l_extendedprice)|max(l_extendedprice)|avg(l_quantity)"
        "|count(l_orderkey)"
    )
    out = agg_spec(table(spark, sf, "lineitem"), spec, alias="snake", group_by=["l_returnflag"])
    return out.withColumn("avg_l_quantity", F.round("avg_l_quantity", 6))


@query("agg_all_functions", """
SELECT event_type, round(sum(value), 2) AS sum_value, min(value) AS min_value,
       max(value) AS max_value, round(avg(value), 6) AS avg_value,
       count(value) AS count_value, arg_min(value, event_id) AS first_value,
       arg_max(value, event_id) AS last_value, round(stddev_samp(value), 6) AS stddev_value,
       round(var_samp(value), 4) AS variance_value
FROM events GROUP BY event_type
""")
def _agg_all_functions(spark, sf):
    names = ("sum", "min", "max", "avg", "count", "first", "last", "stddev", "variance")
    out = agg_spec(
        table(spark, sf, "events"), "|".join(f"{n}(value)" for n in names),
        alias="snake", group_by=["event_type"], order_by="event_id",
    )
    digits = {"sum_value": 2, "avg_value": 6, "stddev_value": 6, "variance_value": 4}
    return out.withColumns({n: F.round(n, d) for n, d in digits.items()})


@query("agg_attach", """
SELECT o_orderkey, o_orderstatus, t.*
FROM orders, (
  SELECT CAST(min(o_totalprice) AS DOUBLE) AS min_o_totalprice,
         CAST(max(o_totalprice) AS DOUBLE) AS max_o_totalprice,
         CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS sum_o_totalprice,
         CAST(count(o_custkey) AS DOUBLE) AS count_o_custkey
  FROM orders) t
""")
def _agg_attach(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_custkey", F.col("o_totalprice").cast(MONEY)
    )
    spec = "min(o_totalprice)|max(o_totalprice)|sum(o_totalprice)|count(o_custkey)"
    return agg_attach(orders, spec).drop("o_custkey", "o_totalprice")


@query("control_record", """
SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS VARCHAR) AS total,
       min(o_orderkey) AS min_key, max(o_custkey) AS max_cust,
       CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS VARCHAR) AS json_total,
       max(o_custkey) AS json_max_cust
FROM orders
""")
def _control_record(spark, sf):
    price = F.col("o_totalprice").cast(MONEY)
    orders = table(spark, sf, "orders").withColumn("o_totalprice", price)
    record = control_record(orders, "sum(o_totalprice)|min(o_orderkey)|max(o_custkey)")
    form = "array<struct<`sum(o_totalprice)`: decimal(25,2), `max(o_custkey)`: bigint>>"
    back = F.from_json("control_json", form)[0]
    return record.select(
        F.col("datacontrols")["sum(o_totalprice)"].cast("string").alias("total"),
        F.col("datacontrols")["min(o_orderkey)"].alias("min_key"),
        F.col("datacontrols")["max(o_custkey)"].alias("max_cust"),
        back["sum(o_totalprice)"].cast("string").alias("json_total"),
        back["max(o_custkey)"].alias("json_max_cust"),
    )


@query("pack_struct", """
SELECT o_orderkey, o_orderstatus AS packed_status, o_totalprice AS packed_price FROM orders
""")
def _pack_struct(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return pack_struct(orders).select(
        "o_orderkey",
        F.col("datacontrols.o_orderstatus").alias("packed_status"),
        F.col("datacontrols.o_totalprice").alias("packed_price"),
    )


@query("rows_to_json", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
""")
def _rows_to_json(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    form = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    back = F.from_json("value", form, {"mode": "FAILFAST"})
    return rows_to_json(orders).select(F.inline(F.array(back)))


@query("result_json_array", """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_l_quantity FROM lineitem GROUP BY ALL
""")
def _result_json_array(spark, sf):
    report = agg_spec(
        table(spark, sf, "lineitem"), "sum(l_quantity)", alias="snake",
        group_by=["l_returnflag", "l_linestatus"],
    )
    form = "l_returnflag string, l_linestatus string, sum_l_quantity double"
    lines = result_json_array(report).where("value not in ('[', ']')")
    record = F.from_json(F.ltrim("value", F.lit(",")), form, {"mode": "FAILFAST"})
    return lines.select(F.inline(F.array(record)))


@query("result_json_lines", """
SELECT '[' AS value UNION ALL SELECT ']'
UNION ALL
SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || '}' FROM orders
""")
def _result_json_lines(spark, sf):
    """Every order as a line of one array text, separators aside."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return result_json_array(orders).select(F.ltrim("value", F.lit(",")).alias("value"))


@query("spec_table", """
WITH s AS (
  SELECT p_partkey, unnest(string_split(
           'SUM(' || p_type || ')| min( size_' || p_size || ' )|' || p_name, '|')) AS item,
         unnest([0, 1, 2]) AS pos
  FROM part)
SELECT p_partkey, CAST(pos AS INTEGER) AS pos,
       CASE pos WHEN 0 THEN 'sum' WHEN 1 THEN 'min' END AS func,
       CASE WHEN pos < 2 THEN trim(regexp_extract(item, '\\(([^()]+)\\)', 1)) END AS "column",
       pos < 2 AS valid
FROM s
""")
def _spec_table(spark, sf):
    specs = table(spark, sf, "part").select(
        "p_partkey",
        F.format_string("SUM(%s)| min( size_%d )|%s", "p_type", "p_size", "p_name").alias("spec"),
    )
    return spec_items(specs)


@query("sql_view_agg", """
SELECT l_linestatus, max(l_extendedprice) AS max_price, count(*) AS n
FROM lineitem GROUP BY l_linestatus
""")
def _sql_view_agg(spark, sf):
    return spark.sql(
        "SELECT l_linestatus, max(l_extendedprice) AS max_price, count(*) AS n "
        "FROM {lines} GROUP BY l_linestatus",
        lines=table(spark, sf, "lineitem"),
    )


@query("filter_match", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
""")
def _filter_match(spark, sf):
    return match_fields(table(spark, sf, "orders"), o_orderstatus="F").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )
