"""Queries of the shape, JSON, text, decimal and warehouse operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.decimals import (
    bytes_to_decimal,
    convert_decimal_fields,
    json_bytes_to_decimal,
)
from millrace.functions.text import (
    inject_before_close,
    json_struct,
    strip_and_parse,
    strip_markup,
)
from millrace.operators.shapes import (
    cast_columns,
    entries_to_rows,
    flatten,
    maps_to_entries,
    maps_to_json,
    rewrite_by_type,
)
from millrace.operators.warehouse import conform
from millrace.plans.registry import query, table
from millrace.sources.readers import branch_frame
from millrace.sources.schemas import infer_json_schema

K_SQL = "CAST(json_extract(props, '$.k') AS BIGINT)"


def _customer_geo(spark, sf):
    """Customers with their nation packed to a struct, the region nested in it."""
    nation = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "n_nationkey",
            F.struct(
                F.col("n_name").alias("name"),
                F.struct(
                    F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")
                ).alias("region"),
            ).alias("nation"),
        )
    )
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "nation")
    )


@query("project_struct_star", """
SELECT c_custkey, n_name AS name, r_name AS region_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def _project_struct_star(spark, sf):
    return (
        _customer_geo(spark, sf)
        .select("c_custkey", "nation.*")
        .select("c_custkey", "name", F.col("region.name").alias("region_name"))
    )


@query("flatten_struct", """
SELECT c_custkey, n_name AS nation_name, r_regionkey AS nation_region_key,
       r_name AS nation_region_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def _flatten_struct(spark, sf):
    return flatten(_customer_geo(spark, sf))


@query("cast_columns", """
SELECT p_partkey, p_name, CAST(p_size AS DOUBLE) AS size_double,
       TRY_CAST(substring(p_brand, 7) AS DOUBLE) AS brand_double,
       CAST(NULL AS DOUBLE) AS name_double
FROM part
""")
def _cast_columns(spark, sf):
    raw = table(spark, sf, "part").select(
        "p_partkey",
        F.encode("p_name", "UTF-8").alias("p_name"),
        F.col("p_size").alias("size_double"),
        F.substring("p_brand", 7, 9).alias("brand_double"),
        F.col("p_name").alias("name_double"),
    )
    out = cast_columns(raw, {"p_name": "string", "size_double": "double"})
    return cast_columns(out, {"brand_double": "double", "name_double": "double"}, strict=False)


@query("rewrite_by_type", """
SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)
         AS l_extendedprice,
       CAST(CAST(l_discount AS DECIMAL(12,2)) AS VARCHAR) AS l_discount, l_returnflag
FROM lineitem
""")
def _rewrite_by_type(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag"
    )
    as_decimal = rewrite_by_type(lines, {T.DoubleType: lambda c, _: c.cast("decimal(12,2)")})
    return rewrite_by_type(as_decimal, {T.DecimalType: lambda c, _: c.cast("string")})


@query("branch_schema", """
SELECT 'orders' AS kind, o_orderkey AS x, o_custkey AS y FROM orders
UNION ALL SELECT 'lineitem', l_orderkey, l_partkey FROM lineitem
""")
def _branch_schema(spark, sf):
    """The columns of a table decide which record kind is read; either kind is."""
    def records(name):
        rows = table(spark, sf, name)
        return branch_frame(
            spark,
            "l_orderkey" in rows.columns,
            lambda: rows.selectExpr("'lineitem' kind", "l_orderkey x", "l_partkey y"),
            lambda: rows.selectExpr("'orders' kind", "o_orderkey x", "o_custkey y"),
        )

    return records("orders").unionByName(records("lineitem"))


@query("infer_json_strings", f"SELECT event_id, {K_SQL} AS k FROM events")
def _infer_json_strings(spark, sf):
    events = table(spark, sf, "events").select("event_id", "props")
    schema = infer_json_schema(events, "props")
    return events.select("event_id", json_struct("props", schema)["k"].alias("k"))


@query("from_json_struct", f"""
SELECT event_id, {K_SQL} AS k, CAST({K_SQL} AS VARCHAR) AS k_text FROM events
""")
def _from_json_struct(spark, sf):
    events = table(spark, sf, "events")
    as_number = json_struct("props", "k bigint")
    as_text = json_struct("props", "k string")
    return events.select("event_id", as_number["k"].alias("k"), as_text["k"].alias("k_text"))


@query("dynamic_schema", """
SELECT o_orderkey, o_totalprice AS price, o_custkey AS cust,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS status
FROM orders
""")
def _dynamic_schema(spark, sf):
    """Records whose fields and number types differ by row."""
    orders = table(spark, sf, "orders")
    price = F.col("o_totalprice").alias("sum(price)")
    cust = F.col("o_custkey").alias("min(cust)")
    whole = F.to_json(F.struct(price, cust, F.col("o_orderstatus").alias("max(status)")))
    records = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, whole).otherwise(F.to_json(F.struct(cust, price))).alias("record"),
    )
    schema = infer_json_schema(records, "record")
    return records.select("o_orderkey", json_struct("record", schema).alias("r")).select(
        "o_orderkey",
        F.col("r")["sum(price)"].cast("double").alias("price"),
        F.col("r")["min(cust)"].alias("cust"),
        F.col("r")["max(status)"].alias("status"),
    )


def _events_with_map(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.from_json("props", "map<string,int>").alias("m")
    )


@query("map_to_json", f"SELECT event_id, {K_SQL} AS k FROM events")
def _map_to_json(spark, sf):
    return maps_to_json(_events_with_map(spark, sf)).select(
        "event_id", F.get_json_object("m", "$.k").cast("bigint").alias("k")
    )


@query("map_to_entries", f"""
SELECT event_id, 'k' AS "key", CAST({K_SQL} AS INTEGER) AS value FROM events
""")
def _map_to_entries(spark, sf):
    return entries_to_rows(maps_to_entries(_events_with_map(spark, sf)), "m", "event_id")


# The schema of an article's attribute document.
ARTICLE = (
    "MegaAttributes struct<lastUpdateUser: string, lastUpdateTimestamp: string, "
    "renderAsTable: string, tableTitle: string, attributes: array<struct<>>>, "
    "SourceArticleAttributes struct<lastUpdateUser: string, lastUpdateTimestamp: string, "
    "renderAsTable: string, attributes: array<struct<key: string, value: string>>>"
)
ARTICLE_TEXT = (
    '<p>{"MegaAttributes": {"lastUpdateUser": "%1$s", "renderAsTable": "false", '
    '"tableTitle": "MegaAttributes", "attributes": []}, "SourceArticleAttributes": '
    '{"lastUpdateUser": "%1$s", "renderAsTable": "false", "attributes": ['
    '{"key": "itemNumber", "value": %2$d}, {"key": "itemTongue", "value": "%3$s"}, '
    '{"key": "itemParent", "value": ""}, '
    '{"key": "itemSizes", "value": [%4$d]}]}}</p>'
)


@query("article_attributes", """
SELECT doc_id, source AS last_user, unnest(['itemNumber', 'itemTongue',
                       'itemParent', 'itemSizes']) AS "key",
       unnest([CAST(doc_id AS VARCHAR), lang, '', '[' || n_chars || ']']) AS value
FROM documents
""")
def _article_attributes(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.format_string(ARTICLE_TEXT, "source", "doc_id", "lang", "n_chars").alias("json_data"),
    )
    clean = strip_and_parse(docs, "json_data")
    parsed = clean.select("doc_id", json_struct("json_data", ARTICLE).alias("a")).select(
        "doc_id",
        F.col("a.MegaAttributes.lastUpdateUser").alias("last_user"),
        F.col("a.SourceArticleAttributes.attributes").alias("attributes"),
    )
    return entries_to_rows(parsed, "attributes", "doc_id", "last_user")


@query("strip_html", """
SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS text FROM pages
""")
def _strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", strip_markup("html").alias("text"))


@query("strip_and_parse_json", f"""
SELECT event_id, CASE WHEN value < 100 THEN {K_SQL} END AS k, value < 100 AS parsed FROM events
""")
def _strip_and_parse_json(spark, sf):
    broken = F.when(F.col("value") >= 100, "'").otherwise("")
    docs = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("<p>"), broken, "props", F.lit("</p>")).alias("doc")
    )
    return strip_and_parse(docs, "doc").select(
        "event_id",
        F.get_json_object("doc", "$.k").cast("bigint").alias("k"),
        F.col("doc_ok").alias("parsed"),
    )


@query("xml_inject", """
SELECT c_custkey,
       replace('<employees><employee><id>' || c_custkey || '</id></employee><employee><name>'
         || c_name || '</name></employee></employees>', '</employee>',
         '<company>acme</company></employee>') AS xml
FROM customer
""")
def _xml_inject(spark, sf):
    text = F.format_string(
        "<employees><employee><id>%d</id></employee><employee><name>%s</name></employee>"
        "</employees>", "c_custkey", "c_name",
    )
    fragment = "<company>acme</company>"
    return table(spark, sf, "customer").select(
        "c_custkey", inject_before_close(text, "employee", fragment).alias("xml")
    )


def _balance_hex():
    """A balance in cents as 16 hex digits of two's complement."""
    return F.lpad(F.hex(F.round(F.col("c_acctbal") * 100).cast("bigint")), 16, "0")


@query("bytes_to_decimal", """
SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS from_8_bytes,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS from_12_bytes,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS from_20_bytes
FROM customer
""")
def _bytes_to_decimal(spark, sf):
    cents = _balance_hex()
    fill = F.when(F.col("c_acctbal") < 0, "FFFFFFFF").otherwise("00000000")
    raw = table(spark, sf, "customer").select(
        "c_custkey", F.unhex(cents).alias("b8"), F.unhex(F.concat(fill, cents)).alias("b12"),
        F.unhex(F.concat(fill, fill, fill, cents)).alias("b20"),
    )
    return raw.select(
        "c_custkey",
        bytes_to_decimal("b8", 38, 2).cast("string").alias("from_8_bytes"),
        bytes_to_decimal("b12", 38, 2).cast("string").alias("from_12_bytes"),
        bytes_to_decimal("b20", 38, 2).cast("string").alias("from_20_bytes"),
    )


BALANCE_SCHEMA = """
{"type": "record", "name": "Balance", "fields": [
  {"name": "name", "type": "string"},
  {"name": "balance", "type": ["null",
    {"type": "bytes", "logicalType": "decimal", "precision": 18, "scale": 2}]}]}
"""


@query("convert_decimal_fields", """
SELECT c_custkey, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance_in_place
FROM customer
""")
def _convert_decimal_fields(spark, sf):
    decoded = table(spark, sf, "customer").select(
        "c_custkey",
        F.struct(
            F.col("c_name").alias("name"), F.unhex(_balance_hex()).alias("balance")
        ).alias("avroData"),
    )
    beside = convert_decimal_fields(decoded, BALANCE_SCHEMA)
    return convert_decimal_fields(beside, BALANCE_SCHEMA, in_place=True).select(
        "c_custkey",
        "avroData.name",
        F.col("balance").cast("string").alias("balance"),
        F.col("avroData.balance").cast("string").alias("balance_in_place"),
    )


@query("json_bytes_to_decimal", """
SELECT c_custkey,
       CASE WHEN c_custkey % 7 > 0 THEN '{"Message":{"ApplicationNumber":"' || c_custkey
         || '","DebtRatio":"' || CAST(c_acctbal AS DECIMAL(18,2)) || '","Extra":"'
         || c_mktsegment || '"},"Top":' || c_nationkey || '}' END AS doc,
       c_custkey % 7 > 0 AS doc_ok
FROM customer
""")
def _json_bytes_to_decimal(spark, sf):
    """Messages with further fields, one in seven of them broken off."""
    message = F.to_json(F.struct(
        F.struct(
            F.col("c_custkey").cast("string").alias("ApplicationNumber"),
            F.struct(
                F.decode(F.unhex(_balance_hex()), "ISO-8859-1").alias("bytes")
            ).alias("DebtRatio"),
            F.col("c_mktsegment").alias("Extra"),
        ).alias("Message"),
        F.col("c_nationkey").alias("Top"),
    ))
    broken = F.substring(message, F.lit(1), F.length(message) - 1)
    doc = F.when(F.col("c_custkey") % 7 > 0, message).otherwise(broken)
    return json_bytes_to_decimal(table(spark, sf, "customer").select("c_custkey", doc.alias("doc")), "doc")


@query("warehouse_conform", """
SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, p_retailprice,
       CAST(CAST(p_retailprice AS DECIMAL(20,10)) AS VARCHAR) AS wide_price,
       CAST(p_size AS VARCHAR) AS short_size, base64(encode(p_name)) AS name_bytes,
       p_brand AS map_key, CAST(p_size AS BIGINT) AS map_value
FROM part
""")
def _warehouse_conform(spark, sf):
    frame = table(spark, sf, "part").select(
        "p_partkey",
        "p_size",
        "p_retailprice",
        F.col("p_retailprice").cast("decimal(20,10)").alias("wide_price"),
        F.col("p_size").cast("smallint").alias("short_size"),
        F.encode("p_name", "UTF-8").alias("name_bytes"),
        F.create_map("p_brand", "p_size").alias("m"),
    )
    fitted = conform(frame)
    plain = [c for c in fitted.columns if c != "m"]
    return fitted.select(*plain, F.inline("m").alias("map_key", "map_value"))
