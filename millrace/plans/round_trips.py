"""Queries that write a table in a format and read it back through the configured reader."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.documents import run_pipeline
from millrace.operators.sinks import write_csv
from millrace.plans.registry import query, table
from millrace.session import scratch_path
from millrace.sources.readers import read_source
from millrace.sources.xml import read_xml_split

# A reader cannot split XML, so elements are dealt out to as many tasks as a shuffle has, and
# files are bounded to some 64 MB for the next reader's tasks.
FILE_BYTES, ELEMENT_BYTES = 64 << 20, 512
MAX_RECORDS = FILE_BYTES // ELEMENT_BYTES

ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       strftime(o_orderdate, '%Y-%m-%d') AS order_day
FROM orders
"""


def _orders_out(df):
    return df.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
    )


@query("read_csv_roundtrip", ORDERS_SQL)
def _read_csv_roundtrip(spark, sf):
    orders, path = table(spark, sf, "orders"), scratch_path(spark, "csv")
    write_csv(orders, path, quote='"', escape="\\")
    back = read_source(
        spark, "csv", path, orders.schema, header=True, delimiter=",", quote='"', escape="\\",
        encoding="UTF-8", mode="FAILFAST",
    )
    return _orders_out(back)


@query("read_json_roundtrip", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
""")
def _read_json_roundtrip(spark, sf):
    part, path = table(spark, sf, "part"), scratch_path(spark, "json")
    part.write.json(path)
    return read_source(
        spark, "json", path, part.schema, mode="FAILFAST", allowUnquotedFieldNames=True
    )


@query("read_orc_roundtrip", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def _read_orc_roundtrip(spark, sf):
    path = scratch_path(spark, "orc")
    table(spark, sf, "customer").write.orc(path)
    return read_source(spark, "orc", path, mergeSchema=False, pathGlobFilter="*.orc")


@query("read_parquet_merge", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS o_custkey
FROM orders
""")
def _read_parquet_merge(spark, sf):
    orders, root = table(spark, sf, "orders"), scratch_path(spark, "merge")
    is_f = F.col("o_orderstatus") == "F"
    orders.where(is_f).select("o_orderkey", "o_totalprice").write.parquet(f"{root}/form=1")
    orders.where(~is_f).select("o_orderkey", "o_custkey").write.parquet(f"{root}/form=2")
    return read_source(spark, "parquet", root, mergeSchema=True).select(
        "o_orderkey", "o_totalprice", "o_custkey"
    )


@query("read_glob_recursive", ORDERS_SQL)
def _read_glob_recursive(spark, sf):
    orders, root = table(spark, sf, "orders"), scratch_path(spark, "tree")
    orders.withColumn("status", F.col("o_orderstatus")).write.partitionBy("status").parquet(
        f"{root}/data"
    )
    # Files of another kind in the same tree, which the glob leaves aside.
    orders.select("o_orderkey").write.csv(f"{root}/data/other")
    back = read_source(
        spark, "parquet", root, orders.schema, recursiveFileLookup=True,
        pathGlobFilter="*.parquet",
    )
    return _orders_out(back)


@query("read_xml_roundtrip", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def _read_xml_roundtrip(spark, sf):
    supplier, path = table(spark, sf, "supplier"), scratch_path(spark, "xml")
    spread = supplier.repartition("s_suppkey")
    spread.write.option("rowTag", "supplier").option("rootTag", "suppliers").option(
        "maxRecordsPerFile", MAX_RECORDS
    ).xml(path)
    return read_source(spark, "xml", path, supplier.schema, rowTag="supplier", mode="FAILFAST")


@query("read_xml_nested_attrs", """
SELECT o_orderkey AS order_id, o_orderstatus AS status, c_name AS customer,
       unnest(['price', 'priority']) AS item_name,
       unnest([CAST(o_totalprice AS VARCHAR), o_orderpriority]) AS item_value
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def _read_xml_nested_attrs(spark, sf):
    """Orders as elements with attributes, the customer, and a nested list of items."""
    path = scratch_path(spark, "xml-nested")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    item = F.array(
        F.struct(
            F.lit("price").alias("name"), F.col("o_totalprice").cast("string").alias("value")
        ),
        F.struct(F.lit("priority").alias("name"), F.col("o_orderpriority").alias("value")),
    )
    elements = (
        table(spark, sf, "orders")
        .join(customer, "o_custkey")
        .select(
            F.col("o_orderkey").alias("_id"),
            F.col("o_orderstatus").alias("_status"),
            F.col("c_name").alias("customer"),
            F.struct(item.alias("item")).alias("items"),
        )
    )
    elements.repartition("_id").write.option("rowTag", "order").option("rootTag", "orders").option(
        "maxRecordsPerFile", MAX_RECORDS
    ).xml(path)
    back = read_source(
        spark, "xml", path, elements.schema, rowTag="order", attributePrefix="_",
        valueTag="_VALUE", mode="FAILFAST",
    )
    return back.select(
        F.col("_id").alias("order_id"), F.col("_status").alias("status"), "customer",
        F.inline("items.item").alias("item_name", "item_value"),
    )


@query("read_xml_split", """
SELECT o_orderkey AS _id, o_orderstatus AS _status, CASE WHEN o_orderkey % 7 <> 3 THEN o_totalprice END AS price,
       CASE WHEN o_orderkey % 7 = 3 THEN NULL WHEN o_orderkey % 100 = 1 THEN 'see </order> of ' || o_custkey
            ELSE o_orderpriority END AS note
FROM orders
""")
def _read_xml_split(spark, sf):
    """Orders as XML text with comments, CDATA sections that hold closing tags, and empty elements, read in splits."""
    path = scratch_path(spark, "xml-split")
    key = F.col("o_orderkey")
    head = F.concat(F.lit('<order id="'), key, F.lit("\" status='"), "o_orderstatus", F.lit("'"))
    note = F.when(key % 100 == 1, F.concat(F.lit("<![CDATA[see </order> of "), "o_custkey", F.lit("]]>"))).otherwise(F.col("o_orderpriority"))
    body = F.concat(head, F.lit("><price>"), "o_totalprice", F.lit("</price><note>"), note, F.when(key % 2 == 0, "</note></order>").otherwise("</note></order >"))
    text = F.when(key % 7 == 3, F.concat(head, F.lit(" />"))).otherwise(body)
    text = F.when(key % 50 == 2, F.concat(F.lit("<!-- no <order> here </order> -->\n<batch>"), text, F.lit("</batch>"))).otherwise(text)
    table(spark, sf, "orders").select(text.alias("value")).write.text(path)
    schema = T.StructType.fromDDL("_id bigint, _status string, price double, note string")
    return read_xml_split(spark, path, schema, rowTag="order", mode="FAILFAST")


PIPELINE = """[
  {"$match": {"$and": [
    {"customer.balance": {"$gt": 500}}, {"status": {"$in": ["F", "O"]}},
    {"$or": [{"priority": {"$regex": "^1|urgent", "$options": "i"}}, {"customer.segment": "BUILDING", "total": {"$lt": 100000}}, {"note": null}]},
    {"missing.field": {"$exists": false}}, {"note": {"$ne": "late"}}
  ]}},
  {"$project": {"status": 1, "customer.segment": 1, "total": 1, "who": "$customer.name"}}
]"""


@query("document_pipeline", """
SELECT o_orderkey AS _id, o_orderstatus AS status, o_totalprice AS total, c_mktsegment AS segment, c_name AS who
FROM (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN 'late' WHEN 1 THEN 'early' WHEN 2 THEN 'x' WHEN 3 THEN 'y' END AS note
      FROM orders JOIN customer ON o_custkey = c_custkey)
WHERE c_acctbal > 500 AND o_orderstatus IN ('F', 'O') AND (note IS NULL OR note <> 'late')
  AND (regexp_matches(o_orderpriority, '^1|urgent', 'i') OR c_mktsegment = 'BUILDING' AND o_totalprice < 100000 OR note IS NULL)
""")
def _document_pipeline(spark, sf):
    """Orders stored as nested documents, selected and projected by a document pipeline."""
    path = scratch_path(spark, "documents")
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")).alias("customer"),
    )
    notes = F.element_at(F.array(F.lit("late"), F.lit("early"), F.lit("x"), F.lit("y"), F.lit(None)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    table(spark, sf, "orders").join(customer, "o_custkey").select(
        F.col("o_orderkey").alias("_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("total"), "customer", notes.alias("note"), F.lit("never read").alias("comment"),
    ).write.parquet(path)
    found = run_pipeline(spark.read.parquet(path), PIPELINE)
    return found.select("_id", "status", "total", "customer.segment", "who")
