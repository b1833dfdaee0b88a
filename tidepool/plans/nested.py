"""P13 on nested rows: orders written as nested records with one schema, read with a later one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.schema_resolution import read_as, spark_type
from tidepool.session import work_dir
from tidepool.sources.tables import read_table

_STATUS = {"type": "enum", "name": "Status", "symbols": ["F", "O", "P"]}
_LINE = {"type": "record", "name": "Line", "fields": [
    {"name": "supplier", "type": "int"}, {"name": "quantity", "type": "int"}, {"name": "note", "type": ["null", "string"]}]}

WRITER = {"type": "record", "name": "Order", "fields": [
    {"name": "key", "type": "int"}, {"name": "status", "type": _STATUS}, {"name": "price", "type": ["null", "float"]},
    {"name": "ref", "type": ["null", "int", "string"]}, {"name": "lines", "type": {"type": "array", "items": _LINE}},
    {"name": "by_month", "type": {"type": "map", "values": "int"}}, {"name": "dropped", "type": "string"}]}

#: Later: a key renamed and widened, a status fewer, lines with another name, a default and a field less.
READER = {"type": "record", "name": "Order", "fields": [
    {"name": "order_key", "aliases": ["key"], "type": "long"},
    {"name": "status", "type": _STATUS | {"symbols": ["F", "O", "OTHER"], "default": "OTHER"}},
    {"name": "price", "type": ["null", "double"]}, {"name": "ref", "type": ["string", "long", "null"]},
    {"name": "lines", "type": {"type": "array", "items": {"type": "record", "name": "Item", "aliases": ["Line"], "fields": [
        {"name": "n", "aliases": ["quantity"], "type": "double"}, {"name": "supplier", "type": ["null", "long"]},
        {"name": "unit", "type": "string", "default": "piece"}]}}},
    {"name": "by_month", "type": {"type": "map", "values": "long"}},
    {"name": "origin", "type": {"type": "record", "name": "Origin", "fields": [{"name": "system", "type": "string"}, {"name": "level", "type": "int", "default": 2}]},
     "default": {"system": "import"}}]}


def resolved_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines as nested records in the writer's schema, read with the reader's."""
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_suppkey").cast("int").alias("supplier"), F.col("l_quantity").cast("int").alias("quantity"),
        F.when(F.col("l_linenumber") == 1, F.lit("first")).alias("note"))).alias("lines"))  # a few lines an order
    o = read_table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    key = F.col("o_orderkey").cast("int")
    ref = F.when(key % 3 == 0, F.struct(key.alias("member0"), F.lit(None).cast("string").alias("member1"))).when(
        key % 3 == 1, F.struct(F.lit(None).cast("int").alias("member0"), F.concat(F.lit("r"), key.cast("string")).alias("member1")))
    rows = o.select(key.alias("key"), F.col("o_orderstatus").alias("status"), F.when(key % 5 > 0, key.cast("float")).alias("price"), ref.alias("ref"),
                    F.coalesce("lines", F.array().cast(spark_type(WRITER)["lines"].dataType)).alias("lines"),
                    F.create_map(F.month("o_orderdate").cast("string"), key % 7).alias("by_month"), F.lit("x").alias("dropped"))
    path = f"{work_dir(spark, 'nested')}/orders"
    rows.write.parquet(path)
    r = read_as(spark.read.parquet(path), WRITER, READER)
    total = F.aggregate("lines", F.lit(0.0), lambda a, x: a + x.n)
    month = F.map_entries("by_month")[0]
    return r.select("order_key", "status", "price", F.col("ref.member0").alias("ref_text"), F.col("ref.member1").alias("ref_number"),
                    F.size("lines").cast("long").alias("n_lines"), total.alias("quantity"), F.array_min("lines.supplier").alias("first_supplier"),
                    F.array_max("lines.unit").alias("unit"), month.key.alias("month"), month.value.alias("month_value"),
                    F.concat("origin.system", F.lit("/"), F.col("origin.level").cast("string")).alias("origin"))


NESTED_SQL = {
    "resolved_nested": """
WITH l AS (SELECT l_orderkey, count(*) AS n, sum(CAST(trunc(l_quantity) AS INTEGER))::DOUBLE AS q, min(l_suppkey) AS s FROM lineitem GROUP BY 1)
SELECT o_orderkey AS order_key, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus ELSE 'OTHER' END AS status,
       CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey::DOUBLE END AS price, CASE WHEN o_orderkey % 3 = 1 THEN 'r' || o_orderkey END AS ref_text,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS ref_number, coalesce(n, 0) AS n_lines, coalesce(q, 0.0)::DOUBLE AS quantity, s AS first_supplier,
       CASE WHEN n > 0 THEN 'piece' END AS unit, CAST(month(o_orderdate) AS VARCHAR) AS month, (o_orderkey % 7)::BIGINT AS month_value, 'import/2' AS origin
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey
""",
}
