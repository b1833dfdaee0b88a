"""Batch sources: Parquet tables, CSV, JSON, local rows, ranges, catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import table_path

# The given tables (fixed names of the test data set).
TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S3: one of the given Parquet tables; the schema comes from the footer."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_split(spark: SparkSession, path: str, max_partition_bytes: int, fmt: str = "parquet", schema: str | T.StructType | None = None) -> DataFrame:
    """A folder of files read in splits of at most so many bytes.  The setting lives in a session
    of its own, so other readers keep theirs."""
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.files.maxPartitionBytes", str(max_partition_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    reader = own.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` with its zone-less `ts` turned into a session-zone (UTC) timestamp.

    Watermarks and `window()` need TIMESTAMP, and the stored column is TIMESTAMP_NTZ; with the
    session zone at UTC the cast keeps the wall-clock value.
    """
    return read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def read_csv(spark: SparkSession, path: str, header: bool = True, schema: str | T.StructType | None = None,
             infer: bool = True) -> DataFrame:
    """CSV with a header and an inferred schema, or with a fixed DDL / StructType.

    `header` is always passed explicitly: with a fixed schema and no header option a header
    line would turn into a data row with NULL numbers.  Inference costs an extra pass over
    the data, so give a schema for anything large.
    """
    r = spark.read.option("header", header)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", infer).csv(path)


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Avro files, when the Avro data source is on the classpath.

    This environment has no Avro package; the call fails with a clear message instead of
    Spark's generic "data source not found".
    """
    try:
        return spark.read.format("avro").load(path)
    except Exception as e:  # noqa: BLE001
        if "avro" in str(e).lower() and ("not find" in str(e).lower() or "failed to find" in str(e).lower()):
            raise RuntimeError("the Avro data source is not installed; add the spark-avro package "
                               "or convert the files to Parquet") from e
        raise


def read_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """JSON lines, inferred (S10) or with a fixed schema."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def json_drift(spark: SparkSession, path: str, known: T.StructType) -> list[str]:
    """Paths of fields, at any depth, that lines of the JSON files have and `known` lacks (bounded: a
    schema).  The lines are read as text and parsed once, into VARIANT."""
    from tidepool.streaming.variant import against, field_counts

    found = against(field_counts(spark.read.text(path)), known).where("status = 'unknown_field'")
    return sorted(r.path.removeprefix("$.") for r in found.select("path").distinct().collect())


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """Local rows with column names or a DDL string."""
    return spark.createDataFrame(rows, schema)


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table with a given (for example a stream's) schema."""
    return spark.createDataFrame([], schema)


def id_range(spark: SparkSession, n: int, name: str = "id", partitions: int | None = None) -> DataFrame:
    """Integers 0 .. n-1."""
    return spark.range(0, n, numPartitions=partitions).withColumnRenamed("id", name)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by short or 3-part name."""
    return spark.table(name)


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Lineage columns from the hidden `_metadata` column of a file scan."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file_path"),
        F.col("_metadata.file_name").alias("_file_name"),
        F.col("_metadata.file_size").alias("_file_size"),
        F.col("_metadata.file_block_start").alias("_file_block_start"),
        F.col("_metadata.file_block_length").alias("_file_block_length"),
        F.col("_metadata.file_modification_time").alias("_file_mtime"),
    )
