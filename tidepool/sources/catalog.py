"""Catalog and table DDL.

Plain Spark SQL / catalog API calls.  Tables are Parquet (`USING PARQUET`); a database can
be given its own location (K14), and table inventories are DataFrames.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if missing, optionally at its own location."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def drop_database(spark: SparkSession, name: str, cascade: bool = True) -> None:
    """Drop a database (and, with cascade, its tables and their files)."""
    spark.sql(f"DROP DATABASE IF EXISTS {name}{' CASCADE' if cascade else ''}")


def create_table(spark: SparkSession, name: str, ddl: str, location: str | None = None) -> None:
    """An empty Parquet table from a column DDL string."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING PARQUET{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists (a managed table's files go with it)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def save_table(df: DataFrame, name: str, files: int | None = None, mode: str = "overwrite",
               max_records_per_file: int | None = None) -> None:
    """Write a managed Parquet table, optionally with a chosen file count
    (`repartition`) or a cap on rows per output file."""
    out = df.repartition(files) if files else df
    w = out.write.mode(mode).format("parquet")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.saveAsTable(name)


def create_or_replace(df: DataFrame, name: str) -> None:
    """K3: create or replace through the V2 write path (`writeTo`).

    The session catalog cannot REPLACE a Parquet table atomically, and `df` may read the table it
    replaces, so the new table is written in full under a name of its own first; only then is the
    old one dropped and the new one renamed.  A failing write leaves the old table as it was.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.writeTo(name).using("parquet").create()
        return
    new = f"{name}__new_{uuid.uuid4().hex[:8]}"
    try:
        df.writeTo(new).using("parquet").create()
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    spark.catalog.refreshTable(name)


def table_inventory(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of a database with provider, type and location."""
    db = database or spark.catalog.currentDatabase()
    names = [t.name for t in spark.catalog.listTables(db)]  # catalog metadata, not data
    rows = []
    for n in names:
        info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.{n}").collect()
                if r[0] in ("Provider", "Type", "Location")}
        rows.append((db, n, info.get("Provider"), info.get("Type"), info.get("Location")))
    return spark.createDataFrame(rows, "database string, table string, provider string, type string, location string")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def catalogs(spark: SparkSession) -> DataFrame:
    """Registered catalogs and databases."""
    cats = [c.name for c in spark.catalog.listCatalogs()]
    dbs = [d.name for d in spark.catalog.listDatabases()]
    return spark.createDataFrame([(c, None) for c in cats] + [(spark.catalog.currentCatalog(), d) for d in dbs],
                                 "catalog string, database string")


def table_location(spark: SparkSession, name: str) -> str:
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == "Location").first()
    return loc[1] if loc else None
