"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.joins import maybe_broadcast
from tidepool.session import folder, table_path, work_dir


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{work_dir(df.sparkSession, 'llm')}/{name}"
    for made in _recorders:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents"))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under its own names; null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


ROW = "_stage_row"
FILE_ROWS = 1 << 36  # rows that one file may have (and 2^27 files): a file's number times this is where its rows begin


def numbered(docs: DataFrame) -> DataFrame:
    """ROW (a number for each row), doc_id, text, and `_doc`, all columns of `docs` under one name, so that
    none can clash.  A scanned table is numbered by file and row index, which no retry or other split of
    the scan changes; anything else is written once with its numbers."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    places = None if "_metadata" in docs.columns else _places(docs, whole)
    if places is None:
        rows = materialise(docs.select(F.monotonically_increasing_id().alias(ROW), whole), "numbered")
        return rows.select(ROW, "_doc.doc_id", "_doc.text", "_doc")
    names = places.select("_file").distinct().repartition(1).sortWithinPartitions("_file")  # names of files only
    files = materialise(names.select("_file", F.monotonically_increasing_id().alias("_number")), "files")
    rows = places.join(maybe_broadcast(files, 1_000_000), "_file")
    number = F.col("_number") * FILE_ROWS + F.col("_index")
    return rows.select(number.alias(ROW), "_doc.doc_id", "_doc.text", "_doc")


def _places(docs: DataFrame, whole: Column) -> DataFrame | None:
    """`whole` with the file and the row index of each row, if `docs` is a plain scan of files."""
    try:
        return docs.select(whole, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    except AnalysisException:
        return None


def smallest_rows(rows: DataFrame, group: str) -> DataFrame:
    """Of the rows ROW, _doc_id and `group`, the one of each group with the smallest identifier; equal ones
    are told apart by ROW.  Minima are combined map-side, so a large group is never gathered."""
    return rows.groupBy(group).agg(F.min(F.struct("_doc_id", ROW)).alias("best")).select(F.col(f"best.{ROW}").alias(ROW))


def keep_rows(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of a numbered table whose number is in `kept`, with the columns that they had.  The numbers
    are written, and sent to the rows if they are few enough (checked); else both are shuffled."""
    kept = materialise(kept.select(ROW), "kept")
    return rows.select(ROW, "_doc").join(maybe_broadcast(kept, 1_000_000), ROW, "left_semi").select("_doc.*")


_recorders: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that `materialise` makes meanwhile."""
    made: list[str] = []
    _recorders.append(made)
    try:
        yield made
    finally:
        _recorders.pop()


def read_from(df: DataFrame) -> list[str]:
    """The folders that a DataFrame's scans read (their roots)."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName() == "LogicalRelation":
            roots.append(leaf.relation().location().rootPaths().mkString("\n"))
    return "\n".join(roots).split("\n")


def delete(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        fs, at = folder(spark, p)
        fs.delete(at, True)
