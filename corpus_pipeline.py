"""Corpus pipeline: the stages that turn `documents` into packed training sequences.

Each stage is (spark, docs, sf_dir) -> DataFrame.  Between stages the rows are written to the
shared folder and read back; all but the last return the columns of `documents`.  A stage numbers
its rows (by file and row index, without a copy) and decides about each by that number, so null and
repeated identifiers are separate rows.  What a stage writes on the way goes when the next one begins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import quality
from tidepool.llm.decontaminate import find_contamination
from tidepool.llm.exact_dedup import exact_dedup
from tidepool.llm.near_dup import near_duplicates
from tidepool.llm.packing import pack_documents
from tidepool.llm.shared import ROW, delete, documents, id_and_text, keep_rows, materialise, numbered, read_from, recorded, smallest_rows
from tidepool.session import prepare, table_path


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: rejected documents go."""
    rows = numbered(docs)
    model = quality.train(id_and_text(docs), spark.read.parquet(table_path(sf_dir, "labels")))
    scored = quality.score(id_and_text(rows, ROW), model).where(F.col("score") >= quality.THRESHOLD)
    return keep_rows(rows, _by_row(scored))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact deduplication: one row of each text stays, that with the smallest identifier (null last)."""
    rows = numbered(docs)
    found = _by_row(exact_dedup(rows, ROW)).select(ROW, "keep_id")
    ids = rows.select(ROW, F.struct(F.col("doc_id").isNull(), "doc_id").alias("_doc_id"))
    return keep_rows(rows, smallest_rows(found.join(ids, ROW), "keep_id"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join, five words and a similarity of 0.8: one row of each group stays, that with the
    smallest identifier (null first)."""
    rows = numbered(docs)
    found = _by_row(near_duplicates(rows, ROW, words=5, percent=80)).select(ROW, "component_id")
    ids = rows.select(ROW, F.struct(F.col("doc_id").isNotNull(), "doc_id").alias("_doc_id"))
    return keep_rows(rows, smallest_rows(found.join(ids, ROW), "component_id"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a window of a test item go."""
    rows = numbered(docs)
    found = find_contamination(rows, spark.read.parquet(table_path(sf_dir, "benchmark")), ROW)
    return keep_rows(rows, _by_row(found.where("size(hit_words) = 0")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sum-of-squares packing of all remaining documents."""
    return pack_documents(docs)


def _by_row(found: DataFrame) -> DataFrame:
    """An operator's result over numbered rows; their number was its identifier."""
    return found.withColumnRenamed("doc_id", ROW)


_left: dict[tuple, list[str]] = {}  # folders of the stage before, by application and input


def _prepared(at: int, stage):
    """A stage that, before it begins, removes what its predecessor wrote on the way: the predecessor's
    result is `docs`, which is a written table by now.  A folder that `docs` reads is never removed."""

    def apply(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        run = spark.sparkContext.applicationId, sf_dir
        before = _left.pop((*run, at - 1), [])
        needed = read_from(docs) if before else []
        delete(spark, [p for p in before if not any(p in n or n in p for n in needed)])
        with recorded() as made:
            out = stage(spark, docs, sf_dir)
        _left[*run, at] = made
        return out

    apply.__name__, apply.__doc__ = stage.__name__, stage.__doc__
    return apply


STAGES = [(name, _prepared(i, stage)) for i, (name, stage) in enumerate([
    ("quality", drop_low_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
])]

#: Tokenisation and the learnt classifier cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = documents(prepare(spark), sf_dir), []
    for name, stage in STAGES[:-1]:
        with recorded() as made:
            docs = materialise(stage(spark, docs, sf_dir), name)
        delete(spark, written)  # the stage before has been read for the last time
        written = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
