"""Operator 1, exact deduplication by content sort (DataFrame functions only).

Normalised texts are range-partitioned by sampled splitters (Spark samples the key: the first
bytes of the text, then a digest that separates texts with a common beginning), each partition
is sorted externally, so that equal texts are neighbours, and the window operator compares each
text in full with its neighbour.  The smallest identifier of each run of equal texts stays.

Hot groups: digests held by more than `max(256, rows / 50,000)` rows are found first from a
count that is combined map-side; there are at most 50,000 of them by construction, so that list
is broadcast.  Their rows are spread over up to 4,096 salts by identifier; each salt yields one
head, and the heads of one text (full comparison again) are merged in a second small step.

Defined cases: null text is the empty text; null identifiers sort last, so such a row stays only
if its group has no other; rows repeated with the same identifier and text count one by one in
`group_size`, and one of them stays; an empty table gives an empty result; other columns are
never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm.shared import documents, id_and_text, materialise

HOT_ROWS = 256
HOT_SHARE = 50_000  # at most so many hot texts, whatever the input
MAX_SALTS = 4096


def normalised(text: Column) -> Column:
    """Each run of x20, x09-x0D becomes one space (runs that are one space already are left)."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    base = id_and_text(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("norm"))
    base = base.withColumn("digest", F.xxhash64("norm"))
    threshold = max(HOT_ROWS, docs.count() // HOT_SHARE)
    hot = (base.groupBy("digest").count().where(F.col("count") > threshold)
           .select("digest", F.least(F.ceil(F.col("count") / HOT_ROWS), F.lit(MAX_SALTS)).alias("salts")))
    rows = base.join(F.broadcast(hot), "digest", "left").select(
        "doc_id", "norm", "digest", F.substring("norm", 1, 32).alias("start"),
        F.coalesce(F.col("salts"), F.lit(0)).alias("salts"),
        F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("salts"))).otherwise(F.lit(0)).alias("salt"))
    equal = W.partitionBy("start", "digest", "salt", "norm")
    first = F.row_number().over(equal.orderBy(F.col("doc_id").asc_nulls_last()))
    runs = (rows.repartitionByRange("start", "digest", "salt")
            .withColumn("place", first)
            .withColumn("head", F.min("doc_id").over(equal))
            .withColumn("n", F.count(F.lit(1)).over(equal)))
    runs = materialise(runs.select(
        "doc_id", "digest", "salts", "salt", "place", "head", "n", F.sha2("norm", 256).alias("text_sha256"),
        F.when((F.col("place") == 1) & (F.col("salts") > 0), F.col("norm")).alias("head_text")), "runs")
    whole = W.partitionBy("head_text")
    heads = (runs.where(F.col("head_text").isNotNull())
             .withColumn("keep_id", F.min("head").over(whole))
             .withColumn("group_size", F.sum("n").over(whole))
             .withColumn("lead", F.row_number().over(whole.orderBy(F.col("head").asc_nulls_last())) == 1)
             .select(F.col("digest").alias("d"), F.col("salt").alias("s"), F.col("text_sha256").alias("t"),
                     "keep_id", "group_size", "lead"))
    cold = runs.where(F.col("salts") == 0).select(
        "doc_id", F.col("head").alias("keep_id"), F.col("n").alias("group_size"), (F.col("place") == 1).alias("kept"), "text_sha256")
    split = (runs.where(F.col("salts") > 0)
             .join(heads, (F.col("digest") == F.col("d")) & (F.col("salt") == F.col("s")) & (F.col("text_sha256") == F.col("t")))
             .select("doc_id", "keep_id", "group_size", ((F.col("place") == 1) & F.col("lead")).alias("kept"), "text_sha256"))
    return cold.unionByName(split)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
