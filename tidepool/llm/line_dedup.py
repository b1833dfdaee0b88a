"""Operator 12, line deduplication (DataFrame functions only).

Lines are normalised (stripped, A-Z lower-cased) and hashed to 128 bits; a hash counts each document
once, and lines whose hash stands in at least `min_docs` documents are dropped from all of them but
the one with the largest identifier.  The text that stays is put together again by position.

1. Each text becomes the array of its lines' hashes (null for a key below `min_chars`).  The distinct
   hashes of a document are exploded and counted by hash, combined map-side, with the largest
   identifier: a line in a third of all documents is one row a task.
2. The positions of a document that stand under a counted hash are joined with it.  The list of
   repeated hashes grows with the corpus, so it is not broadcast but joined by hash; a hot line's rows
   are what adaptive execution splits, as nothing is gathered by hash there.
3. The positions to drop are gathered by document (identifier and digest of the text, so no number
   has to be written) and joined with the texts, which are shuffled once.

Defined cases: a null or empty text is one empty line; `\\r` is white space, not a separator; keys are
compared by hash (MD5); each row is a document, so rows that repeat an identifier count one by one, and
all rows with the largest identifier keep a repeated line; null identifiers are below all others, and
rows that hold a line with no other identifier all keep it; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.shared import documents, id_and_text

MIN_CHARS = 40
MIN_DOCS = 5

WHITE = " \t\n\x0b\x0c\r"  # x20, x09-x0D
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased (by `lower` where all is ASCII)."""
    key = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(key) == F.char_length(key), F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def line_hashes(text: Column, min_chars: int) -> Column:
    """For each line of a text the hash of its key, null where the key is shorter than `min_chars`."""
    def hashed(line: Column) -> Column:
        # a key is no longer than its line, so shorter lines need not be stripped
        return F.when(F.char_length(line) < min_chars, F.lit(None)).otherwise(
            F.when(F.char_length(F.btrim(line, F.lit(WHITE))) >= min_chars, F.md5(line_key(line))))

    return F.transform(F.split(text, "\n"), hashed)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                        min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_lines, dropped (positions of the dropped lines, from 0) and
    text, the lines that stay."""
    base = id_and_text(docs, id_col, text_col)
    identity = [F.xxhash64("text").alias("digest_1"), F.xxhash64(F.lit(1), "text").alias("digest_2")]
    hashes = base.select("doc_id", *identity, line_hashes(F.col("text"), min_chars).alias("hashes"))
    # the outer forms: Spark would compute the hashes of a text once more to leave out empty arrays before it
    counted = (hashes.select("doc_id", F.explode_outer(F.array_distinct("hashes")).alias("hash")).where("hash IS NOT NULL")
               .select("doc_id", F.unhex("hash").alias("hash"))
               .groupBy("hash").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_id")))
    repeated = counted.where(F.col("n_docs") >= min_docs).select("hash", "last_id")
    held = (hashes.select("doc_id", "digest_1", "digest_2", F.posexplode_outer("hashes").alias("position", "hash"))
            .where("hash IS NOT NULL").withColumn("hash", F.unhex("hash")))
    dropped = (held.join(repeated, "hash").where(~F.col("doc_id").eqNullSafe(F.col("last_id")))
               .groupBy(F.col("doc_id").alias("of_id"), F.col("digest_1").alias("of_1"), F.col("digest_2").alias("of_2"))
               .agg(F.collect_set("position").alias("dropped")))
    lines = base.select("doc_id", *identity, F.split("text", "\n").alias("lines"))
    same = (lines.digest_1 == dropped.of_1) & (lines.digest_2 == dropped.of_2) & lines.doc_id.eqNullSafe(dropped.of_id)
    # array_except and transform are linear in the lines; `lines` comes out of the join, so it is not split again
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped"), lambda p: F.get("lines", p))
    text = F.array_join(F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(kept), "\n")
    return lines.join(dropped, same, "left").select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.array_sort("dropped"), F.array().cast("array<int>")).alias("dropped"), text.alias("text"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
), repeated AS (
  SELECT key, max(doc_id) AS last_id FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), decided AS (
  SELECT k.doc_id, k.place, k.line, r.key IS NOT NULL AND k.doc_id <> r.last_id AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM decided GROUP BY doc_id
"""
