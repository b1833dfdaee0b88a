"""Catalogue queries for the schema-drift policies.

The drift lines of `events` land once per session and input folder; the `none` policy
(JSON source, fixed schema) and the `rescue` policy (text source + from_json) each drain
them into their own folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.scalar import parse_ts
from tidepool.operators.projection import parse_failures as count_failures
from tidepool.plans.memo import built_once
from tidepool.session import work_dir
from tidepool.sources.tables import read_table
from tidepool.streaming import drift as D
from tidepool.streaming import variant as V
from tidepool.streaming.layers import drain, stream_session


@dataclass
class DriftRun:
    landing: str
    none_dir: str
    rescue_dir: str
    good_dir: str
    bad_dir: str
    checked_dir: str


WIDENED = T.StructType(D.DRIFT_SCHEMA.fields + [T.StructField("battery_pct", T.LongType())])


def drift_run(spark: SparkSession, sf_dir: str) -> DriftRun:
    def build() -> DriftRun:
        root = work_dir(spark, "drift")
        run = DriftRun(f"{root}/landing", f"{root}/none", f"{root}/rescue", f"{root}/good", f"{root}/bad", f"{root}/checked")
        D.land_lines(D.drift_lines(read_table(spark, sf_dir, "events")), run.landing)
        session = stream_session(spark)
        drain(D.policy_none(session, run.landing), run.none_dir, f"{root}/_checkpoints/none", "drift_none")
        drain(D.policy_rescue(session, run.landing), run.rescue_dir, f"{root}/_checkpoints/rescue", "drift_rescue")
        for name, stream, sink in (("quarantine", D.policy_rescue(session, run.landing), D.quarantine(run.good_dir, run.bad_dir)),
                                   ("fail", session.readStream.format("text").load(run.landing), D.fail_on_unknown(run.checked_dir, WIDENED))):
            q = (stream.writeStream.foreachBatch(sink).queryName(f"drift_{name}")
                 .option("checkpointLocation", f"{root}/_checkpoints/{name}").trigger(availableNow=True).start())
            q.awaitTermination()
        return run

    return built_once(spark, sf_dir, "drift", ("events",), build)


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two tables that the quarantine sink wrote, every line in one of them."""
    run = drift_run(spark, sf_dir)
    both = [spark.read.parquet(d).select("event_id", "event_type", "value", "rescue_reason", F.lit(side).alias("side"))
            for side, d in (("good", run.good_dir), ("quarantine", run.bad_dir))]
    return both[0].unionByName(both[1])


def parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose time is there but does not parse, over the lines of the drift fixture (of which
    every hundredth time is written in a form the parser does not know)."""
    r = spark.read.parquet(drift_run(spark, sf_dir).rescue_dir)
    odd = F.when(F.col("event_id") % 100 == 0, F.concat(F.lit("at "), F.col("event_time"))).otherwise(F.col("event_time"))
    return count_failures(r.withColumn("event_time", odd).withColumn("event_ts", parse_ts("event_time")), "event_time", "event_ts")


def widened_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the failing policy lets through once the schema knows `battery_pct`, merged with
    a copy written before it did (those rows read NULL there)."""
    run = drift_run(spark, sf_dir)
    path = f"{work_dir(spark, 'merged')}/both"
    wide = spark.read.parquet(run.checked_dir).drop("batch").where("event_id IS NOT NULL")
    wide.where("event_id % 2 = 0").write.parquet(f"{path}/wide")
    wide.where("event_id % 2 = 1").drop("battery_pct").write.parquet(f"{path}/narrow")
    merged = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(path)
    return merged.select("event_id", "event_type", "value", "battery_pct")


def unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed schema; unknown fields gone, wrong types NULL, broken lines flagged."""
    n = spark.read.parquet(drift_run(spark, sf_dir).none_dir)
    return n.select("event_id", "event_time", "user_id", "event_type", "value",
                    F.col(D.CORRUPT).isNotNull().alias("has_corrupt"))


def rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line parsed; the raw line kept when it carries anything the schema lacks."""
    r = spark.read.parquet(drift_run(spark, sf_dir).rescue_dir)
    return r.select("event_id", "event_type", "value", F.col(D.RESCUED).isNotNull().alias("rescued"),
                    "rescue_reason")


def bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse failures counted; good rows vs quarantine, each line on one side."""
    r = spark.read.parquet(drift_run(spark, sf_dir).rescue_dir)
    good = F.coalesce(F.col(D.RESCUED).isNull() & F.col("event_id").isNotNull(), F.lit(False))
    return r.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("event_id").alias("parsed_rows"),
        F.count_if(F.col("rescue_reason") == "bad_type").alias("parse_failures"),
        F.count_if(F.col("rescue_reason") == "unknown_field").alias("unknown_field_rows"),
        F.count_if(F.col("rescue_reason") == "not_json").alias("not_json_rows"),
        F.count_if(good).alias("good_rows"),
        F.count_if(~good).alias("quarantined_rows"))


def nested_schema() -> T.StructType:
    return T.StructType.fromDDL(
        "event_id long, event_time string, user struct<id: long, plan: struct<name: string>>, value double, tags array<struct<k: long>>")


def nested_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as nested JSON lines whose shape follows `event_id`: a plan for every fifth user (with seats
    for every tenth, and just its name for every 25th), tags for every fourth line (the second of them of
    another shape), the event's own `props`, `value` as a string in every tenth line and a cut line in every
    hundredth."""
    ev = read_table(spark, sf_dir, "events")
    every = lambda n: F.col("event_id") % n == 0
    text = lambda **c: F.to_json(F.struct(*[x.alias(n) for n, x in c.items()]))
    plan = F.when(every(25), F.lit('"pro"')).when(every(5), text(name=F.lit("pro"), seats=F.when(every(10), F.col("user_id"))))
    user = F.concat(F.lit('{"id":'), F.col("user_id").cast("string"), F.coalesce(F.concat(F.lit(',"plan":'), plan), F.lit("")), F.lit("}"))
    tags = F.when(every(8), F.lit("[]")).when(every(4), F.concat(F.lit('[{"k":'), F.col("event_id").cast("string"), F.lit('},{"k":"x","w":{"deep":null}}]')))
    value = F.when(F.col("event_id") % 10 == 6, F.lit('"n/a"')).otherwise(F.format_string("%.2f", "value"))
    line = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"user":'), user, F.lit(',"value":'), value,
                    F.coalesce(F.concat(F.lit(',"tags":'), tags), F.lit("")), F.lit(',"props":'), F.coalesce("props", F.lit("null")), F.lit("}"))
    return ev.select(F.when(F.col("event_id") % 100 == 99, F.lit('{"event_id":')).otherwise(line).alias("value"))


def drift_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of the nested lines, at any depth, with its types, the lines that hold it and
    whether the reader's schema knows it."""
    return V.against(V.field_counts(nested_lines(spark, sf_dir)), nested_schema())


def rescued_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested lines through the rescue columns; fields unknown below the top level are told too."""
    r = D.rescue_columns(nested_lines(spark, sf_dir), nested_schema())
    return r.select("event_id", F.col("user.id").alias("user_id"), F.col("user.plan.name").alias("plan"), "value", F.size("tags").alias("n_tags"), "rescue_reason")


_K = "(SELECT *, event_id % 10 AS kind FROM events)"
_TS = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"

DRIFT_SQL = {
    "unknown_fields": f"""
SELECT CASE WHEN kind = 9 THEN NULL ELSE event_id END AS event_id,
       CASE WHEN kind = 9 THEN NULL ELSE {_TS} END AS event_time,
       CASE WHEN kind = 9 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN kind = 9 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN kind IN (6, 9) THEN NULL ELSE value END AS value,
       kind IN (6, 9) AS has_corrupt
FROM {_K}
""",
    "rescued": f"""
SELECT CASE WHEN kind = 9 THEN NULL ELSE event_id END AS event_id,
       CASE WHEN kind = 9 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN kind IN (6, 9) THEN NULL ELSE value END AS value,
       kind IN (3, 6, 9) AS rescued,
       CASE kind WHEN 9 THEN 'not_json' WHEN 3 THEN 'unknown_field' WHEN 6 THEN 'bad_type' END AS rescue_reason
FROM {_K}
""",
    "quarantined": f"""
SELECT CASE WHEN kind = 9 THEN NULL ELSE event_id END AS event_id, CASE WHEN kind = 9 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN kind IN (6, 9) THEN NULL ELSE value END AS value,
       CASE kind WHEN 9 THEN 'not_json' WHEN 3 THEN 'unknown_field' WHEN 6 THEN 'bad_type' END AS rescue_reason,
       CASE WHEN kind IN (3, 6, 9) THEN 'quarantine' ELSE 'good' END AS side
FROM {_K}
""",
    "parse_failures": f"SELECT count(*) AS parse_failures FROM {_K} WHERE kind <> 9 AND event_id % 100 = 0",
    "widened_schema": f"""
SELECT event_id, event_type, CASE WHEN kind = 6 THEN NULL ELSE value END AS value,
       CASE WHEN kind = 3 AND event_id % 2 = 0 THEN event_id % 100 END AS battery_pct
FROM {_K} WHERE kind <> 9
""",
    "bad_values": f"""
SELECT count(*) AS lines, count(*) FILTER (WHERE kind <> 9) AS parsed_rows,
       count(*) FILTER (WHERE kind = 6) AS parse_failures, count(*) FILTER (WHERE kind = 3) AS unknown_field_rows,
       count(*) FILTER (WHERE kind = 9) AS not_json_rows, count(*) FILTER (WHERE kind NOT IN (3, 6, 9)) AS good_rows,
       count(*) FILTER (WHERE kind IN (3, 6, 9)) AS quarantined_rows
FROM {_K}
""",
    "drift_fields": """
WITH e AS (SELECT * FROM events WHERE event_id % 100 <> 99),
tag AS (SELECT event_id FROM e WHERE event_id % 4 = 0 AND event_id % 8 <> 0),
f AS (
  SELECT '$' AS path, 'NOT JSON' AS type, 'not_json' AS status FROM events WHERE event_id % 100 = 99
  UNION ALL SELECT p.path, p.type, p.status FROM e, (VALUES ('$', 'OBJECT', 'known'), ('$.event_id', 'BIGINT', 'known'), ('$.user', 'OBJECT', 'known'),
                                            ('$.user.id', 'BIGINT', 'known')) p(path, type, status)
  UNION ALL SELECT '$.user.plan', 'STRING', 'bad_type' FROM e WHERE event_id % 25 = 0
  UNION ALL SELECT p.path, p.type, 'known' FROM e, (VALUES ('$.user.plan', 'OBJECT'), ('$.user.plan.name', 'STRING')) p(path, type)
            WHERE event_id % 5 = 0 AND event_id % 25 <> 0
  UNION ALL SELECT '$.user.plan.seats', 'BIGINT', 'unknown_field' FROM e WHERE event_id % 10 = 0 AND event_id % 25 <> 0
  UNION ALL SELECT '$.value', CASE WHEN event_id % 10 = 6 THEN 'STRING' ELSE 'DECIMAL' END, CASE WHEN event_id % 10 = 6 THEN 'bad_type' ELSE 'known' END FROM e
  UNION ALL SELECT '$.tags', 'ARRAY', 'known' FROM e WHERE event_id % 4 = 0
  UNION ALL SELECT p.path, p.type, p.status FROM tag, (VALUES ('$.tags[*]', 'OBJECT', 'known'), ('$.tags[*].k', 'BIGINT', 'known'), ('$.tags[*].k', 'STRING', 'bad_type'),
            ('$.tags[*].w', 'OBJECT', 'unknown_field'), ('$.tags[*].w.deep', 'VOID', 'unknown_field')) p(path, type, status)
  UNION ALL SELECT '$.props', CASE WHEN props IS NULL THEN 'VOID' ELSE 'OBJECT' END, 'unknown_field' FROM e
  UNION ALL SELECT '$.props.' || k, 'BIGINT', 'unknown_field' FROM (SELECT unnest(json_keys(props)) AS k FROM e WHERE props IS NOT NULL))
SELECT path, type, status, count(*) AS lines FROM f GROUP BY 1, 2, 3
""",
    "rescued_nested": """
SELECT CASE WHEN ok THEN event_id END AS event_id, CASE WHEN ok THEN user_id END AS user_id,
       CASE WHEN ok AND event_id % 5 = 0 AND event_id % 25 <> 0 THEN 'pro' END AS plan,
       CASE WHEN ok AND event_id % 10 <> 6 THEN round(value, 2) END AS value,
       CASE WHEN ok THEN CASE WHEN event_id % 8 = 0 THEN 0 WHEN event_id % 4 = 0 THEN 2 END END AS n_tags,
       CASE WHEN ok THEN 'unknown_field' ELSE 'not_json' END AS rescue_reason
FROM (SELECT *, event_id % 100 <> 99 AS ok FROM events)
""",
}
