"""Replay a table as timed, partly late deliveries of JSON-lines files.

The split is integer arithmetic on `event_id`, so SQL can reproduce it:

    base      = least(event_id div (rows / n), n - 1)
    delivery  = base + 1 (capped at n - 1) when event_id % late_mod = 0, else base
    delivered_at = greatest `ts` of the delivery's on-time rows

A delivery is written by Spark (as many files as the data needs) into the landing folder;
the stream then picks up exactly the new files.  A *redelivery* writes one delivery's rows
again under new file names (the same readings, delivered twice).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

N_DELIVERIES = 4
LATE_MOD = 13
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# What lands: the columns of `events`, event time as ISO text, plus the delivery time.
READINGS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
    T.StructField("delivered_at", T.StringType()),
])


def plan_deliveries(events: DataFrame, n: int = N_DELIVERIES, late_mod: int = LATE_MOD) -> DataFrame:
    """`events` + `delivery`, `on_time`, `delivered_at` (TIMESTAMP_NTZ)."""
    rows = events.count()
    per = max(1, rows // n)
    base = F.least(F.floor(F.col("event_id") / F.lit(per)).cast("long"), F.lit(n - 1).cast("long"))
    moved = F.pmod(F.col("event_id"), F.lit(late_mod)) == 0
    d = events.select("*", base.alias("_base")).withColumn(
        "delivery", F.when(moved, F.least(F.col("_base") + 1, F.lit(n - 1).cast("long"))).otherwise(F.col("_base")))
    d = d.withColumn("on_time", F.col("delivery") == F.col("_base")).drop("_base")
    # At most `n` rows: the delivery times.  Bounded by construction, so broadcast.
    times = d.filter("on_time").groupBy("delivery").agg(F.max("ts").alias("delivered_at"))
    return d.join(F.broadcast(times), "delivery", "left")


def as_landing_rows(planned: DataFrame) -> DataFrame:
    """The JSON document of each reading (string times, as a device would send them)."""
    return planned.select(
        "event_id", F.date_format("ts", TS_FORMAT).alias("event_time"), "user_id", "event_type", "value", "props",
        F.date_format("delivered_at", TS_FORMAT).alias("delivered_at"))


def land(planned: DataFrame, landing_dir: str, delivery: int) -> None:
    """Write one delivery's readings as JSON lines into the landing folder (append)."""
    (as_landing_rows(planned.filter(F.col("delivery") == delivery))
     .write.mode("append").json(landing_dir))


def publish_lines(folder: str, name: str, lines: list[str]) -> str:
    """Publish one small local fixture file atomically: write it under a hidden name
    (file sources skip names starting with '.' or '_'), then rename it into place, so a
    stream never lists a half-written file.  Spark's own writers get the same guarantee
    from their commit protocol."""
    import os

    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, f".{name}.tmp")
    with open(tmp, "w") as f:
        f.writelines(line if line.endswith("\n") else line + "\n" for line in lines)
    final = os.path.join(folder, name)
    os.replace(tmp, final)
    return final
