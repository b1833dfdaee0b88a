"""Bronze, silver and gold stream definitions (T1, T10-T13, P11) and the drain helper.

A `LayerSpec` says what the layers compute: typed columns, the duplicate key (one column or
several), windows, delays and aggregates.  Each layer is a Parquet folder written by a streaming
query with its own checkpoint; the next layer reads that folder as a stream through the sink's
log, so it sees only committed files.  The layer functions return unstarted streams; `drain` runs
one `availableNow` trigger and returns the progress of every micro-batch.

Streams run in a session of their own (`stream_session`), which holds the settings a stateful
query fixes in its checkpoint: the number of state partitions and the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.scalar import parse_ts
from tidepool.monitor.progress import RunRecords
from tidepool.session import ensure_folder
from tidepool.streaming.control import ROCKSDB_PROVIDER
from tidepool.streaming.replay import READINGS_SCHEMA

GOLD_WINDOW = "10 minutes"
GOLD_DELAY = "15 minutes"
GOLD_KEY = "event_type"


def _reading_columns() -> dict[str, Column]:
    """Typed columns of a reading.  A value that does not parse becomes NULL and stops nothing."""
    return {
        "event_id": F.col("event_id"), "user_id": F.col("user_id"), "event_type": F.col("event_type"),
        "event_ts": parse_ts("event_time"), "value": F.col("value").cast("double"),
        "k": F.get_json_object("props", "$.k").cast("int"), "delivered_ts": parse_ts("delivered_at"),
    }


def _reading_checks() -> dict[str, Column]:
    """Aggregates over the rows that silver is handed, told by every micro-batch's progress."""
    lag = F.unix_micros(parse_ts("delivered_at")) - F.unix_micros(parse_ts("event_time"))
    return {
        "rows": F.count(F.lit(1)),
        "bad_time": F.count_if(F.col("event_time").isNotNull() & parse_ts("event_time").isNull()),
        "bad_props": F.count_if(F.col("props").isNotNull() & F.get_json_object("props", "$.k").cast("int").isNull()),
        "no_value": F.count_if(F.col("value").isNull()),
        "incomplete": F.count_if(parse_ts("event_time").isNull() | F.col("event_id").isNull()),
        "lag_seconds": F.coalesce(F.sum(F.floor(lag / 1_000_000).cast("long")), F.lit(0)),
        "overdue": F.count_if(lag > F.lit(seconds_of(GOLD_DELAY) * 1_000_000)),
    }


def seconds_of(interval: str) -> int:
    n, unit = interval.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def _reading_measures() -> dict[str, Column]:
    return {"readings": F.count(F.lit(1)), "avg_value": F.avg("value"), "max_value": F.max("value")}


@dataclass(frozen=True)
class LayerSpec:
    """What the three layers compute over a source of readings."""

    columns: Mapping[str, Column] = field(default_factory=_reading_columns)
    required: tuple[str, ...] = ("event_ts", "event_id")  # rows without them do not reach silver
    dedup_key: tuple[str, ...] = ("event_id",)  # one column or several, for example device and time
    dedup_delay: str = "1 hour"  # on ingestion time, so a late reading is no duplicate
    event_ts: str = "event_ts"
    window: str = GOLD_WINDOW
    delay: str = GOLD_DELAY
    group_by: tuple[str, ...] = (GOLD_KEY,)
    measures: Mapping[str, Column] = field(default_factory=_reading_measures)
    checks: Mapping[str, Column] = field(default_factory=_reading_checks)


INGESTED = "_ingested_at"
CHECKS = "silver_checks"  # name of the observed metrics
SOURCE = "_source_file"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for streams: same catalog and data, its own settings, RocksDB state.
    `state_partitions` is fixed in a stateful query's checkpoint at its first start."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")  # T18: changes can be read back
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.conf.get("spark.sql.shuffle.partitions")))
    return own


def bronze(spark: SparkSession, landing_dir: str, schema: T.StructType = READINGS_SCHEMA,
           max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Landed readings as they are, with their file and the time they came in.  A trigger
    may be bounded by bytes or by files."""
    ensure_folder(spark, landing_dir)
    source = spark.readStream.format("json").schema(schema)
    for option, bound in (("maxFilesPerTrigger", max_files_per_trigger), ("maxBytesPerTrigger", max_bytes_per_trigger)):
        if bound is not None:
            source = source.option(option, bound)
    return source.load(landing_dir).withColumns({SOURCE: F.col("_metadata.file_path"), INGESTED: F.current_timestamp()})


def layer_source(spark: SparkSession, layer_dir: str, schema: T.StructType, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A layer folder (written by a stream) read as a stream."""
    ensure_folder(spark, layer_dir)
    source = spark.readStream.schema(schema)
    if max_bytes_per_trigger is not None:
        source = source.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return source.parquet(layer_dir)


def silver_columns(raw: DataFrame, spec: LayerSpec | None = None) -> DataFrame:
    """The typed columns of the spec (and lineage, where the input has it) of complete rows."""
    spec = spec or LayerSpec()
    lineage = [F.col(c) for c in (SOURCE, INGESTED) if c in raw.columns]
    return raw.select(*[c.alias(n) for n, c in spec.columns.items()], *lineage).na.drop(subset=list(spec.required))


def silver(bronze_stream: DataFrame, spec: LayerSpec | None = None) -> DataFrame:
    """P11 + T13: typed readings, duplicates of the spec's key dropped while the key is in state.  P14: the
    spec's checks are counted on the way (`observedMetrics` of each batch); no row is read twice for them."""
    spec = spec or LayerSpec()
    observed = bronze_stream.observe(CHECKS, *[c.alias(n) for n, c in spec.checks.items()]) if spec.checks else bronze_stream
    typed = silver_columns(observed, spec)
    return typed.withWatermark(INGESTED, spec.dedup_delay).dropDuplicatesWithinWatermark(list(spec.dedup_key))


def gold(silver_stream: DataFrame, spec: LayerSpec | None = None) -> DataFrame:
    """Tumbling windows per key, each emitted once, when the watermark has passed it; rows
    that come later are dropped and counted in the progress."""
    spec = spec or LayerSpec()
    windows = silver_stream.withWatermark(spec.event_ts, spec.delay).groupBy(F.window(spec.event_ts, spec.window), *spec.group_by)
    return (windows.agg(*[c.alias(n) for n, c in spec.measures.items()])
            .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
            .select("window_start", "window_end", *spec.group_by, *spec.measures))


def drain(df: DataFrame, sink_dir: str, checkpoint_dir: str, name: str, output_mode: str = "append",
          fmt: str = "parquet", metrics_dir: str | None = None) -> list[dict]:
    """One availableNow run into a folder; resumes from the checkpoint if it exists.

    Returns the progress of every micro-batch, gathered by a listener as the batches end (Spark
    itself keeps the last hundred only) and, with `metrics_dir`, written there batch by batch.
    T15: Spark refuses an aggregation in append mode without a watermark when the query starts.
    """
    writer = (df.writeStream.format(fmt).outputMode(output_mode).queryName(name)
              .option("checkpointLocation", checkpoint_dir).option("path", sink_dir).trigger(availableNow=True))
    with RunRecords(df.sparkSession, name, metrics_dir) as records:
        q = writer.start()
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return records.of(str(q.runId), q.lastProgress)
