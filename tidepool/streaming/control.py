"""Starting, naming, draining and stopping streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start(df: DataFrame, name: str, sink_dir: str, checkpoint_dir: str, output_mode: str = "append",
          every: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Start a named query into a folder; `every` = processing-time trigger (T3), else as fast
    as data arrives.  Names are unique among active queries."""
    spark = df.sparkSession
    if any(q.name == name for q in spark.streams.active):
        raise ValueError(f"a query named {name!r} is already running")
    w = (df.writeStream.format(fmt).outputMode(output_mode).queryName(name)
         .option("checkpointLocation", checkpoint_dir).option("path", sink_dir))
    if every:
        w = w.trigger(processingTime=every)
    return w.start()


def stop_by_name(spark: SparkSession, name: str) -> bool:
    for q in spark.streams.active:
        if q.name == name:
            q.stop()
            return True
    return False


def drain_and_stop_all(spark: SparkSession) -> int:
    """Process everything available in every active query, then stop them all."""
    qs = list(spark.streams.active)
    for q in qs:
        q.processAllAvailable()
    for q in qs:
        q.stop()
    return len(qs)


def use_rocksdb_state(spark: SparkSession) -> None:
    """RocksDB state store for large state (set before a stateful query first starts;
    the choice is then fixed in its checkpoint)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
