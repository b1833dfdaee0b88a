"""Schema drift at ingest.

The drift fixture is `events` written as JSON lines where integer arithmetic on `event_id`
picks each line's shape:

    event_id % 10 = 3   an extra field `battery_pct` the readers do not know
    event_id % 10 = 6   `value` sent as the string "n/a" (wrong type)
    event_id % 10 = 9   a line cut short: not JSON at all
    otherwise           a plain reading

Three unknown-field policies:

* none   -- JSON source with a fixed schema: unknown fields are lost silently, a wrong type
            becomes NULL, a broken line is kept whole in `_corrupt_record`;
* rescue -- text source + `from_json`: the raw line is kept in `_rescued_data` whenever it
            has a field outside the schema, a value of the wrong type, or is not JSON;
* fail   -- a `foreachBatch` sink that raises before the batch commits when a line has an
            unknown field, so the same files are read again once the schema is widened.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.projection import split_good_bad as split
from tidepool.session import ensure_folder
from tidepool.streaming import variant as V

DRIFT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
CORRUPT = "_corrupt_record"
RESCUED = "_rescued_data"


def drift_lines(events: DataFrame) -> DataFrame:
    """One text line per reading, shaped by `event_id % 10` (see module doc)."""
    kind = F.pmod(F.col("event_id"), F.lit(10))
    t = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    plain = F.to_json(F.struct("event_id", t.alias("event_time"), "user_id", "event_type", "value"))
    extra = F.to_json(F.struct("event_id", t.alias("event_time"), "user_id", "event_type", "value",
                               F.pmod(F.col("event_id"), F.lit(100)).alias("battery_pct")))
    wrong = F.to_json(F.struct("event_id", t.alias("event_time"), "user_id", "event_type",
                               F.lit("n/a").alias("value")))
    broken = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"event_time":"'))
    line = (F.when(kind == 3, extra).when(kind == 6, wrong).when(kind == 9, broken).otherwise(plain))
    return events.select(line.alias("value"))


def land_lines(lines: DataFrame, landing_dir: str) -> None:
    lines.write.mode("append").text(landing_dir)


def policy_none(spark: SparkSession, landing_dir: str) -> DataFrame:
    """T5 + S15: fixed schema; broken (and wrongly typed) lines kept in `_corrupt_record`."""
    ensure_folder(spark, landing_dir)
    schema = T.StructType(DRIFT_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    return (spark.readStream.format("json").schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).load(landing_dir))


def rescue_columns(raw: DataFrame, schema: T.StructType = DRIFT_SCHEMA, line: str = "value") -> DataFrame:
    """T7 on any DataFrame with a raw JSON `line` column: parsed fields + `_rescued_data` + reason.

    The line is parsed once, into a VARIANT; the fields, what does not fit their types and the names
    that the schema lacks, at any depth, are read from that.  Anything but a JSON object without
    repeated keys is not_json."""
    v, fields = F.col("_v"), [f"_field{i}" for i in range(len(schema.fields))]
    parsed = raw.select(F.col(line).alias("_line"), F.try_parse_json(line).alias("_v"))
    # each field is looked up once, into a column that the steps after it read
    parsed = parsed.select("_line", (F.coalesce(V.kind(v) == "OBJECT", F.lit(False))).alias("_object"), (F.size(V.unknown_fields(v, schema)) > 0).alias("_unknown"),
                           *[V.member(v, f.name).alias(c) for f, c in zip(schema.fields, fields, strict=True)])
    found = {f.name: V.typed(F.col(c), f.dataType) for f, c in zip(schema.fields, fields, strict=True)}
    misfit = reduce(lambda a, b: a | b, [bad for _, bad in found.values()], F.lit(False))
    reason = F.when(~F.col("_object"), "not_json").when(F.col("_unknown"), "unknown_field").when(misfit, "bad_type")
    return (parsed.select(*[value.alias(k) for k, (value, _) in found.items()], "_line", reason.alias("rescue_reason"))
            .select(*found, F.when(F.col("rescue_reason").isNotNull(), F.col("_line")).alias(RESCUED), "rescue_reason"))


def policy_rescue(spark: SparkSession, landing_dir: str) -> DataFrame:
    """S12 + T7: text stream, parsed with the rescue columns."""
    ensure_folder(spark, landing_dir)
    return rescue_columns(spark.readStream.format("text").load(landing_dir))


class UnknownFieldError(RuntimeError):
    """Names every field that the reader's schema lacks."""

    def __init__(self, batch_id: int, fields: list[str]):
        self.fields = fields
        super().__init__(f"micro-batch {batch_id} carries {len(fields)} field(s) outside the schema: {', '.join(fields)}")


def fail_on_unknown(sink_dir: str, schema: T.StructType = DRIFT_SCHEMA, line: str = "value"):
    """A foreachBatch function that refuses a batch with unknown fields at any depth, before anything
    is written.  Each batch has its own folder, so a batch that runs again replaces its own rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        v = F.col("_v")
        parsed = batch.select(F.try_parse_json(line).alias("_v")).select(
            *[V.typed(V.member(v, f.name), f.dataType)[0].alias(f.name) for f in schema.fields], V.unknown_fields(v, schema).alias("_unknown")).persist()
        try:
            names = parsed.select(F.explode("_unknown").alias("path")).distinct()
            surplus = sorted(r.path[2:] for r in names.collect())  # distinct names only
            if surplus:
                raise UnknownFieldError(batch_id, surplus)
            parsed.drop("_unknown").write.mode("overwrite").parquet(f"{sink_dir}/batch={batch_id}")
        finally:
            parsed.unpersist()

    return write


def quarantine(good_dir: str, bad_dir: str):
    """A foreachBatch function that sends every row of `rescue_columns` to one of two tables:
    complete rows to `good_dir`, all others, raw line and reason included, to `bad_dir`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            for part, to in zip(split_good_bad(rows), (good_dir, bad_dir)):
                part.write.mode("overwrite").parquet(f"{to}/batch={batch_id}")
        finally:
            rows.unpersist()

    return write


def split_good_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows (parsed, nothing rescued) and the quarantine; each row on one side."""
    return split(rows, F.col(RESCUED).isNull() & F.col("event_id").isNotNull())
