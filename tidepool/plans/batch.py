"""Batch query catalogue (G1 analytics, G2 skew and layout) over the given tables.

Each query is `(spark, sf_dir) -> DataFrame` and reads whole tables.  The matching SQL
(DuckDB dialect, same column names) lives in `tidepool.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.scalar import hot_key, rounded, to_ntz
from tidepool.operators import aggregate as A
from tidepool.operators import joins as J
from tidepool.operators.projection import ReaderField, conform, in_range, in_set
from tidepool.operators.sketches import heavy_keys
from tidepool.sources.tables import read_events, read_table

# Parameters of the catalogue queries (fixed so Spark and the SQL oracle agree).
HOURLY_VALUE_RANGE = (1.0, 250.0)
BUCKET_WIDTH = "10 minutes"
BUCKET_SECONDS = 600
HOT_SHARE_TENTHS = 9
N_KEYS = 100


def hourly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 F1 P8 (flagship): rows, average value and average `k` per hour and event type."""
    ev = in_range(read_events(spark, sf_dir), "value", *HOURLY_VALUE_RANGE)
    k = F.get_json_object("props", "$.k").cast("int")
    return (ev.groupBy(F.hour("ts").alias("hour"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("value"), 6).alias("avg_value"),
                 rounded(F.avg(k), 6).alias("avg_k"))
            .orderBy("hour", "event_type"))


def minmax_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: first and last event time."""
    return A.minmax(read_table(spark, sf_dir, "events"), "ts")


def describe_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: typed summary statistics of two lineitem columns."""
    return A.summary_stats(read_table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"], digits=6)


def count_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 O1: lineitem rows per return flag, biggest first."""
    return A.count_by(read_table(spark, sf_dir, "lineitem"), ["l_returnflag"])


def count_by_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: non-NULL prices per (status, priority)."""
    return A.count_by(read_table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"],
                      value_col="o_totalprice")


def count_by_two_keys_one_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for one status only (the filter reaches the Parquet scan)."""
    o = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return A.count_by(o, ["o_orderstatus", "o_orderpriority"], value_col="o_totalprice")


def avg_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average account balance per market segment."""
    return A.avg_by(read_table(spark, sf_dir, "customer"), ["c_mktsegment"], "c_acctbal", "avg_acctbal")


def global_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 global + A11: one-row average and count."""
    c = read_table(spark, sf_dir, "customer")
    return c.agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("c_acctbal"), 6).alias("avg_acctbal"))


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per (user, type), ties broken by event id."""
    ev = read_table(spark, sf_dir, "events")
    return A.latest_per_key(ev, ["user_id", "event_type"], ["ts", "event_id"], ["value"])


def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (user, type) pairs."""
    return read_table(spark, sf_dir, "events").select("user_id", "event_type").distinct()


def time_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per 10-minute bucket with value sum and max."""
    ev = read_events(spark, sf_dir)
    out = A.time_buckets(ev, "ts", BUCKET_WIDTH, value="value")
    return out.select(to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"),
                      "n", rounded("sum_value", 6).alias("sum_value"), "max_value")


def sum_or_zero_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum over an empty selection is 0, not NULL."""
    ev = read_table(spark, sf_dir, "events").filter(F.col("value") < 0)
    return A.sum_or_zero(ev, "value", "total_value")


def group_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: rows per boolean expression (high-value order or not)."""
    o = read_table(spark, sf_dir, "orders")
    return A.count_by_flag(o, F.col("o_totalprice") > 100000, "high_value")


def priority_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent and high-priority orders per status, sorted by two keys."""
    o = in_set(read_table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return (o.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("o_orderpriority", "o_orderstatus"))


def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 most expensive orders (a top-k report; the limit is the feature)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")).limit(10)


def order_revenue_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 over the given tables: orders joined to customers, revenue per segment and status."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice")
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return (o.join(c, "o_custkey").groupBy("c_mktsegment", "o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("o_totalprice"), 2).alias("revenue")))


# --- G2: skew ---------------------------------------------------------------------------

def skewed_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem with the derived hot key (90 % of rows on key 0)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity")
    return li.withColumn("join_key", hot_key("l_orderkey", HOT_SHARE_TENTHS, N_KEYS))


def heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with at least one hundredth of the order lines, by a frequent-items sketch."""
    return heavy_keys(read_table(spark, sf_dir, "lineitem"), "l_suppkey", 0.01)


def skew_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per derived key, hottest first, with share."""
    return J.skew_report(skewed_lineitem(spark, sf_dir), "join_key")


def _label_agg(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("l_extendedprice"), 6).alias("avg_price"))


def join_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffle (sort-merge) join of the skewed side with the lookup."""
    return _label_agg(J.join_shuffle(skewed_lineitem(spark, sf_dir), J.key_lookup(spark, N_KEYS), "join_key"))


def join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup is broadcast after its size check (100 rows)."""
    return _label_agg(J.join_broadcast(skewed_lineitem(spark, sf_dir), J.key_lookup(spark, N_KEYS), "join_key",
                                       max_rows=100_000))


def join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot keys salted on the big side, replicated on the lookup side."""
    big = skewed_lineitem(spark, sf_dir)
    lookup = J.key_lookup(spark, N_KEYS)
    return _label_agg(J.join_salted(big, lookup, "join_key", rows_per_salt=4096))


def key_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min, median, max rows per derived key and the max/median ratio."""
    counts = skewed_lineitem(spark, sf_dir).groupBy("join_key").agg(F.count(F.lit(1)).alias("rows"))
    return A.balance(counts, "rows").select(
        "min_rows", rounded("median_rows", 3).alias("median_rows"), "max_rows",
        rounded("max_over_median", 3).alias("max_over_median"))


# --- G2: reader schema ------------------------------------------------------------------

PART_READER = (
    ReaderField("part_key", "bigint", ("p_partkey",)),
    ReaderField("title", "string", ("p_name",)),
    ReaderField("brand", "string", ("p_brand",)),
    ReaderField("size", "int", ("p_size",), default=0, nullable=False),
    ReaderField("retail_price", "double", ("p_retailprice",)),
    ReaderField("currency", "string", (), default="USD", nullable=False),
)


def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` projected onto a reader schema with aliases and a defaulted field."""
    return conform(read_table(spark, sf_dir, "part"), PART_READER)


def split_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 summary: every order read exactly once, whatever the split layout."""
    o = read_table(spark, sf_dir, "orders")
    return o.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("distinct_keys"),
                 F.min("o_orderkey").alias("min_key"), F.max("o_orderkey").alias("max_key"))


# --- single-operator views (D3, O3, O5, P2-P6, P9, P10, F7) -------------------------------

def file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: rows, min and max key per file of the given `lineitem` table."""
    from tidepool.operators.layout import file_stats as fs

    return fs(read_table(spark, sf_dir, "lineitem"), "l_orderkey")


def newest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 20 events (a top-k report; the limit is the feature)."""
    from tidepool.operators.order import newest

    return newest(read_table(spark, sf_dir, "events"), "ts", 20, tie="event_id").select("event_id", "ts", "event_type")


def shuffled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: all orders in a seeded random order (the same rows, a different order)."""
    from tidepool.operators.order import shuffle_rows

    return shuffle_rows(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), seed=42)


def cast_rename_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed, renamed seven-column projection of `lineitem`."""
    from tidepool.operators.projection import cast_rename

    li = read_table(spark, sf_dir, "lineitem")
    out = cast_rename(li, [("l_shipdate", "timestamp_ntz", "ship_ts"), ("l_quantity", "int", "quantity"),
                           ("l_extendedprice", "double", "price"), ("l_discount", "double", "discount"),
                           ("l_tax", "double", "tax"), ("l_returnflag", "string", "flag"),
                           ("l_orderkey", "bigint", "order_key")])
    return out.withColumnRenamed("flag", "return_flag").drop("tax")


def discount_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A computed ratio column, NULL where the denominator is 0 (ANSI-safe)."""
    from tidepool.operators.projection import with_ratio

    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return with_ratio(li, "discount_per_tax", "l_discount", "l_tax")


def size_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional labels with NULL-aware predicates, counted."""
    li = read_table(spark, sf_dir, "lineitem")
    cls = (F.when(F.col("l_quantity").isNull(), "unknown")
           .when((F.col("l_quantity") > 25) & ~(F.col("l_returnflag") == "R"), "large")
           .otherwise("small"))
    return li.groupBy(cls.alias("size_class")).agg(F.count(F.lit(1)).alias("n"))


def props_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text parsed to a struct, then expanded with `r.*`."""
    ev = read_table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int").alias("r"))
    return ev.select("event_id", "r.*")
