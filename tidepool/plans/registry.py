"""Registry of every catalogue query and its SQL twin (used by `__spark_entry__`)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepool.plans import batch as B
from tidepool.plans import drift as D
from tidepool.plans import layout as LY
from tidepool.plans import monitoring as M
from tidepool.plans import nested as N
from tidepool.plans import sources as SO
from tidepool.plans import streams as S
from tidepool.plans import versioned as V
from tidepool.plans.oracle import BATCH_SQL
from tidepool.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def _prepared(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "hourly_summary": B.hourly_summary,
        "minmax_ts": B.minmax_ts,
        "describe_lineitem": B.describe_lineitem,
        "count_by_flag": B.count_by_flag,
        "count_by_two_keys": B.count_by_two_keys,
        "count_by_two_keys_one_value": B.count_by_two_keys_one_value,
        "avg_by_key": B.avg_by_key,
        "global_avg": B.global_avg,
        "dedup_latest": B.dedup_latest,
        "distinct_pairs": B.distinct_pairs,
        "time_buckets": B.time_buckets,
        "sum_or_zero_empty": B.sum_or_zero_empty,
        "group_by_flag": B.group_by_flag,
        "priority_set": B.priority_set,
        "top_orders": B.top_orders,
        "order_revenue_by_segment": B.order_revenue_by_segment,
        "skew_report": B.skew_report,
        "heavy_hitters": B.heavy_hitters,
        "join_plain": B.join_plain,
        "join_broadcast": B.join_broadcast,
        "join_salted": B.join_salted,
        "key_balance": B.key_balance,
        "conform_schema": B.conform_schema,
        "resolved_nested": N.resolved_nested,
        "table_changes": V.table_changes,
        "split_totals": B.split_totals,
        "file_stats": B.file_stats,
        "newest_events": B.newest_events,
        "shuffled_orders": B.shuffled_orders,
        "cast_rename_lineitem": B.cast_rename_lineitem,
        "discount_ratio": B.discount_ratio,
        "size_classes": B.size_classes,
        "props_struct": B.props_struct,
        "partition_totals": LY.partition_totals,
        "dir_file_stats": LY.dir_file_stats,
        "cross_database_join": LY.cross_database_join,
        "version_row_counts": V.version_row_counts,
        "version_diff": V.version_diff,
        "time_travel": V.time_travel,
        "restore": V.restore,
        "compact": V.compact,
        "versioned_skip": V.versioned_skip,
        "bronze_resume": S.bronze_resume,
        "silver_dedup": S.silver_dedup,
        "gold_windows": S.gold_windows,
        "pipeline_accounting": S.pipeline_accounting,
        "window_reconciliation": S.window_reconciliation,
        "lag_percentiles": S.lag_percentiles,
        "event_vs_processing_time": S.event_vs_processing_time,
        "lag_alert": S.lag_alert,
        "lag_sketches": S.lag_sketches,
        "complete_counts": S.complete_counts,
        "update_counts": S.update_counts,
        "update_user_counts": S.update_user_counts,
        "unknown_fields": D.unknown_fields,
        "rescued": D.rescued,
        "drift_fields": D.drift_fields,
        "rescued_nested": D.rescued_nested,
        "bad_values": D.bad_values,
        "upsert_not_matched": M.upsert_not_matched,
        "state_rows": M.state_rows,
        "state_lifetimes": M.state_lifetimes,
        "stream_totals": M.stream_totals,
        "stream_totals_full": M.stream_totals_full,
        "backlog_alert": M.backlog_alert,
        "rate_series": M.rate_series,
        "watermark_series": M.watermark_series,
        "late_drop_ratio": M.late_drop_ratio,
        "freshness": M.freshness,
        "quiet_alerts": M.quiet_alerts,
        "pipeline_metrics": M.pipeline_metrics,
        "silver_checks": M.silver_checks,
        "version_history": V.version_history,
        "time_travel_by_time": V.time_travel_by_time,
        "quarantined": D.quarantined,
        "parse_failures": D.parse_failures,
        "widened_schema": D.widened_schema,
        "csv_inferred": SO.csv_inferred,
        "csv_with_schema": SO.csv_with_schema,
        "json_round_trip": SO.json_round_trip,
        "status_names": SO.status_names,
        "split_audit": SO.split_audit,
        "capped_files": SO.capped_files,
        "sum_or_zero_value": SO.sum_or_zero_value,
        "partition_rows": SO.partition_rows,
        "nan_values": SO.nan_values,
        "file_metadata": SO.file_metadata,
    }
    return {k: _prepared(v) for k, v in q.items()}


def oracle_sql() -> dict[str, str]:
    sql = dict(BATCH_SQL)
    sql.update(LY.LAYOUT_SQL)
    sql.update(V.VERSIONED_SQL)
    sql.update(S.STREAM_SQL)
    sql.update(D.DRIFT_SQL)
    sql.update(M.MONITORING_SQL)
    sql.update(SO.SOURCES_SQL)
    sql.update(N.NESTED_SQL)
    return sql
