"""Every registered query by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.plans import events, generated, star

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "region_month_agg": star.region_month_agg,
    "top_per_region": star.top_per_region,
    "events_region_hour": events.events_region_hour,
    "clean_rows": star.clean_rows,
    "derive_columns": star.derive_columns,
    "scan_accounting": star.scan_accounting,
    "reject_by_rule": star.reject_by_rule,
    "source_rows": star.source_rows,
    "dim_projection": star.dim_projection,
    "dim_join": star.dim_join,
    "key_profile": star.key_profile(30),
    "key_profile_85": star.key_profile(85),
    "top_keys": star.top_keys,
    "campaign_dim": star.campaign_dim,
    "salt_replicate": star.salt_replicate,
    "skew_join_plain": star.skew_join("plain"),
    "skew_join_salted": star.skew_join("salted"),
    "skew_join_selective": star.skew_join("selective"),
    "skew_join_plain_85": star.skew_join("plain", 85),
    "skew_join_salted_85": star.skew_join("salted", 85),
    "skew_join_selective_85": star.skew_join("selective", 85),
    "skew_join_preagg": star.skew_join("preagg"),
    "rollup_partial": star.rollup_partial,
    "rollup_merge": star.rollup_merge,
    "rollup_distinct_merge": star.rollup_distinct_merge,
    "rollup_value_counts": star.rollup_value_counts,
    "rollup_many_values": star.rollup_many_values,
    "rollup_top": star.rollup_top,
    "union_parts": star.union_parts,
    "gen_trips": generated.gen_trips,
    "gen_zones": generated.gen_zones,
    "gen_trips_skewed": generated.gen_trips_skewed,
    "gen_hot_zones": generated.gen_hot_zones,
    "gen_dirty_rate": generated.gen_dirty_rate,
    "trips_borough_hour": generated.trips_borough_hour,
    "trips_direct": generated.trips_direct,
    "trips_top_zones": generated.trips_top_zones,
    "table_diff": star.table_diff,
    "row_diff": star.row_diff,
    "table_diff_gate": star.table_diff_gate,
    "repartition_invariance": star.repartition_invariance,
    "measure_summary": events.measure_summary,
    "measure_values": events.measure_values,
    "measure_speedup": events.measure_speedup,
    "measure_throughput": events.measure_throughput,
    "measure_best": events.measure_best,
    "measure_cost_ratio": events.measure_cost_ratio,
    "measure_largest": events.measure_largest,
    "csv_roundtrip": star.roundtrip("csv"),
    "parquet_roundtrip": star.roundtrip("parquet"),
    "json_roundtrip": star.roundtrip("json"),
}
