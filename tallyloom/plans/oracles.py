"""The same questions in ANSI SQL, for an independent engine to answer."""

from __future__ import annotations

SUPPLIER_REGION = """
    SELECT s.s_suppkey, r.r_name
    FROM supplier s
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey"""

LAG = "date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE))"

LINES = f"""
    SELECT l.*, o.o_orderdate, CAST({LAG} AS BIGINT) AS lag
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

KEPT = f"""
    SELECT x.*, l_quantity / CAST(lag AS DOUBLE) AS rate,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total,
           l_extendedprice * l_tax / l_extendedprice * 100 AS tax_pct,
           CAST(month(l_shipdate) AS BIGINT) AS ship_month,
           CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS order_month
    FROM ({LINES}) x
    WHERE l_quantity BETWEEN 2 AND 48 AND l_extendedprice >= 1500 AND lag BETWEEN 1 AND 2000"""

REGION_MONTH_RAW = f"""
    SELECT r_name, ship_month, count(l_orderkey) AS n, sum(total) AS revenue,
           avg(l_extendedprice) AS avg_price, avg(rate) AS avg_rate,
           avg(tax_pct) AS avg_tax_pct, max(l_quantity) AS max_quantity,
           count(DISTINCT l_returnflag) AS n_flags
    FROM ({KEPT}) k JOIN ({SUPPLIER_REGION}) s ON k.l_suppkey = s.s_suppkey
    GROUP BY r_name, ship_month"""

REGION_MONTH = f"""
    SELECT r_name, ship_month, n, round(revenue, 2) AS revenue,
           round(avg_price * n, 2) / n AS avg_price, round(avg_rate, 6) AS avg_rate,
           round(avg_tax_pct * n, 6) / n AS avg_tax_pct, max_quantity, n_flags
    FROM ({REGION_MONTH_RAW}) a"""

TOP_PER_REGION = f"""
    SELECT r_name, rank, l_suppkey, revenue, n FROM (
        SELECT r_name, l_suppkey, revenue, n,
               row_number() OVER (PARTITION BY r_name ORDER BY revenue DESC, l_suppkey) AS rank
        FROM (SELECT r_name, l_suppkey, round(sum(total), 2) AS revenue,
                     count(l_orderkey) AS n
              FROM ({KEPT}) k JOIN ({SUPPLIER_REGION}) s ON k.l_suppkey = s.s_suppkey
              GROUP BY r_name, l_suppkey) t) ranked
    WHERE rank <= 5"""

FAILS = {
    "quantity": "NOT (l_quantity BETWEEN 2 AND 48)",
    "price": "NOT (l_extendedprice >= 1500)",
    "lag": "NOT (lag BETWEEN 1 AND 2000)",
}
FAILS = {name: f"coalesce({fails}, true)" for name, fails in FAILS.items()}
FAILS["order"] = "o_orderkey IS NULL"
ANY_FAILS = " OR ".join(FAILS.values())

ALL_LINES = f"""
    SELECT l.*, o.o_orderkey, CAST({LAG} AS BIGINT) AS lag
    FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey"""

EVENTS_REGION_HOUR = """
    SELECT r_name, hour, count(event_id) AS n, round(sum(value), 2) AS amount,
           round(avg(value) * count(event_id), 2) / count(event_id) AS avg_value,
           max(value) AS max_value,
           count(DISTINCT event_type) AS n_types
    FROM (SELECT *, CAST(floor((CAST(floor(epoch(ts)) AS BIGINT) % 86400) / 3600) AS BIGINT)
                    AS hour
          FROM events WHERE value BETWEEN 0.1 AND 200) e
    JOIN customer c ON e.user_id = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    GROUP BY r_name, hour"""


def injected(percent: int) -> str:
    return f"""
    SELECT CASE WHEN l_orderkey % 100 < {percent} THEN 16 ELSE l_suppkey END AS key
    FROM lineitem"""


def key_profile(percent: int) -> str:
    return f"""
    SELECT key, "rows", "rows" / total AS share, greatest("rows" / total * 8, 1e0) AS gain_bound
    FROM (SELECT key, count(*) AS "rows" FROM ({injected(percent)}) i GROUP BY key) c,
         (SELECT CAST(count(*) AS DOUBLE) AS total FROM lineitem) t"""


CAMPAIGNS = """
    SELECT CAST(p_partkey % (SELECT count(*) FROM supplier) AS INTEGER) AS zone_id,
           CAST(p_partkey % 97 + 1 AS DOUBLE) AS campaign_budget
    FROM part"""


def skew_join(percent: int) -> str:
    """Both sides per key, so that the oracle does not build the joined rows either."""
    return f"""
    SELECT l.key, s.amount * l.n AS budget, CAST(l.n * s.n AS BIGINT) AS n
    FROM (SELECT key, count(*) AS n FROM ({injected(percent)}) i GROUP BY key) l
    JOIN (SELECT zone_id, sum(campaign_budget) AS amount, count(*) AS n
          FROM ({CAMPAIGNS}) c GROUP BY zone_id) s ON l.key = s.zone_id"""


SKEW_JOIN_PAIRS = f"""
    SELECT key, sum(campaign_budget) AS budget, count(*) AS n
    FROM ({injected(30)}) i JOIN ({CAMPAIGNS}) c ON i.key = c.zone_id
    GROUP BY key"""

ROLLUP_PARTIAL = f"""
    SELECT order_month, r_name, ship_month, count(l_orderkey) AS n,
           round(sum(total), 2) AS revenue, round(sum(l_extendedprice), 2) AS sum_price,
           count(l_extendedprice) AS n_price, round(sum(rate), 6) AS sum_rate,
           max(l_quantity) AS max_quantity,
           string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags,
           count(DISTINCT l_returnflag) AS n_flags
    FROM ({KEPT}) k JOIN ({SUPPLIER_REGION}) s ON k.l_suppkey = s.s_suppkey
    GROUP BY order_month, r_name, ship_month"""

ROLLUP_DISTINCT = f"""
    SELECT r_name, ship_month,
           string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags,
           count(DISTINCT l_returnflag) AS n_flags
    FROM ({KEPT}) k JOIN ({SUPPLIER_REGION}) s ON k.l_suppkey = s.s_suppkey
    GROUP BY r_name, ship_month"""

ROLLUP_VALUES = f"""
    SELECT r_name, ship_month, l_returnflag AS value, count(*) AS rows
    FROM ({KEPT}) k JOIN ({SUPPLIER_REGION}) s ON k.l_suppkey = s.s_suppkey
    GROUP BY r_name, ship_month, l_returnflag"""

ROLLUP_MANY = f"""
    SELECT r_name, count(*) AS n, count(DISTINCT l_returnflag) AS n_flags,
           count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_suppkey) AS n_suppliers
    FROM ({KEPT}) k JOIN ({SUPPLIER_REGION}) s ON k.l_suppkey = s.s_suppkey
    GROUP BY r_name"""

UNION_PARTS = """
    SELECT l_linestatus, count(*) AS n, sum(l_quantity) AS quantity,
           round(sum(l_extendedprice), 2) AS price
    FROM lineitem GROUP BY l_linestatus"""


# Comparison


def diff_report(left: str, right: str, keys: list[str], exact: list[str], floats: list[str],
                order: list[str], names: tuple[str, str]) -> str:
    """Full outer join of two keyed tables, one row per value column."""
    on = " AND ".join(f"l.{k} = r.{k}" for k in keys)
    both = f"l.{keys[0]} IS NOT NULL AND r.{keys[0]} IS NOT NULL"
    rows = []
    for c in order:
        if c in floats:
            bad = f"abs(l.{c} - r.{c}) > 1e-9 + 1e-9 * abs(r.{c})"
            worst = (f"round(max(CASE WHEN {both} THEN abs(l.{c} - r.{c}) / "
                     f"CASE WHEN r.{c} = 0 THEN 1 ELSE abs(r.{c}) END END), 12)")
        else:
            bad, worst = f"l.{c} <> r.{c}", "CAST(NULL AS DOUBLE)"
        rows.append(f"""
    SELECT '{names[0]}' AS baseline, '{names[1]}' AS other, '{c}' AS "column",
           '{"float" if c in floats else "exact"}' AS kind,
           count(*) FILTER (WHERE {both}) AS compared,
           count(*) FILTER (WHERE {both} AND ({bad})) AS mismatches,
           {worst} AS worst_rel_error,
           count(*) FILTER (WHERE r.{keys[0]} IS NULL) AS left_only,
           count(*) FILTER (WHERE l.{keys[0]} IS NULL) AS right_only,
           CAST(0 AS BIGINT) AS duplicate_keys
    FROM ({left}) l FULL OUTER JOIN ({right}) r ON {on}""")
    return " UNION ALL ".join(rows)


SUPPLIER_TOTALS = """
    SELECT l_suppkey, count(*) AS n, sum(l_extendedprice) AS price,
           max(l_quantity) AS max_quantity, max(l_returnflag) AS last_flag
    FROM lineitem GROUP BY l_suppkey"""

PERTURBED = f"""
    SELECT CASE WHEN l_suppkey % 25 = 9 THEN -l_suppkey ELSE l_suppkey END AS l_suppkey,
           CASE WHEN l_suppkey % 10 = 5 THEN n + 1 ELSE n END AS n,
           CASE WHEN l_suppkey % 10 = 3 THEN price * (1 + 1e-6)
                WHEN l_suppkey % 10 = 4 THEN price * (1 + 1e-12) ELSE price END AS price,
           CASE WHEN l_suppkey % 10 = 8 THEN 0.0 ELSE max_quantity END AS max_quantity,
           CASE WHEN l_suppkey % 10 = 6 THEN '?' ELSE last_flag END AS last_flag
    FROM ({SUPPLIER_TOTALS}) t WHERE l_suppkey % 25 <> 7"""

TABLE_DIFF = diff_report(SUPPLIER_TOTALS, PERTURBED, ["l_suppkey"], ["n", "last_flag"],
                         ["price", "max_quantity"],
                         ["n", "price", "max_quantity", "last_flag"], ("left", "right"))

ROW_DIFF = """
    SELECT l_suppkey, l_quantity, l_returnflag, CAST(sum(sign) AS BIGINT) AS surplus
    FROM (SELECT l_suppkey, l_quantity, l_returnflag, 1 AS sign FROM lineitem
          UNION ALL
          SELECT l_suppkey, l_quantity,
                 CASE WHEN l_quantity = 7 THEN '?' ELSE l_returnflag END, -1
          FROM lineitem WHERE l_quantity <> 13) u
    GROUP BY l_suppkey, l_quantity, l_returnflag HAVING sum(sign) <> 0"""

WRONG = f"""
    SELECT r_name, ship_month, CASE WHEN ship_month = 5 THEN n + 1 ELSE n END AS n,
           CASE WHEN ship_month = 6 THEN revenue * 1.5 ELSE revenue END AS revenue,
           avg_price, avg_rate, avg_tax_pct, max_quantity, n_flags
    FROM ({REGION_MONTH_RAW}) d"""

_GATE = (["r_name", "ship_month"], ["n", "n_flags"],
         ["revenue", "avg_price", "avg_rate", "avg_tax_pct", "max_quantity"],
         ["n", "revenue", "avg_price", "avg_rate", "avg_tax_pct", "max_quantity", "n_flags"])

TABLE_DIFF_GATE = (
    diff_report(REGION_MONTH_RAW, REGION_MONTH_RAW, *_GATE, ("direct", "merged"))
    + " UNION ALL " + diff_report(REGION_MONTH_RAW, WRONG, *_GATE, ("direct", "wrong")))

INVARIANCE = " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", '{"exact" if c in ("n", "n_flags") else "float"}' AS kind,
           CAST(2 AS BIGINT) AS runs, CAST(2 * count(*) AS BIGINT) AS compared,
           CAST(0 AS BIGINT) AS mismatches, CAST(0 AS BIGINT) AS left_only,
           CAST(0 AS BIGINT) AS right_only, CAST(0 AS BIGINT) AS duplicate_keys
    FROM ({REGION_MONTH_RAW}) d""" for c in _GATE[3])


# Measurements

RUNS = """
    SELECT event_type, event_id, ts, value,
           CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS BIGINT) AS level
    FROM events WHERE event_type <> 'error'"""

SUMMARY = f"""
    SELECT event_type, level, count(*) AS runs, round(median(value), 6) AS median,
           min(value) AS min, max(value) AS max, 
           count(*) / nullif(round(median(value), 6), 0) AS per_unit
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type, level
                                       ORDER BY ts, event_id) AS repetition
          FROM ({RUNS}) r) n
    WHERE repetition > 1 GROUP BY event_type, level"""

BASED = f"""
    SELECT s.*, first_value(median) OVER w AS base, first_value(min) OVER w AS base_best
    FROM ({SUMMARY}) s WINDOW w AS (PARTITION BY event_type ORDER BY level)"""

MEASURE_SPEEDUP = f"""
    SELECT event_type, level, base / nullif(median, 0) AS speedup,
           base / nullif(max, 0) AS speedup_low, base / nullif(min, 0) AS speedup_high
    FROM ({BASED}) b"""

MEASURE_THROUGHPUT = f"""
    SELECT event_type, level, base / nullif(median, 0) / level AS efficiency,
           base_best * level / nullif(min, 0) AS throughput_x
    FROM ({BASED}) b"""

MEASURE_BEST = f"""
    SELECT event_type, level, min(value) AS best FROM ({RUNS}) r GROUP BY event_type, level"""

JOBS = """
    SELECT *, rows / nullif(compute_s, 0) AS rows_per_s FROM (
        SELECT event_type, user_id, sec // 864000 AS days, count(*) AS rows,
               round(sum(value), 2) AS compute_s,
               round(sum(value), 2) + (max(sec) - min(sec)) AS wall_s,
               CAST(1 << CAST(user_id % 4 AS INTEGER) AS BIGINT) AS cores
        FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS sec FROM events) e
        GROUP BY event_type, user_id, days) j"""

JOB_VALUES = ("rows", "compute_s", "wall_s", "rows_per_s")

JOB_SUMMARY = f"""
    SELECT event_type, cores, count(*) AS runs, {", ".join(
        f"round(median({v}), 6) AS {v}_median, CAST(min({v}) AS DOUBLE) AS {v}_min, "
        f"CAST(max({v}) AS DOUBLE) AS {v}_max" for v in JOB_VALUES)}
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type, cores
                                       ORDER BY days, user_id) AS repetition
          FROM ({JOBS}) j) n
    WHERE repetition > 1 GROUP BY event_type, cores"""

MEASURE_VALUES = f"""
    SELECT *, rows_per_s_median / cores AS rows_per_s_core FROM ({JOB_SUMMARY}) s"""

MEASURE_COST_RATIO = f"""
    WITH rates AS (SELECT event_type, cores, rows_median / nullif(compute_s_median * cores, 0) AS rate
                   FROM ({JOB_SUMMARY}) s)
    SELECT a.event_type, a.cores, a.rate AS rows_per_s_core, b.rate / nullif(a.rate, 0) AS cost_ratio
    FROM rates a LEFT JOIN rates b ON a.cores = b.cores AND b.event_type = 'click'"""

MEASURE_LARGEST = f"""
    WITH sizes AS (SELECT event_type, level, count(*) AS n FROM ({RUNS}) r
                   GROUP BY event_type, level)
    SELECT event_type, CAST(sum(n) AS BIGINT) AS "rows",
           CAST((SELECT s.level FROM sizes s WHERE s.event_type = t.event_type
                 ORDER BY s.n DESC, s.level LIMIT 1) AS BIGINT) AS largest_level
    FROM sizes t GROUP BY event_type"""


# Generated trips


MASK = "4294967295"


def mix(x: str, shift: int) -> str:
    return f"((xor(({x}) >> {shift}, {x}) * 73244475) & {MASK})"


def words(source: str, key: str, columns: str) -> str:
    """The two words a and b that the uniforms of seed 0 start from (0x9e3779b9 times 1, 2)."""
    return f"""
    SELECT *, {mix("t", 16)} AS b
    FROM (SELECT *, xor(xor(xor(a >> 16, a), id >> 32), 1013904242) AS t
          FROM (SELECT *, {mix("s", 15)} AS a
                FROM (SELECT *, {mix(f"xor(id & {MASK}, 2654435769)", 16)} AS s
                      FROM (SELECT {columns}, CAST({key} AS BIGINT) AS id FROM {source}) i0
                ) i1) i2) i3"""


def uniform(number: int) -> str:
    y = mix(mix(f"((a + b * {number + 1}) & {MASK})", 16), 15)
    return f"((CAST(xor(({y}) >> 16, {y}) AS DOUBLE) + 0.5e0) / 4294967296e0)"


def zones(source: str, key: str) -> str:
    return f"""
    SELECT CAST(id AS INTEGER) AS zone_id,
           CASE WHEN u < 0.35e0 THEN 'Manhattan' WHEN u < 0.6e0 THEN 'Brooklyn'
                WHEN u < 0.8e0 THEN 'Queens' WHEN u < 0.93e0 THEN 'Bronx'
                WHEN u < 0.98e0 THEN 'Staten Island' ELSE 'EWR' END AS borough,
           printf('Zone %03d', CAST(id AS INTEGER)) AS zone_name
    FROM (SELECT id, {uniform(16)} AS u FROM ({words(source, key, key)}) w) drawn"""


def trips(hot_share: float | None = None) -> str:
    two_pi = "6.283185307179586e0"
    zone = "CAST(floor(u0 * 265) + 1 AS INTEGER)"
    if hot_share is not None:
        zone = f"CASE WHEN u1 < {hot_share}e0 THEN 132 ELSE {zone} END"
    streams = ", ".join(f"{uniform(k)} AS u{k}" for k in range(16))
    return f"""
    SELECT trip_id, vendor_id, pickup_zone_id, dropoff_zone_id, pickup_ts,
           pickup_ts + duration_s AS dropoff_ts, passenger_count,
           CASE WHEN dirty THEN 0e0 ELSE km END AS trip_distance_km,
           CASE WHEN dirty THEN -1e0 ELSE fare END AS fare_amount,
           floor(fare * tip_rate * 100 + 0.5e0) / 100 AS tip_amount, payment_type
    FROM (SELECT *, floor((km * 2.6e0 + 3e0 + duration_s / 60e0 * 0.45e0) * 100 + 0.5e0) / 100
                    AS fare
          FROM (SELECT *, CAST(floor(least(greatest(km / kmh * 3600 + stop_s, 5e0), 28800e0))
                          AS BIGINT) AS duration_s
                FROM (
        SELECT id AS trip_id,
               CAST(floor(u11 * 3) + 1 AS SMALLINT) AS vendor_id,
               {zone} AS pickup_zone_id,
               CAST(floor(u12 * 265) + 1 AS INTEGER) AS dropoff_zone_id,
               CAST(floor(floor(u2 * 30) * 86400
                    + least(greatest(CASE WHEN u3 < 0.5e0 THEN 8.5e0 ELSE 18e0 END
                      + sqrt(ln(u4) * -2e0) * cos(u5 * {two_pi}) * 3e0, 0e0), 23.999e0)
                      * 3600 + u6 * 60) AS BIGINT) + 1704067200 AS pickup_ts,
               CAST(floor(u13 * 6) + 1 AS SMALLINT) AS passenger_count,
               CASE WHEN u14 < 0.7e0 THEN 'card' WHEN u14 < 0.9e0 THEN 'cash'
                    ELSE 'wallet' END AS payment_type,
               floor(exp(sqrt(ln(u4) * -2e0) * sin(u5 * {two_pi}) * 0.85e0 + 0.7e0)
                     * 100 + 0.5e0) / 100 AS km,
               u7 * 37e0 + 8e0 AS kmh,
               sqrt(ln(u8) * -2e0) * cos(u9 * {two_pi}) * 60e0 + 120e0 AS stop_s,
               CASE WHEN u10 < 0.25e0 THEN 0e0 WHEN u10 < 0.4e0 THEN 0.1e0
                    WHEN u10 < 0.65e0 THEN 0.15e0 WHEN u10 < 0.9e0 THEN 0.2e0
                    ELSE 0.25e0 END AS tip_rate,
               u15 < 0.04e0 AS dirty
        FROM (SELECT id, {streams}
              FROM ({words("orders", "o_orderkey", "o_orderkey")}) w) drawn
        ) shaped) timed) priced"""


GEN_DIRTY_RATE = f"""
    SELECT count(*) AS n,
           count(*) FILTER (WHERE trip_distance_km = 0 AND fare_amount = -1) AS dirty,
           count(*) FILTER (WHERE trip_distance_km = 0 OR fare_amount = -1) AS "either",
           count(*) FILTER (WHERE trip_distance_km = 0 AND fare_amount = -1)
               / CAST(count(*) AS DOUBLE) AS share
    FROM ({trips()}) t"""

JOINED_TRIPS = f"""
    SELECT t.*, z.zone_id, z.borough, fare_amount + tip_amount AS total_amount,
           tip_amount / fare_amount * 100 AS tip_pct,
           trip_distance_km / ((dropoff_ts - pickup_ts) / 3600e0) AS speed_kmh,
           CAST(floor((pickup_ts % 86400) / 3600) AS BIGINT) AS pickup_hour
    FROM ({trips()}) t
    JOIN ({zones("(SELECT range AS z FROM range(1, 266)) ids", "z")}) z
      ON t.pickup_zone_id = z.zone_id
    WHERE trip_distance_km BETWEEN 0.1 AND 200 AND fare_amount >= 2.5
      AND dropoff_ts - pickup_ts BETWEEN 60 AND 21600"""

TRIPS_BOROUGH_HOUR = f"""
    SELECT borough, pickup_hour, count(trip_id) AS trips,
           round(sum(total_amount), 2) AS total_revenue,
           round(avg(fare_amount) * count(trip_id), 2) / count(trip_id) AS avg_fare,
           round(avg(tip_pct), 6) AS avg_tip_pct, round(avg(speed_kmh), 6) AS avg_speed_kmh,
           max(trip_distance_km) AS max_distance_km, count(DISTINCT vendor_id) AS n_vendors
    FROM ({JOINED_TRIPS}) j GROUP BY borough, pickup_hour"""

TRIPS_TOP_ZONES = f"""
    SELECT borough, rank, zone_id, round(zone_revenue, 2) AS zone_revenue, zone_trips FROM (
        SELECT *, row_number() OVER (PARTITION BY borough
                                     ORDER BY zone_revenue DESC, zone_id) AS rank
        FROM (SELECT borough, zone_id, sum(total_amount) AS zone_revenue,
                     count(trip_id) AS zone_trips
              FROM ({JOINED_TRIPS}) j GROUP BY borough, zone_id) t) r
    WHERE rank <= 5"""

ORACLES: dict[str, str] = {
    "region_month_agg": REGION_MONTH,
    "top_per_region": TOP_PER_REGION,
    "events_region_hour": EVENTS_REGION_HOUR,
    "clean_rows": f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
                             lag FROM ({KEPT}) k""",
    "derive_columns": f"""SELECT l_orderkey, l_linenumber, l_suppkey, lag, rate, total, tax_pct,
                                 ship_month FROM ({KEPT}) k""",
    "scan_accounting": f"""
        SELECT count(*) AS rows_in, count(*) FILTER (WHERE NOT ({ANY_FAILS})) AS rows_kept,
               count(*) FILTER (WHERE {ANY_FAILS}) AS rows_rejected FROM ({ALL_LINES}) l""",
    "reject_by_rule": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS rejected FROM ({ALL_LINES}) l WHERE {fails}"
        for name, fails in FAILS.items()),
    "source_rows": "SELECT count(*) AS rows_in FROM lineitem",
    "dim_projection": SUPPLIER_REGION,
    "dim_join": f"""
        SELECT r_name, count(*) AS n, sum(l_quantity) AS quantity
        FROM lineitem l JOIN ({SUPPLIER_REGION}) s ON l.l_suppkey = s.s_suppkey
        GROUP BY r_name""",
    "key_profile": key_profile(30),
    "key_profile_85": key_profile(85),
    "top_keys": f"""SELECT key, count(*) AS "rows" FROM ({injected(30)}) i GROUP BY key
                    ORDER BY "rows" DESC, key LIMIT 3""",
    "campaign_dim": CAMPAIGNS,
    "salt_replicate": f"""SELECT c.*, CAST(s.range AS INTEGER) AS salt
                          FROM ({CAMPAIGNS}) c, range(16) s""",
    "skew_join_plain": SKEW_JOIN_PAIRS,
    "skew_join_salted": SKEW_JOIN_PAIRS,
    "skew_join_selective": SKEW_JOIN_PAIRS,
    "skew_join_plain_85": skew_join(85),
    "skew_join_salted_85": skew_join(85),
    "skew_join_selective_85": skew_join(85),
    "skew_join_preagg": SKEW_JOIN_PAIRS,
    "rollup_partial": ROLLUP_PARTIAL,
    "rollup_merge": REGION_MONTH,
    "rollup_distinct_merge": ROLLUP_DISTINCT,
    "rollup_value_counts": ROLLUP_VALUES,
    "rollup_many_values": ROLLUP_MANY,
    "rollup_top": TOP_PER_REGION,
    "union_parts": UNION_PARTS,
    "gen_trips": trips(),
    "gen_zones": zones("supplier", "s_suppkey"),
    "gen_trips_skewed": f"""SELECT pickup_zone_id, count(*) AS n FROM ({trips(0.3)}) t
                            GROUP BY pickup_zone_id""",
    "gen_hot_zones": f"""SELECT pickup_zone_id, count(*) AS n FROM ({trips(0.85)}) t
                         GROUP BY pickup_zone_id ORDER BY n DESC, pickup_zone_id LIMIT 3""",
    "gen_dirty_rate": GEN_DIRTY_RATE,
    "trips_borough_hour": TRIPS_BOROUGH_HOUR,
    "trips_direct": TRIPS_BOROUGH_HOUR,
    "trips_top_zones": TRIPS_TOP_ZONES,
    "table_diff": TABLE_DIFF,
    "row_diff": ROW_DIFF,
    "table_diff_gate": TABLE_DIFF_GATE,
    "repartition_invariance": INVARIANCE,
    "measure_summary": SUMMARY,
    "measure_values": MEASURE_VALUES,
    "measure_speedup": MEASURE_SPEEDUP,
    "measure_throughput": MEASURE_THROUGHPUT,
    "measure_best": MEASURE_BEST,
    "measure_cost_ratio": MEASURE_COST_RATIO,
    "measure_largest": MEASURE_LARGEST,
    "csv_roundtrip": REGION_MONTH,
    "parquet_roundtrip": REGION_MONTH,
    "json_roundtrip": REGION_MONTH,
}
