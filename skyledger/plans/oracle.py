"""Independent DuckDB SQL for every SQL-checkable query.

Each statement rebuilds bookings -> landing -> validated from the base
tables with plain SQL (no shared code with the Spark side), then computes
one result. Column names and types match the Spark queries.
"""

from __future__ import annotations

RUN_ID = "fixture-run-0001"

BASE = f"""
WITH bookings AS (
  SELECT p.p_brand AS airline, sn.n_name AS source, cn.n_name AS destination,
    l.l_shipdate + INTERVAL '1' HOUR * (l.l_partkey % 24) AS departure_time,
    l.l_shipdate + INTERVAL '1' HOUR * (l.l_partkey % 24)
      + INTERVAL '1' MINUTE * CAST(l.l_quantity * 20 AS INT) AS arrival_time,
    l.l_quantity / 3.0 AS duration,
    CASE l.l_linenumber % 3 WHEN 0 THEN 'Direct' WHEN 1 THEN '1 Stop' ELSE '2 Stops' END AS stops,
    p.p_type AS aircraft_type,
    CASE o.o_orderstatus WHEN 'F' THEN 'Economy' WHEN 'O' THEN 'Business' ELSE 'First Class' END AS booking_class,
    CASE l.l_returnflag WHEN 'A' THEN 'Direct Booking' WHEN 'N' THEN 'Online Website' ELSE 'Travel Agency' END AS booking_source,
    CAST((l.l_partkey * 7 + l.l_orderkey) % 90 + 1 AS BIGINT) AS days_before_departure,
    CAST(NULL AS VARCHAR) AS seasonality,
    CAST(CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l.l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS base_fare,
    CASE WHEN l.l_tax = 0 THEN NULL
         ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) END AS tax_and_surcharge
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN customer cu ON o.o_custkey = cu.c_custkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey JOIN nation cn ON cu.c_nationkey = cn.n_nationkey
),
raw AS (
  SELECT row_number() OVER (ORDER BY departure_time NULLS FIRST, airline NULLS FIRST,
      source NULLS FIRST, destination NULLS FIRST, arrival_time NULLS FIRST,
      duration NULLS FIRST, stops NULLS FIRST, aircraft_type NULLS FIRST,
      booking_class NULLS FIRST, booking_source NULLS FIRST,
      days_before_departure NULLS FIRST, seasonality NULLS FIRST,
      base_fare NULLS FIRST, tax_and_surcharge NULLS FIRST, total_fare NULLS FIRST) - 1 AS id,
    *, '{RUN_ID}' AS pipeline_run_id
  FROM (SELECT *, CAST(base_fare + tax_and_surcharge AS DECIMAL(12,2)) AS total_fare FROM bookings) b
),
cleaned AS (
  SELECT *,
    CAST(abs(base_fare) AS DECIMAL(12,2)) AS new_base,
    CAST(coalesce(tax_and_surcharge, 0) AS DECIMAL(12,2)) AS new_tax,
    CAST(abs(base_fare) + coalesce(tax_and_surcharge, 0) AS DECIMAL(12,2)) AS new_total,
    month(departure_time) * 100 + day(departure_time) AS md
  FROM raw
),
validated AS (
  SELECT id AS raw_id, airline, source, destination, departure_time, arrival_time, duration,
    CAST(round(duration * 60) AS INTEGER) AS duration_minutes,
    CASE stops WHEN 'Direct' THEN 0 WHEN '1 Stop' THEN 1 WHEN '2 Stops' THEN 2 END AS stops,
    aircraft_type, booking_class, booking_source, days_before_departure, seasonality,
    new_base AS base_fare, new_tax AS tax_and_surcharge, new_total AS total_fare,
    CAST(departure_time AS DATE) AS travel_date,
    CASE WHEN md BETWEEN 419 AND 426 OR md BETWEEN 408 AND 415
           OR md BETWEEN 626 AND 703 OR md BETWEEN 615 AND 622
           OR md BETWEEN 1220 AND 1231 OR md BETWEEN 101 AND 105
           OR md BETWEEN 412 AND 416 THEN 1 ELSE 0 END AS is_peak_season,
    CASE WHEN md BETWEEN 419 AND 426 OR md BETWEEN 408 AND 415 THEN 'Eid al-Fitr'
         WHEN md BETWEEN 626 AND 703 OR md BETWEEN 615 AND 622 THEN 'Eid al-Adha'
         WHEN md BETWEEN 1220 AND 1231 OR md BETWEEN 101 AND 105 THEN 'Winter Holidays'
         WHEN md BETWEEN 412 AND 416 THEN 'Pohela Boishakh'
         ELSE 'Regular' END AS season_label,
    CASE WHEN airline IS NULL OR source IS NULL OR destination IS NULL OR base_fare IS NULL THEN 'flagged'
         WHEN base_fare < 0 OR tax_and_surcharge IS NULL
              OR (total_fare IS NOT NULL AND total_fare <> new_total) THEN 'corrected'
         ELSE 'valid' END AS validation_status,
    NULLIF(concat_ws('; ',
      CASE WHEN base_fare < 0 THEN 'negative base_fare made positive' END,
      CASE WHEN tax_and_surcharge IS NULL THEN 'missing tax_and_surcharge set to 0' END,
      CASE WHEN total_fare IS NOT NULL AND total_fare <> new_total THEN 'total_fare recomputed' END,
      CASE WHEN airline IS NULL THEN 'missing airline' END,
      CASE WHEN source IS NULL THEN 'missing source' END,
      CASE WHEN destination IS NULL THEN 'missing destination' END,
      CASE WHEN base_fare IS NULL THEN 'missing base_fare' END), '') AS validation_notes,
    pipeline_run_id
  FROM cleaned
)
"""

AVG = "CAST(SUM({c}) AS DOUBLE) / NULLIF(COUNT({c}), 0)"


def avg(c: str) -> str:
    return AVG.format(c=c)


def rmean(total: str, count: str, d: int) -> str:
    """Exact half-up rounding of a cents-scale decimal sum / count, as DOUBLE."""
    k = 10 ** (2 - d)
    return (f"(CAST(sign({total}) * ((2 * abs(CAST({total} * 100 AS HUGEINT)) + {k} * {count})"
            f" // (2 * {k} * NULLIF({count}, 0))) AS DOUBLE) / {10 ** d}.0)")


def ravg(c: str, d: int) -> str:
    return rmean(f"SUM({c})", f"COUNT({c})", d)


SQL: dict[str, str] = {}

SQL["validate_bookings"] = BASE + "SELECT * FROM validated"

SQL["kpi_avg_fare"] = BASE + f"""
SELECT airline, {avg('total_fare')} AS avg_fare, COUNT(*) AS bookings
FROM validated GROUP BY airline"""

R = f"'{RUN_ID}' AS pipeline_run_id"

# --- sources / sinks --------------------------------------------------------
SQL["ingest_bookings"] = BASE + "SELECT * FROM raw"
SQL["scan_run"] = BASE + f"SELECT * FROM raw WHERE pipeline_run_id = '{RUN_ID}'"
SQL["transfer_run"] = BASE + """
SELECT airline, source, destination, departure_time, base_fare, tax_and_surcharge, total_fare,
       pipeline_run_id FROM validated"""
SQL["apply_defaults"] = BASE + """
SELECT raw_id, coalesce(stops, 0) AS stops,
       CAST(coalesce(tax_and_surcharge, 0) AS DECIMAL(12,2)) AS tax_and_surcharge,
       coalesce(is_peak_season, 0) AS is_peak_season,
       coalesce(validation_status, 'valid') AS validation_status
FROM validated"""

# --- validation and quality ---------------------------------------------------
SQL["season_classify"] = BASE + "SELECT raw_id, departure_time, is_peak_season, season_label FROM validated"
SQL["dq_required"] = BASE + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, true AS present, COUNT(*) AS records_checked, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM raw"
    for c in ["airline", "source", "destination", "base_fare", "tax_and_surcharge", "total_fare"])
SQL["fare_mismatch"] = BASE + """
SELECT id AS raw_id, base_fare, tax_and_surcharge, total_fare AS stated_total,
       new_total AS recomputed_total, CAST(new_total - total_fare AS DECIMAL(12,2)) AS difference
FROM cleaned WHERE total_fare IS NOT NULL AND new_total IS NOT NULL AND total_fare <> new_total"""
SQL["validation_status"] = BASE + """
SELECT s.validation_status, COUNT(v.raw_id) AS rows
FROM (VALUES ('valid'), ('corrected'), ('flagged')) s(validation_status)
LEFT JOIN validated v ON v.validation_status = s.validation_status
GROUP BY s.validation_status"""
SQL["validation_audit"] = BASE + """
, r AS (SELECT COUNT(*) AS n,
          COUNT(*) FILTER (WHERE base_fare < 0) AS neg,
          COUNT(*) FILTER (WHERE tax_and_surcharge IS NULL) AS null_tax,
          COUNT(*) FILTER (WHERE airline IS NULL) AS null_airline,
          COUNT(*) FILTER (WHERE source IS NULL) AS null_source,
          COUNT(*) FILTER (WHERE destination IS NULL) AS null_destination,
          COUNT(*) FILTER (WHERE base_fare IS NULL) AS null_base_fare FROM raw),
v AS (SELECT COUNT(*) AS n,
          COUNT(*) FILTER (WHERE total_fare <> base_fare + tax_and_surcharge) AS bad_total,
          COUNT(*) FILTER (WHERE base_fare < 0) AS neg,
          COUNT(*) FILTER (WHERE validation_status = 'flagged') AS flagged FROM validated),
c AS (
  SELECT 'row_count_preserved' AS check_name, abs(r.n - v.n) AS failed, r.n AS checked, 'FAIL' AS bad, 'validated rows equal raw rows' AS details FROM r, v
  UNION ALL SELECT 'negative_base_fare', neg, n, 'WARN', 'negative base fares corrected with abs()' FROM r
  UNION ALL SELECT 'null_tax_and_surcharge', null_tax, n, 'WARN', 'null tax set to 0' FROM r
  UNION ALL SELECT 'required_airline', null_airline, n, 'FAIL', 'airline must not be null' FROM r
  UNION ALL SELECT 'required_source', null_source, n, 'FAIL', 'source must not be null' FROM r
  UNION ALL SELECT 'required_destination', null_destination, n, 'FAIL', 'destination must not be null' FROM r
  UNION ALL SELECT 'required_base_fare', null_base_fare, n, 'FAIL', 'base_fare must not be null' FROM r
  UNION ALL SELECT 'total_equals_base_plus_tax', bad_total, n, 'FAIL', 'total_fare = base_fare + tax_and_surcharge after cleaning' FROM v
  UNION ALL SELECT 'no_negative_fares_after_cleaning', neg, n, 'FAIL', 'base_fare >= 0 after cleaning' FROM v
  UNION ALL SELECT 'flagged_rows', flagged, n, 'WARN', 'rows kept but flagged for review' FROM v)
SELECT check_name, CASE WHEN failed = 0 THEN 'PASS' ELSE bad END AS check_result,
       checked AS records_checked, failed AS records_failed, details FROM c"""
SQL["run_log"] = BASE + """
, r AS (SELECT pipeline_run_id, COUNT(*) AS n FROM raw GROUP BY 1),
v AS (SELECT pipeline_run_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE validation_status = 'flagged') AS f
      FROM validated GROUP BY 1)
SELECT coalesce(r.pipeline_run_id, v.pipeline_run_id) AS run_id,
       coalesce(r.n, 0) AS rows_ingested, coalesce(v.n, 0) AS rows_validated,
       CAST(coalesce(v.f, 0) + greatest(coalesce(r.n, 0) - coalesce(v.n, 0), 0) AS BIGINT) AS rows_rejected,
       CASE WHEN coalesce(r.n, 0) = coalesce(v.n, 0) AND coalesce(r.n, 0) > 0 THEN 'success' ELSE 'failed' END AS status
FROM r FULL JOIN v ON r.pipeline_run_id = v.pipeline_run_id"""
_CITIES = "'Dhaka', 'Chittagong', 'Sylhet', 'Cox''s Bazar', 'Jessore', 'Barisal', 'Rajshahi', 'Comilla', 'Saidpur', 'Jashore'"
SQL["invalid_city_rows"] = BASE + f"""
SELECT raw_id, source, destination,
       coalesce(source IN ({_CITIES}), false) AS source_valid,
       coalesce(destination IN ({_CITIES}), false) AS destination_valid
FROM validated
WHERE NOT coalesce(source IN ({_CITIES}), false) OR NOT coalesce(destination IN ({_CITIES}), false)"""
SQL["rejected_rows"] = BASE + """
SELECT * FROM raw r WHERE NOT EXISTS (
  SELECT 1 FROM validated v WHERE v.pipeline_run_id = r.pipeline_run_id AND v.raw_id = r.id
    AND v.validation_status <> 'flagged')"""
SQL["clean_dedup"] = BASE + """
SELECT DISTINCT airline, source, destination, departure_time, arrival_time, duration, stops,
  aircraft_type, booking_class, booking_source, days_before_departure, seasonality, base_fare,
  tax_and_surcharge, total_fare, pipeline_run_id FROM raw"""

# --- SQL marts --------------------------------------------------------------
STG = """, stg AS (SELECT airline, source, destination, departure_time, arrival_time, duration, stops,
  base_fare, tax_and_surcharge, total_fare, booking_class, pipeline_run_id FROM validated)
"""
SQL["stg_bookings"] = BASE + STG + "SELECT * FROM stg"
SQL["kpi_popular_routes"] = BASE + STG + f"""
SELECT source, destination, COUNT(*) AS bookings, {avg('total_fare')} AS avg_fare
FROM stg GROUP BY source, destination ORDER BY bookings DESC"""
SQL["kpi_seasonal_variation"] = BASE + STG + f"""
SELECT airline, CASE WHEN month(departure_time) IN (4, 6, 12) THEN 'Peak' ELSE 'Off-Peak' END AS season,
       {avg('total_fare')} AS avg_fare
FROM stg GROUP BY airline, season"""
SQL["report_top_routes"] = BASE + STG + f"""
, m AS (SELECT source, destination, COUNT(*) AS bookings, {avg('total_fare')} AS avg_fare
        FROM stg GROUP BY source, destination)
SELECT source, destination, bookings, round(avg_fare, 2) AS avg_fare FROM m
ORDER BY bookings DESC, source, destination LIMIT 10"""
SQL["report_avg_fare"] = BASE + STG + f"""
, m AS (SELECT airline, {avg('total_fare')} AS avg_fare, COUNT(*) AS bookings FROM stg GROUP BY airline)
SELECT airline, round(avg_fare, 2) AS avg_fare, bookings FROM m ORDER BY avg_fare DESC, airline"""
SQL["report_seasonal"] = BASE + STG + f"""
, m AS (SELECT airline, CASE WHEN month(departure_time) IN (4, 6, 12) THEN 'Peak' ELSE 'Off-Peak' END AS season,
        {avg('total_fare')} AS avg_fare FROM stg GROUP BY airline, season)
SELECT airline, season, round(avg_fare, 2) AS avg_fare FROM m ORDER BY airline, season"""

# --- run-scoped KPIs ----------------------------------------------------------
SQL["kpi_avg_fare_by_airline"] = BASE + f"""
SELECT airline, {ravg('base_fare', 2)} AS avg_base_fare, {ravg('tax_and_surcharge', 2)} AS avg_tax,
       {ravg('total_fare', 2)} AS avg_total_fare, MIN(total_fare) AS min_fare,
       MAX(total_fare) AS max_fare, COUNT(total_fare) AS booking_count, {R}
FROM validated WHERE airline IS NOT NULL GROUP BY airline"""
SQL["kpi_seasonal_premium"] = BASE + f"""
, g AS (SELECT airline, season_label, is_peak_season, SUM(total_fare) AS s, COUNT(total_fare) AS n
        FROM validated WHERE airline IS NOT NULL AND season_label IS NOT NULL AND is_peak_season IS NOT NULL
        GROUP BY 1, 2, 3),
b AS (SELECT airline, CAST(SUM(s) AS DOUBLE) / NULLIF(SUM(n), 0) AS base FROM g WHERE is_peak_season = 0 GROUP BY airline),
a AS (SELECT g.*, CAST(s AS DOUBLE) / NULLIF(n, 0) AS m, b.base FROM g LEFT JOIN b ON g.airline = b.airline)
SELECT airline, season_label, is_peak_season AS is_peak, {rmean('s', 'n', 2)} AS avg_total_fare, n AS booking_count,
       round((m - base) / NULLIF(base, 0) * 100, 2) AS fare_premium_pct, {R}
FROM a"""
SQL["kpi_booking_count"] = BASE + f"""
, g AS (SELECT airline, COUNT(total_fare) AS total_bookings,
          COUNT(*) FILTER (WHERE is_peak_season = 1 AND total_fare IS NOT NULL) AS peak_bookings
        FROM validated GROUP BY airline),
t AS (SELECT COUNT(*) AS n FROM validated)
SELECT airline, total_bookings, peak_bookings, total_bookings - peak_bookings AS offpeak_bookings,
       round(CAST(total_bookings AS DOUBLE) / NULLIF(n, 0) * 100, 4) AS market_share_pct, {R}
FROM g, t WHERE airline IS NOT NULL"""
ROUTES = """
, r AS (SELECT source, destination, COUNT(total_fare) AS booking_count, SUM(total_fare) AS s,
          MIN(total_fare) AS min_fare, MAX(total_fare) AS max_fare
        FROM validated WHERE source IS NOT NULL AND destination IS NOT NULL GROUP BY 1, 2),
ra AS (SELECT source, destination, airline, COUNT(*) AS sz FROM validated
       WHERE source IS NOT NULL AND destination IS NOT NULL AND airline IS NOT NULL GROUP BY 1, 2, 3),
top AS (SELECT source, destination, airline AS top_airline FROM (
          SELECT *, row_number() OVER (PARTITION BY source, destination ORDER BY sz DESC, airline) AS rn FROM ra)
        WHERE rn = 1)
"""
SQL["kpi_popular_routes_topn"] = BASE + ROUTES + f"""
, ranked AS (SELECT r.*, t.top_airline,
               row_number() OVER (ORDER BY r.booking_count DESC, r.source, r.destination) AS rnk
             FROM r LEFT JOIN top t ON r.source = t.source AND r.destination = t.destination)
SELECT source, destination, booking_count, {rmean('s', 'booking_count', 2)} AS avg_total_fare,
       min_fare, max_fare, top_airline, rnk AS rank, source || ' → ' || destination AS route, {R}
FROM ranked WHERE rnk <= 20"""
SQL["dominant_airline"] = BASE + ROUTES + """
SELECT r.source, r.destination, t.top_airline FROM r LEFT JOIN top t
  ON r.source = t.source AND r.destination = t.destination"""
SQL["kpi_route_airline"] = BASE + f"""
, ra AS (SELECT source, destination, airline, COUNT(total_fare) AS n, SUM(total_fare) AS s FROM validated
         WHERE source IS NOT NULL AND destination IS NOT NULL AND airline IS NOT NULL GROUP BY 1, 2, 3)
SELECT source, destination, airline, n AS booking_count, {rmean('s', 'n', 2)} AS avg_total_fare,
       round(CAST(n AS DOUBLE) / NULLIF(SUM(n) OVER (PARTITION BY source, destination), 0) * 100, 4) AS route_share_pct,
       {R}
FROM ra"""
SQL["kpi_run_summary"] = BASE + f"""
, d AS (SELECT
    (SELECT COUNT(*) FROM (SELECT DISTINCT source, destination FROM validated
       WHERE source IS NOT NULL AND destination IS NOT NULL)) AS routes,
    (SELECT COUNT(*) FROM (SELECT DISTINCT airline, season_label, is_peak_season FROM validated
       WHERE airline IS NOT NULL AND season_label IS NOT NULL AND is_peak_season IS NOT NULL)) AS seasonal,
    (SELECT COUNT(*) FROM (SELECT DISTINCT source, destination, airline FROM validated
       WHERE source IS NOT NULL AND destination IS NOT NULL AND airline IS NOT NULL)) AS route_airline)
SELECT {R}, COUNT(*) AS total_rows, COUNT(DISTINCT airline) AS airlines, any_value(d.routes) AS routes,
       COUNT(*) FILTER (WHERE is_peak_season = 1) AS peak_rows,
       COUNT(DISTINCT airline) AS kpi_avg_fare_rows, any_value(d.seasonal) AS kpi_seasonal_rows,
       COUNT(DISTINCT airline) AS kpi_booking_count_rows,
       least(any_value(d.routes), 20) AS kpi_popular_routes_rows,
       any_value(d.route_airline) AS kpi_route_airline_rows
FROM validated, d"""
SQL["distinct_routes"] = BASE + "SELECT DISTINCT source, destination FROM validated"

# --- exploratory summaries ------------------------------------------------------
SQL["airline_avg_fare"] = BASE + f"""
SELECT airline, {ravg('total_fare', 2)} AS avg_fare FROM validated
WHERE airline IS NOT NULL GROUP BY airline"""
SQL["season_avg_fare"] = BASE + f"""
SELECT season_label AS season, {ravg('total_fare', 2)} AS avg_fare, COUNT(total_fare) AS bookings
FROM validated WHERE season_label IS NOT NULL GROUP BY season_label"""
SQL["top_route"] = BASE + """
SELECT source || ' → ' || destination AS route, COUNT(*) AS bookings FROM validated
WHERE source IS NOT NULL AND destination IS NOT NULL
GROUP BY 1 ORDER BY bookings DESC, route LIMIT 1"""
SQL["expensive_routes"] = BASE + f"""
SELECT source || ' → ' || destination AS route, {ravg('total_fare', 2)} AS avg_fare FROM validated
WHERE source IS NOT NULL AND destination IS NOT NULL
GROUP BY 1 ORDER BY avg_fare DESC, route LIMIT 5"""
SQL["airline_fare_spread"] = BASE + f"""
, m AS (SELECT airline, {ravg('total_fare', 0)} AS m FROM validated WHERE airline IS NOT NULL GROUP BY airline)
SELECT max(m) AS max_mean_fare, min(m) AS min_mean_fare, max(m) - min(m) AS spread,
       round((max(m) / NULLIF(min(m), 0) - 1) * 100, 1) AS spread_pct,
       (SELECT airline FROM m ORDER BY m DESC, airline DESC LIMIT 1) AS highest_airline,
       (SELECT airline FROM m ORDER BY m ASC, airline ASC LIMIT 1) AS lowest_airline
FROM m"""
SQL["season_premium"] = BASE + f"""
, g AS (SELECT season_label AS season, {avg('total_fare')} AS m, {ravg('total_fare', 2)} AS avg_fare
        FROM validated WHERE season_label IS NOT NULL GROUP BY season_label),
b AS (SELECT coalesce(max(CASE WHEN season = 'Regular' THEN m END), min(m)) AS base FROM g)
SELECT season, avg_fare, round((m / NULLIF(base, 0) - 1) * 100, 1) AS premium_pct FROM g, b"""

# --- profiling ----------------------------------------------------------------
VALIDATED_COLS = ["raw_id", "airline", "source", "destination", "departure_time", "arrival_time",
                  "duration", "duration_minutes", "stops", "aircraft_type", "booking_class",
                  "booking_source", "days_before_departure", "seasonality", "base_fare",
                  "tax_and_surcharge", "total_fare", "travel_date", "is_peak_season", "season_label",
                  "validation_status", "validation_notes", "pipeline_run_id"]
NUMERIC_COLS = ["duration", "duration_minutes", "stops", "days_before_departure", "base_fare",
                "tax_and_surcharge", "total_fare", "is_peak_season"]
TEXT_COLS = ["airline", "source", "destination", "aircraft_type", "booking_class", "booking_source",
             "seasonality", "season_label", "validation_status", "validation_notes", "pipeline_run_id"]


def _union(parts):
    return "\nUNION ALL\n".join(parts)


SQL["profile_nonnull"] = BASE + _union(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, COUNT(*) AS rows FROM validated"
    for c in VALIDATED_COLS)
SQL["missing_report"] = BASE + ", m AS (" + _union(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS missing_count, COUNT(*) AS n FROM validated"
    for c in VALIDATED_COLS) + """)
SELECT column_name, missing_count, round(CAST(missing_count AS DOUBLE) / n * 100, 2) AS missing_pct
FROM m WHERE missing_count > 0"""
LONG_NUM = ", long AS (" + _union(
    f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM validated WHERE {c} IS NOT NULL"
    for c in NUMERIC_COLS) + ")\n"
LONG_TXT = ", long AS (" + _union(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM validated WHERE {c} IS NOT NULL"
    for c in TEXT_COLS) + ")\n"
SQL["describe_numeric"] = BASE + LONG_NUM + """
SELECT column_name, COUNT(value) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
       min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
       round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max
FROM long GROUP BY column_name"""
SQL["describe_categorical"] = BASE + LONG_TXT + """
, c AS (SELECT column_name, value, COUNT(*) AS n FROM long GROUP BY 1, 2),
t AS (SELECT column_name, value AS top FROM (
        SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rn FROM c) WHERE rn = 1)
SELECT c.column_name, SUM(n)::BIGINT AS count, COUNT(*) AS unique, any_value(t.top) AS top, max(n) AS freq
FROM c JOIN t ON c.column_name = t.column_name GROUP BY c.column_name"""
SQL["value_counts"] = BASE + LONG_TXT + """
, c AS (SELECT column_name, value, COUNT(*) AS count FROM long GROUP BY 1, 2)
SELECT column_name, value, count FROM c
WHERE column_name IN (SELECT column_name FROM c GROUP BY column_name HAVING COUNT(*) <= 25)"""
SQL["fare_distribution"] = BASE + """
SELECT round(quantile_cont(CAST(total_fare AS DOUBLE), 0.25), 6) AS q1, round(quantile_cont(CAST(total_fare AS DOUBLE), 0.75), 6) AS q3,
       round(quantile_cont(CAST(total_fare AS DOUBLE), 0.75), 6) - round(quantile_cont(CAST(total_fare AS DOUBLE), 0.25), 6) AS iqr
FROM validated"""
SQL["iqr_outliers"] = BASE + LONG_NUM + """
, q AS (SELECT column_name, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.75), 6) AS q3 FROM long GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f.column_name, q1, q3, iqr, lower_fence, upper_fence,
       COUNT(*) FILTER (WHERE value < lower_fence OR value > upper_fence) AS outliers
FROM f JOIN long l ON f.column_name = l.column_name
GROUP BY f.column_name, q1, q3, iqr, lower_fence, upper_fence"""
SQL["corr_target"] = BASE + _union(
    f"SELECT '{c}' AS column_name, round(corr(CAST({c} AS DOUBLE), CAST(total_fare AS DOUBLE)), 4) AS corr FROM validated"
    for c in NUMERIC_COLS)
SQL["corr_matrix"] = BASE + _union(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 4) AS corr FROM validated"
    for i, a in enumerate(NUMERIC_COLS) for b in NUMERIC_COLS[:i])
SQL["fare_histogram"] = BASE + """
, x AS (SELECT 'linear' AS scale, CAST(total_fare AS DOUBLE) AS x FROM validated WHERE total_fare IS NOT NULL
        UNION ALL
        SELECT 'log10', log10(CAST(total_fare AS DOUBLE)) FROM validated WHERE total_fare > 0),
r AS (SELECT scale, min(x) AS lo, max(x) AS hi FROM x GROUP BY scale),
b AS (SELECT x.scale, lo, hi, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) * 60 / (hi - lo)), 59) END AS INTEGER) AS bin
      FROM x JOIN r ON x.scale = r.scale)
SELECT scale, bin, round(lo + bin * (hi - lo) / 60, 6) AS bin_start, round(lo + (bin + 1) * (hi - lo) / 60, 6) AS bin_end,
       COUNT(*) AS count
FROM b GROUP BY scale, bin, lo, hi"""
SQL["fare_skew"] = BASE + """
SELECT round(skewness(CAST(total_fare AS DOUBLE)), 4) AS skew, COUNT(total_fare) AS n FROM validated"""
SQL["fare_summary"] = BASE + f"""
SELECT COUNT(*) AS rows, {ravg('total_fare', 2)} AS mean_fare, round(stddev_samp(CAST(total_fare AS DOUBLE)), 2) AS std_fare,
       round(quantile_cont(CAST(total_fare AS DOUBLE), 0.5), 6) AS median_fare
FROM validated"""
SQL["airline_fare_stats"] = BASE + f"""
SELECT airline, {ravg('total_fare', 0)} AS mean_fare,
       round(round(quantile_cont(CAST(total_fare AS DOUBLE), 0.5), 6), 0) AS median_fare,
       round(stddev_samp(CAST(total_fare AS DOUBLE)), 0) AS std_fare
FROM validated WHERE airline IS NOT NULL GROUP BY airline"""
DIMS = """, d AS (SELECT 'season_label' AS dimension, season_label AS value, CAST(total_fare AS DOUBLE) AS x FROM validated
              WHERE season_label IS NOT NULL AND total_fare IS NOT NULL
       UNION ALL
       SELECT 'airline', airline, CAST(total_fare AS DOUBLE) FROM validated
              WHERE airline IS NOT NULL AND total_fare IS NOT NULL)
"""
SQL["median_fare_by_dim"] = BASE + DIMS + """
SELECT dimension, value, round(quantile_cont(x, 0.5), 6) AS median_fare FROM d GROUP BY dimension, value"""
SQL["box_stats"] = BASE + DIMS + """
, q AS (SELECT dimension, value, round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) AS median,
          round(quantile_cont(x, 0.75), 6) AS q3 FROM d GROUP BY 1, 2),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.dimension, f.value, q1, median, q3, iqr, COUNT(*) AS n, min(x) AS min, max(x) AS max,
       min(x) FILTER (WHERE x >= lo AND x <= hi) AS lower_whisker,
       max(x) FILTER (WHERE x >= lo AND x <= hi) AS upper_whisker,
       COUNT(*) FILTER (WHERE NOT (x >= lo AND x <= hi)) AS outliers
FROM f JOIN d ON f.dimension = d.dimension AND f.value = d.value
GROUP BY f.dimension, f.value, q1, median, q3, iqr"""

# --- features and model preparation -------------------------------------------
FEAT = """, feat AS (
  SELECT raw_id, airline, source, destination, booking_class AS class, booking_source,
    coalesce(seasonality, season_label) AS seasonality, TRY_CAST(duration AS DOUBLE) AS duration_hrs,
    days_before_departure, CAST(stops AS INTEGER) AS stopovers,
    CAST(hour(departure_time) AS INTEGER) AS departure_hour, CAST(day(departure_time) AS INTEGER) AS departure_day,
    CAST(month(departure_time) AS INTEGER) AS departure_month,
    CAST(isodow(departure_time) - 1 AS INTEGER) AS departure_weekday,
    CAST(hour(arrival_time) AS INTEGER) AS arrival_hour, total_fare,
    CASE WHEN TRY_CAST(duration AS DOUBLE) > 3.5 THEN 1 ELSE 0 END AS is_international,
    source || '_' || destination AS route,
    CASE WHEN isodow(departure_time) - 1 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN days_before_departure <= 7 THEN 1 ELSE 0 END AS last_minute_booking,
    CASE WHEN days_before_departure >= 30 THEN 1 ELSE 0 END AS early_booking,
    CAST(stops AS INTEGER) / (TRY_CAST(duration AS DOUBLE) + 1e-6) AS stopover_intensity,
    CAST(stops AS INTEGER) + CASE WHEN TRY_CAST(duration AS DOUBLE) > 3.5 THEN 1 ELSE 0 END
      + CASE WHEN TRY_CAST(duration AS DOUBLE) > 8 THEN 1 ELSE 0 END AS trip_complexity
  FROM validated),
fs AS (
  SELECT *, CASE WHEN raw_id % 10 >= 8 THEN 'test' ELSE 'train' END AS split,
    CASE WHEN raw_id % 10 >= 8 THEN NULL ELSE CAST((raw_id // 10) % 5 AS INTEGER) END AS fold,
    ln(1 + CAST(total_fare AS DOUBLE)) AS label
  FROM feat)
"""
SQL["engineer_features"] = BASE + FEAT + "SELECT * FROM feat"
SQL["intl_counts"] = BASE + FEAT + """
SELECT COUNT(*) FILTER (WHERE is_international = 0) AS domestic,
       COUNT(*) FILTER (WHERE is_international = 1) AS international FROM feat"""
SQL["parse_lenient"] = BASE + """
SELECT raw_id, TRY_CAST(CAST(departure_time AS VARCHAR) AS TIMESTAMP) AS departure_parsed,
       TRY_CAST(CAST(duration AS VARCHAR) AS DOUBLE) AS duration_parsed,
       TRY_CAST(aircraft_type AS DOUBLE) AS aircraft_type_numeric
FROM validated"""
SQL["derive_duration"] = BASE + """
SELECT raw_id, CAST(date_diff('second', departure_time, arrival_time) AS DOUBLE) / 3600.0 AS duration_hrs_derived
FROM validated"""
SQL["encode_stops"] = BASE + """
SELECT id AS raw_id, stops, CASE stops WHEN 'Direct' THEN 0 WHEN '1 Stop' THEN 1 WHEN '2 Stops' THEN 2 END AS stops_code
FROM raw"""
SQL["log_target"] = BASE + "SELECT raw_id, round(ln(1 + CAST(total_fare AS DOUBLE)), 8) AS label FROM validated"
SQL["impute_nulls"] = BASE + """
, med AS (SELECT round(quantile_cont(CAST(tax_and_surcharge AS DOUBLE), 0.5), 6) AS mt,
                 round(quantile_cont(CAST(total_fare AS DOUBLE), 0.5), 6) AS mf FROM raw)
SELECT id, coalesce(CAST(tax_and_surcharge AS DOUBLE), mt) AS tax_and_surcharge,
       coalesce(CAST(total_fare AS DOUBLE), mf) AS total_fare, coalesce(seasonality, 'Unknown') AS seasonality
FROM raw, med"""
SQL["label_encode"] = BASE + FEAT + ", lv AS (" + _union(
    f"SELECT DISTINCT '{c}' AS column_name, coalesce(CAST({c} AS VARCHAR), 'nan') AS value FROM feat"
    for c in ["airline", "source", "destination", "class", "booking_source", "seasonality"]) + """)
SELECT column_name, value, CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code
FROM lv"""
SQL["train_test_split"] = BASE + FEAT + "SELECT raw_id, split, fold FROM fs"
_NUMF = ["duration_hrs", "days_before_departure", "stopovers", "departure_hour", "departure_day",
         "departure_month", "departure_weekday", "arrival_hour", "is_international"]
SQL["standard_scale"] = BASE + FEAT + ", m AS (SELECT " + ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS {c}__mean, stddev_pop(CAST({c} AS DOUBLE)) AS {c}__std" for c in _NUMF
) + " FROM fs WHERE split = 'train')\nSELECT raw_id, " + ", ".join(
    f"round(CASE WHEN {c}__std = 0 THEN CAST({c} AS DOUBLE) - {c}__mean "
    f"ELSE (CAST({c} AS DOUBLE) - {c}__mean) / {c}__std END, 6) AS {c}" for c in _NUMF) + " FROM fs, m"
PRED = """, fit AS (SELECT regr_slope(label, duration_hrs) AS b, regr_intercept(label, duration_hrs) AS a
             FROM fs WHERE split = 'train'),
pred AS (SELECT label, a + b * CAST(duration_hrs AS DOUBLE) AS prediction FROM fs, fit WHERE split = 'test')
"""
SQL["regression_metrics"] = BASE + FEAT + PRED + """
SELECT round(1 - SUM((label - prediction) * (label - prediction)) / NULLIF(var_pop(label) * COUNT(label), 0), 4) AS r2,
       round(avg(abs((exp(label) - 1) - (exp(prediction) - 1))), 2) AS mae,
       round(sqrt(avg(((exp(label) - 1) - (exp(prediction) - 1)) * ((exp(label) - 1) - (exp(prediction) - 1)))), 2) AS rmse,
       COUNT(label) AS n
FROM pred"""
SQL["residual_summary"] = BASE + FEAT + PRED + """
SELECT round(avg(label - prediction), 4) AS mean_error, round(stddev_samp(label - prediction), 4) AS std_error,
       round(min(label - prediction), 4) AS min_error, round(max(label - prediction), 4) AS max_error
FROM pred"""
_AIRPORTS = ("CASE {c} WHEN 'BZL' THEN 'Barisal' WHEN 'CGP' THEN 'Chittagong' WHEN 'CXB' THEN 'Cox''s Bazar' "
             "WHEN 'DAC' THEN 'Dhaka' WHEN 'JSR' THEN 'Jessore' WHEN 'RJH' THEN 'Rajshahi' "
             "WHEN 'SPD' THEN 'Saidpur' WHEN 'ZYL' THEN 'Sylhet' END")
SQL["dim_lookup"] = BASE + f"""
SELECT raw_id, booking_class,
       CASE booking_class WHEN 'Economy' THEN 'lowest tier' WHEN 'Business' THEN 'mid tier'
            WHEN 'First Class' THEN 'premium tier' END AS class_tier,
       source, {_AIRPORTS.format(c='source')} AS source_city,
       destination, {_AIRPORTS.format(c='destination')} AS destination_city
FROM validated"""
SQL["season_multiplier"] = BASE + FEAT + """
, m AS (SELECT raw_id, seasonality, CASE seasonality WHEN 'Regular' THEN 1.0 WHEN 'Winter Holidays' THEN 1.17
          WHEN 'Eid' THEN 1.34 WHEN 'Hajj' THEN 1.43 END::DOUBLE AS multiplier FROM feat)
SELECT raw_id, seasonality, multiplier, round((multiplier - 1) * 100, 0) AS premium_pct FROM m"""

# --- linear models --------------------------------------------------------------
_CATS = ["airline", "source", "destination", "class", "booking_source", "seasonality"]
_NAMES = [*_CATS, *_NUMF]
_N = len(_NAMES)


def _linear(models: str) -> str:
    """Solutions (model, penalty, k: the fold left out or -1, mz, my, b) on
    standardised features: Gauss-Jordan for least squares and ridge, cyclic
    coordinate descent for lasso. ``models``: rows (model, l1, l2)."""
    values = ", ".join([*[f"CAST(dense_rank() OVER (ORDER BY coalesce(CAST({c} AS VARCHAR), 'nan')) - 1 AS DOUBLE)" for c in _CATS],
                        *[f"CAST({c} AS DOUBLE)" for c in _NUMF]])
    return BASE.replace("WITH bookings", "WITH RECURSIVE bookings", 1) + FEAT + f"""
, raw_x AS (SELECT raw_id, split, coalesce(fold, -1) AS fold, label AS y, [{values}] AS x FROM fs),
long_x AS (SELECT raw_id, split, fold, y, i, x[i] AS v FROM raw_x, (SELECT unnest(range(1, {_N + 1})) AS i)),
centre AS (SELECT i, avg(v) AS mean FROM long_x WHERE split = 'train' GROUP BY i),
scales AS (SELECT i, mean, stddev_pop(coalesce(v, mean)) AS std FROM long_x JOIN centre USING (i) WHERE split = 'train' GROUP BY i, mean),
z AS (SELECT raw_id, split, fold, any_value(y) AS y,
             list(CASE WHEN std > 1e-6 THEN (coalesce(v, mean) - mean) / std ELSE 0.0 END ORDER BY i) AS z
      FROM long_x JOIN scales USING (i) GROUP BY raw_id, split, fold),
pairs AS (SELECT unnest(range(1, {_N + 1})) AS i), 
sums AS (SELECT fold, a.i, b.i AS j, sum(z[a.i] * z[b.i]) AS s FROM z, pairs a, pairs b WHERE split = 'train' GROUP BY ALL),
ones AS (SELECT fold, i, sum(z[i]) AS sz, sum(z[i] * y) AS szy FROM z, pairs WHERE split = 'train' GROUP BY ALL),
ys AS (SELECT fold, count(*) AS n, sum(y) AS sy FROM z WHERE split = 'train' GROUP BY fold),
lefts AS (SELECT unnest(range(-1, 5)) AS k),
n_of AS (SELECT k, sum(n) AS n, sum(sy) / sum(n) AS my FROM lefts, ys WHERE fold <> k GROUP BY k),
z_of AS (SELECT k, i, sum(sz) AS sz, sum(szy) AS szy FROM lefts, ones WHERE fold <> k GROUP BY k, i),
cov AS (
  SELECT k, s.i, s.j, any_value(n) AS n, sum(s) - any_value(a.sz * b.sz / n) AS c
  FROM lefts JOIN n_of USING (k) JOIN sums s ON s.fold <> k JOIN z_of a USING (k, i) JOIN z_of b ON b.k = lefts.k AND b.i = s.j
  GROUP BY k, s.i, s.j),
rhs AS (SELECT k, i, szy - sz * my AS r, sz / n AS mz FROM z_of JOIN n_of USING (k)),
models(model, l1, l2) AS (VALUES {models}),
lines AS (
  SELECT model, l1, l2, k, i, any_value(r) AS r,
         list(c + CASE WHEN cov.i = j THEN l2 + CASE WHEN std > 1e-6 THEN 0 ELSE 1 END ELSE 0 END ORDER BY j) AS c
  FROM models, cov JOIN rhs USING (k, i) JOIN scales USING (i) GROUP BY model, l1, l2, k, i),
start AS (SELECT model, l1, l2, k, list(list_append(c, r) ORDER BY i) AS m FROM lines GROUP BY model, l1, l2, k),
gauss AS (
  SELECT model, l1, l2, k, 1 AS p, m FROM start WHERE l1 = 0
  UNION ALL
  SELECT model, l1, l2, k, p + 1,
         list_transform(m, lambda r, i: CASE WHEN i = p THEN lead_row ELSE list_transform(r, lambda v, j: v - r[p] * lead_row[j]) END)
  FROM (SELECT *, list_transform(m[p], lambda v: v / m[p][p]) AS lead_row FROM gauss WHERE p <= {_N})),
descent AS (
  SELECT model, l1, l2, k, 0 AS t, list_transform(m, lambda r: list_transform(r, lambda v: v / n)) AS m, list_transform(m, lambda r: 0.0::DOUBLE) AS b
  FROM start JOIN n_of USING (k) WHERE l1 > 0
  UNION ALL
  SELECT model, l1, l2, k, t + 1, m,
         list_transform(b, lambda v, j: CASE WHEN j <> i OR m[i][i] < 1e-12 THEN v ELSE sign(rest) * greatest(abs(rest) - l1, 0) / m[i][i] END)
  FROM (SELECT *, t % {_N} + 1 AS i, m[t % {_N} + 1][{_N + 1}] - list_inner_product(m[t % {_N} + 1][1:{_N}], b)
                                      + m[t % {_N} + 1][t % {_N} + 1] * b[t % {_N} + 1] AS rest FROM descent WHERE t < {100 * _N})),
solved AS (
  SELECT model, l1, l2, k, list_transform(m, lambda r: r[{_N + 1}]) AS b FROM gauss WHERE p = {_N + 1}
  UNION ALL SELECT model, l1, l2, k, b FROM descent WHERE t = {100 * _N}),
fitted AS (
  SELECT s.*, my, mz FROM solved s JOIN n_of USING (k) JOIN (SELECT k, list(mz ORDER BY i) AS mz FROM rhs GROUP BY k) USING (k)),
scored AS (
  SELECT model, l1, l2, k, fold, split, y, my + list_inner_product(b, z) - list_inner_product(b, mz) AS p FROM fitted, z
  WHERE (k = -1 AND split = 'test') OR (k >= 0 AND split = 'train')),
held AS (
  SELECT model, l1, l2, k, 1 - sum((y - p) * (y - p)) FILTER (fold = k) / NULLIF(var_pop(y) FILTER (fold = k) * count(y) FILTER (fold = k), 0) AS val,
         1 - sum((y - p) * (y - p)) FILTER (fold <> k) / NULLIF(var_pop(y) FILTER (fold <> k) * count(y) FILTER (fold <> k), 0) AS train
  FROM scored WHERE k >= 0 GROUP BY model, l1, l2, k)
"""


_PRESETS = "('Linear Regression', 0.0, 0.0), ('Ridge Regression', 0.0, 1.0), ('Lasso Regression', 0.001, 0.0)"
SQL["train_linear"] = _linear(_PRESETS) + """
SELECT model, round(1 - sum((y - p) * (y - p)) / NULLIF(var_pop(y) * count(y), 0), 4) AS r2,
       round(avg(abs(exp(y) - exp(p))), 2) AS mae, round(sqrt(avg((exp(y) - exp(p)) * (exp(y) - exp(p)))), 2) AS rmse,
       any_value(cv_r2) AS cv_r2, any_value(cv_std) AS cv_std
FROM scored JOIN (SELECT model, round(avg(val), 4) AS cv_r2, round(stddev_pop(val), 4) AS cv_std FROM held GROUP BY model) USING (model)
WHERE k = -1 GROUP BY model"""
SQL["linear_cv"] = _linear(_PRESETS) + "SELECT model, CAST(k AS INTEGER) AS fold, round(val, 6) AS r2 FROM held"
SQL["coef_table"] = _linear(_PRESETS) + f"""
, w AS (SELECT model, unnest({_NAMES!r}) AS feature, unnest(b) AS w FROM solved WHERE k = -1)
SELECT feature, round(max(w) FILTER (model = 'Linear Regression'), 8) + 0.0 AS linear, round(max(w) FILTER (model = 'Ridge Regression'), 8) + 0.0 AS ridge,
       round(max(w) FILTER (model = 'Lasso Regression'), 8) + 0.0 AS lasso, max(w) FILTER (model = 'Lasso Regression') = 0 AS lasso_zeroed
FROM w GROUP BY feature"""
_ALPHAS = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0]
SQL["penalty_curve"] = _linear(", ".join([f"('Ridge Regression', 0.0, {a})" for a in _ALPHAS] + [f"('Lasso Regression', {a}, 0.0)" for a in _ALPHAS])) + """
SELECT model, 'alpha' AS param, CAST(l1 + l2 AS DOUBLE) AS value, round(avg(train), 4) + 0.0 AS train_r2, round(avg(val), 4) + 0.0 AS val_r2, round(stddev_pop(val), 4) AS val_std
FROM held GROUP BY model, l1, l2"""
SQL["prepare"] = BASE + FEAT + "SELECT * REPLACE (round(label, 8) AS label) FROM fs"
_MISSING = [*[f"CASE WHEN {c} IS NULL THEN 'missing field: {c}' END" for c in _NAMES],
            *[f"CASE WHEN {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM fs WHERE split = 'train' AND {c} IS NOT NULL) THEN 'unknown {c}' END" for c in _CATS]]
SQL["batch_rejects"] = BASE + FEAT + f"""
, r AS (SELECT raw_id, concat_ws('; ', {", ".join(_MISSING)}) AS reject_reason FROM fs)
SELECT raw_id, reject_reason FROM r WHERE reject_reason <> ''"""
