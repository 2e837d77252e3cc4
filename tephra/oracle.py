"""DuckDB SQL for every registered query, written from the query definitions.

The driver runs each query on Spark and the SQL here on DuckDB over the same Parquet
tables. The feeds are rebuilt as CTEs from ``events`` by the fixture's definition
(``tephra.sources.testdata``). The dashboards' labels are one table of lower bounds: a
measure has the label of the largest bound it reaches. Where a query rounds, the SQL
rounds on decimals as well, because engines differ on half ties of doubles.
"""

from __future__ import annotations

from tephra.sources import testdata as fx

# Replay clock of the dashboards: the instant just after the fixture's last day.
AS_OF = "2024-01-31 00:00:00"
# High-water-mark scenario: the target was first loaded with data up to here.
FIRST_LOAD_UNTIL = "2024-01-15 12:00:00"
# Partial aggregates scenario: the dates before this one are compacted after the last load.
COMPACT_BEFORE = "2024-01-03"
# Retention scenario: run at 02:00 on 2024-01-20, keep 7 days plus 1 day buffer.
RETENTION_AS_OF = "2024-01-20 02:00:00"
RETENTION_DAYS = 7
RETENTION_BUFFER_DAYS = 1


def rnd(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,8)), {n}) AS DOUBLE)"


# ---- labels -------------------------------------------------------------------------------

# Fixed values: (scale, lower bound, bound included, label), as the dashboards name them.
# A bound of NULL is the lowest level; ``unknown`` marks the label of a missing measure.
LEVELS = """
levels(scale, bound, included, label, unknown) AS (VALUES
  ('fire intensity',      NULL::DOUBLE, true,  'low',                  true),
  ('fire intensity',      350,          true,  'moderate',             false),
  ('fire intensity',      400,          true,  'severe',               false),
  ('cluster severity',    NULL,         true,  'moderate',             true),
  ('cluster severity',    400,          true,  'severe',               false),
  ('quake severity',      NULL,         true,  'moderate',             true),
  ('quake severity',      6,            true,  'severe',               false),
  ('fire category',       NULL,         true,  'Low Fire',             true),
  ('fire category',       320,          false, 'Moderate Fire',        false),
  ('fire category',       350,          false, 'Severe Fire',          false),
  ('fire category',       400,          false, 'Extreme Fire',         false),
  ('earthquake category', NULL,         true,  'Minor Earthquake',     true),
  ('earthquake category', 2.5,          true,  'Light Earthquake',     false),
  ('earthquake category', 4,            true,  'Moderate Earthquake',  false),
  ('earthquake category', 5.5,          true,  'Strong Earthquake',    false),
  ('earthquake category', 7,            true,  'Major Earthquake',     false),
  ('fire colour',         NULL,         true,  '#FFA500',              true),
  ('fire colour',         320,          false, '#FF6600',              false),
  ('fire colour',         350,          false, '#FF0000',              false),
  ('fire colour',         400,          false, '#8B0000',              false),
  ('earthquake colour',   NULL,         true,  '#ADD8E6',              true),
  ('earthquake colour',   3,            true,  '#87CEEB',              false),
  ('earthquake colour',   4,            true,  '#1E90FF',              false),
  ('earthquake colour',   5,            true,  '#0000FF',              false),
  ('earthquake colour',   6,            true,  '#4B0082',              false),
  ('fire power',          NULL,         true,  'Low',                  true),
  ('fire power',          50,           false, 'Moderate',             false),
  ('fire power',          200,          false, 'Severe',               false),
  ('fire power',          500,          false, 'Extreme',              false),
  ('activity',            NULL,         true,  'Minor Activity',       true),
  ('activity',            3,            true,  'Light Activity',       false),
  ('activity',            4.5,          true,  'Moderate Activity',    false),
  ('activity',            6,            true,  'Significant Activity', false),
  ('depth',               NULL,         true,  'Shallow',              false),
  ('depth',               70,           false, 'Intermediate',         false),
  ('depth',               300,          false, 'Deep',                 true)
)"""

# Names of the detection confidences.
CONFIDENCES = """
confidences(confidence, confidence_level) AS (VALUES ('h', 'High'), ('n', 'Nominal'), ('l', 'Low'))"""


def label(scale: str, measure: str) -> str:
    """Label of a measure: the highest level it reaches, or the one for missing values."""
    reached = f"({measure} > bound OR included AND {measure} = bound OR bound IS NULL AND {measure} IS NOT NULL)"
    return (
        f"(SELECT coalesce(arg_max(label, coalesce(bound, -1e300)) FILTER (WHERE {reached}), max(label) FILTER (WHERE unknown))"
        f" FROM levels WHERE scale = {scale})"
    )


# ---- the feeds ----------------------------------------------------------------------------


def _is(rule: tuple[int, int]) -> str:
    return f"event_id % {rule[0]} = {rule[1]}"


FX_FIRES = f"""
fx_fires AS (
  SELECT event_id AS src_id,
    CASE WHEN NOT ({_is(fx.NO_LATITUDE)}) THEN CAST((event_id*7919)%201 - 100 AS DOUBLE)/100 END AS latitude,
    CAST((event_id*104729)%201 - 100 AS DOUBLE)/100 AS longitude,
    CAST(2900 + (event_id*31)%1500 + [0, -400, 700][1 + user_id%3] AS DOUBLE)/10 AS bright_ti4,
    ['N', 'N20', 'N21'][1 + user_id%3] AS satellite,
    ['h', 'n', 'l', 'x'][1 + event_id%4] AS confidence,
    value*2 AS frp,
    date_trunc('minute', CAST(ts AS TIMESTAMP)) AS event_time
  FROM events WHERE event_type IN {fx.FIRE_TYPES}
)"""

FX_QUAKES = f"""
fx_quakes AS (
  SELECT event_id AS src_id, NOT ({_is(fx.NO_COORDINATES)}) AS placed,
    CASE WHEN placed THEN CAST((event_id*7919)%18001 - 9000 AS DOUBLE)/100 END AS latitude,
    CASE WHEN placed THEN CAST((event_id*104729)%36001 - 18000 AS DOUBLE)/100 END AS longitude,
    CASE WHEN placed AND NOT ({_is(fx.NO_DEPTH)}) THEN CAST((event_id*13)%6500 AS DOUBLE)/10 END AS depth,
    CASE WHEN NOT ({_is(fx.BAD_MAGNITUDE)}) THEN CAST(event_id%90 AS DOUBLE)/10 END AS magnitude,
    date_trunc('second', CAST(ts AS TIMESTAMP)) AS event_time,
    CASE WHEN {_is(fx.ZERO_TIME)} THEN 0
         WHEN {_is(fx.NO_TIME)} THEN NULL
         WHEN {_is(fx.NEGATIVE_TIME)} THEN {fx.NEGATIVE_MILLIS}
         WHEN {_is(fx.HUGE_TIME)} THEN {fx.HUGE_MILLIS}
         ELSE epoch_ms(event_time) + {fx.QUAKE_TIME_EXTRA_MILLIS} END AS time
  FROM events WHERE event_type IN {fx.QUAKE_TYPES}
)"""


def fires_cte(rounding: str = "trunc") -> str:
    cell = ", ".join(f"CAST(CAST({rounding}({x}/0.22) AS INTEGER) AS VARCHAR)" for x in ("latitude", "longitude"))
    return FX_FIRES + f""",
fires AS (
  SELECT latitude, longitude, bright_ti4,
    CAST({fx.FIRE_SCAN} AS DOUBLE) AS scan, CAST({fx.FIRE_TRACK} AS DOUBLE) AS track,
    CAST(event_time AS DATE) AS acq_date,
    CAST(hour(event_time)*100 + minute(event_time) AS VARCHAR) AS acq_time,
    satellite, '{fx.FIRE_INSTRUMENT}' AS instrument, confidence, '{fx.FIRE_VERSION}' AS version,
    CAST({fx.FIRE_BRIGHT_TI5} AS DOUBLE) AS bright_ti5, frp, '{fx.FIRE_DAYNIGHT}' AS daynight,
    event_time AS event_timestamp, 'fire' AS event_type,
    concat_ws('_', satellite, CAST(acq_date AS VARCHAR), lpad(acq_time, 4, '0'),
              CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR)) AS event_id,
    concat_ws('_', {cell}, CAST(acq_date AS VARCHAR)) AS cluster_id
  FROM fx_fires
)"""


QUAKES_CTE = FX_QUAKES + """,
quakes AS (
  SELECT magnitude, 'p' || CAST(src_id AS VARCHAR) AS place, time, longitude, latitude, depth,
    CAST(src_id AS VARCHAR) AS event_id, 'earthquake' AS event_type,
    event_time AS event_timestamp, CAST(event_time AS DATE) AS event_date
  FROM fx_quakes
  WHERE time > 0 AND time < 253402300800000
)"""

STAGING_CTE = fires_cte() + "," + QUAKES_CTE + """,
stg_fires AS (
  SELECT latitude, longitude, bright_ti4, event_timestamp AS event_time, satellite,
    confidence, frp AS fire_radioactive_power, daynight, event_type, cluster_id
  FROM fires WHERE latitude IS NOT NULL AND longitude IS NOT NULL
),
stg_quakes AS (
  SELECT magnitude, place, event_timestamp AS event_time, longitude, latitude, depth,
    event_type, CAST(NULL AS VARCHAR) AS cluster_id
  FROM quakes WHERE latitude IS NOT NULL AND longitude IS NOT NULL
)"""


# ---- marts --------------------------------------------------------------------------------


def fire_summary_sql(src: str = "stg_fires") -> str:
    return f"""
  SELECT event_date, satellite, confidence, fire_count, {rnd('brightness', 2)} AS avg_brightness, max_brightness,
    {rnd('power', 2)} AS avg_frp, max_frp, {label("'fire intensity'", 'brightness')} AS fire_intensity_category
  FROM (
    SELECT event_time::DATE AS event_date, satellite, confidence, count(*)::BIGINT AS fire_count,
      avg(bright_ti4) AS brightness, max(bright_ti4) AS max_brightness,
      avg(fire_radioactive_power) AS power, max(fire_radioactive_power) AS max_frp
    FROM {src} GROUP BY ALL
  )"""


QUAKE_SUMMARY = f"""
  SELECT event_date, hour, earthquake_count, {rnd('m', 2)} AS avg_magnitude, max_magnitude, min_magnitude,
    {rnd('d', 2)} AS avg_depth, max_depth
  FROM (
    SELECT event_time::DATE AS event_date, hour(event_time)::INTEGER AS hour, count(*)::BIGINT AS earthquake_count,
      avg(magnitude) AS m, max(magnitude) AS max_magnitude, min(magnitude) AS min_magnitude,
      avg(depth) AS d, max(depth) AS max_depth
    FROM stg_quakes GROUP BY ALL
  )"""

MARTS_CTE = LEVELS + "," + STAGING_CTE

COMBINED_CTE = MARTS_CTE + f""",
cells AS (
  SELECT cluster_id, event_time::DATE AS event_date, avg(latitude) AS latitude, avg(longitude) AS longitude,
    avg(bright_ti4) AS intensity_measure, max(event_time) AS event_time
  FROM stg_fires GROUP BY ALL
),
fire_clusters AS (
  SELECT latitude, longitude, 'fire' AS event_type, intensity_measure, event_time, event_date,
    {label("'cluster severity'", 'intensity_measure')} AS severity_level
  FROM cells
),
combined_events AS (
  SELECT latitude, longitude, event_type, intensity_measure, event_time, event_date, severity_level FROM fire_clusters
  UNION
  SELECT latitude, longitude, event_type, magnitude, event_time, event_time::DATE, {label("'quake severity'", 'magnitude')}
  FROM stg_quakes
)"""


def _combined(src: str) -> str:
    """The rows as the queries show them: averages to six digits."""
    return f"""
  SELECT {rnd('latitude', 6)} AS latitude, {rnd('longitude', 6)} AS longitude, event_type,
    {rnd('intensity_measure', 6)} AS intensity_measure, event_time, event_date, severity_level
  FROM {src}"""


# ---- dashboards ---------------------------------------------------------------------------


def _short(x: str) -> str:
    """A coordinate to six digits, without closing zeros."""
    return f"regexp_replace(CAST(CAST({rnd(x, 6)} AS DECIMAL(28,6)) AS VARCHAR), '\\.?0+$', '')"


MAP_EVENTS = f"""
  SELECT event_type, {rnd('x', 6)} AS intensity_measure, event_time, event_date, severity_level,
    {rnd('latitude', 6)} AS latitude, {rnd('longitude', 6)} AS longitude,
    {_short('latitude')} || ',' || {_short('longitude')} AS latlong,
    {label("event_type || ' category'", 'x')} AS intensity_category,
    {label("event_type || ' colour'", 'x')} AS map_color,
    {rnd('bubble', 4)} AS bubble_size,
    printf(wording, CAST({rnd('x', 1)} AS VARCHAR)) || strftime(event_time, ' | Time: %Y-%m-%d %H:%M UTC') AS tooltip_text
  FROM (SELECT *, intensity_measure AS x FROM combined_events) AS c
  JOIN (
    -- one row per event type: its bubble rule's parameters and its wording (fixed values)
    VALUES ('fire', true, 'Fire Intensity: %s K'), ('earthquake', false, 'Magnitude: %s')
  ) AS kinds(event_type, linear, wording) USING (event_type),
  LATERAL (SELECT CASE WHEN x IS NULL THEN NULL WHEN linear THEN least(greatest((x - 300) / 2, 1), 100) ELSE 2 ^ x END AS bubble)"""

FIRE_METRICS = f"""
  SELECT event_date, satellite, confidence, fire_count,
    {rnd('avg_brightness', 1)} AS avg_brightness, {rnd('max_brightness', 1)} AS max_brightness,
    {rnd('avg_frp', 1)} AS avg_fire_power, {rnd('max_frp', 1)} AS max_fire_power,
    coalesce(confidence_level, 'Unknown') AS confidence_level,
    {label("'fire power'", 'max_frp')} AS severity_level,
    (isodow(event_date) % 7 + 1)::INTEGER AS day_of_week,
    left(event_date::VARCHAR, 7) AS year_month
  FROM fire_summary LEFT JOIN confidences USING (confidence)"""

QUAKE_METRICS = f"""
  SELECT event_date, hour, earthquake_count,
    {rnd('avg_magnitude', 2)} AS avg_magnitude, {rnd('max_magnitude', 2)} AS max_magnitude,
    {rnd('min_magnitude', 2)} AS min_magnitude,
    {rnd('avg_depth', 1)} AS avg_depth_km, {rnd('max_depth', 1)} AS max_depth_km,
    {label("'activity'", 'max_magnitude')} AS activity_level,
    {label("'depth'", 'avg_depth')} AS depth_category
  FROM quake_summary"""

# One pass over the last seven days; the last day is a flag.
REALTIME = f"""
  SELECT fires_24h, earthquakes_24h, severe_fires_24h, significant_earthquakes_24h, fires_7d, earthquakes_7d,
    {rnd('hottest', 6)} AS max_fire_intensity_24h, strongest AS max_earthquake_magnitude_24h,
    [lvl FOR lvl IN [
        if(strongest >= 6, 'CRITICAL', NULL), if(hottest > 400, 'HIGH', NULL), if(busy > 100, 'ELEVATED', NULL), 'NORMAL'
     ] IF lvl IS NOT NULL][1] AS alert_status,
    TIMESTAMP '{AS_OF}' AS last_updated
  FROM (
    SELECT count(*) FILTER (fire AND today) AS fires_24h,
      count(*) FILTER (quake AND today) AS earthquakes_24h,
      count(*) FILTER (fire AND today AND x > 350) AS severe_fires_24h,
      count(*) FILTER (quake AND today AND x >= 5) AS significant_earthquakes_24h,
      count(*) FILTER (fire) AS fires_7d,
      count(*) FILTER (quake) AS earthquakes_7d,
      max(x) FILTER (fire AND today) AS hottest,
      max(x) FILTER (quake AND today) AS strongest,
      count(*) FILTER (today) AS busy
    FROM (
      SELECT intensity_measure AS x, event_type = 'fire' AS fire, event_type = 'earthquake' AS quake,
        event_time >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY AS today
      FROM combined_events WHERE event_time >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
    )
  )"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


FIRE_COLUMNS_SQL = (
    "latitude, longitude, bright_ti4, scan, track, acq_date, acq_time, satellite, "
    "instrument, confidence, version, bright_ti5, frp, daynight, event_timestamp, "
    "event_type, event_id, cluster_id"
)
QUAKE_COLUMNS_SQL = (
    "magnitude, place, time, longitude, latitude, depth, event_id, event_type, "
    "event_timestamp, event_date"
)
# What an event id determines: equal in all rows with that id.
FIRE_ID_COLUMNS_SQL = (
    "latitude, longitude, acq_date, acq_time, satellite, event_timestamp, event_type, event_id, cluster_id"
)


def _cells(rounding: str) -> str:
    return _with(fires_cte(rounding), "SELECT cluster_id, count(*)::BIGINT AS n_fires FROM fires GROUP BY cluster_id")


def core_queries() -> dict[str, str]:
    first_by_id = f"SELECT {FIRE_COLUMNS_SQL} FROM fires QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY " + ", ".join(
        f"{c.strip()} NULLS FIRST" for c in FIRE_COLUMNS_SQL.split(",") if c.strip() != "event_id"
    ) + ") = 1"
    quakes = f"SELECT {QUAKE_COLUMNS_SQL} FROM quakes"
    summary = MARTS_CTE + f",\nfire_summary AS ({fire_summary_sql()}),\nquake_summary AS ({QUAKE_SUMMARY})"
    return {
        "fires_parse": _with(fires_cte(), f"SELECT {FIRE_COLUMNS_SQL} FROM fires"),
        "fires_ids": _with(fires_cte(), "SELECT event_id, cluster_id, satellite, acq_date, acq_time FROM fires"),
        "fires_dedup": _with(fires_cte(), first_by_id),
        "fires_grid_trunc": _cells("trunc"),
        "fires_grid_floor": _cells("floor"),
        "quakes_parse": _with(QUAKES_CTE, quakes),
        "quakes_valid": _with(QUAKES_CTE, quakes),
        "quakes_dedup": _with(QUAKES_CTE, quakes + " QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY time) = 1"),
        "stg_fires": _with(STAGING_CTE, "SELECT * FROM stg_fires"),
        "stg_quakes": _with(STAGING_CTE, "SELECT * FROM stg_quakes"),
        "fire_summary": _with(MARTS_CTE, fire_summary_sql()),
        "quake_summary": _with(STAGING_CTE, QUAKE_SUMMARY),
        "fire_clusters": _with(COMBINED_CTE, _combined("fire_clusters")),
        "combined_events": _with(COMBINED_CTE, _combined("combined_events")),
        "map_events": _with(COMBINED_CTE, MAP_EVENTS),
        "fire_metrics": _with(summary + "," + CONFIDENCES, FIRE_METRICS),
        "quake_metrics": _with(summary, QUAKE_METRICS),
        "realtime_summary": _with(COMBINED_CTE, REALTIME),
    }


# ---- sinks and streams --------------------------------------------------------------------

# Wave 1 has the first copy of most documents; wave 2 the second copy of all, and the first
# copy of those that come late.
BATCHES = f"""
  SELECT 'fires' AS stream, run::INTEGER AS run, messages::BIGINT AS input_rows,
    (count(DISTINCT event_id) FILTER (held = (run = 1)))::BIGINT AS output_rows,
    CASE run WHEN 0 THEN 0 ELSE
      (count(*) FILTER (event_time < latest - INTERVAL 1 HOUR)
       + count(*) FILTER (held AND event_time < latest - INTERVAL 1 HOUR))::BIGINT END AS late_rows
  FROM (
    SELECT *, max(event_time) FILTER (NOT held) OVER () AS latest
    FROM (SELECT event_id, event_timestamp AS event_time, floor(src_id / {fx.ROWS_PER_DOC}) AS chunk,
                 chunk % {fx.LATE_DOCS[0]} = {fx.LATE_DOCS[1]} AS held
          FROM (SELECT f.*, x.src_id FROM fires f POSITIONAL JOIN fx_fires x))
  ),
  (
    SELECT run, CASE run WHEN 0 THEN count(*) FILTER (NOT held) ELSE count(*) + count(*) FILTER (held) END AS messages
    FROM (SELECT DISTINCT date_trunc('hour', event_time) AS h, floor(src_id / {fx.ROWS_PER_DOC}) AS chunk,
                 chunk % {fx.LATE_DOCS[0]} = {fx.LATE_DOCS[1]} AS held FROM fx_fires),
         (VALUES (0), (1)) AS runs(run)
    GROUP BY run
  )
  GROUP BY run, messages"""


def stream_sql() -> dict[str, str]:
    quakes = _with(QUAKES_CTE, f"SELECT {QUAKE_COLUMNS_SQL} FROM quakes")
    fires = _with(fires_cte(), f"SELECT {FIRE_COLUMNS_SQL} FROM fires")
    distinct_fires = _with(fires_cte(), f"SELECT DISTINCT {FIRE_ID_COLUMNS_SQL} FROM fires")
    return {
        "sink_fires_roundtrip": fires,
        "sink_quakes_roundtrip": quakes,
        "stream_fires_e2e": distinct_fires,
        "stream_quakes_e2e": quakes,
        "stream_dedup_fires": distinct_fires,
        "stream_dedup_quakes": quakes,
        "stream_both": _with(
            fires_cte() + "," + QUAKES_CTE,
            """
  SELECT 'fires' AS table_name, acq_date AS event_date, count(DISTINCT event_id)::BIGINT AS n_rows
  FROM fires GROUP BY acq_date
  UNION ALL
  SELECT 'earthquakes', event_date, count(DISTINCT event_id) FROM quakes GROUP BY event_date""",
        ),
        "batch_metrics": _with(fires_cte(), BATCHES),
        "batch_preview": _with(fires_cte(), f"SELECT {FIRE_COLUMNS_SQL} FROM fires ORDER BY event_id LIMIT 5"),
    }


# ---- exports, retention, quality ----------------------------------------------------------

_RENAMED = ("fx_fires", "fx_quakes", "fires", "quakes", "stg_fires", "stg_quakes")


def first_load(cte: str, prefix: str = "p_") -> str:
    """The same CTEs over the events before ``FIRST_LOAD_UNTIL``, names prefixed."""
    import re

    for name in _RENAMED:
        cte = re.sub(rf"\b{name}\b", prefix + name, cte)
    src = f"(SELECT * FROM events WHERE ts < TIMESTAMP '{FIRST_LOAD_UNTIL}') AS ev"
    return cte.replace("FROM events WHERE", f"FROM {src} WHERE")


def _summaries(prefix: str) -> str:
    fs = fire_summary_sql(f"{prefix}stg_fires")
    qs = QUAKE_SUMMARY.replace("FROM stg_quakes", f"FROM {prefix}stg_quakes")
    return f""",
{prefix}fire_summary AS ({fs}),
{prefix}quake_summary AS ({qs})"""


EXPORT_CTE = MARTS_CTE + "," + first_load(STAGING_CTE) + _summaries("") + _summaries("p_")


# Folders beside the dated ones: an empty old date, a bad date, a foreign key, no partition at all.
ODD_FOLDERS = ("acq_date=2023-12-01", "acq_date=bad", "other=2024-01-01", "notes")

# A dataset that the retention is told of and that does not exist.
MISSING_DATASET = "volcanoes"


def _retention_sql(what: str) -> str:
    cutoff = f"TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL {RETENTION_DAYS + RETENTION_BUFFER_DAYS} DAY"
    ctes = fires_cte() + "," + QUAKES_CTE + f""",
folders AS (
  SELECT 'fires' AS dataset, 'acq_date=' || acq_date AS partition, acq_date AS partition_date, count(*) AS n_rows
  FROM fires GROUP BY ALL
  UNION ALL
  SELECT 'earthquakes', 'event_date=' || event_date, event_date, count(*) FROM quakes GROUP BY ALL
  UNION ALL
  SELECT 'fires', name, TRY_CAST(split_part(name, '=', 2) AS DATE), NULL
  FROM (VALUES {", ".join(f"('{n}')" for n in ODD_FOLDERS)}) AS odd(name)
),
plan AS (
  SELECT dataset, partition, coalesce(partition_date::VARCHAR, '') AS partition_date,
    CASE WHEN NOT own THEN 'skip' WHEN partition_date IS NULL THEN 'error'
         ELSE ['keep', 'delete'][1 + (partition_date::TIMESTAMP < {cutoff})::INTEGER] END AS action,
    coalesce(n_rows, 0)::BIGINT AS n_rows
  FROM (SELECT *, split_part(partition, '=', 1) IN ('acq_date', 'event_date') AS own FROM folders)
),
report AS (
  SELECT dataset, count(*)::BIGINT AS partitions_scanned,
    (count(*) FILTER (action = 'delete'))::BIGINT AS partitions_deleted,
    ({cutoff})::DATE AS cutoff_date,
    (count(*) FILTER (action = 'error'))::BIGINT AS errors,
    coalesce(string_agg(partition, ',' ORDER BY partition) FILTER (action = 'delete'), '') AS deleted,
    (sum(n_rows) FILTER (action = 'keep'))::BIGINT AS rows_remaining
  FROM plan GROUP BY dataset
)"""
    body = {
        "plan": "SELECT * FROM plan",
        "dry_run": f"""
  SELECT dataset, partitions_scanned, partitions_deleted, errors,
    (SELECT sum(n_rows)::BIGINT FROM plan WHERE plan.dataset = report.dataset) AS rows_remaining,
    (SELECT count(*) FROM plan WHERE plan.dataset = report.dataset AND n_rows > 0) AS partitions_with_size
  FROM report
  UNION ALL
  SELECT '{MISSING_DATASET}', 0, 0, 1, 0, 0""",
        "report": "SELECT * FROM report",
        "status": """
  SELECT sum(partitions_scanned)::BIGINT AS partitions_scanned, sum(partitions_deleted)::BIGINT AS partitions_deleted,
    sum(errors)::BIGINT AS errors, (sum(errors) > 0)::INTEGER AS status FROM report""",
    }[what]
    return _with(ctes, body)


def _dq(table: str, checks: list[tuple[str, str, str]]) -> str:
    return "\n  UNION ALL\n".join(
        f"  SELECT '{table}' AS table_name, '{kind}' AS \"check\", '{cols}' AS columns, "
        f"CAST({expr} AS BIGINT) AS failures FROM {table}"
        for kind, cols, expr in checks
    )


DQ = "\n  UNION ALL\n".join(
    [
        _dq(
            "stg_fires",
            [
                ("not_null", "event_time", "COUNT(*) FILTER (WHERE event_time IS NULL)"),
                ("range", "latitude", "COUNT(*) FILTER (WHERE latitude < -90 OR latitude > 90)"),
                ("range", "longitude", "COUNT(*) FILTER (WHERE longitude < -180 OR longitude > 180)"),
                (
                    "accepted_values",
                    "confidence",
                    "COUNT(*) FILTER (WHERE confidence NOT IN ('l','n','h'))",
                ),
                (
                    "range",
                    "fire_radioactive_power",
                    "COUNT(*) FILTER (WHERE fire_radioactive_power < 0)",
                ),
            ],
        ),
        _dq(
            "stg_quakes",
            [
                ("not_null", "event_time", "COUNT(*) FILTER (WHERE event_time IS NULL)"),
                ("range", "latitude", "COUNT(*) FILTER (WHERE latitude < -90 OR latitude > 90)"),
                ("range", "longitude", "COUNT(*) FILTER (WHERE longitude < -180 OR longitude > 180)"),
                ("range", "magnitude", "COUNT(*) FILTER (WHERE magnitude < -2 OR magnitude > 10)"),
            ],
        ),
        _dq(
            "fire_summary",
            [
                ("not_null", "event_date", "COUNT(*) FILTER (WHERE event_date IS NULL)"),
                (
                    "unique",
                    "event_date,satellite,confidence",
                    "COUNT(*) FILTER (WHERE event_date IS NOT NULL AND satellite IS NOT NULL "
                    "AND confidence IS NOT NULL) - COUNT(DISTINCT (event_date, satellite, confidence))",
                ),
                (
                    "accepted_values",
                    "fire_intensity_category",
                    "COUNT(*) FILTER (WHERE fire_intensity_category NOT IN ('severe','moderate','low'))",
                ),
                ("range", "fire_count", "COUNT(*) FILTER (WHERE fire_count < 1)"),
            ],
        ),
        _dq(
            "quake_summary",
            [
                ("not_null", "event_date", "COUNT(*) FILTER (WHERE event_date IS NULL)"),
                (
                    "unique",
                    "event_date,hour",
                    "COUNT(*) FILTER (WHERE event_date IS NOT NULL AND hour IS NOT NULL) "
                    "- COUNT(DISTINCT (event_date, hour))",
                ),
                ("range", "hour", "COUNT(*) FILTER (WHERE hour < 0 OR hour > 23)"),
                ("range", "earthquake_count", "COUNT(*) FILTER (WHERE earthquake_count < 1)"),
            ],
        ),
        _dq(
            "combined_events",
            [
                ("not_null", "event_type", "COUNT(*) FILTER (WHERE event_type IS NULL)"),
                (
                    "accepted_values",
                    "event_type",
                    "COUNT(*) FILTER (WHERE event_type NOT IN ('fire','earthquake'))",
                ),
                (
                    "accepted_values",
                    "severity_level",
                    "COUNT(*) FILTER (WHERE severity_level NOT IN ('severe','moderate'))",
                ),
                ("range", "latitude", "COUNT(*) FILTER (WHERE latitude < -90 OR latitude > 90)"),
                ("range", "longitude", "COUNT(*) FILTER (WHERE longitude < -180 OR longitude > 180)"),
            ],
        ),
    ]
).replace("'quake_summary' AS table_name", "'earthquake_summary' AS table_name").replace(
    "'stg_quakes' AS table_name", "'stg_earthquakes' AS table_name"
)


REJECTS = f"""
  SELECT source, reason, count(*)::BIGINT AS n_records FROM (
    SELECT DISTINCT 'fires' AS source, 'malformed_csv' AS reason,
      date_trunc('hour', event_time) AS h, floor(src_id / {fx.ROWS_PER_DOC}) AS n FROM fx_fires
    UNION ALL
    SELECT 'fires', 'missing_coordinates', event_time, src_id FROM fx_fires WHERE latitude IS NULL
    UNION ALL
    SELECT * FROM (SELECT DISTINCT 'earthquakes', 'malformed_json',
      date_trunc('hour', event_time), floor(src_id / {fx.ROWS_PER_DOC}) FROM fx_quakes)
    UNION ALL
    SELECT 'earthquakes', problem, event_time, src_id FROM (
      SELECT *, coalesce(
        if(time IS NULL OR time <= 0, 'bad_time', NULL),
        if(time >= 253402300800000, 'time_out_of_range', NULL),
        if(latitude IS NULL, 'missing_coordinates', NULL),
        if(magnitude IS NULL, 'bad_field', NULL)) AS problem
      FROM fx_quakes)
    WHERE problem IS NOT NULL
  ) GROUP BY ALL"""


def maintenance_sql() -> dict[str, str]:
    combined = COMBINED_CTE
    incremental = """
  SELECT * FROM p_fire_summary
  UNION ALL
  SELECT * FROM fire_summary
  WHERE event_date > (SELECT MAX(event_date) FROM p_fire_summary)"""
    status = """
  SELECT 'fire_summary' AS table_name, 'append_hwm' AS mode, 'SUCCESS' AS status,
    CAST(COUNT(*) AS BIGINT) AS rows
  FROM fire_summary WHERE event_date > (SELECT MAX(event_date) FROM p_fire_summary)
  UNION ALL
  SELECT 'earthquake_summary', 'append_hwm', 'SUCCESS', CAST(COUNT(*) AS BIGINT)
  FROM quake_summary WHERE event_date > (SELECT MAX(event_date) FROM p_quake_summary)
  UNION ALL
  SELECT 'combined_events', 'snapshot', 'SUCCESS', CAST(COUNT(*) AS BIGINT) FROM combined_events"""
    export_cte_combined = EXPORT_CTE + combined[len(MARTS_CTE):]
    views = f"""
  SELECT 'mv_combined_events' AS relation, count(*)::BIGINT AS n_rows,
    min(event_date)::VARCHAR AS first_day, max(event_date)::VARCHAR AS last_day FROM combined_events
  UNION ALL
  SELECT 'mv_looker_fire_metrics', count(*), min(event_date)::VARCHAR, max(event_date)::VARCHAR FROM fire_summary
  UNION ALL
  SELECT 'mv_looker_earthquake_metrics', count(*), min(event_date)::VARCHAR, max(event_date)::VARCHAR FROM quake_summary
  UNION ALL
  SELECT 'v_looker_realtime_summary', fires_7d + earthquakes_7d, alert_status, fires_24h::VARCHAR FROM ({REALTIME})"""
    # A relation's date is replaced when the second load adds a row of its sources to it.
    stored_of = {
        "fire_summary": ("fire_summary", "fires"),
        "mv_looker_fire_metrics": ("fire_summary", "fires"),
        "earthquake_summary": ("quake_summary", "quakes"),
        "mv_looker_earthquake_metrics": ("quake_summary", "quakes"),
        "combined_events": ("combined_events", "both"),
        "mv_combined_events": ("combined_events", "both"),
    }
    late = f"""
late AS (
  SELECT 'fires' AS source, CAST(ts AS DATE) AS day FROM events
  WHERE event_type IN {fx.FIRE_TYPES} AND ts >= TIMESTAMP '{FIRST_LOAD_UNTIL}'
  UNION ALL
  SELECT 'quakes', event_date FROM quakes JOIN events ON CAST(events.event_id AS VARCHAR) = quakes.event_id
  WHERE ts >= TIMESTAMP '{FIRST_LOAD_UNTIL}'
)"""
    changed = "\n  UNION ALL\n".join(
        f"""  SELECT '{name}' AS table_name, event_date, CAST(count(*) AS BIGINT) AS n_rows,
    event_date IN (SELECT day FROM late{"" if source == "both" else f" WHERE source = '{source}'"}) AS replaced
  FROM {model} GROUP BY event_date"""
        for name, (model, source) in stored_of.items()
    )
    return {
        "export_hwm": _with(
            EXPORT_CTE,
            """
  SELECT 'fire_summary' AS table_name, 1 AS load, MAX(event_date) AS high_water_mark FROM p_fire_summary
  UNION ALL
  SELECT 'earthquake_summary', 1, MAX(event_date) FROM p_quake_summary
  UNION ALL
  SELECT 'fire_summary', 2, MAX(event_date) FROM fire_summary
  UNION ALL
  SELECT 'earthquake_summary', 2, MAX(event_date) FROM quake_summary""",
        ),
        "export_incremental": _with(EXPORT_CTE, incremental),
        "export_refresh_dates": _with(EXPORT_CTE, "SELECT * FROM fire_summary"),
        "export_snapshot": _with(combined, _combined("combined_events")),
        "export_clustered_layout": _with(
            combined,
            """
  SELECT event_date, event_type, severity_level, CAST(COUNT(*) AS BIGINT) AS n_rows,
    CAST(0 AS BIGINT) AS rows_out_of_order, CAST(0 AS BIGINT) AS rows_in_wrong_folder,
    CAST(0 AS BIGINT) AS files_overlapping
  FROM combined_events GROUP BY event_date, event_type, severity_level""",
        ),
        "export_status": _with(export_cte_combined, status),
        "retention_plan": _retention_sql("plan"),
        "retention_report": _retention_sql("report"),
        "retention_status": _retention_sql("status"),
        "retention_dry_run": _retention_sql("dry_run"),
        "refresh_views": _with(COMBINED_CTE + _summaries(""), views),
        "refresh_changed_dates": _with(COMBINED_CTE + _summaries("") + "," + late, changed),
        "fire_summary_merged": _with(MARTS_CTE, fire_summary_sql()),
        "quake_summary_merged": _with(STAGING_CTE, QUAKE_SUMMARY),
        "fire_clusters_merged": _with(COMBINED_CTE, _combined("fire_clusters")),
        "dq_checks": _with(COMBINED_CTE + _summaries(""), DQ),
        "rejects": _with(FX_FIRES + "," + FX_QUAKES, REJECTS),
        "stream_rejects": _with(FX_FIRES + "," + FX_QUAKES, REJECTS),
    }


def all_sql() -> dict[str, str]:
    return {**core_queries(), **stream_sql(), **maintenance_sql()}
