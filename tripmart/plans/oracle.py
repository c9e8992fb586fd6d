"""DuckDB SQL for each catalog query: an independent statement of the expected rows.

The statements read the pre-registered views ``lineitem``, ``nation`` and ``region``
and restate every layer as a chain of CTEs. They are written for the trip shape the
fixture mapping produces (20 typed columns, the ``Airport_fee`` spelling), so the
schema-tolerance branches of the Spark code collapse to their present-column case.
"""

from __future__ import annotations

from tripmart import schemas as S

_DUCK_TYPES = {"INT": "INTEGER", "BIGINT": "BIGINT", "DOUBLE": "DOUBLE",
               "TIMESTAMP": "TIMESTAMP", "STRING": "VARCHAR"}

RAW_COLUMNS = [c if c != "airport_fee" else "Airport_fee" for c, _ in S.TRIP_SPEC]
_RAW_TYPES = {"VendorID": "INT", "tpep_pickup_datetime": "TIMESTAMP",
              "tpep_dropoff_datetime": "TIMESTAMP", "passenger_count": "BIGINT",
              "trip_distance": "DOUBLE", "RatecodeID": "BIGINT",
              "store_and_fwd_flag": "STRING", "PULocationID": "INT", "DOLocationID": "INT",
              "payment_type": "BIGINT"}


def _raw_type(c: str) -> str:
    return _RAW_TYPES.get(c, "DOUBLE")


TYPE_CHECKS = [f"chk_{c}_type_ok" for c, _ in S.TRIP_SPEC]
DOMAIN_CHECKS = ["chk_VendorID_domain_ok", "chk_passenger_count_ge1", "chk_trip_distance_ge0",
                 "chk_RatecodeID_domain_ok", "chk_store_and_fwd_flag_domain_ok",
                 "chk_PULocationID_pos", "chk_DOLocationID_pos", "chk_payment_type_domain_ok",
                 "chk_amounts_nonneg_ok", "chk_times_order_ok", "chk_duration_lt_24h"]
ALL_CHECKS = TYPE_CHECKS + DOMAIN_CHECKS
SILVER_NAMES = [n for n, _ in S.SILVER_TYPES]


def _type_check_sql() -> str:
    parts = []
    for c, t in S.TRIP_SPEC:
        if c in RAW_COLUMNS:
            parts.append(f"({c} IS NULL OR TRY_CAST({c} AS {_DUCK_TYPES[t]}) IS NOT NULL) "
                         f"AS chk_{c}_type_ok")
        else:
            parts.append(f"TRUE AS chk_{c}_type_ok")
    return ",\n  ".join(parts)


def _domain_check_sql() -> str:
    amounts = " AND ".join(f"{c} >= 0" for c in S.AMOUNT_COLUMNS
                           if c in RAW_COLUMNS)
    return ",\n  ".join([
        "VendorID IN (1, 2, 6, 7) AS chk_VendorID_domain_ok",
        "passenger_count >= 1 AS chk_passenger_count_ge1",
        "trip_distance >= 0 AS chk_trip_distance_ge0",
        "RatecodeID IN (1, 2, 3, 4, 5, 6, 99) AS chk_RatecodeID_domain_ok",
        "(store_and_fwd_flag IS NULL OR upper(store_and_fwd_flag) IN ('Y', 'N')) "
        "AS chk_store_and_fwd_flag_domain_ok",
        "PULocationID > 0 AS chk_PULocationID_pos",
        "DOLocationID > 0 AS chk_DOLocationID_pos",
        "payment_type IN (0, 1, 2, 3, 4, 5, 6) AS chk_payment_type_domain_ok",
        f"({amounts}) AS chk_amounts_nonneg_ok",
        "tpep_dropoff_datetime >= tpep_pickup_datetime AS chk_times_order_ok",
        "(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) < 86400 "
        "AS chk_duration_lt_24h",
    ])


def _null_like(c: str) -> str:
    t = _raw_type(c)
    if t == "DOUBLE":
        return f"({c} IS NULL OR isnan({c}))"
    if t == "STRING":
        return f"({c} IS NULL OR length(trim({c})) = 0)"
    return f"{c} IS NULL"


_std_cols = []
for _n, _t in S.SILVER_TYPES:
    _src = {v: k for k, v in S.SILVER_RENAMES.items()}.get(_n, _n)
    _e = f"TRY_CAST({_src} AS {_DUCK_TYPES[_t]})"
    if _n == "store_and_fwd_flag":
        _e = f"upper(trim({_src}))"
    _std_cols.append(f"{_e} AS {_n}")
STANDARDIZE_SELECT = ",\n  ".join(_std_cols)

_order_silver = ", ".join(f"{c} ASC NULLS FIRST" for c in SILVER_NAMES)
_order_zones = ", ".join(f"{c} ASC NULLS FIRST" for c in S.ZONE_COLUMNS)

DERIVED_SELECT = """
  CAST(pickup_datetime AS DATE) AS pickup_date,
  CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
  CAST(week(pickup_datetime) AS INTEGER) AS pickup_week_of_year,
  CAST(date_trunc('week', pickup_datetime) AS DATE) AS pickup_week_start,
  printf('%04d-W%02d', year(pickup_datetime), week(pickup_datetime)) AS pickup_week_id,
  CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
  strftime(pickup_datetime, '%a') AS pickup_day_of_week,
  CASE WHEN (epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60.0::DOUBLE < 0 THEN NULL
       ELSE (epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60.0::DOUBLE END AS trip_minutes"""

FLAGS_SELECT = """
  trip_minutes / 60.0::DOUBLE AS trip_hours,
  (pickup_hour BETWEEN 7 AND 8) OR (pickup_hour BETWEEN 17 AND 18) AS is_peak_hour,
  pickup_hour >= 20 OR pickup_hour < 6 AS is_night,
  dayofweek(pickup_datetime) IN (0, 6) AS is_weekend,
  CASE WHEN trip_distance > 0 THEN total_amount / trip_distance END AS revenue_per_mile,
  CASE WHEN trip_minutes > 0 THEN total_amount / trip_minutes END AS revenue_per_minute,
  CASE WHEN trip_minutes > 0 THEN trip_distance / (trip_minutes / 60.0::DOUBLE) END AS trip_mph"""

RIDE_ID = """sha256(concat_ws('::',
    coalesce(CAST(vendor_id AS VARCHAR), ''),
    strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S'),
    coalesce(pickup_week_id, ''),
    coalesce(CAST(pu_location_id AS VARCHAR), ''),
    coalesce(CAST(do_location_id AS VARCHAR), ''),
    coalesce(CAST(total_amount AS VARCHAR), '')))"""


def _kpi_sql(source: str, peak: str, night: str) -> str:
    return f"""SELECT pickup_week_id, pickup_week_start, pu_borough, weekly_trips,
  weekly_revenue, sum_trip_distance, avg_trip_distance_miles, avg_trip_time_minutes,
  peak_hour_trips, CAST(peak_hour_trips AS DOUBLE) / weekly_trips AS peak_hour_pct,
  night_trips, CAST(night_trips AS DOUBLE) / weekly_trips AS night_trip_pct,
  CASE WHEN sum_trip_distance IS NULL OR sum_trip_distance = 0 THEN NULL
       ELSE weekly_revenue / sum_trip_distance END AS avg_revenue_per_mile
FROM (SELECT pickup_week_id, pickup_week_start, pu_borough,
    count(*) AS weekly_trips,
    CAST(sum(total_amount) AS DOUBLE) AS weekly_revenue,
    CAST(sum(trip_distance) AS DOUBLE) AS sum_trip_distance,
    avg(trip_minutes) AS avg_trip_time_minutes,
    avg(trip_distance) AS avg_trip_distance_miles,
    CAST(sum(CASE WHEN {peak} THEN 1 ELSE 0 END) AS BIGINT) AS peak_hour_trips,
    CAST(sum(CASE WHEN {night} THEN 1 ELSE 0 END) AS BIGINT) AS night_trips
  FROM (SELECT * REPLACE (CASE WHEN pu_borough IS NULL OR length(trim(pu_borough)) = 0
                              THEN 'UNKNOWN' ELSE pu_borough END AS pu_borough)
        FROM {source})
  GROUP BY pickup_week_id, pickup_week_start, pu_borough)"""


CTES: list[tuple[str, str]] = [
    ("b", "SELECT *, l_orderkey*31 + l_partkey*17 + l_linenumber*7 AS h FROM lineitem"),
    ("c", """SELECT h, l_shipdate, l_quantity, l_suppkey,
  floor(l_extendedprice/1000)*0.25E0 + 2.5E0 AS base,
  (h*37) % 86400 AS off_s,
  CASE WHEN h%97=0 THEN -300 WHEN h%89=0 THEN 90000
       ELSE CAST(l_quantity AS BIGINT)*60 + (h%4)*15 END AS dur_s
  FROM b"""),
    ("t", """SELECT h,
  CAST(CASE WHEN h%61=0 THEN 3 WHEN h%4=0 THEN 1 WHEN h%4=1 THEN 2 WHEN h%4=2 THEN 6 ELSE 7 END AS INT) AS VendorID,
  l_shipdate + to_seconds(off_s) AS tpep_pickup_datetime,
  l_shipdate + to_seconds(off_s+dur_s) AS tpep_dropoff_datetime,
  CAST(CASE WHEN h%13=0 THEN NULL WHEN h%29=0 THEN 0 ELSE h%6+1 END AS BIGINT) AS passenger_count,
  CASE WHEN h%83=0 THEN -1.0E0 WHEN h%71=0 THEN 0.0E0 ELSE l_quantity*0.25E0 END AS trip_distance,
  CAST(CASE WHEN h%13=0 THEN NULL WHEN h%101=0 THEN 50 WHEN h%23=0 THEN 99 ELSE h%6+1 END AS BIGINT) AS RatecodeID,
  CASE WHEN h%13=0 THEN NULL WHEN h%211=0 THEN 'X' WHEN h%11=0 THEN ' ' WHEN h%11=1 THEN 'y ' ELSE 'N' END AS store_and_fwd_flag,
  CAST(CASE WHEN h%109=0 THEN 0 ELSE h%26+1 END AS INT) AS PULocationID,
  CAST(CASE WHEN h%113=0 THEN -1 ELSE (h*3+l_suppkey)%26+1 END AS INT) AS DOLocationID,
  CAST(CASE WHEN h%103=0 THEN 9 ELSE h%7 END AS BIGINT) AS payment_type,
  CASE WHEN h%107=0 THEN -base ELSE base END AS fare_amount,
  (h%3)*0.5E0 AS extra, 0.5E0 AS mta_tax, (h%9)*0.25E0 AS tip_amount,
  CASE WHEN h%19=0 THEN 6.5E0 ELSE 0.0E0 END AS tolls_amount, 1.0E0 AS improvement_surcharge,
  base + (h%3)*0.5E0 + (h%9)*0.25E0 + 1.5E0 AS total_amount,
  CASE WHEN h%13=0 THEN NULL ELSE 2.5E0 END AS congestion_surcharge,
  CASE WHEN h%17=0 THEN 1.75E0 ELSE 0.0E0 END AS Airport_fee, 0.75E0 AS cbd_congestion_fee
  FROM c"""),
    ("trips_raw", "SELECT * EXCLUDE (h) FROM t UNION ALL SELECT * EXCLUDE (h) FROM t WHERE h%50=0"),
    ("zones_raw", """SELECT CAST(n_nationkey+1 AS VARCHAR) AS LocationID,
  CASE WHEN n_nationkey=24 THEN ' ' ELSE concat(' ', r_name) END AS Borough, n_name AS Zone,
  CASE WHEN n_nationkey%3=0 THEN 'Yellow Zone' WHEN n_nationkey%3=1 THEN 'Boro Zone' ELSE 'Green Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey=r_regionkey
  UNION ALL SELECT 'xyz', 'Nowhere', 'Bad Row', 'Boro Zone'
  UNION ALL SELECT '1', r_name, 'NATION_0', 'Yellow Zone' FROM region WHERE r_regionkey=0"""),
    ("trip_clean", "SELECT * REPLACE (nullif(trim(store_and_fwd_flag), '') AS store_and_fwd_flag) "
                   "FROM trips_raw"),
    ("trip_type_checked", f"SELECT *,\n  {_type_check_sql()}\nFROM trip_clean"),
    ("trip_domain_checked", f"SELECT *,\n  {_domain_check_sql()}\nFROM trip_clean"),
    ("trip_checked", f"SELECT *,\n  {_type_check_sql()},\n  {_domain_check_sql()}\nFROM trip_clean"),
    ("trip_flagged", f"SELECT *, ({' AND '.join(ALL_CHECKS)}) AS dq_pass FROM trip_checked"),
    ("trip_pass", f"SELECT {', '.join(RAW_COLUMNS)} FROM trip_flagged WHERE dq_pass"),
    ("zones_norm", "SELECT " + ", ".join(f"nullif(trim({c}), '') AS {c}" for c in S.ZONE_COLUMNS)
     + " FROM zones_raw"),
    ("zones_checked", """SELECT *,
  TRY_CAST(LocationID AS INTEGER) IS NOT NULL AS chk_LocationID_numeric,
  Borough IS NOT NULL AS chk_Borough_not_null,
  Zone IS NOT NULL AS chk_Zone_not_null,
  service_zone IS NOT NULL AS chk_service_zone_not_null
  FROM zones_norm"""),
    ("zone_dim", f"""SELECT location_id, trim(Borough) AS borough, trim(Zone) AS zone,
  trim(service_zone) AS service_zone
  FROM (SELECT *, TRY_CAST(LocationID AS INTEGER) AS location_id,
          row_number() OVER (PARTITION BY TRY_CAST(LocationID AS INTEGER) ORDER BY {_order_zones}) AS rn
        FROM zones_checked WHERE TRY_CAST(LocationID AS INTEGER) IS NOT NULL)
  WHERE rn = 1"""),
    ("trips_std", f"SELECT\n  {STANDARDIZE_SELECT}\nFROM trip_pass"),
    ("trips_zoned", """SELECT s.*, pu.borough AS pu_borough, pu.zone AS pu_zone,
  pu.service_zone AS pu_service_zone, d.borough AS do_borough, d.zone AS do_zone,
  d.service_zone AS do_service_zone
  FROM trips_std s
  LEFT JOIN zone_dim pu ON pu.location_id = s.pu_location_id
  LEFT JOIN zone_dim d ON d.location_id = s.do_location_id"""),
    ("trips_derived_base", f"SELECT *, {DERIVED_SELECT}\nFROM trips_zoned"),
    ("trips_derived", f"SELECT *, {FLAGS_SELECT}\nFROM trips_derived_base"),
    ("trips_keyed", f"SELECT *, {RIDE_ID} AS ride_id FROM trips_derived"),
    ("curated", f"""SELECT {', '.join(S.SILVER_ORDER)} FROM (
  SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY {_order_silver}) AS rn
  FROM trips_keyed) WHERE rn = 1"""),
    ("kpis", _kpi_sql("curated", "is_peak_hour", "is_night")),
    ("weekly", """SELECT pickup_week_id, pickup_week_start, count(*) AS row_count,
  sum(total_amount) AS total_revenue, sum(trip_distance) AS total_miles
  FROM curated GROUP BY pickup_week_id, pickup_week_start"""),
]


def _with(final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in CTES)
    return f"WITH {body}\n{final}"


# ---------------------------------------------------------------------------
# Metric tables
# ---------------------------------------------------------------------------

def _metric_row(metric: str, value: str = "NULL", p: str = "NULL", f: str = "NULL",
                rate: str = "NULL", category: str = "") -> str:
    return (f"SELECT '{metric}' AS metric, CAST({value} AS VARCHAR) AS value, "
            f"CAST({p} AS BIGINT) AS pass_count, CAST({f} AS BIGINT) AS fail_count, "
            f"CAST({rate} AS VARCHAR) AS pass_rate, '{category}' AS category FROM agg")


def _rate(p: str, total: str) -> str:
    return (f"printf('%.6f', CASE WHEN ({total}) = 0 THEN 1.0::DOUBLE "
            f"ELSE CAST({p} AS DOUBLE) / ({total}) END)")


def _share(part: str) -> str:
    return f"CASE WHEN n > 0 THEN CAST({part} AS DOUBLE) / n END"


def _metric_parts(parts: tuple[str, ...], columns: list[str], null_like) -> tuple[list[str], list[str]]:
    """The metric rows' SELECTs over ``agg``, and its aggregates."""
    aggs = ["count(*) AS n", "count(*) FILTER (WHERE dq_pass) AS n_pass",
            "count(*) FILTER (WHERE dq_pass IS NULL) AS n_undecided"]
    rows = []
    if "counts" in parts:
        rows += [_metric_row("row_count_total", "n", category="counts"),
                 _metric_row("row_count_pass", "n_pass", category="counts"),
                 _metric_row("row_count_reject", "n - n_pass", category="counts"),
                 _metric_row("row_count_indeterminate", "n_undecided", category="counts")]
    present = [c for c, _ in S.TRIP_SPEC if c in columns]
    if "nulls" in parts:
        for i, c in enumerate(present):
            aggs.append(f"count(*) FILTER (WHERE {null_like(c)}) AS nn{i}")
            rows.append(_metric_row(f"null_pct_{c}", _share(f"nn{i}"), category="nulls"))
    if "checks" in parts:
        for i, c in enumerate(ALL_CHECKS):
            aggs.append(f"count(*) FILTER (WHERE {c}) AS p{i}")
            aggs.append(f"count(*) FILTER (WHERE NOT {c}) AS f{i}")
            cat = "type" if c.endswith("_type_ok") else "domain_range"
            rows.append(_metric_row(c, "NULL", f"p{i}", f"f{i}", _rate(f"p{i}", f"p{i} + f{i}"), cat))
    if "domain_range" in parts:
        aggs.append(f"count(*) FILTER (WHERE {' AND '.join(DOMAIN_CHECKS)}) AS dr")
        rows.append(_metric_row("domain_range_all", "NULL", "dr", "n - dr", _rate("dr", "n"),
                                "domain_range"))
    return rows, aggs


def metric_rows(parts: tuple[str, ...]) -> str:
    rows, aggs = _metric_parts(parts, RAW_COLUMNS, _null_like)
    agg = f"agg AS (SELECT {', '.join(aggs)} FROM trip_flagged)"
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in CTES)
    return f"WITH {body},\n{agg}\n" + "\nUNION ALL\n".join(rows)


def _simple_rows(rows: list[tuple[str, str]], agg: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in CTES)
    sel = "\nUNION ALL\n".join(f"SELECT '{m}' AS metric, CAST({v} AS VARCHAR) AS value FROM agg"
                               for m, v in rows)
    return f"WITH {body},\nagg AS ({agg})\n{sel}"


def _zone_summary() -> str:
    checks = " AND ".join(["chk_LocationID_numeric", "chk_Borough_not_null",
                           "chk_Zone_not_null", "chk_service_zone_not_null"])
    return _simple_rows(
        [("row_count_total", "n"), ("row_count_pass", "p"), ("row_count_reject", "n - p")],
        f"SELECT count(*) AS n, count(*) FILTER (WHERE {checks}) AS p FROM zones_checked")


def _zone_nulls() -> str:
    aggs = ["count(*) AS n"] + [f"count(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS nn{i}"
                                for i, c in enumerate(S.ZONE_COLUMNS)]
    return _simple_rows([(f"null_pct_{c}", _share(f"nn{i}")) for i, c in enumerate(S.ZONE_COLUMNS)],
                        f"SELECT {', '.join(aggs)} FROM zones_checked")


def _slice(col: str) -> str:
    return _with(f"SELECT pickup_week_id, pu_borough, {col} FROM kpis "
                 "ORDER BY pickup_week_id, pu_borough, pickup_week_start LIMIT 500")


def _type_only() -> str:
    return _with("SELECT * FROM trip_type_checked")


# ---------------------------------------------------------------------------
# All-text trips, and trips with columns missing
# ---------------------------------------------------------------------------

def _text_ctes(missing: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """trips_text, text_clean, text_flagged: every column is text, with junk by residue."""
    def cell(i: int, c: str) -> str:
        nan = "WHEN h%103=5 THEN 'NaN' " if c == "trip_distance" else ""
        return f"CASE WHEN h%101={i} THEN 'x' {nan}ELSE CAST({c} AS VARCHAR) END AS {c}"

    cols = ", ".join(f"{cell(i, c)}" for i, c in enumerate(RAW_COLUMNS))
    kept = [c for c in RAW_COLUMNS if c not in missing]
    types = dict(S.TRIP_SPEC) | {"Airport_fee": "DOUBLE"}

    def typed(c: str) -> str:
        return f"TRY_CAST({c} AS {_DUCK_TYPES[types[c]]})"

    def rule(name: str, needs: list[str], sql: str) -> str:
        return f"({sql}) AS {name}" if all(n in kept for n in needs) else f"TRUE AS {name}"

    type_flags = [f"({c} IS NULL OR {typed(c)} IS NOT NULL) AS chk_{c}_type_ok" if c in kept else f"TRUE AS chk_{c}_type_ok"
                  for c, _ in S.TRIP_SPEC]
    up, down = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    amounts = " AND ".join(f"{typed(c)} >= 0" for c in S.AMOUNT_COLUMNS if c in kept)
    domain_flags = [
        rule("chk_VendorID_domain_ok", ["VendorID"], f"{typed('VendorID')} IN (1, 2, 6, 7)"),
        rule("chk_passenger_count_ge1", ["passenger_count"], f"{typed('passenger_count')} >= 1"),
        rule("chk_trip_distance_ge0", ["trip_distance"], f"{typed('trip_distance')} >= 0"),
        rule("chk_RatecodeID_domain_ok", ["RatecodeID"], f"{typed('RatecodeID')} IN (1, 2, 3, 4, 5, 6, 99)"),
        rule("chk_store_and_fwd_flag_domain_ok", ["store_and_fwd_flag"],
             "store_and_fwd_flag IS NULL OR upper(store_and_fwd_flag) IN ('Y', 'N')"),
        rule("chk_PULocationID_pos", ["PULocationID"], f"{typed('PULocationID')} > 0"),
        rule("chk_DOLocationID_pos", ["DOLocationID"], f"{typed('DOLocationID')} > 0"),
        rule("chk_payment_type_domain_ok", ["payment_type"], f"{typed('payment_type')} IN (0, 1, 2, 3, 4, 5, 6)"),
        f"({amounts}) AS chk_amounts_nonneg_ok",
        rule("chk_times_order_ok", [up, down], f"{typed(down)} >= {typed(up)}"),
        rule("chk_duration_lt_24h", [up, down], f"epoch({typed(down)}) - epoch({typed(up)}) < 86400"),
    ]
    flags = type_flags + domain_flags
    return [
        ("text_rows", f"SELECT h, {cols} FROM t"),
        ("trips_text", f"SELECT {', '.join(kept)} FROM text_rows UNION ALL SELECT {', '.join(kept)} FROM text_rows WHERE h%50=0"),
        ("text_clean", "SELECT * REPLACE (nullif(trim(store_and_fwd_flag), '') AS store_and_fwd_flag) FROM trips_text"),
        ("text_type_checked", f"SELECT *, {', '.join(type_flags)} FROM text_clean"),
        ("text_domain_checked", f"SELECT *, {', '.join(domain_flags)} FROM text_clean"),
        ("text_checked", f"SELECT *, {', '.join(flags)} FROM text_clean"),
        ("text_flagged", f"SELECT *, ({' AND '.join(ALL_CHECKS)}) AS dq_pass FROM text_checked"),
    ]


def _text_with(final: str, missing: tuple[str, ...] = ()) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in [*CTES[:3], *_text_ctes(missing)])
    return f"WITH {body}\n{final}"


def _text_metrics(missing: tuple[str, ...] = ()) -> str:
    rows, aggs = _metric_parts(("counts", "nulls", "checks", "domain_range"),
                               [c for c in RAW_COLUMNS if c not in missing],
                               lambda c: f"({c} IS NULL OR length(trim({c})) = 0)")
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in [*CTES[:3], *_text_ctes(missing)])
    return f"WITH {body},\nagg AS (SELECT {', '.join(aggs)} FROM text_flagged)\n" + "\nUNION ALL\n".join(rows)


_OUTPUTS = """(VALUES ('pass'), ('_rejects'), ('_indeterminate')) AS o(output)"""
_STATUS = "CASE WHEN dq_pass THEN 'pass' WHEN NOT dq_pass THEN '_rejects' ELSE '_indeterminate' END"


def _outcomes(where: str = "TRUE") -> str:
    return (f"SELECT o.output, count(f.output) > 0 AS written, count(f.output) AS rows FROM {_OUTPUTS} "
            f"LEFT JOIN (SELECT {_STATUS} AS output FROM trip_flagged WHERE {where}) f ON f.output = o.output GROUP BY 1")


def _filled(layer: str, columns: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {extra}'{c}' AS \"column\", count({c}) AS filled FROM {layer}" for c in columns)


_SPARK_TYPES = {"INT": "int", "DOUBLE": "double", "TIMESTAMP": "timestamp", "STRING": "string"}
# Spark's type names of the derived curated columns, written down here on purpose.
_DERIVED = {"ride_id": "string", "pickup_date": "date", "pickup_hour": "int", "pickup_day_of_week": "string",
            "pickup_year": "int", "pickup_week_of_year": "int", "pickup_week_start": "date", "pickup_week_id": "string",
            "trip_minutes": "double", "trip_hours": "double", "pu_borough": "string", "pu_zone": "string",
            "pu_service_zone": "string", "do_borough": "string", "do_zone": "string", "do_service_zone": "string",
            "revenue_per_mile": "double", "revenue_per_minute": "double", "trip_mph": "double", "is_peak_hour": "boolean",
            "is_night": "boolean", "is_weekend": "boolean"}


def _layer_schema() -> str:
    types = {n: _SPARK_TYPES[t] for n, t in S.SILVER_TYPES} | _DERIVED
    return _with(" UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{types[c]}' AS type, count({c}) AS filled FROM curated"
        for i, c in enumerate(S.SILVER_ORDER)))


def _column_diff() -> str:
    added = [c for c in S.SILVER_ORDER if c not in RAW_COLUMNS]
    removed = [c for c in RAW_COLUMNS if c not in S.SILVER_ORDER]
    return _with(_filled("curated", added, "'added' AS change, ") + " UNION ALL "
                 + _filled("trip_pass", removed, "'removed' AS change, "))


def _more() -> dict[str, str]:
    """Queries over written layers, all-text input and missing columns."""
    trip_rows = metric_rows(("counts", "nulls", "checks", "domain_range"))
    body, select = trip_rows.rsplit("FROM trip_flagged)\n", 1)
    zone_checks = " AND ".join(["chk_LocationID_numeric", "chk_Borough_not_null", "chk_Zone_not_null", "chk_service_zone_not_null"])
    zone_nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS zn{i}" for i, c in enumerate(S.ZONE_COLUMNS))
    simple = [("row_count_total", "n", "zone_counts"), ("row_count_pass", "p", "zone_counts"), ("row_count_reject", "n - p", "zone_counts")]
    simple += [(f"null_pct_{c}", _share(f"zn{i}"), "zone_nulls") for i, c in enumerate(S.ZONE_COLUMNS)]
    zone_rows = "\nUNION ALL\n".join(
        f"SELECT '{m}' AS metric, CAST({v} AS VARCHAR) AS value, CAST(NULL AS BIGINT) AS pass_count, "
        f"CAST(NULL AS BIGINT) AS fail_count, CAST(NULL AS VARCHAR) AS pass_rate, '{c}' AS category FROM zagg" for m, v, c in simple)
    per_table = {name: part for name, part in S.RUN_SUMMARY_DIRS.items()}
    job = [f"SELECT *, '_run_summary_all' AS output FROM m"]
    job += [f"SELECT *, '{name}' AS output FROM m WHERE " + {
        "counts": "category = 'counts'", "nulls": "category = 'nulls'",
        "checks": "category IN ('type', 'domain_range') AND metric <> 'domain_range_all'",
        "domain_range": "metric = 'domain_range_all'"}[part] for name, part in per_table.items()]
    kpi_means = ("SELECT count(*) AS num_week_borough_combinations, CAST(sum(weekly_trips) AS BIGINT) AS total_trips, "
                 "sum(weekly_revenue) AS total_revenue, round(avg(avg_trip_distance_miles), 6) AS mean_avg_distance_miles, "
                 "round(avg(avg_trip_time_minutes), 6) AS mean_avg_time_minutes, round(avg(peak_hour_pct), 6) AS mean_peak_hour_pct, "
                 "round(avg(night_trip_pct), 6) AS mean_night_trip_pct, "
                 "round(avg(avg_revenue_per_mile), 6) AS mean_revenue_per_mile FROM kpis")
    return {
        "trip_type_checks_text": _text_with("SELECT * FROM text_type_checked"),
        "trip_domain_checks_text": _text_with("SELECT * FROM text_domain_checked"),
        "summary_all_text": _text_metrics(),
        "summary_all_missing_columns": _text_metrics(("VendorID", "cbd_congestion_fee")),
        "all_metrics": f"{body}FROM trip_flagged),\nzagg AS (SELECT count(*) AS n, count(*) FILTER (WHERE {zone_checks}) AS p, "
                       f"{zone_nulls} FROM zones_checked)\n{select}\nUNION ALL\n{zone_rows}",
        "trip_job_metrics": f"{body}FROM trip_flagged),\nm AS ({select})\n" + "\nUNION ALL\n".join(job),
        "weekly_kpis_derived_hour": _with(_kpi_sql(
            "curated", "hour(pickup_datetime) IN (7, 8, 17, 18)",
            "(hour(pickup_datetime) BETWEEN 22 AND 23) OR (hour(pickup_datetime) BETWEEN 0 AND 5)")),
        "write_outcomes": _with(_outcomes()),
        "empty_write_skipped": _with(" UNION ALL ".join(
            f"SELECT *, '{name}' AS input FROM ({_outcomes(where)})" for name, where in
            (("all", "TRUE"), ("passing", "dq_pass"), ("rejected", "NOT dq_pass")))),
        "zone_job_checked": _with("SELECT * FROM zones_checked"),
        "zone_job_summary": _zone_summary(),
        "zone_job_nulls": _zone_nulls(),
        "silver_job_curated": _with("SELECT * FROM curated"),
        "silver_job_weekly": _with("SELECT * FROM weekly"),
        "silver_job_overview": _with(
            "SELECT count(*) AS row_count, sum(total_amount) AS total_revenue, sum(trip_distance) AS total_miles, "
            "avg(trip_distance) AS avg_trip_distance, avg(trip_minutes) AS avg_trip_minutes, "
            "avg(CASE WHEN is_peak_hour THEN 1 ELSE 0 END) AS peak_hour_pct, "
            "avg(CASE WHEN is_night THEN 1 ELSE 0 END) AS night_trip_pct FROM curated"),
        "silver_job_sample": _with("SELECT * FROM curated ORDER BY pickup_datetime, ride_id LIMIT 20"),
        "gold_job_overview": _with(kpi_means),
        "gold_job_top": _with("SELECT pickup_week_id, pu_borough, weekly_trips, weekly_revenue FROM kpis "
                              "ORDER BY weekly_trips DESC, pickup_week_id, pu_borough, pickup_week_start LIMIT 10"),
        "gold_job_sample": _with("SELECT * FROM kpis ORDER BY pickup_week_start, pu_borough, pickup_week_id LIMIT 20"),
        "layer_schema": _layer_schema(),
        "layer_column_diff": _column_diff(),
        "layer_sample": _with("SELECT * FROM curated ORDER BY ride_id LIMIT 5000"),
    }


def _chain(over: dict[str, str], final: str) -> str:
    """The layers' CTEs with some of them restated."""
    body = ",\n".join(f"{name} AS (\n{over.get(name, sql)}\n)" for name, sql in CTES)
    return f"WITH {body}\n{final}"


def _drifted() -> str:
    """Generation 0 has no congestion fee, generation 2 alone has a trip type; types are the widest of all."""
    wide = {"VendorID": "BIGINT", "PULocationID": "BIGINT", "passenger_count": "DOUBLE"}
    cols = []
    for c in RAW_COLUMNS:
        if c in wide:
            cols.append(f"CAST({c} AS {wide[c]}) AS {c}")
        elif c == "cbd_congestion_fee":
            cols.append("CASE WHEN year(tpep_pickup_datetime) % 3 <> 0 THEN cbd_congestion_fee END AS cbd_congestion_fee")
        else:
            cols.append(f"{c} AS airport_fee" if c == "Airport_fee" else c)
    return f"SELECT {', '.join(cols)}, CASE WHEN year(tpep_pickup_datetime) % 3 = 2 THEN VendorID + 1 END AS trip_type FROM ({{}})"


def _increments(final: str) -> str:
    raw = dict(CTES)["trips_raw"]
    day, week = "dayofmonth(tpep_pickup_datetime)", "week(tpep_pickup_datetime)"
    return _chain({"trips_raw": f"SELECT * FROM ({raw}) WHERE {day} <= 20 OR ({day} >= 15 AND {week} % 2 = 1)"}, final)


def _previews() -> str:
    values = [c for c in S.KPI_ORDER if c not in ("pickup_week_id", "pickup_week_start", "pu_borough")]
    order = {S.FULL_PREVIEW: "pickup_week_start, pu_borough, pickup_week_id"}
    parts = [(name, c) for name in (S.FULL_PREVIEW, *S.KPI_SLICES) for c in (values if name == S.FULL_PREVIEW else [name])]
    return _with(" UNION ALL ".join(
        f"SELECT '{name}' AS preview, pickup_week_id, pu_borough, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM (SELECT * FROM kpis "
        f"ORDER BY {order.get(name, 'pickup_week_id, pu_borough, pickup_week_start')} LIMIT 500)" for name, c in parts))


def _jobs_and_drift() -> dict[str, str]:
    raw = dict(CTES)["trips_raw"]
    drifted = _drifted().format(raw)
    n = "TRY_CAST(LocationID AS INTEGER)"
    return {
        "trips_raw_drifted": _chain({"trips_raw": drifted}, "SELECT * FROM trips_raw"),
        "trip_flagged_drifted": _chain({"trips_raw": drifted}, "SELECT * FROM trip_flagged"),
        "zones_csv_reordered": _with(
            f"SELECT LocationID, Borough, CASE WHEN short THEN NULL ELSE Zone END AS Zone, CASE WHEN short THEN NULL ELSE service_zone END "
            f"AS service_zone, CASE WHEN short THEN concat(LocationID, ',', Borough) END AS bad_line "
            f"FROM (SELECT *, coalesce({n} % 5 = 0, FALSE) AS short FROM zones_raw)"),
        "increment_curated": _increments("SELECT * FROM curated"),
        "increment_gold": _increments("SELECT * FROM kpis"),
        "versioned_curated": _with("SELECT * FROM curated"),
        "versioned_gold": _with("SELECT * FROM kpis"),
        "trip_metrics_merged": metric_rows(("counts", "nulls", "checks", "domain_range")),
        "gold_job_previews": _previews(),
        "gold_job_summary": _with(
            "SELECT 'run-7' AS run_id, '2025-02-03T04:05:06Z' AS stamp, '/curated' AS silver_path, '/gold' AS gold_path, "
            "CAST(count(*) AS BIGINT) AS weeks_covered, CAST(coalesce(sum(t), 0) AS BIGINT) AS total_weekly_trips FROM "
            "(SELECT pickup_week_id, sum(weekly_trips) AS t FROM kpis GROUP BY pickup_week_id)"),
        "gold_job_empty": _with("SELECT c.x AS \"case\", FALSE AS summary, FALSE AS written, (SELECT count(*) FROM kpis) AS full_kpis "
                                "FROM (VALUES ('empty'), ('missing')) AS c(x)"),
        "null_pct_no_columns": _with("SELECT LocationID AS metric, LocationID AS value FROM zones_checked WHERE FALSE"),
        "trip_totals_stamped": f"SELECT *, TIMESTAMP '2025-02-03 04:05:06' AS stamp FROM ({metric_rows(('counts',))})",
    }


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {
        "trips_raw": _with("SELECT * FROM trips_raw"),
        "zones_raw": _with("SELECT * FROM zones_raw"),
        "zone_normalized": _with("SELECT * FROM zones_norm"),
        "zone_checks": _with("SELECT * FROM zones_checked"),
        "zone_summary": _zone_summary(),
        "zone_null_pct": _zone_nulls(),
        "trip_normalized": _with("SELECT * FROM trip_clean"),
        "trip_type_checks": _type_only(),
        "trip_domain_checks": _with("SELECT * FROM trip_domain_checked"),
        "trip_flagged": _with("SELECT * FROM trip_flagged"),
        "trip_pass": _with("SELECT * FROM trip_pass"),
        "trip_rejects": _with("SELECT * FROM trip_flagged WHERE NOT dq_pass"),
        "trip_indeterminate": _with("SELECT * FROM trip_flagged WHERE dq_pass IS NULL"),
        "trip_totals": metric_rows(("counts",)),
        "trip_null_pct": metric_rows(("nulls",)),
        "trip_check_metrics": metric_rows(("checks",)),
        "domain_range_all": metric_rows(("domain_range",)),
        "summary_all": metric_rows(("counts", "nulls", "checks", "domain_range")),
        "trips_standardized": _with("SELECT * FROM trips_std"),
        "zone_dimension": _with("SELECT * FROM zone_dim"),
        "trips_with_zones": _with("SELECT * FROM trips_zoned"),
        "trips_derived": _with("SELECT * FROM trips_derived"),
        "ride_ids": _with(
            "SELECT ride_id, vendor_id, pickup_datetime, pickup_week_id, pu_location_id, "
            f"do_location_id, total_amount FROM (SELECT *, {RIDE_ID} AS ride_id FROM "
            "(SELECT *, printf('%04d-W%02d', year(pickup_datetime), week(pickup_datetime)) "
            "AS pickup_week_id FROM trips_std))"),
        "curated": _with("SELECT * FROM curated"),
        "trip_zone_ref_checks": _with(
            "SELECT * EXCLUDE (dq_pass), (dq_pass AND chk_PULocationID_ref_ok AND "
            "chk_DOLocationID_ref_ok) AS dq_pass FROM (SELECT *, "
            "CASE WHEN PULocationID IS NULL THEN NULL ELSE PULocationID IN "
            "(SELECT location_id FROM zone_dim) END AS chk_PULocationID_ref_ok, "
            "CASE WHEN DOLocationID IS NULL THEN NULL ELSE DOLocationID IN "
            "(SELECT location_id FROM zone_dim) END AS chk_DOLocationID_ref_ok "
            "FROM trip_flagged)"),
        "orphan_pickup_zones": _with(
            "SELECT pu_location_id, count(*) AS orphan_trips FROM curated c "
            "WHERE NOT EXISTS (SELECT 1 FROM zone_dim z WHERE z.location_id = c.pu_location_id) "
            "GROUP BY pu_location_id"),
        "orphan_dropoff_zones": _with(
            "SELECT do_location_id, count(*) AS orphan_trips FROM curated c "
            "WHERE NOT EXISTS (SELECT 1 FROM zone_dim z WHERE z.location_id = c.do_location_id) "
            "GROUP BY do_location_id"),
        "weekly_summary": _with("SELECT * FROM weekly"),
        "weekly_kpis": _with("SELECT * FROM kpis ORDER BY pickup_week_start, pu_borough, pickup_week_id"),
        "weekly_kpis_derived_flags": _with(
            _kpi_sql("curated", "pickup_hour IN (7, 8, 17, 18)",
                     "(pickup_hour BETWEEN 22 AND 23) OR (pickup_hour BETWEEN 0 AND 5)")),
        "full_kpis_500": _with("SELECT * FROM kpis ORDER BY pickup_week_start, pu_borough, "
                               "pickup_week_id LIMIT 500"),
        "run_summary": _with("SELECT CAST(count(*) AS BIGINT) AS weeks_covered, "
                             "CAST(coalesce(sum(t), 0) AS BIGINT) AS total_weekly_trips FROM "
                             "(SELECT pickup_week_id, sum(weekly_trips) AS t FROM kpis "
                             "GROUP BY pickup_week_id)"),
        "silver_kpi_overview": _with(
            "SELECT count(*) AS row_count, sum(total_amount) AS total_revenue, "
            "sum(trip_distance) AS total_miles, avg(trip_distance) AS avg_trip_distance, "
            "avg(trip_minutes) AS avg_trip_minutes, "
            "avg(CASE WHEN is_peak_hour THEN 1 ELSE 0 END) AS peak_hour_pct, "
            "avg(CASE WHEN is_night THEN 1 ELSE 0 END) AS night_trip_pct FROM curated"),
        "gold_kpi_overview": _with(
            "SELECT count(*) AS num_week_borough_combinations, "
            "CAST(sum(weekly_trips) AS BIGINT) AS total_trips, "
            "sum(weekly_revenue) AS total_revenue, "
            "round(avg(avg_trip_distance_miles), 6) AS mean_avg_distance_miles, "
            "round(avg(avg_trip_time_minutes), 6) AS mean_avg_time_minutes, "
            "round(avg(peak_hour_pct), 6) AS mean_peak_hour_pct, "
            "round(avg(night_trip_pct), 6) AS mean_night_trip_pct, "
            "round(avg(avg_revenue_per_mile), 6) AS mean_revenue_per_mile FROM kpis"),
        "top_week_boroughs": _with(
            "SELECT pickup_week_id, pu_borough, weekly_trips, weekly_revenue FROM kpis "
            "ORDER BY weekly_trips DESC, pickup_week_id, pu_borough, pickup_week_start LIMIT 10"),
        "silver_sample": _with("SELECT * FROM curated ORDER BY pickup_datetime, ride_id LIMIT 20"),
        "gold_sample": _with("SELECT * FROM kpis ORDER BY pickup_week_start, pu_borough, "
                             "pickup_week_id LIMIT 20"),
        "weekly_summary_sorted": _with("SELECT * FROM weekly ORDER BY pickup_week_start, pickup_week_id"),
        "layer_row_counts": _with(
            "SELECT 'raw' AS layer, count(*) AS rows FROM trips_raw UNION ALL "
            "SELECT 'bronze_pass', count(*) FROM trip_pass UNION ALL "
            "SELECT 'silver_curated', count(*) FROM curated UNION ALL "
            "SELECT 'gold_kpis', count(*) FROM kpis"),
        "layer_row_counts_written": _with(
            "SELECT 'bronze_trips' AS layer, count(*) AS rows FROM trips_raw UNION ALL "
            "SELECT 'silver_curated', count(*) FROM curated UNION ALL "
            "SELECT 'gold_kpis', count(*) FROM kpis UNION ALL SELECT 'missing', 0"),
        "layer_row_delta": _with(
            "SELECT 'bronze_pass' AS layer_before, 'silver_curated' AS layer_after, "
            "b.n AS rows_before, a.n AS rows_after, a.n - b.n AS row_delta "
            "FROM (SELECT count(*) AS n FROM trip_pass) b, (SELECT count(*) AS n FROM curated) a"),
        "parquet_roundtrip": _with("SELECT * FROM trip_pass"),
        "partitioned_gold_roundtrip": _with("SELECT * FROM kpis"),
        "csv_preview_roundtrip": _with(
            "SELECT pickup_week_id, pu_borough, CAST(weekly_trips AS VARCHAR) AS weekly_trips "
            "FROM kpis ORDER BY pickup_week_id, pu_borough, pickup_week_start LIMIT 500"),
        "json_summary_roundtrip": _with(
            "SELECT CAST(count(*) AS BIGINT) AS weeks_covered, "
            "CAST(coalesce(sum(t), 0) AS BIGINT) AS total_weekly_trips FROM "
            "(SELECT pickup_week_id, sum(weekly_trips) AS t FROM kpis GROUP BY pickup_week_id)"),
        "zones_csv_scan": _with("SELECT * FROM zones_raw"),
        "first_available_source": _with("SELECT * FROM zones_raw"),
    }
    for c in S.KPI_SLICES:
        q[f"slice_{c}"] = _slice(c)
    return q | _more() | _jobs_and_drift()
