"""Independent DuckDB formulation of every registered query.

Used as the correctness oracle: the same adapters, cleaning rules, KPIs,
ranks, alerts and reports written as one SQL statement per query over the
benchmark tables (views ``events lineitem orders customer nation``).

DuckDB differences handled here:
* ``x / 0`` is inf in DuckDB and NULL with ``try_divide`` in Spark ->
  ``x / NULLIF(y, 0)``;
* Spark rounds HALF_UP on the shortest decimal text of a double; DuckDB
  rounds the binary value -> round the double's text as ``DECIMAL(38,18)``;
* ``concat`` skips NULLs in DuckDB -> messages use ``||``;
* sums of integers are HUGEINT -> cast to BIGINT.
"""

from __future__ import annotations


def R(expr: str, n: int) -> str:
    return f"CAST(round(CAST(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def _div(a: str, b: str) -> str:
    return f"(CAST(({a}) AS DOUBLE) / NULLIF(CAST(({b}) AS DOUBLE), 0))"


def _dedupe(src: str, key: str, ordering: list[str]) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in ordering)
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) "
            f"AS _rn FROM {src}) WHERE _rn = 1")


AS_OF_DATE = "DATE '2024-01-31'"
AS_OF_TS = "CAST(TIMESTAMP '2024-01-31 00:00:00' AS TIMESTAMP)"

# -- sources ----------------------------------------------------------------
TELE_RAW = """
tele_raw AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CAST(user_id AS VARCHAR) AS vehicle_id,
         CASE WHEN event_id % 50 = 0 THEN NULL
              ELSE CAST(user_id + CASE WHEN event_id % 10 = 1 THEN 1 ELSE 0 END AS VARCHAR) END AS driver_id,
         ts AS event_timestamp,
         -26.5::DOUBLE + (event_id % 1000) / 1000.0::DOUBLE AS latitude,
         27.5::DOUBLE + (event_id % 1000) / 1000.0::DOUBLE AS longitude,
         value AS speed_kmh,
         CAST(NULL AS DOUBLE) AS odometer_km,
         CAST(NULL AS INTEGER) AS engine_rpm,
         CAST(CASE WHEN event_type = 'error' THEN 3 ELSE 0 END AS INTEGER) AS harsh_braking,
         CAST(CASE WHEN event_type = 'purchase' THEN 2 ELSE 0 END AS INTEGER) AS harsh_accel,
         CASE WHEN event_type = 'view' THEN CAST(event_id % 20 AS DOUBLE) ELSE 0.0::DOUBLE END AS idling_minutes,
         1.5::DOUBLE * CAST(json_extract_string(props, '$.k') AS DOUBLE) AS distance_km
  FROM events)"""

TELE = f"""
tele AS (
  SELECT *, CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour
  FROM ({_dedupe("tele_raw", "event_id", ["event_timestamp", "vehicle_id", "driver_id", "latitude", "longitude",
                                             "speed_kmh", "odometer_km", "engine_rpm", "harsh_braking",
                                             "harsh_accel", "idling_minutes", "distance_km"])})
  WHERE speed_kmh BETWEEN 0 AND 200)"""

FUEL_RAW = """
fuel_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS fuel_id,
         CAST(l_suppkey AS VARCHAR) AS vehicle_id,
         l_shipdate AS fill_timestamp,
         l_quantity * l_discount AS litres_filled,
         l_extendedprice / 1000.0::DOUBLE AS cost_zar,
         CAST(NULL AS DOUBLE) AS odometer_km,
         CAST(NULL AS VARCHAR) AS fuel_station_id
  FROM lineitem)"""

FUEL = f"""
fuel AS (
  SELECT *, CAST(fill_timestamp AS DATE) AS fill_date, cost_zar / NULLIF(litres_filled, 0) AS cost_per_litre
  FROM ({_dedupe("fuel_raw", "fuel_id", ["fill_timestamp", "vehicle_id", "litres_filled", "cost_zar",
                                           "odometer_km", "fuel_station_id"])})
  WHERE litres_filled > 0)"""

MAINT_RAW = """
maint_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS record_id,
         CASE WHEN o_custkey % 7 = 0 THEN 'pool-' || CAST(o_custkey % 10 AS VARCHAR)
              ELSE CAST(o_custkey AS VARCHAR) END AS vehicle_id,
         CAST(o_orderdate AS DATE) AS service_date,
         o_orderpriority AS service_type,
         o_totalprice AS next_service_km,
         CAST(DATE '2024-01-31' + CAST(o_orderkey % 106 - 15 AS INTEGER) AS DATE) AS next_service_date,
         o_totalprice / 100.0::DOUBLE AS cost_zar,
         CAST(o_orderkey % 5 AS VARCHAR) AS workshop_id,
         CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS INTEGER) AS compliant
  FROM orders)"""

MAINT = f"""
maint AS (
  SELECT *,
         CAST(CASE WHEN next_service_date < {AS_OF_DATE} THEN 1 ELSE 0 END AS INTEGER) AS is_overdue,
         CAST(next_service_date - {AS_OF_DATE} AS INTEGER) AS days_until_service
  FROM ({_dedupe("maint_raw", "record_id", ["service_date", "vehicle_id", "service_type", "next_service_km",
                                              "next_service_date", "cost_zar", "workshop_id", "compliant"])}))"""

SOURCES = [TELE_RAW, TELE, FUEL_RAW, FUEL, MAINT_RAW, MAINT]

# -- KPIs ---------------------------------------------------------------------
A1 = f"""
a1 AS (
  SELECT *, CAST(CASE WHEN fuel_efficiency_km_l < 7.0 THEN 1 ELSE 0 END AS INTEGER) AS fuel_efficiency_flag
  FROM (
    SELECT d.vehicle_id, d.total_distance_km, c.total_litres, c.total_fuel_cost_zar,
           {R(_div("d.total_distance_km", "c.total_litres"), 2)} AS fuel_efficiency_km_l,
           {R(_div("c.total_fuel_cost_zar", "d.total_distance_km"), 4)} AS fuel_cost_per_km
    FROM (SELECT vehicle_id, SUM(distance_km) AS total_distance_km FROM tele GROUP BY vehicle_id) d
    JOIN (SELECT vehicle_id, SUM(litres_filled) AS total_litres, SUM(cost_zar) AS total_fuel_cost_zar
          FROM fuel GROUP BY vehicle_id) c ON d.vehicle_id = c.vehicle_id))"""

A2 = f"""
a2 AS (
  SELECT *, CAST(CASE WHEN harsh_events_per_100km > 1.5 THEN 1 ELSE 0 END AS INTEGER) AS harsh_driving_flag
  FROM (
    SELECT *, {R(_div("total_harsh_events", "total_distance_km") + " * 100", 2)} AS harsh_events_per_100km
    FROM (
      SELECT vehicle_id,
             CAST(SUM(harsh_braking) AS BIGINT) AS total_harsh_braking,
             CAST(SUM(harsh_accel) AS BIGINT) AS total_harsh_accel,
             SUM(distance_km) AS total_distance_km,
             SUM(idling_minutes) AS total_idling_minutes,
             AVG(speed_kmh) AS avg_speed_kmh,
             CAST(SUM(harsh_braking) + SUM(harsh_accel) AS BIGINT) AS total_harsh_events
      FROM tele GROUP BY vehicle_id)))"""

A3 = f"""
a3 AS (
  SELECT *,
         CAST(CASE WHEN compliance_rate < 0.8 THEN 1 ELSE 0 END AS INTEGER) AS maintenance_flag,
         CAST(CASE WHEN min_days_until_service BETWEEN 0 AND 7 THEN 1 ELSE 0 END AS INTEGER) AS service_due_soon_flag
  FROM (
    SELECT vehicle_id,
           COUNT(record_id) AS total_services,
           CAST(SUM(compliant) AS BIGINT) AS compliant_services,
           MIN(days_until_service) AS min_days_until_service,
           {R(_div("SUM(compliant)", "COUNT(record_id)"), 4)} AS compliance_rate
    FROM maint GROUP BY vehicle_id))"""

A4 = f"""
a4 AS (
  SELECT *, CAST(CASE WHEN utilisation_rate < 0.85 THEN 1 ELSE 0 END AS INTEGER) AS utilisation_flag
  FROM (
    SELECT vehicle_id, active_days, {R(_div("active_days", "30"), 4)} AS utilisation_rate
    FROM (SELECT vehicle_id, COUNT(DISTINCT event_date) AS active_days FROM tele GROUP BY vehicle_id)))"""

MASTER = """
master AS (
  SELECT *,
         CASE WHEN risk_score >= 3 THEN 'HIGH' WHEN risk_score = 2 THEN 'MEDIUM'
              WHEN risk_score = 1 THEN 'LOW' ELSE 'NORMAL' END AS risk_tier
  FROM (
    SELECT a1.vehicle_id, a1.total_distance_km, a1.total_litres, a1.total_fuel_cost_zar,
           a1.fuel_efficiency_km_l, a1.fuel_cost_per_km, a1.fuel_efficiency_flag,
           a2.total_harsh_braking, a2.total_harsh_accel, a2.total_idling_minutes, a2.avg_speed_kmh,
           a2.total_harsh_events, a2.harsh_events_per_100km, a2.harsh_driving_flag,
           a3.total_services, a3.compliant_services, a3.min_days_until_service, a3.compliance_rate,
           a3.maintenance_flag, a3.service_due_soon_flag,
           a4.active_days, a4.utilisation_rate, a4.utilisation_flag,
           CAST(a1.fuel_efficiency_flag + a2.harsh_driving_flag + a3.maintenance_flag + a4.utilisation_flag
                AS INTEGER) AS risk_score
    FROM a1
    LEFT JOIN a2 ON a1.vehicle_id = a2.vehicle_id
    LEFT JOIN a3 ON a1.vehicle_id = a3.vehicle_id
    LEFT JOIN a4 ON a1.vehicle_id = a4.vehicle_id))"""

KPI = [A1, A2, A3, A4, MASTER]

SCORED = """
scored AS (
  SELECT *, CAST(RANK() OVER (ORDER BY weighted_risk_score DESC NULLS LAST) AS INTEGER) AS priority_rank
  FROM (
    SELECT *,
           CASE WHEN weighted_risk_score >= 6 THEN 'CRITICAL'
                WHEN weighted_risk_score BETWEEN 4 AND 5 THEN 'HIGH'
                WHEN weighted_risk_score BETWEEN 2 AND 3 THEN 'MEDIUM'
                ELSE 'LOW' END AS risk_category
    FROM (
      SELECT *, CAST(harsh_driving_flag * 3 + maintenance_flag * 2 + fuel_efficiency_flag * 2
                     + utilisation_flag * 1 AS INTEGER) AS weighted_risk_score
      FROM master)))"""

DAILY = """
daily AS (
  SELECT vehicle_id, event_date,
         SUM(distance_km) AS daily_distance_km,
         CAST(SUM(harsh_braking) AS BIGINT) AS daily_harsh_braking,
         CAST(SUM(harsh_accel) AS BIGINT) AS daily_harsh_accel,
         SUM(idling_minutes) AS daily_idling_minutes,
         AVG(speed_kmh) AS avg_speed_kmh,
         MAX(speed_kmh) AS max_speed_kmh,
         COUNT(event_id) AS event_count,
         CAST(SUM(harsh_braking) + SUM(harsh_accel) AS BIGINT) AS daily_harsh_events
  FROM tele GROUP BY vehicle_id, event_date)"""

DAILY_FUEL = """
daily_fuel AS (
  SELECT vehicle_id, fill_date,
         SUM(litres_filled) AS daily_litres,
         SUM(cost_zar) AS daily_fuel_cost_zar,
         COUNT(fuel_id) AS fill_count
  FROM fuel GROUP BY vehicle_id, fill_date)"""

# -- alerts -------------------------------------------------------------------
GEN = f"{AS_OF_TS} AS generated_at"
L1 = f"""
SELECT vehicle_id, fuel_efficiency_km_l, fuel_cost_per_km, total_fuel_cost_zar,
       'FUEL_EFFICIENCY' AS alert_type, 'MEDIUM' AS severity,
       'Vehicle ' || vehicle_id || ' fuel efficiency ' || CAST(fuel_efficiency_km_l AS VARCHAR)
         || ' km/L is below the 7.0 km/L threshold.' AS alert_message, {GEN}
FROM master WHERE fuel_efficiency_flag = 1"""

L2 = f"""
SELECT vehicle_id, harsh_events_per_100km, total_harsh_braking, total_harsh_accel,
       'HARSH_DRIVING' AS alert_type,
       CASE WHEN harsh_events_per_100km > 1.7 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       'Vehicle ' || vehicle_id || ' recorded ' || CAST(harsh_events_per_100km AS VARCHAR)
         || ' harsh events per 100 km — exceeds 1.5 threshold.' AS alert_message, {GEN}
FROM master WHERE harsh_driving_flag = 1"""

L3 = f"""
SELECT vehicle_id, compliance_rate, total_services, compliant_services,
       'MAINTENANCE_COMPLIANCE' AS alert_type, 'MEDIUM' AS severity,
       'Vehicle ' || vehicle_id || ' maintenance compliance at ' || CAST({R("compliance_rate * 100", 1)} AS VARCHAR)
         || '% — below the 80% threshold.' AS alert_message, {GEN}
FROM master WHERE maintenance_flag = 1"""

L4 = f"""
SELECT vehicle_id, min_days_until_service,
       'SERVICE_DUE_SOON' AS alert_type, 'HIGH' AS severity,
       'Vehicle ' || vehicle_id || ' service due in ' || CAST(min_days_until_service AS VARCHAR)
         || ' day(s). Schedule immediately.' AS alert_message, {GEN}
FROM master WHERE service_due_soon_flag = 1"""

L6 = f"""
SELECT vehicle_id, utilisation_rate, active_days,
       'LOW_UTILISATION' AS alert_type, 'LOW' AS severity,
       'Vehicle ' || vehicle_id || ' utilisation at ' || CAST({R("utilisation_rate * 100", 1)} AS VARCHAR)
         || '% — below the 85% target.' AS alert_message, {GEN}
FROM master WHERE utilisation_flag = 1"""

L7 = f"""
SELECT vehicle_id, risk_score, risk_tier,
       'HIGH_RISK_VEHICLE' AS alert_type, 'CRITICAL' AS severity,
       'CRITICAL: Vehicle ' || vehicle_id || ' has breached ' || CAST(risk_score AS VARCHAR)
         || ' KPI thresholds simultaneously. Immediate review required.' AS alert_message, {GEN}
FROM master WHERE risk_tier = 'HIGH'"""

L8 = f"""
SELECT event_id, vehicle_id, driver_id, event_timestamp, speed_kmh, latitude, longitude,
       'SPEED_VIOLATION' AS alert_type, 'HIGH' AS severity,
       'Speed violation: vehicle ' || vehicle_id || ' recorded ' || CAST(speed_kmh AS VARCHAR)
         || ' km/h at ' || CAST(event_timestamp AS VARCHAR) AS alert_message, {GEN}
FROM tele WHERE speed_kmh > 120.0"""

_COMMON = "vehicle_id, alert_type, severity, alert_message, generated_at"
ALERTS = f"""
alerts AS (
  SELECT {_COMMON},
         md5(concat_ws('|', vehicle_id, alert_type, alert_message, CAST(generated_at AS VARCHAR), event_id))
           AS alert_id,
         CAST(generated_at AS DATE) AS alert_date
  FROM (
    {" UNION ALL ".join(f"SELECT {_COMMON}, CAST(NULL AS VARCHAR) AS event_id FROM ({q})"
                         for q in (L1, L2, L3, L4, L6, L7))}
    UNION ALL SELECT {_COMMON}, event_id FROM ({L8})))"""

# -- daily-log views ------------------------------------------------------------
DL_VIEWS = """
dl_tel AS (
  SELECT d.event_date AS date, d.vehicle_id, cn.vehicle_type, cn.route,
         d.daily_distance_km AS km_driven, d.avg_speed_kmh, d.daily_idling_minutes AS idle_minutes,
         CAST(d.daily_harsh_events AS INTEGER) AS harsh_braking_events
  FROM daily d
  LEFT JOIN (SELECT CAST(c.c_custkey AS VARCHAR) AS vehicle_id, c.c_mktsegment AS vehicle_type, n.n_name AS route
             FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey) cn
    ON d.vehicle_id = cn.vehicle_id),
dl_fuel AS (
  SELECT fill_date AS date, vehicle_id, daily_litres AS litres, daily_fuel_cost_zar AS total_cost FROM daily_fuel),
dl_maint AS (
  SELECT vehicle_id, service_date AS scheduled_date, service_type AS maintenance_type, cost_zar AS cost,
         CASE WHEN compliant = 1 THEN 'Y' ELSE 'N' END AS completed
  FROM maint)"""

DL_KPIS = f"""
dl_kpis AS (
  SELECT t.vehicle_id, t.vehicle_type, t.route, t.total_km, t.active_days, t.total_idle_min, t.harsh_events,
         f.total_litres, f.total_fuel_cost, m.scheduled_jobs, m.completed_jobs, m.total_maint_cost,
         {R(_div("t.active_days", "30") + " * 100", 1)} AS utilisation_pct,
         {R(_div("t.total_km", "f.total_litres"), 2)} AS km_per_litre,
         {R(_div("f.total_fuel_cost", "t.total_km"), 3)} AS fuel_cost_per_km,
         {R(_div("t.harsh_events", "t.total_km") + " * 100", 2)} AS harsh_events_per_100km,
         {R(_div("t.total_idle_min", "t.active_days * 600.0::DOUBLE"), 3)} AS idle_ratio,
         {R(_div("m.completed_jobs", "m.scheduled_jobs") + " * 100", 1)} AS maint_compliance_pct
  FROM (SELECT vehicle_id, vehicle_type, route, SUM(km_driven) AS total_km, COUNT(DISTINCT date) AS active_days,
               SUM(idle_minutes) AS total_idle_min, CAST(SUM(harsh_braking_events) AS BIGINT) AS harsh_events
        FROM dl_tel GROUP BY vehicle_id, vehicle_type, route) t
  LEFT JOIN (SELECT vehicle_id, SUM(litres) AS total_litres, SUM(total_cost) AS total_fuel_cost
             FROM dl_fuel GROUP BY vehicle_id) f ON t.vehicle_id = f.vehicle_id
  LEFT JOIN (SELECT vehicle_id, COUNT(*) AS scheduled_jobs,
                    CAST(SUM(CASE WHEN completed = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS completed_jobs,
                    SUM(cost) AS total_maint_cost
             FROM dl_maint GROUP BY vehicle_id) m ON t.vehicle_id = m.vehicle_id)"""


def _with(ctes: list[str], body: str, doubles: list[str] = ()) -> str:
    sql = "WITH " + ",".join(ctes) + "\n" + body
    if doubles:
        repl = ", ".join(f"{R(R(c, 9), 6)} AS {c}" for c in doubles)
        sql = f"SELECT * REPLACE ({repl}) FROM ({sql}) AS q"
    return sql


_TELE_D = ["latitude", "longitude", "speed_kmh", "odometer_km", "idling_minutes", "distance_km"]
_MASTER_D = ["total_distance_km", "total_litres", "total_fuel_cost_zar", "fuel_efficiency_km_l", "fuel_cost_per_km",
             "total_idling_minutes", "avg_speed_kmh", "harsh_events_per_100km", "compliance_rate",
             "utilisation_rate"]
_DAILY_D = ["daily_distance_km", "daily_idling_minutes", "avg_speed_kmh", "max_speed_kmh"]
_DL_D = ["total_km", "total_idle_min", "total_litres", "total_fuel_cost", "total_maint_cost", "utilisation_pct",
         "km_per_litre", "fuel_cost_per_km", "harsh_events_per_100km", "idle_ratio", "maint_compliance_pct"]

S = SOURCES
M = SOURCES + KPI

# Rows of the checked ingest whose keys are made NULL, and CSV records that are made unreadable.
FAULTY = """
faulty AS (
  SELECT *, CASE WHEN event_id IS NULL OR vehicle_id IS NULL OR event_timestamp IS NULL THEN 'null key: ' || concat_ws(', ',
           CASE WHEN event_id IS NULL THEN 'event_id' END, CASE WHEN vehicle_id IS NULL THEN 'vehicle_id' END,
           CASE WHEN event_timestamp IS NULL THEN 'event_timestamp' END) END AS reason
  FROM (SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 101 = 5 THEN NULL ELSE event_id END AS event_id,
                          CASE WHEN CAST(event_id AS BIGINT) % 211 = 7 THEN NULL ELSE vehicle_id END AS vehicle_id,
                          CASE WHEN CAST(event_id AS BIGINT) % 307 = 11 THEN NULL ELSE event_timestamp END AS event_timestamp)
        FROM tele_raw)),
accepted AS (SELECT * EXCLUDE (reason) FROM faulty WHERE reason IS NULL)"""
_CSV = "(l_orderkey * 7 + l_linenumber) % 100"

ORACLE_SQL: dict[str, str] = {
    "ingest_telemetry": _with(S, "SELECT * FROM tele", _TELE_D),
    "ingest_fuel": _with(S, "SELECT * FROM fuel",
                         ["litres_filled", "cost_zar", "odometer_km", "cost_per_litre"]),
    "ingest_maintenance": _with(S, "SELECT * FROM maint", ["next_service_km", "cost_zar"]),
    "validate_join_keys": _with(S, """
        SELECT vehicle_id, 'no_fuel_records' AS issue
        FROM (SELECT vehicle_id FROM tele EXCEPT SELECT vehicle_id FROM fuel)
        UNION ALL
        SELECT vehicle_id, 'no_maintenance_records' AS issue
        FROM (SELECT vehicle_id FROM tele EXCEPT SELECT vehicle_id FROM maint)"""),
    "fuel_efficiency": _with(S + [A1], "SELECT * FROM a1",
                             ["total_distance_km", "total_litres", "total_fuel_cost_zar", "fuel_efficiency_km_l",
                              "fuel_cost_per_km"]),
    "driving_behaviour": _with(S + [A2], """
        SELECT vehicle_id, total_harsh_braking, total_harsh_accel, total_distance_km, total_idling_minutes,
               avg_speed_kmh, total_harsh_events, harsh_events_per_100km, harsh_driving_flag FROM a2""",
                               ["total_distance_km", "total_idling_minutes", "avg_speed_kmh",
                                "harsh_events_per_100km"]),
    "maintenance_compliance": _with(S + [A3], "SELECT * FROM a3", ["compliance_rate"]),
    "utilisation": _with(S + [A4], "SELECT * FROM a4", ["utilisation_rate"]),
    "master_kpi": _with(M, "SELECT * FROM master", _MASTER_D),
    "daily_telemetry": _with(S + [DAILY], "SELECT * FROM daily", _DAILY_D),
    "daily_fuel": _with(S + [DAILY_FUEL], "SELECT * FROM daily_fuel", ["daily_litres", "daily_fuel_cost_zar"]),
    "rolling_kpis": _with(S + [DAILY], f"""
        SELECT *, CAST(CASE WHEN rolling_7d_harsh_per_100km > 1.5 THEN 1 ELSE 0 END AS INTEGER)
                  AS behaviour_trend_flag
        FROM (
          SELECT *, {R(_div("rolling_7d_harsh_events", "rolling_7d_distance_km") + " * 100", 2)}
                    AS rolling_7d_harsh_per_100km
          FROM (
            SELECT d.*,
                   SUM(daily_distance_km) OVER w AS rolling_7d_distance_km,
                   CAST(SUM(daily_harsh_events) OVER w AS BIGINT) AS rolling_7d_harsh_events,
                   SUM(daily_idling_minutes) OVER w AS rolling_7d_idling_minutes
            FROM daily d
            WINDOW w AS (PARTITION BY vehicle_id ORDER BY event_date
                         RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)))""",
                          _DAILY_D + ["rolling_7d_distance_km", "rolling_7d_idling_minutes",
                                      "rolling_7d_harsh_per_100km"]),
    "vehicle_risk": _with(M + [SCORED], "SELECT * FROM scored", _MASTER_D),
    "fleet_summary": _with(M + [SCORED], f"""
        SELECT *, {R("(fleet_avg_fuel_efficiency / 7.0::DOUBLE + fleet_avg_compliance_rate"
                     " + fleet_avg_utilisation_rate) / 3 * 100", 1)} AS fleet_health_score,
               {AS_OF_TS} AS snapshot_timestamp
        FROM (
          SELECT COUNT(vehicle_id) AS total_vehicles,
                 AVG(fuel_efficiency_km_l) AS fleet_avg_fuel_efficiency,
                 AVG(harsh_events_per_100km) AS fleet_avg_harsh_events_per_100km,
                 AVG(compliance_rate) AS fleet_avg_compliance_rate,
                 AVG(utilisation_rate) AS fleet_avg_utilisation_rate,
                 CAST(SUM(fuel_efficiency_flag) AS BIGINT) AS vehicles_low_fuel_efficiency,
                 CAST(SUM(harsh_driving_flag) AS BIGINT) AS vehicles_harsh_driving,
                 CAST(SUM(maintenance_flag) AS BIGINT) AS vehicles_maintenance_noncompliant,
                 CAST(SUM(utilisation_flag) AS BIGINT) AS vehicles_underutilised,
                 CAST(SUM(CASE WHEN risk_category = 'CRITICAL' THEN 1 ELSE 0 END) AS BIGINT)
                   AS vehicles_critical_risk
          FROM scored)""",
                           ["fleet_avg_fuel_efficiency", "fleet_avg_harsh_events_per_100km",
                            "fleet_avg_compliance_rate", "fleet_avg_utilisation_rate", "fleet_health_score"]),
    "driver_ranking": _with(S, f"""
        SELECT driver_id, total_distance_km, total_harsh_events, avg_speed_kmh, total_idling_minutes,
               harsh_events_per_100km,
               CAST(RANK() OVER (ORDER BY harsh_events_per_100km ASC NULLS FIRST) AS INTEGER) AS driver_safety_rank,
               CAST(CASE WHEN harsh_events_per_100km > 1.5 THEN 1 ELSE 0 END AS INTEGER) AS driver_risk_flag
        FROM (
          SELECT *, {R(_div("total_harsh_events", "total_distance_km") + " * 100", 2)} AS harsh_events_per_100km
          FROM (
            SELECT driver_id, SUM(distance_km) AS total_distance_km,
                   CAST(SUM(harsh_braking) + SUM(harsh_accel) AS BIGINT) AS total_harsh_events,
                   AVG(speed_kmh) AS avg_speed_kmh, SUM(idling_minutes) AS total_idling_minutes
            FROM tele WHERE driver_id IS NOT NULL GROUP BY driver_id))""",
                            ["total_distance_km", "avg_speed_kmh", "total_idling_minutes",
                             "harsh_events_per_100km"]),
    "alerts_fuel": _with(M, L1, ["fuel_efficiency_km_l", "fuel_cost_per_km", "total_fuel_cost_zar"]),
    "alerts_harsh": _with(M, L2, ["harsh_events_per_100km"]),
    "alerts_maintenance": _with(M, f"SELECT * FROM ({L3}) UNION ALL BY NAME SELECT * FROM ({L4})",
                                ["compliance_rate"]),
    "alerts_utilisation": _with(M, L6, ["utilisation_rate"]),
    "alerts_high_risk": _with(M, L7),
    "alerts_speed": _with(S, L8, ["speed_kmh", "latitude", "longitude"]),
    "alert_summary": _with(M + [ALERTS], "SELECT * FROM alerts"),
    "report_performance": _with(M + [SCORED], f"""
        SELECT vehicle_id, fuel_efficiency_km_l AS fuel_eff_km_l, fuel_cost_per_km AS fuel_cost_per_km_zar,
               total_fuel_cost_zar AS total_fuel_spend_zar, harsh_events_per_100km,
               total_idling_minutes AS total_idling_min, utilisation_rate, compliance_rate, risk_score,
               risk_category, priority_rank,
               {R("utilisation_rate * 100", 1)} AS utilisation_pct,
               {R("compliance_rate * 100", 1)} AS compliance_pct
        FROM scored""",
                                ["fuel_eff_km_l", "fuel_cost_per_km_zar", "total_fuel_spend_zar",
                                 "harsh_events_per_100km", "total_idling_min", "utilisation_rate",
                                 "compliance_rate", "utilisation_pct", "compliance_pct"]),
    "report_weekly_trend": _with(S + [DAILY], f"""
        SELECT *, {R(_div("weekly_harsh_events", "weekly_distance_km") + " * 100", 2)} AS fleet_harsh_per_100km
        FROM (
          SELECT CAST(isoyear(event_date) AS INTEGER) AS year, CAST(weekofyear(event_date) AS INTEGER) AS iso_week,
                 SUM(daily_distance_km) AS weekly_distance_km,
                 CAST(SUM(daily_harsh_events) AS BIGINT) AS weekly_harsh_events,
                 SUM(daily_idling_minutes) AS weekly_idling_minutes,
                 COUNT(DISTINCT vehicle_id) AS active_vehicles
          FROM daily GROUP BY 1, 2)""",
                                 ["weekly_distance_km", "weekly_idling_minutes", "fleet_harsh_per_100km"]),
    "report_maintenance": _with(S, """
        SELECT vehicle_id, service_date, service_type, next_service_km, next_service_date, days_until_service,
               is_overdue, compliant, cost_zar AS last_service_cost_zar,
               CASE WHEN is_overdue = 1 THEN 'OVERDUE' WHEN days_until_service <= 7 THEN 'DUE_SOON'
                    ELSE 'ON_TRACK' END AS compliance_status
        FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id
                                           ORDER BY service_date DESC NULLS LAST, record_id DESC NULLS LAST) AS rn
              FROM maint)
        WHERE rn = 1""", ["next_service_km", "last_service_cost_zar"]),
    "report_cost": _with(M, f"""
        SELECT vehicle_id, total_distance_km, total_litres, total_fuel_cost_zar, fuel_efficiency_km_l,
               fuel_cost_per_km,
               CAST(RANK() OVER (ORDER BY {R(R("total_fuel_cost_zar", 9), 6)} DESC NULLS LAST) AS INTEGER) AS cost_rank
        FROM master""", ["total_distance_km", "total_litres", "total_fuel_cost_zar", "fuel_efficiency_km_l",
                         "fuel_cost_per_km"]),
    "report_alerts": _with(M + [ALERTS], """
        SELECT alert_type, severity, COUNT(alert_id) AS alert_count, COUNT(DISTINCT vehicle_id) AS vehicles_affected
        FROM alerts GROUP BY alert_type, severity"""),
    "daily_log_kpis": _with(S + [DAILY, DAILY_FUEL, DL_VIEWS, DL_KPIS], "SELECT * FROM dl_kpis", _DL_D),
    "daily_log_alerts": _with(S + [DAILY, DAILY_FUEL, DL_VIEWS, DL_KPIS], """
        SELECT vehicle_id, 'MAINTENANCE_OVERDUE' AS alert,
               'Only ' || CAST(maint_compliance_pct AS VARCHAR) || '% of scheduled jobs completed' AS detail
        FROM dl_kpis WHERE maint_compliance_pct < 80.0"""),
    "dashboard_dataset": _with(S + [DAILY, DAILY_FUEL, DL_VIEWS, DL_KPIS], """
        SELECT vehicle_id, km_per_litre, 7.0::DOUBLE AS km_per_litre_threshold, harsh_events_per_100km,
               1.5::DOUBLE AS harsh_events_threshold, maint_compliance_pct, 80.0::DOUBLE AS compliance_target_pct,
               CAST(CASE WHEN maint_compliance_pct < 80.0 THEN 1 ELSE 0 END AS INTEGER) AS compliance_below_target
        FROM dl_kpis""", ["km_per_litre", "harsh_events_per_100km", "maint_compliance_pct"]),
    # Declared thresholds as rules of their own
    "alerts_fuel_cost": _with(M, f"""
        SELECT vehicle_id, fuel_cost_per_km, total_fuel_cost_zar, total_distance_km, 'FUEL_COST' AS alert_type,
               'MEDIUM' AS severity, 'Vehicle ' || vehicle_id || ' fuel cost ' || CAST(fuel_cost_per_km AS VARCHAR)
                 || ' ZAR/km is above the 3.5 ZAR/km warning.' AS alert_message, {GEN}
        FROM master WHERE fuel_cost_per_km > 3.5""",
                              ["fuel_cost_per_km", "total_fuel_cost_zar", "total_distance_km"]),
    "alerts_idling": _with(S + [DAILY], f"""
        SELECT vehicle_id, event_date, daily_idling_minutes, 'EXCESSIVE_IDLING' AS alert_type, 'LOW' AS severity,
               'Vehicle ' || vehicle_id || ' idled ' || CAST(daily_idling_minutes AS VARCHAR) || ' minutes on '
                 || CAST(event_date AS VARCHAR) || ', above the 20.0 minute limit.' AS alert_message, {GEN}
        FROM daily WHERE daily_idling_minutes > 20.0""", ["daily_idling_minutes"]),
    # Checks of written tables
    "validate_outputs": _with(M + [ALERTS], " UNION ALL ".join(f"""
        SELECT '{t}' AS table_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS row_count,
               CAST(COALESCE(SUM(CASE WHEN {k} IS NULL THEN n ELSE 0 END), 0) AS BIGINT) AS null_keys,
               CAST(COUNT(*) FILTER (WHERE {k} IS NOT NULL AND n > 1) AS BIGINT) AS repeated_keys,
               COALESCE(SUM(n), 0) > 0 AND COALESCE(MAX(CASE WHEN {k} IS NULL OR n > 1 THEN 1 ELSE 0 END), 0) = 0 AS passed
        FROM (SELECT {k}, COUNT(*) AS n FROM {src} GROUP BY {k})"""
        for t, k, src in (("kpi_master", "vehicle_id", "master"), ("alerts", "alert_id", "alerts")))),
    # K1, K2: a table written, partitioned, and read again
    "round_trip_daily_telemetry": _with(S + [DAILY], "SELECT * FROM daily", _DAILY_D),
    # S1 behind the key check
    "checked_telemetry": _with([TELE_RAW, FAULTY, TELE.replace("FROM tele_raw", "FROM accepted")], "SELECT * FROM tele", _TELE_D),
    "telemetry_rejects": _with([TELE_RAW, FAULTY], "SELECT * FROM faulty WHERE reason IS NOT NULL", _TELE_D),
    "telemetry_counts": _with([TELE_RAW, FAULTY], """
        SELECT 'rows_read' AS metric, COUNT(*) AS n FROM faulty UNION ALL
        SELECT 'rows_rejected', COUNT(reason) FROM faulty UNION ALL SELECT 'malformed', 0 UNION ALL
        SELECT 'null_event_id', COUNT(*) FILTER (WHERE event_id IS NULL) FROM faulty UNION ALL
        SELECT 'null_vehicle_id', COUNT(*) FILTER (WHERE vehicle_id IS NULL) FROM faulty UNION ALL
        SELECT 'null_event_timestamp', COUNT(*) FILTER (WHERE event_timestamp IS NULL) FROM faulty"""),
    # Records that cannot be read
    "csv_fuel": _with([FUEL_RAW.replace("FROM lineitem", f"FROM lineitem WHERE {_CSV} NOT IN (1, 2, 3)"), FUEL], "SELECT * FROM fuel",
                      ["litres_filled", "cost_zar", "odometer_km", "cost_per_litre"]),
    "csv_fuel_rejects": f"""
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS fuel_id,
               CASE WHEN {_CSV} = 3 THEN 3 ELSE 7 END AS n_fields,
               CASE WHEN {_CSV} = 1 THEN 'not a time' ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END AS fill_text,
               'malformed record' AS reason
        FROM lineitem WHERE {_CSV} IN (1, 2, 3)""",
    "report_weekly_change": f"""
        WITH trend AS (SELECT * FROM ({{trend}})),
        w AS (SELECT a.*, b.weekly_distance_km AS d0, b.weekly_harsh_events AS h0, b.weekly_idling_minutes AS i0, b.active_vehicles AS v0,
                     b.fleet_harsh_per_100km AS r0
              FROM trend a LEFT JOIN trend b ON CAST(strptime(a.year || '-' || lpad(CAST(a.iso_week AS VARCHAR), 2, '0') || '-1', '%G-%V-%u') AS DATE)
                = CAST(strptime(b.year || '-' || lpad(CAST(b.iso_week AS VARCHAR), 2, '0') || '-1', '%G-%V-%u') AS DATE) + 7)
        SELECT year, iso_week, weekly_distance_km, weekly_harsh_events, weekly_idling_minutes, active_vehicles, fleet_harsh_per_100km,
               {R("weekly_distance_km - d0", 6)} AS distance_km_change, weekly_harsh_events - h0 AS harsh_events_change,
               {R("weekly_idling_minutes - i0", 6)} AS idling_minutes_change, active_vehicles - v0 AS active_vehicles_change,
               {R("fleet_harsh_per_100km - r0", 6)} AS harsh_per_100km_change,
               {R("(weekly_distance_km - d0) / NULLIF(d0, 0) * 100", 1)} AS distance_change_pct
        FROM w""",
}
# The same rows by another way: files, publication, several runs.
ORACLE_SQL["report_weekly_change"] = ORACLE_SQL["report_weekly_change"].replace("{trend}", ORACLE_SQL["report_weekly_trend"])
ORACLE_SQL.update({name: ORACLE_SQL[same] for name, same in {
    "csv_daily_log": "daily_log_kpis", "published_kpi_master": "vehicle_risk", "published_alerts": "alert_summary",
    "published_fleet_summary": "fleet_summary", "published_driver_ranking": "driver_ranking",
    "published_daily_telemetry": "daily_telemetry", "incremental_daily": "daily_telemetry"}.items()})
