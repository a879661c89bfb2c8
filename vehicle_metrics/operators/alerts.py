"""Rule-based alerts from the master KPI table (L1-L7) and from single
telemetry events (L8), and the consolidated alert table (L9).

Every rule is data: (alert_type, condition, severity, message). The
per-rule operators filter and project evidence columns; the consolidated
table evaluates all KPI rules in ONE pass over the KPI table
(``explode`` of the matching rule structs) instead of re-reading it once
per rule, then appends the event-level speed alerts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.config import DEFAULT_THRESHOLDS, Thresholds
from vehicle_metrics.functions.exprs import SEVERITY_LEVEL_SQL, sql_double, sql_str, timestamp_sql

# Alert types and message fragments.
#   FUEL_EFFICIENCY         "Vehicle {id} fuel efficiency {km/L} km/L is below the {min} km/L threshold."
#   HARSH_DRIVING           "Vehicle {id} recorded {per100} harsh events per 100 km — exceeds {max} threshold."
#   MAINTENANCE_COMPLIANCE  "Vehicle {id} maintenance compliance at {pct}% — below the {min%}% threshold."
#   SERVICE_DUE_SOON        "Vehicle {id} service due in {days} day(s). Schedule immediately."
#   LOW_UTILISATION         "Vehicle {id} utilisation at {pct}% — below the {min%}% target."
#   HIGH_RISK_VEHICLE       "CRITICAL: Vehicle {id} has breached {score} KPI thresholds simultaneously.
#                            Immediate review required."
#   SPEED_VIOLATION         "Speed violation: vehicle {id} recorded {speed} km/h at {timestamp}"

ALERT_COLUMNS = ["vehicle_id", "alert_type", "severity", "alert_message", "generated_at"]
SUMMARY_COLUMNS = [*ALERT_COLUMNS, "alert_id", "alert_date"]


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _num(v: float) -> str:
    """Threshold as printed in a message: 7.0 -> '7.0', 1.5 -> '1.5'."""
    return str(float(v))


def _pct_num(rate: float) -> str:
    """Rate threshold as a whole percent when it is one: 0.8 -> '80'."""
    p = round(rate * 100, 6)
    return str(int(p)) if p == int(p) else str(p)


def _concat(*parts: str) -> str:
    """concat(...) of SQL parts; plain text parts are given as ('text',)."""
    return "concat(" + ", ".join(sql_str(p[0]) if isinstance(p, tuple) else p for p in parts) + ")"


@dataclass(frozen=True)
class Rule:
    """An alert rule as SQL expression text over the KPI table."""
    alert_type: str
    condition: str
    severity: str
    message: str
    evidence: tuple[str, ...]


def kpi_rules(th: Thresholds = DEFAULT_THRESHOLDS) -> list[Rule]:
    return [
        Rule("FUEL_EFFICIENCY", "fuel_efficiency_flag = 1", "'MEDIUM'",
             _concat(("Vehicle ",), "vehicle_id", (" fuel efficiency ",), _s("fuel_efficiency_km_l"),
                     (f" km/L is below the {_num(th.fuel_efficiency_min_km_l)} km/L threshold.",)),
             ("vehicle_id", "fuel_efficiency_km_l", "fuel_cost_per_km", "total_fuel_cost_zar")),
        Rule("HARSH_DRIVING", "harsh_driving_flag = 1",
             f"CASE WHEN harsh_events_per_100km > {sql_double(th.harsh_severity_high_per_100km)} "
             "THEN 'HIGH' ELSE 'MEDIUM' END",
             _concat(("Vehicle ",), "vehicle_id", (" recorded ",), _s("harsh_events_per_100km"),
                     (f" harsh events per 100 km — exceeds {_num(th.harsh_events_per_100km_max)} threshold.",)),
             ("vehicle_id", "harsh_events_per_100km", "total_harsh_braking", "total_harsh_accel")),
        Rule("MAINTENANCE_COMPLIANCE", "maintenance_flag = 1", "'MEDIUM'",
             _concat(("Vehicle ",), "vehicle_id", (" maintenance compliance at ",),
                     _s("round(compliance_rate * 100, 1)"),
                     (f"% — below the {_pct_num(th.maintenance_compliance_min)}% threshold.",)),
             ("vehicle_id", "compliance_rate", "total_services", "compliant_services")),
        Rule("SERVICE_DUE_SOON", "service_due_soon_flag = 1", "'HIGH'",
             _concat(("Vehicle ",), "vehicle_id", (" service due in ",), _s("min_days_until_service"),
                     (" day(s). Schedule immediately.",)),
             ("vehicle_id", "min_days_until_service")),
        Rule("LOW_UTILISATION", "utilisation_flag = 1", "'LOW'",
             _concat(("Vehicle ",), "vehicle_id", (" utilisation at ",), _s("round(utilisation_rate * 100, 1)"),
                     (f"% — below the {_pct_num(th.utilisation_min_rate)}% target.",)),
             ("vehicle_id", "utilisation_rate", "active_days")),
        Rule("HIGH_RISK_VEHICLE", "risk_tier = 'HIGH'", "'CRITICAL'",
             _concat(("CRITICAL: Vehicle ",), "vehicle_id", (" has breached ",), _s("risk_score"),
                     (" KPI thresholds simultaneously. Immediate review required.",)),
             ("vehicle_id", "risk_score", "risk_tier")),
    ]


def _rule_by_type(th: Thresholds, alert_type: str) -> Rule:
    return next(r for r in kpi_rules(th) if r.alert_type == alert_type)


def apply_rule(kpi_df: DataFrame, rule: Rule, as_of_ts=None) -> DataFrame:
    """Filter -> evidence columns -> alert_type, severity, message, generated_at."""
    return kpi_df.where(rule.condition).selectExpr(
        *rule.evidence,
        f"{sql_str(rule.alert_type)} AS alert_type",
        f"{rule.severity} AS severity",
        f"{rule.message} AS alert_message",
        f"{timestamp_sql(as_of_ts)} AS generated_at",
    )


def generate_fuel_alerts(kpi_df, as_of_ts=None, thresholds: Thresholds = DEFAULT_THRESHOLDS):
    """L1"""
    return apply_rule(kpi_df, _rule_by_type(thresholds, "FUEL_EFFICIENCY"), as_of_ts)


def generate_harsh_driving_alerts(kpi_df, as_of_ts=None, thresholds: Thresholds = DEFAULT_THRESHOLDS):
    """L2"""
    return apply_rule(kpi_df, _rule_by_type(thresholds, "HARSH_DRIVING"), as_of_ts)


def _matches_sql(rules: list[Rule], evidence: list[str], types: dict) -> str:
    """array of the matching rules' structs (NULL for a rule that does not
    hold, removed by array_compact)."""
    def as_struct(r: Rule) -> str:
        fields = [f"{sql_str(c)}, " + (c if c in r.evidence else f"CAST(NULL AS {types[c]})") for c in evidence]
        fields += [f"'alert_type', {sql_str(r.alert_type)}", f"'severity', {r.severity}",
                   f"'alert_message', {r.message}"]
        return "named_struct(" + ", ".join(fields) + ")"

    return "array_compact(array(" + ", ".join(f"CASE WHEN {r.condition} THEN {as_struct(r)} END"
                                             for r in rules) + "))"


def apply_rules(kpi_df: DataFrame, rules: list[Rule], as_of_ts=None) -> DataFrame:
    """Several rules in one pass, shaped like their union by name: the
    evidence columns of all rules (first rule's first), NULL where a rule
    has no such column, then the alert columns."""
    evidence: list[str] = []
    for r in rules:
        evidence += [c for c in r.evidence if c not in evidence]
    types = {f.name: f.dataType.simpleString() for f in kpi_df.schema.fields}
    first = rules[0].evidence
    order = [*first, "alert_type", "severity", "alert_message", "generated_at",
             *[c for c in evidence if c not in first]]
    return (
        kpi_df
        .selectExpr(f"explode({_matches_sql(rules, evidence, types)}) AS _a")
        .selectExpr("_a.*", f"{timestamp_sql(as_of_ts)} AS generated_at")
        .select(*order)
    )


def generate_maintenance_alerts(kpi_df, as_of_ts=None, thresholds: Thresholds = DEFAULT_THRESHOLDS):
    """L3 + L4 + L5: compliance and due-soon alerts, shaped as their union
    by name (columns missing on one side are NULL), computed in one pass
    over the KPI table."""
    rules = [_rule_by_type(thresholds, "MAINTENANCE_COMPLIANCE"), _rule_by_type(thresholds, "SERVICE_DUE_SOON")]
    return apply_rules(kpi_df, rules, as_of_ts)


def generate_utilisation_alerts(kpi_df, as_of_ts=None, thresholds: Thresholds = DEFAULT_THRESHOLDS):
    """L6"""
    return apply_rule(kpi_df, _rule_by_type(thresholds, "LOW_UTILISATION"), as_of_ts)


def generate_high_risk_alerts(kpi_df, as_of_ts=None, thresholds: Thresholds = DEFAULT_THRESHOLDS):
    """L7"""
    return apply_rule(kpi_df, _rule_by_type(thresholds, "HIGH_RISK_VEHICLE"), as_of_ts)


def generate_speed_alerts(telemetry_df: DataFrame, speed_limit_kmh: float | None = None, as_of_ts=None,
                          thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """One alert per event above the speed limit. Stateless (filter +
    project), so it runs unchanged on a streaming DataFrame; the filter is
    pushed into the Parquet scan. event_id is kept so alert ids stay
    unique when two events share a message."""
    limit = thresholds.speed_limit_kmh if speed_limit_kmh is None else speed_limit_kmh
    message = _concat(("Speed violation: vehicle ",), "vehicle_id", (" recorded ",), _s("speed_kmh"),
                      (" km/h at ",), _s("event_timestamp"))
    return telemetry_df.where(f"speed_kmh > {sql_double(limit)}").selectExpr(
        "event_id", "vehicle_id", "driver_id", "event_timestamp", "speed_kmh", "latitude", "longitude",
        "'SPEED_VIOLATION' AS alert_type", "'HIGH' AS severity", f"{message} AS alert_message",
        f"{timestamp_sql(as_of_ts)} AS generated_at",
    )


def generate_fuel_cost_alerts(kpi_df: DataFrame, as_of_ts=None,
                              thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Fuel cost per km above the warning threshold. Not part of the
    consolidated alerts; call it where the rule is wanted."""
    limit = thresholds.fuel_cost_per_km_warning_zar
    return apply_rule(kpi_df, Rule(
        "FUEL_COST", f"fuel_cost_per_km > {sql_double(limit)}", "'MEDIUM'",
        _concat(("Vehicle ",), "vehicle_id", (" fuel cost ",), _s("fuel_cost_per_km"),
                (f" ZAR/km is above the {_num(limit)} ZAR/km warning.",)),
        ("vehicle_id", "fuel_cost_per_km", "total_fuel_cost_zar", "total_distance_km")), as_of_ts)


def generate_idling_alerts(daily_df: DataFrame, as_of_ts=None,
                           thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Vehicle days (R1) that idled longer than the daily maximum. Not
    part of the consolidated alerts; call it where the rule is wanted."""
    limit = thresholds.idling_minutes_daily_max
    return apply_rule(daily_df, Rule(
        "EXCESSIVE_IDLING", f"daily_idling_minutes > {sql_double(limit)}", "'LOW'",
        _concat(("Vehicle ",), "vehicle_id", (" idled ",), _s("daily_idling_minutes"), (" minutes on ",),
                _s("event_date"), (f", above the {_num(limit)} minute limit.",)),
        ("vehicle_id", "event_date", "daily_idling_minutes")), as_of_ts)


def kpi_alerts_one_pass(kpi_df: DataFrame, as_of_ts=None, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """All KPI rules in a single narrow pass: each vehicle row yields the
    array of rule structs whose condition holds; NULL conditions drop out
    with ``array_compact``; ``explode`` emits one alert per match."""
    rules = kpi_rules(thresholds)
    return (
        kpi_df
        .selectExpr("vehicle_id", f"explode({_matches_sql(rules, [], {})}) AS _a")
        .selectExpr("vehicle_id", "_a.alert_type", "_a.severity", "_a.alert_message",
                    f"{timestamp_sql(as_of_ts)} AS generated_at")
    )


def alert_id_sql(*cols: str) -> str:
    """Deterministic id: md5 over the identifying fields (NULLs skipped), so
    a recomputed partition yields the same ids."""
    return "md5(concat_ws('|', " + ", ".join(_s(c) for c in cols) + "))"


def alert_id(*cols) -> Column:
    return F.expr(alert_id_sql(*cols))


ALERT_ID_FIELDS = ("vehicle_id", "alert_type", "alert_message", "generated_at", "event_id")


def build_alert_summary(kpi_df: DataFrame, telemetry_df: DataFrame, as_of_ts=None,
                        thresholds: Thresholds = DEFAULT_THRESHOLDS, sort: bool = True) -> DataFrame:
    """Every KPI and speed alert with alert_id and alert_date, ordered
    by severity (CRITICAL, HIGH, MEDIUM, rest), then type, vehicle and id."""
    kpi = kpi_alerts_one_pass(kpi_df, as_of_ts, thresholds).selectExpr(
        *ALERT_COLUMNS, "CAST(NULL AS STRING) AS event_id")
    speed = generate_speed_alerts(telemetry_df, None, as_of_ts, thresholds).select(*ALERT_COLUMNS, "event_id")
    alerts = kpi.unionByName(speed).selectExpr(
        *ALERT_COLUMNS, f"{alert_id_sql(*ALERT_ID_FIELDS)} AS alert_id", "to_date(generated_at) AS alert_date")
    if sort:
        alerts = alerts.orderBy(F.expr(SEVERITY_LEVEL_SQL), "alert_type", "vehicle_id", "alert_id")
    return alerts
