from vehicle_metrics.operators.alerts import (
    build_alert_summary,
    generate_fuel_alerts,
    generate_harsh_driving_alerts,
    generate_high_risk_alerts,
    generate_maintenance_alerts,
    generate_speed_alerts,
    generate_utilisation_alerts,
    kpi_alerts_one_pass,
)
from vehicle_metrics.operators.daily import (
    aggregate_daily_fuel,
    aggregate_daily_telemetry,
    compute_rolling_kpis,
    daily_telemetry_parts,
)
from vehicle_metrics.operators.daily_log import dashboard_dataset, daily_log_alerts, daily_log_vehicle_kpis
from vehicle_metrics.operators.kpi import (
    build_master_kpi,
    compute_driving_behaviour,
    compute_fuel_efficiency,
    compute_maintenance_compliance,
    compute_utilisation,
)
from vehicle_metrics.operators.ranking import global_rank
from vehicle_metrics.operators.reports import (
    build_alert_report,
    build_cost_report,
    build_fleet_trend_report,
    build_maintenance_report,
    build_performance_report,
)
from vehicle_metrics.operators.risk import build_fleet_summary, rank_drivers_by_behaviour, score_vehicle_risk

__all__ = [
    "aggregate_daily_fuel", "aggregate_daily_telemetry", "build_alert_report", "build_alert_summary",
    "build_cost_report", "build_fleet_summary", "build_fleet_trend_report", "build_maintenance_report",
    "build_master_kpi", "build_performance_report", "compute_driving_behaviour", "compute_fuel_efficiency",
    "compute_maintenance_compliance", "compute_rolling_kpis", "compute_utilisation", "daily_log_alerts",
    "daily_log_vehicle_kpis", "daily_telemetry_parts", "dashboard_dataset", "generate_fuel_alerts",
    "generate_harsh_driving_alerts", "generate_high_risk_alerts", "generate_maintenance_alerts",
    "generate_speed_alerts", "generate_utilisation_alerts", "global_rank", "kpi_alerts_one_pass",
    "rank_drivers_by_behaviour", "score_vehicle_risk",
]
