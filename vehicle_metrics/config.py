"""Thresholds and weights used by the KPI, risk and alert operators.

Operators take a ``Thresholds`` instance, so a deployment can override
a value without editing code; the defaults reproduce the reference fleet
rules.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference rules for identical results).
#   fuel efficiency minimum            7.0 km/L   (flag below)
#   fuel cost per km warning           3.50 ZAR   (declared, optional rule)
#   harsh events per 100 km maximum    1.5        (flag above)
#   harsh-driving HIGH severity cut    3.0 per 100 km
#   speed limit                        120.0 km/h
#   daily idling maximum               60.0 min   (declared, optional rule)
#   maintenance compliance minimum     0.80
#   service due soon window            0..7 days
#   utilisation minimum                0.60
#   risk tier cuts                     HIGH >= 3, MEDIUM = 2, LOW = 1, else NORMAL
#   weighted risk weights              harsh 3, maintenance 2, fuel 2, utilisation 1
#   weighted category cuts             CRITICAL >= 6, HIGH 4-5, MEDIUM 2-3, else LOW
#   observation window                 30 days
#   valid speed range                  0..200 km/h
#   daily-log shift length             600 min per day (idle ratio divisor)
#   daily-log compliance minimum       80 %
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    fuel_efficiency_min_km_l: float = 7.0
    fuel_cost_per_km_warning_zar: float = 3.50
    harsh_events_per_100km_max: float = 1.5
    harsh_severity_high_per_100km: float = 3.0
    speed_limit_kmh: float = 120.0
    idling_minutes_daily_max: float = 60.0
    maintenance_compliance_min: float = 0.80
    service_due_soon_days: int = 7
    utilisation_min_rate: float = 0.60
    risk_tier_high: int = 3
    risk_tier_medium: int = 2
    risk_tier_low: int = 1
    observation_days: int = 30
    speed_valid_min_kmh: float = 0.0
    speed_valid_max_kmh: float = 200.0
    rolling_window_days: int = 7
    daily_log_shift_minutes: float = 600.0
    daily_log_compliance_min_pct: float = 80.0


@dataclass(frozen=True)
class RiskWeights:
    harsh_driving: int = 3
    maintenance: int = 2
    fuel_efficiency: int = 2
    utilisation: int = 1
    critical_min: int = 6
    high_min: int = 4
    medium_min: int = 2


DEFAULT_THRESHOLDS = Thresholds()
DEFAULT_WEIGHTS = RiskWeights()
