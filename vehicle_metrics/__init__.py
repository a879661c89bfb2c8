"""vehicle_metrics: Spark-native fleet telematics analytics.

Every operator is a DataFrame -> DataFrame transformation built from
built-in Spark SQL functions, so Catalyst can prune, push down and plan
the shuffles. Thresholds and the as-of date are explicit arguments.

Modules: ``sources`` (readers, cleaning, sinks), ``operators`` (KPIs,
rollups, risk, alerts, reports, daily-log), ``plans`` (composed daily
batch, query registry, spark-submit job), ``streaming``.
"""

from vehicle_metrics.config import DEFAULT_THRESHOLDS, DEFAULT_WEIGHTS, RiskWeights, Thresholds

__all__ = ["DEFAULT_THRESHOLDS", "DEFAULT_WEIGHTS", "RiskWeights", "Thresholds"]
