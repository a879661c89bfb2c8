"""Hand-made rows for unit tests, chosen from the rules: values on both sides
of each limit, with the expected results worked out by hand beside them."""

import datetime as dt

from vehicle_metrics.schemas import FUEL_SCHEMA, MAINTENANCE_SCHEMA, TELEMETRY_SCHEMA

D = dt.date
T = dt.datetime


def telemetry_rows(spark, rows):
    """rows: dicts with any subset of telemetry columns (others NULL);
    event_date / event_hour are derived like ingest does."""
    from vehicle_metrics.sources.ingest import clean_telemetry

    cols = [f.name for f in TELEMETRY_SCHEMA.fields]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return clean_telemetry(spark.createDataFrame(data, TELEMETRY_SCHEMA))


def fuel_rows(spark, rows):
    from vehicle_metrics.sources.ingest import clean_fuel

    cols = [f.name for f in FUEL_SCHEMA.fields]
    return clean_fuel(spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], FUEL_SCHEMA))


def maintenance_rows(spark, rows, as_of="2024-06-01"):
    from vehicle_metrics.sources.ingest import clean_maintenance

    cols = [f.name for f in MAINTENANCE_SCHEMA.fields]
    return clean_maintenance(
        spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], MAINTENANCE_SCHEMA), as_of)


def base_telemetry(spark):
    """Two vehicles. KA: three events on two days, 160 km, 1 + 3 = 4 harsh
    events (2.5 per 100 km, above 1.5). KB: four events on three days, 400 km,
    6 harsh events (1.5 per 100 km, on the limit and so not above it)."""
    def event(key, vehicle, at, speed, km, braking, accel, idle):
        return dict(event_id=key, vehicle_id=vehicle, driver_id=f"P-{vehicle}", event_timestamp=at, speed_kmh=speed,
                    distance_km=km, harsh_braking=braking, harsh_accel=accel, idling_minutes=idle)

    return telemetry_rows(spark, [
        event("a1", "KA", T(2024, 5, 13, 6, 15), 40.0, 64.0, 0, 2, 4.0),
        event("a2", "KA", T(2024, 5, 13, 23, 59), 70.0, 16.0, 1, 0, 0.5),
        event("a3", "KA", T(2024, 5, 14), 100.0, 80.0, 0, 1, 7.5),
        event("b1", "KB", T(2024, 5, 13, 12), 0.0, 100.0, 2, 0, 1.0),
        event("b2", "KB", T(2024, 5, 20, 5), 120.0, 100.0, 1, 1, 1.0),
        event("b3", "KB", T(2024, 5, 20, 6), 60.0, 100.0, 2, 0, 1.0),
        event("b4", "KB", T(2024, 5, 29, 7), 60.0, 100.0, 0, 0, 1.0),
    ])


def base_fuel(spark):
    """KA: 16 L in two fills for 400 (10 km/L, 2.5 a km). KB: 64 L for 1400
    (6.25 km/L, below 7; 3.5 a km)."""
    return fuel_rows(spark, [
        dict(fuel_id="fa1", vehicle_id="KA", fill_timestamp=T(2024, 5, 13, 5), litres_filled=12.0, cost_zar=300.0),
        dict(fuel_id="fa2", vehicle_id="KA", fill_timestamp=T(2024, 5, 15), litres_filled=4.0, cost_zar=100.0),
        dict(fuel_id="fb1", vehicle_id="KB", fill_timestamp=T(2024, 5, 21), litres_filled=64.0, cost_zar=1400.0),
    ])


def base_maintenance(spark):
    """As of 2024-06-01. KA: 4 of 5 services on time (0.8, on the limit), next
    one in 8 days (not due soon). KB: 1 of 2 on time (0.5), due in 7 days."""
    ka = [dict(record_id=f"sa{i}", vehicle_id="KA", service_date=D(2024, i, 2), next_service_date=D(2024, 6, 8 + i),
               cost_zar=100.0 * i, compliant=int(i != 3)) for i in range(1, 6)]
    kb = [dict(record_id=f"sb{i}", vehicle_id="KB", service_date=D(2024, 4, i), next_service_date=D(2024, 6, 6 + 2 * i - 1),
               cost_zar=50.0, compliant=i - 1) for i in (1, 2)]
    return maintenance_rows(spark, ka + kb)


def by_key(df, key="vehicle_id"):
    return {r[key]: r for r in df.collect()}


__all__ = ["D", "T", "telemetry_rows", "fuel_rows", "maintenance_rows", "base_telemetry", "base_fuel",
           "base_maintenance", "by_key"]


def plain_rank(df, order_col, rank_col, ascending=True):
    """Single-partition RANK(), to compare with."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    o = F.col(order_col).asc() if ascending else F.col(order_col).desc()
    return df.withColumn(rank_col, F.rank().over(Window.orderBy(o)))
