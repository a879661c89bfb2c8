from vehicle_metrics.streaming.rollup import compact, merge_batch, start_rollup_stream, stored_rollup
from vehicle_metrics.streaming.telemetry import (
    read_telemetry_stream,
    start_speed_alert_stream,
    stream_clean_telemetry,
    stream_daily_rollup,
    stream_speed_alerts,
)

__all__ = [
    "compact", "merge_batch", "read_telemetry_stream", "start_rollup_stream", "start_speed_alert_stream", "stored_rollup",
    "stream_clean_telemetry", "stream_daily_rollup", "stream_speed_alerts",
]
