from starloom.streaming.alerts import read_alerts, stream_failed_runs, stream_metric, write_windows
from starloom.streaming.bronze import stream_bronze, stream_evolving, stream_files
from starloom.streaming.upsert import stream_upsert

__all__ = [
    "read_alerts",
    "stream_bronze",
    "stream_evolving",
    "stream_failed_runs",
    "stream_files",
    "stream_metric",
    "stream_upsert",
    "write_windows",
]
