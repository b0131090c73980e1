"""Starting streaming queries: sinks, triggers, recovery."""

from windrow.streaming.queries import (
    fan_out,
    latest_totals,
    start_bucketed,
    start_console,
    start_files,
    start_running_totals,
    start_top_n,
)
from windrow.streaming.stages import run_in_stages
from windrow.streaming.timers import top_n_by_timer

__all__ = [
    "fan_out",
    "latest_totals",
    "run_in_stages",
    "start_bucketed",
    "start_console",
    "start_files",
    "start_running_totals",
    "start_top_n",
    "top_n_by_timer",
]
