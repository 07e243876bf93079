from .growing import follow_growing_metrics, growing_lines_stream
from .logs import follow_rolled_metrics, rolled_metrics_stream

__all__ = [
    "follow_growing_metrics",
    "follow_rolled_metrics",
    "growing_lines_stream",
    "rolled_metrics_stream",
]
