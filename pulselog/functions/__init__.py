"""Column functions: built-in expressions only, no Python UDF."""

from pulselog.functions.lines import app_id_from_path, event_name
from pulselog.functions.names import (
    or_default,
    sanitize_label_name,
    sanitize_metric_name,
)
from pulselog.functions.order import epoch_micros, epoch_millis, order_key

__all__ = [
    "app_id_from_path",
    "epoch_micros",
    "epoch_millis",
    "event_name",
    "or_default",
    "order_key",
    "sanitize_label_name",
    "sanitize_metric_name",
]
