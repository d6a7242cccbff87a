"""pulselog: Spark's own job history as DataFrames.

Listener events (event-log lines) go in; typed record tables, roll-ups,
Prometheus samples, push requests and Kafka messages come out.  Everything is
DataFrame and Structured Streaming code.
"""

from pulselog.settings import Settings

__all__ = ["Settings"]
