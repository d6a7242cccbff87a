"""Sources: event logs (batch, stream, lines at hand) and text."""

from pulselog.sources.event_log import parse_events, read_event_stream, read_events
from pulselog.sources.tail import tail_lines
from pulselog.sources.text import read_lines

__all__ = ["parse_events", "read_event_stream", "read_events", "read_lines", "tail_lines"]
