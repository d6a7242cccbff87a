"""What can be read off a raw event-log line or its path without parsing JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_APP_ID = "noAppId"


def event_name(line: Column) -> Column:
    """The `Event` of a line that is whole JSON; null for any other line, whatever its layout."""
    return F.from_json(line, "Event string").getField("Event")


def event_hint(line: Column) -> Column:
    """What the `Event` of a line is if the line is whole: for filters before the parse only.

    Spark writes the event name first, so it sits between the third and fourth
    quote and a filter on it costs a look at the first bytes of a line.  Lines of
    another layout go through a JSON path.
    """
    leading = F.substring_index(F.substring_index(line, '"', 4), '"', -1)
    return F.when(line.startswith('{"Event":"'), leading).otherwise(
        F.get_json_object(line, "$.Event")
    )


def app_id_from_path(path: Column) -> Column:
    """Application id of an event-log file.

    Known layouts: rolling directories (``eventlog_v2_<id>/events_1_<id>``),
    archives partitioned by application (``appId=<id>/part-…``) and single files
    named after the application.  A YARN id loses its attempt suffix.
    """
    file = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    single = F.regexp_replace(file, r"(\.(inprogress|zstd|zst|lz4|lzf|snappy|gz|json))+$", "")
    name = (
        F.when(folder.startswith("eventlog_v2_"), F.substring_index(folder, "eventlog_v2_", -1))
        .when(folder.startswith("appId="), F.url_decode(F.substring_index(folder, "appId=", -1)))
        .otherwise(single)
    )
    yarn = F.when(name.startswith("application_"), F.substring_index(name, "_", 3)).otherwise(name)
    return F.when(F.length(yarn) > 0, yarn).otherwise(NO_APP_ID)
