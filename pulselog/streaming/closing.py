"""The push state of running entities: kept while they live, closed some time after their end."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Tasks get this module's functions by value: executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Kinds of push groups whose arrival says that the entity has ended.
ENDS = (
    "stageEnd",
    "stageMetrics",
    "executorRemoved",
    "queryEnd",
    "jobEnd",
    "taskEnd",
    "taskMetrics",
)

#: What an entity and a series are called by in samples of push groups.
ENTITY = ("job", "instance", "appid", "entity")
SERIES = ("type", "metric")

_NO_TIE = -(1 << 63)


def push_entity(group: Column) -> Column:
    """The entity of a push group's type: ``stageEnd-3-0`` and ``stageSubmitted-3-0`` are ``stage-3-0``."""
    return F.regexp_replace(group, "^([a-z]+)[A-Z][A-Za-z]*", "$1")


def push_ended(group: Column) -> Column:
    """Whether a push group's type comes with its entity's end."""
    return F.substring_index(group, "-", 1).isin(*ENDS)


def _millis(span: str) -> int:
    return int(pd.Timedelta(span).total_seconds() * 1000)


def _keeper(linger: int, idle: int):
    """The function that Spark calls with a group's rows, or when its timer has run out.

    A group is an entity or a bucket of entities. Its rows come and go as plain columns, an entity
    and a series as one JSON text each; the state is one text of all entities: the newest (time, tie,
    value) by series, end mark, last event time.
    """

    def due(kept: list) -> int:
        return kept[2] + (linger if kept[1] else idle)

    def keep(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState):
        kept = json.loads(state.get[0]) if state.exists else {}
        now = state.getCurrentWatermarkMs()
        changed: dict[str, dict] = {}
        for batch in () if state.hasTimedOut else batches:
            for entity, name, time, tie, value, ended, event in zip(*(batch[c].tolist() for c in _ROW)):
                own = kept.get(entity)
                if own is None:
                    own = kept[entity] = [{}, False, 0]
                if ended:
                    own[1] = True
                if event > own[2]:
                    own[2] = event
                news = changed.get(entity)
                if news is None:
                    news = changed[entity] = {}
                known = own[0].get(name)
                if known is None or time > known[0] or (time == known[0] and tie > known[1]):
                    own[0][name] = news[name] = (time, tie, value)
        out = [(entity, False, name, *newest) for entity, news in changed.items() for name, newest in news.items()]
        over = [e for e, own in kept.items() if e not in changed and due(own) <= now]
        out += [(entity, True, name, *newest) for entity in over for name, newest in kept.pop(entity)[0].items()]
        if kept:
            state.update((json.dumps(kept),))
            state.setTimeoutTimestamp(max(min(map(due, kept.values())), now + 1))
        else:
            state.remove()
        if out:
            yield pd.DataFrame(dict(zip(_OUT, zip(*out))))

    return keep


#: Columns of a row that comes, and of one that goes.
_ROW = ("_entity", "_series", "_time", "_tie", "_value", "_ended", "_at")
_OUT = ("_entity", "closed", "_series", "_time", "_tie", "_value")
_OUT_DDL = "_entity string, closed boolean, _series string, _time long, _tie long, _value string"


def closing_stream(
    samples: DataFrame,
    at: Column,
    ended: Column,
    entity: tuple[str, ...] = ENTITY,
    series: tuple[str, ...] = SERIES,
    time: str = "epochMillis",
    tie: str = "value",
    value: str = "value",
    *,
    delay: str,
    linger: str = "1 minute",
    idle: str = "7 days",
    buckets: int | None = None,
) -> DataFrame:
    """The latest value per series of each entity, for ``update`` mode.

    State is kept by entity, or by bucket of entities: a call of Python costs 1 to 2 ms whatever it
    gets, so many short-lived entities want ``buckets``, each of some hundred open ones. Results
    are the same. ``linger`` after its last event, once ``ended`` was true for one, an
    entity's rows come once more with ``closed`` and its state is gone; one without an end goes
    ``idle`` after its last event. Timers follow the watermark of ``at``, which is ``delay``
    behind. Columns: entity, series, value, time, ``tie_value`` and ``closed``. The newest by
    (time, tie) wins as in ``latest_samples``; a null tie is the lowest, and rows without a time
    are left out. A closed entity that sends again starts anew: its rows are newer than the closed
    ones, since older ones are behind the watermark.
    """
    kind = {c: samples.schema[c].dataType.simpleString() for c in (*entity, *series, time, value)}
    texts = lambda columns: F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))
    # The first watermark is the epoch itself and drops what is not behind it.
    event = F.greatest(at, F.timestamp_millis(F.lit(1)))
    rows = samples.where(F.col(time).isNotNull()).select(
        texts(entity).alias("_entity"),
        texts(series).alias("_series"),
        F.col(time).cast("long").alias("_time"),
        F.coalesce(F.col(tie).cast("long"), F.lit(_NO_TIE)).alias("_tie"),
        F.col(value).cast("string").alias("_value"),
        F.coalesce(ended, F.lit(False)).alias("_ended"),
        F.unix_millis(event).alias("_at"),
        event.alias("_event"),
    )
    group = F.col("_entity")
    if buckets:
        group = F.pmod(F.xxhash64(group), F.lit(buckets)).cast("string")
    rows = rows.withColumn("_key", group)
    latest = (
        rows.withWatermark("_event", delay)
        .groupBy("_key")
        .applyInPandasWithState(
            _keeper(_millis(linger), _millis(idle)),
            _OUT_DDL,
            "kept string",
            "update",
            GroupStateTimeout.EventTimeTimeout,
        )
    )
    lists = (F.from_json(c, "array<string>").alias(c) for c in ("_entity", "_series"))
    latest = latest.select(*lists, "closed", "_time", "_tie", "_value")
    listed = lambda text, columns: [
        F.col(text)[k].cast(kind[c]).alias(c) for k, c in enumerate(columns)
    ]
    return latest.select(
        *listed("_entity", entity),
        *listed("_series", series),
        F.col("_value").cast(kind[value]).alias(value),
        F.col("_time").cast(kind[time]).alias(time),
        F.nullif("_tie", F.lit(_NO_TIE)).alias("tie_value"),
        "closed",
    )
