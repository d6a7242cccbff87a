"""Last value per series: overall (push group state) and per scrape tick."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, TimestampNTZType

from pulselog.functions.order import epoch_micros, order_key

PUSH_GROUP = ("job", "instance", "type", "appid", "metric")


def _whole(samples: DataFrame, tie: str) -> None:
    kind = samples.schema[tie].dataType
    if not isinstance(kind, IntegralType):
        raise ValueError(f"the tie-break {tie} must be a whole number, not {kind.simpleString()}")


def _newest(value: str, time: Column, tie: str) -> Column:
    return F.max_by(value, order_key(time, F.col(tie)))


def latest_samples(
    samples: DataFrame,
    keys: tuple[str, ...] = PUSH_GROUP,
    time: str = "epochMillis",
    tie: str = "value",
    value: str = "value",
) -> DataFrame:
    """Per key the value of the newest sample, with its ``time`` (bigint) and tie-break.

    ``tie`` (bigint) decides between samples of the same time; without an order
    among them the largest value wins, so the result never depends on partitions.
    A null tie is lower than any; samples without a time are left out.  Value, time
    and tie come from the same sample.  A tie that is no whole number is refused.
    Partial aggregation leaves one row per key and task before the shuffle.
    """
    _whole(samples, tie)
    tied = tie != value
    return samples.where(F.col(time).isNotNull()).groupBy(*keys).agg(
        _newest(value, F.col(time), tie).alias(value),
        F.max(time).alias(time),
        *([F.max_by(tie, order_key(F.col(time), F.col(tie))).alias(tie)] if tied else []),
    )


def scrape_samples(
    samples: DataFrame,
    keys: tuple[str, ...],
    time: str = "ts",
    tie: str = "seq",
    value: str = "value",
    every: str = "500 milliseconds",
) -> DataFrame:
    """What a scrape every ``every`` sees: per key and tick the last value pushed before it.

    ``tick`` (window start and end) is kept so that a stream with a watermark can
    drop its state.  Ticks without a push yield no row; carrying values forward
    would create ticks × series rows.
    """
    _whole(samples, tie)
    zoneless = isinstance(samples.schema[time].dataType, TimestampNTZType)
    micros = epoch_micros(F.col(time), zoneless)
    return samples.groupBy(*keys, F.window(time, every).alias("tick")).agg(
        _newest(value, micros, tie).alias(value)
    )


def value_intervals(
    samples: DataFrame,
    keys: tuple[str, ...],
    time: str = "ts",
    tie: str = "seq",
    value: str = "value",
    every: str = "500 milliseconds",
    span_micros: int = 86_400_000_000,
) -> DataFrame:
    """What scrapes see between pushes too: per key one row for each change of the value.

    Scrapes from ``first_tick`` on see ``value``, up to the one at ``last_tick``; the newest value of
    a key has none. That is what ticks × series rows would say, in as many rows as there are
    changes. Nulls are values. Neighbours are found within spans of ``span_micros``, and spans
    meet by one row each, so a series with very many ticks spreads over tasks.
    """
    ticks = scrape_samples(samples, keys, time, tie, value, every)
    end = F.col("tick.end")
    zoneless = isinstance(samples.schema[time].dataType, TimestampNTZType)
    span = F.floor(epoch_micros(end, zoneless) / F.lit(span_micros))
    rows = ticks.select(*keys, F.col(value).alias("_seen"), end.alias("_tick"), span.alias("_span"))
    inside = Window.partitionBy(*keys, "_span").orderBy("_tick")
    along = Window.partitionBy(*keys).orderBy("_span")

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        same = [left[c].eqNullSafe(right[c]) for c in (*keys, "_span")]
        found = left.join(right, reduce(Column.__and__, same), "left")
        return found.select(left["*"], *[right[c] for c in right.columns if c not in (*keys, "_span")])

    lasts = rows.groupBy(*keys, "_span").agg(F.max_by("_seen", "_tick").alias("_last"))
    earlier = F.lag("_last").over(along).alias("_earlier"), F.lag(F.lit(True)).over(along).alias("_any")
    lasts = lasts.select(*keys, "_span", *earlier)
    # Whether there is a value before is told apart from its being null.
    beginning = F.lag(F.lit(True)).over(inside).isNull()
    known = F.when(beginning, F.col("_earlier")).otherwise(F.lag("_seen").over(inside))
    anew = ~known.eqNullSafe(F.col("_seen")) | (beginning & F.col("_any").isNull())
    changes = beside(rows, lasts).withColumn("_anew", anew).where("_anew")
    firsts = changes.groupBy(*keys, "_span").agg(F.min("_tick").alias("_first"))
    after = along.rowsBetween(1, Window.unboundedFollowing)
    firsts = firsts.select(*keys, "_span", F.min("_first").over(after).alias("_later"))
    following = F.coalesce(F.lead("_tick").over(inside), F.col("_later"))
    last = following - F.expr(f"INTERVAL {every}")
    return beside(changes, firsts).select(
        *keys, F.col("_seen").alias(value), F.col("_tick").alias("first_tick"), last.alias("last_tick")
    )
