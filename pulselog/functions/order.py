"""Time values and orderings that keep aggregation hash-based."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(time: Column, zoneless: bool = True) -> Column:
    """Epoch microseconds; a zone-less timestamp is read as UTC, whatever the session zone."""
    if not zoneless:
        return F.unix_micros(time)
    days = F.unix_date(time.cast("date")).cast("bigint")
    seconds = days * 86_400 + F.hour(time) * 3_600 + F.minute(time) * 60
    micros = (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("bigint")
    return seconds * 1_000_000 + micros


def epoch_millis(time: Column, zoneless: bool = True) -> Column:
    """Epoch milliseconds, rounded down."""
    return F.floor(epoch_micros(time, zoneless) / F.lit(1000)).cast("bigint")


def order_key(time: Column, tie: Column) -> Column:
    """One sortable number for the pair (time, tie), both bigint; a null tie is the lowest.

    ``max_by`` over a struct falls back to sort aggregation, because a struct has
    no fixed width in the aggregation buffer.  A decimal has: time * 2^65 + tie
    keeps the order of the pair exactly and fits 38 digits for |time| < 2·10^18.
    """
    scaled = time.cast("decimal(19,0)") * F.expr("36893488147419103232BD")
    below_all = F.expr("-9223372036854775809BD").cast("decimal(19,0)")
    return (scaled + F.coalesce(tie.cast("decimal(19,0)"), below_all)).cast("decimal(38,0)")
