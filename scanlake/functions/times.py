"""UTC wall-clock time columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: str | datetime) -> Column:
    """A literal time; ``now`` is always an argument so that reruns agree."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def minutes_before(time: Column, minutes: int) -> Column:
    return time - F.make_dt_interval(mins=F.lit(minutes))


def micros_between(start: Column, end: Column) -> Column:
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint")


def iso_utc(time: Column) -> Column:
    """ISO-8601 with offset; the fraction is left out when it is zero."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(time, "SSSSSS")
    return F.concat(whole, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""),
                    F.lit("+00:00"))
