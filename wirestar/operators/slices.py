"""Day slices of the raw packets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _instant(day: dt.date, clock: str = "00:00:00") -> Column:
    return F.lit(f"{day.isoformat()} {clock}").cast("timestamp_ntz")


def day_slice(
    packets: DataFrame,
    first: dt.date,
    last: dt.date | None = None,
    half_open: bool = False,
) -> DataFrame:
    """Packets of one day, or of the days ``first`` to ``last``.

    A day ends at 23:59:59 inclusive, so later fractions of its last second are left
    out; ``half_open`` keeps them. With a ``partition_date`` column the slice also
    prunes partitions, which the time predicate alone does not on Parquet tables.
    """
    last = last or first
    ts = F.col("time_stamp")
    if half_open:
        inside = (ts >= _instant(first)) & (ts < _instant(last + dt.timedelta(days=1)))
    else:
        inside = (ts >= _instant(first)) & (ts <= _instant(last, "23:59:59"))
        if last != first:
            inside = inside & in_closed_day(ts)
    if "partition_date" in packets.columns:
        packets = packets.where(F.col("partition_date").between(F.lit(first), F.lit(last)))
    return packets.where(inside)


def in_closed_day(ts: Column) -> Column:
    """False in the fractions after 23:59:59 that a closed day slice leaves out."""
    # Rows outside the last minute of a day are decided by the cheap parts.
    seconds = F.date_part(F.lit("SECOND"), ts)
    return (F.hour(ts) < 23) | (F.minute(ts) < 59) | (seconds <= 59)
