"""Scalar expressions of the packet model.

Timestamps are zone-less (``timestamp_ntz``) throughout. The helpers below use only
functions that treat them as such, so results do not depend on the session time
zone: ``date_trunc`` and ``date_format`` would convert through it and move hours
that fall into a daylight-saving gap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wirestar.schemas import PRIVATE_ADDRESS


def floor_hour(ts: Column) -> Column:
    """Start of the hour, NULL for a NULL time. Plain arithmetic on zone-less fields; a
    tumbling window would silently drop rows without a time."""
    zero = F.lit(0)
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(zero, F.hour(ts), zero)


def floor_minute(ts: Column) -> Column:
    """Start of the minute, see ``floor_hour``."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.hour(ts), F.minute(ts)
    )


def minute_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm``."""
    return F.substring(ts.cast("string"), 1, 16)


def date_key(ts: Column) -> Column:
    """Hour key ``yyyyMMddHH`` as INT, by arithmetic rather than by text."""
    day = F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)
    return (day * 100 + F.hour(ts)).cast("int")


def day_of_key(key: Column) -> Column:
    """Day ``yyyyMMdd`` of an hour key: the fact table's physical partition."""
    return F.floor(key / 100).cast("int")


def calendar(hour: Column) -> dict[str, Column]:
    """Date dimension attributes of an hour. Week is the ISO week, year the calendar year."""
    return {
        "date_key": date_key(hour),
        "date": F.to_date(hour),
        "year": F.year(hour).cast("smallint"),
        "quarter": F.quarter(hour).cast("smallint"),
        "month": F.month(hour).cast("smallint"),
        "week": F.weekofyear(hour).cast("smallint"),
        "day": F.dayofmonth(hour).cast("smallint"),
        "hour": F.hour(hour).cast("smallint"),
        "is_weekend": F.weekday(hour).isin(5, 6),
    }


def is_private(ip: Column, pattern: str = PRIVATE_ADDRESS) -> Column:
    return ip.like(pattern)


def external_key(
    source_ip: Column,
    destination_ip: Column,
    source_key: Column,
    destination_key: Column,
    pattern: str = PRIVATE_ADDRESS,
) -> Column:
    """Key of the external end: the source if public, else the destination if public, else NULL."""
    return F.when(~is_private(source_ip, pattern), source_key).when(
        ~is_private(destination_ip, pattern), destination_key
    )


def direction_label(source_ip: Column, local_ip: Column) -> Column:
    """``inbound`` if the source is the user's own address. A label by convention only:
    capture orders each address pair by text, so it does not tell who sent the traffic."""
    return F.when(source_ip == local_ip, F.lit("inbound")).otherwise(F.lit("outbound"))


def pair_high(a: Column, b: Column) -> Column:
    """First address of the direction-free pair: the one greater as text."""
    return F.greatest(a, b)


def pair_low(a: Column, b: Column) -> Column:
    return F.least(a, b)


# KB per unit as printed in conversation reports.
KB_PER_UNIT = {"bytes": 1 / 1024, "kB": 1.0, "MB": 1024.0, "GB": 1048576.0}


def to_kb(amount: Column, unit: Column, only_bytes: bool = False) -> Column:
    """Amount in KB. ``only_bytes`` treats every unit but ``bytes`` as KB."""
    units = {"bytes": KB_PER_UNIT["bytes"]} if only_bytes else KB_PER_UNIT
    factor = None
    for name, kb in units.items():
        factor = (F if factor is None else factor).when(unit == name, F.lit(kb))
    return amount * factor.otherwise(F.lit(1.0))


def known_unit(unit: Column) -> Column:
    return unit.isin(*KB_PER_UNIT)


def packet_id(user: Column, ts: Column, number: Column) -> Column:
    """``user-yyyy-MM-dd HH:mm-number``; NULL if any part is (``concat_ws`` would skip it)."""
    return F.concat(user, F.lit("-"), minute_text(ts), F.lit("-"), number.cast("string"))


def whole_kb(kb: Column) -> Column:
    """Truncated toward zero, exact."""
    return kb.cast("bigint").cast("decimal(38,0)")


def day_in_name(path: Column) -> Column:
    """The last ``yyyy-MM-dd`` in a traffic file's own name; NULL without one, whatever the
    folders above are called."""
    return F.regexp_extract(path, r".*(\d{4}-\d{2}-\d{2})[^/]*$", 1).try_cast("date")
