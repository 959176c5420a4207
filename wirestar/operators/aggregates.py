"""Bandwidth sums.

All of them combine on the map side, so a key that holds a third of all packets still
sends one row per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirestar.functions import columns as C
from wirestar.operators.slices import in_closed_day
from wirestar.schemas import PRIVATE_ADDRESS


def hourly(packets: DataFrame) -> DataFrame:
    """KB per hour, user, source and destination."""
    return (
        packets.groupBy(
            C.floor_hour(F.col("time_stamp")).alias("time_hour"),
            "user_name",
            "source_ip",
            "destination_ip",
        )
        .agg(F.sum("bandwidth_kb").alias("bandwidth_kb_sum"))
    )


def user_totals(packets: DataFrame) -> DataFrame:
    """KB per user, as summed."""
    return packets.groupBy("user_name").agg(F.sum("bandwidth_kb").alias("total_bandwidth_kb"))


def totals_of_day(packets: DataFrame, day: dt.date) -> DataFrame:
    """KB per user of one day's packets, truncated and stamped with the day."""
    return user_totals(packets).select(
        "user_name",
        F.lit(day.isoformat()).alias("date"),
        C.whole_kb(F.col("total_bandwidth_kb")).alias("total_bandwidth_kb"),
    )


def totals_by_day(packets: DataFrame) -> DataFrame:
    """``totals_of_day`` for every day there is, in one pass."""
    return (
        packets.where(in_closed_day(F.col("time_stamp")))
        .groupBy("user_name", F.to_date("time_stamp").alias("day"))
        .agg(F.sum("bandwidth_kb").alias("kb"))
        .select(
            "user_name",
            F.col("day").cast("string").alias("date"),
            C.whole_kb(F.col("kb")).alias("total_bandwidth_kb"),
        )
    )


def address_pairs(packets: DataFrame) -> DataFrame:
    """Packets with their addresses in direction-free order."""
    a, b = F.col("source_ip"), F.col("destination_ip")
    return packets.withColumns({"source_ip": C.pair_high(a, b), "destination_ip": C.pair_low(a, b)})


def pair_totals(packets: DataFrame) -> DataFrame:
    """KB per address pair, both directions together."""
    return (
        address_pairs(packets)
        .groupBy("source_ip", "destination_ip")
        .agg(F.sum("bandwidth_kb").alias("kb_bandwidth"))
    )


def top_pairs(packets: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` busiest pairs, with the KB of all traffic beside each. The packets are read
    once: their total is the sum of the pairs' sums."""
    pairs = pair_totals(packets)
    everything = pairs.agg(F.sum("kb_bandwidth")).scalar()  # reuses the pairs' exchange
    return (
        pairs.orderBy(F.desc("kb_bandwidth"), "source_ip", "destination_ip")
        .limit(n)
        .withColumn("total_kb_bandwidth", everything)
    )


def minute_pairs(packets: DataFrame) -> DataFrame:
    """KB per minute and address pair."""
    return (
        address_pairs(packets)
        .groupBy(C.floor_minute(F.col("time_stamp")).alias("minute"), "source_ip", "destination_ip")
        .agg(F.sum("bandwidth_kb").alias("kb_bandwidth"))
    )


def minute_totals(packets: DataFrame) -> DataFrame:
    """KB per minute of all traffic."""
    return packets.groupBy(C.floor_minute(F.col("time_stamp")).alias("minute")).agg(
        F.sum("bandwidth_kb").alias("total_kb_bandwidth")
    )


def minute_report(pairs: DataFrame) -> DataFrame:
    """Minute pairs with the KB of all traffic of their minute, as traffic files show it.

    A minute's pairs are already sums, so its total is the sum of its pairs. The totals are
    few and joined back; the sums of the pairs are shuffled once and reused."""
    totals = pairs.groupBy(F.col("minute").alias("_minute")).agg(
        F.sum("kb_bandwidth").alias("total_kb_bandwidth")
    )
    return pairs.join(totals, F.col("minute").eqNullSafe(F.col("_minute"))).drop("_minute")


def last_per_pair(packets: DataFrame, sequence: str) -> DataFrame:
    """Last value written per day and address pair, and the running total written last on that
    day. ``sequence`` is the write order, a number or time, so that the aggregates keep
    fixed-width state and hash, not sort. Packets without a running total have NULL there."""
    if "total_bandwidth_kb" not in packets.columns:
        packets = packets.withColumn("total_bandwidth_kb", F.lit(None).cast("double"))
    date = F.to_date("time_stamp")
    pairs = packets.groupBy(date.alias("date"), "source_ip", "destination_ip").agg(
        F.max_by("bandwidth_kb", sequence).alias("kb_bandwidth")
    )
    # One row per task and day: small enough to be broadcast, whatever the pairs are.
    days = packets.groupBy(date.alias("_date")).agg(
        F.max_by("total_bandwidth_kb", sequence).alias("total_kb_bandwidth")
    )
    return pairs.join(days, F.col("date").eqNullSafe(F.col("_date"))).drop("_date")


def local_addresses(hours: DataFrame, pattern: str = PRIVATE_ADDRESS) -> DataFrame:
    """Private source addresses of each user, with the last hour each was seen."""
    return (
        hours.where(C.is_private(F.col("source_ip"), pattern))
        .groupBy("user_name", F.col("source_ip").alias("local_ip"))
        .agg(F.max("time_hour").alias("start_date"))
    )


def latest_local_ip(hours: DataFrame, pattern: str = PRIVATE_ADDRESS) -> DataFrame:
    """Each user's latest private address: ``user_name, local_ip, start_date``. Among
    addresses last seen in the same hour the smallest wins."""
    # An aggregate rather than a window, as it combines before the shuffle. The negated
    # hour key sorts the latest hour first.
    latest_first = F.struct((-C.date_key(F.col("start_date"))).alias("k"), "local_ip", "start_date")
    return (
        local_addresses(hours, pattern)
        .groupBy("user_name")
        .agg(F.min(latest_first).alias("latest"))
        .select("user_name", "latest.local_ip", "latest.start_date")
    )


def latest_of_batch(addresses: DataFrame) -> DataFrame:
    """The one latest row of a batch, by user name and address among equals."""
    latest = addresses.orderBy(F.desc("start_date"), "user_name", "local_ip").limit(1)
    return latest.select("user_name", "local_ip", "start_date")


SCOPES = ("per_user", "batch_latest")


def in_scope(latest: DataFrame, scope: str) -> DataFrame:
    """The users a load may version: all of the batch, or its one latest (which suits
    the capture of a single user)."""
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}, not {scope}")
    return latest if scope == "per_user" else latest_of_batch(latest)
