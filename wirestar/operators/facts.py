"""The traffic fact: dimension keys looked up per hourly row, new rows kept, keyed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wirestar.functions import columns as C
from wirestar.operators.lookups import BROADCAST_BYTES, Sized, left_lookup
from wirestar.operators.numbering import number_rows
from wirestar.schemas import PACKETS_FACT, PRIVATE_ADDRESS
from wirestar.sources.staging import Staged, Staging

MEASURES = [c for c in PACKETS_FACT.names if c != "packets_key"]
MATCH_KEYS = ["date_key", "user_key", "source_ip_key", "destination_ip_key"]


def fact_staging(
    hours: Sized,
    users: Sized,
    ips: Sized,
    directions: DataFrame,
    pattern: str = PRIVATE_ADDRESS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fact rows of a batch. Users are looked up in their current row whatever the hour;
    a user without one gets a NULL key, as does a packet without an external end.

    If ``users`` and ``hours`` have a ``day``, users are looked up by name and day
    instead, in the rows that ``history.users_in_effect`` or ``users_on_days`` gives. If
    ``users`` have a ``time_hour``, as those of ``history.users_at_hours``, they are looked up
    by name and hour; a row without an hour then gets no user.
    """
    moment = next((c for c in ("day", "time_hour") if c in users.df.columns), None)
    held = users.df if moment else users.df.where("current_flag")
    at = [F.col(moment).alias("_moment")] if moment else []
    named = held.select("user_key", F.col("user_name").alias("_name"), "local_ip", *at)
    sources = ips.df.select(
        F.col("ip_key").alias("source_ip_key"), F.col("ip_address").alias("_source")
    )
    destinations = ips.df.select(
        F.col("ip_key").alias("destination_ip_key"), F.col("ip_address").alias("_destination")
    )
    user_keys = (["user_name"], ["_name"])
    if moment:
        user_keys = (["user_name", moment], ["_name", "_moment"])
    rows = hours.df
    for dim, row_keys, dim_keys in (
        (Sized(named, users.rows), *user_keys),
        (Sized(sources, ips.rows), ["source_ip"], ["_source"]),
        (Sized(destinations, ips.rows), ["destination_ip"], ["_destination"]),
    ):
        rows = left_lookup(rows, dim, row_keys, dim_keys, hours, broadcast_bytes)

    # Two constants, read once each: no join with every row. NULL if the value is missing.
    def key_of(label: str):
        return directions.where(F.col("direction") == label).select("direction_key").scalar()

    label = C.direction_label(F.col("source_ip"), F.col("local_ip"))
    return rows.select(
        "user_key",
        "source_ip_key",
        "destination_ip_key",
        C.external_key(
            F.col("source_ip"),
            F.col("destination_ip"),
            F.col("source_ip_key"),
            F.col("destination_ip_key"),
            pattern,
        ).alias("external_ip_key"),
        C.date_key(F.col("time_hour")).alias("date_key"),
        F.when(label == "inbound", key_of("inbound"))
        .otherwise(key_of("outbound"))
        .alias("direction_key"),
        F.col("bandwidth_kb_sum").alias("kb_bandwidth"),
    )


def new_facts(facts: DataFrame, staged: DataFrame, null_safe: bool = False) -> DataFrame:
    """Rows whose hour, user, source and destination the fact table does not hold yet.

    A NULL key equals nothing, so rows without a user are new in every run; ``null_safe``
    treats NULLs as equal and adds them once. Pass only the batch's days of ``facts``:
    adaptive pruning does not reach through an anti join.
    """
    old = facts.select(*(F.col(k).alias(f"_{k}") for k in MATCH_KEYS))
    same = [
        F.col(k).eqNullSafe(F.col(f"_{k}")) if null_safe else F.col(k) == F.col(f"_{k}")
        for k in MATCH_KEYS
    ]
    return staged.join(old, same, "left_anti")


def with_held_keys(held: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows``, which replace the ``held`` ones, with the ``packets_key`` of the held row that
    is the same, or else is the same but for its bandwidth; NULL if there is none.

    Sums of one hour may differ in their last digit from run to run, so bandwidth alone makes no
    new row. Rows without a user can be the same in all else; of those that no row equals, the
    largest meets the largest, so that no key is given twice. Both tables are shuffled once.
    """
    same = [c for c in MEASURES if c != "kb_bandwidth"]
    old = held.select(*MEASURES, "packets_key", F.lit(True).alias("_old"))
    new = rows.select(*MEASURES, F.lit(False).alias("_old"))
    # A group is the users unknown to the dimension who had one hour and address pair in common.
    # What follows is all within these groups, so this placing of the rows serves every step.
    both = old.unionByName(new, allowMissingColumns=True).repartition(*same)
    alike = Window.partitionBy(*MEASURES, "_old").orderBy("packets_key")
    met = (
        both.withColumn("_n", F.row_number().over(alike))
        .groupBy(*MEASURES, "_n")
        .agg(
            F.max("packets_key").alias("packets_key"),
            F.bool_or("_old").alias("_was"),
            F.bool_or(~F.col("_old")).alias("_is"),
        )
        .withColumn("_alone", F.col("_was") != F.col("_is"))
    )
    by_size = Window.partitionBy(*same, "_was", "_is").orderBy(
        F.desc_nulls_last("kb_bandwidth"), "packets_key", "_n"
    )
    beside = Window.partitionBy(*same, "_alone", "_place")
    # The held row at the same place among the rows that are left.
    left = F.max(F.when(F.col("_alone"), F.col("packets_key"))).over(beside)
    placed = met.withColumn("_place", F.row_number().over(by_size)).withColumn("_left", left)
    return placed.where("_is").select(F.coalesce("packets_key", "_left").alias("packets_key"), *MEASURES)


def key_facts(
    new: DataFrame, last_key: int | Callable[[int], int], staging: Staging, by_day: bool = False
) -> Staged:
    """Key new rows by falling bandwidth, after the last key so far. ``by_day`` keys the
    days one after the other, as loading them singly would."""
    rest = [c for c in MEASURES if c != "kb_bandwidth"]
    order = [F.desc_nulls_last("kb_bandwidth"), *(F.asc_nulls_last(c) for c in rest)]
    if by_day:
        order.insert(0, C.day_of_key(F.col("date_key")))
    keyed = number_rows(new, order, "packets_key", staging, start=last_key)
    return Staged(keyed.df.select(*PACKETS_FACT.names), keyed.rows)
