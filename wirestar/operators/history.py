"""Many days in one pass, with the result of loading them one after the other.

A backfill of a thousand days as a thousand day loads is a thousand times the fixed cost
of a load. What a day's load depends on is only which user row and which addresses the
days before it left behind, and that is a window over at most one row per user and day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wirestar.functions import columns as C
from wirestar.operators.as_of import as_of
from wirestar.operators.dimensions import close_changed
from wirestar.operators.numbering import number_rows
from wirestar.schemas import PRIVATE_ADDRESS, USERS_DIM
from wirestar.sources.staging import Staged, Staging


def with_day(hours: DataFrame) -> DataFrame:
    return hours.withColumn("day", F.to_date("time_hour"))


def daily_local_ips(
    hours: DataFrame, scope: str = "per_user", pattern: str = PRIVATE_ADDRESS
) -> DataFrame:
    """``aggregates.latest_local_ip`` of every day: ``day, user_name, local_ip, start_date``,
    and in ``first_seen`` the day's first hour with that address."""
    seen = (
        with_day(hours)
        .where(C.is_private(F.col("source_ip"), pattern))
        .groupBy("day", "user_name", F.col("source_ip").alias("local_ip"))
        .agg(F.max("time_hour").alias("start_date"), F.min("time_hour").alias("first_seen"))
    )
    keys = ["day"] if scope == "batch_latest" else ["day", "user_name"]
    late_first = (-C.date_key(F.col("start_date"))).alias("late_first")
    columns = ["user_name", "local_ip", "start_date", "first_seen"]
    best = F.min(F.struct(late_first, *columns)).alias("best")
    return seen.groupBy(*keys).agg(best).select("day", *(f"best.{c}" for c in columns))


def daily_changes(users: DataFrame, daily: DataFrame) -> DataFrame:
    """Days on which a user is new or has another address than on the user's day before:
    ``day, user_name, local_ip, start_date, first_seen``, and in ``user_key`` the stored row
    that the user's first change closes."""
    current = users.where("current_flag").select(
        "user_key", F.col("user_name").alias("_name"), F.col("local_ip").alias("_ip")
    )
    # At most one row per day in a user's window.
    by_day = Window.partitionBy("user_name").orderBy("day")
    changed = (
        daily.join(current, F.col("user_name") == F.col("_name"), "left")
        .withColumn("_before", F.coalesce(F.lag("local_ip").over(by_day), F.col("_ip")))
        .where(~F.col("local_ip").eqNullSafe(F.col("_before")))
    )
    first = F.row_number().over(by_day) == 1
    return changed.withColumn("user_key", F.when(first, F.col("user_key"))).select(
        "day", "user_name", "local_ip", "start_date", "first_seen", "user_key"
    )


def keyed_changes(changes: DataFrame, last_key: int | Callable[[int], int], staging: Staging) -> Staged:
    """Changes with the ``new_key`` of the row each opens, by day and user name."""
    return number_rows(
        changes,
        [F.col("day"), F.col("user_name")],
        "new_key",
        staging,
        start=last_key,
        dtype=USERS_DIM["user_key"].dataType,
    )


def users_after_history(users: DataFrame, changes: DataFrame) -> DataFrame:
    """State of ``users_dim`` after all days: each change closes the row before it."""
    by_day = Window.partitionBy("user_name").orderBy("day")
    until = F.lead("start_date").over(by_day)
    opened = changes.select(
        F.col("new_key").alias("user_key"),
        "user_name",
        "local_ip",
        "start_date",
        until.alias("end_date"),
        until.isNull().alias("current_flag"),
    )
    return close_changed(users, changes).unionByName(opened)


def users_in_effect(users: DataFrame, changes: DataFrame, hours: DataFrame) -> DataFrame:
    """The user row each day's load would find: ``user_name, day, user_key, local_ip`` for
    every user and day of the hours."""
    current = users.where("current_flag").select(
        F.col("user_name").alias("_name"),
        F.col("user_key").alias("_key"),
        F.col("local_ip").alias("_ip"),
    )
    opened = changes.select("user_name", "day", "new_key", "local_ip")
    so_far = (
        Window.partitionBy("user_name")
        .orderBy("day")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        with_day(hours)
        .select("user_name", "day")
        .distinct()
        .join(opened, ["user_name", "day"], "left")
        .select(
            "user_name",
            "day",
            F.last("new_key", ignorenulls=True).over(so_far).alias("new_key"),
            F.last("local_ip", ignorenulls=True).over(so_far).alias("local_ip"),
        )
        .join(current, F.col("user_name") == F.col("_name"), "left")
        .select(
            "user_name",
            "day",
            F.coalesce("new_key", "_key").alias("user_key"),
            F.coalesce("local_ip", "_ip").alias("local_ip"),
        )
    )


def user_runs(observations: DataFrame) -> DataFrame:
    """All versions of the users of ``observations``, whatever order they came in:
    ``user_name, run, user_key, local_ip, start_date, end_date, current_flag, since``.

    An observation (``user_name, local_ip, start_date, first_seen, user_key``) is what one load
    saw of a user, or a stored version with its key. In order of ``start_date``, neighbours of
    one address are one version, which begins where the first does and ends where the next
    version begins; so an observation between two splits, links or lengthens its neighbours.
    A version keeps the earliest stored key that is in it and has NULL if there is none.
    ``since`` is the first hour that shows the address, NULL for a user's first version.
    """
    once = observations.groupBy("user_name", "start_date", "local_ip").agg(
        F.min("first_seen").alias("first_seen"), F.min("user_key").alias("user_key")
    )
    # At most one row per load, and stored version, in a user's windows.
    in_order = Window.partitionBy("user_name").orderBy(
        "start_date", F.asc_nulls_last("user_key"), "local_ip"
    )
    opens = (F.row_number().over(in_order) == 1) | ~F.col("local_ip").eqNullSafe(
        F.lag("local_ip").over(in_order)
    )
    marked = once.withColumn("_opens", opens.cast("int"))
    runs = (
        marked.withColumn("run", F.sum("_opens").over(in_order))
        .groupBy("user_name", "run")
        .agg(
            F.min("local_ip").alias("local_ip"),
            F.min("start_date").alias("start_date"),
            F.min_by("first_seen", "start_date").alias("_seen"),
            F.min_by("user_key", F.when(F.col("user_key").isNotNull(), F.col("start_date"))).alias(
                "user_key"
            ),
        )
    )
    by_run = Window.partitionBy("user_name").orderBy("run")
    until, before = F.lead("start_date").over(by_run), F.lag("start_date").over(by_run)
    # Hours of late packets may lie before the version that was seen first.
    seen = F.when(F.col("_seen") > before, F.col("_seen")).otherwise(F.col("start_date"))
    return runs.select(
        "user_name",
        "run",
        "user_key",
        "local_ip",
        "start_date",
        until.alias("end_date"),
        until.isNull().alias("current_flag"),
        F.when(F.col("run") > 1, seen).alias("since"),
    )


def splice_versions(
    versions: DataFrame,
    observations: DataFrame,
    last_key: int | Callable[[int], int],
    staging: Staging,
) -> Staged:
    """``user_runs`` of stored ``versions`` and all ``observations`` of their users, with new
    keys, by user name and time, for versions that no stored row is part of; ``rows`` counts
    these. Loads in any order give the versions of the right order."""
    held = versions.select(
        "user_name", "local_ip", "start_date", F.col("start_date").alias("first_seen"), "user_key"
    )
    key_type = USERS_DIM["user_key"].dataType
    seen = observations.select(
        "user_name", "local_ip", "start_date", "first_seen", F.lit(None).cast(key_type).alias("user_key")
    )
    runs = staging.write(user_runs(held.unionByName(seen)), "user-runs").df
    added = number_rows(
        runs.where(F.col("user_key").isNull()).drop("user_key"),
        [F.col("user_name"), F.col("run")],
        "user_key",
        staging,
        start=last_key,
        dtype=key_type,
    )
    state = runs.where(F.col("user_key").isNotNull()).unionByName(added.df)
    return Staged(state.select(*USERS_DIM.names, "since"), added.rows)


def users_at_hours(versions: DataFrame, hours: DataFrame) -> DataFrame:
    """The version that each user had in each of the hours: ``user_name, time_hour, user_key,
    local_ip``. ``versions`` have a ``since``, the first hour with the address."""
    moments = hours.select("user_name", "time_hour").distinct()
    return as_of(moments, versions, "user_name", "time_hour", "since", ["user_key", "local_ip"])


def users_on_days(versions: DataFrame, hours: DataFrame) -> DataFrame:
    """The version that each user had at the end of each day of the hours, as loads in order
    find it: ``user_name, day, user_key, local_ip``."""
    days = with_day(hours).select("user_name", "day").distinct()
    last_hour = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(23))
    moments = days.select("user_name", last_hour.alias("last_hour"))
    takes = ["user_key", "local_ip"]
    found = as_of(moments, versions, "user_name", "last_hour", "start_date", takes)
    return found.select("user_name", F.to_date("last_hour").alias("day"), *takes)


def versions_seen(changes: DataFrame) -> DataFrame:
    """Versions that ``keyed_changes`` open, with their ``since``, see ``user_runs``."""
    first = F.row_number().over(Window.partitionBy("user_name").orderBy("day")) == 1
    return changes.select(
        "user_name",
        F.col("new_key").alias("user_key"),
        "local_ip",
        F.when(~first, F.col("first_seen")).alias("since"),
    )


def new_addresses_by_day(ips: DataFrame, hours: DataFrame) -> DataFrame:
    """Addresses the dimension does not hold yet, with the day each appears first."""
    both = F.explode(F.array("source_ip", "destination_ip")).alias("ip_address")
    seen = with_day(hours).select("day", both).where(F.col("ip_address").isNotNull())
    first = seen.groupBy("ip_address").agg(F.min("day").alias("day"))
    return first.join(ips.select("ip_address"), "ip_address", "left_anti")
