"""The day load: raw packets of a day into the star schema, dimensions before the fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirestar.functions import columns as C
from wirestar.operators import aggregates, checks, dimensions, facts, history
from wirestar.operators.lookups import Sized
from wirestar.operators.slices import day_slice
from wirestar.schemas import DIRECTIONS, PACKETS_FACT, PRIVATE_ADDRESS
from wirestar.sources.staging import Staging
from wirestar.sources.tables import Warehouse


class BackDatedBatch(ValueError):
    """The batch is older than the current row of at least one of its users."""


def run_day(
    spark: SparkSession,
    packets: DataFrame,
    warehouse: Warehouse,
    day: dt.date,
    last_day: dt.date | None = None,
    *,
    half_open: bool = False,
    scope: str = "per_user",
    null_safe: bool = False,
    allow_back_dated: bool = False,
    private: str = PRIVATE_ADDRESS,
) -> dict[str, int]:
    """Load one day of packets, or ``day`` to ``last_day`` as one batch, and return the
    rows added per table.

    ``scope``, ``null_safe`` and ``half_open`` are those of ``aggregates.in_scope``,
    ``facts.new_facts`` and ``day_slice``. A batch older than a user's current row is refused
    unless ``allow_back_dated``. The loads only add what is missing, so a run that
    failed half way is completed by running it again. Loads of different days may run side by
    side: they take turns for the dimensions, and load their facts at once.

    ``replace_days`` loads batches in any order instead, see that function.
    """
    warehouse.create()
    with Staging(spark) as staging:
        sliced = day_slice(packets, day, last_day, half_open)
        # Five loads read the hourly sums: computed once, and far smaller than the packets.
        hours = staging.write(aggregates.hourly(sliced), "hourly")
        latest = staging.write(aggregates.latest_local_ip(hours.df, private), "latest-ips").df
        daily = history.daily_local_ips(hours.df, scope, private)
        with warehouse.lease("dimensions"):  # what one load adds, the next one finds
            if not allow_back_dated:
                _refuse_back_dated(dimensions.back_dated(warehouse.current_users(), latest), day)
            added = _together(
                date_dim=lambda: _load_dates(warehouse, hours.df, day, last_day or day),
                ip_dim=lambda: _load_addresses(
                    warehouse, dimensions.new_addresses(warehouse.read("ip_dim"), hours.df), staging
                ),
                users_dim=lambda: _load_users(warehouse, aggregates.in_scope(latest, scope), staging),
                direction_dim=lambda: _load_directions(warehouse),
                user_days=lambda: warehouse.see_users(daily),
            )
            users = Sized(warehouse.current_users(), warehouse.last_key("users_dim"))
        added["packets_fact"] = _load_facts(
            warehouse,
            Sized(hours.df, hours.rows),
            users,
            staging,
            day,
            last_day or day,
            null_safe,
            private,
        )
        return added


def replace_days(
    spark: SparkSession,
    packets: DataFrame,
    warehouse: Warehouse,
    day: dt.date,
    last_day: dt.date | None = None,
    *,
    half_open: bool = False,
    scope: str = "per_user",
    at_hour: bool = False,
    private: str = PRIVATE_ADDRESS,
) -> dict[str, int]:
    """Load ``day`` to ``last_day``, or load them again, in place of the facts they have: the
    result is that of the right order, whatever is loaded before and after. Returns the rows
    added per table, of the fact those with new keys.

    Users' versions are spliced between the stored ones. Facts get the version that their user
    had at the end of their day, as loads in order find it, or ``at_hour`` the version of their
    hour. A fact that differs from a held one by nothing but its bandwidth keeps its key, held
    ones that are not among the new are gone, and days that stay the same are not written.

    A version that is spliced in splits or lengthens others: loaded days after it still have
    the keys they were loaded with, until they are replaced too.
    """
    last = last_day or day
    warehouse.create()
    with Staging(spark) as staging:
        sliced = day_slice(packets, day, last, half_open)
        hours = staging.write(aggregates.hourly(sliced), "hourly")
        daily = staging.write(history.daily_local_ips(hours.df, scope, private), "daily-ips").df
        with warehouse.lease("dimensions"):
            warehouse.see_users(daily)
            versions = None

            def load_users() -> int:
                nonlocal versions
                versions, added = _splice_users(warehouse, hours.df, staging)
                return added

            added = _together(
                date_dim=lambda: _load_dates(warehouse, hours.df, day, last),
                ip_dim=lambda: _load_addresses(
                    warehouse, dimensions.new_addresses(warehouse.read("ip_dim"), hours.df), staging
                ),
                users_dim=load_users,
                direction_dim=lambda: _load_directions(warehouse),
            )
        if at_hour:
            found, rows = history.users_at_hours(versions, hours.df), hours.df
        else:
            found, rows = history.users_on_days(versions, hours.df), history.with_day(hours.df)
        in_effect = staging.write(found, "users-in-effect")
        users = Sized(in_effect.df, in_effect.rows)
        added["packets_fact"] = _replace_facts(
            warehouse, Sized(rows, hours.rows), users, staging, day, last, private
        )
        return added


def _splice_users(
    warehouse: Warehouse, hours: DataFrame, staging: Staging
) -> tuple[DataFrame, int]:
    """All versions of the users of the hours, and how many of them are new."""
    version, keys = warehouse.users_version(), warehouse.claims("users_dim")
    stored = warehouse.read("users_dim")
    named = hours.select("user_name").distinct()
    held = stored.join(named, "user_name", "left_semi")
    seen = warehouse.users_seen().join(named, "user_name", "left_semi")
    spliced = history.splice_versions(held, seen, keys, staging)
    versions = staging.write(spliced.df, "versions")
    state = versions.df.drop("since")
    if not _unlike(state, held).isEmpty():
        others = stored.join(named, "user_name", "left_anti")
        warehouse.replace_users(others.unionByName(state), version, whole=True)
    return versions.df, spliced.rows


def _replace_facts(
    warehouse: Warehouse,
    hours: Sized,
    users: Sized,
    staging: Staging,
    first: dt.date,
    last: dt.date,
    private: str,
) -> int:
    ips = Sized(warehouse.read("ip_dim"), warehouse.last_key("ip_dim"))
    again = facts.fact_staging(hours, users, ips, warehouse.read("direction_dim"), private)
    held = warehouse.facts_between(_day_number(first), _day_number(last)).select(*PACKETS_FACT.names)
    rows = staging.write(facts.with_held_keys(held, again), "replaced").df
    fresh = rows.where("packets_key IS NULL").drop("packets_key")
    added = facts.key_facts(fresh, warehouse.claims("packets_fact"), staging)
    now = rows.where("packets_key IS NOT NULL").unionByName(added.df)
    day = C.day_of_key(F.col("date_key")).alias("day")
    unlike = _unlike(now, held)
    changed = sorted(r[0] for r in unlike.select(day).distinct().collect())  # days of the batch
    if changed:
        warehouse.replace_facts(now.where(C.day_of_key(F.col("date_key")).isin(changed)), changed)
    return added.rows


def _unlike(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one of the tables has more often than the other."""
    columns = a.columns
    one, other = a.withColumn("_n", F.lit(1)), b.select(*columns, F.lit(-1).alias("_n"))
    counted = one.unionByName(other).groupBy(*columns).agg(F.sum("_n").alias("_n"))
    return counted.where("_n <> 0").drop("_n")


def _together(**loads: Callable[[], int | None]) -> dict[str, int]:
    """Run the dimension loads side by side: none reads what another writes, and each
    alone leaves most of a cluster idle. If one fails, the others finish, then it raises.
    Loads that return nothing are not counted."""
    with ThreadPoolExecutor(len(loads)) as pool:
        running = {table: pool.submit(load) for table, load in loads.items()}
    done = {table: load.result() for table, load in running.items()}
    return {table: rows for table, rows in done.items() if rows is not None}


def _load_dates(warehouse: Warehouse, hours: DataFrame, first: dt.date, last: dt.date) -> int:
    held = warehouse.read("date_dim").where(F.col("date").between(F.lit(first), F.lit(last)))
    # At most 24 rows a day: one file. Only finished hours are moved, not each task's.
    return warehouse.append("date_dim", dimensions.new_dates(held, hours).repartition(1))


def _load_addresses(
    warehouse: Warehouse,
    unkeyed: DataFrame,
    staging: Staging,
    order_by: tuple[str, ...] = ("ip_address",),
) -> int:
    new = dimensions.keyed_addresses(unkeyed, warehouse.claims("ip_dim"), staging, order_by)
    if new.rows:
        warehouse.append("ip_dim", new.df)
    return new.rows


def _load_users(warehouse: Warehouse, latest: DataFrame, staging: Staging) -> int:
    version = warehouse.users_version()
    keys = warehouse.claims("users_dim")
    state = dimensions.next_users(warehouse.current_users(), latest, keys, staging)
    if state.rows:  # every change adds a row, so without one the state is the same
        warehouse.replace_users(state.df, version)
    return state.rows


def _load_directions(warehouse: Warehouse) -> int:
    held = warehouse.read("direction_dim")
    if held.count() == len(DIRECTIONS):
        return 0
    new = dimensions.new_directions(held).collect()  # at most two
    warehouse.append("direction_dim", warehouse.spark.createDataFrame(new, held.schema).coalesce(1))
    return len(new)


def _load_facts(
    warehouse: Warehouse,
    hours: Sized,
    users: Sized,
    staging: Staging,
    first: dt.date,
    last: dt.date,
    null_safe: bool,
    private: str,
    by_day: bool = False,
) -> int:
    ips = warehouse.read("ip_dim")
    directions = warehouse.read("direction_dim")
    # The highest key is at least the number of addresses.
    sized = Sized(ips, warehouse.last_key("ip_dim"))
    rows = facts.fact_staging(hours, users, sized, directions, private)
    held = warehouse.facts_between(_day_number(first), _day_number(last))
    new = facts.new_facts(held, rows, null_safe)
    keyed = facts.key_facts(new, warehouse.claims("packets_fact"), staging, by_day)
    if keyed.rows:
        warehouse.append("packets_fact", keyed.df, several_days=first != last)
    return keyed.rows


def run_history(
    spark: SparkSession,
    packets: DataFrame,
    warehouse: Warehouse,
    first: dt.date,
    last: dt.date,
    *,
    half_open: bool = False,
    scope: str = "per_user",
    null_safe: bool = False,
    allow_back_dated: bool = False,
    private: str = PRIVATE_ADDRESS,
) -> dict[str, int]:
    """Load the days ``first`` to ``last`` with the result of ``run_day`` for each in
    order, keys included, in as many Spark jobs as one day takes. Days that hold no rows
    are skipped. Arguments are those of ``run_day``."""
    warehouse.create()
    with Staging(spark) as staging:
        sliced = day_slice(packets, first, last, half_open)
        hours = staging.write(aggregates.hourly(sliced), "hourly")
        with warehouse.lease("dimensions"):
            version, held_users = warehouse.users_version(), warehouse.current_users()
            daily = staging.write(history.daily_local_ips(hours.df, scope, private), "daily-ips").df
            if not allow_back_dated:
                everyone = daily
                if scope != "per_user":
                    everyone = history.daily_local_ips(hours.df, "per_user", private)
                _refuse_back_dated(dimensions.back_dated(held_users, everyone), first)

            def load_users() -> int:
                nonlocal in_effect
                changes = history.keyed_changes(
                    history.daily_changes(held_users, daily), warehouse.claims("users_dim"), staging
                )
                in_effect = staging.write(
                    history.users_in_effect(held_users, changes.df, hours.df), "users-in-effect"
                )
                if changes.rows:
                    state = history.users_after_history(held_users, changes.df)
                    warehouse.replace_users(state, version)
                return changes.rows

            in_effect = None
            added = _together(
                date_dim=lambda: _load_dates(warehouse, hours.df, first, last),
                ip_dim=lambda: _load_addresses(
                    warehouse,
                    history.new_addresses_by_day(warehouse.read("ip_dim"), hours.df),
                    staging,
                    ("day", "ip_address"),
                ),
                users_dim=load_users,
                direction_dim=lambda: _load_directions(warehouse),
                user_days=lambda: warehouse.see_users(daily),
            )
        added["packets_fact"] = _load_facts(
            warehouse,
            Sized(history.with_day(hours.df), hours.rows),
            Sized(in_effect.df, in_effect.rows),
            staging,
            first,
            last,
            null_safe,
            private,
            by_day=True,
        )
        return added


def _refuse_back_dated(late: DataFrame, day: dt.date) -> None:
    if not late.isEmpty():
        raise BackDatedBatch(f"{day}: older than the current row of some users")


def _day_number(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def violations(
    warehouse: Warehouse, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Rule violations of the star schema; none after a load. With days, of the fact only
    their partitions are checked, as after a load of these days, and of the others only
    whether they have one of their keys."""
    rows = others = None
    if first is not None:
        days = _day_number(first), _day_number(last or first)
        rows = warehouse.facts_between(*days)
        others = warehouse.read("packets_fact").where(~F.col("date_day").between(*days))
    return checks.check_star_schema(warehouse.tables(), rows, others)


def counts(warehouse: Warehouse) -> DataFrame:
    """Row count per table, from the footers of the stored files."""
    return checks.table_counts(warehouse.parts())
