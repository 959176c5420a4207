"""Incremental dimension loads: existing rows and a batch in, new rows (or state) out.

Loads only insert: what a dimension already holds stays as it is. The one exception is
``users_dim``, whose rows are closed when a user's address changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wirestar.functions import columns as C
from wirestar.operators.numbering import last_key as last_key_of
from wirestar.operators.numbering import number_rows
from wirestar.schemas import DATE_DIM, DIRECTIONS, IP_DIM, USERS_DIM
from wirestar.sources.staging import Staged, Staging


def date_attributes(hours: DataFrame) -> DataFrame:
    """The batch's distinct hours with their calendar attributes."""
    distinct = hours.select("time_hour").distinct()
    return distinct.select(
        *(e.alias(name) for name, e in C.calendar(F.col("time_hour")).items())
    )


def new_dates(dates: DataFrame, hours: DataFrame) -> DataFrame:
    """Hours the date dimension does not hold yet."""
    fresh = date_attributes(hours).select(*DATE_DIM.names)
    # At most one row per hour ever seen on either side.
    return fresh.join(dates.select("date_key"), "date_key", "left_anti").select(*DATE_DIM.names)


def address_candidates(hours: DataFrame) -> DataFrame:
    """All addresses of the batch. Each column is tested for its own NULLs."""
    # One pass over the batch for both columns; distinct combines before the shuffle.
    both = hours.select(F.explode(F.array("source_ip", "destination_ip")).alias("ip_address"))
    return both.where(F.col("ip_address").isNotNull()).distinct()


def new_addresses(ips: DataFrame, hours: DataFrame) -> DataFrame:
    """Addresses the dimension does not hold yet, unkeyed."""
    return address_candidates(hours).join(ips.select("ip_address"), "ip_address", "left_anti")


def keyed_addresses(
    new: DataFrame,
    last_key: int | Callable[[int], int],
    staging: Staging,
    order_by: tuple[str, ...] = ("ip_address",),
) -> Staged:
    """Key new addresses in address order, after the last key so far."""
    numbered = number_rows(
        new,
        [F.col(c) for c in order_by],
        "ip_key",
        staging,
        start=last_key,
        dtype=IP_DIM["ip_key"].dataType,
    )
    return Staged(numbered.df.select(*IP_DIM.names), numbered.rows)


def direction_values(df: DataFrame) -> DataFrame:
    """The fixed direction values, as rows of ``df``'s session."""
    values = F.explode(F.array(*map(F.lit, DIRECTIONS)))
    return df.sparkSession.range(1).select(values.alias("direction"))


def new_directions(directions: DataFrame) -> DataFrame:
    """Direction values the dimension does not hold yet, keyed after the highest key."""
    held = directions.select("direction")
    missing = direction_values(directions).join(held, "direction", "left_anti")
    # At most two rows, so an ungrouped window is fine here.
    place = F.row_number().over(Window.orderBy("direction"))
    key = place + F.lit(last_key_of(directions, "direction_key"))
    return missing.select(key.cast("int").alias("direction_key"), "direction")


def user_changes(users: DataFrame, latest: DataFrame) -> DataFrame:
    """Users of ``latest`` who are new or whose address differs from their current row:
    ``user_name, local_ip, start_date, user_key`` with the current row's key, if any."""
    current = users.where("current_flag").select(
        "user_key", F.col("user_name").alias("_name"), F.col("local_ip").alias("_ip")
    )
    return (
        latest.join(current, F.col("user_name") == F.col("_name"), "left")
        .where(~F.col("local_ip").eqNullSafe(F.col("_ip")))
        .select("user_name", "local_ip", "start_date", "user_key")
    )


def back_dated(users: DataFrame, latest: DataFrame) -> DataFrame:
    """Users of ``latest`` whose batch ends before their current row starts. Loading such
    a batch would close the newer row with an earlier end, or key the old hours by it."""
    current = users.where("current_flag").select("user_name", F.col("start_date").alias("_since"))
    return latest.join(current, "user_name").where(F.col("start_date") < F.col("_since"))


def close_changed(users: DataFrame, changes: DataFrame) -> DataFrame:
    """``users`` with the rows that changes replace closed at the change's start."""
    closing = changes.where(F.col("user_key").isNotNull()).select(
        F.col("user_key").alias("_key"), F.col("start_date").alias("_end")
    )
    closed = F.col("_key").isNotNull()
    return users.join(closing, F.col("user_key") == F.col("_key"), "left").select(
        "user_key",
        "user_name",
        "local_ip",
        "start_date",
        F.when(closed, F.col("_end")).otherwise(F.col("end_date")).alias("end_date"),
        (F.col("current_flag") & ~closed).alias("current_flag"),
    )


def next_users(
    users: DataFrame, latest: DataFrame, last_key: int | Callable[[int], int], staging: Staging
) -> Staged:
    """State of ``users_dim`` after a batch with the ``latest`` addresses: changed rows closed, their successors and
    new users added (slowly changing dimension, type 2). Unchanged users keep their row.
    ``rows`` counts the added rows only.

    ``end_date`` is the successor's ``start_date``, which is the last hour the batch
    shows the new address in. New rows are keyed in user-name order after the last key.
    """
    changes = number_rows(
        user_changes(users, latest),
        [F.col("user_name")],
        "new_key",
        staging,
        start=last_key,
        dtype=USERS_DIM["user_key"].dataType,
    )
    added = changes.df.select(
        F.col("new_key").alias("user_key"),
        "user_name",
        "local_ip",
        "start_date",
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
        F.lit(True).alias("current_flag"),
    )
    return Staged(close_changed(users, changes.df).unionByName(added), changes.rows)
