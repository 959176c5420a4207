"""Registered queries: each reads the whole packet feed and returns one DataFrame.

Incremental loads need something already loaded. They take the dimension or fact as the
packets before ``SPLIT`` would leave it, and load the whole feed (or the rest of it) on
top. ``oracle.py`` holds the same queries as DuckDB SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wirestar.functions import columns as C
from wirestar.operators import aggregates, checks, dimensions, facts, history, packet_ids
from wirestar.operators.lookups import Sized
from wirestar.operators.slices import day_slice as slice_days
from wirestar.plans import warehouse_load
from wirestar.schemas import DAILY_AGGREGATE, DATE_DIM, DIRECTION_DIM, IP_DIM, PACKETS_FACT, USERS_DIM, empty
from wirestar.sources import reports, traffic_files
from wirestar.sources.event_feed import EVENTS, packets_from_events, read_events, read_packets
from wirestar.sources.item_store import put_in_store, read_store
from wirestar.sources.staging import Staged, Staging
from wirestar.sources.tables import Warehouse, raw_packets
from wirestar.sources.tables import daily_aggregate as daily_table
from wirestar.streaming import capture
from wirestar.streaming.held_back import AdmissionLog, read_held_back
from wirestar.streaming.minute_state import MinuteTables, run_until_idle, write_minute_state

SLICE_DAY = dt.date(2024, 1, 4)
SPLIT = dt.datetime(2024, 1, 16)

Query = Callable[[SparkSession, str], DataFrame]


def _at(moment: dt.datetime):
    return F.lit(moment).cast("timestamp_ntz")


class _Loads:
    """The load of a query up to some table, each part staged once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.staging = Staging(spark)
        self.hours = self.staging.write(aggregates.hourly(read_packets(spark, sf_dir)), "hourly")
        self.before = self.hours.df.where(F.col("time_hour") < _at(SPLIT))
        self.after = self.hours.df.where(F.col("time_hour") >= _at(SPLIT))
        self.directions = dimensions.new_directions(empty(spark, DIRECTION_DIM))

    def addresses(self, hours: DataFrame, held: Staged | None = None) -> Staged:
        held = held or Staged(empty(self.spark, IP_DIM), 0)
        new = dimensions.new_addresses(held.df, hours)
        return dimensions.keyed_addresses(new, held.rows, self.staging)

    def all_addresses(self) -> Staged:
        """The address dimension after both loads."""
        first = self.addresses(self.before)
        second = self.addresses(self.after, first)
        return Staged(first.df.unionByName(second.df), first.rows + second.rows)

    def latest(self, hours: DataFrame, scope: str) -> DataFrame:
        return aggregates.in_scope(aggregates.latest_local_ip(hours), scope)

    def users_before(self, scope: str = "per_user") -> Staged:
        held = empty(self.spark, USERS_DIM)
        return dimensions.next_users(held, self.latest(self.before, scope), 0, self.staging)

    def users_after(self, first: Staged, scope: str = "per_user") -> Staged:
        latest = self.latest(self.after, scope)
        second = dimensions.next_users(first.df, latest, first.rows, self.staging)
        return Staged(second.df, first.rows + second.rows)

    def both_users(self, scope: str = "per_user") -> Staged:
        return self.users_after(self.users_before(scope), scope)

    def history(self) -> tuple[Staged, Staged]:
        """Both user states of loading all days one by one: after, and by day."""
        none = empty(self.spark, USERS_DIM)
        daily = history.daily_local_ips(self.hours.df)
        changes = history.keyed_changes(history.daily_changes(none, daily), 0, self.staging)
        after = history.users_after_history(none, changes.df)
        by_day = history.users_in_effect(none, changes.df, self.hours.df)
        return Staged(after, changes.rows), self.staging.write(by_day, "users-in-effect")

    def facts_before(self, users: Staged, ips: Staged) -> DataFrame:
        return facts.fact_staging(
            Sized(self.before, self.hours.rows),
            Sized(users.df, users.rows),
            Sized(ips.df, ips.rows),
            self.directions,
        )

    def facts(self, users: Staged, ips: Staged) -> DataFrame:
        return facts.fact_staging(
            Sized(self.hours.df, self.hours.rows),
            Sized(users.df, users.rows),
            Sized(ips.df, ips.rows),
            self.directions,
        )

    def new_facts(self, null_safe: bool = False) -> DataFrame:
        """The whole feed loaded after its first part: rows not held by the fact yet."""
        ips, first = self.all_addresses(), self.users_before()
        second = self.users_after(first)
        return facts.new_facts(
            self.facts_before(first, ips), self.facts(second, ips), null_safe
        )


def day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_days(read_packets(spark, sf_dir), SLICE_DAY)


def row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = read_packets(spark, sf_dir)
    return packet_ids.with_ordered_ids(packets, [F.col("event_id")], Staging(spark))


def _sent_again(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Packets with ids: the first two thirds of the days, and the last two thirds sent again
    with other sums."""
    ts = F.col("time_stamp")
    packets = read_packets(spark, sf_dir).select(
        "user_name",
        ts,
        "source_ip",
        "destination_ip",
        "bandwidth_kb",
        C.packet_id(F.col("user_name"), ts, F.col("event_id") + 1).alias("id"),
        F.to_date(ts).alias("partition_date"),
    )
    day, twice = F.col("partition_date"), F.col("bandwidth_kb") * F.lit(2).cast("float")
    existing = packets.where(day < F.lit(dt.date(2024, 1, 21)))
    batch = packets.where(day >= F.lit(dt.date(2024, 1, 11))).withColumn("bandwidth_kb", twice)
    return existing, batch


def raw_upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended to a stored table, then upserted, and read back."""
    staging = Staging(spark)
    table = raw_packets(spark, staging.path("lake"))
    table.create()
    existing, batch = _sent_again(spark, sf_dir)
    table.append(existing, compact=True)
    table.upsert(batch, ["partition_date", "id"], staging)
    return table.read()


def stored_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets per day of a stored table after an upsert, from the footers of its files."""
    staging = Staging(spark)
    table = raw_packets(spark, staging.path("lake"))
    table.create()
    existing, batch = _sent_again(spark, sf_dir)
    table.append(existing, compact=True)
    table.upsert(batch, ["partition_date", "id"], staging)
    return table.partition_counts()


def daily_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KB per user and day put into the stored aggregate, twice, and read back."""
    staging = Staging(spark)
    table = daily_table(spark, staging.path("lake"))
    table.create()
    totals = aggregates.totals_by_day(read_packets(spark, sf_dir))
    for _ in range(2):  # putting the same items again changes nothing
        table.upsert(totals, ["date", "user_name"], staging)
    return table.read()


def daily_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KB per user and day put into the item store: with wrong sums, then in two puts that
    overlap, and read back."""
    path, key = Staging(spark).path("items"), ["date", "user_name"]
    totals, split = aggregates.totals_by_day(read_packets(spark, sf_dir)), f"{SPLIT:%Y-%m-%d}"
    wrong = totals.withColumn("total_bandwidth_kb", F.lit(0).cast("decimal(38,0)"))
    for rows in (wrong, totals.where(F.col("date") >= split), totals):
        put_in_store(rows.select(*DAILY_AGGREGATE.names), path, key)
    return read_store(spark, path, DAILY_AGGREGATE, key)


def minute_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute files written by two runs of a stream over the feed's traffic files, the second
    run finding only the files that are new, read back. Minutes still open are not there."""
    staging = Staging(spark)
    source, out, checkpoint = (staging.path(p) for p in ("source", "minutes", "checkpoint"))
    rows = _traffic_rows(read_packets(spark, sf_dir))
    early = F.col("time_stamp") < f"{SPLIT:%Y-%m-%d}"
    for part in (rows.where(early), rows.where(~early)):
        ordered = part.repartitionByRange(4, "time_stamp").sortWithinPartitions("time_stamp")
        ordered.write.mode("append").option("header", "true").csv(source)
        packets = capture.read_capture_stream(spark, source, when_done="delete")
        capture.run_available(capture.write_minute_files(packets, "feed", out, checkpoint))
    packets = traffic_files.read_traffic(spark, f"{out}/*/*")
    return packets.select("user_name", "time_stamp", "source_ip", "destination_ip", "bandwidth_kb")


def raw_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last third of the packets sent again with other sums, over the first two."""
    ts = F.col("time_stamp")
    packets = read_packets(spark, sf_dir).select(
        C.packet_id(F.col("user_name"), ts, F.col("event_id") + 1).alias("id"),
        F.to_date(ts).alias("partition_date"),
        "source_ip",
        "destination_ip",
        "bandwidth_kb",
    )
    day = F.col("partition_date")
    existing = packets.where(day < F.lit(dt.date(2024, 1, 21)))
    batch = packets.where(day >= F.lit(dt.date(2024, 1, 11))).withColumn(
        "bandwidth_kb", F.col("bandwidth_kb") * F.lit(2).cast("float")
    )
    return packet_ids.upsert(existing, batch, ["partition_date", "id"])


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.hourly(read_packets(spark, sf_dir))


def daily_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.totals_by_day(read_packets(spark, sf_dir))


def user_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.user_totals(read_packets(spark, sf_dir))


def _ints(dates: DataFrame) -> DataFrame:
    parts = ("year", "quarter", "month", "week", "day", "hour")
    return dates.withColumns({c: F.col(c).cast("int") for c in parts})


def date_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = read_packets(spark, sf_dir).select(
        C.floor_hour(F.col("time_stamp")).alias("time_hour")
    )
    return _ints(dimensions.date_attributes(hours))


def private_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = read_packets(spark, sf_dir)
    return packets.where(C.is_private(F.col("source_ip"))).select(
        "event_id",
        "source_ip",
        "destination_ip",
        (~C.is_private(F.col("destination_ip"))).alias("leaves_network"),
    )


def ip_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.address_candidates(read_packets(spark, sf_dir))


def _packet_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of the packets, unsummed: enough where only who, where and when count."""
    hour = C.floor_hour(F.col("time_stamp")).alias("time_hour")
    return read_packets(spark, sf_dir).select(hour, "user_name", "source_ip", "destination_ip")


def latest_local_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.latest_local_ip(_packet_hours(spark, sf_dir))


def latest_local_ip_of_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.latest_of_batch(aggregates.local_addresses(_packet_hours(spark, sf_dir)))


def date_dim_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = _packet_hours(spark, sf_dir)
    before = hours.where(F.col("time_hour") < _at(SPLIT))
    held = dimensions.new_dates(empty(spark, DATE_DIM), before)
    return _ints(dimensions.new_dates(held, hours))


def ip_dim_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = _Loads(spark, sf_dir)
    return loads.addresses(loads.hours.df, loads.addresses(loads.before)).df


def direction_dim_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directions missing after traffic from outside the network alone was loaded."""
    outside = read_packets(spark, sf_dir).where(~C.is_private(F.col("source_ip")))
    seen = C.direction_label(F.col("source_ip"), F.lit(None).cast("string"))
    held = outside.select(seen.alias("direction")).distinct()
    keyed = held.select(F.lit(1).alias("direction_key"), "direction")
    return dimensions.new_directions(keyed)


def scd2_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = _Loads(spark, sf_dir)
    latest = aggregates.latest_local_ip(loads.after)
    return dimensions.user_changes(loads.users_before().df, latest)


def scd2_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _Loads(spark, sf_dir).both_users().df


def scd2_state_batch_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _Loads(spark, sf_dir).both_users("batch_latest").df


def fact_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = _Loads(spark, sf_dir)
    return loads.facts(loads.both_users(), loads.all_addresses())


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension after loading every day of the feed in order."""
    return _Loads(spark, sf_dir).history()[0].df


def fact_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows of loading every day of the feed in order."""
    loads = _Loads(spark, sf_dir)
    by_day, none = loads.history()[1], empty(spark, IP_DIM)
    unkeyed = history.new_addresses_by_day(none, loads.hours.df)
    ips = dimensions.keyed_addresses(unkeyed, 0, loads.staging, ("day", "ip_address"))
    return facts.fact_staging(
        Sized(history.with_day(loads.hours.df), loads.hours.rows),
        Sized(by_day.df, by_day.rows),
        Sized(ips.df, ips.rows),
        loads.directions,
    )


def scd2_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension after loading every second day first and then those between."""
    loads = _Loads(spark, sf_dir)
    daily = loads.staging.write(history.daily_local_ips(loads.hours.df), "daily-ips").df
    odd = daily.where("day(day) % 2 = 1")
    first = history.splice_versions(empty(spark, USERS_DIM), odd, 0, loads.staging)
    held = loads.staging.write(first.df, "odd-days").df
    both = history.splice_versions(held, daily, first.rows, loads.staging)
    return both.df.drop("user_key", "since")


def fact_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows with each user's row of the hour."""
    loads = _Loads(spark, sf_dir)
    daily = history.daily_local_ips(loads.hours.df)
    opened = history.daily_changes(empty(spark, USERS_DIM), daily)
    versions = history.versions_seen(history.keyed_changes(opened, 0, loads.staging).df)
    users = loads.staging.write(history.users_at_hours(versions, loads.hours.df), "users-at-hours")
    return loads.facts(users, loads.all_addresses())


def fact_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of the first load replaced after the second: users with a new row get it, and
    all other rows keep their keys."""
    loads = _Loads(spark, sf_dir)
    ips, first = loads.all_addresses(), loads.users_before()
    held = facts.key_facts(loads.facts_before(first, ips), 0, loads.staging)
    again = loads.facts_before(loads.users_after(first), ips)
    rows = loads.staging.write(facts.with_held_keys(held.df, again), "replaced").df
    fresh = rows.where("packets_key IS NULL").drop("packets_key")
    added = facts.key_facts(fresh, held.rows, loads.staging)
    return rows.where("packets_key IS NOT NULL").unionByName(added.df)


def fact_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _Loads(spark, sf_dir).new_facts()


def fact_new_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _Loads(spark, sf_dir).new_facts(null_safe=True)


def fact_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = _Loads(spark, sf_dir)
    ips, first = loads.all_addresses(), loads.users_before()
    held = loads.before.count()  # one fact row per hourly row, keyed 1 to n
    second = loads.users_after(first)
    new = facts.new_facts(loads.facts_before(first, ips), loads.facts(second, ips))
    return facts.key_facts(new, held, loads.staging).df


def _star(spark: SparkSession, sf_dir: str, keyed: bool = True) -> dict[str, DataFrame]:
    """The five tables after both loads, built in memory of the staging folder; the facts
    without keys unless ``keyed``."""
    loads = _Loads(spark, sf_dir)
    users, ips = loads.both_users(), loads.all_addresses()
    rows = loads.facts(users, ips)
    if keyed:
        rows = facts.key_facts(rows, 0, loads.staging).df
    else:
        rows = rows.withColumn("packets_key", F.lit(None).cast("long"))
    return {
        "ip_dim": ips.df,
        "users_dim": users.df,
        "date_dim": dimensions.new_dates(empty(spark, DATE_DIM), loads.hours.df),
        "direction_dim": loads.directions,
        "packets_fact": rows.select(*PACKETS_FACT.names),
    }


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts need no keys in the fact."""
    return checks.table_counts(_star(spark, sf_dir, keyed=False))


def dq_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules over a star with faults: addresses and hours of the second load are missing
    from their dimensions, and the facts of one direction have another one's key."""
    star, staging = _star(spark, sf_dir, keyed=False), Staging(spark)
    split = int(f"{SPLIT:%Y%m%d}00")
    facts_rows = star["packets_fact"].withColumns(
        {
            "packets_key": F.col("source_ip_key").cast("long") * 100_000 + F.col("destination_ip_key"),
            "direction_key": F.when(F.col("direction_key") == 1, 9).otherwise(F.col("direction_key")),
        }
    )
    faulty = {
        "ip_dim": star["ip_dim"].where("ip_key % 3 > 0"),
        "date_dim": staging.write(star["date_dim"].where(F.col("date_key") < split), "dates").df,
        "packets_fact": staging.write(facts_rows, "facts").df,  # each rule reads them
    }
    return checks.check_star_schema({**star, **faulty})


def count_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the dimensions and hourly rows before and after the second load."""
    loads = _Loads(spark, sf_dir)
    first, users = loads.addresses(loads.before), loads.users_before()
    none = empty(spark, DATE_DIM)
    before = {
        "ip_dim": first.df,
        "users_dim": users.df,
        "date_dim": dimensions.new_dates(none, loads.before),
        "direction_dim": loads.directions,
        "packets_fact": loads.before,
    }
    after = before | {
        "ip_dim": first.df.unionByName(loads.addresses(loads.after, first).df),
        "users_dim": loads.users_after(users).df,
        "date_dim": dimensions.new_dates(none, loads.hours.df),
        "packets_fact": loads.hours.df,
    }
    return checks.count_changes(checks.table_counts(before), checks.table_counts(after))


def _traffic_rows(packets: DataFrame, *more: str) -> DataFrame:
    """Packets as the rows of traffic files, with a running total."""
    return packets.select(
        *more,
        "user_name",
        F.col("time_stamp").cast("string").alias("time_stamp"),
        "source_ip",
        "destination_ip",
        "bandwidth_kb",
        F.lit(0.0).cast("float").alias("total_bandwidth_kb"),
    )


def traffic_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as one traffic file a day, archived under the files' names, and read back with
    the day of the name and ids in file order, counted per day and user."""
    staging = Staging(spark)
    written, archived = staging.path("traffic"), staging.path("archive")
    rows = _traffic_rows(read_packets(spark, sf_dir))
    day = F.substring("time_stamp", 1, 10)
    traffic_files.write_named(rows.repartition(day), F.concat(F.lit("feed-"), day), written)
    for last_digit in ("[02468]", "[13579]"):  # the second run leaves the first's files
        files = f"{written}/feed-*{last_digit}.csv"
        traffic_files.archive_traffic(spark, files, archived)
    packets = traffic_files.read_traffic(spark, archived, positions=True, days=True)
    numbered = packet_ids.with_file_ids(packets.drop("file_day"), staging)
    by_day = numbered.df.groupBy("user_name", F.col("partition_date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids")
    )
    named = packets.groupBy("user_name", F.col("file_day").alias("day")).agg(
        F.sum(F.col("bandwidth_kb").cast("double")).alias("kb")
    )
    return by_day.join(named, ["user_name", "day"])




def pair_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.pair_totals(read_packets(spark, sf_dir))


def minute_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.minute_pairs(read_packets(spark, sf_dir))


def minute_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.minute_totals(read_packets(spark, sf_dir))


def minute_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.minute_report(aggregates.minute_pairs(read_packets(spark, sf_dir)))


def top_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.top_pairs(read_packets(spark, sf_dir))


def last_per_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a running total made of the packet's place and size."""
    running = F.col("event_id") * 1000.0 + F.col("bandwidth_kb")
    packets = read_packets(spark, sf_dir).withColumn("total_bandwidth_kb", running)
    return aggregates.last_per_pair(packets, "event_id")


# Lines as a capture tool prints them, in mixed units and with lines to skip.
CONVERSATION_LINE = (
    "CASE WHEN event_id % 10 = 9 THEN 'frames  |  bytes' ELSE "
    "source_ip || '   <-> ' || destination_ip || '  1 60 bytes  2   120 bytes     3 '"
    " || CAST(event_id % 1000 AS STRING) || ' ' ||"
    " CASE event_id % 5 WHEN 0 THEN 'bytes' WHEN 1 THEN 'kB' WHEN 2 THEN 'MB'"
    " WHEN 3 THEN 'GB' ELSE 'bits' END END"
)
PROTOCOL_LINE = (
    "CASE WHEN event_id % 10 = 9 THEN 'Protocol Hierarchy Statistics' ELSE "
    "'eth      frames:' || CAST(user_id AS STRING) || ' bytes:'"
    " || CAST(event_id % 100000 AS STRING) END"
)


def conv_report_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_packets(spark, sf_dir).selectExpr("event_id", f"{CONVERSATION_LINE} AS line")
    return reports.parse_conversations(lines)


def protocol_report_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capture per day; its total is its first Ethernet line."""
    lines = read_events(spark, sf_dir).selectExpr(
        "to_date(ts) AS capture", "event_id AS line_no", f"{PROTOCOL_LINE} AS line"
    )
    return reports.capture_totals(lines)


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unfit key columns: source addresses repeat, and so do users with several addresses."""
    packets = read_packets(spark, sf_dir)
    several = aggregates.local_addresses(_packet_hours(spark, sf_dir)).withColumn(
        "current_flag", F.lit(True)
    )
    return checks.duplicates(packets, "packets", "source_ip").unionByName(
        checks.several_current(several)
    )


def dq_unique_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the second part of the feed, some of which were given before or twice."""
    packets = read_packets(spark, sf_dir)
    old = packets.where(F.col("time_stamp") < _at(SPLIT)).select("event_id")
    again = F.when(F.col("event_id") % 13 == 0, F.floor(F.col("event_id") / 2))
    new = packets.where(F.col("time_stamp") >= _at(SPLIT)).select(
        F.coalesce(again, F.col("event_id")).alias("event_id")
    )
    staged = Staging(spark).write(new, "new-keys")
    return checks.duplicates_after(old, Sized(staged.df, staged.rows), "packets", "event_id")


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = read_packets(spark, sf_dir).withColumns(
        {
            "user_name": F.nullif(F.col("user_name"), F.lit("guest")),
            "source_ip": F.when(C.is_private(F.col("source_ip")), F.col("source_ip")),
        }
    )
    columns = ["user_name", "time_stamp", "source_ip", "destination_ip", "bandwidth_kb"]
    return checks.nulls(packets, "packets", columns)


def dq_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directions of packets, where those inside the network get a third one."""
    source, target = C.is_private(F.col("source_ip")), C.is_private(F.col("destination_ip"))
    label = (
        F.when(source & target, F.lit("internal"))
        .when(source, F.lit("outbound"))
        .otherwise(F.lit("inbound"))
    )
    packets = read_packets(spark, sf_dir).select(label.alias("direction"))
    return checks.not_allowed(packets, "packets", "direction", ("inbound", "outbound"))


def dq_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the whole feed against an address dimension of its first part."""
    packets = read_packets(spark, sf_dir)
    held = dimensions.address_candidates(packets.where(F.col("time_stamp") < _at(SPLIT)))
    return checks.orphans(packets, "packets", "source_ip", held, "ip_address").unionByName(
        checks.orphans(packets, "packets", "destination_ip", held, "ip_address")
    )


def dq_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses with a port, and names with an address, are longer than allowed."""
    packets = read_packets(spark, sf_dir).select(
        F.concat("source_ip", F.lit(":"), "event_id").alias("local_ip"),
        F.concat("user_name", F.lit("@"), "destination_ip").alias("user_name"),
        "destination_ip",
    )
    limits = {"local_ip": 15, "user_name": 20, "destination_ip": 15}
    return checks.too_long(packets, "packets", limits)


def run_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts after two batches that cover the feed, the second overlapping the first."""
    packets = read_packets(spark, sf_dir)
    warehouse = Warehouse(spark, Staging(spark).path("warehouse"))
    day = F.to_date("time_stamp")
    first, last = packets.agg(F.min(day), F.max(day)).first()
    before_split = (SPLIT - dt.timedelta(days=1)).date()
    warehouse_load.run_day(spark, packets, warehouse, first, before_split, half_open=True)
    warehouse_load.run_day(spark, packets, warehouse, first, last, half_open=True)
    return warehouse_load.counts(warehouse)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet")
    return packets_from_events(stream.parquet(sf_dir))


def _streamed(spark: SparkSession, sums: DataFrame) -> DataFrame:
    """What the stream emits for the files that are there."""
    staging = Staging(spark)
    path = staging.path("emitted")
    writer = sums.writeStream.outputMode("append").format("parquet").option("path", path)
    capture.run_available(writer.option("checkpointLocation", staging.path("checkpoint")))
    return spark.read.schema(sums.schema).parquet(path)


def stream_minute_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, capture.minute_pairs_stream(_event_stream(spark, sf_dir)))


def stream_minute_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, capture.minute_totals_stream(_event_stream(spark, sf_dir)))


#: How long the stateful streams' minutes are, so that they hold pairs worth ranking.
STATE_SECONDS = 86_400
#: The file of events without a time. By name it is older than the numbered ones.
NO_DAY = "dateless"


def _disordered_files(spark: SparkSession, sf_dir: str, staging: Staging) -> str:
    """The feed as traffic files of ten days each, cut at noon. One packet in 97 has lost its
    time, and of the others one in 89 comes two files late. Events without a time are in a file
    without a number."""
    packets, number = read_packets(spark, sf_dir), F.col("event_id")
    start = F.lit(dt.datetime(2024, 1, 1, 12)).cast("timestamp_ntz")
    seconds = F.unix_micros(F.col("time_stamp").cast("timestamp")) - F.unix_micros(
        start.cast("timestamp"))
    file = F.floor(seconds / F.lit(10 * 86_400 * 1_000_000)) + F.when(number % 89 == 0, 2).otherwise(0)
    numbered = F.format_string("feed-%04d", (file + 1).cast("int"))
    name = F.when(file.isNotNull(), numbered).otherwise(NO_DAY)
    lost = number % 97 == 0
    packets = packets.withColumns({
        "time_stamp": F.when(~lost, F.col("time_stamp")), "_file": name,
    })
    rows = _traffic_rows(packets, "_file").repartition("_file")
    path = staging.path("source")
    traffic_files.write_named(rows, F.col("_file"), path)
    return path


def _stateful(
    spark: SparkSession, source: str, staging: Staging, hold: int = 0, resume=None,
    read: tuple[str, ...] = (), show=None, pattern: str = "",
) -> MinuteTables:
    """The tables of a new stream over the files there are, without the files ``read``."""
    log, path = staging.path("log"), staging.path("minute-state")
    AdmissionLog(log).write(0, read)
    packets = read_held_back(spark, source, log, hold, 1, pattern, "name")
    run_until_idle(write_minute_state(
        packets, path, staging.path("checkpoint"), seconds=STATE_SECONDS, resume=resume, show=show
    ))
    return MinuteTables(spark, path)


def stream_held_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read of each numbered file while the two newest wait."""
    staging = Staging(spark)
    source = _disordered_files(spark, sf_dir, staging)
    read = _stateful(spark, source, staging, hold=2).packets_read()
    return read.where(~F.col("file_name").startswith(NO_DAY))


def stream_left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets that came too late or without a time, with the reason."""
    staging = Staging(spark)
    source = _disordered_files(spark, sf_dir, staging)
    return _stateful(spark, source, staging).left_out().drop("batch")


def stream_resumed_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed days of a stream that ends after half the files, and of one without its checkpoint
    that goes on from the open sums."""
    staging = Staging(spark)
    source = _disordered_files(spark, sf_dir, staging)
    first = _stateful(spark, source, staging, hold=3)
    point = first.resume_point("10 minutes")
    names = tuple(r[0] for r in point.files.collect())  # one per file of the folder
    second = _stateful(spark, source, staging, resume=point, read=names)
    return first.closed().unionByName(second.closed())


def stream_top_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 busiest pairs of the newest day so far, as shown after each file."""
    staging = Staging(spark)
    source = _disordered_files(spark, sf_dir, staging)
    tables = _stateful(spark, source, staging, show=lambda df, batch: None)
    files = tables.rows("read").select("batch", "file_name").distinct()
    newest = Window.partitionBy("file_name")
    shown = tables.top().join(files, "batch").withColumn("newest", F.max("minute").over(newest))
    return shown.where(F.col("minute") == F.col("newest")).drop("newest", "batch")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        day_slice,
        row_id,
        raw_upsert,
        raw_upsert_stored,
        stored_day_counts,
        traffic_csv,
        daily_aggregate,
        daily_items,
        minute_files,
        hourly,
        daily_by_user,
        user_totals,
        date_attrs,
        private_filter,
        ip_candidates,
        latest_local_ip,
        latest_local_ip_of_batch,
        date_dim_new,
        ip_dim_new,
        direction_dim_new,
        scd2_changed,
        scd2_state,
        scd2_state_batch_latest,
        scd2_history,
        scd2_any_order,
        fact_staging,
        fact_history,
        fact_as_of,
        fact_replaced,
        fact_new,
        fact_new_null_safe,
        fact_keyed,
        table_counts,
        count_changes,
        pair_totals,
        minute_pairs,
        minute_totals,
        minute_report,
        top_pairs,
        last_per_pair,
        conv_report_parse,
        protocol_report_parse,
        dq_unique,
        dq_unique_after,
        dq_not_null,
        dq_check,
        dq_foreign_key,
        dq_length,
        dq_star,
        run_day,
        stream_minute_pairs,
        stream_minute_totals,
        stream_held_back,
        stream_left_out,
        stream_resumed_minutes,
        stream_top_pairs,
    )
}
