"""The driver's ``events`` table seen as a packet feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string"
)

# Each expression is both Spark SQL and DuckDB SQL, so that the oracle reads the same
# packets. Users grow with the table. A user's own address changes from day to day. The
# user 'guest' only ever appears with an external source, so it gets no dimension row.
# One address receives a quarter of all packets.
PACKET_COLUMNS = {
    "event_id": "event_id",
    "user_name": "CASE WHEN event_type = 'error' THEN 'guest'"
    " ELSE 'u' || CAST(user_id AS STRING) END",
    "time_stamp": "ts",
    "source_ip": "CASE WHEN event_type = 'error' OR event_id % 4 = 0"
    " THEN '8.8.' || CAST(event_id % 50 AS STRING) || '.' || CAST(user_id % 100 AS STRING)"
    " ELSE '192.168.' || CAST(user_id % 200 AS STRING) || '.'"
    " || CAST(EXTRACT(DAY FROM ts) % 3 AS STRING) END",
    "destination_ip": "CASE WHEN event_id % 4 = 0"
    " THEN '192.168.' || CAST(user_id % 200 AS STRING) || '.'"
    " || CAST(EXTRACT(DAY FROM ts) % 3 AS STRING)"
    " WHEN event_id % 4 = 1 THEN '192.168.9.9'"
    " ELSE '1.1.' || CAST(event_id % 250 AS STRING) || '.'"
    " || CAST(user_id % 250 AS STRING) END",
    "bandwidth_kb": "CAST(value AS FLOAT)",
}

PACKETS_SQL = (
    "SELECT " + ", ".join(f"{e} AS {c}" for c, e in PACKET_COLUMNS.items()) + " FROM events"
)


def packets_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*(f"{e} AS {c}" for c, e in PACKET_COLUMNS.items()))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared, not inferred: inferring a schema is a job of its own."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def read_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_from_events(read_events(spark, sf_dir))
