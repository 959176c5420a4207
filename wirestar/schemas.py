"""Declared schemas, and the rules a database would enforce on them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: addresses that match are inside the network, all others are external.
PRIVATE_ADDRESS = "192.168%"

# The only two directions, keyed in this order.
DIRECTIONS = ("inbound", "outbound")

TRAFFIC_CSV = T.StructType(
    [
        T.StructField("user_name", T.StringType(), False),
        T.StructField("time_stamp", T.TimestampNTZType(), False),
        T.StructField("source_ip", T.StringType(), False),
        T.StructField("destination_ip", T.StringType(), False),
        T.StructField("bandwidth_kb", T.FloatType(), False),
        T.StructField("total_bandwidth_kb", T.FloatType(), True),
    ]
)

RAW_PACKETS = T.StructType(
    [
        T.StructField("user_name", T.StringType()),
        T.StructField("time_stamp", T.TimestampNTZType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("destination_ip", T.StringType()),
        T.StructField("bandwidth_kb", T.FloatType()),
        T.StructField("id", T.StringType()),
        T.StructField("partition_date", T.DateType()),
    ]
)

HOURLY = T.StructType(
    [
        T.StructField("time_hour", T.TimestampNTZType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("destination_ip", T.StringType()),
        T.StructField("bandwidth_kb_sum", T.DoubleType()),
    ]
)

IP_DIM = T.StructType(
    [
        T.StructField("ip_key", T.IntegerType()),
        T.StructField("ip_address", T.StringType()),
    ]
)

USERS_DIM = T.StructType(
    [
        T.StructField("user_key", T.IntegerType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("local_ip", T.StringType()),
        T.StructField("start_date", T.TimestampNTZType()),
        T.StructField("end_date", T.TimestampNTZType()),
        T.StructField("current_flag", T.BooleanType()),
    ]
)

#: What one load saw of a user on one day: the last address, when it was seen last and first.
USER_DAYS = T.StructType(
    [
        T.StructField("user_name", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("local_ip", T.StringType()),
        T.StructField("start_date", T.TimestampNTZType()),
        T.StructField("first_seen", T.TimestampNTZType()),
    ]
)

DATE_DIM = T.StructType(
    [
        T.StructField("date_key", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("year", T.ShortType()),
        T.StructField("quarter", T.ShortType()),
        T.StructField("month", T.ShortType()),
        T.StructField("week", T.ShortType()),
        T.StructField("day", T.ShortType()),
        T.StructField("hour", T.ShortType()),
        T.StructField("is_weekend", T.BooleanType()),
    ]
)

DIRECTION_DIM = T.StructType(
    [
        T.StructField("direction_key", T.IntegerType()),
        T.StructField("direction", T.StringType()),
    ]
)

# packets_key is a BIGINT: at 100 TB the fact table can pass 2^31 rows, and an INT
# key would then fail the load (ANSI mode raises on overflow).
PACKETS_FACT = T.StructType(
    [
        T.StructField("packets_key", T.LongType()),
        T.StructField("user_key", T.IntegerType()),
        T.StructField("source_ip_key", T.IntegerType()),
        T.StructField("destination_ip_key", T.IntegerType()),
        T.StructField("external_ip_key", T.IntegerType()),
        T.StructField("date_key", T.IntegerType()),
        T.StructField("direction_key", T.IntegerType()),
        T.StructField("kb_bandwidth", T.DoubleType()),
    ]
)

DAILY_AGGREGATE = T.StructType(
    [
        T.StructField("user_name", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("total_bandwidth_kb", T.DecimalType(38, 0)),
    ]
)


@dataclass(frozen=True)
class TableRules:
    """Constraints of one table: Parquet tables do not enforce them, checks do."""

    schema: T.StructType
    key: str
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # foreign key column -> (table, key column)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    # physical partition column that is not part of the schema
    partition: str | None = None


STAR_SCHEMA = {
    "ip_dim": TableRules(
        IP_DIM,
        key="ip_key",
        unique=("ip_key", "ip_address"),
        not_null=("ip_key", "ip_address"),
        max_length={"ip_address": 15},
    ),
    "users_dim": TableRules(
        USERS_DIM,
        key="user_key",
        unique=("user_key",),
        not_null=("user_key", "user_name", "start_date", "current_flag"),
        max_length={"user_name": 20, "local_ip": 15},
    ),
    "date_dim": TableRules(
        DATE_DIM,
        key="date_key",
        unique=("date_key",),
        not_null=("date_key", "date", "year", "quarter", "month", "week", "day", "hour"),
    ),
    "direction_dim": TableRules(
        DIRECTION_DIM,
        key="direction_key",
        unique=("direction_key", "direction"),
        not_null=("direction_key",),
        max_length={"direction": 8},
        allowed={"direction": DIRECTIONS},
    ),
    "packets_fact": TableRules(
        PACKETS_FACT,
        key="packets_key",
        unique=("packets_key",),
        not_null=("packets_key",),
        references={
            "user_key": ("users_dim", "user_key"),
            "source_ip_key": ("ip_dim", "ip_key"),
            "destination_ip_key": ("ip_dim", "ip_key"),
            "external_ip_key": ("ip_dim", "ip_key"),
            "date_key": ("date_dim", "date_key"),
            "direction_key": ("direction_dim", "direction_key"),
        },
        partition="date_day",
    ),
}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, known as empty to the optimizer."""
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
