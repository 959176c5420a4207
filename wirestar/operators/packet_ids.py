"""Row ids of raw packets, and the upsert by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirestar.functions import columns as C
from wirestar.operators.numbering import number_in_file, number_rows
from wirestar.schemas import RAW_PACKETS
from wirestar.sources.staging import Staged, Staging


REQUIRED = ["user_name", "time_stamp", "source_ip", "destination_ip", "bandwidth_kb"]


def with_file_ids(packets: DataFrame, staging: Staging) -> Staged:
    """Raw packets with ids from their place in their file (see ``number_in_file``).
    ``seen`` counts the NULLs of each required column; an id is NULL only with those."""
    null_counts = {c: F.count_if(F.col(c).isNull()) for c in REQUIRED}
    numbered = number_in_file(packets, "_number", staging, null_counts)
    return Staged(_raw_columns(numbered.df), numbered.rows, numbered.seen)


def with_ordered_ids(packets: DataFrame, order_by: list[Column], staging: Staging) -> DataFrame:
    """Raw packets with ids from their place among the packets of their day."""
    dated = packets.withColumn("partition_date", F.to_date("time_stamp"))
    numbered = number_rows(dated, order_by, "_number", staging, group_by=["partition_date"])
    return _raw_columns(numbered.df)


def _raw_columns(numbered: DataFrame) -> DataFrame:
    ts = F.col("time_stamp")
    return numbered.withColumns(
        {
            "id": C.packet_id(F.col("user_name"), ts, F.col("_number")),
            "partition_date": F.to_date(ts),
        }
    ).select(*RAW_PACKETS.names)


class RepeatedKeys(ValueError):
    """A batch to upsert holds a key more than once."""


def refuse_repeated_keys(batch: DataFrame, keys: list[str]) -> None:
    """Counted before the shuffle; only a few examples reach the driver."""
    counted = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    examples = counted.limit(3).collect()
    if examples:
        raise RepeatedKeys(f"more than one row for {[r.asDict() for r in examples]}")


def upsert(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` with rows of the batch's keys replaced and its other rows added. The
    batch must be unique on its keys (see ``refuse_repeated_keys``)."""
    kept = existing.join(batch.select(*keys), keys, "left_anti")
    return kept.select(*existing.columns).unionByName(batch.select(*existing.columns))
