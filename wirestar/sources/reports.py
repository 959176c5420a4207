"""Printed capture reports: conversations per address pair, and protocol totals.

Both work on a text table with one line per row, so a folder of reports of any size is
read in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirestar.functions import columns as C


def read_report_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``capture`` (file), ``line_no`` (rising within a file) and ``line``."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("capture"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("line_no"),
        F.col("value").alias("line"),
    )


def parse_conversations(lines: DataFrame, only_bytes: bool = False) -> DataFrame:
    """KB per conversation line ``ip1 <-> ip2 frames bytes unit frames bytes unit frames
    BYTES UNIT``; other lines are skipped. Addresses come in direction-free order.

    ``unit_known`` is false for units other than bytes, kB, MB and GB, which count as
    KB; ``only_bytes`` counts all but bytes as KB. Text where the number should be
    gives NULL KB.
    """
    squeezed = F.trim(F.regexp_replace(F.col("line"), r"\s+", " "))
    token = F.split(squeezed, " ")
    others = [c for c in lines.columns if c != "line"]
    parsed = lines.where(F.col("line").contains("<->")).select(
        *others,
        F.get(token, F.lit(0)).alias("ip1"),
        F.get(token, F.lit(2)).alias("ip2"),
        F.get(token, F.lit(10)).alias("amount"),
        F.get(token, F.lit(11)).alias("unit"),
    )
    whole = F.nullif(F.regexp_extract("amount", r"^[+-]?\d+", 0), F.lit("")).cast("bigint")
    return parsed.select(
        *others,
        C.pair_high(F.col("ip1"), F.col("ip2")).alias("source_ip"),
        C.pair_low(F.col("ip1"), F.col("ip2")).alias("destination_ip"),
        C.to_kb(whole.cast("double"), F.col("unit"), only_bytes).alias("bandwidth_kb"),
        C.known_unit(F.col("unit")).alias("unit_known"),
    )


def parse_protocol_totals(lines: DataFrame) -> DataFrame:
    """KB per Ethernet line ``eth frames:N bytes:N``; other lines are skipped."""
    others = [c for c in lines.columns if c != "line"]
    wanted = F.col("line").contains("eth") & F.col("line").contains("bytes")
    third = F.get(F.split("line", ":"), F.lit(2))
    number = F.nullif(F.regexp_extract(third, r"^\s*([+-]?\d+(\.\d+)?)", 1), F.lit(""))
    return lines.where(wanted).select(
        *others, (number.cast("double") / 1024).alias("total_kb_bandwidth")
    )


def capture_totals(lines: DataFrame) -> DataFrame:
    """KB of each capture: its first Ethernet line, as nested layers repeat its bytes."""
    return (
        parse_protocol_totals(lines)
        .groupBy("capture")
        .agg(F.min_by("total_kb_bandwidth", "line_no").alias("total_kb_bandwidth"))
    )
