"""Daily traffic files: CSV, plain or gzip, on any file system Spark reads."""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirestar.functions import columns as C
from wirestar.schemas import TRAFFIC_CSV

#: Names whose files are moved into place side by side.
MOVES_AT_ONCE = 16

# Columns go by position and the header line is skipped, whatever it says. A row that
# does not fit the schema fails the job; with column pruning a row with too few or too
# many fields would pass. Empty fields are null by default; the option adds the text NULL.
CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "nullValue": "NULL",
    "mode": "FAILFAST",
    "columnPruning": "false",
}


def read_traffic(
    spark: SparkSession, path: str | list[str], positions: bool = False, days: bool = False
) -> DataFrame:
    """Packets of traffic files, without the running total.

    ``positions`` adds ``file_path`` and ``block_start`` for numbering rows in file
    order, ``days`` adds ``file_day`` from the file name.
    """
    df = spark.read.schema(TRAFFIC_CSV).options(**CSV_OPTIONS).csv(path)
    columns = [c for c in TRAFFIC_CSV.names if c != "total_bandwidth_kb"]
    return df.select(
        *(_quoted_empty_to_null(f) for f in TRAFFIC_CSV if f.name in columns),
        *(
            [
                F.col("_metadata.file_path").alias("file_path"),
                F.col("_metadata.file_block_start").alias("block_start"),
            ]
            if positions
            else []
        ),
        *([C.day_in_name(F.col("_metadata.file_path")).alias("file_day")] if days else []),
    )


def _quoted_empty_to_null(field: T.StructField):
    column = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.nullif(column, F.lit("")).alias(field.name)
    return column


def _move(fs, source, target) -> None:
    """A file system may tell a failed rename by its result alone."""
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {source.toString()} to {target.toString()}")


def write_named(rows: DataFrame, name: Column, destination: str, compression: str = "none") -> None:
    """Rows as CSV files of the given names under ``destination``. Files that are there stay,
    but for those of an equal name, which are replaced. Rows of a name that several tasks hold
    become several files, ``name-00000.csv`` and so on, each with the header.

    Spark writes each name's rows into a folder of its own in a working folder. Then, name by
    name and several names at once, the files that are there move into the working folder and the
    new ones into their place. If a move fails, that name's old files move back and the working
    folder stays; only when all is in place is it deleted, with the old files in it.
    """
    spark, work = rows.sparkSession, f"{destination}/_work-{uuid.uuid4().hex}"
    options = {"header": "true", "compression": compression}
    rows.withColumn("_file", name).write.partitionBy("_file").options(**options).csv(work)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(work).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    ending = ".csv.gz" if compression == "gzip" else ".csv"

    def put(folder) -> None:
        base = unquote(folder.getName().removeprefix("_file="))
        found = fs.globStatus(path(f"{destination}/{base}*{ending}")) or []
        old = [p.getPath() for p in found if re.fullmatch(
            r"(-\d{5})?", p.getPath().getName().removeprefix(base).removesuffix(ending))]
        parts = fs.globStatus(path(f"{folder.toString()}/part-*"))
        parts = sorted(p.getPath().toString() for p in parts)
        moves = [(p, path(f"{folder.toString()}/_old-{p.getName()}")) for p in old]
        for n, part in enumerate(parts):
            number = f"-{n:05d}" if len(parts) > 1 else ""
            moves.append((path(part), path(f"{destination}/{base}{number}{ending}")))
        done = []
        try:
            for source, target in moves:
                _move(fs, source, target)
                done.append((source, target))
        except Exception:
            for source, target in reversed(done):
                fs.rename(target, source)
            raise

    folders = [f.getPath() for f in fs.globStatus(path(f"{work}/_file=*")) or []]
    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        list(pool.map(put, folders))
    fs.delete(path(work), True)


def archive_traffic(spark: SparkSession, path: str | list[str], destination: str) -> None:
    """Keep traffic files as gzip files of their own names under ``destination``, beside those
    that are there. Two files of one name are refused, as one would replace the other."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.csv)?(\.gz)?$", 1)
    rows = spark.read.schema(TRAFFIC_CSV).options(**CSV_OPTIONS).csv(path)
    sources = rows.select(F.col("_metadata.file_path").alias("path"), name.alias("name")).distinct()
    twice = sources.groupBy("name").count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"several files are named {[r.name for r in twice]}")
    write_named(rows, name, destination, "gzip")
