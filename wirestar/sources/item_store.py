"""Items of a key, put in transactions: a put is seen whole or not at all.

Tasks write their items into files of their own and hand the names to the driver. Only when all
tasks have finished does one commit file, written under another name and moved, list the files;
readers see what commits list. A task that is killed, tried twice or left over from a failed job
leaves a file that no commit names. Of items with one key the last commit's counts, so a put that
is run again changes nothing.

Spark turns rows into JSON and back; Python tasks only move lines. Files are written by PyArrow:
to local folders, or any store it has a file system for.
"""

from __future__ import annotations

import json
import posixpath
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

ITEMS, COMMITS = "items", "commits"


def _open(location: str) -> tuple[fs.FileSystem, str]:
    if "://" in location or location.startswith("file:"):
        return fs.FileSystem.from_uri(location)
    return fs.LocalFileSystem(), location


@dataclass
class Written(WriterCommitMessage):
    name: str


class ItemWriter(DataSourceWriter):
    def __init__(self, location: str):
        self.location = location

    def write(self, rows: Iterator[Row]) -> Written:
        files, folder = _open(self.location)
        files.create_dir(posixpath.join(folder, ITEMS))
        name = f"{uuid.uuid4().hex}.json"
        with files.open_output_stream(posixpath.join(folder, ITEMS, name)) as out:
            for row in rows:
                out.write(row[0].encode() + b"\n")
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = _open(self.location)
        folder = posixpath.join(folder, COMMITS)
        files.create_dir(folder)
        path = posixpath.join(folder, f"{time.time_ns():020d}-{uuid.uuid4().hex}.json")
        with files.open_output_stream(path + ".part") as out:
            out.write(json.dumps([m.name for m in messages if m]).encode())
        files.move(path + ".part", path)

    def abort(self, messages: list[Written | None]) -> None:
        """Files of tasks that had finished; those of others are named by no commit."""
        files, folder = _open(self.location)
        for message in messages:
            if message:
                files.delete_file(posixpath.join(folder, ITEMS, message.name))


class ItemStore(DataSource):
    """``format("item_store")`` with the option path; one column of JSON."""

    @classmethod
    def name(cls) -> str:
        return "item_store"

    def schema(self) -> str:
        return "item string"

    def writer(self, schema, overwrite) -> ItemWriter:
        return ItemWriter(self.options["path"])


def put_in_store(rows: DataFrame, path: str, key: list[str]) -> None:
    """Put one item per key in one transaction."""
    spark = rows.sparkSession
    spark.dataSource.register(ItemStore)
    items = rows.dropDuplicates(key).select(F.to_json(F.struct(*rows.columns)).alias("item"))
    items.write.format("item_store").option("path", path).mode("append").save()


def commits(path: str) -> list[list[str]]:
    """The files that each commit lists, oldest first: as many names as tasks have written."""
    files, folder = _open(path)
    found = files.get_file_info(
        fs.FileSelector(posixpath.join(folder, COMMITS), allow_not_found=True)
    )
    listed = []
    for info in sorted(found, key=lambda f: f.base_name):
        if info.base_name.endswith(".json"):
            with files.open_input_stream(info.path) as commit:
                listed.append(json.loads(commit.read()))
    return listed


def read_store(spark: SparkSession, path: str, schema: T.StructType, key: list[str]) -> DataFrame:
    """The items of all commits, of each key the one put last."""
    order = [(name, n) for n, names in enumerate(commits(path)) for name in names]
    if not order:
        return spark.createDataFrame([], schema)
    items = spark.read.schema(schema).json([f"{path}/{ITEMS}/{name}" for name, _ in order])
    items = items.withColumn("_name", F.col("_metadata.file_name"))
    numbers = spark.createDataFrame(order, "_name string, _commit int")
    rest = [c for c in schema.names if c not in key]
    last = F.max_by(F.struct(*rest), "_commit").alias("_last")
    found = items.join(F.broadcast(numbers), "_name").groupBy(*key).agg(last)  # a row per file
    return found.select(*key, "_last.*").select(*schema.names)
