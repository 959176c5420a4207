"""A stream of the lines of finished files in a folder whose newest files are still written.

Spark's file source reads a file as soon as it sees it. This source leaves the newest files of a
folder alone until newer ones have come, so a writer need not rename. What it admits is written
to a log before it is read: entry n of the log names the files of offset n. An offset is then a
number, a batch that is repeated after a failure reads the files that it named, and a restart
reads none twice, whatever has appeared, under whatever name, in between.

Folders and logs are read by PyArrow: local ones, or any it has a file system for.
"""

from __future__ import annotations

import gzip
import io
import json
import posixpath
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from wirestar.schemas import TRAFFIC_CSV
from wirestar.sources.traffic_files import CSV_OPTIONS

# Fixed value: so many of the newest files wait for newer ones.
HOLD = 2
#: Lines in a batch from a file.
LINES = 20_000


def _open(location: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(location) if "://" in location or location.startswith(
        "file:") else (fs.LocalFileSystem(), location)


class AdmissionLog:
    """Entries 1, 2, ... of a folder, each a list of file names. Entry 0, if there is one, names
    files that are never to be read. An entry is written under another name and then moved."""

    def __init__(self, location: str):
        self.files, self.folder = _open(location)

    def _path(self, n: int) -> str:
        return posixpath.join(self.folder, f"{n:09d}.json")

    def numbers(self) -> list[int]:
        found = self.files.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        return sorted(int(f.base_name[:9]) for f in found if f.base_name.endswith(".json"))

    def read(self, n: int) -> list[str]:
        with self.files.open_input_stream(self._path(n)) as entry:
            return json.loads(entry.read())

    def write(self, n: int, names: Sequence[str]) -> None:
        self.files.create_dir(self.folder)
        with self.files.open_output_stream(self._path(n) + ".part") as entry:
            entry.write(json.dumps(list(names)).encode())
        self.files.move(self._path(n) + ".part", self._path(n))


class _File(InputPartition):
    def __init__(self, name: str):
        self.name = name


class HeldBackReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.files, self.folder = _open(options["path"])
        self.log = AdmissionLog(options["log"])
        self.hold, self.most = int(options.get("hold", HOLD)), int(options.get("max_files", 0))
        self.by_name = options.get("order", "time") == "name"
        self.ending, self.header = options.get("ending", ""), options.get("header") == "true"
        self.seen: set[str] | None = None
        self.last = 0

    def initialOffset(self) -> dict:
        return {"n": 0}

    def _load(self) -> None:
        """The log as it was left, once per start."""
        if self.seen is None:
            numbers = self.log.numbers()
            self.seen = {name for n in numbers for name in self.log.read(n)}
            self.last = max(numbers, default=0)

    def latestOffset(self) -> dict:
        """Admits what is neither seen nor held back, oldest first."""
        self._load()
        listed = self.files.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        waiting = sorted(
            (0 if self.by_name else f.mtime_ns, f.base_name) for f in listed
            if f.type == fs.FileType.File and f.base_name not in self.seen
            and f.base_name.endswith(self.ending) and f.base_name[0] not in "._"
        )
        names = [name for _, name in waiting[: max(0, len(waiting) - self.hold)]]
        names = names[: self.most] if self.most else names
        if names:
            self.log.write(self.last + 1, names)
            self.seen.update(names)
            self.last += 1
        return {"n": self.last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_File(f) for n in range(start["n"] + 1, end["n"] + 1) for f in self.log.read(n)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        data = self.files.open_input_stream(
            posixpath.join(self.folder, partition.name), compression=None
        )
        with data:
            raw = gzip.open(data) if partition.name.endswith(".gz") else data
            lines = io.TextIOWrapper(io.BufferedReader(raw), "utf-8", errors="replace")
            if self.header:
                next(lines, None)
            held: list[str] = []
            for line in lines:
                held.append(line.rstrip("\r\n"))
                if len(held) == LINES:
                    yield self._batch(partition.name, held)
                    held = []
            if held:
                yield self._batch(partition.name, held)

    @staticmethod
    def _batch(name: str, lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(lines)), pa.array(lines)], names=["file_name", "value"]
        )


class HeldBackFiles(DataSource):
    """``format("held_back_files")`` with the options path, log, hold, max_files, order (by time or
    name), ending and header."""

    @classmethod
    def name(cls) -> str:
        return "held_back_files"

    def schema(self) -> str:
        return "file_name string, value string"

    def streamReader(self, schema) -> HeldBackReader:
        return HeldBackReader(dict(self.options))


def read_held_back(
    spark: SparkSession,
    path: str,
    log: str,
    hold: int = HOLD,
    max_files: int = 0,
    ending: str = "",
    order: str = "time",
) -> DataFrame:
    """Packets of the traffic files under ``path``, with their ``file_name``, oldest file first:
    by when it was last written, or by ``name`` where names count up. The newest ``hold`` files wait; ``log`` is the folder of the source's own record, one per
    stream. Lines are parsed by Spark as in a batch read, a field may not hold a line break."""
    spark.dataSource.register(HeldBackFiles)
    reader = spark.readStream.format("held_back_files").options(
        path=path, log=log, hold=str(hold), max_files=str(max_files), ending=ending, order=order,
        header="true",
    )
    lines = reader.load().where(F.length(F.trim("value")) > 0)
    return lines.select("file_name", _parsed("value").alias("row")).select("file_name", "row.*").drop(
        "total_bandwidth_kb"
    )


def _parsed(column: str) -> Column:
    options = {k: str(v) for k, v in CSV_OPTIONS.items() if k not in ("header", "enforceSchema")}
    return F.from_csv(F.col(column), TRAFFIC_CSV.simpleString()[len("struct<") : -1].replace(
        ":", " "), options)
