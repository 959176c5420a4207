"""Parquet tables: raw packets, the star schema and the daily aggregate.

A location is a folder on any file system Spark reads (``file:``, ``s3a:``, ``hdfs:``). Raw
packets and the daily aggregate may also be tables of the session's catalog.
"""

from __future__ import annotations

import contextlib
import json
import os
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirestar.functions import columns as C
from wirestar.operators.numbering import last_key
from wirestar.operators.packet_ids import refuse_repeated_keys, upsert
from wirestar.schemas import DAILY_AGGREGATE, RAW_PACKETS, STAR_SCHEMA, USER_DAYS, empty
from wirestar.sources.staging import Staging

#: Files that are moved into a table side by side.
MOVES_AT_ONCE = 16


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` that counts the rows of Parquet files, as a whole or by
    partition, from their footers and reads no column. Its relations have to be read by it."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


class PartitionedTable:
    """A Parquet table partitioned by one column of its schema, in a folder or, with
    ``catalog_name``, under a name in the session's catalog."""

    def __init__(
        self,
        spark: SparkSession,
        path: str | None,
        schema: T.StructType,
        partition: str,
        catalog_name: str | None = None,
    ):
        self.spark, self.path, self.catalog_name = spark, path, catalog_name
        self.schema, self.partition = schema, partition

    def create(self) -> None:
        """Create the table unless it is there."""
        rows = empty(self.spark, self.schema)
        writer = rows.write.mode("ignore").partitionBy(self.partition)
        if self.catalog_name:
            writer.format("parquet").saveAsTable(self.catalog_name)
        else:
            writer.parquet(self.path)

    def read(self) -> DataFrame:
        self.finish_swaps()
        if self.catalog_name:
            return self.spark.table(self.catalog_name).select(*self.schema.names)
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)

    def partition_counts(self) -> DataFrame:
        """Rows of each partition: its column and ``n_rows``. Of a folder only the footers of
        the files are read; a table of the catalog is counted by a scan."""
        if self.catalog_name:
            rows = self.read()
        else:
            self.finish_swaps()
            rows = footer_session(self.spark).read.schema(self.schema).parquet(self.path)
        return rows.groupBy(self.partition).agg(F.count(F.lit(1)).alias("n_rows"))

    def append(self, rows: DataFrame, compact: bool = False) -> None:
        """Append rows. No shuffle by default, as traffic files hold one day each;
        ``compact`` rebalances mixed input into few files per day, splitting big days."""
        if compact:
            rows = rows.hint("rebalance", F.col(self.partition))
        if self.catalog_name:
            self._insert(rows, overwrite=False)
        else:
            rows.write.mode("append").partitionBy(self.partition).parquet(self.path)

    def _insert(self, rows: DataFrame, overwrite: bool) -> None:
        """Into the catalog's table, whose partition column stands last."""
        columns = [c for c in self.schema.names if c != self.partition] + [self.partition]
        writer = rows.select(*columns).write.option("partitionOverwriteMode", "dynamic")
        writer.insertInto(self.catalog_name, overwrite)

    def upsert(self, batch: DataFrame, keys: list[str], staging: Staging) -> None:
        """Replace rows of the batch's keys and add its other rows. Keys must include the
        partition. A batch that holds a key twice is refused before anything is written.

        In a folder, only files that hold a key of the batch are read whole and written anew;
        all others stay. In a catalog's table the days that the batch touches are. Until all new
        files are written nothing has changed; then a plan of the swap is written, which any
        later reader or writer of this table completes if it finds it (``finish_swaps``)."""
        fixed = staging.write(batch.select(*self.schema.names), "upsert-batch").df
        refuse_repeated_keys(fixed, keys)
        # One value per day of the batch.
        days = [r[0] for r in fixed.select(self.partition).distinct().collect()]
        if not days:
            return
        touched = self.read().where(F.col(self.partition).isin(days))
        if self.catalog_name:
            self._insert(staging.write(upsert(touched, fixed, keys), "upsert-merged").df, True)
            return
        table = self.spark.read.schema(self.schema).parquet(self.path)
        in_days = table.where(F.col(self.partition).isin(days))
        named = in_days.select(*keys, F.col("_metadata.file_path").alias("_file"))
        hit = named.join(fixed.select(*keys), keys, "left_semi").select("_file").distinct()
        old = sorted(r[0] for r in hit.collect())  # names of files, of which the driver has all
        rows = fixed
        if old:
            # A condition on the path prunes the files that are listed for the scan.
            rows = upsert(in_days.where(F.col("_metadata.file_path").isin(old)), fixed, keys)
        work = f"{self.path}/_swap-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.partitionBy(self.partition).parquet(work)
        self._plan_swap(work, old)
        self.finish_swaps()

    def replace_partitions(self, rows: DataFrame, values: list) -> None:
        """``rows`` in place of all that the partitions of ``values`` hold, in a folder's table.
        They are written whole beside it before the planned swap, so they may be read from it."""
        self.finish_swaps()
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        old = []
        for value in values:
            pattern, fs = _hadoop(self.spark, f"{self.path}/{self.partition}={value}")
            found = fs.globStatus(folder(pattern, "*.parquet")) or []
            old += [f.getPath().toUri().toString() for f in found]
        work = f"{self.path}/_swap-{uuid.uuid4().hex}"
        rows = rows.select(*self.schema.names).hint("rebalance", F.col(self.partition))
        rows.write.partitionBy(self.partition).parquet(work)
        self._plan_swap(work, sorted(old))
        self.finish_swaps()

    def _plan_swap(self, work: str, old: list[str]) -> None:
        """What a swap does, in a file that stands when its name does."""
        part, fs = _hadoop(self.spark, f"{work}/_plan.part")
        stream = fs.create(part, True)
        stream.write(bytearray(json.dumps(old).encode()))
        stream.close()
        _rename(fs, part, _hadoop(self.spark, f"{work}/_plan")[0])

    def finish_swaps(self) -> None:
        """Complete swaps that were planned: new files move into their partitions, then the
        files that they replace are deleted, then the plan. Each step may be repeated. A working
        folder without a plan is of an upsert that runs or has failed, and is left alone."""
        if self.catalog_name:
            return
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        uri = self.spark.sparkContext._jvm.java.net.URI
        pattern, fs = _hadoop(self.spark, f"{self.path}/_swap-*/_plan")
        for plan in fs.globStatus(pattern) or []:
            work = plan.getPath().getParent()
            stream = fs.open(plan.getPath())
            old = json.loads(bytes(stream.readAllBytes()))
            stream.close()
            for part in fs.globStatus(path(work, f"{self.partition}=*/*.parquet")) or []:
                day = path(self.path, part.getPath().getParent().getName())
                fs.mkdirs(day)
                _rename(fs, part.getPath(), path(day, part.getPath().getName()))
            for name in old:
                fs.delete(path(uri(name)), False)
            fs.delete(work, True)


def _hadoop(spark: SparkSession, path: str):
    """Hadoop's path and its file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _rename(fs, source, target) -> None:
    """A file system may tell a failed rename by its result alone. A source that is gone has
    been moved by another who completes the same swap."""
    if not fs.rename(source, target) and fs.exists(source):
        raise OSError(f"cannot rename {source.toString()} to {target.toString()}")


def _lake_table(
    spark: SparkSession, lake: str, name: str, schema: T.StructType, partition: str
) -> PartitionedTable:
    """A ``lake`` with a slash or a scheme is a folder, anything else a catalog schema such
    as ``traffic`` or ``spark_catalog.traffic``."""
    if "/" in lake:
        return PartitionedTable(spark, f"{lake}/{name}", schema, partition)
    return PartitionedTable(spark, None, schema, partition, f"{lake}.{name}")


def raw_packets(spark: SparkSession, lake: str) -> PartitionedTable:
    return _lake_table(spark, lake, "packets", RAW_PACKETS, "partition_date")


def daily_aggregate(spark: SparkSession, lake: str) -> PartitionedTable:
    return _lake_table(spark, lake, "daily_aggregate", DAILY_AGGREGATE, "date")


class ItemWriter(Protocol):
    """What ``put_items`` needs of an external store's writer."""

    def put(self, item: dict) -> None: ...

    def close(self) -> None:
        """Called once after the last item; a writer that buffers sends the rest here."""


def put_items(rows: DataFrame, open_writer: Callable[[], ItemWriter], key: list[str]) -> None:
    """Hand each row to an external store's writer: one writer per partition, closed after
    its last row. A failing writer, also in ``close``, fails the job. Writers must replace
    items of equal key, as a retried task sends its rows again."""

    def send(items: Iterator[Row]) -> None:
        writer = open_writer()
        with contextlib.closing(writer):
            for item in items:
                writer.put(item.asDict())

    rows.dropDuplicates(key).foreachPartition(send)


class ChangedMeanwhile(RuntimeError):
    """Another load has changed what this one started from."""


class Warehouse:
    """The star schema. Four tables are append-only. Of ``users_dim`` the current rows are a
    new version folder after each change, and the highest finished one counts; the rows that a
    change closes are added once, in a folder of the same version. So a failed write leaves the
    state alone and its repetition overwrites what it left, closed rows are never written
    again, and only ``keep`` versions of the current rows are kept. A change of closed rows, which
    a batch between loaded ones makes, writes all closed rows anew and marks its version as
    whole: closed rows of versions before it no longer count.

    Beside the star stands ``user_days``: what each load saw of its users on each day, from which
    such a batch is spliced in. Rows that repeat in it are of no effect.

    Keys are claimed before the rows that use them are written: claim number n of a table is a
    file that only one load can create (``key_claims``), and it holds the highest key given out so
    far. A load that finds its number taken reads the new claim and tries the next one, so loads
    side by side never use a key twice. A load that fails leaves a gap in the keys. No load reads
    keys from its table. Claims are never deleted, as a slow load might then claim an old number.
    """

    VERSIONED = "users_dim"
    KEYED = ("ip_dim", "users_dim", "packets_fact")

    def __init__(self, spark: SparkSession, location: str, keep: int = 2):
        self.spark, self.location, self.keep = spark, location, max(1, keep)

    def _schema(self, table: str) -> T.StructType:
        rules = STAR_SCHEMA[table]
        if rules.partition is None:
            return rules.schema
        return T.StructType([*rules.schema, T.StructField(rules.partition, T.IntegerType())])

    def _path(self, table: str) -> str:
        return f"{self.location}/{table}"

    def _files(self, path: str):
        return _hadoop(self.spark, path)

    def _finished(self, folder: str) -> list[str]:
        """Folders of the pattern that a finished write has marked."""
        pattern, fs = self._files(f"{self.location}/{folder}/_SUCCESS")
        return [s.getPath().getParent().getName() for s in fs.globStatus(pattern) or []]

    def _versions(self, folder: str = "users_dim/current") -> list[int]:
        return sorted(int(name.split("=")[1]) for name in self._finished(f"{folder}/version=*"))

    def _drop_old(self, folder: str) -> None:
        for version in self._versions(folder)[: -self.keep]:
            path, fs = self._files(f"{self.location}/{folder}/version={version}")
            fs.delete(path, True)

    @contextlib.contextmanager
    def lease(self, name: str, wait_seconds: float = 3600) -> Iterator[None]:
        """A block that only one load runs at a time; others wait for it. The lease of a load
        whose driver was lost has to be deleted, which the error of those that wait says."""
        path, until = f"{self.location}/_leases/{name}", time.time() + wait_seconds
        while not self._create_file(path, str(time.time())):
            if time.time() > until:
                raise RuntimeError(f"{path} is held; if no load runs, delete it")
            time.sleep(0.2)
        try:
            yield
        finally:
            held, fs = self._files(path)
            fs.delete(held, False)

    def create(self) -> None:
        """Create the tables that are not there, and the first key claims from their keys."""
        with self.lease("create"):
            self._create()

    def _create(self) -> None:
        there = self._finished("*")
        for table, rules in STAR_SCHEMA.items():
            if table == self.VERSIONED:
                if not self._versions():
                    self.replace_users(empty(self.spark, rules.schema))
                continue
            if table in there:
                continue
            writer = empty(self.spark, self._schema(table)).write.mode("ignore")
            if rules.partition:
                writer = writer.partitionBy(rules.partition)
            writer.parquet(self._path(table))
        for table in self.KEYED:
            if not self._claims(table):
                highest = last_key(self.read(table), STAR_SCHEMA[table].key)
                self._create_file(self._claim_path(table, 1), str(highest))

    def _claim_path(self, table: str, n: int) -> str:
        return f"{self.location}/key_claims/{table}/{n:09d}"

    def _claims(self, table: str) -> list[int]:
        pattern, fs = self._files(f"{self.location}/key_claims/{table}/[0-9]*")
        return sorted(int(s.getPath().getName()) for s in fs.globStatus(pattern) or [])

    def _create_file(self, path: str, text: str) -> bool:
        """Create a file unless it is there, as one step, and tell whether it was created."""
        hadoop, fs = self._files(path)
        if hadoop.toUri().getScheme() in (None, "file") and fs.getScheme() == "file":
            local = hadoop.toUri().getPath()  # Hadoop's local files only look before they create
            os.makedirs(os.path.dirname(local), exist_ok=True)
            try:
                with open(local, "x") as file:
                    file.write(text)
            except FileExistsError:
                return False
            return True
        try:
            stream = fs.create(hadoop, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def _read_file(self, path: str) -> str:
        """A small file's text; one that another load is just writing is waited for."""
        hadoop, fs = self._files(path)
        for _ in range(100):
            if size := fs.getFileStatus(hadoop).getLen():
                stream = fs.open(hadoop)
                text = "".join(chr(stream.read()) for _ in range(size))
                stream.close()
                return text
            time.sleep(0.1)
        raise RuntimeError(f"{path} is empty: the load that created it has failed; delete it")

    def last_key(self, table: str) -> int:
        """The highest key given out so far."""
        return int(self._read_file(self._claim_path(table, self._claims(table)[-1])))

    def claim_keys(self, table: str, n: int) -> int:
        """The key before a range of ``n`` that no other load gets."""
        while True:
            number = self._claims(table)[-1]
            last = int(self._read_file(self._claim_path(table, number)))
            if self._create_file(self._claim_path(table, number + 1), str(last + n)):
                return last

    def claims(self, table: str) -> Callable[[int], int]:
        return lambda n: self.claim_keys(table, n)

    def read(self, table: str) -> DataFrame:
        """A table's rows. The fact table also shows its partition column ``date_day``:
        filter on it to read only some days."""
        if table == self.VERSIONED:
            return self.current_users().unionByName(self._closed_users())
        if table == "packets_fact":
            self._fact_table().finish_swaps()
        schema = self._schema(table)
        return self.spark.read.schema(schema).parquet(self._path(table))

    def users_version(self) -> int:
        """The version of ``users_dim`` that a change starts from."""
        return self._versions()[-1]

    def current_users(self) -> DataFrame:
        """The current rows of ``users_dim``, without its closed ones."""
        schema = STAR_SCHEMA[self.VERSIONED].schema
        path = f"{self.location}/users_dim/current/version={self._versions()[-1]}"
        return self.spark.read.schema(schema).parquet(path)

    def _closed_users(self) -> DataFrame:
        """Closed rows of all changes up to the current version."""
        schema = STAR_SCHEMA[self.VERSIONED].schema
        versioned = T.StructType([*schema, T.StructField("version", T.LongType())])
        closed = self.spark.read.schema(versioned).parquet(f"{self.location}/users_dim/closed")
        newest = self._versions()[-1]
        pattern, fs = self._files(f"{self.location}/users_dim/_whole-*")
        marked = [int(s.getPath().getName().split("-")[1]) for s in fs.globStatus(pattern) or []]
        whole = max((v for v in marked if v <= newest), default=0)
        return closed.where(F.col("version").between(whole, newest)).select(*schema.names)

    def _fact_table(self) -> PartitionedTable:
        name = "packets_fact"
        return PartitionedTable(self.spark, self._path(name), self._schema(name), "date_day")

    def replace_facts(self, rows: DataFrame, days: list[int]) -> None:
        """``rows`` in place of all facts of the days ``yyyyMMdd``, which they lie in."""
        day = C.day_of_key(F.col("date_key"))
        self._fact_table().replace_partitions(rows.withColumn("date_day", day), days)

    def see_users(self, daily: DataFrame) -> None:
        """Keep what a load saw of its users: ``history.daily_local_ips``. At most one row per
        user and day, in one file."""
        work = f"{self.location}/user_days/_append-{uuid.uuid4().hex}"
        daily.select(*USER_DAYS.names).coalesce(1).write.parquet(work)
        self._move_parts(work, f"{self.location}/user_days")

    def users_seen(self) -> DataFrame:
        """All that loads have seen of users; what one load saw twice is there twice."""
        path = f"{self.location}/user_days"
        folder, fs = self._files(path)
        if not fs.exists(folder):  # a warehouse of before
            return empty(self.spark, USER_DAYS)
        return self.spark.read.schema(USER_DAYS).parquet(path)

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.read(t).select(*STAR_SCHEMA[t].schema.names) for t in STAR_SCHEMA}

    def parts(self) -> dict[str, list[DataFrame]]:
        """Each table as the stored parts that it is the union of, for counting their rows from
        the footers of the files: columns must not be read from them."""
        files = Warehouse(footer_session(self.spark), self.location, self.keep)
        found = {t: [files.read(t)] for t in STAR_SCHEMA if t != self.VERSIONED}
        return {**found, self.VERSIONED: [files.current_users(), files._closed_users()]}

    def create_views(self) -> None:
        """Temporary views of the tables as they are now, for ``spark.sql``."""
        for table, df in self.tables().items():
            df.createOrReplaceTempView(table)

    def facts_between(self, first_day: int, last_day: int) -> DataFrame:
        """Fact rows of the days ``yyyyMMdd``, by partition."""
        return self.read("packets_fact").where(F.col("date_day").between(first_day, last_day))

    def append(self, table: str, rows: DataFrame, several_days: bool = False) -> int:
        """Append rows and return their number. Facts of ``several_days`` are rebalanced
        into few files per day, a day too big for one task being split; those of one day
        are written as they come, without a shuffle."""
        rules, seen = STAR_SCHEMA[table], Observation()
        rows = rows.select(*rules.schema.names)
        if rules.partition:
            rows = rows.withColumn(rules.partition, C.day_of_key(F.col("date_key")))
            if several_days:
                rows = rows.hint("rebalance", F.col(rules.partition))
        writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write
        if rules.partition:
            writer = writer.partitionBy(rules.partition)
        # Spark's committer deletes what another append to the same folder has not finished.
        work = f"{self._path(table)}/_append-{uuid.uuid4().hex}"
        writer.parquet(work)
        self._move_parts(work, self._path(table))
        return seen.get["rows"]

    def _move_parts(self, work: str, target: str) -> None:
        """Files of a finished write into the table, several at once, then the folder goes."""
        folder, fs = self._files(work)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        found = [*(fs.globStatus(path(folder, "part-*")) or []),
                 *(fs.globStatus(path(folder, "*=*/part-*")) or [])]

        def move(part) -> None:
            inside = part.getParent().getName() if "=" in part.getParent().getName() else ""
            into = path(f"{target}/{inside}" if inside else target)
            fs.mkdirs(into)
            _rename(fs, part, path(into, part.getName()))

        with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
            list(pool.map(move, [f.getPath() for f in found]))
        fs.delete(folder, True)

    def replace_users(self, state: DataFrame, since: int = 0, whole: bool = False) -> None:
        """The current rows after a change, and the rows it has closed, as one ``state``
        without rows closed before, or with all of them if ``whole``. A change is refused if
        another has been finished after the version ``since`` that it started from."""
        version = max(self._versions(), default=0) + 1
        folder = f"{self.location}/users_dim"
        claim = f"{folder}/_claim-{version}"
        if (since and since != version - 1) or not self._create_file(claim, str(version)):
            raise ChangedMeanwhile(
                f"another load changes users_dim: load again (if none runs, delete {claim})"
            )
        try:
            marker = f"{folder}/_whole-{version}"  # counts when the version does
            if whole:
                self._create_file(marker, str(version))
            else:
                marked, fs = self._files(marker)
                fs.delete(marked, False)  # of a failed change
            state = state.select(*STAR_SCHEMA[self.VERSIONED].schema.names)
            closed, current = state.where("not current_flag"), state.where("current_flag")
            closed.write.mode("overwrite").parquet(f"{folder}/closed/version={version}")
            current.write.mode("overwrite").parquet(f"{folder}/current/version={version}")
        finally:  # a finished version needs no claim, a failed one may be tried again
            claimed, fs = self._files(claim)
            fs.delete(claimed, False)
        self._drop_old("users_dim/current")
