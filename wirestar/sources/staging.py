"""Intermediate results written once to the cluster's shared checkpoint folder.

A staged table cuts the lineage, and its rows keep what was assigned to them (row
positions, surrogate keys) when an executor is lost and a later stage is recomputed.
It is columnar, so a second reader that needs one column reads one column.
"""

from __future__ import annotations

import contextlib
import itertools
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local session may go without: it
    gets a temporary folder, which on a cluster other machines could not read."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wirestar-"))
    return context.getCheckpointDir()


_owner: ContextVar[str | None] = ContextVar("staging_owner", default=None)


@contextlib.contextmanager
def owned_staging(spark: SparkSession) -> Iterator[Staging]:
    """A block that owns what is staged inside it. A query returns before its result is read,
    so it cannot drop what it has staged; a caller that reads the result inside such a block
    leaves nothing behind."""
    with Staging(spark) as area:
        token = _owner.set(area.folder)
        try:
            yield area
        finally:
            _owner.reset(token)


@dataclass(frozen=True)
class Staged:
    df: DataFrame
    rows: int
    seen: Mapping[str, object] = field(default_factory=dict)


class Staging:
    """Staged tables of one job. ``with Staging(spark) as staging`` drops them at the end,
    unless it ends with an error;
    otherwise the ``owned_staging`` block around it does, or else they stay as long as the
    checkpoint folder keeps them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{_owner.get() or checkpoint_dir(spark)}/wirestar-{uuid.uuid4().hex}"
        self._numbers = itertools.count(1)

    def path(self, label: str) -> str:
        return f"{self.folder}/{next(self._numbers):03d}-{label}"

    def write(
        self, df: DataFrame, label: str, observe: Mapping[str, Column] | None = None
    ) -> Staged:
        """Write ``df`` and return it as read back, with its row count and the aggregates
        to ``observe``. These are taken during the write and cost no extra pass."""
        path, seen = self.path(label), Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        metrics += [column.alias(name) for name, column in (observe or {}).items()]
        df.observe(seen, *metrics).write.parquet(path)
        values = dict(seen.get)
        return Staged(
            self.spark.read.schema(df.schema).parquet(path), values.pop("rows"), values
        )

    def clear(self) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        hadoop.getFileSystem(conf).delete(hadoop, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, kind, *exc) -> None:
        """After an error the staged tables stay: one may be the only copy of rows that a
        failed write was to replace."""
        if kind is None:
            self.clear()
