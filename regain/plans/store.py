"""Written tables that cut lineage: scratch tables for one query, layer tables for a full build."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession

from regain.plans import versions
from regain.plans.files import delete_folder, file_system


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, local mode gets a temporary folder; a cluster must name a shared one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="regain-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Replace a plain folder of Parquet files at ``path``, for readers that know no versions, and return it read back.

    Tables of a build are versions instead (see ``Layers``). The new table is written beside the old one and then takes its place, so ``df`` may read the old table, and a
    write that fails leaves the old table as it was. Other frames over the old files end with them.
    """
    spark = df.sparkSession
    fresh, old = f"{path}.{uuid.uuid4().hex}.new", f"{path}.{uuid.uuid4().hex}.old"
    files, make = file_system(spark, path)
    try:
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(fresh)
    except BaseException:
        files.delete(make(fresh), True)
        raise
    replaced = files.exists(make(path)) and files.rename(make(path), make(old))
    if not files.rename(make(fresh), make(path)):
        if replaced:
            files.rename(make(old), make(path))
        raise OSError(f"cannot move {fresh} to {path}")
    if replaced:
        files.delete(make(old), True)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Scratch:
    """Tables one query writes and reads back. They survive the loss of an executor.

    They are deleted by ``close``, at the end of a ``with`` block, and at the latest when the driver's Python ends.
    """

    spark: SparkSession

    @cached_property
    def root(self) -> str:
        root = f"{scratch_root(self.spark)}/regain-{uuid.uuid4().hex}"
        atexit.register(self._delete_quietly, root)
        return root

    def _delete_quietly(self, root: str) -> None:
        with contextlib.suppress(Py4JError, OSError):  # the session may be gone
            delete_folder(self.spark, root)

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex}"
        df.write.parquet(path, compression=versions.COMPRESSION)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        if "root" in self.__dict__:
            delete_folder(self.spark, self.root)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()


@dataclass(frozen=True)
class Layers:
    """Named tables, one folder per layer, each with its versions. ``layouts`` says how a table lies on disk."""

    root: str
    layers: dict[str, str] = field(default_factory=dict)
    layouts: dict[str, versions.Layout] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/{self.layers.get(name, 'intermediate')}/{name}"

    def put(self, name: str, df: DataFrame, part: Callable[[Column], DataFrame] | None = None) -> DataFrame:
        return versions.put(df, self.path(name), self.layouts.get(name, versions.PLAIN), part=part)

    def get(self, spark: SparkSession, name: str) -> DataFrame:
        return versions.read(spark, self.path(name))
