"""Tables committed by pointer: data folders that never change, and small numbered files that say which are current.

A table is a folder. Each write puts its data into a new subfolder and then creates the next pointer file under
``_commits``; readers take the highest pointer that is complete and keep to its folders. Nothing is renamed and nothing
is overwritten, so a reader never meets a gap, and a writer that dies between any two steps leaves the last table as it
was: data without a pointer is no version, and neither is a half-written pointer. Creating a pointer fails where its
number exists, so two writers get two numbers. Old versions go when a newer one is committed, all but the last ``KEEP``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regain.plans.files import delete_folder, file_system

KEEP = 2  # versions: the current one, and the one that open readers may still hold
COMPRESSION = "zstd"  # of Parquet files: about a third smaller than Spark's default on these tables
# Of the tables of a build: at level 5 (3 is the default; 9 takes an eighth more time for 2 % less), and with the encodings by
# difference of the second Parquet format
TABLE_OPTIONS = {
    "compression": COMPRESSION, "parquet.compression.codec.zstd.level": "5", "parquet.writer.version": "PARQUET_2_0",
}
ROWS_PER_RANGE, SAMPLED_PER_RANGE = 50_000, 20  # of a file of a range; its bounds are taken from so many of its rows
ORPHAN_HOURS = 24  # data without a pointer may belong to a writer at work until it is this old


@dataclass(frozen=True)
class Layout:
    """How a table lies on disk.

    ``derive`` adds columns (SQL by name), ``partition_by`` makes folders of them, ``range_by`` deals rows to files of
    disjoint ranges and sorts them. ``bucket_by`` instead deals rows to ``buckets`` files by hash, in the same way in
    every table with the same number, so that such tables join without an exchange. The buckets are written in ``turns``,
    so that an exchange holds one share of the rows at a time. ``sort_by`` sorts rows within each file and needs no
    exchange. ``no_dictionary`` names columns whose values are many and near each other in the order of the rows: they take
    less as differences from the value before than with a dictionary.
    """

    derive: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    range_by: tuple[str, ...] = ()
    bucket_by: str | None = None
    buckets: int = 0
    turns: int = 1
    sort_by: tuple[str, ...] = ()
    no_dictionary: tuple[str, ...] = ()

    def options(self) -> dict[str, str]:
        return TABLE_OPTIONS | {f"parquet.enable.dictionary#{name}": "false" for name in self.no_dictionary}


PLAIN = Layout()


@dataclass(frozen=True)
class Parts:
    """The rows of one partition by a condition, and rows of few columns that hold the values of all partitions."""

    of: Callable[[Column], DataFrame]
    seen: DataFrame

    def __call__(self, same: Column) -> DataFrame:
        return self.of(same)


@dataclass(frozen=True)
class Version:
    """One committed state: data folders, schema and layout, and what its writer noted."""

    number: int
    folders: tuple[str, ...]
    schema: T.StructType
    layout: Layout = PLAIN
    notes: dict = field(default_factory=dict)


def _commits(path: str) -> str:
    return f"{path}/_commits"


def _list(spark: SparkSession, path: str) -> list:
    files, make = file_system(spark, path)
    return list(files.listStatus(make(path))) if files.exists(make(path)) else []


def _read_text(spark: SparkSession, path: str) -> str:
    files, make = file_system(spark, path)
    stream = files.open(make(path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _parse(text: str, number: int) -> Version | None:
    """None for a pointer that its writer did not finish."""
    try:
        found = json.loads(text)
    except ValueError:
        return None
    layout = Layout(**{k: tuple(v) if isinstance(v, list) else v for k, v in found["layout"].items()})
    return Version(number, tuple(found["folders"]), T.StructType.fromJson(found["schema"]), layout, found["notes"])


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = [f.getPath().getName() for f in _list(spark, _commits(path))]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _pointer(path: str, number: int) -> str:
    return f"{_commits(path)}/{number:020d}.json"


def versions(spark: SparkSession, path: str) -> list[Version]:
    """Every committed version, oldest first."""
    found = (_parse(_read_text(spark, _pointer(path, n)), n) for n in _numbers(spark, path))
    return [v for v in found if v is not None]


def current(spark: SparkSession, path: str) -> Version | None:
    """The latest committed version; pointers are read from the newest back, so one is read as a rule."""
    for number in reversed(_numbers(spark, path)):
        found = _parse(_read_text(spark, _pointer(path, number)), number)
        if found is not None:
            return found
    return None


def _table_name(folder: str) -> str:
    return "regain_" + folder.rstrip("/").rsplit("-", 1)[-1]


def read_version(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """The frame over one version. It stays as it is whatever is committed later, until its folders are removed."""
    folders = [f"{path}/{f}" for f in version.folders]
    layout = version.layout
    if layout.bucket_by and len(folders) == 1:
        # buckets are known to Spark by a table only
        name = _table_name(folders[0])
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.schema.fields)
            key = layout.bucket_by
            spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                f"INTO {layout.buckets} BUCKETS LOCATION '{folders[0]}'"
            )
        return spark.table(name)
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*folders)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The frame over the current version, resolved now."""
    version = current(spark, path)
    if version is None:
        raise FileNotFoundError(f"no committed table at {path}")
    return read_version(spark, path, version)


def arranged(df: DataFrame, layout: Layout) -> DataFrame:
    """The rows as ``layout`` wants them before they are written."""
    df = df.withColumns({name: F.expr(sql) for name, sql in layout.derive.items()}) if layout.derive else df
    if layout.bucket_by:
        return df.repartition(layout.buckets, layout.bucket_by)
    if layout.range_by:
        return df.repartitionByRange(*layout.range_by).sortWithinPartitions(*layout.range_by)
    return df.sortWithinPartitions(*layout.sort_by) if layout.sort_by else df


def write_data(df: DataFrame, path: str, layout: Layout = PLAIN, watch: Callable[[DataFrame], DataFrame] = lambda df: df) -> str:
    """Write a data folder under the table and return its name. It is no version before it is committed.

    ``watch`` may add metrics: it gets the frame as arranged, so they are counted in the tasks that write, once a row. It
    is called for each write of a table that is written in several.
    """
    spark, name = df.sparkSession, f"v-{uuid.uuid4().hex}"
    folder = f"{path}/{name}"
    try:
        if layout.bucket_by:
            files, make = file_system(spark, path)
            files.mkdirs(make(path))
            turn = F.pmod(bucket_of(layout.bucket_by, layout.buckets), F.lit(layout.turns))
            for k in range(layout.turns):
                rows = df if layout.turns == 1 else df.filter(turn == k)
                writer = watch(arranged(rows, layout)).write.options(**layout.options()).format("parquet").option("path", folder)
                writer = writer.mode("append" if k else "error").bucketBy(layout.buckets, layout.bucket_by)
                writer.sortBy(layout.bucket_by).saveAsTable(_table_name(folder))
        else:
            writer = watch(arranged(df, layout)).write.options(**layout.options())
            writer.partitionBy(*layout.partition_by).parquet(folder) if layout.partition_by else writer.parquet(folder)
    except BaseException:
        delete_folder(spark, folder)
        raise
    return name


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket Spark puts a key in."""
    return F.pmod(F.hash(key), F.lit(buckets))


def sampled_keys(df: DataFrame, layout: Layout) -> DataFrame:
    """A few rows of each range: the partition columns and the keys that order the rows of a partition. Rows are picked by a
    hash of the last key, which is applied before the joins of ``df`` where it is a column of their rows."""
    picked = F.pmod(F.xxhash64(layout.range_by[-1]), F.lit(max(1, ROWS_PER_RANGE // SAMPLED_PER_RANGE))) == 0
    rows = df.withColumns({name: F.expr(sql) for name, sql in layout.derive.items()}) if layout.derive else df
    return rows.filter(picked).select(*layout.partition_by, *[n for n in layout.range_by if n not in layout.partition_by])


def range_bounds(df: DataFrame, layout: Layout) -> dict[tuple, list[tuple]]:
    """The lower bounds of all ranges but the first, for each partition."""
    sampled, width = sampled_keys(df, layout), len(layout.partition_by)
    keys = [F.col(n) for n in sampled.columns[width:]]
    place = F.row_number().over(Window.partitionBy(*layout.partition_by).orderBy(*keys)) if keys else F.lit(1)
    bounds = sampled.withColumn("_at", place).filter(F.col("_at") % F.lit(SAMPLED_PER_RANGE) == 0).drop("_at")
    found: dict[tuple, list[tuple]] = {}
    for row in bounds.distinct().orderBy(*sampled.columns).collect():  # a row for each file
        found.setdefault(tuple(row[:width]), []).append(tuple(row[width:]))
    return found


def in_ranges(df: DataFrame, layout: Layout, bounds: list[tuple]) -> DataFrame:
    """The rows of one partition, as ``arranged`` gives them, but by known bounds: no rows are made to look for them."""
    df = df.withColumns({name: F.expr(sql) for name, sql in layout.derive.items()}) if layout.derive else df
    fields = [df.schema[n] for n in layout.range_by if n not in layout.partition_by]
    if not bounds:
        return df.repartition(1).sortWithinPartitions(*layout.range_by)
    lower = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, fields)]) for b in bounds])
    key = F.struct(*[F.col(f.name) for f in fields])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    # by bisection: how many bounds are not above the key
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(lower, at + step - 1) <= key, at + step).otherwise(at))
    return df.repartitionById(len(bounds) + 1, place).sortWithinPartitions(*layout.range_by)


def write_by_partition(
    df: DataFrame, path: str, layout: Layout, watch: Callable[[DataFrame], DataFrame] = lambda df: df,
    part: Callable[[Column], DataFrame] | None = None,
) -> str:
    """As ``write_data`` for a layout of partitions, but one partition at a time: what the exchanges of ``df`` and
    the one that makes the ranges hold, ends with its partition. ``part`` gives the rows of ``df`` that a condition on the
    derived columns' inputs holds for, where its author can apply it before the joins of ``df``. The bounds of all ranges are
    looked for beforehand, in a few rows: an exchange by range makes all its rows twice, once to find them."""
    spark, name = df.sparkSession, f"v-{uuid.uuid4().hex}"
    folder, part = f"{path}/{name}", part or df.filter
    sources = {n: F.expr(layout.derive[n]) if n in layout.derive else F.col(n) for n in layout.partition_by}
    seen = part.seen if isinstance(part, Parts) else df
    values = seen.select(*[c.alias(n) for n, c in sources.items()]).distinct().collect()  # a folder each
    bounds = range_bounds(df, layout) if layout.range_by else {}
    try:
        for value in values:
            same = reduce(lambda a, b: a & b, [sources[n].eqNullSafe(F.lit(v)) for n, v in value.asDict().items()])
            own = part(same)
            rows = watch(in_ranges(own, layout, bounds.get(tuple(value), [])) if layout.range_by else arranged(own, layout))
            rows.write.mode("append").options(**layout.options()).partitionBy(*layout.partition_by).parquet(folder)
        if not values:
            watch(arranged(df, layout)).write.options(**layout.options()).partitionBy(*layout.partition_by).parquet(folder)
    except BaseException:
        delete_folder(spark, folder)
        raise
    return name


def commit(
    spark: SparkSession, path: str, folders: tuple[str, ...], schema: T.StructType, layout: Layout = PLAIN,
    notes: dict | None = None, keep: int = KEEP,
) -> Version:
    """Make these folders the current version, then remove what is older than the last ``keep`` versions."""
    files, make = file_system(spark, path)
    files.mkdirs(make(_commits(path)))
    body = json.dumps({"folders": folders, "schema": json.loads(schema.json()), "layout": asdict(layout), "notes": notes or {}})
    number = max(_numbers(spark, path), default=0)
    while True:
        number += 1
        try:
            stream = files.create(make(_pointer(path, number)), False)
            break
        except Exception as error:  # another writer took the number
            if not files.exists(make(_pointer(path, number))):
                raise error
    try:
        stream.write(bytearray(body.encode()))
    finally:
        stream.close()
    expire(spark, path, keep)
    return Version(number, tuple(folders), schema, layout, notes or {})


def expire(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove all but the last ``keep`` versions, and data that a writer left behind over ``ORPHAN_HOURS`` ago."""
    known = versions(spark, path)
    kept, gone = known[-keep:], known[:-keep]
    used = {f.split("/")[0] for v in kept for f in v.folders}
    for version in gone:  # pointers first: what they lose is out of every reader's sight
        delete_folder(spark, _pointer(path, version.number))
    parts = {f for v in gone for f in v.folders} - {f for v in kept for f in v.folders}
    left = {f.split("/")[0] for f in parts} - used
    for part in parts:  # a part of a data folder whose other parts are in use
        if part.split("/")[0] in used:
            delete_folder(spark, f"{path}/{part}")
    old = (time.time() - ORPHAN_HOURS * 3600) * 1000
    for found in _list(spark, path):
        name = found.getPath().getName()
        if name.startswith("v-") and name not in used and (name in left or found.getModificationTime() < old):
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(name)}")
            delete_folder(spark, f"{path}/{name}")


def put(
    df: DataFrame, path: str, layout: Layout = PLAIN, keep: int = KEEP, accept: Callable[[DataFrame], None] | None = None,
    watch: Callable[[DataFrame], DataFrame] = lambda df: df, part: Callable[[Column], DataFrame] | None = None,
) -> DataFrame:
    """Write ``df`` as the table's next version and return the frame over it. ``df`` may read an older version.

    ``accept`` sees the written frame before it is committed; if it raises, the table stays as it was. ``part`` makes the
    rows of one partition (see ``write_by_partition``).
    """
    spark = df.sparkSession
    one_by_one = layout.partition_by and (layout.range_by or part)
    name = write_by_partition(df, path, layout, watch, part) if one_by_one else write_data(df, path, layout, watch)
    derived = [T.StructField(n, df.select(F.expr(sql).alias(n)).schema[n].dataType) for n, sql in layout.derive.items()]
    # partition columns come last when they are read back
    fields = [*df.schema.fields, *derived]
    fields = [f for f in fields if f.name not in layout.partition_by] + [f for f in fields if f.name in layout.partition_by]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    written = Version(0, (name,), schema, layout)
    if accept is not None:
        try:
            accept(read_version(spark, path, written))
        except BaseException:
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(name)}")
            delete_folder(spark, f"{path}/{name}")
            raise
    return read_version(spark, path, commit(spark, path, (name,), schema, layout, keep=keep))


def even_buckets(frames: list[DataFrame], key: str, rows_per_bucket: int, most_uneven: float) -> Layout:
    """Buckets by ``key`` for tables that join on it, sized by the first; none where a key holds so much that one bucket
    would be ``most_uneven`` times the mean: an exchange with the adaptive skew join serves such tables better."""
    total = frames[0].count()
    buckets = max(8, -(-total // rows_per_bucket))
    place = bucket_of(key, buckets)
    for df in frames:
        counts = df.groupBy(place.alias("bucket")).count().agg(F.max("count"), F.sum("count")).first()
        if counts[0] and counts[0] > most_uneven * max(rows_per_bucket / 8, counts[1] / buckets):
            return PLAIN
    return Layout(bucket_by=key, buckets=buckets)
