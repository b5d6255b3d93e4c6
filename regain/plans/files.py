"""Folders and files through the file system the cluster names, whatever it is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system of the path, function that makes its paths)."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def delete_folder(spark: SparkSession, path: str) -> None:
    files, make = file_system(spark, path)
    files.delete(make(path), True)


def move_files(spark: SparkSession, source: str, target: str, name: Callable[[int], str]) -> None:
    """Move the part files of a written folder, giving each a name by its place in the listing."""
    files, make = file_system(spark, source)
    files.mkdirs(make(target))
    parts = sorted(f.getPath().toString() for f in files.listStatus(make(source)) if f.getPath().getName().startswith("part-"))
    for k, part in enumerate(parts):
        if not files.rename(make(part), make(f"{target}/{name(k)}")):
            raise OSError(f"cannot move {part} to {target}")
