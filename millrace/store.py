"""Small versioned tables in a shared folder, one folder per batch."""

from __future__ import annotations

import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


def delete_all(spark: SparkSession, paths: Iterable[str], at_once: int = 16) -> None:
    """Delete folders, some at a time; the names pass by and are not held together."""
    paths = iter(paths)
    with ThreadPoolExecutor(at_once) as pool:
        while some := list(islice(paths, 1000)):
            for _ in pool.map(lambda path: delete(spark, path), some):
                pass


def publish_in_order(spark: SparkSession, staging: str, path: str) -> None:
    """Move the data files of a folder to another, in the order of their names, each dated after those before.

    Files there already stay the oldest. Only names and dates are touched.
    """
    fs, source = _path(spark, staging)
    _, target = _path(spark, path)
    fs.mkdirs(target)

    def data_files(folder):
        files = [f for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
        return sorted(files, key=lambda f: f.getPath().getName())

    new = data_files(source)
    newest = max((f.getModificationTime() for f in data_files(target)), default=0)
    first = max(int(time.time() * 1000) - len(new), newest + 1)
    for i, file in enumerate(new):
        name = file.getPath().getName()
        fs.setTimes(file.getPath(), first + i, -1)
        if not fs.rename(file.getPath(), _path(spark, f"{path}/{name}")[1]):
            raise OSError(f"cannot publish {name} to {path}")
    fs.delete(source, True)


class BatchTable:
    """Rows of batch N live in ``batch=N``; writing a batch again replaces it."""

    def __init__(self, spark: SparkSession, path: str, schema: str | None = None) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    def folder(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self.folder(batch_id))

    def numbers(self) -> list[int]:
        """Batches that were written to the end."""
        fs, target = _path(self.spark, self.path)
        if not fs.exists(target):
            return []
        names = [entry.getPath().getName() for entry in fs.listStatus(target)]
        found = [int(name[6:]) for name in names if name.startswith("batch=")]
        return [n for n in found if exists(self.spark, f"{self.folder(n)}/_SUCCESS")]

    def has(self, batch_id: int) -> bool:
        return exists(self.spark, self.folder(batch_id))

    def read(self, batch_id: int) -> DataFrame:
        reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read
        return reader.parquet(self.folder(batch_id))

    def read_range(self, first: int, last: int) -> DataFrame | None:
        """Batches ``first`` to ``last`` that exist, or None."""
        found = [self.folder(i) for i in range(first, last + 1) if self.has(i)]
        if not found:
            return None
        reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read
        return reader.parquet(*found)

    def read_all(self) -> DataFrame:
        """All batches, with the ``batch`` column."""
        reader = self.spark.read
        if self.schema:
            reader = reader.schema(f"{self.schema}, batch bigint")
        return reader.parquet(self.path)

    def drop(self, batch_id: int) -> None:
        delete(self.spark, self.folder(batch_id))
