"""The shared folder for what a job must not lose, and files in it that Python workers can write and read."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession

from ..shared import new_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read again: work up to here isn't repeated when executors go."""
    spark, path = df.sparkSession, new_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made and that nothing needs any more."""
    for table in tables:
        remove(table.sparkSession, table._written_to)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def filesystem(uri: str):
    """An Arrow file system (file, hdfs, s3, gs, ...) and the path within it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    parsed = urlparse(uri)
    if parsed.scheme == "file":
        return fs.LocalFileSystem(), unquote(parsed.path)
    return fs.FileSystem.from_uri(uri)


class NewFile:
    """A file that appears under its name only when it is whole; a repeated task attempt writes another file."""

    def __init__(self, folder: str, name: str):
        self.fs, base = filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        stem, ext = os.path.splitext(name)
        self.path = f"{base}/{stem}-{uuid.uuid4().hex}{ext}"
        self.uri = folder.rstrip("/") + "/" + os.path.basename(self.path)
        self.out = self.fs.open_output_stream(self.path + ".part")
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> str:
        self.out.close()
        self.fs.move(self.path + ".part", self.path)
        return self.uri


def opened(uri: str):
    """A file that can be read at any position."""
    system, path = filesystem(uri)
    return system.open_input_file(path)
