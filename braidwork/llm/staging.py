"""Tables and files in the folder that the whole cluster shares.

Work that must not be repeated (or must survive a lost executor) is written as
Parquet below ``spark.checkpoint.dir`` and read again, which also cuts lineage.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session; a local one is set only in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"/tmp/checkpoints/{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column has it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def stage(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = fresh_path(df.sparkSession, label)
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.staged_at = path
    return written


def unstage(df: DataFrame) -> None:
    """Remove a table that ``stage`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def open_folder(uri: str):
    """(filesystem, path) of a folder in any store that pyarrow can write.

    s3a and s3n are Hadoop's names of what pyarrow calls s3."""
    from pyarrow import fs

    scheme = urlparse(uri).scheme
    if scheme in ("s3a", "s3n"):
        uri = "s3" + uri[len(scheme) :]
    if scheme:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(uri)


class NewFile:
    """``uri/name``, written through ``out``; it appears under its name at ``finish``.

    So a second attempt of a task, or a speculative twin, can do no harm."""

    def __init__(self, uri: str, name: str):
        self.store, folder = open_folder(uri)
        self.store.create_dir(folder, recursive=True)
        self.part, self.path = f"{folder}/.{name}.{uuid.uuid4().hex}", f"{folder}/{name}"
        self.out = self.store.open_output_stream(self.part)

    def finish(self) -> None:
        self.out.close()
        self.store.move(self.part, self.path)


def put_file(uri: str, name: str, write) -> None:
    """Write ``uri/name`` through ``write(stream)``."""
    new = NewFile(uri, name)
    write(new.out)
    new.finish()
