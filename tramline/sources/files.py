"""Files in the shared folders, from tasks as well as from the driver."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def at(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def exists(path: str) -> bool:
    fs, inner = at(path)
    return fs.get_file_info(inner).type != pafs.FileType.NotFound


@contextmanager
def whole(path: str) -> Iterator:
    """A stream to write a file by, which gets its name when all of it is there; after an error what was there before stays."""
    fs, inner = at(path)
    folder, _, name = inner.rpartition("/")
    fs.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{name}-{uuid.uuid4().hex}"
    try:
        with fs.open_output_stream(temporary) as out:
            yield out
        fs.move(temporary, inner)
    except BaseException:
        if fs.get_file_info(temporary).type != pafs.FileType.NotFound:
            fs.delete_file(temporary)
        raise


def delete(path: str) -> None:
    """Deletes a folder, if it is there."""
    fs, inner = at(path)
    if fs.get_file_info(inner).type == pafs.FileType.Directory:
        fs.delete_dir(inner)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share; in local mode, where that is unset, a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-tramline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tramline-core/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
