"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDER = "tramline-scratch"
#: Rows that go to a Python task at once, in a session that has made scratch tables; Spark's own number is meant for short rows, not for texts.
ARROW_ROWS = 2_000
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a local one in local mode, as in tests, and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-tramline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{_FOLDER}/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: this cuts the lineage, and lost executors don't lose it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    schema = df.schema
    if not 0 < int(spark.conf.get(_ARROW)) <= ARROW_ROWS:
        spark.conf.set(_ARROW, ARROW_ROWS)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes this application's scratch tables; call it when results that rest on them have been written."""
    jvm, path = spark._jvm, shared_dir(spark)
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


#: Up to so many bytes of text and binary, a table is broadcast.
BROADCAST_BYTES = 128 << 20


def sized(df: DataFrame, rows: int) -> DataFrame:
    """df, with a broadcast hint if it has so many rows at most and its text, binary, arrays and structs are within BROADCAST_BYTES."""
    flat = [(c, F.octet_length(c)) for c, kind in df.dtypes if kind in ("string", "binary")]
    deep = [(c, F.octet_length(F.to_json(F.struct(c)))) for c, kind in df.dtypes if kind.startswith(("array", "struct", "map"))]
    wide = [F.coalesce(F.sum(size), F.lit(0)) for _, size in flat + deep]
    found = df.agg(F.count(F.lit(1)).alias("n"), sum(wide, F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if found["n"] <= rows and found["bytes"] <= BROADCAST_BYTES else df


def partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the cluster's settings have it; they follow the input, not this machine."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns in one struct, so that no name of theirs can clash with another."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def unpacked(df: DataFrame, columns: list[str], name: str = "row", **added: Column) -> DataFrame:
    """The columns of the struct, and added ones, which replace columns of the same name."""
    kept = [c for c in columns if c.lower() not in {a.lower() for a in added}]
    return df.select(*[F.col(name)[c].alias(c) for c in kept], *[a.alias(n) for n, a in added.items()])


def row_hash(row: str) -> Column:
    """A hash of a struct of columns of any type, maps and variants included, which have no order of their own."""
    return F.xxhash64(F.to_json(row))
