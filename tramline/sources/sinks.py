"""Writers: RFC 4180 CSV, JSON, YAML facets, replacement by source, publication of a whole version. Documents of one file are in documents.py."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """CSV after RFC 4180 with a header: text is quoted, numbers are bare, quotes are doubled, null is an empty field."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    quoted = {c: F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')) for c in texts}
    line = F.concat_ws(",", *[F.coalesce(quoted.get(c, F.col(c).cast("string")), F.lit("")) for c in df.columns])
    header = df.sparkSession.createDataFrame([(",".join(df.columns),)], "value string")
    df.select(line.alias("value")).write.mode("overwrite").text(f"{path}/rows")
    header.coalesce(1).write.mode("overwrite").text(f"{path}/header")


def read_csv_text(df: DataFrame, path: str) -> DataFrame:
    """Reads write_csv's rows again, with the schema of df."""
    return df.sparkSession.read.schema(df.schema).csv(f"{path}/rows", escape='"', multiLine=True, nullValue="\u0000", emptyValue="")


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines that keep nulls."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def to_yaml(document, indent: int = 0) -> str:
    """A document of mappings, lists and scalars as YAML."""
    pad, out = "  " * indent, []
    if isinstance(document, dict):
        for k, v in document.items():
            out.append(f"{pad}{_scalar(k)}:" + (f"\n{to_yaml(v, indent + 1)}" if isinstance(v, dict | list) and v else f" {_scalar(v)}"))
    else:
        for v in document:
            body = to_yaml(v, indent + 1) if isinstance(v, dict | list) and v else f"{pad}  {_scalar(v)}"
            out.append(f"{pad}- {body.lstrip()}")
    return "\n".join(out)


def _scalar(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int | float):
        return str(v)
    if isinstance(v, dict | list):
        return "{}" if isinstance(v, dict) else "[]"
    plain = v and v == v.strip() and v.replace("_", "").replace("-", "").replace(" ", "").isalnum() and not v[0].isdigit() and v.lower() not in ("true", "false", "null", "yes", "no", "on", "off")
    return v if plain and v.isascii() and v[0] != "-" else "'" + v.replace("'", "''") + "'" if "\n" not in v else '"' + v.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n") + '"'


def replaced_by_source(current: DataFrame, incoming: DataFrame, source: str = "source", sources: list[str] | None = None) -> DataFrame:
    """current without the rows of the incoming rows' sources (or of those named), and the incoming rows."""
    if sources is not None:
        kept = current.filter(~F.coalesce(F.col(source).isin(sources), F.lit(False)))
    else:
        kept = current.join(incoming.select(source).distinct(), source, "left_anti").select(current.columns)
    return kept.unionByName(incoming)


def replace_partitions(incoming: DataFrame, path: str, source: str = "source") -> None:
    """Overwrites only the incoming rows' sources in a table partitioned by source; readers never see it without them."""
    incoming.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(source).parquet(path)


#: Versions that stay beside the current one, for readers that have begun.
KEPT = 1


def publish(df: DataFrame, path: str, version: str | None = None, keep: int = KEPT) -> str:
    """Writes a new version beside the old ones, and then renames a pointer file over the old one, so there is a whole
    version for readers at any time, also if this ends midway. A store without renames that overwrite refuses.

    A version that is named (by the number of a batch, say) is written over when it comes again. Afterwards versions
    are removed but for the current one and the `keep` newest others.
    """
    spark = df.sparkSession
    version = version or uuid.uuid4().hex
    df.write.mode("overwrite").parquet(f"{path}/{version}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.FileSystem.get(spark._jvm.java.net.URI(path), spark._jsc.hadoopConfiguration())
    pointer, new = hadoop.Path(f"{path}/CURRENT"), hadoop.Path(f"{path}/CURRENT-{version}")
    out = fs.create(new, True)
    out.write(bytearray(version.encode()))
    out.close()
    files = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(new, pointer, overwrite)
    others = sorted((f for f in fs.listStatus(hadoop.Path(path)) if f.isDirectory() and f.getPath().getName() != version), key=lambda f: -f.getModificationTime())
    for old in others[keep:]:
        fs.delete(old.getPath(), True)
    return version


def published(spark, path: str) -> DataFrame:
    """The version that the pointer names."""
    version = spark.read.text(f"{path}/CURRENT").first()["value"]
    return spark.read.parquet(f"{path}/{version}")
