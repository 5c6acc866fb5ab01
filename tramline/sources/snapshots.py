"""Readers of polled snapshots and dimensions: JSON envelopes, GraphQL documents, pages, CSV, XML rows, binary inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATION = "scode string, sname string, sorigin string, sactive boolean, savailable boolean, scoordinate struct<x:double,y:double>, smetadata variant"
BAY = "scode string, pcode string, savailable boolean"
BIKE = "scode string, pcode string, sactive boolean, savailable boolean, scoordinate struct<x:double,y:double>, smetadata variant"
PLUG = "scode string, pcode string, sname string, mvalue variant, smetadata variant"
MEASUREMENT = "scode string, sname string, prlineage string, tname string, mvalue variant"
ROUTE = "struct<gtfsId:string,mode:string,shortName:string,longName:string,agency:struct<name:string,url:string,gtfsId:string>>"
STOP = (
    "gtfsId string, code string, desc string, lat double, lon double, name string, parentStation struct<gtfsId:string,name:string>, "
    f"vehicleType int, vehicleMode string, platformCode string, url string, routes array<{ROUTE}>"
)
PLACE = "gtfsId string, lat double, lon double, name string"


def read_envelope(spark: SparkSession, path: str, row: str, under: str = "data") -> DataFrame:
    """The rows of `{data: [...]}` documents, with `ordinal`, their place. A document without the list gives no rows."""
    whole = spark.read.schema(f"`{under}` array<struct<{_fields(row)}>>").json(path, multiLine=True)
    return whole.select(F.posexplode(under).alias("ordinal", "row")).select("row.*", F.col("ordinal").cast("bigint"))


def _fields(row: str) -> str:
    """Columns `a t, b u` as the fields of a struct, `a:t, b:u`."""
    out, depth, part = [], 0, ""
    for ch in row + ",":
        if ch == "," and not depth:
            name, _, kind = part.strip().partition(" ")
            out.append(f"{name}:{kind}")
            part = ""
            continue
        depth += (ch in "<(") - (ch in ">)")
        part += ch
    return ",".join(out)


def read_collections(spark: SparkSession, path: str, rows: dict[str, str], under: str = "data") -> dict[str, DataFrame]:
    """One GraphQL reply as a table per collection; a collection that is not there is empty."""
    schema = ",".join(f"{name}:array<struct<{_fields(row)}>>" for name, row in rows.items())
    whole = spark.read.schema(f"`{under}` struct<{schema}>").json(path, multiLine=True)
    return {name: whole.select(F.posexplode(f"{under}.{name}").alias("ordinal", "row")).select("row.*", F.col("ordinal").cast("bigint")) for name in rows}


def read_items(spark: SparkSession, paths: str | list[str], item: str) -> DataFrame:
    """The `Items` of one or many page documents; `ordinal` counts within a page, `page` is its file."""
    whole = spark.read.schema(f"Items array<struct<{_fields(item)}>>, TotalPages int").json(paths, multiLine=True)
    return whole.select(F.input_file_name().alias("page"), F.posexplode("Items").alias("ordinal", "row")).select("row.*", "page", "ordinal")


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header; every column is text, quoted fields may hold commas and doubled quotes, empty is empty text."""
    return spark.read.csv(path, header=True, inferSchema=False, escape='"', multiLine=True, emptyValue="").fillna("")


def read_xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Elements of a timetable file as rows."""
    return spark.read.schema(schema).xml(path, rowTag=row_tag)


def read_binary(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files as path, modificationTime, length and content, for inputs that other programs decode."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
