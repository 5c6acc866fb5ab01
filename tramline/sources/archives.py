"""Timetable archives: members of zip files as partitions, their CSV lines and XML elements as rows; and archives made by tasks."""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import at, whole

CSV, XML = r"(?i)(.*/)?[^/]*\.(txt|csv)", r"(?i)(.*/)?[^/]*\.xml"


def _archives(paths: list[str]) -> list[str]:
    """Files; of a folder, those that end in .zip."""
    out = []
    for path in paths:
        fs, inner = at(path)
        if fs.get_file_info(inner).type == pafs.FileType.Directory:
            base = path.rstrip("/")
            out += sorted(f"{base}/{f.path[len(inner.rstrip('/')) + 1 :]}" for f in fs.get_file_info(pafs.FileSelector(inner, recursive=True)) if f.is_file and f.base_name.lower().endswith(".zip") and not f.base_name.startswith("."))
        else:
            out.append(path)
    return out


class _Member(InputPartition):
    def __init__(self, archive: str, name: str):
        self.archive, self.name = archive, name


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.pattern, self.tag = json.loads(options["paths"]), options.get("pattern"), options.get("tag")

    def partitions(self) -> list[_Member]:
        """One for each member whose whole name matches. Only the directory of an archive, at its end, is read here."""
        pattern, out = re.compile(self.pattern or (XML if self.tag else CSV)), []
        for archive in _archives(self.paths):
            fs, inner = at(archive)
            with fs.open_input_file(inner) as f, zipfile.ZipFile(f) as z:
                out += [_Member(archive, i.filename) for i in z.infolist() if not i.is_dir() and pattern.fullmatch(i.filename)]
        return out or [_Member("", "")]

    def read(self, member: _Member) -> Iterator[tuple]:
        if not member.archive:
            return
        fs, inner = at(member.archive)
        with fs.open_input_file(inner) as f, zipfile.ZipFile(f) as z, z.open(member.name) as raw:
            for ordinal, (fields, item) in enumerate(_elements(raw, self.tag) if self.tag else _lines(raw)):
                yield (member.archive, member.name, ordinal, fields, item)


def _lines(raw) -> Iterator[tuple[dict, None]]:
    """Fields by the header; a line that is shorter lacks the rest, what is beyond the header is left out. A byte order mark is none of the header."""
    for line in csv.DictReader(io.TextIOWrapper(raw, "utf-8-sig", newline=""), restkey=None):
        yield {k.strip(): v for k, v in line.items() if k is not None and v is not None}, None


def _plain(name: str) -> str:
    return name.rpartition("}")[2]


def _elements(raw, tag: str) -> Iterator[tuple[dict, str]]:
    """Elements of a name (of any namespace): attributes, and the element's text as XML without namespaces. What is done is let go of."""
    path: list = []
    for event, element in ElementTree.iterparse(raw, events=("start", "end")):
        if event == "start":
            path.append(element)
            continue
        path.pop()
        if _plain(element.tag) == tag:
            for e in element.iter():
                e.tag = _plain(e.tag)
                for k in [k for k in e.attrib if "}" in k]:
                    e.attrib[_plain(k)] = e.attrib.pop(k)
            element.tail = None
            yield dict(element.attrib), ElementTree.tostring(element, encoding="unicode")
        if path and not any(_plain(e.tag) == tag for e in path):
            path[-1].remove(element)


class ArchiveMembers(DataSource):
    """format("archive_members"): options paths (JSON list of archives or folders), pattern (of whole member names), tag (then members are XML).

    Columns archive, member, ordinal, fields (of a CSV line; attributes of an element), item (the element as XML text).
    """

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return "archive string, member string, ordinal long, fields map<string,string>, item string"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def read_members(spark: SparkSession, paths: str | list[str], pattern: str | None = None, tag: str | None = None) -> DataFrame:
    """All matching members of archives, one partition each."""
    spark.dataSource.register(ArchiveMembers)
    options = {"paths": json.dumps([paths] if isinstance(paths, str) else paths)} | ({"pattern": pattern} if pattern else {}) | ({"tag": tag} if tag else {})
    return spark.read.format("archive_members").options(**options).load()


def read_table(spark: SparkSession, paths: str | list[str], name: str, columns: str) -> DataFrame:
    """A CSV table of archives, such as stops.txt, by the names of its columns (DDL): empty fields, columns that are not there, and values of another type are null."""
    rows = read_members(spark, paths, rf"(.*/)?{re.escape(name)}")
    schema = rows.sparkSession.createDataFrame([], columns).schema
    return rows.select("archive", "ordinal", *[F.nullif(F.col("fields")[f.name], F.lit("")).try_cast(f.dataType).alias(f.name) for f in schema])


def read_elements(spark: SparkSession, paths: str | list[str], tag: str, columns: str, pattern: str | None = None) -> DataFrame:
    """XML elements of archives as rows; attributes are columns that begin with an underscore."""
    rows = read_members(spark, paths, pattern, tag)
    return rows.select("archive", "member", "ordinal", F.from_xml("item", columns).alias("row")).select("archive", "member", "ordinal", "row.*")


def _write(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((a, m, v) for batch in batches for a, m, v in zip(*(c.to_pylist() for c in batch.columns)))
        row = next(rows, None)
        while row:
            archive, lines = row[0], 0
            with whole(f"{folder}/{archive}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                while row and row[0] == archive:
                    member = row[1]
                    with z.open(member, "w", force_zip64=True) as inner:
                        while row and row[:2] == (archive, member):
                            inner.write((row[2] or "").encode() + b"\n")
                            lines, row = lines + 1, next(rows, None)
            yield pa.RecordBatch.from_pydict({"archive": [archive], "lines": [lines]})

    return write


def write_archives(lines: DataFrame, folder: str) -> list[tuple[str, int]]:
    """Archives of members of lines (columns archive, member, ordinal, value), as a stream: a task holds no member. Gives names with counts of lines."""
    dealt = lines.select("archive", "member", "value", "ordinal").repartition("archive").sortWithinPartitions("archive", "member", "ordinal").select("archive", "member", "value")
    return sorted((r["archive"], r["lines"]) for r in dealt.mapInArrow(_write(folder.rstrip("/")), "archive string, lines long").collect())
