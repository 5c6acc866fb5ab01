"""One document from many tasks: JSON envelopes, JSON arrays and CSV files with their header.

Tasks write fragments beside the document. The commit joins head, fragments in order and tail in a new file, a block at
a time, and gives it the document's name; until then readers have the old one.
"""

from __future__ import annotations

import json
import uuid

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .files import at, delete, whole

#: Bytes that are held while fragments are joined.
BLOCK = 4 << 20


class _Fragment(WriterCommitMessage):
    def __init__(self, order: int, path: str | None, rows: int):
        self.order, self.path, self.rows = order, path, rows


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.head, self.between, self.tail = (json.loads(options.get(k, '""')) for k in ("head", "between", "tail"))
        self.folder = f"{self.path}.fragments-{uuid.uuid4().hex}"

    def write(self, iterator) -> _Fragment:
        """A task's rows, one after the other. An attempt has a file of its own, so a repeated task does no harm."""
        task = TaskContext.get()
        fs, folder = at(self.folder)
        fs.create_dir(folder, recursive=True)
        name, rows = f"{folder}/{task.partitionId():08d}-{task.taskAttemptId()}", 0
        with fs.open_output_stream(name) as out:
            for batch in iterator:
                texts = [v for v in batch.column(0).to_pylist() if v is not None]
                if texts:
                    out.write(((self.between if rows else "") + self.between.join(texts)).encode())
                    rows += len(texts)
        return _Fragment(task.partitionId(), f"{self.folder}/{name.rpartition('/')[2]}", rows)

    def commit(self, messages: list[_Fragment | None]) -> None:
        """Head, fragments by partition, tail. A failure here leaves the old document."""
        with whole(self.path) as out:
            out.write(self.head.encode())
            first = True
            for m in sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.order):
                if not first:
                    out.write(self.between.encode())
                first = False
                fs, inner = at(m.path)
                with fs.open_input_stream(inner) as part:
                    while block := part.read(BLOCK):
                        out.write(block)
            out.write(self.tail.encode())
        delete(self.folder)

    def abort(self, messages: list[_Fragment | None]) -> None:
        delete(self.folder)


class OneDocument(DataSource):
    """format("one_document"), for writing: options path, and head, between and tail as JSON texts. One column of text, the pieces."""

    @classmethod
    def name(cls) -> str:
        return "one_document"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options, overwrite)


def write_pieces(pieces: DataFrame, path: str, head: str, between: str, tail: str) -> None:
    """Pieces of text (one column, in the order of partitions and rows) as one file. Null pieces are left out."""
    pieces.sparkSession.dataSource.register(OneDocument)
    texts = {"head": head, "between": between, "tail": tail}
    pieces.write.format("one_document").mode("append").options(path=path, **{k: json.dumps(v) for k, v in texts.items()}).save()


def row_text(rows: DataFrame, keep_nulls: list[str] | tuple = (), without: str | None = None) -> Column:
    """A row as JSON. Null columns are left out, as absent keys are, but for those named in keep_nulls; so is the column `without`."""
    parts = []
    for c in rows.columns:
        if c != without:
            field = F.regexp_extract(F.to_json(F.struct(F.col(f"`{c}`").alias(c))), r"(?s)^\{(.*)\}$", 1)
            parts.append(F.when(F.col(f"`{c}`").isNull(), F.lit(f"{json.dumps(c)}:null") if c in keep_nulls else F.lit(None)).otherwise(field))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _ordered(rows: DataFrame, order: str | None, text: Column) -> DataFrame:
    """Texts of rows in the given order, ties by text: a sort by ranges, so no task has more than its share."""
    texts = rows.select(*([F.col(order).alias("o")] if order else []), text.alias("value"))
    return (texts.orderBy("o", "value") if order else texts).select("value")


def write_envelope(rows: DataFrame, path: str, name: str, last_updated: int, version: str | None, order: str | None = None, keep_nulls: list[str] | tuple = (), without: str | None = None) -> None:
    """A feed as one document: last_updated, ttl 0, version (left out if None), and the rows under data.<name>, in the given order."""
    head = f'{{"last_updated":{last_updated},"ttl":0,' + (f'"version":{json.dumps(version)},' if version else "") + f'"data":{{{json.dumps(name)}:['
    write_pieces(_ordered(rows, order, row_text(rows, keep_nulls, without)), path, head, ",", "]}}")


def write_array(rows: DataFrame, path: str, order: str | None = None, keep_nulls: list[str] | tuple = (), without: str | None = None) -> None:
    """All rows as one JSON array."""
    write_pieces(_ordered(rows, order, row_text(rows, keep_nulls, without)), path, "[", ",", "]")


def csv_text(rows: DataFrame, columns: list[str]) -> Column:
    """A line after RFC 4180: text is quoted, numbers are bare, quotes are doubled, null is an empty field."""
    kinds = dict(rows.dtypes)
    field = lambda c: F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')) if kinds[c] == "string" else F.col(c).cast("string")
    return F.concat_ws(",", *[F.coalesce(field(c), F.lit("")) for c in columns])


def write_csv_file(rows: DataFrame, path: str, order: str | None = None, columns: list[str] | None = None) -> None:
    """One CSV file with its header as the first line."""
    columns = columns or rows.columns
    write_pieces(_ordered(rows, order, csv_text(rows, columns)), path, ",".join(columns) + "\n", "\n", "\n")


def read_csv_file(spark: SparkSession, path: str, schema) -> DataFrame:
    """A CSV file with a header, as write_csv_file makes it: a quoted empty field is empty text, a bare one is null."""
    return spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=True, nullValue="\u0000", emptyValue="")
