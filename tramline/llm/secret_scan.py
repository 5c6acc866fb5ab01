"""Secrets in texts, also in those that are encoded: a worklist of layers.

A document is the first layer. What a layer holds in encoded form (URL and Unicode escapes, base64, compressed bytes) is
unwrapped into further layers, until there is nothing new to unwrap. Every layer is scanned by the same patterns, and
what is found there is mapped back to the code points of the document from which it came.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import packed, unpacked

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
#: Runs that are too short fail as a whole, so the least length can stand in the pattern of these two.
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]{14,}"), re.compile(r"[0-9a-f]{16,}")
_KEY = 12
#: Escapes; an escaped escape sign in front of the same kind of escape, however often, is one layer with it.
_ESCAPE = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+|\\(?:u005[cC])*(?:u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))")
#: A run of 22 letters stands for 16 bytes; fewer hold no secret, and no compressed one. Lines of one length may follow each other.
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:(?:[A-Za-z0-9+/]{76}\r?\n)+[A-Za-z0-9+/]+|(?:[A-Za-z0-9+/]{64}\r?\n)+[A-Za-z0-9+/]+|[A-Za-z0-9+/_-]{22,})={0,2}")
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
#: Layers of escapes that are unwrapped one by one; deeper ones are unwrapped to the end at once.
ROUNDS = 32
#: Bytes that may come out of all compressed layers of a document. More is a bomb, and is not unwrapped.
UNPACKED = 64 << 20


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find in one layer, without overlap within a kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= _KEY]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]


class Layer:
    """A text (or bytes) and where its characters come from: each one by itself (arrays), all of them (two numbers), or the document itself."""

    __slots__ = ("data", "first", "last", "via", "rounds")

    def __init__(self, data: str | bytes, first=None, last=None, via: str = "", rounds: int = 0):
        self.data, self.first, self.last, self.via, self.rounds = data, first, last, via, rounds

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Of the document, for a range that is not empty."""
        if self.first is None:
            return start, end
        if isinstance(self.first, int):
            return self.first, self.last
        return int(self.first[start]), int(self.last[end - 1])

    def spans(self, start: np.ndarray, end: np.ndarray):
        """The same for arrays of ranges, as what a new layer's characters come from."""
        if self.first is None:
            return start, end
        if isinstance(self.first, int):
            return self.first, self.last
        return self.first[start], self.last[end - 1]

    def child(self, data: str | bytes, first, last, how: str, rounds: int = 0) -> Layer:
        return Layer(data, first, last, f"{self.via}>{how}" if self.via else how, rounds)


def _unpack(data: bytes, most: int) -> Iterator[tuple[str, bytes]]:
    """What compressed bytes hold, and by which method, if that is `most` bytes or less."""
    tries = []
    if data[:2] == b"\x1f\x8b" or len(data) > 1 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0:
        tries.append(("gzip" if data[0] == 0x1F else "zlib", lambda: zlib.decompressobj(47).decompress(data, most + 1)))
    if data[:3] == b"BZh":
        tries.append(("bzip2", lambda: bz2.BZ2Decompressor().decompress(data, most + 1)))
    if data[:6] == b"\xfd7zXZ\x00":
        tries.append(("xz", lambda: lzma.LZMADecompressor(memlimit=256 << 20).decompress(data, most + 1)))
    if data[:4] == b"\x28\xb5\x2f\xfd":
        tries.append(("zstd", lambda: zstandard.ZstdDecompressor(max_window_size=128 << 20).stream_reader(data).read(most + 1)))
    for how, run in tries:
        try:
            out = run()
        except (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError, zstandard.ZstdError, MemoryError):
            continue
        if 0 < len(out) <= most:
            yield how, out


def _points(data: bytes) -> list[tuple[str, int, int]]:
    """Characters of UTF-8 with their bytes; a byte that belongs to none is U+FFFD."""
    out, i = [], 0
    while i < len(data):
        n = 1 if data[i] < 0x80 else 2 if data[i] >> 5 == 6 else 3 if data[i] >> 4 == 14 else 4
        try:
            out.append((data[i : i + n].decode(), i, i + n))
        except UnicodeDecodeError:
            n = 1
            out.append(("\ufffd", i, i + 1))
        i += n
    return out


def _code(m: re.Match) -> str:
    value = int(m[1] or m[2] or m[3] or m[4], 16)
    return chr(value) if value < 0x110000 and not 0xD800 <= value < 0xE000 else "\ufffd"


def _unescaped(layer: Layer, blobs: list[Layer]) -> Layer | None:
    """The layer with each escape unwrapped once; None if it has none. Runs of URL escapes that are compressed bytes go to blobs."""
    text, pieces, starts, ends, at = layer.data, [], [], [], 0

    def put(piece: str, first, last) -> None:
        pieces.append(piece)
        starts.append(first)
        ends.append(last)

    for m in _ESCAPE.finditer(text):
        if at < m.start():
            plain = np.arange(at, m.start())
            put(text[at : m.start()], plain, plain + 1)
        if m[0][0] == "%":
            one = [(x.end() - 2, x.start() + m.start(), x.end() + m.start()) for x in re.finditer(r"%(?:25)*[0-9A-Fa-f]{2}", m[0])]
            data = bytes(int(m[0][k : k + 2], 16) for k, _, _ in one)
            if len(data) > 16:
                blobs.append(layer.child(data, *layer.span(m.start(), m.end()), "url"))
            points = _points(data)
            put("".join(p for p, _, _ in points), np.array([one[a][1] for _, a, _ in points]), np.array([one[b - 1][2] for _, _, b in points]))
        else:
            put(_code(m), np.array([m.start()]), np.array([m.end()]))
        at = m.end()
    if not pieces:
        return None
    if at < len(text):
        plain = np.arange(at, len(text))
        put(text[at:], plain, plain + 1)
    return layer.child("".join(pieces), *layer.spans(np.concatenate(starts), np.concatenate(ends)), "escapes", layer.rounds + 1)


def _settled(layer: Layer) -> Layer:
    """The layer with all escapes unwrapped, those that come from escapes, too: from right to left, each sign once."""
    out: list[tuple[str, int, int]] = []
    text, hexes = layer.data, set("0123456789abcdefABCDEF")

    def top(n: int, skip: int) -> str:
        """n signs after `skip` others, if all are hexadecimal."""
        digits = "".join(c for c, _, _ in out[-skip - n : -skip][::-1])
        return digits if len(digits) == n and hexes.issuperset(digits) else ""

    for i in range(len(text) - 1, -1, -1):
        out.append((text[i], i, i + 1))
        while out[-1][0] in "%\\":
            skip, sign = (1, "%") if out[-1][0] == "%" else (2, out[-2][0] if len(out) > 1 else "")
            digits = top({"%": 2, "x": 2, "u": 4, "U": 8}.get(sign, 99), skip)
            if not digits or int(digits, 16) > 0x10FFFF or 0xD800 <= int(digits, 16) < 0xE000:
                break
            used = out[-skip - len(digits) :]
            del out[-skip - len(digits) :]
            out.append((chr(int(digits, 16)), min(u[1] for u in used), max(u[2] for u in used)))
    out.reverse()
    return layer.child("".join(c for c, _, _ in out), *layer.spans(np.array([a for _, a, _ in out]), np.array([b for _, _, b in out])), "escapes")


def _decoded(layer: Layer) -> Iterator[Layer]:
    """What stands in a text in base64, as bytes or, with the place of each character, as text."""
    for m in _BASE64.finditer(layer.data):
        run = m[0].rstrip("=")
        places = np.array([k for k, c in enumerate(run) if c not in "\r\n"]) if "\n" in run else np.arange(len(run))
        letters = run.replace("\r", "").replace("\n", "").replace("-", "+").replace("_", "/")
        if len(letters) % 4 == 1:
            continue
        try:
            data = base64.b64decode(letters + "=" * (-len(letters) % 4))
        except (binascii.Error, ValueError):
            continue
        if data[:1] and (data[:2] == b"\x1f\x8b" or data[:3] == b"BZh" or data[:4] in (b"\x28\xb5\x2f\xfd", b"\xfd7zX") or data[0] & 15 == 8):
            yield layer.child(data, *layer.span(m.start(), m.end()), "base64")
        text = _printable(data)
        if text is not None:
            size = np.array([len(c.encode()) for c in text]) if not text.isascii() else np.ones(len(text), np.int64)
            last = np.cumsum(size)
            first = places[(last - size) * 8 // 6] + m.start()
            yield layer.child(text, *layer.spans(first, places[np.minimum((last * 8 + 5) // 6, len(places)) - 1] + m.start() + 1), "base64")


def _printable(data: bytes) -> str | None:
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return text if text and not _CONTROL.search(text) else None


def find(text: str, unpacked_bytes: int = UNPACKED) -> list[tuple[int, int, int, bool, str]]:
    """(start, kind, end, base, via) of all secrets of a text, sorted: those of the text itself, and those of its layers.

    A layer is looked at once for each place it comes from, so a layer that unwraps to itself ends. A span that
    the text itself has is not given again for a layer.
    """
    spans = {(a, kind, b): (True, "") for a, kind, b in scan(text)}
    work, seen, left = [Layer(text)], set(), unpacked_bytes
    while work:
        layer = work.pop()
        if layer.first is not None:
            raw = layer.data.encode("utf-8", "surrogatepass") if isinstance(layer.data, str) else layer.data
            key = (isinstance(layer.data, str), hashlib.sha256(raw).digest(), layer.span(0, len(layer.data)))
            if key in seen:
                continue
            seen.add(key)
        if isinstance(layer.data, bytes):
            for how, data in _unpack(layer.data, left):
                left -= len(data)
                work.append(layer.child(data, layer.first, layer.last, how))
                inner = _printable(data)
                if inner is not None:
                    work.append(layer.child(inner, layer.first, layer.last, how))
            continue
        if layer.first is not None:
            for a, kind, b in scan(layer.data):
                start, end = layer.span(a, b)
                spans.setdefault((start, kind, end), (False, layer.via))
        blobs: list[Layer] = []
        if _ESCAPE.search(layer.data):
            work.append(_settled(layer) if layer.rounds >= ROUNDS else _unescaped(layer, blobs))
        work += blobs
        work.extend(x for x in _decoded(layer) if x.data)
    return sorted((a, kind, b, *how) for (a, kind, b), how in spans.items())


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("via", pa.string())]))


def _scan(most: int):
    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            found = [[{"kind": KINDS[k], "start": a, "end": b, "base": base, "via": via} for a, k, b, base, via in find(t.as_py() or "", most)] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, _SPANS)], names=["row", "_spans"])

    return scan_batches


def secrets(docs: DataFrame, text: str = "text", most: int = UNPACKED) -> DataFrame:
    """Adds _spans to each row (in place of a column of this name): kind, start, end (code points, end exclusive), base, via.

    base: the text itself matches; else `via` names the layers that were unwrapped, and the span is what of the text they come
    from. Spans are sorted by start, kind and end. A null or empty text has none. No row meets another, so there is no
    shuffle and any row may repeat; other columns are carried along. Layers that unwrap to themselves end; compressed layers are
    unwrapped up to `most` bytes in a document, beyond which what was found until then counts.
    """
    rows = packed(docs)
    spans = "array<struct<kind:string,start:long,end:long,base:boolean,via:string>>"
    schema = T.StructType([rows.schema["row"], T.StructField("_spans", T.DataType.fromDDL(spans))])
    found = rows.withColumn("_text", F.col("row")[text].cast("string")).mapInArrow(_scan(most), schema)
    return unpacked(found, docs.columns, _spans=F.col("_spans"))


def redacted(docs: DataFrame, text: str = "text", mark: str = "[secret]", most: int = UNPACKED) -> DataFrame:
    """The documents with each secret, those in encoded form included, replaced by a mark; overlapping spans become one mark."""
    columns = docs.columns
    spans = F.transform("_spans", lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b")))
    empty = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        gap = F.substring(F.col(text), (acc["at"] + 1).cast("int"), F.greatest(s["a"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.when(s["a"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["b"]).alias("at"))

    done = F.aggregate(spans, empty, step, lambda acc: F.concat(acc["out"], F.substring(F.col(text), (acc["at"] + 1).cast("int"), F.lit(2147483647))))
    return secrets(docs, text, most).withColumn(text, F.when(F.size("_spans") > 0, done).otherwise(F.col(text))).select([F.col(f"`{c}`") for c in columns])
