"""Fields of the protocol buffer wire format, as far as map files need them."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np


def varint(data: bytes, at: int) -> tuple[int, int]:
    """A number, and the place after it."""
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message: numbers for varints, bytes for all else (4 or 8 of them for fixed sizes)."""
    at, end = 0, len(data)
    while at < end:
        key, at = varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = varint(data, at)
            yield key >> 3, value
            continue
        if kind == 2:
            size, at = varint(data, at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
        else:
            raise ValueError(f"unknown kind of field {kind}")
        if at + size > end:
            raise ValueError("a message ends early")
        yield key >> 3, data[at : at + size]
        at += size


def packed(data: bytes) -> np.ndarray:
    """All varints of a packed field, as unsigned 64-bit numbers."""
    if not data:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    if not len(last) or last[-1] != len(raw) - 1:
        raise ValueError("a packed field ends early")
    first = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64), first)


def signed(values: np.ndarray) -> np.ndarray:
    """Numbers in zigzag order to signed ones."""
    return (values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)


def zigzag(value: int) -> int:
    return (value >> 1) ^ -(value & 1)


def two(value: int) -> int:
    """An unsigned number as a signed one of 64 bits."""
    return value - (1 << 64) if value >> 63 else value


def real(data: bytes) -> float:
    return struct.unpack("<d" if len(data) == 8 else "<f", data)[0]
