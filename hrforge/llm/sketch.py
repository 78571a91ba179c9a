"""Hash-partitioned counting: partition sketches, merged by slices of the hash space.

Map tasks gather hashes in a bounded buffer, reduce it to distinct values (so that
a hot value costs each buffer one entry), cut it by the leading bits into slices,
and emit one packed row per slice. Spark shuffles rows by slice; a reduce task
merges one slice in numpy. Two products:

``totals``   exact sums per 64-bit key, kept packed by slice;
``repeated`` a count-min row: cells of a 2**bits table whose merged count is 2 or
             more, as a bit map of fixed size (at most 2**29 bits) for a broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.llm.common import U64, mix64, plan_bytes, power_of_two, released, slice_bits, table

#: Hashes a map task holds before it emits them.
BUFFER = 1 << 20
PACKED = "slice int, keys binary, counts binary"
#: Largest bit map that is broadcast: 64 MB a row.
MAX_BITS = 29


def packed_rows(schema: list[str], slices: np.ndarray, columns: list[np.ndarray],
                write: Callable[[np.ndarray], bytes] = np.ndarray.tobytes) -> pa.RecordBatch | None:
    """One row per slice with each column's values as bytes. ``slices``: per entry."""
    if not len(slices):
        return None
    order = np.argsort(slices, kind="stable")
    s = slices[order]
    cuts = np.flatnonzero(np.diff(s)) + 1
    begin = np.concatenate([[0], cuts])
    arrays = [pa.array(s[begin].astype(np.int32))]
    for c in columns:
        arrays.append(pa.array([write(x) for x in np.split(c[order], cuts)], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, schema)


def planes(x: np.ndarray) -> bytes:
    """The bytes of ``x`` (its rows, if it has two dimensions) by place: all first bytes, then
    all second ones. Sorted or small values so give long runs, which shuffles compress well."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def from_planes(col, kind, n: int = 1) -> np.ndarray:
    """Values that ``planes`` wrote (``n``: values of a row), of all rows of ``col``."""
    size = n * np.dtype(kind).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(size, -1).T).view(kind) for x in col]
    got = np.concatenate(parts or [np.empty((0, n), kind)])
    return got if n > 1 else got.ravel()


class Gather:
    """Buffer of 64-bit keys of one map task; emits distinct keys with counts."""

    def __init__(self, bits: int):
        self.bits, self.parts, self.size = bits, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(keys), BUFFER):
            self.parts.append(keys[i:i + BUFFER])
            self.size += len(self.parts[-1])
            if self.size >= BUFFER:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            keys, n = np.unique(np.concatenate(self.parts), return_counts=True)
            self.parts, self.size = [], 0
            got = packed_rows(["slice", "keys", "counts"], mix64(keys) >> U64(64 - self.bits), [keys, n.astype(np.uint32)], planes)
            if got is not None:
                yield got


def unpack(col, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in col] or [np.empty(0, kind)])


def gather(docs: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> DataFrame:
    """Packed partial counts of the uint64 keys that ``keys_of`` makes of each batch."""

    def run(batches):
        held = Gather(bits)
        for batch in batches:
            for keys in keys_of(batch):
                yield from held.add(keys)
        yield from held.flush()

    return docs.mapInArrow(run, PACKED)


def totals(partial: DataFrame, least: int, name: str) -> DataFrame:
    """Merged counts by slice, of the keys counted ``least`` times or more; ``seen`` is
    the sum of all counts of the slice."""

    def merge(group: pa.Table) -> pa.Table:
        keys, n = from_planes(group["keys"], U64), from_planes(group["counts"], np.uint32)
        found, at = np.unique(keys, return_inverse=True)
        count = np.bincount(at, n, len(found)).astype(np.int64)
        big = count >= least
        return pa.table({"slice": group["slice"][:1], "keys": pa.array([found[big].tobytes()], pa.binary()),
                         "counts": pa.array([count[big].tobytes()], pa.binary()),
                         "seen": pa.array([int(count.sum())], pa.int64())})

    with released(partial.sparkSession):
        return table(partial.groupBy("slice").applyInArrow(merge, PACKED + ", seen long"), name)


def frequent(counted: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (sorted) and counts of those counted ``least`` times or more. Callers bound
    the result by choosing ``least`` in proportion to the sum of all counts."""

    def run(batches):
        for b in batches:
            keys, n = unpack(b.column("keys"), U64), unpack(b.column("counts"), np.int64)
            big = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(keys[big].view(np.int64)), pa.array(n[big])], ["key", "n"])

    got = counted.select("keys", "counts").mapInArrow(run, "key long, n long").toArrow()
    keys = got["key"].to_numpy().view(U64)
    order = np.argsort(keys)
    return keys[order], got["n"].to_numpy()[order]


def lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """values of the wanted keys, 0 where absent; ``keys`` is sorted."""
    if not len(keys):
        return np.zeros(len(wanted), values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


class Bits:
    """A bit map over 2**bits cells; ``hit`` tells which keys fall into a set cell."""

    def __init__(self, bits: int, data: np.ndarray, salts: tuple[int, ...]):
        self.bits, self.data, self.salts = bits, data, salts

    def hit(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for row, salt in enumerate(self.salts):
            c = cells(keys, salt, self.bits)
            out &= (self.data[row][c >> np.uint32(3)] >> (c & np.uint32(7)).astype(np.uint8)) & 1 == 1
        return out


def cells(keys: np.ndarray, salt: int, bits: int) -> np.ndarray:
    return (mix64(keys ^ U64(salt)) >> U64(64 - bits)).astype(np.uint32)


SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344)


def width(docs: DataFrame, cells_per_byte: float) -> int:
    return power_of_two(plan_bytes(docs) * cells_per_byte, 16, MAX_BITS)


def repeated(docs: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int,
             depth: int = 1, least: int = 2) -> Bits:
    """Count-min sketch of the keys of all rows, cut at ``least`` (1 or 2).

    A key counted ``least`` times or more always hits; another one hits only when all
    its ``depth`` cells are shared. Each map buffer is a partition sketch, sent as its
    non-empty cells; slices of the table are merged by Spark, and the finished bit map
    (2**bits / 8 bytes a row) is the only thing that reaches the driver.
    """
    cut = max(3, bits - 16)  # a slice has at most 2**16 cells: two bytes name one
    inside = np.uint32((1 << (bits - cut)) - 1)

    def run(batches):
        parts, size = [], 0

        def flush():
            keys = np.concatenate(parts)
            for row, salt in enumerate(SALTS[:depth]):
                c, n = np.unique(cells(keys, salt, bits), return_counts=True)
                c = np.repeat(c, np.minimum(n, 2))
                yield packed_rows(["slice", "keys"], (c >> np.uint32(bits - cut)) + np.uint32(row << cut),
                                  [(c & inside).astype(np.uint16)])

        for batch in batches:
            for keys in keys_of(batch):
                for i in range(0, len(keys), BUFFER):
                    parts.append(keys[i:i + BUFFER])
                    size += len(parts[-1])
                    if size >= BUFFER:
                        yield from flush()
                        parts.clear()
                        size = 0
        if size:
            yield from flush()

    def merge(group: pa.Table) -> pa.Table:
        flags = np.bincount(unpack(group["keys"], np.uint16), minlength=1 << (bits - cut)) >= least
        return pa.table({"slice": group["slice"][:1], "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    got = docs.mapInArrow(run, "slice int, keys binary").groupBy("slice").applyInArrow(merge, "slice int, bits binary").toArrow()
    data = np.zeros((depth, 1 << (bits - 3)), np.uint8)
    step = 1 << (bits - cut - 3)
    for s, b in zip(got["slice"].to_pylist(), got["bits"]):
        row, place = s >> cut, s & ((1 << cut) - 1)
        data[row, place * step:(place + 1) * step] = np.frombuffer(b.as_buffer(), np.uint8)
    return Bits(bits, data, SALTS[:depth])


def slice_total(counted: DataFrame) -> int:
    return counted.agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0]


def key_count(counted: DataFrame) -> int:
    return counted.agg(F.coalesce(F.sum(F.octet_length("keys")), F.lit(0))).first()[0] // 8


def key_bits(counted: DataFrame, shift: int = 0, cells_per_key: int = 16) -> Bits:
    """Bit map of the keys of packed counts, without their last ``shift`` bits: a key of the
    table always hits. At most 2**MAX_BITS cells, so larger tables let more other keys hit."""
    salt = 0xA4093822299F31D0
    bits = power_of_two(key_count(counted) * cells_per_key, 16, MAX_BITS)
    cut = min(12, bits - 3)

    def run(batches):
        for b in batches:
            c = np.unique(cells(unpack(b.column("keys"), U64) >> U64(shift), salt, bits))
            got = packed_rows(["part", "cells"], c >> np.uint32(bits - cut), [c])
            if got is not None:
                yield got

    def merge(group: pa.Table) -> pa.Table:
        flags = np.zeros(1 << (bits - cut), bool)
        flags[unpack(group["cells"], np.uint32) & np.uint32((1 << (bits - cut)) - 1)] = True
        return pa.table({"part": group["part"][:1], "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    got = counted.mapInArrow(run, "part int, cells binary").groupBy("part").applyInArrow(merge, "part int, bits binary").toArrow()
    data = np.zeros((1, 1 << (bits - 3)), np.uint8)
    step = 1 << (bits - cut - 3)
    for p, b in zip(got["part"].to_pylist(), got["bits"]):
        data[0, p * step:(p + 1) * step] = np.frombuffer(b.as_buffer(), np.uint8)
    return Bits(bits, data, (salt,))
