"""Shared helpers: reading documents, shared tables, words and hashes in numpy.

Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``; every other byte,
non-ASCII white space included, belongs to a word. Word hashes are 64 bit.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hrforge.session import checkpoint_dir

#: Rows of an Arrow batch between the JVM and Python: texts can be long.
BATCH_ROWS = 512
#: Bytes from which a single word is hashed by itself.
LONG = 1 << 10

U64 = np.uint64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def arrow_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for tables of long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    This cuts the lineage: the rows survive the loss of executors, and values
    that depend on the partitioning of ``df`` are fixed from here on.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Queries that begin within remove their shuffle files when they end. For tables that
    are written, or results that are collected, once; not for frames handed on unread."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (file bytes for a table on disk); it only
    sets widths and numbers of partitions, never results."""
    return max(1, min(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())), 1 << 50))


def power_of_two(n: float, low: int, high: int) -> int:
    """Exponent b with 2**b >= n, held within [low, high]."""
    return max(low, min(high, math.ceil(math.log2(max(n, 1)))))


def slice_bits(df: DataFrame) -> int:
    """Hash partitions (as a power of two) so that one holds about 2 MB of input."""
    return power_of_two(plan_bytes(df) / (2 << 20), 5, 20)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Masks of the first n bytes of a little-endian 64-bit word.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[at[0]:at[-1]] if buf is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return data, at - at[0]


class Words(NamedTuple):
    """Words of a batch: byte ranges in ``data``, 64-bit hashes, and where each row's
    words begin (``rows`` has one entry more than there are rows)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray


def words(col: pa.Array, lower: bool = False) -> Words:
    """Split and hash the words of every row (``lower``: A-Z count as a-z)."""
    data, at = text_bytes(col)
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.empty(0, U64), np.zeros(len(at), np.int64))
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < len(data)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(data, starts, ends, _hash_words(data, starts, ends, lower), np.searchsorted(starts, at))


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Hash of every word, eight bytes at a time."""
    size = ends - starts
    out = mix64(size.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(1))
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = _LOWER[data] if lower else data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    for i in np.flatnonzero(size > LONG):
        out[i] = xxhash.xxh3_64_intdigest(padded[starts[i]:ends[i]].tobytes())
    at = None  # words that have more bytes
    for done in range(0, LONG, 8):
        left = size - done if at is None else size[at] - done
        more = (left > 0) & (left <= LONG - done)
        at = np.flatnonzero(more) if at is None else at[more]
        if not len(at):
            break
        part = eight[starts[at] + done] & _FIRST[np.minimum(size[at] - done, 8)]
        out[at] = mix64(out[at] ^ part)
    return out


_GRAM = mix64(np.arange(1, 65, dtype=U64) * U64(0xD1342543DE82EF95)) | U64(1)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words of one row."""
    if len(h) < n:
        return np.empty(0, U64)
    m = len(h) - n + 1
    out = h[:m] * _GRAM[0]
    for j in range(1, n):
        out = out + h[j:j + m] * _GRAM[j]
    return mix64(out)


def digest(h: np.ndarray) -> bytes:
    """128-bit identity of a word sequence."""
    return hashlib.blake2b(np.ascontiguousarray(h).tobytes(), digest_size=16).digest()


def hex_sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def share(docs: DataFrame, value):
    """Broadcast a value whose size its maker bounds."""
    return docs.sparkSession.sparkContext.broadcast(value)


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(docs: DataFrame, kept: DataFrame, drop: bool = False) -> DataFrame:
    """Rows of ``docs`` whose doc_id is (``drop``: is not) in ``kept.doc_id``; null ids
    match null. All columns of ``docs`` stay as they are."""
    other = free_name(docs, "kept_id")
    ids = kept.select(F.col("doc_id").alias(other))
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids[other]), "left_anti" if drop else "left_semi")
