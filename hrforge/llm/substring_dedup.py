"""Removal of repeated passages with a count-min prefilter.

A window is ``window`` consecutive words of one document. A word is removed when a
window that covers it also starts anywhere else, in the same document or another one.

1. Sketch. Two equal windows have equal anchors: the ``ANCHOR``-word run of smallest
   hash within the window, at the same place. Every document adds its distinct anchor
   places to a count-min sketch. Partition sketches are merged by Spark; an anchor's
   merged count is at least the count of any window with that anchor, so a window whose
   anchor is estimated once starts nowhere else. A bit map of fixed size (at most 64 MB
   a row) holds the cells of count 2 and more and is broadcast.
2. Windows estimated repeated are grouped exactly, by a 128-bit hash of their words, in
   hash partitions; equal windows of one map buffer travel as one entry, so a hot window
   makes no hot partition. Only the exceptions leave this step: windows that in fact
   start once.
3. Documents with estimated windows meet their exceptions and lose the words of the
   others. The other documents are done where they are read.

Nothing is lost: the sketch only overestimates. Words are compared as they are. A null
text has no words. Equal rows are copies of each other: all their windows repeat. Empty
table: empty result. A long text is read whole; memory follows the longest text. Columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.llm.common import U64, arrow_batches, digest, grams, hex_sha256, mix64, share, slice_bits, words
from hrforge.llm.sketch import Bits, packed_rows, repeated, unpack, width

WINDOW, ANCHOR = 35, 8
#: Window entries a map task holds before it sends them.
BUFFER = 1 << 18
_PLACE = U64((1 << 24) - 1)


def anchors(h: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> np.ndarray:
    """For each window start: 40 bits of the smallest hash among the window's runs of
    ``anchor`` words, and 24 bits of its (first) place."""
    g = grams(h, anchor)
    span = window - anchor + 1
    if len(g) < span:
        return np.empty(0, U64)
    low = (g & ~_PLACE) | (np.arange(len(g), dtype=U64) & _PLACE)
    size = 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[:len(g) - span + 1], low[span - size:])
    return low


def anchor_places(batch: pa.RecordBatch, column: int, window: int):
    """Anchor hashes of a batch, once for each place in a document."""
    w = words(batch.column(column))
    for a, b in zip(w.rows, w.rows[1:]):
        if b - a >= window:
            low = anchors(w.hashes[a:b], window)
            first = np.ones(len(low), bool)
            first[1:] = low[1:] != low[:-1]
            yield low[first] >> U64(24)


_MULTIPLIERS = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""
    got = _POWERS.get(which)
    if got is None or len(got[0]) < size:
        m = _MULTIPLIERS[which]
        n = max(size, 1 << 15)
        both = []
        for x in (m, pow(m, -1, 1 << 64)):
            p = np.full(n, x, U64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        got = _POWERS[which] = both[0], both[1]
    return got


def window_hashes(h: np.ndarray, window: int, which: int) -> np.ndarray:
    """Polynomial hash of every window, from prefix sums modulo 2**64."""
    up, down = _powers(which, len(h) + 1)
    sums = np.zeros(len(h) + 1, U64)
    np.cumsum(h * up[:len(h)], out=sums[1:])
    n = len(h) - window + 1
    return mix64((sums[window:] - sums[:n]) * down[:n])


def key_of(h: np.ndarray) -> tuple[int, int]:
    """96-bit identity of a document's words: a long and an int."""
    d = digest(h)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:12], "little") & 0x7FFFFFFF


ENTRY = "slice int, a binary, b binary, doc binary, place binary, many binary"


def windows(docs: DataFrame, bits: Bits, cut: int, window: int) -> DataFrame:
    """Windows estimated repeated, packed by slices of their hash."""
    shared = share(docs, bits)

    def run(batches):
        held, size = [], 0

        def flush():
            a, b, doc, place = (np.concatenate([x[i] for x in held]) for i in range(4))
            order = np.lexsort((b, a))
            a, b, doc, place = a[order], b[order], doc[order], place[order]
            at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            many = np.diff(np.append(at, len(a))) > 1
            got = packed_rows(["slice", "a", "b", "doc", "place", "many"], a[at] >> U64(64 - cut),
                              [a[at], b[at], doc[at], place[at], many.astype(np.uint8)])
            if got is not None:
                yield got

        for batch in batches:
            w = words(batch.column(0))
            for x, y in zip(w.rows, w.rows[1:]):
                if y - x < window:
                    continue
                h = w.hashes[x:y]
                at = np.flatnonzero(shared.value.hit(anchors(h, window) >> U64(24)))
                if not len(at):
                    continue
                k1, k2 = key_of(h)
                held.append((window_hashes(h, window, 0)[at], window_hashes(h, window, 1)[at], np.full(len(at), k1),
                             (k2 << 32) + at))
                size += len(at)
                if size >= BUFFER:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    return docs.select("text").mapInArrow(run, ENTRY)


def exceptions(entries: DataFrame) -> DataFrame:
    """Documents (k1, k2) with the places of their estimated windows that start once."""

    def single(group: pa.Table) -> pa.Table:
        a, b = unpack(group["a"], U64), unpack(group["b"], U64)
        doc, place, many = unpack(group["doc"], np.int64), unpack(group["place"], np.int64), unpack(group["many"], np.uint8)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        once = order[new & np.append(new[1:], True)]
        once = once[many[once] == 0]
        return pa.table({"k1": pa.array(doc[once]), "k2": pa.array((place[once] >> 32).astype(np.int32)),
                         "place": pa.array((place[once] & 0xFFFFFFFF).astype(np.int32))})

    return (entries.groupBy("slice").applyInArrow(single, "k1 long, k2 int, place int")
            .groupBy("k1", "k2").agg(F.collect_list("place").alias("once")))


DONE = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _row(doc_id, data: bytes, starts, ends, gone: np.ndarray | None) -> tuple:
    """Digest of the kept words, joined by single spaces."""
    n = len(starts)
    if gone is None or not gone.any():
        kept = b" ".join(data.split())
        return doc_id, n, 0, hex_sha256(kept), kept
    kept = b" ".join(data[s:e] for s, e in zip(starts[~gone].tolist(), ends[~gone].tolist()))
    return doc_id, n, int(gone.sum()), hex_sha256(kept), kept


def removed(h: np.ndarray, bits: Bits, once: np.ndarray, window: int) -> np.ndarray:
    """Flags of the words that repeated windows cover."""
    hit = bits.hit(anchors(h, window) >> U64(24))
    hit[once] = False
    at = np.flatnonzero(hit)
    edge = np.zeros(len(h) + 1, np.int32)
    edge[at] += 1
    edge[at + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and (``texts``) the kept text of every row."""
    arrow_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bits = repeated(source, lambda b: anchor_places(b, 1, window), width(docs, 0.35), depth=2)
    shared = share(docs, bits)
    once = exceptions(windows(source, bits, slice_bits(docs), window))

    def first(batches):
        """Finish rows without estimated windows; give the others their key."""
        for batch in batches:
            w = words(batch.column(1))
            rows, keys, bodies = [], [], []
            for i, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                h = w.hashes[w.rows[i]:w.rows[i + 1]]
                keys.append(key_of(h))
                if len(h) >= window and shared.value.hit(anchors(h, window) >> U64(24)).any():
                    rows.append((doc_id, len(h), None, None, None))
                    bodies.append(text)
                else:
                    data = (text or "").encode()
                    rows.append(_row(doc_id, data, range(len(h)), None, None))
                    bodies.append(None)
            yield _batch(rows, texts, [pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int32()),
                                       pa.array(bodies, pa.string())], ["k1", "k2", "body"])

    def second(batches):
        for batch in batches:
            body, single = batch.column("body"), batch.column("once").to_pylist()
            w = words(body)
            rows = []
            done = [batch.column(c).to_pylist() for c in ("doc_id", "n_words", "n_removed", "kept_sha256", "kept")]
            for i, (text, *known) in enumerate(zip(body.to_pylist(), *done)):
                if text is None:
                    rows.append((*known[:4], None if known[4] is None else known[4].encode()))
                    continue
                a, b = w.rows[i], w.rows[i + 1]
                gone = removed(w.hashes[a:b], shared.value, np.array(single[i] or [], np.int64), window)
                data = text.encode()
                offset = _offset(body, i)
                rows.append(_row(known[0], data, w.starts[a:b] - offset, w.ends[a:b] - offset, gone))
            yield _batch(rows, texts, [], [])

    started = source.mapInArrow(first, DONE + ", k1 long, k2 int, body string")
    joined = started.join(once, ["k1", "k2"], "left").select("doc_id", "n_words", "n_removed", "kept_sha256", "kept", "body", "once")
    out = joined.mapInArrow(second, DONE)
    return out if texts else out.drop("kept")


def _offset(col: pa.Array, i: int) -> int:
    """Bytes of the rows before row i."""
    at = np.frombuffer(col.buffers()[1], np.int64 if pa.types.is_large_string(col.type) else np.int32)
    return int(at[col.offset + i] - at[col.offset])


def _batch(rows: list[tuple], texts: bool, more: list, names: list[str]) -> pa.RecordBatch:
    doc_id, n, gone, sha, kept = zip(*rows) if rows else ([], [], [], [], [])
    kept = [None if k is None or not texts else k.decode() for k in kept]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_id, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()),
         pa.array(kept, pa.string()), *more], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", *names])
