"""Sequence packing by minimum bin slack.

Documents are tokenised once. Each is cut into full pieces of ``capacity`` ids and
one rest; pieces carry their CRC-32, so that ids never move. Rests are dealt evenly
over groups of about ``group_rests`` rows. Within a group, each window takes the
longest rest and then, by a bitset subset-sum program over the multiset of the
remaining lengths (with their counts), the lengths that fill it closest to
capacity; backtracking through the bitsets gives how many of each length to take.
At the end of a group, a window whose sum can be a power of two takes that sum when
it wastes less, as such a sequence is not padded.

A null text counts as empty; an empty text is one piece (its end id). Equal rows are
packed like any others. Empty table: empty result. A long text is tokenised word by
word; its ids are held once. Columns other than ``doc_id`` and ``text`` are not read.

Words are runs outside ASCII white space: the tokenizer's pieces never cross white
space, so ids of a text are the ids of its words in order. Words are encoded by the
tokenizers library and cached per worker, in bounded memory.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.llm.common import arrow_batches, table

CAPACITY = 4096
END_ID = 2
#: Words whose ids a worker keeps at most, and the longest of them in bytes.
CACHE, CACHED_BYTES = 1_000_000, 256
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECES + ", sequence_id long, offset long"

_CACHES: dict[str, tuple] = {}


def word_ids(path: str) -> tuple:
    """(tokenizer, cache of word -> its ids as little-endian uint32 bytes) of a worker."""
    if path not in _CACHES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _CACHES[path] = tokenizer, {}
    return _CACHES[path]


def encoded(texts: list[str | None], path: str) -> Iterator[bytes]:
    """Ids of each text, as little-endian uint32 bytes."""
    tokenizer, cache = word_ids(path)
    # the vocabulary is lower case; only special strings tell cases apart
    split = [(d if b"<|" in d else d.lower()).split() for d in ((t or "").encode() for t in texts)]
    if len(cache) > CACHE:
        cache.clear()
    found = [list(map(cache.get, ws)) for ws in split]
    gaps = [[i for i, x in enumerate(row) if x is None] if None in row else () for row in found]
    fresh = {ws[i] for ws, at in zip(split, gaps) for i in at}
    if fresh:
        # a full stop or comma after a letter is a token of its own
        ended = {w for w in fresh if w[-1] in b".," and w[-2:-1].isalpha()}
        plain = (fresh - ended) | {w for w in {w[:-1] for w in ended} | {b".", b","} if w not in cache}
        _learn(tokenizer, cache, sorted(plain))
        for w in ended:
            cache[w] = cache[w[:-1]] + cache[w[-1:]]
    for ws, row, at in zip(split, found, gaps):
        for i in at:
            row[i] = cache[ws[i]]
    for w in fresh:  # memory of the cache has a bound: long words are not kept
        if len(w) > CACHED_BYTES:
            cache.pop(w, None)
            cache.pop(w[:-1], None)
    yield from map(b"".join, found)


def _learn(tokenizer, cache: dict[bytes, bytes], words: list[bytes]) -> None:
    """Ids of new words: many at once, with a digit between them, which is a token of its
    own, since a call for each word costs more than its work."""
    mark_id = tokenizer.encode("0", add_special_tokens=False).ids[0]
    simple = [w for w in words if b"<|" not in w and b"0" not in w]
    for i in range(0, len(simple), 500):
        part = simple[i:i + 500]
        ids = np.array(tokenizer.encode_batch_fast([b" 0 ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
        cut = 4 * np.flatnonzero(ids == mark_id)
        data = ids.tobytes()
        for w, a, b in zip(part, [0, *(cut + 4).tolist()], [*cut.tolist(), len(data)], strict=True):
            cache[w] = data[a:b]
    for w in set(words).difference(simple):
        cache[w] = np.array(tokenizer.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes()


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Full pieces and the rest of every document."""
    arrow_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(0, len(ids), 64):
                for doc_id, data in zip(ids[i:i + 64], encoded(texts[i:i + 64], path)):
                    data += end
                    n = len(data) // 4
                    for s in range(0, n, capacity):
                        part = data[4 * s:4 * (s + capacity)]
                        out.append((doc_id, s, len(part) // 4, zlib.crc32(part), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 5,
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def closest_fill(stock: Counter, room: int) -> tuple[Counter, int]:
    """Counts of the lengths in ``stock`` whose sum comes closest to ``room`` from below,
    and a bitset of the sums that were reachable."""
    full = (1 << (room + 1)) - 1
    reach, layers = 1, []
    for length in sorted((x for x in stock if x <= room), reverse=True):
        before, left, step = reach, min(stock[length], room // length), 1
        while left:
            take = min(step, left)
            reach |= (reach << (length * take)) & full
            left -= take
            step *= 2
        layers.append((length, before))
        if reach >> room & 1:
            break
    return _backtrack(layers, reach.bit_length() - 1), reach


def _backtrack(layers: list[tuple[int, int]], total: int) -> Counter:
    used: Counter = Counter()
    for length, before in reversed(layers):
        while not before >> total & 1:
            total -= length
            used[length] += 1
    return used


def windows(lengths: list[int], capacity: int = CAPACITY) -> Iterator[list[int]]:
    """Pack a multiset of lengths; yields the lengths of each window."""
    stock = Counter(lengths)
    order = sorted(stock, reverse=True)
    at = 0
    while at < len(order):
        longest = order[at]
        if not stock[longest]:
            at += 1
            del stock[longest]
            continue
        stock[longest] -= 1
        used, reach = closest_fill(+stock if len(stock) < 64 else stock, capacity - longest)
        total = longest + sum(k * n for k, n in used.items())
        if total < capacity:
            # no exact fill: an unpadded power of two that holds as much or more of it
            for b in range(total.bit_length() - 1, -1, -1):
                exact = (1 << b) - longest
                if exact >= 0 and 2 * (1 << b) > total and reach >> exact & 1:
                    used = closest_fill(+stock, exact)[0]
                    break
        stock.subtract(used)
        yield [longest, *used.elements()]


def placed(rests: DataFrame, capacity: int) -> DataFrame:
    """Give every rest of a partition its sequence and offset."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        length = rows["length"].to_numpy()
        by_length: dict[int, list[int]] = {}
        for i in np.lexsort([rows["start"].to_numpy(), length])[::-1]:
            by_length.setdefault(int(length[i]), []).append(int(i))
        group = TaskContext.get().partitionId()
        order, seq, off = [], [], []
        for w, window in enumerate(windows(length.tolist(), capacity)):
            at = 0
            for size in window:
                order.append(by_length[size].pop())
                seq.append((group << 32) + w)
                off.append(at)
                at += size
        got = rows.take(pa.array(order)).append_column("sequence_id", pa.array(seq, pa.int64())).append_column(
            "offset", pa.array(off, pa.int64()))
        yield from got.to_batches()

    return rests.mapInArrow(run, PLACED)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         group_rests: int = 30_000) -> DataFrame:
    """Every piece of every document with its sequence and offset there."""
    cut = table(pieces(docs, path, capacity, end_id), "pieces")
    rests = cut.filter(F.col("length") < capacity)
    groups = max(1, round(rests.count() / group_rests))
    whole = cut.filter(F.col("length") == capacity).select(
        "*", (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed(rests.repartition(groups), capacity).unionByName(whole)
