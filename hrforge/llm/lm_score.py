"""Stupid-backoff language-model scores, computed relationally.

The model is counted over all documents. Every word is kept, with its count; n-grams of
2 up to ``order`` words are kept when seen ``cut`` times or more (1: all of them). All counts are in
tables partitioned by hash: words are known by 64-bit hashes, n-grams by 64-bit hashes
of their words' hashes, so no number of words is too many. With
S(w | h) = c(h w) / c(h) if h w is kept, else ALPHA * S(w | h without its first word),
and S(w) = c(w) / N, a document's score is the mean of log S over its words. N-grams
stay within a document; its first words have shorter histories and no penalty.

Jobs: for each length, counts of the n-grams whose parts are seen twice or more (a Bloom
bit map of bounded size says which may be); then every document's n-grams are
exploded, reduced to distinct (document, n-gram, weight) entries, sent to the hash
partition of the count table of their length, and summed per document.

With ``cut`` 1 every n-gram of the corpus is in the model, so nothing backs off, and what a
text asks is known where it is read: the count of each n-gram and, with weight -1, of each
history. An n-gram that the bit map lacks is seen once, and its logarithm is 0. The
others go to the tables of all lengths in one exchange; the tables hold the counts of
2 and more, and an entry that its table lacks is seen once. With a larger ``cut`` an entry that
the table lacks goes on to the next shorter length, down to the single words. Words and
n-grams that make up ``1 / HOT`` of all words or more are looked up where they are found
(their counts, at most ``HOT`` a length, are broadcast), so no partition gets a hot
n-gram's documents. What is counted and moved grows with the corpus; the tables, of any
size, stay partitioned.

Logarithms are added up as integers, in units of 2**-32, so the order of the sums does not
matter: equal texts get equal scores, bit by bit.

A null text counts as empty: no words, score null. Empty
table: empty result. Long texts are scored whole. Columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.llm.common import _GRAM as GRAM
from hrforge.llm.common import U64, arrow_batches, grams, mix64, plan_bytes, power_of_two, share, words
from hrforge.llm.sketch import (Bits, cells, frequent, from_planes, gather, lookup, packed_rows, planes,
                                slice_total, totals, unpack, width)

ORDER, ALPHA, CUT = 3, 0.4, 1
#: Units of a logarithm.
UNIT = 1 << 32
#: Input bytes for a hash partition: its count tables and entries fit in a task.
PARTITION = 8 << 20
HOT = 1 << 19
#: Entries a task holds at a time.
HELD = 1 << 17
#: Cells of the bit map of a length for each byte of input: there are fewer words than n-grams.
CELLS = {1: 1 / 16}


def runs(rows: np.ndarray, n: int) -> np.ndarray:
    """Places of a batch's words where ``n`` words of one row begin."""
    left = np.repeat(rows[1:], np.diff(rows)) - np.arange(rows[-1])
    return np.flatnonzero(left >= n)


def ngram_keys(h: np.ndarray, n: int) -> np.ndarray:
    """Keys of all runs of ``n`` words: the word's own hash, or one of its words' hashes."""
    return h if n == 1 else grams(h, n)


def keys_of_columns(columns: np.ndarray) -> np.ndarray:
    """Keys of n-grams whose j-th words are ``columns[j]``."""
    if len(columns) == 1:
        return columns[0]
    out = columns[0] * GRAM[0]
    for word, factor in zip(columns[1:], GRAM[1:]):
        out = out + word * factor
    return mix64(out)


def fixed(x: float | np.ndarray) -> np.ndarray:
    """Logarithm in units."""
    return np.rint(np.log(x) * UNIT).astype(np.int64)


def kept_bits(counted: DataFrame, bits: int, least: int) -> Bits:
    """Bloom bit map of the keys counted ``least`` times or more, merged from the slices."""
    salt = 0x452821E638D01377
    # (slice of the map, bits) rows: a map part is OR-ed once per table partition
    cut = min(12, bits - 3)

    def run(batches):
        for b in batches:
            often = unpack(b.column("counts"), np.int64) >= least
            c = np.unique(cells(unpack(b.column("keys"), U64)[often], salt, bits))
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


def partition_bits(docs: DataFrame) -> int:
    return power_of_two(plan_bytes(docs) / PARTITION, 5, 20)


class Model(NamedTuple):
    """What map tasks hold: number of words, per length a bit map and the hot counts, and
    numbers for the hot words (from 1, by falling count): of each hash, and its hash of each."""

    total: int
    maps: dict[int, Bits]
    hot: dict[int, tuple[np.ndarray, np.ndarray]]
    numbers: np.ndarray
    named: np.ndarray


def train(docs: DataFrame, order: int = ORDER, least: int = 2, words_least: int = 1) -> tuple[Model, dict[int, DataFrame]]:
    """The model and the count tables (packed by slice) for 1 up to ``order`` words; those of
    2 words and more hold the n-grams counted ``least`` (2 or more) times, and the first one the
    words counted ``words_least`` times."""
    bits = partition_bits(docs)
    texts = docs.select("text")
    model, tables = Model(0, {}, {}, np.empty(0, np.uint32), np.zeros(1, U64)), {}
    for n in range(1, order + 1):
        known = share(docs, model.maps.get(n - 1))

        def keys_of(batch, n=n, known=known):
            w = words(batch.column(0))
            at, keys = runs(w.rows, n), ngram_keys(w.hashes, n)
            if n > 1 and len(at):  # both parts must be kept, or the whole can't be
                part = known.value.hit(ngram_keys(w.hashes, n - 1))
                at = at[part[at] & part[at + 1]]
            yield keys[at]

        tables[n] = totals(gather(texts, keys_of, bits), words_least if n == 1 else least, f"counts-{n}")
        known.unpersist()
        if n == 1:
            model = model._replace(total=slice_total(tables[1]))
        model.maps[n] = kept_bits(tables[n], width(docs, CELLS.get(n, 0.5)), least)
        model.hot[n] = frequent(tables[n], max(words_least if n == 1 else least, -(-model.total // HOT)))
    hashes, counts = model.hot[1]
    by_count = np.argsort(-counts, kind="stable")
    numbers = np.empty(len(hashes), np.uint32)
    numbers[by_count] = np.arange(1, len(hashes) + 1)
    del model.maps[1]  # only the counting of pairs asks it
    return model._replace(numbers=numbers, named=np.append(U64(0), hashes[by_count])), tables


class Entries(NamedTuple):
    """Weighted n-grams of documents: hashes of the words by place, key, document, ``tgt``
    occurrences to be scored, ``ctx`` uses as the history of a scored longer n-gram."""

    words: np.ndarray
    key: np.ndarray
    doc: np.ndarray
    tgt: np.ndarray
    ctx: np.ndarray

    def only(self, keep: np.ndarray) -> Entries:
        return Entries(self.words[:, keep], *(x[keep] for x in self[1:]))

    def distinct(self) -> Entries:
        """One entry for each document and n-gram."""
        if len(self.key) < 2:
            return self
        # equal pairs have equal sums; should others clash, a pair only stays in two entries
        e = self.only(np.argsort(self.key + self.doc.astype(U64) * U64(0x9E3779B97F4A7C15), kind="stable"))
        at = np.flatnonzero(np.concatenate([[True], (e.key[1:] != e.key[:-1]) | (e.doc[1:] != e.doc[:-1])]))
        return Entries(e.words[:, at], e.key[at], e.doc[at], np.add.reduceat(e.tgt, at), np.add.reduceat(e.ctx, at))


def entries(columns: np.ndarray, doc: np.ndarray, tgt: np.ndarray, ctx: np.ndarray) -> Entries:
    return Entries(columns, keys_of_columns(columns), doc, tgt, ctx)


def together(parts: list[Entries]) -> Entries:
    return Entries(*(np.concatenate(x, axis=-1) for x in zip(*parts)))


def step_down(n: int, e: Entries, count: np.ndarray, total: int) -> tuple[np.ndarray, Entries | None]:
    """Log scores of entries of length n under their counts (0: not kept), and what they
    ask of the next shorter length (single words: nothing)."""
    logs = fixed(np.maximum(count, 1))
    if n == 1:
        return (e.tgt - e.ctx) * logs - e.tgt * fixed(max(total, 1)), None
    got = count > 0
    part = np.where(got, (e.tgt - e.ctx) * logs, e.tgt * fixed(ALPHA))
    history, shorter = e.only(got), e.only(~got)
    return part, entries(
        np.concatenate([history.words[:-1], shorter.words[1:]], axis=1), np.concatenate([history.doc, shorter.doc]),
        np.concatenate([np.zeros_like(history.tgt), shorter.tgt]), np.concatenate([history.tgt, shorter.tgt * 0]))


def settle_locally(n: int, e: Entries | None, known: Model) -> tuple[list[tuple], dict[int, Entries]]:
    """Follow entries of length n down as far as no count table is needed: (doc, log
    score) arrays, and by length the entries that only the table can settle."""
    done, left = [], {}
    while n > 0:
        e = e.distinct()
        count = lookup(*known.hot[n], e.key)
        ask = count == 0
        if n > 1:  # every word is in its table
            ask &= known.maps[n].hit(e.key)
        left[n] = e.only(ask)
        e, count = e.only(~ask), count[~ask]
        part, down = step_down(n, e, count, known.total)
        done.append((e.doc, part))
        n, e = n - 1, down
    return done, left


SCHEMA = pa.schema([("n", pa.int32()), ("slice", pa.int32()), ("docs", pa.binary()), ("keys", pa.binary()), ("cold", pa.binary()),
                    ("tgts", pa.binary()), ("ctxs", pa.binary()), ("parts", pa.binary()),
                    ("ids", pa.list_(pa.int64())), ("words", pa.list_(pa.int64()))])
FLOW = ("n int, slice int, docs binary, keys binary, cold binary, tgts binary, ctxs binary, parts binary, "
        "ids array<bigint>, words array<bigint>")


def _batch(n: int, packed: pa.RecordBatch | None) -> list[pa.RecordBatch]:
    if packed is None:
        return []
    size = packed.num_rows
    cols = {f: packed.column(f) for f in packed.schema.names} | {"n": pa.array(np.full(size, n, np.int32))}
    return [pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(size, f.type)) for f in SCHEMA], schema=SCHEMA)]


def _slices(keys: np.ndarray, bits: int) -> np.ndarray:
    return mix64(keys.view(U64)) >> U64(64 - bits)


def entry_rows(n: int, e: Entries, bits: int, known: Model) -> list[pa.RecordBatch]:
    """Entries for the count table of length n, by slice of the n-gram. A hot word goes as
    its number, any other as 0 and its hash in ``cold``."""
    slices = _slices(e.key, bits)
    order = np.argsort(slices, kind="stable")
    words_of = e.words.T[order]
    code = lookup(known.hot[1][0], known.numbers, words_of.ravel()).reshape(words_of.shape)
    cold = words_of[code == 0]
    packed = packed_rows(["slice", "keys", "docs", "tgts", "ctxs"], slices[order],
                         [code, e.doc[order], e.tgt[order].astype(np.int32), e.ctx[order].astype(np.int32)], planes)
    if packed is None:
        return []
    ends = np.flatnonzero(np.diff(slices[order])) + 1
    upto = np.append(0, np.cumsum((code == 0).sum(1)))
    return _batch(n, packed.append_column("cold", pa.array([x.tobytes() for x in np.split(cold, upto[ends])], pa.binary())))


def read_entries(n: int, own: pa.Table, known: Model) -> Entries:
    code = from_planes(own["keys"], np.uint32, n).reshape(-1, n)
    found = known.named[code]
    found[code == 0] = unpack(own["cold"], U64)
    return entries(np.ascontiguousarray(found.T), from_planes(own["docs"], np.int64),
                   from_planes(own["tgts"], np.int32).astype(np.int64), from_planes(own["ctxs"], np.int32).astype(np.int64))


def pieces(own: pa.Table) -> Iterator[pa.Table]:
    """Rows of about ``HELD`` entries: scores are sums, so entries may be settled apart."""
    upto = np.cumsum(pc.binary_length(own["docs"]).to_numpy().astype(np.int64)) // 8 // HELD
    at = [0, *np.flatnonzero(np.diff(upto)) + 1, len(upto)]
    for a, b in zip(at, at[1:]):
        yield own.slice(a, b - a)


def summed(keys: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their parts (integers)."""
    if not len(keys):
        return keys, parts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(parts[order], at)


def sum_rows(done: list[tuple], bits: int) -> list[pa.RecordBatch]:
    """Log scores summed by document, by slice of the document."""
    found, total = summed(np.concatenate([d for d, _ in done]), np.concatenate([p for _, p in done]))
    return _batch(0, packed_rows(["slice", "docs", "parts"], _slices(found, bits), [found, total], planes))


def entries_of(docs: DataFrame, model, order: int, bits: int) -> DataFrame:
    """Exploded n-grams, local sums, and one row per document, in one pass. Documents are
    numbered by partition and place, so all rows of a document come from one task."""

    def run(batches):
        known = model.value
        number = TaskContext.get().partitionId() << 32
        held, size = {}, 0

        def emit():
            for n, parts in held.items():
                yield from entry_rows(n, together(parts), bits, known)
            held.clear()

        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                ids = batch.column(0).slice(i, 128).to_pylist()
                w = words(batch.column(1).slice(i, 128))
                row = np.repeat(np.arange(len(ids)), np.diff(w.rows))
                keys = np.arange(number, number + len(ids))
                number += len(ids)
                done, left = [], {}
                for n in range(1, order + 1):
                    at = runs(w.rows, n)
                    if n < order:  # shorter histories only where a text begins
                        at = at[np.isin(at, w.rows)]
                    found = entries(w.hashes[at + np.arange(n)[:, None]], row[at], np.ones(len(at), np.int64), np.zeros(len(at), np.int64))
                    got, rest = settle_locally(n, found, known)
                    done += got
                    for k, e in rest.items():
                        left.setdefault(k, []).append(e)
                for n, parts in left.items():
                    e = together(parts).distinct()
                    held.setdefault(n, []).append(e._replace(doc=keys[e.doc]))
                    size += len(e.doc)
                if size >= HELD:
                    yield from emit()
                    size = 0
                yield from sum_rows([(keys[d], p) for d, p in done], bits)
                yield from _doc_rows(ids, keys, np.diff(w.rows), bits)
        yield from emit()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FLOW)


def _doc_rows(ids: list, keys: np.ndarray, n_words: np.ndarray, bits: int) -> list[pa.RecordBatch]:
    size = len(keys)
    cols = {"n": pa.array(np.zeros(size, np.int32)), "slice": pa.array(_slices(keys, bits).astype(np.int32)),
            "docs": pa.array([k.tobytes() for k in keys], pa.binary()), "ids": pa.array([[d] for d in ids], pa.list_(pa.int64())),
            "words": pa.array([[int(x)] for x in n_words], pa.list_(pa.int64()))}
    return [pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(size, f.type)) for f in SCHEMA], schema=SCHEMA)]


def against_table(n: int, model, bits: int):
    """Settle one slice's entries of length n by its part of the count table; other rows
    pass. Returns the function for a cogroup."""

    def run(flow: pa.Table, counted: pa.Table) -> pa.Table:
        own = flow.filter(pc.equal(flow["n"], n))
        out = flow.filter(pc.not_equal(flow["n"], n)).cast(SCHEMA).to_batches()
        if own.num_rows:
            known = model.value
            keys, counts = unpack(counted["keys"], U64), unpack(counted["counts"], np.int64)
            for piece in pieces(own):
                e = read_entries(n, piece, known).distinct()
                part, down = step_down(n, e, lookup(keys, counts, e.key), known.total)
                done, left = settle_locally(n - 1, down, known)
                for k, rest in left.items():
                    out += entry_rows(k, rest.distinct(), bits, known)
                out += sum_rows([(e.doc, part), *done], bits)
        return pa.Table.from_batches(out, SCHEMA)

    return run


def finish(flow: pa.Table) -> pa.Table:
    """Scores of the documents of one slice."""
    parts = flow.filter(pc.is_valid(flow["parts"]))
    rows = flow.filter(pc.is_valid(flow["ids"]))
    found, total = summed(from_planes(parts["docs"], np.int64), from_planes(parts["parts"], np.int64))
    docs = unpack(rows["docs"], np.int64)
    n = np.array([x[0] for x in rows["words"].to_pylist()], np.int64)
    score = lookup(found, total, docs) / UNIT / np.maximum(n, 1)
    return pa.table({"doc_id": pa.array([x[0] for x in rows["ids"].to_pylist()], pa.int64()), "n_words": pa.array(n),
                     "score": pa.array(score, pa.float64(), mask=n == 0)})


# ------------------------------------------------------------------ all n-grams kept


def asked(rows: np.ndarray, n: int, order: int) -> np.ndarray:
    """Per word: how often a text's scores ask the count of the ``n`` words from it on, less the
    times they ask it as a history. Only a text's first words have histories shorter than
    ``order`` - 1 words."""
    weight = np.zeros(rows[-1], np.int64)
    for m, sign in ((n, 1), (n + 1, -1)):
        if m <= order:
            at = runs(rows, m)
            weight[at if m == order else at[np.isin(at, rows)]] += sign
    return weight


def direct_entries(docs: DataFrame, model, order: int, bits: int) -> DataFrame:
    """For every length the (document, n-gram, weight) entries that only the count tables can
    settle, the sums of the others, and one row per document, in one pass."""

    def run(batches):
        known = model.value
        number = TaskContext.get().partitionId() << 32
        held, size = {}, 0

        def emit():
            for n, parts in held.items():
                keys, numbers, weights = (np.concatenate(x) for x in zip(*parts))
                mixed = mix64(keys)
                yield from _batch(n, packed_rows(["slice", "keys", "docs", "tgts"], mixed >> U64(64 - bits),
                                                 [mixed, numbers, weights.astype(np.int32)], planes))
            held.clear()

        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                ids = batch.column(0).slice(i, 128).to_pylist()
                w = words(batch.column(1).slice(i, 128))
                row = np.repeat(np.arange(len(ids)), np.diff(w.rows))
                numbers = np.arange(number, number + len(ids))
                number += len(ids)
                done = [(numbers, (np.diff(w.rows) > 0) * -np.diff(w.rows) * fixed(max(known.total, 1)) if order == 1
                         else (np.diff(w.rows) > 0) * -fixed(max(known.total, 1)))]
                for n in range(1, order + 1):
                    weight = asked(w.rows, n, order)
                    at = np.flatnonzero(weight)
                    doc, key, weight = distinct(row[at], ngram_keys(w.hashes, n)[at], weight[at])
                    count = lookup(*known.hot[n], key)
                    done.append((numbers[doc], weight * fixed(np.maximum(count, 1))))
                    ask = count == 0
                    if n > 1:  # one that the map lacks is seen once
                        ask &= known.maps[n].hit(key)
                    held.setdefault(n, []).append((key[ask], numbers[doc[ask]], weight[ask]))
                    size += int(ask.sum())
                if size >= 4 * HELD:
                    yield from emit()
                    size = 0
                yield from sum_rows(done, bits)
                yield from _doc_rows(ids, numbers, np.diff(w.rows), bits)
        yield from emit()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FLOW)


def distinct(doc: np.ndarray, key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry for each document and n-gram; those whose weights add up to 0 go."""
    if not len(key):
        return doc, key, weight
    order = np.argsort(key + doc.astype(U64) * U64(0x9E3779B97F4A7C15), kind="stable")
    doc, key, weight = doc[order], key[order], weight[order]
    at = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]))
    weight = np.add.reduceat(weight, at)
    keep = weight != 0
    return doc[at][keep], key[at][keep], weight[keep]


def for_lookup(tables: dict[int, DataFrame]) -> DataFrame:
    """The counts of 2 and more, with mixed keys in order, packed to be moved."""

    def run(batches):
        for b in batches:
            keys, counts = [], []
            for i in range(b.num_rows):
                mixed, n = mix64(unpack(b.column("keys").slice(i, 1), U64)), unpack(b.column("counts").slice(i, 1), np.int64)
                mixed, n = mixed[n > 1], n[n > 1]
                order = np.argsort(mixed)
                keys.append(planes(mixed[order]) if len(order) else b"")
                counts.append(planes(n[order]) if len(order) else b"")
            yield pa.RecordBatch.from_arrays([b.column("n"), b.column("slice"), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
                                             ["n", "slice", "keys", "counts"])

    every = reduce(DataFrame.unionByName, [t.select(F.lit(n).alias("n"), "slice", "keys", "counts") for n, t in tables.items()])
    return every.mapInArrow(run, "n int, slice int, keys binary, counts binary")


def against_counts(order: int, bits: int):
    """Settle the entries of one slice, of all lengths; sums and document rows pass. Returns
    the function for a cogroup."""

    def run(flow: pa.Table, counted: pa.Table) -> pa.Table:
        done = []
        for n in range(1, order + 1):
            own, table_ = (x.filter(pc.equal(x["n"], n)) for x in (flow, counted))
            keys, counts = from_planes(table_["keys"], U64), from_planes(table_["counts"], np.int64)
            for piece in pieces(own) if own.num_rows else ():
                count = lookup(keys, counts, from_planes(piece["keys"], U64))
                part = from_planes(piece["tgts"], np.int32).astype(np.int64) * fixed(np.maximum(count, 1))
                done.append(summed(from_planes(piece["docs"], np.int64), part))
        out = flow.filter(pc.equal(flow["n"], 0)).cast(SCHEMA).to_batches()
        return pa.Table.from_batches(out + (sum_rows(done, bits) if done else []), SCHEMA)

    return run


def score(docs: DataFrame, order: int = ORDER, cut: int = CUT) -> DataFrame:
    """doc_id, n_words and score (mean log S; null without words) of every document."""
    if not 1 <= order <= len(GRAM) or cut < 1:
        raise ValueError(f"order is 1 to {len(GRAM)}, cut 1 or more")
    arrow_batches(docs.sparkSession)
    model, tables = train(docs, order, max(cut, 2), 2 if cut == 1 else 1)
    bits = partition_bits(docs)
    shared = share(docs, model)
    if cut == 1:
        flow = (direct_entries(docs, shared, order, bits).groupBy("slice")
                .cogroup(for_lookup(tables).groupBy("slice")).applyInArrow(against_counts(order, bits), FLOW))
    else:
        flow = entries_of(docs, shared, order, bits)
        for n in range(order, 0, -1):
            flow = flow.groupBy("slice").cogroup(tables[n].groupBy("slice")).applyInArrow(against_table(n, shared, bits), FLOW)
    return flow.filter("n = 0").groupBy("slice").applyInArrow(finish, "doc_id long, n_words long, score double")
