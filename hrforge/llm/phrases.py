"""Phrase collocations mined by shards (SON) and counted exactly.

Texts are lower-cased (A-Z only) and split at ``.,;:!?`` and line ends into pieces, and those
at blanks and tabs into words. Everything is counted for each lang (null: ``und``). A phrase
has 2 to ``longest`` words of one piece; candidates are found ``support`` times or more,
overlaps included.

1. Words. A phrase is no more frequent than its words, so words found fewer than
   ``support`` times end every phrase. They are counted by hash partitions.
2. Shards. A document belongs to one of SHARDS shards by the hash of its doc_id. What is found
   ``support`` times in all is found support / SHARDS times in at least one shard: with
   that lowered support each shard is mined completely, first its pairs, then longer phrases,
   whose pairs are all frequent in the shard. A shard is a share of the corpus, not a
   task: its counts are gathered by many tasks and merged by hash partitions, so the
   lowered support is the same at every size of the corpus.
3. Union. Phrases frequent in any shard become a bit map, which has no false negatives.
4. Count. A second pass over all texts counts the phrases of the union (and the words)
   by their text, task by task and then by hash partitions; the sums are exact, and those
   below ``support`` go, false positives included.
5. Score. Each candidate is joined with the counts of both parts of each of its cuts. The lowest
   score counts, ties to the shortest first part. Candidates within a longer candidate that is
   found at least ``absorb`` / 100 times as often go. The best ``top`` of each lang stay, chosen in
   salted groups first, so that no task sorts a whole lang.

Hashes have 61 bits or more. A clash in steps 1 to 3 only lets more phrases through to the count.
The bit maps have at most 2**29 cells; fuller ones do so as well. In step 4 one
buffer of text takes phrases of one 64-bit hash for the same.

Odd cases: null and empty texts have no words. Equal rows all count; a null doc_id has a shard,
too. Ties in all of score, count and phrase cannot occur. Empty table: empty result. Columns other
than doc_id, text and lang are not read. Memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hrforge.llm.common import U64, _hash_words, arrow_batches, grams, mix64, share, slice_bits, table, text_bytes
from hrforge.llm.sketch import Bits, gather, key_bits, totals

SUPPORT, LONGEST, ABSORB, TOP = 100, 5, 100, 2000
#: Shards of the corpus, as a power of two.
SHARD_BITS = 3
SHARDS = 1 << SHARD_BITS
#: Bytes of text that are counted at once in step 4.
CHUNK = 4 << 20
#: Groups of a lang in which the best phrases are looked for first.
SALTS = 32
#: Counts that a task of step 4 holds before it adds them up by phrase.
HELD = 1 << 20

_BLANK, _END = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True


class Pieces(NamedTuple):
    """Words of a batch: bytes, hash, the piece and row each stands in."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    piece: np.ndarray
    row: np.ndarray


def pieces(col: pa.Array) -> Pieces:
    data, at = text_bytes(col)
    none = np.empty(0, np.int64)
    if not len(data):
        return Pieces(data, none, none, np.empty(0, U64), none, none)
    stop = _END[data]
    inside = ~(_BLANK[data] | stop)
    heads = at[:-1][at[:-1] < len(data)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(at, starts, "right") - 1
    return Pieces(data, starts, ends, _hash_words(data, starts, ends, True), np.cumsum(stop)[starts] + row, row)


def phrase_keys(p: Pieces, n: int, lang: np.ndarray) -> np.ndarray:
    """Keys of the runs of ``n`` words from each word on (within pieces or not)."""
    return mix64((p.hashes if n == 1 else grams(p.hashes, n)) ^ lang[p.row[:max(0, len(p.row) - n + 1)]])


def within(ok: np.ndarray, n: int) -> np.ndarray:
    """Where ``n`` places from here on are all ``ok``."""
    m = max(0, len(ok) - n + 1)
    out = ok[:m].copy()
    for j in range(1, n):
        out &= ok[j:j + m]
    return out


def together(p: Pieces, common: np.ndarray) -> np.ndarray:
    """Per word but the last: whether it and the next one are ``common`` and of one piece."""
    return common[:-1] & common[1:] & (p.piece[:-1] == p.piece[1:])


def lang_hashes(col: pa.Array) -> np.ndarray:
    seen: dict[str, int] = {}
    return np.array([seen.get(x) or seen.setdefault(x, xxhash.xxh3_64_intdigest(x)) for x in col.to_pylist()], U64)


def _in_shard(keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
    return (keys & ~U64(SHARDS - 1)) | shard


def _corpus(docs: DataFrame) -> DataFrame:
    return docs.select("text", F.coalesce(F.col("lang"), F.lit("und")).alias("lang"),
                       F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).alias("shard"))


def frequent_words(corpus: DataFrame, support: int, bits: int) -> DataFrame:
    """Packed counts of the words (mixed with their lang) found ``support`` times or more."""

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        p = pieces(batch.column(0))
        yield phrase_keys(p, 1, lang_hashes(batch.column(1)))

    return totals(gather(corpus, keys_of, bits), support, "phrase-words")


def mined_pairs(corpus: DataFrame, words, local: int, bits: int) -> DataFrame:
    """Pairs found ``local`` times or more in a shard; the last bits of a key are the shard."""

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        p, lang = pieces(batch.column(0)), lang_hashes(batch.column(1))
        pair = together(p, words.value.hit(phrase_keys(p, 1, lang)))
        shard = batch.column(2).to_numpy().astype(U64)[p.row]
        yield _in_shard(phrase_keys(p, 2, lang)[pair], shard[:-1][pair])

    return totals(gather(corpus, keys_of, bits), local, "phrase-pairs")


def mined_longer(corpus: DataFrame, words, pairs, local: int, longest: int, bits: int) -> DataFrame:
    """Phrases of 3 words and more found ``local`` times or more in a shard."""

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        p, lang = pieces(batch.column(0)), lang_hashes(batch.column(1))
        pair = together(p, words.value.hit(phrase_keys(p, 1, lang)))
        shard = batch.column(2).to_numpy().astype(U64)[p.row]
        at = np.flatnonzero(pair)
        pair[at] = pairs.value.hit(_in_shard(phrase_keys(p, 2, lang)[at], shard[at]))
        for n in range(3, longest + 1):
            at = np.flatnonzero(within(pair, n - 1))
            yield _in_shard(phrase_keys(p, n, lang)[at], shard[at])

    return totals(gather(corpus, keys_of, bits), local, "phrase-longer")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(0).nbytes
        if size >= CHUNK:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _counted_chunk(batch: pa.RecordBatch, words: Bits, union: Bits, longest: int) -> Iterator[pa.RecordBatch]:
    """(key, lang, phrase, f) of the phrases of the union and of frequent words in one chunk,
    and (key, lang, "", number of words)."""
    langs = batch.column(1).dictionary_encode()
    names, code = langs.dictionary, langs.indices.to_numpy()
    hashes = np.array([xxhash.xxh3_64_intdigest(x) for x in names.to_pylist()], U64)
    lang = hashes[code]
    p = pieces(batch.column(0))
    yield _rows(hashes, names, np.arange(len(names)), [b""] * len(names), np.bincount(code[p.row], minlength=len(names)))
    one = phrase_keys(p, 1, lang)
    common = words.hit(one)
    pair = together(p, common) if len(one) else np.empty(0, bool)
    lower = p.data.copy()
    capital = (lower >= 0x41) & (lower <= 0x5A)
    lower[capital] += 0x20
    text = lower.tobytes()
    for n in range(1, longest + 1):
        at = np.flatnonzero(common if n == 1 else within(pair, n - 1))
        keys = one[at] if n == 1 else phrase_keys(p, n, lang)[at]
        if n > 1:
            hit = union.hit(keys >> U64(SHARD_BITS))
            at, keys = at[hit], keys[hit]
        if not len(at):
            continue
        keys, first, count = np.unique(keys, return_index=True, return_counts=True)
        at = at[first]
        phrases = [text[s:e] for s, e in zip(p.starts[at].tolist(), p.ends[at + n - 1].tolist())]
        if n > 1:
            phrases = [b" ".join(x.split()) for x in phrases]
        yield _rows(keys, names, code[p.row[at]], phrases, count)


def _rows(keys: np.ndarray, names: pa.Array, code: np.ndarray, phrases: list[bytes], f: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), names.take(pa.array(code)), pa.array(phrases, pa.binary()), pa.array(f.astype(np.int64))],
                                      ["key", "lang", "phrase", "f"])


def _added_up(counts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The counts with equal lang and phrase as one, as far as HELD rows show them."""
    held, size = [], 0
    for batch in counts:
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size >= HELD:
            held = [_merged(held)]
            size = held[0].num_rows
            if size > HELD // 2:
                yield held.pop()
                size = 0
    if held:
        yield _merged(held)


def _merged(held: list[pa.Table], by: tuple = ("key", "lang", "phrase")) -> pa.Table:
    added = pa.concat_tables(held).group_by(list(by), use_threads=False).aggregate([("f", "sum")])
    return added.select([*by, "f_sum"]).rename_columns([*by, "f"])


def _sliced(counts: pa.Table, bits: int) -> pa.RecordBatch:
    """One row per slice of the keys and lang: its phrases (which hold no line ends) and counts."""
    counts = counts.append_column("slice", pa.array((mix64(counts["key"].to_numpy()) >> U64(64 - bits)).astype(np.int32)))
    counts = counts.sort_by([("slice", "ascending"), ("lang", "ascending")])
    slices, langs = counts["slice"].to_numpy(), counts["lang"].combine_chunks().dictionary_encode()
    cuts = np.flatnonzero((np.diff(slices) != 0) | (np.diff(langs.indices.to_numpy()) != 0)) + 1
    phrases, f = counts["phrase"].to_pylist(), counts["f"].to_numpy()
    begin, end = [0, *cuts.tolist()], [*cuts.tolist(), len(phrases)]
    return pa.RecordBatch.from_arrays(
        [pa.array(slices[begin]), langs.take(pa.array(begin)).cast(pa.string()),
         pa.array([b"\n".join(phrases[i:j]) for i, j in zip(begin, end)], pa.binary()),
         pa.array([f[i:j].tobytes() for i, j in zip(begin, end)], pa.binary())], ["slice", "lang", "phrases", "counts"])


def _summed(group: pa.Table, support: int) -> pa.Table:
    """Exact counts of one slice, by the text of the phrases."""
    parts = []
    for lang, phrases, counts in zip(group["lang"].to_pylist(), group["phrases"].to_pylist(), group["counts"].to_pylist()):
        text = phrases.split(b"\n")
        parts.append(pa.table({"lang": pa.array([lang] * len(text), pa.string()), "phrase": pa.array(text, pa.binary()),
                               "f": pa.array(np.frombuffer(counts, np.int64))}))
    added = _merged(parts, ("lang", "phrase"))
    keep = pc.or_(pc.greater_equal(added["f"], support), pc.equal(pc.binary_length(added["phrase"]), 0))
    added = added.filter(keep)
    return added.set_column(1, "phrase", added["phrase"].cast(pa.string()))


def phrase_counts(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, f of all words and phrases found ``support`` times or more, and
    (lang, "", number of words)."""
    arrow_batches(docs.sparkSession)
    corpus, bits = _corpus(docs), slice_bits(docs)
    local = -(-support // SHARDS)
    words = share(docs, key_bits(frequent_words(corpus, support, bits)))
    in_pairs = mined_pairs(corpus, words, local, bits)
    pairs = share(docs, key_bits(in_pairs))
    longer = mined_longer(corpus, words, pairs, local, longest, bits)
    union = share(docs, key_bits(in_pairs.unionByName(longer), shift=SHARD_BITS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = (c for chunk in _chunks(batches) for c in _counted_chunk(chunk, words.value, union.value, longest))
        for added in _added_up(chunks):
            yield _sliced(added, bits)

    found = corpus.mapInArrow(count, "slice int, lang string, phrases binary, counts binary")
    return table(found.groupBy("slice").applyInArrow(lambda group: _summed(group, support), "lang string, phrase string, f long"), "phrase-counts")


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score of every candidate: its lowest cut."""
    sizes = table(counts.filter("phrase = ''").select("lang", F.col("f").alias("n")), "lang-sizes")
    words = F.split("phrase", " ")
    f = counts.filter("phrase <> ''").withColumn("words", words)
    m = F.size("words")
    cuts = f.filter(m > 1).select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.transform(
        F.sequence(F.lit(1), m - 1), lambda k: F.struct(k.alias("k"), _joined(F.col("words"), F.lit(1), k).alias("left"),
                                                        _joined(F.col("words"), k + 1, F.size("words") - k).alias("right")))).alias("cut"))
    part = f.select(F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    cuts = cuts.select("lang", "phrase", "words", "a", "cut.*")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = (cuts.join(part, (cuts["lang"] == part["part_lang"]) & (cuts[side] == part["part"]))
                .withColumnRenamed("part_f", name).drop("part", "part_lang"))

    def wide(c: str) -> Column:
        return F.col(c).cast("decimal(38,0)")

    cuts = cuts.join(sizes, "lang").withColumn("top", F.lit(1000).cast("decimal(38,0)") * wide("a") * wide("n"))
    cuts = cuts.withColumn("parts", wide("l") * wide("r")).withColumn("score", F.expr("top div parts"))
    return cuts.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("low")).select(
        "lang", "phrase", "words", "a", "low.l", "low.r", "n", "low.score")


def absorbed(candidates: DataFrame) -> DataFrame:
    """lang, phrase, longer_f: the highest count of a longer candidate that holds the phrase."""
    m = F.size("words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), m - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.size("words") - size + 1), lambda i: _joined(F.col("words"), i, size))))
    return (candidates.filter(m > 2).select(F.col("lang").alias("in_lang"), F.explode(F.array_distinct(inner)).alias("inner"), "a")
            .groupBy("in_lang", "inner").agg(F.max("a").alias("longer_f")))


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, absorb: int = ABSORB, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of each lang."""
    best = table(scored(phrase_counts(docs, support, longest)), "phrase-scores")
    longer = absorbed(best)
    left = best.join(longer, (best["lang"] == longer["in_lang"]) & (best["phrase"] == longer["inner"]), "left").filter(
        F.col("longer_f").isNull() | (100 * F.col("longer_f") < absorb * F.col("a")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = Window.partitionBy("lang", "salt").orderBy(*order)
    few = (left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
           .withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= top))
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
