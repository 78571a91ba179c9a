"""Byte-level BPE, encoding and decoding, with a contiguous rank array per word.

A text is split at the special strings, then by the vocabulary's pre-tokenisation
pattern into short words. Each word starts as one part per byte, kept in two
parallel lists: part ids (the boundaries) and the ranks of adjacent pairs. The
smallest rank is found by scanning the list; its boundary is deleted and the ranks
of the two neighbouring pairs are refreshed, until no pair can merge. Words of more
than ``SHORT`` bytes take the same merges from a heap instead, so that a very long
run of letters costs n log n. Results are cached per worker, in bounded memory.

A null text counts as empty: no ids, empty decoded text. Work is per row: repeated
rows and ties need nothing special; empty table: empty result. Columns other than
``doc_id`` and ``text`` are not read. The tokenizer file is a parameter; ids equal
those of the tokenizers library on the same file. The library's Unicode tables may be
older than those of ``regex``: letters and numbers that it lacks are found once, on the
driver, and count as neither, as they do there.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterable
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.llm.common import arrow_batches, hex_sha256

SHORT = 256
CACHE = 400_000
#: The pre-tokenisation pattern of byte-level BPE; white space is Unicode's.
_S = r"\t-\r \x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
NO_RANK = 1 << 60
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> dict[str, int]:
    """The printable character by which byte-level vocabularies write each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def newer_characters() -> tuple[str, str]:
    """Letters and numbers of ``regex`` that the tokenizers library does not know as such,
    as ranges for a character class."""
    from tokenizers import Regex, pre_tokenizers
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))

    def lacking(kind: str) -> str:
        ours = "".join(regex.findall(rf"\p{{{kind}}}+", every))
        left = pre_tokenizers.Split(Regex(rf"\p{{{kind}}}+"), "removed").pre_tokenize_str(ours)
        ranges: list[list[int]] = []
        for c in map(ord, "".join(part for part, _ in left)):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
        return "".join(f"{chr(low)}-{chr(high)}" for low, high in ranges)

    return lacking("L"), lacking("N")


class Bpe:
    """Vocabulary, merge ranks, special strings, and the worker's cache. ``newer``: what
    ``newer_characters`` found."""

    def __init__(self, path: str, newer: tuple[str, str] | None = None):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        self.of_byte = [0] * 256
        for c, b in letters.items():
            self.of_byte[b] = vocab[c]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.at_special = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.split = regex.compile(PATTERN).findall
        letters_, numbers_ = newer_characters() if newer is None else newer
        self.at_newer, self.split_newer = None, self.split
        if letters_ or numbers_:
            self.at_newer = re.compile(f"[{letters_}{numbers_}]").search
            older = PATTERN
            for kind, ranges in (("L", letters_), ("N", numbers_)):
                if ranges:
                    older = older.replace(rf"\p{{{kind}}}", rf"[\p{{{kind}}}--[{ranges}]]")
            self.split_newer = regex.compile("(?V1)" + older).findall
        self.cache: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self.cache) >= CACHE:
            self.cache.clear()
        data = word.encode()
        ids = self.short(data) if len(data) <= SHORT else self.long(data)
        got = tuple(ids)
        if len(data) <= SHORT:
            self.cache[word] = got
        return got

    def short(self, data: bytes) -> list[int]:
        merges, of_byte = self.merges, self.of_byte
        parts = [of_byte[b] for b in data]
        none = (NO_RANK, 0)
        pairs = [merges.get(p, none) for p in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best is none or best[0] == NO_RANK:
                break
            i = pairs.index(best)
            parts[i:i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = merges.get((parts[i - 1], parts[i]), none)
            if i < len(pairs):
                pairs[i] = merges.get((parts[i], parts[i + 1]), none)
        return parts

    def long(self, data: bytes) -> list[int]:
        merges = self.merges
        parts: list[int | None] = [self.of_byte[b] for b in data]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[p][0], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = merges[a, b][1], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                p = parts[i], parts[after[i]]
                if p in merges:
                    heapq.heappush(heap, (merges[p][0], i, *p))
            if before[i] >= 0:
                p = parts[before[i]], parts[i]
                if p in merges:
                    heapq.heappush(heap, (merges[p][0], before[i], *p))
        return [p for p in parts if p is not None]

    def encode(self, text: str) -> list[int]:
        if self.at_special is not None and self.at_special.search(text):
            ids: list[int] = []
            for i, part in enumerate(self.at_special.split(text)):
                ids.extend([self.special[part]] if i % 2 else self.ordinary(part))
            return ids
        return self.ordinary(text)

    def ordinary(self, text: str) -> list[int]:
        get, missing, split = self.cache.get, self.__missing__, self.split
        if self.at_newer is not None and not text.isascii() and self.at_newer(text):
            split = self.split_newer
        return list(chain.from_iterable(get(w) or missing(w) for w in split(text)))

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, Bpe] = {}


def loaded(path: str, newer: tuple[str, str] | None = None) -> Bpe:
    if path not in _LOADED:
        _LOADED[path] = Bpe(path, newer)
    return _LOADED[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of every whole text."""
    arrow_batches(docs.sparkSession)
    newer = newer_characters()

    def run(batches):
        bpe = loaded(path, newer)
        for batch in batches:
            ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and the text that the ids stand for (null ids: empty)."""
    arrow_batches(rows.sparkSession)

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            texts = [bpe.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digests of the ids of every text and of the text decoded from them, in one pass."""
    arrow_batches(docs.sparkSession)
    newer = newer_characters()

    def run(batches):
        bpe = loaded(path, newer)
        for batch in batches:
            n, shas, back = [], [], []
            for text in batch.column(1).to_pylist():
                ids = bpe.encode(text or "")
                n.append(len(ids))
                shas.append(hex_sha256(",".join(map(str, ids)).encode()))
                back.append(hex_sha256(bpe.decode(ids).encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)
