"""Null and repeated doc_ids in the operators that give a result per row, and very long texts."""

from __future__ import annotations

import random
from collections import Counter

import brute
import public_tokenizers
from conftest import frame

from hrforge.llm import bpe, packing, quality_forest, secrets, surrogates, toxicity

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def counted(rows):
    return Counter(tuple(r) for r in rows)


def test_packing(spark, odd_ids):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORD_BPE)
    got = [r.asDict() for r in packing.pack(frame(spark, odd_ids), WORD_BPE).collect()]
    want, have = Counter(), Counter()
    for d, text in odd_ids:
        want[d] += len(t.encode(text or "", add_special_tokens=False).ids) + 1
    for r in got:
        have[r["doc_id"]] += r["length"]
    assert have == want
    filled = Counter()
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled[r["sequence_id"]]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 4096


def test_bpe(spark, odd_ids):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE_BPE)
    want = []
    for d, text in odd_ids:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((d, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(t.decode(ids, skip_special_tokens=False))))
    got = bpe.round_trip(frame(spark, odd_ids), BYTE_BPE).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert counted(got) == counted(want)


def test_surrogates(spark, odd_ids):
    key = b"a key of this test"
    got = surrogates.replace_pii(frame(spark, odd_ids), key).select("doc_id", "text", "n_entities").collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in odd_ids)
    # the ids have no part in the replacements: numbered rows of the same texts give the same
    plain = {r["doc_id"]: (r["text"], r["n_entities"]) for r in surrogates.replace_pii(
        frame(spark, [(i, t) for i, (_, t) in enumerate(odd_ids)]), key).collect()}
    assert counted(got) == counted((d, *plain[i]) for i, (d, _) in enumerate(odd_ids))


def test_secrets(spark, odd_ids):
    got = secrets.secret_spans(frame(spark, odd_ids)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256").collect()
    assert counted(got) == counted((d, *brute.secret_base(t)) for d, t in odd_ids)


def test_toxicity(spark, odd_ids):
    rng = random.Random(2)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    bad = [(20_000 + i, " ".join(rng.choice(words) for _ in range(30)) + (" you rotter." if i % 5 == 0 else ".")) for i in range(600)]
    marks = spark.createDataFrame([(d, 1, int("rotter" in t)) for d, t in bad] + [(None, 0, 1), (150, 1, 0), (150, 1, 1), (20_001, 1, None)],
                                  "doc_id long, quality int, toxic int")
    rows = odd_ids + [(None, "you rotter"), (150, "you rotter"), (150, "y " * 200_000 + ". you rotter.")] + bad
    docs = frame(spark, rows)
    model = toxicity.train(docs, marks)
    got = toxicity.score(docs, model).select("doc_id", "predicted").collect()
    assert counted(got) == counted((d, int("rotter" in (t or ""))) for d, t in rows)
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert counted((r["doc_id"], r["text"]) for r in kept.collect()) == counted((d, t) for d, t in rows if "rotter" not in (t or ""))
    asked = docs.select("doc_id", toxicity.held_out(docs["doc_id"]).alias("h")).filter("doc_id is null").collect()
    assert {r["h"] for r in asked} == {None}


def test_quality(spark, odd_ids):
    long_text = " ".join(f"word{i % 90_000}" for i in range(300_000))
    rows = odd_ids + [(9, long_text)]
    marks = spark.createDataFrame([(150, 1, 0), (150, 0, 0), (None, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_forest.judge(frame(spark, rows), marks)
    base = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert counted(base) == counted((d, *brute.quality_base(t)) for d, t in rows)
    for r in got.collect():
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] in (True, False) and not (r["kept"] and r["base_failed"])


def test_binomial_tail():
    from math import comb, exp
    for n, k, p in [(4, 4, 0.05), (20, 3, 0.3), (200, 30, 0.05), (7, 0, 0.5)]:
        exact = sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k, n + 1))
        assert abs(exp(toxicity.log_tail(n, k, p)) - exact) < 1e-9 * exact
