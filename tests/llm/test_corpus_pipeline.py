"""The pipeline's stages on a small corpus: each decision takes effect, clean rows stay."""

from __future__ import annotations

import brute
import corpus_pipeline
import public_tokenizers

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    got, states = docs, []
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, got, SF).cache()
        states.append(got)
    toxic, exact, near, masked, packed = states
    for s in states[:-1]:
        assert s.columns == cols
    before = [(r["doc_id"], r["text"]) for r in toxic.collect()]
    largest = {x[1] for x in brute.exact(before)}
    after = [(r["doc_id"], r["text"]) for r in exact.collect()]
    assert {d for d, _ in after} == largest
    assert {r["doc_id"] for r in near.collect()} == {c for _, _, c in brute.near(after)}
    texts = {r["doc_id"]: r["text"] for r in near.collect()}
    final = [(r["doc_id"], r["text"]) for r in masked.collect()]
    assert {d for d, _ in final} == set(texts)
    for d, t in final:
        assert brute.secret_base(t)[:3] == (0, 0, 0)
        if not any(brute.secret_base(texts[d])[:3]) and t != texts[d]:
            assert "[secret]" in t
    path = public_tokenizers.path("word_bpe_49k.json")
    assert brute.packing_errors(final, [r.asDict() for r in packed.collect()], path) == []


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(got.columns)
    assert got.count() > 0
