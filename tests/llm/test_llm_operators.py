"""The ten operators against brute force, round trips and held-out labels; odd cases."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import brute
import public_tokenizers
import pytest
from conftest import frame

from hrforge.llm import (bpe, components, exact_dedup, lm_score, ngram_join, packing, quality_forest, secrets,
                         substring_dedup, surrogates, toxicity)

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def ordered(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


# ------------------------------------------------------------------ 1 packing


def test_packing_covers_every_id_once(docs, rows):
    got = [r.asDict() for r in packing.pack(docs, WORD_BPE).collect()]
    assert brute.packing_errors(rows, got, WORD_BPE) == []


def test_packing_small_windows_waste_little(docs, rows):
    got = [r.asDict() for r in packing.pack(docs, WORD_BPE, capacity=64, group_rests=1000).collect()]
    assert brute.packing_errors(rows, got, WORD_BPE, 64) == []
    pad, ids = brute.padding(got, 64)
    assert pad < 0.01 * ids


def test_windows_pick_the_closest_fill():
    rng = random.Random(3)
    for _ in range(200):
        stock = Counter(rng.randint(1, 40) for _ in range(rng.randint(0, 9)))
        room = rng.randint(0, 90)
        sums = {0}
        for x in stock.elements():
            sums |= {s + x for s in sums}
        used, _ = packing.closest_fill(stock, room)
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)
        assert all(n <= stock[k] for k, n in used.items())


def test_windows_use_every_length():
    rng = random.Random(4)
    lengths = [rng.randint(1, 4095) for _ in range(3000)]
    got = list(packing.windows(lengths))
    assert Counter(x for w in got for x in w) == Counter(lengths)
    assert max(map(sum, got)) <= 4096


def test_words_have_the_ids_of_the_text():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORD_BPE)
    texts = ["A.b, c.. d!. 10,000 x0. y0 '0'", "<|endoftext|> A<|startoftext|>b <|ENDOFTEXT|>", "É é́  x　y İ ſ", "", "a" * 700]
    for text, data in zip(texts, packing.encoded(texts, WORD_BPE)):
        ids = t.encode(text, add_special_tokens=False).ids
        assert data == b"".join(i.to_bytes(4, "little") for i in ids)


def test_long_words_do_not_stay_in_memory():
    texts = ["q" * 5000 + "z", "long" * 400 + ".", "short words here."]
    first = list(packing.encoded(texts, WORD_BPE))
    assert max(map(len, packing.word_ids(WORD_BPE)[1])) <= packing.CACHED_BYTES
    assert list(packing.encoded(texts, WORD_BPE)) == first


# ------------------------------------------------------------------ 2 language model


@pytest.mark.parametrize("order,cut", [(1, 1), (2, 1), (3, 1), (4, 1), (2, 2), (3, 2), (3, 3)])
def test_backoff_scores(docs, rows, order, cut):
    want = {(d, n): s for d, n, s in brute.backoff(rows, order, cut=cut)}
    got = lm_score.score(docs, order, cut).collect()
    assert len(got) == len(rows)
    for r in got:
        s = want[r["doc_id"], r["n_words"]]
        assert (r["score"] is None) == (s is None)
        assert s is None or abs(r["score"] - s) < 1e-9


def test_backoff_with_odd_ids(spark, odd_ids):
    got = sorted((str(r["doc_id"]), r["n_words"], r["score"] or 0) for r in lm_score.score(frame(spark, odd_ids), 2).collect())
    want = sorted((str(d), n, s or 0) for d, n, s in brute.backoff(odd_ids, 2))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert sum(x[2] for x in got) == pytest.approx(sum(x[2] for x in want))


@pytest.mark.parametrize("cut", [1, 2])
def test_equal_texts_have_equal_scores(spark, rows, cut):
    copies = [(k, t) for k, (_, t) in enumerate(rows * 3)]
    got = {r["doc_id"]: r["score"] for r in lm_score.score(frame(spark, copies).repartition(7), cut=cut).collect()}
    by_text = defaultdict(set)
    for d, t in copies:
        by_text[t].add(got[d])
    assert len(got) == len(copies) and all(len(x) == 1 for x in by_text.values())


@pytest.mark.parametrize("hot,cut", [(1 << 19, 1), (16, 1), (16, 2)])
def test_every_word_is_kept(spark, monkeypatch, hot, cut):
    """Over 65,536 words; with a small ``hot`` nearly all counts come from the partitioned tables."""
    monkeypatch.setattr(lm_score, "HOT", hot)
    rng = random.Random(21)
    rare = [f"w{i}" for i in range(70_000)]
    many = [w for k, w in enumerate(rare) for _ in range(1 + k % 3)]
    rng.shuffle(many)
    rows = [(i, " ".join(many[i * 500:(i + 1) * 500] + ["the", "of"] * (i % 90))) for i in range(-(-len(many) // 500))]
    rows += [(9000 + i, " ".join(rare[i * 50:i * 50 + 60])) for i in range(60)] + [(9100, "zq " * 40), (9101, "w1 w4 w7")]
    want = {d: (n, s) for d, n, s in brute.backoff(rows, 3, vocabulary=1 << 62, cut=cut)}
    got = {r["doc_id"]: (r["n_words"], r["score"]) for r in lm_score.score(frame(spark, rows).repartition(4), cut=cut).collect()}
    assert got.keys() == want.keys()
    assert all(got[d][0] == want[d][0] and abs(got[d][1] - want[d][1]) < 1e-9 for d in want)


# ------------------------------------------------------------------ 3 BPE


def test_bpe_equals_the_library(docs, rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE_BPE)
    want = {}
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[d] = (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(t.decode(ids, skip_special_tokens=False)))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(docs, BYTE_BPE).collect()}
    assert got == want


def test_bpe_encode_then_decode(docs, rows):
    back = bpe.decode(bpe.encode(docs, BYTE_BPE), BYTE_BPE)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {d: t or "" for d, t in rows}


def test_short_and_long_words_merge_alike():
    from tokenizers import Tokenizer
    t, own = Tokenizer.from_file(BYTE_BPE), bpe.loaded(BYTE_BPE)
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("aeinorstthé ") for _ in range(rng.randint(1, 60))).encode()
        assert own.short(word) == own.long(word)
    for text in ["ab" * 400, "the" * 300, "<|endoftext|>x <|endoftext|>", "\t\n  a　 b", "'S don't WE'LL", "\x00\x1c\x1f\x85"]:
        assert own.encode(text) == t.encode(text, add_special_tokens=False).ids


def test_letters_newer_than_the_library(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE_BPE)
    letters, numbers = bpe.newer_characters()
    new = [c for c in letters + numbers if c != "-"][::7] + ["\U00011dda", "\U00011de3", "\u088f"]
    texts = [f"an{c}\u9ed6 {c}b 1{c}2 {c}{c}\u00a0{c}." for c in new]
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(frame(spark, list(enumerate(texts))), BYTE_BPE).collect()}
    assert got == {i: t.encode(x, add_special_tokens=False).ids for i, x in enumerate(texts)}


# ------------------------------------------------------------------ 4 surrogates

KEY = b"test key"


def test_surrogates_hide_originals_and_stay_distinct(docs, rows):
    got = {r["doc_id"]: r for r in surrogates.replace_pii(docs, KEY).collect()}
    pairs = {}
    for d, t in rows:
        new = got[d]["text"]
        if t is None:
            assert new is None
            continue
        old = surrogates.mentions(t)
        assert got[d]["n_entities"] == len(old)
        if not old:
            assert new == t
        for m in old:
            pairs.setdefault((m.kind, m.canon, m.gender), set()).add(m.surface)
    for d in (x for x, t in rows if t and "Mail.example" in t):
        new = got[d]["text"]
        assert not re.search(r"(?i)ann\.lee9|386|3733|4111|10\.1\.2\.3", new)
        first, second = re.findall(r"[\w.]+@[\w.]+", new)
        assert first.lower().rstrip(",") == second.lower().rstrip(",") and first != second
        card = re.search(r"\d{4} \d{4} \d{4} \d{4}", new).group().replace(" ", "")
        assert surrogates.luhn(card[:-1]) == int(card[-1]) and card[0] == "4"
        assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", new)


def test_surrogates_keep_coreference_gender_and_script():
    text = "Dr. Maria Lopez met Mr. Petrov. Lopez left; г-жа Ирина Иванова stayed with Иванова."
    new, kinds = surrogates.rewrite(text, KEY, {})
    assert not any(x in new for x in ("Maria", "Lopez", "Petrov", "Ирина", "Иванова"))
    m = re.fullmatch(r"Dr\. (\w+) (\w+) met Mr\. (\w+)\. (\w+) left; г-жа (\w+) (\w+) stayed with (\w+)\.", new)
    assert m[2] == m[4] and m[6] == m[7] and m[1].endswith("a") and m[5].endswith("а")
    assert re.fullmatch(r"[А-Яа-я]+", m[5] + m[6]) and Counter(kinds) == {"given": 2, "surname": 5}


def test_colliding_surrogates_get_another_try(spark, monkeypatch):
    def clumsy(key, kind, canon, gender, attempt):
        return f"s{(len(canon) + attempt) % 40}" if attempt < 30 else f"u{canon}{attempt}"
    monkeypatch.setattr(surrogates, "candidates", lambda rows, key, attempt: spark.createDataFrame(
        [(r["kind"], r["canon"], r["gender"], clumsy(key, r["kind"], r["canon"], r["gender"], attempt)) for r in rows.collect()],
        "kind string, canon string, gender string, surrogate string"))
    found = spark.createDataFrame([("ip", "s3", ""), ("ip", "abc", ""), ("ip", "xyz", ""), ("ip", "pqrs", ""), ("phone", "abc", "")],
                                  "kind string, canon string, gender string")
    later = {(r["kind"], r["canon"]): r["attempt"] for r in surrogates.later_tries(found, KEY).collect()}
    final = {k: clumsy(KEY, *k, "", later.get(k, 0)) for k in [("ip", "s3"), ("ip", "abc"), ("ip", "xyz"), ("ip", "pqrs"), ("phone", "abc")]}
    ips = [v for (kind, _), v in final.items() if kind == "ip"]
    assert len(set(ips)) == 4 and not set(ips) & {"s3", "abc", "xyz", "pqrs"}


def test_short_addresses_grow_where_all_are_real(spark):
    real = [("local", c, "") for c in "abcdefghijklmnopqrstuvwxyz"] + [("domain", f"{c}.org", "") for c in "abcdefghijklmnopqrstuvwxyz"]
    found = spark.createDataFrame(real, "kind string, canon string, gender string")
    later = {(r["kind"], r["canon"]): r["attempt"] for r in surrogates.later_tries(found, KEY).collect()}
    new = {surrogates.surrogate(KEY, k, c, "", later[k, c]) for k, c, _ in real}
    assert len(new) == len(real) and not new & {c for _, c, _ in real}
    tries = {(*k, ""): n for k, n in later.items()}
    out = [surrogates.rewrite(t, KEY, tries)[0] for t in ("A@B.org", "a@b.org")]
    assert out[0].lower() == out[1] and len(out[1]) > len("a@b.org")


def test_texts_of_many_entities():
    pairs = [(f"{'Q' if i % 2 else 'K'}{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}", i) for i in range(1000)]
    text = " ".join(f"Mr. {n} called +1 386 555 {i:04d}." for n, i in pairs * 5) + " " + " ".join(n for n, _ in pairs)
    found = surrogates.mentions(text)
    assert Counter(m.kind for m in found) == {"surname": 6000, "phone": 5000}
    assert all(a.end <= b.start for a, b in zip(found, found[1:]))


def test_many_later_tries_are_joined(docs):
    local = {r["doc_id"]: r["text"] for r in surrogates.replace_pii(docs, KEY).collect()}
    rows = docs.select("doc_id", "text")
    none = surrogates.entities(docs).limit(0).selectExpr("*", "1 AS attempt")
    assert {r["doc_id"]: r["text"] for r in surrogates._joined(rows, KEY, none).collect()} == local


# ------------------------------------------------------------------ 5 substring dedup


@pytest.mark.parametrize("window", [35, 10])
def test_repeated_passages(docs, rows, window):
    got = ordered(substring_dedup.remove_repeats(docs, window), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substring(rows, window), key=str)


def test_repeated_passages_with_odd_ids(spark, odd_ids):
    got = substring_dedup.remove_repeats(frame(spark, odd_ids))
    assert ordered(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.substring(odd_ids), key=str)
    assert all(brute.sha(r["kept"]) == r["kept_sha256"] for r in got.collect())


# ------------------------------------------------------------------ 6 n-gram join


def test_components_of_near_copies(docs, rows):
    assert ordered(ngram_join.near_duplicates(docs), "doc_id", "n_shingles", "component_id") == sorted(brute.near(rows), key=str)


def test_near_copies_with_odd_ids(spark, odd_ids):
    got = ordered(ngram_join.near_duplicates(frame(spark, odd_ids)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.near(odd_ids), key=str)


def test_near_copies_that_share_an_id(spark):
    """A repeated doc_id: an unrelated text stays, and one of two near copies goes."""
    base = [f"w{i}" for i in range(60)]
    copy, other = " ".join([*base, "end"]), " ".join(f"v{i}" for i in range(40))
    rows = [(1, " ".join(base)), (5, copy), (5, other), (8, " ".join(f"u{i}" for i in range(50))), (8, " ".join(f"u{i}" for i in range(51))),
            (9, "x y z"), (9, "x y z"), (9, ""), (9, ""), (None, copy), (None, None)]
    docs = frame(spark, rows)
    got = ngram_join.drop_near_copies(docs)
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    assert sum(d == 8 for d, _ in kept) == 1
    assert [r for r in kept if r[0] != 8] == sorted([(1, rows[0][1]), (5, other), (9, "x y z"), (9, ""), (9, ""), (None, copy), (None, None)], key=str)


def test_near_copies_of_random_edits(spark):
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(60)]
    bases = [[rng.choice(pool) for _ in range(rng.randint(20, 60))] for _ in range(6)]
    rows = []
    for i in range(150):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            p = rng.randrange(len(w))
            w[p:p + rng.randint(0, 2)] = [rng.choice(pool)] * rng.randint(0, 2)
        rows.append((i, " ".join(w)))
    got = ordered(ngram_join.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.near(rows), key=str)


def test_lists_of_the_same_classes_are_kept_once(spark):
    """The list of the first token stays: tokens ascend as unsigned numbers, and classes may have
    several rows. A list that differs in a class, or in a class of copies, stays as well."""
    lists = {3: "ab", 9: "ab", -5: "ab", -7: "cd", 4: "cde", -1: "cdf", 5: "ggh", 6: "iih", -2: "ggh", 7: "k", 8: "ll"}
    rows = [(c.encode(), 10, token, token % 8, 0) for token, members in lists.items() for c in members]
    posting = spark.createDataFrame(rows, "class binary, size int, token long, place int, alone int").repartition(3)
    shared = ngram_join.distinct_lists(posting)
    kept = {3, -7, 4, -1, 5, 6, 8}
    assert ordered(shared, "token", "class") == sorted(((t, c.encode()) for t in kept for c in lists[t]), key=str)
    assert {r["token"] for r in ngram_join.with_hubs(shared).collect()} == kept - {8}


def test_prefixes_of_unlike_texts_are_empty_at_any_size(spark, monkeypatch):
    """As in a large corpus, there are many more tokens than cells of the widest bit map: texts that share
    no token still leave no row to be compared."""
    from hrforge.llm import sketch
    monkeypatch.setattr(sketch, "MAX_BITS", 16)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(1500))) for i in range(200)]
    near = [(900 + k, " ".join(f"n{i}" for i in range(40)) + f" end{k}") for k in range(3)]
    got = ngram_join.postings(frame(spark, rows + near).select("doc_id", "text").repartition(3))
    assert got.filter("kind = 0").count() == 203
    assert got.filter("kind = 1").groupBy("size").count().collect() == [(37, 3 * 7)]  # prefixes of 8 of 37, one token alone


def test_prefixes_take_rare_tokens_first(spark):
    """Tokens that come once precede the others, which ascend by the number of texts that hold them; equal texts count once."""
    common, rare = " ".join(f"c{i}" for i in range(30)), " ".join(f"r{i}" for i in range(30))
    rows = [(i, f"{common} " + " ".join(f"o{i}x{k}" for k in range(30))) for i in range(5)]
    rows += [(10, f"{common} {rare}"), (11, f"{common} {rare} end"), (12, f"{common} {rare}"), (None, f"{common} {rare}")]
    got = ngram_join.postings(frame(spark, rows).select("doc_id", "text").repartition(3)).collect()
    size = {bytes(r["class"]): r["size"] for r in got if r["kind"] == 0}
    posts = [r for r in got if r["kind"] == 1]
    assert len({(r["class"], r["place"]) for r in posts}) == len(posts)
    assert sorted({r["size"] for r in posts}) == [56, 57]
    for r in posts:
        assert r["token"] >> 56 == 2 and r["alone"] <= r["place"] < ngram_join.prefix_size(size[bytes(r["class"])])
    assert sorted(r["alone"] for r in posts if r["place"] == r["alone"]) == [0, 1]


@pytest.mark.parametrize("chunk, members", [(1, 2), (400, 3)])
def test_near_copies_in_small_chunks_and_parts(spark, rows, monkeypatch, chunk, members):
    """Sets of a task that are sent in many chunks, and posting lists that are compared in parts."""
    from hrforge.llm import token_order
    monkeypatch.setattr(token_order, "BUFFER", chunk)
    monkeypatch.setattr(ngram_join, "MEMBERS", members)
    short = [r for r in rows if len(r[1] or "") < 20_000]
    short += short[60:64]  # equal rows
    got = ordered(ngram_join.near_duplicates(frame(spark, short).coalesce(1)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.near(short), key=str)


def shuffle_files(spark) -> set[str]:
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {str(f) for d in disk.localDirsString() for f in Path(d).rglob("shuffle_*.data")}


def test_near_copies_leave_no_shuffle_files(spark, docs):
    """What a step has shuffled goes when its table is written, and not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, conf = shuffle_files(spark), spark.conf.get(key)
    got = ngram_join.near_duplicates(docs)
    for _ in range(100):  # files are removed a moment later
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(key) == conf
    assert got.count() == got.count() == docs.count()


def test_long_chains_become_one_component(spark):
    links = spark.createDataFrame([(f"{i:04}", f"{i + 1:04}") for i in range(300)] + [("a", "c"), ("b", "c")], "a string, b string")
    roots = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert {k for k, r in roots.items() if r == "0000"} == {f"{i:04}" for i in range(1, 301)}
    assert roots["b"] == roots["c"] == "a"


# ------------------------------------------------------------------ 7 toxicity


def toxic_rows(n: int = 1200) -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(9)
    pool = [f"{a}{b}" for a in "bcdfglmnpr" for b in ("an", "en", "ol", "ur", "ish", "ate")]
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(pool) for _ in range(rng.randint(3, 12))) for _ in range(rng.randint(1, 20))]
        bad = rng.random() < 0.15
        if bad:
            k = rng.randrange(len(sentences))
            sentences[k] += " you " + rng.choice(["vilething", "nastyone", "rotter"])
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, 1, int(bad) if rng.random() > 0.02 else int(not bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    docs = frame(spark, rows + [(5000, None), (5001, "")])
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    truth = {d: bool(re.search("vilething|nastyone|rotter", t)) for d, t in rows}
    out = [d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all((got[d]["predicted"] == 1) == truth[d] for d in out)
    assert got[5000]["score"] == got[5001]["score"] < 0.3
    text = dict(rows)
    for d in out:
        if truth[d]:
            spans = [x.split(":") for x in got[d]["toxic_spans"].split(",")]
            assert all(re.search("vilething|nastyone|rotter", text[d][int(a):int(b)]) for a, b in spans)
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {d for d, r in got.items() if not r["predicted"]}


def test_toxicity_sample_is_bounded_and_weighted(spark):
    rows, labels = toxic_rows()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    picked, weight = toxicity.training_rows(frame(spark, rows), marks, 300)
    assert picked.count() <= 300 and weight[0] > 1


def test_copies_do_not_push_out_toxic_words(spark):
    """Half of the toxic rows are copies of one text of 400 words."""
    rows, labels = toxic_rows()
    text = " ".join(f"{a}{b}{c}" for a in "qwxz" for b in "abcdefghij" for c in "klmnopqrst")
    n = sum(toxic for _, _, toxic in labels)
    rows += [(10_000 + i, text) for i in range(n)]
    labels += [(10_000 + i, 1, 1) for i in range(n)]
    model = toxicity.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {"vilething", "nastyone", "rotter"} <= set(model.weights)


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, none)).collect()
    assert {r["score"] for r in got} == {0.0}


# ------------------------------------------------------------------ 8 quality forest


def test_base_rules(spark, docs, rows):
    cols = ["doc_id", *quality_forest.BASE, "base_failed"]
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_forest.judge(docs, marks)
    want = []
    for d, t in rows:
        b = brute.quality_base(t)
        want.append((d, *b, b[0] < 10 or 100 * b[4] > 20 * b[0]))
    assert ordered(got, *cols) == sorted(want, key=str)
    assert all(r["kept"] == (not r["base_failed"]) for r in got.collect())


def test_forest_drops_odd_documents(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(900):
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(30, 200))]
        odd = i % 20 == 0
        rows.append((i, " ".join(x + "$$$" for x in w) if odd else " ".join(w)))
        if i % 3:
            labels.append((i, int(not odd), 0))
    got = quality_forest.judge(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert all(r["kept"] == (r["doc_id"] % 20 != 0) for r in got if not r["base_failed"])


def test_forest_sample_keeps_proportions(spark):
    """A group of copies that holds a third of all rows gets a third of the sample."""
    zero = {c: 0 for c in quality_forest.BASE + quality_forest.MORE}
    rows = [(i, *({**zero, "n_words": 50, "n_lines": 1, "word_chars": 200, "n_symbols": 0 if i % 3 == 0 else 10 + i}).values())
            for i in range(3000)]
    stats = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{c} long" for c in zero))
    taken = []
    real = quality_forest.grow
    quality_forest.grow = lambda x, seed: taken.append(x) or real(x, seed)
    try:
        quality_forest.fit(stats, sample=600)
    finally:
        quality_forest.grow = real
    assert 500 <= len(taken[0]) <= 600
    assert 0.25 <= (taken[0][:, 0] == 0).mean() <= 0.42


def test_forest_isolates_kinds_the_sample_misses(spark):
    """Several kinds of odd rows beside many with symbols; one kind is 2 of 30,000 rows."""
    rng = random.Random(4)
    rows, kinds = [], {}
    for i in range(30_000):
        n = rng.randint(50, 400)
        chars = int(n * rng.uniform(4.2, 5.8))
        r = {"n_words": n, "word_chars": chars, "n_symbols": 0, "n_dup_lines": 0, "n_repeat_words": 0, "n_lines": rng.randint(1, 20),
             "n_upper": int(chars * rng.uniform(0.01, 0.05)), "n_digits": int(chars * rng.uniform(0, 0.03)), "n_adjacent": rng.choice([0, 0, 0, 1])}
        kind = "digits" if i in (11_111, 22_222) else "symbols" if i % 12 == 0 else "upper" if i % 100 == 1 else "short" if i % 500 == 2 else "within" if i % 400 == 3 else ""
        r |= {"digits": {"n_digits": int(chars * 0.9)}, "symbols": {"n_symbols": n}, "upper": {"n_upper": int(chars * 0.8)},
              "short": {"word_chars": int(n * 1.5), "n_digits": 0, "n_upper": 0}, "within": {"n_upper": int(chars * 0.25)}}.get(kind, {})
        kinds[i] = kind
        rows.append((i, *(r[c] for c in quality_forest.BASE + quality_forest.MORE)))
    stats = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{c} long" for c in quality_forest.BASE + quality_forest.MORE))
    marks = spark.createDataFrame([(i, int(not k), 0) for i, k in kinds.items() if i % 5 == 0 and k in ("", "symbols")],
                                  "doc_id long, quality int, toxic int")
    levels = defaultdict(list)
    for r in quality_forest.scored(stats, quality_forest.fit(stats, sample=2000, labels=marks)).collect():
        levels[kinds[r["doc_id"]]].append(r["level"])
    usual = sorted(levels.pop(""))
    assert len(levels) == 5
    mild = levels.pop("within")  # capitals not far beyond the usual ones
    assert sum(mild) / len(mild) > usual[len(usual) // 2]
    for kind, found in levels.items():
        assert min(found) > usual[-len(usual) // 20], (kind, min(found))


# ------------------------------------------------------------------ 9 exact dedup


def test_equal_texts(docs, rows):
    got = exact_dedup.exact_groups(docs)
    assert ordered(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(brute.exact(rows), key=str)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got.collect())


def test_equal_texts_with_odd_ids(spark, odd_ids):
    got = exact_dedup.exact_groups(frame(spark, odd_ids))
    assert ordered(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(brute.exact(odd_ids), key=str)
    kept = [r["text_sha256"] for r in got.filter("kept").collect()]
    assert len(kept) == len(set(kept)) == len({x[3] for x in brute.exact(odd_ids)})
    stay = exact_dedup.drop_copies(frame(spark, odd_ids))
    assert stay.columns == frame(spark, odd_ids).columns
    assert stay.count() == len(kept)


def test_chunks_make_up_the_text(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcd \n。日w") for _ in range(n)) for n in (0, 1, 1023, 1024, 5000, 40_000)] + ["x" * 30_000]
    df = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr(
        "text", f"regexp_extract_all(text, r'{exact_dedup.CHUNK}', 0) AS c")
    for r in df.collect():
        assert "".join(r["c"]) == r["text"]
        assert all(len(c) >= 1024 for c in r["c"][:-1])


def test_identifiers_that_clash_are_not_trusted(spark):
    recipe = spark.createDataFrame([(1, [(5, b"a"), (6, b"b")]), (2, [(5, b"c")])], "row long, chunks array<struct<id:long,sha:binary>>")
    assert [r["id"] for r in exact_dedup.unverified(recipe).collect()] == [5]


# ------------------------------------------------------------------ 10 secrets


def test_base_secrets(docs, rows):
    got = ordered(secrets.secret_spans(docs), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert got == sorted(((d, *brute.secret_base(t)) for d, t in rows), key=str)


def test_weak_parts_need_each_other(docs, rows):
    got = {r["doc_id"]: r["spans"] for r in secrets.secret_spans(docs).collect()}
    by_text = {t: got[d] for d, t in rows}

    def kinds(start: str) -> list[str]:
        return [x.split(":")[0] for t, s in by_text.items() if t and t.startswith(start) for x in s.split(",") if x]

    assert kinds("login: bob") == ["weak_id", "weak_secret", "endpoint"]
    assert kinds("pwd=xy12 alone") == kinds("user=bob alone") == kinds("client_id = app-7") == []
    assert kinds("client_id=app7") == ["weak_id", "weak_secret", "endpoint"]


def test_masking(spark, odd_ids):
    docs = frame(spark, odd_ids)
    got = secrets.mask_secrets(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    for r in got.collect():
        t = r["text"] or ""
        assert brute.secret_base(t)[:3] == (0, 0, 0) and r["n_chars"] == len(t)


# ------------------------------------------------------------------ all


def test_empty_tables(spark, empty):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for got in (packing.pack(empty, WORD_BPE), lm_score.score(empty), bpe.round_trip(empty, BYTE_BPE),
                surrogates.replace_pii(empty, KEY), substring_dedup.remove_repeats(empty), ngram_join.near_duplicates(empty),
                toxicity.score(empty, toxicity.train(empty, marks)), quality_forest.judge(empty, marks),
                exact_dedup.exact_groups(empty), exact_dedup.drop_copies(empty), secrets.secret_spans(empty),
                secrets.mask_secrets(empty)):
        assert got.count() == 0
