"""Toxicity by multiple-instance learning: noisy-or over sentences.

Labels are known for documents only. A sentence's probability is logistic in the
lexicon words it holds; a document's is 1 - (1 - leak) * prod(1 - p_sentence), trained
on document labels. So the model says which sentences make a document toxic. A
sentence without a lexicon word has no evidence and probability 0; ``leak`` is what
remains of documents without any evidence.

Training: at most ``SAMPLE`` labelled rows (a documented bound), drawn by a hash per
label with weights that restore the label rate. Words whose documents are toxic more often
than chance would allow become the lexicon (copies of a text count once): the binomial tail of
the word's toxic documents is exact, and its bound is divided by the number of words looked at, so
that about ``CHANCE`` words get in by chance, whatever the sample. Counting
is a Spark aggregation. The rows' sentences, reduced to lexicon word numbers, are
fitted in numpy. Scoring covers every row in one pass.

Words are runs of letters, lower-cased; sentences end at ``.``, ``!``, ``?`` or a line
end. A null text counts as empty and scores ``leak``. Repeated rows score alike. Without
training rows of both labels the lexicon is empty and every score is the label rate (0
if there is no label). Empty table: empty result. Only ``doc_id`` and ``text`` are read;
neither doc_id nor any label is an input of a score. A null doc_id is not labelled, and
whether it is held out is null.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrforge.llm.common import arrow_batches, share, table

SAMPLE = 24_000
#: A lexicon word's least number of documents, and how many words may get in by chance.
LEAST, CHANCE = 4, 0.5
#: Least z value of a lexicon word's toxic share: on large samples common words of a small
#: excess would pass the tail alone.
LEAST_Z = 5.0
THRESHOLD = 0.3
#: Values of the hash by which rows are drawn: many more than any table has rows.
MARKS = 1 << 52
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


class Model(NamedTuple):
    """Lexicon word -> weight, bias of a sentence with evidence, leak probability."""

    weights: dict[str, float]
    bias: float
    leak: float


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, dict[int, float]]:
    """(text, toxic) of at most ``sample`` labelled rows outside the held-out quarter, and
    the weight of a row of each label."""
    known = labels.filter("toxic is not null and doc_id is not null").select("doc_id", "toxic").dropDuplicates(["doc_id"])
    known = known.filter(~F.coalesce(held_out(F.col("doc_id")), F.lit(True)))
    count = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share_of = {1: sample // 3, 0: sample - sample // 3}
    rate = {k: min(1.0, 0.95 * share_of.get(k, 0) / n) for k, n in count.items()}
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    below = F.lit(0)
    for k, r in rate.items():
        below = F.when(F.col("toxic") == k, F.lit(int(r * MARKS))).otherwise(below)
    picked = known.filter(mark < below)
    # at most ``sample`` ids: small enough to broadcast, so that no text is shuffled
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic")
    return rows, {k: 1 / r for k, r in rate.items() if r}


def lexicon(rows: DataFrame) -> list[str]:
    """Words whose documents are toxic far more often than the sample's rate. Equal texts of
    one label count once, so copies do not push out the words of other documents."""
    arrow_batches(rows.sparkSession)
    rows = rows.withColumn("sha", F.sha2("text", 256)).dropDuplicates(["sha", "toxic"]).select("text", "toxic")

    def run(batches):
        for b in batches:
            count: dict[str, list[int]] = {}
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w in set(_WORD.findall(text.lower())):
                    count.setdefault(w, [0, 0])[toxic == 1] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(count), pa.string()), pa.array([c[0] for c in count.values()], pa.int64()),
                 pa.array([c[1] for c in count.values()], pa.int64())], ["word", "clean", "toxic"])

    total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not total.get(1) or not total.get(0):
        return []
    p = total[1] / (total[0] + total[1])
    n = F.col("toxic") + F.col("clean")
    z = (F.col("toxic") - n * p) / F.sqrt(n * p * (1 - p))
    words = (rows.mapInArrow(run, "word string, clean long, toxic long").groupBy("word")
             .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(n >= LEAST))
    words = table(words, "lexicon")  # as many as the sample has
    tested = words.count()
    found = words.filter(z >= LEAST_Z).collect()
    tails = {r["word"]: log_tail(r["clean"] + r["toxic"], r["toxic"], p) for r in found}
    return sorted((w for w, t in tails.items() if t <= math.log(CHANCE / tested)), key=lambda w: (tails[w], w))


def log_tail(n: int, k: int, p: float) -> float:
    """Logarithm of P(X >= k) for X of a binomial distribution of n and p."""
    term = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    total, ratio = 1.0, 1.0
    for i in range(k, n):
        ratio *= (n - i) / (i + 1) * p / (1 - p)
        total += ratio
        if ratio < 1e-15 * total:
            break
    return term + math.log(total)


def evidence(text: str, number: dict[str, int]) -> list[list[int]]:
    """Lexicon word numbers of each sentence that has any."""
    low = text.lower()
    if number.keys().isdisjoint(_WORD.findall(low)):
        return []
    found = []
    for sentence in _SENTENCE.findall(low):
        ids = sorted({number[w] for w in _WORD.findall(sentence) if w in number})
        if ids:
            found.append(ids)
    return found


def fit(rows: DataFrame, weight: dict[int, float], steps: int = 400) -> Model:
    """Noisy-or model by gradient ascent on the weighted document likelihood."""
    vocabulary = lexicon(rows)
    number = {w: i for i, w in enumerate(vocabulary)}
    shared = share(rows, vocabulary)

    def run(batches):
        index = {w: i for i, w in enumerate(shared.value)}
        for b in batches:
            got = [evidence(t, index) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(got, pa.list_(pa.list_(pa.int32())))], ["toxic", "bags"])

    kind = rows.schema["toxic"].dataType.simpleString()
    # rows without evidence are alike: only their number matters
    bags = rows.mapInArrow(run, f"toxic {kind}, bags array<array<int>>")
    seen = bags.groupBy("toxic", "bags").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pylist()
    seen.sort(key=lambda r: (r["toxic"], r["bags"]))
    w = np.array([weight.get(r["toxic"], 1.0) * r["n"] for r in seen])
    y = np.array([float(r["toxic"] == 1) for r in seen])
    if not len(y) or not w.sum():
        return Model({}, 0.0, 0.0)
    rate = float((w * y).sum() / w.sum())
    if not number:
        return Model({}, 0.0, rate)
    doc = np.array([i for i, r in enumerate(seen) for _ in r["bags"]], np.int64)
    sent = np.array([s for s, bag in enumerate(x for r in seen for x in r["bags"]) for _ in bag], np.int64)
    word = np.array([k for r in seen for bag in r["bags"] for k in bag], np.int64)
    w = w / w.sum()
    theta = np.zeros(len(number) + 2)
    theta[-1] = math.log(max(rate, 1e-3) / 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        score = np.bincount(sent, theta[word], len(doc)) + theta[-2]
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        leak = 1 / (1 + math.exp(-theta[-1]))
        clear = np.clip(np.exp(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y))) * (1 - leak), 1e-9, 1 - 1e-9)
        # d log L / d log(clear); clear = P(document not toxic)
        slope = w * np.where(y > 0, -clear / (1 - clear), 1.0)
        g_sent = -p * slope[doc]
        grad = np.append(np.bincount(word, g_sent[sent], len(number)), [g_sent.sum(), -leak * slope.sum()])
        grad[:-2] -= 1e-5 * theta[:-2]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta += 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return Model({x: float(theta[i]) for x, i in number.items()}, float(theta[-2]), 1 / (1 + math.exp(-float(theta[-1]))))


def sentence_scores(text: str, model: Model) -> list[tuple[int, int, float]]:
    """(start, end, probability) of each sentence with evidence."""
    low = text.lower()
    if model.weights.keys().isdisjoint(_WORD.findall(low)):
        return []
    if len(low) != len(text):  # lower-casing changed a length: take each sentence by itself
        parts = [(m.start(), m.end(), m.group().lower()) for m in _SENTENCE.finditer(text)]
    else:
        parts = [(m.start(), m.end(), m.group()) for m in _SENTENCE.finditer(low)]
    out = []
    for start, end, sentence in parts:
        known = {w for w in _WORD.findall(sentence) if w in model.weights}
        if known:
            s = model.bias + sum(model.weights[w] for w in sorted(known))
            out.append((start, end, 1 / (1 + math.exp(-max(-30.0, min(30.0, s))))))
    return out


def document_score(found: list[tuple[int, int, float]], leak: float) -> float:
    clear = 1 - leak
    for _, _, p in found:
        clear *= 1 - p
    return min(1.0, max(0.0, 1 - clear))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted, and the sentences with a probability of ``threshold`` or
    more as ``start:end`` ranges in code points."""
    arrow_batches(docs.sparkSession)
    shared = share(docs, model)

    def run(batches):
        got = shared.value
        for b in batches:
            scores, spans = [], []
            for text in b.column(1).to_pylist():
                found = sentence_scores(text or "", got)
                scores.append(document_score(found, got.leak))
                spans.append(",".join(f"{s}:{e}" for s, e, p in found if p >= threshold))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()),
                 pa.array(spans, pa.string())], ["doc_id", "score", "predicted", "toxic_spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int, toxic_spans string")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows, weight = training_rows(docs, labels, sample)
    return fit(rows, weight)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the model trained on ``labels`` calls toxic; all
    columns stay. The rows are filtered where they are read: nothing is shuffled."""
    model = train(docs, labels)
    shared = share(docs, model)
    at = docs.columns.index("text")

    def run(batches):
        got = shared.value
        for b in batches:
            ok = [document_score(sentence_scores(t or "", got), got.leak) < threshold for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
