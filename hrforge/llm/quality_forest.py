"""Quality rules with an isolation forest on the rule statistics.

Fixed base rules fail a document that has under 10 words, or in which more than 20 %
of the words stand in 5-word windows found twice or more. For the others an isolation
forest decides: random cuts over the whole range of a rule statistic isolate odd rows
early, so a short mean path is an anomaly. It sees the statistics themselves, scaled on either side of the median
by far quantiles over all rows that passed the base rules; none is cut at a bound. A side
is cut the more often, the more labelled bad rows lie beyond nearly all good ones on it, but
always with a share of ``FLOOR``, so that kinds without labels are isolated too. It is fitted on at most ``SAMPLE`` such rows, chosen by a hash of
doc_id and statistics, so in proportion to their number; on larger tables 1 / ``FAR`` of
them are rows with far values and the rows with the least and greatest value of every
statistic over all rows, and every tree has the latter. So a kind that the sample misses can
still be cut off. Every row is scored. The cut
is calibrated on all labelled rows (``labels.quality``): among score levels it takes
the one that separates quality 0 from 1 best, while at most ``LOSS`` of the
quality-1 rows are lost. Without labelled rows of both kinds, the cut is 1: no anomaly.

A null text has no words; it and the empty text fail the base rules. Repeated rows get
equal verdicts. Long texts are counted whole; memory follows the longest text. Empty
table: empty result. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hrforge.llm.common import arrow_batches, grams, share, table, words

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_digits", "n_adjacent"]
WINDOW = 5
#: Rows the forest is drawn from, trees, rows of a tree.
SAMPLE, TREES, TREE_ROWS = 20_000, 128, 256
#: Values of the hash by which rows are drawn: many more than any table has rows.
MARKS = 1 << 60
LOSS = 0.01
LEVELS = 1000
#: Share (as a divisor) of the sample that is kept for far values, and what is far.
FAR, TAIL = 50, 0.001
#: Least weight of a side of a statistic (the greatest is 1 more), and which share of the good rows a
#: side's bad ones must exceed.
FLOOR, MOST = 0.1, 0.99
#: The rule statistics: symbols per word, duplicate lines, repeated and adjacent equal words,
#: capitals, digits, and the mean word length.
RATES = [("n_symbols", "n_words"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_adjacent", "n_words"),
         ("n_upper", "word_chars"), ("n_digits", "word_chars"), ("word_chars", "n_words")]

_SYMBOL, _UPPER, _DIGIT, _CONT, _BLANK = (np.zeros(256, bool) for _ in range(5))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[0x41:0x5B] = True
_DIGIT[0x30:0x3A] = True
_CONT[0x80:0xC0] = True
_BLANK[[0x20, *range(9, 14)]] = True


def repeat_words(h: np.ndarray) -> int:
    """Words that stand in a window found twice or more in the row."""
    g = grams(h, WINDOW)
    if len(g) < 2:
        return 0
    order = np.argsort(g, kind="stable")
    s = g[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(g), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(h) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def dup_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and all lines with a word."""
    seen: set[bytes] = set()
    dup = n = 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\r\x0b\x0c"):
            n += 1
            dup += line in seen
            seen.add(line)
    return dup, n


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every document."""
    arrow_batches(docs.sparkSession)
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE + MORE)

    def run(batches):
        for batch in batches:
            rows: list[list[int]] = []
            for i in range(0, batch.num_rows, 64):
                part = batch.column(1).slice(i, 64)
                w = words(part)
                for k, text in enumerate(part.to_pylist()):
                    data = (text or "").encode()
                    raw = np.frombuffer(data, np.uint8)
                    h = w.hashes[w.rows[k]:w.rows[k + 1]]
                    blank = int(_BLANK[raw].sum())
                    dup, lines = dup_lines(data)
                    rows.append([len(h), len(raw) - blank - int(_CONT[raw].sum()), int(_SYMBOL[raw].sum()), dup,
                                 repeat_words(h), lines, int(_UPPER[raw].sum()), int(_DIGIT[raw].sum()),
                                 int((h[1:] == h[:-1]).sum())])
            cols = np.array(rows, np.int64).reshape(-1, len(BASE) + len(MORE)).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in cols]], ["doc_id", *BASE, *MORE])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rate_columns() -> list[Column]:
    return [F.col(a) / F.greatest(F.col(b), F.lit(1)) for a, b in RATES]


class Scale(NamedTuple):
    """Of each statistic: median, distances of the far values below and above, weights."""

    middle: np.ndarray
    below: np.ndarray
    above: np.ndarray
    weight_below: np.ndarray
    weight_above: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        def side(far: np.ndarray) -> np.ndarray:  # linear up to the far value, then logarithmic
            return np.minimum(far, 1) + np.log(np.maximum(far, 1))

        return (self.weight_above * side(np.maximum(x - self.middle, 0) / self.above)
                - self.weight_below * side(np.maximum(self.middle - x, 0) / self.below))


def features(rows: pa.Table | pa.RecordBatch, scale: Scale) -> np.ndarray:
    """The rule statistics, scaled so that 0 stays 0."""
    c = {k: rows.column(k).to_numpy(zero_copy_only=False).astype(float) for k in BASE + MORE}
    return scale.of(np.stack([c[a] / np.maximum(c[b], 1) for a, b in RATES], axis=1)) - scale.of(np.zeros(len(RATES)))


class Survey(NamedTuple):
    """Of all rows that passed the base rules: number, scale (weights 1), the bounds of each
    statistic's far values, and the rows with its least and greatest value."""

    n: int
    scale: Scale
    low: list[float]
    high: list[float]
    ends: pa.Table


def survey(ok: DataFrame) -> Survey | None:
    row = F.struct(*BASE, *MORE)
    got = ok.agg(F.count(F.lit(1)).alias("n"), *[x for i, r in enumerate(rate_columns()) for x in (
        F.percentile_approx(r, [TAIL, 0.5, 1 - TAIL], 10_000).alias(f"q{i}"),
        F.min(F.struct(r.alias("rate"), row.alias("row"))).alias(f"min{i}"),
        F.max(F.struct(r.alias("rate"), row.alias("row"))).alias(f"max{i}"))]).first()
    if not got["n"]:
        return None
    every = range(len(RATES))
    low, middle, high = (np.array([got[f"q{i}"][k] for i in every]) for k in range(3))
    least, most = (np.array([got[f"{end}{i}"]["rate"] for i in every]) for end in ("min", "max"))

    def distance(far: np.ndarray, farthest: np.ndarray) -> np.ndarray:
        return np.where(far > 0, far, np.where(farthest > 0, farthest, 1.0))

    ends = [got[f"{end}{i}"]["row"].asDict() for i in every for end in ("min", "max")]
    one = np.ones(len(RATES))
    return Survey(got["n"], Scale(middle, distance(middle - low, middle - least), distance(high - middle, most - middle), one, one),
                  low.tolist(), high.tolist(), pa.Table.from_pylist(ends, pa.schema([(c, pa.int64()) for c in BASE + MORE])))


def weighted(scale: Scale, ok: DataFrame, labels: DataFrame) -> Scale:
    """Weights by the share of all labelled bad rows beyond ``MOST`` of the good ones."""
    known = ok.join(labels.filter("quality is not null").select("doc_id", (F.col("quality") == 1).alias("good")), "doc_id")
    good = known.filter("good").agg(*[F.percentile_approx(r, [1 - MOST, MOST], 10_000).alias(f"q{i}") for i, r in enumerate(rate_columns())]).first()
    if good["q0"] is None:
        return scale
    sides = [x for i, r in enumerate(rate_columns()) for x in (r < good[f"q{i}"][0], r > good[f"q{i}"][1])]
    got = known.filter("not good").agg(*[F.avg(x.cast("int")) for x in sides]).first()
    if got[0] is None:
        return scale
    share_of = FLOOR + np.array(list(got)).reshape(-1, 2)
    return scale._replace(weight_below=share_of[:, 0], weight_above=share_of[:, 1])


def _mean_path(n: float) -> float:
    """Mean path of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n <= 1 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def grow(x: np.ndarray, seed: int, trees: int = TREES, rows: int = TREE_ROWS) -> dict[str, np.ndarray]:
    """Isolation trees as flat arrays: feature (-1: leaf), cut, left child, path value. Every
    tree has the rows with the least and greatest value of each feature."""
    rng = np.random.default_rng(seed)
    out: dict[str, list] = {"feature": [], "cut": [], "left": [], "value": [], "root": []}
    limit = math.ceil(math.log2(max(2, min(rows, len(x)))))

    def node(feature=-1, cut=0.0, value=0.0) -> int:
        for k, v in (("feature", feature), ("cut", cut), ("left", 0), ("value", value)):
            out[k].append(v)
        return len(out["feature"]) - 1

    ends = np.concatenate([x.argmin(0), x.argmax(0)])
    whole, wide = x.min(0), x.max(0) - x.min(0)
    for _ in range(trees):
        take = x[np.union1d(rng.choice(len(x), min(rows, len(x)), replace=False), ends)]
        out["root"].append(node())
        todo = [(out["root"][-1], take, 0)]
        while todo:
            at, part, depth = todo.pop()
            low, high = part.min(0), part.max(0)
            open_ = np.flatnonzero(high > low)
            if depth >= limit or len(part) < 2 or not len(open_):
                out["value"][at] = depth + _mean_path(len(part))
                continue
            # over the whole range: a cut beside all rows of a narrow part leaves them together
            f = int(rng.choice(len(wide), p=wide / wide.sum()))
            cut = float(rng.uniform(whole[f], whole[f] + wide[f]))
            if not low[f] <= cut < high[f]:
                todo.append((at, part, depth + 1))
                continue
            out["feature"][at], out["cut"][at], out["left"][at] = f, cut, node()
            node()
            goes = part[:, f] <= cut
            todo += [(out["left"][at], part[goes], depth + 1), (out["left"][at] + 1, part[~goes], depth + 1)]
    got = {k: np.array(v) for k, v in out.items()}
    got["norm"] = np.array([_mean_path(min(rows, len(x))) or 1.0])
    return got


def anomaly(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """2 ** -(mean path / expected path): near 1 is odd, 0.5 and less is usual."""
    total = np.zeros(len(x))
    every = np.arange(len(x))
    for root in forest["root"]:
        at = np.full(len(x), root)
        while (inner := forest["feature"][at] >= 0).any():
            f = np.where(inner, forest["feature"][at], 0)
            step = forest["left"][at] + (x[every, f] > forest["cut"][at])
            at = np.where(inner, step, at)
        total += forest["value"][at]
    return 2.0 ** (-total / len(forest["root"]) / forest["norm"][0])


def fit(stats: DataFrame, sample: int = SAMPLE, seed: int = 7, labels: DataFrame | None = None) -> dict | None:
    """Forest on at most ``sample`` rows that passed the base rules, with weights by ``labels``."""
    mark = F.pmod(F.xxhash64("doc_id", *BASE, *MORE), F.lit(MARKS))
    ok = stats.filter(~base_failed())
    known = survey(ok)
    if known is None:
        return None

    def drawn(rows: DataFrame, most: int, n: int) -> pa.Table:
        part = rows if n <= most else rows.filter(mark < -(-MARKS * most // n))
        return part.orderBy(mark, "doc_id", *BASE, *MORE).limit(most).select(*BASE, *MORE).toArrow()

    if known.n <= sample:
        got = drawn(ok, sample, known.n)
    else:
        far = F.lit(False)
        for r, low, high in zip(rate_columns(), known.low, known.high):
            far = far | (r < low) | (r > high)
        room = max(0, sample // FAR - known.ends.num_rows)
        tails = ok.filter(far)
        got = [drawn(ok, sample - room - known.ends.num_rows, known.n), drawn(tails, room, tails.count()), known.ends]
        got = pa.concat_tables([t.cast(known.ends.schema) for t in got])
    scale = known.scale if labels is None else weighted(known.scale, ok, labels)
    return {**grow(features(got, scale), seed), "scale": scale}


def scored(stats: DataFrame, forest: dict | None) -> DataFrame:
    """Statistics, base_failed and the anomaly score in thousandths (0 without forest)."""
    model = share(stats, forest)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = anomaly(model.value, features(b, model.value["scale"])) if model.value is not None else np.zeros(b.num_rows)
            yield b.append_column("level", pa.array(np.round(s * LEVELS).astype(np.int32)))

    kept = stats.select("doc_id", *BASE, *MORE)
    schema = T.StructType([*kept.schema.fields, T.StructField("level", T.IntegerType())])
    return kept.mapInArrow(run, schema).withColumn("base_failed", base_failed())


def calibrate(rows: DataFrame, labels: DataFrame, loss: float = LOSS) -> int:
    """Score level from which a document is an anomaly, from all labelled rows."""
    known = labels.filter("quality is not null").select("doc_id", (F.col("quality") == 1).alias("good"))
    count = {(r["level"], r["good"]): r["n"] for r in rows.filter(~F.col("base_failed")).join(known, "doc_id")
             .groupBy("level", "good").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = (sum(n for (_, g), n in count.items() if g is side) for side in (True, False))
    if not good or not bad:
        return LEVELS + 1
    best, top, cut, g, b = 0.0, LEVELS + 1, LEVELS + 1, 0, 0
    for level in range(LEVELS, -1, -1):
        g, b = g + count.get((level, True), 0), b + count.get((level, False), 0)
        apart = b / bad - g / good
        if g <= loss * good and apart > best:
            best, top, cut = apart, level, level
        elif apart == best and level == cut - 1:
            cut = level
    return (top + cut + 1) // 2  # the middle of a gap between the two


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, loss: float = LOSS) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the anomaly score."""
    stats = table(statistics(docs), "statistics")
    rows = scored(stats, fit(stats, sample, labels=labels))
    cut = calibrate(rows, labels, loss)
    return rows.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.col("level") < cut)).alias("kept"),
                       (F.col("level") / LEVELS).alias("anomaly"))
