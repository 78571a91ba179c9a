"""Secret scan with multipart credential linking (DataFrame functions only).

Strong findings stand alone: ``assign``, ``access`` and ``hex`` (the base kinds).
Weak candidates are a user or client name (``weak_id``), a short or bare secret
(``weak_secret``) and an address (``endpoint``). A weak candidate is reported only
when its complement lies within ``reach`` code points in the same text: a name
needs a secret, a secret needs a name, an address needs both. Base findings also
serve as complements. The link is an interval join: spans become rows keyed by
(row, bucket of ``reach`` code points), so that the work follows the number of
spans in a neighbourhood, not the square of those in a text.

Within a text, places are running sums over the matches and weak spans meet base spans by
running extremes, block by block, so a long log with a match in every line costs in
proportion to its length.

Spans are half-open code point ranges of whole matches. A null text counts as
empty; an empty text or table has no spans. Equal rows get equal results. Texts of
any length are scanned whole. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrforge.llm.common import free_name, table

# The base kinds and their patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
# Weak candidates of this operator.
WEAK_ID = r"""(?i)\b(client_?id|user_?name|user|login|account|access_?key(?:_?id)?)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
WEAK_SECRET = r"""(?i)\b(?:pwd|pass|password|passwd|secret|token|api_?key|private_?key|credential)(?-i)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{4,}|(?<![0-9A-Za-z])(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{16,31}(?![0-9A-Za-z])|(?<![0-9A-Za-z+/])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{20,64}(?![0-9A-Za-z+/])"""
ENDPOINT = r"""(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+|(?i)\b(?:host|endpoint|server)(?-i)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9.])"""

#: Kinds in the order in which equal starts are listed.
KINDS = ["assign", "access", "hex", "weak_id", "weak_secret", "endpoint"]
#: Code points between parts that belong together.
REACH = 200
#: Values of an array that running sums and extremes take at a time.
BLOCK = 64
#: Code points of a piece into which texts are cut to mask spans.
PIECE = 4096


def _grown(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running values of a short array: every step copies what it has."""
    return F.aggregate(values, F.array().cast("array<int>"), lambda acc, x: F.concat(
        acc, F.array(F.coalesce(op(F.try_element_at(acc, F.lit(-1)), x), x))))


def with_running(df: DataFrame, columns: dict[str, tuple[Column, Callable[[Column, Column], Column]]]) -> DataFrame:
    """``df`` and a column of running sums, maxima or minima of each array of integers, by BLOCK
    values at a time: within the blocks, over their last values, and both put together. So
    the work of a long array follows its length, not its square. The parts are columns of
    their own, so that none is computed anew for every element."""
    value, inner, carry = ({n: f"{part}_{n}" for n in columns} for part in ("value", "inner", "carry"))

    def within(values: Column, op) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda i: _grown(F.slice(values, i * BLOCK + 1, F.lit(BLOCK)), op))

    def over(blocks: Column, op) -> Column:
        return F.concat(F.array(F.lit(None).cast("int")), _grown(F.transform(blocks, lambda x: F.try_element_at(x, F.lit(-1))), op))

    def joined(blocks: str, before: str, op) -> Column:
        added = F.zip_with(blocks, before, lambda block, last: F.when(last.isNull(), block).otherwise(
            F.transform(block, lambda x: op(last, x))))
        return F.flatten(F.filter(added, lambda x: x.isNotNull()))

    df = df.select("*", *[values.alias(value[n]) for n, (values, _) in columns.items()])
    df = df.select("*", *[within(F.col(value[n]), op).alias(inner[n]) for n, (_, op) in columns.items()])
    df = df.select("*", *[over(F.col(inner[n]), op).alias(carry[n]) for n, (_, op) in columns.items()])
    df = df.select("*", *[joined(inner[n], carry[n], op).alias(n) for n, (_, op) in columns.items()])
    return df.drop(*value.values(), *inner.values(), *carry.values())


def _plus(a: Column, b: Column) -> Column:
    return a + b


def steps(text: Column, pattern: str, group: int = 0, guard: str | None = None) -> Column:
    """The leftmost non-overlapping matches in turn: code points since the last one, of the
    match and of its ``group``. Texts without a ``guard`` match are scanned once."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    marks = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    gaps = F.split(text, pattern, -1)
    found = F.arrays_zip(
        F.transform(F.slice(gaps, F.lit(1), F.size(hits)), F.char_length).alias("gap"),
        F.transform(hits, F.char_length).alias("size"), F.transform(marks, F.char_length).alias("mark"))
    return F.when(text.rlike(guard or pattern), found).otherwise(F.array().cast("array<struct<gap:int,size:int,mark:int>>"))


#: Pattern, least length and group of each kind, and what a text must hold for a match.
SCANS = {"assign": (ASSIGN, 8, 2, None), "access": (ACCESS, 16, 0, r"AKIA[A-Z0-9]{12}"), "hex": (HEX, 32, 0, None),
         "weak_id": (WEAK_ID, 5, 0, None), "weak_secret": (WEAK_SECRET, 8, 0, None), "endpoint": (ENDPOINT, 7, 0, None)}
BASE, WEAK = KINDS[:3], KINDS[3:]


def scanned(docs: DataFrame) -> DataFrame:
    """All spans of each row by kind, weak candidates included, before linking. Weak spans
    that overlap a base span go: of the spans in order, the base ones before a weak one must
    not reach into it, and the next base one must not start within it."""
    text = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
                       F.coalesce("text", F.lit("")).alias("body"))
    raw = text.select("doc_id", "text_hash", F.char_length("body").alias("n_chars"), F.monotonically_increasing_id().alias("row"),
                      *[steps(F.col("body"), pattern, group, guard).alias(f"steps_{k}") for k, (pattern, _, group, guard) in SCANS.items()])
    raw = with_running(raw, {f"ends_{k}": (F.transform(f"steps_{k}", lambda x: x["gap"] + x["size"]), _plus) for k in KINDS})

    def long_enough(kind: str, least: int) -> Column:
        zipped = F.arrays_zip(F.col(f"steps_{kind}").alias("x"), F.col(f"ends_{kind}").alias("until"))
        return F.transform(F.filter(zipped, lambda s: s["x"]["mark"] >= least),
                           lambda s: F.struct((s["until"] - s["x"]["size"]).alias("start"), s["until"].alias("until")))

    found = raw.select("doc_id", "text_hash", "n_chars", "row", *[long_enough(k, scan[1]).alias(k) for k, scan in SCANS.items()])
    both = (sum(F.size(k) for k in BASE) > 0) & (sum(F.size(k) for k in WEAK) > 0)
    listed = F.when(both, _listed(*KINDS)).otherwise(F.array().cast("array<struct<start:int,rank:int,until:int>>"))
    found = found.withColumn("listed", listed).withColumn("crossed", both)
    strong = lambda s: s["rank"] < len(BASE)
    found = with_running(found, {
        "reached": (F.transform("listed", lambda s: F.when(strong(s), s["until"]).otherwise(F.lit(-1))), F.greatest),
        "next": (F.reverse(F.transform("listed", lambda s: F.when(strong(s), s["start"]).otherwise(F.lit(2**31 - 1)))), F.least)})
    apart = F.filter(F.arrays_zip(F.col("listed").alias("s"), F.col("reached").alias("reached"), F.reverse("next").alias("next")),
                     lambda x: (x["reached"] <= x["s"]["start"]) & (x["next"] >= x["s"]["until"]) & ~strong(x["s"]))
    found = found.withColumn("apart", apart)

    def left(kind: str) -> Column:
        mine = F.filter("apart", lambda x: x["s"]["rank"] == KINDS.index(kind))
        return F.when(~F.col("crossed"), F.col(kind)).otherwise(F.transform(
            mine, lambda x: F.struct(x["s"]["start"].alias("start"), x["s"]["until"].alias("until"))))

    return found.select("doc_id", "text_hash", "n_chars", "row", *BASE, *[left(k).alias(k) for k in WEAK])


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak spans with their complement near by: row, kind, start, until."""
    some = parts.filter((F.size("access") + F.size("weak_id") > 0)
                        & (F.size("assign") + F.size("hex") + F.size("weak_secret") > 0))
    roles = {"access": "id", "weak_id": "id", "assign": "secret", "hex": "secret", "weak_secret": "secret",
             "endpoint": "endpoint"}
    every = None
    for kind, role in roles.items():
        one = some.select("row", F.lit(kind).alias("kind"), F.lit(role).alias("role"), F.explode(kind).alias("s")).select(
            "row", "kind", "role", "s.start", "s.until")
        every = one if every is None else every.unionByName(one)

    def bucketed(df: DataFrame, margin: int, prefix: str) -> DataFrame:
        low, high = F.floor((F.col("start") - margin) / reach), F.floor((F.col("until") + margin) / reach)
        named = df.select("row", F.explode(F.sequence(low, high)).alias("bucket"),
                          *[F.col(c).alias(prefix + c) for c in ("kind", "role", "start", "until")])
        return named

    weak = every.filter(F.col("kind").isin("weak_id", "weak_secret", "endpoint"))
    left = bucketed(weak, reach, "w_")
    right = bucketed(every.filter("role != 'endpoint'"), 0, "p_").select("row", "bucket", "p_role", "p_start", "p_until")
    near = left.join(right, ["row", "bucket"]).filter(
        (F.col("p_role") != F.col("w_role")) & (F.col("p_start") - F.col("w_until") <= reach)
        & (F.col("w_start") - F.col("p_until") <= reach))
    met = near.groupBy("row", "w_kind", "w_start", "w_until").agg(
        F.max(F.col("p_role") == "id").alias("has_id"), F.max(F.col("p_role") == "secret").alias("has_secret"))
    complete = (((F.col("w_kind") == "weak_id") & F.col("has_secret"))
                | ((F.col("w_kind") == "weak_secret") & F.col("has_id"))
                | ((F.col("w_kind") == "endpoint") & F.col("has_id") & F.col("has_secret")))
    return met.filter(complete).select("row", F.col("w_kind").alias("kind"), F.col("w_start").alias("start"),
                                       F.col("w_until").alias("until"))


def _listed(*kinds: str) -> Column:
    """Spans of the given array columns as (start, rank of the kind, until), in order."""
    def ranked(kind: str) -> Column:
        rank = F.lit(KINDS.index(kind))
        return F.transform(F.col(kind), lambda s: F.struct(
            s["start"].alias("start"), rank.alias("rank"), s["until"].alias("until")))

    return F.array_sort(F.concat(*map(ranked, kinds)))


def _written(listed: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(listed, lambda s: F.concat_ws(
        ":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["until"].cast("string"))), ",")


def secret_spans(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Per row: base counts, base_sha256, spans (text form), found (array), text_hash."""
    parts = table(scanned(docs), "secret-parts")
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    extra = linked(parts, reach).groupBy("row").agg(F.collect_list(F.struct(
        "start", rank[F.col("kind")].alias("rank"), "until")).alias("extra"))
    nothing = F.array().cast("array<struct<start:int,rank:int,until:int>>")
    base = parts.withColumn("base", _listed("assign", "access", "hex"))
    both = base.join(extra, "row", "left").withColumn(
        "found", F.array_sort(F.concat("base", F.coalesce("extra", nothing))))
    return both.select(
        "doc_id", F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"), F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.col("found")).alias("spans"), "found", "text_hash", "n_chars")


def mask_secrets(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mask`` (overlapping spans by one);
    n_chars, where there is such a column, follows. No row is dropped."""
    hits = secret_spans(docs).filter("size(found) > 0").select(
        F.concat_ws(":", "text_hash", "n_chars", F.col("doc_id").cast("string")).alias("key"), "found").dropDuplicates(["key"])
    hits = with_running(hits, {"reached": (F.transform("found", lambda s: s["until"]), F.greatest)})
    # spans that start behind all before them, and how far those reach: what lies between stays
    before = F.concat(F.array(F.lit(0)), F.slice("reached", F.lit(1), F.size("reached") - 1))
    gaps = F.transform(F.filter(F.arrays_zip(F.col("found").alias("s"), before.alias("from")), lambda x: x["s"]["start"] >= x["from"]),
                       lambda x: F.struct(x["from"].alias("from"), x["s"]["start"].alias("to")))
    key, own = (free_name(docs, n) for n in ("same", "masked"))
    hits = hits.select(F.col("key").alias(key), F.struct(gaps.alias("gaps"), F.array_max("reached").alias("last")).alias(own))
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumn(key, F.concat_ws(":", F.xxhash64(text), F.char_length(text), F.col("doc_id").cast("string")))
    out = rows.join(hits, key, "left")
    # a text is cut once, so that taking a part of it does not walk it from its begin
    cuts = free_name(out, "cuts")
    out = out.withColumn(cuts, F.when(F.col(own).isNotNull(), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))))

    def part(start: Column, to: Column) -> Column:
        first = F.floor(start / PIECE).cast("int")
        near = F.slice(cuts, first + 1, F.floor(to / PIECE).cast("int") - first + 1)
        return F.array_join(near, "").substr(start - first * PIECE + 1, to - start)

    whole = F.col(own).isNull()
    kept = F.transform(F.col(f"{own}.gaps"), lambda g: F.concat(part(g["from"], g["to"]), F.lit(mask)))
    rest = part(F.col(f"{own}.last"), F.char_length("text"))
    out = out.withColumn("text", F.when(whole, F.col("text")).otherwise(F.concat(F.array_join(kept, ""), rest)))
    if "n_chars" in docs.columns:
        count = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(count))
    return out.select(*docs.columns)
