"""N-gram Jaccard self-join by multiple-global-order filtering, and its components.

A document's set holds the hashes of its distinct ``SHINGLE``-word shingles (A-Z
lower-cased; fewer words: the whole sequence; no words: empty). Two documents link when
100 * intersection >= 80 * union. Equal word sequences form one class, named by a
128-bit digest; classes are compared, documents carry their class.

Under any global order of the tokens, two sets with that overlap share a token within
their first ``n - least overlap + 1`` tokens. Several orders are used:

* order 0 puts tokens first that one text alone holds, then the others by the number of texts
  that hold them (``token_order``; equal texts count once). So a prefix of a document without
  near copies holds no token that anybody shares, even if passages of it are found elsewhere,
  and what many documents have in common comes last. Prefix tokens that are shared are
  grouped by token: that makes the candidates. Of tokens that the same classes hold one is kept;
* every other order (a different hash of the tokens) must also give common prefix tokens,
  and enough of them: an overlap is at most the common tokens of the prefixes plus what
  lies beyond the prefix that ends first. Pairs that fail one order are dropped, and only
  the others' sets are moved and intersected. Pairs with a hub (below) skip these orders.

No pairs are emitted within a group of copies. In each posting list the class with the
fewest tokens of its own is the hub (it lies nearest to what the others share). First every
class is compared with its hubs; the links give components. Then, where a list still has
several components, classes outside the hub's component are compared with all others of
other components, unless marks (bit sets of what both have and lack against the hub, and of
all their tokens) rule out a link. So each pair of linked classes is either compared or already joined by
verified links, and components are exact.

Hashes of shingles and words have 64 bits. A null text counts as empty; empty documents
have an empty set and link with nothing. Equal rows share a class. Empty table: empty
result. Texts of any length are used whole. Columns other than ``doc_id`` and ``text``
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hrforge.llm.common import U64, arrow_batches, digest, free_name, grams, mix64, released, share, table, words
from hrforge.llm.components import components
from hrforge.llm.sketch import Bits, repeated, width
from hrforge.llm.token_order import BITS, prefixes

SHINGLE = 5
PERCENT = 80
#: Orders whose prefixes candidates must share; the first also makes the candidates.
ORDERS = 3
#: Rows of a posting list from which on it is compared in parts.
MEMBERS = 1024
_MIX = (0, 0xA4093822299F31D0, 0x082EFA98EC4E6C89, 0x3F84D5B5B5470917)


def shingles(h: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingles of a document's word hashes."""
    if not len(h):
        return np.empty(0, U64)
    if len(h) < n:
        return mix64(grams(h, len(h)) ^ U64(0xC0AC29B7C97C50DD))
    return np.unique(grams(h, n))


def prefix_size(n: int) -> int:
    """Prefix that serves any partner: the smallest one has PERCENT % of the tokens."""
    return n - -(-n * PERCENT // 100) + 1


def head(tokens: np.ndarray, order: int) -> np.ndarray:
    """Prefix in a hash order, as the leading 32 bits of the hashes, ascending."""
    ranks = (mix64(tokens ^ U64(_MIX[order])) >> U64(32)).astype(np.uint32)
    return np.sort(ranks)[:prefix_size(len(tokens))]


def heads_allow(p: np.ndarray, n: int, q: np.ndarray, m: int) -> bool:
    """Can sets of n and m tokens with these prefixes of one order still link?"""
    if p[-1] > q[-1]:
        p, n, q, m = q, m, p, n
    most = int(np.isin(p, q).sum()) + n - len(p)
    return 100 * most >= PERCENT * (n + m - most)


def classes(batch: pa.RecordBatch, column: int = 1):
    """(digest, word hashes) of every row of a batch."""
    for i in range(0, batch.num_rows, 64):
        w = words(batch.column(column).slice(i, 64), lower=True)
        for a, b in zip(w.rows, w.rows[1:]):
            yield digest(w.hashes[a:b]), w.hashes[a:b]


def equal_texts(docs: DataFrame) -> tuple[Bits, Bits]:
    """Bit maps of the texts that several rows have, and of one row (rows, if they are equal)
    of each text that hits the first map. A row that hits the first map only is spare: another
    one has its text. A text that hits the first map by chance is in the second one too."""
    texts = table(docs.groupBy(text_digest().alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")), "texts")

    def several(batch):
        yield text_keys(batch.column("digest"))

    many = repeated(texts.filter("n > 1"), several, width(texts, 0.25), least=1)
    shared = share(docs, many)

    def first(batch):
        keys = text_keys(batch.column("digest"))
        yield row_keys(keys, batch.column("doc_id"))[shared.value.hit(keys)]

    return many, repeated(texts, first, width(texts, 0.25), least=1)


def text_digest() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def text_keys(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), U64)[::2].copy()


def row_keys(keys: np.ndarray, ids) -> np.ndarray:
    """Hashes of rows: of the text and the doc_id, which may be null."""
    own = mix64(pc.fill_null(ids, 0).to_numpy().view(U64) + U64(0x9E3779B97F4A7C15))
    own[ids.is_null().to_numpy(zero_copy_only=False)] = U64(0x452821E638D01377)
    return mix64(keys ^ own)


def postings(docs: DataFrame) -> DataFrame:
    """One row per document (kind 0), and one per prefix token that may have a partner
    (kind 1; once for equal texts, as far as their doc_ids differ)."""
    many, first = (share(docs, x) for x in equal_texts(docs))

    def sets_of(batch):
        keys = text_keys(batch.column(2))
        spare = many.value.hit(keys) & ~first.value.hit(row_keys(keys, batch.column(0)))
        for (d, h), s in zip(classes(batch), spare):
            t = shingles(h)
            yield d, len(t), mark(t, 512), None if s else t

    return prefixes(docs.withColumn("digest", text_digest()), sets_of, prefix_size)


def fits(a: str, b: str, places: bool = True) -> Column:
    """Sizes that can link, and (``places``) prefix places that can be the first common ones."""
    low, high = F.least(f"{a}.size", f"{b}.size"), F.greatest(f"{a}.size", f"{b}.size")
    ok = high * PERCENT <= low * 100
    if places:
        need = F.ceil((F.col(f"{a}.size") + F.col(f"{b}.size")) * PERCENT / (100 + PERCENT))
        ok = ok & (F.col(f"{a}.place") <= F.col(f"{a}.size") - need) & (F.col(f"{b}.place") <= F.col(f"{b}.size") - need)
    return ok


def sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingle sets of the classes in ``wanted.class``, once each. A bit map of the wanted
    classes keeps the others' sets from being sent."""
    def keys(batch):
        yield np.array([int.from_bytes(c[:8], "little") for c in batch.column(0).to_pylist()], U64)

    near = share(docs, repeated(wanted, keys, width(docs, 0.02), least=1))

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            if len(seen) > 200_000:
                seen.clear()
            out = []
            for d, h in classes(batch):
                if d not in seen and near.value.hit(np.array([int.from_bytes(d[:8], "little")], U64))[0]:
                    seen.add(d)
                    out.append((d, shingles(h)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in out], pa.binary()), pa.array([t.tobytes() for _, t in out], pa.binary())], ["class", "tokens"])

    found = docs.mapInArrow(run, "class binary, tokens binary").join(wanted, "class", "left_semi")
    return table(found.dropDuplicates(["class"]), "shingle-sets")


def heads(members: DataFrame) -> DataFrame:
    """class, size and the prefixes in the further orders."""
    names = [f"head{k}" for k in range(1, ORDERS)]

    def run(batches):
        for batch in batches:
            sets_ = [np.frombuffer(t.as_buffer(), U64) for t in batch.column("tokens")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), pa.array([len(t) for t in sets_], pa.int32()),
                 *[pa.array([head(t, k).tobytes() for t in sets_], pa.binary()) for k in range(1, ORDERS)]],
                ["class", "size", *names])

    return members.mapInArrow(run, "class binary, size int, " + ", ".join(f"{n} binary" for n in names))


def filtered(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs (a, b) that every further order allows."""
    names = [f"head{k}" for k in range(1, ORDERS)]

    def run(batches):
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            n, m = batch.column("size_a").to_numpy(), batch.column("size_b").to_numpy()
            for name in names:
                a, b = batch.column(f"{name}_a"), batch.column(f"{name}_b")
                for i in np.flatnonzero(ok):
                    ok[i] = heads_allow(np.frombuffer(a[i].as_buffer(), np.uint32), n[i],
                                        np.frombuffer(b[i].as_buffer(), np.uint32), m[i])
            got = batch.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([got.column("a"), got.column("b")], ["a", "b"])

    known = table(heads(members), "prefixes")
    both = pairs
    for side in "ab":
        both = both.join(known.select(F.col("class").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("size", *names)]), side)
    return both.mapInArrow(run, "a binary, b binary")


_COMPARED = "a binary, b binary, link boolean, overlap int, " + ", ".join(
    f"{side}{i} long" for side in ("lacks", "adds") for i in range(4))


def compared(docs: DataFrame, pairs: DataFrame, filters: bool) -> DataFrame:
    """Pairs (a, b) with their verdict: do they link? Also the overlap, and 256-bit marks of
    the tokens that a lacks of b (``lacks``) and has beyond it (``adds``). With ``filters``
    pairs that a further order excludes are left out."""

    def run(batches):
        for batch in batches:
            a, b = batch.column("tokens_a"), batch.column("tokens_b")
            ok, overlap, marks = [], [], np.zeros((batch.num_rows, 8), np.int64)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), U64) for c in (a, b))
                inside = np.isin(x, y, assume_unique=True)
                both = int(inside.sum())
                ok.append(100 * both >= PERCENT * (len(x) + len(y) - both))
                overlap.append(both)
                marks[i, :4], marks[i, 4:] = mark(np.setdiff1d(y, x, assume_unique=True)), mark(x[~inside])
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(ok, pa.bool_()), pa.array(overlap, pa.int32()),
                 *[pa.array(np.ascontiguousarray(m)) for m in marks.T]],
                ["a", "b", "link", "overlap", *[f"{s}{i}" for s in ("lacks", "adds") for i in range(4)]])

    wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    members = sets(docs, wanted)
    if filters:
        pairs = table(filtered(pairs, members), "filtered-pairs")
    left = members.select(F.col("class").alias("a"), F.col("tokens").alias("tokens_a"))
    right = members.select(F.col("class").alias("b"), F.col("tokens").alias("tokens_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "tokens_a", "tokens_b")
    return both.mapInArrow(run, _COMPARED)


def mark(tokens: np.ndarray, size: int = 256) -> np.ndarray:
    """``size`` bits, one set by each token."""
    bits = np.zeros(size, bool)
    bits[(mix64(tokens) % U64(size)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view("<i8")


def may_link(x: str, y: str) -> Column:
    """False where marks rule out a link. What two members of a list have or lack against its
    hub: their overlap is at most the hub's tokens that neither lacks, plus the tokens beyond
    the hub that one has and the other may have. Also, tokens of a class whose bit of 512
    the other class has not set are not shared."""
    def ones(f, n: int = 4) -> Column:
        return sum((F.bit_count(f(i)) for i in range(n)), F.lit(0))

    def col(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def beyond(p: str, q: str) -> Column:
        return col(p, "size") - col(p, "overlap") - ones(
            lambda i: col(p, f"adds{i}").bitwiseAND(F.bitwise_not(col(q, f"adds{i}"))))

    most = col(x, "hub_size") - ones(lambda i: col(x, f"lacks{i}").bitwiseOR(col(y, f"lacks{i}"))) + F.least(
        beyond(x, y), beyond(y, x))
    def shared(p: str, q: str) -> Column:
        return col(p, "size") - ones(
            lambda i: col(p, BITS[i]).bitwiseAND(F.bitwise_not(col(q, BITS[i]))), len(BITS))

    need = (col(x, "size") + col(y, "size")) * PERCENT
    return (F.least(shared(x, y), shared(y, x)) * (100 + PERCENT) >= need) & F.coalesce(
        most * (100 + PERCENT) >= need, F.lit(True))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row."""
    return labelled(docs).select("doc_id", "n_shingles", "component_id")


def distinct_lists(posting: DataFrame) -> DataFrame:
    """Rows of the posting lists with two rows or more. Of lists of the same classes only the
    one of the first token is kept: it comes before the other tokens in the prefix of every
    class, so it allows each pair that another one allows. Lists are told apart by their
    number of rows and by sums of 96 bits of the classes' hashes (a class has as many rows in
    one list as in any other)."""
    h = F.xxhash64("class")
    parts = {"s0": h.bitwiseAND(F.lit(0xFFFFFFFF)), "s1": F.shiftrightunsigned(h, 32),
             "s2": F.shiftrightunsigned(F.xxhash64(F.lit(1), "class"), 32)}
    top = F.lit(-(1 << 63))  # tokens ascend as unsigned numbers
    lists = posting.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(c) for c, x in parts.items()]).filter("n > 1")
    first = lists.groupBy("n", *parts).agg(F.min(F.col("token").bitwiseXOR(top)).bitwiseXOR(top).alias("token"))
    return posting.join(first.select("token"), "token")


def with_hubs(shared: DataFrame) -> DataFrame:
    """Rows of the lists that hold two classes or more, with the hub of the list."""
    key = F.struct((F.col("alone") / F.col("size")).alias("share"), "size", "class", "place")
    lists = shared.groupBy("token").agg(F.min(key).alias("hub"), F.min("class").alias("low"), F.max("class").alias("high")).filter(
        "low != high").select("token", "hub")
    return shared.join(lists, "token").select(
        "token", "class", "size", "place", F.col("hub.class").alias("hub"), F.col("hub.size").alias("hub_size"),
        F.col("hub.place").alias("hub_place"))


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``postings`` of the documents, and ``components`` of their classes, both written."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = table(postings(source), "postings")
    posting = every.filter("kind = 1").select("class", "size", "token", "place", "alone")
    listed = table(with_hubs(table(distinct_lists(posting), "shared-postings")), "posting-lists")

    member = F.struct("size", "place")
    hub = F.struct(F.col("hub_size").alias("size"), F.col("hub_place").alias("place"))
    starred = listed.filter("class != hub").withColumn("x", member).withColumn("y", hub).filter(fits("x", "y", places=False))
    first = table(starred.select(F.col("class").alias("a"), F.col("hub").alias("b")).distinct(), "hub-pairs")
    tested = table(compared(source, first, False), "hub-links")
    links = tested.filter("link").select("a", "b")
    label = components(links)

    # lists that still hold several components: classes outside the hub's one meet the others
    named = listed.join(label.select(F.col("node").alias("class"), F.col("root").alias("of")), "class", "left").withColumn(
        "of", F.coalesce("of", "class")).join(
        label.select(F.col("node").alias("hub"), F.col("root").alias("of_hub")), "hub", "left").withColumn(
        "of_hub", F.coalesce("of_hub", "hub"))
    open_ = named.groupBy("token").agg(
        F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"), F.max(F.col("of") != F.col("of_hub")).alias("open")).filter("open")
    marks = every.filter("kind = 0").select("class", *BITS).dropDuplicates(["class"])
    named = table(named.join(open_.drop("open"), "token").distinct().join(marks, "class").join(
        tested.drop("link").withColumnsRenamed({"a": "class", "b": "hub"}), ["class", "hub"], "left"), "open-lists")
    meets = ((F.col("x.of") != F.col("y.of")) & ((F.col("y.of") == F.col("y.of_hub")) | (F.col("x.class") < F.col("y.class")))
             & (F.col("y.class") != F.col("y.hub")) & fits("x", "y") & may_link("x", "y"))
    part = F.pmod(F.xxhash64("class"), "parts").cast("int")  # of a long list each task has a part, and all that it meets
    left = named.filter("of != of_hub").withColumn("part", part).alias("x")
    right = named.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("y")
    here = (F.col("x.token") == F.col("y.token")) & (F.col("x.part") == F.col("y.part"))
    second = left.join(right, here & meets).select(
        F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()
    more = compared(source, table(second, "other-pairs"), True).filter("link").select("a", "b")
    return every, components(table(links.unionByName(more), "links"))


def labelled(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` with the class of every row and a name of its component (``of``)."""
    arrow_batches(docs.sparkSession)
    with released(docs.sparkSession):
        every, label = linked(docs)
    rows = every.filter("kind = 0").select("doc_id", "class", F.col("size").cast("long").alias("n_shingles"))
    of = rows.join(label.select(F.col("node").alias("class"), "root"), "class", "left").select(
        "doc_id", "n_shingles", "class", F.coalesce("root", "class").alias("of"))
    smallest = of.filter("n_shingles > 0").groupBy("of").agg(F.min("doc_id").alias("smallest"))
    return of.join(smallest, "of", "left").select(
        "doc_id", "n_shingles", "class", "of", F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id (of several, the
    one of the smallest class); rows without a doc_id or a shingle stay, as do all columns.
    A doc_id may repeat: rows are told apart by doc_id and class."""
    own, place = free_name(docs, "own_class"), free_name(docs, "place")
    text = docs.columns.index("text")

    def run(batches):
        for b in batches:
            yield b.append_column(own, pa.array([d for d, _ in classes(b, text)], pa.binary()))

    pairs = labelled(docs).filter("doc_id is not null and n_shingles > 0").groupBy("of", "component_id", "doc_id", "class").agg(
        F.count(F.lit(1)).alias("n"))
    first = pairs.filter("doc_id = component_id").groupBy("of").agg(F.min("class").alias("first"))
    # the pairs of which not all rows stay: none, or one
    pairs = table(pairs.join(first, "of").withColumn(
        "stays", (F.col("doc_id") == F.col("component_id")) & (F.col("class") == F.col("first"))).filter(
        "not stays or n > 1").select(F.col("doc_id").alias("of_id"), F.col("class").alias("of_class"), "stays"), "near-copies")
    rows = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(own, T.BinaryType())]))
    same = (F.col("d.doc_id") == F.col("p.of_id")) & (F.col(f"d.{own}") == F.col("p.of_class"))
    alone = rows.alias("d").join(pairs.alias("p"), same, "left_anti")
    several = rows.alias("d").join(pairs.filter("stays").alias("p"), same, "left_semi").withColumn(
        place, F.row_number().over(Window.partitionBy("doc_id", own).orderBy("text"))).filter(F.col(place) == 1)
    return alone.select(*docs.columns).unionByName(several.select(*docs.columns))
