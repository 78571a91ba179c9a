"""Merkle manifest of a table with proofs found by pointer jumping.

H is the lower-case hex SHA-256 of its inputs one after the other, digests as hex text.
A leaf is H of a row's doc_id, source, lang, n_chars and text, each as ``-`` if null, else
byte count, ``:`` and value. The leaves of a source stand by doc_id; runs of ``ARITY``
become their H, level by level, until one node is left: the subroot. The subroots, by
source (null first, then by UTF-8 bytes), make the root in the same way.

1. Leaves are hashed where they are read; from there on only digests move.
2. Places: rows are range-partitioned by (source, doc_id) and numbered by the offsets of
   their partitions, so a source of any size is numbered by many tasks.
3. Nodes: ``LEVELS`` levels for each grouping of at most ARITY ** LEVELS digests.
4. Proofs: a node holds a pointer to an ancestor (at first its parent) and the segment of
   siblings on the way there. A self-join with the ancestors' rows appends their
   segments and takes over their pointers, which doubles the distance; after
   ceil(log2(depth + 1)) joins every leaf has reached the root. For the next join only nodes
   whose level is a multiple of the distance (and those above the subroots) are asked, so
   only they are kept beside the leaves.
5. A leaf (or another digest in its place) is folded with its segment and compared with
   the root.

Odd cases: null fields are ``-``; an empty text is ``0:``. A null doc_id stands first in
its source and is never tampered with. Rows with equal source and doc_id stand by their
leaf digest; rows equal in all five columns are leaves of their own, next to each other.
A lone leaf is its source's subroot, a lone subroot the root; without siblings the proof is
H of nothing. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from hrforge.llm.common import table

ARITY = 3
#: Levels that one grouping builds.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the subroots; trees of sources have the source's field as name, never "".
TOP = ""
_POSITION_BITS = 33  # of monotonically_increasing_id


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def as_hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def without_newlines(docs: DataFrame) -> Column:
    """Text as stored by a faulty copy: rows of an even crc32(doc_id) lose their newlines."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))


def leaves(docs: DataFrame, stored_text: Column | None = None) -> DataFrame:
    """tree, doc_id, leaf, and the leaf that the stored text gives (null: the same one)."""
    kept = docs.select(*FIELDS, *([stored_text.alias("stored")] if stored_text is not None else []))
    head = [field(F.col(c)) for c in FIELDS[:-1]]
    stored = F.lit(None).cast("string")
    if stored_text is not None:
        stored = F.when(~F.col("stored").eqNullSafe(F.col("text")), digest(*head, field(F.col("stored"))))
    return kept.select(field(F.col("source")).alias("tree"), "doc_id", digest(*head, field(F.col("text"))).alias("leaf"),
                       stored.alias("stored_leaf"), F.monotonically_increasing_id().alias("row"))


def numbered(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """Adds ``idx`` (from 0, by ``order`` within ``group``) and ``n`` (rows of the group)."""
    laid = table(rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
                 .withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", _POSITION_BITS).alias("part")
    pieces = laid.groupBy(group, part).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    here = Window.partitionBy(group)  # one row for each partition that the group reaches
    before = F.sum("rows").over(here.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select(F.col(group).alias("of"), F.col("part").alias("in_part"),
                           (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(here).alias("n"))
    return (laid.withColumn("part", part).join(pieces, (F.col(group) == F.col("of")) & (F.col("part") == F.col("in_part")))
            .withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "of", "in_part", "shift"))


def depth(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    powers = F.array(*[F.lit(ARITY ** k).cast("long") for k in range(40) if ARITY ** k < 1 << 63])
    return F.size(F.filter(powers, lambda p: p < n))


def _level_above(digests: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(digests, i * ARITY + 1, F.lit(ARITY)), ""), 256))


def _with_siblings(digests: Column, level: int) -> Column:
    """Nodes of one level of a group: place, digest, siblings of the run to the left and right."""
    def node(h: Column, p: Column) -> Column:
        nth = p % ARITY
        return F.struct(F.lit(level).alias("step"), p.alias("place"), F.unhex(h).alias("hash"),
                        F.unhex(F.array_join(F.slice(digests, p - nth + 1, nth), "")).alias("l"),
                        F.unhex(F.array_join(F.slice(digests, p + 2, F.lit(ARITY - 1) - nth), "")).alias("r"))
    return F.transform(digests, node)


def nodes(placed: DataFrame, name: str) -> DataFrame:
    """All nodes of the trees whose leaves are ``placed`` (tree, idx, n, hash as hex): tree,
    depth, level, idx, hash, l, r. The node of level ``depth`` is the tree's last one."""
    rows = placed.select("tree", depth(F.col("n")).alias("depth"), "idx", "hash")
    deepest = rows.agg(F.max("depth")).first()[0]
    size, out = ARITY ** LEVELS, None
    base = 0
    while out is None or base <= deepest:
        block = F.floor(F.col("idx") / size).alias("block")
        groups = rows.groupBy("tree", "depth", block).agg(F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("kids"))
        groups = groups.select("tree", "depth", "block", F.col("kids.hash").alias("a0"))
        for j in range(LEVELS):
            groups = groups.withColumn(f"a{j + 1}", F.when(F.col("depth") > base + j, _level_above(F.col(f"a{j}"))).otherwise(
                F.array().cast("array<string>")))
        groups = table(groups, f"{name}-{base}")
        found = groups.select("tree", "depth", "block", F.explode(F.concat(
            *[_with_siblings(F.col(f"a{j}"), j) for j in range(LEVELS)])).alias("x")).select(
            "tree", "depth", (F.col("x.step") + base).alias("level"),
            (F.col("block") * F.pow(F.lit(ARITY), F.lit(LEVELS) - F.col("x.step")).cast("long") + F.col("x.place")).alias("idx"),
            "x.hash", "x.l", "x.r")
        out = found if out is None else out.unionByName(found)
        base += LEVELS
        rows = groups.filter(F.col("depth") >= base).select("tree", "depth", F.col("block").alias("idx"), F.col("a4")[0].alias("hash"))
    return out


def _pointed(rows: DataFrame, sub: Column, root: Column) -> DataFrame:
    """Rows that point to their parents; the root points nowhere."""
    done = root.isNotNull()
    return rows.select(
        "tree", "level", "idx", "hash",
        F.when(done, F.array().cast("array<struct<l:binary,r:binary>>")).otherwise(F.array(F.struct("l", "r"))).alias("seg"),
        F.when(~done, F.col("up_tree")).alias("up_tree"), F.when(~done, F.col("up_level")).alias("up_level"),
        F.when(~done, F.floor(F.col("up_idx") / ARITY)).alias("up_idx"), sub.alias("sub"), root.alias("root"))


def jumped(rows: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Each row with its ancestor's segment behind its own, and its ancestor's pointer. A row
    that has reached the root points at a place of its own that no node has."""
    t = ancestors.select(F.col("tree").alias("t_tree"), F.col("level").alias("t_level"), F.col("idx").alias("t_idx"),
                         *[F.col(c).alias("t_" + c) for c in ("seg", "up_tree", "up_level", "up_idx", "sub", "root")])
    met = rows.join(t, (rows["up_tree"] == t["t_tree"]) & (rows["up_level"] == t["t_level"]) & (rows["up_idx"] == t["t_idx"]), "left")
    own = {"seg": F.concat("seg", F.coalesce("t_seg", F.array().cast("array<struct<l:binary,r:binary>>"))),
           "up_tree": F.coalesce("t_up_tree", "tree"), "up_level": F.coalesce("t_up_level", F.lit(-1)),
           "up_idx": F.coalesce("t_up_idx", "idx"), "sub": F.coalesce("sub", "t_sub"), "root": F.coalesce("root", "t_root")}
    return met.select(*[own[c].alias(c) if c in own else F.col(c) for c in rows.columns])


def prove(docs: DataFrame, stored_text: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, path (siblings to the left and
    right of each level, binary), and stored_leaf (null: as leaf), the leaf of ``stored_text``."""
    placed = numbered(table(leaves(docs, stored_text), "leaves"), "tree",
                      [F.col("doc_id"), F.col("leaf"), F.col("row")], "ranks").drop("row")
    placed = table(placed, "places")
    if placed.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, leaf string, stored_leaf string, subroot string, root string, "
                                                     "path array<struct<l:binary,r:binary>>")
    lower = nodes(placed.select("tree", "idx", "n", F.col("leaf").alias("hash")), "nodes")
    subroots = table(lower.filter("level = depth").select(F.col("tree").alias("source"), "level", "hash"), "subroots")
    name = F.when(F.col("source") != "-", F.expr("substr(source, instr(source, ':') + 1)"))
    ranked = table(numbered(subroots.withColumn("tree", F.lit(TOP)), "tree", [name], "subroot-ranks"), "subroot-places")
    upper = table(nodes(ranked.select("tree", "idx", "n", as_hex(F.col("hash")).alias("hash")), "top"), "top-nodes")
    top = upper.first()["depth"]

    last = F.col("level") == top
    parents = [F.col("tree").alias("up_tree"), (F.col("level") + 1).alias("up_level"), F.col("idx").alias("up_idx")]
    none = F.lit(None).cast("binary")
    inside = _pointed(lower.filter("level < depth").select("*", *parents), none, none)
    above = _pointed(upper.filter("level > 0").select("*", *parents), none, F.when(last, F.col("hash")))
    places = ranked.select(F.col("source"), F.col("level").alias("at_level"), F.col("idx").alias("at_idx"))
    # a subroot is a node of its source and a leaf of the tree above
    joints = _pointed(
        places.join(upper.filter("level = 0"), F.col("at_idx") == F.col("idx")).select(
            F.col("source").alias("tree"), F.col("at_level").alias("level"), F.lit(0).cast("long").alias("idx"), "hash", "l", "r",
            F.lit(TOP).alias("up_tree"), F.lit(1).alias("up_level"), F.col("at_idx").alias("up_idx")),
        F.col("hash"), F.when(F.lit(top == 0), F.col("hash")))
    all_nodes = table(inside.unionByName(joints).unionByName(above), "pointers")
    rank = placed.select(F.col("tree").alias("of"), F.col("idx").alias("at"), "doc_id", "stored_leaf")
    low = all_nodes.filter((F.col("level") == 0) & (F.col("tree") != TOP))
    low = low.join(rank, (low["tree"] == rank["of"]) & (low["idx"] == rank["at"])).drop("of", "at")
    ancestors = all_nodes.filter((F.col("level") > 0) | (F.col("tree") == TOP))
    # the root's own row is read too, for its digest
    distance, far = 1, placed.agg(F.max(depth(F.col("n")))).first()[0] + top + 1
    while distance < far:
        low = jumped(low, ancestors)
        distance *= 2
        if distance < far:
            asked = ancestors.filter((F.col("tree") == TOP) | (F.col("level") % distance == 0))
            ancestors = table(jumped(asked, ancestors), f"pointers-{distance}")
    return low.select("doc_id", as_hex(F.col("hash")).alias("leaf"), "stored_leaf", as_hex(F.col("sub")).alias("subroot"),
                      as_hex(F.col("root")).alias("root"), F.col("seg").alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: digest(as_hex(s["l"]), h, as_hex(s["r"])))


def verify(proofs: DataFrame) -> DataFrame:
    """proof_sha256, folded_root and verified of each proof: the stored leaf, where it
    differs, is folded with the original siblings."""
    siblings = F.array_join(F.transform("path", lambda s: F.concat(as_hex(s["l"]), as_hex(s["r"]))), "")
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.coalesce("stored_leaf", "leaf"), F.col("path")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
