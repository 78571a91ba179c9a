"""Exact duplicates by content-defined chunk recipes (DataFrame functions only).

Texts are equal when identical after lower-casing A-Z only; a null text counts as
empty. The whole text of each row is cut once, by one regular expression, into
chunks whose ends depend on nearby characters only. A chunk becomes a 64-bit
identifier with its SHA-256; the row's recipe is the ordered list. From there only
recipes move, never texts:

1. verify: an identifier is good when all chunks of the corpus that bear it have
   one SHA-256. Rows with a chunk whose identifier fails compare by the list of
   SHA-256 values instead;
2. group rows by the ordered identifier list (pre-aggregated before the shuffle),
   and join each row with its group's representative. A group that holds a large
   part of all rows is split by the skew-join rule, the other side being one row.

Ties and repeated rows: the row with the largest doc_id stays (a null doc_id counts
as smallest); of rows that also share the doc_id exactly one stays. Empty table:
empty result. Only ``doc_id`` and ``text`` are read; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hrforge.llm.common import free_name, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A chunk has 1,024 characters or more and ends before a blank that one of a few
#: letters follows, or after East Asian punctuation; at 8,192 it ends anyway.
CHUNK = r"(?s).{1024,8192}?(?=[\x20\n][b-dw])|(?s).{1024,8192}?[。，、]|(?s).{1,8192}"


def normalised(text: Column) -> Column:
    """Text in lower case (A-Z only), null as empty. ``lower`` does the same as
    ``translate`` on pure ASCII and is much faster."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def recipes(docs: DataFrame) -> DataFrame:
    """One row per document: row number, SHA-256 of the text, ordered chunk list."""
    text = docs.select("doc_id", F.monotonically_increasing_id().alias("row"),
                       normalised(F.col("text")).alias("norm"))
    chunks = F.transform(
        F.regexp_extract_all("norm", F.lit(CHUNK), F.lit(0)),
        lambda c: F.struct(F.xxhash64(c).alias("id"), F.unhex(F.sha2(c, 256)).alias("sha")))
    return text.select("doc_id", "row", F.sha2("norm", 256).alias("text_sha256"), chunks.alias("chunks"))


def unverified(recipe: DataFrame) -> DataFrame:
    """Identifiers that stand for chunks of different content (normally none)."""
    return (recipe.select(F.explode("chunks").alias("c")).select("c.id", "c.sha").distinct()
            .groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and n_chunks for every row."""
    recipe = table(recipes(docs), "recipes")
    doubtful = (recipe.select("row", F.explode("chunks").alias("c")).select("row", F.col("c.id").alias("id"))
                .join(unverified(recipe), "id", "left_semi").select("row").distinct()
                .withColumn("doubt", F.lit(True)))
    none = F.array().cast("array<binary>")
    keyed = recipe.join(doubtful, "row", "left").select(
        "doc_id", "row", "text_sha256", F.size("chunks").alias("n_chunks"),
        F.col("chunks.id").alias("ids"),
        F.when(F.coalesce("doubt", F.lit(False)), F.col("chunks.sha")).otherwise(none).alias("shas"))
    groups = keyed.groupBy("ids", "shas").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("stays"))
    return keyed.join(groups, ["ids", "shas"]).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"), "text_sha256", "n_chunks")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group; all columns stay as they are."""
    def key(doc_id: Column, sha: Column) -> Column:
        return F.concat_ws(":", sha, doc_id.cast("string"))

    same, place = free_name(docs, "same"), free_name(docs, "place")
    kept = exact_groups(docs).filter("kept").select(key(F.col("doc_id"), F.col("text_sha256")).alias(same))
    rows = docs.withColumn(same, key(F.col("doc_id"), F.sha2(normalised(F.col("text")), 256)))
    nth = F.row_number().over(Window.partitionBy(same).orderBy(same))
    return (rows.join(kept, same, "left_semi").withColumn(place, nth)
            .filter(F.col(place) == 1).select(*docs.columns))
