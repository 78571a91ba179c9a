"""Identity-column emulation: dense ids continuing from the table's maximum.

``IDENTITY`` + ``SCOPE_IDENTITY`` hand out ``max(id)+1, +2, ...`` in insertion
order. Here the insertion order is a caller-given natural key, and ids (64 bits) are
assigned without a global window (which would pull every row into one task):

1. range-partition the new rows on the order key, sort inside partitions, number the rows
   of each partition, and write them once in the shared checkpoint folder. The number of
   partitions follows the rows (AQE joins small ones), and all that comes later reads
   this one layout, so a lost executor cannot change an id;
2. count the rows of each partition from the written numbers (one column, one tiny row per
   partition), turn the counts into running offsets, and broadcast that table (its size is
   the partition count);
3. id = base + partition offset + position inside the partition + 1.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hrforge.session import checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def max_id(existing: DataFrame, col: str) -> Column:
    """Scalar subquery ``COALESCE(MAX(col), 0)`` over an existing table."""
    return existing.select(F.coalesce(F.max(col), F.lit(0)).cast("bigint")).scalar()


def assign_ids(df: DataFrame, order_cols: list[str], id_col: str, base: Column | int,
               num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = base + 1-based rank of each row by ``order_cols``.

    ``order_cols`` must identify rows uniquely, so the ids are deterministic.
    ``num_partitions`` fixes the number of partitions.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    parts = [num_partitions] if num_partitions else []
    laid_out = (df.repartitionByRange(*parts, *order_cols).sortWithinPartitions(*order_cols)
                .withColumn("_mid", F.monotonically_increasing_id()))
    laid_out.write.parquet(path)
    laid_out = spark.read.schema(laid_out.schema).parquet(path)
    part = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = laid_out.groupBy(part.alias("_pid")).agg((F.max(pos) + 1).alias("_cnt"))
    # One row per partition: a global running sum over it is cheap.
    offsets = counts.select(
        "_pid",
        (F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
         ).alias("_off"))
    base_col = F.lit(base) if isinstance(base, int) else base
    return (laid_out.withColumn("_pid", part).withColumn("_pos", pos)
            .join(F.broadcast(offsets), "_pid", "left")
            .withColumn(id_col, base_col + F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + 1)
            .drop("_mid", "_pid", "_pos", "_off"))
