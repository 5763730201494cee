"""Dense surrogate keys 1..n in key order without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnmart.scratch import staged

# monotonically_increasing_id() keeps the partition in the bits above the lowest 33 and
# the row's position in its partition below them.
POSITION_BITS = 33
POSITION_MASK = (1 << POSITION_BITS) - 1


def dense_key(
    keys: DataFrame, order_by: str, id_col: str, start: int = 0, id_type: str = "bigint"
) -> DataFrame:
    """Add ``id_col`` = start + rank of ``order_by``, which must be unique; NULL is first.

    Ids are long. ``id_type="int"`` fits tables that were made with such ids; an id beyond
    its range then fails.

    The keys are range-partitioned and sorted, each row's partition and position are
    written out once (a recomputed sort could draw other range bounds), and every
    partition's offset is the sum of the counts before it. Only the counts, one row per
    range partition, meet in one task and are broadcast.
    """
    ranked = keys.orderBy(F.col(order_by).asc_nulls_first()).withColumn(
        "_rank", F.monotonically_increasing_id()
    )
    placed = staged(ranked, f"ranked-{id_col}").withColumn(
        "_part", F.shiftright("_rank", POSITION_BITS)
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    position = F.col("_rank").bitwiseAND(F.lit(POSITION_MASK))
    return placed.join(F.broadcast(offsets), "_part").select(
        *keys.columns,
        (F.lit(start).cast("long") + F.col("_offset") + position + 1).cast(id_type).alias(id_col),
    )
