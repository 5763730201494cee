"""Finding, de-duplicating and merging the new rows of a batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from txnmart.operators.members import apart
from txnmart.schemas import ID
from txnmart.scratch import staged


Existing = DataFrame | Callable[[DataFrame], DataFrame | None]


@dataclass(frozen=True)
class Fresh:
    """What a batch brings: its new rows, and how many of the others there are."""

    rows: DataFrame
    known: int


def find_new(batch: DataFrame, existing: Existing, key: str = ID) -> Fresh:
    """Rows of ``batch`` whose key is not in ``existing``, and the number of those whose key is.

    ``existing`` may also be a function of the batch's distinct keys that gives the rows which
    can have one of them (None for no rows), so that whatever holds none is not even listed.

    Repeats inside the batch all survive, and a NULL key never matches, so its row is
    always new. ``existing`` is scanned for its key alone, and only where its files'
    statistics overlap the batch's range of keys: with ids that grow over time, old files
    are skipped unread.

    No key can overload a task, however often it repeats. Both sides shrink to distinct
    keys (combined before the shuffle) to find the keys in both; where the batch's keys
    are small enough to broadcast, Spark moves that semi join below the distinct and the
    existing table is not shuffled at all. Whole rows then meet the shorter list, of keys
    seen before or of fresh ones: few new rows in a large redelivery, or few repeats in a
    new batch, are found without shuffling the batch. A list too large to broadcast meets only
    the rows that :func:`apart` leaves for it. All lists are written out, so such a
    join is between two plain shuffles, the shape in which adaptive
    execution splits the batch's hot or NULL keys over several tasks. What is counted is counted
    by the writes.

    The batch is read up to three times and should be a table, or a projection of one.
    """
    present = F.col(key).isNotNull()
    counted = batch.select(key).where(present).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    seen = Observation()
    facts = [F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("keys"), F.sum("_rows").alias("rows")]
    counts = staged(counted.observe(seen, *facts), "batch-keys")
    in_batch, keys = seen.get, counts.select(key)
    held = existing(keys) if callable(existing) else existing
    if held is None:
        return Fresh(batch, 0)
    in_range = F.col(key).between(F.lit(in_batch["low"]), F.lit(in_batch["high"]))
    known = held.select(key).where(in_range).distinct()
    found = Observation()
    both = staged(known.join(keys, key, "left_semi").observe(found, F.count(key).alias("keys")), "seen-keys")
    seen_keys = found.get["keys"]
    if seen_keys == 0:
        return Fresh(batch, 0)
    if seen_keys == in_batch["keys"]:
        return Fresh(batch.where(~present), in_batch["rows"])
    if 2 * seen_keys <= in_batch["keys"]:
        rows = counts.join(both, key, "left_semi").agg(F.sum("_rows")).first()[0]
        may_be_seen, others = apart(batch, both, key, seen_keys)
        new = may_be_seen.join(both, key, "left_anti").select(batch.columns)
        return Fresh(new if others is None else new.unionByName(others), rows)
    left = Observation()
    unseen = counts.join(both, key, "left_anti").observe(left, F.sum("_rows").alias("rows"))
    fresh = staged(unseen.select(key), "fresh-keys")
    may_be_fresh, _ = apart(batch, fresh, key, in_batch["keys"] - seen_keys)
    new = may_be_fresh.join(fresh, key, "left_semi").select(batch.columns)
    return Fresh(new.unionByName(batch.where(~present)), in_batch["rows"] - left.get["rows"])


def new_rows(batch: DataFrame, existing: Existing, key: str = ID) -> DataFrame:
    """The new rows of :func:`find_new`."""
    return find_new(batch, existing, key).rows


def union_by_name(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.unionByName(new)


def merged(existing: DataFrame | None, batch: DataFrame, key: str = ID) -> DataFrame:
    """What a table holds after the batch: old rows plus new ones; with nothing new it is
    unchanged, with no table (or an empty one) it is the batch."""
    if existing is None:
        return batch
    return union_by_name(existing, new_rows(batch, existing, key))


def dedup_batch(batch: DataFrame, key: str = ID) -> DataFrame:
    """One row per key: the least by all other columns, NULLs first, so every run keeps
    the same row. Rows with a NULL key are no duplicates of each other and all stay.

    The rank filter keeps one row per key in each task before the shuffle, so a key
    repeated a billion times reaches its task as one row per input partition.
    """
    least = Window.partitionBy(key).orderBy(*[c for c in batch.columns if c != key])
    keyed = batch.where(F.col(key).isNotNull())
    kept = keyed.withColumn("_n", F.row_number().over(least)).where("_n = 1").drop("_n")
    return kept.unionByName(batch.where(F.col(key).isNull()))
