"""Keeping a dimension up to date: latest-wins upsert, type-2 history and change apply.

Only keys that a batch holds are worked on. The dimension's other rows pass through an anti join
with the batch's distinct keys, which Spark broadcasts while they are few: they are neither
shuffled nor sorted. A NULL key is a key like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnmart.scratch import staged

# What a change may ask for, in any case and with spaces around it.
INSERT, UPDATE, DELETE = "I", "U", "D"


def _split(dim: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``dim`` whose key is in ``keys``, and the others."""
    known = keys.select(F.col(key).alias("_key"))
    same = F.col(key).eqNullSafe(F.col("_key"))
    return dim.join(known, same, "left_semi"), dim.join(known, same, "left_anti")


def _last(changes: DataFrame, keys: list[Column], order: list[str], rest: list[str]) -> DataFrame:
    """The row of each key that is last by ``order``, combined before the shuffle."""
    ranking = list(dict.fromkeys([*order, *rest]))
    names = [f"_k{i}" for i in range(len(keys))]
    grouped = changes.groupBy(*[k.alias(n) for k, n in zip(keys, names, strict=True)])
    return grouped.agg(F.max(F.struct(*ranking)).alias("last"))


def dim_upsert(dim: DataFrame, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Type 1: one row per key, the batch's last by ``order`` where the batch has the key,
    else the dimension's."""
    rest = [c for c in dim.columns if c != key]
    last = _last(batch, [F.col(key)], order, rest).select(
        F.col("_k0").alias(key), *[F.col("last")[c].alias(c) for c in rest]
    )
    last = staged(last, "upserted")
    _, others = _split(dim, last, key)
    return others.unionByName(last)


def scd2_merge(
    dim: DataFrame, changes: DataFrame, key: str, tracked: str, effective: str, seq: str
) -> DataFrame:
    """Type 2: ``dim`` (key, tracked, valid_from, valid_to, is_current) after ``changes``
    (key, tracked, effective date, sequence).

    Days are the grain: of several changes to a key on one day the last by ``seq`` counts,
    and it replaces a version that began the same day. So a key has at most one version
    per day, and the window over it is bounded by the calendar, however many changes
    arrive. A change to the value already in force adds nothing; one dated before the
    current version takes its place in the timeline.

    Keys without changes stay as they are, closed ones too. A close date that no version
    explains (the key ended then) stays: it closes whatever version is in force on that day,
    and a later change opens the key again, with the same value or another.
    """
    changed, others = scd2_changes(dim, changes, key, tracked, effective, seq)
    return others.select(changed.columns).unionByName(changed)


def scd2_changes(
    dim: DataFrame, changes: DataFrame, key: str, tracked: str, effective: str, seq: str
) -> tuple[DataFrame, DataFrame]:
    """The parts of :func:`scd2_merge`: all versions, closed ones too, of the keys that changes
    hold, and the other rows of ``dim``."""
    latest = staged(
        _last(changes, [F.col(key), F.col(effective).cast("date")], [seq], [tracked]).select(
            F.col("_k0").alias(key),
            F.col(f"last.{tracked}").alias(tracked),
            F.col("_k1").alias("valid_from"),
        ),
        "changes-by-day",
    )
    changed, others = _split(dim, latest.select(key).distinct(), key)
    known = Window.partitionBy(key).orderBy("valid_from")
    following = F.lead("valid_from").over(known)
    ended = F.col("valid_to").isNotNull() & (following.isNull() | (following > F.col("valid_to")))
    marked = changed.withColumn("_ended", F.when(ended, F.col("valid_to")))
    # Three kinds of events, in the order they take effect on a day: an end, a version that
    # was known, a version that is new.
    events = (
        marked.where("_ended is not null")
        .select(
            key,
            F.lit(None).cast(dim.schema[tracked].dataType).alias(tracked),
            F.col("_ended").alias("valid_from"),
            F.lit(0).alias("_kind"),
        )
        .unionByName(marked.select(key, tracked, "valid_from", F.lit(1).alias("_kind")))
        .unionByName(latest.withColumn("_kind", F.lit(2)))
    )
    timeline = Window.partitionBy(key).orderBy("valid_from", "_kind")
    # On one day a new version replaces a known one, and any version an end.
    replaced = F.coalesce(F.lead("valid_from").over(timeline) == F.col("valid_from"), F.lit(False))
    days = events.withColumn("_replaced", replaced).where("not _replaced")
    in_force = F.coalesce(F.lag("_kind").over(timeline) > 0, F.lit(False))
    repeats = (
        (F.col("_kind") > 0) & in_force & F.lag(tracked).over(timeline).eqNullSafe(F.col(tracked))
    )
    versions = days.withColumn("_repeats", repeats).where("not _repeats")
    valid_to = F.lead("valid_from").over(timeline)
    merged = (
        versions.select(key, tracked, "valid_from", valid_to.alias("valid_to"), "_kind")
        .where("_kind > 0")
        .withColumn("is_current", F.col("valid_to").isNull())
    )
    return merged.drop("_kind"), others


def _operation(op: str) -> Column:
    return F.upper(F.trim(F.col(op)))


def known_operation(op: str) -> Column:
    """Whether a change's operation is one of I, U and D."""
    return F.coalesce(_operation(op).isin(INSERT, UPDATE, DELETE), F.lit(False))


def cdc_apply(target: DataFrame, changes: DataFrame, key: str, op: str, seq: str) -> DataFrame:
    """``target`` after change rows (all its columns, plus an operation I, U or D in either
    case and a sequence): the last change per key wins, D removes the key.

    Changes with another operation, or none, take no part; :func:`cdc_rejected` has them.
    Changes shrink to one row per key before the shuffle. ``seq`` must be unique per key.
    """
    rest = [c for c in target.columns if c != key]
    valid = changes.where(known_operation(op)).withColumn(op, _operation(op))
    last = staged(
        _last(valid, [F.col(key)], [seq], [op, *rest]).select(
            F.col("_k0").alias(key), F.col(f"last.{op}").alias("_op"), *[F.col("last")[c].alias(c) for c in rest]
        ),
        "last-changes",
    )
    _, others = _split(target, last, key)
    return others.unionByName(last.where(F.col("_op") != DELETE).drop("_op"))


def cdc_rejected(changes: DataFrame, op: str) -> DataFrame:
    """The changes :func:`cdc_apply` leaves out, because of their operation."""
    return changes.where(~known_operation(op))
