"""Connected components of a link table by alternating large-star and small-star joins.

Every round is two aggregations and two joins; a hub's links are combined before its shuffle,
and where links meet their node's smallest neighbour the other side has one row per node, so
adaptive execution can split a hub. Rounds are written to the scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.scratch import staged, temporary


def _downward(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller; loops go."""
    return (
        links.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _state(links: DataFrame) -> tuple[int, int]:
    mark = F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0).cast("long"))
    n, x = links.agg(F.count("*"), mark).first()
    return n, x


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node that has a link.

    ``links`` has long columns ``u`` and ``v``; order, repeats and loops do not matter."""
    spark = links.sparkSession
    with temporary(spark) as block:
        now = staged(_downward(links), "links")
        state = _state(now)
        while state[0]:
            with temporary(spark) as round_:
                after = round_.keep(staged(_round(now), "links"))
            new_state = _state(after)
            if new_state == state:
                break
            now, state = after, new_state
        # Links are stars now: each node but the smallest points at it.
        roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
        stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        return block.keep(staged(stars.unionAll(roots), "components"))


def _round(now: DataFrame) -> DataFrame:
    """The links after a large-star and a small-star step. The smallest neighbours are written before
    they are joined: a join beside the aggregation that feeds it could not be split."""
    both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = staged(least, "smallest-neighbours")
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    down = staged(_downward(large), "links")
    least = staged(down.groupBy("u").agg(F.min("v").alias("m")), "smallest-neighbours")
    small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _downward(small.unionAll(least.select("u", F.col("m").alias("v"))))
