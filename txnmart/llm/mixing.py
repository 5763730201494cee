"""Mixing sources to target weights by blocks of tokens (here: words).

The words of each source, in document order, are cut into blocks of a fixed length; blocks run
over document ends. Output shards have a fixed number of slots. How many slots a shard gives
to each source is drawn from a multinomial over what is still to be placed, so that the draws
of all shards add up to the targets. The j-th slot of a source takes the block at a
pseudorandom permutation of its indices; each pass over the source has a permutation of its
own, so no block is taken more than ``ceil(slots / blocks)`` times. Slots and blocks then meet
in one join by (source, block), a sort-merge join: slots are made from one row per source and
shard, by whose few bytes Spark would take them for small enough to broadcast.

Prefix sums of sizes are taken inside sorted range partitions, plus one small table of
partition totals, so a source that holds most rows is spread over all tasks. What the driver
holds is one number per source and shard; ``most_shards`` bounds the shards, and more than
``MOST_SOURCES`` sources are refused (a ValueError): their weights are settings of the mix.

NULL sources are a source of their own. NULL or empty texts have no words and are never taken.
Rows are numbered, so repeated ids and rows are told apart; extra columns are ignored. The same
rows give the same mix: documents are ordered by (source, id, size) and all draws are seeded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnmart.llm.common import apart, mix64, partitions, word_count
from txnmart.scratch import staged

BLOCK_WORDS = 64
SHARD_SLOTS = 8192
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
MOST_SOURCES = 100_000


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Words to take of each source: ``share`` of all words by weight, none above ``most``
    times its size; what is cut off goes to the others by weight."""
    left, out = share * sum(sizes), [0.0] * len(sizes)
    active = [i for i, s in enumerate(sizes) if s > 0]
    while active:
        total = sum(weights[i] for i in active)
        full = [i for i in active if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in active:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in full)
        active = [i for i in active if i not in set(full)]
    return out


def draw_shards(slots: np.ndarray, shard_slots: int, seed: int) -> Iterator[np.ndarray]:
    """For each shard, its slots per source: a multinomial over the slots still to be placed,
    redrawn only for what exceeds them. The shards add up to ``slots``."""
    rng = np.random.default_rng(seed)
    left = slots.astype(np.int64).copy()
    while (total := int(left.sum())) > 0:
        room = min(shard_slots, total)
        drawn = np.zeros(len(left), np.int64)
        while room:
            open_slots = left - drawn
            more = np.minimum(rng.multinomial(room, open_slots / open_slots.sum()), open_slots)
            drawn += more
            room -= int(more.sum())
        left -= drawn
        yield drawn


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n-1 at ``index``: four Feistel rounds over the next
    power of four, walked on until inside."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    low = np.uint64((1 << half) - 1)

    def rounds(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for r in range(4):
            f = mix64(right + np.uint64((key * 4 + r) * 0x9E3779B97F4A7C15 % (1 << 64)))
            left, right = right, left ^ (f >> np.uint64(20) & low)
        return left << np.uint64(half) | right

    out = rounds(index.astype(np.uint64))
    while (outside := out >= n).any():
        out[outside] = rounds(out[outside])
    return out.astype(np.int64)


def _offsets(sized: DataFrame) -> DataFrame:
    """``sized`` (row, sid, doc_id, size) with ``before``: the words of its source ahead of it."""
    spark = sized.sparkSession

    def running(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        last, held = None, 0
        for f in frames:
            sums = f.groupby("sid")["size"].cumsum()
            # Sorted by source: only the first source of a batch can go on from the last one.
            if len(f):
                sums = sums + np.where(f["sid"].to_numpy() == last, held, 0)
                last, held = f["sid"].iloc[-1], int(sums.iloc[-1])
            yield f[["row", "sid", "size"]].assign(task=task, within=sums - f["size"])

    ordered = sized.repartitionByRange(partitions(spark), "sid", "doc_id", "size", "row")
    local = staged(
        ordered.sortWithinPartitions("sid", "doc_id", "size", "row").mapInPandas(
            running, "row long, sid int, size long, task int, within long"
        ),
        "mix-order",
    )
    ahead = Window.partitionBy("sid").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    totals = local.groupBy("sid", "task").agg(F.sum("size").alias("words"))
    starts = totals.select(
        "sid", "task", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("first")
    )
    return local.join(starts, ["sid", "task"]).select(
        "row", "sid", "size", (F.col("within") + F.col("first")).alias("before")
    )


class Mix:
    """A planned mix. ``sized``: row, doc_id, source, size. ``sources``: the targets.
    ``pieces()``: what the shards hold."""

    def __init__(
        self,
        docs: DataFrame,
        weights: tuple[float, ...] = WEIGHTS,
        share: float = SHARE,
        most: float = MOST,
        block_words: int = BLOCK_WORDS,
        shard_slots: int = SHARD_SLOTS,
        most_shards: int = 100_000,
        seed: int = 11,
        row: Column | None = None,
    ):
        self.spark: SparkSession = docs.sparkSession
        self.block_words, self.seed = block_words, seed
        numbered = docs.select(
            (row if row is not None else F.monotonically_increasing_id()).alias("row"),
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
        )
        self.sized = staged(numbered, "mix-sizes")
        by_source = staged(self.sized.groupBy("source").agg(F.sum("size").alias("size")), "mix-sources")
        if (many := by_source.count()) > MOST_SOURCES:
            raise ValueError(f"{many} sources; a mix takes {MOST_SOURCES} at most")
        # One row per source: a source list is part of the mix's settings.
        totals = by_source.collect()
        totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        self.names = [r["source"] for r in totals]
        self.sizes = [int(r["size"]) for r in totals]
        by = [weights[i % len(weights)] for i in range(len(totals))]
        self.targets = targets(self.sizes, by, share, most)
        self.blocks = np.array([-(-s // block_words) for s in self.sizes], np.int64)
        mean = np.array([s / b if b else 1.0 for s, b in zip(self.sizes, self.blocks, strict=True)])
        wanted = np.rint(np.array(self.targets) / mean).astype(np.int64) if totals else np.zeros(0, np.int64)
        self.slots = np.minimum(wanted, np.floor(most * self.blocks).astype(np.int64))
        self.shard_slots = max(shard_slots, -(-int(self.slots.sum()) // most_shards))

    def sources(self) -> DataFrame:
        """``sid``, ``source``, ``source_size``, ``target``: one row per source."""
        rows = list(zip(range(len(self.names)), self.names, self.sizes, self.targets, strict=True))
        kind = self.sized.schema["source"].dataType.simpleString()
        return self.spark.createDataFrame(
            rows, f"sid int, source {kind}, source_size long, target double"
        )

    def _numbered(self) -> DataFrame:
        s = F.broadcast(self.sources().select("sid", F.col("source").alias("named")))
        return self.sized.join(s, F.col("source").eqNullSafe(F.col("named"))).where("size > 0")

    def document_blocks(self) -> DataFrame:
        """The blocks each document has words in: ``sid``, ``block``, ``row``, the first word
        in the document and the number of words."""
        b = F.lit(self.block_words)
        placed = _offsets(self._numbered().select("row", "sid", "doc_id", "size"))
        end = F.col("before") + F.col("size")
        each = placed.withColumn(
            "block", F.explode(F.sequence(F.floor(F.col("before") / b), F.floor((end - 1) / b)))
        )
        first = F.greatest(F.col("block") * b, F.col("before"))
        last = F.least((F.col("block") + 1) * b, end)
        return each.select(
            "sid",
            "block",
            "row",
            (first - F.col("before")).alias("start"),
            (last - first).alias("n_words"),
        )

    def shard_slots_table(self) -> DataFrame:
        """Every slot of every shard: ``shard``, ``slot``, ``sid``, ``block``."""
        given = np.zeros(len(self.slots), np.int64)
        rows = []
        for shard, drawn in enumerate(draw_shards(self.slots, self.shard_slots, self.seed)):
            first = np.cumsum(drawn) - drawn
            rows += [
                (shard, int(drawn.sum()), int(s), int(first[s]), int(given[s]), int(drawn[s]))
                for s in np.flatnonzero(drawn)
            ]
            given += drawn
        counts = self.spark.createDataFrame(
            rows, "shard int, room int, sid int, first int, given long, n int"
        ).repartition(partitions(self.spark), "shard", "sid")
        blocks, seed = self.blocks, self.seed

        def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for shard, room, sid, first, at, n in f.itertuples(index=False):
                    j = np.arange(at, at + n)
                    passes, index = j // blocks[sid], j % blocks[sid]
                    block = np.empty(n, np.int64)
                    for p in np.unique(passes):
                        on = passes == p
                        key = seed * 1_000_003 + int(sid) * 101 + int(p)
                        block[on] = permuted(index[on], int(blocks[sid]), key)
                    slot = permuted(np.arange(first, first + n), int(room), seed + 7919 * int(shard))
                    yield pd.DataFrame({"shard": shard, "slot": slot, "sid": sid, "block": block})

        return counts.mapInPandas(fill, "shard int, slot long, sid int, block long")

    def pieces(self) -> DataFrame:
        """What the slots hold: ``shard``, ``slot``, ``row``, ``start``, ``n_words``."""
        return (
            self.shard_slots_table()
            .hint("merge")
            .join(self.document_blocks(), ["sid", "block"])
            .select("shard", "slot", "row", "start", "n_words")
        )

    def report(self) -> DataFrame:
        """``doc_id``, ``size``, its source's ``source_size`` and ``target``, and ``taken``."""
        taken = self.pieces().groupBy("row").agg(F.sum("n_words").alias("taken"))
        s = F.broadcast(self.sources().withColumnRenamed("source", "named"))
        return (
            self.sized.join(s, F.col("source").eqNullSafe(F.col("named")))
            .join(taken, "row", "left")
            .select(
                "doc_id",
                "size",
                "source_size",
                "target",
                F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            )
        )


def _kept_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The words of ``spans`` (first word, number), adjoining ones joined by spaces."""
    words = text.encode().split()
    return b" ".join(w for first, n in spans for w in words[first : first + n]).decode()


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as documents: for each pass over its source, a row with the words the mix takes
    of the document in that pass, with the columns of ``docs``. A document taken whole keeps
    its text as it is. ``n_chars`` follows the text where there is one."""
    own = apart(docs, "_mix")
    held = staged(docs.withColumn(f"{own}_row", F.monotonically_increasing_id()), "mix-docs")
    mix = Mix(held, row=F.col(f"{own}_row"), **settings)
    at = F.struct("start", "n_words")
    # A block that is taken twice has two slots: the first makes copy 0, the second copy 1.
    nth = Window.partitionBy("row", "start").orderBy("shard", "slot")
    taken = (
        mix.pieces()
        .withColumn("copy", F.row_number().over(nth))
        .groupBy("row", "copy")
        .agg(F.array_sort(F.collect_list(at)).alias(f"{own}_spans"), F.sum("n_words").alias(f"{own}_words"))
    )
    whole = mix.sized.select("row", F.col("size").alias(f"{own}_size"))
    # Both joins are by row; a row per document is no table to broadcast, however few bytes it takes on disk.
    joined = taken.join(whole.hint("merge"), "row").withColumnsRenamed({"row": f"{own}_of", "copy": f"{own}_copy"})
    joined = joined.join(held, F.col(f"{own}_of") == F.col(f"{own}_row"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if t is None else _kept_words(t, [(s["start"], s["n_words"]) for s in p])
                for t, p in zip(text, spans, strict=True)
            ],
            dtype=object,
        )

    in_part = F.when(F.col(f"{own}_words") < F.col(f"{own}_size"), F.col("text"))
    out = joined.withColumn("text", F.coalesce(cut(in_part, f"{own}_spans"), "text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
