"""Hard-negative mining with exact integer scores by the method of the Four Russians.

Components become whole numbers, ``floor(scale * x)``, and a row's score is its inner product with
the anchor. Every row is indexed once as packed bit planes: in two's complement, one byte for eight
components of one plane. An anchor's components are taken in groups of eight, and the sums of all
256 subsets of a group are tabulated; a plane's part of a score is then one look-up per group, and
planes are added from the highest down, shifting once a plane. All scores are exact.

Anchors (``every``: rows whose id it divides) meet all rows in tiles: both sides are dealt by a hash
into parts of about ``tile`` rows, and each pair of parts is a group of its own, so no label, vector
or anchor makes a large group. A first pass over rows of the anchor's label keeps the best of each
tile, which gives the positives; a second pass over all others keeps, for each anchor and positive,
the best of a tile inside the positive's band. Parts are ranked by a window that Spark limits before
its shuffle.

Rows with a NULL label, a NULL vector, or any NULL or non-finite component take no part. Rows meet
rows of the same length only (empty vectors score 0). A NULL id is no anchor and comes last among
ties. Ids are longs. Repeated rows and ids are rows of their own: a copy of an anchor can be its positive. A score
beyond a long counts as the largest or smallest long. Extra columns are ignored; an anchor without
positives or without rows in the band gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnmart.llm.common import partitions
from txnmart.scratch import staged, temporary

EVERY = 100
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
BAND = (30, 90)  # per cent of the positive's score
TILE = 8192  # rows of a part of a tile
LEAST_PART = 512  # parts get no smaller for the sake of more tasks
ANCHORS, ROWS = 128, 2048  # scored at once: tables and scores of about a megabyte
LONG = (-(1 << 63), (1 << 63) - 1)


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, as 64-bit integers where they fit and as Python's otherwise."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    exact = np.frompyfunc(lambda x: math.floor(x * scale) if abs(x) < 2.0**53 else int(x) * scale, 1, 1)
    return exact(values)


def planes_needed(numbers: np.ndarray) -> np.ndarray:
    """Planes that hold each row of numbers in two's complement; 8 at least."""
    bare = np.where(numbers < 0, ~numbers, numbers)
    if numbers.dtype == object:
        most = np.array([max((int(x).bit_length() for x in row), default=0) for row in bare], np.int64)
    else:
        most = np.frexp(bare.max(axis=1, initial=0).astype(np.float64))[1].astype(np.int64)
    return np.maximum(most + 1, 8)


def pack(numbers: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups of eight components) bytes of the numbers' bits, lowest plane first."""
    bits = np.stack([((numbers >> p) & 1).astype(np.uint8) for p in range(planes)], axis=1)
    return np.packbits(bits, axis=2, bitorder="little")


def unpack(packed: np.ndarray, dims: int) -> np.ndarray:
    """The numbers again."""
    bits = np.unpackbits(packed, axis=2, bitorder="little", count=dims)
    kind = np.int64 if packed.shape[1] < 63 else object
    out = -bits[:, -1].astype(kind)
    for p in range(packed.shape[1] - 2, -1, -1):
        out = out + out + bits[:, p].astype(kind)
    return out


def subset_sums(anchors: np.ndarray, kind) -> np.ndarray:
    """(groups, 256, anchors): for each group of eight components, the sums of all its subsets."""
    n, dims = anchors.shape
    groups = -(-dims // 8)
    padded = np.zeros((n, groups * 8), kind)
    padded[:, :dims] = anchors
    parts = padded.reshape(n, groups, 8).transpose(1, 2, 0)
    sums = np.zeros((groups, 256, n), kind)
    for j in range(8):
        sums[:, 1 << j : 2 << j] = sums[:, : 1 << j] + parts[:, j : j + 1]
    return sums


def scores(anchors: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """The exact inner products (anchors, rows) of whole-number vectors with packed rows."""
    planes, groups = packed.shape[1:]
    most = max((int(x) for x in np.abs(anchors).sum(axis=1)), default=0) << planes
    kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 62 else object
    out = np.empty((len(anchors), len(packed)), kind)
    for a in range(0, len(anchors), ANCHORS):
        sums = subset_sums(anchors[a : a + ANCHORS], kind)
        for r in range(0, len(packed), ROWS):
            rows = packed[r : r + ROWS]
            total = np.zeros((len(rows), sums.shape[2]), kind)
            for p in range(planes - 1, -1, -1):
                total += total  # the shift
                for g in range(groups):
                    looked_up = sums[g].take(rows[:, p, g], axis=0)
                    # The highest plane is the sign's.
                    total = total - looked_up if p == planes - 1 else np.add(total, looked_up, out=total)
            out[a : a + ANCHORS, r : r + ROWS] = total.T
    if kind is object and out.size:
        out = np.clip(out, *LONG)
    return out


def first_of(row: np.ndarray, most: int) -> np.ndarray:
    """Where the ``most`` largest values are, in their order, ties by position."""
    if len(row) > most:
        least = np.partition(row, len(row) - most)[len(row) - most]
        some = np.flatnonzero(row >= least)
    else:
        some = np.arange(len(row))
    return some[np.argsort(-row[some], kind="stable")][:most]


def banded(row: np.ndarray, positives: list[int], band: tuple[int, int], most: int) -> list[np.ndarray]:
    """For each positive's score, where the ``most`` largest values inside its band are."""
    limits = [(-(-band[0] * int(p) // 100), band[1] * int(p) // 100) for p in positives]
    open_ = [x for x in limits if x[0] <= x[1]]
    if not open_:
        return [np.zeros(0, np.int64)] * len(limits)
    some = np.flatnonzero((row >= min(x[0] for x in open_)) & (row <= max(x[1] for x in open_)))
    some = some[np.argsort(-row[some], kind="stable")]
    falling = -row[some]
    out = []
    for low, high in limits:
        start, end = np.searchsorted(falling, -high, "left"), np.searchsorted(falling, -low, "right")
        out.append(some[start : max(start, min(end, start + most))])
    return out


def index_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label``, ``dims``, ``planes`` and ``packed`` of the rows that take part."""
    label = vectors.schema["label"].dataType.simpleString()
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.select(F.col("vec_id").cast("long"), "label", "embedding").where(
        "label is not null and embedding is not null"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            length = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            start = np.cumsum(length) - length
            planes, packed = np.zeros(len(length), np.int32), [b""] * len(length)
            for dims in np.unique(length):
                rows = np.flatnonzero(length == dims)
                numbers = whole(flat[start[rows][:, None] + np.arange(dims)], scale)
                planes[rows] = planes_needed(numbers)
                for p in np.unique(planes[rows]):
                    held = np.flatnonzero(planes[rows] == p)
                    for i, bits in zip(rows[held], pack(numbers[held], int(p)), strict=True):
                        packed[i] = bits.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array(length.astype(np.int32)),
                    pa.array(planes),
                    pa.array(packed, pa.binary()),
                ],
                names=["vec_id", "label", "dims", "planes", "packed"],
            )

    schema = f"vec_id long, label {label}, dims int, planes int, packed binary"
    return usable.where(~odd).mapInArrow(run, schema)


def _blocks(f: pd.DataFrame):
    """A part's rows by their number of planes: (where they are, packed)."""
    dims = int(f["dims"].iloc[0])
    planes = f["planes"].to_numpy()
    for p in np.unique(planes):
        at = np.flatnonzero(planes == p)
        held = np.frombuffer(b"".join(f["packed"].iloc[at]), np.uint8)
        yield at, held.reshape(len(at), int(p), -(-dims // 8)), dims


def _tile_scores(rows: pd.DataFrame, anchors: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Some anchors at a time with their scores (anchors, rows) for all rows of the tile."""
    for at, held, dims in _blocks(anchors):
        for a in range(0, len(at), ANCHORS):
            numbers = unpack(held[a : a + ANCHORS], dims)
            parts = [(where, scores(numbers, packed)) for where, packed, _ in _blocks(rows)]
            kind = np.result_type(*[s.dtype for _, s in parts])
            out = np.empty((len(numbers), len(rows)), kind)
            for where, s in parts:
                out[:, where] = s
            yield anchors.iloc[at[a : a + ANCHORS]], out


def _tiles(rows: DataFrame, anchors: DataFrame, by: list[str], tile: int):
    """Rows and anchors dealt into parts that meet once each: both grouped by ``by`` and tile.

    Each row goes to every part of the anchors it may meet, and the other way round; the larger
    ``tile``, the fewer times."""
    deal = partitions(rows.sparkSession)
    parts = lambda df, name, least: df.groupBy(*by).agg(F.count("*").alias("n")).select(
        *by, F.greatest(F.ceil(F.col("n") / tile), F.least(F.lit(least), F.ceil(F.col("n") / LEAST_PART))).alias(name)
    )
    dealt = staged(parts(rows, "chunks", deal).join(parts(anchors, "cells", 1), by), "tile-counts")
    own = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    met = rows.join(dealt, by).select(*rows.columns, own("chunks").alias("chunk"), every("cells").alias("cell"))
    asked = anchors.join(dealt, by).select(
        *anchors.columns, own("cells").alias("cell"), every("chunks").alias("chunk")
    )
    key = [*by, "cell", "chunk"]
    return met.groupBy(*key).cogroup(asked.groupBy(*key))


def _in_order(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows by id, so that a row's place decides ties; NULL ids last."""
    return rows.sort_values(["no_id", "id"], kind="stable", ignore_index=True)


def _ids(rows: pd.DataFrame, at: list[int]) -> pd.Series:
    some = rows.iloc[at]
    return some["id"].astype("Int64").mask(some["no_id"]).reset_index(drop=True)


def _sent(rows: DataFrame) -> DataFrame:
    """Rows as tiles take them: pandas would make floats of ids beside a NULL."""
    return rows.select(
        "row", "label", "dims", "planes", "packed", F.coalesce("vec_id", F.lit(0).cast("long")).alias("id"),
        F.col("vec_id").isNull().alias("no_id"),
    )


def positives_of(rows: DataFrame, anchors: DataFrame, most: int = POSITIVES, tile: int = TILE) -> DataFrame:
    """``anchor`` (its row), ``nth``, ``positive_id``, ``positive_score``: the first ``most`` other
    rows of each anchor's label."""

    def run(met: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int]] = []
        met = _in_order(met)
        own = met["row"].to_numpy()
        for some, table in _tile_scores(met, asked) if len(asked) and len(met) else ():
            for row, values in zip(some["row"].tolist(), table, strict=True):
                first = first_of(values, most + 1)
                first = first[own[first] != row][:most]
                found += [(row, i, int(values[i])) for i in first]
        at = [f[1] for f in found]
        return pd.DataFrame(
            {
                "anchor": pd.Series([f[0] for f in found], dtype="int64"),
                "positive_id": _ids(met, at),
                "positive_score": pd.Series([f[2] for f in found], dtype="int64"),
            }
        )

    best = _tiles(_sent(rows), anchors, ["dims", "label"], tile).applyInPandas(
        run, "anchor long, positive_id long, positive_score long"
    )
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    return best.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)


def negatives_of(
    rows: DataFrame,
    asked: DataFrame,
    most: int = NEGATIVES,
    band: tuple[int, int] = BAND,
    tile: int = TILE,
) -> DataFrame:
    """``anchor``, ``nth`` (its positive), ``rank``, ``negative_id``, ``negative_score``. ``asked``:
    anchors with ``positives``, the scores of their positives in order."""

    def run(met: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int, int]] = []
        met = _in_order(met)
        labels = met["label"].to_numpy()
        for some, table in _tile_scores(met, wanted) if len(wanted) and len(met) else ():
            for row, label, positives, values in zip(
                some["row"].tolist(), some["label"], some["positives"], table, strict=True
            ):
                other = np.flatnonzero(labels != label)
                values = values[other]
                for nth, at in enumerate(banded(values, list(positives), band, most), 1):
                    found += [(row, nth, other[i], int(values[i])) for i in at]
        return pd.DataFrame(
            {
                "anchor": pd.Series([f[0] for f in found], dtype="int64"),
                "nth": pd.Series([f[1] for f in found], dtype="int32"),
                "negative_id": _ids(met, [f[2] for f in found]),
                "negative_score": pd.Series([f[3] for f in found], dtype="int64"),
            }
        )

    best = _tiles(_sent(rows), asked, ["dims"], tile).applyInPandas(
        run, "anchor long, nth int, negative_id long, negative_score long"
    )
    order = Window.partitionBy("anchor", "nth").orderBy(
        F.desc("negative_score"), F.asc_nulls_last("negative_id")
    )
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(
    vectors: DataFrame,
    every: int = EVERY,
    scale: int = SCALE,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
    tile: int = TILE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score`` for ``vectors`` (``vec_id``, ``embedding``, ``label``)."""
    with temporary(vectors.sparkSession) as block:
        indexed = index_rows(vectors, scale).withColumn("row", F.monotonically_increasing_id())
        rows = staged(indexed, "packed-vectors")
        anchors = staged(rows.where(F.col("vec_id") % every == 0), "anchors")
        positives = staged(positives_of(rows, anchors, n_positives, tile), "positives")
        in_order = F.transform(
            F.array_sort(F.collect_list(F.struct("nth", "positive_score"))), lambda p: p["positive_score"]
        )
        per_anchor = positives.groupBy("anchor").agg(in_order.alias("positives"))
        asked = staged(
            anchors.join(per_anchor, F.col("row") == F.col("anchor")).drop("anchor"), "asked-anchors"
        )
        negatives = negatives_of(rows, asked, n_negatives, band, tile)
        named = positives.join(
            asked.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor"
        )
        out = negatives.join(named, ["anchor", "nth"]).select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int"),
            "negative_id",
            "positive_score",
            "negative_score",
        )
        return block.keep(staged(out, "hard-negatives"))


def hard_negative_report(vectors: DataFrame) -> DataFrame:
    """The result over ``vectors`` with every seventh id's label moved on by one, modulo ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", "embedding", moved.alias("label")))
