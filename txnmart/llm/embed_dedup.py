"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosines, components.

Vectors equal in every component are one class and are compared once. Each table hashes a class
to the signs of its dot products with a few random hyperplanes; classes of one bucket are
compared exactly, in double precision. Bits and tables follow from the number of classes and
from the share of pairs at the threshold that may be missed (``MISS``), so that buckets stay
small up to 2^36 classes: bits grow with their logarithm (beyond, buckets grow, and nothing is lost).

Buckets larger than ``CHUNK`` are cut into chunks that meet in pairs, each pair a group of its
own; a group gives out one sum per vector and one tree of links, never its pairs. A pair that
meets in several tables counts in the first only, which both signatures tell.

Vectors that are NULL, empty, zero, or hold NULL or non-finite components link with nothing, nor
do vectors of different lengths. Repeated rows and ids are rows of their own; extra columns are
ignored. NULL ids take part; a component's id is the smallest id that is not NULL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmart.llm.common import partitions
from txnmart.llm.components import components
from txnmart.scratch import staged, temporary

THRESHOLD = 0.9
MISS = 2e-4
CHUNK = 1024
MOST_BITS = 32  # of a table's signature: enough for 2^36 classes


def plan_tables(classes: int, threshold: float, miss: float, per_bucket: int = 16) -> tuple[int, int]:
    """Bits per table and tables: about ``per_bucket`` unrelated classes to a bucket, and a pair
    at the threshold parted by all tables with probability ``miss``."""
    bits = min(MOST_BITS, max(4, math.ceil(math.log2(max(classes, 2) / per_bucket))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-same)))


def clean_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vec``: the components as bytes of doubles (of floats where the column has
    floats), NULL for vectors that link with nothing."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    float32 = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("embedding"):
                v = v.values if v.is_valid else None
                if v is None or not len(v) or v.null_count:
                    out.append(None)
                    continue
                a = v.to_numpy(zero_copy_only=False).astype("<f4" if float32 else "<f8") + 0.0
                out.append(a.tobytes() if np.isfinite(a).all() and a.any() else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "vec"]
            )

    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, vec binary")


def _unit(rows: list[bytes], dtype: str) -> np.ndarray:
    v = np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1).astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def signatures(v: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """The bucket of each unit vector in each table."""
    planes = np.random.default_rng([seed, v.shape[1]]).standard_normal((tables * bits, v.shape[1]))
    signs = (v @ planes.T > 0).reshape(len(v), tables, bits)
    return (signs.astype(np.int64) << np.arange(bits)).sum(axis=2).astype(np.uint32)


def _trees(near: np.ndarray) -> np.ndarray:
    """The smallest index each row is connected to, for a symmetric matrix of links."""
    label = np.arange(len(near))
    while True:
        best = np.where(near, label[None, :], len(near)).min(axis=1)
        new = np.minimum(label, best)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def compare(nodes, weights, vecs, sigs, halves, table: int, dtype: str, threshold: float):
    """Links of one group. ``halves``: which chunk each row is from (all 0 in a group of one
    chunk). Returns (node, weight of its links counted here) and (node, tree root)."""
    v = _unit(vecs, dtype)
    near = v @ v.T >= threshold
    if halves.any():
        near &= halves[:, None] != halves[None, :]
    np.fill_diagonal(near, False)
    some = np.flatnonzero(near.any(axis=1))
    if not len(some):
        return [], []
    near = near[np.ix_(some, some)]
    s = np.stack([np.frombuffer(sigs[i], "<u4") for i in some])
    # The pair counts here if no earlier table has the two in one bucket.
    counted = near.copy()
    for earlier in range(table):
        counted &= s[:, None, earlier] != s[None, :, earlier]
    w = weights[some]
    sums = counted @ w
    root = nodes[some][_trees(near)]
    return [(int(nodes[i]), int(n)) for i, n in zip(some, sums, strict=True) if n], [
        (int(nodes[i]), int(r)) for i, r in zip(some, root, strict=True) if nodes[i] != r
    ]


def link_classes(classes: DataFrame, dtype: str, threshold: float, miss: float, chunk: int, seed: int):
    """(``node``, ``links``) sums and (``u``, ``v``) tree links of ``classes`` (node, copies, vec)."""
    spark = classes.sparkSession
    bits, tables = plan_tables(classes.count(), threshold, miss)

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for length, part in f.groupby(f["vec"].map(len)):
                got = signatures(_unit(list(part["vec"]), dtype), bits, tables, seed)
                keys = (np.arange(tables, dtype=np.int64) << 40) | got.astype(np.int64)
                yield part.assign(sig=[g.astype("<u4").tobytes() for g in got], keys=list(keys))

    schema = "node long, copies long, vec binary, sig binary, keys array<long>"
    marked = staged(classes.mapInPandas(hashed, schema), "vector-buckets")
    # Vectors of another length never share a bucket.
    each = marked.select(
        "node", "copies", "vec", "sig", F.octet_length("vec").alias("size"), F.posexplode("keys").alias("t", "key")
    )
    bucket = ["size", "key"]
    large = staged(
        each.groupBy(*bucket).agg(F.count("*").alias("n")).where(F.col("n") > chunk), "large-buckets"
    )
    own = F.pmod(F.xxhash64("node"), F.col("m"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("m") - 1),
        lambda o: F.struct(F.least(own, o).alias("a"), F.greatest(own, o).alias("b")),
    )
    dealt = (
        each.join(large.select(*bucket, F.ceil(F.col("n") / chunk).alias("m")), bucket, "left")
        .withColumn("m", F.coalesce("m", F.lit(1).cast("long")))
        .select("node", "copies", "vec", "sig", "t", *bucket, own.alias("own"), F.explode(pairs).alias("p"))
        .select("node", "copies", "vec", "sig", "t", *bucket, "own", "p.a", "p.b")
    )
    group = [*bucket, "a", "b"]

    def match(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(run: pd.DataFrame) -> pd.DataFrame | None:
            if len(run) < 2:
                return None
            halves = (run["own"] != run["a"]).to_numpy() if run["a"].iloc[0] != run["b"].iloc[0] else (
                np.zeros(len(run), bool)
            )
            sums, tree = compare(
                run["node"].to_numpy(), run["copies"].to_numpy(), list(run["vec"]), list(run["sig"]),
                halves, int(run["t"].iloc[0]), dtype, threshold,
            )
            if not sums and not tree:
                return None
            return pd.DataFrame(
                [(u, None, n) for u, n in sums] + [(u, v, 0) for u, v in tree], columns=["u", "v", "links"]
            ).astype({"u": "int64", "v": "Int64", "links": "int64"})

        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            change = (f[group].ne(f[group].shift())).any(axis=1).to_numpy()
            starts = np.flatnonzero(change)
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if b - a > 1 and (out := rows(f.iloc[a:b])) is not None:
                    yield out
            rest = f.iloc[starts[-1] :] if len(starts) else f
        if rest is not None and (out := rows(rest)) is not None:
            yield out

    found = staged(
        dealt.repartition(partitions(spark), *group)
        .sortWithinPartitions(*group)
        .mapInPandas(match, "u long, v long, links long"),
        "vector-links",
    )
    sums = found.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    return sums, found.where("v is not null").select("u", "v")


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, chunk: int = CHUNK, seed: int = 17
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``
    (``vec_id``, ``embedding``)."""
    dtype = "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"
    rows = staged(clean_vectors(vectors), "vectors")
    classes = staged(
        rows.where("vec is not null")
        .groupBy("vec")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
        .select(F.monotonically_increasing_id().alias("node"), "copies", "least", "vec"),
        "vector-classes",
    )
    with temporary(vectors.sparkSession) as block:
        sums, links = link_classes(
            classes.select("node", "copies", "vec"), dtype, threshold, miss, chunk, seed
        )
        of = components(links)
        known = (
            classes.select("node", "copies", "least")
            .join(of, "node", "left")
            .join(sums, "node", "left")
            .withColumn("component", F.coalesce("component", "node"))
        )
        known = block.keep(staged(known, "vector-components"))
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = known.join(smallest, "component").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    by_vec = classes.select("node", F.col("vec").alias("of_vec")).join(by_class, "node")
    out = rows.join(by_vec, F.col("vec") == F.col("of_vec"), "left")
    component = F.when(F.col("vec").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
