"""N-gram Jaccard join by vertical partitioning.

A document's set holds its distinct 5-word shingles. Shingles are numbered by a 64-bit hash, and
their range is cut into fragments; every fragment sees its part of every set and counts alone,
and the counts of all fragments are added up per document or per pair.

1. Equal sets are one class; from here on a class is one document.
2. Fragments count, per document, the shingles that any other document has too. A document with
   fewer than 80 % of those can have no partner, and goes no further. (Fragments compare 32 bits
   of what is left of the hash: chance can only let more documents through.)
3. For what is left, fragments count in how many documents a shingle is, which gives the global
   order: rare first. Two documents that link share a shingle among the first ``n - 0.8 n + 1``
   of each in this order.
4. Documents that share such a shingle are candidates. Candidates are first taken as stars
   around the smallest document of a shingle, then between members of components that share
   one; then all pairs whose documents are not yet in one
   component, and whose lengths, positions and sketches allow a link, are taken. Each pair's overlap is
   counted per fragment and summed. Links inside a component change nothing, so large groups of
   near copies are never expanded into pairs, and no link between components is lost.

Counting (2, 3) is done in numpy over blocks of documents: a block sends each fragment one row, and
a shingle at most once, so a shingle that a third of all documents has is no larger than others.

NULL texts and texts without words have no set and link with nothing. A text of fewer than five
words is one shingle. Repeated rows are documents of their own; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import apart, mix64, partitions, slices
from txnmart.llm.components import components
from txnmart.llm.fragments import (
    distinct_entries,
    fragment_of,
    fragment_rows,
    joined,
    packed,
    times,
    unpacked,
)
from txnmart.scratch import staged, temporary

SHINGLE = 5
PERCENT = 80
BRIDGE_ROUNDS = 4
SEGMENTS = 8  # by the first three bits
SKETCH = 16  # longs of a set's sketch: its shingles' parities in 1024 buckets


def shingle_sets(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, ascending, end to end; and their numbers."""
    code: dict[bytes, int] = {}
    parts: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    runs = []
    for text in texts:
        words = text.encode().lower().split()
        runs.append(np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words)))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in code), np.uint64, len(code))
    factor = np.uint64(0x9E3779B97F4A7C15)
    for i, run in enumerate(runs):
        n = len(run)
        if not n:
            continue
        width = min(n, size)
        h = hashes[run]
        total = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            total = mix64(total * factor + h[k : n - width + 1 + k])
        found = np.unique(total)
        counts[i] = len(found)
        parts.append(found)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), counts


def _shared_counts(docs: DataFrame, fragments: int) -> DataFrame:
    """``node``, ``doc_id``, ``th``, ``n`` (set size), ``digest``, and ``shared``: how many of the
    set's shingles other documents have too (or seem to)."""
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    info = ["node", "doc_id", "th", "sizes", "digests", "local"]
    info_schema = (
        f"node array<long>, doc_id array<{doc_kind}>, th array<long>, sizes array<long>, "
        "digests array<binary>, local array<long>"
    )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for part, held in slices(batches, "text"):
            hashes, counts = shingle_sets(held)
            firsts = np.cumsum(counts) - counts
            digests = [
                xxhash.xxh3_128_digest(hashes[a : a + n].tobytes()) if n else None
                for a, n in zip(firsts, counts, strict=True)
            ]
            entries, cells, again = distinct_entries(hashes, counts)
            owner = np.repeat(np.arange(len(counts)), counts)
            local = np.bincount(owner[again], minlength=len(counts))
            rows = [
                (f, packed(of, len(counts)), held)
                for f, of, held in fragment_rows(entries, cells, fragments, "<u4")
            ]
            # One more row bears what is known of the block's documents.
            rows.append((block % fragments, None, None))
            once = lambda v: [*[None] * (len(rows) - 1), v]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(rows), pa.int64()),
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[1] for r in rows], pa.binary()),
                    pa.array([r[2] for r in rows], pa.binary()),
                    *[pa.array(once(part.column(c)), pa.list_(part.column(c).type)) for c in info[:3]],
                    pa.array(once(counts), pa.list_(pa.int64())),
                    pa.array(once(digests), pa.list_(pa.binary())),
                    pa.array(once(local), pa.list_(pa.int64())),
                ],
                names=["block", "fragment", "owners", "held", *info],
            )
            block += 1

    def count(f: pd.DataFrame) -> pd.DataFrame:
        """``owners`` and ``held`` become the documents of a block that have shared shingles here, and
        how many each."""
        bearers = f[f["held"].isna()]
        f = f[f["held"].notna()]
        ends = np.cumsum([0, *(len(h) // 4 for h in f["held"])])
        again = times(joined(f["held"], "<u4")) > 1
        rows = []
        for block, owners, a, b in zip(f["block"], f["owners"], ends[:-1], ends[1:], strict=True):
            docs, many = np.unique(unpacked(owners, b - a)[again[a:b]], return_counts=True)
            if len(docs):
                rows.append((block, docs.astype("<u4").tobytes(), many.astype("<u4").tobytes()))
        rows = [(*r, *[None] * len(info)) for r in rows]
        counted = pd.DataFrame(rows, columns=["block", "owners", "held", *info], dtype=object)
        out = pd.concat([bearers[["block", "owners", "held", *info]], counted])
        return out.astype({"block": "int64"})

    def add(f: pd.DataFrame) -> pd.DataFrame:
        bearer = f[f["sizes"].notna()].iloc[0]
        f = f[f["held"].notna()]
        total = np.bincount(
            joined(f["owners"], "<u4"), joined(f["held"], "<u4"), minlength=len(bearer["sizes"]) + 1
        ).astype(np.int64)[:-1]
        out = pd.DataFrame(
            {"node": bearer["node"], "th": bearer["th"], "n": bearer["sizes"], "shared": total + bearer["local"]}
        )
        out["doc_id"] = pd.Series(list(bearer["doc_id"]), dtype=object)
        out["digest"] = pd.Series(list(bearer["digests"]), dtype=object)
        return out.astype({"doc_id": "Int64"}) if doc_kind in ("bigint", "int") else out

    sent = docs.select("node", "doc_id", "th", "text").mapInArrow(
        send, f"block long, fragment int, owners binary, held binary, {info_schema}"
    )
    counted = sent.groupBy("fragment").applyInPandas(
        count, f"block long, owners binary, held binary, {info_schema}"
    )
    return counted.groupBy("block").applyInPandas(
        add, f"node long, th long, n long, shared long, doc_id {doc_kind}, digest binary"
    )


def _ordered_sets(texts: DataFrame, fragments: int) -> DataFrame:
    """``node``, ``n``, ``prefix`` (shingle and position in the global order, without shingles
    that no other document has), ``segments`` (the set, cut by hash range) and ``sketch``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for part, held in slices(batches, "text"):
            hashes, counts = shingle_sets(held)
            entries, documents = np.unique(hashes, return_counts=True)  # ascending, so by fragment
            of = fragment_of(entries, fragments)
            cuts = np.searchsorted(of, np.arange(fragments + 1))
            sent = [
                (f, entries[a:b].astype("<u8").tobytes(), documents[a:b].astype("<u4").tobytes())
                for f, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                if b > a
            ]
            # The block's own sets take the way around the fragments, as fragment -1.
            nodes = part.column("node").to_numpy().astype("<i8").tobytes()
            sent.append((-1, hashes.astype("<u8").tobytes(), nodes + counts.astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(sent), pa.int64()),
                    pa.array([s[0] for s in sent], pa.int32()),
                    pa.array([s[1] for s in sent], pa.binary()),
                    pa.array([s[2] for s in sent], pa.binary()),
                ],
                names=["block", "fragment", "held", "more"],
            )
            block += 1

    schema = "block long, fragment int, held binary, more binary"
    sent = staged(texts.select("node", "text").mapInArrow(send, schema), "shingle-blocks")

    def weigh(f: pd.DataFrame) -> pd.DataFrame:
        """``more`` becomes a code of how many documents have the shingle."""
        _, number = np.unique(joined(f["held"], "<u8"), return_inverse=True)
        documents = np.bincount(number, joined(f["more"], "<u4"))[number]
        code = np.minimum(255, 4 * np.log2(np.maximum(documents, 1))).astype(np.uint8)
        ends = np.cumsum([len(h) // 8 for h in f["held"]])
        starts = np.append(0, ends[:-1])
        out = f[["block", "fragment", "held"]].copy()
        out["more"] = [code[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        return out

    weighed = sent.where("fragment >= 0").groupBy("fragment").applyInPandas(weigh, schema)

    def collect(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("fragment")
        own, sent_parts = f.iloc[0], f.iloc[1:]
        numbers = np.frombuffer(own["more"], "<i8")
        nodes, n = numbers[: len(numbers) // 2], numbers[len(numbers) // 2 :]
        value = np.frombuffer(own["held"], "<u8")
        at = np.searchsorted(joined(sent_parts["held"], "<u8"), value)
        code = joined(sent_parts["more"], np.uint8)[at]
        order = np.lexsort((value, code, np.repeat(np.arange(len(n)), n)))
        ends = np.cumsum(n)
        rows = []
        for node, size, end in zip(nodes.tolist(), n.tolist(), ends.tolist(), strict=True):
            ranked = order[end - size : end]
            first = ranked[: size - -(-PERCENT * size // 100) + 1]
            some = np.flatnonzero(code[first] > 0)
            prefix = [
                {"token": t, "pos": p}
                for t, p in zip(value[first[some]].view(np.int64).tolist(), some.tolist(), strict=True)
            ]
            whole = value[end - size : end]  # ascending
            cuts = np.searchsorted(whole >> np.uint64(61), np.arange(SEGMENTS + 1))
            parts = [whole[a:b].view(np.int64) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            rows.append((node, size, prefix, parts, sketch(whole)))
        return pd.DataFrame(rows, columns=["node", "n", "prefix", "segments", "sketch"])

    return (
        weighed.unionByName(sent.where("fragment < 0"))
        .groupBy("block")
        .applyInPandas(
            collect,
            "node long, n long, prefix array<struct<token: long, pos: int>>, segments array<array<long>>, "
            "sketch array<long>",
        )
    )


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Whether each of 1024 buckets holds an odd number of the hashes, as bits. Where two sets'
    sketches differ they differ in one shingle at least."""
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) & 64 * SKETCH - 1, minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _enough(overlap: Column, a: Column, b: Column) -> Column:
    return 100 * overlap >= PERCENT * (a + b - overlap)


def _common_at_most(x: str, y: str) -> Column:
    """No more shingles than this are in both sets, by their sizes and sketches."""
    apart = sum(
        F.bit_count(F.col(f"{x}.sketch")[i].bitwiseXOR(F.col(f"{y}.sketch")[i])) for i in range(SKETCH)
    )
    return F.floor((F.col(f"{x}.n") + F.col(f"{y}.n") - apart) / 2)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: overlaps are counted per segment and summed."""
    parts = sets.select("node", "n", F.posexplode("segments").alias("part", "held"))
    side = lambda s: parts.select(*[F.col(c).alias(f"{c}_{s}") for c in parts.columns])
    counted = (
        pairs.join(side("b"), F.col("b") == F.col("node_b"))
        .join(side("a"), (F.col("a") == F.col("node_a")) & (F.col("part_a") == F.col("part_b")))
        .where(_enough(F.least("n_a", "n_b"), F.col("n_a"), F.col("n_b")))
        .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("held_a", "held_b")).alias("common"))
    )
    total = counted.groupBy("a", "b", "n_a", "n_b").agg(F.sum("common").alias("common"))
    return total.where(_enough(F.col("common"), F.col("n_a"), F.col("n_b"))).select(
        F.col("a").alias("u"), F.col("b").alias("v")
    )


def _linked(sets: DataFrame) -> DataFrame:
    """``node`` and ``component`` of the documents of ``sets`` that have a link."""
    entries = staged(
        sets.select("node", "n", F.explode("prefix").alias("p")).select("node", "n", "p.token", "p.pos"),
        "prefixes",
    )
    hubs = staged(
        entries.groupBy("token").agg(F.min("node").alias("hub"), F.count("*").alias("docs")).where("docs > 1"),
        "hubs",
    ).drop("docs")
    star = entries.join(hubs, "token").where("node != hub")
    nearest = star.groupBy("node").agg(F.min("hub").alias("a")).select("a", F.col("node").alias("b"))
    links = staged(_verified(nearest, sets), "jaccard-links")
    of = components(links)

    def labelled(of: DataFrame) -> DataFrame:
        return entries.join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))

    hub_of = hubs.join(of, F.col("hub") == F.col("node"), "left").select(
        "token", "hub", F.coalesce("component", "hub").alias("hub_component")
    )
    others = (
        labelled(of)
        .join(hub_of, "token")
        .where("component != hub_component")
        .select(F.col("hub").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    of = _extended(of, staged(_verified(others, sets), "jaccard-links"))
    # Components that share shingles but not yet a link meet through one member each, another
    # one for every shingle, until that finds nothing more. It only spares the last step work.
    for _ in range(BRIDGE_ROUNDS):
        found = staged(_verified(_bridges(labelled(of)), sets), "jaccard-links")
        if not found.take(1):
            break
        of = _extended(of, found)
    # What is left: shingles of several components. A pair is taken at its first shared one.
    lab = labelled(of)
    ends = lab.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    # Written, so that the join is between two plain shuffles and a hot shingle can be split.
    open_ = staged(ends.where("low != high").select("token"), "open-shingles")
    left = lab.join(open_, "token")
    order = sets.select(F.col("node").alias("of_node"), "prefix", "sketch")
    ahead = F.transform(F.filter("prefix", lambda p: p["pos"] < F.col("pos")), lambda p: p["token"])
    one = staged(
        left.join(order, F.col("node") == F.col("of_node")).select(
            "token", "node", "n", "pos", "component", "sketch", ahead.alias("ahead")
        ),
        "labelled-prefixes",
    )
    x, y = one.alias("x"), one.alias("y")
    bound = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    rest = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.component") < F.col("y.component"))
        & _enough(F.least(bound, _common_at_most("x", "y")), F.col("x.n"), F.col("y.n"))
        & ~F.arrays_overlap("x.ahead", "y.ahead"),
    ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return _extended(of, staged(_verified(rest, sets), "jaccard-links"))


def _extended(of: DataFrame, links: DataFrame) -> DataFrame:
    """``of`` (node, component) after more links. Only what they join is worked on again: the
    components of the components they meet."""
    ends = links.select("u", "v")
    for side in ("u", "v"):
        label = of.select(F.col("node").alias("of_node"), F.col("component").alias("label"))
        ends = ends.join(label, F.col(side) == F.col("of_node"), "left").withColumn(
            f"of_{side}", F.coalesce("label", side)
        )
        ends = ends.drop("of_node", "label")
    ends = staged(ends, "component-links")
    joined = components(ends.select(F.col("of_u").alias("u"), F.col("of_v").alias("v")))
    joined = joined.select(F.col("node").alias("of_node"), F.col("component").alias("to"))
    # Documents without a link so far are their own component.
    alone = ends.where("u = of_u").select(F.col("u").alias("node"))
    alone = alone.unionAll(ends.where("v = of_v").select(F.col("v").alias("node"))).distinct()
    known = of.unionAll(alone.join(of, "node", "left_anti").select("node", F.col("node").alias("component")))
    moved = known.join(joined, F.col("component") == F.col("of_node"), "left")
    return staged(moved.select("node", F.coalesce("to", "component").alias("component")), "components")


def _bridges(entries: DataFrame) -> DataFrame:
    """Pairs of documents of different components: for each shingle a member of its first and of
    its last component, with a member of every other one. Members are picked by a hash."""
    pick = F.min_by("node", F.xxhash64("token", "node")).alias("node")
    members = entries.groupBy("token", "component").agg(pick)
    member = F.struct("component", "node")
    ends = members.groupBy("token").agg(F.min(member).alias("low"), F.max(member).alias("high"))
    ends = staged(ends.where("low.component != high.component"), "shingle-ends")
    met = members.join(ends, "token")
    ways = [
        met.where(F.col("component") != F.col(f"{end}.component")).select(
            F.least("node", f"{end}.node").alias("a"), F.greatest("node", f"{end}.node").alias("b")
        )
        for end in ("low", "high")
    ]
    return ways[0].unionAll(ways[1]).distinct()


def near_duplicates(docs: DataFrame, node: Column | None = None) -> DataFrame:
    """``node``, ``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` (the first row of its
    component by id) for every row of ``docs`` (``doc_id``, ``text``). ``node`` numbers the rows;
    without it they are numbered here."""
    spark = docs.sparkSession
    numbered = docs.select(
        (node if node is not None else F.monotonically_increasing_id()).alias("node"),
        "doc_id",
        F.xxhash64("text").alias("th"),
        "text",
    )
    with temporary(spark) as block:
        return block.keep(staged(_grouped(docs, numbered), "near-duplicates"))


def _grouped(docs: DataFrame, numbered: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    fragments = 4 * partitions(spark)
    rows = staged(_shared_counts(numbered, fragments), "shingle-counts")
    classes = staged(
        rows.where("n > 0")
        .groupBy("digest")
        .agg(
            F.min(F.struct("doc_id", "node", "th", "n", "shared")).alias("r"),
            F.min("doc_id").alias("least_id"),  # r has a NULL id if any row of the class has
        )
        .select("digest", "r.*", "least_id"),
        "set-classes",
    )
    maybe = classes.where(100 * F.col("shared") >= PERCENT * F.col("n")).select(
        F.col("node").alias("of_node"), F.col("doc_id").alias("of_id"), F.col("th").alias("of_th")
    )
    texts = (
        docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
        .join(maybe, (F.col("th") == F.col("of_th")) & F.col("doc_id").eqNullSafe(F.col("of_id")))
        .select(F.col("of_node").alias("node"), "text")
        .dropDuplicates(["node"])
    )
    with temporary(spark) as block:
        sets = block.keep(staged(_ordered_sets(texts, fragments), "shingle-sets"))
    with temporary(spark) as block:
        of = block.keep(_linked(sets))
    grouped = staged(
        classes.join(of, "node", "left").select(
            "digest", "doc_id", "least_id", "node", F.coalesce("component", "node").alias("component")
        ),
        "set-components",
    )
    first = grouped.groupBy("component").agg(
        F.min("least_id").alias("component_id"), F.min(F.struct("doc_id", "node")).alias("first")
    )
    by_digest = grouped.select(F.col("digest").alias("of_digest"), "component").join(first, "component")
    out = rows.join(by_digest, F.col("digest") == F.col("of_digest"), "left")
    return out.select(
        "node",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col("node") == F.col("first.node"))).alias("kept"),
    )


def jaccard_report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row, the first by id, of each group; rows without a set all stay."""
    node = apart(docs, "_node")
    held = staged(docs.withColumn(node, F.monotonically_increasing_id()), "dedup-docs")
    keep = near_duplicates(held, F.col(node)).where("kept").select(F.col("node").alias(node))
    return held.join(keep, node, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
