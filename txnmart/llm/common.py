"""Small helpers the training-data operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmart.scratch import staged, temporary

# Fixed value: a word is a run of anything but these six ASCII spaces. Python's
# ``bytes.split()`` cuts at exactly the same characters.
WORD = r"[^\x20\x09-\x0D]+"

MASK = (1 << 64) - 1


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let documents go to Python a thousand at a time, a few megabytes, unless the session says how
    many: a batch is held several times over, in the executor and beside it."""
    if spark.conf.get(BATCH) == "10000" and not spark.sparkContext.getConf().contains(BATCH):
        spark.conf.set(BATCH, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, parts: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def apart(df: DataFrame, prefix: str) -> str:
    """A prefix for columns of our own: ``prefix``, made longer while a column of ``df`` begins so."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """One label per document: repeated rows take the larger, NULLs go."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    return known.groupBy("doc_id").agg(F.max(column).alias(column))


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most, picked by a hash of ``key``: the same rows each time.

    Only for fitting a model; ``bound`` is the caller's documented parameter."""
    rows = df.count()
    if rows <= bound:
        return df
    keep = int(bound / rows * (1 << 30))
    return df.where(F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(1 << 30)) < keep)


def bounded_rows(rows: DataFrame, sized: list[str], most_bytes: int) -> dict[str, list]:
    """Rows for fitting on the driver, as columns by ``doc_id``: one row per id, the least by the other
    columns, and ``most_bytes`` of the columns ``sized`` together at most. Documents are taken whole, in
    the order of a hash of their id; one for which there is no room left is passed over.

    Only for a sample whose ids are bounded by the caller: their sizes come to the driver first."""
    rest = [c for c in rows.columns if c != "doc_id"]
    with temporary(rows.sparkSession):
        least = rows.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("r"))
        once = staged(least.select("doc_id", *[F.col(f"r.{c}").alias(c) for c in rest]), "fitting-rows")
        size = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in sized), F.lit(0))
        sizes = once.select("doc_id", size.alias("size"), F.xxhash64(F.lit(7), "doc_id").alias("h")).collect()
        left, taken = most_bytes, []
        for r in sorted(sizes, key=lambda r: (r["h"], str(r["doc_id"]))):
            if r["size"] <= left:
                left -= r["size"]
                taken.append(r["doc_id"])
        if len(taken) < len(sizes):
            once = once.where(F.col("doc_id").isin(taken))
        held = once.toArrow().sort_by("doc_id")
    return {c: held.column(c).to_pylist() for c in rows.columns}


def give_back() -> None:
    """Return to the system what a Python worker has freed: it is used again by later tasks, and
    would keep the most that any of them held."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000, raw: bool = False):
    """Cut Arrow batches so that the texts of a slice hold about ``most`` bytes, or are one
    text. Yields (slice, list of texts, NULL as ''); with ``raw`` the texts as UTF-8 bytes."""

    def texts(part: pa.RecordBatch) -> list:
        values = part.column(column)
        return [t or b"" for t in values.cast(pa.binary()).to_pylist()] if raw else [
            t or "" for t in values.to_pylist()
        ]
    give_back()
    for batch in batches:
        sizes = np.asarray(
            pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
                zero_copy_only=False
            ),
            dtype=np.int64,
        )
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                part = batch.slice(start, i - start)
                yield part, texts(part)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, texts(part)
    give_back()


PIECE = 1 << 20  # bytes of a text that are cut into words at once


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    start = 0
    while start < len(text):
        end = min(start + PIECE, len(text))
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[start:end].split()
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers (multiply and shift, twice)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F), (32, 1)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x
