"""File readers with fixed schemas: no inference pass, no type drift between files."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmart.schemas import CORRUPT, RAW_CSV, TRANSACTION, VALID

# Quotes inside a quoted field are doubled, as common CSV writers do.
CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "quote": '"',
    "escape": '"',
}
RECURSIVE = {"recursiveFileLookup": "true"}
# No file is cut, and none shares a partition: a file counts as more than a partition holds.
WHOLE_FILES = {
    "spark.sql.files.maxPartitionBytes": str(1 << 50),
    "spark.sql.files.openCostInBytes": str(1 << 50),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


class HeaderMismatch(ValueError):
    """A CSV file whose header does not name exactly the expected columns."""


def csv_scan(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_CSV,
    check_bytes: bool = False,
) -> DataFrame:
    """Transactions from CSV, columns taken by the names in each file's header.

    Files may order their columns differently; a file that lacks a column or has an unknown
    or repeated one is refused (:class:`HeaderMismatch`). A field that does not parse is NULL
    and the whole line is kept in ``_corrupt_record``. Lines never span rows, so big files
    split. With ``check_bytes`` a column ``_valid_utf8`` says whether the text of the line is
    UTF-8, byte for byte."""
    by_header = headers(spark, path)
    names = [n for n in schema.fieldNames() if n != CORRUPT]
    for header, files in by_header.items():
        if problem := header_problem(header, names):
            raise HeaderMismatch(f"{files[0]}: {problem}")
    scans = []
    for header, files in by_header.items():
        fields = [schema[n] for n in header] + [f for f in schema.fields if f.name == CORRUPT]
        # One order for all files, the usual case: let Spark list them.
        found = path if len(by_header) == 1 else files
        reader = spark.read.schema(T.StructType(fields)).options(**CSV_OPTIONS, **RECURSIVE)
        if check_bytes:
            scans.append(_with_bytes(reader.option("encoding", "ISO-8859-1").csv(found), schema))
        else:
            scans.append(reader.csv(found).select(schema.fieldNames()))
    if not scans:
        fields = [*schema.fields, *([T.StructField(VALID, T.BooleanType())] if check_bytes else [])]
        return spark.createDataFrame([], T.StructType(fields))
    return reduce(DataFrame.unionAll, scans)


def _with_bytes(scan: DataFrame, schema: T.StructType) -> DataFrame:
    """A scan that took each byte for a character, its texts read as UTF-8 instead."""
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    raw = {c: F.encode(c, "ISO-8859-1").cast("string") for c in texts}
    valid = reduce(Column.__and__, [F.coalesce(F.is_valid_utf8(r), F.lit(True)) for r in raw.values()])
    columns = [F.make_valid_utf8(raw[c]).alias(c) if c in raw else F.col(c) for c in schema.fieldNames()]
    return scan.select(*columns, valid.alias(VALID))


def header_problem(header: tuple[str, ...], names: list[str]) -> str | None:
    """What is wrong with a header, or None."""
    missing = [n for n in names if n not in header]
    unknown = [n for n in header if n not in names]
    repeated = sorted({n for n in header if header.count(n) > 1})
    said = [
        f"{what} {', '.join(columns)}"
        for what, columns in (("missing", missing), ("unknown", unknown), ("repeated", repeated))
        if columns
    ]
    return "; ".join(said) or None


def headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The CSV files below a path or pattern, or of a list of files, by the column names of their
    header; hidden files, markers and files without a line are left out.

    Spark lists the files, and a task per file reads the first line and stops there, so the driver
    opens none; it gets each header once, with the files that have it."""
    if isinstance(path, str) and not path_exists(spark, path) or not path:
        return {}
    # A session of its own, whose splits are whole files, each by itself.
    own = spark.newSession()
    for name, value in WHOLE_FILES.items():
        own.conf.set(name, value)
    lines = own.read.options(**RECURSIVE).text(path)
    # Bytes, since a line need not be UTF-8.
    lines = lines.select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("file"))
    found = (
        lines.mapInArrow(_first_lines, "value binary, file string")
        .groupBy("value")
        .agg(F.array_sort(F.collect_list("file")).alias("files"))
        .collect()
    )
    out: dict[tuple[str, ...], list[str]] = {}
    for line, files in sorted((bytes(r["value"]), r["files"]) for r in found):
        text = line.decode(errors="replace").removeprefix("\ufeff")
        names = tuple(n.strip() for n in next(csv.reader([text])))
        out.setdefault(names, []).extend(unquote(f) for f in files)
    return {names: sorted(files) for names, files in out.items()}


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of a file that is not blank; nothing is read beyond its batch."""
    for batch in batches:
        for i, line in enumerate(batch.column("value").to_pylist()):
            if line.strip():
                yield batch.slice(i, 1)
                return


def parquet_scan(
    spark: SparkSession, path: str, schema: T.StructType | None = TRANSACTION
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or a pattern) names anything, on whatever file system it is."""
    return bool(matching_paths(spark, path))


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """What a path or pattern names."""
    fs, hadoop = _file_system(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(hadoop) or ()]


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that must not exist yet."""
    fs, hadoop = _file_system(spark, path)
    stream = fs.create(hadoop, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


ROWS_PER_FILE = 1_000_000  # of compressed CSV, which readers cannot split


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", compression: str = "none") -> None:
    """CSV that :func:`csv_scan` reads back unchanged, padding included, if it is UTF-8. Compressed
    files are kept short enough for a task each."""
    (
        df.write.options(
            header="true",
            encoding=encoding,
            compression=compression,
            # Of gzip alone: a fifth more bytes for less work.
            **{"zlib.compress.level": "BEST_SPEED"},
            maxRecordsPerFile="0" if compression == "none" else str(ROWS_PER_FILE),
            quote='"',
            escape='"',
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
        ).csv(path)
    )
