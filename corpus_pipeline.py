"""From raw documents to packed training sequences, in five stages.

Each stage is written as parquet to the scratch folder and read again by the next one, so a lost
executor repeats tasks of one stage only. ``STAGES`` lists (name, function); a function takes
(spark, docs, sf_dir) and returns what it keeps, with the columns of ``documents`` in all stages
but the last. Columns beside doc_id, text, lang, source and n_chars stay as they are, whatever their
names; an empty table gives an empty table in every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnmart.llm import jaccard_join, mixing, packing, secrets, toxicity
from txnmart.llm.common import table
from txnmart.scratch import staged, temporary

# Three stages are learned, hashed or drawn: no SQL can state the result.
ORACLE_SQL: str | None = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores as toxic go. It learns from the labels of ``sf_dir``; without
    labels, or with one class only, all are scored alike (0 without labels). NULL and empty texts
    score the share of toxic labels, very long ones their worst passage; NULL ids and repeated rows by their text."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, one row of it (a NULL id
    comes first). Rows without words (NULL, empty or blank texts) all stay."""
    return jaccard_join.without_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; reported spans are masked, and ``n_chars`` follows. A text without spans
    stays as it is, NULL and empty too; repeated rows are masked alike."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their targets: a document's row for each pass that takes words of it. A NULL
    source is one by itself; NULL, empty and blank texts have no words and are never taken; repeated
    rows and ids are documents of their own, and no document is taken more than twice."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences, with their token ids. A NULL or empty text is its end token; a text
    longer than a sequence is cut; NULL and repeated ids keep their pieces apart by sequence."""
    return packing.pack(docs, packing.default_tokenizer)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mix", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with temporary(spark) as all_stages:
        for name, stage in STAGES:
            with temporary(spark) as block:
                docs = block.keep(staged(stage(spark, docs, sf_dir), f"stage-{name}"))
        return all_stages.keep(docs)
