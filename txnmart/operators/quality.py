"""Validation: schema, CSV structure, business rules and referential integrity."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmart.operators.members import apart
from txnmart.schemas import CORRUPT, ID, VALID
from txnmart.scratch import staged

# The character decoders put in place of undecodable bytes, and an email's shape.
REPLACEMENT = "�"
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

Rules = Mapping[str, Column]


def schema_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per expected or surplus column: declared types, status, and how many of
    its values are NULL or do not cast to the expected type. One pass over the data."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in expected.fields}

    def facts(name: str) -> Column:
        if name not in actual:
            status = "missing"
        elif name not in wanted:
            status = "unexpected"
        else:
            status = "ok" if actual[name] == wanted[name] else "type_differs"
        nulls = failures = F.lit(None).cast("long")
        if name in actual:
            nulls = F.count_if(F.col(name).isNull())
        if name in actual and name in wanted:
            failures = F.count_if(
                F.col(name).isNotNull() & F.col(name).try_cast(wanted[name]).isNull()
            )
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(wanted[name].simpleString() if name in wanted else None)
            .cast("string")
            .alias("expected_type"),
            F.lit(actual[name].simpleString() if name in actual else None)
            .cast("string")
            .alias("actual_type"),
            F.lit(status).alias("status"),
            nulls.alias("null_rows"),
            failures.alias("cast_failures"),
        )

    names = [*wanted, *(n for n in actual if n not in wanted)]
    return df.agg(F.array(*[facts(n) for n in names]).alias("facts")).select(
        F.inline("facts")
    )


def csv_verdict(scan: DataFrame) -> DataFrame:
    """Tag each line of a CSV scan ``good``, ``malformed`` or ``encoding``.

    A scan that looked at the bytes (``check_bytes``) says itself which lines are not UTF-8. In
    another, the character that decoders put in place of broken bytes tells, which a right file
    may hold too."""
    texts = [f.name for f in scan.schema.fields if isinstance(f.dataType, T.StringType)]
    if VALID in scan.columns:
        undecodable = ~F.col(VALID)
    else:
        undecodable = reduce(
            Column.__or__,
            [F.coalesce(F.contains(F.col(c), F.lit(REPLACEMENT)), F.lit(False)) for c in texts],
        )
    return scan.withColumn(
        "verdict",
        F.when(undecodable, "encoding")
        .when(F.col(CORRUPT).isNotNull(), "malformed")
        .otherwise("good"),
    )


def transaction_rules(first_day: str, last_day: str) -> dict[str, Column]:
    """Row rules by name: true where the row passes."""
    day = F.col("transaction_date")
    return {
        "id_present": F.col(ID).isNotNull(),
        "amount_positive": F.col("transaction_amount") > 0,
        "date_in_range": day.between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")),
        "email_shape": F.col("customer_email").rlike(EMAIL),
    }


def tag_violations(df: DataFrame, rules: Rules) -> DataFrame:
    """Add ``violations``: the names of the rules a row breaks, in rule order, with
    ``id_unique`` last. A rule that comes out NULL is broken.

    Ids are counted with a combine before the shuffle, the repeated ones are written out,
    and the rows that may have one (:func:`apart`) look them up: a hot id is one row on the
    lookup side, and its rows are split over tasks by adaptive execution. ``df`` is read up to
    three times and should be a table.
    """
    repeated = (
        df.where(F.col(ID).isNotNull())
        .groupBy(ID)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(ID, F.lit(True).alias("_repeated"))
    )
    passed = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    passed["id_unique"] = F.col("_repeated").isNull()
    broken = F.array_compact(
        F.array(*[F.when(~ok, F.lit(name)) for name, ok in passed.items()])
    )
    seen = Observation()
    ids = staged(repeated.observe(seen, F.count(ID).alias("ids")), "repeated-ids")
    may_repeat, others = apart(df, ids, ID, seen.get["ids"])
    looked_up = may_repeat.join(ids, ID, "left")
    if others is not None:
        unrepeated = others.withColumn("_repeated", F.lit(None).cast("boolean"))
        looked_up = looked_up.unionByName(unrepeated)
    return looked_up.withColumn("violations", broken).select(*df.columns, "violations")


def split_by_rules(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows with their ``violations``)."""
    clean = F.size("violations") == 0
    return tagged.where(clean).drop("violations"), tagged.where(~clean)


def rule_summary(tagged: DataFrame, names: list[str]) -> DataFrame:
    """Per rule, the rows checked and the rows that break it; one pass."""
    per_rule = [
        F.struct(
            F.lit(name).alias("rule"),
            F.count(F.lit(1)).alias("checked"),
            F.count_if(F.array_contains("violations", name)).alias("broken"),
        )
        for name in names
    ]
    return tagged.agg(F.array(*per_rule).alias("rules")).select(F.inline("rules"))


def fk_orphans(fact: DataFrame, references: Mapping[str, DataFrame]) -> DataFrame:
    """Per foreign key: rows pointing at no dimension row, and rows with no id at all.

    ``references`` maps the key column to the dimension that must hold it. The fact is
    counted per id before it is joined, so the join sees each id once.
    """

    def one(column: str, dim: DataFrame) -> DataFrame:
        per_id = fact.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        known = dim.select(F.col(column).alias("known_id"), F.lit(True).alias("known"))
        looked_up = per_id.join(known, F.col(column) == F.col("known_id"), "left")
        orphan = F.col(column).isNotNull() & F.col("known").isNull()
        total = [
            F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).alias(name)
            for name, test in [
                ("orphan_rows", orphan),
                ("unresolved_rows", F.col(column).isNull()),
            ]
        ]
        return looked_up.agg(*total).select(F.lit(column).alias("foreign_key"), "*")

    return reduce(DataFrame.unionAll, [one(c, d) for c, d in references.items()])
