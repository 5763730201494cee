"""The three dimensions, built whole or extended by the members a batch adds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnmart.functions.cleaning import date_parts
from txnmart.operators.keys import dense_key


def first_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """The least ``value`` per ``key``; a NULL value is least and NULL is one key.

    Distinct pairs are hashed down first, before the shuffle and after. The rank filter
    then keeps one row per key in each task before its shuffle too, so a key held by a
    third of all rows, or with a million values, reaches no task as a whole.
    """
    first = Window.partitionBy(key).orderBy(value)
    ranked = df.select(value, key).distinct().withColumn("_n", F.row_number().over(first))
    return ranked.where("_n = 1").drop("_n")


def customer_members(silver: DataFrame) -> DataFrame:
    return first_per_key(silver, "customer_email", "customer_name")


def merchant_members(silver: DataFrame) -> DataFrame:
    return silver.select("merchant_name").distinct()


def date_members(silver: DataFrame) -> DataFrame:
    return silver.select("transaction_date").distinct()


@dataclass(frozen=True)
class Dimension:
    """How one dimension is keyed: business key, id column and the distinct members."""

    table: str
    key: str
    id_col: str
    id_type: str = "bigint"

    def members(self, silver: DataFrame) -> DataFrame:
        return MEMBERS[self.table](silver)

    def build(self, silver: DataFrame) -> DataFrame:
        """All members with ids 1..n in key order."""
        return self._finish(dense_key(self.members(silver), self.key, self.id_col, id_type=self.id_type))

    def additions(self, silver: DataFrame, existing: DataFrame) -> DataFrame:
        """Members not in ``existing`` (NULL matches NULL), numbered after its last id.
        Members already there keep their rows and ids."""
        known = existing.select(F.col(self.key).alias("known_key"))
        new = self.members(silver).join(
            known, F.col(self.key).eqNullSafe(F.col("known_key")), "left_anti"
        )
        last = existing.agg(F.max(self.id_col)).first()[0] or 0
        return self._finish(dense_key(new, self.key, self.id_col, start=last, id_type=self.id_type))

    def _finish(self, keyed: DataFrame) -> DataFrame:
        return date_parts(keyed) if self.table == "dim_date" else keyed


MEMBERS = {
    "dim_customer": customer_members,
    "dim_merchant": merchant_members,
    "dim_date": date_members,
}
CUSTOMER = Dimension("dim_customer", "customer_email", "customer_id")
MERCHANT = Dimension("dim_merchant", "merchant_name", "merchant_id")
DATE = Dimension("dim_date", "transaction_date", "date_id")
DIMENSIONS = (CUSTOMER, MERCHANT, DATE)
