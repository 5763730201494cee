"""The plans Spark makes of the operators: what is scanned, shuffled and split."""

import re

import pytest
from helpers import plan, settings
from pyspark.sql import functions as F

import txnmart.operators.delta as delta
from txnmart.operators import dims, facts, history, quality, reports
from txnmart.operators.keys import dense_key
from txnmart.scratch import staged

NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}
# Sizes at which adaptive execution sees the test's hot key as it would a real one.
TINY_SKEW = {
    **NO_BROADCAST,
    "spark__sql__shuffle__partitions": "8",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


ROWS = 300_000


@pytest.fixture(scope="module")
def feed(spark):
    """Transactions of which a third have one id, email, name and merchant, and a third
    NULL ids, names and emails."""
    i, kind = F.col("id"), F.col("id") % 3
    return staged(
        spark.range(0, ROWS, 1, 6).select(
            F.when(kind == 0, 0).when(kind == 1, i).alias("transaction_id"),
            F.when(kind == 0, F.lit("HOT"))
            .when(kind == 1, F.concat(F.lit("C"), i % 900))
            .alias("customer_name"),
            F.when(kind == 0, F.lit("hot@x.org"))
            .when(kind == 1, F.concat(F.lit("c"), i % 900, F.lit("@x.org")))
            .alias("customer_email"),
            F.when(kind == 0, F.lit("HOT")).otherwise(F.concat(F.lit("M"), i % 500)).alias("merchant_name"),
            (F.abs(F.hash(i)) % 100_000 / 100 + 1).alias("transaction_amount"),
            F.date_add(F.lit("2024-01-01").cast("date"), (i % 300).cast("int")).alias("transaction_date"),
        ),
        "hot-feed",
    )


@pytest.fixture(scope="module")
def star(feed):
    return [staged(d.build(feed), d.table) for d in dims.DIMENSIONS]


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_delta_scans_only_the_keys_in_range_of_the_existing_table(spark, feed, monkeypatch):
    seen = []
    real = delta.staged
    monkeypatch.setattr(delta, "staged", lambda df, label: seen.append(df) or real(df, label))
    delta.new_rows(feed.where("transaction_id between 100 and 200"), feed)
    with settings(spark, **NO_BROADCAST):
        text = plan(seen[1])
    scans = re.findall(r"ReadSchema: (.*)", text)
    assert scans and all(s == "struct<transaction_id:bigint>" for s in scans)
    assert "GreaterThanOrEqual(transaction_id,100)" in text
    assert "LessThanOrEqual(transaction_id,199)" in text


def test_small_batch_does_not_shuffle_the_existing_table(spark, feed, monkeypatch):
    seen = []
    real = delta.staged
    monkeypatch.setattr(delta, "staged", lambda df, label: seen.append(df) or real(df, label))
    delta.new_rows(feed.where("transaction_id < 200"), feed)
    text = plan(seen[1])
    # The semi join sits below the distinct: only its matches are shuffled.
    assert text.index("HashAggregate") < text.index("BroadcastHashJoin")


def test_hot_and_null_keys_of_a_batch_are_split(spark, feed):
    with settings(spark, **TINY_SKEW):
        df = delta.new_rows(feed, feed.where(f"transaction_id < {ROWS // 2}"))
        assert "SortMergeJoin(skew=true)" in final_plan(df)
        assert df.count() == ROWS // 2  # NULL ids and the later half of the unique ones


def test_a_hot_fresh_key_of_a_redelivery_is_split(spark, feed):
    with settings(spark, **TINY_SKEW):
        df = delta.new_rows(feed, feed.where("transaction_id > 3"))
        assert "SortMergeJoin(skew=true)" in final_plan(df)
        # The hot id, the one unique id below 4, and the rows without an id.
        assert df.count() == ROWS // 3 * 2 + 1


def test_few_new_rows_are_found_without_shuffling_the_batch(spark, feed):
    text = plan(delta.new_rows(feed, feed.where(f"transaction_id < {ROWS - 90}")))
    assert "hashpartitioning" not in text and "LeftSemi" in text


def test_hot_members_are_split_in_the_fact_joins(spark, feed, star):
    with settings(spark, **TINY_SKEW):
        df = facts.fact_transactions(feed, *star, "2026-01-01 00:00:00")
        text = final_plan(df)
        assert text.count("SortMergeJoin(skew=true)") >= 2
        assert df.count() == ROWS
        assert df.where("customer_id is null").count() == ROWS // 3


def test_hot_ids_are_split_in_the_rule_check(spark, feed):
    rules = quality.transaction_rules("2024-01-01", "2024-12-31")
    with settings(spark, **TINY_SKEW):
        df = quality.tag_violations(feed, rules)
        assert "SortMergeJoin(skew=true)" in final_plan(df)
        assert df.where("array_contains(violations, 'id_unique')").count() == ROWS // 3


def test_small_dimensions_are_broadcast_without_a_hint(spark, feed, star):
    text = plan(facts.fact_transactions(feed, *star, "2026-01-01 00:00:00"))
    assert text.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in text
    assert "hashpartitioning" not in text  # the transactions are not shuffled


def test_one_row_per_key_leaves_each_task_before_the_shuffle(feed):
    for df in (dims.customer_members(feed), delta.dedup_batch(feed)):
        text = plan(df)
        assert re.search(r"WindowGroupLimit.*\n(.*\n)*?.*Exchange.*\n(.*\n)*?.*WindowGroupLimit", text)


def test_ranking_keys_needs_no_single_task(spark, monkeypatch):
    import txnmart.operators.keys as keys

    seen = []
    real = keys.staged
    monkeypatch.setattr(keys, "staged", lambda df, label: seen.append(df) or real(df, label))
    ranked = dense_key(spark.range(5000).selectExpr("(id * 7919) % 5003 as k"), "k", "id")
    written = plan(seen[0])
    assert "SinglePartition" not in written and "Window" not in written
    assert "rangepartitioning" in written
    # What meets in one task afterwards are the counts per range, not the keys.
    single = plan(ranked).split("SinglePartition")[0]
    assert "Window" in plan(ranked) and "_rows" in single


def test_reports_shrink_the_fact_before_joining_customers(spark, feed, star):
    customers, merchants, dates = star
    fact = staged(facts.fact_transactions(feed, *star, "2026-01-01 00:00:00"), "fact")
    text = plan(reports.monthly_spend(fact, customers, dates))
    assert "struct<customer_id:bigint,transaction_amount:double,date_id:bigint>" in text
    assert "IsNotNull(customer_id)" in text
    with settings(spark, **NO_BROADCAST):
        steps = re.findall(
            r"hashpartitioning\(([a-z_, ]+)",
            re.sub(r"#\d+L?", "", plan(reports.monthly_spend(fact, customers, dates))),
        )
    # After (customer, month) totals, the fact side is shuffled on the customer once more.
    assert steps.index("customer_id, month, ") < steps.index("customer_id, ")


def test_nothing_leaves_the_jvm(spark, feed, star):
    frames = [
        facts.fact_transactions(feed, *star, "2026-01-01 00:00:00"),
        reports.daily_totals(feed),
        quality.tag_violations(feed, quality.transaction_rules("2024-01-01", "2024-12-31")),
        delta.dedup_batch(feed),
        history.dim_upsert(star[0], star[0], "customer_email", ["customer_name"]),
    ]
    for df in frames:
        text = plan(df)
        assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct|NestedLoop", text)
