"""Rows told apart by a bitmap of keys before a join."""

from helpers import frame, plan, settings, txn, values
from pyspark.sql import functions as F

from txnmart.operators import delta, members, quality
from txnmart.operators.members import apart, bits_for, bitmap
from txnmart.schemas import ID
from txnmart.scratch import staged


def numbers(spark, start, end, step=1):
    return spark.range(start, end, step).select(F.col("id").alias(ID))


def test_no_row_with_a_key_is_told_apart(spark, monkeypatch):
    monkeypatch.setattr(members, "FEWEST", 0)
    rows = numbers(spark, -30_000, 30_000).unionByName(spark.sql(f"select cast(null as bigint) as {ID}"))
    keys = staged(numbers(spark, -30_000, 30_000, 7), "keys")
    may, others = apart(rows, keys, ID, keys.count())
    assert may.join(keys, ID, "left_semi").count() == keys.count()
    assert others.join(keys, ID, "left_semi").count() == 0
    assert may.count() + others.count() == 60_001 and others.where(F.col(ID).isNull()).count() == 1
    assert may.count() < 2 * keys.count()  # few rows share a bit with another's key


def test_every_bit_of_a_word_is_found(spark):
    """As many bits as the keys have hashes, in words of 64."""
    keys = numbers(spark, 0, 500)
    words = {r["_piece"]: r["_words"] for r in bitmap(keys, ID, 1 << 17).collect()}
    found = {
        (p << 15) + w * 64 + (b ^ 56)
        for p, some in words.items()
        for w, word in enumerate(some)
        for b in range(64)
        if word >> b & 1
    }
    hashed = keys.select((F.xxhash64(ID).bitwiseAND(F.lit((1 << 17) - 1))).alias("h")).collect()
    assert found == {r["h"] for r in hashed}


def test_bits_are_bounded(spark, monkeypatch):
    assert bits_for(0) == bits_for(1) == members.PIECE
    assert all(8 * n <= bits_for(n) < 16 * n for n in (10_000, 1_000_000, 30_000_000))
    assert bits_for(1 << 40) == members.MOST_BITS
    rows = numbers(spark, 0, 5)
    assert apart(rows, rows, ID, 1 << 40)[1] is None  # all rows would have their bit set
    assert apart(rows, rows, ID, 5)[1] is None  # so few are broadcast
    monkeypatch.setattr(members, "FEWEST", 0)
    assert apart(rows, rows.select(F.col(ID).cast("int")), ID, 5)[1] is None
    assert apart(rows, rows, ID, 5)[1].count() == 0


def many(spark):
    """Most ids known (below 40), repeats, a hot id and NULL ids."""
    return staged(frame(spark, *[txn(i) for i in range(60)], *[txn(50)] * 9, txn(None), txn(None)), "batch")


def few(spark):
    """Most ids new, a hot known one, a repeated new one and a NULL id."""
    return staged(frame(spark, *[txn(i) for i in range(30, 90)], *[txn(35)] * 9, txn(89), txn(None)), "batch")


def assert_bitmap_below_the_shuffle(df, kind):
    """Whole rows meet the bitmap, which is broadcast, before they are shuffled for the join."""
    text = plan(df)
    above = text[: text.index("BroadcastHashJoin")]
    assert f"SortMergeJoin {kind}" in above and "- Exchange" in above


def test_rules_look_up_only_rows_left_by_the_bitmap(spark, monkeypatch):
    rules = {"id_present": F.col(ID).isNotNull()}

    def violations(batch):
        tagged = quality.tag_violations(batch, rules)
        return values(tagged.withColumn("violations", F.concat_ws(",", "violations")))

    batches = [many(spark), few(spark)]
    plain = [violations(b) for b in batches]
    monkeypatch.setattr(members, "FEWEST", 0)
    assert [violations(b) for b in batches] == plain
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert_bitmap_below_the_shuffle(quality.tag_violations(batches[0], rules), "LeftOuter")


def test_a_merge_joins_only_rows_left_by_the_bitmap(spark, monkeypatch):
    known = staged(frame(spark, *[txn(i) for i in range(40)]), "known")
    batches = {"LeftSemi": many(spark), "LeftAnti": few(spark)}

    def results():
        fresh = [delta.find_new(b, known) for b in batches.values()]
        return [(values(f.rows), f.known) for f in fresh]

    plain = results()
    assert [known for _, known in plain] == [40, 19]
    monkeypatch.setattr(members, "FEWEST", 0)
    assert results() == plain
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for kind, batch in batches.items():
            assert_bitmap_below_the_shuffle(delta.new_rows(batch, known), kind)
