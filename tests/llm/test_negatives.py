"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from txnmart.llm import hard_negatives
from txnmart.scratch import staged


def brute(rows, every, positives, negatives, band, scale=256):
    """``rows``: (vec_id, embedding, label)."""
    usable = [
        (i, v, label, [math.floor(scale * x) if abs(x) < 1e15 else int(x) * scale for x in v])
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    low, high = hard_negatives.LONG
    out = []
    for a, (anchor, _, label, ints) in enumerate(usable):
        if anchor is None or anchor % every:
            continue
        scored = []
        for b, (other, _, theirs, more) in enumerate(usable):
            if b != a and len(more) == len(ints):
                score = min(high, max(low, sum(x * y for x, y in zip(ints, more, strict=True))))
                scored.append((-score, other is None, other or 0, other, theirs == label, score))
        scored.sort(key=lambda s: s[:3])
        for _, _, _, positive, _, score in [s for s in scored if s[4]][:positives]:
            fits = [s for s in scored if not s[4] and band[0] * score <= 100 * s[5] <= band[1] * score]
            for rank, s in enumerate(fits[:negatives], 1):
                out.append((anchor, positive, rank, s[3], score, s[5]))
    return sorted(out, key=str)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.selectExpr("*", "1 as row", "'x' as packed", "2 as cell", "3 as anchor", "4 as nth")
    return sorted((tuple(r) for r in hard_negatives.mine(df, **more).collect()), key=str)


def test_bit_planes():
    rng = np.random.default_rng(1)
    for dims in (0, 1, 8, 13):
        for numbers in (
            rng.integers(-300, 300, (9, dims)),
            rng.integers(-(1 << 61), 1 << 61, (9, dims)),
            rng.integers(-(1 << 61), 1 << 61, (9, dims)).astype(object) * (1 << 40),
        ):
            planes = int(hard_negatives.planes_needed(numbers).max())
            packed = hard_negatives.pack(numbers, planes)
            assert (hard_negatives.unpack(packed, dims) == numbers).all()
            want = np.clip(numbers.astype(object) @ numbers.astype(object).T, *hard_negatives.LONG)
            assert (hard_negatives.scores(numbers, packed) == want).all()


def test_subset_sums():
    sums = hard_negatives.subset_sums(np.arange(1, 11)[None, :], np.int64)
    assert sums.shape == (2, 256, 1) and sums[0, 0b10000001, 0] == 1 + 8 and sums[1, 0b11, 0] == 9 + 10
    assert sums[1, 0b100, 0] == 0


@pytest.mark.parametrize("tile", [7, 8192])
def test_against_brute_force(spark, tile):
    rng = random.Random(tile)
    rows = [
        (i, [rng.choice([-0.4, -0.1, 0.1, 0.2, 0.7]) for _ in range(9)], rng.choice([0, 0, 0, 1, 2]))
        for i in range(90)
    ]
    more = {"every": 10, "n_positives": 4, "n_negatives": 6, "band": (20, 80)}
    want = brute(rows, *more.values())
    assert len(want) > 100 and mined(spark, rows, tile=tile, **more) == want


def test_awkward_rows(spark):
    near = [0.5, 0.25, 0.125]
    rows = [
        (0, near, 1), (0, near, 1), (0, near, 2), (1, near, 1), (1, near, 1), (None, near, 1),
        (None, [0.3, 0.2, 0.1], 2), ((1 << 62) + 1, [0.3, 0.2, 0.1], 2), (2, [0.3, 0.2, 0.1], 3),
        (3, None, 1), (4, near, None), (5, [0.1, None, 0.2], 1), (6, [math.nan, 0.0, 0.0], 1),
        (7, [math.inf, 0.0, 0.0], 2), (100, [], 1), (101, [], 1), (102, [], 2), (200, [0.0, 0.0, 0.0], 1),
        (300, [1e300, 1.0, 0.0], 4), (301, [1e300, 0.0, 0.0], 4), (302, [1.0, 0.0, 0.0], 5),
        (400, [2e9, 0.0], 4), (401, [2e9, 0.0], 4), (402, [1e9, 0.0], 5), (500, [1.0] * 5, 9),
    ]
    want = brute(rows, 100, 5, 10, (30, 90))
    assert want and mined(spark, rows) == want


def test_empty_table(spark):
    assert mined(spark, []) == []


def test_hot_label_goes_to_many_tiles(spark):
    """No group of a pass holds more than a tile's rows, whatever a label's share."""
    df = spark.range(20_000).selectExpr(
        "id as vec_id", "array(float(0.1), float(id % 97) / 97) as embedding", "int(id % 50 = 7) as label"
    )
    rows = hard_negatives.index_rows(df).selectExpr("*", "vec_id as row")
    sent = hard_negatives._sent(rows)
    anchors = staged(rows.where("vec_id % 100 = 0"), "anchors")
    tiles = hard_negatives._tiles(sent, anchors, ["dims", "label"], 1000)
    def sizes(met: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"rows": [len(met)], "anchors": [len(asked)]})

    got = tiles.applyInPandas(sizes, "rows long, anchors long").toPandas()
    assert got["rows"].max() < 1200 and got["rows"].sum() >= 19_600
