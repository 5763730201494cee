"""Small tables with everything that tends to go wrong: NULLs, empty and long texts, repeated
rows, columns whose names clash with the operators' own."""

from __future__ import annotations

import random

WORDS = ("alder birch cedar dogwood elm fir gum hazel ironwood juniper kapok larch maple nutmeg oak "
         "pine quince rowan spruce teak upas viburnum willow yew").split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def documents(spark, rows, extra: bool = False):
    """``rows``: (doc_id, text, lang, source)."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], schema)
    if extra:
        for name in ("row", "node", "block", "size", "spans", "score", "th", "key", "component"):
            df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def awkward_rows():
    long = prose(1, 6000)
    base = prose(2, 120)
    near = base.replace("oak", "ash", 1)
    return [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, near, "en", "b"),
        (4, None, None, None),
        (5, "", "en", "a"),
        (6, " \t\n", "de", None),
        (7, "x" * 50_000, "de", "b"),
        (8, long, "en", "a"),
        (9, long, "en", "c"),
        (10, "one two", "en", "c"),
        (10, "one two", "en", "c"),
        (None, prose(3, 80), "fr", "c"),
        (11, "größer Ünïcode 🙂 " * 30, "de", "c"),
        (12, prose(4, 70) + " " + base[100:300], "en", "b"),
    ]
