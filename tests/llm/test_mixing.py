import random
import re

import numpy as np
import pytest
from helpers import settings
from helpers_llm import awkward_rows, documents, prose

import corpus_pipeline
from txnmart.llm import mixing
from txnmart.llm.queries import QUERIES


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 1.5, 2.0) == [200.0, 2 / 3 * 250, 1 / 3 * 250]
    assert mixing.targets([0, 10], [5, 2], 1.5, 2.0) == [0.0, 15.0]
    assert mixing.targets([], [], 1.5, 2.0) == []


def test_shards_add_up():
    slots = np.array([5000, 0, 1, 777])
    shards = list(mixing.draw_shards(slots, 1000, 3))
    assert (np.sum(shards, axis=0) == slots).all()
    assert [int(s.sum()) for s in shards] == [1000] * 5 + [778]
    assert np.std([s[0] for s in shards[:-1]]) > 1  # drawn, not dealt


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 1000])
def test_permutations(n):
    a, b = (mixing.permuted(np.arange(n), n, key) for key in (1, 2))
    assert sorted(a) == sorted(b) == list(range(n))
    assert n < 60 or (a != b).any()


def corpus(seed, n):
    rng = random.Random(seed)
    names = ["a", "b", "c", None, "d"]
    return [(i, prose(i, rng.choice([1, 20, 90, 300])), "en", rng.choice([*names, "a", "a"])) for i in range(n)]


def test_report(spark):
    rows = corpus(0, 300)
    docs = documents(spark, rows, extra=True)
    got = mixing.Mix(docs.repartition(4)).report().collect()
    again = mixing.Mix(docs.repartition(2)).report().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    names = sorted({r[3] for r in rows if r[3]}) + [None]
    sizes = [sum(len(r[1].split()) for r in rows if r[3] == s) for s in names]
    wanted = mixing.targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(names))], 1.5, 2.0)
    source = {r[0]: names.index(r[3]) for r in rows}
    taken = [0] * len(names)
    for r in got:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (len(rows[r["doc_id"]][1].split()), sizes[s])
        assert r["target"] == pytest.approx(wanted[s]) and r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(t - w) <= max(64, 0.01 * w) for t, w in zip(taken, wanted, strict=True))


def test_slots_and_sizes_are_not_broadcast(spark):
    """Slots are made from a few rows of counts, and sizes of documents are small on disk: by these
    Spark would hold a row per block or document in the driver."""
    docs = documents(spark, corpus(3, 400))
    keys = []
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="10MB"):
        for df in (mixing.Mix(docs, block_words=4).report(), mixing.mixed_documents(docs, block_words=4)):
            assert len(df.collect()) >= 400
            plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            keys.append(re.findall(r"BroadcastHashJoin \[(.*?)\]", plan))
            assert len(re.findall(r"SortMergeJoin.* \[sid#\d+, block#\d+L\]", plan)) == 1
    assert not [k for k in sum(keys, []) if "block#" in k]
    assert not [k for k in keys[1] if k.startswith("row#")]


def test_pieces_are_whole_blocks(spark):
    rows = corpus(1, 200)
    mix = mixing.Mix(documents(spark, rows))
    pieces = mix.pieces().collect()
    size = {}
    for p in pieces:
        size[p["shard"], p["slot"]] = size.get((p["shard"], p["slot"]), 0) + p["n_words"]
    assert len(size) == mix.slots.sum()
    assert max(size.values()) <= 64 and sum(v < 64 for v in size.values()) <= 2 * len(mix.names)
    slots = sorted(size)
    assert slots == [(s, i) for s in range(slots[-1][0] + 1) for i in range(sum(k[0] == s for k in slots))]


def test_mixed_documents(spark):
    rows = corpus(2, 150)
    docs = documents(spark, rows, extra=True)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words, seen = {}, {}
    for r in mixed.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
        assert r["n_chars"] == len(r["text"]) and set(r["text"].split()) <= set(rows[r["doc_id"]][1].split())
    taken = {r["doc_id"]: r["taken"] for r in mixing.Mix(docs).report().collect() if r["taken"]}
    assert words == taken and max(seen.values()) <= 2


def test_awkward(spark):
    rows = awkward_rows()
    got = mixing.Mix(documents(spark, rows, extra=True)).report().collect()
    assert len(got) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in got)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    nothing = documents(spark, [])
    assert mixing.Mix(nothing).report().count() == 0 and mixing.mixed_documents(nothing).count() == 0
    blank = documents(spark, [(1, None, "en", None), (2, " ", "en", "a")])
    assert [r["taken"] for r in mixing.Mix(blank).report().collect()] == [0, 0]


def test_pipeline(spark):
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert pieces.columns == ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "mix", "pack"]
    assert pieces.count() > 100


def test_pipeline_stages_on_odd_tables(spark, monkeypatch):
    for rows in (awkward_rows(), []):
        docs = documents(spark, rows, extra=True)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs2 = stage(spark, docs, "/root/testdata/sf0.001")
            assert docs2.columns == docs.columns
            docs = docs2.cache()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= (len(rows) > 0)


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
