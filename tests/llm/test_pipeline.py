"""Every stage of the pipeline against what plain Python makes of its input."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import documents, prose
from tokenizers import Tokenizer

import corpus_pipeline
from txnmart.llm import mixing, packing, toxicity

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
TOKENIZER = Tokenizer.from_file(packing.default_tokenizer())


def corpus():
    """Clean prose, toxic prose, near and exact copies, assigned secrets, odd rows."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(160):
        bad = i % 5 == 0
        text = prose(i, 60 + i % 50)
        if bad:
            words = text.split()
            for at in rng.sample(range(len(words)), 12):
                words[at] = rng.choice(["vile", "scum", "filth"])
            text = " ".join(words)
        if i % 7 == 0:
            text += f" password={'Zq' * 8}{i}! the end"
        rows.append((i, text, "en", "abc"[i % 3] if i % 11 else None))
        if i < 120:
            labels.append((i, int(bad)))
    for i in range(160, 200):  # copies of clean texts, some with a word changed
        source = rows[(i * 7) % 160]
        text = source[1] if i % 2 else source[1].replace(source[1].split()[3], "changed", 1)
        rows.append((i, text, *source[2:]))
    rows += [(300, None, "en", "a"), (301, "", "en", "a"), (302, " \n", None, None), (303, "one two", "en", "b")]
    rows += [(303, "one two", "en", "b"), (None, prose(999, 50), "en", "b")]
    return rows, labels


def shingles(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def survivors(rows):
    """Of each group of near copies the row with the smallest id, NULL first; rows without words all."""
    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                up[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i) if sets[i] else ("none", i)].append((r[0] is not None, r[0] or 0, i))
    return [rows[min(g)[2]] for g in groups.values()]


def masked(text):
    if text is None:
        return None
    out, at = "", 0
    for m in ASSIGN.finditer(text):
        if len(m[1]) >= 12:
            out, at = out + text[at : m.start()] + "[secret]", m.end()
    return out + text[at:]


def columns(rows):
    return sorted(((r[0], r[1], r[2], r[3], None if r[1] is None else len(r[1])) for r in rows), key=str)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input of each stage and the output of the last, as rows."""
    sf = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = corpus()
    documents(spark, rows).repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{sf}/{name}"
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        held.append(docs.collect())
    return sf, held


def test_toxicity_takes_what_the_network_rejects(spark, stages):
    sf, held = stages
    net = toxicity.fit_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    scores = toxicity.score_texts(net, [r[1] or "" for r in held[0]])
    want = [r for r, s in zip(held[0], scores, strict=True) if s < toxicity.THRESHOLD]
    assert columns(held[1]) == columns(want)
    kept = {r[0] for r in held[1]}
    bad = {r[0] for r in held[0] if r[1] and re.search("vile|scum|filth", r[1])}
    assert not kept & bad and kept == {r[0] for r in held[0]} - bad


def test_one_of_each_group_stays(stages):
    _, held = stages
    assert columns(held[2]) == columns(survivors(held[1]))
    assert len(held[2]) < len(held[1]) - 20


def test_secrets_are_masked_and_all_documents_stay(stages):
    _, held = stages
    want = [(r[0], masked(r[1]), *r[2:]) for r in held[2]]
    assert columns(held[3]) == columns(want)
    assert sum("[secret]" in (r[1] or "") for r in held[3]) > 10


def test_the_mix_takes_each_source_to_its_target(stages):
    _, held = stages
    before, after = held[3], held[4]
    size = lambda t: len((t or "").encode().split())
    names = sorted({r[3] for r in before if r[3] is not None}) + [None]
    sizes = [sum(size(r[1]) for r in before if r[3] == s) for s in names]
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(names))]
    for s, n, target in zip(names, sizes, mixing.targets(sizes, weights, mixing.SHARE, mixing.MOST), strict=True):
        taken = sum(size(r[1]) for r in after if r[3] == s)
        assert abs(taken - target) <= max(mixing.BLOCK_WORDS, 0.05 * target) and taken <= 2 * n
    # Every row is words of its document, in order, and no document is taken more than twice.
    by_id = {r[0]: r for r in before}
    words = defaultdict(Counter)
    for r in after:
        source = by_id[r[0]]
        own, of = r[1].encode().split(), source[1].encode().split()
        rest = iter(of)
        assert own and all(w in rest for w in own) and r[2:4] == source[2:4] and r[4] == len(r[1])
        words[r[0]].update(own)
    for doc, taken in words.items():
        of = Counter(by_id[doc][1].encode().split())
        assert all(n <= 2 * of[w] for w, n in taken.items())
    # A source that is taken twice over loses no document.
    whole = {s for s, n, t in zip(names, sizes, mixing.targets(sizes, weights, 1.5, 2.0), strict=True) if t >= 2 * n}
    assert {r[0] for r in before if r[3] in whole and size(r[1])} <= {r[0] for r in after}


def test_packs_hold_every_token_once(stages):
    _, held = stages
    want = Counter()
    for r in held[4]:
        want[(r[0], tuple(TOKENIZER.encode(r[1], add_special_tokens=False).ids) + (packing.END_ID,))] += 1
    names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in held[5]:
        doc, start, ids, total, sequence, offset = (r[n] for n in names)
        ids = np.frombuffer(ids, "<u4").tolist()
        sequences[sequence].append((offset, len(ids)))
        pieces[(doc, total)].append((start, ids))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.LENGTH
    # All ids, by document: pieces of rows with one id and length are told apart by their ids.
    for (doc, total), parts in pieces.items():
        rows = [ids for (d, ids), n in want.items() if d == doc and len(ids) == total for _ in range(n)]
        assert sum(len(ids) for _, ids in parts) == total * len(rows)
        for start, ids in parts:
            assert any(list(row[start : start + len(ids)]) == ids for row in rows)
    assert sum(len(i) for p in pieces.values() for _, i in p) == sum(len(i) * n for (_, i), n in want.items())


def test_run_is_the_stages_in_turn(spark, stages):
    sf, held = stages
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).drop("sequence_id", "offset").collect()), key=str) == sorted(
        ((r["doc_id"], r["start"], r["ids"], r["doc_tokens"]) for r in held[5]), key=str
    )
