"""Learned operators: gradients, exact small cases, held-out accuracy, odd tables."""

import random
from itertools import product

import numpy as np
import pytest
from helpers_llm import awkward_rows, documents, prose

from txnmart.llm import cotraining, decision_list, langid, toxicity
from txnmart.llm.wordtables import ngrams, segment_sum, sum_by, word_numbers


def labels(spark, rows, column):
    return spark.createDataFrame(rows, f"doc_id long, {column} int")


# shared tables


def test_word_tables():
    flat, lengths, words = word_numbers(["a B a", "", "b c"])
    assert [words[i] for i in flat] == [b"a", b"b", b"a", b"b", b"c"] and lengths.tolist() == [3, 0, 2]
    grams, counts = ngrams([b"abc", b"", b"x"], (2, 3), 1 << 20)
    one, two = (ngrams([b"abc"], (n,), 1 << 20)[0].tolist() for n in (2, 3))
    assert counts[0] == 4 + 3 and grams[:7].tolist() == one + two
    assert segment_sum(np.arange(5), np.array([2, 0, 3])).tolist() == [1, 0, 9]
    assert sum_by(np.array([2, 0, 2]), np.array([1.0, 5.0, 2.0]), 4).tolist() == [5, 0, 3, 0]


# quality rules


def counts_by_hand(text):
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    seen = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(seen) if seen.count(w) > 1 for k in range(3)}
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(hit),
    )


def test_text_counts():
    rng = random.Random(0)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b ", " ", "\n", "é", "#", "a b c ", "\t", "| "]) for _ in range(rng.randint(0, 60)))
        assert decision_list.text_counts(text)[:5] == counts_by_hand(text)


def test_rules_find_planted_conjunction():
    rng = np.random.default_rng(0)
    values = {n: rng.random(3000) for n in decision_list.FEATURES}
    bad = (values["upper_share"] > 0.7) & (values["digit_share"] < 0.3) | (values["repeat_share"] > 0.9)
    rules = decision_list.learn_rules(values, bad)
    hit = np.any([decision_list._covers(r, values, 3000) for r in rules], axis=0)
    assert (hit & bad).sum() > 0.95 * bad.sum() and (hit & ~bad).sum() < 0.02 * (~bad).sum()


def test_verdict_is_first_rule(spark):
    c = decision_list.Condition
    rules = [(c("words", True, 5.0),), (c("words", True, 2.0), c("upper_share", False, 0.5))]
    rows = [(n, 10, 0, 0, 0, 1, n, u, 10, 0, 0) for n, u in ((9, 9), (3, 9), (3, 1), (1, 0))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in (*decision_list.COUNTS, *decision_list.MORE)))
    assert [r[0] for r in df.select(decision_list.verdict(rules)).collect()] == [1, None, 2, None]


def test_quality_rules(spark):
    rows, marks = [], []
    for i in range(300):
        text = prose(i, 80)
        if i % 5 == 0:
            text = " ".join(w + "###" for w in text.split())
        rows.append((i, text, "en", "a"))
        if i % 2 == 0:
            marks.append((i, int(i % 5 != 0)))
    got = decision_list.quality_report(documents(spark, rows, True), labels(spark, marks, "quality")).collect()
    assert all(r["kept"] == (r["doc_id"] % 5 != 0) for r in got)


def test_quality_rules_awkward(spark):
    docs = documents(spark, awkward_rows(), extra=True)
    for marks in ([], [(1, 1)], [(1, None), (None, 1)], [(1, 0), (1, 1), (2, 0)]):
        got = decision_list.quality_report(docs, labels(spark, marks, "quality")).collect()
        assert len(got) == len(awkward_rows())
        assert all(not r["kept"] for r in got if r["n_words"] < 50)
    assert decision_list.quality_report(docs.limit(0), labels(spark, [], "quality")).count() == 0


# toxicity


def test_network_gradients():
    net = toxicity.Network({b"ab": 1, b"cd": 2}, hidden=4, dtype=np.float64)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words, counts, y = [b"ab", b"cd", b"efg"], np.array([2, 3]), np.array([1.0, 0.0])
    idx = np.random.default_rng(0).integers(0, 4, (5, 6))

    def loss():
        x, _ = net.inputs(words)
        s, _ = toxicity.pool(net.forward(net.table(x), idx)[0], counts)
        return float((np.log1p(np.exp(s)) - y * s).sum())

    x, made = net.inputs(words)
    logits, cache = net.forward(net.table(x), idx, keep=True)
    s, weight = toxicity.pool(logits, counts)
    of = np.repeat([0, 1], counts)
    d = (1 / (1 + np.exp(-s)) - y)[of] * weight * (1 + toxicity.SHARP * (logits - s[of]))
    grads, dtable = net.backward(idx, cache, d, len(x))
    grads |= net.input_gradients(x, made, dtable)
    for name, value in net.p.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        held = value[at]
        value[at] = held + 1e-5
        up = loss()
        value[at] = held - 1e-5
        down = loss()
        value[at] = held
        assert (up - down) / 2e-5 == pytest.approx(grads[name][at], rel=1e-4, abs=1e-9)


def test_windows_cover_whole_texts():
    lengths = np.array([0, 5, 32, 33, 48, 49, 500])
    flat = np.arange(lengths.sum())
    idx, n = toxicity.windows(flat, lengths, -1)
    first = np.cumsum(lengths) - lengths
    at = np.cumsum(n) - n
    for i, size in enumerate(lengths):
        rows = idx[at[i] : at[i] + n[i]]
        assert set(rows.ravel()) - {-1} == set(range(first[i], first[i] + size))
        if size > 32:
            assert (np.diff(rows[:, 0]) <= toxicity.STRIDE).all() and (rows >= 0).all()


def test_toxicity_held_out(spark):
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(400):
        words = prose(i, rng.randint(20, 150)).split()
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "rotten", "wretch"]))
        rows.append((i, " ".join(words), "en", "a"))
        marks.append((i, int(i % 4 == 0)))
    got = toxicity.toxicity_report(documents(spark, rows, True), labels(spark, marks, "toxic")).collect()
    out = [r for r in got if r["held_out"]]
    assert 60 < len(out) < 140
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_rare_toxic_phrase_is_not_taken_for_wrong_labels(monkeypatch):
    """Documents of a kind that is not learned by the middle of training still count."""

    def toxic(i, words, n):
        rng = random.Random(i)
        text = prose(i, rng.randint(20, 80)).split()
        for _ in range(n):
            text.insert(rng.randrange(len(text)), rng.choice(words))
        return " ".join(text)

    texts = [prose(i, 20 + i % 60) for i in range(360)]
    texts += [toxic(1000 + i, ["vile", "rotten", "wretch"], 3) for i in range(104)]
    texts += [toxic(2000 + i, ["zorkblat"], 1) for i in range(16)]
    rare, clean = [toxic(5000 + i, ["zorkblat"], 1) for i in range(40)], [prose(9000 + i, 20 + i % 60) for i in range(100)]
    means = []
    for doubt in (toxicity.DOUBT, 0.0):  # 0 leaves them out
        monkeypatch.setattr(toxicity, "DOUBT", doubt)
        net = toxicity.train(texts, np.repeat([0.0, 1.0], [360, 120]), steps=70)
        means.append(toxicity.score_texts(net, rare).mean())
        assert (toxicity.score_texts(net, clean) < 0.5).all()
    assert means[0] > means[1] + 0.05


def test_toxicity_awkward(spark):
    docs = documents(spark, awkward_rows(), extra=True)
    for marks, score in (([], 0.0), ([(1, 1)], 1.0), ([(2, 0), (None, 1), (3, None)], 0.0)):
        got = toxicity.toxicity_report(docs, labels(spark, marks, "toxic")).collect()
        assert [r["score"] for r in got] == [score] * len(awkward_rows())
    net = toxicity.train([prose(1, 50), prose(2, 50) + " vile"] * 3, np.array([0, 1] * 3), steps=5)
    kept = toxicity.score_documents(docs, net)
    assert sorted(kept.columns) == sorted(docs.columns) and kept.count() == len(awkward_rows())
    assert toxicity.score_documents(docs.limit(0), net).count() == 0


# language


def test_forward_backward():
    rng = np.random.default_rng(2)
    emit, trans, start = rng.random((5, 1, 3)), rng.random((3, 3)), rng.random(3)
    first = np.array([1, 0, 0, 1, 0], bool)[:, None]
    got, _, _ = langid.marginals(emit, first, trans, start)
    want = np.zeros((5, 3))
    for path in product(range(3), repeat=5):
        p = 1.0
        for t, y in enumerate(path):
            p *= emit[t, 0, y] * (start[y] if first[t, 0] else trans[path[t - 1], y])
        want[np.arange(5), path] += p
    assert np.allclose(got[:, 0], want / want.sum(axis=1, keepdims=True))


SYLLABLES = {"en": "the ing tion wh", "de": "sch ung ein ü", "fr": "eau que é oi"}


def speech(lang, seed, n):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(SYLLABLES[lang].split(), k=rng.randint(1, 3))) for _ in range(n))


def test_languages_held_out_and_mixed(spark):
    rows = [(i, speech(("en", "de", "fr")[i % 3], i, 30 + i % 70), ("en", "de", "fr")[i % 3], "a") for i in range(300)]
    rows += [(1000, None, "en", "a"), (1001, "", "en", "a"), (1002, "123 !!", "de", "a"), (1003, speech("fr", 9, 50), None, "a")]
    got = {r["doc_id"]: r for r in langid.language_report(documents(spark, rows, True)).collect()}
    out = [r for r in got.values() if r["held_out"] and r["doc_id"] < 1000]
    assert np.mean([r["lang_pred"] == rows[r["doc_id"]][2] for r in out]) > 0.97
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "fr"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    model = langid.train([r[1] for r in rows[:300]], [r[2] for r in rows[:300]])
    mixed = langid.word_languages(model, speech("en", 5000, 20) + " " + speech("de", 5001, 20))
    assert np.mean([y == ("en" if i < 20 else "de") for i, (_, y) in enumerate(mixed)]) > 0.8


@pytest.mark.parametrize("short", ["fr", "de fr en"])
def test_languages_with_short_texts_only(short):
    """A language is learned from texts of fewer words than a passage has, also if all are short."""

    def sample(first, n):
        langs = [("en", "de", "fr")[i % 3] for i in range(n)]
        sizes = [1 + i % 9 if x in short.split() else 30 + i % 70 for i, x in enumerate(langs)]
        return [speech(x, first + i, k) for i, (x, k) in enumerate(zip(langs, sizes, strict=True))], langs

    model = langid.train(*sample(0, 300))
    texts, langs = sample(10_000, 300)
    names, _ = langid.identify(model, texts)
    for lang in ("en", "de", "fr"):
        assert np.mean([a == b for a, b in zip(names, langs, strict=True) if b == lang]) > 0.9


def test_sequences_of_uneven_passages():
    at, y = langid._sequences(np.array([5, 0, 9, 2]), np.array([2, 3, 1, 2]), np.array([1, 0, 2, 1]), 3)
    assert at.tolist() == [[5, 6, 0, 1, 2, 9], [2, 3, -1, -1, -1, -1]]
    assert y.tolist() == [[1, 1, 0, 0, 0, 2], [1, 1, 0, 0, 0, 0]]


def test_languages_awkward(spark):
    docs = documents(spark, awkward_rows(), extra=True)
    assert langid.language_report(docs).count() == len(awkward_rows())
    nothing = langid.language_report(docs.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    assert langid.language_report(docs.limit(0)).count() == 0


# co-training


def test_co_training(spark):
    rows, marks = [], []
    for i in range(400):
        good = i % 3 != 0
        text = prose(i, 60) if good else "\n".join(w.upper() + "!!" for w in prose(i, 60).split())
        rows.append((i, text, "en", "good-site" if good else "bad-site"))
        if i % 4 == 0:
            marks.append((i, int(good)))
    got = cotraining.quality_scores(documents(spark, rows, True), labels(spark, marks, "quality")).collect()
    for column in ("content_score", "metadata_score", "score"):
        assert np.mean([(r[column] >= 0.5) == (r["doc_id"] % 3 != 0) for r in got]) > 0.97


def pages(n, seed, first=0, noisy=False):
    """Rows of documents, and whether each is good: the source tells, and the words if not ``noisy``."""
    rng = random.Random(seed)
    rows, good = [], []
    for i in range(n):
        good.append(rng.random() < 0.5)
        words = "" if noisy else "alder birch " if good[-1] else "quince rowan "
        rows.append((first + i, words + prose(seed * 1000 + i, 7), "en", "s" if good[-1] else "t"))
    return rows, good


def content_accuracy(spark, labelled, more, **settings):
    """How well the content view tells fresh documents, with labels of ``labelled`` alone."""
    (rows, good), (free, _) = labelled, more
    views = cotraining.written_views(documents(spark, rows + free))
    marks = labels(spark, [(r[0], int(g)) for r, g in zip(rows, good, strict=True)], "quality")
    model = cotraining.fit_quality(views, marks, **settings)
    test, truth = pages(200, 3)
    fresh = cotraining.Views.of(*[[r[k] for r in test] for k in (1, 2, 3)], [40] * len(test))
    content, _ = fresh.sparse(model.edges)
    return np.mean((model.models[0].logits(content) > 0) == np.array(truth))


def test_other_documents_help_the_weaker_view(spark):
    """Content labels that few documents have come from the metadata of the rest."""
    assert content_accuracy(spark, pages(60, 1, noisy=True), pages(600, 2, 1000)) > 0.9


def test_every_document_can_be_picked(spark):
    """Of 20,000 documents without a label only the last ones have words that tell; the others say
    nothing to either view."""
    dull = [(100_000 + i, f"w{i % 997} x{i % 991}", "en", "u") for i in range(20_000)]
    told = pages(400, 2, 900_000)
    assert content_accuracy(spark, pages(60, 1, noisy=True), (dull + told[0], None)) > 0.9
    assert content_accuracy(spark, pages(60, 1, noisy=True), (dull, None)) < 0.8


def test_copies_do_not_fill_the_picks(spark):
    rows, good = pages(400, 2, 1000)
    copies = [(10_000 + i, *rows[good.index(True)][1:]) for i in range(3000)]
    assert content_accuracy(spark, pages(60, 1, noisy=True), (rows + copies, None)) > 0.9


def test_rows_for_fitting_are_bounded(spark):
    """One row per id and so many bytes, whatever the table repeats."""
    from txnmart.llm.common import bounded_rows

    df = spark.range(100_000).selectExpr("0 as doc_id", "repeat('x', int(id % 3)) as text").unionByName(
        spark.range(1, 50).selectExpr("id as doc_id", "repeat('y', 100) as text")
    )
    held = bounded_rows(df, ["text"], 10_000)
    assert held["doc_id"] == list(range(50)) and held["text"][0] == ""
    held = bounded_rows(df, ["text"], 1000)
    assert len(held["doc_id"]) in (10, 11) and sum(map(len, held["text"])) <= 1000
    huge = df.selectExpr("doc_id", "if(doc_id = 7, repeat('z', 5000), text) as text")
    assert 7 not in bounded_rows(huge, ["text"], 4900)["doc_id"]
    assert bounded_rows(df.limit(0), ["text"], 10) == {"doc_id": [], "text": []}


def test_a_labelled_id_repeated_many_times(spark):
    rows = [(i, prose(i, 20) + (" vile" if i % 2 else ""), "en", "a") for i in range(40)]
    docs = documents(spark, rows)
    again = spark.range(100_000).selectExpr("1L as doc_id", f"'{rows[1][1]}' as text", "'en' as lang")
    many = docs.unionByName(again, allowMissingColumns=True)
    net = toxicity.fit_toxicity(many, labels(spark, [(i, i % 2) for i in range(40)], "toxic"))
    assert isinstance(net, toxicity.Network)
    assert langid.fit_langid(many) is not None


def test_null_ids_are_not_held_out(spark):
    docs = documents(spark, [(None, "some words here", "en", "a"), (1, "some more words", "en", "a")])
    for report in (toxicity.toxicity_report(docs, labels(spark, [], "toxic")), langid.language_report(docs)):
        got = {r["doc_id"]: r["held_out"] for r in report.collect()}
        assert got[None] is False and got[1] is not None


def test_letters_are_what_unicode_calls_letters(spark):
    rows = [(i, speech("en", i, 30), "en", "a") for i in range(30)]
    rows += [(100, "½ ② ① 12", "en", "a"), (101, "é", "en", "a")]
    got = {r["doc_id"]: r for r in langid.language_report(documents(spark, rows)).collect()}
    assert (got[100]["lang_pred"], got[100]["score"]) == ("und", 0.0)
    assert got[101]["lang_pred"] == "en"


def test_co_training_awkward(spark):
    docs = documents(spark, awkward_rows(), extra=True)
    for marks, score in (([], 1.0), ([(1, 0)], 0.0), ([(None, 1), (2, None)], 1.0)):
        got = cotraining.quality_scores(docs, labels(spark, marks, "quality")).collect()
        assert [r["score"] for r in got] == [score] * len(awkward_rows())
    got = cotraining.quality_scores(docs, labels(spark, [(i, i % 2) for i in range(12)], "quality")).collect()
    assert len(got) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert cotraining.quality_scores(docs.limit(0), labels(spark, [], "quality")).count() == 0
