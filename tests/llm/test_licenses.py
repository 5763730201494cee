"""Licence scans against brute force."""

import random
import re

import numpy as np
import pytest
from helpers_llm import awkward_rows, documents

from txnmart.llm import license_scan
from txnmart.llm.license_scan import LEAST_MATCH, Automaton, chained, scan, words
from txnmart.llm.license_texts import PHRASES, TEMPLATES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_words_are_the_pattern():
    for text in ["Größe Über CC-BY\x00x\x7fy İ1 a_b c@d {e} \u00a0 f\tg", "", "ÀÉ😀 ok"]:
        assert [w.decode() for w in words(text.encode())] == WORD.findall(lower(text))


def random_automaton(rng):
    letters = "abc"
    draw = lambda n: [rng.choice(letters).encode() for _ in range(rng.randint(0, n))]
    templates, phrases = [draw(14) for _ in range(4)], [draw(3) for _ in range(3)]
    return templates, phrases, Automaton(templates, phrases), [draw(60) for _ in range(4)]


def has(hay, needle):
    return any(hay[i : i + len(needle)] == needle for i in range(len(hay) - len(needle) + 1))


@pytest.mark.parametrize("seed", range(25))
def test_against_brute_force(seed):
    templates, phrases, automaton, texts = random_automaton(random.Random(seed))
    for text in texts:
        text = text + [b"z"] + text[:5]
        # Phrases are in the automaton too: they are runs that may be followed.
        longest = [
            max(n for n in range(i + 2) if any(has(t, text[i + 1 - n : i + 1]) for t in templates + phrases))
            for i in range(len(text))
        ]
        codes = np.array([automaton.number.get(w, 0) for w in text])
        got = [n for n, _ in automaton.statistics(codes.tolist())]
        assert got == longest
        places, anchors = scan(automaton, codes)
        assert sorted(places) == [
            (p, i)
            for p, phrase in enumerate(phrases)
            for i in range(len(text))
            if phrase and text[i : i + len(phrase)] == phrase
        ]
        want = set()
        for i, n in enumerate(longest):
            if n >= LEAST_MATCH and (i + 1 == len(text) or longest[i + 1] <= n):
                run = text[i + 1 - n : i + 1]
                for t, template in enumerate(templates):
                    for at in range(len(template) - n + 1):
                        if template[at : at + n] == run:
                            want.add((t, i + 1 - n, at, n))
        assert set(anchors) == want and len(anchors) == len(want)


@pytest.mark.parametrize("seed", range(20))
def test_chains_are_the_best(seed):
    rng = random.Random(seed)
    anchors = [(rng.randrange(30), rng.randrange(30), rng.randint(3, 6)) for _ in range(9)]

    def best(chosen, rest):
        """Words of the best chain that goes on from ``chosen``."""
        covered = 0
        for k, (s, a, n) in enumerate(chosen):
            covered += n
            if k:
                p, b, m = chosen[k - 1]
                covered -= max(0, p + m - s, b + m - a)
        out = covered
        for i, (s, a, n) in enumerate(rest):
            if chosen:
                p, b, m = chosen[-1]
                shared = max(0, p + m - s, b + m - a)
                if not (p < s and b < a and shared < n and s - p - m <= 4 and a - b - m <= 4):
                    continue
            out = max(out, best(chosen + [(s, a, n)], rest[i + 1 :]))
        return out

    spans = chained(anchors, gap=4)
    assert spans[0][4] == best([], sorted(set(anchors)))
    assert all(end - start >= covered and high - low >= covered for start, end, low, high, covered in spans)


def test_chain_over_changed_words():
    automaton = Automaton([list(b"abcdefghijklmnop"[i : i + 1] for i in range(16))], [])
    text = [bytes([c]) for c in b"xxabcdefgh"] + [b"?"] + [bytes([c]) for c in b"jklmnopyy"]
    _, anchors = scan(automaton, np.array([automaton.number.get(w, 0) for w in text]))
    assert license_scan.spans_of(automaton, anchors, 0.7, 20) == [(0, 2, 18, 0, 16, 15)]


def base(text):
    w = WORD.findall(lower(text))
    places = []
    for phrase, label in PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return (
        len(w), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def test_report(spark):
    rows = awkward_rows()
    mit, gpl = (dict(TEMPLATES)[k] for k in ("mit-text", "gpl-text"))
    rows += [
        (100, "x " * 50 + mit + " y" * 50, None, None),
        (101, "CC-BY, cc  BY! cc by cc. General PUBLIC license x", None, None),
        (102, gpl.replace("hope that it will", "hope it would").upper(), None, None),
        (103, "Released under the MIT License. All rights\nreserved.", None, None),
        (104, "General Public\u00a0License all rights", None, None),
        (105, "licensed under the", None, None),
        (106, "All Rights Reserved " * 3000, None, None),
    ]
    report = license_scan.license_report(documents(spark, rows, extra=True).selectExpr("*", "0 as places"))
    got = sorted((tuple(r) for r in report.collect()), key=str)
    assert [r[:6] for r in got] == sorted(((r[0], *base(r[1])) for r in rows), key=str)
    by = {r[0]: r for r in got}
    assert by[100][6] == "mit-text" and by[100][7] == 1.0
    assert by[101][6] == "cc-by,gpl" and by[101][7] == 1.0
    assert by[102][6].split(",") == ["gpl", "gpl-text"]
    assert by[103][6] == "mit-notice,reserved"
    assert by[104][1:] == (4, 0, None, None, "", "", 0.0)  # a space beyond ASCII is part of a word
    assert by[105][6] == "" and by[106][2] == 3000
    assert by[4][1:] == (0, 0, None, None, "", "", 0.0)


def test_spans_say_where(spark):
    text = "see below - released under the MIT licence? no: Released, under the MIT License; thanks"
    row = license_scan.scanned(documents(spark, [(1, text, None, None)])).first()
    spans = {(s["label"], s["start"], s["end"], s["template_start"], s["template_end"]) for s in row["spans"]}
    assert ("mit-notice", 8, 13, 0, 5) in spans
    w = words(text.encode())
    assert w[8:13] == [b"released", b"under", b"the", b"mit", b"license"]


def test_no_templates_and_no_rows(spark):
    docs = documents(spark, [(1, "all rights reserved", None, None)])
    row = license_scan.scanned(docs, templates=[("none", "")], phrases=[("", "none"), ("rights", "one")]).first()
    assert row["spans"] == [] and [tuple(p) for p in row["places"]] == [("one", 1)]
    assert license_scan.license_report(documents(spark, [])).collect() == []
