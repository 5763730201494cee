"""Licence scans with a generalised suffix automaton of licence wordings.

The words of all templates go into one automaton, which has every run of words of any template as a
path. A text is streamed through it: for each word the automaton tells the longest run of template
words that ends there (matching statistics), dropping words from the front along suffix links where
the run cannot go on. Runs of ``LEAST_MATCH`` words or more that cannot be extended are anchors; each
lies at one or several places of templates. Anchors of one template are chained while both texts go
forward and the words left out between two are ``GAP`` at most; a chain of the most words is a span,
and it counts if it covers ``SHARE`` of its template, or ``LONG_COVER`` words. Phrases are templates
whose occurrences are counted themselves: a run that ends in the whole phrase is a place.

The templates are a parameter; the automaton of about two states a word is built once on the driver
and sent to every task, so they should stay below some ten thousand words. Texts are handled whole, by
the task that reads them, and nothing is shuffled.

Letters A-Z count as a-z; words are runs of letters, digits and characters beyond ASCII. NULL and
empty texts have no words. Repeated rows each give a row; clashing names of extra columns do no harm.
Template words may repeat; an empty template never matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import slices, words_of
from txnmart.llm.license_texts import PHRASES, TEMPLATES

LEAST_MATCH = 3
GAP = 8
SHARE = 0.7
LONG_COVER = 20

# Fixed value: words are cut at these ASCII bytes; A-Z become a-z.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


class Automaton:
    """Every run of words of the templates; state 0 is the empty run."""

    def __init__(self, templates: list[list[bytes]], phrases: list[list[bytes]]):
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        coded = [[self.number.setdefault(w, len(self.number) + 1) for w in t] for t in templates]
        asked = [[self.number.setdefault(w, len(self.number) + 1) for w in p] for p in phrases]
        for run in coded + asked:
            last = 0
            for word in run:
                last = self._extend(last, word)
        # From the longest runs to the shortest, and back, along suffix links.
        order = sorted(range(1, len(self.link)), key=self.longest.__getitem__)
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for t, run in enumerate(coded):
            state = 0
            for i, word in enumerate(run):
                state = self.next[state][word]
                self.places[state].append((t, i + 1))
        for state in reversed(order):
            if self.longest[self.link[state]] >= LEAST_MATCH:
                self.places[self.link[state]] += self.places[state]
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for p, run in enumerate(asked):
            state = 0
            for word in run:
                state = self.next[state][word]
            if run:
                self.ends[state].append((p, len(run)))
        for state in order:
            self.ends[state] = self.ends[state] + self.ends[self.link[state]]
        self.sizes = [len(run) for run in coded]
        self.shortest = min([LEAST_MATCH, *(len(run) for run in asked if run)])

    def _state(self, after: dict[int, int], link: int, longest: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.longest.append(longest)
        return len(self.link) - 1

    def _split(self, state: int, word: int) -> int:
        """The state of exactly the runs of ``state`` followed by ``word``."""
        to = self.next[state][word]
        if self.longest[to] == self.longest[state] + 1:
            return to
        new = self._state(dict(self.next[to]), self.link[to], self.longest[state] + 1)
        self.link[to] = new
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = new
            state = self.link[state]
        return new

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # an earlier template has this run
            return self._split(last, word)
        new = self._state({}, 0, self.longest[last] + 1)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def statistics(self, run: list[int], state: int = 0, length: int = 0) -> Iterator[tuple[int, int]]:
        """For each word, the length of the longest run of template words that ends there, and its
        state."""
        after, link, longest = self.next, self.link, self.longest
        for word in run:
            while state and word not in after[state]:
                state = link[state]
                length = longest[state]
            to = after[state].get(word)
            if to is None:
                state = length = 0
            else:
                state, length = to, length + 1
            yield length, state


def scan(automaton: Automaton, codes: np.ndarray):
    """Of a text as template word numbers (0: none): the places of phrases (phrase, start), and the
    anchors (template, start in the text, start in the template, words)."""
    places: list[tuple[int, int]] = []
    anchors: list[tuple[int, int, int, int]] = []
    known = codes > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
    ends = automaton.ends
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if b - a < automaton.shortest:
            continue
        before, held = 0, 0
        for i, (length, state) in enumerate(automaton.statistics(codes[a:b].tolist()), a + 1):
            if ends[state]:
                places += [(p, i - n) for p, n in ends[state] if n <= length]
            if length <= before and before >= LEAST_MATCH:  # the run before cannot go on
                anchors += [(t, i - 1 - before, e - before, before) for t, e in automaton.places[held]]
            before, held = length, state
        if before >= LEAST_MATCH:
            anchors += [(t, b - before, e - before, before) for t, e in automaton.places[held]]
    return places, anchors


def chained(anchors: list[tuple[int, int, int]], gap: int = GAP) -> list[tuple[int, int, int, int, int]]:
    """Spans (start, end, template start, template end, words covered) of one template's anchors
    (start, template start, words): disjoint chains, those of the most words first. Words that two
    neighbours of a chain share count once."""
    anchors = sorted(set(anchors))
    score = [n for _, _, n in anchors]
    back = [-1] * len(anchors)
    first = 0
    most = max((n for _, _, n in anchors), default=0)
    for j, (start, at, n) in enumerate(anchors):
        while anchors[first][0] + most + gap < start:
            first += 1
        for i in range(first, j):
            s, a, m = anchors[i]
            # What the later one brings beyond the earlier one's end in either text.
            shared = max(0, s + m - start, a + m - at)
            if s < start and a < at and shared < n and start - s - m <= gap and at - a - m <= gap:
                if score[i] + n - shared > score[j]:
                    score[j], back[j] = score[i] + n - shared, i
    spans, used = [], [False] * len(anchors)
    for j in sorted(range(len(anchors)), key=lambda j: (-score[j], j)):
        if used[j]:
            continue
        chain = [j]
        while back[chain[-1]] >= 0 and not used[back[chain[-1]]]:
            chain.append(back[chain[-1]])
        for i in chain:
            used[i] = True
        rest = back[chain[-1]]
        covered = score[j] - (score[chain[-1]] - anchors[chain[-1]][2] if rest >= 0 else 0)
        (s, a, _), (t, b, n) = anchors[chain[-1]], anchors[j]
        spans.append((s, t + n, a, b + n, covered))
    return spans


def _outermost(spans):
    """Spans (template, start, end, ...) without those inside a larger one of the same template."""
    out: list[tuple] = []
    for span in sorted(spans, key=lambda s: (s[0], s[1], -s[2])):
        if not out or out[-1][0] != span[0] or span[2] > out[-1][2]:
            out.append(span)
    return out


def spans_of(automaton: Automaton, anchors, share: float, long_cover: int):
    """Spans (template, start, end, template start, template end, covered) that count."""
    by: dict[int, list[tuple[int, int, int]]] = {}
    for template, *anchor in anchors:
        by.setdefault(template, []).append(tuple(anchor))
    found = []
    for template, own in by.items():
        least = min(long_cover, share * automaton.sizes[template])
        found += [(template, *s) for s in chained(own) if s[4] >= least]
    return sorted(_outermost(found), key=lambda s: s[1:3] + s[:1])


def scanned(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: list[tuple[str, str]] = PHRASES,
    share: float = SHARE,
    long_cover: int = LONG_COVER,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``places`` (label and first word of each phrase found, by place) and
    ``spans`` (label, first word and end in the text, first word and end in the template, words
    covered and their share of the template) for every row of ``docs`` (``doc_id``, ``text``).
    ``templates``: (label, text); ``phrases``: (text, label)."""
    automaton = Automaton([words(t.encode()) for _, t in templates], [words(p.encode()) for p, _ in phrases])
    label_of = [label for label, _ in templates]
    place_of = [label for _, label in phrases]
    kind = docs.schema["doc_id"].dataType.simpleString()
    place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
    numbers = ["start", "end", "template_start", "template_end", "covered"]
    span = pa.list_(
        pa.struct([("label", pa.string()), *((n, pa.int64()) for n in numbers), ("share", pa.float64())])
    )

    def one(text: bytes):
        number = automaton.number.get
        parts = [np.zeros(0, np.int32)]
        for some in words_of(text.translate(_BYTES)):
            parts.append(np.fromiter((number(w, 0) for w in some), np.int32, len(some)))
        codes = np.concatenate(parts)
        places, anchors = scan(automaton, codes)
        spans = spans_of(automaton, anchors, share, long_cover)
        return (
            len(codes),
            [{"label": place_of[p], "start": s} for p, s in sorted(places, key=lambda x: x[::-1])],
            [
                {"label": label_of[t], **dict(zip(numbers, s, strict=True)), "share": s[4] / automaton.sizes[t]}
                for t, *s in spans
            ],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text", raw=True):
            found = [one(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], place),
                    pa.array([f[2] for f in found], span),
                ],
                names=["doc_id", "n_words", "places", "spans"],
            )

    longs = ", ".join(f"{n}: long" for n in numbers)
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_words long, places array<struct<label: string, start: long>>, "
        f"spans array<struct<label: string, {longs}, share: double>>",
    )


def license_report(docs: DataFrame) -> DataFrame:
    """Phrases and spans of every text in figures; ``score`` is the largest share of a template that
    a span covers, 1 for a phrase."""
    labels = lambda *cols: F.array_join(F.array_sort(F.array_distinct(F.concat(*cols))), ",")
    spans = F.coalesce(F.array_max("spans.share"), F.lit(0.0))
    return scanned(docs).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        labels("places.label").alias("base_labels"),
        labels("places.label", "spans.label").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(spans).alias("score"),
    )
