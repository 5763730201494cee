"""Quality rules: a decision list learned from labelled statistics of texts.

Sequential covering: a rule is grown, one threshold condition after the other, until it covers
no good document of the growing part; it is pruned from its end on the other part; rules are
added while the pruned rule is precise enough. The list becomes one ordered ``CASE WHEN`` of
Spark, so judging a corpus is a plain projection over its statistics.

A NULL or empty text has no words; ties between thresholds go to the first by (feature,
threshold). With no labels, or labels of one class only, the list is empty and everything that
passes the base rules is kept. Extra columns are ignored; repeated rows each give a row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import bounded_sample, one_label, slices
from txnmart.scratch import staged

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct", "n_upper", "n_alpha", "n_digit", "n_marks")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_MARKS = re.compile(r"[!?]")
_CHARS = re.compile(r"[^\x20\x09-\x0D]")
_UPPER = re.compile(r"[A-Z]")
_ALPHA = re.compile(r"[^\W\d_]")
_DIGIT = re.compile(r"[0-9]")


def text_counts(text: str) -> tuple[int, ...]:
    """The counts of COUNTS and MORE for one text."""
    words = text.encode().split()
    n = len(words)
    lines = text.split("\n")
    seen: set[str] = set()
    filled = duplicates = 0
    for line in lines:
        if line.encode().split():
            filled += 1
            duplicates += line in seen
            seen.add(line)
    repeated = 0
    if n >= 3:
        code: dict[bytes, int] = {}
        ids = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, n)
        kinds = len(code)
        # Three steps of pairing keep every window's number below n * kinds.
        window = ids[:-1] * kinds + ids[1:]
        _, window = np.unique(window, return_inverse=True)
        window = window[:-1] * kinds + ids[2:]
        _, window, times = np.unique(window, return_inverse=True, return_counts=True)
        again = times[window] > 1
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= again
        repeated = int(covered.sum())
        distinct = kinds
    else:
        distinct = len(set(words))
    return (
        n,
        len(_CHARS.findall(text)),
        len(_SYMBOLS.findall(text)),
        duplicates,
        repeated,
        filled,
        distinct,
        len(_UPPER.findall(text)),
        len(_ALPHA.findall(text)),
        len(_DIGIT.findall(text)),
        len(_MARKS.findall(text)),
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every document, written to the scratch folder."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = (*COUNTS, *MORE)

    def count(batches):
        for part, texts in slices(batches, "text"):
            rows = list(zip(*[text_counts(t) for t in texts], strict=True))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in rows]],
                names=["doc_id", *names],
            )

    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names)
    return staged(docs.select("doc_id", "text").mapInArrow(count, schema), "text-statistics")


#: What conditions test: shares that mean the same for short and long texts.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "upper_share": ("n_upper", "n_alpha"),
    "digit_share": ("n_digit", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "alpha_share": ("n_alpha", "word_chars"),
    "distinct_share": ("n_distinct", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "words": ("n_words", None),
}


def features() -> dict[str, Column]:
    def share(top: str, under: str | None) -> Column:
        return F.col(top).cast("double") / (F.greatest(F.col(under), F.lit(1)) if under else F.lit(1))

    return {name: share(*of) for name, of in FEATURES.items()}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value <= threshold
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        v = values[self.feature]
        return v >= self.threshold if self.above else v <= self.threshold

    def column(self, columns: dict[str, Column]) -> Column:
        c = columns[self.feature]
        return c >= self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(values)
    return out


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    """Add the condition of most information gain until no good document is covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < most:
        p, n = int((bad & inside).sum()), int((~bad & inside).sum())
        if n == 0 or p == 0:
            break
        before = np.log2(p / (p + n))
        best: tuple[float, Condition | None] = (1e-9, None)
        for name, all_values in values.items():
            v, y = all_values[inside], bad[inside]
            order = np.argsort(v, kind="stable")
            v, y = v[order], y[order]
            ends = np.flatnonzero(np.append(v[1:] != v[:-1], True))  # the last of each value
            up_p, up_n = np.cumsum(y)[ends], np.cumsum(~y)[ends]
            middle = (v[ends[:-1]] + v[ends[1:]]) / 2
            for above in (True, False):
                tp = (p - up_p[:-1]) if above else up_p[:-1]
                tn = (n - up_n[:-1]) if above else up_n[:-1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(tp > 0, tp * (np.log2(tp / (tp + tn)) - before), 0.0)
                if len(gain) and gain.max() > best[0]:
                    best = (float(gain.max()), Condition(name, above, float(middle[gain.argmax()])))
        if best[1] is None:
            break
        rule += (best[1],)
        inside &= best[1].holds(values)
    return rule


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest head of the rule with the best (p - n) / (p + n) on the other part."""

    def worth(head: Rule) -> float:
        inside = _covers(head, values, len(bad))
        p, n = int((bad & inside).sum()), int((~bad & inside).sum())
        return (p - n) / (p + n) if p + n else -1.0

    heads = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(heads, key=lambda h: (worth(h), -len(h)))


def learn_rules(
    values: dict[str, np.ndarray],
    bad: np.ndarray,
    precision: float = 0.98,
    least: int = 4,
    most_rules: int = 24,
    most_conditions: int = 4,
    seed: int = 3,
) -> list[Rule]:
    """Rules for ``bad`` documents, in the order they were learned. A rule must cover
    ``least`` bad documents of what is left, with this precision over all of it."""
    rng = np.random.default_rng(seed)
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    misses = 0
    while len(rules) < most_rules and misses < 3 and (bad & left).sum() >= least:
        part = rng.random(len(bad)) < 2 / 3
        take = lambda where: ({k: v[where] for k, v in values.items()}, bad[where])
        rule = _grow(*take(left & part), most_conditions)
        if rule:
            rule = _prune(rule, *take(left & ~part))
        inside = _covers(rule, values, len(bad)) & left if rule else np.zeros(len(bad), bool)
        p, n = int((bad & inside).sum()), int((~bad & inside).sum())
        if p < least or p < precision * (p + n):
            misses += 1  # another split may find a better rule
            continue
        misses = 0
        rules.append(rule)
        left &= ~inside
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional: the number of the first rule that holds, else NULL."""
    columns = features()
    out: Column | None = None
    for number, rule in enumerate(rules, 1):
        holds = rule[0].column(columns)
        for c in rule[1:]:
            holds &= c.column(columns)
        out = F.when(holds, number) if out is None else out.when(holds, number)
    return out if out is not None else F.lit(None).cast("int")


def fit_decision_list(
    statistics: DataFrame, labels: DataFrame, label: str = "quality", bound: int = 20_000
) -> list[Rule]:
    """Learn the list from ``bound`` labelled documents at most; label 0 is bad."""
    known = statistics.join(one_label(labels, label), "doc_id")
    rows = bounded_sample(known, "doc_id", bound).select(
        "doc_id", (F.col(label) == 0).alias("bad"), *[c.alias(n) for n, c in features().items()]
    )
    got = rows.toPandas().sort_values("doc_id", kind="stable")
    bad = got["bad"].to_numpy(bool)
    if not bad.any() or bad.all():
        return []
    return learn_rules({n: got[n].to_numpy(float) for n in FEATURES}, bad)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, base verdict, the learned rule that rejects (if any) and ``kept``."""
    statistics = text_statistics(docs)
    rules = fit_decision_list(statistics, labels)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rule = verdict(rules)
    return statistics.select(
        "doc_id",
        *COUNTS,
        failed.alias("base_failed"),
        (~failed & rule.isNull()).alias("kept"),
        rule.cast("int").alias("rule"),
    )
