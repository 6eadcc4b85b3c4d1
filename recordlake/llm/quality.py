"""Quality rules as a short-circuit cascade ordered by rejections per cost."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from recordlake.llm.frames import annotate

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SAMPLE_ROWS = 200

FIELDS = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "base_failed": "boolean",
    "kept": "boolean",
}


class Text:
    """One text with the figures of the base, each computed once."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.raw = self.text.encode("utf-8", "surrogatepass")
        # bytes.split() splits at exactly \x20 and \x09-\x0D
        self.words = self.raw.split()
        self.n_words = len(self.words)
        blanks = len(self.raw) - sum(map(len, self.words))
        self.word_chars = len(self.text) - blanks
        self.n_symbols = len(self.raw) - len(self.raw.translate(None, SYMBOLS))
        lines = [line for line in self.raw.split(b"\n") if line and not line.isspace()]
        self.n_lines = len(lines)
        self.n_dup_lines = len(lines) - len(set(lines))
        self.n_repeat_words = repeated_words(self.words)

    @property
    def base_failed(self) -> bool:
        return (
            self.n_words < MIN_WORDS
            or 100 * self.n_repeat_words > MAX_REPEATED_PERCENT * self.n_words
        )


def repeated_words(words: list[bytes]) -> int:
    """Words standing in a 3-word window that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen: set = set()
    again: set = set()
    if len(set(windows)) == len(windows):
        return 0
    for window in windows:
        (again if window in seen else seen).add(window)
    count, covered = 0, 0  # covered: first word not yet counted
    for i, window in enumerate(windows):
        if window in again:
            count += i + 3 - max(i, covered)
            covered = i + 3
    return count


@dataclass(frozen=True)
class QualityRule:
    """A named test; ``passes`` is true for a text worth keeping."""

    name: str
    passes: Callable[[Text], bool]


def few_symbols(t: Text) -> bool:
    return 10 * t.n_symbols <= 2 * t.n_words


def usual_word_length(t: Text) -> bool:
    return 2 * t.n_words <= t.word_chars <= 15 * t.n_words


def few_exclamations(t: Text) -> bool:
    return 2 * t.raw.count(b"!") <= t.n_words


def few_capitals(t: Text) -> bool:
    """At most six in ten of the letters A-Z and a-z are capitals."""
    upper = len(t.raw) - len(t.raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(t.raw) - len(t.raw.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    return 10 * upper <= 6 * (upper + lower)


def few_repeated_lines(t: Text) -> bool:
    return 10 * t.n_dup_lines <= 7 * t.n_lines


def mostly_words(t: Text) -> bool:
    """At least four in ten words hold an ASCII letter or a non-ASCII character."""
    plain = sum(1 for w in t.words if w.isascii() and w.lower() == w.upper())
    return 10 * plain <= 6 * t.n_words


RULES = (
    QualityRule("few_symbols", few_symbols),
    QualityRule("usual_word_length", usual_word_length),
    QualityRule("few_exclamations", few_exclamations),
    QualityRule("few_capitals", few_capitals),
    QualityRule("few_repeated_lines", few_repeated_lines),
    QualityRule("mostly_words", mostly_words),
)


class Cascade:
    """Rules run in turn until one rejects.

    Over the first ``sample_rows`` texts it is given, every rule is run and
    timed; from then on the rules run by rejections per second spent, most
    first. All rules must pass, so the order changes only the time.
    """

    def __init__(self, rules=RULES, sample_rows: int = SAMPLE_ROWS, clock=time.perf_counter_ns):
        self.rules = list(rules)
        self.left = sample_rows
        self.clock = clock
        self.cost = {r.name: 0 for r in rules}
        self.rejections = {r.name: 0 for r in rules}

    def keeps(self, text: Text) -> bool:
        if self.left <= 0:
            return all(rule.passes(text) for rule in self.rules)
        self.left -= 1
        verdict = True
        for rule in self.rules:
            start = self.clock()
            passed = rule.passes(text)
            self.cost[rule.name] += self.clock() - start
            self.rejections[rule.name] += not passed
            verdict &= passed
        if not self.left:
            self.rules.sort(key=self.rank)
        return verdict

    def rank(self, rule: QualityRule) -> tuple:
        """Most rejections per cost first; of those that rejected nothing, the cheapest."""
        cost = max(1, self.cost[rule.name])
        return (-self.rejections[rule.name] / cost, cost)


def judge_quality(
    df: DataFrame,
    text: str = "text",
    *,
    rules: tuple[QualityRule, ...] = RULES,
    sample_rows: int = SAMPLE_ROWS,
    keep: list[str] | None = None,
) -> DataFrame:
    """The base figures of every whole text, and whether it is kept.

    Base: at least 50 words, and at most half of them in repeated 3-word
    windows. What passes it goes through the cascade of ``rules``. Each task
    takes the first ``sample_rows`` texts it meets as the sample that cost and
    selectivity are estimated on; the verdict does not depend on it.

    A null or empty text has no words, so it fails the base. Rows are judged
    one by one: ties, repeated rows and empty tables need no special case.
    ``keep`` names the columns to carry (all if None); columns named like a
    result are replaced by it.
    """
    rules = tuple(rules)

    def make():
        cascade = Cascade(rules, sample_rows)

        def row(value):
            t = Text(value)
            failed = t.base_failed
            return (
                t.n_words,
                t.word_chars,
                t.n_symbols,
                t.n_dup_lines,
                t.n_repeat_words,
                failed,
                not failed and cascade.keeps(t),
            )

        return row

    return annotate(df, make, FIELDS, [text], keep)
