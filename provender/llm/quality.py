"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at counts of one text and votes good, bad, or not at all. What a rule's
vote is worth is not set by hand: a document's quality is a hidden class, and
expectation-maximisation finds the share of good documents and, for every rule, how often
it is right on good and on bad ones. A document stays when its posterior probability to be
good says so, not when every rule does.

The fit needs only how often each combination of votes occurs, at most ``3 ** rules``
numbers however many documents there are; that table is what reaches the driver, and what
goes back to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provender.session import written

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
TRAILING = bytes(range(0x80, 0xC0))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_marks",
          "n_distinct", "n_bare"]


@dataclass(frozen=True)
class Rule:
    """Conditions over the counts, in SQL; a rule that meets neither abstains."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "n_words >= 100", "n_words < 50"),
    Rule("word length", "word_chars >= 4 * n_words and word_chars <= 8 * n_words",
         "word_chars < 3 * n_words or word_chars > 10 * n_words"),
    Rule("symbols", "50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    Rule("repeated lines", "n_lines >= 3 and 10 * n_dup_lines <= n_lines", "n_lines >= 3 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("repeated words", "10 * n_repeat_words <= n_words", "10 * n_repeat_words > 3 * n_words"),
    Rule("capitals", "n_lower > 0 and 4 * n_upper <= n_lower", "n_upper > n_lower"),
    Rule("punctuation", "10 * n_marks <= word_chars", "4 * n_marks > word_chars"),
    Rule("vocabulary", "10 * n_distinct >= 6 * n_words", "n_words <= 2000 and 10 * n_distinct < 3 * n_words"),
    Rule("bare marks", "50 * n_bare <= n_words", "10 * n_bare > n_words"),
)
#: Steps of expectation-maximisation.
STEPS = 100
#: Where it starts: the share of good documents, and how often a rule is right on good and on bad ones.
#: A rule knows one kind of fault, so it seldom blames a good document and misses most bad ones.
START_SHARE, START_GOOD, START_BAD = 0.8, 0.99, 0.3
#: Documents that the start counts for in every step, so that no estimate reaches 0 or 1.
WEIGHT = 10.0
#: A posterior from here on keeps a document.
LEAST = 0.5


def text_counts(text: bytes | None) -> tuple[int, ...]:
    """The counts of one text in UTF-8, in the order of ``COUNTS``; memory and time grow with its length alone.

    Words are what ASCII white space separates. ``n_lines`` counts lines with a word,
    ``n_dup_lines`` those of them that equal an earlier one. ``n_repeat_words`` counts
    words that lie in a window of three words which the text holds twice or more,
    ``n_bare`` words of ASCII punctuation alone.
    """
    text = text or b""
    words = text.split()
    n = len(words)
    solid = text.translate(None, SPACE)
    lines = [line for line in text.split(b"\n") if line.translate(None, SPACE)]

    def of(kind: bytes) -> int:
        return len(solid) - len(solid.translate(None, kind))

    # A word's number is the place where it is first seen.
    first: dict[bytes, int] = {}
    numbers = np.fromiter(map(first.setdefault, words, count()), np.int64, n)
    repeated = 0
    if n > 3:  # windows are numbered pair by pair
        pairs = np.unique(numbers[:-1] * n + numbers[1:], return_inverse=True)[1]
        _, window, times = np.unique(pairs[:-1] * n + numbers[2:], return_inverse=True, return_counts=True)
        twice = times[window] > 1
        covered = np.zeros(n, dtype=bool)
        for shift in range(3):
            covered[shift:n - 2 + shift] |= twice
        repeated = int(covered.sum())
    return (n, len(solid) - of(TRAILING), of(SYMBOLS), len(lines), len(lines) - len(set(lines)), repeated,
            of(UPPER), of(LOWER), of(PUNCTUATION), len(first), sum(not w.strip(PUNCTUATION) for w in words))


def with_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every row's whole ``text``; null has none."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([text_counts(t.as_py()) for t in batch.column(1)], dtype=np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in found.T)], names=["doc_id", *COUNTS])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(made, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))


def vote(rule: Rule) -> Column:
    """1 for good, -1 for bad, 0 where the rule abstains."""
    return F.when(F.expr(rule.bad), -1).when(F.expr(rule.good), 1).otherwise(0)


def fit(votes: np.ndarray, times: np.ndarray, steps: int = STEPS) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of good documents, and per rule how often it is right on good and on bad ones.

    ``votes`` has a row per combination and a column per rule; ``times`` says how many
    documents vote so. Abstaining tells nothing about the class.
    """
    share = START_SHARE
    good, bad = np.full(votes.shape[1], START_GOOD), np.full(votes.shape[1], START_BAD)
    yes, no, total = votes > 0, votes < 0, float(times.sum())
    for _ in range(steps):
        belief = posterior(votes, share, good, bad)
        on_good, on_bad = times * belief, times * (1 - belief)
        good = (on_good @ yes + WEIGHT * START_GOOD) / (on_good @ (yes | no) + WEIGHT)
        bad = (on_bad @ no + WEIGHT * START_BAD) / (on_bad @ (yes | no) + WEIGHT)
        share = (on_good.sum() + WEIGHT * START_SHARE) / (total + WEIGHT)
    return share, good, bad


def posterior(votes: np.ndarray, share: float, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Probability of each combination of votes to come from a good document."""
    yes, no = votes > 0, votes < 0
    if_good = share * np.where(yes, good, np.where(no, 1 - good, 1.0)).prod(axis=1)
    if_bad = (1 - share) * np.where(no, bad, np.where(yes, 1 - bad, 1.0)).prod(axis=1)
    return if_good / (if_good + if_bad)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, steps: int = STEPS) -> DataFrame:
    """Every row of ``docs`` as ``doc_id``, its counts, ``votes`` (of the rules, in order) and ``quality``.

    ``quality`` is the posterior probability, 0 to 1. The rules are weighed on all rows,
    rows that repeat counting each. A null or empty text has no words and gets the votes
    that counts of zero lead to; a null id is kept as it is. An empty table gives no
    rows; extra columns are left out.
    """
    told = with_counts(docs).withColumn("votes", F.array(*[vote(r).cast("int") for r in rules]))
    told = written(told, "votes")
    # At most 3 ** len(rules) rows.
    seen = told.groupBy("votes").agg(F.count("*").alias("times")).orderBy("votes").collect()
    votes = np.array([r.votes for r in seen], dtype=np.int64).reshape(-1, len(rules))
    belief = posterior(votes, *fit(votes, np.array([r.times for r in seen], dtype=float), steps))
    table = docs.sparkSession.createDataFrame(
        [(r.votes, float(p)) for r, p in zip(seen, belief, strict=True)], "votes array<int>, quality double")
    return told.join(F.broadcast(table), "votes", "left").select("doc_id", *COUNTS, "votes", "quality")
