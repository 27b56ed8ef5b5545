import random
import re
from collections import Counter

import numpy as np
import pytest

from provender.llm import quality


def counts_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + s for i, w in enumerate(windows) if times[w] > 1 for s in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    of = lambda pattern: len(re.findall(pattern, text))
    return (len(words), sum(map(len, words)), of(r"[#*$%&|<>]"), len(lines), len(lines) - len(set(lines)), len(covered),
            of("[A-Z]"), of("[a-z]"), of(r"[!-/:-@\[-`{-~]"), len(set(words)),
            sum(bool(re.fullmatch(r"[!-/:-@\[-`{-~]+", w)) for w in words))


TEXTS = [None, "", " \t\n\x0b", "one", "a b", "a b c", "a a a a", "a b c a b c", "x y  z", "É# <b>é\n\n é \né\né ",
         "a b c d\na b c d\n--- !! a|b\n", "\x1c \x85 \x85", "l\r\nl\r\nl\n", "w " * 500]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert quality.text_counts(None if text is None else text.encode()) == counts_by_hand(text)


def test_counts_of_random_texts():
    pick = random.Random(4)
    for _ in range(300):
        text = "".join(pick.choice(["a", "b", " ", " ", "\n", "#", "É", "AB", "!", "\t", " "]) for _ in range(pick.randrange(120)))
        assert quality.text_counts(text.encode()) == counts_by_hand(text)


def test_long_text_takes_time_by_its_length():
    import time

    def took(n):
        text = " ".join(f"w{i % 977}" for i in range(n)).encode()
        start = time.perf_counter()
        assert quality.text_counts(text)[0] == n
        return time.perf_counter() - start

    took(1000)
    assert took(1_200_000) < 8 * took(300_000)


def posterior_by_hand(votes, share, good, bad):
    a, b = share, 1 - share
    for v, g, w in zip(votes, good, bad, strict=True):
        if v:
            a *= g if v > 0 else 1 - g
            b *= w if v < 0 else 1 - w
    return a / (a + b)


def fit_by_hand(rows, steps):
    share, n, weight = quality.START_SHARE, len(rows[0]), quality.WEIGHT
    good, bad = [quality.START_GOOD] * n, [quality.START_BAD] * n
    for _ in range(steps):
        p = [posterior_by_hand(r, share, good, bad) for r in rows]
        good = [(sum(q for q, r in zip(p, rows, strict=True) if r[j] > 0) + weight * quality.START_GOOD)
                / (sum(q for q, r in zip(p, rows, strict=True) if r[j]) + weight) for j in range(n)]
        bad = [(sum(1 - q for q, r in zip(p, rows, strict=True) if r[j] < 0) + weight * quality.START_BAD)
               / (sum(1 - q for q, r in zip(p, rows, strict=True) if r[j]) + weight) for j in range(n)]
        share = (sum(p) + weight * quality.START_SHARE) / (len(rows) + weight)
    return share, good, bad


def test_fit_equals_one_document_at_a_time():
    pick = random.Random(5)
    rows = [tuple(pick.choice([1, 1, 0, -1]) for _ in range(4)) for _ in range(200)]
    seen = Counter(rows)
    votes, times = np.array(list(seen)), np.array(list(seen.values()), float)
    share, good, bad = quality.fit(votes, times, 12)
    by_hand = fit_by_hand(rows, 12)
    assert np.allclose([share, *good, *bad], [by_hand[0], *by_hand[1], *by_hand[2]], rtol=0, atol=1e-12)


def text_of(kind, pick):
    words = ["".join(pick.choice("abcdefghij") for _ in range(pick.randrange(3, 9))) for _ in range(200)]
    if kind == "symbols":
        return " ".join(w + "###" for w in words)
    if kind == "copied":
        return " ".join((words[:12] * 20)[:200])
    if kind == "shouting":
        return " ".join(w.upper() + "!!" for w in words[:20] * 10)
    return ". ".join(words)


def test_judgement(spark):
    pick = random.Random(6)
    kinds = ["clean"] * 120 + ["symbols"] * 12 + ["copied"] * 12 + ["shouting"] * 6
    rows = [(i, text_of(k, pick), i % 3, "x") for i, k in enumerate(kinds)] + [(None, None, 0, "y"), (7, "", 0, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, votes int, n_words string").repartition(5)
    out = quality.judge(docs).collect()
    assert len(out) == len(rows)
    kept = {r.doc_id: r.quality >= quality.LEAST for r in out if r.n_words}
    assert [kept[i] for i in range(len(kinds))] == [k == "clean" for k in kinds]
    for r in out:
        assert 0 <= r.quality <= 1
    assert quality.judge(docs.limit(0)).collect() == []


def test_vote_of_each_rule(spark):
    df = spark.createDataFrame([(10, 0), (60, 5), (200, 500)], "n_words long, word_chars long")
    got = [r.v for r in df.select(quality.vote(quality.Rule("r", "n_words > 100", "n_words < 50")).alias("v")).collect()]
    assert got == [-1, 0, 1]
