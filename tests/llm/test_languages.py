import zlib

import pytest
from pyspark.sql import functions as F

from provender.llm import languages

from .test_pipeline import WORDS


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, lang string, lang_pred string, score int").repartition(4)


def made(n=160):
    out = []
    for i in range(n):
        lang = sorted(WORDS)[i % 4]
        out.append((i, " ".join(WORDS[lang][(i * 3 + j * j) % len(WORDS[lang])] for j in range(8 + i % 50)), lang))
    return out


ODD = [(1000, None, "en"), (1001, "", None), (1002, "12 !? 34", "en"), (1003, "ß", None), (1004, "the of " * 200_000, None), (1005, "漢字", None)]


def test_held_out_accuracy(spark):
    docs = table(spark, made() + ODD)
    model = languages.train(docs, ~languages.held_out(F.col("doc_id")), per_language=50)
    out = {r.doc_id: r for r in languages.identify(docs, model).select("*", languages.held_out(F.col("doc_id")).alias("h")).collect()}
    assert len(out) == 166
    truth = {i: lang for i, _, lang in made()}
    assert all(out[i].h == (zlib.crc32(str(i).encode()) % 4 == 2) for i in out)
    held = [i for i in truth if out[i].h]
    assert held and sum(out[i].lang_pred == truth[i] for i in held) / len(held) > 0.95
    assert all((out[i].lang_pred, out[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert out[1004].lang_pred == "en" and out[1003].lang_pred in WORDS and out[1005].lang_pred in WORDS
    assert all(0 <= r.score <= 1 for r in out.values())


def test_learns_nothing_from_held_out_rows(spark):
    rows = made(80)
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    model = languages.train(table(spark, wrong), ~languages.held_out(F.col("doc_id")), per_language=50)
    assert "zz" not in {lang for langs in model.families.values() for lang in langs}


@pytest.mark.parametrize("rows,answer", [([], None), ([(1, "abc", None)], "und"), ([(1, "abc", "en"), (3, "def", "en")], "en")])
def test_little_to_learn(spark, rows, answer):
    docs = table(spark, rows)
    out = languages.identify(docs, languages.train(docs, F.lit(True))).collect()
    assert [r.lang_pred for r in out] == [answer] * len(rows)


def test_long_texts_are_read_whole():
    import numpy as np

    rng = np.random.default_rng(0)
    weights = rng.normal(size=(languages.WIDTH, 1)).astype(np.float32)
    text = bytes(rng.integers(97, 122, 5000, dtype=np.uint8))
    whole = weights[languages.features(text)].mean(dtype=np.float64)
    for step in (3, 512, 5001, 10_000):
        assert abs(whole - languages._mean_weights(text, weights, step)) < 1e-9


def test_sample_is_bounded_by_different_texts(spark, monkeypatch):
    rows = [(i, "always the same text again", "en") for i in range(3000)] + [(i, f"text number {i} of the others", "en") for i in range(3000, 6000)]
    rows += [(i, f"ein anderer satz {i} noch", "de") for i in range(6000, 6500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    seen, fit = [], languages._fit
    monkeypatch.setattr(languages, "_fit", lambda a, b, left, right, *rest: seen.append((len(left), len(right))) or fit(a, b, left, right, *rest))
    languages.train(df, F.lit(True), per_language=50)
    assert seen and all(n <= 50 for pair in seen for n in pair)
