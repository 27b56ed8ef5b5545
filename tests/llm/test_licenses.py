import re

from provender.llm import licenses

TEXTS = [
    None, "", "...", "the word license alone", "Released under the MIT License.", "mit license MIT-LICENSE mit é license",
    "a general public License and an apache\nlicense", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC 3.0.",
    "x " * 500 + "This work is licensed under the GNU General Public License, version 3.", "mit licenses", "license mit",
    "before. " + licenses.TEMPLATES[0].text + ". after", licenses.TEMPLATES[0].text.replace("hereby", "never"),
    "İ mıt lıcense public license general public license general public license", "apache license " * 300,
    licenses.TEMPLATES[5].text, "cc by nc 4 0",
]


def words(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)


def by_hand(text):
    ws, found = words(text), []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        found += [(label, i) for i in range(len(ws)) if ws[i:i + len(p)] == p]
    return len(ws), sorted(found)


def scan(spark, texts):
    rows = [(i, t, "keep", 3) for i, t in enumerate(texts)]
    return licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, _words string, score int").repartition(3))


def test_base_places(spark):
    rows = scan(spark, TEXTS).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        n, found = by_hand(TEXTS[r.doc_id])
        assert (r.n_words, sorted(map(tuple, r.places))) == (n, found), r.doc_id
        assert r.base_labels == ",".join(sorted({label for label, _ in found}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) and r._words == "keep"


def test_templates_need_key_phrases(spark):
    labels = {r.doc_id: r.labels for r in scan(spark, TEXTS).collect()}
    assert labels[7] == "cc-by-nc" and labels[8] == ""
    assert labels[12] == "mit" and labels[13] == "" and labels[16] == "bsd"
    assert labels[3] == ""


def test_every_template_finds_itself(spark):
    rows = scan(spark, [t.text for t in licenses.TEMPLATES]).collect()
    for r in rows:
        assert licenses.TEMPLATES[r.doc_id].label in r.labels.split(",")


def test_empty_table(spark):
    assert scan(spark, ["a"]).limit(0).collect() == []
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []
