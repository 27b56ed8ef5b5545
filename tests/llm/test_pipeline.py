import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from provender.llm import languages, mixing, secrets, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the of and to in that is was for with as this from have they which".split(),
    "de": "der die und das nicht mit von sich auf ein eine wird auch durch ist".split(),
    "fr": "le la les des une est dans pour que qui avec sur pas nous être".split(),
    "es": "el los las una es en para que con por del como más pero ñandú".split(),
}


def documents():
    rows = []
    for i in range(120):
        lang = sorted(WORDS)[i % 4]
        text = " ".join(WORDS[lang][(i * 7 + j * (i % 5 + 1) + j * j) % len(WORDS[lang])] for j in range(60 + i))
        rows.append((i, text, lang if i % 9 else None, f"s{i % 3}" if i % 11 else None))
    rows += [(200 + i, rows[5][1], "de", "s0") for i in range(6)]
    rows += [(300, None, "en", "s1"), (301, "", "en", "s1"), (302, "12 34 ...", None, "s1")]
    rows += [(310, "the password=abcdefgh12345678 and " + "which they as was " * 20, "en", "s2")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def test_stages_one_by_one(spark, tmp_path):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name.replace(" ", "_"))
        stage(spark, docs, str(tmp_path)).write.parquet(out)
        docs = spark.read.parquet(out)
        seen.append(docs)
    told, single, hidden, mixed, packed = seen
    assert all(x.columns == docs_columns() for x in seen[:4])

    assert {r.doc_id for r in told.collect()} == {i for i, *_ in rows} - {300, 301, 302}
    assert all(r.lang for r in told.collect())
    texts = {i: t for i, t, *_ in rows}
    prints = {r.doc_id: simhash.text_fingerprint(texts[r.doc_id], 3) for r in told.collect()}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if root[j] < root[i] and (prints[i] ^ prints[j]).bit_count() <= 3:
                    root[i], changed = root[j], True
    kept = {i for i in prints if root[i] == i}
    assert {r.doc_id for r in single.collect()} == kept and not kept & set(range(200, 206))

    by_id = {r.doc_id: r for r in hidden.collect()}
    assert set(by_id) == kept
    assert all(by_id[i].text == texts[i] for i in kept if i != 310)
    assert by_id[310].text.startswith("the [secret] and ") and by_id[310].n_chars == len(by_id[310].text)

    copies = {r.doc_id: r.copies for r in mixing.mix(hidden).collect()}
    counted = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counted == {i: n for i, n in copies.items() if n}

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, n in counted.items():
        ids = [*library.encode(by_id[i].text, add_special_tokens=False).ids, 1]
        pieces = [r for r in packed.where(packed.doc_id == i).collect()] if i % 40 == 0 else []
        if pieces:
            assert sum(r.length for r in pieces) == n * len(ids)
            whole = sorted({(r.start, bytes(r.ids)) for r in pieces})
            assert b"".join(b for _, b in whole) == b"".join(x.to_bytes(4, "little") for x in ids)


def docs_columns():
    return ["doc_id", "text", "lang", "source", "n_chars"]


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "SimHash near-dedup", "secret scans", "mixing sources", "packing"]
    assert languages.UNKNOWN == "und" and secrets.RULES
