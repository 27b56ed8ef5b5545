import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from provender.llm import packing, token_files
from provender.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = ["", " ", "a", " a", "a ", "a  b", "a \nb", "a\n \n b", "it's  'quoted' don't", "x" * 3000, "a  b", "\x1c a \x1cb",
         "é è ü 漢字 仮名", "one <|endoftext|> two", "tab\t end\n", "\n\n  lead", "😀 😀  x", "1 22 333  4444", "a\r\n b \r\n",
         "x.y,z 12ab_3--4 (a)[b] {c}\n\nd don't '', ..'s \"q\"\nw A'B", "<|endoftext|>", "a<|endoftext|>b.c"]


def plain(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def as_bytes(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_library(text):
    assert Encoder(PATH).encode([text]) == [as_bytes(plain(text))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab' .\n\r\t\u00a0\u2003\x1c\x85é1漢²×…_\x00"), max_size=20), max_size=4))
def test_any_white_space(texts):
    assert SHARED.encode(texts) == [as_bytes(plain(t)) for t in texts]


SHARED = Encoder(PATH)


def test_small_room_forgets_and_stays_right():
    small = Encoder(PATH, room=2, room_chars=10)
    for _ in range(3):
        assert small.encode(["some words here", None, "other words"]) == [
            as_bytes(plain("some words here")), b"", as_bytes(plain("other words"))]


def test_binary_lengths():
    assert packing.binary_lengths(0, 8) == []
    assert packing.binary_lengths(21, 8) == [8, 8, 4, 1]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, length string")


def test_pieces_cover_each_document_once(spark):
    texts = [*TEXTS, None, "word " * 5000]
    rows = packing.pack(docs(spark, texts).repartition(3), PATH).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    for i, text in enumerate(texts):
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert b"".join(r.ids for r in mine) == as_bytes([*plain(text or ""), 1])
        at = 0
        for r in mine:
            assert (r.start, r.offset, len(r.ids)) == (at, 0, 4 * r.length)
            assert r.length & (r.length - 1) == 0 and r.length <= 2048
            assert r.doc_tokens == sum(x.length for x in mine)
            at += r.length


def test_repeated_rows_and_empty_table(spark):
    one = docs(spark, ["same text"])
    twice = packing.pack(one.union(one), PATH).collect()
    assert len(twice) == 2 * len(packing.pack(one, PATH).collect())
    assert len({r.sequence_id for r in twice}) == len(twice)
    assert packing.pack(one.limit(0), PATH).collect() == []


def test_width_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(docs(spark, ["a"]), PATH, width=1000)


def test_buckets_hold_one_length(spark, tmp_path):
    path = str(tmp_path / "buckets")
    packing.write_buckets(packing.pack(docs(spark, TEXTS), PATH, width=16), path)
    rows = spark.read.parquet(path).select("bucket", "length").collect()
    assert rows and all(r.bucket == r.length for r in rows)


def test_files_round_trip(spark, tmp_path):
    texts = [*TEXTS, None]
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs(spark, texts).repartition(5), path, PATH, shards=4)
    rows = {r.doc_id: r for r in token_files.read_tokens(spark, path).collect()}
    sums = {r.doc_id: r.ids_crc32 for r in token_files.with_checksum(token_files.read_tokens(spark, path)).collect()}
    at = 0
    for i, text in enumerate(texts):
        ids = [*plain(text or ""), 2]
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids) == (at, len(ids), ids)
        assert sums[i] == zlib.crc32(as_bytes(ids))
        at += len(ids)


def test_files_with_repeated_and_null_ids(spark, tmp_path):
    path = str(tmp_path / "tokens")
    rows = [(7, "a b")] * 50 + [(None, "c"), (1, None)]
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH, shards=3)
    read = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in read] == [None, 1] + [7] * 50
    assert [r.start for r in read] == [sum(x.n_tokens for x in read[:i]) for i in range(len(read))]


def test_files_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs(spark, ["a"]).limit(0), path, PATH, shards=2)
    assert token_files.with_checksum(token_files.read_tokens(spark, path)).collect() == []


def test_ids_are_dictionary_coded_with_page_index(spark, tmp_path):
    import pyarrow.parquet as pq

    path = tmp_path / "tokens"
    token_files.write_tokens(docs(spark, ["some text to write"] * 50), str(path), PATH, shards=1)
    file = next(f for f in path.iterdir() if f.suffix == ".parquet" and pq.ParquetFile(f).metadata.num_rows)
    columns = {c.path_in_schema: c for c in map(pq.ParquetFile(file).metadata.row_group(0).column, range(5))}
    ids = next(c for name, c in columns.items() if name.startswith("ids"))
    assert ids.has_dictionary_page and ids.has_offset_index
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings


def test_counts_read_no_ids(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs(spark, ["a"]), path, PATH, shards=1)
    plan = token_files.read_tokens(spark, path).select(F.sum("n_tokens"))._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan
