import random

import numpy as np
import pytest
import xxhash

from provender.llm import simhash
from provender.llm.components import components, smallest_reached


def print_by_hand(text, size=3):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components_by_hand(ids, prints, distance):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


TEXTS = [None, "", " \t\x0b", "One", "one TWO", "a b c", "É A\x1cb c d", "w " * 50, "x\x85y \xa0 z q", "the same words again and again " * 30]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text, monkeypatch):
    assert simhash.text_fingerprint(text, 3) == print_by_hand(text)
    monkeypatch.setattr(simhash, "STEP", 7)
    assert simhash.text_fingerprint(text, 3) == print_by_hand(text)


def test_documents(spark):
    pick = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[pick.choice(vocabulary) for _ in range(250)] for _ in range(6)]
    texts = list(TEXTS)
    for words in base:
        for _ in range(25):
            near = list(words)
            for _ in range(pick.randrange(3)):
                near[pick.randrange(len(near))] = pick.choice(vocabulary)
            texts.append(" ".join(near))
    rows = [(i * 7 + 3, t, "x", 1) for i, t in enumerate(texts)]
    pick.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, tie int").repartition(4)
    got = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    prints = {i: print_by_hand(t) for i, t, *_ in rows}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    wanted = components_by_hand(sorted(prints), prints, 3)
    assert {i: r.component_id for i, r in got.items()} == wanted
    kept = simhash.kept_documents(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({*wanted.values()})


@pytest.mark.parametrize("distance,segments", [(3, 2), (3, 4), (2, 2), (5, 3), (0, 1)])
def test_any_distance(spark, distance, segments):
    pick = random.Random(distance * 10 + segments)
    centres = [pick.getrandbits(64) for _ in range(8)]
    values = {c ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(5))) for c in centres for _ in range(20)}
    values |= {0, (1 << 64) - 1, 1 << 63}
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fingerprint long")
    got = {r.fingerprint & (2**64 - 1): r.root for r in simhash.near_fingerprints(df, distance, segments).collect()}
    wanted = components_by_hand(sorted(values), {v: v for v in values}, distance)
    assert set(got) == values
    groups, hand = {}, {}
    for v in values:
        groups.setdefault(got[v], set()).add(v)
        hand.setdefault(wanted[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, hand.values()))


def test_empty_null_and_repeated(spark):
    schema = "doc_id long, text string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a"), (5, "b c d"), (5, "b c d"), (6, "b c d"), (None, None)]
    out = simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in out) == [(0, 0), (0, 0), (5, 5), (5, 5), (6, 5)]
    kept = simhash.kept_documents(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 0, 5]


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    pick = random.Random(3)
    nodes = [pick.randrange(-10**9, 10**9) for _ in range(300)]
    pairs = {"path": list(zip(sorted(nodes), sorted(nodes)[1:], strict=False)), "star": [(nodes[0], n) for n in nodes],
             "random": [(pick.choice(nodes), pick.choice(nodes)) for _ in range(200)], "none": []}[kind]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long").repartition(6)).collect()}
    order = sorted({n for a, b in pairs if a != b for n in (a, b)})
    place = {n: i for i, n in enumerate(order)}
    real = [(place[a], place[b]) for a, b in pairs if a != b]
    root = smallest_reached(len(order), np.array([a for a, _ in real], int), np.array([b for _, b in real], int))
    assert got == {n: order[root[i]] for n, i in place.items()}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_kept_rows_of_an_id_with_several_texts(spark, parts):
    pick = random.Random(9)
    a, b, c = (" ".join(pick.choice("abcdefgh") * 3 + str(pick.randrange(99)) for _ in range(80)) for _ in range(3))
    rows = [(2, a, "x"), (5, a, "x"), (5, b, "x"), (9, c, "x"), (9, c, "y"), (9, c, "x"), (11, a, "x")]
    kept = set()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string, _row string").repartition(parts)
        got = simhash.kept_documents(df, 3, 3).collect()
        assert sorted((r.doc_id, r.text) for r in got) == sorted([(2, a), (5, b), (9, c)])
        kept.add(next(r._row for r in got if r.doc_id == 9))
    assert len(kept) == 1
