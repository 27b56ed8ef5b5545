import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from provender.llm import rebuilding, trie


def nodes_by_hand(seqs):
    """Every prefix of every sequence, one at a time; an item is (name, weight)."""
    through = defaultdict(set)
    for s, items in seqs.items():
        for d in range(len(items) + 1):
            through[tuple(items[:d])].add(s)
    out = set()
    for prefix, ids in through.items():
        below = [p for p in through if p[:len(prefix)] == prefix]
        leaf = lambda p: not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in through)
        ends = sorted(s for s in ids if len(seqs[s]) == len(prefix))
        out.add((min(ids), len(prefix), min(through[prefix[:-1]]) if prefix else None, len(ids),
                 sum(len(p) == len(prefix) + 1 for p in below), sum(map(leaf, below)),
                 sum((len(through[p]) - 1) * p[-1][1] for p in below if p),
                 hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def tables(spark, seqs):
    items = [(s, i + 1, name, w) for s, seq in seqs.items() for i, (name, w) in enumerate(seq)]
    return (spark.createDataFrame(items, "seq_id long, at long, item string, weight long").repartition(3),
            spark.createDataFrame([(s, len(q)) for s, q in seqs.items()], "seq_id long, n long"))


def some(seed, n, names, longest):
    pick = random.Random(seed)
    return {i * 3 - 40: [(name, len(name)) for name in (pick.choice(names) for _ in range(pick.randrange(longest + 1)))] for i in range(n)}


@pytest.mark.parametrize("capacity", [1, 3, 20, 4096])
def test_nodes(spark, capacity, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 4)
    seqs = some(capacity, 60, ["a", "bb", "ccc"], 7)
    seqs[1000] = [("a", 1)] * 23  # one much longer than the others
    got = [tuple(r) for r in trie.trie_nodes(*tables(spark, seqs), capacity).select(*trie.NODE).collect()]
    assert len(got) == len(set(got)) and set(got) == nodes_by_hand(seqs)


def test_crowd_of_equal_sequences(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    seqs = {i: [("x", 2), ("y", 3), ("z", 5)] for i in range(200)} | {i: [] for i in range(-60, 0)} | {500: [("x", 2), ("q", 1)]}
    got = {tuple(r) for r in trie.trie_nodes(*tables(spark, seqs), 10).select(*trie.NODE).collect()}
    assert got == nodes_by_hand(seqs)


def test_few_or_none(spark):
    for seqs in ({5: []}, {5: [("a", 1)]}, {5: [], 6: []}):
        got = {tuple(r) for r in trie.trie_nodes(*tables(spark, seqs)).select(*trie.NODE).collect()}
        assert got == nodes_by_hand(seqs)
    empty = (spark.createDataFrame([], "seq_id long, at long, item string, weight long"), spark.createDataFrame([], "seq_id long, n long"))
    assert trie.trie_nodes(*empty).collect() == []


def test_sweep_of_one_container():
    a, b, c = (1, 1, 5), (2, 2, 7), (3, 3, 11)
    nodes = trie.sweep_container({9: [a, b], 4: [a, c], 7: [a, b]}, 3)
    none, two = hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"7,9").hexdigest()
    assert sorted(nodes) == sorted([(4, 3, None, 3, 2, 2, 17, none), (7, 4, 4, 2, 0, 1, 7, two),
                                    (4, 4, 4, 1, 0, 1, 0, hashlib.sha256(b"4").hexdigest())])


def test_numbers_in_groups_of_any_size(spark):
    pick = random.Random(8)
    rows = [(pick.choice([1, 1, 1, 2, 3, None]), pick.choice([None, 1, 2, 3]), f"i{pick.randrange(50)}") for _ in range(400)]
    df = spark.createDataFrame(rows, "g long, t long, item string").repartition(6)
    got = defaultdict(list)
    for r in trie.numbered(df, "g", ["t", "item"]).where("g is not null").collect():
        got[r.g].append((r["at"], (r.t is not None, r.t or 0, r.item)))
    for g, found in got.items():
        found.sort()
        assert [at for at, _ in found] == list(range(1, len(found) + 1))
        assert [v for _, v in found] == sorted((t is not None, t or 0, i) for h, t, i in rows if h == g)


def rebuilt_by_hand(turns):
    """Sequences of (role, text) by conversation, in the order that the operator states."""
    own = defaultdict(list)
    for c, t, role, text in turns:
        role, text = role or "", text or ""
        if c is not None:
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), len(text.encode())))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        giver = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(giver, [])[:h] + v[h:]
    return out


def test_rebuilt_conversations(spark, monkeypatch):
    for module in (trie,):
        monkeypatch.setattr(module, "CHUNK", 4)
    pick = random.Random(9)
    turns = [(c, t, pick.choice(["user", "assistant", None]), pick.choice([None, "", "ä", "hello", "bye"]))
             for c in [*range(-7, 40), 101, 102] for t in range(pick.randrange(14)) if c != 10]
    turns += [(3, None, "user", "first"), (3, None, None, None), (3, 2, "user", "again"), (None, 1, "user", "lost")]
    turns += [(25, 100 + t, "user", f"t{t}") for t in range(40)]
    df = spark.createDataFrame([(*t, 1, "x") for t in turns], "conv_id long, turn long, role string, text string, at int, item string")
    items, members = rebuilding.rebuilt(df.repartition(4))
    got = {r.seq_id: {} for r in members.collect()}
    for r in items.collect():
        got[r.seq_id][r["at"]] = (r.item, r.weight)
    want = rebuilt_by_hand(turns)
    assert {c: [v[i] for i in range(1, len(v) + 1)] for c, v in got.items()} == want
    assert {r.seq_id: r.n for r in members.collect()} == {c: len(v) for c, v in want.items()}
    nodes = {tuple(r) for r in trie.trie_nodes(items, members, 12).select(*trie.NODE).collect()}
    assert nodes == nodes_by_hand(want)
    empty = rebuilding.rebuilt(df.where(F.lit(False)))
    assert trie.trie_nodes(*empty).collect() == []
