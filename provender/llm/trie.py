"""Prefix trie of many sequences as a burst trie.

Every sequence starts in one container under the root. A container that holds more rows
than its capacity bursts: its top becomes a head of the trie, and its suffixes are dealt
by their next item to new containers. Bursting looks at several depths at a time, twice as
many in each round, so a long common prefix costs rounds by its logarithm. What is left
lies in containers of bounded size: shards hold them, sort the suffixes of each and sweep
them once into finished nodes.

A node is known by its depth and a 128-bit hash of its path; the hash of the parent's path
follows from the node's own last item, so nothing has to walk up. A head's totals come
from below without a round per depth: each finished part of the trie is credited to one of
its sequences, suffix sums along that sequence carry it up, and the heads it passes
through add it. Long sequences and crowds of equal ones are cut into chunks everywhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provender.session import written

#: Rows of a container at most.
CAPACITY = 512
#: Positions of a sequence that are handled together.
CHUNK = 4096
#: Depths that the first round of bursting looks at.
FIRST_ROUND = 4
#: Parts into which rows that ask for one head are dealt.
SALTS = 16
#: Ids of a piece of text that is hashed.
PIECE = 8192

NODE = ["seq_id", "depth", "parent", "n_seqs", "n_children", "n_leaves", "saved", "ends_sha256"]
KEY = ["at", "k1", "k2"]


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Rows with ``at``, their place from 1 in their group by ``order`` (nulls first); a group may be of any size.

    The rows are range-sorted as a whole, so a huge group, or a huge tie in it, lies in
    many tasks; the numbers of a group's rows in earlier tasks are added afterwards. Rows
    equal in ``order`` must be equal altogether: which of them comes first is not defined.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            found = []
            for value in batch.column(group).to_pylist():
                n = n + 1 if value == last else 1
                last = value
                found.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int64()), pa.array([part] * len(found), pa.int64())],
                names=[*batch.schema.names, "place", "part"])

    placed = written(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                     .mapInArrow(place, f"{fields}, place bigint, part bigint"), "placed")
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(group, "part").agg(F.count("*").alias("n")).select(
        group, "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return placed.join(parts, [group, "part"]).select(*rows.columns, (F.col("place") + F.col("before")).alias("at"))


def chunk(at: Column) -> Column:
    return F.floor((at - 1) / CHUNK).cast("bigint")


def over_chunks(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """A row for each chunk of the places from ``first`` to ``last``; none if there is no such place."""
    return df.where(last >= first).withColumn("chunk", F.explode(F.sequence(chunk(first), chunk(last))))


def trie_nodes(items: DataFrame, members: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Nodes of the trie of all sequences, as ``NODE``.

    ``items``: ``seq_id, at, item, weight`` (``at`` 1, 2, ... without a gap; ``item`` any
    text that stands for the item; ``weight`` its tokens or bytes). ``members``: ``seq_id,
    n``, one row per sequence with its number of items, 0 included.

    A node is a distinct prefix. ``seq_id`` is its smallest member and ``parent`` its
    parent's; ``n_leaves`` counts nodes without children in its subtree, ``saved`` adds
    ``(n_seqs - 1) * weight`` over the subtree, ``ends_sha256`` hashes the ascending,
    comma-joined ids of the members that end there. The root has depth 0 and weight 0.
    Without members there are no nodes.
    """
    keyed = written(_with_keys(items, members), "keyed")
    head_rows, starts = _burst(keyed, members, capacity)
    swept = written(_sweep(keyed, starts), "swept")
    heads = written(_heads(head_rows, swept, members), "heads")

    below = heads.where("at > 0").select("seq_id", (F.col("at") - 1).alias("at"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
                                         F.col("at").alias("depth"))
    tops = swept.where("top")
    under = below.unionByName(tops.select("seq_id", (F.col("depth") - 1).alias("at"), F.col("p1").alias("k1"),
                                          F.col("p2").alias("k2"), "depth"))
    parents = written(_asking(under, heads.select(*KEY, F.col("seq_id").alias("parent")), "inner")
                      .select("seq_id", "depth", "parent"), "parents")
    same = ["seq_id", "depth"]
    inner = swept.where("not top").select(*NODE)
    attached = tops.drop("parent").join(parents, same).select(*NODE)
    upper = heads.withColumn("depth", F.col("at")).join(parents, same, "left").select(*NODE)
    return upper.unionByName(attached).unionByName(inner)


def _with_keys(items: DataFrame, members: DataFrame) -> DataFrame:
    """Items with the hash of the path to them, that of the path before, and their sequence's length."""
    rows = items.select(
        "seq_id", "at", chunk(F.col("at")).alias("chunk"), F.xxhash64("item", "at").alias("x1"),
        F.xxhash64("at", F.lit("path"), "item").alias("x2"), F.col("weight").cast("bigint").alias("weight"))
    along = Window.partitionBy("seq_id", "chunk").orderBy("at")
    before = Window.partitionBy("seq_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0).cast("bigint")
    chunks = rows.groupBy("seq_id", "chunk").agg(F.bit_xor("x1").alias("c1"), F.bit_xor("x2").alias("c2")).select(
        "seq_id", "chunk", *[F.coalesce(F.bit_xor(c).over(before), nothing).alias(c) for c in ("c1", "c2")])
    chunks = chunks.join(members.select("seq_id", "n"), "seq_id")
    walked = rows.withColumn("r1", F.bit_xor("x1").over(along)).withColumn("r2", F.bit_xor("x2").over(along))
    k1, k2 = F.col("r1").bitwiseXOR(F.col("c1")), F.col("r2").bitwiseXOR(F.col("c2"))
    return walked.join(chunks, ["seq_id", "chunk"]).select(
        "seq_id", "chunk", "at", "n", "weight", k1.alias("k1"), k2.alias("k2"),
        k1.bitwiseXOR(F.col("x1")).alias("p1"), k2.bitwiseXOR(F.col("x2")).alias("p2"))


def _asking(rows: DataFrame, of_key: DataFrame, how: str) -> DataFrame:
    """Rows with what is known of their key; ``of_key`` has few keys, each of which very many rows may have."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("seq_id"), F.lit(SALTS)).cast("int"))
    dealt = of_key.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return salted.join(dealt, [*KEY, "salt"], how).drop("salt")


def _burst(keyed: DataFrame, members: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame]:
    """Rows that lie at heads, and where each sequence enters its container."""
    low, width, active = 0, FIRST_ROUND, None
    head_rows, starts = [], []
    while True:
        high = low + width
        rows = keyed.where(F.col("at").between(low + 1, high))
        if active is not None:
            last = F.least(F.col("n"), F.lit(high))
            rows = rows.join(over_chunks(active, F.lit(low + 1), last).select("seq_id", "chunk"), ["seq_id", "chunk"], "left_semi")
        size = F.sum(F.col("n") - F.col("at") + 1)
        large = rows.groupBy(*KEY).agg(size.alias("size")).where(F.col("size") > capacity).select(*KEY, F.lit(True).alias("head"))
        told = written(_asking(rows, large, "left").withColumn("head", F.coalesce("head", F.lit(False))), "burst")
        head_rows.append(told.where("head"))
        entry = F.min(F.when(~F.col("head"), F.struct("at", "k1", "k2", "p1", "p2")))
        reached = written(told.groupBy("seq_id").agg(entry.alias("entry"), F.max("n").alias("n")), "reached")
        starts.append(reached.where("entry is not null").select("seq_id", "n", "entry.*"))
        active = reached.where(F.col("entry").isNull() & (F.col("n") > high)).select("seq_id", "n")
        if active.isEmpty():
            break
        low, width = high, 2 * width
    every = lambda tables: _union(tables)
    return every(head_rows), every(starts)


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


SWEPT = ("seq_id bigint, depth bigint, parent bigint, n_seqs bigint, n_children bigint, n_leaves bigint, saved bigint, "
         "ends_sha256 string, top boolean, p1 bigint, p2 bigint")


def _sweep(keyed: DataFrame, starts: DataFrame) -> DataFrame:
    """Finished nodes of all containers; the top of each knows its parent only by key."""
    entries = over_chunks(starts.select("seq_id", "n", F.col("at").alias("top_at"), F.col("k1").alias("t1"),
                                        F.col("k2").alias("t2"), F.col("p1").alias("u1"), F.col("p2").alias("u2")),
                          F.col("top_at"), F.col("n")).drop("n")
    rows = keyed.join(entries, ["seq_id", "chunk"]).where("at >= top_at").select(
        "top_at", "t1", "t2", "u1", "u2", "seq_id", "at", "k1", "k2", "weight")
    container = ["top_at", "t1", "t2"]

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        out: list[tuple] = []
        for (top_at, *_), held in groupby(lines(), key=lambda r: r[:3]):
            suffixes: dict[int, list[tuple[int, int, int]]] = {}
            for row in held:
                u1, u2 = row[3], row[4]
                suffixes.setdefault(row[5], []).append(row[7:])
            out += [(*node, node[1] == top_at, u1, u2) for node in sweep_container(suffixes, top_at)]
            if len(out) >= PIECE:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return rows.repartition(*container).sortWithinPartitions(*container, "seq_id", "at").mapInArrow(sweep, SWEPT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    names, types = zip(*(field.split() for field in SWEPT.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=list(names))


def sweep_container(suffixes: dict[int, list[tuple[int, int, int]]], top_at: int) -> list[tuple]:
    """Nodes of one container in one pass over its sorted suffixes.

    A suffix lists ``(k1, k2, weight)`` per place, from the container's top on; all
    suffixes share the top. A node is finished when the next suffix leaves it.
    """
    nodes: list[dict] = []
    path: list[dict] = []

    def leave(depth: int) -> None:
        while len(path) > depth:
            node = path.pop()
            node["saved"] += (node["n"] - 1) * node["weight"]
            if not node["children"]:
                node["leaves"] = 1
            if path:
                up = path[-1]
                up["leaves"] += node["leaves"]
                up["saved"] += node["saved"]

    before: list[tuple[int, int, int]] = []
    for seq, suffix in sorted(suffixes.items(), key=lambda s: s[1]):
        shared = 0
        while shared < len(before) and shared < len(suffix) and before[shared][:2] == suffix[shared][:2]:
            shared += 1
        leave(shared)
        for k in range(shared, len(suffix)):
            if path:
                path[-1]["children"] += 1
            node = {"seq": seq, "depth": top_at + k, "up": path[-1] if path else None, "n": 0, "children": 0,
                    "leaves": 0, "saved": 0, "weight": suffix[k][2], "ends": []}
            nodes.append(node)
            path.append(node)
        for node in path:
            node["n"] += 1
            node["seq"] = min(node["seq"], seq)
        path[-1]["ends"].append(seq)
        before = suffix
    leave(0)
    return [(n["seq"], n["depth"], n["up"]["seq"] if n["up"] else None, n["n"], n["children"], n["leaves"], n["saved"],
             hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest()) for n in nodes]


def _heads(head_rows: DataFrame, swept: DataFrame, members: DataFrame) -> DataFrame:
    """The root and all other heads with their totals, their key and their parent's key."""
    zero = F.lit(0).cast("bigint")
    found = head_rows.groupBy(*KEY).agg(
        F.min("seq_id").alias("seq_id"), F.count("*").alias("n_seqs"), F.max("weight").alias("weight"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    root = members.agg(F.min("seq_id").alias("seq_id"), F.count("*").alias("n_seqs")).where("n_seqs > 0").select(
        "seq_id", "n_seqs", *[zero.alias(c) for c in (*KEY, "weight", "p1", "p2")])
    heads = written(found.unionByName(root), "head-nodes")
    tops = swept.where("top")

    up = [(F.col("at") - 1).alias("at"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    under = heads.where("at > 0").select(*up).unionByName(tops.select((F.col("depth") - 1).alias("at"), *up[1:]))
    children = under.groupBy(*KEY).agg(F.count("*").alias("n_children"))
    heads = written(heads.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", zero)), "head-nodes")

    # What each sequence stands for at each place: heads of which it is the smallest member, and its container.
    own = heads.where("at > 0").select("seq_id", "at", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("leaves"),
                                       ((F.col("n_seqs") - 1) * F.col("weight")).alias("saved"))
    credit = written(own.unionByName(tops.select("seq_id", F.col("depth").alias("at"), F.col("n_leaves").alias("leaves"), "saved")), "credit")
    nothing = F.lit(None).cast("bigint")
    both = head_rows.select("seq_id", *KEY, zero.alias("leaves"), zero.alias("saved")).unionByName(
        credit.select("seq_id", "at", nothing.alias("k1"), nothing.alias("k2"), "leaves", "saved"))
    both = both.withColumn("chunk", chunk(F.col("at")))
    onward = Window.partitionBy("seq_id", "chunk").orderBy(F.col("at").desc())
    later = Window.partitionBy("seq_id").orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    chunks = credit.withColumn("chunk", chunk(F.col("at"))).groupBy("seq_id", "chunk").agg(
        F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    # A head row's chunk may hold no credit of its own, so chunks come from both sides.
    spans = both.groupBy("seq_id", "chunk").agg(F.max("at").alias("last")).drop("last").join(chunks, ["seq_id", "chunk"], "left")
    carried = spans.select("seq_id", "chunk", *[F.coalesce(F.sum(c).over(later), zero).alias(c) for c in ("l", "s")])
    summed = both.select("seq_id", "chunk", *KEY, *[F.sum(c).over(onward).alias(c) for c in ("leaves", "saved")]) \
        .where("k1 is not null").join(carried, ["seq_id", "chunk"])
    totals = summed.groupBy(*KEY).agg(F.sum(F.col("leaves") + F.col("l")).alias("n_leaves"),
                                      F.sum(F.col("saved") + F.col("s")).alias("saved"))
    whole = credit.agg(F.coalesce(F.sum("leaves"), zero).alias("n_leaves"), F.coalesce(F.sum("saved"), zero).alias("saved")) \
        .select(*[zero.alias(c) for c in KEY], F.greatest("n_leaves", F.lit(1).cast("bigint")).alias("n_leaves"), "saved")
    ends = head_rows.where("at = n").select(*KEY, "seq_id").unionByName(
        members.where("n = 0").select(*[zero.alias(c) for c in KEY], "seq_id"))
    return heads.join(totals.unionByName(whole), KEY).join(id_digests(ends, KEY), KEY, "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))


def id_digests(ids: DataFrame, key: list[str]) -> DataFrame:
    """SHA-256 of each key's ascending, comma-joined ``seq_id``; a key may have any number of them.

    Ids are range-sorted, so a huge key lies in many tasks that join its ids to texts;
    the texts alone meet in one task, which hashes them as they come and holds none.
    """
    kinds = ", ".join(f"{k} bigint" for k in key)
    names = [*key, "seq_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in names), strict=True)

        for of, held in groupby(lines(), key=lambda r: r[:-1]):
            piece: list[int] = []
            for row in held:
                piece.append(row[-1])
                if len(piece) == PIECE:
                    yield text(of, piece)
                    piece = []
            if piece:
                yield text(of, piece)

    def text(of: tuple, piece: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*(pa.array([v], pa.int64()) for v in (*of, piece[0])), pa.array([",".join(map(str, piece))])], names=[*names, "text"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in (*key, "text")), strict=True)

        for of, texts in groupby(lines(), key=lambda r: r[:-1]):
            found, glue = hashlib.sha256(), ""
            for row in texts:
                found.update((glue + row[-1]).encode())
                glue = ","
            yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in of), pa.array([found.hexdigest()])],
                                             names=[*key, "ends_sha256"])

    pieces = ids.repartitionByRange(*names).sortWithinPartitions(*names).mapInArrow(join, f"{kinds}, seq_id bigint, text string")
    return pieces.repartition(*key).sortWithinPartitions(*names).mapInArrow(digest, f"{kinds}, ends_sha256 string")
