"""Near-duplicate embeddings: spherical k-means cells, then blocked cosines.

Vectors are compared within one label only. Equal vectors are one entry. Each entry
has a home, the cell whose centre it is nearest to, and also visits every cell that
could be the home of a near vector. The rule is exact: if x has home a, y has home b
and x, y lie within a distance d, then (x.a - x.b) + (y.b - y.a) = (a - b).(x - y) is
at most |a - b| d, so one of the two terms is at most half of it, and that vector
visits the other's home. A cell's residents and visitors are compared in blocks of
bounded size by matrix products; a block returns counts and a forest of its links,
never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provender.llm.components import components, smallest_reached
from provender.session import written

#: Vectors of a label from which its centres are fitted, about; and centres in all.
SAMPLE, CENTRES = 4096, 4096
#: Rows of a block.
BLOCK = 1024
#: Rounding that a bound must survive.
SLACK = 1e-9

Centres = dict[tuple[int, int], np.ndarray]


def valid(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, v``: rows with a label and a finite vector other than zero, as doubles."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), v.alias("v"))
        .where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    )


def near_embeddings(vectors: DataFrame, least: float = 0.93, block: int = BLOCK) -> DataFrame:
    """Every row of ``vectors`` as ``vec_id, n_links, component_id, kept``.

    Two rows link when their labels are equal and not null and their cosine in
    double precision is ``least`` or more (above 0). ``n_links`` counts other rows;
    ``kept`` marks the representative, the smallest id of its component. A row with a
    null label, or whose vector is null, zero, or holds a null or non-finite
    component, links with nothing. Vectors of different lengths never link. Rows that
    repeat are rows of their own and link with each other; a null id has no place in
    an order and links with nothing. An empty table gives no rows; extra columns are
    left out.
    """
    ok = valid(vectors).where(F.col("vec_id").isNotNull())
    entries = written(
        ok.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "entries")
    sizes = {(r.label, r.n): r.count_ for r in entries.groupBy("label", F.size("v").alias("n"))
             .agg(F.count("*").alias("count_")).where(F.col("count_") >= 2 * block).orderBy(F.desc("count_"))
             .limit(CENTRES // 2).collect()}
    centres = _fit(entries, sizes)
    cells = written(_placed(entries, centres, least), "cells")
    counts = cells.groupBy("label", "width", "cell").agg(
        F.count(F.when(F.col("resident"), 1)).alias("residents"), F.count("*").alias("members"))
    cut = counts.select("label", "width", "cell",
                        F.ceil(F.col("residents") / block).alias("rows"), F.ceil(F.col("members") / block).alias("others"))
    # Each resident meets every block of members, each member every block of residents.
    part = lambda n: F.pmod(F.xxhash64("id"), F.greatest(F.col(n), F.lit(1))).cast("int")
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.greatest(F.col(n).cast("int"), F.lit(1)) - 1))
    known = cells.join(cut, ["label", "width", "cell"]).where(F.col("rows") > 0)
    rows = known.where("resident").select("*", part("rows").alias("r"), up_to("others").alias("o")).withColumn("side", F.lit(0))
    others = known.select("*", part("others").alias("o"), up_to("rows").alias("r")).withColumn("side", F.lit(1))
    keys = ["label", "width", "cell", "r", "o"]
    chosen = [*keys, "side", "id", "copies", "home", "visits", "resident", "v"]
    out = written(
        rows.select(*chosen).unionByName(others.select(*chosen)).groupBy(*keys)
        .applyInPandas(_compare(least), "id bigint, n bigint, other bigint"), "compared")

    linked = out.groupBy("id").agg(F.sum("n").alias("n"))
    joined = components(out.where(F.col("other").isNotNull()).select(F.col("id").alias("a"), F.col("other").alias("b")))
    answer = (
        entries.select("label", "v", "id", "copies").join(linked, "id", "left")
        .join(joined.withColumnRenamed("node", "id"), "id", "left")
        .select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "id").alias("component_id"))
    )
    of_valid = ok.join(answer, ["label", "v"]).select("vec_id", "n_links", "component_id")
    rest = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding")
    finite = F.forall(F.col("embedding").cast("array<double>"),
                      lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(finite & F.exists(F.col("embedding").cast("array<double>"), lambda x: x != 0)
                      & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    alone = rest.where(~good).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return of_valid.unionByName(alone).select(
        "vec_id", F.col("n_links").cast("bigint").alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest part first, so that none overflows."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _fit(entries: DataFrame, sizes: dict[tuple[int, int], int], rounds: int = 8) -> Centres:
    """Centres of the labels that need more than a cell, fitted on about ``SAMPLE`` entries each.

    A label's cells grow with the square root of its entries, up to its part of
    ``CENTRES``. Which entries are sampled follows from a hash of the vector.
    """
    if not sizes:
        return {}
    total = sum(sizes.values())
    cells = {key: max(2, min(math.isqrt(n), CENTRES * n // total)) for key, n in sizes.items()}
    share = F.lit(0.0)
    for (label, width), n in sizes.items():
        share = F.when((F.col("label") == label) & (F.size("v") == width), min(1.0, SAMPLE / n)).otherwise(share)
    ticket = F.pmod(F.xxhash64("v"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    wanted = F.create_map(*[x for (label, width), k in cells.items() for x in (F.lit(f"{label}/{width}"), F.lit(k))])
    name = F.concat_ws("/", F.col("label").cast("string"), F.size("v").cast("string"))
    sample = entries.where(ticket < share).select("label", "v", F.element_at(wanted, name).alias("cells"),
                                                  F.size("v").alias("width"))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.stack(rows["v"].to_numpy()))
        x = x[np.lexsort(x.T[::-1])]
        k = min(int(rows["cells"].iloc[0]), len(x))
        c = x[np.random.default_rng(1).choice(len(x), k, replace=False)]
        for _ in range(rounds):
            at = (x @ c.T).argmax(axis=1)
            sums = np.zeros_like(c)
            np.add.at(sums, at, x)
            full = np.linalg.norm(sums, axis=1) > 1e-6
            c[full] = unit(sums[full])
        return pd.DataFrame({"label": rows["label"].iloc[0], "width": x.shape[1], "centres": [c.ravel()]})

    found = sample.groupBy("label", "width").applyInPandas(fit, "label bigint, width int, centres array<double>").collect()
    return {(r.label, r.width): np.array(r.centres).reshape(-1, r.width) for r in found}


def _placed(entries: DataFrame, centres: Centres, least: float) -> DataFrame:
    """One row per entry and cell it lives in or visits."""
    reach = math.sqrt(max(0.0, 2 - 2 * least))
    apart = {k: np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T))) for k, c in centres.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch.column("label"))
            lengths = np.diff(batch.column("v").offsets.to_numpy())
            for key in {*zip(label.tolist(), lengths.tolist(), strict=True)}:
                mine = np.flatnonzero((label == key[0]) & (lengths == key[1]))
                rows = batch.take(pa.array(mine))
                x = unit(rows.column("v").flatten().to_numpy().reshape(-1, key[1]))
                if key in centres:
                    near = x @ centres[key].T
                    home = near.argmax(axis=1)
                    gap = near[np.arange(len(x)), home][:, None] - near
                    visits = gap <= apart[key][home] * (reach / 2) + SLACK
                else:
                    home, visits = np.zeros(len(x), int), np.ones((len(x), 1), bool)
                visits[np.arange(len(x)), home] = True
                at, cell = np.nonzero(visits)
                packed = [np.packbits(v, bitorder="little").tobytes() for v in visits]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), key[0])), pa.array(np.full(len(at), key[1], dtype=np.int32)),
                    pa.array(cell.astype(np.int32)), pa.array(cell == home[at]), pa.array(home[at].astype(np.int32)),
                    pa.array([packed[i] for i in at], pa.binary()),
                    rows.column("id").take(pa.array(at)), rows.column("copies").take(pa.array(at)),
                    pa.array([x[i].tobytes() for i in at], pa.binary()),
                ], names=["label", "width", "cell", "resident", "home", "visits", "id", "copies", "v"])

    return entries.select("label", "id", "copies", "v").mapInArrow(
        place, "label bigint, width int, cell int, resident boolean, home int, visits binary, id bigint, copies bigint, v binary")


def _compare(least: float):
    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cell = int(key[2])
        a, b = rows[rows["side"] == 0], rows[rows["side"] == 1]
        empty = pd.DataFrame({"id": [], "n": [], "other": []})
        if not len(a) or not len(b):
            return empty
        ids, others = a["id"].to_numpy(), b["id"].to_numpy()
        x = np.frombuffer(b"".join(a["v"]), dtype=np.float64).reshape(len(a), -1)
        y = np.frombuffer(b"".join(b["v"]), dtype=np.float64).reshape(len(b), -1)
        near = x @ y.T >= least
        near &= ids[:, None] != others[None, :]
        lives = b["resident"].to_numpy()
        if not lives.all():
            # Where the resident visits the other's home too, the smaller cell counts the pair.
            home = b["home"].to_numpy()
            sets = np.stack([np.frombuffer(v, dtype=np.uint8) for v in a["visits"]])
            back = (sets[:, home >> 3] >> (home & 7).astype(np.uint8) & 1).astype(bool)
            near &= ~(back & (~lives & (home < cell))[None, :])
        ac, bc = a["copies"].to_numpy(), b["copies"].to_numpy()
        found = [pd.DataFrame({"id": ids, "n": near @ bc})]
        if not lives.all():
            found.append(pd.DataFrame({"id": others, "n": (ac @ near) * ~lives}))
        nodes, at = np.unique(np.concatenate([ids, others]), return_inverse=True)
        i, j = np.nonzero(near)
        root = smallest_reached(len(nodes), at[:len(ids)][i], at[len(ids):][j])
        off = root != np.arange(len(nodes))
        links = pd.DataFrame({"id": nodes[off], "n": 0, "other": nodes[root[off]]})
        counted = pd.concat(found).query("n > 0").assign(other=None)
        return pd.concat([counted, links])[["id", "n", "other"]].astype({"id": "int64", "n": "int64", "other": "Int64"})

    return compare

