"""Language identification in two steps: the family, then the language within it.

Texts are vectors of byte-pair and hashed byte-triple frequencies of whole texts
(ASCII letters made small, digits and marks as one). Linear support vector machines
tell families apart, one family against another; within a family every two
languages have a machine of their own and the one with most votes wins.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Families of closely related languages; a language that isn't listed is a family by itself.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "pl": "slavic", "cs": "slavic", "ru": "slavic", "uk": "slavic", "bg": "slavic", "sk": "slavic",
}
UNKNOWN = "und"
#: Times the texts of a sample that are looked at before it is cut.
SPARE = 1.25
PAIRS, TRIPLES = 1 << 16, 1 << 17
WIDTH = PAIRS + TRIPLES

_SEEN = np.arange(256, dtype=np.uint32)
_SEEN[ord("A"):ord("Z") + 1] += 32
_SEEN[[b for b in range(128) if not chr(b).isalpha()]] = 32


def features(raw: bytes) -> np.ndarray:
    """Indexes of all byte pairs and triples of a text, repeats included."""
    return _features(b" " + raw + b" ", True)


def _features(padded: bytes, start: bool) -> np.ndarray:
    """Those of a stretch; one that isn't the start leaves out the pair it shares with the stretch before."""
    b = _SEEN[np.frombuffer(padded, dtype=np.uint8)]
    pair = b[:-1] << 8 | b[1:]
    triple = (pair[:-1] * np.uint32(0x9E3779B1) ^ b[2:] * np.uint32(0x85EBCA6B)) >> np.uint32(15)
    return np.concatenate([pair if start else pair[1:], triple + np.uint32(PAIRS)])


@dataclass(frozen=True)
class Machine:
    """Decides for ``one`` where the weighted mean of a text's features is above 0."""

    one: str
    other: str
    weights: np.ndarray
    bias: float


@dataclass(frozen=True)
class Model:
    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: one in four by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, allowed: Column, per_language: int = 800, families: Mapping[str, str] = FAMILIES,
          rounds: int = 12) -> Model:
    """Fit on a bounded sample: at most ``per_language`` different allowed texts of every language.

    Which texts are taken follows from a hash of the text; copies count once. The driver
    gets the counted features of the sample, never a text. Rows with a null language or
    without letters teach nothing.
    """
    known = docs.select("lang", "text", allowed.alias("_ok")).where(F.col("_ok") & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for lang, n in sorted(sizes.items()):
        share = F.when(F.col("lang") == lang, min(1.0, SPARE * per_language / n)).otherwise(share)
    unit = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    few = known.where((unit < share) & F.col("text").rlike(r"\p{L}")).select("lang", "text").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text"))
    sample = few.withColumn("place", place).where(F.col("place") <= per_language).select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(features(t.encode()), return_counts=True) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("lang"), pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32())),
                pa.array([c.astype(np.int32) for _, c in found], pa.list_(pa.int32()))], names=["lang", "at", "n"])

    rows = sample.mapInArrow(counted, "lang string, at array<int>, n array<int>").toArrow()
    texts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for lang, at, n in zip(rows["lang"].to_pylist(), rows["at"], rows["n"], strict=True):
        n = n.values.to_numpy().astype(np.float32)
        texts.setdefault(lang, []).append((at.values.to_numpy(), n / n.sum()))
    # The order in which rows arrive doesn't count.
    texts = {lang: sorted(v, key=lambda x: (len(x[0]), x[0].tobytes(), x[1].tobytes())) for lang, v in sorted(texts.items())}
    grouped: dict[str, list[str]] = {}
    for lang in texts:
        grouped.setdefault(families.get(lang, lang), []).append(lang)
    of_family = {f: [x for lang in langs for x in texts[lang]] for f, langs in grouped.items()}
    machines = lambda sides: [_fit(a, b, sides[a], sides[b], rounds) for a, b in combinations(sorted(sides), 2)]
    return Model(grouped, machines(of_family),
                 {f: machines({lang: texts[lang] for lang in langs}) for f, langs in grouped.items()})


def _fit(one: str, other: str, left: list, right: list, rounds: int, cost: float = 10.0) -> Machine:
    """Dual coordinate descent for the squared hinge loss; both sides weigh alike.

    Features are square roots of frequencies at training, so that frequent pairs
    don't drown the rest, and each feature's weight is then spread by its mean.
    """
    rows = [(at, v, 1.0) for at, v in left] + [(at, v, -1.0) for at, v in right]
    scale = np.zeros(WIDTH, dtype=np.float32)
    for at, v, _ in rows:
        scale[at] += v
    scale = 1 / np.sqrt(scale / len(rows) + 1e-6)
    shaped = [(at, v * scale[at], y) for at, v, y in rows]
    norm = np.sqrt(np.mean([float(v @ v) for _, v, _ in shaped]))
    shaped = [(at, v / norm, y) for at, v, y in shaped]
    slack = {1.0: len(left) / (cost * len(rows)), -1.0: len(right) / (cost * len(rows))}
    weights, bias, alpha = np.zeros(WIDTH, dtype=np.float32), 0.0, np.zeros(len(rows))
    squares = [float(v @ v) + 1.0 for _, v, _ in shaped]
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(shaped)):
            at, v, y = shaped[i]
            gradient = y * (float(weights[at] @ v) + bias) - 1 + slack[y] * alpha[i]
            new = max(0.0, alpha[i] - gradient / (squares[i] + slack[y]))
            change = (new - alpha[i]) * y
            if change:
                alpha[i] = new
                weights[at] += np.float32(change) * v
                bias += change
    return Machine(one, other, (weights * scale / norm).astype(np.float32), float(bias))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) from the whole text; other columns are kept.

    A text that is null or has no letter, and any text when nothing was learned, is
    ``und`` with score 0. Input columns of these names are replaced. Repeated rows
    get the same answer; an empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_doc"),
                       F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("_text"))
    answer = F.pandas_udf(_predictor(model), "lang string, score double")
    rows = rows.withColumn("_said", answer("_text"))
    return rows.select("_doc.*", F.col("_said.lang").alias("lang_pred"), F.col("_said.score").alias("score"))


def _predictor(model: Model):
    import pandas as pd

    machines = [*model.between, *(m for f in sorted(model.within) for m in model.within[f])]
    table = np.stack([m.weights for m in machines], axis=1) if machines else np.zeros((WIDTH, 0), np.float32)
    bias = np.array([m.bias for m in machines])
    place = {(m.one, m.other): i for i, m in enumerate(machines)}

    def vote(names: list[str], margins: np.ndarray) -> tuple[str, float]:
        """Most votes, then the largest sum of margins; the certainty is that of the closest contest won."""
        if len(names) == 1:
            return names[0], 1.0
        sums = {n: [0, 0.0, np.inf] for n in names}
        for a, b in combinations(sorted(names), 2):
            m = float(margins[place[a, b]])
            for name, value in ((a, m), (b, -m)):
                s = sums[name]
                s[0] += value > 0
                s[1] += value
                s[2] = min(s[2], value)
        best = min(names, key=lambda n: (-sums[n][0], -sums[n][1], n))
        return best, 1 / (1 + np.exp(-2 * np.clip(sums[best][2], -20, 20)))

    def predict(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            if text is None or not model.families:
                out.append((UNKNOWN, 0.0))
                continue
            margins = bias + _mean_weights(text.encode(), table)
            family, sure = vote(sorted(model.families), margins)
            lang, surer = vote(model.families[family], margins)
            out.append((lang, float(sure * surer)))
        return pd.DataFrame(out, columns=["lang", "score"])

    predict.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return predict


def _mean_weights(raw: bytes, table: np.ndarray, step: int = 1 << 18) -> np.ndarray:
    """Mean weight of a whole text's features for every machine, in stretches of bounded size."""
    padded, total, n = b" " + raw + b" ", np.zeros(table.shape[1]), 0
    for start in range(0, len(padded), step):
        at = _features(padded[max(0, start - 2):start + step], start == 0)
        total += table[at].sum(axis=0, dtype=np.float64)
        n += len(at)
    return total / n
