"""Secret scans over every version of every file, each distinct content once.

A version's content is addressed by its SHA-256. A ledger table remembers which
contents were scanned under which version of the rules, with their findings. A
scan reads only contents that the ledger lacks, adds them, and joins findings back
to all paths that hold the content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from provender.llm.names import spare
from provender.llm.walks import bound, running


#: Characters of a stretch of text from which gaps between spans are cut.
STRETCH = 1024


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


#: Fixed values of the contract.
BASE_RULES = (
    Rule("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                   r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Rules of this library: key blocks, signed tokens, and tokens with well-known public prefixes.
MORE_RULES = (
    Rule("keyblock", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("prefixed", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{20,})"),
)
RULES = BASE_RULES + MORE_RULES

#: Tasks that may share the paths of one content.
SALTS = 16

FOUND = "array<struct<start: int, rank: int, end: int, kind: string>>"
LEDGER = f"blob string, rules string, found {FOUND}"


def rules_version(rules: Sequence[Rule]) -> str:
    """Names a rule set by what it says, so that a changed rule scans anew."""
    return hashlib.sha256(repr(tuple(rules)).encode()).hexdigest()[:16]


def found_in(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Spans of all rules by start, then rule order; offsets in code points, end exclusive.

    Text between matches and the matches give the places, as each match begins
    where the pieces before it end.
    """
    def spans(rank: int, rule: Rule) -> Column:
        pattern = F.lit(rule.pattern)
        whole = F.regexp_extract_all(text, pattern, F.lit(0))
        part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
        rows = F.arrays_zip(
            F.transform(F.slice(F.split(text, rule.pattern, -1), 1, F.size(whole)), F.char_length).alias("gap"),
            F.transform(whole, F.char_length).alias("width"),
            F.transform(part, F.char_length).alias("weight"))

        before = lambda held: running(F.transform(held, lambda r: r["gap"] + r["width"]), lambda a, b: a + b, 0)
        every = bound(rows, lambda held: F.zip_with(held, before(held), lambda r, at: F.struct(
            (at + r["gap"]).cast("int").alias("start"), F.lit(rank).alias("rank"), (at + r["gap"] + r["width"]).cast("int").alias("end"),
            F.lit(rule.kind).alias("kind"), r["weight"].alias("weight"))))
        kept = F.transform(F.filter(every, lambda s: s["weight"] >= rule.least), lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.when(text.rlike(rule.pattern), kept).otherwise(F.from_json(F.lit("[]"), FOUND))

    return F.array_sort(F.concat(*[spans(rank, rule) for rank, rule in enumerate(rules)]))


def scan_versions(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every version with its ``blob`` and the spans ``found`` in its ``text``.

    ``ledger`` is the path of the ledger table; it is made if it isn't there, and
    contents scanned here are added before this returns. Input columns are kept,
    but for ``blob`` and ``found``, which are replaced. A null text is an empty
    one. Repeated contents are scanned once, wherever they lie. An empty table
    scans nothing.
    """
    spark, version, salt = versions.sparkSession, rules_version(rules), spare(versions.columns, "_salt")
    kept = [F.col(f"`{c}`") for c in versions.columns if c not in ("blob", "found")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    blobs = versions.select(*kept, F.sha2(text.cast("binary"), 256).alias("blob"))
    seen = read_ledger(spark, ledger).where(F.col("rules") == version).select("blob")
    unseen = (
        blobs.select("blob", text.alias("text")).dropDuplicates(["blob"])
        .join(seen, "blob", "left_anti")
    )
    (
        unseen.select("blob", F.lit(version).alias("rules"), found_in(F.col("text"), rules).alias("found"))
        .write.mode("append").parquet(ledger)
    )
    # A run that was repeated may have added a content twice; the rows are then alike.
    known = (
        read_ledger(spark, ledger).where((F.col("rules") == version) & (F.size("found") > 0))
        .groupBy("blob").agg(F.max("found").alias("found"))
        .withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = blobs.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return salted.join(known, ["blob", salt], "left").select(
        *kept, "blob", F.coalesce("found", F.from_json(F.lit("[]"), FOUND)).alias("found"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, empty where none was written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def span_list(found: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """The text with every found stretch replaced; spans that touch or overlap become one mark."""
    # Where each span starts, and how far those before it reach: it opens a gap if it starts beyond that.
    far = running(F.transform(found, lambda s: s["end"]), F.greatest, -1)
    known = F.zip_with(found, far, lambda s, f: F.struct(s["start"].alias("start"), f.cast("int").alias("far")))
    opening = F.filter(known, lambda s: s["start"] > s["far"])
    last = F.array_max(F.transform(found, lambda s: s["end"]))

    def pieces(first: Column) -> Column:
        gaps = F.concat(F.transform(first, lambda s: F.struct(F.greatest(s["far"], F.lit(0)).alias("start"), s["start"].alias("end"))),
                        F.array(F.struct(last.alias("start"), F.char_length(text).alias("end"))))
        # A place in a long text is only found by reading up to it, so gaps are cut from stretches of it.
        stretches = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))

        def cut(held: Column, gap: Column) -> Column:
            at = F.floor(gap["start"] / STRETCH).cast("int")
            near = F.array_join(F.slice(held, at + 1, F.floor(gap["end"] / STRETCH).cast("int") - at + 1), "")
            return F.substring(near, gap["start"] - at * STRETCH + 1, gap["end"] - gap["start"])

        return F.array_join(bound(stretches, lambda held: F.transform(gaps, lambda g: cut(held, g))), mark)

    return F.when(F.size(found) == 0, text).otherwise(bound(opening, pieces))
