"""A corpus from raw documents to packed sequences, stage by stage.

Every stage takes and, but for the last, returns the columns of ``documents``, and
works on all its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provender.llm import languages, mixing, packing, secrets, simhash
from provender.llm.queries import TOKENIZER
from provender.plans.tables import table
from provender.session import scratch_dir, written


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go; a document without a language gets the predicted one."""
    model = languages.train(docs, ~languages.held_out(F.col("doc_id")))
    told = languages.identify(docs, model).where(F.col("text").rlike(r"\p{L}"))
    known = F.coalesce("lang", F.when(F.col("lang_pred") != languages.UNKNOWN, F.col("lang_pred")))
    return told.withColumn("lang", known).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: shingles of three words, three bits at most."""
    return simhash.kept_documents(docs, shingle=3, distance=3)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced by a mark in the text; all documents stay."""
    scanned = secrets.scan_versions(docs, scratch_dir(spark, "ledger"))
    text = secrets.redacted(F.col("text"), F.col("found"))
    clean = F.size("found") == 0
    return scanned.withColumn("n_chars", F.when(clean, F.col("n_chars")).otherwise(F.char_length(text).cast("bigint"))) \
        .withColumn("text", text).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.emitted(mixing.mix(docs))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their token ids."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language ID", identify_languages),
    ("SimHash near-dedup", drop_near_copies),
    ("secret scans", hide_secrets),
    ("mixing sources", mix_sources),
    ("packing", pack_documents),
]

#: Tokenizing and training have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
