"""What an extraction run found in a document's attachments, from the run's JSON text.

A run is an object of attachments by key. An attachment has ``results``, an object of found
certificates, or an error; ``results`` may itself be an error. A serialized error has a
message and a chain of causes. The whole run may be an error too, or absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTRIES = "map<string,string>"


def _entries(text: Column) -> Column:
    """Keys and raw values of a JSON object, in its order; a repeated key comes each time."""
    found = F.map_entries(F.from_json(text, ENTRIES))
    return F.coalesce(found, F.array().cast("array<struct<key:string,value:string>>"))


def _at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def _ran(run: Column) -> Column:
    """Whether a run is there and did not fail as a whole."""
    return F.coalesce(F.get_json_object(run, "$").startswith("{") & F.get_json_object(run, "$.serialized").isNull(), F.lit(False))


def _key(source: Column, place: Column) -> Column:
    return F.coalesce(source["fileName"], source["S3Name"], F.concat(F.lit("attachment-"), (place + 1).cast("string")))


def attachment_statuses(docs: DataFrame) -> DataFrame:
    """One row per attachment: ``doc_id, attachment, file_name, stored_name, status, error, extracted``.

    ``docs``: ``doc_id``, ``attachments`` (array of structs with ``fileName`` and
    ``S3Name``, null or empty for none) and ``run``, JSON text or null. Without a run, or
    when the run as a whole failed, every attachment is ``not-run`` with the run's error.
    Else an attachment of the run is ``failed`` without results or with a serialized error
    in their place, and ``error`` is its message, or what the cause of the cause says;
    ``extracted`` holds the ids of the certificates it found. Its source is the last of the
    document's attachments with its name. Text that is no JSON object counts as no run.
    """
    no_sources = F.array().cast(docs.schema["attachments"].dataType)
    told = docs.select("doc_id", F.coalesce("attachments", no_sources).alias("sources"), "run", _ran(F.col("run")).alias("ran"))
    run_error = F.coalesce(F.get_json_object("run", "$.msg"), F.get_json_object("run", "$.serialized.message"))

    # A document takes one of two ways, in one pass: its sources, or the entries of its run.
    def item(attachment: Column, s: Column, value: Column) -> Column:
        return F.struct(attachment.alias("attachment"), s["fileName"].alias("file_name"), s["S3Name"].alias("stored_name"), value.alias("value"))

    def named_so(key: Column) -> Column:
        return F.try_element_at(F.filter("sources", lambda s: F.coalesce(s["fileName"], s["S3Name"]) == key), F.lit(-1))

    idle = F.transform("sources", lambda s, at: item(_key(s, at), s, F.lit(None).cast("string")))
    held = F.transform(_entries(F.col("run")), lambda e: item(e["key"], named_so(e["key"]), e["value"]))
    rows = told.select("doc_id", "ran", F.when(~F.col("ran"), run_error).alias("run_error"),
                       F.explode(F.when(F.col("ran"), held).otherwise(idle)).alias("x"))
    rows = rows.select("doc_id", "ran", "run_error", "x.*").withColumn("v", F.try_parse_json("value"))
    rows = rows.withColumns({"results": _at(F.col("v"), "$.results"), "serialized": _at(F.col("v"), "$.results.serialized")})

    none = F.array().cast("array<string>")
    failed = F.col("results").isNull() | F.col("serialized").isNotNull()
    error = F.when(~F.col("ran"), F.col("run_error")).when(F.col("results").isNull(), F.coalesce(
        _at(F.col("v"), "$.msg"), _at(F.col("v"), "$.serialized.message"))).when(F.col("serialized").isNotNull(), F.coalesce(
        _at(F.col("v"), "$.results.serialized.cause.cause.information"), _at(F.col("v"), "$.results.serialized.message")))
    ids = F.filter(F.transform(_entries(F.col("results")), lambda e: F.get_json_object(e["value"], "$._id")), lambda i: i.isNotNull())
    return rows.select(
        "doc_id", "attachment", "file_name", "stored_name",
        F.when(~F.col("ran"), "not-run").when(failed, "failed").otherwise("success").alias("status"), error.alias("error"),
        F.when(~F.col("ran") | failed, none).otherwise(ids).alias("extracted"))


def valid_extractions(docs: DataFrame) -> DataFrame:
    """Found certificates that have an id, one row each: ``doc_id, attachment, certificate_id, certificate`` (JSON text).

    ``docs`` as for ``attachment_statuses``; failed runs, failed attachments and results
    without an id are left out.
    """
    whole = docs.where(_ran(F.col("run"))).select("doc_id", F.explode(_entries(F.col("run"))).alias("entry"))
    value = F.try_parse_json(F.col("entry.value"))
    results = whole.where(_at(value, "$.results.serialized").isNull()).select(
        "doc_id", F.col("entry.key").alias("attachment"), F.explode(_entries(_at(value, "$.results"))).alias("found"))
    certificate = F.get_json_object("found.value", "$._id")
    return results.where(certificate.isNotNull()).select(
        "doc_id", "attachment", certificate.alias("certificate_id"), F.col("found.value").alias("certificate"))
