"""Reports: counters, reconciliation, stage funnel, rolling windows, job rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provender.functions.text import drop_commas, named, present
from provender.operators.merge import latest_per_key
from provender.session import constant_table

# ---------------------------------------------------------------------------
# Report text of a job error.
ERROR_LABELS = (
    ("associated-assessment-rejected", "Assessment Failure"),
    ("bad-fl-attachments", "Attachments could not be retrieved or are corrupt."),
    ("document-validation", "Document contents did not match source data or were missing."),
    ("multi-files-attached", "Multiple attachments is not currently allowed for this document type."),
    ("target-multiple-docs-combined", "The PDF attachment contained multiple documents. This is currently unsupported."),
    ("target-other", "Extraction Failure"),
    ("target-unrecognized", "Extraction Failure"),
    ("target-validation", "Extraction Failure"),
    ("unknown", "Other Errors"),
    ("target-error-already-approved", "Document already approved; Extraction Failure"),
)
# The same in the final report; the name of the site that documents come from is put in.
FINAL_LABELS = (
    ("target-other", "Other target errors"),
    ("associated-assessment-rejected", "Assessment failure"),
    ("document-validation", "Document data did not match {site} data"),
    ("target-unrecognized", "Format unrecognized during extration"),
    ("multi-files-attached", "Multiple files were attached within {site}"),
    ("target-validation", "Required data elements missing during Target extraction"),
    ("target-multiple-docs-combined",
     "The PDF contained multiple document extractable results, but this is current not supported."),
    ("bad-fl-attachments", "Attachments corrupt or can no longer be retrieved from Amazon S3"),
)
# Funnel nodes and their descriptions.
FUNNEL_NODES = (
    ("a1", "Document approved"), ("a2", "Document rejected"), ("a3", "Other doc statuses"), ("a4", "Document Awaiting Approval"),
    ("b1", "Document created"), ("b2", "Document has multiple PDFs attached"), ("b3", "Failed to retrieve attachments"),
    ("b4", "Already approved by others"), ("b5", "Already rejected by others"), ("b6", "Remainder of options"),
    ("c1", "Job created"), ("c2", "Remainder of options"),
    ("d1", "Extraction success"), ("d2", "Extraction failure"), ("d3", "Other extraction result"),
    ("d2a", "Document requires OCR"), ("d2b", "Document has multiple certificates within the file"),
    ("d2c", "PDF format unrecognized"), ("d2d", "Extraction validation failure"), ("d2e", "Other failure modes"),
    ("e1", "Data extracted"), ("e2", "Remainder of options"),
    ("f1", "Extracted data passes"), ("f2", "Extracted data fails"), ("f3", "Remainder of options"),
    ("f2a", "Document expired"), ("f2b", "Expirations do not match"),
    ("g1", "Assessment passes"), ("g2", "Assessment fails"), ("g3", "Remainder of options"),
    ("A1", "Assessments mirrored"), ("A1a", "Created by us"), ("A1b", "Created by someone else"),
    ("B1", "Assessment state is Approved"), ("B2", "Assessment state is Rejected"), ("B3", "Assessment state is Submitted"),
    ("B4", "Assessment state is In Progress"), ("B5", "Assessment state is Not Started"), ("B6", "Other assessment states"),
)
# What to do about a node that ends a document's way.
MANUAL = "Document requires manual evaluation."
FUNNEL_REMEDIES = (
    ("b2", "Ask the supplier for a single PDF per document."),
    ("b3", "Check by hand whether the attachments are available; if not, inform the supplier."),
    ("b6", MANUAL), ("c2", MANUAL), ("d2a", MANUAL),
    ("d2b", "Ask the supplier for a single certificate per document."),
    ("d2c", MANUAL), ("d2d", MANUAL), ("d2e", MANUAL), ("d3", MANUAL), ("e2", MANUAL),
    ("f2a", "Reject and tell the supplier the document is expired."),
    ("f2b", "Reject and tell the supplier the dates do not match."),
    ("f3", MANUAL),
    ("g2", "Reject and tell the supplier the coverage does not meet requirements."),
    ("g3", MANUAL),
)
ASSESSMENT_STATES = (("Approved", "B1"), ("Rejected", "B2"), ("Submitted", "B3"), ("In Progress", "B4"), ("Not Started", "B5"))
# ---------------------------------------------------------------------------


def error_labels(spark: SparkSession, final_site: str | None = None) -> DataFrame:
    """Label of each job error; with the name of the site, those of the final report, which has fewer."""
    labels = ERROR_LABELS if final_site is None else [(c, t.format(site=final_site)) for c, t in FINAL_LABELS]
    return constant_table(spark, labels, ["error_code", "label"])


def error_counts(jobs: DataFrame, code: str = "error_code") -> DataFrame:
    """Jobs per error code and in total."""
    return (
        jobs.where(named(code).isNotNull()).rollup(named(code)).agg(F.count("*").alias("n"))
        .select(F.coalesce(named(code), F.lit("total")).alias(code), "n"))


def status_key(status: Column) -> Column:
    """One spelling per status; the feed mixes ``approved`` and ``Approved``."""
    return F.lower(status)


def document_counters(docs: DataFrame) -> DataFrame:
    """Counters over all documents in one pass.

    Flags: ``is_test, is_owner, by_us, deleted, has_job, job_error, job_status,
    archived, has_result``. Test and owner documents are only counted as such.
    """
    scope = ~F.col("is_test") & ~F.col("is_owner")
    with_job = scope & F.col("has_job")
    ok = with_job & F.col("job_error").isNull() & (F.col("job_status") == "success")
    count = lambda name, cond: F.count_if(cond).cast("bigint").alias(name)
    return docs.agg(
        F.count("*").alias("total"),
        count("ignored_test", F.col("is_test")), count("ignored_owner", ~F.col("is_test") & F.col("is_owner")),
        count("by_us", scope & F.col("by_us")), count("deleted", scope & F.col("deleted")),
        count("missing_job", scope & ~F.col("has_job")),
        count("job_errors", with_job & F.col("job_error").isNotNull()),
        count("job_success", ok),
        count("other_errors", with_job & F.col("job_error").isNull() & ~(F.col("job_status") == "success")),
        count("archived", ok & F.col("has_result") & F.col("archived")),
        count("not_archived", ok & F.col("has_result") & ~F.col("archived")))


def status_counters(docs: DataFrame) -> DataFrame:
    scope = docs.where(~F.col("is_test") & ~F.col("is_owner"))
    return scope.groupBy(status_key(F.col("status")).alias("status")).agg(
        F.count("*").alias("total"), F.count_if("by_us").alias("by_us"),
        F.count_if(~F.col("has_job")).alias("missing_job"))


def reconcile(counters: DataFrame) -> DataFrame:
    """Parts against totals, one row per check."""
    c = F.col
    def check(name, total, parts):
        return F.struct(F.lit(name).alias("check"), total.alias("total"), parts.alias("parts"),
                        (total - parts).alias("diff"))
    return counters.select(F.explode(F.array(
        check("totals", c("total"), c("ignored_test") + c("ignored_owner") + c("job_success") + c("job_errors")
              + c("other_errors") + c("missing_job")),
        check("archived", c("job_success"), c("archived") + c("not_archived")),
        check("jobs", c("total") - c("ignored_test") - c("ignored_owner") - c("missing_job"),
              c("job_success") + c("job_errors") + c("other_errors")),
    )).alias("r")).select("r.*")


def latest_jobs(docs: DataFrame, jobs: DataFrame, results: DataFrame, archive: DataFrame) -> DataFrame:
    """Document to its newest job, that job's result and the archive entry; each optional.

    Job ids sort by time, so the highest one is the newest.
    """
    newest = latest_per_key(jobs, ["doc_id"], ["job_id"])
    return (docs.join(newest, "doc_id", "left").join(results, "job_id", "left").join(archive, "result_id", "left"))


def funnel(docs: DataFrame) -> DataFrame:
    """All nodes a certificate passes, and the one where its way ends.

    Adds ``nodes`` (in order) and ``node`` (where it ends). Columns used:
    ``status, retrievable, meta_invalid, meta_message, has_pdf, has_job,
    job_status, job_texts, has_result, valid, valid_message, approval,
    has_assessment, by_us, assessment_state``.
    """
    c = F.col
    yes = lambda x: F.coalesce(x, F.lit(False))
    status = status_key(c("status"))
    a = F.when(status == "approved", "a1").when(status == "rejected", "a2").when(
        status == "awaiting approval", "a4").otherwise("a3")
    b = (F.when(~yes(c("retrievable")), "b3")
         .when(yes(c("meta_invalid")) & yes(c("meta_message").contains("Multiple")), "b2")
         .when(yes(c("has_pdf")), "b1").when(status == "approved", "b4").when(status == "rejected", "b5").otherwise("b6"))
    c_ = F.when(yes(c("has_job")), "c1").otherwise("c2")
    d = F.when(c("job_status") == "success", "d1").when(c("job_status") == "failure", "d2").otherwise("d3")
    # The first update that says something known decides.
    kinds = F.transform("job_texts", lambda t: F.when(t.contains("recognized"), "d2c").when(t.contains("multi-COI"), "d2b")
                        .when(t.contains("OCR"), "d2a").when(t.contains("Valiadation"), "d2d"))
    first = F.get(F.filter(kinds, lambda k: k.isNotNull()), F.lit(0))
    d2 = F.when(c("job_status") == "failure", F.coalesce(first, F.lit("d2e")))
    e = F.when(yes(c("has_result")), "e1").otherwise("e2")
    f = F.when(c("valid"), "f1").when(~c("valid"), "f2").otherwise("f3")
    f2 = F.when(yes(c("valid_message").contains("expired")), "f2a").when(yes(c("valid_message").contains("match")), "f2b")
    g = F.when(c("approval"), "g1").when(~c("approval"), "g2").otherwise("g3")
    s = None
    for word, node in ASSESSMENT_STATES:
        s = F.when(c("assessment_state") == word, node) if s is None else s.when(c("assessment_state") == word, node)
    s = s.otherwise("B6")
    # The stages become columns first, so that each is worked out once per row.
    staged = docs.withColumns({"_a": a, "_b": b, "_c": c_, "_d": d, "_d2": d2, "_e": e, "_f": f, "_f2": f2, "_g": g, "_s": s})
    a, b, c_, d, d2, e, f, f2, g, s = (c(x) for x in ("_a", "_b", "_c", "_d", "_d2", "_e", "_f", "_f2", "_g", "_s"))
    reached_c, reached_d = b == "b1", (b == "b1") & (c_ == "c1")
    reached_e = reached_d & (d == "d1")
    reached_f = reached_e & (e == "e1")
    reached_g = reached_f & (f == "f1")
    reached_s = reached_g & (g == "g1") & yes(c("has_assessment"))
    nodes = present(
        a, b, F.when(reached_c, c_), F.when(reached_d, d), F.when(reached_d & (d == "d2"), d2),
        F.when(reached_e, e), F.when(reached_f, f), F.when(reached_f & (f == "f2"), f2), F.when(reached_g, g),
        F.when(reached_s, "A1"), F.when(reached_s, F.when(yes(c("by_us")), "A1a").otherwise("A1b")), F.when(reached_s, s))
    return staged.withColumn("nodes", nodes).withColumn("node", F.element_at("nodes", -1)).select(
        *[named(x) for x in docs.columns], "nodes", "node")


def funnel_counts(flagged: DataFrame) -> DataFrame:
    """Documents per node; every node is listed, with its description and remedy."""
    spark = flagged.sparkSession
    nodes = constant_table(spark, FUNNEL_NODES, ["node", "description"])
    remedies = constant_table(spark, FUNNEL_REMEDIES, ["node", "remedy"])
    # A task has at most one row per node after its partial count. The list is never
    # empty; the outer form spares the filter on it, which would work it out again.
    counts = flagged.select(F.explode_outer("nodes").alias("node")).groupBy("node").agg(F.count("*").alias("n"))
    return nodes.join(F.broadcast(remedies), "node", "left").join(counts, "node", "left").select(
        "node", "description", "remedy", F.coalesce("n", F.lit(0)).alias("n"))


def is_recent(created: Column, as_of: Column, hours: int) -> Column:
    return F.coalesce(created > as_of - F.expr(f"INTERVAL {hours} HOURS"), F.lit(False))


def rolling_union(daily: DataFrame, key: str, day: str, last_day: Column, days: int, oldest_wins: bool = False,
                  created: str | None = None, as_of: Column | None = None) -> DataFrame:
    """One row per job over the last ``days`` day partitions; the newest copy wins.

    The day filter prunes partitions. ``oldest_wins`` keeps the first copy.
    """
    rows = daily.where((named(day) <= last_day) & (named(day) > F.date_sub(last_day, days)))
    if created is not None:
        rows = rows.where(is_recent(named(created), as_of, 24 * 7))
    return latest_per_key(rows, [key], [day], oldest=oldest_wins)


def pointer(doc: Column, path: str) -> Column:
    """Text at a JSON pointer of a JSON text column."""
    keys = "".join(f"['{p}']" for p in path.strip("/").split("/"))
    return F.get_json_object(doc, f"${keys}")


def job_report(jobs: DataFrame, columns: dict[str, str], doc: str = "job") -> DataFrame:
    """Report columns from JSON pointers."""
    return jobs.select(*[pointer(named(doc), path).alias(name) for name, path in columns.items()])


def partner_report_filter(updates: Column, location_group: Column, product_group: Column) -> Column:
    """Jobs with an incomplete-business update, outside the internal groups."""
    return (F.exists(updates, lambda u: u["status"] == "fl-business-incomplete")
            & ~location_group.eqNullSafe(F.lit("Internal")) & ~product_group.eqNullSafe(F.lit("Internal")))


def vendors_to_complete(members: DataFrame, fields: Sequence[str], site: str = "", community: str = "",
                        order: str | None = None) -> DataFrame:
    """Members outside the internal groups that lack an internal id; commas removed.

    ``link`` leads to the member's page: ``site``, the member, ``community``. Rows come
    sorted by ``order``, the member breaking ties, if given.
    """
    kept = members.where(~F.col("location_group").eqNullSafe(F.lit("Internal"))
                         & ~F.col("product_group").eqNullSafe(F.lit("Internal")) & (F.col("internal_id") == ""))
    link = F.concat(F.lit(f"{site}/"), F.col("member_id").cast("string"), F.lit(f"/{community}"))
    out = kept.select("member_id", *[drop_commas(named(f)).alias(f) for f in fields], link.alias("link"))
    return out.orderBy(order, "member_id") if order else out


def comments_text(comments: Column) -> Column:
    """``First Last: text`` lines of a map of comment arrays."""
    return F.array_join(F.transform(F.flatten(F.map_values(comments)), lambda m: F.concat(
        m["first_name"], F.lit(" "), m["last_name"], F.lit(": "), m["comment"])), "\n")


def day_counters(events: DataFrame, ts: str, by: str) -> DataFrame:
    """Counts per tumbling day."""
    return events.groupBy(F.window(named(ts), "1 day").alias("w"), named(by)).agg(F.count("*").alias("n")).select(
        F.col("w.start").cast("date").alias("day"), named(by), "n")
