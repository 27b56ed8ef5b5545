"""Supplier documents: type lookup, translation, triage and lifecycle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provender.functions.text import named
from provender.session import constant_table

# ---------------------------------------------------------------------------
# Document type name and the short name it is filed under.
DOCUMENT_TYPES = (
    ("Unidentified", "unidentified"),
    ("Certificate of Insurance", "cois"),
    ("Pure Food Guaranty and Indemnification Agreement (LOG)", "pfgias"),
    ("Letter of Guarantee", "letters-of-guarantee"),
    ("Emergency Contact Information", "emergency-contact-information"),
    ("Specifications that indicate acceptable requirements", "sars"),
    ("100g Nutritional Information", "nutritional-information"),
    ("Allergen Statement", "allergen-statements"),
    ("Bioengineered (BE) Ingredient Statement", "be-ingredient-statements"),
    ("Ingredient Statement", "ingredient-statements"),
    ("California Prop 65 Statement", "ca-prop-65-statements"),
    ("Country of Origin Statement", "coo-statements"),
    ("Gluten Statement", "gluten-statements"),
    ("Ingredient Breakdown Range %", "ingredient-breakdowns"),
    ("Product Label", "product-labels"),
    ("Product Specification", "product-specs"),
    ("Safety Data Sheet (SDS)", "sds"),
    ("GMO Statement", "gmo-statements"),
    ("Natural Statement", "natural-statements"),
    ("GFSI Certificate", "gfsi-certificates"),
    ("Non-Ambulatory (3D/4D) Animal Statement", "animal-statements"),
    ("Specified Risk Materials (SRM) Statement / Audit", "srm-statements-audits"),
    ("Specified Risk Materials (SRM) Audit", "srm-audits"),
    ("Specified Risk Materials (SRM) Statement", "srm-statements"),
    ("Specified Risk Materials (SRM) Corrective Actions", "srm-corrective-actions"),
    ("E.Coli 0157:H7 Intervention Audit", "ecoli-audits"),
    ("Foreign Material Control Plan", "foreign-material-control-plans"),
    ("Animal Welfare Audit", "animal-welfare-audits"),
    ("Humane Harvest Statement", "humane-harvest-statements"),
    ("National Residue Program (NRP) Statement", "nrp-statements"),
    ("Lot Code Explanation", "lot-code-explanations"),
    ("APHIS Statement", "aphis-statements"),
    ("Bisphenol A (BPA) Statement", "bpa-statements"),
    ("GFSI Audit", "fsqa-audits"),
    ("HACCP Plan / Flow Chart", "haccp-plans"),
    ("Co-Packer FSQA Questionnaire (GFSI Certified)", "copacker-fsqa-questionnaires"),
    ("Co-Pack Confidentiality Agreement Form", "copack-confidentiality-agreement-forms"),
    ("Third Party Food Safety GMP Audit Corrective Actions", "tpa-corrective-actions"),
    ("Third Party Food Safety GMP Audit", "tpa-food-safety-audits"),
    ("Third Party Animal Welfare Audit", "tpa-animal-welfare-audits"),
    ("Third Party Animal Welfare Corrective Actions", "tpa-animal-welfare-corrective-actions"),
    ("W-8", "w-8s"),
    ("Animal Welfare Corrective Actions", "animal-welfare-corrective-actions"),
    ("Third Party Food Safety GMP Certificate", "fsqa-certificates"),
    ("Signed Vendor Acknowledgement Form", "signed-vendor-acknowledgement-forms"),
    ("WIRE Form", "wire-forms"),
    ("E.Coli 0157:H7 Intervention Statement", "ecoli-statements"),
    ("E.Coli 0157:H7 Intervention Statement / Audit", "ecoli-intervention-statements-audits"),
    ("Business License", "business-licenses"),
    ("Rate Sheet", "rate-sheets"),
    ("Master Service Agreement (MSA)", "msas"),
)
DEFAULT_SLUG = "unidentified"
# Document types that get a work item of their own kind.
SUPPORTED_TYPES = (
    "100g Nutritional Information",
    "APHIS Statement",
    "Allergen Statement",
    "Animal Welfare Audit",
    "Animal Welfare Corrective Actions",
    "Bioengineered (BE) Ingredient Statement",
    "Bisphenol A (BPA) Statement",
    "Business License",
    "COA",
    "California Prop 65 Statement",
    "Certificate of Insurance",
    "Co-Pack Confidentiality Agreement Form",
    "Co-Packer FSQA Questionnaire (GFSI Certified)",
    "Co-Packer FSQA Questionnaire (Non-GFSI Certified)",
    "Country of Origin Statement",
    "E.Coli 0157:H7 Intervention Audit",
    "E.Coli 0157:H7 Intervention Statement",
    "Foreign Material Control Plan",
    "GFSI Audit",
    "GFSI Certificate",
    "Gluten Statement",
    "HACCP Plan / Flow Chart",
    "Humane Harvest Statement",
    "Ingredient Breakdown Range %",
    "Lot Code Explanation",
    "Master Service Agreement (MSA)",
    "National Residue Program (NRP) Statement",
    "Natural Statement",
    "Non-Ambulatory (3D/4D) Animal Statement",
    "Product Label",
    "Product Specification",
    "Pure Food Guaranty and Indemnification Agreement (LOG)",
    "Rate Sheet",
    "Safety Data Sheet (SDS)",
    "Specified Risk Materials (SRM) Audit",
    "Specified Risk Materials (SRM) Audit Corrective Actions",
    "Specified Risk Materials (SRM) Statement",
    "Third Party Food Safety GMP Audit",
    "Third Party Food Safety GMP Audit Corrective Actions",
    "Third Party Food Safety GMP Certificate",
)
# Attribute renames of a document; later ones win on a clash.
SHARE_ATTRIBUTES = (
    ("adjustmentDate", "adjustment_date"),
    ("auditDate", "audit_date"),
    ("certifyingBody", "certifying_body"),
    ("doesYourCompanyComplyWithFsisDirective108001", "fsis_directive_108001_compliance"),
    ("effectiveDate", "effective_date"),
    ("gradeScore", "score"),
    ("initialTermDate", "initial_term_date"),
    ("isAuditorPaacoCertified", "is_paaco_certified"),
    ("documentDate", "document_date"),
    ("selectAllRegulationsYouComplyWith", "regulation_compliance"),
)
DEFAULT_ATTRIBUTES = (
    ("auditAttributes.auditor", "auditor"),
    ("auditAttributes.auditDate", "audit_date"),
    ("auditAttributes.certIssuedDate", "issue_date"),
    ("auditAttributes.criticalFailures", "failures"),
    ("auditAttributes.reAuditDate", "reaudit_date"),
    ("auditAttributes.scheme", "scheme"),
    ("expirationDate", "expire_date"),
    ("products", "products"),
    ("locations", "locations"),
)
CERTIFICATE = "Certificate of Insurance"
# Error classes of a failed extraction; a later class wins.
ERROR_CLASSES = (
    ("target-multiple-docs-combined", (r"(?i)this is a multi-.* file",)),
    ("target-validation", (r"(?i)(validation|valiadation) failed",)),
    ("target-unrecognized", (r"(?i)file format was not recognized", r"(?i)^file is not a textual pdf")),
)
ERROR_DEFAULT = "target-other"
# Statuses after which an attachment's extraction is over.
FINAL_STATUSES = ("success", "failure")
# ---------------------------------------------------------------------------


def type_table(spark: SparkSession) -> DataFrame:
    """Type name to short name; the reverse lookup uses the same table."""
    return constant_table(spark, DOCUMENT_TYPES, ["type_name", "slug"])


def with_lookup(df: DataFrame, lookup: DataFrame, on: str, key: str, value: str, default: str | None = None) -> DataFrame:
    """Left join with a lookup table and an optional default; Spark weighs the table's size."""
    small = lookup.select(named(key).alias("_k"), named(value).alias("_v"))
    out = df.join(small, named(on) == F.col("_k"), "left")
    found = F.col("_v") if default is None else F.coalesce("_v", F.lit(default))
    return out.withColumn(value, found).drop("_k", "_v")


def is_supported(type_name: Column) -> Column:
    return F.coalesce(type_name.isin(*SUPPORTED_TYPES), F.lit(False))


def translate_document(doc: Column, share: Column, business: Column, type_name: Column,
                       attributes: tuple[str, ...] | None = None) -> Column:
    """Struct of the canonical attributes of a document.

    ``share`` is the map of share-specific attributes; ``doc`` the JSON text of
    the document for the default ones. ``document_date`` falls back to
    ``effective_date``; a holder is set for certificates only.
    """
    values: dict[str, Column] = {}
    for source, target in SHARE_ATTRIBUTES:
        values[target] = share.getItem(source)
    for path, target in DEFAULT_ATTRIBUTES:
        own = F.get_json_object(doc, f"$.{path}")
        values[target] = F.coalesce(own, values[target]) if target in values else own
    values["document_date"] = F.coalesce(F.nullif(values["document_date"], F.lit("")), values["effective_date"])
    names = attributes or tuple(values)
    holder = F.when(type_name == CERTIFICATE, F.struct(
        business["name"].alias("name"),
        F.struct(
            business["address"]["addressLineOne"].alias("street_address"),
            business["address"]["postalCode"].alias("postal_code"),
            business["address"]["city"].alias("city"),
            business["address"]["region"].alias("state"),
            business["address"]["country"].alias("country")).alias("location")))
    return F.struct(*[values[n].alias(n) for n in names], holder.alias("holder"))


def triage(deleted: Column, type_name: Column, status: Column, supported: Column, has_draft: Column,
           has_partner: Column, set_by_us: Column, open_jobs: Column) -> Column:
    """Route of a changed document, in order of precedence."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    approved = status == "Approved"
    awaiting = status == "Awaiting Approval"
    return (
        F.when(yes(deleted), "skip-deleted")
        .when(type_name.isNull() | (type_name == ""), "ignore-no-type")
        .when(~yes(supported) & ~yes(approved), "ignore-unsupported")
        .when(yes(has_draft) & ~yes(awaiting), "reset-draft")
        .when(~yes(has_partner), "diagnostic")
        .when(awaiting, "queue")
        .when(yes(set_by_us) & yes(open_jobs > 0), "finish")
        .when(yes(set_by_us) & approved, "reprocess")
        .when(yes(set_by_us), "none")
        .when(approved, "queue-no-rejection")
        .otherwise("cancel")
    )


def work_items(routed: DataFrame) -> DataFrame:
    """Work items of the routes that queue one, keyed by document and version."""
    return routed.where(F.col("route").isin("queue", "diagnostic", "reprocess", "queue-no-rejection")).select(
        F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.col("version").cast("string"))).alias("job_id"),
        "doc_id", "version", "status", "type_name", "masterid",
        (~F.col("route").isin("reprocess", "queue-no-rejection")).alias("allow_rejection"))


def draft_resets(docs: DataFrame, as_of: Column, months: int = 24) -> DataFrame:
    """Drafts whose status must go back to awaiting approval."""
    return docs.where((F.col("updated") >= F.add_months(as_of, -months)) & F.col("draft_id").isNotNull()
                      & (F.col("draft_id") != "")).select(
        F.col("draft_id").alias("document_id"), F.lit("Awaiting Approval").alias("new_status"))


def assessment_triage(has_job: Column, type_known: Column, template_known: Column, state: Column,
                      allow_rejection: Column) -> Column:
    """Route of a changed assessment."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(~yes(has_job), "ignore-no-job")
        .when(~yes(type_known), "ignore-type")
        .when(~yes(template_known), "ignore-template")
        .when(state == "Submitted", "queue")
        .when(state == "Approved", "finish")
        .when((state == "Rejected") & ~F.coalesce(allow_rejection, F.lit(True)), "finish-approved")
        .when(state == "Rejected", "associated-assessment-rejected")
        .otherwise("skip")
    )


def classify_error(message: Column) -> Column:
    """Class of an extraction error message; the last class that matches wins."""
    out = None
    for name, patterns in reversed(ERROR_CLASSES):
        hit = message.rlike(patterns[0])
        for p in patterns[1:]:
            hit = hit | message.rlike(p)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(ERROR_DEFAULT)


def first_error(updates: Column) -> Column:
    """Text of the first update with status ``error`` (array of structs), else null."""
    return F.get(F.filter(updates, lambda u: u["status"] == "error"), F.lit(0))["information"]


def extraction_outcome(status: Column, approved: Column, error_class: Column) -> Column:
    """What a final extraction status leads to."""
    return (
        F.when(F.coalesce(approved, F.lit(False)) & status.isin(*FINAL_STATUSES), "finish")
        .when(status == "success", "validate")
        .when(status == "failure", error_class)
        .otherwise("wait")
    )


def completion_result(result_type: Column, result_key: Column, declared_type: Column, declared_key: Column,
                      failed_result: Column, allow_rejection: Column) -> dict[str, Column]:
    """Which document a finished work item files, or why it cannot."""
    kind = F.coalesce(F.when(~F.coalesce(failed_result, F.lit(False)), result_type), declared_type)
    own = F.when(kind == result_type, result_key)
    fallback = F.when(~F.coalesce(allow_rejection, F.lit(True)), declared_key)
    key = F.coalesce(own, fallback)
    return {
        "filed_type": kind,
        "filed_key": key,
        "outcome": F.when(kind.isNull(), "other").when(key.isNull(), "target-invalid-result").otherwise("filed"),
    }


def completion(attachments: DataFrame, expected: DataFrame) -> DataFrame:
    """Per work item: attachments in a final status against the expected number.

    ``attachments`` holds ``job_id, attachment, status, seq`` events; repeats of
    a final status count once. The first success (by ``seq``) is chosen.
    """
    final = attachments.where(F.col("status").isin(*FINAL_STATUSES))
    # The last final status of an attachment is the one that counts.
    per = final.groupBy("job_id", "attachment").agg(
        F.max_by(F.col("status") == "success", "seq").alias("ok"), F.max("seq").alias("seq"))
    done = per.groupBy("job_id").agg(
        F.count("*").alias("n_final"), F.count_if("ok").alias("n_success"),
        F.min_by("attachment", F.when(F.col("ok"), F.col("seq"))).alias("chosen"))
    joined = expected.join(done, "job_id", "left")
    return joined.select(
        "job_id", "n_expected",
        F.coalesce("n_final", F.lit(0)).alias("n_final"), F.coalesce("n_success", F.lit(0)).alias("n_success"),
        "chosen", (F.coalesce("n_final", F.lit(0)) >= F.col("n_expected")).alias("complete"))


def review_decision(status: Column, decision: Column, message: Column, current: Column, doc_id: Column,
                    draft_id: Column, has_ids: Column) -> dict[str, Column]:
    """State of a review decision and what it would write."""
    wanted = F.coalesce(status, F.when(decision == "approve", "Approved").when(decision == "reject", "Rejected"))
    comment = F.when(wanted == "Rejected", F.trim(F.coalesce(message, F.lit("")))).otherwise("")
    error = (
        F.when(~F.coalesce(has_ids, F.lit(False)), "missing-id")
        .when(~F.coalesce(wanted.isin("Approved", "Rejected"), F.lit(False)), "bad-status")
        .when((wanted == "Rejected") & (comment == ""), "missing-message")
    )
    moved_on = F.coalesce((current != "") & (current != "Awaiting Approval"), F.lit(False))
    return {
        "new_status": wanted, "comment": comment,
        "document_id": F.coalesce(draft_id, doc_id),
        "visible_to_supplier": F.coalesce(wanted == "Rejected", F.lit(False)),
        "error": error,
        "writeback": F.when(error.isNotNull(), "failed").when(moved_on, "skipped").otherwise("submitted"),
    }


def superseded(jobs: DataFrame, chunk: Column, keys: list[str], order: list[str], job: str) -> DataFrame:
    """Jobs with the newer job of the same document that cancels them, if any."""
    from provender.operators.ordered import with_next

    out = with_next(jobs, keys, chunk, order, [job])
    return out.withColumn("state", F.when(F.col(f"next_{job}").isNotNull(), "job-cancelled").otherwise("open"))
