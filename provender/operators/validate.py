"""Validation of extracted documents and of assessment templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Document types with an expiry validator, and the bad date an
# extraction leaves behind.
VALIDATED_TYPES = ("100g Nutritional Information", "Certificate of Insurance")
BAD_DAY = "1900-12-30"
# Names used by the insurance template.
UMBRELLA = "Umbrella Coverage"
UNSCORED = "none"


def usable_day(c: Column) -> Column:
    """Drop the extraction's bad date before taking a minimum."""
    return F.when(F.date_format(c, "yyyy-MM-dd") != BAD_DAY, c)


def expiry_verdict(type_name: Column, declared: Column, minimum: Column, as_of: Column,
                   source_label: str = "the source system", error_prefix: str = "Validation failed: ",
                   type_label: str = "type") -> dict[str, Column]:
    """Status and message of the expiry rule; ``minimum`` is the earliest usable date.

    When both rules fail the message of the second (expired) stays.
    """
    supported = F.coalesce(type_name.isin(*VALIDATED_TYPES), F.lit(False))
    lowest = F.date_format(minimum, "yyyy-MM-dd")
    stated = F.date_format(declared, "yyyy-MM-dd")
    mismatch = F.coalesce(stated > lowest, F.lit(False))
    expired = F.coalesce(F.to_timestamp(lowest) <= as_of, F.lit(False))
    message = (
        F.when(~supported, F.concat(F.lit(f"{error_prefix}Validation of {type_label} "),
                                    F.coalesce(type_name, F.lit("undefined")), F.lit(" unsupported")))
        .when(minimum.isNull(), f"{error_prefix}Could not extract expiration dates from PDF.")
        .when(expired, F.concat(
            F.lit("Minimum expiration date found on the document indicates it is already expired: "), lowest))
        .when(mismatch, F.concat(
            F.lit(f"Expiration date submitted in {source_label} ("), stated,
            F.lit(") does not match the minimum expiration date found in the PDF document ("), lowest, F.lit(").")))
        .otherwise("")
    )
    return {"valid": supported & minimum.isNotNull() & ~expired & ~mismatch, "message": message}


def after_validation(valid: Column, status: Column) -> Column:
    """What follows a validated result: finish an approved document, else close or fail it."""
    return F.when(status == "Approved", "finish").when(~valid, "document-validation").otherwise("end")


def template_columns(assessments: DataFrame) -> DataFrame:
    """One row per scored column of every question, with its answer and the umbrella's.

    Input: ``assessment_id`` and ``sections`` nested as arrays of
    subsections, questions, ``columns`` and ``answers`` (of the first answer row).
    """
    # A question is one small nested value, so these steps stay inside a row.
    questions = (
        assessments.select("assessment_id", F.posexplode("sections").alias("i", "s"))
        .select("assessment_id", "i", F.posexplode("s.subsections").alias("j", "b"))
        .select("assessment_id", "i", "j", F.posexplode("b.questions").alias("k", "q"))
    )
    umbrella_id = F.get(F.filter("q.columns", lambda c: c["name"] == UMBRELLA), F.lit(0))["id"]
    # Answers by column id, worked out once per question; the first answer of an id counts.
    ids = F.array_distinct(F.transform("q.answers", lambda a: a["column"]))
    by_id = F.map_from_arrays(ids, F.transform(
        ids, lambda i: F.get(F.filter("q.answers", lambda a: a["column"] == i), F.lit(0))))
    looked_up = questions.select("assessment_id", "i", "j", "k", F.col("q.columns").alias("columns"),
                                 umbrella_id.alias("umbrella_id"), by_id.alias("answers"))
    rows = looked_up.select(
        "assessment_id", "i", "j", "k", "answers",
        F.try_element_at("answers", F.col("umbrella_id"))["answer_numeric"].alias("umbrella"),
        F.posexplode("columns").alias("n", "c"))
    return rows.withColumn("answer", F.try_element_at("answers", F.col("c.id"))).drop("answers")


def generic_violation(c: Column) -> tuple[Column, Column]:
    """A scored column fails when it is not fully within tolerance."""
    failed = (c["acceptance_type"] != UNSCORED) & F.coalesce(c["percent"] < 100, F.lit(False))
    reason = F.when(failed, F.concat(
        c["name"], F.lit("("), F.coalesce(c["average"].cast("string"), F.lit("undefined")),
        F.lit(") did not meet the requirement ("),
        F.coalesce(c["required_numeric"].cast("string"), F.lit("undefined")), F.lit(")")))
    return failed, reason


def insurance_violation(c: Column, answer: Column, umbrella: Column) -> tuple[Column, Column]:
    """Like the generic rule, but a numeric coverage may lean on the umbrella."""
    def text(v: Column) -> Column:
        return F.coalesce(v.cast("string"), F.lit("undefined"))

    short = (c["acceptance_type"] != UNSCORED) & F.coalesce(c["percent"] < 100, F.lit(False))
    leaning = (c["name"] != UMBRELLA) & (c["type"] == "numeric")
    value, needed = answer["answer_numeric"], c["required_numeric"]
    total = value + umbrella
    known = value.isNotNull() & umbrella.isNotNull() & needed.isNotNull()
    failed = short & F.when(leaning & known, total < needed).otherwise(F.lit(True))
    reason = (
        F.when(failed & leaning & known, F.concat(
            F.lit("The sum of "), c["name"], F.lit("("), text(value), F.lit(") and Umbrella Coverage("), text(umbrella),
            F.lit(") was "), text(total), F.lit(". This does not meet the required coverage ("), text(needed), F.lit(")")))
        .when(failed & ~leaning & (c["type"] == "numeric"), F.concat(
            c["name"], F.lit("("), text(value), F.lit("; plus umbrella "), text(umbrella),
            F.lit(") did not meet the requirement ("), text(needed), F.lit(")")))
        .when(failed & (c["type"] == "bool"), F.concat(
            c["name"], F.lit("("), text(answer["answer_bool"]), F.lit(") did not meet the requirement ("),
            text(c["required_bool"]), F.lit(")")))
    )
    return failed, reason


def check_template(assessments: DataFrame, insurance: bool) -> DataFrame:
    """Per assessment: failed or not, how many columns fail.

    Columns are judged inside their row, so only one count per row is shuffled; rows
    that repeat an id are taken together.
    """
    def failures(q: Column) -> Column:
        def answer_of(key: Column) -> Column:
            return F.get(F.filter(q["answers"], lambda a: a["column"] == key), F.lit(0))

        leaning = F.get(F.filter(q["columns"], lambda c: c["name"] == UMBRELLA), F.lit(0))["id"]
        umbrella = answer_of(leaning)["answer_numeric"]

        def fails(c: Column) -> Column:
            failed, _ = insurance_violation(c, answer_of(c["id"]), umbrella) if insurance else generic_violation(c)
            return F.coalesce(failed, F.lit(False))

        return F.size(F.filter(q["columns"], fails))

    questions = F.flatten(F.flatten(F.transform("sections", lambda s: F.transform(
        F.coalesce(s["subsections"], F.array()), lambda b: b["questions"]))))
    n = F.aggregate(F.transform(questions, failures), F.lit(0), lambda a, b: a + b)
    counted = assessments.select("assessment_id", F.coalesce(n, F.lit(0)).cast("bigint").alias("n_failed"))
    return counted.groupBy("assessment_id").agg(F.sum("n_failed").alias("n_failed")).select(
        "assessment_id", (F.col("n_failed") > 0).alias("failed"), "n_failed")


def template_reasons(assessments: DataFrame, insurance: bool) -> DataFrame:
    """Reasons in template order, one row each."""
    rows = template_columns(assessments)
    c = F.col("c")
    failed, reason = insurance_violation(c, F.col("answer"), F.col("umbrella")) if insurance else generic_violation(c)
    return rows.select("assessment_id", "i", "j", "k", "n", failed.alias("failed"), reason.alias("reason")).where(
        "reason is not null")


def assessment_state(failed: Column, auto_approve: Column) -> Column:
    return F.when(auto_approve, F.when(failed, "Rejected").otherwise("Approved"))


def template_answers(values: dict[str, Column], column_ids: dict[str, str]) -> Column:
    """Answer row of a template: one answer per column, numbers and flags apart."""
    def answer(name: str, value: Column) -> Column:
        flag = name == "worker"
        return F.struct(
            F.lit(column_ids[name]).alias("column"),
            (value if flag else F.lit(None)).cast("boolean").alias("answer_bool"),
            (F.lit(None) if flag else value).cast("bigint").alias("answer_numeric"))
    return F.array(*[answer(n, v) for n, v in values.items()])


def first_policy_answers(policies: DataFrame, keys: list[str]) -> DataFrame:
    """Numbers of the first policy of each type, for the assessment template."""
    from provender.functions.text import int_or_zero, named

    def first(type_name: str, column: str, alias: str) -> Column:
        mine = F.col("type") == type_name
        return F.coalesce(int_or_zero(F.min_by(F.coalesce(F.col(column), F.lit("")), F.when(mine, F.col("ord")))),
                          F.lit(0)).alias(alias)

    return policies.groupBy(*[named(k) for k in keys]).agg(
        first("Commercial General Liability", "each_occurrence", "general"),
        first("Commercial General Liability", "general_aggregate", "aggregate"),
        first("Automobile Liability", "combined_single_limit", "auto"),
        first("Commercial General Liability", "products_compop_agg", "product"),
        first("Umbrella Liability", "each_occurrence", "umbrella"),
        first("Worker's Compensation Employee Liability", "el_each_accident", "employer"),
        F.bool_or(F.col("type") == "Worker's Compensation").alias("worker"))
