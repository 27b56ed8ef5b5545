"""Insurance policies: composition per supplier, limits, dates and holders.

Input is a long table of extracted policies, one row per policy:
``supplier_id, doc_id, cert_id, ord, type, number, effective_date, expire_date``
(timestamps), the money fields as text, and ``per_statute``. ``ord`` is the
unique arrival order. Money is read by its leading integer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provender.functions.dates import is_active, is_placeholder
from provender.functions.text import int_or_zero, named, present

# ---------------------------------------------------------------------------
# Policy type of each slot and the money fields summed for it.
SLOT_TYPES = {
    "cgl": "Commercial General Liability",
    "al": "Automobile Liability",
    "ul": "Umbrella Liability",
    "wcel": "Worker's Compensation Employee Liability",
}
SLOT_FIELDS = {
    "cgl": ("each_occurrence", "general_aggregate", "products_compop_agg"),
    "al": ("combined_single_limit",),
    "ul": ("each_occurrence",),
    "wcel": ("el_each_accident", "el_disease_employee", "el_disease_limit"),
}
MONEY_FIELDS = (
    "each_occurrence", "general_aggregate", "products_compop_agg", "combined_single_limit",
    "el_each_accident", "el_disease_employee", "el_disease_limit",
)


@dataclass(frozen=True)
class Limit:
    key: str
    slot: str
    field: str
    minimum: int
    name: str
    long_name: str


# Required coverage.
LIMITS = (
    Limit("general_occurrence", "cgl", "each_occurrence", 2_000_000,
          "General Liability", "General Liability (Per Occurrence)"),
    Limit("general_aggregate", "cgl", "general_aggregate", 5_000_000,
          "General Liability", "General Liability (Aggregate)"),
    Limit("automobile", "al", "combined_single_limit", 1_000_000,
          "Automobile Liability", "Automobile Liability"),
    Limit("employers", "wcel", "el_each_accident", 1_000_000,
          "Worker's Compensation Employee Liability", "Employer's Liability"),
)
# ---------------------------------------------------------------------------


def compose_policies(policies: DataFrame, keys: Sequence[str], as_of: Column,
                     types: dict[str, str] | None = None) -> DataFrame:
    """One row per supplier: a composed policy per slot, and the earliest expiry.

    Policies that are active (or carry a placeholder date) count once per
    policy number, the first in arrival order; those without a number all
    count. A slot takes the minimum dates and the sums of its money fields, and
    is null when no policy is active. ``min_expire`` looks at all policies,
    expired and repeated ones too, but not at placeholder dates.

    Two aggregates, each with a map-side step: the first spreads a huge
    supplier over its policy numbers, the second reduces before it shuffles.
    """
    types = types or SLOT_TYPES
    slot_of = None
    for slot, type_name in types.items():
        hit = F.col("type") == type_name
        slot_of = F.when(hit, slot) if slot_of is None else slot_of.when(hit, slot)
    widest = max(len(f) for f in SLOT_FIELDS.values())
    rows = policies.select(
        *[named(k) for k in keys], "number", "ord", "expire_date", "effective_date",
        slot_of.otherwise(F.concat(F.lit("other:"), F.col("type"))).alias("_slot"),
        # Only the money fields of a policy's own type are read.
        *[_money(types, place).alias(f"_m{place}") for place in range(widest)],
        F.col("per_statute").eqNullSafe(F.lit("1")).alias("_statute"))
    # Ordered by ord where active; all buffers are fixed width, so this stays a hash aggregate.
    at = F.when(is_active(F.col("expire_date"), as_of), F.col("ord"))
    kept = ["effective_date", "expire_date", *[f"_m{i}" for i in range(widest)], "_statute"]
    once = rows.groupBy(
        *[named(k) for k in keys], "_slot", "number", F.when(F.col("number").isNull(), F.col("ord")).alias("_own")
    ).agg(
        F.count(at).alias("_active"), *[F.min_by(c, at).alias(c) for c in kept],
        F.min(F.when(~is_placeholder(F.col("expire_date")), F.col("expire_date"))).alias("min_expire"),
        F.count("*").alias("n"))
    aggs = [F.min("min_expire").alias("min_expire"), F.sum("n").alias("n_policies")]
    for slot in types:
        mine = (F.col("_slot") == slot) & (F.col("_active") > 0)
        aggs += [F.count_if(mine).alias(f"{slot}_n"),
                 F.min(F.when(mine, F.col("effective_date"))).alias(f"{slot}_effective"),
                 F.min(F.when(mine, F.col("expire_date"))).alias(f"{slot}_expire")]
        aggs += [F.sum(F.when(mine, F.col(f"_m{i}"))).alias(f"{slot}_{f}") for i, f in enumerate(SLOT_FIELDS[slot])]
        if slot == "wcel":
            aggs.append(F.when(F.count_if(mine) > 0, F.count_if(mine & ~F.col("_statute")) == 0).alias("wcel_per_statute"))
    return once.groupBy(*[named(k) for k in keys]).agg(*aggs)


def _money(types: dict[str, str], place: int) -> Column:
    """The money field at a place of a policy's own slot."""
    out = None
    for slot, type_name in types.items():
        if place < len(SLOT_FIELDS[slot]):
            value = int_or_zero(F.col(SLOT_FIELDS[slot][place]))
            hit = F.col("type") == type_name
            out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def certificate_members(policies: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Which certificates make up a supplier's combined one, one row each."""
    return policies.select(*[named(k) for k in keys], "cert_id").distinct()


def day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def check_expiry(declared_day: Column, as_of: Column, slots: Sequence[str] = tuple(SLOT_TYPES)) -> dict[str, Column]:
    """Earliest expiry over the composed slots against now and the declared day."""
    dates = [F.when(~is_placeholder(F.col(f"{s}_expire")), F.col(f"{s}_expire")) for s in slots]
    first = F.least(*dates) if len(dates) > 1 else dates[0]
    return {
        "min_expiration": day(first),
        "expiry_passed": first > as_of,
        "expiry_mismatch": F.coalesce(day(first) < declared_day, F.lit(False)),
        "declared_day": declared_day,
    }


def check_limits(as_of: Column, limits: Sequence[Limit] = LIMITS) -> Column:
    """Array of one result per limit, from the composed columns of a row.

    The umbrella counts on top of a policy that exists, never on its own. A
    placeholder date gives a warning and no pass. An expired date adds a reason
    but does not by itself fail the limit.
    """
    umbrella = F.coalesce(F.col("ul_each_occurrence"), F.lit(0))
    return F.array(*[_limit_result(x, umbrella, as_of) for x in limits])


def _limit_result(limit: Limit, umbrella: Column, as_of: Column) -> Column:
    value = F.col(f"{limit.slot}_{limit.field}")
    expires = F.col(f"{limit.slot}_expire")
    missing = value.isNull()
    effective = value + umbrella
    warning = ~missing & is_placeholder(expires)
    expired = ~missing & F.coalesce(expires < as_of, F.lit(True))
    passed = ~missing & ~warning & F.coalesce(effective >= limit.minimum, F.lit(False))
    including = F.when(umbrella > 0, " including Umbrella policy").otherwise("")
    reasons = present(
        F.when(missing, f"No unexpired {limit.name} policies found"),
        F.when(~missing & expires.isNull(), f"{limit.name} policy has no expiration date"),
        F.when(expired & ~warning & expires.isNotNull(),
               F.concat(F.lit(f"{limit.name} policy expired "), day(expires))),
        F.when(warning, f"Confirm Effective Dates for {limit.name} policy."),
        F.when(~missing & ~warning & ~passed, F.concat(
            F.lit(f"Insufficient {limit.long_name} coverage. {limit.minimum} is required. Coverage"),
            including, F.lit(" is only "), effective.cast("string"), F.lit("."))),
    )
    shown = (
        F.when(missing, "")
        .when(warning & expired, F.concat(value.cast("string"), F.lit(" (Confirm Effective Dates)")))
        .when(expired, F.concat(F.lit("Expired "), F.coalesce(day(expires), F.lit("(unknown)"))))
        .otherwise(value.cast("string"))
    )
    return F.struct(
        F.lit(limit.key).alias("key"), F.lit(limit.name).alias("name"),
        F.lit(limit.minimum).cast("bigint").alias("minimum"),
        F.lit(f"/policies/{limit.slot}/{limit.field}").alias("pointer"),
        value.alias("amount"), F.when(~missing, effective).alias("effective"),
        shown.alias("shown"), passed.alias("passed"), warning.alias("warning"), reasons.alias("reasons"),
    )


def check_workers(as_of: Column) -> dict[str, Column]:
    """Workers' compensation text, flags and reason from the composed slot."""
    has = F.col("wcel_n") > 0
    expires = F.col("wcel_expire")
    statute = F.coalesce(F.col("wcel_per_statute"), F.lit(False))
    word = F.when(statute, "Yes").otherwise("No")
    warning = has & is_placeholder(expires)
    expired = has & F.coalesce(expires < as_of, F.lit(False))
    return {
        "workers": F.when(~has, "")
        .when(warning, F.concat(word, F.lit(" (Confirm Effective Dates)")))
        .when(expired, F.concat(F.when(statute, "1").otherwise("0"), F.lit(" (Expired "), day(expires), F.lit(")")))
        .otherwise(word),
        "workers_warning": warning,
        "workers_expired": expired,
        "workers_reason": F.when(has & ~warning & expired, "Worker's Comp policy is expired.")
        .when(has & ~warning & ~statute, "Worker's Comp policy is missing per statute requirement."),
    }


@dataclass(frozen=True)
class HolderRule:
    """What a certificate's holder must contain or equal, all in lower case."""

    name_has: str
    state: str
    city: str
    street_has: str


def holder_is_good(rule: HolderRule, name: Column, state: Column, city: Column, street: Column) -> Column:
    return F.coalesce(
        F.lower(name).contains(rule.name_has) & (F.lower(state) == rule.state)
        & (F.lower(city) == rule.city) & F.lower(street).contains(rule.street_has), F.lit(False))


def check_holders(certificates: DataFrame, doc_key: str, rule: HolderRule) -> DataFrame:
    """Per document: certificates seen and whether any has an acceptable holder."""
    good = holder_is_good(rule, F.col("holder_name"), F.col("holder_state"), F.col("holder_city"), F.col("holder_street"))
    return certificates.groupBy(named(doc_key)).agg(
        F.count("*").alias("n_certificates"), F.count_if(good).alias("n_good_holders"),
        F.bool_or(good).alias("holder_passed"))


def holder_lines(certificates: DataFrame, doc_key: str) -> DataFrame:
    """Holder text per certificate, one row each, for display."""
    parts = ["holder_name", "holder_street", "holder_city", "holder_state", "holder_postal_code", "holder_country"]
    return certificates.select(named(doc_key), "cert_id", F.concat_ws(
        ",", *[F.nullif(F.col(p), F.lit("")) for p in parts if p in certificates.columns]).alias("holder_line"))


def attachment_outcomes(attachments: DataFrame) -> DataFrame:
    """Status and error of each attachment of a document.

    Input: ``supplier_id, doc_id, seq, file_name, stored_name, ran, result_error,
    run_error``. An attachment is known by its file name, else its stored name,
    else its place among the document's attachments.
    """
    key = F.coalesce("file_name", "stored_name", F.concat(F.lit("attachment-"), F.col("seq").cast("string")))
    failed = F.col("run_error").isNotNull() | F.col("result_error").isNotNull()
    return attachments.select(
        "supplier_id", "doc_id", key.alias("attachment"),
        F.when(~F.col("ran"), "not-run").when(failed, "failed").otherwise("success").alias("status"),
        F.coalesce("run_error", "result_error").alias("error"))


def parsing_errors(outcomes: DataFrame, search_name: bool = True) -> DataFrame:
    """Per supplier: did any attachment fail, and does an error name the holder.

    A review case searches the attachment's name with its error; a workbook
    (``search_name=False``) the error alone.
    """
    said = F.when(F.col("error").isNotNull(), F.concat_ws(": ", "attachment", "error")) if search_name else F.col("error")
    return outcomes.groupBy("supplier_id").agg(
        F.bool_or(F.col("status") == "failed").alias("parsing_error"),
        F.coalesce(F.bool_or(said.contains("Holder")), F.lit(False)).alias("invalid_holder"),
        F.count("error").alias("n_errors"))


def to_report(status: Column, archived: Column, error: Column) -> Column:
    """Certificates that await approval, are not archived and are no error rows."""
    return error.isNull() & (status == "Awaiting Approval") & ~F.coalesce(archived, F.lit(False))


def supplier_certificates(awaiting: DataFrame, approved: DataFrame, supplier: str, key: str) -> DataFrame:
    """Awaiting certificates plus the approved ones of the same suppliers."""
    more = approved.join(awaiting.select(named(supplier)).distinct(), supplier, "left_semi")
    return awaiting.unionByName(more).dropDuplicates([key])


def assess(docs: DataFrame, composed: DataFrame, holders: DataFrame, parsing: DataFrame | None, as_of: Column,
           legacy_truthy: bool = False, limits: Sequence[Limit] = LIMITS) -> DataFrame:
    """Overall assessment of each document against its supplier's composed policies.

    ``docs`` has ``doc_id, supplier_id, declared_day``. ``legacy_truthy`` lets
    any workers' compensation text pass, also a "No".
    """
    # Both supplier tables are aggregates on that key, so they meet without another
    # shuffle, and the documents are shuffled for the supplier once: last, and narrow,
    # since all that is worked out for a row comes after it.
    if parsing is not None:
        suppliers = composed.join(parsing, "supplier_id", "full_outer")
    else:
        suppliers = composed.withColumns({"parsing_error": F.lit(False), "invalid_holder": F.lit(False)})
    joined = docs.join(holders, "doc_id", "left").join(suppliers, "supplier_id", "left").select(
        "doc_id", "supplier_id", *[named(c) for df in (docs, suppliers, holders) for c in df.columns if c not in ("doc_id", "supplier_id")])
    joined = joined.withColumns({
        "wcel_n": F.coalesce("wcel_n", F.lit(0)),
        "holder_passed": F.coalesce("holder_passed", F.lit(False)),
        "parsing_error": F.coalesce("parsing_error", F.lit(False)),
        "invalid_holder": F.coalesce("invalid_holder", F.lit(False)),
    })
    checked = joined.withColumns({
        **check_expiry(F.col("declared_day"), as_of), **check_workers(as_of), "limits": check_limits(as_of, limits)})
    workers_ok = F.col("workers") != "" if legacy_truthy else F.col("workers").startswith("Yes")
    passed = (F.forall("limits", lambda x: x["passed"]) & F.coalesce("expiry_passed", F.lit(False))
              & workers_ok & F.col("holder_passed"))
    reasons = F.concat(
        F.array_distinct(F.flatten(F.transform("limits", lambda x: x["reasons"]))),
        present(F.col("workers_reason"), F.when(~F.col("holder_passed"), "Holder info does not meet requirements.")))
    extraction = F.concat(F.lit("PDF extraction errors occurred."),
                          F.when(F.col("invalid_holder"), " Invalid Holder info detected.").otherwise(""))
    out = checked.withColumns({
        "passed": passed,
        "date_warning": F.exists("limits", lambda x: x["warning"]),
        "reasons": F.when(F.col("parsing_error"), F.concat(F.array(extraction), reasons)).otherwise(reasons),
    })
    return out.withColumn("recommendation", recommend(F.col("passed"), F.col("parsing_error"), F.col("date_warning")))


def recommend(passed: Column, parsing_error: Column, date_warning: Column) -> Column:
    return F.when(passed, "approve").when(parsing_error | date_warning, "review").otherwise("reject")


def check_list(assessed: DataFrame) -> DataFrame:
    """One row per document and check: status, expected and actual value, evidence."""
    def check(key, status, expected=None, actual=None, pointer=None):
        text = lambda v: F.lit(v).cast("string") if v is None or isinstance(v, str) else v.cast("string")
        return F.struct(F.lit(key).alias("check"), status.alias("status"), text(expected).alias("expected"),
                        text(actual).alias("actual"), text(pointer).alias("evidence"))

    def verdict(ok: Column) -> Column:
        return F.when(ok, "pass").otherwise("fail")

    head = [
        check("extraction.parsing", verdict(~F.col("parsing_error"))),
        check("expiration.minimum", F.when(F.col("expiry_passed").isNull(), "unknown").otherwise(
            verdict(F.col("expiry_passed"))), None, F.col("min_expiration"), "/policies/*/expire_date"),
        check("expiration.declared", verdict(~F.col("expiry_mismatch")), "Match attachment contents",
              F.col("declared_day"), "/expirationDate"),
    ]
    tail = [
        check("workers.per-statute", F.when(F.col("workers_warning"), "warn").otherwise(
            verdict(F.col("workers").startswith("Yes"))), "Yes", F.col("workers"), "/policies/wcel/per_statute"),
        check("holder.address", verdict(F.col("holder_passed")), None, None, "/holder"),
    ]
    coverage = F.transform("limits", lambda x: F.struct(
        F.concat(F.lit("coverage."), x["key"]).alias("check"),
        F.when(x["warning"], "warn").when(x["passed"], "pass").otherwise("fail").alias("status"),
        x["minimum"].cast("string").alias("expected"), x["shown"].alias("actual"), x["pointer"].alias("evidence")))
    # The outer form spares a filter on the list that would work it out again.
    return assessed.select("doc_id", F.explode_outer(F.concat(F.array(*head), coverage, F.array(*tail))).alias("c")).select(
        "doc_id", "c.*")


def assessment_rows(assessed: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Flat report row per document; ``*_flag`` holds what a sheet would colour. ``extra`` columns stay."""
    cells = [
        F.col("doc_id"), F.col("supplier_id"),
        F.initcap("recommendation").alias("recommended_action"),
        F.when(F.col("passed"), " ").when(F.col("parsing_error"), F.concat(
            F.lit("PDF extraction errors occurred. "),
            F.when(F.col("invalid_holder"), "Invalid Holder info detected. ").otherwise("")))
        .otherwise(F.array_join("reasons", "\n")).alias("rejection_reasons"),
        F.coalesce("min_expiration", F.lit("")).alias("min_expiration"),
        F.when(F.coalesce(F.col("expiry_passed"), F.lit(True)) | F.col("parsing_error"), "none").otherwise("fail")
        .alias("min_expiration_flag"),
        F.when(F.col("expiry_mismatch"), F.col("declared_day")).otherwise("").alias("different_expiration"),
    ]
    for i, limit in enumerate(LIMITS):
        x = F.col("limits")[i]
        cells += [x["shown"].alias(limit.key),
                  F.when(x["passed"], "none").when(x["warning"], "warn")
                  .when(F.col("parsing_error") | (x["shown"] == ""), "none").otherwise("fail").alias(f"{limit.key}_flag")]
    cells += [
        F.col("ul_each_occurrence").alias("umbrella"), F.col("workers"),
        F.when(F.col("workers_warning"), "warn").when(F.col("workers_expired") | F.col("workers").startswith("No"), "fail")
        .otherwise("none").alias("workers_flag"),
        F.when(F.col("holder_passed") | F.col("parsing_error"), "none").otherwise("fail").alias("holder_flag"),
    ]
    return assessed.select(*cells, *[named(c) for c in extra])
