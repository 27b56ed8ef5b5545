"""Partner master data: mapping, external ids, conflicts and repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provender.functions.text import named, nonempty

# Prefixes of external ids; give the ones your stored partners use.
SOURCE_PREFIX = "source:"
OFFICE_PREFIX = "sap:"


def office_ids(internal: Column, prefix: str = OFFICE_PREFIX) -> Column:
    """Back-office ids of a comma list, trimmed and prefixed; empty when there is none."""
    ids = F.transform(F.split(internal, ","), lambda x: F.concat(F.lit(prefix), F.trim(x)))
    return F.when(nonempty(internal).isNotNull(), ids).otherwise(F.array().cast("array<string>"))


def map_partner(df: DataFrame, key: str, internal: str, fields: dict[str, str],
                source_prefix: str = SOURCE_PREFIX, office_prefix: str = OFFICE_PREFIX) -> DataFrame:
    """Business rows as partner elements: text fields default to "", ids to a list."""
    ids = F.concat(F.array(F.concat(F.lit(source_prefix), named(key).cast("string"))),
                   office_ids(named(internal), office_prefix))
    return df.select(
        named(key),
        *[F.coalesce(named(source).cast("string"), F.lit("")).alias(target) for target, source in fields.items()],
        ids.alias("external_ids"))


def id_owners(partners: DataFrame) -> DataFrame:
    """One row per (external id, partner). Ids are meant to be unique, but may not be."""
    return partners.select("masterid", F.explode("external_ids").alias("xid")).distinct()


def resolve(elements: DataFrame, owners: DataFrame, key: str) -> DataFrame:
    """Find the partner of each element by its first (source) id; ``is_new`` if none.

    Where several partners own the id, the lowest master id is taken; the
    owners are reduced to one row per id before the join.
    """
    one = owners.groupBy("xid").agg(F.min("masterid").alias("masterid"))
    first = elements.withColumn("xid", F.element_at("external_ids", 1))
    return first.join(one, "xid", "left").withColumn("is_new", F.col("masterid").isNull()).drop("xid")


def new_partners(elements: DataFrame, owners: DataFrame) -> DataFrame:
    """Elements whose source id no partner owns."""
    first = elements.withColumn("xid", F.element_at("external_ids", 1))
    return first.join(owners.select("xid").distinct(), "xid", "left_anti").drop("xid")


def attach_ids(resolved: DataFrame, owners: DataFrame, key: str) -> DataFrame:
    """Per element: ids it may take, ids another partner holds, and the completeness reason.

    An id owned elsewhere is not attached and is reported; a new partner
    without a back-office id is incomplete. The sets hold an element's own ids,
    however often the element is repeated, so no group grows with the data.
    """
    one = owners.groupBy("xid").agg(F.min("masterid").alias("owner"))
    flat = resolved.select(named(key), "masterid", "is_new", F.posexplode("external_ids").alias("place", "xid"))
    joined = flat.join(one, "xid", "left")
    taken = F.col("owner").isNotNull() & ~F.col("owner").eqNullSafe(F.col("masterid"))
    return joined.groupBy(named(key)).agg(
        F.first("masterid").alias("masterid"),
        F.first("is_new").alias("is_new"),
        F.count_if(F.col("place") > 0).alias("n_office"),
        F.array_join(F.array_sort(F.collect_set(F.when(~taken, F.col("xid")))), ",").alias("attached"),
        F.array_join(F.array_sort(F.collect_set(F.when(taken, F.col("xid")))), ",").alias("conflicts"),
    ).withColumn("reason", completeness(F.col("is_new"), F.col("n_office") > 0, F.col("conflicts"))).drop("n_office")


def completeness(is_new: Column, has_internal: Column, conflicts: Column, failed_job: Column | None = None) -> Column:
    """Why a business is incomplete; ``failed_job`` is the job whose update of its ids failed, null for none."""
    out = (
        F.when(conflicts != "", F.concat(F.lit("Conflicting internalIds: "), conflicts))
        .when(is_new & ~has_internal, "business is missing internalIds")
    )
    if failed_job is None:
        return out
    return F.when(failed_job.isNotNull(), F.concat(
        F.lit("Other Internal Failure. See job "), failed_job.cast("string"), F.lit(" for details."))).otherwise(out)


def may_update_internal(current: Column, new: Column) -> Column:
    """Internal ids may be replaced when none are set or all are among the new ones."""
    left = F.array_except(F.split(current, ","), F.split(new, ","))
    return (F.coalesce(current, F.lit("")) == "") | (F.size(left) == 0)


def merge_pairs(matches: DataFrame, owners: DataFrame, source_prefix: str = SOURCE_PREFIX,
                office_prefix: str = OFFICE_PREFIX) -> DataFrame:
    """Partner pairs to merge: both ids must belong to exactly one partner."""
    one = owners.groupBy("xid").agg(F.count("*").alias("n"), F.min("masterid").alias("masterid"))
    one = one.where("n = 1").select("xid", "masterid")
    pairs = matches.select(
        F.concat(F.lit(source_prefix), F.col("source_id").cast("string")).alias("from_xid"),
        F.concat(F.lit(office_prefix), F.col("office_id").cast("string")).alias("to_xid"))
    return (
        pairs.join(one.select(F.col("xid").alias("from_xid"), F.col("masterid").alias("from_partner")), "from_xid")
        .join(one.select(F.col("xid").alias("to_xid"), F.col("masterid").alias("to_partner")), "to_xid"))


def migrate_ids(own_source_id: Column, ids: Column, change_id: Column, prefix: str = SOURCE_PREFIX) -> Column:
    """External ids of an old partner: own source id, else listed ids, else its first change."""
    return (
        F.when(nonempty(own_source_id).isNotNull(), F.array(F.concat(F.lit(prefix), own_source_id)))
        .when(F.exists(ids, lambda x: x.startswith(prefix.rstrip(":"))), ids)
        .when(nonempty(change_id).isNotNull(), F.array(F.concat(F.lit(prefix), change_id)))
        .otherwise(F.array().cast("array<string>")))


# Fields of a partner that are text and never null.
PARTNER_FIELDS = ("companycode", "vendorid", "partnerid", "name", "address", "city", "state",
                  "coi_emails", "fsqa_emails", "email", "phone")


def migrate_partners(old: DataFrame, prefix: str = SOURCE_PREFIX) -> DataFrame:
    """Old partners in the new form: ``masterid``, text fields, ``external_ids``, ``frozen``.

    ``old`` has ``id, own_source_id, external_ids, change_id`` and any of the text fields;
    a field that is absent or null becomes empty, null ids become a list without entries.
    """
    blank = F.lit("")
    fields = [F.coalesce(named(f).cast("string"), blank).alias(f) if f in old.columns else blank.alias(f) for f in PARTNER_FIELDS]
    ids = migrate_ids(F.col("own_source_id"), F.coalesce("external_ids", F.array().cast("array<string>")), F.col("change_id"), prefix)
    return old.select(F.col("id").alias("masterid"), *fields, ids.alias("external_ids"), F.lit(False).alias("frozen"))


def repair_ids(ids: Column, change_id: Column, prefix: str = SOURCE_PREFIX) -> Column:
    """Drop ids with an undefined part; an id from the first change replaces the list."""
    cleaned = F.when(F.array_contains(ids, prefix + "undefined"),
                     F.filter(ids, lambda x: ~x.contains("undefined"))).otherwise(ids)
    return F.when(nonempty(change_id).isNotNull(), F.array(F.concat(F.lit(prefix), change_id))).otherwise(cleaned)


def vendors(master: DataFrame) -> DataFrame:
    """Vendor master rows to match against: not blocked and not flagged deleted.

    Only a name that says so blocks, only a flag deletes: rows without either stay.
    """
    blocked = F.coalesce(F.col("VendorName").startswith("BLK"), F.lit(False))
    deleted = F.coalesce(F.trim("CentralDeletionFlag") == "X", F.lit(False))
    return master.where(~blocked & ~deleted).select(
        F.col("Vendor").alias("vendor_id"), F.col("VendorName").alias("name"), F.col("StreetAddress").alias("address"),
        F.col("City").alias("city"), F.col("Region").alias("state"),
        F.coalesce("Telephone1", "Telephone2").alias("phone"), F.col("PostalCode").alias("zip"),
        F.col("TaxNumber1").alias("ein1") if "TaxNumber1" in master.columns else F.col("TaxNumber2").alias("ein1"),
        F.col("TaxNumber2").alias("ein2"))


def vendors_without_partner(vendor_rows: DataFrame, owners: DataFrame, prefix: str = OFFICE_PREFIX) -> DataFrame:
    keyed = vendor_rows.withColumn("xid", F.concat(F.lit(prefix), F.col("vendor_id").cast("string")))
    return keyed.join(owners.select("xid").distinct(), "xid", "left_anti")
