"""Landed page files of the JSON feeds, and the tables built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provender.functions.text import named
from provender.operators.merge import latest_per_key

ADDRESS = "struct<addressLineOne:string,city:string,region:string,postalCode:string,country:string>"
DOCUMENT = (
    "struct<_id:string,name:string,expirationDate:string,isArchived:boolean,"
    "attachments:array<struct<S3Name:string,fileName:string,BucketName:string,updatedAt:string>>,"
    "shareSource:struct<isDeleted:boolean,draftVersionId:string,membershipId:string,"
    "type:struct<_id:string,name:string>,approvalInfo:struct<status:string,setAt:string,setBy:struct<_id:string>>,"
    "complianceInfo:struct<status:string>,"
    f"sourceBusiness:struct<_id:string,name:string,address:{ADDRESS}>,"
    "shareSpecificAttributes:map<string,string>>,"
    "versionInfo:struct<isCurrentVersion:boolean,currentVersionId:string,createdAt:string,updatedAt:string>>"
)
ASSESSMENT = (
    "struct<_id:string,state:string,lastUpdatedAt:string,performedOnBusiness:struct<_id:string,name:string>,"
    "assessmentTemplate:struct<_id:string,name:string>,lastUpdate:struct<userId:string>>"
)
MEMBERSHIP = (
    "struct<_id:string,createdAt:string,updatedAt:string,internalId:string,status:string,"
    f"business:struct<_id:string,name:string,email:string,phone:string,address:{ADDRESS}>,"
    "locationGroup:struct<_id:string,name:string>,productGroup:struct<_id:string,name:string>>"
)
INCIDENT = (
    "struct<_id:string,incidentDate:string,comment:string,updatedAt:string,"
    "incidentType:struct<_id:string,name:string>,currentStatus:struct<id:int,name:string,isResolved:boolean>,"
    "location:struct<_id:string,name:string,globalLocationNumber:string>,extraAttributes:map<string,string>>"
)
INCIDENT_TYPE = "struct<_id:string,name:string,statuses:array<struct<id:int,name:string,isResolved:boolean>>>"

# Item shape, key of the item list, and the time that a poll window is about.
FEEDS = {
    "documents": (DOCUMENT, "pageItems", "versionInfo.updatedAt"),
    "assessments": (ASSESSMENT, "pageItems", "lastUpdatedAt"),
    "memberships": (MEMBERSHIP, "pageItems", "createdAt"),
    "incidents": (INCIDENT, "pageItems", "updatedAt"),
    "incident_types": (INCIDENT_TYPE, "items", None),
}
ENVELOPE = "pageItemCount int, totalItemCount int, hasNextPage boolean, nextPageIndex int"


def page_schema(feed: str, item: str | None = None) -> T.StructType:
    shape, items, _ = FEEDS[feed]
    return T._parse_datatype_string(f"{items} array<{item or shape}>, {ENVELOPE}")


def read_items(spark: SparkSession, path: str, feed: str, stream: bool = False, page_per_line: bool = False) -> DataFrame:
    """Items of landed pages as they are: one row each, the whole item as JSON text in ``item``.

    A file is one page, or with ``page_per_line`` many; such files can be split.
    """
    reader = spark.readStream if stream else spark.read
    schema = T._parse_datatype_string(f"{FEEDS[feed][1]} array<string>, {ENVELOPE}")
    pages = reader.schema(schema).option("multiLine", not page_per_line).json(path)
    return pages.select(F.explode(FEEDS[feed][1]).alias("item"))


def parse_items(items: DataFrame, feed: str, item: str | None = None) -> DataFrame:
    """The fields of raw items that rules use, as columns."""
    shape = T._parse_datatype_string(item or FEEDS[feed][0])
    return items.select(F.from_json("item", shape).alias("item")).select("item.*")


def read_pages(spark: SparkSession, path: str, feed: str, stream: bool = False, item: str | None = None) -> DataFrame:
    """Items of landed pages, one row each, as columns of the item's fields."""
    reader = spark.readStream if stream else spark.read
    pages = reader.schema(page_schema(feed, item)).option("multiLine", True).json(path)
    return pages.select(F.explode(FEEDS[feed][1]).alias("item")).select("item.*")


def in_window(items: DataFrame, feed: str, after: Column, until: Column) -> DataFrame:
    """Items of a poll window ``(after, until]``."""
    at = F.col(FEEDS[feed][2]).try_cast("timestamp")
    return items.where((at > after) & (at <= until))


# Where an item says under what it is filed: its business, for incidents their type.
FILED_UNDER = {
    "documents": "$.shareSource.sourceBusiness._id",
    "assessments": "$.performedOnBusiness._id",
    "memberships": "$.business._id",
    "incidents": "$.incidentType._id",
    "incident_types": "$._id",
}


def canonical(item: Column) -> Column:
    """JSON text with sorted keys and no spacing, so equal items have equal texts; null if it is no JSON."""
    return F.to_json(F.try_parse_json(item))


def mirror_rows(items: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """Raw items as rows of the mirror table, and those that cannot be filed.

    A row has ``type, business_id, item_id, item, version``; the version is a hash
    of the whole item, so a change in any field, named here or not, is seen. Items
    that are no JSON, or have no id or nothing to be filed under, are the second
    table: ``type, item, reason``.
    """
    rows = items.select(
        F.lit(feed).alias("type"), F.get_json_object("item", FILED_UNDER[feed]).alias("business_id"),
        F.get_json_object("item", "$._id").alias("item_id"), "item", canonical(F.col("item")).alias("_canonical"))
    reason = (F.when(F.col("_canonical").isNull(), "not JSON").when(F.col("item_id").isNull(), "no id")
              .when(F.col("business_id").isNull(), "nothing to file it under"))
    judged = rows.withColumn("reason", reason)
    filed = judged.where("reason is null").select(
        "type", "business_id", "item_id", F.col("_canonical").alias("item"), F.md5("_canonical").alias("version"))
    return filed, judged.where("reason is not null").select("type", "item", "reason")


def certificates(docs: DataFrame, type_id: str | None, status: str, as_of: Column, order: str,
                 business: str | None = None, archived: bool | None = None) -> DataFrame:
    """Documents that a certificate query asks for, the last write per id by ``order``.

    The filters sit before the per-id step, so they reach the scan.
    """
    expires = F.col("expirationDate").try_cast("timestamp")
    keep = (F.col("shareSource.approvalInfo.status") == status) & (expires >= as_of)
    if type_id is not None:
        keep = keep & (F.col("shareSource.type._id") == type_id)
    if business is not None:
        keep = keep & (F.col("shareSource.sourceBusiness._id") == business)
    if archived is not None:
        keep = keep & (F.coalesce("isArchived", F.lit(False)) == archived)
    return latest_per_key(docs.where(keep), ["_id"], [order])


def unprocessed(docs: DataFrame, done: DataFrame, supplier: str) -> DataFrame:
    """Resume: the suppliers an earlier run has not handled."""
    return docs.join(done.select(named(supplier)).distinct(), supplier, "left_anti")


def attachments(docs: DataFrame) -> DataFrame:
    """Attachment rows of documents, numbered from 1; directory entries are dropped."""
    return docs.select(F.col("_id").alias("doc_id"), F.posexplode("attachments").alias("at", "a")).where(
        ~F.coalesce(F.col("a.fileName").endswith("/"), F.lit(False))).select(
        "doc_id", (F.col("at") + 1).alias("seq"), F.col("a.fileName").alias("file_name"),
        F.col("a.S3Name").alias("stored_name"))
