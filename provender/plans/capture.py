"""Mirror, change capture and streams over the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provender.operators import merge as M
from provender.operators.ordered import time_chunk, with_next, with_position, with_previous
from provender.operators.reports import day_counters
from provender.plans.catalog import Catalog
from provender.plans.tables import table
from provender.session import scratch_dir, use_utc
from provender.sources import feeds, sinks
from provender.streaming import capture as SC
from provender.streaming import completion as ST

catalog = Catalog()
QUERIES, SQL, query = catalog.queries, catalog.sql, catalog.query

# Ten minutes of one user are a chunk: a month of events gives a few thousand per user.
CHUNK = 600


@query("""
SELECT c_custkey AS item_id, c_mktsegment AS segment,
       CASE WHEN c_custkey % 5 = 0 THEN 'added' ELSE 'changed' END AS change
FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 4 = 1
""")
def q_change_capture(spark: SparkSession, sf: str) -> DataFrame:
    """Incoming items that are new or differ from the stored copy."""
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("item_id"), F.col("c_mktsegment").alias("segment"),
        F.struct("c_name", "c_nationkey").alias("owner"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal")).alias("balance"))
    stored = c.where("item_id % 5 <> 0").withColumn(
        "balance", F.when(F.col("item_id") % 4 == 1, F.coalesce("balance", F.lit(0)) + 1).otherwise(F.col("balance")))
    return M.detect_changes(stored, c, "item_id", ["segment", "owner", "balance"], by_hash=True).select("item_id", "segment", "change")


@query("""
SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, max_by(event_type, (ts, event_id)) AS event_type, max(ts)::DATE AS day
FROM events GROUP BY user_id
""")
def q_latest_version(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    out = M.latest_per_key(e, ["user_id"], ["ts", "event_id"])
    return out.select("user_id", "event_id", "event_type", F.col("ts").cast("date").alias("day"))


@query("""
SELECT event_id, user_id, lag(event_type) OVER w AS previous_type,
       CASE WHEN lag(event_id) OVER w IS NULL THEN 'added' WHEN lag(event_type) OVER w <> event_type THEN 'changed' ELSE 'same' END AS change
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def q_version_history(spark: SparkSession, sf: str) -> DataFrame:
    """Each version against the one before it, as a batch replay of the capture."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    out = with_previous(e, ["user_id"], time_chunk(F.col("ts"), CHUNK), ["ts", "event_id"], ["event_type"])
    change = F.when(F.col("prev_event_type").isNull(), "added").when(
        F.col("prev_event_type") != F.col("event_type"), "changed").otherwise("same")
    return out.select("event_id", "user_id", F.col("prev_event_type").alias("previous_type"), change.alias("change"))


@query("""
SELECT md5(text) AS version_key, sha256(text) AS content_key, count(*) AS n_copies, min(doc_id) AS first_doc
FROM documents GROUP BY text
""")
def q_content_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Version and content keys of whole texts; equal content shares a key."""
    d = table(spark, sf, "documents")
    return d.groupBy(F.md5("text").alias("version_key"), M.bytes_key(F.encode("text", "UTF-8")).alias("content_key")).agg(
        F.count("*").alias("n_copies"), F.min("doc_id").alias("first_doc"))


@query("""
SELECT event_id AS job_id, user_id AS doc_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cancelled_by,
       CASE WHEN lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 'open' ELSE 'job-cancelled' END AS state
FROM events
""")
def q_supersede(spark: SparkSession, sf: str) -> DataFrame:
    """A newer job of the same document cancels the earlier one."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("job_id"), F.col("user_id").alias("doc_id"), "ts")
    out = with_next(e, ["doc_id"], time_chunk(F.col("ts"), CHUNK), ["ts", "job_id"], ["job_id"])
    return out.select("job_id", "doc_id", F.col("next_job_id").alias("cancelled_by"),
                      F.when(F.col("next_job_id").isNull(), "open").otherwise("job-cancelled").alias("state"))


@query("""
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS part,
       count(*) OVER (PARTITION BY user_id) AS n_parts FROM events
""")
def q_group_position(spark: SparkSession, sf: str) -> DataFrame:
    """Place of a row in its group and the group's size."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return with_position(e, ["user_id"], time_chunk(F.col("ts"), CHUNK), ["ts", "event_id"], "part", "n_parts").drop("ts")


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def q_day_counters(spark: SparkSession, sf: str) -> DataFrame:
    return day_counters(table(spark, sf, "events"), "ts", "event_type")


def _landed_members(spark: SparkSession, sf: str, folder: str, later: bool) -> DataFrame:
    """Customers as members on landed pages of a hundred; later some differ deep inside, in a field no rule names."""
    c, key = table(spark, sf, "customer"), F.col("c_custkey")
    deep = F.when(F.lit(later) & (key % 7 == 0), "new").otherwise("old")
    item = F.to_json(F.struct(
        F.when(key % 50 != 0, F.concat(F.lit("m"), key)).alias("_id"),
        F.struct(F.when(key % 60 != 1, F.concat(F.lit("b"), F.col("c_nationkey"))).alias("_id"), F.col("c_name").alias("name")).alias("business"),
        F.array(F.struct(F.struct(deep.alias("inner")).alias("deep"), F.col("c_acctbal").alias("balance"))).alias("unlisted")))
    pages = c.groupBy(F.floor(key / 100)).agg(F.array_join(F.collect_list(item), ",").alias("items"))
    pages.select(F.concat(F.lit('{"pageItems":['), "items", F.lit('],"hasNextPage":false}'))).write.text(folder)
    return feeds.read_items(spark, folder, "memberships", page_per_line=True)


@query("""
SELECT 'changed' AS outcome, 'm' || c_custkey AS item_id, 'b' || c_nationkey AS business_id, 1 AS n FROM customer
WHERE c_custkey % 7 = 0 AND c_custkey % 50 <> 0 AND c_custkey % 60 <> 1
UNION ALL
SELECT CASE WHEN c_custkey % 50 = 0 THEN 'no id' ELSE 'nothing to file it under' END, NULL, NULL, count(*) FROM customer
WHERE c_custkey % 50 = 0 OR c_custkey % 60 = 1 GROUP BY 1
""")
def q_mirror_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items of landed pages against the stored mirror: what changed, and what cannot be filed."""
    base = scratch_dir(spark, "pages")
    before, _ = feeds.mirror_rows(_landed_members(spark, sf, f"{base}/first", False), "memberships")
    sinks.append_mirror(before, f"{base}/mirror")
    now, rejects = feeds.mirror_rows(_landed_members(spark, sf, f"{base}/second", True), "memberships")
    changed = M.detect_changes(spark.read.parquet(f"{base}/mirror"), now, "item_id", ["version"])
    counted = rejects.groupBy(F.col("reason").alias("outcome")).agg(F.count("*").cast("int").alias("n"))
    nothing = F.lit(None).cast("string")
    return changed.select(F.col("change").alias("outcome"), "item_id", "business_id", F.lit(1).alias("n")).unionByName(
        counted.select("outcome", nothing.alias("item_id"), nothing.alias("business_id"), "n"))


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    use_utc(spark)
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("""
SELECT user_id AS item_id, max_by(event_type, (ts, event_id)) AS event_type, 'added' AS change, false AS handled,
       CASE WHEN max_by(event_type, (ts, event_id)) = 'error' THEN 'ignore' ELSE 'queue' END AS route
FROM events GROUP BY user_id
""")
def q_stream_capture(spark: SparkSession, sf: str) -> DataFrame:
    """Capture and route changed items from a stream of landed files."""
    items = _event_stream(spark, sf).select(F.col("user_id").alias("item_id"), "event_id", "event_type", "value", "ts")
    base = scratch_dir(spark, "capture")

    def route(changed: DataFrame, _: int) -> DataFrame:
        return changed.withColumn("route", F.when(F.col("event_type") == "error", "ignore").otherwise("queue"))

    SC.start_capture(items, "item_id", ["ts", "event_id"], ["event_type", "value"], f"{base}/store", f"{base}/checkpoint",
                     then=route).awaitTermination()
    return SC.current_state(spark, f"{base}/store", "item_id").select("item_id", "event_type", "change", "handled", "route")


# Work items start on different days and have ten; an attachment's status changes several times.
LIMIT_DAYS = 10
COMPLETION_SQL = f"""
WITH s AS (
  SELECT 'job-' || user_id AS job_id, 'file-' || (hour(ts) % 5) AS attachment, ts, 3 + user_id % 3 AS n_expected,
         CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failure' ELSE 'running' END AS status,
         TIMESTAMP '2024-01-01' + to_days((user_id % 23)::INTEGER) + to_days({LIMIT_DAYS}) AS deadline FROM events),
a AS (
  SELECT job_id, attachment, max_by(status, (ts, status)) AS status, min(ts) AS first
  FROM s WHERE status <> 'running' AND ts < deadline GROUP BY job_id, attachment),
f AS (
  SELECT job_id, count(*) AS n_final, count(*) FILTER (status = 'success') AS n_success,
         min_by(attachment, (first, attachment)) FILTER (status = 'success') AS chosen FROM a GROUP BY job_id),
j AS (SELECT job_id, max(n_expected) AS n_expected, max(deadline) AS deadline FROM s GROUP BY job_id),
o AS (
  SELECT job_id, coalesce(n_final, 0) AS n_final, coalesce(n_success, 0) AS n_success, chosen,
         CASE WHEN n_final >= n_expected THEN 'complete'
              WHEN deadline < (SELECT max(ts) FROM events) THEN 'timeout' ELSE 'open' END AS outcome
  FROM j LEFT JOIN f USING (job_id))
"""


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "error", "failure").otherwise("running")
    started = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval((F.col("user_id") % 23).cast("int"))
    statuses = _event_stream(spark, sf).select(
        F.concat(F.lit("job-"), F.col("user_id")).alias("job_id"), F.concat(F.lit("file-"), F.hour("ts") % 5).alias("attachment"),
        status.alias("status"), (3 + F.col("user_id") % 3).alias("n_expected"), started.alias("started"), "ts")
    base = scratch_dir(spark, "completion")
    ST.start_completion(statuses, f"{base}/outcomes", f"{base}/checkpoint", limit=f"{LIMIT_DAYS} days").awaitTermination()
    return spark.read.schema(ST.OUTCOMES).parquet(f"{base}/outcomes")


@query(COMPLETION_SQL + "SELECT job_id, n_final, n_success, chosen FROM o WHERE outcome = 'complete'")
def q_stream_completion(spark: SparkSession, sf: str) -> DataFrame:
    """Work items whose attachments all reached a final status in time, from a stream."""
    return _outcomes(spark, sf).where("outcome = 'complete'").drop("outcome")


@query(COMPLETION_SQL + "SELECT job_id, n_final, n_success FROM o WHERE outcome = 'timeout'")
def q_stream_timeout(spark: SparkSession, sf: str) -> DataFrame:
    """Work items that ran out of time before all their attachments were final, from a stream."""
    return _outcomes(spark, sf).where("outcome = 'timeout'").select("job_id", "n_final", "n_success")


@query("""
SELECT * FROM (SELECT user_id AS doc_id, event_id AS job_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cancelled_by
FROM events) WHERE cancelled_by IS NOT NULL
""")
def q_stream_supersede(spark: SparkSession, sf: str) -> DataFrame:
    """Cancelled jobs from a stream of new ones."""
    base = scratch_dir(spark, "supersede")
    jobs = _event_stream(spark, sf).select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("job_id"), "ts")
    ST.start_supersede(jobs, time_chunk(F.col("ts"), CHUNK), ["ts", "job_id"], f"{base}/store", f"{base}/checkpoint"
                       ).awaitTermination()
    return ST.cancellations(spark, f"{base}/store")
