"""Reports over the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provender.functions.text import join_present
from provender.operators import documents as D
from provender.operators import reports as R
from provender.plans.catalog import Catalog
from provender.plans.documents import pick
from provender.plans.tables import table
from provender.session import scratch_dir
from provender.sources import sinks

catalog = Catalog()
QUERIES, SQL, query = catalog.queries, catalog.sql, catalog.query

DAY = "2024-01-30"


def _counted(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as documents; their newest line item is the latest job."""
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "doc_id")
    li = table(spark, sf, "lineitem")
    jobs = li.select(F.col("l_orderkey").alias("doc_id"),
                     (F.col("l_linenumber").cast("bigint") * 10**9 + F.col("l_partkey") * 10**4 + F.col("l_suppkey")).alias("job_id"),
                     F.when(F.col("l_returnflag") == "R", F.when(F.col("l_partkey") % 2 == 0, "target-other").otherwise("document-validation")).alias("job_error"),
                     F.when(F.col("l_returnflag") == "A", "success").otherwise("failure").alias("job_status"),
                     F.col("l_suppkey").alias("result_id"))
    results = jobs.groupBy("job_id").agg(F.count("*").alias("n_same"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("result_id"), (F.col("s_acctbal") > 5000).alias("archived"))
    newest = R.latest_jobs(o, jobs, results, s)
    return newest.select(
        "doc_id", (F.col("o_custkey") % 50 == 0).alias("is_test"), (F.col("o_custkey") % 51 == 0).alias("is_owner"),
        F.when(F.col("o_orderstatus") == "O", "Approved").when(F.col("o_orderstatus") == "F", "approved").otherwise("Awaiting Approval").alias("status"),
        (F.col("o_orderpriority") == "1-URGENT").alias("by_us"), (F.col("o_totalprice") < 5000).alias("deleted"),
        F.col("job_id").isNotNull().alias("has_job"), "job_error", "job_status", F.coalesce("archived", F.lit(False)).alias("archived"),
        F.col("result_id").isNotNull().alias("has_result"))


COUNTED_SQL = """
WITH j AS (SELECT l_orderkey AS doc_id, l_linenumber::BIGINT * 1000000000 + l_partkey * 10000 + l_suppkey AS job_id,
  CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_partkey % 2 = 0 THEN 'target-other' ELSE 'document-validation' END END AS job_error,
  CASE WHEN l_returnflag = 'A' THEN 'success' ELSE 'failure' END AS job_status, l_suppkey AS result_id FROM lineitem),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY job_id DESC) AS rn FROM j) WHERE rn = 1),
d AS (SELECT o_orderkey AS doc_id, o_custkey % 50 = 0 AS is_test, o_custkey % 51 = 0 AS is_owner,
  CASE WHEN o_orderstatus = 'P' THEN 'awaiting approval' ELSE 'approved' END AS status, o_orderpriority = '1-URGENT' AS by_us, o_totalprice < 5000 AS deleted,
  job_id IS NOT NULL AS has_job, job_error, job_status, COALESCE(s_acctbal > 5000, false) AS archived, result_id IS NOT NULL AS has_result
  FROM orders LEFT JOIN l ON o_orderkey = l.doc_id LEFT JOIN supplier ON result_id = s_suppkey),
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE is_test) AS ignored_test, count(*) FILTER (WHERE NOT is_test AND is_owner) AS ignored_owner,
  count(*) FILTER (WHERE NOT is_test AND NOT is_owner AND by_us) AS by_us, count(*) FILTER (WHERE NOT is_test AND NOT is_owner AND deleted) AS deleted,
  count(*) FILTER (WHERE NOT is_test AND NOT is_owner AND NOT has_job) AS missing_job,
  count(*) FILTER (WHERE NOT is_test AND NOT is_owner AND has_job AND job_error IS NOT NULL) AS job_errors,
  count(*) FILTER (WHERE NOT is_test AND NOT is_owner AND has_job AND job_error IS NULL AND job_status = 'success') AS job_success,
  count(*) FILTER (WHERE NOT is_test AND NOT is_owner AND has_job AND job_error IS NULL AND job_status <> 'success') AS other_errors,
  count(*) FILTER (WHERE NOT is_test AND NOT is_owner AND has_job AND job_error IS NULL AND job_status = 'success' AND archived) AS archived,
  count(*) FILTER (WHERE NOT is_test AND NOT is_owner AND has_job AND job_error IS NULL AND job_status = 'success' AND NOT archived) AS not_archived FROM d)
"""


@query(COUNTED_SQL + "SELECT * FROM c")
def q_doc_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Counters over all documents in one pass."""
    return R.document_counters(_counted(spark, sf))


@query(COUNTED_SQL + """
SELECT status, count(*) AS total, count(*) FILTER (WHERE by_us) AS by_us, count(*) FILTER (WHERE NOT has_job) AS missing_job
FROM d WHERE NOT is_test AND NOT is_owner GROUP BY 1
""")
def q_status_counters(spark: SparkSession, sf: str) -> DataFrame:
    return R.status_counters(_counted(spark, sf))


@query(COUNTED_SQL + """
SELECT "check", total, parts, total - parts AS diff FROM (
  SELECT 'totals' AS "check", total, ignored_test + ignored_owner + job_success + job_errors + other_errors + missing_job AS parts FROM c
  UNION ALL SELECT 'archived', job_success, archived + not_archived FROM c
  UNION ALL SELECT 'jobs', total - ignored_test - ignored_owner - missing_job, job_success + job_errors + other_errors FROM c)
""")
def q_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Parts against totals."""
    return R.reconcile(R.document_counters(_counted(spark, sf)))


@query("""
SELECT COALESCE(code, 'total') AS error_code, n FROM (SELECT event_type AS code, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY ROLLUP (event_type))
""")
def q_error_counts(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.when(F.col("event_type") != "view", F.col("event_type")).alias("error_code"))
    return R.error_counts(e)


def _funnel(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as certificates whose attributes decide how far they get."""
    o = table(spark, sf, "orders")
    k = F.col("o_custkey")
    texts = F.array(F.lit("start"), pick(["not recognized", "a multi-COI file", "needs OCR", "Valiadation failed", "other"], k % 5), F.lit("OCR"))
    return R.funnel(o.select(
        F.col("o_orderkey").alias("doc_id"),
        F.when(F.col("o_orderstatus") == "O", "Awaiting Approval").when(F.col("o_orderstatus") == "F", "Approved").otherwise("rejected").alias("status"),
        (k % 31 != 0).alias("retrievable"), (k % 29 == 0).alias("meta_invalid"), F.lit("Multiple files").alias("meta_message"),
        (F.col("o_orderpriority") != "5-LOW").alias("has_pdf"), (k % 23 != 0).alias("has_job"),
        pick(["success", "success", "success", "failure", "queued"], F.col("o_orderkey") % 5).alias("job_status"), texts.alias("job_texts"),
        (k % 19 != 0).alias("has_result"), pick([True, True, True, False, None], k % 5).alias("valid"),
        F.when(k % 2 == 0, "it is expired").otherwise("does not match").alias("valid_message"),
        pick([True, False, None], k % 3).alias("approval"), (k % 7 != 0).alias("has_assessment"), (k % 4 == 0).alias("by_us"),
        pick(["Approved", "Rejected", "Submitted", "In Progress", "Not Started", "Lost"], k % 6).alias("assessment_state")))


FUNNEL_SQL = """
WITH s AS (SELECT o_orderkey AS doc_id, o_custkey AS k, o_orderkey % 5 AS ok, CASE o_orderstatus WHEN 'O' THEN 'a4' WHEN 'F' THEN 'a1' ELSE 'a2' END AS a,
  CASE WHEN o_custkey % 31 = 0 THEN 'b3' WHEN o_custkey % 29 = 0 THEN 'b2' WHEN o_orderpriority <> '5-LOW' THEN 'b1' WHEN o_orderstatus = 'F' THEN 'b4' WHEN o_orderstatus = 'P' THEN 'b5' ELSE 'b6' END AS b FROM orders),
t AS (SELECT *, CASE WHEN b = 'b1' THEN CASE WHEN k % 23 <> 0 THEN 'c1' ELSE 'c2' END END AS c FROM s),
u AS (SELECT *, CASE WHEN c = 'c1' THEN CASE WHEN ok < 3 THEN 'd1' WHEN ok = 3 THEN 'd2' ELSE 'd3' END END AS d FROM t),
v AS (SELECT *, CASE WHEN d = 'd2' THEN CASE k % 5 WHEN 0 THEN 'd2c' WHEN 1 THEN 'd2b' WHEN 3 THEN 'd2d' ELSE 'd2a' END END AS d2,
  CASE WHEN d = 'd1' THEN CASE WHEN k % 19 <> 0 THEN 'e1' ELSE 'e2' END END AS e FROM u),
w AS (SELECT *, CASE WHEN e = 'e1' THEN CASE WHEN k % 5 < 3 THEN 'f1' WHEN k % 5 = 3 THEN 'f2' ELSE 'f3' END END AS f FROM v),
x AS (SELECT *, CASE WHEN f = 'f2' THEN CASE WHEN k % 2 = 0 THEN 'f2a' ELSE 'f2b' END END AS f2, CASE WHEN f = 'f1' THEN CASE k % 3 WHEN 0 THEN 'g1' WHEN 1 THEN 'g2' ELSE 'g3' END END AS g FROM w),
y AS (SELECT *, CASE WHEN g = 'g1' AND k % 7 <> 0 THEN 'A1' END AS s1 FROM x),
z AS (SELECT *, CASE WHEN s1 IS NOT NULL THEN CASE WHEN k % 4 = 0 THEN 'A1a' ELSE 'A1b' END END AS s2, CASE WHEN s1 IS NOT NULL THEN 'B' || (1 + k % 6) END AS s3 FROM y)
"""


@query(FUNNEL_SQL + """
SELECT doc_id, concat_ws('>', a, b, c, d, d2, e, f, f2, g, s1, s2, s3) AS nodes, COALESCE(s3, g, f2, f, e, d2, d, c, b) AS node FROM z
""")
def q_stage_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """All nodes a document passes and the one where its way ends."""
    return _funnel(spark, sf).select("doc_id", F.array_join("nodes", ">").alias("nodes"), "node")


_nodes = ", ".join(f"('{n}')" for n, _ in R.FUNNEL_NODES)


@query(FUNNEL_SQL + f""", a2 AS (SELECT unnest([a, b, c, d, d2, e, f, f2, g, s1, s2, s3]) AS node FROM z)
SELECT n.node, count(a2.node) AS n FROM (VALUES {_nodes}) n(node) LEFT JOIN a2 ON n.node = a2.node GROUP BY 1
""")
def q_funnel_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.funnel_counts(_funnel(spark, sf)).select("node", "n")


_labels = ", ".join(f"('{c}', '{t}')" for c, t in R.ERROR_LABELS)


@query(f"""
WITH l(error_code, label) AS (VALUES {_labels})
SELECT CAST(event_id AS VARCHAR) AS document_id, 'user ' || user_id AS supplier, COALESCE(label, 'Success') AS result,
       CASE event_type WHEN 'error' THEN 'Other target errors' WHEN 'signup' THEN 'Document data did not match the site''s data' END AS final_result
FROM events LEFT JOIN l ON error_code = CASE event_type WHEN 'error' THEN 'target-other' WHEN 'signup' THEN 'document-validation' WHEN 'click' THEN 'new-code' END
""")
def q_job_report(spark: SparkSession, sf: str) -> DataFrame:
    """Report columns from JSON pointers, and the label of the job error."""
    e = table(spark, sf, "events")
    code = F.when(F.col("event_type") == "error", "target-other").when(F.col("event_type") == "signup", "document-validation").when(
        F.col("event_type") == "click", "new-code")
    job = F.to_json(F.struct(F.struct(F.col("event_id").cast("string").alias("key"),
                                      F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("b-name")).alias("config"),
                             F.struct(code.alias("error-code")).alias("result")))
    rows = R.job_report(e.select(job.alias("job")), {"document_id": "/config/key", "supplier": "/config/b-name", "error_code": "/result/error-code"})
    rows = D.with_lookup(rows, R.error_labels(spark, "the site's"), "error_code", "error_code", "label").withColumnRenamed("label", "final_result")
    return D.with_lookup(rows, R.error_labels(spark), "error_code", "error_code", "label", "Success").select(
        "document_id", "supplier", F.col("label").alias("result"), "final_result")


@query("""
SELECT c_custkey, replace(c_name, '#', ' ') AS name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment || ', ' END || n_name AS address, 'Ann Lee: hi' || chr(10) || 'Bo Fox: ' || c_mktsegment AS comments
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 4 = 1 AND c_mktsegment <> 'BUILDING' AND n_regionkey <> 0
""")
def q_partner_report(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs of incomplete businesses outside the internal groups, with address and comments."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)  # nation has 25 fixed rows
    updates = F.array(F.struct(F.lit("start").alias("status")),
                      F.struct(F.when(F.col("c_custkey") % 4 == 1, "fl-business-incomplete").otherwise("ok").alias("status")))
    kept = j.where(R.partner_report_filter(
        updates, F.when(F.col("c_mktsegment") == "BUILDING", "Internal"), F.when(F.col("n_regionkey") == 0, "Internal").otherwise("x")))
    said = lambda first, last, what: F.struct(F.lit(first).alias("first_name"), F.lit(last).alias("last_name"), what.alias("comment"))
    comments = F.create_map(F.lit("a"), F.array(said("Ann", "Lee", F.lit("hi"))), F.lit("b"), F.array(said("Bo", "Fox", F.col("c_mktsegment"))))
    return kept.select(
        "c_custkey", F.replace("c_name", F.lit("#"), F.lit(" ")).alias("name"),
        join_present(", ", [F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).otherwise(""), F.col("n_name")]).alias("address"),
        R.comments_text(comments).alias("comments"))


@query("""
SELECT c_custkey AS member_id, replace(c_name, '#', '') AS name, 'https://site.example/suppliers/' || c_custkey || '/k1' AS link FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_custkey % 2 = 0
""")
def q_vendor_report(spark: SparkSession, sf: str) -> DataFrame:
    """Members that lack an internal id, commas removed, sorted by name, with a link to each."""
    c = table(spark, sf, "customer")
    m = c.select(F.col("c_custkey").alias("member_id"), F.replace("c_name", F.lit("#"), F.lit(",")).alias("name"),
                 F.when(F.col("c_mktsegment") == "MACHINERY", "Internal").alias("location_group"), F.lit("Suppliers").alias("product_group"),
                 F.when(F.col("c_custkey") % 2 == 0, "").otherwise("id").alias("internal_id"))
    return R.vendors_to_complete(m, ["name"], "https://site.example/suppliers", "k1", order="name")


@query("""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max_by(event_type, (ts, event_id)) AS event_type, count(*) AS n FROM events
  GROUP BY 1, 2 HAVING min(ts) > TIMESTAMP '2024-01-23' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-11' AND DATE '2024-01-30')
SELECT user_id, max(day) AS day, max_by(event_type, day) AS event_type, max_by(n, day) AS n, min_by(event_type, day) AS oldest_type FROM d GROUP BY 1
""")
def q_rolling_report(spark: SparkSession, sf: str) -> DataFrame:
    """One row per job created in the last seven days, from day partitions; newest copy, and the oldest for comparison."""
    folder = scratch_dir(spark, "days")
    daily = table(spark, sf, "events").groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"), F.count("*").alias("n"), F.min("ts").alias("created"))
    sinks.day_partition(daily, "day", folder)
    stored = sinks.read_days(spark, folder, "2024-01-11", DAY)
    last, now = F.lit(DAY).cast("date"), F.lit(DAY).cast("timestamp_ntz")
    newest = R.rolling_union(stored, "user_id", "day", last, 20, created="created", as_of=now).drop("created")
    oldest = R.rolling_union(stored, "user_id", "day", last, 20, oldest_wins=True, created="created", as_of=now)
    return newest.join(oldest.select("user_id", F.col("event_type").alias("oldest_type")), "user_id")


@query("""
SELECT event_id, ts > TIMESTAMP '2024-01-29' AND ts <= TIMESTAMP '2024-01-30 23:59:59' AS is_new FROM events
""")
def q_recent_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items created within the last day."""
    e = table(spark, sf, "events")
    as_of = F.lit("2024-01-30").cast("timestamp")
    ts = F.col("ts").cast("timestamp")
    return e.select("event_id", (R.is_recent(ts, as_of, 24) & (ts <= F.lit("2024-01-30 23:59:59").cast("timestamp"))).alias("is_new"))
