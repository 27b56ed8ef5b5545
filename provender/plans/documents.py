"""Document triage, lifecycle and validation over the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provender.operators import documents as D
from provender.operators import validate as V
from provender.operators.reports import pointer
from provender.plans.catalog import Catalog
from provender.plans.tables import table
from provender.session import scratch_dir, use_utc
from provender.streaming.triage import start_triage

catalog = Catalog()
QUERIES, SQL, query = catalog.queries, catalog.sql, catalog.query


def pick(words: list[str | None], at):
    """The word at a place (from 0) of a fixed list."""
    return F.element_at(F.array(*[F.lit(w) for w in words]), (at + 1).cast("int"))


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CASE WHEN event_type = 'signup' THEN 'doc' ELSE CAST(ts::DATE AS VARCHAR) END AS document_date,
       CASE WHEN value < 30 THEN CAST(ts::DATE AS VARCHAR) END AS effective_date,
       CASE WHEN value > 60 THEN 'default' ELSE 'share' END AS audit_date,
       CASE WHEN event_type = 'purchase' THEN 'user ' || user_id END AS holder_name
FROM events WHERE value < 30 OR event_type = 'signup' OR value > 60
""")
def q_pointer_projection(spark: SparkSession, sf: str) -> DataFrame:
    """JSON pointers and the translation of a document's attributes."""
    e = table(spark, sf, "events").where("value < 30 or event_type = 'signup' or value > 60")
    day = F.date_format("ts", "yyyy-MM-dd")
    share = F.map_filter(F.create_map(
        F.lit("effectiveDate"), F.when(F.col("value") < 30, day),
        F.lit("auditDate"), F.lit("share"),
        F.lit("documentDate"), F.when(F.col("event_type") == "signup", "doc").otherwise(F.when(F.col("value") >= 30, day))),
        lambda k, v: v.isNotNull())
    doc = F.when(F.col("value") > 60, F.lit('{"auditAttributes":{"auditDate":"default"},"expirationDate":"2030-01-01"}')
                 ).otherwise(F.lit('{"expirationDate":"2030-01-01"}'))
    blank = F.lit("").alias("x")
    business = F.struct(F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name"), F.struct(
        *[blank.alias(n) for n in ("addressLineOne", "postalCode", "city", "region", "country")]).alias("address"))
    kind = F.when(F.col("event_type") == "purchase", D.CERTIFICATE).otherwise("W-8")
    out = e.withColumn("t", D.translate_document(doc, share, business, kind))
    return out.select(
        "event_id", pointer(F.col("props"), "/k").cast("bigint").alias("k"), F.col("t.document_date"),
        F.col("t.effective_date"), F.col("t.audit_date"), F.col("t.holder.name").alias("holder_name"))


@query("""
WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'Certificate of Insurance' WHEN 'click' THEN 'W-8'
  WHEN 'signup' THEN 'COA' WHEN 'purchase' THEN 'GFSI Audit' ELSE 'Mystery' END AS type_name FROM events)
SELECT event_id, type_name, CASE type_name WHEN 'Certificate of Insurance' THEN 'cois' WHEN 'W-8' THEN 'w-8s'
  WHEN 'GFSI Audit' THEN 'fsqa-audits' ELSE 'unidentified' END AS slug,
  type_name IN ('Certificate of Insurance', 'COA', 'GFSI Audit') AS supported,
  CASE type_name WHEN 'Certificate of Insurance' THEN type_name WHEN 'W-8' THEN type_name WHEN 'GFSI Audit' THEN type_name
  ELSE 'Unidentified' END AS back
FROM e
""")
def q_type_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Type to short name and back, with a default; supported types flagged."""
    e = table(spark, sf, "events")
    names = {"view": D.CERTIFICATE, "click": "W-8", "signup": "COA", "purchase": "GFSI Audit"}
    kind = None
    for event, name in names.items():
        hit = F.col("event_type") == event
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    rows = e.select("event_id", kind.otherwise("Mystery").alias("type_name"))
    types = D.type_table(spark)
    out = D.with_lookup(rows, types, "type_name", "type_name", "slug", D.DEFAULT_SLUG)
    back = D.with_lookup(out, types.withColumnRenamed("type_name", "back"), "slug", "slug", "back")
    return back.select("event_id", "type_name", "slug", D.is_supported(F.col("type_name")).alias("supported"), "back")


TRIAGE_SQL = """
WITH j AS (SELECT l_orderkey, count(*) AS open_jobs FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_orderkey),
d AS (SELECT o_orderkey AS doc_id, o_totalprice < 2000 AS deleted,
  CASE o_custkey % 5 WHEN 0 THEN 'Certificate of Insurance' WHEN 1 THEN 'GFSI Audit' WHEN 2 THEN 'Mystery' WHEN 3 THEN 'COA' ELSE NULL END AS type_name,
  CASE o_orderstatus WHEN 'O' THEN 'Awaiting Approval' WHEN 'F' THEN 'Approved' ELSE 'Rejected' END AS status,
  o_orderpriority = '5-LOW' AS draft, c_acctbal > 0 AS partner, o_orderpriority = '1-URGENT' AS us, COALESCE(open_jobs, 0) AS open_jobs
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN j ON o_orderkey = l_orderkey)
SELECT doc_id, status, type_name, CASE WHEN deleted THEN 'skip-deleted' WHEN type_name IS NULL THEN 'ignore-no-type'
  WHEN type_name = 'Mystery' AND status <> 'Approved' THEN 'ignore-unsupported'
  WHEN draft AND status <> 'Awaiting Approval' THEN 'reset-draft' WHEN partner IS NOT TRUE THEN 'diagnostic'
  WHEN status = 'Awaiting Approval' THEN 'queue' WHEN us AND open_jobs > 0 THEN 'finish'
  WHEN us AND status = 'Approved' THEN 'reprocess' WHEN us THEN 'none'
  WHEN status = 'Approved' THEN 'queue-no-rejection' ELSE 'cancel' END AS route
FROM d
"""


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as supplier documents, their customer as the business, open lines as open jobs."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    jobs = table(spark, sf, "lineitem").where("l_linestatus = 'O'").groupBy("l_orderkey").agg(F.count("*").alias("open_jobs"))
    joined = o.join(c, o.o_custkey == c.c_custkey, "left").join(jobs, o.o_orderkey == jobs.l_orderkey, "left")
    status = F.when(F.col("o_orderstatus") == "O", "Awaiting Approval").when(F.col("o_orderstatus") == "F", "Approved").otherwise("Rejected")
    return joined.select(
        F.col("o_orderkey").alias("doc_id"), F.lit(1).alias("version"),
        (F.col("o_totalprice") < 2000).alias("deleted"),
        pick([D.CERTIFICATE, "GFSI Audit", "Mystery", "COA", None], F.col("o_custkey") % 5).alias("type_name"),
        status.alias("status"), (F.col("o_orderpriority") == "5-LOW").alias("draft"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("p"), F.col("c_custkey").cast("string"))).alias("masterid"),
        (F.col("o_orderpriority") == "1-URGENT").alias("us"), F.coalesce("open_jobs", F.lit(0)).alias("open_jobs"),
        "o_orderdate")


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    d = _documents(spark, sf)
    return d.withColumn("route", D.triage(
        F.col("deleted"), F.col("type_name"), F.col("status"), D.is_supported(F.col("type_name")), F.col("draft"),
        F.col("masterid").isNotNull(), F.col("us"), F.col("open_jobs")))


@query(TRIAGE_SQL)
def q_triage(spark: SparkSession, sf: str) -> DataFrame:
    """Route of each changed document, with its partner and open jobs joined."""
    return _routed(spark, sf).select("doc_id", "status", "type_name", "route")


@query(TRIAGE_SQL)
def q_stream_triage(spark: SparkSession, sf: str) -> DataFrame:
    """The same routes from a stream of change events, some of which carry no document."""
    use_utc(spark)
    schema = spark.read.parquet(f"{sf}/orders.parquet").schema
    orders = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
    status = F.when(F.col("o_orderstatus") == "O", "Awaiting Approval").when(F.col("o_orderstatus") == "F", "Approved").otherwise("Rejected")
    mirror = F.struct(
        F.lit(1).alias("version"), (F.col("o_totalprice") < 2000).alias("deleted"),
        pick([D.CERTIFICATE, "GFSI Audit", "Mystery", "COA", None], F.col("o_custkey") % 5).alias("type_name"),
        status.alias("status"), (F.col("o_orderpriority") == "5-LOW").alias("draft"), (F.col("o_orderpriority") == "1-URGENT").alias("us"))
    events = orders.withColumn("mirrored", F.explode(F.array(F.lit(True), F.lit(False)))).select(
        F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").alias("business_id"), F.when(F.col("mirrored"), mirror).alias("mirror"))

    def partners(session: SparkSession) -> DataFrame:
        c = table(session, sf, "customer").where("c_acctbal > 0")
        return c.select(F.col("c_custkey").alias("business_id"), F.concat(F.lit("p"), F.col("c_custkey")).alias("masterid"))

    def jobs(session: SparkSession) -> DataFrame:
        return table(session, sf, "lineitem").where("l_linestatus = 'O'").groupBy(F.col("l_orderkey").alias("doc_id")).agg(
            F.count("*").alias("open_jobs"))

    base = scratch_dir(spark, "triage")
    start_triage(events, partners, jobs, f"{base}/routes", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/routes").select("doc_id", "status", "type_name", "route")


@query(f"""
SELECT md5(doc_id || '|1') AS job_id, doc_id, status, route NOT IN ('reprocess', 'queue-no-rejection') AS allow_rejection
FROM ({TRIAGE_SQL}) WHERE route IN ('queue', 'diagnostic', 'reprocess', 'queue-no-rejection')
""")
def q_work_items(spark: SparkSession, sf: str) -> DataFrame:
    """Work items of the routes that queue one."""
    return D.work_items(_routed(spark, sf)).select("job_id", "doc_id", "status", "allow_rejection")


@query("""
SELECT 'd' || o_orderkey AS document_id, 'Awaiting Approval' AS new_status
FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderdate >= DATE '1998-06-15'
""")
def q_draft_resets(spark: SparkSession, sf: str) -> DataFrame:
    """Drafts of the last 24 months that go back to awaiting approval."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("updated"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("d"), F.col("o_orderkey").cast("string"))).alias("draft_id"))
    return D.draft_resets(o, F.lit("2000-06-15").cast("date"))


@query("""
WITH d AS (SELECT o_orderkey AS assessment_id, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS job,
  o_custkey % 7 <> 0 AS type_known, o_custkey % 5 <> 0 AS template,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Submitted' WHEN '2-HIGH' THEN 'Approved' WHEN '3-MEDIUM' THEN 'Rejected' ELSE 'In Progress' END AS state,
  o_orderstatus <> 'F' AS allow_rejection, o_totalprice > 250000 AS failed FROM orders)
SELECT assessment_id, CASE WHEN NOT job THEN 'ignore-no-job' WHEN NOT type_known THEN 'ignore-type' WHEN NOT template THEN 'ignore-template'
  WHEN state = 'Submitted' THEN 'queue' WHEN state = 'Approved' THEN 'finish'
  WHEN state = 'Rejected' THEN CASE WHEN allow_rejection THEN 'associated-assessment-rejected' ELSE 'finish-approved' END
  ELSE 'skip' END AS route, CASE WHEN allow_rejection THEN CASE WHEN failed THEN 'Rejected' ELSE 'Approved' END END AS auto_state FROM d
""")
def q_assessment_triage(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    jobs = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("job", F.lit(True))
    d = o.join(jobs, "o_orderkey", "left")
    state = (F.when(F.col("o_orderpriority") == "1-URGENT", "Submitted").when(F.col("o_orderpriority") == "2-HIGH", "Approved")
             .when(F.col("o_orderpriority") == "3-MEDIUM", "Rejected").otherwise("In Progress"))
    allow = F.col("o_orderstatus") != "F"
    return d.select(
        F.col("o_orderkey").alias("assessment_id"),
        D.assessment_triage(F.col("job"), F.col("o_custkey") % 7 != 0, F.col("o_custkey") % 5 != 0, state, allow).alias("route"),
        V.assessment_state(F.col("o_totalprice") > 250000, allow).alias("auto_state"))


ERROR_SQL = """
WITH e AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN text || ' This is a MULTI-page file.' WHEN 1 THEN 'Valiadation failed: ' || text
  WHEN 2 THEN 'File is not a textual PDF ' || text WHEN 3 THEN text || ' file format was not recognized; validation failed'
  WHEN 4 THEN text || ' file is not a textual pdf' WHEN 5 THEN NULL ELSE text END AS message, doc_id % 11 = 0 AS approved,
  CASE WHEN doc_id % 3 = 0 THEN 'success' WHEN doc_id % 3 = 1 THEN 'failure' ELSE 'running' END AS status FROM documents),
c AS (SELECT *, CASE WHEN regexp_matches(message, '(?i)file format was not recognized') OR regexp_matches(message, '(?i)^file is not a textual pdf') THEN 'target-unrecognized'
  WHEN regexp_matches(message, '(?i)(validation|valiadation) failed') THEN 'target-validation'
  WHEN regexp_matches(message, '(?i)this is a multi-.* file') THEN 'target-multiple-docs-combined' ELSE 'target-other' END AS error_class FROM e)
SELECT doc_id, error_class, CASE WHEN approved AND status <> 'running' THEN 'finish' WHEN status = 'success' THEN 'validate'
  WHEN status = 'failure' THEN error_class ELSE 'wait' END AS outcome FROM c
"""


@query(ERROR_SQL)
def q_error_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Error text of the first error update, its class, and what follows."""
    d = table(spark, sf, "documents")
    t, m = F.col("text"), F.col("doc_id") % 7
    message = (F.when(m == 0, F.concat(t, F.lit(" This is a MULTI-page file."))).when(m == 1, F.concat(F.lit("Valiadation failed: "), t))
               .when(m == 2, F.concat(F.lit("File is not a textual PDF "), t))
               .when(m == 3, F.concat(t, F.lit(" file format was not recognized; validation failed")))
               .when(m == 4, F.concat(t, F.lit(" file is not a textual pdf"))).when(m == 5, F.lit(None)).otherwise(t))
    updates = F.array(F.struct(F.lit("start").alias("status"), F.lit("x").alias("information")),
                      F.struct(F.lit("error").alias("status"), message.alias("information")))
    status = pick(["success", "failure", "running"], F.col("doc_id") % 3)
    c = d.select("doc_id", D.classify_error(D.first_error(updates)).alias("error_class"), status.alias("status"))
    return c.select("doc_id", "error_class",
                    D.extraction_outcome(F.col("status"), F.col("doc_id") % 11 == 0, F.col("error_class")).alias("outcome"))


@query("""
WITH e AS (SELECT o_orderkey AS job_id, 1 + o_custkey % 4 AS n_expected FROM orders),
s AS (SELECT l_orderkey AS job_id, l_linenumber AS attachment, l_partkey * 1000000000 + l_linenumber * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS seq,
  CASE WHEN l_returnflag = 'A' THEN 'running' WHEN l_linestatus = 'O' THEN 'success' ELSE 'failure' END AS status FROM lineitem),
p AS (SELECT job_id, attachment, max_by(status, seq) AS status, max(seq) AS seq FROM s WHERE status <> 'running' GROUP BY 1, 2),
g AS (SELECT job_id, count(*) AS n_final, count(*) FILTER (WHERE status = 'success') AS n_success,
  min_by(attachment, seq) FILTER (WHERE status = 'success') AS chosen FROM p GROUP BY 1)
SELECT e.job_id, n_expected, COALESCE(n_final, 0) AS n_final, COALESCE(n_success, 0) AS n_success, chosen, COALESCE(n_final, 0) >= n_expected AS complete
FROM e LEFT JOIN g ON e.job_id = g.job_id
""")
def q_attachment_completion(spark: SparkSession, sf: str) -> DataFrame:
    """Attachments in a final status against the expected number, per work item."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    status = F.when(F.col("l_returnflag") == "A", "running").when(F.col("l_linestatus") == "O", "success").otherwise("failure")
    events = li.select(F.col("l_orderkey").alias("job_id"), F.col("l_linenumber").alias("attachment"), status.alias("status"),
                       (F.col("l_partkey") * 10**9 + F.col("l_linenumber").cast("bigint") * 10**8
                        + F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("seq"))
    expected = o.select(F.col("o_orderkey").alias("job_id"), (1 + F.col("o_custkey") % 4).alias("n_expected"))
    return D.completion(events, expected)


@query("""
WITH d AS (SELECT o_orderkey AS job_id, CASE WHEN o_custkey % 4 <> 0 THEN 'cois' END AS result_type,
  CASE WHEN o_custkey % 8 <> 1 THEN 'r' || o_orderkey END AS result_key, CASE WHEN o_custkey % 3 <> 0 THEN 'sds' END AS declared_type,
  'k' || o_custkey AS declared_key, o_orderpriority = '5-LOW' AS bad, o_orderstatus <> 'F' AS allow_rejection FROM orders),
k AS (SELECT *, COALESCE(CASE WHEN NOT bad THEN result_type END, declared_type) AS filed_type FROM d),
f AS (SELECT *, COALESCE(CASE WHEN filed_type = result_type THEN result_key END, CASE WHEN NOT allow_rejection THEN declared_key END) AS filed_key FROM k)
SELECT job_id, filed_type, filed_key, CASE WHEN filed_type IS NULL THEN 'other' WHEN filed_key IS NULL THEN 'target-invalid-result' ELSE 'filed' END AS outcome FROM f
""")
def q_completion_result(spark: SparkSession, sf: str) -> DataFrame:
    """Which result a finished work item files, or why it cannot."""
    o = table(spark, sf, "orders")
    s = lambda c: F.col(c).cast("string")
    out = D.completion_result(
        F.when(F.col("o_custkey") % 4 != 0, "cois"), F.when(F.col("o_custkey") % 8 != 1, F.concat(F.lit("r"), s("o_orderkey"))),
        F.when(F.col("o_custkey") % 3 != 0, "sds"), F.concat(F.lit("k"), s("o_custkey")),
        F.col("o_orderpriority") == "5-LOW", F.col("o_orderstatus") != "F")
    return o.select(F.col("o_orderkey").alias("job_id"), *[c.alias(n) for n, c in out.items()])


@query("""
WITH d AS (SELECT o_orderkey AS doc_id, CASE WHEN o_custkey % 3 = 0 THEN 'approve' WHEN o_custkey % 3 = 1 THEN 'reject' ELSE 'later' END AS decision,
  CASE WHEN o_custkey % 2 = 0 THEN ' please fix ' ELSE ' ' END AS message,
  CASE o_orderstatus WHEN 'O' THEN 'Awaiting Approval' WHEN 'F' THEN 'Approved' ELSE NULL END AS current,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'draft ' || o_orderkey END AS draft_id, o_orderkey % 13 <> 0 AS ids FROM orders),
w AS (SELECT *, CASE decision WHEN 'approve' THEN 'Approved' WHEN 'reject' THEN 'Rejected' END AS new_status,
  CASE WHEN decision = 'reject' THEN trim(message) ELSE '' END AS comment FROM d),
x AS (SELECT *, CASE WHEN NOT ids THEN 'missing-id' WHEN new_status IS NULL THEN 'bad-status' WHEN new_status = 'Rejected' AND comment = '' THEN 'missing-message' END AS error FROM w)
SELECT doc_id, new_status, comment, COALESCE(draft_id, CAST(doc_id AS VARCHAR)) AS document_id, COALESCE(new_status = 'Rejected', false) AS visible_to_supplier, error,
  CASE WHEN error IS NOT NULL THEN 'failed' WHEN current = 'Approved' THEN 'skipped' ELSE 'submitted' END AS writeback FROM x
""")
def q_review_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Review decisions checked, and what each would write."""
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    out = D.review_decision(
        F.lit(None).cast("string"), pick(["approve", "reject", "later"], F.col("o_custkey") % 3),
        F.when(F.col("o_custkey") % 2 == 0, " please fix ").otherwise(" "),
        F.when(F.col("o_orderstatus") == "O", "Awaiting Approval").when(F.col("o_orderstatus") == "F", "Approved"),
        key, F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("draft "), key)), F.col("o_orderkey") % 13 != 0)
    return o.select(F.col("o_orderkey").alias("doc_id"), *[c.alias(n) for n, c in out.items()])


@query("""
WITH l AS (SELECT l_orderkey, min(CASE WHEN l_partkey % 9 <> 0 THEN CAST(l_shipdate AS DATE) END) AS lowest FROM lineitem GROUP BY 1),
d AS (SELECT o_orderkey AS doc_id, CASE o_custkey % 3 WHEN 0 THEN 'Certificate of Insurance' WHEN 1 THEN '100g Nutritional Information' ELSE 'W-8' END AS type_name,
  CAST(o_orderdate AS DATE) AS declared, lowest, CASE WHEN o_orderstatus = 'F' THEN 'Approved' ELSE 'Awaiting Approval' END AS status FROM orders LEFT JOIN l ON l_orderkey = o_orderkey),
m AS (SELECT *, CASE WHEN type_name = 'W-8' THEN 'Validation failed: Validation of type W-8 unsupported'
  WHEN lowest IS NULL THEN 'Validation failed: Could not extract expiration dates from PDF.'
  WHEN lowest <= DATE '1997-06-01' THEN 'Minimum expiration date found on the document indicates it is already expired: ' || lowest
  WHEN declared > lowest THEN 'Expiration date submitted in the source system (' || declared || ') does not match the minimum expiration date found in the PDF document (' || lowest || ').'
  ELSE '' END AS message FROM d)
SELECT doc_id, message = '' AS valid, message, CASE WHEN status = 'Approved' THEN 'finish' WHEN message <> '' THEN 'document-validation' ELSE 'end' END AS next FROM m
""")
def q_validate_expiry(spark: SparkSession, sf: str) -> DataFrame:
    """Declared expiry against the earliest usable extracted date."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    found = F.when(F.col("l_partkey") % 9 == 0, F.lit(V.BAD_DAY).cast("date")).otherwise(F.col("l_shipdate").cast("date"))
    lowest = li.groupBy("l_orderkey").agg(F.min(V.usable_day(found)).alias("lowest"))
    d = o.join(lowest, o.o_orderkey == lowest.l_orderkey, "left")
    kind = pick([D.CERTIFICATE, "100g Nutritional Information", "W-8"], F.col("o_custkey") % 3)
    status = F.when(F.col("o_orderstatus") == "F", "Approved").otherwise("Awaiting Approval")
    v = V.expiry_verdict(kind, F.col("o_orderdate"), F.col("lowest"), F.lit("1997-06-01").cast("timestamp"))
    return d.select(F.col("o_orderkey").alias("doc_id"), *[c.alias(n) for n, c in v.items()],
                    V.after_validation(v["valid"], status).alias("next"))


def _assessments(spark: SparkSession, sf: str) -> DataFrame:
    """A nested template per line item: three coverages, an umbrella and a yes/no column."""
    li = table(spark, sf, "lineitem")
    whole = lambda c: F.round(F.col(c)).cast("bigint")
    none = F.lit(None)

    def column(i, name, kind, accept, percent, needed=none, wanted=none):
        return F.struct(F.lit(i).alias("id"), F.lit(name).alias("name"), F.lit(kind).alias("type"), accept.alias("acceptance_type"),
                        percent.cast("int").alias("percent"), needed.cast("bigint").alias("required_numeric"),
                        wanted.cast("boolean").alias("required_bool"), none.cast("bigint").alias("average"))

    def answer(i, number=none, flag=none):
        return F.struct(F.lit(i).alias("column"), number.cast("bigint").alias("answer_numeric"), flag.cast("boolean").alias("answer_bool"))

    low = F.when(F.col("l_quantity") < 25, 50).otherwise(100)
    question = F.struct(
        F.array(column("a", "Quantity", "numeric", F.lit("min"), low, F.lit(30)),
                column("b", "Price", "numeric", F.when(F.col("l_linestatus") == "O", "none").otherwise("min"), F.lit(10), F.lit(50000)),
                column("u", V.UMBRELLA, "numeric", F.lit("none"), F.lit(0)),
                column("w", "Returned", "bool", F.lit("bool"), F.when(F.col("l_returnflag") == "R", 0).otherwise(100), none, F.lit(True))
                ).alias("columns"),
        F.array(answer("a", whole("l_quantity")), answer("b", whole("l_extendedprice")), answer("u", F.col("l_suppkey") % 10),
                answer("w", none, F.lit(False))).alias("answers"))
    sections = F.array(F.struct(F.array(F.struct(F.array(question).alias("questions"))).alias("subsections")))
    key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return li.select(key.alias("assessment_id"), sections.alias("sections"))


@query("""
WITH a AS (SELECT *, l_quantity < 25 AND round(l_quantity) + l_suppkey % 10 < 30 AS f1,
  l_linestatus <> 'O' AND round(l_extendedprice) + l_suppkey % 10 < 50000 AS f2, l_returnflag = 'R' AS f3 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, bool_or(f1 OR f2 OR f3) AS failed,
  CAST(sum(f1::INT + f2::INT + f3::INT) AS BIGINT) AS n_failed
FROM a GROUP BY ALL
""")
def q_template_check(spark: SparkSession, sf: str) -> DataFrame:
    """Insurance template: scored columns against requirements, leaning on the umbrella."""
    return V.check_template(_assessments(spark, sf), insurance=True).select("assessment_id.*", "failed", "n_failed")


@query("""
WITH a AS (SELECT *, CAST(round(l_quantity) AS BIGINT) AS q, CAST(round(l_extendedprice) AS BIGINT) AS p, l_suppkey % 10 AS u FROM lineitem)
SELECT reason, count(*) AS n FROM (
  SELECT 'The sum of Quantity(' || q || ') and Umbrella Coverage(' || u || ') was ' || (q + u) || '. This does not meet the required coverage (30)' AS reason FROM a WHERE l_quantity < 25 AND q + u < 30
  UNION ALL SELECT 'The sum of Price(' || p || ') and Umbrella Coverage(' || u || ') was ' || (p + u) || '. This does not meet the required coverage (50000)' FROM a WHERE l_linestatus <> 'O' AND p + u < 50000
  UNION ALL SELECT 'Returned(false) did not meet the requirement (true)' FROM a WHERE l_returnflag = 'R')
GROUP BY reason
""")
def q_template_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return V.template_reasons(_assessments(spark, sf), insurance=True).groupBy("reason").agg(F.count("*").alias("n"))


@query("""
WITH a AS (SELECT *, l_quantity < 25 AS f1, l_linestatus <> 'O' AS f2, l_returnflag = 'R' AS f3 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, bool_or(f1 OR f2 OR f3) AS failed, CAST(sum(f1::INT + f2::INT + f3::INT) AS BIGINT) AS n_failed
FROM a GROUP BY ALL
""")
def q_template_generic(spark: SparkSession, sf: str) -> DataFrame:
    """Any other template: a scored column must be fully within tolerance."""
    return V.check_template(_assessments(spark, sf), insurance=False).select("assessment_id.*", "failed", "n_failed")
