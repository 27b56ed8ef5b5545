"""Insurance certificate flow over the shared tables.

A customer stands for a supplier, its orders for certificate documents, and
each line item for one extracted policy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provender.functions.dates import earliest
from provender.operators import cases as C
from provender.operators import extractions as X
from provender.operators import policies as P
from provender.operators import validate as V
from provender.operators.merge import latest_per_key
from provender.operators.ordered import with_position
from provender.plans.catalog import Catalog
from provender.plans.tables import table

catalog = Catalog()
QUERIES, SQL, query = catalog.queries, catalog.sql, catalog.query

AS_OF = "1998-06-01"
RULE = P.HolderRule(name_has="acme", state="va", city="springfield", street_has="commerce")


def policies(spark: SparkSession, sf: str) -> DataFrame:
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    text = lambda c: c.cast("string")
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    kind = (F.when((flag == "A") & (line == "F"), P.SLOT_TYPES["cgl"]).when((flag == "N") & (line == "F"), P.SLOT_TYPES["cgl"])
            .when(flag == "A", P.SLOT_TYPES["al"]).when((flag == "R") & (line == "F"), P.SLOT_TYPES["ul"])
            .when(flag == "R", P.SLOT_TYPES["wcel"]).otherwise("Worker's Compensation"))
    base = F.floor("l_extendedprice").cast("bigint")
    amount = lambda times: F.when(F.col("l_suppkey") % 10 == 0, "n/a").otherwise(F.concat(text(base * times), F.lit(".50")))
    expires = F.when(F.col("l_partkey") % 41 == 0, F.lit("1900-12-30").cast("timestamp_ntz")).otherwise(F.col("l_shipdate"))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("supplier_id"), F.col("l_orderkey").alias("doc_id"),
        (F.col("l_orderkey") * 10**12 + F.col("l_linenumber").cast("bigint") * 10**11 + F.col("l_partkey") * 10**4 + F.col("l_suppkey")).alias("ord"),
        F.concat(F.lit("c"), text(F.col("l_orderkey")), F.lit("-"), text(F.col("l_linenumber"))).alias("cert_id"),
        kind.alias("type"),
        F.when(F.col("l_linenumber") != 4, F.concat(F.lit("P"), text(F.col("l_partkey") % 3))).alias("number"),
        F.col("o_orderdate").cast("timestamp").alias("effective_date"), expires.cast("timestamp").alias("expire_date"),
        amount(7).alias("each_occurrence"), amount(20).alias("general_aggregate"), amount(3).alias("products_compop_agg"),
        amount(5).alias("combined_single_limit"), amount(6).alias("el_each_accident"), amount(2).alias("el_disease_employee"),
        amount(2).alias("el_disease_limit"), F.when(F.col("l_tax") < 0.07, "1").otherwise("0").alias("per_statute"))


POLICIES_SQL = f"""
raw AS (SELECT o_custkey AS supplier_id, l_orderkey AS doc_id, l_linenumber, l_partkey, l_suppkey, o_orderdate AS effective_date,
  l_orderkey * 1000000000000 + l_linenumber::BIGINT * 100000000000 + l_partkey * 10000 + l_suppkey AS ord,
  CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_returnflag = 'R' THEN 'ul' ELSE 'cgl' END
       WHEN l_returnflag = 'A' THEN 'al' WHEN l_returnflag = 'R' THEN 'wcel' ELSE 'wc' END AS slot,
  CASE WHEN l_linenumber <> 4 THEN 'P' || (l_partkey % 3) END AS number,
  CASE WHEN l_partkey % 41 = 0 THEN TIMESTAMP '1900-12-30' ELSE l_shipdate END AS expire_date,
  CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS base, l_tax < 0.07 AS statute
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
act AS (SELECT *, row_number() OVER (PARTITION BY supplier_id, slot, number ORDER BY ord) AS rn FROM raw
  WHERE expire_date > TIMESTAMP '{AS_OF}' OR year(expire_date) = 1900),
kept AS (SELECT * FROM act WHERE number IS NULL OR rn = 1),
lows AS (SELECT supplier_id, min(expire_date) FILTER (WHERE year(expire_date) <> 1900) AS min_expire, count(*) AS n_policies FROM raw GROUP BY 1),
slots AS (SELECT supplier_id,
  count(*) FILTER (WHERE slot = 'cgl') AS cgl_n, min(expire_date) FILTER (WHERE slot = 'cgl') AS cgl_expire,
  min(effective_date) FILTER (WHERE slot = 'cgl') AS cgl_effective,
  CAST(sum(base * 7) FILTER (WHERE slot = 'cgl') AS BIGINT) AS occ, CAST(sum(base * 20) FILTER (WHERE slot = 'cgl') AS BIGINT) AS agg,
  min(expire_date) FILTER (WHERE slot = 'al') AS al_expire, CAST(sum(base * 5) FILTER (WHERE slot = 'al') AS BIGINT) AS csl,
  min(expire_date) FILTER (WHERE slot = 'ul') AS ul_expire, CAST(sum(base * 7) FILTER (WHERE slot = 'ul') AS BIGINT) AS umb,
  count(*) FILTER (WHERE slot = 'wcel') AS wcel_n, min(expire_date) FILTER (WHERE slot = 'wcel') AS wcel_expire,
  CAST(sum(base * 6) FILTER (WHERE slot = 'wcel') AS BIGINT) AS acc, bool_and(statute) FILTER (WHERE slot = 'wcel') AS statute
  FROM kept GROUP BY 1),
comp AS (SELECT l.supplier_id, min_expire, n_policies, COALESCE(cgl_n, 0) AS cgl_n, cgl_effective, cgl_expire, occ, agg, al_expire, csl, ul_expire, umb,
  COALESCE(wcel_n, 0) AS wcel_n, wcel_expire, acc, statute FROM lows l LEFT JOIN slots s ON l.supplier_id = s.supplier_id)
"""


def composed(spark: SparkSession, sf: str) -> DataFrame:
    return P.compose_policies(policies(spark, sf), ["supplier_id"], F.lit(AS_OF).cast("timestamp"))


@query(f"""
WITH {POLICIES_SQL}
SELECT supplier_id, cgl_n, CAST(cgl_effective AS DATE) AS cgl_effective, CAST(cgl_expire AS DATE) AS cgl_expire, occ AS cgl_occurrence,
  agg AS cgl_aggregate, csl AS al_limit, umb AS umbrella, wcel_n, acc AS wcel_accident, statute AS wcel_per_statute FROM comp
""")
def q_policy_compose(spark: SparkSession, sf: str) -> DataFrame:
    """Policies of a supplier combined by type: once per number, minimum dates, summed money."""
    c = composed(spark, sf)
    return c.select(
        "supplier_id", "cgl_n", F.col("cgl_effective").cast("date").alias("cgl_effective"),
        F.col("cgl_expire").cast("date").alias("cgl_expire"), F.col("cgl_each_occurrence").alias("cgl_occurrence"),
        F.col("cgl_general_aggregate").alias("cgl_aggregate"), F.col("al_combined_single_limit").alias("al_limit"),
        F.col("ul_each_occurrence").alias("umbrella"), "wcel_n", F.col("wcel_el_each_accident").alias("wcel_accident"), "wcel_per_statute")


@query(f"""
WITH {POLICIES_SQL}, d AS (SELECT o_orderkey AS doc_id, o_custkey AS supplier_id, strftime(o_orderdate, '%Y-%m-%d') AS declared_day FROM orders),
m AS (SELECT d.*, c.min_expire, c.n_policies, least(CASE WHEN year(cgl_expire) <> 1900 THEN cgl_expire END, CASE WHEN year(al_expire) <> 1900 THEN al_expire END,
  CASE WHEN year(ul_expire) <> 1900 THEN ul_expire END, CASE WHEN year(wcel_expire) <> 1900 THEN wcel_expire END) AS slot_min
  FROM d LEFT JOIN comp c ON d.supplier_id = c.supplier_id)
SELECT doc_id, supplier_id, CAST(least(min_expire, slot_min) AS DATE) AS combined_expire, n_policies,
  strftime(slot_min, '%Y-%m-%d') AS min_expiration, slot_min > TIMESTAMP '{AS_OF}' AS expiry_passed,
  COALESCE(strftime(slot_min, '%Y-%m-%d') < declared_day, false) AS expiry_mismatch FROM m
""")
def q_certificate_combine(spark: SparkSession, sf: str) -> DataFrame:
    """Earliest expiry over all policies, and over the composed ones against the declared day."""
    as_of = F.lit(AS_OF).cast("timestamp")
    c = _docs(spark, sf).join(composed(spark, sf), "supplier_id", "left")
    check = P.check_expiry(F.col("declared_day"), as_of)
    slot_min = F.to_timestamp(check["min_expiration"])
    return c.select("doc_id", "supplier_id", earliest(F.col("min_expire"), slot_min).cast("date").alias("combined_expire"), "n_policies",
                    *[check[k].alias(k) for k in ("min_expiration", "expiry_passed", "expiry_mismatch")])


@query("""
SELECT DISTINCT o_custkey AS supplier_id, 'c' || l_orderkey || '-' || l_linenumber AS cert_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def q_certificate_members(spark: SparkSession, sf: str) -> DataFrame:
    """The certificates that make up a supplier's combined one."""
    return P.certificate_members(policies(spark, sf), ["supplier_id"])


LIMITS_SQL = f"""
lim(key, name, long_name, minimum) AS (VALUES ('general_occurrence', 'General Liability', 'General Liability (Per Occurrence)', 2000000),
  ('general_aggregate', 'General Liability', 'General Liability (Aggregate)', 5000000), ('automobile', 'Automobile Liability', 'Automobile Liability', 1000000),
  ('employers', 'Worker''s Compensation Employee Liability', 'Employer''s Liability', 1000000)),
lv AS (SELECT supplier_id, key, name, long_name, minimum, COALESCE(umb, 0) AS umb,
  CASE key WHEN 'general_occurrence' THEN occ WHEN 'general_aggregate' THEN agg WHEN 'automobile' THEN csl ELSE acc END AS amount,
  CASE key WHEN 'automobile' THEN al_expire WHEN 'employers' THEN wcel_expire ELSE cgl_expire END AS expires,
  CASE key WHEN 'general_occurrence' THEN 1 WHEN 'general_aggregate' THEN 2 WHEN 'automobile' THEN 3 ELSE 4 END AS place FROM comp, lim),
lr AS (SELECT *, CASE WHEN amount IS NOT NULL THEN amount + umb END AS effective, amount IS NOT NULL AND year(expires) = 1900 AS warning,
  amount IS NOT NULL AND year(expires) <> 1900 AND amount + umb >= minimum AS passed FROM lv),
lx AS (SELECT *, CASE WHEN amount IS NULL THEN '' WHEN warning THEN amount || ' (Confirm Effective Dates)' ELSE CAST(amount AS VARCHAR) END AS shown,
  CASE WHEN amount IS NULL THEN 'No unexpired ' || name || ' policies found'
       WHEN warning THEN 'Confirm Effective Dates for ' || name || ' policy.'
       WHEN NOT passed THEN 'Insufficient ' || long_name || ' coverage. ' || minimum || ' is required. Coverage' ||
         CASE WHEN umb > 0 THEN ' including Umbrella policy' ELSE '' END || ' is only ' || effective || '.' END AS reason FROM lr)
"""


@query(f"""
WITH {POLICIES_SQL}, {LIMITS_SQL}
SELECT supplier_id, key, CAST(minimum AS BIGINT) AS minimum, effective, shown, passed, warning, COALESCE(reason, '') AS reasons FROM lx
""")
def q_limits(spark: SparkSession, sf: str) -> DataFrame:
    """Each required coverage against the composed policy plus umbrella."""
    c = composed(spark, sf).withColumn("limits", P.check_limits(F.lit(AS_OF).cast("timestamp")))
    return c.select("supplier_id", F.explode_outer("limits").alias("x")).select(
        "supplier_id", F.col("x.key"), F.col("x.minimum"), F.col("x.effective"), F.col("x.shown"), F.col("x.passed"),
        F.col("x.warning"), F.array_join("x.reasons", "; ").alias("reasons"))


def _certificates(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("doc_id"), F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("cert_id"),
        F.when(F.col("l_quantity") > 20, "Acme Foods Inc").otherwise("Other").alias("holder_name"),
        F.when(F.col("l_returnflag") == "A", "VA").otherwise("NC").alias("holder_state"), F.lit("Springfield").alias("holder_city"),
        F.when(F.col("l_linestatus") == "O", "200 Commerce St").alias("holder_street"))


HOLDER_SQL = """
hold AS (SELECT l_orderkey AS doc_id, count(*) AS n_certificates, count(*) FILTER (WHERE l_quantity > 20 AND l_returnflag = 'A' AND l_linestatus = 'O') AS n_good_holders,
  bool_or(l_quantity > 20 AND l_returnflag = 'A' AND l_linestatus = 'O') AS holder_passed FROM lineitem GROUP BY 1)
"""
WORKERS_SQL = f"""
work AS (SELECT supplier_id, CASE WHEN wcel_n = 0 THEN '' WHEN year(wcel_expire) = 1900 THEN CASE WHEN statute THEN 'Yes' ELSE 'No' END || ' (Confirm Effective Dates)'
  WHEN statute THEN 'Yes' ELSE 'No' END AS workers, wcel_n > 0 AND COALESCE(year(wcel_expire) = 1900, false) AS workers_warning,
  wcel_n > 0 AND COALESCE(wcel_expire < TIMESTAMP '{AS_OF}', false) AS workers_expired,
  CASE WHEN wcel_n > 0 AND year(wcel_expire) <> 1900 AND NOT statute THEN 'Worker''s Comp policy is missing per statute requirement.' END AS workers_reason FROM comp)
"""


@query(f"WITH {HOLDER_SQL} SELECT * FROM hold")
def q_holders(spark: SparkSession, sf: str) -> DataFrame:
    """Does any certificate of a document name an acceptable holder."""
    return P.check_holders(_certificates(spark, sf), "doc_id", RULE)


@query("""
SELECT l_orderkey AS doc_id, l_orderkey || '-' || l_linenumber AS cert_id, CASE WHEN l_quantity > 20 THEN 'Acme Foods Inc' ELSE 'Other' END ||
  CASE WHEN l_linestatus = 'O' THEN ',200 Commerce St' ELSE '' END || ',Springfield,' || CASE WHEN l_returnflag = 'A' THEN 'VA' ELSE 'NC' END AS holder_line FROM lineitem
""")
def q_holder_lines(spark: SparkSession, sf: str) -> DataFrame:
    return P.holder_lines(_certificates(spark, sf), "doc_id")


@query(f"WITH {POLICIES_SQL}, {WORKERS_SQL} SELECT supplier_id, workers, workers_warning, workers_expired, workers_reason FROM work")
def q_workers(spark: SparkSession, sf: str) -> DataFrame:
    """Workers' compensation per supplier."""
    c = composed(spark, sf)
    return c.select("supplier_id", *[v.alias(k) for k, v in P.check_workers(F.lit(AS_OF).cast("timestamp")).items()])


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").alias("supplier_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("declared_day"), "o_orderstatus", "o_orderpriority", "o_totalprice")


def _attachments(spark: SparkSession, sf: str) -> DataFrame:
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    s = lambda c: F.col(c).cast("string")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("supplier_id"), F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("seq"),
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("f"), s("l_partkey"))).alias("file_name"),
        F.when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("s"), s("l_partkey"))).alias("stored_name"),
        (F.col("l_suppkey") % 11 != 0).alias("ran"),
        F.when(F.col("l_partkey") % 97 == 0, "Holder is missing").alias("result_error"),
        F.when(F.col("l_partkey") % 101 == 0, "no file").alias("run_error"))


ATTACH_SQL = """
att AS (SELECT o_custkey AS supplier_id, l_orderkey AS doc_id, CASE l_linenumber % 3 WHEN 0 THEN 'f' || l_partkey WHEN 1 THEN 's' || l_partkey
  ELSE 'attachment-' || l_linenumber END AS attachment, CASE WHEN l_suppkey % 11 = 0 THEN 'not-run' WHEN l_partkey % 97 = 0 OR l_partkey % 101 = 0 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN l_partkey % 101 = 0 THEN 'no file' WHEN l_partkey % 97 = 0 THEN 'Holder is missing' END AS error FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
par AS (SELECT supplier_id, bool_or(status = 'failed') AS parsing_error, COALESCE(bool_or(contains(error, 'Holder')), false) AS invalid_holder, count(error) AS n_errors FROM att GROUP BY 1)
"""


@query(f"WITH {ATTACH_SQL} SELECT * FROM att")
def q_attachment_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Status, error and key of each attachment."""
    return P.attachment_outcomes(_attachments(spark, sf))


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as documents: their lines as attachments, and the JSON text of an extraction run."""
    li, name = table(spark, sf, "lineitem"), F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string"))
    kind, part = F.col("l_linenumber") % 3, F.col("l_partkey")
    file_name, stored = F.when(kind == 0, F.concat(F.lit("f"), name)), F.when(kind == 1, F.concat(F.lit("s"), name))
    answer = (
        F.when(part % 7 == 0, '{"results":{"serialized":{"message":"m","cause":{"cause":{"information":"Holder is missing"}}}}}')
        .when(part % 7 == 1, '{"results":{"serialized":{"message":"plain"}}}')
        .when(part % 7 == 2, '{"msg":"no file","serialized":{"message":"x"}}')
        .when(part % 7 == 3, '{"serialized":{"message":"only a message"}}')
        .otherwise(F.format_string('{"results":{"r1":{"_id":"c%s"},"r2":{"name":"no id"}}}', name)))
    entry = F.concat(F.lit('"'), F.coalesce(file_name, stored, F.concat(F.lit("x"), name)), F.lit('":'), answer)
    docs = li.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct(
        "l_linenumber", F.struct(file_name.alias("fileName"), stored.alias("S3Name")).alias("source"), entry.alias("entry")))).alias("lines"))
    run = (F.when(F.col("doc_id") % 11 == 0, None).when(F.col("doc_id") % 11 == 1, '{"msg":"run failed","serialized":{"message":"z"}}')
           .otherwise(F.concat(F.lit("{"), F.array_join("lines.entry", ","), F.lit("}"))))
    return docs.select("doc_id", F.col("lines.source").alias("attachments"), run.alias("run"))


RUN_SQL = """
WITH a AS (
  SELECT l_orderkey AS doc_id, l_linenumber, l_partkey || '-' || l_linenumber AS name, l_partkey % 7 AS part, l_orderkey % 11 AS run,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS place, l_linenumber % 3 AS kind FROM lineitem)
"""


@query(RUN_SQL + """
SELECT doc_id, CASE WHEN kind = 0 THEN 'f' || name WHEN kind = 1 THEN 's' || name WHEN run < 2 THEN 'attachment-' || place ELSE 'x' || name END AS attachment,
       CASE WHEN kind = 0 THEN 'f' || name END AS file_name, CASE WHEN kind = 1 THEN 's' || name END AS stored_name,
       CASE WHEN run < 2 THEN 'not-run' WHEN part < 4 THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN run = 0 THEN NULL WHEN run = 1 THEN 'run failed' WHEN part = 0 THEN 'Holder is missing' WHEN part = 1 THEN 'plain'
            WHEN part = 2 THEN 'no file' WHEN part = 3 THEN 'only a message' END AS error,
       CASE WHEN run > 1 AND part > 3 THEN 'c' || name ELSE '' END AS extracted
FROM a""")
def q_extraction_status(spark: SparkSession, sf: str) -> DataFrame:
    """Status, error and found certificates of each attachment, from the JSON text of runs."""
    return X.attachment_statuses(_runs(spark, sf)).withColumn("extracted", F.array_join("extracted", ","))


@query(RUN_SQL + """
SELECT doc_id, CASE kind WHEN 0 THEN 'f' || name WHEN 1 THEN 's' || name ELSE 'x' || name END AS attachment, 'c' || name AS certificate_id
FROM a WHERE run > 1 AND part > 3""")
def q_valid_extractions(spark: SparkSession, sf: str) -> DataFrame:
    """Certificates with an id that runs found."""
    return X.valid_extractions(_runs(spark, sf)).drop("certificate")


@query(f"WITH {ATTACH_SQL} SELECT * FROM par")
def q_parsing_errors(spark: SparkSession, sf: str) -> DataFrame:
    return P.parsing_errors(P.attachment_outcomes(_attachments(spark, sf)))


@query("""
SELECT DISTINCT o_orderkey AS doc_id, o_custkey AS supplier_id, CASE o_orderstatus WHEN 'O' THEN 'Awaiting Approval' ELSE 'Approved' END AS status FROM orders
WHERE (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND o_totalprice < 400000)
   OR (o_orderstatus = 'F' AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND o_totalprice < 400000))
""")
def q_supplier_certificates(spark: SparkSession, sf: str) -> DataFrame:
    """Certificates that await approval plus the approved ones of the same suppliers."""
    d = _docs(spark, sf)
    status = F.when(F.col("o_orderstatus") == "O", "Awaiting Approval").otherwise("Approved")
    rows = d.withColumn("status", status)
    awaiting = rows.where(P.to_report(F.when(F.col("o_orderstatus") == "O", F.col("status")), F.col("o_totalprice") >= 400000,
                                      F.when(F.col("o_orderpriority") != "1-URGENT", "x")))
    out = P.supplier_certificates(awaiting, rows.where("o_orderstatus = 'F'"), "supplier_id", "doc_id")
    return out.select("doc_id", "supplier_id", "status")


ASSESS_SQL = f"""
WITH {POLICIES_SQL}, {LIMITS_SQL}, {HOLDER_SQL}, {WORKERS_SQL}, {ATTACH_SQL},
sup AS (SELECT supplier_id, bool_and(passed) AS limits_ok, bool_or(warning) AS date_warning,
  string_agg(reason, chr(10) ORDER BY place) FILTER (WHERE reason IS NOT NULL AND NOT (key = 'general_aggregate' AND COALESCE(dup, false))) AS limit_reasons
  FROM (SELECT *, lag(reason) OVER (PARTITION BY supplier_id ORDER BY place) = reason AS dup FROM lx) GROUP BY 1),
slotmin AS (SELECT supplier_id, least(CASE WHEN year(cgl_expire) <> 1900 THEN cgl_expire END, CASE WHEN year(al_expire) <> 1900 THEN al_expire END,
  CASE WHEN year(ul_expire) <> 1900 THEN ul_expire END, CASE WHEN year(wcel_expire) <> 1900 THEN wcel_expire END) AS low FROM comp),
base AS (SELECT o_orderkey AS doc_id, o_custkey AS supplier_id, strftime(o_orderdate, '%Y-%m-%d') AS declared_day FROM orders WHERE o_orderstatus = 'O'),
j AS (SELECT b.*, COALESCE(limits_ok, false) AS limits_ok, COALESCE(date_warning, false) AS date_warning, limit_reasons, low,
  COALESCE(low > TIMESTAMP '{AS_OF}', false) AS expiry_ok, COALESCE(workers, '') AS workers, workers_reason, COALESCE(workers_warning, false) AS workers_warning,
  COALESCE(workers_expired, false) AS workers_expired, COALESCE(holder_passed, false) AS holder_ok, COALESCE(parsing_error, false) AS parsing_error,
  COALESCE(invalid_holder, false) AS invalid_holder, COALESCE(strftime(low, '%Y-%m-%d') < declared_day, false) AS expiry_mismatch, comp.supplier_id IS NULL AS bare, umb
  FROM base b LEFT JOIN sup ON b.supplier_id = sup.supplier_id LEFT JOIN slotmin ON b.supplier_id = slotmin.supplier_id LEFT JOIN work ON b.supplier_id = work.supplier_id
  LEFT JOIN hold ON b.doc_id = hold.doc_id LEFT JOIN par ON b.supplier_id = par.supplier_id LEFT JOIN comp ON b.supplier_id = comp.supplier_id),
a AS (SELECT *, limits_ok AND expiry_ok AND starts_with(workers, 'Yes') AND holder_ok AS passed,
  concat_ws(chr(10), CASE WHEN parsing_error THEN 'PDF extraction errors occurred.' || CASE WHEN invalid_holder THEN ' Invalid Holder info detected.' ELSE '' END END,
    CASE WHEN bare THEN 'No unexpired General Liability policies found' || chr(10) || 'No unexpired Automobile Liability policies found' || chr(10) || 'No unexpired Worker''s Compensation Employee Liability policies found' ELSE limit_reasons END,
    workers_reason, CASE WHEN NOT holder_ok THEN 'Holder info does not meet requirements.' END) AS reasons FROM j),
f AS (SELECT *, CASE WHEN passed THEN 'approve' WHEN parsing_error OR date_warning THEN 'review' ELSE 'reject' END AS recommendation FROM a)
"""


def _awaiting(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).where("o_orderstatus = 'O'").select("doc_id", "supplier_id", "declared_day")


def assessed(spark: SparkSession, sf: str, legacy_truthy: bool = False, docs: DataFrame | None = None) -> DataFrame:
    docs = _awaiting(spark, sf) if docs is None else docs
    holders = P.check_holders(_certificates(spark, sf), "doc_id", RULE)
    parsing = P.parsing_errors(P.attachment_outcomes(_attachments(spark, sf)))
    return P.assess(docs, composed(spark, sf), holders, parsing, F.lit(AS_OF).cast("timestamp"), legacy_truthy)


@query(f"""{ASSESS_SQL}
SELECT doc_id, supplier_id, passed, recommendation, reasons, strftime(low, '%Y-%m-%d') AS min_expiration, expiry_mismatch, parsing_error FROM f
""")
def q_assess(spark: SparkSession, sf: str) -> DataFrame:
    """Overall assessment and recommendation of each awaiting document."""
    return assessed(spark, sf).select("doc_id", "supplier_id", "passed", "recommendation", F.array_join("reasons", "\n").alias("reasons"),
                                      "min_expiration", "expiry_mismatch", "parsing_error")


@query(f"""{ASSESS_SQL}
SELECT "check", status, count(*) AS n FROM (
  SELECT 'extraction.parsing' AS "check", CASE WHEN parsing_error THEN 'fail' ELSE 'pass' END AS status FROM f
  UNION ALL SELECT 'expiration.minimum', CASE WHEN low IS NULL THEN 'unknown' WHEN expiry_ok THEN 'pass' ELSE 'fail' END FROM f
  UNION ALL SELECT 'expiration.declared', CASE WHEN expiry_mismatch THEN 'fail' ELSE 'pass' END FROM f
  UNION ALL SELECT 'workers.per-statute', CASE WHEN workers_warning THEN 'warn' WHEN starts_with(workers, 'Yes') THEN 'pass' ELSE 'fail' END FROM f
  UNION ALL SELECT 'holder.address', CASE WHEN holder_ok THEN 'pass' ELSE 'fail' END FROM f
  UNION ALL SELECT 'coverage.' || lim.key, CASE WHEN COALESCE(warning, false) THEN 'warn' WHEN COALESCE(lx.passed, false) THEN 'pass' ELSE 'fail' END
    FROM f CROSS JOIN lim LEFT JOIN lx ON f.supplier_id = lx.supplier_id AND lim.key = lx.key)
GROUP BY 1, 2
""")
def q_check_list(spark: SparkSession, sf: str) -> DataFrame:
    """Check list of all assessed documents, counted by check and status."""
    return P.check_list(assessed(spark, sf)).groupBy("check", "status").agg(F.count("*").alias("n"))


@query(f"""{ASSESS_SQL}, lp AS (SELECT supplier_id, max(shown) FILTER (WHERE key = 'automobile') AS automobile,
  max(CASE WHEN passed THEN 'none' WHEN warning THEN 'warn' WHEN shown = '' THEN 'blank' ELSE 'fail' END) FILTER (WHERE key = 'automobile') AS auto_flag FROM lx GROUP BY 1)
SELECT doc_id, upper(substr(recommendation, 1, 1)) || substr(recommendation, 2) AS recommended_action,
  CASE WHEN passed THEN ' ' WHEN parsing_error THEN 'PDF extraction errors occurred. ' || CASE WHEN invalid_holder THEN 'Invalid Holder info detected. ' ELSE '' END ELSE reasons END AS rejection_reasons,
  COALESCE(strftime(low, '%Y-%m-%d'), '') AS min_expiration, CASE WHEN expiry_mismatch THEN declared_day ELSE '' END AS different_expiration,
  COALESCE(automobile, '') AS automobile, CASE WHEN auto_flag IN ('none', 'warn') THEN auto_flag WHEN parsing_error OR COALESCE(auto_flag, 'blank') = 'blank' THEN 'none' ELSE 'fail' END AS automobile_flag,
  umb AS umbrella, workers, CASE WHEN workers_warning THEN 'warn' WHEN workers_expired OR starts_with(workers, 'No') THEN 'fail' ELSE 'none' END AS workers_flag,
  CASE WHEN holder_ok OR parsing_error THEN 'none' ELSE 'fail' END AS holder_flag,
  CASE WHEN count(*) OVER (PARTITION BY f.supplier_id) = 1 THEN '' ELSE CAST(row_number() OVER (PARTITION BY f.supplier_id ORDER BY doc_id) AS VARCHAR) END AS part
FROM f LEFT JOIN lp ON f.supplier_id = lp.supplier_id
""")
def q_report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Flat report row per document, with its place among the supplier's documents."""
    # A document keeps its place through the assessment, so only ids are sorted for it.
    docs = _awaiting(spark, sf)
    placed = with_position(docs, ["supplier_id"], F.floor(F.col("doc_id") / 100000).cast("bigint"), ["doc_id"], "part", "n_parts")
    rows = P.assessment_rows(assessed(spark, sf, docs=placed), extra=["part", "n_parts"])
    return rows.select(
        "doc_id", "recommended_action", "rejection_reasons", "min_expiration", "different_expiration", "automobile", "automobile_flag",
        "umbrella", "workers", "workers_flag", "holder_flag",
        F.when(F.col("n_parts") == 1, "").otherwise(F.col("part").cast("string")).alias("part"))


@query(f"""
WITH {POLICIES_SQL}, o AS (SELECT *, CASE slot WHEN 'cgl' THEN 7 WHEN 'ul' THEN 7 WHEN 'al' THEN 5 ELSE 6 END AS times FROM raw)
SELECT supplier_id, COALESCE(min_by(base * 7, ord) FILTER (WHERE slot = 'cgl'), 0) AS general, COALESCE(min_by(base * 20, ord) FILTER (WHERE slot = 'cgl'), 0) AS aggregate,
  COALESCE(min_by(base * 5, ord) FILTER (WHERE slot = 'al'), 0) AS auto, COALESCE(min_by(base * 7, ord) FILTER (WHERE slot = 'ul'), 0) AS umbrella,
  COALESCE(min_by(base * 6, ord) FILTER (WHERE slot = 'wcel'), 0) AS employer, bool_or(slot = 'wc') AS worker FROM o GROUP BY 1
""")
def q_template_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Template answers from the first policy of each type, one answer array per supplier."""
    first = V.first_policy_answers(policies(spark, sf), ["supplier_id"])
    names = ["general", "aggregate", "auto", "product", "umbrella", "employer", "worker"]
    filled = first.withColumn("answers", V.template_answers({n: F.col(n) for n in names}, {n: n for n in names}))

    def back(name: str, field: str):
        return F.filter("answers", lambda a: a["column"] == name)[0][field].alias(name)

    return filled.select("supplier_id", *[back(n, "answer_numeric") for n in ("general", "aggregate", "auto", "umbrella", "employer")],
                         back("worker", "answer_bool"))


@query("""
SELECT o_custkey AS supplier_id, max(o_orderkey) AS doc_id FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1998-06-01' GROUP BY 1
""")
def q_certificate_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Filtered certificate scan, last write per supplier; the filters reach the scan."""
    o = table(spark, sf, "orders").where((F.col("o_orderstatus") != "P") & (F.col("o_orderdate") >= F.lit(AS_OF).cast("timestamp_ntz")))
    rows = o.select(F.col("o_custkey").alias("supplier_id"), F.col("o_orderkey").alias("doc_id"))
    return latest_per_key(rows, ["supplier_id"], ["doc_id"])


LINK = "https://example.com/documents/"
HOLDER_LINE_SQL = """CASE WHEN l_quantity > 20 THEN 'Acme Foods Inc' ELSE 'Other' END || CASE WHEN l_linestatus = 'O' THEN ',200 Commerce St' ELSE '' END
  || ',Springfield,' || CASE WHEN l_returnflag = 'A' THEN 'VA' ELSE 'NC' END"""
ENTRIES_SQL = f"""
ent AS (SELECT supplier_id, doc_id, 'attachment' AS kind, attachment AS entry, status, error AS detail FROM att
  UNION ALL SELECT supplier_id, doc_id, 'error', attachment || ': ' || error, NULL, NULL FROM att WHERE error IS NOT NULL
  UNION ALL SELECT o_custkey, l_orderkey, 'certificate', l_orderkey || '-' || l_linenumber, NULL, NULL FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT o_custkey, o_orderkey, 'document', '{LINK}' || o_orderkey, NULL, NULL FROM orders
  UNION ALL SELECT o_custkey, l_orderkey, 'holder', {HOLDER_LINE_SQL}, NULL, NULL FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
CHECKS_SQL = """
chk AS (
  SELECT doc_id, 1 AS place, 'extraction.parsing' AS key, 'Attachment parsing' AS label, CASE WHEN parsing_error THEN 'fail' ELSE 'pass' END AS status,
    NULL AS expected, NULL AS actual, CASE WHEN parsing_error THEN 'One or more attachment extraction errors occurred.' END AS message FROM f
  UNION ALL SELECT doc_id, 2, 'expiration.minimum', 'Minimum policy expiration date', CASE WHEN low IS NULL THEN 'unknown' WHEN expiry_ok THEN 'pass' ELSE 'fail' END,
    NULL, strftime(low, '%Y-%m-%d'), CASE WHEN low IS NOT NULL AND NOT expiry_ok THEN 'One or more policies are expired.' END FROM f
  UNION ALL SELECT doc_id, 3, 'expiration.declared', 'Declared expiration does not exceed policy expiration', CASE WHEN expiry_mismatch THEN 'fail' ELSE 'pass' END,
    'Match attachment contents', declared_day, CASE WHEN expiry_mismatch THEN 'Declared expiration is later than the earliest extracted policy expiration.' END FROM f
  UNION ALL SELECT doc_id, 3 + k.place, 'coverage.' || k.key, k.name, CASE WHEN COALESCE(lx.warning, false) THEN 'warn' WHEN COALESCE(lx.passed, false) THEN 'pass' ELSE 'fail' END,
    CAST(k.minimum AS VARCHAR), COALESCE(lx.shown, ''), CASE WHEN NOT COALESCE(lx.passed, false) THEN COALESCE(lx.reason, 'No unexpired ' || k.name || ' policies found') END
    FROM f CROSS JOIN (SELECT *, CASE key WHEN 'general_occurrence' THEN 1 WHEN 'general_aggregate' THEN 2 WHEN 'automobile' THEN 3 ELSE 4 END AS place FROM lim) k
    LEFT JOIN lx ON f.supplier_id = lx.supplier_id AND k.key = lx.key
  UNION ALL SELECT doc_id, 8, 'workers.per-statute', 'Workers compensation per statute', CASE WHEN workers_warning THEN 'warn' WHEN starts_with(workers, 'Yes') THEN 'pass' ELSE 'fail' END,
    'Yes', workers, NULL FROM f
  UNION ALL SELECT doc_id, 9, 'holder.address', 'Certificate holder address', CASE WHEN holder_ok THEN 'pass' ELSE 'fail' END, NULL,
    COALESCE((SELECT string_agg(entry, chr(10) ORDER BY entry) FROM ent WHERE kind = 'holder' AND ent.doc_id = f.doc_id), ''),
    CASE WHEN NOT holder_ok THEN 'Holder info does not meet requirements.' END FROM f)
"""


def _first_sql(key: str, kind: str, name: str, text: str = "entry", shown: int = C.SHOWN) -> str:
    """A table of the first entries of a kind as lines, and of how many there are."""
    return f"""{name} AS (SELECT {key}, string_agg({text}, chr(10) ORDER BY place) FILTER (WHERE place <= {shown}) AS lines, count(*) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY doc_id, entry, status, detail) AS place FROM ent WHERE kind = '{kind}') GROUP BY 1)"""


def case_entries(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf).select("supplier_id", "doc_id")
    owned = _certificates(spark, sf).join(docs, "doc_id")
    lines = P.holder_lines(_certificates(spark, sf), "doc_id").join(docs, "doc_id")
    return C.case_entries(P.attachment_outcomes(_attachments(spark, sf)), owned, docs, lines, F.concat(F.lit(LINK), F.col("doc_id")))


@query(f"WITH {ATTACH_SQL}, {ENTRIES_SQL} SELECT * FROM ent")
def q_case_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Attachments, errors, certificates, documents and holders behind the review cases, one row each."""
    return case_entries(spark, sf)


@query(f"""{ASSESS_SQL}, {ENTRIES_SQL}, {CHECKS_SQL},
{_first_sql('supplier_id', 'attachment', 'fa', "entry || '|' || status || '|' || COALESCE(detail, '')")}, {_first_sql('supplier_id', 'error', 'fe')},
{_first_sql('supplier_id', 'certificate', 'fc')}, {_first_sql('supplier_id', 'document', 'fd')},
cl AS (SELECT doc_id, string_agg(concat_ws('|', key, label, status, COALESCE(expected, '-'), COALESCE(actual, '-'), COALESCE(message, '-')), chr(10) ORDER BY place) AS checks FROM chk GROUP BY 1)
SELECT f.doc_id AS id, f.supplier_id, recommendation, passed, COALESCE(reasons, '') AS reasons, checks, COALESCE(fa.lines, '') AS attachments, COALESCE(fe.lines, '') AS errors,
  COALESCE(fc.lines, '') AS certificates, COALESCE(fd.lines, '') AS documents,
  COALESCE(fa.n, 0) AS n_attachments, COALESCE(fe.n, 0) AS n_errors, COALESCE(fc.n, 0) AS n_certificates, COALESCE(fd.n, 0) AS n_documents
FROM f JOIN cl ON f.doc_id = cl.doc_id LEFT JOIN fa ON f.supplier_id = fa.supplier_id LEFT JOIN fe ON f.supplier_id = fe.supplier_id
LEFT JOIN fc ON f.supplier_id = fc.supplier_id LEFT JOIN fd ON f.supplier_id = fd.supplier_id
""")
def q_review_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Nested review case of each awaiting document, its lists as lines of text."""
    entries = case_entries(spark, sf)
    docs = C.with_lists(_awaiting(spark, sf), entries, "doc_id", ["holder"])
    cases = C.review_cases(assessed(spark, sf, docs=docs), entries)
    lines = lambda c, line: F.array_join(F.transform(c, line), "\n")
    dash = lambda c: F.coalesce(c, F.lit("-"))
    return cases.select(
        "id", "supplier.supplier_id", "assessment.recommendation", "assessment.passed", F.array_join("assessment.reasons", "\n").alias("reasons"),
        lines("assessment.checks", lambda c: F.concat_ws("|", c["key"], c["label"], c["status"], dash(c["expected"]), dash(c["actual"]), dash(c["message"]))).alias("checks"),
        lines("attachments", lambda a: F.concat_ws("|", a["key"], a["status"], F.coalesce(a["error"], F.lit("")))).alias("attachments"),
        F.array_join("extraction.parsing_errors", "\n").alias("errors"), F.array_join("extraction.certificates", "\n").alias("certificates"),
        F.array_join("extraction.documents", "\n").alias("documents"),
        "extraction.n_attachments", "extraction.n_errors", "extraction.n_certificates", "extraction.n_documents")


@query(f"""{ASSESS_SQL}, {ENTRIES_SQL}, {_first_sql('doc_id', 'attachment', 'fa', "entry || ': ' || status")}, {_first_sql('doc_id', 'holder', 'fh')}, {_first_sql('supplier_id', 'document', 'fd')},
flag AS (SELECT supplier_id, key, shown, CASE WHEN passed THEN 'none' WHEN warning THEN 'warn' WHEN shown = '' THEN 'blank' ELSE 'fail' END AS flag FROM lx)
SELECT f.doc_id, 'Supplier ' || f.supplier_id AS trading_partner, '{LINK}' || f.doc_id AS document_link, '' AS action_selection, '' AS custom_message,
  COALESCE(fh.lines, '') AS holder_names, COALESCE(fa.lines, '') AS attachment_details, COALESCE(fa.n, 0) AS n_attachments, COALESCE(fd.lines, '') AS documents_considered, COALESCE(fd.n, 0) AS n_documents,
  """ + ", ".join(f"""COALESCE({k}.shown, '') AS {k}, CASE WHEN {k}.flag IN ('none', 'warn') THEN {k}.flag WHEN parsing_error OR COALESCE({k}.flag, 'blank') = 'blank' THEN 'none' ELSE 'fail' END AS {k}_flag"""
                  for k in ("general_occurrence", "general_aggregate", "automobile", "employers")) + """
FROM f LEFT JOIN fa ON f.doc_id = fa.doc_id LEFT JOIN fh ON f.doc_id = fh.doc_id LEFT JOIN fd ON f.supplier_id = fd.supplier_id
""" + " ".join(f"LEFT JOIN flag {k} ON f.supplier_id = {k}.supplier_id AND {k}.key = '{k}'" for k in ("general_occurrence", "general_aggregate", "automobile", "employers")))
def q_full_report(spark: SparkSession, sf: str) -> DataFrame:
    """Report row of each awaiting document with its four limits, holders, attachments and the documents considered."""
    entries = case_entries(spark, sf)
    docs = C.with_lists(_awaiting(spark, sf), entries, "doc_id", ["holder", "attachment"])
    report = C.full_report(assessed(spark, sf, docs=docs), entries, F.concat(F.lit("Supplier "), F.col("supplier_id")),
                           F.concat(F.lit(LINK), F.col("doc_id")))
    limits = [c for x in P.LIMITS for c in (x.key, f"{x.key}_flag")]
    return report.select("doc_id", "trading_partner", "document_link", "action_selection", "custom_message", "holder_names", "attachment_details",
                         "n_attachments", "documents_considered", "n_documents", *limits)
