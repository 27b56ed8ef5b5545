import datetime as dt

from pyspark.sql import functions as F

from provender.operators import policies as P
from provender.operators import validate as V
from provender.plans.certificates import q_report_rows

CGL, AL, UL, WCEL = P.SLOT_TYPES.values()
SCHEMA = ("supplier_id int, doc_id int, cert_id string, ord long, type string, number string, effective_date timestamp, "
          "expire_date timestamp, " + ", ".join(f"{m} string" for m in P.MONEY_FIELDS) + ", per_statute string")
LATER, GONE, BAD = dt.datetime(2027, 1, 1), dt.datetime(2020, 1, 1), dt.datetime(1900, 12, 30)


def as_of():
    return F.lit("2026-01-01").cast("timestamp")


def policy(ord, kind, number=None, expires=LATER, effective=dt.datetime(2025, 1, 1), statute=None, **money):
    return (1, 10, f"c{ord}", ord, kind, number, effective, expires, *[money.get(m) for m in P.MONEY_FIELDS], statute)


def compose(spark, *rows):
    return P.compose_policies(spark.createDataFrame(list(rows), SCHEMA), ["supplier_id"], as_of())


def test_sums_once_per_number_and_all_without(spark):
    r = compose(spark, policy(1, CGL, "A", each_occurrence="100", general_aggregate="7 dollars"),
                policy(2, CGL, "A", each_occurrence="900"), policy(3, CGL, None, each_occurrence="10"),
                policy(4, CGL, None, each_occurrence="x"), policy(5, CGL, "B", GONE, each_occurrence="5000")).first()
    assert (r.cgl_each_occurrence, r.cgl_general_aggregate, r.cgl_n) == (110, 7, 3)
    assert r.min_expire == GONE and r.n_policies == 5
    assert r.al_n == 0 and r.al_combined_single_limit is None


def test_expired_copy_does_not_use_up_the_number(spark):
    r = compose(spark, policy(1, AL, "A", GONE, combined_single_limit="1"), policy(2, AL, "A", combined_single_limit="2")).first()
    assert r.al_combined_single_limit == 2


def test_placeholder_date_is_active_and_becomes_the_minimum(spark):
    r = compose(spark, policy(1, AL, "A", BAD, combined_single_limit="5"), policy(2, AL, "B", combined_single_limit="6")).first()
    assert r.al_expire == BAD and r.al_combined_single_limit == 11 and r.min_expire == LATER


def test_per_statute_needs_all(spark):
    assert compose(spark, policy(1, WCEL, "a", statute="1"), policy(2, WCEL, "b", statute="1")).first().wcel_per_statute is True
    assert compose(spark, policy(1, WCEL, "a", statute="1"), policy(2, WCEL, "b")).first().wcel_per_statute is False
    assert compose(spark, policy(1, AL, "a")).first().wcel_per_statute is None


def limits(spark, *rows):
    got = compose(spark, *rows).withColumn("x", P.check_limits(as_of())).first().x
    return {x.key: x for x in got}


def test_limits(spark):
    x = limits(spark, policy(1, CGL, "A", each_occurrence="1500000", general_aggregate="6000000"), policy(2, UL, "U", each_occurrence="600000"))
    assert x["general_occurrence"].passed and x["general_occurrence"].effective == 2_100_000 and x["general_occurrence"].shown == "1500000"
    assert x["general_aggregate"].passed
    # The umbrella never counts on its own.
    assert not x["automobile"].passed and x["automobile"].shown == ""
    assert x["automobile"].reasons == ["No unexpired Automobile Liability policies found"]


def test_limit_reasons(spark):
    x = limits(spark, policy(1, AL, "A", combined_single_limit="5"), policy(2, WCEL, "W", BAD, el_each_accident="2000000"))
    assert x["automobile"].reasons == ["Insufficient Automobile Liability coverage. 1000000 is required. Coverage is only 5."]
    assert x["employers"].warning and not x["employers"].passed
    assert x["employers"].shown == "2000000 (Confirm Effective Dates)"
    assert x["employers"].reasons == ["Confirm Effective Dates for Worker's Compensation Employee Liability policy."]


FULL = (policy(1, CGL, "A", each_occurrence="2000000", general_aggregate="5000000"), policy(2, AL, "B", combined_single_limit="1000000"))


def assessed(spark, *rows, holder=True, parsing=None, legacy=False, declared="2026-06-01"):
    docs = spark.createDataFrame([(10, 1, declared)], "doc_id int, supplier_id int, declared_day string")
    holders = spark.createDataFrame([(10, 1, int(holder), holder)], "doc_id int, n_certificates long, n_good_holders long, holder_passed boolean")
    if parsing is not None:
        parsing = spark.createDataFrame([(1, *parsing)], "supplier_id int, parsing_error boolean, invalid_holder boolean")
    return P.assess(docs, compose(spark, *rows), holders, parsing, as_of(), legacy)


def test_approved(spark):
    r = assessed(spark, *FULL, policy(3, WCEL, "W", el_each_accident="1000000", statute="1")).first()
    assert r.passed and r.recommendation == "approve" and r.reasons == [] and r.workers == "Yes" and not r.expiry_mismatch


def test_no_statute_fails_unless_legacy(spark):
    rows = (*FULL, policy(3, WCEL, "W", el_each_accident="1000000", statute="0"))
    r = assessed(spark, *rows).first()
    assert not r.passed and r.recommendation == "reject" and r.workers == "No"
    assert r.reasons == ["Worker's Comp policy is missing per statute requirement."]
    assert assessed(spark, *rows, legacy=True).first().passed


def test_review_and_mismatch(spark):
    r = assessed(spark, *FULL, holder=False, parsing=(True, True), declared="2028-01-01").first()
    assert r.recommendation == "review" and r.expiry_mismatch
    assert r.reasons[0] == "PDF extraction errors occurred. Invalid Holder info detected."
    assert r.reasons[-1] == "Holder info does not meet requirements."


def test_repeated_reason_is_listed_once(spark):
    r = assessed(spark, policy(1, AL, "A", combined_single_limit="1000000")).first()
    assert r.reasons.count("No unexpired General Liability policies found") == 1


def test_supplier_without_policies(spark):
    docs = spark.createDataFrame([(10, 2, "2026-06-01")], "doc_id int, supplier_id int, declared_day string")
    holders = spark.createDataFrame([], "doc_id int, n_certificates long, n_good_holders long, holder_passed boolean")
    r = P.assess(docs, compose(spark, *FULL), holders, None, as_of())
    checks = {c.check: c.status for c in P.check_list(r).collect()}
    assert checks["expiration.minimum"] == "unknown" and checks["holder.address"] == "fail" and len(checks) == 9


def test_report_flags(spark):
    rows = P.assessment_rows(assessed(spark, policy(1, AL, "A", combined_single_limit="5"))).first()
    assert rows.automobile == "5" and rows.automobile_flag == "fail" and rows.general_occurrence_flag == "none"
    assert rows.recommended_action == "Reject" and rows.holder_flag == "none"


def test_holder_rule(spark):
    rule = P.HolderRule("acme", "va", "springfield", "commerce")
    rows = [(1, "a", "ACME Foods", "VA", "Springfield", "200 Commerce St"), (1, "b", "Acme", "NC", "Springfield", "Commerce"), (2, "c", None, "VA", "Springfield", "Commerce")]
    df = spark.createDataFrame(rows, "doc_id int, cert_id string, holder_name string, holder_state string, holder_city string, holder_street string")
    assert {r.doc_id: r.holder_passed for r in P.check_holders(df, "doc_id", rule).collect()} == {1: True, 2: False}


def test_attachment_keys_and_errors(spark):
    rows = [(1, 10, 1, "f", "s", True, None, None), (1, 10, 2, None, "s2", True, "no Holder", None), (1, 11, 3, None, None, False, None, None)]
    df = spark.createDataFrame(rows, "supplier_id int, doc_id int, seq int, file_name string, stored_name string, ran boolean, result_error string, run_error string")
    out = P.attachment_outcomes(df)
    assert [(r.attachment, r.status) for r in out.collect()] == [("f", "success"), ("s2", "failed"), ("attachment-3", "not-run")]
    r = P.parsing_errors(out).first()
    assert r.parsing_error and r.invalid_holder


def test_expiry_verdict(one):
    now = F.lit("2026-01-01").cast("timestamp")

    def verdict(kind, declared, lowest):
        v = V.expiry_verdict(F.lit(kind), F.lit(declared).cast("date"), F.lit(lowest).cast("date"), now)
        return one(F.struct(v["valid"], v["message"]))

    kind = V.VALIDATED_TYPES[1]
    assert tuple(verdict(kind, "2027-01-01", "2027-01-01")) == (True, "")
    assert "does not match" in verdict(kind, "2028-01-01", "2027-01-01")[1]
    assert "already expired" in verdict(kind, "2028-01-01", "2025-01-01")[1]
    assert "unsupported" in verdict("W-8", "2027-01-01", "2027-01-01")[1]
    assert "Could not extract" in verdict(kind, "2027-01-01", None)[1]


def template(spark, columns, answers):
    schema = ("assessment_id int, sections array<struct<subsections:array<struct<questions:array<struct<"
              "columns:array<struct<id:string,name:string,type:string,acceptance_type:string,percent:int,required_numeric:bigint,required_bool:boolean,average:bigint>>,"
              "answers:array<struct<column:string,answer_numeric:bigint,answer_bool:boolean>>>>>>>>")
    return spark.createDataFrame([(1, [([([(columns, answers)],)],)])], schema)


def test_template_leans_on_the_umbrella(spark):
    columns = [("a", "Auto", "numeric", "min", 50, 100, None, 3), ("u", V.UMBRELLA, "numeric", "none", 0, None, None, None)]
    enough = template(spark, columns, [("a", 60, None), ("u", 40, None)])
    short = template(spark, columns, [("a", 60, None), ("a", 99, None), ("u", 39, None)])
    assert tuple(V.check_template(enough, True).first())[1:] == (False, 0)
    assert tuple(V.check_template(short, True).first())[1:] == (True, 1)
    assert V.template_reasons(short, True).first().reason == (
        "The sum of Auto(60) and Umbrella Coverage(39) was 99. This does not meet the required coverage (100)")
    assert V.check_template(enough, False).first().failed is True
    assert V.template_reasons(enough, False).first().reason == "Auto(3) did not meet the requirement (100)"


def test_template_without_answers_fails(spark):
    columns = [("a", "Auto", "numeric", "min", 50, 100, None, None), ("w", "Work", "bool", "bool", 0, None, True, None)]
    got = V.check_template(template(spark, columns, [("w", None, False)]), True).first()
    assert (got.failed, got.n_failed) == (True, 2)
    assert [r.reason for r in V.template_reasons(template(spark, columns, [("w", None, False)]), True).collect()] == [
        "Work(false) did not meet the requirement (true)"]


def test_report_rows_are_assessed_once(spark, tmp_path):
    """The place among a supplier's documents is found before the assessment, not beside a second one."""
    land = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    land("orders", [(i, i % 2, "O", 1.0, dt.datetime(1998, 1, 1), "1-URGENT") for i in range(5)],
         "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    land("lineitem", [(i, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", dt.datetime(1999, 1, 1)) for i in range(5)],
         "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
         "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    rows = q_report_rows(spark, str(tmp_path))
    assert sorted((r.doc_id, r.part) for r in rows.collect()) == [(0, "1"), (1, "1"), (2, "2"), (3, "2"), (4, "3")]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 3  # policies, holders, attachments
