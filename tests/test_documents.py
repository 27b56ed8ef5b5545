import itertools

import pytest
from pyspark.sql import functions as F

from provender.operators import documents as D
from provender.operators import reports as R


def route(one, **over):
    base = dict(deleted=False, type_name=D.CERTIFICATE, status="Awaiting Approval", supported=True, has_draft=False,
                has_partner=True, set_by_us=False, open_jobs=0)
    return one(D.triage(**{k: F.lit(v) for k, v in (base | over).items()}))


@pytest.mark.parametrize("over, expected", [
    ({"deleted": True}, "skip-deleted"),
    ({"type_name": None}, "ignore-no-type"),
    ({"supported": False}, "ignore-unsupported"),
    ({"supported": False, "status": "Approved"}, "queue-no-rejection"),
    ({"has_draft": True}, "queue"),
    ({"has_draft": True, "status": "Rejected"}, "reset-draft"),
    ({"has_partner": False}, "diagnostic"),
    ({}, "queue"),
    ({"set_by_us": True}, "queue"),
    ({"set_by_us": True, "status": "Approved"}, "reprocess"),
    ({"set_by_us": True, "status": "Approved", "open_jobs": 2}, "finish"),
    ({"set_by_us": True, "status": "Rejected"}, "none"),
    ({"status": "Approved"}, "queue-no-rejection"),
    ({"status": "Rejected"}, "cancel"),
    ({"status": None}, "cancel"),
])
def test_triage_order(one, over, expected):
    assert route(one, **over) == expected


@pytest.mark.parametrize("text, expected", [
    ("This is a Multi-page pdf file", "target-multiple-docs-combined"), ("Valiadation failed: x", "target-validation"),
    ("file format was not recognized", "target-unrecognized"), ("File is not a textual PDF", "target-unrecognized"),
    ("sorry, file is not a textual pdf", "target-other"), (None, "target-other"),
    ("validation failed, file format was not recognized", "target-unrecognized")])
def test_error_classes(one, text, expected):
    assert one(D.classify_error(F.col("m")), m=text) == expected


def test_type_lookup_both_ways(spark):
    types = D.type_table(spark)
    assert types.count() == 51 and types.select("slug").distinct().count() == 51
    df = spark.createDataFrame([("W-8",), ("Nothing",), (None,)], "t string")
    got = [r.slug for r in D.with_lookup(df, types, "t", "type_name", "slug", D.DEFAULT_SLUG).collect()]
    assert got == ["w-8s", "unidentified", "unidentified"]
    assert len(D.SUPPORTED_TYPES) == 40


def test_completion(spark):
    events = [(1, "a", "success", 1), (1, "a", "success", 2), (1, "b", "running", 3), (1, "b", "failure", 4), (2, "a", "failure", 1),
              (2, "a", "success", 2), (3, "a", "running", 1)]
    df = spark.createDataFrame(events, "job_id int, attachment string, status string, seq int")
    expected = spark.createDataFrame([(1, 2), (2, 2), (3, 1)], "job_id int, n_expected int")
    got = {r.job_id: tuple(r)[2:] for r in D.completion(df, expected).collect()}
    assert got == {1: (2, 1, "a", True), 2: (1, 1, "a", False), 3: (0, 0, None, False)}


def test_outcome_and_result(one):
    out = lambda s, a: one(D.extraction_outcome(F.lit(s), F.lit(a), F.lit("target-other")))
    assert [out("success", True), out("failure", True), out("success", False), out("failure", False), out("new", True)] == [
        "finish", "finish", "validate", "target-other", "wait"]
    r = lambda **k: one(F.struct(*[c.alias(n) for n, c in D.completion_result(**{a: F.lit(v) for a, v in k.items()}).items()]))
    base = dict(result_type="cois", result_key="k", declared_type="sds", declared_key="d", failed_result=False, allow_rejection=True)
    assert r(**base).filed_key == "k"
    assert r(**(base | {"result_key": None})).outcome == "target-invalid-result"
    assert r(**(base | {"result_key": None, "allow_rejection": False})).filed_key == "d"
    assert r(**(base | {"failed_result": True, "declared_type": None})).outcome == "other"


def test_decisions(one):
    def state(**over):
        base = dict(status=None, decision="approve", message=" ", current="Awaiting Approval", doc_id="d", draft_id=None, has_ids=True) | over
        cols = {k: F.lit(v) if not isinstance(v, type(None)) else F.lit(None).cast("string") for k, v in base.items()}
        return one(F.struct(*[c.alias(n) for n, c in D.review_decision(**cols).items()]))

    assert state().writeback == "submitted" and state().document_id == "d"
    assert state(draft_id="x").document_id == "x"
    assert state(decision="reject").error == "missing-message"
    assert state(decision="reject", message=" why ").comment == "why"
    assert state(current="Approved").writeback == "skipped" and state(current=None).writeback == "submitted"
    assert state(decision="later").error == "bad-status" and state(has_ids=False).error == "missing-id"


def test_every_funnel_way_ends_in_a_known_node(spark):
    tri = [True, False, None]
    rows = [(s, *f, j, v, a, st) for s, f, j, v, a, st in itertools.product(
        ["approved", "Rejected", "Awaiting Approval", None], [(True, False, True, True), (False, False, True, True), (True, True, True, True),
                                                             (True, False, False, True), (True, False, True, False)],
        ["success", "failure", "new"], tri, tri, ["Approved", "??"])]
    df = spark.createDataFrame(rows, "status string, retrievable boolean, meta_invalid boolean, has_pdf boolean, has_job boolean, "
                                     "job_status string, valid boolean, approval boolean, assessment_state string")
    df = df.withColumns({"meta_message": F.lit("Multiple"), "job_texts": F.array(F.lit("x"), F.lit("needs OCR"), F.lit("recognized")),
                         "has_result": F.lit(True), "valid_message": F.lit("match"), "has_assessment": F.lit(True), "by_us": F.lit(True)})
    flagged = R.funnel(df)
    known = {n for n, _ in R.FUNNEL_NODES}
    assert {r.node for r in flagged.select("node").distinct().collect()} <= known
    assert flagged.where("array_contains(nodes, 'd2') and not array_contains(nodes, 'd2a')").count() == 0
    counts = {r.node: r.n for r in R.funnel_counts(flagged).collect()}
    assert set(counts) == known and counts["a1"] + counts["a2"] + counts["a3"] + counts["a4"] == len(rows)


def test_translation(spark):
    df = spark.sql("""SELECT map('effectiveDate', '2026-01-01', 'auditDate', 'share') AS share,
      '{"auditAttributes":{"auditDate":"own"},"expirationDate":"2027-01-01"}' AS doc,
      named_struct('name', 'Acme', 'address', named_struct('addressLineOne', '1 St', 'postalCode', '2', 'city', 'C', 'region', 'R', 'country', 'U')) AS bus""")
    t = lambda kind: df.select(D.translate_document(F.col("doc"), F.col("share"), F.col("bus"), F.lit(kind)).alias("t")).first().t
    assert t("W-8").audit_date == "own" and t("W-8").document_date == "2026-01-01" and t("W-8").holder is None
    assert t(D.CERTIFICATE).holder.location.state == "R"


def test_reports(spark):
    df = spark.sql("SELECT map('a', array(named_struct('first_name','Ann','last_name','Lee','comment','hi'))) AS c")
    assert df.select(R.comments_text(F.col("c")).alias("v")).first().v == "Ann Lee: hi"
    daily = spark.sql("SELECT * FROM VALUES (1, date'2026-01-01', 'old'), (1, date'2026-01-03', 'new'), (2, date'2025-12-01', 'x') AS t(k, day, v)")
    last = F.lit("2026-01-04").cast("date")
    assert [tuple(r)[2] for r in R.rolling_union(daily, "k", "day", last, 7).collect()] == ["new"]
    assert [tuple(r)[2] for r in R.rolling_union(daily, "k", "day", last, 7, oldest_wins=True).collect()] == ["old"]
    assert spark.sql("""SELECT '{"config":{"fl-business":{"a/b":1}}}' AS job""").select(
        R.pointer(F.col("job"), "/config/fl-business/a").alias("v")).first().v is None
