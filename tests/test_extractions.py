import json

from provender.operators import extractions as X

SCHEMA = "doc_id string, attachments array<struct<fileName:string,S3Name:string>>, run string"
FILES = [("a.pdf", "s1"), (None, "s2"), (None, None)]


def statuses(spark, run, files=FILES):
    text = run if run is None or isinstance(run, str) else json.dumps(run)
    rows = X.attachment_statuses(spark.createDataFrame([("d", files, text)], SCHEMA)).collect()
    return [(r.attachment, r.file_name, r.stored_name, r.status, r.error, r.extracted) for r in rows]


def test_no_run_and_failed_runs(spark):
    idle = lambda error: [("a.pdf", "a.pdf", "s1", "not-run", error, []), ("s2", None, "s2", "not-run", error, []),
                          ("attachment-3", None, None, "not-run", error, [])]
    assert statuses(spark, None) == idle(None) == statuses(spark, "no json") == statuses(spark, "[1]")
    assert statuses(spark, {"msg": "m", "serialized": {"message": "z"}}) == idle("m")
    assert statuses(spark, {"serialized": {"message": "z"}}) == idle("z")
    assert statuses(spark, None, None) == [] == statuses(spark, None, [])


def test_attachments_of_a_run(spark):
    cause = {"serialized": {"message": "outer", "cause": {"message": "middle", "cause": {"information": "Holder is missing"}}}}
    run = {"a.pdf": {"results": {"k": {"_id": "c1", "deep": {"_id": "no"}}, "l": {"name": "x"}, "m": {"_id": "c2"}}},
           "s2": {"results": cause}, "other": {"results": {"serialized": {"message": "plain"}}},
           "e": {"msg": "gone", "serialized": {"message": "x"}}, "f": {"serialized": {"message": "only"}}, "g": {"results": {}}}
    assert statuses(spark, run) == [
        ("a.pdf", "a.pdf", "s1", "success", None, ["c1", "c2"]), ("s2", None, "s2", "failed", "Holder is missing", []),
        ("other", None, None, "failed", "plain", []), ("e", None, None, "failed", "gone", []),
        ("f", None, None, "failed", "only", []), ("g", None, None, "success", None, [])]
    docs = spark.createDataFrame([("d", FILES, json.dumps(run)), ("n", None, None), ("x", [], '{"serialized":{}}')], SCHEMA)
    found = X.valid_extractions(docs).collect()
    assert [(r.doc_id, r.attachment, r.certificate_id) for r in found] == [("d", "a.pdf", "c1"), ("d", "a.pdf", "c2")]
    assert json.loads(found[0].certificate) == {"_id": "c1", "deep": {"_id": "no"}}


def test_documents_are_read_once(spark):
    plan = X.attachment_statuses(spark.createDataFrame([("d", FILES, None)], SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
