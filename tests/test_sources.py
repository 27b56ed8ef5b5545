import json

import pytest
from pyspark.sql import functions as F

from provender.operators.headers import lineage, mapping_table, mapping_usage, unfed_columns, unmapped_headers
from provender.registry import CREATED_AT, LONG_NAME, Registry, approved_overrides
from provender.session import constant_table, scratch_dir, written
from provender.sources import feeds, incidents, sinks, versioned

CORE = Registry.core()


def land(path, name, text):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text, encoding="utf-8")


def landed(tmp_path):
    land(tmp_path / "in", "w1.csv", 'Id,Incident ID,Created At,My Location Name,GTIN,GTIN,Description\n'
         '1,22,2026-01-02,"Town, DC",,="007","two\nlines"\n2,23,Jan 5 2026,,5,6,n/a\n')
    land(tmp_path / "in", "w2.csv", 'Id,Incident ID,Created At,location (My Location Name/Location Name),Observation\n3,24,1/9/2026,Port,seen\n')
    land(tmp_path / "in", "w3.csv", 'Id,Incident ID,Created At,location (My Location Name/Location Name),Observation\n4,25,1/9/2026,Bay,\n')
    return str(tmp_path / "in")


def test_header_sets_group_files(spark, tmp_path):
    groups = incidents.header_sets(spark, landed(tmp_path))
    assert sorted(len(paths) for _, paths in groups) == [1, 2]


def test_windows_with_differing_headers(spark, tmp_path):
    rows = {r["Id"]: r for r in incidents.read_incidents(spark, landed(tmp_path), CORE).collect()}
    assert set(rows) == {"1", "2", "3", "4"}
    assert rows["1"][LONG_NAME] == "Town, DC" and rows["1"]["GTIN"] == "007" and rows["1"]["Description"] == "two\nlines"
    assert rows["2"]["Description"] is None and str(rows["2"][CREATED_AT]) == "2026-01-05"
    assert rows["3"][LONG_NAME] == "Port"


def test_upsert_into_a_stored_table(spark, tmp_path):
    source = incidents.read_incidents(spark, landed(tmp_path), CORE).withColumn("_seq", F.lit(1))
    first = sinks.upsert_table(spark, source, str(tmp_path / "table"), CORE, "Id", ["_seq"])
    assert first.count() == 4
    land(tmp_path / "next", "w.csv", "Id,Incident ID,Created At,Description\n1,22,2026-01-02,\n5,30,2026-02-01,new\n")
    again = incidents.read_incidents(spark, str(tmp_path / "next"), CORE).withColumn("_seq", F.lit(1))
    out = {r["Id"]: r for r in sinks.upsert_table(spark, again, str(tmp_path / "table"), CORE, "Id", ["_seq"]).collect()}
    assert len(out) == 5 and out["1"]["Description"] == "two\nlines" and out["1"][LONG_NAME] == "Town, DC"
    assert out["5"]["Reported By"] == ""


def test_upsert_that_dies_before_the_switch(spark, tmp_path, monkeypatch):
    source = incidents.read_incidents(spark, landed(tmp_path), CORE).withColumn("_seq", F.lit(1))
    table = str(tmp_path / "table")
    sinks.upsert_table(spark, source.where("Id = '1'"), table, CORE, "Id", ["_seq"])
    with monkeypatch.context() as broken, pytest.raises(KeyboardInterrupt):
        broken.setattr(versioned, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        sinks.upsert_table(spark, source, table, CORE, "Id", ["_seq"])
    assert [r["Id"] for r in versioned.read_table(spark, table).collect()] == ["1"]
    assert sinks.upsert_table(spark, source, table, CORE, "Id", ["_seq"]).count() == 4


def test_corpus_reports(spark, tmp_path):
    registry = CORE.extended([("Incident Details", "VARCHAR(max)", True)])
    counts, headers = incidents.corpus_counts(spark, landed(tmp_path))
    pairs = constant_table(spark, lineage(headers, registry), ["header", "target"])
    usage = mapping_usage(counts, pairs)
    table = {r.header: r for r in mapping_table(usage).collect()}
    assert (table["Observation"].targets, table["Observation"].n_rows, table["Observation"].n_filled) == ("", 2, 1)
    assert " | " in table["My Location Name"].targets
    assert {r.header for r in unmapped_headers(usage).collect()} == {"Observation"}
    wanted = constant_table(spark, [(s.name, s.kind, not s.nullable) for s in registry.active()], ["target", "kind", "required"])
    assert {"Reported By", "Incident Details"} <= {r.target for r in unfed_columns(usage, wanted).collect()}


def test_whitelist_and_overrides(spark, tmp_path):
    land(tmp_path / "cfg", "wl.csv", "Id, Description ,Other\n1,2,3\n")
    header = incidents.whitelist_header(spark, str(tmp_path / "cfg" / "wl.csv"))
    limited = CORE.restricted(header)
    assert limited.active_names() == ["Description", "Id"]
    assert incidents.whitelist_header(spark, str(tmp_path / "none.csv")) is None
    land(tmp_path / "cfg2", "map.csv", "From,To,Decision\nA, Description ,Approved\nB,Description,no\nC,Unknown,yes\n,Id,1\n")
    assert approved_overrides(spark, str(tmp_path / "cfg2" / "map.csv"), limited) == [("A", "Description")]
    assert approved_overrides(spark, str(tmp_path / "nope.csv"), limited) == []


def test_registry_from_file_and_table(spark, tmp_path):
    land(tmp_path / "r", "r.csv", 'name,type,nullable\nId,VARCHAR(100),false\n"Cost, $","DECIMAL(38, 2)",true\n')
    r = Registry.from_file(str(tmp_path / "r" / "r.csv"))
    assert [(s.name, s.nullable) for s in r.active()] == [("Cost, $", True), ("Id", False)]
    t = Registry.from_table(spark.sql("SELECT 'x' AS Id, true AS B, date'2026-01-01' AS D, CAST(1 AS DECIMAL(38,2)) AS N"))
    assert {s.name: s.kind for s in t.active()} == {"Id": "VARCHAR(max)", "B": "BIT", "D": "DATE", "N": "DECIMAL(38, 2)"}


def test_snapshot(spark, tmp_path):
    land(tmp_path / "s", "s.csv", 'Incident ID,A\n 1 ,null\n2,\n,x\n3, v \n')
    got = {r["Incident ID"]: r.A for r in incidents.read_snapshot(spark, str(tmp_path / "s"), "Incident ID", ["A"]).collect()}
    assert got == {"1": None, "2": "", "3": "v"}


def document(i, status="Awaiting Approval", business="b1", expires="2027-01-01T00:00:00Z"):
    return {"_id": i, "name": "n", "expirationDate": expires, "isArchived": False,
            "attachments": [{"fileName": "a/"}, {"fileName": "x.pdf", "S3Name": "s"}],
            "shareSource": {"approvalInfo": {"status": status}, "type": {"_id": "t", "name": "Certificate of Insurance"},
                            "sourceBusiness": {"_id": business} if business else None}, "versionInfo": {"updatedAt": "2026-01-05T00:00:00Z"}}


def test_pages(spark, tmp_path):
    page = lambda items, nxt: json.dumps({"pageItems": items, "pageItemCount": len(items), "totalItemCount": 3, "hasNextPage": nxt, "nextPageIndex": 1})
    land(tmp_path / "p", "0.json", page([document("1"), document("2", "Approved")], True))
    land(tmp_path / "p", "1.json", page([document("3", business=None)], False))
    items = feeds.read_pages(spark, str(tmp_path / "p"), "documents")
    assert items.count() == 3
    inside = feeds.in_window(items, "documents", F.lit("2026-01-05").cast("timestamp"), F.lit("2026-02-01").cast("timestamp"))
    assert inside.count() == 0  # the window is open at its start
    filed, rejected = feeds.mirror_rows(feeds.read_items(spark, str(tmp_path / "p"), "documents"), "documents")
    assert filed.count() == 2 and [r.reason for r in rejected.collect()] == ["nothing to file it under"]
    assert {r._id for r in feeds.parse_items(feeds.read_items(spark, str(tmp_path / "p"), "documents"), "documents").collect()} == {"1", "2", "3"}
    certs = feeds.certificates(items, "t", "Awaiting Approval", F.lit("2026-01-01").cast("timestamp"), "expirationDate", archived=False)
    assert sorted(r._id for r in certs.collect()) == ["1", "3"]
    got = feeds.attachments(items).where("doc_id = '1'").collect()
    assert [(r.seq, r.file_name) for r in got] == [(2, "x.pdf")]
    rest = feeds.unprocessed(items.select("_id"), spark.createDataFrame([("1",)], "_id string"), "_id")
    assert rest.count() == 2


def test_mirror_sees_any_field(spark):
    def versions(feed, *items):
        df = spark.createDataFrame([(json.dumps(i) if not isinstance(i, str) else i,) for i in items], "item string")
        filed, rejected = feeds.mirror_rows(df, feed)
        return {r.item_id: (r.business_id, r.version) for r in filed.collect()}, [r.reason for r in rejected.collect()]

    plain, changed = document("1"), document("1") | {"auditAttributes": {"auditor": "Ann"}}
    assert versions("documents", plain)[0] != versions("documents", changed)[0]
    assert versions("documents", plain)[0] == versions("documents", dict(reversed(plain.items())))[0]
    incident = {"_id": "9", "incidentType": {"_id": "kind"}, "links": [{"href": "x"}]}
    assert versions("incidents", incident)[0]["9"][0] == "kind"
    assert versions("incident_types", {"_id": "kind", "name": "n"})[0]["kind"][0] == "kind"
    assert sorted(versions("documents", "{broken", {"x": 1})[1]) == ["no id", "not JSON"]


def test_incident_types_envelope(spark, tmp_path):
    land(tmp_path / "t", "0.json", json.dumps({"items": [{"_id": "1", "name": "n", "statuses": []}], "has_more": False}))
    assert feeds.read_pages(spark, str(tmp_path / "t"), "incident_types").first().name == "n"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1, "2026-01-02 10:00:00")], "v string, n int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    sinks.write_csv(df.drop("ts"), str(tmp_path / "c"), strip_commas=True)
    assert spark.read.csv(str(tmp_path / "c"), header=True).first().v == "ab"
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 1
    sinks.day_partition(df, "ts", str(tmp_path / "d"))
    assert sinks.read_days(spark, str(tmp_path / "d"), "2026-01-01", "2026-01-07").count() == 1
    assert sinks.read_days(spark, str(tmp_path / "d"), "2026-01-03", "2026-01-07").count() == 0
    sinks.append_jobs(df, str(tmp_path / "jobs"))
    sinks.append_jobs(df, str(tmp_path / "jobs"))
    assert spark.read.parquet(str(tmp_path / "jobs")).count() == 2
    sinks.append_mirror(df.withColumn("type", F.lit("documents")), str(tmp_path / "m"))
    assert "documents" in [r.type for r in spark.read.parquet(str(tmp_path / "m")).collect()]


def test_table_names():
    assert sinks.table_name(None) == ("dbo", "incidents") == sinks.table_name(" null ")
    assert sinks.table_name("[a].[b]") == ("a", "b") and sinks.table_name("[t]") == ("dbo", "t") and sinks.table_name("s.t") == ("s", "t")


def test_scratch_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(base)
    assert written(spark.range(5), "five").count() == 5
    rows = [("it's", 1, True, None), ("back\\slash", 0, False, "x")]
    assert [tuple(r) for r in constant_table(spark, rows, ["a", "b", "c", "d"]).collect()] == rows


def test_header_sets_are_found_by_spark(spark, tmp_path):
    odd = tmp_path / "odd names"
    land(odd, "a b%20c.csv", "﻿Id,Name\n1,x\n")
    land(odd, "b.csv", 'Id,"A name\nof two lines, or ""three"""\n1,x\n')
    land(odd, "c.csv", 'Id,"A name\r\nof two lines, or ""three"""\r\n2,y\r\n')
    land(odd, "d.csv", "Id,Name\r\n3,z\r\n")
    land(odd, "e.csv", "")
    found = incidents.header_sets(spark, str(odd))
    assert [h for h, _ in found] == [["Id", 'A name\nof two lines, or "three"'], ["Id", "Name"]]
    assert [[p.split("/")[-1] for p in files] for _, files in found] == [["b.csv", "c.csv"], ["a b%20c.csv", "d.csv"]]
    rows = [r["Id"] for h, files in found for r in incidents.read_window_files(spark, files, h).collect()]
    assert sorted(rows) == ["1", "1", "2", "3"]
    assert incidents.header_sets(spark, str(odd / "e.csv")) == []


def test_exact_renames_reach_the_reader(spark, tmp_path):
    land(tmp_path / "in", "w.csv", "Id,Incident ID,Created At,What did you see there?\n1,22,2026-01-02,a crack\n")
    plain = incidents.read_incidents(spark, str(tmp_path / "in"), CORE).first()
    named = incidents.read_incidents(spark, str(tmp_path / "in"), CORE, renames=[("What did you see there?", "Description")]).first()
    assert (plain["Description"], named["Description"]) == (None, "a crack")


def test_a_day_that_runs_again_is_replaced(spark, tmp_path):
    folder = str(tmp_path / "days")
    day = lambda rows: sinks.day_partition(spark.createDataFrame(rows, "k int, ts string"), "ts", folder)
    day([(1, "2026-01-01"), (2, "2026-01-02")])
    day([(3, "2026-01-02")])
    read = sinks.read_days(spark, folder, "2026-01-02", "2026-01-02")
    assert [r.k for r in read.collect()] == [3] and spark.read.parquet(folder).count() == 2
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan  # other days are not opened


def test_ordered_files(spark, tmp_path):
    import random

    names = [f"n{i:05d}" for i in range(4000)]
    random.Random(3).shuffle(names)
    df = spark.createDataFrame([(n, i % 7) for i, n in enumerate(names)], "name string, v int").repartition(5)
    sinks.write_csv(df, str(tmp_path / "out"), order=["name"])
    read = []
    for file in sorted((tmp_path / "out").glob("part-*")):
        read += [line.split(",")[0] for line in file.read_text().splitlines()[1:]]
    assert read == sorted(names)


def test_many_pages_in_a_file(spark, tmp_path):
    land(tmp_path / "p", "pages.json", '{"pageItems":[{"_id":"a"}],"hasNextPage":true}\n{"pageItems":[{"_id":"b"},{"_id":"c"}]}\n')
    items = feeds.read_items(spark, str(tmp_path / "p"), "memberships", page_per_line=True)
    assert sorted(json.loads(r.item)["_id"] for r in items.collect()) == ["a", "b", "c"]
