from provender.operators.headers import HeaderPlan, lineage, positional, union_by_header_set
from provender.operators.rows import conform, export_text, scrub_date_bleed
from provender.registry import (
    CREATED_AT, DISTRIBUTOR, INCIDENT_DATE, LONG_GLN, LONG_NAME, RECEIVER, SHORT_GLN, SHORT_NAME, UPDATED_AT, Registry,
)

CORE = Registry.core()
THREE = "distributor (Shipment Originator/Smithfield Plant/Receiver)"


def resolve(spark, row, registry=CORE, **kw):
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"`{k}` string" for k in row))
    return HeaderPlan(list(row), registry, **kw).project(df).first().asDict()


def test_flat_headers_reach_canonical_columns(spark):
    out = resolve(spark, {"Id": "1", "My Location Name": "5 - Town DC", "My Location GLN": "999",
                          "Shipment Originator": "11 - Port", "Incident Date": "Feb 04, 2026"})
    assert out[LONG_NAME] == out[SHORT_NAME] == "5 - Town DC"
    assert out[LONG_GLN] == out[SHORT_GLN] == "999"
    assert out[DISTRIBUTOR] == out[RECEIVER] == "11 - Port"
    assert out[INCIDENT_DATE] == "Feb 04, 2026"


def test_bracketed_headers_reach_canonical_columns(spark):
    out = resolve(spark, {"Id": "2", SHORT_NAME: "5 - Town DC", SHORT_GLN: "999", THREE: "11 - Port",
                          "incidentDate (Incident Date/Delivery Date/Date)": "Feb 04, 2026"})
    assert (out[LONG_NAME], out[LONG_GLN], out[DISTRIBUTOR], out[RECEIVER], out[INCIDENT_DATE]) == (
        "5 - Town DC", "999", "11 - Port", "11 - Port", "Feb 04, 2026")


def test_alias_fills_only_blank_destinations(spark):
    out = resolve(spark, {"Shipment Originator": "new", DISTRIBUTOR: "old"})
    assert out[DISTRIBUTOR] == "old"
    out = resolve(spark, {"Shipment Originator": "new", DISTRIBUTOR: "  "})
    assert out[DISTRIBUTOR] == "new"


def test_same_tokens_overwrite(spark):
    out = resolve(spark, {"product (Material GTIN/Product GTIN/Product Name GTIN)": "",
                          "product (Product GTIN/Product Name GTIN/Material GTIN)": "kept?"})
    assert out["product (Product GTIN/Product Name GTIN/Material GTIN)"] == ""


def test_closest_does_not_replace_an_empty_text(spark):
    target = "product (Product GTIN/Product Name GTIN/Material GTIN)"
    assert resolve(spark, {"product (Product GTIN/Material GTIN)": "a", target: ""})[target] == ""
    assert resolve(spark, {"product (Product GTIN/Material GTIN)": "a"})[target] == "a"


def test_closest_prefers_the_smallest_superset(spark):
    out = resolve(spark, {"sourceMembership (Supplier/Product Supplier/Supplier Name)": "s"})
    assert out["sourceMembership (Manufacturer of Product or Distributor Name/Supplier/Product Supplier/Supplier Name)"] == "s"
    assert out["sourceMembership (Supplier/Product Supplier)"] is None


def test_unknown_base_is_left_alone(spark):
    assert lineage(["plant (Internal Supplier/Plant)"], CORE) == []


def test_short_location_is_spent_by_the_alias_step(spark):
    """The short header moves into the long one, which then fills it again."""
    out = resolve(spark, {SHORT_NAME: "short", LONG_NAME: "long", SHORT_GLN: "1", LONG_GLN: "2"})
    assert (out[LONG_NAME], out[SHORT_NAME], out[LONG_GLN], out[SHORT_GLN]) == ("long", "long", "2", "2")


def test_later_short_location_overwrites_the_long_one(spark):
    out = resolve(spark, {"location (Location Name/My Location Name)": "short", LONG_NAME: "long"})
    assert (out[LONG_NAME], out[SHORT_NAME]) == ("short", "short")


def test_credit_note_rules(spark):
    target = "Credit note to supplier"
    assert resolve(spark, {"CREDIT NOTE": "c"})[target] == "c"
    assert resolve(spark, {"Credit Note": "c", target: "mine"})[target] == "mine"
    assert resolve(spark, {"Credit Note": "c", target: "mine"}, legacy_credit_note=True)[target] == "c"
    assert resolve(spark, {"Credit Note": "c", target: "mine", "DC Pick Label": ""}, legacy_credit_note=True)[target] == "mine"


def test_overrides_respect_kept_sources_and_values(spark):
    out = resolve(spark, {"Old": "v", "Description": None}, overrides=[("Old", "Description")])
    assert out["Description"] == "v"
    out = resolve(spark, {"Old": "", "Description": None}, overrides=[("Old", "Description")])
    assert out["Description"] is None
    out = resolve(spark, {"Affected Quantity": "3"}, overrides=[("Affected Quantity", "Description")])
    assert out["Affected Quantity"] == "3" and out["Description"] == "3"


def test_remarked_question(spark):
    question = "Did you email your account rep for recovery options?"
    remarked = question + " (Be sure to include your id in your email)"
    registry = CORE.extended([(question, "VARCHAR(max)", True)])
    assert resolve(spark, {remarked: "yes"}, registry, renames=[(remarked, question)])[question] == "yes"
    assert resolve(spark, {remarked: "yes"}, registry)[question] is None


def test_case_only_duplicates_keep_the_first():
    r = Registry.of([("A?", "BIT", True), ("a?", "BIT", True), ("B", "BIT", True)])
    assert r.active_names() == ["A?", "B"]


def test_whitelist_limits_targets(spark):
    only = CORE.restricted(["Id", SHORT_NAME])
    out = resolve(spark, {"Id": "1", "My Location Name": "x"}, only)
    assert out == {"Id": "1", SHORT_NAME: "x"}
    assert CORE.restricted(None).active_names() == CORE.active_names()


def positional_rows(spark, headers, *rows):
    schema = ", ".join(f"c{i} string" for i in range(len(headers)))
    return [r.asDict() for r in positional(spark.createDataFrame(list(rows), schema), headers).collect()]


def test_duplicate_headers(spark):
    headers = ["Id", "GTIN", " Note ", "", "GTIN", "Note"]
    rows = positional_rows(spark, headers, ("1", "", "", "x", '="007"', "b"), ("2", "5", "a", "x", "6", "b"), ("3", "", "", "x", "", ""))
    assert rows == [{"Id": "1", "GTIN": "007", "Note": "b"}, {"Id": "2", "GTIN": "5", "Note": "a"}, {"Id": "3", "GTIN": None, "Note": ""}]


def test_wide_files_resolve_like_narrow_ones(spark):
    headers = ["Id"] + [f"h{i}" for i in range(150)] + ["GTIN", "GTIN"]
    row = ("'1",) + tuple(f' ="{i}" ' for i in range(150)) + ("", "9")
    got = positional_rows(spark, headers, row)[0]
    assert got["Id"] == "1" and got["h149"] == "149" and got["GTIN"] == "9"


def test_hostile_names_survive(spark):
    headers = ["Id", "a.b", "c`d", "e $/(f)#", "Still have the Product?"]
    rows = positional_rows(spark, headers, ("1", "2", "3", "4", "yes"))
    assert rows[0]["a.b"] == "2" and rows[0]["c`d"] == "3"


def test_files_with_differing_headers(spark):
    a = spark.createDataFrame([("1", "x")], "`Id` string, `Description` string")
    b = spark.createDataFrame([("2", "y")], "`Id` string, `Location Name` string")
    out = {r.Id: r for r in union_by_header_set([(a.columns, a), (b.columns, b)], CORE).collect()}
    assert out["1"]["Description"] == "x" and out["2"][LONG_NAME] == "y" and out["2"]["Description"] is None


def test_bleed_and_not_null(spark):
    row = {"Id": "1", CREATED_AT: "2026-01-02", "Description": "January 2, 2026", "Supplier Location": "Jan 3, 2026",
           "Best By Date": "2026-05-05"}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"`{k}` string" for k in row))
    assert scrub_date_bleed(df).first().asDict()["Description"] is None
    out = conform(HeaderPlan(list(row), CORE).project(df), CORE).first().asDict()
    assert out["Description"] is None and out["Supplier Location"] == "Jan 3, 2026"
    assert str(out[UPDATED_AT]) == "2026-01-02" and str(out[INCIDENT_DATE]) == "2026-05-05"
    assert out["quantityAffected (Quantity Affected/Affected Quantity)"] == 0
    assert out["Reported By"] is None


def test_export_writes_every_known_column(spark):
    only = Registry.of([("Id", "VARCHAR(100)", False), ("Flag", "BIT", False), ("Other", "BIT", False), ("Day", "DATE", True)], ["Id", "Flag", "Day"])
    df = spark.sql("SELECT '1' AS Id, true AS Flag, date'2026-01-02' AS Day")
    assert export_text(df, only).first().asDict() == {"Day": "2026-01-02", "Flag": "1", "Id": "1", "Other": "0"}
