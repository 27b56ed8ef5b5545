import itertools
import random

from pyspark.sql import functions as F

from provender.operators import match as X
from provender.operators import partners as P
from provender.plans.partners import q_back_office_list


def partners(spark, *rows):
    return spark.createDataFrame(list(rows), "masterid string, external_ids array<string>")


def elements(spark, *rows):
    df = spark.createDataFrame(list(rows), "id string, internal string, name string")
    return P.map_partner(df, "id", "internal", {"name": "name"})


def test_mapping(spark):
    got = {r.id: (r.name, r.external_ids) for r in elements(spark, ("1", "a, b", None), ("2", "", "N"), ("3", None, "M")).collect()}
    assert got == {"1": ("", ["source:1", "sap:a", "sap:b"]), "2": ("N", ["source:2"]), "3": ("M", ["source:3"])}


def test_free_id_is_attached_and_taken_id_reported(spark):
    owners = P.id_owners(partners(spark, ("m1", ["source:1"]), ("m2", ["source:2", "sap:taken"])))
    found = P.resolve(elements(spark, ("1", "taken,free", "x"), ("3", None, "y"), ("2", "taken", "z")), owners, "id")
    got = {r.id: (r.masterid, r.is_new, r.attached, r.conflicts, r.reason) for r in P.attach_ids(found, owners, "id").collect()}
    assert got["1"] == ("m1", False, "sap:free,source:1", "sap:taken", "Conflicting internalIds: sap:taken")
    assert got["3"] == (None, True, "source:3", "", "business is missing internalIds")
    assert got["2"] == ("m2", False, "sap:taken,source:2", "", None)


def test_only_unknown_source_ids_are_new(spark):
    owners = P.id_owners(partners(spark, ("m1", ["source:1", "sap:2"])))
    assert [r.id for r in P.new_partners(elements(spark, ("1", None, ""), ("2", "2", "")), owners).collect()] == ["2"]


def test_merge_needs_exactly_one_partner_each(spark):
    owners = P.id_owners(partners(spark, ("a", ["source:1", "source:2"]), ("b", ["sap:1", "sap:2"]), ("c", ["sap:2"])))
    matches = spark.createDataFrame([("1", "1"), ("2", "2"), ("3", "1")], "source_id string, office_id string")
    assert [(r.from_partner, r.to_partner) for r in P.merge_pairs(matches, owners).collect()] == [("a", "b")]


def test_repairs(one):
    ids = lambda *x: F.array(*[F.lit(i) for i in x]).cast("array<string>")
    none = F.lit(None).cast("string")
    assert one(P.repair_ids(ids("source:undefined", "sap:1", "sap:undefined"), none)) == ["sap:1"]
    assert one(P.repair_ids(ids("sap:1"), F.lit("9"))) == ["source:9"]
    assert one(P.migrate_ids(none, ids("source:3", "sap:1"), none)) == ["source:3", "sap:1"]
    assert one(P.migrate_ids(F.lit("5"), ids("source:3"), none)) == ["source:5"]
    assert one(P.migrate_ids(none, ids("sap:1"), none)) == []
    assert one(P.may_update_internal(F.lit("a,b"), F.lit("b,a"))) is True
    assert one(P.may_update_internal(F.lit("a,c"), F.lit("b,a"))) is False
    assert one(P.may_update_internal(none, F.lit("b"))) is True


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] / max(len(a), len(b))


def noisy(rng, name):
    out = list(name)
    for _ in range(rng.randrange(0, 4)):
        at = rng.randrange(len(out))
        out[at:at + rng.randrange(0, 2)] = rng.choice(["", "x", "ab"])
    return "".join(out) or "q"


def test_similar_names_equal_brute_force(spark):
    rng = random.Random(11)
    words = ["green", "farm", "meat", "co", "foods", "aaa", "aaaa", "inc", "mill", "x"]
    right = sorted({" ".join(rng.sample(words, rng.randrange(1, 4))) for _ in range(60)})
    left = sorted({noisy(rng, rng.choice(right)) for _ in range(80)})
    df = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    for threshold in (0.1, 0.2, 0.33, 0.45):
        got = [(r.left_name, r.right_name) for r in X.similar_names(df(left), df(right), threshold).collect()]
        want = {(a, b) for a in left for b in right if distance(a, b) <= threshold}
        assert len(got) == len(set(got)) and set(got) == want


def test_matches_equal_brute_force_with_one_huge_name(spark):
    """A third of both sides share one name; the best vendors are still exact."""
    rng = random.Random(5)
    names = ["acme foods", "acme food", "acne foods inc", "north mill", "north mills", "zz top"]
    rows = lambda n: [(i, "acme foods" if i % 3 == 0 else rng.choice(names), rng.choice(["", "1 st", "2 st"]), rng.choice(["c", "d"]), rng.choice(["", "s"]))
                      for i in range(n)]
    b, v = rows(60), rows(90)
    schema = "name string, address string, city string, state string"
    bdf = spark.createDataFrame(b, f"business_id int, {schema}")
    vdf = spark.createDataFrame(v, f"vendor_id int, {schema}")
    got = {}
    for r in X.match_vendors(bdf, vdf, 0.3).collect():
        got.setdefault(r.business_id, []).append((r.rank, r.score, r.vendor_id))
    weights = (2.0, 0.5, 0.5)
    for bid, name, *fields in b:
        scored = []
        for vid, other, *theirs in v:
            d = distance(name, other)
            if d > 0.3:
                continue
            used = [(w, x != y) for w, x, y in zip(weights, fields, theirs) if x]
            mean = (5 * d + sum(w for w, differs in used if differs)) / (5 + sum(w for w, _ in used))
            scored.append((round(min(d, mean), 6), vid))
        scored.sort()
        want = scored if len(scored) <= 5 else scored[:4]
        assert [(s, i) for _, s, i in sorted(got.get(bid, []))] == want, bid


def test_exactly_five_stay(spark):
    df = spark.createDataFrame([(1, i, 0.1 * i) for i in range(5)] + [(2, i, 0.1 * i) for i in range(6)], "k int, vendor_id int, score double")
    counts = {r.k: r["count"] for r in X.cut_candidates(df, ["k"]).groupBy("k").count().collect()}
    assert counts == {1: 5, 2: 4}


def test_review(spark):
    rows = spark.createDataFrame([(1, " x", 0.0), (1, "", 0.5), (2, "X", 0.2), (2, "x", 0.3), (3, "no", 0.4)], "id int, mark string, score double")
    marked = X.is_marked(F.col("mark"))
    assert [r.id for r in X.unmarked_ids(rows, "id", marked).collect()] == [3]
    assert [r.id for r in X.multiply_marked_ids(rows, "id", marked).collect()] == [2]
    assert [r.id for r in X.accepted_matches(rows, "id", marked).collect()] == [1]
    assert X.unmarked_ids(rows, "id", X.is_marked(F.col("mark"), any_mark=True)).count() == 0
    assert sorted((r.id, r.score) for r in X.reduce_perfect(rows, "id").collect()) == [(1, 0.0), (2, 0.2), (2, 0.3), (3, 0.4)]


def test_vendor_scan(spark):
    cols = "Vendor string, VendorName string, StreetAddress string, City string, Region string, Telephone1 string, Telephone2 string, PostalCode string, TaxNumber2 string, CentralDeletionFlag string"
    row = lambda i, name, flag: (i, name, "a", "c", "r", None, "2", "p", "t", flag)
    df = spark.createDataFrame([row("1", "Ok", ""), row("2", "BLK Bad", ""), row("3", "Gone", " X ")], cols)
    got = P.vendors(df).collect()
    assert [(r.vendor_id, r.phone, r.ein1) for r in got] == [("1", "2", "t")]


def test_migrated_partner_has_every_field(spark):
    old = spark.createDataFrame(
        [("a", "Mills", None, "7", ["source:x"], "9"), ("b", None, None, None, ["source:x", "sap:1"], "9"),
         ("c", None, None, "", None, "9"), ("d", None, None, None, None, None)],
        "id string, name string, city string, own_source_id string, external_ids array<string>, change_id string")
    rows = {r.masterid: r for r in P.migrate_partners(old).collect()}
    assert [rows[k].external_ids for k in "abcd"] == [["source:7"], ["source:x", "sap:1"], ["source:9"], []]
    assert rows["a"].name == "Mills" and rows["b"].name == rows["a"].city == rows["d"].phone == "" and not rows["a"].frozen


def test_vendors_without_flag_or_name_stay(spark):
    columns = "Vendor, VendorName, CentralDeletionFlag, StreetAddress, City, Region, Telephone1, Telephone2, PostalCode, TaxNumber1, TaxNumber2".split(", ")
    rows = [("1", "Mill", None), ("2", None, ""), ("3", "BLK Mill", None), ("4", "Mill", " X "), ("5", None, None)]
    master = spark.createDataFrame([r + (None,) * 8 for r in rows], ", ".join(f"{c} string" for c in columns))
    assert sorted(r.vendor_id for r in P.vendors(master).collect()) == ["1", "2", "5"]


def test_back_office_list_of_groups_shuffles_no_pair(spark):
    """Whole groups that match give what their pairs give, repeats and nulls too; pairs are made in the last join."""
    b = spark.createDataFrame([(1, "Mill", "1 st", None, "s"), (2, "Farm", None, "c", "s"), (2, "Farm 2", "2 st", "c", ""), (None, "No id", "a", "b", "c")],
                              "business_id int, name string, address string, city string, state string")
    v = spark.createDataFrame([(i, f"v{i}", "a", "c", None, f"e{i}") for i in range(40)] + [(3, "again", None, None, None, None)],
                              "vendor_id int, name string, address string, city string, state string, ein string")
    left = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y"), (None, "x"), (1, None)], "business_id int, g string")
    right = spark.createDataFrame([(i, "x" if i % 2 else None if i % 5 == 0 else "y") for i in range(40)] + [(3, "x")], "vendor_id int, g string")
    rows = lambda df: sorted(map(repr, df.collect()))
    whole = X.back_office_list(b, v, (left, right), ["g"])
    assert rows(whole) == rows(X.back_office_list(b, v, left.join(right, "g"))) != []
    assert whole.where("office_ein = 'e1'").orderBy("business_name").first().asDict() == {
        "business_id": 2, "business_name": "Farm", "business_address": "; c; s", "office_name": "v1", "office_address": "a; c; ", "office_ein": "e1"}


def test_back_office_query_makes_its_pairs_last(spark, tmp_path):
    land = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    land("supplier", [(i, f"s{i}", i % 3) for i in range(9)], "s_suppkey long, s_name string, s_nationkey int")
    land("nation", [(i, f"n{i}") for i in range(3)], "n_nationkey int, n_name string")
    land("part", [(i, "p", "b", i % 3) for i in range(30)], "p_partkey long, p_name string, p_brand string, p_size int")
    found = q_back_office_list(spark, str(tmp_path))
    assert found.count() == 90
    joins = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert "size" in joins[0] and not any("size" in x for x in joins[1:])


def test_reach_of_names(spark):
    """Once names up to a distance have enough vendors, farther names know it, and few of them are looked up."""
    pairs = spark.createDataFrame([("a", "x", 0.0), ("a", "y", 0.1), ("a", "z", 0.2), ("b", "y", 0.1)], "left_name string, right_name string, distance double")
    vendors = spark.createDataFrame([(i, "x") for i in range(4)] + [(9, "y"), (10, "y"), (11, "z")], "vendor_id int, name string")
    got = {(r.left_name, r.right_name): r.reach for r in X._with_reach(pairs, vendors, 6).collect()}
    assert got == {("a", "x"): None, ("a", "y"): 0.1, ("a", "z"): 0.1, ("b", "y"): None}


def test_pairs_of_a_group_come_block_by_block(spark):
    """A block of businesses meets all vendors of a part before the next block does, so cells repeat close to each other."""
    b = spark.range(1000).select(F.col("id").alias("business_id"), F.format_string("b%d", "id").alias("name"),
                                 *[F.lit("x").alias(c) for c in ("address", "city", "state")])
    v = spark.range(64).select(F.col("id").alias("vendor_id"), F.format_string("v%d", "id").alias("name"),
                               *[F.lit("y").alias(c) for c in ("address", "city", "state")], F.format_string("e%d", "id").alias("ein"))
    found = X.back_office_list(b, v, (b.select("business_id", F.lit(1).alias("g")), v.select("vendor_id", F.lit(1).alias("g"))), ["g"])
    pairs = [(r.business_id, r.office_ein) for r in found.collect()]
    assert len(pairs) == len(set(pairs)) == 64000
    runs = [len(list(rows)) for _, rows in itertools.groupby(pairs, key=lambda p: p[1])]
    assert max(runs) <= X.GROUP_BLOCK * 2 and len(runs) < 64000 / 20
    gaps, last = [], {}
    for i, (business, _) in enumerate(pairs):
        gaps += [i - last[business]] if business in last else []
        last[business] = i
    assert sorted(gaps)[len(gaps) // 2] <= X.GROUP_BLOCK
