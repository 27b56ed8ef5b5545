"""Incident ingestion over the shared tables: drift, typing, merge.

The tables stand in for landed files: clean columns are written out as dirty
text under drifting headers, then resolved, typed and merged by the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provender.functions.dates import iso_day, parse_day
from provender.functions.text import leading_int, named
from provender.functions.typing import as_bit, as_decimal, as_text
from provender.operators import headers as H
from provender.operators import merge as M
from provender.operators.rows import conform, export_text, scrub_date_bleed
from provender.plans.catalog import Catalog
from provender.plans.tables import table
from provender.registry import (
    BUSINESS_KEY, CREATED_AT, DISTRIBUTOR, INCIDENT_DATE, KEY, LONG_GLN, LONG_NAME, RECEIVER, SHORT_GLN, SHORT_NAME,
    UPDATED_AT, Registry,
)
from provender.session import constant_table, scratch_dir
from provender.sources.incidents import read_incidents, snapshot_text
from provender.sources.sinks import upsert_table
from provender.sources.versioned import replace_table

catalog = Catalog()
QUERIES, SQL, query = catalog.queries, catalog.sql, catalog.query


def text(name: str):
    return F.col(name).cast("string")


# One registry for the order-shaped incidents used below.
ORDER_REGISTRY = Registry.of([
    (KEY, "VARCHAR(100)", False), (BUSINESS_KEY, "VARCHAR(max)", False), (CREATED_AT, "DATE", False),
    (UPDATED_AT, "DATE", False), (INCIDENT_DATE, "DATE", False), (LONG_NAME, "VARCHAR(max)", False),
    (SHORT_NAME, "VARCHAR(max)", True), (LONG_GLN, "VARCHAR(max)", False), (SHORT_GLN, "VARCHAR(max)", True),
    ("Description", "VARCHAR(max)", True), ("Credit Amount", "DECIMAL(38, 2)", True),
    ("Still have the product?", "BIT", True),
])


@query("""
SELECT c_custkey AS customer, c_name AS name, c_mktsegment AS segment,
       CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR) WHEN c_custkey % 3 = 1 THEN 'alt' || c_nationkey
            ELSE NULL END AS gtin,
       CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'second' END AS note
FROM customer
""")
def q_dup_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Positional CSV lines with repeated and blank headers, spreadsheet wrappers and apostrophes."""
    c = table(spark, sf, "customer")
    key = F.col("c_custkey")
    line = F.concat_ws(
        ",",
        F.concat(F.lit('"=""'), key.cast("string"), F.lit('"""')),
        F.concat(F.lit(" '"), F.col("c_name"), F.lit(" ")),
        F.when(key % 3 == 0, text("c_nationkey")).otherwise(""),
        F.lit("dropped"),
        F.when(key % 3 == 1, F.concat(F.lit("alt"), text("c_nationkey"))).otherwise(""),
        F.when(key % 2 == 0, F.col("c_name")).otherwise(""),
        F.col("c_mktsegment"),
        F.lit("second"))
    names = ["Id", "Name", "GTIN", "", "GTIN", "Note", "Segment", " Note "]
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    parsed = c.select(F.from_csv(line, schema, {"escape": '"', "emptyValue": "", "nullValue": "\u0000"}).alias("r")).select("r.*")
    parsed = parsed.select(*[F.coalesce(F.col(x), F.lit("")).alias(x) for x in parsed.columns])
    rows = H.positional(parsed, names)
    return rows.select(leading_int(F.col("Id")).alias("customer"), F.col("Name").alias("name"),
                       F.col("Segment").alias("segment"), F.col("GTIN").alias("gtin"), F.col("Note").alias("note"))


def _flat_and_bracketed(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("even", F.col("o_orderkey") % 2 == 0)
    day = F.date_format("o_orderdate", "MMM dd, yyyy")
    flat = o.where("not even").select(
        text("o_orderkey").alias("Id"), text("o_custkey").alias("Incident ID"),
        F.concat(F.lit("Loc "), text("o_custkey")).alias("My Location Name"),
        F.when(F.col("o_custkey") % 5 == 0, "").otherwise(text("o_custkey")).alias("My Location GLN"),
        F.col("o_orderpriority").alias("Shipment Originator"), day.alias("Incident Date"))
    bracketed = o.where("even").select(
        text("o_orderkey").alias("Id"), text("o_custkey").alias("Incident ID"),
        F.concat(F.lit("Loc "), text("o_custkey")).alias(SHORT_NAME),
        F.when(F.col("o_custkey") % 5 == 0, "").otherwise(text("o_custkey")).alias(SHORT_GLN),
        F.col("o_orderpriority").alias("distributor (Shipment Originator/Smithfield Plant/Receiver)"),
        day.alias("incidentDate (Incident Date/Delivery Date/Date)"))
    return H.union_by_header_set([(flat.columns, flat), (bracketed.columns, bracketed)], Registry.core())


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Loc ' || o_custkey AS long_name, 'Loc ' || o_custkey AS short_name,
       CASE WHEN o_custkey % 5 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN '' END ELSE CAST(o_custkey AS VARCHAR) END AS long_gln,
       o_orderpriority AS distributor, o_orderpriority AS receiver, CAST(o_orderdate AS DATE) AS incident_date
FROM orders
""")
def q_header_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Flat headers on one half, bracketed ones on the other; both reach the same columns."""
    out = _flat_and_bracketed(spark, sf)
    return out.select(
        F.col("Id").alias("id"), named(LONG_NAME).alias("long_name"), named(SHORT_NAME).alias("short_name"),
        named(LONG_GLN).alias("long_gln"), named(DISTRIBUTOR).alias("distributor"), named(RECEIVER).alias("receiver"),
        parse_day(named(INCIDENT_DATE)).alias("incident_date"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS product,
       CASE WHEN o_orderkey % 3 = 0 THEN 'S' || o_custkey ELSE 'M' || o_custkey END AS membership,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) END AS lot, o_orderstatus AS kind,
       CAST(o_orderdate AS DATE) AS incident_date
FROM orders
""")
def q_header_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Token order shuffled, supersets and overlaps of bracketed headers."""
    o = table(spark, sf, "orders").withColumn("third", F.col("o_orderkey") % 3 == 0)
    day = F.date_format("o_orderdate", "yyyy/MM/dd")
    shuffled = o.where("third").select(
        text("o_orderkey").alias("Id"), F.col("o_orderpriority").alias("product (Material GTIN/Product GTIN/Product Name GTIN)"),
        F.concat(F.lit("S"), text("o_custkey")).alias("sourceMembership (Product Supplier/Supplier)"),
        text("o_custkey").alias("product (Product LOT/Material LOT/Product Name LOT)"),
        F.col("o_orderstatus").alias("productType (Material Category/Product Type/Product Name/QA Product Category)"),
        day.alias("incidentDate (Date of Delivery/Delivery Date/Incident Date)"))
    closest = o.where("not third").select(
        text("o_orderkey").alias("Id"), F.col("o_orderpriority").alias("product (Product GTIN/Material GTIN)"),
        F.concat(F.lit("M"), text("o_custkey")).alias("sourceMembership (Supplier/Something Else)"),
        F.col("o_orderstatus").alias("productType (Product Type/Material Category)"),
        day.alias("incidentDate (Delivery Date/Incident Date)"))
    r = Registry.core()
    out = H.union_by_header_set([(shuffled.columns, shuffled), (closest.columns, closest)], r)
    member = F.coalesce(named("sourceMembership (Supplier/Product Supplier)"),
                        named("sourceMembership (Manufacturer of Product or Distributor Name/Supplier/Product Supplier/Supplier Name)"))
    date = F.coalesce(named(INCIDENT_DATE), named("incidentDate (Incident Date/Delivery Date)"))
    return out.select(
        F.col("Id").alias("id"), named("product (Product GTIN/Product Name GTIN/Material GTIN)").alias("product"),
        member.alias("membership"), named("product (Product Name LOT/Material LOT/Product LOT)").alias("lot"),
        named("productType (Product Name/Product Type/QA Product Category/Material Category)").alias("kind"),
        parse_day(date).alias("incident_date"))


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS community, CAST(p_size AS VARCHAR) AS quantity,
       CAST(p_size AS VARCHAR) AS kept_quantity, p_brand AS credit_note, p_brand AS credit_to_supplier,
       CASE WHEN p_partkey % 4 = 0 THEN 'own ' || p_type ELSE p_type END AS description
FROM part
""")
def q_header_overrides(spark: SparkSession, sf: str) -> DataFrame:
    """Approved overrides, credit-note rules and renames with kept sources."""
    p = table(spark, sf, "part").select(
        text("p_partkey").alias("Id"), F.col("p_name").alias("Community"), text("p_size").alias("Affected Quantity"),
        F.col("p_brand").alias("CREDIT NOTE"), F.col("p_type").alias("Claim Text"),
        F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("own "), F.col("p_type"))).alias("Description"))
    out = H.HeaderPlan(p.columns, Registry.core(), [("Claim Text", "Description")]).project(p)
    return out.select(
        F.col("Id").alias("id"), named("community (Community/Business Name)").alias("community"),
        named("quantityAffected (Quantity Affected/Affected Quantity)").alias("quantity"),
        named("Affected Quantity").alias("kept_quantity"), named("Credit Note").alias("credit_note"),
        named("Credit note to supplier").alias("credit_to_supplier"), named("Description").alias("description"))


@query("""
SELECT s_suppkey AS id, n_name AS long_name, n_name AS short_name, CAST(n_nationkey AS VARCHAR) AS long_gln,
       CAST(n_nationkey AS VARCHAR) AS short_gln, s_name AS distributor, s_name AS receiver
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def q_header_fanout(spark: SparkSession, sf: str) -> DataFrame:
    """One location or distributor header fills all of its target columns."""
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    rows = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select(  # nation has 25 fixed rows
        text("s_suppkey").alias("Id"), F.col("n_name").alias("location (Location Name/Shop Name Name)"),
        text("n_nationkey").alias("location (Shop Name GLN/Location GLN)"),
        F.col("s_name").alias("distributor (Shipment Originator/Distributor)"))
    out = H.HeaderPlan(rows.columns, Registry.core()).project(rows)
    return out.select(
        leading_int(F.col("Id")).alias("id"), named(LONG_NAME).alias("long_name"), named(SHORT_NAME).alias("short_name"),
        named(LONG_GLN).alias("long_gln"), named(SHORT_GLN).alias("short_gln"), named(DISTRIBUTOR).alias("distributor"),
        named(RECEIVER).alias("receiver"))


# Headers under which the line items land, by file; some reach no column.
CORPUS_HEADERS = {
    "l_orderkey": "Id", "l_partkey": "My Location GLN", "l_quantity": "Affected Quantity",
    "l_returnflag": "Claim Comments", "l_linestatus": "Observation", "l_shipdate": "Incident Date",
}


def _corpus(spark: SparkSession, sf: str) -> tuple[DataFrame, Registry]:
    li = table(spark, sf, "lineitem")
    files = li.select(F.col("l_returnflag").alias("file"), *[
        (F.when(F.col(c) == "O", text(c)).otherwise("") if c == "l_linestatus" else text(c)).alias(h)
        for c, h in CORPUS_HEADERS.items()])
    registry = Registry.core().extended([("Incident Details", "VARCHAR(max)", True)])
    return H.cell_counts(files, F.col("file"), list(CORPUS_HEADERS.values())), registry


def _pairs(spark: SparkSession, registry: Registry) -> DataFrame:
    return constant_table(spark, H.lineage(list(CORPUS_HEADERS.values()), registry), ["header", "target"])


@query(f"""
WITH m(header, targets) AS (VALUES
  ('Affected Quantity', 'Affected Quantity | quantityAffected (Quantity Affected/Affected Quantity)'),
  ('Claim Comments', ''), ('Id', 'Id'),
  ('Incident Date', '{INCIDENT_DATE}'),
  ('My Location GLN', '{LONG_GLN} | {SHORT_GLN}'),
  ('Observation', ''))
SELECT header, targets, (SELECT count(*) FROM lineitem) AS n_rows,
  CASE WHEN header = 'Observation' THEN (SELECT count(*) FROM lineitem WHERE l_linestatus = 'O')
       ELSE (SELECT count(*) FROM lineitem) END AS n_filled
FROM m
""")
def q_mapping_report(spark: SparkSession, sf: str) -> DataFrame:
    """Which headers of the landed corpus reach which columns, with filled cells."""
    cells, registry = _corpus(spark, sf)
    return H.mapping_table(H.mapping_usage(cells, _pairs(spark, registry)))


@query("""
SELECT l_returnflag AS file, 'Claim Comments' AS header, count(*) AS n_filled FROM lineitem GROUP BY l_returnflag
UNION ALL
SELECT l_returnflag, 'Observation', count(*) FILTER (WHERE l_linestatus = 'O') FROM lineitem GROUP BY l_returnflag
""")
def q_unmapped_headers(spark: SparkSession, sf: str) -> DataFrame:
    cells, registry = _corpus(spark, sf)
    return H.unmapped_headers(H.mapping_usage(cells, _pairs(spark, registry)))


@query("""
SELECT 'Claim Comments' AS header, 'Comments' AS target, false AS usable, (SELECT count(*) FROM lineitem) AS n_rows
UNION ALL SELECT 'Observation', 'Incident Details', true, (SELECT count(*) FROM lineitem)
""")
def q_proposed_mappings(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed proposals for the headers seen; usable when the whitelist has the target."""
    cells, registry = _corpus(spark, sf)
    seen = cells.groupBy("header").agg(F.sum("n_rows").alias("n_rows"))
    proposals = constant_table(spark, H.PROPOSALS, ["source", "target"])
    targets = constant_table(spark, [(n,) for n in registry.active_names()], ["target"])
    usable = H.proposed_mappings(seen, proposals, targets).withColumn("usable", F.lit(True))
    return (proposals.join(seen.withColumnRenamed("header", "source"), "source")
            .join(usable, ["source", "target"], "left")
            .select(F.col("source").alias("header"), "target", F.coalesce("usable", F.lit(False)).alias("usable"), "n_rows"))


@query("""
WITH fed(target) AS (VALUES ('Id'), ('Affected Quantity'), ('quantityAffected (Quantity Affected/Affected Quantity)'))
SELECT required, count(*) AS n_columns, (SELECT count(*) FROM lineitem) AS n_rows FROM (
  VALUES ('Created At', true), ('Description', false), ('Due Date', false)) AS r(target, required)
WHERE target NOT IN (SELECT target FROM fed) GROUP BY required
""")
def q_unfed_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Registry columns that no file feeds, by whether they are required."""
    cells, _ = _corpus(spark, sf)
    small = Registry.of([
        (KEY, "VARCHAR(100)", False), (CREATED_AT, "DATE", False), ("Description", "VARCHAR(max)", True),
        ("Due Date", "DATETIME", True), ("Affected Quantity", "DECIMAL(38, 2)", True),
        ("quantityAffected (Quantity Affected/Affected Quantity)", "DECIMAL(38, 2)", False)])
    pairs = constant_table(spark, H.lineage(list(CORPUS_HEADERS.values()), small), ["header", "target"])
    usage = H.mapping_usage(cells, pairs)
    registry = constant_table(spark, [(s.name, s.kind, not s.nullable) for s in small.active()], ["target", "kind", "required"])
    total = cells.where(F.col("header") == KEY).agg(F.sum("n_rows")).first()[0]
    unfed = H.unfed_columns(usage, registry).groupBy("required").agg(F.count("*").alias("n_columns"))
    return unfed.withColumn("n_rows", F.lit(total))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS p_name,
       CASE WHEN p_partkey % 3 = 1 THEN p_brand END AS p_brand, CASE WHEN p_partkey % 3 <> 1 THEN p_size END AS p_size,
       CAST(NULL AS VARCHAR) AS added
FROM part
""")
def q_schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with differing columns, united, and a registry column added as null."""
    p = table(spark, sf, "part")
    parts = [p.where("p_partkey % 3 = 0").select("p_partkey", "p_name", "p_size"),
             p.where("p_partkey % 3 = 1").select("p_partkey", "p_brand"),
             p.where("p_partkey % 3 = 2").select("p_partkey", "p_size")]
    out = M.evolve(M.union_evolving(*parts), Registry.of([("P_NAME", "VARCHAR(max)", True), ("added", "VARCHAR(max)", True)]))
    return out.select("p_partkey", "p_name", "p_brand", "p_size", "added")


@query("""
SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false END AS flag,
       CASE p_size % 6 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN false END AS legacy_flag
FROM part
""")
def q_type_bit(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    words = F.array(*[F.lit(w) for w in ("Yes", "NO", "true", "False", "maybe", "")])
    word = F.element_at(words, (F.col("p_size") % 6 + 1).cast("int"))
    return p.select("p_partkey", as_bit(word).alias("flag"), as_bit(word, legacy_yes_no=True).alias("legacy_flag"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE l_partkey % 5 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN l_partkey * 10 ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS cents,
       CASE WHEN l_partkey % 5 = 1 THEN NULL WHEN l_partkey % 5 = 0 THEN 0 ELSE 1 END AS present
FROM lineitem
""")
def q_type_decimal(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    m = F.col("l_partkey") % 5
    price = F.format_string("%.2f", "l_extendedprice")
    cell = (F.when(m == 0, " ").when(m == 1, F.concat(text("l_partkey"), F.lit(",5")))
            .when(m == 2, F.concat(text("l_partkey"), F.lit("e-1"))).otherwise(F.concat(F.lit(" "), price, F.lit(" "))))
    value = as_decimal(cell, 2)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", (value * 100).cast("bigint").alias("cents"),
                     F.when(value.isNotNull(), F.when(value == 0, 0).otherwise(1)).alias("present"))


@query("""
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN ' n/a ' ELSE p_name END AS label
FROM part
""")
def q_type_text(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    words = F.array(F.lit(""), F.lit("NA"), F.lit("n/A"), F.lit(" n/a "), F.col("p_name"))
    return p.select("p_partkey", as_text(F.element_at(words, (F.col("p_partkey") % 5 + 1).cast("int"))).alias("label"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 22 = 13 THEN NULL WHEN o_orderkey % 22 = 16 THEN CAST(date_trunc('month', o_orderdate) AS DATE)
       ELSE CAST(o_orderdate AS DATE) END AS day,
       strftime(o_orderdate, '%Y-%m-%d') AS iso
FROM orders
""")
def q_type_dates(spark: SparkSession, sf: str) -> DataFrame:
    """One date written in every known shape, and one that is no date."""
    o = table(spark, sf, "orders")
    d = F.col("o_orderdate")
    shapes = ["yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "M/d/yyyy", "MM-dd-yyyy", "M-d-yyyy", "MMM d, yyyy", "MMMM d, yyyy",
              "MMM d yyyy", "MMMM d yyyy", "MMMM d, yyyy h:mma", "MMMM d yyyy h:mma", "yyyy-MM-dd'T'HH:mm:ss'Z'"]
    free = ["yyyy-M-d", "yyyyMMdd", "yyyy-MM", "yyyy/M/d", "M/d/yyyy H:mm", "M/d/yyyy h:mm:ss a", "MMM d, yyyy h:mm a", "yyyy-MM-dd H:mm:ss"]
    cells = F.array(*[F.date_format(d, s) for s in shapes], F.concat(F.lit("2026-02-30"), F.lit("x")),
                    *[F.date_format(d, s) for s in free])
    cell = F.element_at(cells, (F.col("o_orderkey") % 22 + 1).cast("int"))
    return o.select("o_orderkey", parse_day(cell).alias("day"),
                    iso_day(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")).alias("iso"))


@query("""
WITH l AS (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey)
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS created, CAST(o_orderdate AS DATE) AS updated,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE)
            ELSE COALESCE(CAST(first_ship AS DATE), CAST(o_orderdate AS DATE)) END AS incident_date,
       0 AS quantity_cents
FROM orders LEFT JOIN l ON o_orderkey = l_orderkey
""")
def q_not_null_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Required dates fall back to a stand-in date; required numbers to 0."""
    first = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))
    o = table(spark, sf, "orders")
    rows = o.join(first, o.o_orderkey == first.l_orderkey, "left").select(
        text("o_orderkey").alias(KEY), F.date_format("o_orderdate", "yyyy-MM-dd").alias(CREATED_AT),
        F.when(F.col("o_orderkey") % 2 == 1, F.date_format("first_ship", "M/d/yyyy")).alias("Date Product Received"))
    typed = conform(rows, Registry.core())
    return typed.select(
        F.col(KEY).alias("id"), named(CREATED_AT).alias("created"), named(UPDATED_AT).alias("updated"),
        named(INCIDENT_DATE).alias("incident_date"),
        (named("quantityAffected (Quantity Affected/Affected Quantity)") * 100).cast("int").alias("quantity_cents"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN o_orderpriority
       ELSE strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') END AS description,
       strftime(o_orderdate, '%Y-%m-%d') AS kept
FROM orders
""")
def q_bleed_scrub(spark: SparkSession, sf: str) -> DataFrame:
    """A stray copy of the creation date is cleared from text columns, in any date shape."""
    o = table(spark, sf, "orders")
    d = F.col("o_orderdate")
    rows = o.select(
        text("o_orderkey").alias(KEY), F.date_format(d, "yyyy-MM-dd").alias(CREATED_AT),
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format(d, "MMMM d, yyyy"))
        .when(F.col("o_orderkey") % 3 == 1, F.col("o_orderpriority"))
        .otherwise(F.date_format(d + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd")).alias("Description"),
        F.date_format(d, "yyyy-MM-dd").alias("Other Text"))
    out = scrub_date_bleed(rows)
    return out.select(F.col(KEY).alias("id"), F.col("Description").alias("description"), F.col("Other Text").alias("kept"))


@query("SELECT user_id, event_type, count(*) AS n_rows FROM events GROUP BY user_id, event_type HAVING count(*) > 1")
def q_key_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    return M.duplicate_keys(table(spark, sf, "events"), ["user_id", "event_type"])


def _incident_text(o: DataFrame, updated: bool) -> DataFrame:
    """Orders as dirty incident text; an update lacks some values."""
    key = F.col("o_orderkey")
    gone = (key % 4 == 0) if updated else F.lit(False)
    return o.select(
        F.concat(F.lit('="'), text("o_orderkey"), F.lit('"')).alias("Id"), text("o_custkey").alias("Incident ID"),
        F.date_format("o_orderdate", "MMM d, yyyy").alias(CREATED_AT),
        F.when(gone, " ").otherwise(F.concat(F.lit("Loc "), text("o_custkey"))).alias("My Location Name"),
        F.when(gone, "N/A").otherwise(F.concat(F.lit("v2 " if updated else "v1 "), F.col("o_orderpriority"))).alias("Description"),
        F.when(key % 5 == 0, "n.a.").otherwise(F.format_string("%.2f", F.col("o_totalprice") + F.lit(1.0 if updated else 0.0)))
        .alias("Credit Amount"),
        F.when(key % 2 == 0, "yes").otherwise("").alias("Still have the Product?"))


def _resolve(df: DataFrame) -> DataFrame:
    cleaned = H.positional(df.select(*[named(c).alias(f"c{i}") for i, c in enumerate(df.columns)]), df.columns)
    return conform(H.HeaderPlan(cleaned.columns, ORDER_REGISTRY).project(cleaned), ORDER_REGISTRY)


def _target_and_updates(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders")
    return (_resolve(_incident_text(o.where("o_orderkey % 3 <> 0"), False)),
            _resolve(_incident_text(o.where("o_orderkey % 3 <> 1"), True)))


UPSERT_SQL = """
WITH s AS (SELECT *, o_orderkey % 3 <> 0 AS stored, o_orderkey % 3 <> 1 AS incoming, o_orderkey % 4 = 0 AS gone FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS incident_id, CAST(o_orderdate AS DATE) AS created,
       CASE WHEN incoming AND gone AND NOT stored THEN '' ELSE 'Loc ' || o_custkey END AS location,
       CASE WHEN incoming AND NOT gone THEN 'v2 ' || o_orderpriority WHEN stored THEN 'v1 ' || o_orderpriority END AS description,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL
            ELSE CAST(round((o_totalprice + CASE WHEN incoming THEN 1 ELSE 0 END) * 100) AS BIGINT) END AS credit_cents,
       CASE WHEN o_orderkey % 2 = 0 THEN true END AS still_have
FROM s
"""


@query(UPSERT_SQL)
def q_upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty text, resolved and typed, merged into the stored table without losing values."""
    target, updates = _target_and_updates(spark, sf)
    stored = scratch_dir(spark, "incidents")
    replace_table(spark, stored, target)
    merged = upsert_table(spark, updates.withColumn("_seq", F.lit(1)), stored, ORDER_REGISTRY, KEY, ["_seq"])
    return merged.select(
        F.col(KEY).alias("id"), named(BUSINESS_KEY).alias("incident_id"), named(CREATED_AT).alias("created"),
        named(LONG_NAME).alias("location"), F.col("Description").alias("description"),
        (named("Credit Amount") * 100).cast("bigint").alias("credit_cents"), named("Still have the product?").alias("still_have"))


# The same columns under three header rows: other names, another order, a long question.
LANDED_HEADERS = [
    {},
    {"My Location Name": LONG_NAME},
    {"Still have the Product?": "Is any of it left, and where?"},
]
LANDED_RENAMES = [("Is any of it left, and where?", "Still have the product?")]


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS incident_id, CAST(o_orderdate AS DATE) AS created,
       'Loc ' || o_custkey AS location, 'v1 ' || o_orderpriority AS description,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS credit_cents,
       CASE WHEN o_orderkey % 2 = 0 THEN true END AS still_have
FROM orders
""")
def q_landed_windows(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files of three header rows, landed, found by their headers, and read as one typed table."""
    folder = scratch_dir(spark, "landed")
    rows = _incident_text(table(spark, sf, "orders"), False)
    for i, names in enumerate(LANDED_HEADERS):
        part = rows.where(F.pmod(F.xxhash64("Id"), F.lit(len(LANDED_HEADERS))) == i).withColumnsRenamed(names)
        order = part.columns[i:] + part.columns[:i]
        part.select(*[named(c) for c in order]).write.csv(f"{folder}/{i}", header=True, quote='"', escape='"')
    paths = [f"{folder}/{i}" for i in range(len(LANDED_HEADERS))]
    read = read_incidents(spark, paths, ORDER_REGISTRY, multi_line=False, renames=LANDED_RENAMES)
    return read.select(
        F.col(KEY).alias("id"), named(BUSINESS_KEY).alias("incident_id"), named(CREATED_AT).alias("created"),
        named(LONG_NAME).alias("location"), F.col("Description").alias("description"),
        (named("Credit Amount") * 100).cast("bigint").alias("credit_cents"), named("Still have the product?").alias("still_have"))


@query("""
SELECT user_id AS key, max_by(event_type, ts) AS last_type,
       max_by(CASE WHEN value < 50 THEN value END, CASE WHEN value < 50 THEN ts END) AS last_small,
       max_by(props, CASE WHEN event_type = 'purchase' THEN ts END) AS last_purchase, count(*) > 0 AS seen
FROM events GROUP BY user_id
""")
def q_fold_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Many updates per key folded in order: the last value of each column stays."""
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("key"), "ts", "event_type", F.when(F.col("value") < 50, F.col("value")).alias("last_small"),
        F.when(F.col("event_type") == "purchase", F.col("props")).otherwise("").alias("last_purchase"), F.lit(True).alias("seen"))
    out = M.fold_updates(e.withColumnRenamed("event_type", "last_type"), "key", ["ts"], {
        "last_type": M.TEXT, "last_small": M.VALUE, "last_purchase": M.TEXT, "seen": M.VALUE})
    return out.select("key", "last_type", "last_small", "last_purchase", "seen")


@query("""
WITH s AS (SELECT *, o_orderkey % 3 <> 0 AS stored FROM orders WHERE o_orderkey % 3 <> 1)
SELECT o_orderkey AS id, COALESCE(CASE WHEN stored AND o_orderkey % 7 <> 0 THEN 'v1' END, 'null') AS description_before,
       CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS description_incoming,
       CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus WHEN stored AND o_orderkey % 7 <> 0 THEN 'v1' END AS description_after,
       o_orderkey % 4 <> 0 AS description_would_change
FROM s
""")
def q_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    """What the merge would change, against an export where NULL is a word."""
    o = table(spark, sf, "orders")
    export = o.where("o_orderkey % 3 <> 0").select(
        F.col("o_orderkey").alias("id"),
        snapshot_text(F.when(F.col("o_orderkey") % 7 == 0, " null ").otherwise(" v1")).alias("description"))
    incoming = o.where("o_orderkey % 3 <> 1").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.col("o_orderstatus")).alias("description"))
    return M.merge_preview(export, incoming, "id", ["description"])


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d') AS created,
       CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE printf('%.2f', o_totalprice) END AS credit,
       CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '' END AS still_have, 'v1 ' || o_orderpriority AS description,
       '' AS short_gln
FROM orders
""")
def q_export_text(spark: SparkSession, sf: str) -> DataFrame:
    """Typed rows back to export text."""
    out = export_text(_resolve(_incident_text(table(spark, sf, "orders"), False)), ORDER_REGISTRY)
    return out.select(F.col(KEY).alias("id"), named(CREATED_AT).alias("created"), named("Credit Amount").alias("credit"),
                      named("Still have the product?").alias("still_have"), F.col("Description").alias("description"),
                      named(SHORT_GLN).alias("short_gln"))


@query("""
SELECT COALESCE(a.k, b.k) AS key, CASE WHEN b.k IS NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM (SELECT DISTINCT user_id * 100 + hour(ts) AS k FROM events WHERE ts < TIMESTAMP '2024-01-10') a
FULL JOIN (SELECT DISTINCT user_id * 100 + hour(ts) AS k FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12') b
ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL
""")
def q_window_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Ids that only one of two overlapping windows holds."""
    e = table(spark, sf, "events").withColumn("key", F.col("user_id") * 100 + F.hour("ts"))
    left = e.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    right = e.where((F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz"))
                    & (F.col("ts") < F.lit("2024-01-12").cast("timestamp_ntz")))
    return M.window_difference(left, right, "key")
