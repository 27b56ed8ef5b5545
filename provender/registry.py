"""The target columns of the incident table: names, kinds and null rules.

The full column list is data, not code: it is read from a registry file, from
the header of an export, or from an existing table. Only the columns that a
rule names are listed here.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from provender.functions.typing import spark_type

# ---------------------------------------------------------------------------
# Canonical column names that rules refer to.
LONG_NAME = "location (Location Name/Shop Name Name/Restaurant Reporting Complaint Name/My Location Name)"
LONG_GLN = "location (Location GLN/Shop Name GLN/Restaurant Reporting Complaint GLN/My Location GLN)"
SHORT_NAME = "location (My Location Name/Location Name)"
SHORT_GLN = "location (My Location GLN/Location GLN)"
DISTRIBUTOR = "distributor (Distribution Center/Distributor/Shipment Originator/Smithfield Plant)"
RECEIVER = "distributor (Shipment Originator/Receiver)"
INCIDENT_DATE = "incidentDate (Incident Date/Date of Delivery/Delivery Date)"
INCIDENT_DATE_SHORT = "incidentDate (Incident Date/Delivery Date)"
CREATED_AT = "Created At"
UPDATED_AT = "Last Updated At"
KEY = "Id"
BUSINESS_KEY = "Incident ID"

# Fixed values: (name, kind, may be null) of the columns that rules or types
# other than plain nullable text depend on.
CORE_COLUMNS = (
    (KEY, "VARCHAR(100)", False),
    (BUSINESS_KEY, "VARCHAR(max)", False),
    ("Incident Type", "VARCHAR(max)", False),
    ("Current Status", "VARCHAR(max)", False),
    (UPDATED_AT, "DATE", False),
    ("Last Updated By", "VARCHAR(max)", False),
    ("Reported By", "VARCHAR(max)", False),
    (CREATED_AT, "DATE", False),
    ("Created From", "VARCHAR(max)", False),
    (LONG_NAME, "VARCHAR(max)", False),
    (LONG_GLN, "VARCHAR(max)", False),
    ("community (Community/Business Name)", "VARCHAR(max)", False),
    (INCIDENT_DATE, "DATE", False),
    ("quantityAffected (Quantity Affected/Affected Quantity)", "DECIMAL(38, 2)", False),
    ("product (Product GTIN/Product Name GTIN/Material GTIN)", "VARCHAR(max)", False),
    (DISTRIBUTOR, "VARCHAR(max)", True),
    (RECEIVER, "VARCHAR(max)", True),
    ("productType (Product Name/Product Type/QA Product Category/Material Category)", "VARCHAR(max)", True),
    ("sourceMembership (Manufacturer of Product or Distributor Name/Supplier/Product Supplier/Supplier Name)", "VARCHAR(max)", True),
    ("sourceMembership (Supplier/Product Supplier)", "VARCHAR(max)", True),
    ("supplierLocation (Supplier Location/Supplier Manufacturing Location)", "VARCHAR(max)", True),
    ("product (Product Name Name/Material Name/Product Name)", "VARCHAR(max)", True),
    ("product (Product Name LOT/Material LOT/Product LOT)", "VARCHAR(max)", True),
    (SHORT_NAME, "VARCHAR(max)", True),
    (SHORT_GLN, "VARCHAR(max)", True),
    (INCIDENT_DATE_SHORT, "DATE", True),
    ("images (Photo of Case Labels & Product/Photos or Documents)", "VARCHAR(max)", True),
    ("Due Date", "DATETIME", True),
    ("Invoice Date / Delivery Date", "DATE", True),
    ("Use By Date / Freeze By Date / Expiration Date", "DATE", True),
    ("Best By/Expiration Date", "DATE", True),
    ("Date Product Received", "DATE", True),
    ("Best By/Use By Date", "DATE", True),
    ("Best By Date", "DATE", True),
    ("Date Received Original PO", "DATE", True),
    ("Plant Production Date", "DATE", True),
    ("Affected Quantity", "DECIMAL(38, 2)", True),
    ("Credit Amount", "DECIMAL(38, 2)", True),
    ("Quantity", "DECIMAL(38, 0)", True),
    ("PO Number", "DECIMAL(38, 0)", True),
    ("GTIN", "VARCHAR(max)", True),
    ("Credit Note", "VARCHAR(max)", True),
    ("Credit note to supplier", "VARCHAR(max)", True),
    ("DC Pick Label", "VARCHAR(max)", True),
    ("IMAGE OF SUPPLIER CASE LABEL", "VARCHAR(max)", True),
    ("Still have the product?", "BIT", True),
    ("Distributor Item Number", "VARCHAR(max)", True),
    ("Restaurant Contact Name", "VARCHAR(max)", True),
    ("Supplier Location", "VARCHAR(max)", True),
    ("Producing Plant", "VARCHAR(max)", True),
    ("Description", "VARCHAR(max)", True),
    ("Review and Action Comments", "VARCHAR(max)", True),
)
# Not-null incidentDate falls back to the first of these that is set.
INCIDENT_DATE_FALLBACKS = (
    INCIDENT_DATE_SHORT,
    "Invoice Date / Delivery Date",
    "Date Product Received",
    "Date Received Original PO",
    "Best By/Use By Date",
    "Best By/Expiration Date",
    "Best By Date",
    "Plant Production Date",
)
# Text columns that may carry a stray copy of the creation date.
BLEED_COLUMNS = (
    "Distributor Item Number",
    "Restaurant Contact Name",
    "Supplier Location",
    "Producing Plant",
    "Description",
    "Review and Action Comments",
)
# Words that approve a proposed mapping.
APPROVAL_WORDS = ("true", "yes", "y", "1", "approved", "ok")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    kind: str
    nullable: bool = True

    @property
    def is_text(self) -> bool:
        return "VARCHAR" in self.kind.upper()


@dataclass(frozen=True)
class Registry:
    """Known columns, and the subset of them (the whitelist) a target accepts."""

    known: tuple[ColumnSpec, ...]
    allowed: frozenset[str] = field(default_factory=frozenset)

    @staticmethod
    def of(columns: Iterable[Sequence], allowed: Iterable[str] | None = None) -> Registry:
        specs = tuple(c if isinstance(c, ColumnSpec) else ColumnSpec(*c) for c in columns)
        names = frozenset(s.name for s in specs)
        keep = names if allowed is None else frozenset(a.strip() for a in allowed)
        return Registry(specs, keep)

    @staticmethod
    def core() -> Registry:
        return Registry.of(CORE_COLUMNS)

    @staticmethod
    def from_file(path: str) -> Registry:
        """A ``name,type,nullable`` CSV, one line per column."""
        with open(path, newline="", encoding="utf-8-sig") as f:
            return Registry.of(
                ColumnSpec(r["name"], r["type"], r["nullable"].strip().lower() in ("true", "1", "yes"))
                for r in csv.DictReader(f)
            )

    @staticmethod
    def from_table(table: DataFrame) -> Registry:
        """Columns of an existing table; text unless the table says otherwise."""
        kinds = {"boolean": "BIT", "date": "DATE", "timestamp": "DATETIME"}

        def kind(t: T.DataType) -> str:
            if isinstance(t, T.DecimalType):
                return f"DECIMAL({t.precision}, {t.scale})"
            return kinds.get(t.simpleString(), "VARCHAR(max)")

        return Registry.of(ColumnSpec(f.name, kind(f.dataType), f.nullable) for f in table.schema)

    def extended(self, columns: Iterable[Sequence]) -> Registry:
        """Add further columns; a name already known (in any case) stays as it is."""
        extra = Registry.of(columns)
        seen = {s.name.lower() for s in self.known}
        fresh = tuple(s for s in extra.known if s.name.lower() not in seen)
        return Registry(self.known + fresh, self.allowed | {s.name for s in fresh})

    def restricted(self, header: Iterable[str] | None) -> Registry:
        """Whitelist by an export's header; without one, everything is allowed."""
        if header is None:
            return Registry(self.known, frozenset(s.name for s in self.known))
        return Registry(self.known, frozenset(h.strip() for h in header))

    def knows(self, name: str) -> bool:
        return any(s.name == name for s in self.known)

    def allows(self, name: str) -> bool:
        return name in self.allowed

    def unique(self) -> list[ColumnSpec]:
        """Known columns without case-only repeats; the first definition wins."""
        first: dict[str, ColumnSpec] = {}
        for spec in self.known:
            first.setdefault(spec.name.lower(), spec)
        return list(first.values())

    def active(self) -> list[ColumnSpec]:
        return sorted((s for s in self.unique() if self.allows(s.name)), key=lambda s: s.name)

    def active_names(self) -> list[str]:
        return [s.name for s in self.active()]

    def spec(self, name: str) -> ColumnSpec:
        return next(s for s in self.known if s.name == name)

    def schema(self) -> T.StructType:
        ddl = {s.name: spark_type(s.kind) for s in self.active()}
        return T.StructType([T.StructField(n, T._parse_datatype_string(t), True) for n, t in ddl.items()])


def approved_overrides(spark: SparkSession, path: str, registry: Registry) -> list[tuple[str, str]]:
    """Approved ``From,To`` pairs of a mapping CSV whose target the whitelist allows.

    The file is configuration that people fill in by hand, so its rows are read
    to the driver. A missing file means no overrides.
    """
    from pyspark.errors import AnalysisException
    from pyspark.sql import functions as F

    try:
        table = spark.read.csv(path, header=True)
    except AnalysisException:
        return []
    rows = (
        table.where(F.lower(F.trim("Decision")).isin(*APPROVAL_WORDS))
        .where((F.col("From") != "") & (F.col("To") != ""))
        .select(F.trim("From").alias("source"), F.trim("To").alias("target"))
        .collect()
    )
    return [(r.source, r.target) for r in rows if registry.allows(r.target)]
