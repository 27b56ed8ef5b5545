"""Header resolution: which incoming headers feed which target column.

Which header feeds which column depends on the header set alone; only "is this
cell blank" depends on the row. So a :class:`HeaderPlan` is worked out once per
distinct header set on the driver (a few hundred strings), and gives one
projection that Spark applies to every row of the files with that header set.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provender.functions.text import clean_cell, is_blank, named, nonblank, nonempty
from provender.registry import (
    DISTRIBUTOR, INCIDENT_DATE, LONG_GLN, LONG_NAME, RECEIVER, SHORT_GLN, SHORT_NAME, Registry,
)

# ---------------------------------------------------------------------------
# Flat or reordered headers and the columns they fill when blank.
FLAT_ALIASES = (
    ("My Location Name", (SHORT_NAME, LONG_NAME)),
    ("My Location GLN", (SHORT_GLN, LONG_GLN)),
    ("Shipment Originator", (DISTRIBUTOR,)),
    ("Incident Date", (INCIDENT_DATE,)),
    ("Location Name", (SHORT_NAME, LONG_NAME)),
    ("Location GLN", (SHORT_GLN, LONG_GLN)),
    (SHORT_NAME, (LONG_NAME,)),
    (SHORT_GLN, (LONG_GLN,)),
    ("distributor (Shipment Originator/Smithfield Plant/Receiver)", (DISTRIBUTOR,)),
)
# Renames applied after token matching.
RENAMES = (
    ("Community", "community (Community/Business Name)"),
    ("Affected Quantity", "quantityAffected (Quantity Affected/Affected Quantity)"),
    ("IMAGE OF SUPPLIER CASE LABEL", "images (Photo of Case Labels & Product/Photos or Documents)"),
    ("Still have the Product?", "Still have the product?"),
    ("Still have the product", "Still have the product?"),
    ("incidentDate (Incident Date/Delivery Date/Date)", INCIDENT_DATE),
    ("distributor (Shipment Originator/Smithfield Plant/Receiver)", RECEIVER),
)
# Sources that keep their own column after feeding another one.
KEPT_SOURCES = ("Affected Quantity", "IMAGE OF SUPPLIER CASE LABEL", INCIDENT_DATE)
# Words for the same token of a bracketed header.
TOKEN_SYNONYMS = {"date of delivery": "delivery date", "date": "delivery date"}
SYNONYM_BASE = "incidentdate"
# Proposed mappings for headers that reach no column.
PROPOSALS = (
    ("plant (Internal Supplier/Plant)", "Producing Plant"),
    ("FSQA Final Review", "FSQA Manager Comments"),
    ("Source of Claim", "Incident Type"),
    ("Is there a complaint related to this claim?", "Customer Complaint Related"),
    ("Claim Amount ($) Requested", "Total Credit Request Amount ($)"),
    ("Claim Reason", "Reason for Request"),
    ("Claim Comments", "Comments"),
    ("Claim Documentation", "Supporting Document"),
    ("Claim Reviewed", "Buyer Final Review"),
    ("Is the related incident linked on the right side of the screen?", "Incident Acknowledged?"),
    ("Buyer Claim Comments", "Buyer Final Review Comments"),
    ("Information Needed", "Review and Action Comments"),
    ("Acknowledge claim and begin processing", "Review and Action Comments"),
    ("Claim Processing/Invoice #", "Invoice Number"),
    ("Claim Final Review", "Buyer Final Review"),
    ("Final Review Comments", "Buyer Final Review Comments"),
    ("Observation", "Incident Details"),
    ("Corrective Action", "Corrective Action Performed"),
    ("Evidence of Correction Action", "Evidence of Correction"),
    ("Incident Category", "Complaint Type"),
    ("Evidence of Non-compliance", "Review and Action Comments"),
    ("Completion Date", "Due Date"),
    ("Evidence of Corrective Action", "Evidence of Correction"),
)
# ---------------------------------------------------------------------------

# Wider projections run without whole-stage code generation by default.
CODEGEN_WIDTH = 100
BRACKETED = re.compile(r" \((?:[^()/]+/)+[^()/]+\)")


@dataclass(frozen=True)
class Feed:
    """What a column holds at some point of the resolution.

    ``value`` is null where the row has nothing; ``live`` is the condition under
    which the header still exists for a row (None: for every row); ``sources``
    are the incoming headers that can reach it.
    """

    value: Column
    live: Column | None = None
    sources: frozenset[str] = frozenset()

    def filled(self, value: Column, by: Feed) -> Feed:
        return Feed(value, None, self.sources | by.sources)


def _nothing() -> Feed:
    return Feed(F.lit(None).cast("string"))


def base_of(header: str) -> str:
    return header.split(" (")[0].strip().lower()


def tokens_of(header: str) -> list[str]:
    inside = header[header.index("(") + 1:]
    return [t.strip().lower() for t in inside.removesuffix(")").split("/")]


class HeaderPlan:
    """The projection from one header set to the registry's active columns."""

    def __init__(
        self,
        headers: Sequence[str],
        registry: Registry,
        overrides: Sequence[tuple[str, str]] = (),
        values: dict[str, Column] | None = None,
        legacy_credit_note: bool = False,
        renames: Sequence[tuple[str, str]] = (),
    ):
        self.registry = registry
        self.legacy_credit_note = legacy_credit_note
        # Exact pairs of a site's own long questions, beside the fixed ones.
        self.renames = (*RENAMES, *renames)
        unique = [h for h in dict.fromkeys(h.strip() for h in headers) if h]
        values = values or {h: named(h) for h in unique}
        self.feeds = {h: Feed(values[h], None, frozenset([h])) for h in unique}
        self._flat_aliases()
        self._same_tokens()
        self._closest_tokens()
        for source, target in overrides:
            self._override(source, target)
        self._credit_note()
        self._same_tokens()
        self._renames()
        self._distributors()
        self._locations()

    # -- steps ------------------------------------------------------------

    def _flat_aliases(self) -> None:
        for source, targets in FLAT_ALIASES:
            if source not in self.feeds:
                continue
            feed = self.feeds[source]
            for target in targets:
                old = self.feeds.get(target, _nothing())
                self.feeds[target] = old.filled(
                    F.coalesce(nonblank(old.value), nonblank(feed.value), old.value), feed)
            if source not in KEPT_SOURCES:
                blank = is_blank(feed.value)
                self.feeds[source] = Feed(F.when(blank, feed.value), blank, frozenset())

    def _same_tokens(self) -> None:
        """A bracketed header with a known column's tokens in any order is that column."""
        targets = [s.name for s in self.registry.unique()
                   if BRACKETED.search(s.name) and self.registry.allows(s.name)]
        bags = [(t, self._bag(t, True)) for t in targets]
        for header in [h for h in self.feeds if BRACKETED.search(h) and not self.registry.knows(h)]:
            bag = self._bag(header, True)
            target = next((t for t, b in bags if b == bag), None)
            if target is None:
                continue
            feed = self.feeds.pop(header)
            if feed.live is None:
                self.feeds[target] = Feed(feed.value, None, feed.sources)
            else:
                old = self.feeds.get(target, _nothing())
                self.feeds[target] = old.filled(F.when(feed.live, feed.value).otherwise(old.value), feed)

    def _closest_tokens(self) -> None:
        """Same base name: equal tokens, else smallest superset, else most in common."""
        groups: dict[str, list[str]] = {}
        for name in self.registry.active_names():
            if self._ends_bracketed(name):
                groups.setdefault(base_of(name), []).append(name)
        for header in [h for h in self.feeds if self._ends_bracketed(h) and not self.registry.knows(h)]:
            base = base_of(header)
            target = self._closest(header, groups.get(base, []))
            if target is None:
                continue
            feed = self.feeds.pop(header)
            extra: tuple[str, ...] = ()
            if base == "distributor":
                extra = (RECEIVER,)
            elif base == "location":
                gln = "gln" in header[header.index("("):].lower()
                extra = (LONG_GLN, SHORT_GLN) if gln else (LONG_NAME, SHORT_NAME)
            for name in (target, *extra):
                self._fill_null(name, feed, nonempty(feed.value))

    def _closest(self, header: str, candidates: list[str]) -> str | None:
        wanted = self._bag(header, base_of(header) == SYNONYM_BASE)

        def rank(name: str) -> tuple:
            have = self._bag(name, base_of(header) == SYNONYM_BASE)
            shared = len(set(wanted) & set(have))
            if have == wanted:
                return (3, 0)
            if set(wanted) <= set(have):
                return (2, wanted.total() - have.total())
            return (1, shared) if shared else (0, 0)

        best = max(candidates, key=rank, default=None)
        return best if best is not None and rank(best)[0] else None

    def _override(self, source: str, target: str) -> None:
        if source not in self.feeds:
            return
        feed = self.feeds[source]
        self._fill_null(target, feed, nonempty(feed.value))
        if source not in KEPT_SOURCES:
            spent = nonempty(feed.value).isNotNull()
            self.feeds[source] = Feed(F.when(~spent, feed.value), ~spent, frozenset())

    def _credit_note(self) -> None:
        if "CREDIT NOTE" in self.feeds:
            self.feeds["Credit Note"] = self.feeds.pop("CREDIT NOTE")
        note = self.feeds.get("Credit Note", _nothing())
        target = "Credit note to supplier"
        if target not in self.feeds or (self.legacy_credit_note and "DC Pick Label" not in self.feeds):
            self.feeds[target] = note
        elif self.feeds[target].live is not None:
            old = self.feeds[target]
            self.feeds[target] = old.filled(F.when(old.live, old.value).otherwise(note.value), note)

    def _renames(self) -> None:
        for source, target in self.renames:
            if source in self.feeds and self.registry.allows(target):
                self._fill_null(target, self.feeds[source])
                if source not in KEPT_SOURCES:
                    self.feeds.pop(source)

    def _distributors(self) -> None:
        for header in [h for h in self.feeds if h.startswith("distributor (")]:
            if header != RECEIVER:
                self._fill_null(RECEIVER, self.feeds[header])

    def _locations(self) -> None:
        allows = self.registry.allows
        if SHORT_NAME in self.feeds and allows(LONG_NAME):
            short, old = self.feeds[SHORT_NAME], self.feeds.get(LONG_NAME, _nothing())
            self.feeds[LONG_NAME] = old.filled(F.coalesce(nonblank(short.value), old.value), short)
        if LONG_NAME in self.feeds:
            self._fill_null(SHORT_NAME, self.feeds[LONG_NAME])
        if SHORT_GLN in self.feeds:
            self._fill_null(LONG_GLN, self.feeds[SHORT_GLN])
        if LONG_GLN in self.feeds:
            self._fill_null(SHORT_GLN, self.feeds[LONG_GLN])

    # -- helpers ----------------------------------------------------------

    def _fill_null(self, target: str, feed: Feed, value: Column | None = None) -> None:
        """Fill a column where it has no value; an empty text counts as a value."""
        if not self.registry.allows(target):
            return
        value = feed.value if value is None else value
        old = self.feeds.get(target)
        self.feeds[target] = (
            Feed(value, None, feed.sources) if old is None
            else old.filled(F.coalesce(old.value, value), feed)
        )

    @staticmethod
    def _ends_bracketed(name: str) -> bool:
        found = list(BRACKETED.finditer(name))
        return bool(found) and found[-1].end() == len(name)

    @staticmethod
    def _bag(header: str, synonyms: bool) -> Counter:
        words = tokens_of(header)
        return Counter(TOKEN_SYNONYMS.get(w, w) if synonyms else w for w in words)

    # -- results ----------------------------------------------------------

    def columns(self) -> list[Column]:
        """One text column per active registry column."""
        out = []
        for name in self.registry.active_names():
            feed = self.feeds.get(name)
            out.append((feed.value if feed else F.lit(None)).cast("string").alias(name))
        return out

    def project(self, df: DataFrame) -> DataFrame:
        return df.select(*self.columns())


def lineage(headers: Sequence[str], registry: Registry, overrides: Sequence[tuple[str, str]] = ()) -> list[tuple[str, str]]:
    """(header, target) pairs: the columns each header reaches when it stands alone."""
    pairs = []
    active = set(registry.active_names())
    for header in dict.fromkeys(h.strip() for h in headers if h.strip()):
        feeds = HeaderPlan([header], registry, overrides).feeds
        pairs += [(header, name) for name in sorted(active & feeds.keys()) if header in feeds[name].sources]
    return pairs


def positional(df: DataFrame, headers: Sequence[str]) -> DataFrame:
    """Name the positional columns of a file by its header row.

    Repeated headers give one column with the first non-empty value; blank
    headers are dropped; ``GTIN`` is null if all copies are empty. Up to the
    width Spark generates code for, each column is cleaned on its own; wider
    rows are cleaned in one array expression, which then costs less.
    """
    meta = [named(c) for c in df.columns if c.startswith("_meta_")]
    raw = [named(c) for c in df.columns if not c.startswith("_meta_")]
    if len(raw) <= CODEGEN_WIDTH:
        cells = df.select(*meta, *[clean_cell(c).alias(f"_cell{i}") for i, c in enumerate(raw)])
        at_place = [F.col(f"_cell{i}") for i in range(len(raw))]
    else:
        cells = df.select(*meta, F.transform(F.array(*raw), clean_cell).alias("cells"))
        at_place = [F.get("cells", F.lit(i)) for i in range(len(raw))]
    places: dict[str, list[int]] = {}
    for i, header in enumerate(headers):
        if header and header.strip():
            places.setdefault(header.strip(), []).append(i)
    out = list(meta)
    for header, at in places.items():
        cell = [at_place[i] for i in at]
        if len(at) == 1 and header != "GTIN":
            out.append(cell[0].alias(header))
            continue
        found = F.coalesce(*[nonempty(c) for c in cell])
        out.append((found if header == "GTIN" else F.coalesce(found, cell[0])).alias(header))
    return cells.select(*out)


def union_by_header_set(parts: Sequence[tuple[Sequence[str], DataFrame]], registry: Registry,
                        overrides: Sequence[tuple[str, str]] = (), renames: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Resolve each group of files by its own header set, then put them together.

    ``renames`` are exact pairs of names that apply after all rules, beside the fixed ones.
    """
    resolved = [HeaderPlan(headers, registry, overrides, renames=renames).project(df) for headers, df in parts]
    return reduce(lambda a, b: a.unionByName(b), resolved)


def cell_counts(df: DataFrame, file: Column, headers: Sequence[str]) -> DataFrame:
    """Rows and filled cells per (file, header) of files that share a header set.

    All headers are counted side by side in one aggregate; only the counts are
    turned into rows.
    """
    counted = df.groupBy(file.alias("file")).agg(
        F.count("*").alias("n_rows"), *[F.count(nonblank(named(h))).alias(f"_n{i}") for i, h in enumerate(headers)])
    rows = F.array(*[F.struct(F.lit(h).alias("header"), F.col(f"_n{i}").alias("n_filled")) for i, h in enumerate(headers)])
    return counted.select("file", "n_rows", F.inline(rows))


def mapping_usage(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows and filled cells per (file, header, target) over a landed corpus.

    ``counts`` is the union of :func:`cell_counts`; ``pairs`` is the lineage
    (``header``, ``target``), at most the registry's size.
    """
    return counts.join(F.broadcast(pairs), "header", "left").select("file", "header", "target", "n_rows", "n_filled")


def mapping_table(usage: DataFrame) -> DataFrame:
    """Per header: targets joined by `` | ``, rows and filled cells over all files."""
    per_header = usage.groupBy("file", "header").agg(
        F.first("n_rows").alias("n_rows"), F.first("n_filled").alias("n_filled"),
        F.collect_set("target").alias("targets"))
    return per_header.groupBy("header").agg(
        F.array_join(F.array_sort(F.first("targets")), " | ").alias("targets"),
        F.sum("n_rows").alias("n_rows"), F.sum("n_filled").alias("n_filled"))


def unmapped_headers(usage: DataFrame) -> DataFrame:
    """Headers that reach no column, per file."""
    return usage.where(F.col("target").isNull()).select("file", "header", "n_filled").distinct()


def unfed_columns(usage: DataFrame, registry_rows: DataFrame) -> DataFrame:
    """Registry columns (``target``, ``kind``, ``required``) no file feeds."""
    fed = usage.where(F.col("target").isNotNull()).select("target").distinct()
    return registry_rows.join(fed, "target", "left_anti")


def proposed_mappings(headers: DataFrame, proposals: DataFrame, targets: DataFrame) -> DataFrame:
    """Proposals whose header is present and whose target the whitelist has."""
    present = headers.select(F.col("header").alias("source")).distinct()
    return proposals.join(present, "source", "left_semi").join(
        F.broadcast(targets.select(F.col("target")).distinct()), "target", "left_semi").select("source", "target")
