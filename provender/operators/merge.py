"""Latest version, value-preserving upsert and change detection.

Every per-key step here is an aggregate with a map-side partial step, so a key
that holds a third of all rows is reduced before anything is shuffled. Joins
run on keys that are unique on both sides by then.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provender.functions.text import named, nonempty
from provender.registry import Registry

TEXT, VALUE = "text", "value"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], oldest: bool = False) -> DataFrame:
    """One row per key: the one with the highest (or lowest) order."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if oldest else F.max_by
    best = pick(F.struct(*[named(c) for c in rest]), F.struct(*[named(c) for c in order]))
    return df.groupBy(*[named(k) for k in keys]).agg(best.alias("_best")).select(
        *[named(c) if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*[named(k) for k in keys]).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def fold_updates(source: DataFrame, key: str, order: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """Apply the updates of one key in order, keeping the last value of each column.

    A null never replaces a value, and for text an empty string does not either:
    the outcome of merging the rows one by one, as one aggregate.
    """
    at = F.struct(*[named(c) for c in order])
    def last(name: str) -> Column:
        value = nonempty(named(name)) if kinds[name] == TEXT else named(name)
        return F.max_by(named(name), F.when(value.isNotNull(), at)).alias(name)
    return source.groupBy(named(key)).agg(*[last(c) for c in kinds])


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    kinds: Mapping[str, str],
    required_text: Sequence[str] = (),
    with_outcome: bool = False,
) -> DataFrame:
    """Merge ``source`` (one row per key) into ``target`` without losing values.

    Names are matched without case and come out as ``kinds`` spells them. Matched
    rows take the incoming value where there is one and keep the stored one
    otherwise; unmatched incoming rows are inserted; the rest stay.
    """
    stored = {c.lower(): c for c in target.columns}
    incoming = {c.lower(): c for c in source.columns}
    own_key, new_key = stored[key.lower()], incoming[key.lower()]
    t, s = target.alias("t"), source.alias("s")
    joined = t.join(s, F.col(f"t.`{own_key}`") == F.col(f"s.`{new_key}`"), "full_outer")

    def merged(name: str) -> Column:
        new = F.col(f"s.`{incoming[name.lower()]}`")
        if kinds[name] == TEXT:
            new = nonempty(new)
        old = [F.col(f"t.`{stored[name.lower()]}`")] if name.lower() in stored else []
        default = [F.lit("")] if name in required_text else []
        return F.coalesce(new, *old, *default).alias(name)

    outcome = []
    if with_outcome:
        outcome = [
            F.when(F.col(f"t.`{own_key}`").isNull(), "inserted")
            .when(F.col(f"s.`{new_key}`").isNull(), "kept").otherwise("updated").alias("outcome")
        ]
    known = {key.lower(), *(c.lower() for c in kinds)}
    extra = [c for c in target.columns if c.lower() not in known]
    return joined.select(
        F.coalesce(F.col(f"s.`{new_key}`"), F.col(f"t.`{own_key}`")).alias(key),
        *[merged(c) for c in kinds],
        *[F.col(f"t.`{c}`").alias(c) for c in extra],
        *outcome,
    )


def kinds_of(registry: Registry, key: str) -> dict[str, str]:
    return {s.name: TEXT if s.is_text else VALUE for s in registry.active() if s.name != key}


def merge_incidents(target: DataFrame, source: DataFrame, registry: Registry, key: str, order: Sequence[str]) -> DataFrame:
    """Fold a window of incident rows per key and upsert them into the table."""
    kinds = kinds_of(registry, key)
    folded = fold_updates(source, key, order, kinds)
    required = [s.name for s in registry.active() if s.is_text and not s.nullable and s.name != key]
    return upsert(target, folded, key, kinds, required)


def evolve(table: DataFrame, registry: Registry) -> DataFrame:
    """Add the registry columns a table lacks (compared without case) as null."""
    have = {c.lower() for c in table.columns}
    missing = [f for f in registry.schema() if f.name.lower() not in have]
    return table.select(*[named(c) for c in table.columns],
                        *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def union_evolving(*parts: DataFrame) -> DataFrame:
    """Union of parts with differing columns; absent ones are null."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def content_hash(columns: Sequence[str]) -> Column:
    """Version key of an item: md5 over its typed columns as JSON."""
    return F.md5(F.to_json(F.struct(*[named(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}))


def bytes_key(c: Column) -> Column:
    return F.sha2(c, 256)


def detect_changes(stored: DataFrame, incoming: DataFrame, key: str, compare: Sequence[str], force: bool = False,
                   by_hash: bool = False) -> DataFrame:
    """Incoming items that are new or differ from the stored copy.

    ``change`` is ``added`` or ``changed``; with ``force`` an equal item is
    written too, as ``forced``. Both sides hold one row per key. ``by_hash``
    compares version keys, so a stored row is shuffled as its key and hash only;
    columns that cannot be compared directly (maps) need it too.
    """
    def look() -> Column:
        return content_hash(compare) if by_hash else F.struct(*[named(c) for c in compare])

    s = stored.select(named(key), look().alias("_old"))
    joined = incoming.join(s.withColumn("_seen", F.lit(True)), key, "left")
    new = look()
    change = F.when(F.col("_seen").isNull(), "added").when(~new.eqNullSafe(F.col("_old")), "changed")
    if force:
        change = change.otherwise("forced")
    return joined.withColumn("change", change).where("change is not null").drop("_old", "_seen")


def merge_preview(target: DataFrame, incoming: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """What a merge would do to some text columns: before, incoming, after, change."""
    t = target.select(named(key), *[named(c).alias(f"{c}_before") for c in columns])
    s = incoming.select(named(key), *[named(c).alias(f"{c}_incoming") for c in columns])
    out = s.join(t, key, "left")
    cols = [named(key)]
    for c in columns:
        before = named(f"{c}_before")
        after = F.coalesce(nonempty(named(f"{c}_incoming")), before)
        cols += [F.coalesce(before, F.lit("null")).alias(f"{c}_before"), named(f"{c}_incoming"),
                 after.alias(f"{c}_after"), (~after.eqNullSafe(before)).alias(f"{c}_would_change")]
    return out.select(*cols)


def window_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids that only one of two windows holds, with the side they are on."""
    a = left.select(named(key)).distinct().withColumn("_a", F.lit(1))
    b = right.select(named(key)).distinct().withColumn("_b", F.lit(1))
    return a.join(b, key, "full_outer").where("_a is null or _b is null").select(
        named(key), F.when(F.col("_b").isNull(), "left_only").otherwise("right_only").alias("side"))
