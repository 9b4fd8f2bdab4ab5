"""Joins: equi, range, as-of and code translation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .blocks import epoch_micros, running

MICROS = 1_000_000


def join_using(left: DataFrame, rights: Sequence[DataFrame], key: str | Sequence[str], how: str = "inner") -> DataFrame:
    """A chain of equi joins on one key.

    No broadcast hint: Spark broadcasts a side only below its size threshold
    and splits hot keys of a sort-merge join at run time.
    """
    on = [key] if isinstance(key, str) else list(key)
    for right in rights:
        left = left.join(right, on, how)
    return left


def join_left(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return join_using(left, [right], key, "left")


def join_full(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return join_using(left, [right], key, "outer")


def join_semi(df: DataFrame, keys: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in another set."""
    return join_using(df, [keys], key, "left_semi")


def join_twice(fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str], how: str = "inner") -> DataFrame:
    """The same dimension under several roles: prefix -> fact key column.

    Dimension columns arrive as ``prefix_column``.
    """
    for prefix, fact_key in roles.items():
        renamed = dim.select(*[F.col(c).alias(f"{prefix}_{c}") for c in dim.columns])
        fact = fact.join(renamed, F.col(fact_key) == F.col(f"{prefix}_{dim_key}"), how)
    return fact


def attach_scalars(df: DataFrame, aggregate: DataFrame) -> DataFrame:
    """The columns of a one-row aggregate on every row, as scalar sub-queries.

    Spark runs the aggregate once and inlines the values; it also fails the
    query if more than one row comes back, so nothing unbounded is attached.
    """
    return df.select("*", *[aggregate.select(c).scalar().alias(c) for c in aggregate.columns])


# shorter intervals of a key that may share a bucket of the most frequent level
CROWD = 8


def _level(length: Column) -> Column:
    """Bits of an interval's length, made even: 2**level is above the length and at most four times as much."""
    bits = F.length(F.bin(length))
    return (bits + bits % 2).cast("int")


def _at_level(micros: Column, level: Column) -> Column:
    return F.call_function("shiftright", micros, level)


def _common_levels(intervals: DataFrame, keys: Sequence[str]) -> dict[int, int]:
    """The level that the intervals of each level are joined at, few in all, as every fact is looked for at each.

    Longer intervals go down to the most frequent level while that adds no more
    rows than there are intervals; shorter ones go up to it if they stay few per
    key and bucket there (``CROWD``), so that no fact meets many in vain.
    """
    counts = {r["_level"]: r["count"] for r in intervals.groupBy("_level").count().collect()}  # a row per level, 33 at most
    to = {level: level for level in counts}
    if len(counts) < 2:
        return to
    main = max(counts, key=lambda level: (counts[level], level))
    room = sum(counts.values())
    for level in sorted(level for level in counts if level > main):
        room -= counts[level] * 2 ** (level - main)
        if room < 0:
            break
        to[level] = main
    shorter = intervals.filter(F.col("_level") < main)
    crowd = shorter.groupBy(*keys, _at_level(F.col("_begins"), F.lit(main)).alias("_bucket")).count().agg(F.max("count")).first()[0]
    if crowd is not None and crowd <= CROWD:
        to.update({level: main for level in counts if level < main})
    return to


def join_range(
    facts: DataFrame, intervals: DataFrame, keys: Sequence[str], point: str, start: str, stop: str,
    how: str = "inner", closed: bool = False,
) -> DataFrame:
    """Facts whose ``point`` lies in ``[start, stop)`` (``closed``: ``[start, stop]``).

    Every interval goes to the level of its own length, where buckets are wider
    than it, so it lies in one or two of them, or, where that is cheap, to the level
    of most intervals (``_common_levels``); a fact is looked for in one
    bucket of each level that is left. Minutes and decades can share a table: an
    interval meets only facts within a few times its own length, and a hot key
    is spread over its buckets. Exact bounds are checked afterwards. A null
    ``stop`` is still open, and lasts to the end of the latest interval or
    fact; a null start, point or key matches nothing. With ``how`` = "left" facts without
    an interval are kept (they are stored once, to be told apart).
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown kind of range join {how!r}")
    if how == "left":
        facts = materialise(facts.withColumn("_fact", F.monotonically_increasing_id()), "facts")
    # stored once: their bounds and levels are asked for before they are joined
    right = materialise(intervals.withColumns({"_begins": epoch_micros(start), "_ends": epoch_micros(stop)}), "intervals")
    # facts after every known bound can only be in open intervals: they are looked for right after it
    ceiling = right.agg((F.max(F.greatest("_begins", "_ends")) + 1).alias("c")).scalar()
    right = right.withColumn("_ends", F.coalesce("_ends", ceiling)).filter("_begins <= _ends")
    right = right.withColumn("_level", _level(F.col("_ends") - F.col("_begins")))
    to = _common_levels(right, keys)
    if any(a != b for a, b in to.items()):
        right = right.replace(to, subset=["_level"])
    first, last = (_at_level(F.col(c), F.col("_level")) for c in ("_begins", "_ends"))
    right = right.withColumn("_bucket", F.explode(F.sequence(first, last))).drop("_begins", "_ends")
    left = facts.withColumn("_level", F.explode(F.array(*map(F.lit, sorted(set(to.values())))).cast("array<int>")))
    left = left.withColumn("_bucket", _at_level(F.least(epoch_micros(point), ceiling), F.col("_level")))
    joined = [*keys, "_level", "_bucket"]
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in joined})
    inside = F.col(stop).isNull() | ((F.col(point) <= F.col(stop)) if closed else (F.col(point) < F.col(stop)))
    cond = (F.col(point) >= F.col(start)) & inside
    for k in joined:
        cond = cond & (F.col(k) == F.col(f"_r_{k}"))
    found = left.join(right, cond).drop("_level", "_bucket", *[f"_r_{k}" for k in joined])
    if how == "inner":
        return found
    rest = facts.join(found.select("_fact"), "_fact", "left_anti")
    return found.unionByName(rest, allowMissingColumns=True).drop("_fact")


def join_asof(
    labels: DataFrame, features: DataFrame, keys: Sequence[str], ts: str, feature_ts: str,
    columns: Sequence[str], tie: str | None = None, lookback_seconds: int | None = None,
    direction: str = "backward",
) -> DataFrame:
    """Latest feature row at or before (``forward``: first at or after) each label time.

    Both inputs are stacked and scanned once in time order, hot keys in blocks, so
    neither label x feature pairs nor whole keys meet in one task. ``tie``
    breaks equal feature times (largest wins). Adds ``columns`` and
    ``feature_ts``; all null when nothing qualifies.
    """
    sign = 1 if direction == "backward" else -1
    found = F.struct(F.col(feature_ts).alias("_fts"), *[F.col(c) for c in columns])
    feats = features.select(
        *keys,
        (epoch_micros(feature_ts) * sign).alias("_t"),
        F.lit(0).alias("_kind"),
        (F.col(tie) if tie else F.lit(0)).cast("long").alias("_tie"),
        found.alias("_feat"),
    ).filter(F.col("_t").isNotNull()).dropna(subset=list(keys))  # a null key matches nothing
    rows = labels.select(
        *keys,
        (epoch_micros(ts) * sign).alias("_t"),
        F.lit(1).alias("_kind"),
        F.lit(0).cast("long").alias("_tie"),
        F.struct(*labels.columns).alias("_row"),
    )
    both = rows.unionByName(feats, allowMissingColumns=True)
    seen = running(
        both, keys, [F.col("_t"), F.col("_kind"), F.col("_tie")], F.col("_t"), {"_last": ("last", F.col("_feat"))}
    ).filter("_kind = 1")
    hit = F.col("_last")
    if lookback_seconds is not None:
        age = (F.col("_t") * sign - epoch_micros(F.col("_last._fts"))) * sign
        hit = F.when(age <= lookback_seconds * MICROS, hit)
    seen = seen.withColumn("_hit", hit)
    return seen.select(
        "_row.*", F.col("_hit._fts").alias(feature_ts), *[F.col("_hit").getField(c).alias(c) for c in columns]
    )


def next_end(starts: DataFrame, ends: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """The smallest ``end`` at or after each ``start`` of the same key; rows without one are dropped.

    Same as an inequality join followed by a minimum, without forming the pairs.
    """
    return join_asof(
        starts, ends.select(*keys, end), keys, start, end, [], direction="forward"
    ).filter(F.col(end).isNotNull())


def same_start_spans(df: DataFrame, keys: Sequence[str], start: str, stop: str, row_id: str) -> DataFrame:
    """Rows sharing keys and start taken together: first id, latest stop, pair count.

    A self join on (keys, start) would emit n squared pairs per group; their
    minimum, maximum and number follow from one aggregate.
    """
    return df.groupBy(*keys, start).agg(
        F.min(row_id).alias(row_id),
        F.max(stop).alias(stop),
        (F.count(F.lit(1)) * F.count(F.lit(1))).alias("pairs"),
    )


def map_codes(
    source: DataFrame, concept: DataFrame, relation: DataFrame, code: str,
    source_vocabulary: str, target_domain: str | None = None, missing: int = 0,
) -> DataFrame:
    """Source code -> concept -> standard concept through a "maps to" relation.

    ``concept``: concept_id, concept_code, vocabulary_id, domain_id,
    standard_concept, invalid_reason; ``relation``: concept_id_1, concept_id_2,
    relationship_id, invalid_reason. Codes without a match get ``missing``.
    """
    known = concept.filter(F.col("vocabulary_id") == source_vocabulary).select(
        F.col("concept_code").alias(code), F.col("concept_id").alias("source_concept_id")
    )
    links = relation.filter(
        F.col("invalid_reason").isNull() & (F.lower("relationship_id") == "maps to")
    ).select(F.col("concept_id_1").alias("source_concept_id"), F.col("concept_id_2").alias("target_concept_id"))
    target = concept.filter(F.col("invalid_reason").isNull() & (F.col("standard_concept") == "S"))
    if target_domain:
        target = target.filter(F.col("domain_id") == target_domain)
    target = target.select(F.col("concept_id").alias("target_concept_id"))
    standard = known.join(links, "source_concept_id").join(target, "target_concept_id").select(code, "target_concept_id")
    return (
        source.join(known, code, "left")
        .join(standard, code, "left")
        .withColumns({
            "source_concept_id": F.coalesce("source_concept_id", F.lit(missing)),
            "target_concept_id": F.coalesce("target_concept_id", F.lit(missing)),
        })
    )


def join_files_labels(files: DataFrame, labels: DataFrame, path: str = "path", name: str = "file_name") -> DataFrame:
    """File rows with their label rows, by the last part of the path."""
    return files.withColumn(name, F.substring_index(path, "/", -1)).join(labels, name)
