"""Projection, cleaning and reshaping: everything here stays inside one stage
unless the docstring says otherwise."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .blocks import as_column


def clean_entities(df: DataFrame, spec: Mapping[str, str], keep: Sequence[str] | None = None) -> DataFrame:
    """Output column -> ``"rule source [argument]"``.

    Rules: ``copy``, ``sha1``, ``title``, ``timestamp`` (argument: format,
    unparsable gives null), ``cast`` (argument: type, failures give null).
    """
    out = [F.col(c) for c in keep or []]
    for name, text in spec.items():
        rule, source, *arg = text.split(" ", 2)
        col = F.col(source)
        if rule == "copy":
            value = col
        elif rule == "sha1":
            value = F.sha1(col.cast("string"))
        elif rule == "title":
            value = F.initcap(F.lower(col))
        elif rule == "timestamp":
            value = F.try_to_timestamp(col.cast("string"), F.lit(arg[0]))
        elif rule == "cast":
            value = col.try_cast(arg[0])
        else:
            raise ValueError(f"unknown rule {rule!r}")
        out.append(value.alias(name))
    return df.select(*out)


def drop_technical(df: DataFrame, columns: Iterable[str], expand: Sequence[str] = ()) -> DataFrame:
    """All columns but some; structs named in ``expand`` are opened in place."""
    gone = set(columns)
    picked: list[Column] = []
    for field in df.schema:
        if field.name in gone:
            continue
        if field.name in expand:
            picked += [
                F.col(f"`{field.name}`").getField(sub.name).alias(sub.name)
                for sub in field.dataType.fields
                if sub.name not in gone
            ]
        else:
            picked.append(F.col(f"`{field.name}`"))
    return df.select(*picked)


def snake_case(name: str) -> str:
    name = re.sub(r"[^0-9A-Za-z]+", "_", name.strip())
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return name.strip("_").lower()


def rename_columns(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Rename by map, or every column to snake_case when no map is given."""
    if names is None:
        names = {c: snake_case(c) for c in df.columns}
    return df.withColumnsRenamed(dict(names))


def flatten_struct(df: DataFrame, separator: str = "_") -> DataFrame:
    """One level of struct columns becomes ``parent_child`` columns."""
    out = []
    for field in df.schema:
        if isinstance(field.dataType, T.StructType):
            out += [
                F.col(f"`{field.name}`").getField(sub.name).alias(f"{field.name}{separator}{sub.name}")
                for sub in field.dataType.fields
            ]
        else:
            out.append(F.col(f"`{field.name}`"))
    return df.select(*out)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None, valid: Sequence[str] = ()) -> DataFrame:
    """Rows with no null in ``columns`` on which every ``valid`` predicate is true."""
    out = df.dropna(subset=list(columns) if columns is not None else None)
    for predicate in valid:
        out = out.filter(F.expr(predicate))
    return out


def safe_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def fill_missing(df: DataFrame, constants: Mapping[str, object] | None = None, blank_to_zero: Sequence[str] = ()) -> DataFrame:
    """Nulls to constants; blank text to 0 with the rest read as double."""
    out = df.fillna(dict(constants)) if constants else df
    return out.withColumns(
        {c: F.when(F.trim(c) == "", F.lit(0.0)).otherwise(F.col(c).try_cast("double")) for c in blank_to_zero}
    ) if blank_to_zero else out


def parse_json_column(
    df: DataFrame, column: str, schema: str | None = None,
    paths: Mapping[str, tuple[str, str]] | None = None, out: str = "parsed",
) -> DataFrame:
    """JSON text to a typed struct or map (``schema``) and/or single values by
    path: name -> (``$.path``, type). Paths go through one VARIANT parse."""
    if schema is not None:
        df = df.withColumn(out, F.from_json(column, schema))
    if paths:
        tree = F.try_parse_json(F.col(column))
        df = df.withColumn("_tree", tree)
        df = df.withColumns(
            {n: F.try_variant_get("_tree", p, t) for n, (p, t) in paths.items()}
        ).drop("_tree")
    return df


def clean_map(df: DataFrame, column: str) -> DataFrame:
    """Map entries with a null value removed."""
    return df.withColumn(column, F.map_filter(column, lambda _, v: v.isNotNull()))


def explode_list(df: DataFrame, column: str, out: str, position: str | None = None) -> DataFrame:
    """One row per list element; empty and null lists give no row."""
    rest = [F.col(c) for c in df.columns if c != column]
    if position:
        return df.select(*rest, F.posexplode(column).alias(position, out))
    return df.select(*rest, F.explode(column).alias(out))


def bucketize(df: DataFrame, out: str, cases: Sequence[tuple[str, object]], otherwise: object = None) -> DataFrame:
    """First matching (predicate, label) wins."""
    value = None
    for predicate, label in cases:
        value = F.when(F.expr(predicate), F.lit(label)) if value is None else value.when(F.expr(predicate), F.lit(label))
    return df.withColumn(out, value.otherwise(F.lit(otherwise)))


def apply_rules(df: DataFrame, rules: DataFrame, order: str = "rule_id", limit: int = 10_000) -> DataFrame:
    """Each active rule row (``check_name``, ``check_code``) becomes a column.

    Rules run in ``order`` and may use columns of earlier rules. The rule table
    is metadata: reading more than ``limit`` active rules is refused.
    """
    active = (
        rules.filter("is_active").orderBy(order).select("check_name", "check_code").limit(limit + 1).collect()
    )
    if len(active) > limit:
        raise ValueError(f"more than {limit} active rules")
    for rule in active:
        df = df.withColumn(rule.check_name, F.expr(rule.check_code))
    return df


def extract_regex(df: DataFrame, column: str, outputs: Mapping[str, tuple[str, int]]) -> DataFrame:
    return df.withColumns({n: F.regexp_extract(column, p, g) for n, (p, g) in outputs.items()})


def replace_regex(df: DataFrame, replacements: Mapping[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({c: F.regexp_replace(c, p, r) for c, (p, r) in replacements.items()})


def dedup(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One (arbitrary) row per key; see ``latest_per_key`` for a chosen one."""
    return df.dropDuplicates(list(keys) if keys else None)


def tag_columns(df: DataFrame, meta: Mapping[str, dict]) -> DataFrame:
    for column, values in meta.items():
        df = df.withMetadata(column, {**df.schema[column].metadata, **values})
    return df


def time_features(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Weekday (Monday 0), day of month, hour, and their sine/cosine pairs
    over periods of 7, 30 and 24."""
    parts = {
        "day_of_week": (F.weekday(ts), 7),
        "day_of_month": (F.dayofmonth(ts), 30),
        "hour": (F.hour(ts), 24),
    }
    out = {}
    for name, (value, period) in parts.items():
        angle = value * F.lit(2.0) * F.pi() / F.lit(float(period))
        out[f"{prefix}{name}"] = value
        out[f"{prefix}{name}_sin"] = F.sin(angle)
        out[f"{prefix}{name}_cos"] = F.cos(angle)
    return df.withColumns(out)


def assemble_vector(df: DataFrame, columns: Sequence[str], out: str, key: Sequence[str] = (), key_out: str = "composite_key") -> DataFrame:
    """Columns into one array of doubles; optional composite text key."""
    df = df.withColumn(out, F.array(*[F.col(c).cast("double") for c in columns]))
    if key:
        df = df.withColumn(key_out, F.concat_ws("-", *[F.col(c).cast("string") for c in key]))
    return df


def one_hot(df: DataFrame, columns: Mapping[str, Sequence[str] | None], limit: int = 1000) -> DataFrame:
    """0/1 bigint column per category, named ``column_category`` in lower case; like names are numbered.

    Categories are taken from the argument, or found by one distinct job and
    refused beyond ``limit``, so the column list is stable and bounded.
    """
    out: dict[str, Column] = {}
    for column, values in columns.items():
        if values is None:
            found = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
            if len(found) > limit:
                raise ValueError(f"{column} has more than {limit} categories")
            values = sorted(r[0] for r in found)
        for v in values:
            plain = name = f"{column}_{re.sub(r'[^0-9a-z]+', '_', str(v).lower())}"
            number = 1
            while name in out or name in df.columns:
                number += 1
                name = f"{plain}_{number}"
            out[name] = F.coalesce((F.col(column) == F.lit(v)).cast("long"), F.lit(0).cast("long"))
    return df.select(*[c for c in df.columns if c not in columns], *[e.alias(n) for n, e in out.items()])


def years_since(column: str | Column, asof: str) -> Column:
    """Age in years of a date at ``asof``."""
    return F.datediff(F.lit(asof).cast("date"), as_column(column)) / F.lit(365.25)


def derive_deltas(df: DataFrame, differences: Mapping[str, tuple[str, str]] | None = None,
                  days_since: Mapping[str, str] | None = None, asof: str | None = None) -> DataFrame:
    """``name -> (a, b)`` gives a - b; ``name -> date`` gives days before ``asof``."""
    out = {n: F.col(a) - F.col(b) for n, (a, b) in (differences or {}).items()}
    out |= {n: F.datediff(F.lit(asof).cast("date"), F.col(c)) for n, c in (days_since or {}).items()}
    return df.withColumns(out)


def surrogate_key(
    df: DataFrame, order_by: Sequence[str], out: str = "id", start: int = 1, step: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Dense ids in the order of ``order_by``, without a one-task sort.

    Rows are range partitioned by sampling (balanced whatever the keys look
    like), written once so that counting and numbering see the same pieces, and
    each piece is numbered from the sum of the counts before it.
    """
    cut = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    cut = materialise(cut.withColumn("_piece", F.spark_partition_id()), "surrogate-key")
    counts = cut.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    # one row per piece: as many rows as partitions
    before = counts.select(
        "_piece",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    inside = F.row_number().over(Window.partitionBy("_piece").orderBy(*order_by))
    return (
        cut.withColumn("_i", inside)
        .join(before, "_piece")
        .withColumn(out, F.lit(start) + (F.col("_before") + F.col("_i") - 1) * F.lit(step))
        .select(*df.columns, out)
    )


def append_with_keys(existing: DataFrame, new: DataFrame, order_by: Sequence[str], out: str = "id") -> DataFrame:
    """New rows numbered after the largest key already stored."""
    last = existing.agg(F.coalesce(F.max(out), F.lit(0)).alias("m")).first().m
    return existing.unionByName(surrogate_key(new, order_by, out, start=last + 1))


def derived_partition(df: DataFrame, ts: str, out: str = "part_day") -> DataFrame:
    """Partition day of a timestamp, to be used with ``partitionBy``."""
    return df.withColumn(out, F.col(ts).cast("date"))


def filter_derived(df: DataFrame, ts: str, low: str | None, high: str | None, part: str = "part_day") -> DataFrame:
    """Range filter on the timestamp that also prunes the derived partition."""
    if low is not None:
        df = df.filter((F.col(ts) >= F.lit(low).cast(df.schema[ts].dataType)) & (F.col(part) >= F.lit(low[:10]).cast("date")))
    if high is not None:
        df = df.filter((F.col(ts) < F.lit(high).cast(df.schema[ts].dataType)) & (F.col(part) <= F.lit(high[:10]).cast("date")))
    return df


def geo_distance(lat1: str | Column, lon1: str | Column, lat2: str | Column, lon2: str | Column) -> Column:
    """Great-circle distance in kilometres (haversine, earth radius 6371 km)."""
    a1, o1, a2, o2 = (F.radians(as_column(c)) for c in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return F.lit(2 * 6371.0) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def count_flags(columns: Sequence[str], yes: str = "Yes") -> Column:
    """How many of the columns equal ``yes``; nulls count as no."""
    total = F.lit(0)
    for c in columns:
        total = total + F.when(F.col(c) == yes, 1).otherwise(0)
    return total


def hash_share(keys: Sequence[str], seed: int = 42) -> Column:
    """A number in [0, 1) fixed by the key and seed, the same under any partitioning."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    # 13 hex digits stay exact in a double
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def split_random(df: DataFrame, weights: Mapping[str, float], keys: Sequence[str], seed: int = 42, out: str = "split") -> DataFrame:
    """Label rows train / validate / test by the hash of their key."""
    total = float(sum(weights.values()))
    share = hash_share(keys, seed)
    edge, value = 0.0, None
    names = list(weights)
    for name in names[:-1]:
        edge += weights[name] / total
        value = F.when(share < edge, name) if value is None else value.when(share < edge, name)
    label = F.lit(names[-1]) if value is None else value.otherwise(names[-1])
    return df.withColumn(out, label)


def split_time(df: DataFrame, ts: str, cutoff: str, out: str = "split") -> DataFrame:
    """``train`` before the cutoff, ``test`` from it on."""
    return df.withColumn(out, F.when(F.col(ts) < F.lit(cutoff).cast(df.schema[ts].dataType), "train").otherwise("test"))


def sample_rows(df: DataFrame, keys: Sequence[str], fraction: float | None = None,
                per_group: int | None = None, groups: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """A share of all rows, or exactly ``per_group`` rows of each group, by key hash."""
    if fraction is not None:
        return df.filter(hash_share(keys, seed) < fraction)
    w = Window.partitionBy(*groups).orderBy(F.col("_share"), *keys)
    return (
        df.withColumn("_share", hash_share(keys, seed))
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= per_group)
        .drop("_share", "_rn")
    )


def rebalance(df: DataFrame, label: str, keys: Sequence[str], minority: object, copies: int, ratio: float, seed: int = 42) -> DataFrame:
    """Minority rows ``copies`` times, majority cut to ``ratio`` times that count."""
    counts = df.agg(
        F.count_if(F.col(label) == minority).alias("few"), F.count_if(F.col(label) != minority).alias("many")
    ).first()
    share = min(1.0, ratio * copies * counts.few / counts.many) if counts.many else 1.0
    few = df.filter(F.col(label) == minority)
    few = few.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")
    many = df.filter(F.col(label) != minority).filter(hash_share(keys, seed) < share)
    return few.unionByName(many)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Class weight n / (classes * n_class) per row; class counts are one row per class."""
    per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totals = per_class.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"))
    weights = per_class.select(
        label,
        (totals.select("n").scalar() / (totals.select("k").scalar() * F.col("_n"))).alias(out),
    )
    return df.join(weights, label)


def melt_counts(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "kind", value: str = "n") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def pandas_frame(df: DataFrame, index: str | None = None):
    """The pandas-style view of a DataFrame, still distributed."""
    return df.pandas_api(index_col=index)


def secure_encode(df: DataFrame, column: str, key: str | Column, when: Column, out: str | None = None, mode: str = "GCM") -> DataFrame:
    """AES + base64 where ``when`` holds, plain text elsewhere.

    GCM draws a fresh nonce per row; ECB gives stable text where that is needed
    for joins or tests.
    """
    secret = F.lit(key) if isinstance(key, str) else key
    text = F.base64(F.aes_encrypt(F.col(column).cast("string"), secret, F.lit(mode)))
    return df.withColumn(out or column, F.when(when, text).otherwise(F.col(column).cast("string")))


def secure_decode(df: DataFrame, column: str, key: str | Column, when: Column, mode: str = "GCM") -> DataFrame:
    secret = F.lit(key) if isinstance(key, str) else key
    plain = F.aes_decrypt(F.unbase64(column), secret, F.lit(mode)).cast("string")
    return df.withColumn(column, F.when(when, plain).otherwise(F.col(column)))


def build_cohort(df: DataFrame, entity: str, code: str, start: str, codes: Sequence[str], cohort_id: int, name: str, stop: str | None = None) -> DataFrame:
    """One row per entity that has any of the codes, with its first and last date."""
    return (
        df.filter(F.col(code).isin(list(codes)))
        .groupBy(entity)
        .agg(F.min(start).alias("cohort_start"), F.max(stop or start).alias("cohort_end"))
        .select(F.lit(cohort_id).alias("cohort_id"), F.lit(name).alias("cohort_name"), entity, "cohort_start", "cohort_end")
    )
