"""Declarative quality rules: expectations, quarantine, counts, constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """``action``: warn keeps the row, drop removes it, fail stops the job."""

    name: str
    condition: str
    action: str = "warn"


def holds(condition: str) -> Column:
    """True or false: an unknown condition counts as violated."""
    return F.coalesce(F.expr(condition), F.lit(False))


def expect(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that survive the rules. A failed ``fail`` rule raises when the job runs."""
    for rule in rules:
        if rule.action == "fail":
            stop = F.raise_error(F.lit(f"expectation {rule.name} failed: {rule.condition}")).cast("boolean")
            df = df.filter(F.when(holds(rule.condition), F.lit(True)).otherwise(stop))
        elif rule.action == "drop":
            df = df.filter(holds(rule.condition))
        elif rule.action != "warn":
            raise ValueError(f"unknown action {rule.action!r}")
    return df


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The exact complement of the kept rows, with the names of the broken rules."""
    broken = F.array_compact(F.array(*[F.when(~holds(r.condition), F.lit(r.name)) for r in rules]))
    return df.withColumn("violations", broken).filter(F.size("violations") > 0)


def rules_from_table(rules: DataFrame, tag: str, action: str = "drop", limit: int = 10_000) -> list[Rule]:
    """Rules with a tag, as stored (``tag``, ``name``, ``constraint``). Metadata, bounded by ``limit``."""
    found = rules.filter(F.col("tag") == tag).select("name", "constraint").orderBy("name").limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} rules for tag {tag!r}")
    return [Rule(r.name, r.constraint, action) for r in found]


def expectation_metrics(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """passed, failed, dropped and output counts per rule: one aggregate for all rules."""
    keep = F.lit(True)
    for r in rules:
        if r.action == "drop":
            keep = keep & holds(r.condition)
    counted = df.agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(keep).alias("_kept"),
        *[F.count_if(holds(r.condition)).alias(f"_p{i}") for i, r in enumerate(rules)],
    )
    lines = [
        F.struct(
            F.lit(dataset).alias("dataset"), F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
            F.col(f"_p{i}").alias("passed"), (F.col("_n") - F.col(f"_p{i}")).alias("failed"),
            (F.col("_n") - F.col(f"_p{i}") if r.action == "drop" else F.lit(0).cast("long")).alias("dropped"),
            F.col("_kept").alias("output_rows"),
        )
        for i, r in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*lines)))


def build_event_log(metrics: DataFrame, update_id: Column, when: Column) -> DataFrame:
    """One log row per dataset and update, with the rule counts as nested JSON."""
    item = F.struct(
        F.col("rule").alias("name"), "dataset",
        F.col("passed").alias("passed_records"), F.col("failed").alias("failed_records"),
    )
    per = metrics.withColumns({"_u": update_id, "_t": when}).groupBy("_u", "_t", "dataset").agg(
        F.array_sort(F.collect_list(item)).alias("expectations"), F.sum("dropped").alias("dropped_records"),
        F.max("output_rows").alias("num_output_rows"),
    )
    details = F.to_json(F.struct(F.struct(
        F.lit("COMPLETED").alias("status"),
        F.struct("num_output_rows").alias("metrics"),
        F.struct("dropped_records", "expectations").alias("data_quality"),
    ).alias("flow_progress")))
    return per.select(
        F.col("_u").alias("id"), F.col("_t").alias("timestamp"), F.lit("flow_progress").alias("event_type"),
        F.struct(F.col("_u").alias("update_id"), F.col("dataset").alias("flow_name")).alias("origin"),
        details.alias("details"),
    )


def event_log_expectations(log: DataFrame) -> DataFrame:
    """The nested log opened to one row per update, dataset and rule."""
    tree = log.filter("event_type = 'flow_progress'").select(
        "id", "timestamp", "origin", F.try_parse_json("details").alias("_d")
    )
    shape = "array<struct<name string, dataset string, passed_records bigint, failed_records bigint>>"
    return tree.select(
        F.col("origin.update_id").alias("update_id"), "timestamp",
        F.try_variant_get("_d", "$.flow_progress.status", "string").alias("status"),
        F.try_variant_get("_d", "$.flow_progress.metrics.num_output_rows", "bigint").alias("output_records"),
        F.try_variant_get("_d", "$.flow_progress.data_quality.dropped_records", "bigint").alias("dropped_records"),
        F.explode(F.try_variant_get("_d", "$.flow_progress.data_quality.expectations", shape)).alias("_e"),
    ).select("update_id", "timestamp", "status", "output_records", "dropped_records", "_e.*")


def event_log_report(log: DataFrame) -> DataFrame:
    """Passed and failed records and failure rate per day, table and rule."""
    flat = event_log_expectations(log)
    return flat.groupBy(
        F.col("timestamp").cast("date").alias("day"),
        F.split_part("dataset", F.lit("."), F.lit(-1)).alias("table_name"),
        F.col("name").alias("rule"),
    ).agg(
        F.sum("passed_records").alias("passed"), F.sum("failed_records").alias("failed"),
        F.try_divide(F.sum("failed_records").cast("double"), F.sum(F.col("passed_records") + F.col("failed_records"))).alias("failure_rate"),
    )


def lineage_counts(edges: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """Inputs and outputs per table from lineage edges (source, target)."""
    distinct = edges.select(source, target).distinct()
    down = distinct.groupBy(F.col(source).alias("table_name")).agg(F.count(F.lit(1)).alias("outputs"))
    up = distinct.groupBy(F.col(target).alias("table_name")).agg(F.count(F.lit(1)).alias("inputs"))
    return down.join(up, "table_name", "outer").fillna(0, ["inputs", "outputs"])


def table_tests(df: DataFrame, checks: Mapping[str, tuple[str, object]], fail: bool = False) -> DataFrame:
    """Assertions on one-row aggregates: name -> (aggregate SQL, expected value).

    All aggregates run in one pass. With ``fail`` a wrong result stops the job.
    """
    one = df.agg(*[F.expr(sql).cast("string").alias(f"_c{i}") for i, (sql, _) in enumerate(checks.values())])
    lines = []
    for i, (name, (_, wanted)) in enumerate(checks.items()):
        found = F.col(f"_c{i}")
        ok = found.eqNullSafe(F.lit(str(wanted)))
        if fail:
            ok = F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(f"table test {name} failed")).cast("boolean"))
        lines.append(F.struct(F.lit(name).alias("test"), F.lit(str(wanted)).alias("expected"), found.alias("found"), ok.alias("passed")))
    return one.select(F.inline(F.array(*lines)))


def unique_key_test(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count_if(F.col("n") > 1).alias("repeated_keys")
    )


def check_constraints(
    df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = (),
    checks: Mapping[str, str] | None = None, foreign: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Violations per constraint. A CHECK is broken only when false; a null passes, as in SQL."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"not_null {c}") for c in not_null]
    aggs += [F.count_if(~F.coalesce(F.expr(e), F.lit(True))).alias(f"check {n}") for n, e in (checks or {}).items()]
    parts: list[DataFrame] = []
    if aggs:
        one = df.agg(*aggs)
        parts.append(one.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("violations")) for c in one.columns]))))
    for keys in unique:
        repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        parts.append(repeated.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit("unique " + ",".join(keys)).alias("name"), "violations"))
    for column, (parent, key) in (foreign or {}).items():
        orphans = df.filter(F.col(column).isNotNull()).select(column).join(
            parent.select(F.col(key).alias(column)), column, "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(f"foreign {column}").alias("name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
