"""Data-level access: masks, row filters, shared slices, audit reports.

Who asks is always an argument (``user``, ``groups``); nothing reads the session.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask_value(column: str, style: str = "full", keep: int = 4) -> Column:
    """``full`` text mask, ``chars`` (letters and digits replaced), ``prefix`` (first ``keep`` shown),
    ``hash`` or ``null``."""
    c = F.col(column).cast("string")
    if style == "full":
        return F.lit("****")
    if style == "chars":
        return F.mask(c)
    if style == "prefix":
        return F.concat(F.substring(c, 1, keep), F.lit("****"))
    if style == "hash":
        return F.sha1(c)
    if style == "null":
        return F.lit(None).cast("string")
    raise ValueError(f"unknown mask style {style!r}")


def mask_columns(df: DataFrame, styles: Mapping[str, str], groups: Sequence[str], allowed: str | Sequence[str], when: str | None = None) -> DataFrame:
    """Columns masked for readers outside the ``allowed`` groups (only rows ``when`` holds, if given)."""
    allowed = {allowed} if isinstance(allowed, str) else set(allowed)
    if allowed & set(groups):
        return df
    hit = F.coalesce(F.expr(when), F.lit(False)) if when else F.lit(True)
    return df.withColumns({
        c: F.when(hit, mask_value(c, style)).otherwise(F.col(c).cast("string")) for c, style in styles.items()
    })


def filter_rows(df: DataFrame, groups: Sequence[str], admin: str = "admin", rule: str | None = None,
                group_prefix: str | None = None, column: str | None = None) -> DataFrame:
    """Admins see all. Others see rows matching ``rule`` and rows whose ``column``
    names one of their groups (``group_prefix`` + value)."""
    if admin in groups:
        return df
    seen = F.expr(rule) if rule else F.lit(False)
    if column is not None:
        mine = [g[len(group_prefix or ""):].lower() for g in groups if g.startswith(group_prefix or "")]
        seen = seen | F.lower(F.col(column)).isin(mine)
    return df.filter(F.coalesce(seen, F.lit(False)))


def filter_rows_by_mapping(df: DataFrame, mapping: DataFrame, groups: Sequence[str], column: str,
                           group_column: str = "identity_group", values_column: str = "countries") -> DataFrame:
    """Rows whose value is listed for one of the reader's groups (group -> array of values)."""
    allowed = mapping.filter(F.col(group_column).isin(list(groups))).select(F.explode(values_column).alias(column)).distinct()
    return df.join(allowed, column, "left_semi")


def permission_view(df: DataFrame, permissions: DataFrame, user: str, column: str, sensitive: Sequence[str],
                    admin: bool = False) -> DataFrame:
    """Rows a permission table (user_name, country_filter, gdpr_filter) gives a user; PII hashed per flag."""
    if admin:
        return df
    mine = permissions.filter(F.col("user_name") == user).select(
        F.col("country_filter").alias(column), F.col("gdpr_filter").alias("_hide")
    ).groupBy(column).agg(F.max("_hide").alias("_hide"))
    seen = df.join(mine, column)
    hidden = {c: F.when(F.col("_hide") == 1, F.sha1(F.col(c).cast("string"))).otherwise(F.col(c).cast("string")) for c in sensitive}
    return seen.withColumns(hidden).drop("_hide").select(*df.columns)


def share_slice(df: DataFrame, properties: Mapping[str, str]) -> DataFrame:
    """Rows visible to one recipient: every property column equals its value."""
    for column, value in properties.items():
        df = df.filter(F.col(column).cast("string") == F.lit(value))
    return df


def split_services(bronze: DataFrame) -> DataFrame:
    """Audit rows with typed time and cleaned request map (one silver table, partitioned by service).

    ``timestamp`` is in milliseconds; null map entries are removed.
    """
    return bronze.withColumns({
        "event_time": F.timestamp_millis(F.col("timestamp")),
        "event_date": F.timestamp_millis(F.col("timestamp")).cast("date"),
        "request_params": F.map_filter("request_params", lambda _, v: v.isNotNull()),
    }).drop("timestamp")


def action_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("service_name", "action_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_name").alias("users"))


def top_users(df: DataFrame, k: int = 10, hashed: bool = False) -> DataFrame:
    """Most active users, names hashed on request."""
    name = F.sha1("user_name") if hashed else F.col("user_name")
    return df.groupBy("user_name").agg(F.count(F.lit(1)).alias("n")).select(name.alias("user_name"), "n").orderBy(
        F.desc("n"), "user_name").limit(k)


def denied_actions(df: DataFrame, codes: Sequence[int] = (401, 403)) -> DataFrame:
    """Refused requests per day and user."""
    return df.filter(F.col("response.status_code").isin(list(codes))).groupBy(
        F.col("event_time").cast("date").alias("day"), "user_name").agg(F.count(F.lit(1)).alias("n"))


def deletes_by_scope(df: DataFrame) -> DataFrame:
    """Delete actions per service and named object."""
    return df.filter(F.lower("action_name").like("%delete%")).groupBy(
        "service_name", F.try_element_at("request_params", F.lit("full_name")).alias("object_name")
    ).agg(F.count(F.lit(1)).alias("n"), F.max("event_time").alias("last_seen"))


def permission_changes(df: DataFrame) -> DataFrame:
    """Permission updates with the object and the change text."""
    return df.filter(F.lower("action_name").like("%permission%")).select(
        "event_time", "user_name", F.try_element_at("request_params", F.lit("full_name")).alias("object_name"),
        F.try_element_at("request_params", F.lit("changes")).alias("changes"))


def entity_current(log: DataFrame, entity: str, event_time: str, order: str, create: Sequence[str], delete: Sequence[str],
                   action: str = "action", attributes: Sequence[str] = ()) -> DataFrame:
    """Current state of every object from its create/edit/delete log, one aggregate."""
    rank = F.struct(event_time, order)
    return log.groupBy(entity).agg(
        *[F.max_by(a, F.when(F.col(a).isNotNull(), rank)).alias(a) for a in attributes],
        F.min(F.when(F.col(action).isin(list(create)), F.col(event_time))).alias("created_at"),
        F.max_by(F.col(action), rank).alias("last_action"),
        F.max(event_time).alias("changed_at"),
    ).withColumns({
        "is_created": F.col("created_at").isNotNull(),
        "is_deleted": F.col("last_action").isin(list(delete)),
    })
