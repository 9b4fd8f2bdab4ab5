"""Change data, quality, monitoring and governance as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks as B
from ..operators import changes as H
from ..operators import governance as G
from ..operators import monitor as M
from ..operators import quality as Q
from ..session import scratch_path
from .catalog import query
from .core_queries import r

DAY = B.DAY
Rule = Q.Rule

# A change log derived from orders: the customer is the key, each order one change.
_LOG = """SELECT o_custkey AS id, o_orderkey AS seq, o_orderdate AS changed, o_orderpriority AS priority, o_totalprice AS amount,
    CASE WHEN o_orderkey % 17 = 0 THEN 'DELETE' ELSE 'UPDATE' END AS operation FROM orders"""


def _log(t):
    return t.orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("seq"), F.col("o_orderdate").alias("changed"),
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderkey") % 17 == 0, "DELETE").otherwise("UPDATE").alias("operation"))


@query("apply_changes_scd1", f"""
    SELECT id, priority, amount FROM ({_LOG}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1 AND operation <> 'DELETE'""")
def _(t):
    log = _log(t)
    args = dict(keys=["id"], sequence_by="seq", delete_when="operation = 'DELETE'", except_columns=["operation", "changed"])
    # two loads, the second with older rows: the stored sequence decides
    state = H.apply_changes_scd1(None, log.filter("seq % 3 > 0"), **args)
    return H.live_rows(H.apply_changes_scd1(state, log.filter("seq % 3 = 0"), **args))


@query("apply_changes_ignore_nulls", f"""
    WITH c AS (SELECT *, max(CASE WHEN operation = 'DELETE' THEN seq END) OVER (PARTITION BY id) AS gone,
        CASE WHEN seq % 4 > 0 THEN amount END AS part FROM ({_LOG}))
    SELECT id, max_by(priority, seq) AS priority, max_by(part, seq) FILTER (part IS NOT NULL) AS part
    FROM c WHERE gone IS NULL OR seq > gone GROUP BY id""")
def _(t):
    log = _log(t).withColumn("part", F.when(F.col("seq") % 4 > 0, F.col("amount")))
    return H.live_rows(H.apply_changes_scd1(
        None, log, ["id"], "seq", "operation = 'DELETE'", ["operation", "changed", "amount"], ignore_null_updates=True))


_SCD2 = f"""
    SELECT id, priority, changed AS __START_AT, nxt AS __END_AT FROM (
      SELECT *, lead(changed) OVER (PARTITION BY id ORDER BY changed) AS nxt FROM (
        SELECT *, lag(state) OVER (PARTITION BY id ORDER BY changed) AS prev FROM (
          SELECT id, changed, priority, operation, CASE WHEN operation = 'DELETE' THEN 'gone' ELSE 'row ' || priority END AS state
          FROM ({_LOG}) QUALIFY row_number() OVER (PARTITION BY id, changed ORDER BY seq DESC) = 1))
      WHERE prev IS NULL OR prev <> state) WHERE operation <> 'DELETE'"""
_SCD2_ARGS = dict(keys=["id"], sequence_by="changed", delete_when="operation = 'DELETE'",
                  except_columns=["operation", "seq", "amount"], tie="seq")


def _along():
    return B.epoch_micros("changed")


@query("apply_changes_scd2", _SCD2)
def _(t):
    return H.apply_changes_scd2(_log(t), along=_along(), **_SCD2_ARGS)


@query("update_scd2", _SCD2)
def _(t):
    log = _log(t)
    old, new = log.filter("seq % 5 > 0"), log.filter("seq % 5 = 0")
    history = H.apply_changes_scd2(old, along=_along(), **_SCD2_ARGS)
    rest = {k: v for k, v in _SCD2_ARGS.items() if k not in ("keys", "sequence_by")}
    return H.update_scd2(history, log, new, ["id"], "changed", _along(), **rest)


@query("as_of", f"""
    SELECT id, priority FROM ({_SCD2}) WHERE __START_AT <= TIMESTAMP '1998-06-01' AND (__END_AT IS NULL OR __END_AT > TIMESTAMP '1998-06-01')""")
def _(t):
    return H.as_of(H.apply_changes_scd2(_log(t), along=_along(), **_SCD2_ARGS), "1998-06-01")


@query("merge_upsert", """
    WITH tgt AS (SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status FROM orders WHERE o_orderkey % 4 > 0),
    src AS (SELECT o_orderkey AS id, round(o_totalprice * 2, 2) AS price, o_orderpriority AS priority, o_orderkey % 10 = 0 AS del
            FROM orders WHERE o_orderkey % 4 <> 1)
    SELECT coalesce(s.id, t.id) AS id, coalesce(s.price, t.price) AS price, CASE WHEN t.id IS NULL THEN 'new' ELSE t.status END AS status,
      s.priority FROM tgt t FULL JOIN src s ON t.id = s.id WHERE NOT coalesce(s.del, false)""")
def _(t):
    k = F.col("o_orderkey")
    tgt = t.orders.filter(k % 4 > 0).select(k.alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    src = t.orders.filter(k % 4 != 1).select(
        k.alias("id"), F.round(F.col("o_totalprice") * 2, 2).alias("price"), F.col("o_orderpriority").alias("priority"),
        (k % 10 == 0).alias("del"))
    return H.merge_upsert(
        tgt, src, ["id"], {"price": "s.price", "priority": "s.priority"},
        {"price": "s.price", "status": "'new'", "priority": "s.priority"}, "s.del").drop("del")


@query("update_delete", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE o_orderstatus END AS o_orderstatus,
      CASE WHEN o_orderstatus = 'P' THEN round(o_totalprice + 1, 2) ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE NOT o_custkey % 10 = 3""")
def _(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    o = H.update_where(o, "o_orderstatus = 'P'", {"o_orderstatus": "'pending'", "o_totalprice": "round(o_totalprice + 1, 2)"})
    return H.delete_where(o, "o_custkey % 10 = 3").drop("o_custkey")


_BEFORE = "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderkey % 5 > 0"
_AFTER = "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 6 > 0"


def _snapshots(t):
    o = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    after = o.filter("id % 6 > 0").withColumn("status", F.when(F.col("id") % 7 == 0, "X").otherwise(F.col("status")))
    return o.filter("id % 5 > 0"), after


@query("change_feed", f"""
    WITH b AS ({_BEFORE}), a AS ({_AFTER})
    SELECT a.id, a.status, 'insert' AS _change_type FROM a LEFT JOIN b USING (id) WHERE b.status IS NULL
    UNION ALL SELECT b.id, b.status, 'delete' FROM b LEFT JOIN a USING (id) WHERE a.status IS NULL
    UNION ALL SELECT b.id, b.status, 'update_preimage' FROM b JOIN a USING (id) WHERE a.status <> b.status
    UNION ALL SELECT a.id, a.status, 'update_postimage' FROM b JOIN a USING (id) WHERE a.status <> b.status""")
def _(t):
    return H.change_feed(*_snapshots(t), ["id"])


@query("consume_feed", f"SELECT id, replace(status, 'X', 'x') AS status FROM ({_AFTER})")
def _(t):
    before, after = _snapshots(t)
    feed = H.change_feed(before, after, ["id"], version=1)
    return H.consume_feed(feed, before, ["id"], {"status": ("X", "x")})


@query("compact", "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS amount, true AS fewer_files FROM orders")
def _(t):
    many, few = scratch_path(t.spark, "many"), scratch_path(t.spark, "few")
    t.orders.repartition(24).write.parquet(many)
    files = H.compact(t.spark, many, few, 64)
    out = t.spark.read.parquet(few)
    return out.agg(F.count(F.lit(1)).alias("n"), r(F.sum("o_totalprice"), 2).alias("amount"), F.lit(files < 24).alias("fewer_files"))


@query("cluster_table", "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem")
def _(t):
    return H.cluster_table(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"), ["l_partkey", "l_shipdate"], 8)


# ---- quality --------------------------------------------------------------

_RULES = [
    Rule("positive_quantity", "l_quantity > 5", "drop"),
    Rule("known_flag", "l_returnflag IN ('A', 'N', 'R')", "fail"),
    Rule("small_discount", "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount <= 0.08 END", "drop"),
    Rule("low_tax", "l_tax < 0.08", "warn"),
]
_P = ["l_quantity > 5", "l_returnflag IN ('A', 'N', 'R')",
      "coalesce(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount <= 0.08 END, false)", "l_tax < 0.08"]
_KEEP = f"{_P[0]} AND {_P[2]}"


@query("expect", f"SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE {_KEEP}")
def _(t):
    return Q.expect(t.lineitem, _RULES).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("quarantine", f"""
    SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN NOT {_P[0]} THEN 'positive_quantity' END,
      CASE WHEN NOT {_P[2]} THEN 'small_discount' END) AS violations FROM lineitem WHERE NOT ({_KEEP})""")
def _(t):
    bad = Q.quarantine(t.lineitem, [x for x in _RULES if x.action == "drop"])
    return bad.select("l_orderkey", "l_linenumber", F.array_join("violations", ",").alias("violations"))


@query("rules_from_table", f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE {_KEEP}")
def _(t):
    stored = t.spark.createDataFrame(
        [("lines", x.name, x.condition) for x in _RULES if x.action == "drop"] + [("other", "never", "false")],
        "tag string, name string, constraint string")
    return Q.expect(t.lineitem, Q.rules_from_table(stored, "lines")).select("l_orderkey", "l_linenumber")


@query("expectation_metrics", " UNION ALL ".join(f"""
    SELECT 'lineitem' AS dataset, '{x.name}' AS rule, '{x.action}' AS action, count(*) FILTER ({p}) AS passed,
      count(*) - count(*) FILTER ({p}) AS failed, {'count(*) - count(*) FILTER (' + p + ')' if x.action == 'drop' else '0'} AS dropped,
      count(*) FILTER ({_KEEP}) AS output_rows FROM lineitem""" for x, p in zip(_RULES, _P)))
def _(t):
    return Q.expectation_metrics(t.lineitem, _RULES, "lineitem")


@query("event_log_report", """
    SELECT CAST(ts AS DATE) AS day, event_type AS table_name, 'big_value' AS rule, count(*) FILTER (value > 50) AS passed,
      count(*) FILTER (value <= 50) AS failed, round(count(*) FILTER (value <= 50) / count(*)::DOUBLE, 6) AS failure_rate
    FROM events GROUP BY 1, 2""", dates=("day",))
def _(t):
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    counts = t.events.groupBy(hour.alias("at"), F.concat(F.lit("prod.app."), "event_type").alias("dataset")).agg(
        F.count_if(F.col("value") > 50).alias("passed"), F.count_if(F.col("value") <= 50).alias("failed"),
        F.count(F.lit(1)).alias("output_rows"))
    counts = counts.withColumns({"rule": F.lit("big_value"), "dropped": F.col("failed")})
    log = Q.build_event_log(counts, F.date_format("at", "yyyyMMddHH"), F.col("at"))
    return Q.event_log_report(log).withColumn("failure_rate", r("failure_rate"))


@query("lineage_counts", """
    WITH e AS (SELECT DISTINCT 'u' || user_id AS s, event_type AS d FROM events)
    SELECT s AS table_name, 0 AS inputs, count(*) AS outputs FROM e GROUP BY 1 UNION ALL SELECT d, count(*), 0 FROM e GROUP BY 1""")
def _(t):
    return Q.lineage_counts(t.events.select(F.concat(F.lit("u"), "user_id").alias("source"), F.col("event_type").alias("target")))


@query("table_tests", """
    SELECT 'rows' AS test, CAST(count(*) AS VARCHAR) AS found, true AS passed FROM customer
    UNION ALL SELECT 'no_null_id', CAST(count(*) FILTER (c_custkey IS NULL) AS VARCHAR), true FROM customer
    UNION ALL SELECT 'no_clear_email', CAST(count(*) FILTER (c_name LIKE '%@%') AS VARCHAR), true FROM customer
    UNION ALL SELECT 'no_debt', CAST(count(*) FILTER (c_acctbal < 0) AS VARCHAR), count(*) FILTER (c_acctbal < 0) = 0 FROM customer
    UNION ALL SELECT 'repeated_keys', CAST(count(*) AS VARCHAR), count(*) = 0 FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)""")
def _(t):
    n = t.customer.count()
    out = Q.table_tests(t.customer, {
        "rows": ("count(*)", n), "no_null_id": ("count_if(c_custkey IS NULL)", 0),
        "no_clear_email": ("count_if(c_name LIKE '%@%')", 0), "no_debt": ("count_if(c_acctbal < 0)", 0)})
    unique = Q.unique_key_test(t.customer, ["c_custkey"])
    more = Q.table_tests(unique, {"repeated_keys": ("max(repeated_keys)", 0)})
    return out.unionByName(more).select("test", "found", "passed")


@query("check_constraints", """
    SELECT 'not_null o_custkey' AS name, count(*) FILTER (o_custkey IS NULL) AS violations FROM orders
    UNION ALL SELECT 'check price', count(*) FILTER (NOT o_totalprice > 1000) FROM orders
    UNION ALL SELECT 'unique o_custkey,o_orderdate', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)
    UNION ALL SELECT 'foreign o_custkey', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 > 0)""")
def _(t):
    return Q.check_constraints(t.orders, ["o_custkey"], [["o_custkey", "o_orderdate"]], {"price": "o_totalprice > 1000"},
                               {"o_custkey": (t.customer.filter("c_custkey % 9 > 0"), "c_custkey")})


# ---- monitoring -----------------------------------------------------------

_PROF = """
    SELECT '{g}' AS granularity, date_trunc('{g}', ts) AS window_start, {sk} AS slice_key, {sv} AS slice_value, '{c}' AS column_name,
      count({c}) AS n, count(*) FILTER ({c} IS NULL) AS nulls, count(*) FILTER ({c} = 0) AS zeros, CAST(min({c}) AS DOUBLE) AS "min",
      CAST(max({c}) AS DOUBLE) AS "max", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
      CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median FROM events GROUP BY 1, 2, 3, 4"""
_PROF_TABLE = """
    SELECT '{g}', date_trunc('{g}', ts), {sk}, {sv}, ':table', count(*), 0, 0, NULL, NULL, NULL, NULL, NULL FROM events GROUP BY 1, 2, 3, 4"""


@query("profile_metrics", " UNION ALL ".join(
    _PROF.format(g=g, c=c, sk=sk, sv=sv) for g in ("day", "week") for c in ("value", "user_id")
    for sk, sv in (("'-'", "'-'"), ("'event_type'", "event_type"))) + "".join(
    " UNION ALL " + _PROF_TABLE.format(g=g, sk=sk, sv=sv) for g in ("day", "week")
    for sk, sv in (("'-'", "'-'"), ("'event_type'", "event_type"))))
def _(t):
    out = M.profile_metrics(t.events, "ts", ["day", "week"], ["value", "user_id"], ["event_type"])
    return out.fillna("-", ["slice_key", "slice_value"]).select(
        "granularity", "window_start", "slice_key", "slice_value", "column_name", "n", "nulls", "zeros", "min", "max",
        r("mean").alias("mean"), r("stddev").alias("stddev"), F.get("quantiles", F.lit(0)).alias("median"))


@query("frequent_items", """
    SELECT window_start, item, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, item) AS rank FROM (
      SELECT date_trunc('week', ts) AS window_start, CAST(user_id AS VARCHAR) AS item, count(*) AS n FROM events GROUP BY 1, 2)) WHERE rank <= 5""")
def _(t):
    return M.frequent_items(t.events, "ts", "week", "user_id", 5).withColumn("rank", F.col("rank").cast("bigint"))


_BOUNDS = [10.0, 20.0, 40.0, 80.0, 160.0]
_BIN = "CASE " + " ".join(f"WHEN value < {b} THEN {i}" for i, b in enumerate(_BOUNDS)) + f" ELSE {len(_BOUNDS)} END"
_DRIFT = f"""
    WITH c AS (SELECT date_trunc('week', ts) AS w, {{bin}} AS bin, count(*) AS n FROM events GROUP BY 1, 2),
    d AS (SELECT w, bin, n, n / sum(n) OVER (PARTITION BY w)::DOUBLE AS share, sum(n) OVER (PARTITION BY w) AS total FROM c),
    ws AS (SELECT w, total, lag(w) OVER (ORDER BY w) AS base FROM (SELECT DISTINCT w, total FROM d)),
    grid AS (SELECT ws.w, ws.total, ws.base, b.bin FROM ws, (SELECT DISTINCT bin FROM d) b WHERE base IS NOT NULL),
    pq AS (SELECT g.w, g.total, g.bin, coalesce(a.share, 0) AS p, coalesce(b.share, 0) AS q FROM grid g
       LEFT JOIN d a ON a.w = g.w AND a.bin = g.bin LEFT JOIN d b ON b.w = g.base AND b.bin = g.bin),
    cum AS (SELECT *, sum(p) OVER (PARTITION BY w ORDER BY bin) AS cp, sum(q) OVER (PARTITION BY w ORDER BY bin) AS cq,
       greatest(p, 1e-4) AS pf, greatest(q, 1e-4) AS qf FROM pq WHERE p > 0 OR q > 0)
    SELECT w AS window_start, 'CONSECUTIVE' AS drift_type, round(sum(abs(p - q)) / 2, 6) AS tv_distance, round(max(abs(p - q)), 6) AS l_infinity_distance,
      round(sqrt(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END / 2 + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END / 2)), 6) AS js_distance,
      round(sum(CASE WHEN q > 0 THEN (p - q) * (p - q) / q END) * max(total), 4) AS chi_square,
      round(sum((pf - qf) * ln(pf / qf)), 6) AS population_stability_index, round(max(abs(cp - cq)), 6) AS ks_distance
    FROM cum GROUP BY w"""


def _rounded_drift(d):
    return d.select("window_start", "drift_type", *[r(c).alias(c) for c in (
        "tv_distance", "l_infinity_distance", "js_distance", "population_stability_index", "ks_distance")], r("chi_square", 4).alias("chi_square"))


@query("drift_metrics_numeric", _DRIFT.replace("{bin}", _BIN))
def _(t):
    return _rounded_drift(M.drift_metrics(M.distributions(t.events, F.date_trunc("week", "ts"), M.number_bins("value", _BOUNDS))))


@query("drift_metrics_categorical", _DRIFT.replace("{bin}", "event_type"))
def _(t):
    return _rounded_drift(M.drift_metrics(M.distributions(t.events, F.date_trunc("week", "ts"), F.col("event_type"))))


@query("drift_metrics_baseline", """
    WITH base AS (SELECT event_type AS bin, count(*) / (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-02')::DOUBLE AS q
                  FROM events WHERE CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM events) GROUP BY 1),
    c AS (SELECT date_trunc('week', ts) AS w, event_type AS bin, count(*) AS n FROM events GROUP BY 1, 2),
    d AS (SELECT w, bin, n / sum(n) OVER (PARTITION BY w)::DOUBLE AS p FROM c)
    SELECT w AS window_start, 'BASELINE' AS drift_type, round(sum(abs(p - q)) / 2, 6) AS tv_distance FROM d JOIN base USING (bin) GROUP BY 1""")
def _(t):
    first = M.distributions(M.baseline_view(t.events, "ts"), F.lit(0), F.col("event_type")).select("bin", "share")
    dist = M.distributions(t.events, F.date_trunc("week", "ts"), F.col("event_type"))
    return M.drift_metrics(dist, first).select("window_start", "drift_type", r("tv_distance").alias("tv_distance"))


@query("custom_metrics", """
    WITH m AS (SELECT date_trunc('year', l_shipdate) AS window_start, l_returnflag AS slice, 'l_quantity' AS column_name,
        sum(l_quantity * l_extendedprice) / sum(l_extendedprice) AS weighted_mean, max(l_quantity) AS top FROM lineitem GROUP BY 1, 2
      UNION ALL SELECT date_trunc('year', l_shipdate), l_returnflag, 'l_discount', sum(l_discount * l_extendedprice) / sum(l_extendedprice), max(l_discount)
      FROM lineitem GROUP BY 1, 2)
    SELECT window_start, slice, column_name, round(weighted_mean, 6) AS weighted_mean, round(top / weighted_mean, 6) AS headroom,
      round(weighted_mean - lag(weighted_mean) OVER (PARTITION BY slice, column_name ORDER BY window_start), 6) AS moved FROM m""")
def _(t):
    out = M.custom_metrics(
        t.lineitem, {"window_start": F.date_trunc("year", "l_shipdate"), "slice": F.col("l_returnflag")}, ["l_quantity", "l_discount"],
        {"weighted_mean": "sum({{input_column}} * {{weight}}) / sum({{weight}})", "top": "max({{input_column}})"},
        {"headroom": "top / weighted_mean"}, {"moved": "current.weighted_mean - base.weighted_mean"}, {"weight": "l_extendedprice"})
    return out.select("window_start", "slice", "column_name", *[r(c).alias(c) for c in ("weighted_mean", "headroom", "moved")])


@query("inference_quality_regression", """
    SELECT year(o_orderdate) AS yr, count(*) AS n, round(avg((o_totalprice - p) ^ 2) / 1e6, 4) AS mse, round(avg(abs(o_totalprice - p)), 4) AS mae,
      round(1 - sum((o_totalprice - p) ^ 2) / (var_pop(o_totalprice) * count(*)), 6) AS r2
    FROM (SELECT *, 1000.0 * (o_custkey % 300) AS p FROM orders) GROUP BY 1""")
def _(t):
    o = t.orders.withColumn("p", 1000.0 * (F.col("o_custkey") % 300))
    q = M.regression_quality(o, {"yr": F.year("o_orderdate").cast("bigint")}, "o_totalprice", "p")
    return q.select("yr", "n", r(F.col("mse") / 1e6, 4).alias("mse"), r("mae", 4).alias("mae"), r("r2").alias("r2"))


@query("inference_quality_classes", """
    WITH x AS (SELECT user_id % 3 AS model, event_type AS y, CASE WHEN event_id % 4 = 0 THEN 'view' ELSE event_type END AS p FROM events),
    cls AS (SELECT model, c, count(*) FILTER (y = c) AS support, count(*) FILTER (p = c) AS predicted, count(*) FILTER (y = c AND p = c) AS hit
            FROM x, (SELECT DISTINCT event_type AS c FROM events) GROUP BY 1, 2),
    m AS (SELECT *, coalesce(hit / nullif(predicted, 0)::DOUBLE, 0) AS pr, coalesce(hit / nullif(support, 0)::DOUBLE, 0) AS re FROM cls)
    SELECT model, CAST(sum(support) AS BIGINT) AS n, round(sum(hit) / sum(support)::DOUBLE, 6) AS accuracy, round(sum(pr * support) / sum(support), 6) AS weighted_precision,
      round(sum(re * support) / sum(support), 6) AS weighted_recall, round(avg(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END), 6) AS macro_f1 FROM m GROUP BY 1""")
def _(t):
    x = t.events.withColumn("p", F.when(F.col("event_id") % 4 == 0, "view").otherwise(F.col("event_type")))
    q = M.classification_quality(x, {"model": F.col("user_id") % 3}, "event_type", "p")
    return q.select("model", "n", *[r(c).alias(c) for c in ("accuracy", "weighted_precision", "weighted_recall", "macro_f1")])


@query("baseline_view", "SELECT event_id FROM events WHERE CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM events)")
def _(t):
    return M.baseline_view(t.events, "ts").select("event_id")


@query("violations", """
    WITH p AS (SELECT date_trunc('day', ts) AS window_start, avg(value) AS mean, count(*) AS n,
        count(*) FILTER (event_type = 'error') / count(*)::DOUBLE AS error_share FROM events GROUP BY 1)
    SELECT window_start, CAST(mean < 48 AS INTEGER) + CAST(n > 340 AS INTEGER) AS performance_violations,
      CAST(error_share > 0.2 AS INTEGER) AS drift_violations,
      CAST(mean < 48 AS INTEGER) + CAST(n > 340 AS INTEGER) + CAST(error_share > 0.2 AS INTEGER) > 1 AS retrain FROM p""")
def _(t):
    per = t.events.groupBy(F.date_trunc("day", "ts").alias("window_start")).agg(
        F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"),
        F.avg((F.col("event_type") == "error").cast("double")).alias("error_share"))
    long = per.unpivot("window_start", ["error_share"], "metric", "value")
    return M.violations(per.drop("error_share"), long, {"mean": ("min", 48.0), "n": ("max", 340)}, {"error_share": 0.2}, allowed=1)


@query("freshness_checks", """
    WITH k AS (SELECT date_trunc('day', ts) AS window_start, CASE WHEN event_id % 40 > 0 THEN event_id // 2 END AS id FROM events)
    SELECT window_start, CAST(sum(c) AS BIGINT) AS n, CAST(coalesce(sum(c) FILTER (id IS NULL), 0) AS BIGINT) AS null_ids,
      count(*) FILTER (id IS NOT NULL AND c > 1) AS repeated_ids FROM (SELECT window_start, id, count(*) AS c FROM k GROUP BY 1, 2) GROUP BY 1""")
def _(t):
    k = t.events.select("ts", F.when(F.col("event_id") % 40 > 0, F.floor(F.col("event_id") / 2)).alias("id"))
    return M.freshness_checks(k, "ts", "id")


# ---- governance -----------------------------------------------------------

@query("mask_columns", """
    SELECT c_custkey, '****' AS c_name, regexp_replace(regexp_replace(regexp_replace(c_mktsegment, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_mktsegment
    FROM customer""")
def _(t):
    return G.mask_columns(t.customer.select("c_custkey", "c_name", "c_mktsegment"), {"c_name": "full", "c_mktsegment": "chars"}, ["analysts"], "hr")


@query("mask_prefix", """
    SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN substr(s_name, 1, 4) || '****' ELSE s_name END AS s_name FROM supplier""")
def _(t):
    return G.mask_columns(t.supplier, {"s_name": "prefix"}, [], "hr", when="s_acctbal > 0").select("s_suppkey", "s_name")


@query("filter_rows", "SELECT c_custkey FROM customer WHERE c_name LIKE '%7' OR lower(c_mktsegment) IN ('building')")
def _(t):
    return G.filter_rows(t.customer, ["segment-building", "staff"], rule="c_name LIKE '%7'", group_prefix="segment-",
                         column="c_mktsegment").select("c_custkey")


@query("filter_rows_by_mapping", """
    SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name IN ('EUROPE', 'ASIA')""")
def _(t):
    # one group per region, listing its nations
    mapping = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy(
        F.col("r_name").alias("identity_group")).agg(F.collect_list("n_nationkey").alias("countries"))
    return G.filter_rows_by_mapping(t.customer, mapping, ["EUROPE", "ASIA"], "c_nationkey").select("c_custkey")


@query("permission_view", """
    SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey % 2 = 1 THEN sha1(c_name) ELSE c_name END AS c_name FROM customer
    WHERE c_nationkey % 5 = 2""")
def _(t):
    perms = t.nation.select(
        F.concat(F.lit("user"), F.col("n_nationkey") % 5).alias("user_name"), F.col("n_nationkey").alias("country_filter"),
        (F.col("n_nationkey") % 2).alias("gdpr_filter"))
    return G.permission_view(t.customer.select("c_custkey", "c_nationkey", "c_name"), perms, "user2", "c_nationkey", ["c_name"])


@query("share_slice", "SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7")
def _(t):
    return G.share_slice(t.customer, {"c_mktsegment": "BUILDING", "c_nationkey": "7"}).select("c_custkey", "c_acctbal")


def audit_log(t):
    """Events read as an audit log: nested identity, request map with null entries, response."""
    e = t.events
    return e.select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(F.col("event_type").isin("signup", "purchase"), "accounts").otherwise("catalog").alias("service_name"),
        F.when(F.col("event_type") == "error", "deleteTable").when(F.col("event_type") == "signup", "updatePermissions")
        .otherwise("getTable").alias("action_name"),
        F.concat(F.lit("user"), "user_id").alias("user_name"),
        F.create_map(F.lit("full_name"), F.concat(F.lit("t"), F.col("event_id") % 50),
                     F.lit("changes"), F.when(F.col("event_type") == "signup", F.col("props"))).alias("request_params"),
        F.struct(F.when(F.col("value") > 90, 403).otherwise(200).alias("status_code")).alias("response"))


_AUDIT = """audit AS (SELECT ts, CASE WHEN event_type IN ('signup', 'purchase') THEN 'accounts' ELSE 'catalog' END AS service_name,
    CASE event_type WHEN 'error' THEN 'deleteTable' WHEN 'signup' THEN 'updatePermissions' ELSE 'getTable' END AS action_name,
    'user' || user_id AS user_name, 't' || (event_id % 50) AS object_name, event_type, props, value FROM events)"""


@query("split_services", f"""
    WITH {_AUDIT} SELECT service_name, CAST(ts AS DATE) AS event_date, count(*) AS n,
      CAST(sum(CASE WHEN event_type = 'signup' THEN 2 ELSE 1 END) AS BIGINT) AS params FROM audit GROUP BY 1, 2""", dates=("event_date",))
def _(t):
    return G.split_services(audit_log(t)).groupBy("service_name", "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("request_params")).alias("params"))


@query("audit_actions", f"WITH {_AUDIT} SELECT service_name, action_name, count(*) AS n, count(DISTINCT user_name) AS users FROM audit GROUP BY 1, 2")
def _(t):
    return G.action_counts(G.split_services(audit_log(t)))


@query("audit_top_users", f"WITH {_AUDIT} SELECT sha1(user_name) AS user_name, n FROM (SELECT user_name, count(*) AS n FROM audit GROUP BY 1 ORDER BY n DESC, user_name LIMIT 10)")
def _(t):
    return G.top_users(G.split_services(audit_log(t)).select("user_name"), 10, hashed=False).select(
        F.sha1("user_name").alias("user_name"), "n")


@query("audit_denied", f"WITH {_AUDIT} SELECT CAST(ts AS DATE) AS day, user_name, count(*) AS n FROM audit WHERE value > 90 GROUP BY 1, 2", dates=("day",))
def _(t):
    return G.denied_actions(G.split_services(audit_log(t)))


@query("audit_deletes", f"WITH {_AUDIT} SELECT service_name, object_name, count(*) AS n FROM audit WHERE action_name = 'deleteTable' GROUP BY 1, 2")
def _(t):
    return G.deletes_by_scope(G.split_services(audit_log(t))).drop("last_seen")


@query("audit_permissions", f"WITH {_AUDIT} SELECT user_name, object_name, props AS changes FROM audit WHERE action_name = 'updatePermissions'")
def _(t):
    return G.permission_changes(G.split_services(audit_log(t))).drop("event_time")


@query("entity_current", """
    WITH l AS (SELECT user_id AS entity, event_id, ts, CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'edit' END AS action,
      CASE WHEN event_id % 3 > 0 THEN props END AS props FROM events)
    SELECT entity, arg_max(props, struct_pack(ts, event_id)) FILTER (props IS NOT NULL) AS props, min(ts) FILTER (action = 'create') AS created_at,
      arg_max(action, struct_pack(ts, event_id)) AS last_action, max(ts) AS changed_at,
      count(*) FILTER (action = 'create') > 0 AS is_created, arg_max(action, struct_pack(ts, event_id)) = 'delete' AS is_deleted FROM l GROUP BY 1""")
def _(t):
    kind = F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "error", "delete").otherwise("edit")
    log = t.events.select(F.col("user_id").alias("entity"), "event_id", "ts", kind.alias("action"),
                          F.when(F.col("event_id") % 3 > 0, F.col("props")).alias("props"))
    return G.entity_current(log, "entity", "ts", "event_id", ["create"], ["delete"], attributes=["props"])
