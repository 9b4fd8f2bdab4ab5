"""Aggregates, windows, sorting and set operations as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import blocks as B
from ..operators import windows as W
from .catalog import query
from .core_queries import r

DAY = B.DAY


@query("entity_profile", """
    WITH o AS (SELECT o_custkey AS id, count(*) AS order_count, round(sum(o_totalprice), 2) AS total_amount,
                      max(o_orderdate) AS last_transaction FROM orders GROUP BY 1),
    e AS (SELECT user_id AS id, arg_min(event_type, struct_pack(ts, event_id)) AS first_platform, count(*) AS event_count,
                 count(DISTINCT CAST(ts AS DATE)) AS session_count, max(ts) AS last_event FROM events GROUP BY 1)
    SELECT c_custkey AS id, c_name, order_count, total_amount, last_transaction, first_platform, event_count, session_count,
      last_event, date_diff('day', CAST(last_transaction AS DATE), DATE '2024-02-01') AS days_since_last_transaction,
      date_diff('day', CAST(last_event AS DATE), DATE '2024-02-01') AS days_since_last_event
    FROM customer JOIN o ON o.id = c_custkey JOIN e ON e.id = c_custkey""")
def _(t):
    users = t.customer.select(F.col("c_custkey").alias("id"), "c_name")
    orders = t.orders.withColumn("id", F.col("o_custkey"))
    events = t.events.withColumns({"id": F.col("user_id"), "session": F.col("ts").cast("date")})
    out = A.entity_profile(users, orders, events, "id", "o_orderdate", "o_totalprice", "ts", "event_id",
                           "session", "event_type", "2024-02-01")
    return out.withColumns({
        "total_amount": r("total_amount", 2),
        "days_since_last_transaction": F.col("days_since_last_transaction").cast("bigint"),
        "days_since_last_event": F.col("days_since_last_event").cast("bigint")})


@query("sensor_stats", """
    SELECT event_type, date_trunc('hour', ts) AS window_start, round(avg(value), 9) AS avg_value,
      round(stddev_pop(value), 6) AS std_value, quantile_disc(value, 0.1) AS p10, quantile_disc(value, 0.6) AS p60,
      quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1, 2""")
def _(t):
    s = A.sensor_stats(t.events, ["event_type"], "ts", ["value"])
    p = F.col("percentiles_value")
    return s.select("event_type", "window_start", r("avg_value", 9).alias("avg_value"), r("std_value").alias("std_value"),
                    p[0].alias("p10"), p[2].alias("p60"), p[4].alias("p95"))


@query("trailing_aggregates", """
    WITH m AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders)
    SELECT o_custkey,
      count(*) FILTER (CAST(o_orderdate AS DATE) >= d - INTERVAL 12 MONTH) AS sent_cnt_12m,
      round(sum(o_totalprice) FILTER (CAST(o_orderdate AS DATE) >= d - INTERVAL 12 MONTH), 2) AS sent_amt_12m,
      count(*) FILTER (CAST(o_orderdate AS DATE) >= d - INTERVAL 6 MONTH) AS sent_cnt_6m,
      round(avg(o_totalprice) FILTER (CAST(o_orderdate AS DATE) >= d - INTERVAL 6 MONTH), 6) AS sent_avg_6m,
      count(*) FILTER (CAST(o_orderdate AS DATE) >= d - INTERVAL 3 MONTH) AS sent_cnt_3m,
      count(DISTINCT CASE WHEN CAST(o_orderdate AS DATE) >= d - INTERVAL 3 MONTH THEN o_orderpriority END) AS sent_partners_3m
    FROM orders, m WHERE CAST(o_orderdate AS DATE) >= d - INTERVAL 12 MONTH GROUP BY 1""")
def _(t):
    out = A.trailing_aggregates(t.orders, "o_custkey", "o_orderdate", "o_totalprice", "sent", partner="o_orderpriority")
    return out.select("o_custkey", "sent_cnt_12m", r("sent_amt_12m", 2).alias("sent_amt_12m"), "sent_cnt_6m",
                      r("sent_avg_6m").alias("sent_avg_6m"), "sent_cnt_3m", "sent_partners_3m")


@query("conditional_counts", """
    SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
      count(DISTINCT user_id) FILTER (event_type = 'click') AS clickers,
      round(count(*) FILTER (event_type = 'click') / nullif(count(*) FILTER (event_type = 'view'), 0)::DOUBLE, 6) AS ctr
    FROM events GROUP BY 1""", dates=('day',))
def _(t):
    e = t.events.withColumn("day", F.col("ts").cast("date"))
    out = A.conditional_counts(e, ["day"], {"views": "event_type = 'view'", "clicks": "event_type = 'click'"},
                               {"clickers": ("event_type = 'click'", "user_id")}, {"ctr": ("clicks", "views")})
    return out.withColumn("ctr", r("ctr"))


@query("multi_level_totals", """
    SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'ALL' ELSE l_returnflag END AS l_returnflag,
      CASE WHEN grouping(l_linestatus) = 1 THEN 'ALL' ELSE l_linestatus END AS l_linestatus,
      count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def _(t):
    return A.multi_level_totals(t.lineitem, ["l_returnflag", "l_linestatus"],
                                {"n": F.count(F.lit(1)), "qty": r(F.sum("l_quantity"), 2)})


@query("grand_total", "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS amount FROM orders")
def _(t):
    return A.grand_total(t.orders, {"n": F.count(F.lit(1)), "amount": r(F.sum("o_totalprice"), 2)})


@query("group_all", """
    SELECT year(o_orderdate) AS yr, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY ALL HAVING n > 100""")
def _(t):
    return A.group_all(t.orders, {"yr": F.year("o_orderdate").cast("bigint"), "priority": "o_orderpriority"},
                       {"n": F.count(F.lit(1))}, "n > 100")


@query("collect_values", """
    SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS kinds FROM (SELECT DISTINCT user_id, event_type FROM events)
    GROUP BY 1""")
def _(t):
    return A.collect_values(t.events, ["user_id"], "event_type", "kinds", ",")


@query("pivot_wide", """
    SELECT year(o_orderdate) AS yr, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
      count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def _(t):
    long = t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("yr"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return A.pivot_wide(long, ["yr"], "o_orderstatus", ["F", "O", "P"], "n")


@query("period_kpi", """
    SELECT CAST(date_trunc('week', ts) AS DATE) AS period, event_type, count(*) AS n, round(sum(value), 4) AS total
    FROM events GROUP BY 1, 2""", dates=('period',))
def _(t):
    return A.period_kpi(t.events, "ts", "week", {"n": F.count(F.lit(1)), "total": r(F.sum("value"), 4)}, ["event_type"])


@query("period_change", """
    WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, sum(o_totalprice) AS total FROM orders GROUP BY 1)
    SELECT period, round(total, 2) AS total, round(total - lag(total) OVER (ORDER BY period), 2) AS change,
      round(100.0 * (total - lag(total) OVER (ORDER BY period)) / lag(total) OVER (ORDER BY period), 6) AS change_pct FROM m""", dates=('period',))
def _(t):
    out = A.period_change(t.orders, "o_orderdate", F.sum("o_totalprice"))
    return out.select("period", r("total", 2).alias("total"), r("change", 2).alias("change"), r("change_pct").alias("change_pct"))


@query("ratio_kpi", """
    SELECT l_returnflag, round(count(*) FILTER (l_discount > 0.05) / count(*)::DOUBLE, 4) AS ratio FROM lineitem GROUP BY 1""")
def _(t):
    return A.ratio_kpi(t.lineitem, ["l_returnflag"], F.count_if(F.col("l_discount") > 0.05), F.count(F.lit(1)))


@query("share_of_total", """
    SELECT c_mktsegment, count(*) AS total, round(count(*) / (SELECT count(*) FROM customer)::DOUBLE, 6) AS share
    FROM customer GROUP BY 1""")
def _(t):
    return A.share_of_total(t.customer, ["c_mktsegment"], F.count(F.lit(1))).withColumn("share", r("share"))


@query("pair_flow", """
    SELECT a.n_name AS origin, b.n_name AS destination, least(a.n_name, b.n_name) || '-' || greatest(a.n_name, b.n_name) AS pair,
      count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON s_nationkey = a.n_nationkey
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation b ON c_nationkey = b.n_nationkey
    GROUP BY 1, 2""")
def _(t):
    f = t.lineitem.select("l_suppkey", "l_orderkey").join(
        t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("ok")), "l_suppkey")
    f = f.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")), "l_orderkey")
    f = f.join(t.customer.select("c_custkey", F.col("c_nationkey").alias("dk")), "c_custkey")
    f = f.join(t.nation.select(F.col("n_nationkey").alias("ok"), F.col("n_name").alias("origin")), "ok")
    f = f.join(t.nation.select(F.col("n_nationkey").alias("dk"), F.col("n_name").alias("destination")), "dk")
    return A.pair_flow(f, "origin", "destination", {"n": F.count(F.lit(1))})


@query("histogram", """
    SELECT CAST(floor(l_extendedprice / 5000) * 5000 AS DOUBLE) AS bin, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def _(t):
    return A.histogram(t.lineitem, "l_extendedprice", 5000.0, ["l_returnflag"])


@query("crosstab", """
    SELECT quality, count(*) FILTER (toxic = 0) AS toxic_0, count(*) FILTER (toxic = 1) AS toxic_1 FROM labels GROUP BY 1""")
def _(t):
    return A.crosstab(t.labels, "quality", "toxic", [0, 1])


_MB = """CASE WHEN day({b}) = day({a}) OR ({b} = last_day({b}) AND {a} = last_day({a}))
      THEN CAST((year({a}) - year({b})) * 12 + month({a}) - month({b}) AS DOUBLE)
      ELSE round((year({a}) - year({b})) * 12 + month({a}) - month({b}) + (day({a}) - day({b})) / 31.0, 8) END"""


def _earned(lo, hi):
    a, b = f"least(ends, DATE '{hi}')", f"greatest(begins, DATE '{lo}')"
    return f"sum(premium * ({_MB.format(a=a, b=b)})) FILTER (begins <= DATE '{hi}' AND ends >= DATE '{lo}')"


@query("loss_ratio", f"""
    WITH pol AS (SELECT o_orderpriority AS product, CAST(o_orderdate AS DATE) AS begins,
                        CAST(o_orderdate AS DATE) + CAST(o_orderkey % 700 AS INTEGER) AS ends, o_totalprice / 12 AS premium FROM orders),
    cl AS (SELECT o_orderpriority AS product, CAST(l_shipdate AS DATE) AS claim_date, l_extendedprice AS amount
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'),
    e AS (SELECT product, {_earned('1998-01-01', '1998-12-31')} AS cp, {_earned('1997-01-01', '1997-12-31')} AS pp FROM pol GROUP BY 1),
    c AS (SELECT product, sum(amount) FILTER (claim_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31') AS cc,
                 sum(amount) FILTER (claim_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31') AS pc FROM cl GROUP BY 1)
    SELECT e.product, round(cp, 2) AS current_premium, round(coalesce(cc, 0) / cp, 6) AS current_loss_ratio,
      round(coalesce(pc, 0) / pp, 6) AS prior_loss_ratio FROM e LEFT JOIN c ON e.product = c.product""")
def _(t):
    day = F.col("o_orderdate").cast("date")
    pol = t.orders.select(F.col("o_orderpriority").alias("product"), day.alias("begins"),
                          F.date_add(day, (F.col("o_orderkey") % 700).cast("int")).alias("ends"),
                          (F.col("o_totalprice") / 12).alias("premium"))
    kinds = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("product"))
    cl = t.lineitem.filter("l_returnflag = 'R'").select(
        "l_orderkey", F.col("l_shipdate").cast("date").alias("claim_date"), F.col("l_extendedprice").alias("amount")
    ).join(kinds, "l_orderkey")
    out = A.loss_ratio(pol, cl, "1998-01-01", "1998-12-31", ["product"])
    return out.select("product", r("current_premium", 2).alias("current_premium"),
                      r("current_loss_ratio").alias("current_loss_ratio"), r("prior_loss_ratio").alias("prior_loss_ratio"))


_NEED = "SELECT l_partkey AS item, l_quantity AS need FROM lineitem"
_HAVE = "SELECT p_partkey AS item, p_size * 25.0 AS have FROM part"


def _demand_supply(t):
    return (t.lineitem.select(F.col("l_partkey").alias("item"), F.col("l_quantity").alias("need")),
            t.part.select(F.col("p_partkey").alias("item"), (F.col("p_size") * 25.0).alias("have")))


@query("shortage", f"""
    WITH d AS (SELECT item, sum(need) AS demand FROM ({_NEED}) GROUP BY 1), s AS (SELECT item, sum(have) AS supply FROM ({_HAVE}) GROUP BY 1)
    SELECT item, round(demand, 4) AS demand, round(coalesce(supply, 0), 4) AS supply, round(demand - coalesce(supply, 0), 4) AS short
    FROM d LEFT JOIN s USING (item) WHERE demand - coalesce(supply, 0) > 0""")
def _(t):
    out = A.shortage(*_demand_supply(t), "item", "need", "have")
    return out.select("item", *[r(c, 4).alias(c) for c in ("demand", "supply", "short")])


@query("shortage_fanout", f"""
    SELECT item, round(sum(need), 4) AS demand, round(coalesce(sum(have), 0), 4) AS supply,
      round(sum(need) - coalesce(sum(have), 0), 4) AS short FROM ({_NEED}) LEFT JOIN ({_HAVE}) USING (item) GROUP BY 1
    HAVING sum(need) - coalesce(sum(have), 0) > 0""")
def _(t):
    out = A.shortage(*_demand_supply(t), "item", "need", "have", fanout=True)
    return out.select("item", *[r(c, 4).alias(c) for c in ("demand", "supply", "short")])


@query("duplicates", """
    SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(event_id // 2 AS DOUBLE) END AS id, count(*) AS n FROM events
    GROUP BY 1 HAVING count(*) > 1 OR id IS NULL""")
def _(t):
    ids = t.events.select(F.when(F.col("event_id") % 50 != 0, F.floor(F.col("event_id") / 2).cast("double")).alias("id"))
    return A.duplicates(ids, ["id"])


@query("active_users", """
    SELECT CAST(date_trunc('day', ts) AS DATE) AS period, event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""", dates=('period',))
def _(t):
    return A.active_users(t.events, "user_id", "ts", "day", ["event_type"])


@query("volatility", """
    SELECT user_id, CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER) AS week, round(stddev_samp(value), 6) AS volatility, count(value) AS n
    FROM events GROUP BY 1, 2""", dates=('week',))
def _(t):
    return A.volatility(t.events, ["user_id"], "ts", "value").withColumn("volatility", r("volatility"))


_DESCRIBE = """SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
    min({c}) AS "min", quantile_disc({c}, 0.25) AS p25, quantile_disc({c}, 0.5) AS p50, quantile_disc({c}, 0.75) AS p75, max({c}) AS "max" FROM lineitem"""


@query("describe_table", " UNION ALL ".join(_DESCRIBE.format(c=c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def _(t):
    out = A.describe_table(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.withColumns({"mean": r("mean"), "std": r("std")})


@query("value_counts", "SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def _(t):
    return A.value_counts(t.documents, "lang")


@query("top_n", """
    SELECT o_custkey, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1 ORDER BY amount DESC, o_custkey LIMIT 20""")
def _(t):
    spent = t.orders.groupBy("o_custkey").agg(r(F.sum("o_totalprice"), 2).alias("amount"))
    return A.top_n(spent, [F.desc("amount"), F.asc("o_custkey")], 20)


# ---- windows --------------------------------------------------------------

@query("latest_per_key", """
    SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(t):
    return W.latest_per_key(t.events.select("user_id", "event_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"])


@query("latest_with_ties", """
    SELECT o_custkey, o_orderkey FROM orders QUALIFY dense_rank() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC) = 1""")
def _(t):
    o = t.orders.select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("yr"))
    return W.latest_with_ties(o, ["o_custkey"], "yr").select("o_custkey", "o_orderkey")


@query("gap_label", """
    WITH v AS (SELECT event_id, user_id, ts, ts + to_hours(CAST(event_id % 48 AS INTEGER)) AS stop FROM events)
    SELECT event_id, user_id, CAST(coalesce(ts - lag(stop) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 1 DAY, false) AS INTEGER)
      AS is_repeat FROM v""")
def _(t):
    v = t.events.select("event_id", "user_id", "ts",
                        F.timestamp_add("HOUR", (F.col("event_id") % 48).cast("int"), F.col("ts")).alias("stop"))
    return W.gap_label(v, ["user_id"], "ts", "stop", "event_id", 1).select("event_id", "user_id", "is_repeat")


@query("lead_lag", """
    SELECT event_id, lag(value) OVER w AS before, lead(value) OVER w AS after FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t):
    e = t.events.select("event_id", "user_id", "ts", "value")
    out = W.neighbour_values(e, ["user_id"], ["ts", "event_id"], B.epoch_micros("ts"),
                             {"before": ("value", 1), "after": ("value", -1)})
    return out.select("event_id", "before", "after")


@query("lead_lag_far", """
    SELECT event_id, lag(value, 3) OVER w AS before, lead(value, 2) OVER w AS after FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t):
    e = t.events.select("event_id", "user_id", "ts", "value")
    out = W.neighbour_values(e, ["user_id"], ["ts", "event_id"], B.epoch_micros("ts"),
                             {"before": ("value", 3), "after": ("value", -2)})
    return out.select("event_id", "before", "after")


@query("rolling_range", """
    SELECT event_id, round(sum(value) OVER w, 4) AS value_7d, count(value) OVER w AS events_7d, round(avg(value) OVER w, 6) AS mean_7d
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""")
def _(t):
    e = t.events.select("event_id", "user_id", "ts", "value")
    out = W.rolling_totals(e, ["user_id"], "ts", 7 * DAY, {
        "value_7d": ("sum", "value"), "events_7d": ("count", "value"), "mean_7d": ("avg", "value")})
    return out.select("event_id", r("value_7d", 4).alias("value_7d"), "events_7d", r("mean_7d").alias("mean_7d"))


@query("rolling_days", """
    WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
    SELECT day, n, CAST(sum(n) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS n_7d,
      CAST(sum(n) OVER (ORDER BY day RANGE BETWEEN INTERVAL 27 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS n_28d FROM d""", dates=('day',))
def _(t):
    daily = t.events.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return W.rolling_days(daily, "day", [7, 28], ["n"])


@query("centered_mean", """
    SELECT event_id, round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING), 6)
      AS smooth FROM events""")
def _(t):
    e = t.events.select("event_id", "event_type", "ts", "value")
    out = W.centered_mean(e, ["event_type"], ["ts", "event_id"], B.epoch_micros("ts"), {"smooth": "value"})
    return out.select("event_id", r("smooth").alias("smooth"))


@query("partition_max", "SELECT event_id, max(value) OVER (PARTITION BY event_type) * 1.2 AS cap FROM events")
def _(t):
    return W.partition_max(t.events.select("event_id", "event_type", "value"), ["event_type"], "value", "cap", 1.2).select("event_id", "cap")


@query("back_adjust", """
    WITH f AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, CASE WHEN o_orderkey % 10 = 0 THEN 2.0 ELSE 1.0 END AS f FROM orders)
    SELECT o_orderkey, round(o_totalprice * exp(coalesce(sum(ln(f)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)), 4) AS adjusted FROM f""")
def _(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                        F.when(F.col("o_orderkey") % 10 == 0, 2.0).otherwise(1.0).alias("f"))
    out = W.back_adjust(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], B.epoch_micros("o_orderdate"), "o_totalprice", "f")
    return out.select("o_orderkey", r("adjusted", 4).alias("adjusted"))


@query("top_k_per_group", """
    SELECT month, l_partkey, qty, rank FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY qty DESC, l_partkey) AS rank FROM (
      SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_partkey, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY 1, 2))
    WHERE rank <= 10""", dates=('month',))
def _(t):
    sold = t.lineitem.groupBy(F.date_trunc("month", "l_shipdate").cast("date").alias("month"), "l_partkey").agg(
        r(F.sum("l_quantity"), 2).alias("qty"))
    return W.top_k_per_group(sold, ["month"], [F.desc("qty"), F.asc("l_partkey")], 10).withColumn("rank", F.col("rank").cast("bigint"))


_STAYS = "SELECT event_id, user_id, ts AS start, ts + to_hours(CAST(event_id % 30 AS INTEGER)) AS stop FROM events"


def _stays(t):
    """Events read as stays of up to 29 hours."""
    return t.events.select("event_id", "user_id", F.col("ts").alias("start"),
                           F.timestamp_add("HOUR", (F.col("event_id") % 30).cast("int"), F.col("ts")).alias("stop"))


_EPISODES = f"""SELECT user_id, min(start) AS start, max(stop) AS stop, count(*) AS members FROM (
      SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY start, stop, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM (
        SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY user_id ORDER BY start, stop, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens FROM ({_STAYS})))
    GROUP BY user_id, grp"""


@query("merge_intervals", _EPISODES)
def _(t):
    return W.merge_intervals(_stays(t), ["user_id"], "start", "stop", gap_seconds=3600)


@query("assign_episode", f"""
    WITH ep AS ({_EPISODES}),
    cand AS (SELECT e.event_id, e.event_type, p.start, p.stop, CASE WHEN e.event_type = 'purchase' AND e.ts > p.start THEN 1
        WHEN e.ts = p.start THEN 2 ELSE 3 END AS priority
      FROM events e JOIN ep p ON e.user_id = p.user_id AND e.ts >= p.start AND e.ts <= p.stop)
    SELECT event_id, start, stop, priority FROM cand QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY priority, start, stop) = 1""")
def _(t):
    episodes = W.merge_intervals(_stays(t), ["user_id"], "start", "stop", gap_seconds=3600)
    out = W.assign_episode(
        t.events.select("event_id", "event_type", "user_id", "ts"), episodes.drop("members"), ["user_id"], "event_id", "ts",
        "start", "stop", "CASE WHEN event_type = 'purchase' AND ts > start THEN 1 WHEN ts = start THEN 2 ELSE 3 END")
    return out.select("event_id", "start", "stop", "priority")


@query("sequence_number", """
    SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS seq FROM events""")
def _(t):
    out = W.sequence_number(t.events.select("event_id", "user_id", "event_type", "ts"), ["user_id", "event_type"],
                            ["ts", "event_id"], B.epoch_micros("ts"))
    return out.select("event_id", "seq")


# ---- sorting and set operations -------------------------------------------

@query("sort_multi", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority ASC, o_totalprice DESC")
def _(t):
    return A.sort_multi(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), o_orderpriority="asc", o_totalprice="desc")


@query("limit_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50")
def _(t):
    return A.limit_offset(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 25, 50)


@query("shuffle_rows", "SELECT doc_id, quality FROM labels")
def _(t):
    return A.shuffle_rows(t.labels.select("doc_id", "quality"), ["doc_id"])


@query("union_all", """
    SELECT n_name AS name, 'nation' AS kind FROM nation UNION ALL SELECT r_name, 'region' FROM region
    UNION ALL SELECT s_name, 'supplier' FROM supplier""")
def _(t):
    part = lambda df, c, k: df.select(F.col(c).alias("name"), F.lit(k).alias("kind"))
    return A.union_all(part(t.nation, "n_name", "nation"), part(t.region, "r_name", "region"), part(t.supplier, "s_name", "supplier"))


@query("union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t):
    return A.union_distinct(t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey"))
