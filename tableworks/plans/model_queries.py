"""Features, models, forecasts and SQL functions as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import register as U
from ..operators import features as K
from ..operators import forecast as Z
from ..session import scratch_path
from ..streaming import streams as R
from .catalog import query
from .core_queries import _ASOF, _PRICES, _SHARE, _features, _labelled_orders, _price_spans, r
from .ingest_queries import events_ltz, ntz, replay


@query("write_features", """
    SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal * 2 ELSE c_acctbal END AS balance,
      CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer""")
def _(t):
    path = scratch_path(t.spark, "features")
    base = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    K.write_features(base, path, ["id"], 0)
    wider = t.customer.filter("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("id"), (F.col("c_acctbal") * 2).alias("balance"), F.col("c_mktsegment").alias("segment"))
    K.write_features(wider, path, ["id"], 1)
    return K.read_features(t.spark, path, ["id"])


@query("write_features_stream", "SELECT user_id, ts, max_by(value, event_id) AS value FROM events GROUP BY 1, 2")
def _(t):
    src, path, ckpt = (scratch_path(t.spark, n) for n in ("src", "features", "ckpt"))
    one = events_ltz(t).groupBy("user_id", "ts").agg(F.max_by("value", "event_id").alias("value"))
    schema = "user_id bigint, ts timestamp, value double"
    replay(one, src, lambda: K.write_features_stream(R.stream_files(t.spark, src, schema), path, ["user_id"], ckpt, ts="ts"), 2)
    return ntz(K.read_features(t.spark, path, ["user_id"], "ts"), "ts")


@query("training_set", f"""
    SELECT o_orderkey, c_mktsegment, value AS last_value, round(coalesce(c_acctbal * value, 0), 4) AS weighted FROM
      ({_ASOF.format(how='ASOF LEFT', op='>=')}) LEFT JOIN customer ON o_custkey = c_custkey""")
def _(t):
    lookups = [
        K.Lookup(t.customer, {"o_custkey": "c_custkey"}, ["c_mktsegment", "c_acctbal"]),
        K.Lookup(_features(t), {"o_custkey": "o_custkey"}, ["value"], label_ts="o_at", feature_ts="ts", tie="event_id",
                 rename={"value": "last_value"}),
    ]
    return K.training_set(_labelled_orders(t), lookups, {"weighted": "round(coalesce(c_acctbal * last_value, 0), 4)"},
                          exclude=["o_custkey", "o_at", "c_acctbal"])


@query("feature_function", """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 0 THEN round((l_extendedprice - l_tax) / l_quantity, 9) ELSE 0 END AS increase FROM lineitem""")
def _(t):
    f = K.feature_function("CASE WHEN {n} > 0 THEN ({total} - {extra}) / {n} ELSE 0 END",
                           {"n": "l_quantity", "total": "l_extendedprice", "extra": "l_tax"})
    return t.lineitem.select("l_orderkey", "l_linenumber", r(f, 9).alias("increase"))


@query("build_label", """
    SELECT doc_id, CAST(CASE WHEN quality = 1 AND toxic = 0 THEN 1 WHEN NOT (quality = 1 AND toxic = 0) THEN 0 ELSE -1 END AS INTEGER) AS label
    FROM documents LEFT JOIN labels USING (doc_id)""")
def _(t):
    d = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return K.build_label(d, "quality = 1 AND toxic = 0", unknown=-1).select("doc_id", "label")


@query("assemble_training", "SELECT doc_id, lang, n_chars, quality FROM documents JOIN labels USING (doc_id)")
def _(t):
    return K.assemble_training(t.documents, t.labels, ["doc_id"], drop=["text", "source", "toxic"])


def _labelled(t):
    return K.assemble_training(t.documents.select("doc_id", "lang", "source", "n_chars"), t.labels, ["doc_id"])


@query("train_and_score")
def _(t):
    data = _labelled(t)
    model = K.train_classifier(data, "quality", ["n_chars"], ["lang"], grid={"regParam": [0.0, 0.1]}, folds=2)
    return K.score_batch(data, model, ["n_chars"], ["doc_id"], "1", "champion", "2024-02-01")


@query("score_boosted")
def _(t):
    data = _labelled(t)
    model = K.train_classifier(data, "toxic", ["n_chars"], ["lang"], kind="boosted")
    return K.score_batch(data, model, ["n_chars"], ["doc_id"], "2", "challenger", "2024-02-01")


@query("score_latest")
def _(t):
    e = t.events.withColumn("bad", (F.col("event_type") == "error").cast("int"))
    model = K.train_classifier(e, "bad", ["value"])
    users = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return K.score_latest(e, users, model, "user_id", ["ts", "event_id"], ["value"], "1", "2024-02-01")


@query("compare_models", """
    WITH p AS (SELECT quality AS y, CAST(n_chars > 1000 AS INTEGER) AS a, CAST(n_chars > 3000 AS INTEGER) AS b FROM labels JOIN documents USING (doc_id)),
    c AS (SELECT 'champion' AS model, count(*) FILTER (y = 1 AND a = 1) AS tp, count(*) FILTER (y <> 1 AND a = 1) AS fp, count(*) FILTER (y = 1 AND a <> 1) AS fn, count(*) FILTER (y <> 1 AND a <> 1) AS tn FROM p
      UNION ALL SELECT 'challenger', count(*) FILTER (y = 1 AND b = 1), count(*) FILTER (y <> 1 AND b = 1), count(*) FILTER (y = 1 AND b <> 1), count(*) FILTER (y <> 1 AND b <> 1) FROM p),
    f AS (SELECT *, round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1, CAST(1500 * tp - 500 * fp + 2000 * fn AS DOUBLE) AS value FROM c)
    SELECT *, f1 >= (SELECT f1 FROM f WHERE model = 'champion') AS promote FROM f""")
def _(t):
    d = _labelled(t).withColumns({"a": (F.col("n_chars") > 1000).cast("int"), "b": (F.col("n_chars") > 3000).cast("int")})
    out = K.compare_models(d, "quality", {"champion": "a", "challenger": "b"}, {"tp": 1500, "fp": -500, "fn": 2000, "tn": 0})
    return out.withColumn("f1", r("f1"))


@query("traffic_split", f"""
    SELECT event_id, CASE WHEN {_SHARE.format(k='user_id')} < 0.9 THEN 'current' ELSE 'next' END AS variant FROM events""")
def _(t):
    return K.traffic_split(t.events, ["user_id"], {"current": 0.9, "next": 0.1}).select("event_id", "variant")


_LIN = """
    x AS (SELECT l_orderkey, l_linenumber, l_returnflag, 0.5 * (l_quantity - (SELECT avg(l_quantity) FROM lineitem)) AS q,
      -2.0 * (l_discount - (SELECT avg(l_discount) FROM lineitem)) AS d FROM lineitem)"""


def _linear(t):
    return K.explain_linear(t.lineitem, {"l_quantity": 0.5, "l_discount": -2.0}, ["l_orderkey", "l_linenumber", "l_returnflag"])


@query("explain_linear", f"WITH {_LIN} SELECT l_orderkey, l_linenumber, round(q, 8) AS quantity, round(d, 8) AS discount FROM x")
def _(t):
    return _linear(t).select("l_orderkey", "l_linenumber", r("contribution_l_quantity", 8).alias("quantity"),
                             r("contribution_l_discount", 8).alias("discount"))


@query("mean_importance", f"WITH {_LIN} SELECT 'l_quantity' AS feature, round(avg(abs(q)), 6) AS importance FROM x UNION ALL SELECT 'l_discount', round(avg(abs(d)), 6) FROM x")
def _(t):
    return K.mean_importance(_linear(t)).withColumn("importance", r("importance"))


@query("fairness_gap", f"""
    WITH {_LIN}, g AS (SELECT l_returnflag, avg(q) AS q, avg(d) AS d FROM x GROUP BY 1)
    SELECT 'contribution_l_quantity' AS output, round(max(q) - min(q), 6) AS gap FROM g UNION ALL SELECT 'contribution_l_discount', round(max(d) - min(d), 6) FROM g""")
def _(t):
    return K.fairness_gap(_linear(t), "l_returnflag", ["contribution_l_quantity", "contribution_l_discount"]).withColumn("gap", r("gap"))


# ---- forecasts ------------------------------------------------------------

def _daily(t):
    return t.orders.groupBy("o_orderpriority", F.col("o_orderdate").cast("date").alias("ds")).agg(F.sum("o_totalprice").alias("y"))


@query("prepare_series", f"""
    WITH {_PRICES}, u AS (SELECT CAST(l_shipdate AS DATE) AS ds, l_returnflag AS family, l_quantity * price / 1000 AS y, l_quantity AS q FROM lineitem
      JOIN spans ON l_suppkey = suppkey AND l_shipdate >= valid_from AND (valid_to IS NULL OR l_shipdate < valid_to)),
    s AS (SELECT ds, CASE WHEN grouping(family) = 1 THEN 'ALL' ELSE family END AS family, sum(y) AS y, sum(q) AS quantity FROM u
      GROUP BY GROUPING SETS ((ds), (ds, family))),
    act AS (SELECT * FROM s WHERE family IN (SELECT family FROM s WHERE ds >= DATE '1999-01-01'))
    SELECT ds, family, round(y, 6) AS y, round(quantity, 3) AS quantity, round(max(y) OVER (PARTITION BY family) * 1.2, 6) AS cap FROM act""", dates=("ds",))
def _(t):
    usage = t.lineitem.select(F.col("l_suppkey").alias("suppkey"), F.col("l_returnflag").alias("family"), "l_shipdate",
                              F.col("l_quantity").alias("q"))
    prices = _price_spans(t).withColumn("price", F.col("price") / 1000)
    out = Z.prepare_series(usage, prices, ["suppkey"], ["family"], "l_shipdate", "q", "price", "valid_from", "valid_to", "1999-01-01")
    return out.select("ds", "family", r("y", 6).alias("y"), r("quantity", 3).alias("quantity"), r("cap", 6).alias("cap"))


@query("forecast_groups")
def _(t):
    return Z.forecast_groups(_daily(t), ["o_orderpriority"]).withColumn("ds", F.col("ds").cast("timestamp_ntz"))


@query("assemble_forecast", """
    WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS ds, sum(o_totalprice) AS y FROM orders GROUP BY 1, 2),
    f AS (SELECT o_orderpriority, ds, y, ds >= DATE '2001-01-01' AS is_prediction, greatest(y * 0.9 - 20000, 0) AS lo, greatest(y * 1.1, 0) AS hi FROM d)
    SELECT o_orderpriority, ds, round(CASE WHEN is_prediction THEN y * 0.95 ELSE y END, 6) AS value, is_prediction,
      round(avg(lo) OVER w, 6) AS lower_smooth, round(avg(hi) OVER w, 6) AS upper_smooth FROM f
    WINDOW w AS (PARTITION BY o_orderpriority ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)""", dates=("ds",))
def _(t):
    d = _daily(t)
    fc = d.select("o_orderpriority", "ds", F.when(F.col("ds") < "2001-01-01", F.col("y")).alias("y"), (F.col("y") * 0.95).alias("yhat"),
                  (F.col("y") * 0.9 - 20000).alias("yhat_lower"), (F.col("y") * 1.1).alias("yhat_upper"))
    out = Z.assemble_forecast(fc, ["o_orderpriority"])
    return out.select("o_orderpriority", "ds", r("value", 6).alias("value"), "is_prediction",
                      r("lower_smooth", 6).alias("lower_smooth"), r("upper_smooth", 6).alias("upper_smooth"))


@query("top_series", """
    WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS ds, sum(o_totalprice) AS y FROM orders GROUP BY 1, 2)
    SELECT o_custkey, ds, round(y, 2) AS y FROM d WHERE ds >= DATE '2000-08-01' AND o_custkey IN (
      SELECT o_custkey FROM d WHERE ds >= DATE '2000-08-01' GROUP BY 1 ORDER BY sum(y) DESC, o_custkey LIMIT 5)""", dates=("ds",))
def _(t):
    d = t.orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("ds")).agg(F.sum("o_totalprice").alias("y"))
    return Z.top_series(d, ["o_custkey"], "y", "ds", "2000-08-01").withColumn("y", r("y", 2))


# ---- functions ------------------------------------------------------------

@query("sql_function", "SELECT o_orderkey, round(o_totalprice * 1.2, 4) AS gross, round(o_totalprice * 1.05, 4) AS reduced FROM orders")
def _(t):
    U.register_sql_function(t.spark, "tw_gross", {"price": "DOUBLE", "rate": "DOUBLE DEFAULT 0.2"}, "DOUBLE", "price * (1 + rate)", "price with tax")
    return t.orders.select("o_orderkey", r(F.expr("tw_gross(o_totalprice)"), 4).alias("gross"), r(F.expr("tw_gross(o_totalprice, 0.05D)"), 4).alias("reduced"))


@query("table_function", """
    SELECT c_mktsegment, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND o_totalprice >= 400000""")
def _(t):
    t.customer.createOrReplaceTempView("tw_customer")
    t.orders.createOrReplaceTempView("tw_orders")
    U.register_table_function(t.spark, "tw_big_orders", {"segment": "STRING", "at_least": "DOUBLE DEFAULT 100000"},
                              "segment STRING, o_orderkey BIGINT, o_totalprice DOUBLE",
                              "SELECT c_mktsegment, o_orderkey, o_totalprice FROM tw_customer JOIN tw_orders ON c_custkey = o_custkey "
                              "WHERE c_mktsegment = tw_big_orders.segment AND o_totalprice >= at_least")
    return t.spark.sql("SELECT segment AS c_mktsegment, o_orderkey, o_totalprice FROM tw_big_orders('BUILDING', 400000)")


def _title_words(text):
    return " ".join(w[:1].upper() + w[1:].lower() for w in text.split(" "))


@query("python_function", "SELECT c_custkey, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS segment FROM customer")
def _(t):
    U.register_python_function(t.spark, "tw_title", _title_words, "string")
    return t.customer.selectExpr("c_custkey", "tw_title(c_mktsegment) AS segment")


@query("pandas_function", """
    SELECT event_id, round(value * 2, 4) AS doubled, round(value + 100, 4) AS shifted, round(value * event_id, 2) AS product, value > 50 AS big FROM events""")
def _(t):
    U.register_pandas_function(t.spark, "tw_double", lambda s: s * 2, "double")

    def load():  # stands for loading a model once per task
        offset = 100.0
        return lambda s: s + offset

    both = U.struct_function(lambda v, i: (v * i).to_frame("product").assign(big=v > 50), "product double, big boolean", "value", "event_id")
    out = t.events.select("event_id", "value", both.alias("b"))
    return out.select("event_id", r(F.expr("tw_double(value)"), 4).alias("doubled"), r(U.with_setup(load, "double")("value"), 4).alias("shifted"),
                      r("b.product", 2).alias("product"), F.col("b.big").alias("big"))


@query("grouped_maps", """
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT event_type, count(*) AS days, CAST(max(n) - min(n) AS BIGINT) AS spread FROM d GROUP BY 1""")
def _(t):
    daily = t.events.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))

    def spread(pdf):
        return pdf.groupby("event_type", as_index=False).agg(days=("n", "size"), spread=("n", lambda x: x.max() - x.min()))

    def whole(batches):
        yield from batches

    kept = U.per_partition(daily.select("event_type", "n"), whole, "event_type string, n bigint")
    return U.per_group(kept, ["event_type"], spread, "event_type string, days bigint, spread bigint")


@query("model_function", """
    SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-(0.1 + 0.02 * l_quantity - 3.0 * l_discount))), 6) AS score FROM lineitem""")
def _(t):
    U.register_linear_model(t.spark, "tw_score", {"quantity": 0.02, "discount": -3.0}, 0.1)
    return t.lineitem.select("l_orderkey", "l_linenumber", r(F.expr("tw_score(l_quantity, l_discount)")).alias("score"))
