"""Sources, sinks and streams as named queries.

Inputs are written from the test tables by Spark first, so each query covers
the whole table through the path it is about.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import files as S
from ..sources import tables as K
from ..session import scratch_path
from ..streaming import streams as R
from .catalog import query
from .core_queries import r

EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def replay(df, path, run, slices=3, fmt="parquet", order="ts"):
    """Add a table to ``path`` in time-ordered slices, oldest first, and ``run()`` after each.

    A slice keeps the partitions of the table; rows without a time go with the oldest.
    """
    bounds = df.agg(F.min(F.unix_micros(F.col(order).cast("timestamp"))), F.max(F.unix_micros(F.col(order).cast("timestamp")))).first()
    step = (bounds[1] - bounds[0]) // slices + 1
    at = F.coalesce(F.floor((F.unix_micros(F.col(order).cast("timestamp")) - bounds[0]) / step), F.lit(0))
    for i in range(slices):
        df.filter(at == i).write.mode("append").format(fmt).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").save(path)
        run()


def events_ltz(t):
    return t.events.withColumn("ts", F.col("ts").cast("timestamp"))


def ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


@query("ingest_files", _EVENTS)
def _(t):
    src, out, ckpt = (scratch_path(t.spark, n) for n in ("json", "bronze", "ckpt"))

    def load():
        S.ingest_files(t.spark, src, "json", EVENT_SCHEMA, ckpt, out)

    replay(events_ltz(t), src, load, 2, "json")
    load()  # finds nothing new
    return ntz(t.spark.read.parquet(out), "ts")


@query("infer_schema", """
    SELECT * FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'decimal(12,2)'),
      ('c_mktsegment', 'string')) v(name, type)""")
def _(t):
    src, store = scratch_path(t.spark, "csv"), scratch_path(t.spark, "schema")
    t.customer.write.option("header", "true").csv(src)
    hints = "c_custkey bigint, c_acctbal decimal(12,2)"
    S.infer_schema(t.spark, src, "csv", hints, store)
    schema = S.infer_schema(t.spark, src, "csv", None, store)  # from the store: hints are kept
    return t.spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], "name string, type string")


@query("read_with_rescue", """
    SELECT event_id, CASE WHEN event_id % 9 > 0 THEN value END AS value,
      CASE WHEN event_id % 9 = 0 AND event_id % 5 = 0 THEN '{"value":"bad","extra":"' || user_id || '"}'
           WHEN event_id % 9 = 0 THEN '{"value":"bad"}' WHEN event_id % 5 = 0 THEN '{"extra":"' || user_id || '"}' END AS _rescued_data FROM events""")
def _(t):
    src = scratch_path(t.spark, "dirty")
    bad = F.when(F.col("event_id") % 9 == 0, "bad").otherwise(F.col("value").cast("string"))
    value = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit('"'), bad, F.lit('"'))).otherwise(bad)
    extra = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit(', "extra": "'), "user_id", F.lit('"'))).otherwise(F.lit(""))
    t.events.select(F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "value": '), value, extra, F.lit("}"))).write.text(src)
    return S.read_with_rescue(t.spark, src, "json", "event_id bigint, value double").select("event_id", "value", S.RESCUED)


@query("read_with_rescue_nested", """
    SELECT event_id, CASE WHEN event_id % 9 > 0 THEN value END AS amount, event_type AS kind,
      CASE WHEN event_id % 9 = 0 AND event_id % 5 = 0 THEN '{"body.amount":"bad","body.extra":"' || user_id || '"}'
           WHEN event_id % 9 = 0 THEN '{"body.amount":"bad"}' WHEN event_id % 5 = 0 THEN '{"body.extra":"' || user_id || '"}' END AS _rescued_data FROM events""")
def _(t):
    src = scratch_path(t.spark, "dirty")
    bad, more = F.col("event_id") % 9 == 0, F.col("event_id") % 5 == 0
    good = F.to_json(F.struct("event_id", F.struct(
        F.when(~bad, F.col("value")).alias("amount"), F.when(more, F.col("user_id").cast("string")).alias("extra"), F.col("event_type").alias("kind")).alias("body")))
    odd = F.to_json(F.struct("event_id", F.struct(
        F.lit("bad").alias("amount"), F.when(more, F.col("user_id").cast("string")).alias("extra"), F.col("event_type").alias("kind")).alias("body")))
    t.events.select(F.when(bad, odd).otherwise(good).alias("value")).write.text(src)
    found = S.read_with_rescue(t.spark, src, "json", "event_id bigint, body struct<amount double, kind string>")
    return found.select("event_id", "body.amount", "body.kind", S.RESCUED)


@query("read_with_rescue_csv", """
    SELECT c_custkey, CASE WHEN c_custkey % 8 > 0 THEN c_nationkey END::DOUBLE AS c_nationkey,
      CASE WHEN c_custkey % 8 = 0 THEN '{"c_nationkey":"unknown","c_mktsegment":"' || c_mktsegment || '"}'
           ELSE '{"c_mktsegment":"' || c_mktsegment || '"}' END AS _rescued_data FROM customer""")
def _(t):
    src = scratch_path(t.spark, "dirty")
    t.customer.select("c_custkey", F.when(F.col("c_custkey") % 8 == 0, "unknown").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
                      "c_mktsegment").write.option("header", "true").csv(src)
    return S.read_with_rescue(t.spark, src, "csv", "c_custkey bigint, c_nationkey double")


@query("evolve_schema", """
    SELECT event_id, CASE WHEN event_id % 2 = 1 THEN value END AS value, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type FROM events""")
def _(t):
    src, store, ckpt, out = (scratch_path(t.spark, n) for n in ("json", "schema", "ckpt", "bronze"))

    def load():
        S.ingest_evolving(t.spark, src, store, ckpt, out, "event_id bigint")

    t.events.filter("event_id % 2 = 0").select("event_id").write.json(src)
    S.run_until_stable(load)
    t.events.filter("event_id % 2 = 1").select("event_id", "value", "event_type").write.mode("append").json(src)
    S.run_until_stable(load)
    return K.read_table(t.spark, out, merge_schema=True).select("event_id", "value", "event_type")


@query("evolve_schema_nested", """
    SELECT event_id, CASE WHEN event_id % 2 = 1 THEN value END AS amount, CASE WHEN event_id % 2 = 1 THEN event_type END AS kind FROM events""")
def _(t):
    src, store, ckpt, out = (scratch_path(t.spark, n) for n in ("json", "schema", "ckpt", "bronze"))

    def load():
        S.ingest_evolving(t.spark, src, store, ckpt, out, "body struct<event_id bigint>")

    t.events.filter("event_id % 2 = 0").select(F.struct("event_id").alias("body")).write.json(src)
    S.run_until_stable(load)
    wide = F.struct("event_id", F.col("value").alias("amount"), F.col("event_type").alias("kind"))
    t.events.filter("event_id % 2 = 1").select(wide.alias("body")).write.mode("append").json(src)
    S.run_until_stable(load)
    return K.read_table(t.spark, out, merge_schema=True).select("body.event_id", "body.amount", "body.kind")


@query("with_file_metadata", "SELECT event_id, 'events.parquet' AS file_name FROM events")
def _(t):
    e = S.with_file_metadata(t.events)
    return e.select("event_id", F.substring_index("source_file", "/", -1).alias("file_name"))


@query("read_any", "SELECT 'csv' AS fmt, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer UNION ALL "
       "SELECT 'json', count(*), round(sum(c_acctbal), 2) FROM customer UNION ALL SELECT 'orc', count(*), round(sum(c_acctbal), 2) FROM customer")
def _(t):
    out = None
    for fmt in ("csv", "json", "orc"):
        path = scratch_path(t.spark, fmt)
        writer = t.customer.write.format(fmt)
        (writer.option("header", "true") if fmt == "csv" else writer).save(path)
        df = S.read_any(t.spark, path, fmt, t.customer.schema, glob=f"*.{fmt}").agg(
            F.count(F.lit(1)).alias("n"), r(F.sum("c_acctbal"), 2).alias("total")).select(F.lit(fmt).alias("fmt"), "n", "total")
        out = df if out is None else out.unionByName(df)
    return out


@query("query_files", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def _(t):
    df = S.query_files(t.spark, t.path("orders"), "parquet", "o_orderstatus", "o_totalprice > 100000")
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("ingest_binary", """
    SELECT 'k' || page_id % 4 AS label, CAST(sum(strlen(html) + 1) AS BIGINT) AS bytes FROM pages GROUP BY 1""")
def _(t):
    src = scratch_path(t.spark, "binary")
    t.pages.select("html", F.concat(F.lit("k"), F.col("page_id") % 4).alias("label")).repartition("label").write.partitionBy("label").text(src)
    found = S.ingest_binary(t.spark, src, "*.txt", "label=([^/]+)/")
    return found.withColumn("bytes", F.octet_length("content")).groupBy("label").agg(F.sum("bytes").alias("bytes"))


@query("parse_messages", "SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events WHERE event_id % 50 > 0")
def _(t):
    e = t.events
    payload = F.struct(F.when(e.event_id % 50 > 0, e.event_id).alias("event_id"), "user_id", "event_type",
                       F.unix_seconds(F.col("ts").cast("timestamp")).alias("event_date"))
    messages = e.select(F.col("user_id").cast("string").cast("binary").alias("key"), F.to_json(payload).cast("binary").alias("value"))
    out = S.parse_messages(messages, '{"event_id": 1, "user_id": 1, "event_type": "view", "event_date": 1700000000}',
                           ["event_date"], required=["event_id"])
    return out.select("event_id", "user_id", "event_type", F.unix_seconds("event_date").alias("seconds"))


@query("copy_into", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    src, table = scratch_path(t.spark, "drop"), scratch_path(t.spark, "table")
    o = t.orders.select("o_orderkey", "o_totalprice")
    o.filter("o_orderkey % 2 = 0").write.json(src)
    schema = o.schema
    S.copy_into(t.spark, src, "json", table, schema, glob="*.json")
    S.copy_into(t.spark, src, "json", table, schema, glob="*.json")  # nothing new
    o.filter("o_orderkey % 2 = 1").write.mode("append").json(src)
    S.copy_into(t.spark, src, "json", table, schema, glob="*.json")
    return t.spark.read.parquet(table).select("o_orderkey", "o_totalprice")


@query("write_table", """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS o_totalprice,
      CASE WHEN o_orderkey % 2 = 1 AND o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def _(t):
    path = scratch_path(t.spark, "table")
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority").repartition("o_orderstatus")
    K.write_table(o.filter("o_orderkey % 2 = 0").drop("o_orderpriority"), path, "overwrite", ["o_orderstatus"])
    K.write_table(o.filter("o_orderkey % 2 = 1"), path, "append", ["o_orderstatus"], merge_schema=True)
    fixed = o.filter("o_orderstatus = 'P'").drop("o_orderpriority").withColumn("o_totalprice", F.lit(0.0))
    K.write_table(fixed, path, partition_by=["o_orderstatus"], replace_partitions=True)
    return K.read_table(t.spark, path, merge_schema=True)


@query("fan_out", """
    SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def _(t):
    base = scratch_path(t.spark, "fan")
    names = ["nation", "orders", "part", "supplier"]
    S.fan_out(names, lambda n: getattr(t, n).write.parquet(f"{base}/{n}"), workers=4)
    parts = [t.spark.read.parquet(f"{base}/{n}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("foreach_batch_sink", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def _(t):
    src, out, ckpt = (scratch_path(t.spark, n) for n in ("src", "out", "ckpt"))

    def totals(batch, batch_id):
        batch.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    replay(events_ltz(t), src, lambda: S.foreach_batch_sink(R.stream_files(t.spark, src, EVENT_SCHEMA), totals, ckpt))
    return t.spark.read.parquet(out).groupBy("user_id").agg(F.sum("n").alias("n"))


@query("copy_tables", """
    SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'parts', count(*) FROM part
    UNION ALL SELECT 'small_parts', count(*) FROM part WHERE p_size < 10""")
def _(t):
    a, b = (scratch_path(t.spark, n).rsplit("/", 1) for n in ("src_db", "dst_db"))
    src, dst = a[1].replace("-", "_"), b[1].replace("-", "_")
    for name, (folder, _) in ((src, a), (dst, b)):
        t.spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/{name}'")
    middle = t.orders.agg((F.max("o_orderkey") / 2).cast("bigint")).first()[0]
    t.orders.filter(F.col("o_orderkey") <= middle).write.saveAsTable(f"{src}.orders")
    t.part.write.saveAsTable(f"{src}.parts")
    t.spark.sql(f"CREATE VIEW {src}.small_parts AS SELECT * FROM {src}.parts WHERE p_size < 10")
    K.copy_tables(t.spark, src, dst, {"orders": "o_orderkey"})
    # the rest arrives later and only it is copied
    t.orders.filter(F.col("o_orderkey") > middle).write.mode("append").saveAsTable(f"{src}.orders")
    K.copy_tables(t.spark, src, dst, {"orders": "o_orderkey"})
    out = None
    for name in ("orders", "parts", "small_parts"):
        df = t.spark.table(f"{dst}.{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = df if out is None else out.unionByName(df)
    return out


# ---- streams --------------------------------------------------------------

def _replayed(t, run, slices=3, repeat=False):
    """Events in time slices; ``run`` gets the stream after each and goes on from its checkpoint."""
    src = scratch_path(t.spark, "events")
    e = events_ltz(t)
    if repeat:  # every tenth event arrives twice
        e = e.unionByName(e.filter("event_id % 10 = 0"))
    replay(e, src, lambda: run(R.stream_files(t.spark, src, EVENT_SCHEMA)), slices)


def _out(t):
    return scratch_path(t.spark, "out"), scratch_path(t.spark, "ckpt")


@query("dedup_stream", "SELECT event_id, ts FROM events")
def _(t):
    out, ckpt = _out(t)
    _replayed(t, lambda s: R.run_to_files(R.dedup_stream(s, ["event_id"], "ts", "1 hour").select("event_id", "ts"), out, ckpt), repeat=True)
    return ntz(t.spark.read.parquet(out), "ts")


@query("tumbling_counts", """
    SELECT time_bucket(INTERVAL 10 SECOND, ts) AS window_start, event_type, count(*) AS n FROM events
    GROUP BY 1, 2 HAVING window_start + INTERVAL 10 SECOND <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 MINUTE FROM events)""")
def _(t):
    out, ckpt = _out(t)
    _replayed(t, lambda s: R.run_to_files(R.tumbling_counts(s, "ts", "10 seconds", ["event_type"]), out, ckpt))
    return ntz(t.spark.read.parquet(out), "window_start").drop("window_end")


@query("running_aggregate", "SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def _(t):
    out, ckpt = _out(t)
    aggs = {"n": F.count(F.lit(1)), "mean": F.avg("value")}
    _replayed(t, lambda s: R.keep_latest_result(R.running_aggregate(s, ["event_type"], aggs), out, ckpt))
    return t.spark.read.parquet(out).withColumn("mean", r("mean"))


_GAP = 4 * 3600
_SESSIONS = f"""SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS click_count FROM (
    SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (
      SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL {_GAP} SECOND THEN 0 ELSE 1 END AS opens FROM events))
    GROUP BY user_id, s"""
_CLOSED = f"""SELECT user_id, start, "end", click_count FROM ({_SESSIONS})
    WHERE "end" + INTERVAL {_GAP} SECOND <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events)"""


@query("sessionize_window", _CLOSED)
def _(t):
    out, ckpt = _out(t)
    _replayed(t, lambda s: R.run_to_files(R.sessionize_window(s, "user_id", "ts", _GAP), out, ckpt))
    return ntz(t.spark.read.parquet(out), "start", "end").drop("status")


@query("sessionize_stateful", _CLOSED)
def _(t):
    out, ckpt = _out(t)
    _replayed(t, lambda s: R.run_to_files(R.sessionize_stateful(s, "user_id", "ts", _GAP), out, ckpt))
    return ntz(t.spark.read.parquet(out), "start", "end").drop("status")


@query("upsert_sessions", f"""
    SELECT user_id, start, "end", click_count, CASE WHEN "end" + INTERVAL {_GAP} SECOND <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events)
      THEN 'offline' ELSE 'online' END AS status FROM ({_SESSIONS}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY start DESC) = 1""")
def _(t):
    out, ckpt = _out(t)
    _replayed(t, lambda s: R.upsert_stream(R.sessionize_stateful(s, "user_id", "ts", _GAP, report_online=True), out, ckpt))
    return ntz(K.latest_rows(t.spark, out, ["user_id"], ["end"]), "start", "end")


@query("stream_from_table", "SELECT event_id, value FROM events WHERE value > 20")
def _(t):
    bronze, ckpt = _out(t)
    silver, ckpt2 = _out(t)

    def run(events):
        R.run_to_files(events, bronze, ckpt)
        R.run_to_files(R.stream_files(t.spark, bronze, EVENT_SCHEMA).filter("value > 20").select("event_id", "value"), silver, ckpt2)

    _replayed(t, run)
    return t.spark.read.parquet(silver)


@query("stream_rollup", """
    SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def _(t):
    out, ckpt = _out(t)
    aggs = {"n": F.count(F.lit(1)), "total": F.sum("value")}
    _replayed(t, lambda s: R.stream_rollup(s, "ts", ["event_type"], aggs, out, ckpt))
    return ntz(K.latest_rows(t.spark, out, ["window_start", "event_type"]), "window_start").withColumn("total", r("total", 4))


@query("join_stream_static", """
    SELECT event_id, c_mktsegment FROM events JOIN customer ON user_id = c_custkey""")
def _(t):
    out, ckpt = _out(t)
    users = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    _replayed(t, lambda s: R.run_to_files(R.join_stream_static(s, users, ["user_id"]).select("event_id", "c_mktsegment"), out, ckpt))
    return t.spark.read.parquet(out)


@query("join_stream_stream", """
    SELECT v.event_id AS view_id, c.event_id AS click_id FROM events v JOIN events c ON v.user_id = c.user_id
    AND c.ts >= v.ts - INTERVAL 2 HOUR AND c.ts <= v.ts + INTERVAL 2 HOUR WHERE v.event_type = 'view' AND c.event_type = 'click'""")
def _(t):
    out, ckpt = _out(t)

    def run(events):
        views = events.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
        clicks = events.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
        R.run_to_files(R.join_stream_stream(views, clicks, ["user_id"], "view_ts", "click_ts", "3 hours", "2 HOURS").select("view_id", "click_id"), out, ckpt)

    _replayed(t, run)
    return t.spark.read.parquet(out)


@query("sync_tables", """
    SELECT o.o_custkey AS id, o.o_totalprice AS amount, c.c_name AS name FROM (
      SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1) o
    LEFT JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.o_orderkey % 17 <> 0""")
def _(t):
    """Raw change folders to current tables, table by table in parallel, then joined."""
    base = scratch_path(t.spark, "cdc")
    raw = {
        "transactions": t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("amount"),
                                        F.when(F.col("o_orderkey") % 17 == 0, "DELETE").otherwise("APPEND").alias("operation")),
        "customers": t.customer.select(F.col("c_custkey").alias("id"), F.lit(1).cast("bigint").alias("seq"), F.col("c_name").alias("name"),
                                       F.lit("APPEND").alias("operation")),
    }
    for name, df in raw.items():
        df.write.json(f"{base}/raw/{name}")

    def sync(name):
        schema = raw[name].schema
        S.ingest_files(t.spark, f"{base}/raw/{name}", "json", schema, f"{base}/ckpt/{name}", f"{base}/bronze/{name}")
        changes = R.stream_files(t.spark, f"{base}/bronze/{name}", schema)
        feed = R.changes_from_state(changes, ["id"], F.col("seq"), "operation = 'DELETE'", ["operation", "seq"])
        R.run_to_files(feed, f"{base}/silver/{name}", f"{base}/ckpt2/{name}")
        return R.current_rows(t.spark.read.parquet(f"{base}/silver/{name}"), ["id"])

    done = S.fan_out(raw, sync, workers=2)
    return done["transactions"].join(done["customers"], "id", "left").select("id", "amount", "name")
