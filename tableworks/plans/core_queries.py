"""Cleaning, joins, aggregates, windows and set operations as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import blocks as B
from ..operators import clean as P
from ..operators import joins as J
from ..operators import windows as W
from .catalog import query

DAY = B.DAY


def r(col, digits=6):
    """Rounded double: sums of doubles differ in the last bits between engines."""
    return F.round(B.as_column(col).cast("double"), digits)


# ---- cleaning -------------------------------------------------------------

@query("clean_entities", """
    SELECT c_custkey AS id, sha1(c_name) AS name_hash,
           upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS segment,
           CAST(c_acctbal AS INTEGER) AS balance_band,
           strptime(strftime(TIMESTAMP '2020-01-01' + to_days(CAST(c_custkey % 3000 AS INTEGER)), '%m-%d-%Y %H:%M:%S'),
                    '%m-%d-%Y %H:%M:%S') AS created
    FROM (SELECT c_custkey, c_name, c_mktsegment, trunc(c_acctbal) AS c_acctbal FROM customer)""")
def _(t):
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 3000).cast("int"))
    raw = t.customer.withColumn("created_text", F.date_format(day, "MM-dd-yyyy HH:mm:ss"))
    return P.clean_entities(raw, {
        "id": "copy c_custkey", "name_hash": "sha1 c_name", "segment": "title c_mktsegment",
        "balance_band": "cast c_acctbal int", "created": "timestamp created_text MM-dd-yyyy HH:mm:ss",
    })


@query("drop_technical", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def _(t):
    nested = t.orders.select("o_orderkey", F.struct("o_custkey", "o_totalprice", "o_orderpriority").alias("detail"),
                             "o_orderdate", "o_orderstatus")
    return P.drop_technical(nested, ["o_orderstatus", "o_orderpriority"], expand=["detail"])


@query("rename_columns", """SELECT p_partkey AS part_key, p_name AS part_name, p_retailprice AS retail_price FROM part""")
def _(t):
    camel = t.part.select(F.col("p_partkey").alias("PartKey"), F.col("p_name").alias("Part Name"),
                          F.col("p_retailprice").alias("retailPrice"))
    return P.rename_columns(camel)


@query("flatten_struct", """SELECT event_id, user_id AS actor_user_id, event_type AS actor_event_type, value FROM events""")
def _(t):
    return P.flatten_struct(t.events.select(
        "event_id", F.struct("user_id", "event_type").alias("actor"), "value"))


@query("drop_incomplete", """
    SELECT event_id, user_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM events
    WHERE event_id % 7 <> 0 AND value > 10""")
def _(t):
    holes = t.events.select("event_id", "user_id",
                            F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    return P.drop_incomplete(holes, ["value"], ["value > 10"])


@query("safe_cast", """
    SELECT doc_id, CAST(try_cast(split_part(source, '-', 1) AS INTEGER) AS DOUBLE) AS source_no,
           CAST(try_cast(CASE WHEN n_chars % 2 = 0 THEN CAST(n_chars AS VARCHAR) ELSE 'x' || n_chars END AS BIGINT) AS DOUBLE) AS n
    FROM documents""")
def _(t):
    d = t.documents.select(
        "doc_id", F.split_part("source", F.lit("-"), F.lit(1)).alias("source_no"),
        F.when(F.col("n_chars") % 2 == 0, F.col("n_chars").cast("string"))
        .otherwise(F.concat(F.lit("x"), F.col("n_chars").cast("string"))).alias("n"))
    cast = P.safe_cast(d, {"source_no": "int", "n": "bigint"})
    return cast.select("doc_id", F.col("source_no").cast("double").alias("source_no"), F.col("n").cast("double").alias("n"))


@query("fill_missing", """
    SELECT d.doc_id, coalesce(l.quality, -1) AS quality,
           CASE WHEN l.toxic IS NULL THEN 0.0 ELSE CAST(l.toxic AS DOUBLE) END AS toxic
    FROM documents d LEFT JOIN labels l USING (doc_id)""")
def _(t):
    joined = J.join_left(t.documents.select("doc_id"), t.labels, "doc_id")
    joined = joined.withColumn("toxic", F.coalesce(F.col("toxic").cast("string"), F.lit(" ")))
    return P.fill_missing(joined, {"quality": -1}, ["toxic"])


@query("parse_json_column", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_path,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_struct,
           json_extract_string(props, '$.k') AS k_map
    FROM events""")
def _(t):
    e = P.parse_json_column(t.events, "props", "struct<k: bigint>", {"k_path": ("$.k", "bigint")})
    e = P.parse_json_column(e, "props", "map<string,string>", out="as_map")
    return e.select("event_id", "k_path", F.col("parsed.k").alias("k_struct"),
                    F.try_element_at("as_map", F.lit("k")).alias("k_map"))


@query("clean_map", """
    SELECT event_id, event_type || CASE WHEN value > 50 THEN ',' || 'value' ELSE '' END AS entries FROM events""")
def _(t):
    m = t.events.select("event_id", F.create_map(
        F.col("event_type"), F.lit("1"), F.lit("value"),
        F.when(F.col("value") > 50, F.col("value").cast("string"))).alias("m"))
    return P.clean_map(m, "m").select("event_id", F.array_join(F.map_keys("m"), ",").alias("entries"))


@query("explode_list", """
    SELECT doc_id, CAST(pos AS BIGINT) AS pos, word FROM (
      SELECT doc_id, unnest(range(len(w))) AS pos, unnest(w) AS word
      FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents WHERE text <> ''))""")
def _(t):
    words = t.documents.filter("text <> ''").select("doc_id", F.split("text", " ", -1).alias("w"))
    return P.explode_list(words, "w", "word", "pos").withColumn("pos", F.col("pos").cast("bigint"))


@query("bucketize", """
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class,
           CAST(ceil(p_size / 5.0) * 5 AS BIGINT) AS size_band FROM part""")
def _(t):
    b = P.bucketize(t.part, "size_class", [("p_size < 10", "small"), ("p_size < 30", "medium")], "large")
    return b.select("p_partkey", "size_class", (F.ceil(F.col("p_size") / 5.0) * 5).cast("bigint").alias("size_band"))


@query("apply_rules", """
    WITH a AS (SELECT l_orderkey, l_linenumber,
        CASE WHEN l_quantity <= 40 THEN 'in range' ELSE 'too many' END AS valid_amount,
        CASE WHEN l_discount > 0.05 THEN 'HIGH' ELSE 'NORMAL' END AS discount_check FROM lineitem)
    SELECT *, CASE WHEN valid_amount = 'in range' AND discount_check = 'NORMAL' THEN 'release' ELSE 'review' END AS decision
    FROM a""")
def _(t):
    # the rule table: id, name, code, severity, active
    rules = t.spark.createDataFrame([
        (1, "valid_amount", "CASE WHEN l_quantity <= 40 THEN 'in range' ELSE 'too many' END", "HIGH", True),
        (2, "discount_check", "IF(l_discount > 0.05, 'HIGH', 'NORMAL')", "LOW", True),
        (3, "unused", "1 / 0", "LOW", False),
        (4, "decision", "CASE WHEN valid_amount = 'in range' AND discount_check = 'NORMAL' THEN 'release' ELSE 'review' END", "HIGH", True),
    ], "rule_id int, check_name string, check_code string, check_severity string, is_active boolean")
    return P.apply_rules(t.lineitem, rules).select("l_orderkey", "l_linenumber", "valid_amount", "discount_check", "decision")


@query("extract_regex", """
    SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
           regexp_extract(url, '^https?://([^/]+)', 1) AS host,
           split_part(url, '/', -1) AS last_part, regexp_replace(url, '[-_]+', ' ', 'g') AS spaced
    FROM pages""")
def _(t):
    p = t.pages.withColumn("spaced", F.col("url"))
    p = P.extract_regex(p, "html", {"title": ("<title>([^<]*)</title>", 1)})
    p = P.extract_regex(p, "url", {"host": ("^https?://([^/]+)", 1)})
    p = P.replace_regex(p, {"spaced": ("[-_]+", " ")})
    return p.select("page_id", "title", "host", F.substring_index("url", "/", -1).alias("last_part"), "spaced")


@query("dedup", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    return P.dedup(t.events.select("user_id", "event_type"))


@query("tag_columns", "SELECT c_custkey, 'category' AS semantic_type FROM customer")
def _(t):
    tagged = P.tag_columns(t.customer, {"c_mktsegment": {"semantic_type": "category"}})
    return tagged.select("c_custkey", F.lit(tagged.schema["c_mktsegment"].metadata["semantic_type"]).alias("semantic_type"))


@query("time_features", """
    SELECT event_id, (dayofweek(ts) + 6) % 7 AS day_of_week, day(ts) AS day_of_month, hour(ts) AS hour,
           round(sin(((dayofweek(ts) + 6) % 7) * 2.0 * pi() / 7.0), 6) + 0.0 AS day_of_week_sin,
           round(cos(day(ts) * 2.0 * pi() / 30.0), 6) + 0.0 AS day_of_month_cos,
           round(sin(hour(ts) * 2.0 * pi() / 24.0), 6) + 0.0 AS hour_sin
    FROM events""")
def _(t):
    return P.time_features(t.events, "ts").select(
        "event_id", *[F.col(c).cast("bigint").alias(c) for c in ("day_of_week", "day_of_month", "hour")],
        *[(r(c) + 0.0).alias(c) for c in ("day_of_week_sin", "day_of_month_cos", "hour_sin")])


@query("assemble_vector", """
    SELECT l_orderkey, l_linenumber, round(l_quantity + l_tax, 6) AS ends, l_orderkey || '-' || l_linenumber AS composite_key
    FROM lineitem""")
def _(t):
    v = P.assemble_vector(t.lineitem, ["l_quantity", "l_discount", "l_tax"], "v", ["l_orderkey", "l_linenumber"])
    return v.select("l_orderkey", "l_linenumber", r(F.get("v", F.lit(0)) + F.get("v", F.lit(2))).alias("ends"), "composite_key")


@query("one_hot", """
    SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS BIGINT) AS c_mktsegment_automobile,
      CAST(c_mktsegment = 'BUILDING' AS BIGINT) AS c_mktsegment_building,
      CAST(c_mktsegment = 'FURNITURE' AS BIGINT) AS c_mktsegment_furniture,
      CAST(c_mktsegment = 'HOUSEHOLD' AS BIGINT) AS c_mktsegment_household,
      CAST(c_mktsegment = 'MACHINERY' AS BIGINT) AS c_mktsegment_machinery FROM customer""")
def _(t):
    return P.one_hot(t.customer.select("c_custkey", "c_mktsegment"), {"c_mktsegment": None})


@query("derive_deltas", """
    SELECT l_orderkey, l_linenumber, round(l_extendedprice - l_discount, 6) AS net,
           date_diff('day', CAST(l_shipdate AS DATE), DATE '2002-01-01') AS days_since,
           round(date_diff('day', CAST(l_shipdate AS DATE), DATE '2002-01-01') / 365.25, 6) AS years
    FROM lineitem""")
def _(t):
    d = P.derive_deltas(t.lineitem, {"net": ("l_extendedprice", "l_discount")}, {"days_since": "l_shipdate"}, "2002-01-01")
    return d.select("l_orderkey", "l_linenumber", r("net").alias("net"), F.col("days_since").cast("bigint").alias("days_since"),
                    r(P.years_since("l_shipdate", "2002-01-01")).alias("years"))


@query("surrogate_key", """
    SELECT o_orderkey, 100 + 10 * (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) AS id FROM orders""")
def _(t):
    return P.surrogate_key(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"],
                           start=100, step=10).select("o_orderkey", F.col("id").cast("bigint").alias("id"))


@query("append_with_keys", """
    WITH old AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS id FROM orders WHERE o_orderstatus <> 'P'),
    new AS (SELECT *, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY o_orderkey) AS id FROM orders WHERE o_orderstatus = 'P')
    SELECT o_orderkey, id FROM old UNION ALL SELECT o_orderkey, id FROM new""")
def _(t):
    o = t.orders.select("o_orderkey", "o_orderstatus")
    old = P.surrogate_key(o.filter("o_orderstatus <> 'P'"), ["o_orderkey"])
    out = P.append_with_keys(old, o.filter("o_orderstatus = 'P'"), ["o_orderkey"])
    return out.select("o_orderkey", F.col("id").cast("bigint").alias("id"))


@query("derived_partition", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS part_day FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-03-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-03-01 00:00:00'""", dates=("part_day",))
def _(t):
    parts = P.derived_partition(t.orders, "o_orderdate")
    return P.filter_derived(parts, "o_orderdate", "1996-03-01 00:00:00", "1997-03-01 00:00:00").select("o_orderkey", "part_day")


@query("geo_distance", """
    WITH p AS (SELECT c_custkey, (c_custkey * 37) % 180 - 90.0 AS lat, (c_custkey * 61) % 360 - 180.0 AS lon FROM customer)
    SELECT c_custkey, round(2 * 6371.0 * asin(least(1.0, sqrt(pow(sin((radians(48.85) - radians(lat)) / 2), 2)
       + cos(radians(lat)) * cos(radians(48.85)) * pow(sin((radians(2.35) - radians(lon)) / 2), 2)))), 4) AS km FROM p""")
def _(t):
    p = t.customer.select("c_custkey", ((F.col("c_custkey") * 37) % 180 - 90.0).alias("lat"),
                          ((F.col("c_custkey") * 61) % 360 - 180.0).alias("lon"))
    return p.select("c_custkey", r(P.geo_distance("lat", "lon", F.lit(48.85), F.lit(2.35)), 4).alias("km"))


@query("count_flags", """
    SELECT l_orderkey, l_linenumber, CAST((l_quantity > 25) AS INTEGER) + CAST((l_discount > 0.05) AS INTEGER)
      + CAST((l_tax > 0.04) AS INTEGER) AS flags FROM lineitem""")
def _(t):
    yes = {f"f{i}": F.when(F.expr(p), "Yes").otherwise("No")
           for i, p in enumerate(["l_quantity > 25", "l_discount > 0.05", "l_tax > 0.04"])}
    return t.lineitem.withColumns(yes).select("l_orderkey", "l_linenumber", P.count_flags(list(yes)).alias("flags"))


_SHARE = "CAST(('0x' || substr(md5({k} || '|42'), 1, 13)) AS BIGINT) / 4503599627370496.0"


@query("split_random", f"""
    WITH s AS (SELECT o_orderkey, {_SHARE.format(k='o_orderkey')} AS share FROM orders)
    SELECT o_orderkey, CASE WHEN share < 0.7 THEN 'train' WHEN share < 0.7 + 0.2 THEN 'validate' ELSE 'test' END AS split FROM s""")
def _(t):
    return P.split_random(t.orders.select("o_orderkey"), {"train": 0.7, "validate": 0.2, "test": 0.1}, ["o_orderkey"])


@query("split_time", """
    SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' ELSE 'test' END AS split FROM orders""")
def _(t):
    return P.split_time(t.orders, "o_orderdate", "1999-01-01").select("o_orderkey", "split")


@query("sample_rows", f"SELECT event_id FROM events WHERE {_SHARE.format(k='event_id')} < 0.1")
def _(t):
    return P.sample_rows(t.events.select("event_id"), ["event_id"], fraction=0.1)


@query("sample_per_group", f"""
    SELECT event_id, hour FROM (SELECT event_id, date_trunc('hour', ts) AS hour,
      row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY {_SHARE.format(k='event_id')}, event_id) AS rn FROM events)
    WHERE rn <= 5""")
def _(t):
    e = t.events.select("event_id", F.date_trunc("hour", "ts").alias("hour"))
    return P.sample_rows(e, ["event_id"], per_group=5, groups=["hour"])


@query("rebalance", f"""
    WITH c AS (SELECT count(*) FILTER (toxic = 1) AS few, count(*) FILTER (toxic <> 1) AS many FROM labels),
    s AS (SELECT least(1.0, 1.5 * 2 * few / many) AS share FROM c)
    SELECT doc_id, toxic FROM labels, range(2) WHERE toxic = 1
    UNION ALL SELECT doc_id, toxic FROM labels WHERE toxic <> 1 AND {_SHARE.format(k='doc_id')} < (SELECT share FROM s)""")
def _(t):
    return P.rebalance(t.labels.select("doc_id", "toxic"), "toxic", ["doc_id"], 1, copies=2, ratio=1.5)


@query("balanced_weights", """
    WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
    SELECT doc_id, l.quality, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * c.n), 6) AS weight
    FROM labels l JOIN c ON l.quality = c.quality""")
def _(t):
    return P.balanced_weights(t.labels, "quality").select("doc_id", "quality", r("weight").alias("weight"))


@query("melt_counts", """
    WITH c AS (SELECT l_returnflag, count(*) FILTER (l_quantity > 10) AS passed, count(*) FILTER (l_quantity <= 10) AS failed
               FROM lineitem GROUP BY 1)
    SELECT l_returnflag, 'passed' AS kind, passed AS n FROM c UNION ALL SELECT l_returnflag, 'failed', failed FROM c""")
def _(t):
    c = A.conditional_counts(t.lineitem, ["l_returnflag"], {"passed": "l_quantity > 10", "failed": "l_quantity <= 10"})
    return P.melt_counts(c, ["l_returnflag"], ["passed", "failed"])


@query("pandas_frame", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(t):
    frame = P.pandas_frame(t.events.select("event_id", "event_type"))
    counts = frame.groupby("event_type").size().reset_index(name="n")
    return counts.to_spark()


@query("secure_encode", """
    SELECT c_custkey, c_name AS plain, c_mktsegment = 'BUILDING' AS encoded FROM customer""")
def _(t):
    key = "0123456789abcdef"
    hot = F.col("c_mktsegment") == "BUILDING"
    enc = P.secure_encode(t.customer, "c_name", key, hot, out="secret")
    enc = enc.withColumn("encoded", F.col("secret") != F.col("c_name"))
    return P.secure_decode(enc, "secret", key, hot).select("c_custkey", F.col("secret").alias("plain"), "encoded")


@query("build_cohort", """
    SELECT 1 AS cohort_id, 'urgent buyers' AS cohort_name, o_custkey, min(o_orderdate) AS cohort_start, max(o_orderdate) AS cohort_end
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY o_custkey""")
def _(t):
    return P.build_cohort(t.orders, "o_custkey", "o_orderpriority", "o_orderdate", ["1-URGENT", "2-HIGH"], 1, "urgent buyers")


# ---- joins ----------------------------------------------------------------

@query("join_using", """
    SELECT o_orderkey, count(*) AS lines, round(sum(l_quantity), 4) AS qty FROM orders
    JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    return J.join_using(t.orders.select("o_orderkey"), [lines], "o_orderkey").groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), r(F.sum("l_quantity"), 4).alias("qty"))


@query("join_left", """
    SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def _(t):
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return J.join_left(t.customer.select("c_custkey"), o, "c_custkey")


@query("join_twice", """
    SELECT cn.n_name AS buyer_n_name, sn.n_name AS seller_n_name, count(*) AS n, round(sum(l_extendedprice), 2) AS amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation cn ON c_nationkey = cn.n_nationkey
    JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY 1, 2""")
def _(t):
    l = t.lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice")
    f = l.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    f = f.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    f = f.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    f = J.join_twice(f, t.nation.select("n_nationkey", "n_name"), "n_nationkey", {"buyer": "c_nationkey", "seller": "s_nationkey"})
    return f.groupBy("buyer_n_name", "seller_n_name").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("l_extendedprice"), 2).alias("amount"))


@query("join_full", """
    WITH a AS (SELECT user_id, event_type, count(*) AS early FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1, 2),
    b AS (SELECT user_id, event_type, count(*) AS late FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1, 2)
    SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.event_type, b.event_type) AS event_type,
      coalesce(early, 0) AS early, coalesce(late, 0) AS late FROM a FULL JOIN b ON a.user_id = b.user_id AND a.event_type = b.event_type""")
def _(t):
    a = t.events.filter("ts < '2024-01-10'").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("early"))
    b = t.events.filter("ts >= '2024-01-20'").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("late"))
    return J.join_full(a, b, ["user_id", "event_type"]).fillna(0, ["early", "late"])


@query("join_semi", """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def _(t):
    rich = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return J.join_semi(t.customer.select("c_custkey", "c_name"), rich, "c_custkey")


@query("join_cross_scalar", """
    SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), CAST(m AS DATE)) AS age, round(o_totalprice / s, 10) AS part
    FROM orders, (SELECT max(o_orderdate) AS m, sum(o_totalprice) AS s FROM orders)""")
def _(t):
    top = t.orders.agg(F.max("o_orderdate").alias("m"), F.sum("o_totalprice").alias("s"))
    return J.attach_scalars(t.orders, top).select(
        "o_orderkey", F.datediff("m", "o_orderdate").cast("bigint").alias("age"), r(F.col("o_totalprice") / F.col("s"), 10).alias("part"))


_PRICES = """
    prices AS (SELECT l_suppkey AS suppkey, CAST(date_trunc('quarter', l_shipdate) AS TIMESTAMP) AS valid_from,
                      round(max(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1, 2),
    spans AS (SELECT suppkey, price, valid_from,
                     lead(valid_from) OVER (PARTITION BY suppkey ORDER BY valid_from) AS valid_to FROM prices)"""


def _price_spans(t):
    """Price intervals per supplier: one per quarter, the last one open."""
    prices = t.lineitem.groupBy(
        F.col("l_suppkey").alias("suppkey"), F.date_trunc("quarter", "l_shipdate").alias("valid_from")
    ).agg(F.round(F.max("l_extendedprice"), 2).alias("price"))
    return W.neighbour_values(prices, ["suppkey"], ["valid_from"], B.epoch_micros("valid_from"),
                              {"valid_to": ("valid_from", -1)})


@query("join_range", f"""
    WITH {_PRICES}
    SELECT l_orderkey, l_linenumber, price FROM lineitem JOIN spans ON l_suppkey = suppkey AND l_shipdate >= valid_from
      AND (valid_to IS NULL OR l_shipdate < valid_to)""")
def _(t):
    facts = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("suppkey"), "l_shipdate")
    return J.join_range(facts, _price_spans(t), ["suppkey"], "l_shipdate", "valid_from", "valid_to").select("l_orderkey", "l_linenumber", "price")


@query("join_theta_min", """
    SELECT s.event_id, s.user_id, min(e.ts) AS next_purchase FROM events s JOIN events e
      ON s.user_id = e.user_id AND e.ts >= s.ts AND e.event_type = 'purchase'
    WHERE s.event_type = 'view' GROUP BY 1, 2""")
def _(t):
    starts = t.events.filter("event_type = 'view'").select("event_id", "user_id", "ts")
    ends = t.events.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("next_purchase"))
    return J.next_end(starts, ends, ["user_id"], "ts", "next_purchase").select("event_id", "user_id", "next_purchase")


@query("join_same_start", """
    SELECT a.o_custkey, a.o_orderdate, min(a.o_orderkey) AS o_orderkey, max(b.o_totalprice) AS o_totalprice, count(*) AS pairs
    FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderdate = b.o_orderdate GROUP BY 1, 2""")
def _(t):
    return J.same_start_spans(t.orders, ["o_custkey"], "o_orderdate", "o_totalprice", "o_orderkey")


_ASOF = """
    SELECT o_orderkey, o_custkey, o_at, e.ts AS ts, e.value FROM (
       SELECT o_orderkey, o_custkey, TIMESTAMP '2024-01-01' + to_seconds((o_orderkey * 7919) % 2592000) AS o_at FROM orders) o
    {how} JOIN (SELECT user_id, ts, max_by(value, event_id) AS value FROM events GROUP BY 1, 2) e
      ON o_custkey = e.user_id AND o_at {op} e.ts"""


def _labelled_orders(t):
    """Orders with a made-up decision time inside the month the events cover."""
    at = F.timestamp_add("SECOND", (F.col("o_orderkey") * 7919) % 2592000, F.lit("2024-01-01").cast("timestamp_ntz"))
    return t.orders.select("o_orderkey", "o_custkey", at.alias("o_at"))


def _features(t):
    return t.events.select(F.col("user_id").alias("o_custkey"), "ts", "event_id", "value")


@query("join_asof", _ASOF.format(how="ASOF LEFT", op=">="))
def _(t):
    return J.join_asof(_labelled_orders(t), _features(t), ["o_custkey"], "o_at", "ts", ["value"], tie="event_id")


@query("join_asof_lookback", "SELECT o_orderkey, o_custkey, o_at, CASE WHEN o_at - ts <= INTERVAL 2 DAY THEN ts END AS ts, "
       "CASE WHEN o_at - ts <= INTERVAL 2 DAY THEN value END AS value FROM (" + _ASOF.format(how="ASOF LEFT", op=">=") + ")")
def _(t):
    return J.join_asof(_labelled_orders(t), _features(t), ["o_custkey"], "o_at", "ts", ["value"], tie="event_id",
                       lookback_seconds=2 * DAY)


_VOCAB = """
    concept AS (SELECT p_partkey AS concept_id, p_name || '#' || p_partkey AS concept_code,
        CASE WHEN p_partkey % 2 = 1 THEN 'local' ELSE 'standard' END AS vocabulary_id,
        CASE WHEN p_size < 25 THEN 'small' ELSE 'large' END AS domain_id,
        CASE WHEN p_partkey % 2 = 0 THEN 'S' END AS standard_concept,
        CASE WHEN p_partkey % 11 = 0 THEN 'D' END AS invalid_reason FROM part),
    relation AS (SELECT p_partkey AS concept_id_1, p_partkey + 1 AS concept_id_2, 'Maps To' AS relationship_id,
        CASE WHEN p_partkey % 13 = 0 THEN 'D' END AS invalid_reason FROM part WHERE p_partkey % 2 = 1)"""


def _vocabulary(t):
    k = F.col("p_partkey")
    concept = t.part.select(
        k.alias("concept_id"), F.concat("p_name", F.lit("#"), k.cast("string")).alias("concept_code"),
        F.when(k % 2 == 1, "local").otherwise("standard").alias("vocabulary_id"),
        F.when(F.col("p_size") < 25, "small").otherwise("large").alias("domain_id"),
        F.when(k % 2 == 0, "S").alias("standard_concept"), F.when(k % 11 == 0, "D").alias("invalid_reason"))
    relation = t.part.filter(k % 2 == 1).select(
        k.alias("concept_id_1"), (k + 1).alias("concept_id_2"), F.lit("Maps To").alias("relationship_id"),
        F.when(k % 13 == 0, "D").alias("invalid_reason"))
    return concept, relation


@query("map_codes", f"""
    WITH {_VOCAB}
    SELECT l_orderkey, l_linenumber, coalesce(c.concept_id, 0) AS source_concept_id, coalesce(s.target, 0) AS target_concept_id
    FROM (SELECT l_orderkey, l_linenumber, p_name || '#' || p_partkey AS code FROM lineitem JOIN part ON l_partkey = p_partkey)
    LEFT JOIN concept c ON code = c.concept_code AND c.vocabulary_id = 'local'
    LEFT JOIN (SELECT a.concept_code, b.concept_id AS target FROM concept a JOIN relation ON a.concept_id = concept_id_1
          AND relation.invalid_reason IS NULL JOIN concept b ON b.concept_id = concept_id_2
        WHERE a.vocabulary_id = 'local' AND b.invalid_reason IS NULL AND b.standard_concept = 'S' AND b.domain_id = 'small') s
      ON code = s.concept_code""")
def _(t):
    concept, relation = _vocabulary(t)
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"),
                          F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string")).alias("code"))
    source = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(parts, "l_partkey")
    return J.map_codes(source, concept, relation, "code", "local", "small").select(
        "l_orderkey", "l_linenumber", "source_concept_id", "target_concept_id")


@query("join_files_labels", """
    SELECT page_id, split_part(url, '/', -1) AS file_name, quality FROM pages
    JOIN (SELECT DISTINCT split_part(url, '/', -1) AS f, page_id AS p, page_id % 2 AS quality FROM pages) ON f = split_part(url, '/', -1)
      AND p = page_id""")
def _(t):
    labels = t.pages.select(F.substring_index("url", "/", -1).alias("file_name"), F.col("page_id").alias("label_id"),
                            (F.col("page_id") % 2).alias("quality")).distinct()
    files = t.pages.select("page_id", F.col("url").alias("path"))
    return J.join_files_labels(files, labels).filter("page_id = label_id").select("page_id", "file_name", "quality")
