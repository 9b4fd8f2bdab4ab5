"""The end-to-end jobs as named queries, with the test tables read in the jobs' shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks as B
from ..operators.quality import Rule
from ..session import scratch_path
from . import jobs
from .catalog import query
from .change_queries import _AUDIT, _log, audit_log
from .core_queries import _VOCAB, _price_spans, _vocabulary, r
from .ingest_queries import _GAP, ntz
from .text_queries import _SHARE, _pairs

DAY = B.DAY
MICRO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def land(t, frames):
    """Write frames as raw JSON folders, as an outside system would drop them."""
    raw = scratch_path(t.spark, "raw")
    for name, df in frames.items():
        df.write.option("timestampFormat", MICRO_FORMAT).json(f"{raw}/{name}")
    return raw


@query("customer_360", """
    WITH u AS (SELECT c_custkey AS user_id, sha1(c_name) AS name_hash FROM customer WHERE c_custkey % 50 > 0),
    o AS (SELECT o_custkey AS user_id, count(*) AS order_count, round(sum(o_totalprice), 2) AS total_amount, max(o_orderdate) AS last_transaction
          FROM orders WHERE o_orderkey > 0 GROUP BY 1),
    e AS (SELECT user_id, count(*) AS event_count, count(DISTINCT CAST(ts AS DATE)) AS session_count,
          arg_min(event_type, struct_pack(ts, event_id)) AS first_platform FROM events WHERE user_id > 0 GROUP BY 1)
    SELECT user_id, name_hash, order_count, total_amount, event_count, session_count, first_platform,
      date_diff('day', CAST(last_transaction AS DATE), DATE '2024-02-01') AS days_since_last_transaction,
      round(1 / (1 + exp(-(0.3 + 0.01 * order_count - 0.02 * event_count))), 6) AS churn_score
    FROM u JOIN o USING (user_id) JOIN e USING (user_id)""")
def _(t):
    """Raw JSON files to a stored and scored customer profile."""
    k = F.col("c_custkey")
    created = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 3000).cast("int")), "MM-dd-yyyy HH:mm:ss")
    raw = land(t, {
        "users": t.customer.select(F.when(k % 50 > 0, k).alias("id"), F.col("c_name").alias("name"),
                                   F.col("c_mktsegment").alias("segment"), created.alias("creation_date")),
        "orders": t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                                  F.col("o_orderdate").cast("timestamp").alias("transaction_date"), F.col("o_totalprice").cast("string").alias("amount")),
        "events": t.events.select("user_id", "event_id", F.col("event_type").alias("platform"), F.col("ts").cast("timestamp").alias("date"),
                                  F.col("ts").cast("date").cast("string").alias("session_id")),
    })
    base = scratch_path(t.spark, "customer-360")
    bronze = jobs.load_bronze(t.spark, raw, base, {
        "users": "id bigint, name string, segment string, creation_date string",
        "orders": "order_id bigint, user_id bigint, transaction_date timestamp, amount string",
        "events": "user_id bigint, event_id bigint, platform string, date timestamp, session_id string",
    })
    out = jobs.customer_360(bronze, base, "2024-02-01", {"order_count": 0.01, "event_count": -0.02}, 0.3)["profile"]
    return out.select("user_id", "name_hash", "order_count", r("total_amount", 2).alias("total_amount"), "event_count", "session_count",
                      "first_platform", F.col("days_since_last_transaction").cast("bigint").alias("days_since_last_transaction"),
                      r("churn_score").alias("churn_score"))


_ENC = """enc AS (SELECT event_id AS encounter_id, user_id AS patient,
      CASE event_type WHEN 'purchase' THEN 'inpatient' WHEN 'error' THEN 'emergency' ELSE 'outpatient' END AS class, ts AS start,
      ts + to_hours(CAST(CASE WHEN event_type = 'purchase' THEN event_id % 30 ELSE event_id % 5 END AS INTEGER)) AS stop FROM events)"""


@query("clinical_visits", f"""
    WITH {_ENC}, {_VOCAB},
    inp AS (SELECT patient, class, min(start) AS start, max(stop) AS stop FROM (
      SELECT *, sum(opens) OVER (PARTITION BY patient ORDER BY start, stop, encounter_id ROWS UNBOUNDED PRECEDING) AS g FROM (
        SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY patient ORDER BY start, stop, encounter_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
          + INTERVAL 1 DAY THEN 0 ELSE 1 END AS opens FROM enc WHERE class = 'inpatient')) GROUP BY patient, class, g),
    visits AS (SELECT patient, class, start, stop FROM inp UNION ALL SELECT patient, class, start, max(stop) FROM enc WHERE class <> 'inpatient' GROUP BY 1, 2, 3),
    best AS (SELECT e.encounter_id, v.class AS visit_class, v.start AS visit_start FROM enc e JOIN visits v ON v.patient = e.patient AND e.start BETWEEN v.start AND v.stop
      AND CASE WHEN e.class = 'inpatient' AND v.class = 'inpatient' THEN 1 WHEN e.class = 'emergency' AND v.class = 'inpatient' AND e.start > v.start THEN 1
        WHEN e.class = 'emergency' AND v.class = 'emergency' AND e.start = v.start THEN 2 WHEN e.class = 'outpatient' AND v.class = 'inpatient' THEN 1
        WHEN e.class = 'outpatient' AND v.class = 'outpatient' THEN 2 END IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY e.encounter_id ORDER BY CASE WHEN v.class = 'inpatient' THEN 1 ELSE 2 END, v.start, v.stop) = 1)
    SELECT event_id AS condition_id, coalesce(c.concept_id, 0) AS source_concept_id, coalesce(s.target, 0) AS target_concept_id, visit_class, visit_start
    FROM events LEFT JOIN part ON p_partkey = 1 + event_id % 200
    LEFT JOIN concept c ON c.concept_code = p_name || '#' || p_partkey AND c.vocabulary_id = 'local'
    LEFT JOIN (SELECT a.concept_code, b.concept_id AS target FROM concept a JOIN relation ON a.concept_id = concept_id_1 AND relation.invalid_reason IS NULL
      JOIN concept b ON b.concept_id = concept_id_2 WHERE a.vocabulary_id = 'local' AND b.invalid_reason IS NULL AND b.standard_concept = 'S') s
      ON s.concept_code = p_name || '#' || p_partkey
    LEFT JOIN best ON best.encounter_id = event_id""")
def _(t):
    kind = F.when(F.col("event_type") == "purchase", "inpatient").when(F.col("event_type") == "error", "emergency").otherwise("outpatient")
    hours = F.when(F.col("event_type") == "purchase", F.col("event_id") % 30).otherwise(F.col("event_id") % 5).cast("int")
    enc = t.events.select(F.col("event_id").alias("encounter_id"), F.col("user_id").alias("patient"), kind.alias("class"),
                          F.col("ts").alias("start"), F.timestamp_add("HOUR", hours, F.col("ts")).alias("stop"))
    codes = t.part.select(F.col("p_partkey").alias("k"), F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string")).alias("code"))
    cond = t.events.select(F.col("event_id").alias("condition_id"), F.col("event_id").alias("encounter_id"), (1 + F.col("event_id") % 200).alias("k"))
    out = jobs.clinical_visits(enc, cond.join(codes, "k", "left"), *_vocabulary(t))
    visits = out["visits"].select("visit_id", F.col("class").alias("visit_class"), F.col("start").alias("visit_start"))
    return out["conditions"].join(visits, "visit_id", "left").select(
        "condition_id", "source_concept_id", "target_concept_id", "visit_class", "visit_start")


@query("readmission_training", """
    WITH v AS (SELECT o_orderkey AS visit_id, o_custkey AS patient, o_orderdate AS start, o_orderdate + to_days(CAST(o_orderkey % 10 AS INTEGER)) AS stop FROM orders)
    SELECT visit_id, (o_orderkey_days * 24)::DOUBLE AS length_hours, readmitted, seg_building, seg_machinery FROM (
      SELECT visit_id, visit_id % 10 AS o_orderkey_days, CAST(c_mktsegment = 'BUILDING' AS BIGINT) AS seg_building, CAST(c_mktsegment = 'MACHINERY' AS BIGINT) AS seg_machinery,
        CAST(coalesce(start - lag(stop) OVER (PARTITION BY patient ORDER BY start, visit_id) < INTERVAL 30 DAY, false) AS INTEGER) AS readmitted
      FROM v JOIN customer ON c_custkey = patient)""")
def _(t):
    visits = t.orders.select(F.col("o_orderkey").alias("visit_id"), F.col("o_custkey").alias("patient"), F.col("o_orderdate").alias("start"),
                             F.timestamp_add("DAY", (F.col("o_orderkey") % 10).cast("int"), F.col("o_orderdate")).alias("stop"))
    patients = t.customer.select(F.col("c_custkey").alias("patient"), F.col("c_mktsegment").alias("seg"))
    return jobs.readmission_training(visits, patients.unionByName(patients), {"seg": ["BUILDING", "MACHINERY"]})


def _credit_sql(role, key, months):
    parts = [f"count(*) FILTER (d >= m - INTERVAL {n} MONTH) AS {role}_cnt_{n}m, round(coalesce(sum(amount) FILTER (d >= m - INTERVAL {n} MONTH), 0), 2) AS {role}_amt_{n}m"
             for n in months]
    return f"SELECT {key} AS cust_id, {', '.join(parts)} FROM tr, mx WHERE d >= m - INTERVAL 12 MONTH GROUP BY 1"


@query("credit_features", f"""
    WITH acc AS (SELECT c_custkey AS account_id, c_custkey - c_custkey % 2 AS cust_id, c_acctbal AS balance FROM customer),
    tr AS (SELECT p.cust_id AS payer, q.cust_id AS payee, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS d FROM orders
      JOIN acc p ON p.account_id = o_custkey JOIN acc q ON q.account_id = 1 + (o_custkey * 7 + o_orderkey) % 100),
    mx AS (SELECT max(d) AS m FROM tr), s AS ({_credit_sql('sent', 'payer', (12, 3))}), g AS ({_credit_sql('rcvd', 'payee', (12, 3))}),
    b AS (SELECT cust_id, round(sum(balance), 2) AS balance, count(*) AS accounts FROM acc GROUP BY 1)
    SELECT c_custkey AS cust_id, coalesce(b.balance, 0) AS balance, coalesce(accounts, 0) AS accounts, coalesce(sent_cnt_12m, 0) AS sent_cnt_12m,
      coalesce(sent_amt_12m, 0) AS sent_amt_12m, coalesce(sent_cnt_3m, 0) AS sent_cnt_3m, coalesce(rcvd_cnt_12m, 0) AS rcvd_cnt_12m,
      coalesce(rcvd_amt_3m, 0) AS rcvd_amt_3m, round(coalesce(sent_amt_3m / nullif(sent_amt_12m, 0), 0), 6) AS sent_ratio_3m_12m
    FROM customer LEFT JOIN b ON b.cust_id = c_custkey LEFT JOIN s ON s.cust_id = c_custkey LEFT JOIN g ON g.cust_id = c_custkey""")
def _(t):
    k = F.col("c_custkey")
    customers = t.customer.select(k.alias("cust_id"), "c_mktsegment")
    accounts = t.customer.select(k.alias("account_id"), (k - k % 2).alias("cust_id"), F.col("c_acctbal").alias("balance"))
    transfers = t.orders.select(F.col("o_custkey").alias("payer"), (1 + (F.col("o_custkey") * 7 + F.col("o_orderkey")) % 100).alias("payee"),
                                F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("at"))
    out = jobs.credit_features(customers, accounts, transfers, scratch_path(t.spark, "credit"))
    return out.select("cust_id", r("balance", 2).alias("balance"), "accounts", "sent_cnt_12m", r("sent_amt_12m", 2).alias("sent_amt_12m"), "sent_cnt_3m",
                      "rcvd_cnt_12m", r("rcvd_amt_3m", 2).alias("rcvd_amt_3m"), r("sent_ratio_3m_12m").alias("sent_ratio_3m_12m"))


@query("fraud_gold", """
    SELECT o.n_name AS country_orig, d.n_name AS country_dest, least(o.n_name, d.n_name) || '-' || greatest(o.n_name, d.n_name) AS pair,
      round(sum(o_totalprice), 2) AS amount, count(*) AS n, count(*) FILTER (o_orderkey % 20 = 0) AS frauds
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation o ON o.n_nationkey = c_nationkey JOIN nation d ON d.n_nationkey = o_orderkey % 25
    GROUP BY 1, 2 ORDER BY sum(o_totalprice) DESC, 1, 2 LIMIT 20""")
def _(t):
    names = t.nation.select(F.col("n_nationkey").alias("k"), F.concat(F.lit("--"), "n_name").alias("n"))
    tx = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        names.withColumnsRenamed({"k": "k1", "n": "country_orig"}), F.col("c_nationkey") == F.col("k1")).join(
        names.withColumnsRenamed({"k": "k2", "n": "country_dest"}), F.col("o_orderkey") % 25 == F.col("k2"))
    tx = tx.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"), "country_orig", "country_dest",
                   F.col("c_acctbal").alias("old_balance_orig"), (F.col("c_acctbal") - F.col("o_totalprice")).alias("new_balance_orig"),
                   F.lit(0.0).alias("old_balance_dest"), F.col("o_totalprice").alias("new_balance_dest"))
    reports = t.orders.filter("o_orderkey % 20 = 0").select(F.col("o_orderkey").alias("id"), F.lit(1).alias("is_fraud"))
    countries = t.nation.select(F.col("n_name").alias("code"), F.col("n_regionkey").alias("region"))
    users = t.customer.select(F.col("c_custkey").alias("customer_id"), "c_mktsegment")
    return jobs.fraud_gold(tx, reports, countries, users)["flows"].withColumn("amount", r("amount", 2))


@query("claims", """
    SELECT l_orderkey || '-' || l_linenumber AS claim_no, CAST(CAST(floor(datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) / 30.0) AS BIGINT) AS VARCHAR) AS months_waited,
      CASE WHEN l_tax = 0 THEN 'exempt' ELSE CAST(CAST(round(100 * l_tax, 0) AS BIGINT) AS VARCHAR) END AS tax_percent,
      'Q' || quarter(l_shipdate) AS season,
      CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'front desk' WHEN quarter(l_shipdate) = 4 THEN 'year end team' ELSE 'queue ' || l_linenumber % 3 END AS desk
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_extendedprice > 0""")
def _(t):
    claim = t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("claim_no"), F.col("l_orderkey").alias("policy_no"), F.col("l_linenumber").alias("part"),
        F.col("l_shipdate").cast("date").alias("claim_date"), F.struct(F.col("l_extendedprice").alias("total"), F.col("l_tax").alias("tax")).alias("amount"))
    day = F.col("o_orderdate").cast("date")
    pol = t.orders.select(F.col("o_orderkey").alias("policy_no"), F.col("o_custkey").alias("chassis"), F.col("o_orderpriority").alias("product"),
                          (-F.col("o_totalprice") / 12).alias("premium"), day.alias("begins"), F.date_add(day, 365).alias("ends"))
    speed = t.events.select(F.col("user_id").alias("chassis"), F.col("value").alias("speed"))
    # how long a claim took, how it is taxed, when it fell, and which desk takes it
    rules = t.spark.createDataFrame([
        (10, "months_waited", "CAST(CAST(floor(datediff(claim_date, begins) / 30.0) AS BIGINT) AS STRING)", True),
        (20, "tax_percent", "CASE WHEN amount_tax = 0 THEN 'exempt' ELSE CAST(CAST(round(100 * amount_tax, 0) AS BIGINT) AS STRING) END", True),
        (30, "season", "concat('Q', quarter(claim_date))", True),
        (40, "desk", "CASE WHEN left(product, 1) IN ('1', '2') THEN 'front desk' WHEN season = 'Q4' THEN 'year end team' ELSE concat('queue ', part % 3) END", True),
        (50, "unused", "1 / 0", False),
    ], "rule_id int, check_name string, check_code string, is_active boolean")
    out = jobs.claims(claim, pol, speed, rules, "1998-01-01", "1998-12-31")
    return out["insights"].select("claim_no", "months_waited", "tax_percent", "season", "desk")


@query("turbine_features", """
    WITH h AS (SELECT event_type AS turbine, date_trunc('hour', ts) AS window_start, avg(value) AS m FROM events WHERE value >= 0 GROUP BY 1, 2),
    st AS (SELECT DISTINCT event_type AS turbine, date_trunc('week', ts) AS start_time, date_trunc('week', ts) + INTERVAL 7 DAY AS end_time,
      CASE WHEN week(ts) % 2 = 0 THEN 'ok' ELSE 'sensor_B' END AS abnormal FROM events)
    SELECT h.turbine, window_start, round(m, 6) AS avg_value, abnormal, 'place ' || h.turbine AS location FROM h JOIN st ON st.turbine = h.turbine
      AND window_start >= start_time AND window_start < end_time QUALIFY row_number() OVER (PARTITION BY h.turbine ORDER BY window_start DESC) = 1""")
def _(t):
    readings = t.events.select(F.col("event_type").alias("turbine"), "ts", "value")
    week = F.date_trunc("week", "ts")
    status = readings.select("turbine", week.alias("start_time"), F.timestamp_add("DAY", F.lit(7), week).alias("end_time"),
                             F.when(F.weekofyear("ts") % 2 == 0, "ok").otherwise("sensor_B").alias("abnormal")).distinct()
    turbines = readings.select("turbine").distinct().withColumn("location", F.concat(F.lit("place "), "turbine"))
    cur = jobs.turbine_features(readings, status, turbines, ["value"])["current"]
    return ntz(cur.select("turbine", "window_start", r("avg_value").alias("avg_value"), "abnormal", "location"), "window_start")


@query("loan_quality", """
    WITH o AS (SELECT o_totalprice - 50000 AS balance, 'n' || o_custkey % 25 AS location, month(o_orderdate) <= 2 AS winter, o_custkey % 25 = 24 AS far, o_orderdate >= TIMESTAMP '1998-01-01' AS is_new,
      o_totalprice, substr(o_orderpriority, 1, 1) = '3' AS middling FROM orders),
    n AS (SELECT *, winter OR far AS bad FROM o WHERE is_new)
    SELECT part, location, CAST(coalesce(n, 0) AS BIGINT) AS n, coalesce(amount, 0.0::DOUBLE) AS amount FROM (
      SELECT 'total' AS part, location, NULL AS n, round(sum(balance), 2) AS amount FROM n WHERE NOT bad GROUP BY location
      UNION SELECT 'total', location, NULL, round(sum(o_totalprice), 2) FROM o WHERE NOT is_new GROUP BY location
      UNION ALL SELECT 'clean', location, count(*), NULL FROM n WHERE NOT bad GROUP BY location
      UNION ALL SELECT 'quarantine', location, count(*), NULL FROM n WHERE bad GROUP BY location
      UNION ALL SELECT 'failed outside_winter', 'cleaned', count(*) FILTER (WHERE winter), NULL FROM n
      UNION ALL SELECT 'failed near', 'cleaned', count(*) FILTER (WHERE far), NULL FROM n
      UNION ALL SELECT 'failed not_middling', 'cleaned', count(*) FILTER (WHERE middling), NULL FROM n
      UNION ALL SELECT 'failed known_kind', 'cleaned', 0, NULL)""")
def _(t):
    o = t.orders.select(F.col("o_orderdate").cast("date").alias("next_payment_date"), F.col("o_totalprice"), "o_orderdate",
                        F.concat(F.lit("n"), F.col("o_custkey") % 25).alias("location"), F.col("o_orderpriority").alias("cost_center"),
                        (F.col("o_orderkey") % 3).alias("treatment_id"))
    new = o.filter("o_orderdate >= '1998-01-01'").withColumns({"balance": F.col("o_totalprice") - 50000, "arrears": F.lit(1.0)})
    old = o.filter("o_orderdate < '1998-01-01'").withColumn("balance", F.col("o_totalprice"))
    rules = [Rule("near", "location <> 'n24'", "drop"), Rule("known_kind", "treatment LIKE 't_'", "fail"),
             Rule("not_middling", "NOT startswith(cost_center, '3')"), Rule("outside_winter", "month(next_payment_date) > 2", "drop")]
    kinds = t.orders.select((F.col("o_orderkey") % 3).alias("treatment_id")).distinct().withColumn("treatment", F.concat(F.lit("t"), "treatment_id"))
    out = jobs.loan_quality(new, old, kinds, rules, "u1", "2024-01-01")
    counted = [out[p].groupBy("location").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(p)) for p in ("clean", "quarantine")]
    report = out["report"].select(F.concat(F.lit("failed "), "rule").alias("part"), F.col("table_name").alias("location"), F.col("failed").alias("n"))
    shown = out["totals"].select(F.lit("total").alias("part"), "location", r("balance", 2).alias("amount"))
    for more in (*counted, report):
        shown = shown.unionByName(more, allowMissingColumns=True)
    return shown.fillna(0).select("part", "location", F.col("n").cast("bigint").alias("n"), "amount")


def _cdc(t):
    """The job over two drops of change files, the second with late rows, updates and deletes, then once more with nothing new."""
    base, raw = scratch_path(t.spark, "cdc"), scratch_path(t.spark, "raw")
    log = _log(t).drop("changed")

    def load():
        return jobs.cdc_sync(t.spark, raw, base, "id bigint, seq bigint, priority string, amount double, operation string", ["id"], "seq", F.col("seq"))

    log.filter("seq % 3 > 0").write.json(f"{raw}/changes")
    load()
    log.filter("seq % 3 = 0").write.mode("append").json(f"{raw}/changes")
    load()
    return load()


_CDC = """(SELECT o_custkey AS id, o_orderkey AS seq, o_orderpriority AS priority, o_totalprice AS amount, o_orderkey % 17 = 0 AS gone FROM orders)"""


@query("cdc_sync", """
    SELECT o_custkey AS id, o_orderpriority AS priority, o_totalprice AS amount FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1 AND o_orderkey % 17 <> 0""")
def _(t):
    return _cdc(t)["gold"].select("id", "priority", "amount")


@query("cdc_sync_tables", f"""
    WITH newest AS (SELECT * FROM {_CDC} QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1),
    old AS (SELECT * FROM (SELECT * FROM {_CDC} WHERE seq % 3 > 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1) WHERE NOT gone),
    new AS (SELECT * FROM newest WHERE NOT gone),
    steps AS (SELECT *, lag(CASE WHEN gone THEN 'gone' ELSE 'row ' || coalesce(priority, '') || amount END) OVER (PARTITION BY id ORDER BY seq) AS prev FROM {_CDC}),
    spans AS (SELECT *, lead(seq) OVER (PARTITION BY id ORDER BY seq) AS nxt FROM steps
              WHERE prev IS NULL OR prev <> CASE WHEN gone THEN 'gone' ELSE 'row ' || coalesce(priority, '') || amount END)
    SELECT 'current' AS part, id, priority, amount, 0 AS start, 0 AS stop FROM new
    UNION ALL SELECT 'history', id, priority, amount, seq, coalesce(nxt, 0) FROM spans WHERE NOT gone
    UNION ALL SELECT 'insert', id, priority, amount, 1, 0 FROM old
    UNION ALL SELECT 'insert', n.id, n.priority, n.amount, 1, 0 FROM new n ANTI JOIN old o USING (id)
    UNION ALL SELECT 'delete', o.id, o.priority, o.amount, 2, 0 FROM old o ANTI JOIN new n USING (id)
    UNION ALL SELECT 'update_preimage', o.id, o.priority, o.amount, 2, 0 FROM old o JOIN new n USING (id) WHERE (o.priority, o.amount) IS DISTINCT FROM (n.priority, n.amount)
    UNION ALL SELECT 'update_postimage', n.id, n.priority, n.amount, 2, 0 FROM old o JOIN new n USING (id) WHERE (o.priority, o.amount) IS DISTINCT FROM (n.priority, n.amount)""")
def _(t):
    """Current rows, history spans and the feed of all loads (``start`` is the version there) in one frame."""
    out = _cdc(t)
    zero = F.lit(0).cast("bigint")
    parts = [
        out["current"].select(F.lit("current").alias("part"), "id", "priority", "amount", zero.alias("start"), zero.alias("stop")),
        out["history"].select(F.lit("history").alias("part"), "id", "priority", "amount", F.col("__START_AT").alias("start"), F.coalesce("__END_AT", zero).alias("stop")),
        out["feed"].select(F.col("_change_type").alias("part"), "id", "priority", "amount", F.col("_commit_version").alias("start"), zero.alias("stop")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("clickstream_sessions", f"""
    WITH e AS (SELECT event_id, user_id, date_trunc('second', ts) AS ts FROM events WHERE event_id % 50 > 0)
    SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS click_count FROM (
      SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (
        SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL {_GAP} SECOND THEN 0 ELSE 1 END AS opens FROM e))
    GROUP BY user_id, s HAVING max(ts) + INTERVAL {_GAP} SECOND <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM e)""")
def _(t):
    e = t.events
    message = F.to_json(F.struct(F.when(e.event_id % 50 > 0, e.event_id).alias("event_id"), "user_id", F.col("event_type").alias("action"),
                                 F.unix_seconds(F.col("ts").cast("timestamp")).alias("event_date")))
    lines = e.select("ts", "event_id", message.alias("value"))
    lines = lines.unionByName(lines.filter("event_id % 10 = 0"))
    raw = scratch_path(t.spark, "messages")
    stamp = F.unix_micros(F.col("ts").cast("timestamp"))
    bounds = lines.agg(F.min(stamp), F.max(stamp)).first()
    base = scratch_path(t.spark, "clicks")
    for i in range(2):
        half = F.floor((stamp - bounds[0]) / ((bounds[1] - bounds[0]) // 2 + 1)) == i
        lines.filter(half).select("value").write.mode("append").text(raw)
        out = jobs.clickstream_sessions(t.spark, raw, base, '{"event_id": 1, "user_id": 1, "action": "view", "event_date": 1700000000}', _GAP)
    return ntz(out["sessions"].select("user_id", "start", "end", "click_count"), "start", "end")


@query("billing_forecast")
def _(t):
    usage = t.lineitem.select(F.col("l_suppkey").alias("suppkey"), F.col("l_returnflag").alias("family"), "l_shipdate", F.col("l_quantity").alias("q"))
    out = jobs.billing_forecast(usage, _price_spans(t), ["suppkey"], ["family"], "l_shipdate", "q", "price", "valid_from", "valid_to", "1999-01-01", "2000-06-01")
    return out["top"].withColumn("ds", F.col("ds").cast("timestamp_ntz"))


@query("table_monitor", """
    WITH x AS (SELECT date_trunc('week', ts) AS w, event_type AS y, CASE WHEN event_id % 4 = 0 THEN 'view' ELSE event_type END AS p FROM events),
    ws AS (SELECT w, count(*) AS n, count(*) FILTER (y = p) / count(*)::DOUBLE AS accuracy FROM x GROUP BY 1)
    SELECT w AS window_start, n, round(accuracy, 6) AS accuracy FROM ws""")
def _(t):
    x = t.events.withColumn("p", F.when(F.col("event_id") % 4 == 0, "view").otherwise(F.col("event_type")))
    out = jobs.table_monitor(x, "ts", ["value"], "event_type", "event_type", "p")
    joined = out["quality"].join(out["decision"], "window_start")
    return joined.select("window_start", "n", r("accuracy").alias("accuracy"))


@query("document_index")
def _(t):
    questions = t.benchmark.select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
    out = jobs.document_index(t.pages, questions, scratch_path(t.spark, "index"))
    return out["hits"].select("question_id", "chunk_id", "page_id", "rank", r("score", 4).alias("score"))


_SLA = """tk AS (SELECT o_orderkey AS ticket_id, o_orderdate AS created, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS closed, 'agent' || o_custkey % 20 AS agent,
      CASE WHEN o_orderkey % 13 > 0 THEN (o_orderkey % 9)::DOUBLE END AS fr, 5.0 AS er, (o_orderkey % 31)::DOUBLE AS rs, 24.0 AS xr FROM orders)"""


def _tickets(t):
    k = F.col("o_orderkey")
    tickets = t.orders.select(k.alias("ticket_id"), F.col("o_orderdate").alias("created"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("closed"))
    agents = t.orders.select(k.alias("ticket_id"), F.concat(F.lit("agent"), F.col("o_custkey") % 20).alias("agent"))
    sla = t.orders.select(k.alias("ticket_id"), F.when(k % 13 == 0, "n/a").otherwise((k % 9).cast("string")).alias("first_response"), F.lit("5").alias("expected_response"),
                          (k % 31).cast("string").alias("resolution"), F.lit("24").alias("expected_resolution"))
    return jobs.support_sla(tickets, agents, sla)


@query("support_sla", f"""
    WITH {_SLA} SELECT date_trunc('month', created) AS month, count(*) AS tickets, round(100.0 * count(*) FILTER (fr > er) / count(*), 2) AS violation_pct
    FROM tk WHERE fr IS NOT NULL GROUP BY 1""", dates=("month",))
def _(t):
    return _tickets(t)["monthly"]


@query("support_agents", f"""
    WITH {_SLA} SELECT agent, count(*) FILTER (rs > xr) AS violations, count(closed) AS closed, round(count(*) FILTER (rs > xr) / count(closed)::DOUBLE, 6) AS rate
    FROM tk GROUP BY 1 HAVING count(*) FILTER (rs > xr) > 0 AND count(closed) > 0""")
def _(t):
    return _tickets(t)["agents"].withColumn("rate", r("rate"))


@query("campaign_funnel", """
    WITH d AS (SELECT CAST(ts AS DATE) AS date, count(DISTINCT user_id) FILTER (event_type = 'click') AS unique_clicks, count(*) FILTER (event_type = 'purchase') AS delivered FROM events GROUP BY 1)
    SELECT date, CAST(sum(unique_clicks) OVER w7 AS BIGINT) AS unique_clicks_7d, CAST(sum(delivered) OVER w28 AS BIGINT) AS delivered_28d,
      round(sum(unique_clicks) OVER w7 / sum(delivered) OVER w7, 6) AS ctr_7d FROM d
    WINDOW w7 AS (ORDER BY date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), w28 AS (ORDER BY date RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW)""", dates=("date",))
def _(t):
    names = F.create_map(*[F.lit(x) for kv in (("view", "sent"), ("purchase", "delivered"), ("signup", "open"), ("click", "click"), ("error", "optout")) for x in kv])
    e = t.events.select((F.col("user_id") % 12).cast("int").alias("campaign_id"), F.col("user_id").alias("contact_id"),
                        F.try_element_at(names, F.col("event_type")).alias("event_type"), F.col("ts").cast("date").alias("date"))
    campaigns = t.nation.select(F.col("n_nationkey").alias("campaign_id"), F.col("n_name").alias("CampaignName"))
    out = jobs.campaign_funnel(e, campaigns)["rolling"]
    return out.select("date", "unique_clicks_7d", "delivered_28d", r("ctr_7d").alias("ctr_7d"))


@query("portfolio", """
    WITH p AS (SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS close, CASE WHEN max(l_orderkey) % 50 = 0 THEN 2.0 ELSE 1.0 END AS f FROM lineitem GROUP BY 1, 2)
    SELECT ticker, date, round(close * exp(coalesce(sum(ln(f)) OVER (PARTITION BY ticker ORDER BY date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)), 4) AS adjusted FROM p""", dates=("date",))
def _(t):
    prices = t.lineitem.groupBy(F.col("l_suppkey").alias("ticker"), F.col("l_shipdate").cast("date").alias("date")).agg(
        F.max("l_extendedprice").alias("close"), F.when(F.max("l_orderkey") % 50 == 0, 2.0).otherwise(1.0).alias("split_factor"),
        F.avg("l_discount").alias("return"))
    news = t.documents.select(F.col("doc_id").alias("article_id"), F.array(F.col("doc_id") % 10, F.col("doc_id") % 7).alias("tickers"))
    out = jobs.portfolio(prices, news)["adjusted"]
    return out.select("ticker", "date", r("adjusted", 4).alias("adjusted"))


@query("deal_review", """
    WITH a AS (SELECT c_custkey, n_regionkey AS region FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal > 0)
    SELECT date_trunc('month', o_orderdate) AS created, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS stage, region, round(sum(o_totalprice), 2) AS amount
    FROM orders JOIN a ON c_custkey = o_custkey GROUP BY 1, 2, 3""", dates=("created",))
def _(t):
    accounts = t.customer.select(F.col("c_custkey").alias("account_id"), F.col("c_nationkey").alias("country_hq"), F.col("c_nationkey").alias("country_local"),
                                 F.col("c_acctbal").alias("employees"))
    month = F.date_trunc("month", "o_orderdate").cast("date")
    deals = t.orders.select(F.col("o_orderkey").alias("deal_id"), F.col("o_custkey").alias("account_id"), F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("stage"),
                            month.alias("created"), F.col("o_orderdate").cast("date").alias("closed"), F.col("o_totalprice").alias("amount"))
    countries = t.nation.select(F.col("n_nationkey").alias("country"), F.col("n_regionkey").alias("region"))
    return jobs.deal_review(accounts, deals, countries, [("employees < 50", "S"), ("employees < 500", "M")], "L")["history"].withColumn("amount", r("amount", 2))


@query("supply_shortage", """
    SELECT item, round(demand, 4) AS demand, round(p_size * 25.0, 4) AS supply FROM (SELECT l_partkey AS item, sum(l_quantity) AS demand FROM lineitem GROUP BY 1)
    JOIN part ON p_partkey = item WHERE demand > p_size * 25.0""")
def _(t):
    demand = t.lineitem.select(F.col("l_partkey").alias("item"), F.col("l_shipdate").alias("at"), F.col("l_quantity").alias("need"))
    stock = t.part.select(F.col("p_partkey").alias("item"), (F.col("p_size") * 25.0).alias("have"))
    return jobs.supply_shortage(demand, stock)["short"].select("item", r("demand", 4).alias("demand"), r("supply", 4).alias("supply"))


@query("retail_gold", """
    SELECT month, product_id, revenue, rank FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY revenue DESC, product_id) AS rank FROM (
      SELECT date_trunc('month', l_shipdate) AS month, l_partkey AS product_id, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1, 2)) WHERE rank <= 10""", dates=("month",))
def _(t):
    buyers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    sales = t.lineitem.join(buyers, "l_orderkey").select("user_id", F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("at"), F.col("l_extendedprice").alias("revenue"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    products = t.part.select(F.col("p_partkey").alias("product_id"), "p_brand")
    return jobs.retail_gold(sales, users, products)["top"].withColumn("rank", F.col("rank").cast("bigint"))


@query("audit", f"WITH {_AUDIT} SELECT service_name, action_name, count(*) AS n, count(DISTINCT user_name) AS users FROM audit GROUP BY 1, 2")
def _(t):
    raw = land(t, {"log": audit_log(t)})
    schema = "timestamp bigint, service_name string, action_name string, user_name string, request_params map<string,string>"
    first = schema + ", response struct<status_code: int>"
    return jobs.audit(t.spark, f"{raw}/log", scratch_path(t.spark, "audit"), first)["actions"]


@query("feedback_eval", f"""
    WITH p AS (SELECT u.conv_id * 1000 + u.turn AS request_id FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
      WHERE u.role = 'user' AND a.role = 'assistant')
    SELECT request_id, CASE WHEN request_id % 4 < 2 AND (request_id % 4 < 2 OR {_SHARE.format(k='request_id')} < 0.3) THEN 'done'
      WHEN {_SHARE.format(k='request_id')} < 0.3 THEN 'todo' ELSE 'skipped' END AS eval_status FROM p""")
def _(t):
    rid = F.col("request_id")
    req = _pairs(t).select((F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"), F.col("question").alias("request"), F.col("answer").alias("response"))
    rating = F.when(rid % 4 == 0, "positive").when(rid % 4 == 1, "negative").otherwise("unsure")
    ass = req.select("request_id", (rid % 3).alias("user_id"), F.lit(10).alias("timestamp"), rating.alias("rating"),
                     F.when(rid % 4 == 1, "better").otherwise("").alias("suggested_output"), F.lit(None).cast("string").alias("retrieval"))
    return jobs.feedback_eval(req, ass, 0.3)["queue"].select("request_id", "eval_status")
