"""End-to-end jobs, composed of the operators.

A job is a plain function of DataFrames (its bronze tables) that returns its
result tables by name; ``load_bronze`` is the incremental load in front of it.
Any scheduler can run them, and each writes only under the ``base`` it is given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.register import register_linear_model
from ..operators import aggregate as A
from ..operators import blocks as B
from ..operators import changes as H
from ..operators import clean as P
from ..operators import features as K
from ..operators import forecast as Z
from ..operators import governance as G
from ..operators import joins as J
from ..operators import monitor as M
from ..operators import quality as Q
from ..operators import text as X
from ..operators import vectors as V
from ..operators import windows as W
from ..operators.quality import Rule
from ..sources import files as S
from ..sources import tables as T
from ..streaming import streams as R

DAY = B.DAY
Frames = dict[str, DataFrame]


def load_bronze(spark: SparkSession, raw: str, base: str, schemas: Mapping[str, str], fmt: str = "json") -> Frames:
    """Load the new files of every ``raw/<name>`` folder, several at a time; returns the bronze tables."""

    def one(name: str) -> DataFrame:
        out = f"{base}/bronze/{name}"
        S.ingest_files(spark, f"{raw}/{name}", fmt, schemas[name], f"{base}/checkpoints/{name}", out)
        return spark.read.parquet(out)

    return S.fan_out(schemas, one)


def customer_360(bronze: Frames, base: str, asof: str, weights: Mapping[str, float], intercept: float, version: int = 0) -> Frames:
    """Users, orders and app events to one scored profile per user.

    Rows without an id are dropped and counted, names are hashed, times parsed;
    the profile is stored as a feature table and scored by a linear model
    registered as a SQL function.
    """
    rules = {
        "users": [Rule("user_has_id", "id > 0", "drop")],
        "orders": [Rule("order_has_id", "order_id > 0", "drop"), Rule("order_has_user", "user_id > 0", "drop")],
        "events": [Rule("event_has_user", "user_id > 0", "drop")],
    }
    users = P.clean_entities(Q.expect(bronze["users"], rules["users"]), {
        "user_id": "copy id", "name_hash": "sha1 name", "segment": "title segment",
        "created": "timestamp creation_date MM-dd-yyyy HH:mm:ss",
    })
    orders = P.safe_cast(Q.expect(bronze["orders"], rules["orders"]), {"amount": "double"})
    profile = A.entity_profile(users, orders, Q.expect(bronze["events"], rules["events"]), "user_id",
                               "transaction_date", "amount", "date", "event_id", "session_id", "platform", asof)
    path = f"{base}/features/customers"
    K.write_features(profile, path, ["user_id"], version)
    stored = K.read_features(profile.sparkSession, path, ["user_id"])
    register_linear_model(profile.sparkSession, "tw_churn", weights, intercept)
    scored = stored.withColumn("churn_score", F.expr(f"tw_churn({', '.join(weights)})"))
    counts = None
    for name, checks in rules.items():
        part = Q.expectation_metrics(bronze[name], checks, name)
        counts = part if counts is None else counts.unionByName(part)
    return {"profile": scored, "quality": counts}


def clinical_visits(
    encounters: DataFrame, conditions: DataFrame, concept: DataFrame, relation: DataFrame,
    acute: Sequence[str] = ("emergency", "urgent"),
) -> Frames:
    """Encounters to visits, and coded conditions attached to their best visit.

    ``encounters``: encounter_id, patient, class, start, stop; ``conditions``:
    condition_id, encounter_id, patient, code. Inpatient stays at most a day
    apart form one visit; other encounters of one start form one. An encounter
    goes to the inpatient visit around it (an ``acute`` one only if it began
    later than the visit), else to a visit of its kind: ``acute`` at its own
    start, all other classes (ambulatory, wellness, outpatient) around it.
    """
    columns = ["patient", "class", "start", "stop"]
    stays = W.merge_intervals(encounters.filter("class = 'inpatient'"), ["patient", "class"], "start", "stop", DAY)
    others = J.same_start_spans(encounters.filter("class <> 'inpatient'"), ["patient", "class"], "start", "stop", "encounter_id")
    visits = A.union_all(stays.select(*columns), others.select(*columns))
    visits = P.surrogate_key(visits, ["patient", "start", "class", "stop"], "visit_id")
    kind = F.when(F.col("class") == "inpatient", "stay").when(F.col("class").isin(*acute), "acute").otherwise("planned")
    best = W.assign_episode(
        encounters.select("encounter_id", "patient", kind.alias("own_kind"), F.col("start").alias("at")),
        visits.select("visit_id", "patient", "start", "stop", kind.alias("visit_kind")), ["patient"], "encounter_id", "at", "start", "stop",
        """CASE WHEN visit_kind = 'stay' AND (own_kind <> 'acute' OR at > start) THEN 1
                WHEN own_kind = visit_kind AND (own_kind <> 'acute' OR at = start) THEN 2 END""",
    ).select("encounter_id", "visit_id")
    coded = J.map_codes(conditions, concept, relation, "code", "local")
    return {"visits": visits, "assigned": best, "conditions": J.join_left(coded, best, "encounter_id")}


def readmission_training(visits: DataFrame, patients: DataFrame, categories: Mapping[str, Sequence[str]], days: float = 30) -> DataFrame:
    """One row per visit: patient traits as 0/1 columns and the readmission label.

    ``visits``: visit_id, patient, start, stop. ``patients``: patient, traits.
    """
    one = P.dedup(patients, ["patient"])
    encoded = P.one_hot(one, categories)
    labelled = W.gap_label(visits, ["patient"], "start", "stop", "visit_id", days, "readmitted")
    hours = (B.epoch_seconds("stop") - B.epoch_seconds("start")) / 3600
    features = labelled.withColumn("length_hours", hours).select("visit_id", "patient", "length_hours")
    return K.assemble_training(features.join(encoded, "patient"), labelled.select("visit_id", "readmitted"), ["visit_id"], drop=["patient"])


def credit_features(customers: DataFrame, accounts: DataFrame, transfers: DataFrame, base: str, version: int = 0) -> DataFrame:
    """Customer features from balances and transfers sent and received over trailing months.

    ``accounts``: account_id, cust_id, balance; ``transfers``: payer, payee
    (account ids), amount, at. Stored as a feature table.
    """
    owner = accounts.select("account_id", "cust_id")
    both = J.join_twice(transfers, owner, "account_id", {"payer": "payer", "payee": "payee"})
    both = both.withColumnsRenamed({"payer_cust_id": "payer_cust", "payee_cust_id": "payee_cust"})
    sent = A.trailing_aggregates(both.withColumn("cust_id", F.col("payer_cust")), "cust_id", "at", "amount", "sent")
    got = A.trailing_aggregates(both.withColumn("cust_id", F.col("payee_cust")), "cust_id", "at", "amount", "rcvd")
    balances = accounts.groupBy("cust_id").agg(F.sum("balance").alias("balance"), F.count(F.lit(1)).alias("accounts"))
    out = P.dedup(customers, ["cust_id"])
    for part in (balances, sent, got):
        out = J.join_left(out, part, "cust_id")
    numbers = [c for c in out.columns if c not in customers.columns]
    out = P.fill_missing(out, {c: 0 for c in numbers})
    out = out.withColumn("sent_ratio_3m_12m", F.coalesce(F.try_divide("sent_amt_3m", "sent_amt_12m"), F.lit(0.0)))
    path = f"{base}/features/credit"
    K.write_features(out, path, ["cust_id"], version)
    return K.read_features(out.sparkSession, path, ["cust_id"])


def fraud_gold(transactions: DataFrame, reports: DataFrame, countries: DataFrame, customers: DataFrame, top: int = 20) -> Frames:
    """Cleaned transactions with balance changes, both countries and the fraud flag, and the biggest flows."""
    clean = P.replace_regex(transactions, {"country_orig": ("--", ""), "country_dest": ("--", "")})
    clean = P.derive_deltas(clean, {"diff_orig": ("new_balance_orig", "old_balance_orig"), "diff_dest": ("new_balance_dest", "old_balance_dest")})
    silver = J.join_left(Q.expect(clean, [Rule("has_id", "id IS NOT NULL"), Rule("has_customer", "customer_id IS NOT NULL")]), reports, "id")
    gold = J.join_twice(silver, countries, "code", {"orig": "country_orig", "dest": "country_dest"})
    gold = gold.join(customers, "customer_id").withColumn("is_fraud", F.coalesce(F.col("is_fraud"), F.lit(0)).cast("boolean"))
    flows = A.pair_flow(gold, "country_orig", "country_dest", {
        "amount": F.sum("amount"), "n": F.count(F.lit(1)), "frauds": F.count_if("is_fraud")})
    return {"gold": gold, "flows": A.top_n(flows, [F.desc("amount"), F.asc("country_orig"), F.asc("country_dest")], top)}


def claims(claim_rows: DataFrame, policies: DataFrame, telematics: DataFrame, rules: DataFrame, start: str, stop: str) -> Frames:
    """Nested claims flattened and checked, joined to policy and driving data, judged by stored rules, loss ratio per product."""
    flat = P.flatten_struct(claim_rows)
    flat = Q.expect(flat, [Rule("valid_claim", "claim_no IS NOT NULL", "drop"), Rule("valid_amount", "amount_total > 0", "drop")])
    speed = telematics.groupBy("chassis").agg(F.avg("speed").alias("telematics_speed"))
    pol = policies.withColumn("premium", F.abs("premium"))
    joined = J.join_left(flat.join(pol, "policy_no"), speed, "chassis")
    judged = P.apply_rules(joined, rules)
    ratio = A.loss_ratio(
        pol.select("product", "premium", "begins", "ends"),
        joined.select("product", F.col("amount_total").alias("amount"), F.col("claim_date")), start, stop, ["product"])
    return {"insights": judged, "loss_ratio": ratio}


def turbine_features(readings: DataFrame, status: DataFrame, turbines: DataFrame, sensors: Sequence[str], query_vectors: DataFrame | None = None) -> Frames:
    """Hourly sensor statistics joined to the status valid at that hour, newest hour per turbine, similar hours by vector.

    ``readings``: turbine, ts, sensors; ``status``: turbine, start_time, end_time, abnormal.
    """
    good = Q.expect(readings, [Rule("has_time", "ts IS NOT NULL", "drop"), Rule("energy_ok", f"{sensors[0]} >= 0", "drop")])
    hourly = A.sensor_stats(good, ["turbine"], "ts", sensors)
    training = J.join_range(hourly, status, ["turbine"], "window_start", "start_time", "end_time")
    training = P.assemble_vector(training, [f"std_{s}" for s in sensors], "sensor_vector", ["turbine", "window_start"])
    training = training.join(turbines, "turbine")
    out = {"training": training, "current": W.latest_per_key(training, ["turbine"], ["window_start"])}
    if query_vectors is not None:
        out["similar"] = V.vector_top_k(query_vectors, training, "query_id", "composite_key", "sensor_vector", 3, "l2")
    return out


def loan_quality(new_loans: DataFrame, old_loans: DataFrame, treatments: DataFrame, rules: list[Rule], update_id: str, at: str) -> Frames:
    """Loans enriched, split into clean and quarantined rows, totals over old and new, quality counts as an event log."""
    enriched = J.join_using(new_loans, [treatments], "treatment_id")
    clean = Q.expect(enriched, rules)
    bad = Q.quarantine(enriched, [r for r in rules if r.action == "drop"])
    history = J.join_using(old_loans, [treatments], "treatment_id")
    totals = A.union_distinct(
        history.groupBy("location").agg(F.sum("balance").alias("balance")),
        clean.groupBy("location").agg(F.sum("balance").alias("balance")))
    metrics = Q.expectation_metrics(enriched, rules, "loans.cleaned")
    log = Q.build_event_log(metrics, F.lit(update_id), F.lit(at).cast("timestamp"))
    return {"clean": clean, "quarantine": bad, "totals": totals, "log": log, "report": Q.event_log_report(log)}


def cdc_sync(spark: SparkSession, raw: str, base: str, schema: str, keys: Sequence[str], sequence_by: str, along: Column) -> Frames:
    """Change files, loaded incrementally, to a change feed, the current table, a
    history table, and the feed merged downstream.

    Every run takes the files that are new: bronze and the feed are streams
    with checkpoints, and the newest row per key is the state of the second.
    Only the history is built from the whole log, as a late change may split
    an old span.
    """
    bronze = load_bronze(spark, raw, base, {"changes": schema})["changes"]
    rules = [Rule("has_key", f"{keys[0]} IS NOT NULL", "drop"), Rule("known_operation", "operation IN ('APPEND', 'UPDATE', 'DELETE')", "drop")]
    args = dict(delete_when="operation = 'DELETE'", except_columns=["operation"])
    changes = Q.expect(R.stream_files(spark, f"{base}/bronze/changes", bronze.schema), rules)
    valued = dict(args, except_columns=["operation", sequence_by])
    R.run_to_files(R.changes_from_state(changes, keys, along, **valued), f"{base}/feed", f"{base}/checkpoints/feed")
    feed = spark.read.parquet(f"{base}/feed")
    history = H.apply_changes_scd2(Q.expect(bronze, rules), list(keys), sequence_by, along, **args)
    nothing = feed.drop(R.CHANGE, R.VERSION).filter(F.lit(False))
    return {"current": R.current_rows(feed, keys), "history": history, "feed": feed, "gold": H.consume_feed(feed, nothing, keys)}


def clickstream_sessions(spark: SparkSession, raw: str, base: str, example: str, gap_seconds: int,
                         max_files: int | None = None) -> Frames:
    """JSON messages to clean events to closed sessions: chained streams with their own checkpoints.

    Another call with the same ``base`` goes on where the last one stopped.
    """
    messages = R.stream_files(spark, raw, "value string", "text", max_files=max_files)
    typed = S.parse_messages(messages, example, ["event_date"], required=["event_id"])
    R.run_to_files(R.dedup_stream(typed, ["event_id"], "event_date", "1 hour"), f"{base}/silver", f"{base}/ckpt/silver")
    silver = R.stream_files(spark, f"{base}/silver", spark.read.parquet(f"{base}/silver").schema)
    # a closed session never changes, so the append-only sink is enough
    R.run_to_files(R.sessionize_window(silver, "user_id", "event_date", gap_seconds), f"{base}/gold", f"{base}/ckpt/gold")
    sessions = spark.read.parquet(f"{base}/gold")
    return {"silver": spark.read.parquet(f"{base}/silver"), "sessions": sessions, "durations": R.session_durations(sessions)}


def billing_forecast(usage: DataFrame, prices: DataFrame, keys: Sequence[str], dims: Sequence[str], day: str, quantity: str, price: str,
                     start: str, stop: str, active_since: str, report_since: str) -> Frames:
    """Priced usage per day and level, a forecast per group, past and future in one table, the biggest groups."""
    series = Z.prepare_series(usage, prices, keys, dims, day, quantity, price, start, stop, active_since)
    forecast = Z.forecast_groups(series, dims)
    table = Z.assemble_forecast(forecast, dims)
    everything = F.lit(True)
    for d in dims:
        everything = everything & (F.col(d) == "ALL")
    return {"series": series, "table": table, "top": Z.top_series(table, dims, "value", "ds", report_since, exclude=everything)}


def table_monitor(df: DataFrame, ts: str, columns: Sequence[str], slice_by: str, label: str, prediction: str) -> Frames:
    """Profile, drift, model quality and the retrain decision per week."""
    window = F.date_trunc("week", ts)
    profile = M.profile_metrics(df, ts, ["week"], columns, [slice_by])
    drift = M.drift_metrics(M.distributions(df, window, F.col(slice_by)))
    quality = M.classification_quality(df, {"window_start": window}, label, prediction)
    long = drift.unpivot("window_start", ["js_distance", "tv_distance"], "metric", "value")
    decision = M.violations(quality, long, {"macro_f1": ("min", 0.5), "accuracy": ("min", 0.5)},
                            {"js_distance": 0.2, "tv_distance": 0.1}, allowed=0)
    return {"profile": profile, "drift": drift, "quality": quality, "decision": decision}


def document_index(pages: DataFrame, questions: DataFrame, base: str, dim: int = 256, k: int = 3) -> Frames:
    """Pages to text to chunks to vectors (stored), and the best chunks for each question from a vector index."""
    text = X.html_to_text(pages).filter("text IS NOT NULL").select("page_id", "text")
    chunks = X.chunk_by_heading(text, "text", 200, 5, 20)
    # Python-heavy work is spread by content before embedding
    chunks = chunks.withColumn("chunk_id", F.concat_ws("-", "page_id", "chunk_no"))
    path = f"{base}/index"
    X.embed(chunks, "chunk", dim).write.mode("overwrite").parquet(path)
    index = pages.sparkSession.read.parquet(path)
    lists = V.build_vector_index(index, "chunk_id", "embedding", metric="cosine")
    hits = lists.search(X.embed(questions, "question", dim).drop("question"), "question_id", "embedding", k, exact=True)
    return {"index": index, "hits": hits.join(index.select("chunk_id", "page_id", "chunk"), "chunk_id")}


def support_sla(tickets: DataFrame, agents: DataFrame, sla: DataFrame, k: int = 3) -> Frames:
    """Tickets with non-numeric noise cleaned: SLA violation share per month and per agent, top agents per month."""
    times = P.safe_cast(sla, {c: "double" for c in ("first_response", "expected_response", "resolution", "expected_resolution")})
    joined = J.join_using(tickets, [times], "ticket_id")
    known = joined.filter("first_response IS NOT NULL AND expected_response IS NOT NULL")
    monthly = known.groupBy(F.date_trunc("month", "created").cast("date").alias("month")).agg(
        F.count(F.lit(1)).alias("tickets"),
        F.round(100.0 * F.count_if(F.col("first_response") > F.col("expected_response")) / F.count(F.lit(1)), 2).alias("violation_pct"))
    # violations and closed tickets of an agent come from one pass, not a self join
    by_agent = joined.join(agents, "ticket_id")
    per_agent = A.conditional_counts(by_agent, ["agent"], {"violations": "resolution > expected_resolution", "closed": "closed IS NOT NULL"},
                                     rates={"rate": ("violations", "closed")}).filter("violations > 0 AND closed > 0")
    busiest = W.top_k_per_group(
        by_agent.groupBy(F.date_trunc("month", "created").cast("date").alias("month"), "agent").agg(F.count(F.lit(1)).alias("n")),
        ["month"], [F.desc("n"), F.asc("agent")], k)
    return {"monthly": monthly, "agents": per_agent, "busiest": busiest}


def campaign_funnel(events: DataFrame, campaigns: DataFrame) -> Frames:
    """Mail events to a funnel per campaign and trailing daily metrics.

    ``events``: campaign_id, contact_id, event_type, date.
    """
    clean = P.drop_incomplete(events, ["campaign_id", "contact_id", "event_type"])
    flags = {n: f"event_type = '{e}'" for n, e in (("sent", "sent"), ("delivered", "delivered"), ("opens", "open"), ("clicks", "click"), ("optouts", "optout"))}
    funnel = A.conditional_counts(clean, ["campaign_id"], flags, {"unique_clicks": ("event_type = 'click'", "contact_id")},
                                  {"ctr": ("unique_clicks", "delivered"), "delivery_rate": ("delivered", "sent")})
    daily = A.conditional_counts(clean, ["date"], flags, {"unique_clicks": ("event_type = 'click'", "contact_id")})
    rolling = W.rolling_days(daily, "date", [7, 28, 91], ["unique_clicks", "delivered"])
    rolling = rolling.withColumns({f"ctr_{n}d": F.try_divide(f"unique_clicks_{n}d", f"delivered_{n}d") for n in (7, 28, 91)})
    return {"funnel": P.rename_columns(funnel.join(campaigns, "campaign_id")), "rolling": rolling}


def portfolio(prices: DataFrame, news: DataFrame) -> Frames:
    """Split-adjusted prices, weekly volatility, and articles per ticker.

    ``prices``: ticker, date, close, split_factor, return; ``news``: article_id, tickers (array).
    """
    clean = P.drop_incomplete(prices, ["ticker", "date", "close"], ["close > 0"])
    adjusted = W.back_adjust(clean, ["ticker"], ["date"], B.epoch_micros("date"), "close", "split_factor")
    mentions = P.explode_list(news, "tickers", "ticker").groupBy("ticker").agg(F.count_distinct("article_id").alias("articles"))
    return {"adjusted": adjusted, "volatility": A.volatility(clean, ["ticker"], "date", "return"), "mentions": mentions}


def deal_review(accounts: DataFrame, deals: DataFrame, countries: DataFrame, classes: list[tuple[str, str]], largest: str) -> Frames:
    """Accounts with size segment and both regions; deals by day, stage and region; the open total.

    ``accounts``: account_id, country_hq, country_local, employees; ``deals``: deal_id, account_id, stage, created, closed, amount.
    """
    acc = P.drop_incomplete(accounts, ["account_id"], ["employees > 0"])
    acc = P.bucketize(acc, "size_segment", classes, largest)
    acc = J.join_twice(acc, countries, "country", {"hq": "country_hq", "local": "country_local"})
    good = P.drop_incomplete(deals, ["deal_id", "account_id"], ["closed >= created"])
    joined = good.join(acc, "account_id")
    history = A.group_all(joined, {"created": F.col("created"), "stage": "stage", "region": "local_region"}, {"amount": F.sum("amount")})
    open_total = A.grand_total(joined.filter("stage <> 'closed'"), {"open_amount": F.sum("amount"), "open_deals": F.count(F.lit(1))})
    return {"accounts": acc, "history": history, "open": open_total}


def supply_shortage(demand: DataFrame, stock: DataFrame) -> Frames:
    """Monthly demand per item and the items short over the whole span. ``demand``: item, at, need."""
    monthly = A.period_kpi(demand, "at", "month", {"need": F.sum("need")}, ["item"])
    return {"monthly": monthly, "short": A.shortage(monthly, stock, "item", "need", "have")}


def retail_gold(sales: DataFrame, users: DataFrame, products: DataFrame, k: int = 10) -> Frames:
    """Sales with user and product columns: daily totals, top products per month, revenue per segment."""
    silver = J.join_left(J.join_left(sales, users, "user_id"), products, "product_id")
    daily = A.period_kpi(silver, "at", "day", {"revenue": F.sum("revenue"), "n": F.count(F.lit(1))})
    per_month = silver.groupBy(F.date_trunc("month", "at").cast("date").alias("month"), "product_id").agg(F.round(F.sum("revenue"), 2).alias("revenue"))
    top = W.top_k_per_group(per_month, ["month"], [F.desc("revenue"), F.asc("product_id")], k)
    return {"silver": silver, "daily": daily, "top": top, "segments": silver.groupBy("segment").agg(F.sum("revenue").alias("revenue"))}


def audit(spark: SparkSession, raw: str, base: str, first_schema: str) -> Frames:
    """JSON audit files to an evolving bronze table, one partitioned silver table, and the standard reports."""
    S.run_until_stable(lambda: S.ingest_evolving(spark, raw, f"{base}/schema", f"{base}/ckpt", f"{base}/bronze", first_schema))
    bronze = T.read_table(spark, f"{base}/bronze", merge_schema=True).drop("batch")
    silver = G.split_services(bronze)
    T.write_table(silver, f"{base}/silver", "overwrite", ["service_name", "event_date"])
    stored = spark.read.parquet(f"{base}/silver")
    return {
        "silver": stored, "actions": G.action_counts(stored), "users": G.top_users(stored),
        "deletes": G.deletes_by_scope(stored), "active": A.active_users(stored, "user_name", "event_time", "day"),
    }


def feedback_eval(requests: DataFrame, assessments: DataFrame, rate: float) -> Frames:
    """Feedback set, evaluation queue, and word overlap of expected and given answers for the queued ones."""
    feedback = X.feedback_dataset(requests, assessments)
    queue = X.eval_queue(None, requests.select("request_id"), "request_id", rate, feedback.filter("type <> 'no_feedback_provided'"))
    todo = queue.filter("eval_status = 'todo'").join(requests, "request_id").join(
        feedback.select("request_id", "expected_response").filter("expected_response IS NOT NULL"), "request_id")
    scored = X.extraction_scores(
        todo.withColumns({"p": X.token_set("response"), "t": X.token_set("expected_response")}), "p", "t")
    scored = scored.select("request_id", "precision", "recall")
    done = H.merge_upsert(queue.withColumn("recall", F.lit(None).cast("double")),
                          scored.select("request_id", F.lit("done").alias("eval_status"), "recall"), ["request_id"])
    return {"feedback": feedback, "queue": done, "scores": scored}
