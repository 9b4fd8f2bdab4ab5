import itertools
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tableworks.operators import blocks, changes, clean, governance, joins, monitor, quality
from tableworks.operators.quality import Rule

LOG = "k int, seq int, v string, w int, op string"


@pytest.fixture(scope="module")
def log():
    """A change log where one key has most changes; deletes, repeats, nulls."""
    rnd = random.Random(5)
    out, used = [], set()
    for i in range(160):
        k = 1 if rnd.random() < 0.6 else rnd.randint(2, 8)
        seq = rnd.randint(0, 400)
        if (k, seq) in used:
            continue
        used.add((k, seq))
        out.append((k, seq, rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]), "DELETE" if rnd.random() < 0.15 else "UPDATE"))
    return out


@pytest.fixture(params=["plain", "cut"])
def mode(request, monkeypatch):
    if request.param == "cut":
        monkeypatch.setattr(blocks, "TARGET_ROWS", 10)


ARGS = dict(keys=["k"], sequence_by="seq", delete_when="op = 'DELETE'", except_columns=["op"])


def test_scd1_does_not_depend_on_batches_or_order(spark, log):
    best = {}
    for k, seq, v, w, op in log:
        if k not in best or seq > best[k][0]:
            best[k] = (seq, v, w, op)
    want = sorted((k, v, w) for k, (s, v, w, op) in best.items() if op != "DELETE")
    rnd = random.Random(1)
    for parts in (1, 3):
        shuffled = log[:]
        rnd.shuffle(shuffled)
        state = None
        for i in range(parts):
            batch = spark.createDataFrame(shuffled[i::parts], LOG)
            state = changes.apply_changes_scd1(state, batch, **ARGS)
        assert sorted(tuple(r) for r in changes.live_rows(state).select("k", "v", "w").collect()) == want


def test_scd1_null_updates_ignored(spark, log):
    want = {}
    for k, seq, v, w, op in sorted(log, key=lambda r: r[1]):
        if op == "DELETE":
            want[k] = None
        else:
            old = want.get(k) or (None, None)
            want[k] = (v if v is not None else old[0], w if w is not None else old[1])
    state = changes.apply_changes_scd1(None, spark.createDataFrame(log, LOG), ignore_null_updates=True, **ARGS)
    got = {r.k: (r.v, r.w) for r in changes.live_rows(state).collect()}
    assert got == {k: x for k, x in want.items() if x is not None}


def _history(log):
    out = []
    for k, group in itertools.groupby(sorted(log), key=lambda r: r[0]):
        current = None
        for _, seq, v, w, op in group:
            row = None if op == "DELETE" else (v, w)
            if row == (current[0] if current else None):
                continue
            if current:
                out.append((k, *current[0], current[1], seq))
            current = (row, seq) if row else None
        if current:
            out.append((k, *current[0], current[1], None))
    return out


def test_scd2_brute_force_and_late_rows(spark, log, mode):
    block = F.col("seq")
    df = spark.createDataFrame(log, LOG)
    got = changes.apply_changes_scd2(df, along=block, **ARGS)
    want = sorted(_history(log), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    old, late = df.filter("seq % 3 > 0"), df.filter("seq % 3 = 0")
    before = changes.apply_changes_scd2(old, along=block, **ARGS)
    after = changes.update_scd2(before, df, late, ["k"], "seq", block, delete_when="op = 'DELETE'", except_columns=["op"])
    assert sorted((tuple(r) for r in after.collect()), key=repr) == want


def test_as_of_has_one_row_per_key(spark, log):
    hist = changes.apply_changes_scd2(spark.createDataFrame(log, LOG), along=F.col("seq"), **ARGS)
    for when in (0, 100, 250, 399):
        keys = [r.k for r in changes.as_of(hist, F.lit(when)).collect()]
        assert len(keys) == len(set(keys))


def test_feed_round_trip(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (3, None, 2)], "id int, s string, n int")
    b = spark.createDataFrame([(1, "x", None), (2, "z", 1), (4, "w", None)], "id int, s string, n int")
    feed = changes.change_feed(a, b, ["id"], 1)
    kinds = {(r.id, r._change_type) for r in feed.collect()}
    assert kinds == {(2, "update_preimage"), (2, "update_postimage"), (3, "delete"), (4, "insert")}
    assert rows(changes.consume_feed(feed, a, ["id"])) == rows(b)


def test_merge_refuses_repeated_source_keys(spark):
    t = spark.createDataFrame([(1, "a")], "id int, v string")
    s = spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string")
    with pytest.raises(PySparkException, match="repeats a key"):
        changes.merge_upsert(t, s, ["id"]).collect()


def test_update_delete_keep_unknown(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, v int")
    assert rows(changes.update_where(df, "v > 10", {"v": "0"})) == [(1, 5), (2, None), (3, 0)]
    assert rows(changes.delete_where(df, "v > 10")) == [(1, 5), (2, None)]


def test_cluster_table_narrows_files(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") * 7919 % 10_007).alias("a"), (F.col("id") * 104_729 % 9_973).alias("b"))
    out = str(tmp_path / "z")
    changes.cluster_table(df, ["a", "b"], 16, bits=6).write.parquet(out)
    spans = spark.read.parquet(out).groupBy(F.col("_metadata.file_path")).agg(
        (F.max("a") - F.min("a")).alias("sa"), (F.max("b") - F.min("b")).alias("sb"))
    mean = spans.agg(F.avg("sa"), F.avg("sb"), F.count("*")).first()
    # each file covers about a quarter of both columns, not all of them
    assert mean[2] >= 12 and mean[0] < 5_000 and mean[1] < 5_000


def test_cluster_table_orders_whole_texts(spark, tmp_path):
    # all values share a long prefix, and some lie outside ASCII
    words = F.concat(F.lit("https://例.example/ü/"), F.lpad((F.col("id") * 7919 % 10_007).cast("string"), 6, "0"))
    df = spark.range(20_000).select(F.when(F.col("id") % 100 > 0, words).alias("a"), (F.col("id") * 104_729 % 9_973).alias("b"))
    out = str(tmp_path / "z")
    changes.cluster_table(df, ["a", "b"], 16, bits=6).write.parquet(out)
    back = spark.read.parquet(out)
    number = F.substring("a", -6, 6).cast("int")
    spans = back.groupBy(F.col("_metadata.file_path")).agg((F.max(number) - F.min(number)).alias("sa"), (F.max("b") - F.min("b")).alias("sb"))
    mean = spans.agg(F.avg("sa"), F.avg("sb")).first()
    assert mean[0] < 5_000 and mean[1] < 5_000
    assert back.count() == 20_000 and back.exceptAll(df).isEmpty()


def test_compact(spark, tmp_path):
    many, few = str(tmp_path / "many"), tmp_path / "few"
    spark.range(1000).repartition(8).write.parquet(many)
    assert changes.compact(spark, many, str(few)) == 1
    assert len(list(few.glob("*.parquet"))) == 1 and spark.read.parquet(str(few)).count() == 1000


# ---- quality --------------------------------------------------------------

RULES = [Rule("pos", "v > 0", "drop"), Rule("small", "v < 10", "drop")]


def test_kept_and_quarantined_make_the_input(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50), (4, -1)], "id int, v int")
    kept, bad = quality.expect(df, RULES), quality.quarantine(df, RULES)
    assert [r.id for r in kept.collect()] == [1]
    assert {r.id: r.violations for r in bad.collect()} == {2: ["pos", "small"], 3: ["small"], 4: ["pos"]}


def test_fail_rule_stops(spark):
    df = spark.createDataFrame([(1, None)], "id int, v int")
    with pytest.raises(PySparkException, match="expectation must"):
        quality.expect(df, [Rule("must", "v > 0", "fail")]).collect()
    with pytest.raises(PySparkException, match="table test"):
        quality.table_tests(df, {"rows": ("count(*)", 2)}, fail=True).collect()


def test_drop_rule_before_fail_rule(spark):
    df = spark.createDataFrame([(1, -5), (2, 5)], "id int, v int")
    rules = [Rule("pos", "v > 0", "drop"), Rule("known", "v IS NOT NULL", "fail")]
    assert [r.id for r in quality.expect(df, rules).collect()] == [2]


def test_constraints(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 9)], "id int, p int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    got = dict(tuple(r) for r in quality.check_constraints(df, ["id"], [["id"]], {"low": "p < 5"}, {"p": (parent, "pk")}).collect())
    assert got == {"not_null id": 1, "check low": 1, "unique id": 1, "foreign p": 1}


# ---- cleaning -------------------------------------------------------------

def test_surrogate_key_is_dense(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("a"), "id").repartition(7)
    got = clean.surrogate_key(df, ["a", "id"], out="key", partitions=6).orderBy("a", "id").collect()
    assert [r.key for r in got] == list(range(1, 5001))


def test_split_and_sample_do_not_depend_on_partitions(spark):
    df = spark.range(2000)
    one = clean.split_random(df.coalesce(1), {"train": 0.8, "test": 0.2}, ["id"])
    many = clean.split_random(df.repartition(9), {"train": 0.8, "test": 0.2}, ["id"])
    assert rows(one) == rows(many)
    assert 1500 < one.filter("split = 'train'").count() < 1700


def test_secure_round_trip(spark):
    df = spark.createDataFrame([("a",), ("b",)], "v string")
    hide = F.col("v") == "a"
    enc = clean.secure_encode(df, "v", "0123456789abcdef", hide, out="s", mode="ECB")
    assert enc.filter("v = 'a' AND s <> v").count() == 1
    assert [r.s for r in clean.secure_decode(enc, "s", "0123456789abcdef", hide, mode="ECB").collect()] == ["a", "b"]


def test_one_hot_refuses_too_many(spark):
    with pytest.raises(ValueError):
        clean.one_hot(spark.range(50).select(F.col("id").cast("string").alias("c")), {"c": None}, limit=10)


def test_multi_level_keeps_real_nulls(spark):
    from tableworks.operators.aggregate import multi_level_totals

    df = spark.createDataFrame([("a", 1), (None, 2)], "d string, v int")
    got = {(r.d, r.t) for r in multi_level_totals(df, ["d"], {"t": F.sum("v")}).collect()}
    assert got == {("a", 1), (None, 2), ("ALL", 3)}


# ---- joins ----------------------------------------------------------------

def test_range_join_open_and_long_intervals(spark):
    facts = spark.sql("SELECT id, 'k' AS k, timestampadd(DAY, CAST(id AS INT), TIMESTAMP'2020-01-01') AS at FROM range(400)")
    spans = spark.sql("""SELECT * FROM VALUES ('k', TIMESTAMP'2010-01-01', TIMESTAMP'2020-02-01', 'long'), ('k', TIMESTAMP'2020-06-01', NULL, 'open'),
        ('z', TIMESTAMP'2010-01-01', NULL, 'other') AS t(k, a, b, name)""")
    got = joins.join_range(facts, spans, ["k"], "at", "a", "b")
    assert rows(got.groupBy("name").count()) == rows(facts.join(spans, (facts.k == spans.k) & (facts["at"] >= spans.a) & (
        spans.b.isNull() | (facts["at"] < spans.b))).groupBy("name").count())


def _spans_and_facts(spark):
    """Facts every ten seconds of a week and far ones; minutes, days and decades as intervals, null and empty ones too."""
    facts = spark.sql("""SELECT id, CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 3 = 1 THEN 'b' END AS k, timestampadd(SECOND, CAST(id * 10 AS INT), TIMESTAMP'2020-01-01') AS at, 'f' AS _level FROM range(20000)
        UNION ALL SELECT 90001, 'a', TIMESTAMP'1960-05-05', 'f' UNION ALL SELECT 90002, 'a', TIMESTAMP'2150-01-01', 'f' UNION ALL SELECT 90003, 'a', NULL, 'f'""").drop("_level")
    spans = spark.sql("""SELECT CAST(id AS STRING) AS name, IF(id % 2 = 0, 'a', 'b') AS k, timestampadd(MINUTE, CAST(id * 7 AS INT), TIMESTAMP'2020-01-01') AS s,
          timestampadd(SECOND, CAST(30 + id % 90 AS INT), timestampadd(MINUTE, CAST(id * 7 AS INT), TIMESTAMP'2020-01-01')) AS e FROM range(1000)
        UNION ALL SELECT * FROM VALUES ('decade', 'a', TIMESTAMP'1955-01-01', TIMESTAMP'2020-01-02'), ('open', 'a', TIMESTAMP'2020-01-02', NULL), ('late', 'b', TIMESTAMP'2020-01-03 00:00:05', NULL),
          ('point', 'a', TIMESTAMP'2020-01-01', TIMESTAMP'2020-01-01'), ('wrong', 'a', TIMESTAMP'2021-01-01', TIMESTAMP'2020-01-01'), ('none', 'a', NULL, NULL), ('nokey', NULL, TIMESTAMP'2000-01-01', NULL) AS t(name, k, s, e)""")
    return facts, spans


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_range_join_of_minutes_and_decades(spark, how, closed):
    facts, spans = _spans_and_facts(spark)
    f, i = facts.toPandas(), spans.toPandas()
    want = set()
    for k, s, e, name in zip(i.k, i.s, i.e, i.name):
        if s == s and s is not None and k is not None:
            hit = f[(f.k == k) & (f["at"] >= s)]
            if e == e and e is not None:
                hit = hit[(hit["at"] <= e) if closed else (hit["at"] < e)]
            want |= {(x, name) for x in hit.id}
    if how == "left":
        want |= {(x, None) for x in set(f.id) - {x for x, _ in want}}
    got = joins.join_range(facts, spans, ["k"], "at", "s", "e", how, closed).select("id", "name").collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_range_join_pairs_stay_within_a_constant_of_the_matches(spark):
    """Candidates are counted from the joined plan with the exact bounds left out."""
    facts, spans = _spans_and_facts(spark)
    spans = spans.filter("e IS NOT NULL AND e > s AND name <> 'decade'").unionByName(
        spark.sql("SELECT concat('ten years ', id) AS name, 'a' AS k, TIMESTAMP'2015-01-01' AS s, timestampadd(DAY, CAST(id AS INT), TIMESTAMP'2024-01-01') AS e FROM range(3)"))
    joined = joins.join_range(facts, spans, ["k"], "at", "s", "e")
    matches = joined.count()
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "_r__level" in plan and "_r__bucket" in plan
    # the same buckets by hand: every pair that shares key, level and bucket
    f = [(r.k, int(r.t)) for r in facts.filter("at IS NOT NULL").select("k", F.unix_micros("at").alias("t")).collect()]
    candidates = 0
    by_key = {}
    for k, t in f:
        by_key.setdefault(k, []).append(t)
    for r in spans.select("k", F.unix_micros("s").alias("a"), F.unix_micros("e").alias("b")).collect():
        bits = (r.b - r.a).bit_length()
        level = bits + bits % 2
        assert r.b - r.a < 2**level <= 4 * max(1, r.b - r.a) and (r.b >> level) - (r.a >> level) <= 1
        candidates += sum((r.a >> level) <= (t >> level) <= (r.b >> level) for t in by_key.get(r.k, []))
    assert matches <= candidates <= 8 * matches


@pytest.mark.parametrize("target", [5_000_000, 1])
def test_asof_null_features_and_forward(spark, monkeypatch, target):
    monkeypatch.setattr(blocks, "TARGET_ROWS", target)
    labels = spark.sql("SELECT 1 AS k, TIMESTAMP'2020-01-03' AS t UNION ALL SELECT NULL, TIMESTAMP'2020-01-03'")
    feats = spark.sql("SELECT 1 AS k, TIMESTAMP'2020-01-01' AS ft, CAST(5 AS INT) AS v UNION ALL SELECT 1, TIMESTAMP'2020-01-02', NULL UNION ALL SELECT 1, TIMESTAMP'2020-01-09', 7")
    back = joins.join_asof(labels, feats, ["k"], "t", "ft", ["v"]).filter("k = 1").first()
    assert back.ft.day == 2 and back.v is None  # the newest row wins, even with a null value
    ahead = joins.join_asof(labels, feats, ["k"], "t", "ft", ["v"], direction="forward").filter("k = 1").first()
    assert ahead.ft.day == 9 and ahead.v == 7


# ---- monitoring and access ------------------------------------------------

def test_drift_of_equal_windows_is_zero(spark):
    df = spark.range(700).select(F.expr("timestampadd(DAY, CAST(id % 14 AS INT), TIMESTAMP'2024-01-01')").alias("ts"), (F.col("id") % 7 % 3).alias("c"))
    d = monitor.drift_metrics(monitor.distributions(df, F.date_trunc("week", "ts"), F.col("c"))).first()
    assert abs(d.tv_distance) < 1e-12 and abs(d.js_distance) < 1e-6 and abs(d.chi_square) < 1e-9


def test_row_filters(spark):
    df = spark.createDataFrame([("FR", 1), ("US", 2)], "country string, v int")
    assert governance.filter_rows(df, ["admin"]).count() == 2
    assert governance.filter_rows(df, []).count() == 0
    assert [r.v for r in governance.filter_rows(df, ["analyst_us"], group_prefix="analyst_", column="country").collect()] == [2]
    assert governance.mask_columns(df, {"country": "full"}, ["hr"], "hr") is df


def test_range_join_looks_at_one_level_where_that_is_cheap(spark):
    day = 86_400_000_000
    spans = spark.range(400).select((F.col("id") % 40).alias("k"), (F.floor(F.col("id") / 40) * 90 * day).alias("_begins"), F.lit(90 * day).alias("n"))
    spans = spans.withColumn("_ends", F.col("_begins") + F.when(F.col("_begins") == 9 * 90 * day, 3 * day).when((F.col("_begins") == 0) & (F.col("k") == 1), 900 * day).otherwise(F.col("n")))
    spans = spans.withColumn("_level", joins._level(F.col("_ends") - F.col("_begins")))
    assert len(joins._common_levels(spans, ["k"])) == 3 and len(set(joins._common_levels(spans, ["k"]).values())) == 1
    # many short ones in a bucket keep their level
    crowd = spark.range(100).select(F.lit(1).cast("long").alias("k"), (F.col("id") * 1000).alias("_begins"), F.lit(0).cast("long").alias("n"), (F.col("id") * 1000 + 900).alias("_ends"), F.lit(10).alias("_level"))
    assert 10 in joins._common_levels(spans.unionByName(crowd), ["k"]).values()
