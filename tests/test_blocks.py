"""Block scans against plain windows, on data where one key holds most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tableworks.operators import blocks, windows

DAY = blocks.DAY


@pytest.fixture(scope="module")
def skewed(spark, tables):
    # two thirds of the rows under one key, some under a null key
    key = F.when(F.col("event_id") % 3 > 0, 7).when(F.col("event_id") % 30 == 0, None).otherwise(F.col("user_id"))
    return tables.events.select(key.alias("k"), "ts", "event_id", "value").cache()


ORDER = ["ts", "event_id"]


@pytest.fixture(autouse=True, params=["plain", "cut"])
def mode(request, monkeypatch):
    """Every test once with plain windows and once with hot keys cut into blocks."""
    if request.param == "cut":
        monkeypatch.setattr(blocks, "TARGET_ROWS", 40)


def test_row_number(skewed):
    got = windows.sequence_number(skewed, ["k"], ORDER, blocks.epoch_micros("ts"))
    want = skewed.withColumn("seq", F.row_number().over(Window.partitionBy("k").orderBy(*ORDER)))
    assert rows(got) == rows(want)


def test_lag_and_lead(skewed):
    w = Window.partitionBy("k").orderBy(*ORDER)
    block = blocks.epoch_micros("ts")
    got = windows.neighbour_values(skewed, ["k"], ORDER, block, {"a": ("value", 1), "b": ("value", -1)})
    want = skewed.withColumns({"a": F.lag("value").over(w), "b": F.lead("value").over(w)})
    assert rows(got) == rows(want)
    got = windows.neighbour_values(skewed, ["k"], ORDER, block, {"a": ("value", 3), "b": ("value", -2)})
    want = skewed.withColumns({"a": F.lag("value", 3).over(w), "b": F.lead("value", 2).over(w)})
    assert rows(got) == rows(want)


def test_row_frame_segments(skewed):
    w = Window.partitionBy("k").orderBy(*ORDER).rowsBetween(-7, 7)
    got = blocks.row_frame(
        skewed, ["k"], [F.col(c) for c in ORDER], blocks.epoch_micros("ts"), 7, 7,
        {"m": lambda w: F.avg("value").over(w.rowsBetween(-7, 7))}, segment_rows=50,
    )
    assert rows(got) == rows(skewed.withColumn("m", F.avg("value").over(w)))


@pytest.mark.parametrize("seconds,block", [(7 * DAY, DAY), (DAY, DAY), (6 * 3600, 3600), (2 * DAY, None)])
def test_rolling_range(skewed, seconds, block):
    base = skewed.withColumn("t", blocks.epoch_micros("ts"))
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-seconds * 1_000_000, 0)
    want = base.withColumns({
        "s": F.sum("value").over(w), "n": F.count("value").over(w), "a": F.avg("value").over(w),
        "lo": F.min("value").over(w), "hi": F.max("value").over(w),
    }).drop("t")
    got = windows.rolling_totals(skewed, ["k"], "ts", seconds, {
        "s": ("sum", "value"), "n": ("count", "value"), "a": ("avg", "value"),
        "lo": ("min", "value"), "hi": ("max", "value"),
    }, block)
    assert rows(got) == rows(want)


def test_running_last_and_sum(skewed):
    df = skewed.withColumn("v", F.when(F.col("value") > 50, F.col("value")))
    w = Window.partitionBy("k").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumns({"l": F.last("v", True).over(w), "s": F.sum("v").over(w), "m": F.max("v").over(w)})
    got = blocks.running(
        df, ["k"], [F.col(c) for c in ORDER], blocks.epoch_micros("ts"),
        {"l": ("last", F.col("v")), "s": ("sum", F.col("v")), "m": ("max", F.col("v"))},
        include_current=False,
    )
    assert rows(got) == rows(want)


def test_merge_intervals_brute_force(skewed):
    base = skewed.select("k", F.col("ts").alias("start"),
                         (F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 9).cast("int"))).alias("stop"))
    got = windows.merge_intervals(base, ["k"], "start", "stop", gap_seconds=1800)
    want = []
    groups = {}
    for r in base.collect():
        groups.setdefault(r.k, []).append((r.start, r.stop))
    for k, spans in groups.items():
        spans.sort()
        cur = None
        for s, e in spans:
            if cur and (s - cur[1]).total_seconds() <= 1800:
                cur = [cur[0], max(cur[1], e), cur[2] + 1]
            else:
                if cur:
                    want.append((k, *cur))
                cur = [s, e, 1]
        want.append((k, *cur))
    assert rows(got) == sorted(want, key=repr)


def test_hot_keys_are_cut(skewed):
    cut, split = blocks.cut_blocks(skewed, ["k"], blocks.epoch_micros("ts"))
    most = cut.groupBy("_key", "_block").count().agg(F.max("count")).first()[0]
    if split:
        assert cut.select("_block").distinct().count() > 10 and most < 100
    else:
        assert cut.select("_block").distinct().count() == 1


@pytest.mark.parametrize("odd,blocks_least,most", [
    ("IF(id = 0, TIMESTAMP '1970-01-01', ts)", 50, 30),  # one old time does not widen the blocks
    ("IF(id % 4 = 0, NULL, ts)", 30, 150),  # rows without a time are one block of their own
    ("TIMESTAMP '2024-01-01'", 1, 600),  # equal times cannot be told apart
    ("CAST(NULL AS TIMESTAMP)", 1, 600),
])
def test_blocks_hold_equal_rows(spark, monkeypatch, odd, blocks_least, most):
    monkeypatch.setattr(blocks, "TARGET_ROWS", 10)
    rows_ = spark.range(600).selectExpr("id", "timestampadd(SECOND, CAST(id AS INT), TIMESTAMP '2024-01-01') AS ts")
    df = rows_.selectExpr("CASE WHEN id < 599 THEN 'hot' END AS k", f"{odd} AS ts", "id")
    cut, split = blocks.cut_blocks(df, ["k"], blocks.epoch_micros("ts"))
    sizes = [r["count"] for r in cut.groupBy("_key", "_block").count().collect()]
    assert split and sum(sizes) == 600 and len(sizes) >= blocks_least and max(sizes) <= most
    got = windows.sequence_number(df, ["k"], ["ts", "id"], blocks.epoch_micros("ts"))
    assert rows(got) == rows(df.withColumn("seq", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id"))))


def test_back_adjust(skewed):
    df = skewed.withColumn("f", F.when(F.col("event_id") % 40 == 0, 2.0).otherwise(1.0))
    w = Window.partitionBy("k").orderBy(F.desc("ts"), F.desc("event_id")).rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("adjusted", F.col("value") * F.exp(F.coalesce(F.sum(F.log("f")).over(w), F.lit(0.0))))
    got = windows.back_adjust(df, ["k"], ORDER, blocks.epoch_micros("ts"), "value", "f")
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:-1] == y[:-1] and abs(x[-1] - y[-1]) < 1e-6 * max(1, abs(y[-1]))


def test_null_keys_and_null_starts(spark):
    from tableworks.operators.clean import one_hot
    from tableworks.operators.joins import join_asof
    from tableworks.operators.windows import latest_with_ties, merge_intervals

    labels = spark.sql("SELECT * FROM VALUES (CAST(NULL AS INT), TIMESTAMP '2024-01-02', 1), (5, TIMESTAMP '2024-01-02', 2) t(k, ts, id)")
    feats = spark.sql("SELECT * FROM VALUES (CAST(NULL AS INT), TIMESTAMP '2024-01-01', 10), (5, TIMESTAMP '2024-01-01', 20) t(k, fts, v)")
    assert {r.id: r.v for r in join_asof(labels, feats, ["k"], "ts", "fts", ["v"]).collect()} == {1: None, 2: 20}
    assert sorted(r.id for r in latest_with_ties(labels, ["k"], "ts").collect()) == [1, 2]
    spans = spark.sql("""SELECT 'a' AS k, CAST(s AS TIMESTAMP) AS s, CAST(e AS TIMESTAMP) AS e FROM VALUES
        (NULL, '2030-01-01'), ('2024-01-01', '2024-01-02'), ('2025-01-01', '2025-01-02') t(s, e)""")
    assert sorted((r.s is not None and r.s.year, r.members) for r in merge_intervals(spans, ["k"], "s", "e").collect()) == [(False, 1), (2024, 1), (2025, 1)]
    wide = one_hot(spark.sql("SELECT * FROM VALUES ('A b'), ('a-b'), ('x') t(c)"), {"c": None})
    assert sorted(wide.columns) == ["c_a_b", "c_a_b_2", "c_x"]
    assert wide.groupBy().sum().first().asDict() == {f"sum({c})": 1 for c in wide.columns}
