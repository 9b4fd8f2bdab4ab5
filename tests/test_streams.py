"""Streams over small ordered files, against batch results."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tableworks.sources import tables
from tableworks.streaming import streams

SCHEMA = "u bigint, t timestamp"


def _feed(spark, path, *batches):
    for b in batches:
        df = spark.createDataFrame(b, "u bigint, s bigint").select("u", F.timestamp_seconds("s").alias("t"))
        df.coalesce(1).write.mode("append").parquet(path)
    return streams.stream_files(spark, path, SCHEMA, max_files=1)


# gap 100 s, watermark delay 50 s; key 1 has most events, some late but allowed
BATCHES = [
    [(1, 1000), (1, 1050), (2, 1000)],
    [(1, 1300), (1, 1010), (1, 1145)],
    [(1, 1290), (3, 2000)],
    [(3, 5000)],
]
SESSIONS = [(1, 1000, 1145, 4), (1, 1290, 1300, 2), (2, 1000, 1000, 1), (3, 2000, 2000, 1)]


@pytest.mark.parametrize("kind", ["window", "stateful"])
def test_sessions_with_late_events(spark, tmp_path, kind):
    stream = _feed(spark, str(tmp_path / "src"), *BATCHES)
    make = streams.sessionize_window if kind == "window" else streams.sessionize_stateful
    # a watermark wide enough for the late rows of the next files
    out = str(tmp_path / "out")
    streams.run_to_files(make(stream, "u", "t", 100, "400 seconds"), out, str(tmp_path / "ckpt"))
    got = spark.read.parquet(out).select(
        "u", F.unix_seconds("start").alias("a"), F.unix_seconds("end").alias("b"), "click_count")
    assert sorted(tuple(r) for r in got.collect()) == SESSIONS


def test_dedup_drops_repeats(spark, tmp_path):
    stream = _feed(spark, str(tmp_path / "src"), [(1, 1000), (2, 1001)], [(1, 1002), (3, 1003)])
    out = str(tmp_path / "out")
    streams.run_to_files(streams.dedup_stream(stream, ["u"], "t", "1 hour"), out, str(tmp_path / "ckpt"))
    assert sorted(r.u for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_upsert_keeps_newest_and_resumes(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    stream = _feed(spark, src, [(1, 1000), (2, 900)], [(1, 950), (2, 1100)])
    streams.upsert_stream(stream, out, ckpt, mode="append")
    stream = _feed(spark, src, [(3, 10)])
    streams.upsert_stream(stream, out, ckpt, mode="append")
    got = tables.latest_rows(spark, out, ["u"], ["t"]).select("u", F.unix_seconds("t").alias("s"))
    assert rows(got) == [(1, 1000), (2, 1100), (3, 10)]


CHANGES = "id bigint, seq bigint, v double, at timestamp, op string"


def _net_changes(loads):
    """What each load does to each key, one change after the other."""
    state, version, feed = {}, {}, []
    for load in loads:
        for key in {c[0] for c in load}:
            old = state.get(key)
            new = max([c for c in ([old] if old else []) + [(s, op == "D", -1e9 if v is None else v, v) for i, s, v, op in load if i == key]])
            state[key] = new
            was, now = (None if x is None or x[1] else (x[3],) for x in (old, new))
            if was == now:
                continue
            version[key] = version.get(key, 0) + 1
            if was is None:
                feed.append((key, now[0], "insert", version[key]))
            elif now is None:
                feed.append((key, was[0], "delete", version[key]))
            else:
                feed += [(key, was[0], "update_preimage", version[key]), (key, now[0], "update_postimage", version[key])]
    return feed, {k: x[3] for k, x in state.items() if not x[1]}


def test_changes_from_state_over_loads(spark, tmp_path):
    loads = [
        [(1, 1, 1.0, "U"), (1, 3, 3.0, "U"), (2, 1, 5.0, "U"), (3, 4, 0.0, "D"), (None, 1, 7.0, "U")],
        [(1, 2, 2.0, "U"), (2, 2, None, "D"), (3, 2, 9.0, "U"), (4, 1, 0.1 + 0.2, "U"), (None, 2, 8.0, "U")],  # late: 1 and 3
        [(2, 3, 6.0, "U"), (3, 4, 9.0, "U"), (4, 1, 0.1 + 0.2, "U"), (1, 5, None, "U"), (None, 9, None, "D")],  # a tie with a delete, a repeat
        [(2, 3, 6.0, "U")],
    ]
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    for load in loads:
        df = spark.createDataFrame(load, "id bigint, seq bigint, v double, op string").withColumn("at", F.timestamp_micros(F.col("seq") * 7 + 1))
        df.select("id", "seq", "v", "at", "op").write.mode("append").parquet(src)
        stream = streams.stream_files(spark, src, CHANGES)
        streams.run_to_files(streams.changes_from_state(stream, ["id"], F.col("seq"), "op = 'D'", ["op", "seq", "at"]), out, ckpt)
    want, current = _net_changes(loads)
    feed = spark.read.parquet(out)
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in feed.select("id", "v", "_change_type", "_commit_version").collect()), key=order) == sorted(want, key=order)
    assert {r.id: r.v for r in streams.current_rows(feed, ["id"]).collect()} == current


def test_changes_from_state_keeps_types(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    df = spark.sql("""SELECT 1L AS id, timestamp'2024-01-01 00:00:00.123456' AS at, 1.50BD AS d, array(1, null) AS a, 'x"\\n' AS s,
                      cast(null AS int) AS n, date'2020-02-29' AS day, X'00FF' AS b, 9007199254740993L AS big""")
    df.write.parquet(src)
    stream = streams.stream_files(spark, src, df.schema)
    streams.run_to_files(streams.changes_from_state(stream, ["id"], F.col("id"), "false"), out, ckpt)
    got = streams.current_rows(spark.read.parquet(out), ["id"])
    assert got.select(df.columns).collect() == df.collect()
    assert [f.dataType for f in got.select(df.columns).schema] == [f.dataType for f in df.schema]


def test_hot_key_sends_one_row_per_arrow_batch():
    import pandas as pd

    pdf = pd.DataFrame({"k": ["a"] * 1000 + ["b"], "at": [*range(1000), 1], "gone": False, "body": "{}"})
    out = next(streams._newest_per_batch(iter([pdf])))
    assert sorted(zip(out["k"], out["at"])) == [("a", 999), ("b", 1)]


class _Held:
    """A value state, and how often it was written."""

    def __init__(self):
        self.value, self.written = None, 0

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.written = value, self.written + 1

    def clear(self):
        self.value = None


class _Handle:
    def __init__(self):
        self.held, self.timers = _Held(), []

    def getValueState(self, name, schema):
        return self.held

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_many_keys_share_one_call_of_the_change_state():
    import pandas as pd

    handle, made = _Handle(), streams.ChangeProcessor()
    made.init(handle)
    rows_of = lambda at: pd.DataFrame({"k": [f"k{i}" for i in range(500)], "at": at, "gone": False, "body": f"b{at}"})
    first = list(made.handleInputRows((0,), iter([rows_of(1)]), None))
    second = list(made.handleInputRows((0,), iter([rows_of(2), rows_of(1)]), None))
    assert handle.held.written == 2 and len(first) == len(second) == 1
    assert (first[0]["change"] == "insert").all() and len(second[0]) == 1000 and set(second[0]["version"]) == {2}


def test_many_keys_share_one_session_state_and_timer():
    import pandas as pd

    handle, made = _Handle(), streams.SessionProcessor(10_000, False)
    made.init(handle)
    list(made.handleInputRows((0,), iter([pd.DataFrame({"k": ["a", "b", "a"], "first_us": [0, 5_000, 30_000], "last_us": [0, 5_000, 30_000], "clicks": 1})]), None))
    assert handle.held.written == 1 and handle.timers == [10]

    class Now:
        def getCurrentWatermarkInMs(self):
            return 15

    handle.timers.clear()  # it fired
    out = list(made.handleExpiredTimer((0,), Now(), None))
    assert sorted(out[0]["k"]) == ["a", "b"] and handle.timers == [40]


def test_null_and_large_session_keys_are_kept(spark, tmp_path):
    big = 2**53 + 1
    stream = _feed(spark, str(tmp_path / "src"), [(big, 1000), (None, 1000), (big, 1050)], [(1, 9000)])
    out = str(tmp_path / "out")
    streams.run_to_files(streams.sessionize_stateful(stream, "u", "t", 100, "400 seconds"), out, str(tmp_path / "ckpt"))
    assert {(r.u, r.click_count) for r in spark.read.parquet(out).collect()} == {(big, 2), (None, 1)}
