"""Structured Streaming operators: dedup, windows, sessions, upserts, joins.

Runs use the available-now trigger: take what is there, commit, stop.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.windows import latest_per_key
from ..session import stream_width
from ..sources.tables import append_batch

# text form of keys and stored rows: exact to the microsecond, nulls kept
_ROW_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
             "ignoreNullFields": "false"}
# Keys of a stateful Python operator share this many states: a call of Python and of the state store then serves many
# keys of a large table, and still few of a small batch. It may not change while checkpoints exist.
STATES = 1 << 12

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state off the heap; needed by the stateful session operator."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None, **options: str) -> DataFrame:
    """A table written by another stream (or files) as the next stream's source.

    The sink is append-only, so changed rows never reach the reader.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_to_files(stream: DataFrame, out: str, checkpoint: str) -> None:
    with stream_width(stream.sparkSession):
        query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start(out)
    query.awaitTermination()


def _state_of(key: str) -> Column:
    """The number of the state that a key's rows meet in."""
    return F.pmod(F.xxhash64(key), F.lit(STATES)).cast("int").alias("state_no")


def dedup_stream(df: DataFrame, ids: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Repeats inside the watermark dropped; state expires with the watermark."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(ids))


def tumbling_counts(df: DataFrame, ts: str, width: str, keys: Sequence[str] = (), delay: str = "1 minute", since: str | None = None) -> DataFrame:
    """Counts per window and key; ``since`` keeps only later events."""
    if since is not None:
        df = df.filter(F.col(ts) >= F.lit(since).cast("timestamp"))
    counted = df.withWatermark(ts, delay).groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n")


def running_aggregate(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Totals over everything seen so far; write it in complete mode."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def keep_latest_result(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Complete-mode result replaced after every micro-batch."""

    def swap(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    with stream_width(stream.sparkSession):
        query = stream.writeStream.outputMode("complete").foreachBatch(swap).option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start()
    query.awaitTermination()


def sessionize_window(df: DataFrame, key: str, ts: str, gap_seconds: int, delay: str = "10 minutes") -> DataFrame:
    """Closed sessions with the built-in session window.

    A session ends when the next event of the key is more than ``gap_seconds``
    away. Sessions are merged on the map side before the shuffle (see
    ``session.RUNTIME_CONF``), so a hot key sends few rows.
    """
    grouped = df.withWatermark(ts, delay).groupBy(F.session_window(ts, f"{gap_seconds} seconds").alias("w"), key).agg(
        F.count(F.lit(1)).alias("click_count"))
    return grouped.select(
        key, "click_count", F.col("w.start").alias("start"),
        (F.col("w.end") - F.make_dt_interval(secs=F.lit(float(gap_seconds)))).alias("end"),
        F.lit("offline").alias("status"))


def _partial_sessions(gap_us: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Events of one key within one stretch of ``gap`` belong together: reduce
    each Arrow batch to such stretches before anything is shuffled."""

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                cell = pdf["us"] // gap_us
                yield pdf.groupby(["k", cell.rename("cell")], sort=False)["us"].agg(
                    first_us="min", last_us="max", clicks="count").reset_index().drop(columns="cell")

    return reduce


class SessionProcessor(StatefulProcessor):
    """Open sessions of the keys of one state; a timer closes each when the watermark passes its end plus the gap.

    Several sessions of a key can be open at once, because events may arrive out of
    order within the watermark: a late event can extend or join them.
    """

    def __init__(self, gap_us: int, report_online: bool):
        self.gap_us = gap_us
        self.report_online = report_online

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState(
            "open", "k array<string>, first_us array<bigint>, last_us array<bigint>, clicks array<bigint>, due bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        spans, due = self._stored()
        fresh: dict[str, list[tuple]] = {}
        for pdf in rows:
            for k, *span in zip(pdf["k"].tolist(), pdf["first_us"].tolist(), pdf["last_us"].tolist(), pdf["clicks"].tolist()):
                fresh.setdefault(k, []).append(tuple(span))
        for k, more in fresh.items():
            merged: list[list[int]] = []
            for first, last, clicks in sorted(spans.get(k, []) + more):
                if merged and first - merged[-1][1] <= self.gap_us:
                    merged[-1][1] = max(merged[-1][1], last)
                    merged[-1][2] += clicks
                else:
                    merged.append([first, last, clicks])
            spans[k] = [tuple(m) for m in merged]
        self._store(spans, due)
        if self.report_online:
            yield self._frame([(k, spans[k][-1]) for k in fresh], closed=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        spans, due = self._stored()
        closed = [(k, s) for k, held in spans.items() for s in held if self._expiry(s) <= now]
        kept = {k: [s for s in held if self._expiry(s) > now] for k, held in spans.items()}
        self._store({k: held for k, held in kept.items() if held}, None if due is None or due <= now else due)
        if closed:
            yield self._frame(closed, closed=True)

    def _stored(self) -> tuple[dict[str, list[tuple]], int | None]:
        spans: dict[str, list[tuple]] = {}
        held = self.open.get()
        if held is None:
            return spans, None
        for k, *span in zip(*held[:4]):
            spans.setdefault(k, []).append(tuple(int(v) for v in span))
        return spans, held[4]

    def _store(self, spans: dict[str, list[tuple]], due: int | None) -> None:
        """Keep the spans and one timer, for the session due first."""
        rows = [(k, *s) for k, held in spans.items() for s in held]
        first = min((self._expiry(r[1:]) for r in rows), default=None)
        if first != due:
            if due is not None:
                self.handle.deleteTimer(due)
            if first is not None:
                self.handle.registerTimer(first)
        if rows:
            self.open.update((*map(list, zip(*rows)), first))
        else:
            self.open.clear()

    def _expiry(self, span) -> int:
        # rounded up to the millisecond, so that nothing closes early
        return -(-(span[1] + self.gap_us) // 1000)

    def _frame(self, spans, closed: bool) -> pd.DataFrame:
        return pd.DataFrame({
            "k": [k for k, _ in spans], "click_count": [s[2] for _, s in spans],
            "first_us": [s[0] for _, s in spans], "last_us": [s[1] for _, s in spans], "closed": [closed] * len(spans),
        })

    def close(self) -> None:
        pass


def sessionize_stateful(df: DataFrame, key: str, ts: str, gap_seconds: int, delay: str = "10 minutes", report_online: bool = False) -> DataFrame:
    """Sessions from explicit per-key state and event-time timers.

    Emits a row with status ``offline`` when the watermark passes a session's
    end plus the gap; with ``report_online`` also the newest open session after
    every micro-batch (then write in update mode).
    """
    use_rocksdb(df.sparkSession)
    gap_us = gap_seconds * 1_000_000
    kind = df.schema[key].dataType.simpleString()
    named = F.to_json(F.struct(F.col(key).alias("k")), _ROW_JSON)
    events = df.select(named.alias("k"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"))
    partial = events.mapInPandas(_partial_sessions(gap_us), "k string, first_us bigint, last_us bigint, clicks bigint")
    marked = partial.withColumns({"seen": F.timestamp_micros("last_us"), "state_no": _state_of("k")}).withWatermark("seen", delay)
    out = marked.groupBy("state_no").transformWithStateInPandas(
        SessionProcessor(gap_us, report_online),
        "k string, click_count bigint, first_us bigint, last_us bigint, closed boolean",
        "Update" if report_online else "Append", "EventTime",
    )
    return out.select(
        F.from_json("k", f"k {kind}", _ROW_JSON)["k"].alias(key), "click_count", F.timestamp_micros("first_us").alias("start"),
        F.timestamp_micros("last_us").alias("end"),
        F.when(F.col("closed"), "offline").otherwise("online").alias("status"))


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, mode: str = "update") -> None:
    """Append every micro-batch of changed rows to a log table, each under its number.

    ``sources.tables.latest_rows`` gives the current table. A batch that is run
    again after a failure replaces itself.
    """
    with stream_width(stream.sparkSession):
        query = stream.writeStream.outputMode(mode).foreachBatch(lambda batch, i: append_batch(batch, i, path)).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def stream_rollup(df: DataFrame, ts: str, keys: Sequence[str], aggs: Mapping[str, Column], path: str, checkpoint: str,
                  width: str = "1 hour", delay: str = "3 hours") -> None:
    """Windowed totals that stay open for ``delay``; each change of one is a row of the log (``latest_rows`` by window and keys)."""
    rolled = df.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), *keys).agg(
        *[c.alias(n) for n, c in aggs.items()])
    flat = rolled.select(F.col("w.start").alias("window_start"), *keys, *aggs)
    upsert_stream(flat, path, checkpoint)


# ---- changes from state -----------------------------------------------------

CHANGE, VERSION = "_change_type", "_commit_version"


def _newest_per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per key of each Arrow batch, so that a key with most of the changes sends few."""
    for pdf in batches:
        if len(pdf):
            yield pdf.sort_values(["at", "gone", "body"], kind="stable").drop_duplicates("k", keep="last")


class ChangeProcessor(StatefulProcessor):
    """Keeps the newest change of each key of one state, a delete as a tombstone, and emits what a batch did to its row.

    Of equal sequences a delete counts, else the larger row: the outcome does
    not depend on the order of arrival.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState(
            "last", "k array<string>, at array<bigint>, gone array<boolean>, body array<string>, version array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.last.get()
        stored = {} if held is None else {k: (int(at), bool(gone), body, int(n)) for k, at, gone, body, n in zip(*held)}
        newest: dict[str, tuple] = {}
        for pdf in rows:
            for k, *change in zip(pdf["k"].tolist(), pdf["at"].tolist(), pdf["gone"].tolist(), pdf["body"].tolist()):
                change = tuple(change)
                if k not in newest or change > newest[k]:
                    newest[k] = change
        events, touched = [], False
        for k, change in newest.items():
            before = stored.get(k)
            if before is not None and change <= before[:3]:
                continue
            touched = True
            old = None if before is None or before[1] else before[2]
            new = None if change[1] else change[2]
            version = (0 if before is None else before[3]) + (old != new)
            stored[k] = (*change, version)
            if old == new:
                continue
            if old is None:
                events.append((k, new, "insert", version))
            elif new is None:
                events.append((k, old, "delete", version))
            else:
                events += [(k, old, "update_preimage", version), (k, new, "update_postimage", version)]
        if touched:
            self.last.update(tuple(map(list, zip(*((k, *row) for k, row in stored.items())))))
        if events:
            yield pd.DataFrame(events, columns=["k", "body", "change", "version"])

    def close(self) -> None:
        pass


def changes_from_state(df: DataFrame, keys: Sequence[str], sequence: Column, delete_when: str, except_columns: Sequence[str] = ()) -> DataFrame:
    """A stream of change rows to the feed of what they do to the table.

    The state holds the newest row per key with its ``sequence`` (a whole
    number, null lowest). Per micro-batch and key the net change comes out as
    ``insert``, ``update_preimage`` and ``update_postimage``, or ``delete``, in
    ``_change_type``; ``_commit_version`` counts the changes of the key. Late,
    repeated and ineffective changes give no row. The output is append-only:
    ``current_rows`` reduces it to the table. Null keys are keys like others.
    """
    use_rocksdb(df.sparkSession)
    values = [c for c in df.columns if c not in (*keys, *except_columns)]
    row_type = {f.name: f.dataType.simpleString() for f in df.schema}
    spelled = lambda names: ", ".join(f"`{c}` {row_type[c]}" for c in names)
    packed = df.select(
        F.to_json(F.struct(*keys), _ROW_JSON).alias("k"),
        F.coalesce(sequence.cast("long"), F.lit(-(2**63))).alias("at"),
        F.coalesce(F.expr(delete_when), F.lit(False)).alias("gone"),
        F.to_json(F.struct(*values), _ROW_JSON).alias("body"))
    reduced = packed.mapInPandas(_newest_per_batch, packed.schema).withColumn("state_no", _state_of("k"))
    out = reduced.groupBy("state_no").transformWithStateInPandas(
        ChangeProcessor(), "k string, body string, change string, version bigint", "Append", "None")
    opened = out.select(F.from_json("k", spelled(keys), _ROW_JSON).alias("k"), F.from_json("body", spelled(values), _ROW_JSON).alias("r"),
                        F.col("change").alias(CHANGE), F.col("version").alias(VERSION))
    return opened.select("k.*", "r.*", CHANGE, VERSION)


def current_rows(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table that a change feed leads to."""
    after = latest_per_key(feed.filter(F.col(CHANGE) != "update_preimage"), keys, [VERSION])
    return after.filter(F.col(CHANGE) != "delete").drop(CHANGE, VERSION)


def join_stream_static(stream: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A stream enriched by a reference table (read again for every micro-batch)."""
    return stream.join(table, list(on), how)


def join_stream_stream(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, delay: str, within: str) -> DataFrame:
    """Pairs of two streams on a key whose times differ by at most ``within``.

    The bound lets Spark drop state once the watermark has passed.
    """
    a = left.withWatermark(left_ts, delay)
    b = right.withColumnsRenamed({k: f"_r_{k}" for k in on}).withWatermark(right_ts, delay)
    span = F.expr(f"INTERVAL {within}")
    cond = (F.col(right_ts) >= F.col(left_ts) - span) & (F.col(right_ts) <= F.col(left_ts) + span)
    for k in on:
        cond = cond & (F.col(k) == F.col(f"_r_{k}"))
    return a.join(b, cond).drop(*[f"_r_{k}" for k in on])


def session_durations(sessions: DataFrame) -> DataFrame:
    """Mean length and number of sessions per status."""
    length = F.unix_micros("end") - F.unix_micros("start")
    return sessions.groupBy("status").agg(F.avg(length / 1_000_000).alias("mean_seconds"), F.count(F.lit(1)).alias("n"))
