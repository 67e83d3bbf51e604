"""Token-pressure monitor (ST1–ST4, F12, J8).

* ST1 ``usage_tokens``  – keep ``message_start`` events; tokens = input +
  cache-read + cache-creation (missing → 0)
* F12 ``context_size``  – model → context window by first matching substring
* ST2 ``bells``         – one row per threshold reached by a request (stateless,
  works on batch and streaming DataFrames alike)
* ST3 ``latch``         – each stop consumes the bells of its session since the
  previous stop; highest level wins (batch: skew-safe as-of join; stream:
  ``applyInPandasWithState`` keyed by session)
* ST4 ``pressure``      – none / pressure / critical from the highest level
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from threadlake.operators.asof import asof_join

# Fixed monitor values.
THRESHOLDS = (70, 85, 95)
# Model-name substring → context size, first match wins.  Every entry of the
# original table equals the default size, so an empty table gives the same
# sizes; pass your own table for models with other windows.
MODEL_CONTEXTS: tuple[tuple[str, int], ...] = ()
DEFAULT_CONTEXT = 200000
PRESSURE_LEVEL, CRITICAL_LEVEL = 85, 95


def usage_tokens(events: DataFrame) -> DataFrame:
    """ST1: (…, tokens) for message_start events."""
    tok = (F.coalesce(F.col("input_tokens"), F.lit(0)) + F.coalesce(F.col("cache_read_input_tokens"), F.lit(0))
           + F.coalesce(F.col("cache_creation_input_tokens"), F.lit(0)))
    return events.filter(F.col("type") == "message_start").withColumn("tokens", tok)


def context_size(model: Column, contexts=MODEL_CONTEXTS, default: int = DEFAULT_CONTEXT) -> Column:
    """first substring (in list order) contained in the model name."""
    return F.coalesce(*[F.when(F.coalesce(model, F.lit("")).contains(sub), F.lit(size))
                        for sub, size in contexts], F.lit(default))


def bells(usage: DataFrame, contexts=MODEL_CONTEXTS, default: int = DEFAULT_CONTEXT,
          thresholds=THRESHOLDS) -> DataFrame:
    """ST2: one row per (request, threshold ≤ pct)."""
    u = usage_tokens(usage).withColumn("max_tokens", context_size(F.col("model"), contexts, default))
    pct = F.col("tokens") / F.col("max_tokens") * 100.0
    ths = F.array(*[F.lit(t) for t in thresholds])
    return u.select("event_id", "session_id", "ts", F.col("tokens").alias("token_count"), "max_tokens",
                    (F.round(pct * 10.0, 0) / 10.0).alias("percentage"),
                    F.explode(F.filter(ths, lambda t: pct >= t)).alias("level"))


def pressure(level: Column) -> Column:
    """ST4."""
    return (F.when(level >= CRITICAL_LEVEL, F.lit("critical"))
            .when(level >= PRESSURE_LEVEL, F.lit("pressure")).otherwise(F.lit("none")))


def latch(bell_rows: DataFrame, stops: DataFrame) -> DataFrame:
    """ST3 / J8 (batch): per stop event, the highest bell of its session since
    the previous stop (the latest bell of that level supplies the numbers).  Output: session_id, stop_event_id, ts, level,
    percentage, token_count, label (``bell_N`` or ``periodic``), pressure."""
    # an id per bell for ties: events ring a bell of a level once, levels are below 1024
    b = bell_rows.withColumn("bell_id", F.col("event_id") * 1024 + F.col("level"))
    s = stops.select("session_id", F.col("event_id").alias("stop_event_id"), "ts")
    m = asof_join(b, s, "session_id", "ts", "bell_id", "stop_event_id", "forward")
    best = (m.filter(F.col("stop_event_id").isNotNull()).groupBy("stop_event_id")
            .agg(F.max_by(F.struct("level", "percentage", "token_count"),
                          F.struct("level", "ts", "event_id")).alias("b")))
    out = s.join(best, "stop_event_id", "left")
    lvl = F.col("b.level")
    return out.select("session_id", "stop_event_id", "ts", lvl.alias("level"),
                      F.col("b.percentage").alias("percentage"), F.col("b.token_count").alias("token_count"),
                      F.when(lvl.isNull(), F.lit("periodic")).otherwise(F.concat(F.lit("bell_"), lvl.cast("string")))
                      .alias("label"),
                      pressure(F.coalesce(lvl, F.lit(0))).alias("pressure"))


# --- streaming ------------------------------------------------------------------------------

LATCH_OUT = ("session_id string, stop_event_id long, ts timestamp_ntz, level int, percentage double, "
             "token_count double, label string, pressure string")
LATCH_STATE = "level int, percentage double, token_count double"


def _latch_fn(ttl_ms: int | None, key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Per-session latch: bells raise the held level; a stop emits and resets."""
    if state.hasTimedOut:
        state.remove()
        return
    held = state.get if state.exists else (None, None, None)
    out = []
    rows = pd.concat(list(pdfs)) if pdfs else pd.DataFrame()
    rows = rows.sort_values(["ts", "kind", "event_id"]) if len(rows) else rows
    for r in rows.itertuples(index=False):
        if r.kind == 0:
            if held[0] is None or r.level >= held[0]:  # latest bell of the highest level
                held = (int(r.level), float(r.percentage), float(r.token_count))
        else:
            lvl = held[0]
            label = "periodic" if lvl is None else f"bell_{lvl}"
            pr = "critical" if (lvl or 0) >= CRITICAL_LEVEL else ("pressure" if (lvl or 0) >= PRESSURE_LEVEL else "none")
            out.append((key[0], int(r.event_id), r.ts, lvl, held[1], held[2], label, pr))
            held = (None, None, None)
    if held[0] is None:
        state.remove()
    else:
        state.update(held)
        if ttl_ms is not None:
            last_ms = int(pd.Timestamp(rows["ets"].max()).value // 1_000_000)
            state.setTimeoutTimestamp(last_ms + ttl_ms)  # event-time TTL of a held bell
    if out:
        yield pd.DataFrame(out, columns=[c.split()[0] for c in LATCH_OUT.split(", ")])


def latch_stream(events: DataFrame, contexts=MODEL_CONTEXTS, default: int = DEFAULT_CONTEXT,
                 ttl_hours: int | None = None) -> DataFrame:
    """ST3 on a stream of usage rows carrying ``is_stop``: bells and stops are
    interleaved per session in event order within each micro-batch, state
    carries the held level across batches.  A held bell waits until a stop
    consumes it, as in the batch form.  With ``ttl_hours`` it expires that much
    event time after it rang, and events later than that are dropped by the
    watermark: bounded state, at the price of those rows."""
    b = bells(events, contexts, default).select(
        "session_id", "ts", "event_id", F.lit(0).alias("kind"), "level", "percentage", "token_count")
    s = events.filter(F.col("is_stop")).select(
        "session_id", "ts", "event_id", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("level"),
        F.lit(None).cast("double").alias("percentage"), F.lit(None).cast("double").alias("token_count"))
    ev = b.unionByName(s).withColumn("ets", F.col("ts").cast("timestamp"))
    if ttl_hours is not None:
        ev = ev.withWatermark("ets", f"{ttl_hours} hours")
    return (ev.groupBy("session_id")
            .applyInPandasWithState(partial(_latch_fn, ttl_hours and ttl_hours * 3600_000), LATCH_OUT, LATCH_STATE, "append",
                                    GroupStateTimeout.EventTimeTimeout if ttl_hours else GroupStateTimeout.NoTimeout))


# --- ordered by event time (transformWithState) ---------------------------------------------

ROCKSDB = ("spark.sql.streaming.stateStore.providerClass",
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class OrderedLatch(StatefulProcessor):
    """Bells and stops of one session wait in map state under their
    millisecond; a timer at that time takes them out when the watermark has
    passed it.  Timers fire in event-time order, so the latch sees events in
    order whatever batch they came in, and only the events of one millisecond
    are ever in hand."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", LATCH_STATE)
        self.waiting = handle.getMapState("waiting", "ms long", "events string")

    def handleInputRows(self, key, rows, timerValues):
        for pdf in rows:
            for ms, some in pdf.groupby("ms"):
                ms = int(ms)
                new = some[["us", "kind", "event_id", "level", "percentage", "token_count"]]
                new = json.loads(new.to_json(orient="values", double_precision=15))
                before = json.loads(self.waiting.getValue((ms,))[0]) if self.waiting.containsKey((ms,)) else []
                self.waiting.updateValue((ms,), (json.dumps(before + new),))
                self.handle.registerTimer(ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        ms = int(expiredTimerInfo.getExpiryTimeInMs())
        if not self.waiting.containsKey((ms,)):
            return iter([])
        events = sorted(json.loads(self.waiting.getValue((ms,))[0]), key=lambda e: e[:3])
        self.waiting.removeKey((ms,))
        held = self.held.get() if self.held.exists() else (None, None, None)
        out = []
        for us, kind, event_id, level, percentage, tokens in events:
            if kind == 0:
                if held[0] is None or level >= held[0]:
                    held = (int(level), float(percentage), float(tokens))
            else:
                top = held[0]
                out.append((key[0], int(event_id), pd.Timestamp(us, unit="us"), top, held[1], held[2],
                            "periodic" if top is None else f"bell_{top}",
                            "critical" if (top or 0) >= CRITICAL_LEVEL else "pressure" if (top or 0) >= PRESSURE_LEVEL else "none"))
                held = (None, None, None)
        if held[0] is None:
            self.held.clear()
        else:
            self.held.update(held)
        if not out:
            return iter([])
        df = pd.DataFrame(out, columns=[c.split()[0] for c in LATCH_OUT.split(", ")])
        return iter([df.astype({"level": "Int32"})])

    def close(self) -> None:
        pass


def latch_stream_ordered(events: DataFrame, lateness: str = "10 minutes", contexts=MODEL_CONTEXTS,
                         default: int = DEFAULT_CONTEXT) -> DataFrame:
    """ST3 on a stream whose events come out of order, also across
    micro-batches: a stop is given out once the watermark (``lateness`` behind the
    newest event) has passed it, with the bells before it in event time - the
    answer of the batch form for all events that are not later than that.
    The session's state store must be RocksDB (``ROCKSDB``)."""
    b = bells(events, contexts, default).select(
        "session_id", "ts", "event_id", F.lit(0).alias("kind"), "level", "percentage", "token_count")
    s = events.filter(F.col("is_stop")).select(
        "session_id", "ts", "event_id", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("level"),
        F.lit(None).cast("double").alias("percentage"), F.lit(None).cast("double").alias("token_count"))
    ets = F.col("ts").cast("timestamp")
    ev = b.unionByName(s).withColumns({"ets": ets, "us": F.unix_micros(ets), "ms": F.unix_millis(ets)}).drop("ts")
    return (ev.withWatermark("ets", lateness).groupBy("session_id")
            .transformWithStateInPandas(OrderedLatch(), LATCH_OUT, "append", "eventTime"))
