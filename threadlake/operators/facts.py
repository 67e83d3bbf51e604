"""Incremental fact extraction.

One DAG per run: pending sessions → transcript packing → extractor →
reply parsing → classification → memory rows → exact-content dedupe →
marker advance → run report.  State is a ``markers(session_id,
last_turn_idx)`` table; memory is a ``memory(content_hash, content, metadata)``
table.  Nothing is collected; the only Python is the user's extractor
callable, run through ``mapInPandas``.
"""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.functions.text import full_trim
from threadlake.operators.sessions import in_recent_window, one_row_join, usable_for_transcript

# Fixed run limits and labels.
MAX_CHARS_PER_BATCH = 12000
MAX_TURNS_PER_BATCH = 150
MAX_SESSIONS_PER_RUN = 40
CHUNK_CHARS = 2000
MIN_TRANSCRIPT_CHARS = 200
SOURCE_TAG = "fact-extract"   # default tag marking extracted facts; a parameter of memory_rows
FACT_TYPES = ("decision", "config", "outcome", "correction", "discovery")


# --- E1 --------------------------------------------------------------------------

def pending_sessions(sessions: DataFrame, markers: DataFrame, as_of: str, hours: int = 24,
                     min_turns: int = 4, max_sessions: int | None = MAX_SESSIONS_PER_RUN,
                     session_id: str | None = None) -> DataFrame:
    """Sessions to process this run with their ``since`` marker.

    Window: ended_at > as_of − hours and turn_count ≥ min_turns (F9); pending
    when marker < turn_count − 1 (J10 default −1); newest ``max_sessions`` by
    ended_at (W6).  An explicit ``session_id`` bypasses window, minimum and
    marker (since = −1).
    """
    m = markers.select("session_id", F.col("last_turn_idx").alias("_marker"))
    if session_id is not None:
        s = sessions.filter(F.col("session_id") == session_id)
        return s.select("session_id", "ai_title", "node", "started_at", "ended_at", "turn_count",
                        F.lit(-1).alias("since"))
    s = sessions.filter(in_recent_window(F.lit(as_of).cast("timestamp"), hours, min_turns))
    s = s.join(m, "session_id", "left").withColumn("since", F.coalesce("_marker", F.lit(-1)))
    s = s.filter(F.col("since") < F.col("turn_count") - 1)
    # W6 cap (None = every pending session; a huge limit would plan a huge top-k buffer)
    top = s if max_sessions is None else s.orderBy(F.col("ended_at").desc(), F.col("session_id")).limit(max_sessions)
    return top.select("session_id", "ai_title", "node", "started_at", "ended_at", "turn_count", "since")


# --- E2 / E3 ---------------------------------------------------------------------------

def pack_transcripts(pending: DataFrame, turns: DataFrame, max_chars: int | None = MAX_CHARS_PER_BATCH,
                     max_turns: int | None = MAX_TURNS_PER_BATCH,
                     chunk_chars: int | None = CHUNK_CHARS) -> DataFrame:
    """Greedy transcript per pending session.

    Among usable turns after ``since`` (F13) keep the prefix whose running
    length of ``text[:chunk_chars]`` stays ≤ max_chars and whose count stays ≤
    max_turns; unusable turns before the first rejected one still advance the
    marker.  ``last_idx`` = max turn_idx below the first rejected usable turn
    (all turns when none is rejected; ``since`` when there are none).

    Only the first ``max_turns + 1`` usable turns per session can matter, so a
    per-session top-n (partial WindowGroupLimit before the shuffle) bounds the
    windowed work even for a session holding a third of all turns; the marker
    is a partial-aggregated max.

    None switches a limit off.  ``chunk_chars`` loses the tail of a longer turn
    for good, because the marker moves past the turn; what ``max_chars`` and
    ``max_turns`` reject is left for the next run.

    Output: session_id, since, transcript, n_turns, last_idx, too_short (E3).
    """
    p = pending.select("session_id", "since")
    t = (turns.select("session_id", "turn_idx", "role", "text").join(p, "session_id")
         .filter(F.col("turn_idx") > F.col("since")))
    usable = t.filter(usable_for_transcript())
    w = Window.partitionBy("session_id").orderBy("turn_idx")
    first_n = usable.withColumn("rn", F.row_number().over(w))
    if max_turns is not None:
        first_n = first_n.filter(F.col("rn") <= max_turns + 1)
    chunk = F.col("text") if chunk_chars is None else F.substring("text", 1, chunk_chars)
    run = (first_n.withColumn("chunk", chunk)
           .withColumn("rs", F.sum(F.length("chunk")).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    keep = F.lit(True)
    if max_chars is not None:
        keep = keep & (F.col("rs") <= max_chars)
    if max_turns is not None:
        keep = keep & (F.col("rn") <= max_turns)
    packed = run.groupBy("session_id").agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.when(keep, F.struct(
                F.col("turn_idx"), F.concat(F.lit("["), F.col("role"), F.lit("]: "), F.col("chunk")).alias("line"))))),
            lambda x: x["line"]), "\n\n").alias("transcript"),
        F.count_if(keep).alias("n_turns"),
        F.min(F.when(~keep, F.col("turn_idx"))).alias("first_rejected"))
    cut = p.join(packed, "session_id", "left")
    reach = (t.join(cut.select("session_id", "first_rejected"), "session_id", "left")
             .filter(F.col("first_rejected").isNull() | (F.col("turn_idx") < F.col("first_rejected")))
             .groupBy("session_id").agg(F.max("turn_idx").alias("_reach")))
    out = cut.join(reach, "session_id", "left")
    transcript = F.coalesce("transcript", F.lit(""))
    return out.select(
        "session_id", "since", transcript.alias("transcript"),
        F.coalesce("n_turns", F.lit(0)).alias("n_turns"),
        F.coalesce("_reach", F.col("since")).cast("int").alias("last_idx"),
        (F.length(transcript) < MIN_TRANSCRIPT_CHARS).alias("too_short"))


# --- E4 ------------------------------------------------------------------------------------

_REPLY = "session_id string, reply string, ok boolean, error string"
#: Seconds a call may take (fixed), calls at a time per task, and calls that may
#: hang in a task before it makes no more.
DEADLINE, CALLS, LOST = 120.0, 8, 64


def _call_all(extractor: Callable[[str], str], texts: list[str], deadline: float, calls: int, retries: int, lost: list):
    """(reply, ok, error) of each text.

    ``calls`` run at a time, each in a daemon thread.  A call that is not back by
    its deadline is given up: its thread is left behind (nothing can end it), its
    place is free for the next one.  A call that raises is made again up to
    ``retries`` times.  After ``LOST`` threads left behind, the rest fails at
    once."""
    out: list = [None] * len(texts)
    done: queue.SimpleQueue = queue.SimpleQueue()
    todo = [(i, 0) for i in reversed(range(len(texts)))]
    running: dict[tuple[int, int], float] = {}

    def work(i: int, attempt: int) -> None:
        try:
            done.put((i, attempt, extractor(texts[i]), None))
        except Exception as e:  # noqa: BLE001 - any failure is an outcome of its row
            done.put((i, attempt, None, f"{type(e).__name__}: {e}"))

    while todo or running:
        while todo and len(running) < calls:
            i, attempt = todo.pop()
            if len(lost) >= LOST:
                out[i] = (None, False, "not called: too many calls hang")
                continue
            running[i, attempt] = time.monotonic() + deadline
            threading.Thread(target=work, args=(i, attempt), daemon=True).start()
        if not running:
            break
        try:
            i, attempt, reply, error = done.get(timeout=max(0.0, min(running.values()) - time.monotonic()))
        except queue.Empty:
            now = time.monotonic()
            for key in [k for k, end in running.items() if end <= now]:
                del running[key]
                lost.append(key)
                out[key[0]] = (None, False, f"no reply in {deadline:g} s")
            continue
        if running.pop((i, attempt), None) is None:
            continue  # came after its deadline
        if error is None:
            out[i] = (reply, True, None)
        elif attempt < retries:
            todo.append((i, attempt + 1))
        else:
            out[i] = (None, False, error)
    return out


def extract(packed: DataFrame, extractor: Callable[[str], str], deadline: float = DEADLINE, calls: int = CALLS,
            retries: int = 0) -> DataFrame:
    """Run the user's extractor on every transcript that is not too short.

    Calls that fail or miss the deadline give ``ok = false``, no reply and an
    error, so neither a bad call nor one that hangs stops the run; the markers
    of these sessions do not advance, and the next run takes them again.
    Output: session_id, reply, ok, error.
    """
    todo = packed.filter(~F.col("too_short")).select("session_id", "transcript")

    def run(batches):
        lost: list = []
        for pdf in batches:
            texts = pdf["transcript"].tolist()
            for at in range(0, len(texts), 16 * calls):
                got = _call_all(extractor, texts[at:at + 16 * calls], deadline, calls, retries, lost)
                yield pd.DataFrame({"session_id": pdf["session_id"].iloc[at:at + len(got)].tolist(), "reply": [g[0] for g in got],
                                    "ok": [g[1] for g in got], "error": [g[2] for g in got]}).astype(
                    {"session_id": object, "reply": object, "ok": bool, "error": object})

    return todo.mapInPandas(run, _REPLY)


# --- E5 / E6 --------------------------------------------------------------------------------

def parse_replies(replies: DataFrame) -> DataFrame:
    """E5: slice first ``[`` … last ``]``, parse as a JSON array; anything else
    is an empty list.  Output: session_id, pos, elem (VARIANT)."""
    body = F.regexp_extract(F.coalesce("reply", F.lit("")), r"(?s)(\[.*\])", 1)
    arr = F.try_variant_get(F.try_parse_json(body), "$", "array<variant>")
    return replies.select("session_id", F.posexplode(F.coalesce(arr, F.array().cast("array<variant>")))
                          .alias("pos", "elem"))


def _has_key(elem: Column, key: str) -> Column:
    return F.try_variant_get(elem, f"$.{key}", "variant").isNotNull()


def classify_facts(elems: DataFrame) -> DataFrame:
    """Quarantined (not an object, or neither ``type`` nor ``fact`` key),
    failed (``fact`` missing or empty), candidate (type defaults to
    ``unknown``).  Output: session_id, pos, status, type, fact, tags."""
    e = F.col("elem")
    is_obj = F.coalesce(F.schema_of_variant(e).startswith("OBJECT"), F.lit(False))
    fact = F.try_variant_get(e, "$.fact", "string")
    typ = F.try_variant_get(e, "$.type", "string")
    status = (F.when(~is_obj | (~_has_key(e, "type") & ~_has_key(e, "fact")), F.lit("quarantined"))
              .when(fact.isNull() | (fact == ""), F.lit("failed"))
              .otherwise(F.lit("candidate")))
    return elems.select("session_id", "pos", status.alias("status"),
                        F.coalesce(typ, F.lit("unknown")).alias("type"), fact.alias("fact"),
                        F.coalesce(F.try_variant_get(e, "$.tags", "array<string>"),
                                   F.array().cast("array<string>")).alias("tags"))


# --- E7 / E8 ------------------------------------------------------------------------------------

def memory_rows(facts: DataFrame, sessions: DataFrame, extracted_at: str,
                source_tag: str = SOURCE_TAG) -> DataFrame:
    """Content ``[type] fact``; tags + source tag + ``node:<n>``;
    metadata struct.  Keeps ``order_key`` (session ended_at desc, session,
    position) for the dedupe."""
    s = sessions.select("session_id", "node", "ended_at")
    f = facts.filter(F.col("status") == "candidate").join(s, "session_id", "left")
    tags = F.concat(F.col("tags"), F.array(F.lit(source_tag),
                                           F.concat(F.lit("node:"), F.coalesce("node", F.lit("unknown")))))
    content = F.concat(F.lit("["), F.col("type"), F.lit("] "), F.col("fact"))
    return f.select(
        "session_id", "pos", content.alias("content"),
        F.struct(F.col("type"), F.lit(source_tag).alias("source"), F.col("session_id"),
                 tags.alias("tags"), F.lit(extracted_at).alias("extracted_at")).alias("metadata"),
        F.struct((-F.unix_timestamp(F.try_to_timestamp(F.col("ended_at")))).alias("k0"),
                 F.col("session_id").alias("k1"), F.col("pos").alias("k2")).alias("order_key"))


def dedupe(rows: DataFrame, memory: DataFrame | None = None) -> DataFrame:
    """Exact-content dedupe.  The first copy (by ``order_key``) of a content
    not yet in ``memory`` is ``stored``; every other copy is ``duplicate``.

    Skew-safe: the first copy per content is a partial-aggregated ``min``; only
    these rows, one per content, meet the memory, and the join back is on (content
    hash, order key), which is unique — so a content that makes up a third of all
    rows never lands in one task.
    """
    h = rows.withColumn("content_hash", F.sha2(F.col("content"), 256))
    first = h.groupBy("content_hash").agg(F.min("order_key").alias("order_key"))
    if memory is not None:
        first = first.join(memory.select("content_hash"), "content_hash", "left_anti")
    out = h.join(first.withColumn("_new", F.lit(True)), ["content_hash", "order_key"], "left")
    return out.withColumn("status", F.when(F.col("_new").isNotNull(), F.lit("stored")).otherwise(F.lit("duplicate"))).drop("_new")


# --- E9 / E10 ------------------------------------------------------------------------------------

def advance_markers(markers: DataFrame, packed: DataFrame, replies: DataFrame | None = None,
                    legacy: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """New marker = last consumed turn for every processed session whose
    extraction did not fail (too-short sessions advance too); legacy sessions
    without a marker are seeded at turn_count − 1.  Max per session."""
    adv = packed.select("session_id", "last_idx", "too_short")
    if replies is not None:
        failed = replies.filter(~F.col("ok")).select("session_id")
        adv = adv.join(failed, "session_id", "left_anti")
    parts = [markers.select("session_id", "last_turn_idx"),
             adv.select("session_id", F.col("last_idx").alias("last_turn_idx"))]
    if legacy is not None and sessions is not None:
        seeded = (legacy.join(markers, "session_id", "left_anti").join(sessions, "session_id")
                  .select("session_id", (F.col("turn_count") - 1).alias("last_turn_idx")))
        parts.append(seeded)
    allm = parts[0]
    for p in parts[1:]:
        allm = allm.unionByName(p)
    return allm.groupBy("session_id").agg(F.max("last_turn_idx").cast("int").alias("last_turn_idx"))


def run_report(packed: DataFrame, replies: DataFrame, facts: DataFrame, deduped: DataFrame) -> DataFrame:
    """One row of run counts."""
    p = packed.agg(F.count(F.lit(1)).alias("sessions"), F.count_if("too_short").alias("too_short"))
    r = replies.agg(F.count_if(~F.col("ok")).alias("extract_failed"))
    f = facts.agg(F.count(F.lit(1)).alias("extracted"),
                  F.count_if(F.col("status") == "quarantined").alias("quarantined"),
                  F.count_if(F.col("status") == "failed").alias("failed"))
    d = deduped.agg(F.count_if(F.col("status") == "stored").alias("stored"),
                    F.count_if(F.col("status") == "duplicate").alias("duplicate"))
    return one_row_join([p, r, f, d])


def stub_extractor(transcript: str) -> str:
    """Deterministic stand-in for a model endpoint (tests and registered
    queries): one fact per transcript line, shapes cycling through complete,
    missing type, missing fact, empty fact and non-object; wrapped in prose."""
    import json

    items = []
    for i, line in enumerate(transcript.split("\n\n")):
        body = full_text = line.split("]: ", 1)[-1]
        words = " ".join(full_text.split()[:2])
        kind = (i + len(transcript)) % 6
        if kind in (0, 1):
            items.append({"fact": words, "type": FACT_TYPES[i % 5], "tags": [f"t{i % 3}"]})
        elif kind == 2:
            items.append({"fact": words, "tags": []})
        elif kind == 3:
            items.append({"type": "config", "tags": ["x"]})
        elif kind == 4:
            items.append({"fact": "", "type": "outcome"})
        else:
            items.append({"note": body[:20]})
    return "Here are the facts:\n```json\n" + json.dumps(items) + "\n```"


def extraction_run(sessions: DataFrame, turns: DataFrame, markers: DataFrame, memory: DataFrame | None,
                   extractor: Callable[[str], str], as_of: str, hours: int = 24,
                   base: str | None = None, snapshot_id: int | None = None, dry_run: bool = False,
                   session_id: str | None = None, legacy: DataFrame | None = None,
                   source_tag: str = SOURCE_TAG, **pack_args) -> dict[str, DataFrame]:
    """E1–E10.  The replies are checkpointed, so the extractor is called once per
    transcript whatever reads them later.  With ``base`` and not ``dry_run`` the
    new markers and the stored memory rows are published together: both tables
    are written first, then one pointer names the pair, so a failed run publishes
    neither and the next one takes a new id."""
    from threadlake.session import cut_lineage
    from threadlake.sources import snapshots as SN

    pending = pending_sessions(sessions, markers, as_of, hours, session_id=session_id)
    packed = pack_transcripts(pending, turns, **pack_args)
    replies = cut_lineage(extract(packed, extractor))
    facts = classify_facts(parse_replies(replies))
    deduped = dedupe(memory_rows(facts, sessions, as_of, source_tag), memory)
    new_markers = advance_markers(markers, packed, replies, legacy, sessions)
    report = run_report(packed, replies, facts, deduped)
    if base is not None and not dry_run:
        stored = deduped.filter(F.col("status") == "stored").select(
            "content_hash", "content", "metadata")
        mem_all = stored if memory is None else memory.select("content_hash", "content", "metadata").unionByName(stored)
        SN.publish({"memory": mem_all, "markers": new_markers}, base, snapshot_id)
    return {"pending": pending, "packed": packed, "replies": replies, "facts": facts,
            "deduped": deduped, "markers": new_markers, "report": report}
