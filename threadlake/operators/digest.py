"""Per-session digests (D1–D5) and their building blocks.

Message tables carry (session_id, pos, ts, role, text) where ``pos`` orders
the messages of a session (file order / turn order).  "Last N per session"
is ``row_number() over (… desc) ≤ N``, which Spark plans as WindowGroupLimit:
a partial top-N runs before the shuffle, so a session with a third of all
rows ships only N rows per map partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlake.functions.text import full_trim
from threadlake.operators.asof import asof_join

# Fixed digest limits.
LAST_USER_MSGS, USER_CHARS = 5, 200
ASSISTANT_CHARS = 1000
LAST_FILES, LAST_OPS, OP_CHARS = 20, 10, 100
CHECKPOINT_MAX_AGE_MIN = 180
CHECKPOINT_MAX_CHARS, STATE_MAX_CHARS = 4000, 3000

# Fixed close-trigger phrases, in match-priority order.
CLOSE_TRIGGERS = (
    "save", "goodnight", "good night", "wrap up", "wrapping up",
    "closing", "close out", "done for today", "done for the day",
    "end session", "signing off", "signing out", "bye", "goodbye",
    "that's it for today", "thats it for today", "shutting down",
)


def last_n(df: DataFrame, n: int, part: str = "session_id", order: str = "pos") -> DataFrame:
    """The last ``n`` rows of each group (rank 1 = newest)."""
    w = Window.partitionBy(part).orderBy(F.col(order).desc())
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n)


def ordered_list(df: DataFrame, value: Column, part: str = "session_id", order: str = "pos",
                 name: str = "items") -> DataFrame:
    """collect rows into an array in ``order`` (bounded groups only)."""
    return df.groupBy(part).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"),
                                                                               value.alias("v")))),
                                            lambda x: x["v"]).alias(name))


def user_assistant_digest(messages: DataFrame) -> DataFrame:
    """D1 (messages part): last 5 user messages (200 chars, newlines → space,
    ``[ts16] text``) and the last assistant message (1000 chars) per session.

    messages(session_id, pos, ts, role, text): text already flattened (P2)
    and stripped; empty texts are ignored.
    """
    m = messages.filter(F.col("text").isNotNull() & (F.col("text") != ""))
    users = last_n(m.filter(F.col("role") == "user"), LAST_USER_MSGS)
    line = F.concat(F.lit("  ["), F.substring(F.coalesce("ts", F.lit("")), 1, 16), F.lit("] "),
                    F.replace(F.substring("text", 1, USER_CHARS), F.lit("\n"), F.lit(" ")))
    u = ordered_list(users, line, name="_u").select("session_id", F.array_join("_u", "\n").alias("recent_user"))
    a = (m.filter(F.col("role") == "assistant").groupBy("session_id")
         .agg(F.max_by(F.struct("ts", "text"), "pos").alias("_a"))
         .select("session_id", F.substring("_a.ts", 1, 16).alias("last_assistant_ts"),
                 F.substring("_a.text", 1, ASSISTANT_CHARS).alias("last_assistant")))
    return u.join(a, "session_id", "full")


def files_touched(tool_uses: DataFrame) -> DataFrame:
    """Edit/Write ``file_path`` values, unique by first appearance,
    last 20 per session.  tool_uses(session_id, pos, name, file_path, …)."""
    f = (tool_uses.filter(F.col("name").isin("Edit", "Write") & F.col("file_path").isNotNull()
                          & (F.col("file_path") != ""))
         .groupBy("session_id", "file_path").agg(F.min("pos").alias("pos")))
    return ordered_list(last_n(f, LAST_FILES), F.col("file_path"), name="files")


def operations(tool_uses: DataFrame) -> DataFrame:
    """D3: Bash description, else the first 80 characters of the command;
    last 10 per session, each cut to 100 characters."""
    entry = F.coalesce(F.nullif(F.col("description"), F.lit("")), F.substring(F.col("command"), 1, 80))
    ops = tool_uses.filter(F.col("name") == "Bash").withColumn("op", entry).filter(
        F.col("op").isNotNull() & (F.col("op") != ""))
    return ordered_list(last_n(ops, LAST_OPS), F.substring("op", 1, OP_CHARS), name="ops")


def session_digest(messages: DataFrame, tool_uses: DataFrame | None = None) -> DataFrame:
    """One digest row per session (+ files and operations when tool uses
    are given)."""
    d = user_assistant_digest(messages)
    if tool_uses is not None:
        d = d.join(files_touched(tool_uses), "session_id", "full").join(operations(tool_uses), "session_id", "full")
    return d


def render_checkpoint(digest: DataFrame, saved_at: str, trigger: Column | None = None, cwd: Column | None = None) -> DataFrame:
    """Checkpoint text of a digest row (the layout is fixed): header with the
    time it was saved, what triggered it and the folder, then the blocks that
    have something to say."""
    trigger, cwd = trigger if trigger is not None else F.lit("unknown"), cwd if cwd is not None else F.lit("")

    def block(title: str, column: str, mark: str) -> Column:
        lines = F.transform(column, lambda x: F.concat(F.lit(mark), x))
        return F.when(F.size(F.coalesce(column, F.array())) > 0,
                      F.concat(F.lit(f"== {title} ==\n"), F.array_join(lines, "\n"), F.lit("\n")))

    answer = F.when(F.col("last_assistant").isNull(), F.lit("(none recorded)")).otherwise(
        F.concat(F.lit("["), F.coalesce("last_assistant_ts", F.lit("")), F.lit("]\n"), F.col("last_assistant")))
    parts = [F.lit("=== COMPACTION CHECKPOINT ==="), F.concat(F.lit("Session: "), F.col("session_id")),
             F.lit(f"Saved:   {saved_at}"), F.concat(F.lit("Trigger: "), F.coalesce(trigger, F.lit("unknown"))),
             F.concat(F.lit("CWD:     "), F.coalesce(cwd, F.lit(""))), F.lit(""),
             F.lit(f"== RECENT USER MESSAGES (last {LAST_USER_MSGS}) =="), F.col("recent_user"), F.lit(""),
             F.lit("== LAST ASSISTANT RESPONSE =="), answer, F.lit("")]
    if "files" in digest.columns:
        parts.append(block("FILES TOUCHED THIS SESSION", "files", "  "))
    if "ops" in digest.columns:
        parts.append(block("RECENT OPERATIONS", "ops", "  - "))
    parts.append(F.lit("=== END CHECKPOINT ==="))
    return digest.select("session_id", F.concat_ws("\n", *parts).alias("checkpoint"))


def close_triggers(messages: DataFrame) -> DataFrame:
    """First close-trigger phrase (list order) contained in the
    lower-cased last non-empty user message of each session (NULL if none)."""
    m = messages.filter((F.col("role") == "user") & F.col("text").isNotNull() & (full_trim(F.col("text")) != ""))
    last = m.groupBy("session_id").agg(F.max_by("text", "pos").alias("last_user"))
    lower = F.lower(F.col("last_user"))
    hits = F.filter(F.array(*[F.lit(t) for t in CLOSE_TRIGGERS]), lambda t: F.instr(lower, t) > 0)
    return last.select("session_id", "last_user", F.try_element_at(hits, F.lit(1)).alias("trigger"))


def resume_context(starts: DataFrame, checkpoints: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """What to inject at session start.

    compact → latest checkpoint of the session at or before the start if it is
    younger than 180 minutes (first 4000 chars), else the project state
    (3000 chars); resume → project state; startup / clear → nothing.
    starts(event_id, session_id, ts, source); checkpoints(event_id,
    session_id, saved_at, body); state(session_id, body).
    """
    ck = checkpoints.select(F.col("event_id").alias("ck_id"), "session_id", F.col("saved_at").alias("ts"),
                            F.col("body").alias("ck_body"))
    m = asof_join(starts, ck, "session_id", "ts", "event_id", "ck_id", "backward")
    m = m.join(ck.select("ck_id", F.col("ts").alias("saved_at"), "ck_body"), "ck_id", "left")
    if state is not None:
        m = m.join(state.select("session_id", F.col("body").alias("st_body")), "session_id", "left")
    else:
        m = m.withColumn("st_body", F.lit(None).cast("string"))
    # difference of the zone-less timestamps themselves (no session-time-zone cast)
    age_min = F.timestamp_diff("MICROSECOND", F.col("saved_at"), F.col("ts")) / 6e7
    fresh = F.col("saved_at").isNotNull() & (age_min < CHECKPOINT_MAX_AGE_MIN)
    has_state = F.col("st_body").isNotNull() & (F.col("st_body") != "")
    kind = (F.when((F.col("source") == "compact") & fresh, F.lit("checkpoint"))
            .when(F.col("source").isin("compact", "resume") & has_state, F.lit("state"))
            .otherwise(F.lit("none")))
    body = (F.when(kind == "checkpoint", F.substring("ck_body", 1, CHECKPOINT_MAX_CHARS))
            .when(kind == "state", F.substring("st_body", 1, STATE_MAX_CHARS)))
    return m.select("event_id", "session_id", "ts", "source", kind.alias("inject"), body.alias("body"))
