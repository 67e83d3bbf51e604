"""Model tables derived from the driver's parquet tables.

The reference works on ``sessions`` / ``turns`` / ``turn_vecs`` / ``edges``
tables built from transcript files.  The test harness ships generic tables
instead; this module derives the model tables from them with Spark, by the
rules below, so that every registered query reads the given tables and its
work grows with them.

Fixed mapping rules (the SQL oracle uses the same ones):

* turns     <- conversations: session_id = conv_id as text, turn_idx = turn,
               ts = started_at + turn minutes
* sessions  <- conversations grouped by conv_id: started_at = 2024-01-01 +
               conv_id hours, ended_at = last turn ts, turn_count = count,
               project = 'p' || conv_id % 7, node = 'n' || conv_id % 3 (NULL when
               conv_id % 11 = 0), source = 'chat' when conv_id % 5 = 0 else 'code',
               ai_title = NULL when conv_id % 4 = 0 else 'title ' || conv_id,
               cwd = '/home/dev/' || project
* vecs      <- embeddings joined to turns: vec_id = 0-based position of the turn
               in (conv_id, turn) order
* usage     <- events: session_id = user_id, tokens = value, model = event_type
* stops     <- events with event_type = 'purchase'
* starts    <- events with event_type = 'signup'; source by event_id % 4
               (compact, resume, startup, clear)
* checkpoints <- events with event_type = 'view' (saved_at = ts, body = props)
* project state <- latest 'click' event per user (body = props)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlake.functions.indexing import with_global_index

# Fixed values of the mapping (see module docstring).
EPOCH = "2024-01-01 00:00:00"
AS_OF = "2024-12-31T00:00:00Z"
ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def iso(col) -> F.Column:
    return F.date_format(col, ISO_FMT)


def _started_ts(conv_id: F.Column) -> F.Column:
    return F.timestamp_add("HOUR", conv_id, F.lit(EPOCH).cast("timestamp_ntz"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """turns(session_id, turn_idx, ts, role, text, ts_ntz)."""
    c = table(spark, sf_dir, "conversations")
    ts = F.timestamp_add("MINUTE", F.col("turn"), _started_ts(F.col("conv_id")))
    return c.select(
        F.col("conv_id").cast("string").alias("session_id"),
        F.col("turn").cast("int").alias("turn_idx"),
        iso(ts).alias("ts"),
        F.col("role"),
        F.col("text"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sessions(session_id, project, ai_title, cwd, started_at, ended_at,
    turn_count, source, node)."""
    c = table(spark, sf_dir, "conversations")
    g = c.groupBy("conv_id").agg(F.count(F.lit(1)).cast("int").alias("turn_count"),
                                 F.max("turn").alias("_last"))
    cid = F.col("conv_id")
    start = _started_ts(cid)
    project = F.concat(F.lit("p"), (cid % 7).cast("string"))
    return g.select(
        cid.cast("string").alias("session_id"),
        project.alias("project"),
        F.when(cid % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("title "), cid.cast("string"))).alias("ai_title"),
        F.concat(F.lit("/home/dev/"), project).alias("cwd"),
        iso(start).alias("started_at"),
        iso(F.timestamp_add("MINUTE", F.col("_last"), start)).alias("ended_at"),
        F.col("turn_count"),
        F.when(cid % 5 == 0, F.lit("chat")).otherwise(F.lit("code")).alias("source"),
        F.when(cid % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("n"), (cid % 3).cast("string"))).alias("node"),
    )


def vecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vecs(session_id, turn_idx, embedding ARRAY<FLOAT>)."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    t = with_global_index(t, ["conv_id", "turn"], "vec_pos")
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return (t.join(e, t.vec_pos == e.vec_id)
            .select(F.col("conv_id").cast("string").alias("session_id"),
                    F.col("turn").cast("int").alias("turn_idx"),
                    "embedding"))


def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """usage(event_id, session_id, ts, type, model, input_tokens,
    cache_read_input_tokens, cache_creation_input_tokens, is_stop)."""
    return usage_from_events(table(spark, sf_dir, "events"))


def usage_from_events(e: DataFrame) -> DataFrame:
    """Row mapping for batch or streaming ``events``."""
    return e.select(
        "event_id",
        F.col("user_id").cast("string").alias("session_id"),
        F.col("ts"),
        F.lit("message_start").alias("type"),
        F.col("event_type").alias("model"),
        F.col("value").alias("input_tokens"),
        F.lit(0.0).alias("cache_read_input_tokens"),
        F.lit(None).cast("double").alias("cache_creation_input_tokens"),
        (F.col("event_type") == "purchase").alias("is_stop"),
    )


def stop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select("event_id", F.col("user_id").cast("string").alias("session_id"), "ts")


START_SOURCES = ("compact", "resume", "startup", "clear")


def start_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    src = F.element_at(F.array(*[F.lit(s) for s in START_SOURCES]),
                       (F.col("event_id") % 4 + 1).cast("int"))
    return e.select("event_id", F.col("user_id").cast("string").alias("session_id"),
                    "ts", src.alias("source"))


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return e.select(F.col("user_id").cast("string").alias("session_id"),
                    F.col("ts").alias("saved_at"), F.col("props").alias("body"),
                    "event_id")


def project_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    return (e.groupBy(F.col("user_id").cast("string").alias("session_id"))
            .agg(F.max_by("props", F.struct("ts", "event_id")).alias("body")))


def markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A previous extraction run's state: sessions on node n1 were read up to
    turn 1."""
    s = sessions(spark, sf_dir)
    return s.filter(F.col("node") == "n1").select("session_id", F.lit(1).alias("last_turn_idx"))


def legacy_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy whole-session skip list: chat sessions."""
    s = sessions(spark, sf_dir)
    return s.filter(F.col("source") == "chat").select("session_id")
