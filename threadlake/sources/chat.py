"""Chat-export ingest.

The export is one JSON array of conversations per file; ``multiLine`` JSON
reading turns each array element into a row, so a conversation (with all its
messages) is one row and its messages are numbered inside the row with
higher-order functions — no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.functions.text import full_trim

CHAT_PROJECT = "chat.export"   # project name given to chat sessions (parameter)
NO_NAME = "(no name)"

_NAMED = T.ArrayType(T.StructType([T.StructField("file_name", T.StringType()),
                                   T.StructField("name", T.StringType())]))
EXPORT_SCHEMA = T.StructType([
    T.StructField("uuid", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("summary", T.StringType()), T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("chat_messages", T.ArrayType(T.StructType([
        T.StructField("sender", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("attachments", _NAMED), T.StructField("files", _NAMED)])))])


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """One row per conversation."""
    return spark.read.schema(EXPORT_SCHEMA).option("multiLine", True).json(path)


def updated_epoch(col) -> F.Column:
    """S4 key: epoch seconds of ``updated_at`` (0.0 when unparsable)."""
    ts = F.try_to_timestamp(col)
    return F.coalesce(F.unix_micros(ts) / 1e6, F.lit(0.0))


def _names(arr, label: str):
    named = F.transform(F.coalesce(arr, F.array().cast(_NAMED)),
                        lambda a: F.coalesce(F.nullif(a["file_name"], F.lit("")), a["name"], F.lit("")))
    return F.array_join(F.transform(F.filter(named, lambda n: n != ""),
                                    lambda n: F.concat(F.lit(f"\n[{label}: "), n, F.lit("]"))), "")


def conversation_turns(convs: DataFrame) -> DataFrame:
    """P3 + P5 + P4: (session_id, turn_idx, ts, role, text); the summary is
    turn −1 with role ``summary`` when the conversation has turns."""
    msgs = F.transform(F.coalesce("chat_messages", F.array().cast(EXPORT_SCHEMA["chat_messages"].dataType)),
                       lambda m: F.struct(
                           F.when(F.coalesce(m["sender"], F.lit("human")) == "human", F.lit("user"))
                           .otherwise(F.lit("assistant")).alias("role"),
                           F.concat(F.coalesce(m["text"], F.lit("")), _names(m["attachments"], "attachment"),
                                    _names(m["files"], "file")).alias("text"),
                           F.coalesce(m["created_at"], F.lit("")).alias("ts")))
    kept = F.filter(msgs, lambda m: full_trim(m["text"]) != "")
    c = convs.select(F.col("uuid").alias("session_id"), kept.alias("_m"), "summary", "created_at")
    turns = c.select("session_id", F.posexplode("_m").alias("turn_idx", "_x")).select(
        "session_id", F.col("turn_idx").cast("int"), F.col("_x.ts").alias("ts"), F.col("_x.role").alias("role"),
        F.col("_x.text").alias("text"))
    summ = c.filter((F.size("_m") > 0) & F.col("summary").isNotNull() & (F.col("summary") != "")).select(
        "session_id", F.lit(-1).alias("turn_idx"), F.coalesce("created_at", F.lit("")).alias("ts"),
        F.lit("summary").alias("role"), F.col("summary").alias("text"))
    return turns.unionByName(summ)


def conversation_sessions(convs: DataFrame, indexed_at: str, project: str = CHAT_PROJECT) -> DataFrame:
    """Session rows of conversations that have at least one kept message."""
    t = conversation_turns(convs).filter(F.col("turn_idx") >= 0).groupBy("session_id").agg(
        F.count(F.lit(1)).cast("int").alias("turn_count"))
    return (convs.withColumnRenamed("uuid", "session_id").join(t, "session_id")
            .select("session_id", F.lit(project).alias("project"),
                    F.coalesce(F.nullif(F.col("name"), F.lit("")), F.lit(NO_NAME)).alias("ai_title"),
                    F.lit(None).cast("string").alias("cwd"), F.col("created_at").alias("started_at"),
                    F.col("updated_at").alias("ended_at"), "turn_count",
                    F.lit(None).cast("string").alias("file_path"),
                    updated_epoch(F.col("updated_at")).alias("file_mtime"),
                    F.lit(indexed_at).alias("indexed_at"), F.lit("chat").alias("source"),
                    F.lit(None).cast("string").alias("node")))


def changed_conversations(convs: DataFrame, stored_sessions: DataFrame) -> DataFrame:
    """Conversations whose updated-at epoch differs from the stored one."""
    k = convs.select(F.col("uuid").alias("session_id"), updated_epoch(F.col("updated_at")).alias("file_mtime"))
    return k.join(stored_sessions.select("session_id", "file_mtime"), ["session_id", "file_mtime"], "left_anti")
