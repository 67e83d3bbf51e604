"""Write transcript files from the model tables (test and bench fixtures).

Spark builds every JSON line (``to_json``).  On a shared folder (``file:``) the tasks
write the files under their own names, and the driver learns their number only;
in other stores Spark's text writer does, and the driver renames what it made.

Line shapes (fixed rules):

* first line per session: ``{"type": "ai-title", "aiTitle": <ai_title>}``
* user turn:      ``{"type": "user", "timestamp", "cwd", "message": {"content": <text>}}``
* assistant turn: content blocks ``[text, (Edit tool_use when turn % 3 = 1), Bash tool_use]``
* system turn:    ``{"type": "system", …}`` (a type the reader ignores)
* sessions with conv id % 9 = 0 end with one malformed line
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlake.session import ship_package


def session_lines(turns: DataFrame, sessions: DataFrame, tool_results: bool = False) -> DataFrame:
    """(session_id, node, project, pos, line) for the JSONL export.  With
    ``tool_results`` a user line that is the result of a tool follows every
    assistant turn with turn % 4 = 1."""
    s = sessions.select("session_id", F.coalesce("node", F.lit("local")).alias("node"), "project", "cwd", "ai_title")
    t = turns.join(s, "session_id")
    idx = F.col("turn_idx")
    bash = F.struct(F.lit("tool_use").alias("type"), F.lit("Bash").alias("name"),
                    F.struct(F.concat(F.lit("step "), idx.cast("string")).alias("description"),
                             F.concat(F.lit("echo "), idx.cast("string")).alias("command")).alias("input"))
    edit = F.struct(F.lit("tool_use").alias("type"), F.lit("Edit").alias("name"),
                    F.struct(F.lit(None).cast("string").alias("description"),
                             F.concat(F.lit("/src/"), F.col("project"), F.lit("/f"), (idx % 4).cast("string"),
                                      F.lit(".py")).alias("command")).alias("input"))
    text_block = F.struct(F.lit("text").alias("type"), F.lit(None).cast("string").alias("name"),
                          F.struct(F.lit(None).cast("string").alias("description"),
                                   F.lit(None).cast("string").alias("command")).alias("input"),
                          F.col("text").alias("text"))
    bash = bash.withField("text", F.lit(None).cast("string"))
    edit = edit.withField("text", F.lit(None).cast("string"))
    blocks = F.when(idx % 3 == 1, F.array(text_block, edit, bash)).otherwise(F.array(text_block, bash))
    # Edit blocks carry their path as input.file_path
    blocks = F.transform(blocks, lambda b: F.struct(
        b["type"].alias("type"), b["name"].alias("name"), b["text"].alias("text"),
        F.struct(b["input"]["description"].alias("description"),
                 F.when(b["name"] == "Edit", b["input"]["command"]).alias("file_path"),
                 F.when(b["name"] == "Bash", b["input"]["command"]).alias("command")).alias("input")))
    user = F.to_json(F.struct(F.lit("user").alias("type"), F.col("ts").alias("timestamp"), F.col("cwd"),
                              F.struct(F.col("text").alias("content")).alias("message")))
    asst = F.to_json(F.struct(F.lit("assistant").alias("type"), F.col("ts").alias("timestamp"),
                              F.struct(blocks.alias("content")).alias("message")))
    other = F.to_json(F.struct(F.lit("system").alias("type"), F.col("ts").alias("timestamp"),
                               F.struct(F.col("text").alias("content")).alias("message")))
    line = (F.when(F.col("role") == "user", user).when(F.col("role") == "assistant", asst).otherwise(other))
    body = t.select("session_id", "node", "project", (2 * idx).alias("pos"), line.alias("line"))
    if tool_results:
        said = F.to_json(F.struct(F.lit("user").alias("type"), F.col("ts").alias("timestamp"), F.struct(F.array(F.struct(
            F.lit("tool_result").alias("type"), F.col("text").alias("content"))).alias("content")).alias("message")))
        body = body.unionByName(t.filter((F.col("role") == "assistant") & (idx % 4 == 1)).select(
            "session_id", "node", "project", (2 * idx + 1).alias("pos"), said.alias("line")))
    title = s.select("session_id", "node", "project", F.lit(-1).alias("pos"),
                     F.to_json(F.struct(F.lit("ai-title").alias("type"), F.col("ai_title").alias("aiTitle")),
                               {"ignoreNullFields": "false"}).alias("line"))
    broken = (s.filter(F.col("session_id").cast("long") % 9 == 0)
              .select("session_id", "node", "project", F.lit(1 << 30).alias("pos"), F.lit("{broken").alias("line")))
    return title.unionByName(body).unionByName(broken)


#: Names changed or files made at a time.
AT_ONCE = 16
#: Tasks put their files in place themselves; nobody reads the folder before the job is done.
BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def _named_files(df: DataFrame, key: list[str], root: str, name) -> None:
    """Write ``value`` with Spark's text writer, one file per ``key``, and give
    each file its name (an older file of that name is replaced).  The names are
    changed side by side; a folder is made, and an older file looked for, only
    where there may be one."""
    spark = df.sparkSession
    made = f"{root.rstrip('/')}-made-{uuid.uuid4().hex[:8]}"
    df.write.options(**BY_TASK).partitionBy(*key).text(made)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(made).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    older = fs.exists(path(root))
    files = spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(made).select("path").inputFiles()
    pattern = re.compile("/" + "".join(f"{k}=([^/]+)/" for k in key) + "part-")
    found = [(part, pattern.search(part)) for part in map(unquote, files)]
    moves = [(part, f"{root.rstrip('/')}/{name(*m.groups())}") for part, m in found if m]
    for folder in {to.rsplit("/", 1)[0] for _, to in moves}:
        fs.mkdirs(path(folder))

    def move(pair: tuple[str, str]) -> None:
        to = path(pair[1])
        if older:
            fs.delete(to, False)
        if not fs.rename(path(pair[0]), to):
            raise OSError(f"cannot rename {pair[0]} to {pair[1]}")

    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(move, moves))


#: How Spark names the folder of a key without a value, and what it escapes in one.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def _part_of_name(value: str | None) -> str:
    return ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else NO_VALUE


def shared_folder(spark: SparkSession, root: str) -> str | None:
    """The path of a folder that every task can reach as a file (``file:``), or
    None in other stores."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _put_files(root: str, suffix: str, lines: bool = True):
    """For ``mapInArrow`` over rows sorted by their key (all columns but ``value``):
    a task writes each key's file line by line, and gives it its name when it is
    whole.  A task that is run again replaces its files by the same."""
    def put(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key = part = out = None
        made, folders = 0, set()

        def close() -> None:
            if out:
                out.close()
                os.replace(part, f"{root}/{'/'.join(key)}{suffix}")

        try:
            for batch in batches:
                *keys, values = (c.to_pylist() for c in batch.columns)
                for *now, value in zip(*keys, values):
                    now = [_part_of_name(x) for x in now]
                    if now != key:
                        close()
                        out = None
                        folder = "/".join([root, *now[:-1]])
                        if folder not in folders:
                            os.makedirs(folder, exist_ok=True)
                            folders.add(folder)
                        key, part = now, f"{folder}/.{uuid.uuid4().hex}"
                        out = open(part, "wb")
                        made += 1
                    if lines:
                        out.write((value or b"") + b"\n")
            close()
            out = None
        finally:
            if out:  # half written
                out.close()
                os.unlink(part)
        yield pa.RecordBatch.from_pydict({"files": pa.array([made], pa.int64())})
    return put


def write_jsonl(lines: DataFrame, root: str) -> None:
    """One ``<root>/<node>/<project>/<session>.jsonl`` per session."""
    key = ["node", "project", "session_id"]
    rows = lines.repartition(*key).sortWithinPartitions(*key, "pos").select(*key, F.col("line").alias("value"))
    folder = shared_folder(lines.sparkSession, root)
    if folder is None:
        _named_files(rows, key, root, lambda node, project, sid: f"{node}/{project}/{sid}.jsonl")
        return
    ship_package(lines.sparkSession)
    os.makedirs(folder, exist_ok=True)  # also when there is no session
    rows = rows.withColumn("value", F.col("value").cast("binary"))
    rows.mapInArrow(_put_files(folder, ".jsonl"), "files long").agg(F.sum("files")).collect()


def touch(files: DataFrame, root: str) -> None:
    """A file without a byte, ``<root>/<node>/<project>/<session>.jsonl``, for each row."""
    spark, key = files.sparkSession, ["node", "project", "session_id"]
    folder = shared_folder(spark, root)
    if folder is not None:
        ship_package(spark)
        rows = files.select(*key, F.lit(None).cast("binary").alias("value")).repartition(*key).sortWithinPartitions(*key)
        rows.mapInArrow(_put_files(folder, ".jsonl", lines=False), "files long").agg(F.sum("files")).collect()
        return
    path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()

    def make(row) -> None:
        where = path(f"{root.rstrip('/')}/{'/'.join(map(_part_of_name, row))}.jsonl")
        where.getFileSystem(conf).create(where).close()

    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(make, files.select(*key).toLocalIterator()))


def chat_objects(turns: DataFrame, sessions: DataFrame) -> DataFrame:
    """(session_id, obj) — one chat-export conversation per chat session:
    uuid = 'c' || id, summary on sessions whose id % 10 = 0, an attachment on
    turn 0, system turns become blank assistant messages (dropped on read)."""
    s = sessions.filter(F.col("source") == "chat").select("session_id", "ai_title", "started_at", "ended_at")
    t = turns.join(s.select("session_id"), "session_id")
    msg = F.struct(
        F.col("turn_idx").alias("o"),
        F.when(F.col("role") == "user", F.lit("human")).otherwise(F.lit("assistant")).alias("sender"),
        F.when(F.col("role") == "system", F.lit("")).otherwise(F.col("text")).alias("text"),
        F.col("ts").alias("created_at"),
        F.when(F.col("turn_idx") == 0, F.array(F.struct(F.lit("notes.txt").alias("file_name"),
                                                        F.lit(None).cast("string").alias("name"))))
        .otherwise(F.array().cast("array<struct<file_name:string,name:string>>")).alias("attachments"))
    m = t.groupBy("session_id").agg(F.array_sort(F.collect_list(msg)).alias("_m"))
    conv = s.join(m, "session_id").select(
        "session_id",
        F.to_json(F.struct(
            F.concat(F.lit("c"), F.col("session_id")).alias("uuid"), F.col("ai_title").alias("name"),
            F.when(F.col("session_id").cast("long") % 10 == 0,
                   F.concat(F.lit("summary of "), F.col("session_id"))).alias("summary"),
            F.col("started_at").alias("created_at"), F.col("ended_at").alias("updated_at"),
            F.transform("_m", lambda x: x.dropFields("o")).alias("chat_messages"))).alias("obj"))
    return conv


def write_chat_export(objs: DataFrame, root: str, files: int = 4) -> None:
    """Write the conversations as ``files`` JSON-array files."""
    some = objs.groupBy(F.pmod(F.xxhash64("session_id"), F.lit(files)).alias("k")).agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list("obj"), ",\n"), F.lit("\n]")).alias("value"))
    _named_files(some, ["k"], root, lambda k: f"export-{k}.json")
