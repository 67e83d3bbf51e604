"""Session JSONL ingest.

Layout: ``<root>/<project>/<session>.jsonl`` (one node) or
``<store>/<node>/<project>/<session>.jsonl`` (per-node layout, node from the
path).  One text scan reads every file; the line order is captured in the scan
projection as (file_path, file_block_start, monotonically_increasing_id), so it
survives files split over several read partitions.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlake.functions.content import flatten_content, is_object, vget
from threadlake.functions.indexing import number_in_files
from threadlake.functions.text import full_trim
from threadlake.operators.sessions import one_row_join
from threadlake.session import settings, ship_package, stored
from threadlake.sources import store
from threadlake.sources.export import shared_folder

KEEP_TYPES = ("user", "assistant", "ai-title")
DEFAULT_NODE, DEFAULT_SOURCE = "local", "code"


def _path_columns(path: Column, per_node_dirs: bool, node: str | None) -> list[Column]:
    """session_id, project and node of a file, from its (encoded) path."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    parts = F.split(plain, "/")
    n = F.size(parts)
    node_col = F.element_at(parts, n - 2) if per_node_dirs else F.lit(node or DEFAULT_NODE)
    return [F.regexp_extract(plain, r"([^/]+)\.jsonl$", 1).alias("session_id"),
            F.element_at(parts, n - 1).alias("project"), node_col.alias("node")]


#: Time of a listed file without a byte; one that grows gets a real one.
NO_TIME = "1970-01-01 00:00:00"


def list_files(spark: SparkSession, root: str, per_node_dirs: bool = False, node: str | None = None) -> DataFrame:
    """S1 / S7 / S10 without reading: one row per ``*.jsonl`` file under
    ``root``, listed once; no file is opened.  A shared folder (``file:``) is listed
    by tasks, folder by folder, and the driver holds no name of a file; other stores by Spark
    (``_listed_by_spark``).  A file without a byte has 0 bytes and the time
    ``NO_TIME``.  Output: file_path (as scans have it), plain_path (not
    encoded), file_mtime, bytes, session_id, project, node."""
    folder = shared_folder(spark, root) if not re.search(r"[\\*?\[\]{}]", root) else None
    df = _listed_by_spark(spark, root) if folder is None or not os.path.isdir(folder) else _listed_by_tasks(
        spark, folder, 2 if per_node_dirs else 1)
    return stored(df.select("*", *_path_columns(F.col("file_path"), per_node_dirs, node)), "files")


def _listed_by_spark(spark: SparkSession, root: str) -> DataFrame:
    """The content column of the binary source is never asked for, so no
    file is opened.  Its scan leaves out files without a byte; they are in the
    listing that Spark makes for it on the driver, and are added from there; the
    names come to Python only when there are such files."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl")
          .load(root).select(F.col("_metadata.file_path").alias("file_path"), F.col("path").alias("plain_path"),
                             F.col("_metadata.file_modification_time").alias("file_mtime"),
                             F.col("_metadata.file_size").alias("bytes")))
    listing = df._jdf.inputFiles()  # the driver's own listing, in the JVM
    if len(listing) > df.count():
        names = spark.createDataFrame([(re.sub("^([a-z0-9]+):///", r"\1:/", n),) for n in listing], "file_path string")
        empty = names.join(df.select("file_path"), "file_path", "left_anti").select(
            "file_path", F.col("file_path").alias("plain_path"), F.lit(NO_TIME).cast("timestamp").alias("file_mtime"),
            F.lit(0).cast("long").alias("bytes"))
        df = df.unionByName(empty)
    return df


def _hidden(name: str) -> bool:
    """Names that Spark's own listing leaves out."""
    return (name.startswith(".") or name.endswith("._COPYING_")
            or name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata")))


def _as_uri(path: str) -> str:
    """``file:`` URI of a path as Java writes it: of the characters above 127 only
    spaces and controls are escaped."""
    def plain(c: str) -> bool:
        return (c.isalnum() or c in "_-!.~'()*/:@&=+$,;") if c < "\x80" else not (c.isspace() or c < "\xa0")

    return "file:" + "".join(c if plain(c) else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogateescape")) for c in path)


#: Names that a listing task gives out at a time.
NAMES = 10_000


def _list_folders(batches: Iterator) -> Iterator:
    """For ``mapInArrow`` over (folder, deep): path, time in ms and size of the
    ``*.jsonl`` files of each folder, and below it with ``deep``."""
    import pyarrow as pa

    names = ["file_path", "plain_path", "ms", "bytes"]
    rows: list[tuple] = []
    batch = lambda: pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], names)
    for b in batches:
        todo = list(zip(*(c.to_pylist() for c in b.columns)))
        while todo:
            folder, deep = todo.pop()
            with os.scandir(folder) as entries:
                for e in entries:
                    if _hidden(e.name):
                        continue
                    if e.is_dir():
                        if deep:
                            todo.append((e.path, True))
                    elif e.name.endswith(".jsonl"):
                        s, uri = e.stat(), _as_uri(e.path)
                        rows.append((uri, f"file:{e.path}" if s.st_size else uri, s.st_mtime_ns // 1_000_000, s.st_size))
                        if len(rows) == NAMES:
                            yield batch()
                            rows.clear()
    yield batch()


def _listed_by_tasks(spark: SparkSession, root: str, levels: int) -> DataFrame:
    """The driver lists the ``levels`` folders that lie above the files, tasks the
    files, each folder with what is below it."""
    ship_package(spark)
    folders = [root]
    todo: list[tuple[str, bool]] = []
    for _ in range(levels):
        todo += [(f, False) for f in folders]
        below = []
        for f in folders:
            with os.scandir(f) as entries:
                below += [e.path for e in entries if e.is_dir() and not _hidden(e.name)]
        folders = below
    todo += [(f, True) for f in folders]
    dealt = spark.createDataFrame(todo, "folder string, deep boolean").repartition(
        min(len(todo), 4 * spark.sparkContext.defaultParallelism))
    found = dealt.mapInArrow(_list_folders, "file_path string, plain_path string, ms long, bytes long")
    time = F.when(F.col("bytes") > 0, F.timestamp_millis("ms")).otherwise(F.lit(NO_TIME).cast("timestamp"))
    return found.select("file_path", "plain_path", time.alias("file_mtime"), "bytes")


#: For scans of many small files: what opening one costs in bytes read (Spark's 4 MB would
#: make a task of every few files), and a listing without what the driver need not keep.
SMALL_FILES = {"spark.sql.files.openCostInBytes": "65536", "spark.sql.sources.ignoreDataLocality": "true",
               "spark.sql.hive.manageFilesourcePartitions": "false"}


def scan_lines(spark: SparkSession, root: str | list[str], per_node_dirs: bool = False,
               node: str | None = None, only: list[str] | None = None) -> DataFrame:
    """Every line of every ``*.jsonl`` under ``root`` (a folder, or a
    list of files) with its file metadata and order; with ``only`` of the files
    of these ``file_path`` alone: Spark drops the others from its listing and
    does not open them.  Output: file_path, file_mtime, session_id, project,
    node, block, mid, raw."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").text(root)
    if only is not None:
        quoted = ",".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in only)
        df = df.filter(F.expr(f"_metadata.file_path IN ({quoted})"))
    df = (df.select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file_path"),
                  F.col("_metadata.file_modification_time").alias("file_mtime"),
                  F.col("_metadata.file_block_start").alias("block"),
                  F.monotonically_increasing_id().alias("mid")))
    return df.select("file_path", "file_mtime", *_path_columns(F.col("file_path"), per_node_dirs, node),
                     "block", "mid", "raw")


def decode(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine).

    Records: valid JSON objects whose ``type`` is user / assistant / ai-title.
    Quarantine: lines that are not blank and are not JSON objects (ledger
    8.5: such a line no longer fails the whole file).  Undecodable bytes are
    replaced before parsing.
    """
    text = full_trim(F.make_valid_utf8(F.col("raw")))
    x = lines.withColumn("line", text).filter(F.col("line") != "").withColumn("v", F.try_parse_json("line"))
    ok = F.coalesce(is_object(F.col("v")), F.lit(False))
    bad = x.filter(~ok).select("file_path", "session_id", "block", "mid", "line",
                               F.when(F.col("v").isNull(), F.lit("malformed json")).otherwise(F.lit("not an object"))
                               .alias("reason"))
    good = x.filter(ok).withColumn("kind", vget(F.col("v"), "$.type")).filter(F.col("kind").isin(*KEEP_TYPES))
    return good.drop("raw", "line"), bad


def narrow(records: DataFrame) -> DataFrame:
    """One row per kept line with the fields every later step needs: kind,
    timestamp, cwd, ai-title and the flattened text (P1) of user/assistant
    lines.  This is the table worth materialising: it is read by both the
    turns and the session headers."""
    v = F.col("v")
    is_msg = F.col("kind").isin("user", "assistant")
    return records.select(
        "session_id", "project", "node", "file_path", "file_mtime", "block", "mid", "kind",
        vget(v, "$.timestamp").alias("ts"), vget(v, "$.cwd").alias("cwd"),
        F.when(F.col("kind") == "ai-title", vget(v, "$.aiTitle")).alias("title"),
        F.when(is_msg, flatten_content(vget(v, "$.message.content", "variant"))).alias("text"))


def parse_once(lines: DataFrame, records: bool = False) -> DataFrame:
    """``narrow`` rows and set-aside lines (``bad``, ``reason``) in one table, so
    that both come from a single pass over the files; with ``records`` also the
    parsed line (``v``)."""
    text = full_trim(F.make_valid_utf8(F.col("raw")))
    x = lines.withColumn("line", text).filter(F.col("line") != "").withColumn("v", F.try_parse_json("line"))
    v, ok = F.col("v"), F.coalesce(is_object(F.col("v")), F.lit(False))
    x = x.withColumns({"ok": ok, "kind": F.when(ok, vget(v, "$.type"))}).filter(~F.col("ok") | F.col("kind").isin(*KEEP_TYPES))
    is_msg = F.col("kind").isin("user", "assistant")
    return x.select(
        "session_id", "project", "node", "file_path", "file_mtime", "block", "mid", "kind",
        F.when(F.col("ok"), vget(v, "$.timestamp")).alias("ts"), F.when(F.col("ok"), vget(v, "$.cwd")).alias("cwd"),
        F.when(F.col("kind") == "ai-title", vget(v, "$.aiTitle")).alias("title"),
        F.when(is_msg, flatten_content(vget(v, "$.message.content", "variant"))).alias("text"),
        F.when(~F.col("ok"), F.col("line")).alias("bad"),
        F.when(v.isNull(), F.lit("malformed json")).when(~F.col("ok"), F.lit("not an object")).alias("reason"),
        *([F.when(F.col("ok"), v).alias("v")] if records else []))


def _is_turn() -> F.Column:
    return F.col("kind").isin("user", "assistant") & F.col("text").isNotNull() & (F.col("text") != "")


def to_turns(lines: DataFrame) -> DataFrame:
    """P1 + P5: non-empty user/assistant texts numbered 0.. in file order.
    Input: ``narrow`` rows.  Output: session_id, file_path, turn_idx, ts, role, text."""
    t = lines.filter(_is_turn()).select("session_id", "file_path", "block", "mid", "ts",
                                        F.col("kind").alias("role"), "text")
    n = number_in_files(t, "file_path", "block", "mid", "turn_idx")
    return n.select("session_id", "file_path", "turn_idx", "ts", "role", "text")


def headers(lines: DataFrame, indexed_at: str) -> DataFrame:
    """One session row per file that has at least one turn.

    started/ended = min/max timestamp of user/assistant lines (also those whose
    text is empty), cwd = first non-empty cwd, ai_title = last ai-title line's
    value (even NULL), turn_count = number of turns.  One aggregation over the
    ``narrow`` rows; it does not need the numbered turns.
    """
    order = F.struct("block", "mid")
    is_msg = F.col("kind").isin("user", "assistant")
    cwd = F.when(is_msg, F.col("cwd"))
    ts = F.when(is_msg & (F.col("ts") != ""), F.col("ts"))  # an empty one is none
    h = lines.groupBy("file_path").agg(
        F.first("session_id").alias("session_id"), F.first("project").alias("project"),
        F.first("node").alias("node"), F.first("file_mtime").alias("file_mtime"),
        F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"),
        F.min_by(cwd, F.when(cwd.isNotNull() & (cwd != ""), order)).alias("cwd"),
        F.max_by(F.struct(F.col("title").alias("t")), F.when(F.col("kind") == "ai-title", order)).alias("_t"),
        F.count_if(_is_turn()).cast("int").alias("turn_count"))
    return (h.filter(F.col("turn_count") > 0)
            .select("session_id", "project", F.col("_t.t").alias("ai_title"), "cwd", "started_at", "ended_at",
                    "turn_count", "file_path", "file_mtime", F.lit(indexed_at).alias("indexed_at"),
                    F.lit(DEFAULT_SOURCE).alias("source"), "node"))


def latest_file_per_session(sessions: DataFrame) -> DataFrame:
    """The same stem in two projects: keep the newest file (then the
    greatest path).  A partial-aggregated ``max`` picks it."""
    best = sessions.groupBy("session_id").agg(F.max(F.struct("file_mtime", "file_path")).alias("_b"))
    return sessions.join(best.select("session_id", F.col("_b.file_path").alias("file_path")),
                         ["session_id", "file_path"])


def ingest(spark: SparkSession, root: str, indexed_at: str, per_node_dirs: bool = False,
           node: str | None = None, materialize: bool = False, with_records: bool = False) -> dict[str, DataFrame]:
    """Full scan → {lines, records, quarantine, turns, sessions}.

    With ``materialize`` the decoded per-line table is written once (Parquet under
    spark.checkpoint.dir), so the files are read and parsed a single time although
    turns, sessions and quarantine all consume them; ``with_records`` keeps the
    parsed lines in it for those who read ``records``."""
    lines = scan_lines(spark, root, per_node_dirs, node)
    records, bad = decode(lines)
    if materialize:
        with settings(spark, SMALL_FILES):
            parsed = stored(parse_once(scan_lines(spark, root, per_node_dirs, node), with_records), "parsed")
        good = parsed.filter(F.col("bad").isNull()).drop("bad", "reason")
        nl, bad = good.drop("v"), _set_aside(parsed)
        if with_records:
            records = good.select(records.columns)
    else:
        nl = narrow(records)
    sessions = latest_file_per_session(headers(nl, indexed_at))
    turns = to_turns(nl.join(sessions.select("file_path"), "file_path", "left_semi")).drop("file_path")
    # of two files of one name only the counted one speaks for the session
    records = records.join(sessions.select("file_path"), "file_path", "left_semi")
    return {"lines": lines, "records": records, "narrow": nl, "quarantine": bad, "turns": turns,
            "sessions": sessions}


def _set_aside(parsed: DataFrame) -> DataFrame:
    """Quarantine of ``parse_once`` rows, as ``decode`` has it."""
    return parsed.filter(F.col("bad").isNotNull()).select("file_path", "session_id", "block", "mid",
                                                          F.col("bad").alias("line"), "reason")


#: Sort order of the stored tables inside a bucket.
ORDER = {"sessions": ["session_id"], "turns": ["session_id", "turn_idx"], "files": ["file_path"]}
#: Changed files that are read by name, and those that are picked from the listing
#: of the folder; of more, the folder is scanned and the lines of the others are dropped.
BY_NAME, PICKED = 32, 100_000


def read_changed(spark: SparkSession, root: str, changed: DataFrame, per_node_dirs: bool = False,
                 node: str | None = None, by_name: int = PICKED, every: bool = False) -> DataFrame:
    """Lines of the ``changed`` files (``list_files`` rows): no other file is
    opened while they are ``by_name`` at most; none at all without any.  With
    ``every`` they are all files of the folder."""
    some = changed.filter("bytes > 0").select("plain_path", "file_path").limit(1 if every else by_name + 1).collect()
    if every and some or len(some) > by_name:
        lines = scan_lines(spark, root, per_node_dirs, node)
        return lines.join(changed.select("file_path"), "file_path", "left_semi")
    if len(some) > BY_NAME:  # a listing for each name would cost more than the folder's
        return scan_lines(spark, root, per_node_dirs, node, [r[1] for r in some])
    if some:
        names = [re.sub(r"([\\*?\[\]{}])", r"\\\1", r[0]) for r in some]  # names, not patterns
        return scan_lines(spark, names, per_node_dirs, node)
    return spark.createDataFrame([], "file_path string, file_mtime timestamp, session_id string, project string, "
                                     "node string, block long, mid long, raw string")


def ingest_changes(spark: SparkSession, root: str, base: str, indexed_at: str, per_node_dirs: bool = False,
                   node: str | None = None) -> dict[str, DataFrame]:
    """Bring the store under ``base`` up to date with ``root``.

    Files are listed, those that the store knows with the same time are left
    unopened (S3), the others are read once; their sessions replace the stored
    ones, bucket by bucket.  A stored session whose file has no turn any more
    goes; of two files of one name the newest (then the greatest path) counts.
    Returns files (the listing), changed, quarantine, sessions and turns (as
    stored now) and summary (S9)."""
    files = list_files(spark, root, per_node_dirs, node)
    known, had = store.read(spark, base, "files"), store.read(spark, base, "sessions")
    changed = files if known is None else files.join(known, ["file_path", "file_mtime"], "left_anti")
    changed = stored(changed.select(files.columns), "changed")
    with settings(spark, SMALL_FILES):
        parsed = stored(parse_once(read_changed(spark, root, changed, per_node_dirs, node, every=known is None)), "parsed")
    nl, bad = parsed.filter(F.col("bad").isNull()).drop("bad", "reason"), _set_aside(parsed)
    new = latest_file_per_session(headers(nl, indexed_at))
    before = had if had is not None else spark.createDataFrame([], new.schema)
    gone = before.join(changed.select("file_path"), "file_path", "left_semi").select("session_id")
    if had is not None:
        rival = before.join(changed.select("file_path"), "file_path", "left_anti").select(
            "session_id", F.struct("file_mtime", "file_path").alias("_r"))
        new = new.join(rival, "session_id", "left").filter(
            F.col("_r").isNull() | (F.struct("file_mtime", "file_path") > F.col("_r"))).drop("_r")
    new = stored(new.withColumn("bucket", store.session_bucket(F.col("started_at"), F.col("session_id"))), "sessions")
    text = nl.join(new.select("file_path"), "file_path", "left_semi")
    turns = to_turns(text).drop("file_path").join(new.select("session_id", "bucket"), "session_id")
    old = before.select("session_id", "file_mtime")  # of the set before: it stays readable for a while
    store.upsert(spark, base, "session_id", {"sessions": new, "turns": turns}, gone, ORDER)
    _note_files(spark, base, changed)
    sessions, all_turns = store.read(spark, base, "sessions"), store.read(spark, base, "turns")
    return {"files": files, "changed": changed, "quarantine": bad, "sessions": sessions, "turns": all_turns,
            "summary": run_summary(files, old, new, bad, sessions, all_turns)}


def _note_files(spark: SparkSession, base: str, changed: DataFrame) -> None:
    """Remember the listed files, those without a session too, by hash of the
    path: the buckets of changed files are written."""
    bucket = F.pmod(F.xxhash64("file_path"), F.lit(FILE_BUCKETS)).cast("string")
    rows = changed.select("file_path", "file_mtime", bucket.alias("bucket"))
    store.upsert(spark, base, "file_path", {"files": rows}, rows.limit(0), ORDER)


#: Buckets of the table of known files.
FILE_BUCKETS = 64


# --- incremental maintenance ----------------------------------------------------------------

def changed_files(manifest: DataFrame, stored_sessions: DataFrame) -> DataFrame:
    """S3: files of a listing whose (session, mtime) differs from the stored
    session row."""
    old = stored_sessions.select("session_id", "file_mtime")
    return manifest.join(old, ["session_id", "file_mtime"], "left_anti")


def upsert(old: DataFrame, new: DataFrame, changed_ids: DataFrame, key: str = "session_id") -> DataFrame:
    """Replace-by-key — drop every old row of a changed key, add the new
    rows (schemas aligned by name; missing columns NULL — apply
    ``with_defaults`` to session tables for S8)."""
    kept = old.join(changed_ids.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def with_defaults(sessions: DataFrame) -> DataFrame:
    """Old data without ``source`` / ``node`` get 'code' / 'local'."""
    cols = sessions.columns
    out = sessions
    out = out.withColumn("source", F.coalesce(F.col("source"), F.lit(DEFAULT_SOURCE)) if "source" in cols
                         else F.lit(DEFAULT_SOURCE))
    out = out.withColumn("node", F.coalesce(F.col("node"), F.lit(DEFAULT_NODE)) if "node" in cols
                         else F.lit(DEFAULT_NODE))
    return out


def run_summary(manifest: DataFrame, stored_sessions: DataFrame, new_sessions: DataFrame,
                quarantine: DataFrame, total_sessions: DataFrame, total_turns: DataFrame) -> DataFrame:
    """One row — new/updated, unchanged, files with errors, totals and
    the first 10 erroring files (by path)."""
    m = manifest.join(stored_sessions.select("session_id", F.col("file_mtime").alias("_old")), "session_id", "left")
    produced = new_sessions.select("file_path").withColumn("_produced", F.lit(True))
    m = m.join(produced, "file_path", "left")
    new = F.col("_produced").isNotNull() & (F.col("_old").isNull() | (F.col("_old") != F.col("file_mtime")))
    counts = m.agg(F.count_if(new).alias("new_or_updated"), F.count_if(~new).alias("unchanged"))
    errs = quarantine.select("file_path").distinct()
    first10 = errs.orderBy("file_path").limit(10).agg(   # top-10 first: never collect every path
        F.array_sort(F.collect_list("file_path")).alias("first_errors"))
    err_row = one_row_join([errs.agg(F.count(F.lit(1)).alias("errors")), first10])
    tot = total_sessions.agg(F.count(F.lit(1)).alias("sessions"))
    tt = total_turns.agg(F.count(F.lit(1)).alias("turns"))
    return one_row_join([counts, err_row, tot, tt])


def node_coverage(files: DataFrame, roster: DataFrame) -> DataFrame:
    """Listed files (empty ones too) per expected node (0 = no
    transcripts, not a failure) plus nodes seen but not on the roster.
    roster(node).  When no node has a file at all, every row says so."""
    per = files.groupBy("node").agg(F.count(F.lit(1)).alias("files"))
    out = roster.select("node").join(per, "node", "full")
    seen = per.agg(F.count(F.lit(1)).alias("_nodes"))  # one row
    out = out.join(F.broadcast(seen), F.lit(True))
    return out.select("node", F.coalesce("files", F.lit(0)).alias("files"),
                      F.when(F.col("_nodes") == 0, F.lit("warning: no node has transcripts"))
                      .when(F.col("files").isNull(), F.lit("no transcripts"))
                      .otherwise(F.lit("ok")).alias("status"))


def digest_inputs(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages and tool uses for digests (P2, F10, D2/D3 inputs).

    messages(session_id, pos, ts, role, text): user messages whose content has
    no tool_result block (text blocks joined by a space), and assistant
    messages with block content (text blocks joined by a newline; plain
    string assistant content is skipped, ledger 8.25).
    tool_uses(session_id, pos, name, file_path, description, command).
    """
    from threadlake.functions.content import flatten_prose, has_tool_result, is_array, tool_uses

    pos = F.struct("block", "mid")
    content = vget(F.col("v"), "$.message.content", "variant")
    ts = F.substring(F.coalesce(vget(F.col("v"), "$.timestamp"), F.lit("")), 1, 16)
    user = (records.filter((F.col("kind") == "user") & ~F.coalesce(has_tool_result(content), F.lit(False)))
            .select("session_id", pos.alias("pos"), ts.alias("ts"), F.lit("user").alias("role"),
                    flatten_prose(content, " ").alias("text")))
    asst_rows = records.filter((F.col("kind") == "assistant") & is_array(content))
    asst = asst_rows.select("session_id", pos.alias("pos"), ts.alias("ts"), F.lit("assistant").alias("role"),
                            flatten_prose(content, "\n").alias("text"))
    msgs = user.unionByName(asst).filter(F.col("text") != "")
    tools = (asst_rows.select("session_id", pos.alias("pos"), F.posexplode(tool_uses(content)).alias("k", "tu"))
             .select("session_id", F.struct(F.col("pos.block"), F.col("pos.mid"), F.col("k")).alias("pos"),
                     "tu.name", "tu.file_path", "tu.description", "tu.command"))
    return msgs, tools
