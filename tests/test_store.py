"""Listing before reading, and the bucketed copy-on-write store."""
import glob
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT
from threadlake.sources import jsonl as J
from threadlake.sources import store


def _session(root, node, project, sid, texts, day="2024-01-01"):
    os.makedirs(f"{root}/{node}/{project}", exist_ok=True)
    with open(f"{root}/{node}/{project}/{sid}.jsonl", "w", encoding="utf-8") as f:
        for i, t in enumerate(texts):
            f.write(json.dumps({"type": "user", "timestamp": f"{day}T00:00:{i:02d}Z", "message": {"content": t}}) + "\n")


def _run(spark, root, base):
    g = J.ingest_changes(spark, str(root), str(base), "now", per_node_dirs=True)
    turns = sorted((r["session_id"], r["turn_idx"], r["text"]) for r in g["turns"].collect())
    s = g["summary"].first()
    return turns, (s["new_or_updated"], s["unchanged"], s["errors"], s["sessions"]), g


def test_second_runs(spark, tmp_path):
    root, base = tmp_path / "in", tmp_path / "store"
    _session(root, "n1", "p", "a", ["one", "two"])
    _session(root, "n1", "p", "b [x] {1}", ["odd name"])
    _session(root, "n2", "p", "c", ["old"], "2023-05-05")
    (root / "n2" / "p" / "empty.jsonl").touch()
    (root / "n2" / "p" / "broken.jsonl").write_text("{nope\n")
    turns, summary, g = _run(spark, root, base)
    assert [t[0] for t in turns] == ["a", "a", "b [x] {1}", "c"] and summary == (3, 2, 1, 3)
    assert g["files"].filter("bytes = 0").select("session_id").collect()[0][0] == "empty"
    # nothing changed: no file is read
    again, summary, g = _run(spark, root, base)
    assert again == turns and summary == (0, 5, 0, 3) and g["changed"].count() == 0
    # one grows, one loses its turns, one comes, the empty one gets a line
    before = {(b.table, b.bucket): b.path for b in store.pointer(spark, str(base))[1]}
    _session(root, "n1", "p", "a", ["one", "two", "three"])
    _session(root, "n2", "p", "c", [""])
    _session(root, "n1", "q", "d", ["new"], "2024-02-02")
    _session(root, "n2", "p", "empty", ["now"], "2024-03-03")
    for name in ("n1/p/a", "n2/p/c"):
        os.utime(root / f"{name}.jsonl", (2_000_000_000, 2_000_000_000))
    turns, summary, g = _run(spark, root, base)
    assert [t[0] for t in turns] == ["a"] * 3 + ["b [x] {1}", "d", "empty"]
    assert g["changed"].count() == 4 and summary[3] == 4
    assert {r["session_id"] for r in g["sessions"].collect()} == {"a", "b [x] {1}", "d", "empty"}
    after = {(b.table, b.bucket): b.path for b in store.pointer(spark, str(base))[1]}
    b_bucket = g["sessions"].filter("session_id like 'b%'").first()["bucket"]
    a_bucket = g["sessions"].filter("session_id = 'a'").first()["bucket"]
    assert after["turns", a_bucket] != before["turns", a_bucket]
    if b_bucket != a_bucket:  # untouched: carried by its name
        assert after["turns", b_bucket] == before["turns", b_bucket]


def test_same_stem_older_file_does_not_win(spark, tmp_path):
    root, base = tmp_path / "in", tmp_path / "store"
    _session(root, "n1", "p", "s", ["newest"])
    assert _run(spark, root, base)[0] == [("s", 0, "newest")]
    _session(root, "n2", "p", "s", ["older copy"])
    os.utime(root / "n2" / "p" / "s.jsonl", (1_000_000_000, 1_000_000_000))
    assert _run(spark, root, base)[0] == [("s", 0, "newest")]
    assert _run(spark, root, base)[2]["changed"].count() == 0  # and is not read again
    os.utime(root / "n2" / "p" / "s.jsonl", (2_000_000_000, 2_000_000_000))
    assert _run(spark, root, base)[0] == [("s", 0, "older copy")]


def test_many_changed_files_are_scanned(spark, tmp_path):
    root = tmp_path / "in"
    for i in range(5):
        _session(root, "n", "p", f"s{i}", [f"t{i}"])
    files = J.list_files(spark, str(root), per_node_dirs=True)
    some = files.filter("session_id < 's3'")
    by_name = J.read_changed(spark, str(root), some, per_node_dirs=True)
    scanned = J.read_changed(spark, str(root), some, per_node_dirs=True, by_name=2)
    names = lambda df: sorted(r["session_id"] for r in df.collect())
    assert names(by_name) == names(scanned) == ["s0", "s1", "s2"]
    assert len(by_name.inputFiles()) == 3
    nothing = J.read_changed(spark, str(root), files.limit(0), per_node_dirs=True)
    assert nothing.count() == 0 and nothing.inputFiles() == []


SECOND_RUN = """
import sys
sys.path.insert(0, {repo!r})
from threadlake.session import get_spark
from threadlake.sources import jsonl as J
spark = get_spark("second-run", cores=2, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{log}",
                                               "spark.eventLog.compress": "false"}})
for i in range(2):
    spark.sparkContext.setJobGroup(f"run{{i}}", "")
    J.ingest_changes(spark, {root!r}, {base!r}, "now", per_node_dirs=True)["summary"].collect()
spark.stop()
"""


def test_many_changed_files_are_picked_from_one_listing(spark, tmp_path):
    """More changed files than are listed one by one: the folder is listed once,
    and the other files are not opened."""
    root = tmp_path / "many"
    for i in range(60):
        (root / "n1" / "it's p").mkdir(parents=True, exist_ok=True)
        (root / "n1" / "it's p" / f"s {i}.jsonl").write_text('{"type": "user"}\n')
    files = J.list_files(spark, str(root), per_node_dirs=True)
    changed = files.filter(F.regexp_extract("session_id", r"(\d+)", 1).cast("int") < 40)
    lines = J.read_changed(spark, str(root), changed, per_node_dirs=True)
    assert sorted(r["session_id"] for r in lines.collect()) == sorted(f"s {i}" for i in range(40))
    scan = lines._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.relation().location().rootPaths().size() == 1
    assert scan.metrics().apply("numFiles").value() == 40
    every = J.read_changed(spark, str(root), files, per_node_dirs=True, every=True)
    assert every.count() == 60


def test_second_run_reads_no_content(tmp_path):
    """By the event log: the text scan of the first run reads the files, the
    second run has no text scan."""
    root, log = tmp_path / "in", tmp_path / "log"
    log.mkdir()
    for i in range(20):
        _session(root, "n", "p", f"s{i}", ["x" * 1000] * 5)
    code = SECOND_RUN.format(repo=ROOT, log=log, root=str(root), base=str(tmp_path / "store"))
    subprocess.run([sys.executable, "-c", code], check=True, timeout=600, capture_output=True)
    events = [json.loads(line) for f in glob.glob(f"{log}/*/events*") for line in open(f, encoding="utf-8")]
    read = {}
    stages = {}
    for e in events:
        if e["Event"] == "SparkListenerStageSubmitted":
            info = e["Stage Info"]
            stages[info["Stage ID"]] = (e["Properties"].get("spark.jobGroup.id"), json.dumps(info["RDD Info"]))
        elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            group, rdds = stages[e["Stage ID"]]
            if "Scan text" in rdds:
                read[group] = read.get(group, 0) + e["Task Metrics"]["Input Metrics"]["Bytes Read"]
    assert read.get("run0", 0) > 100_000 and read.get("run1", 0) == 0


def _rows(spark, lo, hi, text="x" * 200):
    s = spark.range(lo, hi).select(F.col("id").cast("string").alias("session_id"),
                                   F.date_format(F.timestamp_add("HOUR", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz")),
                                                 "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("started_at"))
    s = s.withColumn("bucket", store.session_bucket(F.col("started_at"), F.col("session_id")))
    t = s.select("session_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("turn_idx"),
                 F.concat(F.lit(text), F.sha2("session_id", 512)).alias("text"), "bucket")
    return {"sessions": s, "turns": t}


def _bytes(base):
    return {p: os.path.getsize(p) for p in glob.glob(f"{base}/*/set=*/bucket=*/part-*")}


def test_small_batch_writes_little(spark, tmp_path):
    base = str(tmp_path)
    store.upsert(spark, base, "session_id", _rows(spark, 0, 10_000), spark.createDataFrame([], "session_id string"), J.ORDER)
    first = _bytes(base)
    # the newest 1 % of the sessions grow
    n, touched = store.upsert(spark, base, "session_id", _rows(spark, 9_900, 10_000, "y" * 200),
                              spark.createDataFrame([], "session_id string"), J.ORDER)
    new = {p: s for p, s in _bytes(base).items() if p not in first}
    assert sum(new.values()) < 0.03 * sum(first.values())
    rows = store.read(spark, base, "turns")
    assert rows.count() == 50_000 and rows.filter("text like 'y%'").count() == 500
    only = store.read(spark, base, "turns", touched)
    assert 500 <= only.count() < 1500 and len(only.inputFiles()) < len(rows.inputFiles()) / 10
    # keys that go, without rows that come
    gone = spark.createDataFrame([("5",), ("6",), ("none",)], "session_id string")
    empty = {k: v.limit(0) for k, v in _rows(spark, 0, 1).items()}
    store.upsert(spark, base, "session_id", empty, gone, J.ORDER)
    assert store.read(spark, base, "sessions").count() == 9_998 and store.read(spark, base, "turns").count() == 49_990


def test_retire_and_failed_jobs(spark, tmp_path):
    base, none = str(tmp_path), spark.createDataFrame([], "session_id string")
    for i in range(5):
        store.upsert(spark, base, "session_id", _rows(spark, 0, 30 + i, chr(97 + i)), none, J.ORDER)
    live = {b.path for b in store.pointer(spark, base)[1]}
    going = store.retire(spark, base, keep=1)
    assert going and not live & set(going)
    assert len(glob.glob(f"{base}/_pointer/set=*")) == 1
    assert {os.path.dirname(p) for p in _bytes(base)} == live
    assert store.read(spark, base, "turns").count() == 34 * 5 and store.retire(spark, base, keep=1) == []
    bad = _rows(spark, 0, 5)
    bad["turns"] = bad["turns"].withColumn("text", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        store.upsert(spark, base, "session_id", bad, none, J.ORDER)
    os.makedirs(f"{base}/_pointer/set=99")  # a pointer that was never finished
    assert store.read(spark, base, "turns").count() == 34 * 5
    store.upsert(spark, base, "session_id", _rows(spark, 0, 1, "z"), none, J.ORDER)
    assert store.pointer(spark, base)[0] == 100 and store.read(spark, base, "turns").filter("text like 'z%'").count() == 5
    assert store.read(spark, base, "never") is None and store.read(spark, str(tmp_path / "no"), "turns") is None
