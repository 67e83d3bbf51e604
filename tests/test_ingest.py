"""Raw JSONL and chat-export ingest on generated fixtures (FIXTURES B1, B2)."""
import json
import os

from pyspark.sql import functions as F

from threadlake.sources import chat as CH
from threadlake.sources import jsonl as J


def _write(path, lines, raw_bytes=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        for ln in lines:
            f.write((ln if isinstance(ln, str) else json.dumps(ln)).encode("utf-8") + b"\n")
        if raw_bytes:
            f.write(raw_bytes + b"\n")


def _fixture(root):
    long_result = "r" * 700
    lines = [
        {"type": "ai-title", "aiTitle": "First"},
        "",                                            # blank
        "{not json",                                   # malformed
        "5",                                           # bare number
        {"type": "summary", "x": 1},                   # unknown type
        {"type": "user", "timestamp": "2024-01-01T00:00:00Z", "message": None},   # null message, no cwd
        {"type": "user", "timestamp": "2024-01-01T00:01:00Z", "cwd": "/w", "message": {"content": ""}},
        {"type": "user", "timestamp": "2024-01-01T00:02:00Z", "message": {"content": "   "}},
        {"type": "user", "timestamp": "2024-01-01T00:03:00Z", "message": {"content": "[not a list]"}},
        {"type": "assistant", "timestamp": "2024-01-01T00:04:00Z", "message": {"content": [
            {"type": "text", "text": None}, {"type": "text", "text": "hello"},
            {"type": "tool_use", "name": "Bash", "input": {"command": "ls"}},
            {"type": "tool_use", "name": "Edit", "input": {"description": "fix it", "file_path": "/a.py"}}]}},
        {"type": "user", "timestamp": "2024-01-01T00:05:00Z", "message": {"content": [
            {"type": "tool_result", "content": long_result}]}},
        {"type": "user", "timestamp": "2024-01-01T00:06:00Z", "message": {"content": [
            {"type": "tool_result", "content": [{"text": "a"}, {"text": "b"}, "skip"]}]}},
        {"type": "user", "timestamp": "2024-01-01T00:07:00Z", "message": {"content": [
            {"type": "tool_result", "content": {"k": 1}}]}},
        {"type": "user", "timestamp": "2024-01-01T00:08:00Z", "message": {"content": [
            {"type": "tool_result", "content": None}]}},
        {"type": "ai-title", "aiTitle": "Second"},
    ]
    _write(os.path.join(root, "nodeA", "proj1", "s1.jsonl"), lines, raw_bytes=b'{"type":"user","message":{"content":"caf\xe9"}}')
    _write(os.path.join(root, "nodeA", "proj1", "empty.jsonl"), ["", "{bad", {"type": "other"}])
    _write(os.path.join(root, "nodeB", "proj2", "s1.jsonl"), [{"type": "user", "message": {"content": "older copy"}}])
    os.utime(os.path.join(root, "nodeB", "proj2", "s1.jsonl"), (1_000_000_000, 1_000_000_000))
    os.makedirs(os.path.join(root, "nodeC"), exist_ok=True)


def test_jsonl_edge_cases(spark, tmp_path):
    root = str(tmp_path / "store")
    _fixture(root)
    g = J.ingest(spark, root, "2024-12-31T00:00:00Z", per_node_dirs=True)
    turns = {r["turn_idx"]: r for r in g["turns"].filter("session_id = 's1'").collect()}
    texts = [turns[i]["text"] for i in sorted(turns)]
    assert texts[0] == "   "                       # whitespace-only string content is a turn
    assert texts[1] == "[not a list]"
    assert texts[2] == "hello\n[tool:Bash]\n[tool:Edit] fix it"
    assert texts[3] == "[result] " + "r" * 500
    assert texts[4] == "[result] a b"
    assert texts[5] == '[result] {"k":1}'
    assert texts[6] == "[result] "
    assert texts[7] == "caf�"                  # invalid UTF-8 replaced
    s = g["sessions"].filter("session_id = 's1'").collect()
    assert len(s) == 1                              # newest of the two same-stem files
    s = s[0]
    assert s["node"] == "nodeA" and s["project"] == "proj1"
    assert s["ai_title"] == "Second" and s["cwd"] == "/w"
    assert s["started_at"] == "2024-01-01T00:00:00Z" and s["ended_at"] == "2024-01-01T00:08:00Z"
    assert s["turn_count"] == len(texts)
    assert g["sessions"].filter("session_id = 'empty'").count() == 0   # no usable line
    reasons = sorted(r["reason"] for r in g["quarantine"].collect())
    assert reasons == ["malformed json", "malformed json", "not an object"]


def test_split_files_keep_order(tmp_path):
    from threadlake.session import get_spark
    spark = get_spark("tests")
    root = str(tmp_path / "big")
    lines = [{"type": "user" if i % 2 == 0 else "assistant", "timestamp": f"t{i:05d}",
              "message": {"content": f"line {i} " + "x" * 200}} for i in range(2000)]
    _write(os.path.join(root, "n", "p", "big.jsonl"), lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        g = J.ingest(spark, root, "x", per_node_dirs=True)
        assert g["lines"].rdd.getNumPartitions() > 1
        t = g["turns"].orderBy("turn_idx").select("turn_idx", "ts").collect()
        assert [r["ts"] for r in t] == [f"t{i:05d}" for i in range(2000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_changed_files_and_upsert(spark, tmp_path):
    root = str(tmp_path / "store")
    _fixture(root)
    g = J.ingest(spark, root, "x", per_node_dirs=True)
    man = J.list_files(spark, root, per_node_dirs=True)
    assert J.changed_files(man, g["sessions"]).join(g["sessions"], ["session_id", "file_path"], "left_semi").count() == 0
    old = g["sessions"].withColumn("file_mtime", F.lit(0).cast("timestamp")).drop("source", "node")
    ch = J.changed_files(man, old)
    up = J.with_defaults(J.upsert(old, g["sessions"], ch))
    assert up.filter("session_id = 's1'").first()["node"] == "nodeA"


def test_chat_export(spark, tmp_path):
    convs = [
        {"uuid": "c1", "name": "Chat", "summary": "sum", "created_at": "2024-01-01T00:00:00Z",
         "updated_at": "2024-01-02T00:00:00Z",
         "chat_messages": [{"sender": "human", "text": "hi", "created_at": "t0"},
                           {"sender": "assistant", "text": "  ", "created_at": "t1"},
                           {"sender": "assistant", "text": "", "created_at": "t2",
                            "attachments": [{"file_name": "a.txt"}], "files": [{"name": "b.png"}]}]},
        {"uuid": "c2", "created_at": "x", "updated_at": "not a date", "chat_messages": []},
        {"uuid": "c3", "name": "", "chat_messages": [{"text": "only text, no sender"}]},
    ]
    p = tmp_path / "export"
    p.mkdir()
    (p / "conversations.json").write_text(json.dumps(convs))
    c = CH.read_export(spark, str(p))
    t = {(r["session_id"], r["turn_idx"]): r for r in CH.conversation_turns(c).collect()}
    assert t[("c1", -1)]["role"] == "summary"
    assert t[("c1", 0)]["text"] == "hi" and t[("c1", 0)]["role"] == "user"
    assert t[("c1", 1)]["text"] == "\n[attachment: a.txt]\n[file: b.png]"
    assert ("c1", 2) not in t
    assert t[("c3", 0)]["role"] == "user"
    s = {r["session_id"]: r for r in CH.conversation_sessions(c, "x").collect()}
    assert set(s) == {"c1", "c3"}
    assert s["c3"]["ai_title"] == "(no name)" and s["c1"]["turn_count"] == 2
    assert CH.changed_conversations(c, CH.conversation_sessions(c, "x")).count() == 1   # c2 never stored
