"""Many small files: written, listed and read by tasks, once each."""
import glob
import os
import shutil

from threadlake.sources import export as EX
from threadlake.sources import jsonl as J

SCHEMA = "node string, project string, session_id string, pos int, line string"


def _files(root):
    return {os.path.relpath(f, root): open(f, "rb").read() for f in glob.glob(f"{root}/**/*", recursive=True) if os.path.isfile(f)}


def test_tasks_write_files_under_their_names(spark, tmp_path, monkeypatch):
    """The driver neither lists nor renames what the tasks wrote."""
    monkeypatch.setattr(EX, "_named_files", None)
    rows = [("n1", "p", f"s{i}", j, f"é{i} {j}") for i in range(50) for j in (2, 0, 1)]
    rows += [("n/2", None, "a:b", 0, "odd"), ("", "p q", "%", 0, "x")]
    root = tmp_path / "out"
    EX.write_jsonl(spark.createDataFrame(rows, SCHEMA), str(root))
    got = _files(root)
    assert len(got) == 52 and got["n1/p/s7.jsonl"].decode() == "é7 0\né7 1\né7 2\n"
    none = "__HIVE_DEFAULT_PARTITION__"
    assert got[f"n%2F2/{none}/a%3Ab.jsonl"] == b"odd\n" and got[f"{none}/p q/%25.jsonl"] == b"x\n"
    assert not [n for d, _, names in os.walk(root) for n in names if n.startswith(".")]
    EX.write_jsonl(spark.createDataFrame([("n1", "p", "s7", 0, "new")], SCHEMA), f"file://{root}")  # replaced
    assert _files(root) == got | {"n1/p/s7.jsonl": b"new\n"}
    EX.touch(spark.createDataFrame([("n9", "p", "e")], "node string, project string, session_id string"), str(root))
    assert _files(root)["n9/p/e.jsonl"] == b"" and len(_files(root)) == 53


def test_tasks_list_what_spark_lists(spark, tmp_path, monkeypatch):
    names = ["n1/p a/s1", "n1/p a/b [x] {1}", "n1/it's %41/é ü x", "n1/p/a+b&c=d;e,f$~!@(z)", "n2/deep/er/x y", "n1/p/_hid",
             "n1/p/_a=b", "n1/p/.dot", "n1/_h/z", "n1/p/a#b^c`d|\"e<f>", "n1/p/empty", "n1/top", "up"]
    root = tmp_path / "in"
    for n in names:
        f = root / f"{n}.jsonl"
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("" if n.endswith("empty") else "x\n")
    (root / "n1" / "p" / "other.txt").write_text("x\n")
    want = {tuple(r) for r in J._listed_by_spark(spark, str(root)).collect()}
    for levels in (1, 2):
        assert {tuple(r) for r in J._listed_by_tasks(spark, str(root), levels).collect()} == want
    scanned = {r[0] for r in J.scan_lines(spark, str(root)).select("file_path").collect()}
    assert len(want) == 10 and scanned == {r[0] for r in want if r[3]}
    monkeypatch.setattr(J, "_listed_by_spark", None)
    files = J.list_files(spark, str(root), per_node_dirs=True)
    (root / "n1" / "p" / "late.jsonl").write_text("x\n")
    assert files.count() == 10  # listed once


def test_files_are_read_once(spark, tmp_path):
    """Turns, headers, quarantine and digests come from one pass over the files."""
    root = tmp_path / "in"
    lines = ['{"type": "user", "timestamp": "2024-01-01T00:00:00Z", "message": {"content": "hi"}}', "{broken", "5",
             '{"type": "assistant", "timestamp": "2024-01-01T00:01:00Z", "message": {"content": [{"type": "text", "text": "yes"},'
             ' {"type": "tool_use", "name": "Bash", "input": {"command": "ls"}}]}}', '{"type": "ai-title", "aiTitle": "T"}']
    for sid in "ab":
        (root / "n" / "p").mkdir(parents=True, exist_ok=True)
        (root / "n" / "p" / f"{sid}.jsonl").write_text("\n".join(lines))

    def rows(g):
        msgs, tools = J.digest_inputs(g["records"])
        return [sorted(map(str, df.drop("pos", "block", "mid").collect()))
                for df in (g["turns"], g["sessions"], g["quarantine"], msgs, tools)]

    want = rows(J.ingest(spark, str(root), "x", per_node_dirs=True))
    once = J.ingest(spark, str(root), "x", per_node_dirs=True, materialize=True, with_records=True)
    shutil.move(root, tmp_path / "elsewhere")
    assert rows(once) == want and [len(x) for x in want] == [4, 2, 4, 4, 2]
