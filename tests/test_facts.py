"""The reference's extraction cases, as DataFrame tests."""
import json

import pytest

from pyspark.sql import functions as F

from threadlake.operators import facts as FX


def _replies(spark, reply, sid="sess-001"):
    return spark.createDataFrame([(sid, reply, True)], "session_id string, reply string, ok boolean")


def _sessions(spark):
    return spark.createDataFrame([("sess-001", "node-a", "2026-07-01T00:00:00Z")],
                                 "session_id string, node string, ended_at string")


def _classify(spark, items):
    return FX.classify_facts(FX.parse_replies(_replies(spark, json.dumps(items))))


def test_complete_fact_is_stored(spark):
    f = _classify(spark, [{"type": "decision", "fact": "Parquet tables are sorted by session.",
                           "tags": ["layout", "tables"]}])
    rows = FX.memory_rows(f, _sessions(spark), "2026-07-01T00:00:00Z")
    d = FX.dedupe(rows).collect()
    assert len(d) == 1 and d[0]["status"] == "stored"
    assert d[0]["content"] == "[decision] Parquet tables are sorted by session."
    assert d[0]["metadata"]["tags"] == ["layout", "tables", FX.SOURCE_TAG, "node:node-a"]


def test_duplicate_against_memory(spark):
    f = _classify(spark, [{"type": "config", "fact": "Port 8200.", "tags": []}])
    rows = FX.memory_rows(f, _sessions(spark), "x")
    memory = rows.select(F.sha2("content", 256).alias("content_hash"))
    assert FX.dedupe(rows, memory).first()["status"] == "duplicate"


def test_duplicate_within_run(spark):
    f = _classify(spark, [{"type": "config", "fact": "Same."}, {"type": "config", "fact": "Same."}])
    st = sorted(r["status"] for r in FX.dedupe(FX.memory_rows(f, _sessions(spark), "x")).collect())
    assert st == ["duplicate", "stored"]


def test_missing_type_is_unknown(spark):
    f = _classify(spark, [{"fact": "Something learned.", "tags": []}])
    r = FX.dedupe(FX.memory_rows(f, _sessions(spark), "x")).first()
    assert r["status"] == "stored" and r["content"].startswith("[unknown]")


def test_missing_fact_fails(spark):
    assert [r["status"] for r in _classify(spark, [{"type": "config", "tags": ["x"]}]).collect()] == ["failed"]


def test_empty_fact_fails(spark):
    assert [r["status"] for r in _classify(spark, [{"type": "outcome", "fact": "", "tags": []}]).collect()] == ["failed"]


def test_extractor_failure_gives_no_facts(spark):
    packed = spark.createDataFrame([("s1", "A" * 300, False)], "session_id string, transcript string, too_short boolean")

    def boom(_):
        raise TimeoutError("model call timed out")
    rep = FX.extract(packed, boom)
    r = rep.first()
    assert r["ok"] is False and r["reply"] is None
    assert FX.parse_replies(rep).count() == 0


def test_mixed_reply(spark):
    items = [{"type": "decision", "fact": "A."}, {"fact": "B."}, {"note": "neither key"}, {"type": "config"}]
    reply = "Sure! ```json\n" + json.dumps(items) + "\n``` done"
    f = FX.classify_facts(FX.parse_replies(_replies(spark, reply)))
    st = {r["pos"]: r["status"] for r in f.collect()}
    assert st == {0: "candidate", 1: "candidate", 2: "quarantined", 3: "failed"}
    d = FX.dedupe(FX.memory_rows(f, _sessions(spark), "x"))
    assert d.filter("status = 'stored'").count() == 2


def test_bad_replies_are_empty(spark):
    for reply in ["no brackets here", "[not json", "[]", None, "[1, \"x\"]"]:
        f = FX.classify_facts(FX.parse_replies(_replies(spark, reply)))
        assert f.filter("status = 'candidate'").count() == 0


def test_packing_consumes_each_turn_once(spark):
    """Running the packer until caught up visits every usable turn exactly once."""
    texts = [("s", i, "user" if i % 2 == 0 else "assistant", ("x" * (50 + (i * 37) % 400)) if i % 5 else "short")
             for i in range(40)]
    turns = spark.createDataFrame(texts, "session_id string, turn_idx int, role string, text string")
    since, seen = -1, []
    for _ in range(50):
        pending = spark.createDataFrame([("s", since)], "session_id string, since int")
        p = FX.pack_transcripts(pending, turns, max_chars=1000, max_turns=3, chunk_chars=300).first()
        if p["last_idx"] == since:
            break
        lines = [ln for ln in p["transcript"].split("\n\n") if ln]
        seen.extend(lines)
        since = p["last_idx"]
    usable = [t for t in texts if len(t[3].strip()) >= 10]
    assert since == 39
    assert len(seen) == len(usable)


def test_extraction_run_publishes_a_pair(spark, tmp_path):
    """sf0.01 has pending sessions: one extractor call per transcript, both
    tables behind one pointer, a second run goes on from the new markers."""
    from conftest import SF_MID
    from threadlake.sources import driver_tables as D
    from threadlake.sources import snapshots as SN
    base = str(tmp_path / "store")
    calls = spark.sparkContext.accumulator(0)

    def counted(transcript):
        calls.add(1)
        return FX.stub_extractor(transcript)

    s, t = D.sessions(spark, SF_MID), D.turns(spark, SF_MID)
    args = dict(max_chars=700, max_turns=3, chunk_chars=300)
    as_of = "2024-01-03T00:00:00Z"
    out = FX.extraction_run(s, t, D.markers(spark, SF_MID), None, counted, as_of, 24, base=base, **args)
    rep = out["report"].first()
    asked = out["packed"].filter("NOT too_short").count()
    assert asked > 0 and calls.value == asked and rep["stored"] > 0
    mem, mk = SN.read_latest(spark, base, "memory"), SN.read_latest(spark, base, "markers")
    assert mem.count() == rep["stored"] and mk.count() == out["markers"].count()
    again = FX.extraction_run(s, t, mk, mem, FX.stub_extractor, as_of, 24, base=base, **args)
    assert again["packed"].filter("since >= 0").count() > 0
    assert SN.latest_snapshot(spark, base, "memory") == 1


def test_failed_publish_keeps_the_old_pair(spark, tmp_path):
    from threadlake.sources import snapshots as SN
    base = str(tmp_path / "store")
    one = spark.createDataFrame([(1,)], "x int")
    SN.publish({"a": one, "b": one}, base)
    bad = one.select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception, match="no"):
        SN.publish({"a": one.union(one), "b": bad}, base)
    assert SN.read_latest(spark, base, "a").count() == 1 and SN.latest_snapshot(spark, base, "b") == 0
    SN.publish({"a": one.union(one), "b": one}, base)
    assert SN.read_latest(spark, base, "a").count() == 2
    assert SN.read_latest(spark, str(tmp_path / "none"), "a") is None
