"""Deadlines, retries and concurrency of extractor calls."""
import time

from threadlake.operators import facts as FX


def _packed(spark, texts):
    return spark.createDataFrame([(f"s{i}", t, False) for i, t in enumerate(texts)], "session_id string, transcript string, too_short boolean")


def _run(spark, texts, fn, **kw):
    return {r["session_id"]: (r["reply"], r["ok"], r["error"]) for r in FX.extract(_packed(spark, texts).coalesce(1), fn, **kw).collect()}


def _extractor():
    def call(text):  # travels to the workers by value
        import time
        if "hang" in text:
            time.sleep(600)
        if "bad" in text:
            raise ValueError("no")
        return text.upper()
    return call


_hangs = _extractor()


def test_a_call_that_hangs_fails_in_time(spark):
    start = time.monotonic()
    got = _run(spark, ["a", "hang 1", "b", "bad", "hang 2", *(f"t{i}" for i in range(40))], _hangs, deadline=2.0, calls=2)
    assert time.monotonic() - start < 60
    assert got["s0"] == ("A", True, None) and got["s2"] == ("B", True, None) and len(got) == 45
    assert got["s1"] == (None, False, "no reply in 2 s") and got["s4"][1] is False
    assert got["s3"] == (None, False, "ValueError: no")
    assert all(got[f"s{i + 5}"] == (f"T{i}", True, None) for i in range(40))


def test_calls_run_side_by_side(spark):
    def slow(text):
        time.sleep(0.5)
        return text
    _run(spark, ["x"], slow)
    start = time.monotonic()
    assert len(_run(spark, ["x"] * 16, slow, calls=16)) == 16
    assert time.monotonic() - start < 6


def test_failed_calls_are_made_again():
    seen = []

    def flaky(text):
        seen.append(text)
        if len(seen) < 3:
            raise OSError("later")
        return "ok"
    assert FX._call_all(flaky, ["x"], 5, 1, 2, []) == [("ok", True, None)] and len(seen) == 3
    seen.clear()
    assert FX._call_all(flaky, ["x"], 5, 1, 1, [])[0][:2] == (None, False)


def test_too_many_hanging_calls_end_the_task(monkeypatch):
    monkeypatch.setattr(FX, "LOST", 2)
    start = time.monotonic()
    got = FX._call_all(_hangs, ["hang"] * 50, 0.2, 2, 0, [])
    assert time.monotonic() - start < 5 and len(got) == 50 and not any(ok for _, ok, _ in got)
    assert sum(e.startswith("not called") for _, _, e in got) >= 46


def test_hanging_sessions_keep_their_marker(spark):
    packed = spark.createDataFrame([("a", "hang", False, 5), ("b", "fine", False, 6)],
                                   "session_id string, transcript string, too_short boolean, last_idx int")
    replies = FX.extract(packed, _hangs, deadline=1.0)
    markers = spark.createDataFrame([("a", 1)], "session_id string, last_turn_idx int")
    got = {r["session_id"]: r["last_turn_idx"] for r in FX.advance_markers(markers, packed, replies).collect()}
    assert got == {"a": 1, "b": 6}
