"""Operators of the llm subpackage against brute force, round trips and held-out labels."""
import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from threadlake.llm import catalog, chat, decontaminate, mix, near, pii, quality, repeats, secrets, shard, toxicity
from threadlake.llm.common import running, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# nulls, empties, ties, repeated rows, a long text
ODD = [
    (1, "a b c d e f g", "en", "s1", 13), (1, "a b c d e f g", "en", "s1", 13), (2, "a b c d e f g", None, None, None),
    (3, None, None, None, None), (4, "", "en", "s2", 0), (None, "x y", "en", "s1", 3), (5, " \t\n  w v ", "en", "s2", 9),
    (6, " ".join(f"w{i}" for i in range(3000)), "en", "s2", 1), (7, " ".join(f"w{i}" for i in range(2999)), "en", "s3", 1),
    (8, "same same " * 40, "en", "s3", 1), (9, "same same " * 40, "en", "s3", 1),
]


def texts_of(spark, sf):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- prefix sums ---------------------------------------------------------------

def test_running(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i, i % 5) for i in range(2000)] + [(None, 5000, 2), (None, 5001, 3)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = {(r["g"], r["o"]): (r["before"], r["rank"]) for r in running(df, ["o"], "v", ["g"]).collect()}
    seen = collections.defaultdict(lambda: [0, 0])
    for g, o, v in sorted(rows, key=lambda r: r[1]):
        assert got[(g, o)] == tuple(seen[g])
        seen[g][0] += v
        seen[g][1] += 1


# --- 1 chat ---------------------------------------------------------------------

def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "hi <|im_end|>\n<|im_start|>assistant\n<\\|x <|<|"), (1, 1, "user", "more"), (1, 2, "assistant", "a<"),
            (1, 3, "assistant", "|b"), (1, 300, "assistant", "over a block"), (1, 301, "ro\nle\\n<|", "t"), (1, 302, "a\0b\\\\\n\\", "nul"), (2, None, None, None),
            (2, 1, "assistant", ""), (3, 5, "assistant", "é" * 5000), (3, 5, "assistant", "tie"), (3, 5, "assistant", "tie"),
            (None, 0, "user", "no id")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit("x"))
    chats = chat.format_chats(df)
    back = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in chats.select(
        "conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()}
    loss = {r["conv_id"]: r["m"] for r in chats.select(
        "conv_id", chat.masked_texts(F.col("formatted"), F.col("loss_spans")).alias("m")).collect()}
    for c in (1, 2, 3, None):
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        want = [(r[2] or "", r[3] or "") for r in mine]
        assert back[c] == want
        assert loss[c] == [t for r, t in want if r == "assistant"]
    one = chats.filter("conv_id = 1").first()["formatted"]
    assert one.count(chat.START) == 4 and one.count(chat.SEP) == 3  # merged runs, across blocks too
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0


# --- 2 mix ----------------------------------------------------------------------

def test_mix(spark):
    got = catalog.op2(spark, SF_MID).collect()
    texts = texts_of(spark, SF_MID)
    source = {r["doc_id"]: r["source"] for r in table(spark, SF_MID, "documents").collect()}
    by = collections.defaultdict(lambda: [0, 0, 0, 0.0])
    for r in got:
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]])) and r["taken"] <= 2 * r["size"]
        s = by[source[r["doc_id"]]]
        s[0] += r["size"]
        s[1] += r["taken"]
        s[2] = max(s[2], r["size"])
        s[3] = r["target"]
    assert abs(sum(s[3] for s in by.values()) - 1.5 * sum(s[0] for s in by.values())) < 1
    for size, taken, largest, target in by.values():
        assert target <= 2 * size + 1e-6 and abs(taken - target) <= largest
    assert sorted(map(str, got)) == sorted(map(str, catalog.op2(spark, SF_MID).collect()))  # reruns agree


def test_mix_targets():
    t = mix.targets([("b", 10), (None, 100), ("a", 1000)])
    assert list(t) and t["b"] == 20.0 and t["a"] + t[None] + 20 == pytest.approx(1665)
    assert mix.targets([]) == {} and mix.targets([("a", 0)]) == {"a": 0.0}


def test_mix_odd(spark, odd, empty):
    rows = mix.mix(odd).collect()
    assert len(rows) == len(ODD) and all(r["taken"] <= 2 * r["size"] for r in rows)
    taken = sum(r["taken"] for r in rows)
    out = mix.mixed(odd)
    assert out.columns == odd.columns
    assert sum(len(WORD.findall(r["text"] or "")) for r in out.collect()) == taken
    assert mix.mix(empty).count() == 0 and mix.mixed(empty).count() == 0


# --- 3 quality --------------------------------------------------------------------

def brute_counts(text):
    words = WORD.findall(text or "")
    runs = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    cover = set()
    for i in range(len(words) - 2):
        if runs[tuple(words[i:i + 3])] > 1:
            cover |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover)


def test_quality(spark):
    got = {r["doc_id"]: r for r in catalog.op3(spark, SF_MID).collect()}
    for i, t in texts_of(spark, SF_MID).items():
        r = got[i]
        want = brute_counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    labels = [(r["quality"], got[r["doc_id"]]) for r in table(spark, SF_MID, "labels").collect()]
    good = [r["kept"] for q, r in labels if q == 1 and not r["base_failed"]]
    bad = [r["kept"] for q, r in labels if q == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_quality_em_finds_accuracies():
    rng = np.random.default_rng(1)
    true = rng.random(20000) < 0.8
    acc, votes = (0.95, 0.9, 0.7), []
    for a in acc:
        right = rng.random(20000) < a
        cast = rng.random(20000) < 0.8
        votes.append(np.where(cast, np.where(right == true, 1, -1), 0))
    patterns, n = np.unique(np.stack(votes, 1), axis=0, return_counts=True)
    share, accuracy = quality.learn(patterns, n.astype(float))
    assert 0.6 < share < 0.95
    assert accuracy[0, 0] > accuracy[2, 0]  # the contradicted rule loses weight


def test_quality_em_without_anchor():
    """A rule little better than a coin is found out, and the share of good texts too."""
    rng = np.random.default_rng(1)
    good = rng.random(400_000) < 0.8
    right = [rng.random(good.size) < a for a in (0.95, 0.9, 0.55)]
    votes = np.stack([np.where(r == good, 1, -1) for r in right], 1)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    share, learned = quality.learn(patterns, n.astype(float))
    assert abs(share - 0.8) < 0.03
    for k in range(3):
        bad, fine = votes[:, k] < 0, votes[:, k] > 0
        assert abs(learned[k, 0] - (~good)[bad].mean()) < 0.05 and abs(learned[k, 1] - good[fine].mean()) < 0.05


def test_quality_does_not_turn_with_the_number_of_rows(spark):
    """Most texts are sound: the model says so for a hundred rows and for millions."""
    rules = list(quality.votes(F.struct(*[F.lit(1).alias(c) for c in quality.COUNTS])))
    seen = {("many_words", "varied_words"): 28642, ("varied_words",): 13175, ("too_short",): 2230,
            ("symbols", "many_words", "varied_words"): 2183, ("symbols", "varied_words"): 1276,
            ("repeated_words", "few_words_over_and_over", "many_words"): 1055,
            ("repeated_words", "capitals", "stress", "many_words"): 751, ("repeated_words",): 244}
    good = ("many_words", "varied_words")
    patterns = np.array([[(1 if r in good else -1) if r in p else 0 for r in rules] for p in seen])
    trusted = tuple(i for i, r in enumerate(rules) if r in quality.TRUSTED)
    for times in (0.01, 1, 100):
        share, accuracy = quality.learn(patterns, np.array(list(seen.values()), float) * times, trusted)
        odds = np.log(share / (1 - share))
        logit = (odds + (patterns < 0) @ quality._weight(accuracy[:, 0], -odds, -1)
                 + (patterns > 0) @ quality._weight(accuracy[:, 1], odds, 1))
        assert (logit[:2] > 0).all() and (logit[2:] < 0).all()


def test_quality_odd(spark, odd, empty):
    assert [tuple(quality.count_text(t)[:5]) for _, t, *_ in ODD] == [brute_counts(t) for _, t, *_ in ODD]
    assert quality.quality_rules(odd).count() == len(ODD)
    assert quality.keep_good(odd).columns == odd.columns
    assert quality.quality_rules(empty).count() == 0 and quality.keep_good(empty).count() == 0


# --- 4 substring dedup ---------------------------------------------------------------

def brute_removed(rows):
    words = [WORD.findall(t or "") for t in rows]
    n = collections.Counter(tuple(w[i:i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - 34):
            if n[tuple(w[i:i + 35])] > 1:
                gone |= set(range(i, i + 35))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_repeats(spark):
    texts = texts_of(spark, SF_MID)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in catalog.op4(spark, SF_MID).collect()}
    assert [got[i] for i in texts] == brute_removed(list(texts.values()))


def test_repeats_odd(spark, odd, empty):
    rng = np.random.default_rng(2)
    w = lambda n: " ".join(f"v{x}" for x in rng.integers(0, 50, n))
    shared = w(60)
    more = [(100 + i, f"{w(20)} {shared} {w(20)}", "en", "s", 1) for i in range(6)]
    more += [(200, " ".join([shared] * 3), "en", "s", 1), (201, " ".join(shared.split()[:34]), "en", "s", 1),
             (202, " ".join(shared.split()[:35]), "en", "s", 1), (203, "z " * 100, "en", "s", 1)]
    df = odd.unionByName(spark.createDataFrame(more, SCHEMA))
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.digests(df).collect())
    rows = ODD + more
    want = sorted((str(r[0]), *b) for r, b in zip(rows, brute_removed([r[1] for r in rows]), strict=True))
    assert got == want
    assert repeats.digests(empty).count() == 0


def test_window_hashes_and_anchors():
    h = np.random.default_rng(0).integers(0, 1 << 62, 300).astype(np.uint64)
    for width in (1, 2, 5, 9, 18, 35):
        a = repeats.windows(h, width)
        assert len(a) == len(h) - width + 1
        assert (repeats.windows(h[7:], width) == a[7:]).all()  # depends on the words alone
    h9 = repeats.windows(h, 9)
    at = repeats.anchors(h9)
    inside = repeats.anchors(h9[50:150]) + 50
    assert set(inside[(inside >= 76) & (inside < 123)]) <= set(at)
    assert all(((at >= s) & (at < s + repeats.SPAN)).any() for s in range(len(h9) - repeats.SPAN + 1))


# --- 5 secrets ------------------------------------------------------------------------

def test_secrets(spark, odd, empty):
    found = {(r["value_sha256"]): r for r in catalog.op5(spark, SF_MID).collect()}
    for text in texts_of(spark, SF_MID).values():
        for m in re.finditer(r'token = "([0-9a-f]{40})"|(AKIA[A-Z0-9]{16})|password=([0-9a-f]{18})', text):
            assert found[secrets.sha(next(g for g in m.groups() if g))]["secret"]
        for m in re.finditer(r"(?<![\w.])\d{16}(?!\w)", text):
            assert not found[secrets.sha(m.group())]["secret"]
    assert secrets.scan(odd).count() == 0 and secrets.scan(empty).count() == 0


def test_secret_candidates_are_whole():
    """Letter-only keys, runs over 512 characters, short and odd passwords, each once and whole."""
    rng = np.random.default_rng(2)
    long = "".join(rng.choice(list("abcdefghABCDEFGH0123456789"), 903))
    found = lambda t: [(s, v) for s, v, _, _ in secrets.candidates(t)]
    assert found('token = "aBcDeFgHiJkLmNoPqRsTuVwX"') == [(9, "aBcDeFgHiJkLmNoPqRsTuVwX")]
    assert found(f"see {long} there") == [(4, long)] and found(long[:516]) == [(0, long[:516])]
    assert found('password = "hunter2!Xq9"') == [(12, "hunter2!Xq9")]
    assert found("x: DB_PASSWORD=p4$s; y") == [(15, "p4$s")]
    assert found('{"apiKey": "a b\'c"}') == [(12, "a b'c")]
    assert found('secret = "ab!0123456789abcdef01"') == [(10, "ab!0123456789abcdef01")]
    assert found("nothing = here: at all") == [] and found("password = ") == []


def test_secrets_short_and_letters(spark):
    """The forest keeps short passwords and letter-only keys, and leaves words and calls."""
    rows = ['password = "hunter2!Xq9"', 'token = "aBcDeFgHiJkLmNoPqRsTuVwX"', 'password = "value"', "token = get.name()"]
    df = spark.createDataFrame([(i, f"the other thing {r} and more") for i, r in enumerate(rows)] + [(9, "value name get other " * 50)],
                               "doc_id long, text string")
    got = {r["doc_id"]: r["secret"] for r in secrets.scan(df).collect()}
    assert got == {0: True, 1: True, 2: False, 3: False}


def test_secrets_held_out(spark):
    rows = secrets.made_findings(["value", "name", "other", "thing"], 2000)
    train, test = rows[:1000], rows[1000:]
    df = spark.createDataFrame([(i, v, p, a, y) for i, (v, p, a, y) in enumerate(test)],
                               "doc_id long, value string, before string, after string, label int")
    got = secrets.scored(df, train, {}, ["value", "name"]).select("label", "score").collect()
    right = sum((r["score"] >= 0.5) == bool(r["label"]) for r in got)
    assert right >= 0.95 * len(got)


# --- 6 decontamination ------------------------------------------------------------------

def test_leaks_edges(spark, odd, empty):
    words = [f"b{i}" for i in range(40)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "Two words"), (3, None), (4, ""), (None, "x y z u v w"), (5, " ".join(words))],
                                  "item_id long, text string").withColumn("doc_id", F.lit(0))
    docs = [(10, "pre " + " ".join(words) + " post"), (11, " ".join(words[:35])), (12, " ".join(words[:30])),
            (13, "some two words here"), (14, None), (15, "twowords"), (None, "x y z u v w"), (16, " ".join(words).upper())]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(df, bench).collect()}
    # 36 shingles; 31 of them are 0.86, 26 are 0.72
    assert got == {(d, i) for d in (10, 11, 16) for i in (1, 5)} | {(13, 2), (None, None)}
    clean = decontaminate.clean(df, bench)
    assert {r["doc_id"] for r in clean.collect()} == {12, 14, 15} and clean.columns == df.columns
    # items of one item_id are judged one by one: the half copy of the long one must not lend its length
    long, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(10))
    twice = spark.createDataFrame([(7, long), (7, other)], "item_id long, text string")
    held = spark.createDataFrame([(1, f"x {other} y"), (2, " ".join(long.split()[:24])), (3, long)], "doc_id long, text string")
    got = {tuple(r) for r in decontaminate.leaks(held, twice).collect()}
    assert got == {(1, 7, 6, 6, 1.0), (3, 7, 36, 36, 1.0)}
    assert decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.leaks(odd, bench.limit(0)).count() == 0


def test_clean_row_by_row(spark):
    """A leaking row takes no other row without an id, or of its id, along."""
    item = " ".join(f"b{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, f"a {item} b"), (None, "clean one"), (None, None), (4, f"c {item}"), (4, "clean two"), (5, "clean three")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in decontaminate.clean(df, bench).collect()}
    assert got == {rows[1], rows[2], rows[4], rows[5]}
    assert {tuple(r)[:2] for r in decontaminate.leaks(df, bench).collect()} == {(None, 1), (4, 1)}


# --- 7 shards -----------------------------------------------------------------------------

def test_shards(spark):
    texts = texts_of(spark, SF_MID)
    rows = catalog.op7(spark, SF_MID).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    by = collections.defaultdict(list)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(8))
    sizes = [sum(r["size"] for r in x) for x in by.values()]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows) + 0.04 * sum(sizes) / 8
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in by.values())


def test_shards_odd(spark, odd, empty):
    rows = shard.shard(odd, 3).collect()
    assert len(rows) == len(ODD) and all(0 <= r["shard"] < 3 for r in rows)
    assert shard.shard(empty).count() == 0


def test_shards_cut_a_huge_group(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, "same text").otherwise(
        F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    sizes = [r["s"] for r in shard.shard(df).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.05 * min(sizes)


# --- 8 n-gram join ---------------------------------------------------------------------------

def brute_links(rows):
    """Per row: (least doc_id of its linked group, number of linked texts)."""
    seqs = [tuple(WORD.findall(t or "")) for _, t in rows]
    first = {}
    for (i, _), s in sorted(zip(rows, seqs, strict=True), key=lambda x: x[0][0]):
        first.setdefault(s, i)
    sets = {s: {s[i:i + min(5, len(s))] for i in range(max(1, len(s) - 4))} if s else set() for s in first}
    inverted = collections.defaultdict(list)
    for s, x in sets.items():
        for g in x:
            inverted[g].append(s)
    links = collections.defaultdict(set)
    for s, x in sets.items():
        n = collections.Counter(o for g in x for o in inverted[g] if o != s)
        links[s] = {o for o, k in n.items() if k >= 0.8 * (len(x) + len(sets[o]) - k)}
    group = {}
    for s in sorted(first, key=first.get):
        if s in group:
            continue
        todo = [s]
        while todo:
            x = todo.pop()
            if x not in group:
                group[x] = first[s]
                todo += links[x]
    return [(group[s], len(links[s])) for s in seqs]


def test_near(spark):
    texts = texts_of(spark, SF_MID)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in catalog.op8(spark, SF_MID).collect()}
    assert [got[i] for i in texts] == brute_links(list(texts.items()))


def test_near_large_groups(spark, monkeypatch):
    """Groups larger than a block, chains, copies: every link is counted."""
    monkeypatch.setattr(near, "BLOCK", 8)
    rng = np.random.default_rng(4)
    word = lambda: f"w{rng.integers(10 ** 6)}"
    rows, i = [], 0
    for size in (2, 5, 60):
        base = [word() for _ in range(200)]
        for _ in range(size):
            t = list(base)
            for _ in range(int(rng.integers(0, 5))):
                t[rng.integers(200)] = word()
            rows.append((i, " ".join(t)))
            i += 1
    rows += [(i + k, rows[3][1]) for k in range(5)] + [(i + 10, ""), (i + 11, None), (i + 12, "a b"), (i + 13, "a  b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near.near_join(df).collect()}
    want = dict(zip([r[0] for r in rows], brute_links(rows), strict=True))
    missed = sum(want[k][1] - got[k][1] for k in want)
    assert all(got[k][1] <= want[k][1] for k in want) and missed <= 0.01 * sum(w[1] for w in want.values())
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}


def test_near_odd(spark, odd, empty):
    assert near.near_join(odd).count() == len(ODD)
    kept = near.one_of_each(odd)
    assert kept.columns == odd.columns
    assert near.near_join(empty).count() == 0 and near.one_of_each(empty).count() == 0


def test_one_of_each_shared_ids(spark):
    """Rows without an id, or with one id, are kept by their texts."""
    rng = np.random.default_rng(9)
    a, b, c, d, e = (" ".join(f"w{rng.integers(10 ** 6)}" for _ in range(60)) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (5, c), (5, d), (5, c + " more"), (1, d + " more"), (None, e), (7, e), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in near.one_of_each(df).collect()), key=str)
    assert len(got) == 6 and set(got) - {(5, c), (5, c + " more")} == {
        (None, a), (None, b), (1, d + " more"), (7, e), (None, None)}
    assert near.near_join(df).count() == len(rows)


def test_forest_depth():
    d = near.depth_for()
    assert 1 - (1 - 0.8 ** d) ** near.TREES >= near.TARGET_RECALL > 1 - (1 - 0.8 ** (d + 1)) ** near.TREES


def test_forest_recall_at_the_threshold():
    """Random pairs of Jaccard similarity 0.8: as many share a bucket as TARGET_RECALL says."""
    rng = np.random.default_rng(5)
    odd, add, paths = near._family()
    found, pairs, depth = 0, 6000, near.depth_for()
    for _ in range(pairs):
        x = rng.integers(0, 1 << 63, 90, dtype=np.uint64)  # 80 shared, 10 and 10 of their own
        one, two = (near.prefixes(near.minhash(np.concatenate([x[:80], own]), odd, add), paths, depth)
                    for own in (x[80:], rng.integers(0, 1 << 63, 10, dtype=np.uint64)))
        found += bool((one == two).any())
    assert found >= near.TARGET_RECALL * pairs  # 0.99946 by the formula


# --- 9 toxicity -------------------------------------------------------------------------------

def test_toxicity(spark):
    got = {r["doc_id"]: r for r in catalog.op9(spark, SF_MID).collect()}
    label = {r["doc_id"]: r["toxic"] for r in table(spark, SF_MID, "labels").collect()}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
        assert all(e["doc_id"] in label and zlib.crc32(str(e["doc_id"]).encode()) % 3 != 1 for e in r["evidence"])
    test = [(label[i], got[i]) for i in label if got[i]["held_out"]]
    assert sum(r["predicted"] for y, r in test if y == 0) == 0
    assert sum(r["predicted"] for y, r in test if y == 1) >= 0.75 * sum(y for y, _ in test)


def tox_terms(text):
    """Term → times, anew."""
    out = collections.Counter()
    for w, n in collections.Counter(re.findall(r"[^\W\d_]+", (text or "").lower())).items():
        for t in {w, *[w[:k] + "*" for k in (4, 5) if len(w) > k]}:
            out[t] += n
    return out


def test_toxicity_against_brute_force(spark, monkeypatch):
    """Cosines of the evidence are the highest over whole texts and all terms;
    labels sent to the texts or shuffled give one answer."""
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    monkeypatch.setattr(toxicity, "BROADCAST_LABELS", 0)
    assert got == {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    label = {r["doc_id"]: r["toxic"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["doc_id"] in text}
    n = collections.Counter(label.values())
    held = {i: tox_terms(t) for i, t in text.items()}
    df = {y: collections.Counter(t for i, v in label.items() if v == y for t in held[i]) for y in (0, 1)}

    def weight(t):
        c, x = (df[0][t], df[1][t]) if df[0][t] + df[1][t] else (1, 0)
        half = sum(n.values()) / 2
        p = (x * half / n[1] + 1) / (x * half / n[1] + c * half / n[0] + 2)
        p = min(max(p, 1e-12), 1 - 1e-12)
        info = p * np.log(2 * p) + (1 - p) * np.log(2 * (1 - p))
        return (np.log((sum(n.values()) + 1) / (c + x + 1)) + 1) * max(info, 1e-6)

    vectors = {}
    for i, x in held.items():
        w = {t: (1 + np.log(k)) * weight(t) for t, k in x.items()}
        size = np.sqrt(sum(v * v for v in w.values())) or 1.0
        vectors[i] = {t: v / size for t, v in w.items()}
    for i, v in vectors.items():
        if sum(df[0][t] + df[1][t] for t in v) == 0:
            continue
        every = np.array(sorted((sum(x * vectors[j].get(t, 0.0) for t, x in v.items()) for j in label), reverse=True)[:16])
        assert np.allclose([e["cosine"] for e in got[i]["evidence"]], every[every > 0], atol=1e-5)


def test_toxicity_rare_words(spark):
    """300 toxic words, each in a third of a percent of the toxic texts, are all seen."""
    rng = np.random.default_rng(5)
    base = [f"w{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + i // 676)}x" for i in range(2000)]
    bad = [f"q{chr(97 + i // 26)}{chr(97 + i % 26)}zz" for i in range(300)]
    rows = [(i, " ".join([*rng.choice(base, 30), *([bad[rng.integers(300)]] if i % 2 else [])]), i % 2) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    got = [r for r in toxicity.toxicity(df.drop("toxic"), df.select("doc_id", "toxic")).collect() if r["held_out"]]
    assert sum(r["predicted"] for r in got if r["doc_id"] % 2) >= 0.9 * sum(r["doc_id"] % 2 for r in got)
    assert sum(r["predicted"] for r in got if r["doc_id"] % 2 == 0) <= 0.01 * len(got)


def tox_index(texts, label, made=toxicity.build):
    held = [tox_terms(t) for t in texts]
    n = {y: label.count(y) for y in (0, 1)}
    vocabulary = sorted({t for x in held for t in x})
    df = [np.array([sum(t in x for x, v in zip(held, label, strict=True) if v == y) for t in vocabulary], float) for y in (0, 1)]
    words = toxicity.Terms(vocabulary, toxicity.term_weights(*df, n), 0.1)
    return made(words, [words.vector(t) for t in texts], label, list(range(len(texts))), n)


def test_block_max_is_exact(monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    share = np.arange(1, 201) ** -1.0
    draw = lambda k: " ".join(rng.choice(words, k, p=share / share.sum()))
    index = tox_index([draw(12) for _ in range(700)], [int(x) for x in rng.random(700) < 0.4])
    full = np.zeros((700, len(index.words.vocabulary)))
    for i, (a, b) in enumerate(zip(index.start[:-1], index.start[1:], strict=True)):
        full[i, index.at[a:b]] = index.w[a:b]
    for first, finish in ((32, 128), (1, 16), (4, 700)):  # however the work is cut
        monkeypatch.setattr(toxicity, "FIRST", first)
        monkeypatch.setattr(toxicity, "FINISH", finish)
        for _ in range(40):
            at, w = index.words.vector(draw(15))
            place, score = index.nearest(at, w)
            every = full[:, at] @ w
            assert np.allclose(score, np.sort(every)[::-1][:toxicity.NEAREST])
            assert np.allclose(every[place], score)


def test_frequent_terms_are_not_walked(monkeypatch):
    """Postings of terms that many examples hold are added for many texts at
    once, and no text walks through whole examples; the neighbours are exact."""
    rng = np.random.default_rng(4)
    common = [f"c{chr(97 + i)}" for i in range(26)]
    rare = [f"r{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    draw = lambda: " ".join([*rng.choice(common, 20), *rng.choice(rare, 3)])
    index = tox_index([draw() for _ in range(600)], [int(x) for x in rng.random(600) < 0.4])
    full = np.zeros((600, len(index.words.vocabulary)))
    for i, (a, b) in enumerate(zip(index.start[:-1], index.start[1:], strict=True)):
        full[i, index.at[a:b]] = index.w[a:b]
    walked = []
    ranges = toxicity._ranges

    def seen(start, which, value):
        got = ranges(start, which, value)
        walked.append(len(got[0]))
        return got

    monkeypatch.setattr(toxicity, "_ranges", seen)
    texts = [draw() for _ in range(100)] + ["", None, "nowhere"]
    for text, (score, ids, cosines) in zip(texts, index.scores(texts), strict=True):
        at, w = index.words.vector(text)
        every = full[:, at] @ w
        best = np.sort(every)[::-1][:toxicity.NEAREST]
        place = [index.ids.index(i) for i in ids]
        assert 0 <= score <= 1 and np.allclose(cosines, best[best > 0]) and np.allclose(every[place], cosines)
    assert sum(walked) < 100 * 600  # before: more than ten postings per example and text


def test_calibration_looks_past_copies():
    """An example with hundreds of equals still has NEAREST other neighbours."""
    texts = ["ta tb"] * 300 + [f"ta tb t{chr(99 + i)}" for i in range(24)]
    voted = []

    class Seen(toxicity.Index):
        def vote(self, place, score):
            voted.append((len(place), score.max(initial=0)))
            return super().vote(place, score)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(toxicity, "Index", Seen)
        tox_index(texts, [1] * 300 + [i % 2 for i in range(24)])
    assert len(voted) == 25 and all(n == toxicity.NEAREST and s < 1 - 1e-9 for n, s in voted)


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None), (99, 0)], "doc_id long, toxic int")
    assert toxicity.toxicity(odd, labels).count() == len(ODD)
    assert toxicity.toxicity(odd, labels.limit(0)).count() == len(ODD)
    assert toxicity.toxicity(empty, labels).count() == 0


# --- 10 PII -------------------------------------------------------------------------------------

def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_pii_round_trip(spark):
    rows = ["call +1 (743) 555-3824 or +17435553824", "ip 152.143.123.131### 999.1.1.1", "to that.92@mail5.example.com.",
            "card 4785380592391139$$$ 4785 3805 9239 1139 4785380592391138", "on 2024-02-29 and 1999-13-01, 2023-02-29",
            "id 123-45-6789", None, "", "no 1.2.3 12345678901234567890123"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").withColumn("_found", F.lit(1)).drop("_found")
    new = pii.pseudonyms(df, "k")
    got = [r["text"] for r in new.orderBy("doc_id").collect()]
    shape = lambda t: t and re.sub(r"[a-z]", "a", re.sub(r"\d", "9", t))
    assert [r is None for r in got] == [r is None for r in rows]
    for a, b in zip(rows, got, strict=True):
        if a and "ip" not in a:
            assert shape(a) == shape(b)
    assert luhn(re.search(r"\d{16}", got[3]).group()) and got[3].endswith("4785380592391138")
    assert re.sub(r"\D", "", got[3][5:21]) == re.sub(r"\D", "", got[3][25:44])  # linked across spellings
    assert "1999-13-01, 2023-02-29" in got[4] and "2024-02-29" not in got[4]
    assert rows[7:] == got[7:] and "999.1.1.1" in got[1] and "152.143" not in got[1]
    back = [r["text"] for r in pii.pseudonyms(new.drop("n_replaced"), "k", undo=True).orderBy("doc_id").collect()]
    assert back == rows
    other = [r["text"] for r in pii.pseudonyms(df, "other key").orderBy("doc_id").collect()]
    assert other[0] != got[0]


def test_pii_card_beside_numbers(spark):
    """A card is found beside short numbers, dates, addresses and after a dash; the way back is exact."""
    card, spaced = "4111111111111111", "4111 1111 1111 1111"
    rows = [f"{spaced} 123", f"{card} 99 euro", f"12 {spaced}", f"5 {card}", f"Visa-{card}", f"1234 5678 {spaced}",
            f"{spaced} 5500 0000 0000 0004 7", f"{card} 2024-02-29", f"{spaced} 152.143.123.131", f"7 3782 822463 10005 1",
            f"{card} 5 a9@b.example.com", "41111 11111 111111 77"]
    rows += [f"{i} {spaced} {i * 7}" for i in range(60)] + [" ".join(str(i * 37 % 1000) for i in range(300))]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    new = pii.pseudonyms(df, "k")
    got = [r["text"] for r in new.orderBy("doc_id").collect()]
    digits = [re.sub(r"\D", "", t) for t in got]
    assert not any(card in d for d in digits[:-1]) and "378282246310005" not in digits[9]
    assert "5500000000000004" not in digits[6] and got[0].endswith(" 123") and got[2].startswith("12 ")
    assert "2024-02-29" not in got[7] and "152.143.123.131" not in got[8] and "a9@" not in got[10]
    assert len({re.sub(r"\D", "", t)[len(str(i)):][:16] for i, t in enumerate(got[12:-1])}) == 1  # one card, one pseudonym
    assert all(re.sub(r"\d", "9", a) == re.sub(r"\d", "9", b) for i, (a, b) in enumerate(zip(rows, got, strict=True)) if i not in (8, 10))
    back = [r["text"] for r in pii.pseudonyms(new.drop("n_replaced"), "k", undo=True).orderBy("doc_id").collect()]
    assert back == rows


def test_feistel_is_a_permutation(spark):
    df = spark.range(6 * 35).select(pii.feistel(F.col("id"), 6, 35, "k", "t").alias("x"), "id")
    df = df.withColumn("y", pii.feistel(F.col("x"), 6, 35, "k", "t", undo=True))
    rows = df.collect()
    assert sorted(r["x"] for r in rows) == list(range(210)) and all(r["y"] == r["id"] for r in rows)


def test_pii_table(spark):
    docs = texts_of(spark, SF_MID)
    got = {r["doc_id"]: r for r in catalog.op10(spark, SF_MID).collect()}
    token = re.compile(r"(?<![\w.+-])[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d)")
    for i, t in docs.items():
        private = token.findall(t)
        assert len(got[i]["text"]) >= len(t) - 20
        assert not private or got[i]["text"] != t
        for p in private:
            assert p not in got[i]["text"]
        if not re.search(r"\d|@", t):
            assert got[i]["text"] == t


def test_pii_odd(spark, odd, empty):
    assert sorted(map(str, pii.pseudonyms(odd, "k").drop("n_replaced").collect())) == sorted(map(str, odd.collect()))
    assert pii.pseudonyms(empty, "k").count() == 0


# --- pipeline ---------------------------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P

    docs = table(spark, SF_MID, "documents")
    cols, seen = docs.columns, []
    for name, stage in P.STAGES:
        stage(spark, docs, SF_MID).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        seen.append((name, docs, out))
        docs = out
    for name, before, after in seen[:-1]:
        assert after.columns == cols, name
    assert [n for n, _, _ in seen] == ["quality_rules", "ngram_join", "decontaminate", "mix_sources", "shard"]
    ids = lambda df: [r[0] for r in df.select("doc_id").collect()]
    # quality: what op3 keeps
    want = {r["doc_id"] for r in catalog.op3(spark, SF_MID).filter("kept").collect()}
    assert set(ids(seen[0][2])) == want
    # near duplicates: brute force on the stage's input
    rows = [(r["doc_id"], r["text"]) for r in seen[1][1].select("doc_id", "text").collect()]
    assert set(ids(seen[1][2])) == {g for g, _ in brute_links(rows)}
    # decontamination
    leaked = {r["doc_id"] for r in catalog.op6(spark, SF_MID).collect()}
    assert set(ids(seen[2][2])) == set(ids(seen[2][1])) - leaked
    # mix: whole rows, at most twice
    n = collections.Counter(ids(seen[3][2]))
    assert max(n.values()) <= 2 and set(n) <= set(ids(seen[3][1]))
    assert seen[4][2].count() == sum(n.values())


def test_clashing_columns(spark, odd):
    """Columns named like the operators' helpers change no row and come back as they were."""
    names = ["size", "_row", "_row2", "copy", "_copy", "_n", "_c", "kept", "quality", "_f1", "_f2", "doc", "_near_key", "_near_f1",
             "_near_f2", "_found", "_between", "_new", "_text", "n", "row", "node", "h", "before", "rank"]
    own = odd.columns
    wide = odd.select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    good = wide.withColumn("text", F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(90)), lambda i: F.concat(
        F.lit("word"), F.col("doc_id").cast("string"), F.lit("x"), i.cast("string"))), " "), F.lit(" 4111 1111 1111 1111")))
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    df = wide.union(good)
    for run in (mix.mixed, quality.keep_good, near.one_of_each, lambda d: decontaminate.clean(d, items),
                lambda d: pii.pseudonyms(d, "k")):
        got = run(df).select(*own, *names).collect()
        assert got and all(r[n] == f"own {n}" for r in got for n in names)
        if run not in (mix.mixed, near.one_of_each):  # one queues by all columns; the other's copies share a row's place
            key = lambda r: [str(r[x]) for x in own]
            assert sorted(map(key, got)) == sorted(map(key, run(df.select(*own)).collect()))


def test_registered():
    import __spark_entry__ as E

    names = E.queries()
    assert all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_oracle(spark, name):
    import duckdb

    from test_oracle import _rows
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    assert _rows(catalog.queries()[name](spark, SF_SMALL).toPandas()) == _rows(con.execute(catalog.oracle_sql()[name]).df())
