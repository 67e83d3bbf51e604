"""BPE lexicon against the tokenizers library and against plain dictionaries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from threadlake.llm import lexicon as L
from threadlake.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def coded(spark, texts, lexicon):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = L.decode(L.encode(df, PATH, lexicon), PATH).collect()
    return {r["doc_id"]: (np.frombuffer(r["ids"], "<u4").tolist(), r["text"]) for r in rows}


def test_transducer_is_a_dictionary_with_shared_ends(tmp_path):
    rng = random.Random(5)
    entries = {}
    for _ in range(3000):
        stem, end = "".join(rng.choice("abcé") for _ in range(rng.randint(0, 5))), rng.choice(["ing", "ation", "s", ""])
        if stem + end:
            entries[(stem + end).encode()] = tuple(ord(c) for c in stem) + ((1000 + len(end),) if end else ())
    arrays = L.compile_transducer(sorted(entries.items()))
    (tmp_path / "t").write_bytes(L.to_bytes(arrays))
    t = L.Transducer(str(tmp_path / "t"))
    words = [*entries, b"zz", b"a" * 70, b"abcab" * 3]
    for w, got in zip(words, t.look_up(words), strict=True):
        want = entries.get(w)
        assert (None if want is None else np.array(want, "<u4").tobytes()) == got
    trie = {w[:i] for w in entries for i in range(len(w) + 1)}
    assert len(arrays["final"]) < len(trie) / 4  # beginnings and endings are shared
    empty = L.compile_transducer([])
    (tmp_path / "e").write_bytes(L.to_bytes(empty))
    assert L.Transducer(str(tmp_path / "e")).look_up([b"a"]) == [None]


def test_merging_together_equals_merging_one_by_one():
    rng, v = random.Random(1), L.Vocabulary(PATH)
    letters = "etaoinshr" * 3 + "é!=漢"
    words = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 5, 9, 16, 40]))).encode() for _ in range(4000)] + [b"a" * 24, b"=" * 23]
    assert v.merge_all(words) == [np.array(v.merge(w), "<u4").tobytes() for w in words]
    assert v.merge_all([]) == []


def test_registered_query_equals_library(spark):
    from threadlake.llm.catalog import queries
    rows = {r["doc_id"]: r for r in queries()["op11_bpe_lexicon"](spark, SF_SMALL).collect()}
    docs = table(spark, SF_SMALL, "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids, text = expected(d["text"])
        r = rows[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


ODD = ["", None, " \n\t ", "I'LL can't 'sun 'S ''re", "<|endoftext|>", "a<|endoftext|><|startoftext|>B <|END|>", "ΣΑΣ Σ ΣΣ.",
       "İi ǅ ẞ ß ŉ", "é ́x ạ̇ 각", "\x1c\x1d\x85\xa0　x", "１２ ½ ²³ Ⅷ ٣",
       "=" * 5000, "ab" * 4000, "x" * 70 + " " + "x" * 70, "你好 \U0001f469‍\U0001f4bb", "\0a\0", "_a_1_", "don't" * 50]


@pytest.mark.parametrize("most", [0, 20, L.LEXICON])
def test_odd_texts_with_any_lexicon(spark, most):
    docs = spark.createDataFrame([(t,) for t in ODD * 3], "text string")
    name = L.build_lexicon(docs, PATH, most) if most else None
    got = coded(spark, ODD, name)
    for i, t in enumerate(ODD):
        assert got[i] == expected(t), t


def test_every_code_point(spark):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}1 {c}" for c in points[i:i + 2000]) for i in range(0, len(points), 2000)]
    got = coded(spark, texts, None)
    for i, t in enumerate(texts):
        assert got[i] == expected(t), hex(i * 2000)


def test_odd_rows_and_tables(spark):
    df = spark.createDataFrame([(None, "a", "x"), (1, "b", "y"), (1, "b", "y")], "doc_id long, text string, ids string")
    out = L.decode(L.encode(df, PATH), PATH)
    assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == [("1", "b</w>"), ("1", "b</w>"), ("None", "a</w>")]
    none = df.limit(0)
    assert L.digests(L.decode(L.encode(none, PATH, L.build_lexicon(none, PATH)), PATH)).count() == 0
    bad = df.select("doc_id", F.expr("cast(X'61FF62' as string)").alias("text"))
    assert {r["text"] for r in L.decode(L.encode(bad, PATH), PATH).collect()} == {expected("a�b")[1]}
