r"""Byte-pair encoding and decoding with a minimal acyclic transducer lexicon.

``build_lexicon`` counts the words of every text with Spark, takes the
frequent ones (at most ``LEXICON``; the cut is a count, found on a histogram of
fixed size), merges each once and compiles them into a minimal acyclic
transducer: arcs carry bytes of the word and ids of its encoding, states with
equal continuations are shared, so words share beginnings and endings.  The
flat arrays are written once to the shared folder; every task maps the file
into memory and walks it for all new words of a batch at once.  A word that it
does not hold is merged exactly, by the ranks of the vocabulary file.  The
lexicon is only a store of results: its size changes the speed, never an id.

``encode`` gives the ids of the tokenizers library for the file (without added
special tokens; ``<|endoftext|>`` and the like inside a text are their own ids,
as there); ``decode`` gives its decoding with special tokens kept.

Words.  White space parts the text; special tokens part it further.  Each part
is composed (NFC), lower-cased and cut into words by the file's pattern.  For
the code points below U+0250 that is done here; parts with others go through the
library's own normaliser and word splitter, whose tables they depend on.

Defined cases: a null or empty text has no ids and decodes to the empty text;
bytes that are not UTF-8 count as U+FFFD; texts and words of any length are
taken whole (a word of n bytes costs n log n); rows are encoded one by one, so
ties, repeated rows and null or repeated doc_ids stay as they are; an empty
table gives no row.  Columns other than doc_id and text are not read, whatever
their names.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadlake.llm.common import ready, stored
from threadlake.session import ensure_checkpoint_dir

#: Words that the lexicon holds at most; what bounds its file and the driver's work.
LEXICON = 1 << 17
#: Steps of a doubling in the histogram of word counts.
STEPS = 8
#: Words that a Python worker remembers at most (then it forgets them all).
MEMO = 300_000
#: Bytes that are split into words at a time within a task (one row at least).
PIECE = 1 << 20

#: White space of the Unicode standard, as the vocabulary file's pattern has it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PART = re.compile(f"[^{SPACE}]+").findall
PLAIN = re.compile("[\0-ɏ]*").fullmatch
END = "</w>"
#: Words of so many bytes at most are merged together, longer ones one by one.
SHORT = 24
NEVER = 1 << 20  # above every rank


def _plain_words():
    """The file's word pattern for lower-case text below U+0250, with its classes
    written out; the parts of the alternation that begin differently stand in
    order of frequency."""
    points = sorted({x for c in range(0x250) for x in chr(c).lower()})  # some lie above
    letters, digits = ("".join(re.escape(c) for c in points if regex.match(p, c)) for p in (r"\p{L}", r"\p{N}"))
    return re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{digits}]|[^{letters}{digits}{SPACE}]+").findall


PLAIN_WORDS = _plain_words()


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


# --- transducer ------------------------------------------------------------------------------

class _State:
    __slots__ = ("arcs", "final", "number")

    def __init__(self):
        self.arcs: dict[int, list] = {}   # byte -> [target, ids]
        self.final: tuple | None = None   # ids put out when a word ends here
        self.number = -1


def _common(a: tuple, b: tuple) -> int:
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return n


def compile_transducer(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """Sorted, distinct (word, ids) to the arrays of a minimal transducer.

    Words come in order, so all states but those of the last word's path are
    final in shape: they are replaced by an equal registered state, from the
    end.  Ids move towards the start as far as the words through an arc agree.
    """
    register: dict[tuple, _State] = {}
    kept: list[_State] = []

    def settle(state: _State) -> _State:
        key = (state.final, tuple((b, id(t), out) for b, (t, out) in state.arcs.items()))
        got = register.get(key)
        if got is None:
            register[key] = got = state
            state.number = len(kept)
            kept.append(state)
        return got

    path, last = [_State()], b""
    for word, ids in entries:
        shared = 0
        while shared < len(word) and shared < len(last) and word[shared] == last[shared]:
            shared += 1
        for i in range(len(last), shared, -1):
            path[i - 1].arcs[last[i - 1]][0] = settle(path[i])
        del path[shared + 1:]
        for i in range(shared):
            arc = path[i].arcs[word[i]]
            n = _common(arc[1], ids)
            rest, arc[1], ids = arc[1][n:], arc[1][:n], ids[n:]
            if rest:
                below = path[i + 1]
                for a in below.arcs.values():
                    a[1] = rest + a[1]
                if below.final is not None:
                    below.final = rest + below.final
        for i in range(shared, len(word)):
            path.append(_State())
            path[i].arcs[word[i]] = [path[i + 1], ids if i == shared else ()]
        path[-1].final = ids if len(word) == shared else ()
        last = word
    for i in range(len(last), 0, -1):
        path[i - 1].arcs[last[i - 1]][0] = settle(path[i])
    start = settle(path[0])

    pool: dict[tuple, int] = {(): 0}
    flat: list[int] = []

    def place(ids: tuple) -> int:
        if ids not in pool:
            pool[ids] = len(flat)
            flat.extend(ids)
        return pool[ids]

    key, to, at, size, final, final_at = [], [], [], [], [], []
    for s in kept:
        for b in sorted(s.arcs):
            t, out = s.arcs[b]
            key.append(s.number << 8 | b)
            to.append(t.number)
            at.append(place(out))
            size.append(len(out))
        final.append(-1 if s.final is None else len(s.final))
        final_at.append(place(s.final or ()))
    return {"start": np.array([start.number], np.int64), "key": np.array(key, np.int64), "to": np.array(to, np.int64),
            "at": np.array(at, np.int64), "size": np.array(size, np.int64), "final": np.array(final, np.int64),
            "final_at": np.array(final_at, np.int64), "ids": np.array(flat, np.int64)}


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    head = json.dumps([[k, len(a)] for k, a in arrays.items()]).encode()
    head += b" " * (-(len(head) + 8) % 8)
    return len(head).to_bytes(8, "little") + head + b"".join(a.astype("<i8").tobytes() for a in arrays.values())


class Transducer:
    """A compiled lexicon file, mapped into memory."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n = int.from_bytes(raw[:8].tobytes(), "little")
        body, at = raw[8 + n:].view("<i8"), 0
        for name, size in json.loads(raw[8:8 + n].tobytes()):
            setattr(self, name, body[at:at + size])
            at += size

    def look_up(self, words: list[bytes]) -> list[bytes | None]:
        """Ids (little-endian, 32 bits each) of each word, None where unknown."""
        if not words or not len(self.key):
            return [None] * len(words)
        size = np.array([len(w) for w in words])
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        text = np.frombuffer(b"".join(words), np.uint8)
        state = np.full(len(words), self.start[0])
        live, outs = np.arange(len(words)), []
        done = []
        for i in range(int(size.max(initial=0)) + 1):
            ends = size[live] == i
            done.append(live[ends])
            live = live[~ends]
            if not len(live):
                break
            want = state[live] << 8 | text[first[live] + i]
            arc = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            ok = self.key[arc] == want
            live, arc = live[ok], arc[ok]
            state[live] = self.to[arc]
            said = self.size[arc] > 0
            outs.append((live[said], self.at[arc[said]], self.size[arc[said]]))
        ended = np.concatenate(done)
        ended = ended[self.final[state[ended]] >= 0]
        found = np.zeros(len(words), bool)
        found[ended] = True
        outs.append((ended, self.final_at[state[ended]], self.final[state[ended]]))
        who, at, n = (np.concatenate(x) for x in zip(*outs, strict=True))
        order = np.argsort(who, kind="stable")
        who, at, n = who[order], at[order], n[order]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ids = self.ids[np.repeat(at, n) + step].astype("<u4")
        stop = np.cumsum(np.bincount(who, n, len(words)).astype(np.int64)) * 4
        data, out, begin = ids.tobytes(), [], 0
        for end, known in zip(stop.tolist(), found.tolist(), strict=True):
            out.append(data[begin:end] if known else None)
            begin = end
        return out


# --- vocabulary ------------------------------------------------------------------------------

class Tokens:
    """Ids and special tokens of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.ids: dict[str, int] = self.spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        known = self.ids | self.special
        self.strings = [""] * (1 + max(known.values()))
        for s, i in known.items():
            self.strings[i] = s


class Vocabulary(Tokens):
    """The same with merge ranks and the library's own normaliser."""

    def __init__(self, path: str):
        super().__init__(path)
        self.ranks = {tuple(m): i for i, m in enumerate(self.spec["model"]["merges"])}
        merged = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in self.spec["model"]["merges"]]
        self.spec = None
        order = sorted(range(len(merged)), key=lambda r: merged[r][:2])
        self.pair = np.array([merged[r][0] << 20 | merged[r][1] for r in order], np.int64)
        self.rank = np.array(order, np.int64)
        self.joined = np.array([m[2] for m in merged], np.int64)
        self.letters = byte_letters()
        self.bytes = {c: b for b, c in self.letters.items()}
        self.inner, self.last = (np.array([self.ids[self.letters[b] + e] for b in range(256)], np.int64) for e in ("", END))
        self.path = path
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")" if self.special else "(?!)").split

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def words(self, parts: list[str]) -> list[list[str]]:
        """Composed, lower-case words of each part (no white space, no special
        token inside)."""
        other = [p for p in parts if not PLAIN(p)]
        said = {}
        if other:
            normal = self.library.normalizer.normalize_str(" ".join(other)).split(" ")
            split = self.library.pre_tokenizer.pre_tokenize_str
            back = self.bytes
            said = {p: [bytes([back[c] for c in w]).decode() for w, _ in split(n)] for p, n in zip(other, normal, strict=True)}
        return [said[p] if p in said else PLAIN_WORDS(p.lower()) for p in parts]

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word: its bytes, joined pair by pair in the order of the
        ranks (equal ranks from the left)."""
        part = [self.letters[b] for b in word]
        part[-1] += END
        n = len(part)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        ranks = self.ranks
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := ranks.get((part[i], part[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if part[i] != a or j < 0 or part[j] != b:
                continue  # one of the two has been joined since
            part[i], part[j] = a + b, ""
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (r := ranks.get((part[i], part[k]))) is not None:
                    heapq.heappush(heap, (r, i, part[i], part[k]))
            if (h := left[i]) >= 0 and (r := ranks.get((part[h], part[i]))) is not None:
                heapq.heappush(heap, (r, h, part[h], part[i]))
        return tuple(self.ids[p] for p in part if p)

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words (little-endian, 32 bits each): in each step every
        word joins its pair of least rank, the leftmost of equals."""
        out: list[bytes | None] = [None] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= SHORT]
        for i in set(range(len(words))).difference(short):
            out[i] = np.array(self.merge(words[i]), "<u4").tobytes()
        if not short:
            return out
        size = np.array([len(words[i]) for i in short])
        text = np.frombuffer(b"".join([words[i] for i in short]), np.uint8)
        end = np.cumsum(size) - 1
        token = self.inner[text]
        token[end] = self.last[text[end]]
        word = np.repeat(np.arange(len(short)), size)

        def ranks(at: np.ndarray) -> np.ndarray:
            """Rank of the pair that begins at each place."""
            after = np.minimum(at + 1, len(token) - 1)
            want = token[at] << 20 | token[after]
            found = np.minimum(np.searchsorted(self.pair, want), len(self.pair) - 1)
            ok = (self.pair[found] == want) & (word[at] == word[after]) & (after > at)
            return np.where(ok, self.rank[found], NEVER)

        rank = ranks(np.arange(len(token)))
        while True:
            n = len(token)
            least = np.minimum.reduceat(rank * n + np.arange(n), np.cumsum(size) - size)
            live = least < NEVER * n
            if not live.any():
                break
            at = least[live] % n
            token[at] = self.joined[rank[at]]
            stay = np.ones(n, bool)
            stay[at + 1] = False
            token, word, rank = token[stay], word[stay], rank[stay]
            size[live] -= 1
            at -= np.arange(len(at))  # one place went in each earlier word
            rank[at] = ranks(at)
            before = at[at > 0] - 1
            rank[before] = ranks(before)
        data, stop, begin = token.astype("<u4").tobytes(), (np.cumsum(size) * 4).tolist(), 0
        for i, end in zip(short, stop, strict=True):
            out[i], begin = data[begin:end], end
        return out


class Encoder:
    """Encodes texts with a lexicon; one in each Python worker."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Transducer | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.known: dict[str, bytes] = {}
        self.special = {s: i.to_bytes(4, "little") for s, i in vocabulary.special.items()}

    def words(self, text: str) -> list[str]:
        """Words of a text; a special token is a word with a space before it."""
        if PLAIN(text) and not any(s in text for s in self.special):
            return PLAIN_WORDS(text.lower())
        out = []
        for piece in self.vocabulary.cut(text):
            if piece in self.special:
                out.append(" " + piece)
            elif PLAIN(piece):
                out += PLAIN_WORDS(piece.lower())
            else:
                parts = PART(piece)
                said = dict(zip(new := list(set(parts)), self.vocabulary.words(new), strict=True))
                for p in parts:
                    out += said[p]
        return out

    def learn(self, words: list[str]) -> None:
        """Remember the ids of these words."""
        raw = [w.encode() for w in words]
        ids = self.lexicon.look_up(raw) if self.lexicon else [None] * len(raw)
        self.known.update(zip(words, ids, strict=True))
        rare = [i for i, got in enumerate(ids) if got is None and words[i][0] != " "]
        merged = self.vocabulary.merge_all([raw[i] for i in rare])
        self.known.update(zip([words[i] for i in rare], merged, strict=True))
        self.known.update((w, self.special[w[1:]]) for w in words if w[0] == " ")

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.words(t) for t in texts]
        seen = set().union(*split)
        if new := [w for w in seen if w not in self.known]:
            if len(self.known) + len(new) > MEMO:
                self.known.clear()
                new = list(seen)
            self.learn(new)
        get = self.known.__getitem__
        out = [b"".join(map(get, s)) for s in split]
        for w in [w for w in new if len(w) > 64]:
            del self.known[w]
        return out


_OPEN: dict[tuple, object] = {}


def _opened(kind, path: str):
    """One object of a vocabulary file per worker."""
    if (kind, path) not in _OPEN:
        _OPEN[kind, path] = kind(path)
    return _OPEN[kind, path]


def _encoder(path: str, lexicon: str | None) -> Encoder:
    if (Encoder, path, lexicon) not in _OPEN:
        for old in [k for k in _OPEN if k[0] is Encoder]:
            del _OPEN[old]  # a worker that is used again keeps one lexicon
        _OPEN[Encoder, path, lexicon] = Encoder(
            _opened(Vocabulary, path), Transducer(SparkFiles.get(lexicon)) if lexicon else None)
    return _OPEN[Encoder, path, lexicon]


# --- Spark -----------------------------------------------------------------------------------

def frequent_words(docs: DataFrame, most: int = LEXICON) -> list[str]:
    """The most frequent runs of letters in all texts, ``most`` at most, by a
    count that all of them reach.  Counting and the cut run in Spark; the driver
    gets a histogram of fixed size and the words themselves."""
    word = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"))
    counts = docs.select(word.alias("w")).filter("w != ''").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    step = F.floor(F.log2(F.col("n")) * STEPS).cast("int")
    counts = stored(counts.filter("n > 1").withColumn("step", step), "lexicon-words")
    room, cut = most, None
    for r in sorted(counts.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        if r["count"] > room:
            break
        room, cut = room - r["count"], r["step"]
    return [] if cut is None else [r["w"] for r in counts.filter(F.col("step") >= cut).select("w").collect()]


def build_lexicon(docs: DataFrame, path: str, most: int = LEXICON) -> str:
    """Compile the lexicon of ``docs`` and hand it to all executors; returns the
    name under which tasks find the file."""
    spark = docs.sparkSession
    vocabulary = _opened(Vocabulary, path)
    words = {w[0] for w in vocabulary.words(frequent_words(docs, most)) if len(w) == 1}
    raw = sorted(w.encode() for w in words)
    ids = [tuple(np.frombuffer(x, "<u4").tolist()) for x in vocabulary.merge_all(raw)]
    data = to_bytes(compile_transducer(zip(raw, ids, strict=True)))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}")
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place)
    try:
        out.write(data)
    finally:
        out.close()
    spark.sparkContext.addFile(place.toString())
    return name


def _slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` bytes of a column, a row at least."""
    bytes_of = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(bytes_of) // size
    at = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(at, at[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def encode(docs: DataFrame, path: str, lexicon: str | None = None) -> DataFrame:
    """docs(doc_id, text) to doc_id, ids (little-endian, 32 bits each), one row
    per row."""
    ready(docs.sparkSession)
    x = docs.select("doc_id", F.make_valid_utf8(F.coalesce("text", F.lit(""))).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(path, lexicon)
        for batch in batches:
            for b in _slices(batch, 1, PIECE):
                ids = pa.array(coder.encode(b.column(1).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), ids], ["doc_id", "ids"])

    return x.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded(doc_id, ids) to doc_id, ids, text: the tokens of the ids, parted
    by a space, as the file names no decoder."""
    ready(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        say = _opened(Tokens, path).strings.__getitem__
        for batch in batches:
            for b in _slices(batch, 1, PIECE):
                text = [" ".join(map(say, np.frombuffer(x or b"", "<u4").tolist())) for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())],
                                                 ["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and SHA-256 of ids and decoded texts."""
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))
