"""Conversation structure repair by a grammar-compressed dynamic programme.

Every row of a conversation becomes one letter: the class of its role's initial
(s, u, a, other) and its fault (none, truncated, blank, duplicate).  The letters
of a conversation are its sequence.

``learn_grammar`` compresses the distinct sequences of all conversations by
Re-Pair: the most frequent pairs of neighbours become rules, round by round.
Counting runs in Spark; a round takes pairs that cannot overlap one another, so
their counts are those of replacing them one after the other.  The grammar has
``RULES`` rules at most; sequences keep the symbols that no rule covers, so its
size changes the work, never a result.

Repair is a shortest path.  States say which roles have been written (nothing,
s, ...u, ...a); each letter has a 4 x 4 matrix of the cheapest edits between
them, insertions before the row included; a rule's matrix is the min-plus
product of its two symbols' matrices, computed once, bottom-up, and shared by
all conversations.  An entry is (cost, audit): the audit is a rope over the
ropes of the symbols, compared by hashes of equal-long parts, so equal costs are
told apart by the least audit without writing the audits out.  (Two audits of
equal cost between the same states never are a prefix of one another: the rest
would be insertions, which cost.  So the least audit of a product is made of
least audits.)  The audit fixes the edits: from each state there is one role to
insert or to rerole to.

Edits: Keep 0; Rerole to user or assistant 2; Delete 3 (the only edit of a blank
or duplicate row); Insert an empty user or assistant row 2; a truncated row that
stays costs 1 more.  The roles' initials in the end match ``(s?(ua)+)?``.

Rows are numbered by range partitions, so a conversation of any length spans
tasks until its repaired text is hashed, which streams.

Defined cases: null role, text, and - in the damage key - conv_id and turn are
one space; a null conv_id is a conversation of its own; rows come by turn (nulls
first), then role and text, so ties and repeated rows have one order and a
repeated row is a duplicate; an empty role has no initial and is none of s, u, a;
texts of any length are only hashed and passed on; an empty table gives no row.
Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import fingerprint, ready, running, stored

#: Letters of a sequence that are gathered at a time.
BLOCK = 1024
#: Rules of the grammar, pairs that a round looks at, and rounds, at most.
RULES, PAIRS, ROUNDS = 2048, 512, 10
#: Results of whole sequences that a worker remembers at most.
MEMO = 50_000

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
ROLES = "sua"           # class 3 is any other initial
OK, TRUNCATED, BLANK, DUPLICATE = range(4)
FIRST_LETTER = ord("A")  # letters: FIRST_LETTER + 4 * fault + class
FIRST_RULE = 0xE000      # symbols of rules: private use
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEPS = {(NOTHING, 0): SYSTEM, (NOTHING, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
NEXT = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ENDS = (NOTHING, ASSISTANT)
LEGAL = {"su", "ua", "au"}
_MOD = (1 << 127) - 1
_BASE = 0x9E3779B97F4A7C15F39CC0605CEDC835


# --- ropes and matrices ----------------------------------------------------------------------

class Rope:
    """A string held as the joint of two others, with its hash."""
    __slots__ = ("size", "hash", "power", "left", "right", "text")

    def __init__(self, text: str = "", left: "Rope | None" = None, right: "Rope | None" = None):
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.size, self.hash, self.power = len(text), 0, 1
            for c in text:
                self.hash = (self.hash * _BASE + ord(c)) % _MOD
                self.power = self.power * _BASE % _MOD
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * right.power + right.hash) % _MOD
            self.power = left.power * right.power % _MOD

    def __add__(self, other: "Rope") -> "Rope":
        return Rope(left=self, right=other) if self.size and other.size else self if self.size else other

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            r = todo.pop()
            if r.left is None:
                out.append(r.text)
            else:
                todo += (r.right, r.left)
        return "".join(out)

    def less(self, other: "Rope") -> bool:
        """Whether this string comes before the other one."""
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a.size == b.size and a.hash == b.hash:
                continue
            if not a.size or not b.size:
                if a.size:
                    mine.append(a)
                if b.size:
                    theirs.append(b)
            elif a.left is not None and (b.left is None or a.size >= b.size):
                mine += (a.right, a.left)
                theirs.append(b)
            elif b.left is not None:
                mine.append(a)
                theirs += (b.right, b.left)
            else:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text[:n] < b.text[:n]
                mine.append(Rope(a.text[n:]))
                theirs.append(Rope(b.text[n:]))
        return any(r.size for r in theirs) and not any(r.size for r in mine)


Matrix = list  # 4 x 4 of (cost, Rope) or None


def _better(new, old) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and new[1].less(old[1]))


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; equal costs are told apart by the audit."""
    out = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for j in range(4):
            best = None
            for k in range(4):
                x, y = a[i][k], b[k][j]
                if x is not None and y is not None and (best is None or x[0] + y[0] <= best[0]):
                    got = x[0] + y[0], x[1] + y[1]
                    if _better(got, best):
                        best = got
            out[i][j] = best
    return out


def _inserts() -> Matrix:
    """No insertion, or as many as lead to another state."""
    out = [[(0, Rope()) if i == j else None for j in range(4)] for i in range(4)]
    for i in range(4):
        state, n = NEXT[i], 1
        while out[i][state] is None:
            out[i][state] = 2 * n, Rope("I" * n)
            state, n = NEXT[state], n + 1
    return out


INSERTS = _inserts()


def letter_matrix(letter: str) -> Matrix:
    """Insertions, then one edit of the row that the letter stands for."""
    fault, role = divmod(ord(letter) - FIRST_LETTER, 4)
    edit: Matrix = [[None] * 4 for _ in range(4)]
    more = 1 if fault == TRUNCATED else 0
    for i in range(4):
        said = [(i, 3, "D")]
        if fault in (OK, TRUNCATED):
            said.append((NEXT[i], 2 + more, "R"))
            if (i, role) in KEEPS:
                said.append((KEEPS[i, role], more, "K"))
        for j, cost, edit_letter in said:
            got = cost, Rope(edit_letter)
            if _better(got, edit[i][j]):
                edit[i][j] = got
    return product(INSERTS, edit)


class Grammar:
    """Rules (symbol -> its two parts, in the order they were made) and the
    matrix of every symbol."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.matrices = {chr(FIRST_LETTER + i): letter_matrix(chr(FIRST_LETTER + i)) for i in range(16)}
        for i, pair in enumerate(rules):  # bottom-up: a rule's parts come before it
            self.matrices[chr(FIRST_RULE + i)] = product(self.matrices[pair[0]], self.matrices[pair[1]])

    def repair(self, compressed: str) -> tuple[int, str]:
        """Cost and audit of a sequence; products are paired up, so ropes stay
        flat."""
        level = [self.matrices[c] for c in compressed]
        while len(level) > 1:
            level = [product(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        whole = product(level[0], INSERTS) if level else INSERTS
        best = None
        for j in ENDS:
            if whole[NOTHING][j] is not None and _better(whole[NOTHING][j], best):
                best = whole[NOTHING][j]
        return best[0], str(best[1])


def compress(sequences: list[str], rules: list[str], first: int = 0) -> list[str]:
    """Replace the pairs of the rules, oldest first, from the left."""
    text = "\n".join(sequences)
    for i in range(first, len(rules)):
        text = text.replace(rules[i], chr(FIRST_RULE + i))
    return text.split("\n") if sequences else []


def edits(sequence: str, audit: str) -> tuple[list[int], list[str | None]]:
    """The rows that stay: number in the conversation (-1: inserted) and the
    role they get (None: their own)."""
    state, row, numbers, roles = NOTHING, 0, [], []
    for e in audit:
        if e != "D":
            new = KEEPS[state, (ord(sequence[row]) - FIRST_LETTER) % 4] if e == "K" else NEXT[state]
            numbers.append(-1 if e == "I" else row)
            roles.append(None if e == "K" else "user" if new == USER else "assistant")
            state = new
        row += e != "I"
    return numbers, roles


# --- Spark -----------------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage: conv_id, turn, role, text and ``dropped``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    x = conversations.select("conv_id", "turn", kind.alias("k"), space("role").alias("role"), space("text").alias("text"))
    text = F.when(F.col("k") == 1, F.lit("")).when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("k") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("k") == 3, 2).otherwise(1))
    return x.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("k") == 0).alias("dropped"),
                    F.explode(times).alias("_")).drop("_")


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows plus rank (0-based in the conversation, by turn, role and text,
    equal rows in any order), written once; and (conv_id, rank, letter)."""
    rows = turns.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("tie"), F.lit(1).alias("one"))
    ranked = stored(running(rows, ["turn", "role", "text", "tie"], "one", ["conv_id"], "repair-order")
                    .drop("before", "one", "tie"), "repair-rows")
    f1, f2 = fingerprint(F.col("text"))
    keyed = ranked.withColumns({"_f1": f1, "_f2": f2})
    first = keyed.groupBy("conv_id", "role", "_f1", "_f2").agg(F.min("rank").alias("_rank")).select(
        F.col("conv_id").alias("_conv"), "_rank", F.lit(True).alias("_first"))
    marked = ranked.select("conv_id", "rank", "role", _last_letter().alias("last")).join(
        first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("rank") == F.col("_rank")), "left")
    fault = (F.when(F.col("last") == "", BLANK).when(F.col("_first").isNull(), DUPLICATE)
             .when(~F.col("last").isin(".", "!", "?"), TRUNCATED).otherwise(OK))
    initial = F.substring("role", 1, 1)
    role = F.lit(3)
    for i, c in enumerate(ROLES):
        role = F.when(initial == c, F.lit(i)).otherwise(role)
    letter = F.char(F.lit(FIRST_LETTER) + 4 * fault + role)
    return ranked, marked.select("conv_id", "rank", letter.alias("letter"))


def _last_letter():
    """Last character of the text that is no blank, or the empty string."""
    return F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))


def sequences(letters: DataFrame) -> DataFrame:
    """conv_id, seq: joined block by block, then over the blocks."""
    x = letters.groupBy("conv_id", F.floor(F.col("rank") / BLOCK).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "letter"))), lambda s: s["letter"]), "").alias("part"))
    return x.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "part"))), lambda s: s["part"]), "").alias("seq"))


def _pairs(rules: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for s in compress(b.column(0).to_pylist(), rules):
                last = None
                for i in range(len(s) - 1):
                    pair = s[i:i + 2]
                    # in a run of one symbol every other pair counts
                    if pair[0] == pair[1] and last == i - 1:
                        continue
                    last = i if pair[0] == pair[1] else None
                    total[pair] += 1
        yield pa.RecordBatch.from_pydict({"pair": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})
    return run


def learn_grammar(seqs: DataFrame) -> Grammar:
    """Re-Pair over the distinct sequences."""
    distinct = stored(seqs.select("seq").distinct(), "repair-sequences")
    rules: list[str] = []
    for _ in range(ROUNDS):
        counts = (distinct.mapInArrow(_pairs(list(rules)), "pair string, n long").groupBy("pair")
                  .agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "pair").limit(PAIRS).collect())
        left, right, new = set(), set(), []
        for r in counts:
            a, b = r["pair"]
            if a in right or b in left or (a == b and (a in left or a in right)) or len(rules) + len(new) == RULES:
                continue
            left.add(a)
            right.add(b)
            new.append(r["pair"])
        rules += new
        if not new or len(rules) == RULES:
            break
    return Grammar(rules)


AUDIT = {"cost": pa.int64(), "audit": pa.string(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(),
         "illegal": pa.int64(), "numbers": pa.list_(pa.int64()), "roles": pa.list_(pa.string())}


def audits(seqs: DataFrame, grammar: Grammar) -> DataFrame:
    """conv_id, seq to the cheapest edits of each conversation and what was
    found in it."""
    rules = grammar.rules

    def of(seq: str, packed: str, mine: Grammar) -> tuple:
        cost, audit = mine.repair(packed)
        codes = [divmod(ord(c) - FIRST_LETTER, 4) for c in seq]
        faults = Counter(f for f, _ in codes)
        initials = "".join((ROLES + "-")[r] for _, r in codes)
        illegal = sum(initials[i:i + 2] not in LEGAL for i in range(len(seq) - 1))
        return cost, audit, faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal, *edits(seq, audit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, known = Grammar(rules), {}
        for b in batches:
            said = b.column(1).to_pylist()
            new = list(set(said) - known.keys())
            if len(known) + len(new) > MEMO:
                known.clear()
                new = list(set(said))
            known |= {seq: of(seq, packed, mine) for seq, packed in zip(new, compress(new, rules), strict=True)}
            got = [known[s] for s in said]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([g[i] for g in got], t) for i, t in enumerate(AUDIT.values()))], ["conv_id", *AUDIT])

    kind = seqs.schema["conv_id"].dataType.simpleString()
    return seqs.select("conv_id", "seq").mapInArrow(
        run, f"conv_id {kind}, cost long, audit string, blank long, duplicate long, truncated long, illegal long, "
             "numbers array<long>, roles array<string>")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """turns(conv_id, turn, role, text) to (audits, rows): the audit of each
    conversation, and its repaired rows (conv_id, pos, role, text, inserted)."""
    ready(turns.sparkSession)
    ranked, letters = numbered(turns)
    seqs = stored(sequences(letters), "repair-conversations")
    found = stored(audits(seqs, learn_grammar(seqs)), "repair-audits")
    kept = found.select(F.col("conv_id").alias("_conv"), F.posexplode(F.arrays_zip("numbers", "roles")).alias("pos", "e")).select(
        "_conv", "pos", F.col("e.roles").alias("_role"),
        # an inserted row meets no row; numbers of its own keep them apart in the join
        F.when(F.col("e.numbers") < 0, -1 - F.col("pos")).otherwise(F.col("e.numbers")).alias("_rank"))
    own = ranked.select("conv_id", "rank", "role", "text")
    rows = kept.join(own, F.col("_conv").eqNullSafe(F.col("conv_id")) & (F.col("_rank") == F.col("rank")), "left")
    return found.drop("numbers", "roles"), rows.select(
        F.col("_conv").alias("conv_id"), "pos", F.coalesce("_role", "role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), (F.col("_rank") < 0).alias("inserted"))


def text_hashes(rows: DataFrame) -> DataFrame:
    """conv_id, sha256 of its ``role:text`` lines: rows stream by, sorted, and
    only the state of one hash is kept."""
    x = rows.select("conv_id", "pos", F.concat("role", F.lit(":"), "text").alias("line"))
    x = x.repartition("conv_id").sortWithinPartitions("conv_id", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        kind = None
        for b in batches:
            kind, out = b.column(0).type, []
            for c, line in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if digest is None or c != now:
                    if digest is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = c, hashlib.sha256(line.encode())
                else:
                    digest.update(b"\n" + line.encode())
            yield _hashed(out, kind)
        if digest is not None:
            yield _hashed([(now, digest.hexdigest())], kind)

    return x.mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, sha string")


def _hashed(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], kind), pa.array([h for _, h in out], pa.string())],
                                      ["conv_id", "sha"])


def digests(conversations: DataFrame) -> DataFrame:
    """The contract's columns for every conv_id, after ``damage`` and ``repair``."""
    damaged = damage(conversations)
    left = F.when(~F.col("dropped"), F.col("turn"))
    convs = damaged.groupBy("conv_id").agg(
        F.coalesce(F.max(left) - F.min(left) + 1 - F.count_distinct(left), F.lit(0)).cast("long").alias("gaps"))
    found, rows = repair(damaged.filter(~F.col("dropped")))
    by = lambda df, n: df.withColumnRenamed("conv_id", n)
    x = convs.join(by(found, "_a"), F.col("conv_id").eqNullSafe(F.col("_a")), "left")
    x = x.join(by(text_hashes(rows), "_h"), F.col("conv_id").eqNullSafe(F.col("_h")), "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return x.select("conv_id", "gaps", *map(number, ("blank", "duplicate", "truncated", "illegal", "cost")),
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
