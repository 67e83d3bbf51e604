"""Conversation repair against enumeration, a plain dynamic programme and Python on whole tables."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from conftest import SF_MID
from threadlake.llm import repair as R
from threadlake.llm.common import table

LEGAL_END = re.compile(r"(s?(ua)+)?")


def letters(rng, n):
    return "".join(chr(R.FIRST_LETTER + rng.choice([0, 1, 2, 1, 2, 3, 5, 6, 9, 13, rng.randrange(16)])) for _ in range(n))


def plain(seq):
    """Least (cost, audit) by a programme over whole strings."""
    def grow(states):
        for _ in range(3):
            for i, (c, a) in list(states.items()):
                j = R.NEXT[i]
                if j not in states or (c + 2, a + "I") < states[j]:
                    states[j] = c + 2, a + "I"
        return states

    states = {R.NOTHING: (0, "")}
    for letter in seq:
        fault, role = divmod(ord(letter) - R.FIRST_LETTER, 4)
        new = {}
        for i, (c, a) in grow(states).items():
            moves = [(i, 3, "D")]
            if fault < 2:
                moves.append((R.NEXT[i], 2 + fault, "R"))
                if (i, role) in R.KEEPS:
                    moves.append((R.KEEPS[i, role], fault, "K"))
            for j, more, e in moves:
                if j not in new or (c + more, a + e) < new[j]:
                    new[j] = c + more, a + e
        states = new
    return min(v for j, v in grow(states).items() if j in R.ENDS)


def enumerated(seq, most_inserts=3):
    """Least (cost, audit) over all edits with few insertions, by the contract's words."""
    best = None
    rows = [divmod(ord(c) - R.FIRST_LETTER, 4) for c in seq]
    gaps = list(itertools.product(*[["".join(x) for n in range(most_inserts) for x in itertools.product("ua", repeat=n)]] * (len(seq) + 1)))
    options = [([("D", "")] if f >= 2 else [("D", ""), ("K", "sua-"[r]), ("R", "u"), ("R", "a")]) for f, r in rows]
    for edit in itertools.product(*options):
        for gap in gaps:
            out, audit, cost = gap[0], "I" * len(gap[0]), 2 * sum(map(len, gap))
            for (e, c), (f, _), g in zip(edit, rows, gap[1:], strict=True):
                out, audit = out + c + g, audit + e + "I" * len(g)
                cost += {"D": 3, "K": 0, "R": 2}[e] + (e != "D" and f == 1)
            if LEGAL_END.fullmatch(out) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def test_programme_equals_enumeration():
    for n in range(3):
        for seq in itertools.product(map(chr, range(R.FIRST_LETTER, R.FIRST_LETTER + 16)), repeat=n):
            assert plain("".join(seq)) == enumerated("".join(seq)), seq


@pytest.mark.parametrize("n_rules", [0, 3, 60])
def test_grammar_equals_programme(n_rules):
    rng = random.Random(n_rules)
    seqs = [letters(rng, rng.choice([0, 1, 2, 5, 9, 40])) for _ in range(300)] + [letters(rng, 700) * 3]
    rules = []
    symbols = [chr(R.FIRST_LETTER + i) for i in range(16)]
    for i in range(n_rules):  # any rules at all give the same repairs
        rules.append(rng.choice(symbols) + rng.choice(symbols))
        symbols.append(chr(R.FIRST_RULE + i))
    g = R.Grammar(rules)
    for seq, packed in zip(seqs, R.compress(seqs, rules), strict=True):
        assert g.repair(packed) == plain(seq)


def test_ropes_compare_as_strings():
    rng = random.Random(7)
    for _ in range(3000):
        a, b = ("".join(rng.choice("DI") for _ in range(rng.randint(0, 9))) for _ in range(2))
        ropes = []
        for s in (a, b):
            parts = [R.Rope(s[i:i + 2]) for i in range(0, len(s), 2)] or [R.Rope()]
            while len(parts) > 1:
                i = rng.randrange(len(parts) - 1)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            ropes.append(parts[0])
        assert str(ropes[0]) == a and ropes[0].less(ropes[1]) == (a < b)


def expected(rows):
    """The contract in Python: conv_id -> the result's columns."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role = "user" if kind == 4 else role
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            mine += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seq, seen, illegal = "", set(), 0
        for i, (_, role, text) in enumerate(mine):
            last = re.sub(r"[\x20\x09-\x0d]+\Z", "", text)[-1:]
            fault = 2 if not last else 3 if (role, text) in seen else 0 if last in ".!?" else 1
            seen.add((role, text))
            seq += chr(R.FIRST_LETTER + 4 * fault + max(0, "sua".find(role[:1]) if role[:1] and role[:1] in "sua" else 3))
            illegal += i > 0 and mine[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        cost, audit = plain(seq)
        lines = [f"{w or mine[i][1]}:{mine[i][2] if i >= 0 else ''}" for i, w in zip(*R.edits(seq, audit), strict=True)]
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [(ord(c) - R.FIRST_LETTER) // 4 for c in seq]
        out[conv] = (gaps, faults.count(2), faults.count(3), faults.count(1), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(spark, rows, schema="conv_id long, turn long, role string, text string"):
    got = R.digests(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def test_registered_query(spark):
    from threadlake.llm.catalog import queries
    rows = [tuple(r) for r in table(spark, SF_MID, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = queries()["op12_conversation_repair"](spark, SF_MID).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == expected(rows) and len(got) == len({r[0] for r in rows})


def test_odd_rows(spark, monkeypatch):
    rng = random.Random(2)
    roles, texts = ["user", "assistant", "system", "", None, "tool", "usage"], ["Yes.", "no", "", None, " \t\n", "ok! \r\n", "what?\x0b", "é。", "x\ny."]
    rows = [(c, rng.choice([t, t, None, 3]), rng.choice(roles), rng.choice(texts)) for c in [*range(40), None] for t in range(rng.randint(1, 12))]
    rows += [(77, 5, "user", "Same.")] * 6 + [(78, None, "user", None)] + [(79, t, "ua"[t % 2] + "x", "z" * 20000 + ".") for t in range(4)]
    rows += [(80, t, rng.choice(roles[:3]), rng.choice(texts)) for t in range(300)]
    monkeypatch.setattr(R, "BLOCK", 7)
    assert result(spark, rows) == expected(rows)
    assert result(spark, []) == {}
    clash = [(1, 0, "user", "Hi.", "a", 1, 2, True, "s", "r"), (1, 1, "assistant", "Yes.", "a", 1, 2, True, "s", "r")]
    schema = "conv_id long, turn long, role string, text string, tie string, rank long, one long, dropped boolean, seq string, letter string"
    assert result(spark, clash, schema) == expected([r[:4] for r in clash])
