r"""PII pseudonyms by format-preserving Feistel permutation, DataFrame functions only.

Numbers and dates that pass their validation are replaced by another valid
value of the same format.  Each kind is a keyed permutation of its own domain,
so equal values get equal pseudonyms in every document, different values get
different ones, and the key holder can go back (``undo=True``).

========  ==========================================  =======================
kind      validated                                   domain
========  ==========================================  =======================
card      13 to 19 digits, Luhn, optional gaps, also  digits before the check
          beside other numbers                        digit; it is made anew
phone     +1 and ten digits, with or without marks    10^10, after the +1
ip        four numbers of 0 to 255                    2^32
date      year-month-day, a real day of 1900 to 2099  73,000 days
id        ddd-dd-dddd                                 10^9
email     local part of letters and digits            letters and digits,
                                                      each in its own class
========  ==========================================  =======================

Feistel: a number below p*q is split into (L, R) by division; in every round
one half is moved by a keyed hash of the other, modulo its own size.  That is a
permutation for any p and q, without cycle walking.  Emails use the same two
halves on arrays of character codes, moved inside a-z, A-Z and 0-9.

Cards are looked for in whole runs of digit groups with single spaces or dashes
between them: every row of whole groups with 13 to 19 digits that passes Luhn is
a reading.  Readings of a card's usual layout (one group, 4-4-4-4, 4-6-5, 4-6-4)
go first, then from left to right, longer before shorter; readings that overlap
a taken one are left.  A pseudonym that would make a reading valid that goes
first is permuted again (at most ``WALK`` times), so the way back takes the same
readings.  Only there a number's pseudonym depends on its neighbours.

Texts are taken apart by one regular expression into what is between matches
and the matches; only texts with a match are touched.

Defined cases: null stays null, empty stays empty; what matches but fails its
validation stays as it is; columns of other names are not read and stay, but for an
``n_replaced``, which is replaced; repeated rows give equal results; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import packed

ROUNDS = 8
WALK = 512
FIRST_DAY, DAYS = "1900-01-01", 73000  # 365 * 200, so up to 2099-11-13

EMAIL = r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
PHONE = r"(?<![\w.])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)"
DATE = r"(?<![\d-])(?:19|20)\d{2}-\d{2}-\d{2}(?![\d]|-\d)"
ID = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d]|-\d)"
_SEP = rf"[ -](?!{EMAIL}|{IP}|{DATE}|{ID})"  # what another kind begins with ends the run
CARD = rf"(?<!\d)(?<!\d\.)(?=\d(?:(?:{_SEP})?\d){{12}})\d++(?:{_SEP}\d++)*+"
#: In this order at one place: the more particular first.
KINDS = {"email": EMAIL, "phone": PHONE, "ip": IP, "date": DATE, "id": ID, "card": CARD}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())


def _hash(key: str, tag: str, turn: Column, half: Column) -> Column:
    """Keyed hash of one half, 0 <= h < 2^52."""
    mixed = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), turn.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(mixed, 1, 13), 16, 10).cast("long")


def feistel(x: Column, p: Column | int, q: Column | int, key: str, tag: str, undo: bool = False) -> Column:
    """Keyed permutation of 0 .. p*q-1 (bigint): the halves take turns."""
    p = F.lit(p).cast("long") if isinstance(p, int) else p.cast("long")
    q = F.lit(q).cast("long") if isinstance(q, int) else q.cast("long")
    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if undo else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    sign = -1 if undo else 1

    def step(s, turn):
        left, right = s["l"], s["r"]
        return F.when(turn % 2 == 0, F.struct(
            F.pmod(left + sign * _hash(key, tag, turn, right), p).alias("l"), right.alias("r"))
        ).otherwise(F.struct(left.alias("l"), F.pmod(right + sign * _hash(key, tag, turn, left), q).alias("r")))

    x = x.cast("long")
    half = F.aggregate(turns, F.struct(_div(x, q).alias("l"), F.pmod(x, q).alias("r")), step)
    return half["l"] * q + half["r"]


def _div(x: Column, q: Column) -> Column:
    """Whole-number division without going through a double."""
    return F.call_function("div", x, q)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def luhn_digit(body: Column) -> Column:
    """Check digit that makes body + digit pass the Luhn test."""
    n = F.length(body)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + _luhn_value(
        F.substr(body, i, F.lit(1)).cast("int"), (n - i) % 2 == 0))
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string")


def _luhn_value(d: Column, doubled: Column) -> Column:
    twice = d * 2
    return F.when(doubled, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    chars = F.split(shape, "")
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("at"))
    return F.aggregate(chars, start, lambda a, c: F.when(
        c.rlike(r"^\d$"), F.struct(F.concat(a["s"], F.substr(digits, a["at"], F.lit(1))).alias("s"),
                                   (a["at"] + 1).alias("at"))
    ).otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["at"].alias("at"))))["s"]


def _ten(n: Column) -> Column:
    """10^n for 0 <= n <= 9, as bigint."""
    return F.pow(F.lit(10.0), n).cast("long")


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def _luhn(d: Column) -> Column:
    return F.substr(d, F.length(d), F.lit(1)) == luhn_digit(F.substr(d, F.lit(1), F.length(d) - 1))


def _card_number(d: Column, key: str, undo: bool) -> Column:
    """The pseudonym of the 13 to 19 digits of a card."""
    body = F.substr(d, F.lit(1), F.length(d) - 1)
    n = F.length(body)
    high = _div(n, F.lit(2))
    new = feistel(body.cast("long"), _ten(high), _ten(n - high), key, "card", undo)
    return _let(F.lpad(new.cast("string"), n, F.lit("0")), lambda x: F.concat(x, luhn_digit(x)))


def _card(s: Column, key: str, undo: bool) -> Column:
    """A run of digit groups with its cards replaced."""
    alone = s.rlike(r"^(?:\d+|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4})$")  # one reading at most
    d = _digits(s)
    one = F.when(F.length(d).between(13, 19), F.when(_luhn(d), refill(s, _card_number(d, key, undo)))
                 ).otherwise(F.lit(None))
    many = _let(F.regexp_extract_all(s, F.lit(r"\d+"), F.lit(0)), lambda g: F.array_join(F.zip_with(
        F.split(s, r"\d+", -1), _groups(g, key, undo), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""))
    return F.coalesce(F.when(alone, one).otherwise(many), s)


def _readings(g: Column) -> Column:
    """Rows of whole groups with 13 to 19 digits, per first group: (level,
    first group, minus the number of groups), which is the order they go in."""
    def row(i, n):
        sizes = F.transform(F.slice(g, i, n), F.length)
        usual = (n == 1) | F.array_join(sizes, "-").isin("4-4-4-4", "4-6-5", "4-6-4")
        return F.struct(F.when(usual, 0).otherwise(1).alias("lvl"), i.alias("i"), (-n).alias("m"),
                        F.aggregate(sizes, F.lit(0), lambda a, x: a + x).alias("n"))

    return F.transform(F.sequence(F.lit(1), F.size(g)), lambda i: F.transform(F.filter(F.transform(
        F.sequence(F.least(F.lit(19), F.size(g) - i + 1), F.lit(1), F.lit(-1)), lambda n: row(i, n)),
        lambda r: r["n"].between(13, 19)), lambda r: F.struct(r["lvl"], r["i"], r["m"])))


def _meet(a: Column, b: Column) -> Column:
    return (a["i"] < b["i"] - b["m"]) & (b["i"] < a["i"] - a["m"])


def _at(g: Column, r: Column) -> Column:
    """The digits of a reading."""
    return F.array_join(F.slice(g, r["i"], -r["m"]), "")


def _put(g: Column, r: Column, d: Column) -> Column:
    """The groups with the digits of a reading replaced."""
    new = F.split(refill(F.array_join(F.slice(g, r["i"], -r["m"]), " "), d), " ")
    return F.concat(F.slice(g, F.lit(1), r["i"] - 1), new, F.slice(g, r["i"] - r["m"], F.size(g)))


def _groups(g: Column, key: str, undo: bool) -> Column:
    """Digit groups of a run → the groups with every card replaced."""
    def take(valid, barred):
        none = F.filter(valid, lambda r: F.lit(False))
        return F.aggregate(valid, F.struct(none.alias("t"), F.lit(1).alias("free")), lambda a, r: F.when(
            (r["i"] >= a["free"]) & ~barred(r),
            F.struct(F.concat(a["t"], F.array(r)).alias("t"), (r["i"] - r["m"]).alias("free"))).otherwise(a))["t"]

    def taken(valid):
        usual = take(F.filter(valid, lambda r: r["lvl"] == 0), lambda r: F.lit(False))
        return _let(usual, lambda u: F.concat(u, take(
            F.filter(valid, lambda r: r["lvl"] == 1), lambda r: F.exists(u, lambda t: _meet(t, r)))))

    def replaced(every, t):
        def step(now, c):
            first = F.greatest(F.lit(1), c["i"] - 18)
            beside = F.flatten(F.slice(every, first, c["i"] - c["m"] - first))
            # readings that go first and were not valid: they must stay so
            near = F.filter(t, lambda o: (o["i"] < c["i"] - c["m"] + 19) & (c["i"] < o["i"] - o["m"] + 19))
            before = _let(near, lambda ts: F.filter(beside, lambda r: (r < c) & _meet(r, c) & ~F.exists(
                ts, lambda o: (o < r) & _meet(o, r))))

            def walk(rivals):
                turns = F.sequence(F.lit(1), F.when(F.size(rivals) == 0, 1).otherwise(WALK))
                start = F.struct(_at(now, c).alias("d"), F.lit(False).alias("done"))
                return F.aggregate(turns, start, lambda a, _: F.when(a["done"], a).otherwise(
                    _let(_card_number(a["d"], key, undo), lambda d: F.struct(d.alias("d"), _let(
                        _put(now, c, d), lambda x: ~F.exists(rivals, lambda r: _luhn(_at(x, r)))).alias("done")))))["d"]

            return _put(now, c, _let(before, walk))

        return F.aggregate(F.reverse(t) if undo else t, g, step)

    return _let(_readings(g), lambda every: _let(
        taken(F.filter(F.flatten(every), lambda r: _luhn(_at(g, r)))), lambda t: replaced(every, t)))


def _phone(s: Column, key: str, undo: bool) -> Column:
    d = _digits(s)  # 1 and ten digits
    new = feistel(F.substr(d, F.lit(2)).cast("long"), 10 ** 5, 10 ** 5, key, "phone", undo)
    return refill(s, F.concat(F.lit("1"), F.lpad(new.cast("string"), 10, "0")))


def _ip(s: Column, key: str, undo: bool) -> Column:
    p = F.transform(F.split(s, r"\."), lambda x: x.cast("long"))
    new = feistel(p[0] * (1 << 24) + p[1] * (1 << 16) + p[2] * 256 + p[3], 1 << 16, 1 << 16, key, "ip", undo)
    byte = lambda n: F.pmod(F.shiftright(new, n), F.lit(256)).cast("string")
    return F.when(F.forall(p, lambda x: x <= 255), F.concat_ws(".", byte(24), byte(16), byte(8), byte(0))).otherwise(s)


def _date(s: Column, key: str, undo: bool) -> Column:
    first = F.lit(FIRST_DAY).cast("date")
    day = F.date_diff(F.try_to_date(s, "yyyy-MM-dd"), first)
    new = feistel(day, 365, DAYS // 365, key, "date", undo)
    ok = day.isNotNull() & (day >= 0) & (day < DAYS)
    return F.when(ok, F.date_format(F.date_add(first, F.when(ok, new).cast("int")), "yyyy-MM-dd")).otherwise(s)


def _id(s: Column, key: str, undo: bool) -> Column:
    new = feistel(_digits(s).cast("long"), 10 ** 4, 10 ** 5, key, "id", undo)
    return refill(s, F.lpad(new.cast("string"), 9, "0"))


def _email(s: Column, key: str, undo: bool) -> Column:
    """The local part's letters and digits, two halves moved in turns."""
    at = F.locate("@", s)
    local, host = F.substr(s, F.lit(1), at - 1), F.substr(s, at)
    n = F.length(local)
    half = _div(n, F.lit(2))
    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if undo else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    sign = -1 if undo else 1

    def move(part: Column, by: Column, turn: Column) -> Column:
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), turn.cast("string"), by), 512)

        def one(c, i):
            step = sign * F.conv(F.substr(stream, F.pmod(i * 3, F.lit(120)) + 1, F.lit(6)), 16, 10).cast("int")
            code = F.ascii(c)
            turned = lambda low, size: F.char(low + F.pmod(code - low + step, F.lit(size)))
            return (F.when(c.between("a", "z"), turned(97, 26)).when(c.between("A", "Z"), turned(65, 26))
                    .when(c.between("0", "9"), turned(48, 10)).otherwise(c))

        return F.array_join(F.transform(F.split(part, ""), one), "")

    def step(x, turn):
        return F.when(turn % 2 == 0, F.struct(move(x["l"], x["r"], turn).alias("l"), x["r"].alias("r"))
                      ).otherwise(F.struct(x["l"].alias("l"), move(x["r"], x["l"], turn).alias("r")))

    out = F.aggregate(turns, F.struct(F.substr(local, F.lit(1), half).alias("l"),
                                      F.substr(local, half + 1, n).alias("r")), step)
    return F.concat(out["l"], out["r"], host)


_MAKERS = {"email": _email, "phone": _phone, "ip": _ip, "date": _date, "id": _id, "card": _card}


def pseudonym(match: Column, key: str, undo: bool = False) -> Column:
    """The pseudonym of one match of ANY."""
    out = None
    for kind, pattern in KINDS.items():
        # only the branch of the match's own kind sees it
        whole = match.rlike("^(?:" + (r"\d++(?:[ -]\d++)*+" if kind == "card" else _bare(pattern)) + ")$")
        made = _MAKERS[kind](F.when(whole, match), key, undo)
        out = F.when(whole, made) if out is None else out.when(whole, made)
    return F.coalesce(out.otherwise(match), match)


def _bare(pattern: str) -> str:
    """The pattern without what it asks of its surroundings."""
    import re

    return re.sub(r"\(\?<?!(?:[^()\[\]]|\[[^\]]*\])*\)", "", pattern)


def pseudonyms(docs: DataFrame, key: str, undo: bool = False, text: str = "text") -> DataFrame:
    """docs with ``text`` replaced and ``n_replaced`` (values that changed)."""
    t = F.col(text)
    touched = t.rlike("[0-9@]") & t.rlike(ANY)
    found = F.when(touched, F.regexp_extract_all(t, F.lit(ANY), F.lit(0)))
    between = F.when(touched, F.split(t, ANY, -1))
    d = packed(docs, t.alias("_text"), found.alias("_found"), between.alias("_between"))
    d = d.withColumn("_new", F.transform("_found", lambda m: pseudonym(m, key, undo)))
    woven = F.concat(F.array_join(F.zip_with("_between", "_new", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""))
    changed = F.size(F.filter(F.arrays_zip("_found", "_new"), lambda x: x["_found"] != x["_new"]))
    out = F.when(F.col("_found").isNull(), F.col("_text")).otherwise(woven)
    return d.select(*[out.alias(c) if c == text else F.col(f"doc.`{c}`") for c in docs.columns if c != "n_replaced"],
                    F.when(F.col("_found").isNull(), 0).otherwise(changed).cast("long").alias("n_replaced"))


def values(docs: DataFrame, key: str) -> DataFrame:
    """One row per distinct value: kind, value, pseudonym, n_docs - what links
    documents, without the texts."""
    t = F.col("text")
    m = (docs.filter(t.rlike("[0-9@]") & t.rlike(ANY))
         .select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(t, F.lit(ANY), F.lit(0)))).alias("value")))
    n = m.groupBy("value").agg(F.count(F.lit(1)).alias("n_docs"))
    return n.withColumn("pseudonym", pseudonym(F.col("value"), key))
