"""Column-level text helpers: tokenizer, whitespace trim, display formatting.

All helpers return Spark Columns so that they stay inside whole-stage codegen /
JVM expression evaluation; none of them is a Python UDF.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fold_table() -> tuple[str, str]:
    """Diacritic folding table, built by rule from Unicode decomposition.

    Every code point whose canonical decomposition is one base character, with
    or without combining marks, maps to that base.  Characters without such a
    decomposition (``ß``, ``æ``, ``ø``) are left unchanged, which is what
    ``strip_accents`` does as well.
    """
    src, dst = [], []
    for cp in range(0x00C0, sys.maxunicode + 1):
        ch = chr(cp)
        if not unicodedata.decomposition(ch):
            continue
        base = strip_marks(unicodedata.normalize("NFD", ch))
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def strip_marks(text: str) -> str:
    """``text`` without its combining marks."""
    return "".join(c for c in text if unicodedata.category(c)[0] != "M")


FOLD_FROM, FOLD_TO = _fold_table()

# Token = maximal run of Unicode letters or digits (unicode61-style).
TOKEN_PATTERN = r"([\p{L}\p{N}]+)"


def fold(col: Column) -> Column:
    """Lower-case and strip diacritics, composed or not (the per-character
    translate only runs on values that contain non-ASCII characters)."""
    low = F.lower(col)
    plain = F.regexp_replace(F.translate(low, FOLD_FROM, FOLD_TO), r"\p{M}+", "")
    return F.when(low.rlike(r"[^\x00-\x7F]"), plain).otherwise(low)


def tokenize(col: Column) -> Column:
    """ARRAY<STRING> of normalised tokens, in text order."""
    return F.regexp_extract_all(fold(col), F.lit(TOKEN_PATTERN), 1)


def full_trim(col: Column) -> Column:
    """Strip all Unicode whitespace at both ends (Spark ``trim`` only strips
    U+0020)."""
    return F.regexp_replace(col, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def display_ts(col: Column, n: int = 19) -> Column:
    """``ts[:n]`` with ``T`` replaced by a space ('' for NULL)."""
    return F.replace(F.substring(F.coalesce(col, F.lit("")), 1, n), F.lit("T"), F.lit(" "))


def cut_body(col: Column, n: int) -> Column:
    """First n characters, plus ``...`` when the text was longer."""
    t = F.coalesce(col, F.lit(""))
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit("..."))).otherwise(t)


def contains_ci(col: Column, needle: Column | str) -> Column:
    """Literal, case-insensitive substring test (no LIKE wildcards)."""
    needle_col = F.lit(needle) if isinstance(needle, str) else needle
    return F.instr(F.lower(col), F.lower(needle_col)) > 0


def prefix_join(big: DataFrame, big_col: str, small: DataFrame, small_col: str) -> DataFrame:
    """Rows of ``big`` with every row of ``small`` whose ``small_col`` their
    ``big_col`` starts with (an empty one starts everything, null nothing).

    One pass over ``big`` for any mix of lengths, by hash, without comparing all
    with all: the lengths that occur (one row, at most as long as the longest
    prefix) go to ``big``, whose rows are cut to each and meet the prefixes by
    equality."""
    lengths = small.agg(F.collect_set(F.length(small_col)).alias("_lens"))
    cut = (big.join(F.broadcast(lengths), F.lit(True))
           .withColumn("_len", F.explode(F.filter("_lens", lambda n: n <= F.length(big_col)))))
    cut = cut.withColumn("_pfx", F.expr(f"substring({big_col}, 1, _len)")).drop("_lens", "_len")
    return cut.join(small, F.col("_pfx") == F.col(small_col)).drop("_pfx")
