"""Snippets (X8): the best ``n``-token window of a hit, hits marked.

Runs only on the top-k rows of a search (k per query), as an Arrow-batched
pandas UDF: the window choice needs per-row token offsets, which SQL
functions cannot return.  Window score: +1000 for each distinct phrase and +1
for each further hit inside the window; the window is centred on its hits and
clamped to the text; ``...`` marks cut ends.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.functions.text import FOLD_FROM, FOLD_TO, strip_marks

OPEN, CLOSE, ELLIPSIS, TOKENS = ">>>", "<<<", "...", 24   # fixed snippet arguments


_FOLD = str.maketrans(FOLD_FROM, FOLD_TO)


def _tokens(text: str):
    """(start, end, folded word); marks belong to the word they stand in."""
    import regex
    return [(m.start(), m.end(), strip_marks(m.group(0).lower().translate(_FOLD)))
            for m in regex.finditer(r"[\p{L}\p{N}][\p{L}\p{N}\p{M}]*", text or "")]


def _phrase_tokens(ptext: str):
    return [word for _, _, word in _tokens(ptext)]


def snippet_text(text: str, phrases, n: int = TOKENS, open_: str = OPEN, close: str = CLOSE,
                 ellipsis: str = ELLIPSIS) -> str:
    toks = _tokens(text)
    if not toks:
        return text or ""
    words = [t[2] for t in toks]
    hits = []  # (start_token, length, phrase_no)
    for pno, (ptext, is_prefix) in enumerate(phrases):
        pt = _phrase_tokens(ptext)
        if not pt:
            continue
        L = len(pt)
        for i in range(len(words) - L + 1):
            ok = all(words[i + j] == pt[j] for j in range(L - 1))
            last = words[i + L - 1]
            ok = ok and (last.startswith(pt[-1]) if is_prefix else last == pt[-1])
            if ok:
                hits.append((i, L, pno))
    start = 0
    if hits:
        best = None
        for h0, _, _ in hits:
            inside = [h for h in hits if h0 <= h[0] and h[0] + h[1] <= h0 + n]
            seen, score = set(), 0
            for h in inside:
                score += 1 if h[2] in seen else 1000
                seen.add(h[2])
            first = min(h[0] for h in inside)
            last = max(h[0] + h[1] - 1 for h in inside)
            adj = first - (n - (last - first + 1)) // 2
            adj = max(0, min(adj, len(words) - n))
            if best is None or score > best[0]:
                best = (score, adj)
        start = best[1]
    end = min(len(words), start + n)
    marks_open, marks_close = {}, {}
    for h0, L, _ in hits:
        if h0 >= start and h0 + L <= end:
            marks_open[h0] = marks_open.get(h0, 0) + 1
            marks_close[h0 + L - 1] = marks_close.get(h0 + L - 1, 0) + 1
    out = [ellipsis] if start > 0 else []
    pos = toks[start][0]
    for i in range(start, end):
        s, e, _ = toks[i]
        out.append(text[pos:s])
        out.append(open_ * marks_open.get(i, 0) + text[s:e] + close * marks_close.get(i, 0))
        pos = e
    if end < len(words):
        out.append(ellipsis)
    else:
        out.append(text[pos:])
    return unicodedata.normalize("NFC", "".join(out)).strip()


@F.pandas_udf(T.StringType())
def _snippet_udf(text: pd.Series, phrases: pd.Series) -> pd.Series:
    return pd.Series([snippet_text(t, [(p["text"], bool(p["prefix"])) for p in (ph if ph is not None else [])])
                      for t, ph in zip(text, phrases)])


def add_snippets(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """hits(query_id, …, text) from ``search_sessions`` → + snippet."""
    q = queries.select("query_id", "phrases")
    return hits.join(q, "query_id").withColumn("snippet", _snippet_udf(F.col("text"), F.col("phrases"))).drop("phrases")
