"""Full-text query builder (replaces a MATCH-string parser).

A query is a tree of phrases combined with AND / OR / NOT::

    all_of(term("wave"), phrase("memory v4"), not_(prefix("deb")))

Phrases are numbered left to right (like FTS5).  For batch evaluation the tree
is turned into disjunctive normal form: a list of clauses, each a set of
phrases that must occur and a set that must not.  Each clause needs at least
one positive phrase, as a pure NOT query cannot be answered from postings.

``query_table`` turns a batch of such queries into a small DataFrame
(one row per query) that search plans join against.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Phrase:
    text: str
    prefix: bool = False


@dataclass(frozen=True)
class And:
    parts: tuple


@dataclass(frozen=True)
class Or:
    parts: tuple


@dataclass(frozen=True)
class Not:
    part: object


def term(text: str) -> Phrase:
    return Phrase(text)


def phrase(text: str) -> Phrase:
    """Adjacent tokens in order (a quoted phrase)."""
    return Phrase(text)


def prefix(text: str) -> Phrase:
    """Last token matches any term that starts with it (``tok*``)."""
    return Phrase(text, prefix=True)


def all_of(*parts) -> And:
    return And(tuple(parts))


def any_of(*parts) -> Or:
    return Or(tuple(parts))


def not_(part) -> Not:
    return Not(part)


def leaves(q) -> list[Phrase]:
    if isinstance(q, Phrase):
        return [q]
    if isinstance(q, Not):
        return leaves(q.part)
    out: list[Phrase] = []
    for p in q.parts:
        out.extend(leaves(p))
    return out


def dnf(q) -> list[tuple[frozenset, frozenset]]:
    """Clauses (must, must_not) over phrase numbers."""
    counter = iter(range(10**9))

    def number(node):
        if isinstance(node, Phrase):
            return ("lit", next(counter))
        if isinstance(node, Not):
            return ("not", number(node.part))
        return ("and" if isinstance(node, And) else "or", [number(p) for p in node.parts])

    def walk(node, neg=False):
        kind = node[0]
        if kind == "lit":
            return [(frozenset(), frozenset([node[1]]))] if neg else [(frozenset([node[1]]), frozenset())]
        if kind == "not":
            return walk(node[1], not neg)
        is_and = (kind == "and") != neg
        subs = [walk(p, neg) for p in node[1]]
        if not is_and:
            return [c for s in subs for c in s]
        out = []
        for combo in product(*subs):
            must = frozenset().union(*[c[0] for c in combo])
            must_not = frozenset().union(*[c[1] for c in combo])
            if not (must & must_not):
                out.append((must, must_not))
        return out

    clauses = walk(number(q))
    for must, _ in clauses:
        if not must:
            raise ValueError("every alternative of a query needs a positive phrase")
    return clauses


@dataclass
class Query:
    query_id: int
    expr: object
    limit: int = 10
    project: str | None = None
    source: str | None = None
    node: str | None = None
    text: str = field(default="")


QUERY_SCHEMA = T.StructType([
    T.StructField("query_id", T.LongType(), False),
    T.StructField("query_text", T.StringType(), True),
    T.StructField("phrases", T.ArrayType(T.StructType([
        T.StructField("pno", T.IntegerType(), False),
        T.StructField("text", T.StringType(), False),
        T.StructField("prefix", T.BooleanType(), False)])), False),
    T.StructField("clauses", T.ArrayType(T.StructType([
        T.StructField("must", T.ArrayType(T.IntegerType()), False),
        T.StructField("must_not", T.ArrayType(T.IntegerType()), False)])), False),
    T.StructField("lim", T.IntegerType(), False),
    T.StructField("project_filter", T.StringType(), True),
    T.StructField("source_filter", T.StringType(), True),
    T.StructField("node_filter", T.StringType(), True),
])


def render(q) -> str:
    """FTS5-like text of a query tree (for display only)."""
    if isinstance(q, Phrase):
        body = q.text if (" " not in q.text.strip() and q.text.isalnum()) else f'"{q.text}"'
        return body + ("*" if q.prefix else "")
    if isinstance(q, Not):
        return f"NOT {render(q.part)}"
    sep = " AND " if isinstance(q, And) else " OR "
    return "(" + sep.join(render(p) for p in q.parts) + ")"


def query_rows(queries: list[Query]) -> list[tuple]:
    rows = []
    for q in queries:
        phr = [(i, p.text, p.prefix) for i, p in enumerate(leaves(q.expr))]
        cl = [(sorted(m), sorted(n)) for m, n in dnf(q.expr)]
        rows.append((q.query_id, q.text or render(q.expr), phr, cl, q.limit,
                     q.project, q.source, q.node))
    return rows


def query_table(spark: SparkSession, queries: list[Query]) -> DataFrame:
    """One row per query; its size is bounded by the batch the caller passes."""
    return spark.createDataFrame(query_rows(queries), QUERY_SCHEMA)
