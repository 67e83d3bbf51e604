"""Mixing sources to target weights by weighted fair queueing.

Every source puts its documents into a queue in a keyed random order, epoch
after epoch (at most ``EPOCHS``).  A queued document's virtual finish time is
the source's cumulative words up to and including it, divided by the source's
target.  All queues are merged by finish time with one global range sort and
the merged stream is cut where the total budget is reached.

Targets: the budget is ``BUDGET`` times all words, shared by weight; a target
stops at ``EPOCHS`` times its source's size and the excess is shared again.

Defined cases: a null source is one source and comes last; a null or empty
text has no words and is never taken; repeated rows count and queue each; ties in
finish time are broken by the fingerprint of the row; very long texts queue whole;
other columns may have any name (they enter the fingerprint); an empty table gives
no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from threadlake.llm.common import packed, running, stored, word_count

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
EPOCHS = 2
SEED = 20260101
KEY = ["_row", "_row2"]


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, budget: float = BUDGET,
            cap: int = EPOCHS) -> dict[str | None, float]:
    """Target words per source.  ``sizes`` is one entry per source."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))  # str order is code point order
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    out: dict[str | None, float] = {}
    left, free = budget * sum(size.values()), set(size)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= cap * size[s]}
        if not over:
            out |= {s: left * weight[s] / total for s in free}
            break
        out |= {s: float(cap * size[s]) for s in over}
        left -= sum(cap * size[s] for s in over)
        free -= over
    return out


def queue(docs: DataFrame, name: str = "mix") -> tuple[DataFrame, DataFrame]:
    """(rows, taken): one line per row of docs as (doc_id, source, size, source_size,
    target, *KEY, copy) and the queue entries inside the budget (*KEY, copy, epoch).

    Rows equal in every column share KEY and are told apart by ``copy``.
    """
    slim = stored(docs.groupBy("doc_id", "source", "size", *KEY).agg(F.count(F.lit(1)).alias("n")), name)
    by_source = slim.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sizes = [(r["source"], r["source_size"]) for r in by_source.collect()]  # one row per source
    goal = targets(sizes)
    plan = docs.sparkSession.createDataFrame(
        [Row(_source=s, source_size=n, target=float(goal[s])) for s, n in sizes],
        "_source string, source_size long, target double")
    rows = (slim.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).drop("n"))
    entries = (rows.filter("size > 0").drop("doc_id")
               .withColumn("_queue", F.xxhash64(F.lit(SEED), *KEY, "copy")))
    entries = running(entries, ["_queue", *KEY, "copy"], "size", group=["source"], name=f"{name}-queue")
    # a later epoch repeats the queue behind the first one
    entries = entries.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))))
    finish = (F.col("before") + F.col("size") + F.col("epoch") * F.col("source_size")) / F.col("target")
    merged = running(entries.select(*KEY, "copy", "epoch", "size", finish.alias("finish")),
                     ["finish", *KEY, "copy", "epoch"], "size", name=f"{name}-merged")
    budget = BUDGET * sum(n for _, n in sizes)
    return rows, merged.filter(F.col("before") + F.col("size") / 2 <= F.lit(budget)).select(*KEY, "copy", "epoch", "size")


def mix(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, source) → doc_id, source, size, source_size, target,
    taken (words the mix takes of the row, repeats counted), copies."""
    rows, taken = queue(_keyed(docs).select("doc_id", "source", "size", *KEY))
    per_row = taken.groupBy(*KEY, "copy").agg(F.sum("size").alias("taken"), F.count(F.lit(1)).alias("copies"))
    return (rows.join(per_row, [*KEY, "copy"], "left")
            .select("doc_id", "source", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                    F.coalesce("copies", F.lit(0)).cast("long").alias("copies")))


def mixed(docs: DataFrame) -> DataFrame:
    """The mixed corpus itself: rows of ``docs``, each as often as it is taken."""
    keyed = _keyed(docs)
    _, taken = queue(keyed.select("doc_id", "source", "size", *KEY))
    often = taken.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"))
    return (keyed.dropDuplicates(KEY).join(often, KEY)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
            .select("doc.*"))


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows packed, with ``size`` and a 96-bit fingerprint of the whole row
    (KEY); hashes pass over nulls, so which columns are null is hashed too."""
    cols = [docs[f"`{c}`"] for c in docs.columns]
    cols = [c.cast("string") for c in cols] + [c.isNull() for c in cols]
    return packed(docs, "doc_id", "source", word_count(F.col("text")).alias("size"),
                  F.xxhash64(*cols).alias(KEY[0]), F.hash(*cols).alias(KEY[1]))
