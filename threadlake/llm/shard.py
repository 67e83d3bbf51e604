"""Contiguous shards of equal bytes.

Rows are range-sorted by (hash of text, doc_id); per-partition byte totals give
every row its global byte offset, and shard k takes the rows whose middle byte
lies between the k-th and the (k+1)-th of ``shards`` equal cuts.  Equal texts
are neighbours in this order.  A cut that falls into such a group moves to the
group's nearer end when that costs at most ``slack`` of a shard; a larger group
is cut through, because equal sizes are the law here.

Defined cases: null text has no bytes and counts like the empty text; repeated
rows each get a slot; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import running

SHARDS = 8
SLACK = 0.02


def shard(docs: DataFrame, shards: int = SHARDS, slack: float = SLACK) -> DataFrame:
    """docs(doc_id, text) → doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is UTF-8 bytes + 1, ``slot`` the row's place in its shard (from 0,
    gapless).  The driver sees ``shards`` cuts and as many straddling groups.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("_h"))
    rows = running(slim, ["_h", "doc_id", "size"], "size", name="shard")
    total = rows.agg(F.max(F.col("before") + F.col("size"))).first()[0] or 0
    cuts = _cuts(rows, total, shards, slack)
    middle = F.col("before") + F.col("size") / 2
    number = sum((F.when(middle >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    rows = rows.withColumn("shard", number)
    first = rows.groupBy("shard").agg(F.min("rank").alias("_first"))  # one row per shard
    return rows.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("_first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def _cuts(rows: DataFrame, total: int, shards: int, slack: float) -> list[float]:
    """Equal cuts, moved to the end of a straddling small group of equal texts."""
    cuts = [total * k / shards for k in range(1, shards)]
    if not total or not cuts:
        return cuts
    inside = [(F.col("before") < c) & (F.col("before") + F.col("size") > c) for c in cuts]
    at_cut = inside[0]
    for x in inside[1:]:
        at_cut = at_cut | x
    hashes = [r[0] for r in rows.filter(at_cut | F.col("before").isin([int(c) for c in cuts])).select("_h").distinct().collect()]
    groups = (rows.filter(F.col("_h").isin(hashes)).groupBy("_h")
              .agg(F.min("before").alias("lo"), F.max(F.col("before") + F.col("size")).alias("hi"),
                   F.count(F.lit(1)).alias("n")).collect())
    moved = []
    for c in cuts:
        for g in groups:
            if g["n"] > 1 and g["lo"] < c < g["hi"]:
                end = min((g["lo"], g["hi"]), key=lambda e: abs(e - c))
                c = end if abs(end - c) <= slack * total / shards else c
                break
        moved.append(float(c))
    return moved
