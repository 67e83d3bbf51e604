"""Skew-safe as-of join.

For every probe row find the nearest marker row of the same key:

* ``backward`` – the last marker with marker.ts ≤ probe.ts
* ``forward``  – the first marker with marker.ts ≥ probe.ts

Two-level carry: the rows of a key are cut into hours, and hours with more than
``bucket_rows`` rows into equal slices of the hour.  Inside a bucket a window
carries the last marker along; from bucket to bucket a window over one small
row per bucket does.  A key with a third of all rows is spread over its
buckets, and nothing depends on how Spark samples or partitions the rows.
Rows of one key that share one second stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 1 << 14


def asof_join(probes: DataFrame, markers: DataFrame, key: str, ts: str, probe_id: str,
              marker_id: str, direction: str = "backward", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Return ``probes`` plus ``marker_id`` of the matched marker (NULL when none).

    ``probe_id`` / ``marker_id`` break ties between rows with equal ``ts``
    (markers sort before probes for backward, after them for forward, so equal
    timestamps match).  A NULL key or timestamp matches nothing.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(direction)
    back = direction == "backward"
    p_kind, m_kind = (1, 0) if back else (0, 1)
    probe = F.struct(*[F.col(c) for c in probes.columns])
    m = markers.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    ev = (probes.select(F.col(key).alias("_key"), F.col(ts).alias("_ts"), F.lit(p_kind).alias("_kind"),
                        F.col(probe_id).cast("long").alias("_id"), probe.alias("_probe"))
          .unionByName(m.select(F.col(key).alias("_key"), F.col(ts).alias("_ts"), F.lit(m_kind).alias("_kind"),
                                F.col(marker_id).cast("long").alias("_id")), allowMissingColumns=True)
          # fields of the timestamp itself: no time zone comes in
          .withColumn("_hour", F.unix_date(F.to_date("_ts")) * 24 + F.hour("_ts")))
    crowded = (ev.groupBy("_key", "_hour").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bucket_rows)
               .select("_key", "_hour", F.ceil(F.col("_n") / bucket_rows).alias("_slices")))
    second = F.minute("_ts") * 60 + F.floor(F.second("_ts"))
    bucket = ["_key", "_hour", "_slice"]
    ev = (ev.join(crowded, ["_key", "_hour"], "left")
          .withColumn("_slice", F.floor(second * F.coalesce("_slices", F.lit(1)) / 3600)).drop("_slices"))

    def along(*cols: str):
        return [F.col(c) if back else F.col(c).desc() for c in cols]

    marker = F.when(F.col("_kind") == m_kind, F.struct("_ts", "_id"))
    edge = F.max(marker) if back else F.min(marker)  # the marker that a bucket hands on
    before = Window.partitionBy("_key").orderBy(*along("_hour", "_slice")).rowsBetween(Window.unboundedPreceding, -1)
    carried = (ev.groupBy(*bucket).agg(edge.alias("_edge"))
               .select(*bucket, F.last("_edge", ignorenulls=True).over(before)["_id"].alias("_carried")))
    inside = Window.partitionBy(*bucket).orderBy(*along("_ts", "_kind", "_id")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = (ev.withColumn("_near", F.last(marker, ignorenulls=True).over(inside)["_id"])
           .filter(F.col("_kind") == p_kind).join(carried, bucket, "left"))
    return out.select("_probe.*", F.coalesce("_near", "_carried").alias(marker_id))
