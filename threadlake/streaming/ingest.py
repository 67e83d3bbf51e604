"""Continuous ingest (ST5).

Transcript files grow in place, which the streaming file source cannot see
(it never re-reads a known file).  The supported shape is a *landing*
directory of immutable files (one file per upload); each micro-batch is a
batch ingest of the new files, upserted into the bucketed store
(``foreachBatch``): it writes the buckets of its sessions and one pointer, and
retires old sets.  A batch that Spark repeats after a failure upserts the same
sessions again, which changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlake.session import settings
from threadlake.sources import jsonl as J
from threadlake.sources import store


def _batch(base: str, indexed_at: str, per_node_dirs: bool):
    def run(lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        lines = lines.withColumn("mid", F.monotonically_increasing_id())  # line order, taken on the scan
        scan = lines.select("file_path", "file_mtime", *J._path_columns(F.col("file_path"), per_node_dirs, None),
                            "block", "mid", "raw")
        records, _bad = J.decode(scan)
        with store.kept(J.narrow(records), base) as nl:
            headers = J.latest_file_per_session(J.headers(nl, indexed_at)).withColumn(
                "bucket", store.session_bucket(F.col("started_at"), F.col("session_id")))
            with store.kept(headers, base) as sessions:
                turns = J.to_turns(nl.join(sessions.select("file_path"), "file_path", "left_semi")).drop("file_path")
                turns = turns.join(sessions.select("session_id", "bucket"), "session_id")
                store.upsert(spark, base, "session_id", {"sessions": sessions, "turns": turns},
                             sessions.select("session_id").limit(0), J.ORDER)
        store.retire(spark, base)
    return run


#: Files of a batch that the driver lists itself; for more Spark starts a job.
LISTED = {"spark.sql.sources.parallelPartitionDiscovery.threshold": "64"}


def start_ingest(spark: SparkSession, landing: str, base: str, checkpoint: str, indexed_at: str,
                 per_node_dirs: bool = True, available_now: bool = False, files_per_batch: int = 1000):
    lines = (spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl")
             .option("maxFilesPerTrigger", files_per_batch).text(landing)
             .select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_modification_time").alias("file_mtime"),
                     F.col("_metadata.file_block_start").alias("block")))
    w = lines.writeStream.foreachBatch(_batch(base, indexed_at, per_node_dirs)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    with settings(spark, J.SMALL_FILES | LISTED):  # the stream takes them along
        return w.start()
