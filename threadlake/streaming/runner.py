"""Run a streaming plan to a parquet table in the shared scratch area.

File sink + checkpoint directory under ``spark.checkpoint.dir`` (shared on a
cluster), so a restarted query resumes exactly-once and executors can be lost.
``availableNow`` processes what is there and stops; on a live source use a
processing-time trigger instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadlake.session import scratch_path


def run_available(stream: DataFrame, name: str, spark: SparkSession | None = None,
                  timeout_s: int = 600) -> DataFrame:
    spark = spark or stream.sparkSession
    out = scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(stream.schema).parquet(out)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Stream the rows of one driver table (files named ``<name>.parquet``)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .option("maxFilesPerTrigger", 1).parquet(sf_dir))
