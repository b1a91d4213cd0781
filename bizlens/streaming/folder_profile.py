"""Incremental folder profiling (L24): profile CSV files as they land.

A file-source stream over the folder delivers every new file whole in one
micro-batch; ``foreachBatch`` runs the batch profiler on just those files.  A
batch writes its own folder (``batch=<epoch>``) and overwrites it when it is
run again after a failure, so each file is profiled exactly once; a rerun
resumes from the checkpoint.  Zero-byte files carry no lines and are not seen
by a text stream (the batch profiler lists them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.folder import CSV_GLOB, number_lines, profile_lines


def folder_profile_stream(spark: SparkSession, folder: str, sink_dir: str, checkpoint_dir: str,
                          max_files_per_trigger: int | None = None) -> None:
    """Profile the CSV files that arrive in ``folder`` (availableNow; one folder per batch in ``sink_dir``)."""
    reader = spark.readStream.format("text").option("pathGlobFilter", CSV_GLOB)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(folder).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("size_bytes"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))

    def profile_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            files = (batch.select("file_name", "file_path", "size_bytes").distinct()
                          .withColumn("file_idx", F.lit(None).cast("long")))
            found = profile_lines(files, number_lines(batch))
            for name, df in zip(("files", "columns"), found):
                df.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/{name}/batch={epoch_id}")
        finally:
            batch.unpersist()

    q = (stream.writeStream.foreachBatch(profile_batch).option("checkpointLocation", checkpoint_dir)
               .trigger(availableNow=True).start())
    q.awaitTermination()
