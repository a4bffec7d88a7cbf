"""Incremental ingest with Structured Streaming.

Each micro-batch of new source files becomes block rows and one retrieval record per file, both appended with
``ingest_seq`` = the batch id.  Reprocessing a file in a later batch appends it again (bag semantics, as repeated
ingest calls do); the stream's checkpoint makes file pickup exactly-once, and every batch overwrites only its own
``ingest_seq=<id>`` folder, so a retried batch replaces its earlier partial output instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.blocks import retrieval_record


def start_ingest(spark: SparkSession, source: str, schema: str, to_blocks: Callable[[DataFrame, int], DataFrame],
                 out_dir: str, glob: str | None = None, fmt: str = "parquet", available_now: bool = True,
                 processing_time: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest stream: ``source`` files (``fmt``) -> ``to_blocks(batch_df, batch_id)`` -> block table at
    ``<out_dir>/blocks`` and retrieval records at ``<out_dir>/records`` (both partitioned by ``ingest_seq``).
    ``out_dir`` must be on the shared file system; the stream checkpoint lives in ``<out_dir>/_checkpoint``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The micro-batch feeds two writes: keep it for the duration of the batch instead of reading it twice.
        batch.persist()
        try:
            blocks = to_blocks(batch, batch_id).drop("ingest_seq")
            blocks.write.mode("overwrite").parquet(f"{out_dir}/blocks/ingest_seq={batch_id}")
            recs = retrieval_record(blocks.withColumn("ingest_seq", F.lit(batch_id).cast("long")))
            recs.drop("ingest_seq").write.mode("overwrite").parquet(f"{out_dir}/records/ingest_seq={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", f"{out_dir}/_checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_ingested(spark: SparkSession, out_dir: str, what: str = "blocks") -> DataFrame:
    """The appended table (``blocks`` or ``records``) with ``ingest_seq`` as a long column."""
    df = spark.read.parquet(f"{out_dir}/{what}")
    return df.withColumn("ingest_seq", F.col("ingest_seq").cast("long"))
