"""Incremental ingest and tagging with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from labelforge.operators import profile
from labelforge.plans.runner import rule_side, tag_all
from labelforge.sources.delimited import parse_cells


def stream_tsv_cells(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                     names: list[str], family: str, mode: str = "strict",
                     available_now: bool = True, max_files_per_trigger: int | None = None
                     ) -> StreamingQuery:
    """A10 + A11 on a stream: new TSV files -> strict rows -> cells -> Parquet sink.

    The file sink with a checkpoint is exactly-once: a micro-batch that is retried
    after a failure rewrites the same batch id, which the sink's log de-duplicates.
    ``available_now`` processes everything present and stops (batch-style runs).
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    cells = parse_cells(reader.load(source_dir), names, names[0], family, mode=mode)
    writer = cells.writeStream.format("parquet").option("path", sink_dir) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def stream_profile_updates(source: DataFrame, key: str, specs: list, profile_path: str,
                           checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Tag each micro-batch of a streaming business table with the one-scan runner
    and upsert the cells into the long profile.  A batch's run is named by its id: a
    replayed batch takes its old place and changes nothing."""

    side = rule_side(source.sparkSession, specs, keep=True)  # once, not per batch

    def apply(batch: DataFrame, batch_id: int) -> None:
        profile.write_profile(tag_all(batch, key, specs, side=side), profile_path, mode="upsert",
                              run=f"{checkpoint} {batch_id}")

    writer = source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
