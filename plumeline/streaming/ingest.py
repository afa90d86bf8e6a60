"""Streaming ingest of feed files (ST-4, ST-5).

A file source picks up new objects; each micro-batch is normalised, staged and
loaded with the same operators as a batch run.  Late or revised values become
new versions with an audit row.  Progress lives in the stream's checkpoint;
staging and history ignore rows they already hold, and a load repeats by its
batch number, so a replayed micro-batch changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumeline.operators import normalise
from plumeline.plans.load import run_load
from plumeline.sources.config import pollutant_aliases, pollutant_config
from plumeline.sources.delimited import MAX_BROADCAST_FILES, parse_hourly_lines
from plumeline.sources.documents import authoritative_rows, gap_fill_rows
from plumeline.sources.staging import stage
from plumeline.sources.store import ObservationStore


def start_ingest(
    store: ObservationStore,
    feed: str,
    source_dir: str,
    clock: Callable[[], datetime],
    *,
    regions: DataFrame | None = None,
    max_files: int = 1000,
    available_now: bool = False,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Start a stream loading the files of ``source_dir`` into ``store``."""
    spark, job = store.spark, f"stream_{feed}"
    reader = spark.readStream.option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", True)
    if feed == "airnow_hourly_file":
        source = reader.text(source_dir).select(
            F.col("_metadata.file_path").alias("object_key"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.make_valid_utf8("value").alias("line"),
        )
    else:
        source = reader.option("wholetext", True).text(source_dir).select(
            F.col("_metadata.file_path").alias("object_key"), F.try_parse_json("value").alias("doc")
        )

    location = checkpoint or f"{store.work_dir}/stream_{feed}"

    def load(batch: DataFrame, epoch: int) -> None:
        # A stream's id is in its checkpoint: epochs of another stream, or of this one
        # after its checkpoint was dropped, are other batches.
        stream = store.read_text(f"{location}/metadata")
        key = f"{json.loads(stream)['id']}-{epoch}"
        as_of, batch_id = clock(), store.batch_number(job, key)
        observed = _normalised(store, feed, batch, regions, max_files <= MAX_BROADCAST_FILES).withColumn("ingested_at", F.lit(as_of).cast("timestamp"))
        run = store.run_name(job, batch_id, key)
        observed = store.once(run, "observed", observed)  # parse the files once
        stage(store, observed, as_of)
        run_load(store, batch_id, as_of, job=job, staged=observed, regions=regions)
        store.discard(run)

    writer = source.writeStream.foreachBatch(load).option("checkpointLocation", location)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _normalised(
    store: ObservationStore, feed: str, batch: DataFrame, regions: DataFrame | None, few_files: bool
) -> DataFrame:
    spark = store.spark
    if feed == "airnow_hourly_file":
        # A file arrives whole in one micro-batch, so its header is here too.
        lines = batch.withColumn("line_id", F.monotonically_increasing_id())
        rows = parse_hourly_lines(lines, broadcast_layouts=few_files)
    elif feed == "airnow_gapfill_json":
        rows = gap_fill_rows(batch)
    else:
        return normalise.normalise_authoritative(authoritative_rows(batch), feed, pollutant_config(spark))
    return normalise.normalise_provisional(rows, feed, pollutant_aliases(spark), regions)
