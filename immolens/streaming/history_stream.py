"""H1 + H5 as an incremental job: Gold snapshots flow into the History.

The batch path rewrites a snapshot's History partition after each Gold
write. This is the same step expressed with Structured Streaming: the Gold
folder is a file source, each micro-batch holds the files written since the
last one, and every snapshot date present in a batch replaces that date in
History (dynamic partition overwrite). A rerun of a date therefore replaces
it, other dates are untouched, and nothing is rewritten whole.

Progress lives in a checkpoint under the cluster's shared
``spark.checkpoint.dir`` so a restarted job (or one that lost executors)
picks up where it stopped; ``availableNow`` processes what is there and
stops, which suits a weekly schedule.

A micro-batch only says which dates changed: each of those dates is then
re-read whole from Gold (a semi-join on the partition column, so only
those folders are scanned) and replaces its History partition. A date
whose files arrive over several micro-batches (``maxFilesPerTrigger``, or
a listing taken while a Gold write is still committing) therefore never
loses the rows of the earlier batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from immolens.schema import GOLD, GOLD_COLUMNS
from immolens.session import ensure_checkpoint_dir
from immolens.sources.files import read_gold, write_history


def gold_stream(spark: SparkSession, gold_root: str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Gold files as a stream (fixed schema, date from the folder names)."""
    reader = spark.readStream.schema(GOLD).option("basePath", gold_root)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(gold_root)


def start_history_stream(spark: SparkSession, gold_root: str, history_root: str,
                         checkpoint: str | None = None, available_now: bool = True,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start copying new Gold snapshots into History; returns the query."""
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/history_stream"

    def replace_dates(batch: DataFrame, _batch_id: int) -> None:
        changed = batch.select("date_scraping").distinct()      # a few dates
        whole = read_gold(batch.sparkSession, gold_root, required=False) \
            .join(changed, "date_scraping", "left_semi")
        write_history(whole.select(*GOLD_COLUMNS), history_root)

    writer = (gold_stream(spark, gold_root, max_files_per_trigger).writeStream
              .foreachBatch(replace_dates)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def historize_available(spark: SparkSession, gold_root: str, history_root: str,
                        checkpoint: str | None = None,
                        max_files_per_trigger: int | None = None) -> None:
    """Process every Gold file not yet historised, then return."""
    query = start_history_stream(spark, gold_root, history_root, checkpoint, available_now=True,
                                 max_files_per_trigger=max_files_per_trigger)
    query.awaitTermination()
