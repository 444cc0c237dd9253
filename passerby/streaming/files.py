"""Probe files taken in as they come, each once."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from passerby.plans.refresh import publish_refresh
from passerby.session import cut_lineage, temporary_tables
from passerby.sources.probes import bad_probes, good_probes, stream_probe_files


def publish_files(spark: SparkSession, thresholds: DataFrame, root: str, name: str = "files",
                  then: Callable[[str], None] | None = None) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: publishes the files of a micro-batch as the run ``<name>-<number>``, its rejects beside it.

    A batch that failed comes again with the same files and the same number, so
    its run replaces what it had left. ``then`` is called with the run when it
    is published.
    """
    def publish(batch: DataFrame, batch_id: int) -> None:
        run = f"{name}-{batch_id:08d}"
        with temporary_tables(spark):
            # The text is parsed once.
            typed = cut_lineage(batch)
            publish_refresh(spark, good_probes(typed), thresholds, root, run)
            bad_probes(typed).write.mode("overwrite").json(f"{root}/rejects/{run}")
        if then is not None:
            then(run)

    return publish


def ingest_files(spark: SparkSession, source: str, thresholds: DataFrame, root: str, checkpoint: str, files_per_batch: int = 10_000,
                 every: str | None = None, name: str = "files", then: Callable[[str], None] | None = None) -> DataStreamWriter:
    """A writer that publishes the probe files under ``source`` that no earlier run of this checkpoint has taken.

    Which files were taken lies in the checkpoint. Without ``every`` it takes
    what is there and stops: the nightly job. Each checkpoint of a root needs a
    ``name`` of its own.
    """
    lines = stream_probe_files(spark, source, files_per_batch)
    writer = lines.writeStream.foreachBatch(publish_files(spark, thresholds, root, name, then)).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
