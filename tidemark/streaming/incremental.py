"""Incremental ingestion: the stream finds new files, the batch plan takes all that are not done.

Micro-batches only note arrivals, so how many files are in one has no influence on the result. What
is taken are the files noted and not marked as processed: those that failed before are tried again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.ingest import IngestConfig, IngestResult, ingest_files
from tidemark.sources.files import logical_name
from tidemark.state import manifest

FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
ARRIVALS = "path STRING, source_file STRING"


def stream_files(spark: SparkSession, source: str, config: IngestConfig, max_files: int = 1000) -> DataFrame:
    """New files of a folder as a stream of names; their content is not read. Files of any age count."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", f"*{config.suffix}")
        .option("recursiveFileLookup", str(config.recursive).lower())
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", "36500d")
        .load(source)
        .select("path", logical_name(F.col("path"), config.name_pattern).alias("source_file"))
    )


@dataclass(frozen=True)
class IncrementalRun:
    """A search for new files that has been started."""

    spark: SparkSession
    config: IngestConfig
    search: StreamingQuery

    def awaitTermination(self) -> IngestResult:  # noqa: N802
        """Wait until all new files are noted, then take every noted file that is not done."""
        self.search.awaitTermination()
        arrived = manifest.read_or_empty(self.spark, self.config.path("state/arrivals"), ARRIVALS).select("path", "source_file").distinct()
        events = manifest.load(self.spark, self.config.path("state/manifest"))
        left = manifest.pending(arrived, events).collect()
        return ingest_files(self.spark, {r.path: r.source_file for r in left}, self.config)


def start_ingest(
    spark: SparkSession,
    source: str,
    config: IngestConfig,
    *,
    max_files: int = 1000,
    after: Callable[[int], None] | None = None,
) -> IncrementalRun:
    """Note all files that are new since the last call, ``max_files`` at a time; the run takes them.

    A micro-batch that is replayed replaces its own note.
    """

    def note(batch: DataFrame, number: int) -> None:
        named = batch.select("path", "source_file", F.lit(number).alias("batch"))
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(
            config.path("state/arrivals")
        )
        if after:
            after(number)

    search = (
        stream_files(spark, source, config, max_files)
        .writeStream.foreachBatch(note)
        .option("checkpointLocation", config.path("state/stream"))
        .trigger(availableNow=True)
        .start()
    )
    return IncrementalRun(spark, config, search)
