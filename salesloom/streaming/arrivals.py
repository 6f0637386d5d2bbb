"""Start a day's run when its source files have arrived.

A file stream over the source folder notices new files by name and time and
never reads their contents; its progress folder remembers which it has seen.
A run starts once something is new and a whole set has arrived: all eight
sources are there, and the files of each are others than those of the last
ingest. Files of which only some have arrived start nothing. A run that failed
goes on where it stopped, by the record of its date.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from salesloom.plans.daily import Outcome, run_day
from salesloom.plans.manifest import Manifest, fingerprints
from salesloom.schemas import LAYOUT
from salesloom.sources.ingest import missing_sources

# The columns Spark gives for a file.
FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, source: str) -> DataFrame:
    """A stream with one row per file that appears under the source folder."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_COLUMNS)
        .option("recursiveFileLookup", "true")
        .load(source)
        .select("path", "modificationTime", "length")
    )


def run_on_arrival(
    spark: SparkSession,
    source: str,
    staging: str,
    results: str,
    progress: str,
    day: date | None = None,
    database: str | None = None,
    every: str | None = None,
    report: Callable[[list[Outcome]], None] = lambda outcomes: None,
    delivered: tuple[str, ...] = tuple(LAYOUT),
) -> StreamingQuery:
    """Watch the source folder and run whenever a complete set has new files.

    ``delivered`` are the tables that come anew with every set; tables that
    change seldom can be left out of it.

    Without ``every``, what is there now is looked at once and the query ends;
    with it, for example "5 minutes", the query goes on looking. ``day`` is the
    load date, by default that of the moment the run starts. ``progress`` is a
    folder that keeps what has been seen, on storage all executors share.
    """

    def start(files: DataFrame, _: int) -> None:
        if files.isEmpty() or missing_sources(spark, source):
            return
        now, last = fingerprints(spark, source), Manifest.last(spark, results).staged
        if any(now[table] == last.get(table) for table in delivered):
            return
        report(run_day(spark, source, staging, results, day or date.today(), database))

    writer = (
        arrivals(spark, source)
        .writeStream.foreachBatch(start)
        .option("checkpointLocation", progress)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
