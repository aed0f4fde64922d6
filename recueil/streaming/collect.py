"""Landed pages to the versioned raw table, one micro-batch at a time.

The stream's checkpoint is the cursor: a batch that fails is taken again, and
the journal tells whether it was finished before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from recueil import schemas
from recueil.sources import landing, versions


def _stream(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return lines.select("value", landing.landed_file().alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _run(stream: DataFrame, handle, checkpoint: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def merge_lines(
    spark: SparkSession, path: str, root: str, checkpoint: str, files_per_batch: int = 1000, **options
) -> StreamingQuery:
    """Merges landed JSON Lines, one event per line."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        events = batch.filter(F.length(F.trim("value")) > 0).withColumnRenamed("value", "payload")
        versions.integrate(
            batch.sparkSession, root, events, source_id=checkpoint, batch_id=batch_id, skip_empty=True, **options
        )

    return _run(_stream(spark, path, files_per_batch), handle, checkpoint)


def merge_event_pages(
    spark: SparkSession, path: str, root: str, checkpoint: str, limit: int | None = None,
    files_per_batch: int = 1000, **options,
) -> StreamingQuery:
    """Merges all events of captured pages, or up to ``limit`` of each page.

    What is merged does not depend on how the files are dealt into batches.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        page_rows = landing.pages(batch, schemas.EVENT_PAGE)
        events = landing.page_events(page_rows, limit).select("payload", "seq")
        versions.integrate(
            batch.sparkSession, root, events, source_id=checkpoint, batch_id=batch_id, skip_empty=True, **options
        )

    return _run(_stream(spark, path, files_per_batch), handle, checkpoint)


def follow_agenda_pages(spark: SparkSession, path: str, root: str, checkpoint: str, files_per_batch: int = 1) -> StreamingQuery:
    """Saves the cursor after every batch of captured agenda pages.

    A cursor is committed once per batch, so a batch that is taken again after a
    failure does not count twice.  A page without agendas is no end of the list
    and leaves the cursor alone; a page with agendas and without a cursor ends
    the list, and the next collection starts from the beginning.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        page_rows = landing.pages(batch, schemas.AGENDA_PAGE).filter(F.size("agendas") > 0)
        if page_rows.isEmpty():
            return
        cursor = landing.next_cursor(page_rows).first()
        versions.write_cursor(
            batch.sparkSession, root, cursor["curseur_after"], cursor["nb_agendas_session"], cursor["total_agendas_api"],
            source_id=checkpoint, batch_id=batch_id,
        )

    return _run(_stream(spark, path, files_per_batch), handle, checkpoint)


def collect(spark: SparkSession, pages: str, root: str, checkpoint: str, **options) -> DataFrame:
    """Takes everything landed below ``pages/agendas`` and ``pages/events``
    and returns the journal."""
    queries = [
        follow_agenda_pages(spark, f"{pages}/agendas", root, f"{checkpoint}/agendas"),
        merge_event_pages(spark, f"{pages}/events", root, f"{checkpoint}/events", **options),
    ]
    for query in queries:
        query.awaitTermination()
    return versions.journal(spark, root)
