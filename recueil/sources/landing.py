"""Landed records: JSON Lines, JSON array files and captured page payloads.

Fetching is the user's business.  What it brings lands as text files, one page
payload per line, below a folder every executor can read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from recueil import schemas
from recueil.sources import arrays

# How much one collection run takes.
AGENDAS_PER_PAGE = 20
EVENTS_PER_AGENDA = 30

#: Parts a group is cut into where a limit is too large to apply early.
GROUP_PARTS = 64

_PLACE = "value STRING, file STRUCT<place: STRING, path: STRING>, block BIGINT"


def landed_file() -> Column:
    """The file of a text row, sortable (see :func:`arrays.file_order`)."""
    return arrays.file_order(F.col("_metadata.file_path"))


def source_order() -> Column:
    """Sortable landing order of rows that carry ``file`` and ``block``."""
    return F.struct("file", "block", F.monotonically_increasing_id().alias("at"))


def _text(spark: SparkSession, path: str, **options) -> DataFrame:
    """Text rows with the place they come from; a missing path has no rows."""
    try:
        lines = spark.read.text(path, **options)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _PLACE)
    return _placed(lines)


def _placed(lines: DataFrame) -> DataFrame:
    return lines.select("value", landed_file().alias("file"), F.col("_metadata.file_block_start").alias("block"))


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw events, one JSON document per line: ``payload, seq``."""
    lines = _text(spark, path).filter(F.length(F.trim("value")) > 0)
    return lines.select(F.col("value").alias("payload"), source_order().alias("seq"))


def raw_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Raw events of files that each hold one JSON array: ``payload, seq``.

    Content that is no array gives no rows; an element that is no object is
    kept as text, so that it can be quarantined, and one that is no JSON is left
    out.  A file of any size is cut into blocks that are read side by side (see
    :mod:`recueil.sources.arrays`).
    """
    return arrays.array_elements(spark, path)


def pages(lines: DataFrame, schema: str) -> DataFrame:
    """Text rows parsed as page payloads."""
    page = F.explode(F.array(F.from_json("value", schema))).alias("page")
    line = F.monotonically_increasing_id().alias("line")
    return lines.select("file", "block", "value", line).select("file", "block", "line", page).select(
        "file", "block", "line", "page.*"
    )


def agenda_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured agenda pages: ``file, block, line, agendas, after, total``."""
    return pages(_text(spark, path), schemas.AGENDA_PAGE)


def event_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured event pages: ``file, block, line, agenda_uid, events``."""
    return pages(_text(spark, path), schemas.EVENT_PAGE)


def agendas(page_rows: DataFrame, limit: int = 50) -> DataFrame:
    """The first ``limit`` agendas of every page: ``uid, title``."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    listed = page_rows.select(F.posexplode("agendas").alias("at", "agenda"))
    return listed.filter(F.col("at") < limit).select("agenda.uid", "agenda.title")


def next_cursor(page_rows: DataFrame) -> DataFrame:
    """Cursor after the last page: ``curseur_after, nb_agendas_session,
    total_agendas_api``; a null cursor means the list ended."""
    ordered = page_rows.withColumn("_seq", F.struct("file", "block", "line"))
    return ordered.agg(
        F.max_by("after", "_seq").alias("curseur_after"),
        F.coalesce(F.sum(F.coalesce(F.size("agendas"), F.lit(0))), F.lit(0)).cast("int").alias("nb_agendas_session"),
        F.coalesce(F.max_by("total", "_seq"), F.lit(0)).cast("int").alias("total_agendas_api"),
    )


def with_uid(agenda_rows: DataFrame) -> DataFrame:
    """Agendas that have a uid; the others cannot be asked for events."""
    return agenda_rows.filter("uid IS NOT NULL AND uid <> ''")


def first_per_group(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows per key.

    For n up to 1000 Spark applies the limit before the shuffle as well, so a
    hot group costs n rows per task.  Beyond that, every group is first cut
    into parts by a hash of its order, each limited on its own.
    """
    if n < 1:
        raise ValueError("the limit must be at least 1")
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)

    def limited(rows: DataFrame, *groups: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*orders))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")

    if n > 1000:
        parts = df.withColumn("_part", F.pmod(F.xxhash64(*orders), F.lit(GROUP_PARTS)))
        df = limited(parts, *keys, "_part").drop("_part")
    return limited(df, *keys)


def events_of(agenda_rows: DataFrame, event_page_rows: DataFrame, limit: int = EVENTS_PER_AGENDA) -> DataFrame:
    """Up to ``limit`` raw events of every agenda: ``agenda_uid, payload, seq``."""
    wanted = with_uid(agenda_rows).select(F.col("uid").alias("_asked")).distinct()
    # Limited first, joined by a copy of the key the optimizer does not move
    # below the limit: an agenda with very many pages joins with few rows.
    few = first_events(event_page_rows.withColumn("_asked", F.col("agenda_uid")), limit, "_asked")
    return few.join(wanted, "_asked", "left_semi").drop("_asked")


def page_events(event_page_rows: DataFrame, limit: int | None = None) -> DataFrame:
    """All raw events of all pages, or up to ``limit`` of each page: ``agenda_uid,
    payload, seq``.  Pages count apart, so batches of them give the same rows."""
    if limit is not None and limit < 1:
        raise ValueError("the limit must be at least 1")
    asked = with_uid(event_page_rows.withColumnRenamed("agenda_uid", "uid")).withColumnRenamed("uid", "agenda_uid")
    listed = asked.select("agenda_uid", "file", "block", "line", F.posexplode("events").alias("item", "payload"))
    kept = listed if limit is None else listed.filter(F.col("item") < limit)
    at = F.struct("line", "item").alias("at")
    return kept.select("agenda_uid", "payload", F.struct("file", "block", at).alias("seq"))


def first_events(event_page_rows: DataFrame, limit: int = EVENTS_PER_AGENDA, *kept: str) -> DataFrame:
    """Up to ``limit`` (at least 1) raw events per agenda, in landing order.

    ``kept`` names page columns to carry along.
    """
    if limit < 1:
        raise ValueError("the limit must be at least 1")
    asked = with_uid(event_page_rows.withColumnRenamed("agenda_uid", "uid")).withColumnRenamed("uid", "agenda_uid")
    # No later item of a page, and no later page with items, can be among the first
    # of its agenda.  Pages are limited before they are taken apart.
    listed = asked.select("agenda_uid", *kept, "file", "block", "line", F.slice("events", 1, limit).alias("events"))
    order = ["file", "block", "line"]
    few = first_per_group(listed.filter(F.size("events") > 0), "agenda_uid", order, limit)
    earlier = Window.partitionBy("agenda_uid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = few.withColumn("_before", F.coalesce(F.sum(F.size("events")).over(earlier), F.lit(0)))
    opened = counted.filter(F.col("_before") < limit).select(
        "agenda_uid", *kept, *order, "_before", F.posexplode("events").alias("item", "payload")
    )
    at = F.struct("line", "item").alias("at")
    return opened.filter(F.col("_before") + F.col("item") < limit).select(
        "agenda_uid", *kept, "payload", F.struct("file", "block", at).alias("seq")
    )


def events_of_agenda(event_page_rows: DataFrame, agenda_uid: str, limit: int = 50) -> DataFrame:
    """Up to ``limit`` raw events of one agenda: ``agenda_uid, payload, seq``."""
    if not agenda_uid:
        raise ValueError("agenda_uid must not be empty")
    one = event_page_rows.sparkSession.createDataFrame([(str(agenda_uid), None)], "uid STRING, title STRING")
    return events_of(one, event_page_rows, limit)


def collection_summary(agenda_rows: DataFrame, events: DataFrame, uid: str = "uid", event_agenda: str = "agenda_uid") -> DataFrame:
    """``agendas, agendas_avec_evenements, agendas_sans_uid, evenements``."""
    per_agenda = events.groupBy(F.col(event_agenda).alias("_uid")).agg(F.count("*").alias("_n"))
    key = F.nullif(F.col(uid).cast("string"), F.lit(""))
    seen = agenda_rows.groupBy(key.alias("_key")).agg(F.count("*").alias("_agendas"))
    joined = seen.join(per_agenda.withColumn("_uid", F.col("_uid").cast("string")), F.col("_key") == F.col("_uid"), "left")
    zero = F.lit(0).cast("bigint")
    return joined.agg(
        F.coalesce(F.sum("_agendas"), zero).alias("agendas"),
        F.coalesce(F.sum(F.when(F.col("_n") > 0, F.col("_agendas"))), zero).alias("agendas_avec_evenements"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_agendas"))), zero).alias("agendas_sans_uid"),
        F.coalesce(F.sum("_n"), zero).alias("evenements"),
    )
