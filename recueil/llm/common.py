"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recueil.session import shared_dir

#: A word is a run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

#: Tables of at most so many rows (each a few short columns) are broadcast.
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; null is empty."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


#: Rows that go to Python at a time while a stored table is made: whole texts and
#: arrays are long.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


#: Paths of the tables stored within each open scratch, the innermost last.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Deletes the tables that are stored within, also after a failure.

    What outlasts them is stored by the function it gives, which makes the table
    the caller's.
    """
    own: list[str] = []
    outer = _open.get()
    token = _open.set((*outer, own))

    def kept(df: DataFrame, name: str) -> DataFrame:
        inner = _open.set(outer)
        try:
            return stored(df, name)
        finally:
            _open.reset(inner)

    try:
        yield kept
    finally:
        _open.reset(token)
        for path in own:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read from there.

    Cuts the lineage: a lost executor costs a read, not the work before it.
    """
    spark = df.sparkSession
    path, before = shared_dir(spark, name), spark.conf.get(_BATCH)
    if _open.get():
        _open.get()[-1].append(path)
    spark.conf.set(_BATCH, str(BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row, however often it is used.

    A generator is a place the optimizer does not move expressions across.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def hidden(docs: DataFrame, names: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """The table with columns of these names (in any case) out of the way, and what
    selects its columns as they were."""
    taken = {x.lower() for x in names}
    away = {c: f"__{c}" for c in docs.columns if c.lower() in taken}
    return docs.withColumnsRenamed(away), [F.col(f"`{away.get(c, c)}`").alias(c) for c in docs.columns]


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a stored table for broadcast if it is counted to be short.

    A longer one is left to a shuffled join, where adaptive execution splits
    hot keys.
    """
    return F.broadcast(df) if df.count() <= rows else df
