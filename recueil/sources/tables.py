"""Readers and writers of the clean, vector and index tables."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from recueil import schemas
from recueil.operators.embed import embedding_errors, embedding_stats
from recueil.operators.profile import statistics_document
from recueil.operators.search import VectorIndex

_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
_CSV_OUT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

#: A saved index: what it is, and the parts that belong to it.
INDEX = (
    "method STRING, dimension INT, bucket_length DOUBLE, tables INT, seed INT, has_centroids BOOLEAN, has_metadata BOOLEAN, "
    "entry INT, parts ARRAY<INT>"
)


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    """Clean events from CSV, every column text.

    CSV cannot tell a missing value from an empty one; both read as ``''``.
    """
    events = spark.read.options(**_CSV).csv(path)
    missing = {"id", "texte_complet"} - set(events.columns)
    if missing:
        raise ValueError(f"{path} lacks the columns {sorted(missing)}")
    return events.fillna("")


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Clean events from Parquet."""
    return spark.read.schema(schemas.CLEAN).parquet(path)


def write_clean(clean: DataFrame, path: str) -> bool:
    """Writes ``parquet``, ``csv``, ``json`` and ``statistics`` below ``path``.

    Returns False and writes nothing more if there are no rows.  The plan runs
    once, for the Parquet table; the other forms are made from that.
    """
    clean.select(*schemas.CLEAN_COLUMNS).write.mode("errorifexists").parquet(f"{path}/parquet")
    stored = read_clean(clean.sparkSession, f"{path}/parquet")
    if stored.isEmpty():
        return False
    stored.write.options(**_CSV_OUT).csv(f"{path}/csv")
    stored.write.option("ignoreNullFields", False).json(f"{path}/json")
    statistics_document(stored).write.json(f"{path}/statistics")
    return True


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The vector table: one row holds vector and metadata."""
    return spark.read.parquet(f"{path}/vectors")


def write_vectors(embedded: DataFrame, path: str, position: str = "id", text: str = "texte_complet", **figures) -> None:
    """Writes ``vectors``, ``stats`` and, if any row failed, ``errors``."""
    embedded.write.mode("errorifexists").parquet(f"{path}/vectors")
    stored = read_vectors(embedded.sparkSession, path)
    embedding_stats(stored, **figures).write.json(f"{path}/stats")
    errors = embedding_errors(stored, position, text)
    if not errors.isEmpty():
        errors.write.json(f"{path}/errors")


def _part(path: str, kind: str, part: int) -> str:
    return f"{path}/{kind}/part={part:06d}"


def _write_part(index: VectorIndex, path: str, part: int) -> None:
    """Vectors, buckets and metadata of one part, overwriting what a lost run
    left behind.

    The rebalance hint gives every cell few files and splits a large cell.
    """
    writer = index.vectors.write
    if index.centroids is not None:
        writer = index.vectors.hint("rebalance", "cell").write.partitionBy("cell")
    writer.mode("overwrite").parquet(_part(path, "vectors", part))
    if index.buckets is not None:
        placed = index.buckets.hint("rebalance", "part").sortWithinPartitions("part", "cell")
        placed.write.mode("overwrite").partitionBy("part").parquet(_part(path, "buckets", part))
    if index.metadata is not None:
        index.metadata.write.mode("overwrite").parquet(_part(path, "metadata", part))


def _manifest(spark: SparkSession, path: str, entry: int | None = None) -> Row:
    """The newest entry of the manifest, or the one asked for."""
    entries = spark.read.schema(INDEX).option("recursiveFileLookup", True).json(f"{path}/manifest")
    if entry is not None:
        entries = entries.filter(F.col("entry") == entry)
    newest = entries.orderBy(F.desc("entry")).limit(1).collect()
    if not newest:
        raise FileNotFoundError(f"no index at {path}")
    return newest[0]


def _commit_index(index: VectorIndex, path: str, entry: int, parts: list[int]) -> None:
    """Names the parts of the index in a new entry of the manifest.

    Nothing written for it is seen before; an entry that another writer made in the
    meantime is not overwritten but raises.
    """
    facts = (
        index.method, index.dimension, index.bucket_length, index.tables, index.seed,
        index.centroids is not None, index.metadata is not None, entry, parts,
    )
    one = index.spark.createDataFrame([facts], INDEX).coalesce(1)
    one.write.mode("errorifexists").json(f"{path}/manifest/entry-{entry:06d}")
    load_index(index.spark, path).stats().write.mode("overwrite").json(f"{path}/stats")


def save_index(index: VectorIndex, path: str) -> None:
    """Writes the index; clustered vectors are stored per cell, hashed ones with
    their buckets.  It exists once its manifest is written."""
    if index.centroids is not None:
        index.centroids.write.mode("errorifexists").parquet(f"{path}/centroids")
    _write_part(index, path, 1)
    _commit_index(index, path, 1, [1])


def load_index(spark: SparkSession, path: str, entry: int | None = None) -> VectorIndex:
    """An index as saved, with all parts that were added to it, or as it was at an
    earlier entry of its manifest; raises if there is none."""
    facts = _manifest(spark, path, entry)

    def parts(kind: str) -> DataFrame:
        read = spark.read.option("basePath", f"{path}/{kind}")
        return read.parquet(*[_part(path, kind, x) for x in facts["parts"]])

    # The part of a bucket is that of its cell; the folder of the manifest is no column.
    vectors = parts("vectors").drop("part")
    buckets = None
    if facts["method"] == "lsh":
        each = [spark.read.parquet(_part(path, "buckets", x)) for x in facts["parts"]]
        buckets = reduce(DataFrame.unionByName, each)
    return VectorIndex(
        vectors,
        facts["method"],
        facts["dimension"],
        spark.read.parquet(f"{path}/centroids") if facts["has_centroids"] else None,
        parts("metadata").drop("part") if facts["has_metadata"] else None,
        facts["bucket_length"],
        facts["tables"],
        facts["seed"],
        buckets,
    )


def append_to_index(spark: SparkSession, path: str, vectors: DataFrame, metadata: DataFrame | None = None) -> None:
    """Adds vectors to a saved index without rewriting it.

    Vectors, buckets and metadata are written as a part of their own, which the
    manifest then names.  An append that fails on the way leaves the index as it
    was, and its part is overwritten by the next one.
    """
    facts = _manifest(spark, path)
    index = load_index(spark, path)
    # Only the new rows: the saved index without its vectors, plus the new ones.
    empty = replace(
        index, vectors=index.vectors.limit(0), metadata=None if index.metadata is None else index.metadata.limit(0),
        buckets=None if index.buckets is None else index.buckets.limit(0),
    )
    part = facts["entry"] + 1
    _write_part(empty.add(vectors, metadata), path, part)
    _commit_index(index, path, part, [*facts["parts"], part])


def with_current_text(events: DataFrame, vectors: DataFrame) -> DataFrame:
    """Vectors next to the full clean row of the same id."""
    return vectors.select("id", "embedding").join(events, "id")


def as_hits(events: DataFrame) -> DataFrame:
    """Clean events with the names prompts and documents use."""
    return events.withColumns({"lieu_nom": F.col("adresse"), "categorie": F.col("categories")})
