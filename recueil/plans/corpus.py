"""From raw events to a searchable corpus."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from recueil.operators.clean import clean_events, extract_events
from recueil.operators.embed import EmbedFn, check_embedded, embed_new
from recueil.operators.merge import append_vectors, unmatched_keys
from recueil.operators.search import VectorIndex, build_index
from recueil.session import settled
from recueil.sources import tables


def clean_corpus(events: DataFrame, base_url: str, order: str = "seq", fallback: str = "presence") -> DataFrame:
    """Raw events (``payload`` and an order column) as clean events."""
    return clean_events(extract_events(events, base_url, order=order, fallback=fallback), order).drop(order)


def refresh_vectors(
    spark: SparkSession, clean: DataFrame, root: str, version: str, fn: EmbedFn, previous: str | None = None,
    reembed: str = "new", **options,
) -> DataFrame:
    """Embeds what is new, writes a complete vector version and returns it."""
    stored = None if previous is None else tables.read_vectors(spark, f"{root}/embeddings/versions/{previous}")
    path = f"{root}/embeddings/versions/{version}"
    tables.write_vectors(embed_new(clean, stored, fn, reembed=reembed, **options), path)
    vectors = tables.read_vectors(spark, path)
    check_embedded(vectors)
    return vectors


def as_index_input(vectors: DataFrame) -> DataFrame:
    """The vector table with the names the index uses."""
    return tables.as_hits(vectors).withColumnRenamed("id", "vec_id")


PUBLISHED = "version STRING, number INT"


def _published(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(PUBLISHED).option("recursiveFileLookup", True).json(f"{root}/vectorstore/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLISHED)


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Makes a saved index the one in use.

    The pointer is one small file that is written once the index loads; readers
    see the old version or the new one, and older versions stay.
    """
    tables.load_index(spark, f"{root}/vectorstore/versions/{version}")
    number = (_published(spark, root).agg(F.max("number").alias("n")).first()["n"] or 0) + 1
    one = spark.createDataFrame([(version, number)], PUBLISHED).coalesce(1)
    one.write.mode("errorifexists").json(f"{root}/vectorstore/published/entry-{number:06d}")


def published_index(spark: SparkSession, root: str) -> VectorIndex:
    """The index in use."""
    newest = _published(spark, root).orderBy(F.desc("number")).limit(1).collect()
    if not newest:
        raise FileNotFoundError(f"no index is published below {root}")
    return tables.load_index(spark, f"{root}/vectorstore/versions/{newest[0]['version']}")


def publish_index(spark: SparkSession, vectors: DataFrame, root: str, version: str, method: str = "flat_l2", **options) -> VectorIndex:
    """Builds the index anew as its own version, publishes and loads it."""
    path = f"{root}/vectorstore/versions/{version}"
    tables.save_index(build_index(as_index_input(vectors), method, **options), path)
    publish(spark, root, version)
    return published_index(spark, root)


def write_processed(clean: DataFrame, root: str, version: str) -> bool:
    """Writes clean events as a version of their own (see :func:`tables.write_clean`)."""
    return tables.write_clean(clean, f"{root}/processed/versions/{version}")


def integrate_vectors(
    spark: SparkSession, existing: DataFrame | None, vectors: DataFrame, metadata: DataFrame, root: str, version: str,
    method: str = "flat_l2", key: str = "id",
) -> VectorIndex:
    """Adds vectors that come apart from their metadata, rebuilds the index and
    publishes it; until then the old one stays in use."""
    if not unmatched_keys(vectors, metadata, key).isEmpty():
        raise ValueError("vectors and metadata have different keys")
    fresh = settled(vectors.join(metadata, key))
    path = f"{root}/embeddings/versions/{version}"
    append_vectors(existing, fresh, key).write.mode("errorifexists").parquet(f"{path}/vectors")
    merged = tables.read_vectors(spark, path).withColumnRenamed(key, "vec_id")
    index_path = f"{root}/vectorstore/versions/{version}"
    tables.save_index(build_index(merged, method), index_path)
    publish(spark, root, version)
    return published_index(spark, root)
