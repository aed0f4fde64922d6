"""Embedding generation through a user-supplied batch function."""

from __future__ import annotations

import hashlib
import re
import time
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as t

from recueil.functions.text import excerpt, not_blank
from recueil.functions.vectors import counted_codes, feature_words, word_codes
from recueil.operators.merge import append_vectors, replace_vectors, without_vector
from recueil.session import settled

#: ``fn(texts)`` returns one vector per text, or ``(vectors, token_counts)``.
EmbedFn = Callable[[list[str]], "Sequence[Sequence[float]] | tuple[Sequence[Sequence[float]], Sequence[int]]"]

#: Rows that are Python objects at a time, about.
SLICE_ROWS = 256

_WORD = re.compile(r"\w+")


def hashing_embedder(dimension: int = 256) -> EmbedFn:
    """A deterministic embedder that needs no service: signed word hashing."""

    def embed_texts(texts: list[str]):
        vectors = np.zeros((len(texts), dimension), dtype=np.float32)
        tokens = []
        for row, text in enumerate(texts):
            words = [w.encode() for w in _WORD.findall(text.lower())]
            tokens.append(len(words))
            if words:
                codes = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
                signs = np.where(codes >> np.uint32(31), 1.0, -1.0)
                np.add.at(vectors[row], codes % dimension, signs)
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        return vectors / np.where(norms == 0, 1, norms), tokens

    return embed_texts


_FEATURE = re.compile(r"[a-z0-9\u00e0-\u00ff]+")


def feature_embedder(dimension: int = 256) -> EmbedFn:
    """The vectors of :func:`embed_features`, for what wants a function."""

    def embed_texts(texts: list[str]):
        vectors = np.zeros((len(texts), dimension), dtype=np.float32)
        tokens = []
        for row, text in enumerate(texts):
            words = _FEATURE.findall(text.lower())
            tokens.append(len(words))
            for word in words:
                digits = hashlib.md5(word.encode()).hexdigest()
                vectors[row, int(digits[:4], 16) % dimension] += 1 if int(digits[4], 16) < 8 else -1
        return vectors, tokens

    return embed_texts


def embed_features(df: DataFrame, text: str = "texte_complet", dimension: int = 256) -> DataFrame:
    """Adds what :func:`embed` adds, by feature hashing in native expressions.

    It needs no service and no Python; the vectors are whole numbers, and the same
    in every engine with MD5.
    """
    if text not in df.columns:
        raise KeyError(f"no column {text!r}; available: {df.columns}")
    cleaned = clean_text(df, text)
    # Columns of their own, so that a text is taken apart and its words hashed once.
    coded = df.withColumn("_words", feature_words(cleaned)).withColumn("_codes", word_codes(F.col("_words"), dimension))
    return coded.withColumns({
        "embedding": counted_codes(F.col("_codes"), dimension), "tokens": F.size("_words").cast("bigint"),
        "embed_error": F.lit(None).cast("string"), "text_digest": F.sha2(cleaned, 256),
    }).drop("_words", "_codes")


def clean_text(df: DataFrame, column: str) -> Column:
    """The column as text: null and NaN become ``''``."""
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (t.FloatType, t.DoubleType)):
        c = F.when(~F.isnan(c), c)
    return F.coalesce(c.cast("string"), F.lit(""))


def blank_texts(df: DataFrame, column: str = "texte_complet") -> DataFrame:
    """One row ``total, blank`` of the texts to embed."""
    text = clean_text(df, column)
    return df.agg(F.count("*").alias("total"), F.count_if(~not_blank(text)).alias("blank"))


def slices(batches: Iterator[pa.RecordBatch], batch_size: int) -> Iterator[pa.RecordBatch]:
    """Short pieces of record batches, each of whole slices of ``batch_size`` rows
    but the last, so that few texts are Python objects at a time."""
    step = batch_size * max(1, SLICE_ROWS // batch_size)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def embed(
    df: DataFrame,
    fn: EmbedFn,
    text: str = "texte_complet",
    batch_size: int = 10,
    delay: float = 0.0,
    attempts: int = 3,
    backoff: float = 2.0,
    tasks: int | None = None,
    zero_dimension: int | None = None,
) -> DataFrame:
    """Adds ``embedding, tokens, embed_error, text_digest`` to every row.

    Texts go to ``fn`` in slices of ``batch_size`` with ``delay`` seconds in
    between; a failing slice is tried ``attempts`` times, waiting ``backoff``
    seconds and twice as long each further time, and then marked as failed
    instead of failing the job.  Failed rows have a null vector, or zeros if
    ``zero_dimension`` is given.  ``tasks`` spreads the rows evenly over so many
    tasks; pauses hold per task, so it also bounds the total call rate.  A task
    lost with its executor runs again, hence ``fn`` must give the same vector
    for the same text.
    """
    if text not in df.columns:
        raise KeyError(f"no column {text!r}; available: {df.columns}")
    if batch_size < 1 or attempts < 1:
        raise ValueError("batch_size and attempts must be at least 1")

    # A text column goes to Python once, anything else as text beside it.
    plain = isinstance(df.schema[text].dataType, t.StringType)
    cleaned = df if plain else df.withColumn("_text", clean_text(df, text))
    cleaned = cleaned.withColumn("text_digest", F.sha2(clean_text(df, text), 256))
    if tasks:
        cleaned = cleaned.repartition(tasks)

    def call(texts: list[str]):
        for attempt in range(attempts):
            try:
                result = fn(texts)
                vectors, tokens = result if isinstance(result, tuple) else (result, [None] * len(texts))
                if len(vectors) != len(texts):
                    raise ValueError(f"{len(vectors)} vectors for {len(texts)} texts")
                return list(np.asarray(vectors, dtype=np.float32)), list(tokens), None
            except Exception as error:  # whatever the user function raises is data
                message = str(error)
                if attempt + 1 < attempts:
                    time.sleep(backoff * 2**attempt)
        zeros = None if zero_dimension is None else np.zeros(zero_dimension, dtype=np.float32)
        return [zeros] * len(texts), [None] * len(texts), message

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        called = False
        for batch in slices(batches, batch_size):
            texts = [x or "" for x in batch.column(text if plain else "_text").to_pylist()]
            vectors, tokens, errors = [], [], []
            for start in range(0, len(texts), batch_size):
                if called and delay:
                    time.sleep(delay)
                called = True
                part = texts[start : start + batch_size]
                v, n, error = call(part)
                vectors += v
                tokens += n
                errors += [error] * len(part)
            columns = batch if plain else batch.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays(
                [
                    *columns.columns,
                    pa.array(vectors, pa.list_(pa.float32())),
                    pa.array(tokens, pa.int64()),
                    pa.array(errors, pa.string()),
                ],
                names=[*columns.schema.names, "embedding", "tokens", "embed_error"],
            )

    kept = cleaned.drop("_text").schema
    schema = t.StructType([
        *kept.fields,
        t.StructField("embedding", t.ArrayType(t.FloatType())),
        t.StructField("tokens", t.LongType()),
        t.StructField("embed_error", t.StringType()),
    ])
    return cleaned.mapInArrow(run, schema)


def vector_metadata(df: DataFrame, position: str, columns: Sequence[str] = ("titre", "ville", "date_debut", "url")) -> DataFrame:
    """Metadata of a vector: missing text is ``''``, a missing id the position."""

    def value(name: str, default: Column) -> Column:
        if name not in df.columns:
            return default.alias(name)
        c = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (t.FloatType, t.DoubleType)):
            c = F.when(~F.isnan(c), c)
        return F.coalesce(c.cast("string"), default).alias(name)

    return df.select(
        value("id", F.col(position).cast("string")),
        *[value(c, F.lit("")) for c in columns],
        F.col(position).alias("index"),
    )


def embedding_errors(embedded: DataFrame, position: str, text: str = "texte_complet") -> DataFrame:
    """Failed rows as ``index, texte, erreur`` with shortened texts."""
    return embedded.filter("embed_error IS NOT NULL").select(
        F.col(position).alias("index"),
        excerpt(clean_text(embedded, text)).alias("texte"),
        F.col("embed_error").alias("erreur"),
    )


def embedding_stats(embedded: DataFrame, batch_size: int = 10, model: str | None = None, total_time: float | None = None) -> DataFrame:
    """Figures of a run; the wall time is the caller's to measure."""
    seconds = F.lit(total_time).cast("double")
    n = F.count("*")
    return embedded.agg(
        n.alias("total_events"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens"),
        seconds.alias("total_time"),
        F.when(n > 0, F.lit(total_time).cast("double") / n).alias("temps_moyen"),
        F.count_if(F.col("embed_error").isNotNull()).alias("errors"),
        F.lit(batch_size).alias("batch_size"),
        F.max(F.when(F.col("embed_error").isNull(), F.size("embedding"))).alias("dimension"),
        n.alias("nombre_embeddings"),
        F.lit(model).cast("string").alias("modele"),
    )


def check_embedded(embedded: DataFrame) -> None:
    """Raises if there are rows and every one of them failed."""
    row = embedded.agg(F.count("*").alias("n"), F.count_if(F.col("embed_error").isNotNull()).alias("bad")).first()
    if row["n"] and row["n"] == row["bad"]:
        raise RuntimeError(f"all {row['n']} texts failed to embed")


def embed_new(
    events: DataFrame, vectors: DataFrame | None, fn: EmbedFn, text: str = "texte_complet", reembed: str = "new", **options
) -> DataFrame:
    """The vector table after embedding what has no (current) vector yet.

    Rows that failed before are tried again.  The fresh vectors are written once,
    so each text goes to ``fn`` once.
    """
    if vectors is None:
        return embed(events, fn, text, **options)
    if "embed_error" in vectors.columns:
        vectors = vectors.filter("embed_error IS NULL")
    fresh = settled(embed(without_vector(events, vectors, reembed, text), fn, text, **options))
    return replace_vectors(vectors, fresh) if reembed == "changed" else append_vectors(vectors, fresh)
