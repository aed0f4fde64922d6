"""Mixing sources to target weights by hash thresholds.

Every document has a place in a fixed order given by a hash.  A source takes
its documents a whole number of times and once more those below a threshold.
The threshold is found from histograms of words by source and hash bucket; only
the bucket in which the budget ends is looked at more closely, twice.  Nothing
is sorted.  Only DataFrame functions are used.

Defined results: a null text has size 0; a null source is a source of its own,
the last one; rows with equal id and text share a place and are taken together;
sources without words have target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from recueil.llm.common import WORD, small, stored, whole_text

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3

#: Bits of the hash per histogram, and how many histograms are nested.
BITS = 12
LEVELS = 3


def place(key: str, text: str = "text") -> Column:
    """The first 36 bits of a digest of key and text, as a number."""
    whole = F.concat(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.lit(":"), whole_text(text))
    return F.conv(F.substring(F.md5(whole), 1, BITS * LEVELS // 4), 16, 10).cast("bigint")


def words(text: str = "text") -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("bigint")


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``key, source, size, place`` of every document."""
    return docs.select(key, F.col(f"`{source}`").alias("source"), words(text).alias("size"), place(key, text).alias("place"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``source, source_size, target``; one row per source.

    Weights repeat over the sources in code point order.  A target ends at
    ``most`` times its source; what is cut off goes to the others by weight.
    With sources ordered by cap per weight, the capped ones come first, so one
    running sum finds the common level at which nothing is above.
    """
    every = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = every.withColumn("_at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ranked.withColumns({
        "_weight": F.element_at(listed, (F.pmod(F.col("_at") - 1, F.lit(len(weights))) + 1).cast("int")),
        "_cap": (most * F.col("source_size")).cast("double"),
    })
    filled = Window.orderBy(F.col("_cap") / F.col("_weight"), "_at")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    left = F.sum("_weight").over(Window.partitionBy()) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    # The level if this source and all later ones shared what is left.
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / left
    levelled = weighed.withColumn("_level", level).withColumn("_fits", F.col("_level") * F.col("_weight") <= F.col("_cap"))
    shared = F.min_by("_level", F.when(F.col("_fits"), F.struct(F.col("_cap") / F.col("_weight"), F.col("_at")))).over(
        Window.partitionBy()
    )
    target = F.least(F.col("_cap"), F.coalesce(shared, F.lit(0.0)) * F.col("_weight"))
    return levelled.select("source", "source_size", target.alias("target"))


def _bucket(level: int) -> Column:
    shift = BITS * (LEVELS - 1 - level)
    return F.pmod(F.shiftright("place", shift), F.lit(1 << BITS))


def thresholds(sizes: DataFrame, aims: DataFrame) -> DataFrame:
    """Adds ``whole`` and ``cut``: a document of the source is taken ``whole``
    times, and once more if its place is below ``cut``."""
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = stored(
        aims.withColumn("whole", ratio.cast("bigint")).withColumns({
            "rest": F.col("target") - F.col("whole") * F.col("source_size"),
            "prefix": F.lit(0).cast("bigint"),
        }),
        "mix_targets",
    )
    for level in range(LEVELS):
        # Words by bucket, of the boundary bucket found before.
        inside = sizes.withColumn("_prefix", F.shiftright("place", BITS * (LEVELS - level)))
        wanted = state.select(F.col("source").alias("_source"), F.col("prefix").alias("_wanted"))
        same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_prefix") == F.col("_wanted"))
        histogram = (
            inside.join(small(wanted), same, "left_semi")
            .groupBy("source", _bucket(level).alias("bucket"))
            .agg(F.sum("size").alias("words"))
        )
        running = Window.partitionBy("source").orderBy("bucket")
        cumulated = histogram.withColumn("upto", F.sum("words").over(running))
        budget = state.select(F.col("source").alias("_source"), "rest")
        met = cumulated.join(small(budget), F.col("source").eqNullSafe(F.col("_source")))
        # The bucket in which the budget ends, the last one if it never does.
        ends = met.groupBy("source").agg(
            F.min(F.when(F.col("upto") > F.col("rest"), F.struct("bucket", "upto", "words"))).alias("first"),
            F.max(F.struct("bucket", "upto", "words")).alias("last"),
        )
        end = ends.select(F.col("source").alias("_source"), F.coalesce("first", "last").alias("end"))
        joined = state.join(end, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
        found = joined.withColumns({
            "prefix": F.shiftleft("prefix", BITS) + F.coalesce(F.col("end.bucket"), F.lit(0)),
            "rest": F.col("rest") - F.coalesce(F.col("end.upto") - F.col("end.words"), F.lit(0)),
            "words": F.coalesce(F.col("end.words"), F.lit(0)),
        })
        state = stored(found.drop("end", *(["words"] if level < LEVELS - 1 else [])), "mix_level")
    # The last bucket, hardly ever more than one document, if that is nearer.
    cut = F.col("prefix") + F.when(2 * F.col("rest") >= F.col("words"), 1).otherwise(0)
    return state.select("source", "source_size", "target", "whole", cut.alias("cut"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``key, source, size, source_size, target, taken`` of every document."""
    sizes = stored(sized(docs, key, text, source), "mix_sizes")
    cuts = thresholds(sizes, targets(sizes, **options)).withColumnRenamed("source", "_source")
    joined = sizes.join(small(cuts), F.col("source").eqNullSafe(F.col("_source")))
    times = F.col("whole") + F.when(F.col("place") < F.col("cut"), 1).otherwise(0)
    return joined.select(key, "source", "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of which the mix takes something, with all their columns and
    ``size, source_size, target, taken, copies``.  No text is shuffled."""
    sizes = stored(sized(docs, key, text, source), "mix_sizes")
    cuts = thresholds(sizes, targets(sizes, **options))
    cuts = stored(cuts.select(F.col("source").alias("_source"), F.struct("source_size", "target", "whole", "cut").alias("_cut")), "mix_cuts")
    joined = docs.withColumns({"size": words(text), "_place": place(key, text)}).join(
        small(cuts), F.col(f"`{source}`").eqNullSafe(F.col("_source"))
    )
    times = F.col("_cut.whole") + F.when(F.col("_place") < F.col("_cut.cut"), 1).otherwise(0)
    added = {"source_size": F.col("_cut.source_size"), "target": F.col("_cut.target"), "taken": F.col("size") * times, "copies": times}
    return joined.withColumns(added).filter("taken > 0").drop("_source", "_cut", "_place")
