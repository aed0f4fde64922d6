"""Descriptive statistics of the clean table.  Each report is one pass of
partial aggregation; only the report itself reaches a single task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from recueil.functions import text as T
from recueil.session import settled


def row_and_value_counts(df: DataFrame, value: str) -> DataFrame:
    """``rows, distinct_values``; nulls are no value."""
    return df.agg(F.count("*").alias("rows"), F.countDistinct(value).alias("distinct_values"))


def value_counts(df: DataFrame, value: str, n: int) -> DataFrame:
    """The ``n`` most frequent values, ties in value order; nulls left out."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), value).limit(n)


def length_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, min, max, mean`` of text lengths, the mean cut to an integer."""
    length = {c: F.length(c) for c in columns}
    one = df.agg(*[
        F.struct(
            F.lit(c).alias("column"),
            F.min(length[c]).alias("min"),
            F.max(length[c]).alias("max"),
            F.avg(length[c]).cast("int").alias("mean"),
        ).alias(c)
        for c in columns
    ])
    return one.select(F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))


def _is_filled(name: str, rule: str) -> Column:
    c = F.col(f"`{name}`").cast("string")
    if rule == "trimmed":
        return T.not_blank(c)
    if rule == "strict":
        return T.filled(c)
    if rule == "not_empty":
        return ~F.coalesce(c == "", F.lit(False))
    raise ValueError(f"unknown fill rule: {rule!r}")


def fill_rate(name: str, rule: str) -> Column:
    """Aggregate: percentage of filled values to one decimal, 0 on no rows."""
    rate = F.bround(100.0 * F.count_if(_is_filled(name, rule)) / F.nullif(F.count("*"), F.lit(0)), 1)
    return F.coalesce(rate, F.lit(0.0))


def fill_rates(df: DataFrame, columns: Sequence[str] | None = None, rule: str = "trimmed") -> DataFrame:
    """``column, percent`` for every column.

    ``trimmed`` counts text with a visible character, ``strict`` text that is
    not empty, ``not_empty`` also counts nulls as filled.
    """
    names = list(columns or df.columns)
    one = df.agg(*[fill_rate(c, rule).alias(c) for c in names])
    return one.unpivot([], [F.col(f"`{c}`") for c in names], "column", "percent")


def _mean(total: str, n: str) -> Column:
    return (F.sum(total) / F.sum(n)).cast("int")


def _share(hits: str) -> Column:
    rate = F.bround(100.0 * F.sum(hits) / F.nullif(F.sum("n"), F.lit(0)), 1)
    return F.coalesce(rate, F.lit(0.0))


def _per_city(clean: DataFrame, texts: Sequence[str], filled_by: dict[str, tuple[str, str]]) -> DataFrame:
    """One small row per city with everything the reports add up.

    The clean plan runs once, here; both the totals and the most frequent
    cities come from the result.
    """
    aggregates = [F.count("*").alias("n")]
    for c in texts:
        length = F.length(c)
        aggregates += [
            F.min(length).alias(f"min_{c}"), F.max(length).alias(f"max_{c}"),
            F.sum(length).alias(f"sum_{c}"), F.count(length).alias(f"n_{c}"),
        ]
    aggregates += [F.count_if(_is_filled(c, rule)).alias(name) for name, (c, rule) in filled_by.items()]
    return settled(clean.groupBy("ville").agg(*aggregates))


def _top(per_city: DataFrame, n: int) -> DataFrame:
    return per_city.filter("ville IS NOT NULL").select("ville", "n").orderBy(F.desc("n"), "ville").limit(n)


def summary(clean: DataFrame) -> DataFrame:
    """One row of headline figures; no row for an empty table."""
    rates = {
        "taux_avec_categories": ("categories", "not_empty"),
        "taux_avec_description_longue": ("description_longue", "strict"),
        "taux_avec_date_debut": ("date_debut", "strict"),
        "taux_avec_url": ("url", "strict"),
    }
    per_city = _per_city(clean, ["description", "texte_complet"], rates)
    figures = per_city.agg(
        F.sum("n").alias("nombre_total"),
        F.count("ville").alias("nombre_villes"),
        _mean("sum_description", "n_description").alias("longueur_moyenne_description"),
        _mean("sum_texte_complet", "n_texte_complet").alias("longueur_moyenne_texte_complet"),
        *[_share(name).alias(name) for name in rates],
    )
    return one_row(figures, _as_map(_top(per_city, 10), "ville", "top_villes")).filter("nombre_total > 0")


def _as_map(counts: DataFrame, value: str, name: str) -> DataFrame:
    """A short count table as one map, most frequent first."""
    entries = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), F.col(value).alias("v"), F.col("n"))))
    pairs = F.transform(entries, lambda e: F.struct(e["v"], e["n"]))
    return counts.agg(F.map_from_entries(pairs).alias(name))


def one_row(*tables: DataFrame) -> DataFrame:
    """One-row tables as one row."""
    keyed = [df.withColumn("_one", F.lit(1)) for df in tables]
    return reduce(lambda a, b: a.join(b, "_one"), keyed).drop("_one")


def statistics_document(clean: DataFrame) -> DataFrame:
    """The one-row statistics document saved next to the clean table."""
    columns = clean.columns
    texts = [c for c in ("description", "texte_complet") if c in columns]
    per_city = _per_city(clean, texts, {f"filled_{c}": (c, "trimmed") for c in columns})

    def percent(c: str) -> Column:
        return F.format_string("%.1f%%", _share(f"filled_{c}"))

    stats = []
    for c in texts:
        stats += [
            F.min(f"min_{c}").alias(f"{c}_min"), F.max(f"max_{c}").alias(f"{c}_max"), _mean(f"sum_{c}", f"n_{c}").alias(f"{c}_moyenne")
        ]
    dated = [(c, name) for c, name in (("date_debut", "taux_avec_dates"), ("url", "taux_avec_url")) if c in columns]
    figures = per_city.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("nombre_evenements"),
        F.array(*[F.lit(c) for c in columns]).alias("colonnes"),
        F.struct(*[percent(c).alias(c) for c in columns]).alias("completude"),
        F.struct(*stats).alias("statistiques_texte"),
        *[percent(c).alias(name) for c, name in dated],
    )
    return one_row(figures, _as_map(_top(per_city, 20), "ville", "villes_principales"))
