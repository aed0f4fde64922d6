"""From raw JSON events to the clean event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recueil import schemas
from recueil.functions import text as T

#: Why a row was left out, in the order the rules apply.
RULES = ["duplicate", "no_title", "no_description", "short_description", "no_city", "kept"]

_CORRUPT = "_corrupt"


def _parsed(payload: Column) -> Column:
    return F.from_json(
        payload, f"{schemas.RAW_EVENT}, {_CORRUPT} STRING", {"columnNameOfCorruptRecord": _CORRUPT}
    )


def _with_parsed(events: DataFrame, payload: str) -> DataFrame:
    """Adds ``_event`` and ``_object``: the parsed record and whether it is one.

    The explode of a one-element array keeps the optimizer from copying the
    parse into every later expression.  The second, slower parse only runs on
    records the first one could not read completely.
    """
    parsed = events.select("*", F.explode(F.array(_parsed(F.col(payload)))).alias("_event"))
    complete = F.when(F.col(f"_event.{_CORRUPT}").isNull(), True).otherwise(
        F.try_parse_json(F.col(payload)).isNotNull()
    )
    return parsed.withColumn(
        "_object", F.coalesce(F.ltrim(F.col(payload)).startswith("{") & complete, F.lit(False))
    )


def well_formed(events: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows whose payload is a JSON object."""
    return _with_parsed(events, payload).filter("_object").drop("_event", "_object")


def malformed(events: DataFrame, payload: str = "payload") -> DataFrame:
    """The other rows, for a quarantine table."""
    return _with_parsed(events, payload).filter("NOT _object").drop("_event", "_object")


def event_key(payload: Column) -> Column:
    """The record's ``uid`` as text; null where it is missing, empty or zero."""
    uid = F.from_json(payload, "uid string")["uid"]
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(payload), "$.uid", "variant"))
    falsy = F.when(uid.isin("", "[]", "{}"), True).when(uid.isin("0", "-0", "0.0", "false"), kind != "STRING")
    return F.when(F.coalesce(falsy, F.lit(False)), None).otherwise(uid)


def extract_events(
    events: DataFrame, base_url: str, payload: str = "payload", order: str = "seq", fallback: str = "presence"
) -> DataFrame:
    """The clean event columns of every well-formed raw event, plus ``order``."""
    event = _with_parsed(events, payload).filter("_object").select(order, F.col("_event").alias("e"))
    missing = F.lit("")
    flat = event.select(
        order,
        F.coalesce("e.uid", missing).alias("id"),
        T.pick_language(F.col("e.title"), fallback=fallback).alias("titre"),
        T.pick_language(F.col("e.description"), fallback=fallback).alias("description"),
        T.pick_language(F.col("e.longDescription"), fallback=fallback).alias("description_longue"),
        F.coalesce("e.location.city", missing).alias("ville"),
        F.coalesce("e.location.address", missing).alias("adresse"),
        F.coalesce("e.location.region", missing).alias("region"),
        T.wall_clock(F.col("e.firstTiming.begin")).alias("date_debut"),
        T.wall_clock(F.col("e.lastTiming.end")).alias("date_fin"),
        T.join_keywords(F.col("e.keywords")).alias("categories"),
        T.build_url(base_url, F.col("e.originAgenda.slug"), F.col("e.slug")).alias("url"),
    )
    return flat.withColumn("texte_complet", _composed()).select(*schemas.CLEAN_COLUMNS, order)


def _composed() -> Column:
    return T.compose_text(
        *[F.col(c) for c in ("titre", "description", "description_longue", "ville", "adresse", "categories")],
        F.col("date_debut"),
        F.col("date_fin"),
    )


def keep_first(df: DataFrame, key: str | list[str], order: str | list[str]) -> DataFrame:
    """One row per key, the first by ``order``; null keys form one group.

    The rank filter is planned as a group limit before the shuffle, so a key
    that holds a third of all rows sends one row per task, not all of them.
    """
    keys = [key] if isinstance(key, str) else key
    orders = [order] if isinstance(order, str) else order
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*orders)))
    return ranked.filter("_rank = 1").drop("_rank")


def _verdict(min_description: int) -> Column:
    """Position in RULES of the first rule a row breaks, else of ``kept``."""
    return (
        F.when(~T.not_blank(F.col("titre")), 1)
        .when(~T.not_blank(F.col("description")), 2)
        .when(F.length("description") < min_description, 3)
        .when(~T.not_blank(F.col("ville")), 4)
        .otherwise(5)
    )


def clean_events(extracted: DataFrame, order: str = "seq", min_description: int = 50) -> DataFrame:
    """De-duplicate, filter, normalise and recompose, in that order.

    The length rule looks at the description as it came, and a first-seen
    invalid duplicate hides a later valid one; both follow from the order.
    """
    first = keep_first(extracted.drop("texte_complet"), "id", order)
    valid = first.filter(_verdict(min_description) == RULES.index("kept"))
    spaced = valid.withColumns({
        name: F.coalesce(T.collapse_spaces(F.col(name)), F.lit(""))
        for name in ("titre", "description", "description_longue", "ville", "adresse", "region", "categories")
    })
    plain = spaced.withColumns({name: T.strip_html(F.col(name)) for name in ("description", "description_longue")})
    return plain.withColumn("texte_complet", _composed()).select(*schemas.CLEAN_COLUMNS, order)


def rejection_counts(extracted: DataFrame, order: str = "seq", min_description: int = 50) -> DataFrame:
    """Rows per rule, in one pass: ``rule, n, percent`` of all rows.

    Every row is judged where it is read; what is shuffled is one small
    partial result per id and task.
    """
    per_id = (
        extracted.select("id", order, _verdict(min_description).alias("verdict"))
        .groupBy("id")
        .agg(F.min_by("verdict", order).alias("verdict"), F.count("*").alias("n"))
    )
    sums = per_id.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate"),
        *[F.count_if(F.col("verdict") == i).alias(rule) for i, rule in enumerate(RULES) if i > 0],
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    return sums.unpivot(["total"], RULES, "rule", "n").select(
        "rule", "n", F.when(F.col("total") > 0, F.bround(100.0 * F.col("n") / F.col("total"), 1)).otherwise(0.0).alias("percent")
    )


def display_sample(clean: DataFrame, order: str | list[str], n: int = 3) -> DataFrame:
    """The first ``n`` rows with a shortened description, for display."""
    shown = F.concat(F.substring("description", 1, 100), F.lit("...")).alias("description")
    columns = ["id", "titre", "ville", "date_debut", "date_fin", "url", shown, "categories"]
    orders = [order] if isinstance(order, str) else order
    return clean.orderBy(*orders).limit(max(n, 0)).select(*columns)
