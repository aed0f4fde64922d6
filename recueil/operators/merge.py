"""Ordered upsert by key, anti joins, and their counters.

Tables to merge have four columns: ``uid`` (null means "no key"), ``pos``
(any sortable value, unique per table, later rows have larger ones),
``payload`` and ``digest`` (see :func:`with_key_and_digest`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as t

from recueil.functions.text import fingerprint
from recueil.operators.clean import event_key, keep_first
from recueil.operators.profile import one_row

COLUMNS = ["uid", "pos", "payload", "digest"]

# 2 ** bits: positions of one key compared inside one group before the groups are.
_RUN_BITS = 20


def with_key_and_digest(events: DataFrame, order: str = "seq", payload: str = "payload") -> DataFrame:
    """Raw events in the shape the merge expects."""
    return events.select(
        event_key(F.col(payload)).alias("uid"),
        F.col(order).alias("pos"),
        F.col(payload).alias("payload"),
        fingerprint(F.col(payload)).alias("digest"),
    )


def with_runs(df: DataFrame) -> DataFrame:
    """Adds ``run``, which cuts the order of each key into contiguous runs.

    Integers are cut by value, structs by everything but their last field (for
    landed records that is the file block).  Rows ordered by anything else (text,
    times, decimals) are dealt by ranges of key and order, and the range is the
    run.  A key holding a third of all rows is thus compared run by run.
    """
    kind = df.schema["pos"].dataType
    if isinstance(kind, t.IntegralType):
        return df.withColumn("run", F.shiftright(F.col("pos").cast("bigint"), _RUN_BITS))
    if isinstance(kind, t.StructType) and len(kind) > 1:
        return df.withColumn("run", F.struct(*[F.col(f"pos.{name}") for name in kind.names[:-1]]))
    return df.repartitionByRange("uid", "pos").withColumn("run", F.spark_partition_id())


def targets(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The existing row each incoming key updates: the last one of its key.

    Reducing before the semi join keeps repeated keys off the shuffle; where
    the incoming keys are few the optimizer moves the semi join below.
    """
    keys = incoming.filter("uid IS NOT NULL").select("uid").distinct()
    last = (
        existing.filter("uid IS NOT NULL")
        .groupBy("uid")
        .agg(F.max_by("digest", "pos").alias("digest"), F.max("pos").alias("pos"))
    )
    return last.join(keys, "uid", "left_semi")


def _loose(existing: DataFrame, incoming: DataFrame, keyless: str) -> DataFrame:
    """The keyless incoming rows to append."""
    loose = incoming.filter("uid IS NULL")
    if keyless == "append":
        return loose
    if keyless != "content_hash":
        raise ValueError(f"unknown keyless rule: {keyless!r}")
    known = existing.filter("uid IS NULL").select("digest").distinct()
    return keep_first(loose, "digest", "pos").join(known, "digest", "left_anti")


def _changes(steps: DataFrame, session: str | None = None) -> DataFrame:
    """``added, updated, same`` of the fresh steps, per session if named.

    Every step is compared with the one before it of the same key.  Steps are
    compared within contiguous runs first; then only the runs of a key are.
    Sessions must be contiguous in ``pos`` as well.
    """
    cut = [session] if session else []
    in_run = Window.partitionBy("uid", *cut, "run").orderBy("pos")
    compared = with_runs(steps).withColumn("previous", F.lag("digest").over(in_run))
    known = F.col("fresh") & F.col("previous").isNotNull()
    runs = compared.groupBy("uid", *cut, "run").agg(
        F.min_by(F.struct("digest", "fresh"), "pos").alias("first"),
        F.max_by("digest", "pos").alias("last"),
        F.count_if(known & (F.col("previous") != F.col("digest"))).alias("updates"),
        F.count_if(known & (F.col("previous") == F.col("digest"))).alias("repeats"),
    )
    across = runs.withColumn("previous", F.lag("last").over(Window.partitionBy("uid").orderBy(*cut, "run")))
    before, opening = F.col("previous"), F.col("first.fresh").cast("bigint")
    sums = [
        F.sum(F.when(before.isNull(), opening).otherwise(0)).alias("added"),
        F.sum(F.col("updates") + F.when(before != F.col("first.digest"), opening).otherwise(0)).alias("updated"),
        F.sum(F.col("repeats") + F.when(before == F.col("first.digest"), opening).otherwise(0)).alias("same"),
    ]
    return across.groupBy(*cut).agg(*sums)


def merge_counts(existing: DataFrame, incoming: DataFrame, keyless: str = "append") -> DataFrame:
    """One row ``nb_nouveaux, nb_ajoutes, nb_mis_a_jour, nb_doublons``.

    Every incoming row is compared with the state its key had just before it.
    Only keys, positions and digests are shuffled; keyless rows are counted
    where they are read.
    """
    keyed = incoming.filter("uid IS NOT NULL").select("uid", "pos", "digest", F.lit(True).alias("fresh"))
    before = targets(existing, incoming).select("uid", "pos", "digest", F.lit(False).alias("fresh"))
    counted = _changes(before.unionByName(keyed))
    rows = incoming.agg(F.count("*").alias("rows"), F.count_if(F.col("uid").isNull()).alias("keyless"))
    loose = _loose(existing, incoming, keyless).agg(F.count("*").alias("loose"))
    zero = F.lit(0).cast("bigint")
    return one_row(rows, counted, loose).select(
        F.col("rows").alias("nb_nouveaux"),
        (F.coalesce("added", zero) + F.col("loose")).alias("nb_ajoutes"),
        F.coalesce("updated", zero).alias("nb_mis_a_jour"),
        (F.coalesce("same", zero) + F.col("keyless") - F.col("loose")).alias("nb_doublons"),
    )


def replayed_journal(events: DataFrame, session: str) -> DataFrame:
    """The journal that merging ``events`` session by session would write.

    ``events`` has the merge columns and ``session``, which grows with ``pos``.
    """
    keyed = events.filter("uid IS NOT NULL").select("uid", "pos", "digest", session, F.lit(True).alias("fresh"))
    counts = _changes(keyed, session)
    rows = events.groupBy(session).agg(F.count("*").alias("rows"), F.count_if(F.col("uid").isNull()).alias("keyless"))
    zero = F.lit(0).cast("bigint")
    report = rows.join(counts, session, "left").select(
        F.col(session).alias("horodatage"),
        F.col("rows").alias("nb_nouveaux"),
        (F.coalesce("added", zero) + F.col("keyless")).alias("nb_ajoutes"),
        F.coalesce("updated", zero).alias("nb_mis_a_jour"),
        F.coalesce("same", zero).alias("nb_doublons"),
    )
    # One row per session is all this window ever sees.
    after = F.sum("nb_ajoutes").over(Window.orderBy("horodatage").rowsBetween(Window.unboundedPreceding, 0))
    return report.withColumn("nb_apres_fusion", after).withColumn(
        "nb_avant_fusion", F.col("nb_apres_fusion") - F.col("nb_ajoutes")
    )


def delta(existing: DataFrame, incoming: DataFrame, keyless: str = "append") -> DataFrame:
    """What a merge changes: the merge columns and ``target``.

    ``target`` is the position of the existing row to replace, null for rows to
    add.  Keys whose latest payload equals the existing one are not in it.
    """
    keyed = incoming.filter("uid IS NOT NULL")
    latest = keyed.groupBy("uid").agg(
        F.min("pos").alias("first_pos"), F.max_by(F.struct("payload", "digest"), "pos").alias("last")
    )
    known = targets(existing, incoming).select("uid", F.col("pos").alias("target"), F.col("digest").alias("known"))
    state = latest.select("uid", "first_pos", "last.*").join(known, "uid", "left")
    changed = state.filter("target IS NULL OR known <> digest").select(
        "uid", F.coalesce("target", "first_pos").alias("pos"), "payload", "digest", "target"
    )
    loose = _loose(existing, incoming, keyless).select(*COLUMNS)
    return changed.unionByName(loose, allowMissingColumns=True)


def apply_delta(existing: DataFrame, changes: DataFrame) -> DataFrame:
    """Existing rows with the changes applied.

    The join on ``pos`` spreads evenly whatever the keys are, because positions
    are unique.
    """
    replaced = changes.filter("target IS NOT NULL").select(
        F.col("target").alias("pos"), F.col("payload").alias("new_payload"), F.col("digest").alias("new_digest")
    )
    kept = existing.join(replaced, "pos", "left").select(
        "uid",
        "pos",
        F.coalesce("new_payload", "payload").alias("payload"),
        F.coalesce("new_digest", "digest").alias("digest"),
    )
    return kept.unionByName(changes.filter("target IS NULL").select(*COLUMNS))


def merge(existing: DataFrame, incoming: DataFrame, keyless: str = "append") -> DataFrame:
    """Existing rows in place, updated ones with their latest payload, new ones
    behind them at the position their key first came.

    ``keyless="content_hash"`` adds a keyless row only if no equal one exists.
    """
    existing, incoming = existing.select(*COLUMNS), incoming.select(*COLUMNS)
    return apply_delta(existing, delta(existing, incoming, keyless))


def merge_report(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Counters with the table sizes before and after."""
    before = existing.agg(F.count("*").alias("nb_avant_fusion"))
    return one_row(merge_counts(existing, incoming), before).select(
        "nb_nouveaux",
        "nb_avant_fusion",
        (F.col("nb_avant_fusion") + F.col("nb_ajoutes")).alias("nb_apres_fusion"),
        "nb_ajoutes",
        "nb_mis_a_jour",
        "nb_doublons",
    )


def without_vector(events: DataFrame, vectors: DataFrame, reembed: str = "new", text: str = "texte_complet") -> DataFrame:
    """Events that still need a vector; ids are compared as text.

    ``reembed="changed"`` also returns events whose text differs from the one
    the stored vector was made of (``text_digest``).  What is new is found on
    the keys alone; in a steady run that is little, and the events themselves
    are then filtered without being shuffled.  They are read twice, so pass a
    stored table.
    """
    keys = {"_id": F.coalesce(F.col("id").cast("string"), F.lit(""))}
    have = dict(keys)
    if reembed == "changed":
        keys["text_digest"] = F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)
        have["text_digest"] = F.col("text_digest")
    elif reembed != "new":
        raise ValueError(f"unknown re-embedding rule: {reembed!r}")
    stored = vectors.select(*[c.alias(name) for name, c in have.items()]).distinct()
    missing = events.select(*[c.alias(name) for name, c in keys.items()]).join(stored, list(keys), "left_anti")
    return events.withColumns(keys).join(missing, list(keys), "left_semi").select(*events.columns)


def append_vectors(existing: DataFrame | None, fresh: DataFrame, key: str = "id") -> DataFrame:
    """Existing vectors and the fresh ones whose key is not there yet."""
    if existing is None:
        return fresh
    new = fresh.join(existing.select(key).distinct(), key, "left_anti").select(*fresh.columns)
    return existing.unionByName(new, allowMissingColumns=True)


def replace_vectors(existing: DataFrame, fresh: DataFrame, key: str = "id") -> DataFrame:
    """Fresh vectors take the place of existing ones with the same key."""
    kept = existing.join(fresh.select(key).distinct(), key, "left_anti").select(*existing.columns)
    return kept.unionByName(fresh, allowMissingColumns=True)


def unmatched_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Alignment check: keys whose row counts differ, ``key, n_left, n_right``."""
    sides = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = sides.groupBy(key).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
    return counts.filter("n_left <> n_right")
