"""The versioned raw table: snapshots, changes, compacted state, journal, cursor.

Layout below one root::

    raw/versions/version=N    the batch as it came
    raw/changes/version=N    the rows it changes, and nothing else
    raw/base/version=N/bucket=B    the whole state after version N
    raw/bases/entry-N    one row per finished compaction; writing it commits
    raw/journal/entry-N    one row per finished version; writing it commits
    raw/cursor/entry-*    where the next collection resumes

A merge appends the rows that change and rewrites nothing.  The state is the newest
base and, of the changes since, the newest row of each key; a row keeps its position
when it is updated.  Few changes are joined with a large base, which is not
shuffled for it.  Compaction writes the state as a new base.  It is due when as
many rows changed since the last base as that one has, or after ``COMPACT_VERSIONS``
versions, so what all compactions write grows with the data and not with the number
of merges.  The first version is a base by itself.

A base has so many buckets that each holds about ``BUCKET_ROWS`` rows, a power of
two; a merge reads keys, positions and digests of the buckets its keys are in.
Rows without a key never change and lie in bucket -1.

A version that was not journaled does not exist; running its batch again
overwrites what a lost run left behind.  A base without its entry does not exist
either.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from recueil import schemas
from recueil.functions.text import fingerprint
from recueil.operators.clean import event_key
from recueil.operators.merge import COLUMNS, delta, merge_counts
from recueil.sources.landing import source_order

KINDS = ("raw", "processed", "embeddings", "vectorstore")
KEYLESS_BUCKET = -1

#: Rows of a bucket of a base, about, and the number of slots keys are hashed to:
#: no base has more buckets.
BUCKET_ROWS = 1_000_000
SLOTS = 1 << 20

#: Versions after which a compaction is due whatever they changed.
COMPACT_VERSIONS = 32


def session_stamp() -> str:
    return time.strftime("%Y%m%d_%H%M%S")


def _name(version: int) -> str:
    return f"{version:010d}"


def _entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a folder of small JSON entries; none if it does not exist."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _commit(spark: SparkSession, row: Row | tuple, schema: str, path: str) -> None:
    """Writes one row as an entry of its own."""
    one = spark.createDataFrame([row], schema).coalesce(1)
    one.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def journal(spark: SparkSession, root: str) -> DataFrame:
    """One row per finished merge, oldest first."""
    return _entries(spark, f"{root}/raw/journal", schemas.JOURNAL).orderBy("version")


def list_versions(spark: SparkSession, root: str, kind: str = "raw") -> DataFrame:
    """Versions of a kind of data, newest name first, with their size.

    Only file names and lengths are read; hidden files do not count.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}; known: {list(KINDS)}")
    folder = f"{root}/{kind}/versions"
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "fichier STRING, chemin STRING, taille_ko DOUBLE")
    name = F.regexp_extract("path", r"/versions/([^/]+)", 1)
    sizes = files.select(name.alias("fichier"), "length").groupBy("fichier").agg(F.sum("length").alias("bytes"))
    return sizes.select(
        "fichier",
        F.concat(F.lit(f"{folder}/"), F.col("fichier")).alias("chemin"),
        F.bround(F.col("bytes") / 1024, 1).alias("taille_ko"),
    ).orderBy(F.desc("fichier"))


def bases(spark: SparkSession, root: str) -> DataFrame:
    """One row per finished compaction: ``version, bucket_count, rows``."""
    return _entries(spark, f"{root}/raw/bases", schemas.BASE)


class _State:
    """What the journal says about the state: its last version, the newest base and
    the versions that changed rows since.  ``done`` tells whether a stream's batch is
    journaled."""

    def __init__(self, spark: SparkSession, root: str, source_id: str | None = None, batch_id: int | None = None):
        self.spark, self.root = spark, root
        self.log = _entries(spark, f"{root}/raw/journal", schemas.JOURNAL)
        same = (F.col("source_id") == F.lit(source_id)) & (F.col("batch_id") == F.lit(batch_id))
        seen = self.log.agg(
            F.max("version").alias("version"), F.max_by("nb_apres_fusion", "version").alias("rows"), F.bool_or(same).alias("done")
        ).first()
        self.version, self.size, self.done = seen["version"] or 0, seen["rows"] or 0, bool(seen["done"])
        known = bases(spark, root).filter(F.col("version") <= self.version) if self.version else None
        newest = F.struct("version", "bucket_count", "rows")
        self.base = known.agg(F.max(newest).alias("base")).first()["base"] if known is not None else None
        since = self.base["version"] if self.base else 0
        self.changes: dict[int, int] = {}
        if self.version > since:  # compaction bounds their number
            rows = self.log.filter((F.col("version") > since) & (F.col("changed") > 0)).select("version", "changed").collect()
            self.changes = {r["version"]: r["changed"] for r in rows}

    @property
    def bucket_count(self) -> int:
        return self.base["bucket_count"] if self.base else 1

    def due(self) -> bool:
        """Whether a compaction is worth its writing."""
        changed = sum(self.changes.values())
        return bool(changed) and (changed >= self.base["rows"] or len(self.changes) >= COMPACT_VERSIONS)

    def rows(self, columns: list[str], buckets: set[int] | None = None) -> DataFrame | None:
        """Some columns of the state, of some buckets of the base; None if there
        is no version yet."""
        if not self.base:
            return None
        path = f"{self.root}/raw/base/version={_name(self.base['version'])}"
        base = self.spark.read.parquet(path)
        if buckets is not None:
            base = base.filter(F.col("bucket").isin(sorted(buckets)))
        base = base.select(*columns)
        if not self.changes:
            return base
        folder = f"{self.root}/raw/changes"
        paths = [f"{folder}/version={_name(v)}" for v in sorted(self.changes)]
        changed = self.spark.read.option("basePath", folder).parquet(*paths)
        keyed, loose = changed.filter("uid IS NOT NULL"), changed.filter("uid IS NULL")
        if len(paths) > 1:
            others = [c for c in columns if c != "uid"]
            newest = F.max_by(F.struct(*others), "version").alias("newest")
            keyed = keyed.groupBy("uid").agg(newest).select("uid", "newest.*")
        untouched = base.join(keyed.select("uid"), "uid", "left_anti")
        return untouched.select(*columns).unionByName(keyed.select(*columns)).unionByName(loose.select(*columns))


def current(spark: SparkSession, root: str) -> DataFrame:
    """The merged table."""
    rows = _State(spark, root).rows(COLUMNS)
    return spark.createDataFrame([], "uid STRING, pos STRING, payload STRING, digest BINARY") if rows is None else rows


def _bucket(count: int) -> Column:
    slot = F.pmod(F.xxhash64("uid"), F.lit(SLOTS)).cast("int")
    return F.when(F.col("uid").isNull(), KEYLESS_BUCKET).otherwise(slot % count).alias("bucket")


def _bucket_count(rows: int, bucket_rows: int) -> int:
    return min(SLOTS, 1 << max(0, (-(-rows // bucket_rows) - 1).bit_length()))


def _write_base(rows: DataFrame, root: str, version: int, n: int, bucket_rows: int) -> None:
    spark, count = rows.sparkSession, _bucket_count(n, bucket_rows)
    placed = rows.select(*COLUMNS, _bucket(count)).hint("rebalance", "bucket")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/raw/base/version={_name(version)}")
    _commit(spark, (version, count, n), schemas.BASE, f"{root}/raw/bases/entry-{_name(version)}")


def compact(spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS) -> bool:
    """Writes the state as a new base; False if nothing changed since the last.

    Readers of the old base are not disturbed; it may be deleted when none are
    left.
    """
    state = _State(spark, root)
    if not state.changes:
        return False
    _write_base(state.rows(COLUMNS), root, state.version, state.size, bucket_rows)
    return True


def integrate(
    spark: SparkSession,
    root: str,
    events: DataFrame,
    source_id: str = "batch",
    batch_id: int | None = None,
    keyless: str = "append",
    skip_empty: bool = False,
    bucket_rows: int = BUCKET_ROWS,
    compacting: bool = True,
) -> Row | None:
    """Snapshots a batch, merges it into the current table and journals it.

    ``events`` has ``payload`` and either ``seq`` or ``file, block``.  A batch
    of a stream that is journaled already is skipped.  An empty batch raises,
    or is skipped if ``skip_empty``.  The journal names the earlier version that
    had the same content, if any (``rejoue``).  ``compacting`` compacts when due.
    """
    state = _State(spark, root, source_id, batch_id)
    if state.done:
        return None
    version, before = state.version + 1, state.size

    # The snapshot fixes keys, order and digests; everything after reads it.
    snapshot = f"{root}/raw/versions/version={_name(version)}"
    if "seq" not in events.columns:
        events = events.withColumn("seq", source_order())
    kind = events.schema["seq"].dataType
    order = [F.col(f"seq.{f}") for f in kind.names] if hasattr(kind, "names") else [F.col("seq")]
    keyed = events.select(
        event_key(F.col("payload")).alias("uid"),
        F.struct(F.lit(version).cast("bigint").alias("version"), *order).alias("pos"),
        "payload",
        fingerprint(F.col("payload")).alias("digest"),
    )
    keyed.write.mode("overwrite").parquet(snapshot)
    incoming = spark.read.parquet(snapshot)
    content = F.concat_ws(
        "-", F.count("*").cast("string"),
        *[F.hex(F.bit_xor(F.xxhash64("digest", F.lit(i)))) for i in range(2)], F.hex(F.sum(F.crc32("digest"))),
    )
    came = incoming.agg(content.alias("content"), F.count("*").alias("n"), F.collect_set(_bucket(state.bucket_count)).alias("buckets")).first()
    if not came["n"]:
        if skip_empty:
            return None
        raise ValueError("the batch is empty; nothing was merged")
    again = state.log.filter(F.col("empreinte") == came["content"]).agg(F.min("version").alias("version")).first()["version"]

    # Appended keyless rows need not be compared with earlier ones.
    wanted = {b for b in came["buckets"] if b >= 0} | ({KEYLESS_BUCKET} if keyless != "append" else set())
    known = state.rows(["uid", "pos", "digest"], wanted)
    compared = incoming.select("uid", "pos", "digest").limit(0) if known is None else known
    counts = merge_counts(compared, incoming, keyless).first()
    changes = delta(compared, incoming, keyless).select(*COLUMNS)
    changed = counts["nb_ajoutes"] if known is None else 0
    if known is None:
        _write_base(changes, root, version, counts["nb_ajoutes"], bucket_rows)
    elif counts["nb_ajoutes"] or counts["nb_mis_a_jour"]:
        path = f"{root}/raw/changes/version={_name(version)}"
        changes.write.mode("overwrite").parquet(path)
        changed = spark.read.parquet(path).count()

    entry = Row(
        horodatage=session_stamp(),
        nb_nouveaux=counts["nb_nouveaux"],
        nb_avant_fusion=before,
        nb_apres_fusion=before + counts["nb_ajoutes"],
        nb_ajoutes=counts["nb_ajoutes"],
        nb_mis_a_jour=counts["nb_mis_a_jour"],
        nb_doublons=counts["nb_doublons"],
        fichier_version=snapshot,
        version=version,
        source_id=source_id,
        batch_id=batch_id,
        changed=changed,
        empreinte=came["content"],
        rejoue=again,
    )
    _commit(spark, entry, schemas.JOURNAL, f"{root}/raw/journal/entry-{_name(version)}")
    if known is not None and changed:
        state.changes[version] = changed
        if compacting and state.due():
            compact(spark, root, bucket_rows)
    return entry


def read_cursor(spark: SparkSession, root: str) -> Row | None:
    """The newest cursor row; None to start from the beginning."""
    rows = _entries(spark, f"{root}/raw/cursor", schemas.CURSOR)
    return next(iter(rows.orderBy(F.desc("seq")).limit(1).collect()), None)


def resume_from(spark: SparkSession, root: str) -> list[int] | None:
    """The cursor the next collection passes on; None to start from the
    beginning, because none was saved or because the list ended."""
    row = read_cursor(spark, root)
    return row["curseur_after"] if row else None


def cursors(spark: SparkSession, root: str) -> DataFrame:
    """All cursor rows, oldest first."""
    return _entries(spark, f"{root}/raw/cursor", schemas.CURSOR).orderBy("seq")


def write_cursor(
    spark: SparkSession, root: str, after: list[int] | None, received: int, total: int = 0,
    source_id: str | None = None, batch_id: int | None = None,
) -> bool:
    """Saves where the next collection resumes; no cursor ends the list.

    The cursor of a stream's batch is saved once: False if it is there already.
    """
    rows = cursors(spark, root)
    if batch_id is not None and not rows.filter((F.col("source_id") == source_id) & (F.col("batch_id") == batch_id)).isEmpty():
        return False
    seq = (rows.agg(F.max("seq").alias("seq")).first()["seq"] or 0) + 1
    row = (after, received, total, session_stamp(), after is None, seq, source_id, batch_id)
    _commit(spark, row, schemas.CURSOR, f"{root}/raw/cursor/entry-{_name(seq)}")
    return True
