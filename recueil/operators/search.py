"""k nearest neighbours of a whole question table.

Every method is the same distributed search: a question carries the *cells* it
probes, and is compared with the vectors in them.  Exact search has one cell,
clustered search the nearest KMeans cells, hashed search the buckets of random
projections.

Distances are computed in NumPy inside the tasks that hold the vectors, and a
task only ever keeps the best k per question, so no pair table exists.  Questions
go to the vectors, which are scanned where they are: a bounded block of questions
at a time.  One block is the rule.  A larger question table takes a wave for each
block; a wave scans the vectors once, ranks its questions for good and writes their
hits, so what is shuffled grows with the hits and no vector is copied.

The driver sends the questions of a wave, so it only ever takes ``QUESTION_LIMIT``
bytes of them for a search.  Of a question table beyond that it takes none: questions
and vectors are stored in blocks, and every pair of blocks is a task's work.

Hashed search keeps the buckets as a table of ids, made when the index is built.
A search looks up the buckets its questions probe, and reads the vectors of the
ids found there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as t

from recueil.functions.vectors import similarity_score
from recueil.session import settled, shared_dir

METHODS = ("flat_l2", "flat_ip", "ivf", "lsh")

#: Bytes of question vectors that are sent to every task in one wave, about, and
#: that the driver takes in all for one search.
QUESTION_LIMIT = 16 << 20
#: Bytes of the vectors in a block, about, where questions do not pass the driver.
#: Each block emits k rows per question.
VECTOR_LIMIT = 32 << 20
#: Waves of fewer questions run side by side in one job, up to so many and up to
#: the same bytes in all.
WAVES_PER_JOB = 16
#: Centroids are sent to every task, so many bytes of them at a time.
CENTROID_LIMIT = 64 << 20
#: Folders the bucket table of a hashed index is stored in.
BUCKET_PARTS = 64
#: Each scan task emits k rows per question; scan partitions are joined into
#: fewer tasks only if they would emit more rows than this in total, and never
#: into fewer than so many tasks per core.
HIT_LIMIT = 2_000_000_000
TASKS_PER_CORE = 4
#: Up to this many hits are broadcast to the metadata they are joined with.
BROADCAST_HITS = 500_000
#: Up to this many probed cells are named in the scan filter.
FILTER_LIMIT = 1000

# Distances computed at a time, 4 MB in single precision.
_BLOCK_CELLS = 1 << 20

# Vectors of a stored block that are compared at a time.
_BLOCK_ROWS = 10_000

# Marks (bits) of a block of vectors of a hashed search, 8 MB.
_BLOCK_MARKS = 1 << 26

# ---------------------------------------------------------------- kernel


def _matrix(column: pa.Array, dimension: int, kind: type | None = np.float64) -> np.ndarray:
    """A list column without nulls as a matrix, as it is stored if ``kind`` is None."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    values = values if kind is None else values.astype(kind)
    lengths = column.value_lengths()
    if len(column) and set(lengths.unique().to_pylist()) != {dimension}:
        raise ValueError(f"vectors must have dimension {dimension}")
    return values.reshape(len(column), dimension)


def _order(ids: np.ndarray) -> np.ndarray:
    """Sortable stand-in for ids of any type."""
    return ids if ids.dtype.kind in "iu" else np.unique(ids.astype(str), return_inverse=True)[1]


def _ids(column: pa.Array) -> np.ndarray:
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False)
    return np.array(column.to_pylist(), dtype=object)


class _Best:
    """The k best hits per question seen so far in one task."""

    def __init__(self, questions: np.ndarray, k: int, metric: str):
        self.q, self.k, self.metric = questions, k, metric
        step = max(1, _BLOCK_CELLS // max(1, questions.shape[1]))
        blocks = [questions[i : i + step].astype(np.float64) for i in range(0, len(questions), step)]
        self.norms = np.concatenate([(x**2).sum(1) for x in blocks]) if blocks else np.empty(0)
        self.offset = self.norms if metric == "l2" else np.zeros(len(questions))
        self.row = np.empty(0, np.int64)
        self.dist = np.empty(0)
        self.id: np.ndarray | None = None
        self.limit = np.full(len(questions), np.inf)
        self.pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def _exact(self, rows: np.ndarray, vectors: np.ndarray, cols: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows))
        step = max(1, _BLOCK_CELLS // max(1, self.q.shape[1]))
        for i in range(0, len(rows), step):
            a, b = self.q[rows[i : i + step]].astype(np.float64), vectors[cols[i : i + step]]
            out[i : i + step] = ((a - b) ** 2).sum(1) if self.metric == "l2" else -(a * b).sum(1)
        return out

    def _few_copies(self, vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Positions of the k lowest ids of every distinct vector.

        Copies are equally far from any question and ties go by id, so no other
        copy can be among the k best.
        """
        bits = np.ascontiguousarray(vectors).view(np.uint64)
        bits = bits ^ (bits >> np.uint64(29))
        weights = np.random.default_rng(0).integers(0, 1 << 62, bits.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        group = (bits * weights).sum(1, dtype=np.uint64)
        by_group = np.lexsort((_order(ids), group))
        start = np.searchsorted(group[by_group], group[by_group])
        if not np.array_equal(vectors[by_group], vectors[by_group[start]]):
            # Two vectors share a hash: group by the vectors themselves.
            group = np.unique(vectors, axis=0, return_inverse=True)[1].ravel()
            by_group = np.lexsort((_order(ids), group))
            start = np.searchsorted(group[by_group], group[by_group])
        return np.sort(by_group[np.arange(len(by_group)) - start < self.k])

    def _wide(self, rows: np.ndarray, kind: type) -> np.ndarray:
        """|v - q|^2 - |q|^2 = (v, |v|^2) . (-2q, 1), one matrix product."""
        factor, last = (-2, 1) if self.metric == "l2" else (-1, 0)
        return np.column_stack([factor * self.q[rows].astype(kind), np.full(len(rows), last, kind)])

    def add(self, questions: np.ndarray, vectors: np.ndarray, ids: np.ndarray) -> None:
        """Compares some questions (row numbers) with some vectors."""
        self._add(questions, vectors, ids, None)

    def add_near(self, vectors: np.ndarray, ids: np.ndarray) -> bool:
        """Compares all questions with vectors of several cells at once, if the limits
        so far leave few candidates; False if the cells have to be added one by one."""
        if not np.isfinite(vectors).all() or not np.isfinite(self.limit).all() or not len(vectors):
            return False
        norms = (vectors**2).sum(1)
        kind = np.float32 if self.norms.max(initial=0) + norms.max() < 1e30 else np.float64
        wide, step = np.column_stack([vectors, norms]).astype(kind), max(1, _BLOCK_CELLS // len(vectors))
        for at in range(0, len(self.q), step):
            some = np.arange(at, min(at + step, len(self.q)))
            margin = 4 * np.finfo(kind).eps * (vectors.shape[1] + 8) * (self.norms[some] + norms.max())
            near = self._wide(some, kind) @ wide.T <= ((self.limit - self.offset)[some] + margin)[:, None]
            if np.count_nonzero(near) > 8 * self.k * len(some) + 1000:
                return False  # what is noted already may be met again
            rows, cols = np.nonzero(near)
            self._merge(some[rows], cols, vectors, ids)
        return True

    def add_marked(self, bits: np.ndarray, vectors: np.ndarray, ids: np.ndarray) -> None:
        """Compares every vector with the questions whose bit its row has set."""
        self._add(np.arange(len(self.q)), vectors, ids, bits)

    def _add(self, questions: np.ndarray, vectors: np.ndarray, ids: np.ndarray, bits: np.ndarray | None) -> None:
        # One NaN would make every margin of its batch NaN.
        finite = np.isfinite(vectors).all(axis=1)
        if not finite.all():
            vectors, ids, bits = vectors[finite], ids[finite], None if bits is None else bits[finite]
        if not len(questions) or not len(vectors):
            return
        norms = (vectors**2).sum(1)
        largest = norms.max()
        # Single precision preselects; values beyond its range need double.
        kind = np.float32 if self.norms[questions].max() + largest < 1e30 else np.float64
        wide = np.column_stack([vectors, norms]).astype(kind)
        thin, at = bits is None, 0
        while at < len(questions):
            # A byte has the marks of eight questions.
            step = max(8, _BLOCK_CELLS // len(wide) // 8 * 8)
            some = questions[at : at + step]
            # Far above the rounding error of a product of this length.
            margin = 4 * np.finfo(kind).eps * (vectors.shape[1] + 8) * (self.norms[some] + largest)
            mark = None
            if bits is not None:
                mark = np.unpackbits(bits[:, at // 8 : (at + step) // 8], axis=1, bitorder="little").T[: len(some)].astype(bool)
            pairs = self._candidates(some, wide, margin, mark, give_up=thin)
            if pairs is None:
                kept = self._few_copies(vectors, ids)
                vectors, wide, ids, thin = vectors[kept], wide[kept], ids[kept], False
                continue
            self._merge(*pairs, vectors, ids)
            at += step

    def _candidates(
        self, some: np.ndarray, wide: np.ndarray, margin: np.ndarray, mark: np.ndarray | None, give_up: bool
    ) -> tuple[np.ndarray, np.ndarray] | None:
        """Pairs that may be among the k best; None if suspiciously many."""
        rough = self._wide(some, wide.dtype.type) @ wide.T
        limit = (self.limit - self.offset)[some] + margin
        near = rough <= limit[:, None]
        if mark is not None:
            near &= mark
        enough = 8 * self.k * len(some) + 1000
        if len(wide) > self.k and np.count_nonzero(near) > enough:
            if mark is not None:
                rough = np.where(mark, rough, np.inf)
            best = np.partition(rough, self.k - 1, axis=1)[:, self.k - 1]
            near &= rough <= (best + 2 * margin)[:, None]
            if give_up and np.count_nonzero(near) > enough:
                return None
        rows, cols = np.nonzero(near)
        return some[rows], cols

    def _merge(self, row: np.ndarray, col: np.ndarray, vectors: np.ndarray, ids: np.ndarray) -> None:
        """Notes candidates; they are ranked when there are enough of them."""
        self.pending.append((row, self._exact(row, vectors, col), ids[col]))
        self.waiting += len(row)
        if self.waiting > max(20_000, self.k * len(self.q)):
            self.flush()

    def flush(self) -> None:
        """Ranks the candidates noted so far and tightens the limits."""
        if not self.waiting:
            return
        held = [] if self.id is None else [(self.row, self.dist, self.id)]
        row, dist, ids = (np.concatenate(parts) for parts in zip(*held, *self.pending))
        self.pending, self.waiting = [], 0
        order = np.lexsort((_order(ids), dist, row))
        row, dist, ids = row[order], dist[order], ids[order]
        # The same vector may be met again through another cell.
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])
        row, dist, ids = row[fresh], dist[fresh], ids[fresh]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        best = rank < self.k
        self.row, self.dist, self.id = row[best], dist[best], ids[best]
        last = rank[best] == self.k - 1
        self.limit[self.row[last]] = self.dist[last]

    def table(self, question_ids: np.ndarray, schema: pa.Schema) -> pa.Table:
        self.flush()
        ids = [] if self.id is None else self.id
        return pa.table(
            [
                pa.array(question_ids[self.row], schema.field(0).type),
                pa.array(ids, schema.field(1).type),
                pa.array(self.dist, pa.float64()),
            ],
            schema=schema,
        )


def _arrow_type(kind: t.DataType) -> pa.DataType:
    known = {t.LongType(): pa.int64(), t.IntegerType(): pa.int32(), t.StringType(): pa.string()}
    if kind not in known:
        raise ValueError(f"ids of type {kind.simpleString()} are not supported; cast them to bigint, int or string")
    return known[kind]


# ---------------------------------------------------------------- search


class _Wave:
    """A block of questions and who probes which cell.

    Questions without a list of cells probe all of them; in one search either
    all questions have one or none.
    """

    def __init__(self, questions: pa.Table, dimension: int):
        ids = _ids(questions.column("query_id"))
        _, first = np.unique(_order(ids), return_index=True)
        self.ids, self.questions = ids[first], _matrix(questions.column("embedding"), dimension, None)[first]
        self.probing: dict[int, np.ndarray] | None = None
        if questions.num_rows and questions.column("cells").null_count == questions.num_rows:
            return
        lists = questions.column("cells").combine_chunks().take(pa.array(first))
        cells = lists.flatten().to_numpy(zero_copy_only=False)
        who = np.repeat(np.arange(len(first), dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
        order = np.argsort(cells, kind="stable")
        names, starts = np.unique(cells[order], return_index=True)
        self.probing = {int(c): np.unique(x) for c, x in zip(names, np.split(who[order], starts[1:]))}

    def marks(self) -> dict[int, np.ndarray]:
        """The cells that many questions probe, as bits of all questions.

        There are at most so many of them as 64 questions probe.
        """
        found = {}
        for cell, rows in self.probing.items():
            if len(rows) * 64 > len(self.ids):
                mark = np.zeros(len(self.ids), bool)
                mark[rows] = True
                found[cell] = np.packbits(mark, bitorder="little")
        return found


def _cell_filter(df: DataFrame, probing: dict[int, np.ndarray] | None) -> DataFrame:
    """The rows of probed cells; where cells are stored apart this prunes files."""
    if probing is None:
        return df
    if len(probing) <= FILTER_LIMIT:
        return df.filter(F.col("cell").isin(list(probing)))
    # No more cells than the questions of a block probe.
    probed = df.sparkSession.createDataFrame(pa.table({"cell": pa.array(list(probing), pa.int64())}))
    return df.join(F.broadcast(probed), "cell", "left_semi")


def _compare_cells(best: _Best, batch: pa.RecordBatch, wave: _Wave, dimension: int) -> None:
    """Compares vectors with the questions that probe their ``cell``."""
    vector, ids = _matrix(batch.column("embedding"), dimension), _ids(batch.column("vec_id"))
    probing, everyone = wave.probing, np.arange(len(best.q))
    cell = batch.column("cell").to_numpy()
    by_cell = np.argsort(cell, kind="stable")
    names, starts = np.unique(cell[by_cell], return_index=True)
    if probing is None and len(names) > 1 and best.add_near(vector, ids):
        return
    for name, here in zip(names, np.split(by_cell, starts[1:])):
        rows = everyone if probing is None else probing.get(int(name))
        if rows is not None:
            best.add(rows, vector[here], ids[here])


def _compare_marked(best: _Best, batch: pa.RecordBatch, wave: _Wave, marks: dict[int, np.ndarray], dimension: int) -> None:
    """Compares vectors with the questions that probe one of their ``cells``."""
    width = -(-len(wave.ids) // 8)
    step = max(1, _BLOCK_MARKS // (8 * max(1, width)))
    nobody = np.empty(0, np.int32)
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        bits = np.zeros((len(part), width), np.uint8)
        for row, cells in zip(bits, part.column("cells").to_pylist()):
            for cell in cells:
                if cell in marks:
                    row |= marks[cell]
                else:
                    few = wave.probing.get(cell, nobody)
                    np.bitwise_or.at(row, few >> 3, np.left_shift(1, few & 7).astype(np.uint8))
        met = bits.any(axis=1)
        best.add_marked(bits[met], _matrix(part.column("embedding"), dimension)[met], _ids(part.column("vec_id"))[met])


def _wave_hits(
    wave: _Wave, sent, vectors: DataFrame, buckets: DataFrame | None, k: int, metric: str, schema: pa.Schema, hit_schema: t.StructType
) -> DataFrame:
    """The k best vectors of each task for every question of a wave."""
    dimension, hashed = wave.questions.shape[1], buckets is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(sent.value.questions, k, metric)
        marks = sent.value.marks() if hashed else None
        for batch in batches:
            if hashed:
                _compare_marked(best, batch, sent.value, marks, dimension)
            else:
                _compare_cells(best, batch, sent.value, dimension)
            best.flush()
        yield from best.table(sent.value.ids, schema).to_batches()

    if not hashed:
        near = _cell_filter(vectors, wave.probing)
    else:
        parts = sorted({c % BUCKET_PARTS for c in wave.probing})
        found = _cell_filter(buckets.filter(F.col("part").isin(parts)), wave.probing)
        # A list has at most one bucket of each table.
        found = found.groupBy("vec_id").agg(F.collect_list("cell").alias("cells"))
        near = vectors.join(found, "vec_id").select("vec_id", "embedding", "cells")
    tasks = max(TASKS_PER_CORE * vectors.sparkSession.sparkContext.defaultParallelism, HIT_LIMIT // max(1, k * len(wave.ids)))
    return near.coalesce(min(tasks, 1 << 30)).mapInArrow(run, hit_schema)


def _stored_blocks(df: DataFrame, key: str, count: int, order: str | None = None) -> DataFrame:
    """``block, rows``: the rows dealt to ``count`` blocks, each an Arrow stream in a
    partition of its own.  Rows of one key share a block."""

    def pack(rows: pa.Table) -> pa.Table:
        inside = rows.drop_columns(["block"])
        inside = inside.sort_by(order) if order else inside
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, inside.schema) as out:
            out.write_table(inside)
        return pa.table([rows.column("block")[:1], pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "rows"])

    dealt = df.withColumn("block", F.pmod(F.xxhash64(key), F.lit(count)).cast("int"))
    packed = settled(dealt.groupBy("block").applyInArrow(pack, "block INT, rows BINARY"))
    # Blocks are few, so the sample these ranges are made of has all of them.
    return packed.repartitionByRange(count, "block")


def _block_hits(
    questions: DataFrame, count: int, size: int, vectors: DataFrame, buckets: DataFrame | None, k: int, metric: str, dimension: int,
    schema: pa.Schema, hit_schema: t.StructType,
) -> DataFrame:
    """The k best vectors of each block of vectors for ``count`` questions of about
    ``size`` bytes, none of which passes the driver."""
    hashed = buckets is not None
    if hashed:
        found = buckets.groupBy("vec_id").agg(F.collect_list("cell").alias("cells"))
        vectors = vectors.join(found, "vec_id").select("vec_id", "embedding", "cells")
    parts = max(1, -(-vectors.count() * 8 * dimension // VECTOR_LIMIT))
    # Smaller blocks of questions keep all cores busy and cost no further hits.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = min(count, max(-(-count * size // QUESTION_LIMIT), -(-TASKS_PER_CORE * cores // parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave, marks, name = None, None, None
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                # Arrow streams are read in place.
                asked, against = (pa.ipc.open_stream(batch.column(c)[i].as_buffer()).read_all() for c in ("asked", "against"))
                if block != name:
                    wave, name = _Wave(asked, dimension), block
                    marks = wave.marks() if hashed else None
                best = _Best(wave.questions, k, metric)
                for some in against.combine_chunks().to_batches(max_chunksize=_BLOCK_ROWS):
                    if hashed:
                        _compare_marked(best, some, wave, marks, dimension)
                    else:
                        _compare_cells(best, some, wave, dimension)
                    best.flush()
                yield from best.table(wave.ids, schema).to_batches()

    against = _stored_blocks(vectors, "vec_id", parts, None if hashed else "cell").select(F.col("rows").alias("against"))
    asked = _stored_blocks(questions, "query_id", blocks).select("block", F.col("rows").alias("asked"))
    # Each task reads one block of either side; neither is broadcast.
    return against.hint("shuffle_replicate_nl").crossJoin(asked).mapInArrow(run, hit_schema)


def _ranked(hits: DataFrame, k: int, metric: str) -> DataFrame:
    nearest = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    if metric == "ip":
        ranked = ranked.withColumn("distance", -F.col("distance"))
    return ranked.select("query_id", "rank", "vec_id", "distance")


def dimension_of(df: DataFrame, expected: int | None = None) -> int | None:
    """The common dimension of all vectors, checked row by row; None if empty."""
    row = df.agg(F.min(F.size("embedding")).alias("lo"), F.max(F.size("embedding")).alias("hi")).first()
    if row["lo"] != row["hi"]:
        raise ValueError(f"vectors have dimensions from {row['lo']} to {row['hi']}")
    return _expect(row["lo"], expected)


def _first_dimension(df: DataFrame, expected: int | None = None) -> int | None:
    """Dimension of the first vector; deviating rows fail where they are read."""
    row = df.select(F.size("embedding").alias("d")).filter("d >= 0").first()
    return _expect(row and row["d"], expected)


def _expect(found: int | None, expected: int | None) -> int | None:
    if None not in (found, expected) and found != expected:
        raise ValueError(f"vectors have dimension {found}, expected {expected}")
    return found


def _cell_search(
    questions: DataFrame, vectors: DataFrame, buckets: DataFrame | None, k: int, metric: str, dimension: int, question_limit: int,
    probes: int = 0,
) -> tuple[DataFrame, int | None]:
    """``query_id, rank, vec_id, distance``, and how many rows there are at most,
    if one wave does: questions carry ``cells``, about ``probes`` of them or null
    for all, vectors a ``cell`` or, if there are ``buckets``, none."""
    if k < 1:
        raise ValueError("k must be at least 1")
    types = [questions.schema["query_id"].dataType, vectors.schema["vec_id"].dataType]
    hit_schema = t.StructType([
        t.StructField("query_id", types[0]),
        t.StructField("vec_id", types[1]),
        t.StructField("distance", t.DoubleType()),
    ])
    schema = pa.schema([("query_id", _arrow_type(types[0])), ("vec_id", _arrow_type(types[1])), ("distance", pa.float64())])
    questions = questions.select("query_id", "embedding", F.col("cells").cast("array<bigint>").alias("cells"))
    context = vectors.sparkSession.sparkContext

    # At most one row over the limit reaches the driver, and only to tell.
    rows = max(1, question_limit // (8 * dimension + 64 + 16 * probes))
    few = questions.limit(rows + 1).toArrow()
    if few.num_rows <= rows:
        wave = _Wave(few, dimension)
        hits = _wave_hits(wave, context.broadcast(wave), vectors, buckets, k, metric, schema, hit_schema)
        return _ranked(hits, k, metric), k * few.num_rows
    path, count = shared_dir(vectors.sparkSession, "waves"), questions.count()
    if count * (question_limit // rows) > QUESTION_LIMIT:
        hits = _block_hits(questions, count, question_limit // rows, vectors, buckets, k, metric, dimension, schema, hit_schema)
        _ranked(hits, k, metric).write.parquet(f"{path}/hits")
        return vectors.sparkSession.read.parquet(f"{path}/hits"), None
    # Blocks are stored first, so each of them is read once.
    waves = -(-count // rows)
    block = F.pmod(F.xxhash64("query_id"), F.lit(waves)).alias("wave")
    questions.select("*", block).repartition("wave").write.partitionBy("wave").parquet(f"{path}/questions")
    stored = vectors.sparkSession.read.parquet(f"{path}/questions")
    # Small waves share a job: each of its tasks has the questions of one of them.
    together = max(1, min(WAVES_PER_JOB, QUESTION_LIMIT // question_limit))
    for first in range(0, waves, together):
        block = stored.filter(F.col("wave").between(first, first + together - 1)).toArrow()
        number, sent, hits = block.column("wave").to_numpy(), [], []
        for name in np.unique(number):
            wave = _Wave(block.filter(pa.array(number == name)), dimension)
            sent.append(context.broadcast(wave))
            hits.append(_wave_hits(wave, sent[-1], vectors, buckets, k, metric, schema, hit_schema))
        if hits:
            _ranked(reduce(DataFrame.unionAll, hits), k, metric).write.mode("append").parquet(f"{path}/hits")
        for one in sent:
            one.destroy()
    return vectors.sparkSession.read.parquet(f"{path}/hits"), None


# ---------------------------------------------------------------- cells


def default_nlist(n: int) -> int:
    """Number of cells for ``n`` vectors: a tenth up to 100, then the root of n,
    so that cells grow with the root as well."""
    return max(1, min(max(100, math.isqrt(n)), n // 10))


def train_centroids(vectors: DataFrame, nlist: int, seed: int = 42, max_iter: int = 20, fraction: float = 1.0) -> DataFrame:
    """``cell, centroid`` by KMeans over all vectors.

    A ``fraction`` below 1 trains on that share of them, picked by a hash of
    their id; that only places the centroids, every vector is searched.
    """
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be above 0 and at most 1")
    sample = vectors
    if fraction < 1:
        sample = vectors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < math.ceil(fraction * (1 << 20)))
    points = sample.select(array_to_vector("embedding").alias("features"))
    model = KMeans(k=nlist, seed=seed, maxIter=max_iter).fit(points)
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return vectors.sparkSession.createDataFrame(centers, "cell INT, centroid ARRAY<DOUBLE>")


def _centroid_blocks(centroids: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Names and centers of the cells in order, a bounded block at a time."""
    row = centroids.agg(F.count("*").alias("n"), F.max(F.size("centroid")).alias("d"), F.max("cell").alias("top")).first()
    if not row["n"]:
        raise ValueError("no centroids")
    step = max(1, CENTROID_LIMIT // (8 * row["d"]))
    for low in range(0, row["top"] + 1, step):
        block = centroids.filter(F.col("cell").between(low, low + step - 1))
        table = block.select("cell", "centroid").orderBy("cell").toArrow()
        if table.num_rows:
            yield table.column("cell").to_numpy(), _matrix(table.column("centroid"), row["d"])


def nearest_cells(df: DataFrame, centroids: DataFrame, n: int = 1) -> DataFrame:
    """Adds ``cells``, the ``n`` cells nearest to ``embedding``, nearest first.

    Rows pass the blocks of centroids one after the other and carry the best
    cells so far with their distances; as a rule there is one block.
    """
    fields = [t.StructField("cells", t.ArrayType(t.IntegerType())), t.StructField("_far", t.ArrayType(t.DoubleType()))]
    found = df
    for number, block in enumerate(_centroid_blocks(centroids)):
        found = _nearer_cells(found, block, n, bool(number), t.StructType([*df.schema.fields, *fields]))
    return found.drop("_far")


def _nearer_cells(df: DataFrame, block: tuple[np.ndarray, np.ndarray], n: int, merge: bool, schema: t.StructType) -> DataFrame:
    """The ``n`` best cells of a block and (``merge``) of those before it."""
    sent = df.sparkSession.sparkContext.broadcast(block)

    def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, centers = sent.value
        norms = (centers**2).sum(1)
        step = max(1, _BLOCK_CELLS // len(names))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                vector = _matrix(batch.column("embedding"), centers.shape[1])
                far = norms - 2.0 * (vector @ centers.T)
                cells = np.broadcast_to(names, far.shape)
                if merge:
                    # Cells of earlier blocks come first, so ties go to the lower one.
                    before = [batch.column(c).flatten().to_numpy().reshape(len(batch), -1) for c in ("cells", "_far")]
                    cells, far = np.hstack([before[0], cells]), np.hstack([before[1], far])
                order = np.argmin(far, axis=1)[:, None] if n == 1 else np.argsort(far, axis=1, kind="stable")[:, :n]
                best = [np.take_along_axis(x, order, axis=1) for x in (cells, far)]
                columns = [batch.column(c) for c in schema.names[:-2]]
                yield pa.RecordBatch.from_arrays([*columns, lists(best[0], pa.int32()), lists(best[1], pa.float64())], names=schema.names)

    return df.mapInArrow(run, schema)


class Projections:
    """Random directions; a table's bucket is the place of a vector along one of
    them, in steps of ``bucket_length``."""

    def __init__(self, dimension: int, tables: int, bucket_length: float, seed: int):
        directions = np.random.default_rng(seed).normal(size=(dimension, tables))
        self.directions = directions / np.linalg.norm(directions, axis=0) / bucket_length
        self.tables, self.dimension = tables, dimension

    def nearest(self, vectors: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` buckets of each table that are nearest to each vector: an
        array by vector, table and nearness."""
        place = vectors @ self.directions
        home = np.floor(place)
        inside = (place - home)[:, :, None]
        step = np.arange(-n, n + 1)
        far = np.where(step > 0, step - inside, np.where(step < 0, inside - step - 1, -1.0))
        order = np.argsort(far, axis=2, kind="stable")[:, :, :n]
        return home.astype(np.int64)[:, :, None] + step[order]


def _hashed(df: DataFrame, key: str, projections: Projections, n: int) -> DataFrame:
    """``key, hash_table, bucket`` of the nearest buckets of every vector."""
    name = df.schema[key]
    schema = t.StructType([name, t.StructField("hash_table", t.IntegerType()), t.StructField("bucket", t.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = projections.nearest(_matrix(batch.column("embedding"), projections.dimension), n)
            rows, tables, probes = (x.ravel() for x in np.indices(found.shape))
            ids = batch.column(key).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([ids, pa.array(tables.astype(np.int32)), pa.array(found.ravel())], names=schema.names)

    return df.select(key, "embedding").mapInArrow(run, schema)


def _cell() -> Column:
    return F.xxhash64("hash_table", "bucket").alias("cell")


def hash_buckets(vectors: DataFrame, projections: Projections) -> DataFrame:
    """``cell, vec_id, part``: in which bucket of each table a vector lies."""
    found = _hashed(vectors, "vec_id", projections, 1).select(_cell(), "vec_id")
    return found.withColumn("part", F.pmod("cell", F.lit(BUCKET_PARTS)).cast("int"))


# ---------------------------------------------------------------- index


@dataclass(frozen=True)
class VectorIndex:
    """Vectors ready to be searched.

    ``vectors`` has ``vec_id``, ``embedding``, ``cell`` for clustered indexes,
    and any metadata columns.  ``metadata`` may hold them apart instead.  Hashed
    indexes have ``buckets``, a table of ``cell, vec_id, part``.
    """

    vectors: DataFrame
    method: str
    dimension: int
    centroids: DataFrame | None = None
    metadata: DataFrame | None = None
    bucket_length: float = 1.0
    tables: int = 8
    seed: int = 42
    buckets: DataFrame | None = None

    @property
    def spark(self) -> SparkSession:
        return self.vectors.sparkSession

    def search(self, questions: DataFrame, k: int = 5, nprobe: int = 1, question_limit: int = QUESTION_LIMIT) -> DataFrame:
        """``query_id, rank, vec_id, distance`` of the k nearest vectors.

        ``questions`` has ``query_id`` and ``embedding``.  Distances are squared
        L2, or the inner product (larger is nearer) for ``flat_ip``.  Ties go to
        the smaller id; fewer than k vectors give fewer rows.  ``nprobe`` cells
        are probed, or buckets of each table of a hashed index, nearest first.

        The questions are evaluated here, once if a wave of ``question_limit``
        bytes takes them all.  Otherwise the waves, or pairs of blocks, run here as
        well; write an expensive question table before searching.
        """
        return self._search(questions, k, nprobe, question_limit)[0]

    def _search(self, questions: DataFrame, k: int, nprobe: int, question_limit: int) -> tuple[DataFrame, int | None]:
        questions = questions.select("query_id", "embedding").filter("embedding IS NOT NULL")
        vectors, probes = self.vectors, 0
        if self.method == "ivf":
            questions, count = nearest_cells(questions, self.centroids, nprobe), self.centroids.count()
            # A list of all cells says no more than that all are probed.
            probes = 0 if nprobe >= count else nprobe
            questions = questions.withColumn("cells", F.when(F.size("cells") < count, F.col("cells")))
        elif self.method == "lsh":
            probes = _hashed(questions, "query_id", self.projections(), nprobe).withColumn("cell", _cell())
            cells = probes.groupBy("query_id").agg(F.collect_set("cell").alias("cells"))
            questions, probes = questions.join(cells, "query_id"), nprobe * self.tables
        else:
            questions = questions.withColumn("cells", F.lit(None).cast("array<bigint>"))
            vectors = vectors.withColumn("cell", F.lit(0))
        metric = "ip" if self.method == "flat_ip" else "l2"
        columns = ["vec_id", "embedding"] if self.method == "lsh" else ["vec_id", "embedding", F.col("cell").cast("bigint").alias("cell")]
        return _cell_search(questions, vectors.select(*columns), self.buckets, k, metric, self.dimension, question_limit, probes)

    def search_with_metadata(self, questions: DataFrame, k: int = 5, nprobe: int = 1) -> DataFrame:
        """Hits with their score and metadata.

        Hits without metadata are dropped.  Hits known to be few are broadcast,
        so the metadata stay in place.
        """
        hits, most = self._search(questions, k, nprobe, QUESTION_LIMIT)
        if most is not None and most <= BROADCAST_HITS:
            hits = F.broadcast(hits)
        score = F.lit(None).cast("double") if self.method == "flat_ip" else similarity_score(F.col("distance"))
        return hits.withColumn("score", score).join(self.metadata_table(), "vec_id")

    def metadata_table(self) -> DataFrame:
        if self.metadata is not None:
            return self.metadata
        return self.vectors.drop("embedding", "cell", "text_digest", "tokens", "embed_error")

    def add(self, vectors: DataFrame, metadata: DataFrame | None = None) -> VectorIndex:
        """The index with more vectors, cells assigned by the same centroids."""
        _first_dimension(vectors, self.dimension)
        if self.metadata is not None:
            if metadata is None or not _aligned(vectors, metadata):
                raise ValueError("every new vector needs exactly one metadata row")
            metadata = self.metadata.unionByName(metadata)
        fresh = _usable(vectors) if self.centroids is None else _with_cell(_usable(vectors), self.centroids)
        buckets = self.buckets
        if buckets is not None:
            buckets = buckets.unionByName(hash_buckets(fresh, self.projections()))
        vectors = self.vectors.unionByName(fresh, allowMissingColumns=True)
        return replace(self, vectors=vectors, metadata=metadata if metadata is not None else self.metadata, buckets=buckets)

    def is_coherent(self) -> bool:
        """Whether vectors and metadata have the same keys."""
        if self.metadata is None:
            raise ValueError("no separate metadata loaded")
        return _aligned(self.vectors, self.metadata)

    def stats(self) -> DataFrame:
        """One row of index figures; ``coherent`` is null without metadata."""
        sides = self.vectors.select("vec_id", F.size("embedding").alias("d"), F.lit(1).alias("v"), F.lit(0).alias("m"))
        if self.metadata is not None:
            sides = sides.unionByName(
                self.metadata.select("vec_id", F.lit(None).cast("int").alias("d"), F.lit(0).alias("v"), F.lit(1).alias("m"))
            )
        per_key = sides.groupBy("vec_id").agg(F.max("d").alias("d"), F.sum("v").alias("v"), F.sum("m").alias("m"))
        has_metadata = F.lit(self.metadata is not None)
        return per_key.agg(
            F.max("d").alias("dimension"),
            F.coalesce(F.sum("v"), F.lit(0)).alias("nombre_vecteurs"),
            F.lit(self.method).alias("type_index"),
            F.lit(True).alias("is_trained"),
            F.coalesce(F.sum("m"), F.lit(0)).alias("nb_metadata"),
            F.when(has_metadata, F.count_if(F.col("v") != F.col("m")) == 0).alias("coherent"),
        )

    def projections(self) -> Projections:
        return Projections(self.dimension, self.tables, self.bucket_length, self.seed)


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows with a vector of finite numbers; failed embeddings are no points."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    usable = vectors.filter(F.col("embedding").isNotNull() & finite)
    return usable.filter("embed_error IS NULL") if "embed_error" in vectors.columns else usable


def _with_cell(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    placed = nearest_cells(vectors.drop("cell"), centroids, 1)
    return placed.withColumn("cell", F.col("cells")[0]).drop("cells")


def _aligned(vectors: DataFrame, metadata: DataFrame) -> bool:
    from recueil.operators.merge import unmatched_keys

    return unmatched_keys(vectors, metadata, "vec_id").isEmpty()


def build_index(
    vectors: DataFrame,
    method: str = "flat_l2",
    dimension: int | None = None,
    metadata: DataFrame | None = None,
    nlist: int | None = None,
    seed: int = 42,
    bucket_length: float = 1.0,
    tables: int = 8,
) -> VectorIndex:
    """An index over ``vec_id, embedding`` (plus metadata columns).

    ``flat_l2`` and ``flat_ip`` are exact, ``ivf`` clusters the vectors into
    ``nlist`` cells, ``lsh`` hashes them into ``tables`` bucket tables.  Cells and
    buckets are settled here, in the checkpoint folder, and not at every search.
    """
    if method not in METHODS:
        raise ValueError(f"unknown index method {method!r}; known: {METHODS}")
    vectors = _usable(vectors)
    found = _first_dimension(vectors, dimension)
    if found is None and dimension is None:
        raise ValueError("cannot tell the dimension of an empty vector table")
    centroids = buckets = None
    if method == "ivf":
        centroids = train_centroids(vectors, nlist or default_nlist(vectors.count()), seed)
        vectors = settled(_with_cell(vectors, centroids))
    index = VectorIndex(vectors, method, found or dimension, centroids, metadata, bucket_length, tables, seed)
    if method == "lsh":
        buckets = settled(hash_buckets(vectors, index.projections()))
    return replace(index, buckets=buckets)
