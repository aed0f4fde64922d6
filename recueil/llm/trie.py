"""Prefix trie of conversations that share the head of another one.

Every conversation c is rebuilt: the first h turns of its base, conversation
``c - c % 100``, then its own turns after its first h; h = crc32(c) % 6.  Each
distinct sequence of first d rebuilt turns is a node.

Fingerprints.  A turn is a 64-bit number t, a sequence of turns the polynomial
``t1*B + t2*B**2 + ...`` modulo 2**64 with its length.  Sequences are a monoid:
``(p, m) + (q, n) = (p + q * B**m, m + n)``, and B has an inverse.  So the prefixes
of a rebuilt conversation follow from the prefix products of the base's head and
of the own turns; no rebuilt text, and no list of rebuilt turns, is ever made.
Products of a conversation that lies in several tasks are composed from those of
its parts: the turns are dealt by ranges of (conversation, turn), so that one of
any length is spread, and a row per range carries the product on.

Nodes.  A member row is a fingerprint with the reference of its last turn: the
stored turn of base or conversation it came from, by its digest.  Rows with one
fingerprint must agree in depth, parent and referenced turn, which is checked for
every node; by induction the whole prefixes then agree.  Otherwise the work is done
again with another base B.

Sums over subtrees.  A node of one member is the top of a single path.  Only nodes
of several members need sums; they are found by pointer doubling, in as many
rounds as the deepest of them has binary digits, each over the nodes alone.

The hash of the ids that end in a node is sequential.  Ids are joined in range
order in many tasks first; the hash then runs over these pieces, one after another.

Defined results: null role and text are empty; turns of one conversation that are
equal in ``turn`` follow in order of the digest of role and text, null turns first;
rows without conv_id belong to no conversation; an empty table has no nodes;
further columns do not enter.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from recueil.llm.common import stored, whole_text

#: Conversations of one base, and the most turns a head can have, plus one.
FAMILY = 100
HEADS = 6

#: Odd numbers; the next is taken if a collision is found.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)
_MASK = (1 << 64) - 1

#: Ids that are joined to one piece of text.
PIECE = 100_000
_EMPTY = hashlib.sha256().hexdigest()


def head_turns(conv_id: int) -> int:
    """How many turns of its base a conversation starts with at most."""
    return zlib.crc32(str(conv_id).encode()) % HEADS


class Monoid:
    """Products of turns for one base."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = np.ones(1, np.uint64)

    def powers(self, n: int) -> np.ndarray:
        """The powers 0 to n of the base."""
        if n >= len(self.up):
            size = max(n + 1, 2 * len(self.up), 1024)
            self.up = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, self.base, np.uint64))])
        return self.up[: n + 1]

    def joined(self, p: int, m: int, q: int) -> int:
        """The product of a sequence of m turns and another one."""
        return (p + q * pow(self.base, m, 1 << 64)) & _MASK


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _batch(names: list[str], columns: list) -> pa.RecordBatch:
    arrays = [x if isinstance(x, pa.Array) else pa.array(x.view(np.int64) if getattr(x, "dtype", None) == np.uint64 else x) for x in columns]
    return pa.RecordBatch.from_arrays(arrays, names=names)


_TURN = "conv_id BIGINT, place BIGINT, product BIGINT, before BIGINT, ref BIGINT, chars BIGINT"
_TURN_NAMES = ["conv_id", "place", "product", "before", "ref", "chars"]


def _scanned(rows: DataFrame, monoid: Monoid) -> DataFrame:
    """Places of turns within each range of the sorted rows, with the product up
    to each turn and the one ``before`` it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place, total, task = None, 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, turn = _numbers(batch.column("conv_id")), _numbers(batch.column("turn_hash")).view(np.uint64)
            fresh = np.ones(len(conv), bool)
            fresh[1:] = conv[1:] != conv[:-1]
            start = np.flatnonzero(fresh)
            length = np.diff(np.append(start, len(conv)))
            before = np.zeros(len(start), np.int64)
            sums = np.zeros(len(start), np.uint64)
            if conv[0] == last:  # goes on from the batch before
                before[0], sums[0] = place, np.uint64(total)
            places = np.arange(len(conv)) - np.repeat(start - before, length) + 1
            term = turn * monoid.powers(int(places.max()))[places]
            steps = np.cumsum(term)
            offset = np.where(start > 0, steps[np.maximum(start - 1, 0)], np.uint64(0))
            product = steps - np.repeat(offset, length) + np.repeat(sums, length)
            last, place, total = int(conv[-1]), int(places[-1]), int(product[-1])
            yield _batch(
                ["task", *_TURN_NAMES],
                [np.full(len(conv), task, np.int32), conv, places, product, product - term, batch.column("ref"), batch.column("chars")],
            )

    return rows.mapInArrow(run, "task INT, " + _TURN)


def _carried(scanned: DataFrame, monoid: Monoid) -> DataFrame:
    """The same rows, conversations that lie in several ranges joined."""
    end = F.max_by(F.struct("conv_id", "place", "product"), F.struct("conv_id", "place")).alias("end")
    ends = scanned.groupBy("task").agg(F.min("conv_id").alias("first"), end).orderBy("task").collect()  # one row per range
    carry, conv, place, product = {}, None, 0, 0
    for row in ends:
        if row["first"] == conv:
            carry[row["task"]] = (conv, place, product)
        same = row["end"]["conv_id"] == conv and row["first"] == conv
        before, total = (place, product) if same else (0, 0)
        conv = row["end"]["conv_id"]
        product = monoid.joined(total, before, row["end"]["product"] & _MASK)
        place = before + row["end"]["place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, place = _numbers(batch.column("conv_id")), _numbers(batch.column("place"))
            product, before = (_numbers(batch.column(c)).view(np.uint64) for c in ("product", "before"))
            for task in set(batch.column("task").to_pylist()) & set(carry):
                name, n, total = carry[task]
                here = (conv == name) & (_numbers(batch.column("task")) == task)
                place = np.where(here, place + n, place)
                start, times = np.uint64(total), np.uint64(pow(monoid.base, n, 1 << 64))
                product, before = (np.where(here, start + x * times, x) for x in (product, before))
            yield _batch(_TURN_NAMES, [conv, place, product, before, batch.column("ref"), batch.column("chars")])

    return scanned.mapInArrow(run, _TURN)


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns without their texts: two halves of a digest, and a length."""
    role, text = whole_text("role"), whole_text("text")
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    # Fifteen hexadecimal digits each, which a signed number holds.
    half = [F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint") for at in (1, 16)]
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        half[0].alias("turn_hash"), half[1].alias("ref"), F.length(text).cast("bigint").alias("chars"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_hash"), F.col("ref")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


_MEMBER = "conv_id BIGINT, depth BIGINT, fp BIGINT, parent BIGINT, ref BIGINT, chars BIGINT, ends BOOLEAN"
_MEMBER_NAMES = ["conv_id", "depth", "fp", "parent", "ref", "chars", "ends"]
_PLAN = "conv_id BIGINT, head BIGINT, skipped BIGINT, plus BIGINT, times BIGINT, length BIGINT, end_fp BIGINT"


def _plans(turns: DataFrame, monoid: Monoid) -> DataFrame:
    """Per conversation the turns ``head`` it takes of its base, the number of its
    own that it ``skipped``, and what moves a product of its own turns to the one
    of the rebuilt sequence: ``product * times + plus``; also the ``heads`` rows.
    """
    first = F.when(F.col("place") < HEADS, F.struct("place", "product", "ref", "chars"))
    convs = turns.groupBy("conv_id").agg(
        F.max("place").alias("n"), F.max_by("product", "place").alias("last"), F.sort_array(F.collect_list(first)).alias("first")
    )
    convs = stored(convs, "trie_convs")
    base = convs.select(F.col("conv_id").alias("base_id"), F.col("first").alias("head_turns"))
    mine = convs.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % FAMILY).join(
        base.filter(F.col("base_id") % FAMILY == 0), "base_id", "left"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "head", "skipped", "plus", "times", "length", "end_fp", "heads"]
        kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("depth", "fp", "parent", "ref", "chars")]))
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for batch in batches:
            out: list[list] = [[] for _ in names]
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "n", "last", "first", "head_turns")]
            for conv, n, last, first, theirs in zip(*columns, strict=True):
                h = head_turns(conv)
                taken = (theirs or [])[:h]
                head, skipped = len(taken), min(h, n)
                start = taken[-1]["product"] & _MASK if taken else 0
                own = first[skipped - 1]["product"] & _MASK if skipped else 0
                # Own turns stood at h + 1 and on; they go to head + 1 and on.
                times = pow(monoid.inverse, h - head, 1 << 64)
                plus = (start - own * times) & _MASK
                end = (last * times + plus) & _MASK if n > h else start
                heads = [{"depth": 0, "fp": 0, "parent": None, "ref": 0, "chars": 0}]
                for x in taken:
                    row = {"depth": len(heads), "fp": x["product"], "parent": heads[-1]["fp"], "ref": x["ref"], "chars": x["chars"]}
                    heads.append(row)
                row = (conv, head, skipped, signed(plus), signed(times), head + max(0, n - h), signed(end), heads)
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in out[:-1]], pa.array(out[-1], kind)], names=names)

    heads = "heads ARRAY<STRUCT<depth: BIGINT, fp: BIGINT, parent: BIGINT, ref: BIGINT, chars: BIGINT>>"
    return mine.select("conv_id", "n", "last", "first", "head_turns").mapInArrow(run, f"{_PLAN}, {heads}")


def _members(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """One row per rebuilt turn, and the root, of every conversation."""
    heads = plans.select("conv_id", "length", F.explode("heads").alias("x"))
    shared = heads.select("conv_id", "x.*", (F.col("x.depth") == F.col("length")).alias("ends"))
    own = turns.join(plans.drop("heads", "end_fp"), "conv_id").filter(F.col("place") > F.col("skipped"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, skipped, head, length = (_numbers(batch.column(c)) for c in ("place", "skipped", "head", "length"))
            before, product, plus, times = (_numbers(batch.column(c)).view(np.uint64) for c in ("before", "product", "plus", "times"))
            depth = place - skipped + head
            yield _batch(_MEMBER_NAMES, [
                batch.column("conv_id"), depth, product * times + plus, before * times + plus,
                batch.column("ref"), batch.column("chars"), depth == length,
            ])

    return shared.select(*_MEMBER_NAMES).unionByName(own.mapInArrow(run, _MEMBER))


def _nodes(members: DataFrame) -> DataFrame:
    """Members by fingerprint; ``agree`` tells whether they are one sequence."""
    grouped = members.groupBy("fp").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.count("*").alias("n_convs"),
        F.min("chars").alias("chars"), F.count_if("ends").alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("end_id"),
        *[(F.min(c).eqNullSafe(F.max(c))).alias(f"same_{c}") for c in ("depth", "parent", "ref", "chars")],
    )
    agree = F.col("same_depth") & F.col("same_parent") & F.col("same_ref") & F.col("same_chars")
    return grouped.withColumn("agree", agree).drop("same_depth", "same_parent", "same_ref", "same_chars")


def _subtree_sums(shared: DataFrame, tops: DataFrame) -> DataFrame:
    """``fp, n_children, n_leaves, saved_tokens`` of the nodes of several members.

    ``tops`` are the nodes right below one of them.
    """
    children = tops.groupBy("parent").agg(F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("paths"))
    children = children.withColumnRenamed("parent", "fp")
    own = shared.join(children, "fp", "left").na.fill(0, ["n_children", "paths"])
    sums = stored(own.select(
        "fp", F.col("parent").alias("above"), "depth", "n_children",
        (F.col("paths") + (F.col("n_children") == 0).cast("bigint")).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    ), "trie_sums")
    deepest, reach = sums.agg(F.max("depth")).first()[0] or 0, 1
    while reach <= deepest:
        # Every node holds the sums of less than ``reach`` steps below it, and
        # points to the node ``reach`` steps above.
        lower = sums.filter("above IS NOT NULL").groupBy(F.col("above").alias("fp")).agg(
            F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved")
        )
        further = sums.select(F.col("fp").alias("above"), F.col("above").alias("_above"))
        joined = sums.join(lower, "fp", "left").join(further, "above", "left")
        sums = stored(joined.select(
            "fp", F.col("_above").alias("above"), "depth", "n_children",
            (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens"),
        ), "trie_sums")
        reach *= 2
    return sums.select("fp", "n_children", "n_leaves", "saved_tokens")


def ids_hashed(rows: DataFrame) -> DataFrame:
    """``fp, ends_sha256``: the hash of the ids ``conv_id`` of each ``fp``, in
    order and joined by commas."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, ids = _numbers(batch.column("fp")), _numbers(batch.column("conv_id"))
            start = np.flatnonzero(np.append(True, fp[1:] != fp[:-1])) if len(fp) else np.zeros(0, np.int64)
            cuts = sorted({*start.tolist(), *range(0, len(fp), PIECE), len(fp)})
            texts = [",".join(map(str, ids[a:b].tolist())).encode() for a, b in zip(cuts, cuts[1:], strict=False)]
            at = cuts[:-1]
            yield _batch(["fp", "conv_id", "ids"], [fp[at], ids[at], pa.array(texts, pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            done: list[tuple[int, str]] = []
            for fp, ids in zip(batch.column("fp").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if fp != last:
                    done += [(last, state.hexdigest())] if state else []
                    last, state = fp, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
            yield _hashes(done)
        yield _hashes([(last, state.hexdigest())] if state else [])

    order = ["fp", "conv_id"]
    pieces = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "fp BIGINT, conv_id BIGINT, ids BINARY")
    return pieces.repartition("fp").sortWithinPartitions(*order).mapInArrow(run, "fp BIGINT, ends_sha256 STRING")


def _hashes(done: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.string())], names=["fp", "ends_sha256"])


def _checked_nodes(conversations: DataFrame, base: int) -> tuple[DataFrame, DataFrame] | None:
    """Nodes and plans under one base; nothing if two prefixes collide."""
    monoid = Monoid(base)
    scanned = stored(_scanned(_turns(conversations), monoid), "trie_turns")
    turns = _carried(scanned, monoid)
    plans = stored(_plans(turns, monoid), "trie_plans")
    nodes = stored(_nodes(_members(turns, plans)), "trie_nodes")
    return (nodes, plans) if nodes.filter("NOT agree").isEmpty() else None


def prefix_trie(conversations: DataFrame, bases: tuple[int, ...] = BASES) -> DataFrame:
    """One row per node: ``conv_id`` (its smallest member), ``depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    found = next((x for base in bases if (x := _checked_nodes(conversations, base))), None)
    if found is None:
        raise RuntimeError("fingerprints collide under all bases")
    nodes, plans = found
    shared = nodes.filter("n_convs > 1")
    above = shared.select(F.col("fp").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = nodes.join(above, "parent", "left")
    sums = _subtree_sums(shared, placed.filter("parent_conv_id IS NOT NULL").select("parent", "n_convs"))
    crowded = nodes.filter("n_ends > 1").select(F.col("fp").alias("end_fp"))
    ended = plans.select("end_fp", "conv_id").join(crowded, "end_fp", "left_semi").withColumnRenamed("end_fp", "fp")
    hashed = ids_hashed(ended)
    one = F.when(F.col("n_ends") == 1, F.sha2(F.col("end_id").cast("string"), 256)).otherwise(_EMPTY)
    path = F.lit(1).cast("bigint")
    return placed.join(sums, "fp", "left").join(hashed, "fp", "left").select(
        "conv_id", "depth",
        # Above a single path lies a shared node, or the same path.
        F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", (F.col("n_ends") == 0).cast("bigint")).alias("n_children"),
        F.coalesce("n_leaves", path).alias("n_leaves"), F.coalesce("saved_tokens", path - 1).alias("saved_tokens"),
        F.coalesce("ends_sha256", one).alias("ends_sha256"),
    )
