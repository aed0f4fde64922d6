"""SimHash near-duplicates by the general pigeonhole principle.

A text's fingerprint has 64 bits; a bit is 1 if it is set in over half of the
hashes of the text's 4-word shingles.  Fingerprints link at ``REACH`` or fewer
differing bits.

Partitions.  The 64 bits are dealt to m partitions so that bits which vary
together share one: what they say is then said once.  The correlations are those
of all distinct fingerprints.

Thresholds.  If x and y differ in at most ``REACH`` bits and the thresholds of m
partitions sum to ``REACH - m + 1``, then in some partition x and y differ in at
most its threshold.  Thresholds may be unequal, and -1 leaves a partition out.
Every fingerprint gets its own, by dynamic programming over the partitions: a
threshold costs the values that are looked up and the candidates they are
estimated to bring.  The estimate counts exactly how many fingerprints lie at
each distance within pieces of at most ``PIECE`` bits, and takes pieces as
independent.  m is the one whose thresholds cost least in total.

Probing.  All fingerprints are indexed under the value of each partition.  First
the fingerprints under one value are compared among themselves, in blocks of
``BLOCK``; that joins dense groups.  Then fingerprints look up all values within
their thresholds, and candidates of other components are verified by their bits.
Of two components the one with fewer fingerprints asks, so a very large one does
not.  A value with more than ``BLOCK`` fingerprints is cut into blocks, each in a
task of its own; a value under which only one component stands is not asked by
that component.  Tasks give the links that join components, not all pairs.

Defined results: null and empty texts, and texts without words, have fingerprint
zero, which links like any other; fewer than four words are one shingle; equal
fingerprints are one class from the start, so repeated rows cost one; a null id
is never the smallest id unless all are null; an empty table gives an empty
result; other columns of the input do not enter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as t

from recueil.llm.common import small, stored, whole_text
from recueil.llm.components import components

WORDS = 4
SEED = 42
#: Bits that linked fingerprints differ in at most.
REACH = 4
BITS = 64

#: Numbers of partitions to choose from, and bits counted together.
PARTITIONS = (2, 3, 4, 5)
PIECE = 11
#: Costs of a value looked up (a row that is shuffled) and of a candidate.
LOOKUP, CANDIDATE = 1.0, 0.01

#: Fingerprints under one value that are compared in one task, candidates that
#: are compared at a time, and fingerprints (by number of documents) whose
#: component is broadcast.
BLOCK = 500
AT_A_TIME = 1 << 21
HOT = 50_000

#: Shingles whose bits are counted at a time.
SHINGLES = 1 << 16
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes) -> int:
    """The fingerprint of UTF-8 bytes, as an unsigned number."""
    words = text.translate(_FOLD).split()
    if not words:
        return 0
    joined, ends, at = memoryview(b" ".join(words)), [], 0
    for word in words:
        at += len(word)
        ends.append(at)
        at += 1
    first = [0, *[x + 1 for x in ends[:-1]]]
    last, hashed = ends[WORDS - 1 :] or ends[-1:], xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, np.int64), len(last)
    for a in range(0, n, SHINGLES):
        hashes = [hashed(joined[x:y], SEED) for x, y in zip(first[a : a + SHINGLES], last[a : a + SHINGLES])]  # noqa: B905
        ones += _bits(np.array(hashes, np.uint64)).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _bits(numbers: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones per number, the lowest bit first."""
    return np.unpackbits(numbers.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp``: the fingerprint of every document as a signed number."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), whole_text(text).alias("text"))
    schema = t.StructType([t.StructField("key", rows.schema["key"].dataType), t.StructField("fp", t.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_buffer().to_pybytes()) for x in batch.column("text").cast(pa.large_binary())]
            numbers = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(numbers)], names=["key", "fp"])

    return rows.mapInArrow(run, schema)


# ------------------------------------------------------------- partitions


def pair_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Fingerprints, and how many have both bits of each pair set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            numbers = _unsigned(batch.column("fp"))
            for a in range(0, len(numbers), SHINGLES):
                bits = _bits(numbers[a : a + SHINGLES]).astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
            n += len(numbers)
        place = np.arange(BITS * BITS + 1, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.append(both.ravel(), n))], names=["place", "n"])

    counted = prints.select("fp").mapInArrow(run, "place INT, n BIGINT").groupBy("place").agg(F.sum("n").alias("n"))
    sums = np.zeros(BITS * BITS + 1, np.int64)
    for row in counted.collect():  # always 4,097 rows
        sums[row["place"]] = row["n"]
    return int(sums[-1]), sums[:-1].reshape(BITS, BITS)


def partitioned(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits dealt to partitions of nearly equal size, correlated ones
    together."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(share * (1 - share))
    related = np.abs(both / max(n, 1) - np.outer(share, share)) / np.maximum(np.outer(spread, spread), 1e-9)
    np.fill_diagonal(related, 0)
    left, out = set(range(BITS)), []
    for i in range(parts):
        size = BITS // parts + (i < BITS % parts)
        rest = sorted(left)
        group = [max(rest, key=lambda b: (related[b, rest].max(), -b))]
        while len(group) < size:
            rest = sorted(left - set(group))
            group.append(max(rest, key=lambda b: (related[b, group].mean(), -b)))
        left -= set(group)
        out.append(sorted(group))
    return out


def values(numbers: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits of a partition, packed."""
    out = np.zeros(len(numbers), np.uint64)
    for i, b in enumerate(bits):
        out |= ((numbers >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return out


def _pieces(bits: list[int]) -> list[list[int]]:
    n = -(-len(bits) // PIECE)
    return [bits[i::n] for i in range(n)]


def piece_counts(prints: DataFrame, pieces: list[list[int]]) -> list[np.ndarray]:
    """For every piece, how many fingerprints have each of its values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(1 << len(x), np.int64) for x in pieces]
        for batch in batches:
            numbers = _unsigned(batch.column("fp"))
            for total, piece in zip(sums, pieces, strict=True):
                total += np.bincount(values(numbers, piece).astype(np.int64), minlength=len(total))
        for i, total in enumerate(sums):
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["piece", "value", "n"]
            )

    rows = prints.select("fp").mapInArrow(run, "piece INT, value INT, n BIGINT").groupBy("piece", "value").agg(F.sum("n").alias("n"))
    out = [np.zeros(1 << len(x), np.int64) for x in pieces]
    for row in rows.collect():  # at most 2,048 values of each piece
        out[row["piece"]][row["value"]] = row["n"]
    return out


class Plan:
    """Partitions with the counts that thresholds are estimated from."""

    def __init__(self, parts: list[list[int]], counts: list[list[np.ndarray]]):
        self.parts, self.m = parts, len(parts)
        #: The largest threshold; one above an equal share, so that others may be lower.
        self.most = min(REACH, REACH - self.m + 2)
        self.near = [[_at_distance(x) for x in pieces] for pieces in counts]
        self.n = max(int(counts[0][0].sum()), 1)
        #: Sets of values to look up per partition and threshold.
        self.masks = [[_masks(len(bits), k) for k in range(self.most + 1)] for bits in parts]

    def costs(self, numbers: np.ndarray) -> np.ndarray:
        """Cost of every partition (axis 1) at thresholds -1, 0, ... (axis 2)."""
        most = self.most
        out = np.zeros((len(numbers), self.m, most + 2))
        for i, bits in enumerate(self.parts):
            share = np.zeros((len(numbers), most + 1))
            share[:, 0] = 1
            for piece, near in zip(_pieces(bits), self.near[i], strict=True):
                own = near[values(numbers, piece).astype(np.int64)][:, : most + 1] / self.n
                share = np.stack([(share[:, : k + 1] * own[:, k::-1]).sum(axis=1) for k in range(most + 1)], axis=1)
            within = np.cumsum(share, axis=1) * self.n
            looked = np.cumsum([len(x) for x in self.masks[i]])
            out[:, i, 1:] = LOOKUP * looked + CANDIDATE * within
        return out

    def thresholds(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The thresholds of every fingerprint that cost least, and their cost."""
        cost, most = self.costs(numbers), self.most
        # A state is the sum of (threshold + 1) so far; in the end it is REACH + 1.
        states = REACH + 2
        best = np.full((len(numbers), states), np.inf)
        best[:, 0] = 0
        choices = []
        for i in range(self.m):
            step = np.full((len(numbers), states, most + 2), np.inf)
            for k in range(most + 2):
                step[:, k:, k] = best[:, : states - k] + cost[:, i, k, None]
            choices.append(step.argmin(axis=2))
            best = step.min(axis=2)
        state, out = np.full(len(numbers), states - 1), np.zeros((len(numbers), self.m), np.int64)
        for i in range(self.m - 1, -1, -1):
            k = choices[i][np.arange(len(numbers)), state]
            out[:, i] = k - 1
            state = state - k
        return out, best[:, -1]


def _at_distance(counts: np.ndarray) -> np.ndarray:
    """For every value, how many fingerprints differ from it in 0, 1, ... bits."""
    index = np.arange(len(counts))
    out = np.zeros((len(counts), REACH + 1), np.int64)
    for mask in index[np.bitwise_count(index) <= REACH]:
        out[:, int(mask).bit_count()] += counts[index ^ mask]
    return out


def _masks(bits: int, weight: int) -> np.ndarray:
    """All numbers of so many bits with this many of them set."""
    found = [(0, 0)]
    for _ in range(weight):
        found = [(x | 1 << b, b + 1) for x, low in found for b in range(low, bits)]
    return np.array([x for x, _ in found], np.uint64)


def planned(prints: DataFrame) -> Plan:
    """The plan whose thresholds cost least over all fingerprints."""
    n, both = pair_counts(prints)
    dealt = [partitioned(n, both, m) for m in PARTITIONS]
    pieces = [piece for parts in dealt for bits in parts for piece in _pieces(bits)]
    counts = iter(piece_counts(prints, pieces))
    plans = [Plan(parts, [[next(counts) for _ in _pieces(bits)] for bits in parts]) for parts in dealt]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(plans))
        for batch in batches:
            numbers = _unsigned(batch.column("fp"))
            for a in range(0, len(numbers), SHINGLES):
                sums += [p.thresholds(numbers[a : a + SHINGLES])[1].sum() for p in plans]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(plans), dtype=np.int32)), pa.array(sums)], names=["plan", "cost"])

    total = prints.select("fp").mapInArrow(run, "plan INT, cost DOUBLE").groupBy("plan").agg(F.sum("cost").alias("cost")).collect()
    return plans[min((r["cost"], r["plan"]) for r in total)[1]] if total else plans[-1]


# ---------------------------------------------------------------- probing

_INDEX = "part INT, value BIGINT, fp BIGINT, component BIGINT, size BIGINT, asks BOOLEAN"


def _table(part: int, at: np.ndarray, numbers: np.ndarray, component: np.ndarray, size: np.ndarray, asks: bool) -> pa.RecordBatch:
    n = len(at)
    columns = [
        pa.array(np.full(n, part, np.int32)), pa.array(at.view(np.int64)), pa.array(numbers.view(np.int64)),
        pa.array(component), pa.array(size), pa.array(np.full(n, asks)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["part", "value", "fp", "component", "size", "asks"])


def _indexed(prints: DataFrame, plan: Plan, asking: bool) -> DataFrame:
    """Every fingerprint under its value in each partition and, if asking, under
    the values within its thresholds; the largest component does not ask.

    ``prints`` has ``fp, component, size, asker``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = _unsigned(batch.column("fp"))
            component, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("component", "size"))
            own = [values(numbers, bits) for bits in plan.parts]
            for i, at in enumerate(own):
                yield _table(i, at, numbers, component, size, False)
            if not asking:
                continue
            asker = np.flatnonzero(batch.column("asker").to_numpy(zero_copy_only=False))
            chosen, _ = plan.thresholds(numbers[asker])
            for i, at in enumerate(own):
                for k, masks in enumerate(plan.masks[i]):
                    who = asker[chosen[:, i] >= k]
                    for a in range(0, len(who), max(1, AT_A_TIME // len(masks))):
                        some = who[a : a + max(1, AT_A_TIME // len(masks))]
                        if len(some):
                            looked = (at[some][:, None] ^ masks[None, :]).ravel()
                            again = np.repeat(some, len(masks))
                            yield _table(i, looked, numbers[again], component[again], size[again], True)

    return prints.select("fp", "component", "size", "asker").mapInArrow(run, _INDEX)


def _dealt(rows: DataFrame) -> DataFrame:
    """Adds ``block``: values with many fingerprints are cut into blocks, and who
    asks there goes to each of them."""
    crowds = rows.filter("NOT asks").groupBy("part", "value").agg(
        F.count("*").alias("_n"), F.min("component").alias("_low"), F.max("component").alias("_high")
    ).filter(F.col("_n") > BLOCK)
    crowds = stored(crowds.select("part", "value", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks"), "_low", "_high"), "simhash_crowds")
    met = rows.join(small(crowds), ["part", "value"], "left")
    idle = F.col("asks") & (F.col("_low") == F.col("_high")) & (F.col("component") == F.col("_low"))
    one = F.array(F.pmod(F.xxhash64("fp", "part"), F.coalesce("_blocks", F.lit(1))).cast("int"))
    every = F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1)
    block = F.explode(F.when(F.col("asks"), every).otherwise(one)).alias("block")
    return met.filter(F.coalesce(~idle, F.lit(True))).select("part", "value", block, "fp", "component", "size", "asks")


_COLUMNS = ("part", "value", "block", "fp", "component", "size", "asks")
_LINKS = "a BIGINT, b BIGINT"


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Columns of whole groups of sorted rows, with where each group starts."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in _COLUMNS]
        if kept is not None:
            columns = [np.concatenate([x, y]) for x, y in zip(kept, columns, strict=True)]
        starts, whole = _starts(columns), 0
        if len(starts) > 1:
            whole = starts[-1]
            yield [x[:whole] for x in columns], starts[:-1]
        kept = [x[whole:] for x in columns]
    if kept is not None and len(kept[0]):
        yield kept, _starts(kept)


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    fresh = np.ones(len(columns[0]), bool)
    fresh[1:] = np.any([x[1:] != x[:-1] for x in columns[:3]], axis=0)
    return np.flatnonzero(fresh)


def _joining(a: np.ndarray, b: np.ndarray, root: dict[int, int]) -> list[tuple[int, int]]:
    """Of links between labels those that join what others have not joined."""

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    out = []
    for x, y in np.unique(np.stack([a, b], axis=1), axis=0).tolist() if len(a) else ():
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def block_links(numbers: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
    """Links within groups of neighbouring rows, enough to connect what all
    links of a group connect."""
    signed, end = numbers.view(np.int64), np.append(starts[1:], len(numbers))
    last = np.repeat(end, end - starts)
    at = np.flatnonzero(np.arange(len(numbers)) + 1 < last)
    root, label, out, distance, stale = {}, signed.copy(), [], 1, False
    while len(at):
        # Rows ``distance`` apart, of groups that are that long.
        near = at[np.bitwise_count(numbers[at] ^ numbers[at + distance]) <= REACH]
        near = near[label[near] != label[near + distance]]
        if len(near):
            fresh = _joining(signed[near], signed[near + distance], root)
            out += fresh
            stale |= bool(fresh)
        if stale and distance % 16 == 1:
            label, stale = np.array([_root(root, x) for x in signed.tolist()], np.int64), False
        distance += 1
        at = at[at + distance < last[at]]
    return out


def _root(root: dict[int, int], x: int) -> int:
    while (up := root.get(x, x)) != x:
        x = up
    return x


def _within(rows: DataFrame) -> DataFrame:
    """Links among the fingerprints of one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, starts in _groups(batches):
            if found := block_links(columns[3].astype(np.int64).view(np.uint64), starts):
                yield _links(found)

    keys = ["part", "value", "block"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "fp").select(*_COLUMNS).mapInArrow(run, _LINKS)


def _across(rows: DataFrame) -> DataFrame:
    """Pairs of components of which one's fingerprint found one of the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}
        for columns, starts in _groups(batches):
            numbers = columns[3].astype(np.int64).view(np.uint64)
            component, size, asks = columns[4].astype(np.int64), columns[5].astype(np.int64), columns[6].astype(bool)
            length = np.diff(np.append(starts, len(numbers)))
            there = np.add.reduceat((~asks).astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
            first, many = np.repeat(starts, length), np.repeat(there, length)
            who = np.flatnonzero(asks & (many > 0))
            cut = np.searchsorted(np.cumsum(many[who]), np.arange(AT_A_TIME, many[who].sum() + AT_A_TIME, AT_A_TIME))
            out = []
            for some in np.split(who, np.unique(cut)):
                if not len(some):
                    continue
                asker = np.repeat(some, many[some])
                found = np.repeat(first[some], many[some]) + np.arange(len(asker)) - np.repeat(np.cumsum(many[some]) - many[some], many[some])
                smaller = (size[asker] < size[found]) | ((size[asker] == size[found]) & (component[asker] < component[found]))
                close = smaller & (np.bitwise_count(numbers[asker] ^ numbers[found]) <= REACH)
                out += _joining(component[asker[close]], component[found[close]], root)
            if out:
                yield _links(out)
            if len(root) > 1 << 20:
                root = {}

    keys = ["part", "value", "block"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "asks", "fp").select(*_COLUMNS).mapInArrow(run, _LINKS)


def _named(prints: DataFrame, near: DataFrame) -> DataFrame:
    """Adds the ``component`` of each fingerprint, itself if it has no links."""
    joined = prints.join(near, F.col("fp") == F.col("node"), "left")
    return joined.withColumn("component", F.coalesce("component", "fp")).drop("node")


def fingerprint_components(prints: DataFrame) -> DataFrame:
    """``fp, component`` of a stored table of distinct fingerprints ``fp``."""
    plan = planned(prints)
    alone = prints.select("fp", F.col("fp").alias("component"), F.lit(1).cast("bigint").alias("size"), F.lit(False).alias("asker"))
    near = components(stored(_within(_dealt(_indexed(alone, plan, False))), "simhash_links"))
    named = stored(_named(prints.select("fp"), near), "simhash_named")
    grown = near.groupBy("component").agg(F.count("*").alias("size"))
    # The largest component, if any, is asked by all others and asks none.
    top = grown.orderBy(F.desc("size"), F.desc("component")).limit(1).collect()
    sized = named.join(grown, "component", "left").withColumn("size", F.coalesce("size", F.lit(1).cast("bigint")))
    asker = F.col("component") != F.lit(top[0]["component"]) if top else F.lit(True)
    dealt = _dealt(stored(_indexed(sized.withColumn("asker", asker), plan, True), "simhash_index"))
    merged = components(stored(_across(dealt), "simhash_links")).select(F.col("node").alias("component"), F.col("component").alias("merged"))
    return named.join(merged, "component", "left").select("fp", F.coalesce("merged", "component").alias("component"))


def simhash_join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint, component_id`` of every document."""
    found = stored(fingerprints(docs, key, text), "simhash_prints")
    prints = stored(found.groupBy("fp").agg(F.min("key").alias("low"), F.count("*").alias("docs")), "simhash_distinct")
    of_print = fingerprint_components(prints).join(prints, "fp")
    of_print = stored(of_print.select("fp", "component", "low", "docs"), "simhash_components")
    lowest = of_print.groupBy("component").agg(F.min("low").alias("component_id"))
    placed = stored(of_print.join(lowest, "component").select("fp", "component_id", "docs"), "simhash_placed")
    # Fingerprints of very many documents meet them without a shuffle.
    hot = placed.orderBy(F.desc("docs"), "fp").limit(HOT).select("fp", "component_id", F.lit(True).alias("_hot"))
    marked = found.join(F.broadcast(hot), "fp", "left")
    rest = marked.filter("_hot IS NULL").select("fp", "key").join(placed.select("fp", "component_id"), "fp")
    every = marked.filter("_hot").select("fp", "key", "component_id").unionByName(rest)
    return every.select(F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
