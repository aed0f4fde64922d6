"""Exact Jaccard self-join on word shingles, and its components.

Two documents link if their shingle sets overlap by 80 % or more.  Equal sets are
one class from the start.

Candidates.  If two sets link, they share at least k elements among the first
``n - ceil(0.8 n) + k`` of each, in any order common to all; k is 5 % of n.  The
order is by hash, with shingles of many documents last: a broadcast list of at
most ``FREQUENT`` of them.  Only elements that two classes have in their prefixes
matter, and only classes with enough of them; a tile is the classes that meet in
one element.

Links.  First every class goes to the tile of its smallest such element, and the
tile finds its links: rows are ordered by set size, so only a band of sizes is
compared; bitmaps of the hashed elements bound the overlap from above by their
bit counts; what is left is decided by intersecting the sorted arrays.  Rows
already connected are not compared again, so thousands of near copies cost about
one comparison each.  Large tiles are salted.  A second round does the same in the
tiles of other elements, with some classes for each component found so far.  Then classes
go that have too few tiles in which different components remain, and each of these
tiles is compared across them, by size band and bit counts; the distinct pairs left
are intersected.  No link between different components can be missing after that.

Defined results: a text without words has the empty set, no links and its own id
as component; null ids are never the smallest id unless all are null; repeated
rows are one class; an empty table gives an empty result; other columns of the
input do not enter.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as t

from recueil.llm import rolling
from recueil.llm.common import WORD, scratch, small, stored, whole_text
from recueil.llm.components import components

WORDS = 5
#: Two sets link if 100 * intersection >= PERCENT * union.
PERCENT = 80

#: Per cent of a set's size that linked sets must share in their prefixes.
PREFIX_SHARE = 5

#: Shingles known to be in many documents, at most; they come last in the order.
FREQUENT = 1 << 18
#: Documents that a shingle must be in to be counted, among those a task holds at
#: a time (so many elements), and documents in all from which it is frequent.
LOCAL, MANY = 2, 32
COUNTED = 1_000_000

#: Classes of a tile that are compared in one task, and classes of one component
#: that stand for it in a tile.
TILE = 1000
HEADS = 32
#: Smallest tokens of a class by which most of its pairs count in one tile only.
FIRST = 8

#: How often classes that share too little are left out, before links are sought
#: and among those that are still in different components.
PASSES = 1

#: Text digests (8 bytes each) that are broadcast at most.
DIGESTS = 500_000


def shared_at_least(n):
    """Elements that two linked sets, the smaller of this size, share in their
    prefixes; a number or a column."""
    return (n * PREFIX_SHARE + 99) // 100 if isinstance(n, int) else F.ceil(n * PREFIX_SHARE / 100)


def _prefix_length(n: int) -> int:
    return n - (n * PERCENT + 99) // 100 + shared_at_least(n)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted arrays of distinct elements link."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def needed(n: np.ndarray | int, m: np.ndarray | int):
    """The smallest overlap of two linked sets of these sizes."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def bitmap(elements: np.ndarray) -> np.ndarray:
    """Hashed elements as bits, between two and four times as many as elements."""
    bits = 1 << max(8, min(16, int(2 * len(elements) - 1).bit_length()))
    at = np.unique((elements & np.uint64(bits - 1)).astype(np.int64))
    flags = np.zeros(bits, np.uint8)
    flags[at] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """A bitmap shortened to ``size`` words."""
    return np.bitwise_or.reduce(words.reshape(-1, size), axis=0)


def overlap_bound(n: int, a: np.ndarray, m: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The overlap of a set with several others is at most this.

    ``a`` is one bitmap, ``b`` a matrix of bitmaps of the same length.
    """
    own = n - np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64)
    other = m - np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64)
    return np.minimum(own, other)


def _sets(texts: pa.Array, powers: rolling.Powers) -> Iterator[np.ndarray]:
    for _, _, data, starts in rolling.chunks(texts):
        yield from rolling.shingle_sets(data, starts, powers, WORDS)


def _class_id(elements: np.ndarray) -> bytes | None:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else None


def _half(class_id: bytes) -> int:
    return int.from_bytes(class_id[:8], "little", signed=True)


def _signed(elements: np.ndarray) -> np.ndarray:
    return elements.view(np.int64)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, class`` of every document, and (with ``token``)
    shingles that are in several documents of one task, with their number."""
    value = whole_text(text)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(value).alias("digest"), value.alias("text"))
    schema = t.StructType([
        t.StructField("key", rows.schema["key"].dataType), t.StructField("class", t.BinaryType()),
        *[t.StructField(x, t.LongType()) for x in ("digest", "n_shingles", "half", "token", "docs")],
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, several, pending, held = rolling.Powers(), Counter(), [], 0

        def count() -> None:
            if pending:
                values, counts = np.unique(np.concatenate(pending), return_counts=True)
                again = counts >= LOCAL
                several.update(dict(zip(values[again].tolist(), counts[again].tolist(), strict=True)))

        def table(n: int, **columns: pa.Array) -> pa.RecordBatch:
            arrays = [columns.get(x, pa.nulls(n, types.get(x, pa.int64()))) for x in schema.names]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        types = {"class": pa.binary()}
        for batch in batches:
            types["key"] = batch.column("key").type
            sizes, ids = [], []
            for elements in _sets(batch.column("text"), powers):
                sizes.append(len(elements))
                ids.append(_class_id(elements))
                pending.append(elements)
                held += len(elements)
                if held > COUNTED:
                    count()
                    pending, held = [], 0
            yield table(
                len(ids), key=batch.column("key"), digest=batch.column("digest"), n_shingles=pa.array(sizes, pa.int64()),
                half=pa.array([x and _half(x) for x in ids], pa.int64()), **{"class": pa.array(ids, pa.binary())},
            )
        count()
        if several:
            n = len(several)
            tokens = _signed(np.fromiter(several.keys(), np.uint64, n))
            yield table(n, token=pa.array(tokens), docs=pa.array(list(several.values()), pa.int64()))

    return rows.mapInArrow(run, schema)


def _frequent(found: DataFrame) -> np.ndarray:
    """The most frequent shingles, sorted; any choice gives right results."""
    counted = found.filter("token IS NOT NULL").groupBy("token").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= MANY)
    top = counted.orderBy(F.desc("docs"), "token").limit(FREQUENT).select("token").toArrow()
    return np.sort(top.column("token").to_numpy().astype(np.int64).view(np.uint64))


def _prefixes(docs: DataFrame, text: str, frequent) -> DataFrame:
    """``token, half``: the prefix of every class, once per task that has it."""
    rows = docs.select(whole_text(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen, late = rolling.Powers(), set(), frequent.value
        for batch in batches:
            tokens, halves = [], []
            for elements in _sets(batch.column("text"), powers):
                if not len(elements):
                    continue
                half = _half(_class_id(elements))
                if half in seen:
                    continue
                if len(seen) < 1 << 20:
                    seen.add(half)
                if len(late):
                    at = np.searchsorted(late, elements)
                    at[at == len(late)] = 0
                    common = late[at] == elements
                    elements = np.concatenate([elements[~common], elements[common]])
                head = elements[: _prefix_length(len(elements))]
                tokens.append(head)
                halves.append(np.full(len(head), half, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(np.concatenate(tokens))), pa.array(np.concatenate(halves))], names=["token", "half"]
                )

    return rows.mapInArrow(run, "token BIGINT, half BIGINT")


def _shared(prefixes: DataFrame) -> DataFrame:
    """The rows whose token is in the prefixes of several classes."""
    tile = Window.partitionBy("token")
    several = F.min("half").over(tile) != F.max("half").over(tile)
    return prefixes.withColumn("_several", several).filter("_several").drop("_several").distinct()


def _likely(shared: DataFrame, sizes: DataFrame) -> DataFrame:
    """The rows of classes that share enough elements for any link."""
    counted = shared.groupBy("half").agg(F.count("*").alias("_shared")).join(sizes, "half")
    enough = counted.filter(F.col("_shared") >= shared_at_least(F.ceil(F.col("n") * PERCENT / 100)))
    return shared.join(small(stored(enough.select("half").distinct(), "jaccard_enough")), "half", "left_semi")


def _members(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """``class, half, n, elements, bits`` of the classes with the wanted texts."""
    value = whole_text(text)
    texts = docs.select(F.xxhash64(value).alias("digest"), value.alias("text"))
    once = texts.join(wanted, "digest", "left_semi").dropDuplicates(["digest"]).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = rolling.Powers()
        for batch in batches:
            found = [x for x in _sets(batch.column("text"), powers) if len(x)]
            ids = [_class_id(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.binary()), pa.array([_half(x) for x in ids], pa.int64()),
                    pa.array([len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary()),
                    pa.array([bitmap(x).tobytes() for x in found], pa.binary()),
                ],
                names=["class", "half", "n", "elements", "bits"],
            )

    return once.mapInArrow(run, "class BINARY, half BIGINT, n BIGINT, elements BINARY, bits BINARY")


_EDGES = "a BINARY, b BINARY"


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], names=["a", "b"])


def tile_links(ids: list[bytes], sets: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
    """Links that connect the sets of a tile as all its links would.

    Sets come in order of their size.  Each is compared with the earlier ones
    of its size band that are not yet connected with it.
    """
    sizes = np.array([len(x) for x in sets])
    bits = 1 << max(8, min(16, int(2 * sizes[-1] - 1).bit_length()))
    flags = np.zeros((len(sets), bits // 8), np.uint8)
    for i, x in enumerate(sets):
        at = (x & np.uint64(bits - 1)).astype(np.int64)
        np.bitwise_or.at(flags[i], at >> 3, (1 << (at & 7)).astype(np.uint8))
    maps = flags.view(np.uint64)
    label, links = np.arange(len(sets)), []
    for i in range(1, len(sets)):
        low = np.searchsorted(sizes[:i], -(-PERCENT * sizes[i] // 100))
        if low == i:
            continue
        slack = overlap_bound(sizes[i], maps[i], sizes[low:i], maps[low:i]) - needed(sizes[i], sizes[low:i])
        order = low + np.argsort(-slack, kind="stable")
        order = order[: int((slack >= 0).sum())]
        while len(order):
            j, order = order[0], order[1:]
            if linked(sets[i], sets[j]):
                links.append((ids[i], ids[j]))
                label[label == label[i]] = label[j]
                order = order[label[order] != label[i]]
    return links


def _linked_tiles(rows: DataFrame) -> DataFrame:
    """Links within tiles; ``rows`` has ``tile, salt, class, n, elements``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, ids, sets = None, [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("tile", "salt", "class")] + [rolling.number_views(batch.column("elements"))]
            out = []
            for token, salt, name, elements in zip(*columns, strict=True):
                if (token, salt) != tile:
                    out += tile_links(ids, sets) if len(ids) > 1 else []
                    tile, ids, sets = (token, salt), [], []
                ids.append(name)
                sets.append(elements)
            if out:
                yield _edges(out)
        if len(ids) > 1 and (out := tile_links(ids, sets)):
            yield _edges(out)

    dealt = rows.repartition("tile", "salt").sortWithinPartitions("tile", "salt", "n", "class")
    return dealt.select("tile", "salt", "class", "elements").mapInArrow(run, _EDGES)


def _met(homes: DataFrame) -> DataFrame:
    """``tile, salt, class`` of those in tiles with different components.

    ``homes`` has ``tile, class, component``.  A component is present with
    ``HEADS`` of its classes at most; what it links with and they do not is
    found at the end.  Large tiles are salted.
    """
    one = Window.partitionBy("tile", "component").orderBy(F.xxhash64("class"))
    heads = homes.withColumn("_at", F.row_number().over(one)).filter(F.col("_at") <= HEADS).drop("_at")
    mixed = heads.groupBy("tile").agg(
        F.count("*").alias("_size"), F.min("component").alias("_low"), F.max("component").alias("_high")
    ).filter(F.col("_low") != F.col("_high"))
    salts = F.ceil(F.col("_size") / TILE).cast("int")
    return heads.join(mixed, "tile").select("tile", F.pmod(F.xxhash64("class"), salts).cast("int").alias("salt"), "class")


def _undecided(rows: DataFrame) -> DataFrame:
    """The rows of tiles in which different components meet, of the classes that
    have enough such tiles to link with a class of another component.

    All elements that two such classes share are in such tiles, so no link is
    lost.  ``rows`` has ``token, class, n, component``.
    """
    tiles = rows.groupBy("token").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    met = stored(rows.join(tiles.filter("_low <> _high").select("token"), "token", "left_semi"), "jaccard_met")
    least = shared_at_least(F.ceil(F.col("n") * PERCENT / 100))
    enough = met.groupBy("class", "n").agg(F.count("*").alias("_shared")).filter(F.col("_shared") >= least)
    return stored(met.join(small(stored(enough.select("class"), "jaccard_enough")), "class", "left_semi"), "jaccard_undecided")


def _blocks(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of tiles in which different components meet, dealt to tasks.

    A row carries its set size, bitmap and the ``FIRST`` smallest of its tokens in
    such tiles.  A tile of more than ``TILE`` rows is cut into blocks; each pair of
    blocks meets in a task.  ``rows`` has ``token, class, n, component``.
    """
    # Tiles with the same classes are one.
    names = [F.bit_xor(F.xxhash64("class", F.lit(i))).alias(f"_name{i}") for i in range(2)]
    tiles = rows.groupBy("token").agg(
        F.count("*").alias("_size"), F.min("component").alias("_low"), F.max("component").alias("_high"), *names
    ).filter(F.col("_low") != F.col("_high"))
    mixed = tiles.groupBy("_size", "_low", "_high", "_name0", "_name1").agg(F.min("token").alias("token"))
    open_ = stored(rows.join(mixed, "token").select("token", "class", "n", "component", "_size"), "jaccard_open")
    first = F.slice(F.sort_array(F.collect_list("token")), 1, FIRST).alias("first")
    tokens = open_.groupBy("class").agg(first)
    many = F.ceil(F.col("_size") / TILE).cast("int")
    mine = F.pmod(F.xxhash64("class"), many).cast("int")
    full = open_.withColumn("block", mine).withColumn("other", F.explode(F.sequence(F.lit(0), many - 1)))
    full = full.join(tokens, "class").join(members.select("class", "bits"), "class")
    return full.withColumns({"left": F.least("block", "other"), "right": F.greatest("block", "other")}).drop("_size", "other")


def tile_pairs(token: int, rows: list[tuple], across: bool) -> Iterator[tuple[bytes, bytes]]:
    """Pairs of a tile that may link: of different components and a common size
    band, with enough overlap by the bit counts.

    ``rows``, by size: class, n, component, block, first tokens, bits.  A pair that
    has a smaller one of these in common counts there.  ``across`` leaves out pairs
    within a block.
    """
    size = np.array([r[1] for r in rows])
    _, component = np.unique([r[2] for r in rows], return_inverse=True)
    block = np.array([r[3] for r in rows])
    maps = [np.frombuffer(r[5], np.uint64) for r in rows]
    before = [{x for x in r[4] if x < token} for r in rows]
    width = np.array([len(x) for x in maps])
    place = np.zeros(len(rows), np.int64)
    matrix = {}
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        place[at] = np.arange(len(at))
        matrix[w] = np.stack([maps[i] for i in at])
    for i in range(1, len(rows)):
        low = np.searchsorted(size[:i], -(-PERCENT * size[i] // 100))
        near = low + np.flatnonzero((component[low:i] != component[i]) & (~across | (block[low:i] != block[i])))
        for w in np.unique(width[near]).tolist():
            at = near[width[near] == w]
            bound = overlap_bound(size[i], folded(maps[i], w), size[at], matrix[w][place[at]])
            for j in at[bound >= needed(size[i], size[at])].tolist():
                if before[i].isdisjoint(before[j]):
                    yield max(rows[i][0], rows[j][0]), min(rows[i][0], rows[j][0])


def _pairs(dealt: DataFrame) -> DataFrame:
    """The pairs of all tiles, each once."""
    names = ["class", "n", "component", "block", "first", "bits"]
    where = ["token", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows = None, []

        def settle() -> list[tuple[bytes, bytes]]:
            return list(tile_pairs(tile[0], rows, tile[1] != tile[2])) if len(rows) > 1 else []

        for batch in batches:
            out = []
            at = zip(*[batch.column(c).to_pylist() for c in where], strict=True)
            columns = [batch.column(c).to_pylist() for c in names]
            for here, row in zip(at, zip(*columns, strict=True), strict=True):
                if here != tile:
                    out += settle()
                    tile, rows = here, []
                rows.append(row)
            if out:
                yield _edges(out)
        if out := settle():
            yield _edges(out)

    sorted_rows = dealt.repartition(*where).sortWithinPartitions(*where, "n", "class")
    # Two classes may still meet in several tiles.
    return sorted_rows.select(*where, *names).mapInArrow(run, _EDGES).distinct()


def _verified(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs that link, by intersecting the sorted arrays."""
    sides = [members.select(F.col("class").alias(x), F.col("elements").alias(f"of_{x}")) for x in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(*[rolling.number_views(batch.column(c)) for c in ("of_a", "of_b")], strict=True)
            keep = [linked(a, b) for a, b in both]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(run, _EDGES)


def _named(rows: DataFrame, near: DataFrame | None) -> DataFrame:
    """Adds the ``component`` of each class, itself if it has no links yet."""
    if near is None:
        return rows.withColumn("component", F.col("class"))
    joined = rows.join(near, F.col("class") == F.col("node"), "left").drop("node")
    return joined.withColumn("component", F.coalesce("component", "class"))


def _joined(near: DataFrame | None, links: DataFrame) -> DataFrame:
    """``node, component`` after more links: they join the components found so far,
    whose classes do not take part again."""
    links = stored(links, "jaccard_links")
    if near is None:
        return components(links)
    if links.isEmpty():
        return near
    known = small(near)
    ends = [known.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}")) for x in "ab"]
    named = links.join(ends[0], "a", "left").join(ends[1], "b", "left")
    merged = small(components(named.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))))
    into = merged.select(F.col("node").alias("component"), F.col("component").alias("merged"))
    grown = near.join(into, "component", "left").select("node", F.coalesce("merged", "component").alias("component"))
    return stored(grown.unionByName(merged.join(known.select("node"), "node", "left_anti")), "jaccard_near")


def class_components(docs: DataFrame, listed: DataFrame, text: str = "text") -> DataFrame:
    """``node, component`` of classes that link with others."""
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(listed))
    one = listed.filter("class IS NOT NULL").groupBy("class").agg(
        F.min("digest").alias("digest"), F.first("half").alias("half"), F.first("n_shingles").alias("n")
    )
    sizes = stored(one.select("half", "digest", "n"), "jaccard_sizes")
    shared = stored(_shared(_prefixes(docs, text, frequent)), "jaccard_tiles")
    for _ in range(PASSES):
        # Without the classes that go, others share less.
        shared = stored(_shared(_likely(shared, sizes)), "jaccard_tiles")
    wanted = stored(sizes.join(shared.select("half").distinct(), "half", "left_semi").select("digest").distinct(), "jaccard_wanted")
    members = stored(_members(docs, text, small(wanted, DIGESTS)), "jaccard_members")
    keyed = members.select("half", "class", "n")

    # In each round a class goes to the tile of one of its elements.
    near = None
    token = F.col("token")
    for chosen in (F.min(token), F.max(token)):
        home = shared.groupBy("half").agg(chosen.alias("tile")).join(keyed, "half").select("tile", "class")
        dealt = stored(_met(_named(home, near)), "jaccard_homes")
        if not dealt.isEmpty():
            near = _joined(near, _linked_tiles(small(dealt).join(members.select("class", "n", "elements"), "class")))

    # What is left: tiles in which different components meet.
    named = _named(stored(keyed, "jaccard_keyed"), near)
    rows = shared.join(small(stored(named, "jaccard_keyed")), "half").select("token", "class", "n", "component")
    for _ in range(PASSES):
        # Without the classes that go, fewer tiles are open.
        rows = _undecided(rows)
    possible = stored(_pairs(_blocks(rows, members)), "jaccard_pairs")
    return _joined(near, _verified(possible, members))


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, class, component_id`` of every document."""
    with scratch(docs.sparkSession) as kept:
        listed = stored(classes(docs, key, text), "jaccard_classes")
        of_class = class_components(docs, listed, text)
        rows = listed.filter("token IS NULL").select("key", "n_shingles", "class")
        named = rows.join(of_class, F.col("class") == F.col("node"), "left").withColumn("component", F.coalesce("component", "class"))
        named = kept(named.select("key", "n_shingles", "class", "component"), "jaccard_named")
    lowest = named.filter("component IS NOT NULL").groupBy("component").agg(F.min("key").alias("component_id"))
    joined = named.join(lowest, "component", "left")
    own = F.when(F.col("component").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select(F.col("key").alias(key), "n_shingles", "class", own.alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, one of each component: one with the smallest key.

    Documents without words all stay.
    """
    with scratch(docs.sparkSession) as kept:
        listed = stored(classes(docs, key, text), "jaccard_classes")
        of_class = class_components(docs, listed, text)
        rows = listed.filter("token IS NULL AND class IS NOT NULL").select("key", "digest", "class")
        named = rows.join(of_class, F.col("class") == F.col("node"), "left").withColumn("component", F.coalesce("component", "class"))
        first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "digest")).alias("first")
        chosen = kept(named.groupBy("component").agg(first).select(
            F.col("first.key").alias("__key"), F.col("first.digest").alias("__digest"), F.lit(True).alias("__first")
        ), "jaccard_chosen")
    value = whole_text(text)
    marked = docs.withColumn("__text_digest", F.xxhash64(value))
    same = F.col(f"`{key}`").eqNullSafe(F.col("__key")) & (F.col("__text_digest") == F.col("__digest"))
    joined = marked.join(chosen, same, "left")
    wordless = ~value.rlike(WORD)
    # Of rows equal in key and text one stays; those without words all do.
    place = Window.partitionBy(f"`{key}`", "__text_digest").orderBy(F.lit(0))
    first_row = joined.filter(F.col("__first") & ~wordless).withColumn("__row", F.row_number().over(place)).filter(F.col("__row") == 1)
    return first_row.select(*docs.columns).unionByName(marked.filter(wordless).select(*docs.columns))
