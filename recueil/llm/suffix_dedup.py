"""Removal of long passages that occur more than once.

Every byte covered by a string of ``length`` bytes (400 unless said otherwise) that
starts at two places is removed; strings are judged on the input, within and across
documents.  All copies go, the first one too.

Which suffixes have to meet.  Of the 100-byte grams in a window of 400 bytes the
one with the smallest hash is its anchor.  Equal windows have equal anchors at
equal places.  Consecutive windows with one anchor form a run, about 150 of
them; a run is a row of numbers: anchor hash, digest of the bytes it spans, text
and place.  Runs whose anchor occurs once are dropped, runs with equal digests
are repeats as a whole, and only where one anchor has different surroundings the
bytes of one run per digest are fetched.

Suffix sort.  The runs of an anchor meet in one task.  Their suffixes, cut at 400
bytes, are merge-sorted: a comparison finds the common extension of two suffixes
by binary search over its length, with prefix polynomial hashes of both, and
then looks at one byte.  Neighbours with a common extension of 400 are repeats;
their bytes are compared, so a hash collision cannot remove anything.  The merge
is vectorised over all suffixes a task holds.  An anchor with very many different
surroundings (a passage that a large part of the corpus shares) is decided by
counting digests of its windows instead, which needs no group in one task.

Defined results: null text is empty; texts under ``length`` bytes lose nothing; of
texts that occur twice all copies lose everything; nothing is removed from an
empty table; input columns stay, those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as t

from recueil.llm import rolling
from recueil.llm.common import hidden, scratch, stored, whole_text

#: Bytes of a string that counts as repeated; grams that anchors are chosen from
#: have a quarter of that.
LENGTH = 400

#: Different surroundings of an anchor that are sorted in one task.
SURROUNDINGS = 1000

#: Bytes of runs that are sorted at a time; an anchor is never divided.
SORTED = 1 << 20

_RUN = "h BIGINT, c BINARY, start BIGINT, n BIGINT, rel BIGINT"


def _runs(data: np.ndarray, starts: np.ndarray, powers: rolling.Powers, length: int):
    """Runs of a chunk: row, start in the row, windows, anchor within the run,
    anchor hash, first byte in the chunk."""
    gram = max(1, length // 4)
    span = length - gram + 1
    if len(data) < length:
        return
    grams = rolling.mixed(rolling.Prefix(data, powers).windows(gram))
    at = np.arange(len(grams), dtype=np.uint64)
    keyed = (grams & np.uint64(0xFFFFFFFF00000000)) | at
    padded = np.full(-(-len(keyed) // span) * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(keyed)] = keyed
    blocks = padded.reshape(-1, span)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(data) - length + 1
    anchor = (np.minimum(onward[:windows], upto[span - 1 : span - 1 + windows]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Windows that do not cross into the next row.
    row = np.searchsorted(starts, np.arange(windows), "right") - 1
    inside = np.flatnonzero(np.arange(windows) + length <= starts[row + 1])
    if not len(inside):
        return
    anchor, row = anchor[inside], row[inside]
    fresh = np.ones(len(inside), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    n = np.diff(np.append(first, len(inside)))
    begin = inside[first]
    yield from zip(
        row[first].tolist(), (begin - starts[row[first]]).tolist(), n.tolist(), (anchor[first] - begin).tolist(),
        grams[anchor[first]].view(np.int64).tolist(), begin.tolist(), strict=True,
    )


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """The union of spans, in order."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _text_key(value):
    """128 bits of a SHA-256 as identity of a text."""
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def anchor_runs(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``key, h, c, start, n, rel`` of all runs, of each text once per task.

    Runs with equal bytes within a text, as periodic text has very many, give
    one row; where they stand is told by rows without ``h``.
    """
    value = whole_text(text)
    rows = docs.filter(F.octet_length(value) >= length).select(_text_key(value).alias("key"), value.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen = rolling.Powers(), set()
        for batch in batches:
            keys = batch.column("key").to_pylist()
            fresh = []
            for i, key in enumerate(keys):
                if key not in seen:
                    fresh.append(i)
                    if len(seen) < 1 << 20:
                        seen.add(key)
            texts = batch.column("text").take(pa.array(fresh, pa.int64()))
            for first, _, data, starts in rolling.chunks(texts):
                raw = memoryview(data.tobytes())
                out: tuple[list, ...] = ([], [], [], [], [], [])
                places: dict[tuple, list] = defaultdict(list)
                for row, start, n, rel, h, begin in _runs(data, starts, powers, length):
                    digest = hashlib.blake2b(raw[begin : begin + n + length - 1], digest_size=16).digest()
                    places[row, digest].append((h, start, n, rel))
                known: dict[int, list] = defaultdict(list)
                for (row, digest), alike in places.items():
                    h, start, n, rel = alike[0]
                    for column, x in zip(out, (keys[fresh[first + row]], h, digest, start, n, rel), strict=True):
                        column.append(x)
                    if len(alike) > 1:
                        known[row] += [(x[1], x[1] + x[2]) for x in alike]
                for row, spans in known.items():
                    for a, b in _merged(spans):
                        for column, x in zip(out, (keys[fresh[first + row]], None, None, a, b - a, None), strict=True):
                            column.append(x)
                kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["key", "h", "c", "start", "n", "rel"]
                )

    return rows.mapInArrow(run, "key BINARY, " + _RUN)


class _Suffixes:
    """Suffixes of a buffer, cut at ``length`` bytes."""

    def __init__(self, data: np.ndarray, powers: rolling.Powers, length: int = LENGTH):
        self.data, self.prefix, self.length = data, rolling.Prefix(data, powers), length
        self.whole = self.prefix.windows(length)

    def same(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self.whole[x] == self.whole[y]

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether x comes before y, by the first byte after what they share."""
        out = np.zeros(len(x), bool)
        differ = np.flatnonzero(~self.same(x, y))
        x, y = x[differ], y[differ]
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length)
        while (high - low > 1).any():
            middle = (low + high) // 2
            equal = self.prefix.ranges(x, x + middle) == self.prefix.ranges(y, y + middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle)
        out[differ] = self.data[x + low] < self.data[y + low]
        return out

    def sort(self, at: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Merge-sorts the suffixes ``at`` within groups, all groups at once.

        ``begin`` and ``size`` tell for every place the group it is in.
        """
        at, local, width = at.copy(), np.arange(len(at)) - begin, 1
        while width < size.max(initial=0):
            run = local // width
            other = run ^ 1
            has = np.flatnonzero(other * width < size)
            x, left = at[has], (run[has] % 2 == 0)
            base = begin[has] + other[has] * width
            low = np.zeros(len(has), np.int64)
            high = np.minimum(width, size[has] - other[has] * width)
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                y, mine, lefts = at[base[open_] + middle], x[open_], left[open_]
                # Of equal suffixes the left run's come first.
                before = np.empty(len(open_), bool)
                before[lefts] = self.less(y[lefts], mine[lefts])
                before[~lefts] = ~self.less(mine[~lefts], y[~lefts])
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            merged = at.copy()
            merged[begin[has] + np.minimum(run, other)[has] * width + local[has] % width + low] = x
            at, width = merged, 2 * width
        return at


def repeated_windows(
    group: np.ndarray, n: np.ndarray, rel: np.ndarray, spans: list[bytes], powers: rolling.Powers, length: int = LENGTH
) -> np.ndarray:
    """Flags of the windows of all runs that start at two places.

    Windows can only be equal if their runs are of one group and the anchor is
    at the same place in them.  The flags follow each other run by run.
    """
    data = np.frombuffer(b"".join(spans), np.uint8)
    base = np.concatenate([[0], np.cumsum([len(x) for x in spans])])[:-1]
    run = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    place, offset = base[run] + inside, rel[run] - inside
    order = np.lexsort((offset, group[run]))
    new = np.ones(len(order), bool)
    new[1:] = (group[run[order]][1:] != group[run[order]][:-1]) | (offset[order][1:] != offset[order][:-1])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(order)))
    kept = np.repeat(sizes > 1, sizes)
    order, sizes = order[kept], sizes[sizes > 1]
    flags = np.zeros(len(run), bool)
    if not len(order):
        return flags
    begin, size = np.repeat(np.cumsum(sizes) - sizes, sizes), np.repeat(sizes, sizes)
    suffixes = _Suffixes(data, powers, length)
    element = np.full(len(data), -1)
    element[place[order]] = order
    at = suffixes.sort(place[order], begin, size)
    near = np.flatnonzero((begin[1:] == begin[:-1]) & suffixes.same(at[1:], at[:-1]))
    if not len(near):
        return flags
    x, y = element[at[near]], element[at[near + 1]]
    # Compare the bytes, of stretches of neighbouring windows at once.
    line = np.lexsort((inside[x], run[y], run[x]))
    x, y, group_at = x[line], y[line], begin[near][line]
    breaks = np.ones(len(x), bool)
    breaks[1:] = (run[x][1:] != run[x][:-1]) | (run[y][1:] != run[y][:-1]) | (inside[x][1:] != inside[x][:-1] + 1)
    raw, doubtful = memoryview(data), set()
    heads = np.flatnonzero(breaks)
    for a, b in zip(heads, np.append(heads[1:], len(x)), strict=True):
        i, j, long = place[x[a]], place[y[a]], b - a + length - 1
        if raw[i : i + long] == raw[j : j + long]:
            flags[x[a:b]] = flags[y[a:b]] = True
        else:
            doubtful.update(group_at[a:b].tolist())
    for g in doubtful:  # a collision: decide these windows by their bytes
        found = defaultdict(list)
        for e in element[at[g : g + size[g]]].tolist():
            found[bytes(raw[place[e] : place[e] + length])].append(e)
        for same in found.values():
            flags[same] = len(same) > 1
    return flags


_MARK = "h BIGINT, c BINARY, spans ARRAY<STRUCT<`from`: BIGINT, upto: BIGINT>>"


def _stretches(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"from": int(a), "upto": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _sorted_marks(rows: DataFrame, length: int) -> DataFrame:
    """Repeated windows of runs that meet in a task, anchor by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = rolling.Powers()
        held: list[tuple] = []
        size = 0

        def settle() -> pa.RecordBatch:
            h, c, n, rel, spans = zip(*held, strict=True)
            n = np.array(n)
            flags = repeated_windows(np.unique(h, return_inverse=True)[1], n, np.array(rel), list(spans), powers, length)
            parts = [_stretches(x) for x in np.split(flags, np.cumsum(n)[:-1])]
            found = [i for i, x in enumerate(parts) if x]
            kind = pa.list_(pa.struct([("from", pa.int64()), ("upto", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [pa.array([h[i] for i in found], pa.int64()), pa.array([c[i] for i in found], pa.binary()), pa.array([parts[i] for i in found], kind)],
                names=["h", "c", "spans"],
            )

        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("h", "c", "n", "rel", "span")]
            for row in zip(*columns, strict=True):
                if held and held[-1][0] != row[0] and size > SORTED:
                    yield settle()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield settle()

    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(run, _MARK)


def _counted_marks(rows: DataFrame, length: int) -> DataFrame:
    """The same by counting digests of windows, for anchors with very many runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, c, n, span in zip(*[batch.column(x).to_pylist() for x in ("h", "c", "n", "span")], strict=True):
                view = memoryview(span)
                digests = [hashlib.blake2b(view[i : i + length], digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array([h] * n, pa.int64()), pa.array([c] * n, pa.binary()), pa.array(range(n), pa.int64())],
                    names=["w", "h", "c", "i"],
                )

    windows = rows.mapInArrow(run, "w BINARY, h BIGINT, c BINARY, i BIGINT")
    twice = windows.groupBy("w").agg(F.count("*").alias("_n")).filter("_n > 1").select("w")
    one = F.struct(F.col("i").alias("from"), (F.col("i") + 1).alias("upto"))
    return windows.join(twice, "w", "left_semi").groupBy("h", "c").agg(F.collect_list(one).alias("spans"))


def repeated_spans(docs: DataFrame, text: str = "text", surroundings: int = SURROUNDINGS, length: int = LENGTH) -> DataFrame:
    """``key, spans``: windows of each text that start elsewhere too."""
    every = stored(anchor_runs(docs, text, length), "runs")
    known = every.filter("h IS NULL").distinct()
    repeated = every.filter("h IS NOT NULL").groupBy("h").agg(F.count("*").alias("_n")).filter("_n > 1").select("h")
    runs = stored(every.join(repeated, "h", "left_semi").distinct(), "repeated_runs")
    first = F.min(F.struct("key", "start")).alias("first")
    alike = runs.groupBy("h", "c").agg(F.count("*").alias("times"), first, F.first("n").alias("n"), F.first("rel").alias("rel"))
    alike = stored(alike, "alike_runs")
    whole = alike.filter("times > 1").select(
        "h", "c", F.array(F.struct(F.lit(0).cast("bigint").alias("from"), F.col("n").alias("upto"))).alias("spans")
    )
    # Anchors with different surroundings: fetch the bytes, of each digest once.
    different = alike.groupBy("h").agg(F.count("*").alias("ways")).filter("ways > 1")
    wanted = alike.join(different, "h").groupBy(F.col("first.key").alias("key")).agg(
        F.collect_list(F.struct("h", "c", "n", "rel", "ways", F.col("first.start").alias("start"))).alias("runs")
    )
    value = whole_text(text)
    texts = docs.filter(F.octet_length(value) >= length).select(_text_key(value).alias("key"), F.encode(value, "UTF-8").alias("raw"))
    near = texts.join(wanted, "key").dropDuplicates(["key"]).select("raw", F.explode("runs").alias("run"))
    span = F.substring("raw", (F.col("run.start") + 1).cast("int"), (F.col("run.n") + length - 1).cast("int"))
    fetched = stored(near.select("run.h", "run.c", "run.n", "run.rel", "run.ways", span.alias("span")), "fetched_runs")
    few, many = F.col("ways") <= surroundings, F.col("ways") > surroundings
    marks = whole.unionByName(_sorted_marks(fetched.filter(few), length))
    if not fetched.filter(many).isEmpty():
        marks = marks.unionByName(_counted_marks(fetched.filter(many), length))
    marks = stored(marks, "repeat_marks")
    placed = runs.join(marks, ["h", "c"]).select("key", "start", F.explode("spans").alias("s"))
    moved = F.struct((F.col("s.from") + F.col("start")).alias("from"), (F.col("s.upto") + F.col("start")).alias("upto"))
    inside = F.struct(F.col("start").alias("from"), (F.col("start") + F.col("n")).alias("upto"))
    spans = placed.select("key", moved.alias("span")).unionByName(known.select("key", inside.alias("span")))
    return spans.groupBy("key").agg(F.collect_list("span").alias("spans"))


def without_repeats(
    docs: DataFrame, text: str = "text", surroundings: int = SURROUNDINGS, as_text: bool = False, length: int = LENGTH
) -> DataFrame:
    """All documents with ``n_bytes, n_removed, n_spans, kept_sha256`` and ``kept``,
    the remaining bytes; as text, without characters that were cut."""
    value = whole_text(text)
    with scratch(docs.sparkSession) as kept_table:
        spans = stored(repeated_spans(docs, text, surroundings, length), "repeat_spans").withColumnRenamed("key", "__key")
        copies = docs.groupBy(_text_key(value).alias("__key")).agg(F.count("*").alias("__copies")).filter("__copies > 1")
        found = kept_table(spans.join(copies, "__key", "full"), "repeat_texts").withColumnRenamed("spans", "__spans")
    joined = docs.withColumn("__text_key", _text_key(value)).join(found, F.col("__text_key") == F.col("__key"), "left")
    joined = joined.withColumn("__raw", F.encode(value, "UTF-8")).drop("__text_key", "__key")
    own = ["n_bytes", "n_removed", "n_spans"]
    columns = [c for c in docs.columns if c.lower() not in (*own, "kept_sha256", "kept")]
    schema = t.StructType([
        *docs.select(*[f"`{c}`" for c in columns]).schema.fields, *[t.StructField(x, t.LongType()) for x in own],
        t.StructField("kept_sha256", t.StringType()), t.StructField("kept", t.StringType() if as_text else t.BinaryType()),
    ])
    kind = pa.string() if as_text else pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, kept = ([], [], []), [], []
            for raw, spans, copies in zip(*[batch.column(x).to_pylist() for x in ("__raw", "__spans", "__copies")], strict=True):
                if copies and len(raw) >= length:
                    spans = [{"from": 0, "upto": len(raw) - length + 1}]
                ends = _merged([(s["from"], s["upto"] + length - 1) for s in spans or ()])
                edges = [0, *[x for pair in ends for x in pair], len(raw)]
                left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode(errors="ignore") if as_text else left)
                for column, x in zip(counts, (len(raw), len(raw) - len(left), len(ends)), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], *[pa.array(x, pa.int64()) for x in counts], pa.array(digests, pa.string()), pa.array(kept, kind)],
                names=schema.names,
            )

    return joined.select(*[f"`{c}`" for c in columns], "__raw", "__spans", "__copies").mapInArrow(run, schema)


def repeats_removed(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """The documents with the remaining text.

    Where a removal cuts a character, the rest of it goes too.  A document of
    which nothing remains is dropped.
    """
    inside, own = hidden(docs, ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    done = without_repeats(inside.withColumn("__row_text", F.col(f"`{text}`")), "__row_text", as_text=True, length=length)
    rest = done.filter((F.col("n_removed") == 0) | (F.octet_length("kept") > 0))
    now = F.when(F.col("n_removed") == 0, F.col(f"`{text}`")).otherwise(F.col("kept"))
    return rest.withColumn(text, now).select(*own)
