"""How the sources of a language differ in their words.

Index.  Every task reads its documents once and builds postings in memory: per
(language, source, term) the occurrences and the documents.  When ``BLOCK`` words are
held they are spilled as a run: a row per language and term, in that order, with the
postings of all sources; then a new block is begun.  Words of a block are told apart
by 128 bits of hashes.  Rows go to shards by a hash of language and term.  A shard
merges its runs with a heap and adds what is equal.  It holds ``MERGED`` postings at a
time; if more come, what is merged is put out and the sums are completed afterwards,
so memory is bounded whatever the vocabulary.

Kept are the terms of a language that ``LEAST`` of its documents have.  The share
of a term in a group is ``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``; two shares
differ by ``f = floor((p - q)**2 / (p + q))``.  All of it is whole numbers.

Pairs.  The value of two sources is the sum of f over all kept terms.  Most terms
occur in neither, and give the same f; that part is a product.  What is left are
corrections: terms of one source, which depend on the count alone and are added
by count, and terms of both, streamed term by term.  Sources are dealt to squares of
``SQUARE`` by ``SQUARE`` pairs and terms to slices of about ``SLICE`` postings, so a task
holds one square of sums, however many sources or terms there are, and puts out
sums, not a row per term and pair.

Defined results: null text, language and source are empty; a group without terms is
there all the same; a language without kept terms has pairs of value 0 and no
terms; rows repeated count as often; ties rank by the item's bytes; an empty table
gives an empty result; other columns of the input do not enter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from recueil.llm import rolling
from recueil.llm.common import small, stored, whole_text

#: Documents of a language that must have a term, ranks of terms, and the scale
#: of shares.
LEAST = 10
TOP = 10
SCALE_STEPS, SCALE_STEP = 3, 1000

#: Words of a block, postings of a merge, and pairs of them that are added at a time.
BLOCK = 1_000_000
MERGED = 1_000_000
AT_A_TIME = 1 << 20

#: Documents that are added to a block at a time.
ROWS = 500

SQUARE = 256
SLICE = 200_000

#: Letters are A to Z and every character beyond ASCII.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

_POSTINGS = "run BIGINT, lang STRING, term STRING, source ARRAY<STRING>, tf ARRAY<BIGINT>, df ARRAY<BIGINT>"
_FREQUENCY = "lang STRING, source STRING, term STRING, tf BIGINT, df BIGINT"


class Block:
    """Words in memory, and the postings they make."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.texts: list[np.ndarray] = []
        self.held = self.docs = self.size = 0

    def add(self, texts: pa.Array, langs: list[str], sources: list[str], powers: rolling.Powers) -> None:
        group = np.array([self.groups.setdefault(x, len(self.groups)) for x in zip(langs, sources, strict=True)], np.int64)
        for first, _, data, starts in rolling.chunks(texts):
            for part, begins in _cut(data, starts):
                begin, end, row = rolling.word_spans(_LETTER[part], begins)
                doc = row + first
                hashes = []
                for seed in (1, 2):
                    prefix = rolling.Prefix(rolling.FOLD[part], powers, seed)
                    hashes.append(rolling.mixed(prefix.ranges(begin, end) + (end - begin).astype(np.uint64)))
                self.parts.append((*hashes, group[doc], self.docs + doc, self.size + begin, end - begin))
                self.texts.append(rolling.FOLD[part])
                self.size += len(part)
                self.held += len(begin)
        self.docs += len(texts)

    def run(self, number: int) -> pa.RecordBatch:
        """The postings by language and term."""
        one, two, group, doc, begin, size = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        data = np.concatenate(self.texts)
        order = np.argsort(one)
        if ((one[order][1:] == one[order][:-1]) & (two[order][1:] != two[order][:-1])).any():
            order = np.lexsort((two, one))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        number_of = np.empty(len(order), np.int64)
        number_of[order] = np.cumsum(fresh) - 1
        first = order[fresh]
        words = _slices(data, begin[first], size[first])
        ranked = pc.sort_indices(words).to_numpy()
        rank = np.empty(len(ranked), np.int64)
        rank[ranked] = np.arange(len(ranked))

        names = list(self.groups)
        langs = sorted({lang for lang, _ in names})
        lang_of = np.array([langs.index(lang) for lang, _ in names])
        # One number per language, term, group and document; sorted, equal ones meet.
        keys = (lang_of[group] * len(rank) + rank[number_of]) * len(names) + group
        if len(langs) * len(rank) * len(names) * self.docs < 1 << 62:
            keys, doc = np.divmod(np.sort(keys * self.docs + doc), self.docs)
        else:
            order = np.lexsort((doc, keys))
            keys, doc = keys[order], doc[order]
        posting = np.ones(len(keys), bool)
        posting[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(posting)
        tf = np.diff(np.append(at, len(keys)))
        posting[1:] |= doc[1:] != doc[:-1]
        df = np.add.reduceat(posting.astype(np.int64), at)
        item, group = np.divmod(keys[at], len(names))
        head = np.ones(len(item), bool)
        head[1:] = item[1:] != item[:-1]
        heads = np.flatnonzero(head)
        ends = pa.array(np.append(heads, len(item)).astype(np.int32))
        lang, term = np.divmod(item[heads], len(rank))
        source = pa.array([x for _, x in names], pa.string()).take(pa.array(group))
        lists = [pa.ListArray.from_arrays(ends, x) for x in (source, pa.array(tf), pa.array(df))]
        named = [pa.array(langs, pa.string()).take(pa.array(lang)), words.take(pa.array(ranked[term])).cast(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(heads), number)), *named, *lists], names=["run", "lang", "term", "source", "tf", "df"])


def _cut(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A chunk as it is; one very long text in pieces between words."""
    if len(starts) > 2 or len(data) <= 2 * rolling.CHUNK:
        yield data, starts
        return
    begin = 0
    while begin < len(data):
        end = min(begin + rolling.CHUNK, len(data))
        while end < len(data) and _LETTER[data[end - 1]]:
            end += 1
        yield data[begin:end], np.array([0, end - begin])
        begin = end


def _slices(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """The bytes of some places as a binary column."""
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data[at].tobytes())])
    return whole.cast(pa.binary())


def _fresh(*columns: pa.Array) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    out = np.ones(len(columns[0]), bool)
    if len(out) > 1:
        out[1:] = np.any([pc.not_equal(x.slice(1), x.slice(0, len(x) - 1)).to_numpy(zero_copy_only=False) for x in columns], axis=0)
    return out


def runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Postings of all documents, block by block and sorted within each."""
    rows = docs.select(whole_text(text).alias("text"), whole_text("lang").alias("lang"), whole_text("source").alias("source"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, block, number = rolling.Powers(), Block(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                block.add(part.column("text"), part.column("lang").to_pylist(), part.column("source").to_pylist(), powers)
                if block.held >= BLOCK:
                    yield block.run(number)
                    block, number = Block(), number + 1
        if block.held:
            yield block.run(number)

    return rows.mapInArrow(index, _POSTINGS)


def merged_runs(found: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Sorted runs of ``lang, term`` with their postings, as one row per posting:
    ``lang, source, term, tf, df``, equal ones added."""

    def keys(run: pa.RecordBatch, start: int) -> Iterator[tuple]:
        joined = pc.binary_join_element_wise(run.column("lang"), run.column("term"), "\0")
        return zip(joined.to_pylist(), range(start, start + run.num_rows), strict=True)

    starts = np.cumsum([0, *[x.num_rows for x in found]]).tolist()
    # The heap gives the rows in order, so rows of one term are neighbours.
    order, item, last = [], [], None
    for key, row in heapq.merge(*[keys(x, a) for x, a in zip(found, starts, strict=False)]):
        if key != last:
            last = key
            item.append(len(order))
        order.append(row)
    rows = pa.Table.from_batches(found).take(pa.array(order, pa.int64())).combine_chunks()
    lists = {x: rows.column(x).combine_chunks() for x in ("source", "tf", "df")}
    number = np.repeat(np.arange(len(item)), np.diff([*item, len(order)]))
    flat = pa.table({
        "item": np.repeat(number, lists["tf"].value_lengths().to_numpy(zero_copy_only=False)), **{x: y.flatten() for x, y in lists.items()}
    })
    sums = flat.group_by(["item", "source"]).aggregate([("tf", "sum"), ("df", "sum")])
    heads = rows.take(pa.array(item, pa.int64())).take(sums.column("item"))
    columns = [heads.column("lang"), sums.column("source"), heads.column("term"), sums.column("tf_sum"), sums.column("df_sum")]
    return pa.table(columns, names=["lang", "source", "term", "tf", "df"]).combine_chunks().to_batches()[0]


def frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """``lang, source, term, tf, df`` of all terms; where a shard does not fit into
    one merge, in several rows to be added."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last, size = None, 0
        for batch in batches:
            names, at = batch.column("block").to_pylist(), 0
            for name, rows in groupby(names):
                n = len(list(rows))
                part = batch.slice(at, n).select(["lang", "term", "source", "tf", "df"])
                at, size = at + n, size + len(part.column("tf").flatten())
                if name == last:
                    held[-1] = pa.Table.from_batches([held[-1], part]).combine_chunks().to_batches()[0]
                else:
                    held.append(part)
                last = name
            if size > MERGED:
                yield merged_runs(held)
                held, last, size = [], None, 0
        if held:
            yield merged_runs(held)

    # Rows of one run stay together, and sorted, on the way to their shard.
    named = runs(docs, text).withColumn("block", F.shiftleft(F.spark_partition_id().cast("bigint"), 32) + F.col("run"))
    dealt = named.repartition("lang", "term").sortWithinPartitions("block", "lang", "term")
    return dealt.mapInArrow(merge, _FREQUENCY)


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(10**9 * (count + 2) / total)``, by long division so that no step
    leaves 64 bits; 1 where the total is 0."""
    total = np.maximum(total, 1)
    out, rest = np.zeros(np.broadcast(count, total).shape, np.int64), count + 2
    out, rest = out + rest // total, rest % total
    for _ in range(SCALE_STEPS):
        rest = rest * SCALE_STEP
        out, rest = out * SCALE_STEP + rest // total, rest % total
    return 1 + out


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Square:
    """Sums of corrections for the pairs of two lists of sources."""

    def __init__(self, left: dict[str, int], right: dict[str, int]):
        self.names = [pa.array(list(x), pa.string()) for x in (left, right)]
        self.totals = [np.array(list(x.values()), np.int64) for x in (left, right)]
        self.none = [shares(np.zeros(len(x), np.int64), x) for x in self.totals]
        self.neither = differences(self.none[0][:, None], self.none[1][None, :])
        self.sums = np.zeros(self.neither.shape, np.int64)

    def add(self, term: np.ndarray, source: pa.Array, count: np.ndarray) -> None:
        """The postings of whole terms, in order of the terms (numbers)."""
        sides = []
        for names, total in zip(self.names, self.totals, strict=True):
            at = pc.fill_null(pc.index_in(source, value_set=names), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            mine = np.flatnonzero(at >= 0)
            sides.append((term[mine], at[mine], count[mine], shares(count[mine], total[at[mine]])))
        (left_term, i, n, p), (right_term, j, m, q) = sides
        self._one_sided(self.sums, self.neither, i, n, p, self.none[1])
        self._one_sided(self.sums.T, self.neither.T, j, m, q, self.none[0])
        low, high = (np.searchsorted(right_term, left_term, side) for side in ("left", "right"))
        many = high - low
        cuts = np.unique(np.searchsorted(np.cumsum(many), np.arange(AT_A_TIME, many.sum() + AT_A_TIME, AT_A_TIME)))
        for some in np.split(np.arange(len(many)), cuts):
            a = np.repeat(some, many[some])
            b = np.repeat(low[some], many[some]) + np.arange(len(a)) - np.repeat(np.cumsum(many[some]) - many[some], many[some])
            x, y = i[a], j[b]
            p0, q0 = self.none[0][x], self.none[1][y]
            both = differences(p[a], q[b]) - differences(p[a], q0) - differences(p0, q[b]) + self.neither[x, y]
            np.add.at(self.sums, (x, y), both)

    def _one_sided(self, sums: np.ndarray, neither: np.ndarray, at: np.ndarray, count: np.ndarray, share: np.ndarray, other: np.ndarray) -> None:
        """Terms of one source as if the others had none: it depends on the count."""
        if not len(at):
            return
        (row, _), first, times = (x for x in np.unique(np.stack([at, count]), axis=1, return_index=True, return_counts=True))
        more = differences(share[first][:, None], other[None, :]) - neither[row]
        np.add.at(sums, row, times[:, None] * more)


def _corrections(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: sums over the terms of either source.

    ``kept`` has ``lang, source, term, tf``; ``groups`` has ``lang, source, total,
    postings, sources`` with the totals and the numbers of the language.
    """
    blocks, slices = F.ceil(F.col("sources") / SQUARE).cast("int"), F.ceil((F.col("postings") + 1) / SLICE).cast("int")
    langs = groups.select("lang", blocks.alias("blocks"), slices.alias("slices")).distinct()

    def squares(rows: DataFrame) -> DataFrame:
        mine = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
        other = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return other.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})

    names = ["lang", "low", "high", "slice", "term", "mine", "source", "n"]
    dealt = kept.join(small(langs), "lang").withColumn("slice", F.pmod(F.xxhash64("term"), F.col("slices")).cast("int"))
    postings = squares(dealt).select(*names[:-1], F.col("tf").alias("n"))
    every = groups.join(small(langs), "lang").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    headers = squares(every.withColumn("term", F.lit(None).cast("string"))).select(*names[:-1], F.col("total").alias("n"))

    def put(place: tuple, square: Square) -> pa.RecordBatch:
        i, j = (x.ravel() for x in np.indices(square.sums.shape))
        if place[1] == place[2]:
            i, j = i[i != j], j[i != j]
        ends, flat = [names.take(pa.array(x)) for names, x in zip(square.names, (i, j), strict=True)], square.sums[i, j]
        if place[1] != place[2]:
            ends, flat = [pa.concat_arrays([ends[0], ends[1]]), pa.concat_arrays([ends[1], ends[0]])], np.concatenate([flat, flat])
        lang = pa.array([place[0]] * len(flat), pa.string())
        return pa.RecordBatch.from_arrays([lang, *ends, pa.array(flat, pa.int64())], names=["lang", "source", "item", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, square, rest = None, None, None
        sides: tuple[dict, dict] = ({}, {})

        def added(rows: pa.RecordBatch, whole: bool) -> pa.RecordBatch | None:
            """Adds all terms, or all but the last, which may go on."""
            if not rows.num_rows:
                return None
            fresh = _fresh(rows.column("term"))
            end = rows.num_rows if whole else int(np.flatnonzero(fresh)[-1])
            if end:
                done = rows.slice(0, end)
                square.add(np.cumsum(fresh[:end]), done.column("source"), done.column("n").to_numpy(zero_copy_only=False))
            return None if whole else rows.slice(end)

        def settled_square() -> pa.RecordBatch:
            if rest is not None:
                added(rest, True)
            return put(place, square or Square(*sides))

        for batch in batches:
            at = 0
            for key, rows in groupby(zip(*[batch.column(c).to_pylist() for c in names[:4]], strict=True)):
                n = len(list(rows))
                part, at = batch.slice(at, n), at + n
                if key != place:
                    if place:
                        yield settled_square()
                    place, square, rest, sides = key, None, None, ({}, {})
                # The sources of a square come before its terms.
                listed = part.column("term").null_count
                for row in part.slice(0, listed).select(["mine", "source", "n"]).to_pylist():
                    for side, block in enumerate(key[1:3]):
                        if row["mine"] == block:
                            sides[side][row["source"]] = row["n"]
                part = part.slice(listed)
                if part.num_rows:
                    square = square or Square(*sides)
                    if rest is not None:
                        part = pa.Table.from_batches([rest, part]).combine_chunks().to_batches()[0]
                    rest = added(part, False)
        if place:
            yield settled_square()

    keys = names[:4]
    rows = postings.unionByName(headers)
    sums = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("term").asc_nulls_first(), "source").select(*names)
    parts = sums.mapInArrow(run, "lang STRING, source STRING, item STRING, value BIGINT")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _share(count, total):
    """The share of a count as a column."""
    scale = SCALE_STEP**SCALE_STEPS
    wide = ((count.cast("decimal(38,0)") + 2) * scale).cast("decimal(38,0)")
    # Most counts times the scale are 64-bit numbers.
    narrow = F.call_function("div", (count.cast("bigint") + 2) * scale, total.cast("bigint"))
    return F.when(count < (1 << 63) // scale - 2, narrow).otherwise(F.call_function("div", wide, total.cast("decimal(38,0)"))) + 1


def _difference(p, q):
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(docs: DataFrame, text: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``."""
    named = docs.select(whole_text(text).alias("text"), whole_text("lang").alias("lang"), whole_text("source").alias("source"))
    found = stored(frequencies(named), "divergence_terms")
    terms = found.groupBy("lang", "term").agg(F.sum("tf").alias("all_tf"), F.sum("df").alias("df")).filter(F.col("df") >= LEAST)
    terms = stored(terms.drop("df"), "divergence_kept_terms")
    joined = found.drop("df").join(small(terms), ["lang", "term"])
    kept = stored(joined.groupBy("lang", "term", "all_tf", "source").agg(F.sum("tf").alias("tf")), "divergence_kept")

    # One row per language and per group; everything below joins on these.
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_tf").alias("lang_n"))
    sums = kept.groupBy("lang", "source").agg(F.sum("tf").alias("n"), F.count("*").alias("m"))
    every = named.groupBy("lang", "source").agg(F.count("*").alias("docs")).join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = F.lit(0).cast("bigint")
    groups = every.select(
        "lang", "source", F.coalesce("v", zero).alias("v"), (F.coalesce("n", zero) + 2 * F.coalesce("v", zero)).alias("total"),
        (F.coalesce("lang_n", zero) + 2 * F.coalesce("v", zero)).alias("lang_total"),
        F.sum(F.coalesce("m", zero)).over(Window.partitionBy("lang")).alias("postings"), F.count("*").over(Window.partitionBy("lang")).alias("sources"),
    )
    groups = stored(groups, "divergence_groups")

    # Sources against each other: what no term changes, and the corrections.
    none = _share(F.lit(0), F.greatest("total", F.lit(1)))
    side = groups.select("lang", "source", "v", none.alias("none"))
    pairs = _corrections(kept, groups)
    pairs = pairs.join(small(side), ["lang", "source"]).join(small(side.select("lang", F.col("source").alias("item"), F.col("none").alias("other"))), ["lang", "item"])
    whole = (F.col("value") + F.col("v") * _difference(F.col("none"), F.col("other"))).alias("value")
    by_pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", whole)

    # Terms against their language.
    joined = kept.join(small(groups.select("lang", "source", "total", "lang_total")), ["lang", "source"])
    p, q = _share(F.col("tf"), F.col("total")), _share(F.col("all_tf"), F.col("lang_total"))
    by_term = joined.withColumns({"p": p, "q": q}).filter("tf > 0 AND p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _difference(F.col("p"), F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    best = by_term.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return by_pair.withColumn("rank", F.row_number().over(order)).unionByName(best)
