"""Elements of JSON array files of any size, found block by block.

Spark cuts a file into blocks; a record of the text source is what lies between two
commas.  An element of the array ends at a comma outside strings and brackets, which
nobody can tell from a block alone: it may begin within a string, or deep inside an
element.  So files of several blocks are read more than once.

First every block is summed up: how it changes the depth of brackets if it begins
outside of a string and if it begins inside of one, and whether its quotes switch
between the two.  These are composed in file order, by windows over one short row per
block, and tell each block the state it begins in.

Then blocks are cut at the commas where the depth is one.  What lies between two of
them is an element.  The ends of a block are pieces of elements that go over its
borders; they alone are shuffled, and put together by file and number.

Files too small to be cut begin in a known state and are read once; the others once
for the sums, once for whole elements and once for the pieces at the ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Blocks (one short row each) whose states are broadcast at most; with more of
#: them the fragments are shuffled to the states and sorted again.
BROADCAST_BLOCKS = 1_000_000

_ELEMENT = "payload STRING, seq STRUCT<file: STRUCT<place: STRING, path: STRING>, block: BIGINT, at: BIGINT>"


def file_order(path: Column) -> Column:
    """A file as a sortable struct: by name, numbers in it by value.

    So page 10 comes after page 2, padded or not, and also after a copy of the
    folder, which changes file times.
    """
    # Zeros are counted up from none: a number has few digits, so few tries do.  All
    # zeros first and then back took most of the time of reading lines.
    padded = F.regexp_replace(F.regexp_replace(path, r"(\d+)", "0000000000000000000$1"), r"0*?(\d{20})(?!\d)", "$1")
    return F.struct(padded.alias("place"), path.alias("path"))


class _Scan:
    """What the bytes of some fragments, a comma after each, do to the state."""

    def __init__(self, fragments: list[bytes]):
        data = np.frombuffer(b",".join([*fragments, b""]), np.uint8)
        self.commas = np.cumsum([len(x) + 1 for x in fragments]) - 1
        at, slash = np.arange(len(data)), data == ord("\\")
        # A quote is escaped by an odd number of backslashes right before it.
        behind = at - np.maximum.accumulate(np.where(slash, -1, at))
        escaped = np.zeros(len(data), bool)
        escaped[1:] = behind[:-1] % 2 == 1
        self.quotes = np.cumsum((data == ord('"')) & ~escaped) % 2 == 1
        opens, closes = (data == ord("[")) | (data == ord("{")), (data == ord("]")) | (data == ord("}"))
        self.steps = opens.astype(np.int8) - closes.astype(np.int8)

    def from_state(self, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether each comma lies in a string, and the depth there."""
        within = self.quotes ^ inside
        depths = depth + np.cumsum(np.where(within, 0, self.steps), dtype=np.int64)
        return within[self.commas], depths[self.commas]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch, list[bytes]]]:
    """Neighbouring fragments of one block."""
    for batch in batches:
        paths, blocks = (batch.column(c).to_pylist() for c in ("path", "block"))
        start = 0
        for i in range(1, len(blocks) + 1):
            if i == len(blocks) or blocks[i] != blocks[start] or paths[i] != paths[start]:
                part = batch.slice(start, i - start)
                yield (paths[start], blocks[start]), part, part.column("value").cast(pa.binary()).to_pylist()
                start = i


def _table(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    arrays = [pa.array(list(x), kind) for x, kind in zip(columns, schema.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(schema))


def _is_array(first: bytes) -> bool:
    return first.lstrip().startswith(b"[")


_SUMMARY = {
    "path": pa.string(), "block": pa.int64(), "at": pa.int64(), "flips": pa.int32(), "outside": pa.int64(), "inside": pa.int64(), "list": pa.bool_()
}


def block_summaries(fragments: DataFrame) -> DataFrame:
    """``path, block, flips, outside, inside, list`` of blocks: whether their
    quotes switch, the change of depth from either state, whether an array begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for at, (key, _, values) in enumerate(_runs(batches)):
            scan = _Scan(values)
            depths = [int(scan.from_state(x, 0)[1][-1]) for x in (False, True)]
            begins = key != last and key[1] == 0 and _is_array(values[0])
            yield _table(_SUMMARY, [(*key, at, int(scan.quotes[-1]), *depths, begins)])
            last = key

    schema = "path STRING, block BIGINT, at BIGINT, flips INT, outside BIGINT, inside BIGINT, list BOOLEAN"
    parts = _switched(fragments.select("path", "block", "value").mapInArrow(run, schema), "path", "block", "at")
    same = F.col("switched") == 0
    return parts.groupBy("path", "block").agg(
        (F.sum("flips") % 2).alias("flips"), F.sum(F.when(same, F.col("outside")).otherwise(F.col("inside"))).alias("outside"),
        F.sum(F.when(same, F.col("inside")).otherwise(F.col("outside"))).alias("inside"), F.bool_or("list").alias("list"),
    )


def _before(*columns: str):
    return Window.partitionBy(*columns[:-1]).orderBy(columns[-1]).rowsBetween(Window.unboundedPreceding, -1)


def _switched(parts: DataFrame, *order: str) -> DataFrame:
    """Adds ``switched``: whether the parts before, of a block or of a file, have
    switched between inside and outside of a string."""
    return parts.withColumn("switched", F.coalesce(F.sum("flips").over(_before(*order)), F.lit(0)) % 2)


def block_states(summaries: DataFrame) -> DataFrame:
    """``path, block, inside, depth, list``: the state each block of a file begins
    in, and whether the file holds an array."""
    begun = _switched(summaries, "path", "block")
    step = F.when(F.col("switched") == 0, F.col("outside")).otherwise(F.col("inside"))
    return begun.select(
        "path", "block", (F.col("switched") == 1).alias("inside"),
        F.coalesce(F.sum(step).over(_before("path", "block")), F.lit(0)).cast("bigint").alias("depth"),
        F.bool_or("list").over(Window.partitionBy("path")).alias("list"),
    )


_PIECE = {"path": pa.string(), "block": pa.int64(), "at": pa.int64(), "piece": pa.string(), "opened": pa.bool_(), "closed": pa.bool_()}


class _Block:
    """The pieces of one block, in order."""

    def __init__(self, key: tuple[str, int], inside: bool, depth: int, first: bytes, listed: bool):
        self.key, self.inside, self.depth = key, inside, depth
        self.at, self.held = 0, []
        # A block begins behind a comma: that is a border, or a piece goes on.
        self.opened = key[1] == 0 or (depth == 1 and not inside)
        self.listed = _is_array(first) if key[1] == 0 else listed

    def _row(self, last: bool, closed: bool) -> tuple:
        piece = b",".join(self.held)
        if self.key[1] == 0 and self.at == 0:
            piece = piece.lstrip()[1:]
        if last and closed:
            piece = piece.rstrip().removesuffix(b"]")
        row = (*self.key, self.at, piece.decode(errors="replace"), self.opened, closed)
        self.at, self.opened, self.held = self.at + 1, True, []
        return row

    def add(self, values: list[bytes]) -> list[tuple]:
        """The pieces that end in these fragments."""
        if not self.listed:
            return []
        scan, out, start = _Scan(values), [], 0
        within, depths = scan.from_state(self.inside, self.depth)
        for i in np.flatnonzero(~within & (depths == 1)).tolist():
            self.held += values[start : i + 1]
            out.append(self._row(False, True))
            start = i + 1
        self.held += values[start:]
        self.inside, self.depth = bool(within[-1]), int(depths[-1])
        return out

    def rest(self) -> list[tuple]:
        """What is left at the end of the block, or of the array."""
        return [self._row(True, self.depth == 0 and not self.inside)] if self.held else []


def block_pieces(fragments: DataFrame) -> DataFrame:
    """Elements and pieces of elements; ``opened`` and ``closed`` tell whether they
    begin and end with a border in this block.

    ``fragments``, block by block in order, have the state their block begins in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for key, part, values in _runs(batches):
            rows = []
            if block is None or key != block.key:
                rows += block.rest() if block else []
                state = [part.column(c)[0].as_py() for c in ("inside", "depth")]
                block = _Block(key, *state, values[0], part.column("list")[0].as_py())
            rows += block.add(values)
            if rows:
                yield _table(_PIECE, rows)
        if block:
            yield _table(_PIECE, block.rest())

    schema = "path STRING, block BIGINT, at BIGINT, piece STRING, opened BOOLEAN, closed BOOLEAN"
    return fragments.select("path", "block", "value", "inside", "depth", "list").mapInArrow(run, schema)


def _stitched(pieces: DataFrame) -> DataFrame:
    """Elements that go over the borders of blocks, at the place they begin."""
    upto = Window.partitionBy("path").orderBy("block", "at").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("number", F.sum(F.col("opened").cast("int")).over(upto))
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "piece"))).alias("parts")
    found = numbered.groupBy("path", "number").agg(parts)
    first, text = F.col("parts")[0], F.array_join(F.transform("parts", lambda x: x["piece"]), ",")
    return found.select("path", first["block"].alias("block"), first["at"].alias("at"), text.alias("piece"))


def _least_block(spark: SparkSession) -> int:
    """No file of so many bytes is cut."""
    sizes = [spark.conf.get(f"spark.sql.files.{x}") for x in ("maxPartitionBytes", "openCostInBytes")]
    units = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}

    def number(text: str) -> int:
        digits = text.lower().rstrip("ib")
        return int(digits[:-1]) * units[digits[-1]] if digits[-1] in units else int(digits)

    return max(1, min(number(x) for x in sizes))


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """``payload, seq`` of the elements of all array files below ``path``."""
    least = _least_block(spark)
    try:
        lines = spark.read.option("lineSep", ",").text(path)
        # Names and lengths only; contents are not read.
        files = spark.read.format("binaryFile").load(path).filter(F.col("length") > least)
        blocks = files.agg(F.sum(F.ceil(F.col("length") / least))).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ELEMENT)
    meta = F.col("_metadata")

    def fragments(large: bool) -> DataFrame:
        sized = lines.filter(meta["file_size"] > least if large else meta["file_size"] <= least)
        return sized.select(
            meta["file_path"].alias("path"), meta["file_block_start"].alias("block"), "value", F.monotonically_increasing_id().alias("line")
        )

    state = {"inside": F.lit(False), "depth": F.lit(0).cast("bigint"), "list": F.lit(True)}
    found = block_pieces(fragments(False).withColumns(state)).select("path", "block", "at", "piece")
    if blocks:
        states = block_states(block_summaries(fragments(True)))
        if blocks <= BROADCAST_BLOCKS:
            joined = fragments(True).join(F.broadcast(states), ["path", "block"])
        else:
            joined = fragments(True).join(states, ["path", "block"]).sortWithinPartitions("path", "block", "line")
        pieces = block_pieces(joined)
        whole = pieces.filter("opened AND closed").select("path", "block", "at", "piece")
        found = found.unionByName(whole).unionByName(_stitched(pieces.filter("NOT (opened AND closed)")))
    items = F.from_json(F.concat(F.lit("["), "piece", F.lit("]")), "array<string>")
    parsed = found.filter(F.length(F.trim("piece")) > 0).withColumn("items", items).filter(F.size("items") == 1)
    return parsed.select(F.col("items")[0].alias("payload"), F.struct(file_order(F.col("path")).alias("file"), "block", "at").alias("seq"))
