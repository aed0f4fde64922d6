"""Benchmark decontamination by templates.

Texts become sequences of typed tokens: numbers, names and units are slots, other
words stand for themselves in lower case.  Windows of tokens are hashed and
looked up among the windows of the benchmark, so a question asked again with
other figures or names is found too.  What is found is checked: a slot value of
the item must stand for the same value everywhere in the match, and different
names for different names; where one does not, the match is split.

Beside these, plain windows are looked up: words and numbers without slots and
case, and single characters of scripts without blanks, so that a copy is found
whatever its share of figures and names.

The benchmark is broadcast in blocks of bounded size; each block meets all
documents.  No text is shuffled.

Defined results: null or empty texts and items match nothing; items of fewer than
``LEAST`` tokens are searched for as plain text only, as a whole; items that occur twice are reported each;
an empty table gives an empty result; other columns do not enter.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as t
from pyspark.sql.pandas.types import to_arrow_type

from recueil.llm import rolling
from recueil.llm.common import whole_text

#: Tokens of a window, and how many of them must be words.
WINDOW = 8
WORDS = 4
#: A shorter item is its own window; still shorter ones have plain windows only.
LEAST = 5

#: An item is in a document if so many tokens in a row match (or all it has), or
#: this share of its tokens in several pieces.
IN_A_ROW = 13
SHARE = 0.5

#: Bytes of benchmark text that are broadcast at a time.
BLOCK_BYTES = 16 << 20

NUMBER, NAME, UNIT = np.uint64(11), np.uint64(12), np.uint64(13)

# Units that may follow a number.
UNITS = (
    "g kg mg t lb lbs pound pounds ounce ounces oz m km cm mm mile miles foot feet inch inches yard yards l ml cl litre litres"
    " liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months"
    " year years percent degree degrees dollar dollars usd euro euros eur cent cents mph kmh watt watts volt volts joule"
    " joules kb mb gb tb hz khz mhz ghz"
).split()

_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_ENDS = np.zeros(256, np.int64)
_ENDS[[ord(c) for c in ".!?:\n"]] = 1


@dataclass
class Tokens:
    """Typed tokens of a chunk of texts."""

    code: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    row: np.ndarray

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all windows; those that leave their row are 0."""
        n = len(self.code) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        total = np.full(n, np.uint64(size))
        for k in range(size):
            total += self.code[k : n + k] * np.uint64(pow(rolling.BASE, k + 1, 1 << 64))
        return np.where(self.row[:n] == self.row[size - 1 :], rolling.mixed(total) | np.uint64(1), np.uint64(0))


def _lowered(data: np.ndarray) -> np.ndarray:
    """A-Z and the capitals of Latin-1 in lower case."""
    low = rolling.FOLD[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    low[capital] += 32
    return low


def tokens(data: np.ndarray, starts: np.ndarray, powers: rolling.Powers, units: np.ndarray) -> Tokens:
    """Typed tokens of the texts of a chunk; ``units`` are hashes, sorted."""
    kind = _KIND[data]
    if len(data) > 2:
        point = np.flatnonzero((data[1:-1] == 46) | (data[1:-1] == 44)) + 1
        kind[point[(kind[point - 1] == 2) & (kind[point + 1] == 2)]] = 2
    # A change of kind ends a token, like the end of a text.
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1 if len(kind) else np.zeros(0, np.int64)
    begin, end, _ = rolling.word_spans(kind > 0, np.union1d(starts, change))
    row = np.searchsorted(starts, begin, "right") - 1
    low = _lowered(data)
    code = rolling.mixed(rolling.Prefix(low, powers).ranges(begin, end) + (end - begin).astype(np.uint64)) | np.uint64(64)
    number = kind[begin] == 2
    first = np.ones(len(begin), bool)
    first[1:] = row[1:] != row[:-1]
    stops = np.concatenate([[0], np.cumsum(_ENDS[data])])
    after_stop = first.copy()
    after_stop[1:] |= stops[begin[1:]] > stops[end[:-1]]
    name = (low[begin] != data[begin]) & ~number
    wide = np.minimum(begin + 1, len(data) - 1)
    name |= (data[begin] == 0xC3) & (low[wide] != data[wide]) & (end - begin > 1)
    unit = np.zeros(len(begin), bool)
    unit[1:] = number[:-1] & ~first[1:] & np.isin(code[1:], units)
    code[name & ~after_stop] = NAME
    code[unit] = UNIT
    code[number] = NUMBER
    return Tokens(code, begin, end, row)


def unit_codes(powers: rolling.Powers) -> np.ndarray:
    texts = pa.array(UNITS)
    [(_, _, data, starts)] = rolling.chunks(texts)
    return np.unique(tokens(data, starts, powers, np.zeros(0, np.uint64)).code)


LETTER, HALF, QUARTER, DIGIT = 1, 2, 3, 4
#: What a plain token counts, by the kind of its first character.
_COUNTS = np.array([0, 1, 0.5, 0.25, 1])

# Blocks of scripts without blanks, and what part of a word one of
# their characters is about.
_ALONE = [
    (HALF, 0x2E80, 0x312F), (HALF, 0x31A0, 0x31BF), (HALF, 0x31F0, 0x31FF), (HALF, 0x3400, 0x4DBF), (HALF, 0x4E00, 0x9FFF),
    (HALF, 0xF900, 0xFAFF), (HALF, 0xFF66, 0xFF9F), (HALF, 0x1B000, 0x1B16F), (HALF, 0x20000, 0x3FFFF),
    (QUARTER, 0x0E00, 0x0FFF), (QUARTER, 0x1000, 0x109F), (QUARTER, 0x1780, 0x17FF), (QUARTER, 0x1950, 0x19FF),
    (QUARTER, 0x1A20, 0x1AAF), (QUARTER, 0x1B00, 0x1B7F), (QUARTER, 0xA980, 0xA9FF), (QUARTER, 0xAA60, 0xAADF),
]


@lru_cache(1)
def _kinds() -> np.ndarray:
    """The kind of every code point; 0 for what stands between tokens."""
    category = [unicodedata.category(chr(c)) for c in range(0x32400)]
    kinds = np.full(0x110000, LETTER, np.uint8)
    kinds[: len(category)] = [DIGIT if c[0] == "N" else LETTER if c[0] in "LM" or c in ("Cn", "Co") else 0 for c in category]
    for kind, first, last in _ALONE:
        part = kinds[first : last + 1]
        part[part == LETTER] = kind
    return kinds


def plain_tokens(texts: list[str], powers: rolling.Powers) -> tuple[Tokens, np.ndarray, np.ndarray]:
    """Tokens of case-folded texts with their kinds, and where each text starts."""
    starts = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _kinds()[points]
    alone = (kind == HALF) | (kind == QUARTER)
    edge = np.zeros(len(points) + 1, bool)
    edge[starts] = True
    edge[:-1] |= alone
    edge[1:] |= alone
    begin, end, _ = rolling.word_spans(kind > 0, np.flatnonzero(edge))
    up, down = powers.upto(len(points) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(rolling.mixed(points.astype(np.uint64) + np.uint64(1)) * up[: len(points)])])
    code = rolling.mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    return Tokens(code, begin, end, np.searchsorted(starts, begin, "right") - 1), kind[begin], starts


def _inner(text: str) -> str:
    """A text without white space."""
    return "".join(text.split())


class Plain:
    """Plain windows of the items: hash, item and place, by hash.

    Items of few words, formulas for instance, must agree in all characters
    between their tokens (``exact``), those without tokens in all but blanks
    (``signs``).
    """

    def __init__(self, texts: list[str]):
        powers = rolling.Powers()
        self.counts: list[np.ndarray] = []
        self.exact: dict[int, str] = {}
        self.signs: list[tuple[int, str]] = []
        found = []
        for i, value in enumerate(texts):
            folded = value.casefold()
            typed, kind, _ = plain_tokens([folded], powers)
            self.counts.append(_COUNTS[kind])
            size = min(WINDOW, len(kind))
            if not size:
                self.signs += [(i, _inner(folded))] if _inner(folded) else []
                continue
            if len(kind) < WINDOW and (kind == LETTER).sum() < WORDS:
                self.exact[i] = _inner(folded[typed.begin[0] : typed.end[-1]])
            found += [(size, h, i, p) for p, h in enumerate(typed.windows(size).tolist())]
        found.sort(key=lambda x: x[1])
        self.sizes = sorted({x[0] for x in found})
        self.hashes = np.array([x[1] for x in found], np.uint64)
        self.item, self.place = (np.array([x[k] for x in found], np.int64) for k in (2, 3))
        # One bit of a hash's head tells most windows of documents apart.
        self.shift = np.uint64(64 - max(16, (16 * len(found)).bit_length()))
        self.heads = np.zeros(1 << (64 - int(self.shift)), bool)
        self.heads[self.hashes >> self.shift] = True

    def hits(self, typed: Tokens) -> Iterator[tuple[int, int, int, int, int]]:
        """Windows in common: row, item, place there, place here, size."""
        for size in self.sizes:
            windows = typed.windows(size)
            here = np.flatnonzero(self.heads[windows >> self.shift])
            a, b = (np.searchsorted(self.hashes, windows[here], side) for side in ("left", "right"))
            for at, first, last in zip(here[b > a].tolist(), a[b > a].tolist(), b[b > a].tolist(), strict=True):
                row = int(typed.row[at])
                for k in range(first, last):
                    yield row, int(self.item[k]), int(self.place[k]), at, size

    def found(self, texts: list[str], powers: rolling.Powers) -> dict[int, dict[int, tuple[int, int]]]:
        """Per row its items: tokens of the item, matched tokens."""
        texts = [x.casefold() for x in texts]
        typed, _, starts = plain_tokens(texts, powers)
        items: dict[int, dict[int, tuple[int, int]]] = defaultdict(dict)
        covered: dict[tuple[int, int], dict[int, set]] = defaultdict(lambda: defaultdict(set))
        for row, item, there, here, size in self.hits(typed):
            if len(self.counts[item]) >= WINDOW:
                covered[row, item][here - there].update(range(there, there + size))
            elif item not in items.get(row, ()):
                a, b = int(typed.begin[here] - starts[row]), int(typed.end[here + size - 1] - starts[row])
                if item not in self.exact or self.exact[item] == _inner(texts[row][a:b]):
                    items[row][item] = size, size
        for (row, item), lines in covered.items():
            counts = self.counts[item]
            longest = 0.0
            for places in lines.values():
                run, before = 0.0, -2
                for place in sorted(places):
                    run = counts[place] + (run if place == before + 1 else 0.0)
                    longest, before = max(longest, run), place
            every = set().union(*lines.values())
            whole, n = counts.sum(), sum(counts[x] for x in every)
            if longest >= min(IN_A_ROW, whole) or n >= max(WINDOW, SHARE * whole):
                items[row][item] = len(counts), len(every)
        if self.signs:
            for row, text in enumerate(map(_inner, texts)):
                for item, signs in self.signs:
                    if signs in text:
                        items[row][item] = 0, 0
        return items


@dataclass
class Block:
    """Benchmark items with their windows: hash, item and place, by hash."""

    ids: list
    code: list[np.ndarray]
    text: list[list[bytes]]
    sizes: list[int]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    plain: Plain
    #: Whole items without blanks and case.
    lines: set[str]
    keys: np.ndarray = field(init=False)

    def __post_init__(self):
        self.keys = np.unique(self.hashes)


def block(ids: list, texts: list[str]) -> Block:
    powers = rolling.Powers()
    units = unit_codes(powers)
    code, words, found = [], [], []
    for i, value in enumerate(texts):
        raw = np.frombuffer(value.encode(), np.uint8)
        if not len(raw):
            code.append(np.zeros(0, np.uint64))
            words.append([])
            continue
        typed = tokens(raw, np.array([0, len(raw)]), powers, units)
        code.append(typed.code)
        low = _lowered(raw).tobytes()
        words.append([low[a:b] for a, b in zip(typed.begin, typed.end, strict=True)])
        size = min(WINDOW, len(typed.code))
        if size >= LEAST:
            is_word = np.concatenate([[0], np.cumsum(typed.code >= 64)])
            enough = is_word[size:] - is_word[:-size] >= min(WORDS, size)
            found += [(size, h, i, p) for p, h in enumerate(typed.windows(size).tolist()) if enough[p]]
    found.sort(key=lambda x: x[1])
    return Block(
        ids, code, words, sorted({x[0] for x in found}), np.array([x[1] for x in found], np.uint64),
        np.array([x[2] for x in found], np.int64), np.array([x[3] for x in found], np.int64), Plain(texts),
        {_inner(x.casefold()) for x in texts},
    )


def _offending(item: list[bytes], said: list[bytes], code: np.ndarray, forth: dict, back: dict) -> list[int]:
    """Places whose slot value breaks that values stand for each other one to one.

    Equal values never do.  Else ``forth`` and ``back``, noted from other pieces,
    decide what a value stands for, then the value itself, then the most frequent
    one; among equally frequent ones none is right.
    """
    slots = [(k, (kind, item[k]), (kind, said[k])) for k, kind in enumerate(code.tolist()) if kind < 64]
    votes = Counter((a, b) for _, a, b in slots)

    def chosen(noted: dict, one: int) -> dict:
        best: dict = {}
        for pair, n in votes.items():
            x, y = pair[one], pair[1 - one]
            best.setdefault(x, []).append((math.inf if x == y else n, y))
        for x, values in best.items():
            most = max(values, key=lambda v: v[0])
            best[x] = noted.get(x, most[1] if sum(v[0] == most[0] for v in values) == 1 else None)
        return best

    to, of = chosen(forth, 0), chosen(back, 1)
    return [k for k, a, b in slots if a != b and (to[a] != b or (a[0] == NAME and of[b] != a))]


def matches(code: np.ndarray, words: list[bytes], hits: list[tuple[int, int, int, int]], bench: Block) -> list[tuple[int, int, bool]]:
    """Items in one text: item, matched tokens, whether slots have new values.

    ``hits`` are windows in common: item, place there, place here, size.  Windows
    with an offending slot are left out, like those with another word.
    """
    by_item: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for item, there, here, size in hits:
        by_item[item][here - there].append((there, there + size))
    found = []
    for item, lines in by_item.items():
        pieces = [x for shift, windows in lines.items() for x in _merged(sorted(windows), shift)]
        covered, longest, other, forth, back = set(), 0, False, {}, {}
        for a, b, shift, windows in sorted(pieces, key=lambda p: (p[0] - p[1], p)):
            mine, said, kinds = bench.text[item][a:b], words[a + shift : b + shift], bench.code[item][a:b]
            if offending := _offending(mine, said, kinds, forth, back):
                wrong = np.zeros(b - a + 1, np.int64)
                wrong[np.array(offending) + 1] = 1
                before = np.cumsum(wrong)
                windows = [(x, y) for x, y in windows if before[y - a] == before[x - a]]
            for x, y, _, _ in _merged(windows, shift):
                covered.update(range(x, y))
                longest = max(longest, y - x)
                other |= mine[x - a : y - a] != said[x - a : y - a]
                for kind, p, q in zip(kinds[x - a : y - a].tolist(), mine[x - a : y - a], said[x - a : y - a], strict=True):
                    if kind < 64:
                        forth.setdefault((kind, p), (kind, q))
                        back.setdefault((kind, q), (kind, p))
        whole = len(bench.code[item])
        if longest >= min(IN_A_ROW, whole) or len(covered) >= max(WINDOW, SHARE * whole):
            found.append((item, len(covered), other))
    return found


def _merged(windows: list[tuple[int, int]], shift: int) -> list[tuple[int, int, int, list]]:
    """Pieces of sorted windows that touch, each with its windows."""
    pieces: list = []
    for a, b in windows:
        if pieces and a <= pieces[-1][1]:
            pieces[-1][1] = b
            pieces[-1][3].append((a, b))
        else:
            pieces.append([a, b, shift, [(a, b)]])
    return [tuple(x) for x in pieces]


def _found(texts: pa.Array, bench: Block, powers: rolling.Powers, units: np.ndarray) -> Iterator[tuple[int, list]]:
    """Rows in which items are found: item, its tokens, matched tokens, whether
    slots have new values.  What typed windows find is not counted again."""
    for first, _, data, starts in rolling.chunks(texts):
        typed = tokens(data, starts, powers, units)
        by_row: dict[int, list] = defaultdict(list)
        for size in bench.sizes:
            windows = typed.windows(size)
            for here in np.flatnonzero(np.isin(windows, bench.keys)).tolist():
                a, b = np.searchsorted(bench.hashes, windows[here], "left"), np.searchsorted(bench.hashes, windows[here], "right")
                row = int(typed.row[here])
                by_row[row] += [(int(bench.item[k]), int(bench.place[k]), here, size) for k in range(a, b)]
        raw = data.tobytes()
        plain = bench.plain.found([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[:-1], starts[1:], strict=True)], powers)
        if not by_row and not plain:
            continue
        low = _lowered(data)
        for row in sorted(by_row.keys() | plain.keys()):
            items = []
            if hits := by_row.get(row):
                a, b = np.searchsorted(typed.row, [row, row + 1])
                words = [low[x:y].tobytes() for x, y in zip(typed.begin[a:b], typed.end[a:b], strict=True)]
                own = [(item, there, here - int(a), size) for item, there, here, size in hits]
                items = [(item, len(bench.code[item]), n, other) for item, n, other in matches(typed.code[a:b], words, own, bench)]
            told = {x[0] for x in items}
            items += [(item, size, n, False) for item, (size, n) in sorted(plain.get(row, {}).items()) if item not in told]
            if items:
                yield first + row, items


def _blocks(benchmark: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_bytes``."""
    items = benchmark.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).filter("length(text) > 0")
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, -(-total // block_bytes))
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("key", "text"), F.lit(parts)) == part).toArrow().sort_by([("key", "ascending"), ("text", "ascending")])
        yield block(rows.column("key").to_pylist(), rows.column("text").to_pylist())


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``key, item_id, item_tokens, n_matched, new_values``: every item found in
    a document, with how much of it; ``new_values`` if slots are filled anew.

    Tokens are typed ones, or plain ones for what only plain windows find."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), whole_text(text).alias("text"))
    kinds = [rows.schema["key"].dataType, benchmark.schema[item].dataType, t.LongType(), t.LongType(), t.BooleanType()]
    names = ["key", "item", "item_tokens", "n_matched", "new_values"]
    schema = t.StructType([t.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    item_kind = to_arrow_type(kinds[1])
    every = None
    for bench in _blocks(benchmark, item, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(bench)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            powers, known = rolling.Powers(), shared.value
            units = unit_codes(powers)
            for batch in batches:
                found = [(i, *x) for i, items in _found(batch.column("text"), known, powers, units) for x in items]
                if found:
                    at, items, size, n, other = (list(x) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("key").take(pa.array(at)), pa.array([known.ids[x] for x in items], item_kind),
                            pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array(other, pa.bool_()),
                        ],
                        names=names,
                    )

        part = rows.mapInArrow(run, schema)
        every = part if every is None else every.unionByName(part)
    return every.select(F.col("key").alias(key), F.col("item").alias(item), "item_tokens", "n_matched", "new_values")


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents in which no item is found, decided where they are read.

    Items are found wherever they stand; a document goes if ``LEAST`` tokens of one
    match, or if an item is a whole line of it.  An item of a word or two within a
    sentence is reported by :func:`contaminated` and drops nothing.
    """
    for bench in _blocks(benchmark, item, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(bench)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            powers, known = rolling.Powers(), shared.value
            units = unit_codes(powers)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                texts = batch.column(text)
                for i, items in _found(texts.fill_null(""), known, powers, units):
                    said = any(x[2] >= LEAST for x in items)
                    keep[i] = not said and not any(_inner(x.casefold()) in known.lines for x in texts[i].as_py().split("\n"))
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
