"""Token counts of whole texts, without moving a single pre-token.

Texts are cut into pre-tokens where they are read.  A table of frequent
pre-tokens with their lengths in tokens is broadcast: the vocabulary itself, in
which byte-pair training has collected what is frequent.  It is as long as the
vocabulary, whatever the corpus.  Other pre-tokens are encoded by the library
once per Python worker and then found in the worker's bounded cache.

Defined results: a null or empty text has no tokens; strings of special tokens
inside a text are treated as the library does by default; repeated rows are
counted each; an empty table gives an empty result; the result has the key and
its own columns only, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as t

from recueil.llm.common import whole_text

#: The longest text a model of this context takes.
CONTEXT = 1024

#: Pre-tokens a worker remembers beyond the broadcast table; longer ones are
#: encoded each time.
CACHE_ENTRIES = 400_000
CACHE_CHARS = 64


def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_names(tokenizer) -> list[str]:
    """How the library writes the 256 bytes as characters (byte-level models)."""
    from tokenizers.pre_tokenizers import ByteLevel

    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    names = [chr(b) if b in printable else chr(next(rest)) for b in range(256)]
    assert set(names) == set(ByteLevel.alphabet())
    return names


def frequent_lengths(path: str) -> dict[str, int]:
    """Pre-tokens that are in the vocabulary, with their number of tokens."""
    tokenizer = _library(path)
    byte_of = {name: byte for byte, name in enumerate(_byte_names(tokenizer))}
    lengths = {}
    for name in tokenizer.get_vocab(with_added_tokens=False):
        try:
            text = bytes(byte_of[c] for c in name).decode()
        except (KeyError, UnicodeDecodeError):
            continue  # no text of its own
        lengths[text] = len(tokenizer.model.tokenize(name))
    return lengths


class _Lengths(dict):
    """Lengths of pre-tokens: the broadcast ones, then those met here."""

    def __init__(self, frequent: dict[str, int], encode: Callable[[str], int]):
        super().__init__(frequent)
        self.encode, self.most = encode, len(frequent) + CACHE_ENTRIES
        self.frequent = frequent

    def __missing__(self, piece: str) -> int:
        n = self.encode(piece)
        if len(piece) <= CACHE_CHARS:
            if len(self) >= self.most:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n


class _Counter:
    def __init__(self, path: str, pattern: str, frequent: dict[str, int]):
        import regex

        self.tokenizer = _library(path)
        names = _byte_names(self.tokenizer)
        self.special = [a.content for a in self.tokenizer.get_added_tokens_decoder().values()]
        table = {b: names[b] for b in range(256)}
        tokenize = self.tokenizer.model.tokenize
        self.lengths = _Lengths(frequent, lambda x: len(tokenize(x.encode().decode("latin-1").translate(table))))
        self.split = regex.compile(pattern).findall
        self.known: set[str] = set()

    def plain(self, text: str) -> bool:
        """Whether both libraries surely cut the text alike: it has no special
        token and no character that is newer than Python's Unicode table."""
        if any(s in text for s in self.special):
            return False
        if text.isascii():
            return True
        fresh = set(text) - self.known
        if any(unicodedata.category(c) == "Cn" for c in fresh):
            return False
        self.known |= fresh
        return True

    def __call__(self, text: str) -> int:
        if self.plain(text):
            return sum(map(self.lengths.__getitem__, self.split(text)))
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


#: Counters of this Python worker, which outlives its tasks.
_WORKERS: dict[tuple, _Counter] = {}


def _worker(key: tuple, make: Callable[[], _Counter]) -> _Counter:
    """The counter for a vocabulary and a pattern; the worker keeps the newest."""
    if key not in _WORKERS:
        _WORKERS.clear()
        _WORKERS[key] = make()
    return _WORKERS[key]


def token_counts(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", context: int = CONTEXT
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every document.

    ``path`` names a byte-level BPE file of the tokenizers library, readable on
    every executor, ``pattern`` the expression it cuts texts with.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(path))
    digest = hashlib.sha256(Path(path).read_bytes()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _worker((path, digest, pattern), lambda: _Counter(path, pattern, frequent.value))
        for batch in batches:
            counts = pa.array([count(x.as_py()) for x in batch.column("__text")], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column("n_bytes"), counts], names=["key", "n_bytes", "n_tokens"]
            )

    value = whole_text(text)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.octet_length(value).cast("bigint").alias("n_bytes"), value.alias("__text"))
    schema = t.StructType([*rows.drop("__text").schema.fields, t.StructField("n_tokens", t.LongType())])
    counted = rows.mapInArrow(run, schema)
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > context).alias("over_limit"))
