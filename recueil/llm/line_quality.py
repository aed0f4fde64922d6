"""Document quality from a linear-chain model of lines.

A conditional random field labels every line of a text good or bad.  Its features
are figures of the line and of the lines before and after it; transitions tie
neighbouring labels.  Forward and backward sums give the probability that a line
is good, and their mean, weighted by line length, is the document's score.

Only labels of whole documents are known, so in fitting every line has its
document's label.  The model is fitted on a bounded sample of labelled documents
(``SAMPLE`` with texts up to ``SAMPLE_BYTES``); every document is scored, with its
whole text.  Neither id, source nor language is an input.

Defined results: blank lines do not count; a text without words scores the share
of good documents in the sample; repeated label rows count once, of conflicting
ones the worse; without any label the score is 0.5; an empty table gives an
empty result; the result has its own columns only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as t

from recueil.llm import rolling
from recueil.llm.common import whole_text

#: Labelled documents the model is fitted on, and how long they may be.
SAMPLE = 4000
SAMPLE_BYTES = 20_000

#: Lines that follow each other in one chain while fitting.
CHAIN = 64
STEPS = 200
RATE = 0.05
RIDGE = 1e-4

#: From this score a document is predicted to be good.
LIMIT = 0.3

_UPPER, _LOWER, _DIGIT, _SYMBOL, _BANG, _PIPE, _STOP, _HIGH = range(8)
_CLASS = np.zeros((8, 256), bool)
_CLASS[_UPPER, 65:91] = True
_CLASS[_LOWER, 97:123] = True
_CLASS[_DIGIT, 48:58] = True
for _row, _chars in ((_SYMBOL, b"#*$%&<>@^~_=+\\{}[]"), (_BANG, b"!?"), (_PIPE, b"|"), (_STOP, b".,;:")):
    _CLASS[_row, list(_chars)] = True
_CLASS[_HIGH, 128:] = True

#: Figures of one line; see ``line_figures``.
FIGURES = 14


def line_figures(data: np.ndarray, starts: np.ndarray, powers: rolling.Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, length in bytes and figures of every line that has a word."""
    begin, end, row = rolling.word_spans(data != 10, starts)
    word_begin, word_end, word_row = rolling.words(data, starts)
    line = np.searchsorted(begin, word_begin, "right") - 1
    n_words = np.bincount(line, minlength=len(begin))
    code = rolling.mixed(rolling.Prefix(data, powers).ranges(word_begin, word_end) + (word_end - word_begin).astype(np.uint64))

    def per_line(flags: np.ndarray, lines: np.ndarray) -> np.ndarray:
        return np.bincount(lines[flags], minlength=len(begin))

    def counted(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[end] - total[begin]

    counts = [counted(c[data]) for c in _CLASS]
    pair = np.zeros(len(code), bool)
    pair[1:] = (code[1:] == code[:-1]) & (line[1:] == line[:-1])
    # Words and lines seen before in the same text.
    def seen(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
        order = np.lexsort((np.arange(len(values)), values, rows))
        again = np.zeros(len(values), bool)
        again[order[1:]] = (values[order[1:]] == values[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
        return again

    triple = np.zeros(len(code), np.uint64)
    if len(code) > 2:
        triple[:-2] = rolling.mixed(code[:-2] + code[1:-1] * np.uint64(3) + code[2:] * np.uint64(7))
    triples = seen(triple, word_row)
    lines = rolling.Prefix(data, powers, 2).ranges(begin, end)
    size = (end - begin).astype(float)
    words = np.maximum(n_words, 1)
    letters = np.maximum(counts[_UPPER] + counts[_LOWER] + counts[_HIGH], 1)
    last = data[np.maximum(end - 1, 0)]
    figures = np.stack(
        [
            np.log1p(n_words),
            np.log1p((word_end - word_begin).sum() if not len(begin) else np.bincount(line, word_end - word_begin, len(begin)) / words),
            counts[_UPPER] / letters,
            counts[_DIGIT] / np.maximum(size, 1),
            np.minimum(counts[_SYMBOL] / words, 5),
            np.minimum(counts[_BANG] / words, 5),
            np.minimum(counts[_PIPE] / words, 2),
            np.minimum(counts[_STOP] / words, 2),
            counts[_HIGH] / np.maximum(size, 1),
            per_line(pair, line) / words,
            per_line(triples, line) / words,
            seen(lines, row).astype(float),
            np.isin(last, list(b".!?")).astype(float),
            (n_words < 4).astype(float),
        ],
        axis=1,
    )
    real = n_words > 0
    return row[real], size[real], figures[real]


def with_neighbours(row: np.ndarray, figures: np.ndarray) -> np.ndarray:
    """Figures of the line, the one before and the one after, and a constant."""
    before, after = np.zeros_like(figures), np.zeros_like(figures)
    same = row[1:] == row[:-1]
    before[1:][same] = figures[:-1][same]
    after[:-1][same] = figures[1:][same]
    return np.concatenate([figures, before, after, np.ones((len(row), 1))], axis=1)


@dataclass
class Model:
    """Log-odds that a line is good, and of keeping the label of the line before.

    ``stay`` has one entry for staying bad and one for staying good.
    """

    weights: np.ndarray
    stay: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    share: float

    def odds(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights


def marginals(odds: np.ndarray, first: np.ndarray, count: np.ndarray, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over chains of lines, all chains a step at a time.

    ``odds`` holds the lines of all chains, chain i from ``first[i]``.  Returns
    the probability that each line is good, and that it and the line before are
    both bad or both good; the latter are 0 for first lines.
    """
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    steps = int(count.max(initial=0))
    moves = np.array([[stay[0], 0.0], [0.0, stay[1]]])
    emit = np.stack([np.zeros_like(odds), odds], axis=1)
    alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
    live = np.searchsorted(-count, -np.arange(steps), "left")  # chains longer than each step
    for s in range(steps):
        at = first[: live[s]] + s
        if s:
            alpha[at] = np.logaddexp.reduce(alpha[at - 1][:, :, None] + moves, axis=1)
        alpha[at] += emit[at]
        alpha[at] -= alpha[at].max(axis=1, keepdims=True)
    for s in range(steps - 2, -1, -1):
        at = first[: live[s + 1]] + s
        beta[at] = np.logaddexp.reduce(moves + (beta[at + 1] + emit[at + 1])[:, None, :], axis=2)
        beta[at] -= beta[at].max(axis=1, keepdims=True)
    both = alpha + beta
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    later = np.ones(len(odds), bool)
    later[first] = False
    at = np.flatnonzero(later)
    joint = alpha[at - 1][:, :, None] + moves + (beta[at] + emit[at])[:, None, :]
    joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    stays = np.zeros((len(odds), 2))
    stays[at] = joint[:, [0, 1], [0, 1]]
    return good, stays, later


def _chains(row: np.ndarray, length: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First line and number of lines of every chain."""
    new = np.ones(len(row), bool)
    new[1:] = row[1:] != row[:-1]
    first = np.flatnonzero(new)
    if length:
        within = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        first = np.flatnonzero(within % length == 0)
    return first, np.diff(np.append(first, len(row)))


def fit(features: np.ndarray, row: np.ndarray, label: np.ndarray, share: float) -> Model:
    """Maximum likelihood by Adam; ``label`` is that of each line."""
    mean, scale = features.mean(axis=0), features.std(axis=0)
    mean[-1], scale[-1] = 0, 1
    scale[scale < 1e-6] = 1
    x = (features - mean) / scale
    first, count = _chains(row, CHAIN)
    after = np.ones(len(row), bool)
    after[first] = False
    known = np.zeros((len(row), 2))
    known[after & (label == 0), 0] = known[after & (label == 1), 1] = 1
    theta = np.zeros(x.shape[1] + 2)
    m = v = np.zeros_like(theta)
    # Documents count alike, whatever their number of lines.
    _, inverse, lines = np.unique(row, return_inverse=True, return_counts=True)
    weight = 1 / lines[inverse]
    weight /= weight.sum()
    for step in range(1, STEPS + 1):
        good, stays, _ = marginals(x @ theta[:-2], first, count, theta[-2:])
        gradient = np.concatenate([x.T @ (weight * (label - good)), ((known - stays) * weight[:, None]).sum(axis=0)]) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(theta[:-2], theta[-2:], mean, scale, share)


def scores(model: Model | None, data: np.ndarray, starts: np.ndarray, powers: rolling.Powers) -> np.ndarray:
    """Length-weighted mean probability of good lines, per text."""
    n = len(starts) - 1
    out = np.full(n, model.share if model else 0.5)
    if model is None or not len(data):
        return out
    row, size, figures = line_figures(data, starts, powers)
    if not len(row):
        return out
    first, count = _chains(row)
    good, _, _ = marginals(model.odds(with_neighbours(row, figures)), first, count, model.stay)
    total = np.bincount(row, size, n)
    has = total > 0
    out[has] = np.clip(np.bincount(row, size * good, n)[has] / total[has], 0, 1)
    return out


def held_out(key: str) -> Column:
    """Whether the crc32 of the key as text is divisible by 5; null is ''."""
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fitted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    """The model from labelled documents that are not held out."""
    known = labels.filter(~held_out(key)).groupBy(F.col(f"`{key}`").alias("key")).agg(F.min(f"`{label}`").alias("label"))
    value = whole_text(text)
    short = docs.filter(F.octet_length(value) <= SAMPLE_BYTES).select(F.col(f"`{key}`").alias("key"))
    usable = known.filter("label IS NOT NULL AND key IS NOT NULL").join(short, "key", "left_semi")
    sample = usable.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).toArrow()
    if not len(sample):
        return None
    chosen = docs.sparkSession.createDataFrame(sample)
    texts = docs.select(F.col(f"`{key}`").alias("key"), value.alias("text")).join(F.broadcast(chosen), "key")
    # Of rows that share an id one is enough, which bounds the sample.
    rows = texts.filter(F.octet_length("text") <= SAMPLE_BYTES).groupBy("key").agg(F.min(F.struct("text", "label")).alias("row"))
    rows = rows.select("key", "row.text", "row.label").orderBy("key").toArrow()
    powers, parts, offset = rolling.Powers(), [], 0
    label_of = rows.column("label").to_numpy().astype(float)
    for first, _, data, starts in rolling.chunks(rows.column("text").combine_chunks()):
        if len(data):
            row, _, figures = line_figures(data, starts, powers)
            parts.append((row + first, figures))
    row = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    if not len(row):
        return None
    features = with_neighbours(row, np.concatenate([p[1] for p in parts]))
    return fit(features, row, label_of[row], float(label_of.mean()))


def quality_scores(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", limit: float = LIMIT) -> DataFrame:
    """``key, held_out, score, predicted`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{key}`").alias("key"), held_out(key).alias("held_out"), whole_text(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = rolling.Powers()
        for batch in batches:
            parts = [scores(shared.value, data, starts, powers) for _, _, data, starts in rolling.chunks(batch.column("text"))]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("held_out"), pa.array(score, pa.float64())], names=["key", "held_out", "score"]
            )

    schema = t.StructType([
        t.StructField("key", rows.schema["key"].dataType), t.StructField("held_out", t.BooleanType()), t.StructField("score", t.DoubleType())
    ])
    scored = rows.mapInArrow(run, schema)
    return scored.select(F.col("key").alias(key), "held_out", "score", (F.col("score") >= limit).cast("int").alias("predicted"))
