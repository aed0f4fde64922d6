"""Near duplicates and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recueil.llm import components, jaccard, suffix_dedup

SCHEMA = "doc_id BIGINT, text STRING, class STRING, spans INT, n_bytes STRING, source STRING"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    """Rows with further columns whose names clash with results."""
    return spark.createDataFrame([(i, x, "c", 1, "n", None) for i, x in rows], SCHEMA)


def some_texts():
    dice = random.Random(5)
    words = [f"{a}{b}" for a in ("ba", "Ko", "ré", "ti", "lu") for b in ("na", "so", "mi", "ß", "dor")]

    def prose(n):
        return [dice.choice(words) + dice.choice(words) for _ in range(n)]

    base = [prose(dice.choice([3, 5, 8, 60, 200, 400])) for _ in range(20)]
    passage = prose(70)
    texts = [" ".join(x) for x in base] + [" ".join(base[3]), " ".join(base[3]).upper()]
    for i in range(30):  # near copies, some near the limit
        near = list(base[5 + i % 3])
        for _ in range(dice.randint(0, max(1, len(near) // 40))):
            near[dice.randrange(len(near))] = "x" + str(dice.random())
        texts.append(" ".join(near))
    texts += [" ".join([*prose(30), *passage, *prose(40)]) for _ in range(5)]
    texts += ["ab " * 400, "ab " * 300 + "tail", "é" * 450, "x" + "é" * 450, "", " \n\t", None, "one", "ONE", "one\x0btwo three four", " ".join(prose(4000))]
    return list(enumerate(texts)) + [(None, "a null id"), (None, "a null id"), (7, "again the id seven"), (7, "again the id seven")]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    sets = [shingles(x) for _, x in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    lowest = {}
    for (i, _), x in zip(rows, label, strict=True):
        if i is not None:
            lowest[x] = min(lowest.get(x, i), i)
    return Counter((i, len(s), lowest.get(x) if s else i) for (i, _), s, x in zip(rows, sets, label, strict=True))


def brute_repeats(rows, size=400):
    texts = [(x or "").encode() for _, x in rows]
    count = Counter(t[p : p + size] for t in texts for p in range(len(t) - size + 1))
    out = Counter()
    for (i, _), t in zip(rows, texts, strict=True):
        mask = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - size + 1):
            if count[t[p : p + size]] > 1:
                mask[p : p + size] = True
        starts = int((mask[1:] & ~mask[:-1]).sum() + mask[0])
        kept = bytes(b for b, gone in zip(t, mask, strict=False) if not gone)
        out[i, len(t), int(mask.sum()), starts, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("tile", [1000, 3])
def test_components_are_those_of_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "MANY", 4)
    rows = some_texts()
    found = jaccard.jaccard_join(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, found)) == brute_components(rows)


def test_one_of_each_component_stays(spark):
    rows = some_texts()
    kept = Counter((r["doc_id"], r["text"]) for r in jaccard.one_of_each(frame(spark, rows)).collect())
    groups = brute_components(rows)
    assert sum(1 for (_, n, c) in {(0, n, c) for _, n, c in groups if n}) <= sum(kept.values())
    assert (None, "a null id") in kept and max(kept.values()) == 1
    assert {x for _, x in kept} >= {"", " \n\t", None}
    assert jaccard.one_of_each(frame(spark, rows)).columns == frame(spark, rows).columns


def test_bit_counts_bound_the_overlap():
    dice = np.random.default_rng(1)
    for n, m in ((5, 6), (300, 260), (4000, 4100)):
        a = np.unique(dice.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], dice.integers(0, 1 << 63, m - n // 2).astype(np.uint64)]))
        x, y = jaccard.bitmap(a), jaccard.bitmap(b)
        size = min(len(x), len(y))
        bound = jaccard.overlap_bound(len(a), jaccard.folded(x, size), np.array([len(b)]), jaccard.folded(y, size)[None])
        assert bound[0] >= len(np.intersect1d(a, b))


@pytest.mark.parametrize("surroundings", [1000, 1])
def test_repeats_are_those_of_brute_force(spark, surroundings):
    rows = some_texts()
    done = suffix_dedup.without_repeats(frame(spark, rows), surroundings=surroundings)
    found = done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256), "kept_sha256").collect()
    assert all(r[4] == r[5] for r in found)
    assert Counter(tuple(r)[:5] for r in found) == brute_repeats(rows)


def test_shorter_passages_can_be_removed(spark):
    rows = some_texts()
    found = suffix_dedup.without_repeats(frame(spark, rows), length=60).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, found)) == brute_repeats(rows, 60)


def test_a_hash_collision_removes_nothing(spark, monkeypatch):
    class Same(suffix_dedup._Suffixes):
        def same(self, x, y):
            return np.ones(len(x), bool)

    monkeypatch.setattr(suffix_dedup, "_Suffixes", Same)
    one, two = bytes(range(32, 112)) * 6, bytes(range(33, 113)) * 6
    flags = suffix_dedup.repeated_windows(
        np.array([0, 0, 0]), np.array([5, 5, 5]), np.array([4, 4, 4]), [one[:404], two[:404], one[:404]], suffix_dedup.rolling.Powers()
    )
    assert flags.tolist() == [True] * 5 + [False] * 5 + [True] * 5


def test_suffixes_sort_like_bytes():
    dice = random.Random(3)
    data = np.frombuffer(bytes(dice.choice(b"ab") for _ in range(900)), np.uint8)
    suffixes = suffix_dedup._Suffixes(data, suffix_dedup.rolling.Powers())
    at = np.array(dice.sample(range(500), 77) + dice.sample(range(500), 20))
    begin, size = np.repeat([0, 77], [77, 20]), np.repeat([77, 20], [77, 20])
    raw, got = data.tobytes(), suffixes.sort(at, begin, size)
    for a, b in ((0, 77), (77, 97)):
        assert [raw[i : i + 400] for i in got[a:b]] == sorted(raw[i : i + 400] for i in at[a:b])


def test_cut_characters_go(spark):
    rows = some_texts()
    done = {r["text"] for r in suffix_dedup.repeats_removed(frame(spark, rows)).collect()}
    assert "é" * 450 not in done and all("\ufffd" not in (x or "") for x in done)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert jaccard.jaccard_join(none).count() == 0
    assert jaccard.one_of_each(none).count() == 0
    assert suffix_dedup.without_repeats(none).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    found = components.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT"))
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}
