"""The stages of the pipeline, one after the other, against brute force."""

import random
import re
from collections import Counter

import corpus_pipeline
import pytest
from recueil.llm import common

WORDS = r"[^\x20\x09-\x0D]+"
COLUMNS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, kept STRING, n_words STRING, size STRING, Digest STRING"


def some_rows():
    dice = random.Random(8)
    words = [a + b + c for a in ("ba", "ko", "re", "ti") for b in ("na", "so", "mi") for c in ("x", "dor", "lin", "u")]

    def prose(n):
        return " ".join(dice.choice(words) + str(dice.randrange(1000)) for _ in range(n))

    passage, item = prose(60), prose(30)
    texts = [prose(dice.randint(60, 160)) for _ in range(24)]
    near = texts[3].split()
    near[len(near) // 2] = "changed"
    texts += [texts[0], " ".join(near), texts[5].upper()]  # copies and near copies
    texts += [f"{prose(50)} {passage} {prose(70)}" for _ in range(3)] + [passage, f"{prose(60)} {item} {prose(20)}"]
    texts += [prose(49), "", None, "a b c " * 100, " \t\n"]
    rows = [(i, x, "fr", dice.choice(["s", "t", None]), len(x or "")) for i, x in enumerate(texts)]
    rows += [(7, texts[7], "fr", "s", len(texts[7]))] * 2  # a row three times, in all
    rows[7] = (7, texts[7], "fr", "s", len(texts[7]))
    rows += [(None, prose(90), None, "t", 0), (None, None, None, None, None)]
    return [(*r, "k", "many", None, "d") for r in rows], item


def good(text):
    words = re.findall(WORDS, text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words) >= 50 and 2 * len(covered) <= len(words)


def shingles(text):
    words = re.findall(WORDS, text.lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, item):
    rows = [r for r in rows if good(r[1])]
    sets, label = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common_ = len(sets[i] & sets[j])
            if 100 * common_ >= 80 * (len(sets[i]) + len(sets[j]) - common_):
                label = [label[j] if x == label[i] else x for x in label]
    first = {}
    for r, x in zip(rows, label, strict=True):
        if x not in first or (r[0] is None, r[0] or 0) < (first[x][0] is None, first[x][0] or 0):
            first[x] = r
    rows = list(first.values())
    size, count = corpus_pipeline.PASSAGE, Counter()
    for r in rows:
        count.update(r[1][p : p + size] for p in range(len(r[1]) - size + 1))
    out = []
    for r in rows:
        gone = [False] * len(r[1])
        for p in range(len(r[1]) - size + 1):
            if count[r[1][p : p + size]] > 1:
                gone[p : p + size] = [True] * size
        text = "".join(c for c, x in zip(r[1], gone, strict=True) if not x)
        if text and item not in text:
            out.append((r[0], text, *r[2:4], len(text), *r[5:]))
    return Counter(out)


@pytest.fixture
def tables(spark, path):
    rows, item = some_rows()
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, "The"), (None, None)], "item_id BIGINT, text STRING").write.parquet(f"{path}/benchmark.parquet")
    return rows, item, path


def test_stages_give_the_rows_of_brute_force(spark, tables, monkeypatch):
    rows, item, path = tables
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "decontamination", "mix_sources"]
    left = []
    real = common.stored

    def noted(df, name):
        if name == "decontamination":
            left.extend(map(tuple, df.collect()))
        return real(df, name)

    monkeypatch.setattr(common, "stored", noted)
    mixed = corpus_pipeline.run(spark, path)
    assert Counter(left) == brute(rows, item)
    # The mix takes whole documents, some of them several times, and leaves some out.
    last = mixed.collect()
    assert {(r["doc_id"], r["text"]) for r in last} <= {x[:2] for x in left} and last
    assert all(r["copies"] >= 1 and r["taken"] == int(r["size"]) * r["copies"] for r in last)


def test_an_empty_corpus(spark, path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id BIGINT, text STRING").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
