"""The distance kernel alone, against brute force."""

import numpy as np
import pytest

from recueil.operators import search as S


def run(questions, vectors, ids, k, metric="l2", batch=50):
    best = S._Best(np.asarray(questions, float), k, metric)
    for i in range(0, len(vectors), batch):
        best.add(np.arange(len(questions)), np.asarray(vectors[i : i + batch], float), ids[i : i + batch])
    best.flush()
    return [(int(r), i) for r, i in zip(best.row, best.id)]


def brute(questions, vectors, ids, k, metric="l2"):
    q, v = np.asarray(questions, float), np.asarray(vectors, float)
    d = ((q[:, None] - v[None]) ** 2).sum(2) if metric == "l2" else -(q[:, None] * v[None]).sum(2)
    return [(row, ids[j]) for row in range(len(q)) for j in np.lexsort((ids, d[row]))[:k]]


@pytest.mark.parametrize("scale", [1e-20, 1.0, 1e6, 1e18])
@pytest.mark.parametrize("metric", ["l2", "ip"])
def test_random(scale, metric):
    rng = np.random.default_rng(3)
    v, q = rng.normal(size=(400, 12)) * scale, rng.normal(size=(30, 12)) * scale
    ids = rng.permutation(400)
    assert run(q, v, ids, 7, metric) == brute(q, v, ids, 7, metric)


def test_far_from_the_origin():
    """Differences below the preselection's precision must still count."""
    rng = np.random.default_rng(4)
    v = 1000 + rng.normal(size=(500, 8)) * 1e-3
    assert run(v[:20], v, np.arange(500), 5) == brute(v[:20], v, np.arange(500), 5)


@pytest.mark.parametrize("batch", [10, 1000])
def test_many_copies_in_falling_distance(batch):
    rng = np.random.default_rng(5)
    distinct = rng.normal(size=(40, 4))
    v = np.concatenate([np.repeat(distinct, 20, axis=0), np.zeros((900, 4))])
    v = v[np.argsort(-(v**2).sum(1), kind="stable")]
    ids = rng.permutation(len(v))
    q = np.concatenate([np.zeros((50, 4)), distinct])
    assert run(q, v, ids, 6, batch=batch) == brute(q, v, ids, 6)


def test_copies_when_hashes_collide(monkeypatch):
    class Zeros:
        def integers(self, low, high, size, dtype):
            return np.zeros(size, dtype)

    rng = np.random.default_rng(6)
    v = np.repeat(rng.normal(size=(3, 2)), 400, axis=0)
    v[400:800] = v[0][::-1]
    ids = rng.permutation(1200)
    with monkeypatch.context() as m:
        m.setattr(S.np.random, "default_rng", lambda seed: Zeros())
        found = run(v[:1], v, ids, 5, batch=1200)
    assert found == brute(v[:1], v, ids, 5)


def test_a_vector_met_twice_counts_once():
    v, ids = np.eye(4), np.arange(4)
    assert run(v[:2], np.concatenate([v, v]), np.concatenate([ids, ids]), 3, batch=4) == brute(v[:2], v, ids, 3)


def test_text_ids_tie_in_order():
    ids = np.array(["b", "a", "c"], dtype=object)
    assert [i for _, i in run([[0.0]], [[1.0], [1.0], [1.0]], ids, 2)] == ["a", "b"]


def test_a_broken_vector_costs_only_itself(spark):
    import random

    from recueil.operators.search import build_index

    dice = random.Random(4)
    rows = [(i, [dice.random() for _ in range(4)]) for i in range(60)]
    rows[7] = (7, [float("nan")] * 4)
    rows[8] = (8, [1.0, None, 1.0, 1.0])
    vectors = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")
    asked = vectors.filter("vec_id < 5").withColumnRenamed("vec_id", "query_id")
    hits = build_index(vectors).search(asked, 3).collect()
    assert len(hits) == 15 and not {r["vec_id"] for r in hits} & {7, 8}


@pytest.mark.parametrize("questions", [3, 30])
def test_marked_questions_alone(questions):
    """Every vector meets the questions whose bit is set, and no others."""
    rng = np.random.default_rng(7)
    v, q, ids = rng.normal(size=(200, 6)), rng.normal(size=(questions, 6)), rng.permutation(200)
    mark = rng.random((200, questions)) < 0.4
    best = S._Best(q.astype(np.float32), 4, "l2")
    for i in range(0, 200, 50):
        best.add_marked(np.packbits(mark[i : i + 50], axis=1, bitorder="little"), v[i : i + 50], ids[i : i + 50])
    best.flush()
    d = ((q.astype(np.float32).astype(float)[:, None] - v[None]) ** 2).sum(2)
    d[~mark.T] = np.inf
    wanted = [(row, ids[j]) for row in range(questions) for j in np.lexsort((ids, d[row]))[:4]]
    assert [(int(r), i) for r, i in zip(best.row, best.id)] == wanted


def test_candidates_of_many_questions_are_ranked_on_the_way(monkeypatch):
    """What waits to be ranked is bounded, however many questions a batch meets."""
    rng, waiting = np.random.default_rng(8), []
    merge = S._Best._merge
    monkeypatch.setattr(S, "_BLOCK_CELLS", 1 << 14)
    monkeypatch.setattr(S._Best, "_merge", lambda self, row, *rest: (waiting.append(len(row)), merge(self, row, *rest))[1])
    q, v = rng.normal(size=(2000, 4)), rng.normal(size=(300, 4))
    assert run(q, v, np.arange(300), 3, batch=300) == brute(q, v, np.arange(300), 3)
    assert max(waiting) < 2000


def test_cells_at_once_find_the_same():
    """Cells that all questions probe are compared together once limits are known."""
    rng = np.random.default_rng(9)
    v, q = rng.normal(size=(600, 5)), rng.normal(size=(40, 5))
    best = S._Best(q, 4, "l2")
    assert not best.add_near(v[:200], np.arange(200))
    best.add(np.arange(40), v[:200], np.arange(200))
    best.flush()
    assert best.add_near(v[200:], np.arange(200, 600))
    best.flush()
    assert [(int(r), i) for r, i in zip(best.row, best.id)] == brute(q, v, np.arange(600), 4)
