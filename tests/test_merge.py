import json
import random

import pytest
from pyspark.sql import functions as F

from recueil.operators import merge as M


def table(spark, rows, start=0):
    df = spark.createDataFrame([(start + i, p) for i, p in enumerate(rows)], "seq long, payload string")
    return M.with_key_and_digest(df)


def simulate(existing, incoming):
    """One row at a time, in order."""
    key = lambda p: json.loads(p).get("uid")
    at = {key(p): i for i, p in enumerate(existing) if key(p)}
    state, added, updated, same = list(existing), 0, 0, 0
    for p in incoming:
        uid = key(p)
        if not uid or uid not in at:
            if uid:
                at[uid] = len(state)
            state.append(p)
            added += 1
        elif json.loads(state[at[uid]]) == json.loads(p):
            same += 1
        else:
            state[at[uid]] = p
            updated += 1
    return state, (len(incoming), len(existing), len(state), added, updated, same)


@pytest.mark.parametrize("seed", range(6))
def test_merge_equals_one_row_at_a_time(spark, seed, monkeypatch):
    monkeypatch.setattr(M, "_RUN_BITS", 1)
    draw = random.Random(seed)

    def row():
        items = [("uid", draw.choice([None, "", "hot", "hot", "hot", "a", "b", "c"])), ("v", draw.choice([1, 2, 1.0])), ("z", [1, 2])]
        draw.shuffle(items)
        return json.dumps(dict(items))

    old = [row() for _ in range(draw.randint(0, 12))]
    new = [row() for _ in range(draw.randint(1, 30))]
    a, b = table(spark, old), table(spark, new, len(old))
    state, report = simulate(old, new)
    merged = [json.loads(r["payload"]) for r in M.merge(a, b).orderBy("pos").collect()]
    assert merged == [json.loads(p) for p in state]
    assert tuple(M.merge_report(a, b).first()) == report


def test_replay_changes_nothing(spark):
    rows = [json.dumps({"uid": i, "v": i}) for i in range(1, 298)]
    a, b = table(spark, rows), table(spark, rows, 1000)
    assert tuple(M.merge_report(a, b).first()) == (297, 297, 297, 0, 0, 297)
    assert M.delta(a, b).isEmpty()


def test_keyless_by_content(spark):
    rows = ['{"v": 1}', '{"v": 1.0}', '{"v": 2}']
    a, b = table(spark, rows[:1]), table(spark, rows, 10)
    assert M.merge(a, b).count() == 4
    assert M.merge(a, b, keyless="content_hash").count() == 2
    assert tuple(M.merge_counts(a, b, "content_hash").first()) == (3, 1, 0, 2)
    with pytest.raises(ValueError):
        M.merge(a, b, keyless="other")


def test_replayed_journal(spark):
    rows = [("1", "a"), ("1", "a"), ("1", "b"), ("2", "a"), ("2", "b"), (None, "a"), (None, "a")]
    days = [1, 1, 1, 2, 2, 2, 2]
    df = spark.createDataFrame([(u, i, p, p.encode(), d) for i, ((u, p), d) in enumerate(zip(rows, days))],
                               "uid string, pos long, payload string, digest binary, day int")
    found = [tuple(r[c] for c in ("horodatage", "nb_nouveaux", "nb_avant_fusion", "nb_apres_fusion", "nb_ajoutes", "nb_mis_a_jour", "nb_doublons"))
             for r in M.replayed_journal(df, "day").orderBy("horodatage").collect()]
    assert found == [(1, 3, 0, 1, 1, 1, 1), (2, 4, 1, 4, 3, 1, 0)]


def test_without_vector(spark):
    events = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, texte_complet string")
    vectors = spark.createDataFrame([("1", "a"), ("2", "old")], "id string, t string").select(
        "id", F.sha2("t", 256).alias("text_digest")
    )
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(M.without_vector(events, vectors)) == [3]
    assert ids(M.without_vector(events, vectors, "changed")) == [2, 3]
    with pytest.raises(ValueError):
        M.without_vector(events, vectors, "all")


def test_vector_tables(spark):
    old = spark.createDataFrame([("1", 1), ("2", 2)], "id string, v int")
    new = spark.createDataFrame([("2", 20), ("3", 30)], "id string, v int")
    pairs = lambda df: sorted((r["id"], r["v"]) for r in df.collect())
    assert pairs(M.append_vectors(None, new)) == [("2", 20), ("3", 30)]
    assert pairs(M.append_vectors(old, new)) == [("1", 1), ("2", 2), ("3", 30)]
    assert pairs(M.append_vectors(old, old)) == pairs(old)
    assert pairs(M.replace_vectors(old, new)) == [("1", 1), ("2", 20), ("3", 30)]
    assert [tuple(r) for r in M.unmatched_keys(old, new, "id").orderBy("id").collect()] == [("1", 1, 0), ("3", 0, 1)]
