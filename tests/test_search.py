import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from recueil.operators import evaluate as V
from recueil.operators import search as S
from recueil.plans import corpus
from recueil.sources import tables

SCHEMA = "vec_id long, embedding array<float>"


def frame(spark, matrix, first=0, schema=SCHEMA):
    return spark.createDataFrame([(first + i, [float(x) for x in v]) for i, v in enumerate(matrix)], schema)


@pytest.fixture(scope="module")
def matrix():
    return np.random.default_rng(42).random((60, 16)).astype(np.float32)


@pytest.fixture(scope="module")
def vectors(spark, matrix):
    return frame(spark, matrix).repartition(3).cache()


@pytest.fixture(scope="module")
def questions(spark, matrix):
    return frame(spark, matrix[:20] + 0.01, schema="query_id long, embedding array<float>").cache()


def brute(matrix, asked, k, metric="l2"):
    a, b = asked.astype(np.float64), matrix.astype(np.float64)
    d = ((a[:, None] - b[None]) ** 2).sum(2) if metric == "l2" else -(a @ b.T)
    return {(q, r + 1, int(v)) for q, row in enumerate(np.argsort(d, axis=1, kind="stable")[:, :k]) for r, v in enumerate(row)}


def hits(df):
    return {(r["query_id"], r["rank"], r["vec_id"]) for r in df.collect()}


@pytest.mark.parametrize("method, metric", [("flat_l2", "l2"), ("flat_ip", "ip")])
@pytest.mark.parametrize("limit", [S.QUESTION_LIMIT, 1500])
def test_exact_search_equals_brute_force(vectors, questions, matrix, method, metric, limit):
    found = S.build_index(vectors, method).search(questions, 5, question_limit=limit)
    assert hits(found) == brute(matrix, matrix[:20] + np.float32(0.01), 5, metric)


@pytest.mark.parametrize("limit", [S.QUESTION_LIMIT, 1500])
@pytest.mark.parametrize("method", ["ivf", "lsh"])
def test_approximate_search_can_be_exhaustive(vectors, questions, matrix, method, limit):
    # One huge bucket per table, or every cell probed, is exact search.
    index = S.build_index(vectors, method, bucket_length=1e6, tables=3)
    assert hits(index.search(questions, 5, nprobe=100, question_limit=limit)) == brute(matrix, matrix[:20] + np.float32(0.01), 5)


def test_hashed_search_probes_neighbouring_buckets(vectors, questions, matrix):
    index = S.build_index(vectors, "lsh", bucket_length=0.3, tables=2)
    exact = S.build_index(vectors).search(questions, 5)
    recall = [V.recall_against(index.search(questions, 5, nprobe=n), exact).first()["recall"] for n in (1, 2, 4, 30)]
    assert recall == sorted(recall) and recall[0] < recall[2] and recall[3] == 1.0
    places = S.Projections(2, 1, 1.0, 1)
    places.directions = np.array([[1.0], [0.0]])
    assert places.nearest(np.array([[2.3, 9], [-0.2, 9]]), 4).tolist() == [[[2, 1, 3, 0]], [[-1, 0, -2, 1]]]


def test_vectors_are_not_copied_for_many_questions(spark, matrix, path, questions):
    """A wave scans the vectors in place: nothing but hits is exploded or shuffled."""
    frame(spark, matrix).write.parquet(f"{path}/vectors")
    vectors = spark.read.parquet(f"{path}/vectors")
    index = S.build_index(vectors)
    wave = S._Wave(questions.withColumn("cells", F.array(F.lit(0).cast("bigint"))).toArrow(), 16)
    types = S.t.StructType([S.t.StructField("query_id", S.t.LongType()), S.t.StructField("vec_id", S.t.LongType()), S.t.StructField("distance", S.t.DoubleType())])
    schema = S.pa.schema([("query_id", S.pa.int64()), ("vec_id", S.pa.int64()), ("distance", S.pa.float64())])
    sent = vectors.sparkSession.sparkContext.broadcast(wave)
    one = S._wave_hits(wave, sent, index.vectors.withColumn("cell", F.lit(0).cast("bigint")), None, 5, "l2", schema, types)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan and "Join" not in plan


def test_recall_grows_with_probes(vectors, questions):
    exact = S.build_index(vectors).search(questions, 5)
    index = S.build_index(vectors, "ivf", nlist=6)
    recall = [V.recall_against(index.search(questions, 5, nprobe=n), exact).first()["recall"] for n in (1, 3, 6)]
    assert recall[0] <= recall[1] <= recall[2] == 1.0 and recall[0] > 0.3


def test_self_search(vectors, matrix, spark):
    own = frame(spark, matrix, schema="query_id long, embedding array<float>")
    rows = S.build_index(vectors).search_with_metadata(own, 5).collect()
    first = [r for r in rows if r["rank"] == 1]
    assert all(r["query_id"] == r["vec_id"] and r["distance"] == 0.0 and r["score"] == 1.0 for r in first) and len(first) == 60
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_more_hits_wanted_than_vectors(spark):
    index = S.build_index(frame(spark, [[0, 0], [1, 1]]))
    assert index.search(frame(spark, [[0, 0]], schema="query_id long, embedding array<float>"), 5).count() == 2


@pytest.mark.parametrize("limit", [S.QUESTION_LIMIT, 80])
def test_copies_tie_by_id(spark, limit):
    """A third and more of the vectors are one and the same."""
    copies = spark.range(3000).select((F.lit(5000) - F.col("id")).alias("vec_id"), F.array(F.lit(0.5), F.lit(0.5)).cast("array<float>").alias("embedding"))
    others = frame(spark, np.random.default_rng(1).random((400, 2)) + 5, 10_000)
    asked = frame(spark, [[0.5, 0.5], [0.4, 0.5], [5.5, 5.5]], schema="query_id long, embedding array<float>")
    found = S.build_index(copies.union(others)).search(asked, 4, question_limit=limit).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found if r["query_id"] < 2) == [
        (q, r, 2000 + r) for q in (0, 1) for r in (1, 2, 3, 4)
    ]
    assert all(r["vec_id"] >= 10_000 for r in found if r["query_id"] == 2)


def test_text_ids(spark, matrix):
    named = frame(spark, matrix).select(F.format_string("v%03d", "vec_id").alias("vec_id"), "embedding")
    asked = frame(spark, matrix[:4]).select(F.col("vec_id").cast("string").alias("query_id"), "embedding")
    found = S.build_index(named).search(asked, 2).collect()
    assert {(r["query_id"], r["vec_id"]) for r in found if r["rank"] == 1} == {(str(i), f"v{i:03d}") for i in range(4)}


def test_failed_embeddings_are_no_points(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0], "boom"), (2, [1.0, 1.0], None), (3, None, "boom")], SCHEMA + ", embed_error string")
    index = S.build_index(df)
    asked = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], "query_id long, embedding array<float>")
    assert hits(index.search(asked, 5)) == {(1, 1, 2)}


def test_wrong_arguments(spark, vectors, questions):
    with pytest.raises(ValueError, match="unknown index method"):
        S.build_index(vectors, "flat")
    with pytest.raises(ValueError, match="dimension"):
        S.build_index(vectors, dimension=8)
    with pytest.raises(ValueError, match="empty"):
        S.build_index(vectors.limit(0))
    with pytest.raises(ValueError, match="at least 1"):
        S.build_index(vectors).search(questions, 0)
    short = frame(spark, [[1.0, 2.0]], schema="query_id long, embedding array<float>")
    with pytest.raises(ValueError, match="dimension"):
        S.build_index(vectors).search(short)
    mixed = frame(spark, [[1.0, 2.0], [1.0, 2.0, 3.0]])
    with pytest.raises(ValueError, match="dimensions from 2 to 3"):
        S.dimension_of(mixed)
    with pytest.raises(PythonException, match="dimension"):
        S.build_index(mixed.coalesce(1)).search(short).collect()


def test_adding_vectors(spark, vectors, matrix, questions):
    head, tail = vectors.filter("vec_id < 40"), vectors.filter("vec_id >= 40")
    assert hits(S.build_index(head).add(tail).search(questions, 5)) == brute(matrix, matrix[:20] + np.float32(0.01), 5)
    grown = S.build_index(head, "ivf", nlist=4).add(tail)
    assert hits(grown.search(questions, 5, nprobe=4)) == brute(matrix, matrix[:20] + np.float32(0.01), 5)
    with pytest.raises(ValueError, match="dimension"):
        S.build_index(head).add(frame(spark, [[1.0]], 99))
    index = S.build_index(head, metadata=head.select("vec_id"))
    with pytest.raises(ValueError, match="metadata"):
        index.add(tail, tail.select("vec_id").limit(3))
    grown = index.add(tail, tail.select("vec_id"))
    assert grown.is_coherent() and grown.stats().first()["nombre_vecteurs"] == 60


def test_coherence(vectors):
    assert S.build_index(vectors).stats().first()["coherent"] is None
    with pytest.raises(ValueError):
        S.build_index(vectors).is_coherent()
    less = S.build_index(vectors, metadata=vectors.filter("vec_id > 0").select("vec_id"))
    assert not less.is_coherent()
    row = less.stats().first()
    assert (row["dimension"], row["nombre_vecteurs"], row["nb_metadata"], row["coherent"], row["is_trained"]) == (16, 60, 59, False, True)


def test_hits_without_metadata_are_dropped(vectors, questions):
    index = S.build_index(vectors, metadata=vectors.filter("vec_id < 10").select("vec_id", F.lit("x").alias("titre")))
    assert all(r["vec_id"] < 10 for r in index.search_with_metadata(questions, 5).collect())


@pytest.mark.parametrize("method", S.METHODS)
def test_saved_index(spark, vectors, questions, path, method):
    index = S.build_index(vectors, method, metadata=vectors.select("vec_id", F.lit("t").alias("titre")), bucket_length=0.5)
    tables.save_index(index, f"{path}/ix")
    loaded = tables.load_index(spark, f"{path}/ix")
    assert hits(loaded.search(questions, 3, nprobe=2)) == hits(index.search(questions, 3, nprobe=2))
    assert spark.read.json(f"{path}/ix/stats").first()["nb_metadata"] == 60
    if method == "ivf":
        plan = loaded.search(questions.limit(1), 3)._jdf.queryExecution().toString()
        assert "PartitionFilters: [" in plan and "cell" in plan[plan.index("PartitionFilters: [") :][:200]


@pytest.mark.parametrize("method", ["flat_l2", "ivf", "lsh"])
def test_an_append_that_fails_leaves_the_index_as_it_was(spark, vectors, questions, path, method, monkeypatch):
    head, tail = vectors.filter("vec_id < 40"), vectors.filter("vec_id >= 40")
    titled = lambda df: df.select("vec_id", F.lit("t").alias("titre"))
    tables.save_index(S.build_index(head, method, metadata=titled(head), nlist=4, bucket_length=1e6, tables=2), f"{path}/ix")
    before = hits(tables.load_index(spark, f"{path}/ix").search(questions, 5, nprobe=4))
    with monkeypatch.context() as broken:
        # The vectors of the part are there, its entry is not.
        broken.setattr(tables, "_commit_index", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.append_to_index(spark, f"{path}/ix", tail.limit(3), titled(tail.limit(3)))
    assert hits(tables.load_index(spark, f"{path}/ix").search(questions, 5, nprobe=4)) == before
    tables.append_to_index(spark, f"{path}/ix", tail, titled(tail))
    grown = tables.load_index(spark, f"{path}/ix")
    assert grown.is_coherent() and grown.stats().first()["nombre_vecteurs"] == 60
    assert hits(grown.search(questions, 5, nprobe=4)) == brute(np.array([r["embedding"] for r in vectors.orderBy("vec_id").collect()], np.float32), np.array([r["embedding"] for r in questions.orderBy("query_id").collect()], np.float32), 5)
    assert hits(tables.load_index(spark, f"{path}/ix", entry=1).search(questions, 5, nprobe=4)) == before
    with pytest.raises(FileNotFoundError):
        tables.load_index(spark, f"{path}/ix", entry=9)


def test_default_cells():
    assert [S.default_nlist(n) for n in (0, 9, 10, 405, 10_000, 10**10)] == [1, 1, 1, 40, 100, 10**5]


def test_centroids_in_blocks_give_the_same_cells(vectors, monkeypatch):
    index = S.build_index(vectors, "ivf", nlist=4)

    def cells():
        return {r["vec_id"]: r["cells"] for r in S.nearest_cells(vectors, index.centroids, 3).collect()}

    whole = cells()
    assert all(len(x) == 3 for x in whole.values())
    for limit in (1, 8 * 2 * index.dimension):
        monkeypatch.setattr(S, "CENTROID_LIMIT", limit)
        assert cells() == whole


def test_hits_are_broadcast_to_the_metadata(vectors):
    index = S.build_index(vectors)
    found = index.search_with_metadata(vectors.limit(2).select(S.F.col("vec_id").alias("query_id"), "embedding"), 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and found.count() == 6


def test_the_published_index_is_the_one_in_use(spark, vectors, questions, path):
    with pytest.raises(FileNotFoundError):
        corpus.published_index(spark, path)
    for version, rows in (("0001", "vec_id < 30"), ("0002", "vec_id < 60")):
        tables.save_index(S.build_index(vectors.filter(rows)), f"{path}/vectorstore/versions/{version}")
    corpus.publish(spark, path, "0001")
    assert corpus.published_index(spark, path).vectors.count() == 30
    with pytest.raises(Exception):
        corpus.publish(spark, path, "0003")
    assert corpus.published_index(spark, path).vectors.count() == 30
    corpus.publish(spark, path, "0002")
    assert corpus.published_index(spark, path).vectors.count() == 60


def test_full_probe_sends_no_lists_of_cells(vectors, questions, matrix, monkeypatch):
    """Questions that probe every cell need not say which."""
    waves, hits_of = [], S._wave_hits
    monkeypatch.setattr(S, "_wave_hits", lambda wave, *rest: (waves.append(wave), hits_of(wave, *rest))[1])
    index = S.build_index(vectors, "ivf", nlist=5)
    assert hits(index.search(questions, 5, nprobe=5)) == brute(matrix, matrix[:20] + np.float32(0.01), 5)
    assert [w.probing for w in waves] == [None]
    index.search(questions, 5, nprobe=2).collect()
    assert sum(len(x) for x in waves[1].probing.values()) == 40


def test_cells_count_as_bytes_of_a_question(vectors, questions, monkeypatch):
    waves, hits_of = [], S._wave_hits
    monkeypatch.setattr(S, "_wave_hits", lambda wave, *rest: (waves.append(len(wave.ids)), hits_of(wave, *rest))[1])
    S.build_index(vectors, "ivf", nlist=20).search(questions, 5, nprobe=19, question_limit=20 * (8 * 16 + 64)).collect()
    assert sum(waves) == 20 and len(waves) > 1


def test_small_waves_share_a_job(vectors, questions, matrix, monkeypatch):
    ranked, rank = [], S._ranked
    monkeypatch.setattr(S, "_ranked", lambda *rest: (ranked.append(1), rank(*rest))[1])
    found = S.build_index(vectors).search(questions, 5, question_limit=600)
    assert hits(found) == brute(matrix, matrix[:20] + np.float32(0.01), 5) and len(ranked) == 1


@pytest.mark.parametrize("method, how", [("flat_l2", {}), ("flat_ip", {}), ("ivf", {"nprobe": 3}), ("ivf", {"nprobe": 100}), ("lsh", {"nprobe": 2})])
def test_large_question_tables_do_not_pass_the_driver(spark, vectors, questions, matrix, monkeypatch, method, how):
    """Pairs of stored blocks give the hits that one wave gives, also where questions come twice."""
    index = S.build_index(vectors, method, nlist=6, bucket_length=0.5, tables=3)
    asked = questions.union(questions)
    expected = hits(index.search(asked, 5, **how))

    def refused(*rest):
        raise AssertionError("questions passed the driver")

    monkeypatch.setattr(S, "QUESTION_LIMIT", 1500)
    monkeypatch.setattr(S, "VECTOR_LIMIT", 4000)
    monkeypatch.setattr(S, "_wave_hits", refused)
    found = index.search(asked, 5, question_limit=1500, **how)
    assert hits(found) == expected and found.count() == len(expected)
    if method == "flat_l2":  # a vector that is there twice is found once
        twice = S.build_index(vectors.union(vectors)).search(asked, 5, question_limit=1500)
        assert hits(twice) == expected and twice.count() == len(expected)


def test_recall_does_not_broadcast_the_hits(vectors, questions):
    exact = S.build_index(vectors).search(questions, 5)
    plan = V.recall_against(exact, exact)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
