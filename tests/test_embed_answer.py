import pytest
from pyspark.sql import functions as F

from recueil.functions import prompts
from recueil.operators import embed as E
from recueil.operators import evaluate as V
from recueil.operators.search import build_index
from recueil.plans import answer as A
from recueil.plans import corpus
from recueil.session import shared_dir
from recueil.sources import tables, versions


def events(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, texte_complet string")


def lengths(texts):
    return [[1.0, float(len(t))] for t in texts], [len(t.split()) for t in texts]


def test_vectors_stay_with_their_rows(spark):
    done = E.embed(events(spark, "a", "bb b", None, "").repartition(2), lengths, batch_size=3).orderBy("id").collect()
    assert [list(r["embedding"]) for r in done] == [[1, 1], [1, 4], [1, 0], [1, 0]]
    assert [r["tokens"] for r in done] == [1, 2, 0, 0] and all(r["embed_error"] is None for r in done)


def test_numbers_and_nan_as_text(spark):
    df = spark.createDataFrame([(1, 1.5), (2, float("nan")), (3, None)], "id int, x double")
    assert [r[0] for r in df.orderBy("id").select(E.clean_text(df, "x")).collect()] == ["1.5", "", ""]
    assert tuple(E.blank_texts(df, "x").first()) == (3, 2)


def test_batches_have_the_asked_size(spark):
    df = events(spark, *["x"] * 25).coalesce(1)
    done = E.embed(df, lambda ts: [[float(len(ts))] for _ in ts], batch_size=10)
    assert sorted(r["embedding"][0] for r in done.collect()) == [5.0] * 5 + [10.0] * 20


def test_retry_then_success(spark, path):
    def flaky(texts):
        import os
        marker = f"{path}/seen"
        if not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("first call")
        return [[1.0] for _ in texts]

    row = E.embed(events(spark, "a").coalesce(1), flaky, backoff=0.0).first()
    assert list(row["embedding"]) == [1.0] and row["embed_error"] is None


def test_failures_are_rows(spark):
    def refuse(texts):
        raise RuntimeError("no service")

    df = events(spark, "x" * 150, "short")
    done = E.embed(df, refuse, attempts=2, backoff=0.0)
    errors = {r["index"]: (r["texte"], r["erreur"]) for r in E.embedding_errors(done, "id").collect()}
    assert errors == {"0": ("x" * 100 + "...", "no service"), "1": ("short", "no service")}
    assert E.embedding_stats(done).first()["errors"] == 2
    with pytest.raises(RuntimeError, match="all 2 texts"):
        E.check_embedded(done)
    zeros = E.embed(df, refuse, attempts=1, zero_dimension=3).first()
    assert list(zeros["embedding"]) == [0, 0, 0] and zeros["embed_error"] == "no service"


def test_wrong_number_of_vectors_is_a_failure(spark):
    row = E.embed(events(spark, "a", "b").coalesce(1), lambda ts: [[1.0]], attempts=1).first()
    assert "1 vectors for 2 texts" in row["embed_error"]


def test_arguments_and_empty_input(spark):
    with pytest.raises(KeyError):
        E.embed(events(spark, "a"), lengths, "missing")
    with pytest.raises(ValueError):
        E.embed(events(spark, "a"), lengths, batch_size=0)
    empty = E.embed(events(spark, "a").limit(0), lengths)
    assert empty.count() == 0 and E.embedding_stats(empty).first()["total_events"] == 0
    E.check_embedded(empty)


def test_hashing_embedder_is_deterministic():
    fn = E.hashing_embedder(32)
    (a, b, c), tokens = fn(["Un concert de jazz", "un CONCERT de jazz", ""])
    assert (a == b).all() and abs(float((a**2).sum()) - 1) < 1e-6 and not c.any() and tokens == [4, 4, 0]


def test_metadata_defaults(spark):
    df = spark.createDataFrame([(None, None, 7), ("a", "T", 8)], "id string, titre string, position long")
    rows = [tuple(r) for r in E.vector_metadata(df, "position").orderBy("index").collect()]
    assert rows == [("7", "", "", "", "", 7), ("a", "T", "", "", "", 8)]


def test_incremental_embedding(spark):
    first = E.embed_new(events(spark, "a", "b"), None, lengths)
    changed = spark.createDataFrame([("0", "a"), ("1", "changed"), ("2", "c")], "id string, texte_complet string")
    new = {r["id"]: r["embedding"][1] for r in E.embed_new(changed, first, lengths).collect()}
    assert new == {"0": 1.0, "1": 1.0, "2": 1.0}
    fresh = {r["id"]: r["embedding"][1] for r in E.embed_new(changed, first, lengths, reembed="changed").collect()}
    assert fresh == {"0": 1.0, "1": 7.0, "2": 1.0}


@pytest.fixture(scope="module")
def index(spark):
    rows = [("1", "Visite du Carillon Bollée", "Le carillon", "Châtellerault"), ("2", "Concert de jazz", "Musique", "Paris")]
    clean = spark.createDataFrame(rows, "id string, titre string, description string, ville string")
    clean = clean.withColumns({
        "adresse": F.lit(""), "categories": F.lit("x"), "date_debut": F.lit("2026-04-01"), "date_fin": F.lit(None).cast("string"),
        "texte_complet": F.concat_ws(" ", "titre", "description", "ville"),
    })
    return build_index(corpus.as_index_input(E.embed(clean, E.hashing_embedder(64))), dimension=64)


def test_questions_end_to_end(spark, index):
    asked = spark.createDataFrame([(1, "carillon Bollée"), (2, "jazz à Paris"), (3, "  "), (4, " QUIT ")], "query_id long, question string")
    echo = lambda ps: [p.split("Titre: ")[1].split("\n")[0] for p in ps]
    options = A.AnswerOptions(k=1, model="echo")
    rows = A.answer(asked, index, E.hashing_embedder(64), echo, options).orderBy("query_id").collect()
    assert [(r["query_id"], r["answer"], r["nb_events_retrieved"], r["nb_events_used"]) for r in rows] == [
        (1, "Visite du Carillon Bollée", 1, 1), (2, "Concert de jazz", 1, 1)
    ]
    assert rows[0]["model"] == "echo" and rows[0]["temperature"] == 0.3
    assert rows[0]["source_events"][0]["titre"] == "Visite du Carillon Bollée"
    bare = A.answer(asked, index, E.hashing_embedder(64), echo, A.AnswerOptions(return_sources=False, prompt="grounded"))
    assert "source_events" not in bare.columns
    with pytest.raises(ValueError):
        A.answer(asked, index, E.hashing_embedder(64), echo, A.AnswerOptions(prompt="other"))


def test_timed_answers(spark, index):
    asked = spark.createDataFrame([(1, "carillon")], "query_id long, question string")
    row = A.timed_answer(asked, index, E.hashing_embedder(64), lambda ps: ["ok"] * len(ps)).first()
    timing = row["timing"]
    assert row["nb_events_retrieved"] == 2 and timing["total_ms"] >= timing["retrieval_ms"] > 0


def test_prompts_without_hits(spark, index):
    questions = spark.createDataFrame([(9, "rien ?")], "query_id long, question string")
    none = A.retrieve(questions.withColumn("embedding", F.lit(None).cast("array<float>")), index, 5)
    full = A.grounded_prompts(questions, none).first()
    assert prompts.NO_EVENT in full["prompt"] and full["nb_events_retrieved"] == 0
    assert A.simple_prompts(questions, none).first()["prompt"] == "Question: rien ?\n\nAucun événement pertinent trouvé."


def test_documents(spark, index):
    asked = E.embed(spark.createDataFrame([(1, "jazz")], "query_id long, question string"), E.hashing_embedder(64), "question")
    rows = A.hit_documents(A.retrieve(asked, index, 1)).collect()
    assert rows[0]["page_content"] == "Titre: Concert de jazz\nDescription: Musique\nVille: Paris\nDate de début: 2026-04-01\nCatégorie: x"
    assert rows[0]["metadata"]["vec_id"] == "2" and 0 < rows[0]["metadata"]["similarity_score"] <= 1


def test_generation_must_answer_every_prompt(spark):
    df = spark.createDataFrame([("a",), ("b",)], "prompt string").coalesce(1)
    rows = A.generate(df, lambda ps: ["x"], backoff=0).collect()
    assert [(r["answer"], r["answer_error"]) for r in rows] == [(None, "1 answers for 2 prompts")] * 2


def test_refused_prompts_leave_the_others_alone(spark):
    def fn(texts):
        if "bad" in texts:
            raise RuntimeError("refused")
        return [x.upper() for x in texts]

    df = spark.createDataFrame([("a",), ("bad",), ("c",)], "prompt string")
    rows = A.generate(df, fn, batch_size=1, attempts=2, backoff=0, tasks=2).collect()
    assert {(r["prompt"], r["answer"], r["answer_error"]) for r in rows} == {
        ("a", "A", None), ("bad", None, "refused"), ("c", "C", None)
    }


def test_own_prompt_builder_and_stop_words(spark, index):
    def builder(questions, hits, *more):
        return A.simple_prompts(questions, hits, *more).withColumn("prompt", F.concat(F.lit("> "), "question"))

    asked = spark.createDataFrame([(1, "carillon"), (2, "\tQuit ")], "query_id long, question string")
    options = A.AnswerOptions(prompt=builder, return_sources=False)
    rows = A.answer(asked, index, E.hashing_embedder(64), lambda ps: ps, options).collect()
    assert [(r["query_id"], r["answer"], r["answer_error"]) for r in rows] == [(1, "> carillon", None)]


def test_evaluation(spark):
    questions = V.evaluation_questions(spark)
    assert questions.groupBy("question_group").count().count() == 4 and questions.count() == 9
    answered = questions.withColumns({
        "answer": F.lit("Le CARILLON sonne"), "nb_events_retrieved": F.lit(5),
        "source_events": F.array(F.struct(F.lit("Visite du Carillon Bollée").alias("titre"))),
    })
    rows = {r["question"]: r for r in V.evaluate_answers(answered).collect()}
    carillon = rows["Parle-moi du Carillon Bollée"]
    assert (carillon["nb_found"], carillon["recall"], carillon["event_met"], carillon["count_met"]) == (1, 0.5, True, None)
    assert rows["Quels sont les horaires de la Manu ?"]["event_met"] is False
    assert rows["Quels événements à Paris ?"]["recall"] is None


def test_hit_at_k(spark):
    hits = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "query_id int, rank int, titre string")
    expected = spark.createDataFrame([(1, "b"), (2, "x"), (3, None)], "query_id int, expected_event string")
    rows = {r["query_id"]: (r["hit"], r["hit_rank"]) for r in V.hit_at_k(hits, expected).collect()}
    assert rows == {1: (True, 2), 2: (False, None)}


def test_corpus_versions(spark, path):
    clean = events(spark, "un concert", "une visite").withColumns({c: F.lit("v") for c in ("titre", "adresse", "categories")})
    corpus.refresh_vectors(spark, clean, path, "0001", E.hashing_embedder(16))
    more = clean.union(clean.limit(1).withColumn("id", F.lit("9")))
    vectors = corpus.refresh_vectors(spark, more, path, "0002", E.hashing_embedder(16), previous="0001")
    assert vectors.count() == 3
    index = corpus.publish_index(spark, vectors, path, "0002")
    assert index.stats().first()["nombre_vecteurs"] == 3
    assert [r["fichier"] for r in versions.list_versions(spark, path, "embeddings").collect()] == ["0002", "0001"]
    assert versions.list_versions(spark, path, "vectorstore").count() == 1

    def refuse(texts):
        raise RuntimeError("no service")

    with pytest.raises(RuntimeError):
        corpus.refresh_vectors(spark, clean, path, "0003", refuse, attempts=1)
    assert spark.read.json(f"{path}/embeddings/versions/0003/errors").count() == 2


def test_vectors_apart_from_metadata(spark, path):
    vectors = spark.createDataFrame([("1", [1.0, 0.0]), ("2", [0.0, 1.0])], "id string, embedding array<float>")
    metadata = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, titre string")
    with pytest.raises(ValueError):
        corpus.integrate_vectors(spark, None, vectors, metadata.limit(1), path, "1")
    index = corpus.integrate_vectors(spark, None, vectors, metadata, path, "1")
    again = corpus.integrate_vectors(spark, tables.read_vectors(spark, f"{path}/embeddings/versions/1"), vectors, metadata, path, "2")
    assert index.stats().first()["nombre_vecteurs"] == again.stats().first()["nombre_vecteurs"] == 2


def test_shared_dir(spark):
    assert shared_dir(spark, "a") != shared_dir(spark, "a")


def test_feature_hashing_is_the_same_in_both_forms(spark):
    texts = ["Bonjour le monde, le MONDE", "é à ÿ Œ x1", "", None, "a" * 300, "the the the " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING")
    native = {r["id"]: r for r in E.embed_features(df, "t", 16).collect()}
    called = {r["id"]: r for r in E.embed(df, E.feature_embedder(16), "t").collect()}
    for i in native:
        assert [native[i][c] for c in ("embedding", "tokens", "embed_error", "text_digest")] == [
            called[i][c] for c in ("embedding", "tokens", "embed_error", "text_digest")
        ]
    assert native[0]["tokens"] == 5 and sum(map(abs, native[5]["embedding"])) == 1500 and not any(native[3]["embedding"])
    with pytest.raises(KeyError):
        E.embed_features(df, "other")


def test_types_of_answers(spark):
    rows = [("Aucun concert trouvé.", 5), ("Il y a peu d'événements", 5), ("Voici cinq événements", 5), ("Voici", 2), ("Voici", 0), (None, 5)]
    df = spark.createDataFrame(rows, "answer STRING, n INT")
    found = [r["kind"] for r in df.select(V.answer_type(F.col("answer"), F.col("n")).alias("kind")).collect()]
    assert found == ["negative", "limited", "full", "limited", "negative", None]


def test_a_run_counts_what_it_answers(spark, index):
    asked = spark.createDataFrame([(i, f"question {i}") for i in range(4)], "query_id BIGINT, question STRING")

    def refuses(prompts):
        if any("question 3" in p for p in prompts):
            raise ValueError("no")
        return ["ok"] * len(prompts)

    options = A.AnswerOptions(k=2, batch_size=1, attempts=1)
    rows = A.timed_answer(asked, index, E.hashing_embedder(64), refuses, options).collect()
    assert {tuple(r["run"]) for r in rows} == {(4, 4, 8, 1)} and len(rows) == 4


def test_features_hash_a_word_once(spark):
    """One MD5 per word, and the vectors of the function."""
    texts = ["", None, "Un été, un ÉTÉ d'or 42 x", "a " * 300 + "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    made = E.embed_features(df, "text", 40)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    vectors, tokens = E.feature_embedder(40)([t or "" for t in texts])
    rows = made.orderBy("id").collect()
    assert [r["embedding"] for r in rows] == [v.tolist() for v in vectors] and [r["tokens"] for r in rows] == tokens


def test_few_rows_are_python_objects_at_a_time():
    batch = E.pa.RecordBatch.from_pydict({"x": list(range(1000))})
    for size, step in ((1, 256), (10, 250), (300, 300)):
        parts = list(E.slices(iter([batch, batch]), size))
        assert [x for p in parts for x in p.column("x").to_pylist()] == list(range(1000)) * 2
        assert all(p.num_rows == step for p in parts[: 1000 // step])


def test_vector_table_keeps_its_dimension(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["vector_table_roundtrip"](spark, "/root/testdata/sf0.001").select("dimension").distinct().collect()
    assert [r[0] for r in rows] == [64]
