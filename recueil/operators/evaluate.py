"""Retrieval and answer quality against expectations."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recueil import schemas

# The evaluation questions.
QUESTIONS = [
    ("questions_simples", "Quels sont les événements à Châtellerault ?", ["Châtellerault", "événement"], 5, None, None, None),
    ("questions_simples", "Y a-t-il des visites guidées ?", ["visite", "guidée"], 5, None, None, None),
    ("questions_simples", "Quels événements sont gratuits ?", ["gratuit", "libre"], 5, None, None, None),
    ("questions_specifiques", "Parle-moi du Carillon Bollée", ["Carillon", "Bollée"], None, "Visite du Carillon Bollée", None, None),
    ("questions_specifiques", "Quels sont les horaires de la Manu ?", ["Manu", "horaire"], None, "Visite de la Manu", None, None),
    ("questions_temporelles", "Quels événements en avril 2026 ?", ["avril", "2026"], 5, None, None, None),
    ("questions_temporelles", "Que faire ce week-end ?", ["week-end", "samedi", "dimanche"], 5, None, None, None),
    ("questions_negatives", "Y a-t-il des concerts de rock ?", None, None, None, "negative_or_limited",
     "Peu probable d'avoir des concerts de rock dans les données"),
    ("questions_negatives", "Quels événements à Paris ?", None, None, None, "limited", "Peu d'événements à Paris (10%)"),
]


def evaluation_questions(spark: SparkSession) -> DataFrame:
    """The evaluation questions as a table."""
    return spark.createDataFrame(QUESTIONS, schemas.QUESTIONS)


def keywords_found(text: Column, keywords: Column) -> Column:
    """How many keywords occur in the text, whatever their case."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.size(F.filter(keywords, lambda word: F.contains(lowered, F.lower(word))))


# Wording by which an answer says that there is nothing, or little.
NEGATIVE = ["aucun", "pas d'", "pas de ", "rien", "ne trouve pas", "n'ai pas trouvé"]
LIMITED = ["peu ", "quelques", "seulement", "uniquement un", "limité"]


def answer_type(answer: Column, nb_events: Column, wanted: int = 5) -> Column:
    """``negative`` if the answer says that there is nothing or has no events,
    ``limited`` if it says that there is little or has fewer events than wanted,
    ``full`` otherwise; null without an answer."""
    lowered = F.lower(answer)

    def says(words: list[str]) -> Column:
        return reduce(or_, [F.contains(lowered, F.lit(word)) for word in words])

    return (
        F.when(answer.isNull(), F.lit(None).cast("string"))
        .when(says(NEGATIVE) | (F.coalesce(nb_events, F.lit(0)) == 0), "negative")
        .when(says(LIMITED) | (nb_events < wanted), "limited")
        .otherwise("full")
    )


def keyword_recall(answers: DataFrame, answer: str = "answer", keywords: str = "expected_keywords") -> DataFrame:
    """Adds ``nb_expected, nb_found, recall``; null where nothing is expected."""
    found = keywords_found(F.col(answer), F.col(keywords))
    expected = F.size(keywords)
    has = F.col(keywords).isNotNull() & (expected > 0)
    return answers.withColumns({
        "nb_expected": F.when(has, expected),
        "nb_found": F.when(has, found),
        "recall": F.when(has, found / expected),
    })


def evaluate_answers(answers: DataFrame) -> DataFrame:
    """Expectations of every question against its answer and hits.

    ``answers`` has the question columns, ``answer``, ``nb_events_retrieved``
    and ``source_events`` (structs with ``titre``).
    """
    scored = keyword_recall(answers)
    titles = F.transform("source_events", lambda hit: hit["titre"])
    kind = answer_type(F.col("answer"), F.col("nb_events_retrieved"))
    return scored.withColumns({
        "count_met": F.col("nb_events_retrieved") >= F.col("expected_nb_events"),
        "event_met": F.when(F.col("expected_event").isNotNull(), F.array_contains(titles, F.col("expected_event"))),
        "answer_type": kind,
        # Several types may be expected, as in negative_or_limited.
        "type_met": F.array_contains(F.split("expected_answer_type", "_or_"), kind),
    })


def hit_at_k(hits: DataFrame, expected: DataFrame, title: str = "titre") -> DataFrame:
    """``query_id, expected_event, hit, hit_rank`` for every expectation."""
    wanted = expected.filter("expected_event IS NOT NULL").select("query_id", "expected_event")
    found = hits.select("query_id", F.col(title).alias("expected_event"), "rank")
    ranks = found.groupBy("query_id", "expected_event").agg(F.min("rank").alias("hit_rank"))
    return wanted.join(ranks, ["query_id", "expected_event"], "left").withColumn("hit", F.col("hit_rank").isNotNull())


def recall_against(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """One row ``nb_exact, nb_found, recall`` of approximate hits.

    Hits of many questions are as many on either side, so they are not broadcast.
    """
    found = approximate.select("query_id", "vec_id", F.lit(1).alias("found")).hint("merge")
    joined = exact.select("query_id", "vec_id").join(found, ["query_id", "vec_id"], "left")
    return joined.agg(F.count("*").alias("nb_exact"), F.count("found").alias("nb_found")).withColumn(
        "recall", F.col("nb_found") / F.col("nb_exact")
    )


def label_agreement(hits: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """``query_id, nb_hits, nb_agreeing`` of hits that share the question's label."""
    asked = labels.select(F.col("vec_id").alias("query_id"), F.col(label).alias("_asked"))
    found = hits.join(labels.select("vec_id", F.col(label).alias("_found")), "vec_id").join(asked, "query_id")
    return found.groupBy("query_id").agg(
        F.count("*").alias("nb_hits"), F.count_if(F.col("_asked") == F.col("_found")).alias("nb_agreeing")
    )
