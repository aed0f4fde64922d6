"""From a question table to hits, documents, prompts and answers."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, functions as F, types as t

from recueil.functions import prompts
from recueil.functions.text import collapse_spaces, not_blank
from recueil.operators.embed import EmbedFn, embed, slices
from recueil.operators.search import VectorIndex
from recueil.session import settled

#: ``fn(prompts)`` returns one answer per prompt.
GenerateFn = Callable[[list[str]], list[str]]

# Words that end a session when asked as a question.
STOP_WORDS = ["quit", "exit", "q"]


@dataclass(frozen=True)
class AnswerOptions:
    """Everything that shapes an answer, in one place."""

    k: int = 5
    nprobe: int = 1
    model: str | None = None
    temperature: float = 0.3
    batch_size: int = 10
    #: A name of ``PROMPTS``, or a function like those: it takes questions, hits
    #: and aggregates to carry along, and adds ``prompt``, ``nb_events_retrieved``.
    prompt: str | Callable[..., DataFrame] = "grounded"
    return_sources: bool = True
    attempts: int = 3
    backoff: float = 2.0
    tasks: int | None = None


def askable(questions: DataFrame, question: str = "question") -> DataFrame:
    """Questions that are neither blank nor a stop word."""
    text = F.col(question)
    return questions.filter(not_blank(text) & ~F.lower(collapse_spaces(text)).isin(STOP_WORDS))


def embed_questions(questions: DataFrame, fn: EmbedFn, **options) -> DataFrame:
    """``query_id, question, embedding`` of the askable questions.

    Written once to the checkpoint folder, so ``fn`` sees each question once.
    """
    asked = askable(questions).select("query_id", "question")
    return settled(embed(asked, fn, "question", **options).select("query_id", "question", "embedding"))


def retrieve(questions: DataFrame, index: VectorIndex, k: int = 5, nprobe: int = 1) -> DataFrame:
    """The k nearest records of every embedded question, with rank, distance,
    ``similarity_score`` and metadata."""
    return index.search_with_metadata(questions, k, nprobe).withColumnRenamed("score", "similarity_score")


def hit_documents(hits: DataFrame) -> DataFrame:
    """Hits as ``query_id, rank, page_content, metadata``."""
    fields = [c for c in hits.columns if c not in ("query_id", "rank")]
    return hits.select("query_id", "rank", prompts.hit_text().alias("page_content"), F.struct(*fields).alias("metadata"))


def _per_question(questions: DataFrame, hits: DataFrame, text: Column, separator: str, *more: Column) -> DataFrame:
    gathered = hits.groupBy("query_id").agg(
        prompts.in_rank_order(F.col("rank"), text, separator).alias("context"),
        F.count("*").cast("int").alias("nb_events_retrieved"),
        *more,
    )
    joined = questions.join(gathered, "query_id", "left")
    return joined.withColumn("nb_events_retrieved", F.coalesce("nb_events_retrieved", F.lit(0)))


def grounded_prompts(questions: DataFrame, hits: DataFrame, with_score: bool = True, *more: Column) -> DataFrame:
    """One full prompt per question, also for questions without hits."""
    score = F.col("similarity_score") if with_score and "similarity_score" in hits.columns else None
    gathered = _per_question(questions, hits, prompts.context_block(F.col("rank"), score), "\n", *more)
    return gathered.withColumn("prompt", prompts.grounded_prompt(F.col("question"), F.col("context"))).drop("context")


def simple_prompts(questions: DataFrame, hits: DataFrame, *more: Column) -> DataFrame:
    """One short prompt per question."""
    gathered = _per_question(questions, hits, prompts.simple_line(F.col("rank")), "\n\n", *more)
    return gathered.withColumn("prompt", prompts.simple_prompt(F.col("question"), F.col("context"))).drop("context")


PROMPTS = {
    "grounded": lambda questions, hits, *more: grounded_prompts(questions, hits, True, *more),
    "simple": simple_prompts,
}


def generate(
    prompted: DataFrame, fn: GenerateFn, batch_size: int = 10, attempts: int = 3, backoff: float = 2.0, tasks: int | None = None
) -> DataFrame:
    """Adds ``answer, answer_error`` by calling ``fn`` on slices of prompts.

    A failing slice is tried ``attempts`` times, waiting ``backoff`` seconds and
    twice as long each further time; then its answers are null and
    ``answer_error`` says why.  ``tasks`` spreads the prompts over so many tasks.
    """
    if batch_size < 1 or attempts < 1:
        raise ValueError("batch_size and attempts must be at least 1")

    def call(texts: list[str]) -> tuple[list[str | None], str | None]:
        for attempt in range(attempts):
            try:
                answers = list(fn(texts))
                if len(answers) != len(texts):
                    raise ValueError(f"{len(answers)} answers for {len(texts)} prompts")
                return answers, None
            except Exception as error:  # whatever the user function raises is data
                message = str(error)
                if attempt + 1 < attempts:
                    time.sleep(backoff * 2**attempt)
        return [None] * len(texts), message

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, batch_size):
            texts = batch.column("prompt").to_pylist()
            answers, errors = [], []
            for start in range(0, len(texts), batch_size):
                part = texts[start : start + batch_size]
                found, error = call(part)
                answers += found
                errors += [error] * len(part)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(answers, pa.string()), pa.array(errors, pa.string())],
                names=[*batch.schema.names, "answer", "answer_error"],
            )

    text_fields = [t.StructField(x, t.StringType()) for x in ("answer", "answer_error")]
    spread = prompted.repartition(tasks) if tasks else prompted
    return spread.mapInArrow(run, t.StructType([*prompted.schema.fields, *text_fields]))


def _sources(hits: DataFrame) -> Column:
    """Aggregate: the hits of a question, at most k, best first."""
    fields = [c for c in hits.columns if c not in ("query_id", "rank")]
    return F.array_sort(F.collect_list(F.struct("rank", *fields))).alias("source_events")


def _builder(options: AnswerOptions) -> Callable[..., DataFrame]:
    if callable(options.prompt):
        return options.prompt
    if options.prompt not in PROMPTS:
        raise ValueError(f"unknown prompt {options.prompt!r}; known: {sorted(PROMPTS)}")
    return PROMPTS[options.prompt]


def _calls(options: AnswerOptions) -> dict:
    return {x: getattr(options, x) for x in ("batch_size", "attempts", "backoff", "tasks")}


def answer(
    questions: DataFrame, index: VectorIndex, embed_fn: EmbedFn, generate_fn: GenerateFn, options: AnswerOptions = AnswerOptions()
) -> DataFrame:
    """Answers a whole question table.

    Columns: the question, ``answer, answer_error, nb_events_retrieved,
    nb_events_used, model, temperature`` and, if wanted, ``source_events``.
    The answers are written once to the checkpoint folder, so ``generate_fn``
    sees each prompt once however often the result is used.
    """
    builder = _builder(options)
    embedded = embed_questions(questions, embed_fn, **_calls(options))
    hits = retrieve(embedded, index, options.k, options.nprobe)
    more = [_sources(hits)] if options.return_sources else []
    prompted = builder(embedded.drop("embedding"), hits, *more)
    answered = settled(generate(prompted, generate_fn, **_calls(options))).drop("prompt")
    return answered.withColumns({
        "nb_events_used": F.col("nb_events_retrieved"),
        "model": F.lit(options.model).cast("string"),
        "temperature": F.lit(options.temperature),
    })


def timed_answer(
    questions: DataFrame, index: VectorIndex, embed_fn: EmbedFn, generate_fn: GenerateFn, options: AnswerOptions = AnswerOptions()
) -> DataFrame:
    """Answers with a ``timing`` struct in milliseconds and a ``run`` struct of counts.

    Both halves run here and are written to the checkpoint folder, because a
    lazy plan has no halves to time.  The times are those of the whole table.  The
    counts (questions asked, questions with hits, hits, failed answers) are observed
    while the halves are written, without a pass of their own.
    """
    builder = _builder(options)
    hits_seen, answers_seen = Observation(), Observation()
    start = time.perf_counter()
    embedded = embed_questions(questions, embed_fn, **_calls(options))
    found = retrieve(embedded, index, options.k, options.nprobe)
    hits = settled(found.observe(hits_seen, F.count("*").alias("hits"), F.count_if(F.col("rank") == 1).alias("found")))
    retrieved = time.perf_counter()
    more = [_sources(hits)] if options.return_sources else []
    prompted = builder(embedded.drop("embedding"), hits, *more)
    generated = generate(prompted, generate_fn, **_calls(options))
    failed = F.count_if(F.col("answer_error").isNotNull()).alias("failed")
    answered = settled(generated.observe(answers_seen, F.count("*").alias("asked"), failed)).drop("prompt")
    end = time.perf_counter()

    def ms(seconds: float) -> Column:
        return F.lit(round(seconds * 1000, 2))

    counts = answers_seen.get | hits_seen.get
    timing = F.struct(
        ms(retrieved - start).alias("retrieval_ms"), ms(end - retrieved).alias("generation_ms"), ms(end - start).alias("total_ms")
    )
    run = F.struct(*[F.lit(counts.get(x, 0)).cast("bigint").alias(f"nb_{x}") for x in ("asked", "found", "hits", "failed")])
    return answered.withColumns({"timing": timing, "run": run})
