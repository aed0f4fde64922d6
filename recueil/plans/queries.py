"""Every operator as a query over the shared tables.

Each query takes the session and a table folder and reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recueil.functions import text as T
from recueil.functions.vectors import inner_product, similarity_score, squared_l2
from recueil.operators import clean as C
from recueil.operators import embed as E
from recueil.operators import evaluate as V
from recueil.operators import merge as M
from recueil.operators import profile as P
from recueil.operators.search import build_index, default_nlist, dimension_of
from recueil.plans import answer as A
from recueil.plans import corpus
from recueil.session import settled, shared_dir
from recueil.sources import landing, tables, versions
from recueil.streaming import collect

BASE_URL = "https://agenda.example.org"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ------------------------------------------------------------- shared inputs


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as raw JSON events: ``payload, seq``; equal texts share a uid."""
    first_line = F.split("text", "\n")[0]
    day = F.date_format(F.date_add(F.lit("2024-01-01"), F.pmod("n_chars", F.lit(365)).cast("int")), "yyyy-MM-dd")
    begin = F.concat(day, F.lit("T09:30:00.000+02:00"))
    end = F.when(F.col("lang") == "fr", begin).otherwise(F.concat(day, F.lit("T18:00:00Z")))
    event = F.struct(
        F.md5("text").alias("uid"),
        F.create_map("lang", first_line).alias("title"),
        F.create_map("lang", F.col("text")).alias("description"),
        F.when(F.col("lang") == "en", F.concat(F.lit("About  "), "source")).alias("longDescription"),
        F.struct(
            F.when(F.col("lang") == "es", " ").otherwise(F.concat(F.lit(" "), "source", F.lit("  city"))).alias("city"),
            F.when(F.col("lang") != "de", F.col("lang")).alias("address"),
            F.col("source").alias("region"),
        ).alias("location"),
        F.struct(F.array("lang", "source").alias("fr")).alias("keywords"),
        F.struct(begin.alias("begin")).alias("firstTiming"),
        F.struct(end.alias("end")).alias("lastTiming"),
        F.concat(F.lit("doc-"), "doc_id").alias("slug"),
        F.when(F.col("lang") != "en", F.struct(F.col("source").alias("slug"))).alias("originAgenda"),
    )
    return _table(spark, folder, "documents").select(F.to_json(event).alias("payload"), F.col("doc_id").alias("seq"))


def _extracted(spark: SparkSession, folder: str) -> DataFrame:
    return C.extract_events(raw_events(spark, folder), BASE_URL)


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return C.clean_events(_extracted(spark, folder))


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "embeddings")


def _asked(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector as a question."""
    return _vectors(spark, folder).select(
        F.col("vec_id").alias("query_id"), F.concat(F.lit("Que trouver près de "), "vec_id", F.lit(" ?")).alias("question"), "embedding"
    )


def _described(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as the metadata of the vectors with the same id."""
    return _table(spark, folder, "documents").select(
        F.col("doc_id").alias("vec_id"),
        F.col("source").alias("titre"),
        F.col("text").alias("description"),
        F.col("lang").alias("ville"),
        F.col("n_chars").cast("string").alias("date_debut"),
        F.lit(None).cast("string").alias("date_fin"),
        F.when(F.col("lang") == "fr", F.col("source")).alias("lieu_nom"),
        F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("categorie"),
    )


def _hits(spark: SparkSession, folder: str) -> DataFrame:
    index = build_index(_vectors(spark, folder).select("vec_id", "embedding"), metadata=_described(spark, folder))
    return A.retrieve(_asked(spark, folder), index, 5)


def _keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a change log: one key per user, ``error`` events have none."""
    uid = F.when(F.col("event_type") != "error", F.col("user_id").cast("string"))
    payload = F.to_json(F.struct("event_type"))
    return _table(spark, folder, "events").select(
        uid.alias("uid"),
        F.col("event_id").alias("pos"),
        payload.alias("payload"),
        T.fingerprint(payload).alias("digest"),
        F.date_format("ts", "yyyyMMdd").alias("day"),
    )


def _base_and_increment(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    log = _keyed(spark, folder)
    return log.filter("day < '20240116'"), log.filter("day >= '20240116' OR day IS NULL")


def _rounded(hits: DataFrame, *more: str) -> DataFrame:
    return hits.select("query_id", "rank", "vec_id", F.round("distance", 4).alias("distance"), *more)


# ------------------------------------------------------------- vector search


@query
def knn_flat_l2(spark, folder):
    return _rounded(build_index(_vectors(spark, folder)).search(_asked(spark, folder), 5))


@query
def knn_flat_ip(spark, folder):
    return _rounded(build_index(_vectors(spark, folder), "flat_ip").search(_asked(spark, folder), 5))


@query
def knn_flat_blocks(spark, folder):
    """The way taken by question tables too large to send to every task: waves."""
    return _rounded(build_index(_vectors(spark, folder)).search(_asked(spark, folder), 5, question_limit=1 << 18))


@query
def knn_with_metadata(spark, folder):
    hits = build_index(_vectors(spark, folder)).search_with_metadata(_asked(spark, folder), 5)
    return _rounded(hits.withColumn("score", F.round("score", 4)), "score", "label")


@query
def knn_join_batch(spark, folder):
    hits = build_index(_vectors(spark, folder)).search(_asked(spark, folder), 10)
    return hits.groupBy("query_id").agg(
        F.count("*").alias("nb_events_retrieved"), F.round(F.max("distance"), 4).alias("farthest")
    )


@query
def knn_ivf_full_probe(spark, folder):
    """Clustered search that probes every cell equals exact search."""
    vectors = _vectors(spark, folder)
    index = build_index(vectors, "ivf")
    return _rounded(index.search(_asked(spark, folder), 5, nprobe=default_nlist(vectors.count())))


def _recall(spark, folder, index, **how) -> DataFrame:
    exact = build_index(_vectors(spark, folder)).search(_asked(spark, folder), 5)
    return V.recall_against(index.search(_asked(spark, folder), 5, **how), exact)


@query
def knn_ivf_recall(spark, folder):
    return _recall(spark, folder, build_index(_vectors(spark, folder), "ivf"), nprobe=8)


@query
def knn_lsh_recall(spark, folder):
    return _recall(spark, folder, build_index(_vectors(spark, folder), "lsh", bucket_length=0.1, tables=16))


@query
def knn_lsh_full(spark, folder):
    """A hashed index with its buckets stored; probing all of them is exact search."""
    path = shared_dir(spark, "index")
    tables.save_index(build_index(_vectors(spark, folder).drop("label"), "lsh", bucket_length=0.5, tables=2), path)
    # Vectors have length 1, so no bucket is further away than four.
    return _rounded(tables.load_index(spark, path).search(_asked(spark, folder), 5, nprobe=9))


@query
def knn_known_only(spark, folder):
    """Hits whose metadata are missing are left out."""
    vectors = _vectors(spark, folder)
    known = vectors.filter("label < 5").select("vec_id", "label")
    return _rounded(build_index(vectors.drop("label"), metadata=known).search_with_metadata(_asked(spark, folder), 5), "label")


@query
def pair_distances(spark, folder):
    """Distance of every vector to the one with the next id, as expressions."""
    a = _vectors(spark, folder).select("vec_id", "embedding")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    squared = squared_l2(F.col("embedding"), F.col("next"))
    return a.join(b, "vec_id").select(
        "vec_id",
        F.round(squared, 4).alias("squared_l2"),
        F.round(inner_product(F.col("embedding"), F.col("next")), 4).alias("inner_product"),
        F.round(similarity_score(squared), 4).alias("score"),
    )


@query
def index_add(spark, folder):
    """An index grown in two steps finds the same neighbours."""
    vectors = _vectors(spark, folder)
    index = build_index(vectors.filter("label < 5").drop("label")).add(vectors.filter("label >= 5").drop("label"))
    return _rounded(index.search(_asked(spark, folder), 5))


@query
def index_roundtrip(spark, folder):
    """A clustered index written, appended to, loaded and searched in full."""
    vectors = _vectors(spark, folder)
    path = shared_dir(spark, "index")
    tables.save_index(build_index(vectors.filter("label < 5"), "ivf", nlist=16), path)
    tables.append_to_index(spark, path, vectors.filter("label >= 5"))
    return _rounded(tables.load_index(spark, path).search(_asked(spark, folder), 5, nprobe=16))


@query
def index_failed_append(spark, folder):
    """An append whose metadata cannot be written leaves the index as it was."""
    vectors = _vectors(spark, folder).drop("label")
    old, new = (vectors.filter(f"vec_id % 2 = {i}") for i in (0, 1))
    path = shared_dir(spark, "index")
    tables.save_index(build_index(old, metadata=old.select("vec_id", F.lit("titre").alias("titre"))), path)
    lost = new.select("vec_id", F.raise_error(F.lit("lost")).cast("string").alias("titre"))
    try:
        tables.append_to_index(spark, path, new, lost)
    except PySparkException as error:
        if "lost" not in str(error):
            raise
    return _rounded(tables.load_index(spark, path).search_with_metadata(_asked(spark, folder), 5), "titre")


@query
def index_published(spark, folder):
    """Vectors merged with those that came apart from their metadata, the index
    rebuilt, published and searched."""
    vectors = _vectors(spark, folder).withColumnRenamed("vec_id", "id")
    root, fresh = shared_dir(spark, "published"), vectors.filter("label >= 5")
    first = vectors.filter("label < 5").withColumnRenamed("id", "vec_id")
    tables.save_index(build_index(first), f"{root}/vectorstore/versions/0001")
    corpus.publish(spark, root, "0001")
    corpus.integrate_vectors(spark, vectors.filter("label < 5"), fresh.drop("label"), fresh.select("id", "label"), root, "0002")
    return _rounded(corpus.published_index(spark, root).search_with_metadata(_asked(spark, folder), 5), "label")


@query
def index_stats(spark, folder):
    vectors = _vectors(spark, folder)
    return build_index(vectors.drop("label"), metadata=vectors.select("vec_id", "label")).stats()


@query
def index_coherence(spark, folder):
    """Vectors and documents whose ids have no counterpart."""
    documents = _table(spark, folder, "documents").select(F.col("doc_id").alias("vec_id"))
    return M.unmatched_keys(_vectors(spark, folder), documents, "vec_id")


@query
def dimension_check(spark, folder):
    vectors = _vectors(spark, folder)
    return vectors.agg(F.count("*").alias("n")).withColumn("dimension", F.lit(dimension_of(vectors, 64)))


# --------------------------------------------------------------- text


@query
def html_clean(spark, folder):
    return _table(spark, folder, "pages").select("page_id", T.strip_html(F.col("html")).alias("text"))


@query
def whitespace_normalize(spark, folder):
    return _table(spark, folder, "documents").select("doc_id", T.collapse_spaces(F.col("text")).alias("text"))


@query
def compose_text(spark, folder):
    customers = _table(spark, folder, "customer")
    nations = _table(spark, folder, "nation")
    regions = _table(spark, folder, "region")
    # Nation and region are fixed, tiny tables; the join type is Spark's choice.
    joined = customers.join(nations, customers.c_nationkey == nations.n_nationkey).join(
        regions, nations.n_regionkey == regions.r_regionkey
    )
    rich = F.col("c_acctbal") > 0
    return joined.select(
        "c_custkey",
        T.compose_text(
            F.col("c_name"),
            F.col("c_mktsegment"),
            F.when(rich, F.col("c_mktsegment")).otherwise(F.concat("c_mktsegment", F.lit(" / "), "n_name")),
            F.col("n_name"),
            F.when(rich, F.col("r_name")),
            F.when(rich, "").otherwise(F.col("r_name")),
            F.lit("2024-01-01"),
            F.when(rich, "2024-01-01").otherwise("2024-02-01"),
        ).alias("texte_complet"),
    )


@query
def language_pick(spark, folder):
    """French or English text if present, else the first entry."""
    raw = F.to_json(F.create_map(F.lit("zz"), F.col("source"), F.col("lang"), F.col("text")))
    return _table(spark, folder, "documents").select("doc_id", T.pick_language(raw).alias("text"))


@query
def keywords_join(spark, folder):
    raw = (
        F.when(F.col("lang") == "fr", F.to_json(F.struct(F.array("lang", "source").alias("fr"))))
        .when(F.col("lang") == "en", F.to_json(F.array("source", "lang")))
        .when(F.col("lang") == "de", F.col("source"))
        .otherwise(F.to_json(F.struct(F.array("lang").alias("es"))))
    )
    return _table(spark, folder, "documents").select("doc_id", T.join_keywords(raw).alias("categories"))


@query
def wallclock_date(spark, folder):
    """Five spellings of a time; milliseconds and bare dates stay as they are."""
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_type")
    spelled = (
        F.when(kind == "view", F.concat(base, F.lit(".000+02:00")))
        .when(kind == "click", F.concat(base, F.lit("Z")))
        .when(kind == "signup", base)
        .when(kind == "error", F.concat(base, F.lit(".123+02:00")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    return _table(spark, folder, "events").select("event_id", T.wall_clock(spelled).alias("date_debut"))


@query
def build_url(spark, folder):
    agenda = F.when(F.col("c_acctbal") > 0, F.lower("c_mktsegment"))
    slug = F.when(F.col("c_acctbal") < 9000, F.lower("c_name"))
    return _table(spark, folder, "customer").select("c_custkey", T.build_url(BASE_URL, agenda, slug).alias("url"))


@query
def json_project(spark, folder):
    props = F.from_json("props", "k BIGINT, missing STRING")
    return _table(spark, folder, "events").select(
        "event_id", props["k"].alias("k"), F.coalesce(props["missing"], F.lit("")).alias("missing")
    )


@query
def error_excerpt(spark, folder):
    return _table(spark, folder, "documents").select("doc_id", T.excerpt(F.col("text")).alias("texte"))


@query
def sanitized_texts(spark, folder):
    """Texts to embed, with blanks for what is missing, counted per source."""
    joined = _table(spark, folder, "documents").join(_table(spark, folder, "labels"), "doc_id", "left")
    masked = joined.withColumn("text", F.when(F.col("quality") == 1, F.col("text")))
    clean = masked.withColumn("clean", E.clean_text(masked, "text"))
    return clean.groupBy("source").agg(
        F.count("*").alias("total"), F.count_if(~T.not_blank(F.col("clean"))).alias("blank"), F.sum(F.length("clean")).alias("chars")
    )


@query
def metadata_projection(spark, folder):
    named = _table(spark, folder, "documents").select(
        F.when(F.col("lang") != "de", F.concat(F.lit("d"), "doc_id")).alias("id"),
        F.col("source").alias("titre"),
        F.when(F.col("lang") == "fr", F.col("lang")).alias("ville"),
        (F.col("doc_id") * 2).alias("position"),
    )
    return E.vector_metadata(named, "position")


# --------------------------------------------------------------- cleaning


@query
def extract_events(spark, folder):
    return _extracted(spark, folder).drop("seq")


@query
def malformed_events(spark, folder):
    """German documents land as plain text, the others as JSON."""
    documents = _table(spark, folder, "documents")
    payload = F.when(F.col("lang") == "de", F.col("text")).otherwise(F.to_json(F.struct("doc_id", "text")))
    return C.malformed(documents.select("doc_id", payload.alias("payload"))).select("doc_id")


@query
def clean_events(spark, folder):
    return _clean(spark, folder).drop("seq")


@query
def rejection_counts(spark, folder):
    return C.rejection_counts(_extracted(spark, folder))


@query
def dedup_keep_first(spark, folder):
    documents = _table(spark, folder, "documents")
    return C.keep_first(documents, "text", "doc_id").select("doc_id", "source", "n_chars")


@query
def display_sample(spark, folder):
    return C.display_sample(_clean(spark, folder), ["date_debut", "id"], 10)


@query
def clean_csv_roundtrip(spark, folder):
    """Clean events written in every form and read back from CSV."""
    path = shared_dir(spark, "processed")
    tables.write_clean(_clean(spark, folder), path)
    return tables.read_clean_csv(spark, f"{path}/csv")


# --------------------------------------------------------------- profiling


@query
def value_counts_top10(spark, folder):
    return P.value_counts(_table(spark, folder, "documents"), "source", 10)


@query
def value_counts_roles(spark, folder):
    return P.value_counts(_table(spark, folder, "conversations"), "role", 20)


@query
def length_stats(spark, folder):
    return P.length_stats(_table(spark, folder, "documents"), ["text", "lang", "source"])


@query
def distinct_counts(spark, folder):
    return P.row_and_value_counts(_table(spark, folder, "events"), "user_id")


def _partly_labelled(spark, folder) -> DataFrame:
    documents = _table(spark, folder, "documents").join(_table(spark, folder, "labels"), "doc_id", "left")
    return documents.select(
        "text",
        F.when(F.col("lang") == "fr", " ").when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("lang"),
        "quality",
    )


@query
def fill_rates(spark, folder):
    return P.fill_rates(_partly_labelled(spark, folder))


@query
def fill_rates_strict(spark, folder):
    return P.fill_rates(_partly_labelled(spark, folder), rule="strict")


@query
def fill_rates_not_empty(spark, folder):
    return P.fill_rates(_partly_labelled(spark, folder), rule="not_empty")


def _entries(counts: Column) -> Column:
    """A map of counts as text, in its order."""
    return F.array_join(F.transform(F.map_entries(counts), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), "|")


@query
def corpus_summary(spark, folder):
    summary = P.summary(_clean(spark, folder))
    return summary.withColumn("top_villes", _entries(F.col("top_villes")))


@query
def statistics_document(spark, folder):
    document = P.statistics_document(_clean(spark, folder).drop("seq"))
    return document.select(
        "nombre_evenements", F.array_join("colonnes", ",").alias("colonnes"), "completude.*", "statistiques_texte.*",
        "taux_avec_dates", "taux_avec_url", _entries(F.col("villes_principales")).alias("villes_principales"),
    )


# --------------------------------------------------------------- merging


@query
def upsert_merge(spark, folder):
    return M.merge(*_base_and_increment(spark, folder)).select("uid", "pos", "payload")


@query
def upsert_merge_by_content(spark, folder):
    """Keyless rows count as the same row if their content is equal."""
    merged = M.merge(*_base_and_increment(spark, folder), keyless="content_hash")
    return merged.groupBy("uid").agg(F.count("*").alias("n"))


@query
def upsert_report(spark, folder):
    return M.merge_report(*_base_and_increment(spark, folder))


@query
def session_journal(spark, folder):
    return M.replayed_journal(_keyed(spark, folder), "day")


def _labelled_as_vectors(spark, folder) -> tuple[DataFrame, DataFrame]:
    events = _table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text", "n_chars")
    vectors = _table(spark, folder, "labels").select(F.col("doc_id").alias("id"), "quality")
    return events, vectors


@query
def anti_join_new(spark, folder):
    """Documents that have no label yet."""
    events, vectors = _labelled_as_vectors(spark, folder)
    return M.without_vector(events, vectors).select("id", "n_chars")


@query
def anti_join_changed(spark, folder):
    """Documents that are new or whose text changed (those of quality 0)."""
    events, vectors = _labelled_as_vectors(spark, folder)
    digest = F.when(F.col("quality") == 1, F.sha2("text", 256)).otherwise("stale")
    stored = events.join(vectors, "id").select("id", digest.alias("text_digest"))
    return M.without_vector(events, stored, "changed", "text").select("id", "n_chars")


@query
def vector_append(spark, folder):
    events, vectors = _labelled_as_vectors(spark, folder)
    fresh = events.select("id", F.lit(-1).alias("quality"))
    return M.append_vectors(vectors, fresh)


@query
def page_limit(spark, folder):
    events = _table(spark, folder, "events").select("user_id", "event_id", "event_type")
    return landing.first_per_group(events, "user_id", "event_id", landing.EVENTS_PER_AGENDA)


@query
def collection_summary(spark, folder):
    uid = F.when(F.col("c_acctbal") > 0, F.col("c_custkey"))
    agendas = _table(spark, folder, "customer").select(uid.alias("uid"))
    events = _table(spark, folder, "orders").select(F.col("o_custkey").alias("agenda_uid"))
    return landing.collection_summary(agendas, events)


@query
def landed_events(spark, folder):
    """Orders as landed event pages, up to three items taken from each."""
    items = _table(spark, folder, "lineitem")
    item = F.struct("l_linenumber", "l_partkey", "l_quantity")
    # An order has at most seven items, so a page is small.
    page = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("events"))
    path = shared_dir(spark, "landing")
    page.select(F.to_json(F.struct(F.col("l_orderkey").cast("string").alias("agenda_uid"), "events"))).write.text(path)
    agendas = _table(spark, folder, "orders").filter("o_orderstatus <> 'P'")
    agendas = agendas.select(F.col("o_orderkey").cast("string").alias("uid"), F.col("o_orderpriority").alias("title"))
    events = landing.events_of(agendas, landing.event_pages(spark, path), 3)
    parsed = F.from_json("payload", "l_linenumber INT, l_partkey BIGINT, l_quantity DOUBLE")
    return events.select("agenda_uid", parsed.alias("e")).select("agenda_uid", "e.*")


def _agenda_pages(spark, folder) -> DataFrame:
    """Customers as landed agenda pages of twenty."""
    page = F.floor(F.col("c_custkey") / landing.AGENDAS_PER_PAGE)
    agenda = F.struct(F.col("c_custkey").cast("string").alias("uid"), F.col("c_name").alias("title"))
    customers = _table(spark, folder, "customer")
    listed = customers.groupBy(page.alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("c_custkey", agenda.alias("agenda")))).alias("sorted"),
        F.max("c_custkey").alias("last"),
    )
    body = F.struct(
        F.transform("sorted", lambda a: a["agenda"]).alias("agendas"),
        F.array(F.col("page") + 1, "last").alias("after"),
        F.lit(customers.count()).alias("total"),
    )
    path = shared_dir(spark, "landing")
    ordered = listed.repartitionByRange("page").sortWithinPartitions("page")
    ordered.select(F.to_json(body)).write.text(path)
    return landing.agenda_pages(spark, path)


@query
def landed_agendas(spark, folder):
    """Up to fifteen agendas of every landed page."""
    return landing.agendas(_agenda_pages(spark, folder), 15)


@query
def landed_cursor(spark, folder):
    """Where the next collection resumes after all landed pages."""
    cursor = landing.next_cursor(_agenda_pages(spark, folder))
    return cursor.withColumn("curseur_after", F.array_join(F.col("curseur_after").cast("array<string>"), ","))


@query
def array_files(spark, folder):
    """Documents as array files of five thousand, cut at the borders of elements."""
    element = F.struct("doc_id", "text", F.array("lang", F.lit('],[{"')).alias("more"))
    page = F.floor(F.col("doc_id") / 5000).alias("page")
    arrays = _table(spark, folder, "documents").groupBy(page).agg(F.to_json(F.collect_list(element)).alias("value"))
    path = shared_dir(spark, "landing")
    arrays.write.partitionBy("page").text(path)
    parsed = F.from_json("payload", "doc_id BIGINT, text STRING, more ARRAY<STRING>").alias("e")
    return landing.raw_arrays(spark, path).select(parsed).select(
        "e.doc_id", F.md5("e.text").alias("text"), F.array_join("e.more", " ").alias("more")
    )


@query
def resumed_cursor(spark, folder):
    """Agenda pages landed in four collections: three go through the list, which
    ends with the third; the fourth begins anew.  The stream stops in between and
    goes on where its cursor is."""
    base, customers = shared_dir(spark, "cursor"), _table(spark, folder, "customer")
    page = F.floor(F.col("c_custkey") / landing.AGENDAS_PER_PAGE)
    last = customers.agg(F.max(page)).first()[0]
    agenda = F.struct(F.col("c_custkey").cast("string").alias("uid"), F.col("c_name").alias("title"))
    # A page has twenty agendas.
    listed = customers.groupBy(page.alias("page")).agg(F.collect_list(agenda).alias("agendas"), F.max("c_custkey").alias("at"))
    body = F.struct("agendas", F.when(F.col("page") < last, F.array(F.col("page") + 1, "at")).alias("after"), F.lit(last + 1).alias("total"))
    for collection in (0, 1, 2, 0):
        part = listed.filter(F.floor(F.col("page") * 3 / (last + 1)) == collection).repartitionByRange("page").sortWithinPartitions("page")
        part.select(F.to_json(body)).write.mode("append").text(f"{base}/landing")
        collect.follow_agenda_pages(spark, f"{base}/landing", f"{base}/root", f"{base}/checkpoint", 1000).awaitTermination()
    resumed = versions.resume_from(spark, f"{base}/root")
    after = F.array_join(F.col("curseur_after").cast("array<string>"), ",")
    return versions.cursors(spark, f"{base}/root").select(
        "seq", after.alias("curseur_after"), "nb_agendas_session", "total_agendas_api", "fin_de_liste",
        F.lit(",".join(map(str, resumed or []))).alias("next_after"),
    )


def _landed(spark, folder, path: str, half: Column) -> None:
    event = F.to_json(F.struct(F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("uid"), "event_type"))
    log = _table(spark, folder, "events").filter(half)
    ordered = log.repartitionByRange("event_id").sortWithinPartitions("event_id")
    ordered.select(event.alias("value")).write.mode("append").text(path)


@query
def stream_upsert(spark, folder):
    """Two landings of events, merged by a stream into the versioned table."""
    base = shared_dir(spark, "stream")
    early = F.coalesce(F.col("ts") < F.lit("2024-01-16").cast("timestamp"), F.lit(False))
    for half in (early, ~early):
        _landed(spark, folder, f"{base}/landing", half)
        collect.merge_lines(spark, f"{base}/landing", f"{base}/root", f"{base}/checkpoint").awaitTermination()
    return versions.current(spark, f"{base}/root").select(
        "uid", F.col("pos.version").alias("version"), F.get_json_object("payload", "$.event_type").alias("event_type")
    )


@query
def stream_journal(spark, folder):
    """The journal of those two merges."""
    base = shared_dir(spark, "stream")
    early = F.coalesce(F.col("ts") < F.lit("2024-01-16").cast("timestamp"), F.lit(False))
    for half in (early, ~early):
        _landed(spark, folder, f"{base}/landing", half)
        collect.merge_lines(spark, f"{base}/landing", f"{base}/root", f"{base}/checkpoint").awaitTermination()
    return versions.journal(spark, f"{base}/root").select(
        "version", "nb_nouveaux", "nb_avant_fusion", "nb_apres_fusion", "nb_ajoutes", "nb_mis_a_jour", "nb_doublons"
    )


def _halves(spark, folder) -> list[DataFrame]:
    """Events of the first half of the month and the others, as raw events."""
    event = F.to_json(F.struct(F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("uid"), "event_type"))
    early = F.coalesce(F.col("ts") < F.lit("2024-01-16").cast("timestamp"), F.lit(False))
    log = _table(spark, folder, "events")
    return [log.filter(half).select(event.alias("payload"), F.col("event_id").alias("seq")) for half in (early, ~early)]


@query
def compacted_table(spark, folder):
    """Two merges, the second appended as changes, and the state compacted."""
    root = shared_dir(spark, "merge")
    for half in _halves(spark, folder):
        versions.integrate(spark, root, half, bucket_rows=1000, compacting=False)
    versions.compact(spark, root, 1000)
    return versions.current(spark, root).select(
        "uid", F.col("pos.version").alias("version"), F.get_json_object("payload", "$.event_type").alias("event_type")
    )


@query
def merge_changes(spark, folder):
    """How many rows each merge writes: those that change and no others."""
    root = shared_dir(spark, "merge")
    for half in _halves(spark, folder):
        versions.integrate(spark, root, half, compacting=False)
    return versions.journal(spark, root).select("version", "nb_nouveaux", "nb_ajoutes", "nb_mis_a_jour", "changed")


@query
def replayed_batches(spark, folder):
    """One batch merged five times: the replays add and change nothing."""
    root, customers = shared_dir(spark, "replay"), _table(spark, folder, "customer")
    payload = F.to_json(F.struct(F.col("c_name").alias("uid"), "c_mktsegment"))
    batch = customers.select(payload.alias("payload"), F.col("c_custkey").alias("seq"))
    for _ in range(5):
        versions.integrate(spark, root, batch)
    return versions.journal(spark, root).select(
        "version", "nb_nouveaux", "nb_avant_fusion", "nb_apres_fusion", "nb_ajoutes", "nb_mis_a_jour", "nb_doublons", "changed", "rejoue"
    )


@query
def list_versions(spark, folder):
    """Versions of raw and processed data in the order they are listed; hidden
    ones do not count."""
    base = shared_dir(spark, "versions")
    for half in _halves(spark, folder):
        versions.integrate(spark, base, half)
    customers, nations = _table(spark, folder, "customer"), _table(spark, folder, "nation")
    placed = customers.join(nations, customers.c_nationkey == nations.n_nationkey)
    for region in _table(spark, folder, "region").collect():  # five rows
        for name in (region["r_name"], f"_{region['r_name']}"):
            placed.filter(F.col("n_regionkey") == region["r_regionkey"]).write.parquet(f"{base}/processed/versions/{name}")
    listed = [
        (kind, row["fichier"], place + 1, row["taille_ko"] > 0)
        for kind in ("raw", "processed") for place, row in enumerate(versions.list_versions(spark, base, kind).collect())
    ]
    return spark.createDataFrame(listed, "kind STRING, fichier STRING, place INT, filled BOOLEAN")


# --------------------------------------------------------------- embedding


DIMENSION = 32


def _embedded(spark, folder, embedder: E.EmbedFn = E.feature_embedder(DIMENSION)) -> DataFrame:
    documents = _table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    return E.embed(documents, embedder, "text", batch_size=64)


def _numbers(vector: str) -> Column:
    return F.array_join(F.transform(vector, lambda x: x.cast("int").cast("string")), ",")


@query
def embed_hash(spark, folder):
    """Documents with their vectors and token counts, by a function."""
    return _embedded(spark, folder).select("id", _numbers("embedding").alias("embedding"), "tokens", "embed_error")


@query
def embed_features(spark, folder):
    """The same in native expressions."""
    documents = _table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return E.embed_features(documents, "text", DIMENSION).select("id", _numbers("embedding").alias("embedding"), "tokens", "text_digest")


@query
def embedding_stats(spark, folder):
    return E.embedding_stats(_embedded(spark, folder), 64, "hashing", 2.0)


@query
def vector_table_roundtrip(spark, folder):
    """Vectors written with their figures and read back."""
    path = shared_dir(spark, "vectors")
    tables.write_vectors(_embedded(spark, folder, E.hashing_embedder(64)), path, text="text", batch_size=64)
    return tables.read_vectors(spark, path).select("id", "text_digest", F.size("embedding").alias("dimension"))


def _refuses_digits(texts: list[str]):
    if any("1" in t for t in texts):
        raise ValueError("refused")
    return [[1.0, float(len(t))] for t in texts]


@query
def embed_errors(spark, folder):
    """Texts the function refuses become error rows, not failures."""
    documents = _table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    done = E.embed(documents, _refuses_digits, "text", batch_size=1, attempts=2, backoff=0.0)
    return E.embedding_errors(done, "id", "text")


@query
def embed_incremental(spark, folder):
    """Only documents without a label get a vector; the others keep theirs."""
    events, labels = _labelled_as_vectors(spark, folder)
    stored = labels.select("id", F.array(F.lit(0.0).cast("float")).alias("embedding"))
    merged = E.embed_new(events.select("id", "text"), stored, lambda ts: [[1.0, float(len(t))] for t in ts], "text", batch_size=64)
    return merged.select("id", F.size("embedding").alias("dimension"), F.element_at("embedding", -1).cast("int").alias("last"))


# --------------------------------------------------------------- answers


@query
def askable_questions(spark, folder):
    turns = _table(spark, folder, "conversations")
    masked = F.when(F.col("role") == "system", " \t").when(F.col("turn") == 1, " Quit ").otherwise(F.col("text"))
    return A.askable(turns.select("conv_id", "turn", masked.alias("question")))


@query
def hit_documents(spark, folder):
    return A.hit_documents(_hits(spark, folder)).select("query_id", "rank", "page_content")


@query
def context_prompt(spark, folder):
    questions = _asked(spark, folder).drop("embedding")
    return A.grounded_prompts(questions, _hits(spark, folder))


@query
def simple_prompt(spark, folder):
    questions = _asked(spark, folder).drop("embedding")
    return A.simple_prompts(questions, _hits(spark, folder))


@query
def generated_answers(spark, folder):
    """Prompts answered by a function that reports their length."""
    prompts = A.grounded_prompts(_asked(spark, folder).drop("embedding"), _hits(spark, folder))
    answered = A.generate(prompts, lambda texts: [f"{len(t)} caractères" for t in texts])
    return answered.select("query_id", "answer", "nb_events_retrieved")


def _first_lines(prompts: list[str]) -> list[str]:
    """Stands in for a chat model: repeats the titles of the context."""
    titles = [[line for line in p.split("\n") if line.startswith("Titre: ")] for p in prompts]
    return [" / ".join(t) if t else "rien" for t in titles]


def _document_index(spark, folder):
    documents = _table(spark, folder, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    vectors = settled(E.embed_features(documents, "text", DIMENSION).select("vec_id", "embedding"))
    return build_index(vectors, dimension=DIMENSION, metadata=_described(spark, folder))


@query
def answer_batch(spark, folder):
    """Every benchmark text asked against every document, end to end."""
    questions = _table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    options = A.AnswerOptions(model="first-lines")
    return A.answer(questions, _document_index(spark, folder), E.feature_embedder(DIMENSION), _first_lines, options).select(
        "query_id", "answer", "answer_error", "nb_events_retrieved", "nb_events_used", "model", "temperature",
        F.array_join(F.transform("source_events", lambda hit: hit["vec_id"].cast("string")), ",").alias("sources"),
    )


@query
def answer_run(spark, folder):
    """Counts and times of a run of answers: the times of both halves add up."""
    questions = _table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    timed = A.timed_answer(questions, _document_index(spark, folder), E.feature_embedder(DIMENSION), _first_lines)
    halves = F.col("timing.retrieval_ms") + F.col("timing.generation_ms")
    near = F.abs(halves - F.col("timing.total_ms")) < 0.1
    return timed.select("query_id", "run.*", (near & (F.col("timing.retrieval_ms") > 0)).alias("adds_up"))


@query
def golden_evaluation(spark, folder):
    """The evaluation questions asked against every document."""
    questions = V.evaluation_questions(spark).withColumn("query_id", F.xxhash64("question"))
    answered = A.answer(questions, _document_index(spark, folder), E.feature_embedder(DIMENSION), _first_lines)
    scored = V.evaluate_answers(questions.join(answered.drop("question"), "query_id"))
    return scored.select(
        "question_group", "question", "answer", "nb_events_retrieved", "nb_found", F.round("recall", 4).alias("recall"), "count_met",
        "event_met", "answer_type", "type_met",
    )


@query
def label_agreement_at_k(spark, folder):
    vectors = _vectors(spark, folder)
    hits = build_index(vectors.drop("label")).search(_asked(spark, folder), 5)
    return V.label_agreement(hits, vectors.select("vec_id", "label"))


@query
def keyword_recall(spark, folder):
    """Words of a user's turn that come back in the assistant's next turn."""
    turns = _table(spark, folder, "conversations")
    words = F.array_distinct(F.filter(F.split(F.lower("text"), " "), lambda w: F.length(w) >= 8))
    asked = turns.filter("role = 'user'").select("conv_id", "turn", words.alias("expected_keywords"))
    replies = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    scored = V.keyword_recall(asked.join(replies, ["conv_id", "turn"]))
    return scored.select("conv_id", "turn", "nb_expected", "nb_found", F.round("recall", 4).alias("recall"))


@query
def hit_at_k(spark, folder):
    """Whether the document a question was made from is among the hits."""
    expected = _described(spark, folder).select(
        F.col("vec_id").alias("query_id"), F.when(F.col("ville") != "de", F.col("titre")).alias("expected_event")
    )
    asked = _vectors(spark, folder).select(F.col("vec_id").alias("query_id"))
    return V.hit_at_k(_hits(spark, folder), expected.join(asked, "query_id"))


@query
def corpus_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw events cleaned, embedded, searched and turned into prompts."""
    clean = corpus.clean_corpus(raw_events(spark, folder), BASE_URL)
    vectors = E.embed_features(clean, dimension=DIMENSION)
    index = build_index(settled(corpus.as_index_input(vectors)), dimension=DIMENSION)
    questions = _table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    embedded = A.embed_questions(questions, E.feature_embedder(DIMENSION))
    return A.grounded_prompts(embedded.drop("embedding"), A.retrieve(embedded, index, 5))
