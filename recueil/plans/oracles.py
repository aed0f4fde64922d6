"""The queries once more, as plain SQL over the same tables.

They are written from the meaning of each operator and share no code with it
but the fixed values.
"""

from __future__ import annotations

from recueil.functions import prompts
from recueil.functions.text import ENTITIES

BASE_URL = "https://agenda.example.org"

# White space as the text functions see it.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NOT_WS = _WS.replace("[", "[^", 1)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'))"


def _visible(c: str) -> str:
    return f"coalesce(regexp_matches({c}, '{_NOT_WS}'), false)"


def _html(c: str) -> str:
    out = f"regexp_replace({c}, '<[^>]+>', '', 'g')"
    for entity, char in ENTITIES:
        out = f"replace({out}, {_text(entity)}, {_text(char)})"
    return _collapse(out)


def _excerpt(c: str) -> str:
    return f"CASE WHEN length({c}) > 100 THEN substr({c}, 1, 100) || '...' ELSE {c} END"


# ------------------------------------------------------------- vector search

_PAIRS = """
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         list_sum(list_transform(list_zip(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d
  FROM embeddings a, embeddings b
)"""


def _knn(k: int = 5, select: str = "query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(d, 4) AS distance", tail: str = "") -> str:
    return f"""WITH {_PAIRS},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rank FROM pairs),
    hits AS (SELECT * FROM ranked WHERE rank <= {k})
    SELECT {select} FROM hits {tail}"""


_KNN = _knn()

_IP = """WITH pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         list_sum(list_transform(list_zip(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), lambda x: x[1] * x[2])) AS d
  FROM embeddings a, embeddings b),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(d, 4) AS distance FROM ranked WHERE rank <= 5"""

_NEXT = """WITH p AS (
  SELECT a.vec_id, list_zip(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS z
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
d AS (
  SELECT vec_id, list_sum(list_transform(z, lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS s,
         list_sum(list_transform(z, lambda x: x[1] * x[2])) AS ip FROM p)
SELECT vec_id, round(s, 4) AS squared_l2, round(ip, 4) AS inner_product, round(1 / (1 + s), 4) AS score FROM d"""

# --------------------------------------------------------------- events

_DAY = "strftime(DATE '2024-01-01' + CAST(n_chars % 365 AS INTEGER), '%Y-%m-%d')"

_RAW = f"""
raw AS (
  SELECT doc_id AS seq, md5(text) AS id, split_part(text, chr(10), 1) AS titre, text AS description,
         CASE WHEN lang = 'en' THEN 'About  ' || source ELSE '' END AS description_longue,
         CASE WHEN lang = 'es' THEN ' ' ELSE ' ' || source || '  city' END AS ville,
         CASE WHEN lang <> 'de' THEN lang ELSE '' END AS adresse,
         source AS region,
         {_DAY} || ' 09:30:00' AS date_debut,
         {_DAY} || CASE WHEN lang = 'fr' THEN ' 09:30:00' ELSE ' 18:00:00' END AS date_fin,
         lang || ', ' || source AS categories,
         '{BASE_URL}/' || CASE WHEN lang <> 'en' THEN source || '/' ELSE '' END || 'events/doc-' || doc_id AS url
  FROM documents
)"""

_COMPOSED = """concat_ws(chr(10),
    'Titre: ' || nullif(titre, ''),
    'Description: ' || nullif(description, ''),
    CASE WHEN description_longue <> description THEN 'Détails: ' || nullif(description_longue, '') END,
    'Lieu: ' || nullif(concat_ws(', ', nullif(ville, ''), nullif(adresse, '')), ''),
    'Date de début: ' || nullif(date_debut, ''),
    CASE WHEN date_fin <> date_debut THEN 'Date de fin: ' || nullif(date_fin, '') END,
    'Catégories: ' || nullif(categories, '')) AS texte_complet"""

_COLUMNS = "id, titre, description, description_longue, ville, adresse, region, date_debut, date_fin, categories, url"

_CLEAN = f"""{_RAW},
firsts AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1),
valid AS (
  SELECT * FROM firsts WHERE {_visible('titre')} AND {_visible('description')} AND length(description) >= 50 AND {_visible('ville')}),
spaced AS (
  SELECT id, {_collapse('titre')} AS titre, {_html(_collapse('description'))} AS description,
         {_html(_collapse('description_longue'))} AS description_longue, {_collapse('ville')} AS ville,
         {_collapse('adresse')} AS adresse, {_collapse('region')} AS region, date_debut, date_fin,
         {_collapse('categories')} AS categories, url
  FROM valid),
clean AS (SELECT {_COLUMNS}, {_COMPOSED} FROM spaced)"""


def _rate(condition: str) -> str:
    return f"round_even(100.0 * count(*) FILTER ({condition}) / count(*), 1)"


_LABELLED = """p AS (
  SELECT d.text, CASE WHEN lang = 'fr' THEN ' ' WHEN lang = 'en' THEN '' ELSE lang END AS lang, CAST(l.quality AS VARCHAR) AS quality
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _rates(condition: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", CAST({_rate(condition.replace('$', c))} AS DOUBLE) AS percent FROM p"
        for c in ("text", "lang", "quality")
    ]
    return f"WITH {_LABELLED} " + " UNION ALL ".join(parts)


def _count(rule: str, condition: str) -> str:
    return f"SELECT '{rule}' AS rule, count(*) AS n FROM judged WHERE {condition}"


_REJECTED = f"""WITH {_RAW},
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS nth FROM raw),
judged AS (SELECT *, {_visible('titre')} AS t, {_visible('description')} AS d, length(description) >= 50 AS l, {_visible('ville')} AS v FROM ranked),
counts AS (
  {_count('duplicate', 'nth > 1')} UNION ALL
  {_count('no_title', 'nth = 1 AND NOT t')} UNION ALL
  {_count('no_description', 'nth = 1 AND t AND NOT d')} UNION ALL
  {_count('short_description', 'nth = 1 AND t AND d AND NOT l')} UNION ALL
  {_count('no_city', 'nth = 1 AND t AND d AND l AND NOT v')} UNION ALL
  {_count('kept', 'nth = 1 AND t AND d AND l AND v')})
SELECT rule, n, CAST(round_even(100.0 * n / (SELECT count(*) FROM raw), 1) AS DOUBLE) AS percent FROM counts"""

# --------------------------------------------------------------- merging

_LOG = """
log AS (
  SELECT event_id AS pos, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS uid, event_type,
         '{"event_type":"' || event_type || '"}' AS payload, coalesce(ts >= TIMESTAMP '2024-01-16', true) AS fresh, strftime(ts, '%Y%m%d') AS day
  FROM events),
target AS (SELECT uid, max(pos) AS pos FROM log WHERE NOT fresh AND uid IS NOT NULL GROUP BY uid),
latest AS (
  SELECT uid, min(pos) AS first_pos, arg_max(payload, pos) AS payload FROM log WHERE fresh AND uid IS NOT NULL GROUP BY uid)"""

_MERGED = f"""{_LOG},
merged AS (
  SELECT g.uid, g.pos, CASE WHEN t.pos = g.pos AND l.uid IS NOT NULL THEN l.payload ELSE g.payload END AS payload
  FROM log g LEFT JOIN target t ON g.uid = t.uid LEFT JOIN latest l ON g.uid = l.uid WHERE NOT g.fresh
  UNION ALL SELECT uid, first_pos, payload FROM latest l WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.uid = l.uid)
  UNION ALL SELECT uid, pos, payload FROM log WHERE fresh AND uid IS NULL)"""

_CLASSES = """
steps AS (
  SELECT *, lag(payload) OVER (PARTITION BY uid ORDER BY pos) AS previous FROM log WHERE uid IS NOT NULL),
classes AS (
  SELECT fresh, day, CASE WHEN previous IS NULL THEN 'a' WHEN previous <> payload THEN 'u' ELSE 's' END AS class FROM steps
  UNION ALL SELECT fresh, day, 'a' FROM log WHERE uid IS NULL)"""

_REPORT = f"""WITH {_LOG},
{_CLASSES},
n AS (
  SELECT count(*) AS rows, count(*) FILTER (class = 'a') AS a, count(*) FILTER (class = 'u') AS u, count(*) FILTER (class = 's') AS s
  FROM classes WHERE fresh),
b AS (SELECT count(*) AS before FROM log WHERE NOT fresh)
SELECT rows AS nb_nouveaux, before AS nb_avant_fusion, before + a AS nb_apres_fusion, a AS nb_ajoutes, u AS nb_mis_a_jour, s AS nb_doublons FROM n, b"""

_JOURNAL = f"""WITH {_LOG},
{_CLASSES},
n AS (
  SELECT day, count(*) AS rows, count(*) FILTER (class = 'a') AS a, count(*) FILTER (class = 'u') AS u, count(*) FILTER (class = 's') AS s
  FROM classes GROUP BY day),
r AS (SELECT *, CAST(sum(a) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS after FROM n)
SELECT day AS horodatage, rows AS nb_nouveaux, a AS nb_ajoutes, u AS nb_mis_a_jour, s AS nb_doublons,
       after AS nb_apres_fusion, after - a AS nb_avant_fusion FROM r"""

# Both landings merge into an empty table: one row per key, keyless ones all.
_STREAMED = f"""WITH {_LOG},
versioned AS (SELECT *, CASE WHEN fresh THEN 2 ELSE 1 END AS version FROM log)
SELECT uid, CAST(min(version) AS BIGINT) AS version, arg_max(event_type, pos) AS event_type FROM versioned WHERE uid IS NOT NULL GROUP BY uid
UNION ALL SELECT uid, CAST(version AS BIGINT), event_type FROM versioned WHERE uid IS NULL"""

_STREAM_JOURNAL = f"""WITH {_LOG},
{_CLASSES},
n AS (
  SELECT CASE WHEN fresh THEN 2 ELSE 1 END AS v, count(*) AS rows, count(*) FILTER (class = 'a') AS a,
         count(*) FILTER (class = 'u') AS u, count(*) FILTER (class = 's') AS s FROM classes GROUP BY 1),
r AS (SELECT *, CAST(sum(a) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS BIGINT) AS after FROM n)
SELECT CAST(v AS BIGINT) AS version, rows AS nb_nouveaux, after - a AS nb_avant_fusion, after AS nb_apres_fusion, a AS nb_ajoutes,
       u AS nb_mis_a_jour, s AS nb_doublons FROM r"""

# --------------------------------------------------------------- answers

_HITS = f"""{_PAIRS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rank FROM pairs),
hits AS (
  SELECT r.query_id, r.rank, r.vec_id, 1 / (1 + r.d) AS score, source AS titre, text AS description, lang AS ville,
         CAST(n_chars AS VARCHAR) AS date_debut, CAST(NULL AS VARCHAR) AS date_fin,
         CASE WHEN lang = 'fr' THEN source END AS lieu_nom, CASE WHEN lang = 'en' THEN '' ELSE lang END AS categorie
  FROM ranked r JOIN documents ON doc_id = vec_id WHERE r.rank <= 5),
questions AS (SELECT vec_id AS query_id, 'Que trouver près de ' || vec_id || ' ?' AS question FROM embeddings)"""

_BLOCK = "'Événement ' || rank || ':' || chr(10) || " + " || ".join(
    f"'{label}: ' || coalesce({name}, 'N/A') || chr(10)" for label, name in prompts.HIT_FIELDS
) + " || 'Score de pertinence: ' || printf('%.2f', score) || chr(10)"

_HIT_LINES = ", ".join(f"'{label}: ' || nullif({name}, '')" for label, name in prompts.HIT_FIELDS)

_GROUNDED = f"""{_HITS},
contexts AS (SELECT query_id, string_agg({_BLOCK}, chr(10) ORDER BY rank) AS context, count(*) AS n FROM hits GROUP BY query_id),
prompted AS (
  SELECT q.query_id, question, CAST(coalesce(n, 0) AS INTEGER) AS nb_events_retrieved,
    {_text(prompts.INSTRUCTIONS)} || chr(10) || chr(10) || {_text(prompts.CONTEXT_TITLE)} || chr(10) || chr(10)
    || coalesce(context, {_text(prompts.NO_EVENT)}) || chr(10) || chr(10) || {_text(prompts.QUESTION_TITLE)} || chr(10) || question
    || chr(10) || chr(10) || {_text(prompts.ANSWER_TITLE)} || chr(10) || {_text(prompts.ANSWER_RULE)} AS prompt
  FROM questions q LEFT JOIN contexts c ON q.query_id = c.query_id)"""

_SIMPLE = f"""WITH {_HITS},
contexts AS (
  SELECT query_id, string_agg(rank || '. ' || titre || ' - ' || ville || ' - ' || date_debut, chr(10) || chr(10) ORDER BY rank) AS context,
         count(*) AS n FROM hits GROUP BY query_id)
SELECT q.query_id, question, CAST(coalesce(n, 0) AS INTEGER) AS nb_events_retrieved,
  CASE WHEN context IS NULL THEN 'Question: ' || question || chr(10) || chr(10) || {_text(prompts.NO_EVENT)}
  ELSE {_text(prompts.SIMPLE_TITLE)} || chr(10) || chr(10) || context || chr(10) || chr(10) || 'Question : ' || question
       || chr(10) || chr(10) || {_text(prompts.SIMPLE_RULE)} END AS prompt
FROM questions q LEFT JOIN contexts c ON q.query_id = c.query_id"""

# Feature hashing: the words of a text, their signed places, and their sums.
_DIM = 32


def _features(text: str) -> str:
    """Columns ``words`` and ``codes`` of a text."""
    words = f"regexp_extract_all(lower(coalesce({text}, '')), '[a-z0-9\\x{{e0}}-\\x{{ff}}]+')"
    place = f"('0x' || substr(md5(w), 1, 4))::INTEGER % {_DIM}"
    code = f"CASE WHEN ('0x' || substr(md5(w), 5, 1))::INTEGER < 8 THEN {place} ELSE -1 - {place} END"
    return f"len({words}) AS words, list_transform({words}, lambda w: {code}) AS codes"


_VECTOR = f"list_transform(range({_DIM}), lambda i: len(list_filter(codes, lambda c: c = i)) - len(list_filter(codes, lambda c: c = -1 - i)))"

_DOCUMENT_VECTORS = f"""
embedded AS (SELECT id, words, digest, {_VECTOR} AS v FROM (SELECT doc_id AS id, sha256(coalesce(text, '')) AS digest, {_features('text')} FROM documents))"""

_ASKED_BENCHMARK = f"""
asked AS (SELECT item_id AS query_id, text AS question FROM benchmark WHERE {_visible('text')} AND lower({_collapse('text')}) NOT IN ('quit', 'exit', 'q'))"""


def _nearest(asked: str, key: str, known: str, k: int = 5) -> str:
    """CTEs up to ``near``: query_id, rank, id, d of the nearest of ``known``."""
    return f"""asking AS (SELECT {key}, {_VECTOR} AS v FROM (SELECT {key}, {_features('question')} FROM {asked})),
distances AS (
  SELECT a.{key}, b.id, list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d FROM asking a, {known} b),
near AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY d, id) AS rank FROM distances QUALIFY rank <= {k})"""


_CORPUS_PROMPTS = f"""WITH {_CLEAN},
embedded AS (SELECT id, {_VECTOR} AS v FROM (SELECT id, {_features('texte_complet')} FROM clean)),
{_ASKED_BENCHMARK},
{_nearest('asked', 'query_id', 'embedded')},
hits AS (
  SELECT query_id, rank, 1 / (1 + d) + 1e-9 AS score, titre, description, ville, date_debut, date_fin, adresse AS lieu_nom, categories AS categorie
  FROM near JOIN clean USING (id)),
contexts AS (SELECT query_id, string_agg({_BLOCK}, chr(10) ORDER BY rank) AS context, count(*) AS n FROM hits GROUP BY query_id)
SELECT q.query_id, question, CAST(coalesce(n, 0) AS INTEGER) AS nb_events_retrieved,
    {_text(prompts.INSTRUCTIONS)} || chr(10) || chr(10) || {_text(prompts.CONTEXT_TITLE)} || chr(10) || chr(10)
    || coalesce(context, {_text(prompts.NO_EVENT)}) || chr(10) || chr(10) || {_text(prompts.QUESTION_TITLE)} || chr(10) || question
    || chr(10) || chr(10) || {_text(prompts.ANSWER_TITLE)} || chr(10) || {_text(prompts.ANSWER_RULE)} AS prompt
FROM asked q LEFT JOIN contexts c USING (query_id)"""

_ANSWERED = f"""WITH {_DOCUMENT_VECTORS},
{_ASKED_BENCHMARK},
{_nearest('asked', 'query_id', 'embedded')},
answers AS (
  SELECT query_id, string_agg('Titre: ' || source, ' / ' ORDER BY rank) AS answer, string_agg(id::VARCHAR, ',' ORDER BY rank) AS sources, count(*) AS n
  FROM near JOIN documents ON doc_id = id GROUP BY query_id)"""

# The evaluation questions once more.
_GOLDEN = """
golden(question_group, question, keywords, nb, event, type) AS (VALUES
  ('questions_simples', 'Quels sont les événements à Châtellerault ?', ['châtellerault', 'événement'], 5, NULL, NULL),
  ('questions_simples', 'Y a-t-il des visites guidées ?', ['visite', 'guidée'], 5, NULL, NULL),
  ('questions_simples', 'Quels événements sont gratuits ?', ['gratuit', 'libre'], 5, NULL, NULL),
  ('questions_specifiques', 'Parle-moi du Carillon Bollée', ['carillon', 'bollée'], NULL, 'Visite du Carillon Bollée', NULL),
  ('questions_specifiques', 'Quels sont les horaires de la Manu ?', ['manu', 'horaire'], NULL, 'Visite de la Manu', NULL),
  ('questions_temporelles', 'Quels événements en avril 2026 ?', ['avril', '2026'], 5, NULL, NULL),
  ('questions_temporelles', 'Que faire ce week-end ?', ['week-end', 'samedi', 'dimanche'], 5, NULL, NULL),
  ('questions_negatives', 'Y a-t-il des concerts de rock ?', NULL, NULL, NULL, ['negative', 'limited']),
  ('questions_negatives', 'Quels événements à Paris ?', NULL, NULL, NULL, ['limited']))"""

_EVALUATED = f"""WITH {_DOCUMENT_VECTORS},
{_GOLDEN},
{_nearest('golden', 'question', 'embedded')},
answers AS (
  SELECT question, string_agg('Titre: ' || source, ' / ' ORDER BY rank) AS answer, list(source) AS titles, count(*) AS n
  FROM near JOIN documents ON doc_id = id GROUP BY question),
scored AS (
  SELECT *, CASE WHEN n = 0 THEN 'negative' WHEN n < 5 THEN 'limited' ELSE 'full' END AS kind,
         len(list_filter(keywords, lambda w: contains(lower(answer), w))) AS found FROM golden JOIN answers USING (question))
SELECT question_group, question, answer, CAST(n AS INTEGER) AS nb_events_retrieved, CAST(found AS INTEGER) AS nb_found, round(found / len(keywords), 4) AS recall,
       n >= nb AS count_met, CASE WHEN event IS NOT NULL THEN list_contains(titles, event) END AS event_met, kind AS answer_type,
       CASE WHEN type IS NOT NULL THEN list_contains(type, kind) END AS type_met FROM scored"""

_CHANGED = f"""WITH {_LOG},
{_CLASSES},
known AS (SELECT g.uid, g.payload FROM log g JOIN target t ON g.uid = t.uid AND g.pos = t.pos),
newest AS (SELECT uid, arg_max(payload, pos) AS payload FROM log WHERE NOT fresh AND uid IS NOT NULL GROUP BY uid),
n AS (
  SELECT CASE WHEN fresh THEN 2 ELSE 1 END AS version, count(*) AS nb_nouveaux, count(*) FILTER (class = 'a') AS nb_ajoutes,
         count(*) FILTER (class = 'u') AS nb_mis_a_jour FROM classes GROUP BY 1)
SELECT CAST(version AS BIGINT) AS version, nb_nouveaux, nb_ajoutes, nb_mis_a_jour,
  CASE WHEN version = 1 THEN nb_ajoutes ELSE (SELECT count(*) FROM log WHERE fresh AND uid IS NULL)
    + (SELECT count(*) FROM latest l LEFT JOIN newest k ON k.uid = l.uid WHERE k.uid IS NULL OR k.payload <> l.payload) END AS changed FROM n"""

_CURSORS = """WITH pages AS (SELECT c_custkey // 20 AS page, count(*) AS n, max(c_custkey) AS top FROM customer GROUP BY 1),
ends AS (SELECT *, max(page) OVER () AS last, page * 3 // (max(page) OVER () + 1) AS part FROM pages),
taken AS (SELECT part + 1 AS seq, * FROM ends UNION ALL SELECT 4, * FROM ends WHERE part = 0),
saved AS (
  SELECT seq, sum(n) AS n, max(last) + 1 AS total,
         CASE WHEN max(page) < max(last) THEN (max(page) + 1) || ',' || max(top) END AS after FROM taken GROUP BY seq)
SELECT CAST(seq AS BIGINT) AS seq, after AS curseur_after, CAST(n AS INTEGER) AS nb_agendas_session, CAST(total AS INTEGER) AS total_agendas_api,
       after IS NULL AS fin_de_liste, (SELECT after FROM saved ORDER BY seq DESC LIMIT 1) AS next_after FROM saved"""

_TOP_CITIES = "(SELECT string_agg(ville || ':' || n, '|' ORDER BY n DESC, ville) FROM (SELECT ville, count(*) AS n FROM clean GROUP BY ville ORDER BY n DESC, ville LIMIT {}))"

_FILLED = ", ".join(
    f"printf('%.1f', {_rate(_visible(c))}) || '%' AS {c}" for c in [x.strip() for x in _COLUMNS.split(",")] + ["texte_complet"]
)

ORACLES = {
    "corpus_prompts": _CORPUS_PROMPTS,
    "answer_batch": f"""{_ANSWERED} SELECT query_id, answer, CAST(NULL AS VARCHAR) AS answer_error, CAST(n AS INTEGER) AS nb_events_retrieved,
        CAST(n AS INTEGER) AS nb_events_used, 'first-lines' AS model, 0.3::DOUBLE AS temperature, sources FROM answers""",
    "answer_run": f"""{_ANSWERED} SELECT query_id, (SELECT count(*) FROM asked) AS nb_asked, (SELECT count(*) FROM answers) AS nb_found,
        (SELECT CAST(sum(n) AS BIGINT) FROM answers) AS nb_hits, CAST(0 AS BIGINT) AS nb_failed, true AS adds_up FROM answers""",
    "golden_evaluation": _EVALUATED,
    "embed_features": f"WITH {_DOCUMENT_VECTORS} SELECT id, array_to_string(v, ',') AS embedding, words AS tokens, digest AS text_digest FROM embedded",
    "array_files": """SELECT doc_id, md5(text) AS text, lang || ' ],[{"' AS more FROM documents""",
    "resumed_cursor": _CURSORS,
    "compacted_table": _STREAMED,
    "merge_changes": _CHANGED,
    "replayed_batches": """SELECT v AS version, n AS nb_nouveaux, CASE WHEN v = 1 THEN 0 ELSE n END AS nb_avant_fusion, n AS nb_apres_fusion,
        CASE WHEN v = 1 THEN n ELSE 0 END AS nb_ajoutes, CAST(0 AS BIGINT) AS nb_mis_a_jour, CASE WHEN v = 1 THEN 0 ELSE n END AS nb_doublons,
        CASE WHEN v = 1 THEN n ELSE 0 END AS changed, CASE WHEN v > 1 THEN CAST(1 AS BIGINT) END AS rejoue
        FROM (SELECT count(*) AS n FROM customer), range(1, 6) r(v)""",
    "list_versions": """SELECT 'processed' AS kind, r_name AS fichier, CAST(row_number() OVER (ORDER BY r_name DESC) AS INTEGER) AS place,
        true AS filled FROM region UNION ALL SELECT 'raw', 'version=' || lpad(v::VARCHAR, 10, '0'), CAST(row_number() OVER (ORDER BY v DESC) AS INTEGER), true
        FROM (SELECT DISTINCT CASE WHEN coalesce(ts >= TIMESTAMP '2024-01-16', true) THEN 2 ELSE 1 END AS v FROM events)""",
    "knn_lsh_full": _KNN,
    "knn_known_only": _knn(
        select="query_id, CAST(rank AS INTEGER) AS rank, hits.vec_id, round(d, 4) AS distance, label",
        tail="JOIN embeddings e ON e.vec_id = hits.vec_id WHERE label < 5",
    ),
    "index_failed_append": f"""WITH {_PAIRS},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rank FROM pairs WHERE vec_id % 2 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(d, 4) AS distance, 'titre' AS titre FROM ranked WHERE rank <= 5""",
    "index_published": _knn(
        select="query_id, CAST(rank AS INTEGER) AS rank, hits.vec_id, round(d, 4) AS distance, label",
        tail="JOIN embeddings e ON e.vec_id = hits.vec_id",
    ),
    "knn_flat_l2": _KNN,
    "knn_flat_blocks": _KNN,
    "knn_ivf_full_probe": _KNN,
    "index_add": _KNN,
    "index_roundtrip": _KNN,
    "knn_flat_ip": _IP,
    "knn_with_metadata": _knn(
        select="query_id, CAST(rank AS INTEGER) AS rank, hits.vec_id, round(d, 4) AS distance, round(1 / (1 + d), 4) AS score, label",
        tail="JOIN embeddings e ON e.vec_id = hits.vec_id",
    ),
    "knn_join_batch": _knn(
        10, select="query_id, count(*) AS nb_events_retrieved, round(max(d), 4) AS farthest", tail="GROUP BY query_id"
    ),
    "pair_distances": _NEXT,
    "index_stats": """SELECT CAST(max(len(embedding)) AS INTEGER) AS dimension, count(*) AS nombre_vecteurs, 'flat_l2' AS type_index,
        true AS is_trained, count(*) AS nb_metadata, true AS coherent FROM embeddings""",
    "index_coherence": """SELECT coalesce(v.vec_id, doc_id) AS vec_id, CAST(v.vec_id IS NOT NULL AS BIGINT) AS n_left,
        CAST(doc_id IS NOT NULL AS BIGINT) AS n_right FROM embeddings v FULL JOIN documents ON v.vec_id = doc_id
        WHERE v.vec_id IS NULL OR doc_id IS NULL""",
    "dimension_check": "SELECT count(*) AS n, CAST(max(len(embedding)) AS INTEGER) AS dimension FROM embeddings",
    "html_clean": f"SELECT page_id, {_html('html')} AS text FROM pages",
    "whitespace_normalize": f"SELECT doc_id, {_collapse('text')} AS text FROM documents",
    "compose_text": """SELECT c_custkey, concat_ws(chr(10), 'Titre: ' || c_name, 'Description: ' || c_mktsegment,
        CASE WHEN c_acctbal > 0 THEN NULL ELSE 'Détails: ' || c_mktsegment || ' / ' || n_name END,
        'Lieu: ' || n_name || CASE WHEN c_acctbal > 0 THEN ', ' || r_name ELSE '' END, 'Date de début: 2024-01-01',
        CASE WHEN c_acctbal > 0 THEN NULL ELSE 'Date de fin: 2024-02-01' END,
        CASE WHEN c_acctbal > 0 THEN NULL ELSE 'Catégories: ' || r_name END) AS texte_complet
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "language_pick": "SELECT doc_id, CASE WHEN lang IN ('fr', 'en') THEN text ELSE source END AS text FROM documents",
    "keywords_join": """SELECT doc_id, CASE lang WHEN 'fr' THEN 'fr, ' || source WHEN 'en' THEN source || ', en' WHEN 'de' THEN source
        ELSE '' END AS categories FROM documents""",
    "wallclock_date": """SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'signup') THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
        WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.123+02:00' ELSE strftime(ts, '%Y-%m-%d') END AS date_debut
        FROM events""",
    "build_url": f"""SELECT c_custkey, CASE WHEN c_acctbal >= 9000 THEN '' ELSE '{BASE_URL}/' || CASE WHEN c_acctbal > 0
        THEN lower(c_mktsegment) || '/' ELSE '' END || 'events/' || lower(c_name) END AS url FROM customer""",
    "json_project": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        coalesce(json_extract_string(props, '$.missing'), '') AS missing FROM events""",
    "error_excerpt": f"SELECT doc_id, {_excerpt('text')} AS texte FROM documents",
    "sanitized_texts": f"""WITH t AS (SELECT source, CASE WHEN quality = 1 THEN text ELSE '' END AS clean
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
        SELECT source, count(*) AS total, count(*) FILTER (NOT {_visible('clean')}) AS blank, CAST(sum(length(clean)) AS BIGINT) AS chars
        FROM t GROUP BY source""",
    "metadata_projection": """SELECT CASE WHEN lang <> 'de' THEN 'd' || doc_id ELSE CAST(doc_id * 2 AS VARCHAR) END AS id, source AS titre,
        CASE WHEN lang = 'fr' THEN lang ELSE '' END AS ville, '' AS date_debut, '' AS url, doc_id * 2 AS index FROM documents""",
    "extract_events": f"WITH {_RAW} SELECT {_COLUMNS}, {_COMPOSED} FROM raw",
    "malformed_events": "SELECT doc_id FROM documents WHERE lang = 'de'",
    "clean_events": f"WITH {_CLEAN} SELECT * FROM clean",
    "clean_csv_roundtrip": f"WITH {_CLEAN} SELECT * FROM clean",
    "rejection_counts": _REJECTED,
    "dedup_keep_first": """SELECT doc_id, source, n_chars FROM documents
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "display_sample": f"""WITH {_CLEAN} SELECT id, titre, ville, date_debut, date_fin, url, substr(description, 1, 100) || '...' AS description,
        categories FROM clean ORDER BY date_debut, id LIMIT 10""",
    "value_counts_top10": "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 10",
    "value_counts_roles": "SELECT role, count(*) AS n FROM conversations GROUP BY role ORDER BY n DESC, role LIMIT 20",
    "length_stats": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(min(length({c})) AS INTEGER) AS min, CAST(max(length({c})) AS INTEGER) AS max,
        CAST(trunc(avg(length({c}))) AS INTEGER) AS mean FROM documents"""
        for c in ("text", "lang", "source")
    ),
    "distinct_counts": "SELECT count(*) AS rows, count(DISTINCT user_id) AS distinct_values FROM events",
    "fill_rates": _rates(_visible("$")),
    "fill_rates_strict": _rates("coalesce($ <> '', false)"),
    "fill_rates_not_empty": _rates("coalesce($ <> '', true)"),
    "corpus_summary": f"""WITH {_CLEAN} SELECT count(*) AS nombre_total, count(DISTINCT ville) AS nombre_villes,
        CAST(trunc(avg(length(description))) AS INTEGER) AS longueur_moyenne_description,
        CAST(trunc(avg(length(texte_complet))) AS INTEGER) AS longueur_moyenne_texte_complet,
        CAST({_rate("categories <> ''")} AS DOUBLE) AS taux_avec_categories,
        CAST({_rate("description_longue <> ''")} AS DOUBLE) AS taux_avec_description_longue,
        CAST({_rate("date_debut <> ''")} AS DOUBLE) AS taux_avec_date_debut, CAST({_rate("url <> ''")} AS DOUBLE) AS taux_avec_url,
        {_TOP_CITIES.format(10)} AS top_villes FROM clean""",
    "statistics_document": f"""WITH {_CLEAN} SELECT count(*) AS nombre_evenements, '{_COLUMNS.replace(" ", "")},texte_complet' AS colonnes, {_FILLED},
        CAST(min(length(description)) AS INTEGER) AS description_min, CAST(max(length(description)) AS INTEGER) AS description_max,
        CAST(trunc(avg(length(description))) AS INTEGER) AS description_moyenne,
        CAST(min(length(texte_complet)) AS INTEGER) AS texte_complet_min, CAST(max(length(texte_complet)) AS INTEGER) AS texte_complet_max,
        CAST(trunc(avg(length(texte_complet))) AS INTEGER) AS texte_complet_moyenne,
        '100.0%' AS taux_avec_dates, '100.0%' AS taux_avec_url, {_TOP_CITIES.format(20)} AS villes_principales FROM clean""",
    "upsert_merge": f"WITH {_MERGED} SELECT uid, pos, payload FROM merged",
    "upsert_merge_by_content": f"""WITH {_MERGED} SELECT uid, count(*) AS n FROM merged WHERE uid IS NOT NULL GROUP BY uid
        UNION ALL SELECT NULL, count(*) FROM log WHERE uid IS NULL AND NOT fresh""",
    "upsert_report": _REPORT,
    "session_journal": _JOURNAL,
    "anti_join_new": """SELECT doc_id AS id, n_chars FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "anti_join_changed": """SELECT doc_id AS id, n_chars FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1)""",
    "vector_append": """SELECT doc_id AS id, quality FROM labels UNION ALL SELECT doc_id, -1 FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "page_limit": """SELECT user_id, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 30""",
    "collection_summary": """WITH n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
        SELECT count(*) AS agendas, count(*) FILTER (n > 0 AND c_acctbal > 0) AS agendas_avec_evenements,
        count(*) FILTER (c_acctbal <= 0) AS agendas_sans_uid, CAST(coalesce(sum(n) FILTER (c_acctbal > 0), 0) AS BIGINT) AS evenements
        FROM customer LEFT JOIN n ON o_custkey = c_custkey""",
    "landed_events": """SELECT CAST(l_orderkey AS VARCHAR) AS agenda_uid, l_linenumber, l_partkey, l_quantity
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) <= 3""",
    "landed_agendas": "SELECT CAST(c_custkey AS VARCHAR) AS uid, c_name AS title FROM customer WHERE c_custkey % 20 < 15",
    "landed_cursor": """SELECT CAST(max(c_custkey) // 20 + 1 AS VARCHAR) || ',' || max(c_custkey) AS curseur_after,
        CAST(count(*) AS INTEGER) AS nb_agendas_session, CAST(count(*) AS INTEGER) AS total_agendas_api FROM customer""",
    "vector_table_roundtrip": "SELECT doc_id AS id, sha256(text) AS text_digest, 64 AS dimension FROM documents",
    "stream_upsert": _STREAMED,
    "stream_journal": _STREAM_JOURNAL,
    "embed_hash": f"""WITH {_DOCUMENT_VECTORS} SELECT id, array_to_string(v, ',') AS embedding, words AS tokens, CAST(NULL AS VARCHAR) AS embed_error
        FROM embedded""",
    "embedding_stats": f"""WITH {_DOCUMENT_VECTORS} SELECT count(*) AS total_events, CAST(sum(words) AS BIGINT) AS total_tokens, 2.0::DOUBLE AS total_time,
        2.0 / count(*) AS temps_moyen, CAST(0 AS BIGINT) AS errors, 64 AS batch_size, 32 AS dimension, count(*) AS nombre_embeddings,
        'hashing' AS modele FROM embedded""",
    "embed_errors": f"""SELECT doc_id AS index, {_excerpt('text')} AS texte, 'refused' AS erreur FROM documents WHERE contains(text, '1')""",
    "embed_incremental": """SELECT d.doc_id AS id, CASE WHEN l.doc_id IS NULL THEN 2 ELSE 1 END AS dimension,
        CASE WHEN l.doc_id IS NULL THEN CAST(length(text) AS INTEGER) ELSE 0 END AS last
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "askable_questions": f"""SELECT conv_id, turn, text AS question FROM conversations WHERE role <> 'system' AND turn <> 1
        AND {_visible('text')} AND lower(trim(text)) NOT IN ('quit', 'exit', 'q')""",
    "hit_documents": f"""WITH {_HITS} SELECT query_id, CAST(rank AS INTEGER) AS rank, concat_ws(chr(10), {_HIT_LINES}) AS page_content FROM hits""",
    "context_prompt": f"WITH {_GROUNDED} SELECT query_id, question, nb_events_retrieved, prompt FROM prompted",
    "simple_prompt": _SIMPLE,
    "generated_answers": f"""WITH {_GROUNDED} SELECT query_id, length(prompt) || ' caractères' AS answer, nb_events_retrieved FROM prompted""",
    "label_agreement_at_k": _knn(
        select="query_id, count(*) AS nb_hits, count(*) FILTER (a.label = b.label) AS nb_agreeing",
        tail="JOIN embeddings a ON a.vec_id = query_id JOIN embeddings b ON b.vec_id = hits.vec_id GROUP BY query_id",
    ),
    "keyword_recall": """WITH asked AS (
          SELECT conv_id, turn, list_distinct(list_filter(string_split(lower(text), ' '), lambda w: length(w) >= 8)) AS words
          FROM conversations WHERE role = 'user'),
        paired AS (SELECT a.*, lower(c.text) AS answer FROM asked a JOIN conversations c
          ON c.conv_id = a.conv_id AND c.turn = a.turn + 1 AND c.role = 'assistant'),
        scored AS (SELECT conv_id, turn, len(words) AS n, len(list_filter(words, lambda w: contains(answer, w))) AS f FROM paired)
        SELECT conv_id, turn, CAST(CASE WHEN n > 0 THEN n END AS INTEGER) AS nb_expected, CAST(CASE WHEN n > 0 THEN f END AS INTEGER) AS nb_found,
        CASE WHEN n > 0 THEN round(f / n, 4) END AS recall FROM scored""",
    "hit_at_k": f"""WITH {_HITS} SELECT q.query_id, d.source AS expected_event, CAST(min(h.rank) AS INTEGER) AS hit_rank,
        min(h.rank) IS NOT NULL AS hit FROM questions q JOIN documents d ON d.doc_id = q.query_id
        LEFT JOIN hits h ON h.query_id = q.query_id AND h.titre = d.source WHERE d.lang <> 'de' GROUP BY q.query_id, d.source""",
}
