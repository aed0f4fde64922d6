"""The operators of this subpackage as queries over the shared tables, with SQL.

Each query reads whole tables; ``ORACLES`` holds the same result as DuckDB SQL
where SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from recueil.llm import (
    decontaminate, divergence, fixity, host_rules, jaccard, licenses, line_quality, mixing, simhash, suffix_dedup, token_counts, trie,
    url_filter,
)
from recueil.llm.common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


@query
def op2_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_quality.quality_scores(docs, line_quality.fitted(docs, table(spark, folder, "labels")))


@query
def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = suffix_dedup.without_repeats(table(spark, folder, "documents").select("doc_id", "text"), as_text=True)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept").alias("text"))


@query
def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.license_scan(table(spark, folder, "documents"))
    joined = {c: F.concat_ws("|", c) for c in ("sentence_ids", "licenses", "kinds")}
    return found.withColumns(joined).select("doc_id", *joined, "usable")


@query
def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mixed(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _every(column: str, n: int) -> str:
    """SQL of both engines: one in n, by the id."""
    return f"coalesce({column}, 0) % {n} = 0"


@query
def op9_fixity_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Audits a replica that lost every 61st page and has a wrong first byte in
    every 53rd."""
    pages = table(spark, folder, "pages")
    html = F.coalesce("html", F.lit(""))
    hurt = F.when(F.expr(_every("page_id", 53)), F.overlay(html, F.lit("~"), 1, 1)).otherwise(html)
    original = fixity.warc_record(F.col("page_id"), F.col("url"), html)
    replica = F.when(~F.expr(_every("page_id", 61)), fixity.warc_record(F.col("page_id"), F.col("url"), hurt))
    laid = stored(fixity.laid_out(fixity.record_table(pages, digest=original, replica=replica)), "warc")
    there = laid.filter("replica IS NOT NULL").select("file", "offset", F.col("replica").alias("digest"))
    found = fixity.audit(laid.select("file", "offset", "digest"), there)
    kind = F.when(F.col("replica_digest").isNull(), "missing").otherwise("changed").alias("damage")
    named = found.join(laid.select("file", "offset", "page_id", "length"), ["file", "offset"])
    return named.select("page_id", kind, "length", "original_digest", "replica_digest")


@query
def op10_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    done = host_rules.quality_table(table(spark, folder, "documents"))
    return done.select("doc_id", *host_rules.MEASURES, "base_failed", "kept")


@query
def op11_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_join(table(spark, folder, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))


@query
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


# ------------------------------------------------------------------- the SQL

_WORD = r"[^\x20\x09-\x0D]+"

# Fixed values, spelled out apart from the code under test.
_KNOWN = {
    "licensed under the apache license version 2 0": ("apache-2.0-notice", "apache-2.0", "permissive"),
    "released under the mit license": ("mit-notice", "mit", "permissive"),
    "this work is licensed under the gnu general public license version 3": ("gpl-3.0-notice", "gpl-3.0", "copyleft"),
    "licensed under cc by nc 4 0": ("cc-by-nc-4.0-notice", "cc-by-nc-4.0", "noncommercial"),
    "all rights reserved": ("reserved", "all-rights-reserved", "proprietary"),
}
ORACLES["op6_license_scan"] = f"""
WITH known(sentence, id, license, kind) AS (VALUES {", ".join(f"('{s}', '{i}', '{n}', '{k}')" for s, (i, n, k) in _KNOWN.items())}),
parts AS (
    SELECT rowid AS r, unnest(list_zip(x, range(len(x)))) AS p FROM (
        SELECT row_number() OVER () AS rowid, regexp_split_to_array(coalesce(text, ''), '\\n+|[.!?]+[ \\t]+') AS x FROM documents
    )
),
found AS (
    SELECT r, list(id ORDER BY p[2]) AS ids, list_sort(list_distinct(list(license))) AS licenses,
           list_sort(list_distinct(list(kind))) AS kinds
    FROM parts JOIN known ON sentence = trim(regexp_replace(lower(p[1]), '[^a-z0-9]+', ' ', 'g')) GROUP BY r
)
SELECT doc_id, coalesce(array_to_string(ids, '|'), '') AS sentence_ids, coalesce(array_to_string(licenses, '|'), '') AS licenses,
       coalesce(array_to_string(kinds, '|'), '') AS kinds, kinds = ['permissive'] AS usable
FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) LEFT JOIN found USING (r)
"""

ORACLES["op7_mix_sources"] = f"""
WITH RECURSIVE sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 9))::BIGINT AS place
    FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, 3.0 * sum(size)::DOUBLE AS cap,
           ([5.0, 2.0, 1.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
    FROM sizes GROUP BY source
),
levels AS (
    SELECT *, ((SELECT sum(source_size) FROM sources)::DOUBLE - coalesce(sum(cap) OVER before, 0))
              / ((SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER before, 0)) AS level
    FROM sources WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
aims AS (
    SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
    FROM (
        SELECT source, source_size,
               least(cap, coalesce((SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight LIMIT 1), 0) * weight) AS target
        FROM levels
    )
),
ends AS (
    SELECT s.doc_id, s.size, s.place, a.source_size, a.target, a.whole, a.target - a.whole * a.source_size AS rest,
           sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place) AS upto,
           sum(s.size) OVER (PARTITION BY s.source, s.place) AS tied
    FROM sizes s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN upto <= rest OR (upto - tied <= rest AND 2 * (rest - (upto - tied)) >= tied) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ends
"""

def _reputations(tag: str, counted: str) -> str:
    """CTEs up to ``low_<tag>``: host and the lower bound of its reputation, from
    the outcomes of the pages for which ``counted`` holds."""

    def strength(level: str) -> str:
        more = "sum(n * pow(k / n - mean, 2) - mean * (1 - mean)) FILTER (WHERE n > 0) OVER ()"
        free = "sum((n - 1) * mean * (1 - mean)) FILTER (WHERE n > 0) OVER ()"
        return f"SELECT *, 1 / least(greatest(coalesce({more} / nullif({free}, 0), 0.5), 0.001), 0.9) - 1 AS m FROM {level}"

    return f"""hosts_{tag} AS (
    SELECT *, string_split(host, '.') AS labels,
           CASE WHEN array_to_string(labels[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.in', 'co.nz') THEN 2 ELSE 1 END AS w,
           array_to_string(labels[-w:], '.') AS suffix, array_to_string(labels[-(w + 1):], '.') AS domain
    FROM (SELECT host, count(bad) FILTER ({counted}) AS n, count(*) FILTER (bad AND {counted}) AS k FROM outcomes GROUP BY host)
),
s0_{tag} AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 0.5) / (sum(n) + 1.0) FROM hosts_{tag}) AS mean FROM hosts_{tag} GROUP BY suffix),
s1_{tag} AS ({strength(f"s0_{tag}")}),
d0_{tag} AS (
    SELECT h.suffix, domain, sum(h.n) AS n, sum(h.k) AS k, any_value((s.k + s.mean * m) / (s.n + m)) AS mean
    FROM hosts_{tag} h JOIN s1_{tag} s USING (suffix) GROUP BY h.suffix, domain
),
d1_{tag} AS ({strength(f"d0_{tag}")}),
h0_{tag} AS (SELECT host, h.n, h.k, d.n AS dn, (d.k + d.mean * m) / (d.n + m) AS mean FROM hosts_{tag} h JOIN d1_{tag} d USING (suffix, domain)),
h1_{tag} AS ({strength(f"h0_{tag}")}),
low_{tag} AS (SELECT host, (k + mean * m) / (n + m) AS p, CASE WHEN dn > 0 THEN p - sqrt(p * (1 - p) / (n + m + 1)) ELSE 0 END AS low FROM h1_{tag})"""


ORACLES["op8_url_filter"] = f"""
WITH parts AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path, md5(coalesce(url, ''))[1] < '3' AS held
    FROM pages
),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM parts
),
outcomes AS (SELECT host, held, CASE WHEN rule IS NOT NULL THEN rule IN ('net/', 'example.com/de/') END AS bad FROM ruled),
{_reputations("fit", "NOT held")},
{_reputations("all", "true")},
limits(x) AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])::DOUBLE),
verdicts AS (
    SELECT x, count(*) FILTER (bad = (low > x)) AS good FROM limits LEFT JOIN (outcomes JOIN low_fit USING (host)) ON held AND bad IS NOT NULL GROUP BY x
),
chosen AS (SELECT x FROM verdicts ORDER BY good DESC, x DESC LIMIT 1)
SELECT page_id, r.host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN low > (SELECT x FROM chosen) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r JOIN low_all USING (host)
"""


def _record(html: str) -> str:
    crlf = "chr(13) || chr(10)"
    return (
        f"'WARC/1.1' || {crlf} || 'WARC-Type: resource' || {crlf} || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || {crlf}"
        f" || 'WARC-Target-URI: ' || coalesce(url, '') || {crlf} || 'Content-Type: text/html' || {crlf}"
        f" || 'Content-Length: ' || strlen({html}) || {crlf} || {crlf} || {html} || {crlf} || {crlf}"
    )


ORACLES["op9_fixity_audit"] = f"""
SELECT page_id, CASE WHEN {_every("page_id", 61)} THEN 'missing' ELSE 'changed' END AS damage,
       strlen({_record("html")})::BIGINT AS length, sha256({_record("html")}) AS original_digest,
       CASE WHEN NOT {_every("page_id", 61)} THEN sha256({_record("hurt")}) END AS replica_digest
FROM (SELECT page_id, url, coalesce(html, '') AS html, '~' || substr(coalesce(html, ''), 2) AS hurt FROM pages)
WHERE {_every("page_id", 61)} OR {_every("page_id", 53)}
"""

ORACLES["op10_host_rules"] = f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
listed AS (SELECT r, regexp_extract_all(text, '{_WORD}') AS w FROM rows),
windows AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM listed),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, x) > 1),
covered AS (SELECT r, count(DISTINCT i + d)::BIGINT AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS v(d) GROUP BY r),
measured AS (
    SELECT r, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')))
            - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')))))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM rows JOIN listed USING (r) LEFT JOIN covered USING (r)
),
flags AS (
    SELECT source, unnest([1, 2, 3, 4, 5]) AS rule, unnest([
        n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > word_chars, 5 * n_dup_lines > n_words,
        word_chars < 2 * n_words OR word_chars > 12 * n_words
    ])::INT AS bad FROM measured
),
counts AS (SELECT rule, source, count(*) AS n, sum(bad) AS k FROM flags GROUP BY ALL),
prior AS (
    SELECT rule, mean, 1 / least(greatest((sum(n * pow(k / n - mean, 2)) - mean * (1 - mean) * count(*)) / (mean * (1 - mean) * sum(n - 1)), 0.001), 0.9) - 1 AS m
    FROM counts JOIN (SELECT rule, (sum(k) + 0.5) / (sum(n) + 1.0) AS mean FROM counts GROUP BY rule) USING (rule) GROUP BY rule, mean
),
rates AS (SELECT source, n, m, (k + mean * m) / (n + m) AS p FROM counts JOIN prior USING (rule)),
verdicts AS (SELECT source, bool_or(p - 2 * sqrt(p * (1 - p) / (n + m + 1)) > 0.5) AS rejected FROM rates GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT rejected AS kept
FROM measured m JOIN verdicts v ON m.source IS NOT DISTINCT FROM v.source
"""


def _crc32(text: str) -> str:
    """The CRC-32 of an ASCII string, half a byte at a time."""
    table = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)

    def half(x: str) -> str:
        return f"xor({x} >> 4, ({table}::BIGINT[])[({x} & 15) + 1])"

    step = half(half("xor(a, b)"))
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {step}), 4294967295::BIGINT)"


ORACLES["op12_prefix_trie"] = f"""
WITH turns AS (
    SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
           length(coalesce(text, '')) AS chars
    FROM conversations WHERE conv_id IS NOT NULL
),
spoken AS (SELECT conv_id, list({{'said': said, 'chars': chars}} ORDER BY turn NULLS FIRST, said) AS own FROM turns GROUP BY conv_id),
headed AS (SELECT *, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM spoken),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS line
    FROM headed c LEFT JOIN spoken b ON b.conv_id = c.conv_id - c.conv_id % 100
),
prefixes AS (SELECT conv_id, depth, line[1:depth] AS path, len(line) = depth AS ends FROM (SELECT *, unnest(range(len(line) + 1)) AS depth FROM rebuilt)),
nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN depth > 0 THEN (count(*) - 1) * path[depth].chars ELSE 0 END AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY path, depth
),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
below AS (
    SELECT path[1:up] AS path, sum(saved) AS saved, count(*) FILTER (childless) AS leaves
    FROM (SELECT n.path, saved, c.n IS NULL AS childless, unnest(range(depth + 1)) AS up FROM nodes n LEFT JOIN children c ON c.path = n.path) GROUP BY 1
)
SELECT n.conv_id, n.depth, CASE WHEN n.depth > 0 THEN p.conv_id END AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
       b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN children c ON c.path = n.path LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""

ORACLES["op13_source_divergence"] = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM words GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term HAVING sum(docs) >= 10),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
pairs AS (SELECT DISTINCT lang, source FROM texts),
grid AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM pairs g JOIN kept k USING (lang)
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
shares AS (
    SELECT g.*, 1 + (1000000000 * (g.n + 2)::HUGEINT) // (sum(g.n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
           1 + (1000000000 * (k.n + 2)::HUGEINT) // (s.n + 2 * v) AS q
    FROM grid g JOIN kept k USING (lang, term) JOIN sizes s USING (lang)
),
valued AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM pairs a JOIN pairs b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN valued v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
""".replace("\\\\", "\\")
