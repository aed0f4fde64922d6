"""Text expressions.  All of them are native columns, so they stay inside
whole-stage code generation and never start a Python worker."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F

# Unicode white space plus the four information separators.
_SPACE = r"(?U)[\s\x1c-\x1f]"
_NOT_SPACE = r"(?U)[^\s\x1c-\x1f]"

# The entities that are decoded, in this order.
ENTITIES = [
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&eacute;", "é"),
    ("&egrave;", "è"),
    ("&ecirc;", "ê"),
    ("&agrave;", "à"),
    ("&acirc;", "â"),
    ("&ccedil;", "ç"),
    ("&ocirc;", "ô"),
    ("&ucirc;", "û"),
    ("&icirc;", "î"),
]

# Labels of the composed text.
TEXT_LABELS = {
    "titre": "Titre: ",
    "description": "Description: ",
    "description_longue": "Détails: ",
    "lieu": "Lieu: ",
    "date_debut": "Date de début: ",
    "date_fin": "Date de fin: ",
    "categories": "Catégories: ",
}

_OFFSET = r"(?:Z|[+-](?:[01]\d|2[0-3]):?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?)?$"
_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}" + _OFFSET
_ISO_SHORT = r"^(\d{4})-(\d{1,2})-(\d{1,2})T(\d{1,2}):(\d{1,2}):(\d{1,2})" + _OFFSET


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def filled(c: Column) -> Column:
    """True where the text is neither null nor empty; never null."""
    return F.coalesce(c != "", F.lit(False))


def not_blank(c: Column) -> Column:
    """True where the text holds at least one visible character; never null."""
    return F.coalesce(c.rlike(_NOT_SPACE), F.lit(False))


def collapse_spaces(c: Column) -> Column:
    """Runs of white space become one blank, outer blanks go."""
    return F.trim(F.regexp_replace(c, _SPACE + "+", " "))


def pick_language(
    raw: Column, languages: Sequence[str] = ("fr", "en"), fallback: str = "presence"
) -> Column:
    """Text of a multilingual field given as raw JSON.

    The first language *present* wins, even if its text is empty; then the
    first entry in document order.  ``fallback="non_empty"`` skips empty texts.
    A field that is no object is returned as it is, a missing one as ``''``.
    """
    if fallback not in ("presence", "non_empty"):
        raise ValueError(f"unknown fallback: {fallback!r}")

    def choose(by_lang: Column) -> Column:
        texts = F.map_values(by_lang)
        if fallback == "non_empty":
            named = [F.nullif(by_lang[lang], F.lit("")) for lang in languages]
            others = F.filter(texts, lambda t: t != "")
            chosen = F.coalesce(*named, F.try_element_at(others, F.lit(1)), F.lit(""))
        else:
            chosen = F.when(F.size(by_lang) == 0, F.lit(""))
            for lang in languages:
                chosen = chosen.when(F.map_contains_key(by_lang, lang), by_lang[lang])
            chosen = chosen.otherwise(F.try_element_at(texts, F.lit(1)))
        return F.when(by_lang.isNull(), raw).otherwise(chosen)

    as_map = F.from_json(raw, "map<string,string>")
    return F.when(raw.startswith("{"), _once(as_map, choose)).otherwise(F.coalesce(raw, F.lit("")))


def join_keywords(raw: Column, language: str = "fr") -> Column:
    """Keywords given as raw JSON, joined by commas.

    Accepts an object of lists per language, a plain list, or a plain string,
    which counts as a list of one.
    """
    def joined(items: Column) -> Column:
        listed = F.array_join(F.from_json(items, "array<string>"), ", ")
        return F.when(items.startswith("["), F.coalesce(listed, items)).otherwise(items)

    per_language = F.from_json(raw, f"`{language}` string")[language]
    object_or_list = F.when(raw.startswith("{"), _once(per_language, joined)).otherwise(joined(raw))
    return F.coalesce(object_or_list, F.lit(""))


def wall_clock(c: Column) -> Column:
    """ISO 8601 text as ``YYYY-MM-DD HH:MM:SS`` without moving the clock.

    An offset is dropped, not applied.  Text in any other form, or naming an
    impossible date, comes back unchanged; a missing one as ``''``.
    """
    text = F.replace(c, F.lit(".000"), F.lit(""))
    day_time = F.concat(F.substring(text, 1, 10), F.lit(" "), F.substring(text, 12, 8))
    part = lambda i: F.lpad(F.regexp_extract(text, _ISO_SHORT, i), 2, "0")
    padded = F.concat(
        F.regexp_extract(text, _ISO_SHORT, 1),
        F.lit("-"), part(2), F.lit("-"), part(3),
        F.lit(" "), part(4), F.lit(":"), part(5), F.lit(":"), part(6),
    )
    shown = F.when(text.rlike(_ISO), day_time).when(text.rlike(_ISO_SHORT), padded)
    valid = shown.try_cast("timestamp_ntz").isNotNull() & ~shown.startswith("0000")
    return F.coalesce(F.when(valid, shown), c, F.lit(""))


def build_url(base: str, agenda_slug: Column, slug: Column) -> Column:
    """``base/{agenda}/events/{slug}``, without the agenda if it is unknown."""
    base = base.rstrip("/")
    return (
        F.when(filled(slug) & filled(agenda_slug), F.concat(F.lit(f"{base}/"), agenda_slug, F.lit("/events/"), slug))
        .when(filled(slug), F.concat(F.lit(f"{base}/events/"), slug))
        .otherwise("")
    )


def strip_html(c: Column) -> Column:
    """Tags removed, the known entities decoded in order, spaces collapsed."""
    bare = F.regexp_replace(c, "<[^>]+>", "")
    decoded = bare
    for entity, char in ENTITIES:
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    # Most texts have no entity at all; one search replaces fifteen.
    return collapse_spaces(F.when(F.contains(c, F.lit("&")), decoded).otherwise(bare))


def labelled(label: str, c: Column) -> Column:
    """``label + text``, or null where the text is empty."""
    return F.when(filled(c), F.concat(F.lit(label), c))


def compose_text(
    titre: Column,
    description: Column,
    description_longue: Column,
    ville: Column,
    adresse: Column,
    categories: Column,
    date_debut: Column,
    date_fin: Column,
    labels: Mapping[str, str] = TEXT_LABELS,
) -> Column:
    """One labelled line per field; empty and repeated fields are left out."""
    place = F.concat_ws(", ", F.nullif(ville, F.lit("")), F.nullif(adresse, F.lit("")))
    return F.concat_ws(
        "\n",
        labelled(labels["titre"], titre),
        labelled(labels["description"], description),
        F.when(~description_longue.eqNullSafe(description), labelled(labels["description_longue"], description_longue)),
        labelled(labels["lieu"], place),
        labelled(labels["date_debut"], date_debut),
        F.when(~date_fin.eqNullSafe(date_debut), labelled(labels["date_fin"], date_fin)),
        labelled(labels["categories"], categories),
    )


def excerpt(c: Column, n: int = 100) -> Column:
    """The first ``n`` characters and ``...`` for display of longer texts."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def canonical_json(c: Column) -> Column:
    """JSON text with sorted keys and plain numbers; other text unchanged."""
    return F.coalesce(F.to_json(F.try_parse_json(c)), c)


def fingerprint(c: Column) -> Column:
    """32-byte digest under which two equal JSON documents agree."""
    return F.unhex(F.sha2(canonical_json(c), 256))
