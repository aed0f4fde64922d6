"""Hits as text: documents, context blocks and prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from recueil.functions.text import labelled

# Instructions and wording of the prompts.
INSTRUCTIONS = """Tu es un assistant spécialisé dans les événements culturels en France.

Ton rôle est d'aider les utilisateurs à trouver des événements pertinents en te basant UNIQUEMENT sur les informations fournies.

Règles importantes :
- Réponds de manière claire, concise et structurée
- Base-toi UNIQUEMENT sur les événements fournis dans le contexte
- Si aucun événement ne correspond, dis-le clairement
- Mentionne toujours les informations clés : titre, ville, date
- Si l'utilisateur demande des détails, fournis-les depuis le contexte
- Ne jamais inventer d'informations
"""
CONTEXT_TITLE = "CONTEXTE - Événements pertinents :"
QUESTION_TITLE = "QUESTION DE L'UTILISATEUR :"
ANSWER_TITLE = "RÉPONSE :"
ANSWER_RULE = "Réponds à la question en te basant uniquement sur les événements ci-dessus."
NO_EVENT = "Aucun événement pertinent trouvé."
BLOCK_TITLE = "Événement %d:"
SCORE_LABEL = "Score de pertinence: %.2f"
SIMPLE_TITLE = "Voici des événements culturels :"
SIMPLE_RULE = "Réponds de manière concise."

# Labelled fields of a hit, in order.
HIT_FIELDS = [
    ("Titre", "titre"),
    ("Description", "description"),
    ("Ville", "ville"),
    ("Date de début", "date_debut"),
    ("Date de fin", "date_fin"),
    ("Lieu", "lieu_nom"),
    ("Catégorie", "categorie"),
]


def hit_text(fields: Sequence[tuple[str, str]] = HIT_FIELDS) -> Column:
    """A hit as labelled lines, empty fields skipped."""
    return F.concat_ws("\n", *[labelled(f"{label}: ", F.col(name)) for label, name in fields])


def context_block(rank: Column, score: Column | None = None, fields: Sequence[tuple[str, str]] = HIT_FIELDS) -> Column:
    """A numbered block for the prompt; missing fields read ``N/A``."""
    lines = [F.format_string(BLOCK_TITLE, rank)]
    lines += [F.concat(F.lit(f"{label}: "), F.coalesce(F.col(name), F.lit("N/A"))) for label, name in fields]
    if score is not None:
        lines.append(F.when(score.isNotNull(), F.format_string(SCORE_LABEL, score)))
    return F.concat(F.concat_ws("\n", *lines), F.lit("\n"))


def simple_line(rank: Column) -> Column:
    """``rank. title - city - date`` with ``N/A`` for what is missing."""
    parts = [F.coalesce(F.col(name), F.lit("N/A")) for name in ("titre", "ville", "date_debut")]
    return F.concat(rank.cast("string"), F.lit(". "), F.concat_ws(" - ", *parts))


def in_rank_order(rank: Column, text: Column, separator: str) -> Column:
    """Aggregate: texts of one question joined by rank (at most k of them)."""
    ordered = F.array_sort(F.collect_list(F.struct(rank.alias("rank"), text.alias("text"))))
    return F.array_join(F.transform(ordered, lambda hit: hit["text"]), separator)


def grounded_prompt(question: Column, context: Column) -> Column:
    """The full prompt; a null context says that nothing was found."""
    return F.concat(
        F.lit(f"{INSTRUCTIONS}\n\n{CONTEXT_TITLE}\n\n"),
        F.coalesce(context, F.lit(NO_EVENT)),
        F.lit(f"\n\n{QUESTION_TITLE}\n"),
        question,
        F.lit(f"\n\n{ANSWER_TITLE}\n{ANSWER_RULE}"),
    )


def simple_prompt(question: Column, context: Column) -> Column:
    """The short prompt."""
    found = F.concat(
        F.lit(f"{SIMPLE_TITLE}\n\n"), context, F.lit("\n\nQuestion : "), question, F.lit(f"\n\n{SIMPLE_RULE}")
    )
    empty = F.concat(F.lit("Question: "), question, F.lit(f"\n\n{NO_EVENT}"))
    return F.coalesce(found, empty)
