"""Declared schemas.  Nothing in this library infers a schema."""

from __future__ import annotations

# Clean event: fixed values, the column names and their order are the contract.
CLEAN_COLUMNS = [
    "id", "titre", "description", "description_longue", "ville", "adresse",
    "region", "date_debut", "date_fin", "categories", "url", "texte_complet",
]
CLEAN = ", ".join(f"{name} STRING" for name in CLEAN_COLUMNS)

#: Fields read from one raw event.  Language maps and keywords stay raw JSON
#: text because their shape varies from record to record.
RAW_EVENT = (
    "uid STRING, title STRING, description STRING, longDescription STRING, "
    "location STRUCT<city: STRING, address: STRING, region: STRING>, "
    "keywords STRING, firstTiming STRUCT<begin: STRING>, "
    "lastTiming STRUCT<end: STRING>, slug STRING, originAgenda STRUCT<slug: STRING>"
)

#: One landed page of agendas.
AGENDA_PAGE = "agendas ARRAY<STRUCT<uid: STRING, title: STRING>>, after ARRAY<BIGINT>, total BIGINT"

#: One landed page of events; each event stays raw JSON text.
EVENT_PAGE = "agenda_uid STRING, events ARRAY<STRING>"

JOURNAL = (
    "horodatage STRING, nb_nouveaux BIGINT, nb_avant_fusion BIGINT, nb_apres_fusion BIGINT, "
    "nb_ajoutes BIGINT, nb_mis_a_jour BIGINT, nb_doublons BIGINT, fichier_version STRING, "
    "version BIGINT, source_id STRING, batch_id BIGINT, changed BIGINT, empreinte STRING, rejoue BIGINT"
)

#: One finished compaction of the versioned table.
BASE = "version BIGINT, bucket_count INT, rows BIGINT"

CURSOR = (
    "curseur_after ARRAY<BIGINT>, nb_agendas_session INT, total_agendas_api INT, "
    "horodatage STRING, fin_de_liste BOOLEAN, seq BIGINT, source_id STRING, batch_id BIGINT"
)

#: Evaluation questions; every group uses some of the expectation columns.
QUESTIONS = (
    "question_group STRING, question STRING, expected_keywords ARRAY<STRING>, "
    "expected_nb_events INT, expected_event STRING, expected_answer_type STRING, note STRING"
)
