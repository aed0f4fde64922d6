"""License scans by sentence rules.

Texts are normalised and searched for known sentences, which may be wrapped over
lines.  A table maps normalised sentences to identifiers; a rule names a licence
and the identifiers that must follow one another in a document, other known
sentences of the same rule's family not in between.  What is found is the
licence, where, and what it allows.

Defined results: a null or empty text has no licence; very long texts are read
whole; repeated rows are reported each; an empty table gives an empty result;
the result has its own columns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recueil.llm.common import held, whole_text

# The wording of public licence notices, normalised (lower case,
# runs of anything but a-z and 0-9 as one blank), and their identifiers.
_APACHE = "apache license version 2 0 the license you may not use this file except in compliance with the license"
_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction"
)
_AS_IS = "the software is provided as is without warranty of any kind express or implied"
_BSD = "redistribution and use in source and binary forms with or without modification are permitted"
_GPL = (
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
    " license as published by the free software foundation"
)
_GPL_WARRANTY = "this program is distributed in the hope that it will be useful but without any warranty"
SENTENCES = {
    "licensed under the apache license version 2 0": "apache-2.0-notice",
    "this work is licensed under the apache license version 2 0": "apache-2.0-notice",
    "licensed under the apache license version 2 0 the license": "apache-2.0-notice",
    f"licensed under the {_APACHE}": "apache-2.0-notice",
    f"the asf licenses this file to you under the {_APACHE}": "apache-2.0-notice",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache-2.0-url",
    "http www apache org licenses license 2 0": "apache-2.0-url",
    "https www apache org licenses license 2 0": "apache-2.0-url",
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "this project is licensed under the mit license": "mit-notice",
    _MIT: "mit-grant",
    f"{_MIT} including without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
    " copies of the software and to permit persons to whom the software is furnished to do so subject to the following"
    " conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of"
    " the software": "mit-condition",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies"
    " or substantial portions of the software": "mit-condition",
    _AS_IS: "as-is",
    f"{_AS_IS} including but not limited to the warranties of merchantability fitness for a particular purpose and"
    " noninfringement": "as-is",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0-notice",
    "licensed under the gnu general public license version 3": "gpl-3.0-notice",
    _GPL: "gpl-grant",
    **{
        f"{_GPL} {version}": "gpl-grant"
        for n in (2, 3)
        for version in (
            f"either version {n} of the license or at your option any later version", f"version {n} of the license",
            f"either version {n} of the license", f"version {n}",
        )
    },
    _GPL_WARRANTY: "gpl-warranty",
    f"{_GPL_WARRANTY} without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0-notice",
    "this work is licensed under cc by nc 4 0": "cc-by-nc-4.0-notice",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4.0-notice",
    "licensed under cc by 4 0": "cc-by-4.0-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0-notice",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0-notice",
    "all rights reserved": "reserved",
    _BSD: "bsd-grant",
    f"{_BSD} provided that the following conditions are met": "bsd-grant",
    **{
        f"this software is provided by the {whose} as is and any express or implied warranties including but not limited to the"
        " implied warranties of merchantability and fitness for a particular purpose are disclaimed": "as-is"
        for whose in (
            "copyright holders and contributors", "copyright holder and contributors", "regents and contributors",
            "author and contributors", "authors and contributors", "author", "authors",
        )
    },
    "this work is dedicated to the public domain": "public-domain",
}

# Licence, what it is, and the identifiers in order.
RULES = [
    ("apache-2.0", "permissive", ["apache-2.0-notice"]),
    ("mit", "permissive", ["mit-notice"]),
    ("mit", "permissive", ["reserved", "mit-grant", "mit-condition", "as-is"]),
    ("mit", "permissive", ["mit-grant", "mit-condition", "as-is"]),
    ("bsd", "permissive", ["reserved", "bsd-grant", "as-is"]),
    ("bsd", "permissive", ["bsd-grant", "as-is"]),
    ("gpl-3.0", "copyleft", ["gpl-3.0-notice"]),
    ("gpl", "copyleft", ["gpl-grant", "gpl-warranty"]),
    ("cc-by-4.0", "permissive", ["cc-by-4.0-notice"]),
    ("cc-by-sa-4.0", "copyleft", ["cc-by-sa-4.0-notice"]),
    ("cc-by-nc-4.0", "noncommercial", ["cc-by-nc-4.0-notice"]),
    ("public-domain", "permissive", ["public-domain"]),
    ("all-rights-reserved", "proprietary", ["reserved"]),
]

# Marks in normalised texts: the end of a sentence, the end of a line.
_END, _LINE = "#", "~"


def normalized(text: Column) -> Column:
    """Lower case, runs of anything but a-z and 0-9 as one blank; a full stop,
    question or exclamation mark before white space and line ends become marks,
    an empty line becomes two."""
    ended = F.regexp_replace(F.translate(F.lower(text), _END + _LINE, "  "), r"[.!?][ \t\r\n]", _END)
    return F.regexp_replace(F.regexp_replace(ended, rf"[^a-z0-9\n{_END}]+", " "), r" ?\n ?", _LINE)


def known_sentences(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """The identifiers of the known sentences of a text, in order.

    A sentence starts and ends where a sentence or line does.  It may run over
    line ends, not over ends of sentences or empty lines; of sentences that start
    at one place the longest counts.
    """
    table = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    known = "|".join(s.replace(" ", f"[ {_LINE}]") for s in sorted(sentences, key=len, reverse=True))
    found = F.regexp_extract_all(normalized(text), F.lit(f"(?:^|[{_END}{_LINE}]) ?({known})(?= ?(?:[{_END}{_LINE}]|$))"), 1)
    return F.transform(found, lambda s: F.element_at(table, F.translate(s, _LINE, " ")))


def license_scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", sentences: dict[str, str] = SENTENCES, rules: list = RULES
) -> DataFrame:
    """``key, sentence_ids, licenses, kinds, usable`` of every document.

    A rule fits where its identifiers stand next to one another in the sequence
    of known sentences; what a longer rule fits is not left to shorter ones, so
    "all rights reserved" above a BSD text is part of it.  ``usable`` is false if a licence is found that is not
    permissive, null if none is found.
    """
    found = held(docs.select(F.col(f"`{key}`").alias("key"), text), "ids", known_sentences(whole_text(text), sentences))
    line, fits = F.concat(F.lit("|"), F.concat_ws("||", "ids"), F.lit("|")), []
    for name, kind, ids in sorted(rules, key=lambda rule: -len(rule[2])):
        run = F.lit("|" + "||".join(ids) + "|")
        fits.append((name, kind, F.contains(line, run)))
        line = F.replace(line, run, F.lit("-")) if len(ids) > 1 else line

    def collected(at: int) -> Column:
        values = F.array(*[F.when(rule[2], F.lit(rule[at])) for rule in fits])
        return F.sort_array(F.array_distinct(F.filter(values, lambda x: x.isNotNull())))

    usable = F.when(F.size("kinds") > 0, F.forall("kinds", lambda x: x == "permissive"))
    return (
        found.select("key", F.col("ids").alias("sentence_ids"), collected(0).alias("licenses"), collected(1).alias("kinds"))
        .withColumn("usable", usable)
        .withColumnRenamed("key", key)
    )
