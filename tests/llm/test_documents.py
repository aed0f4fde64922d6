"""Operators that decide document by document."""

import pytest
from pyspark.sql import functions as F

from recueil.llm import decontaminate, fixity, host_rules, licenses, line_quality, mixing, token_counts, url_filter

ITEM = "A train travels 120 km from Paris to Lyon in 2 hours and then stops at the old station. How fast did the train travel to Lyon?"


def test_tokens_are_those_of_the_library(spark):
    tokenizers, names = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = names.path("byte_bpe_50k.json")
    texts = [
        None, "", " ", "\n\n  a", "It's we'll  THEY'RE 3.5kg", "<|endoftext|> inside <|endoftext|>", "é" * 3000, "日本語 \u1680 x", "a" * 20000,
        "\u0558 new letters \U0003d000", "tab\tand\x00zero", "same", "same",
    ]
    docs = spark.createDataFrame([(i, x, 5) for i, x in enumerate(texts)], "doc_id INT, text STRING, n_tokens INT")
    found = token_counts.token_counts(docs, path, names.PATTERN).orderBy("doc_id").collect()
    library = tokenizers.Tokenizer.from_file(path)
    assert [r["n_tokens"] for r in found] == [len(library.encode(x or "", add_special_tokens=False).ids) for x in texts]
    assert [r["n_bytes"] for r in found] == [len((x or "").encode()) for x in texts]
    assert token_counts.token_counts(docs.limit(0), path, names.PATTERN).count() == 0
    # Another pattern in the same workers: every character by itself.
    single = token_counts.token_counts(docs.filter("doc_id = 4"), path, ".").first()["n_tokens"]
    assert single == len(texts[4]) and single != found[4]["n_tokens"]


def bench(spark, *items):
    return spark.createDataFrame([(i, x, 1) for i, x in enumerate(items)], "item_id INT, text STRING, doc_id INT")


def leaks(spark, texts, *items, **options):
    docs = spark.createDataFrame([(i, x, 3) for i, x in enumerate(texts)], "doc_id INT, text STRING, item_id INT")
    rows = decontaminate.contaminated(docs, bench(spark, *items), **options).collect()
    return {(r["doc_id"], r["item_id"]): r["new_values"] for r in rows}


def test_items_are_found_with_new_values(spark):
    anew = ITEM.replace("120", "95.5").replace("Paris", "Rome").replace("Lyon", "Bern")
    mixed = ITEM.replace("to Lyon in", "to Rome in")
    texts = [f"Before. {ITEM} After.", anew, mixed, None, "", "The old station is where the train stops.", ITEM.lower(), ITEM, ITEM * 50]
    found = leaks(spark, texts, ITEM, None, "", "too short")
    assert found[0, 0] is False and found[1, 0] is True
    assert {i for i, _ in found} >= {0, 1, 7, 8} and not {i for i, _ in found} & {3, 4, 5}
    assert leaks(spark, texts, ITEM, block_bytes=1) == found
    assert leaks(spark, texts, ITEM, ITEM, block_bytes=1).keys() == {(i, k) for i, _ in found for k in (0, 1)}


def test_inconsistent_slots_do_not_match():
    item = "From Rome the road goes by Oslo and then from Rome back by Oslo"
    block = decontaminate.block([1], [item])

    def found(text):
        import pyarrow as pa

        powers = decontaminate.rolling.Powers()
        return list(decontaminate._found(pa.array([text]), block, powers, decontaminate.unit_codes(powers)))

    assert found(item.replace("Rome", "Bern").replace("Oslo", "Kiev"))
    assert not found("From Aix the road goes by Metz and then from Brest back by Nice")


def test_one_other_slot_splits_a_match(spark):
    item = (
        "On the old road from Rome the 12 wagons with grain were counted twice before the gate was closed, while the guards near Oslo"
        " let 12 riders from Rome pass without any word about the bridge that they had burned"
    )
    anew = item.replace("Rome", "Bern").replace("Oslo", "Kiev").replace("12", "30")
    at = item.rindex("12")
    texts = [
        item[:at] + "13" + item[at + 2 :], item.replace("from Rome pass", "from Turin pass"), anew.replace("30 riders", "31 riders"),
        anew.replace("near Kiev", "near Bern"), item.replace("12 riders", "13 riders").replace("12 wagons", "14 wagons"),
    ]
    found = leaks(spark, texts, item)
    assert found == {(0, 0): False, (1, 0): False, (2, 0): True, (3, 0): True, (4, 0): False}


def test_offending_slots():
    import numpy as np

    def places(item, said, forth=None, back=None):
        code = np.array([12 if w[0].isupper() else 11 if w[0].isdigit() else 64 for w in item.split()], np.uint64)
        return decontaminate._offending(item.encode().split(), said.encode().split(), code, forth or {}, back or {})

    assert places("A x A x A", "B x B x C") == [4] and places("A x A", "B x C") == [0, 2] and places("A x A", "A x B") == [2]
    assert places("A x B x A", "C x C x C") == [2] and places("1 x 2", "3 x 3") == [] and places("A x B", "B x A") == []
    assert places("A x A", "C x A", {(12, b"A"): (12, b"B")}) == [0]


def test_copies_are_found_whatever_they_hold(spark):
    items = [
        "Compute 12*34+56-78", "Anna Bell, Carl Dorn, Emil Frey, Gita Hahn, Ines Jung", "What Is The Oldest Bridge Of Old Prague Town Called?",
        "北京大学的图书馆里有多少本书，谁在管理这些书？", "นักเรียนอ่านหนังสือที่ห้องสมุดทุกวัน", ITEM, "2+2", "Какая река течёт через город Киев и впадает в море?", "→ ∂?",
    ]
    texts = [f"Before it. “{x}” After it." for x in items]
    assert leaks(spark, texts, *items).keys() >= {(i, i) for i in range(len(items))}
    for changed in (str.upper, str.lower):
        assert leaks(spark, [changed(x) for x in texts], *items).keys() >= {(i, i) for i in range(len(items))}
    others = ["12, 34, 56, 78 and 2 2", "Compute 12+34+56+78", "Carl Dorn met Gita Hahn", "北京有多少本书", "Какая река течёт на юг?", "22+22", "", None]
    assert not leaks(spark, others, *items)
    assert leaks(spark, texts, *items, block_bytes=40) == leaks(spark, texts, *items)


def test_decontaminated_keeps_the_rest(spark):
    docs = spark.createDataFrame([(1, ITEM, "a"), (2, None, "b"), (3, "clean text", None)], "doc_id INT, text STRING, item_id STRING")
    kept = decontaminate.decontaminated(docs, bench(spark, ITEM))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {2, 3}
    assert decontaminate.decontaminated(docs, bench(spark)).count() == 3


def test_short_items_drop_no_sentences(spark):
    texts = ["The cat sat on the mat. Yes.", "yes.", "One line\n The \nand more", "A sum, 12*34+56-78, within a text", "12 * 34 + 56 - 78", "other", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING")
    items = bench(spark, "The", "Yes.", "12*34+56-78", "+", "", None)
    assert {r["doc_id"] for r in decontaminate.decontaminated(docs, items).collect()} == {0, 5, 6, 7} | ({3} if decontaminate.LEAST > 4 else set())
    assert {r["doc_id"] for r in decontaminate.contaminated(docs, items).collect()} >= {0, 1, 2, 3, 4}
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0 and decontaminate.decontaminated(docs.limit(0), items).count() == 0


def test_licences_in_order(spark):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction.\nThe above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software.\nThe software is provided \"as is\", without warranty of any kind, "
        "express or implied.\n"
    )
    lines = mit.strip().split("\n")
    texts = ["Text. Released under the MIT License.", mit, "\n".join(lines[::-1]), "ALL RIGHTS RESERVED!", "x" * 100000, "", None, "All rights reserved. Yes"]
    docs = spark.createDataFrame([(i, x, "l") for i, x in enumerate(texts)], "doc_id INT, text STRING, licenses STRING")
    found = {r["doc_id"]: (r["licenses"], r["usable"]) for r in licenses.license_scan(docs).collect()}
    assert found == {
        0: (["mit"], True), 1: (["mit"], True), 2: ([], None), 3: (["all-rights-reserved"], False), 4: ([], None), 5: ([], None),
        6: ([], None), 7: (["all-rights-reserved"], False),
    }


MIT = """MIT License

Copyright (c) 2020 A. Author. All rights reserved.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Copyright (c) 2020, A. Author
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES.
"""
GPL = """/*
 * Copyright (C) 2020  A. Author
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 */
"""
APACHE = """# Copyright 2020 A. Author
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""


def test_wrapped_licences_are_found(spark):
    split = "All rights\n\nreserved. All rights. Reserved. Not all rights reserved"
    texts = [MIT, BSD, GPL, APACHE, MIT.replace("\n", "\r\n"), BSD.replace("THIS SOFTWARE", "X"), split, BSD + "\nAll rights reserved."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING")
    found = {r["doc_id"]: (r["sentence_ids"], r["licenses"], r["usable"]) for r in licenses.license_scan(docs).collect()}
    mit = ["reserved", "mit-grant", "mit-condition", "as-is"]
    assert found == {
        0: (mit, ["mit"], True), 1: (["reserved", "bsd-grant", "as-is"], ["bsd"], True), 2: (["gpl-grant", "gpl-warranty"], ["gpl"], False),
        3: (["apache-2.0-notice", "apache-2.0-url"], ["apache-2.0"], True), 4: (mit, ["mit"], True),
        5: (["reserved", "bsd-grant"], ["all-rights-reserved"], False), 6: ([], [], None),
        7: (["reserved", "bsd-grant", "as-is", "reserved"], ["all-rights-reserved", "bsd"], False),
    }


def test_mix_reaches_targets(spark):
    rows = [(i, "w " * (i % 7), ["a", "b", "c", None][(i * i) % 4], 1) for i in range(400)] + [(None, None, "d", 1), (5, "dup dup", "b", 1), (5, "dup dup", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id INT, text STRING, source STRING, size INT")
    found = mixing.mixed(docs).collect()
    assert len(found) == len(rows)
    total = sum(len((t or "").split()) for _, t, _, _ in rows)
    by = {}
    for r in found:
        assert r["taken"] <= 3 * r["size"]
        by.setdefault(r["source"], [r["source_size"], r["target"], 0])[2] += r["taken"]
    assert sum(x[1] for x in by.values()) == pytest.approx(total)
    for size, target, taken in by.values():
        assert target <= 3 * size + 1e-9 and abs(taken - target) <= 6
    assert sorted(map(tuple, mixing.mixed(docs.repartition(5)).collect()), key=str) == sorted(map(tuple, found), key=str)
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_mix_stage_keeps_whole_documents(spark):
    import corpus_pipeline

    rows = [(i, "w " * (i % 7), ["a", "b", "c", None][(i * i) % 4], "en") for i in range(200)] + [(None, None, "d", "fr")]
    rows += [(i, "x y z", "b", "de") for i in range(300, 900)]
    docs = spark.createDataFrame(rows, "doc_id INT, text STRING, source STRING, lang STRING")
    found = corpus_pipeline.mix_sources(spark, docs, "")
    assert found.columns == [*docs.columns, "size", "source_size", "target", "taken", "copies"]
    kept = found.collect()
    taken = {tuple(r) for r in mixing.mixed(docs).filter("taken > 0").collect()}
    assert len(kept) < len(rows) and {(r["doc_id"], r["source"], r["size"], r["source_size"], r["target"], r["taken"]) for r in kept} == taken
    assert len(kept) == len(taken) and {tuple(r)[:4] for r in kept} <= set(rows)
    assert all(r["taken"] == r["size"] * r["copies"] for r in kept)


def test_urls(spark):
    urls = [
        None, "", "no scheme", "HTTP://WWW.Example.NET/en/x?y", "http://example.net/EN/", "x://a.example.com/de/1#f", "http://badexample.com/de/",
        "http://a.org/fr/", "http://net/", "http://net", "http://É.net/", "a://b?c://d.net/",
    ]
    pages = spark.createDataFrame([(i, u, "own", "v") for i, u in enumerate(urls)], "page_id INT, url STRING, host STRING, Verdict STRING")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in url_filter.judged(pages).collect()}
    assert found == {
        0: ("", "", None), 1: ("", "", None), 2: ("", "", None), 3: ("www.example.net", "/en/x", "example.net/en/"),
        4: ("example.net", "/EN/", "net/"), 5: ("a.example.com", "/de/1", "example.com/de/"), 6: ("badexample.com", "/de/", None),
        7: ("a.org", "/fr/", "org/fr/"), 8: ("net", "/", "net/"), 9: ("net", "", None), 10: ("É.net", "/", "net/"), 11: ("b", "", None),
    }
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_hosts_with_bad_pages_are_blocked(spark):
    rows = [(f"http://bad.site.io/x/{i}",) for i in range(40)] + [("http://bad.site.io/y",), ("http://bad.site.io/y",)]
    rows += [(f"http://h{i % 30}.fine.io/y",) for i in range(300)]
    pages = spark.createDataFrame(rows, "url STRING").withColumn("page_id", F.monotonically_increasing_id())
    found = url_filter.judged(pages, [url_filter.Rule("block", "bad.site.io", "/x/")])
    assert {(r["host"], r["verdict"]) for r in found.filter("rule IS NULL").collect() if r["host"] == "bad.site.io"} == {("bad.site.io", "block")}
    assert found.filter("host LIKE '%fine.io' AND verdict <> 'allow'").count() == 0


def test_unruled_pages_do_not_vote(spark):
    hosts = [f"b{i}.bad.io" for i in range(10)] + [f"f{i}.fine.io" for i in range(10)]
    urls = [f"http://{h}/{'x' if 'bad' in h else 'ok'}/{i}" for h in hosts for i in range(6)] + [f"http://{h}/y/{i}" for h in hosts for i in range(40)]
    urls += [f"http://{h}/y" for h in ("new.bad.io", "new.fine.io", "else.org")]
    pages = spark.createDataFrame([(u,) for u in urls], "url STRING")
    rules = [url_filter.Rule("block", "bad.io", "/x/"), url_filter.Rule("allow", "fine.io", "/ok/")]

    found = url_filter.judged(pages, rules).filter("rule IS NULL AND verdict = 'block'").select("host").distinct()
    assert {r["host"] for r in found.collect()} == {*hosts[:10], "new.bad.io"}
    assert url_filter.judged(pages, []).filter("verdict <> 'allow'").count() == 0


def test_the_limit_is_chosen_on_held_out_pages(spark):
    # Hosts of one domain, three in ten of whose pages are bad; those of another, all.
    rows = [(f"h{i % 9}.mixed.io", i % 10 < 3, i % 4 == 0) for i in range(900)] + [(f"b{i % 9}.bad.io", True, i % 4 == 0) for i in range(300)]
    outcomes = spark.createDataFrame(rows, "host STRING, bad BOOLEAN, held BOOLEAN")
    assert 0.3 <= url_filter.chosen_limit(outcomes) <= 0.9
    assert url_filter.chosen_limit(outcomes.withColumn("bad", ~F.col("bad")), [0.1, 0.5]) == 0.5
    assert url_filter.chosen_limit(outcomes.limit(0)) == 0.9


def test_fixity_finds_damage_and_nothing_else(spark):
    leaves = [(f, o * 1000, f"{f}-{o}") for f in range(3) for o in range(300)]
    broken = [(f, o, "bad" if (f, o) == (1, 7000) else d) for f, o, d in leaves if (f, o) != (2, 299000)] + [(0, 999_999_999, "extra")]
    schema = "file INT, offset BIGINT, digest STRING"
    a, b = spark.createDataFrame(leaves, schema), spark.createDataFrame(broken, schema)
    found = {tuple(r) for r in fixity.audit(a, b).collect()}
    assert found == {(1, 7000, "1-7", "bad"), (2, 299000, "2-299", None), (0, 999_999_999, None, "extra")}
    assert fixity.audit(a, a).count() == 0 and fixity.audit(a.limit(0), b.limit(0)).count() == 0
    assert fixity.audit(a, b.limit(0)).count() == len(leaves)


def test_warc_layout_has_no_gaps(spark):
    pages = spark.createDataFrame([(i, None, "é" * (i % 9)) for i in range(50)] + [(3, None, "é" * 3)], "page_id INT, url STRING, html STRING")
    record = fixity.warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    laid = fixity.laid_out(fixity.record_table(pages, digest=record), 2000).collect()
    assert len(laid) == 50 and sum(r["copies"] for r in laid) == 51
    for f in {r["file"] for r in laid}:
        at = 0
        for r in sorted((r for r in laid if r["file"] == f), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]


def brute_measures(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)]


def test_rules(spark):
    texts = [None, "", " \n", "a b c a b c a b c", "one\none\n\n \ntwo\none", "x\u00a0y é\u3000z\x0b#|<", "w " * 3000, "a b a b a", "q\r\nq\r\n"]
    rows = [(i, x, "h" if i < 3 else None, "7") for i, x in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id INT, text STRING, source STRING, n_words STRING")
    found = host_rules.quality_table(docs).orderBy("doc_id").collect()
    assert [[r[c] for c in host_rules.MEASURES] for r in found] == [brute_measures(x) for x in texts]
    assert [r["base_failed"] for r in found] == [m[0] < 50 or 100 * m[4] > 50 * m[0] for m in map(brute_measures, texts)]
    assert host_rules.quality_table(docs.limit(0)).count() == 0


def test_hosts_with_failures_are_rejected(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, good if i % 10 else "short", "fine") for i in range(200)] + [(1000 + i, "short" if i % 10 else good, "poor") for i in range(200)]
    found = host_rules.quality_rules(spark.createDataFrame(rows, "doc_id INT, text STRING, source STRING"))
    assert {(r["source"], r["kept"]) for r in found.filter("NOT base_failed").collect()} == {("fine", True), ("poor", False)}


def test_line_quality_tells_held_out_documents(spark):
    import random

    dice = random.Random(2)
    words = ["the", "river", "of", "small", "houses", "runs", "under", "old", "bridge", "and"]

    def text(good):
        lines = [" ".join(dice.choice(words) for _ in range(dice.randint(4, 12))) + "." for _ in range(dice.randint(1, 8))]
        return "\n".join(lines if good else [x.upper().replace(" ", "!! ") for x in lines])

    rows = [(i, text(i % 3 > 0), i % 3) for i in range(300)] + [(900, None, 0), (901, "\n \n", 0), (902, "a b. " * 20000, 0), (None, "null id", 0)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, score INT")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(5, None, 0), (None, 1, 0)], "doc_id BIGINT, quality INT, toxic INT")
    found = {r["doc_id"]: r for r in line_quality.quality_scores(docs, line_quality.fitted(docs, labels)).collect()}
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found.values())
    told = [r["predicted"] == int(i % 3 > 0) for i, r in found.items() if i is not None and i < 300 and r["held_out"]]
    assert len(told) > 40 and all(told)
    assert {r["score"] for r in line_quality.quality_scores(docs, line_quality.fitted(docs, labels.limit(0))).collect()} == {0.5}
    assert line_quality.quality_scores(docs.limit(0), None).count() == 0


def test_marginals_are_those_of_all_labellings():
    import itertools

    import numpy as np

    odds, stay = np.array([0.3, -1.2, 0.8, 2.0]), np.array([0.7, 1.1])
    good, stays, _ = line_quality.marginals(odds, np.array([0, 3]), np.array([3, 1]), stay)
    weight = {}
    for y in itertools.product((0, 1), repeat=3):
        weight[y] = np.exp(sum(odds[i] * y[i] for i in range(3)) + sum(stay[y[i]] for i in (1, 2) if y[i] == y[i - 1]))
    total = sum(weight.values())
    assert good[:3] == pytest.approx([sum(w for y, w in weight.items() if y[i]) / total for i in range(3)])
    assert stays[1, 1] == pytest.approx(sum(w for y, w in weight.items() if y[0] == y[1] == 1) / total)
    assert good[3] == pytest.approx(1 / (1 + np.exp(-2.0)))
