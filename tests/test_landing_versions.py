import json
import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from recueil import schemas
from recueil.operators import clean as C
from recueil.plans import corpus
from recueil.sources import arrays, landing, tables, versions
from recueil.streaming import collect


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(line if isinstance(line, str) else json.dumps(line, ensure_ascii=False) for line in lines) + "\n")


def event(uid, v=1):
    return {"uid": uid, "v": v}


def batch(spark, *records, start=0):
    return spark.createDataFrame([(start + i, json.dumps(r)) for i, r in enumerate(records)], "seq long, payload string")


def test_lines_keep_their_order(spark, path):
    write(f"{path}/a/1.json", *[event(i) for i in range(50)])
    write(f"{path}/a/0.json", *[event(100 + i) for i in range(50)], "")
    rows = landing.raw_lines(spark, f"{path}/a").orderBy("seq").collect()
    assert [json.loads(r["payload"])["uid"] for r in rows] == [*range(100, 150), *range(50)]
    assert landing.raw_lines(spark, f"{path}/missing").count() == 0


def test_array_files(spark, path):
    write(f"{path}/a/1.json", json.dumps([event(1), 5, event(2)], indent=2))
    write(f"{path}/a/2.json", '{"no": "list"}')
    write(f"{path}/a/3.json", "[broken")
    rows = landing.raw_arrays(spark, f"{path}/a")
    assert [r["payload"] for r in C.malformed(rows).collect()] == ["5"]
    assert C.well_formed(rows).count() == 2
    assert landing.raw_arrays(spark, f"{path}/missing").count() == 0


def tricky(i):
    """Objects with all that could be taken for a border."""
    return {"uid": i, "t": [', "uid": [', 'a\\"],[{', "\\\\", "é, ]}", {"x": [[], {}, i]}][i % 5], "n": [i, [i, {"y": ","}]], "long": "z,]" * (i % 40)}


@pytest.mark.parametrize("block", [64, 700, 1 << 20])
def test_array_files_are_cut_into_blocks(spark, path, block):
    """Whatever the size of the blocks, elements are those of a JSON parser."""
    files = {
        "1": json.dumps([tricky(i) for i in range(300)], ensure_ascii=False),
        "2": json.dumps([tricky(i) for i in range(200)], indent=1),
        "3": json.dumps([1, "a, b", None, "[", True, {"uid": 1}, [2, 3], 'q"', "\\"] * 40),
        "4": "  [ ]\n", "5": json.dumps({"a": [tricky(i) for i in range(90)]}), "6": json.dumps([tricky(7)]), "7": "", "8": "[broken",
    }
    for name, text in files.items():
        os.makedirs(f"{path}/a", exist_ok=True)
        with open(f"{path}/a/{name}.json", "w", encoding="utf-8") as f:
            f.write(text)
    settings = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": str(block)}
    before = {x: spark.conf.get(x) for x in settings}
    for x, value in settings.items():
        spark.conf.set(x, value)
    try:
        rows = landing.raw_arrays(spark, f"{path}/a")
        if block < 1000:
            assert landing._text(spark, f"{path}/a").rdd.getNumPartitions() > 8
        found = [r["payload"] for r in rows.orderBy("seq").collect()]
    finally:
        for x, value in before.items():
            spark.conf.set(x, value)
    wanted = [x for name in "1236" for x in json.loads(files[name])]
    assert len(found) == len(wanted)
    for got, want in zip(found, wanted):
        assert got == want if isinstance(want, str) or want is None else json.loads(got) == want


@pytest.fixture
def pages(path):
    write(f"{path}/agendas/1.json", {"agendas": [{"uid": "a", "title": "A"}, {"uid": "", "title": "B"}, {"uid": "c"}], "after": [2, 7], "total": 9})
    write(f"{path}/agendas/2.json", {"agendas": [{"title": "D"}, {"uid": 5}], "after": None, "total": 9})
    write(f"{path}/events/1.json", {"agenda_uid": "a", "events": [event(i) for i in range(1, 6)]}, {"agenda_uid": "a", "events": [event(9)]})
    write(f"{path}/events/2.json", {"agenda_uid": "z", "events": [event(70)]}, {"agenda_uid": "c", "events": []}, {"agenda_uid": "5", "events": [event(50)]})
    return path


def test_pages(spark, pages):
    agenda_pages = landing.agenda_pages(spark, f"{pages}/agendas")
    event_pages = landing.event_pages(spark, f"{pages}/events")
    agendas = landing.agendas(agenda_pages)
    assert agendas.count() == 5 and landing.agendas(agenda_pages, 1).count() == 2 and landing.with_uid(agendas).count() == 3
    uids = lambda df: [json.loads(r["payload"])["uid"] for r in df.orderBy("agenda_uid", "seq").collect()]
    assert uids(landing.events_of(agendas, event_pages)) == [50, 1, 2, 3, 4, 5, 9]
    assert uids(landing.events_of(agendas, event_pages, 2)) == [50, 1, 2]
    assert uids(landing.events_of_agenda(event_pages, "a", 3)) == [1, 2, 3]
    summary = landing.collection_summary(agendas, landing.events_of(agendas, event_pages)).first()
    assert tuple(summary) == (5, 2, 2, 7)
    assert tuple(landing.next_cursor(agenda_pages).first()) == (None, 5, 9)
    for bad in (lambda: landing.agendas(agenda_pages, 0), lambda: landing.events_of(agendas, event_pages, 0),
                lambda: landing.events_of_agenda(event_pages, "")):
        with pytest.raises(ValueError):
            bad()


def test_integrate_and_replay(spark, path):
    with pytest.raises(ValueError, match="empty"):
        versions.integrate(spark, path, spark.createDataFrame([], "seq long, payload string"))
    records = [event(i) for i in range(1, 41)] + [event(None)]
    first = versions.integrate(spark, path, batch(spark, *records), bucket_rows=10)
    assert (first["nb_avant_fusion"], first["nb_apres_fusion"], first["nb_ajoutes"]) == (0, 41, 41)
    again = versions.integrate(spark, path, batch(spark, *records[:40]))
    assert (again["nb_ajoutes"], again["nb_mis_a_jour"], again["nb_doublons"]) == (0, 0, 40) and again["changed"] == 0
    third = versions.integrate(spark, path, batch(spark, event(1, 2), event(None), event(99)))
    assert (third["nb_ajoutes"], third["nb_mis_a_jour"], third["nb_avant_fusion"], third["nb_apres_fusion"]) == (2, 1, 41, 43)
    assert third["changed"] == 3

    state = [json.loads(r["payload"]) for r in versions.current(spark, path).orderBy("pos").collect()]
    want = [event(1, 2)] + [event(i) for i in range(2, 41)] + [event(None), event(None), event(99)]
    assert state == want
    log = versions.journal(spark, path).collect()
    assert [r["version"] for r in log] == [1, 2, 3] and log[0]["horodatage"] <= log[2]["horodatage"]
    listed = versions.list_versions(spark, path).collect()
    assert [r["fichier"] for r in listed] == [f"version={v:010d}" for v in (3, 2, 1)] and listed[0]["taille_ko"] > 0
    with pytest.raises(ValueError):
        versions.list_versions(spark, path, "other")
    assert versions.list_versions(spark, path, "processed").count() == 0


def test_a_batch_is_merged_once(spark, path):
    run = lambda v: versions.integrate(spark, path, batch(spark, event(1, v)), source_id="s", batch_id=0)
    assert run(1) is not None and run(2) is None
    assert versions.integrate(spark, path, batch(spark, event(1, 3)), source_id="other", batch_id=0) is not None
    assert versions.journal(spark, path).count() == 2


def test_a_lost_run_leaves_nothing_behind(spark, path, monkeypatch):
    versions.integrate(spark, path, batch(spark, event(1)))
    with monkeypatch.context() as broken:
        broken.setattr(versions, "session_stamp", lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            versions.integrate(spark, path, batch(spark, event(1, 2), event(2), event(None)))
    assert versions.current(spark, path).count() == 1
    versions.integrate(spark, path, batch(spark, event(3)))
    state = [json.loads(r["payload"])["uid"] for r in versions.current(spark, path).orderBy("pos").collect()]
    assert state == [1, 3]


def files(path):
    return {os.path.join(d, x): os.path.getmtime(os.path.join(d, x)) for d, _, names in os.walk(path) for x in names if x.endswith(".parquet")}


def test_a_merge_writes_the_rows_that_change_and_no_others(spark, path):
    n = 3000
    versions.integrate(spark, path, batch(spark, *[event(i) for i in range(1, n + 1)]), bucket_rows=100)
    base = files(f"{path}/raw/base")
    buckets = versions.bases(spark, path).first()
    assert (buckets["bucket_count"], buckets["rows"]) == (32, n) and len(base) >= 30
    changed = [i * 7 % n + 1 for i in range(300)]
    second = versions.integrate(spark, path, batch(spark, *[event(i, 2) for i in changed], *[event(i) for i in range(n - 50, n)]))
    assert second["changed"] == 300 and files(f"{path}/raw/base") == base
    assert spark.read.parquet(f"{path}/raw/changes").count() == 300
    state = {r["uid"]: json.loads(r["payload"])["v"] for r in versions.current(spark, path).collect()}
    assert state == {str(i): 2 if i in changed else 1 for i in range(1, n + 1)}


def test_compaction_keeps_the_state(spark, path, monkeypatch):
    monkeypatch.setattr(versions, "COMPACT_VERSIONS", 3)
    versions.integrate(spark, path, batch(spark, *[event(i) for i in range(1, 101)]), bucket_rows=10)
    order = lambda: [(r["pos"], r["payload"]) for r in versions.current(spark, path).orderBy("pos").collect()]
    for v in range(2, 4):
        versions.integrate(spark, path, batch(spark, event(v, v), event(1, v), event(None, v), event(200 + v)), bucket_rows=10)
    before = order()
    assert [r["version"] for r in versions.bases(spark, path).orderBy("version").collect()] == [1]
    assert versions.compact(spark, path, 10) and not versions.compact(spark, path, 10)
    assert order() == before and [r["version"] for r in versions.bases(spark, path).orderBy("version").collect()] == [1, 3]
    for v in range(4, 8):
        versions.integrate(spark, path, batch(spark, event(v, v), event(1, v)), bucket_rows=10)
    found = [r["version"] for r in versions.bases(spark, path).orderBy("version").collect()]
    assert found == [1, 3, 6]
    state = {r["uid"]: json.loads(r["payload"])["v"] for r in versions.current(spark, path).filter("uid IS NOT NULL").collect()}
    assert state == {str(i): 1 for i in range(8, 101)} | {str(v): v for v in range(2, 8)} | {"1": 7, "202": 1, "203": 1}


def test_an_unfinished_compaction_is_not_seen(spark, path, monkeypatch):
    versions.integrate(spark, path, batch(spark, event(1), event(2)))
    versions.integrate(spark, path, batch(spark, event(1, 2)), compacting=False)
    with monkeypatch.context() as broken:
        broken.setattr(versions, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            versions.compact(spark, path)
    assert [r["version"] for r in versions.bases(spark, path).orderBy("version").collect()] == [1]
    versions.integrate(spark, path, batch(spark, event(2, 3)), compacting=False)
    state = {r["uid"]: json.loads(r["payload"])["v"] for r in versions.current(spark, path).collect()}
    assert state == {"1": 2, "2": 3}


def test_the_journal_names_a_replayed_batch(spark, path):
    a, b = [event(1), event(2)], [event(2, 5)]
    found = [versions.integrate(spark, path, batch(spark, *x)) for x in (a, a, b, list(reversed(a)), b)]
    assert [(r["nb_ajoutes"], r["nb_mis_a_jour"], r["nb_doublons"], r["rejoue"]) for r in found] == [
        (2, 0, 0, None), (0, 0, 2, 1), (0, 1, 0, None), (0, 1, 1, 1), (0, 1, 0, 3)
    ]


def test_keyless_content(spark, path):
    rows = [{"v": 1}, {"v": 1.0}, {"v": 2}]
    first = versions.integrate(spark, path, batch(spark, *rows), keyless="content_hash")
    assert (first["nb_ajoutes"], first["nb_doublons"]) == (2, 1)
    again = versions.integrate(spark, path, batch(spark, *rows, {"v": 3}), keyless="content_hash")
    assert (again["nb_ajoutes"], again["nb_apres_fusion"]) == (1, 3)
    assert versions.current(spark, path).count() == 3


def test_cursor(spark, path):
    assert versions.read_cursor(spark, path) is None
    versions.write_cursor(spark, path, [3, 17], 20, 100)
    assert versions.read_cursor(spark, path)["curseur_after"] == [3, 17]
    versions.write_cursor(spark, path, None, 5, 100)
    last = versions.read_cursor(spark, path)
    assert last["curseur_after"] is None and last["fin_de_liste"] and last["nb_agendas_session"] == 5
    assert versions.resume_from(spark, path) is None
    assert versions.write_cursor(spark, path, [4], 1, 1, "s", 0) and not versions.write_cursor(spark, path, [9], 1, 1, "s", 0)
    assert versions.resume_from(spark, path) == [4] and versions.cursors(spark, path).count() == 3


def test_stream_of_pages(spark, pages, tmp_path):
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "checkpoint")
    log = collect.collect(spark, pages, root, checkpoint).collect()
    assert [(r["nb_nouveaux"], r["nb_apres_fusion"]) for r in log] == [(8, 8)]
    assert versions.read_cursor(spark, root)["fin_de_liste"]
    write(f"{pages}/events/3.json", {"agenda_uid": "a", "events": [event(1, 5), event(200)]})
    log = collect.collect(spark, pages, root, checkpoint).collect()
    assert [(r["nb_ajoutes"], r["nb_mis_a_jour"]) for r in log] == [(8, 0), (1, 1)]
    assert collect.collect(spark, pages, root, checkpoint).count() == 2
    by_uid = {r["uid"]: json.loads(r["payload"])["v"] for r in versions.current(spark, root).collect()}
    assert by_uid["1"] == 5 and by_uid["200"] == 1 and len(by_uid) == 9


def test_clean_tables(spark, path):
    record = {"uid": 1, "title": {"fr": 'Un "titre",\nlong'}, "description": {"fr": "  é" * 40}, "location": {"city": "Ville"}}
    clean = corpus.clean_corpus(batch(spark, record), "https://x.org")
    assert clean.columns == schemas.CLEAN_COLUMNS
    assert tables.write_clean(clean, f"{path}/v1")
    back = tables.read_clean_csv(spark, f"{path}/v1/csv")
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in clean.collect()]
    assert spark.read.json(f"{path}/v1/json").count() == 1
    stats = spark.read.json(f"{path}/v1/statistics").first()
    assert stats["nombre_evenements"] == 1 and stats["completude"]["titre"] == "100.0%" and stats["colonnes"] == schemas.CLEAN_COLUMNS
    assert not tables.write_clean(clean.limit(0), f"{path}/v2")
    back.drop("id").write.option("header", True).csv(f"{path}/v3")
    with pytest.raises(ValueError, match="id"):
        tables.read_clean_csv(spark, f"{path}/v3")
    with pytest.raises(AnalysisException):
        tables.load_index(spark, f"{path}/missing")


def test_hot_key_is_cut_into_runs(spark):
    from recueil.operators import merge as M

    log = spark.range(3 << M._RUN_BITS, (3 << M._RUN_BITS) + 10).select(F.lit("hot").alias("uid"), F.col("id").alias("pos"))
    assert M.with_runs(log).select("run").distinct().collect()[0][0] == 3
    nested = log.withColumn("pos", F.struct(F.lit("f").alias("file"), F.lit(0).alias("block"), F.col("pos").alias("at")))
    assert tuple(M.with_runs(nested).select("run.*").first()) == ("f", 0)


@pytest.mark.parametrize("kind", ["string", "timestamp", "decimal(30,2)"])
def test_a_hot_key_in_any_order_is_compared_in_many_tasks(spark, kind):
    from recueil.operators import merge as M

    pos = F.lpad("id", 9, "0") if kind == "string" else F.col("id")
    log = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("uid"), pos.cast(kind).alias("pos"),
        F.lit("p").alias("payload"), F.encode((F.floor(F.col("id") / 3) % 2).cast("string"), "UTF-8").alias("digest"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert M.with_runs(log).filter("uid = 'hot'").select("run").distinct().count() > 1
        counts = tuple(M.merge_counts(log.limit(0), log).first())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # Pairs of equal hot rows in turn; the first one adds the key.
    assert counts == (20_000, 6668, 6666, 6666)


@pytest.mark.parametrize("n", [3, 1500])
def test_first_rows_of_a_hot_group(spark, n):
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id") % 10).alias("k"), (-F.col("id")).alias("o"))
    found = {}
    for r in landing.first_per_group(df, "k", "o", n).collect():
        found.setdefault(r["k"], []).append(r["o"])
    rows = {}
    for i in range(5999, -1, -1):
        rows.setdefault(-1 if i % 3 else i % 10, []).append(-i)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v[:n]) for k, v in rows.items()}


def test_numbered_files_count_by_number(spark, path):
    import os

    for n in (2, 10):
        name = f"{path}/pages/p-{n}.json"
        os.makedirs(os.path.dirname(name), exist_ok=True)
        with open(name, "w") as f:
            f.write(json.dumps({"agendas": [{"uid": "a", "title": str(n)}], "after": [n], "total": 9}) + "\n")
    assert landing.next_cursor(landing.agenda_pages(spark, f"{path}/pages")).first()["curseur_after"] == [10]


@pytest.mark.parametrize("files", [1, 1000])
def test_batches_do_not_change_what_is_merged(spark, path, files):
    import os

    os.makedirs(f"{path}/in")
    for n in range(2):
        events = [{"uid": str(100 * n + i)} for i in range(40)]
        with open(f"{path}/in/e-{n}.json", "w") as f:
            f.write(json.dumps({"agenda_uid": "a", "events": events}) + "\n")
    collect.merge_event_pages(spark, f"{path}/in", f"{path}/root", f"{path}/check", files_per_batch=files).awaitTermination()
    assert versions.current(spark, f"{path}/root").count() == 80


def test_pages_are_limited_before_they_are_taken_apart(spark):
    pages = [("a", 0, 2), ("a", 1, 0), ("b", 2, 5), ("a", 3, 4), ("a", 4, 1), ("", 5, 3), (None, 6, 3), ("b", 7, 1)]
    rows = [(("f", "p"), 0, line, uid, [f"{line}.{i}" for i in range(n)] if n else None) for uid, line, n in pages]
    df = spark.createDataFrame(rows, "file STRUCT<place: STRING, path: STRING>, block LONG, line LONG, agenda_uid STRING, events ARRAY<STRING>")
    for limit, wanted in ((1, ["0.0"]), (3, ["0.0", "0.1", "3.0"]), (7, ["0.0", "0.1", "3.0", "3.1", "3.2", "3.3", "4.0"]), (2000, None)):
        first = landing.first_events(df, limit)
        found = [r["payload"] for r in first.filter("agenda_uid = 'a'").orderBy("seq").collect()]
        assert found == (wanted or ["0.0", "0.1", "3.0", "3.1", "3.2", "3.3", "4.0"])
    plan = landing.first_events(df, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Window")
    with pytest.raises(ValueError):
        landing.first_events(df, 0)


def _least_seconds(df, column):
    def once():
        began = time.perf_counter()
        df.select(column).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    return min(once() for _ in range(3))


def test_files_are_ordered_at_the_cost_of_their_digits(spark):
    """Numbers are padded to twenty digits; zeros put before them are not tried from the longest run down."""
    paths = ["", "page", "p2", "p10/a03", "0", "00012", "9" * 20, "9" * 21, "0" * 21, "0" * 30 + "7", "12" + "0" * 25, "7" + "0" * 4 + "3" * 20, "a1b22c333"]
    greedy = F.regexp_replace(F.regexp_replace("path", r"(\d+)", "0000000000000000000$1"), r"0*(\d{20})(?!\d)", "$1")
    rows = spark.createDataFrame([(x,) for x in paths], "path STRING").select(arrays.file_order(F.col("path"))["place"].alias("place"), greedy.alias("old")).collect()
    assert all(r["place"] == r["old"] for r in rows)
    name = F.concat(F.lit("file:/tmp/landing/part-0000"), F.col("id"), F.lit("-de9bff81-667c-49b5-ad22-f2430db072a5-c000.txt"))
    path = spark.range(0, 200_000, 1, 4).select(name.alias("path"))
    assert _least_seconds(path, arrays.file_order(F.col("path"))["place"]) < 0.7 * _least_seconds(path, greedy)
