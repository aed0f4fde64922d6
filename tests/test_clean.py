import json

from pyspark.sql import functions as F

from recueil import schemas
from recueil.operators import clean as C
from recueil.operators import profile as P


def event(uid, title="Titre", description="d" * 50, city="Ville", **more):
    record = {"uid": uid, "title": {"fr": title}, "description": {"fr": description}, "location": {"city": city}, **more}
    return json.dumps(record, ensure_ascii=False)


def extracted(spark, payloads):
    rows = list(enumerate(payloads))
    return C.extract_events(spark.createDataFrame(rows, "seq long, payload string"), "https://x.org")


def test_full_record(spark):
    payload = json.dumps({
        "uid": 7, "title": {"fr": "Concert"}, "description": "texte", "longDescription": {"en": "long"},
        "location": {"city": "Paris", "address": "Rue", "region": "IDF"}, "keywords": {"fr": ["a", "b"]},
        "firstTiming": {"begin": "2026-08-01T20:00:00.000+03:00"}, "lastTiming": {"end": "2026-08-01T23:00:00.000+03:00"},
        "slug": "s", "originAgenda": {"slug": "ag"}, "other": [1, 2],
    })
    row = extracted(spark, [payload]).drop("seq").first()
    assert list(row.asDict()) == schemas.CLEAN_COLUMNS
    assert tuple(row)[:11] == (
        "7", "Concert", "texte", "long", "Paris", "Rue", "IDF", "2026-08-01 20:00:00", "2026-08-01 23:00:00", "a, b",
        "https://x.org/ag/events/s",
    )


def test_malformed_elements_are_set_aside(spark):
    df = spark.createDataFrame([(0, "5"), (1, "{bad"), (2, event(1)), (3, '"x"'), (4, '{"location": "text"}'), (5, None)], "seq long, payload string")
    assert [r["seq"] for r in C.malformed(df).orderBy("seq").collect()] == [0, 1, 3, 5]
    assert [r["seq"] for r in C.well_formed(df).orderBy("seq").collect()] == [2, 4]
    assert C.extract_events(df, "u").count() == 2


def test_missing_fields_and_null_location(spark):
    row = extracted(spark, ['{"location": null, "originAgenda": null, "keywords": null}']).first()
    assert set(row.asDict()[c] for c in schemas.CLEAN_COLUMNS) == {""}


def test_first_duplicate_hides_a_later_valid_one(spark):
    rows = [event(1, description="short"), event(1), event(2), event(2, title="zweite"), event("2", title="dritte")]
    clean = C.clean_events(extracted(spark, rows)).collect()
    assert [(r["id"], r["titre"]) for r in clean] == [("2", "Titre")]


def test_length_is_measured_before_cleaning(spark):
    tagged = "<b>" + "x" * 20 + "</b>" + " " * 30
    rows = [event(1, description="x" * 49), event(2, description="x" * 50), event(3, description=tagged)]
    clean = {r["id"]: r["description"] for r in C.clean_events(extracted(spark, rows)).collect()}
    assert clean == {"2": "x" * 50, "3": "x" * 20}


def test_blank_title_description_city(spark):
    rows = [event(1, title="  "), event(2, description=" " * 60), event(3, city="\n"), event(4, title=None), event(5)]
    assert [r["id"] for r in C.clean_events(extracted(spark, rows)).collect()] == ["5"]
    counts = {r["rule"]: r["n"] for r in C.rejection_counts(extracted(spark, rows + [event(5)])).collect()}
    assert counts == {"duplicate": 1, "no_title": 2, "no_description": 1, "short_description": 0, "no_city": 1, "kept": 1}


def test_text_is_composed_after_cleaning(spark):
    row = C.clean_events(extracted(spark, [event(1, description="<i>" + "é" * 60 + "</i>", city="  Le   Mans ")])).first()
    assert row["texte_complet"] == "Titre: Titre\nDescription: " + "é" * 60 + "\nLieu: Le Mans"


def test_empty_input_keeps_the_schema(spark):
    empty = C.extract_events(spark.createDataFrame([], "seq long, payload string"), "u")
    assert C.clean_events(empty).drop("seq").columns == schemas.CLEAN_COLUMNS
    assert [r["n"] for r in C.rejection_counts(empty).collect()] == [0] * 6
    assert P.summary(C.clean_events(empty)).count() == 0
    assert {r["percent"] for r in P.fill_rates(empty.drop("seq")).collect()} == {0.0}


def test_event_key(spark):
    payloads = ['{"uid": 5}', '{"uid": "5"}', '{"uid": 0}', '{"uid": "0"}', '{"uid": ""}', '{"uid": null}', "{}", "x"]
    df = spark.createDataFrame(list(enumerate(payloads)), "i int, payload string")
    keys = [r[0] for r in df.orderBy("i").select(C.event_key(F.col("payload"))).collect()]
    assert keys == ["5", "5", None, "0", None, None, None, None]


def test_hot_key_is_limited_before_the_shuffle(spark):
    plan = C.keep_first(spark.range(10).selectExpr("id % 2 AS k", "id"), "k", "id")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan"):]
    assert physical.count("WindowGroupLimit") == 2


def test_fill_rules_differ_on_nulls_and_blanks(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("x",)], "c string")
    rate = lambda rule: P.fill_rates(df, rule=rule).first()["percent"]
    assert (rate("trimmed"), rate("strict"), rate("not_empty")) == (25.0, 50.0, 75.0)


def test_counts_and_lengths(spark):
    df = spark.createDataFrame([("b", "é😀"), ("a", "xyzt"), ("a", ""), (None, "x")], "ville string, t string")
    assert [tuple(r) for r in P.value_counts(df, "ville", 10).collect()] == [("a", 2), ("b", 1)]
    assert tuple(P.row_and_value_counts(df, "ville").first()) == (4, 2)
    assert tuple(P.length_stats(df, ["t"]).first()) == ("t", 0, 4, 1)


def test_display_sample(spark):
    clean = C.clean_events(extracted(spark, [event(i, description="x" * 200) for i in range(5)]))
    rows = C.display_sample(clean, "seq", 2).collect()
    assert len(rows) == 2 and rows[0]["description"] == "x" * 100 + "..."
    assert C.display_sample(clean, "seq", 0).count() == 0 and C.display_sample(clean, "seq", -1).count() == 0
