import json
import re

import pytest
from pyspark.sql import functions as F

from recueil.functions import prompts
from recueil.functions import text as T


def apply(spark, values, fn):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", fn(F.col("v")).alias("out"))
    return [r["out"] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ('{"en": "e", "fr": "f"}', "f"),
        ('{"de": "d", "en": "e"}', "e"),
        ('{"it": "i", "de": "d"}', "i"),
        ('{"fr": "", "en": "e"}', ""),
        ('{"fr": null, "en": "e"}', None),
        ("{}", ""),
        ("plain", "plain"),
        ("{not json", "{not json"),
        (None, ""),
    ],
)
def test_language_by_presence(spark, raw, expected):
    assert apply(spark, [raw], T.pick_language) == [expected]


def test_language_non_empty(spark):
    values = ['{"fr": "", "en": "e"}', '{"fr": null, "de": "", "it": "i"}', '{"fr": ""}']
    assert apply(spark, values, lambda c: T.pick_language(c, fallback="non_empty")) == ["e", "i", ""]
    with pytest.raises(ValueError):
        T.pick_language(F.col("v"), fallback="other")


def test_keywords(spark):
    values = ['{"fr": ["a", "b"]}', '["x", null, "y"]', "solo", '{"en": ["a"]}', '{"fr": "one"}', "[]", None, "[broken"]
    assert apply(spark, values, T.join_keywords) == ["a, b", "x, y", "solo", "", "one", "", "", "[broken"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2026-04-08T14:00:00.000+02:00", "2026-04-08 14:00:00"),
        ("2026-04-08T14:00:00+0200", "2026-04-08 14:00:00"),
        ("2026-04-08T14:00:00Z", "2026-04-08 14:00:00"),
        ("2026-04-08T14:00:00", "2026-04-08 14:00:00"),
        ("2026-4-8T9:05:1", "2026-04-08 09:05:01"),
        ("2026-03-29T02:30:00+01:00", "2026-03-29 02:30:00"),
        ("2026-04-08T14:00:00.123+02:00", "2026-04-08T14:00:00.123+02:00"),
        ("2026-02-31T10:00:00", "2026-02-31T10:00:00"),
        ("2026-04-08T24:00:00", "2026-04-08T24:00:00"),
        ("2026-04-08", "2026-04-08"),
        ("", ""),
        (None, ""),
    ],
)
def test_wall_clock(spark, raw, expected):
    assert apply(spark, [raw], T.wall_clock) == [expected]


def test_wall_clock_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        assert apply(spark, ["2026-03-29T02:30:00"], T.wall_clock) == ["2026-03-29 02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_url(spark):
    df = spark.createDataFrame([("a", "s"), (None, "s"), ("", "s"), ("a", ""), ("a", None)], "agenda string, slug string")
    urls = [r[0] for r in df.select(T.build_url("https://x.org/", F.col("agenda"), F.col("slug"))).collect()]
    assert urls == ["https://x.org/a/events/s", "https://x.org/events/s", "https://x.org/events/s", "", ""]


def test_every_entity(spark):
    values = [entity for entity, _ in T.ENTITIES]
    assert apply(spark, [f"a{v}b" for v in values], T.strip_html) == [f"a{char}b" for _, char in T.ENTITIES]


def test_html_order_and_limits(spark):
    values = ["a<br>b", "&amp;lt;b&gt;", "&copy; &EACUTE;", "  x  \u001c\n y ", "", None, "1 < 2", "<>x"]
    assert apply(spark, values, T.strip_html) == ["ab", "<b>", "&copy; &EACUTE;", "x y", "", None, "1 < 2", "<>x"]


def test_spaces_agree_with_python(spark):
    chars = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000 and chr(c) not in "xy"]
    values = [f" x{c}{c}y{c}" for c in chars]
    assert apply(spark, values, T.collapse_spaces) == [re.sub(r"\s+", " ", v).strip() for v in values]
    blank = apply(spark, chars, T.not_blank)
    assert blank == [c.strip() != "" for c in chars]


def test_compose_skips_empty_and_repeated(spark):
    df = spark.createDataFrame(
        [("t", "d", "d", "v", "", "", "1", "1"), ("", " ", "l", "", "a", "c", "", "2"), (None,) * 8],
        "t string, d string, l string, v string, a string, c string, b string, e string",
    )
    out = [r[0] for r in df.select(T.compose_text(*[F.col(c) for c in "tdlvacbe"])).collect()]
    assert out[0] == "Titre: t\nDescription: d\nLieu: v\nDate de début: 1"
    assert out[1] == "Description:  \nDétails: l\nLieu: a\nDate de fin: 2\nCatégories: c"
    assert out[2] == ""


def test_excerpt(spark):
    assert apply(spark, ["x" * 100, "x" * 101, None], T.excerpt) == ["x" * 100, "x" * 100 + "...", None]


def test_canonical_json(spark):
    same = ['{"a": 1, "b": [1, 2]}', '{"b": [1, 2], "a": 1.0}']
    a, b = apply(spark, same, T.canonical_json)
    assert a == b and json.loads(a) == {"a": 1, "b": [1, 2]}
    c, d = apply(spark, ['{"b": [2, 1]}', "not json"], T.canonical_json)
    assert c == '{"b":[2,1]}' and d == "not json"


def test_blocks_and_lines(spark):
    columns = "rank int, titre string, description string, ville string, date_debut string, date_fin string, lieu_nom string, categorie string, s double"
    df = spark.createDataFrame([(1, "T", None, "V", "D", "", None, "C", 0.456)], columns)
    row = df.select(
        prompts.hit_text().alias("text"),
        prompts.context_block(F.col("rank"), F.col("s")).alias("block"),
        prompts.context_block(F.col("rank")).alias("bare"),
        prompts.simple_line(F.col("rank")).alias("line"),
    ).first()
    assert row["text"] == "Titre: T\nVille: V\nDate de début: D\nCatégorie: C"
    assert row["block"] == (
        "Événement 1:\nTitre: T\nDescription: N/A\nVille: V\nDate de début: D\nDate de fin: \n"
        "Lieu: N/A\nCatégorie: C\nScore de pertinence: 0.46\n"
    )
    assert row["bare"] == row["block"].replace("Score de pertinence: 0.46\n", "")
    assert row["line"] == "1. T - V - D"
