import uuid

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import scores, text, values


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn("v").alias("r")).first().r


@pytest.mark.parametrize(
    "title,key",
    [
        ("Budget Law FY2024", "budget law"),
        ("Rice Exports (2008-2023)", "rice exports"),
        ("Trade 2023 - 2024 by Province", "trade by province"),
        ("Form x2024 and 20245", "form x2024 and 20245"),
        ("Café fy 2020", "caf"),
        ("ថវិកា ២០២៤", ""),
        ("ចំណូល2024", "2024"),
        ("a_2024", "a 2024"),
        ("", ""),
    ],
)
def test_normalize_title(spark, title, key):
    assert one(spark, title, text.normalize_title) == key


@pytest.mark.parametrize(
    "name,out",
    [
        ("ref_year", "year"),
        ("ref_year_en", "year"),
        ("Month Num", "month"),
        ("Province EN", "province"),
        ("partner_country_en", "partner_country"),
        ("Partner Country EN", "country_partner"),
        ("Capital / Province", "province"),
        ("  Total (USD) ", "total_usd"),
        ("value_kh", "value"),
        (" Name_km ", "name"),
        ("ខេត្ត", ""),
    ],
)
def test_normalize_column(spark, name, out):
    assert one(spark, name, text.normalize_column) == out


def test_strip_script(spark):
    assert one(spark, "Rice ស្រូវ  yield", text.strip_script) == "Rice yield"
    assert one(spark, None, text.strip_script) == ""


def test_semantic_string(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", None), ("a", ""), (": a", " b: ")], "t string, d string")
    got = [r.s for r in rows.select(text.semantic_string("t", "d").alias("s")).collect()]
    assert got == ["a: b", "a", "a", "a:  b"]


def test_join_names(spark):
    row = spark.createDataFrame([(["Trade", "ពាណិជ្ជកម្ម", " Farm  land "],)], "n array<string>")
    got = row.select(text.join_names(F.col("n")).alias("a"), text.join_names(F.col("n"), True).alias("b")).first()
    assert got == ("Trade, Farm land", "Trade, , Farm land")


def test_uuid5(spark):
    for t in ["ref_year", "ខេត្ត", "", "a b c"]:
        assert one(spark, t, values.uuid5) == str(uuid.uuid5(uuid.NAMESPACE_URL, t))


def test_truthiness(spark):
    df = spark.createDataFrame([("", "x", 0, 3), (None, "", None, 0)], "a string, b string, n int, m int")
    got = df.select(values.first_truthy("a", "b"), values.first_nonzero("n", "m")).collect()
    assert [tuple(r) for r in got] == [("x", 3), (None, None)]


def test_usable_id(spark):
    df = spark.createDataFrame([("", "s", "u"), ("i", "s", "u"), (None, None, "u"), ("", "", "")], "id string, slug string, uuid string")
    assert [r[0] for r in df.select(values.usable_id()).collect()] == ["s", "i", "u", None]


@pytest.mark.parametrize("t,n", [("1,200,000", 1200000.0), (" 12.5 ", 12.5), ("-3", -3.0), ("n/a", None), (None, None), ("", None)])
def test_parse_number(spark, t, n):
    assert one(spark, t, values.parse_number) == n


def test_times(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05",), ("2024-01-02T10:04:05+07:00",), ("soon",)], "t string")
    got = [r.s for r in df.select(values.iso_utc(values.parse_time("t")).alias("s")).collect()]
    assert got == ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05Z", None]
    assert df.select(values.date_stamp(values.parse_time("t")).alias("s")).first().s == "20240102"


def test_jaccard_is_symmetric_and_zero_on_empty(spark):
    df = spark.createDataFrame(
        [(["a", "b"], ["b", "c"]), ([], []), (["a"], []), (["a"], ["a"])], "a array<string>, b array<string>"
    )
    got = df.select(scores.jaccard("a", "b").alias("x"), scores.jaccard("b", "a").alias("y")).collect()
    assert [r.x for r in got] == [pytest.approx(1 / 3), 0.0, 0.0, 1.0]
    assert all(r.x == r.y for r in got)


def test_token_overlap(spark):
    df = spark.createDataFrame([("rice export rice", "rice import"), ("", "rice")], "a string, b string")
    got = [r[0] for r in df.select(scores.token_overlap("a", "b")).collect()]
    assert got == [pytest.approx(1 / 3), 0.0]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [round(r[0], 6) for r in df.select(scores.cosine("a", "b")).collect()] == [0.707107, 0.0]
    ragged = spark.createDataFrame([([1.0], [1.0, 1.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="differ in length"):
        ragged.select(scores.cosine("a", "b")).collect()


@pytest.mark.parametrize(
    "a,b,want",
    [
        (("Annual", "2010", "2020"), ("Annual", "1990", "1991"), 1.0),
        (("Annual", "2010", None), ("Annual", "2010", "2020"), 0.5),
        (("Annual", "2010", "2020"), ("Monthly", "2010", "2020"), 0.5),
        ((None, "", "2020"), (None, "2010", "2020"), 0.0),
        (("", None, None), ("", None, None), 0.0),
    ],
)
def test_temporal(spark, a, b, want):
    df = spark.createDataFrame([(*a, *b)], "fa string, sa string, ea string, fb string, sb string, eb string")
    got = df.select(
        scores.temporal_compat(
            F.col("fa"), scores.is_covered("sa", "ea"), F.col("fb"), scores.is_covered("sb", "eb")
        )
    ).first()[0]
    assert got == want


def test_weights_and_reasons(spark):
    df = spark.range(1)
    lit = F.lit
    w = df.select(
        scores.weighted_score(lit(1.0), lit(0.5), lit(1.0)),
        scores.weighted_score(lit(1.0), lit(1.0), lit(1.0), scores.PLANNED_WEIGHTS, lit(1.0)),
    ).first()
    assert [round(x, 6) for x in w] == [0.875, 1.0]
    many = F.array(*[lit(c) for c in "abcdef"])
    none = F.array().cast("array<string>")
    r = df.select(
        scores.explain_match(many, lit(True), lit(False)),
        scores.explain_match(none, lit(False), lit(True)),
        scores.explain_match(none, lit(False), lit(False)),
    ).first()
    assert list(r) == ["shared columns: a, b, c, d, e; same category", "same organization", "similar title and schema"]
