import math

import pytest
from pyspark.sql import functions as F

from fieldmark.functions import geo, lookup, nested, numeric, text


def one(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_ieee_div(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (1.0, 0.0), (-1.0, 0.0), (1.0, 4.0), (None, 1.0), (1.0, None)], "a double, b double"
    )
    got = [r[0] for r in df.select(numeric.ieee_div(F.col("a"), F.col("b"))).collect()]
    assert math.isnan(got[0]) and got[1:] == [math.inf, -math.inf, 0.25, None, None]


def test_nan_to_null(spark):
    assert one(spark, [1.0, float("nan"), None], "double", numeric.nan_to_null) == [1.0, None, None]


def test_floor_bucket(spark):
    assert one(spark, [0, 99, 100, 250], "int", lambda c: numeric.floor_bucket(c, 100)) == [0, 0, 100, 200]


def test_first_number(spark):
    cells = ["Oui", "non", "1,5", "-5", "1 234", "abc", None, "12 ha", "1,2,3"]
    assert one(spark, cells, "string", text.first_number) == [1, 0, 1.5, 5, 1, None, None, 12, 1.2]


def test_plain_number(spark):
    cells = ["Oui", "NON", "1,5", "-5", "1d", " 12 ", "1e3", None]
    assert one(spark, cells, "string", text.plain_number) == [1, 0, None, -5, None, None, 1000, None]


def test_replace_first(spark):
    got = one(spark, ["a,b,c", "abc", None, ",x"], "string", lambda c: text.replace_first(c, ",", "."))
    assert got == ["a.b,c", "abc", None, ".x"]


def test_extract_without_match_is_null(spark):
    assert one(spark, ["x2024", "x", None], "string", lambda c: text.extract(c, r"(\d{4})")) == ["2024", None, None]


@pytest.mark.parametrize(
    ("label", "wanted"),
    [
        ("  Marchés à bétail  ", "marche a betail"),
        ("Plans nationaux", "plan national"),
        ("Taux de prix plus ou moins sous", "taux prix plus moins sous"),
        ("Dont femmes", "dont femme"),
        ("les œuvres d’été (y compris l'eau)", "œuvre dete y compri leau"),
        ("des choix\tdu pays", "choi pay"),
        ("aux", "al"),
        ("axs x s", "a"),
        ("prix/taux", "prixtaux"),
        ("", ""),
    ],
)
def test_normalise_label(spark, label, wanted):
    assert one(spark, [label], "string", text.normalise_label) == [wanted]


def test_normalise_label_null(spark):
    assert one(spark, [None], "string", text.normalise_label) == [None]


def test_contains_any_case_with_accents(spark):
    got = one(
        spark,
        ["INDICATEUR SUPPRIMÉ en 2025", "Indicateur changé", "autre", None],
        "string",
        lambda c: text.contains_any_case(c, "indicateur supprimé", "indicateur changé"),
    )
    assert got == [True, True, False, None]


def test_january_first(spark):
    assert one(spark, [2024, None], "int", text.january_first) == ["2024-01-01", None]


def test_lookups(spark):
    table = {"a": "1", "b": "2"}
    assert one(spark, ["a", "z", None], "string", lambda c: lookup.relabel(c, table)) == ["1", "z", None]
    assert one(spark, ["a", "z", None], "string", lambda c: lookup.lookup(c, table)) == ["1", None, None]
    groups = {"x": ["a"], "y": ["a", "b"]}
    assert one(spark, ["a", "b", "c"], "string", lambda c: lookup.member_of(c, groups)) == ["x", "y", None]


def test_point_part(spark):
    points = [[1.0, 2.0], [0.0, 2.0], [None, 2.0], [], None]
    got = one(spark, points, "array<double>", lambda c: nested.point_part(c, 0))
    assert got == [1.0, None, None, None, None]


def test_to_json_or_null(spark):
    df = spark.createDataFrame([([("é", None)], ("x", None)), ([], None)], "l array<struct<a:string,b:int>>, s struct<a:string,b:int>")
    got = df.select(
        nested.to_json_or_null(F.col("l"), df.schema["l"].dataType),
        nested.to_json_or_null(F.col("s"), df.schema["s"].dataType),
    ).collect()
    assert tuple(got[0]) == ('[{"a":"é","b":null}]', '{"a":"x","b":null}')
    assert tuple(got[1]) == (None, None)


def test_public_url(spark):
    got = one(spark, [None, "", "a.jpg"], "string", lambda c: nested.public_url(c, "http://x/"))
    assert got == ["http://x/placeholder.png", "http://x/placeholder.png", "http://x/a.jpg"]


def test_last_segment(spark):
    assert one(spark, ["a/b/c.jpg", "c.jpg", None], "string", nested.last_segment) == ["c.jpg", "c.jpg", None]


def test_haversine(spark):
    df = spark.createDataFrame([(14.0, -3.0, 14.0, -3.0), (0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geo.haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    assert got[0] == 0 and abs(got[1] - 6372.8 * math.pi / 180) < 1e-9


def test_wkt(spark):
    df = spark.createDataFrame([(1.5, 2.0), (None, 2.0)], "lon double, lat double")
    assert [r[0] for r in df.select(geo.wkt_point(F.col("lon"), F.col("lat"))).collect()] == ["POINT (1.5 2.0)", None]
