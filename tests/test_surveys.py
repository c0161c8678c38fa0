import json
from datetime import date

from fieldmark.plans import fixed_values as fixed
from fieldmark.plans.attachments import fetch_manifest, publish_manifest
from fieldmark.plans.catalogue import definitions
from fieldmark.plans.indicators import Projects, combine_indicators, indicator_table
from fieldmark.plans.surveys import point_table, standardise, survey_snapshots, transform_survey

SCHEMA = """_id long, DATE date, LMB1 string, LMB2 string, LMB3 string, LMB4 string, LMB5 string,
LMB6 struct<a:string,b:int>, STMB5 string, _validation_status struct<label:string>, _geolocation array<double>,
_attachments array<struct<download_url:string,filename:string>>, LMB7a string, LMB7b string, LMB7c string, LMB7d string,
CMOP1 string, CMOP3 string, CMOP4 string, CMOP6 string, IGMB5 string, IGMB7 int, IGMB8 int, IGMBA array<string>"""


def market(i, day, point, **more):
    row = dict(
        _id=i, DATE=day, LMB1="Mali", LMB2="Gao", LMB3="p", LMB4="c", LMB5="l", LMB6=("é", None), STMB5=None,
        _validation_status=("Approved",), _geolocation=point, _attachments=[], LMB7a=None, LMB7b="", LMB7c="x.jpg", LMB7d=None,
        CMOP1=None, CMOP3=None, CMOP4=None, CMOP6=None, IGMB5=None, IGMB7=None, IGMB8=None, IGMBA=None,
    ) | more
    return tuple(row.values())


def markets(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_standard_columns(spark):
    df = markets(spark, market(1, date(2023, 1, 1), [14.0, -3.0], STMB5="ok"), market(2, None, [0.0, 1.0], _validation_status=None))
    first, second = sorted(standardise(df, "marches_a_betail", "http://p/").collect(), key=lambda r: r._id)
    assert (first.validation_status, first.LATITUDE, first.LONGITUDE) == ("Approved", 14.0, -3.0)
    assert (first.level_2, first.level_6, first.STATE) == ("Mali", "l", "ok")
    assert json.loads(first.level_7) == {"a": "é", "b": None} and first._attachments is None
    assert (first.LMB7a, first.LMB7b, first.LMB7c) == ("http://p/placeholder.png", "http://p/placeholder.png", "http://p/x.jpg")
    assert (second.validation_status, second.LATITUDE) == (None, None)
    assert "PROGRESS" not in first.asDict()


def test_sites_snapshots_and_points(spark):
    df = markets(
        spark,
        market(1, date(2022, 1, 1), [14.0, -3.0]),
        market(2, date(2024, 1, 1), [14.0, -3.0]),
        market(3, None, [14.5, -3.0]),
        market(4, date(2023, 1, 1), None),
    )
    sites, latest = transform_survey(df, "marches_a_betail", "http://p/")
    assert {r._id: r.infrastructure_id for r in sites.collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {r._id for r in latest.collect()} == {2, 3, 4}
    got = sorted((r.infrastructure_id, r.over_year, r._id) for r in survey_snapshots(sites).collect())
    assert got == [(1, 2022, 1), (1, 2023, 1), (1, 2024, 2), (4, 2023, 4), (4, 2024, 4)]
    points = {r._id: r.geometry for r in point_table(latest).collect()}
    assert points == {2: "POINT (-3.0 14.0)", 3: "POINT (-3.0 14.5)"}


def test_country_survey_is_left_whole(spark):
    df = spark.createDataFrame([("Mali", 1), ("Mali", 2)], "DATE4 string, x int")
    one, two = transform_survey(df, fixed.COUNTRY_SURVEY, "http://p/")
    assert one.count() == two.count() == 2 and one.first().level_2 == "Mali"


def test_state_rule(spark):
    yes = dict(CMOP1="Oui", CMOP3="Oui", CMOP4="Oui", CMOP6="Oui")
    df = markets(
        spark,
        market(1, date(2023, 1, 1), None, STMB5=fixed.STATE_PROVISIONAL),
        market(2, date(2023, 1, 1), None, STMB5=fixed.STATE_FINAL, **yes),
        market(3, date(2023, 1, 1), None, STMB5=fixed.STATE_FINAL, **(yes | {"CMOP4": None})),
        market(4, date(2023, 1, 1), None),
    )
    facts = combine_indicators({"marches_a_betail": df}, None)
    assert facts.filter("indicator_code = 'IRI-8'").count() == 2
    coordinates = json.loads(facts.first().coordinates)
    assert coordinates["a"] == "é"


def test_women_in_office(spark):
    def place(i, members, women, offices):
        return market(i, date(2023, 1, 1), None, IGMB5="Oui", IGMB7=members, IGMB8=women, IGMBA=offices)

    df = markets(
        spark,
        place(1, 20, 3, ["Président (e)"]),
        place(2, 20, 2, ["Président (e)"]),
        place(3, 0, 3, ["Président (e)"]),
        place(4, 20, 5, ["Membre"]),
        place(5, None, 5, None),
    )
    facts = combine_indicators({"marches_a_betail": df}, None).filter("indicator_code = 'IRI-16'")
    assert sorted(r.value for r in facts.collect()) == [0, 0, 0, 0, 1]
    without = combine_indicators({"marches_a_betail": df.drop("IGMBA")}, None)
    assert without.filter("indicator_code = 'IRI-16'").count() == 0


def test_variants_replace_definitions(spark):
    income = spark.createDataFrame([(date(2023, 1, 1), 10.0, 4.0)], "DATE date, VAAGR6 double, VAAGR7 double")
    for column in ("LAGR1", "LAGR2", "LAGR3", "LAGR4", "LAGR5", "LAGR6", "VAAGR7A", "VAAGR8", "VAAGR9", "VAAGR10", "VAAGR11"):
        income = income.selectExpr("*", f"CAST(NULL AS DOUBLE) AS {column}")
    tables = {"activites_generatrices_de_revenus": income}

    def women(definitions_):
        return combine_indicators(tables, None, definitions=definitions_).filter("indicator_code = 'IRI-133'").first().value

    assert women(definitions()) == 10.0 and women(definitions(("IRI-133",))) == 4.0
    assert len({d.code for d in definitions()}) == 31


def test_whole_indicator_job(spark):
    df = markets(
        spark,
        market(1, date(2023, 1, 1), None, STMB5=fixed.STATE_PROVISIONAL),
        market(2, date(2024, 1, 1), None, STMB5=fixed.STATE_PROVISIONAL),
    )
    history = spark.createDataFrame(
        [("IRI-8", "2021-01-01", 2, "Mali", "old", 5.0)],
        "indicator_code string, date string, level int, country string, project string, value double",
    )
    metadata = spark.createDataFrame(
        [("IRI-8", "IRI-8", "Marchés", "count", None)], "code string, code_v2 string, designation_v2 string, unite_v2 string, note string"
    )
    official = spark.createDataFrame(
        [("IRI-8", "Marchés", "count", 2025, "2025-01-01", "new", 2, "Mali", 9.0, False)],
        "indicator_code string, indicator_name string, unit string, year int, date string, project string, level int, country string, value double, indicator_changed boolean",
    )
    out = indicator_table({"marches_a_betail": df}, history, metadata, official, Projects("old", "new"))
    got = {(r.level, r.year): (r.value, r.cumulative_value, r.cumulative_value_new) for r in out.collect()}
    assert got[(2, 2021)] == (5.0, 5.0, None) and got[(2, 2023)] == (1.0, 6.0, 1.0) and got[(2, 2024)] == (1.0, 7.0, 2.0)
    assert got[(2, 2022)] == (None, 5.0, 0.0)
    assert got[(2, 2025)] == (9.0, 9.0, 9.0)
    assert got[(3, 2024)] == (1.0, 2.0, 2.0) and got[(1, 2024)] == (1.0, 7.0, 2.0)


def test_manifests(spark):
    text = json.dumps(
        [
            {"download_url": "http://x/1", "filename": "a/b/1.jpg"},
            {"download_url": "http://x/placeholder.png", "filename": "p.png"},
            {"download_url": None, "filename": "n.jpg"},
            {"download_url": "http://x/2", "filename": "2.jpg"},
        ]
    )
    df = spark.createDataFrame([(text,), (None,), ("[]",)], "_attachments string")
    present = spark.createDataFrame([("2.jpg",)], "file_name string")
    got = [tuple(r) for r in fetch_manifest({"s": df}, present).select("survey", "download_url", "file_name").collect()]
    assert got == [("s", "http://x/1", "1.jpg")]
    files = spark.createDataFrame([("/a/1.JPG",), ("/a/2.jpg",), ("/a/3.txt",), ("/a/jpg",)], "path string")
    assert [r.file_name for r in publish_manifest(files, present).collect()] == ["1.JPG"]
