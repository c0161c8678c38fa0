import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fieldmark.operators.fingerprint import added_up, fingerprint, part_fingerprints
from fieldmark.operators.reshape import pivot_years
from fieldmark.plans import fixed_values as fixed
from fieldmark.plans.report import layout, spine, target_vs_result, wide_report
from fieldmark.schema import FACT, null_empty_structs, union_aligned
from fieldmark.session import settle
from fieldmark.sources import readers, sinks


def report_inputs(spark, extra_value=()):
    targets = spark.createDataFrame(
        [
            ("IR-1", "BF", 2022, 50.0, "Pourcentage"), ("IR-2", "ML", 2023, 4e6, "Nombre (millions)"),
            ("IR-3", "NE", 2022, 0.0, "Milliers d’ha"), ("IRI-2", "BF", 2024, 3.0, "Nombre"), ("Reg Int 1", "REGIONAL", 2022, 2.0, "Nombre"),
        ],
        "Code string, Pays string, `année` int, valeur double, unite string",
    ).withColumn("line", F.monotonically_increasing_id())
    values = spark.createDataFrame(
        [
            ("IR-1", "Burkina-Faso", 2022, 2, 0.25, float("nan")), ("IR-2", "Mali", 2023, 2, 1e6, 3e6), ("IR-3", "Niger", 2022, 2, 5000.0, None),
            ("IRI-2", "Burkina-Faso", 2024, 2, 9.0, 1.0), ("IRI-2", "Burkina-Faso", 2023, 3, 9.0, 1.0),
            ("Reg Int 1", "Régional", 2022, 1, 1.0, 9.0), *extra_value,
        ],
        "indicator_code string, country string, year int, level int, value double, cumulative_value_new double",
    )
    meta = spark.createDataFrame([("IR-1", "Taux"), ("zz", "x"), ("zz", "y")], "code string, designation string")
    return targets, values, meta


def test_report(spark):
    long = target_vs_result(*report_inputs(spark), "new")
    got = {(r.indicator_code, r.country, r.year): (r.target, r.value, r.ratio, r.label) for r in long.collect()}
    assert got[("IR-1", "Burkina-Faso", 2022)] == (50.0, 25.0, 0.5, "Taux")
    assert got[("IR-2", "Mali", 2023)] == (4.0, 3.0, 0.75, None)
    assert got[("IR-3", "Niger", 2022)] == (0.0, 5.0, None, None)
    assert got[("IRI-2", "Burkina-Faso", 2024)] == (3.0, 1.0, 0.333, None)
    assert got[("IRI-2", "Burkina-Faso", 2023)][1] is None  # a region's row is not read
    assert got[("Reg Int 1", "Régional", 2022)] == (2.0, 1.0, 0.5, None)
    regional = sum(code.startswith("Reg") for _, _, parts in fixed.REPORT_LAYOUT for _, codes in parts for code in codes)
    assert len(got) == ((layout(spark).count() - regional) * 7 + regional) * 6 == spine(layout(spark)).count()
    wide = wide_report(long)
    assert wide.count() * 6 == len(got) and wide.columns[-3:] == ["2027_target", "2027_value", "2027_ratio"]


def test_report_refuses_a_place_found_twice(spark):
    twice = [("IR-1", "Burkina-Faso", 2022, 2, 0.5, None)]
    with pytest.raises(Exception, match="more than one row"):
        target_vs_result(*report_inputs(spark, twice), "new").collect()


def test_fingerprint(spark):
    one = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "x int, y string")
    other = spark.createDataFrame([(None, 2), ("a", 1), (None, 2)], "y string, x int")
    assert fingerprint(one).first() == fingerprint(other).first()
    assert fingerprint(one).first() != fingerprint(one.distinct()).first()
    assert fingerprint(one.filter("false")).first().n_rows == 0


def test_fingerprint_tells_nulls_names_and_types_apart(spark):
    def of(rows, schema):
        r = fingerprint(spark.createDataFrame(rows, schema)).first()
        return r.content, r.columns

    told = [
        of([(1.0, None)], "numerator double, denominator double"), of([(None, 1.0)], "numerator double, denominator double"),
        of([(1, 2)], "a int, b int"), of([(1, 2)], "aa int, bb int"), of([(1, 2)], "a long, b int"), of([("1", 2)], "a string, b int"),
        of([], "a int"), of([], "b int"), of([(["x", None],)], "a array<string>"), of([(["x"],)], "a array<string>"), of([(None,)], "a array<string>"),
        of([("-", "x")], "a string, b string"), of([(None, "x")], "a string, b string"), of([("1:x;b", "")], "a string, b string"),
    ]
    assert len(set(told)) == len(told)


def test_unit_is_that_of_the_first_line(spark):
    targets, *rest = report_inputs(spark)
    own = [("IRI-2", "ML", 2026, 3.0, "Pourcentage", -2), ("IRI-2", "NE", 2026, 3.0, "Nombre", -1)]
    more = targets.union(spark.createDataFrame(own, targets.schema))
    units = {r.unit for r in target_vs_result(more, *rest, "new").collect() if r.indicator_code == "IRI-2"}
    assert units == {"Pourcentage"}


def test_a_year_that_is_not_listed_ends_the_job(spark):
    df = spark.createDataFrame([("a", 2020, 1), ("a", 2021, 2)], "k string, year int, n int")
    assert pivot_years(df, ["k"], "year", [2020, 2021], ["n"]).first().asDict() == {"k": "a", "2020_n": 1, "2021_n": 2}
    with pytest.raises(Exception, match="another year: 2021"):
        pivot_years(df, ["k"], "year", [2020], ["n"]).collect()


def test_versions_without_a_mark_do_not_count(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    one = sinks.publish_if_changed(df, str(tmp_path))
    df.write.parquet(f"{tmp_path}/version=99999999_crashed")
    two = sinks.publish_if_changed(df.union(df), str(tmp_path))
    assert one and two and one < two and sinks.publish_if_changed(df.union(df), str(tmp_path)) is None


def test_publish_only_if_changed(spark, tmp_path):
    folder = str(tmp_path / "t")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert sinks.publish_if_changed(df, folder, "v1") == "v1"
    assert sinks.publish_if_changed(df.orderBy("x", ascending=False), folder, "v2") is None
    assert sinks.publish_if_changed(df.filter("x = 1"), folder, "v3") == "v3"
    assert spark.read.parquet(f"{folder}/version=v3").count() == 1


def test_tables_and_mirror(spark):
    df = spark.createDataFrame([(1, "a")], "x int, `cumulative values` string")
    sinks.replace_tables(df, ["t_one", "t_two"])
    sinks.mirror_tables(spark, {"t_one": "t_old"})
    assert spark.table("t_old").first() == spark.table("t_two").first() == df.first()
    sinks.replace_table(df.filter("false"), "t_one")
    assert spark.table("t_one").count() == 0


def test_publish_survey(spark):
    sites = spark.createDataFrame([(1, "[14.0,-3.0]"), (2, None)], "id int, _geolocation string")
    sinks.publish_survey(sites, sites, "site_survey")
    assert spark.table("site_survey").first().geometry == "POINT (-3.0 14.0)"
    assert (spark.table("site_survey").count(), spark.table("site_survey_snapshots").count()) == (1, 2)


def test_country_surveys_keep_all_rows(spark):
    rows = spark.createDataFrame([(1, None), (2, None)], "id int, _geolocation string")
    sinks.publish_surveys({fixed.COUNTRY_SURVEY: (rows, rows), fixed.REGIONAL_SURVEY: (rows, rows)})
    assert [spark.table(s).count() for s in (fixed.COUNTRY_SURVEY, fixed.REGIONAL_SURVEY)] == [2, 2]


def test_csv_readers(spark, tmp_path):
    history = tmp_path / "history.csv"
    history.write_text("année,Code,Pays,valeur\n2020,IR-1,BF,50\n2021,IRI-2,REGIONAL,3\n2021,IRI-2,ZZ,\n", "utf-8")
    got = {(r.indicator_code, r.country): (r.date, r.level, r.value) for r in readers.history(spark, str(history), "old").collect()}
    assert got == {
        ("IR-1", "Burkina-Faso"): ("2020-01-01", 2, 0.5), ("IRI-2", "Régional"): ("2021-01-01", 1, 3.0), ("IRI-2", "ZZ"): ("2021-01-01", 2, None),
    }
    with pytest.raises(AnalysisException):
        readers.indicator_metadata(spark, str(tmp_path / "none.csv"))
    targets = tmp_path / "targets.csv"
    targets.write_text('Code,Pays,année,valeur,unite\nIR-1,BF,2024,"12",Nombre\nIR-1,BF,2025,n/a,Nombre\n', "utf-8")
    assert [(r["année"], r.valeur) for r in readers.report_targets(spark, str(targets)).collect()] == [(2024, 12.0), (2025, None)]


def test_cell_grid(spark, tmp_path):
    (tmp_path / "g.csv").write_text('0,title,\n1,"a, b",\n', "utf-8")
    got = readers.cell_grid(spark, str(tmp_path / "g.csv"), "csv").orderBy("row_idx").collect()
    assert [tuple(r) for r in got] == [(0, "title", None), (1, "a, b", None)] and got[0].column_1 == "title"


def test_submissions_and_form(spark, tmp_path):
    lines = [{"_id": 1, "_validation_status": {}, "_geolocation": [1.0, 2.0]}, {"_id": 2, "_validation_status": {}, "_geolocation": None}]
    (tmp_path / "s.json").write_text("\n".join(map(json.dumps, lines)), "utf-8")
    df = readers.submissions(spark, str(tmp_path / "s.json"))
    assert dict(df.dtypes)["_validation_status"] == "string"
    assert dict(df.dtypes)["_geolocation"] == "array<double>" and dict(df.dtypes)["_attachments"] == "string"
    df.write.parquet(str(tmp_path / "s.parquet"))
    typed = readers.submissions(spark, str(tmp_path / "s.json"), "_id long, _validation_status struct<>")
    assert dict(typed.dtypes)["_validation_status"] == "string"
    form = {"content": {"survey": [{"name": "q1", "type": "text", "label": ["Un", "One"]}, {"type": "end"}]}}
    (tmp_path / "f.json").write_text(json.dumps(form, indent=1), "utf-8")
    assert [tuple(r) for r in readers.form_fields(spark, str(tmp_path / "f.json")).collect()] == [(0, "q1", "text", "Un")]


def test_files_and_survey_tables(spark, tmp_path):
    for name in ("a.JPG", "b.png", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert sorted(r.file_name for r in readers.files(spark, str(tmp_path)).collect()) == ["a.JPG", "b.png"]
    spark.range(2).write.parquet(str(tmp_path / "points_d_eau.parquet"))
    found = readers.survey_tables(spark, str(tmp_path))
    assert list(found) == ["points_d_eau"] and found["points_d_eau"].count() == 2
    tagged = readers.official_results(spark, str(tmp_path / "points_d_eau.parquet"), "official")
    assert tagged.first().data_source == "official"


def test_settle_keeps_rows_and_types(spark):
    df = spark.sql("SELECT 1 AS `IR-2`, NULL AS nothing, named_struct('a', 1) AS s, array(1.5D) AS l, true AS `cumulative values`")
    stored = settle(df)
    assert stored.first() == df.first() and dict(stored.dtypes)["nothing"] == "string"


def test_union_aligned_and_empty_structs(spark):
    a = spark.sql("SELECT 'x' AS indicator_code, DATE '2024-01-01' AS date, true AS value, 2L AS level")
    b = spark.sql("SELECT 'y' AS indicator_code, '2023-01-01' AS date, 1.5D AS value, 'extra' AS other")
    got = {r.indicator_code: (r.date, r.value, r.level, r.region) for r in union_aligned([a, b], FACT).collect()}
    assert got == {"x": ("2024-01-01", 1.0, 2, None), "y": ("2023-01-01", 1.5, None, None)}
    assert null_empty_structs(a).columns == a.columns


def test_lines_are_numbered_over_pieces(spark, tmp_path):
    r = random.Random(3)
    records = [(str(i), r.choice(["x", 'say ""this""', "two\nlines", "a,b", "", "é\n\nü", 'odd "" one\nmore']), str(i % 7)) for i in range(3000)]
    text = "no,\"the,\nname\",last\n" + "".join(f'{a},"{b}",{c}\n' + ("\n" if i % 50 == 0 else "") for i, (a, b, c) in enumerate(records))
    (tmp_path / "f.csv").write_text(text, "utf-8")
    path = str(tmp_path / "f.csv")
    want = [tuple(r) for r in readers.csv_text(spark, path, line_breaks=True).collect()]  # one task
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        pieces = spark.read.text(path).rdd.getNumPartitions()
        lines = readers.numbered_lines(spark, path)
        got = sorted(lines.collect(), key=lambda x: x.line)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert pieces > 5 and [tuple(x)[:-1] for x in got] == want and len(want) == 3000
    assert lines.columns[:3] == ["no", "the,\nname", "last"] and len({x.line for x in got}) == 3000


def test_only_changed_parts_are_written(spark, tmp_path, rows):
    folder = str(tmp_path / "parts")
    data = [(y, i, f"t{i}") for y in (2001, 2002, 2003, None) for i in range(5)]
    df = spark.createDataFrame(data, "year int, i int, t string").repartition(3)
    files = lambda: {str(p) for p in (tmp_path / "parts").rglob("version=*/**/*.parquet")}
    assert sinks.publish_parts_if_changed(df, folder, ["year"], "v1") == "v1"
    first = files()
    assert len(first) == 4 and rows(sinks.published_parts(spark, folder, ["year"]), "year", "i", "t") == sorted(data, key=lambda t: [(v is not None, str(v)) for v in t])
    assert sinks.publish_parts_if_changed(df.repartition(2), folder, ["year"], "v2") is None and files() == first
    changed = [(y, i, "new" if (y, i) == (2002, 3) else t) for y, i, t in data]
    assert sinks.publish_parts_if_changed(spark.createDataFrame(changed, df.schema), folder, ["year"], "v3") == "v3"
    assert len(files() - first) == 1 and "year=2002" in next(iter(files() - first))
    got = sinks.published_parts(spark, folder, ["year"])
    assert sorted(map(tuple, got.select("year", "i", "t").collect()), key=str) == sorted(changed, key=str)
    # a part goes, another returns to what it was
    fewer = [t for t in data if t[0] != 2001]
    assert sinks.publish_parts_if_changed(spark.createDataFrame(fewer, df.schema), folder, ["year"], "v4") == "v4"
    assert sorted(map(tuple, sinks.published_parts(spark, folder, ["year"]).collect()), key=str) == sorted(map(tuple, spark.createDataFrame(fewer, df.schema).select(*sinks.published_parts(spark, folder, ["year"]).columns).collect()), key=str)
    assert sinks.published_parts(spark, folder, ["year"], "v1").count() == 20
    assert sinks.published_parts(spark, str(tmp_path / "none"), ["year"]) is None


def test_a_table_is_the_sum_of_its_parts(spark):
    df = spark.createDataFrame([(i % 3, i, None if i % 2 else "x") for i in range(50)], "p int, i int, t string")
    assert added_up(part_fingerprints(df, ["p"])).first() == fingerprint(df).first()
    empty = fingerprint(df.limit(0)).first()
    assert empty.n_rows == 0 and empty.columns == fingerprint(df).first().columns
