import random

import pytest
from pyspark.sql import functions as F

from fieldmark.operators import ordered, resolve
from fieldmark.operators.resolve import number_sub_items
from fieldmark.plans.framework import (
    assign_codes,
    combined_targets,
    framework_tables,
    results_sheet_2025,
    results_table,
    target_order,
    targets_sheet_2026,
)
from fieldmark.sources import sinks

META = "code string, code_v2 string, designation string, designation_v2 string, unite_v2 string, note string"


def metadata(spark):
    return spark.createDataFrame(
        [
            ("IRI-10", "IRI-10", "Sous-projets innovants promus", "Sous-projets innovants", "count", None),
            ("IRI-2", "IRI-22", "Unités vétérinaires", "Unités", "count", "NOUVEAU CODE D'INDICATEUR"),
            ("IR-3", "IR-3", "Superficie", "Superficies", "surface", "Indicateur changé"),
        ],
        META,
    )


def grid(spark, cells, width):
    """Four title rows, then the given cells by column number."""
    rows = [(i, *["title"] * width) for i in range(4)]
    for i, line in enumerate(cells, start=4):
        rows.append((i, *[line.get(c) for c in range(1, width + 1)]))
    return spark.createDataFrame(rows, "row_idx long, " + ", ".join(f"column_{c} string" for c in range(1, width + 1)))


def sheet(spark):
    return grid(
        spark,
        [
            {1: "Code", 2: "Intitulé", 4: "Unité", 5: "Pays", 7: "Cible", 8: "Résultats 2025"},
            {1: "10", 2: "Sous-projet innovant promu", 4: "Nombre", 5: "BF", 7: "5", 8: "4"},
            {5: "MR", 7: "1,5", 8: "3"},
            {5: "MR restruc", 7: "7", 8: "6"},
            {5: "Total", 7: "9", 8: "9"},
            {2: "Dont femmes", 5: "BF", 7: "2", 8: "oui"},
            {2: "Dont jeunes", 5: "BF", 7: "2", 8: None},
            {2: "Dont jeunes", 5: "ML", 7: "2", 8: "1"},
            {1: "6", 2: "Unités vétérinaires", 4: "millions", 5: None, 7: "185", 8: "2"},
        ],
        8,
    )


def test_rows_of_2025(spark):
    got = {
        (r.indicator_name_original, r.country, r.value_type): (r.value, r.original_order)
        for r in results_sheet_2025(sheet(spark)).collect()
    }
    first = "Sous-projet innovant promu"
    assert got == {
        (first, "BF", "target"): (5.0, 1),
        (first, "BF", "result"): (4.0, 1),
        (first, "MR", "target"): (7.0, 1),  # the restructured line stands for both
        (first, "MR", "result"): (6.0, 1),
        ("Dont femmes", "BF", "target"): (2.0, 5),
        ("Dont femmes", "BF", "result"): (1.0, 5),
        ("Dont jeunes", "ML", "target"): (2.0, 6),
        ("Dont jeunes", "ML", "result"): (1.0, 6),
        # the country of a blank depends on the value, so the two may differ
        ("Unités vétérinaires", "MR", "target"): (185.0, 8),
        ("Unités vétérinaires", "NE", "result"): (2.0, 8),
    }


def test_codes_of_2025(spark):
    rows = assign_codes(results_sheet_2025(sheet(spark)), metadata(spark), True)
    got = {(r.original_order, r.value_type): (r.indicator_code, r.indicator_name, r.unit_ref) for r in rows.collect()}
    assert got[(1, "target")] == ("IRI-10", "Sous-projets innovants", "count")
    # sub-items: parent and number, no name, the unit of the row before
    assert got[(5, "result")] == ("IRI-101", None, "count") and got[(6, "target")] == ("IRI-102", None, "count")
    assert got[(8, "result")] == ("IRI-22", "Unités", "count")


def test_sub_items_hard_case(spark):
    names = ["P1", "dont a", "dont a", "dont b", "P2", "dont c", "P3", "dont a", "P1", "dont z"]
    refs = {"P1": "I-1", "P3": "I-3"}
    df = spark.createDataFrame([("s", i, n, refs.get(n)) for i, n in enumerate(names)], "s string, o long, clean string, code_ref string")
    got = [r.code_final for r in number_sub_items(df, ["s"], "o").orderBy("o").collect()]
    assert got == ["I-1", "I-11", "I-11", "I-12", None, "I-13", "I-3", "I-31", "I-1", "I-14"]


def plain_numbers(rows):
    """Codes of (sequence, position, name, reference) rows, one after the other."""
    out, last, previous, counts = {}, {}, {}, {}
    for s, i, clean, ref in rows:
        sub = clean.startswith("dont ")
        if not sub and ref is not None:
            last[s] = ref
        parent = last.get(s)
        if sub and s in previous and clean != previous[s]:
            counts[s, parent] = counts.get((s, parent), 0) + 1
        out[s, i] = ref if not sub else None if parent is None else f"{parent}{counts.get((s, parent), 0)}"
        previous[s] = clean
    return out


@pytest.mark.parametrize("width", [7, 50, 65536])
def test_sub_items_across_blocks(spark, monkeypatch, width):
    r, rows = random.Random(1), []
    for s in ("a", "b", None):
        for i in range(300):
            k = r.random()
            rows.append((s, i, "dont " + r.choice("xyz") if k < 0.6 else r.choice("MNO"), None if k < 0.6 or k > 0.95 else r.choice(["P1", "P2", "P3"])))
    df = spark.createDataFrame(rows, "s string, p long, clean string, code_ref string").repartition(3)
    monkeypatch.setattr(resolve, "blocks_of", lambda position: ordered.blocks_of(position, width))
    got = {(x.s, x.p): x.code_final for x in number_sub_items(df, ["s"], "p").collect()}
    assert got == plain_numbers(rows)


def test_results_are_scaled_by_unit(spark):
    rows = spark.createDataFrame(
        [("a", "Nombre (MILLIONS)", "BF", 2.0), ("b", "milliers", "REGIONAL", 2.0), ("c", "Pourcentage", "XX", 50.0), ("d", None, None, 1.0)],
        "indicator_code string, unit_original string, country string, value double",
    ).withColumns(
        {"value_type": F.lit("result"), "year": F.lit(2025), "unit_ref": F.lit("count"), "indicator_name": F.lit("n"), "indicator_changed": F.lit(False)}
    )
    got = {r.indicator_code: (r.value, r.country, r.level, r.date, r.project) for r in results_table(rows, "new").collect()}
    assert got["a"] == (2e6, "Burkina-Faso", 2, "2025-01-01", "new")
    assert got["b"] == (2000.0, "Régional", 1, "2025-01-01", "new")
    assert got["c"] == (0.5, "XX", 2, "2025-01-01", "new") and got["d"] == (1.0, None, 2, "2025-01-01", "new")


def test_targets_of_both_sheets(spark):
    later = grid(
        spark,
        [{1: "3", 2: "Superficies", 4: "hectares (milliers,   valeur cumulée) ", 5: "TD", 6: "1,5", 7: "oui", 8: "x", 9: None, 10: "1 234", 11: "-5"}],
        11,
    )
    rows = targets_sheet_2026(later)
    assert {r.year: r.value for r in rows.collect()} == {2021: 1.5, 2022: 1.0, 2023: None, 2024: None, 2026: 1.0, 2027: 5.0}
    results, targets = framework_tables(sheet(spark), later, metadata(spark), "new")
    assert results.count() == 5
    got = {(r.Code, r.Pays, r["année"]): r for r in targets.collect()}
    land = got[("IR-3", "TD", 2021)]
    assert (land.valeur, land.unite, land.Composante, land.indicator_type) == (1500.0, "Milliers d’ha (cumulé)", "ODP", "Nombre")
    assert got[("IRI-101", "BF", 2025)].Composante == "3"
    sinks.replace_table(targets.repartition(3), "targets_laid_out", order=target_order())
    codes = [r.Code for r in spark.table("targets_laid_out").collect()]
    assert codes == sorted(codes, reverse=True) and len(codes) == targets.count()


def test_several_sheets_do_not_mix(spark):
    one = sheet(spark)
    two = one.withColumn("sheet_id", F.lit(0)).unionByName(one.withColumn("sheet_id", F.lit(1)))
    coded = assign_codes(results_sheet_2025(two), metadata(spark), True)
    alone = assign_codes(results_sheet_2025(one), metadata(spark), True)
    assert coded.count() == 2 * alone.count()
    columns = [c for c in alone.columns if c != "sheet_id"]
    for i in (0, 1):
        part = coded.filter(F.col("sheet_id") == i).select(*columns)
        assert part.exceptAll(alone.select(*columns)).isEmpty()


@pytest.mark.parametrize("former", [True, False])
def test_names_without_metadata_get_null(spark, former):
    rows = targets_sheet_2026(grid(spark, [{1: "1", 2: "inconnu", 4: "u", 5: "TD", 6: "1"}], 11))
    got = assign_codes(rows, metadata(spark), former).collect()
    assert {r.indicator_code for r in got} == {None} and {r.indicator_changed for r in got} == {False}


def test_combined_targets_keep_unknown_units(spark):
    rows = spark.createDataFrame([("Z", "autre  unité", 1.0)], "indicator_code string, unit_original string, value double").withColumns(
        {"indicator_name": F.lit("n"), "country": F.lit("BF"), "year": F.lit(2026), "unit_ref": F.lit("x"), "value_type": F.lit("target"), "indicator_changed": F.lit(False)}
    )
    row = combined_targets(rows).first()
    assert (row.unite, row.indicator_type, row.Composante, row["cumulative values"]) == ("autre unité", "x", None, False)
