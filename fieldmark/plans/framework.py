"""Results-framework sheets to results and targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lookup import member_of, relabel
from ..functions.numeric import floor_bucket
from ..functions.text import (
    contains_any_case,
    first_number,
    january_first,
    plain_number,
    replace_first,
    squeeze,
    strip,
)
from ..operators.dedup import keep_lone_or_marked
from ..operators.ordered import blocks_of, forward_fill
from ..operators.reshape import unpivot_ordered, year_in_name
from ..operators.resolve import MetadataColumns, resolve_codes
from ..session import settle
from . import fixed_values as fixed

# Fixed value: columns by which the table of targets is laid out.
TARGET_ORDER = ("Code", "Pays", "année")

# Fixed value: rows are ordered within blocks of this many.
ORDER_BLOCK = 100

_MERGED_CELLS = ["indicator_code_original", "indicator_name_original", "unit_original"]


def block_min_order(df: DataFrame, keys: list[str], position: str, out: str, width: int = ORDER_BLOCK) -> DataFrame:
    """The smallest position with the same keys in the same block of ``width`` positions.

    A window sees one block of one sheet, so at most ``width`` rows.
    """
    window = Window.partitionBy(*keys, floor_bucket(F.col(position), width))
    return df.withColumn(out, F.min(position).over(window))


def sheet_rows(grid: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows below the title, merged cells filled, with their order.

    ``grid`` is the sheet's cells as text with ``row_idx`` (from 0) and, for
    several sheets at once, ``sheet_id``.
    """
    sheet = F.col("sheet_id") if "sheet_id" in grid.columns else F.lit(0)
    rows = grid.filter(F.col("row_idx") >= fixed.TITLE_ROWS).select(
        sheet.alias("sheet_id"),
        (F.col("row_idx") - fixed.TITLE_ROWS).alias("row_idx"),
        *[F.col(cell).cast("string").alias(out) for out, cell in columns.items()],
    )
    filled = forward_fill(rows, ["sheet_id"], ["row_idx"], _MERGED_CELLS, [blocks_of(F.col("row_idx"))])
    keys = ["sheet_id", "indicator_name_original", "indicator_code_original"]
    return block_min_order(filled, keys, "row_idx", "original_order")


_IDS = [
    "sheet_id", "row_idx", "indicator_name_original", "unit_original", "country",
    "indicator_code_original", "original_order",
]


def _filled_country() -> Column:
    code, value = F.col("indicator_code_original"), F.col("value")
    out = F.when(F.col("country").isNotNull(), F.col("country"))
    for item, values, country in fixed.BLANK_COUNTRY_BY_VALUE:
        out = out.when((code == item) & value.isin(*[float(v) for v in values]), country)
    for item, country in fixed.BLANK_COUNTRY_BY_CODE.items():
        out = out.when(code == item, country)
    out = out.when(code.isin(*fixed.REGIONAL_CODES), fixed.BLANK_COUNTRY_REGIONAL)
    return out.otherwise(fixed.BLANK_COUNTRY_ELSE)


def results_sheet_2025(grid: DataFrame) -> DataFrame:
    """The 2025 sheet as long rows: one target and one result per line."""
    rows = sheet_rows(grid, fixed.SHEET_2025_COLUMNS)
    rows = rows.filter(
        F.col("result_value").isNotNull() & ~F.col("result_value").contains(fixed.RESULT_HEADER)
    )
    measures = ["target_value", "result_value"]
    rows = rows.withColumns({m: plain_number(F.col(m)) for m in measures})
    long = unpivot_ordered(rows, _IDS, measures, "value_type", "value", "var_pos").withColumns(
        {
            "value_type": F.when(F.col("value_type") == "target_value", "target").otherwise("result"),
            "year": F.lit(2025),
        }
    )
    long = long.withColumn("country", _filled_country())
    long = long.filter(~F.col("country").contains(fixed.TOTAL_LABEL))
    long = long.withColumn("clean_country", replace_first(F.col("country"), f" {fixed.RESTRUCTURED}", ""))
    kept = keep_lone_or_marked(
        long,
        ["sheet_id", "indicator_name_original", "indicator_code_original", "value_type", "clean_country"],
        F.col("country").contains(fixed.RESTRUCTURED),
    )
    return kept.withColumn("country", F.col("clean_country")).drop("clean_country")


def targets_sheet_2026(grid: DataFrame) -> DataFrame:
    """The 2026-27 sheet as long rows: one target per line and year."""
    rows = sheet_rows(grid, fixed.SHEET_2026_COLUMNS).filter(F.col("country").isNotNull())
    measures = [c for c in fixed.SHEET_2026_COLUMNS if c.startswith("target_value_")]
    rows = rows.withColumns({m: first_number(F.col(m)) for m in measures})
    long = unpivot_ordered(rows, _IDS, measures, "year", "value", "var_pos")
    return long.withColumns({"year": year_in_name(F.col("year")), "value_type": F.lit("target")})


def assign_codes(rows: DataFrame, metadata: DataFrame, sheet_of_2025: bool) -> DataFrame:
    """Long rows with indicator code, name, unit and the changed flag.

    The 2025 sheet is matched on the former names and codes, and then moved to
    the new code where the note says so; the later sheet on the new ones.
    """
    columns = (
        MetadataColumns("designation", "code") if sheet_of_2025 else MetadataColumns("designation_v2", "code_v2")
    )
    return resolve_codes(
        settle(rows),
        metadata,
        columns,
        fixed.CODE_OF_NAME,
        recode_by_note=sheet_of_2025,
        new_code_note=fixed.NOTE_NEW_CODE,
        changed_notes=fixed.NOTES_CHANGED,
    )


def scaled_result(value: Column, unit: Column) -> Column:
    """A result in its base unit, from millions, thousands or percent."""
    return (
        F.when(contains_any_case(unit, "million"), value * 1_000_000)
        .when(contains_any_case(unit, "millier"), value * 1_000)
        .when(contains_any_case(unit, "pourcent"), value / 100)
        .otherwise(value)
    )


def results_table(rows: DataFrame, project: str) -> DataFrame:
    """Official results in the form the indicator table takes."""
    country = relabel(F.col("country"), fixed.COUNTRY_OF_SHEET_CODE)
    return (
        rows.filter(F.col("value_type") == "result")
        .withColumn("country", country)
        .select(
            "indicator_code",
            "indicator_name",
            F.col("unit_ref").alias("unit"),
            "year",
            january_first(F.col("year")).alias("date"),
            F.lit(project).alias("project"),
            F.when(F.col("country").contains(fixed.TOP_PLACE), 1).otherwise(2).alias("level"),
            "country",
            scaled_result(F.col("value"), F.col("unit_original")).alias("value"),
            "indicator_changed",
        )
    )


def combined_targets(*sheets: DataFrame) -> DataFrame:
    """Targets of all sheets, with component, cleaned unit and indicator type, in no order: the writer takes ``target_order()``."""
    targets = sheets[0].filter(F.col("value_type") == "target")
    for sheet in sheets[1:]:
        targets = targets.unionByName(sheet.filter(F.col("value_type") == "target"))
    unit = relabel(strip(squeeze(F.col("unit_original"))), fixed.UNIT_LABELS)
    thousands = contains_any_case(F.col("unite"), "millier")
    return targets.withColumn("unite", unit).select(
        F.col("indicator_code").alias("Code"),
        F.col("indicator_name").alias("Indicateur_Name"),
        F.col("country").alias("Pays"),
        member_of(F.col("indicator_code"), fixed.COMPONENT_CODES).alias("Composante"),
        F.col("year").alias("année"),
        F.when(thousands, F.col("value") * 1_000).otherwise(F.col("value")).alias("valeur"),
        "unite",
        relabel(F.col("unit_ref"), fixed.INDICATOR_TYPES).alias("indicator_type"),
        F.lit(False).alias("cumulative values"),
        "indicator_changed",
    )


def target_order() -> list[Column]:
    """For the writer: each column falling, nulls first."""
    return [F.desc_nulls_first(c) for c in TARGET_ORDER]


def framework_tables(
    grid_2025: DataFrame, grid_2026: DataFrame, metadata: DataFrame, project: str
) -> tuple[DataFrame, DataFrame]:
    """Official results of 2025, and the targets of both sheets."""
    rows_2025 = settle(assign_codes(results_sheet_2025(grid_2025), metadata, sheet_of_2025=True))
    rows_2026 = assign_codes(targets_sheet_2026(grid_2026), metadata, sheet_of_2025=False)
    return results_table(rows_2025, project), combined_targets(rows_2025, rows_2026)
