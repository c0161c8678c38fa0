"""From free-text indicator names, in sheet order, to codes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lookup import lookup
from ..functions.text import normalise_label
from .lookups import attach
from .ordered import blocks_of, forward_fill

# Fixed value: how a normalised name begins if it is a part of the item above it.
SUB_ITEM = "dont "


@dataclass(frozen=True)
class MetadataColumns:
    """Which metadata columns names are matched on, and what is read from there."""

    name: str
    code: str
    new_name: str = "designation_v2"
    new_code: str = "code_v2"
    unit: str = "unite_v2"
    note: str = "note"


def main_items(metadata: DataFrame, columns: MetadataColumns) -> DataFrame:
    """Metadata rows of main items, with the normalised name."""
    return (
        metadata.select(
            normalise_label(F.col(columns.name)).alias("clean"),
            F.col(columns.code).alias("code_ref"),
            F.col(columns.new_code).alias("code_ref_new"),
            F.col(columns.new_name).alias("name_ref_new"),
            F.col(columns.unit).alias("unit_ref"),
            F.col(columns.note).alias("note"),
        )
        .filter(~F.col("clean").startswith(SUB_ITEM))
    )


def match_names(names: DataFrame, items: DataFrame, name: str, overrides: dict[str, str]) -> DataFrame:
    """Names with the code of the item of the same normalised name.

    An override by the exact original name wins.  A name that several items
    share is repeated; one that none has gets null.
    """
    cleaned = names.withColumn("clean", normalise_label(F.col(name)))
    matched = attach(
        cleaned,
        items,
        {"clean": "clean"},
        {"code_ref": "code_ref", "code_ref_new": "code_ref_new", "note": "note"},
    )
    return matched.withColumn("code_ref", lookup(F.col(name), overrides, F.col("code_ref")))


_KEY, _BLOCK, _PARENT = "__key", "__block", "__parent"


def number_sub_items(
    names: DataFrame, sequence: list[str], position: str, ref: str = "code_ref", out: str = "code_final"
) -> DataFrame:
    """Sub-items get the code of the last coded main item and a running number.

    The number grows with each change of name among the sub-items of one parent
    within a sequence, so a repeated name keeps its number and a parent met
    again goes on counting.  There is no separator between code and number.

    Rows move once, to their block of the sequence, where the last reference, the
    last name and the changes so far are folded; the part of a block before its
    first reference has the parent that is carried in.  What blocks need of each
    other goes through one row for each block (last reference and name, first
    name) and one for each block and parent (changes), and comes back to the block.
    """
    clean, is_sub = F.col("clean"), F.col("clean").startswith(SUB_ITEM)
    rows = names.withColumns({_KEY: F.struct(*sequence), _BLOCK: blocks_of(F.col(position)).cast("long")})
    in_block = Window.partitionBy(_KEY, _BLOCK).orderBy(position, ref)
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns(
        {
            "__here": F.last(F.when(~is_sub, F.col(ref)), ignorenulls=True).over(so_far),
            "__previous": F.lag(F.struct("clean")).over(in_block),
        }
    )
    changed = F.coalesce(is_sub & (clean != F.col("__previous.clean")), F.lit(False)).cast("long")
    of_parent = Window.partitionBy(_KEY, _BLOCK, "__here").orderBy(position, ref).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__changes", F.sum(changed).over(of_parent))

    # one row for each block: what it hands on, and the sub-item it may begin with
    order = F.struct(position, ref)
    ends = rows.groupBy(_KEY, _BLOCK).agg(
        F.max_by(F.struct("clean"), order).alias("__name"),
        F.max_by("__here", F.when(F.col("__here").isNotNull(), order)).alias("__ref"),
        F.max(F.when(F.col("__previous").isNull() & is_sub, F.struct("clean"))).alias("__first"),
    )
    earlier = Window.partitionBy(_KEY).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        _KEY,
        _BLOCK,
        F.last("__ref", ignorenulls=True).over(earlier).alias("__carried"),
        F.coalesce(F.col("__first.clean") != F.last("__name", ignorenulls=True).over(earlier)["clean"], F.lit(False)).cast("long").alias("__step"),
    )

    # one row for each block and parent: its changes, and those of the parent before
    groups = rows.groupBy(_KEY, _BLOCK, "__here").agg(F.max("__changes").alias("__changes")).join(carried, [_KEY, _BLOCK])
    bare = F.col("__here").isNull()
    step = F.when(bare, F.col("__step")).otherwise(0)
    groups = groups.withColumns({_PARENT: F.coalesce("__here", "__carried"), "__step": step, "__changes": F.col("__changes") + step})
    before = Window.partitionBy(_KEY, _PARENT).orderBy(_BLOCK, F.col("__here").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("__step") + F.coalesce(F.sum("__changes").over(before), F.lit(0))
    # a block has at most as many parents as rows
    offsets = groups.withColumn("__offset", offset).groupBy(_KEY, _BLOCK).agg(
        F.map_from_entries(F.collect_list(F.when(~bare, F.struct("__here", "__offset")))).alias("__offsets"),
        F.max(F.when(bare, F.struct("__offset"))["__offset"]).alias("__bare_offset"),
        F.max(F.when(bare, F.col("__carried"))).alias("__carried"),
    )

    placed = rows.join(offsets, [_KEY, _BLOCK])
    parent = F.coalesce("__here", "__carried")
    number = F.col("__changes") + F.when(bare, F.col("__bare_offset")).otherwise(F.element_at("__offsets", F.col("__here")))
    part = F.concat(parent, number.cast("string"))
    return placed.withColumn(out, F.when(~is_sub, F.col(ref)).otherwise(part)).select(*[c for c in names.columns if c != out], out)


def resolve_codes(
    rows: DataFrame,
    metadata: DataFrame,
    columns: MetadataColumns,
    overrides: dict[str, str],
    recode_by_note: bool,
    new_code_note: str,
    changed_notes: tuple[str, ...],
) -> DataFrame:
    """Sheet rows with indicator code, name, unit and the changed flag.

    ``rows`` hold ``sheet_id``, ``row_idx`` and ``var_pos`` (their place in the
    sheet, read column by column) besides the original name, code and order.
    """
    key = ["sheet_id", "indicator_name_original", "indicator_code_original", "original_order"]
    items = main_items(metadata, columns)
    names = match_names(rows.select(*key).distinct(), items, "indicator_name_original", overrides)
    numbered = number_sub_items(names, ["sheet_id"], "original_order")
    resolved = attach(
        numbered,
        items,
        {"code_final": "code_ref"},
        {"indicator_name": "name_ref_new", "unit_found": "unit_ref"},
    )
    joined = attach(
        rows,
        resolved,
        {k: k for k in key},
        {
            "indicator_code": "code_final",
            "code_ref_new": "code_ref_new",
            "indicator_name": "indicator_name",
            "unit_ref": "unit_found",
            "note": "note",
        },
    )
    # a sub-item has no unit of its own: it takes that of the row before it
    filled = forward_fill(
        joined,
        ["sheet_id"],
        ["var_pos", "row_idx", "indicator_code"],
        ["unit_ref"],
        [F.col("var_pos"), blocks_of(F.col("row_idx"))],
    )
    note = F.col("note")
    if recode_by_note:
        recoded = F.when(note.rlike(f"(?iu){new_code_note}"), F.col("code_ref_new"))
        filled = filled.withColumns(
            {
                "indicator_code": recoded.otherwise(F.col("indicator_code")),
                "indicator_changed": F.coalesce(note.rlike("(?iu)" + "|".join(changed_notes)), F.lit(False)),
            }
        )
    else:
        filled = filled.withColumn("indicator_changed", F.lit(False))
    return filled.select(
        "sheet_id",
        "row_idx",
        "var_pos",
        "indicator_code",
        "indicator_name",
        "unit_original",
        "unit_ref",
        "country",
        "value",
        "value_type",
        "year",
        "original_order",
        "indicator_changed",
    )
