"""Fill-in-middle: a text is cut at two unit bounds, and its middle moves to the end.

Units are lines, each with its line feed.  ``regexp_count`` gives their number n, a hash of
the id two of the n + 1 bounds, a <= b.  A pattern is made for each row: a group of a units,
a group of b - a units, and the rest.  Counted possessive quantifiers take the units
without backtracking and without recursion, however many there are.  One match of that
pattern captures prefix, middle and suffix, and the replacement that refers to the groups
is the output.

Outputs lead back to the text: the markers stand in no text that is cut, and no marker can
come about across the joint of a marker and a part, so each is found where it was put.

Null texts count as empty.  Texts that are empty or hold a marker stay plain.  A null id
counts as an empty string in the hash.  Rows that repeat an id and text are all returned and
alike; other columns travel in ``row`` and cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One line with its line feed, or the last one without.
LINE = r"(?:[^\n]*+\n|[^\n]++)"


@dataclass(frozen=True)
class Markers:
    """What stands before the three parts.  None may begin with what another ends with."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def each(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def _replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def _fourth(digest: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits, from 1, as a number."""
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 7,
    percent: int = 100,
    spm_percent: int = 50,
    markers: Markers = Markers(),
    unit: str = LINE,
) -> DataFrame:
    """Each row (as ``row``) with n, form, prefix, middle, suffix and output.

    ``form`` is ``psm`` or ``spm`` by the order of the parts, or ``plain``; plain rows keep
    their text as output and have null parts.  ``percent`` of the others are cut, of those
    ``spm_percent`` as spm.  ``unit`` is a pattern that matches one unit, never the
    empty string, and whose matches from left to right cover the text.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"row.`{id_col}`").cast("string"), F.lit(""))).cast("binary"), 256)
    marked = F.lit(False)
    for marker in markers.each:
        marked = marked | F.contains("whole", F.lit(marker))
    counted = (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        .withColumn("whole", F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")))
        .withColumns({"digest": digest, "n": F.regexp_count("whole", F.lit(unit)).cast("long")})
        .withColumns({f"bound{k}": _fourth(F.col("digest"), k) % (F.col("n") + 1) for k in (1, 2)})
    )
    form = (
        F.when((F.col("whole") == "") | marked | (_fourth(F.col("digest"), 3) % 100 >= percent), "plain")
        .when(_fourth(F.col("digest"), 4) % 100 < spm_percent, "spm")
        .otherwise("psm")
    )
    a, b = F.least("bound1", "bound2"), F.greatest("bound1", "bound2")
    pattern = F.format_string(r"(?s)\A(%s{%d}+)(%s{%d}+)(.*+)\z", F.lit(unit), a, F.lit(unit), b - a)
    p, s, m = (_replacement(x) for x in markers.each)
    order = F.when(F.col("form") == "psm", f"{p}$1{s}$3{m}$2").otherwise(f"{s}$3{p}$1{m}$2")
    cut = counted.withColumns({"form": form, "pattern": pattern}).withColumn(
        "output", F.when(F.col("form") == "plain", F.col("whole")).otherwise(F.regexp_replace(F.col("whole"), F.col("pattern"), order))
    )
    return with_parts(cut, markers).select("row", "n", "form", "prefix", "middle", "suffix", "output")


def with_parts(rows: DataFrame, markers: Markers = Markers()) -> DataFrame:
    """Adds the three parts, read back from ``output`` and ``form``; null for plain rows."""
    between = "|".join(_quoted(x) for x in markers.each)
    pieces = F.when(F.col("form") != "plain", F.split("output", between, -1))
    psm = F.col("form") == "psm"
    placed = rows.withColumn("pieces", pieces)
    parts = {
        "prefix": F.when(psm, F.col("pieces")[1]).otherwise(F.col("pieces")[2]),
        "middle": F.col("pieces")[3],
        "suffix": F.when(psm, F.col("pieces")[2]).otherwise(F.col("pieces")[1]),
    }
    return placed.withColumns(parts).drop("pieces")


def restored(rows: DataFrame, markers: Markers = Markers(), out: str = "restored") -> DataFrame:
    """Adds the text that ``output`` and ``form`` came from."""
    parted = with_parts(rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("all"), "output", "form"), markers)
    text = F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat("prefix", "middle", "suffix"))
    return parted.withColumn(out, text).select("all.*", out)
