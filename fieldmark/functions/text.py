"""Text cleaning.  ``(?U)`` throughout: word and space classes are Unicode ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accented letters that lose their accent, and their plain forms.
ACCENTED = "éèêëàâäîïôöùûüç"
PLAIN = "eeeeaaaiioouuuc"

# Words that keep their final s or x.
PROTECTED_WORDS = ("plus", "moins", "prix", "sous", "taux")

# Linking words that do not count in a label.
LINK_WORDS = ("de", "du", "des", "et", "le", "la", "les", "pour", "au", "ou")


def strip(text: Column) -> Column:
    """Without leading and trailing white space of any kind, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank."""
    return F.regexp_replace(text, r"(?U)\s+", " ")


def replace_first(text: Column, old: str, new: str) -> Column:
    """Replace the first occurrence of a literal, and only that one."""
    return F.regexp_replace(text, rf"(?s)^(.*?)\Q{old}\E", f"$1{new}")


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """A regex group, null where the pattern is not found."""
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found)


def january_first(year: Column) -> Column:
    """``2024`` as ``2024-01-01``; null stays null."""
    return F.concat(year.cast("string"), F.lit("-01-01"))


def year_of_text(date: Column) -> Column:
    return F.substring(date, 1, 4).cast("int")


def contains_any_case(text: Column, *words: str) -> Column:
    """One of the words occurs, in any case, accents included."""
    return text.rlike("(?iu)" + "|".join(words))


def normalise_label(label: Column) -> Column:
    """A label reduced to what two spellings of it have in common.

    Lower case, no accents, singular words (``aux`` to ``al``, else a final s
    and a final x go, protected words aside), no linking words, no punctuation,
    single blanks and none at the ends.  Patterns look at the end of a word and
    then back, so a text is read once per rule.
    """
    text = F.translate(F.lower(label), ACCENTED, PLAIN)
    kept = "|".join(PROTECTED_WORDS)
    text = F.regexp_replace(text, r"(?U)aux\b(?<!\btaux)", "al")
    text = F.regexp_replace(text, rf"(?U)(?:xs|[sx])(?!\w)(?<!\b(?:{kept}))", "")
    text = F.regexp_replace(text, rf"(?U)\b(?:{'|'.join(LINK_WORDS)})\b", " ")
    text = F.regexp_replace(text, r"(?U)[^\w\s]+", "")
    return F.trim(squeeze(text))


def _yes_no(text: Column, otherwise: Column) -> Column:
    lowered = F.lower(text)
    return F.when(lowered == "oui", F.lit("1")).when(lowered == "non", F.lit("0")).otherwise(otherwise)


def plain_number(text: Column) -> Column:
    """A cell that is a plain decimal number as a whole, or yes/no; anything else is null."""
    cell = _yes_no(text, text)
    numeric = cell.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    return F.when(numeric, cell.try_cast("double"))


def first_number(text: Column) -> Column:
    """The first run of digits in a cell, decimal comma allowed, or yes/no.

    Signs are not read and a thousands blank ends the number.
    """
    cell = replace_first(_yes_no(text, F.lower(text)), ",", ".")
    return extract(cell, r"(\p{Nd}+\.?\p{Nd}*)").try_cast("double")
