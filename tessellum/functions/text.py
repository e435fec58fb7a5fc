"""Text predicates that hold for every script, and folding of accents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as punctuation. The class holds the range from ! to the em dash, letters and digits included.
PUNCTUATION = r"[\.,;:!-—'\"“”‘’]"
# List markers by kind.
BULLETS = {
    "NUMERIC": r"^[0-9]+[\)\.°-]$",
    "LOWER": r"^[a-z][\)\.]$",
    "UPPER": r"^[A-Z][\)\.]$",
    "ROMAN": r"^[xivXIV]+[\)\.]$",
    "BULLET": r"^[•-]$",
}
FOLD_FROM, FOLD_TO = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def is_upper(t: Column) -> Column:
    return t.rlike(r"\p{Lu}") & ~t.rlike(r"\p{Ll}|\p{Lt}")


def is_title(t: Column) -> Column:
    """Upper-case letters only after what is no letter with case, lower-case ones only after letters with case; at least one."""
    return t.rlike(r"[\p{Lu}\p{Lt}]") & ~t.rlike(r"(?:^|[^\p{Lu}\p{Ll}\p{Lt}])\p{Ll}|[\p{Lu}\p{Ll}\p{Lt}][\p{Lu}\p{Lt}]")


def is_numeric(t: Column) -> Column:
    return t.rlike(r"^\p{N}+\z")


def is_alpha(t: Column) -> Column:
    return t.rlike(r"^\p{L}+\z")


def true_false(c: Column) -> Column:
    return F.when(c, "True").otherwise("False")


def fold(t: Column) -> Column:
    """Lower case without the accents of the western languages, ligatures spelled out."""
    out = F.translate(F.lower(t), FOLD_FROM, FOLD_TO)
    return F.replace(F.replace(out, F.lit("œ"), F.lit("oe")), F.lit("æ"), F.lit("ae"))
