"""UUID text: validation, canonical form and repeatable derivation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GROUPS = (8, 4, 4, 4, 12)
CANONICAL = r"\A" + "-".join(f"[0-9a-f]{{{n}}}" for n in GROUPS) + r"\z"
DIGITS = r"\A" + "".join(f"([0-9a-f]{{{n}}})" for n in GROUPS) + r"\z"


def canonical_uuid(text: Column) -> Column:
    """Lower-case hyphenated form of any accepted spelling, null for anything else.

    Accepted are upper case, missing or misplaced hyphens, surrounding braces and
    the ``urn:uuid:`` prefix, which is what Python's ``uuid.UUID`` reads.
    """
    bare = F.replace(F.replace(text, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    digits = F.lower(F.replace(F.btrim(bare, F.lit("{}")), F.lit("-"), F.lit("")))
    tidy = F.regexp_replace(digits, DIGITS, "$1-$2-$3-$4-$5")
    return F.when(text.rlike(CANONICAL), text).when(tidy.rlike(CANONICAL), tidy)


def derived_uuid(namespace: str, ident: Column) -> Column:
    """UUID text computed from an id: the same id always gives the same UUID."""
    hex32 = F.md5(F.concat(F.lit(f"{namespace}:"), ident.cast("string")))
    return F.regexp_replace(hex32, DIGITS, "$1-$2-$3-$4-$5")
