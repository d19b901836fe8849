"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space that separates words, and the regular expression of the gaps between words.
BLANKS = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"

NO_ID = -(2**63)


def col(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col(f"`{name.replace('`', '``')}`")


def content(text: str) -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(col(text).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text that is not NULL."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without columns of these names, which an operator is about to add."""
    gone = {n.lower() for n in names}
    if not gone & {c.lower() for c in df.columns}:
        return df
    return df.select(*[col(c) for c in df.columns if c.lower() not in gone])
