"""Lenient text handling for raw flow lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Everything up to and including U+0020. Spark's plain trim strips spaces only.
BLANKS = "".join(map(chr, range(0x21)))


def strip_blanks(text: Column) -> Column:
    """Strip blanks and control characters from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def normalise(text: Column) -> Column:
    """Strip and upper-case, for case-insensitive keys."""
    return F.upper(strip_blanks(text))


def is_data_line(line: Column) -> Column:
    """Neither blank nor a header, wherever in the file it stands."""
    return ~line.rlike(r"^[\x00-\x20]*(?:timestamp|\z)")


def field_of_lines(lines: DataFrame, position: int, name: str) -> DataFrame:
    """The comma-separated field at `position` (from 0) of every usable line.

    Trailing empty fields do not count, and a line too short to have the field is
    dropped. Slicing one element and exploding it does the arity check and the
    extraction in a single evaluation of the split. The field itself is not stripped.
    """
    content = F.rtrim(F.rtrim("value", F.lit(BLANKS)), F.lit(","))
    # position + 2 pieces are enough: the wanted one is then never the unsplit rest
    fields = F.split(content, ",", position + 2)
    return lines.filter(is_data_line(F.col("value"))).select(
        F.explode(F.slice(fields, position + 1, 1)).alias(name)
    )
