"""Text clean-up expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def replace_literal(col: Column, search: str, replacement: str = "") -> Column:
    return F.replace(col, F.lit(search), F.lit(replacement))


def replace_pattern(col: Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(col, pattern, replacement)


def parse_number(col: Column) -> Column:
    """The number inside money-like text (``$1,250.00``); null if there is none."""
    return F.regexp_replace(col, r"[^0-9.\-]", "").try_cast("double")


def pad_zip(col: Column, width: int = 5) -> Column:
    """Put back the leading zeros a numeric reader dropped from a postal code.

    Longer codes pass unchanged: ``lpad`` alone would cut them.
    """
    text = F.trim(col.cast("string"))
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def drop_prefix(col: Column, n: int) -> Column:
    """Everything after the first ``n`` characters."""
    return F.substring(col, n + 1, 2**31 - 1)


def prefix(col: Column, n: int) -> Column:
    return F.substring(col, 1, n)


def join_text(*parts: Column | str) -> Column:
    """Concatenate columns and literal strings; null if any column is null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def blank_to(col: Column, replacement: str = "N/A") -> Column:
    """Replace empty text; nulls stay null, as an empty string is a value of its own."""
    return F.when(col == "", F.lit(replacement)).otherwise(col)


def recode(col: Column, mapping: Mapping, default=None) -> Column:
    """Replace each listed value by its code; others become ``default``."""
    out = None
    for value, code in mapping.items():
        out = F.when(col == F.lit(value), F.lit(code)) if out is None else out.when(col == F.lit(value), F.lit(code))
    return out.otherwise(F.lit(default))


def keep_listed(col: Column, values: Sequence, other: str = "others") -> Column:
    """Listed values unchanged, everything else (null too) becomes ``other``."""
    return F.when(col.isin(list(values)), col).otherwise(F.lit(other))


def flag(col: Column, value) -> Column:
    """1 where the column equals ``value``, else 0 (null counts as 0)."""
    return F.coalesce((col == F.lit(value)).cast("int"), F.lit(0))


def band(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands ``(edges[i], edges[i+1]]``; values outside give null."""
    if len(edges) != len(labels) + 1:
        raise ValueError("a band needs one more edge than labels")
    out = F.when(col <= F.lit(edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        out = out.when(col <= F.lit(upper), F.lit(label))
    return out
