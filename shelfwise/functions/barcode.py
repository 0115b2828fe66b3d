"""Barcode normalisation: one function, five policies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digits(c: Column) -> Column:
    """Digits of a barcode text; a number in scientific notation is written out, '.0' dropped, placeholders are null."""
    t = F.trim(c.cast("string"))
    t = F.when(~F.lower(t).isin("", "nan", "none", "0", "0.0"), t)
    written = F.when(F.lower(t).contains("e"), F.coalesce(F.bround(t.try_cast("double"), 0).try_cast("decimal(38,0)").cast("string"), t)).otherwise(t)
    return F.regexp_replace(F.regexp_replace(written, r"\.0$", ""), r"\D", "")


def normalize_barcode(c: Column, mode: str = "digits") -> Column:
    """Null where nothing usable is left.

    digits     digits without leading zeros
    padded     digits with leading zeros, at least six
    compact    spaces and dashes dropped, upper case
    stripped   trimmed, leading zeros dropped
    plain      trimmed, a final '.0' dropped
    """
    if mode == "digits":
        return F.nullif(F.ltrim(_digits(c), F.lit("0")), F.lit(""))
    if mode == "padded":
        d = _digits(c)
        return F.when(F.char_length(d) >= 6, d)
    t = F.trim(c.cast("string"))
    if mode == "compact":
        out = F.upper(F.regexp_replace(t, r"[\s-]", ""))
    elif mode == "stripped":
        out = F.ltrim(t, F.lit("0"))
    elif mode == "plain":
        out = F.regexp_replace(t, r"\.0$", "")
    else:
        raise ValueError(f"unknown barcode mode: {mode}")
    return F.nullif(out, F.lit(""))
