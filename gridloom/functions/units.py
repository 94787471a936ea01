"""Exactly invertible unit decoding and encoding; text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.spec import NODATA


def decode(raw: Column, divisor: Column | int) -> Column:
    """float(raw) / float(divisor) in single precision, nodata as NaN."""
    by = (F.lit(divisor) if isinstance(divisor, int) else divisor).cast("float")
    return F.when(raw == NODATA, F.lit(float("nan")).cast("float")).otherwise((raw.cast("float") / by).cast("float"))


def encode(value: Column, divisor: Column | int) -> Column:
    """The stored integer again: half-even rounding in double precision, NaN as nodata."""
    by = F.lit(divisor) if isinstance(divisor, int) else divisor
    whole = F.rint(value.cast("double") * by)
    return F.when(F.isnan(value), F.lit(NODATA)).otherwise(whole).cast("smallint")


def is_fill(value: Column) -> Column:
    """Whether a number is NaN; false for null."""
    return F.coalesce(F.isnan(value), F.lit(False))


def valued(value: Column) -> Column:
    """NaN as null, as aggregates need it."""
    return F.when(~F.isnan(value), value)


def normalise_transformation(text: Column) -> Column:
    """Stripped text; null, blank and any spelling of none become ``none``."""
    bare = F.trim(text)
    return F.when(bare.isNull() | (bare == "") | (F.lower(bare) == "none"), F.lit("none")).otherwise(bare)


def hms(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(whole / 3600), F.floor(whole / 60) % 60, whole % 60)
