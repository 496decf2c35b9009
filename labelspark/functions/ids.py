"""Column expressions on identifiers, numbers and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def to_int(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def shuffle_key(c: Column | str, seed: int) -> Column:
    """A seeded order every engine can compute."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(c).cast("string")))


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def valid_id(c: Column | str) -> Column:
    """True for an id that is not NULL, not NaN and not blank."""
    text = F.trim(_col(c).cast("string"))
    return F.coalesce(_col(c).isNotNull() & (F.lower(text) != "nan") & (text != ""), F.lit(False))


def id_string(c: Column | str) -> Column:
    """``10019211.0`` and ``10019211`` both become ``'10019211'``; anything else NULL."""
    number = to_double(c)
    return F.when(valid_id(c) & ~F.isnan(number), number.try_cast("bigint").cast("string"))


def predicted_class(pred0: Column | str, pred1: Column | str) -> Column:
    """Index of the larger of two scores; the first one wins a tie."""
    return F.when(_col(pred1) > _col(pred0), 1).otherwise(0)


def relu(c: Column | str) -> Column:
    return F.when(_col(c) > 0, _col(c)).otherwise(F.lit(0.0))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Quotient as double, NULL for a zero denominator."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
