"""Division, rounding and money columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``numerator / denominator * scale`` as DOUBLE, NULL where the denominator is 0.

    Money is summed as DECIMAL before it gets here, so the only inexact step is the division.
    """
    divisor = F.nullif(denominator.cast("double"), F.lit(0.0))
    result = numerator.cast("double") / divisor
    return result if scale == 1.0 else result * F.lit(float(scale))


def round_to(value: Column, digits: int) -> Column:
    """Round half up on the decimal value.

    The detour over DECIMAL(24,6) takes binary noise off before the tie is decided: 0.145 held
    as 0.14499999999999999 still rounds to 0.15. Holds for absolute values below 1e18.
    """
    return F.round(value.cast("decimal(24,6)"), digits).cast("double")


def percent(numerator: Column, denominator: Column, digits: int = 1) -> Column:
    """Rounded share in percent, of counts or money; large counts cannot overflow."""
    return round_to(ratio(numerator.cast("decimal(30,2)") * 100, denominator), digits)


def money(value: Column) -> Column:
    """Money total with two exact decimals."""
    return value.cast("decimal(38,2)")
