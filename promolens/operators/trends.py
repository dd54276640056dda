"""Growth from one period to the next."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.functions import percent


def previous(measure: str, period: str) -> Column:
    """Value in the preceding row by ``period``.

    For frames with one row per calendar period only: the window is not partitioned.
    """
    return F.lag(measure).over(Window.orderBy(period))


def period_growth(df: DataFrame, period: str, changes: Mapping[str, str]) -> DataFrame:
    """Add the change of each measure against the preceding period in percent.

    ``changes`` maps a measure to the name of its change.
    """

    def change(measure: str) -> Column:
        before = previous(measure, period)
        return percent(F.col(measure) - before, before)

    return df.withColumns({name: change(measure) for measure, name in changes.items()})
