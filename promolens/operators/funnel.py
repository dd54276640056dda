"""Stage counts and their share of the first stage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions import percent
from promolens.operators.rollup import one_row


def funnel(counts: list[DataFrame], first: str, shares: Mapping[str, str]) -> DataFrame:
    """One row: the ``first`` stage, then every stage of ``shares`` with its percentage.

    ``counts`` are one-row frames that hold the stage counts between them; ``shares`` maps each
    later stage to the name of its percentage column.
    """
    columns = [F.col(first)]
    for stage, name in shares.items():
        columns += [F.col(stage), percent(F.col(stage), F.col(first)).alias(name)]
    return one_row(*counts).select(*columns)
