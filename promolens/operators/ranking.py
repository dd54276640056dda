"""Tiles and top lists over totally ordered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.functions import percent


#: Limits between ranges of values.
_LIMITS = 128


def _ranged(df: DataFrame, measure: str, key: str) -> DataFrame:
    """``df`` with ``_range``, the number of a row's range of values, larger measures first.

    The limits are the (measure, key) of the rows with the smallest hashes, a fixed number of them
    that depends on the rows alone. They are found when the query runs, as a subquery of one row.
    """
    drawn = df.select(F.col(measure).alias("m"), F.col(key).alias("k")).orderBy(F.xxhash64("m", "k"), "k").limit(_LIMITS)
    limits = drawn.agg(F.collect_list(F.struct("m", "k"))).scalar()
    m, k = F.col(measure), F.col(key)

    def comes_before(limit: Column) -> Column:
        larger = F.coalesce(limit["m"] > m, limit["m"].isNotNull() & m.isNull())
        return larger | (limit["m"].eqNullSafe(m) & (limit["k"] < k))

    before = F.size(F.filter("_limits", comes_before))
    return df.withColumn("_limits", limits).withColumn("_range", before).drop("_limits")


def distributed_ntile(df: DataFrame, measure: str, key: str, tiles: int, name: str) -> DataFrame:
    """``ntile(tiles)`` over all rows, largest ``measure`` first, without moving them into one task.

    Equal measures go by ``key``, which has to be unique; NULL measures come last. Rows are numbered
    within ranges of (measure, key), to which the rows of the ranges before are added. A row's
    place depends on values only, so a repeated task gives it the same number, and nothing is
    stored. Ranges of equal size on average split a measure that very many rows share as well.
    """
    ranged = _ranged(df, measure, key)
    in_range = Window.partitionBy("_range").orderBy(F.col(measure).desc_nulls_last(), F.col(key).asc())
    placed = ranged.withColumn("_place", F.row_number().over(in_range) - 1)
    by_range = Window.orderBy("_range")
    # The windows run over one row per range.
    starts = (
        ranged.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select(
            "_range",
            (F.sum("_rows").over(by_range) - F.col("_rows")).alias("_before"),
            F.sum("_rows").over(Window.partitionBy()).alias("_total"),
        )
    )
    row_number = "(_before + _place + 1)"
    small = f"(_total div {tiles})"
    larger_tiles = f"(_total % {tiles})"
    in_larger = f"({larger_tiles} * ({small} + 1))"
    # The first (total % tiles) tiles are one row larger than the rest.
    tile = F.expr(
        f"CASE WHEN {row_number} <= {in_larger} THEN ({row_number} + {small}) div ({small} + 1) "
        f"ELSE {larger_tiles} + ({row_number} - {in_larger} + {small} - 1) "
        f"div greatest({small}, 1) END"
    )
    return (
        placed.join(F.broadcast(starts), "_range")  # _LIMITS + 1 rows at most
        .withColumn(name, tile)
        .drop("_range", "_place", "_before", "_total")
    )


#: Ranges of a histogram for each doubling of the measure.
_RANGES = 4096


def _range_of(measure: Column) -> Column:
    """A whole number that never falls as the measure rises, with fewer than half a million values.

    It depends on the value alone. NULL comes first.
    """
    size = F.abs(measure).cast("double")
    code = (F.signum(measure.cast("double")) * F.floor(F.log2(size + 1) * _RANGES)).cast("long")
    return F.coalesce(code, F.lit(-(1 << 40)))


def ranked_values(df: DataFrame, measure: str) -> DataFrame:
    """Every value of ``measure`` with the places of its rows, largest first: (measure, rows, start, total).

    The rows have the places from ``start``, counted from 0, of ``total``. Only values are ordered,
    within ranges of values, and only one row of each range is brought together for the rows before it; no row of
    ``df`` is numbered, and ``df`` is read once. NULL comes last.
    """
    counted = df.groupBy(_range_of(F.col(measure)).alias("_range"), measure).agg(F.count("*").alias("rows"))
    in_range = Window.partitionBy("_range")
    ordered = in_range.orderBy(F.col(measure).desc_nulls_last())
    placed = counted.withColumns({"_running": F.sum("rows").over(ordered), "_held": F.sum("rows").over(in_range)})
    # The first value of each range stands for it; the window over these has a row for each range.
    first = F.col("_running") == F.col("rows")
    ranges = Window.partitionBy(F.when(first, F.lit(None)).otherwise(F.col("_range")))
    descending = ranges.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    with_ranges = placed.withColumns(
        {
            "_before": F.when(first, F.sum("_held").over(descending) - F.col("_held")),
            "_total": F.when(first, F.sum("_held").over(ranges)),
        }
    )
    return with_ranges.select(
        measure,
        "rows",
        (F.max("_before").over(in_range) + F.col("_running") - F.col("rows")).alias("start"),
        F.max("_total").over(in_range).alias("total"),
    )


def concentration(df: DataFrame, key: str, measure: str, tiles: int = 5) -> DataFrame:
    """Share of ``measure`` held by each of ``tiles`` equal groups, largest holders first.

    Which of the rows with one amount are on which side of a limit changes neither the members nor the sums, so
    the values with their numbers of rows are all that the limits are found in.
    """
    del key  # tells equal amounts apart, which no result depends on
    small, larger = f"(total div {tiles})", f"(total % {tiles})"
    in_larger = f"({larger} * ({small} + 1))"

    def tile_of(place: str) -> str:
        return (
            f"IF({place} < {in_larger}, {place} div ({small} + 1), "
            f"{larger} + ({place} - {in_larger}) div greatest({small}, 1))"
        )

    def begin_of(tile: str) -> str:
        return f"({tile} * {small} + least({tile}, {larger}))"

    # A value is in more than one tile only where a limit falls on it.
    split = ranked_values(df, measure).withColumn(
        "_tile", F.explode(F.expr(f"sequence({tile_of('start')}, {tile_of('(start + rows - 1)')})"))
    )
    part = F.expr(f"least(start + rows, {begin_of('(_tile + 1)')}) - greatest(start, {begin_of('_tile')})")
    kind = df.schema[measure].dataType.typeName()
    amount = F.col(measure) * (F.col("_part").cast("decimal(18,0)") if kind == "decimal" else F.col("_part"))
    per_tile = (
        split.withColumn("_part", part)
        .groupBy((F.col("_tile") + 1).alias("tile"))
        .agg(F.sum("_part").alias("members"), F.sum(amount).alias("total"))
    )
    # The windows run over one row per tile.
    platform = F.sum("total").over(Window.partitionBy())
    running = F.sum("total").over(Window.orderBy("tile"))
    return per_tile.withColumns(
        {
            "share_pct": percent(F.col("total"), platform),
            "cumulative_pct": percent(running, platform),
        }
    )


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows in ``order``; each task keeps only its own best ``k``."""
    return df.orderBy(*order).limit(k)


#: Rows whose parents are looked up to learn from which value on the others matter.
LEADERS = 1000


def contenders(df: DataFrame, k: int, measure: str, parents: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """The rows of ``df`` that can be among the first ``k`` by ``measure``, largest first, of those with all parents.

    ``parents`` are (column, frame of its known values). The first ``LEADERS`` rows are looked up first: the ``k``-th
    of those that are known is a value that no row below can beat, and so only rows from there on
    are joined. With fewer than ``k`` known ones among them all rows are. All columns of ``df`` take part in the first step, so
    both steps read the same shuffle.
    """
    best = F.col(measure).desc_nulls_last()
    leaders = known_rows(top_k(df, LEADERS, best, *(F.col(c).asc() for c in df.columns if c != measure)), parents)
    limit = top_k(leaders, k, best).agg(F.count("*").alias("rows"), F.min(F.struct(measure, *(c for c in df.columns if c != measure))).alias("last"))
    least = limit.select(F.when(F.col("rows") == k, F.col(f"last.{measure}")).alias("least")).scalar()
    return known_rows(df.where(least.isNull() | (F.col(measure) >= least)), parents)


def known_rows(df: DataFrame, parents: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """The rows whose columns all hold a value of their parent."""
    columns = df.columns
    for column, parent in parents:
        df = df.join(parent.select(column), column, "left_semi")
    return df.select(columns)


def top_k_ranked(df: DataFrame, k: int, measure: str, ties: Sequence[str], rank: str) -> DataFrame:
    """Top ``k`` by ``measure`` descending, with the dense rank of each row.

    The dense rank of the leading rows depends on those rows alone, so it is taken after the
    limit, over ``k`` rows.
    """
    best = F.col(measure).desc_nulls_last()
    leading = top_k(df, k, best, *(F.col(c).asc() for c in ties))
    return leading.withColumn(rank, F.dense_rank().over(Window.orderBy(best)).cast("long"))
