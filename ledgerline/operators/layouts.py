"""Date layouts of whole columns.

``03/04/2024`` alone doesn't tell whether it is in March or April; the other cells of its column do.  Per
key (a file type), column and separator the cells that fit each order of day and month are counted; counts
add up over tasks, files and loads.  The order that more cells fit is the column's; where both fit
equally many, the layout must be configured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.values import DAY_FIRST, MONTH_FIRST, date_family, fits_order


def layout_counts(cells: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(*keys, Family, Cells, MonthFirst, DayFirst): one aggregate, combined map-side."""
    return cells.select(*keys, date_family(column).alias("Family"), fits_order(column, MONTH_FIRST).alias("_m"),
                        fits_order(column, DAY_FIRST).alias("_d")) \
        .where(F.col("Family").isNotNull()).groupBy(*keys, "Family").agg(
        F.count(F.lit(1)).alias("Cells"), F.sum(F.col("_m").cast("bigint")).alias("MonthFirst"),
        F.sum(F.col("_d").cast("bigint")).alias("DayFirst"))


def merged(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of several loads as one."""
    return counts.groupBy(*keys, "Family").agg(*[F.sum(c).alias(c) for c in ("Cells", "MonthFirst", "DayFirst")])


def chosen_order() -> Column:
    """The order of a row of counts; NULL where it stays open."""
    return F.when(F.col("MonthFirst") > F.col("DayFirst"), MONTH_FIRST) \
        .when(F.col("DayFirst") > F.col("MonthFirst"), DAY_FIRST)


def layout_name(order: Column, family: Column) -> Column:
    """The layout as a pattern, as a datatype may name it."""
    first, second = F.when(order == MONTH_FIRST, "M").otherwise("d"), F.when(order == MONTH_FIRST, "d").otherwise("M")
    return F.when(order.isNotNull(), F.concat(first, family, second, family, F.lit("yyyy")))
