"""Previous/next row over an ordered series without putting a whole series into one group."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _shifted(df: DataFrame, keys: list[str], order: str, wanted: dict[str, str], step, back) -> DataFrame:
    """``wanted`` maps new column to source column; ``order`` must be unique within ``keys``.

    Rows are ranked within (keys, day). Only the first and last row of a day can need a neighbour in
    another day; those edge rows form a second, much smaller group per key (two rows per day), and
    every other row stands alone in it. The largest group is therefore one day of one key, however
    much data a key holds.
    """
    day = F.to_date(order)
    in_day = Window.partitionBy(*keys, day).orderBy(order)
    staged = df.withColumns(
        {
            "__has": step(order).over(in_day).isNotNull(),
            "__edge": back(order).over(in_day).isNull(),
            **{f"__in_{new}": step(src).over(in_day) for new, src in wanted.items()},
        }
    )
    group = F.when(F.col("__has") & ~F.col("__edge"), F.col(order))
    edges = Window.partitionBy(*keys, group).orderBy(order)
    return staged.withColumns(
        {
            new: F.when(F.col("__has"), F.col(f"__in_{new}")).otherwise(step(src).over(edges))
            for new, src in wanted.items()
        }
    ).drop("__has", "__edge", *[f"__in_{new}" for new in wanted])


def previous_row(df: DataFrame, keys: list[str], order: str, wanted: dict[str, str]) -> DataFrame:
    return _shifted(df, keys, order, wanted, F.lag, F.lead)


def next_row(df: DataFrame, keys: list[str], order: str, wanted: dict[str, str]) -> DataFrame:
    return _shifted(df, keys, order, wanted, F.lead, F.lag)
