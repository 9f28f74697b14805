"""Moving figures over calendar days: a day without a row is a zero in the sum and a day in the average.

A series is cut into stretches of days; each stretch also gets the rows of the days before it that its frames reach, so
the series of a hot key is several groups and each row is copied once at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STRETCH_DAYS = 128


def moving_sum(rows: DataFrame, key: str, day: str, value: str, days: int, name: str, stretch: int = STRETCH_DAYS) -> DataFrame:
    """The rows with the sum of ``value`` over the ``days`` calendar days that end with the row's own day.

    Rows without a day, and rows of one key and day, are all kept; the latter share one sum.  A frame may not be longer
    than a stretch.
    """
    if not 1 <= days <= stretch:
        raise ValueError("a frame has at least one day and fits a stretch")
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    placed = rows.withColumns({"_day": number, "_stretch": F.floor(number / stretch), "_halo": F.lit(False)})
    reached = F.col("_day") >= (F.col("_stretch") + 1) * stretch - (days - 1)
    halo = placed.where(reached).withColumns({"_stretch": F.col("_stretch") + 1, "_halo": F.lit(True)})
    frame = Window.partitionBy(key, "_stretch").orderBy("_day").rangeBetween(1 - days, Window.currentRow)
    summed = placed.unionByName(halo).withColumn(name, F.when(F.col("_day").isNotNull(), F.sum(value).over(frame)))
    return summed.where(~F.col("_halo")).drop("_day", "_stretch", "_halo")
