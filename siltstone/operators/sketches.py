"""Sketches as stored columns: made once for a day, merged by any later question.

A day's sketch has a bounded size, whatever the day holds, so trailing figures
read one row a day instead of all events again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_ENTRIES, QUANTILE_SIZE = 14, 400  # relative error about 0.8 %; rank error about 0.7 %


def daily_sketches(events: DataFrame, time: str, item: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row for each day (and ``by``): day, n, items (HLL of ``item``) and quantiles (KLL of ``value``).

    Partial sketches are made where the rows are, so an exchange moves one row a
    task, day and ``by``. Null items and values count in n only; rows without a
    time have no day.
    """
    day = F.to_date(time).alias("day")
    items = F.hll_sketch_agg(item, F.lit(LOG_ENTRIES)).alias("items")
    quantiles = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(QUANTILE_SIZE)).alias("quantiles")
    return events.where(F.col(time).isNotNull()).groupBy(day, *by).agg(F.count("*").alias("n"), items, quantiles)


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the rows that agree in ``by``, as of all they were made from."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("items").alias("items"), F.kll_merge_agg_double("quantiles").alias("quantiles"))


def trailing_days(sketches: DataFrame, days: int, by: Sequence[str] = ()) -> DataFrame:
    """For every day that has a sketch the merged sketches of it and the ``days`` - 1 days before it.

    Each sketch goes to the days it counts for; days without any rows of their
    own are left out.
    """
    own = sketches.select("day", *by)
    spread = sketches.withColumn("day", F.explode(F.sequence("day", F.date_add("day", days - 1))))
    return merged(spread.join(own, ["day", *by], "left_semi"), ["day", *by])


def estimates(sketches: DataFrame, *ranks: float) -> DataFrame:
    """The sketches' columns with distinct_items and, for each rank from 0 to 1, the value q<percent>."""
    at = [F.kll_sketch_get_quantile_double("quantiles", F.lit(float(r))).alias(f"q{round(100 * r)}") for r in ranks]
    return sketches.select("*", F.hll_sketch_estimate("items").alias("distinct_items"), *at).drop("items", "quantiles")
