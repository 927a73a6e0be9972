"""Reports over the product table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallybrook.functions.times import day_number


def of_day(stats: DataFrame, day: int | None = None) -> DataFrame:
    """Rows of one day ``yyyyMMdd`` (default: today).

    A table partitioned by ``dt`` is pruned to the day's folder; without that
    column the window start decides.
    """
    if "dt" in stats.columns:
        want = F.current_date() if day is None else F.to_date(F.lit(str(day)), "yyyyMMdd")
        return stats.filter(F.col("dt") == want)
    want = day_number(F.current_timestamp()) if day is None else F.lit(day)
    return stats.filter(day_number("stt") == want)


def gmv(stats: DataFrame, day: int | None = None, measure: str = "order_amount") -> DataFrame:
    """Turnover of a day.  ``measure="sku_price"`` sums list prices instead."""
    return of_day(stats, day).agg(F.sum(measure).alias("gmv"))


def gmv_by_trademark(stats: DataFrame, day: int | None = None, limit: int = 5,
                     measure: str = "order_amount") -> DataFrame:
    """The day's top trademarks by turnover, best first, ties by name."""
    return (
        of_day(stats, day)
        .groupBy("tm_name")
        .agg(F.sum(measure).alias("order_amount"))
        .orderBy(F.col("order_amount").desc_nulls_last(), F.col("tm_name").asc_nulls_last())
        .limit(limit)
    )


def as_map(top: DataFrame, key: str = "tm_name", value: str = "order_amount") -> DataFrame:
    """The top rows as one MAP in rank order; ``top`` is a bounded report.  A map has no
    NULL key: what has no name goes under the empty one, together with what bears it."""
    named = top.groupBy(F.coalesce(F.col(key), F.lit("")).alias("k")).agg(F.sum(value).alias("v"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("v")).alias("r"), "k", "v")))
    pairs = F.transform(ranked, lambda e: F.struct(e["k"], e["v"]))
    return named.agg(F.map_from_entries(pairs).alias("amounts"))
