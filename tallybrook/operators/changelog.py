"""Changelog rows and their materialisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def to_changelog(changes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each change as signed rows ``(is_add, row)``: an update retracts the old
    row and adds the new one, an insert or read adds, a delete retracts."""
    old = F.struct(F.lit(False).alias("is_add"), F.col("before").alias("row"))
    new = F.struct(F.lit(True).alias("is_add"), F.col("after").alias("row"))
    signed = (
        F.when(F.col("type") == "update", F.array(old, new))
        .when(F.col("type") == "delete", F.array(old))
        .otherwise(F.array(new))
    )
    return changes.select(*keep, F.inline(signed))


def latest_state(changes: DataFrame, pk: str, seq: str = "seq") -> DataFrame:
    """The table a change feed describes: newest row per key, deleted keys gone.

    ``row_number() = 1`` is cut to one row per key before the shuffle, so a key
    that is changed over and over stays cheap.
    """
    key = F.coalesce(F.try_element_at("after", F.lit(pk)), F.try_element_at("before", F.lit(pk)))
    w = Window.partitionBy("_pk").orderBy(F.col(seq).desc())
    return (
        changes.withColumn("_pk", key)
        .withColumn("_rn", F.row_number().over(w))
        .filter((F.col("_rn") == 1) & ~F.col("type").eqNullSafe("delete"))
        .select(F.col("after").alias("row"), seq)
    )
