"""Behaviour-log operators: new-visitor correction, start/page/display split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.functions.jsontext import carried_items, with_value


def is_entry(last_page: Column | str = "page.last_page_id") -> Column:
    """True where a page was opened from nowhere (NULL or empty last page)."""
    c = F.col(last_page) if isinstance(last_page, str) else last_page
    return F.length(F.coalesce(c, F.lit(""))) == 0


def correct_new_visitors(logs: DataFrame, order: tuple[str, ...] = ("ts", "seq")) -> DataFrame:
    """Per ``common.mid`` keep ``is_new="1"`` on the first such row only.

    Later "1" rows become "0"; rows with "0" neither read nor set anything.
    ``order`` must order a visitor's rows totally.

    Static frames: the first row per visitor is an aggregate with map-side
    combine, joined back on (mid, order...).  Those join keys are nearly unique,
    so a visitor with a third of all rows spreads over all tasks, and rows that
    are not marked new pass by without any shuffle.  Streams: keyed state.
    """
    if logs.isStreaming:
        from tallybrook.streaming.new_visitors import correct_new_visitors_stream

        return correct_new_visitors_stream(logs, order)
    marked = (F.col("common.is_new") == "1") & F.col("common.mid").isNotNull()
    marked = F.coalesce(marked, F.lit(False))
    rest = logs.filter(~marked)
    new = logs.filter(marked)
    first = (
        new.groupBy(F.col("common.mid").alias("_mid"))
        .agg(F.min(F.struct(*order)).alias("_first"))
        .select("_mid", *[F.col(f"_first.{c}").alias(f"_o_{c}") for c in order])
    )
    on = new["common.mid"] == first["_mid"]
    for c in order:
        on = on & new[c].eqNullSafe(first[f"_o_{c}"])
    fixed = new.join(first, on, "left").withColumn(
        "common",
        F.col("common").withField(
            "is_new", F.when(F.col("_mid").isNull(), F.lit("0")).otherwise(F.lit("1"))
        ),
    )
    return rest.unionByName(fixed.select(*logs.columns))


def full_record(raw: Column | str, was: Column, now: Column) -> Column:
    """The text of a whole log record with the corrected ``common.is_new``: ``was`` and
    ``now`` are the flag as it came and as it is.  Where they agree the text is the one
    that came; else that one value is replaced in it, all other bytes stay."""
    text = F.col(raw) if isinstance(raw, str) else raw
    changed = ~was.eqNullSafe(now)
    return F.when(changed, with_value(F.when(changed, text), ("common", "is_new"), '"0"')).otherwise(text)


def full_displays(raws: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON text ``value`` per display of a page, numbered by ``place``: the whole
    display object, byte for byte, and the page's id."""
    shown = carried_items(F.when(F.contains(F.col(raw), F.lit("displays")), F.col(raw)), "displays", ("page", "page_id"))
    return raws.select(*keep, F.posexplode(shown).alias("place", "value"))


def start_logs(logs: DataFrame) -> DataFrame:
    """Rows whose ``start`` part is non-empty."""
    return logs.filter(F.length(F.coalesce(F.col("start"), F.lit(""))) > 0)


def page_logs(logs: DataFrame) -> DataFrame:
    """All rows that are not start rows."""
    return logs.filter(F.length(F.coalesce(F.col("start"), F.lit(""))) == 0)


def display_logs(pages: DataFrame, carry: tuple[str | Column, ...] = ()) -> DataFrame:
    """One row per display of a page, with the page's id; ``carry`` adds more."""
    return pages.select(
        F.explode("displays").alias("d"), F.col("page.page_id").alias("page_id"), *carry
    ).select("d.*", "page_id", *[c for c in _names(pages, carry)])


def _names(df: DataFrame, carry: tuple[str | Column, ...]) -> list[str]:
    return df.select(*carry).columns if carry else []
