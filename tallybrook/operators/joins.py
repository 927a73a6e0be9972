"""Interval joins, dimension joins and the checked broadcast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.functions.times import int_div


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000,
                       max_bytes: int = 8 << 20) -> DataFrame:
    """Hint a broadcast only after measuring that the side is small.

    The check reads at most ``max_rows + 1`` rows.  A larger side gets no hint
    and is left to the optimiser: statistics below the broadcast threshold, or
    a shuffle join whose hot partitions AQE splits.
    """
    if df.isStreaming:
        return df
    size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))
    rows, octets = df.limit(max_rows + 1).agg(F.count("*"), size).first()
    small = rows <= max_rows and (octets or 0) <= max_bytes
    return F.broadcast(df) if small else df


def _seconds(ms: int) -> Column:
    return F.expr(f"INTERVAL '{ms / 1000:.3f}' SECOND")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    lower_ms: int,
    upper_ms: int,
    lower_inclusive: bool = True,
    upper_inclusive: bool = True,
    project: Sequence[Column] | None = None,
    slice_ms: int | None = 0,
) -> DataFrame:
    """Inner equi-join where ``right_time`` lies in ``left_time + [lower, upper]``.

    Works on two static frames and on two streams with watermarks; from the
    time range and the watermarks Spark derives when join state can go.

    On static frames the key is extended by a time slice: each right row has
    one slice, each left row is copied to every slice its range touches, so a
    pair meets exactly once.  A key that is hot on both sides is thereby spread
    over tasks by time, and the pairs tested per key stay near the pairs kept.
    ``slice_ms=0`` takes four ranges (1.25 copies per left row on average);
    ``slice_ms=None`` turns slicing off, for a left side that has one row per
    key, where AQE's skew split of the right side is enough and free.

    ``project`` lists output columns with the prefixes ``l.`` and ``r.``.
    """
    if lower_ms > upper_ms:
        raise ValueError("lower bound above upper bound")
    streaming = left.isStreaming or right.isStreaming
    lt, rt = F.col(f"l.{left_time}"), F.col(f"r.{right_time}")
    lo, hi = lt + _seconds(lower_ms), lt + _seconds(upper_ms)
    cond = (rt >= lo if lower_inclusive else rt > lo) & (
        rt <= hi if upper_inclusive else rt < hi
    )
    for lk, rk in keys:
        cond = cond & (F.col(f"l.{lk}") == F.col(f"r.{rk}"))

    out = list(project) if project is not None else (
        [F.col(f"l.{c}") for c in left.columns] + [F.col(f"r.{c}") for c in right.columns]
    )
    if not streaming and slice_ms is not None:
        width = slice_ms or max(1, 4 * (upper_ms - lower_ms))
        at = F.unix_millis(F.col(left_time))
        left = left.withColumn(
            "_slice",
            F.explode(F.sequence(_slice(at + F.lit(lower_ms), width),
                                 _slice(at + F.lit(upper_ms), width))),
        )
        right = right.withColumn("_slice", _slice(F.unix_millis(F.col(right_time)), width))
        cond = cond & (F.col("l._slice") == F.col("r._slice"))
    return left.alias("l").join(right.alias("r"), cond, "inner").select(*out)


def _slice(ms: Column, width: int) -> Column:
    """Number of the time slice, rounding down also before 1970."""
    return int_div(ms - F.pmod(ms, F.lit(width)), width)


def dim_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    columns: Mapping[str, str | Column],
    dim_key: str = "ID",
    missing: str = "keep",
    also: Sequence[str] = (),
) -> DataFrame:
    """Add dimension columns to facts by key.

    ``columns`` maps an output name to a dimension column (or expression over
    the dimension).  An output name the fact already has is overwritten where
    the key was found.  ``missing="keep"`` leaves facts without a dimension row
    in place, ``"drop"`` takes them out.  ``also`` names columns of both sides that
    must agree as well, as the salt of a dimension that was copied for each.

    No broadcast is forced: the optimiser broadcasts a dimension whose size is
    under the threshold, AQE one that turns out to be, and else the facts are
    shuffled with hot keys split.  Keys are compared in the fact key's type.
    """
    if missing not in ("keep", "drop"):
        raise ValueError("missing must be 'keep' or 'drop'")
    key_type = fact.schema[fact_key].dataType
    side = dim.select(
        F.col(dim_key).try_cast(key_type).alias("_dk"),
        *[
            (F.col(src) if isinstance(src, str) else src).alias(f"_d_{out}")
            for out, src in columns.items()
        ],
        *[F.col(c).alias(f"_a_{c}") for c in also],
    ).filter(F.col("_dk").isNotNull())
    on = fact[fact_key] == side["_dk"]
    for c in also:
        on = on & (fact[c] == side[f"_a_{c}"])
    joined = fact.join(side, on, "left" if missing == "keep" else "inner")
    found = F.col("_dk").isNotNull()
    have = fact.columns
    picked = [
        F.when(found, F.col(f"_d_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in have
    ]
    picked += [F.col(f"_d_{c}").alias(c) for c in columns if c not in have]
    return joined.select(*picked)
