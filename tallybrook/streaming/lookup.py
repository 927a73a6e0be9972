"""A lookup that waits for a dimension row that is not there yet."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallybrook.streaming.packed import by_bucket
from tallybrook.streaming.payload import pack, unpack

SALTS = 16


def _wait(wait_ms: int):
    """Versions of dimension rows, and facts that have met none, of a bucket of keys."""
    names = ["k", "at", "payload", "is_dim"]

    def step(state: pd.DataFrame, rows: pd.DataFrame, now: int):
        pdf = pd.concat([state, rows[names].astype(state.dtypes)], ignore_index=True) if len(rows) else state
        pdf = pdf.sort_values("at", kind="stable")
        dims, facts = pdf[pdf["is_dim"]], pdf[~pdf["is_dim"]].reset_index(drop=True)
        dims = dims.drop_duplicates(["k", "at"], keep="last")
        # the version in force, else the first that comes in time
        side = dims[["k", "at", "payload"]].rename(columns={"payload": "found", "at": "dim_at"})
        args = {"left_on": "at", "right_on": "dim_at", "by": "k"}
        held = pd.merge_asof(facts, side, direction="backward", **args)
        soon = pd.merge_asof(facts, side, direction="forward", tolerance=wait_ms, **args)
        found = held["found"].where(held["found"].notna(), soon["found"])
        status = pd.Series("found", facts.index).where(held["found"].notna(), "late")
        status = status.where(found.notna(), "timeout")
        done = found.notna() | (facts["at"] + wait_ms < now)
        out = pd.DataFrame({"payload": facts["payload"], "found": found, "status": status})[done]
        # of versions before the watermark only the newest can be asked for
        old = dims[dims["at"] <= now]
        dims = pd.concat([old.drop_duplicates("k", keep="last"), dims[dims["at"] > now]])
        left = facts[~done]
        wake = int(left["at"].min()) + wait_ms + 1 if len(left) else None
        return pd.concat([dims, left])[names], out, wake

    return step


def lookup_waiting(facts: DataFrame, dim: DataFrame, key: str, time: str, dim_key: str, dim_time: str,
                   columns: list[str], wait_ms: int = 60_000, delay: str = "0 seconds", salts: int = SALTS) -> DataFrame:
    """Add a dimension's columns to a stream of facts, where the dimension is a stream of
    its rows' versions.

    A fact takes the version in force at its event time.  If there is none yet it waits:
    the first version that comes with an event time of at most ``wait_ms`` later releases
    it; once the watermark has passed that, it goes on without.  ``status`` tells which:
    found, late, timeout.  ``time`` and ``dim_time`` are timestamps; the watermark follows
    the facts alone, so a dimension row is never too late to be kept.

    A hot key's facts are spread over ``salts`` groups, each of which gets the dimension's
    rows.  State per group: waiting facts, and versions from the newest before the
    watermark on.  A fact without key or time does not wait: it has nothing to wait for.
    """
    shape = T.StructType([dim.schema[c] for c in columns])
    body = F.to_json(F.struct(*columns))
    timed = facts.withWatermark(time, delay)
    salt = F.pmod(F.xxhash64(*[F.to_json(F.struct(*facts.columns))]), F.lit(salts)).cast("int")
    left = timed.select(
        F.col(time).alias("_et"), F.col(key).cast("string").alias("k"), F.unix_millis(time).alias("at"),
        pack(facts).alias("payload"), F.lit(False).alias("is_dim"), salt.alias("salt"),
    )
    right = dim.select(
        F.lit(None).cast("timestamp").alias("_et"), F.col(dim_key).cast("string").alias("k"),
        F.unix_millis(dim_time).alias("at"), body.alias("payload"), F.lit(True).alias("is_dim"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
    )
    both = left.filter("k IS NOT NULL AND at IS NOT NULL").unionByName(right.filter("k IS NOT NULL AND at IS NOT NULL"))
    joined = by_bucket(
        both, F.concat_ws("/", "salt", "k"), _wait(wait_ms), "k string, at bigint, payload string, is_dim boolean",
        "payload string, found string, status string",
    )
    none = left.filter("k IS NULL OR at IS NULL").select("payload", F.lit(None).cast("string").alias("found"), F.lit("timeout").alias("status"))
    out = unpack(joined.unionByName(none), facts.schema, keep=("found", "status"))
    return out.withColumn("_d", F.from_json("found", shape)).select(*facts.columns, *[F.col(f"_d.{c}") for c in columns], "status")
