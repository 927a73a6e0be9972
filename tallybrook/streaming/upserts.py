"""A changelog from plain upserts on a stream."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.streaming.packed import by_bucket

ROW = "map<string,string>"


def _materialise(state: pd.DataFrame, rows: pd.DataFrame, _: int):
    """Of a bucket's keys the row each has now.  Every new row retracts the one before it
    and adds itself; no row at all (a deletion) only retracts.  A row that is not newer
    than what its key has is an old one delivered again."""
    pdf = pd.concat([state.assign(old=True), rows[["pk", "seq", "row"]].assign(old=False)], ignore_index=True)
    pdf = pdf.sort_values(["pk", "seq", "old"], ascending=[True, True, False], kind="stable")
    pdf = pdf.drop_duplicates(["pk", "seq"])
    known = pdf["seq"].where(pdf["old"]).groupby(pdf["pk"], dropna=False).transform("max")
    pdf = pdf[~(pdf["seq"] < known)]
    before = pdf.groupby("pk", dropna=False, sort=False)["row"].shift()
    new = ~pdf["old"].astype(bool)
    gone = pd.DataFrame({"seq": pdf["seq"], "is_add": False, "row": before})[new & before.notna()]
    came = pd.DataFrame({"seq": pdf["seq"], "is_add": True, "row": pdf["row"]})[new & pdf["row"].notna()]
    last = pdf.drop_duplicates("pk", keep="last")
    return last[["pk", "seq", "row"]], pd.concat([gone, came]), None


def changelog_stream(upserts: DataFrame, key: Column, row: Column, seq: str = "seq") -> DataFrame:
    """Signed rows ``(seq, is_add, row)`` of a stream of upserts that do not say what was
    before: ``row`` is a map of the new values, NULL for a deletion.

    State is the newest row per key, by buckets of keys, and the sequence number of a
    deleted one, so that an older record that comes again changes nothing.  Rows without a
    key are left out.
    """
    slim = upserts.select(key.alias("pk"), F.col(seq).cast("bigint").alias("seq"), F.to_json(row).alias("row"))
    signed = by_bucket(
        slim.filter("pk IS NOT NULL"), F.col("pk"), _materialise, "pk string, seq bigint, row string",
        "seq bigint, is_add boolean, row string", "None",
    )
    return signed.withColumn("row", F.from_json("row", ROW))
