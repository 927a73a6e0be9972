"""Rows packed by groups of documents: how verdicts on places find their texts.

An operator that looks for repeats sends what it found as places (doc_id, number
among rows of that id, position), many packed into one value, to the group of
documents they belong to.  Texts travel to the same groups, packed alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallybrook.llm.common import give_back, pack, sliced, spread, unpack

NULL_ID = -(1 << 63)
RUN_BYTES = 4 << 20


def places(doc: np.ndarray, n: np.ndarray, at: np.ndarray) -> bytes:
    """Places packed small: in order they differ little from one to the next."""
    return pack(pa.table({"doc": np.diff(doc, prepend=0), "n": n.astype(np.int32), "at": np.diff(at, prepend=0).astype(np.int32)}))


def grouped(doc: np.ndarray, n: np.ndarray, at: np.ndarray, groups: int) -> tuple[list[int], list[bytes]]:
    """Places of removed windows, one packed value per group of documents."""
    g = spread(doc, groups)
    order = np.lexsort((at, n, doc, g))
    g, doc, n, at = g[order], doc[order], n[order], at[order]
    ends = np.append(np.flatnonzero(np.diff(g)) + 1, len(g)) if len(g) else []
    ids, blobs, start = [], [], 0
    for end in ends:
        ids.append(int(g[start]))
        blobs.append(places(doc[start:end], n[start:end], at[start:end]))
        start = end
    return ids, blobs


def keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    doc = batch.column("doc_id").cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
    return doc, batch.column("_n").to_numpy(zero_copy_only=False).astype(np.int64)


def text_rows(groups: int):
    """Whole rows packed by groups of documents."""

    def rows(batches):
        for batch in sliced(batches, "text", RUN_BYTES):
            g = spread(keys(batch)[0], groups)
            order = np.argsort(g, kind="stable")
            g = g[order]
            ends = np.append(np.flatnonzero(np.diff(g)) + 1, len(g))
            table = pa.Table.from_batches([batch]).take(pa.array(order))
            starts = np.concatenate([[0], ends[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(g[starts]),
                    pa.array([0] * len(starts), pa.int32()),
                    pa.array([pack(table.slice(s, e - s)) for s, e in zip(starts.tolist(), ends.tolist())], pa.binary()),
                ],
                names=["group", "kind", "value"],
            )

    return rows


def to_bucket(bucket: list, group: list, blobs: list) -> pa.RecordBatch:
    """Rows for a bucket; those with a group only pass through it."""
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(group, pa.int32()), pa.array(blobs, pa.binary())],
        names=["bucket", "to_group", "value"],
    )


def passing(rows: pa.Table) -> tuple[list[int], list[bytes], list[pa.Table]]:
    """Of a bucket's rows: groups and values that pass through, and the rest."""
    to, blobs = rows["to_group"], rows["value"]
    through = pc.is_valid(to)
    return (
        to.filter(through).to_pylist(),
        blobs.filter(through).to_pylist(),
        [unpack(b) for b in blobs.filter(pc.invert(through)).to_pylist()],
    )


def to_groups(groups: list[int], values: list[bytes]) -> pa.Table:
    return pa.table(
        {
            "group": pa.array(groups, pa.int32()),
            "kind": pa.array([1] * len(groups), pa.int32()),
            "value": pa.array(values, pa.binary()),
        }
    )


def texts_and_places(rows: pa.Table) -> tuple[pa.Table, dict[tuple[int, int], np.ndarray]]:
    """Of a group's rows: its documents, and the sorted positions found for each."""
    kind, blobs = rows["kind"].to_pylist(), rows["value"].to_pylist()
    # values of different runs may differ in how their strings are laid out
    give_back()
    texts = pa.concat_tables([unpack(b) for b, k in zip(blobs, kind) if k == 0], promote_options="permissive")
    found = [unpack(b) for b, k in zip(blobs, kind) if k == 1]
    at_of: dict[tuple[int, int], np.ndarray] = {}
    if found:
        doc = np.concatenate([np.cumsum(p["doc"].to_numpy()) for p in found])
        n = np.concatenate([p["n"].to_numpy() for p in found])
        at = np.concatenate([np.cumsum(p["at"].to_numpy()) for p in found])
        order = np.lexsort((at, n, doc))
        doc, n, at = doc[order], n[order], at[order]
        ends = np.append(np.flatnonzero((np.diff(doc) != 0) | (np.diff(n) != 0)) + 1, len(doc))
        start = 0
        for end in ends.tolist():
            at_of[int(doc[start]), int(n[start])] = at[start:end]
            start = end
    return texts, at_of
