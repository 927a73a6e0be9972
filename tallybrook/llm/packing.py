"""Cost-balanced packing of documents into sequences of bounded length.

The cost of a sequence is estimated as ``linear`` times its tokens plus
``quadratic`` times the sum of its pieces' squared lengths (attention stays
within a piece).  A document longer than a sequence gives whole sequences and a
rest.  Rests go by descending length to the cheapest open sequence that has
room; one that fits nowhere is cut at the largest gap.  Packing works on runs
of rows where they lie: nothing is shuffled, no key can be hot, and each run
leaves at most one sequence that is not full.  With ``tail`` that one is cut
into lengths that are powers of two, which need no padding.

A NULL or empty text is its end id alone.  Repeated rows are separate
documents.  Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallybrook.llm.common import sliced
from tallybrook.llm.tokens import encoder

SCHEMA = "start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
RUN_BYTES = 6 << 20


def assign(lengths: np.ndarray, size: int, linear: float = 1.0, quadratic: float = 1 / 1024, tail: bool = True) -> np.ndarray:
    """Rows of (document, start, length, sequence, offset) for documents of the
    given lengths; sequences are numbered from 0."""
    whole, rest = lengths // size, lengths % size
    doc = np.repeat(np.arange(len(lengths)), whole)
    first = np.concatenate([[0], np.cumsum(whole)])[:-1]
    n = np.arange(len(doc))
    pieces = [np.stack([doc, (n - np.repeat(first, whole)) * size, np.full(len(doc), size), n, np.zeros(len(doc), np.int64)], 1)]
    count, left = int(rest.sum()) // size, int(rest.sum()) % size
    # open sequences: full ones, and what is left over
    caps = [size] * count
    if tail:
        caps += [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
    elif left:
        caps.append(left)
    room = np.array(caps, np.int64)
    # shorter sequences start as if filled up to the full length
    cost = linear * (size - room) + quadratic * (size - room) ** 2.0
    used = np.zeros(len(room), np.int64)
    out = []
    for d in np.argsort(-rest, kind="stable").tolist():
        todo, start = int(rest[d]), int(whole[d]) * size
        while todo:
            s = int(np.argmin(np.where(room >= todo, cost, np.inf)))
            if room[s] < todo:
                s = int(np.argmax(room))
            take = min(todo, int(room[s]))
            out.append((d, start, take, len(doc) + s, int(used[s])))
            room[s] -= take
            used[s] += take
            cost[s] += linear * take + quadratic * take * take
            todo, start = todo - take, start + take
    pieces.append(np.array(out, np.int64).reshape(-1, 5))
    return np.concatenate(pieces)


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, kind: str = "word", ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset,
    ids_crc32 and, with ``ids``, the ids themselves."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer, kind)
        base = TaskContext.get().partitionId() << 33
        for batch in sliced(batches, "text", RUN_BYTES):
            tokens, at = code.encode(batch.column("text"))
            tokens = np.insert(tokens.astype("<u4"), at[1:], end_id)
            at = at + np.arange(len(at))
            rows = assign(np.diff(at), size)
            d, start, length, seq, offset = rows.T
            raw = memoryview(tokens).cast("B")
            begin = at[d] + start
            crc = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begin.tolist(), (begin + length).tolist())]
            cols = [
                batch.column("doc_id").take(pa.array(d)),
                *(pa.array(c) for c in (start, length, np.diff(at)[d], base + seq, offset)),
                pa.array(crc, pa.int64()),
            ]
            if ids:
                ends = np.cumsum(length)
                at_ids = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - length), length)
                cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(tokens[at_ids].astype(np.int32))))
            base += int(seq.max()) + 1
            yield pa.RecordBatch.from_arrays(cols, names=names)

    key = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {key}, {SCHEMA}, ids_crc32 bigint" + ", ids array<int>" * ids
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"] + ["ids"] * ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)
