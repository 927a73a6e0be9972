"""Removal of repeated runs of lines, by content-defined chunks.

The lines of a text are hashed, and a rolling hash over each two neighbouring
line hashes decides whether a chunk may end after them: all but one in
``divisor`` of the places do.  ``min_lines`` lets a cut also depend on where its
chunk began, so after inserted lines chunks agree again from the first end that
both have, mostly a few lines later.  A repeat goes as far as whole chunks lie
inside it, so short repeats in different surroundings may stay.  A chunk has ``min_lines`` to ``max_lines`` lines; only chunks of two
lines or more that hold a word are ever removed.  Chunks go, packed, to the
bucket of their hash.  A run of rows sends equal chunks once, so a chunk that a
third of all documents share stays small.  In its bucket, chunks of one hash
are compared byte by byte; all but the earliest of equal ones are removed.

The earliest chunk is that of the smallest doc_id (NULL before all), then the
first in its document.  Rows that share a doc_id count as documents of their
own, ordered by text.  A NULL text stays NULL.  All columns of the input are
returned, but for those with the names of the new ones, which are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from tallybrook.llm.common import as_bytes, aside, keyed, pack, sliced, text_bytes
from tallybrook.llm.exchange import NULL_ID, RUN_BYTES, grouped, keys, passing, text_rows, texts_and_places, to_bucket, to_groups

BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
BUCKET_BYTES, GROUP_BYTES = 8 << 20, 4 << 20
NEW = [StructField("n_lines", LongType()), StructField("n_removed_lines", LongType())]


def chunks(lines: list[bytes], divisor: int, min_lines: int, max_lines: int) -> list[tuple[int, int]]:
    """Intervals of lines, end excluded."""
    out, start, last = [], 0, 0
    for i, line in enumerate(lines):
        h = xxhash.xxh3_64_intdigest(line)
        rolled = (last * BASE + h) & MASK
        last = h
        size = i + 1 - start
        if size >= max_lines or (size >= min_lines and (rolled * BASE & MASK) >> 40 & 0xFFFF >= 0x10000 // divisor):
            out.append((start, i + 1))
            start = i + 1
    if start < len(lines):
        out.append((start, len(lines)))
    return out


def _chunk_rows(rule: tuple[int, int, int], buckets: int, groups: int):
    def rows(batches):
        for batch in sliced(batches, "text", RUN_BYTES):
            doc, n = keys(batch)
            texts = as_bytes(batch.column("text"))
            seen: set[bytes] = set()
            new, again = [], []
            for i in np.lexsort((n, doc)).tolist():
                lines = texts[i].split(b"\n") if texts[i] else []
                for k, (a, b) in enumerate(chunks(lines, *rule)):
                    if b - a < 2:
                        continue
                    body = b"\n".join(lines[a:b])
                    if body in seen:
                        again.append((doc[i], n[i], k))
                    elif not body.isspace() and body:
                        seen.add(body)
                        h = xxhash.xxh3_128_intdigest(body)
                        new.append((h % buckets, h >> 64, h & MASK, doc[i], n[i], k, body))
            if again:
                d, m, k = (np.array(x, np.int64) for x in zip(*again))
                ids, blobs = grouped(d, m, k, groups)
                yield to_bucket([i % buckets for i in ids], ids, blobs)
            new.sort(key=lambda r: r[0])
            starts = [i for i in range(len(new)) if not i or new[i][0] != new[i - 1][0]]
            parts = []
            for s, e in zip(starts, [*starts[1:], len(new)]):
                _, hi, lo, d, m, k, body = zip(*new[s:e])
                parts.append(
                    pack(
                        pa.table(
                            {
                                "hi": pa.array(hi, pa.uint64()),
                                "lo": pa.array(lo, pa.uint64()),
                                "doc": pa.array(d, pa.int64()),
                                "n": pa.array(m, pa.int32()),
                                "at": pa.array(k, pa.int32()),
                                "body": pa.array(body, pa.large_binary()),
                            }
                        )
                    )
                )
            yield to_bucket([new[s][0] for s in starts], [None] * len(parts), parts)

    return rows


def _repeats(groups: int):
    def find(rows: pa.Table) -> pa.Table:
        ids, out, parts = passing(rows)
        if parts:
            t = pa.concat_tables(parts)
            hi, lo, doc, n, at = (t[c].to_numpy() for c in ("hi", "lo", "doc", "n", "at"))
            order = np.lexsort((at, n, doc, lo, hi))
            same = (hi[order][1:] == hi[order][:-1]) & (lo[order][1:] == lo[order][:-1])
            several = np.zeros(len(order), bool)
            several[1:] |= same
            several[:-1] |= same
            seen: set[bytes] = set()
            again = []
            bodies = t["body"].take(pa.array(order[several])).to_pylist() if several.any() else []
            for i, body in zip(order[several].tolist(), bodies):
                if body in seen:  # equal byte by byte
                    again.append(i)
                seen.add(body)
            more, values = grouped(doc[again], n[again].astype(np.int64), at[again].astype(np.int64), groups)
            ids, out = ids + more, out + values
        return to_groups(ids, out)

    return find


def _cut(rule: tuple[int, int, int], schema: StructType):
    names = [f.name for f in schema]

    def cut(rows: pa.Table) -> pa.Table:
        texts, at_of = texts_and_places(rows)
        out, n_lines, n_removed = [], [], []
        ids = texts["doc_id"].cast(pa.int64()).fill_null(NULL_ID).to_pylist()
        for key, n, text in zip(ids, texts["_n"].to_pylist(), texts["text"].cast(pa.binary()).to_pylist()):
            at = at_of.get((key, n))
            n_lines.append(text.count(b"\n") + 1 if text else 0)
            n_removed.append(0)
            if at is not None:
                lines, gone = text.split(b"\n"), set(at.tolist())
                kept = []
                for k, (a, b) in enumerate(chunks(lines, *rule)):
                    if k in gone:
                        n_removed[-1] += b - a
                    else:
                        kept += lines[a:b]
                text = b"\n".join(kept)
            out.append(text)
        new = {
            "text": pa.array(out, pa.binary()).cast(pa.string()),
            "n_lines": pa.array(n_lines, pa.int64()),
            "n_removed_lines": pa.array(n_removed, pa.int64()),
        }
        return pa.table([new[c] if c in new else texts[c] for c in names], names=names)

    return cut


def remove_repeated_lines(docs: DataFrame, divisor: int = 3, min_lines: int = 2, max_lines: int = 64) -> DataFrame:
    """The columns of the input with ``text`` cut, n_lines and n_removed_lines."""
    new = {f.name.lower() for f in NEW}
    docs, back = aside(docs.select(*[c for c in docs.columns if c.lower() == "text" or c.lower() not in new]), ["_n"])
    rule = (divisor, min_lines, max_lines)
    size = text_bytes(docs)
    buckets, groups = max(128, size // BUCKET_BYTES), max(128, size // GROUP_BYTES)
    named = keyed(docs)
    schema = StructType([*docs.schema.fields, *NEW])
    found = (
        named.select("doc_id", "_n", "text")
        .mapInArrow(_chunk_rows(rule, buckets, groups), "bucket int, to_group int, value binary")
        .groupBy("bucket")
        .applyInArrow(_repeats(groups), "group int, kind int, value binary")
    )
    texts = named.mapInArrow(text_rows(groups), "group int, kind int, value binary")
    return back(texts.unionByName(found).groupBy("group").applyInArrow(_cut(rule, schema), schema))
