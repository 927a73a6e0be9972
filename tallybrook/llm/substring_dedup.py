"""Removal of repeated word passages by Rabin-Karp hashes of every window.

Every window of ``width`` consecutive words gets a rolling 64-bit hash, and a
second one that picks its bucket.  Windows travel to their bucket packed, a few
thousand to a row.  A run of rows sends a hash once, however often it occurs
there, so a passage that a third of all documents share costs one entry per run
and cannot make a bucket hot.  A bucket finds the hashes that come from
several runs, keeps the earliest window of each, and sends the places of the
others to their documents, again packed by groups of documents.  There the
windows merge into maximal intervals, which are cut out of the text.

Windows are judged on the input.  The earliest is the one of the smallest
doc_id (NULL before all), and in a document the one that starts first.  Rows
that share a doc_id count as documents of their own, ordered by text.  A NULL or
empty text has no words and stays as it is; a text shorter than a window loses
nothing.  All columns of the input are returned, but for those with the names of
the new ones, which are replaced.  Equal windows are told by 64 bits and the
bucket (7 bits or more): some 10^-4 wrong pairs are to be expected in 10^9
windows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tallybrook.llm.common import as_bytes, aside, keyed, pack, sliced, split_words, text_bytes, word_hashes
from tallybrook.llm.exchange import NULL_ID, RUN_BYTES, grouped, keys, passing, text_rows, texts_and_places, to_bucket, to_groups

BASE, SECOND = np.uint64(0x9E3779B97F4A7C15 | 3), np.uint64(0xC2B2AE3D27D4EB4F | 3)
MIX = np.uint64(0xFF51AFD7ED558CCD)
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BUCKET_BYTES, GROUP_BYTES = 8 << 20, 4 << 20
NEW = [
    StructField("n_words", LongType()),
    StructField("n_removed", LongType()),
    StructField("kept_words", StringType()),
    StructField("removed", ArrayType(ArrayType(LongType()))),
]


def rolling(words: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hash, modulo 2**64, of each window of ``width`` hashed words.
    Windows of doubled width are put together from two."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, have, power = None, 0, int(base)
    part, size = words, 1  # hashes of all windows of `size` words
    while width:
        if width & 1:
            out = part if out is None else part[: len(part) - have] * _power(base, have) + out[size : size + len(part) - have]
            have += size
        width >>= 1
        if width:
            part = part[:-size] * np.uint64(power) + part[size:]
            power = power * power & (1 << 64) - 1
            size *= 2
    return out[:n]


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def _window_rows(width: int, buckets: int, groups: int):
    """Rows (bucket, to_group, value): windows for a bucket, or (to_group not
    NULL) places already known to repeat within a run."""

    def rows(batches):
        for batch in sliced(batches, "text", RUN_BYTES):
            doc, n = keys(batch)
            order = np.lexsort((n, doc))
            texts = as_bytes(batch.column("text"))
            hashes = word_hashes()
            hashed = [hashes.of(split_words(texts[i])) for i in order]
            sizes = np.array([len(h) for h in hashed], np.int64)
            words = np.concatenate(hashed)
            first = np.cumsum(sizes) - sizes
            counts = np.maximum(sizes - width + 1, 0)
            if not counts.sum():
                continue
            which = np.repeat(np.arange(len(sizes)), counts)
            at = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
            place = first[which] + at
            h = rolling(words, width, BASE)[place]
            second = rolling(words, width, SECOND)[place] * MIX
            bucket = ((second >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            doc, n = doc[order][which], n[order][which]
            by_hash = np.argsort(h, kind="stable")
            same = (h[by_hash][1:] == h[by_hash][:-1]) & (second[by_hash][1:] == second[by_hash][:-1])
            again = np.zeros(len(h), bool)
            again[by_hash[1:][same]] = True
            ids, blobs = grouped(doc[again], n[again], at[again], groups)
            yield to_bucket([i % buckets for i in ids], ids, blobs)
            keep = np.flatnonzero(~again)
            keep = keep[np.argsort(bucket[keep], kind="stable")]
            b = bucket[keep]
            starts = np.concatenate([[0], np.flatnonzero(np.diff(b)) + 1])
            parts = []
            for s, e in zip(starts, np.append(starts[1:], len(b))):
                k = keep[s:e]
                parts.append(
                    pack(pa.table({"h": h[k], "doc": np.diff(doc[k], prepend=0), "n": n[k].astype(np.int32), "at": np.diff(at[k], prepend=0).astype(np.int32)}))
                )
            yield to_bucket(b[starts].tolist(), [None] * len(parts), parts)

    return rows


def _repeats(groups: int):
    """Of one bucket's windows, the places of all but the earliest of each hash."""

    def find(rows: pa.Table) -> pa.Table:
        ids, out, parts = passing(rows)
        if parts:
            h = np.concatenate([p["h"].to_numpy() for p in parts])
            doc = np.concatenate([np.cumsum(p["doc"].to_numpy()) for p in parts])
            n = np.concatenate([p["n"].to_numpy() for p in parts])
            at = np.concatenate([np.cumsum(p["at"].to_numpy()) for p in parts])
            order = np.argsort(h)
            same = h[order][1:] == h[order][:-1]
            several = np.zeros(len(h), bool)
            several[order[1:][same]] = True
            several[order[:-1][same]] = True
            k = np.flatnonzero(several)
            k = k[np.lexsort((at[k], n[k], doc[k], h[k]))]
            k = k[1:][h[k][1:] == h[k][:-1]] if len(k) else k
            more, places = grouped(doc[k], n[k], at[k], groups)
            ids, out = ids + more, out + places
        return to_groups(ids, out)

    return find


def _cut(width: int, schema: StructType):
    """Cut the repeated windows out of the texts of a group."""
    names = [f.name for f in schema]

    def cut(rows: pa.Table) -> pa.Table:
        texts, at_of = texts_and_places(rows)
        out_text, kept, n_words, n_removed, removed = [], [], [], [], []
        ids = texts["doc_id"].cast(pa.int64()).fill_null(NULL_ID).to_pylist()
        for key, n, text in zip(ids, texts["_n"].to_pylist(), texts["text"].cast(pa.binary()).to_pylist()):
            words = split_words(text)
            at = at_of.get((key, n))
            n_words.append(len(words))
            if at is None:
                out_text.append(text)
                kept.append(b" ".join(words))
                n_removed.append(0)
                removed.append([])
                continue
            # windows that overlap or touch make one interval
            first = np.concatenate([[True], np.diff(at) > width])
            begin = at[first]
            end = np.append(at[:-1][first[1:]], at[-1]) + width
            stay = np.ones(len(words), bool)
            spans = [[int(b), int(e)] for b, e in zip(begin, end)]
            for b, e in spans:
                stay[b:e] = False
            kept.append(b" ".join([w for w, s in zip(words, stay.tolist()) if s]))
            n_removed.append(int((~stay).sum()))
            removed.append(spans)
            starts = [m.start() for m in WORD.finditer(text)] + [len(text)]
            pieces, last = [], 0
            for b, e in spans:
                pieces.append(text[last : starts[b]])
                last = starts[e]
            out_text.append(b"".join(pieces) + text[last:])
        new = {
            "text": pa.array(out_text, pa.binary()).cast(pa.string()),
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept_words": pa.array(kept, pa.binary()).cast(pa.string()),
            "removed": pa.array(removed, pa.list_(pa.list_(pa.int64()))),
        }
        return pa.table([new[c] if c in new else texts[c] for c in names], names=names)

    return cut


def remove_repeats(docs: DataFrame, width: int = 20) -> DataFrame:
    """Documents without the passages that occur earlier: the columns of the
    input with ``text`` cut, n_words, n_removed, kept_words (joined by one
    space) and removed (intervals of word numbers, end excluded)."""
    new = {f.name.lower() for f in NEW}
    docs, back = aside(docs.select(*[c for c in docs.columns if c.lower() == "text" or c.lower() not in new]), ["_n"])
    size = text_bytes(docs)
    buckets, groups = max(128, size // BUCKET_BYTES), max(128, size // GROUP_BYTES)
    named = keyed(docs)
    schema = StructType([*docs.schema.fields, *NEW])
    found = (
        named.select("doc_id", "_n", "text")
        .mapInArrow(_window_rows(width, buckets, groups), "bucket int, to_group int, value binary")
        .groupBy("bucket")
        .applyInArrow(_repeats(groups), "group int, kind int, value binary")
    )
    texts = named.mapInArrow(text_rows(groups), "group int, kind int, value binary")
    return back(texts.unionByName(found).groupBy("group").applyInArrow(_cut(width, schema), schema))
