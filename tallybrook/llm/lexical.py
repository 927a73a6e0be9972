"""Ranked lexical search by scanning documents with an automaton of all items' terms.

Terms are runs of ASCII letters and digits and of characters beyond ASCII; only
A to Z are lower-cased.  In UTF-8 every other byte ends a term, so a text whose
other bytes became blanks is matched, byte for byte, against an Aho-Corasick
automaton of the items' terms with a blank on either side: it finds whole terms
only, all of them in one walk, with no index of the documents.  Terms point to
the items that hold them.

Two scans: one counts in how many documents each term occurs, and how long
documents are; the other scores.  Each task keeps the best k of every item, and
these meet in two steps (part of the tasks, then all), so nothing grows with the
number of documents in one place.  Items come in blocks of bounded bytes; each
block has an automaton of its own, so broadcasts are bounded whatever the number
of items (an item larger than a block is a block).

Scores are 64-bit integers.  NULL and empty texts have no term: such a document
does not count, such an item finds nothing.  Equal scores are ranked by ascending
doc_id, NULL last.  Rows that share a doc_id are documents of their own; items
that share an item_id are ranked each for itself.  Texts of any length are read
whole; only counts are kept of them.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.common import as_bytes, sliced, worker_cache

# Every ASCII byte outside letters and digits becomes a blank; A to Z lower case.
FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
SLICE, MATCHES = 1 << 20, 1 << 20
BLOCK_BYTES, BLOCK_ITEMS = 4 << 20, 4_096
CELLS = 1 << 20  # scores held at once: documents of a step times items
PARTS, SUMS = 64, 8  # groups of tasks that meet first: best documents, sums


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split(b" ") if text else []


class Block:
    """Items of a block: their distinct terms, numbered, and who holds them."""

    def __init__(self, items: list[tuple[int | None, bytes | None]]):
        self.ids = [i for i, _ in items]
        holders: dict[bytes, list[int]] = {}
        for k, (_, text) in enumerate(items):
            for term in set(terms(text)) - {b""}:
                holders.setdefault(term, []).append(k)
        self.terms = sorted(holders)
        held = [holders[t] for t in self.terms]
        self.ends = np.cumsum([0, *map(len, held)])
        self.items = np.fromiter(chain.from_iterable(held), np.int64, int(self.ends[-1]))
        self.name = uuid.uuid4().hex

    def automaton(self):
        """Built once in each worker, which keeps that of the last block; the block
        travels as its terms only."""
        kept = worker_cache("automaton", dict)
        if self.name not in kept:
            import ahocorasick

            a = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for i, term in enumerate(self.terms):
                a.add_word(f" {term.decode('latin-1')} ", i)
            a.make_automaton()
            kept.clear()
            kept[self.name] = a
        return kept[self.name]

    def counts(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text, and (text, term, occurrences) of the items' terms."""
        folded = [b" " + (t or b"").translate(FOLD) + b" " for t in texts]
        ends = np.cumsum([len(t) for t in folded])
        whole = b"".join(folded)
        blank = np.frombuffer(whole, np.uint8) == 32
        # a text ends and the next begins with a blank, so a term starts in one text
        starts = np.flatnonzero(blank[:-1] & ~blank[1:])
        n = np.bincount(np.searchsorted(ends, starts, "right"), minlength=len(texts))
        found = chain.from_iterable(self.automaton().iter(whole.decode("latin-1")))
        size, cells, times = len(self.terms), [], []
        while True:
            pairs = np.fromiter(islice(found, 2 * MATCHES), np.int64)
            if not len(pairs):
                break
            # a match ends on its closing blank, which is still the text's own
            cell = np.searchsorted(ends, pairs[::2], "right") * size + pairs[1::2]
            c, m = np.unique(cell, return_counts=True)
            cells.append(c)
            times.append(m)
        if not cells:
            none = np.empty(0, np.int64)
            return n, none, none, none
        cell, back = np.unique(np.concatenate(cells), return_inverse=True)
        tf = np.zeros(len(cell), np.int64)
        np.add.at(tf, back, np.concatenate(times))
        return n, cell // size, cell % size, tf


def blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """Items with a text in blocks of at most BLOCK_BYTES and BLOCK_ITEMS."""
    held, size = [], 0
    rows = items.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    for row in rows.toLocalIterator():
        text = bytes(row["text"], "utf-8")
        if held and (size + len(text) > BLOCK_BYTES or len(held) == BLOCK_ITEMS):
            yield Block(held)
            held, size = [], 0
        held.append((row["id"], text))
        size += len(text)
    if held:
        yield Block(held)


def statistics(texts: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms in all, and documents per term of the block."""
    size = len(block.terms)

    def count(batches):
        total = np.zeros(size + 2, np.int64)
        for batch in sliced(batches, "text", SLICE):
            n, _, term, _ = block.counts(as_bytes(batch.column("text")))
            total[:2] += np.count_nonzero(n), n.sum()
            total[2:] += np.bincount(term, minlength=size)
        part = TaskContext.get().partitionId() % SUMS
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    def add(batches):
        total = None
        for batch in batches:
            for sums in batch.column("sums").to_pylist():
                total = np.frombuffer(sums, np.int64) + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    # tasks' sums by SUMS groups, and these on the driver: SUMS numbers per term of a block
    sums = texts.select("text").mapInArrow(count, "part int, sums binary").repartition(SUMS, "part").mapInArrow(add, "sums binary")
    total = sum((np.frombuffer(r["sums"], np.int64) for r in sums.collect()), np.zeros(size + 2, np.int64))
    return int(total[0]), int(total[1]), total[2:]


def _best(found: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """Of (item, score, no id, doc) the best k of each item."""
    item, score, none, doc = found
    order = np.lexsort((doc, none, -score, item))
    item, score, none, doc = item[order], score[order], none[order], doc[order]
    keep = np.arange(len(item)) - np.searchsorted(item, item) < k
    return item[keep], score[keep], none[keep], doc[keep]


def _scores(texts: DataFrame, block: Block, documents: int, length: int, df: np.ndarray, k: int) -> DataFrame:
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    n_items = len(block.ids)
    step = max(1, CELLS // n_items)

    def score(batches):
        best = tuple(np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64))
        floor = np.ones(n_items, np.int64)  # the least score that may still enter
        for batch in sliced(batches, "text", SLICE):
            ids = batch.column("doc_id")
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
            n, text, term, tf = block.counts(as_bytes(batch.column("text")))
            m = np.array([10 + 90 * x * documents // length if length else 10 for x in n.tolist()], np.int64)
            part = weight[term] * (1_000_000_000 * tf // (1_000 * tf + 8 * m[text]))
            for first in range(0, len(n), step):
                a, b = np.searchsorted(text, (first, first + step))
                times = block.ends[term[a:b] + 1] - block.ends[term[a:b]]
                rows = np.repeat(np.arange(a, b), times)
                at = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
                item = block.items[block.ends[term[rows]] + at]
                total = np.zeros((min(step, len(n) - first), n_items), np.int64)
                np.add.at(total.reshape(-1), (text[rows] - first) * n_items + item, part[rows])
                d, i = np.nonzero(total >= floor)
                new = (i, total[d, i], no_id[d + first], doc[d + first])
                best = _best(tuple(np.concatenate([x, y]) for x, y in zip(best, new)), k)
                full = np.flatnonzero(np.bincount(best[0], minlength=n_items) == k)
                floor[full] = best[1][np.searchsorted(best[0], full, "right") - 1]
        item, points, none, doc = best
        part = TaskContext.get().partitionId() % PARTS
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item, pa.int32()),
                pa.array([block.ids[i] for i in item.tolist()], pa.int64()),
                pa.array(doc, pa.int64(), mask=none),
                pa.array(points, pa.int64()),
                pa.array(np.full(len(item), part), pa.int32()),
            ],
            names=["item", "item_id", "doc_id", "score", "part"],
        )

    return texts.mapInArrow(score, "item int, item_id bigint, doc_id bigint, score bigint, part int")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's k best documents.
    Further columns of either table are not read."""
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    for block in blocks(items, id_col, text_col):
        if not block.terms:
            continue
        found = _scores(texts, block, *statistics(texts, block), k)
        near = Window.partitionBy("item", "part").orderBy(*order)
        few = found.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k)
        rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
        best = few.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)
        out = out.unionByName(best.select("item_id", "rank", "doc_id", "score"))
    return out
