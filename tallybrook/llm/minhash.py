"""Near copies by DartMinHash over weighted word shingles.

A document is the multiset of its five-word shingles, a shingle's weight being
the number of times it occurs; similarity is weighted Jaccard.  Hashed darts
are thrown at the plane weight x rank of every shingle, region by dyadic
region: how many darts fall into a region (Poisson, of its area), where, and on
which of the k coordinates depends on the shingle alone.  A dart counts if it
lies below the shingle's weight; each coordinate keeps the dart of lowest rank.
Two documents agree on a coordinate with probability equal to their
similarity.  Regions are thrown in order of rank until all coordinates of a
document have a dart, so the work follows its number of shingles.

Documents with equal words form a class, of which one takes part.  Bands of
coordinates give buckets; in a bucket every member is paired with the one that
shares most with others, never with all, and pairs are checked by exact
similarity.  What is still apart after that but shares a bucket is never compared
bucket by bucket: each such text sends its rarest shingles, as many as two similar
texts can't all differ in, and texts of different groups that meet in one of them
are checked in the same way.  No link in a bucket is lost, and shingles that very
many texts share bring nobody together.  Links make groups by connected components;
all of it stays in tables.

Documents of fewer than five words have one shingle, of all their words; those
without words (NULL, empty) are near nothing.  Rows that share a doc_id count
as documents of their own.  A NULL doc_id sorts first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import as_bytes, aside, keyed, sliced, split_words, word_hashes, written
from tallybrook.llm.substring_dedup import rolling

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 28, 6
BASE = np.uint64(0x9E3779B97F4A7C15 | 3)
SLOTS = 1 << 20  # of shingle hashes, to tell rare from frequent
SMALLEST = 0.25  # rank of the first regions
MANY = 1 << 19  # darts of one step


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def poisson(area: float) -> np.ndarray:
    """Distribution function of a Poisson variable, up to where it is 1."""
    n = np.arange(int(area + 12 * np.sqrt(area) + 24))
    logs = n * np.log(area) - area - np.concatenate([[0.0], np.cumsum(np.log(n[1:]))])
    return np.cumsum(np.exp(logs))


def sketch(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, k: int) -> np.ndarray:
    """Signatures (docs x k) of weighted sets given as rows (owner, element,
    weight); owners are 0 to docs - 1, and each has an element."""
    best = np.full(docs * k, np.iinfo(np.uint64).max, np.uint64)
    open_ = np.ones(docs, bool)
    low, high, level = 0.0, SMALLEST, 0
    while open_[owner].any():
        rows = np.flatnonzero(open_[owner])
        bottom, top, band = 0.0, 1.0, 0
        while True:
            at = rows[weight[rows] > bottom] if bottom else rows
            if not len(at):
                break
            area = (top - bottom) * (high - low)
            step = max(1, int(MANY / max(area, 1.0)))
            cdf = poisson(area)
            for part in (at[i : i + step] for i in range(0, len(at), step)):
                seed = mix(element[part] + np.uint64((level * 64 + band + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
                count = np.searchsorted(cdf, unit(seed), "right")
                hit = np.flatnonzero(count)
                n = count[hit]
                which = np.repeat(hit, n)
                dart = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                h = mix(seed[which] + (dart + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
                rank = low + (high - low) * unit(mix(h ^ np.uint64(0xA5A5)))
                if band:
                    below = bottom + (top - bottom) * unit(mix(h ^ np.uint64(0x5A5A))) < weight[part[which]]
                    which, h, rank = which[below], h[below], rank[below]
                slot = owner[part[which]] * k + (h % np.uint64(k)).astype(np.int64)
                # rank first, then the dart's own hash
                value = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (h >> np.uint64(32))
                np.minimum.at(best, slot, value)
            bottom, top, band = top, top * 2, band + 1
        full = (best.reshape(docs, k) != np.iinfo(np.uint64).max).all(1)
        open_ &= ~full
        low, high, level = high, high * 2, level + 1
    return best.reshape(docs, k)


def shingles(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Distinct shingles of some texts: owner, hash, count; and each text's words
    joined by one space."""
    hashes = word_hashes()
    words = [split_words(t) for t in texts]
    owners, values = [], []
    for i, w in enumerate(words):
        if w:
            h = hashes.of(w)
            values.append(rolling(h, min(SHINGLE, len(w)), BASE))
            owners.append(np.full(len(values[-1]), i))
    joined = [b" ".join(w) for w in words]
    if not values:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0), joined
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (value[1:] != value[:-1])]))
    return owner[first], value[first], np.diff(np.append(first, len(owner))).astype(float), joined


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, _n, hi and lo (128-bit hash of the words) and bands (NULL without
    words)."""

    def make(batches):
        for batch in sliced(batches, "text", 2 << 20):
            owner, element, weight, joined = shingles(as_bytes(batch.column("text")))
            present = np.unique(owner)
            values = [None] * batch.num_rows
            if len(present):
                signature = sketch(np.searchsorted(present, owner), element, weight, len(present), bands * rows)
                # the low halves are hashes of the darts, the ranks add nothing
                parts = mix(signature).reshape(len(present), bands, rows)
                h = np.zeros((len(present), bands), np.uint64)
                for r in range(rows):
                    h = mix(h * BASE + parts[:, :, r])
                for i, v in zip(present.tolist(), h.view(np.int64).tolist()):
                    values[i] = v
            digests = [xxhash.xxh3_128_intdigest(j) for j in joined]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("_n"),
                    pa.array(np.array([d >> 64 for d in digests], np.uint64).view(np.int64)),
                    pa.array(np.array([d & (1 << 64) - 1 for d in digests], np.uint64).view(np.int64)),
                    pa.array(values, pa.list_(pa.int64())),
                ],
                names=["doc_id", "_n", "hi", "lo", "bands"],
            )

    key = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "_n", "text").mapInArrow(make, f"doc_id {key}, _n int, hi bigint, lo bigint, bands array<bigint>")


def _similar(threshold: float):
    """Rows (b, salt, a, text), sorted so that b's own text (a NULL) comes first:
    pairs (a, b) that are similar."""

    def one(text: bytes) -> tuple[np.ndarray, np.ndarray]:
        _, value, count, _ = shingles([text])
        return value, count

    def check(batches):
        b_id, b = None, None
        for batch in sliced(batches, "text", 2 << 20):
            out = []
            for to, a, text in zip(batch.column("b").to_pylist(), batch.column("a").to_pylist(), as_bytes(batch.column("text"))):
                if a is None:
                    b_id, b = to, one(text)
                    continue
                if to != b_id:
                    raise ValueError("a pair came before its second text")
                value, count = one(text)
                total = count.sum() + b[1].sum()
                if min(count.sum(), b[1].sum()) < threshold * max(count.sum(), b[1].sum()):
                    continue
                _, i, j = np.intersect1d(value, b[0], assume_unique=True, return_indices=True)
                shared = np.minimum(count[i], b[1][j]).sum()
                if shared >= threshold * (total - shared):
                    out.append((a, to))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return check


def links(pairs: DataFrame, ids: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose texts are similar.  A text travels once
    for each of its pairs as a; b's text once for each 256 of them or so."""
    pairs = written(pairs.withColumn("salt", F.pmod(F.hash("a"), F.lit(64))), "pairs")
    wanted = pairs.select(F.col("a").alias("uid")).union(pairs.select(F.col("b").alias("uid"))).distinct()
    names = wanted.join(ids, "uid").select("uid", "doc_id", "_n")
    same = F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("d._n") == F.col("i._n"))
    texts = written(docs.alias("d").join(names.alias("i"), same).select("i.uid", "d.text"), "texts")
    first = pairs.join(texts, pairs["a"] == texts["uid"]).select("b", "salt", "a", "text")
    second = pairs.select("b", "salt").distinct().join(texts, F.col("b") == texts["uid"]).select("b", "salt", F.lit(None).cast("bigint").alias("a"), "text")
    rows = first.unionByName(second).repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())
    return written(rows.select("b", "a", "text").mapInArrow(_similar(threshold), "a bigint, b bigint"), "links")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node of each node's component, as uid, label: labels spread over
    the edges and jump along labels until nothing changes."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = written(nodes.select("uid", F.col("uid").alias("label")), "labels")
    while True:
        near = both.join(label, both["b"] == label["uid"]).groupBy("a").agg(F.min("label").alias("near"))
        step = label.join(near, label["uid"] == near["a"], "left").select("uid", F.least("label", F.coalesce("near", "label")).alias("label"), F.col("label").alias("was"))
        step = written(step, "labels")
        jump = step.select(F.col("uid").alias("to"), F.col("label").alias("further"))
        moved = step.filter("label <> uid").join(jump, F.col("label") == F.col("to")).select("uid", "further", "was")
        still = step.filter("label = uid").select("uid", F.col("label").alias("further"), "was")
        new = written(moved.union(still), "labels")
        label = new.select("uid", F.col("further").alias("label"))
        if new.filter("further <> was").limit(1).isEmpty():
            return label


def _frequencies(texts: DataFrame) -> np.ndarray:
    """How many shingles of the texts fall into each slot of the hash space: tasks
    add up what they read, Spark adds up the tasks.  Its size is fixed."""

    def count(batches):
        total = np.zeros(SLOTS, np.int64)
        for batch in sliced(batches, "text", 2 << 20):
            value = shingles(as_bytes(batch.column("text")))[1]
            total += np.bincount(_slot(value), minlength=SLOTS)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(total[slot])], names=["slot", "n"])

    got = texts.select("text").mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SLOTS, np.int64)
    out[got["slot"].to_numpy()] = got["n"].to_numpy()
    return out


def _slot(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _rarest(frequency: np.ndarray, threshold: float):
    """Of each text (uid, label) the shingles that come first by (frequency, hash), with
    the weight from each of them on to the last and the whole weight.

    Texts whose shared weight is ``threshold`` of the larger one or more have a first
    shared shingle, behind which all that they share must fit: so neither of them has
    less than that share of its weight left there, and both send it.
    """

    def rows(batches):
        for batch in sliced(batches, "text", 2 << 20):
            owner, value, weight, _ = shingles(as_bytes(batch.column("text")))
            order = np.lexsort((value, frequency[_slot(value)], owner))
            owner, value, weight = owner[order], value[order], weight[order]
            total = np.bincount(owner, weight, batch.num_rows)
            rest = np.cumsum(total)[owner] - np.cumsum(weight) + weight
            sent = rest >= threshold * total[owner] * (1 - 1e-12)
            at = pa.array(owner[sent])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("uid").take(at),
                    batch.column("label").take(at),
                    pa.array(value[sent].view(np.int64)),
                    pa.array(rest[sent].astype(np.int64)),
                    pa.array(total[owner[sent]].astype(np.int64)),
                ],
                names=["uid", "label", "shingle", "rest", "total"],
            )

    return rows


def across(apart: DataFrame, ids: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of texts with different labels that may be similar: all that are,
    and others that have a rare shingle in common."""
    names = apart.join(ids, "uid").select("uid", "label", "doc_id", "_n")
    same = F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("d._n") == F.col("i._n"))
    texts = written(docs.alias("d").join(names.alias("i"), same).select("i.uid", "i.label", "d.text"), "apart-texts")
    sent = texts.mapInArrow(_rarest(_frequencies(texts), threshold), "uid bigint, label bigint, shingle bigint, rest bigint, total bigint")
    sent = written(sent, "rarest")
    # a shingle of one group alone brings no pair: a group of many copies stays out of the join
    mixed = sent.groupBy("shingle").agg(F.min("label").alias("l"), F.max("label").alias("m")).filter("l <> m").select("shingle")
    sent = written(sent.join(mixed, "shingle", "left_semi"), "met")
    x, y = sent.alias("x"), sent.alias("y")
    low, high = F.least("x.total", "y.total"), F.greatest("x.total", "y.total")
    slack = threshold * (1 - 1e-12)
    may = (
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.label") != F.col("y.label"))
        & (F.col("x.uid") > F.col("y.uid"))
        & (low >= high * slack)
        & (F.least("x.rest", "y.rest") * (1 + threshold) >= (low + high) * slack)
    )
    return x.join(y, may).select(F.col("x.uid").alias("a"), F.col("y.uid").alias("b")).distinct()


def near_copies(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, _n, class_id (smallest doc_id of the group) and kept (true for one
    document of each group: the one of the smallest doc_id, then the first by text)."""
    named = keyed(docs.select("doc_id", "text"))
    ids = written(sketches(named, bands, rows).withColumn("uid", F.monotonically_increasing_id()), "sketches")
    # documents without words stay alone: they get a hash of their own
    alone = F.col("bands").isNull()
    same = ids.withColumn("hi", F.when(alone, F.col("uid")).otherwise(F.col("hi"))).withColumn("lo", F.when(alone, F.lit(-1)).otherwise(F.col("lo")))
    first = same.groupBy("hi", "lo").agg(F.min("uid").alias("rep"))
    member = written(same.select("uid", "hi", "lo").join(first, ["hi", "lo"]).select("uid", "rep"), "members")
    reps = member.filter("uid = rep").select("uid")
    slots = ids.join(reps, "uid", "left_semi").select("uid", F.posexplode("bands").alias("band", "h"))
    size = slots.groupBy("band", "h").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(slots.join(size, ["band", "h"]).select("band", "h", "uid", "n"), "buckets")
    # the text that others were copied from shares buckets with more of them than
    # any copy does, so it leads; equal ones are told apart by hash
    weight = shared.groupBy("uid").agg((F.sum("n") * (1 << 20) + F.pmod(F.xxhash64("uid"), F.lit(1 << 20))).alias("weight"))
    weighted = shared.join(weight, "uid")
    leader = weighted.groupBy("band", "h").agg(F.max_by("uid", "weight").alias("b"))
    shared = written(shared.join(leader, ["band", "h"]).select("band", "h", "uid", "b"), "led")
    tried = shared.filter("uid <> b").select(F.col("uid").alias("a"), "b").distinct()
    edges = links(tried, ids, named, similarity)
    label = components(reps, edges)
    # texts in buckets that still hold several components: pair across these
    labelled = shared.join(label, "uid").select("band", "h", "uid", "label", "b")
    split = labelled.groupBy("band", "h").agg(F.min("label").alias("l"), F.max("label").alias("m")).filter("l <> m").select("band", "h")
    apart = written(labelled.join(split, ["band", "h"], "left_semi"), "apart")
    if not apart.limit(1).isEmpty():
        cross = across(apart.select("uid", "label").distinct(), ids, named, similarity)
        more = links(cross, ids, named, similarity)
        label = components(reps, edges.unionByName(more))
    group = member.join(label.withColumnRenamed("uid", "rep"), "rep").select("uid", "label")
    out = ids.select("uid", "doc_id", "_n").join(group, "uid")
    # the smallest (doc_id, _n) of each group, by an aggregate that combines before it shuffles
    least = out.groupBy("label").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("has_null"))
    out = out.join(least, "label").withColumn("class_id", F.when(~F.col("has_null"), F.col("least")))
    lead = F.col("doc_id").eqNullSafe(F.col("class_id"))
    number = out.filter(lead).groupBy("label").agg(F.min("_n").alias("first_n"))
    out = out.join(number, "label")
    return out.select("doc_id", "_n", "class_id", (lead & (F.col("_n") == F.col("first_n"))).alias("kept"))


def without_near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of the input that stay: one document of each group."""
    kept = near_copies(docs, similarity).filter("kept").select("doc_id", "_n")
    renamed, back = aside(docs, ["_n"])
    named = keyed(renamed)
    same = named["doc_id"].eqNullSafe(kept["doc_id"]) & (named["_n"] == kept["_n"])
    return back(named.join(kept, same, "left_semi").drop("_n"))
