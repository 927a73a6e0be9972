"""Approximate nearest neighbours by the order in which vectors see pivots.

A vector is represented by its NEAREST closest pivots in order.  Vectors are dealt
into shards; a shard posts each of its vectors in the inverted files of these
pivots, with its place there.  A query reads the files of its own closest pivots
only, and adds up what makes its footrule distance to each vector met: with places
p and q at a shared pivot (from 0), footrule = m(m+1) - 2 * sum(m - max(p, q)) for
lists of m pivots.  The vectors at least as close by footrule as a share of the
shard's rows are ranked again by exact Euclidean distance.

Only pivots are a sample: PIVOTS distinct vectors, the first by hash.  Every vector
is posted.  Equal vectors are posted once, with the k + 1 smallest of their ids:
at equal distance smaller ids come first, so no other can be an answer.  So a vector
that a third of the rows hold is one posting, and its copies cannot fill the
candidates.  All that tie with the last candidate are candidates.

Distances are in double precision, ties go to the smaller id.  Vectors that are NULL
or zero, or hold NULL or non-finite components, take no part, nor do rows without
an id; missing trailing components count as 0.  A query skips all rows of its id.
Rows that share an id are one point, as near as the nearest of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.common import written

PIVOTS, NEAREST = 512, 64
SHARD, QUERIES = 8_192, 16_384
# Candidates: a quarter of a shard, LEAST at least.  A share, so that recall does not fall
# where shards are full (a trial with a sixteenth gave 0.86 to 0.89 of the neighbours).
SHARE, LEAST = 4, 512
EDGES = -1  # pivot number of the row that holds a shard's vectors


def usable(rows: DataFrame) -> DataFrame:
    """id and v (doubles as bytes, without trailing zeros) of rows that take part."""

    def convert(batches):
        for batch in batches:
            ids, vectors = batch.column("id"), batch.column("vector")
            sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            # NULL components become NaN, which is not finite; 0.0 turns -0.0 into 0.0
            x = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            ok = vectors.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
            ok &= bad[ends] == bad[ends - sizes]
            own = [np.trim_zeros(x[e - s : e], "b") if o else x[:0] for s, e, o in zip(sizes.tolist(), ends.tolist(), ok.tolist())]
            keep = np.flatnonzero([len(v) for v in own])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(keep, pa.int64())).cast(pa.int64()), pa.array([own[i].tobytes() for i in keep.tolist()], pa.binary())],
                names=["id", "v"],
            )

    return rows.mapInArrow(convert, "id bigint, v binary")


def _matrix(values: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(values), dim))
    for i, b in enumerate(values):
        out[i, : len(b) // 8] = np.frombuffer(b)
    return out


def closest(v: np.ndarray, pivots: np.ndarray, m: int) -> np.ndarray:
    """Numbers of the m closest pivots of each vector, closest first."""
    far = (pivots**2).sum(1)[None, :] - 2 * (v @ pivots.T)
    return np.argsort(far, 1, kind="stable")[:, :m]


def _post(pivots: np.ndarray, m: int, dim: int):
    """Rows of one shard as posting lists, one row per pivot, and a row of vectors."""

    def post(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        table = table.sort_by("v")  # the same numbers whenever the shard is made
        v = _matrix(table["v"].to_pylist(), dim)
        near = closest(v, pivots, m)
        order = np.argsort(near.reshape(-1), kind="stable")
        pivot, at = near.reshape(-1)[order], order // m
        place = order % m
        ends = np.append(np.flatnonzero(np.diff(pivot)) + 1, len(pivot))
        starts = np.concatenate([[0], ends[:-1]])
        lists = [at[a:b].astype(np.int32).tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
        places = [place[a:b].astype(np.int16).tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
        ids = pa.array([[]] * len(lists) + [table["ids"].combine_chunks().flatten().to_pylist()], pa.list_(pa.int64()))
        sizes = table["ids"].combine_chunks().value_lengths().to_numpy().astype(np.int16).tobytes()
        return pa.table(
            {
                "shard": pa.array([shard] * (len(lists) + 1), pa.int32()),
                "pivot": pa.array([*pivot[starts].tolist(), EDGES], pa.int32()),
                "entries": pa.array([*lists, v.tobytes()], pa.binary()),
                "places": pa.array([*places, sizes], pa.binary()),
                "ids": ids,
            }
        )

    return post


def _search(pivots: np.ndarray, m: int, dim: int, k: int, share: int, least: int):
    def search(key: tuple, index: pa.Table, asked: pa.Table) -> pa.Table:
        none = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if not index.num_rows or not asked.num_rows:
            return pa.table(none)
        lists = {}
        for p, e, s, ids in zip(*(index[c].to_pylist() for c in ("pivot", "entries", "places", "ids"))):
            if p == EDGES:
                v, sizes, all_ids = np.frombuffer(e).reshape(-1, dim), np.frombuffer(s, np.int16), np.array(ids, np.int64)
            else:
                lists[p] = np.frombuffer(e, np.int32), np.frombuffer(s, np.int16)
        ends = np.cumsum(sizes, dtype=np.int64)
        wanted = max(least, -(-len(v) // share))
        q_ids, q = asked["id"].to_numpy(), _matrix(asked["v"].to_pylist(), dim)
        out = []
        for q_id, x, near in zip(q_ids.tolist(), q, closest(q, pivots, m).tolist()):
            gain = np.zeros(len(v), np.int32)
            for place, p in enumerate(near):
                if p in lists:
                    entries, places = lists[p]
                    gain[entries] += m - np.maximum(places, place)
            if wanted < len(v):
                some = np.flatnonzero(gain >= np.partition(gain, len(v) - wanted)[len(v) - wanted])
            else:
                some = np.arange(len(v))
            far = np.sqrt(((v[some] - x) ** 2).sum(1))
            times = sizes[some].astype(np.int64)
            row = np.repeat(np.arange(len(some)), times)
            at = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(ends[some] - times, times)
            ids, far = all_ids[at], far[row]
            other = ids != q_id
            ids, far = ids[other], far[other]
            best = np.lexsort((ids, far))
            best = best[np.sort(np.unique(ids[best], return_index=True)[1])[:k]]
            out.append((np.full(len(best), q_id), ids[best], far[best]))
        return pa.table(dict(zip(none, (pa.array(np.concatenate(c)) for c in zip(*out)))))

    return search


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
    near: int = NEAREST,
    share: int = SHARE,
    least: int = LEAST,
    shard: int = SHARD,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (distance) of each query's k nearest
    rows found.  Further columns are not read."""
    given = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    rows = written(usable(given.select("id", "vector")), "points")
    asked = written(usable(given.filter("asked").select("id", "vector")).distinct(), "asked")
    # the k + 1 smallest ids of each distinct vector; the window cuts before it shuffles
    first = Window.partitionBy("v").orderBy("id")
    few = rows.distinct().withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    points = written(few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "distinct-points")
    size, longest = points.agg(F.count("*"), F.max(F.octet_length("v"))).head()
    dim = max(1, (longest or 0) // 8)
    chosen = points.select("v").orderBy(F.xxhash64("v"), "v").limit(pivots).collect()  # at most ``pivots`` rows
    centres = _matrix([bytes(r["v"]) for r in chosen], dim)
    m = max(1, min(near, len(centres)))
    shards, groups = -(-size // shard) or 1, -(-asked.count() // QUERIES) or 1
    index = written(
        points.withColumn("shard", F.pmod(F.xxhash64("v", F.lit(1)), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInArrow(_post(centres, m, dim), "shard int, pivot int, entries binary, places binary, ids array<bigint>"),
        "inverted-files",
    )
    posted = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = asked.select(
        "id", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("part")
    )
    found = (
        posted.groupBy("shard", "part")
        .cogroup(dealt.groupBy("shard", "part"))
        .applyInArrow(_search(centres, m, dim, k, share, least), "query_id bigint, vec_id bigint, score double")
    )
    # an id that has several vectors may be met in several shards
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
