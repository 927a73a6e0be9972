"""Exact search for the largest inner products, over norm-sorted vectors.

Vectors are cut into parts by descending length (Euclidean norm), and a basis
in which most of the inner product sits in the first coordinates is found from
the matrix of second moments (its eigenvectors are the right singular vectors
of the data).  A query goes through a part from the longest vector down and
stops where length times length can no longer reach its k-th best score.  Of
the rest, the product over the first rotated coordinates plus the
Cauchy-Schwarz bound of what remains decides which vectors are scored exactly,
in integers.  Every query first meets the longest vectors of all, so each part
starts with a threshold.

Queries are taken in groups and vectors in parts of fixed size; each pair of a
group and a part is one unit of work, so neither a common vector nor a large
table makes a task large.  Scores are 64-bit integers.  Ties go to the smaller
id.  NULL vectors and vectors with NULL or non-finite components take no part, nor
do rows without an id; missing trailing components count as 0.  Rows that share
an id are vectors of their own; a query skips all rows of its id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.common import give_back, pack, unpack, written

PART, QUERIES, STEP = 16_384, 4_096, 1_024
# queries that meet a block of STEP vectors at a time, and components scored at a time
SLICE, CELLS = 512, 1 << 21


def quantised(rows: DataFrame, scale: int) -> DataFrame:
    """id, v (integers as bytes), norm of every row that takes part."""

    def quantise(batches):
        for batch in batches:
            ids, vectors = batch.column("id"), batch.column("vector")
            sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = vectors.flatten()
            # NULL components become NaN, which is not finite
            x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            ok = vectors.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
            ok &= bad[ends] == bad[ends - sizes]
            with np.errstate(invalid="ignore", over="ignore"):
                v = np.clip(np.floor(scale * np.where(np.isfinite(x), x, 0.0)), -(2.0**62), 2.0**62).astype(np.int64)
            k = np.flatnonzero(ok)
            own = [v[e - s : e] for s, e in zip(sizes[k].tolist(), ends[k].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(k)).cast(pa.int64()),
                    pa.array([o.tobytes() for o in own], pa.binary()),
                    pa.array([float(np.sqrt((o.astype(float) ** 2).sum())) for o in own], pa.float64()),
                    pa.array(sizes[k], pa.int32()),
                ],
                names=["id", "v", "norm", "dim"],
            )

    return rows.mapInArrow(quantise, "id bigint, v binary, norm double, dim int")


def _matrix(values: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(values), dim), np.int64)
    for i, b in enumerate(values):
        out[i, : len(b) // 8] = np.frombuffer(b, np.int64)
    return out


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Orthonormal basis, most weight first, from the summed second moments.
    Tasks sum what they read, then 32 groups sum the tasks' sums."""

    def moments(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            m = _matrix(batch.column("v").to_pylist(), dim).astype(float)
            total += m.T @ m
        task = TaskContext.get().partitionId() % 32
        yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["g", "m"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b) for b in table["m"].to_pylist())
        return pa.table({"m": pa.array([total.tobytes()], pa.binary())})

    sums = rows.select("v").mapInArrow(moments, "g int, m binary").groupBy("g").applyInArrow(add, "m binary")
    total = sum((np.frombuffer(r["m"]) for r in sums.toLocalIterator()), np.zeros(dim * dim)).reshape(dim, dim)
    return np.linalg.eigh(total)[1][:, ::-1].copy()


def _packed(size: int):
    """Rows packed in their order, up to ``size`` to a value, with a number that
    holds the partition and the place in it."""

    def rows(batches):
        base, held = TaskContext.get().partitionId() << 32, []

        def out(table, i):
            return pa.RecordBatch.from_arrays([pa.array([base + i], pa.int64()), pa.array([pack(table)], pa.binary())], names=["number", "value"])

        n = i = 0
        for batch in batches:
            while batch.num_rows:
                take = min(size - n, batch.num_rows)
                held.append(batch.slice(0, take))
                batch, n = batch.slice(take), n + take
                if n == size:
                    yield out(pa.Table.from_batches(held), i)
                    held, n, i = [], 0, i + 1
        if held:
            yield out(pa.Table.from_batches(held), i)

    return rows


def _scores(q: np.ndarray, v: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``i`` of ``q`` and ``j`` of ``v``.  Most pairs of a block
    may ask for one, so their components are copied a few at a time."""
    score, n = np.empty(len(i), np.int64), max(1, CELLS // max(1, q.shape[1]))
    for at in range(0, len(i), n):
        score[at : at + n] = np.einsum("ij,ij->i", q[i[at : at + n]], v[j[at : at + n]])
    return score


def _dealt(n: int) -> Column:
    """Place among ``n`` of what :func:`_packed` has numbered: a partition's first value has
    the partition's own, a further one the next."""
    number = F.col("number")
    return F.pmod(F.shiftright(number, 32) + number.bitwiseAND(F.lit((1 << 32) - 1)), F.lit(n)).cast("int")


def _search(dim: int, basis: np.ndarray, k: int):
    head = max(1, dim // 4)

    def search(table: pa.Table) -> pa.Table:
        values = [unpack(b) for b in table["value"].to_pylist()]
        asked = [t for t in values if "floor" in t.column_names]
        # parts from the longest vectors on
        parts = sorted((t for t in values if "floor" not in t.column_names), key=lambda t: -t["norm"][0].as_py())
        if not asked:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
        queries = pa.concat_tables(asked)
        q_id, q = queries["id"].to_numpy(), _matrix(queries["v"].to_pylist(), dim)
        floor = queries["floor"].to_numpy().astype(float)
        q_norm = np.sqrt((q.astype(float) ** 2).sum(1))
        q_head = q @ basis[:, :head]
        q_rest = np.sqrt(np.maximum(q_norm**2 - (q_head**2).sum(1), 0))
        best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))  # query, score, id
        for part in parts:
            c_id, c = part["id"].to_numpy(), _matrix(part["v"].to_pylist(), dim)
            c_norm = part["norm"].to_numpy()
            for at in range(0, len(c_id), STEP):
                ids, v, norm = c_id[at : at + STEP], c[at : at + STEP], c_norm[at : at + STEP]
                slack = 1e-9 * q_norm * norm[0] + 1e-6
                live = np.flatnonzero(q_norm * norm[0] + slack >= floor)  # the block's longest comes first
                if not len(live):
                    break
                v_head = v @ basis[:, :head]
                v_rest = np.sqrt(np.maximum(norm**2 - (v_head**2).sum(1), 0))
                for some in np.array_split(live, -(-len(live) // SLICE)):
                    bound = q_head[some] @ v_head.T
                    bound += q_rest[some][:, None] * v_rest[None, :]
                    bound += slack[some][:, None]
                    i, j = np.nonzero((bound >= floor[some][:, None]) & (q_id[some][:, None] != ids[None, :]))
                    i = some[i]
                    score = _scores(q, v, i, j)
                    at_least = score >= floor[i]
                    best = tuple(np.concatenate([b, n[at_least]]) for b, n in zip(best, (i, score, ids[j])))
                    order = np.lexsort((best[2], -best[1], best[0]))
                    best = tuple(b[order] for b in best)
                    first = np.searchsorted(best[0], best[0])
                    rank = np.arange(len(first)) - first
                    keep = rank < k
                    kth = best[0][rank == k - 1]
                    floor[kth] = np.maximum(floor[kth], best[1][rank == k - 1])
                    best = tuple(b[keep] for b in best)
        found = pa.table({"query_id": q_id[best[0]], "vec_id": best[2], "score": best[1]})
        give_back()
        return found

    return search


def _floors(seeds: list, dim: int, k: int):
    """Each query with its k-th best score among the longest vectors, which its
    k-th best of all can't be below."""
    ids = np.array([r["id"] for r in seeds], np.int64)
    v = _matrix([bytes(r["v"]) for r in seeds], dim)

    def floors(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                score = _matrix(some.column("v").to_pylist(), dim) @ v.T
                own = some.column("id").to_numpy()[:, None] == ids[None, :]
                score = np.sort(np.where(own, np.iinfo(np.int64).min, score), 1)[:, ::-1]
                floor = score[:, k - 1] if score.shape[1] >= k else np.full(len(score), np.iinfo(np.int64).min)
                yield pa.RecordBatch.from_arrays([some.column("id"), some.column("v"), pa.array(floor)], names=["id", "v", "floor"])

    return floors


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best rows."""
    given = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("_q"))
    rows = written(quantised(given.select("id", "vector"), scale), "vectors")
    asked = written(quantised(given.filter("_q").select("id", "vector"), scale), "queries")
    size, dim = rows.agg(F.count("*"), F.max("dim")).head()
    dim = max(1, dim or 0)
    parts, groups = -(-size // PART) or 1, -(-asked.count() // QUERIES) or 1
    longest = rows.orderBy(F.desc("norm"), "id").limit(STEP).collect()  # STEP vectors, whatever the size
    c = (
        rows.repartitionByRange(parts, F.desc("norm"), "id")
        .sortWithinPartitions(F.desc("norm"), "id")
        .select("id", "v", "norm")
        .mapInArrow(_packed(PART), "number bigint, value binary")
        .select(
            _dealt(parts).alias("part"),
            F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
            "value",
        )
    )
    q = (
        asked.select("id", "v")
        .mapInArrow(_floors(longest, dim, k), "id bigint, v binary, floor bigint")
        .repartition(groups, "id")
        .mapInArrow(_packed(QUERIES), "number bigint, value binary")
        .select(
            F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
            _dealt(groups).alias("group"),
            "value",
        )
    )
    found = c.unionByName(q).groupBy("part", "group").applyInArrow(
        _search(dim, rotation(rows, dim), k), "query_id bigint, vec_id bigint, score bigint"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
