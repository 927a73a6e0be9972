"""Repair of conversation structure by the cheapest edits.

A conversation should read s?(ua)+ by the initials of its roles (system, user,
assistant), or be empty.  Rows, in the order of their turns, are kept (cost 0),
given the role user or assistant (3) or deleted (4); a row of role user or assistant
without text may be inserted anywhere (3).  Blank rows and repeats of an earlier row
must be deleted; a truncated row that stays costs 3 more.  Of all cheapest edits
those whose initials D, I, K, R in order are ASCII-least are taken.

The cost to finish from a row on depends on the state of the pattern alone: after
nothing, s, u or a.  So a backward pass yields one vector of four costs per row.  Only
every sqrt(n)-th vector is kept; the forward pass makes those of one block anew
from the vector at its end, and picks in each row the least letter that keeps the
cost.

Rows are sorted into runs of bounded bytes.  A conversation inside a run is repaired
there and then.  One that crosses into another run is cut into pieces, however many
rows it has; what a piece does to the costs is a matrix of four by four (min, +).
From the matrices follow the vectors at the pieces' ends, from these the state that
each piece is left in for each state it may be entered in, and from that chain the
edits of every piece.  No task holds more than a run, but for the slim facts of one
conversation's pieces.

A NULL role or text is read as one blank, a NULL turn comes first, and NULL is a
conversation id like others.  Equal turns are ordered by role, then text, so equal
rows alone tie.  Texts of any length are kept whole.  Columns other than those named
are not read, so their names do not matter.  An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import text_bytes, worker_cache, written

# Costs of the edits, and the blanks of a text.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = "\t\n\v\f\r "

RUN_BYTES = 4 << 20
FAR = 1 << 60  # no way
Vector = tuple[int, int, int, int]

# States: nothing yet, after s, after u, after a.  The role due next leads on; a
# kept row leads where its initial may follow.
ON = (2, 2, 3, 2)
DUE = ("user", "user", "assistant", "user")
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
END: Vector = (0, 2 * INSERT, INSERT, 0)

# What of a row counts for its edits, its kind: its initial (s, u, a or ?), then D if
# it must go, T if it is truncated, or a dash.


def _before(kind: str, after: Vector) -> Vector:
    """Costs from a row on, given those from the next row on."""
    own = [DELETE + c for c in after]
    if kind[1] != "D":
        more = TRUNCATED if kind[1] == "T" else 0
        for s in range(4):
            own[s] = min(own[s], REROLE + more + after[ON[s]])
            if s in KEPT.get(kind[0], ()):
                own[s] = min(own[s], more + after[KEPT[kind[0]][s]])
    # after two inserted rows a third leads nowhere new
    return tuple(min(own[s], INSERT + own[ON[s]], 2 * INSERT + own[ON[ON[s]]]) for s in range(4))


def costs(kind: str, after: Vector) -> Vector:
    """Costs from a row on; by differences to the least, of which there are few."""
    known = worker_cache("edit costs", dict)
    least = min(after)
    key = (kind, *(min(c - least, FAR) for c in after))
    if key not in known:
        known[key] = _before(kind, key[1:])
    return tuple(c + least for c in known[key])


def matrix(kinds: list[str]) -> list[Vector]:
    """Costs of getting through the rows from each state to each state."""
    columns = []
    for t in range(4):
        v = tuple(0 if s == t else FAR for s in range(4))
        for kind in reversed(kinds):
            v = costs(kind, v)
        columns.append(v)
    return list(zip(*columns))


def checkpoints(kinds: list[str], end: Vector) -> tuple[int, list[Vector]]:
    """Rows per block, and the costs from the start of every block on."""
    block = max(1, int(np.sqrt(len(kinds))))
    kept, v = [end], end
    for i in range(len(kinds) - 1, -1, -1):
        v = costs(kinds[i], v)
        if i % block == 0:
            kept.append(v)
    return block, kept[::-1]


def walk(kinds: list[str], end: Vector, state: int = 0, last: bool = True) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits, and the state they lead to."""
    block, kept = checkpoints(kinds, end)
    edits = []
    for b, start in enumerate(range(0, len(kinds), block)):
        rows = kinds[start : start + block]
        vectors = [kept[b + 1]]
        for kind in reversed(rows):
            vectors.append(costs(kind, vectors[-1]))
        vectors.reverse()
        for kind, here, after in zip(rows, vectors, vectors[1:]):
            while True:
                if here[state] == DELETE + after[state]:
                    edits.append("D")
                elif here[state] == INSERT + here[ON[state]]:
                    edits.append("I")
                    state = ON[state]
                    continue
                else:
                    to = KEPT.get(kind[0], {}).get(state) if kind[1] != "D" else None
                    more = TRUNCATED if kind[1] == "T" else 0
                    keep = to is not None and here[state] == more + after[to]
                    edits.append("K" if keep else "R")
                    state = to if keep else ON[state]
                break
    while last and END[state]:
        edits.append("I")
        state = ON[state]
    return "".join(edits), state


def apply(edits: str, state: int, roles: list[str], texts: list[str]) -> list[dict[str, str]]:
    """The rows that edits make of a conversation's rows, entered in a state."""
    out, i = [], 0
    for e in edits:
        if e == "I":
            out.append({"role": DUE[state], "text": ""})
            state = ON[state]
            continue
        if e == "K":
            out.append({"role": roles[i], "text": texts[i]})
            state = KEPT[roles[i][0]][state]
        elif e == "R":
            out.append({"role": DUE[state], "text": texts[i]})
            state = ON[state]
        i += 1
    return out


ROWS = "array<struct<role:string,text:string>>"
FACTS = "n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, least bigint, most bigint, turns bigint"
PIECE = f"conv_id bigint, run int, k int, whole boolean, {FACTS}, costs array<bigint>, cost bigint, kinds string, audit string, content {ROWS}"
LEGAL = {"su", "ua", "au"}


def facts(kinds: list[str], faults: list[str], roles: list[str], turns: list[int | None]) -> dict:
    """Counts of a piece, and what its neighbours need to add theirs."""
    initials = [r[:1] for r in roles]
    known = [t for t in turns if t is not None]
    return {
        "n": len(kinds),
        "blank": faults.count("B"),
        "duplicate": faults.count("D"),
        "truncated": faults.count("T"),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first": initials[0] if initials else None,
        "last": initials[-1] if initials else None,
        "least": min(known, default=None),
        "most": max(known, default=None),
        "turns": len(set(known)),
    }


def _pieces(batches: Iterator[pa.RecordBatch], run_bytes: int) -> Iterator[pa.RecordBatch]:
    """A run's rows, in order, as pieces.  Only the first and the last conversation
    of a run may go on in another one."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("run", pa.int32()), ("k", pa.int32()), ("whole", pa.bool_())]
        + [(c, pa.int64()) for c in ("n", "blank", "duplicate", "truncated", "illegal")]
        + [("first", pa.string()), ("last", pa.string())]
        + [(c, pa.int64()) for c in ("least", "most", "turns")]
        + [("costs", pa.list_(pa.int64())), ("cost", pa.int64()), ("kinds", pa.string()), ("audit", pa.string())]
        + [("content", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))]
    )
    run, k, size = TaskContext.get().partitionId(), 0, 0
    now: list[tuple] = []
    key, begun, cut = None, False, True  # of the conversation at hand; cut: it is not whole

    def piece(whole: bool) -> dict:
        turns, roles, texts, faults = ([r[i] for r in now] for i in range(4))
        kinds = [(r[0] if r[:1] in ("s", "u", "a") else "?") + {"B": "D", "D": "D", "T": "T"}.get(f, "-") for r, f in zip(roles, faults)]
        out = {"conv_id": key, "run": run, "k": k, "whole": whole, **facts(kinds, faults, roles, turns)}
        if whole:
            edits, _ = walk(kinds, END)
            v = END
            for kind in reversed(kinds):
                v = costs(kind, v)
            return {**out, "cost": v[0], "audit": edits, "content": apply(edits, 0, roles, texts)}
        content = [{"role": r, "text": t} for r, t in zip(roles, texts)]
        return {**out, "costs": [c for row in matrix(kinds) for c in row], "kinds": "".join(kinds), "content": content}

    held: list[dict] = []
    held_bytes = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "present", "turn", "role", "text", "fault")]
        for conv, present, *row in zip(*columns):
            if not begun or conv != key or size > run_bytes:
                if begun:
                    same = conv == key
                    held.append(piece(whole=not cut and not same))
                    held_bytes += size
                    k += 1
                    cut = same
                else:
                    cut = True  # it may have begun in the run before
                key, begun, now, size = conv, True, [], 0
                if held_bytes > run_bytes:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held, held_bytes = [], 0
            if present:
                now.append(tuple(row))
                size += len(row[2]) + 64
    if begun:
        held.append(piece(whole=False))
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def faulty(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present, fault (B, D, T or none, the first that holds)
    and uid of every row.  A row is a repeat unless it is the first of its role and
    text in its conversation; the first is an aggregate, joined back on keys that are
    nearly unique, so a large conversation stays spread."""
    trimmed = F.btrim("text", F.lit(BLANKS))
    alike = F.struct("role", F.sha2("text", 256).alias("digest"))
    place = F.struct(F.col("turn").isNotNull().alias("a"), F.coalesce("turn", F.lit(0)).alias("b"), "uid")
    marked = rows.withColumn("alike", alike).withColumn("place", place)
    first = (
        marked.filter("present").groupBy(F.col("conv_id").alias("c"), F.col("alike").alias("a")).agg(F.min("place").alias("p"))
    )
    on = marked["conv_id"].eqNullSafe(first["c"]) & (marked["alike"] == first["a"]) & (marked["place"] == first["p"]) & marked["present"]
    fault = (
        F.when(trimmed == "", "B").when(F.col("p").isNull(), "D").when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "T")
    )
    return marked.join(first, on, "left").select("conv_id", "turn", "role", "text", "present", fault.alias("fault"), "uid")


def repair(rows: DataFrame, present: Column | None = None, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Pieces of repaired conversations: conv_id, run and k (their order), facts, cost (of
    the whole conversation), audit (the edits) and content (rows role, text).  A conversation
    is one piece if ``whole``.  Rows where ``present`` is false are no part of a
    conversation, they only name it."""
    blank = F.lit(" ")
    given = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
        F.monotonically_increasing_id().alias("uid"),  # written below, so it stays
    )
    given = written(given, "conversations")
    runs = max(1, -(-text_bytes(given) // run_bytes))
    order = ("conv_id", "turn", "role", "text", "uid")
    pieces = written(
        faulty(given).repartitionByRange(runs, *order).sortWithinPartitions(*order).mapInArrow(lambda b: _pieces(b, run_bytes), PIECE), "conversation-pieces"
    )
    whole = pieces.filter("whole")
    parts = pieces.filter("NOT whole")
    slim = written(parts.groupBy("conv_id").applyInArrow(_ends, "run int, k int, end array<bigint>, last boolean, cost bigint"), "piece-ends")
    on = ["run", "k"]
    ways = parts.select("conv_id", *on, "kinds").join(slim, on).mapInArrow(_ways, WAYS)
    edits = ways.groupBy("conv_id").applyInArrow(_chain, "run int, k int, entry int, edits string")
    joined = parts.drop("cost", "audit").join(slim.select(*on, "cost"), on).join(written(edits, "piece-edits"), on)
    edited = joined.mapInArrow(_edit, f"conv_id bigint, run int, k int, whole boolean, {FACTS}, cost bigint, audit string, content {ROWS}")
    return whole.select(edited.columns).unionByName(written(edited, "edited-pieces"))


def _ends(table: pa.Table) -> pa.Table:
    """Of one conversation's pieces: the costs at the end of each, and of all."""
    table = table.select(["run", "k", "costs"]).sort_by([("run", "ascending"), ("k", "ascending")])
    ends, v = [], END
    for m in reversed(table["costs"].to_pylist()):
        ends.append(v)
        v = tuple(min(m[4 * s + t] + v[t] for t in range(4)) for s in range(4))
    n = len(ends)
    return pa.table(
        {
            "run": table["run"],
            "k": table["k"],
            "end": pa.array([list(e) for e in reversed(ends)], pa.list_(pa.int64())),
            "last": pa.array([i == n - 1 for i in range(n)]),
            "cost": pa.array([v[0]] * n, pa.int64()),
        }
    )


WAYS = "conv_id bigint, run int, k int, exits array<int>, edits array<string>"


def _kinds(text: str) -> list[str]:
    return [text[i : i + 2] for i in range(0, len(text), 2)]


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of a piece for each state it may be entered in."""
    for batch in batches:
        ways = [
            [walk(_kinds(kinds), tuple(end), s, last) for s in range(4)]
            for kinds, end, last in zip(*(batch.column(c).to_pylist() for c in ("kinds", "end", "last")))
        ]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("conv_id", "run", "k")),
                pa.array([[s for _, s in w] for w in ways], pa.list_(pa.int32())),
                pa.array([[e for e, _ in w] for w in ways], pa.list_(pa.string())),
            ],
            names=["conv_id", "run", "k", "exits", "edits"],
        )


def _chain(table: pa.Table) -> pa.Table:
    """The state in which each piece of a conversation is entered, and its edits."""
    table = table.sort_by([("run", "ascending"), ("k", "ascending")])
    state, entries, edits = 0, [], []
    for exits, ways in zip(table["exits"].to_pylist(), table["edits"].to_pylist()):
        entries.append(state)
        edits.append(ways[state])
        state = exits[state]
    return pa.table({"run": table["run"], "k": table["k"], "entry": pa.array(entries, pa.int32()), "edits": pa.array(edits, pa.string())})


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces after their edits."""
    for batch in batches:
        for i in range(batch.num_rows):  # a piece may be as large as a run
            row = batch.slice(i, 1)
            (entry,), (edits,), (content,) = (row.column(c).to_pylist() for c in ("entry", "edits", "content"))
            new = apply(edits, entry, [r["role"] for r in content], [r["text"] for r in content])
            keep = ["conv_id", "run", "k", "whole", "n", "blank", "duplicate", "truncated", "illegal", "first", "last", "least", "most", "turns", "cost"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(row.column(c) for c in keep),
                    pa.array([edits], pa.string()),
                    pa.array([new], pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                ],
                names=[*keep, "audit", "content"],
            )


def rows_of(pieces: DataFrame) -> DataFrame:
    """conv_id, place (order within the conversation: run, k, i), role and text of repaired rows."""
    return pieces.select("conv_id", "run", "k", F.posexplode("content").alias("i", "row")).select(
        "conv_id", F.struct("run", "k", "i").alias("place"), "row.role", "row.text"
    )


SUMMARY = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def summary(pieces: DataFrame) -> DataFrame:
    """One row per conversation.  Those in one piece are summed up where they are, the
    others streamed in order: a digest takes its text in order, but holds none of it."""
    body = F.array_join(F.transform("content", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0))
    one = pieces.filter("whole").select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(body, 256).alias("repaired_sha256")
    )
    order = ("conv_id", "run", "k")
    many = pieces.filter("NOT whole").drop("whole").repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_sum_up, SUMMARY)
    return one.unionByName(many)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    )
    total: dict = {}

    def done() -> pa.RecordBatch:
        row = {c: total[c] for c in ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")}
        gaps = total["most"] - total["least"] + 1 - total["turns"] if total["turns"] else 0
        row |= {"gaps": gaps, "audit": "".join(total["audit"]), "repaired_sha256": total["hash"].hexdigest()}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for i in range(batch.num_rows):
            (p,) = batch.slice(i, 1).to_pylist()
            if not total or total["conv_id"] != p["conv_id"]:
                if total:
                    yield done()
                total = {"conv_id": p["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0}
                total |= {"least": None, "most": None, "end": None, "audit": [], "hash": hashlib.sha256(), "any": False, "cost": p["cost"]}
            for c in ("blank", "duplicate", "truncated", "illegal"):
                total[c] += p[c]
            if p["n"]:
                if total["end"] is not None and total["end"] + p["first"] not in LEGAL:
                    total["illegal"] += 1
                total["end"] = p["last"]
            if p["turns"]:
                # turns ascend, so only the one at the border can be in both
                total["turns"] += p["turns"] - (total["most"] == p["least"])
                total["least"] = p["least"] if total["least"] is None else total["least"]
                total["most"] = p["most"]
            total["audit"].append(p["audit"])
            for r in p["content"]:
                total["hash"].update(("\n" if total["any"] else "").encode() + f"{r['role']}:{r['text']}".encode())
                total["any"] = True
    if total:
        yield done()


def damaged(rows: DataFrame) -> DataFrame:
    """The damage that the query repairs, by crc32 of ``conv_id:turn`` modulo 20: 0
    drops the row (it stays with ``present`` false), 1 empties its text, 2 removes
    its full stops, exclamation and question marks, 3 repeats it, 4 makes its role
    user.  A NULL anywhere is one blank first."""
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    hit = F.crc32(key) % 20
    text = F.coalesce("text", blank)
    new = rows.select(
        "conv_id",
        "turn",
        F.when(hit == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (hit != 0).alias("present"),
        F.when(hit == 3, 2).otherwise(1).alias("times"),
    )
    return new.select("conv_id", "turn", "role", "text", "present", F.explode(F.sequence(F.lit(1), "times"))).drop("col")
