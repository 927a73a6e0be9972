"""Conversation repair, the permutation index and the document scan, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import conversations, lexical, permutation

# -- conversations -----------------------------------------------------------
CONV = "conv_id bigint, turn bigint, role string, text string, run string, cost int, present string, p int"
TEXTS = ["Hello.", "and then", "Yes!", "why?  \n", "", " \t", None, "So it is.\x0b", "no"]


def conversation_rows():
    pick = random.Random(3)
    rows = []
    for c in range(60):
        turn = pick.choice([0, 0, 5, -3])
        for _ in range(pick.randint(1, 9)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "uncle"])
            rows.append((c, None if pick.random() < 0.05 else turn, role, pick.choice(TEXTS)))
            turn += pick.choice([0, 1, 1, 1, 4])
    rows += [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (77, None, None, None), (78, 2**62, "user", "x " * 40_000 + ".")]
    rows += [(99, i, ("user", "assistant", "assistant")[i % 3], pick.choice(TEXTS[:3]) + str(i % 40)) for i in range(300)]
    return rows


def damage(rows):
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(hit, 1)):
            yield c, t, role, text


def cheapest(rows, faults):
    """(cost, audit, lines) by trying every edit in every state, from the end."""
    after = {"": ("user", "s"), "s": ("user",), "u": ("assistant",), "a": ("user",)}
    table = {}
    for i in range(len(rows), -1, -1):
        here = {s: ([(0, "", ())] if i == len(rows) and s in "a" else []) for s in after}
        if i < len(rows):
            role, text = rows[i][2:]
            more = 3 if faults[i] == "truncated" else 0
            for s, follow in after.items():
                cost, audit, lines = table[i + 1, s]
                here[s].append((4 + cost, "D" + audit, lines))
                if faults[i] in ("blank", "duplicate"):
                    continue
                if role[:1] in [r[:1] for r in follow]:
                    cost, audit, lines = table[i + 1, role[:1]]
                    here[s].append((more + cost, "K" + audit, (f"{role}:{text}", *lines)))
                for r in follow:
                    if r != "s":
                        cost, audit, lines = table[i + 1, r[0]]
                        here[s].append((3 + more + cost, "R" + audit, (f"{r}:{text}", *lines)))
        for _ in range(4):
            for s, follow in after.items():
                for r in follow:
                    if r != "s":
                        here[s] += [(3 + cost, "I" + audit, (f"{r}:", *lines)) for cost, audit, lines in here[r[0]][:]]
            here = {s: [min(x)] if x else [] for s, x in here.items()}
        table |= {(i, s): x[0] for s, x in here.items()}
    return table[0, ""]


def repaired(rows):
    blank = duplicate = truncated = illegal = 0
    faults, seen = [], set()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    for _, _, role, text in rows:
        rest = text.strip("\t\n\v\f\r ")
        faults.append("blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = {r[1] for r in rows} - {None}
    cost, audit, lines = cheapest(rows, faults)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    n = Counter(faults)
    return gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.mark.parametrize("run_bytes", [4 << 20, 6_000, 150])
def test_repair(spark, run_bytes):
    rows = conversation_rows()
    frame = spark.createDataFrame([(*r, "clash", 1, "no", 2) for r in rows], CONV).repartition(3)
    pieces = conversations.repair(conversations.damaged(frame), F.col("present"), run_bytes).persist()
    if run_bytes == 150:
        assert pieces.filter("conv_id = 99").count() > 20  # one conversation in many pieces
    got = {r.conv_id: tuple(r)[1:] for r in conversations.summary(pieces).collect()}
    by_conv = defaultdict(list)
    for r in damage(rows):
        by_conv[r[0]].append(r)
    assert got == {c: repaired(by_conv[c]) for c in {r[0] for r in rows}}
    # the repaired rows are what the digests are made of, and read s?(ua)+
    texts = defaultdict(list)
    for r in conversations.rows_of(pieces).orderBy("conv_id", "place").collect():
        texts[r.conv_id].append((r.role, r.text))
    for c, lines in texts.items():
        assert re.fullmatch("s?(ua)+", "".join(role[0] for role, _ in lines))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest() == got[c][-1]


def test_repair_of_undamaged_rows_and_of_none(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "u."), (1, 2, "assistant", "a."), (2, 0, "user", "u.")]
    frame = spark.createDataFrame([(*r, "", 0, "", 0) for r in rows], CONV)
    out = {r.conv_id: r for r in conversations.summary(conversations.repair(frame)).collect()}
    assert (out[1].cost, out[1].audit) == (0, "KKK")
    assert (out[2].cost, out[2].audit) == (3, "KI")
    assert conversations.summary(conversations.repair(frame.limit(0))).count() == 0
    assert conversations.summary(conversations.repair(conversations.damaged(frame.limit(0)), F.col("present"))).count() == 0


def test_costs_are_remade_block_by_block():
    kinds = [random.Random(5).choice(["u-", "a-", "sT", "uD", "?-", "aT"]) for _ in range(50)]
    block, kept = conversations.checkpoints(kinds, conversations.END)
    assert block == 7 and len(kept) == 9  # a vector per block and the end's
    v = conversations.END
    for i in range(49, -1, -1):
        v = conversations.costs(kinds[i], v)
        if i % block == 0:
            assert kept[i // block] == v


# -- permutation index ---------------------------------------------------------
VEC = "vec_id bigint, embedding array<float>, id string, v int, shard string, rank int"


def vector_rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24)) * 2
    x = (centres[rng.integers(0, 12, 4_000)] + rng.normal(size=(4_000, 24))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(10_000 + i, x[7].tolist()) for i in range(3_000)]  # one vector under many ids
    rows += [(20_000, None), (20_001, [None] * 24), (20_100, [float("nan")] * 24), (20_200, [0.0] * 24), (20_300, []), (None, x[3].tolist())]
    rows += [(20_400, x[5].tolist()[:20]), (20_500, [0.0, -0.0, 1.0]), (20_501, [float("inf")] * 24), (42, x[42].tolist())]
    return rows


def exact(rows, k=10):
    x = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            x[i] = np.array([*v, *[0.0] * (24 - len(v))], np.float32).astype(float)
    ids = np.array(sorted(x))
    m = np.stack([x[i] for i in ids.tolist()])
    out = {}
    for i in ids.tolist():
        if i % 100 == 0:
            far = np.sqrt(((m - x[i]) ** 2).sum(1))
            far[ids == i] = np.inf
            best = [b for b in np.lexsort((ids, far)) if ids[b] != i][:k]
            out[i] = [(int(ids[b]), float(far[b])) for b in best]
    return out


def found(frame, **options):
    out = defaultdict(list)
    for r in permutation.nearest(frame, F.col("vec_id") % 100 == 0, **options).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_nearest_is_exact_where_all_are_candidates(spark):
    rows = vector_rows()
    frame = spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in rows], VEC).repartition(3)
    want = exact(rows)
    assert found(frame, least=10_000, shard=900) == want
    few = [r for r in rows if r[0] in (0, 1, 2, 20_200)]
    got = found(spark.createDataFrame([(*r, "", 1, "", 2) for r in few], VEC))
    assert got == exact(few) and len(got[0]) == 2
    assert not found(frame.limit(0)) and not found(frame.filter("vec_id > 20000 AND vec_id < 20400"))


def test_recall_of_the_index(spark):
    rows = vector_rows()
    frame = spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in rows], VEC).repartition(3)
    want = exact(rows)
    got = found(frame, pivots=128, near=32, least=50, shard=900)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    assert hits / sum(map(len, want.values())) >= 0.9
    far = {(q, i): d for q, w in want.items() for i, d in w}
    assert all(d == far[q, i] for q, g in got.items() for i, d in g if (q, i) in far)
    # a vector that many ids share: the smallest of them, not all candidates
    assert [i for i, _ in got[10_000]][:2] == [7, 10_001]


# -- lexical search --------------------------------------------------------------
ITEM = "item_id bigint, text string, doc_id string, score string"
DOC = "doc_id bigint, text string, item_id string, n string, part int, sums string"


def words(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def search_rows():
    pick = random.Random(9)
    names = [f"w{i}" for i in range(120)] + ["the", "a", "of", "été", "한국어", "İx", "ΑΣ", "ﬁ", "½"]
    weights = [1] * 120 + [60, 50, 40] + [3] * 6
    docs = [(i, " ".join(pick.choices(names, weights, k=pick.randint(1, 60)))) for i in range(300)]
    docs += [(i, docs[5][1]) for i in range(400, 430)]  # equal scores
    docs += [(500, None), (501, ""), (502, "-- \n;"), (503, "the-The_THE.the's ÉTÉ été"), (5, "w1 w1 twice"), (None, "w1 w2 w3 no id")]
    docs += [(504, " ".join(pick.choices(names, weights, k=30_000)))]
    items = [(i, " ".join(pick.choices(names, weights, k=8))) for i in range(40)]
    items += [(50, None), (51, ""), (52, "unseen"), (53, "The the THE été"), (54, docs[5][1]), (None, "w1 w2")]
    return docs, items


def ranked(docs, items, k=10):
    bags = [(i, Counter(words(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = {}
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 100 - 90 + (90 * sum(b.values()) * n_docs) // length
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in set(words(text)) if b[t]
            )
            if s > 0:
                scores.append((-s, i is None, i or 0))
        if scores:
            out[item] = [(None if none else i, -s) for s, none, i in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("block_items", [4096, 7])
def test_search(spark, monkeypatch, block_items):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", block_items)
    docs, items = search_rows()
    d = spark.createDataFrame([(*r, "clash", "clash", 1, "") for r in docs], DOC).repartition(5)
    i = spark.createDataFrame([(*r, "clash", "clash") for r in items], ITEM)
    got = defaultdict(list)
    for r in lexical.search(d, i).orderBy("item_id", "rank").collect():
        assert r["rank"] == len(got[r.item_id]) + 1
        got[r.item_id].append((r.doc_id, r.score))
    assert got == ranked(docs, items)
    assert lexical.search(d.limit(0), i).count() == 0
    assert lexical.search(d, i.limit(0)).count() == 0
    assert lexical.search(d.filter("doc_id > 499 AND doc_id < 503"), i).count() == 0
