"""Every text operator on awkward rows, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import bpe, line_dedup, lm, minhash, orc_ids, packing, quality, substring_dedup, topk, toxicity
from tallybrook.llm.queries import tokenizer
from tallybrook.llm.tokens import Encoder

random.seed(7)
VOCABULARY = [f"w{i}" for i in range(300)]


def prose(n):
    return " ".join(random.choices(VOCABULARY, k=n))


SHARED = prose(60)
ROWS = [
    (1, prose(80)),
    (2, f"{prose(30)} {SHARED}\n{prose(20)}"),
    (3, f"{SHARED} {prose(10)}"),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "one"),
    (8, " ".join(["same"] * 90)),
    (9, f"{prose(5)}\na b\nc d\ne f\ng h\n{prose(5)}"),
    (10, f"x\na b\nc d\ne f\ng h\ny"),
    (11, prose(6000)),
    (12, "naïve　Ünïcode İstanbul ΑΣ 한국어 😀😀 <|endoftext|> '́ ½\x0bz\x1cq"),
    (13, f"{prose(30)} {SHARED}"),
    (13, "a second row of this id " + SHARED),
    (None, f"no id {SHARED}"),
]
ROWS += [(20, ROWS[0][1]), (21, ROWS[0][1]), (21, ROWS[0][1])]
near = ROWS[0][1].split()
near[40] = "changed"
ROWS.append((22, " ".join(near)))
SCHEMA = "doc_id bigint, text string, lang string, n_words string, kept string, severity int, _n2 int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "clash", "clash", 3, None) for i, t in ROWS], SCHEMA).repartition(5, "doc_id")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ordered():
    return sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_substrings(docs, empty):
    seen, want = set(), []
    rows = ordered()
    for k, (i, t) in enumerate(rows):
        w = words(t)
        stay = [True] * len(w)
        new = set()
        for a in range(len(w) - 19):
            x = tuple(w[a : a + 20])
            if x in seen or x in new:
                stay[a : a + 20] = [False] * 20
            new.add(x)
        seen |= new
        want.append((i, len(w), len(w) - sum(stay), " ".join(x for x, s in zip(w, stay) if s)))
    out = substring_dedup.remove_repeats(docs)
    assert set(docs.columns) <= set(out.columns)
    got = [tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept_words").collect()]
    assert Counter(got) == Counter(want)
    assert all(words(r.text) == words(r.kept_words) for r in out.collect())
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_rolling_hash_depends_on_the_window_alone():
    x = np.random.default_rng(1).integers(0, 2**63, 200).astype(np.uint64)
    x[100:140] = x[20:60]
    for width in (1, 5, 20, 33):
        h = substring_dedup.rolling(x, width, substring_dedup.BASE)
        assert len(h) == 201 - width
        assert (h[20 : 61 - width] == h[100 : 141 - width]).all()
        assert len(set(h.tolist())) == len(h) - (41 - width)


def test_lines(docs, empty):
    seen, want = set(), []
    for i, t in ordered():
        lines = (t or "").encode().split(b"\n") if t else []
        kept, gone = [], 0
        for a, b in line_dedup.chunks(lines, 3, 2, 64):
            body = b"\n".join(lines[a:b])
            if b - a > 1 and body in seen:
                gone += b - a
            else:
                kept += lines[a:b]
            if b - a > 1 and body.strip():
                seen.add(body)
        want.append((i, len(lines), gone, b"\n".join(kept).decode() if t else t))
    out = line_dedup.remove_repeated_lines(docs)
    got = [tuple(r) for r in out.select("doc_id", "n_lines", "n_removed_lines", "text").collect()]
    assert Counter(got) == Counter(want)
    assert line_dedup.remove_repeated_lines(empty).count() == 0


def test_chunks_agree_after_an_insertion():
    lines = [str(random.random()).encode() for _ in range(200)]
    rule = (3, 2, 64)
    ends = {lines[b - 1] for _, b in line_dedup.chunks(lines, *rule)}
    moved = {([b"new"] + lines)[b - 1] for _, b in line_dedup.chunks([b"new"] + lines, *rule)}
    assert len(ends - moved) <= 3


def shingle_bag(text):
    w = words(text)
    k = min(5, len(w))
    return Counter(tuple(w[a : a + k]) for a in range(len(w) - k + 1)) if w else Counter()


def test_near_copies(docs, empty):
    out = minhash.near_copies(docs).collect()
    assert len(out) == len(ROWS)
    group = {}
    for r in out:
        group.setdefault(r.class_id, []).append(r)
    assert sum(r.kept for r in out) == len(group) + sum(1 for i in (4, 5, 6) if False)
    assert {r.doc_id for r in group[1]} == {1, 20, 21, 22}
    assert len(group[1]) == 5
    for i in (4, 5, 6, 7, 11):
        assert [r.doc_id for r in group[i]] == [i]
    assert minhash.without_near_copies(docs).count() == len(group)
    assert minhash.without_near_copies(docs).columns == docs.columns
    assert minhash.near_copies(empty).count() == 0


def test_sketch_agreement_is_weighted_similarity():
    a = {i: 1.0 + i % 3 for i in range(400)}
    b = {i: 1.0 + (i + 1) % 3 if i < 40 else v for i, v in a.items() if i >= 20} | {1000 + i: 2.0 for i in range(30)}
    keys = set(a) | set(b)
    true = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    owner = np.array([0] * len(a) + [1] * len(b))
    element = np.array([*a, *b], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    s = minhash.sketch(owner, element, np.array([*a.values(), *b.values()]), 2, 4000)
    assert abs((s[0] == s[1]).mean() - true) < 0.03


def test_groups_of_near_copies_match_brute_force(spark):
    rng = random.Random(3)
    rows, n = [], 0
    for _ in range(12):
        base = [rng.choice(VOCABULARY) for _ in range(rng.randint(40, 200))]
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
            rows.append((n, " ".join(w)))
            n += 1
    bags = {i: shingle_bag(t) for i, t in rows}
    parent = {i: i for i in bags}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in bags:
        for j in range(i):
            shared = sum((bags[i] & bags[j]).values())
            if shared >= 0.8 * (sum(bags[i].values()) + sum(bags[j].values()) - shared):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    got = {r.doc_id: r.class_id for r in minhash.near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    wrong = sum(got[i] != find(i) for i in bags)
    assert wrong <= 1  # bands miss a pair at the threshold now and then


def test_top_k(spark, empty):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 16) * rng.choice([0.1, 1, 3])]) for i in range(700)]
    rows += [(800, None), (801, [1.0] * 15 + [float("nan")]), (802, [1.0, None]), (900, rows[0][1]), (901, rows[0][1]), (1000, [2.0, 1.0]), (None, [1.0] * 16), (1100, [])]
    schema = "vec_id bigint, embedding array<float>, score string"
    df = spark.createDataFrame([(*r, "clash") for r in rows], schema)
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    v = {}
    for i, x in rows:
        if i is not None and x is not None and all(a is not None and np.isfinite(a) for a in x):
            v[i] = np.floor(1024 * np.array(x + [0.0] * (16 - len(x)), np.float32).astype(float)).astype(np.int64)
    for q in v:
        if q % 100 == 0:
            best = sorted(((-int(v[q] @ x), i) for i, x in v.items() if i != q))[:10]
            assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert set(got) == {q for q in v if q % 100 == 0}
    assert topk.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 100 == 0).count() == 0


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer(name))
    t.no_truncation()
    t.no_padding()
    return t


ODD = list("aB é\n\t  'sΣςİ1٣½ﬁ 　\xa0́ẛ가한漢😀<|endoftext|>.,!#\x1c\x85‍_\x01'll") + ["<|endoftext|>", "<|startoftext|>", "'ve"]


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_pieces_encode_like_the_whole(name, kind):
    texts = ["".join(random.choices(ODD, k=random.randint(0, 30))) for _ in range(3000)] + [t for _, t in ROWS]
    ids, at = Encoder(tokenizer(name), kind).encode(pa.array(texts))
    model = library(name)
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == model.encode(t or "", add_special_tokens=False).ids


def test_transducer():
    machine, model = bpe.Transducer(tokenizer("word_bpe_49k.json")), library("word_bpe_49k.json")
    texts = ["".join(random.choices(ODD, k=random.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(random.choices("etaoinshrdlu", k=n)) for n in (1, 300, 3000)] + ["a" * 5001, "ab" * 3000, "!" * 3001]
    for t in texts:
        ids = model.encode(t, add_special_tokens=False).ids
        assert machine.encode(t) == ids
        assert "".join(machine.decoded(ids, tokens=True)) == model.decode(ids, skip_special_tokens=False)
    word = machine.word_symbols("ab" * 4000)
    emitted = 0
    for n, token in enumerate(machine.tokens(iter(word))):
        emitted += len(token)
    assert emitted == len(word)
    ids = machine.encode("naïve 😀 <|endoftext|> end")
    assert "".join(machine.decoded(ids)) == "naïve 😀 <|endoftext|>end "
    assert "".join(machine.decoded(machine.encode("😀")[:-1])).endswith("�") or len(machine.encode("😀")) == 1


def test_tokens_come_out_while_the_word_goes_on():
    machine = bpe.Transducer(tokenizer("word_bpe_49k.json"))
    read = 0

    def symbols():
        nonlocal read
        for c in machine.word_symbols("the" * 3000):
            read += 1
            yield c

    next(machine.tokens(symbols()))
    assert read <= 3 * (machine.lookahead + machine.longest)


def test_round_trip(docs, empty):
    model = library("word_bpe_49k.json")
    out = bpe.round_trip(docs, tokenizer("word_bpe_49k.json"))
    want = Counter()
    for i, t in ROWS:
        ids = model.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), " ".join(map(str, ids)), model.decode(ids, skip_special_tokens=False)] += 1
    assert Counter(tuple(r) for r in out.collect()) == want
    digests = bpe.round_trip(docs, tokenizer("word_bpe_49k.json"), digests=True)
    assert Counter((r.doc_id, r.ids_sha256) for r in digests.collect()) == Counter({(k[0], hashlib.sha256(k[2].encode()).hexdigest()): n for k, n in want.items()})
    assert bpe.round_trip(empty, tokenizer("word_bpe_49k.json")).count() == 0


def test_orc(spark, docs, empty, tmp_path):
    model = library("byte_bpe_50k.json")
    path = str(tmp_path / "ids")
    orc_ids.write_ids(docs, path, tokenizer("byte_bpe_50k.json"))
    rows = orc_ids.read_ids(spark, path).orderBy("start").collect()
    place, last = 0, None
    for r in rows:
        assert r.start == place and r.n_tokens == len(r.ids) and r.ids[-1] == 2
        assert last is None or r.doc_id >= last
        place, last = place + r.n_tokens, r.doc_id
    want = Counter((i, *model.encode(t or "", add_special_tokens=False).ids, 2) for i, t in ROWS)
    assert Counter((r.doc_id, *r.ids) for r in rows) == want
    some = orc_ids.read_ids(spark, path, F.col("doc_id") == 11)
    assert some.count() == 1 and "PushedFilters: [" in some._jdf.queryExecution().toString()
    crc = {(r.doc_id, r.n_tokens): r.ids_crc32 for r in orc_ids.with_digest(orc_ids.read_ids(spark, path)).collect()}
    for r in rows:
        if r.doc_id not in (13, 21):
            assert crc[r.doc_id, r.n_tokens] == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    none = str(tmp_path / "none")
    orc_ids.write_ids(empty, none, tokenizer("byte_bpe_50k.json"))
    assert orc_ids.read_ids(spark, none).count() == 0


def test_orc_files_have_bloom_filters(spark, docs, tmp_path):
    path = tmp_path / "ids"
    orc_ids.write_ids(docs, str(path), tokenizer("byte_bpe_50k.json"))
    from pyarrow import orc

    f = orc.ORCFile(next(p for p in path.iterdir() if p.suffix == ".orc" and p.stat().st_size > 500))
    assert f.compression == "ZSTD" and f.row_index_stride == 1000


@pytest.mark.parametrize("tail", [True, False])
def test_assign(tail):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 5000, 300)
    rows = packing.assign(lengths, 2048, tail=tail)
    cover = {}
    for d, start, n, _, _ in rows.tolist():
        cover.setdefault(d, []).append((start, n))
    for d, parts in cover.items():
        parts.sort()
        assert [s for s, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) == lengths[d]
    fill = Counter()
    for _, _, n, s, offset in sorted(rows.tolist(), key=lambda r: (r[3], r[4])):
        assert offset == fill[s]
        fill[s] += n
    assert max(fill.values()) == 2048
    short = [n for n in fill.values() if n < 2048]
    assert len(short) <= 11 if tail else len(short) <= 1
    assert not tail or all(n & n - 1 == 0 for n in short)
    # costs are even: a second of quadratic cost would show in a first-fit packing
    squares = Counter()
    for _, _, n, s, _ in rows.tolist():
        squares[s] += n * n
    rest = [squares[s] for s in fill if fill[s] == 2048 and squares[s] < 2048 * 2048]
    assert max(rest) < 4 * np.median(rest)


def test_pack(docs, empty):
    model = library("word_bpe_49k.json")
    rows = packing.pack(docs, tokenizer("word_bpe_49k.json")).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in rows)
    total = sum(len(model.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ROWS)
    assert sum(r.length for r in rows) == total
    assert packing.pack(empty, tokenizer("word_bpe_49k.json")).count() == 0


def test_quality(docs, empty):
    def figures(t):
        w = words(t)
        windows = [tuple(w[a : a + 5]) for a in range(len(w) - 4)]
        n = Counter(windows)
        covered = {k for a, x in enumerate(windows) if n[x] > 1 for k in range(a, a + 5)}
        lines = [s for s in (t or "").split("\n") if words(s)]
        return (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w),
        )

    out = quality.judge(docs)
    got = Counter(tuple(r) for r in out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
    assert got == Counter((i, *figures(t)) for i, t in ROWS)
    assert not any(r.kept and r.base_failed for r in out.collect())
    assert quality.judge(empty).count() == 0


def test_js_distance(spark):
    df = spark.createDataFrame([([1, 3], [3, 1]), ([1, 0], [0, 1]), ([2, 2], [5, 5]), ([0, 0], [1, 1])], "a array<bigint>, b array<bigint>")
    got = [r.d for r in df.select(quality.js_distance("a", "b").alias("d")).collect()]
    assert got[0] == pytest.approx((0.25 * np.log2(0.25 / 0.5) + 0.75 * np.log2(0.75 / 0.5)) ** 0.5)
    assert got[1] == pytest.approx(1) and got[2] == pytest.approx(0) and got[3] is None


def test_quality_rejects_symbols_and_tables(spark):
    rng = random.Random(4)
    stop, rare = quality.COMMON["en"], [f"{a}{b}{c}" for a in "ab" for b in ("ing", "tion", "er") for c in ("ed", "ly", "on")]
    text = lambda: " ".join(rng.choice(stop) if rng.random() < 0.4 else rng.choice(rare) for _ in range(rng.randint(150, 300)))
    rows = [(i, text(), "en") for i in range(60)]
    rows += [(100, " ".join(f"{w}### $$$" for w in text().split()), "en"), (101, " ".join(rng.choice(rare) for _ in range(400)), "en")]
    kept = {r.doc_id: (r.kept, r.base_failed) for r in quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert sum(k for k, _ in kept.values()) >= 58
    assert not kept[100][0] and not kept[101][0]


def test_toxicity(spark, docs, empty):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        w = [rng.choice(VOCABULARY) for _ in range(rng.randint(20, 300))]
        bad = i % 8 == 0
        for _ in range(rng.randint(2, 6) if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["scoundrel", "Nitwit!", "knaves"]))
        rows.append((i, " ".join(w), int(bad)))
    train = spark.createDataFrame(rows, "doc_id bigint, text string, y int")
    labels = train.filter("doc_id < 300").select("doc_id", F.col("y").alias("toxic"))
    labels = labels.union(labels.limit(5)).union(spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int"))
    model = toxicity.fit(train, labels)
    assert (np.diff(model.thresholds) >= 0).all() and min(model.weights.values()) > 0
    got = toxicity.score(train, model).filter("doc_id >= 300").collect()
    assert all(r.toxic == bool(r.y) for r in got)
    assert all(0 <= r.severity <= 3 for r in got)
    out = toxicity.score(docs, model)
    assert out.count() == len(ROWS) and out.filter("toxic").count() == 0
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, labels.filter("toxic = 0"))).agg(F.max("severity")).head()[0] < 1e-100


def test_ordinal_grades_follow_the_score():
    rng = np.random.default_rng(8)
    rows, grade = [], []
    for _ in range(600):
        n = rng.integers(0, 4)
        rows.append(np.array([0] * 0 + rng.choice(5, n, replace=False).tolist(), np.int64))
        grade.append(n)
    w, theta = toxicity.fit_ordinal(rows, 5, np.array(grade), np.ones(600), penalty=0)
    assert (np.diff(theta) > 0).all() and w.std() / w.mean() < 0.2


def test_lm(docs, empty, spark):
    out = {}
    for r in lm.score(docs).collect():
        out.setdefault(r.doc_id, []).append(r)
    tokens = [(i, (t or "").encode().lower().split() + [b""]) for i, t in ROWS]
    count = Counter()
    for i, w in tokens:
        if not lm.held_out(i):
            count.update(w)
    n, v = sum(count.values()), len(count)
    assert sum(map(len, out.values())) == len(ROWS)
    for i, w in tokens:
        base = sum(np.log10((count[x] + 1) / (n + 1 * (v + 1))) for x in w)
        assert any(
            r.n_tokens == len(w) and r.n_known == sum(count[x] > 0 for x in w) and r.train_tokens == n and r.base_score == pytest.approx(base) for r in out[i]
        )
        assert all(r.score < 0 for r in out[i])
    assert lm.score(empty).count() == 0


def test_lm_learns_order(spark):
    """Held-out texts of a first-order chain score better than by word counts."""
    rng = random.Random(9)
    step = {w: rng.sample(VOCABULARY[:40], 3) for w in VOCABULARY[:40]}
    rows = []
    for i in range(400):
        w = [rng.choice(VOCABULARY[:40])]
        while len(w) < 120:
            w.append(rng.choice(step[w[-1]]))
        rows.append((i, " ".join(w)))
    got = lm.score(spark.createDataFrame(rows, "doc_id bigint, text string")).filter("held_out").collect()
    bits = -sum(r.score for r in got) / sum(r.n_tokens for r in got) * np.log2(10)
    assert bits < 4.2  # 5.3 by counts alone, 1.6 at best


def test_lm_sums_to_one():
    model = lm.Trainer()
    rng = np.random.default_rng(1)
    before, word = rng.integers(0, lm.BLANK**2, 500), rng.integers(32, 1024, 500) * rng.integers(0, 2, 500)
    model.learn(before, word)
    every = np.concatenate([[lm.RARE], np.arange(32, 1024)])
    assert (10.0 ** model.log10(np.repeat(before[:1], 993), every)).sum() == pytest.approx(1, abs=1e-3)


def test_pieces_are_learned_many_at_a_time(monkeypatch):
    store, calls = Encoder(tokenizer("byte_bpe_50k.json"), "byte"), []
    model, add = library("byte_bpe_50k.json"), Encoder.add
    monkeypatch.setattr(Encoder, "add", lambda self, pieces, *rest: calls.append(len(pieces)) or add(self, pieces, *rest))
    texts = [" ".join(f"w{i * 7 + k}x" for k in range(40)) for i in range(100)] + ["", "a <|b <|endoftext|> c w1x", "w1x. w2x,\nw3x"]
    for _ in range(2):
        ids, at = store.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [model.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(calls) == len(store.known) and len(calls) < 10


def test_a_piece_is_encoded_once_while_there_is_room(monkeypatch):
    store, met = bpe._Known(tokenizer("word_bpe_49k.json")), []
    monkeypatch.setattr(store.machine, "encode", lambda p: met.append(p) or [7, len(p)])
    pieces = [f"p{i}" for i in range(320_000)]
    for _ in range(2):
        for i in range(0, len(pieces), 40_000):
            store.look_up(pieces[i : i + 40_000])
    assert len(met) == len(pieces)
    ids, at = store.ids_of(store.look_up(["p5", "new", "p123456"]))
    assert ids.tolist() == [7, 2, 7, 3, 7, 7] and at.tolist() == [0, 2, 4, 6]
