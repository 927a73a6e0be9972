"""What the language model learns from and about words outside the most frequent."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tallybrook.llm import lm

SCHEMA = "doc_id bigint, text string"


def bits(rows) -> float:
    return -sum(r.score for r in rows) / sum(r.n_tokens for r in rows) * np.log2(10)


def test_rare_words_are_told_apart_as_history(spark):
    """Each of 6,000 words is followed by a word of its own among 40; most of the
    6,000 are outside the vocabulary."""
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        picks = [rng.randrange(6000) for _ in range(60)]
        rows.append((i, " ".join(f"r{k} f{k % 40}" for k in picks)))
    got = lm.score(spark.createDataFrame(rows, SCHEMA).coalesce(1)).filter("held_out").collect()
    assert bits(got) < 8.0  # 8.7 when they all count as one


def test_words_outside_the_vocabulary_have_context(spark):
    """3,000 pairs of words: the second is certain after the first."""
    rng = random.Random(6)
    rows = []
    for i in range(1500):
        picks = [rng.randrange(3000) for _ in range(60)]
        rows.append((i, " ".join(f"r{k} s{k}" for k in picks)))
    got = lm.score(spark.createDataFrame(rows, SCHEMA).coalesce(1)).filter("held_out").collect()
    assert bits(got) < 11.2  # 11.65 when only the vocabulary has context


def test_a_bucket_sums_to_one():
    rng = np.random.default_rng(2)
    counts = np.sort(rng.integers(lm.LEAST, 500, 700))[::-1]
    model = lm._started(counts, 50.0)
    every = np.concatenate([[lm.RARE], lm.CLASSES + np.arange(700)])
    before = rng.integers(0, lm.BLANK**2, 4000)
    shares = np.concatenate([[50.0], counts]) / (50 + counts.sum())
    assert np.allclose(10.0 ** model.log10(np.repeat(before[:1], 701), every), shares, rtol=1e-3)
    model.learn(before, rng.choice(every, 4000))
    assert abs((10.0 ** model.log10(np.repeat(before[:1], 701), every)).sum() - 1) < 1e-3


def test_messages_are_small(spark):
    """Bytes that runs and buckets exchange, per token outside the vocabulary."""
    rng = np.random.default_rng(8)
    words = (rng.zipf(1.2, 150_000) % 30_000).reshape(300, 500)
    docs = spark.createDataFrame([(i, " ".join(map("w{}".format, row))) for i, row in enumerate(words.tolist())], SCHEMA)
    runs = lm.runs_of(docs.coalesce(1))
    frequent = [lm.word_hash(b"w%d" % i) for i in range(1, 993)]
    vocabulary, names = lm.Vocabulary(np.array(frequent)), "bucket int, run bigint, kind int, value binary"
    events = runs.mapInArrow(lm._events(vocabulary, 4), names)
    replies = events.groupBy("bucket").applyInArrow(lm._replies(vocabulary, 60_000, 20_000, 4), "run bigint, kind int, bucket int, value binary")
    asked, answered = (sum(len(r.value) for r in x.collect()) for x in (events, replies))
    rare = int(((words > 992) | (words == 0)).sum())
    assert asked < 11.5 * rare and answered < 3.5 * rare


def test_a_slice_has_the_tokens_of_its_texts():
    texts = pa.array(["a b c", "d", "e f", "g h i j"])
    for some in (texts, texts.slice(1), texts.slice(2, 1)):
        assert lm.tokens_of(some)[2].tolist() == [len(t.split()) + 1 for t in some.to_pylist()]
