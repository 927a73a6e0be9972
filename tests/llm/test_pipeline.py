"""The corpus pipeline against its stages by brute force."""

from __future__ import annotations

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(500)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = text(60)
    rows = [(i, text(rng.randint(50, 200)), "en", f"s{i % 3}") for i in range(300)]
    toxic = set(range(0, 300, 10))
    rows = [(i, f"{t} scoundrel knave nitwit scoundrel" if i in toxic else t, *r) for i, t, *r in rows]
    rows += [(400 + i, rows[5][1] + f" tail{i}", "en", "s0") for i in range(20)]  # near copies of 5
    rows += [(500, f"{text(40)} {passage}", "de", "s1"), (501, f"{text(50)} {passage}", "fr", "s1")]
    rows += [(600, None, None, None), (601, "", "en", "s2")]
    docs = [(i, t, lang, s, len(t) if t else 0) for i, t, lang, s in rows]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(300)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, dict((r[0], r[1]) for r in rows), toxic, passage


def test_stages(spark, folder):
    path, texts, toxic, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == columns
        seen[name] = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(list(seen[name].values()), docs.schema)
    assert set(seen["toxicity"]) == set(texts) - toxic
    assert set(seen["line dedup"]) == set(seen["toxicity"])
    assert set(seen["near dedup"]) == set(seen["line dedup"]) - set(range(400, 420))
    assert set(seen["substring dedup"]) == set(seen["near dedup"])
    assert seen["substring dedup"][500].text == texts[500]
    assert passage not in seen["substring dedup"][501].text
    assert seen["substring dedup"][501].n_chars == len(seen["substring dedup"][501].text)
    assert seen["substring dedup"][600].text is None


def test_run(spark, folder):
    path, texts, toxic, _ = folder
    pieces = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in pieces} == set(texts) - toxic - set(range(400, 420))
    by_sequence = {}
    for r in pieces:
        by_sequence[r.sequence_id] = by_sequence.get(r.sequence_id, 0) + r.length
    assert max(by_sequence.values()) <= 2048
