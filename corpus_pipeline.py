"""The corpus pipeline: toxic documents, repeated lines, near copies, repeated
passages, and packing.  Each stage works on all that the one before it kept, and
all but the last return the columns of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import line_dedup, minhash, packing, substring_dedup, toxicity
from tallybrook.llm.common import aside, documents, written
from tallybrook.llm.queries import tokenizer
from tallybrook.session import prepare, small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _apart(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Documents whose further columns are out of an operator's way, whatever they are
    called, and what gives them their names back."""
    return aside(docs, [c for c in docs.columns if c not in ("doc_id", "text")])


def _with_text(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``; n_chars follows the text."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed.select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject."""
    labels = small_batches(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    plain, back = _apart(docs)
    return back(toxicity.score(plain, model).filter("NOT toxic").select(*plain.columns))


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines.  A document that was nothing
    else goes; one that had no text before stays."""
    plain, back = _apart(docs)
    small_batches(spark)
    cut = line_dedup.remove_repeated_lines(plain)
    left = (F.col("n_removed_lines") == 0) | F.col("text").rlike(r"[^ \t-\r]")
    return _with_text(back(cut.filter(left).select(*plain.columns)), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    plain, back = _apart(docs)
    small_batches(spark)
    return back(minhash.without_near_copies(plain).select(*plain.columns))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 20 words or more that occur earlier."""
    plain, back = _apart(docs)
    small_batches(spark)
    return _with_text(back(substring_dedup.remove_repeats(plain).select(*plain.columns)), docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece."""
    small_batches(spark)
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_lines),
    ("near dedup", drop_near_copies),
    ("substring dedup", cut_passages),
    ("packing", pack_tokens),
]

# Hashing, model training and BPE have no SQL form; tests hold run() against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result written as Parquet and reread by the next."""
    docs = documents(prepare(spark), sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
