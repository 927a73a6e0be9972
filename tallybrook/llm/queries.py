"""Registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import (
    bpe, conversations, lexical, line_dedup, lm, minhash, orc_ids, packing, permutation, quality, substring_dedup, topk, toxicity,
)
from tallybrook.llm.common import documents, shared
from tallybrook.session import prepare


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of all documents, and whether it is too high."""
    docs = documents(prepare(spark), sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).drop("text")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that stay of each document once repeated 20-word windows are cut."""
    kept = substring_dedup.remove_repeats(documents(prepare(spark), sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest inner products of every hundredth vector."""
    vectors = prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0).withColumn("rank", F.col("rank").cast("int"))


def op4_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, one row per piece."""
    return packing.pack(documents(prepare(spark), sf_dir), tokenizer("word_bpe_49k.json"), ids=False)


def op5_distribution_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict of all documents."""
    return quality.judge(documents(prepare(spark), sf_dir)).drop("char_distance", "word_distance")


def op6_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents."""
    return lm.score(documents(prepare(spark), sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document once repeated runs of lines are cut."""
    kept = line_dedup.remove_repeated_lines(documents(prepare(spark), sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed_lines", F.sha2("text", 256).alias("kept_sha256"))


def op8_orc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as ORC and read back."""
    path = shared(prepare(spark), "orc-ids")
    orc_ids.write_ids(documents(spark, sf_dir), path, tokenizer("byte_bpe_50k.json"))
    return orc_ids.with_digest(orc_ids.read_ids(spark, path))


def op9_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies of every document, and which one of it stays."""
    return minhash.near_copies(documents(prepare(spark), sf_dir)).drop("_n")


def op10_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again, as digests."""
    return bpe.round_trip(documents(prepare(spark), sf_dir), tokenizer("word_bpe_49k.json"), digests=True)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired by the cheapest edits."""
    rows = conversations.damaged(prepare(spark).read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversations.summary(conversations.repair(rows, F.col("present")))


def op12_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector."""
    vectors = prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return permutation.nearest(vectors, F.col("vec_id") % 100 == 0)


def op13_automaton_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    items = prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical.search(documents(spark, sf_dir), items)


QUERIES = {
    f.__name__: f
    for f in (
        op1_ordinal_toxicity, op2_substring_dedup, op3_exact_top_k, op4_cost_packing, op5_distribution_rules, op6_maxent_lm, op7_line_dedup,
        op8_orc_ids, op9_dart_minhash, op10_bpe_transducer, op11_conversation_repair, op12_permutation_index, op13_automaton_search,
    )
}

OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

WORDS_SQL = r"""
w AS (
  SELECT doc_id, coalesce(text, '') AS text, lang,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
)"""

OP2_SQL = rf"""
WITH {WORDS_SQL}, windows AS (
  SELECT doc_id, a, list_slice(words, a, a + 19) AS x
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS a FROM w)
), later AS (
  SELECT doc_id, a FROM (SELECT doc_id, a, row_number() OVER (PARTITION BY x ORDER BY doc_id, a) AS k FROM windows)
  WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(a, a + 20)) AS i FROM later
), places AS (
  SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, i, words[i] AS word
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w) AS w
  ANTI JOIN gone USING (doc_id, i)
), texts AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM kept GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN places USING (doc_id) LEFT JOIN texts USING (doc_id)
"""


def _js_sql(a: str, b: str) -> str:
    """Jensen-Shannon distance of two lists of counts."""
    part = "CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({x} + {y})) ELSE 0 END"
    x, y = f"z[1] / list_sum({a})", f"z[2] / list_sum({b})"
    each = f"{part.format(x=f'({x})', y=f'({y})')} + {part.format(x=f'({y})', y=f'({x})')}"
    return f"sqrt(greatest(list_sum(list_transform(list_zip({a}, {b}), lambda z: {each})) / 2, 0))"


def op5_sql() -> str:
    listed = {k: "[" + ", ".join(f"'{x}'" for x in v) + "]" for k, v in quality.COMMON.items()}
    common = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in listed.items()) + " END"
    char_sums = ", ".join(f"sum(chars[{i}])" for i in range(1, len(quality.CLASSES) + 1))
    word_sums = ", ".join(f"sum(common[{i}])" for i in range(1, quality.WORDS + 2))
    return rf"""
WITH {WORDS_SQL}, windows AS (
  SELECT doc_id, a, array_to_string(list_slice(words, a, a + 4), ' ') AS x
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS a FROM w)
), twice AS (
  SELECT doc_id, a FROM (SELECT doc_id, a, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(a, a + 5)) AS i FROM twice) GROUP BY doc_id
), letters AS (
  SELECT w.*, list_filter(string_split_regex(lower(text), '[^\p{{L}}]+'), lambda x: x <> '') AS plain, {common} AS frequent,
    length(text) AS n0, length(regexp_replace(text, '\p{{Ll}}+', '', 'g')) AS n1,
    length(regexp_replace(text, '[\p{{Ll}} 	-
]+', '', 'g')) AS n2,
    length(regexp_replace(text, '[\p{{Ll}} 	-
\p{{Lu}}]+', '', 'g')) AS n3,
    length(regexp_replace(text, '[\p{{Ll}} 	-
\p{{Lu}}\p{{Nd}}]+', '', 'g')) AS n4,
    length(regexp_replace(text, '[\p{{Ll}} 	-
\p{{Lu}}\p{{Nd}}.,;:!?''"()\-]+', '', 'g')) AS n5,
    list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^ 	-
]')) AS lines
  FROM w
), figures AS (
  SELECT doc_id, CASE WHEN frequent IS NULL THEN 'other' ELSE lang END AS reference,
    CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    [n0 - n1, n1 - n2, n2 - n3, n3 - n4, n4 - n5, n5] AS chars,
    CASE WHEN frequent IS NULL THEN list_transform(range(0, {quality.WORDS}), lambda x: 0)
      ELSE list_transform(frequent, lambda f: len(list_filter(plain, lambda p: p = f))) END AS hits
  FROM letters LEFT JOIN covered AS c USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         list_append(hits, greatest(0, n_words - list_sum(hits))) AS common
  FROM figures
), ref AS (
  SELECT reference, [{char_sums}] AS ref_chars, [{word_sums}] AS ref_common
  FROM judged WHERE NOT base_failed GROUP BY reference
), far AS (
  SELECT *, {_js_sql("chars", "ref_chars")} AS dc,
         CASE WHEN reference <> 'other' THEN {_js_sql("common", "ref_common")} END AS dw
  FROM judged LEFT JOIN ref USING (reference)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_words >= 50 AND coalesce(dc, 0) > 0.25) AND NOT (n_words >= 100 AND coalesce(dw, 0) > 0.3) AS kept
FROM far
"""


OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), sizes AS (
  SELECT count(*) FILTER (len(t) > 0) AS nd, CAST(sum(len(t)) AS BIGINT) AS total FROM docs
), tf AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM docs) GROUP BY ALL
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id,
    CAST(sum(CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // total)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term), sizes GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op2_substring_dedup": OP2_SQL,
    "op3_exact_top_k": OP3_SQL,
    "op5_distribution_rules": op5_sql(),
    "op13_automaton_search": OP13_SQL,
}
