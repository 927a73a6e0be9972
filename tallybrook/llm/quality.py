"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram of character classes and its histogram of common words
are compared to the reference of its language by the Jensen-Shannon distance
(base 2, 0 to 1).  References are the summed histograms of all documents of the
language that pass the base rules.  Documents of fewer than ``min_words`` words
(``min_words_common`` for common words) are not judged by their distance: their
histograms say too little.  Documents
of other languages share one reference and have no common words to compare.

Base figures are described at ``features``.  A NULL or empty text has no words
and fails the base rules.  Rows are judged one by one, so repeated rows get the
same verdict each; other columns of the input stay out of the result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import written

# Frequent words of each language.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "are", "this"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a", "par", "au", "sur", "pas"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al"],
}
WORDS = 20
SPACE = r"[ \t-\r]"
CLASSES = ["lower", "space", "upper", "digit", "mark", "other"]


def _without(text: str, pattern: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(""))


def _by_lang(make: Callable[[list[str]], Column]) -> Column:
    """What ``make`` gives for the common words of a row's language; NULL for others."""
    first, *rest = COMMON.items()
    return reduce(lambda c, x: c.when(F.col("lang") == x[0], make(x[1])), rest, F.when(F.col("lang") == first[0], make(first[1])))


def features(docs: DataFrame) -> DataFrame:
    """Per document: n_words and word_chars of its words ``[^\\x20\\x09-\\x0D]+``,
    n_symbols (characters of ``#*$%&|<>``), n_dup_lines (lines with a word that
    equal an earlier one), n_repeat_words (words in 5-word windows that occur
    twice or more in the text), base_failed, and the two histograms."""
    d = docs.select("doc_id", F.col("lang").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("words", F.filter(F.split("text", SPACE + "+"), lambda w: w != ""))
    d = d.withColumn("word_hashes", F.transform("words", lambda w: F.xxhash64(w)))
    d = d.withColumn("no_lower", _without("text", r"\p{Ll}+"))
    d = d.withColumn("no_space", _without("no_lower", SPACE + "+"))
    d = d.withColumn("no_upper", _without("no_space", r"\p{Lu}+"))
    d = d.withColumn("no_digit", _without("no_upper", r"\p{Nd}+"))
    d = d.withColumn("no_mark", _without("no_digit", r"[.,;:!?'\"()\-]+"))
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda s: s.rlike(r"[^ \t-\r]")))
    d = d.withColumn("low", F.lower("text"))
    d = d.withColumn("hits", _by_lang(lambda words: F.regexp_extract_all("low", F.lit(rf"(?:^|\P{{L}})({'|'.join(words)})(?!\p{{L}})"), F.lit(1))))
    # only the common words are left, each between blanks of its own
    d = d.withColumn("plain", F.concat(F.lit(" "), F.array_join("hits", "  "), F.lit(" ")))
    n = [F.length(c) for c in ("text", "no_lower", "no_space", "no_upper", "no_digit", "no_mark")]
    counts = _by_lang(
        lambda words: F.array(*[((F.length("plain") - F.length(F.replace("plain", F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)).cast("bigint") for w in words])
    )
    common = F.coalesce(counts, F.array(*[F.lit(0).cast("bigint")] * WORDS))
    d = d.select(
        "doc_id",
        F.when(F.col("lang").isin(list(COMMON)), F.col("lang")).otherwise("other").alias("reference"),
        F.size("words").cast("bigint").alias("n_words"),
        (n[0] - n[1] + n[2]).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("no_digit", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(
            F.size("words") >= 5,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - 5),
                lambda i: F.xxhash64(*[F.get("word_hashes", i + k) for k in range(5)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("windows"),
        F.array(*[(a - b).cast("bigint") for a, b in zip(n, n[1:] + [F.lit(0)])]).alias("char_hist"),
        common.alias("word_hist"),
    )
    # only texts in which some window repeats are looked at more closely
    d = d.withColumn("windows", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.col("windows")))
    d = d.withColumn("_pairs", F.array_sort(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    last = F.size("_pairs") - 1
    same = lambda x, k: F.coalesce(F.get("_pairs", k)["h"] == x["h"], F.lit(False))
    d = d.withColumn(
        "_at",
        F.array_sort(
            F.transform(
                F.filter("_pairs", lambda x, k: ((k > 0) & same(x, k - 1)) | ((k < last) & same(x, k + 1))),
                lambda x: x["i"],
            )
        ),
    )
    covered = F.aggregate(
        F.transform("_at", lambda a, k: F.least(F.lit(5), F.coalesce(F.get("_at", k + 1) - a, F.lit(5)))),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))
    return d.select(
        "doc_id", "reference", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)).alias("base_failed"),
        "char_hist",
        # words that are none of the common ones make the last bin
        F.concat("word_hist", F.array(F.greatest(F.lit(0).cast("bigint"), F.col("n_words") - F.aggregate("word_hist", F.lit(0).cast("bigint"), lambda a, x: a + x)))).alias("word_hist"),
    )


def _sums(column: str, n: int) -> Column:
    return F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(n)])


def js_distance(a: str, b: str) -> Column:
    """Jensen-Shannon distance of two histograms; NULL if one is empty."""
    def total(c):
        return F.aggregate(c, F.lit(0).cast("bigint"), lambda s, x: s + x)

    def part(p, q):
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    ta, tb = total(a), total(b)
    terms = F.zip_with(a, b, lambda x, y: part(x / ta, y / tb) + part(y / tb, x / ta))
    js = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2
    return F.when((ta > 0) & (tb > 0), F.sqrt(F.greatest(js, F.lit(0.0))))


def judge(
    docs: DataFrame,
    min_words: int = 50,
    max_chars: float = 0.25,
    min_words_common: int = 100,
    max_words: float = 0.3,
) -> DataFrame:
    """Base figures, char_distance, word_distance, and ``kept``: false where the
    base rules fail, or a document that is long enough for the comparison is
    further from its language's reference than a limit allows."""
    f = written(features(docs), "quality")
    reference = (
        f.filter(~F.col("base_failed"))
        .groupBy("reference")
        .agg(_sums("char_hist", len(CLASSES)).alias("ref_chars"), _sums("word_hist", WORDS + 1).alias("ref_words"))
    )
    # one row for each language of COMMON and one for the others: never more
    f = f.join(F.broadcast(reference), "reference", "left")
    f = f.withColumn("char_distance", js_distance("char_hist", "ref_chars"))
    f = f.withColumn("word_distance", F.when(F.col("reference") != "other", js_distance("word_hist", "ref_words")))
    far = (F.coalesce("char_distance", F.lit(0.0)) > max_chars) & (F.col("n_words") >= min_words)
    odd = (F.coalesce("word_distance", F.lit(0.0)) > max_words) & (F.col("n_words") >= min_words_common)
    return f.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "char_distance", "word_distance",
        (~F.col("base_failed") & ~far & ~odd).alias("kept"),
    )
