"""Severity of toxic language by cumulative-link ordinal regression.

A document is the set of its words and their first four and five letters
(punctuation around a word does not count, nor does case).  One weight vector
serves all grades: the odds of a grade above j are those of x.w - theta_j, with
ordered thresholds theta, so P(grade > j) = sigmoid(x.w - theta_j) and the
expected severity is the sum of these over j.  Weights are not negative: a word
can raise the severity, but clean words around an insult can't hide it.  An L1
penalty keeps only words that matter, of those that toxic documents have far
more often, so a long clean text gathers no score from chance words.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled documents
of either class, the first by hash of doc_id, weighted to the classes' sizes.
Scoring covers every document where it lies, without a shuffle.

A NULL or empty text has no features and gets the model's lowest severity.
Without labels of both classes there is nothing to tell apart: severity is 0.
Repeated rows are scored each; other columns are passed on, but for those with
the names of the new ones, which are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from tallybrook.llm.common import as_bytes, sliced, split_words

SAMPLE = 4_000  # labelled documents of either class
MIN_DOCS = 5  # of the sample that have a feature
MIN_RATIO = 20  # of its frequencies in toxic and other documents
MIN_G2 = 20.0  # likelihood ratio from which a feature belongs to toxic documents
GRADES = 4
EVIDENCE = 0.75
EDGES = "#*$%&|<>.,;:!?\"'()[]{}-_=+/\\"
NEW = [
    StructField("severity", DoubleType()),
    StructField("toxic_probability", DoubleType()),
    StructField("grade", IntegerType()),
    StructField("toxic", BooleanType()),
]


def word_features(word: bytes) -> tuple[int, ...]:
    """64-bit numbers of the features of a word."""
    w = word.decode("utf-8", "replace").strip(EDGES).lower()
    names = {f"w{w}"} | {f"p{n}{w[:n]}" for n in (4, 5) if len(w) >= n} if w else set()
    return tuple(xxhash.xxh3_64_intdigest(n) >> 1 for n in names)


class Features(dict):
    """Features of each word met, of those in ``known`` if given."""

    def __init__(self, known: dict[int, int] | None = None, limit: int = 150_000):
        super().__init__()
        self.known, self.limit = known, limit

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        found = word_features(word)
        if self.known is not None:
            found = tuple(self.known[f] for f in found if f in self.known)
        self[word] = found
        return found

    def of(self, text: bytes | None) -> set[int]:
        return {f for w in set(split_words(text)) for f in self[w]}


@dataclass
class Ordinal:
    """Weights of features (by number) and ordered thresholds."""

    weights: dict[int, float] = field(default_factory=dict)
    thresholds: np.ndarray = field(default_factory=lambda: np.full(1, np.inf))

    def above(self, z: np.ndarray) -> np.ndarray:
        """P(grade > j) for each row and j."""
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.thresholds[None, :], -500, 500)))


def fit_ordinal(rows: list[np.ndarray], n_features: int, grade: np.ndarray, weight: np.ndarray, penalty: float = 2e-4, steps: int = 300, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative weights and thresholds for rows of feature numbers, by proximal
    AdaGrad."""
    k = int(grade.max()) + 1
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    weight = weight / weight.sum()
    share = np.clip([weight[grade > j].sum() for j in range(k - 1)], 1e-6, 1 - 1e-6)
    theta = np.log((1 - share) / share)
    w = np.zeros(n_features)
    g_w, g_theta = np.full(n_features, 1e-8), np.full(k - 1, 1e-8)
    for _ in range(steps):
        z = np.bincount(owner, w[flat], len(rows))
        above = 1 / (1 + np.exp(-np.clip(z[:, None] - theta[None, :], -500, 500)))
        above = np.concatenate([np.ones((len(z), 1)), above, np.zeros((len(z), 1))], 1)
        a, b = above[np.arange(len(z)), grade], above[np.arange(len(z)), grade + 1]
        p = np.maximum(a - b, 1e-12)
        d_z = weight * (a + b - 1)  # of minus the log likelihood
        d_w = np.bincount(flat, d_z[owner], n_features)
        # theta_j bounds grade j from above and grade j + 1 from below
        d_theta = np.array(
            [
                (weight * np.where(grade == j + 1, a * (1 - a) / p, 0)).sum() - (weight * np.where(grade == j, b * (1 - b) / p, 0)).sum()
                for j in range(k - 1)
            ]
        )
        g_w += d_w**2
        g_theta += d_theta**2
        pace = rate / np.sqrt(g_w)
        w = np.maximum(w - pace * (d_w + penalty), 0)
        theta = np.sort(theta - rate / np.sqrt(g_theta) * d_theta)
    return w, theta


def associated(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> np.ndarray:
    """Features found in enough documents, and so much more often in the first class
    that the likelihood-ratio statistic leaves little room for chance."""
    with np.errstate(divide="ignore", invalid="ignore"):
        total = (a + b) / max(1, n_a + n_b)
        g2 = 0.0
        for x, n in ((a, n_a), (b, n_b)):
            for seen, share in ((x, total), (n - x, 1 - total)):
                g2 = g2 + 2 * np.where(seen > 0, seen * np.log(seen / (n * share)), 0.0)
    return (a + b >= MIN_DOCS) & (a * n_b > MIN_RATIO * b * n_a) & (g2 >= MIN_G2)


def severity_grades(rows: list[np.ndarray], n_features: int, toxic: np.ndarray, weight: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """Ordered grades where labels only say toxic or not: 0 if not; else by how
    many of a document's features are typical of toxic ones (nine times in ten),
    in equal shares from 1 up."""
    flat = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    sizes = np.array([len(r) for r in rows])
    all_ = np.bincount(flat, np.repeat(weight, sizes), n_features)
    bad = np.bincount(flat, np.repeat(weight * toxic, sizes), n_features)
    typical = bad >= 0.9 * np.maximum(all_, 1e-12)
    share = np.array([typical[r.astype(np.int64)].sum() / max(1, len(r)) for r in rows])
    cuts = np.quantile(share[toxic == 1], np.linspace(0, 1, grades)[1:-1]) if (toxic == 1).any() else []
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, share, "right"), 0).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Ordinal:
    """Fit on at most ``sample`` documents of either class of a 0/1 label."""
    marked = labels.filter(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("_y"))
    sizes = {r["_y"]: r["count"] for r in marked.groupBy("_y").count().collect()}
    if len(sizes) < 2:
        return Ordinal()
    by_hash = [marked.filter(F.col("_y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    chosen = by_hash[0].union(by_hash[1])

    def features(batches):
        of = Features()
        for batch in batches:
            found = [sorted(of.of(t)) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("_y"), pa.array(found, pa.list_(pa.int64()))], names=["y", "x"])

    # at most 2 * sample rows of two numbers
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("_y", "text")
    got = texts.mapInArrow(features, "y int, x array<bigint>").toArrow()
    toxic, x = got["y"].to_numpy(), got["x"].combine_chunks()
    values = x.flatten().to_numpy()
    names, number, count = np.unique(values, return_inverse=True, return_counts=True)
    ends = x.offsets.to_numpy() - x.offsets[0].as_py()
    in_toxic = np.bincount(number, np.repeat(toxic, np.diff(ends)), len(names))
    often = associated(in_toxic, count - in_toxic, int(toxic.sum()), int((toxic == 0).sum()))
    new = np.cumsum(often) - 1
    rows = [new[n[often[n]]] for n in (number[a:b] for a, b in zip(ends[:-1], ends[1:]))]
    if not len(toxic) or len(set(toxic.tolist())) < 2 or not often.any():
        return Ordinal()
    weight = np.where(toxic == 1, sizes[1] / (toxic == 1).sum(), sizes[0] / (toxic == 0).sum())
    grade = severity_grades(rows, int(often.sum()), toxic, weight)
    w, theta = fit_ordinal(rows, int(often.sum()), grade, weight)
    used = np.flatnonzero(w)
    return Ordinal(dict(zip(names[often][used].tolist(), w[used].tolist())), theta)


def score(docs: DataFrame, model: Ordinal, evidence: float = EVIDENCE) -> DataFrame:
    """The input's columns with severity (expected grade), toxic_probability
    (P(grade > 0)), grade (the most likely) and toxic: its words raise the
    log odds by ``evidence`` or more over those of a text without features.
    That depends little on how many of the labelled documents are toxic."""
    new = [f.name for f in NEW]
    docs = docs.select(*[c for c in docs.columns if c not in new])
    names = docs.columns
    number = {f: i for i, f in enumerate(model.weights)}
    weight = np.array([*model.weights.values(), 0.0])

    def rate(batches):
        of = Features(number)
        for batch in sliced(batches, "text", 4 << 20):
            z = np.array([weight[list(of.of(t)) or [-1]].sum() if t else 0.0 for t in as_bytes(batch.column("text"))])
            above = model.above(z)
            each = -np.diff(np.concatenate([np.ones((len(z), 1)), above, np.zeros((len(z), 1))], 1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(above.sum(1)),
                    pa.array(above[:, 0]),
                    pa.array(each.argmax(1).astype(np.int32)),
                    pa.array(z >= evidence),
                ],
                names=[*names, *new],
            )

    return docs.mapInArrow(rate, StructType([*docs.schema.fields, *NEW]))
