"""Language-model scores by a hashed maximum-entropy model.

Words are lower-cased in A-Z only.  The most frequent words of the training
documents, the end of a text among them, are the vocabulary; they are dealt to
classes of equal size by frequency; all other words are one class.  The
probability of a word is that of its class times that of the word in its class,
two softmaxes of a few dozen terms each.  Their scores are sums of weights of
three features of the history: the word before (bigram), the two before
(trigram) and the one before the last (skip), each word by its own hash whether
it is in the vocabulary or not.  Features are hashed to a fixed number of rows, for the words of a class
together with the class.

The words outside this vocabulary are dealt to buckets by hash, and the number of
buckets follows the bytes of text.  A bucket has its smoothed share of training
counts, and a model of the same form, with a vocabulary and rows of its own,
gives the probability of a word in its bucket.  Each token outside the vocabulary
goes to its bucket with the two words before it, so that model learns from all
training tokens of its words, and sends the probabilities back.  It starts from
exact counts; a bucket's words that occur less than LEAST times, or are not among
its most frequent, have their smoothed share of training counts there.  So known
words and rows grow with the input; the model of the most frequent words, which
all tasks train and average, does not.  A batch looks at each history it has once, however often it
occurs.

Training passes over all training documents once.  Each task makes AdaGrad steps
over its own, and the tasks' weights are averaged in blocks of rows, weighted by
tokens.  Counts are exact: runs of documents send each distinct word once, as a
64-bit hash, to the bucket that sums it, and get the sums back in the same order.
Texts are split once: a run keeps the hashes of its words and its tokens as numbers.

A NULL or empty text is its end alone.  Rows that share a doc_id are scored
each.  Without training tokens every score is that of an empty model.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import pack, sliced, text_bytes, unpack, written

CLASSES = 32  # classes of the vocabulary, and words of a class
ROWS = 1 << 15  # hashed rows of features, for classes and for words
RARE, RATE, STEP = 0, 0.1, 1 << 15
LEAST = 4  # training tokens of a word in a bucket's vocabulary
BLOCK = 128  # values that numpy sums without halving them
BLANK = CLASSES * CLASSES  # stands before a text, in histories of numbers
END = b""  # no word is empty
RUN_BYTES, BUCKET_BYTES = 8 << 20, 16 << 20
NUMBERS = np.arange(BLANK + 1, dtype=np.uint64)  # the names of numbers: themselves
K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def held_out(doc_id: int | None) -> bool:
    """Kept from training: crc32 of the id as text, modulo 7, is 2."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> 1


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words of some texts, the end among them; all tokens
    as places in that list, an end after each text; how many tokens each has."""
    texts = pa.concat_arrays([texts])  # of a slice, the lists below would begin where its parent does
    low = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(low)  # just the ASCII white space
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
    place, at = coded.indices.to_numpy(), lists.offsets.to_numpy()
    if END in words:  # white space at an end of a text leaves an empty string
        full = place != words.index(END)
        at = np.concatenate([[0], np.cumsum(full)])[at]
        place = place[full]
    words.append(END)
    place = np.insert(place.astype(np.int64), at[1:], len(words) - 1)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(1)  # as word_hash has them
    return hashes.astype(np.int64), place, np.diff(at).astype(np.int64) + 1


def bucket_of(words: np.ndarray, buckets: int) -> np.ndarray:
    return ((words.astype(np.uint64) * K[0] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


# -- counts -----------------------------------------------------------------


def runs_of(docs: DataFrame) -> DataFrame:
    """Rows (run, value): the tokens of documents packed as they lie, about 8 MB of
    text to a run, written once so that a run's number stays what it is."""

    def rows(batches):
        base = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(sliced(batches, "text", RUN_BYTES)):
            words, place, sizes = tokens_of(batch.column("text"))
            lists = {"doc_id": batch.column("doc_id"), "word": words, "size": sizes, **planes("place", place.astype(np.uint32))}
            value = pack(pa.table({name: pa.array([x]) if isinstance(x, np.ndarray) else pa.array([x.to_pylist()], pa.list_(x.type)) for name, x in lists.items()}))
            yield pa.RecordBatch.from_arrays([pa.array([base + i], pa.int64()), pa.array([value], pa.binary())], names=["run", "value"])

    return written(docs.select("doc_id", "text").mapInArrow(rows, "run bigint, value binary"), "runs")


def planes(name: str, numbers: np.ndarray) -> dict[str, np.ndarray]:
    """32-bit values as four columns of bytes, which compress better apart."""
    return {f"{name}{i}": plane for i, plane in enumerate(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 4).T))}


def from_planes(part: pa.Table, name: str, kind: type) -> np.ndarray:
    parts = [part[f"{name}{i}"].combine_chunks() for i in range(4)]
    parts = [x.values if pa.types.is_list(x.type) else x for x in parts]
    return np.stack([x.to_numpy() for x in parts], 1).view(kind).ravel()


def _open(value: bytes) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, held-out flags, and tokens_of the texts of a run."""
    table = unpack(value)
    ids = table["doc_id"][0].as_py()
    words, sizes = (table[c].combine_chunks().values.to_numpy() for c in ("word", "size"))
    place = from_planes(table, "place", np.uint32).astype(np.int64)
    return ids, np.array([held_out(i) for i in ids], bool), words, place, sizes


def _by_bucket(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words in order and the number of each word among them; their order
    by buckets, and the edges of the buckets in it."""
    distinct, number = np.unique(words, return_inverse=True)  # the end comes twice if it was a word
    bucket = bucket_of(distinct, buckets)
    order = np.argsort(bucket, kind="stable")
    return distinct, number, order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _counted(out: np.ndarray, words: np.ndarray, place: np.ndarray, sizes: np.ndarray, buckets: int, least: int):
    """Per bucket that has some: a run's distinct words that occur ``least`` times in
    training, with their training counts."""
    count = np.bincount(place, np.repeat(~out, sizes), len(words)).astype(np.int64)
    distinct, number, order, edges = _by_bucket(words, buckets)
    count = np.bincount(number, count, len(distinct)).astype(np.int64)
    for b, (start, end) in enumerate(zip(edges[:-1], edges[1:])):
        some = order[start:end]
        some = some[count[some] >= least]
        if len(some):
            yield b, pack(pa.table({"word": np.diff(distinct[some], prepend=0), "n": count[some]}))


def _requests(buckets: int):
    """Of each run, per bucket: its distinct training words and their counts."""

    def rows(batches):
        for batch in batches:
            for value in batch.column("value").to_pylist():
                _, out, words, place, sizes = _open(value)
                found = list(_counted(out, words, place, sizes, buckets, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["bucket", "value"]
                )

    return rows


def _totals(rows: pa.Table) -> tuple[list, np.ndarray, np.ndarray]:
    parts = [unpack(b) for b in rows["value"].to_pylist()]
    words = [np.cumsum(p["word"].to_numpy()) for p in parts]
    distinct, number = np.unique(np.concatenate(words), return_inverse=True)
    count = np.bincount(number, np.concatenate([p["n"].to_numpy() for p in parts]), len(distinct)).astype(np.int64)
    return words, distinct, count


def _best(rows: pa.Table) -> pa.Table:
    """One bucket's share of the totals and its most frequent words."""
    _, distinct, count = _totals(rows)
    top = np.lexsort((distinct, -count))[: CLASSES * CLASSES]
    top = top[count[top] > 0]
    return pa.table(
        {
            "word": np.append(distinct[top], -1),
            "n": np.append(count[top], count.sum()),
            "v": np.append(np.zeros(len(top), np.int64), (count > 0).sum()),
        }
    )


# -- model ------------------------------------------------------------------


class Vocabulary:
    """Numbers of the frequent words, given by descending count: class times
    CLASSES plus place, from class 1 on.  All others are RARE, in class 0."""

    def __init__(self, words: np.ndarray):
        order = np.argsort(words)
        self.words, self.number = words[order], CLASSES + order

    def of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(words), RARE)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.number[at], RARE)


def history(places: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the two words before each token, as one number, and the names
    of the places: the hashes of all words, in the end that of the blank before a
    text."""
    blank = len(words)
    starts = np.cumsum(sizes) - sizes
    one = np.concatenate([[blank], places[:-1]])
    one[starts] = blank
    two = np.concatenate([[blank], one[:-1]])
    two[starts] = blank
    return one * (blank + 1) + two, np.append(words.astype(np.uint64), ~np.uint64(0))


def features(before: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Hashes of the features (n x 3) of histories: the word before, both, the one
    before the last."""
    one, two = (names[x] for x in np.divmod(before, len(names)))
    x = np.stack([one * K[0], (one * K[1] ^ (two * K[2] << np.uint64(7))) * K[0], two * K[2]], 1)
    return x ^ (x >> np.uint64(29))


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def _chances(z: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Places of the softmax of scores."""
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    return z[row, column] / z.sum(1)[row]


def rows_of_classes(x: np.ndarray) -> np.ndarray:
    """Weight rows of the features for the classes."""
    return ((x * K[1] >> np.uint64(40)) % np.uint64(ROWS)).astype(np.int64)


def rows_of_words(x: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Weight rows of the features for the words of a class."""
    return (((x ^ (cls.astype(np.uint64) * K[0])[:, None]) * K[2] >> np.uint64(40)) % np.uint64(ROWS)).astype(np.int64)


def sums_of(values: np.ndarray, of: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows ``values[of]`` from each place in ``first`` to the next one, in
    another order, and that order.  They are np.add.reduceat's to the bit: it adds to a
    first value the sum of those after it, by eight sums side by side where there are
    eight to 128 of them.  Here runs of a like length go together, whole rows at a time."""
    after = np.diff(first, append=len(of)) - 1
    order = np.argsort(np.minimum(after, BLOCK + 1).astype(np.uint8), kind="stable")[::-1]
    first, after = first[order], after[order]
    total = values.take(of[first], 0)
    long, mid, some = (int(np.searchsorted(-after, -n, "left")) for n in (BLOCK, 7, 0))
    if long:
        length = after[:long] + 1
        start = np.cumsum(length) - length
        rows = values.take(of[np.arange(length.sum()) + np.repeat(first[:long] - start, length)], 0)
        total[:long] = np.add.reduceat(np.ascontiguousarray(rows.T), start, axis=1).T
    if long < mid:
        at, n = first[long:mid] + 1, after[long:mid]
        eight, left = n // 8, n % 8
        at8 = at[:, None] + np.arange(8)
        sums = values.take(of[at8], 0)
        for i in range(1, int(eight[0])):
            k = int(np.searchsorted(-eight, -i, "left"))
            sums[:k] += values.take(of[at8[:k] + 8 * i], 0)
        while sums.shape[1] > 1:
            sums = sums[:, ::2] + sums[:, 1::2]
        sums, at = sums[:, 0], at + 8 * eight
        for i in range(int(left.max())):
            more = np.flatnonzero(left > i)
            sums[more] += values.take(of[at[more] + i], 0)
        total[long:mid] += sums
    if mid < some:
        at, n = first[mid:some] + 1, after[mid:some]
        sums = values.take(of[at], 0)
        for i in range(1, int(n[0])):
            k = int(np.searchsorted(-n, -i, "left"))
            sums[:k] += values.take(of[at[:k] + i], 0)
        total[mid:some] += sums
    return total, order


class Model:
    """Weights and, while training, AdaGrad sums; row ROWS of each holds the bias
    (for words: rows ROWS + class)."""

    def __init__(self, classes: np.ndarray | None = None, words: np.ndarray | None = None):
        self.classes = np.zeros((ROWS + 1, CLASSES), np.float32) if classes is None else classes
        self.words = np.zeros((ROWS + CLASSES, CLASSES), np.float32) if words is None else words

    def terms(self, before: np.ndarray, word: np.ndarray, names: np.ndarray):
        """Distinct histories with the scores of the classes, and distinct pairs of
        history and class (not 0) with those of the class's words; for both, which
        one a token belongs to."""
        seen, which = np.unique(before, return_inverse=True)
        cls, place = word // CLASSES, word % CLASSES
        common = np.flatnonzero(cls)
        pairs, pair = np.unique(which[common] * CLASSES + cls[common], return_inverse=True)
        x, of = features(seen, names), pairs % CLASSES
        a = np.concatenate([rows_of_classes(x), np.full((len(x), 1), ROWS)], 1)
        b = np.concatenate([rows_of_words(x[pairs // CLASSES], of), (ROWS + of)[:, None]], 1)
        return which, cls, a, self._sum(self.classes, a), common, pair, place[common], b, self._sum(self.words, b)

    @staticmethod
    def _sum(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = weights.take(rows[:, 0], 0)
        for i in range(1, rows.shape[1]):
            out += weights.take(rows[:, i], 0)
        return out

    def log10(self, before: np.ndarray, word: np.ndarray, names: np.ndarray = NUMBERS) -> np.ndarray:
        out = np.empty(len(word))
        for i in range(0, len(word), STEP):
            which, cls, _, p, common, pair, place, _, q = self.terms(before[i : i + STEP], word[i : i + STEP], names)
            part = np.log10(np.maximum(_chances(p, which, cls), 1e-20)).astype(float)
            part[common] += np.log10(np.maximum(_chances(q, pair, place), 1e-20))
            out[i : i + STEP] = part
        return out


class Trainer(Model):
    def __init__(self):
        super().__init__()
        self.g_classes = np.full(self.classes.shape[0], 1e-3, np.float32)
        self.g_words = np.full(self.words.shape[0], 1e-3, np.float32)
        self.seen = 0

    def learn(self, before: np.ndarray, word: np.ndarray, names: np.ndarray = NUMBERS) -> None:
        """Steps over batches that grow with what has been seen: early steps are
        small and many, later ones share more work."""
        i = 0
        while i < len(word):
            step = min(STEP, max(1024, self.seen // 16))
            which, cls, a, p, common, pair, place, b, q = self.terms(before[i : i + step], word[i : i + step], names)
            i, self.seen = i + step, self.seen + step
            for weights, sums, rows, chance, of, target in (
                (self.classes, self.g_classes, a, p, which, cls),
                (self.words, self.g_words, b, q, pair, place),
            ):
                if len(rows):
                    _softmax(chance)
                    n = np.bincount(of, minlength=len(rows)).astype(np.float32)
                    chance *= n[:, None]
                    met, n = np.unique(of * CLASSES + target, return_counts=True)
                    flat = chance.reshape(-1)
                    flat[met] = flat[met].astype(float) - n
                    self._step(weights, sums, rows, chance)

    @staticmethod
    def _step(weights: np.ndarray, sums: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
        """AdaGrad with one pace per row; a row met several times takes the sum."""
        flat = rows.T.ravel().astype(np.uint16)  # so short numbers are sorted by their digits
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        of = np.tile(np.arange(len(gradient)), rows.shape[1])[order]
        total, order = sums_of(gradient, of, first)
        at = flat[first[order]]
        pace = sums[at] + (total * total).mean(1)
        sums[at] = pace
        total *= RATE
        total /= np.sqrt(pace)[:, None]
        weights[at] = np.subtract(weights.take(at, 0), total, out=total)


def _train(vocabulary: Vocabulary, blocks: int):
    """Weights of one task's training documents, in blocks of rows."""

    def rows(batches):
        model, n = Trainer(), 0
        for batch in batches:
            for value in batch.column("value").to_pylist():
                _, out, words, place, sizes = _open(value)
                numbers = vocabulary.of(words)[place]
                use = np.repeat(~out, sizes)
                before, names = history(place, sizes, words)
                model.learn(before[use], numbers[use], names)
                n += int(use.sum())
        if n:
            both = np.concatenate([model.classes, model.words]).astype(np.float16)
            parts = np.array_split(both, blocks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(blocks), pa.int32()),
                    pa.array([float(n)] * blocks),
                    pa.array([p.tobytes() for p in parts], pa.binary()),
                ],
                names=["block", "n", "value"],
            )

    return rows


def _rare_tokens(vocabulary: Vocabulary, buckets: int, hashes: np.ndarray, place: np.ndarray):
    """Where the tokens outside the vocabulary are, bucket by bucket in the order
    of the text, and the edges of the buckets."""
    rare, bucket = vocabulary.of(hashes) == RARE, bucket_of(hashes, buckets)
    at = np.flatnonzero(rare[place])
    of = bucket[place[at]]
    order = np.argsort(of, kind="stable")
    return at[order], np.searchsorted(of[order], np.arange(buckets + 1))


def _events(vocabulary: Vocabulary, buckets: int):
    """Of each run, per bucket: its distinct words with their training counts (kind 0);
    its tokens outside the vocabulary, as numbers among these words, each with 32 bits
    of the hashes of the two words before it, as numbers among all of them, and
    whether it is for training (kind 1)."""

    def rows(batches):
        for batch in batches:
            for run, value in zip(batch.column("run").to_pylist(), batch.column("value").to_pylist()):
                _, out, hashes, place, sizes = _open(value)
                use = np.repeat(~out, sizes)
                before, names = history(place, sizes, hashes)
                short = ((names * K[1]) >> np.uint64(32)).astype(np.uint32)
                at, edges = _rare_tokens(vocabulary, buckets, hashes, place)
                distinct, number, order, starts = _by_bucket(hashes, buckets)
                within = np.empty(len(distinct), np.int64)
                within[order] = np.arange(len(order)) - np.repeat(starts[:-1], np.diff(starts))
                number = within[number][place[at]].astype(np.int32)
                one, two = (short[x] for x in np.divmod(before[at], len(names)))
                found = [(b, 0, x) for b, x in _counted(out, hashes, place, sizes, buckets, 0)]
                for b in range(buckets):
                    s = slice(edges[b], edges[b + 1])
                    if edges[b] < edges[b + 1]:
                        words, pair = np.unique(np.concatenate([one[s], two[s]]), return_inverse=True)
                        pair = pair.astype(np.uint32).reshape(2, -1)
                        event = pa.table({**planes("word", number[s]), **planes("one", pair[0]), **planes("two", pair[1]), "use": use[at[s]]})
                        found += [(b, 1, pack(event)), (b, 2, pack(pa.table({"short": np.diff(words, prepend=np.uint32(0))})))]
                bucket, kind, values = zip(*found)  # every text has its end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket, pa.int32()), pa.array([run] * len(found), pa.int64()), pa.array(kind, pa.int32()), pa.array(values, pa.binary())],
                    names=["bucket", "run", "kind", "value"],
                )

    return rows


def _started(counts: np.ndarray, others: float) -> Trainer:
    """A model whose biases give shares of counts: of the words of a vocabulary in
    their order, and of all others together."""
    model = Trainer()
    table = np.full(CLASSES * CLASSES, 1e-6)
    table[CLASSES : CLASSES + len(counts)] = counts
    table = table.reshape(CLASSES, CLASSES)
    model.words[ROWS:] = np.log(table)
    total = table.sum(1)
    total[0] = others
    model.classes[ROWS] = np.log(total)
    return model


def _replies(vocabulary: Vocabulary, n_rare: int, v_rare: int, buckets: int):
    """One bucket's counts (kind 1) and the log10 probabilities of its words among
    those outside the vocabulary (kind 2), sent back to the runs that have them."""

    def rows(table: pa.Table) -> pa.Table:
        table = table.sort_by([("kind", "ascending"), ("run", "ascending")])
        bucket, kinds = table["bucket"][0].as_py(), table["kind"].to_numpy()
        of = [table.filter(pa.array(kinds == k)) for k in range(3)]
        runs = of[0]["run"].to_pylist()
        words, distinct, count = _totals(of[0])
        counts = [count[np.searchsorted(distinct, w)] for w in words]
        out = [(run, 1, pack(pa.table({"n": c}))) for run, c in zip(runs, counts)]
        keep = (vocabulary.of(distinct) == RARE) & (count > 0)
        n, v = int(count[keep].sum()), int(keep.sum())
        top = np.lexsort((distinct, -np.where(keep, count, 0)))[: CLASSES * (CLASSES - 1)]
        top = top[keep[top] & (count[top] >= LEAST)]
        local = Vocabulary(distinct[top])
        others = n - int(count[top].sum()) + v - len(top) + 1
        model = _started(count[top], others)
        share = np.log10((n + v + 1) / (n_rare + v_rare + buckets))
        of_run, given = dict(zip(runs, zip(words, counts))), []
        for run, value, short in zip(of[1]["run"].to_pylist(), of[1]["value"].to_pylist(), of[2]["value"].to_pylist()):
            part = unpack(value)
            word, use = from_planes(part, "word", np.int32), part["use"].to_numpy()
            names = np.cumsum(unpack(short)["short"].to_numpy(), dtype=np.uint32)
            before = from_planes(part, "one", np.uint32).astype(np.int64) * len(names) + from_planes(part, "two", np.uint32)
            number, c = local.of(of_run[run][0])[word], of_run[run][1][word]
            names = names.astype(np.uint64)
            model.learn(before[use], number[use], names)
            given.append((run, before, number, names, c))
        for run, before, number, names, c in given:
            p = share + model.log10(before, number, names) + np.where(number == RARE, np.log10((c + 1) / others), 0.0)
            out.append((run, 2, pack(pa.table(planes("p", p.astype(np.float32))))))
        run, kind, value = zip(*out)
        return pa.table(
            {
                "run": pa.array(run, pa.int64()),
                "kind": pa.array(kind, pa.int32()),
                "bucket": pa.array([bucket] * len(out), pa.int32()),
                "value": pa.array(value, pa.binary()),
            }
        )

    return rows


def _average(rows: pa.Table) -> pa.Table:
    n = rows["n"].to_numpy()
    total = sum(w * np.frombuffer(v, np.float16).astype(np.float32) for w, v in zip(n, rows["value"].to_pylist())) / n.sum()
    return pa.table({"block": rows["block"][:1], "value": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def _score(model: Model, vocabulary: Vocabulary, n: int, v: int, buckets: int):
    def rows(table: pa.Table) -> pa.Table:
        values = table["value"].to_pylist()
        kinds = table["kind"].to_pylist()
        ids, out, hashes, place, sizes = _open(next(b for b, k in zip(values, kinds) if k == 0))
        answers = sorted(zip(kinds, table["bucket"].to_pylist(), range(len(values))))
        counts = [unpack(values[i])["n"].to_numpy() for k, _, i in answers if k == 1]
        distinct, of, order, _ = _by_bucket(hashes, buckets)
        count = np.empty(len(distinct), np.int64)
        count[order] = np.concatenate(counts)
        c = count[of][place]
        first = np.cumsum(sizes) - sizes
        add = lambda a: np.add.reduceat(a, first)  # noqa: E731  every text has its end
        number = vocabulary.of(hashes)[place]
        before, names = history(place, sizes, hashes)
        own = model.log10(before, number, names)
        at, _ = _rare_tokens(vocabulary, buckets, hashes, place)
        if len(at):
            own[at] += np.concatenate([from_planes(unpack(values[i]), "p", np.float32) for k, _, i in answers if k == 2])
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": out,
                "n_tokens": sizes,
                "n_known": add((c > 0).astype(np.int64)),
                "train_tokens": np.full(len(sizes), n, np.int64),
                "base_score": add(np.log10((c + 1.0) / (n + v + 1.0))),
                "score": add(own),
            }
        )

    return rows


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of
    every document."""
    buckets = int(max(32, text_bytes(docs) // BUCKET_BYTES))
    runs = runs_of(docs)
    asked = runs.mapInArrow(_requests(buckets), "bucket int, value binary")
    # at most 1024 words and one row of totals from each bucket
    best = written(asked.groupBy("bucket").applyInArrow(_best, "word bigint, n bigint, v bigint"), "frequent")
    n, v = best.filter("word = -1").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).head()
    top = best.filter("word >= 0").orderBy(F.desc("n"), "word").limit(CLASSES * (CLASSES - 1)).toArrow()
    end = word_hash(END)
    frequent = top["word"].to_numpy()
    if len(frequent) and end not in frequent:
        frequent[-1:] = end
    counts = dict(zip(top["word"].to_pylist(), top["n"].to_pylist()))
    n_rare = n - sum(counts.get(w, 0) for w in frequent.tolist())
    vocabulary = Vocabulary(frequent)
    blocks = 64
    weights = (
        runs.mapInArrow(_train(vocabulary, blocks), "block int, n double, value binary")
        .groupBy("block")
        .applyInArrow(_average, "block int, value binary")
    )
    # the weights have a fixed size, whatever the input's
    flat = b"".join(bytes(r["value"]) for r in sorted(weights.collect(), key=lambda r: r["block"]))
    both = np.frombuffer(flat, np.float32).reshape(-1, CLASSES)
    model = Model(both[: ROWS + 1], both[ROWS + 1 :]) if len(both) else Model()
    events = runs.mapInArrow(_events(vocabulary, buckets), "bucket int, run bigint, kind int, value binary")
    v_rare = v - len(frequent)
    replies = events.groupBy("bucket").applyInArrow(
        _replies(vocabulary, n_rare, v_rare, buckets), "run bigint, kind int, bucket int, value binary"
    )
    rows = runs.select("run", F.lit(0).alias("kind"), F.lit(-1).alias("bucket"), "value").unionByName(replies)
    return rows.groupBy("run").applyInArrow(
        _score(model, vocabulary, n, v, buckets),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
