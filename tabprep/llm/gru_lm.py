"""Language-model scoring: a gated recurrent network in numpy.

*Counts.*  One pass counts every word of the training documents (and one end
per document).  They give the smoothed unigram score that every text gets as
its base score.

*Model.*  A GRU reads the words; its state gives the next word's class and the
word within its class (class-factored softmax).  The ``KNOWN`` most frequent
words are spread over ``CLASSES`` classes; all others are one more class,
inside which the smoothed unigram counts decide, so every word has a
probability.  Biases start from the counts.

*Training* covers all training documents once: they are dealt into ``ROUNDS``
disjoint parts; in each round every Spark partition trains on its share of that
part by truncated backpropagation (windows of ``WINDOW`` words over ``STREAMS``
parallel streams, the state carried from window to window), and the partitions'
weights are averaged, weighted by words, with a partially aggregated sum.

*Scoring* runs whole documents of a batch side by side, sorted by length; the
state is carried across windows to the last word, nothing is cut.  The counts
of the ``HEAD`` most frequent words travel with the model; rarer words are
looked up by a join on the word.

Defined results: a null text is empty (its only token is the end); a null id is
held out; rows that repeat id and text repeat their result; without training
documents every count is zero and the model is its start; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import fold, importable, require, stage, words_of

FOLDS = 10
HIDDEN = 12
KNOWN = 1023
CLASSES = 24
#: Frequent words whose counts travel with the model.
HEAD = 200_000
ROUNDS = 2
STREAMS = 512
WINDOW = 16
RATE = 0.03
#: Smoothing of the counts (fixed by the base score's definition).
ALPHA = 0.1
#: The end of a text among the counted words; no word is empty.
END = b""
#: Words between two visits of the output layer when scoring, and steps at most.
OUTPUT_WORDS = 16_384
STRIDE = 256
#: Texts that run side by side: fewer would leave the steps mostly empty.
BATCH_TEXTS = 10_000
#: Texts whose words are numbered together.
SLICE_ROWS = 256
#: Bins per octave of the histogram that finds the frequent words.
BINS = 64


@dataclass
class Vocabulary:
    """Frequent words: number 0 is the end, ``len(words)`` stands for the rest.
    ``start[k]`` is the first word of class k; words are sorted by class."""

    words: list[bytes]
    start: np.ndarray
    prior: np.ndarray  # log probability of each class, the rest last
    inside: np.ndarray  # log probability of each word inside its class
    number: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.number = {w: k for k, w in enumerate(self.words)}
        self.cls = np.append(np.searchsorted(self.start, np.arange(len(self.words)), side="right") - 1, len(self.start) - 1)


def vocabulary(top: list[tuple[bytes, int]], total: int, classes: int = CLASSES) -> Vocabulary:
    """Classes of about equal root mass over the most frequent words."""
    words = [END] + [w for w, _ in top if w != END]
    counts = np.array([dict(top).get(w, 0) for w in words], dtype=np.float64) + ALPHA
    mass = np.cumsum(np.sqrt(counts))
    cls = np.minimum((mass / mass[-1] * classes - 1e-9).astype(int), classes - 1)
    cls = np.unique(cls, return_inverse=True)[1]
    start = np.append(np.searchsorted(cls, np.arange(cls[-1] + 1)), len(words))
    by_class = np.add.reduceat(counts, start[:-1])
    rest = max(total - counts.sum(), 0) + ALPHA
    prior = np.log(np.append(by_class, rest) / (by_class.sum() + rest))
    return Vocabulary(words, start, prior, np.log(counts / by_class[cls]))


# --------------------------------------------------------------------- model
def fresh(v: Vocabulary) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(11)
    n, h = len(v.words), HIDDEN
    p = {"wx": rng.normal(0, 0.1, (n + 1, 3 * h)), "u": rng.normal(0, 1 / np.sqrt(h), (h, 3 * h)), "b": np.zeros(3 * h),
         "wc": np.zeros((h, len(v.start))), "bc": v.prior, "ww": np.zeros((n, h)), "bw": v.inside}
    return {k: np.ascontiguousarray(x, dtype=np.float32) for k, x in p.items()}


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def shaped(vector: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = np.ascontiguousarray(vector[at:at + like[k].size].reshape(like[k].shape), dtype=np.float32)
        at += like[k].size
    return out


def advance(p: dict[str, np.ndarray], gates: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One GRU step: new state, update and reset gates, candidate, its input."""
    k = HIDDEN
    hu = h @ p["u"]
    zr = gates[:, :2 * k] + hu[:, :2 * k]
    np.negative(zr, out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    z, r, inner = zr[:, :k], zr[:, k:], hu[:, 2 * k:]
    n = np.tanh(gates[:, 2 * k:] + r * inner)
    return n + z * (h - n), z, r, n, inner


def by_class(v: Vocabulary, target: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Positions of the targets of each class, the rest's left out."""
    cls = v.cls[target]
    order = np.argsort(cls, kind="stable")
    cuts = np.searchsorted(cls[order], np.arange(len(v.start)))
    for k in range(len(v.start) - 1):
        if cuts[k] < cuts[k + 1]:
            yield int(v.start[k]), int(v.start[k + 1]), order[cuts[k]:cuts[k + 1]]


def settled(logits: np.ndarray) -> np.ndarray:
    """The logits moved, in place, to where their exponentials are safe: by one
    number where their range allows it, else row by row."""
    high = logits.max()
    logits -= high if high - logits.min() < 60 else logits.max(axis=1, keepdims=True)
    return logits


def row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def log_probability(p: dict[str, np.ndarray], v: Vocabulary, states: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log probability of each target (of the rest: of their class)."""
    logits = settled(states @ p["wc"] + p["bc"])
    out = logits[np.arange(len(target)), v.cls[target]]
    out -= np.log(row_sums(np.exp(logits, out=logits)))
    for lo, hi, rows in by_class(v, target):
        if hi - lo > 1:
            logits = settled(states[rows] @ p["ww"][lo:hi].T + p["bw"][lo:hi])
            own = logits[np.arange(len(rows)), target[rows] - lo]
            out[rows] += own - np.log(row_sums(np.exp(logits, out=logits)))
    return out


def output_gradient(p: dict, v: Vocabulary, states: np.ndarray, target: np.ndarray, g: dict) -> np.ndarray:
    """Adds the output layer's gradients to ``g``; returns those of the states."""
    prob = settled(states @ p["wc"] + p["bc"])
    np.exp(prob, out=prob)
    prob /= row_sums(prob)[:, None]
    prob[np.arange(len(target)), v.cls[target]] -= 1
    g["wc"] += states.T @ prob
    g["bc"] += prob.sum(axis=0)
    back = prob @ p["wc"].T
    for lo, hi, rows in by_class(v, target):
        if hi - lo > 1:
            own = states[rows]
            prob = settled(own @ p["ww"][lo:hi].T + p["bw"][lo:hi])
            np.exp(prob, out=prob)
            prob /= row_sums(prob)[:, None]
            prob[np.arange(len(rows)), target[rows] - lo] -= 1
            g["ww"][lo:hi] += prob.T @ own
            g["bw"][lo:hi] += prob.sum(axis=0)
            back[rows] += prob @ p["ww"][lo:hi]
    return back


class Trainer:
    """Truncated backpropagation with Adagrad over parallel streams."""

    def __init__(self, p: dict[str, np.ndarray], v: Vocabulary):
        self.p, self.v = {k: x.copy() for k, x in p.items()}, v
        self.seen = {k: np.full_like(x, 1e-7) for k, x in p.items()}
        self.words = 0

    def learn(self, tokens: np.ndarray) -> None:
        """``tokens``: texts one after the other, each closed by the end."""
        streams = max(1, min(STREAMS, len(tokens) // WINDOW))
        length = len(tokens) // streams
        grid = tokens[:streams * length].reshape(streams, length).T
        h = np.zeros((streams, HIDDEN), np.float32)
        for at in range(0, length, WINDOW):
            h = self.window(np.ascontiguousarray(grid[at:at + WINDOW]), h)
        left = tokens[streams * length:]
        if len(left):  # fewer words than streams: one more short stream
            self.window(np.ascontiguousarray(left[:, None]), np.zeros((1, HIDDEN), np.float32))
        self.words += len(tokens)

    def window(self, ids: np.ndarray, h: np.ndarray) -> np.ndarray:
        p, v, k = self.p, self.v, HIDDEN
        steps, streams = ids.shape
        states = np.empty((steps, streams, k), np.float32)
        kept = []
        for t in range(steps):
            states[t] = h
            h, *rest = advance(p, p["wx"][ids[t]] + p["b"], h)
            h[ids[t] == 0] = 0  # a new text begins
            kept.append(rest)
        g = {name: np.zeros_like(x) for name, x in p.items()}
        out = output_gradient(p, v, states.reshape(-1, k), ids.ravel(), g).reshape(states.shape)
        to_gates = np.empty((steps, streams, 3 * k), np.float32)
        to_h = np.zeros((streams, k), np.float32)
        for t in range(steps - 1, -1, -1):
            z, r, n, inner = kept[t]
            to_h[ids[t] == 0] = 0
            a = to_h * (1 - z) * (1 - n * n)
            d = to_gates[t]
            d[:, :k] = to_h * (states[t] - n) * z * (1 - z)
            d[:, k:2 * k] = a * inner * r * (1 - r)
            d[:, 2 * k:] = a
            inward = d.copy()
            inward[:, 2 * k:] *= r
            g["u"] += states[t].T @ inward
            to_h = to_h * z + inward @ p["u"].T + out[t]
        rows = to_gates.reshape(-1, 3 * k)
        g["b"] += rows.sum(axis=0)
        word = ids.ravel()
        order = np.argsort(word, kind="stable")
        used, first = np.unique(word[order], return_index=True)
        g["wx"][used] = np.add.reduceat(rows[order], first, axis=0)
        for name, x in g.items():
            x /= steps * streams
            self.seen[name] += x * x
            p[name] -= RATE * x / np.sqrt(self.seen[name])
        return h


def score_texts(p: dict, v: Vocabulary, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of whole texts (word numbers, the end last),
    run side by side; the state goes on from window to window."""
    total = np.zeros(len(texts))
    order = np.argsort([-len(x) for x in texts], kind="stable")
    sizes = np.array([len(texts[k]) for k in order])
    if not len(sizes):
        return total
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    joined = np.concatenate([texts[k] for k in order])
    h = np.zeros((len(texts), HIDDEN), np.float32)
    sums = np.zeros(len(texts))
    # how many texts are longer than t, for every t
    longer = len(sizes) - np.cumsum(np.bincount(sizes, minlength=sizes[0] + 1))
    at = 0
    while at < sizes[0]:
        states, targets, owner = [], [], []
        stop = min(at + max(8, min(STRIDE, OUTPUT_WORDS // int(longer[at]))), int(sizes[0]))
        for t in range(at, stop):
            alive = int(longer[t])
            ids = joined[starts[:alive] + t]
            states.append(h[:alive])
            targets.append(ids)
            owner.append(np.arange(alive))
            h = advance(p, p["wx"][ids] + p["b"], h[:alive])[0]
        logs = log_probability(p, v, np.concatenate(states), np.concatenate(targets))
        sums += np.bincount(np.concatenate(owner), weights=logs, minlength=len(sums))
        at = stop
    total[order] = sums
    return total


# --------------------------------------------------------------------- Spark
def numbers(v: Vocabulary, words: list[bytes]) -> np.ndarray:
    """Word numbers of a text, the end last."""
    get, rest = v.number.get, len(v.words)
    return np.array([get(w, rest) for w in words] + [0], dtype=np.int32)


def count_words(docs: DataFrame) -> DataFrame:
    """``word, c`` over the training documents, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                                              names=["word", "c"])

        for batch in batches:
            for text in batch.column(0):
                found.update(words_of(text.as_py()))
            found[END] += batch.num_rows
            if len(found) > 500_000:
                yield out()
                found.clear()
        yield out()

    return docs.where("NOT held_out").select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def train(docs: DataFrame, v: Vocabulary) -> dict[str, np.ndarray]:
    """All training documents once, in ``ROUNDS`` parts."""
    p = fresh(v)
    spark = docs.sparkSession
    for part in range(ROUNDS):
        shared = spark.sparkContext.broadcast((p, v))  # KNOWN words and their weights

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, known = shared.value
            trainer, held, size = Trainer(start, known), [], 0
            for batch in batches:
                for text in batch.column(0):
                    held.append(numbers(known, words_of(text.as_py())))
                    size += len(held[-1])
                    if size >= 2_000_000:
                        trainer.learn(np.concatenate(held))
                        held, size = [], 0
            if held:
                trainer.learn(np.concatenate(held))
            if trainer.words:
                yield pa.RecordBatch.from_arrays([
                    pa.array([float(trainer.words)]), pa.array([flat(trainer.p)], pa.list_(pa.float32()))], names=["w", "x"])

        own = docs.where("NOT held_out").where(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == part).select("text")
        each = own.mapInArrow(run, "w double, x array<float>").select("w", F.posexplode("x").alias("k", "x"))
        mean = each.groupBy("k").agg((F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("x")).orderBy("k").collect()
        if mean:
            p = shaped(np.array([r.x for r in mean]), p)
    return p


def frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words with their counts, at most ``most``: all words
    above a count that a histogram of bounded size finds."""
    place = F.floor(F.log2("c") * BINS).cast("int")
    bins = counts.groupBy(place.alias("k")).count().collect()  # BINS per octave of the counts
    room, lowest = most, None
    for row in sorted(bins, key=lambda r: -r.k):
        room -= row["count"]
        if room < 0:
            break
        lowest = row.k
    if lowest is None:
        return []
    found = counts.where(place >= lowest).collect()  # at most ``most`` words
    return sorted(((bytes(r.word), r.c) for r in found), key=lambda x: (-x[1], x[0]))


class Numbers(dict):
    """Number of each frequent word; ``rest`` for all others."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(len(words))))
        self.rest = len(words)

    def __missing__(self, word: bytes) -> int:
        return self.rest


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Contract columns of every row; see the module's text."""
    require(docs, [id_col, text_col])
    spark = docs.sparkSession
    importable(spark, batch_rows=BATCH_TEXTS)
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")).withColumn(
        "held_out", fold(F.col("doc_id"), FOLDS) == 0)
    counts = stage(count_words(own))
    total, distinct = (int(x or 0) for x in counts.agg(F.sum("c"), F.count("*")).first())
    head = frequent(counts, HEAD)
    v = vocabulary(head[:KNOWN], total)
    p = train(own, v)
    table = dict(head)
    inside = sum(table.get(w, 0) for w in v.words)
    base_all = total + ALPHA * (distinct + 1)
    rest_all = (total - inside) + ALPHA * (distinct - sum(w in table for w in v.words) + 1)
    order = v.words + [w for w, _ in head if w not in v.number]
    c = np.array([table.get(w, 0) for w in order] + [0], dtype=np.float64)
    shared = spark.sparkContext.broadcast((p, v, order, c))  # HEAD words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, vocab, words_in_order, c = shared.value
        number, known = Numbers(words_in_order), len(vocab.words)
        base, tail, hit = np.log10((c + ALPHA) / base_all), np.log10((c + ALPHA) / rest_all), (c > 0).astype(np.int64)
        base[-1] = tail[-1] = 0  # rare words are looked up by the join
        tail[:known] = 0
        for whole in batches:
            texts, parts = [], []
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                sizes, flat, rare = [], [], []
                for doc, key, text in zip(ids, keys, batch.column(2)):
                    words = words_of(text.as_py())
                    own = np.array([*map(number.__getitem__, words), 0], dtype=np.int32)
                    away = np.flatnonzero(own == number.rest)
                    rare += [(doc, key, w, n) for w, n in Counter([words[i] for i in away.tolist()]).items()]
                    sizes.append(len(own))
                    flat.append(own)
                    texts.append(np.minimum(own, known))
                joined, starts = np.concatenate(flat), np.concatenate([[0], np.cumsum(sizes)[:-1]])
                parts.append((ids, keys, sizes, *[np.add.reduceat(x[joined], starts) for x in (hit, base, tail)]))
                if rare:
                    d, k, w, n = zip(*rare)
                    zeros = pa.array(np.zeros(len(d), np.int64))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(d, pa.int64()), pa.array(k, pa.int64()), pa.array(w, pa.binary()), pa.array(n, pa.int64()),
                        zeros, zeros, zeros, pa.array(np.zeros(len(d))), pa.array(np.zeros(len(d)))], names=NAMES)
            logs, at = score_texts(weights, vocab, texts) / np.log(10), 0
            for ids, keys, sizes, hits, based, tailed in parts:
                # a text's own row looks up a name that no word has, its own
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(keys, pa.int64()),
                    pa.array([f" {a} {b}".encode() for a, b in zip(ids, keys)], pa.binary()),
                    pa.array(np.zeros(len(ids), np.int64)), pa.array(np.ones(len(ids), np.int64)), pa.array(sizes, pa.int64()),
                    pa.array(hits), pa.array(based), pa.array(tailed + logs[at:at + len(ids)])], names=NAMES)
                at += len(ids)

    rows = own.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text").mapInArrow(run, SCHEMA)
    n = F.coalesce("c", F.lit(0))
    looked = rows.join(counts.where("word != X''"), "word", "left").select(
        "doc_id", "key", "copies", "tokens",
        (F.col("hits") + F.when(n > 0, F.col("n")).otherwise(0)).alias("hits"),
        (F.col("base") + F.col("n") * F.log10((n + ALPHA) / base_all)).alias("base"),
        (F.col("score") + F.col("n") * F.log10((n + ALPHA) / rest_all)).alias("score"))
    sums = looked.groupBy("doc_id", "key").agg(*[F.sum(x).alias(x) for x in ("copies", "tokens", "hits", "base", "score")])
    each = F.col("copies")
    return sums.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), each))).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), (F.col("tokens") / each).cast("long").alias("n_tokens"),
        (F.col("hits") / each).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / each).alias("base_score"), (F.col("score") / each).alias("score"))


NAMES = ["doc_id", "key", "word", "n", "copies", "tokens", "hits", "base", "score"]
SCHEMA = "doc_id long, key long, word binary, n long, copies long, tokens long, hits long, base double, score double"
