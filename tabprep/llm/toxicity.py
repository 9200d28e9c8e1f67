"""Toxicity: subword-bag embeddings under a linear softmax, trained in numpy.

A word's vector is the mean of the vectors of its character n-grams (hashed
into a fixed number of buckets), a text's vector the mean of its words'
vectors, and a linear softmax over it gives the class.  n-gram vectors and
softmax are trained jointly (Adagrad over batches of texts, a few starts
averaged), so a misspelling that was never seen still shares most n-grams with
the word it hides.

Fitting uses a bounded sample of labelled rows: at most ``sample_rows`` rows in
the order of a hash of their id, and at most ``sample_bytes`` bytes of text
(whole texts; a text that does not fit is left out).  Both are parameters.
Scoring covers every row.  Because averaging and the last layer are linear, a
word adds a fixed amount to the margin; a worker computes it once per distinct
word and keeps it in a bounded cache.

Defined results: a null or empty text scores as the softmax of the bias; a
table without both classes in its training rows scores the share of toxic rows
(0 if there are none); labels without a document and null labels are ignored;
an id labelled more than once is toxic if any row says so; repeated rows repeat.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm.common import fold, give_back, lean, require, with_row, words_of

FOLDS = 5
GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 17
DIM = 4
EPOCHS = 8
#: Steps at least; small samples are read more often.
LEAST_STEPS = 640
BATCH = 50
#: Texts of the sample whose words a bucket needs to occur in.
LEAST_TEXTS = 5
#: Zero vectors that every text's mean holds besides: a single odd word decides nothing.
PAD = 20.0
#: Models from different starts that are averaged.
MEMBERS = 3
#: Weight of a word that occurs k times.
DAMPED = [0.0] + [1 + math.log(k) for k in range(1, 256)]
RATE = 1.0
#: Factor on a text's mean, which a few telling words among hundreds move little.
SCALE = 100.0
SEED = 7
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 24 << 20
#: Words of a task's cache, and texts scored together.
CACHE_WORDS = 100_000
SLICE_ROWS = 256
#: Factor of the n-grams' rolling hash.
PRIME = np.uint32(0x01000193)


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character n-grams and of the whole words, their ends
    marked, and the number of the word that each belongs to."""
    marked = ["<" + w.decode("utf-8", "replace") + ">" for w in words]
    code = np.frombuffer("".join(marked).encode("utf-32-le"), dtype="<u4")
    size = np.array([len(m) for m in marked], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
    left = np.repeat(start + size, size) - np.arange(len(code))  # characters up to the word's end
    found, names = [], []
    rolled = np.zeros(len(code), np.uint32)
    for n in range(1, GRAMS[-1] + 1):
        ahead = np.zeros(len(code), np.uint32)
        ahead[:len(code) - n + 1] = code[n - 1:]
        rolled = rolled * PRIME + ahead
        if n >= GRAMS[0]:
            fits = left >= n
            found.append(mixed(rolled[fits] + np.uint32(n)))
            names.append(owner[fits])
            short = np.flatnonzero(size == n)  # the n-gram is the whole word: it counts twice
            found.append(mixed(rolled[start[short]] + np.uint32(n)))
            names.append(short.astype(np.int32))
    if len(words):
        power = np.multiply.accumulate(np.full(int(size.max()), PRIME, np.uint32))
        whole = np.add.reduceat(code * power[np.arange(len(code)) - np.repeat(start, size)], start, dtype=np.uint32)
        longer = np.flatnonzero(size > GRAMS[-1])
        found.append(mixed(whole[longer]))
        names.append(longer.astype(np.int32))
    return np.concatenate(found), np.concatenate(names)


def mixed(x: np.ndarray) -> np.ndarray:
    """Buckets of 32-bit numbers (a finalising mix of xors and odd products)."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return ((x ^ (x >> np.uint32(16))) & np.uint32(BUCKETS - 1)).astype(np.int32)


@dataclass
class Model:
    """Margin that each bucket adds (class 1 minus class 0) and the bias; the
    product of the trained n-gram vectors and the softmax weights."""

    bucket: np.ndarray
    bias: float


def index_type(size: int) -> type:
    """The smallest type that numbers up to ``size`` fit."""
    return next((t for t in (np.uint8, np.uint16, np.int32) if size <= np.iinfo(t).max), np.int64)


@dataclass
class Batch:
    """Texts of one training step: text x word and word x bucket as sorted
    coordinate lists, each with the order that sums it the other way."""

    y: np.ndarray
    doc: np.ndarray
    word: np.ndarray
    share: np.ndarray
    gram_word: np.ndarray
    bucket: np.ndarray
    inverse: np.ndarray

    def __post_init__(self) -> None:
        self.used, self.bucket = np.unique(self.bucket, return_inverse=True)
        self.full, self.doc_at = np.unique(self.doc, return_index=True)
        self.spelt, self.word_at = np.unique(self.gram_word, return_index=True)
        self.by_word = np.argsort(self.word, kind="stable")
        self.use_at = np.searchsorted(self.word[self.by_word], np.arange(len(self.inverse)))
        by_bucket = np.argsort(self.bucket, kind="stable")
        self.bucket_word = self.gram_word[by_bucket].astype(index_type(len(self.inverse)))
        self.bucket_at = np.searchsorted(self.bucket[by_bucket], np.arange(len(self.used)))
        self.gram_word = np.zeros(0, np.int32)
        for name, end in (("bucket", len(self.used)), ("word", len(self.inverse)), ("doc", len(self.y)), ("by_word", len(self.word)),
                          ("use_at", len(self.word)), ("word_at", len(self.bucket)), ("bucket_at", len(self.bucket))):
            setattr(self, name, getattr(self, name).astype(index_type(end)))  # the fit holds all batches

    def step(self, grid: np.ndarray, soft: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, ...]:
        """Gradients of the softmax loss by used bucket, softmax and bias."""
        vector = np.zeros((len(self.inverse), DIM), np.float32)
        if len(self.used):
            vector[self.spelt] = np.add.reduceat(grid[self.used][self.bucket], self.word_at, axis=0)
        vector *= self.inverse
        mean = np.zeros((len(self.y), DIM), np.float32)
        if len(self.full):
            mean[self.full] = np.add.reduceat(vector[self.word] * self.share, self.doc_at, axis=0)
        mean *= SCALE
        logits = mean @ soft + bias
        prob = np.exp(logits - logits.max(axis=1, keepdims=True))
        prob /= prob.sum(axis=1, keepdims=True)
        slope = ((prob - np.eye(2)[self.y]) / len(self.y)).astype(np.float32)
        to_grid = np.zeros((0, DIM), np.float32)
        if len(self.used):
            to_mean = SCALE * (slope @ soft.T)
            to_use = to_mean[self.doc[self.by_word]] * self.share[self.by_word]
            to_word = np.add.reduceat(to_use, self.use_at, axis=0) * self.inverse
            to_grid = np.add.reduceat(to_word[self.bucket_word], self.bucket_at, axis=0)
        return to_grid, mean.T @ slope, slope.sum(axis=0)


def batches(texts: list[str], y: np.ndarray) -> Iterator[Batch]:
    """The sample cut into steps; words and n-grams are held as numbers."""
    number: dict[bytes, int] = {}
    bags = []
    for text in texts:
        bag = Counter(words_of(text))
        bags.append((np.array([number.setdefault(w, len(number)) for w in bag], dtype=np.int32),
                     1 + np.log(np.array(list(bag.values()), dtype=np.float32))))
    parts, names, words = [], [], list(number)
    del number
    for at in range(0, len(words), 20_000):
        found, name = grams(words[at:at + 20_000])
        order = np.argsort(name, kind="stable")
        parts.append(found[order])
        names.append(np.bincount(name, minlength=len(words[at:at + 20_000])))
    buckets = np.concatenate(parts + [np.zeros(0, np.int32)])
    size = np.concatenate(names + [np.zeros(0, np.int64)])
    del parts, words
    first = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
    texts_of = np.bincount(np.concatenate([ids for ids, _ in bags]), minlength=len(size))
    held = np.zeros(BUCKETS)
    for at in range(0, len(size), 50_000):  # in parts: the weights of all n-grams would be large
        part = slice(at, at + 50_000)
        end = first[part][-1] + size[part][-1]
        held += np.bincount(buckets[first[at]:end], weights=np.repeat(texts_of[part], size[part]), minlength=BUCKETS)
    held = held >= LEAST_TEXTS
    for at in range(0, len(bags), BATCH):
        own = bags[at:at + BATCH]
        doc = np.repeat(np.arange(len(own)), [len(ids) for ids, _ in own])
        used, word = np.unique(np.concatenate([ids for ids, _ in own]), return_inverse=True)
        share = np.concatenate([s / (s.sum() + PAD) for _, s in own])[:, None]
        n = size[used]
        gram_word = np.repeat(np.arange(len(used), dtype=np.int32), n)
        bucket = buckets[np.repeat(first[used] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] if len(used) else buckets[:0]
        kept = held[bucket]  # a bucket of few texts says little: it stays zero
        yield Batch(y[at:at + BATCH], doc, word, share, gram_word[kept], bucket[kept], 1 / n[:, None].astype(np.float32))


def fit(texts: list[str], toxic: list[int], epochs: int = EPOCHS) -> Model:
    """Joint training on whole texts with Adagrad over batches of texts."""
    y = np.array(toxic, dtype=np.int64)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        bias = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Model(np.zeros(BUCKETS, np.float32), bias)
    order = np.random.default_rng(SEED).permutation(len(y))
    steps = list(batches([texts[k] for k in order], y[order]))
    give_back()  # what cutting the steps took
    epochs = max(epochs, -(-LEAST_STEPS // len(steps)))
    # margins are linear, so members that start elsewhere average into one model
    members = [train(steps, epochs, SEED + k) for k in range(MEMBERS)]
    return Model(np.mean([m.bucket for m in members], axis=0), float(np.mean([m.bias for m in members])))


def train(steps: list[Batch], epochs: int, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    grid = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft, bias = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen, seen_soft, seen_bias = np.full((BUCKETS, DIM), 1e-8, np.float32), np.full_like(soft, 1e-8), np.full(2, 1e-8)
    touched = np.zeros(BUCKETS, bool)
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for k in rng.permutation(len(steps)):
            b = steps[k]
            g, gs, gb = b.step(grid, soft, bias)
            touched[b.used] = True
            seen[b.used] += g * g
            grid[b.used] -= rate * g / np.sqrt(seen[b.used])
            seen_soft += gs * gs
            soft = (soft - rate * gs / np.sqrt(seen_soft)).astype(np.float32)
            seen_bias += gb * gb
            bias = (bias - rate * gb / np.sqrt(seen_bias)).astype(np.float32)
    out = SCALE * (grid @ (soft[:, 1] - soft[:, 0]))
    return Model(np.where(touched, out, 0).astype(np.float32), float(bias[1] - bias[0]))


class Margins(dict):
    """Margin of each word that a task has met; it starts anew when full."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def learn(self, words: set[bytes]) -> None:
        if len(self) + len(words) > CACHE_WORDS:
            self.clear()
        new = list(words)
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            bucket, owner = grams(part)
            total = np.bincount(owner, weights=self.model.bucket[bucket], minlength=len(part))
            self.update(zip(part, (total / np.bincount(owner, minlength=len(part))).tolist()))

    def probabilities(self, texts: list[str | None]) -> list[float]:
        """Scores of whole texts; each new word is worked out once for all."""
        bags = [Counter(words_of(text)) for text in texts]
        words = {w for bag in bags for w in bag}
        if len(self) + len(words) > CACHE_WORDS:
            self.clear()
        self.learn({w for w in words if w not in self})
        out = []
        for bag in bags:
            margin = self.model.bias
            if bag:
                damped = [DAMPED[c] if c < len(DAMPED) else 1 + math.log(c) for c in bag.values()]
                margin += sum(map(mul, damped, map(self.__getitem__, bag))) / (sum(damped) + PAD)
            out.append(1 / (1 + math.exp(-margin)) if margin > -700 else 0.0)
        return out


def training_sample(docs: DataFrame, labels: DataFrame, sample_rows: int, sample_bytes: int) -> DataFrame:
    """``doc_id, toxic, text`` of the bounded sample of training rows.  The
    driver sees at most ``sample_rows`` ids and sizes, no text."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(fold(F.col("doc_id"), FOLDS) != 0)
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)  # a bounded number of ids
    sizes = (own.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic")
             .agg(F.max(F.octet_length("text")).alias("size")).collect())
    sizes.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id))
    chosen, total = [], 0
    for row in sizes:
        if total + row.size <= sample_bytes:
            chosen.append((row.doc_id, int(row.toxic > 0)))
            total += row.size
    held = docs.sparkSession.createDataFrame(chosen, "doc_id long, toxic int")
    return own.join(F.broadcast(held), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``df`` with the probability of the toxic class; a column of that name (in
    any case) is replaced, all others, whatever their names, pass through."""
    kept = [c for c in df.columns if c.lower() != score_col.lower()]
    held = with_row(df, text=F.col(f"`{text_col}`").cast("string"))
    schema = T.StructType([held.schema["row"], T.StructField("score", T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast((model.bucket.tobytes(), model.bias))  # BUCKETS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, bias = shared.value
        margins = Margins(Model(np.frombuffer(bucket, np.float32), bias))  # the task's own
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                found = margins.probabilities(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["row", "score"])

    scored = held.mapInArrow(lean(run), schema)
    return scored.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("score").alias(score_col))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on the bounded sample, in one task; the driver gets the model."""
    require(docs, ["doc_id", "text"])
    require(labels, ["doc_id", "toxic"])

    def train(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for part in parts for r in zip(*(part.column(k).to_pylist() for k in range(3))))
        model = fit([r[2] for r in rows], [r[1] for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array([model.bucket.tobytes()], pa.binary()), pa.array([model.bias])],
                                         names=["bucket", "bias"])

    sample = training_sample(docs, labels, sample_rows, sample_bytes)
    row = sample.coalesce(1).mapInArrow(lean(train), "bucket binary, bias double").first()
    return Model(np.frombuffer(row.bucket, np.float32), row.bias) if row else fit([], [])


def classify(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = learn(docs, labels, **bounds)
    scored = score(docs.select(F.col("doc_id"), F.col("text")), model)
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
