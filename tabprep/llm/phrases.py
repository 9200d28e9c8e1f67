"""Phrase collocations by best-first branch-and-bound growth.

A phrase of two to five words that occurs often enough is scored by its worst
cut, floor(1000 a n / (l r)).  A cut after the first word has l = the count of
that word and r >= a, so no phrase that starts with a word of count c scores
more than floor(1000 n / c); the same holds for its last word.  These bounds
order the search: the rarest words that are frequent enough come first.  A round
expands a frontier of words, all up to a count, into the phrases that start or
end with one: pairs first, then longer ones along pairs that are frequent.  A
phrase with both ends expanded has all its prefixes, suffixes and one-word
extensions counted, so its score is exact and whether it survives is known.
Once a language's last wanted survivor scores more than the bound of every word
not yet expanded, no phrase that is missing can reach it, ties included.  Else
the next frontier goes up to the count at which the bound meets that score (all
words, where there are too few survivors).  The bound needs no more than two
such steps.

Counting: tasks number the words of some megabytes of text, count phrases on
arrays and send each distinct phrase of such a chunk once; a shuffle sums them.
Which words and pairs are frequent or expanded is told to tasks by bit sets of
fixed size over word hashes.  A false positive only has a phrase counted that is
not needed: counts stay exact, and thresholds are applied to exact counts.

Defined results: a null text counts as empty and a null language as ``und``;
words and languages are compared as they are but for A-Z; repeated rows count
each time; a phrase equal in score and count goes by its UTF-8 bytes; a language
without candidates has no rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import require, stage

#: Bytes that end a piece (fixed values) and those that end a word.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
#: Bits of a set that tasks are told (4 MiB).
BITS = 1 << 25
#: Words counted together in a task.
CHUNK_WORDS = 1_500_000
#: Share of all word occurrences that the first frontier holds at most.
FIRST_SHARE = 0.25
LONGEST = 5
ALL = 2 ** 62

_TO_SPACE = bytes.maketrans(PIECE_ENDS + b"\t", b"\n" * len(PIECE_ENDS) + b" ")
#: Stands for the end of a piece; no UTF-8 text holds this byte.
_END = b"\xff"


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words of a text, with ``_END`` between pieces."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_TO_SPACE).replace(b"\n", b" \xff ").split()


def place(bits: int) -> Column:
    """Bit of a row's (lang, phrase): the low bits of its hash."""
    return F.pmod(F.xxhash64(F.concat_ws("\t", "lang", "phrase")), F.lit(bits))


def place_of(lang: bytes, phrase: bytes, bits: int) -> int:
    return xxhash.xxh64_intdigest(lang + b"\t" + phrase, 42) % bits


def bit_set(bits: int, *frames: DataFrame) -> np.ndarray:
    """The bits of all rows' (lang, phrase); at most ``bits`` of them reach the driver."""
    out = np.zeros(4096 * -(-bits // 32768), dtype=np.uint8)
    for df in frames:
        at = df.select(place(bits).alias("at"))
        rows = at.groupBy((F.col("at") / 32768).cast("int").alias("block")).agg(
            F.bitmap_construct_agg(F.col("at") % 32768).alias("bits")).collect()
        for r in rows:
            out[r.block * 4096:(r.block + 1) * 4096] |= np.frombuffer(bytes(r.bits), dtype=np.uint8)
    return out


def holds(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7) & 1).astype(bool)


def chunks(batches: Iterator[pa.RecordBatch], most: int, sets: dict | None = None) -> Iterator[tuple[bytes, list[bytes]]]:
    """Language and tokens of many documents, those of a language together.
    ``sets``: skip languages whose own bit (the empty phrase) is not in the frontier."""
    held, size = defaultdict(list), 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            key = lang.encode("utf-8", "surrogatepass")
            if sets and not holds(sets["frontier"], np.array([place_of(key, b"", sets["bits"])]))[0]:
                continue
            found = tokens(text)
            held[key] += found
            held[key].append(_END)
            size += len(found) + 1
            if size >= most:
                yield from held.items()
                held, size = defaultdict(list), 0
    yield from held.items()


def prepared(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    require(df, [text_col, lang_col])
    return df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def batch_of(lang: bytes, phrases: list[bytes], counts) -> pa.RecordBatch:
    rows = pa.array(phrases, pa.binary()).cast(pa.string())
    langs = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(phrases), np.int32)), pa.array([lang.decode()])).cast(pa.string())
    return pa.RecordBatch.from_arrays([langs, rows, pa.array(counts, pa.int64())], names=["lang", "phrase", "f"])


def word_counts(docs: DataFrame, chunk_words: int) -> DataFrame:
    """Occurrences of every word, by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in chunks(batches, chunk_words):
            found = Counter(words)
            del found[_END]
            if found:
                yield batch_of(lang, list(found), list(found.values()))

    return summed(docs.mapInArrow(run, "lang string, phrase string, f long"))


class Numbered:
    """A chunk's words as numbers, with what the bit sets say of each."""

    def __init__(self, lang: bytes, words: list[bytes], sets: dict):
        numbers: dict[bytes, int] = {_END: 0}
        self.a = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
        self.words, self.lang = list(numbers), lang
        at = np.array([place_of(lang, w, sets["bits"]) for w in self.words], dtype=np.int64)
        often, new, done = (holds(sets[k], at) for k in ("often", "frontier", "expanded"))
        often[0] = False
        self.often = often[self.a]
        self.done = (done & often)[self.a]
        self.new = (new & often & ~done)[self.a]

    def wanted(self, k: int) -> np.ndarray:
        """Whether the phrase of ``k`` words at each place has an end in the
        frontier and none that was expanded before."""
        m = len(self.a) - k + 1
        new = self.new[:m] | self.new[k - 1:]
        return new & ~self.done[:m] & ~self.done[k - 1:] & self.often[:m] & self.often[k - 1:]

    def distinct(self, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place, count and class of each place of the phrases of ``k`` words."""
        key = self.a[at]
        for j in range(1, k):
            key = np.unique(key, return_inverse=True)[1] * len(self.words) + self.a[at + j]
        _, first, which, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        return at[first], count, which

    def phrases(self, at: np.ndarray, k: int) -> list[bytes]:
        columns = [[self.words[w] for w in self.a[at + j].tolist()] for j in range(k)]
        return [b" ".join(p) for p in zip(*columns)]


def pair_counts(docs: DataFrame, told) -> DataFrame:
    """Occurrences of pairs of frequent words with an end in the frontier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = told.value
        for lang, words in chunks(batches, sets["chunk_words"], sets):
            own = Numbered(lang, words, sets)
            at = np.nonzero(own.wanted(2))[0]
            if len(at):
                first, count, _ = own.distinct(at, 2)
                yield batch_of(lang, own.phrases(first, 2), count)

    return summed(docs.mapInArrow(run, "lang string, phrase string, f long"))


def longer_counts(docs: DataFrame, told) -> DataFrame:
    """Occurrences of phrases of three words and more with an end in the
    frontier, along pairs that are frequent as far as pairs were counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = told.value
        for lang, words in chunks(batches, sets["chunk_words"], sets):
            own = Numbered(lang, words, sets)
            if len(own.a) < 3:
                continue
            link = own.often[:-1] & own.often[1:]
            seen = own.new | own.done
            counted = np.nonzero(link & (seen[:-1] | seen[1:]))[0]
            if len(counted):
                first, _, which = own.distinct(counted, 2)
                places = np.array([place_of(lang, p, sets["bits"]) for p in own.phrases(first, 2)], dtype=np.int64)
                link[counted] = holds(sets["pairs"], places)[which]
            chain = link
            for k in range(3, min(LONGEST, len(own.a)) + 1):
                chain = chain[:-1] & link[k - 2:]
                at = np.nonzero(chain & own.wanted(k))[0]
                if len(at):
                    first, count, _ = own.distinct(at, k)
                    yield batch_of(lang, own.phrases(first, k), count)

    return summed(docs.mapInArrow(run, "lang string, phrase string, f long"))


# ----------------------------------------------------------------- scores
def words_in(phrase: str) -> Column:
    return F.split(phrase, " ")


def survivors(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """Candidates with both ends expanded that no longer candidate of the same
    count contains: ``lang, phrase, a, l, r, n, score``.  ``counts``: words and
    phrases that are frequent enough."""
    words = words_in("phrase")
    phrases = counts.select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.size(words).alias("m")).where("m > 1")
    ends = counts.where(F.instr("phrase", " ") == 0).join(limits.select("lang", "upto"), "lang").where("f <= upto").select("lang", "phrase")
    part = lambda at, n: F.concat_ws(" ", F.slice("w", at, n))
    # a phrase within a longer one of the same count lies in one a word longer
    # than itself: the counts between cannot differ
    inside = phrases.where("m > 2").select(
        "lang", F.explode(F.array(part(F.lit(1), F.col("m") - 1), part(F.lit(2), F.col("m") - 1))).alias("phrase"), "a").distinct()
    kept = (phrases
            .withColumns({"head": F.element_at("w", 1), "tail": F.element_at("w", -1)})
            .join(ends.withColumnRenamed("phrase", "head"), ["lang", "head"], "left_semi")
            .join(ends.withColumnRenamed("phrase", "tail"), ["lang", "tail"], "left_semi")
            .join(inside, ["lang", "phrase", "a"], "left_anti"))
    cuts = kept.select("lang", "phrase", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
                       part(F.col("k") + 1, F.col("m") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    score = F.expr("CAST((CAST(a AS DECIMAL(38,0)) * 1000 * n) div (CAST(l AS DECIMAL(38,0)) * r) AS BIGINT)")
    scored = cuts.join(limits.select("lang", "n"), "lang").withColumn("score", score)
    worst = F.min(F.struct("score", "k", "l", "r")).alias("c")
    return scored.groupBy("lang", "phrase", "a", "n").agg(worst).select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def mine(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, top: int = 2000,
         first_share: float = FIRST_SHARE, bits: int = BITS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    spark, docs = df.sparkSession, prepared(df, text_col, lang_col)
    every = stage(word_counts(docs, chunk_words))
    words = every.where(F.col("f") >= least)
    # how far to expand first: whole doublings of the count, while they hold a
    # bounded share of all words
    steps = every.groupBy("lang", F.floor(F.log2("f")).alias("b")).agg(F.sum("f").alias("mass"), F.max("f").alias("f"))
    so_far = steps.withColumns({"mass": F.sum("mass").over(Window.partitionBy("lang").orderBy("b")),
                                "n": F.sum("mass").over(Window.partitionBy("lang"))})
    reached = so_far.where(F.col("f") >= least)
    limits = stage(reached.groupBy("lang", "n").agg(
        F.max(F.when(F.col("mass") <= F.col("n") * first_share, F.col("f"))).alias("share"), F.min("f").alias("some"),
        F.max("f").alias("most")).select("lang", "n", F.coalesce("share", "some").alias("upto"), "most", F.lit(True).alias("active")))
    counted, pairs = [words], []
    often = bit_set(bits, words)
    expanded = np.zeros_like(often)
    while True:
        active = limits.where("active").select("lang", "upto")
        ends = words.join(active, "lang").where("f <= upto").select("lang", "phrase")
        frontier = bit_set(bits, ends, active.select("lang", F.lit("").alias("phrase")))
        sets = {"bits": bits, "chunk_words": chunk_words, "often": often, "frontier": frontier, "expanded": expanded}
        told = spark.sparkContext.broadcast(sets)  # of fixed size
        pairs.append(stage(pair_counts(docs, told).where(F.col("f") >= least)))
        told = spark.sparkContext.broadcast(sets | {"pairs": bit_set(bits, *pairs)})
        counted += [pairs[-1], stage(longer_counts(docs, told).where(F.col("f") >= least))]
        expanded = expanded | frontier
        counts = counted[0]
        for part in counted[1:]:
            counts = counts.unionByName(part)
        best = stage(ranked(survivors(counts, limits), top))
        # settled: all words expanded, or the last wanted score beats every bound
        last = best.where(F.col("rank") == top).select("lang", F.col("score").alias("last"))
        reach = F.expr("CAST((CAST(n AS DECIMAL(38,0)) * 1000) div greatest(last, 1) AS BIGINT)")
        judged = limits.join(last, "lang", "left").select(
            "lang", "n", "upto", "most", "last", F.when(F.coalesce("last", F.lit(0)) > 0, reach).otherwise(F.lit(ALL)).alias("next"))
        limits = stage(judged.select("lang", "n", F.greatest("upto", "next").alias("upto"), "most",
                                     ((F.col("upto") < F.col("most")) & (F.col("next") > F.col("upto"))).alias("active")))
        if limits.where("active").isEmpty():
            return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
