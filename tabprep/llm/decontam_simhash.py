"""Benchmark decontamination by SimHash over item-sized windows.

1. *Regions.*  A window at 0.8 weighted-shingle similarity shares shingles with
   its item, so only texts that hold a benchmark shingle can hold such a window.
   They are found in one scan by a Bloom filter literal over the benchmark's
   shingles (its size is checked; a larger benchmark is joined instead).
2. *Windows.*  A window of k shingles at similarity s or more to an item of m
   shares at least ``s * (k + m) / (1 + s)`` of them with it.  Every start whose
   window holds that many positions with a shingle of an item of that number of
   words is cut out, wherever the item's parts stand in it.
3. *SimHash.*  Windows and items get a 64-bit fingerprint over their weighted
   shingles (weight: occurrences).  Equal windows of many texts are one.
4. *Multi-index Hamming blocks.*  The fingerprint is cut into 8 blocks.  Two
   fingerprints within ``radius`` differ by at most ``radius // 8`` bits in some
   block, so items are filed under every value within that many bits of each of
   their blocks, and windows look up their own values: an equi-join that misses
   no fingerprint within the radius.
5. *Verification.*  Candidates within the radius are compared exactly: the sum
   of the smaller weights over the sum of the larger weights of their shingles.

Main path: DataFrame operations only.

Defined results: words are separated by white space and punctuation, A-Z is
lower-cased; shingles have five words, shorter items are one shingle; texts
shorter than an item are one window; null and empty texts and items match
nothing; rows that repeat id and text are found once; empty tables give empty
results; other columns pass through ``keep_clean``.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import whole_rows, with_row, let, require, stage
from tabprep.llm.url_cascade import MAX_BITS, build_level, level_size

WIDTH = 5
SIMILARITY = 0.8
#: Two texts at 0.8 lie about 10 bits apart (standard deviation 3).
RADIUS = 20
BLOCKS = 8
BLOCK_BITS = 8
#: False positives of the shingle filter, by position.
FILTER_RATE = 1e-5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAK = "\t\n\x0b\f\r.,;:!?()[]{}<>\"'`|*#&%$@/\\=+-_~^"


def words(text: Column) -> Column:
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER + _BREAK, _UPPER.lower() + " " * len(_BREAK))
    return F.filter(F.split(plain, " ", -1), lambda w: w != "")


def hashes(words_col: Column, width: int) -> Column:
    """Hash of the ``width`` words from each position on; empty if too short."""
    last = F.size(words_col) - width
    at = lambda i: F.xxhash64(*[F.get(words_col, i + k) for k in range(width)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), at)).otherwise(
        F.array().cast("array<bigint>"))


def shingles(window: Column) -> Column:
    """The window's shingles as text, repeats included."""
    width = F.least(F.size(window), F.lit(WIDTH))
    return F.transform(F.sequence(F.lit(1), F.size(window) - width + 1), lambda i: F.concat_ws(" ", F.slice(window, i, width)))


def fingerprints(contents: DataFrame, name: str) -> DataFrame:
    """``contents(name, shingles)`` -> ``name, fp``: bit set if the weights of
    the shingles that have it are more than half of all."""
    each = contents.select(name, F.explode("shingles").alias("s")).select(name, F.xxhash64("s").alias("h"))
    votes = each.groupBy(name).agg(F.count("*").alias("n"), *[
        F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1).cast("long"))).alias(f"b{b}") for b in range(64)])
    fp = F.lit(0).cast("long")
    for b in range(64):
        fp = fp.bitwiseOR(F.when(F.col(f"b{b}") * 2 > F.col("n"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return votes.select(name, fp.alias("fp"))


def masks(radius: int) -> list[int]:
    """Block values within ``radius`` bits of zero."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BLOCK_BITS), r)]


def blocks(df: DataFrame, near: int | None = None) -> DataFrame:
    """One row per block of ``fp``; with ``near`` one per value that near."""
    parts = [F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("fp", k * BLOCK_BITS).bitwiseAND(
        F.lit((1 << BLOCK_BITS) - 1).cast("long")).alias("value")) for k in range(BLOCKS)]
    rows = df.withColumn("_b", F.explode(F.array(*parts))).select("*", "_b.block", "_b.value").drop("_b")
    if near is None:
        return rows
    around = F.array(*[F.lit(m).cast("long") for m in masks(near)])
    return rows.withColumn("_m", F.explode(around)).withColumn("value", F.col("value").bitwiseXOR(F.col("_m"))).drop("_m")


def regions(docs: DataFrame, marks: DataFrame, widths: list[int]) -> DataFrame:
    """``doc_id, hash, words, hits``: texts with a position whose shingle may be
    the benchmark's; ``hits``: (width, position, shingle hash)."""
    known = marks.select(F.col("h").alias("key")).distinct()
    n = known.count()
    level = build_level(0, known, n, FILTER_RATE) if level_size(n, FILTER_RATE)[0] <= MAX_BITS else None
    none = F.array().cast("array<struct<width:int,pos:int,h:bigint>>")

    def numbered(own: Column, width: int) -> Column:
        rows = F.transform(hashes(own, width), lambda h, i: F.struct(
            F.lit(width).alias("width"), i.cast("int").alias("pos"), h.alias("h")))
        return F.filter(rows, lambda s: level.passes(s["h"])) if level else rows

    def found(own: Column) -> Column:
        hits = F.concat(none, *[numbered(own, width) for width in widths])
        return let(hits, lambda h: F.when(F.size(h) > 0, F.struct(own.alias("words"), h.alias("hits"))))

    rows = docs.select("doc_id", text_hash(F.col("text")).alias("hash"), let(words(F.col("text")), found).alias("r"))
    return rows.where("r IS NOT NULL").select("doc_id", "hash", "r.words", "r.hits")


def starts(similarity: float) -> Column:
    """Ranges (first, last) of the starts whose window of ``size`` words can be
    at ``similarity``; needs ``n`` words of the text, ``width`` and ``at``, the
    positions in order whose shingles are those of items.  The window holds k
    shingles; from the i-th position on, the last of those needed must lie in it."""
    last = F.greatest(F.lit(0), F.col("n") - F.col("size"))
    k = F.least("n", "size") - F.col("width") + 1
    least = F.ceil((k + F.col("size") - F.col("width") + 1) * (similarity / (1 + similarity)) - 1e-6).cast("int")
    need = F.greatest(F.lit(1), least)

    def run(at: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(at, i - 1) + 1).otherwise(F.lit(0))
        return F.struct(F.greatest(before, F.get(at, i + need - 1) - k + 1, F.lit(0)).alias("first"),
                        F.least(F.get(at, i), last).alias("last"))

    def runs(at: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(at) - need), lambda i: run(at, i))

    return F.when(F.size("at") >= need, F.filter(let(F.col("at"), runs), lambda r: r["first"] <= r["last"]))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``doc_id, item_id, start, n_words, distance, similarity``: for each text
    and item the best window at ``similarity`` or more; positions count words.
    Texts that share an id, or have none, are told apart."""
    return found_in(docs, benchmark, similarity, radius).drop("hash")


def text_hash(text: Column) -> Column:
    """Tells texts of one id apart; a null text is an empty one."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def found_in(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``contaminated`` with the ``text_hash`` of the text as ``hash``."""
    require(docs, ["doc_id", "text"])
    require(benchmark, ["item_id", "text"])
    items = stage(benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0).select(
        "item_id", "words", F.size("words").alias("size"), F.least(F.size("words"), F.lit(WIDTH)).alias("width")).distinct())
    widths = sorted(r.width for r in items.select("width").distinct().collect())  # at most WIDTH numbers
    marks = None
    for width in widths:
        own = items.where(F.col("width") == width).select("width", "size", F.explode(hashes(F.col("words"), width)).alias("h"))
        marks = own.distinct() if marks is None else marks.union(own.distinct())
    if marks is None:
        return docs.select("doc_id", F.lit(0).cast("long").alias("hash"), F.lit(None).cast("long").alias("item_id"), F.lit(0).alias("start"), F.lit(0).alias("n_words"),
                           F.lit(0).alias("distance"), F.lit(0.0).alias("similarity")).limit(0)
    marks = stage(marks)
    held = stage(regions(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), marks, widths))

    # windows that hold enough of the shingles, as starts and sizes first
    hits = held.select("doc_id", "hash", F.size("words").alias("n"), F.explode("hits").alias("t")).select("doc_id", "hash", "n", "t.*")
    at = hits.join(marks, ["width", "h"]).groupBy("doc_id", "hash", "n", "size", "width").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    ranges = at.select("doc_id", "hash", "size", F.explode(starts(similarity)).alias("r")).select("doc_id", "hash", "size", "r.*")
    cuts = ranges.groupBy("doc_id", "hash").agg(F.collect_list(F.struct("first", "last", "size")).alias("cuts"))
    same = cuts.select(F.col("doc_id").alias("_d"), F.col("hash").alias("_h"), "cuts")
    once = held.dropDuplicates(["doc_id", "hash"]).drop("hits")
    window = once.join(same, (F.col("hash") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_d"))).select(
        "doc_id", "hash", "words", F.explode("cuts").alias("c")).select(
        "doc_id", "hash", "words", "c.size", F.explode(F.sequence("c.first", "c.last")).alias("start")).select(
        "doc_id", "hash", "start", "size", F.slice("words", F.col("start") + 1, F.col("size")).alias("window"))
    windows = stage(window.select("doc_id", "hash", "start", "size", F.size("window").alias("n_words"), "window").withColumn(
        "wid", F.md5(F.concat_ws(" ", F.col("size").cast("string"), F.concat_ws(" ", "window")).cast("binary"))))
    contents = stage(windows.groupBy("wid").agg(F.first("size").alias("size"), F.first("window").alias("window"))).select(
        "wid", "size", let(F.col("window"), shingles).alias("shingles"))
    texts = items.select("item_id", "size", shingles(F.col("words")).alias("shingles")).withColumn(
        "iid", F.md5(F.concat_ws("\n", "shingles").cast("binary")))
    unique = stage(texts.groupBy("iid").agg(F.first("size").alias("size"), F.first("shingles").alias("shingles")))

    asked = contents.join(fingerprints(contents, "wid"), "wid").select("wid", "size", "fp")
    filed = unique.join(fingerprints(unique, "iid"), "iid").select("iid", "size", F.col("fp").alias("item_fp"))
    table = blocks(filed.withColumnRenamed("item_fp", "fp"), radius // BLOCKS).withColumnRenamed("fp", "item_fp")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    near = blocks(asked).join(table, ["size", "block", "value"]).where(distance <= radius).select(
        "wid", "iid", distance.cast("int").alias("distance")).distinct()

    weigh = lambda df, name, out: df.select(name, F.explode("shingles").alias("s")).groupBy(name, "s").agg(F.count("*").alias(out))
    shared = near.join(weigh(contents, "wid", "cw"), "wid").join(weigh(unique, "iid", "ci"), ["iid", "s"]).groupBy(
        "wid", "iid", "distance").agg(F.sum(F.least("cw", "ci")).alias("both"))
    sizes = shared.join(contents.select("wid", F.size("shingles").alias("nw")), "wid").join(
        unique.select("iid", F.size("shingles").alias("ni")), "iid")
    value = F.col("both") / (F.col("nw") + F.col("ni") - F.col("both"))
    good = stage(sizes.withColumn("similarity", value).where(F.col("similarity") >= similarity).select("wid", "iid", "distance", "similarity"))
    best = F.max_by(F.struct("start", "n_words", "distance", "similarity"), F.struct("similarity", -F.col("start"))).alias("w")
    return (windows.select("doc_id", "hash", "start", "n_words", "wid").join(good, "wid").join(texts.select("iid", "item_id"), "iid")
            .groupBy("doc_id", "hash", "item_id").agg(best).select("doc_id", "hash", "item_id", "w.*"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, told by id and text:
    a clean row stays, whatever other rows have its id or, like it, none.
    Columns of any name pass through.  What was found is written first, so its
    size is known when the join is planned."""
    found = stage(found_in(docs.select("doc_id", "text"), benchmark, **options).select(
        F.col("doc_id").alias("found_id"), F.col("hash").alias("found_hash")).distinct())
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("hash") == F.col("found_hash"))
    held = with_row(docs, id=F.col("doc_id"), hash=text_hash(F.col("text")))
    return whole_rows(held.join(found, same, "left_anti"), docs.columns)
