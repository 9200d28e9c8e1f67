"""URL filter: longest-prefix rules, then a Bloom filter cascade.

*Rules* are few and explicit (verdict, host, path prefix).  A rule fits its
host and all subdomains; the longest fitting rule decides.

*Block list.*  Urls that no rule decides are looked up in a list of keys (host
and path).  A cascade of Bloom filters answers exactly for every key of the
corpus: level 1 encodes the listed keys, level 2 the unlisted keys that level 1
lets through, level 3 the listed keys that level 2 lets through, and so on
until none is left.  A url is judged by the first level that it misses, so
judging needs no join; only building joins the corpus's distinct keys with the
list.  The filters are literals of the plan: their total size is checked, and a
list beyond ``MAX_BITS`` is judged by a plain join instead.

Main path: DataFrame operations only.

Defined results: a null url, or one without ``://``, has an empty host and
path, which no rule fits; repeated rows repeat; an empty table gives an empty
result; null keys of the list are ignored; columns of the input other than id
and url are not returned.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import ascii_lower, require, stage

#: Bits of all levels together that may travel as literals (8 MiB).
MAX_BITS = 1 << 26
#: False-positive rate of every level but the first, and hashes of a level at most.
LOWER_RATE = 0.5
MAX_HASHES = 6
MAX_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    return ascii_lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def on_site(host: Column, site: str) -> Column:
    """The host is the site or one of its subdomains."""
    return (host == site) | host.endswith("." + site)


def decided(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (null: none); of equally
    long ones a blocking rule comes first."""
    order = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    text = verdict = None
    for rule in order:
        fits = on_site(host, rule.host) & path.startswith(rule.path)
        text = F.when(fits, rule.text) if text is None else text.when(fits, rule.text)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text.otherwise(none), verdict.otherwise(none))


# ------------------------------------------------------------------ cascade
@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: str  # comma-separated 64-bit words

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(k)), F.lit(self.bits)) for k in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")  # folded to one literal
        tests = [F.getbit(F.element_at(words, (F.floor(p / 64) + 1).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1
                 for p in self.places(key)]
        return reduce(lambda a, b: a & b, tests)


def level_size(n: int, rate: float) -> tuple[int, int]:
    """Bits and hashes of a filter over ``n`` keys."""
    rate = min(max(rate, 1e-9), LOWER_RATE)
    hashes = max(1, min(MAX_HASHES, round(math.log2(1 / rate))))
    return 64 * max(1, math.ceil(-n * hashes / math.log(1 - rate ** (1 / hashes)) / 64)), hashes


def build_level(number: int, keys: DataFrame, n: int, rate: float) -> Level:
    """A Bloom filter over ``keys(key)``, ``n`` rows; words without a set bit
    are filled in on the driver, which sees ``bits / 64`` words at most."""
    bits, hashes = level_size(n, rate)
    level = Level(number, bits, hashes, "")
    place = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("p"))
    one = F.expr("shiftleft(1L, cast(pmod(p, 64) AS INT))")
    rows = place.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.bit_or(one).alias("b")).collect()
    words = [0] * (bits // 64)
    for row in rows:
        words[row.w] = row.b
    return Level(number, bits, level.hashes, ",".join(map(str, words)))


def cascade(universe: DataFrame) -> list[Level] | None:
    """``universe(key, listed)``: all keys of the corpus, one row each.  None
    if the filters would be larger than ``MAX_BITS``."""
    inside, outside = universe.where("listed").select("key"), universe.where("NOT listed").select("key")
    n, others = inside.count(), outside.count()
    rate = n * math.sqrt(0.5) / max(others, 1)
    levels: list[Level] = []
    room = MAX_BITS
    while n:
        room -= level_size(n, rate)[0]
        if room < 0:
            return None
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end; are the keys distinct?")
        level = build_level(len(levels) + 1, inside, n, rate)
        levels.append(level)
        wrong = stage(outside.where(level.passes(F.col("key"))))
        inside, outside, n, rate = wrong, inside, wrong.count(), LOWER_RATE
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: a key that misses an odd level
    is not, one that misses an even level is; past the last level it belongs to
    the keys that this level encodes."""
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(~level.passes(key), F.lit(level.number % 2 == 0)).otherwise(answer)
    return answer


# ----------------------------------------------------------------- operator
def judge(df: DataFrame, rules: list[Rule], listed: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``<id_col>, host, path, rule, verdict, listed`` for every row.
    ``listed(key)``: host and path of blocked urls, joined as one text."""
    require(df, [id_col, url_col])
    host, path = split_url(F.col(f"`{url_col}`"))
    parts = df.select(F.col(f"`{id_col}`").alias(id_col), host.alias("host"), path.alias("path"))
    key = F.concat("host", "path")
    known = listed.where("key IS NOT NULL").select(F.col("key").cast("string").alias("key")).distinct().withColumn("listed", F.lit(True))
    universe = stage(parts.select(key.alias("key")).distinct().join(known, "key", "left").select(
        "key", F.coalesce("listed", F.lit(False)).alias("listed")))
    levels = cascade(universe)
    if levels is None:
        judged = parts.withColumn("key", key).join(universe, "key")
    else:
        judged = parts.withColumn("listed", member(levels, key))
    rule, verdict = decided(rules, F.col("host"), F.col("path"))
    return judged.select(id_col, "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
