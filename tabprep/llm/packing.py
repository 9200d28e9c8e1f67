"""Best-fit packing of token pieces by swap-based local search.

``pieces`` turns each document into token ids with an end mark and cuts only
those longer than a sequence: whole pieces of ``cap`` tokens behind a first
piece that holds the rest.  Whole pieces are sequences of their own.  ``pack``
deals the others by the hash of a written row number into groups of bounded
size.  A task packs one group: best fit, largest first, then local search among
underfull bins.  The least full bin hands items over by moves, one-for-one and
two-for-one exchanges, each of which raises the sum of squared fills, until
bins empty, no exchange is left or the sum of the sizes allows no fewer bins.
The least full bins of all groups are then dealt and packed anew together,
round after round, until one group holds them, so that a bin is not lost per
group.

Tokens.  White space separates words, and a match of the vocabulary's pattern
never runs from one word into the next space, so a text's ids are the joined ids
of its words with the space before them.  Each distinct word of a few megabytes
of text is encoded once and its ids are gathered by position.  Texts where two
white space characters meet at a space are encoded whole.  Words are encoded
with the ranks of the ``tokenizers`` file by ``tiktoken``, whose ids are the
same and which is several times faster (see README); a test compares them.

Defined results: a null text counts as empty and gives the end mark alone; every
row is a document of its own, repeated rows too; special-token strings are
ordinary text; an empty table gives an empty result; ``pieces`` returns the
columns it is asked to keep; ``pack`` passes all columns through and replaces
``sequence_id`` and ``offset``; a length beyond the cap or below one stops it.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm.bpe import byte_table
from tabprep.llm.common import require, stage

#: Expected pieces of a group.
GROUP_ROWS = 8192
#: Share of a group's pieces, those of its least full bins, that go to the next round.
OPEN_SHARE = 1 / 32
#: Moves and exchanges that a group's search looks for at most.
STEPS = 2000
#: Bytes of text encoded together.
SLICE_BYTES = 8 << 20
#: Bytes of distinct words handed to the encoder at once.
JOINED_BYTES = 1 << 18
#: White space (Unicode property White_Space).
SPACE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


# ----------------------------------------------------------------- tokens
class Encoder:
    """Ids of texts by the vocabulary of a byte-level ``tokenizers`` file."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        added = {t["id"] for t in described.get("added_tokens", ())}  # <|endoftext|> and such: no products of merges
        code = {c: b for b, c in enumerate(byte_table())}
        ranks = {bytes(map(code.__getitem__, token)): k for token, k in described["model"]["vocab"].items() if k not in added}
        if sum(len(token) == 1 for token in ranks) != 256:
            raise ValueError(f"{path} is not a byte-level vocabulary")
        self.known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        self.size[list(ranks.values())] = [len(t) for t in ranks]

    def text(self, text: str) -> np.ndarray:
        return np.array(self.known.encode_ordinary(text), dtype=np.uint32)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each with a space before it, and each word's number of ids."""
        ids, at, held = [], 0, 0
        for k, word in enumerate(words):
            held += len(word) + 1
            if held >= JOINED_BYTES or k + 1 == len(words):
                ids.append(self.text(" " + " ".join(words[at:k + 1])))
                at, held = k + 1, 0
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        ends = np.cumsum(self.size[flat])
        bounds = np.cumsum([len(w.encode()) + 1 for w in words], dtype=np.int64)
        last = np.searchsorted(ends, bounds)
        if len(words) and (last[-1] >= len(ends) or (ends[last] != bounds).any()):
            raise ValueError("a token runs over a space")
        return flat, np.diff(last, prepend=-1)

    def texts(self, column: pa.StringArray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, each followed by ``end``, and the bounds between texts."""
        n = len(column)
        odd = pc.match_substring_regex(column, f" {SPACE}|{SPACE} ").to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(pc.if_else(pa.array(odd), "", column), " ")
        offsets, coded = parts.offsets.to_numpy().astype(np.int64), parts.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        inner = [w for w in words if w]
        flat, counts = self.words(inner)
        # what a word code stands for: a place and a length in ``source``; the
        # empty word is a space at a text's end
        alone = self.text(" ")
        lone, length = [len(flat), len(alone)], np.zeros(len(words), dtype=np.int64)
        full = np.array([bool(w) for w in words], dtype=bool)
        begin = np.full(len(words), lone[0], dtype=np.int64)
        length[:] = lone[1]
        length[full], begin[full] = counts, np.cumsum(counts) - counts
        # first words have no space before them; odd texts are encoded whole
        whole = column.to_pylist() if odd.any() else None
        firsts = pc.list_element(parts, 0).to_pylist() if n else []
        own = [self.text(whole[k] if odd[k] else firsts[k]) for k in range(n)]
        source = np.concatenate([flat, alone, np.array([end], np.uint32), *own])
        own_len = np.array([len(x) for x in own], dtype=np.int64)
        own_at = len(flat) + len(alone) + 1 + np.cumsum(own_len) - own_len
        seg_at, seg_len = np.empty(len(codes) + n, np.int64), np.empty(len(codes) + n, np.int64)
        place = np.arange(len(codes)) + np.repeat(np.arange(n), np.diff(offsets))
        seg_at[place], seg_len[place] = begin[codes], length[codes]
        first = offsets[:-1] + np.arange(n)
        seg_at[first], seg_len[first] = own_at, own_len
        last = offsets[1:] + np.arange(n)
        seg_at[last], seg_len[last] = len(flat) + len(alone), 1
        ends = np.cumsum(seg_len)
        ids = source[np.repeat(seg_at - (ends - seg_len), seg_len) + np.arange(ends[-1] if n else 0)]
        return ids, np.concatenate([[0], ends[last]])


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``SLICE_BYTES`` of text."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES - size, side="right")))
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1] - before)
            at = to
            if size >= SLICE_BYTES or at < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def pieces(df: DataFrame, path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
           cap: int = 2048, end: int = 0) -> DataFrame:
    """``keep``, ``piece``, ``start``, ``length`` and ``ids`` (binary,
    little-endian unsigned 32-bit) of every piece of every document."""
    require(df, [*keep, text_col])
    new = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keep] + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in slices(batches, len(keep)):
            ids, bounds = encoder.texts(batch.column(len(keep)).fill_null(""), end)
            raw, size = memoryview(ids.astype("<u4")).cast("B"), np.diff(bounds)
            number = -(-size // cap)
            row = np.repeat(np.arange(len(size)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            first = size - (number - 1) * cap
            start = np.where(piece == 0, 0, first[row] + (piece - 1) * cap)
            length = np.where(piece == 0, first[row], cap)
            at = (bounds[row] + start) * 4
            cut = [bytes(raw[a:b]) for a, b in zip(at.tolist(), (at + length * 4).tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(pa.array(row)) for k in range(len(keep))), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(cut, pa.binary())], names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("_text")).mapInArrow(run, schema)


# ----------------------------------------------------------------- packing
def best_fit(sizes: list[int], cap: int) -> list[list[int]]:
    """Bins of positions: each size, largest first, where the least room is left."""
    bins, room, rooms = [], defaultdict(list), 0  # bit r of rooms: some bin has r left
    for k in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = rooms >> sizes[k]
        if fits:
            r = (fits & -fits).bit_length() - 1 + sizes[k]
            b = room[r].pop()
            if not room[r]:
                rooms &= ~(1 << r)
            bins[b].append(k)
        else:
            b, r = len(bins), cap
            bins.append([k])
        left = r - sizes[k]
        if left:
            room[left].append(b)
            rooms |= 1 << left
    return bins


class Search:
    """Local search among underfull bins: ``bins`` are lists of positions.  At
    most ``steps`` moves and exchanges are looked for, so a group's time is bounded."""

    def __init__(self, sizes: list[int], bins: list[list[int]], cap: int, steps: int = STEPS):
        self.size, self.cap, self.steps = np.array(sizes, dtype=np.int64), cap, steps
        self.bins = [list(b) for b in bins]
        self.home = np.zeros(len(sizes), dtype=np.int64)
        for b, held in enumerate(self.bins):
            self.home[held] = b
        self.room = np.array([cap - int(self.size[b].sum()) for b in self.bins], dtype=np.int64)
        self.least = -(-int(self.size.sum()) // cap)
        # two items for every sum that two of a bin have: bin, its version, sum, items
        self.version = np.zeros(len(bins), dtype=np.int64)
        self.twos = np.zeros((0, 5), dtype=np.int64)

    def run(self) -> list[list[int]]:
        """Bins after the search; the sum of squared fills only grows."""
        left = sum(map(bool, self.bins))
        if left > self.least:
            self.twos = np.concatenate([self.twos, *(self.pairs(b) for b in np.nonzero(self.room > 0)[0].tolist())])
        while left > self.least and self.steps > 0:
            open_ = [b for b in np.argsort(-self.room, kind="stable").tolist() if self.bins[b] and self.room[b] > 0]
            if not any(self.relieve(b) for b in open_):
                break
            left = sum(map(bool, self.bins))
        return [b for b in self.bins if b]

    def relieve(self, v: int) -> bool:
        """Hand items of bin ``v`` over to fuller bins while an exchange is found."""
        done = False
        while self.bins[v] and self.steps > 0:
            self.steps -= 1
            if not (step := self.step(v)):
                break
            given, taken, u = step
            for k in given:
                self.bins[v].remove(k)
                self.bins[u].append(k)
                self.home[k] = u
            for k in taken:
                self.bins[u].remove(k)
                self.bins[v].append(k)
                self.home[k] = v
            gain = int(self.size[given].sum() - self.size[taken].sum())
            self.room[u] -= gain
            self.room[v] += gain
            self.version[[u, v]] += 1
            self.twos = np.concatenate([self.twos[self.version[self.twos[:, 0]] == self.twos[:, 1]], self.pairs(u), self.pairs(v)])
            done = True
        return done

    def step(self, v: int) -> tuple[list[int], list[int], int] | None:
        """A move, else the exchange that takes most out of ``v``: items given,
        items taken and the other bin, which is at least as full."""
        other = (self.room > 0) & (self.room <= self.room[v])
        other[v] = False
        for k in sorted(self.bins[v], key=lambda k: -self.size[k]):
            fits = np.nonzero(other & (self.room >= self.size[k]))[0]
            if len(fits):
                return [k], [], int(fits[np.argmin(self.room[fits])])
        ones = {int(self.size[k]): [k] for k in self.bins[v]}
        twos = {int(s): [int(a), int(b)] for _, _, s, a, b in self.pairs(v)}
        single = np.nonzero(other[self.home])[0]
        double = self.twos[other[self.twos[:, 0]]]
        best, step = 0, None
        for give, size, home, items in ((ones, self.size[single], self.home[single], single[:, None]),
                                        (twos, self.size[single], self.home[single], single[:, None]),
                                        (ones, double[:, 2], double[:, 0], double[:, 3:])):
            if not len(size):
                continue
            room = self.room[home]
            for s, given in give.items():
                gain = s - size
                gain[gain > room] = 0
                at = int(np.argmax(gain))
                if gain[at] > best:
                    best, step = int(gain[at]), (given, items[at].tolist(), int(home[at]))
        return step

    def pairs(self, b: int) -> np.ndarray:
        """Rows of ``twos`` for the items that bin ``b`` holds now."""
        by_size = defaultdict(list)
        for k in self.bins[b]:
            by_size[int(self.size[k])].append(k)
        kinds, sums = sorted(by_size), {}
        for i, x in enumerate(kinds):
            if len(by_size[x]) > 1:
                sums.setdefault(2 * x, by_size[x][:2])
            for y in kinds[i + 1:]:
                sums.setdefault(x + y, [by_size[x][0], by_size[y][0]])
        return np.array([(b, self.version[b], s, *two) for s, two in sums.items()], dtype=np.int64).reshape(-1, 5)


def pack_sizes(sizes: list[int], cap: int) -> list[list[int]]:
    """Bins of positions: best fit, then local search."""
    return Search(sizes, best_fit(sizes, cap), cap).run()


def pack(df: DataFrame, length_col: str = "length", cap: int = 2048, group_rows: int = GROUP_ROWS) -> DataFrame:
    """All columns, with ``sequence_id`` and ``offset`` (long)."""
    require(df, [length_col])
    named = df.drop("sequence_id", "offset")
    kept = named.columns
    row, size, group = (_free(kept, c) for c in ("_row", "_size", "_group"))
    length = F.col(f"`{length_col}`").cast("long")
    checked = F.when((length >= 1) & (length <= cap), length).otherwise(
        F.raise_error(F.lit(f"lengths are 1 to {cap}")).cast("long"))
    # written, so that the numbers of the rows, which deal them, stay as they are
    todo = stage(named.select("*", F.monotonically_increasing_id().alias(row), checked.alias(size)))
    whole = todo.where(F.col(size) == cap).withColumns({"sequence_id": -1 - F.col(row), "offset": F.lit(0).cast("long")})
    done, todo, level, first = [whole], todo.where(F.col(size) < cap), 0, 0
    while True:
        groups = max(1, -(-todo.count() // group_rows))
        dealt = todo.withColumn(group, F.pmod(F.xxhash64(F.lit(level), F.col(row)), F.lit(groups)).cast("long"))
        out = stage(_packed(dealt, row, size, group, cap, first, last=groups == 1))
        done.append(out.where("sequence_id IS NOT NULL").drop(group))
        if groups == 1:
            break
        first += groups
        level += 1
        todo = out.where("sequence_id IS NULL").drop(group, "sequence_id", "offset")
    whole = done[0].select(*[F.col(f"`{c}`") for c in kept], "sequence_id", "offset")
    for part in done[1:]:
        whole = whole.unionByName(part.select(*[F.col(f"`{c}`") for c in kept], "sequence_id", "offset"))
    return whole


def _free(columns: list[str], name: str) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def _packed(df: DataFrame, row: str, size: str, group: str, cap: int, first: int, last: bool) -> DataFrame:
    """Each group's rows with their places; without one for rows that go on."""
    schema = T.StructType(df.schema.fields + [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[(row, "ascending")]))  # the same rows, the same bins
        sizes = rows.column(size).to_pylist()
        number = first + rows.column(group)[0].as_py()
        bins = pack_sizes(sizes, cap)
        fill = [sum(sizes[k] for k in b) for b in bins]
        allowed = 0 if last else max(1, int(len(sizes) * OPEN_SHARE))
        sequence, offset = [None] * len(sizes), [None] * len(sizes)
        for at, b in enumerate(sorted(range(len(bins)), key=lambda b: fill[b])):
            allowed -= len(bins[b])
            if fill[b] < cap and not last and (allowed >= 0 or at == 0):
                continue
            place = 0
            for k in bins[b]:
                sequence[k], offset[k] = (number << 24) + b, place
                place += sizes[k]
        return pa.table([*rows.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=schema.names)

    return df.groupBy(group).applyInArrow(run, schema)


def sequences(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """``sequence_id``, ``n_tokens`` and ``ids`` of every packed sequence; a
    sequence is bounded by the cap."""
    held = F.array_sort(F.collect_list(F.struct("offset", F.col(f"`{ids_col}`").alias("ids"))))
    joined = F.aggregate(held, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return df.groupBy("sequence_id").agg(joined.alias("ids")).select(
        "sequence_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")
