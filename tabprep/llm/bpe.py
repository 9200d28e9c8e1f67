"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

A text is cut by the vocabulary's pattern; each match is mapped byte by byte to
the 256 printable characters of byte-level BPE and merged by ``tokenizers``.
Matches repeat heavily, so a task keeps the library's answers in a cache of
bounded size, its own and gone with it; a text's ids are then the joined answers.  Offsets are code points of
the text: a token's bytes are mapped to the characters that own them, and the
match's own start is added.  A character whose bytes fall into several tokens
belongs to all of them.  Decoding turns ids into their byte-level strings, reverses the byte
table and joins the bytes *before* any UTF-8 decoding, so split characters come
back whole.

Defined results: a null text counts as empty (no ids, empty bytes); an empty
table gives an empty result; every input row gives one output row (repeated
rows repeat); output columns replace input columns of the same name; all other
columns pass through.  Special-token strings in a text are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm.common import lean, with_row

#: Distinct matches in one generation of a task's cache, and the characters of
#: the longest one that is kept.
CACHE_MATCHES = 120_000
CACHE_CHARS = 64
#: Texts handled together inside a task.
SLICE_ROWS = 256


def byte_table() -> list[str]:
    """Character that stands for each byte: printable Latin-1 stays itself, the
    others take the code points from 256 on, in order."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(free)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Answers(dict):
    """What ``ask`` says about each match.  Two generations bound the size: when
    the young one is full it becomes the old one, from which answers still in
    use move up again."""

    def __init__(self, ask: Callable[[str], object], size: int = CACHE_MATCHES):
        super().__init__()
        self.ask, self.size, self.old = ask, size, {}

    def __missing__(self, match: str) -> object:
        answer = self.old.get(match)
        if answer is None:
            answer = self.ask(match)
        if len(match) > CACHE_CHARS:
            return answer
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[match] = answer
        return answer


class Codec:
    """One task's tokenizer: pattern, merges, byte table and known matches."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import models

        ranks = read_ranks(path)
        chars = byte_table()
        spell = {token: "".join(map(chars.__getitem__, token)) for token in ranks}
        # every split of a token into two tokens may produce it; the order of the
        # products is the order of the ranks
        merges = sorted(
            (rank, ranks[token[:i]], ranks[token[i:]])
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        )
        by_rank = {rank: spell[token] for token, rank in ranks.items()}
        self.model = models.BPE(
            vocab={spell[token]: rank for token, rank in ranks.items()},
            merges=[(by_rank[a], by_rank[b]) for _, a, b in merges],
            ignore_merges=True,
        )
        self.pattern = regex.compile(pattern)
        self.to_chars = {b: c for b, c in enumerate(chars)}
        self.token_bytes = decoder(path)
        self.blocks = Answers(self.block)

    def block(self, match: str) -> bytes:
        """The library's tokens of one match: id, first code point and end of
        each, its bytes mapped to the characters that own them."""
        raw, out, at = match.encode(), [], 0
        # a character is a byte in most matches; else bytes have owners
        owner = range(len(raw)) if len(raw) == len(match) else [k for k, c in enumerate(match) for _ in range(len(c.encode()))]
        for token in self.model.tokenize(raw.decode("latin-1").translate(self.to_chars)):
            end = at + len(self.token_bytes[token.id])
            out += (token.id, owner[at], owner[end - 1] + 1)
            at = end
        return struct.pack(f"<{len(out)}I", *out)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text, and start and end code points of its tokens."""
        matches = self.pattern.findall(text)
        blocks = list(map(self.blocks.__getitem__, matches))
        tokens = np.frombuffer(b"".join(blocks), dtype="<u4").reshape(-1, 3)
        size = np.fromiter(map(len, matches), dtype=np.int64, count=len(matches))
        per = np.fromiter(map(len, blocks), dtype=np.int64, count=len(blocks)) // 12
        return tokens[:, 0], tokens[:, 1:] + np.repeat(np.cumsum(size) - size, per).astype("<u4")[:, None]


def decoder(path: str) -> dict[int, bytes]:
    """Bytes of every id: its byte-level string through the reversed table.
    Decoding tasks hold this table only, not the merges."""
    chars = byte_table()
    code = {c: b for b, c in enumerate(chars)}
    spelt = ((rank, "".join(map(chars.__getitem__, token))) for token, rank in read_ranks(path).items())
    return {rank: bytes(map(code.__getitem__, text)) for rank, text in spelt}


def decoded(ids: bytes, table: dict[int, bytes]) -> bytes:
    """The bytes of all tokens joined; characters split over tokens are whole again."""
    return b"".join(map(table.__getitem__, memoryview(ids).cast("I").tolist()))


def _coded(df: DataFrame, path: str, pattern: str, text_col: str, new: list[T.StructField],
           columns: Callable[[Codec, list[tuple[np.ndarray, np.ndarray]]], list[pa.Array]], keep: list[str]) -> DataFrame:
    """``keep`` and the columns that ``columns`` makes of each text's ids and
    spans, all by one Python worker a task."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    held = df.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([held.schema["row"], *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Codec(path, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                coded = [own.encode(t or "") for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns(own, coded)], names=schema.names)

    return held.mapInArrow(lean(run), schema).select(
        *[F.col("row").getField(c).alias(c) for c in keep], *[F.col(f.name) for f in new])


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", offsets: bool = False,
           decoded_col: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens``;
    with ``offsets`` also ``starts`` and ``ends`` (array<int>, code points);
    with ``decoded_col`` also the bytes that the ids stand for.  ``keep``: the
    columns that pass through, all if not given."""
    new = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    if offsets:
        new += [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("starts", "ends")]
    if decoded_col:
        new.append(T.StructField(decoded_col, T.BinaryType()))

    def columns(own: Codec, coded: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
        ids = [i.tobytes() for i, _ in coded]
        arrays = [pa.array(ids, pa.binary()), pa.array([len(i) for i, _ in coded], pa.int64())]
        if offsets:
            ends = np.cumsum([0] + [len(i) for i, _ in coded], dtype=np.int64).astype(np.int32)
            spans = np.concatenate([s for _, s in coded]).astype(np.int32) if coded else np.zeros((0, 2), np.int32)
            arrays += [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(spans[:, k]))) for k in (0, 1)]
        if decoded_col:
            arrays.append(pa.array([decoded(i, own.token_bytes) for i in ids], pa.binary()))
        return arrays

    names = {f.name.lower() for f in new}
    return _coded(df, path, pattern, text_col, new, columns, [c for c in (df.columns if keep is None else keep) if c.lower() not in names])


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded`` (binary: the bytes the ids stand for; null ids: empty)."""
    held = with_row(df, ids=F.col(f"`{ids_col}`"))
    schema = T.StructType([held.schema["row"], T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                out = [decoded(x or b"", table) for x in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=schema.names)

    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c.lower() != "decoded"]
    return held.mapInArrow(lean(run), schema).select(*kept, "decoded")


def round_trip(df: DataFrame, path: str, pattern: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Encode, decode and reduce to digests: one row per input row, with
    ``n_tokens`` and the SHA-256 of ids, offsets (start and end of each token,
    little-endian unsigned 32-bit) and decoded bytes."""
    names = ("ids_sha256", "offsets_sha256", "decoded_sha256")
    new = [T.StructField("n_tokens", T.LongType()), *[T.StructField(c, T.StringType()) for c in names]]
    digest = lambda data: hashlib.sha256(data).hexdigest()

    def columns(own: Codec, coded: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
        ids = [i.tobytes() for i, _ in coded]
        return [pa.array([len(i) for i, _ in coded], pa.int64()), pa.array(map(digest, ids), pa.string()),
                pa.array([digest(s.tobytes()) for _, s in coded], pa.string()),
                pa.array([digest(decoded(i, own.token_bytes)) for i in ids], pa.string())]

    own = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return _coded(own, path, pattern, "text", new, columns, ["doc_id"])
