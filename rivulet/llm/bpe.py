"""Byte-level BPE: encoding with a file of merge ranks, and decoding.

A text is split by the tokenizer's pattern; each piece is encoded by itself: from its single bytes on, the adjacent
pair whose concatenation has the lowest rank is merged, again and again, until no pair has a rank. Each distinct word
is folded once per task and its ids are kept in a table of bounded size, as words repeat; decoding concatenates the
ids' byte strings. Documents never leave their task, so nothing is shuffled. The rank map (tens of thousands of
entries, fixed by the tokenizer's file) is the only broadcast.

``fold_words`` is the same fold in Spark's higher-order functions over byte arrays and a literal rank map. It gives
equal ids (see the tests), but needs a table of all distinct words to be joined back to every occurrence, so the
operator runs the fold inside the tasks; the README has the figures.

Defined results: null is the empty text: no ids, the hash of no bytes. Repeated rows give equal results. Characters that
UTF-8 cannot hold do not occur in Spark strings. The query drops columns other
than the key and the text; the stage keeps all but those named like a result, which takes their place.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import bound_batches, extended, packed, table, widened

FILE = "byte_bpe_multi_50k.tiktoken"
#: words kept per task; the table is emptied when it is full
KEPT_WORDS = 500_000
#: pieces longer than this are merged with a heap instead of by scanning
LONG_PIECE = 64


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _ranges(wanted: str, limit: int) -> str:
    """Inner part of a character class: all characters below ``limit`` whose Unicode category starts with ``wanted``."""
    codes = [c for c in range(limit) if unicodedata.category(chr(c))[0] == wanted]
    runs, start = [], None
    for a, b in zip(codes, [*codes[1:], -1], strict=True):
        start = a if start is None else start
        if b != a + 1:
            runs.append(f"\\U{start:08x}-\\U{a:08x}")
            start = None
    return "".join(runs)


#: Unicode's White_Space property
SPACE = r"\t-\r \x85\xa0  -     　"


@lru_cache(maxsize=12)
def compiled(pattern: str, limit: int) -> re.Pattern:
    """The tokenizer's pattern for Python's re, for texts of code points below ``limit``: \\p{L}, \\p{N} and Unicode's \\s
    are spelled out."""
    inside = {r"\p{L}": _ranges("L", limit), r"\p{N}": _ranges("N", limit), r"\s": SPACE}
    out, i, depth = [], 0, 0
    while i < len(pattern):
        for name, chars in inside.items():
            if pattern.startswith(name, i):
                out.append(chars if depth else f"[{chars}]")
                i += len(name)
                break
        else:
            if pattern.startswith(r"\S", i):
                out.append(f"[^{SPACE}]")
                i += 2
                continue
            depth += {"[": 1, "]": -1}.get(pattern[i], 0)
            out.append(pattern[i])
            i += 1
    return re.compile("".join(out))


class Splitter:
    """findall and finditer of the tokenizer's pattern, with classes no wider than the text: re looks up characters in a
    table up to 0xFFFF, and holds all others of a class range by range against each character that the class lacks."""

    def __init__(self, pattern: str):
        self.pattern = pattern

    def _of(self, text: str) -> re.Pattern:
        if text.isascii():
            return compiled(self.pattern, 1 << 7)
        wide = len(text.encode("utf-16-le", "surrogatepass")) > 2 * len(text)
        return compiled(self.pattern, sys.maxunicode + 1 if wide else 1 << 16)

    def findall(self, text: str) -> list[str]:
        return self._of(text).findall(text)

    def finditer(self, text: str, at: int = 0) -> Iterator[re.Match]:
        return self._of(text).finditer(text, at)


def splitter(pattern: str) -> Splitter:
    return Splitter(pattern)


def fold(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > LONG_PIECE:
        return _fold_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    get, none = ranks.get, len(ranks) + (1 << 40)
    pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _fold_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of (rank, place), so a piece of n bytes takes n log n steps."""
    import heapq

    n = len(piece)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(piece[i:end[j]])) is not None:
            heap.append((r, i, end[j])) if not heapified else heapq.heappush(heap, (r, i, end[j]))

    heapified = False
    for i in range(n - 1):
        offer(i)
    heapq.heapify(heap)
    heapified = True
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if not alive[i] or j >= n or end[j] != stop:
            continue
        alive[j], end[i] = False, stop
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


class Words(dict):
    """word -> its ids as little-endian 32-bit integers, folded when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KEPT_WORDS:
            self.clear()
        ids = np.array(fold(word.encode("utf-8"), self.ranks), "<u4").tobytes()
        self[word] = ids
        return ids


class Codec:
    """Encoder and decoder of one tokenizer. What only one of the two needs is made when it is first used."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern

    @cached_property
    def split(self):
        return splitter(self.pattern).findall

    @cached_property
    def words(self) -> Words:
        return Words(self.ranks)

    @cached_property
    def piece(self) -> dict[int, bytes]:
        return {rank: piece for piece, rank in self.ranks.items()}

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.piece.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def tokenizer(file: str = FILE) -> tuple[str, str]:
    """Path and pattern of a public rank file."""
    import public_tokenizers

    return public_tokenizers.path(file), public_tokenizers.PATTERN


def encode_texts(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with ids (binary: little-endian unsigned 32-bit integers)."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((load_ranks(path), pattern))
    kept = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in batches:
            ids = pa.array([codec.encode(t.as_py() or "") for t in batch.column(text)], pa.binary())
            yield extended(batch.select(kept), ids=ids)

    return df.mapInArrow(run, widened(df.drop(text).schema, ids="binary"))


def decode_ids(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with decoded (binary): the bytes that the ids stand for."""
    shared = df.sparkSession.sparkContext.broadcast((load_ranks(path), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in batches:
            yield extended(batch, decoded=pa.array([codec.decode(x.as_py() or b"") for x in batch.column(ids)],
                                                   pa.binary()))

    return df.mapInArrow(run, widened(df.schema, decoded="binary"))


def round_trip(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 for the column text, beside the other columns (without any that have one
    of these three names)."""
    rest = df.drop("n_tokens", "ids_sha256", "decoded_sha256")
    rows, back = packed(rest, "text")
    coded = decode_ids(encode_texts(rows, path, pattern), path, pattern)
    return coded.select(*[c for c, name in zip(back, rest.columns, strict=True) if name != "text"],
                        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), *tokenizer())


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token counts and digests in place of the text."""
    return round_trip(docs, *tokenizer())


def fold_words(words: DataFrame, path: str, buckets: int = 4096) -> DataFrame:
    """rows (word string) with ids (array<int>), by higher-order functions alone: the state of a word is the array of
    its parts, hex coded; each step finds the adjacent pair of least rank in the literal map and joins it. A literal
    map is searched entry by entry, so it is dealt into ``buckets`` small maps by crc32."""
    import json
    import zlib

    dealt: list[dict[str, int]] = [{} for _ in range(buckets)]
    for piece, rank in load_ranks(path).items():
        name = piece.hex().upper()
        dealt[zlib.crc32(name.encode()) % buckets][name] = rank
    literal = F.from_json(F.lit(json.dumps(dealt)), "array<map<string,int>>")
    rank = lambda x: F.element_at(F.get(literal, (F.crc32(x.cast("binary")) % buckets).cast("int")), x)
    none = F.lit(1 << 30)

    def step(parts: Column, _: Column) -> Column:
        pairs = F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x, i: F.coalesce(
            rank(F.concat(x, F.get(parts, i + 1))), none))
        low = F.coalesce(F.array_min(pairs), none)
        at = F.array_position(pairs, low).cast("int")
        joined = F.concat(F.slice(parts, 1, at - 1), F.array(F.concat(F.get(parts, at - 1), F.get(parts, at))),
                          F.slice(parts, at + 2, F.size(parts)))
        return F.when(low == none, parts).otherwise(joined)

    code = F.hex(F.col("word").cast("binary"))
    size = F.octet_length("word")
    parts = F.transform(F.sequence(F.lit(1), size), lambda i: F.substr(code, 2 * i - 1, F.lit(2)))
    folded = F.aggregate(F.sequence(F.lit(1), size), parts, step)
    return words.select("word", F.when(size == 0, F.array().cast("array<int>")).otherwise(
        F.transform(folded, rank)).alias("ids"))
