"""Byte-level BPE encoding as a tree of joins, and decoding as concatenation up the tree.

Encodings form a monoid under `join`: a piece is halved until a half has LEAF bytes, and neighbours are joined by
encoding a window about their boundary anew. A sequence of tokens is the encoding of its bytes if and only if every two
neighbours are the encoding of theirs. So the window grows, on the side that needs it, until its ends go with the tokens
outside; those are then final, and so is the whole. Texts are cut at pattern matches, which are encoded each for
itself; a match that is a token stays one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Generations, by_value, worker_cache

LEAF = 16
#: Tokens of a leaf in decoding.
LEAVES = 256
#: Units and matches that a worker remembers, twice over, and pairs of tokens.
UNITS, MATCHES, CACHED = 200_000, 150_000, 400_000
#: Unicode's White_Space, as regular expressions of tokenizers' libraries have it.
WHITE = "\t-\r \x85\xa0  -     　"


def units(text: str) -> list[str]:
    """The text cut before spaces that start a match in any context: those after a non-space or before one."""
    import re

    if re.search(r"\s (?:\s|\Z)", text) is None:
        first, *rest = text.split(" ")
        return [first, *(" " + x for x in rest)] if first else [" " + x for x in rest]
    return [x for x in re.split(r"(?<!\s)(?= )|(?= \S)", text) if x]


def finder(pattern: str):
    """A function that lists a text's matches, with white space as tokenizers' libraries have it."""
    import regex

    fixed = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]")
    return regex.compile(fixed).findall


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.token = ranks, {i: t for t, i in ranks.items()}
        self.find = finder(pattern)
        self.cache, self.of_match = Generations(UNITS), Generations(MATCHES)
        self.fits: dict[tuple[int, int], bool] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The encoding by merges of the lowest rank, leftmost first, with a heap over a linked list."""
        ranks, n = self.ranks, len(piece)
        if n == 1:
            return [ranks[piece]]
        stop = list(range(1, n + 1))  # of the part that starts at each place; 0: merged into another
        prev = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            mid = stop[i]
            if not mid or mid >= n or stop[mid] != end:
                continue
            stop[i], stop[mid] = end, 0
            if end < n:
                prev[end] = i
                if (r := ranks.get(piece[i : stop[end]])) is not None:
                    heapq.heappush(heap, (r, i, stop[end]))
            if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : stop[i]]])
            i = stop[i]
        return out

    def fit(self, a: int, b: int) -> bool:
        """Whether the two tokens are the encoding of their bytes."""
        if (a, b) not in self.fits:
            if len(self.fits) > CACHED:
                self.fits.clear()
            self.fits[a, b] = self.merge(self.token[a] + self.token[b]) == [a, b]
        return self.fits[a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings, one after the other."""
        if not left or not right:
            return left or right
        i = j = 1
        while True:
            window = self.merge(b"".join(map(self.token.__getitem__, left[-i:] + right[:j])))
            on_left = i == len(left) or self.fit(left[-i - 1], window[0])
            on_right = j == len(right) or self.fit(window[-1], right[j])
            if on_left and on_right:
                return left[:-i] + window + right[j:]
            i = i if on_left else min(len(left), 2 * i)
            j = j if on_right else min(len(right), 2 * j)

    def tree(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join(self.tree(piece[:half]), self.tree(piece[half:]))

    def match(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return self.tree(piece) if whole is None else [whole]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        import struct

        parts = units(text)
        for u in self.cache.lacks(set(parts)):
            matches = self.find(u)
            for m in self.of_match.lacks(set(matches)):
                ids = self.match(m.encode("utf-8", "surrogatepass"))
                self.of_match[m] = struct.pack(f"<{len(ids)}I", *ids)
            self.cache[u] = b"".join(map(self.of_match.__getitem__, matches))
        return b"".join(map(self.cache.__getitem__, parts))

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids: leaves of LEAVES tokens, and neighbours concatenated up the tree."""
        import numpy as np

        tokens = list(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        parts = [b"".join(tokens[i : i + LEAVES]) for i in range(0, len(tokens), LEAVES)] or [b""]
        while len(parts) > 1:
            parts = [a + b for a, b in zip(parts[::2], [*parts[1::2], b""])]
        return parts[0]


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file: a line has a token in base 64 and its rank."""
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a vocabulary file, which is part of every machine's Python installation."""
    kept = worker_cache("bpe")
    if (path, pattern) not in kept:
        kept.clear()
        kept[path, pattern] = Codec(read_ranks(path), pattern)
    return kept[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """docs with the ids of the whole text, as binary little-endian unsigned 32-bit integers.

    Null text counts as empty: no ids. Rows are encoded alone, whole however long; an empty table gives no rows; a
    column named like the result is replaced."""
    return _through(docs, text_col, out, lambda c, t: c.encode(t or ""), path, pattern)


def decode(tokens: DataFrame, path: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """tokens with the bytes that the ids stand for; null ids count as none."""
    return _through(tokens, ids_col, out, lambda c, x: c.decode(x or b""), path, pattern)


def _through(df: DataFrame, col: str, out: str, step, path: str, pattern: str) -> DataFrame:
    from pyspark.sql import types as T

    df = df.select(*(c for c in df.columns if c != out))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator) -> Iterator:
        c = codec(path, pattern)
        for b in batches:
            for i in range(0, len(b), 1000):
                part = b.iloc[i : i + 1000]
                yield part.assign(**{out: [step(c, x) for x in part[col]]})

    return df.mapInPandas(run, schema)


by_value(__name__)
