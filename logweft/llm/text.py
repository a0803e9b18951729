"""Words, hashes and blocks of rows shared by the operators of this package."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Multiplier of the 64-bit mixing below (2**64 divided by the golden ratio, odd).
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as bytes: runs of characters other than space and \\t, \\n, \\v, \\f, \\r."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z lower-cased and no other letter."""
    return text.encode().lower().split() if text else []


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(32))
        x = x * GOLDEN
        x = x ^ (x >> np.uint64(29))
        x = x * GOLDEN
        return x ^ (x >> np.uint64(32))


class WordCodes(dict):
    """Something computed once per distinct word, kept until ``limit`` words are known."""

    def __init__(self, compute, limit: int = 400_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = self.compute(word)
        return found


def crc_rest(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def crc_rest_of(doc_id, modulus: int) -> int:
    """The same for one Python value."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def pieces(batches: Iterable, size_of, limit: int) -> Iterator[list]:
    """Rows of Arrow batches in lists of at most about ``limit`` by ``size_of``; a larger row stands alone."""
    held, size = [], 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            more = size_of(row)
            if held and size + more > limit:
                yield held
                held, size = [], 0
            held.append(row)
            size += more
    if held:
        yield held


def byte_letters() -> dict[str, int]:
    """The letters in which byte-level vocabularies write bytes, and the bytes."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    return letters | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}


def planes(values: np.ndarray) -> bytes:
    """Of integers all first bytes, then all second ones, and so on, which compresses well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def from_planes(data: bytes, kind=np.int32) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
