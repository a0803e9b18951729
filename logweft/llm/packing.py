"""Hierarchical packing of documents into training sequences of several context sizes.

Every document (its tokens and one end token) is routed to the tier of the smallest context size that holds it;
what exceeds the largest context fills windows of that size and only the rest is routed.  Tiers are packed from the
largest to the smallest: an item opens a window of its tier's size, and the gap is filled with the largest whole
items of shorter tiers that fit.  When no whole item fits, the smallest item that is too long is cut to fill the gap
exactly, and what remains of it is routed anew.  So every window is full, and documents are cut only at gaps.  What
is left at the end of a task, less than one smallest window, is cut at powers of two.  Full windows of one tier are
dealt to step groups of ``group_windows`` in order of their attention cost (the sum of squared piece lengths), so
that the members of a step take about the same time.

Work and memory: a task tokenises its rows as they come and packs ``block_tokens`` at a time; what a block leaves
over goes into the next one.  There is no shuffle, no limit on documents, and a lost task is simply run again: ids
are numbered from the task's number, and the same rows give the same pieces.

Defined cases: a null or empty text is a document of the end token alone; repeated rows are packed as often as they
occur; null ids are carried along; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweft.llm.text import byte_letters


@dataclass(frozen=True)
class PackConfig:
    """``context_sizes``: powers of two, largest first; ``vocabulary``: path of the tokenizer's file (JSON)."""

    vocabulary: str
    context_sizes: tuple[int, ...] = (1024, 512, 256, 128)
    end_id: int = 0
    group_windows: int = 8
    block_tokens: int = 1_000_000

    def __post_init__(self):
        sizes = self.context_sizes
        if any(s & (s - 1) or s < 1 for s in sizes) or list(sizes) != sorted(set(sizes), reverse=True):
            raise ValueError("context_sizes must be distinct powers of two, largest first")


# --- tokens ------------------------------------------------------------------------------------------------

class Encoder:
    """Ids of texts under a byte-level BPE vocabulary.

    The file's vocabulary is run by tiktoken, which gives the same ids several times faster.  A text that it cannot
    take (its expressions give up on a million blanks in a row) is encoded, as a whole, by tokenizers.
    """

    def __init__(self, vocabulary: str):
        import tiktoken

        self.vocabulary, self.slow = vocabulary, None
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.coder = tiktoken.Encoding(
            "vocabulary", mergeable_ranks=ranks, special_tokens=special,
            pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        try:
            ids = self.coder.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.vocabulary)
            ids = np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")
        return ids.astype("<u4", copy=False).tobytes()


# --- packing -----------------------------------------------------------------------------------------------


class Pool:
    """Items in order of length; an item is a tuple that begins with its length."""

    def __init__(self):
        self.items: list[tuple] = []
        self.tokens = 0

    def add(self, item: tuple) -> None:
        bisect.insort(self.items, item)
        self.tokens += item[0]

    def load(self, items: list[tuple]) -> None:
        self.items = sorted(items)
        self.tokens = sum(i[0] for i in items)

    def pop(self, index: int) -> tuple:
        item = self.items.pop(index)
        self.tokens -= item[0]
        return item

    def largest(self, most: int) -> int | None:
        """Index of the longest item of at most ``most`` tokens."""
        at = bisect.bisect_right(self.items, (most, float("inf")))
        return at - 1 if at else None


def pack_block(items: list[tuple[int, int, int]], sizes: tuple[int, ...], last: bool):
    """Windows of ``(length, document, start)`` items, each window a pair of its size and its pieces; and what is left.

    All windows are full.  With ``last`` nothing is left: the rest is cut at powers of two.
    """
    pool, windows = Pool(), []
    pool.load(items)
    for size in sizes:
        floor = size // 2 if size != sizes[-1] else 0
        while pool.tokens >= size and pool.items[-1][0] > floor:
            window, gap = [], size
            while gap:
                at = pool.largest(gap)
                if at is not None:
                    piece = pool.pop(at)
                else:
                    length, document, start = pool.pop(0)
                    piece = (gap, document, start)
                    pool.add((length - gap, document, start + gap))
                window.append(piece)
                gap -= piece[0]
            windows.append((size, window))
    if not last:
        return windows, pool.items
    while pool.tokens:
        size = 1 << (pool.tokens.bit_length() - 1)
        window, gap = [], size
        while gap:
            length, document, start = pool.pop(-1)
            if length > gap:
                pool.add((length - gap, document, start + gap))
                length = gap
            window.append((length, document, start))
            gap -= length
        windows.append((size, window))
    return windows, []


def _long_body(length: int, size: int) -> int:
    """Tokens of a document that fill whole windows of their own."""
    return length // size * size if length > size else 0


_FIELDS = [
    ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("context_size", pa.int32()), ("step_group", pa.int64())]


class _Task:
    """Packs the rows of one task; ``kept`` holds the ids of documents that still have pieces to place."""

    def __init__(self, config: PackConfig, with_ids: bool, id_type: pa.DataType, task: int):
        self.config, self.with_ids, self.id_type, self.base = config, with_ids, id_type, task << 33
        self.sequences = self.groups = self.documents = self.waiting = 0
        self.kept: dict[int, tuple] = {}
        self.items: list[tuple[int, int, int]] = []
        self.windows: list[tuple[int, list]] = []

    def add(self, doc_id, ids: bytes) -> None:
        self.documents += 1
        length, largest = len(ids) // 4, self.config.context_sizes[0]
        self.kept[self.documents] = (doc_id, ids)
        body = _long_body(length, largest)
        self.windows += [(largest, [(largest, self.documents, s)]) for s in range(0, body, largest)]
        if length > body:
            self.items.append((length - body, self.documents, body))
        self.waiting += length

    def batches(self, last: bool):
        """Rows of all windows that can be filled now."""
        found, self.items = pack_block(self.items, self.config.context_sizes, last)
        found = [*self.windows, *found]
        self.windows, self.waiting = [], sum(i[0] for i in self.items)
        # Step groups: of each size, windows of like cost; what does not fill a group is one of its own at the end.
        found.sort(key=lambda w: (-w[0], sum(p[0] ** 2 for p in w[1]), w[1]))
        rows, size, members = [], None, 0
        for window_size, window in found:
            if window_size != size or members == self.config.group_windows:
                size, members = window_size, 0
                self.groups += 1
            members += 1
            sequence, offset = self.base + self.sequences, 0
            self.sequences += 1
            for length, document, start in window:
                doc_id, ids = self.kept[document]
                part = ids[4 * start: 4 * (start + length)]
                rows.append((doc_id, start, length, zlib.crc32(part), len(ids) // 4, sequence, offset, window_size,
                             self.base + self.groups, *([part] if self.with_ids else [])))
                offset += length
        waiting = {i[1] for i in self.items}
        self.kept = {d: self.kept[d] for d in waiting}
        fields = [("doc_id", self.id_type), *_FIELDS, *([("ids", pa.binary())] if self.with_ids else [])]
        for begin in range(0, len(rows), 20_000):
            columns = list(zip(*rows[begin: begin + 20_000], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def pack_documents(docs: DataFrame, config: PackConfig, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, its window's
    ``context_size`` and ``step_group``, and with ``with_ids`` the ids themselves (little-endian, 4 bytes each)."""
    end = np.array([config.end_id], "<u4").tobytes()
    rows = docs.select("doc_id", "text")

    def run(batches):
        encoder, task = None, None
        for batch in batches:
            if task is None:
                encoder = Encoder(config.vocabulary)
                task = _Task(config, with_ids, batch.schema.field(0).type, TaskContext.get().partitionId())
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    task.add(doc_id, encoder.ids(text or "") + end)
                    if task.waiting >= config.block_tokens:
                        yield from task.batches(last=False)
        if task is not None:
            yield from task.batches(last=True)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
              "context_size int, step_group long" + (", ids binary" if with_ids else ""))
    return rows.mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence of pieces that carry ``ids``: ``sequence_id, context_size, step_group, n_tokens, ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id", "context_size", "step_group").agg(
        F.sum("length").alias("n_tokens"), F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), "").alias("_hex"),
    ).select("sequence_id", "context_size", "step_group", "n_tokens", F.unhex("_hex").alias("ids"))
