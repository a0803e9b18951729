"""Alignment of two tokenizers over the same texts, and how often their tokens are linked.

A is a byte-level BPE (tokenizers), B a BPE of pieces with byte fallback (sentencepiece).  Both read a space and the
text.  Byte offsets at which a token of both ends cut the tokens into groups, and link the two tokens that end there.

Coarse cuts are the character offsets of tokenizers and the spans of sentencepiece's proto.  They are exact where the
next token begins where the last one ended.  Where several tokens share one character - bytes of a multibyte character
in A, byte-fallback tokens in B - their spans overlap or are empty; there, ends are refined by adding up the bytes that
the tokens decode to.  A text counts only if all decoded bytes of A, and all of B, are the space and the text.

No token of either crosses a single space between two other characters: A's words begin there, and no piece of B has
a space after another character.  Both begin a token at that space, so a text is cut there into segments, each aligned
by itself, and a worker remembers those it has met.  Where the two files do not allow that (it is looked up when they
are loaded), a text is one segment.

Counts of linked pairs are over the whole corpus:

1. One pass tokenises, aligns and writes blocks: per text its counts, the digest of its groups and its links as codes
   of the block's own pairs, most frequent first (codes are kept in byte planes, which compress); and per block its
   pairs and their counts.  A block is several rows, strips of some texts each, of which the first has the pairs: rows
   of megabytes would be copied whole at every step, and fill the executors' heaps.
2. Blocks' pairs are added up, with partial sums per task, and marked where they are their B id's most frequent: a
   B id has at most as many pairs as A has tokens.
3. What a block asked for comes back to it: texts of a block are cogrouped with its pairs' counts.

Pair counts are broadcast up to ``broadcast_pairs`` rows of fixed width; beyond, they are joined by shuffle.

Defined cases: a null or empty text, and one that either tokenizer does not give back byte by byte, has no tokens; the
strings of special tokens are plain text; null ids and repeated rows are carried along, every row counts; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import contextlib
import functools
import gc
import hashlib
import itertools
import json
import operator
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweft.llm.landing import LONG_ROWS, Scratch, landed, small
from logweft.llm.text import byte_letters, from_planes, planes


@dataclass(frozen=True)
class AlignConfig:
    """``byte_vocabulary``: tokenizers' file (JSON); ``piece_model``: sentencepiece's file.  ``block_links``: about;
    ``strip_links``: at most, or one text."""

    byte_vocabulary: str
    piece_model: str
    block_links: int = 600_000
    strip_links: int = 32_000
    broadcast_pairs: int = 1_000_000


# --- one text ----------------------------------------------------------------------------------------------


@dataclass
class Aligned:
    """Ids of both; for every group the number of tokens of each up to its end, and its end in bytes."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    cuts: np.ndarray


#: A space between two characters that are no white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")

_ID, _END = operator.attrgetter("id"), operator.attrgetter("end")

#: Segments that a worker remembers, twice as many at most.
REMEMBERED = 150_000

#: Bytes of texts that a worker gets at once, or one text.
BATCH_BYTES = 4 << 20

_NONE = Aligned(*(np.empty(0, np.int64) for _ in range(5)))


def refined(begins: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ends of tokens in bytes, from spans in bytes and decoded lengths.

    A span is a cut where it is not empty and the next one begins at its end; in between, decoded bytes are added up.
    """
    cut = ends > begins
    cut[:-1] &= begins[1:] == ends[:-1]
    total = np.cumsum(lengths)
    last = np.maximum.accumulate(np.where(cut, np.arange(len(cut)), -1))
    since = np.where(last >= 0, ends[last] - total[last], 0)
    return total + since


@contextlib.contextmanager
def _uncollected():
    """Without looking for cycles: what is made meanwhile are strings, numbers and very many tuples of these."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


class Aligner:
    """Both tokenizers; one per worker."""

    def __init__(self, config: AlignConfig):
        import sentencepiece
        from tokenizers import Tokenizer

        self.byte_bpe = Tokenizer.from_file(config.byte_vocabulary)
        self.byte_bpe.encode_special_tokens = True
        with open(config.byte_vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        added = {t["content"] for t in spec.get("added_tokens", [])}
        letters = byte_letters()
        self.a_bytes = [b""] * self.byte_bpe.get_vocab_size(with_added_tokens=True)
        for token, i in self.byte_bpe.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = token.encode() if token in added else bytes(letters[c] for c in token)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=config.piece_model)
        self.b_bytes = [
            bytes([int(self.pieces.id_to_piece(i)[3:5], 16)]) if self.pieces.is_byte(i)
            else self.pieces.id_to_piece(i).replace("▁", " ").encode() for i in range(self.pieces.get_piece_size())]
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in known], np.int64) for known in (self.a_bytes, self.b_bytes))
        # Ids as written in a group: first all that go on, then all that end their side of a group.
        self.writing = [f"{i}{end}" for ids, last in ((self.a_bytes, "|"), (self.b_bytes, ";")) for end in (",", last) for i in range(len(ids))]

        words = spec.get("pre_tokenizer") or {}
        self.cuts = (
            words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space")
            and not spec.get("normalizer") and not any(b" " in x.lstrip(b" ") for x in self.b_bytes))
        #: Segments met lately, and those before them, of which those still in use move up.
        self.known: dict[str, tuple | None] = {}
        self.earlier: dict[str, tuple | None] = {}

    def _learn(self, segments: list[str]) -> dict[str, tuple | None]:
        """Per segment its groups as text, links, and the numbers of tokens of both; None where bytes are lost."""
        x = self.align(" ".join(segments))
        if not len(x.a):
            return {s: None if len(segments) == 1 else self._learn([s])[s] for s in segments}
        links = x.a[x.a_ends - 1] << 32 | x.b[x.b_ends - 1]
        written = list(map(self.writing.__getitem__, self._codes(x).tolist()))
        # Segments end where both end; of each, the groups, and the tokens up to there.
        sizes = np.fromiter(map(len, map(str.encode, segments)), np.int64, len(segments)) + 1
        upto = np.append(0, np.searchsorted(x.cuts, np.cumsum(sizes)) + 1)
        a_upto, b_upto = np.append(0, x.a_ends)[upto], np.append(0, x.b_ends)[upto]
        at, n_a, n_b, upto = (v.tolist() for v in (a_upto + b_upto, np.diff(a_upto), np.diff(b_upto), upto))
        return {s: ("".join(written[at[k]: at[k + 1]])[:-1], links[upto[k]: upto[k + 1]].tobytes(), n_a[k], n_b[k])
                for k, s in enumerate(segments)}

    @_uncollected()
    def whole(self, texts: list[str | None]) -> list[tuple[str, bytes, int, int]]:
        """The same of whole texts, segment by segment; without tokens where bytes are lost."""
        parts = [(_CUT.split(t) if self.cuts else [t]) if t else [] for t in texts]
        wanted = set().union(*parts)
        for segment in wanted.intersection(self.earlier):
            self.known[segment] = self.earlier.pop(segment)
        new = wanted.difference(self.known)
        # Segments with white space at an end, those at the ends of texts, cannot be put next to others.
        alone = [p for p in new if not self.cuts or p[0].isspace() or p[-1].isspace()]
        new = list(set(new).difference(alone))
        learned: dict[str, tuple | None] = {}
        for begin, end in _runs(new, 200_000):
            learned |= self._learn(new[begin:end])
        for segment in alone:
            learned |= self._learn([segment])
        known = self.known
        known.update(learned)
        out = []
        for own in parts:
            found = list(map(known.__getitem__, own))
            if not found or None in found:
                out.append(("", b"", 0, 0))
                continue
            groups, links, n_a, n_b = zip(*found, strict=True)
            out.append((";".join(groups), b"".join(links), sum(n_a), sum(n_b)))
        for segment in learned:
            if len(segment) >= 48:
                del known[segment]
        if len(known) > REMEMBERED:
            self.known, self.earlier = {}, known
        return out

    def align(self, text: str | None) -> Aligned:
        """One segment."""
        if not text:
            return _NONE
        whole = " " + text
        data = whole.encode()
        coded = self.byte_bpe.encode(whole, add_special_tokens=False)
        ids = coded.ids
        if b"".join(map(self.a_bytes.__getitem__, ids)) != data:
            return _NONE
        a = np.array(ids, np.int64)
        spans = np.fromiter(itertools.chain.from_iterable(coded.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        if len(data) != len(whole):
            points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
            widths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
            spans = np.append(0, np.cumsum(widths))[spans]
        a_ends = refined(spans[:, 0], spans[:, 1], self.a_lengths[a])

        found = self.pieces.encode(text, return_type="proto").pieces
        ids = list(map(_ID, found))
        if b"".join(map(self.b_bytes.__getitem__, ids)) != data:
            return _NONE
        b = np.array(ids, np.int64)
        # A span begins where the last one ended; those of the proto do not count the space before the text.
        ends = np.fromiter(map(_END, found), np.int64, len(ids)) + 1
        b_ends = refined(np.append(0, ends[:-1]), ends, self.b_lengths[b])

        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        return Aligned(a, b, np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1, common)

    def written(self, x: Aligned) -> str:
        """The groups as text: ids of A, a bar, ids of B; groups divided by semicolons."""
        return "".join(map(self.writing.__getitem__, self._codes(x).tolist()))[:-1] if len(x.a) else ""

    def _codes(self, x: Aligned) -> np.ndarray:
        """Places in ``writing`` of all tokens, in the order of groups."""
        last_a, last_b = np.zeros(len(x.a), np.int64), np.zeros(len(x.b), np.int64)
        last_a[x.a_ends - 1] = 1
        last_b[x.b_ends - 1] = 1
        # A token stands after all of its own side and all groups of the other side that come first.
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        at_a = np.arange(len(x.a)) + np.append(0, x.b_ends)[group_a]
        at_b = np.arange(len(x.b)) + x.a_ends[group_b]
        codes = np.empty(len(x.a) + len(x.b), np.int64)
        codes[at_a] = x.a + last_a * len(self.a_bytes)
        codes[at_b] = x.b + last_b * len(self.b_bytes) + 2 * len(self.a_bytes)
        return codes


def _runs(segments: list[str], limit: int):
    """Begins and ends of runs of segments of about ``limit`` characters."""
    begin = size = 0
    for k, segment in enumerate(segments):
        if size and size + len(segment) > limit:
            yield begin, k
            begin, size = k, 0
        size += len(segment) + 1
    if segments:
        yield begin, len(segments)


# --- blocks ------------------------------------------------------------------------------------------------

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


@dataclass
class _Block:
    """Texts of a block: per text ids, counts and digests; and the links of all, one after the other."""

    doc_ids: list = field(default_factory=list)
    counts: list = field(default_factory=list)
    digests: list = field(default_factory=list)
    groups: list = field(default_factory=list)
    links: list = field(default_factory=list)
    size: int = 0

    def add(self, doc_id, groups: str, links: bytes, n_a: int, n_b: int, with_groups: bool) -> None:
        n_links = len(links) // 8  # a group ends where two tokens end, so it has one link
        self.doc_ids.append(doc_id)
        self.counts.append((n_a, n_b, n_links, n_links))
        self.digests.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        if with_groups:
            self.groups.append(groups)
        self.links.append(links)
        self.size += n_links + 50

    def batch(self, number: int, id_type: pa.DataType, strip_links: int) -> pa.RecordBatch:
        """The block's strips."""
        pairs, place, often = np.unique(np.frombuffer(b"".join(self.links), np.int64), return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        code = np.empty(len(order), np.int32)
        code[order] = np.arange(len(order), dtype=np.int32)
        pairs, codes = pairs[order], code[place]
        upto = np.append(0, np.cumsum([len(x) // 8 for x in self.links]))
        strips = list(_strips(upto.tolist(), strip_links))
        first = lambda v: [v] + [v[:0]] * (len(strips) - 1)
        columns = {
            "block": pa.array([number] * len(strips), pa.int64()),
            "doc_ids": pa.array([self.doc_ids[i:j] for i, j in strips], pa.list_(id_type)),
            **{name: pa.array([list(c[i:j]) for i, j in strips], pa.list_(pa.int64()))
               for name, c in zip(_COUNTS, zip(*self.counts, strict=True), strict=True)},
            "digests": pa.array([self.digests[i:j] for i, j in strips], pa.list_(pa.string())),
            "written": pa.array([self.groups[i:j] for i, j in strips], pa.list_(pa.string())),
            "codes": pa.array([planes(codes[upto[i]: upto[j]]) for i, j in strips], pa.binary()),
            "a": pa.array(first((pairs >> 32).astype(np.int32)), pa.list_(pa.int32())),
            "b": pa.array(first((pairs & 0xFFFFFFFF).astype(np.int32)), pa.list_(pa.int32())),
            "n": pa.array(first(often[order]), pa.list_(pa.int64()))}
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _strips(upto: list[int], limit: int):
    """Begins and ends of runs of texts of ``limit`` links at most, or one; ``upto`` links end before each, and with all."""
    begin = 0
    for k in range(1, len(upto)):
        if k + 1 == len(upto) or upto[k + 1] - upto[begin] > limit or k - begin >= 1_000:
            yield begin, k
            begin = k


@functools.lru_cache(1)
def _aligner(config: AlignConfig) -> Aligner:
    """One per worker, over all its tasks."""
    return Aligner(config)


def aligned_blocks(docs: DataFrame, config: AlignConfig, with_groups: bool = False) -> DataFrame:
    """One row per strip of a block of a task's texts."""
    rows = docs.select("doc_id", "text")

    def run(batches):
        aligner, block, number, kind = None, _Block(), TaskContext.get().partitionId() << 32, None
        for batch in batches:
            if aligner is None:
                aligner, kind = _aligner(config), batch.schema.field(0).type
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                for doc_id, found in zip(part.column(0).to_pylist(), aligner.whole(part.column(1).to_pylist()), strict=True):
                    block.add(doc_id, *found, with_groups)
                    if block.size >= config.block_links:
                        yield block.batch(number, kind, config.strip_links)
                        block, number = _Block(), number + 1
        if block.doc_ids:
            yield block.batch(number, kind, config.strip_links)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"block long, doc_ids array<{kind}>, {', '.join(f'{c} array<long>' for c in _COUNTS)}, digests array<string>, "
             "written array<string>, codes binary, a array<int>, b array<int>, n array<long>")


def pair_counts(asked: DataFrame) -> DataFrame:
    """``a, b, count, best`` of all pairs ``a, b, n``; ``best`` where no pair of the same ``b`` has a higher count."""
    counts = asked.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def _finish(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """The texts of a block with their links' counts."""
    if _aligner.cache_info().currsize:  # this worker has aligned, and is done with that
        _aligner.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
    row = {c: texts.column(c).combine_chunks() for c in texts.column_names}
    codes = np.concatenate([from_planes(strip.as_py()) for strip in row["codes"]])
    at = answers.column("code").to_numpy()
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    count[at], best[at] = answers.column("count").to_numpy(), answers.column("best").to_numpy(zero_copy_only=False)
    links = row["n_links"].flatten().to_numpy()
    ends = np.cumsum(links)
    per_text = lambda v: (s := np.append(0, np.cumsum(v)))[ends] - s[ends - links]
    columns = {"doc_id": row["doc_ids"].flatten(), **{c: row[c].flatten() for c in _COUNTS},
               "n_best": pa.array(per_text(best[codes]), pa.int64()), "count_sum": pa.array(per_text(count[codes]), pa.int64()),
               "groups_sha256": row["digests"].flatten()}
    if "written" in row:
        columns["groups"] = row["written"].flatten()
    return pa.table(columns)


def align(docs: DataFrame, config: AlignConfig, with_groups: bool = False) -> DataFrame:
    """Per row ``doc_id``, the numbers of tokens ``n_a, n_b``, of ``n_groups`` and ``n_links``, ``n_best`` (links whose
    pair is the most frequent of its B id), ``count_sum`` (their counts added up) and ``groups_sha256``; with
    ``with_groups`` the groups themselves as text."""
    scratch = Scratch(docs.sparkSession, "alignment")
    blocks = scratch.land(aligned_blocks(docs, config, with_groups), "blocks", BATCH_BYTES, **LONG_ROWS)
    asked = blocks.select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("code", "pair")).select(
        F.col("block").alias("asking"), "code", "pair.a", "pair.b", "pair.n")
    counts = scratch.land(pair_counts(asked), "pairs")
    answers = asked.drop("n").join(small(counts, config.broadcast_pairs), ["a", "b"]).select("asking", "code", "count", "best")
    texts = blocks.select("block", "doc_ids", *_COUNTS, "digests", "codes", *(["written"] if with_groups else []))
    kind = docs.schema["doc_id"].dataType.simpleString()
    result = landed(texts.groupBy("block").cogroup(answers.groupBy("asking")).applyInArrow(
        _finish, f"doc_id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, n_best long, count_sum long, groups_sha256 string"
        + (", groups string" if with_groups else "")), "alignment-counts")
    scratch.drop()
    return result
