"""Language-model scores by a weighted backoff automaton over n-grams.

States are the contexts seen in training: no word (the root), one word (or the start of a text), and so on up to
``order - 1`` words.  An arc leads from a state by a word seen after it; where there is none, the failure arc leads to
the state of the context without its first word, down to the root, which has an arc for every known word and one for
all unknown words together.  Smoothing is by a Dirichlet prior around the next shorter state (MacKay and Peto 1995): a
state seen ``c`` times has the failure weight ``k / (c + k)``, and an arc seen ``n`` times the weight ``n / (c + k)``
plus what comes by the failure arc, so all words together have the probability 1 in every state.  The root discounts
absolutely.  ``k`` of an order and the discount come from the numbers of n-grams seen, seen once and seen twice.  A text
is scored in one pass from left to right: the state is the longest context that was seen, the weights of the failure
chain below it are multiplied up from the root.

The automaton grows with the corpus, so it is nowhere held whole.  Texts are coded in blocks; a block asks for the
counts of its own distinct n-grams, and what comes back is the part of the automaton that its texts can reach:

1. One pass over the texts writes blocks: word codes and the block's vocabulary.
2. Per order, blocks' counts are added up in buckets of n-grams and sent back per block.  A bucket is chosen by one
   hash, and n-grams within it, about ``bucket_entries`` however large the corpus is, are told apart by 48 bits of
   another: two are mixed up in one of some 700 million cases.  A frequent n-gram is one entry per block, not one per occurrence.
3. Each block is traversed.

The count of a state is that of its own n-gram, since every word but the end is followed by one; states of one start
are as many as texts.

Defined cases: a null text is empty, and an empty text is its end alone; words that training lacks share one
probability; without training texts every score is 0; repeated rows count and are scored as often as they occur;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm.landing import Scratch, landed
from logweft.llm.text import GOLDEN, from_planes, lower_words, mix, planes

#: Hashes of the end of a text and of its start; no word is empty or a line break.
END = xxhash.xxh3_64_intdigest(b"")
START = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))
#: Multiplier of the hashes by which buckets are chosen, odd.
OTHER = np.uint64(0xD1B54A32D192ED03)


@dataclass(frozen=True)
class LmConfig:
    """``order``: words of the longest n-grams; ``block_chars``: text of a block; ``bucket_entries``: keys that meet in
    one group, about."""

    order: int = 3
    block_chars: int = 1_000_000
    bucket_entries: int = 400_000


# --- blocks ------------------------------------------------------------------------------------------------


class _Codes(dict):
    def __missing__(self, word):
        code = self[word] = len(self)
        return code


class _Block:
    """Texts as codes of the block's own words, which are in order of their hashes."""

    def __init__(self):
        self.codes = _Codes()
        self.doc_ids, self.held, self.sizes, self.parts, self.chars = [], [], [], [], 0

    def add(self, doc_id, text: str | None, held: bool) -> None:
        words = lower_words(text)
        words.append(b"")
        self.parts.append(np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words)))
        self.doc_ids.append(doc_id)
        self.held.append(held)
        self.sizes.append(len(words))
        self.chars += len(text or "")

    def batch(self, block: int, fields: pa.Schema) -> pa.RecordBatch:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.codes), np.uint64, len(self.codes))
        words, place = np.unique(hashes, return_inverse=True)
        codes = place.astype(np.int32)[np.concatenate(self.parts)]
        n_train = sum(n for n, held in zip(self.sizes, self.held, strict=True) if not held)
        return pa.RecordBatch.from_arrays([
            pa.array([block], pa.int64()), pa.array([self.doc_ids], fields.field("doc_ids").type),
            pa.array([self.held], pa.list_(pa.bool_())), pa.array([self.sizes], pa.list_(pa.int64())),
            pa.array([planes(codes)], pa.binary()), pa.array([words.tobytes()], pa.binary()),
            pa.array([n_train], pa.int64()), pa.array([len(words)], pa.int64()), pa.array([len(codes)], pa.int64())], schema=fields)


def coded_blocks(docs: DataFrame, held_out: Column, config: LmConfig) -> DataFrame:
    """One row per block of a task's texts."""
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held"))

    def run(batches):
        block, number, fields = _Block(), 0, None
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            if fields is None:
                fields = pa.schema([
                    ("block", pa.int64()), ("doc_ids", pa.list_(batch.schema.field(0).type)), ("held", pa.list_(pa.bool_())),
                    ("sizes", pa.list_(pa.int64())), ("codes", pa.binary()), ("words", pa.binary()),
                    ("n_train", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])
            for start in range(0, batch.num_rows, 200):
                for row in zip(*(c.to_pylist() for c in batch.slice(start, 200).columns), strict=True):
                    block.add(*row)
                    if block.chars >= config.block_chars:
                        yield block.batch(base + number, fields)
                        block, number = _Block(), number + 1
        if block.sizes:
            yield block.batch(base + number, fields)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"block long, doc_ids array<{kind}>, held array<boolean>, sizes array<long>, codes binary, words binary, "
             "n_train long, n_words long, n_tokens long")


# --- n-grams -----------------------------------------------------------------------------------------------


class Grams:
    """The n-grams of a block's texts.

    ``key[m]`` and ``alt[m]`` hash the ``m`` words that end at a token, the start of its text among them; ``whole[m]``
    tells where there are as many.
    """

    def __init__(self, sizes, codes: bytes, words: bytes, order: int):
        own = np.frombuffer(words, np.uint64)[from_planes(codes)]
        with np.errstate(over="ignore"):
            other = mix(own + OTHER)
        sizes = np.asarray(sizes, np.int64)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        place = np.arange(len(own)) - np.repeat(self.starts, sizes)
        self.key, self.alt, self.whole = [None, own], [None, other], [None, np.ones(len(own), bool)]
        for m in range(2, order + 1):
            whole = place >= m - 2
            for kept, first, factor in ((self.key, START, GOLDEN), (self.alt, mix(np.array([START]))[0], OTHER)):
                before = np.roll(kept[m - 1], 1)
                if m == 2:
                    before[self.starts] = first
                with np.errstate(over="ignore"):
                    kept.append(mix(before * factor + kept[1]))
            self.whole.append(whole)

    def distinct(self, m: int, bits: int):
        """Distinct keys of order ``m`` in the order in which they are asked for, their buckets, where each token's key
        is among them, and which tokens have one."""
        at = np.flatnonzero(self.whole[m])
        keys, first, place = np.unique(self.key[m][at], return_index=True, return_inverse=True)
        buckets = (self.alt[m][at[first]] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        order = np.argsort(buckets, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return keys[order], buckets[order], rank[place], at


# --- counts ------------------------------------------------------------------------------------------------


def _bits(entries: int, config: LmConfig) -> int:
    return min(30, max(0, math.ceil(math.log2(max(1, entries) / config.bucket_entries))))


def _trained(held, sizes) -> np.ndarray:
    return ~np.repeat(np.asarray(held, bool), np.asarray(sizes, np.int64))


def high_bytes(keys: np.ndarray) -> bytes:
    """The upper 48 bits of keys."""
    return np.ascontiguousarray(keys.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def from_high_bytes(data) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def asked(blocks: DataFrame, m: int, bits: int) -> DataFrame:
    """Per block and bucket the distinct n-grams of order ``m`` and their counts in the block's training texts."""

    def run(batches):
        for batch in batches:
            for block, held, sizes, codes, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, buckets, place, at = Grams(sizes, codes, words, m).distinct(m, bits)
                counts = np.bincount(place[_trained(held, sizes)[at]], minlength=len(keys)).astype(np.uint32)
                cuts = [*np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])), len(keys)] if len(keys) else []
                for begin, end in zip(cuts, cuts[1:]):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([buckets[begin]], pa.int32()), pa.array([block], pa.int64()),
                        pa.array([high_bytes(keys[begin:end])], pa.binary()), pa.array([planes(counts[begin:end])], pa.binary()),
                    ], ["bucket", "block", "keys", "counts"])

    return blocks.select("block", "held", "sizes", "codes", "words").mapInArrow(run, "bucket int, block long, keys binary, counts binary")


def _added(rows: pa.Table) -> pa.Table:
    """The totals that each block of a bucket asked for, and a row of block -1 with what concerns the whole bucket."""
    pa.default_memory_pool().release_unused()  # of the group before
    keys = [from_high_bytes(k.as_buffer()) for k in rows.column("keys")]
    counts = np.concatenate([from_planes(c.as_buffer(), np.uint32) for c in rows.column("counts")])
    ends = np.cumsum([len(k) for k in keys])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.uint64)
    found = totals[place]
    parts = [planes(found[b:e]) for b, e in zip(np.append(0, ends[:-1]), ends, strict=True)]
    n = len(parts)
    whole = [[0] * n + [int(x)] for x in ((totals > 0).sum(), (totals == 1).sum(), (totals == 2).sum())]
    return pa.table({
        "block": pa.array([*rows.column("block").to_pylist(), -1], pa.int64()),
        "bucket": pa.array([*rows.column("bucket").to_pylist(), -1], pa.int32()), "totals": pa.array([*parts, b""], pa.binary()),
        "n_seen": pa.array(whole[0], pa.int64()), "n_once": pa.array(whole[1], pa.int64()), "n_twice": pa.array(whole[2], pa.int64())})


def totals(blocks: DataFrame, m: int, bits: int) -> DataFrame:
    """Training counts of all blocks together for the n-grams of each block, in the order of ``Grams.distinct``."""
    return asked(blocks, m, bits).groupBy("bucket").applyInArrow(
        _added, "block long, bucket int, totals binary, n_seen long, n_once long, n_twice long")


# --- automaton ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """What is the same for all blocks; ``prior[m]`` is the ``k`` of order ``m``, ``bits[m]`` those of its buckets."""

    tokens: int
    vocabulary: int
    word_discount: float
    prior: tuple[float, ...]
    bits: tuple[int, ...]

    @property
    def order(self) -> int:
        return len(self.bits) - 1


def discount(once: int, twice: int) -> float:
    """The absolute discount; a half where the counts of counts are empty."""
    return once / (once + 2 * twice) if once and twice else 0.5


def root_weights(model: Model, counts: np.ndarray) -> np.ndarray:
    """Probabilities of words by the arcs of the root."""
    left = model.word_discount * model.vocabulary / model.tokens
    return np.where(counts > 0, (counts - model.word_discount) / model.tokens, left)


def traverse(model: Model, counts: list, states: list, whole: list) -> np.ndarray:
    """Log10 weight of every step: ``counts[m]`` of the n-gram of order ``m`` that ends there, ``states[m]`` of the
    context that it leaves, where ``whole[m]``."""
    if not model.tokens:
        return np.zeros(len(counts[1]))
    weight = root_weights(model, counts[1])
    for m in range(2, model.order + 1):
        k = model.prior[m]
        weight = np.where(whole[m], (counts[m] + k * weight) / (states[m] + k), weight)
    return np.log10(weight)


def score_block(block: pa.Table, answers: pa.Table, model: Model) -> pa.Table:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of a block's texts."""
    pa.default_memory_pool().release_unused()  # of the block before
    row = {c: block.column(c)[0] for c in block.column_names}
    sizes = np.asarray(row["sizes"].as_py(), np.int64)
    grams = Grams(sizes, row["codes"].as_py(), row["words"].as_py(), model.order)
    answered: dict[int, list] = {}
    for order, bucket, found in zip(*(answers.column(c).to_pylist() for c in ("order", "bucket", "totals")), strict=True):
        answered.setdefault(order, []).append((bucket, from_planes(found, np.uint64)))
    counts, states = [None], [None, None]
    for m in range(1, model.order + 1):
        _, _, place, at = grams.distinct(m, model.bits[m])
        found = np.zeros(len(grams.key[1]), np.int64)
        found[at] = np.concatenate([t for _, t in sorted(answered[m], key=lambda x: x[0])])[place] if m in answered else 0
        counts.append(found)
        if m < model.order:
            before = np.roll(found, 1)
            if m == 1:  # a start for every end
                before[grams.starts] = found[grams.starts + sizes - 1]
            states.append(before)
    steps = traverse(model, counts, states, grams.whole)
    base = np.log10((counts[1] + 1) / (model.tokens + model.vocabulary + 1))
    return pa.table({
        "doc_id": row["doc_ids"].values, "held_out": row["held"].values, "n_tokens": pa.array(sizes),
        "n_known": pa.array(np.add.reduceat((counts[1] > 0).astype(np.int64), grams.starts)),
        "train_tokens": pa.array([model.tokens] * len(sizes), pa.int64()),
        "base_score": pa.array(np.add.reduceat(base, grams.starts)), "score": pa.array(np.add.reduceat(steps, grams.starts))})


def score_texts(docs: DataFrame, held_out: Column, config: LmConfig = LmConfig()) -> DataFrame:
    """Scores of all texts under the model of those that are not held out."""
    scratch = Scratch(docs.sparkSession, "lm")
    blocks = scratch.land(coded_blocks(docs, held_out, config), "blocks")
    size = blocks.agg(F.sum("n_train"), F.sum("n_words"), F.sum("n_tokens")).first()
    tokens, words, most = (x or 0 for x in size)

    bits, answers, seen, discounts = [0], [], [0], [0.0]
    for m in range(1, config.order + 1):
        bits.append(_bits(words if m == 1 else most, config))
        found = scratch.land(totals(blocks, m, bits[m]), f"order-{m}")
        n_seen, once, twice = (x or 0 for x in found.where("block = -1").agg(F.sum("n_seen"), F.sum("n_once"), F.sum("n_twice")).first())
        seen.append(n_seen)
        discounts.append(discount(once, twice))
        answers.append(found.where("block >= 0").select(F.col("block").alias("asking"), F.lit(m).alias("order"), "bucket", "totals"))
    # What a state loses by discounts on average, as often as it has arcs.
    prior = tuple(discounts[m] * seen[m] / max(1, seen[m - 1]) if m > 1 else 0.0 for m in range(config.order + 1))
    model = Model(tokens, seen[1], discounts[1], tuple(max(k, 1e-3) for k in prior), tuple(bits))

    kind = docs.schema["doc_id"].dataType.simpleString()
    together = answers[0]
    for more in answers[1:]:
        together = together.unionByName(more)
    texts = blocks.select("block", "doc_ids", "held", "sizes", "codes", "words")
    result = landed(texts.groupBy("block").cogroup(together.groupBy("asking")).applyInArrow(
        lambda block, answer: score_block(block, answer, model),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"), "lm-scores")
    scratch.drop()
    return result
