"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

Coordinates are hashes of a text's word n-grams: single words and pairs of words, and runs of one to three word
shapes (letters, capitals, digits and signs of a word, runs collapsed).  In pairs, a word that repeats the one
before it is written as a mark of its own, so that repetition shows with words never seen in training.  The value
of a coordinate is its share of the text's n-grams, so the score is one sparse dot product per text.

Training takes a bounded sample of labelled rows (``sample_rows``), drawn by a hash of the id.  It is dealt to
``shards`` tasks, each of which fits a model; the weights are averaged.  Scoring runs over all rows where they
lie, with no shuffle; what travels to it are ``2 ** bits`` weights, whatever the size of the input.

Defined cases: a null text is empty; an empty text has the score of the bias alone; a null label, or a label of an
unknown document, teaches nothing; without any labelled row every score is 0.5; repeated rows are scored alike;
columns beyond the named ones are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm.ftrl import Rates, fit
from logweft.llm.text import GOLDEN, WordCodes, words_of


@dataclass(frozen=True)
class QualityConfig:
    """``bits``: log2 of the coordinates; ``scale``: value of a text's n-grams together."""

    bits: int = 18
    scale: float = 40.0
    sample_rows: int = 6_000
    shards: int = 4
    rates: Rates = field(default_factory=lambda: Rates(epochs=2))


_SHAPES = bytes(
    ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b
    for b in range(256))
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)


def _code(word: bytes) -> int:
    """Hash of the word in the upper half, hash of its shape in the lower."""
    return zlib.crc32(word) << 32 | zlib.crc32(_RUNS.sub(rb"\1", word.translate(_SHAPES))[:16])


class NGrams:
    """Hashed n-grams of texts; one per worker, since it remembers words."""

    KINDS = 5

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        self.codes = WordCodes(_code)

    def _places(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (hashes + np.uint64(kind)) * GOLDEN
            x = (x ^ (x >> np.uint64(31))) * GOLDEN
        return (x >> self.shift).astype(np.int32)

    def of_many(self, texts: list[str | None]) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Number of words of each text; per kind the reach back in words, and coordinates for every word of all texts.

        A coordinate is of no use where a text has fewer words than the reach before it.
        """
        found = [words_of(t) for t in texts]
        sizes = np.array([len(f) for f in found], np.int64)
        code = np.fromiter((c for f in found for c in map(self.codes.__getitem__, f)), np.uint64, sizes.sum())
        word, shape = code >> np.uint64(32), code & np.uint64(0xFFFFFFFF)
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        again = np.zeros(len(word), bool)
        again[1:] = word[1:] == word[:-1]
        again[starts] = False
        with np.errstate(over="ignore"):
            second = np.where(again, np.uint64(1), word)
            before = np.where(again, np.uint64(2), np.roll(word, 1))
            pair = before * GOLDEN + second
            shapes = np.roll(shape, 1) * GOLDEN + shape
            runs = np.roll(shapes, 1) * GOLDEN + shape
        return sizes, [(0, self._places(second, 11)), (1, self._places(pair, 12)), (0, self._places(shape, 13)),
                       (1, self._places(shapes, 14)), (2, self._places(runs, 15))]

    def of(self, text: str | None) -> np.ndarray:
        """Coordinates of the n-grams of one text, repeats included."""
        return np.concatenate([places[reach:] for reach, places in self.of_many([text])[1]])

    def means(self, texts: list[str | None], weights: np.ndarray) -> np.ndarray:
        """Mean weight of each text's n-grams; 0 for an empty one."""
        sizes, kinds = self.of_many(texts)
        full = sizes > 0
        starts = (np.cumsum(sizes) - sizes)[full]
        total, number = np.zeros(len(starts)), np.zeros(len(starts))
        for reach, places in kinds if len(starts) else []:
            parts = weights[places].astype(float)
            for k in range(reach):
                parts[np.minimum(starts + k, len(parts) - 1)[sizes[full] > k]] = 0.0
            total += np.add.reduceat(parts, starts)
            number += np.maximum(sizes[full] - reach, 0)
        out = np.zeros(len(texts))
        out[full] = total / number
        return out


def _row(places: np.ndarray, dims: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Distinct coordinates and values, the bias last."""
    at, count = np.unique(places, return_counts=True)
    value = count * (scale / max(1, len(places)))
    return np.append(at, dims), np.append(value, 1.0)


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: list[str], may_learn: Column, rows: int) -> DataFrame:
    """``doc_id, text`` and the label columns of about ``rows`` labelled documents at most, drawn by a hash of the id.

    The ids that may teach are counted first; the drawn ones, bounded by ``rows``, are broadcast to the texts.
    """
    known = labels.select("doc_id", *columns).where(
        F.col("doc_id").isNotNull() & F.col(columns[0]).isNotNull() & may_learn)
    total = known.count()
    share = min(1.0, rows / max(1, total))
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) <= int(share * (1 << 30)))
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")


def train_quality(docs: DataFrame, labels: DataFrame, may_learn: Column, config: QualityConfig = QualityConfig()) -> np.ndarray:
    """Weights, the bias last, learned from ``labels.quality`` (0 or 1) of rows for which ``may_learn`` holds."""
    dims = 1 << config.bits

    def fit_shard(rows: pd.DataFrame) -> pd.DataFrame:
        grams = NGrams(config.bits)
        rows = rows.sort_values(["doc_id", "quality"])
        data = [_row(grams.of(t), dims, config.scale) for t in rows["text"]]
        weights = fit(data, rows["quality"].tolist(), dims + 1, config.rates)
        return pd.DataFrame({"n": [len(rows)], "weights": [weights.tobytes()]})

    sample = labelled_sample(docs, labels, ["quality"], may_learn, config.sample_rows)
    fitted = (
        sample.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("quality").cast("double").alias("quality"))
        .groupBy(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(config.shards)).alias("shard"))
        .applyInPandas(fit_shard, "n long, weights binary").collect())
    if not fitted:
        return np.zeros(dims + 1, np.float32)
    total = sum(r.n for r in fitted)
    return sum(np.frombuffer(r.weights, np.float32) * (r.n / total) for r in fitted).astype(np.float32)


def score_quality(docs: DataFrame, weights: np.ndarray, config: QualityConfig = QualityConfig(), score: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and the probability of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    others = [c for c in docs.columns if c != score]
    schema = docs.select(*others).withColumn(score, F.lit(0.0)).schema
    text_at = others.index("text")

    def run(batches):
        grams, w = NGrams(config.bits), sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                margins = w[-1] + config.scale * grams.means(part.column(text_at).to_pylist(), w)
                scores = 1.0 / (1.0 + np.exp(-np.clip(margins, -35, 35)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], [*others, score])

    return docs.select(*others).mapInArrow(run, schema)

