"""Toxicity categories by a chain of linear models.

Categories are predicted one after the other.  The model of a category sees a text's features and the probabilities
of all categories before it.  For training, those probabilities come from models that did not see the text: each
category is first fitted without each of ``folds`` parts of the sample in turn, and predicts the part left out; a
last model, fitted on the whole sample, is the one that scores.

Features are presence of a word and of its first letters (``prefixes``), hashed; words are lower-cased and freed of
signs.  Models are logistic regressions by follow-the-regularised-leader updates, whose penalty leaves few weights.

Training takes a bounded sample of labelled rows (``sample_rows``), drawn by a hash of the id and dealt to ``shards``
tasks; weights are averaged.  Scoring runs over all rows where they lie; the weights that are not zero, a few
thousand whatever the input, travel to it.

Defined cases: a null text is empty; an empty text is scored by the biases alone; null labels teach nothing; without
labelled rows every probability is 0.5 and nothing is toxic; a category without an example is one of low
probability; repeated rows are scored alike; columns named like an added one are replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm.ftrl import Rates, fit, sigmoid
from logweft.llm.quality import labelled_sample
from logweft.llm.text import WordCodes

# Cues that divide texts labelled toxic into categories, for tables that have no labels for them.
INSULT_CUES = ("idiot", "moron", "loser", "fool", "clown", "stupid", "dumb", "imbecile")
CONTEMPT_CUES = ("worthless", "pathetic", "scum", "trash", "garbage", "disgusting", "vile", "filth")


@dataclass(frozen=True)
class ChainConfig:
    """``categories`` in the order of the chain; a text is toxic from ``threshold`` of the last one."""

    categories: tuple[str, ...] = ("insult", "contempt", "toxic")
    bits: int = 22
    prefixes: tuple[int, ...] = (4, 5)
    sample_rows: int = 10_000
    shards: int = 2
    folds: int = 3
    threshold: float = 0.5
    rates: Rates = field(default_factory=lambda: Rates(alpha=1.0, beta=1.0, l1=3.0, l2=0.05, epochs=2))


SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class Features:
    """Hashed features of words; one per worker, since it remembers words."""

    def __init__(self, config: ChainConfig, keep=None):
        """``keep``: of the coordinates, those to keep, or None for all."""
        self.config, self.keep, self.mask = config, keep, (1 << config.bits) - 1
        self.words = WordCodes(self._of_word)

    def _of_word(self, word: str) -> tuple[int, ...]:
        part, mask = word.strip(SIGNS), self.mask
        out = [zlib.crc32(part.encode()) & mask]
        for k in self.config.prefixes:
            if len(part) >= k:
                out.append(zlib.crc32(part[:k].encode(), k) & mask)
        return tuple(out) if self.keep is None else tuple(self.keep.intersection(out))

    def of(self, text: str | None) -> set[int]:
        """Coordinates present in the text."""
        words = set(text.lower().split()) if text else ()
        found: set[int] = set()
        for features in map(self.words.__getitem__, words):
            if features:
                found.update(features)
        return found


def _with_chain(places: np.ndarray, before: list[float], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """A row: present features, the bias, and earlier categories' probabilities."""
    extra = np.arange(dims, dims + 1 + len(before))
    return np.concatenate([places, extra]), np.concatenate([np.ones(len(places) + 1), before])


def train_shard(texts: list[str], labels: list[tuple[float, ...]], config: ChainConfig) -> list[np.ndarray]:
    """One weight vector per category, of the features, the bias and the earlier categories."""
    dims, features = 1 << config.bits, Features(config)
    places = [np.array(sorted(features.of(t)), np.int64) for t in texts]
    fold = np.array([zlib.crc32((t or "").strip().lower().encode()) for t in texts], np.int64) % config.folds  # copies share a fold
    earlier: list[list[float]] = [[] for _ in texts]
    models = []
    for c in range(len(config.categories)):
        rows = [_with_chain(p, e, dims) for p, e in zip(places, earlier, strict=True)]
        wanted = [y[c] for y in labels]
        size = dims + 1 + c
        out = np.zeros(len(texts))
        for f in range(config.folds):
            others = np.flatnonzero(fold != f)
            weights = fit([rows[i] for i in others], [wanted[i] for i in others], size, config.rates)
            for i in np.flatnonzero(fold == f):
                out[i] = sigmoid(float(weights[rows[i][0]] @ rows[i][1]))
        models.append(fit(rows, wanted, size, config.rates))
        earlier = [[*e, p] for e, p in zip(earlier, out, strict=True)]
    return models


@dataclass(frozen=True)
class Chain:
    """Per category the weights that are not zero, by coordinate, and the weights of bias and earlier categories."""

    weights: list[dict[int, float]]
    dense: list[list[float]]

    def probabilities(self, found: set[int]) -> list[float]:
        out: list[float] = []
        for weights, dense in zip(self.weights, self.dense, strict=True):
            margin = dense[0] + sum(w * p for w, p in zip(dense[1:], out, strict=True))
            out.append(sigmoid(margin + sum(weights.get(i, 0.0) for i in sorted(found))))
        return out


def train_chain(docs: DataFrame, labels: DataFrame, may_learn: Column, config: ChainConfig = ChainConfig()) -> Chain | None:
    """The chain learned from ``labels``, which has a column 0 or 1 per category, or cue words for it: a category that
    is no column of ``labels`` holds where ``toxic`` does and the text has one of the category's cues."""
    dims = 1 << config.bits
    cues = {"insult": INSULT_CUES, "contempt": CONTEMPT_CUES}
    known = [c for c in config.categories if c in labels.columns]
    sample = labelled_sample(docs, labels, list(dict.fromkeys([config.categories[-1], *known])), may_learn, config.sample_rows)
    text = F.coalesce("text", F.lit(""))

    def label(name: str) -> Column:
        value = F.col(name) if name in known else F.col(config.categories[-1]) * F.lower(text).rlike("|".join(cues[name])).cast("int")
        return F.coalesce(value.cast("double"), F.lit(0.0)).alias(f"y_{name}")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", *(f"y_{c}" for c in config.categories)])
        wanted = list(rows[[f"y_{c}" for c in config.categories]].itertuples(index=False, name=None))
        models = train_shard(rows["text"].tolist(), wanted, config)
        out = [(c, len(rows), np.flatnonzero(m).astype("<i4").tobytes(), m[m != 0].tobytes()) for c, m in enumerate(models)]
        return pd.DataFrame(out, columns=["category", "n", "places", "weights"])

    fitted = (
        sample.select("doc_id", text.alias("text"), *[label(c) for c in config.categories])
        .groupBy(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(config.shards)).alias("shard"))
        .applyInPandas(run, "category int, n long, places binary, weights binary").collect())
    if not fitted:
        return None
    total = sum(r.n for r in fitted if r.category == 0)
    weights: list[dict[int, float]] = [{} for _ in config.categories]
    for r in sorted(fitted, key=lambda r: (r.category, r.n, r.weights)):
        for i, w in zip(np.frombuffer(r.places, "<i4").tolist(), np.frombuffer(r.weights, np.float32).tolist(), strict=True):
            weights[r.category][i] = weights[r.category].get(i, 0.0) + w * (r.n / total)
    dense = [[w.pop(dims + k, 0.0) for k in range(c + 1)] for c, w in enumerate(weights)]
    return Chain(weights, dense)


def score_toxicity(docs: DataFrame, chain: Chain | None, config: ChainConfig = ChainConfig()) -> DataFrame:
    """All columns, ``p_<category>`` for every category, and ``toxic``."""
    added = [f"p_{c}" for c in config.categories]
    kept = [c for c in docs.columns if c not in (*added, "toxic")]
    rows = docs.select(*kept)
    if chain is None:
        return rows.select(*kept, *[F.lit(0.5).alias(c) for c in added], F.lit(False).alias("toxic"))
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    text_at = kept.index("text")

    def run(batches):
        model = sent.value
        features = Features(config, frozenset(i for w in model.weights for i in w))
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [model.probabilities(features.of(t)) for t in part.column(text_at).to_pylist()]
                columns = [pa.array([p[c] for p in found], pa.float64()) for c in range(len(added))]
                toxic = pa.array([p[-1] >= config.threshold for p in found], pa.bool_())
                yield pa.RecordBatch.from_arrays([*part.columns, *columns, toxic], [*kept, *added, "toxic"])

    schema = rows.select(*kept, *[F.lit(0.0).alias(c) for c in added], F.lit(True).alias("toxic")).schema
    return rows.mapInArrow(run, schema)
