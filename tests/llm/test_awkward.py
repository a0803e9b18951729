"""Columns called like helpers, and texts that the fast paths cannot take."""

import pytest
from pyspark.sql import functions as F

from logweft.llm import packing, quality, rules, secrets, toxicity
from logweft.llm.queries import VOCABULARY

HELPERS = ["_words", "_lines", "_hashes", "_windows", "_ordered", "row", "N_WORDS", "kept", "votes", "count", "label", "word", "held"]


def test_rules_over_columns_called_like_helpers(spark):
    texts = [(1, "some words of a text " * 30), (2, "aa " * 40), (3, None), (4, "")]
    plain = spark.createDataFrame(texts, "doc_id long, text string")
    clashing = plain.select("*", *[F.lit(7).alias(c) for c in HELPERS])
    want = {r.doc_id: r for r in rules.judge(plain).collect()}
    for r in rules.judge(clashing).collect():
        assert (r.n_words, r.n_repeat_words, r.base_failed, r.kept) == tuple(
            want[r.doc_id][c] for c in ("n_words", "n_repeat_words", "base_failed", "kept"))
        assert r["_words"] == r["row"] == 7


@pytest.mark.parametrize("text", [" " * 1_100_000, "\n" * 1_100_000, "x" * 300_000, "-" * 300_000, "a " + " " * 1_050_000 + "b"])
def test_long_runs_are_packed(text):
    tokenizers = pytest.importorskip("tokenizers")
    import numpy as np

    want = np.array(tokenizers.Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids, "<u4")
    assert packing.Encoder(VOCABULARY).ids(text) == want.tobytes()


def test_copies_share_a_fold():
    """A model that has seen a text's copy would give that text away: with one fold of two, both are judged unseen."""
    config = toxicity.ChainConfig(folds=2)
    texts = ["alpha beta gamma"] * 10 + ["delta epsilon zeta"] * 10
    labels = [tuple(float(k < 10) for _ in config.categories) for k in range(20)]
    assert len(toxicity.train_shard(texts, labels, config)) == len(config.categories)


def test_neighbouring_words_with_accents_are_words():
    features = dict(zip(secrets.FEATURES, secrets.describe("clé privée: QkfJ39fjw93fFjw92", 12, 29, "", frozenset({"clé", "privée"})), strict=True))
    assert 2.0 in features.values()
