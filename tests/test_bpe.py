"""Byte-pair counts, with a vocabulary of single bytes made for the test."""

import zipfile

import pytest
from pyspark.sql import functions as F

from logweft.config import WindowConfig
from logweft.functions.tokens import bpe_available, count_tokens
from logweft.operators.lines import split_large_lines
from logweft.operators.windows import process_log_lines, text_windows, token_windows
from tests import folds

pytest.importorskip("tiktoken")
VOCABULARY = '''
def bytes_only():
    ranks = {bytes([i]): i for i in range(256)}
    return {"name": "bytes_only", "pat_str": "[^ ]+| +", "mergeable_ranks": ranks, "special_tokens": {"<|stop|>": 256}}

ENCODING_CONSTRUCTORS = {"bytes_only": bytes_only}
'''
CONFIG = WindowConfig(30, 0.3, tokenizer="bpe", encoding="bytes_only")


@pytest.fixture(scope="module")
def vocabulary(spark, tmp_path_factory):
    archive = str(tmp_path_factory.mktemp("bpe") / "vocabulary.zip")
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("tiktoken_ext/", "")
        z.writestr("tiktoken_ext/logweft_test_vocabulary.py", VOCABULARY)
    spark.sparkContext.addPyFile(archive)
    if not bpe_available("bytes_only"):
        pytest.skip("this version does not find added vocabularies")


def frame(spark, values):
    return spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "source string, line_no long, value string")


def test_counts(spark, vocabulary):
    texts = ["", "abc", "a b", "é", "주문", "x <|stop|> y" * 3]
    rows = frame(spark, texts).withColumn("t", count_tokens(F.col("value"), CONFIG)).orderBy("line_no").collect()
    # A text that spells out a control mark is counted by its length.
    assert [r.t for r in rows] == [len(t.encode()) for t in texts[:-1]] + [len(texts[-1]) // 4]


def test_windows_with_blank_lines_of_no_tokens(spark, vocabulary):
    texts = ["a" * 20, "", "", "b" * 9, "", "c" * 40, "", "d" * 30, "", "e"]
    expected = folds.windows([len(t) for t in texts], 30, 0.3)
    found = sorted(token_windows(frame(spark, texts), CONFIG).collect(), key=lambda r: r.window_index)
    assert [(r.start_line, r.end_line, r.token_count) for r in found] == expected
    logs = spark.createDataFrame([("s", "\n".join(texts))], "source string, text string")
    assert sorted(map(tuple, process_log_lines(logs, CONFIG).collect())) == sorted(map(tuple, found))
    with pytest.raises(ValueError):
        text_windows(logs, CONFIG)


def test_split(spark, vocabulary):
    rows = split_large_lines(frame(spark, ["aaa bbb cc d", "short"]), 8, CONFIG).orderBy("line_no").collect()
    assert [r.value for r in rows] == ["aaa bbb", "cc d", "short"]
