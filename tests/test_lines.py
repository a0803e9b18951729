import random
import re

import pytest
from pyspark.sql import functions as F

from logweft.config import WindowConfig
from logweft.functions.parse import parse_log, parse_rejects, with_parse
from logweft.functions.tokens import count_tokens
from logweft.operators.lines import clean_lines, head_lines, last_rows, recent_logs, split_large_lines
from logweft.sources.lines import lines_from_column, number_lines, renumber_lines
from tests import folds


def frame(spark, values, source="s"):
    return spark.createDataFrame([(source, i, v) for i, v in enumerate(values)], "source string, line_no long, value string")


def values(df):
    return [r.value for r in df.orderBy("source", "line_no").collect()]


PARSED = [
    ("2024-01-15 10:30:15 ERROR [ordersvc] Database down", ("2024-01-15 10:30:15", "ERROR", "ordersvc", "Database down")),
    ("\t 2024-01-15 10:30:15 INFO [a_1] x  \r\n", ("2024-01-15 10:30:15", "INFO", "a_1", "x")),
    ("2024-01-15 10:30:15 오류 [주문] 실패", ("2024-01-15 10:30:15", "오류", "주문", "실패")),
    ("2024-01-15 10:30:15 INFO [s] [b] ] c", ("2024-01-15 10:30:15", "INFO", "s", "[b] ] c")),
    ("2024-01-15 10:30:15 INFO [s] first\nsecond", ("2024-01-15 10:30:15", "INFO", "s", "first")),
    ("2024-03-31 02:30:00 INFO [s] no shift", ("2024-03-31 02:30:00", "INFO", "s", "no shift")),
    ("2024-02-29 23:59:59 INFO [s] leap day", ("2024-02-29 23:59:59", "INFO", "s", "leap day")),
]
REJECTED = [
    ("2024-13-15 10:30:15 ERROR [s] x", "bad_timestamp"),
    ("2023-02-29 10:30:15 ERROR [s] x", "bad_timestamp"),
    ("2024-01-15 24:00:00 ERROR [s] x", "bad_timestamp"),
    ("2024-01-15 10:30:60 ERROR [s] x", "bad_timestamp"),
    ("0000-01-15 10:30:15 ERROR [s] x", "bad_timestamp"),
    ("2024-01-15 10:30:15 ERROR [order-svc] x", "no_match"),
    ("2024-01-15 10:30:15 INFO [s] ", "no_match"),
    ("2024-01-15T10:30:15 INFO [s] x", "no_match"),
    ("2024-01-15 10:30:15  INFO [s] x", "no_match"),
    ("x 2024-01-15 10:30:15 INFO [s] x", "no_match"),
    ("", "no_match"),
    (None, "no_match"),
]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "Asia/Seoul"])
def test_parse(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    lines = frame(spark, [v for v, _ in PARSED + REJECTED])
    good = parse_log(lines).orderBy("line_no").collect()
    assert [(str(r.ts), r.level, r.service, r.message) for r in good] == [e for _, e in PARSED]
    assert [r.raw for r in good] == [v.strip() for v, _ in PARSED]
    bad = parse_rejects(lines).orderBy("line_no").collect()
    assert [(r.value, r.reason) for r in bad] == REJECTED
    assert parse_rejects(lines).columns == ["source", "line_no", "value", "reason"]


def test_parse_like_a_regular_expression(spark):
    rng = random.Random(3)
    parts = ["2024-01-15 10:30:15", "2024-1-5", " ", "  ", "INFO", "WARN", "[svc]", "[a b]", "[]", "msg", "]", "[", "\t", "é"]
    raw = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 7))) for _ in range(2000)]
    raw += [f"2024-01-15 10:30:15 {rng.choice(parts)} {rng.choice(parts)} {rng.choice(parts)}" for _ in range(500)]
    pattern = re.compile(r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) (\w+) \[(\w+)\] (.+)")
    mine = with_parse(frame(spark, raw)).orderBy("line_no").collect()
    for text, row in zip(raw, mine):
        match = pattern.match(text.strip())
        assert (row.reason is None) == bool(match)
        if match:
            assert (row.level, row.service, row.message) == match.groups()[1:]


def test_tokens(spark):
    texts = ["", "abc", "abcd", "abcdefgh", "가나다라마바사아", "a" * 403, "😀" * 9]
    lines = frame(spark, texts).withColumn("t", count_tokens(F.col("value")))
    assert [r.t for r in lines.orderBy("line_no").collect()] == [max(1, len(t) // 4) for t in texts]


def test_byte_pairs_need_their_vocabulary(spark):
    config = WindowConfig(tokenizer="bpe", encoding="no such vocabulary")
    with pytest.raises(ValueError, match="no vocabulary"):
        count_tokens(F.col("value"), config)
    with pytest.raises(ValueError, match="no vocabulary"):
        split_large_lines(frame(spark, ["abcd efgh"]), 1, config)


CLEAN = ["GET /HEALTHZ 200", "GET /healthz", "readinessProbe ok", "livenessProbe ok", "", " \t ", "　", "kept\r\n", "kept too "]


def test_clean(spark):
    lines = frame(spark, CLEAN)
    rest = ["kept", "kept too "]
    assert values(clean_lines(lines)) == ["readinessProbe ok", "livenessProbe ok", *rest]
    assert values(clean_lines(lines, filters=[])) == values(clean_lines(lines))
    assert values(clean_lines(lines, lower_filters=True)) == rest
    assert values(clean_lines(lines, filters=["kept"])) == CLEAN[:4]
    assert values(clean_lines(lines, mode="legacy")) == ["GET /HEALTHZ 200", "livenessProbe ok", "", " \t ", "　", "kept\r", "kept too "]


def test_renumber(spark):
    lines = spark.range(3000).select(
        F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("source"), (F.col("id") * 7).alias("line_no"),
        F.col("id").cast("string").alias("value")).repartition(5)
    for bucket in (64, 100000):
        mine = renumber_lines(lines, bucket_lines=bucket).collect()
        for s in (0, 1):
            own = sorted((r.line_no, int(r.value)) for r in mine if r.source == f"s{s}")
            assert [n for n, _ in own] == list(range(1500))
            assert [v for _, v in own] == list(range(s, 3000, 2))


def test_number_lines(spark):
    rng = random.Random(6)
    rows = [(rng.choice("aaaaaabc"), rng.randint(0, 50), i) for i in range(4000)]
    numbered = number_lines(
        spark.createDataFrame(rows, "source string, at long, id long").repartition(6), "source", ["at", "id"]).collect()
    assert len(numbered) == 4000
    for s in "abc":
        own = sorted((r.line_no, r["at"], r.id) for r in numbered if r.source == s)
        assert [(n, *rest) for n, rest in enumerate(sorted((a, i) for x, a, i in rows if x == s))] == own


def test_split_large_lines(spark):
    rng = random.Random(8)
    texts = [" ".join("w" * rng.choice([1, 3, 9, 30, 300]) for _ in range(rng.choice([1, 5, 60]))) for _ in range(60)]
    texts += [" " * 900, "\t".join(["ab"] * 400), "short", "é" * 1000]
    expected = []
    for text in texts:
        expected += [text] if max(1, len(text) // 4) <= 20 else folds.split(text, 20)
    mine = split_large_lines(frame(spark, texts), 20).orderBy("line_no").collect()
    assert [r.value for r in mine] == expected
    assert [r.line_no for r in mine] == list(range(len(expected)))


def test_head(spark):
    lines = frame(spark, [f"l{i} \t" for i in range(30)]).unionByName(frame(spark, ["only"], "t"))
    mine = head_lines(lines, 10).orderBy("source", "number").collect()
    assert [(r.number, r.value, r.total_lines) for r in mine if r.source == "s"] == [(i + 1, f"l{i}", 30) for i in range(10)]
    assert [(r.number, r.value, r.total_lines) for r in mine if r.source == "t"] == [(1, "only", 1)]


def test_last_rows(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("source"), F.col("id").alias("line_no")).repartition(9)
    mine = last_rows(rows, 7, ["source"], ["line_no"]).collect()
    ids = {s: sorted(r.line_no for r in mine if r.source == s) for s in ("hot", "cold")}
    assert ids == {"hot": [i for i in range(20000) if i % 3][-7:], "cold": [i for i in range(20000) if not i % 3][-7:]}
    assert recent_logs(rows, 100000).count() == 20000


def test_lines_from_column(spark):
    texts = spark.createDataFrame([(1, "a\n\nb"), (2, ""), (3, None)], "id long, text string")
    assert [tuple(r) for r in lines_from_column(texts, "id", "text").orderBy("source", "line_no").collect()] == [
        ("1", 0, "a"), ("1", 1, ""), ("1", 2, "b"), ("2", 0, "")]
