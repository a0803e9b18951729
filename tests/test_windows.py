import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logweft.config import WindowConfig
from logweft.operators.packing import BUFFER_ROWS, Budget, _stream_function, run_ends
from logweft.operators.windows import (
    covered_lines,
    filter_windows,
    merge_windows,
    overlap_carry,
    process_log_lines,
    text_windows,
    token_windows,
    window_by_index,
    window_stats,
)
from tests import folds

# Token counts per line of sample logs.
SAMPLE_A = [20, 16, 20, 16, 20, 20, 22, 16, 20, 19, 15, 18, 16, 15]
SAMPLE_B = [16, 16, 14, 15, 14, 13, 13, 15, 13]
SAMPLE_C = [13, 14, 14, 16, 14, 18, 15, 15, 14, 15, 15, 17, 15, 14, 14, 15, 15, 13, 15, 16, 15, 13, 13, 15, 13, 15]


def lines_frame(spark, sources, partitions=4, with_tokens=True, seed=1):
    rows = [(s, i, f"{s}.{i}", t) for s, tokens in sources.items() for i, t in enumerate(tokens)]
    random.Random(seed).shuffle(rows)
    frame = spark.createDataFrame(rows, "source string, line_no long, value string, tokens long")
    return frame.repartition(partitions) if with_tokens else frame.drop("tokens")


def check(rows, sources, max_tokens, ratio):
    for source, tokens in sources.items():
        mine = sorted((r for r in rows if r.source == source), key=lambda r: r.window_index)
        expected = folds.windows(tokens, max_tokens, ratio)
        assert [(r.start_line, r.end_line, r.token_count) for r in mine] == expected
        assert [r.window_index for r in mine] == list(range(len(expected)))
        assert all(r.total_windows == len(expected) for r in mine)
        for r in mine:
            assert r.content == "\n".join(f"{source}.{i}" for i in range(r.start_line, r.end_line + 1))


def make_sources(seed, max_tokens, zero=False):
    rng = random.Random(seed)
    sources = {}
    for s in range(24):
        n = rng.choice([1, 2, 7, 40, 300, 900])
        kind = rng.choice("uniform mixed small".split())
        sources[f"s{s}"] = [
            4 if kind == "uniform" else rng.choice([1, 2, 5, max_tokens // 2, max_tokens, max_tokens + 3])
            if kind == "mixed" else rng.randint(0 if zero else 1, 6) for _ in range(n)]
    return sources


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 14), min_size=1, max_size=40), min_size=1, max_size=5),
       st.integers(1, 30), st.sampled_from([0.0, 0.1, 0.15, 0.5, 0.9]))
def test_next_starts_equal_the_naive_rules(groups, max_tokens, ratio):
    budget = Budget(max_tokens, int(max_tokens * ratio), ratio > 0)
    sizes = np.array([len(g) for g in groups])
    ends = np.cumsum(sizes)
    last, total, following = run_ends(np.array(sum(groups, [])), np.repeat(ends, sizes), budget)
    for tokens, end in zip(groups, ends):
        begin, at, found = end - len(tokens), end - len(tokens), []
        while at < end:
            found.append((at - begin, last[at] - begin, total[at]))
            assert following[at] > at  # the chain always moves on
            at = following[at]
        assert found == folds.windows(tokens, max_tokens, ratio)


@pytest.mark.parametrize("max_tokens, ratio, chunk, batch_rows", [
    (20, 0.3, None, 10000), (20, 0.3, 22, 6), (20, 0.8, 25, 11), (30, 0.0, 32, 10000), (12, 0.15, 14, 5), (50, 0.5, 60, 64)])
def test_long_and_short_sources(spark, conf, max_tokens, ratio, chunk, batch_rows):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    sources = make_sources(chunk or 0, max_tokens)
    tuning = {"whole_source_tokens": 100, "buffer_rows": batch_rows} if chunk else {}
    found = token_windows(lines_frame(spark, sources), WindowConfig(max_tokens, ratio), chunk_lines=chunk, zero_tokens=False, **tuning)
    check(found.collect(), sources, max_tokens, ratio)


def test_lines_without_tokens(spark):
    sources = make_sources(3, 20, zero=True)
    found = token_windows(lines_frame(spark, sources), WindowConfig(20, 0.3))
    check(found.collect(), sources, 20, 0.3)


# Stretches of lines without tokens that are longer than the budget and reach over several chunks and buckets.
OPEN_SOURCES = {
    "front": [0] * 200 + [1] * 50,
    "back": [2, 9, 1] + [0] * 300,
    "only": [0] * 250,
    "single": [0],
    "between": [3] * 40 + [0] * 150 + [9] + [0] * 77 + [2] * 30 + [0] * 64 + [1],
    "sparse": ([0] * 45 + [1]) * 12,
    "pairs": [0, 1] * 130,
    "large": [40, 0, 0, 41, 0, 3] * 40,
    "mixed": [random.Random(17).choice([0, 0, 0, 0, 1, 3, 11]) for _ in range(700)],
}


@pytest.mark.parametrize("max_tokens, ratio, chunk, bucket", [
    (5, 0.0, 14, 1), (5, 0.3, 30, 16), (10, 0.5, 41, 7), (12, 0.9, 28, 65536), (12, 0.3, None, 16)])
def test_open_runs_of_lines_without_tokens(spark, max_tokens, ratio, chunk, bucket):
    tuning = {"whole_source_tokens": 20, "buffer_rows": 13, "chunks_per_block": 3} if chunk else {}
    found = token_windows(lines_frame(spark, OPEN_SOURCES), WindowConfig(max_tokens, ratio), chunk_lines=chunk,
                          bucket_rows=bucket, **tuning)
    check(found.collect(), OPEN_SOURCES, max_tokens, ratio)


def test_a_run_that_breaks_the_promise_fails_loudly(spark):
    frame = lines_frame(spark, {"s": [0] * 200 + [1] * 50})
    with pytest.raises(Exception, match="zero_tokens=True"):
        token_windows(frame, WindowConfig(5, 0.0), chunk_lines=10, zero_tokens=False).collect()


def test_lines_of_no_source_are_a_source(spark):
    frame = spark.createDataFrame(
        [(s, i, "a", t) for s in (None, "", "=") for i, t in enumerate([1, 0, 0, 2] * 20)],
        "source string, line_no long, value string, tokens long")
    for chunk in (None, 20):
        rows = token_windows(frame, WindowConfig(5, 0.3), chunk_lines=chunk).collect()
        by_source = {s: sorted(r[1:] for r in rows if r.source == s) for s in (None, "", "=")}
        assert by_source[None] == by_source[""] == by_source["="] and by_source[None]


def test_merging_windows_without_tokens(spark):
    rng = random.Random(6)
    sources = {f"s{i}": [rng.choice([0, 0, 0, 5, 30, 61]) for _ in range(n)] for i, n in enumerate([1, 9, 400])}
    sources["s3"] = [0] * 500
    rows = [(s, i, t, i, i, f"{s}.{i}") for s, ts in sources.items() for i, t in enumerate(ts)]
    frame = spark.createDataFrame(
        rows, "source string, window_index int, token_count long, start_line long, end_line long, content string")
    check(merge_windows(frame, 60, chunk_windows=130, bucket_rows=50).collect(), sources, 60, 0.0)


@pytest.mark.parametrize("tokens", [[4] * 3000, None])
def test_many_blocks_of_chunks(spark, tokens):
    rng = random.Random(12)
    sources = {"long": tokens or [rng.choice([1, 2, 7, 33, 45]) for _ in range(3000)], "mid": [9] * 130, "short": [5, 5]}
    found = token_windows(lines_frame(spark, sources), WindowConfig(30, 0.2), chunk_lines=40, chunks_per_block=4, zero_tokens=False)
    check(found.collect(), sources, 30, 0.2)


@pytest.mark.parametrize("numbers, chunk", [([0, 1, 3], None), ([1, 2, 3], None), ([0, 1, 1, 2], None), ([*range(40), 50], 14)])
@pytest.mark.parametrize("zero_tokens", [True, False])
def test_gaps_in_numbers_fail_loudly(spark, numbers, chunk, zero_tokens):
    frame = spark.createDataFrame([("s", n, "abcd", 1) for n in numbers], "source string, line_no long, value string, tokens long")
    with pytest.raises(Exception, match="see renumber_lines"):
        token_windows(frame, WindowConfig(5, 0.0), chunk_lines=chunk, zero_tokens=zero_tokens).collect()


def test_null_lines_are_blank(spark):
    frame = spark.createDataFrame([("s", 0, "a"), ("s", 1, None), ("s", 2, "b")], "source string, line_no long, value string")
    assert token_windows(frame).first().content == "a\n\nb"


def test_one_source_holding_most_rows(spark):
    rng = random.Random(9)
    sources = {"hot": [rng.randint(1, 30) for _ in range(20000)], **{f"c{i}": [3, 9] for i in range(20)}}
    found = token_windows(lines_frame(spark, sources), WindowConfig(100, 0.15), chunk_lines=500)
    check(found.collect(), sources, 100, 0.15)


def test_result_does_not_depend_on_partitions_or_chunks(spark):
    sources = make_sources(5, 40)
    results = [
        sorted(map(tuple, token_windows(
            lines_frame(spark, sources, parts, seed=parts), WindowConfig(40, 0.15), chunk_lines=chunk, zero_tokens=False).collect()))
        for parts, chunk in [(1, None), (7, 42), (3, 100)]]
    assert results[0] == results[1] == results[2]


def test_row_local_path_agrees(spark):
    rng = random.Random(2)
    texts = [(f"d{i}", "\n".join("x" * rng.choice([0, 3, 9, 40, 500]) for _ in range(rng.choice([1, 4, 60])))) for i in range(50)]
    texts += [("empty", ""), ("none", None)]
    frame = spark.createDataFrame(texts, "source string, text string")
    config = WindowConfig(60, 0.2)
    local = sorted(map(tuple, text_windows(frame, config).collect()))
    by_fold = []
    for source, text in texts:
        if text is None:
            continue
        lines = text.split("\n")
        expected = folds.windows([max(1, len(x) // 4) for x in lines], 60, 0.2)
        by_fold += [(source, i, len(expected), s, e, t, "\n".join(lines[s:e + 1])) for i, (s, e, t) in enumerate(expected)]
    assert local == sorted(by_fold)
    assert sorted(map(tuple, process_log_lines(frame, config).collect())) == local


@pytest.mark.parametrize("tokens, max_tokens, ratio, expected", [
    ([34] * 100, 5000, 0.15, [(0, 99, 3400)]),
    ([34] * 100, 500, 0.15, [(0, 13, 476), (12, 25, 476), (24, 37, 476), (36, 49, 476)]),
    ([34] * 100, 100, 0.15, [(0, 1, 68), (2, 3, 68)]),
    ([34] * 100, 60, 0.3, [(0, 0, 34), (1, 1, 34)]),
    (SAMPLE_A, 5000, 0.15, [(0, 13, 253)]),
    (SAMPLE_A, 100, 0.15, [(0, 4, 92), (5, 9, 97), (10, 13, 64)]),
    (SAMPLE_A, 60, 0.3, [(0, 2, 56), (3, 5, 56), (6, 8, 58), (9, 11, 52)]),
    (SAMPLE_B, 100, 0.15, [(0, 5, 88), (5, 8, 54)]),
    (SAMPLE_B, 60, 0.3, [(0, 2, 46), (2, 5, 56), (5, 8, 54)]),
    (SAMPLE_C, 100, 0.15, [(0, 5, 89), (6, 11, 91), (12, 17, 86), (17, 23, 100)]),
])
def test_sample_logs(spark, tokens, max_tokens, ratio, expected):
    found = sorted(token_windows(lines_frame(spark, {"a": tokens}), WindowConfig(max_tokens, ratio)).collect(),
                   key=lambda r: r.window_index)
    mine = [(r.start_line, r.end_line, r.token_count) for r in found]
    assert mine == folds.windows(tokens, max_tokens, ratio)
    if expected:
        assert mine[:len(expected)] == expected
    counts = {(500, 0.15): (9, 3944, 116), (100, 0.15): (50, 3400, 100), (60, 0.3): (100, 3400, 100)}
    if len(tokens) == 100 and (max_tokens, ratio) in counts:
        assert (len(mine), sum(t for *_, t in mine), sum(e - s + 1 for s, e, _ in mine)) == counts[max_tokens, ratio]


def test_default_mode_counts_simple_tokens(spark):
    frame = spark.createDataFrame([("s", 0, "가나다라마바사아"), ("s", 1, "")], "source string, line_no long, value string")
    assert token_windows(frame).first().token_count == 2 + 1


def test_window_properties(spark):
    sources = make_sources(11, 30)
    rows = token_windows(lines_frame(spark, sources), WindowConfig(30, 0.3), chunk_lines=40, zero_tokens=False).collect()
    for source, tokens in sources.items():
        mine = sorted((r for r in rows if r.source == source), key=lambda r: r.window_index)
        covered = {i for r in mine for i in range(r.start_line, r.end_line + 1)}
        assert covered == set(range(len(tokens)))
        for r in mine:
            assert r.token_count <= 30 or r.start_line == r.end_line
        for a, b in zip(mine, mine[1:]):
            assert b.start_line > a.start_line
            assert sum(tokens[b.start_line:a.end_line + 1]) <= 9


def test_statistics(spark):
    frame = lines_frame(spark, {"a": [10, 10, 10], "b": [50]})
    found = token_windows(frame, WindowConfig(20, 0.5, min_tokens=30))
    stats = window_stats(found).first()
    assert (stats.total_windows, stats.total_tokens, stats.min_tokens, stats.max_tokens, stats.total_lines) == (3, 90, 20, 50, 5)
    assert stats.avg_tokens_per_window == 30.0
    assert {r.source: r.distinct_lines for r in covered_lines(found).collect()} == {"a": 3, "b": 1}
    none = window_stats(found.filter("false")).first()
    assert tuple(none) == (0, 0, 0.0, 0, 0, 0)


@pytest.mark.parametrize("bucket", [1, 3, 1000])
def test_overlap(spark, bucket):
    sources = make_sources(8, 40)
    found = token_windows(lines_frame(spark, sources), WindowConfig(40, 0.4), content=False)
    mine = {(r.source, r.window_index): r.carried_lines for r in overlap_carry(found, bucket).collect()}
    expected = {}
    for source, tokens in sources.items():
        spans = folds.windows(tokens, 40, 0.4)
        for i, (start, _, _) in enumerate(spans):
            expected[source, i] = max(0, spans[i - 1][1] - start + 1) if i else 0
    assert mine == expected


def test_filter_and_lookup(spark):
    found = token_windows(lines_frame(spark, {"a": [10, 10, 10], "b": [50]}), WindowConfig(20, 0.5))
    config = WindowConfig(20, 0.5, min_tokens=30)
    for limit in (None, 0):  # both mean the configured minimum
        assert [r.source for r in filter_windows(found, limit, config).collect()] == ["b"]
    assert filter_windows(found, 20, config).count() == 3
    assert [r.start_line for r in window_by_index(found, 1).collect()] == [1]
    assert window_by_index(found, 7).count() == 0


@pytest.mark.parametrize("chunk", [None, 62])
def test_merge(spark, chunk):
    rng = random.Random(4)
    sources = {f"s{i}": [rng.choice([5, 20, 61, 90]) for _ in range(rng.choice([1, 5, 300]))] for i in range(12)}
    rows = [(s, i, len(ts), i * 2, i * 2 + 2, t, f"{s}.{i}") for s, ts in sources.items() for i, t in enumerate(ts)]
    frame = spark.createDataFrame(
        rows, "source string, window_index int, total_windows int, start_line long, end_line long, token_count long, content string")
    found = merge_windows(frame, 60, chunk_windows=chunk, zero_tokens=False).collect()
    for source, tokens in sources.items():
        mine = sorted((r for r in found if r.source == source), key=lambda r: r.window_index)
        expected = folds.windows(tokens, 60, 0.0)
        assert [(r.start_line, r.end_line, r.token_count) for r in mine] == [(a * 2, b * 2 + 2, t) for a, b, t in expected]
        assert [r.content for r in mine] == ["\n".join(f"{source}.{i}" for i in range(a, b + 1)) for a, b, _ in expected]
        assert all(r.total_windows == len(expected) for r in mine)


def test_empty_input(spark):
    frame = spark.createDataFrame([], "source string, line_no long, value string")
    assert token_windows(frame).count() == 0


def test_bad_settings():
    for bad in ({"max_tokens": 0}, {"overlap_ratio": 1.0}, {"min_tokens": -1}, {"tokenizer": "words"}):
        with pytest.raises(ValueError):
            WindowConfig(**bad)


@pytest.mark.parametrize("bucket", [1, 2, 65536])
def test_covered_lines_after_a_filter(spark, bucket):
    found = spark.createDataFrame(
        [("a", 0, 0, 5), ("a", 1, 4, 8), ("a", 5, 10, 12), ("a", 6, 11, 12), ("b", 3, 7, 7)],
        "source string, window_index int, start_line long, end_line long")
    assert {r.source: r.distinct_lines for r in covered_lines(found, bucket).collect()} == {"a": 12, "b": 1}


def test_scorers_get_the_timeout(spark):
    from logweft.operators.analyze import score_payloads

    requests = spark.createDataFrame([("p", 7), ("q", 9)], "payload string, timeout int")
    told = score_payloads(requests, lambda payload, timeout: f"{payload}{timeout}").collect()
    assert sorted(r.analysis for r in told) == ["p7", "q9"]
    assert sorted(r.analysis for r in score_payloads(requests, lambda payload: payload * 2).collect()) == ["pp", "qq"]


@pytest.mark.parametrize("sources, lines", [(1, 40_000), (400, 100)])
def test_a_task_holds_little_of_its_rows(sources, lines):
    """Batches of 10,000 rows of a kilobyte each, as Spark hands them over, from one long source and from many short ones."""
    expected = len(folds.windows([10] * lines, 200, 0.2))

    def batches():
        if sources == 1:  # a long source opens with its marker: entry, runs before, runs in all
            yield batch(["=s0"], [-1], [0], [None], [0], [expected])
        for start in range(0, sources * lines, 10_000):
            row = np.arange(start, start + 10_000)
            pos = row % lines
            yield batch([f"=s{i}" for i in row // lines], pos, row * 0 + 10, [f"{i:01000d}" for i in pos], pos, pos)

    def batch(source, pos, tokens, value, first, last):
        columns = [pa.array(source), pa.array([0] * len(pos)), pa.array(pos), pa.array(tokens), pa.array(value, pa.string()),
                   pa.array(first), pa.array(last)]
        return pa.RecordBatch.from_arrays(columns, ["source", "chunk", "pos", "tokens", "value", "first", "last"])

    before, runs, largest, held = pa.total_allocated_bytes(), 0, 0, 0
    for out in _stream_function(Budget(200, 40, True), 65536, BUFFER_ROWS)(batches()):
        lines_in = [len(c.split("\n")) for c in out["content"].to_pylist()]
        assert [10 * n for n in lines_in] == out["token_count"].to_pylist()
        assert set(out["total_windows"].to_pylist()) == {expected}
        runs += out.num_rows
        largest, held = max(largest, out.nbytes), max(held, pa.total_allocated_bytes() - before)
    assert runs == sources * expected
    assert largest < 16 << 20 and held < 64 << 20
