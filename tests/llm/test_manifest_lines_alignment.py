"""Merkle manifest, line dedup and tokenizer alignment against plain Python, and with awkward rows."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from logweft.llm import alignment, landing, line_dedup, merkle
from logweft.llm.queries import PIECES, QUERIES, VOCABULARY

ALIGN = alignment.AlignConfig(VOCABULARY, PIECES, block_links=150)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- manifest ----------------------------------------------------------------------------------------------


def plain_tree(nodes):
    """Layers up to one node."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k: k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def plain_path(layers, index):
    for layer in layers[:-1]:
        first = index // 3 * 3
        yield layer[first:index], layer[index + 1: first + 3]
        index //= 3


def plain_manifest(rows):
    """Of (tree, key, leaf, claimed)."""
    trees = collections.defaultdict(list)
    for row in rows:
        trees[row[0]].append(row)
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    built = {t: sorted(trees[t], key=lambda r: (r[1] is not None, r[1] or 0, r[2])) for t in order}
    layers = {t: plain_tree([r[2] for r in built[t]]) for t in order}
    top = plain_tree([layers[t][-1][0] for t in order])
    out = []
    for number, t in enumerate(order):
        for index, (_, key, leaf, claimed) in enumerate(built[t]):
            path = [*plain_path(layers[t], index), *plain_path(top, number)]
            folded = claimed if claimed is not None else leaf
            for before, after in path:
                folded = h("".join([*before, folded, *after]))
            proof = [n for before, after in path for n in [*before, *after]]
            out.append((t, key, leaf, layers[t][-1][0], top[-1][0], h("".join(proof)), folded, folded == top[-1][0], proof))
    return sorted(out, key=repr)


def leaves_of(draw, sizes):
    rows = []
    for tree, size in sizes.items():
        for key in draw.sample(range(10 * size), size):
            leaf = h(f"{tree}{key}")
            rows.append((tree, key, leaf, draw.choice([leaf, None, h("other")])))
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 3, "b": 4}, {"hot": 300, "x": 28, None: 27, "": 9, "é": 10, "z": 1}, {f"t{k}": 1 + k % 4 for k in range(40)}])
def test_manifest_equals_plain_trees(spark, sizes):
    rows = leaves_of(random.Random(1), sizes)
    rows += rows[:5] + [(rows[0][0], None, h("n"), h("n"))]
    frame = spark.createDataFrame(rows, "tree string, key long, leaf string, claimed string").repartition(5)
    config = merkle.MerkleConfig(levels=1, slot_rows=20, task_rows=40)
    found = merkle.manifest(frame, config, with_proof=True)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_manifest(rows)


def test_manifest_by_joins_beyond_the_broadcast(spark):
    rows = leaves_of(random.Random(2), {"a": 50, None: 5})
    frame = spark.createDataFrame(rows, "tree string, key long, leaf string, claimed string")
    found = merkle.manifest(frame, merkle.MerkleConfig(levels=2, task_rows=10, broadcast_rows=0)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == [r[:-1] for r in plain_manifest(rows)]


def test_fields_of_leaves(spark):
    frame = spark.createDataFrame([(12, None, "é")], "a long, b string, c string")
    assert frame.select(merkle.leaf_hash(F.col("a"), F.col("b"), F.col("c"))).first()[0] == h("2:12-2:é")


def query_on(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return QUERIES[name](spark, str(tmp_path))


DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, key string, leaf double, slot int, part int"


def awkward_docs():
    extra = ("t", "k", 1.0, 2, 3)
    return [(1, "s", "en", 3, "a\nb\n", *extra), (1, "s", "en", 3, "a\nb\n", *extra), (2, None, None, None, None, *extra),
            (None, "s", "", 0, "", *extra), (7, "", "de", 5, "é\r\n中\n", *extra), (8, "s", "en", 100_000, "long\n" * 100_000, *extra),
            (9, "s", "en", 2, "no", None, None, None, None, None)]


def test_manifest_query(spark, tmp_path):
    docs = awkward_docs()

    def leaf(doc_id, source, lang, n_chars, text):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    rows = []
    for doc_id, source, lang, n_chars, text, *_ in docs:
        cut = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 2 == 0
        bad = text.replace("\n", "") if cut and text is not None else text
        rows.append((source, doc_id, leaf(doc_id, source, lang, n_chars, text), leaf(doc_id, source, lang, n_chars, bad)))
    found = query_on(spark, tmp_path, "op11_merkle", docs, DOCS)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted((r[1:8] for r in plain_manifest(rows)), key=repr)
    assert {r.verified for r in found.collect()} == {True, False}


# --- lines -------------------------------------------------------------------------------------------------


def plain_dedup(rows, least_chars=20, least_docs=3):
    blanks = " \t\n\v\f\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(blanks).translate(lower)
    holders = collections.defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= least_chars:
                holders[key(line)].add(doc_id)
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= least_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_line_dedup_equals_plain_python(spark, seed):
    draw = random.Random(seed)
    pool = [f"{'Common License Line number ' if k % 3 else 'é line '}{k} {'x' * draw.randint(0, 9)}" for k in range(25)]
    rows = []
    for doc_id in [*range(60), None, None, 5, 5]:
        lines = [draw.choice([" ", "\t", ""]) + draw.choice([str.upper, str.lower, str])(draw.choice(pool)) + draw.choice(["", "\r", " "])
                 for _ in range(draw.randint(0, 12))]
        rows.append((doc_id, draw.choice([None, "", "\n".join(lines), "\n".join(lines), "\n".join(lines) + "\n"])))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = line_dedup.dedup_lines(frame).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_dedup(rows)
    assert any(r.n_dropped for r in found)


def test_line_dedup_keeps_other_columns_whatever_their_names(spark):
    line = "a line of at least twenty characters"
    rows = [(k, f"{line}\nown {k}", "k", 2.0, "d", 7) for k in range(4)] + [(9, "long line " * 100_000, None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, keys string, row double, text_hash string, n_lines int")
    found = line_dedup.dedup_lines(frame)
    assert found.columns == ["doc_id", "keys", "row", "text_hash", "text", "n_lines", "n_dropped"]
    kept = {r.doc_id: (r.text, r.n_lines, r.n_dropped, r["keys"], r.row) for r in found.collect()}
    assert kept[0] == ("own 0", 2, 1, "k", 2.0) and kept[3] == (f"{line}\nown 3", 2, 0, "k", 2.0)
    assert kept[9][0] == "long line " * 100_000


def test_line_dedup_query_over_nothing_and_awkward_rows(spark, tmp_path):
    found = query_on(spark, tmp_path, "op12_line_dedup", awkward_docs(), DOCS).collect()
    want = [(d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in plain_dedup([(r[0], r[4]) for r in awkward_docs()])]
    assert sorted((tuple(r) for r in found), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", ["op11_merkle", "op12_line_dedup", "op13_alignment"])
def test_empty_tables(spark, tmp_path, name):
    assert query_on(spark, tmp_path, name, [], DOCS).count() == 0


# --- alignment ---------------------------------------------------------------------------------------------

TEXTS = [
    "Hello world, hello world.", "", None, "é ñ 中文 naïve — “quotes” 😀👩‍👩‍👧 あ", "tabs\tand\n\nlines  and   blanks ", " ", "\n",
    "<|endoftext|> and <s> </s> <unk> <0x41> are text", "▁ is a sign of its own", "é combining", "﻿bom", "ﬁ ligature ½ Ⅷ",
    "emoji 🧿🪬 of bytes 🫠", "日本語のテキストと한국어", "x" * 3000, "Ça va? Größe! " * 40, " no-break thin", "Hello world, hello world."]


def plain_alignment(texts):
    aligner = alignment.Aligner(ALIGN)
    docs = []
    for text in texts:
        groups = []
        if text:
            data = (" " + text).encode()
            a = aligner.byte_bpe.encode(" " + text, add_special_tokens=False).ids
            b = aligner.pieces.encode(text)
            if b"".join(aligner.a_bytes[i] for i in a) == data == b"".join(aligner.b_bytes[i] for i in b):
                i = j = 0
                while i < len(a):
                    left, right, x, y = [a[i]], [b[j]], len(aligner.a_bytes[a[i]]), len(aligner.b_bytes[b[j]])
                    i, j = i + 1, j + 1
                    while x != y:
                        if x < y:
                            left.append(a[i])
                            x, i = x + len(aligner.a_bytes[a[i]]), i + 1
                        else:
                            right.append(b[j])
                            y, j = y + len(aligner.b_bytes[b[j]]), j + 1
                    groups.append((left, right))
        docs.append(groups)
    count = collections.Counter((g[0][-1], g[1][-1]) for groups in docs for g in groups)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for k, groups in enumerate(docs):
        links = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((k, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), h(text) if text else "", text))
    return out


@pytest.mark.parametrize("broadcast_pairs", [1_000_000, 0])
def test_alignment_equals_plain_merging(spark, broadcast_pairs):
    draw = random.Random(4)
    letters = "ab é中😀🧿\n\t.,'0Aん▁"
    texts = TEXTS + ["".join(draw.choices(letters, k=draw.randint(1, 60))) for _ in range(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    config = alignment.AlignConfig(VOCABULARY, PIECES, block_links=150, broadcast_pairs=broadcast_pairs)
    found = alignment.align(frame, config, with_groups=True)
    assert sorted(tuple(r) for r in found.collect()) == plain_alignment(texts)


def test_spans_within_characters_are_refined():
    begins, ends, lengths = ([0, 3, 3, 3, 7, 8], [3, 3, 3, 7, 8, 9], [3, 1, 1, 2, 1, 1])
    import numpy as np

    assert alignment.refined(np.array(begins), np.array(ends), np.array(lengths)).tolist() == [3, 4, 5, 7, 8, 9]


def test_special_tokens_and_lost_texts():
    aligner = alignment.Aligner(ALIGN)
    found = aligner.align("<|endoftext|> <s>")
    assert len(found.a) > 5 and 50256 not in found.a
    assert not len(aligner.align("▁").a), "B reads the sign as a space"
    assert aligner.written(aligner.align("")) == ""


def test_alignment_query_with_awkward_rows(spark, tmp_path):
    found = query_on(spark, tmp_path, "op13_alignment", awkward_docs(), DOCS)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(d[0], *row[1:8]) for d, row in zip(awkward_docs(), plain_alignment([d[4] for d in awkward_docs()]), strict=True)]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr)


def test_long_runs_are_aligned():
    aligner = alignment.Aligner(ALIGN)
    for text in (" " * 300_000, "\n" * 300_000, "-" * 300_000):
        assert len(aligner.align(text).a)


def test_segments_are_looked_up_without_collecting_garbage():
    import gc

    aligner, seen = alignment.Aligner(ALIGN), []
    texts = [" ".join(f"w{k} x{k % 7}" for k in range(i, i + 2_000)) for i in range(0, 20_000, 2_000)] + ["a" * 60, None]
    gc.collect()
    gc.callbacks.append(note := lambda phase, info: seen.append(phase))
    try:
        found = aligner.whole(texts)
        during = len(seen)
    finally:
        gc.callbacks.remove(note)
    assert during <= 2 and gc.isenabled()  # the one that was due, begun and ended
    assert found[-2][2] and found[-1] == ("", b"", 0, 0)
    assert all(len(s) < 48 for s in aligner.known) and aligner.whole(["w5 x5"]) == alignment.Aligner(ALIGN).whole(["w5 x5"])


def test_blocks_are_written_in_rows_and_row_groups_of_bounded_size(spark, conf):
    import pyarrow.parquet as pq

    conf("spark.sql.execution.arrow.maxBytesPerBatch", "32m")
    draw = random.Random(6)
    words = ["".join(draw.choices("etaoinsh", k=draw.randint(1, 9))) for _ in range(5_000)]
    texts = [" ".join(draw.choices(words, k=8_000)) for _ in range(300)] + ["", None, "word " * 60_000, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).cache()
    config = alignment.AlignConfig(VOCABULARY, PIECES)
    blocks = landing.Scratch(spark, "blocks").land(alignment.aligned_blocks(frame, config), "b", alignment.BATCH_BYTES, **landing.LONG_ROWS)
    rows = blocks.select("block", F.size("doc_ids").alias("texts"), F.length("codes").alias("bytes"), F.size("a").alias("pairs")).collect()
    assert sum(r.texts for r in rows) == len(texts) and sum(r.bytes for r in rows) > 20 << 20
    assert all(r.bytes <= 4 * config.strip_links or r.texts == 1 for r in rows)
    assert [sum(r.pairs > 0 for r in rows if r.block == b) for b in {r.block for r in rows}] == [1] * len({r.block for r in rows}), "pairs once a block"
    (path,) = blocks.inputFiles()
    file = pq.ParquetFile(path.removeprefix("file://"))
    groups = [file.metadata.row_group(k) for k in range(file.num_row_groups)]
    assert len(groups) > 1 and max(g.total_byte_size for g in groups) < 12 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "32m", "put back"


def test_strips_hold_all_texts_once():
    draw = random.Random(7)
    for limit in (0, 1, 10, 10**9):
        sizes = [draw.choice([0, 0, 1, 3, 9, 40]) for _ in range(2_500)]
        upto = [0]
        for n in sizes:
            upto.append(upto[-1] + n)
        strips = list(alignment._strips(upto, limit))
        assert [k for i, j in strips for k in range(i, j)] == list(range(len(sizes)))
        assert all(j > i and (j == i + 1 or upto[j] - upto[i] <= limit) and j - i <= 1_000 for i, j in strips)


@pytest.mark.parametrize("strip_links", [0, 7, 60])
def test_alignment_in_strips_equals_plain_merging(spark, strip_links):
    frame = spark.createDataFrame(list(enumerate(TEXTS * 3)), "doc_id long, text string").repartition(2)
    config = alignment.AlignConfig(VOCABULARY, PIECES, block_links=400, strip_links=strip_links)
    assert alignment.aligned_blocks(frame, config).groupBy("block").count().where("count > 1").count()
    found = alignment.align(frame, config, with_groups=True)
    assert sorted(tuple(r) for r in found.collect()) == plain_alignment(TEXTS * 3)
