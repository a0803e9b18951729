"""Benchmark decontamination by spaced seeds.

A mask is a row of word positions of which some are ignored.  Every stretch of words as long as a mask is hashed
under each mask, in the benchmark and in the documents, so that a substituted word leaves those seeds intact that
ignore its place.  Equal seeds are hits.  Around each hit the words of document and benchmark are compared one by
one, over every window that holds the seed, and a window counts if enough of it agrees.

The masks are such that each window with enough agreement holds an intact seed (the tests try all patterns of
substitutions), so hits lose no window.  A benchmark text shorter than a window is one window; masks do not reach
all its patterns, so its seeds are runs of words that part it, one more than it may have substitutions, of which
one is always intact; a text shorter than a mask is one run and must be there whole.  Documents are looked up under the masks and the lengths of runs that the benchmark uses.

Words are compared in lower case and without signs.  All work is column expressions.  The documents are read and
not shuffled: seeds of the benchmark, each with the hashes around it, are broadcast in blocks of at most
``block_seeds``, which bounds them; a benchmark of more seeds takes one pass over the documents per block.  Hits
travel, and are brought to the texts of their documents again: broadcast up to ``broadcast_documents`` documents,
else by a join on the id.

Defined cases: null and empty texts match nothing; a benchmark text of fewer words than a mask has
matches verbatim only, which for one of a word or two is every document with them; repeated benchmark texts are reported under every id; documents with a
null id are not reported, and stay; repeated rows are reported once; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm.landing import landed, small


@dataclass(frozen=True)
class SeedConfig:
    """``masks``: of equal length, 1 for a position that counts; ``percent`` of a ``window`` must agree."""

    masks: tuple[str, ...] = ("110100011", "111001001")
    window: int = 16
    percent: int = 80
    block_seeds: int = 200_000
    broadcast_documents: int = 20_000

    def __post_init__(self):
        if len({len(m) for m in self.masks}) != 1 or any(set(m) - set("01") for m in self.masks):
            raise ValueError("masks must be of equal length and made of 0 and 1")

    @property
    def span(self) -> int:
        return len(self.masks[0])


def word_hashes(text: Column) -> Column:
    """Hashes of the words, without signs and in lower case."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}\s]+", "")
    return F.transform(F.filter(F.split(plain, r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(hashes: Column, mask: str) -> Column:
    """The seed at every word, null where the mask would end after the last; null for a text without words."""
    def at(i: Column) -> Column:
        return F.when(i + len(mask) <= F.size(hashes), F.xxhash64(
            F.lit(mask), *[F.get(hashes, i + k) for k, bit in enumerate(mask) if bit == "1"]))

    return F.when(F.size(hashes) > 0, F.transform(F.sequence(F.lit(0), F.size(hashes) - 1), at))


def runs(words: int, config: SeedConfig) -> list[tuple[int, int]]:
    """``(place, length)`` of runs that part a text of so many words, one more than it may have substitutions; one run for
    a text shorter than a mask."""
    if words < config.span:
        return [(0, words)]
    parts = words * (100 - config.percent) // 100 + 1
    ends = [words * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _seeded(rows: DataFrame, masks: list[str]) -> DataFrame:
    """``doc_id, place, seed`` of documents under all ``masks``; ``place`` of the first word.

    Seeds that a text is too short for are null and join with nothing: a filter on the hashes, or one that the
    optimizer derives from ``posexplode``, would be pushed below them and compute them again per word.  Documents do
    not carry their hashes, which would be copied for each of their words.
    """
    return (
        rows.select("doc_id", word_hashes(F.col("text")).alias("hashes"))
        .withColumn("number", F.size("hashes"))
        .withColumn("seeds", F.concat(*[seeds(F.col("hashes"), m) for m in masks]))
        .select("doc_id", "number", F.posexplode_outer("seeds").alias("at", "seed"))
        .select("doc_id", F.pmod("at", "number").alias("place"), "seed"))


def benchmark_seeds(benchmark: DataFrame, config: SeedConfig) -> DataFrame:
    """``seed, mask, text_key, shift, compared``: per seed the hashes of all windows that hold it, and where they
    begin relative to the seed.  Equal texts are one."""
    texts = benchmark.select(F.xxhash64(word_hashes(F.col("text"))).alias("text_key"), "text").dropDuplicates(["text_key"])
    rows = texts.select("text_key", word_hashes(F.col("text")).alias("hashes")).withColumn("n_words", F.size("hashes"))
    hashes = F.col("hashes")

    def entry(mask: str, place: Column, seed: Column) -> Column:
        return F.struct(F.lit(mask).alias("mask"), place.alias("place"), seed.alias("seed"))

    def under(mask: str) -> Column:
        return F.transform(seeds(hashes, mask), lambda seed, place: entry(mask, place, seed))

    found = F.when(F.col("n_words") >= config.window, F.concat(*[under(m) for m in config.masks]))
    for n in range(1, config.window):
        found = found.when(F.col("n_words") == n, F.array(*[
            entry("1" * k, F.lit(at), F.get(seeds(hashes, "1" * k), F.lit(at))) for at, k in runs(n, config)]))
    exploded = rows.withColumn("found", found).select("text_key", "hashes", "n_words", F.explode("found").alias("found")).select(
        "text_key", "hashes", "n_words", "found.*").where(F.col("seed").isNotNull())
    begin = F.greatest(F.lit(0), F.col("place") + F.length("mask") - config.window)
    end = F.least(F.col("n_words"), F.col("place") + config.window)
    return exploded.select(
        "seed", "mask", "text_key", (begin - F.col("place")).alias("shift"),
        F.slice("hashes", begin + 1, end - begin).alias("compared")).dropDuplicates(["seed", "text_key", "compared"])


def contaminated(docs: DataFrame, benchmark: DataFrame, config: SeedConfig = SeedConfig()) -> DataFrame:
    """``doc_id, item_id, n_equal, n_compared, first_word, end_word, n_windows``: one row per document and benchmark
    text that overlap; the best window's agreeing words, and the words of the document that windows cover."""
    items = benchmark.select("item_id", F.xxhash64(word_hashes(F.col("text"))).alias("text_key"))
    table = landed(benchmark_seeds(benchmark, config), "benchmark-seeds")
    blocks = max(1, -(-table.count() // config.block_seeds))
    masks = sorted(r.mask for r in table.select("mask").distinct().collect()) or list(config.masks)
    table, hits = table.drop("mask"), None
    for block in range(blocks):
        part = table if blocks == 1 else table.where(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == block)
        found = _seeded(docs.where(F.col("doc_id").isNotNull()), masks).join(F.broadcast(part), "seed").select(
            "doc_id", "text_key", (F.col("place") + F.col("shift")).alias("begin"), "compared")
        hits = found if hits is None else hits.unionByName(found)
    of_doc = landed(
        hits.groupBy("doc_id").agg(F.collect_set(F.struct("text_key", "begin", "compared")).alias("hits")), "benchmark-hits")

    # Only documents with hits are hashed again, and compared around them.
    around = docs.select("doc_id", "text").join(small(of_doc, config.broadcast_documents), "doc_id").select(
        "doc_id", "hits", word_hashes(F.col("text")).alias("hashes"))

    def judged(hit: Column) -> Column:
        words = F.least(F.size(hit["compared"]), F.lit(config.window))

        def windows(same: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), F.size(same) - words), lambda k: F.struct(
                hit["text_key"].alias("text_key"), (hit["begin"] + k).alias("begin"), words.alias("n_compared"),
                F.aggregate(F.slice(same, k + 1, words), F.lit(0), lambda n, x: n + x).alias("n_equal")))

        same = F.transform(hit["compared"], lambda h, k: F.coalesce((h == F.get(F.col("hashes"), hit["begin"] + k)).cast("int"), F.lit(0)))
        # In an array of one, so that it is computed once and not for each window.
        every = F.flatten(F.transform(F.array(same), windows))
        return F.filter(every, lambda w: 100 * w["n_equal"] >= F.when(
            w["n_compared"] < config.span, 100).otherwise(config.percent) * w["n_compared"])

    verified = around.select("doc_id", F.explode_outer(F.flatten(F.transform("hits", judged))).alias("hit")).select(
        "doc_id", "hit.*").where(F.col("text_key").isNotNull())
    by_text = verified.groupBy("doc_id", "text_key").agg(
        F.max("n_equal").alias("n_equal"), F.max("n_compared").alias("n_compared"), F.min("begin").alias("first_word"),
        F.max(F.col("begin") + F.col("n_compared")).alias("end_word"), F.count_distinct("begin").alias("n_windows"))
    return by_text.join(items.distinct(), "text_key").select(
        "doc_id", "item_id", F.col("n_equal").cast("long").alias("n_equal"), F.col("n_compared").cast("long").alias("n_compared"),
        F.greatest("first_word", F.lit(0)).cast("long").alias("first_word"), F.col("end_word").cast("long").alias("end_word"), "n_windows")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, config: SeedConfig = SeedConfig()) -> DataFrame:
    """``docs`` without those that overlap a benchmark text."""
    return docs.join(contaminated(docs, benchmark, config).select("doc_id").distinct(), "doc_id", "left_anti")
