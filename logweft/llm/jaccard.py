"""Near duplicates: an exact Jaccard join of shingle sets, and its components.

A text's set is hashed into points: shingles fall into ``groups`` by hash, and the counts per group are coordinates.
For two points the sum of the smaller of each two coordinates bounds the overlap of the sets from above, and for a
rectangle of points so does its upper corner.  An R-tree over points therefore finds all sets whose overlap can
reach the threshold, and those that remain are verified on the sets themselves.

To spread that search over a cluster, sets meet in cells.  Two sets that link differ in at most
``D = (n + m) * (100 - p) / (100 + p)`` shingles, so if shingles are dealt to more than ``D`` buckets by hash, some
bucket holds the same shingles of both.  Each set has a key for every bucket's contents; sets with a common key share
a cell.  The number of buckets is fixed per band of set sizes, and a set that may link into the next band has keys
there too.  Buckets may be empty, so there are a few more than needed, and a set with more empty ones than that also
has keys for them: no pair is lost.

A set with fewer empty buckets than that has more keys in common with any set it links with than one, say ``s`` more.
So it leaves its ``s`` largest cells: of the common keys of two sets, the one with the smallest cell has at least
``s`` others after it, in either set, and stays in both.  Passages that many texts share make the largest cells.

1. Keys and points of all texts (one pass), once per set and task.  Equal sets are one from here on.
2. Cells of at least two different sets, and of these the ones a set stays in, by windows over keys and over sets.
3. Stars: every set against one leader, the smallest set of most of its cells, bound first, then verified; components
   of these links.  In cells that still have several components, members against the cell's smallest and largest sets
   where components differ.
4. Cells of four or more sets that still have several components: an R-tree for all those with the same smallest set,
   or per cell where that is less work or they have more than ``chunk`` sets between them, cells of more than that in pairs of chunks;
   candidates of different components are verified.  A large group of near copies is one component after step 3, so
   its pairs are never listed.
5. Components of all links, and of the texts of one id.

To verify pairs, each text is sent once to the set it is compared with, together with others that are; a set with many
partners is sent to several groups of at most ``partners`` of them.  No shingles are shuffled or written.

Shingles and sets are told apart by 64-bit hashes.

Defined cases: a text of fewer words than a shingle is one shingle of all its words; a null or empty text, or one
without words, has no shingle and links with nothing; a null id is returned as it is, with a null component, and
links nothing; rows of one id are one document, so their texts are linked, whatever they are, and all have its
component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweft.llm.components import components
from logweft.llm.landing import Scratch, landed, small
from logweft.llm.text import GOLDEN, WordCodes, lower_words, mix


@dataclass(frozen=True)
class JaccardConfig:
    """``words`` per shingle, ``percent`` of the union shared; ``growth`` from one band of sizes to the next.

    A point has ``groups`` coordinates (a power of two), or twice as many as often as it takes to have at most ``load``
    shingles in a group on average: with more, sets that share nothing would have like counts.
    """

    words: int = 3
    percent: int = 90
    groups: int = 256
    load: int = 8
    growth: float = 1.5
    leaf: int = 16
    chunk: int = 8_000
    partners: int = 200
    slot_texts: int = 400
    broadcast_rows: int = 100_000


# --- sets --------------------------------------------------------------------------------------------------


class Shingles:
    """Hashed shingle sets of texts; one per worker, since it remembers words."""

    def __init__(self, words: int):
        self.words = words
        self.codes = WordCodes(xxhash.xxh3_64_intdigest)

    def of(self, text: str | None) -> np.ndarray:
        """Distinct shingles' hashes, sorted."""
        found = lower_words(text)
        if not found:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.codes.__getitem__, found), np.uint64, len(found))
        reach = min(self.words, len(hashes))
        with np.errstate(over="ignore"):
            joined = hashes[: len(hashes) - reach + 1] + np.uint64(reach)
            for k in range(1, reach):
                joined = mix(joined) * GOLDEN + hashes[k: len(hashes) - reach + 1 + k]
        return np.unique(mix(joined))


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit name of the set."""
    with np.errstate(over="ignore"):
        total = mix(shingles + GOLDEN).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.array([total]))[0].astype(np.int64))


class Bands:
    """Bands of set sizes with their numbers of buckets."""

    def __init__(self, percent: int, growth: float):
        self.percent, self.growth = percent, growth
        self.lows = [1, 2]

    def _extend(self) -> None:
        self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * self.growth)))

    def band(self, size: int) -> int:
        while self.lows[-1] <= size:
            self._extend()
        return int(np.searchsorted(self.lows, size, side="right")) - 1

    def buckets(self, band: int) -> tuple[int, int]:
        """Buckets of the band, and how many of a set may be empty without further keys.  0 where only equal sets link."""
        while len(self.lows) <= band + 1:
            self._extend()
        differ = 2 * (self.lows[band + 1] - 1) * (100 - self.percent) // (100 + self.percent)
        spare = -(-8 * differ // 100) + 2
        return (differ + 1 + spare, spare) if differ else (0, 0)

    def of(self, size: int) -> range:
        """Bands of all sizes from this one to the largest that can link with it."""
        return range(self.band(size), self.band(size * 100 // self.percent) + 1)


def cell_keys(shingles: np.ndarray, bands: Bands) -> list[tuple[np.ndarray, int]]:
    """Per band the keys of the cells a set belongs to, and how many of them, the same for all by some order of all keys,
    it can do without: that many more than one it has in common with any set it links with."""
    found = []
    spread = mix(shingles ^ GOLDEN)
    for band in bands.of(len(shingles)):
        buckets, spare = bands.buckets(band)
        if not buckets:
            continue
        bucket = (spread >> np.uint64(33)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        sorted_buckets = bucket[order]
        starts = np.flatnonzero(np.append(True, sorted_buckets[1:] != sorted_buckets[:-1]))
        with np.errstate(over="ignore"):
            contents = np.add.reduceat(spread[order] * GOLDEN, starts)
            names = mix(sorted_buckets[starts] + np.uint64(band << 40))
            keys = mix(contents + names)
            more = spare - (buckets - len(starts))
            if more < 0:
                empty = np.setdiff1d(np.arange(buckets, dtype=np.uint64), sorted_buckets[starts])
                keys = np.append(keys, mix(mix(empty + np.uint64(band << 40)) + np.uint64(1)))
        found.append((keys.view(np.int64), max(more, 0)))
    return found


def point(shingles: np.ndarray, config: JaccardConfig) -> np.ndarray:
    """Shingles per group."""
    groups = config.groups
    while groups * config.load < len(shingles):
        groups *= 2
    counts = np.bincount((mix(shingles + np.uint64(77)) & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    kind = np.dtype(_coordinate(config)[1])
    if counts.max(initial=0) > np.iinfo(kind).max:
        raise OverflowError(f"{counts.max()} shingles in one group; load {config.load} takes {np.iinfo(kind).max}")
    return counts.astype(kind)


def _coordinate(config: JaccardConfig) -> tuple[str, str]:
    """Types of a point's coordinates in Spark and numpy: they are about ``load``."""
    return ("byte", "int8") if config.load <= 16 else ("short", "int16")


def folded(points: list) -> np.ndarray:
    """Points of different sizes as rows of the smallest size: groups are told apart by their last bits."""
    points = [np.asarray(p) for p in points]
    least = min(len(p) for p in points)
    return np.stack([p if len(p) == least else p.reshape(-1, least).sum(axis=0, dtype=np.int16) for p in points])


@functools.lru_cache
def _shingles(words: int) -> Shingles:
    """One per worker, whatever it is called for."""
    return Shingles(words)


def keyed_sets(docs: DataFrame, config: JaccardConfig) -> DataFrame:
    """``doc_id, n_shingles, set_id, keys, spares, point`` of every row; only the first row of a set in a task has its
    keys and point, and an empty set has neither these nor an id.  Keys and spares are by band."""
    rows = docs.select("doc_id", "text")
    coordinate = _coordinate(config)

    def run(batches):
        shingles, bands, seen = _shingles(config.words), Bands(config.percent, config.growth), set()
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                sets = [shingles.of(t) for t in part.column(1).to_pylist()]
                names = [set_id(s) if len(s) else None for s in sets]
                new = []
                for name in names:
                    new.append(name is not None and name not in seen)
                    seen.add(name)
                if len(seen) > 1_000_000:
                    seen.clear()
                keys = [cell_keys(s, bands) if n else None for s, n in zip(sets, new, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()),
                    pa.array([k and [x for x, _ in k] for k in keys], pa.list_(pa.list_(pa.int64()))),
                    pa.array([k and [x for _, x in k] for k in keys], pa.list_(pa.int64())),
                    pa.array([point(s, config) if n else None for s, n in zip(sets, new, strict=True)], pa.list_(pa.from_numpy_dtype(coordinate[1]))),
                ], ["doc_id", "n_shingles", "set_id", "keys", "spares", "point"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_shingles long, set_id long, keys array<array<long>>, spares array<long>, point array<{coordinate[0]}>")


def cell_members(sets: DataFrame) -> DataFrame:
    """``key, set_id, least, most, size`` of cells of two different sets or more, after every set has left the largest
    of its cells that it can do without; cells of equal size are told apart by their keys."""
    of_key = Window.partitionBy("key")

    def shared(members: DataFrame) -> DataFrame:
        return members.withColumns({"least": F.min("set_id").over(of_key), "most": F.max("set_id").over(of_key)}).where("least < most")

    # Bands are told apart by the upper half of ``spare``.
    keyed = sets.where(F.col("keys").isNotNull()).select("set_id", "spares", F.posexplode("keys").alias("band", "keys")).select(
        "set_id", F.shiftleft(F.col("band").cast("long"), 32).bitwiseOR(F.col("spares")[F.col("band")]).alias("spare"),
        F.explode("keys").alias("key"))
    # A set comes from several tasks.
    sized = shared(keyed).select("key", "set_id", "spare").distinct().withColumn("size", F.count("*").over(of_key))
    place = F.row_number().over(Window.partitionBy("set_id", "spare").orderBy(F.desc("size"), "key"))
    stay = sized.withColumn("place", place).where(F.col("place") > F.col("spare").bitwiseAND(F.lit(0xFFFFFFFF))).select("key", "set_id")
    return shared(stay).withColumn("size", F.count("*").over(of_key))


# --- R-tree ------------------------------------------------------------------------------------------------


class CountTree:
    """An R-tree of count vectors, packed in order of their widest coordinates.

    A node keeps the upper corner of its points and the smallest of their sums.
    """

    def __init__(self, points: np.ndarray, leaf: int = 16):
        self.order = self._packed(points, np.arange(len(points)), leaf)
        self.points = points[self.order]
        self.sums = self.points.sum(axis=1)
        self.leaf = leaf
        self.levels = []
        upper, least = self.points, self.sums
        while len(upper) > 1:
            cuts = np.arange(0, len(upper), leaf)
            upper, least = np.maximum.reduceat(upper, cuts, axis=0), np.minimum.reduceat(least, cuts)
            self.levels.append((upper, least))

    @staticmethod
    def _packed(points: np.ndarray, among: np.ndarray, leaf: int) -> np.ndarray:
        """Points halved by their widest coordinate until a leaf holds them; halves are whole leaves."""
        done, todo = [], [among]
        while todo:
            part = todo.pop()
            if len(part) <= leaf:
                done.append(part)
                continue
            values = points[part]
            widest = int(np.argmax(values.max(axis=0) - values.min(axis=0)))
            part = part[np.argsort(values[:, widest], kind="stable")]
            half = (len(part) // leaf + 1) // 2 * leaf
            half = half if half < len(part) else len(part) // 2
            todo += [part[half:], part[:half]]
        return np.concatenate(done) if done else among

    def reaching(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Indices of the points whose bound on the overlap reaches the threshold."""
        n = int(query.sum())
        nodes = np.arange(len(self.levels[-1][0]) if self.levels else len(self.points))
        for upper, least in reversed(self.levels):
            nodes = nodes[nodes < len(upper)]
            bound = np.minimum(upper[nodes], query).sum(axis=1)
            nodes = nodes[(100 + percent) * bound >= percent * (n + least[nodes])]
            nodes = (nodes[:, None] * self.leaf + np.arange(self.leaf)).ravel()
        nodes = nodes[nodes < len(self.points)]
        bound = np.minimum(self.points[nodes], query).sum(axis=1)
        return self.order[nodes[(100 + percent) * bound >= percent * (n + self.sums[nodes])]]


def cell_pairs(rows: pd.DataFrame, config: JaccardConfig) -> pd.DataFrame:
    """Pairs of a cell's sets of different components whose bound reaches the threshold.

    ``side`` 0 and 1 are the two chunks of a pair of chunks; a chunk met with itself has side 0 only.
    """
    left = rows[rows["side"] == 0]
    right = rows[rows["side"] == 1]
    same = right.empty
    right = left if same else right
    found: list[tuple[int, int]] = []
    if len(left) and len(right):
        both = folded([*left["point"], *right["point"]])
        queries, points = both[: len(left)], both[len(left):]
        tree = CountTree(points, config.leaf)
        ids, labels = right["set_id"].to_numpy(), right["label"].to_numpy()
        for a, label, q in zip(left["set_id"], left["label"], queries, strict=True):
            near = tree.reaching(q, config.percent)
            near = near[labels[near] != label]
            found += [(min(a, b), max(a, b)) for b in ids[near].tolist() if not same or a < b]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


# --- join --------------------------------------------------------------------------------------------------


def overlap_bound(a: Column, b: Column) -> Column:
    """The sum of the smaller coordinates; sizes of sets that can link differ by less than two, so those of points are
    equal or differ by a factor of two."""
    def bound(x, y):
        return F.aggregate(F.zip_with(x, y, lambda u, v: F.least(u, v)), F.lit(0), lambda s, u: s + u.cast("int"))

    def half(x):
        size = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, F.lit(1), size), F.slice(x, size + 1, size), lambda u, v: u.cast("int") + v.cast("int"))

    return F.when(F.size(a) == F.size(b), bound(a, b)).when(F.size(a) == 2 * F.size(b), bound(half(a), b)).when(
        F.size(b) == 2 * F.size(a), bound(a, half(b))).otherwise(0)


@dataclass
class _Verifier:
    """Verifies pairs of sets on the texts of the documents that stand for them.

    ``points``: ``set_id, n, point``; ``classes``: ``set_id, first_id``.
    """

    docs: DataFrame
    points: DataFrame
    classes: DataFrame
    config: JaccardConfig
    scratch: Scratch

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of the pairs ``a, b`` that link: first by the bound on points, then on the texts."""
        config, p = self.config, self.config.percent
        side = lambda x: self.points.select(F.col("set_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("point").alias(f"p_{x}"))
        narrow = self.scratch.land(
            pairs.join(side("a"), "a").join(side("b"), "b")
            .where((100 + p) * overlap_bound(F.col("p_a"), F.col("p_b")) >= p * (F.col("n_a") + F.col("n_b")))
            .select("a", "b"), f"{name}-bound")
        fans = narrow.groupBy("a").agg(F.ceil(F.count("*") / config.partners).cast("int").alias("parts"))
        dealt = narrow.join(fans, "a").select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), F.col("b").alias("set_id"))
        leads = fans.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("set_id"))
        roles = self.scratch.land(
            dealt.unionByName(leads).join(self.classes, "set_id").select("first_id", "set_id", "a", "part"), f"{name}-roles")
        slots = max(1, math.ceil(roles.count() / config.slot_texts))
        sent = self.docs.select("doc_id", "text").join(
            small(roles, config.broadcast_rows), F.col("doc_id") == F.col("first_id")).select(
            F.pmod(F.xxhash64("a", "part"), F.lit(slots)).alias("slot"), "a", "part", "set_id", "text")
        found = self.scratch.land(
            sent.groupBy("slot").applyInArrow(lambda table: _linked(table, config), "a long, b long").distinct(), name)
        self.scratch.drop(f"{name}-roles")
        self.scratch.drop(f"{name}-bound")
        return found


def _linked(table: pa.Table, config: JaccardConfig) -> pa.Table:
    """Links of the sets ``a`` of a slot with the sets sent to them."""
    shingles = _shingles(config.words)
    lead, part, names = (table.column(c).to_pylist() for c in ("a", "part", "set_id"))
    texts = table.column("text")
    found = []
    for (a, _), run in itertools.groupby(sorted(range(len(lead)), key=lambda i: (lead[i], part[i], names[i] != lead[i])), key=lambda i: (lead[i], part[i])):
        own = None
        for i in run:
            if own is None and names[i] != a:
                break
            other = shingles.of(texts[i].as_py())
            if set_id(other) != names[i]:
                continue  # another text of the same id
            if names[i] == a:
                own = other
                continue
            shared = len(np.intersect1d(own, other, assume_unique=True))
            if 100 * shared >= config.percent * (len(own) + len(other) - shared):
                found.append((a, names[i]))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def near_duplicates(docs: DataFrame, config: JaccardConfig = JaccardConfig()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; the component is the smallest id reachable by links."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    sets = scratch.land(keyed_sets(docs, config), "keys")
    rows = scratch.land(sets.select("doc_id", "n_shingles", "set_id"), "rows")
    classes = scratch.land(rows.where(F.col("doc_id").isNotNull() & F.col("set_id").isNotNull()).groupBy("set_id").agg(
        F.min("doc_id").alias("first_id")), "classes")

    members = scratch.land(cell_members(sets), "members")

    # One point per set of a cell.
    inside = members.select("set_id").distinct()
    points = scratch.land(
        sets.where(F.col("point").isNotNull()).select("set_id", F.col("n_shingles").alias("n"), "point")
        .join(small(scratch.land(inside, "inside"), config.broadcast_rows), "set_id").dropDuplicates(["set_id"]), "points")
    scratch.drop("keys")
    verifier = _Verifier(docs, points, classes, config, scratch)

    led = scratch.land(members.where("set_id <> least").groupBy("set_id", "least").count(), "led")
    stars = led.groupBy("set_id").agg(F.max_by("least", F.struct("count", "least")).alias("a")).select("a", F.col("set_id").alias("b"))
    links = verifier.links(stars, "first-links")
    labels = small(scratch.land(components(links), "first-labels"), config.broadcast_rows)

    to_least = led.select(F.col("least").alias("a"), F.col("set_id").alias("b"))
    to_most = members.where("set_id <> most and set_id <> least").select(F.col("set_id").alias("a"), F.col("most").alias("b"))
    both = _labelled(_labelled(to_least.unionByName(to_most.distinct()), labels, "a"), labels, "b")
    stars = scratch.land(both.where("a_label <> b_label").select("a", "b").distinct(), "stars")
    scratch.drop("led")
    links = links.unionByName(verifier.links(stars, "second-links"))
    labels = small(scratch.land(components(links), "second-labels"), config.broadcast_rows)

    # Cells of four sets or more that still have several labels, without the sets that all others were compared with.
    of_key = Window.partitionBy("key")
    rest = scratch.land(
        _labelled(members.where("size >= 4"), labels, "set_id").withColumnRenamed("set_id_label", "label")
        .withColumns({"lowest": F.min("label").over(of_key), "highest": F.max("label").over(of_key)})
        .where("lowest < highest and set_id <> least and set_id <> most").select("key", "least", "size", "set_id", "label"), "rest")
    scratch.drop("members")
    dealt = scratch.land(_by_leader(rest, config), "dealt")
    pairs = scratch.land(
        _chunked_pairs(dealt.join(points.select("set_id", "point"), "set_id"), config).distinct(), "pairs")
    links = links.unionByName(verifier.links(pairs, "third-links"))

    # The texts of one id are one document.
    of_id = rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("set_id").alias("a"), F.max("set_id").alias("most"), (F.count("*") > F.count("set_id")).alias("with_empty"))
    several = small(scratch.land(of_id.where("a < most or a is not null and with_empty"), "several"), config.broadcast_rows)
    same_id = rows.join(several, "doc_id").where("set_id > a").select("a", F.col("set_id").alias("b"))
    labels = components(links.unionByName(same_id))

    whole = classes.join(labels.select(F.col("node").alias("set_id"), "label"), "set_id", "left").withColumn(
        "label", F.coalesce("label", "set_id"))
    first = whole.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_set = whole.select("set_id", "label").join(first, "label").select("set_id", "component_id")
    # A row without words has the set of its id's other rows, if there are any.
    named = rows.join(several.select("doc_id", F.col("a").alias("of_others")), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("set_id", "of_others").alias("set_id"))
    result = landed(named.join(of_set, "set_id", "left").select("doc_id", "n_shingles", F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")), "jaccard-components")
    scratch.drop()
    return result


def _labelled(frame: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``frame`` with the label of the set in ``column``; a set without links is its own label."""
    of = labels.select(F.col("node").alias(column), F.col("label").alias(f"{column}_label"))
    return frame.join(of, column, "left").withColumn(f"{column}_label", F.coalesce(f"{column}_label", column))


#: What it takes to ask a tree at all, in sets of the tree.
ASKING = 1_000


def _by_leader(rest: DataFrame, config: JaccardConfig) -> DataFrame:
    """``led, key, size, set_id, label``: cells with the same smallest set as one, since mostly the same sets meet there,
    if that is no more work and they have no more than ``chunk`` sets between them; the others as they are."""
    together = rest.groupBy("least", "set_id", "label").agg(F.sum(F.col("size") + ASKING).alias("apart"))
    leaders = together.groupBy("least").agg(F.count("*").alias("sets"), F.sum("apart").alias("apart")).withColumn(
        "led", (F.col("sets") <= config.chunk) & (F.col("sets") * (F.col("sets") + ASKING) <= F.col("apart")))
    one = together.drop("apart").join(leaders.where("led"), "least").select("led", F.col("least").alias("key"), F.col("sets").alias("size"), "set_id", "label")
    apart = rest.join(leaders.where("not led").select("least", "led"), "least").select("led", "key", "size", "set_id", "label")
    return one.unionByName(apart)


def _chunked_pairs(rest: DataFrame, config: JaccardConfig) -> DataFrame:
    """Candidate pairs of the open cells (``led, key``), each pair of chunks of a cell in a group of its own."""
    chunks = F.ceil(F.col("size") / config.chunk).cast("int")
    own = F.pmod(F.xxhash64("set_id", F.lit(5)), chunks).cast("int")
    dealt = rest.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    grouped = dealt.select(
        "led", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "set_id", "label", "point")
    return grouped.groupBy("led", "key", "i", "j").applyInPandas(lambda rows: cell_pairs(rows, config), "a long, b long")
