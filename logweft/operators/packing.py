"""Greedy packing of ordered rows into token-budgeted, overlapping runs.

A run starts somewhere, takes rows while they fit into the budget, and the next run starts inside it so
that at most ``keep`` tokens are carried over.  Where the next run starts is a function of the current
start and of a bounded stretch of rows after it.  That makes the chain of starts splittable:

* rows of one source are cut into chunks of ``chunk_rows`` positions, each seeing the first rows of the
  following chunk as well;
* for every chunk the map "start at which the chain enters -> start at which it leaves" is computed for
  all starts at which it can enter (a bounded number), in parallel;
* the maps are composed in two levels (blocks of chunks, then the blocks of a source), which gives the
  real entry of every chunk together with the number of runs before it;
* every chunk then emits its runs, streaming over its sorted rows.

So a source holding any share of the data is spread over as many tasks as it has chunks.  Only narrow
columns take part until the last step, which shuffles the content once.

Rows without tokens cost nothing, so a run may hold any number of them.  A start lies at a row with tokens
or right behind one, never inside a stretch of rows without: such a stretch acts like a single row.
``join_empty_rows`` makes it one, after which two rows next to each other have a token and all bounds hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNKS_PER_BLOCK = 1024
MIN_CHUNK_ROWS = 65536
# Of a chunk this share, at most, is seen by the chunk before it as well.
CHUNK_REACHES = 16
WHOLE_SOURCE_TOKENS = 2_000_000
EMPTY_BUCKET = 65536
# What a task holds of its rows at a time; contents leave in batches of at most twice so many bytes.
BUFFER_ROWS = 16384
BUFFER_BYTES = 4 << 20

PACKED_SCHEMA = (
    "source string, window_index int, total_windows int, start_line long, end_line long, "
    "token_count long, content string"
)
_GAPS = "positions must count 0, 1, 2, ... within a source; see renumber_lines"
_TOO_FAR = "rows without tokens among rows said to have some; pass zero_tokens=True"
_MAP_SCHEMA = "source string, slot long, first long, exits array<long>, counts array<long>"
_ROOT_SCHEMA = "source string, slot long, entry long, base long, total long"
_ENTRY_SCHEMA = "source string, chunk long, entry long, base long, total long"


@dataclass(frozen=True)
class Budget:
    """Budget of a run and of what it hands to the next one."""

    max_tokens: int
    keep_tokens: int = 0
    carries: bool = False
    rows_per_token: int = 1

    @property
    def reach(self) -> int:
        """Rows a run can span, plus the row that closes it, when so many rows in turn have a token."""
        return self.rows_per_token * (self.max_tokens + 2)


def run_ends(tokens: np.ndarray, stops: np.ndarray, budget: Budget):
    """For a run starting at each row: its last row, its tokens, and the start of the next run.

    ``stops`` holds, per row, the exclusive end of the row's group; groups lie side by side.
    """
    n = len(tokens)
    here = np.arange(n)
    prefix = np.concatenate([[0], np.cumsum(tokens, dtype=np.int64)])
    last = np.searchsorted(prefix, prefix[:-1] + budget.max_tokens, side="right") - 2
    last = np.minimum(last, stops - 1)
    oversize = last < here
    last = np.where(oversize, here, last)
    total = prefix[last + 1] - prefix[here]
    following = last + 1
    if budget.carries:
        kept = np.searchsorted(prefix, prefix[following] - budget.keep_tokens, side="left")
        kept = np.minimum(np.maximum(kept, here), following)
        # A carry that leaves no room for the row that did not fit is dropped whole.
        closing = np.minimum(following + 1, n)
        blocked = (following < stops) & (prefix[closing] - prefix[kept] > budget.max_tokens)
        following = np.where(oversize | blocked, following, kept)
    following = np.where(last + 1 >= stops, stops, following)
    return last, total, following


def pack_lists(tokens: np.ndarray, sizes: np.ndarray, budget: Budget):
    """Runs of whole lists lying side by side: first row, last row, tokens and list of every run."""
    ends = np.cumsum(sizes)
    last, total, following = run_ends(tokens, np.repeat(ends, sizes), budget)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    found, at = [np.zeros(0, dtype=np.int64)], (ends - sizes)[sizes > 0]
    while len(at):
        found.append(at)
        ahead = following[at]
        at = ahead[ahead < ends[owner[at]]]
    start = np.sort(np.concatenate(found))
    return start, last[start], total[start], owner[start]


# ---------------------------------------------------------------------------------------------------
# Chunk maps: where does a chain that enters here leave the chunk, and how many runs does it start?


def _chunk_map_function(budget: Budget, chunk_rows: int):
    def chunk_map(key, table):
        source, chunk = key[0].as_py(), key[1].as_py()
        pos = table["pos"].to_numpy()
        order = np.argsort(pos, kind="stable")
        pos, tokens = pos[order], table["tokens"].to_numpy()[order]
        if pos[0] != chunk * chunk_rows or (np.diff(pos) != 1).any():
            raise ValueError(_GAPS)
        n, first, bound = len(pos), chunk * chunk_rows, (chunk + 1) * chunk_rows
        stops = np.full(n, n)
        last, _, following = run_ends(tokens, stops, budget)
        own = int(np.searchsorted(pos, bound))
        cut_off = pos[-1] == bound + min(budget.reach, chunk_rows) - 1
        if chunk == 0:
            at = np.zeros(1, dtype=np.int64)
        else:
            before = np.concatenate([[0], np.cumsum(tokens[:-1], dtype=np.int64)])
            at = np.arange(min(own, int(np.searchsorted(before, budget.max_tokens, side="right"))))
        label = np.arange(len(at))
        counts = np.zeros(len(at), dtype=np.int64)
        while True:
            inside = at < own
            if not inside.any():
                break
            if cut_off and (last[at[inside]] == n - 1).any():
                raise ValueError(_TOO_FAR)
            counts += inside[label]
            at, back = np.unique(np.where(inside, following[np.minimum(at, n - 1)], at), return_inverse=True)
            label = back.reshape(-1)[label]
        exits = np.where(at < n, pos[np.minimum(at, n - 1)], -1)[label]
        return pa.table({
            "source": pa.array([source], pa.string()),
            "slot": pa.array([chunk], pa.int64()),
            "first": pa.array([first], pa.int64()),
            "exits": pa.array([exits], pa.list_(pa.int64())),
            "counts": pa.array([counts], pa.list_(pa.int64())),
        })

    return chunk_map


def _read_maps(table: pa.Table):
    """Maps of one group in slot order: (slot, first, exits, counts)."""
    order = np.argsort(table["slot"].to_numpy(), kind="stable")
    rows = table.select(["slot", "first", "exits", "counts"]).take(pa.array(order))
    exits, counts = rows["exits"].combine_chunks(), rows["counts"].combine_chunks()
    return [
        (slot, first, exits[i].values.to_numpy(), counts[i].values.to_numpy())
        for i, (slot, first) in enumerate(zip(rows["slot"].to_pylist(), rows["first"].to_pylist()))
    ]


def _step(at: np.ndarray, runs: np.ndarray, first: int, exits: np.ndarray, counts: np.ndarray):
    """Send chains standing at positions ``at`` (-1: ended) through one more map."""
    alive = at >= 0
    index = np.where(alive, at - first, 0)
    if (index >= len(exits)).any() or (index < 0).any():
        raise ValueError(_TOO_FAR)
    return np.where(alive, exits[index], -1), runs + np.where(alive, counts[index], 0)


def _compose_block(key, table):
    maps = _read_maps(table)
    _, first, at, runs = maps[0]
    for _, start, exits, counts in maps[1:]:
        at, runs = _step(at, runs, start, exits, counts)
    return pa.table({
        "source": pa.array([key[0].as_py()], pa.string()),
        "slot": pa.array([key[1].as_py()], pa.int64()),
        "first": pa.array([first], pa.int64()),
        "exits": pa.array([at], pa.list_(pa.int64())),
        "counts": pa.array([runs], pa.list_(pa.int64())),
    })


def _walk(maps, entry: int, base: int):
    """Entries of consecutive maps for a chain that comes in at ``entry`` after ``base`` runs."""
    at, runs = np.array([entry]), np.array([base])
    slots, entries, bases = [], [], []
    for slot, first, exits, counts in maps:
        if at[0] < 0:
            break
        slots.append(slot)
        entries.append(int(at[0]))
        bases.append(int(runs[0]))
        at, runs = _step(at, runs, first, exits, counts)
    return slots, entries, bases, int(runs[0])


def _walk_source(key, table):
    slots, entries, bases, total = _walk(_read_maps(table), 0, 0)
    return pa.table({
        "source": pa.array([key[0].as_py()] * len(slots), pa.string()),
        "slot": pa.array(slots, pa.int64()),
        "entry": pa.array(entries, pa.int64()),
        "base": pa.array(bases, pa.int64()),
        "total": pa.array([total] * len(slots), pa.int64()),
    })


def _walk_block(key, maps, root):
    slots, entries, bases, total = [], [], [], 0
    if root.num_rows and maps.num_rows:
        start = root.to_pylist()[0]
        total = start["total"]
        slots, entries, bases, _ = _walk(_read_maps(maps), start["entry"], start["base"])
    return pa.table({
        "source": pa.array([key[0].as_py()] * len(slots), pa.string()),
        "chunk": pa.array(slots, pa.int64()),
        "entry": pa.array(entries, pa.int64()),
        "base": pa.array(bases, pa.int64()),
        "total": pa.array([total] * len(slots), pa.int64()),
    })


# ---------------------------------------------------------------------------------------------------
# Last step: sorted rows of whole (source, chunk) groups stream by; runs leave with their content.
#
# A group may open with a marker row (pos = -1) that tells where its chain enters (in ``tokens``), how
# many runs came before (``first``) and how many the source has in all (``last``).  Groups without one
# are whole small sources.


def _join_runs(values: pa.Array, start: np.ndarray, last: np.ndarray) -> Iterator[tuple[slice, pa.Array]]:
    """Newline-joined content per run, in slices of bounded size."""
    width = pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    bytes_before = np.concatenate([[0], np.cumsum(width)])
    size = np.cumsum(bytes_before[last + 1] - bytes_before[start])
    lo = 0
    while lo < len(start):
        done = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, done + 2 * BUFFER_BYTES, side="right")))
        lengths = last[lo:hi] - start[lo:hi] + 1
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        rows = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - start[lo:hi], lengths)
        lines = values.take(pa.array(rows)).cast(pa.string())
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines)
        yield slice(lo, hi), pc.binary_join(lists, "\n").cast(values.type)
        lo = hi


class _Groups:
    """The (source, chunk) groups of a sorted table, and for each row where a run started there goes."""

    def __init__(self, table: pa.Table, chunk_rows: int, budget: Budget):
        self.table = table
        codes = table["source"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        chunk, self.pos, tokens = (table[c].to_numpy() for c in ("chunk", "pos", "tokens"))
        rows = len(self.pos)
        new = np.concatenate([[True], (codes[1:] != codes[:-1]) | (chunk[1:] != chunk[:-1])])
        self.of_row = np.cumsum(new) - 1
        self.start = np.flatnonzero(new)
        self.end = np.append(self.start[1:], rows)
        self.chunk = chunk[self.start]
        self.marked = self.pos[self.start] < 0
        inside = ~new[1:] & (self.pos[:-1] >= 0)
        whole = ~self.marked & (self.chunk == 0)
        if (np.diff(self.pos)[inside] != 1).any() or self.pos[self.start[whole]].any():
            raise ValueError(_GAPS)
        body = self.start + self.marked
        self.filled = body < self.end
        body_pos = self.pos[np.minimum(body, rows - 1)]
        self.bound = (self.chunk + 1) * chunk_rows
        entry_pos = np.where(self.marked, tokens[self.start], body_pos)
        self.entry = np.maximum(body, body + entry_pos - body_pos)
        # Rows from here on lie in the next chunk, or the group is over.
        self.stop = np.where(
            self.filled, np.minimum(self.end, body + np.maximum(0, self.bound - body_pos)), self.start)
        self.live = (self.marked | (self.chunk == 0)) & (self.entry < self.stop)
        self.cut_off = self.pos[self.end - 1] == self.bound + min(budget.reach, chunk_rows) - 1
        weights = np.where(self.pos < 0, 0, tokens)
        self.last, self.total, self.following = run_ends(weights, self.end[self.of_row], budget)

    def chains(self, live: np.ndarray) -> np.ndarray:
        """Starts of all runs of the complete groups ``live``, in row order."""
        found, at = [], self.entry[live]
        while len(at):
            group = self.of_row[at]
            if (self.cut_off[group] & (self.last[at] + 1 >= self.end[group])).any():
                raise ValueError(_TOO_FAR)
            found.append(at)
            at = self.following[at]
            at = at[at < self.stop[group]]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)

    def open_chain(self) -> tuple[np.ndarray, int]:
        """Starts of the last group whose runs are closed by rows seen so far, and where to go on."""
        found, at, rows = [], int(self.entry[-1]), len(self.pos)
        while at < self.stop[-1] and self.last[at] + 1 < rows:
            found.append(at)
            at = int(self.following[at])
        return np.array(found, dtype=np.int64), at

    def runs(self, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(start):
            return
        owner = self.of_row[start]
        counts = np.bincount(owner, minlength=len(self.start))
        index = np.arange(len(start)) - np.repeat(np.cumsum(counts) - counts, counts)
        first, last = self.table["first"].to_numpy(), self.table["last"].to_numpy()
        index = index + np.where(self.marked, first[self.start], 0)[owner]
        of = np.where(self.marked, last[self.start], counts)[owner]
        end = self.last[start]
        sources, values = self.table["source"].combine_chunks(), self.table["value"].combine_chunks()
        for part, content in _join_runs(values, start, end):
            yield pa.RecordBatch.from_arrays([
                sources.take(pa.array(start[part])),
                pa.array(index[part], pa.int32()),
                pa.array(of[part], pa.int32()),
                pa.array(first[start[part]], pa.int64()),
                pa.array(last[end[part]], pa.int64()),
                pa.array(self.total[start[part]], pa.int64()),
                content,
            ], names=["source", "window_index", "total_windows", "start_line", "end_line",
                      "token_count", "content"])

    def resume(self, at: int, done: int) -> pa.Table:
        """The rest of the last group: its marker, moved on, and the rows from ``at``."""
        marker = self.table.slice(self.start[-1], 1)
        end = len(self.pos) - 1
        # Positions count on without gaps, so a start beyond the rows seen so far is known too.
        entry = int(self.pos[end]) + at - end
        before = marker["first"][0].as_py() + done
        for name, number in (("tokens", entry), ("first", before)):
            marker = marker.set_column(
                marker.schema.get_field_index(name), marker.schema.field(name), pa.array([number], pa.int64()))
        return pa.concat_tables([marker, self.table.slice(min(at, end))])


def _emit(table: pa.Table, chunk_rows: int, budget: Budget, final: bool):
    """Runs of the groups in ``table`` as record batches, and the rows to see again with more input."""
    groups = _Groups(table, chunk_rows, budget)
    live, rest, open_starts = groups.live.copy(), None, np.zeros(0, dtype=np.int64)
    if not final:
        live[-1] = False
        if groups.marked[-1] and groups.filled[-1]:
            open_starts, at = groups.open_chain()
            rest = groups.resume(at, len(open_starts))
        else:
            rest = table.slice(groups.start[-1])
    return groups.runs(np.concatenate([groups.chains(live), open_starts])), rest


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most ``rows`` rows and about ``BUFFER_BYTES``, however many rows Spark has put into one."""
    for batch in batches:
        step = max(1, min(rows, batch.num_rows * BUFFER_BYTES // max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _stream_function(budget: Budget, chunk_rows: int, buffer_rows: int):
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, waiting, rows, size = None, [], 0, 0
        enough_rows, enough_bytes = buffer_rows, BUFFER_BYTES
        for batch in _slices(batches, buffer_rows):
            waiting.append(batch)
            rows += batch.num_rows
            size += batch.nbytes
            if rows < enough_rows and size < enough_bytes:
                continue
            table = pa.Table.from_batches(waiting)
            table = pa.concat_tables([rest, table]) if rest is not None else table
            out, rest = _emit(table.combine_chunks(), chunk_rows, budget, final=False)
            yield from out
            waiting, rows, size = [], 0, 0
            # Rows of an open group are seen again, so no sooner than as many new ones are there.
            enough_rows, enough_bytes = max(buffer_rows, rest.num_rows), max(BUFFER_BYTES, rest.nbytes)
        table = pa.Table.from_batches(waiting) if waiting else None
        if rest is not None:
            table = pa.concat_tables([rest, table]) if table is not None else rest
        if table is not None:
            yield from _emit(table.combine_chunks(), chunk_rows, budget, final=True)[0]

    return stream


# ---------------------------------------------------------------------------------------------------


def join_empty_rows(rows: DataFrame, bucket_rows: int = EMPTY_BUCKET) -> DataFrame:
    """``rows`` with every stretch of rows without tokens as one row, numbered anew.

    Stretches are found within buckets of positions.  What a bucket needs from those before it is in a table of
    one row per bucket: how many rows they leave, and whether a stretch goes on across the border.  The text of a
    stretch is part of one run, so it is gathered no further than the result gathers it.
    """
    place = Window.partitionBy("source", "_bucket").orderBy("pos")
    empty = F.col("tokens") <= 0
    marked = (
        rows.withColumn("_bucket", F.call_function("div", F.col("pos"), F.lit(bucket_rows)))
        .withColumn("_place", F.row_number().over(place))
        .withColumn("_opens", (~empty | F.coalesce(F.lag("tokens").over(place) > 0, F.lit(True))).cast("long"))
        .withColumn("_opened", F.sum("_opens").over(place))
    )
    earlier = Window.partitionBy("source").orderBy("_bucket")
    sums = earlier.rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        marked.groupBy("source", "_bucket").agg(
            F.count(F.lit(1)).alias("_rows"), F.sum("_opens").alias("_left"),
            F.min_by("tokens", "pos").alias("_first"), F.max_by("tokens", "pos").alias("_last"))
        .withColumn("_goes_on", F.coalesce(
            (F.col("_first") <= 0) & (F.lag("_last").over(earlier) <= 0), F.lit(False)).cast("long"))
        .select(
            "source", "_bucket", "_goes_on",
            F.coalesce(F.sum(F.col("_left") - F.col("_goes_on")).over(sums), F.lit(0)).alias("_base"),
            F.coalesce(F.sum("_rows").over(sums), F.lit(0)).alias("_before"))
    )
    start = F.col("_bucket") * F.lit(bucket_rows)
    gapless = (F.col("_before") == start) & (F.col("pos") == start + F.col("_place") - 1)
    number = F.col("_base") + F.col("_opened") - F.col("_goes_on") - 1
    numbered = marked.join(buckets, ["source", "_bucket"]).withColumn(
        "_number", F.when(gapless, number).otherwise(F.raise_error(F.lit(_GAPS)).cast("long")))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda row: row["value"])
    stretches = numbered.filter(empty).groupBy("source", "_number").agg(
        F.lit(0).cast("long").alias("tokens"), F.array_join(texts, "\n").alias("value"),
        F.min_by("first", "pos").alias("first"), F.max_by("last", "pos").alias("last"))
    columns = ["source", F.col("_number").alias("pos"), "tokens", "value", "first", "last"]
    return numbered.filter(~empty).select(columns).unionByName(stretches.select(columns))


def pack_rows(
    rows: DataFrame,
    budget: Budget,
    chunk_rows: int | None = None,
    zero_tokens: bool = True,
    whole_source_tokens: int = WHOLE_SOURCE_TOKENS,
    buffer_rows: int = BUFFER_ROWS,
    chunks_per_block: int = CHUNKS_PER_BLOCK,
    bucket_rows: int = EMPTY_BUCKET,
) -> DataFrame:
    """Pack ``rows(source, pos, tokens, value, first, last)`` into runs.

    ``pos`` counts 0, 1, 2, ... within a source.  A run reports ``first`` of its first row and ``last``
    of its last row.  ``zero_tokens=False`` says that every row has a token, which saves a shuffle.
    """
    # Joins match no nulls, but rows without a source are a source too: inside, names carry a mark.
    rows = rows.withColumn("source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    if zero_tokens:
        rows, budget = join_empty_rows(rows, bucket_rows), replace(budget, rows_per_token=2)
    chunk_rows = chunk_rows or max(MIN_CHUNK_ROWS, CHUNK_REACHES * budget.reach)
    if chunk_rows < budget.reach:
        raise ValueError(f"chunk_rows must be at least {budget.reach}")
    home = F.call_function("div", F.col("pos"), F.lit(chunk_rows))
    seen_early = (home > 0) & (F.col("pos") % F.lit(chunk_rows) < F.lit(budget.reach))
    placed = rows.withColumn("chunk", F.explode(
        F.when(seen_early, F.array(home, home - 1)).otherwise(F.array(home))))

    # Only sources of several chunks, or of many tokens, need maps; one row per chunk tells which.
    large = (
        placed.groupBy("source", "chunk").agg(F.max("pos").alias("_end"), F.sum("tokens").alias("_sum"))
        .filter((F.col("chunk") > 0) | (F.col("_end") >= chunk_rows) | (F.col("_sum") > whole_source_tokens))
    )
    spread = placed.select("source", "chunk", "pos", "tokens").join(large, ["source", "chunk"], "left_semi")
    maps = spread.groupBy("source", "chunk").applyInArrow(_chunk_map_function(budget, chunk_rows), _MAP_SCHEMA)
    block = F.call_function("div", F.col("slot"), F.lit(chunks_per_block))
    blocked = maps.withColumn("block", block)
    roots = (
        blocked.groupBy("source", "block").applyInArrow(_compose_block, _MAP_SCHEMA)
        .groupBy("source").applyInArrow(_walk_source, _ROOT_SCHEMA)
        .withColumnRenamed("slot", "block")
    )
    entries = (
        blocked.groupBy("source", "block").cogroup(roots.groupBy("source", "block"))
        .applyInArrow(_walk_block, _ENTRY_SCHEMA)
    )
    markers = entries.select(
        "source", "chunk", F.lit(-1).cast("long").alias("pos"), F.col("entry").alias("tokens"),
        F.lit(None).cast("string").alias("value"), F.col("base").alias("first"), F.col("total").alias("last"))
    columns = ["source", "chunk", "pos", "tokens", "value", "first", "last"]
    return (
        placed.select(columns).unionByName(markers)
        .repartition("source", "chunk")
        .sortWithinPartitions("source", "chunk", "pos")
        .mapInArrow(_stream_function(budget, chunk_rows, buffer_rows), PACKED_SCHEMA)
        .withColumn("source", F.when(F.col("source") != "", F.substr("source", F.lit(2))))
    )
