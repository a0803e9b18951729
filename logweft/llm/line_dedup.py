"""Lines that many documents share are dropped, except in one document each.

A line's key is the line without white space at both ends, A-Z lower-cased.  Keys of at least ``least_chars``
characters that stand in at least ``least_docs`` documents lose all their lines except in the document of the largest
id that holds them.  The other lines stay, in their order.

1. Explode: one pass over the texts gives a row per text and distinct key that is long enough: its 128-bit hash.
2. Count: distinct documents per hash, pre-aggregated by hash and document before anything is shuffled, so a line that
   stands in a third of all documents arrives as one row per task.
3. Drop: hashes over the threshold meet the exploded rows again (a join that is split where a hash is hot).
4. Reassemble: what a text loses is gathered per text, so a group has at most the text's own lines, and the text is
   put together again from the lines that stay, by position.

Defined cases: a null or empty text is one empty line; rows of one id are one document when documents are counted, and
each is reassembled from its own text; rows without an id count as no document and lose their lines of every key over
the threshold; an empty table gives no rows; other columns are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweft.llm.landing import Scratch, landed

#: What is stripped from both ends of a line.
BLANKS = " \t\n\v\f\r"


@dataclass(frozen=True)
class LineConfig:
    least_chars: int = 20
    least_docs: int = 3


def line_keys(lines: list[str], config: LineConfig) -> list[bytes | None]:
    """The 128-bit hash of every line's key; None where it is too short."""
    out = []
    for line in lines:
        key = line.strip(BLANKS)
        # bytes.lower() changes A-Z alone
        out.append(xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= config.least_chars else None)
    return out


def exploded(docs: DataFrame, config: LineConfig) -> DataFrame:
    """``doc_id, text_hash, key`` of every text and distinct key."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                index, keys = [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    found = set(line_keys(text.split("\n"), config)) if text else set()
                    found.discard(None)
                    index += [i] * len(found)
                    keys += found
                at = pa.array(index, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(keys, pa.binary())], ["doc_id", "text_hash", "key"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, key binary")


def shared_keys(lines: DataFrame, config: LineConfig) -> DataFrame:
    """``key, keeper`` of the keys over the threshold."""
    return lines.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper")).where(
        F.col("n") >= config.least_docs).select("key", "keeper")


def dedup_lines(docs: DataFrame, config: LineConfig = LineConfig()) -> DataFrame:
    """``docs`` with ``text`` put together from the lines that stay, and ``n_lines`` and ``n_dropped``.

    Columns of ``docs`` that are called like these two are replaced.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    lines = scratch.land(exploded(docs, config), "lines")
    shared = scratch.land(shared_keys(lines, config), "shared")
    lost = lines.join(shared, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).groupBy("doc_id", "text_hash").agg(
        F.collect_set("key").alias("keys"))
    lost = landed(lost.select(F.struct("doc_id", "text_hash").alias("whose"), "keys"), "line-dedup-lost")
    scratch.drop()

    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    # Everything of the given table in one struct, so that no name can clash.
    rows = docs.select(F.struct(*others).alias("row"), "text", F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("of"))
    met = rows.join(lost, F.col("of").eqNullSafe(F.col("whose")), "left").select("row", "text", "keys")

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts, n_lines, n_dropped = [], [], []
                for text, keys in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    if keys:
                        split, gone = text.split("\n"), set(keys)
                        kept = [line for line, key in zip(split, line_keys(split, config), strict=True) if key not in gone]
                        texts.append("\n".join(kept))
                        n_lines.append(len(split))
                        n_dropped.append(len(split) - len(kept))
                    else:
                        texts.append(text or "")
                        n_lines.append((text or "").count("\n") + 1)
                        n_dropped.append(0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                    ["row", "text", "n_lines", "n_dropped"])

    kind = rows.schema["row"].dataType.simpleString()
    return met.mapInArrow(run, f"row {kind}, text string, n_lines long, n_dropped long").select("row.*", "text", "n_lines", "n_dropped")
