"""Sharding by a permutation-filled lookup table.

The table has a prime number of slots.  Every shard has its own order of preference over all slots, an offset and a
step derived from its name; shards take turns, and at each turn a shard claims the first slot of its order that is
still free, until none is.  So shards hold equal numbers of slots, to one, and when a shard is added or removed few
slots of the others change hands.  A row's slot is its key's hash modulo the size; the table, whose size is the
stated prime and not the data's, is broadcast, and placing a row is one lookup.

The table is a plan constant: its fill takes turns and is computed once, from the configuration alone.  Rows never
leave the JVM and are not shuffled.

Defined cases: a null key counts as the empty text; equal keys share a shard; the text is not looked at; an empty
table gives no rows; columns called like the added ones are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ShardConfig:
    """``slots``: a prime, at least a hundred times the number of shards for an even spread."""

    shards: tuple[str, ...] = tuple(f"shard-{i:03d}" for i in range(32))
    slots: int = 4099

    def __post_init__(self):
        if self.slots < 2 or any(self.slots % d == 0 for d in range(2, int(self.slots ** 0.5) + 1)):
            raise ValueError("slots must be prime")
        if not 0 < len(set(self.shards)) == len(self.shards) <= self.slots:
            raise ValueError("shards must be distinct, and not more than slots")


def _number(text: str) -> int:
    """The first 60 bits of the text's MD5."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(config: ShardConfig) -> list[int]:
    """For every slot the index of the shard that claimed it."""
    size = config.slots
    places = [_number(f"{s}/offset") % size for s in config.shards]
    steps = [_number(f"{s}/step") % (size - 1) + 1 for s in config.shards]
    owner, free = [-1] * size, size
    while free:
        for shard, step in enumerate(steps):
            if not free:
                break
            while owner[places[shard]] >= 0:
                places[shard] = (places[shard] + step) % size
            owner[places[shard]] = shard
            free -= 1
    return owner


def slot_of(key: Column, slots: int) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text, modulo the number of slots."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots


def lookup_table(spark, config: ShardConfig) -> DataFrame:
    """``slot, shard, shard_name``: ``config.slots`` rows."""
    owners = F.split(F.lit(",".join(map(str, fill_table(config)))), ",")
    names = F.array(*[F.lit(s) for s in config.shards])
    return (
        spark.range(1).select(F.posexplode(owners).alias("slot", "shard"))
        .select(F.col("slot").cast("long"), F.col("shard").cast("int"), F.element_at(names, F.col("shard").cast("int") + 1).alias("shard_name")))


def assign_shards(rows: DataFrame, key: str, config: ShardConfig = ShardConfig()) -> DataFrame:
    """All columns of ``rows`` with ``slot``, ``shard`` and ``shard_name``."""
    kept = [c for c in rows.columns if c not in ("slot", "shard", "shard_name")]
    table = F.broadcast(lookup_table(rows.sparkSession, config))
    return rows.withColumn("slot", slot_of(F.col(key), config.slots)).select(*kept, "slot").join(table, "slot").select(
        *kept, "slot", "shard", "shard_name")


def write_shards(rows: DataFrame, key: str, path: str, config: ShardConfig = ShardConfig(), files_per_shard: int = 1) -> None:
    """One folder of Parquet files per shard; ``files_per_shard`` tasks write each, so that none takes a whole shard."""
    placed = assign_shards(rows, key, config)
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns]), F.lit(files_per_shard))
    (placed.withColumn("_file", salt).repartition(len(config.shards) * files_per_shard, "shard_name", "_file")
     .drop("_file").write.partitionBy("shard_name").parquet(path))
