"""Sharding by a permutation-filled lookup table.

Each shard has its own preference order over the slots of a prime-sized table; shards take turns and claim their next free
slot until the table is full. A row's slot is a hash of its key modulo the table size; the table is a broadcast of fixed
size, so placement is one lookup. Adding or removing a shard moves few slots beyond the shard's own share.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS, SLOTS = 32, 4099


def _prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """The shard's index in ``names`` for each slot; depends only on the names and the size."""
    if not _prime(slots):
        raise ValueError("the number of slots must be prime")
    if not 0 < len(set(names)) == len(names) <= slots:
        raise ValueError("shard names must be distinct, at least one and at most as many as slots")
    digest = [hashlib.md5(n.encode()).digest() for n in names]
    offset = [int.from_bytes(d[:8], "big") % slots for d in digest]
    skip = [int.from_bytes(d[8:], "big") % (slots - 1) + 1 for d in digest]
    at, table, left = [0] * len(names), [-1] * slots, slots
    while left:
        for k in range(len(names)):
            while table[slot := (offset[k] + at[k] * skip[k]) % slots] >= 0:
                at[k] += 1
            table[slot] = k
            at[k] += 1
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, slots: int) -> Column:
    """The first 60 bits of the key's MD5 modulo the table size; a null key counts as an empty string."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long") % slots).cast("int")


def assign_shards(df: DataFrame, key_col: str = "doc_id", names: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """All rows and columns of ``df`` plus ``slot`` and ``shard`` (the name).

    Rows with equal keys share a shard, null keys that of the empty string; an empty table gives an empty result. Columns
    named ``slot`` or ``shard`` are replaced unless they are the key. No shuffle: the table of ``slots`` rows is broadcast.
    """
    names = names or [f"shard-{k:04d}" for k in range(SHARDS)]
    filled = F.split(F.lit(",".join(map(str, lookup_table(names, slots)))), ",")
    table = df.sparkSession.range(1).select(F.posexplode(filled).alias("__slot", "__k"))
    table = table.select("__slot", F.get(F.array(*[F.lit(n) for n in names]), F.col("__k").cast("int")).alias("__shard"))
    placed = df.withColumn("__at", slot_of(F.col(key_col), slots)).join(F.broadcast(table), F.col("__at") == F.col("__slot"))
    keep = [c for c in df.columns if c == key_col or c not in ("slot", "shard")]
    return placed.select(*keep, F.col("__slot").alias("slot"), F.col("__shard").alias("shard"))


def write_shards(df: DataFrame, path: str, key_col: str = "doc_id", names: list[str] | None = None, slots: int = SLOTS, files: int = 0) -> None:
    """Write ``df`` as Parquet partitioned by shard. With ``files``, rows are first dealt by (shard, slot) into so many tasks."""
    out = assign_shards(df, key_col, names, slots)
    (out.repartition(files, "shard", "slot") if files else out).write.partitionBy("shard").parquet(path)
