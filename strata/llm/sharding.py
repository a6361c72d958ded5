"""Sharding on a consistent-hash ring with virtual nodes and bounded loads (operator 10).

Shards own ``virtual`` points each on a ring of ``CELLS`` cells; a key belongs to the next point
clockwise from its cell. A shard takes at most ``(1 + slack)`` times the mean bytes (plus one row);
keys that overflow a full shard go on clockwise to the next point whose shard has room. So balance is
guaranteed, and a changed shard set moves only the keys of the arcs that change hands plus the
overflow. Law: ``bytes``.

Scale: rows are reduced to one byte sum per cell before anything meets: the ring walk sees ``CELLS``
numbers, whatever the data's size, and returns which run of a cell's bytes each shard takes. A row
finds its place by a running sum inside its cell, its slot by its rank in the cell plus the shard's rows in
the cells before. Running sums have two levels, inside a salt of id, size and CRC and over the salts of a
cell, and equal rows meet as counts per task that read them: a repeated key or text fills no task.
Texts are not shuffled.

Defined cases: the key is doc_id, or the text where the id is null; null text has size 1 and the CRC of
no bytes; rows that are equal in id, size and CRC are interchangeable; an empty table gives an empty
result.
"""

from __future__ import annotations

from bisect import bisect_left

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SHARDS = 16
VIRTUAL = 128
SLACK = 0.001
CELLS = 1 << 14
SALTS = 64


def ring(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    return sorted(
        (xxhash.xxh3_64_intdigest(f"{s}/{v}".encode()) % CELLS, s) for s in range(shards) for v in range(virtual)
    )


def walk(loads: dict[int, int], shards: int, virtual: int = VIRTUAL, slack: float = SLACK) -> list[tuple]:
    """(cell, from_byte, to_byte, shard) runs for the cells' byte sums, shards filled up to the bound."""
    points = ring(shards, virtual)
    places = [p for p, _ in points]
    bound = -(-sum(loads.values()) // shards)
    room = [int(bound * (1 + slack)) + 1] * shards
    runs = []
    for cell in sorted(loads):
        left, at, i = loads[cell], 0, bisect_left(places, cell)
        while left > 0:
            shard = points[i % len(points)][1]
            part = min(left, room[shard])
            if part:
                runs.append((cell, at, at + part, shard))
                room[shard] -= part
                at, left = at + part, left - part
            i += 1
    return runs


def assign(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL, slack: float = SLACK) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, shard, slot (gapless from 0)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text"))
    rows = materialize(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            key.alias("key"),
            F.pmod(key, F.lit(CELLS)).cast("int").alias("cell"),
            F.spark_partition_id().alias("task"),
        )
    )
    loads = {r["cell"]: r["load"] for r in rows.groupBy("cell").agg(F.sum("size").alias("load")).collect()}
    runs = spark.createDataFrame(walk(loads, shards, virtual, slack), "r_cell int, low long, high long, shard int")
    by_cell = runs.groupBy("r_cell").agg(F.collect_list(F.struct("low", "high", "shard")).alias("runs"))
    same = ("cell", "salt", "key", "doc_id", "size", "text_crc32", "task")
    copies = (
        rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(SALTS)).cast("int"))
        .groupBy(*same)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("load", F.col("n") * F.col("size"))
    )
    sums = copies.groupBy("cell", "salt").agg(F.sum("load").alias("s_load"), F.sum("n").alias("s_n"))
    before = Window.partitionBy("cell").orderBy("salt")
    salts = sums.select(
        F.col("cell").alias("s_cell"),
        F.col("salt").alias("s_salt"),
        (F.sum("s_load").over(before) - F.col("s_load")).alias("s_load"),
        (F.sum("s_n").over(before) - F.col("s_n")).alias("s_n"),
    )
    ahead = Window.partitionBy("cell", "salt").orderBy(*same[2:]).rowsBetween(Window.unboundedPreceding, 0)
    starts = materialize(
        copies.withColumn("load_ahead", F.sum("load").over(ahead) - F.col("load"))
        .withColumn("n_ahead", F.sum("n").over(ahead) - F.col("n"))
        .join(salts, (F.col("cell") == F.col("s_cell")) & (F.col("salt") == F.col("s_salt")))
        .select(*same, "n", (F.col("s_load") + F.col("load_ahead")).alias("start"), (F.col("s_n") + F.col("n_ahead")).alias("place"))
        .repartition(*same)  # copies of one row, so far in one task, spread before they are rows again
    )
    # place: the row's number in its cell
    placed = (
        starts.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
        .withColumn("place", F.col("place") + F.col("copy"))
        .join(F.broadcast(by_cell), F.col("cell") == F.col("r_cell"))  # at most CELLS rows
        .select(
            "doc_id", "size", "text_crc32", "cell", "place",
            F.filter("runs", lambda r: (r["low"] <= F.col("start")) & (F.col("start") < r["high"]))[0]["shard"].alias("shard"),
        )
    )
    # a shard takes one run of a cell's bytes, so its rows there have consecutive places
    counts = placed.groupBy("cell", "shard").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    bases = counts.select(
        F.col("cell").alias("b_cell"),
        F.col("shard").alias("b_shard"),
        (F.sum("n").over(Window.partitionBy("shard").orderBy("cell")) - F.col("n") - F.col("first")).alias("base"),
    )
    return placed.join(
        F.broadcast(bases), (F.col("cell") == F.col("b_cell")) & (F.col("shard") == F.col("b_shard"))  # one or two a cell
    ).select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("place")).alias("slot"))
