"""Mixing sources to target weights (operator 5), DataFrame functions only.

A source's documents are packed, one after another, into blocks of ``block`` words. The mix is a
sequence of slots, ``shard_slots`` to an output shard, and each slot holds one block:

* targets: the sizes of all sources together, shared out by weight; a target stops at ``repeat``
  times its source's size and the excess is shared again by weight (solved at once: in the order of
  cap / weight the capped sources come first);
* a source fills ``target`` words' worth of slots; a pseudorandom permutation of the slot numbers deals
  them over the output shards and so draws each shard's source counts (:func:`shard_counts`):
  multinomial given the totals, so the totals meet the targets to within one block (free
  draws would miss small sources' targets by their standard deviation);
* in a shard, a source's slots are its next ones after those of the shards before (a running sum of its
  counts). Its i-th slot takes block ``permutation(i mod blocks)``, another permutation in each round
  through its blocks, so no block is taken more than ``repeat`` times;
* slots join blocks on (source, block index).

Permutations are swap-or-not networks: exact on any range, computed per row, nothing is sorted.

Scale: word counts are made once and stored without the texts; a source's running offsets are sums in
``PACKS`` hash packs plus sums over packs, so a hot source spreads over as many tasks; slots are
numbered in runs of ``RUN`` and spread before they are listed; running sums over shards are sums in spans of
``SPAN`` shards plus sums over spans. Only one row per source, never per document, meets in one task.

Defined cases: null text has no words and is taken 0 times; a null source is a source (last in order);
null ids and repeated rows count as rows of their own; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import digest, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
REPEAT = 3
BLOCK = 128
SHARD_SLOTS = 64
PACKS = 1024
RUN = 4096
SPAN = 4096
ROUNDS = 24
SEED = 20


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """Pseudorandom permutation of [0, ``size``) keyed by ``key``: swap-or-not, ``ROUNDS`` rounds."""

    def step(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), r, *key), size) - x, size)
        swap = F.xxhash64(F.lit(SEED + 1), r, F.greatest(x, mirror), *key) % 2 == 0
        return F.when(swap, mirror).otherwise(x)

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, index.cast("long"), step)


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeat: int = REPEAT) -> DataFrame:
    """One row per source of ``sized`` (source, size): sid (rank by code point, null last), source,
    source_size, weight, target."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    rank = F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    order = everything.orderBy("cap_ratio", "sid")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    ranked = (
        by_source.withColumn("sid", rank.cast("long"))
        .withColumn("weight", weight)
        .withColumn("cap", repeat * F.col("source_size"))
        .withColumn("cap_ratio", F.col("cap") / F.col("weight"))
        .withColumn(
            "level",
            (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
            / F.sum("weight").over(after),
        )
        .withColumn("capped", F.col("cap_ratio") < F.col("level"))
    )
    level = F.min_by(F.when(~F.col("capped"), F.col("level")), F.when(~F.col("capped"), F.struct("cap_ratio", "sid")))
    return ranked.select(
        "sid",
        "source",
        "source_size",
        "weight",
        F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise(level.over(everything) * F.col("weight"))
        .alias("target"),
    )


def quotas(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``targets`` with blocks (of the source), slots (it fills) and first (its first slot number)."""
    fill = F.coalesce(F.round(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size"))), F.lit(0))
    return (
        targets.withColumn("blocks", F.ceil(F.col("source_size") / block))
        .withColumn("slots", fill.cast("long"))
        .withColumn(
            "first", F.sum("slots").over(Window.partitionBy().orderBy("sid")) - F.col("slots")
        )
        .withColumn("all_slots", F.sum("slots").over(Window.partitionBy()))
    )


def shard_counts(quota: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The draw: shard, sid, blocks, n (slots of the shard that the source fills) and ahead (slots it fills in
    the shards before). Staged: a row per shard and source in it."""
    runs = quota.where("slots > 0").select(
        "sid", "blocks", "slots", "first", "all_slots",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / RUN))).alias("run"),
    )
    low = F.col("run") * RUN
    i = F.explode(F.sequence(low, F.least(low + RUN, F.col("slots")) - 1)).alias("i")
    listed = _dealt(runs, "sid", "run").select("sid", "blocks", "first", "all_slots", i)
    place = permuted(F.col("first") + F.col("i"), F.col("all_slots"))
    drawn = materialize(
        listed.groupBy("sid", "blocks", F.floor(place / shard_slots).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    ).withColumn("span", F.floor(F.col("shard") / SPAN))
    sums = drawn.groupBy(F.col("sid").alias("b_sid"), F.col("span").alias("b_span")).agg(F.sum("n").alias("total"))
    before = F.sum("total").over(Window.partitionBy("b_sid").orderBy("b_span")) - F.col("total")
    in_span = F.sum("n").over(Window.partitionBy("sid", "span").orderBy("shard")) - F.col("n")
    return (
        drawn.withColumn("in_span", in_span)
        .join(sums.withColumn("before", before), (F.col("sid") == F.col("b_sid")) & (F.col("span") == F.col("b_span")))
        .select("shard", "sid", "blocks", "n", (F.col("before") + F.col("in_span")).alias("ahead"))
    )


def slots(quota: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix: shard, slot, sid, round, block."""
    counts = shard_counts(quota, shard_slots)
    lower = F.sum("n").over(Window.partitionBy("shard").orderBy("sid")) - F.col("n")
    j = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j")
    held = counts.withColumn("lower", lower).withColumn("held", F.sum("n").over(Window.partitionBy("shard")))
    listed = (
        _dealt(held, "sid", "shard")
        .select("shard", "sid", "blocks", "ahead", "lower", "held", j)
        .withColumn("i", F.col("ahead") + F.col("j"))
        .withColumn("round", F.floor(F.col("i") / F.col("blocks")))
    )
    return listed.select(
        "shard",
        permuted(F.col("lower") + F.col("j"), F.col("held"), F.col("shard")).alias("slot"),
        "sid",
        "round",
        permuted(F.col("i") % F.col("blocks"), F.col("blocks"), F.col("sid"), F.col("round")).alias("block"),
    )


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Few ``rows`` that list many: a count of its own, as they would be merged into one task before."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def packed(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``sized`` rows with words, plus sid and start (first word in the source's stream; unique there)."""
    ids = targets.select("sid", F.col("source").alias("s_source"))
    rows = (
        sized.where("size > 0")
        .join(ids, F.col("source").eqNullSafe(F.col("s_source")))
        .drop("s_source")
        .withColumn("pack", F.pmod(F.xxhash64("doc_id", "size"), F.lit(PACKS)))
    )
    others = [c for c in sized.columns if c not in ("doc_id", "source", "size")]
    in_pack = (
        Window.partitionBy("sid", "pack").orderBy("doc_id", "size", *others).rowsBetween(Window.unboundedPreceding, 0)
    )
    sums = rows.groupBy("sid", "pack").agg(F.sum("size").alias("pack_size"))
    bases = sums.select(
        F.col("sid").alias("b_sid"),
        F.col("pack").alias("b_pack"),
        (F.sum("pack_size").over(Window.partitionBy("sid").orderBy("pack")) - F.col("pack_size")).alias("base"),
    )
    return (
        rows.withColumn("ahead", F.sum("size").over(in_pack) - F.col("size"))
        .join(bases, (F.col("sid") == F.col("b_sid")) & (F.col("pack") == F.col("b_pack")))
        .withColumn("start", F.col("base") + F.col("ahead"))
        .drop("pack", "ahead", "base", "b_sid", "b_pack")
    )


def block_members(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per (document, block it reaches into): block, words of the document in it."""
    end = F.col("start") + F.col("size")
    return placed.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block)))
    ).withColumn(
        "words", F.least(end, (F.col("block") + 1) * block) - F.greatest(F.col("start"), F.col("block") * block)
    )


def mix(sized: DataFrame, targets: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """What each slot of the mix holds: shard, slot, round, block, and the documents' words in it
    (``sized`` columns, sid, start, words)."""
    held = slots(quotas(targets, block), shard_slots).withColumnsRenamed({"sid": "m_sid", "block": "m_block"})
    members = block_members(packed(sized, targets), block)
    # the planner sees only the few source rows that slots are listed from, and would broadcast them all
    return held.hint("merge").join(members, (F.col("sid") == F.col("m_sid")) & (F.col("block") == F.col("m_block"))).drop(
        "m_sid", "m_block"
    )


def words_taken(docs: DataFrame, *extra: Column, block: int = BLOCK) -> DataFrame:
    """A row per row of ``docs`` (doc_id, source, text): doc_id, source, size, ``extra`` columns,
    source_size, target, taken (words of it that the mix takes, repeats counted), first_shard (the smallest
    output shard that holds words of it, else null)."""
    names = [c for c in docs.select(*extra).columns] if extra else []
    sized = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *extra))
    targets = materialize(source_targets(sized))
    uses = (
        slots(quotas(targets, block))
        .groupBy(F.col("sid").alias("u_sid"), F.col("block").alias("u_block"))
        .agg(F.count(F.lit(1)).alias("count"), F.min("shard").alias("u_shard"))
    )
    members = block_members(packed(sized, targets), block)
    carried = ["doc_id", "source", "size", *names]
    taken = (
        members.join(uses.hint("merge"), (F.col("sid") == F.col("u_sid")) & (F.col("block") == F.col("u_block")), "left")
        .groupBy("sid", "start", *carried)
        .agg(
            F.sum(F.coalesce("count", F.lit(0)) * F.col("words")).alias("taken"), F.min("u_shard").alias("first_shard")
        )
        .select(*carried, "taken", "first_shard")
    )
    rest = sized.where("size = 0").select(
        *carried, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_shard")
    )
    about = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    return (
        taken.unionByName(rest)
        .join(about, F.col("source").eqNullSafe(F.col("t_source")), "left")
        .select(*carried, "source_size", "target", "taken", "first_shard")
    )


def resample(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them, columns unchanged: a row is repeated taken / size times, the
    fraction rounded up or down by a hash of its id so that sources keep their share."""
    identity = digest(F.col("text")).alias("tk")
    taken = words_taken(docs.select("doc_id", "source", "text"), identity)
    one = (
        taken.where("size > 0")
        .groupBy(F.col("doc_id").alias("t_id"), F.col("source").alias("t_source"), F.col("tk").alias("t_tk"))
        .agg((F.sum("taken") / F.sum("size")).alias("times"))
        .withColumn("draw", F.pmod(F.xxhash64(F.lit(SEED), "t_id", "t_tk"), F.lit(1 << 20)) / float(1 << 20))
        .withColumn(
            "copies",
            (F.floor("times") + (F.col("draw") < F.col("times") - F.floor("times")).cast("int")).cast("int"),
        )
        .where("copies > 0")
    )
    rows = docs.select(
        digest(docs["text"]).alias("tk"),
        docs["doc_id"].alias("id"),
        docs["source"].alias("origin"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
    )
    same = (
        (F.col("tk") == F.col("t_tk"))
        & F.col("id").eqNullSafe(F.col("t_id"))
        & F.col("origin").eqNullSafe(F.col("t_source"))
    )
    return (
        rows.join(one, same)
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(*[F.col("row")[c].alias(c) for c in docs.columns])
    )
