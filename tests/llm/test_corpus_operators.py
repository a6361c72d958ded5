"""Corpus operators against brute force on small tables: nulls, empty and long texts, ties, repeated
rows, empty tables, extra columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from re import _constants, _parser

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import (
    decontaminate,
    html_main_text,
    licenses,
    mixing,
    near_dup,
    quality,
    sharding,
    suffix_dedup,
    token_scan,
    warc_zip,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string"


def words(rng, n, size=60):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = [words(rng, rng.randrange(1, 160), 400) for _ in range(40)]
    out = []
    for i, text in enumerate(base):
        out.append((i, text))
    for i in range(40, 60):  # near copies
        w = base[i % 5].split()
        w[rng.randrange(len(w))] = f"x{i}"
        out.append((i, " ".join(w)))
    out += [(60 + i, base[7]) for i in range(12)]  # copies
    out += [(80, None), (81, ""), (82, " \n\t "), (83, "é " * 30), (84, words(rng, 30_000)), (None, base[3]), (None, None)]
    out += [(85, base[9]), (85, base[9]), (0, base[11])]  # repeated rows and a repeated id
    return [(d, t, ("en", "de", None)[k % 3], ("a", "b", "b", None)[k % 4], 1, "x", "y") for k, (d, t) in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# ---------------------------------------------------------------- 6 quality rules


def test_text_counts():
    text = "a b c a b c # #\nx y\n\nx y\n x y\nx y"
    got = dict(zip(quality.FIELDS, quality.text_counts(text.encode())))
    # lines equal to an earlier one: "x y" twice more; words in repeated windows: "a b c", "b c a" once
    assert got["n_words"] == 16 and got["n_dup_lines"] == 2 and got["n_symbols"] == 2
    w = text.split()
    windows = Counter(zip(w, w[1:], w[2:]))
    marked = {j for i, t in enumerate(zip(w, w[1:], w[2:])) if windows[t] > 1 for j in range(i, i + 3)}
    assert got["n_repeat_words"] == len(marked)
    assert quality.text_counts(b"") == (0,) * 7


def test_binomial_bound_is_exact():
    for n, p in ((30, 0.1), (400, 0.01), (5000, 0.02)):
        for k in range(0, int(n * p)):
            exact = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
            assert quality.binomial_cdf(k, n, p) == pytest.approx(exact, rel=1e-9)


def test_risk_controlled_cutoffs(spark):
    rng = random.Random(1)
    good = [(i, words(rng, 80, 5000), "en", 1) for i in range(3000)]
    bad = [(5000 + i, " ".join(f"{w}###" for w in words(rng, 80, 5000).split()), "en", 0) for i in range(300)]
    rare = [(9000 + i, words(rng, 80, 5000) + " ###", "xx", 1) for i in range(5)]  # too few labels to prove a cutoff
    df = spark.createDataFrame(good + bad + rare, "doc_id long, text string, lang string, quality int")
    labels = df.select("doc_id", "quality").union(spark.createDataFrame([(None, 1), (77777, 0), (1, None)], "a long, b int"))
    got = quality.assess(df.select("doc_id", "lang", "text"), labels).collect()
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert len(got) == 3305 and not any(kept[d] for d, *_ in bad)
    assert sum(not kept[d] for d, *_ in good) <= 0.05 * len(good) and all(kept[d] for d, *_ in rare)
    assert all("symbols" in r["fired"] for r in got if r["doc_id"] in {d for d, *_ in bad})


def test_quality_edges(spark, docs, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    expect = Counter()
    for r in docs.collect():
        c = quality.text_counts((r["text"] or "").encode())
        expect[r] += not (c[0] < 50 or 100 * c[4] > 50 * c[0])
    assert Counter(kept.collect()) == +expect
    assert quality.assess(none, labels).count() == 0


# ---------------------------------------------------------------- 3 near duplicates


def brute_classes(pairs):
    """(class, copies, links) by row number, from all pairs of shingle sets."""
    sets = [frozenset(near_dup.shingles((t or "").encode()).tolist()) for _, t in pairs]
    n = len(pairs)
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * n
    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = (pairs[i][1] or "") == (pairs[j][1] or "")
            if same or (a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9):
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    classes = defaultdict(list)
    for i in range(n):
        classes[find(i)].append(pairs[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in classes.items()}
    texts = Counter(t or "" for _, t in pairs)
    rows = Counter((d, least[find(i)], texts[t or ""], links[i]) for i, (d, t) in enumerate(pairs))
    return rows, len(classes)


def test_near_duplicates_equal_all_pairs(docs, none, monkeypatch):
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = near_dup.join_near(docs)
    expect, n_classes = brute_classes(pairs)
    assert Counter(tuple(r) for r in got.collect()) == expect
    assert near_dup.join_near(none).count() == 0 and near_dup.keep_one(none).columns == none.columns
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == n_classes


def test_blocks_count_each_pair_once():
    rng = random.Random(5)
    base = words(rng, 60, 500).split()
    rows = []
    for i in range(40):
        w = list(base)
        w[i] = f"y{i}"
        rows.append({"tk": bytes([i]), "copies": 1 + i % 3, "text": " ".join(w), "nodes": [5, 9], "chunk": i % 2})
    whole = defaultdict(int)
    for left, right in ((0, 0), (0, 1), (1, 1)):
        part = [r for r in rows if r["chunk"] in (left, right)]
        for tk, n, _ in near_dup._block((5, left, right), part, 0.8):
            whole[tk] += n
        assert near_dup._block((9, left, right), part, 0.8) == []  # counted in node 5
    sets = [set(near_dup.shingles(r["text"].encode()).tolist()) for r in rows]
    for i, r in enumerate(rows):
        expect = sum(
            rows[j]["copies"] for j in range(40) if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9
        )
        assert whole.get(r["tk"], 0) == expect


def test_every_length_keeps_the_recall():
    trees = near_dup.forest(0.8)
    assert sum((1 - 0.8**d) ** n for d, n in trees.items()) <= 1 - near_dup.RECALL + 1e-12
    assert all((1 - 0.8**d) ** (n - 1) > (1 - near_dup.RECALL) / len(trees) for d, n in trees.items())  # none too many
    assert near_dup.forest(1.0) == {2: 1, 3: 1, 4: 1}
    with pytest.raises(ValueError):
        near_dup.forest(0.3)


def test_texts_stop_at_different_prefixes(spark):
    """Brute force: tries built in Python, every text at the length with the fewest candidates."""
    trees = {1: 2, 2: 3}
    rng = random.Random(6)
    sigs = {i: [rng.randrange(4) for _ in range(6)] for i in range(40)}  # alike by chance
    for i in range(40, 60):  # true copies far from the others
        sigs[i] = [100 + i // 2] * 6
    made = [(bytes([i]), 5, np.array(v, ">u4").tobytes()) for i, v in sigs.items()] + [(b"none", 0, b"")]
    got = near_dup.matched_nodes(spark.createDataFrame(made, "tk binary, n long, sig binary"), trees).collect()
    tries = defaultdict(set)
    for i, v in sigs.items():
        for d in trees:
            for t in range(trees[d]):
                tries[d, t, tuple(v[2 * t : 2 * t + d])].add(i)
    stop = {}
    for i in sigs:
        load = {d: sum(len(m) - 1 for k, m in tries.items() if k[0] == d and i in m) for d in trees}
        stop[i] = min((load[d] * near_dup.WORTH ** (d - 1), d) for d in trees)[1]
    assert set(stop.values()) == {1, 2} and all(stop[i] == 1 for i in range(40, 60))
    expect = [m for k, m in tries.items() if len(m) > 1 and any(stop[i] == k[0] for i in m)]
    found = defaultdict(set)
    for r in got:
        found[r["node"]].add(r["tk"][0])
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expect))


# ---------------------------------------------------------------- 1 decontamination


def test_tiles_are_greedy_and_disjoint():
    item = list(range(1, 31))
    text = [*item[20:30], 0, *item[:12], 0, *item[12:20]]
    tiles = decontaminate.tile(item, text, 5)
    assert sum(t[2] for t in tiles) == 30 and sorted(t[2] for t in tiles) == [8, 10, 12]
    assert decontaminate.tile([1] * 12, [1] * 7, 5) == [(0, 0, 7)] or sum(
        t[2] for t in decontaminate.tile([1] * 12, [1] * 7, 5)
    ) == 7
    assert decontaminate.tile(item, item[:4], 5) == []


def test_tiling_of_a_repetitive_text():
    item = "the cat sat on the mat the cat sat on the mat by the sea"
    block = decontaminate._Block([(1, item)])
    (found,) = block.matches(b"the cat sat on the mat " * 5000)
    assert found["covered"] == 12 and [t[0::2] for t in found["tiles"]] == [[0, 12]]


def greedy_tiles(item, text, least):
    """Tiles by trying all pairs of places, again for every tile."""
    free_item, free_text, tiles = [t != 0 for t in item], [t != 0 for t in text], []
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for q in range(len(text)):
                n = 0
                while p + n < len(item) and q + n < len(text) and item[p + n] == text[q + n] and free_item[p + n] and free_text[q + n]:
                    n += 1
                best = max(best, (n, p, q))
        n, p, q = best
        if n < least:
            return tiles
        free_item[p : p + n] = free_text[q : q + n] = [False] * n
        tiles.append((p, q, n))


def test_tiles_equal_brute_force():
    rng = random.Random(21)
    for _ in range(600):
        letters, least = rng.choice([1, 2, 3, 6]), rng.choice([1, 2, 3, 5])
        item = [rng.randint(1, letters) for _ in range(rng.randint(least, 25))]
        text = [rng.randint(0, letters) for _ in range(rng.randint(0, 40))]
        assert decontaminate.tile(item, text, least) == greedy_tiles(item, text, least)


def test_tiling_work_follows_the_maximal_matches(monkeypatch):
    compared = []
    common = decontaminate._common
    monkeypatch.setattr(decontaminate, "_common", lambda *a: compared.append(1) or common(*a))
    assert decontaminate.tile([1] * 1000, [1] * 20_000, 5) == [(0, 19_000, 1000)]
    assert len(compared) < 3 * 21_000  # of 20 million pairs of equal places


def test_decontamination_catches_reordered_passages(spark, none, monkeypatch):
    rng = random.Random(2)
    items = [words(rng, 24, 3000) for _ in range(6)] + ["only three words", "", None]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(0, items[0])], "item_id long, text string")
    w = items[1].split()
    texts = [
        (1, f"{words(rng, 40, 3000)} {items[0].upper()} {words(rng, 40, 3000)}"),
        (2, " ".join(w[16:] + ["and"] + w[8:16] + ["then"] + w[:8])),
        (3, " ".join(items[2].split()[:9])),
        (4, words(rng, 300, 3000)),
        (5, "here are ONLY three, words."),
        (6, None),
        (7, ""),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for chars in (decontaminate.BLOCK_CHARS, 200):  # one block of items, and several
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", chars)
        got = {r["doc_id"]: r for r in decontaminate.scan(df, bench).collect()}
        assert {d for d, r in got.items() if r["contaminated"]} == {1, 2, 5}
        assert {m["item_id"] for m in got[2]["leaks"]} == {1} and got[2]["coverage"] == 1.0
        assert sorted(len(m["tiles"]) for m in got[2]["leaks"]) == [3]
        assert 0.3 < got[3]["coverage"] < 0.5
    clean = decontaminate.keep_clean(df.withColumn("m", F.lit(1)), bench)
    assert clean.columns == ["doc_id", "text", "m"] and {r["doc_id"] for r in clean.collect()} == {3, 4, 6, 7}
    assert decontaminate.scan(none, bench).count() == 0
    assert decontaminate.keep_clean(df, bench.limit(0)).count() == len(texts)


# ---------------------------------------------------------------- 5 mixing


def test_permutation_is_exact(spark):
    for n in (1, 2, 3, 10, 257):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(9)).alias("p")).collect()
        assert sorted(r["p"] for r in got) == list(range(n))


def water_fill(sizes, weights, repeat):
    left, free, target = float(sum(sizes.values())), set(sizes), {}
    while free:
        each = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / each > repeat * sizes[s]]
        if not over:
            return target | {s: left * weights[s] / each for s in free}
        for s in over:
            target[s] = float(repeat * sizes[s])
            left -= target[s]
            free.discard(s)
    return target


def test_mix_meets_targets(spark, docs, none):
    rng = random.Random(8)
    made = [(i, rng.choice(["a"] * 30 + ["b", "c", "d", None]), words(rng, rng.randrange(0, 400))) for i in range(600)]
    made += [(1000, "tiny", "one two"), (1001, "zero", ""), (1002, "zero", None)]
    df = spark.createDataFrame(made, "doc_id long, source string, text string")
    got = mixing.words_taken(df).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.words_taken(df.repartition(3)).collect()))
    sizes = Counter()
    for _, s, t in made:
        sizes[s] += len((t or "").split())
    order = [*sorted(s for s in sizes if s is not None), None]
    target = water_fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    taken = Counter()
    source = {i: s for i, s, _ in made}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s]) and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert len(got) == len(made)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(2 * mixing.BLOCK, 0.02 * target[s])
    again = mixing.resample(docs)
    assert again.columns == docs.columns and again.count() > 0
    assert mixing.words_taken(none).count() == 0 and mixing.resample(none).count() == 0


def test_mix_holds_whole_blocks(spark):
    sized = spark.createDataFrame([(i, "ab"[i % 2], 50 + i) for i in range(200)], "doc_id long, source string, size long")
    targets = mixing.source_targets(sized)
    held = mixing.mix(sized, targets).groupBy("shard", "slot").agg(F.sum("words").alias("w"), F.countDistinct("sid")).collect()
    assert {r[3] for r in held} == {1} and max(r["w"] for r in held) == mixing.BLOCK
    assert sum(r["w"] < mixing.BLOCK for r in held) <= 6  # only a source's last block is short


def test_taken_words_come_from_the_shard_draw(spark, monkeypatch):
    """Brute force: block uses replayed from the staged shard counts, in pure Python, give words and shards."""
    monkeypatch.setattr(mixing, "SPAN", 3)
    rng = random.Random(4)
    made = [(i, rng.choice("aaaab"), words(rng, rng.randrange(0, 300))) for i in range(300)] + [(900, "c", None)]
    df = spark.createDataFrame(made, "doc_id long, source string, text string")
    sized = df.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    targets = mixing.source_targets(sized)
    quota = mixing.quotas(targets)
    counts = mixing.shard_counts(quota, 8).collect()
    filled = {r["sid"]: r["slots"] for r in quota.collect()}
    total, in_shard = Counter(), Counter()
    for r in sorted(counts, key=lambda r: (r["sid"], r["shard"])):
        assert r["ahead"] == total[r["sid"]]
        total[r["sid"]] += r["n"]
        in_shard[r["shard"]] += r["n"]
    assert all(total[s] == n for s, n in filled.items())
    assert all(n == 8 for s, n in in_shard.items() if s < max(in_shard)) and len(in_shard) > 9
    held = mixing.slots(quota, 8).collect()
    assert len({(r["shard"], r["slot"]) for r in held}) == len(held) == sum(filled.values())
    assert all(0 <= r["slot"] < in_shard[r["shard"]] for r in held)
    blocks = {r["sid"]: r["blocks"] for r in counts}
    uses = Counter((r["sid"], r["block"]) for r in held)
    for s, n in filled.items():  # whole rounds through the blocks, then part of one more
        assert all(uses[s, b] in (n // blocks[s], -(-n // blocks[s])) for b in range(blocks.get(s, 0)))
    uses, first = Counter(), {}
    for r in mixing.slots(quota).collect():
        uses[r["sid"], r["block"]] += 1
        first[r["sid"], r["block"]] = min(first.get((r["sid"], r["block"]), 1 << 60), r["shard"])
    expect = {r["doc_id"]: (0, None) for r in sized.collect()}
    for r in mixing.packed(sized, targets).collect():
        at = Counter((r["sid"], w // mixing.BLOCK) for w in range(r["start"], r["start"] + r["size"]))
        expect[r["doc_id"]] = (
            sum(uses[k] * n for k, n in at.items()),
            min((first[k] for k in at if k in first), default=None),
        )
    taken = mixing.words_taken(df)
    assert {r["doc_id"]: (r["taken"], r["first_shard"]) for r in taken.collect()} == expect


# ---------------------------------------------------------------- 10 sharding


def test_ring_bounds_and_slots(spark, docs, none):
    rng = random.Random(4)
    made = spark.createDataFrame([(i, "x" * rng.randrange(200)) for i in range(4000)], "doc_id long, text string")
    got = sharding.assign(made).collect()
    load, slots = Counter(), defaultdict(list)
    for r in got:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(load.values()) / 16
    assert max(load.values()) <= mean * 1.001 + 202 * 4 and min(load.values()) > 0.9 * mean
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    edge = sharding.assign(docs).collect()
    assert len(edge) == docs.count()
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in edge) == texts
    assert sharding.assign(none).count() == 0


def test_ring_moves_little():
    loads = {c: 100 for c in range(sharding.CELLS)}
    a = {c: s for c, _, _, s in sharding.walk(loads, 16, slack=0.25)}
    b = {c: s for c, _, _, s in sharding.walk(loads, 17, slack=0.25)}
    assert sum(a[c] != b[c] for c in loads) < 0.2 * len(loads)


def test_ring_moves_little_at_the_default_slack():
    """Bytes that change shards when a 17th comes, a hot cell among them."""
    rng = random.Random(17)
    loads = {c: rng.randrange(1000, 9000) for c in range(sharding.CELLS)} | {77: 5_000_000}
    runs = {n: sharding.walk(loads, n) for n in (16, 17)}
    for n, found in runs.items():
        held = Counter()
        for _, start, end, shard in found:
            held[shard] += end - start
        mean = -(-sum(loads.values()) // n)
        assert sum(held.values()) == sum(loads.values()) and max(held.values()) <= mean * (1 + sharding.SLACK) + 1
    after = defaultdict(list)
    for cell, start, end, shard in runs[17]:
        after[cell].append((start, end, shard))
    moved = Counter()
    for cell, start, end, shard in runs[16]:
        for s, e, to in after[cell]:
            if to != shard:
                moved[to == 16] += max(0, min(end, e) - max(start, s))
    total = sum(loads.values())
    # 1 / 17 must go to the new shard; what moves between old ones is the overflow of full shards
    assert moved[True] <= -(-total // 17) * (1 + sharding.SLACK) + 1 and moved[False] < 0.06 * total, moved


def test_hot_keys_are_spread_over_tasks(spark, monkeypatch):
    rng = random.Random(11)
    made = [(7, words(rng, 5)) for _ in range(2000)]  # one id, many texts
    made += [(None, "same text")] * 2000 + [(8, "same row")] * 2000 + [(100 + i, words(rng, 9)) for i in range(2000)]
    staged = []
    monkeypatch.setattr(sharding, "materialize", lambda df, keep=sharding.materialize: staged.append(keep(df)) or staged[-1])
    frame = spark.createDataFrame(made, "doc_id long, text string").repartition(8)
    got = sharding.assign(frame).collect()
    want = Counter((d, len(t) + 1, zlib.crc32(t.encode())) for d, t in made)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, load = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert len(slots) == sharding.SHARDS and all(sorted(x) == list(range(len(x))) for x in slots.values())
    bound = -(-sum(load.values()) // sharding.SHARDS)
    assert max(load.values()) <= int(bound * (1 + sharding.SLACK)) + 1 + max(r["size"] for r in got)
    # running sums meet few rows of a key: copies as counts, texts of one id by salt
    windows = staged[-1].groupBy("cell", "salt").count().agg(F.max("count")).first()[0]
    assert windows < 200


# ---------------------------------------------------------------- 4 licenses


def test_license_rules():
    s = licenses.Scanner()
    assert len(s.rules) > 200
    got = s.scan("Licensed under the Apache License, Version 2.0. CC BY cc by.".encode())
    assert (got["n_base"], got["first_word"], got["last_word"]) == (2, 8, 10)
    assert got["base_labels"] == "cc-by" and got["labels"] == "apache-2.0,cc-by" and 0 < got["score"] <= 1
    # the plain "apache" rule lies inside the versioned one and is suppressed
    assert [x["label"] for x in got["spans"]] == ["apache-2.0"]
    assert s.scan(b"")["labels"] == "" and s.scan(b"")["first_word"] is None and s.scan(b"")["score"] == 0
    assert s.scan("all rightsé reserved".encode())["n_base"] == 0


def test_suppression_equals_all_intervals():
    scanner, rng = licenses.Scanner(), random.Random(5)
    parts = "licensed under the mit license gnu general public version 2 0 see for details spdx identifier apache terms of".split()
    for _ in range(300):
        joined = f" {' '.join(rng.choices(parts, k=60))} ".encode()
        found = sorted(
            (r.priority, m.start() - m.end(), m.start(), r.label)
            for r in scanner.rules
            for m in r.pattern.finditer(joined)
        )
        kept = []
        for _, minus, start, label in found:
            if not any(s <= start and start - minus <= e for s, e, _ in kept):
                kept.append((start, start - minus, label))
        assert [d[:3] for d in scanner.detect(joined)] == kept


def alternatives(parsed):
    """Strings a pattern matches, each of its alternatives in one of them at least."""
    parts = []
    for op, arg in parsed:
        if op is _constants.LITERAL:
            parts.append([chr(arg)])
        elif op is _constants.IN:
            parts.append([chr(c) for kind, a in arg for c in ([a] if kind is _constants.LITERAL else range(a[0], a[1] + 1))])
        elif op is _constants.BRANCH:
            parts.append([s for branch in arg[1] for s in alternatives(branch)])
        elif op is _constants.SUBPATTERN:
            parts.append(alternatives(arg[3]))
        elif op is _constants.MAX_REPEAT:
            assert arg[:2] == (0, 1)
            parts.append(["", *alternatives(arg[2])])
        else:
            assert op is _constants.ASSERT
    first = [p[0] for p in parts]
    return ["".join([*first[:i], s, *first[i + 1 :]]) for i, p in enumerate(parts) for s in p]


def test_every_alternative_passes_its_gates():
    scanner = licenses.Scanner()
    for rule in scanner.rules:
        for s in alternatives(_parser.parse(rule.pattern.pattern.decode())):
            joined = f" {s.strip()} "
            assert rule.pattern.search(joined.encode()), (rule, s)
            present = {k for _, k in scanner.keywords.iter(joined)}
            assert all(gate & present for gate in rule.gates), (rule, s)
    assert scanner.scan(b"Licensed under the FreeBSD license")["labels"] == "bsd-2-clause"
    assert scanner.scan(b"distributed under the Berkeley Software Distribution license")["labels"] == "bsd"


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
         'documentation files (the "Software"), to deal in the Software without restriction', "mit"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
        ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
        ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International", "cc-by-nc-nd"),
        ("the Mozilla Public License, v. 2.0", "mpl-2.0"),
        ("This map is in the public domain.", "public-domain"),
        ("it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
         "version 3 of the License, or (at your option) any later version", "gpl-3.0-or-later"),
        ("http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
        ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa"),
    ],
)
def test_signatures_of_texts(text, label):
    scanner = licenses.Scanner()
    assert label in scanner.scan(text.encode())["labels"].split(",")
    broken = text.replace(" ", " zz ").replace("/", "/zz/")  # the same words apart: no signature
    assert label not in scanner.scan(broken.encode())["labels"].split(",")


def test_clean_prose_has_no_labels():
    text = "The public library is open. Permission was granted to the author, who may copy the source and use it in any form."
    assert licenses.Scanner().scan(text.encode())["labels"] == ""


def test_base_counts_equal_a_word_loop(docs):
    rng = random.Random(12)
    parts = ["cc", "by", "CC", "general", "public", "license", "all", "rights", "reserved", "Ünder", "x1", "-", "é"]
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    scanner = licenses.Scanner()
    for k in range(200):
        text = rng.choice([" ", ", ", "\n"]).join(rng.choices(parts, k=k))
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        seen = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        at = [(i, v) for i in range(len(seen)) for p, v in phrases.items() if tuple(seen[i : i + len(p)]) == p]
        got = scanner.scan(text.encode())
        assert got["n_words"] == len(seen) and got["n_base"] == len(at)
        assert got["first_word"] == (at[0][0] if at else None) and got["last_word"] == (at[-1][0] if at else None)
        assert got["base_labels"] == ",".join(sorted({v for _, v in at}))


def test_many_detections_in_one_text():
    got = licenses.Scanner().scan(b"cc by and licensed under the mit license " * 30_000)
    assert got["n_base"] == 30_000 and got["last_word"] == 8 * 29_999 and len(got["spans"]) == 30_000


def test_license_table(docs, none):
    got = docs.select("doc_id", licenses.scan(F.col("text")).alias("s")).collect()
    assert len(got) == docs.count() and none.select(licenses.scan(F.col("text"))).count() == 0


# ---------------------------------------------------------------- 2 html


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="x">
<nav><ul><li><a href="/">Home</a></ul></nav><!-- <p>no</p> --><div class='ad big'>Buy</div><header>H</header>
<article><h1>Title &amp; more</h1><p>One <b>bold</b>word<br>next
 line<p title="a>b">Two &lt;p&gt; <script>var t="</p>";</script>end<div class="share">Share</div><form><p>f</p></form>
<section id="comments"><p>Nice!</p></section></article><aside>A</aside><footer>F</footer>"""


def test_page_text():
    assert html_main_text.Page(PAGE).text() == "Title & more\n\nOne boldword next line\n\nTwo <p> end"
    assert html_main_text.Page("").text() == "" and html_main_text.Page("plain & <simple").text() == "plain & <simple"
    assert html_main_text.Page("<nav>menu<article><p>in</article>").text() == "in"
    deep = "<div>" * 3000 + "x"
    assert html_main_text.Page(deep).text() == "x"


def test_articles_in_dropped_elements():
    def text(page):
        return html_main_text.Page(page).text()

    assert text("<div><p>story</p></div><aside><article><p>teaser</p></article></aside>") == "story"
    comments = "<section class=comments><article><p>reader comment</p></article></section>"
    assert text(comments) == "" and text(f"<article><p>story</p>{comments}</article>") == "story"
    assert text("<div>intro</div><nav>menu<article><p>in</article>") == "intro\n\nin"
    assert text("<nav>menu<article>in<aside><article>teaser</article></aside>") == "in"
    assert text("<aside><nav>menu<article>teaser</article></aside><p>story") == "story"
    assert text("<form><div>search<article>story</article></div></form>") == "story"
    deep = html_main_text.Page("<aside><article>x" * 30_000)
    assert deep.text() == "\n\n".join("x" * 30_000)
    assert html_main_text.Page("<aside>" + "<aside><article>x" * 30_000 + "</article></aside>" * 30_001).text() == ""


def test_head_without_end_tag():
    for page in (
        "<html><head><meta charset=utf-8><title>T</title><body><div><p>text</p></div></body>",
        "<head><title>T</title><style>p{}</style>\n<p>text",
        "<head><title>T</title>text",
        "<head><title>T</title><b>te</b>xt",
        "<head><title>T</title></head><body>text",
    ):
        assert html_main_text.Page(page).text() == "text", page


def test_deeply_nested_page():
    page = html_main_text.Page("<div class=a>x" * 30_000)
    assert page.text() == "\n\n".join("x" * 30_000)
    assert page.text(frozenset({page.elements[2].path})) == "x"


def test_style_tree_removes_templates(spark, none):
    rng = random.Random(6)

    def page(i):
        body = "".join(f"<p>{words(rng, 30, 4000)}</p>" for _ in range(4))
        return f"<body><div class='strip'>Same words everywhere</div><div class='story'>{body}</div></body>"

    made = [(i, f"https://h.example/{i}", page(i)) for i in range(12)] + [(20, "https://few.example/", page(20))]
    made += [(21, None, None), (22, "not a url", "<p>alone</p>")]
    got = {r["page_id"]: r["text"] for r in html_main_text.extract(spark.createDataFrame(made, "page_id long, url string, html string")).collect()}
    assert all("Same words" not in got[i] and got[i].count("\n\n") == 3 for i in range(12))
    assert "Same words" in got[20] and got[21] == "" and got[22] == "alone"
    same = [(i, "https://h.example/", page(1)) for i in range(1)] * 30  # copies are no template
    whole = html_main_text.extract(spark.createDataFrame([(i, u, h) for i, (_, u, h) in enumerate(same)], "page_id long, url string, html string"))
    assert all(r["text"].count("\n\n") >= 3 for r in whole.collect())
    assert html_main_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_style_tree_alone_removes_declared_elements(spark):
    """Menus, forms and footers are elements of the tree like any other; what varies needs the declared names."""
    rng = random.Random(19)
    menu = "<nav><ul><li><a href=/>Home</a><li><a href=/news>News</a></ul></nav>"
    foot = "<form><p>Search here</p></form><footer><p>All rights reserved by us</p></footer>"

    def page(i):
        story = "".join(f"<p>{words(rng, 30, 4000)}</p>" for _ in range(3))
        comment = f"<section class=comments><p>{words(rng, 12, 4000)}</p></section>"
        return f"{menu}<div class=story>{story}</div>{comment}{foot}"

    made = [(i, f"https://h.example/{i}", page(i)) for i in range(20)]
    pages = spark.createDataFrame(made, "page_id long, url string, html string")
    alone = {r["page_id"]: r["text"] for r in html_main_text.extract(pages, declared=False).collect()}
    both = {r["page_id"]: r["text"] for r in html_main_text.extract(pages).collect()}
    for i, _, html in made:
        paragraphs = re.findall("<p>(.*?)</p>", html)
        assert alone[i].split("\n\n") == paragraphs[:4] and both[i].split("\n\n") == paragraphs[:3]


def entropy(counts):
    return -sum(c / sum(counts) * math.log(c / sum(counts)) for c in counts)


def test_entropies_and_importance_equal_brute_force(spark):
    rng = random.Random(20)

    def page():
        blocks = "".join(f"<div class={rng.choice('ab')}><p>{words(rng, rng.choice([1, 25]), 6)}</p></div>" for _ in range(rng.randint(1, 4)))
        return f"<nav><ul><li>Home<li>News</ul></nav><p>{rng.choice(['One', 'Two'])}</p>{blocks}<footer>{words(rng, 1, 3)}</footer>"

    sources = [page() for _ in range(30)]
    made = spark.createDataFrame([(i, "https://h.example/", h) for i, h in enumerate(sources)], "page_id long, url string, html string")
    tree = html_main_text.style_tree(made)
    rows = {r["path"]: r.asDict() for r in tree.collect()}
    parsed = [html_main_text.Page(h) for h in sources]
    looks, texts, shown = defaultdict(list), defaultdict(lambda: defaultdict(Counter)), defaultdict(set)
    for i, p in enumerate(parsed):
        for e in p.elements:
            looks[e.path].append(tuple(e.children))
            shown[e.path].add(i)
        for text, e in p.blocks:
            texts[e.path][text][i] += 1
    assert set(rows) == set(looks)
    for path, r in rows.items():
        assert r["pages"] == len(shown[path]) and r["occurrences"] == len(looks[path])
        assert r["style"] == pytest.approx(entropy(Counter(looks[path]).values()), abs=1e-9)
        assert r["texts"] == len(texts[path])
        assert r["spread"] == pytest.approx(sum(entropy(c.values()) for c in texts[path].values()), abs=1e-9)

    scored = {p: r for p, r in rows.items() if r["pages"] >= html_main_text.MIN_PAGES}

    def rate(path):  # top down: an element asks its children
        r, unit = rows[path], math.log(rows[path]["pages"])
        inside = [p for p, c in rows.items() if p and c["parent"] == path]
        known = {p: rate(p) for p in inside if p in scored}
        rare = [rows[p] for p in inside if p not in scored]
        own = sum(1 - entropy(c.values()) / unit for c in texts[path].values()) / len(texts[path]) if texts[path] else 0.0
        own = min(1.0, max(0.0, own))
        best = max([own, 1.0 if any(c["chars"] for c in rare) else 0.0, *[b for p, (_, b) in known.items() if not rows[p]["apart"]]])
        weights = [(rows[p]["occurrences"], i) for p, (i, _) in known.items()] + [(c["occurrences"], 1.0) for c in rare]
        fade = 1.0 if not weights and not texts[path] else 0.0
        if weights:
            fade = html_main_text.DECAY ** (len(weights) + bool(texts[path]))
        weights += [(r["occurrences"], own)] * bool(texts[path])
        inner = sum(w * i for w, i in weights) / sum(w for w, _ in weights) if weights else 0.0
        return fade * min(1.0, r["style"] / unit) + (1 - fade) * inner, best

    low = {p for p in scored if p and html_main_text._is_low(rows[p], *rate(p))}
    got = {p for r in html_main_text.low_branches(html_main_text.scored(tree)).collect() for p in r["low"]}
    assert got == low and low


def test_style_tree_decides_inside_articles(spark):
    rng = random.Random(9)

    def page(i):
        story = "".join(f"<p>{words(rng, 30, 4000)}</p>" for _ in range(4))
        if i % 2:  # the article is a template, the story stands beside it
            return f"<div class=story>{story}</div><article class=teaser><p>The same teaser on each of the pages</p></article>"
        return f"<article><h1>{words(rng, 5)}</h1>{story}<p class=letter>Get our letter</p></article>"

    made = [(i, f"https://{'ab'[i % 2]}.example/{i}", page(i)) for i in range(40)]
    got = html_main_text.extract(spark.createDataFrame(made, "page_id long, url string, html string")).collect()
    assert all("letter" not in r["text"] and "teaser" not in r["text"] for r in got)
    assert all(r["text"].count("\n\n") == (3 if r["page_id"] % 2 else 4) for r in got)


def varied_pages():
    """Hosts with a rare notice, long legal notices on thin pages, near copies and nested menus."""
    rng = random.Random(10)
    made = []
    for i in range(10_000):
        notice = "<div class=maintained>We are maintained at night</div>" if i % 1250 == 0 else ""
        made.append(("rare", f"{notice}<p>{words(rng, 12, 4000)}</p>"))
    legal = f"<div class=legal><h3>Terms</h3><p class=a>{words(rng, 150)}</p><p class=b>{words(rng, 100)}</p></div>"
    other = f"<div class=rules>{words(rng, 90)}</div>"
    made += [("thin", f"<div class=story><p>{words(rng, 15, 4000)}</p></div>{legal}{other}") for _ in range(30)]
    article = f"<article><h1>{words(rng, 12)}</h1><p>{words(rng, 200)}</p></article>"
    made += [("near", f"<div class=date>May {i}</div><div class=by>{words(rng, 2, 4000)}</div>{article}") for i in range(30)]
    menu = "".join(f"<div class=m{k}><div class=n><div>Item {k}</div></div></div>" for k in "abcdef")
    made += [("menu", f"<div class=box>{menu}</div><section><p>{words(rng, 15, 4000)}</p></section>") for _ in range(20)]
    return [(i, f"https://{h}.example/{i}", html) for i, (h, html) in enumerate(made)]


def test_style_tree_at_every_size(spark, monkeypatch):
    made = varied_pages()
    pages = spark.createDataFrame(made, "page_id long, url string, html string").repartition(4).cache()
    got = {r["page_id"]: r["text"] for r in html_main_text.extract(pages).collect()}
    assert len(got) == len(made)
    for i, url, html in made:
        if "near" in url:  # copies of one article are no template, though their dates and names differ
            assert got[i] == html_main_text.Page(html).text() and got[i].count("\n\n") == 1
        else:
            assert got[i] and "\n" not in got[i] and f"<p>{got[i]}</p>" in html, url
    monkeypatch.setattr(html_main_text, "GROUP", 5)  # "thin" and "menu" by depth, the others in groups
    assert {r["page_id"]: r["text"] for r in html_main_text.extract(pages).collect()} == got
    tree = html_main_text.scored(html_main_text.style_tree(pages)).cache()
    groups = {(r["host"], p) for r in html_main_text.low_branches(tree).collect() for p in r["low"]}
    assert groups and {tuple(r) for r in html_main_text.low_by_depth(tree).collect()} == groups


def test_style_tree_scores_only_recurring_elements(spark):
    """Elements of single pages are summed up under their parent: what a host's group holds does not grow."""
    rng = random.Random(8)

    def name():
        return "".join(rng.choice("ghijk") for _ in range(12))

    def page():
        own = "".join(f"<div id={name()}><p>{words(rng, 12, 4000)}</p></div>" for _ in range(20))
        return f"<body><div class=strip>Same words everywhere</div><div class=story>{own}</div></body>"

    made = spark.createDataFrame([(i, "https://h.example/", page()) for i in range(40)], "page_id long, url string, html string")
    tree = html_main_text.style_tree(made)
    assert tree.count() == 3 + 40 * 20 * 2  # root, strip, story and the pages' own
    kept = {r["path"]: r for r in html_main_text.scored(tree, made).collect()}
    assert len(kept) == 3 and sorted(r["rare"] for r in kept.values()) == [0, 0, 800]
    whole = kept[0]["chars"]
    assert whole == sum(r["chars"] for p, r in kept.items() if p)
    texts = [r["text"] for r in html_main_text.extract(made).collect()]
    assert all("Same words" not in t and t.count("\n\n") == 19 for t in texts)


# ---------------------------------------------------------------- 9 token files


def test_blocks_are_stitched(spark, tmp_path):
    rng = np.random.default_rng(0)
    expect = {}
    for k, lengths in enumerate(([5, 0, 700, 1, 0, 0, 33], [0], [2000], [4, 3])):
        parts = [np.append(rng.integers(0, 50000, n), 50256) for n in lengths]
        data = np.concatenate(parts).astype("<u2")
        if k == 3:
            data = np.append(data, [7, 7]).astype("<u2")  # an unterminated rest
            lengths = [*lengths, 2]
        (tmp_path / f"{k}.bin").write_bytes(data.tobytes())
        expect |= {(str(tmp_path / f"{k}.bin"), i): n for i, n in enumerate(lengths)}
    (tmp_path / "empty.bin").write_bytes(b"")
    files = spark.createDataFrame([(str(p), p.stat().st_size) for p in tmp_path.iterdir()], "file string, bytes long")
    for block in (64, 130, 1 << 20):
        got = token_scan.count_tokens(files, str(tmp_path), block_bytes=block).collect()
        assert {(r["file"], r["ordinal"]): r["n_tokens"] for r in got} == expect and len(got) == len(expect)


def test_document_tokens(docs, none):
    encoder = token_scan.encoding(token_scan.TOKENIZER)
    expect = Counter((r["doc_id"], len(encoder.encode_ordinary(r["text"] or ""))) for r in docs.collect())
    assert Counter(tuple(r) for r in token_scan.document_tokens(docs.select("doc_id", "text")).collect()) == expect
    assert token_scan.document_tokens(none.select("doc_id", "text")).count() == 0


def test_long_white_space_is_encoded_whole():
    encoder = token_scan.encoding(token_scan.TOKENIZER)
    for text in ("x" + " " * 70_000 + "y", "x" + "\n" * 70_000 + "7", " " * 70_000, "a\u3000" + "\t " * 40_000 + "."):
        assert token_scan.encode(encoder, text) == encoder.encode_ordinary(text)
    text = "x" + " " * 1_500_000 + "y"  # beyond what the pattern can look ahead
    assert encoder.decode(token_scan.encode(encoder, text)) == text


# ---------------------------------------------------------------- 8 WARC


def test_warc_round_trip(spark, none):
    made = [(5, "u5", "<p>a</p>"), (2, "u2", "<p>a</p>"), (9, None, "é" * 1000), (1, "u1", None), (3, "u3", ""), (7, "u7", "x\r\n\r\ny")]
    made += [(None, "n", "<p>a</p>"), (2, "u2", "<p>a</p>")]
    df = spark.createDataFrame(made, "page_id long, url string, html string").repartition(3)
    got = warc_zip.read_archives(warc_zip.write_archives(df)).collect()
    first = {"<p>a</p>": 2, "": 1}
    expect = Counter()
    for i, u, h in made:
        body = (h or "").encode()
        least = first.get(h or "", i)
        kind = ("response", None) if i == least else ("revisit", least)
        expect[(i, u, body if i == least else None, len(body), warc_zip.sha1_base32(body), *kind)] += 1
    assert Counter((r[0], r[1], None if r[2] is None else bytes(r[2]), *r[3:]) for r in got) == expect
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_zip.read_archives(warc_zip.write_archives(empty)).count() == 0


def test_reads_foreign_zips(tmp_path):
    import io
    import zipfile

    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"a comment with PK\5\6 inside"
        z.writestr("indexes/index.cdx", "1 0 3\n")
        z.writestr("archive/data.warc.gz", b"abc")
    system, name = token_scan.open_folder(str(path))
    with system.open_input_file(name) as f:
        members = {m.name: m for m in warc_zip.central_directory(f, f.size())}
        at = warc_zip.data_start(f, members["archive/data.warc.gz"])
        assert f.read_at(members["archive/data.warc.gz"].size, at) == b"abc"
    out = io.BytesIO()  # and other readers read ours
    w = warc_zip.ZipWriter(out)
    w.begin("x")
    w.write(b"hello")
    w.finish()
    w.close()
    with zipfile.ZipFile(out) as z:
        assert z.read("x") == b"hello" and z.testzip() is None


# ---------------------------------------------------------------- 7 repeated strings


def brute_removed(pairs):
    first = {}
    for d, b in pairs:
        for i in range(len(b) - 49):
            s = b[i : i + 50]
            first[s] = min(first.get(s, math.inf), math.inf if d is None else d)
    out = Counter()
    for d, b in pairs:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < (math.inf if d is None else d):
                gone[i : i + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def removed(df):
    got = suffix_dedup.remove_repeats(df.select("doc_id", "text")).collect()
    return Counter((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["starts"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got)


def test_repeats_equal_brute_force(spark, docs, none, monkeypatch):
    pairs = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    assert removed(docs) == brute_removed(pairs)
    assert removed(none) == Counter()
    rng = random.Random(11)
    passage = [words(rng, 14, 9) for _ in range(6)]
    made = [(rng.randrange(60), rng.choice(["", "é", "zz "]) + rng.choice(passage)[rng.randrange(8) :] + words(rng, rng.randrange(12), 9) + rng.choice(passage)) for _ in range(150)]
    made += [(70, "a" * 300), (71, "a" * 120 + "b" + "a" * 49), (72, "ab" * 80), (73, None)]
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(4)
    assert removed(df) == brute_removed([(d, (t or "").encode()) for d, t in made])


def test_deep_shallow_order():
    rng = random.Random(12)
    rows = [bytes(rng.choice(b"ab") for _ in range(76)) for _ in range(200)]
    rows += [r[:40] + bytes(rng.choice(b"ab") for _ in range(36)) for r in rows[:20] for _ in range(8)] + rows[:30]
    got = list(suffix_dedup.deep_shallow(np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 76)))
    assert [k for k, _ in got] == sorted(set(rows))
    assert all(rows[i] == k for k, m in got for i in m) and sum(len(m) for _, m in got) == len(rows)
