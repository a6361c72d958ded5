"""Pivotal grams, the positive-unlabelled classifier, Orchard's search and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import classifier, clustering, queries, spelling, token_scan, warc_zip
from strata.llm.common import materialize
from strata.llm.oracles import ORACLES, clustering as clustering_sql

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, word string, n int"


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 1, "x", "y", "z", 1) for d, t in rows], DOCS)


# ---------------------------------------------------------------- 11: pivotal grams


def _edited(rng, word):
    at, letter = rng.randrange(len(word)), rng.choice("abcé")
    return rng.choice((word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]))


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) == len(b):
        return a != b and a[at + 1 :] == b[at + 1 :]
    return len(b) == len(a) + 1 and a[at:] == b[at + 1 :]


def _grouped(rows):
    """Brute force of the contract over all pairs of words."""
    times: dict[str, int] = {}
    for doc_id, text in rows:
        runs, run = [], ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                runs.append(run)
                run = ""
        for run in runs:
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            times[run] = times.get(run, 0) + 1
    words = {w: n for w, n in times.items() if len(w) >= 6 and n >= 5}
    form, near = {}, {w: [x for x in words if _one_edit(w, x)] for w in words}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(5)
    common = ["".join(rng.choice("abcé") for _ in range(rng.randrange(6, 10))) for _ in range(12)] + ["aaaaaaa", "ababababab"]
    pool = {w: 150 for w in common}
    for w in common:
        for _ in range(8):
            x = _edited(rng, w)
            pool.setdefault(x, 24)
            pool.setdefault(_edited(rng, x), 5)
    texts = [w for w, n in pool.items() for _ in range(n)]
    rng.shuffle(texts)
    rows = [(i, " ".join(texts[i::40]).replace("abc", "ABc")) for i in range(40)]
    rows += [(41, None), (42, ""), (None, "Ananas! ananas ananas, ananas×ananas ananas_ananas"), (43, "Éclair1Éclair " * 6)]
    rows += [(44, "q" * 20_000 + " "), (44, "q" * 20_000)] + [(45 + i, "q" * 20_000 + " " + "q" * 20_001) for i in range(5)]
    return rows + [rows[3], rows[3]]


def test_grouping_equals_brute_force(spark, spelled):
    short = [(d, t) for d, t in spelled if len(t or "") < 15_000]
    got = spelling.group(_docs(spark, short).repartition(5))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = _grouped(short)
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want) > 60
    assert any(w[1] != w[2] and w[1] for w in want)  # a chain of forms


def test_long_words_have_few_entries(spark, spelled):
    got = {r["word"]: r for r in spelling.group(_docs(spark, spelled)).collect()}
    assert {tuple(r) for r in got.values()} == _grouped(spelled)
    assert got["q" * 20_000]["n_near"] >= 1
    last, left, right, starts, ends = spelling.signature("q" * 20_000, {"qq": 3})
    assert (left, right, starts, ends) == ("qq", "qq", ["qq"], ["qq"]) and last == 3


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(1)
    for _ in range(300):
        places = sorted({rng.randrange(12): rng.randrange(9) for _ in range(rng.randrange(3, 9))}.items())
        pairs = [(wa + wb, (a, b)) for a, wa in places for b, wb in places if b >= a + 2]
        if pairs:
            assert tuple(spelling.choose_pivots(places)) == min(pairs)[1]


def test_every_near_pair_meets_in_the_index():
    """The lemma behind the join, over random words of few letters: probe and index share a key and the length."""
    rng = random.Random(2)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(6, 9))) for _ in range(400)}
    words |= {x for w in list(words) for x in [_edited(rng, w)] if len(x) >= 6}
    frequency: dict[str, int] = {}
    for w in words:
        for i in range(len(w) - 1):
            frequency[w[i : i + 2]] = frequency.get(w[i : i + 2], 0) + 1
    signed = {w: spelling.signature(w, frequency) for w in words}

    def met(s, r):
        return signed[s][0] <= signed[r][0] and (signed[s][1] in signed[r][3] or signed[s][2] in signed[r][4])

    pairs = [(a, b) for a in words for b in words if a < b and _one_edit(a, b)]
    assert len(pairs) > 200 and all(met(a, b) or met(b, a) for a, b in pairs)


def test_no_join_broadcasts_words(spark, spelled):
    """Small files of words hold many index entries: a broadcast of them would be gathered in the driver."""
    words = materialize(spelling.vocabulary(_docs(spark, spelled)))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        for made in (spelling.near_pairs(words), spelling.group(_docs(spark, spelled))):
            made.collect()
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert "Join" in plan and "Broadcast" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_no_words(spark):
    for rows in ([], [(1, None), (2, "short words only")]):
        assert spelling.group(_docs(spark, rows)).collect() == []


# ---------------------------------------------------------------- 13: Orchard's search


def test_search_finds_the_nearest_and_the_smaller_number():
    rng = np.random.default_rng(4)
    points = rng.integers(-6, 7, (30, 3))
    points[7] = points[3]
    vectors = np.concatenate([rng.integers(-9, 10, (500, 3)), points])
    cluster, distance = clustering.nearest(vectors, clustering.Centroids.of(points))
    every = ((vectors[:, None] - points[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    one = clustering.nearest(vectors, clustering.Centroids.of(points[:1]))
    assert (one[0] == 0).all() and (one[1] == every[:, 0]).all()


def test_search_stops_early(monkeypatch):
    """Far groups of centroids are not visited: the walk ends where the list passes twice the distance."""
    points = np.array([[100 * (i // 5) + i % 5, 0] for i in range(40)])
    centroids, measured = clustering.Centroids.of(points), []
    count = clustering.squared
    monkeypatch.setattr(clustering, "squared", lambda a, b: measured.append(len(a)) or count(a, b))
    cluster, _ = clustering.nearest(points + [0, 1], centroids)
    assert (cluster == np.arange(40)).all()
    assert sum(measured) < 40 * 10  # a few for each vector, not 40


def _vectors(n, dims, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=dims).astype("f4")]) for i in range(n)]


def test_rounds_equal_the_oracle(spark):
    rows = _vectors(60, 4) + [(7, [0.5] * 4), (7, [0.5] * 4), (None, [0.25, -0.25, 1.0, -1.0])]
    rows += [(90, None), (91, [1.0] * 3), (92, [1.0, None, 1.0, 1.0]), (93, [float("nan")] + [1.0] * 3),
             (94, [float("inf")] * 4), (95, [-float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 3, "c") for i, v in rows], "vec_id long, embedding array<float>, label int, cluster string")
    got = clustering.cluster(df.repartition(4), dims=4, k=6, rounds=3)
    db = duckdb.connect()
    db.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    db.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    want = db.execute(clustering_sql(dims=4, k=6, rounds=3)).fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert got.count() == 63 and got.agg(F.countDistinct("inertia")).first()[0] == 1


def test_few_and_no_vectors_and_large_components(spark):
    kind = "vec_id long, embedding array<float>"
    few = clustering.cluster(spark.createDataFrame(_vectors(3, 4), kind), dims=4)
    rows = few.collect()
    assert [r["distance"] for r in rows] == [0, 0, 0] and len({r["cluster"] for r in rows}) == 3
    ints = ",".join(str(int(np.floor(256 * x))) for x in _vectors(3, 4)[0][1])
    assert {r["vec_id"]: r["centroid_sha256"] for r in rows}[0] == hashlib.sha256(ints.encode()).hexdigest()
    none = clustering.cluster(spark.createDataFrame([], kind), dims=4)
    assert none.collect() == [] and "centroid_sha256" in none.columns
    with pytest.raises(Exception, match="no exact distances"):
        clustering.cluster(spark.createDataFrame([(1, [1e9] * 4)], kind), dims=4)


# ---------------------------------------------------------------- 12: positive-unlabelled learning


def test_prior_and_risk_on_a_known_mixture():
    """Two Gaussians, 60% positives among the unlabelled: prior and error close to the truth."""
    rng = np.random.default_rng(3)
    positive = rng.normal(1.5, 1, (1500, 4))
    mixed = np.where(rng.random(4000) < 0.6, 1, 0)
    unlabelled = rng.normal(0, 1, (4000, 4)) + np.where(mixed[:, None] == 1, 1.5, -1.5)
    rows = np.concatenate([positive, unlabelled]).astype("f4")
    order = rng.permutation(len(rows))
    is_positive = np.arange(len(rows)) < 1500
    net, prior = classifier.fit(rows[order], is_positive[order])
    assert abs(prior - 0.6) < 0.06
    truth = np.concatenate([np.ones(1500), mixed])[1500:]
    assert ((net.probability(unlabelled.astype("f4")) > 0.5) == truth).mean() > 0.97


def test_held_out_accuracy_on_the_tables(spark):
    got = queries.op12_positive_unlabelled(spark, "/root/testdata/sf0.01")
    rows = got.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("q")), "doc_id")
    assert got.count() == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    held = [(r["score"], r["predicted"], r["q"]) for r in rows.where("held_out").collect()]
    assert len(held) > 60 and sum(p == q for _, p, q in held) / len(held) > 0.9
    good, bad = [s for s, _, q in held if q == 1], [s for s, _, q in held if q == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert all((r["score"] >= 0.7) == r["predicted"] for r in got.collect())


def test_labels_of_the_held_out_part_and_bad_labels_are_not_read(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["lorem", "ipsum", "dolor,", "sit."]) for _ in range(60)) for _ in range(80)]
    rows = [(i, t.upper() if i % 4 == 1 else t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (None, texts[0]), (3, texts[4])]
    docs = _docs(spark, rows)
    part = {i: zlib.crc32(str(i).encode()) % 4 for i in range(80)}
    labels = [(i, 0 if i % 4 == 1 else 1, 0) for i in range(80)]

    def scores(given):
        df = classifier.classify(docs, spark.createDataFrame(given, "doc_id long, quality int, toxic int"))
        return sorted(map(tuple, df.collect()), key=repr)

    base = scores(labels + [(None, 1, 0), (3, None, 1), (5555, 1, 0)])
    assert len(base) == len(rows) and {r[1] for r in base if r[0] == 2} == {part[2] == 2}
    flipped = [(i, 1 - q if part[i] == 2 else q, 1) for i, q, _ in labels]
    assert scores(flipped) == base
    assert scores([x for x in labels if x[1] == 1]) == base  # bad labels only say "not trusted"
    assert {r[2] for r in scores([(1, 0, 0)])} == {0.5} and scores([])[0][2] == 0.5
    empty = classifier.classify(_docs(spark, []), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert empty.collect() == []


# ---------------------------------------------------------------- 8 and 9: reads spread over tasks


def test_blocks_and_packages_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """With adaptive execution on, rows that only name work are not merged into one task."""
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    flat = np.arange(1, 40_001, dtype="<u2")
    flat[::97] = token_scan.SEPARATOR
    (tmp_path / "t.bin").write_bytes(flat.tobytes())
    seen = []

    def counted(df, *args):
        seen.append(df.select(F.spark_partition_id().alias("p")).distinct().count())
        return materialize(df, *args)

    monkeypatch.setattr(token_scan, "materialize", counted)
    files = spark.createDataFrame([(str(tmp_path / "t.bin"), flat.nbytes)], "file string, bytes long")
    got = token_scan.count_tokens(files, str(tmp_path), block_bytes=1000).collect()
    at = np.flatnonzero(flat == token_scan.SEPARATOR)
    want = {i: int(n) for i, n in enumerate(np.diff(at, prepend=-1) - 1)} | {len(at): len(flat) - at[-1] - 1}
    assert {r["ordinal"]: r["n_tokens"] for r in got} == {k: v for k, v in want.items() if k < len(at) or v}
    assert seen[0] >= 6
    pages = spark.range(80).selectExpr("id AS page_id", "'u' AS url", "concat('<p>', id) AS html").repartition(24)
    packages = warc_zip.write_archives(pages)
    assert packages.count() >= 20
    read = warc_zip.read_archives(packages).select(F.spark_partition_id().alias("p")).distinct().count()
    assert read >= 6


def test_pages_of_one_payload_are_written_by_many_tasks(spark, monkeypatch):
    """Half of the pages have one payload: equal payloads meet as ids, not as pages."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pages = spark.range(2000).selectExpr("id AS page_id", "'u' AS url", "if(id % 2 = 0, 'same', concat('<p>', id)) AS html")
        packages = warc_zip.write_archives(pages)
        records = [r["records"] for r in packages.collect()]
        assert sum(records) == 2000 and max(records) < 2 * 2000 / 8
        again = warc_zip.read_archives(packages).where("record_type = 'revisit'")
        assert again.count() == 999 and again.where("refers_to <> 0").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


# ---------------------------------------------------------------- queries and pipeline


def test_oracles_belong_to_queries():
    assert set(ORACLES) == {"op11_pivotal_grams", "op13_orchard"} and set(ORACLES) < set(queries.QUERIES)
    assert len(queries.QUERIES) == 13


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder of tables with nulls, copies, near copies, leaks, junk and repeated rows."""
    rng = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("l", "ner", "st", "rom")]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, prose(40)) for i in range(3)]
    rows = [(i, prose(120)) for i in range(60)]
    rows += [(60 + i, rows[1][1]) for i in range(5)]  # exact copies
    near = rows[2][1].split()
    rows += [(70 + i, " ".join(near[:-1] + [f"x{i}"])) for i in range(5)]
    rows += [(80 + i, f"{prose(60)} {items[i][1]} {prose(60)}") for i in range(3)]  # leaks
    rows += [(90, None), (91, ""), (92, "word " * 300), (93, prose(20)), (None, prose(130)), (5, rows[6][1])]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = [(d, t, ("en", None)[k % 2], ("a", "b", None)[k % 3], len(t or "")) for k, (d, t) in enumerate(rows)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, kind).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = spark.createDataFrame([(i, int(i != 4), 0) for i in range(30)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return path, docs


def test_pipeline_stage_by_stage(spark, corpus):
    path, rows = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard", "decontamination", "mixing", "sharding"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = [r["doc_id"] for r in docs.collect()]
    assert not {90, 91, 92, 93} & set(kept["quality_rules"]) and len(kept["quality_rules"]) == len(rows) - 4
    groups = ({1, *range(60, 65)}, {2, *range(70, 75)}, {5}, {6})
    left = kept["ngram_jaccard"]
    assert sorted(i for i in left if i in groups[0] | groups[1]) == [1, 2]
    assert len([i for i in left if i in (5, 6)]) == 2 and len(left) == len(kept["quality_rules"]) - 11
    assert set(left) - set(kept["decontamination"]) == {80, 81, 82}
    assert set(kept["mixing"]) <= set(kept["decontamination"])
    last = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    assert sorted(r["doc_id"] for r in last.collect() if r["doc_id"] is not None) == sorted(i for i in kept["mixing"] if i is not None)
    slots = {}
    for r in last.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_pipeline_of_nothing(spark, corpus, tmp_path):
    path, _ = corpus
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_queries_on_odd_tables(spark, corpus):
    """The registered queries keep one row a document on nulls, empties and repeated rows."""
    path, rows = corpus
    for name in ("op4_license_rules", "op6_quality_rules", "op10_hash_ring", "op12_positive_unlabelled"):
        got = queries.QUERIES[name](spark, path)
        ids = sorted((r["doc_id"] for r in got.collect()), key=repr)
        assert ids == sorted((r[0] for r in rows), key=repr), name
