"""DuckDB SQL of the corpus operators that SQL can express."""

from __future__ import annotations

_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: CRC-32 of a string by the usual table of 256 remainders; words one edit apart share the word without one letter.
SPELLING = f"""WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_ASCII}', '{_ASCII.lower()}'), '[a-zÀ-ÿ]+')) AS run
  FROM documents),
counted AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named, run, count(*) AS n
  FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(
           list_concat([4294967295], list_transform(range(strlen(named)),
                       lambda i: CAST('0x' || substr(hex(named), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM counted, crc_table),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0
                    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
        FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT DISTINCT * FROM (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b USING (rest, i) WHERE a.word <> b.word
    UNION ALL SELECT a.word, a.n, w.word, w.n FROM cut a JOIN words w ON w.word = a.rest
    UNION ALL SELECT w.word, w.n, a.word, a.n FROM cut a JOIN words w ON w.word = a.rest)),
best AS (
  SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS form,
         first(near_n ORDER BY near_n DESC, encode(near)) AS form_n
  FROM near GROUP BY word, n),
forms AS MATERIALIZED (SELECT word, form, form_n FROM best WHERE form_n >= 5 * n),
steps AS (
  SELECT word, form AS root, 1 AS depth FROM forms
  UNION ALL SELECT s.word, f.form, s.depth + 1 FROM steps s JOIN forms f ON f.word = s.root),
roots AS (SELECT word, last(root ORDER BY depth) AS root FROM steps GROUP BY word)
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN best b USING (word) LEFT JOIN forms f USING (word) LEFT JOIN roots r USING (word)"""


def clustering(dims: int = 64, k: int = 40, rounds: int = 5, seed: int = 2) -> str:
    """Lloyd rounds over all pairs of vector and centroid; squared distances stay exact below 2 ** 53."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({256} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT v, sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM kept) ORDER BY h, v LIMIT {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(kv) AS v, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT k.r, k.vec_id, k.v AS kv, c.c, list_dot_product(k.v, k.v) + list_dot_product(c.v, c.v)
               - 2 * list_dot_product(k.v, c.v) AS d FROM kept k CROSS JOIN c{i} c)
  GROUP BY r)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN (
    SELECT c, list(floor(s / n) ORDER BY j) AS v FROM (
      SELECT c, j, sum(v[j]) AS s, count(*) AS n FROM a{i}, range(1, {dims + 1}) q(j) GROUP BY c, j)
    GROUP BY c) m USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (c)"""


ORACLES = {"op11_pivotal_grams": SPELLING, "op13_orchard": clustering()}
