"""DuckDB SQL of the queries that SQL can express. The others (learned model,
XXH64, CRC-32, tokenizers, checksums) are tested against brute force."""

from __future__ import annotations

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT"
#: a word of over 64 characters counts once for each 64 begun
_UNITS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]{1,64}')), 0)::BIGINT"

#: cosine links by all pairs of a label; components by closure
_OP4 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= 0.98),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
cnt AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(cnt.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(comp.m, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(comp.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN cnt ON cnt.a = e.vec_id LEFT JOIN comp ON comp.a = e.vec_id
"""

_OP5 = f"""
WITH doc AS (
  SELECT doc_id, source, {_WORDS} AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')), 1, 15))::BIGINT AS h
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS s FROM doc GROUP BY source),
weighed AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS w,
                   s * 2.0::DOUBLE AS cap FROM src),
lev AS (SELECT *, (sum(s) OVER () * 1.5::DOUBLE
                   - (sum(cap) OVER (ORDER BY cap / w, source IS NULL, source
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cap))
                  / sum(w) OVER (ORDER BY cap / w, source IS NULL, source
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM weighed),
free AS (SELECT arg_min(lvl, cap / w) AS lvl FROM lev WHERE cap > lvl * w),
tgt AS (SELECT lev.source, s, CASE WHEN cap <= lev.lvl * w THEN cap ELSE free.lvl * w END AS t FROM lev, free),
plan AS (SELECT *, least(CASE WHEN s > 0 THEN floor(t / s)::BIGINT ELSE 0 END, 2) AS passes FROM tgt),
part AS (SELECT *, greatest(t - passes * s, 0.0) AS rest FROM plan),
placed AS (
  SELECT d.*, p.s, p.t, p.passes, p.rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, h) AS g
  FROM doc d JOIN part p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, s AS source_size, t AS target,
       (size * least(passes + CASE WHEN 2 * (upto - g) + g <= 2 * rest THEN 1 ELSE 0 END, 2))::BIGINT AS taken
FROM placed
"""

_OP6 = """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_reduce(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i]), lambda x, y: x + y) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def _op8(max_len: int = 2048, buckets: int = 8, budget: int = 16384) -> str:
    """The dynamic program as one table per bucket: least padded words of the
    first i lengths, and the end of the bucket before."""
    layers = ["f0 AS (SELECT 0::BIGINT AS i, 0::BIGINT AS cost)"]
    for b in range(1, buckets + 1):
        layers.append(f"""
f{b} AS (SELECT i, p[1] AS cost, p[2] AS prev FROM (
  SELECT hist.i, min([f.cost + hist.len * (hist.upto - coalesce(e.upto, 0)), f.i]) AS p
  FROM f{b - 1} f JOIN hist ON hist.i > f.i LEFT JOIN hist e ON e.i = f.i GROUP BY hist.i))""")
    walk = ["ends AS (SELECT least((SELECT max(i) FROM hist), " + str(buckets) + ") AS k, (SELECT max(i) FROM hist) AS m)"]
    walk.append(f"e{buckets} AS (SELECT {buckets} AS b, m AS i FROM ends WHERE k = {buckets})")
    for b in range(buckets - 1, 0, -1):
        walk.append(f"e{b} AS (SELECT {b} AS b, f.prev AS i FROM e{b + 1} e JOIN f{b + 1} f ON f.i = e.i "
                    f"UNION ALL SELECT {b} AS b, m AS i FROM ends WHERE k = {b})")
    every = " UNION ALL ".join(f"SELECT * FROM e{b}" for b in range(1, buckets + 1))
    return f"""
WITH doc AS (SELECT doc_id, {_UNITS} AS words, coalesce(md5(text), '') AS digest FROM documents),
cut AS (SELECT doc_id, words, digest, unnest(generate_series(0, greatest(ceil(words / {max_len}.0)::BIGINT - 1, 0))) AS piece
        FROM doc),
seq AS (SELECT doc_id, piece, piece * {max_len} AS start, least(words - piece * {max_len}, {max_len}) AS length,
               md5(coalesce(doc_id::VARCHAR, '') || ':' || piece::VARCHAR || ':' || digest) AS h FROM cut),
hist AS MATERIALIZED (SELECT length AS len, row_number() OVER (ORDER BY length) AS i,
                             (sum(count(*)) OVER (ORDER BY length))::BIGINT AS upto FROM seq GROUP BY length),
{", ".join(layers)},
{", ".join(walk)},
bound AS (SELECT row_number() OVER (ORDER BY hist.len) - 1 AS bucket, hist.len AS bucket_len
          FROM ({every}) x JOIN hist USING (i)),
placed AS (SELECT seq.*, (SELECT min(bucket) FROM bound WHERE bucket_len >= length) AS bucket FROM seq),
spot AS (SELECT placed.*, bound.bucket_len, row_number() OVER (PARTITION BY bucket ORDER BY h, doc_id, piece) - 1 AS pos
       FROM placed JOIN bound USING (bucket))
SELECT doc_id, piece, start, length, bucket::INTEGER AS bucket, bucket_len,
       pos // ({budget} // greatest(bucket_len, 1)) AS batch, pos % ({budget} // greatest(bucket_len, 1)) AS slot
FROM spot
"""


def _op12(entries: int = 256, rounds: int = 4) -> str:
    """Codebooks round by round; whole numbers below 2^53 are exact as doubles."""
    near = """(SELECT rid, p, min([list_inner_product(t.v, t.v) - 2 * list_inner_product(t.v, c.v)
               + list_inner_product(c.v, c.v), c.e::DOUBLE]) AS m FROM pt t JOIN {c} c USING (p) GROUP BY rid, p)"""
    steps = []
    for r in range(rounds):
        steps.append(f"""
a{r} AS MATERIALIZED {near.format(c=f"c{r}")},
s{r} AS (SELECT p, m[2] AS e, pos, floor(sum(x) / count(*)) AS x
         FROM (SELECT p, m, unnest(v) AS x, unnest(range(len(v))) AS pos FROM a{r} JOIN pt USING (rid, p))
         GROUP BY p, m[2], pos),
n{r} AS (SELECT p, e, list(x ORDER BY pos) AS v FROM s{r} GROUP BY p, e),
c{r + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(n.v, c.v) AS v FROM c{r} c LEFT JOIN n{r} n ON n.p = c.p AND n.e = c.e)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pt AS MATERIALIZED (SELECT rid, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS v FROM kept, range(4) AS q(p)),
c0 AS MATERIALIZED (SELECT p, rid - 1 AS e, v FROM pt WHERE rid <= {entries}), {",".join(steps)},
fin AS MATERIALIZED {near.format(c=f"c{rounds}")},
coded AS (SELECT rid, string_agg(printf('%02x', m[2]::BIGINT), '' ORDER BY p) AS code, sum(m[1])::BIGINT AS error
          FROM fin GROUP BY rid),
book AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) AS h
         FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (rid), book
"""


ORACLE_SQL: dict[str, str] = {
    "op4_embedding_links": _OP4,
    "op5_source_mix": _OP5,
    "op6_nearest_vectors": _OP6,
    "op8_packed_batches": _op8(),
    "op12_vector_codes": _op12(),
}
