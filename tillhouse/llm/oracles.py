"""DuckDB SQL of the operators that SQL can express on whole tables."""

_WORDS = ("list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')")
_SHINGLES = ("list_distinct(list_transform(range(1, CASE WHEN len(ws) = 0 THEN 1 ELSE greatest(len(ws) - 4, 1) + 1 END), "
             "lambda i: array_to_string(ws[i:i + 4], ' ')))")


def _sets(table: str, key: str) -> str:
    return f"(SELECT {key}, {_SHINGLES} AS s FROM (SELECT {key}, {_WORDS} AS ws FROM {table}))"


OP2 = f"""
WITH q AS {_sets('benchmark', 'item_id')}, d AS {_sets('documents', 'doc_id')},
qs AS (SELECT item_id, len(s) AS n, unnest(s) AS x FROM q), ds AS (SELECT doc_id, unnest(s) AS x FROM d)
SELECT doc_id, item_id, count(*) / any_value(n) AS containment FROM qs JOIN ds USING (x)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n)"""

OP9 = f"""
WITH RECURSIVE d AS MATERIALIZED {_sets('documents', 'doc_id')},
x AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM d),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
FROM d"""


def _clusters(rounds: int = 3) -> str:
    """Operator 13: each round compares every vector with all 16 centres."""
    near = """near{r} AS MATERIALIZED (
  SELECT rid, min(struct_pack(d := list_sum(list_transform(range(1, 65), lambda i: (kept.v[i] - m.v[i]) * (kept.v[i] - m.v[i]))), c := m.c)) AS best
  FROM kept CROSS JOIN means{r} m GROUP BY rid)"""
    mean = """sums{r} AS (
  SELECT c, i, sum(x) AS s, count(*) AS n
  FROM (SELECT near{r}.best.c AS c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM near{r} JOIN kept USING (rid)) GROUP BY c, i),
means{s} AS MATERIALIZED (
  SELECT m.c, coalesce(x.v, m.v) AS v FROM means{r} m LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) / n AS BIGINT) ORDER BY i) AS v FROM sums{r} GROUP BY c) x ON x.c = m.c)"""
    steps = ",\n".join(f"{near.format(r=r)},\n{mean.format(r=r, s=r + 1)}" for r in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
means0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS c, v FROM kept
  ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v LIMIT 16),
{steps},
{near.format(r=rounds)},
done AS (SELECT vec_id, best.c AS c, CAST(best.d AS BIGINT) AS d FROM near{rounds} JOIN kept USING (rid))
SELECT vec_id, CAST(done.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY done.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM done JOIN means{rounds} m ON m.c = done.c"""


OP13 = _clusters()


def oracles() -> dict[str, str]:
    return {"op2_decontaminate": OP2, "op9_ngram_join": OP9, "op13_centroid_clusters": OP13}
