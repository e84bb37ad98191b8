"""Queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries as q


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in vars(q).items() if name.startswith("op") and callable(f)}


_VECTORS = """
WITH parts AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), bad AS (
  SELECT DISTINCT vec_id FROM parts WHERE x IS NULL OR isnan(x) OR isinf(x)
), good AS (
  SELECT vec_id, d, {value} AS x FROM parts WHERE vec_id NOT IN (SELECT vec_id FROM bad)
), size AS (
  SELECT vec_id, max(d) AS dim FROM good GROUP BY vec_id{having}
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(q.x * c.x{order}){cast} AS score
  FROM good q JOIN good c ON q.d = c.d AND q.vec_id <> c.vec_id
  JOIN size a ON a.vec_id = q.vec_id JOIN size b ON b.vec_id = c.vec_id AND a.dim = b.dim
  WHERE q.vec_id % {every} = 0 GROUP BY q.vec_id, c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= {k}
"""


def _codes(rounds: int = 6) -> str:
    """Rounds of full nearest-entry search over integers."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT rid, part, entry, d FROM (
    SELECT *, row_number() OVER (PARTITION BY rid, part ORDER BY d, entry) AS r FROM (
      SELECT x.rid, x.part, c.entry, sum((x.v - c.v) * (x.v - c.v)) AS d
      FROM x JOIN c{k} c ON x.part = c.part AND x.pos = c.pos GROUP BY x.rid, x.part, c.entry)) WHERE r = 1
)""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, c.pos, CASE WHEN n IS NULL THEN c.v ELSE (s - ((s % n) + n) % n) // n END AS v
  FROM c{k} c LEFT JOIN (
    SELECT a.part, a.entry, x.pos, sum(x.v) AS s, count(*) AS n
    FROM a{k} a JOIN x ON a.rid = x.rid AND a.part = x.part GROUP BY a.part, a.entry, x.pos
  ) m ON m.part = c.part AND m.entry = c.entry AND m.pos = c.pos
)""")
    return f"""
WITH good AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, embedding, len(embedding) // 8 AS size
  FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
), x AS MATERIALIZED (
  SELECT rid, (d - 1) // size AS part, (d - 1) % size AS pos, floor(4096 * e::DOUBLE)::HUGEINT AS v
  FROM (SELECT rid, size, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS d FROM good)
), c0 AS MATERIALIZED (
  SELECT part, rid - 1 AS entry, pos, v FROM x WHERE rid <= 16
), {", ".join(steps)}, coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY rid
), book AS (
  SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM c{rounds}
)
SELECT g.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM good g JOIN coded USING (rid) CROSS JOIN book
"""


#: crc32 of a number's decimal digits, bit by bit (its last two bits count).
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(str_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
  lambda c, x: list_reduce(list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295)"""

_TRIE = r"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
  WHERE conv_id IS NOT NULL
), c0 AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base FROM t GROUP BY conv_id
), c1 AS (
  SELECT *, """ + _CRC + r""" % 4 AS h FROM c0
), c AS (
  SELECT c1.*, least(h, coalesce(b.n, 0)) AS taken, least(h, coalesce(b.n, 0)) + greatest(c1.n - h, 0) AS size
  FROM c1 LEFT JOIN c0 b ON b.conv_id = c1.base
), rebuilt AS (
  SELECT c.conv_id, c.size, pos + 1 AS depth, role, text FROM c JOIN t ON t.conv_id = c.base AND pos < h
  UNION ALL
  SELECT c.conv_id, c.size, pos - h + taken + 1, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos >= h
), m AS MATERIALIZED (
  SELECT conv_id, size, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    string_agg(sha256(len(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS k
  FROM rebuilt
  UNION ALL SELECT conv_id, size, 0, 0, '' FROM c
), linked AS MATERIALIZED (
  SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY depth) AS pk FROM m
), node AS MATERIALIZED (
  SELECT depth, k, any_value(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '') AS ends
  FROM linked GROUP BY depth, k
), child AS (
  SELECT depth - 1 AS depth, pk AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2
), own AS MATERIALIZED (
  SELECT node.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * words AS saved
  FROM node LEFT JOIN child ON child.depth = node.depth AND child.k = node.k
), total AS (
  SELECT m.depth, m.k, count(*) FILTER (o.n_children = 0) AS n_leaves, sum(o.saved)::BIGINT AS saved_tokens
  FROM own o JOIN m ON m.conv_id = o.conv_id AND m.depth <= o.depth GROUP BY m.depth, m.k
)
SELECT o.conv_id, o.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens,
  sha256(o.ends) AS ends_sha256
FROM own o JOIN total ON total.depth = o.depth AND total.k = o.k
LEFT JOIN own p ON p.depth = o.depth - 1 AND p.k = o.pk
"""


def oracle_sql() -> dict[str, str]:
    """Brute force in SQL, for the searches, the vector codes and the trie."""
    return {
        "op12_conversation_trie": _TRIE,
        "op11_vector_codes": _codes(),
        "op5_neighbours": _VECTORS.format(value="x", having=" HAVING max(abs(x)) > 0", order=" ORDER BY q.d",
                                          cast="", every=20, k=20),
        "op10_topk": _VECTORS.format(value="floor(256 * x)::BIGINT", having="", order="", cast="::BIGINT",
                                     every=50, k=5),
    }
