"""SQL for the components of texts that are linked by shared word shingles."""

from __future__ import annotations

import string


def components_sql(words: int, percent: int, kept: bool) -> str:
    """Every pair of texts with a common shingle is counted; components are followed link by link."""
    shingle = " || ' ' || ".join(f"ws[i + {k}]" if k else "ws[i]" for k in range(words))
    more = ", doc_id IS NOT DISTINCT FROM min(d) AS kept" if kept else ""
    return f"""
    WITH RECURSIVE source AS (
      SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
               translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
               '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
      FROM documents),
    sets AS MATERIALIZED (
      SELECT r, doc_id, list_distinct(
               CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
                    WHEN len(ws) < {words} THEN [array_to_string(ws, ' ')]
                    ELSE list_transform(range(1, len(ws) - {words - 2}), lambda i: {shingle}) END) AS members
      FROM source),
    held AS MATERIALIZED (
      SELECT r, n, md5_number(shingle) AS shingle
      FROM (SELECT r, len(members) AS n, unnest(members) AS shingle FROM sets)),
    linked AS (
      SELECT x.r AS a, y.r AS b FROM held x JOIN held y ON x.shingle = y.shingle AND x.r < y.r
      GROUP BY x.r, y.r HAVING 100 * count(*) >= {percent} * (any_value(x.n) + any_value(y.n) - count(*))),
    links AS MATERIALIZED (
      SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
      UNION ALL SELECT x.r, y.r FROM sets x JOIN sets y ON x.doc_id = y.doc_id AND x.r <> y.r),
    reached(r, d) AS (
      SELECT r, doc_id FROM sets
      UNION SELECT l.b, reached.d FROM reached JOIN links l ON l.a = reached.r)
    SELECT doc_id, CAST(len(members) AS BIGINT) AS n_shingles, min(d) AS component_id{more}
    FROM sets JOIN reached USING (r) GROUP BY r, doc_id, members"""
