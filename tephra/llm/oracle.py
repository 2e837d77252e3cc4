"""DuckDB SQL of this subpackage's queries, where SQL can express them on whole tables.

The other queries need a tokenizer, a compressor, a fitted model, a similarity search or
checksums over pattern matches; the tests hold them against brute force.
"""

from __future__ import annotations

from tephra.llm.queries import REFERRED

# Host rules as (verdict, host, path), fixed values of the contract.
RULES_SQL = """(VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS r(verdict, host, path)"""

URL_FILTER = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest,
           regexp_matches(url, '{REFERRED}') AS referred
    FROM pages
), parts AS (
    SELECT page_id,
           coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
           list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'),
                     lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS query,
           rest IS NOT NULL AS whole, referred
    FROM cut
), named AS (
    SELECT page_id, host, path, referred,
           CASE WHEN whole THEN regexp_replace(host, '^(www|m)\\.', '') || rtrim(path, '/')
                || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS canonical
    FROM parts
), listed AS (
    SELECT DISTINCT canonical AS url FROM named WHERE referred
), ruled AS (
    SELECT n.page_id, n.host, n.path, n.canonical,
           arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
           arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM named n LEFT JOIN {RULES_SQL}
      ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
    GROUP BY ALL
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN url IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, canonical
FROM ruled LEFT JOIN listed ON canonical = url
"""


# Ids are unique in the given table; every vector there has the same length.
TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""


def all_sql() -> dict[str, str]:
    return {"op5_url_filter": URL_FILTER, "op11_voronoi_topk": TOP_K}
