"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

They are written independently from the Spark code, directly over the generated tables: the store view,
the standard request, the type and index catalogs and the manifest order are re-stated as SQL common table
expressions, and each query's expected result is computed from those (no JSON documents are parsed:
typed fields are compared).
"""

from __future__ import annotations

STORE = """
store AS (
    SELECT 'analytics' AS client, 'tenant_' || CAST(user_id % 2 AS VARCHAR) AS tenant, event_type AS type,
           CAST(event_id AS VARCHAR) AS id, value AS payload
    FROM events
    UNION ALL
    SELECT 'corpus', lang, source, CAST(doc_id AS VARCHAR), CAST(n_chars AS DOUBLE) FROM documents
    UNION ALL
    SELECT 'web', 'site_' || CAST(page_id % 2 AS VARCHAR), 'page', CAST(page_id AS VARCHAR),
           CAST(strlen(html) AS DOUBLE) FROM pages
)"""

REQUEST = """
request AS (
    SELECT * FROM (VALUES
        (0, 'analytics', 'tenant_0', ['click', 'view', 'click', 'missing']),
        (1, 'analytics', 'tenant_1', CAST(NULL AS VARCHAR[])),
        (2, 'analytics', 'tenant_1', CAST([] AS VARCHAR[])),
        (3, 'analytics', 'tenant_0', ['click']),
        (4, 'analytics', 'nobody', CAST(NULL AS VARCHAR[])),
        (5, 'corpus', 'en', CAST(NULL AS VARCHAR[])),
        (6, 'corpus', 'fr', ['src1', 'src3', 'src5']),
        (7, 'corpus', 'de', ['nope']),
        (8, 'web', 'site_0', CAST(NULL AS VARCHAR[])),
        (9, 'web', 'site_1', ['page', 'page'])
    ) AS t(ord, client, tenant, types)
)"""

CATALOG = """
catalog AS (SELECT client, tenant, type, count(*) AS n_docs FROM store GROUP BY client, tenant, type)"""

RESOLVED = """
resolved AS (
    SELECT CAST(r.ord AS INTEGER) AS ord, c.client, c.tenant, c.type, c.n_docs,
           'f_' || substr(sha256(CAST(r.ord AS VARCHAR)
                || '|' || CAST(length(c.client) AS VARCHAR) || ':' || c.client
                || '|' || CAST(length(c.tenant) AS VARCHAR) || ':' || c.tenant
                || '|' || CAST(length(c.type) AS VARCHAR) || ':' || c.type), 1, 32) AS file
    FROM request r JOIN catalog c
      ON c.client = r.client AND c.tenant = r.tenant
     AND (coalesce(len(r.types), 0) = 0 OR list_contains(r.types, c.type))
)"""

MANIFEST = """
manifest AS (
    SELECT CAST(row_number() OVER (ORDER BY ord, type) - 1 AS INTEGER) AS ord, ord AS req_ord,
           client, tenant, type, file, n_docs
    FROM resolved
)"""

TOUCHED = """
touched AS (SELECT DISTINCT client, tenant, type FROM manifest)"""

INDEXES = """
idx AS (
    SELECT client, tenant, type, 0 AS pos, '{"_id":1}' AS keys, '{"name":"_id_"}' AS options FROM catalog
    UNION ALL SELECT client, tenant, type, 1, '{"user_id":1,"ts":-1}', '{"name":"user_ts","unique":false}'
        FROM catalog WHERE client = 'analytics'
    UNION ALL SELECT client, tenant, type, 1, '{"n_chars":1}', NULL FROM catalog WHERE client = 'corpus'
    UNION ALL SELECT client, tenant, type, 2, '{"text":"text","lang":"text"}',
        '{"name":"text_idx","weights":{"$all":1},"default_language":"' || tenant || '"}'
        FROM catalog WHERE client = 'corpus' AND TRY_CAST(substr(type, 4, 10) AS INTEGER) % 2 = 0
    UNION ALL SELECT client, tenant, type, 2, '{"text":"text","lang":"text"}',
        '{"name":"text_idx","weights":{"text":10,"lang":5}}'
        FROM catalog WHERE client = 'corpus' AND TRY_CAST(substr(type, 4, 10) AS INTEGER) % 2 = 1
    UNION ALL SELECT client, tenant, type, 3, '{}', '{"name":"empty"}'
        FROM catalog WHERE client = 'analytics' AND type = 'error'
    UNION ALL SELECT client, tenant, type, 3, '{"_id":1,"user_id":1}', '{"name":"id_user","sparse":null}'
        FROM catalog WHERE client = 'analytics' AND type = 'purchase'
    UNION ALL SELECT client, tenant, type, 4, '{"_id":-1}', NULL
        FROM catalog WHERE client = 'analytics' AND type = 'view'
),
usable AS (
    SELECT * FROM idx
    WHERE NOT (json_type(keys) = 'OBJECT' AND len(list_filter(json_keys(keys), lambda x: x <> '_id')) = 0)
),
attached AS (
    SELECT client, tenant, type, count(*) AS n, string_agg(keys, ';' ORDER BY pos) AS ks,
           string_agg(options, ';' ORDER BY pos) AS os
    FROM usable GROUP BY client, tenant, type
)"""

# manifest (request order) index definitions as they are sent for creation, with their names
PREPARED = """
mix AS (
    SELECT r.ord, r.client, r.tenant, r.type,
           CAST(row_number() OVER (PARTITION BY r.ord, r.client, r.tenant, r.type ORDER BY u.pos) - 1 AS INTEGER) AS pos,
           u.keys, u.options
    FROM resolved r JOIN usable u ON u.client = r.client AND u.tenant = r.tenant AND u.type = r.type
),
prepared AS (
    SELECT ord, client, tenant, type, pos, keys,
           regexp_replace(CASE WHEN coalesce(list_contains(json_keys(options, '$.weights'), '$all'), false)
                               THEN CAST(json_merge_patch(options, '{"weights":null}') AS VARCHAR)
                               ELSE options END, ',?"[^"]*":null', '', 'g') AS options
    FROM mix
),
named AS (
    SELECT *, coalesce(json_extract_string(options, '$.name'), 'keys:' || keys) AS name FROM prepared
),
existing AS (
    SELECT client, tenant, type, '{"user_id":1,"ts":-1}' AS keys, '{"name":"user_ts"}' AS options, 'user_ts' AS name
    FROM catalog WHERE client = 'analytics' AND tenant = 'tenant_0'
    UNION ALL
    SELECT client, tenant, type, '{"other":1}', '{"name":"user_ts"}', 'user_ts'
    FROM catalog WHERE client = 'analytics' AND tenant = 'tenant_1'
)"""

# the target of the restore queries after the restore: touched types hold every stored document fresh,
# the others keep the stale documents of ids divisible by 3
UPSERTED = """
upserted AS (
    SELECT client, tenant, type, id, false AS stale, payload FROM store s
    WHERE EXISTS (SELECT 1 FROM touched t WHERE t.client = s.client AND t.tenant = s.tenant AND t.type = s.type)
    UNION ALL
    SELECT client, tenant, type, id, true AS stale, CAST(NULL AS DOUBLE) AS payload FROM store s
    WHERE CAST(id AS BIGINT) % 3 = 0
      AND NOT EXISTS (SELECT 1 FROM touched t WHERE t.client = s.client AND t.tenant = s.tenant AND t.type = s.type)
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (STORE, REQUEST, CATALOG, RESOLVED)

SQL = {
    "type_catalog": _with(STORE, CATALOG) + "SELECT client, tenant, type, n_docs FROM catalog",

    "resolve_types": _with(*BASE) + "SELECT ord, client, tenant, type, n_docs, file FROM resolved",

    "document_scan": _with(*BASE) + """
SELECT r.ord, r.client, r.tenant, r.type, s.id, s.payload
FROM resolved r JOIN store s ON s.client = r.client AND s.tenant = r.tenant AND s.type = r.type""",

    "index_filter": _with(STORE, CATALOG, INDEXES) + "SELECT client, tenant, type, pos, keys, options FROM usable",

    "index_attach": _with(*BASE, INDEXES) + """
SELECT r.ord, r.client, r.tenant, r.type, r.file, a.n IS NOT NULL AS has_indexes,
       CAST(coalesce(a.n, 0) AS INTEGER) AS n_indexes,
       a.ks AS index_keys, a.os AS index_options
FROM resolved r LEFT JOIN attached a ON a.client = r.client AND a.tenant = r.tenant AND a.type = r.type""",

    "index_weights": _with(STORE, CATALOG, INDEXES) + """
SELECT client, tenant, type, pos, keys,
       coalesce(list_contains(json_keys(options, '$.weights'), '$all'), false) AS has_all,
       CASE WHEN coalesce(list_contains(json_keys(options, '$.weights'), '$all'), false)
            THEN CAST(json_merge_patch(options, '{"weights":null}') AS VARCHAR) ELSE options END AS options
FROM idx""",

    "index_ensure": _with(*BASE, INDEXES, PREPARED) + """,
firsts AS (
    SELECT client, tenant, type, name, arg_min(keys, ord * 1000 + pos) AS keys,
           arg_min(options, ord * 1000 + pos) AS options
    FROM named GROUP BY client, tenant, type, name
),
created AS (
    SELECT * FROM firsts f WHERE NOT EXISTS (
        SELECT 1 FROM existing e
        WHERE e.client = f.client AND e.tenant = f.tenant AND e.type = f.type AND e.name = f.name)
)
SELECT client, tenant, type, name, keys, options, false AS created FROM existing
UNION ALL
SELECT client, tenant, type, name, keys, options, true AS created FROM created""",

    "backup_manifest": _with(*BASE, MANIFEST, INDEXES) + """
SELECT m.ord, m.client, m.tenant, m.type, m.file, m.n_docs, a.n IS NOT NULL AS has_indexes,
       CAST(coalesce(a.n, 0) AS INTEGER) AS n_indexes
FROM manifest m LEFT JOIN attached a ON a.client = m.client AND a.tenant = m.tenant AND a.type = m.type""",

    "backup_roundtrip": _with(*BASE, MANIFEST) + """
SELECT m.ord, m.client, m.tenant, m.type, s.id, s.payload
FROM manifest m JOIN store s ON s.client = m.client AND s.tenant = m.tenant AND s.type = m.type""",

    "backup_jsonl": _with(*BASE, MANIFEST) + """
SELECT m.ord, m.client, m.tenant, m.type, s.id, s.payload
FROM manifest m JOIN store s ON s.client = m.client AND s.tenant = m.tenant AND s.type = m.type""",

    "manifest_select": _with(*BASE, MANIFEST) + """
SELECT ord, client, CASE WHEN tenant = 'tenant_0' THEN 'tenant_9' ELSE tenant END AS tenant, type, file, n_docs
FROM manifest WHERE type IN ('click', 'src1', 'src3')""",

    "frame_arrays": _with(*BASE, MANIFEST) + """
SELECT m.ord, m.client, m.tenant, m.type, s.id, s.payload
FROM manifest m JOIN store s ON s.client = m.client AND s.tenant = m.tenant AND s.type = m.type""",

    "batch_sizes": _with(*BASE, MANIFEST) + """,
numbered AS (
    SELECT m.ord, m.client, m.tenant, m.type,
           (row_number() OVER (PARTITION BY m.ord ORDER BY s.id) - 1) // 1000 AS batch
    FROM manifest m JOIN store s ON s.client = m.client AND s.tenant = m.tenant AND s.type = m.type
)
SELECT ord, client, tenant, type, CAST(batch AS INTEGER) AS batch, count(*) AS docs, count(*) = 1000 AS full
FROM numbered GROUP BY ord, client, tenant, type, batch""",

    "restore_totals": _with(*BASE, MANIFEST) + """,
loaded AS (
    SELECT m.ord, m.client, m.tenant, m.type, s.id
    FROM manifest m JOIN store s ON s.client = m.client AND s.tenant = m.tenant AND s.type = m.type
),
firsts AS (SELECT client, tenant, type, id, min(ord) AS first_ord FROM loaded GROUP BY client, tenant, type, id),
ins AS (SELECT first_ord AS ord, count(*) AS n FROM firsts WHERE CAST(id AS BIGINT) % 3 <> 0 GROUP BY first_ord),
tot AS (SELECT ord, count(*) AS n FROM loaded GROUP BY ord)
SELECT m.ord, m.client, m.tenant, m.type, coalesce(tot.n, 0) AS total, coalesce(ins.n, 0) AS inserted,
       coalesce(tot.n, 0) - coalesce(ins.n, 0) AS replaced
FROM manifest m LEFT JOIN tot ON tot.ord = m.ord LEFT JOIN ins ON ins.ord = m.ord""",

    "restore_upsert": _with(*BASE, MANIFEST, TOUCHED, UPSERTED) + "SELECT * FROM upserted",

    "migrate": _with(*BASE, MANIFEST, TOUCHED) + """
SELECT client, tenant, type, id, false AS stale, payload FROM store s
WHERE EXISTS (SELECT 1 FROM touched t WHERE t.client = s.client AND t.tenant = s.tenant AND t.type = s.type)""",

    "stream_restore": _with(*BASE, MANIFEST, TOUCHED, UPSERTED) + "SELECT * FROM upserted",

    "stream_restore_widened": _with(*BASE, MANIFEST, TOUCHED, UPSERTED) + """
        SELECT * FROM upserted
        UNION ALL BY NAME
        SELECT s.client, 'tenant_9' AS tenant, s.type, s.id, false AS stale, s.payload
        FROM store s JOIN touched t ON t.client = s.client AND t.tenant = s.tenant AND t.type = s.type WHERE s.tenant = 'tenant_0'""",
    "target_catalog": _with(*BASE, MANIFEST, TOUCHED, UPSERTED) + """
        SELECT client, tenant, type, count(*) AS n_docs FROM upserted GROUP BY client, tenant, type""",
    "verify_documents": _with(*BASE, MANIFEST, TOUCHED) + """
SELECT s.client, s.tenant, s.type,
       count(*) FILTER (WHERE CAST(s.id AS BIGINT) % 7 = 1) AS missing,
       count(*) FILTER (WHERE CAST(s.id AS BIGINT) % 13 = 3) AS extra,
       count(*) FILTER (WHERE CAST(s.id AS BIGINT) % 7 <> 1 AND CAST(s.id AS BIGINT) % 11 = 2) AS different,
       count(*) FILTER (WHERE CAST(s.id AS BIGINT) % 7 <> 1 AND CAST(s.id AS BIGINT) % 11 <> 2) AS same
FROM store s
WHERE EXISTS (SELECT 1 FROM touched t WHERE t.client = s.client AND t.tenant = s.tenant AND t.type = s.type)
GROUP BY s.client, s.tenant, s.type""",

    "verify_indexes": _with(*BASE, INDEXES, PREPARED) + """
SELECT ord, client, tenant, type, pos, name, keys, options FROM named n
WHERE NOT EXISTS (SELECT 1 FROM existing e
                  WHERE e.client = n.client AND e.tenant = n.tenant AND e.type = n.type AND e.name = n.name)""",

    "drop_type": _with(*BASE, MANIFEST, TOUCHED, UPSERTED) + """
SELECT client, tenant, type, count(*) AS n FROM upserted
WHERE NOT ((client = 'analytics' AND tenant = 'tenant_1' AND type IN ('click', 'view'))
           OR (client = 'corpus' AND tenant = 'en' AND type = 'src0'))
GROUP BY client, tenant, type""",
}

# each type's two definitions of the text queries, as they are written
TYPED = """
typed AS (
    SELECT client, tenant, type, 0 AS pos, '{"k":1.50,"n":' || n_docs || '.50}' AS keys,
           '{"z":1e2,"weights":{"$all":1},"a":' || n_docs || '.50,"name":"w"}' AS options,
           '{"z":1e2,"a":' || n_docs || '.50,"name":"w"}' AS sent
    FROM catalog
    UNION ALL
    SELECT client, tenant, type, 1, '{"b":1,"a":' || n_docs || '}',
           '{"weights":"{\\"$all\\":1}","b":' || n_docs || '.10,"a":12345678901234567890123}',
           '{"weights":"{\\"$all\\":1}","b":' || n_docs || '.10,"a":12345678901234567890123}'
    FROM catalog
)"""

SQL |= {
    "backup_skip_indexes": _with(*BASE, MANIFEST) + "SELECT ord, client, tenant, type, file, n_docs, false AS has_indexes FROM manifest",
    "batch_assign": SQL["batch_sizes"],
    "stream_restore_conflicts": """
SELECT 'corpus' AS client, 'all' AS tenant, 'doc' AS type, CAST(doc_id AS VARCHAR) AS id, doc_id % 3 = 0 AS stale,
       CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CAST(n_chars AS DOUBLE) END AS payload
FROM documents""",
    "restore_idless": """
SELECT CAST(run AS INTEGER) AS run, count(*) AS total, CASE WHEN run = 0 THEN count(*) ELSE 0 END AS inserted,
       CASE WHEN run = 0 THEN 0 ELSE count(*) END AS replaced
FROM documents, (VALUES (0), (1)) AS r(run) GROUP BY run""",
    "manifest_text": _with(*BASE, MANIFEST, TYPED) + """
SELECT m.ord, client, tenant, type, CAST(pos AS INTEGER) AS pos, keys, options
FROM manifest m JOIN typed USING (client, tenant, type)""",
    "index_options_text": _with(STORE, CATALOG, TYPED) + "SELECT client, tenant, type, pos, sent AS options FROM typed",
    "migrate_onward": SQL["migrate"],
}
