"""The same queries in SQL. Metadata is computed from the hash digits, not from the binaries."""

from __future__ import annotations

_WITH = """
WITH docs AS (
  SELECT doc_id, concat(CASE WHEN length(source) = 5 THEN '1' ELSE '0' END, '/', source, '/',
                        cast(doc_id AS varchar)) AS name,
         md5(text) AS hash, cast(strlen(text) AS int) AS size, length(source) = 5 AS malicious
  FROM documents),
storage AS (
  SELECT name, hash, size, malicious, TIMESTAMP '2023-12-01 00:00:00' AS sync_time FROM docs),
digits AS (
  SELECT *, instr('0123456789abcdef', substr(hash, 1, 1)) - 1 AS h1,
            instr('0123456789abcdef', substr(hash, 2, 1)) - 1 AS h2,
            instr('0123456789abcdef', substr(hash, 3, 1)) - 1 AS h3,
            instr('0123456789abcdef', substr(hash, 4, 1)) - 1 AS h4
  FROM docs),
expected AS (
  SELECT doc_id, name, hash, size, malicious,
    CASE WHEN h1 < 15 THEN CASE WHEN h1 % 2 = 0 THEN 'x64' ELSE 'x32' END END AS architecture,
    CASE WHEN h1 < 15 THEN cast(h2 AS int) END AS num_imports,
    CASE WHEN h1 < 15 THEN CASE WHEN h3 % 2 = 0 THEN cast(h4 AS int) ELSE 0 END END AS num_exports,
    CASE WHEN h1 < 15 THEN CASE WHEN h3 % 2 = 0 THEN 'dll' ELSE 'exe' END END AS type,
    CASE WHEN h1 < 15 THEN 'EXTRACTED' ELSE 'ERROR' END AS status
  FROM digits),
extracted AS (
  SELECT name, hash, size, architecture, num_imports, num_exports, type, status, malicious,
         TIMESTAMP '2023-12-05 00:00:00' AS created_at
  FROM expected WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
waiting AS (
  SELECT * FROM storage s WHERE NOT EXISTS (
    SELECT 1 FROM extracted e WHERE e.name = s.name AND e.hash = s.hash)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY malicious
                               ORDER BY md5(concat_ws('/', hash, name)), name, hash) AS place
  FROM waiting),
first_known AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY created_at, name) AS n
                 FROM extracted) WHERE n = 1),
before AS (
  SELECT name, hash, size + 1 AS size, malicious, TIMESTAMP '2023-12-01 00:00:00' AS sync_time
  FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)
  UNION ALL
  SELECT name, md5(hash), size + 1, malicious, TIMESTAMP '2023-12-01 00:00:00'
  FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)),
incoming AS (
  SELECT name, hash, size, malicious, TIMESTAMP '2023-12-02 00:00:00' AS sync_time, 1 AS ord
  FROM docs
  UNION ALL
  SELECT name, hash, size + 7, malicious, TIMESTAMP '2023-12-03 00:00:00', 2
  FROM docs WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)),
damaged AS (
  SELECT name, hash FROM docs
  UNION ALL
  SELECT name, hash FROM docs WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
  UNION ALL
  SELECT name, NULL FROM docs WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0))
"""

_AS_OF = "TIMESTAMP '2023-12-06 00:00:00' AS created_at"


def _extraction(batch: str, seed: str = "first_known") -> str:
    """Result rows of a batch: from the known twin, else from the first file with that content."""
    return f"""
, batch AS ({batch}),
remaining AS (SELECT * FROM batch WHERE hash NOT IN (SELECT hash FROM {seed})),
parsed AS (
  SELECT * FROM (
    SELECT x.*, row_number() OVER (PARTITION BY x.hash ORDER BY x.malicious, x.name) AS n
    FROM expected x JOIN remaining r ON x.name = r.name AND x.hash = r.hash) WHERE n = 1),
results AS (
  SELECT b.name, k.hash, k.size, k.architecture, k.num_imports, k.num_exports, k.type, k.status,
         k.malicious, {_AS_OF}
  FROM batch b JOIN {seed} k ON b.hash = k.hash
  UNION ALL
  SELECT r.name, p.hash, p.size, p.architecture, p.num_imports, p.num_exports, p.type, p.status,
         p.malicious, {_AS_OF}
  FROM remaining r JOIN parsed p ON r.hash = p.hash)
"""


_RESULT = "SELECT * FROM results"
_UPSERTED = """
, folded AS (
  SELECT name, hash, arg_min(size, ord) AS size, arg_min(malicious, ord) AS malicious,
         arg_max(sync_time, ord) AS sync_time
  FROM incoming {where} GROUP BY name, hash)
SELECT coalesce(t.name, i.name) AS name, coalesce(t.hash, i.hash) AS hash,
       coalesce(t.size, i.size) AS size, coalesce(t.malicious, i.malicious) AS malicious,
       coalesce(i.sync_time, t.sync_time) AS sync_time
FROM before t FULL JOIN folded i ON t.name = i.name AND t.hash = i.hash
"""
_PE_COLUMNS = "name, hash, architecture, num_imports, num_exports, type, status"

# A content that failed was tried as often as its second digit says, else once. Between the results and
# the run lie 24 hours; the wait is an hour, doubled with each attempt, and six attempts are the most.
_RETRIES = """
, failed AS (
  SELECT *, attempts < 6 AND power(2, attempts - 1) <= 24 AS due FROM (
    SELECT DISTINCT e.hash, g.h2, g.h3, g.h4, cast(greatest(g.h2, 1) AS int) AS attempts,
      TIMESTAMP '2023-12-05 00:00:00' AS last_tried
    FROM extracted e JOIN digits g ON e.hash = g.hash WHERE e.status = 'ERROR')),
mended AS (
  SELECT hash, 'x64' AS architecture, cast(h2 AS int) AS num_imports, cast(h4 AS int) AS num_exports,
    'dll' AS type, 'EXTRACTED' AS status
  FROM failed WHERE due AND h3 % 2 = 0)
"""

_TAILS = {
    "listing_catalogue": "SELECT * FROM storage",
    "one_prefix_listing": "SELECT name, hash, malicious FROM storage WHERE name LIKE '1%'",
    "class_filter": "SELECT hash FROM storage WHERE malicious",
    "unprocessed_anti": "SELECT * FROM waiting",
    "unprocessed_batch": """SELECT * FROM waiting WHERE NOT malicious
        ORDER BY md5(concat_ws('/', hash, name)), name, hash LIMIT 100""",
    "balanced_batch": "SELECT * EXCLUDE (place) FROM ranked WHERE place <= 201 // 2",
    "large_batch": "SELECT * EXCLUDE (place) FROM ranked WHERE place <= 75",
    "distinct_hashes": "SELECT DISTINCT hash FROM storage",
    "one_per_hash": """SELECT name, hash, size, malicious FROM (
        SELECT *, row_number() OVER (PARTITION BY hash ORDER BY malicious, name) AS n FROM storage)
        WHERE n = 1""",
    "matching_rows": "SELECT * FROM extracted WHERE hash IN (SELECT hash FROM waiting)",
    "representatives": "SELECT * EXCLUDE (n) FROM first_known",
    "carry_metadata": f"""SELECT w.name, k.hash, k.size, k.architecture, k.num_imports, k.num_exports,
        k.type, k.status, k.malicious, {_AS_OF} FROM waiting w JOIN first_known k ON w.hash = k.hash""",
    "remaining_files": "SELECT * FROM waiting WHERE hash NOT IN (SELECT hash FROM extracted)",
    "fan_out": f"""SELECT s.name, p.hash, p.size, p.architecture, p.num_imports, p.num_exports, p.type,
        p.status, p.malicious, {_AS_OF} FROM storage s LEFT JOIN (
          SELECT *, row_number() OVER (PARTITION BY hash ORDER BY malicious, name) AS n FROM expected) p
        ON s.hash = p.hash AND p.n = 1""",
    "count_by_prefix": "SELECT substr(name, 1, 1) AS prefix, count(*) AS files FROM storage GROUP BY 1",
    "incoming_conflicts": """SELECT name, hash, arg_min(size, ord) AS size,
        arg_min(malicious, ord) AS malicious, arg_max(sync_time, ord) AS sync_time
        FROM incoming GROUP BY name, hash""",
    "upsert_catalogue": _UPSERTED.format(where=""),
    "integrity_violations": """SELECT 'not_null:hash' AS rule, CAST(NULL AS varchar) AS name,
        CAST(NULL AS varchar) AS hash, count(*) AS rows FROM damaged WHERE hash IS NULL
        HAVING count(*) > 0
        UNION ALL
        SELECT 'unique:name,hash', name, hash, count(*) FROM damaged WHERE hash IS NOT NULL
        GROUP BY name, hash HAVING count(*) > 1""",
    "content_hash": "SELECT name, hash FROM docs",
    "pe_metadata": f"SELECT {_PE_COLUMNS} FROM expected",
    "pe_metadata_udf": f"SELECT {_PE_COLUMNS} FROM expected WHERE name NOT LIKE '%7'",
    "dedup_extract": _extraction("SELECT * FROM waiting", "(SELECT * FROM first_known WHERE false)")
    + _RESULT,
    "incremental_extract": _extraction("SELECT * FROM waiting WHERE malicious") + _RESULT,
    "balanced_extract": _extraction("SELECT * FROM ranked WHERE place <= 201 // 2") + _RESULT,
    "incremental_batch": _extraction("SELECT * FROM ranked WHERE NOT malicious AND place <= 99") + _RESULT,
    "store_extract": _extraction("SELECT * FROM ranked WHERE place <= 201 // 2") + _RESULT,
    "object_listing": """SELECT replace(name, '/', '-') AS Key, '"' || hash || '"' AS ETag, CAST(size AS bigint) AS Size
        FROM storage""",
    "keyed_sync": _UPSERTED.format(where="WHERE ord = 1"),
    "partitioned_sync": _UPSERTED.format(where="WHERE ord = 1"),
    "contents_by_prefix": """SELECT substr(name, 1, 1) AS prefix, count(*) AS files,
        count(DISTINCT hash) AS exact, true AS close
        FROM (SELECT name, hash FROM before UNION ALL SELECT name, hash FROM storage) GROUP BY 1""",
    "verified_bodies": "SELECT name, name NOT LIKE '%3' AS verified FROM storage",
    "slot_extract": _extraction("SELECT * FROM ranked WHERE place <= 201 // 2") + _RESULT,
    "unprocessed_prefiltered": "SELECT * FROM waiting",
    "retried_results": f"""{_RETRIES}
        SELECT e.name, e.hash, e.size, coalesce(m.architecture, e.architecture) AS architecture,
          coalesce(m.num_imports, e.num_imports) AS num_imports, coalesce(m.num_exports, e.num_exports) AS num_exports,
          coalesce(m.type, e.type) AS type, coalesce(m.status, e.status) AS status, e.malicious,
          CASE WHEN m.hash IS NULL THEN e.created_at ELSE TIMESTAMP '2023-12-06 00:00:00' END AS created_at
        FROM extracted e LEFT JOIN mended m ON e.hash = m.hash""",
    "retry_ledger": f"""{_RETRIES}
        SELECT hash, attempts, last_tried FROM failed WHERE h2 > 0 AND NOT due
        UNION ALL
        SELECT hash, attempts + 1, TIMESTAMP '2023-12-06 00:00:00' FROM failed WHERE due AND h3 % 2 = 1""",
    "append_results": _extraction("SELECT * FROM ranked WHERE place <= 201 // 2")
    + _RESULT
    + " UNION ALL SELECT * FROM extracted",
    "sync_catalogue": _UPSERTED.format(where="WHERE ord = 1"),
    "microbatch_sync": _UPSERTED.format(where="WHERE ord = 1"),
}

ORACLE_SQL: dict[str, str] = {
    name: _WITH + ("" if tail.lstrip().startswith(",") else "\n") + tail
    for name, tail in _TAILS.items()
}
