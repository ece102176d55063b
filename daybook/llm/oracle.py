"""DuckDB forms of the queries that SQL can express."""

from __future__ import annotations

from daybook.llm import secret_scan

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2 = f"""
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, i, line, coalesce(doc_id <> keeper, false) AS gone FROM lines LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP7 = """
WITH whole AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and([coalesce(isfinite(x), false) FOR x IN embedding])),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


_PATTERNS = [
    (0, "assign", secret_scan.ASSIGN, 1, 6),
    (1, "access", "AKIA[A-Z0-9]+", 0, 20),
    (2, "hex", "[0-9a-f]{24,}", 0, 24),
    *[(3 + n, name, f"[{letters}]{{{secret_scan.LEAST},}}", 0, secret_scan.LEAST) for n, (name, (letters, _)) in enumerate(secret_scan.CLASSES.items())],
]
_LIMITS = [secret_scan.most(bits) for _, bits in secret_scan.CLASSES.values()]


def _found(kind: int, name: str, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT r, kind, name, m, till - length(m) AS s, till AS e FROM (
    SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY i) AS till FROM (
      SELECT r, {kind} AS kind, '{name}' AS name, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g
      FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS gs FROM texts)
      WHERE len(ms) > 0))
  WHERE length(regexp_extract(m, '{pattern}', {group})) >= {least}"""


OP11 = f"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_found(*p) for p in _PATTERNS)}),
base AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) AS b
  FROM found WHERE kind < 3 GROUP BY r),
candidates AS (
  SELECT * FROM found
  WHERE kind >= 3 AND NOT regexp_full_match(m, '{"|".join(f"(?:{a})" for a in secret_scan.ALLOWED)}')),
windows AS (SELECT *, unnest(range(0, length(m) - {secret_scan.WINDOW - 1})) AS w FROM candidates),
letters AS (
  SELECT r, kind, name, s, w, substr(m, w + j, 1) AS x, count(*) AS c
  FROM windows, (SELECT unnest(range(1, {secret_scan.WINDOW + 1})) AS j) GROUP BY ALL),
high AS (
  SELECT r, kind, name, s + w AS s, s + w + {secret_scan.WINDOW} AS e, s AS first
  FROM letters GROUP BY r, kind, name, s, w
  HAVING sum({secret_scan.terms()}[c + 1]) <= CASE kind {" ".join(f"WHEN {3 + n} THEN {x}" for n, x in enumerate(_LIMITS))} END),
stretches AS (
  SELECT r, kind, name, min(s) AS s, max(e) AS e FROM (
    SELECT *, count(*) FILTER (apart) OVER (PARTITION BY r, kind, first ORDER BY s) AS stretch FROM (
      SELECT *, coalesce(s > lag(e) OVER (PARTITION BY r, kind, first ORDER BY s), true) AS apart FROM high))
  GROUP BY r, kind, name, first, stretch),
every AS (
  SELECT r, string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans FROM (
    SELECT r, kind, name, s, e FROM found WHERE kind < 3 UNION ALL SELECT r, kind, name, s, e FROM stretches)
  GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN base USING (r) LEFT JOIN every USING (r)
"""


def _round(n: int) -> str:
    return f""",
dealt{n} AS MATERIALIZED (
  SELECT r, k.v, c.n, CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(k.v, c.v)]) AS BIGINT) AS d
  FROM kept k, centroids{n} c QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c.n) = 1),
means{n} AS (
  SELECT n, list(CAST((total - ((total % m) + m) % m) // m AS BIGINT) ORDER BY i) AS v FROM (
    SELECT n, i, sum(v[i]) AS total, count(*) AS m
    FROM dealt{n}, (SELECT unnest(range(1, 65)) AS i) GROUP BY n, i) GROUP BY n),
centroids{n + 1} AS MATERIALIZED (
  SELECT c.n, coalesce(m.v, c.v) AS v FROM centroids{n} c LEFT JOIN means{n} m ON m.n = c.n)"""


OP12 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND list_bool_and([coalesce(isfinite(x), false) FOR x IN embedding])),
centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS n, v FROM kept QUALIFY n < 40)
{"".join(_round(n) for n in range(6))}
SELECT vec_id, CAST(d.n AS INTEGER) AS cluster, d.d AS distance,
       CAST(sum(d.d) OVER (PARTITION BY d.n) AS BIGINT) AS cluster_inertia,
       CAST(sum(d.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM dealt5 d JOIN kept k USING (r) JOIN centroids5 c ON c.n = d.n
"""

OP13 = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, length(t) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT *, [CAST('0x' || substr(h, 1 + 8 * i, 8) AS BIGINT) FOR i IN range(0, 4)] AS x,
         least(x[1] % (n + 1), x[2] % (n + 1)) AS low, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS high FROM texts),
formed AS (
  SELECT *, CASE WHEN n = 0 OR regexp_matches(t, '<[PSM]>') OR x[3] % 100 >= 90 THEN 'plain'
                 WHEN x[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         '<P>' || substr(t, 1, low) AS p, '<S>' || substr(t, high + 1) AS s, '<M>' || substr(t, low + 1, high - low) AS m
  FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM formed
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": OP2, "op7_top_k": OP7, "op11_secret_scan": OP11, "op12_centroids": OP12, "op13_fill_middle": OP13,
    }
