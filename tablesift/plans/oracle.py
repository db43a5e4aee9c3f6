"""DuckDB SQL text for the profiling queries (the correctness oracle).

These are deliberately written the *naive* way - distinct (attribute, value)
rows, a self join on the value, counts compared with totals - so that they
check the Spark plans by an independent route.
"""

from __future__ import annotations

from tablesift.plans.schemas import TABLE_COLUMNS

# Fixed value: Java String.trim() as a DuckDB regular expression.
SQL_JAVA_TRIM = r"regexp_replace({v}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def value_sql(col: str, trim: bool) -> str:
    v = f"CAST({_q(col)} AS VARCHAR)"
    return SQL_JAVA_TRIM.format(v=v) if trim else v


def attribute_values_sql(tables, preset: str, columns: dict[str, list[str]] | None = None) -> str:
    """``SELECT DISTINCT`` attribute rows: ``(attr, v)`` for ``trimmed``
    (bare names), ``(t, c, v)`` for ``strict`` (null kept as a value)."""
    parts = []
    for t in tables:
        for c in (columns or TABLE_COLUMNS)[t]:
            if preset == "trimmed":
                parts.append(f"SELECT {_lit(c)} AS attr, {value_sql(c, True)} AS v FROM {t}")
            else:
                parts.append(f"SELECT {_lit(t)} AS t, {_lit(c)} AS c, {value_sql(c, False)} AS v FROM {t}")
    body = "\n  UNION ALL ".join(parts)
    if preset == "trimmed":
        return f"SELECT DISTINCT attr, v FROM (\n  {body}\n) u WHERE v IS NOT NULL AND v <> ''"
    return f"SELECT DISTINCT t, c, v FROM (\n  {body}\n) u"


def unary_inds_sql(tables, preset: str) -> str:
    av = attribute_values_sql(tables, preset)
    if preset == "trimmed":
        return f"""
WITH av AS ({av}),
tot AS (SELECT attr, count(*) AS n FROM av GROUP BY attr),
common AS (
  SELECT a.attr AS dep, b.attr AS ref, count(*) AS n
  FROM av a JOIN av b ON a.v = b.v AND a.attr <> b.attr
  GROUP BY a.attr, b.attr)
SELECT c.dep AS dependent, c.ref AS referenced
FROM common c JOIN tot ON c.dep = tot.attr AND c.n = tot.n"""
    return f"""
WITH av AS ({av}),
tot AS (SELECT t, c, count(*) AS n FROM av GROUP BY t, c),
common AS (
  SELECT a.t AS dt, a.c AS dc, b.t AS rt, b.c AS rc, count(*) AS n
  FROM av a JOIN av b ON a.v IS NOT DISTINCT FROM b.v AND NOT (a.t = b.t AND a.c = b.c)
  GROUP BY a.t, a.c, b.t, b.c)
SELECT dt AS dependent_table, dc AS dependent_column, rt AS referenced_table, rc AS referenced_column
FROM common JOIN tot ON common.dt = tot.t AND common.dc = tot.c AND common.n = tot.n"""


def ind_lines_grouped_sql(tables) -> str:
    return f"""
WITH ind AS ({unary_inds_sql(tables, "trimmed")})
SELECT dependent || ' < ' || string_agg(referenced, ', ' ORDER BY referenced) AS line
FROM ind GROUP BY dependent"""


def ind_lines_pairs_sql(tables) -> str:
    return f"""
WITH ind AS ({unary_inds_sql(tables, "strict")})
SELECT split_part(dependent_table, '.', 1) || ' -> ' || split_part(referenced_table, '.', 1)
       || ': [' || dependent_column || '] c [' || referenced_column || ']' AS line
FROM ind"""


def attribute_values_query_sql(tables) -> str:
    return f"SELECT attr AS attribute, v AS value FROM ({attribute_values_sql(tables, 'trimmed')}) x"


def attribute_profile_sql(tables) -> str:
    parts = []
    for t in tables:
        for c in TABLE_COLUMNS[t]:
            parts.append(f"SELECT {_lit(c)} AS attr, {value_sql(c, True)} AS v FROM {t}")
    body = "\n  UNION ALL ".join(parts)
    return f"""
WITH cells AS (
  {body}
)
SELECT attr AS attribute,
       count(*)::BIGINT AS n_rows,
       count(*) FILTER (WHERE v IS NOT NULL AND v <> '')::BIGINT AS n_values,
       count(DISTINCT v) FILTER (WHERE v IS NOT NULL AND v <> '')::BIGINT AS n_distinct
FROM cells GROUP BY attr"""


def attribute_sets_sql(tables) -> str:
    return f"""
WITH av AS ({attribute_values_sql(tables, "trimmed")}),
per_value AS (SELECT v, string_agg(attr, ',' ORDER BY attr) AS attributes FROM av GROUP BY v)
SELECT attributes, count(*)::BIGINT AS n_values FROM per_value GROUP BY attributes"""


def attribute_overlap_sql(tables) -> str:
    return f"""
WITH av AS ({attribute_values_sql(tables, "trimmed")}),
tot AS (SELECT attr, count(*) AS n FROM av GROUP BY attr)
SELECT a.attr AS dependent, b.attr AS referenced, count(*)::BIGINT AS n_common, max(tot.n)::BIGINT AS n_dependent
FROM av a JOIN av b ON a.v = b.v AND a.attr <> b.attr JOIN tot ON tot.attr = a.attr
GROUP BY a.attr, b.attr"""


def ind_candidates_sql(tables) -> str:
    return f"""
WITH av AS ({attribute_values_sql(tables, "strict")}),
prof AS (SELECT t, c, count(*)::BIGINT AS n FROM av GROUP BY t, c)
SELECT d.t AS dependent_table, d.c AS dependent_column, r.t AS referenced_table, r.c AS referenced_column,
       d.n AS n_dependent, r.n AS n_referenced, d.n <= r.n AS size_ok
FROM prof d CROSS JOIN prof r WHERE NOT (d.t = r.t AND d.c = r.c)"""


def ind_check_sql(tables, pairs) -> str:
    rows = ", ".join(f"({_lit(d)}, {_lit(r)}, {i})" for i, (d, r) in enumerate(pairs))
    return f"""
WITH av AS ({attribute_values_sql(tables, "trimmed")}),
pairs(dep, ref, k) AS (VALUES {rows}),
dv AS (SELECT p.k, a.v FROM pairs p JOIN av a ON a.attr = p.dep),
missing AS (
  SELECT dv.k, count(*) AS n FROM dv JOIN pairs p ON p.k = dv.k
  WHERE NOT EXISTS (SELECT 1 FROM av r WHERE r.attr = p.ref AND r.v = dv.v) GROUP BY dv.k),
total AS (SELECT k, count(*) AS n FROM dv GROUP BY k)
SELECT p.dep AS dependent, p.ref AS referenced,
       coalesce(total.n, 0)::BIGINT AS n_dependent, coalesce(missing.n, 0)::BIGINT AS n_missing,
       coalesce(missing.n, 0) = 0 AND coalesce(total.n, 0) > 0 AS is_ind
FROM pairs p LEFT JOIN total ON total.k = p.k LEFT JOIN missing ON missing.k = p.k"""


def ind_implied_sql(tables) -> str:
    return f"""
WITH ind AS ({unary_inds_sql(tables, "trimmed")})
SELECT DISTINCT a.dependent AS dependent, b.referenced AS referenced
FROM ind a JOIN ind b ON a.referenced = b.dependent
WHERE a.dependent <> b.referenced"""


def nary_level2_sql(tables) -> str:
    """Level-2 INDs, both sides within one table, trimmed values, columns
    identified by (table, column)."""
    av = attribute_values_sql(tables, "strict")
    parts = []
    for t in tables:
        cols = TABLE_COLUMNS[t]
        for c1 in cols:
            for c2 in cols:
                if c1 != c2:
                    parts.append(
                        f"SELECT {_lit(t)} AS t, {_lit(c1)} AS c1, {_lit(c2)} AS c2, "
                        f"{value_sql(c1, True)} AS v1, {value_sql(c2, True)} AS v2 FROM {t}"
                    )
    tuples = "\n  UNION ALL ".join(parts)
    return f"""
WITH raw AS ({av}),
av AS (SELECT t, c, v FROM (SELECT t, c, {SQL_JAVA_TRIM.format(v="v")} AS v FROM raw) x
       WHERE v IS NOT NULL AND v <> '' GROUP BY t, c, v),
tot AS (SELECT t, c, count(*) AS n FROM av GROUP BY t, c),
common AS (
  SELECT a.t AS dt, a.c AS dc, b.t AS rt, b.c AS rc, count(*) AS n
  FROM av a JOIN av b ON a.v = b.v AND NOT (a.t = b.t AND a.c = b.c)
  GROUP BY a.t, a.c, b.t, b.c),
ind AS (SELECT dt, dc, rt, rc FROM common JOIN tot ON common.dt = tot.t AND common.dc = tot.c AND common.n = tot.n),
cand AS (
  SELECT i1.dt, i1.dc AS a, i2.dc AS b, i1.rt, i1.rc AS c, i2.rc AS d
  FROM ind i1 JOIN ind i2 ON i1.dt = i2.dt AND i1.rt = i2.rt AND i1.dc < i2.dc AND i1.rc <> i2.rc),
tv AS (
  SELECT DISTINCT t, c1, c2, v1, v2 FROM (
  {tuples}
  ) u WHERE v1 IS NOT NULL AND v1 <> '' AND v2 IS NOT NULL AND v2 <> ''),
dtot AS (SELECT t, c1, c2, count(*) AS n FROM tv GROUP BY t, c1, c2),
matched AS (
  SELECT cand.dt, cand.a, cand.b, cand.rt, cand.c, cand.d, count(*) AS n
  FROM cand
  JOIN tv dv ON dv.t = cand.dt AND dv.c1 = cand.a AND dv.c2 = cand.b
  JOIN tv rv ON rv.t = cand.rt AND rv.c1 = cand.c AND rv.c2 = cand.d AND rv.v1 = dv.v1 AND rv.v2 = dv.v2
  GROUP BY cand.dt, cand.a, cand.b, cand.rt, cand.c, cand.d)
SELECT m.dt AS dependent_table, m.a || ', ' || m.b AS dependent_columns,
       m.rt AS referenced_table, m.c || ', ' || m.d AS referenced_columns, 2 AS arity
FROM matched m JOIN dtot ON dtot.t = m.dt AND dtot.c1 = m.a AND dtot.c2 = m.b AND dtot.n = m.n"""


def nary_maximal_sql(table: str, columns: list[str], parts: dict[str, str]) -> str:
    """Maximal INDs of arity 2 and up between parts (name, condition) of one
    table whose columns (in name order) have no null or blank, so containment
    of tuples says all.  Every set of unary INDs between two parts is tried."""
    names = "[" + ", ".join(_lit(c) for c in columns) + "]"
    values = "[" + ", ".join(value_sql(c, True) for c in columns) + "]"
    rows = " UNION ALL ".join(f"SELECT {_lit(p)} AS t, {values} AS v FROM {table} WHERE {cond}" for p, cond in parts.items())
    return f"""
WITH RECURSIVE rows_ AS MATERIALIZED ({rows}),
cells AS MATERIALIZED (SELECT DISTINCT t, i, v[i] AS x FROM rows_, range(1, {len(columns) + 1}) g(i)),
tot AS (SELECT t, i, count(*) AS n FROM cells GROUP BY t, i),
common AS (
  SELECT d.t AS dt, d.i AS a, r.t AS rt, r.i AS b, count(*) AS n
  FROM cells d JOIN cells r ON d.x = r.x AND NOT (d.t = r.t AND d.i = r.i) GROUP BY d.t, d.i, r.t, r.i),
una AS MATERIALIZED (SELECT dt, a, rt, b FROM common JOIN tot ON tot.t = dt AND tot.i = a AND tot.n = common.n),
sets AS (
  SELECT dt, rt, [a] AS ds, [b] AS rs FROM una
  UNION ALL
  SELECT s.dt, s.rt, list_append(s.ds, u.a), list_append(s.rs, u.b)
  FROM sets s JOIN una u ON u.dt = s.dt AND u.rt = s.rt AND u.a > s.ds[-1] AND NOT list_contains(s.rs, u.b)),
many AS MATERIALIZED (SELECT *, row_number() OVER () AS id FROM sets WHERE len(ds) > 1),
dep AS (SELECT DISTINCT id, list_transform(ds, lambda k: v[k]) AS x FROM many JOIN rows_ ON t = dt),
ref AS (SELECT DISTINCT id, list_transform(rs, lambda k: v[k]) AS x FROM many JOIN rows_ ON t = rt),
bad AS (SELECT DISTINCT dep.id FROM dep LEFT JOIN ref ON ref.id = dep.id AND ref.x = dep.x WHERE ref.id IS NULL),
held AS MATERIALIZED (
  SELECT *, list_transform(range(1, len(ds) + 1), lambda k: ds[k] * 1000 + rs[k]) AS pairs FROM many WHERE id NOT IN (SELECT id FROM bad))
SELECT dt AS dependent_table, array_to_string(list_transform(ds, lambda k: {names}[k]), ', ') AS dependent_columns,
       rt AS referenced_table, array_to_string(list_transform(rs, lambda k: {names}[k]), ', ') AS referenced_columns,
       len(ds)::INTEGER AS arity
FROM held h
WHERE NOT EXISTS (
  SELECT 1 FROM held o WHERE o.dt = h.dt AND o.rt = h.rt AND len(o.ds) > len(h.ds) AND list_has_all(o.pairs, h.pairs))"""


def longest_shared_sql(table: str, id_sql: str, text_col: str, window: int = 24) -> str:
    """Longest shared substring per id for long texts.

    Ids that share a window of ``window`` characters: pairs of equal windows
    of two ids, and runs of them on one diagonal.  The others: their
    substrings below that length, looked up among all."""
    return f"""
WITH t AS (SELECT {id_sql} AS id, coalesce({text_col}, '') AS txt FROM {table}),
r AS MATERIALIZED (SELECT row_number() OVER () AS rid, id, txt FROM t WHERE id IS NOT NULL),
ids AS (SELECT DISTINCT id FROM r),
win AS MATERIALIZED (
  SELECT rid, id, p, substr(txt, p, {window}) AS k FROM (SELECT *, unnest(range(1, length(txt) + 1)) AS p FROM r)),
held AS (SELECT k FROM win WHERE length(k) = {window} GROUP BY k HAVING min(id) <> max(id)),
kept AS MATERIALIZED (SELECT win.* FROM win JOIN held USING (k)),
pairs AS (
  SELECT a.rid AS r1, b.rid AS r2, a.id, a.p, b.p - a.p AS d FROM kept a JOIN kept b ON a.k = b.k AND a.id <> b.id),
islands AS (SELECT *, p - row_number() OVER (PARTITION BY r1, r2, d ORDER BY p) AS g FROM pairs),
runs AS (SELECT id, r1, min(p) AS s, count(*) + {window} - 1 AS n FROM islands GROUP BY id, r1, r2, d, g),
longest AS (SELECT DISTINCT id, r1, s, n FROM (SELECT *, max(n) OVER (PARTITION BY id) AS m FROM runs) WHERE n = m),
long_best AS (SELECT l.id, min(substr(r.txt, l.s, l.n)) AS sub FROM longest l JOIN r ON r.rid = l.r1 GROUP BY l.id),
heads AS (
  SELECT id, n, substr(k, 1, n) AS sub
  FROM (SELECT id, k, unnest(range(1, least(length(k), {window} - 1) + 1)) AS n FROM win)),
mine AS MATERIALIZED (
  SELECT DISTINCT heads.id, n, sub FROM heads ANTI JOIN long_best ON heads.id = long_best.id),
wanted AS MATERIALIZED (SELECT DISTINCT sub FROM mine),
found AS MATERIALIZED (
  SELECT sub FROM heads SEMI JOIN wanted USING (sub) GROUP BY sub HAVING min(id) <> max(id)),
short_best AS (
  SELECT id, sub FROM (SELECT mine.id, sub, row_number() OVER (PARTITION BY mine.id ORDER BY n DESC, sub) AS rk
                       FROM mine JOIN found USING (sub)) WHERE rk = 1)
SELECT ids.id, coalesce(l.sub, s.sub, '') AS substring
FROM ids LEFT JOIN long_best l ON l.id = ids.id LEFT JOIN short_best s ON s.id = ids.id
WHERE (SELECT count(*) FROM ids) >= 2"""
