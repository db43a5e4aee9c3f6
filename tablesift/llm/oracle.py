"""DuckDB SQL of the pipeline operators that SQL can express (tables are views of the same parquet files)."""

from __future__ import annotations

from tablesift.llm.quality_rules import DEFAULT_RULES, MAX_REPEAT_PERCENT, MIN_WORDS, STOP_WORDS, WINDOW

_WORD = r"[^\x20\x09-\x0D]+"
_STOP = ", ".join(f"'{v}'" for v in sorted({v for s in STOP_WORDS.values() for w in s.split() for v in (w, w.capitalize())}))


def _rule_sql() -> str:
    out = []
    for r in DEFAULT_RULES:
        tests = [f"{r.measure} < {r.low}"] * (r.low is not None) + [f"{r.measure} > {r.high}"] * (r.high is not None)
        out.append(f"CASE WHEN n_words >= {r.min_words} AND ({' OR '.join(tests)}) THEN '{r.name}' END")
    return "list_filter([" + ", ".join(out) + "], lambda x: x IS NOT NULL)"


QUALITY_METRICS = f"""
words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents),
win AS (
  SELECT doc_id, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS p, w FROM words WHERE len(w) >= {WINDOW}),
rep AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, array_to_string(w[p:p + {WINDOW - 1}], ' ')) AS n FROM win),
cov AS (
  SELECT doc_id, sum(least({WINDOW}, coalesce(nxt - p, {WINDOW})))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS nxt FROM rep WHERE n > 1)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM words),
base AS (
  SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
    len(list_filter(w, lambda x: x IN ({_STOP})))::BIGINT AS n_stop_words,
    len(regexp_extract_all(text, '!'))::BIGINT AS n_exclamations,
    len(regexp_extract_all(text, '[0-9]'))::BIGINT AS n_digits
  FROM words JOIN lines USING (doc_id) LEFT JOIN cov USING (doc_id)),
ratios AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
    CASE WHEN n_words > 0 THEN n_exclamations / n_words ELSE 0 END AS exclamation_ratio,
    CASE WHEN word_chars > 0 THEN n_digits / word_chars ELSE 0 END AS digit_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
    CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_word_ratio
  FROM base),
judged AS (
  SELECT *, {_rule_sql()} AS failed_rules,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM ratios)"""

OP10 = f"""WITH {QUALITY_METRICS}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND len(failed_rules) = 0 AS kept, failed_rules, n_stop_words, n_lines
FROM judged"""

OP5 = r"""WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)"""

OP12 = rf"""WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM d),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (
  SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
reach AS (SELECT x, y FROM l UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
c AS (
  SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low.y, d.doc_id)) AS component_id
  FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.x = d.doc_id)
SELECT *, count(*) OVER (PARTITION BY component_id)::BIGINT AS component_size FROM c"""

# CRC-32 (polynomial 0xEDB88320, reflected) of a text's UTF-8 bytes: table by byte, then a fold over the bytes
CRC_TABLE = """
crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(0, 256))::BIGINT AS i)))"""


def _crc32(text: str) -> str:
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(0, length({digits}) // 2), lambda k: ('0x' || substr({digits}, (2 * k + 1)::INT, 2))::BIGINT)"
    fold = f"list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))"
    return f"xor({fold}, 4294967295)"


OP13 = f"""WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
pairs AS (SELECT doc_id, w, count(*) AS c FROM runs GROUP BY doc_id, w),
hashed AS (SELECT w, c, {_crc32("doc_id || ':' || w")} AS h FROM pairs, crc_table),
planted AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, c
  FROM hashed),
v AS MATERIALIZED (
  SELECT word, sum(c)::BIGINT AS n FROM planted WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
shorter AS (SELECT DISTINCT word, substr(word, 1, i - 1) || substr(word, i + 1) AS other FROM places),
holed AS (SELECT word, i, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS k FROM places),
near AS (
  SELECT shorter.word AS a, v.word AS b FROM shorter JOIN v ON v.word = shorter.other
  UNION SELECT v.word, shorter.word FROM shorter JOIN v ON v.word = shorter.other
  UNION SELECT x.word, y.word FROM holed x JOIN holed y ON x.k = y.k AND x.i = y.i AND x.word <> y.word),
ranked AS (
  SELECT a, b, v.n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY v.n DESC, b) AS rk
  FROM near JOIN v ON v.word = b),
f AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN r.n >= 2 * v.n THEN b END AS form, CASE WHEN r.n >= 2 * v.n THEN r.n END AS form_n
  FROM v LEFT JOIN ranked r ON r.a = v.word AND rk = 1),
chain AS (
  SELECT word, form AS r FROM f WHERE form IS NOT NULL
  UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.r WHERE f.form IS NOT NULL),
ends AS (SELECT chain.word, chain.r FROM chain JOIN f ON f.word = chain.r WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(ends.r, f.word) AS root, f.n, f.n_near, f.form_n FROM f LEFT JOIN ends USING (word)"""

# every qualifying run matches six words or more one period later, so equal windows of six words find all lags
OP11 = rf"""WITH {CRC_TABLE},
h AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w, {_crc32("doc_id::VARCHAR")} AS h FROM documents, crc_table),
a AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
d AS MATERIALIZED (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w
    ELSE list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) END AS w FROM p),
places AS (SELECT doc_id, w, unnest(range(0, n)) AS i, n FROM d),
six AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS k FROM places WHERE i + 6 <= n),
lags AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM six x JOIN six y ON x.doc_id = y.doc_id AND x.k = y.k AND y.i > x.i),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM lags),
long_ AS MATERIALIZED (
  SELECT doc_id, min(i) AS s, count(*) + 5 + q AS m, q FROM islands GROUP BY doc_id, q, g HAVING count(*) + 5 + q >= greatest(12, 2 * q)),
runs AS MATERIALIZED (
  SELECT * FROM long_ r WHERE NOT EXISTS (
    SELECT 1 FROM long_ o WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.s <= r.s AND o.s + o.m >= r.s + r.m)),
lines AS (
  SELECT doc_id, count(*)::BIGINT AS n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY doc_id),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY m DESC, s, q) AS rk FROM runs) WHERE rk = 1),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + m)) AS i FROM runs),
kept AS (
  SELECT places.doc_id, string_agg(w[places.i + 1], ' ' ORDER BY places.i) AS t
  FROM places ANTI JOIN dropped ON places.doc_id = dropped.doc_id AND places.i = dropped.i GROUP BY places.doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_words, coalesce(n_runs, 0) AS n_runs, s AS start, m AS length, q AS period,
  1000 * m // q AS exponent_milli, sha256(coalesce(lines.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN lines ON lines.doc_id = d.doc_id LEFT JOIN best ON best.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

OP4 = rf"""WITH
d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM d),
windows AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i + 1:i + 13], ' ') AS k FROM places WHERE i + 13 <= len(w)),
first AS (SELECT k, min(doc_id) AS smallest FROM windows GROUP BY k HAVING min(doc_id) < max(doc_id)),
matched AS (SELECT windows.doc_id, i FROM windows JOIN first ON windows.k = first.k WHERE smallest < windows.doc_id),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM matched),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (
  SELECT places.doc_id, string_agg(w[places.i + 1], ' ' ORDER BY places.i) AS t
  FROM places ANTI JOIN gone ON places.doc_id = gone.doc_id AND places.i = gone.i GROUP BY places.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(removed.n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN removed ON removed.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

ORACLES = {
    "op4_lz_dedup": OP4,
    "op5_exact_dedup": OP5,
    "op10_quality_rules": OP10,
    "op11_periodic_runs": OP11,
    "op12_ngram_join": OP12,
    "op13_spelling_variants": OP13,
}
