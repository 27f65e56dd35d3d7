"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from shredloom.llm import line_dedup, quality

WORDS = r"[x FOR x IN string_split_regex({text}, '[\x20\x09-\x0D]') IF x <> '']"
TRIMMED = "trim({line}, chr(32) || chr(9) || chr(13) || chr(12) || chr(11))"


def quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


SQL: dict[str, str] = {}

SQL["op1_line_dedup"] = f"""
WITH pages AS (SELECT source, text, row_number() OVER () AS page, doc_id FROM documents),
lines AS (
  SELECT page, source, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM pages),
keyed AS (SELECT *, {TRIMMED.format(line="line")} AS key FROM lines),
totals AS (SELECT source, count(DISTINCT text) AS n FROM pages GROUP BY source),
counts AS (SELECT source, key, count(DISTINCT text) AS n FROM keyed WHERE key <> ''
           GROUP BY source, key),
flagged AS (
  SELECT c.source, c.key FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.n >= {line_dedup.MIN_PAGES} AND c.n > {line_dedup.MAX_RATIO} * t.n),
judged AS (
  SELECT k.page, k.line, k.pos, f.key IS NOT NULL AS bad
  FROM keyed k LEFT JOIN flagged f ON k.source IS NOT DISTINCT FROM f.source AND k.key = f.key),
cleaned AS (
  SELECT page, count(*) AS n_lines, count(*) FILTER (WHERE bad) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT bad), '') AS clean
  FROM judged GROUP BY page)
SELECT p.doc_id, p.source, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_dropped, 0) AS n_dropped,
       length(c.clean) AS n_chars_kept, md5(c.clean) AS text_md5
FROM pages p LEFT JOIN cleaned c USING (page)
"""

# A line passes the rules of quality.good_line.
GOOD_LINE = f"""NOT (
  regexp_matches(line, '{quoted(quality.BOILERPLATE)}') AND n <= {quality.MAX_BOILERPLATE_WORDS}
  OR len(regexp_extract_all(line, '{quality.SYMBOLS}'))
     > {quality.MAX_SYMBOL_SHARE} * length(line)
  OR len(regexp_extract_all(line, '{quality.SHOUT}')) > {quality.MAX_SHOUT_SHARE} * n
  OR NOT regexp_matches(line, '{quoted(quality.ENDS)}') AND n < {quality.MIN_OPEN_WORDS}
  OR separators >= {quality.MIN_SEPARATORS} AND separators > {quality.MAX_SEPARATOR_SHARE} * n)"""

SQL["op10_quality_rules"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         {WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
base AS (
  SELECT row, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '{quality.SYMBOLS}')) AS n_symbols FROM docs),
windows AS (
  SELECT row, pos, words[pos:pos + 2] AS gram
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS pos FROM docs)),
twice AS (SELECT row, pos, count(*) OVER (PARTITION BY row, gram) AS n FROM windows),
covered AS (
  SELECT row, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT row, unnest([pos, pos + 1, pos + 2]) AS place FROM twice WHERE n > 1) GROUP BY row),
lines AS (
  SELECT row, line, len(tokens) AS n, len([x FOR x IN tokens IF x IN ({
      ", ".join(f"'{x}'" for x in quality.SEPARATORS)})]) AS separators
  FROM (SELECT row, line, {WORDS.format(text="line")} AS tokens
        FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs))
  WHERE len(tokens) > 0),
line_totals AS (
  SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines, sum(length(line)) AS chars,
         coalesce(sum(length(line)) FILTER (WHERE {GOOD_LINE}), 0) AS good_chars
  FROM lines GROUP BY row),
measured AS (
  SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         n_words < {quality.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0)
           > {quality.MAX_REPEATED} * n_words AS base_failed,
         coalesce(good_chars >= {quality.MIN_KEPT_SHARE} * chars, true) AS enough
  FROM base LEFT JOIN covered USING (row) LEFT JOIN line_totals USING (row))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND enough AS kept FROM measured
"""
