"""What each query must return, in DuckDB SQL over the given tables alone.

The long and wide rows are computed from orders, customer and lineitem, never from XML.
"""

from __future__ import annotations

from shredloom_checks.fixtures import (
    CONCORDANCE_ROWS, HEADER_TABLE, LINES_TABLE, URL_BASE)
from shredloom_checks.queries import AS_OF_YEAR, DRIVER_TABLES

_H, _F = "/Return/ReturnHeader", "/Return/ReturnData/Form"
_G = f"{_F}/LineItemGrp"
ELSEWHERE = URL_BASE.replace("/xml/", "/other/")

# f: one row per filing. l: one row per line with its position i of n. t: text of all lines.
FILINGS = f"""
f AS (
  SELECT o_orderkey AS k, 'OID-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS oid,
    '{URL_BASE}' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '_public.xml' AS url,
    CAST(year(o_orderdate) AS VARCHAR) AS y,
    CAST(year(o_orderdate) AS VARCHAR) || 'v' || CAST(1 + o_orderkey % 3 AS VARCHAR) || '.0'
      AS version,
    CASE o_orderstatus WHEN 'F' THEN '990' WHEN 'O' THEN '990EZ' ELSE '990PF' END AS form,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS a,
    lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ein, c_name AS name, c_mktsegment AS segment,
    o_orderpriority AS priority,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
LINES = """
l AS (
  SELECT f.*, CAST(l_linenumber AS VARCHAR) AS line, CAST(l_partkey AS VARCHAR) AS part,
    CAST(l_suppkey AS VARCHAR) AS supp,
    CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS qty,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS amt,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY
      l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS i,
    count(*) OVER (PARTITION BY l_orderkey) AS n
  FROM lineitem JOIN f ON l_orderkey = f.k),
li AS (
  SELECT l.*, CASE WHEN n > 1 THEN '[' || CAST(i AS VARCHAR) || ']' ELSE '' END AS idx,
    CASE WHEN n > 1 THEN 'TID-' || lpad(CAST(i AS VARCHAR), 5, '0') ELSE 'TID-00000' END AS tid
  FROM l),
t AS (
  SELECT oid, count(*) AS n, string_agg(line || part || supp || qty || amt, '' ORDER BY i) AS txt
  FROM l GROUP BY oid),
ft AS (
  SELECT f.*, coalesce(t.n, 0) AS n_lines, coalesce(t.txt, '') AS txt
  FROM f LEFT JOIN t ON f.oid = t.oid)"""

_VARIABLES = {path: (variable, table) for path, variable, table, _ in CONCORDANCE_ROWS}
# path, header, type, order, value, condition
_SINGLE = [
    ("/Return", "//", "parent", "1", "'VERSION: ' || version", "true"),
    (_H, "//ReturnHeader", "parent", "2",
     "ein || name || y || form || CASE WHEN a = 1 THEN 'X' ELSE '' END", "true"),
    (f"{_H}/Filer", "//ReturnHeader/Filer", "parent", "3", "ein || name", "true"),
    (f"{_H}/Filer/EIN", "//ReturnHeader/Filer", "terminal", "4", "ein", "true"),
    (f"{_H}/Filer/BusinessName", "//Filer/BusinessName", "parent", "5", "name", "true"),
    (f"{_H}/Filer/BusinessName/BusinessNameLine1Txt", "//Filer/BusinessName", "terminal", "6",
     "name", "true"),
    (f"{_H}/TaxYr", "//Return/ReturnHeader", "terminal", "7", "y", "true"),
    (f"{_H}/ReturnTypeCd", "//Return/ReturnHeader", "terminal", "8", "form", "true"),
    (f"{_H}/AmendedReturnInd", "//Return/ReturnHeader", "terminal", "9", "'X'", "a = 1"),
    ("/Return/ReturnData", "//ReturnData", "parent", "9 + a",
     "total || priority || segment || txt", "true"),
    (_F, "//ReturnData/Form", "parent", "10 + a", "total || priority || segment || txt", "true"),
    (f"{_F}/TotalAmt", "//ReturnData/Form", "terminal", "11 + a", "total", "true"),
    (f"{_F}/PriorityTxt", "//ReturnData/Form", "terminal", "12 + a", "priority", "true"),
    (f"{_F}/SegmentTxt", "//ReturnData/Form", "terminal", "13 + a", "segment", "true"),
]
_PER_LINE = [
    ("", "parent", 0, "line || part || supp || qty || amt"),
    ("/LineNum", "terminal", 1, "line"), ("/PartNum", "terminal", 2, "part"),
    ("/SuppNum", "terminal", 3, "supp"), ("/QtyNum", "terminal", 4, "qty"),
    ("/Amt", "terminal", 5, "amt"),
]


def _elements() -> str:
    parts = []
    for path, header, kind, order, value, condition in _SINGLE:
        variable, table = _VARIABLES.get(path, (path.rsplit("/", 1)[1], ""))
        parts.append(
            f"SELECT oid, y, version, CAST({order} AS INTEGER) AS ord, '{path}' AS xpath, "
            f"'{path}' AS xpath2, '{header}' AS header, 'TID-00000' AS tid, '{kind}' AS typ, "
            f"'{table}' AS rdb, '{variable}' AS var, {value} AS val FROM ft WHERE {condition}")
    for leaf, kind, step, value in _PER_LINE:
        path = _G + leaf
        variable, table = _VARIABLES.get(path, (path.rsplit("/", 1)[1], ""))
        parts.append(
            f"SELECT oid, y, version, CAST(14 + a + 6 * (i - 1) + {step} AS INTEGER), "
            f"'{_G}' || idx || '{leaf}', '{path}', '//Form/LineItemGrp', tid, '{kind}', "
            f"'{table}', '{variable}', {value} FROM li")
    return "e AS (\n" + "\nUNION ALL ".join(parts) + ")"


ATTRS = f"""
atr AS (
  SELECT oid, y, 'Return' AS node_name, '/Return' AS xpath, 'returnVersion' AS attr_name,
    version AS attr_value FROM ft
  UNION ALL SELECT oid, y, 'ReturnData', '/Return/ReturnData', 'documentCount',
    CAST(n_lines AS VARCHAR) FROM ft
  UNION ALL SELECT oid, y, 'Amt', '{_G}' || idx || '/Amt', 'currency', 'USD' FROM li)"""

KEY_COLUMNS = """oid AS "OBJECTID", url AS "URL", version AS "VERSION", ein AS "EIN",
  name AS "ORG_NAME", form AS "FORM_TYPE", y AS "TAX_YEAR", CAST(NULL AS VARCHAR) AS "RETURN_TS",
  CASE WHEN a = 1 THEN 'X' END AS "IS_AMENDED", CAST(NULL AS VARCHAR) AS "IS_GROUP",
  CAST(NULL AS VARCHAR) AS "IS_PARTIAL" """

WITH_F = f"WITH {FILINGS}\n"
WITH_L = f"WITH {FILINGS},{LINES}\n"
WITH_E = f"WITH {FILINGS},{LINES},\n{_elements()}\n"
WITH_A = f"WITH {FILINGS},{LINES},{ATTRS}\n"
# ps: the set of element paths and page paths
PATHS = f"""WITH {FILINGS},{LINES},
{_elements()},
ps AS (SELECT DISTINCT xpath FROM (
  SELECT xpath FROM e UNION ALL SELECT url FROM pages) WHERE xpath IS NOT NULL),
pp AS (SELECT DISTINCT array_to_string(parts[1:i], '/') AS xpath FROM (
  SELECT parts, unnest(range(1, len(parts))) AS i FROM (
    SELECT string_split(xpath, '/') AS parts FROM ps)))
"""
EVEN = "CAST(substr(oid, 5, 9) AS BIGINT) % 2 = 0"

HEADER_CELLS = """ein AS "OF_00_EIN", name AS "OF_00_NAME", y AS "OF_00_TAX_YEAR",
  form AS "OF_00_FORM", CASE WHEN a = 1 THEN 'X' ELSE '' END AS "OF_00_AMENDED",
  total AS "OF_00_TOTAL", priority AS "OF_00_PRIORITY" """
LINE_CELLS = """tid AS "TABLE_ID", line AS "OF_01_LINE", part AS "OF_01_PART",
  supp AS "OF_01_SUPP", qty AS "OF_01_QTY", amt AS "OF_01_AMT" """

_PEOPLE = """
  SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, c_mktsegment AS segment,
    CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance, CAST(NULL AS VARCHAR) AS nation
  FROM customer
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, NULL, CAST(s_nationkey AS VARCHAR)
  FROM supplier"""

_CC = "cc AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{path}', '{variable}')" for path, variable, _, _ in CONCORDANCE_ROWS
) + ") v(xpath, variable_name))"


def _report() -> str:
    """Report over all years: totals joined with the crosswalk, typed against the whole path set."""
    return f"""{WITH_E[:-1]}, {_CC},
r AS (SELECT xpath2 AS xpath, CAST(count(*) AS BIGINT) AS count_occurrences,
    string_agg(DISTINCT version, ';;' ORDER BY version) AS schema_versions
  FROM e GROUP BY xpath2),
j AS (SELECT coalesce(r.xpath, cc.xpath) AS xpath, count_occurrences, schema_versions,
    variable_name, CASE WHEN cc.xpath IS NOT NULL THEN '2001' END AS concordance_latest_version
  FROM r FULL JOIN cc ON r.xpath = cc.xpath)
SELECT xpath, coalesce(count_occurrences, -1) AS count_occurrences, schema_versions,
  substr(schema_versions, 1, 4) AS first_year,
  substr(schema_versions, length(schema_versions) - 7, 4) AS last_year,
  substr(schema_versions, length(schema_versions) - 7, 4) AS latest_version,
  CAST(substr(schema_versions, length(schema_versions) - 7, 4) = '{AS_OF_YEAR}' AS VARCHAR)
    AS current_version,
  variable_name, concordance_latest_version,
  CASE WHEN EXISTS (SELECT 1 FROM j o WHERE starts_with(o.xpath, j.xpath || '/'))
    THEN 'HEADER' ELSE 'DATA' END AS path_type
FROM j"""


def _yearly() -> str:
    return f"""{WITH_L[:-1]},
s AS (SELECT y, count(*) AS nk, sum(13 + a + 6 * n_lines) AS ne, sum(2 + n_lines) AS na
  FROM ft GROUP BY y)
SELECT y AS "TaxYear", CAST(nk AS BIGINT) AS n_rows, 'KEYS' AS table_name FROM s
UNION ALL SELECT y, CAST(ne AS BIGINT), 'FLATXML' FROM s
UNION ALL SELECT y, CAST(na AS BIGINT), 'ATTRIBUTES' FROM s"""


_LAST = r"regexp_extract(xpath, '^.*\[(\d+)\]', 1)"
_DISTINCT = f"{WITH_E[:-1]}, d AS (SELECT DISTINCT xpath, xpath2, typ, header, tid FROM e)\n"
_EIN_FORMS = """WITH c AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS key,
  lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS nine FROM customer),
w AS (SELECT c_custkey, 0 AS form, key AS ein FROM c
  UNION ALL SELECT c_custkey, 1, nine FROM c
  UNION ALL SELECT c_custkey, 2, 'EIN-' || nine[1:2] || '-' || nine[3:9] FROM c
  UNION ALL SELECT c_custkey, 3, nine || '77' FROM c
  UNION ALL SELECT c_custkey, 4, ' ' || key || '-' FROM c
  UNION ALL SELECT c_custkey, 5, '' FROM c),
d AS (SELECT *, regexp_replace(ein, '[^0-9]', '', 'g') AS digits FROM w)
SELECT c_custkey, CAST(form AS INTEGER) AS form, ein AS "EIN", """
_SHARD_COUNTS = f"""{WITH_A[:-1]},
s AS (SELECT k % 4 AS shard, count(*) AS nk, sum(13 + a + 6 * n_lines) AS ne,
    sum(2 + n_lines) AS na FROM ft GROUP BY 1)
"""

_KEYS = ("OBJECTID", "URL", "VERSION", "EIN", "ORG_NAME", "FORM_TYPE", "TAX_YEAR", "RETURN_TS",
         "IS_AMENDED", "IS_GROUP", "IS_PARTIAL")
_HEADERS = ("OF_00_EIN", "OF_00_NAME", "OF_00_TAX_YEAR", "OF_00_FORM", "OF_00_AMENDED",
            "OF_00_TOTAL", "OF_00_PRIORITY", "OF_00_UNUSED")
_LINES = ("TABLE_ID", "OF_01_LINE", "OF_01_PART", "OF_01_SUPP", "OF_01_QTY", "OF_01_AMT")


def _cells(names: tuple[str, ...]) -> str:
    return " || '|' || ".join(f"""'{name}=' || coalesce("{name}", '')""" for name in names)


SQL: dict[str, str] = {
    "shred_elements": f"""{WITH_E}SELECT oid AS "OBJECTID", ord AS "ORDER", xpath AS "XPATH",
      xpath2 AS "XPATH2", header AS "TABLE_HEADER", tid AS "TABLE_ID", typ AS "TYPE",
      rdb AS "RDB_TABLE", var AS "VARIABLE_NAME", val AS "VALUE" FROM e""",
    "shred_elements_without_parent_text": f"""{WITH_E}SELECT typ AS "TYPE",
      CAST(count(*) AS BIGINT) AS n_rows,
      CAST(count(*) FILTER (WHERE typ = 'terminal' OR ord = 1) AS BIGINT) AS n_values
      FROM e GROUP BY typ""",
    "shred_attributes": f"""{WITH_A}SELECT oid AS "OBJECTID", node_name, xpath, attr_name,
      attr_value FROM atr""",
    "extract_keys": f"{WITH_F}SELECT {KEY_COLUMNS} FROM f",
    "failed_filings": "SELECT url, 'parse' AS stage FROM pages",
    "shred_batch_counts": f"""{WITH_L}SELECT CAST(count(*) AS BIGINT) AS n_filings,
      (SELECT CAST(count(*) AS BIGINT) FROM pages) AS n_failed,
      CAST(sum(13 + a + 6 * n_lines) AS BIGINT) AS n_elements FROM ft""",
    "root_version": f"""{WITH_F}SELECT oid AS "OBJECTID", 'VERSION: ' || version AS "VALUE" FROM f""",
    "object_id": f"""{WITH_F}SELECT url AS "URL", oid AS "OBJECTID",
      oid AS "OBJECTID_KNOWN_BASE" FROM f
      UNION ALL SELECT replace(url, '/xml/', '/other/'), 'OID-' || '{ELSEWHERE}' || substr(oid, 5),
        'OID-' || '{ELSEWHERE}' || substr(oid, 5) FROM f
      UNION ALL SELECT url, 'OID-' || url, 'OID-' || url FROM pages""",
    "format_ein_id": f"""{_EIN_FORMS}'EIN-' || substr(CASE WHEN length(digits) < 9
      THEN lpad(digits, 9, '0') ELSE digits END, 1, 2) || '-' || substr(CASE WHEN
      length(digits) < 9 THEN lpad(digits, 9, '0') ELSE digits END, 3, 7) AS "EIN_ID" FROM d""",
    "format_ein_n": f"""{_EIN_FORMS}digits AS "EIN_N" FROM d""",
    "normalize_xpath": f"""{_DISTINCT}SELECT xpath AS "XPATH", xpath2 AS "XPATH2" FROM d""",
    "last_index": f"""{_DISTINCT}SELECT xpath AS "XPATH",
      CASE WHEN {_LAST} = '' THEN '0' ELSE {_LAST} END AS last_index FROM d""",
    "table_id": f"""{_DISTINCT}SELECT xpath AS "XPATH", tid AS "TABLE_ID" FROM d""",
    "table_header": f"""{_DISTINCT}SELECT xpath AS "XPATH", typ AS "TYPE",
      header AS "TABLE_HEADER" FROM d""",
    "leaf_name": f"""{_DISTINCT}SELECT xpath AS "XPATH",
      string_split(xpath2, '/')[-1] AS "LEAF_NAME" FROM d""",
    "parent_paths": f"{PATHS}SELECT xpath FROM pp",
    "terminal_paths": f"""{PATHS}SELECT xpath FROM ps WHERE NOT EXISTS (
      SELECT 1 FROM pp WHERE pp.xpath = ps.xpath)""",
    "node_type": f"""{PATHS}SELECT xpath, CASE WHEN EXISTS (
      SELECT 1 FROM pp WHERE pp.xpath = ps.xpath) THEN 'parent' ELSE 'terminal' END AS node_type
      FROM ps""",
    "merge_version_lists": """WITH v AS (
      SELECT o_custkey, o_orderstatus, string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR)
        || 'v' || CAST(1 + o_orderkey % 3 AS VARCHAR) || '.0', ';;' ORDER BY
        CAST(year(o_orderdate) AS VARCHAR) || 'v' || CAST(1 + o_orderkey % 3 AS VARCHAR) || '.0')
        FILTER (WHERE o_orderpriority <> '5-LOW') AS vs
      FROM orders GROUP BY o_custkey, o_orderstatus)
      SELECT o_custkey, o_orderstatus, coalesce(vs, '') AS schema_versions,
        substr(vs, 1, 4) AS first_year, substr(vs, length(vs) - 7, 4) AS last_year FROM v""",
    "chunk_label": f"""{WITH_F[:-1]},
      c AS (SELECT url, y, form, row_number() OVER (PARTITION BY y ORDER BY url) AS p,
        count(*) OVER (PARTITION BY y) AS n FROM f),
      g AS (SELECT *, (p + 24) // 25 AS g, (n + 24) // 25 AS gs FROM c)
      SELECT url AS "URL", y AS "TaxYear", form AS "FormType",
        'G' || lpad(CAST(g AS VARCHAR), CAST(length(CAST(gs AS VARCHAR)) AS INTEGER), '0') || '{{' ||
        CAST(CASE WHEN g < gs THEN 25 ELSE n - (gs - 1) * 25 END AS VARCHAR) || '}}' AS chunk
      FROM g""",
    "split_index_by_year": f"""{WITH_F}SELECT url AS "URL", y AS "TaxYear", form AS "FormType"
      FROM f""",
    "index_crosstab": f"""{WITH_F}SELECT y AS "TaxYear",
      CAST(count(*) FILTER (WHERE form = '990') AS BIGINT) AS "990",
      CAST(count(*) FILTER (WHERE form = '990EZ') AS BIGINT) AS "990EZ"
      FROM f WHERE form IN ('990', '990EZ') GROUP BY y""",
    "missing_filings": f"""{WITH_F}SELECT url AS "URL" FROM f
      EXCEPT SELECT url FROM f WHERE {EVEN}""",
    "missing_filings_of_year": f"""{WITH_F}SELECT url AS "URL" FROM f WHERE y = '1997'
      EXCEPT SELECT url FROM f WHERE {EVEN}""",
    "pending_filings": f"""{WITH_F}SELECT url AS "URL" FROM f WHERE k % 4 = 3""",
    "project_concordance": f"""{WITH_E}SELECT DISTINCT xpath2 AS "XPATH", var AS "VARIABLE_NAME",
      rdb AS "RDB_TABLE" FROM e""",
    "read_concordance": f"""{WITH_E}SELECT DISTINCT xpath2 AS xpath, var AS variable_name,
      nullif(rdb, '') AS rdb_table FROM e""",
    "map_concordance": f"""{WITH_E}SELECT oid AS "OBJECTID", ord AS "ORDER", xpath2 AS "XPATH2",
      var AS "VARIABLE_NAME", rdb AS "RDB_TABLE" FROM e
      UNION ALL SELECT oid, ord, xpath2, 'OF_00_YEAR_TWIN', rdb FROM e
      WHERE xpath2 = '{_H}/TaxYr'""",
    "append_long_tables": f"SELECT * FROM ({_PEOPLE})",
    "align_columns": """SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name,
      CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS VARCHAR) AS balance,
      CAST(s_nationkey AS VARCHAR) AS nation FROM supplier""",
    "create_and_insert": """SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment,
      CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance FROM customer""",
    "merge_shards": f"""{WITH_F}SELECT {KEY_COLUMNS}, y AS "TaxYear",
      CASE WHEN k % 4 = 3 THEN '3' END AS "SHARD" FROM f""",
    "merge_shard_counts": f"""{_SHARD_COUNTS}
      SELECT 'KEYS' AS table_name, CAST(sum(nk) AS BIGINT) AS n_rows, 'main' AS src FROM s
      UNION ALL SELECT 'FLATXML', CAST(sum(ne) AS BIGINT), 'main' FROM s
      UNION ALL SELECT 'ATTRIBUTES', CAST(sum(na) AS BIGINT), 'main' FROM s WHERE shard <> 2""",
    "validate_merge": f"""{_SHARD_COUNTS}
      SELECT 'KEYS' AS table_name, CAST(sum(nk) AS BIGINT) AS main_rows,
        CAST(sum(nk) AS BIGINT) AS worker_sum, CAST(4 AS BIGINT) AS n_workers, 'true' AS match FROM s
      UNION ALL SELECT 'FLATXML', CAST(sum(ne) - sum(nk) AS BIGINT), CAST(sum(ne) AS BIGINT), 4,
        'false' FROM s
      UNION ALL SELECT 'ATTRIBUTES', CAST(sum(na) AS BIGINT), CAST(sum(na) AS BIGINT), 3, 'true'
        FROM s WHERE shard <> 2
      UNION ALL SELECT 'EXTRA', -1, CAST(sum(nk) AS BIGINT), 1, 'false' FROM s WHERE shard = 0
      UNION ALL SELECT 'ONLY_MAIN', CAST(sum(nk) AS BIGINT), -1, -1, NULL FROM s""",
    "merge_update": f"""{WITH_F}SELECT oid AS "OBJECTID", url AS "URL", version AS "VERSION",
      y AS "TaxYear" FROM f""",
    "merge_update_rows": f"""{WITH_E}SELECT y AS "TaxYear", xpath2 AS "XPATH2",
      CAST(count(*) AS BIGINT) AS n_rows FROM e GROUP BY y, xpath2""",
    "open_snapshot_returns": "SELECT CAST(count(*) AS BIGINT) AS n_returns FROM orders",
    "build_year": f"""{WITH_F}SELECT {KEY_COLUMNS}, y AS "TaxYear" FROM f""",
    "build_single_year": f"""{WITH_F}SELECT {KEY_COLUMNS}, y AS "TaxYear" FROM f
      WHERE y = '1996'""",
    "update_year": _yearly(),
    "table_rows": f"""{WITH_E}SELECT oid AS "OBJECTID", var AS "VARIABLE_NAME", val AS "VALUE"
      FROM e WHERE typ = 'terminal' AND rdb = '{HEADER_TABLE}'""",
    "header_rows": f"""{WITH_E}SELECT xpath2 AS "XPATH2", CAST(count(*) AS BIGINT) AS n_rows FROM e
      WHERE typ = 'terminal' AND starts_with(xpath2, '{_H}/Filer/') GROUP BY xpath2""",
    "header_rows_legacy": f"""{WITH_E}SELECT xpath2 AS "XPATH2", CAST(count(*) AS BIGINT) AS n_rows
      FROM e WHERE typ = 'terminal' AND (starts_with(xpath2, '{_H}/Filer')
        OR starts_with(xpath2, '{_F}/Line')) GROUP BY xpath2""",
    "flatten_table": f"""{WITH_F}SELECT oid AS "OBJECTID", {HEADER_CELLS}, '' AS "OF_00_UNUSED"
      FROM f""",
    "flatten_table_observed": f"""{WITH_F}SELECT oid AS "OBJECTID", {HEADER_CELLS} FROM f""",
    "pivot_duplicates": """SELECT CAST(user_id AS VARCHAR) AS "OBJECTID", """ + ", ".join(
        f"""coalesce(max(CASE WHEN event_type = '{kind}' THEN
          CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END), '') AS {kind}"""
        for kind in ("click", "error", "purchase", "signup", "view")
    ) + " FROM events GROUP BY user_id",
    "add_keys": f"""{WITH_F}SELECT oid AS "OBJECTID", CASE WHEN {EVEN} THEN url END AS "URL",
      CASE WHEN {EVEN} THEN version END AS "VERSION", form AS "OF_00_FORM",
      total AS "OF_00_TOTAL" FROM f""",
    "build_table": f"""{WITH_F}SELECT {KEY_COLUMNS}, {HEADER_CELLS}, '' AS "OF_00_UNUSED"
      FROM f""",
    "build_rdb_table": f"{WITH_L}SELECT {KEY_COLUMNS}, {LINE_CELLS} FROM li",
    "extract_tables": f"""{WITH_L[:-1]},
      kl AS (SELECT {KEY_COLUMNS}, {LINE_CELLS}, y FROM li),
      kh AS (SELECT {KEY_COLUMNS}, {HEADER_CELLS}, '' AS "OF_00_UNUSED", y FROM f)
      SELECT '{HEADER_TABLE}' AS table_name, y AS "TaxYear", {_cells(_KEYS + _HEADERS)} AS cells FROM kh
      UNION ALL SELECT '{LINES_TABLE}', y, {_cells(_KEYS + _LINES)} FROM kl""",
    "write_csv_roundtrip": f"""{WITH_L}SELECT oid AS "OBJECTID", version AS "VERSION",
      {LINE_CELLS} FROM li""",
    "retrieve_attributes": f"""{WITH_A}SELECT oid AS "OBJECTID", node_name, xpath, attr_name,
      attr_value FROM atr WHERE {EVEN}""",
    "retrieve_attributes_limit": f"""{WITH_A}SELECT oid AS "OBJECTID", node_name, xpath,
      attr_name, attr_value FROM atr ORDER BY 1, 2, 3, 4, 5 LIMIT 100""",
    "summarize_attributes": f"""{WITH_A[:-1]},
      h AS (SELECT oid, attr_name, CASE WHEN NOT (attr_name = 'currency'
        AND CAST(substr(oid, 5, 9) AS BIGINT) % 7 = 0) THEN attr_value END AS v FROM atr)
      SELECT attr_name, CAST(count(*) AS BIGINT) AS n_records,
        CAST(count(DISTINCT oid) AS BIGINT) AS n_objects,
        CAST(count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS BIGINT)
          AS n_unique_vals,
        min(nullif(v, '')) AS example_value FROM h GROUP BY attr_name""",
    "summarize_attribute_table": f"""{WITH_A}SELECT attr_name, CAST(count(*) AS BIGINT)
      AS n_records, CAST(count(DISTINCT oid) AS BIGINT) AS n_objects,
      CAST(count(DISTINCT attr_value) AS BIGINT) AS n_unique_vals,
      min(attr_value) AS example_value FROM atr GROUP BY attr_name""",
    "profile_tables": " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, (SELECT CAST(count(*) AS BIGINT) FROM {name}) AS n_rows,
          (SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE {name})) AS n_cols, false AS failed"""
        for name in DRIVER_TABLES) + " UNION ALL SELECT 'no_such_table', -1, -1, true",
    "preview_table": "SELECT * FROM customer ORDER BY ALL LIMIT 25",
    "xpath_report": f"""{WITH_E}SELECT xpath2 AS xpath, CAST(count(*) AS BIGINT)
      AS count_occurrences, string_agg(DISTINCT version, ', ' ORDER BY version) AS schema_versions
      FROM e GROUP BY xpath2""",
    "xpath_report_by_year": f"""{WITH_E}SELECT y AS "TaxYear", xpath2 AS xpath,
      CAST(count(*) AS BIGINT) AS count_occurrences,
      string_agg(DISTINCT version, ', ' ORDER BY version) AS schema_versions
      FROM e GROUP BY y, xpath2""",
    "process_xpaths": _report(),
    "write_xpath_reports": _report(),
}

SQL["xpath_report_of_elements"] = SQL["xpath_report"]
SQL["process_xpaths_of_elements"] = SQL["process_xpaths"]
SQL["update_stream_two_sources"] = SQL["resume_year"] = SQL["shred_elements"]
SQL["update_stream"] = SQL["merge_update_attributes"] = SQL["shred_attributes"]
SQL["compact_store"] = SQL["shred_elements"]
SQL["summarize_attribute_rows"] = SQL["summarize_attribute_table"]
SQL["read_filings"] = "SELECT page_id, md5(regexp_replace(html, '\\n$', '')) AS md5 FROM pages"
SQL["list_tables"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, 'view' AS src FROM {name}"
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations"))
SQL["mismatches"] = f"""{_SHARD_COUNTS}
  SELECT 'FLATXML' AS table_name, CAST(sum(ne) - sum(nk) AS BIGINT) AS main_rows,
    CAST(sum(ne) AS BIGINT) AS worker_sum, CAST(4 AS BIGINT) AS n_workers, 'false' AS match FROM s"""
