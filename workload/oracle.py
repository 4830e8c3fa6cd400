"""The same queries as SQL for DuckDB, over the same tables."""

from __future__ import annotations

from workload.fixtures import (
    CUSTOMER_COLUMNS,
    DIALECTS,
    EXTRACT_COLUMNS,
    ORDER_COLUMNS,
    ROWS_PER_FILE,
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# -- fixed values: written out, so that a wrong one in the library shows -------------------

MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
DATE_PREFIXES = [r"\d{4}-\d{2}-\d{2}", r"\d{2}/\d{2}/\d{4}", r"\d{2}-\d{2}-\d{4}", r"\d{2}\.\d{2}\.\d{4}"]
TIME_PREFIXES = [r"\d{2}:\d{2}:\d{2}", r"\d{2}:\d{2}"]
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE = r"^\+?[\d\s\(\)-]{7,20}$"
DATETIME_PREFIXES = [
    r"\d{4}-\d{2}-\d{2}", r"\d{2}/\d{2}/\d{4}", r"\d{2}-\d{2}-\d{4}", r"\d{4}/\d{2}/\d{2}", r"\d{2}/\d{2}/\d{2}",
    r"\d{2}-\d{2}-\d{2}", r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}",
]

# -- end of fixed values ---------------------------------------------------------------

MISSING = ", ".join(_text(t) for t in MISSING_TOKENS)

MESSY = """messy AS (
  SELECT o_orderkey AS k,
         CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 17 = 0 THEN 'NA' ELSE o_orderstatus END AS status,
         CASE WHEN o_orderkey % 23 = 0 THEN 'bad' WHEN o_orderkey % 19 = 0 THEN ''
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
         CASE WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%d/%m/%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         o_orderpriority AS priority
  FROM orders, (VALUES (1), (2)) AS c(copy)
  WHERE copy = 1 OR o_orderkey % 31 = 0)"""

# the messy lines as read: missing tokens are NULL, the amount is a number where it reads as one
PARSED = f"""{MESSY},
parsed AS (
  SELECT k, CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id,
         NULLIF(status, 'NA') AS status, TRY_CAST(NULLIF(amount, '') AS DOUBLE) AS amount,
         amount AS amount_text, status AS status_text, order_date, priority,
         CASE WHEN k % 29 = 0 THEN 'malformed_row' WHEN k % 23 = 0 THEN 'cast_error' END AS error_type
  FROM messy)"""

DATE_OF = """CASE WHEN k % 3 = 1 THEN strptime(order_date, '%d/%m/%Y')
            ELSE strptime(order_date, '%Y-%m-%d') END"""

CHANGED = """changed AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 103 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 101 <> 0)"""

CONTACTS = """contacts AS (
  SELECT 'user' || c_custkey || '@example.com' AS email,
         '+84 ' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone,
         strftime(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%d.%m.%Y') AS birthday,
         lpad(CAST(c_custkey % 24 AS VARCHAR), 2, '0') || ':'
           || lpad(CAST(c_custkey % 60 AS VARCHAR), 2, '0') AS call_time,
         strftime(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%Y-%m-%d')
           || ' 10:20:30' AS created,
         format('{:,}', c_custkey * 1000 + 1) AS points,
         CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'False' END AS active,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance,
         CAST(c_custkey + 3000000000 AS VARCHAR) AS account,
         CAST(NULL AS VARCHAR) AS fax,
         CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE 'N/A' END AS segment
  FROM customer)"""
CONTACT_COLUMNS = [
    "email", "phone", "birthday", "call_time", "created", "points", "active", "balance",
    "account", "fax", "segment",
]


def _prefix(patterns: list[str]) -> str:
    return _text("^(?:" + "|".join(patterns) + ")")


def _cell_facts(table: str, column: str, position: int) -> str:
    """Counts over one text column, from which the types follow."""
    date_dmy = (
        "coalesce(CASE WHEN regexp_matches(substr(v,1,10), '^\\d{4}-\\d{2}-\\d{2}$') "
        "THEN try_strptime(substr(v,1,10), '%Y-%m-%d') END, "
        "CASE WHEN regexp_matches(v, '^\\d{2}([/]\\d{2}[/]|-\\d{2}-|[.]\\d{2}[.])\\d{4}') THEN "
        "try_strptime(replace(replace(substr(v,1,10),'/','-'),'.','-'), '%d-%m-%Y') END)"
    )
    date_mdy = date_dmy.replace("%d-%m-%Y", "%m-%d-%Y")
    clock = (
        "(substr(v,11) = '' OR regexp_matches(substr(v,11), "
        "'^[ T]\\d{2}:\\d{2}(:\\d{2}(\\.\\d{1,6})?)?$'))"
    )
    return f"""
  SELECT {position} AS position, '{column}' AS column_name, count(*) AS n, count(v) AS p,
    count(*) FILTER (lower(v) IN ('true','false')) AS bools,
    count(*) FILTER (regexp_matches(v, '^[+-]?\\d+$') AND TRY_CAST(v AS BIGINT) IS NOT NULL) AS longs,
    min(CASE WHEN regexp_matches(v, '^[+-]?\\d+$') THEN TRY_CAST(v AS BIGINT) END) AS lo,
    max(CASE WHEN regexp_matches(v, '^[+-]?\\d+$') THEN TRY_CAST(v AS BIGINT) END) AS hi,
    count(*) FILTER (regexp_matches(v, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$')) AS nums,
    count(*) FILTER (length(v) = 10 AND {date_dmy} IS NOT NULL) AS dmy,
    count(*) FILTER (length(v) = 10 AND {date_mdy} IS NOT NULL) AS mdy,
    count(*) FILTER ({date_dmy} IS NOT NULL AND {clock}) AS sdmy,
    count(*) FILTER ({date_mdy} IS NOT NULL AND {clock}) AS smdy,
    count(*) FILTER (regexp_matches(v, '^([01]\\d|2[0-3]):[0-5]\\d(:[0-5]\\d)?$')) AS times,
    count(*) FILTER (regexp_matches(v, {_prefix(DATE_PREFIXES)})) AS pdate,
    count(*) FILTER (regexp_matches(v, {_prefix(TIME_PREFIXES)})) AS ptime,
    count(*) FILTER (regexp_matches(v, {_text(EMAIL)})) AS emails,
    count(*) FILTER (regexp_matches(v, {_text(PHONE)})) AS phones,
    max(length(v)) AS len,
    count(*) FILTER (TRY_CAST(v AS TIMESTAMP) IS NOT NULL OR TRY_CAST(v AS TIME) IS NOT NULL) AS parsed,
    count(*) FILTER (regexp_matches(replace(replace(v, ',', ''), ' ', ''),
      '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$')) AS plain,
    {", ".join(
        f"count(*) FILTER (regexp_matches(v, {_text('^(?:' + p + ')')})) AS d{i}"
        for i, p in enumerate(DATETIME_PREFIXES))}
  FROM (SELECT CASE WHEN "{column}" IN ({MISSING}) THEN NULL ELSE "{column}" END AS v FROM {table})"""


def _facts(table: str, columns: list[str]) -> str:
    return "\n  UNION ALL".join(_cell_facts(table, c, i + 1) for i, c in enumerate(columns))


BUCKET = """CASE WHEN len <= 10 THEN 'VARCHAR(10)' WHEN len <= 50 THEN 'VARCHAR(50)'
  WHEN len <= 100 THEN 'VARCHAR(100)' WHEN len <= 255 THEN 'VARCHAR(255)'
  WHEN len <= 1000 THEN 'TEXT' ELSE 'LONGTEXT' END"""

SQL_TYPE = f"""CASE WHEN p = 0 THEN 'TEXT' WHEN bools = p THEN 'BOOLEAN'
  WHEN longs = p AND lo >= -2147483648 AND hi <= 2147483647 THEN 'INT'
  WHEN longs = p THEN 'BIGINT' WHEN nums = p THEN 'DOUBLE'
  WHEN dmy = p OR mdy = p THEN 'DATE' WHEN sdmy = p OR smdy = p THEN 'DATETIME'
  WHEN times = p THEN 'TIME' WHEN emails = p THEN 'VARCHAR(100)'
  WHEN phones = p THEN 'VARCHAR(20)' ELSE {BUCKET} END"""

SEMANTIC = """CASE WHEN p = 0 OR bools = p OR longs = p OR nums = p THEN NULL
  WHEN pdate = p THEN 'date' WHEN ptime = p THEN 'time' WHEN emails = p THEN 'email'
  WHEN phones = p THEN 'phone' END"""

SPARK_TYPE = """CASE sql_type WHEN 'BOOLEAN' THEN 'boolean' WHEN 'INT' THEN 'int'
  WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date'
  WHEN 'DATETIME' THEN 'timestamp_ntz' WHEN 'TIME' THEN 'time' ELSE 'string' END"""


def _inferred(expression: str, name: str) -> str:
    return f"""WITH {MESSY}, {CONTACTS},
facts AS ({_facts("messy", ORDER_COLUMNS)}
  UNION ALL {_facts("contacts", CONTACT_COLUMNS)})
SELECT CAST(position AS BIGINT) AS position, column_name, {expression} AS {name} FROM facts"""


DATETIME_HITS = ", ".join(f"d{i}" for i in range(len(DATETIME_PREFIXES)))

# -- file sets --------------------------------------------------------------------------

FILE_NO = f"(c_custkey // {ROWS_PER_FILE})"
FILES = f"files AS (SELECT DISTINCT {FILE_NO} AS file_no, {FILE_NO} % {len(DIALECTS)} AS d FROM customer)"
NAMES = ",".join(EXTRACT_COLUMNS)
POSITIONAL = ",".join(f"column_{i + 1}" for i in range(len(EXTRACT_COLUMNS)))
PREAMBLE = ["# customer extract", "# one row per customer", "", ",".join(CUSTOMER_COLUMNS)]
CUSTOMER_LINE = (
    "c_custkey || ',' || c_name || ',' || c_nationkey || ',' || "
    "CAST(c_acctbal AS DECIMAL(18,2)) || ',' || c_mktsegment"
)
PREAMBLE_BYTES = sum(len(line) + 1 for line in PREAMBLE)


def size_text(size: str) -> str:
    def scaled(unit: int, label: str) -> str:
        return f"CAST(CAST(round({size} / {unit}.0::DOUBLE, 2) AS DECIMAL(30,2)) AS VARCHAR) || ' {label}'"

    return (
        f"CASE WHEN {size} < 1024 THEN {size} || ' B' WHEN {size} < 1048576 THEN {scaled(1024, 'KB')} "
        f"WHEN {size} < 1073741824 THEN {scaled(1048576, 'MB')} ELSE {scaled(1073741824, 'GB')} END"
    )


# -- profiles ---------------------------------------------------------------------------

LINEITEM_NUMBERS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
]
LINEITEM_WHOLE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def _numbers(column: str, table: str, digits: int | None = None) -> str:
    """Statistics of a column; with ``digits`` after the point, exact ones as text too."""
    mean, deviation = f'avg(CAST("{column}" AS DOUBLE))', f'stddev_samp(CAST("{column}" AS DOUBLE))'
    exact = "CAST(NULL AS VARCHAR) AS min_exact, CAST(NULL AS VARCHAR) AS max_exact, CAST(NULL AS VARCHAR) AS median_exact"
    median = f'CAST(median("{column}") AS DOUBLE)'
    if digits is not None:
        whole = f'CAST("{column}" * {10**digits} AS HUGEINT)'
        l = f'list_sort(list({whole}))'
        twice = f"({l}[(count(*) + 1) // 2] + {l}[count(*) // 2 + 1])"
        point = f"|| '.' || lpad(CAST(({twice} // 2) % {10**digits} AS VARCHAR), {digits}, '0')" if digits else ""
        half = "'5'" if digits else "'.5'"
        exact = (
            f'CAST(min("{column}") AS VARCHAR) AS min_exact, CAST(max("{column}") AS VARCHAR) AS max_exact, '
            f"CAST(({twice} // 2) // {10**digits} AS VARCHAR) {point} "
            f"|| CASE WHEN {twice} % 2 = 1 THEN {half} ELSE '' END AS median_exact"
        )
        median = f"CAST({twice} AS DOUBLE) / {2 * 10**digits}"
        # taken from the least value on, which loses nothing
        apart = f'CAST("{column}" - (SELECT min("{column}") FROM {table}) AS DOUBLE)'
        mean = f'CAST(CAST(min("{column}") AS DECIMAL(38,4)) + CAST(avg({apart}) AS DECIMAL(38,4)) AS DOUBLE)'
        deviation = f"stddev_samp({apart})"
    return f"""SELECT '{column}' AS column_name, round(CAST(min("{column}") AS DOUBLE), 4) AS min_val,
  round(CAST(max("{column}") AS DOUBLE), 4) AS max_val, round({mean}, 4) AS mean_val,
  round({median}, 4) AS median_val,
  round({deviation}, 4) AS std_val, {exact} FROM {table}"""


def _stats(column: str, table: str) -> str:
    return f"""SELECT '{column}' AS column_name, round(CAST(min("{column}") AS DOUBLE), 2) AS min_val,
  round(CAST(max("{column}") AS DOUBLE), 2) AS max_val, round(avg("{column}"), 2) AS avg_val,
  round(CAST(sum("{column}") AS DOUBLE), 2) AS sum_val, count(*) AS count_val,
  count("{column}") AS non_null_count FROM {table}"""


def _top(column: str, table: str) -> str:
    return f"""SELECT '{column}' AS column_name, value, frequency, rank FROM (
  SELECT "{column}" AS value, count(*) AS frequency,
         row_number() OVER (ORDER BY count(*) DESC, "{column}") AS rank
  FROM {table} WHERE "{column}" IS NOT NULL GROUP BY 1) WHERE rank <= 5"""


PARSED_DTYPES = {
    "order_id": "bigint", "customer_id": "bigint", "status": "string", "amount": "double",
    "order_date": "string", "priority": "string",
}


def _profile(column: str, position: int) -> str:
    kind = PARSED_DTYPES[column]
    number = kind != "string"

    def n(expression: str) -> str:
        return f"round(CAST({expression} AS DOUBLE), 4)" if number else "CAST(NULL AS DOUBLE)"

    length = "CAST(NULL AS DOUBLE)" if number else f"round(avg(length({column})), 4)"
    top = "CAST(NULL AS VARCHAR)" if number else (
        f"""(SELECT '[' || string_agg('{{"value":' || CAST(to_json(v) AS VARCHAR) || ',"frequency":' || n || '}}', ','
    ORDER BY n DESC, v) || ']' FROM (SELECT {column} AS v, count(*) AS n FROM parsed WHERE {column} IS NOT NULL
    GROUP BY 1 ORDER BY n DESC, v LIMIT 5))"""
    )
    return f"""SELECT '{column}' AS column_name, '{kind}' AS dtype, CAST({position} AS BIGINT) AS position,
  count(*) AS row_count, {top} AS top_values,
  count(*) - count({column}) AS null_count,
  round((count(*) - count({column})) * 100.0::DOUBLE / count(*), 2) AS null_percentage,
  count(DISTINCT {column}) AS unique_count, {n(f"min({column})")} AS min_val,
  {n(f"max({column})")} AS max_val, {n(f"avg({column})")} AS mean_val,
  {n(f"median({column})")} AS median_val, {n(f"stddev_samp({column})")} AS std_val,
  {length} AS avg_length FROM parsed"""


def _repeated(table: str, columns: str) -> str:
    return f"""SELECT '{table}' AS table_name, count(*) AS duplicate_groups,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_groups,
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows,
  CASE WHEN count(*) = 0 THEN 'Passed' ELSE 'Warning' END AS status
  FROM (SELECT count(*) AS n FROM {table} GROUP BY {columns} HAVING count(*) > 1)"""


def _diff_row(dialects: str, status: str, column: str) -> str:
    return f"SELECT file_no, '{status}' AS status, '{column}' AS column_name FROM files WHERE d IN ({dialects})"


def _column_diff() -> str:
    parts = []
    for column in EXTRACT_COLUMNS:
        if column == "segment":
            parts.append(_diff_row("0, 1, 3, 4", "common", column))
            parts.append(_diff_row("2, 5", "missing", column))
        else:
            parts.append(_diff_row("0, 1, 3, 4, 5", "common", column))
            parts.append(_diff_row("2", "missing", column))
    for i in range(len(EXTRACT_COLUMNS)):
        parts.append(_diff_row("2", "extra", f"column_{i + 1}"))
    parts.append(_diff_row("4", "extra", "channel"))
    return f"WITH {FILES} {_union(parts)}"


CHANGED_NUMBERS = ["o_orderkey", "o_custkey", "o_totalprice"]


def _overall(checks: str) -> str:
    return (
        "CASE WHEN bool_or(status = 'Failed') THEN 'Failed' WHEN bool_or(status = 'Error') THEN 'Error' "
        "WHEN bool_or(status = 'Warning') THEN 'Warning' ELSE 'Passed' END"
    )


def _check_rows(table: str, source: str, numbers: list[str], columns: list[str]) -> list[str]:
    """The rows of all checks of a table that is in order, but for the overall status."""

    def row(test, status, message, metric, value, origin, detail="CAST(NULL AS VARCHAR)"):
        return (
            f"SELECT '{test}' AS test, {status} AS status, {message} AS message, {metric} AS metric, "
            f"round(CAST({value} AS DOUBLE), 2) AS value, {detail} AS detail FROM {origin}"
        )

    parts = [row("table_exists", "'Passed'", "'table found'", "'exists'", "1", "(SELECT 1)")]
    parts.append(row("row_count", "'Info'", "'no expected count'", "'actual_count'", "count(*)", table))
    parts += [
        row("null_values", "'Info'", "'missing values'", f"'{c}'", f"count(*) - count({c})", table) for c in columns
    ]
    parts += [
        row("column_stats", "'Info'", "'numeric column'", f"'{c}.{f}'", f"{f}({c})", table)
        for c in numbers
        for f in ["min", "max", "avg", "sum"]
    ]
    first = "(SELECT *, row_number() OVER (ORDER BY o_orderkey) AS n FROM {0})"
    parts.append(
        row("sample_data", "'Info'", "'sample row'", "'row ' || n", "NULL", first.format(table) + " WHERE n <= 5",
            "CAST(o_orderkey AS VARCHAR)")
    )
    repeated = f"(SELECT o_orderkey, count(*) AS n FROM {table} GROUP BY o_orderkey HAVING count(*) > 1)"
    parts.append(
        row("duplicates", "CASE WHEN count(*) = 0 THEN 'Passed' ELSE 'Warning' END",
            "CASE WHEN count(*) = 0 THEN 'no repeated rows' ELSE 'repeated rows' END",
            "'extra_rows'", "coalesce(sum(n - 1), 0)", repeated)
    )
    parts.append(
        row("duplicates", "'Info'", "'repeated group'", "'group ' || g", "n",
            f"(SELECT *, row_number() OVER (ORDER BY n DESC, o_orderkey) AS g FROM {repeated}) WHERE g <= 10")
    )
    counts = f"(SELECT (SELECT count(*) FROM {source}) AS s, (SELECT count(*) FROM {table}) AS t)"
    agree = "CASE WHEN s = t THEN 'row counts match' ELSE 'row counts differ' END"
    parts.append(
        row("csv_comparison", "CASE WHEN s = t THEN 'Passed' ELSE 'Warning' END", agree, "'source_rows'", "s", counts)
    )
    parts.append(row("csv_comparison", "'Info'", agree, "'table_rows'", "t", counts))
    for c in ORDERS:
        samples = " IS NOT DISTINCT FROM ".join(
            f"(SELECT list({c} ORDER BY n) FROM {first.format(side)} WHERE n <= 5)" for side in (source, table)
        )
        parts.append(
            row("csv_comparison", "'Info'", "CASE WHEN m THEN 'first values match' ELSE 'first values differ' END",
                f"'{c}.first'", "CAST(m AS INTEGER)", f"(SELECT {samples} AS m)")
        )
    return parts


def _report() -> str:
    parts = _union(_check_rows("changed", "orders", CHANGED_NUMBERS, ORDERS))
    return (
        f"WITH {CHANGED}, checks AS ({parts}) SELECT * FROM checks UNION ALL SELECT 'overall', {_overall('checks')}, "
        "'most severe status', 'overall', NULL, NULL FROM checks"
    )


def _validated_tables() -> str:
    """A table in order; one of which a column cannot be read, so that checks that need it break; none."""
    good = _union(_check_rows("orders", "orders", CHANGED_NUMBERS, ORDERS))
    kept = "'good' AS subject, test, status, metric, value"
    broken = [
        "SELECT 'broken', 'table_exists', 'Passed', 'exists', 1",
        "SELECT 'broken', 'row_count', 'Info', 'actual_count', count(*) FROM orders",
        *[f"SELECT 'broken', '{t}', 'Error', '{t}', NULL" for t in ("null_values", "column_stats", "sample_data")],
        "SELECT 'broken', 'duplicates', 'Passed', 'extra_rows', 0",
        "SELECT 'broken', 'csv_comparison', 'Warning', 'source_rows', count(*) FROM orders",
        "SELECT 'broken', 'csv_comparison', 'Info', 'table_rows', count(*) FROM orders",
        *[
            f"SELECT 'broken', 'csv_comparison', 'Info', '{c}', NULL"
            for c in ("o_orderstatus", "o_orderdate", "o_orderpriority")
        ],
        "SELECT 'broken', 'csv_comparison', 'Error', 'source_samples', NULL",
        "SELECT 'broken', 'overall', 'Error', 'overall', NULL",
        "SELECT 'missing', 'table_exists', 'Failed', 'exists', 0",
        "SELECT 'missing', 'overall', 'Failed', 'overall', NULL",
    ]
    return (
        f"WITH checks AS ({good}) SELECT {kept} FROM checks UNION ALL "
        f"SELECT 'good', 'overall', {_overall('checks')}, 'overall', NULL FROM checks UNION ALL " + _union(broken)
    )


ORACLE_SQL = {
    "messy_load_report": f"""WITH {PARSED}
SELECT 'load' AS section, 'total_rows' AS subject, count(*) AS value FROM parsed
UNION ALL SELECT 'load', 'successful_rows', count(*) FROM parsed WHERE error_type IS NULL
UNION ALL SELECT 'load', 'failed_rows', count(*) FROM parsed WHERE error_type IS NOT NULL
UNION ALL SELECT 'error', error_type, count(*) FROM parsed WHERE error_type IS NOT NULL GROUP BY error_type
""" + "".join(
        f"UNION ALL SELECT 'null', '{c}', count(*) - count({c}) FROM parsed WHERE error_type IS NULL\n"
        for c in ORDER_COLUMNS
    ),
    "csv_scan": """SELECT o_orderkey, o_custkey, o_orderstatus,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "csv_delimiter_report": f"""WITH {FILES}
SELECT file_no, CASE WHEN d IN (0, 4) THEN ',' WHEN d IN (1, 5) THEN ';' WHEN d = 2 THEN chr(9)
  ELSE '|' END AS delimiter FROM files""",
    "csv_encoding_report": f"""WITH {FILES}
SELECT file_no, CASE d WHEN 1 THEN 'ISO-8859-1' WHEN 3 THEN 'UTF-16BE' WHEN 4 THEN 'UTF-8-SIG'
  ELSE 'UTF-8' END AS encoding FROM files""",
    "csv_header_report": f"""WITH {FILES}
SELECT file_no, d <> 2 AS has_header,
  CAST(CASE d WHEN 4 THEN 8 WHEN 5 THEN 6 ELSE 7 END AS BIGINT) AS num_columns,
  CASE d WHEN 2 THEN '{POSITIONAL}' WHEN 4 THEN '{NAMES},channel'
    WHEN 5 THEN '{NAMES.replace(",segment", "")}' ELSE '{NAMES}' END AS column_names FROM files""",
    "csv_header_row_skip": """SELECT c_custkey, c_name, c_nationkey,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer""",
    "csv_utf16": """SELECT c_custkey, c_name || chr(266) AS c_name, c_nationkey,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer""",
    "csv_no_header": """SELECT c_custkey AS column_1, c_name AS column_2, c_nationkey AS column_3,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS column_4, c_mktsegment AS column_5 FROM customer""",
    "csv_skip_bad_lines": f"""WITH {PARSED}
SELECT order_id, customer_id, status, amount, {DATE_OF} AS order_date, priority
FROM parsed WHERE k % 29 <> 0""",
    "sample_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000",
    "csv_head_per_file": f"""WITH lines AS (
  SELECT {FILE_NO} AS file_no, c_custkey AS k, {CUSTOMER_LINE} AS line FROM customer
  UNION ALL SELECT DISTINCT {FILE_NO}, -3, {_text(PREAMBLE[0])} FROM customer
  UNION ALL SELECT DISTINCT {FILE_NO}, -2, {_text(PREAMBLE[1])} FROM customer
  UNION ALL SELECT DISTINCT {FILE_NO}, -1, {_text(PREAMBLE[3])} FROM customer)
SELECT file_no, line_no, line FROM (
  SELECT file_no, line, row_number() OVER (PARTITION BY file_no ORDER BY k) AS line_no FROM lines)
WHERE line_no <= 5""",
    "table_write_append": f"WITH {CHANGED} SELECT * FROM orders UNION ALL SELECT * FROM changed",
    "table_write_replace": "SELECT * FROM orders",
    "table_write_fail": "SELECT *, true AS refused FROM customer",
    "add_surrogate_id": "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, * FROM orders",
    "ingest_incremental": """SELECT o_orderkey, o_custkey, o_orderstatus,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "ingest_table": """SELECT o_orderkey, o_custkey, o_orderstatus,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority,
  true AS ids_dense FROM orders""",
    "quarantine_rows": f"""WITH {PARSED}
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
  status_text AS status, NULLIF(amount_text, '') AS amount, order_date, priority, error_type,
  CASE WHEN error_type = 'malformed_row' THEN 'too many fields: ' || order_id || ';' || customer_id
    || ';' || status_text || ';' || amount_text || ';' || order_date || ';' || priority || ';EXTRA'
    ELSE 'amount: cannot read ''bad'' as double' END AS error_message
FROM parsed WHERE error_type IS NOT NULL""",
    "quarantine_keys": f"""WITH {PARSED},
marked AS (SELECT order_id, k, coalesce(error_type, CASE WHEN status IS NULL THEN 'null_violation' END)
  AS error_type, row_number() OVER (PARTITION BY order_id) AS copy FROM parsed),
final AS (SELECT coalesce(error_type, CASE WHEN copy > 1 THEN 'duplicate_key' END) AS error_type FROM marked)
SELECT error_type, count(*) AS error_count FROM final WHERE error_type IS NOT NULL GROUP BY error_type""",
    "error_stats": f"""WITH {PARSED}
SELECT error_type, count(*) AS error_count FROM parsed WHERE error_type IS NOT NULL GROUP BY error_type""",
    "load_stats": f"""WITH {PARSED},
t AS (SELECT count(*) AS total_rows, count(*) FILTER (error_type IS NULL) AS successful_rows,
  count(*) FILTER (error_type IS NOT NULL) AS failed_rows FROM parsed)
SELECT *, CAST(CAST(round(successful_rows * 100.0::DOUBLE / total_rows, 2) AS DECIMAL(30,2)) AS VARCHAR)
  || '%' AS success_rate,
  CASE WHEN failed_rows = 0 THEN 'Completed' ELSE 'Completed with errors' END AS status FROM t""",
    "file_inventory": f"""WITH f AS (SELECT {FILE_NO} AS file_no, count(*) AS n,
  CAST(sum(strlen({CUSTOMER_LINE}) + 1) AS BIGINT) + {PREAMBLE_BYTES} AS size FROM customer GROUP BY 1)
SELECT file_no, 'txt' AS extension, size AS file_size, {size_text("size")} AS size_text,
  n + {len(PREAMBLE)} AS estimated_rows FROM f""",
    "load_delimited": f"""WITH {PARSED}
SELECT row_number() OVER (ORDER BY order_id) AS id, order_id, customer_id, status, amount,
  {DATE_OF} AS order_date, priority FROM parsed WHERE error_type IS NULL""",
    "analyze_files": f"""WITH cells AS (SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer),
facts AS ({_facts("cells", CUSTOMER_COLUMNS)})
SELECT CAST(position AS BIGINT) AS position, column_name, {SQL_TYPE} AS sql_type, n > p AS nullable,
  len AS max_length, 'UTF-8' AS encoding, ',' AS delimiter, true AS has_header FROM facts""",
    "infer_column_types": _inferred(SQL_TYPE, "sql_type"),
    "infer_nullability": f"""WITH {MESSY}, facts AS ({_facts("messy", ORDER_COLUMNS)})
SELECT CAST(position AS BIGINT) AS position, column_name, n - p AS null_count, n > p AS nullable FROM facts""",
    "infer_varchar_bucket": "WITH facts AS (" + _union(
        f"""SELECT {i} AS position, '{c}' AS column_name, max(length("{c}")) AS len FROM {t}
  WHERE "{c}" NOT IN ({MISSING})"""
        for t, columns in [("documents", ["text", "lang", "source"]), ("customer", ["c_name", "c_mktsegment"])]
        for i, c in enumerate(columns, 1)
    ) + f""")
SELECT CAST(position AS BIGINT) AS position, column_name, len AS max_length, {BUCKET} AS bucket FROM facts""",
    "infer_semantic_type": _inferred(SEMANTIC, "semantic_type"),
    "likely_datetime": _inferred(
        f"p > 0 AND (greatest({DATETIME_HITS}) > p * 0.7 OR parsed = p)", "likely_datetime"
    ),
    "likely_numeric": _inferred("p > 0 AND plain = p", "likely_numeric"),
    "typed_cast": f"""WITH {PARSED}
SELECT order_id, customer_id, status, amount, {DATE_OF} AS order_date, priority FROM parsed""",
    "schema_report": f"""WITH {MESSY}, facts AS ({_facts("messy", ORDER_COLUMNS)}),
typed AS (SELECT *, {SQL_TYPE} AS sql_type FROM facts)
SELECT CAST(position AS BIGINT) AS position, column_name, sql_type, {SPARK_TYPE} AS spark_type,
  n > p AND column_name <> 'order_id' AS nullable, {SEMANTIC} AS semantic_type, len AS max_length,
  column_name = 'order_id' AS is_key, greatest(dmy, sdmy) >= greatest(mdy, smdy) AS day_first FROM typed""",
    "schema_override": f"""WITH {MESSY}, facts AS ({_facts("messy", ORDER_COLUMNS)}),
typed AS (SELECT *, CASE column_name WHEN 'amount' THEN 'DECIMAL(12,2)' WHEN 'customer_id' THEN 'BIGINT'
  WHEN 'priority' THEN 'SMALLINT' ELSE {SQL_TYPE} END AS sql_type FROM facts)
SELECT CAST(position AS BIGINT) AS position, column_name, sql_type,
  CASE column_name WHEN 'amount' THEN 'decimal(12,2)' WHEN 'priority' THEN 'smallint' ELSE {SPARK_TYPE} END AS spark_type
FROM typed""",
    "load_mixed_files": """SELECT c_custkey AS customer_id, c_name AS full_name, c_nationkey AS nation,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance,
  CAST(DATE '2020-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS opened,
  CASE WHEN d <> 5 THEN c_mktsegment END AS segment,
  'café, ' || lower(c_mktsegment) || '; visit|call' AS note, CASE WHEN d = 4 THEN 'web' END AS channel
FROM (SELECT *, (c_custkey // 50) % 6 AS d FROM customer)""",
    "load_with_id": "SELECT CAST(o_orderkey AS INTEGER) AS id, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus FROM orders",
    "csv_stray_quotes": """SELECT o_orderkey AS id, '5" pipe' AS item, o_orderstatus AS status,
  o_orderkey % 7 = 0 AS bad FROM orders""",
    "sanitize_names": r"""WITH names AS (SELECT p_name AS name FROM part UNION SELECT text FROM conversations),
s AS (SELECT name, regexp_replace(regexp_replace(name, '[^\p{L}\p{N}_]', '_', 'g'), '_+', '_', 'g') AS w FROM names)
SELECT name, CASE WHEN regexp_matches(w, '^\p{Nd}') THEN 'col_' || w ELSE w END AS sanitized FROM s""",
    "normalize_names": r"""WITH names AS (SELECT p_name AS name FROM part
  UNION SELECT text FROM conversations UNION ALL SELECT NULL),
s AS (SELECT name, regexp_replace(regexp_replace(name, '[^\p{L}\p{N}_\s]', '_', 'g'), '\s+', '_', 'g') AS w FROM names)
SELECT name, CASE WHEN name IS NULL THEN 'unnamed_column'
  WHEN w <> '' AND NOT regexp_matches(w, '^[a-zA-Z_]') THEN lower('col_' || w) ELSE lower(w) END AS normalized
FROM s""",
    "column_stats": _union(_stats(c, "lineitem") for c in LINEITEM_NUMBERS),
    "null_counts": f"WITH {PARSED} " + _union(
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, count(*) - count({c}) AS null_count FROM parsed"
        for i, c in enumerate(ORDER_COLUMNS, 1)
    ),
    "null_percentage": f"WITH {PARSED} " + _union(
        f"""SELECT '{c}' AS column_name,
  round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS null_percentage FROM parsed"""
        for c in ORDER_COLUMNS
    ),
    "table_summary": f"""WITH {PARSED},
d AS (SELECT count(*) AS n FROM parsed
  GROUP BY order_id, customer_id, status, amount, order_date, priority)
SELECT (SELECT count(*) FROM parsed) AS row_count, CAST(6 AS BIGINT) AS column_count,
  CAST((SELECT sum(n - 1) FROM d) AS BIGINT) AS duplicated_rows,
  (SELECT 6 * count(*) - count(order_id) - count(customer_id) - count(status) - count(amount)
    - count(order_date) - count(priority) FROM parsed) AS null_values_total""",
    "unique_counts": _union(
        f"""SELECT '{c}' AS column_name, count(DISTINCT "{c}") AS unique_count FROM {t}"""
        for t, columns in [("orders", ORDERS), ("documents", DOCUMENTS)]
        for c in columns
    ),
    "numeric_summary": "WITH b AS (SELECT o_orderkey * 3 + 9007199254740993 AS big, "
    "CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST('100000000000000000000' AS DECIMAL(38,2)) AS DECIMAL(38,2)) AS wide "
    "FROM orders) "
    + _union(
        [
            *(_numbers(c, "lineitem", 0 if c in LINEITEM_WHOLE else None) for c in LINEITEM_NUMBERS),
            _numbers("big", "b", 0),
            _numbers("wide", "b", 2),
        ]
    ),
    "string_avg_length": _union(
        f"""SELECT '{c}' AS column_name, round(avg(length("{c}")), 4) AS avg_length FROM documents"""
        for c in ["text", "lang", "source"]
    ),
    "top_values": _union(
        _top(c, t)
        for t, columns in [
            ("orders", ["o_orderstatus", "o_orderpriority"]),
            ("part", ["p_name", "p_brand", "p_type"]),
            ("documents", ["text", "lang", "source"]),
        ]
        for c in columns
    ),
    "data_size": f"""WITH s AS (
  SELECT 'documents' AS table_name,
    CAST(sum(16 + strlen(text) + strlen(lang) + strlen(source)) AS BIGINT) AS data_bytes FROM documents
  UNION ALL SELECT 'orders',
    CAST(sum(32 + strlen(o_orderstatus) + strlen(o_orderpriority)) AS BIGINT) FROM orders)
SELECT table_name, data_bytes, {size_text("data_bytes")} AS data_size FROM s""",
    "column_profile": f"WITH {PARSED} " + _union(
        _profile(c, i) for i, c in enumerate(ORDER_COLUMNS, 1)
    ),
    "check_row_count": f"""WITH {CHANGED},
c AS (SELECT (SELECT count(*) FROM changed) AS actual_count, (SELECT count(*) FROM orders) AS expected_count)
SELECT actual_count, expected_count,
  CASE WHEN actual_count = expected_count THEN 'Passed' ELSE 'Failed' END AS status FROM c
UNION ALL SELECT actual_count, NULL, 'Info' FROM c""",
    "duplicate_groups": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
ORDER BY copies DESC, l_orderkey, l_linenumber LIMIT 10""",
    "duplicate_total": _union(
        [
            _repeated("lineitem", "l_orderkey, l_linenumber"),
            _repeated("documents", "text"),
            _repeated("conversations", "conv_id, turn"),
        ]
    ),
    "compare_row_counts": f"""WITH {CHANGED},
c AS (SELECT (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM changed) AS table_rows)
SELECT *, source_rows = table_rows AS rows_match FROM c""",
    "compare_status": f"""WITH {CHANGED},
c AS (SELECT (SELECT count(*) FROM orders) AS s, (SELECT count(*) FROM changed) AS t),
v AS (SELECT s AS source_rows, s AS table_rows, 0 AS missing_columns FROM c
  UNION ALL SELECT s, t, 0 FROM c UNION ALL SELECT s, s, 1 FROM c)
SELECT source_rows, table_rows, source_rows = table_rows AS rows_match,
  CAST(missing_columns AS BIGINT) AS missing_columns,
  CASE WHEN source_rows = table_rows AND missing_columns = 0 THEN 'Passed' ELSE 'Warning' END AS status FROM v""",
    "column_set_diff": _column_diff(),
    "sample_comparison": f"WITH {CHANGED}, "
    "a AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders), "
    "b AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS r FROM changed) "
    + _union(
        f"""SELECT '{c}' AS column_name, bool_and(a."{c}" IS NOT DISTINCT FROM b."{c}") AS match
  FROM a JOIN b USING (r) WHERE r <= 5"""
        for c in ORDERS
    ),
    "reconcile_by_key": f"""WITH {CHANGED},
j AS (SELECT CASE WHEN b.o_orderkey IS NULL THEN 'only_source' WHEN a.o_orderkey IS NULL THEN 'only_target'
    WHEN a.o_custkey IS NOT DISTINCT FROM b.o_custkey AND a.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus
     AND a.o_totalprice IS NOT DISTINCT FROM b.o_totalprice AND a.o_orderdate IS NOT DISTINCT FROM b.o_orderdate
     AND a.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority THEN 'same' ELSE 'changed' END AS outcome
  FROM orders a FULL JOIN changed b ON a.o_orderkey = b.o_orderkey)
SELECT outcome, (SELECT count(*) FROM j WHERE j.outcome = o.outcome) AS key_count
FROM (VALUES ('same'), ('changed'), ('only_source'), ('only_target')) AS o(outcome)""",
    "reconcile_multiset": f"""WITH {CHANGED},
s AS ((SELECT * FROM orders EXCEPT ALL SELECT * FROM changed)),
t AS ((SELECT * FROM changed EXCEPT ALL SELECT * FROM orders))
SELECT {", ".join(ORDERS)}, count(*) AS extra_in_source, CAST(0 AS BIGINT) AS extra_in_target
FROM s GROUP BY ALL
UNION ALL SELECT {", ".join(ORDERS)}, CAST(0 AS BIGINT), count(*) FROM t GROUP BY ALL""",
    "validation_report": _report(),
    "validate_table": _validated_tables(),
    "quality_gate": f"""WITH {PARSED},
good AS (SELECT * FROM parsed WHERE error_type IS NULL),
r AS (SELECT (SELECT count(*) FROM good) * 100.0::DOUBLE / (SELECT count(*) FROM parsed) AS rate)
SELECT 'success_rate' AS rule, 'rows' AS subject, round(rate, 2) AS value,
  CASE WHEN rate >= 95 THEN 'Passed' ELSE 'Failed' END AS status FROM r
""" + "".join(
        f"""UNION ALL SELECT 'not_null', '{c}', CAST(count(*) - count({c}) AS DOUBLE),
  CASE WHEN count(*) = count({c}) THEN 'Passed' ELSE 'Failed' END FROM good
"""
        for c in ["order_id", "status"]
    ) + """UNION ALL SELECT 'unique_key', 'order_id', CAST(count(*) - count(DISTINCT order_id) AS DOUBLE),
  CASE WHEN count(*) = count(DISTINCT order_id) THEN 'Passed' ELSE 'Failed' END FROM good""",
    "table_stats_report": """WITH t AS (
  SELECT 'orders' AS table_name, count(*) AS row_count, 6 AS column_count FROM orders
  UNION ALL SELECT 'customer', count(*), 5 FROM customer
  UNION ALL SELECT 'part', count(*), 6 FROM part)
SELECT table_name, row_count, CAST(column_count AS BIGINT) AS column_count, true AS has_bytes FROM t
UNION ALL SELECT '(all tables)', CAST(sum(row_count) AS BIGINT), CAST(sum(column_count) AS BIGINT), true FROM t""",
}
