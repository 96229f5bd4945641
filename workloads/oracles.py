"""Plain SQL that states what each registered query must return."""

from __future__ import annotations

ORDERS_SOURCE = """
SELECT o_orderkey AS id, cast(year(o_orderdate) AS string) AS year,
 lpad(cast(month(o_orderdate) AS string), 2, '0') AS month,
 cast(cast(floor((day(o_orderdate) - 1) / 7) AS int) + 1 AS string) AS week,
 cast(o_totalprice AS string) AS amount, o_orderstatus AS status, o_orderpriority AS priority,
 cast(cast(o_orderdate AS date) AS string) AS order_date
FROM orders"""

ORDERS_DEST = """
SELECT o_orderkey AS id, cast(year(o_orderdate) AS string) AS year,
 lpad(cast(month(o_orderdate) AS string), 2, '0') AS month,
 cast(cast(floor((day(o_orderdate) - 1) / 7) AS int) + 1 AS string) AS week,
 CASE WHEN o_orderkey % 31 = 0 THEN o_totalprice + 1.0
      WHEN o_orderkey % 37 = 0 THEN o_totalprice + 0.000001 ELSE o_totalprice END AS amount,
 CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN concat('  ', o_orderstatus, ' ')
      WHEN o_orderkey % 59 = 0 THEN 'X' ELSE o_orderstatus END AS status,
 CASE WHEN o_orderkey % 47 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS priority,
 CASE WHEN o_orderkey % 53 = 0 THEN cast(cast(cast(o_orderdate AS date) + INTERVAL 1 DAY AS date) AS string)
      ELSE concat(cast(cast(o_orderdate AS date) AS string), ' 00:00:00') END AS order_date
FROM orders WHERE o_orderkey % 97 <> 0
UNION ALL
SELECT o_orderkey + 1000000000, cast(year(o_orderdate) AS string),
 lpad(cast(month(o_orderdate) AS string), 2, '0'),
 cast(cast(floor((day(o_orderdate) - 1) / 7) AS int) + 1 AS string),
 o_totalprice, o_orderstatus, o_orderpriority, cast(cast(o_orderdate AS date) AS string)
FROM orders WHERE o_orderkey % 89 = 0"""

LINES_SOURCE = """
SELECT l_orderkey AS id, cast(year(l_shipdate) AS string) AS year,
 lpad(cast(month(l_shipdate) AS string), 2, '0') AS month,
 l_linenumber AS line, l_quantity AS quantity, l_extendedprice AS price, l_returnflag AS flag
FROM lineitem"""

LINES_DEST = """
SELECT l_orderkey AS id, cast(year(l_shipdate) AS string) AS year,
 lpad(cast(month(l_shipdate) AS string), 2, '0') AS month, l_linenumber AS line,
 CASE WHEN l_orderkey % 11 = 0 THEN l_quantity + 1 ELSE l_quantity END AS quantity,
 l_extendedprice AS price, l_returnflag AS flag
FROM lineitem WHERE NOT (l_orderkey % 5 = 0 AND l_linenumber >= 6)"""


def _decimal_text(number: str) -> str:
    return f"cast(cast({number} AS decimal(38,5)) AS varchar)"


# Canonical values of the orders pair: c_* is the text, n_amount the number.
_ORDERS_CANON = f"""
 SELECT id, year, month, week, amount, status, priority, order_date,
  try_cast(amount AS double) AS n_amount,
  {_decimal_text("try_cast(amount AS double)")} AS c_amount,
  trim(status) AS c_status, trim(priority) AS c_priority,
  cast(try_cast(substr(order_date, 1, 10) AS date) AS varchar) AS c_order_date"""

_ROW_MD5 = (
    "md5(concat_ws(chr(31), coalesce(c_amount, chr(30)), coalesce(c_order_date, chr(30)),"
    " coalesce(c_priority, chr(30)), coalesce(c_status, chr(30))))"
)

ORDERS = f"""WITH src0 AS ({ORDERS_SOURCE}), dst0 AS ({ORDERS_DEST}),
src1 AS ({_ORDERS_CANON} FROM src0), dst1 AS ({_ORDERS_CANON} FROM dst0),
src AS (SELECT *, {_ROW_MD5} AS h FROM src1), dst AS (SELECT *, {_ROW_MD5} AS h FROM dst1),
pairs AS (
 SELECT s.id, s.year, s.month, s.week, s.h AS s_h, d.h AS d_h,
  s.n_amount AS s_n, d.n_amount AS d_n, s.amount AS s_raw_amount, s.status AS s_raw_status,
  s.priority AS s_raw_priority, s.order_date AS s_raw_order_date,
  s.c_amount AS s_amount, d.c_amount AS d_amount, s.c_status AS s_status, d.c_status AS d_status,
  s.c_priority AS s_priority, d.c_priority AS d_priority,
  s.c_order_date AS s_order_date, d.c_order_date AS d_order_date
 FROM src s JOIN dst d USING (id, year, month, week)),
missing AS (SELECT s.* FROM src s LEFT JOIN dst d USING (id, year, month, week) WHERE d.id IS NULL),
extra AS (SELECT d.* FROM dst d LEFT JOIN src s USING (id, year, month, week) WHERE s.id IS NULL),
"""


def _cells(tolerance: str | None) -> str:
    """Differing cells of the orders pair, NULL differences included."""
    unequal = f"abs(s_n - d_n) >= {tolerance}" if tolerance else "s_n <> d_n"
    parts = [
        f"SELECT id, year, month, week, 'amount' AS \"column\", s_amount AS source_value,"
        f" d_amount AS dest_value, s_raw_amount AS source_raw, s_h, d_h FROM pairs WHERE {unequal}"
    ]
    parts += [
        f"SELECT id, year, month, week, '{c}', s_{c}, d_{c}, s_raw_{c}, s_h, d_h"
        f" FROM pairs WHERE s_{c} IS DISTINCT FROM d_{c}"
        for c in ("status", "priority", "order_date")
    ]
    return " UNION ALL ".join(parts)


CELLS = ORDERS + f"cells AS ({_cells('0.00001')}),\n"
STRICT_CELLS = ORDERS + f"cells AS ({_cells(None)}),\n"

REPORT = CELLS + """report AS (
 SELECT cast(id AS varchar) AS primary_key, 'mismatch' AS type, "column", source_value, dest_value,
  s_h AS source_hash, d_h AS dest_hash, year, month, week, source_raw FROM cells
 UNION ALL
 SELECT cast(id AS varchar), 'missing_in_dest', NULL, NULL, NULL, NULL, NULL, year, month, week, NULL FROM missing
 UNION ALL
 SELECT cast(id AS varchar), 'extra_in_dest', NULL, NULL, NULL, NULL, NULL, year, month, week, NULL FROM extra),
"""


def _end(prelude: str, final: str) -> str:
    return prelude.rstrip().rstrip(",") + "\n" + final


def _lines(key: str = "id", partition: str = "id, year, month") -> str:
    """Duplicate keys of the line pair, paired by position."""
    order = "ORDER BY line, quantity, price, flag"
    return f"""WITH src0 AS ({LINES_SOURCE}), dst0 AS ({LINES_DEST}),
src AS (SELECT *, {key} AS k, row_number() OVER (PARTITION BY {partition} {order}) AS rn FROM src0),
dst AS (SELECT *, {key} AS k, row_number() OVER (PARTITION BY {partition} {order}) AS rn FROM dst0),
aligned AS (
 SELECT coalesce(s.k, d.k) AS id, coalesce(s.year, d.year) AS year, coalesce(s.month, d.month) AS month,
  coalesce(s.rn, d.rn) AS occurrence, s.line AS s_line, d.line AS d_line, s.quantity AS s_quantity,
  d.quantity AS d_quantity, s.price AS s_price, d.price AS d_price, s.flag AS s_flag, d.flag AS d_flag
 FROM src s FULL OUTER JOIN dst d
  ON s.k = d.k AND s.year = d.year AND s.month = d.month AND s.rn = d.rn),
"""


def _lines_report(key: str = "id", partition: str = "id, year, month", columns=None) -> str:
    numbers = [c for c in ("line", "quantity", "price") if columns is None or c in columns]
    parts = [
        f"SELECT id, year, month, occurrence, 'mismatch' AS type, '{c}' AS \"column\","
        f" {_decimal_text('s_' + c)} AS source_value, {_decimal_text('d_' + c)} AS dest_value"
        f" FROM aligned WHERE abs(s_{c} - d_{c}) >= 0.00001"
        for c in numbers
    ]
    parts += [
        "SELECT id, year, month, occurrence, 'mismatch', 'flag', trim(s_flag), trim(d_flag)"
        " FROM aligned WHERE trim(s_flag) <> trim(d_flag)",
        "SELECT id, year, month, occurrence, 'missing_in_dest', NULL, NULL, NULL"
        " FROM aligned WHERE d_price IS NULL",
        "SELECT id, year, month, occurrence, 'extra_in_dest', NULL, NULL, NULL"
        " FROM aligned WHERE s_price IS NULL",
    ]
    final = (
        "SELECT cast(id AS varchar) AS primary_key, type, \"column\", source_value, dest_value, year,"
        " month, cast(occurrence AS varchar) AS occurrence FROM (" + " UNION ALL ".join(parts) + ")"
    )
    return _end(_lines(key, partition), final)


_REPORT_COLUMNS = 'primary_key, type, "column", source_value, dest_value, year, month, week'

_UPDATE_LABEL = "concat_ws('-', year, month, week)"

# A later run over a destination in which other rows differ.
_SECOND_RUN = """changed AS (
 SELECT id, year, month, week, s_amount, s_n, CASE WHEN id % 3 = 0 THEN d_n + 2 ELSE d_n END AS d_n2 FROM pairs),
later AS (
 SELECT cast(id AS varchar) AS primary_key, 'amount' AS "column", s_amount AS source_value,
  cast(cast(d_n2 AS decimal(38,5)) AS varchar) AS dest_value, year, month, week
 FROM changed WHERE abs(s_n - d_n2) >= 0.00001),
first_run AS (
 SELECT primary_key, "column", source_value, dest_value, year, month, week
 FROM report WHERE type = 'mismatch'),
"""

_PLAN = """plan AS (
 SELECT primary_key, year, month, week, "column", source_raw, source_value, dest_value
 FROM report WHERE type = 'mismatch' AND source_value IS NOT NULL AND source_value <> ''),
"""

_REPAIRED = (
    _PLAN
    + """fixes AS (
 SELECT primary_key, year, month, week,
  max(CASE WHEN "column" = 'amount' THEN source_raw END) AS f_amount,
  max(CASE WHEN "column" = 'status' THEN source_raw END) AS f_status,
  max(CASE WHEN "column" = 'priority' THEN source_raw END) AS f_priority,
  max(CASE WHEN "column" = 'order_date' THEN source_raw END) AS f_order_date
 FROM plan GROUP BY ALL),
repaired AS (
 SELECT d.id, d.year, d.month, d.week, coalesce(cast(f_amount AS double), amount) AS amount,
  coalesce(f_status, status) AS status, coalesce(f_priority, priority) AS priority,
  coalesce(f_order_date, order_date) AS order_date
 FROM dst0 d LEFT JOIN fixes f ON cast(d.id AS varchar) = f.primary_key
  AND d.year = f.year AND d.month = f.month AND d.week = f.week),
"""
)

_NULLABLE = """WITH src AS (
 SELECT CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_orderkey END AS id,
  cast(year(o_orderdate) AS string) AS year, o_totalprice AS amount FROM orders),
dst AS (
 SELECT CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_orderkey END AS id,
  cast(year(o_orderdate) AS string) AS year, o_totalprice AS amount FROM orders)
"""

_SCOPED = """WITH src0 AS (""" + ORDERS_SOURCE + """), dst0 AS (""" + ORDERS_DEST + """),
scoped_src AS (SELECT *, CASE WHEN year = '1998' AND month = '05' AND week IN ('1', '3') THEN week END AS entry_week
 FROM src0 WHERE (year = '1998' AND month = '05' AND week IN ('1', '3')) OR (year = '1997' AND month = '11')),
scoped_dst AS (SELECT *, CASE WHEN year = '1998' AND month = '05' AND week IN ('1', '3') THEN week END AS entry_week
 FROM dst0 WHERE (year = '1998' AND month = '05' AND week IN ('1', '3')) OR (year = '1997' AND month = '11')),
joined AS (
 SELECT coalesce(s.id, d.id) AS id, coalesce(s.year, d.year) AS year, coalesce(s.month, d.month) AS month,
  coalesce(s.entry_week, d.entry_week) AS week, s.id AS s_id, d.id AS d_id,
  try_cast(s.amount AS double) AS s_n, d.amount AS d_n, trim(s.status) AS s_status, trim(d.status) AS d_status,
  s.priority AS s_priority, d.priority AS d_priority, substr(s.order_date, 1, 10) AS s_order_date,
  substr(d.order_date, 1, 10) AS d_order_date
 FROM scoped_src s FULL OUTER JOIN scoped_dst d ON s.id = d.id AND s.year = d.year AND s.month = d.month
  AND s.entry_week IS NOT DISTINCT FROM d.entry_week)
"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    orders_columns = "id, year, month, week, amount, status, priority, order_date"

    sql["scan_partition"] = (
        f"WITH src AS ({ORDERS_SOURCE}) SELECT {orders_columns}, year AS part_year, month AS part_month,"
        " cast(NULL AS varchar) AS part_week FROM src WHERE year = '1998' AND month = '05'"
    )
    sql["project_mapped"] = (
        "SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS amount,"
        " o_orderstatus AS status FROM orders"
    )
    sql["filter_partition"] = (
        "SELECT o_orderkey AS id, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders"
        " WHERE (year(o_orderdate) = 1998 AND month(o_orderdate) = 5)"
        " OR (year(o_orderdate) = 1997 AND month(o_orderdate) = 11)"
    )
    sql["filter_partition_week"] = (
        f"WITH src AS ({ORDERS_SOURCE}) SELECT id, year, month, week, week AS part_week FROM src"
        " WHERE year = '1998' AND month = '05' AND week IN ('1', '3')"
    )
    sql["filter_record"] = f"WITH src AS ({ORDERS_SOURCE}) SELECT {orders_columns} FROM src WHERE id = 42"
    sql["scan_ordered"] = f"WITH src AS ({ORDERS_SOURCE}) SELECT {orders_columns} FROM src ORDER BY id"
    sql["scan_limit"] = (
        f"WITH src AS ({ORDERS_SOURCE}), ranked AS (SELECT *, row_number() OVER"
        " (PARTITION BY year, month ORDER BY id) AS rn FROM src)"
        f" SELECT {orders_columns} FROM ranked WHERE rn <= 5"
    )
    sql["scan_limit_large"] = (
        f"WITH src AS ({LINES_SOURCE}), ranked AS (SELECT *, row_number() OVER"
        " (PARTITION BY year ORDER BY id, line, quantity, price, flag) AS rn FROM src)"
        " SELECT id, year, '01' AS month, line, quantity, price, flag FROM ranked WHERE rn <= 2000"
    )
    sql["expand_partitions"] = (
        "SELECT DISTINCT cast(year(o_orderdate) AS varchar) AS year,"
        " lpad(cast(month(o_orderdate) AS varchar), 2, '0') AS month,"
        " CASE WHEN month(o_orderdate) % 2 = 0"
        " THEN cast(cast(floor((day(o_orderdate) - 1) / 7) AS int) + 1 AS varchar) END AS week FROM orders"
    )
    sql["partition_label"] = (
        f"WITH src AS ({ORDERS_SOURCE}) SELECT year, month, week, CASE WHEN year IS NULL THEN 'all' ELSE"
        " year || coalesce('-' || month, '') || coalesce('-W' || week, '') END AS label,"
        " count(*) AS n FROM src GROUP BY ROLLUP (year, month, week)"
    )
    sql["sanitize_cells"] = _end(
        ORDERS,
        "SELECT 'source' AS side, id, n_amount AS amount_number, cast(NULL AS varchar) AS amount_text,"
        " c_status AS status_text, c_priority AS priority_text, c_order_date AS order_day FROM src"
        " UNION ALL SELECT 'destination', id, n_amount, NULL, c_status, c_priority, c_order_date FROM dst",
    )
    sql["normalize_cells"] = _end(
        ORDERS,
        "SELECT 'source' AS side, id, c_amount AS amount, c_status AS status, c_priority AS priority,"
        " c_order_date AS order_date FROM src UNION ALL"
        " SELECT 'destination', id, c_amount, c_status, c_priority, c_order_date FROM dst",
    )
    sql["cell_equality"] = _end(
        ORDERS,
        "SELECT id, abs(s_n - d_n) < 0.00001 AS amount_equal, s_status IS NOT DISTINCT FROM d_status AS"
        " status_equal, s_priority = d_priority AS priority_equal, s_order_date = d_order_date AS"
        " order_date_equal FROM pairs",
    )
    sql["parse_dates"] = (
        "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 6 THEN NULL"
        " ELSE cast(cast(o_orderdate AS date) AS varchar) END AS day FROM orders"
    )
    sql["parse_numbers"] = (
        "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 6 IN (0, 1, 3) THEN o_totalprice"
        " WHEN o_orderkey % 6 = 2 THEN -o_totalprice END AS number FROM orders"
    )
    sql["row_hash"] = _end(ORDERS, "SELECT id, h AS digest FROM src")
    sql["align_full_outer"] = _end(
        ORDERS,
        "SELECT coalesce(s.id, d.id) AS id, coalesce(s.year, d.year) AS year, coalesce(s.month, d.month)"
        " AS month, coalesce(s.week, d.week) AS week, s.amount AS source_amount, d.amount AS dest_amount,"
        " s.id IS NOT NULL AS in_source, d.id IS NOT NULL AS in_dest FROM src s FULL OUTER JOIN dst d ON"
        " s.id = d.id AND s.year = d.year AND s.month = d.month AND s.week = d.week",
    )
    sql["matched_pairs"] = _end(ORDERS, "SELECT id, year, month, week, s_status, d_status FROM pairs")
    sql["missing_in_dest"] = _end(ORDERS, "SELECT id, year, month, week, status FROM missing")
    sql["extra_in_dest"] = _end(ORDERS, "SELECT id, year, month, week, status FROM extra")
    sql["common_keys"] = _end(
        ORDERS,
        "SELECT id, year, month, week FROM src INTERSECT SELECT id, year, month, week FROM dst",
    )
    sql["null_key_count"] = (
        _NULLABLE + "SELECT 'source' AS side, count(*) AS rows, count(*) - count(id) AS null_keys FROM src"
        " UNION ALL SELECT 'destination', count(*), count(*) - count(id) FROM dst"
    )
    sql["align_null_keys"] = (
        _NULLABLE + "SELECT coalesce(s.id, d.id) AS id, coalesce(s.year, d.year) AS year,"
        " s.year IS NOT NULL AS in_source, d.year IS NOT NULL AS in_dest FROM src s FULL OUTER JOIN dst d"
        " ON s.id = d.id AND s.year = d.year"
    )
    sql["align_duplicate_keys"] = _end(
        _lines(),
        "SELECT id, year, month, occurrence, s_line, d_line, s_quantity, d_quantity, s_price, d_price"
        " FROM aligned",
    )
    sql["align_split_keys"] = _end(
        _lines("line", "line, year, month"),
        "SELECT id, year, month, occurrence, s_quantity, d_quantity, s_price, d_price, s_flag, d_flag"
        " FROM aligned",
    )
    sql["duplicate_keys"] = (
        f"WITH src AS ({LINES_SOURCE}), dst AS ({LINES_DEST}), rows_ AS ("
        " SELECT id, year, month, 1 AS s, 0 AS d FROM src UNION ALL SELECT id, year, month, 0, 1 FROM dst)"
        " SELECT id, year, month, sum(s)::bigint AS src_rows, sum(d)::bigint AS dest_rows FROM rows_"
        " GROUP BY ALL HAVING sum(s) > 1 OR sum(d) > 1"
    )
    sql["discard_by_hash"] = _end(
        ORDERS,
        "SELECT 'source' AS side, id, year, month, week FROM (SELECT id, year, month, week, h FROM src"
        " EXCEPT ALL SELECT id, year, month, week, h FROM dst) UNION ALL SELECT 'destination', id, year,"
        " month, week FROM (SELECT id, year, month, week, h FROM dst EXCEPT ALL SELECT id, year, month,"
        " week, h FROM src)",
    )
    sql["pairs_hash_differs"] = _end(
        ORDERS, "SELECT id, year, month, week, s_h AS source_hash, d_h AS dest_hash FROM pairs WHERE s_h <> d_h"
    )
    sql["hash_discard_counts"] = _end(
        ORDERS,
        "SELECT year, month, week, count(*) FILTER (s_h = d_h) AS discarded,"
        " count(*) FILTER (s_h <> d_h) AS kept FROM pairs GROUP BY year, month, week",
    )
    sql["side_row_counts"] = _end(
        ORDERS,
        "SELECT year, month, week, sum(s)::bigint AS src_rows, sum(d)::bigint AS dest_rows FROM (SELECT year,"
        " month, week, 1 AS s, 0 AS d FROM src UNION ALL SELECT year, month, week, 0, 1 FROM dst) GROUP BY ALL",
    )

    cell = 'id, year, month, week, "column", source_value, dest_value'
    sql["diff_include_nulls"] = _end(CELLS, f"SELECT {cell} FROM cells")
    no_nulls = "source_value IS NOT NULL AND dest_value IS NOT NULL"
    sql["diff_cells"] = _end(CELLS, f"SELECT {cell}, source_raw FROM cells WHERE {no_nulls}")
    sql["diff_exclude_nulls"] = _end(CELLS, f"SELECT {cell} FROM cells WHERE {no_nulls}")
    sql["diff_only_columns"] = _end(
        CELLS, f"SELECT {cell} FROM cells WHERE \"column\" IN ('status', 'priority')"
    )
    sql["diff_strict"] = _end(STRICT_CELLS, f"SELECT {cell} FROM cells WHERE {no_nulls}")
    sql["diff_hash_then_cells"] = _end(
        CELLS, f"SELECT {cell}, s_h AS source_hash, d_h AS dest_hash FROM cells"
    )
    sql["mismatch_nested"] = _end(
        CELLS,
        "SELECT id, year, month, week, count(*) AS cells, string_agg(\"column\", ',' ORDER BY"
        " CASE \"column\" WHEN 'amount' THEN 1 WHEN 'status' THEN 2 WHEN 'priority' THEN 3 ELSE 4 END)"
        " AS columns FROM cells GROUP BY id, year, month, week",
    )

    report = _end(REPORT, f"SELECT {_REPORT_COLUMNS}, source_hash, dest_hash FROM report")
    sql["discrepancy_report"] = report
    sql["discrepancy_report_hash_first"] = report
    sql["discrepancy_report_unique_key"] = report
    sql["discrepancy_report_lines"] = _lines_report()
    sql["discrepancy_report_lines_hash_first"] = _lines_report()
    sql["discrepancy_report_split_keys"] = _lines_report(
        "line", "line, year, month", ("quantity", "price")
    ).replace("ORDER BY line, quantity", "ORDER BY quantity")
    sql["align_split_keys"] = sql["align_split_keys"].replace(
        "ORDER BY line, quantity", "ORDER BY quantity"
    )
    sql["discrepancy_summary"] = _end(
        REPORT, 'SELECT year, month, week, type, "column", count(*) AS records FROM report GROUP BY ALL'
    )
    sql["mismatch_sample"] = _end(
        REPORT,
        'SELECT primary_key, "column", source_value, dest_value FROM (SELECT *, row_number() OVER'
        " (PARTITION BY primary_key ORDER BY \"column\") AS rn FROM report WHERE type = 'mismatch')"
        " WHERE rn = 1 ORDER BY primary_key LIMIT 2",
    )
    sql["reconcile_scope"] = (
        _SCOPED
        + f"""SELECT cast(id AS varchar) AS primary_key, 'mismatch' AS type, 'amount' AS "column",
 {_decimal_text("s_n")} AS source_value, {_decimal_text("d_n")} AS dest_value, year, month, week
 FROM joined WHERE abs(s_n - d_n) >= 0.00001"""
        + "".join(
            f" UNION ALL SELECT cast(id AS varchar), 'mismatch', '{c}', s_{c}, d_{c}, year, month, week"
            f" FROM joined WHERE s_id IS NOT NULL AND d_id IS NOT NULL AND s_{c} IS DISTINCT FROM d_{c}"
            for c in ("status", "priority", "order_date")
        )
        + " UNION ALL SELECT cast(id AS varchar), 'missing_in_dest', NULL, NULL, NULL, year, month, week"
        " FROM joined WHERE d_id IS NULL UNION ALL SELECT cast(id AS varchar), 'extra_in_dest', NULL, NULL,"
        " NULL, year, month, week FROM joined WHERE s_id IS NULL"
    )

    record = 'primary_key, "column", source_value, dest_value, year, month, week'
    sql["upsert_discrepancies"] = _end(
        REPORT + _SECOND_RUN,
        f"SELECT {record} FROM later UNION ALL SELECT {record} FROM first_run f WHERE NOT EXISTS"
        ' (SELECT 1 FROM later l WHERE l.primary_key = f.primary_key AND l."column" = f."column"'
        " AND l.year = f.year AND l.month = f.month AND l.week = f.week)",
    )
    runs = " UNION ALL ".join(
        (
            f"SELECT {record}, 1 AS n FROM first_run",
            f"SELECT {record}, 2 FROM later",
            "SELECT primary_key, \"column\", source_value, 'third', year, month, week, 3 FROM first_run"
            " WHERE month = '05'",
        )
    )
    sql["report_log"] = _end(
        REPORT + _SECOND_RUN,
        f"SELECT {record} FROM (SELECT *, row_number() OVER (PARTITION BY primary_key, \"column\", year,"
        f" month, week ORDER BY n DESC) AS rn FROM ({runs})) WHERE rn = 1 AND year <> '1997'",
    )
    # Off by one in big and wide; off by 1e-7, within the tolerance, in fine.
    far = " UNION ALL ".join(
        f"SELECT cast(o_orderkey AS varchar) AS primary_key, 'mismatch' AS type, '{name}' AS \"column\","
        f" cast({base} + o_orderkey AS varchar) AS source_raw, cast({base} + o_orderkey + 1 AS varchar)"
        " AS dest_raw FROM orders WHERE o_orderkey % 7 = 0"
        for name, base in (
            ("big", "9007199254740992::bigint"),
            ("wide", "1000000000000000000000000000000::hugeint"),
        )
    )
    sql["exact_numbers"] = far
    sql["append_records"] = _end(
        REPORT + _SECOND_RUN, f"SELECT {record} FROM first_run UNION ALL SELECT {record} FROM later"
    )

    sql["repair_candidates"] = _end(
        REPORT,
        'SELECT primary_key, "column", source_value, dest_value, year, month, week FROM report'
        " WHERE type = 'mismatch' AND ((year = '1998' AND month = '05' AND week IN ('1', '3'))"
        " OR (year = '1997' AND month = '11'))",
    )
    sql["repair_skip_nulls"] = _end(
        REPORT,
        'SELECT primary_key, "column", source_value, dest_value, year, month, week FROM report'
        " WHERE type = 'mismatch' AND source_value IS NOT NULL AND source_value <> ''",
    )
    sql["repair_skip_nulls_swapped"] = _end(
        REPORT,
        'SELECT primary_key, "column", dest_value AS source_value, source_value AS dest_value, year,'
        " month, week FROM report WHERE type = 'mismatch' AND dest_value IS NOT NULL AND dest_value <> ''",
    )
    sql["repair_columns"] = _end(
        REPORT, "SELECT DISTINCT year, month, week, \"column\" FROM report WHERE type = 'mismatch'"
    )
    sql["repair_plan"] = _end(REPORT + _PLAN, "SELECT * FROM plan")
    sql["repair_apply"] = _end(REPORT + _REPAIRED, f"SELECT {orders_columns} FROM repaired")
    sql["repair_copy_on_write"] = sql["repair_apply"]
    sql["purge_repaired"] = _end(
        REPORT + _PLAN,
        f"SELECT {_REPORT_COLUMNS} FROM report WHERE type <> 'mismatch' OR source_value IS NULL"
        " OR source_value = ''",
    )
    sql["repair_summary"] = _end(
        REPORT + _PLAN,
        f'SELECT {_UPDATE_LABEL} AS "partition", "column", count(*) AS rows_updated FROM plan'
        f' GROUP BY ROLLUP ({_UPDATE_LABEL}, "column")',
    )
    sql["reconcile_then_repair"] = _end(
        REPORT,
        "SELECT primary_key, type, \"column\", year, month, week FROM report WHERE type <> 'mismatch'",
    )
    lines = _lines_report()
    sql["reconcile_then_repair_lines"] = (
        f'SELECT primary_key, type, "column", year, month FROM ({lines}) WHERE type <> \'mismatch\''
    )
    sql["align_stored"] = sql["align_duplicate_keys"]
    sql["align_stored_null_keys"] = sql["align_null_keys"]
    sql["discrepancy_report_stored"] = sql["discrepancy_report"]
    sql["discrepancy_report_by_ranges"] = sql["discrepancy_report"]
    sql["discrepancy_report_lines_by_ranges"] = lines
    sql["reconcile_changed_files"] = sql["reconcile_then_repair"]
    sql["partition_digests"] = _end(
        ORDERS,
        "SELECT year, month, week, sum(s)::bigint AS src_rows, sum(d)::bigint AS dest_rows,"
        " sum(s * h)::hugeint = sum(d * h)::hugeint AS agrees FROM (SELECT year, month, week, 1 AS s, 0 AS d,"
        " hash(id, h)::hugeint AS h FROM src UNION ALL SELECT year, month, week, 0, 1, hash(id, h)::hugeint"
        " FROM dst) GROUP BY ALL",
    )
    sql["key_range_counts"] = _end(
        ORDERS,
        "SELECT side, range, count(*) AS n FROM (SELECT side, CASE WHEN id < 1000 THEN 0 WHEN id < 5000 THEN 1"
        " WHEN id < 12000 THEN 2 WHEN id < 1000000000 THEN 3 ELSE 4 END::int AS range FROM"
        " (SELECT 'source' AS side, id FROM src UNION ALL SELECT 'destination', id FROM dst)) GROUP BY ALL",
    )

    sampled = (
        "hashes AS (SELECT DISTINCT id, md5(concat('7:', id)) AS hash FROM (SELECT id FROM src UNION ALL"
        " SELECT id FROM dst)), bound AS (SELECT hash FROM hashes ORDER BY hash LIMIT 1 OFFSET 500),"
        " drawn AS (SELECT r.* FROM report r JOIN hashes h ON r.primary_key = cast(h.id AS varchar)"
        " WHERE h.hash < coalesce((SELECT hash FROM bound), 'g')),"
        " chance AS (SELECT coalesce((SELECT cast('0x' || substr(hash, 1, 13) AS bigint) FROM bound)"
        " / pow(2::double, 52), 1) AS p),"
    )
    sql["key_sample_report"] = _end(
        REPORT + sampled,
        'SELECT primary_key, type, "column", source_value, dest_value, year, month, week FROM drawn',
    )
    sql["key_sample_estimates"] = _end(
        REPORT + sampled,
        'SELECT type, "column", count(*) AS sampled, cast(round(count(*) / any_value(p)) AS bigint) AS records'
        ' FROM drawn, chance GROUP BY type, "column"',
    )

    def balance(prelude: str, place: str, lost: str = "false") -> str:
        """Rows and kept records per partition, which balances where none was lost."""
        return _end(
            prelude,
            f"SELECT {place}, sum(s)::bigint AS src_rows, sum(d)::bigint AS dest_rows,"
            " sum(m)::bigint AS missing_rows, sum(e)::bigint AS extra_rows, sum(c)::bigint AS cells,"
            " sum(l) = 0 AS balanced FROM ("
            f"SELECT {place}, 1 AS s, 0 AS d, 0 AS m, 0 AS e, 0 AS c, 0 AS l FROM src"
            f" UNION ALL SELECT {place}, 0, 1, 0, 0, 0, 0 FROM dst UNION ALL SELECT {place}, 0, 0,"
            f" (type = 'missing_in_dest' AND NOT {lost})::int, (type = 'extra_in_dest' AND NOT {lost})::int,"
            f" (type = 'mismatch' AND NOT {lost})::int, ({lost})::int FROM report) GROUP BY ALL",
        )

    sql["report_balance"] = balance(REPORT, "year, month, week")
    sql["report_balance_damaged"] = balance(
        REPORT,
        "year, month, week",
        "(coalesce(\"column\", '') IN ('', 'status') AND cast(primary_key AS bigint) % 5 = 0)",
    )
    sql["report_balance_lines"] = balance(_lines() + f"report AS ({_lines_report()}),", "year, month")
    # A finer tolerance than the digest: also the amounts that differ by a millionth.
    sql["discrepancy_report_fine_tolerance"] = _end(
        REPORT.replace("0.00001", "0.0000001"), f"SELECT {_REPORT_COLUMNS} FROM report"
    )
    return sql
