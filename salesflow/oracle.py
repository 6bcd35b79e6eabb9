"""DuckDB SQL equal to each registered query, over the raw test tables.

Spark semantics that DuckDB spells differently:

* ``round(x, 2)`` in Spark is HALF_UP on the decimal text of the double
  (1.005 -> 1.01); DuckDB rounds the binary value (1.005 -> 1.0). ``_r2`` rounds the
  decimal text instead.
* DuckDB has no ``initcap``; ``_initcap`` lower-cases, splits on spaces and upper-cases
  each word's first letter, as Spark does.
* DuckDB's ``year``/``month`` are BIGINT; Spark's are INT.

Of queries about the physical layout (files, splits), what the data decide is compared: rows, partitions, names,
types, and statements that hold for any layout.
"""

from __future__ import annotations

from salesflow.queries import REWRITE_FROM_YEAR, TEST_MID_FROM, TEST_PREMIUM_FROM


def _r2(x: str) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


def _initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: concat(upper(w[1]), w[2:])), ' ')"


def _band(x: str) -> str:
    return (
        f"CASE WHEN {x} >= {TEST_PREMIUM_FROM} THEN 'premium' "
        f"WHEN {x} >= {TEST_MID_FROM} THEN 'mid' ELSE 'budget' END"
    )


_DATE = "CAST(sale_date AS DATE)"
_YEAR_TEXT = f"CAST(year({_DATE}) AS VARCHAR)"
_MONTH_TEXT = f"lpad(CAST(month({_DATE}) AS VARCHAR), 2, '0')"
_YEAR_INT = f"CAST(year({_DATE}) AS INTEGER)"
_MONTH_INT = f"CAST(month({_DATE}) AS INTEGER)"

_SALES = """sales AS (
  SELECT l.l_orderkey AS id,
         strftime(l.l_shipdate, '%Y-%m-%d') AS sale_date,
         p.p_name AS product,
         l.l_extendedprice AS amount,
         p.p_type AS category
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

_PARTS = f"""parts AS (
  SELECT id, sale_date, product, amount, category,
         {_YEAR_TEXT} AS year, {_MONTH_TEXT} AS month
  FROM sales
)"""

_TRANSFORMED = f"""transformed AS (
  SELECT id, {_DATE} AS sale_date, {_initcap('product')} AS product, {_r2('amount')} AS amount,
         {_YEAR_INT} AS year, {_MONTH_INT} AS month, category, {_band('amount')} AS price_category
  FROM sales
)"""


#: The exact sum of amounts, rounded once: whole numbers of 2**-50, added up and read back as text.
_EXACT = "CAST(CAST(sum(CAST(amount * 1125899906842624 AS HUGEINT)) AS VARCHAR) AS DOUBLE) / 1125899906842624"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_REWRITTEN_PRODUCT = f"CASE WHEN year >= '{REWRITE_FROM_YEAR}' THEN {_initcap('product')} ELSE product END"

ORACLE_SQL: dict[str, str] = {
    "sales_scan": _with(_SALES) + "SELECT * FROM sales",
    "sales_external_table": _with(_SALES) + "SELECT * FROM sales",
    "sales_partition_scan": _with(_SALES)
    + f"SELECT id, sale_date, product, amount, category, {_YEAR_INT} AS year, {_MONTH_INT} AS month FROM sales",
    "sales_partition_scan_text": _with(_SALES, _PARTS) + "SELECT * FROM parts",
    "sales_partition_discovery": _with(_SALES)
    + f"SELECT id, sale_date, product, amount, category, {_YEAR_INT} AS year, {_MONTH_INT} AS month FROM sales",
    "sales_table_count": _with(_SALES) + "SELECT count(*) AS row_count FROM sales",
    "sales_date_parts": _with(_SALES)
    + f"SELECT id, {_DATE} AS sale_date, product, amount, category, {_YEAR_TEXT} AS year, {_MONTH_TEXT} AS month "
    "FROM sales",
    "sales_clean": _with(_SALES)
    + f"SELECT id, {_DATE} AS sale_date, {_initcap('product')} AS product, {_r2('amount')} AS amount, category, "
    f"{_band('amount')} AS price_category FROM sales",
    "sales_count": _with(_SALES) + "SELECT count(*) AS row_count FROM sales",
    "sales_sample": _with(_SALES) + "SELECT * FROM sales ORDER BY id, sale_date, product, amount, category LIMIT 3",
    "sales_aggregated": _with(_SALES, _PARTS)
    + f"SELECT {_r2('sum(amount)')} AS total_amount, count(id) AS total_sales, {_r2('avg(amount)')} AS avg_amount, "
    "category, year, month FROM parts GROUP BY category, year, month",
    "sales_aggregated_rerun": _with(_SALES, _PARTS)
    + f"SELECT {_r2('sum(amount)')} AS total_amount, count(id) AS total_sales, {_r2('avg(amount)')} AS avg_amount, "
    "category, year, month FROM parts GROUP BY category, year, month",
    "sales_partitioned_load": _with(_SALES, _PARTS) + "SELECT * FROM parts",
    "sales_stream_load": _with(_SALES, _PARTS) + "SELECT * FROM parts",
    "sales_load_two_batches": _with(_SALES, _PARTS) + "SELECT * FROM parts",
    "sales_restage_load": _with(_SALES, _PARTS) + "SELECT * FROM parts",
    "sales_partition_files": _with(_SALES, _PARTS)
    + "SELECT category, year, month, count(*) AS rows, true AS has_files, true AS has_bytes FROM parts "
    "GROUP BY category, year, month",
    "sales_file_listing": _with(_SALES, _PARTS)
    + "SELECT count(*) AS rows, count(DISTINCT (category, year, month)) AS partitions, true AS described, "
    "true AS paths_differ FROM parts",
    "sales_schema": "SELECT column_name AS col_name, CASE column_type WHEN 'VARCHAR' THEN 'string' "
    "ELSE lower(column_type) END AS data_type FROM (DESCRIBE " + _with(_SALES, _PARTS) + "SELECT * FROM parts)",
    "sales_partition_balance": _with(_SALES) + "SELECT count(*) AS total_rows, true AS ids_differ FROM sales",
    "sales_inspection": _with(_SALES, _PARTS)
    + """SELECT 'row_count' AS part, CAST(count(*) AS VARCHAR) AS value FROM parts
UNION ALL SELECT 'column', unnest(['id', 'sale_date', 'product', 'amount', 'category', 'year', 'month'])
UNION ALL SELECT 'partitions', CAST(count(DISTINCT (category, year, month)) AS VARCHAR) FROM parts
UNION ALL SELECT 'balance', CAST(count(*) AS VARCHAR) FROM parts
UNION ALL SELECT 'sample', concat_ws('|', id, sale_date, product, category, year, month) FROM (
  SELECT * FROM parts ORDER BY id, sale_date, product, amount, category, year, month LIMIT 3)""",
    "sales_load_rerun": _with(_SALES, _PARTS) + "SELECT * FROM parts",
    "sales_partition_revenue": _with(_SALES, _PARTS)
    + f"SELECT category, year, month, count(*) AS cnt, {_r2('sum(amount)')} AS revenue FROM parts "
    "GROUP BY category, year, month ORDER BY year, month, category",
    "sales_append_twice": _with(_SALES, _PARTS) + "SELECT * FROM parts UNION ALL SELECT * FROM parts",
    "sales_partitions": _with(_SALES, _PARTS)
    + "SELECT DISTINCT 'category=' || category || '/year=' || year || '/month=' || month AS \"partition\" FROM parts",
    "sales_full_overwrite": _with(_SALES, _PARTS)
    + f"SELECT id, sale_date, {_initcap('product')} AS product, amount, category, year FROM parts "
    f"WHERE year >= '{REWRITE_FROM_YEAR}'",
    "sales_dynamic_overwrite": _with(_SALES, _PARTS)
    + f"SELECT id, sale_date, {_REWRITTEN_PRODUCT} AS product, amount, category, year FROM parts",
    "sales_path_overwrite": _with(_SALES, _PARTS)
    + f"SELECT id, sale_date, {_REWRITTEN_PRODUCT} AS product, amount, category, CAST(year AS INTEGER) AS year "
    "FROM parts",
    "sales_transformed": _with(_SALES, _TRANSFORMED) + "SELECT * FROM transformed",
    "sales_by_category": _with(_SALES, _TRANSFORMED)
    + f"SELECT category, count(*) AS total_sales, {_r2('sum(amount)')} AS total_revenue, "
    f"{_r2('avg(amount)')} AS avg_amount, min(amount) AS min_amount, max(amount) AS max_amount "
    "FROM transformed GROUP BY category ORDER BY category",
    "sales_by_month": _with(_SALES, _TRANSFORMED)
    + f"SELECT category, count(*) AS total_sales, {_r2('sum(amount)')} AS total_revenue, "
    f"{_r2('avg(amount)')} AS avg_amount, year, month "
    "FROM transformed GROUP BY year, month, category ORDER BY year, month, category",
    "sales_load_once": _with(_SALES, _PARTS) + "SELECT * FROM parts",
    "sales_folder_listing": _with(_SALES, _PARTS)
    + """SELECT 1::INTEGER AS level, count(DISTINCT category) AS folders, true AS empty_files_listed FROM parts
UNION ALL SELECT 2, count(DISTINCT (category, year)), true FROM parts
UNION ALL SELECT 3, count(DISTINCT (category, year, month)), true FROM parts""",
    "sales_partition_count": _with(_SALES) + "SELECT 8::BIGINT AS partitions, 1::BIGINT AS filled, count(*) AS total_rows FROM sales",
    "sales_aggregated_exact": _with(_SALES, _PARTS)
    + f"SELECT category, year, month, {_EXACT} AS total_amount, count(id) AS total_sales, {_EXACT} / count(amount) AS avg_amount "
    "FROM parts GROUP BY category, year, month",
    "sales_category_exact": _with(_SALES)
    + f"SELECT category, count(*) AS total_sales, {_EXACT} AS total_revenue, {_EXACT} / count(amount) AS avg_amount, "
    "min(amount) AS min_amount, max(amount) AS max_amount FROM sales GROUP BY category",
    "sales_etl_counts": _with(_SALES, _TRANSFORMED)
    + """SELECT 'extract' AS step, count(*) AS rows FROM sales UNION ALL SELECT 'transform', count(*) FROM transformed
UNION ALL SELECT 'by_category', count(DISTINCT category) FROM transformed
UNION ALL SELECT 'by_month', count(*) FROM (SELECT DISTINCT year, month, category FROM transformed)""",
    "sales_checked_load": _with(_SALES, _PARTS)
    + """SELECT id, product, amount, category,
  CASE WHEN id % 5 = 0 THEN replace(sale_date, '-', '/') WHEN id % 7 <> 0 THEN sale_date END AS sale_date,
  CASE WHEN id % 5 <> 0 AND id % 7 <> 0 THEN year END AS year, CASE WHEN id % 5 <> 0 AND id % 7 <> 0 THEN month END AS month,
  CASE WHEN id % 5 = 0 THEN 'not a date' WHEN id % 7 = 0 THEN 'no date' END AS reason FROM parts""",
    "sales_sorted_table": _with(_SALES) + "SELECT count(*) AS rows, true AS several_files, false AS overlap FROM sales",
    "sales_compacted": _with(_SALES, _PARTS)
    + "SELECT category, year, count(*) AS rows, 1::BIGINT AS files FROM parts GROUP BY category, year",
    "sales_tables": _with(_SALES, _TRANSFORMED)
    + """SELECT 'sales_by_category' AS table_name, count(DISTINCT category) AS row_count FROM transformed
UNION ALL SELECT 'sales_by_month', count(*) FROM (SELECT DISTINCT year, month, category FROM transformed)
UNION ALL SELECT 'sales_partitioned', count(*) FROM sales
UNION ALL SELECT 'sales_staging', count(*) FROM sales
UNION ALL SELECT 'sales_transformed', count(*) FROM transformed""",
}
_EXACT_SUMMARY = f"count(*) AS total_sales, {_r2(_EXACT)} AS total_revenue, {_r2(f'({_EXACT} / count(amount))')} AS avg_amount"
ORACLE_SQL |= {
    "sales_etl_incremental": ORACLE_SQL["sales_transformed"],
    "sales_etl_incremental_by_category": _with(_SALES, _TRANSFORMED)
    + f"SELECT category, {_EXACT_SUMMARY}, min(amount) AS min_amount, max(amount) AS max_amount FROM transformed GROUP BY category",
    "sales_etl_incremental_by_month": _with(_SALES, _TRANSFORMED)
    + f"SELECT category, {_EXACT_SUMMARY}, year, month FROM transformed GROUP BY year, month, category",
    "sales_etl_published": ORACLE_SQL["sales_by_month"],
}
