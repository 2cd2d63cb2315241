"""SQL (DuckDB) that states, independently, what each registered query must return."""

from __future__ import annotations

from salesloom.checks.queries import CONFIG, NOW, SESSION
from salesloom.samples import HEADER_ROW, LEADS, NAMES

ORACLES: dict[str, str] = {}


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return "([" + ", ".join(text(v) for v in values) + "]::VARCHAR[])"


# Accented letters that occur in the tables and the export headers.
ACCENTED = "áàâäãéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ"
PLAIN = "aaaaaeeeeiiiiooooouuuuncAAAAAEEEEIIIIOOOOOUUUUNC"


def fold(x: str) -> str:
    return f"translate({x}, '{ACCENTED}', '{PLAIN}')"


def normal(x: str) -> str:
    return f"trim(regexp_replace({fold(f'lower({x})')}, '[^a-z0-9#()/%]+', ' ', 'g'))"


def trimmed(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


MONTHS = texts(NAMES)
SOLD = "(o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60))"
MONEY = "('$ ' || translate(format('{{:,.2f}}', {0}), ',.', '.,'))"
ALIASES = texts(CONFIG.alias_targets)
SCHEMA = texts(CONFIG.schema)
REQUIRED = texts(CONFIG.required)
ALIAS_ROWS = ", ".join(f"({text(a)}, {text(t)})" for a, t in CONFIG.alias_targets.items())
FILE = """CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgente.xlsx'
          ELSE 'ventas_' || (o_orderkey // 256) || '.xlsx' END"""
LAYOUT = "CASE WHEN o_orderpriority = '1-URGENT' THEN 8 ELSE (o_orderkey // 256) % 8 END"
LEAD_ROWS = ", ".join(
    f"({layout}, {index}, {texts(labels)})"
    for layout, rows in LEADS.items()
    for index, labels in rows
)
HEADER_ROWS = ", ".join(f"({layout}, {row})" for layout, row in HEADER_ROW.items())

EXPORTS = f"""
exports AS (
  SELECT {FILE} AS file_path, {LAYOUT} AS layout,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey ELSE o_orderkey % 256 END AS position,
         o_orderkey AS id, {SOLD} AS sold, {SOLD} + to_days((o_custkey % 20)::INT) AS shipped_at,
         o_custkey % 9 + 1 AS quantity, o_orderstatus AS status, o_totalprice AS total,
         'SKU-' || o_custkey AS sku
  FROM orders),
header_rows AS (SELECT * FROM (VALUES {HEADER_ROWS}) h(layout, header_row)),
lead_rows AS (SELECT * FROM (VALUES {LEAD_ROWS}) l(layout, row_idx, vals)),
files AS (SELECT DISTINCT file_path, layout, header_row FROM exports JOIN header_rows USING (layout))
"""

GRID = f"""{EXPORTS},
shown AS (
  SELECT file_path, layout, position + 1 + header_row AS row_idx,
         [id::VARCHAR,
          day(sold) || ' de ' || {MONTHS}[month(sold)] || ' de ' || year(sold) || ' '
            || strftime(sold, '%H:%M') || ' hs.',
          '  ' || status || ' ', quantity::VARCHAR, {MONEY.format('total')}, sku,
          day(shipped_at) || ' de ' || {MONTHS}[month(shipped_at)] || ' | '
            || strftime(shipped_at, '%H:%M')] AS v, id
  FROM exports JOIN header_rows USING (layout)),
grid AS (
  SELECT file_path, row_idx,
         CASE layout WHEN 2 THEN list_reverse(v)
                     WHEN 3 THEN list_append(v, 'n' || id)
                     WHEN 4 THEN v[1:4] || v[6:7]
                     WHEN 5 THEN v[1:3] || [NULL::VARCHAR] || v[5:7]
                     WHEN 6 THEN list_append(v, v[4])
                     ELSE v END AS vals
  FROM shown
  UNION ALL
  SELECT file_path, row_idx, vals FROM files JOIN lead_rows USING (layout))
"""

SCORES = f"""{GRID},
top AS (
  SELECT file_path, row_idx, vals,
         list_filter(list_transform(vals, lambda x: {normal("coalesce(x, '')")}),
                     lambda x: x <> '') AS n
  FROM grid WHERE row_idx <= 15),
nexts AS (
  SELECT *, lead(row_idx) OVER w AS next_idx, lead(n) OVER w AS next_n
  FROM top WINDOW w AS (PARTITION BY file_path ORDER BY row_idx)),
scores AS (
  SELECT file_path, row_idx, n, vals,
         list_filter(n, lambda x: list_contains({ALIASES}, x)) AS hits,
         CASE WHEN len(n) = 0 THEN 0.0 ELSE
           3.0 * len(list_filter(n, lambda x: list_contains({ALIASES}, x)))
           + (CASE WHEN len(n) >= 3 THEN 1 ELSE 0 END) + (CASE WHEN len(n) >= 5 THEN 1 ELSE 0 END)
           - 1.5 * len(list_filter(n, lambda x: regexp_full_match(x, '[0-9.,/-]+')))
           + (CASE WHEN next_idx = row_idx + 1
                    AND len(list_filter(next_n, lambda x: regexp_full_match(x, '[0-9.,/-]+'))) > 0
                   THEN 0.5 ELSE 0 END)
         END::DOUBLE AS score
  FROM nexts WHERE row_idx < 15)
"""

# Header cells of accepted-as-header layouts, with the category spread to the right.
LABELS = f"""{GRID},
cells AS (
  SELECT f.file_path, f.layout, f.header_row, unnest(generate_series(1, len(g.vals))) AS place,
         g.vals, coalesce(c.vals, []::VARCHAR[]) AS cats
  FROM files f
  JOIN grid g ON g.file_path = f.file_path AND g.row_idx = f.header_row
  LEFT JOIN grid c ON c.file_path = f.file_path AND c.row_idx = f.header_row - 1
  WHERE f.layout <> 7),
labels AS (
  SELECT file_path, layout, header_row, (place - 1)::INT AS pos,
         coalesce(vals[place], '') AS raw_label,
         coalesce(last_value(cats[place] IGNORE NULLS) OVER (
           PARTITION BY file_path ORDER BY place
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS category_label
  FROM cells),
combined AS (
  SELECT *, concat_ws(' ', nullif(category_label, ''), nullif(raw_label, '')) AS combined_label
  FROM labels),
used AS (SELECT * FROM combined WHERE NOT (layout = 5 AND pos = 3)),
mapped AS (
  SELECT u.*, coalesce(a.alias_target, combined_label) AS target,
         a.alias_target IS NOT NULL AS mapped
  FROM used u LEFT JOIN (VALUES {ALIAS_ROWS}) a(alias_norm, alias_target)
    ON a.alias_norm = {normal('combined_label')}),
sheets AS (
  SELECT file_path, layout, header_row,
         list_distinct(list(target)) || ['source_row_number'] AS present,
         list(target) AS targets, sum(mapped::INT) AS mapped_count
  FROM mapped GROUP BY ALL)
"""

# --- text

ORACLES["normalize_text"] = f"SELECT doc_id, {normal('text')} AS normalized FROM documents"
ORACLES["strip_accents"] = f"SELECT doc_id, {fold('text')} AS plain FROM documents"
ORACLES["normalize_scalar_text"] = f"""
SELECT conv_id, turn, regexp_replace({fold(f"lower({trimmed('text')})")}, '\\s+', ' ', 'g')
  AS normalized FROM conversations"""
ORACLES["standardize_string"] = f"""
SELECT doc_id, {trimmed('text')} AS standardized FROM documents"""
ORACLES["effectively_empty"] = f"""
SELECT event_id, CASE WHEN event_type IN ('click', 'error') THEN true
  ELSE {normal('props')} = '' END AS is_empty FROM events"""
ORACLES["row_values"] = f"""
SELECT c_custkey, {normal('c_name')} || '|' || lower(c_mktsegment) || 'on (ars)|' || c_nationkey
  AS row_values FROM customer"""
ORACLES["numeric_like"] = """
SELECT l_returnflag, l_linenumber,
       sum(2 + (CASE WHEN regexp_full_match(
         trim(regexp_replace(format('{:,.2f}', l_extendedprice), '[^0-9]+', ' ', 'g')),
         '[0-9.,/-]+') THEN 1 ELSE 0 END))::BIGINT AS numeric_cells
FROM lineitem GROUP BY ALL"""

# --- numbers and dates

ORACLES["parse_number_latam"] = """
SELECT l_orderkey, l_partkey, l_suppkey, round(l_extendedprice, 2) AS price FROM lineitem"""
ORACLES["parse_number_forms"] = """
SELECT l_orderkey, l_partkey, l_suppkey,
       CASE l_linenumber WHEN 1 THEN l_quantity WHEN 2 THEN l_quantity + 0.5 WHEN 3 THEN NULL
         WHEN 4 THEN l_quantity * 10 WHEN 5 THEN NULL WHEN 6 THEN -100 * l_quantity
         ELSE NULL END::DOUBLE AS number FROM lineitem"""
ORACLES["parse_int"] = """
SELECT l_orderkey, l_partkey, l_suppkey,
       CASE WHEN l_linenumber IN (3, 4) THEN NULL ELSE l_quantity::BIGINT END AS units,
       l_linenumber = 3 AS is_error FROM lineitem"""
ORACLES["parse_date_es_long"] = f"SELECT o_orderkey, {SOLD} AS sold_at FROM orders"
ORACLES["parse_date_es_short"] = f"SELECT o_orderkey, {SOLD} AS sold_at FROM orders"
ORACLES["parse_date_only"] = "SELECT o_orderkey, o_orderdate::DATE AS sold_on FROM orders"
ORACLES["parse_date_fallback"] = f"""
SELECT o_orderkey,
       CASE o_custkey % 6 WHEN 0 THEN {SOLD}
         WHEN 1 THEN date_trunc('day', o_orderdate)::TIMESTAMP
         WHEN 2 THEN (CASE WHEN day(o_orderdate) <= 12
           THEN make_timestamp(year(o_orderdate), day(o_orderdate), month(o_orderdate), 0, 0, 0.0)
           ELSE date_trunc('day', o_orderdate)::TIMESTAMP END)
         WHEN 3 THEN date_trunc('day', o_orderdate)::TIMESTAMP
         WHEN 4 THEN date_trunc('day', o_orderdate)::TIMESTAMP
         ELSE NULL END AS sold_at FROM orders"""
ORACLES["date_errors"] = """
SELECT o_orderkey, try_cast(t AS DATE) IS NULL AS is_error, try_cast(t AS DATE) AS day
FROM (SELECT o_orderkey,
             year(o_orderdate) || '-02-' || lpad((o_custkey % 31 + 1)::VARCHAR, 2, '0') AS t
      FROM orders)"""
ORACLES["month_lookup"] = """
SELECT month(o_orderdate)::INT AS month, count(*) AS order_count FROM orders GROUP BY ALL"""

# --- headers

ORACLES["header_score"] = f"""WITH {SCORES}
SELECT file_path, row_idx, score, array_to_string(n, '|') AS row_values,
       len(hits)::INT AS alias_matches FROM scores"""
ORACLES["alias_set"] = f"""WITH {SCORES}
SELECT alias_norm, count(*) AS cell_count FROM (SELECT unnest(hits) AS alias_norm FROM scores)
GROUP BY ALL"""
ORACLES["detect_header"] = f"""WITH {SCORES}
SELECT file_path, row_idx AS header_row, score, score >= 3.0 AS header_found
FROM scores QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY score DESC, row_idx) = 1"""
ORACLES["category_ffill"] = f"""WITH {LABELS}
SELECT file_path, pos, raw_label, category_label, combined_label FROM combined"""
ORACLES["unique_headers"] = """
WITH named AS (
  SELECT 'talle_' || p_size || '_' || (p_partkey // 100) AS file_path, p_partkey AS pos,
         CASE WHEN p_type = 'PROMO' THEN 'unnamed_column' ELSE p_type END AS base FROM part)
SELECT file_path, pos, CASE WHEN nth = 1 THEN base ELSE base || '__' || nth END AS source_label
FROM (SELECT *, row_number() OVER (PARTITION BY file_path, base ORDER BY pos) AS nth FROM named)"""
ORACLES["drop_empty_rows"] = f"""
SELECT {FILE} AS file_path, o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P'"""
ORACLES["drop_empty_columns"] = f"""WITH {LABELS}
SELECT file_path, pos, combined_label AS source_label FROM used"""
ORACLES["source_row_number"] = f"""WITH {EXPORTS}
SELECT file_path, position + 1 + header_row AS row_idx,
       row_number() OVER (PARTITION BY file_path ORDER BY position) + header_row + 1
         AS source_row_number,
       position + 2 + header_row AS physical_row_number
FROM exports JOIN header_rows USING (layout) WHERE layout <> 7"""

# --- mapping and validation

ORACLES["map_columns"] = f"""WITH {LABELS}
SELECT file_path, pos, combined_label AS source_label, target, mapped FROM mapped"""
ORACLES["unmapped_report"] = f"""WITH {LABELS}
SELECT file_path, pos, combined_label AS source_label FROM mapped WHERE NOT mapped"""
ORACLES["duplicate_targets"] = f"""WITH {LABELS}
SELECT file_path, target, string_agg(combined_label, '|' ORDER BY pos) AS sources
FROM mapped GROUP BY ALL HAVING count(*) > 1"""
ORACLES["alias_conflicts"] = f"""
SELECT {normal('p_name')} AS alias_norm, count(DISTINCT p_brand) AS target_count,
       min(p_brand) AS first_target, max(p_brand) AS last_target
FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1"""
ORACLES["validate_missing"] = f"""WITH {LABELS}
SELECT file_path,
       array_to_string(list_sort(list_filter({REQUIRED}, lambda c: NOT list_contains(present, c))), '|')
         AS missing_required,
       len(list_filter({SCHEMA}, lambda c: NOT list_contains(present, c)))::INT AS missing_schema,
       len(list_filter({REQUIRED}, lambda c: NOT list_contains(present, c))) = 0 AS is_valid
FROM sheets"""
ORACLES["validate_extra"] = f"""WITH {LABELS}
SELECT file_path,
       array_to_string(list_sort(list_filter(present, lambda c: NOT list_contains({SCHEMA}, c))), '|')
         AS extra_columns, mapped_count::INT AS mapped_count FROM sheets"""
ORACLES["survey_files"] = f"""WITH {SCORES}, best AS (
  SELECT file_path, row_idx AS header_row FROM scores
  QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY score DESC, row_idx) = 1)
SELECT f.file_path,
       CASE f.layout WHEN 4 THEN 'missing required columns' WHEN 5 THEN 'missing required columns'
         WHEN 6 THEN 'duplicate targets' WHEN 7 THEN 'no header' ELSE 'accepted' END AS status,
       b.header_row, f.layout = 0 AS category_row_used,
       CASE f.layout WHEN 4 THEN 6 WHEN 5 THEN 6 WHEN 6 THEN 8 WHEN 7 THEN NULL ELSE 7 END::INT
         AS mapped_count
FROM files f JOIN best b USING (file_path)"""

# --- typing

SHIPPED = """make_timestamp(year(sold), month(shipped_at), day(shipped_at), hour(shipped_at),
  minute(shipped_at), 0.0)"""
ORACLES["conform_schema"] = f"""WITH {EXPORTS}
SELECT id, id::VARCHAR AS sale_id, sold::DATE AS sale_date, quantity::BIGINT AS quantity,
       CASE WHEN quantity = 3 THEN NULL ELSE round(total, 2) END AS total,
       make_timestamp(year(sold), month(shipped_at), day(shipped_at),
                      hour(shipped_at), minute(shipped_at), 0.0) AS shipped_at,
       status = 'O' AS is_open, 0 AS error_count FROM exports"""
ORACLES["conversion_report"] = f"""WITH {EXPORTS}
SELECT id % 10 AS bucket, count(*) AS rows, unnest(['quantity', 'total', 'sale_date']) AS column_name,
       unnest([0, count(*) FILTER (quantity = 3), 0])::BIGINT AS null_count FROM exports GROUP BY 1"""
ORACLES["cast_declared"] = """
SELECT o_orderkey::VARCHAR AS sale_id, o_orderdate::DATE AS sale_date,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END::BIGINT AS quantity,
       o_totalprice AS total_amount_ars FROM orders"""

# --- metadata and hashes

ORACLES["file_hash"] = """
SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5, sha1(text) AS sha1 FROM documents"""
STAMP = NOW.strftime("%Y%m%dT%H%M%SZ")
LOAD_ID = f"'load_{STAMP}_' || substr(sha256('{SESSION}' || chr(10) || file_path), 1, 8)"
ORACLES["load_metadata"] = f"""WITH {EXPORTS}
SELECT id, {LOAD_ID} AS load_id, '{SESSION}' AS session_load_id, file_path AS file_name,
       sha256(file_path) AS file_hash, TIMESTAMP '{NOW}' AS loaded_at, '0' AS source_sheet,
       header_row::BIGINT AS header_row_detected
FROM exports JOIN header_rows USING (layout)"""

# --- dedup, merge, audit

ORDER = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_linenumber"
DESC = ", ".join(f"{c} DESC" for c in ORDER.split(", "))
ORACLES["dedup_keep_first"] = f"""
SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORDER}) = 1"""
ORACLES["dedup_keep_last"] = f"""
SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {DESC}) = 1"""
ORACLES["dedup_null_keys"] = f"""
WITH keyed AS (SELECT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS sale_key, * FROM lineitem)
SELECT sale_key, l_orderkey, {ORDER} FROM keyed
QUALIFY row_number() OVER (
  PARTITION BY sale_key, CASE WHEN sale_key IS NULL THEN l_linestatus END
  ORDER BY l_orderkey, {ORDER}) = 1"""
STAGED = f"""
arrived AS (
  SELECT l_orderkey AS sale_id, l_linestatus AS sale_status, l_extendedprice AS total,
         sha256(l_returnflag) AS file_hash, * FROM lineitem WHERE l_shipdate >= DATE '1998-01-01'),
staged AS (
  SELECT sale_id, sale_status, total, file_hash FROM arrived
  QUALIFY row_number() OVER (PARTITION BY sale_id ORDER BY {ORDER}) = 1),
target AS (
  SELECT o_orderkey AS sale_id, o_orderstatus AS sale_status, o_totalprice AS total,
         sha256(o_orderpriority) AS file_hash
  FROM orders WHERE o_orderdate < DATE '1999-01-01')"""
ORACLES["count_existing"] = f"""WITH {STAGED}
SELECT count(*) AS row_count FROM staged JOIN lineitem
  ON l_orderkey = sale_id AND l_shipdate < DATE '1999-01-01'"""
ORACLES["count_by_hash"] = f"""WITH {STAGED}
SELECT count(*) AS row_count FROM target WHERE file_hash = sha256('2-HIGH')"""
ORACLES["insert_only_merge"] = f"""WITH {STAGED}
SELECT * FROM target
UNION ALL SELECT * FROM staged s WHERE NOT EXISTS (FROM target t WHERE t.sale_id = s.sale_id)"""
ORACLES["load_counts"] = f"""WITH {STAGED},
known AS (
  SELECT s.file_hash, count(*) AS rows_after_dedup, count(t.sale_id) AS rows_already_existing,
         count(*) - count(t.sale_id) AS rows_inserted
  FROM staged s LEFT JOIN target t USING (sale_id) GROUP BY 1)
SELECT file_hash, rows_in_file, rows_after_dedup, rows_already_existing, rows_inserted,
       rows_in_file - rows_after_dedup AS duplicate_rows,
       rows_after_dedup - rows_already_existing AS rows_inserted_derived
FROM (SELECT file_hash, count(*) AS rows_in_file FROM arrived GROUP BY 1) JOIN known USING (file_hash)"""
ORACLES["load_audit"] = f"""
SELECT 'load_' || strftime(o_orderdate, '%Y%m') AS load_id, '{SESSION}' AS session_load_id,
       strftime(o_orderdate, '%Y-%m') AS file_name, sha256(strftime(o_orderdate, '%Y-%m')) AS file_hash,
       TIMESTAMP '{NOW}' AS loaded_at, '0' AS source_sheet, count(*) AS row_count, 'loaded' AS status
FROM orders GROUP BY ALL"""

# --- star schema and marts


def key(*parts: str) -> str:
    joined = " || chr(31) || ".join(f"coalesce({p}::VARCHAR, chr(0))" for p in parts)
    return f"('0x' || substr(md5({joined}), 1, 15))::BIGINT"


SALES = """
sales AS (
  SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey AS sale_id,
         o_orderdate::DATE AS sale_date, o_orderstatus AS sale_status,
         l_linestatus AS status_description, l_quantity::BIGINT AS quantity,
         'SKU-' || l_partkey AS sku, p_brand AS publication_id, p_name AS product_title,
         o_orderpriority AS variant, l_extendedprice AS total_amount_ars, l_shipdate AS shipped_at,
         c_mktsegment AS buyer_city, n_name AS buyer_state, r_name AS buyer_country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey)"""
PRODUCT_KEY = key("sku", "publication_id")
LOCATION_KEY = key("buyer_country", "buyer_state", "buyer_city")
STATUS_KEY = key("sale_status", "status_description")
PRODUCTS = f"""SELECT {PRODUCT_KEY} AS product_key, sku, publication_id, product_title, variant
  FROM sales QUALIFY row_number() OVER (
    PARTITION BY sku, publication_id ORDER BY sale_date DESC, sale_id DESC) = 1"""


def titled(c: str) -> str:
    words = f"string_split(lower({c}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


ORACLES["stg_sales"] = f"""WITH {SALES}
SELECT sale_id, sale_date, product_title,
       CASE WHEN variant <> '5-LOW' THEN variant END AS variant,
       {titled('buyer_city')} AS buyer_city, {titled('buyer_state')} AS buyer_state,
       {titled('buyer_country')} AS buyer_country, quantity, total_amount_ars FROM sales"""
ORACLES["dim_date"] = """
SELECT (year(day) * 10000 + month(day) * 100 + day(day))::INT AS date_key, day,
       year(day)::INT AS year, quarter(day)::INT AS quarter, month(day)::INT AS month,
       day(day)::INT AS day_of_month, isodow(day)::INT AS iso_weekday, week(day)::INT AS iso_week,
       isodow(day) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE,
        INTERVAL 1 DAY))::DATE AS day FROM orders)"""
ORACLES["dim_product"] = f"WITH {SALES} {PRODUCTS}"
ORACLES["dim_location"] = f"""WITH {SALES}
SELECT DISTINCT {LOCATION_KEY} AS location_key, buyer_country, buyer_state, buyer_city FROM sales"""
ORACLES["dim_status"] = f"""WITH {SALES}
SELECT DISTINCT {STATUS_KEY} AS status_key, sale_status, status_description FROM sales"""
ORACLES["fct_sales"] = f"""WITH {SALES}
SELECT sale_id, sale_date,
       (year(sale_date) * 10000 + month(sale_date) * 100 + day(sale_date))::INT AS date_key,
       {PRODUCT_KEY} AS product_key, {LOCATION_KEY} AS location_key, {STATUS_KEY} AS status_key,
       quantity, total_amount_ars FROM sales"""
ORACLES["fct_lookup"] = f"""WITH {SALES},
early AS (SELECT DISTINCT sku FROM sales WHERE sale_date < DATE '1995-02-01')
SELECT e.sku, count(*) AS fact_count, sum(quantity)::BIGINT AS units
FROM sales s LEFT JOIN early e USING (sku) GROUP BY 1"""
METRICS = """round(sum(total_amount_ars), 2) AS total_sales, count(DISTINCT sale_id) AS sale_count,
  sum(quantity)::BIGINT AS units_sold,
  round(sum(total_amount_ars), 2) / count(DISTINCT sale_id) AS average_ticket"""
for name, columns in {
    "kpi_summary": "",
    "kpi_by_product": "sku, product_title, ",
    "kpi_by_location": "buyer_country, buyer_state, buyer_city, ",
    "kpi_by_status": "sale_status, status_description, ",
    "kpi_monthly": "date_trunc('month', sale_date)::DATE AS month, ",
}.items():
    ORACLES[name] = f"WITH {SALES} SELECT {columns}{METRICS} FROM sales" + (
        " GROUP BY ALL" if columns else ""
    )
ORACLES["kpi_location_rollup"] = f"""WITH {SALES}
SELECT buyer_country, buyer_state, buyer_city, round(sum(total_amount_ars), 2) AS total_sales,
       count(*) AS row_count,
       (grouping(buyer_country) + grouping(buyer_state) + grouping(buyer_city))::INT AS level
FROM sales GROUP BY ROLLUP (buyer_country, buyer_state, buyer_city)"""
ORACLES["filter_sales"] = f"""WITH {SALES}
SELECT sale_id, sale_date, sale_status, buyer_country, total_amount_ars FROM sales
WHERE sale_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' AND sale_status IN ('F', 'O')
  AND buyer_country IN ('AMERICA', 'ASIA')"""

ORACLES["preview_rows"] = "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5"

# --- data quality

ORACLES["dq_duplicates"] = """
SELECT count(*) AS duplicated_keys, coalesce(sum(n - 1), 0)::BIGINT AS surplus_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)"""
ORACLES["dq_duplicate_keys"] = """
SELECT l_orderkey, count(*) AS occurrences FROM lineitem GROUP BY 1 HAVING count(*) > 1"""
ORACLES["dq_nulls"] = """
SELECT rule, failed, total FROM (
  SELECT unnest(['sale_id_null', 'sale_date_null', 'sale_status_null']) AS rule,
         unnest([count(*) FILTER (o_orderpriority = '5-LOW'), 0,
                 count(*) FILTER (o_orderstatus = 'P')])::BIGINT AS failed,
         count(*) AS total FROM orders)"""
ORACLES["dq_consistency"] = f"""WITH {SALES}
SELECT rule, failed, total FROM (
  SELECT unnest(['quantity_not_positive', 'total_negative', 'shipped_before_sale',
                 'delivered_before_shipped']) AS rule,
         unnest([count(*) FILTER (quantity <= 0), count(*) FILTER (total_amount_ars < 0),
                 count(*) FILTER (shipped_at::DATE < sale_date),
                 count(*) FILTER (quantity > 26)])::BIGINT AS failed,
         count(*) AS total FROM sales)"""

# --- end to end

TYPED = f"""{EXPORTS},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY position) + header_row + 1
    AS source_row_number
  FROM exports JOIN header_rows USING (layout) WHERE layout IN (0, 1, 2, 3, 8))"""
ORACLES["ingest_end_to_end"] = f"""WITH {TYPED}
SELECT file_path AS file_name, id::VARCHAR AS sale_id, sold::DATE AS sale_date,
       status AS sale_status, quantity::BIGINT AS quantity, round(total, 2) AS total_amount_ars,
       sku, {SHIPPED} AS shipped_at, {LOAD_ID} AS load_id, '{SESSION}' AS session_load_id,
       TIMESTAMP '{NOW}' AS loaded_at, header_row::BIGINT AS header_row_detected,
       source_row_number,
       CASE WHEN layout = 3 THEN '{{"Columna nueva":"n' || id || '"}}' ELSE '{{}}' END AS extras
FROM numbered"""
ORACLES["ingest_monthly_sales"] = f"""WITH {TYPED}
SELECT date_trunc('month', sold)::DATE AS month, round(sum(round(total, 2)), 2) AS total_sales,
       count(DISTINCT id) AS sale_count, sum(quantity)::BIGINT AS units_sold,
       round(sum(round(total, 2)), 2) / count(DISTINCT id) AS average_ticket
FROM numbered GROUP BY 1"""
ORACLES["delimited_scan"] = """
SELECT c_custkey, c_name || '; "' || c_mktsegment || '"' AS label, true AS third_is_empty,
       round(c_acctbal, 2) AS c_acctbal FROM customer"""
ORACLES["delimited_row_order"] = """
SELECT count(*) AS row_count, 0::BIGINT AS files_out_of_order FROM orders"""
ORACLES["line_fingerprint"] = """
SELECT copies, count(*) AS digest_count
FROM (SELECT count(*) AS copies FROM documents GROUP BY text) GROUP BY 1"""
ORACLES["workbook_scan"] = """
SELECT 'clientes_' || (c_custkey // 100) || '.xlsx' AS file_path, 'Ventas' AS sheet,
       c_custkey % 100 AS row_idx, c_name AS name, 'str' AS name_kind, c_acctbal AS balance,
       CASE WHEN c_custkey % 2 = 1 THEN 'True' ELSE 'False' END AS flag, 3::INT AS width
FROM customer"""
ORACLES["stream_ingest"] = """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1"""

ORACLES["stream_compacted"] = ORACLES["stream_ingest"]

# --- loads that die, indexes, marts kept up to date, saved output

DIED = """
loads(n, low, high) AS (VALUES (0, 1995, 1997), (1, 1996, 1999), (2, 1998, 2001)),
arrived AS (
  SELECT n, l_returnflag AS file, CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS k, l_extendedprice AS price
  FROM lineitem JOIN loads ON year(l_shipdate) BETWEEN low AND high),
firsts AS (SELECT DISTINCT n, file, k FROM arrived),
marked AS (
  SELECT *, k IS NULL OR row_number() OVER (PARTITION BY k ORDER BY n, file) = 1 AS fresh FROM firsts)"""
ORACLES["two_phase_load"] = f"""WITH {DIED},
counts AS (
  SELECT n, file, count(*) AS rows_after_dedup, count(*) FILTER (NOT fresh) AS rows_already_existing,
         count(*) FILTER (fresh) AS rows_inserted FROM marked GROUP BY n, file)
SELECT 'load_' || n || '_' || file AS load_id, rows_in_file, rows_in_file - rows_after_dedup AS duplicate_rows,
       rows_after_dedup, rows_already_existing, rows_inserted, rows_inserted AS rows_inserted_derived,
       rows_inserted AS rows_present_for_hash, 'loaded' AS status
FROM counts JOIN (SELECT n, file, count(*) AS rows_in_file FROM arrived GROUP BY n, file) USING (n, file)"""
ORACLES["indexed_load"] = ORACLES["two_phase_load"]
ORACLES["two_phase_target"] = f"""WITH {DIED}
SELECT 'load_' || n || '_' || file AS load_id, DATE '{NOW.date()}' + n AS load_date, count(*) AS row_count,
       count(k) AS key_count FROM marked WHERE fresh GROUP BY n, file"""
ORACLES["indexed_merge"] = ORACLES["insert_only_merge"]
UNIQUE = f"""{SALES}, kept AS (
  SELECT * FROM sales QUALIFY row_number() OVER (
    PARTITION BY sale_id ORDER BY sale_date, shipped_at, total_amount_ars) = 1)"""
ORACLES["mart_state_monthly"] = f"""WITH {UNIQUE}
SELECT date_trunc('month', sale_date)::DATE AS month, {METRICS} FROM kept GROUP BY ALL"""
ORACLES["mart_state_by_product"] = f"""WITH {UNIQUE}
SELECT {PRODUCT_KEY} AS product_key, {METRICS} FROM kept GROUP BY ALL"""


def versions(since: str) -> str:
    return f"""days AS (
  SELECT sku, publication_id, sale_date AS valid_from, product_title, variant FROM sales WHERE {since}
  QUALIFY row_number() OVER (PARTITION BY sku, publication_id, sale_date ORDER BY sale_id DESC) = 1),
changes AS (
  SELECT *, lag((product_title, variant)) OVER own IS DISTINCT FROM (product_title, variant) AS changed
  FROM days WINDOW own AS (PARTITION BY sku, publication_id ORDER BY valid_from)),
versions AS (
  SELECT {PRODUCT_KEY} AS product_key, sku, publication_id, product_title, variant, valid_from,
         lead(valid_from) OVER (PARTITION BY sku, publication_id ORDER BY valid_from) AS valid_to
  FROM changes WHERE changed)"""


ORACLES["dim_product_history"] = f"WITH {SALES}, {versions('true')} SELECT * FROM versions"
ORACLES["fct_history"] = f"""WITH {SALES}, {versions("sale_date >= DATE '1996-01-01'")},
facts AS (SELECT sale_id, sale_date, {PRODUCT_KEY} AS product_key, quantity FROM sales)
SELECT sale_id, sale_date, f.product_key, quantity, variant, valid_from
FROM facts f ASOF LEFT JOIN versions v ON f.product_key = v.product_key AND f.sale_date >= v.valid_from"""
ORACLES["fct_members"] = f"""WITH {SALES}
SELECT CASE WHEN status_description <> 'O' THEN sku END AS sku, count(*) AS fact_count, sum(quantity)::BIGINT AS units
FROM sales GROUP BY 1"""
ORACLES["dq_rules"] = """
WITH lines AS (SELECT *, l_orderkey || '-' || l_partkey || '-' || l_suppkey AS id, count(*) OVER () AS total FROM lineitem),
broken AS (
  SELECT 'large' AS rule, * FROM lines WHERE l_quantity > 49
  UNION ALL SELECT 'free', * FROM lines WHERE l_extendedprice <= 0
  UNION ALL SELECT 'late_return', * FROM lines WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '2000-01-01'),
chosen AS (
  SELECT rule, id FROM broken
  QUALIFY row_number() OVER (PARTITION BY rule, ('0x' || substr(md5(id), 1, 2))::INT % 4 ORDER BY md5(id)) = 1)
SELECT rule, (SELECT count(*) FROM broken b WHERE b.rule = r.rule) AS failed, (SELECT count(*) FROM lines) AS total,
       coalesce((SELECT string_agg(id, '|' ORDER BY id) FROM chosen c WHERE c.rule = r.rule), '') AS sample
FROM (SELECT unnest(['large', 'free', 'late_return']) AS rule) r"""
ORACLES["saved_sessions"] = f"""WITH {DIED}
SELECT file || '_processed' AS output, 'p' || substr(sha256('inbox' || n || '/' || n || '_' || file), 1, 8) AS input,
       count(*) AS csv_rows, count(*) AS parquet_rows, round(sum(price), 2) AS total
FROM arrived WHERE n < 2 GROUP BY n, file"""
ORACLES["not_loaded"] = f"""
SELECT DISTINCT {FILE} AS file_path FROM orders
WHERE NOT (o_orderpriority <> '1-URGENT' AND (o_orderkey // 256) % 2 = 0)"""
