"""The same results as plain SQL over the star-schema tables, for checking.

Common table expressions build the views of `views.py`; each query names the
ones it needs.
"""

from __future__ import annotations

from tillflow.schemas import ORDER_FIELDS

JOINED = """
joined AS (
  SELECT * FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
keyed AS (
  SELECT *,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_id,
    CAST(CAST(o_orderdate AS DATE) + CAST(l_suppkey % 3 AS INTEGER) AS DATE) AS business_date,
    CASE WHEN (l_partkey + l_suppkey) % 10 = 0 THEN 'X' ELSE '' END || CAST(l_partkey AS VARCHAR) AS product_key,
    CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS signed_quantity,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
    CAST(l_shipdate AS DATE) AS ship_date,
    l_shipdate + to_hours(CAST(l_suppkey % 3 AS INTEGER)) AS ingested
  FROM joined
)"""

SALES = """
sales AS (
  SELECT line_id AS order_id, business_date AS order_date, CAST(o_custkey AS VARCHAR) AS customer_id,
    product_key AS product_id, signed_quantity AS quantity, price AS unit_price, r_name AS region,
    l_linenumber = 7 AS has_schema_drift,
    'orders_' || CAST(ship_date AS VARCHAR) || '.csv' AS _source_file,
    ship_date AS _source_batch_date, ingested AS _ingested_at
  FROM keyed
)"""

PRODUCTS = """
products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
    CAST(p_retailprice AS DECIMAL(12,2)) AS list_price
  FROM part
)"""

REVISED = """
sized AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
    CAST(p_retailprice AS DECIMAL(12,2)) AS list_price, p_size
  FROM part
),
existing AS (SELECT product_id, product_name, category, list_price FROM sized WHERE p_size <= 45),
incoming AS (
  SELECT product_id,
    CASE WHEN p_size % 13 = 0 THEN NULL ELSE product_name END AS product_name,
    CASE WHEN p_size % 7 = 0 THEN 'REVISED' ELSE category END AS category,
    CAST(CASE WHEN p_size % 11 = 0 THEN list_price + 1 ELSE list_price END AS DECIMAL(12,2)) AS list_price
  FROM sized WHERE p_size >= 5
),
changed AS (
  SELECT DISTINCT product_id FROM (
    (SELECT product_id, product_name, category, list_price FROM incoming
     EXCEPT ALL SELECT product_id, product_name, category, list_price FROM existing)
    UNION ALL
    (SELECT product_id, product_name, category, list_price FROM existing
     EXCEPT ALL SELECT product_id, product_name, category, list_price FROM incoming))
)"""

MESSY = """
shifted AS (SELECT *, CAST(business_date + 3653 AS DATE) AS day FROM keyed),
bronze AS (
  SELECT
    CASE WHEN l_suppkey % 50 = 0 THEN '  ' WHEN l_suppkey % 3 = 0 THEN line_id || ' ' ELSE line_id END AS order_id,
    CASE WHEN l_orderkey % 5 = 1 THEN strftime(day, '%m/%d/%Y')
      WHEN l_orderkey % 5 = 2 THEN CAST(CAST(day - DATE '1970-01-01' AS BIGINT) * 86400 + l_suppkey AS VARCHAR)
      WHEN l_orderkey % 5 = 3 AND l_linenumber % 2 = 0 THEN 'bad ' || CAST(day AS VARCHAR)
      WHEN l_orderkey % 5 = 4 THEN '  ' || CAST(day AS VARCHAR) || ' '
      ELSE CAST(day AS VARCHAR) END AS order_date,
    CASE WHEN o_custkey % 4 = 0 THEN ' ' ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
    product_key AS product_id,
    CASE WHEN l_partkey % 23 = 0 THEN '2.0' WHEN l_partkey % 29 = 0 THEN ''
      ELSE ' ' || CAST(signed_quantity AS VARCHAR) END AS quantity,
    CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN 'N/A'
      WHEN l_partkey % 31 = 0 THEN '-$' || CAST(price AS VARCHAR)
      ELSE '$' || format('{:,.2f}', CAST(price AS DOUBLE)) END AS unit_price,
    CASE WHEN l_linenumber % 4 = 1 THEN lower(r_name) WHEN l_linenumber % 4 = 2 THEN '   '
      ELSE ' ' || r_name END AS region,
    CASE WHEN l_linenumber = 7 THEN 'EXTRA' END AS _rescued_data,
    CASE WHEN l_suppkey % 40 = 1 THEN 'orders_resend.csv'
      ELSE 'orders_' || CAST(ship_date AS VARCHAR) || '.csv' END AS _source_file,
    ingested AS _ingested_at
  FROM shifted
),
typed AS (
  SELECT trim(order_id) AS order_id,
    CASE WHEN regexp_full_match(trim(order_date), '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(trim(order_date) AS DATE)
      WHEN regexp_full_match(trim(order_date), '[0-9]{2}/[0-9]{2}/[0-9]{4}')
        THEN CAST(try_strptime(trim(order_date), '%m/%d/%Y') AS DATE)
      WHEN regexp_full_match(trim(order_date), '[0-9]{10}')
        THEN CAST(DATE '1970-01-01' + CAST(TRY_CAST(trim(order_date) AS BIGINT) // 86400 AS INTEGER) AS DATE)
      END AS order_date,
    nullif(trim(customer_id), '') AS customer_id,
    trim(product_id) AS product_id,
    CASE WHEN regexp_full_match(trim(quantity), '[+-]?[0-9]+') THEN TRY_CAST(trim(quantity) AS INTEGER) END AS quantity,
    TRY_CAST(nullif(regexp_replace(trim(unit_price), '[^0-9.-]', '', 'g'), '') AS DECIMAL(12,2)) AS unit_price,
    CASE WHEN nullif(trim(region), '') IS NULL THEN 'Unknown' ELSE
      list_aggregate(list_transform(string_split(lower(trim(region)), ' '),
        lambda w: upper(w[1:1]) || w[2:]), 'string_agg', ' ') END AS region,
    _rescued_data IS NOT NULL AS has_schema_drift,
    _source_file,
    TRY_CAST(nullif(regexp_extract(_source_file, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), '') AS DATE) AS _source_batch_date,
    _ingested_at,
    order_date AS order_date_raw, quantity AS quantity_raw, unit_price AS unit_price_raw, region AS region_raw
  FROM bronze
),
classified AS (
  SELECT *,
    CASE WHEN order_id IS NULL OR order_id = '' THEN 'missing_order_id'
      WHEN order_date IS NULL THEN 'unparseable_order_date'
      WHEN quantity IS NULL THEN 'missing_or_invalid_quantity'
      WHEN unit_price IS NULL THEN 'missing_or_invalid_unit_price'
      WHEN unit_price < 0 THEN 'negative_unit_price' END AS reject_reason
  FROM typed
),
valid AS (SELECT * FROM classified WHERE reject_reason IS NULL),
rejected AS (
  SELECT order_id, order_date_raw, customer_id, product_id, quantity_raw, unit_price_raw, region_raw,
    reject_reason, _source_file
  FROM classified WHERE reject_reason IS NOT NULL
)"""

RECORD_HASH = """sha256(concat_ws('||', coalesce(order_id, ''), coalesce(CAST(order_date AS VARCHAR), ''),
      coalesce(customer_id, ''), coalesce(product_id, ''), coalesce(CAST(quantity AS VARCHAR), ''),
      coalesce(CAST(unit_price AS VARCHAR), ''), coalesce(region, '')))"""

SILVER_COLUMNS = """order_id, order_date, customer_id, product_id, quantity, unit_price, region,
    line_revenue, is_return, is_zero_quantity, has_schema_drift, _source_file, _source_batch_date"""


def latest(name: str, source: str) -> str:
    """The latest version of each order in `source`, as a table expression."""
    return f"""
{name} AS (
  SELECT {SILVER_COLUMNS}, _ingested_at, _record_hash FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _source_batch_date DESC NULLS LAST,
        _ingested_at DESC NULLS LAST, _source_file DESC NULLS LAST, _record_hash DESC NULLS LAST,
        has_schema_drift DESC NULLS LAST) AS version_rank
    FROM (
      SELECT *, {RECORD_HASH} AS _record_hash,
        CAST(quantity * unit_price AS DECIMAL(14,2)) AS line_revenue,
        quantity < 0 AS is_return, quantity = 0 AS is_zero_quantity
      FROM {source}))
  WHERE version_rank = 1
)"""


HELD = latest("held", "(SELECT * FROM sales WHERE quantity >= 0)")
INCOMING = latest("incoming_orders", "(SELECT * FROM sales WHERE quantity < 0)")
SILVER = latest("silver", "valid")

UPSERTED = """
versions_met AS (
  SELECT t.order_id AS t_id, s.order_id AS s_id, coalesce(
    (t._source_batch_date IS NULL AND s._source_batch_date IS NOT NULL)
    OR s._source_batch_date > t._source_batch_date
    OR (s._source_batch_date IS NOT DISTINCT FROM t._source_batch_date
      AND (t._ingested_at IS NULL OR s._ingested_at > t._ingested_at
        OR (s._ingested_at IS NOT DISTINCT FROM t._ingested_at
          AND (t._source_file IS NULL OR s._source_file > t._source_file
            OR (s._source_file IS NOT DISTINCT FROM t._source_file AND s._record_hash > t._record_hash))))),
    false) AS source_wins
  FROM held t FULL OUTER JOIN incoming_orders s ON t.order_id = s.order_id
),
upserted AS (
  SELECT held.* FROM held JOIN versions_met ON order_id = t_id WHERE s_id IS NULL OR NOT source_wins
  UNION ALL
  SELECT incoming_orders.* FROM incoming_orders JOIN versions_met ON order_id = s_id
  WHERE t_id IS NULL OR source_wins
)"""

STALE = """
stale AS (
  SELECT order_date FROM incoming_orders
  UNION
  SELECT order_date FROM held WHERE order_id IN (SELECT order_id FROM incoming_orders)
)"""


def money(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(18,2))"


def amount(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(22,4))"


def whole(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def share(part: str, of: str) -> str:
    return f"round(CAST({part} AS DOUBLE) / nullif(CAST({of} AS DOUBLE), 0), 6)"


def average(total: str, count: str, places: int, sql_type: str) -> str:
    """Money per item rounded half up, worked out in whole units of the last place."""
    units = f"CAST(({total}) * {10 ** places} AS HUGEINT)"
    rounded = f"sign({units}) * ((2 * abs({units}) + {count}) // (2 * nullif({count}, 0)))"
    return f"CAST(CAST({rounded} AS DECIMAL(24,0)) / {10 ** places} AS {sql_type})"


def cells(name: str, source: str, reference: str = "products") -> str:
    """Daily sales of `source` as a table expression."""
    return f"""
{name} AS (
  SELECT order_date, category, region, {money('revenue')} AS net_revenue, order_count, units_sold,
    {average('revenue', 'order_count', 2, 'DECIMAL(18,2)')} AS aov
  FROM (
    SELECT o.order_date, coalesce(p.category, 'Unknown') AS category, o.region,
      sum(CAST(o.quantity * o.unit_price AS DECIMAL(14,2))) AS revenue,
      count(DISTINCT o.order_id) AS order_count, {whole('sum(o.quantity)')} AS units_sold
    FROM {source} o LEFT JOIN {reference} p ON o.product_id = p.product_id
    GROUP BY ALL))"""


RETAIL = """
retail AS (
  SELECT
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
      THEN CASE WHEN l_linenumber % 2 = 0 THEN 'c' ELSE 'C' END ELSE '' END
      || CAST(l_orderkey AS VARCHAR) AS invoice,
    CASE WHEN l_partkey % 20 = 0 THEN 'M' ELSE '' END || CAST(l_partkey AS VARCHAR) AS stock_code,
    CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_linenumber <= 3 THEN upper(p_name) ELSE p_name END AS description,
    CASE WHEN l_suppkey % 97 = 0 THEN NULL ELSE signed_quantity END AS quantity,
    ship_date AS invoice_date,
    CAST(CASE WHEN l_suppkey % 25 = 0 THEN 0 WHEN l_suppkey % 41 = 0 THEN -price ELSE price END AS DECIMAL(12,4)) AS unit_price,
    CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_custkey END AS customer_id,
    CASE WHEN n_nationkey = 3 AND l_linenumber = 6 THEN NULL ELSE n_name END AS country,
    unnest(range(CASE WHEN l_linenumber = 7 THEN 2 ELSE 1 END)) AS copy
  FROM keyed JOIN part ON l_partkey = p_partkey
),
older AS (SELECT * EXCLUDE (copy), 'first' AS source_sheet FROM retail WHERE invoice_date < DATE '1999-07-01'),
newer AS (SELECT * EXCLUDE (copy), 'second' AS source_sheet FROM retail WHERE invoice_date >= DATE '1998-10-01'),
bounds AS (
  SELECT (SELECT min(invoice_date) FROM newer) AS newer_start, (SELECT max(invoice_date) FROM older) AS older_end
),
older_overlap AS (SELECT * FROM older WHERE invoice_date >= (SELECT newer_start FROM bounds)),
newer_overlap AS (SELECT * FROM newer WHERE invoice_date <= (SELECT older_end FROM bounds)),
copies AS (
  SELECT * EXCLUDE (source_sheet) FROM older_overlap INTERSECT ALL SELECT * EXCLUDE (source_sheet) FROM newer_overlap
),
resolved AS (
  SELECT * FROM older WHERE invoice_date < (SELECT newer_start FROM bounds) UNION ALL SELECT * FROM newer
),
lines AS (SELECT DISTINCT * EXCLUDE (source_sheet) FROM resolved),
analysis AS (
  SELECT *, quantity * unit_price AS line_value,
    coalesce(starts_with(upper(invoice), 'C'), false) AS is_cancel_invoice,
    coalesce(quantity > 0 AND unit_price > 0, false) AND NOT coalesce(starts_with(upper(invoice), 'C'), false) AS is_sale_line,
    coalesce(quantity < 0 AND unit_price > 0, false) AS is_negative_line,
    coalesce(regexp_matches(stock_code, '^[0-9]'), false) AS is_product_like_code,
    CAST(date_trunc('month', invoice_date) AS DATE) AS month
  FROM lines
),
sold AS (SELECT * FROM analysis WHERE is_sale_line),
negative AS (SELECT *, -line_value AS negative_value FROM analysis WHERE is_negative_line)"""

MONTHLY = f"""
monthly AS (
  SELECT month, {amount('sum(line_value)')} AS gross_sales, count(DISTINCT invoice) AS orders,
    count(DISTINCT customer_id) AS identified_customers,
    {average('sum(line_value)', 'count(DISTINCT invoice)', 4, 'DECIMAL(22,4)')} AS average_order_value
  FROM sold GROUP BY month
)"""

CUSTOMERS = f"""
customers AS (
  SELECT customer_id, {amount('sum(line_value)')} AS gross_sales, count(DISTINCT invoice) AS orders
  FROM sold WHERE customer_id IS NOT NULL GROUP BY customer_id
)"""

COUNTRIES = f"""
countries AS (
  SELECT country, {amount('sum(line_value)')} AS gross_sales, count(DISTINCT invoice) AS orders,
    count(DISTINCT customer_id) AS customers,
    {share(amount('sum(line_value)'), '(SELECT sum(line_value) FROM sold)')} AS sales_share
  FROM sold WHERE country IS NOT NULL GROUP BY country
)"""

DESCRIPTIONS = """
descriptions AS (
  SELECT stock_code, description, line_count FROM (
    SELECT stock_code, description, count(*) AS line_count,
      row_number() OVER (PARTITION BY stock_code ORDER BY count(*) DESC, description) AS place
    FROM sold WHERE stock_code IS NOT NULL AND description IS NOT NULL GROUP BY stock_code, description)
  WHERE place = 1
)"""

PRODUCT_SALES = f"""
product_sales AS (
  SELECT stock_code, {amount('sum(line_value)')} AS gross_sales, {whole('sum(quantity)')} AS units,
    count(DISTINCT invoice) AS orders
  FROM sold WHERE is_product_like_code GROUP BY stock_code
)"""


def statement(select: str, *expressions: str) -> str:
    return "WITH " + ",".join(expressions) + "\n" + select


def over_retail(select: str, *expressions: str) -> str:
    return statement(select, JOINED, RETAIL, *expressions)


def over_messy(select: str, *expressions: str) -> str:
    return statement(select, JOINED, MESSY, *expressions)


def over_sales(select: str, *expressions: str) -> str:
    return statement(select, JOINED, SALES, *expressions)


REJECT_KEY = [
    "order_id", "order_date_raw", "customer_id", "product_id", "quantity_raw", "unit_price_raw", "region_raw",
    "reject_reason", "_source_file",
]
SAME_REJECT = " AND ".join(f"h.{name} IS NOT DISTINCT FROM r.{name}" for name in REJECT_KEY)

QUEUE = "SELECT order_date, max(_source_batch_date) AS queued_at FROM sales {where} GROUP BY order_date"

MESSY_PRODUCTS = """
raw_products AS (
  SELECT ' ' || CAST(p_partkey AS VARCHAR) AS product_id, p_name || '  ' AS product_name, ' ' || lower(p_type) AS category,
    CASE WHEN p_size % 9 = 0 THEN 'n/a' ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS list_price
  FROM part
  UNION ALL
  SELECT CASE WHEN p_size % 8 = 0 THEN '  ' ELSE ' ' || CAST(p_partkey AS VARCHAR) END,
    CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_name END, p_type, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)
  FROM part
),
typed_products AS (
  SELECT trim(product_id) AS product_id, trim(product_name) AS product_name,
    upper(trim(category)[1:1]) || lower(trim(category)[2:]) AS category, TRY_CAST(list_price AS DECIMAL(12,2)) AS list_price
  FROM raw_products WHERE trim(product_id) <> ''
)"""

TOP_CUTS = """
levels AS (SELECT unnest([1, 5, 10, 20]) AS top_percent),
placed AS (SELECT gross_sales, row_number() OVER (ORDER BY gross_sales DESC, customer_id) AS place FROM customers),
cuts AS (
  SELECT top_percent, greatest(1, ((SELECT count(*) FROM customers) * top_percent + 99) // 100) AS customers FROM levels
)"""


def _repeat_segment(label: str, condition: str) -> str:
    return f"""SELECT '{label}' AS segment, count(*) FILTER ({condition}) AS customers,
    {share(f'count(*) FILTER ({condition})', 'count(*)')} AS customer_share,
    {share(f'coalesce(sum(gross_sales) FILTER ({condition}), 0)', 'sum(gross_sales)')} AS revenue_share FROM customers"""


def _issue(label: str, condition: str) -> str:
    return f"""SELECT '{label}' AS issue, count(*) FILTER ({condition}) AS row_count,
    {share(f'count(*) FILTER ({condition})', 'count(*)')} AS row_share FROM analysis"""


def _step(label: str, count: str) -> str:
    return f"SELECT '{label}' AS step, {whole(count)} AS row_count"


def _total(condition: str, value: str = "line_value") -> str:
    return amount(f"coalesce(sum({value}) FILTER ({condition}), 0)")


ORDER_CHECKS = {
    "order_id_not_null": "order_id IS NOT NULL",
    "order_date_not_null": "order_date IS NOT NULL",
    "quantity_not_null": "quantity IS NOT NULL",
    "unit_price_not_null": "unit_price IS NOT NULL",
    "region_not_null": "region IS NOT NULL",
    "unit_price_non_negative": "unit_price >= 0",
    "region_present": "region <> ''",
}

TOTALS = f"""SELECT (SELECT count(DISTINCT order_id) FROM bronze) AS rows_in, (SELECT count(*) FROM silver) AS loaded,
  (SELECT count(*) FROM rejected) AS quarantined, (SELECT {money('sum(net_revenue)')} FROM cells) AS net_revenue"""

LINE = "invoice, invoice_date, stock_code, description, quantity, unit_price"

ORACLE: dict[str, str] = {
    "parse_orders": over_messy("SELECT * EXCLUDE (_ingested_at) FROM classified"),
    "reject_reasons": over_messy("SELECT reject_reason, count(*) AS row_count FROM rejected GROUP BY reject_reason"),
    "quarantine_rows": over_messy("SELECT * FROM rejected"),
    "latest_version": over_sales("SELECT * EXCLUDE (_ingested_at) FROM newest", latest("newest", "sales")),
    "upsert_orders": over_sales("SELECT * EXCLUDE (_ingested_at) FROM upserted", HELD, INCOMING, UPSERTED),
    "quarantine_merge": over_messy(
        f"""SELECT * FROM held_rejects UNION ALL
        SELECT * FROM rejected r WHERE NOT EXISTS (SELECT 1 FROM held_rejects h WHERE {SAME_REJECT})""",
        "held_rejects AS (SELECT * FROM rejected WHERE reject_reason = 'unparseable_order_date')",
    ),
    "queue_upsert": over_sales(
        "SELECT order_date, max(queued_at) AS queued_at FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY order_date",
        f"a AS ({QUEUE.format(where='WHERE quantity >= 0')})",
        f"b AS ({QUEUE.format(where='WHERE quantity < 0')})",
    ),
    "queue_clear": over_sales(
        "SELECT * FROM a EXCEPT SELECT * FROM b",
        f"a AS ({QUEUE.format(where='')})",
        f"b AS ({QUEUE.format(where='WHERE quantity >= 0')})",
    ),
    "affected_dates": over_sales("SELECT order_date FROM stale", HELD, INCOMING, STALE),
    "conform_products": statement(
        """SELECT product_id, product_name, category, list_price FROM (
          SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_name DESC NULLS LAST,
            category DESC NULLS LAST, list_price DESC NULLS LAST) AS place FROM typed_products) WHERE place = 1""",
        MESSY_PRODUCTS,
    ),
    "changed_products": statement("SELECT product_id FROM changed", REVISED),
    "product_affected_dates": over_sales(
        "SELECT DISTINCT order_date FROM sales WHERE product_id IN (SELECT product_id FROM changed)", REVISED
    ),
    "gold_daily_sales": over_sales("SELECT * FROM cells", PRODUCTS, cells("cells", "sales")),
    "gold_report": over_messy(
        "SELECT * FROM cells ORDER BY order_date, category, region", PRODUCTS, SILVER, cells("cells", "silver")
    ),
    "gold_pipeline": over_sales("SELECT * FROM cells", PRODUCTS, HELD, cells("cells", "held")),
    "incremental_gold": over_sales(
        "SELECT * FROM cells", PRODUCTS, HELD, INCOMING, UPSERTED, cells("cells", "upserted")
    ),
    "stream_ingest_counts": over_messy(
        "SELECT count(*) AS rows_landed, count(_rescued_data) AS rows_with_schema_drift, "
        + ", ".join(f"count(DISTINCT nullif({name}, '')) AS distinct_{name}" for name in ORDER_FIELDS)
        + " FROM bronze"
    ),
    "stream_silver": over_messy("SELECT * EXCLUDE (_ingested_at) FROM silver", SILVER),
    "contract_violations": over_messy(
        "SELECT "
        + ", ".join(f"count(*) FILTER (NOT coalesce({rule}, false)) AS {name}" for name, rule in ORDER_CHECKS.items())
        + " FROM classified"
    ),
    "gate_stats": over_sales(
        f"""SELECT {money('sum(CAST(quantity * unit_price AS DECIMAL(14,2)))')} AS net_revenue, count(*) AS row_count,
        count(*) - count(DISTINCT order_id) AS duplicate_order_ids,
        count(*) FILTER (order_id IS NULL OR order_date IS NULL OR quantity IS NULL OR unit_price IS NULL
          OR region IS NULL) AS invalid_contract_rows FROM sales"""
    ),
    "cell_stats": over_sales(
        f"SELECT {money('sum(net_revenue)')} AS net_revenue, count(*) AS row_count FROM cells",
        PRODUCTS, cells("cells", "sales"),
    ),
    "landing_profile": over_messy(
        """SELECT _source_file, count(*) AS rows_landed, count(_rescued_data) AS rows_with_schema_drift,
        count(DISTINCT order_date) AS distinct_raw_dates FROM bronze GROUP BY _source_file"""
    ),
    "bronze_summary": over_messy(
        """SELECT count(*) AS bronze_rows, count(DISTINCT _source_file) AS source_files,
        CAST(min(_ingested_at) AS DATE) AS first_ingested_at, CAST(max(_ingested_at) AS DATE) AS last_ingested_at
        FROM bronze"""
    ),
    "version_counts": over_messy(
        "SELECT order_id, count(*) AS bronze_versions FROM bronze GROUP BY order_id HAVING count(*) > 1"
    ),
    "rows_per_date": over_messy("SELECT order_date, count(*) AS row_count FROM silver GROUP BY order_date", SILVER),
    "restatement_check": over_sales(
        """SELECT order_id, order_date, quantity, unit_price, line_revenue, _source_file FROM newest
        WHERE order_id IN (SELECT order_id FROM sales GROUP BY order_id HAVING count(*) > 1)""",
        latest("newest", "sales"),
    ),
    "table_counts": over_messy(
        """SELECT 'bronze.orders_raw' AS table_name, count(*) AS row_count FROM bronze
        UNION ALL SELECT 'silver.orders', count(*) FROM silver
        UNION ALL SELECT 'quarantine', count(*) FROM rejected
        UNION ALL SELECT 'gold_refresh_queue', count(DISTINCT order_date) FROM silver""",
        SILVER,
    ),
    "row_balance": over_messy(
        f"""SELECT rows_in, loaded, quarantined, missing_id_rows, rows_in = loaded + quarantined AS balanced FROM (
          SELECT (SELECT count(DISTINCT nullif(trim(order_id), '')) FROM bronze) AS rows_in,
            (SELECT count(*) FROM silver) AS loaded,
            (SELECT count(DISTINCT order_id) FROM rejected
              WHERE order_id <> '' AND order_id NOT IN (SELECT order_id FROM silver)) AS quarantined,
            {whole("(SELECT count(*) FROM rejected WHERE order_id = '')")} AS missing_id_rows)""",
        SILVER,
    ),
    "pipeline_totals": over_messy(TOTALS, PRODUCTS, SILVER, cells("cells", "silver")),
    "tie_out": over_messy(
        f"""SELECT 'silver_net_revenue' AS metric, {money('sum(line_revenue)')} AS value FROM silver
        UNION ALL SELECT 'gold_net_revenue', {money('sum(net_revenue)')} FROM cells
        UNION ALL SELECT 'queued_gold_dates', {money('count(DISTINCT order_date)')} FROM silver""",
        PRODUCTS, SILVER, cells("cells", "silver"),
    ),
    "run_audit": over_messy(
        f"""SELECT 'query' AS run_id, 'gold' AS stage, rows_in, loaded AS rows_loaded, quarantined AS rows_quarantined,
        net_revenue, 'totals of one run' AS notes, CAST(NULL AS BIGINT) AS rows_parsed, CAST(NULL AS BIGINT) AS rows_valid,
        CAST(NULL AS BIGINT) AS dates_affected, CAST(NULL AS BIGINT) AS dates_queued, CAST(NULL AS VARCHAR) AS batch
        FROM ({TOTALS})""",
        PRODUCTS, SILVER, cells("cells", "silver"),
    ),
    "order_changes": over_sales(
        """SELECT t.order_date, t.product_id, t.region, t.quantity, t.line_revenue, 'retract' AS kind
        FROM held t JOIN versions_met ON t.order_id = t_id WHERE s_id IS NOT NULL AND source_wins
        UNION ALL SELECT s.order_date, s.product_id, s.region, s.quantity, s.line_revenue, 'add'
        FROM incoming_orders s JOIN versions_met ON s.order_id = s_id WHERE t_id IS NULL OR source_wins""",
        HELD, INCOMING, UPSERTED,
    ),
    "gold_changes": over_sales(
        """SELECT order_date, category, region, CAST(sum(net_revenue) AS DECIMAL(18,2)) AS net_revenue,
          CAST(sum(order_count) AS BIGINT) AS order_count, CAST(sum(units_sold) AS BIGINT) AS units_sold FROM (
          SELECT order_date, category, region, net_revenue, order_count, units_sold FROM new_cells
          UNION ALL SELECT order_date, category, region, -net_revenue, -order_count, -units_sold FROM old_cells)
        GROUP BY ALL HAVING sum(net_revenue) <> 0 OR sum(order_count) <> 0 OR sum(units_sold) <> 0""",
        PRODUCTS, HELD, INCOMING, UPSERTED, cells("old_cells", "held"), cells("new_cells", "upserted"),
    ),
    "snapshot_diff": over_sales(
        """SELECT order_date, category, region, net_revenue, order_count, units_sold, aov,
          CAST(sum(b) AS BIGINT) AS copies_before, CAST(sum(a) AS BIGINT) AS copies_after FROM (
          SELECT *, 1 AS b, 0 AS a FROM old_cells UNION ALL SELECT *, 0, 1 FROM new_cells)
        GROUP BY ALL HAVING sum(b) <> sum(a)""",
        PRODUCTS, HELD, INCOMING, UPSERTED, cells("old_cells", "held"), cells("new_cells", "upserted"),
    ),
    "snapshot_totals": over_sales(
        f"""SELECT 'before' AS state, count(*) AS row_count, {money('sum(net_revenue)')} AS total FROM old_cells
        UNION ALL SELECT 'after', count(*), {money('sum(net_revenue)')} FROM new_cells""",
        PRODUCTS, HELD, INCOMING, UPSERTED, cells("old_cells", "held"), cells("new_cells", "upserted"),
    ),
    "extract_summary": over_retail(
        """SELECT source_sheet, count(*) AS row_count, min(invoice_date) AS min_date, max(invoice_date) AS max_date
        FROM (SELECT * FROM older UNION ALL SELECT * FROM newer) GROUP BY source_sheet"""
    ),
    "overlap_check": over_retail(
        """SELECT *, older_overlap_rows = identical_rows AND newer_overlap_rows = identical_rows AS is_exact_copy FROM (
          SELECT (SELECT count(*) FROM older_overlap) AS older_overlap_rows,
            (SELECT count(*) FROM newer_overlap) AS newer_overlap_rows, (SELECT count(*) FROM copies) AS identical_rows)"""
    ),
    "overlap_resolved": over_retail("SELECT * FROM resolved"),
    "cleaning_audit": over_retail(
        " UNION ALL ".join(
            [
                _step("rows_in_extracts", "(SELECT count(*) FROM older) + (SELECT count(*) FROM newer)"),
                _step("overlap_rows_removed", "(SELECT count(*) FROM copies)"),
                _step("rows_after_overlap", "(SELECT count(*) FROM resolved)"),
                _step("exact_duplicates_removed", "(SELECT count(*) FROM resolved) - (SELECT count(*) FROM lines)"),
                _step("final_rows", "(SELECT count(*) FROM lines)"),
            ]
        )
    ),
    "overlap_impact": over_retail(
        f"""SELECT overlap_gross_inflation, gross_before_dedup, gross_sales,
          {share('gross_before_dedup - gross_sales', 'gross_before_dedup')} AS dedup_sales_impact FROM (
          SELECT (SELECT {amount('sum(quantity * unit_price)')} FROM older_overlap
              WHERE quantity > 0 AND unit_price > 0) AS overlap_gross_inflation,
            (SELECT {amount('sum(quantity * unit_price)')} FROM resolved
              WHERE quantity > 0 AND unit_price > 0 AND NOT starts_with(upper(invoice), 'C')) AS gross_before_dedup,
            (SELECT {amount('sum(line_value)')} FROM sold) AS gross_sales)"""
    ),
    "line_flags": over_retail(f"SELECT * REPLACE ({amount('line_value')} AS line_value) FROM analysis"),
    "monthly_sales": over_retail("SELECT * FROM monthly", MONTHLY),
    "selected_months": over_retail(
        "SELECT * FROM monthly WHERE month IN (DATE '1998-11-01', DATE '1999-11-01')", MONTHLY
    ),
    "peak_months": over_retail(
        """SELECT year, month, gross_sales FROM (
          SELECT CAST(year(month) AS INTEGER) AS year, month, gross_sales,
            row_number() OVER (PARTITION BY year(month) ORDER BY gross_sales DESC, month) AS place
          FROM monthly WHERE last_day(month) <= (SELECT max(invoice_date) FROM analysis)) WHERE place = 1""",
        MONTHLY,
    ),
    "seasonality_share": over_retail(
        f"""SELECT *, {share('sep_nov_sales', 'jan_nov_sales')} AS sep_nov_share FROM (
          SELECT CAST(year(month) AS INTEGER) AS year, {amount('sum(gross_sales)')} AS jan_nov_sales,
            {amount('coalesce(sum(gross_sales) FILTER (month(month) BETWEEN 9 AND 11), 0)')} AS sep_nov_sales
          FROM monthly WHERE month(month) <= 11 AND year(month) BETWEEN 1996 AND 2000 GROUP BY year(month))""",
        MONTHLY,
    ),
    "customer_summary": over_retail("SELECT * FROM customers", CUSTOMERS),
    "customer_concentration": over_retail(
        f"""SELECT top_percent, {whole('cuts.customers')} AS customers,
          {amount('(SELECT sum(gross_sales) FROM placed WHERE place <= cuts.customers)')} AS gross_sales,
          {share('(SELECT sum(gross_sales) FROM placed WHERE place <= cuts.customers)',
                 '(SELECT sum(gross_sales) FROM customers)')} AS sales_share FROM cuts""",
        CUSTOMERS, TOP_CUTS,
    ),
    "repeat_purchase": over_retail(
        _repeat_segment("One order", "orders = 1") + " UNION ALL " + _repeat_segment("Two or more orders", "orders >= 2"),
        CUSTOMERS,
    ),
    "country_summary": over_retail("SELECT * FROM countries", COUNTRIES),
    "top_countries": over_retail("SELECT * FROM countries ORDER BY gross_sales DESC, country LIMIT 10", COUNTRIES),
    "country_share": over_retail("SELECT country, sales_share FROM countries WHERE country = 'NATION_7'", COUNTRIES),
    "product_summary": over_retail("SELECT * FROM product_sales", PRODUCT_SALES),
    "product_description_mode": over_retail("SELECT * FROM descriptions", DESCRIPTIONS),
    "top_products": over_retail(
        """SELECT stock_code, description, gross_sales, units, orders FROM product_sales
        LEFT JOIN descriptions USING (stock_code) ORDER BY gross_sales DESC, stock_code LIMIT 10""",
        PRODUCT_SALES, DESCRIPTIONS,
    ),
    "negative_breakdown": over_retail(
        f"""SELECT code_group, {amount('sum(negative_value)')} AS negative_value, count(*) AS row_count,
          {share(amount('sum(negative_value)'), '(SELECT sum(negative_value) FROM negative)')} AS negative_value_share
        FROM (SELECT *, CASE WHEN is_product_like_code THEN 'Product-like stock code'
            ELSE 'Non-product-like / administrative code' END AS code_group FROM negative) GROUP BY code_group"""
    ),
    "top_negative_lines": over_retail(
        f"""SELECT {LINE}, {amount('negative_value')} AS negative_value, customer_id, country FROM negative
        ORDER BY negative.negative_value DESC, invoice, invoice_date, stock_code, description NULLS FIRST, quantity,
          unit_price, customer_id NULLS FIRST, country NULLS FIRST LIMIT 12"""
    ),
    "extreme_lines": over_retail(
        f"""SELECT {LINE}, {amount('line_value')} AS line_value, customer_id, country FROM analysis
        WHERE analysis.line_value IS NOT NULL
        ORDER BY abs(analysis.line_value) DESC, invoice, invoice_date, stock_code, description NULLS FIRST, quantity,
          unit_price, analysis.line_value, customer_id NULLS FIRST, country NULLS FIRST LIMIT 15"""
    ),
    "headline_metrics": over_retail(
        f"""SELECT *, {share('negative_value', 'gross_sales')} AS negative_value_rate,
          {share('product_like_negative_value', 'product_like_gross_sales')} AS product_like_return_rate,
          {share('negative_value - product_like_negative_value', 'negative_value')} AS non_product_negative_share,
          {share('missing_customer_rows', 'row_count')} AS missing_customer_share,
          {share('anonymous_sales', 'gross_sales')} AS anonymous_sales_share
        FROM (SELECT {_total('is_sale_line')} AS gross_sales, {_total('is_negative_line', '-line_value')} AS negative_value,
          {_total('unit_price > 0')} AS net_transaction_value,
          {_total('is_negative_line AND is_product_like_code', '-line_value')} AS product_like_negative_value,
          {_total('is_sale_line AND is_product_like_code')} AS product_like_gross_sales,
          {_total('is_sale_line AND customer_id IS NULL')} AS anonymous_sales,
          count(*) FILTER (customer_id IS NULL) AS missing_customer_rows, count(*) AS row_count FROM analysis)"""
    ),
    "overview": over_retail(
        f"""SELECT min(invoice_date) AS first_date, max(invoice_date) AS last_date, count(*) AS row_count,
          count(DISTINCT invoice) AS invoices, count(DISTINCT invoice) FILTER (is_sale_line) AS sale_invoices,
          count(DISTINCT stock_code) FILTER (is_sale_line) AS stock_codes,
          count(DISTINCT customer_id) FILTER (is_sale_line) AS identified_customers,
          count(DISTINCT country) FILTER (is_sale_line) AS countries, {_total('is_sale_line')} AS gross_sales,
          {_total('is_negative_line', '-line_value')} AS negative_value,
          {_total('unit_price > 0')} AS net_transaction_value FROM analysis"""
    ),
    "quality_scorecard": over_retail(
        " UNION ALL ".join(
            [
                f"""SELECT 'Cross-sheet date overlap' AS issue, n AS row_count, {share('n', 'of')} AS row_share FROM (
                  SELECT (SELECT count(*) FROM copies) AS n,
                    (SELECT count(*) FROM older) + (SELECT count(*) FROM newer) AS of)""",
                f"""SELECT 'Remaining exact duplicate rows', n, {share('n', 'of')} FROM (
                  SELECT (SELECT count(*) FROM resolved) - (SELECT count(*) FROM lines) AS n,
                    (SELECT count(*) FROM resolved) AS of)""",
                _issue("Missing customer ID", "customer_id IS NULL"),
                _issue("Missing description", "description IS NULL"),
                _issue("Zero unit price", "unit_price = 0"),
                _issue("Negative unit price", "unit_price < 0"),
                _issue("Negative quantity", "quantity < 0"),
                _issue("Negative quantity without C-prefixed invoice", "quantity < 0 AND NOT is_cancel_invoice"),
            ]
        )
    ),
}
