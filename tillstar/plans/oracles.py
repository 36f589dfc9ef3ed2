"""Equivalent SQL for the registered queries, on the raw tables.

Written straight from the definitions (correlated ranges, window ranks), not
from the way the DataFrame operators work, so that each checks the other.
"""

from __future__ import annotations

from tillstar.operators.checks import REQUIRED
from tillstar.operators.rollups import CALENDAR, GEOGRAPHY, PRODUCT
from tillstar.plans.catalog import CALC_GROUP_QUERIES, NAMES, TIME_QUERIES
from tillstar.sources.schemas import GOLD, ORDER_LINES_TEXT
from tillstar.plans.warehouse import COUNTRY, CORPORATE, FORMULA_TERMS, FY, HORIZON_END, SNAPSHOT, USERS, YEAR

ORACLES: dict[str, str] = {}


def _code(prefix: str, key: str) -> str:
    return f"'{prefix}' || lpad(CAST({key} AS VARCHAR), CAST(greatest(9, length(CAST({key} AS VARCHAR))) AS INTEGER), '0')"


STG = f"""
signup AS (SELECT o_custkey AS sk, MIN(CAST(o_orderdate AS DATE)) AS signup_date FROM orders GROUP BY 1),
stg AS MATERIALIZED (
  SELECT {_code("SO-", "o_orderkey")} AS order_id, CAST(o_orderdate AS DATE) AS order_date,
    {_code("C", "c_custkey")} AS customer_id, c_mktsegment AS segment, signup_date,
    s_name AS store_name, n_name || '-' || CAST(s_suppkey % 2 AS VARCHAR) AS city, n_name AS state, r_name AS country,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Online' ELSE 'Store' END AS channel,
    {_code("SKU-", "p_partkey")} AS sku, p_name AS product_name, p_type AS category,
    p_type || '/' || CAST(p_size % 5 AS VARCHAR) AS subcategory, p_brand AS brand,
    CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
    CAST(l_discount AS DECIMAL(5,4)) AS discount_pct,
    CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (0.550 + p_size * 0.005), 2) AS DECIMAL(12,2)) AS unit_cost,
    l_returnflag = 'R' AS is_returned
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN signup ON sk = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey),
span AS (SELECT year(MIN(order_date)) AS y0, year(MAX(order_date)) AS y1 FROM stg),
days AS (
  SELECT make_date(y0, 1, 1) + CAST(n AS INTEGER) AS d
  FROM span, range((make_date(y1 + 1, 1, 1) - make_date(y0, 1, 1))) AS t(n)),
dim_date AS (
  SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_key, d AS date, year(d) AS year,
    quarter(d) AS quarter, month(d) AS month, strftime(d, '%b') AS month_name, strftime(d, '%Y-%m') AS year_month,
    isodow(d) > 5 AS is_weekend, year(d + INTERVAL 9 MONTH) AS fiscal_year FROM days),
dim_customer AS (
  SELECT DISTINCT ON (customer_id) customer_id, MIN(segment) OVER one AS segment, MIN(signup_date) OVER one AS signup_date,
    DENSE_RANK() OVER (ORDER BY customer_id) AS customer_key FROM stg WINDOW one AS (PARTITION BY customer_id)),
dim_store AS (
  SELECT DISTINCT store_name, city, state, country, if(country = '{COUNTRY}', 'Domestic', 'International') AS region,
    DENSE_RANK() OVER (ORDER BY country, state, city, store_name) AS store_key FROM stg),
dim_product AS (
  SELECT p.*, (SELECT COUNT(DISTINCT sku) FROM stg) - RANK() OVER (ORDER BY sku DESC) + 1 AS product_key
  FROM (SELECT sku, MIN(product_name) AS product_name, MIN(category) AS category, MIN(subcategory) AS subcategory,
    MIN(brand) AS brand, MAX(unit_price) AS list_price FROM stg GROUP BY ALL) p),
amounts AS (
  SELECT *, CAST(ROUND(quantity * unit_price * (1 - discount_pct), 2) AS DECIMAL(18,2)) AS net_revenue,
    CAST(ROUND(quantity * unit_price * discount_pct, 2) AS DECIMAL(18,2)) AS discount_amount,
    CAST(ROUND(quantity * unit_cost, 2) AS DECIMAL(18,2)) AS cost FROM stg),
w AS MATERIALIZED (
  SELECT a.*, d.* EXCLUDE (date), customer_key, store_key, product_key, region,
    year * 12 + month - 1 AS mi, order_date - DATE '1970-01-01' AS di
  FROM amounts a JOIN dim_date d ON a.order_date = d.date JOIN dim_customer USING (customer_id)
    JOIN dim_store USING (store_name, city, state, country) JOIN dim_product USING (sku))"""

ANALYTICS = f"""
ord AS (SELECT order_id, MIN(customer_id) AS customer_id, MIN(order_date) AS order_date, MIN(channel) AS channel
  FROM w GROUP BY order_id),
hist AS (SELECT * FROM w WHERE order_date <= DATE '{SNAPSHOT}'),
hord AS (SELECT order_id, MIN(customer_id) AS customer_id, MIN(order_date) AS order_date, MIN(channel) AS channel
  FROM hist GROUP BY order_id),
feat AS (
  SELECT l.*, frequency, online, orders_last_90d,
    CAST(monetary AS DOUBLE) / frequency AS avg_order_value,
    CAST(online AS DOUBLE) / frequency AS online_share,
    frequency / greatest(tenure_days / CAST(30 AS DOUBLE), CAST(1 AS DOUBLE)) AS orders_per_month
  FROM (SELECT customer_id, DATE '{SNAPSHOT}' - MAX(order_date) AS recency_days,
      DATE '{SNAPSHOT}' - MIN(order_date) AS tenure_days, SUM(net_revenue) AS monetary,
      COALESCE(SUM(net_revenue) FILTER (WHERE order_date > DATE '{SNAPSHOT}' - INTERVAL 12 MONTH), 0) AS monetary_12m,
      CAST(SUM(discount_pct) AS DOUBLE) / COUNT(*) AS avg_discount, COUNT(DISTINCT category) AS n_categories,
      CAST(COUNT(*) FILTER (WHERE is_returned) AS DOUBLE) / COUNT(*) AS return_rate,
      CASE WHEN MIN(segment) = '{CORPORATE}' THEN 1 ELSE 0 END AS is_corporate
    FROM hist GROUP BY customer_id) l
  JOIN (SELECT customer_id, COUNT(*) AS frequency, COUNT(*) FILTER (WHERE channel = 'Online') AS online,
      COUNT(*) FILTER (WHERE order_date > DATE '{SNAPSHOT}' - 90) AS orders_last_90d
    FROM hord GROUP BY customer_id) o USING (customer_id)),
active AS (
  SELECT *, CASE WHEN customer_id IN (SELECT customer_id FROM w WHERE order_date > DATE '{SNAPSHOT}'
    AND order_date <= DATE '{HORIZON_END}') THEN 0 ELSE 1 END AS churned FROM feat WHERE recency_days <= 365),
ranked AS (
  SELECT *, COUNT(*) OVER () AS n,
    ROW_NUMBER() OVER (ORDER BY recency_days DESC, customer_id DESC) AS rr,
    ROW_NUMBER() OVER (ORDER BY frequency, customer_id) AS rf,
    ROW_NUMBER() OVER (ORDER BY monetary, customer_id) AS rm FROM active),
rfm AS (
  SELECT *, CASE WHEN R >= 3 AND F >= 3 AND M >= 3 THEN 'Champions' WHEN R >= 3 AND F <= 2 THEN 'Promising'
    WHEN R <= 2 AND F >= 3 THEN 'At risk' WHEN R <= 2 AND F <= 2 THEN 'Hibernating' ELSE 'Needs attention' END AS segment
  FROM (SELECT *, {", ".join(
      f"1 + CAST(4*({r}-1) > n-1 AS INTEGER) + CAST(4*({r}-1) > 2*(n-1) AS INTEGER)"
      f" + CAST(4*({r}-1) > 3*(n-1) AS INTEGER) AS {name}" for r, name in (("rr", "R"), ("rf", "F"), ("rm", "M")))}
    FROM ranked)),
probable AS (
  SELECT *, ROUND(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-(CAST(-1.5 AS DOUBLE) + recency_days * CAST(0.02 AS DOUBLE)
    + return_rate * CAST(0.5 AS DOUBLE) - orders_last_90d * CAST(0.25 AS DOUBLE)
    - online_share * CAST(0.75 AS DOUBLE)))), 4) AS churn_probability FROM rfm),
scores AS (
  SELECT customer_id, R, F, M, segment, churned AS churned_h2_2025, recency_days, frequency,
    CAST(monetary AS DOUBLE) AS monetary, churn_probability,
    CASE WHEN churn_probability <= CAST(0.3 AS DOUBLE) THEN 'Low'
      WHEN churn_probability <= CAST(0.6 AS DOUBLE) THEN 'Medium' ELSE 'High' END AS churn_risk,
    CAST(monetary_12m AS DOUBLE) AS monetary_12m, monetary AS money, monetary_12m AS money_12m FROM probable),
firsts AS (SELECT customer_id, CAST(date_trunc('month', MIN(order_date)) AS DATE) AS cohort_month FROM ord GROUP BY 1),
first_purchase AS (
  SELECT *, CAST(year(cohort_month) AS VARCHAR) || 'Q' || CAST(quarter(cohort_month) AS VARCHAR) AS cohort FROM firsts),
cohort_size AS (SELECT cohort, COUNT(*) AS size FROM first_purchase GROUP BY 1),
cohorts AS (
  SELECT cohort, age AS months_since_first,
    CAST((CAST(COUNT(DISTINCT customer_id) AS BIGINT) * 2000 + MIN(size)) // (2 * MIN(size)) AS DOUBLE) / 10 AS retention_pct
  FROM (SELECT *, (year(order_date) - year(cohort_month)) * 12 + month(order_date) - month(cohort_month) AS age
    FROM ord JOIN first_purchase USING (customer_id)) JOIN cohort_size USING (cohort)
  WHERE age <= 12 AND cohort <= '2000Q2' GROUP BY 1, 2),
split AS (
  SELECT customer_id, churned, rn <= floor(n * 0.25 + 0.5) AS is_test FROM (SELECT customer_id, churned,
    ROW_NUMBER() OVER (PARTITION BY churned ORDER BY md5(customer_id || ':42'), customer_id) AS rn,
    COUNT(*) OVER (PARTITION BY churned) AS n FROM active)),
curve AS (
  SELECT *, SUM(n) OVER (ORDER BY s DESC) AS n_to, SUM(pos) OVER (ORDER BY s DESC) AS pos_to
  FROM (SELECT churn_probability AS s, COUNT(*) AS n, SUM(churned_h2_2025) AS pos FROM scores GROUP BY 1))"""


def _sql(name: str, body: str, analytics: bool = False, ctes: str = "") -> None:
    parts = [STG.strip(), *([ANALYTICS.strip()] if analytics else []), *([ctes] if ctes else [])]
    ORACLES[name] = "WITH " + ",\n".join(parts) + "\n" + body.strip()


def _d(column: str) -> str:
    return f"CAST({column} AS DOUBLE) AS {column}"


def _s(column: str) -> str:
    return f"CAST({column} AS VARCHAR) AS {column}"


TYPED = (
    f"order_id, {_s('order_date')}, customer_id, segment, {_s('signup_date')}, store_name, city, state, country, "
    "channel, sku, product_name, category, subcategory, brand, quantity, "
    f"{_d('unit_price')}, {_d('discount_pct')}, {_d('unit_cost')}, is_returned"
)
TABLES = {
    "dim_date": f"SELECT * EXCLUDE (date), {_s('date')} FROM dim_date",
    "dim_customer": f"SELECT customer_id, segment, {_s('signup_date')}, customer_key FROM dim_customer",
    "dim_store": "SELECT * FROM dim_store",
    "dim_product": f"SELECT * EXCLUDE (list_price), {_d('list_price')} FROM dim_product",
    "fact_sales": "SELECT order_id, customer_key, store_key, product_key, channel, quantity, is_returned, date_key, "
    + ", ".join(map(_d, ("unit_price", "discount_pct", "net_revenue", "discount_amount", "cost")))
    + " FROM w",
    "security_user_country": "SELECT * FROM (VALUES "
    + ", ".join(f"('{u}', '{c}')" for u, c in USERS)
    + ") AS t(user_email, country)",
}

# sources
_sql("read_order_lines", "SELECT " + ", ".join(
    f"'  ' || {c} || ' ' AS {c}" if c in ORDER_LINES_TEXT else f"CAST({c} AS VARCHAR) AS {c}" for c in (
        "order_id", "order_date", "customer_id", "segment", "signup_date", "store_name", "city", "state", "country",
        "channel", "sku", "product_name", "category", "subcategory", "brand", "quantity", "unit_price", "discount_pct",
        "unit_cost", "is_returned")) + " FROM stg")
_sql("stage_order_lines", f"SELECT {TYPED} FROM stg")
_sql("stage_order_lines_csv", f"SELECT {TYPED} FROM stg")
for _t, _body in TABLES.items():
    if _t == "security_user_country":
        _body = f"""SELECT user_email, country, COUNT(*) AS stores FROM ({_body}) JOIN dim_store USING (country)
          GROUP BY user_email, country"""
    _sql(f"read_gold_{_t}", _body)
    _sql("security_map" if _t == "security_user_country" else _t, _body)
_sql("write_gold", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", COUNT(*) AS rows FROM {'w' if t == 'fact_sales' else t}"
    for t in TABLES if t != "security_user_country"))
SCORE_COLUMNS = (
    "customer_id, R, F, M, segment, churned_h2_2025, recency_days, frequency, monetary, churn_probability, churn_risk"
)
_sql("read_scores", f"""SELECT {SCORE_COLUMNS}, CASE churn_risk WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END
  AS risk_order FROM scores""", True)
_sql("customer_scores_formula", f"SELECT {SCORE_COLUMNS}, monetary_12m FROM scores", True)
_sql("read_cohorts", "SELECT cohort, months_since_first, retention_pct / 100 AS retention FROM cohorts", True)
_sql("order_line_scan", f"""SELECT customer_id, segment, {_s('order_date')}, order_id, channel, {_d('net_revenue')},
  {_d('discount_pct')}, is_returned, category FROM w""")

# projections and filters
_sql("line_amounts", f"""SELECT order_id, sku, quantity, {_d('unit_price')}, {_d('net_revenue')},
  {_d('discount_amount')}, {_d('cost')} FROM amounts""")
_sql("kept_lines", f"SELECT order_id, product_key, date_key, {_d('net_revenue')} FROM w WHERE NOT is_returned")
for _n, _where in (
    ("year", f"year = {YEAR}"),
    ("fiscal_year", f"fiscal_year = {FY}"),
    ("range", f"order_date BETWEEN DATE '{YEAR}-01-01' AND DATE '{YEAR}-06-30'"),
):
    _sql(f"period_filter_{_n}", f"SELECT order_id, date_key, {_d('net_revenue')} FROM w WHERE {_where}")
_sql("history_asof", f"""SELECT customer_id, order_id, {_s('order_date')}, {_d('net_revenue')} FROM w
  WHERE order_date <= DATE '{SNAPSHOT}'""")
_sql("history_after", f"""SELECT customer_id, order_id, {_s('order_date')} FROM w
  WHERE w.order_date > DATE '{SNAPSHOT}' AND w.order_date <= DATE '{HORIZON_END}'""")
_sql("history_trailing_90d", f"""SELECT customer_id, order_id, {_s('order_date')} FROM w
  WHERE w.order_date > DATE '{SNAPSHOT}' - 90 AND w.order_date <= DATE '{SNAPSHOT}'""")
_sql("active_customers_asof", "SELECT customer_id, recency_days FROM active", True)

# joins
_sql("star_join", f"""SELECT order_id, date_key, customer_id, sku, store_name, city, region, category, month_name,
  fiscal_year, {_d('net_revenue')} FROM w""")
_sql("churn_label", "SELECT customer_id, churned FROM active", True)
_sql("scores_customer", f"""SELECT customer_id, customer_key, c.segment, {_s('signup_date')}, s.segment AS rfm_segment,
  churn_risk FROM scores s JOIN dim_customer c USING (customer_id)""", True)
_sql("distinct_stores", "SELECT DISTINCT store_name, city, state, country FROM stg")
_sql("dense_key", f"""SELECT order_id, {_s('order_date')}, ROW_NUMBER() OVER (ORDER BY o.order_date DESC, order_id) AS position
  FROM (SELECT DISTINCT order_id, order_date FROM stg) o""")

# base measures
KEPT = "FILTER (WHERE NOT is_returned)"
REV, COST = f"SUM(net_revenue) {KEPT}", f"SUM(cost) {KEPT}"
ORDERS = f"NULLIF(COUNT(DISTINCT order_id) {KEPT}, 0)"
CUSTOMERS = f"NULLIF(COUNT(DISTINCT customer_key) {KEPT}, 0)"
MARGIN = f"CASE WHEN {REV} IS NOT NULL OR {COST} IS NOT NULL THEN COALESCE({REV}, 0) - COALESCE({COST}, 0) END"


def _div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


MEASURE_SQL = {
    "total_revenue": f"CAST({REV} AS DOUBLE)",
    "total_cost": f"CAST({COST} AS DOUBLE)",
    "gross_margin": f"CAST({MARGIN} AS DOUBLE)",
    "gross_margin_pct": _div(MARGIN, REV),
    "orders": ORDERS,
    "units_sold": f"CAST(SUM(quantity) {KEPT} AS BIGINT)",
    "active_customers": CUSTOMERS,
    "avg_order_value": _div(REV, ORDERS),
    "return_rate_pct": _div("COUNT(*) FILTER (WHERE is_returned)", "COUNT(*)"),
    "discount_pct": _div("SUM(discount_amount)", "(SUM(discount_amount) + SUM(net_revenue))"),
    "revenue_per_customer": _div(REV, CUSTOMERS),
}
for _n, _e in MEASURE_SQL.items():
    _sql(f"m_{_n}", f"SELECT category, year, {_e} AS {_n} FROM w GROUP BY category, year")
ALL = ", ".join(f"{e} AS {n}" for n, e in MEASURE_SQL.items())
_sql("m_all_total", f"SELECT {ALL} FROM w")
_sql("m_all_by_country_channel", f"SELECT country, channel, {ALL} FROM w GROUP BY country, channel")
_sql("m_by_customer_segment", "SELECT segment, " + ", ".join(
    f"{MEASURE_SQL[n]} AS {n}" for n in ("total_revenue", "gross_margin_pct", "discount_pct")) + " FROM w GROUP BY segment")
_sql("m_new_customers", """SELECT category, first_key // 100 AS period, COUNT(*) AS new_customers
  FROM (SELECT category, customer_key, MIN(date_key) AS first_key FROM w GROUP BY 1, 2) GROUP BY 1, 2""")
HIGH = "FILTER (WHERE churn_risk = 'High')"
SCORE_SQL = {
    "customers_scored": "COUNT(*)",
    "high_risk_customers": f"NULLIF(COUNT(*) {HIGH}, 0)",
    "high_risk_pct": _div(f"NULLIF(COUNT(*) {HIGH}, 0)", "COUNT(*)"),
    "avg_churn_probability": _div("SUM(CAST(churn_probability AS DECIMAL(10,4)))", "COUNT(*)"),
    "observed_churn_pct": _div("SUM(churned_h2_2025)", "COUNT(*)"),
    "revenue_at_risk": f"CAST(SUM(money) {HIGH} AS DOUBLE)",
}
for _n, _e in SCORE_SQL.items():
    _sql(f"m_{_n}", f"SELECT segment, {_e} AS {_n} FROM scores GROUP BY segment", True)
_sql("m_revenue_at_risk_12m", f"SELECT segment, CAST(SUM(money_12m) {HIGH} AS DOUBLE) AS revenue_at_risk FROM scores GROUP BY 1", True)
_sql("m_retention_pct", f"""SELECT months_since_first, {_div("SUM(CAST(retention_pct AS DECIMAL(6,1)))", "COUNT(*)")} / 100
  AS retention_pct FROM cohorts GROUP BY 1""", True)

# other aggregates
_sql("conditional_agg_yoy", f"""SELECT CAST(cur AS DOUBLE) AS revenue, CAST(py AS DOUBLE) AS revenue_py,
  {_div('cur', 'py')} - 1 AS yoy_pct FROM (SELECT SUM(net_revenue) FILTER (WHERE NOT is_returned AND year = {YEAR}) AS cur,
  SUM(net_revenue) FILTER (WHERE NOT is_returned AND year = {YEAR - 1}) AS py FROM w)""")


def _rollup(levels: tuple, names: tuple) -> str:
    source = "(SELECT *, CAST(order_date AS VARCHAR) AS date FROM w)"
    level = " + ".join(f"(1 - GROUPING({c}))" for c in levels)
    values = ", ".join(f"{MEASURE_SQL[n]} AS {n}" for n in names)
    return f"SELECT CAST({level} AS INTEGER) AS level, {', '.join(levels)}, {values} FROM {source} GROUP BY ROLLUP ({', '.join(levels)})"


_sql("geo_rollup", _rollup(GEOGRAPHY, ("total_revenue", "orders")))
_sql("calendar_rollup", _rollup(CALENDAR, ("total_revenue", "units_sold")))
_sql("product_rollup", _rollup(PRODUCT, ("total_revenue", "gross_margin_pct", "active_customers")))
PIVOT = ", ".join(f"MAX(retention_pct) FILTER (WHERE months_since_first = {i}) AS m{i}" for i in range(13))
_sql("cohort_pivot", f"SELECT cohort, {PIVOT} FROM cohorts GROUP BY cohort", True)
_sql("cohort_unpivot", "SELECT cohort, months_since_first, retention_pct FROM cohorts", True)
_sql("cohort_retention", "SELECT cohort, months_since_first, retention_pct FROM cohorts", True)
_sql("month3_retention", "SELECT cohort, retention_pct FROM cohorts WHERE months_since_first = 3", True)
_sql("segment_summary", """SELECT segment, COUNT(*) AS customers,
  CAST((SUM(churned) * 2000 + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 10 AS churn_rate_pct FROM rfm GROUP BY segment""", True)


# Position, label and context of the expected table; then value, decimals, text before and after, scale.
KPI = (
    (1, "Total Revenue", f"year = {YEAR}", "rev", 0, "₹ ", "", 1),
    (2, "Total Revenue", f"year = {YEAR - 1}", "rev_py", 0, "₹ ", "", 1),
    (3, "Revenue YoY %", f"year = {YEAR}", "rev / NULLIF(rev_py, 0) - 1", 1, "", "%", 100),
    (4, "Orders", f"year = {YEAR}", "orders", 0, "", "", 1),
    (5, "Avg Order Value", f"year = {YEAR}", "rev / NULLIF(orders, 0)", 0, "₹ ", "", 1),
    (6, "Gross Margin %", f"year = {YEAR}", "(rev - cost) / NULLIF(rev, 0)", 1, "", "%", 100),
    (7, "Return Rate %", f"year = {YEAR}", "returned / NULLIF(lines, 0)", 2, "", "%", 100),
    (8, "Active Customers", f"year = {YEAR}", "customers", 0, "", "", 1),
    (9, "Revenue FYTD", f"last date of FY{FY}", "fytd", 0, "₹ ", "", 1),
    (10, "Revenue YTD", f"30-Jun-{YEAR}", "ytd", 0, "₹ ", "", 1),
    (12, f"Total Revenue (RLS: {COUNTRY} Only)", f"year = {YEAR}", "secured", 0, "₹ ", "", 1),
)


def _kpi() -> str:
    """One grouped pass for all sums; each row of the table is an expression of them."""
    sums = {
        "rev": f"SUM(net_revenue) FILTER (NOT is_returned AND year = {YEAR})",
        "rev_py": f"SUM(net_revenue) FILTER (NOT is_returned AND year = {YEAR - 1})",
        "cost": f"SUM(cost) FILTER (NOT is_returned AND year = {YEAR})",
        "orders": f"COUNT(DISTINCT order_id) FILTER (NOT is_returned AND year = {YEAR})",
        "customers": f"COUNT(DISTINCT customer_key) FILTER (NOT is_returned AND year = {YEAR})",
        "lines": f"COUNT(*) FILTER (year = {YEAR})",
        "returned": f"COUNT(*) FILTER (is_returned AND year = {YEAR})",
        "fytd": f"SUM(net_revenue) FILTER (NOT is_returned AND fiscal_year = {FY})",
        "ytd": f"SUM(net_revenue) FILTER (NOT is_returned AND year = {YEAR} AND month <= 6)",
        "secured": f"SUM(net_revenue) FILTER (NOT is_returned AND year = {YEAR} AND country = '{COUNTRY}')",
    }
    one = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in sums.items())
    rows = []
    for position, label, context, value, decimals, before, after, scale in KPI:
        number = f"ROUND(CAST(v AS DECIMAL(38,6)) * {scale}, {decimals})"
        shown = f"printf('%.{decimals}f', CAST({number} AS DOUBLE))" if decimals else f"format('{{:,}}', CAST({number} AS BIGINT))"
        rows.append(
            f"SELECT {position} AS position, '{label}' AS measure, '{context}' AS context, v AS value, "
            f"'{before}' || {shown} || '{after}' AS text FROM (SELECT {value} AS v FROM one)"
        )
    best = f"""SELECT 11, 'Category Rank = 1', 'year = {YEAR}', NULL, arg_min(category, (-r, category)) FROM (
      SELECT category, SUM(net_revenue) AS r FROM w WHERE NOT is_returned AND year = {YEAR} GROUP BY ALL)"""
    return f"SELECT * FROM (WITH one AS (SELECT {one} FROM w) {' UNION ALL '.join([*rows, best])})"


_sql("kpi_table", _kpi())

# time intelligence: per context period, each item is one range of positions
SHIFT = {"Current": 0, "PY": 12, "PM": 1}
PERIOD = {
    "day": ("di", "date", "CAST(date AS VARCHAR)"),
    "month": ("mi", "mi", "MIN(year_month)"),
    "quarter": ("mi", "mi // 3", "MIN(year || 'Q' || quarter)"),
    "year": ("mi", "year", "CAST(year AS VARCHAR)"),
    "fiscal_year": ("mi", "fiscal_year", "CAST(fiscal_year AS VARCHAR)"),
}


FIRST_ROW = " QUALIFY ROW_NUMBER() OVER (PARTITION BY {by}, customer_key ORDER BY date_key) = 1"


def _range(item: str, grain: str) -> tuple[str, str]:
    """First and last position of an item, from the context's first (lo) and last (hi) position."""
    if item in SHIFT:
        return f"lo - {SHIFT[item]}", f"hi - {SHIFT[item]}"
    if grain == "day":
        unit = {"MTD": "month", "QTD": "quarter"}[item]
        return f"CAST(date_trunc('{unit}', DATE '1970-01-01' + CAST(hi AS INTEGER)) AS DATE) - DATE '1970-01-01'", "hi"
    start = {
        "MTD": "hi", "QTD": "hi - hi % 3", "YTD": "hi - hi % 12", "FYTD": "hi - (hi - 3) % 12",
        "Running Total": "0", "3M Avg": "hi - 2",
    }
    return start[item], "hi"


def _rows(measure: str, by: str, at: str) -> str:
    """What the contexts are joined with; sums of one column are taken per position first."""
    if measure == "total_revenue":
        return f"SELECT {by}, {at} AS at_, is_returned, SUM(net_revenue) AS net_revenue FROM w GROUP BY ALL"
    return f"SELECT *, {at} AS at_ FROM w{FIRST_ROW.format(by=by) if measure == 'new_customers' else ''}"


def _time_base(measure: str, items: tuple, by: str, grain: str) -> tuple[str, str]:
    """CTEs ctx and one per plain item; returns (CTEs, SELECT source)."""
    at, group, label = PERIOD[grain]
    plain = [i for i in ("Current", "PY", "PM", "MTD", "QTD", "YTD", "FYTD", "Running Total", "3M Avg") if i in items]
    if {"YoY", "YoY %"} & set(items):
        plain = list(dict.fromkeys([*plain, "Current", "PY"]))
    if "MoM %" in items:
        plain = list(dict.fromkeys([*plain, "Current", "PM"]))
    ctes = [
        "cal AS (SELECT *, year * 12 + month - 1 AS mi, date - DATE '1970-01-01' AS di FROM dim_date)",
        f"per AS (SELECT {label} AS period, MIN({at}) AS lo, MAX({at}) AS hi FROM cal GROUP BY {group})",
        f"ctx AS (SELECT * FROM per CROSS JOIN (SELECT DISTINCT {by} FROM w))",
        f"rows_ AS MATERIALIZED ({_rows(measure, by, at)})",
    ]
    joins = ""
    for i, item in enumerate(plain):
        lo, hi = _range(item, grain)
        value = MEASURE_SQL.get(measure, "COUNT(*)")
        if item == "3M Avg":
            value = f"CAST({value} AS DOUBLE) / 3"
        ctes.append(
            f"i{i} AS (SELECT period, {by}, {value} AS v FROM (SELECT period, {by}, {lo} AS a, {hi} AS b FROM ctx) c "
            f"JOIN rows_ USING ({by}) WHERE at_ BETWEEN a AND b GROUP BY period, {by})"
        )
        joins += f" LEFT JOIN i{i} ON i{i}.period = ctx.period AND i{i}.{by} = ctx.{by}"
    columns = ", ".join(f"i{i}.v AS {NAMES[item]}" for i, item in enumerate(plain))
    ctes.append(f"base AS (SELECT ctx.period, ctx.{by}, {columns} FROM ctx{joins})")
    picked = ", ".join(DERIVED_SQL.get(i, NAMES[i]) for i in items)
    return ", ".join(ctes), f"SELECT period, {by}, {picked} FROM base"


def _grid(by: str, members: str) -> str:
    """Kept revenue of every member in every month of the calendar, and each plain item by window
    frames over that dense grid; blank where no kept line counts."""
    kept = f"SELECT {by}, mi, SUM(net_revenue) AS v FROM w WHERE NOT is_returned GROUP BY ALL"
    return f"""months AS (SELECT DISTINCT year * 12 + month - 1 AS mi, year_month, year, quarter, fiscal_year FROM dim_date),
    grid AS MATERIALIZED (SELECT m.{by}, c.*, r.v FROM ({members}) m CROSS JOIN months c LEFT JOIN ({kept}) r ON r.{by} = m.{by} AND r.mi = c.mi),
    items AS MATERIALIZED (SELECT {by}, year_month AS period, mi, v AS current, lag(v, 12) OVER one AS py, lag(v, 1) OVER one AS pm, v AS mtd,
      SUM(v) OVER (PARTITION BY {by}, year, quarter ORDER BY mi) AS qtd, SUM(v) OVER (PARTITION BY {by}, year ORDER BY mi) AS ytd,
      SUM(v) OVER (PARTITION BY {by}, fiscal_year ORDER BY mi) AS fytd, SUM(v) OVER one AS running_total,
      SUM(v) OVER (PARTITION BY {by} ORDER BY mi ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) / CAST(3 AS DOUBLE) AS rolling_3m_avg
      FROM grid WINDOW one AS (PARTITION BY {by} ORDER BY mi))"""


DERIVED_SQL = {
    "YoY": "CASE WHEN current IS NOT NULL OR py IS NOT NULL THEN COALESCE(current, 0) - COALESCE(py, 0) END AS yoy",
    "YoY %": "CASE WHEN py IS NOT NULL THEN (COALESCE(current, 0) - py) / NULLIF(CAST(py AS DOUBLE), 0) END AS yoy_pct",
    "MoM %": "CASE WHEN pm IS NOT NULL THEN (COALESCE(current, 0) - pm) / NULLIF(CAST(pm AS DOUBLE), 0) END AS mom_pct",
}

# Exact differences: revenue stays decimal until the end.
for _n, (_m, _items, _by, _grain) in TIME_QUERIES.items():
    if (_m, _grain) == ("total_revenue", "month"):
        _out = ", ".join(DERIVED_SQL.get(i, NAMES[i]) for i in _items)
        _typed = ", ".join(f"CAST({NAMES[i]} AS DOUBLE) AS {NAMES[i]}" for i in _items)
        _some = " OR ".join(f"{NAMES[i]} IS NOT NULL" for i in _items)
        _sql(_n, f"SELECT period, {_by}, {_typed} FROM (SELECT period, {_by}, {_out} FROM items) WHERE {_some}",
             ctes=_grid(_by, f"SELECT DISTINCT {_by} FROM w"))
        continue
    _ctes, _select = _time_base(_m, _items, _by, _grain)
    if _m == "total_revenue":
        _ctes = _ctes.replace(f"CAST({REV} AS DOUBLE)", REV)
        _out = ", ".join(f"CAST({NAMES[i]} AS DOUBLE) AS {NAMES[i]}" for i in _items)
        _select = f"SELECT period, {_by}, {_out} FROM ({_select})"
    _some = " OR ".join(f"{NAMES[i]} IS NOT NULL" for i in _items)
    _sql(_n, f"SELECT * FROM ({_select}) WHERE {_some}", ctes=_ctes)

CALC_ITEMS = ("Current", "PY", "YoY", "YoY %", "MTD", "QTD", "YTD", "FYTD")
for _n, (_m, _by, _grain) in CALC_GROUP_QUERIES.items():
    _ctes, _select = _time_base(_m, CALC_ITEMS, _by, _grain)
    if _m == "total_revenue":
        _ctes = _ctes.replace(f"CAST({REV} AS DOUBLE)", REV)
    _long = " UNION ALL ".join(
        f"SELECT period, {_by}, '{c}' AS calc, {i} AS ordinal, CAST({NAMES[c]} AS DOUBLE) AS value FROM wide"
        for i, c in enumerate(CALC_ITEMS)
    )
    _sql(_n, f"SELECT * FROM ({_long}) WHERE value IS NOT NULL", ctes=f"{_ctes}, wide AS ({_select})")


# measures of two stages: each plain item on a dense grid of members and periods, members compared within
# a period, year-over-year items from the finished values
PLAIN_ITEMS = ("Current", "PY", "MTD", "QTD", "YTD", "FYTD")
AT_LAST_MONTH = {"month": ("period", "mi"), "quarter": ("year || 'Q' || quarter", "mi // 3"), "year": ("CAST(year AS VARCHAR)", "year")}


def _plain_items(by: str, members: str, grain: str, sales: str = "w") -> str:
    """CTEs up to ``plain``: per member and period the six plain items of kept revenue. At coarser grains
    the to-date items are read at the period's last month; whole periods are summed."""
    label, number = AT_LAST_MONTH[grain]
    back = {"month": 12, "quarter": 4, "year": 1}[grain]
    base = _grid(by, members).replace("FROM w WHERE", f"FROM {sales} WHERE")
    return f"""{base},
    labelled AS (SELECT i.*, c.year, c.quarter, {number.replace('mi', 'i.mi')} AS pn, {label} AS label FROM items i JOIN months c ON c.mi = i.mi),
    whole AS (SELECT {by}, pn, MIN(label) AS period, SUM(current) AS current, (arg_max(to_date, mi)).mtd AS mtd, (arg_max(to_date, mi)).qtd AS qtd,
      (arg_max(to_date, mi)).ytd AS ytd, (arg_max(to_date, mi)).fytd AS fytd
      FROM (SELECT *, {{'mtd': mtd, 'qtd': qtd, 'ytd': ytd, 'fytd': fytd}} AS to_date FROM labelled) GROUP BY {by}, pn),
    plain AS (SELECT *, lag(current, {back}) OVER (PARTITION BY {by} ORDER BY pn) AS py FROM whole)"""


def _items_long(source: str, keys: str, value: dict[str, str]) -> str:
    """The calculation group in long form from one column per plain item."""
    some = {**value, "YoY": "CASE WHEN {c} IS NOT NULL OR {p} IS NOT NULL THEN COALESCE({c}, 0) - COALESCE({p}, 0) END",
            "YoY %": "CASE WHEN {p} IS NOT NULL THEN (COALESCE({c}, 0) - {p}) / NULLIF({p}, 0) END"}
    parts = [
        f"SELECT period, {keys}, '{c}' AS calc, {i} AS ordinal, "
        f"CAST({some[c].format(c=value['Current'], p=value['PY'])} AS DOUBLE) AS value FROM {source}"
        for i, c in enumerate(CALC_ITEMS)
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE value IS NOT NULL"


def _rank_items(shown: str) -> str:
    names = [NAMES[c] for c in PLAIN_ITEMS]
    ranks = ", ".join(f"DENSE_RANK() OVER (PARTITION BY pn ORDER BY COALESCE({n}, 0) DESC) AS {n}_rank" for n in names)
    return f"ranked AS (SELECT *, {ranks} FROM plain), " + "shown AS (SELECT period, {by}, ".replace("{by}", shown)


for _n, _by, _members, _grain, _sales, _top in (
    ("calc_group_category_rank", "category", "SELECT DISTINCT category FROM dim_product", "quarter", "w", None),
    ("calc_group_city_rank", "city", f"SELECT DISTINCT city FROM dim_store WHERE country = '{COUNTRY}'", "month",
     f"(SELECT * FROM w WHERE country = '{COUNTRY}')", None),
    ("calc_group_top_n", "category", "SELECT DISTINCT category FROM dim_product", "year", "w", 3),
):
    _shown = ", ".join(
        f"CAST({NAMES[c]}_rank AS DOUBLE) AS x{i}" if _top is None
        else f"CASE WHEN {NAMES[c]}_rank <= {_top} THEN CAST({NAMES[c]} AS DOUBLE) END AS x{i}"
        for i, c in enumerate(PLAIN_ITEMS)
    )
    _ctes = f"{_plain_items(_by, _members, _grain, _sales)}, {_rank_items(_by)}{_shown} FROM ranked)"
    _sql(_n, _items_long("shown", _by, {c: f"x{i}" for i, c in enumerate(PLAIN_ITEMS)}), ctes=_ctes)


def _share_items(levels: tuple, grain: str) -> str:
    """Cities add up to their states and countries in every context; a share is of the level above."""
    path = ", ".join(levels)
    city = _plain_items("path", f"SELECT DISTINCT {path}, concat_ws('|', {path}) AS path FROM dim_store", grain,
                        f"(SELECT *, concat_ws('|', {path}) AS path FROM w)")
    names = [NAMES[c] for c in PLAIN_ITEMS]
    parts = []
    for n in range(len(levels) + 1):
        shown = ", ".join(c if i < n else "NULL" for i, c in enumerate(levels))
        up = "".join(f", {c}" for c in levels[: max(0, n - 1)])
        group = "".join(f", {c}" for c in levels[:n])
        values = ", ".join(f"CAST(SUM({x}) AS DOUBLE) / NULLIF(CAST(SUM(SUM({x})) OVER (PARTITION BY pn{up}) AS DOUBLE), 0)" for x in names)
        parts.append(f"SELECT MIN(period), {n}, {shown}, {values} FROM named GROUP BY pn{group}")
    columns = ", ".join(f"x{i}" for i in range(len(names)))
    return (
        f"{city}, named AS (SELECT p.*, {', '.join(f'd.{c}' for c in levels)} FROM plain p JOIN (SELECT DISTINCT {path}, "
        f"concat_ws('|', {path}) AS path FROM dim_store) d USING (path)), "
        f"shown(period, level, {path}, {columns}) AS ({' UNION ALL '.join(parts)})"
    )


_sql("calc_group_share_of_parent", _items_long("shown", "level, country, state, city", {c: f"x{i}" for i, c in enumerate(PLAIN_ITEMS)}),
     ctes=_share_items(("country", "state", "city"), "quarter"))
for _n, _by, _values, _period in (
    ("calc_group_high_risk_pct", "segment", f"SELECT segment, {SCORE_SQL['high_risk_pct']} AS v FROM scores GROUP BY segment", "year"),
    ("calc_group_retention", "months_since_first", f"""SELECT months_since_first,
      {_div("SUM(CAST(retention_pct AS DECIMAL(6,1)))", "COUNT(*)")} / 100 AS v FROM cohorts GROUP BY 1""", "fiscal_year"),
):
    _ctes = f"""constant AS (SELECT CAST({_period} AS VARCHAR) AS period, {_by}, v FROM
      (SELECT DISTINCT {_period} FROM dim_date) CROSS JOIN ({_values}))"""
    _sql(_n, _items_long("constant", _by, dict.fromkeys(PLAIN_ITEMS, "v")), True, ctes=_ctes)

# filter contexts
_sql("context_shares", f"""SELECT country, category, CAST(v AS DOUBLE) AS total_revenue,
    {_div('v', 'SUM(v) OVER (PARTITION BY country)')} AS share_of_beside, {_div('v', 'SUM(v) OVER ()')} AS share_of_selected,
    {_div('v', 'ever')} AS share_of_ever
  FROM (SELECT country, category, SUM(net_revenue) FILTER (WHERE NOT is_returned AND year = {YEAR}) AS v, {REV} AS ever
    FROM w WHERE country IN ('ASIA', 'EUROPE') GROUP BY country, category)""")
_here = f"FILTER (WHERE NOT is_returned AND year = {YEAR}"
_sql("context_counts", f"""SELECT country, city, orders, orders_online, orders_all_cities, customers, customers_ever,
    customers_here_and_before, CAST(online AS DOUBLE) / orders_online AS aov_online
  FROM (SELECT country, city, NULLIF(COUNT(DISTINCT order_id) {_here}), 0) AS orders,
      NULLIF(COUNT(DISTINCT order_id) {_here} AND channel = 'Online'), 0) AS orders_online,
      NULLIF(COUNT(DISTINCT customer_key) {_here}), 0) AS customers, {CUSTOMERS} AS customers_ever,
      NULLIF(COUNT(DISTINCT customer_key) FILTER (WHERE NOT is_returned AND year = {YEAR - 1}), 0) AS customers_here_and_before,
      SUM(net_revenue) {_here} AND channel = 'Online') AS online
    FROM w GROUP BY country, city)
  JOIN (SELECT country, NULLIF(COUNT(DISTINCT order_id) {_here}), 0) AS orders_all_cities FROM w GROUP BY country) USING (country)""")

# mergeable distinct counts
_sql("distinct_cube_year", f"SELECT category, year, {ORDERS} AS orders, {CUSTOMERS} AS active_customers FROM w GROUP BY category, year")
_sql("distinct_cube_country", f"""SELECT country, {ORDERS} AS orders, {CUSTOMERS} AS active_customers FROM w
  WHERE year = {YEAR} AND month <= 6 GROUP BY country""")
_sql("distinct_cube_trailing", f"""SELECT country, month, {ORDERS.replace('order_id', 'id')} AS orders, {CUSTOMERS.replace('customer_key', 'c')} AS active_customers
  FROM (SELECT p.country, (p.mi // 12) * 100 + p.mi % 12 + 1 AS month, w.order_id AS id, w.customer_key AS c, w.is_returned
    FROM (SELECT country, unnest(range(MIN(mi), (SELECT MAX(mi) FROM w) + 1)) AS mi FROM w GROUP BY country) p
    JOIN w ON w.country = p.country AND w.mi BETWEEN p.mi - 11 AND p.mi) GROUP BY country, month""")


# ranking
def _rank(column: str, dim: str, selected: str = "TRUE") -> str:
    """Members and sales within the selection; a member without sales ranks as 0."""
    return f"""SELECT {column}, CAST(v AS DOUBLE) AS revenue, DENSE_RANK() OVER (ORDER BY COALESCE(v, 0) DESC) AS rank
  FROM (SELECT DISTINCT {column} FROM {dim} WHERE {selected})
  LEFT JOIN (SELECT {column}, {REV} AS v FROM w WHERE year = {YEAR} AND {selected} GROUP BY 1) USING ({column})"""


_sql("category_rank", _rank("category", "dim_product"))
_sql("city_rank", _rank("city", "dim_store", f"country = '{COUNTRY}'"))
_sql("product_rank", _rank("sku", "dim_product"))
for _n, _top, _where in (("top_n_revenue", 3, f"year = {YEAR}"), ("top_n_revenue_default", 5, "TRUE")):
    _sql(_n, f"""SELECT category, rank, CAST(v AS DOUBLE) AS revenue,
      CASE WHEN rank <= {_top} THEN CAST(v AS DOUBLE) END AS top_n_revenue
      FROM (SELECT category, {REV} AS v, DENSE_RANK() OVER (ORDER BY {REV} DESC) AS rank FROM w WHERE {_where} GROUP BY 1)
      UNION ALL SELECT NULL, NULL, CAST({REV} AS DOUBLE), CAST({REV} AS DOUBLE) FROM w WHERE {_where}""")


def _share(levels: tuple, where: str) -> str:
    parts = []
    for n in range(len(levels) + 1):
        shown = ", ".join(c if i < n else f"CAST(NULL AS VARCHAR) AS {c}" for i, c in enumerate(levels))
        keys = ", ".join(levels[:n]) or "1"
        parent = ", ".join(levels[: n - 1]) if n > 1 else ""
        over = f"PARTITION BY {parent}" if parent else ""
        group = f"GROUP BY {keys}" if n else ""
        parts.append(
            f"SELECT {n} AS level, {shown}, CAST(v AS DOUBLE) AS total_revenue, "
            f"{_div('v', f'SUM(v) OVER ({over})')} AS share_of_parent "
            f"FROM (SELECT {keys if n else '1 AS one'}, {REV} AS v FROM w WHERE {where} {group})"
        )
    return " UNION ALL ".join(parts)


_sql("share_of_parent", _share(GEOGRAPHY, f"year = {YEAR}"))
_sql("rfm_scores", "SELECT customer_id, R, F, M FROM rfm", True)
_sql("rfm_segment", "SELECT customer_id, segment FROM rfm", True)
_sql("quantile_threshold", "SELECT ROUND(quantile_cont(churn_probability, 0.8), 8) AS threshold FROM scores", True)

# sorts and limits
_sql("top_category", f"""SELECT category, CAST({REV} AS DOUBLE) AS total_revenue FROM w WHERE year = {YEAR}
  GROUP BY 1 ORDER BY {REV} DESC, category LIMIT 1""")
RISKY = "SELECT customer_id, segment, churn_probability, recency_days, monetary FROM scores ORDER BY churn_probability DESC, customer_id"
_sql("highest_risk_customers", f"{RISKY} LIMIT 20", True)
_sql("rpt_highest_risk", RISKY, True)
_sql("revenue_by_category", f"SELECT category, CAST({REV} AS DOUBLE) AS total_revenue FROM w WHERE year = {YEAR} GROUP BY 1")
for _n in ("churn_by_segment", "rpt_segment_churn"):
    _sql(_n, f"SELECT segment, {SCORE_SQL['observed_churn_pct']} AS observed_churn_pct FROM scores GROUP BY 1", True)
_sql("sort_by_column", "SELECT month_name, month, COUNT(*) AS lines FROM w GROUP BY 1, 2 ORDER BY month")

# quality: on the star, and on a star damaged in known places
DAMAGED = f"""
bad_fact AS (SELECT * REPLACE (if(product_key % 50 = 0, -net_revenue, net_revenue) AS net_revenue) FROM w WHERE store_key <> 1),
bad_date AS (SELECT * FROM dim_date WHERE NOT (year = {YEAR} AND month = 1)),
bad_customer AS (SELECT * FROM dim_customer WHERE customer_key % 7 <> 0 UNION ALL SELECT * FROM dim_customer WHERE customer_key <= 3),
bad_store AS (SELECT * FROM dim_store WHERE store_key <> 2),
bad_product AS (SELECT * FROM dim_product WHERE product_key % 11 <> 0)""".strip()


def _without_partner(many: str, one: str, key: str) -> str:
    """Rows of the many side whose key lies in the set difference of the keys."""
    lost = f"SELECT {key} FROM {many} EXCEPT SELECT {key} FROM {one}"
    return f"(SELECT COUNT(*) FROM {many} SEMI JOIN ({lost}) USING ({key}))"


def _surplus(table: str, key: str) -> str:
    """Rows beyond the first of each key."""
    return f"(SELECT COALESCE(SUM(n - 1), 0)::BIGINT FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {key}))"


def _apart(left: str, right: str, value: str) -> str:
    """Difference of a sum over two tables, without its sign."""
    return f"(SELECT ABS(SUM(v))::BIGINT FROM (SELECT {value} AS v FROM {left} UNION ALL SELECT -({value}) FROM {right}))"


def _dq(fact: str, calendar: str, customer: str) -> dict[str, str]:
    # The names of the checks.
    found = {
        "dq_row_parity": ("fact rows = staging rows", _apart(fact, "stg", "1")),
        "dq_orphan_dates": ("orphan date keys", _without_partner(fact, calendar, "date_key")),
        "dq_duplicate_keys": ("duplicate customer keys", _surplus(customer, "customer_key")),
        "dq_negative_revenue": ("negative revenue", f"(SELECT COUNT(*) FROM {fact} WHERE net_revenue < 0)"),
        "dq_revenue_reconciles": ("revenue reconciles to staging (paise)", _apart(fact, "amounts", "net_revenue * 100")),
    }
    return {n: f"SELECT '{name}' AS check_name, {value} AS failures" for n, (name, value) in found.items()}


def _relationships(fact: str, dims: dict[str, str]) -> str:
    keys = (("fact_sales", fact, "dim_date", "date_key"), ("fact_sales", fact, "dim_customer", "customer_key"),
            ("fact_sales", fact, "dim_store", "store_key"), ("fact_sales", fact, "dim_product", "product_key"),
            ("customer_scores", "scores", "dim_customer", "customer_id"))
    rows = []
    for many, source, one, key in keys:
        name = f"SELECT '{many}.{key} -> {one}.{key}' AS relationship"
        rows.append(f"{name}, 'orphans' AS kind, {_without_partner(source, dims[one], key)} AS failures")
        rows.append(f"{name}, 'duplicates', {_surplus(dims[one], key)}")
    return " UNION ALL ".join(rows)


def _orphans(fact: str, dims: dict[str, str]) -> str:
    keys = {"dim_date": "date_key", "dim_customer": "customer_key", "dim_store": "store_key", "dim_product": "product_key"}
    return " UNION ALL ".join(
        f"SELECT 'orphan {k}' AS check_name, {_without_partner(fact, dims[t], k)} AS failures" for t, k in keys.items()
    )


for _suffix, _fact, _prefix, _more in (("", "w", "dim", ""), ("_damaged", "bad_fact", "bad", DAMAGED)):
    _dims = {f"dim_{t}": f"{_prefix}_{t}" for t in ("date", "customer", "store", "product")}
    _checks = _dq(_fact, _dims["dim_date"], _dims["dim_customer"])
    for _n, _body in _checks.items():
        _sql(_n + _suffix, _body, ctes=_more)
    _sql("quality_checks" + _suffix, " UNION ALL ".join(_checks.values()), ctes=_more)
    _sql("orphan_keys" + _suffix, _orphans(_fact, _dims), ctes=_more)
    _sql("relationship_contract" + _suffix, _relationships(_fact, _dims), True, ctes=_more)
ORACLES["dq_gate"] = ORACLES["quality_checks"]
_holes = [f"SELECT 'missing {c}', COUNT(*) - COUNT({c}) FROM w" for c in REQUIRED]
_keys = [f"SELECT 'duplicate {k}', {_surplus(t, k)}" for t, k in (("dim_date", "date_key"), ("dim_store", "store_key"), ("dim_product", "product_key"))]
_sql("quality_checks_observed", " UNION ALL ".join([*_dq("w", "dim_date", "dim_customer").values(),
     "SELECT 'empty fact', CAST(COUNT(*) = 0 AS BIGINT) FROM w", *_holes, *_keys]))
_sql("order_dedup", f"SELECT order_id, customer_id, {_s('order_date')}, channel FROM ord", True)


def _contract(damaged: bool = False) -> str:
    """Every declared column is found with values of its type; the damaged export has a renamed
    column and texts among its prices."""
    rows = []
    for table, schema in GOLD.items():
        for f in schema.fields:
            found, bad = "TRUE", "0"
            if damaged and (table, f.name) == ("dim_product", "brand"):
                found = "FALSE"
            if damaged and (table, f.name) == ("dim_product", "list_price"):
                bad = "(SELECT COUNT(*) FROM dim_product WHERE product_key % 20 = 0)"
            rows.append(f"SELECT '{table}' AS \"table\", '{f.name}' AS \"column\", TRUE AS declared, {found} AS found, {bad}::BIGINT AS bad_values")
    if damaged:
        rows.append("SELECT 'dim_product', 'label', FALSE, TRUE, 0")
    return f"SELECT *, declared AND found AND bad_values = 0 AS ok FROM ({' UNION ALL '.join(rows)})"


_sql("schema_contract", _contract())
_sql("schema_contract_damaged", _contract(True))

# security
_sql("rls_static", f"SELECT country, COUNT(*) AS lines FROM w WHERE country = '{COUNTRY}' GROUP BY country")
for _n, _user in (("rls_dynamic", "head"), ("rls_dynamic_one_country", "europe.manager"), ("rls_dynamic_unmapped", "nobody")):
    _sql(_n, f"""SELECT country, {MEASURE_SQL['total_revenue']} AS total_revenue, {ORDERS} AS orders FROM w
      WHERE country IN (SELECT country FROM ({TABLES['security_user_country']}) WHERE user_email = '{_user}') GROUP BY country""")
for _n, _where in (("rls_views", "country = 'EUROPE'"), ("rls_views_unmapped", "FALSE")):
    _sql(_n, f"""SELECT country, CAST(SUM(net_revenue) AS DOUBLE) AS total_revenue, COUNT(DISTINCT order_id) AS orders
      FROM w WHERE NOT is_returned AND {_where} GROUP BY country""")
_sql("rls_measure", "SELECT " + ", ".join(f"{MEASURE_SQL[n]} AS {n}" for n in
     ("total_revenue", "gross_margin_pct", "active_customers")) + f" FROM w WHERE country = '{COUNTRY}' AND year = {YEAR}")
_sql("rls_scores", "SELECT customer_id, churn_risk FROM scores WHERE customer_id IN (SELECT customer_id FROM w WHERE country = 'ASIA')", True)

# customer analytics
_sql("first_purchase", f"SELECT customer_id, {_s('cohort_month')}, cohort FROM first_purchase", True)
_sql("customer_features", f"""SELECT customer_id, recency_days, tenure_days, frequency, {_d('monetary')}, avg_order_value,
  avg_discount, online_share, n_categories, return_rate, orders_last_90d, is_corporate, orders_per_month,
  {_d('monetary_12m')} FROM feat""", True)
_sql("train_test_split", "SELECT customer_id, churned, is_test FROM split", True)
TERMS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(AVG(ABS((CAST({c} AS DOUBLE) - {m}::DOUBLE) * {w}::DOUBLE)), 8) AS importance "
    "FROM active SEMI JOIN (SELECT customer_id FROM split WHERE is_test) USING (customer_id)"
    for c, w, m in zip(*FORMULA_TERMS)
)
_sql("attribution_formula", TERMS, True)
_sql("top_drivers", f"SELECT * FROM ({TERMS}) ORDER BY importance DESC, feature LIMIT 3", True)


def _auc(by: str = "") -> str:
    key, over = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""SELECT {key}ROUND((SUM(rank_sum) - P * (P + 1) / 2.0) / (P * N), 8) AS roc_auc FROM (
      SELECT {key}SUM(mid) FILTER (WHERE y = 1) AS rank_sum, CAST(SUM(y) AS DOUBLE) AS P, CAST(COUNT(*) - SUM(y) AS DOUBLE) AS N
      FROM (SELECT {key}y, AVG(rn) OVER (PARTITION BY {key}s) AS mid FROM (SELECT {key}churned_h2_2025 AS y,
        churn_probability AS s, ROW_NUMBER() OVER ({over}ORDER BY churn_probability) AS rn FROM scores))
      {"GROUP BY " + by if by else ""}) GROUP BY {key}P, N"""


_sql("roc_auc", _auc(), True)
_sql("roc_auc_by_segment", _auc("segment"), True)
_sql("average_precision", """SELECT ROUND(SUM(CAST(pos AS DOUBLE) * pos_to / n_to) / SUM(pos), 8) AS average_precision
  FROM curve""", True)
_sql("lift_at_k", """SELECT COUNT(*) FILTER (WHERE top) AS top_customers, ROUND(MIN(t), 8) AS threshold,
  ROUND(AVG(y) FILTER (WHERE top), 8) AS top_rate, ROUND(AVG(y) FILTER (WHERE top) / AVG(y), 8) AS lift
  FROM (SELECT CAST(churned_h2_2025 AS DOUBLE) AS y, t, churn_probability >= t AS top FROM scores,
    (SELECT quantile_cont(churn_probability, 0.8) AS t FROM scores))""", True)
_sql("risk_band", "SELECT customer_id, churn_probability, churn_risk FROM scores", True)


# report datasets
def _cards(where: str) -> str:
    return f"""SELECT {FY} AS fiscal_year, CAST(cur AS DOUBLE) AS total_revenue, orders, {_div('cur', 'orders')} AS avg_order_value,
      CASE WHEN py IS NOT NULL THEN CAST(COALESCE(cur, 0) - py AS DOUBLE) / CAST(py AS DOUBLE) END AS yoy_pct
      FROM (SELECT SUM(net_revenue) FILTER (WHERE NOT is_returned AND fiscal_year = {FY}) AS cur,
        NULLIF(COUNT(DISTINCT order_id) FILTER (WHERE NOT is_returned AND fiscal_year = {FY}), 0) AS orders,
        SUM(net_revenue) FILTER (WHERE NOT is_returned AND fiscal_year = {FY - 1}) AS py FROM w WHERE {where})"""


_sql("rpt_overview_kpis", _cards("TRUE"))
_sql("rpt_overview_kpis_user", _cards("country IN ('ASIA', 'EUROPE')"))
_sql("rpt_fy_choices", "SELECT DISTINCT fiscal_year FROM dim_date")
_sql("rpt_monthly_trend", f"""SELECT c.year_month, CAST(a.v AS DOUBLE) AS revenue, CAST(b.v AS DOUBLE) AS revenue_py
  FROM (SELECT DISTINCT year_month, year * 12 + month - 1 AS mi FROM dim_date WHERE fiscal_year = {FY}) c
  LEFT JOIN (SELECT mi, {REV} AS v FROM w GROUP BY 1) a ON a.mi = c.mi
  LEFT JOIN (SELECT mi, {REV} AS v FROM w GROUP BY 1) b ON b.mi = c.mi - 12
  WHERE a.v IS NOT NULL OR b.v IS NOT NULL""")
_sql("rpt_geo_matrix", _share(("country", "state", "city"), f"fiscal_year = {FY}"))
_sql("rpt_channel_mix", f"SELECT channel, CAST({REV} AS DOUBLE) AS total_revenue FROM w WHERE fiscal_year = {FY} GROUP BY 1")
_sql("rpt_category", f"SELECT category, CAST({REV} AS DOUBLE) AS total_revenue FROM w WHERE fiscal_year = {FY} GROUP BY 1")
_sql("rpt_churn_kpis", "SELECT " + ", ".join(f"{SCORE_SQL[n]} AS {n}" for n in
     ("customers_scored", "high_risk_pct", "revenue_at_risk", "observed_churn_pct")) + " FROM scores", True)
_sql("rpt_risk_bands", """SELECT churn_risk, CASE churn_risk WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS risk_order,
  COUNT(*) AS customers_scored FROM scores GROUP BY 1""", True)
_sql("rpt_cohort_matrix", "SELECT cohort, " + ", ".join(
    f"MAX(retention_pct) FILTER (WHERE months_since_first = {i}) / 100 AS m{i}" for i in range(13))
    + " FROM cohorts GROUP BY cohort", True)
