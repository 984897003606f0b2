"""SQL with the results of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from tillworks import schemas
from tillworks.functions import rules
from tillworks.plans.registry import AS_OF, EVENTS_NOW

# --- shared fragments -------------------------------------------------------

_JOINED = """
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey"""

_INVOICE = "CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(o_orderkey AS VARCHAR)"
_QUANTITY = "CAST((CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) * l_quantity AS INT)"
_CUSTOMER = "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) || '.0' END"

_BRONZE = f"""bronze AS (
SELECT {_INVOICE} AS invoiceno,
       p_type || '-' || p_brand AS stockcode,
       p_name AS description,
       {_QUANTITY} AS quantity,
       CAST(o_orderdate AS TIMESTAMP) AS invoicedate,
       CAST(p_size * 0.25 AS DECIMAL(10,2)) AS unitprice,
       {_CUSTOMER} AS customerid,
       n_name AS country{_JOINED})"""

_DIM_DATE = """dim_date AS (
SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS BIGINT) AS date_id,
       date, day(date) AS day, strftime(date, '%A') AS day_name,
       extract('dow' FROM date) AS day_of_week, month(date) AS month,
       strftime(date, '%B') AS month_name, quarter(date) AS quarter, year(date) AS year,
       extract('dow' FROM date) IN (0, 6) AS is_weekend, FALSE AS is_holiday
FROM (SELECT DISTINCT CAST(invoicedate AS DATE) AS date FROM bronze WHERE invoicedate IS NOT NULL))"""


def _category(code: str) -> str:
    whens = " ".join(
        f"WHEN starts_with({code}, '{p}') THEN '{label}'" for p, label in rules.CATEGORY_BY_PREFIX
    )
    return f"CASE {whens} ELSE '{rules.DEFAULT_CATEGORY}' END"


_DIM_PRODUCT = f"""dim_product AS (
SELECT row_number() OVER (ORDER BY stockcode) AS product_id, stockcode AS stock_code,
       min(description) AS description, {_category('stockcode')} AS category
FROM bronze WHERE stockcode IS NOT NULL AND description IS NOT NULL GROUP BY stockcode)"""

_CUSTOMER_ID = "coalesce(TRY_CAST(nullif(split_part(customerid, '.', 1), '') AS BIGINT), -1)"

_FACT = f"""fact AS (
SELECT date_id, product_id, country, max({_CUSTOMER_ID}) AS customer_id,
       count(DISTINCT invoiceno) AS total_transactions, sum(quantity) AS total_quantity,
       CAST(sum(quantity * unitprice) AS DECIMAL(15,2)) AS total_revenue,
       CAST(round(CAST(sum(unitprice) AS DOUBLE) / count(unitprice), 6) AS DECIMAL(14,6)) AS avg_unit_price,
       any_value(dim_date.year) AS year, any_value(dim_date.month) AS month
FROM bronze JOIN dim_date ON CAST(invoicedate AS DATE) = date
            JOIN dim_product ON stockcode = stock_code
WHERE quantity > 0 AND unitprice >= 0 AND country IS NOT NULL
GROUP BY date_id, product_id, country)"""

_SILVER = ",\n".join([_BRONZE, _DIM_DATE, _DIM_PRODUCT, _FACT])


def _n(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def _m(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def _d(expr: str, name: str) -> str:
    return f"CAST({expr} AS VARCHAR) AS {name}"


def _t(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}"


def _quotient(a: str, b: str, places: int) -> str:
    """a / b in doubles, rounded as a decimal; NULL when b is 0."""
    return (
        f"CAST(round(CAST(CAST({a} AS DOUBLE) / CAST(nullif({b}, 0) AS DOUBLE) "
        f"AS DECIMAL(28,10)), {places}) AS DOUBLE)"
    )


def _safe(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {_quotient(a, b, 2)} ELSE 0.0::DOUBLE END"


_SUMS = ", ".join(
    [_m("sum(total_revenue)", "total_revenue"), _n("sum(total_quantity)", "total_quantity"),
     _n("sum(total_transactions)", "total_transactions")]
)
_PER_TX = ", ".join(
    [_safe("sum(total_revenue)", "sum(total_transactions)") + " AS avg_revenue_per_transaction",
     _safe("sum(total_quantity)", "sum(total_transactions)") + " AS avg_quantity_per_transaction"]
)
_KNOWN = _n("count(DISTINCT nullif(customer_id, -1))", "unique_customers")
_ALL_CUSTOMERS = _n("count(DISTINCT customer_id)", "unique_customers")
_PRODUCTS = _n("count(DISTINCT product_id)", "total_products")
_COUNTRIES = _n("count(DISTINCT country)", "total_countries")
_MEAN_PRICE = _quotient("sum(avg_unit_price)", "count(avg_unit_price)", 2) + " AS avg_unit_price"


def _labels(pairs, test: str, otherwise: str) -> str:
    whens = " ".join(f"WHEN {test.format(limit)} THEN '{label}'" for limit, label in pairs)
    return f"CASE {whens} ELSE '{otherwise}' END"


# --- gold relations ---------------------------------------------------------


def _monthly(customers: str = _KNOWN) -> str:
    return f"""SELECT {_n('d.year', 'year')}, {_n('d.month', 'month')}, {_SUMS}, {_PRODUCTS},
       {_COUNTRIES}, {_PER_TX}, {customers},
       CAST(0 AS BIGINT) AS cancelled_transactions, CAST(0 AS DOUBLE) AS cancelled_revenue
FROM fact f JOIN dim_date d USING (date_id) GROUP BY d.year, d.month"""


_PRODUCT_PERFORMANCE = f"""SELECT {_n('p.product_id', 'product_id')}, stock_code, description, category,
       {_SUMS}, {_n('count(DISTINCT date_id)', 'total_days_sold')}, {_COUNTRIES},
       {_safe('sum(total_revenue)', 'count(DISTINCT date_id)')} AS avg_revenue_per_day,
       {_safe('sum(total_quantity)', 'count(DISTINCT date_id)')} AS avg_quantity_per_day,
       {_PER_TX}, {_d('min(date)', 'first_sale_date')}, {_d('max(date)', 'last_sale_date')}
FROM fact JOIN dim_product p USING (product_id) JOIN dim_date d USING (date_id)
GROUP BY p.product_id, stock_code, description, category"""

_TOP_PRODUCT = f"""SELECT country, {_n('product_id', 'top_product_id')}, {_m('revenue', 'top_product_revenue')}
FROM (SELECT country, product_id, sum(total_revenue) AS revenue,
             row_number() OVER (PARTITION BY country ORDER BY sum(total_revenue) DESC, product_id) AS place
      FROM fact GROUP BY country, product_id) WHERE place = 1"""


def _country_sales(customers: str = _KNOWN) -> str:
    return f"""SELECT s.*, top_product_id, top_product_revenue FROM (
SELECT country, {_SUMS}, {_PRODUCTS}, {_n('count(DISTINCT date_id)', 'total_days_active')},
       {customers}, {_PER_TX}, {_d('min(date)', 'first_transaction_date')},
       {_d('max(date)', 'last_transaction_date')}
FROM fact JOIN dim_date USING (date_id) GROUP BY country) s
JOIN ({_TOP_PRODUCT}) t USING (country)"""


_DAILY = f"""SELECT {_n('date_id', 'date_id')}, {_d('date', 'date')}, {_n('d.year', 'year')},
       {_n('d.month', 'month')}, {_n('day_of_week', 'day_of_week')}, {_n('day', 'day_of_month')},
       {_n('quarter', 'quarter')}, {_n('weekofyear(date)', 'week_of_year')}, is_weekend,
       {_SUMS}, {_PRODUCTS}, {_COUNTRIES}, {_KNOWN}, {_PER_TX}
FROM fact f JOIN dim_date d USING (date_id)
GROUP BY date_id, date, d.year, d.month, day_of_week, day, quarter, is_weekend"""


def _trend() -> str:
    cols = []
    for m in ["revenue", "quantity", "transactions"]:
        now, prev = f"total_{m}", f"lag(total_{m}) OVER (ORDER BY date)"
        kind = "DOUBLE" if m == "revenue" else "BIGINT"
        change = f"(CAST({now} AS DECIMAL(18,2)) - CAST({prev} AS DECIMAL(18,2)))"
        cols.append(f"CAST({change} AS {kind}) AS {m}_vs_previous_day")
        cols.append(
            f"CASE WHEN {prev} > 0 THEN {_quotient(f'{change} * 100', prev, 2)} END "
            f"AS {m}_vs_previous_day_pct"
        )
    return f"SELECT *, {', '.join(cols)} FROM ({_DAILY})"


_MONTHLY_SUMMARY = f"""SELECT {_n('d.year', 'year')}, {_n('d.month', 'month')}, month_name,
       {_n('count(DISTINCT product_id)', 'unique_products')},
       {_n('count(DISTINCT country)', 'unique_countries')}, {_SUMS}, {_MEAN_PRICE}
FROM fact f JOIN dim_date d USING (date_id) GROUP BY d.year, d.month, month_name"""

_TOP_PRODUCTS = f"""SELECT stock_code, description, category, {_SUMS},
       {_n('count(DISTINCT date_id)', 'days_sold')},
       {_n('count(DISTINCT country)', 'countries_sold_in')},
       {_quotient('sum(total_revenue)', 'sum(total_quantity)', 2)} AS avg_revenue_per_unit
FROM fact JOIN dim_product USING (product_id) GROUP BY stock_code, description, category
ORDER BY sum(fact.total_revenue) DESC, stock_code LIMIT 100"""

_COUNTRY_PERFORMANCE = f"""SELECT country, {_n('count(DISTINCT date_id)', 'active_days')},
       {_n('count(DISTINCT product_id)', 'unique_products')}, {_SUMS}, {_MEAN_PRICE},
       {_quotient('sum(total_revenue)', 'count(DISTINCT date_id)', 2)} AS avg_daily_revenue,
       {_d('min(date)', 'first_sale_date')}, {_d('max(date)', 'last_sale_date')}
FROM fact JOIN dim_date USING (date_id) GROUP BY country"""

_PRIMARY = """SELECT customer_id, country AS primary_country FROM (
SELECT customer_id, country, row_number() OVER (
         PARTITION BY customer_id ORDER BY sum(total_revenue) DESC, country) AS place
FROM fact WHERE customer_id <> -1 GROUP BY customer_id, country) WHERE place = 1"""

_DAYS_SINCE = f"date_diff('day', {{}}, DATE '{AS_OF}')"

_CLV = f"""SELECT {_n('customer_id', 'customer_id')}, primary_country AS country,
       {_n('buying_days', 'total_purchase_days')}, {_n('pairs', 'total_product_purchases')},
       {_n('orders', 'total_orders')}, {_n('items', 'total_items_purchased')},
       {_m('spend', 'total_lifetime_value')},
       {_quotient('spend', 'fact_rows', 6)} AS avg_daily_revenue,
       CASE WHEN orders > 0 THEN {_quotient('spend', 'orders', 6)} ELSE 0.0::DOUBLE END AS avg_order_value,
       {_m('largest', 'max_daily_revenue')}, {_n('products', 'unique_products_purchased')},
       {_n('categories', 'unique_categories_purchased')}, {_d('first_day', 'first_purchase_date')},
       {_d('last_day', 'last_purchase_date')}, {_n('lifespan', 'customer_lifespan_days')},
       CASE WHEN lifespan > 0 THEN {_quotient('buying_days', 'lifespan', 6)} ELSE 0.0::DOUBLE END
         AS purchase_frequency,
       {_labels(rules.SEGMENT_FLOORS, 'spend >= {}', rules.LOWEST_SEGMENT)} AS customer_segment,
       {_labels(rules.CUSTOMER_RECENCY_CEILINGS, _DAYS_SINCE.format('last_day') + ' <= {}',
                rules.CUSTOMER_RECENCY_BEYOND)} AS recency_category
FROM (SELECT customer_id, count(DISTINCT date_id) AS buying_days,
             count(DISTINCT date_id * 1000000000 + product_id) AS pairs,
             sum(total_transactions) AS orders, sum(total_quantity) AS items,
             sum(total_revenue) AS spend, count(*) AS fact_rows, max(total_revenue) AS largest,
             min(date) AS first_day, max(date) AS last_day,
             date_diff('day', min(date), max(date)) AS lifespan,
             count(DISTINCT product_id) AS products, count(DISTINCT category) AS categories
      FROM fact JOIN dim_date USING (date_id) JOIN dim_product USING (product_id)
      WHERE customer_id <> -1 GROUP BY customer_id)
JOIN ({_PRIMARY}) USING (customer_id)"""

_ACTIVITY = f"""SELECT {_n('customer_id', 'customer_id')}, country, {_n('year', 'year')}, {_n('month', 'month')},
       {_n('buying_days', 'purchase_days_in_month')}, {_n('products', 'unique_products')},
       {_n('orders', 'monthly_orders')}, {_n('items', 'monthly_items')}, {_m('spend', 'monthly_revenue')},
       {_quotient('spend', 'fact_rows', 6)} AS avg_daily_revenue,
       CASE WHEN orders > 0 THEN {_quotient('spend', 'orders', 6)} ELSE 0.0::DOUBLE END AS avg_order_value,
       {_m('largest', 'max_daily_revenue')}, {_m('prev', 'prev_month_revenue')},
       CASE WHEN prev > 0 THEN {_quotient('(spend - prev) * 100', 'prev', 6)} END AS revenue_growth_pct,
       tenure = 1 AS is_first_month, {_n('tenure', 'customer_tenure_months')},
       {_labels(rules.SPENDING_FLOORS, 'spend >= {}', rules.LOWEST_SPENDING)} AS spending_level,
       {_d('first_day', 'first_purchase_in_month')}, {_d('last_day', 'last_purchase_in_month')}
FROM (SELECT *, lag(spend) OVER w AS prev, row_number() OVER w AS tenure
      FROM (SELECT customer_id, country, d.year, d.month, count(DISTINCT date_id) AS buying_days,
                   count(DISTINCT product_id) AS products, sum(total_transactions) AS orders,
                   sum(total_quantity) AS items, sum(total_revenue) AS spend, count(*) AS fact_rows,
                   max(total_revenue) AS largest, min(date) AS first_day, max(date) AS last_day
            FROM fact f JOIN dim_date d USING (date_id) WHERE customer_id <> -1
            GROUP BY customer_id, country, d.year, d.month)
      WINDOW w AS (PARTITION BY customer_id ORDER BY year, month, country))"""

_SHARE = _quotient("spend * 100", "all_spend", 6)
_AFFINITY = f"""SELECT {_n('customer_id', 'customer_id')}, {_n('product_id', 'product_id')}, stock_code,
       description, category, {_n('buying_days', 'times_purchased')}, {_n('orders', 'total_orders')},
       {_n('items', 'total_quantity_bought')}, {_m('spend', 'total_product_revenue')},
       {_quotient('spend', 'fact_rows', 6)} AS avg_purchase_value, {_m('largest', 'max_purchase_value')},
       {_SHARE} AS pct_of_customer_spend, {_n('by_spend', 'product_rank_by_revenue')},
       {_n('by_days', 'product_rank_by_frequency')},
       CASE WHEN span > 0 THEN {_quotient('buying_days', 'span + 1', 6)}
            ELSE CAST(buying_days AS DOUBLE) END AS purchase_frequency,
       CASE WHEN by_spend <= {rules.AFFINITY_TOP3_RANK} THEN '{rules.AFFINITY_TOP3}'
            WHEN by_spend <= {rules.AFFINITY_TOP10_RANK} THEN '{rules.AFFINITY_TOP10}'
            WHEN spend * 100 >= all_spend * {rules.AFFINITY_MAJOR_SHARE_PCT} THEN '{rules.AFFINITY_MAJOR}'
            WHEN buying_days >= {rules.AFFINITY_FREQUENT_TIMES} THEN '{rules.AFFINITY_FREQUENT}'
            ELSE '{rules.AFFINITY_OTHER}' END AS affinity_level,
       {_d('first_day', 'first_purchased_date')}, {_d('last_day', 'last_purchased_date')},
       {_n('span', 'days_buying_this_product')},
       {_labels(rules.PRODUCT_RECENCY_CEILINGS, _DAYS_SINCE.format('last_day') + ' <= {}',
                rules.PRODUCT_RECENCY_BEYOND)} AS recency_category
FROM (SELECT *, sum(spend) OVER (PARTITION BY customer_id) AS all_spend,
             row_number() OVER (PARTITION BY customer_id ORDER BY spend DESC, product_id) AS by_spend,
             row_number() OVER (PARTITION BY customer_id ORDER BY buying_days DESC, product_id) AS by_days
      FROM (SELECT customer_id, product_id, stock_code, description, category,
                   count(DISTINCT date_id) AS buying_days, sum(total_transactions) AS orders,
                   sum(total_quantity) AS items, sum(total_revenue) AS spend, count(*) AS fact_rows,
                   max(total_revenue) AS largest, min(date) AS first_day, max(date) AS last_day,
                   date_diff('day', min(date), max(date)) AS span
            FROM fact JOIN dim_product USING (product_id) JOIN dim_date USING (date_id)
            WHERE customer_id <> -1
            GROUP BY customer_id, product_id, stock_code, description, category))"""

# --- raw lines and events ---------------------------------------------------

_PRICE = "(l_extendedprice - 2000)"

# prices of which most lie within the limits
_NEAR_PRICE = "((l_extendedprice - 2000 + 2000) % 10050 - 25)"

_CLEAN_STRICT = f"""strict AS (
SELECT {_INVOICE} AS invoiceno, p_type || '-' || p_brand AS stockcode,
       CASE WHEN l_discount <> 0.0 THEN p_name ELSE '{rules.STRICT_DESCRIPTION}' END AS description,
       CAST(CASE WHEN l_discount <> 0.05 THEN {_QUANTITY} ELSE 0 END AS BIGINT) AS quantity,
       {_t('o_orderdate', 'invoicedate')},
       CAST(CAST(CASE WHEN l_discount <> 0.1 THEN {_PRICE} ELSE 0 END AS DECIMAL(10,2)) AS DOUBLE) AS unitprice,
       {_CUSTOMER} AS customerid, n_name AS country{_JOINED}
WHERE l_tax <> 0.01 AND l_tax <> 0.08
  AND CASE WHEN l_discount <> 0.1 THEN {_PRICE} ELSE 0 END BETWEEN {rules.MIN_PRICE} AND {rules.MAX_PRICE})"""

_CLEAN_LENIENT = f"""SELECT {_INVOICE} AS invoiceno, p_type || '-' || p_brand AS stockcode,
       CASE WHEN l_discount <> 0.0 THEN p_name ELSE '{rules.LENIENT_DESCRIPTION}' END AS description,
       CAST({_QUANTITY} AS BIGINT) AS quantity, {_t('o_orderdate', 'invoicedate')},
       CAST(CAST({_PRICE} AS DECIMAL(10,2)) AS DOUBLE) AS unitprice,
       coalesce({_CUSTOMER}, '') AS customerid, n_name AS country{_JOINED}
WHERE {_PRICE} >= {rules.MIN_PRICE}"""

_LEDGER = f"""ledger AS (
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month_key,
       CASE month(o_orderdate) % 3 WHEN 1 THEN '{rules.COMPLETED}' ELSE '{rules.IN_PROGRESS}' END AS status,
       year(o_orderdate) AS year, month(o_orderdate) AS month
FROM orders WHERE month(o_orderdate) % 3 <> 0)"""

_MONTHS = """months AS (
SELECT DISTINCT d.year, d.month, strftime(date, '%Y-%m') AS month_key
FROM fact f JOIN dim_date d USING (date_id))"""

_EVENT_LEDGER = f"""event_ledger AS (
SELECT strftime(ts, '%Y-%m') || '-' || CAST(event_id AS VARCHAR) AS month_key,
       CAST(CASE WHEN value >= 1.0 THEN year(ts) END AS BIGINT) AS year,
       CAST(month(ts) AS BIGINT) AS month,
       CASE event_type WHEN 'click' THEN 'invalid_status_corrupted' WHEN 'view' THEN '{rules.IN_PROGRESS}'
            WHEN 'signup' THEN '{rules.FAILED}' ELSE '{rules.COMPLETED}' END AS status,
       CASE event_type WHEN 'error' THEN left(props, length(props) - 1) WHEN 'signup' THEN NULL
            ELSE props END AS metadata
FROM events)"""

_BAD_METADATA = "coalesce(NOT json_valid(metadata), FALSE)"
_BAD_STATUS = (
    "status NOT IN (" + ", ".join(f"'{s}'" for s in rules.LEDGER_STATUSES) + ")"
)


# --- quality ----------------------------------------------------------------


def _check(name: str, failing: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, CAST({failing} AS BIGINT) AS failing_rows, "
        f"({failing}) = 0 AS passed FROM {source}"
    )


def _nulls(table: str, source: str, cols: list[str]) -> list[str]:
    return [
        _check(f"{table}.not_null:{c}", f"count(*) FILTER ({c} IS NULL)", source) for c in cols
    ]


def _dups(table: str, source: str, cols: list[str]) -> str:
    keys = ", ".join(cols)
    return _check(
        f"{table}.unique:{','.join(cols)}", "count(*)",
        f"(SELECT 1 FROM {source} GROUP BY {keys} HAVING count(*) > 1)",
    )


def _suite() -> str:
    b, d, p, f = "raw_transactions", "dim_date", "dim_product", "fact_sales_daily"
    rows = "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"
    out = _nulls(b, "bronze", ["invoiceno", "stockcode", "invoicedate"])
    out.append(_check(f"{b}.has_rows", rows, "bronze"))
    out.append(
        _check(f"{b}.in_range:unitprice", "count(*) FILTER (unitprice < 0 OR unitprice > 10000)", "bronze")
    )
    out += [
        _check(f"{b}.distinct_present:{c}", f"CASE WHEN count(DISTINCT {c}) > 0 THEN 0 ELSE 1 END", "bronze")
        for c in ["invoiceno", "stockcode", "country"]
    ]
    out.append(
        _check(f"{b}.date_bounds:invoicedate",
               "CASE WHEN min(invoicedate) <= max(invoicedate) THEN 0 ELSE 1 END", "bronze")
    )
    out.append(
        _check(f"{b}.customer_parses:customerid",
               "count(*) FILTER (customerid IS NOT NULL AND TRY_CAST(customerid AS DOUBLE) IS NULL)", "bronze")
    )
    out += [
        _check(f"{b}.max_length:{c}", f"count(*) FILTER (length({c}) > {n})", "bronze")
        for c, n in schemas.BRONZE_TEXT_LIMITS.items()
    ]
    out += _nulls(d, "dim_date", ["date_id", "date", "is_weekend"])
    out += [_check(f"{d}.has_rows", rows, "dim_date"), _dups(d, "dim_date", ["date_id"]),
            _dups(d, "dim_date", ["date"])]
    out += _nulls(p, "dim_product", ["product_id", "stock_code", "category"])
    out += [_check(f"{p}.has_rows", rows, "dim_product"), _dups(p, "dim_product", ["product_id"]),
            _dups(p, "dim_product", ["stock_code"])]
    out += _nulls(f, "fact", ["date_id", "product_id", "total_revenue", "total_quantity"])
    out += [
        _check(f"{f}.in_range:{c}", f"count(*) FILTER ({c} < 0)", "fact")
        for c in ["total_revenue", "total_quantity", "total_transactions"]
    ]
    out += [
        _check(f"{f}.has_rows", rows, "fact"),
        _check(f"{f}.positive_total:total_revenue",
               "CASE WHEN sum(total_revenue) > 0 THEN 0 ELSE 1 END", "fact"),
        _check(f"{f}.relationships:date_id", "count(*)", "fact ANTI JOIN dim_date USING (date_id)"),
        _check(f"{f}.relationships:product_id", "count(*)", "fact ANTI JOIN dim_product USING (product_id)"),
        _dups(f, "fact", ["date_id", "product_id", "country"]),
    ]
    marts = {
        "monthly_sales_summary": ["year", "month", "total_revenue"],
        "top_products_by_revenue": ["stock_code", "total_revenue"],
        "country_performance": ["country", "total_revenue"],
        "customer_lifetime_value": ["customer_id", "country", "total_lifetime_value", "total_orders",
                                    "customer_segment", "recency_category"],
        "customer_monthly_activity": ["customer_id", "year", "month", "monthly_revenue",
                                      "monthly_orders", "customer_tenure_months"],
        "customer_product_affinity": ["customer_id", "product_id", "stock_code",
                                      "total_product_revenue", "times_purchased", "affinity_level"],
    }
    for mart, cols in marts.items():
        out += _nulls(mart, mart, cols)
    out += [
        f"SELECT '{t}.columns_match' AS check_name, CAST(0 AS BIGINT) AS failing_rows, TRUE AS passed"
        for t in [b, d, p, f]
    ]
    segments = ", ".join(f"'{s}'" for s in rules.SEGMENTS)
    out.append(
        _check("customer_lifetime_value.accepted_values:customer_segment",
               f"count(*) FILTER (customer_segment NOT IN ({segments}))", "customer_lifetime_value")
    )
    out.append(_dups("country_performance", "country_performance", ["country"]))
    out.append(_dups("customer_lifetime_value", "customer_lifetime_value", ["customer_id"]))
    return "\nUNION ALL ".join(out)


def _failures() -> str:
    raw = f"""(SELECT CASE WHEN l_tax <> 0.01 THEN {_INVOICE} END AS invoiceno,
        p_type || '-' || p_brand AS stockcode, CASE WHEN l_discount <> 0.0 THEN p_name END AS description,
        CASE WHEN l_discount <> 0.1 THEN {_PRICE} END AS unitprice, {_CUSTOMER} AS customerid {_JOINED})"""
    out = _nulls("raw", "raw_lines", ["invoiceno", "description", "customerid"])
    out += [
        _check("raw.in_range:unitprice", "count(*) FILTER (unitprice < 0 OR unitprice > 10000)", "raw_lines"),
        _check("raw.max_length:stockcode", "count(*) FILTER (length(stockcode) > 12)", "raw_lines"),
        _check("raw.customer_parses:customerid",
               "count(*) FILTER (customerid IS NOT NULL AND TRY_CAST(customerid AS DOUBLE) IS NULL)", "raw_lines"),
        _check("events.accepted_values:event_type", "count(*) FILTER (event_type NOT IN ('view', 'click'))", "events"),
        _check("events.has_rows", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", "events"),
        _check("events.positive_total:value", "CASE WHEN sum(value) > 0 THEN 0 ELSE 1 END", "events"),
        _check("events.date_bounds:ts", "CASE WHEN min(ts) <= max(ts) THEN 0 ELSE 1 END", "events"),
        _dups("events", "events", ["user_id", "event_type"]),
        _check("events.relationships:user_id", "count(*)", "events ANTI JOIN supplier ON user_id = s_suppkey"),
        "SELECT 'raw.columns_match' AS check_name, CAST(1 AS BIGINT) AS failing_rows, FALSE AS passed",
    ]
    return f"WITH raw_lines AS {raw}\n" + "\nUNION ALL ".join(out)


_SUITE_CTES = ",\n".join(
    [_SILVER]
    + [
        f"{name} AS ({body})"
        for name, body in {
            "monthly_sales_summary": _MONTHLY_SUMMARY,
            "top_products_by_revenue": _TOP_PRODUCTS,
            "country_performance": _COUNTRY_PERFORMANCE,
            "customer_lifetime_value": _CLV,
            "customer_monthly_activity": _ACTIVITY,
            "customer_product_affinity": _AFFINITY,
        }.items()
    ]
)


# --- the queries ------------------------------------------------------------


def oracle_sql() -> dict[str, str]:
    def bronze(sql: str) -> str:
        return f"WITH {_BRONZE}\n{sql}"

    def silver(sql: str, *extra: str) -> str:
        return f"WITH {', '.join([_SILVER, *extra])}\n{sql}"

    revenue = "sum(quantity * unitprice)"
    fact_cols = (
        "CAST(date_id AS BIGINT) AS date_id, CAST(product_id AS BIGINT) AS product_id, {country} AS country, "
        "CAST(customer_id AS BIGINT) AS customer_id, CAST(total_transactions AS BIGINT) AS total_transactions, "
        "CAST({quantity} AS BIGINT) AS total_quantity, CAST(total_revenue AS DOUBLE) AS total_revenue, "
        "CAST(avg_unit_price AS DOUBLE) AS avg_unit_price, "
        "CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month"
    )
    fact_all = fact_cols.format(country="country", quantity="total_quantity")
    product_cols = _n("product_id", "product_id") + ", stock_code, description, category"
    out: dict[str, str] = {}

    out["clean_strict"] = f"WITH {_CLEAN_STRICT} SELECT * FROM strict"
    out["clean_lenient"] = _CLEAN_LENIENT
    out["clean_report"] = f"""SELECT count(*) AS read_rows, count(*) FILTER (fate = 1) AS missing_key_rows,
       count(*) FILTER (fate = 2) AS unreadable_date_rows, count(*) FILTER (fate = 3) AS invalid_price_rows,
       count(*) FILTER (fate = 4) AS kept_rows
FROM (SELECT CASE WHEN l_tax = 0.01 THEN 1 WHEN l_tax = 0.08 THEN 2
             WHEN CASE WHEN l_discount <> 0.1 THEN {_PRICE} ELSE 0 END
                  NOT BETWEEN {rules.MIN_PRICE} AND {rules.MAX_PRICE} THEN 3 ELSE 4 END AS fate{_JOINED})"""
    out["ingest_check"] = f"""WITH {_CLEAN_STRICT}, n AS (
SELECT (SELECT count(*) FROM lineitem) AS expected_rows, (SELECT count(*) FROM strict) AS actual_rows)
SELECT expected_rows, actual_rows, expected_rows - actual_rows AS missing_rows,
       actual_rows >= expected_rows * {rules.INGEST_TOLERANCE} AS passed FROM n"""
    out["bronze_summary"] = bronze(
        f"""SELECT count(*) AS total_records, count(DISTINCT invoiceno) AS unique_invoices,
       count(DISTINCT stockcode) AS unique_products, count(DISTINCT customerid) AS unique_customers,
       count(DISTINCT country) AS unique_countries, {_t('min(invoicedate)', 'first_transaction')},
       {_t('max(invoicedate)', 'last_transaction')},
       {_m('sum(quantity * unitprice) FILTER (quantity > 0)', 'total_revenue')} FROM bronze"""
    )
    out["bronze_revenue_by_country"] = bronze(
        f"""SELECT country, count(*) AS transaction_count, {_m(revenue, 'total_revenue')}
FROM bronze WHERE quantity > 0 GROUP BY country ORDER BY total_revenue DESC, country LIMIT 10"""
    )
    out["bronze_top_products"] = bronze(
        f"""SELECT stockcode, description, count(*) AS transaction_count,
       {_n('sum(quantity)', 'total_quantity')}, {_m(revenue, 'total_revenue')}
FROM bronze WHERE quantity > 0 GROUP BY stockcode, description
ORDER BY total_revenue DESC, stockcode, description LIMIT 10"""
    )
    out["bronze_daily_volume"] = bronze(
        f"""SELECT {_d('CAST(invoicedate AS DATE)', 'transaction_date')}, count(*) AS transaction_count,
       {_m(revenue, 'daily_revenue')} FROM bronze GROUP BY CAST(invoicedate AS DATE)"""
    )
    out["bronze_customer_analysis"] = bronze(
        f"""SELECT customerid, count(DISTINCT invoiceno) AS invoice_count, {_m(revenue, 'total_spent')},
       {_t('min(invoicedate)', 'first_purchase')}, {_t('max(invoicedate)', 'last_purchase')}
FROM bronze WHERE customerid IS NOT NULL GROUP BY customerid ORDER BY total_spent DESC, customerid LIMIT 10"""
    )
    out["cancellations_by_month"] = bronze(
        f"""SELECT year(invoicedate) AS year, month(invoicedate) AS month,
       count(DISTINCT invoiceno) AS cancelled_transactions, {_m(revenue, 'cancelled_revenue')}
FROM bronze WHERE quantity < 0 OR upper(invoiceno) LIKE 'C%' GROUP BY 1, 2"""
    )

    out["dim_date"] = f"""WITH {_BRONZE}, {_DIM_DATE}
SELECT date_id, {_d('date', 'date')}, {_n('day', 'day')}, day_name, {_n('day_of_week', 'day_of_week')},
       {_n('month', 'month')}, month_name, {_n('quarter', 'quarter')}, {_n('year', 'year')},
       is_weekend, is_holiday FROM dim_date"""
    out["dim_product"] = f"WITH {_BRONZE}, {_DIM_PRODUCT} SELECT {product_cols} FROM dim_product"
    # the added codes sort after the known ones, so ids continue in code order
    kept = "CASE WHEN stock_code < 'PROMO' THEN 'kept ' ELSE '' END || description AS description"
    out["dim_product_extended"] = f"""WITH {_BRONZE}, {_DIM_PRODUCT}
SELECT {_n("product_id", "product_id")}, stock_code, {kept}, category FROM dim_product"""
    out["product_category"] = bronze(
        f"""SELECT {_category('stockcode')} AS category, count(DISTINCT stockcode) AS products
FROM bronze GROUP BY 1"""
    )
    out["customer_ids"] = bronze(
        f"SELECT {_n(_CUSTOMER_ID, 'customer_id')}, count(*) AS line_count FROM bronze GROUP BY 1"
    )
    out["fact_sales_daily"] = silver(f"SELECT {fact_all} FROM fact")
    doubled = "CASE WHEN year = 2001 THEN total_quantity * 2 ELSE total_quantity END"
    out["fact_upsert"] = silver(
        f"""SELECT {fact_cols.format(country='country', quantity=doubled)} FROM fact
UNION ALL SELECT {fact_cols.format(country="country || ' (new)'", quantity=doubled)} FROM fact WHERE year = 2001"""
    )
    out["silver_metrics"] = silver(
        f"""SELECT (SELECT count(*) FROM dim_date) AS date_rows, (SELECT count(*) FROM dim_product) AS product_rows,
       count(*) AS fact_rows, {_m('sum(total_revenue)', 'total_revenue')} FROM fact"""
    )
    out["layer_row_counts"] = silver(
        """SELECT 'bronze.raw_transactions' AS table_name, count(*) AS row_count FROM bronze
UNION ALL SELECT 'silver.dim_date', count(*) FROM dim_date
UNION ALL SELECT 'silver.dim_product', count(*) FROM dim_product
UNION ALL SELECT 'silver.fact_sales_daily', count(*) FROM fact
UNION ALL SELECT 'gold.monthly_sales_summary', count(DISTINCT (year, month)) FROM fact"""
    )

    out["gold_sales_monthly"] = silver(_monthly())
    out["gold_product_performance"] = silver(_PRODUCT_PERFORMANCE)
    out["gold_country_sales"] = silver(_country_sales())
    out["gold_daily_trend"] = silver(_trend())
    out["gold_daily_enhanced"] = silver(_DAILY)
    out["monthly_sales_summary"] = silver(_MONTHLY_SUMMARY)
    out["top_products_by_revenue"] = silver(_TOP_PRODUCTS)
    out["country_performance"] = silver(_COUNTRY_PERFORMANCE)
    out["customer_lifetime_value"] = silver(_CLV)
    out["customer_monthly_activity"] = silver(_ACTIVITY)
    out["customer_product_affinity"] = silver(_AFFINITY)
    out["top_product_per_country"] = silver(_TOP_PRODUCT)
    out["country_unique_customers_incl_unknown"] = silver(
        f"SELECT country, {_ALL_CUSTOMERS} FROM fact GROUP BY country"
    )
    out["customer_primary_country"] = silver(
        f"SELECT {_n('customer_id', 'customer_id')}, primary_country FROM ({_PRIMARY})"
    )
    out["customer_segment_counts"] = silver(
        f"SELECT customer_segment, count(*) AS customers FROM ({_CLV}) GROUP BY 1"
    )
    out["customer_recency_counts"] = silver(
        f"SELECT recency_category, count(*) AS customers FROM ({_CLV}) GROUP BY 1"
    )
    out["affinity_level_counts"] = silver(
        f"SELECT affinity_level, count(*) AS pairs FROM ({_AFFINITY}) GROUP BY 1"
    )

    out["silver_daily_rollup"] = silver(
        f"""SELECT {_d('date', 'date')}, {_m('sum(total_revenue)', 'daily_revenue')},
       {_n('sum(total_quantity)', 'daily_quantity')}, {_n('sum(total_transactions)', 'daily_transactions')}
FROM fact JOIN dim_date d USING (date_id) GROUP BY d.date ORDER BY d.date DESC LIMIT 10"""
    )
    out["silver_top_products"] = silver(
        f"""SELECT description, {_m('sum(total_revenue)', 'total_revenue')},
       {_n('sum(total_quantity)', 'total_quantity')}
FROM fact JOIN dim_product USING (product_id) GROUP BY description
ORDER BY sum(fact.total_revenue) DESC, description LIMIT 10"""
    )
    out["silver_daily_revenue"] = silver(
        f"""SELECT {_d('date', 'date')}, {_m('sum(total_revenue)', 'daily_revenue')}
FROM fact JOIN dim_date d USING (date_id) GROUP BY d.date"""
    )
    out["silver_revenue_by_country"] = silver(
        f"""SELECT country, {_m('sum(total_revenue)', 'total_revenue')},
       count(DISTINCT date_id) AS active_days FROM fact GROUP BY country"""
    )
    out["gold_weekday_analysis"] = silver(
        f"""SELECT {_n('d.day_of_week', 'day_of_week')}, day_name, count(*) AS days,
       {_m('sum(revenue)', 'total_revenue')}, {_quotient('sum(revenue)', 'count(*)', 6)} AS avg_daily_revenue,
       {_n('sum(transactions)', 'total_transactions')}
FROM (SELECT date_id, sum(total_revenue) AS revenue, sum(total_transactions) AS transactions
      FROM fact GROUP BY date_id) JOIN dim_date d USING (date_id) GROUP BY d.day_of_week, day_name"""
    )
    out["gold_month_name_revenue"] = silver(
        f"""SELECT {_n('d.year', 'year')}, {_n('d.month', 'month')}, month_name,
       {_m('sum(total_revenue)', 'monthly_revenue')}, {_n('sum(total_quantity)', 'monthly_quantity')}
FROM fact f JOIN dim_date d USING (date_id) GROUP BY d.year, d.month, month_name"""
    )
    out["gold_monthly_trend"] = silver(
        f"""SELECT year, month, total_revenue, total_quantity, total_transactions, avg_revenue_per_transaction
FROM ({_monthly()})"""
    )
    out["gold_latest_months"] = silver(
        f"SELECT * FROM ({_monthly()}) ORDER BY year DESC, month DESC LIMIT 10"
    )
    out["gold_top10_products"] = silver(
        f"""SELECT stock_code, description, category, total_revenue, total_quantity, total_transactions,
       avg_revenue_per_transaction FROM ({_PRODUCT_PERFORMANCE}) ORDER BY total_revenue DESC, stock_code LIMIT 10"""
    )
    out["gold_country_ranking"] = silver(
        f"""SELECT country, total_revenue, total_quantity, total_transactions, avg_revenue_per_transaction
FROM ({_country_sales()})"""
    )
    out["gold_daily_trend_30"] = silver(
        f"""SELECT date, day_of_week, is_weekend, total_revenue, revenue_vs_previous_day,
       revenue_vs_previous_day_pct FROM ({_trend()}) ORDER BY date DESC LIMIT 30"""
    )

    out["gold_product_listing"] = silver(
        f"""SELECT stock_code, description, total_revenue, total_quantity, total_transactions
FROM ({_PRODUCT_PERFORMANCE}) ORDER BY total_revenue DESC, stock_code LIMIT 10"""
    )
    out["gold_country_listing"] = silver(
        f"""SELECT country, total_revenue, total_quantity, total_transactions
FROM ({_country_sales()}) ORDER BY total_revenue DESC, country LIMIT 10"""
    )
    out["gold_latest_days"] = silver(
        f"""SELECT date, total_revenue, revenue_vs_previous_day, revenue_vs_previous_day_pct, is_weekend
FROM ({_trend()}) ORDER BY date DESC LIMIT 10"""
    )

    out["dq_suite"] = f"WITH {_SUITE_CTES}\n{_suite()}"
    out["dq_summary"] = f"""WITH {_SUITE_CTES}, results AS ({_suite()})
SELECT count(*) AS checks, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
       count(*) FILTER (NOT passed) = 0 AS ok FROM results"""
    out["dq_failures"] = _failures()
    out["reconcile_layers"] = silver(
        f"""SELECT {_m('br', 'bronze_revenue')}, {_n('bq', 'bronze_quantity')}, {_m('sr', 'silver_revenue')},
       {_n('sq', 'silver_quantity')}, br = sr AS revenue_matches, bq = sq AS quantity_matches
FROM (SELECT sum(quantity * unitprice) AS br, sum(quantity) AS bq FROM bronze
      WHERE quantity > 0 AND unitprice >= 0),
     (SELECT sum(total_revenue) AS sr, sum(total_quantity) AS sq FROM fact)"""
    )
    out["freshness"] = f"""WITH n AS (
SELECT max(ts) AS newest, date_sub('hour', max(ts), TIMESTAMP '{EVENTS_NOW}') AS age_hours FROM events)
SELECT {_t('newest', 'newest')}, age_hours,
       CASE WHEN age_hours IS NULL OR age_hours > {rules.FRESHNESS_ERROR_HOURS} THEN 'error'
            WHEN age_hours > {rules.FRESHNESS_WARN_HOURS} THEN 'warn' ELSE 'pass' END AS status FROM n"""

    out["distinct_months"] = silver(f"SELECT {_n('year', 'year')}, {_n('month', 'month')} FROM months", _MONTHS)
    out["pending_months"] = silver(
        f"""SELECT {_n('year', 'year')}, {_n('month', 'month')}, month_key FROM months
WHERE month_key NOT IN (SELECT month_key FROM ledger WHERE status = '{rules.COMPLETED}')""",
        _MONTHS, _LEDGER,
    )
    out["mark_months"] = silver(
        f"""SELECT month_key, {_n('year', 'year')}, {_n('month', 'month')},
       CASE WHEN month_key IN (SELECT month_key FROM months) THEN '{rules.COMPLETED}' ELSE status END AS status
FROM (SELECT month_key, year, month, status FROM ledger
      UNION ALL SELECT month_key, year, month, '{rules.COMPLETED}' FROM months
      WHERE month_key NOT IN (SELECT month_key FROM ledger))""",
        _MONTHS, _LEDGER,
    )
    out["recompute_month"] = silver(_monthly(_ALL_CUSTOMERS))
    out["upsert_monthly"] = silver(
        f"""SELECT * FROM ({_monthly(_ALL_CUSTOMERS)}) WHERE year < 1999
UNION ALL SELECT * FROM ({_monthly()}) WHERE year >= 1999"""
    )
    out["rebuild_month"] = silver(
        f"""SELECT strftime(date, '%Y-%m') AS month_key, {_n('d.year', 'year')}, {_n('d.month', 'month')},
       {_m('sum(total_revenue)', 'total_sales')}, {_n('sum(total_quantity)', 'total_quantity')},
       {_n('sum(total_transactions)', 'transaction_count')}
FROM fact f JOIN dim_date d USING (date_id) GROUP BY 1, d.year, d.month"""
    )
    out["duplicate_months"] = silver(
        f"""SELECT {_n('year', 'year')}, {_n('month', 'month')}, count(DISTINCT country) AS duplicate_count
FROM fact GROUP BY year, month HAVING count(DISTINCT country) > 1"""
    )
    out["dedupe_keep_latest"] = f"""SELECT event_id, {_t('ts', 'ts')}, user_id, event_type FROM (
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
WHERE place = 1"""
    out["log_level_counts"] = """SELECT 'events' AS pipeline_name, CAST(user_id AS VARCHAR) AS run_id,
       event_type AS level, count(*) AS log_count FROM events GROUP BY user_id, event_type"""
    out["log_coverage"] = f"""SELECT CAST(user_id AS VARCHAR) AS run_id, count(*) AS log_count,
       {_t('min(ts)', 'first_log')}, {_t('max(ts)', 'last_log')} FROM events GROUP BY user_id"""
    out["checkpoint_latest"] = """SELECT 'events' AS pipeline_name, CAST(user_id AS VARCHAR) AS run_id,
       event_type AS stage, 'value' AS checkpoint_key, CAST(value AS VARCHAR) AS checkpoint_value, event_id
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS place
      FROM events) WHERE place = 1"""
    out["ledger_scan"] = f"""WITH {_EVENT_LEDGER}
SELECT month_key, year, month, status, {_BAD_METADATA} AS bad_metadata, {_BAD_STATUS} AS bad_status,
       year IS NULL OR month IS NULL AS missing_month FROM event_ledger"""
    out["ledger_repair"] = f"""WITH {_EVENT_LEDGER}
SELECT month_key, year, month, status, metadata FROM event_ledger
WHERE NOT {_BAD_METADATA} AND NOT {_BAD_STATUS} AND year IS NOT NULL AND month IS NOT NULL
  AND NOT coalesce(metadata ILIKE '%corrupted%', FALSE)
UNION ALL SELECT DISTINCT strftime(o_orderdate, '%Y-%m'), year(o_orderdate), month(o_orderdate),
       '{rules.COMPLETED}', '{{"recovered": true}}' FROM orders"""

    out["read_transactions"] = f"""WITH {_CLEAN_STRICT.replace(_PRICE, _NEAR_PRICE)} SELECT * FROM strict"""
    out["read_workbooks"] = out["read_transactions"]
    out["write_bronze_append"] = bronze(
        f"""SELECT CASE WHEN quantity < 0 THEN 'returns' ELSE 'sales' END AS ingest_batch,
       count(*) AS line_count, {_n('sum(quantity)', 'total_quantity')} FROM bronze GROUP BY 1"""
    )
    out["write_bronze_overwrite"] = bronze(
        """SELECT 'early' AS ingest_batch, strftime(invoicedate, '%Y-%m') AS invoice_month, count(*) AS line_count
FROM bronze WHERE year(invoicedate) <= 1998 GROUP BY 2"""
    )
    tables = ", ".join(f"('{n}')" for n in schemas.TABLES)
    out["ensure_layers"] = silver(
        f"""SELECT table_name, CASE table_name WHEN 'ops.processed_months' THEN (SELECT count(*) FROM months)
       ELSE 0 END AS row_count FROM (VALUES {tables}) AS v(table_name)""",
        _MONTHS,
    )
    out["write_table"] = out["monthly_sales_summary"]
    out["gold_row_counts"] = silver(
        """SELECT 'gold.fact_sales_monthly' AS table_name, count(DISTINCT (year, month)) AS row_count FROM fact
UNION ALL SELECT 'gold.fact_product_performance', count(DISTINCT product_id) FROM fact
UNION ALL SELECT 'gold.fact_country_sales', count(DISTINCT country) FROM fact
UNION ALL SELECT 'gold.fact_sales_daily_enhanced', count(DISTINCT date_id) FROM fact"""
    )
    out["stage_checkpoints"] = f"""SELECT 'events' AS pipeline_name, 'run-1' AS run_id, event_type AS stage,
       'rows' AS checkpoint_key, CAST(count(*) AS VARCHAR) AS checkpoint_value, '{rules.COMPLETED}' AS status
FROM events GROUP BY event_type"""
    out["recover_logs"] = """SELECT 'events' AS pipeline_name, CAST(user_id AS VARCHAR) AS run_id,
       event_type AS level, count(*) AS log_count FROM events WHERE event_type <> 'error' GROUP BY user_id, event_type"""
    out["processed_dates"] = f"""SELECT CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS date_value, '{rules.COMPLETED}' AS status FROM events
UNION ALL SELECT CAST(max(CAST(ts AS DATE)) AS VARCHAR), '{rules.FAILED}' FROM events"""
    out["reset_ledger"] = silver(
        "SELECT 'before' AS table_name, count(*) AS row_count FROM months UNION ALL SELECT 'after', 0", _MONTHS
    )
    out["dry_run"] = silver(
        f"SELECT {_n('year', 'year')}, {_n('month', 'month')} FROM months WHERE year = 1998", _MONTHS
    )
    out["pending_months_of_year"] = f"SELECT * FROM ({out['pending_months']}) WHERE year = 1998"
    out["recompute_some_months"] = silver(
        f"""SELECT year, month, CASE WHEN year = 1998 AND month BETWEEN 3 AND 5 THEN total_quantity ELSE -1 END
       AS total_quantity, total_revenue FROM ({_monthly()})"""
    )

    def doubled(cols: str, source: str, condition: str) -> str:
        quantity = _n(f"CASE WHEN {condition} THEN 2 ELSE 1 END * total_quantity", "total_quantity")
        return silver(f"SELECT {cols}, {quantity}, total_revenue FROM ({source})")

    out["upsert_products"] = doubled("product_id, stock_code", _PRODUCT_PERFORMANCE, "product_id % 3 = 0")
    out["upsert_countries"] = doubled("country", _country_sales(), "country < 'G'")
    out["upsert_days"] = doubled("date_id", _DAILY, "date_id >= 19980101")
    out["customer_ids_rounded"] = bronze(
        """SELECT coalesce(CAST(split_part(customerid, '.', 1) AS BIGINT) + 1, -1) AS customer_id, count(*) AS line_count
FROM bronze GROUP BY 1"""
    )
    out["stream_bronze"] = bronze(
        f"""SELECT strftime(invoicedate, '%Y-%m') AS invoice_month, count(*) AS line_count,
       {_n('sum(quantity)', 'total_quantity')}, {_m(revenue, 'total_revenue')} FROM bronze GROUP BY 1"""
    )
    out["arrivals"] = "SELECT 'lineitem.parquet' AS file_name, count(*) AS row_count, TRUE AS has_bytes FROM lineitem"
    out["refresh_touched_months"] = silver(_monthly(_ALL_CUSTOMERS))
    out["stream_daily_sales"] = bronze(
        f"""SELECT {_d('CAST(invoicedate AS DATE)', 'date')}, stockcode AS stock_code, country,
       {_n(f'max({_CUSTOMER_ID})', 'customer_id')}, count(DISTINCT invoiceno) AS total_transactions,
       {_n('sum(quantity)', 'total_quantity')}, {_m(revenue, 'total_revenue')}
FROM bronze WHERE quantity > 0 AND unitprice >= 0 AND country IS NOT NULL
GROUP BY CAST(invoicedate AS DATE), stockcode, country"""
    )
    return out
