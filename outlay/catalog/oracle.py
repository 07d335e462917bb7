"""SQL counterparts of the registered queries, for an independent engine on the same tables.

Written naively on purpose: plain windows, row-level joins and self-joins, none of the
rewrites the Spark operators use.
"""

from __future__ import annotations

from outlay.catalog.inputs import AS_OF, LIMITS, YEARLY_HOLIDAYS

_HOLIDAYS = ", ".join(f"'{h}'" for h in YEARLY_HOLIDAYS)
L = LIMITS


def _decimal_mean(total: str, rows: str) -> str:
    """Mean amount as DECIMAL(14,6): the double quotient in cents, cut at its shortest text."""
    return f"CAST(CAST(CAST({total} * 100 AS DOUBLE) / {rows} / 100 AS VARCHAR) AS DECIMAL(14,6))"


def _mean(total: str, rows: str) -> str:
    return f"CAST({_decimal_mean(total, rows)} AS DOUBLE)"


BASE = f"""
WITH raw_expenses AS (
  SELECT 'INV-' || l_orderkey || '-' || l_linenumber AS invoice_id,
         CAST(l_suppkey AS INT) AS vendor_id, s_name AS vendor_name,
         CAST(o_custkey % 100 AS INT) AS employee_id, 'Employee ' || (o_custkey % 100) AS employee_name,
         c_nationkey AS dept_id, n_name AS dept_name, CAST(l_shipdate AS DATE) AS trx_date,
         CAST(CASE WHEN l_linenumber = 1 THEN round(l_extendedprice / 100) * 100
                   ELSE l_extendedprice END AS DECIMAL(10,2)) AS amount,
         'USD' AS currency, o_orderpriority AS payment_method,
         l_returnflag || l_linestatus AS description, l_quantity, l_discount
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
), flawed_expenses AS (
  SELECT CASE WHEN l_quantity <> 1 THEN invoice_id END AS invoice_id,
         CASE WHEN l_quantity <> 3 THEN vendor_id END AS vendor_id, vendor_name,
         CASE WHEN l_quantity <> 4 THEN employee_id END AS employee_id, employee_name,
         CASE WHEN l_quantity <> 5 THEN dept_id END AS dept_id, dept_name,
         CASE WHEN l_quantity <> 2 THEN trx_date END AS trx_date,
         CAST(CASE WHEN l_discount = 0.1 THEN -amount WHEN l_discount = 0.09 THEN amount * 50
                   ELSE amount END AS DECIMAL(10,2)) AS amount,
         currency, payment_method, description
  FROM raw_expenses
), expenses AS (
  SELECT * EXCLUDE (l_quantity, l_discount, rn), 'lineitem' AS source_file FROM (
    SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY trx_date NULLS FIRST,
      amount NULLS FIRST, vendor_id NULLS FIRST, vendor_name NULLS FIRST, employee_id NULLS FIRST,
      employee_name NULLS FIRST, dept_id NULLS FIRST, dept_name NULLS FIRST, currency NULLS FIRST,
      payment_method NULLS FIRST, description NULLS FIRST) AS rn
    FROM raw_expenses WHERE invoice_id IS NOT NULL AND amount > 0 AND trx_date IS NOT NULL)
  WHERE rn = 1
), raw_budgets AS (
  SELECT dept_id, n_name AS dept_name, budget_month,
         CAST(round(largest * CASE dept_id % 3 WHEN 0 THEN 2.50 WHEN 1 THEN 3.25 ELSE 4.00 END, 2)
              AS DECIMAL(12,2)) AS budget_amount, 'USD' AS currency
  FROM (SELECT c_nationkey AS dept_id, strftime(o_orderdate, '%Y-%m') AS budget_month, o_orderpriority,
               max(CAST(o_totalprice AS DECIMAL(12,2))) AS largest
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE (c_nationkey + month(o_orderdate)) % 7 <> 0
        GROUP BY 1, 2, 3)
  LEFT JOIN nation ON dept_id = n_nationkey
), budgets AS (
  SELECT * EXCLUDE (rn), 'orders' AS source_file FROM (
    SELECT *, row_number() OVER (PARTITION BY dept_id, budget_month ORDER BY dept_name NULLS FIRST,
      budget_amount NULLS FIRST, currency NULLS FIRST) AS rn
    FROM raw_budgets WHERE dept_id IS NOT NULL AND budget_amount > 0)
  WHERE rn = 1
), campaign_spend AS (
  SELECT 'SPEND-' || user_id || '-' || day AS spend_id, CAST(user_id % 20 AS INT) AS campaign_id,
         'Campaign_' || (user_id % 20) AS campaign_name, 'Channel_' || (user_id % 6) AS channel,
         'Objective_' || (user_id % 20 % 4) AS objective, day AS date, cost, clicks, impressions,
         conversions, attributed_revenue, 'events' AS source_file
  FROM (SELECT user_id, CAST(ts AS DATE) AS day,
               CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(10,2)) AS cost,
               count(CASE WHEN event_type = 'click' THEN 1 END) AS clicks,
               count(CASE WHEN event_type = 'view' THEN 1 END) AS impressions,
               count(CASE WHEN event_type = 'purchase' THEN 1 END) AS conversions,
               CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(10,2)) ELSE 0 END)
                    AS DECIMAL(10,2)) AS attributed_revenue
        FROM events GROUP BY 1, 2)
  WHERE cost > 0 AND user_id IS NOT NULL AND day IS NOT NULL
), days AS (
  SELECT DISTINCT CAST(d AS DATE) AS date FROM (
    SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE),
                                  INTERVAL 1 DAY)) AS d FROM orders
    UNION ALL
    SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) FROM events)
), calendar AS (
  SELECT date, CAST(weekofyear(date) AS BIGINT) AS week, strftime(date, '%Y-%m') AS month_key,
         'Q' || quarter(date) AS quarter, CAST(year(date) AS BIGINT) AS year,
         isodow(date) >= 6 AS is_weekend, strftime(date, '%m-%d') IN ({_HOLIDAYS}) AS is_holiday,
         'calendar' AS source_file
  FROM days
), dim_vendor AS (
  SELECT vendor_id, vendor_name, 'Technology' AS category, 'US' AS country,
         row_number() OVER (ORDER BY vendor_id NULLS FIRST) AS vendor_key
  FROM (SELECT vendor_id, min(vendor_name) AS vendor_name FROM expenses GROUP BY 1)
), dim_employee AS (
  SELECT employee_id, employee_name, dept_id, 'Employee' AS title, 'Remote' AS location,
         row_number() OVER (ORDER BY employee_id NULLS FIRST) AS employee_key
  FROM (SELECT employee_id, employee_name, dept_id, row_number() OVER (PARTITION BY employee_id
          ORDER BY employee_name NULLS FIRST, dept_id NULLS FIRST) AS rn FROM expenses)
  WHERE rn = 1
), dim_department AS (
  SELECT dept_id, dept_name, 'Owner_' || dept_name AS owner,
         row_number() OVER (ORDER BY dept_id NULLS FIRST) AS dept_key
  FROM (SELECT dept_id, min(dept_name) AS dept_name FROM expenses GROUP BY 1)
), dim_campaign AS (
  SELECT campaign_id, campaign_name, channel, objective,
         row_number() OVER (ORDER BY campaign_id NULLS FIRST) AS campaign_key
  FROM (SELECT campaign_id, campaign_name, channel, objective, row_number() OVER (PARTITION BY campaign_id
          ORDER BY campaign_name NULLS FIRST, channel NULLS FIRST, objective NULLS FIRST) AS rn
        FROM campaign_spend)
  WHERE rn = 1
), dim_calendar AS (
  SELECT * EXCLUDE (source_file), row_number() OVER (ORDER BY date) AS calendar_key FROM calendar
), fact_expense AS (
  SELECT e.invoice_id, e.vendor_id, e.employee_id, e.dept_id, e.trx_date, e.amount, e.currency,
         e.payment_method, c.month_key AS budget_month_key, v.vendor_key, p.employee_key, d.dept_key,
         c.calendar_key
  FROM expenses e LEFT JOIN dim_vendor v ON e.vendor_id = v.vendor_id
  LEFT JOIN dim_employee p ON e.employee_id = p.employee_id
  LEFT JOIN dim_department d ON e.dept_id = d.dept_id
  LEFT JOIN dim_calendar c ON e.trx_date = c.date
), fact_campaign_spend AS (
  SELECT s.spend_id, s.campaign_id, s.channel, s.date, s.cost, s.clicks, s.impressions, s.conversions,
         s.attributed_revenue, c.calendar_key
  FROM campaign_spend s LEFT JOIN dim_calendar c ON s.date = c.date
), duplicates AS (
  SELECT 'duplicate_invoice' AS rule_name, 'vendor' AS entity_type, CAST(vendor_id AS VARCHAR) AS entity_id,
         vendor_name AS entity_name, trx_date AS signal_date, CAST(75 AS DOUBLE) AS score,
         'Duplicate invoice detected for vendor ' || vendor_name || ' within 30 days' AS details
  FROM (SELECT e.vendor_id, v.vendor_name, e.trx_date,
               count(*) OVER (PARTITION BY e.vendor_id ORDER BY e.trx_date
                 RANGE BETWEEN INTERVAL {L.duplicate_window_days} DAY PRECEDING
                           AND INTERVAL {L.duplicate_window_days} DAY FOLLOWING) AS n
        FROM fact_expense e LEFT JOIN dim_vendor v ON e.vendor_id = v.vendor_id)
  WHERE n > 1
), small_claims AS (
  SELECT 'sub_threshold_repeats' AS rule_name, 'employee' AS entity_type,
         CAST(employee_id AS VARCHAR) AS entity_id, employee_name AS entity_name, trx_date AS signal_date,
         CAST(85 AS DOUBLE) AS score,
         'Employee ' || employee_name || ' made ' || n || ' small claims in 7 days' AS details
  FROM (SELECT e.employee_id, p.employee_name, e.trx_date,
               count(*) OVER (PARTITION BY e.employee_id ORDER BY e.trx_date
                 RANGE BETWEEN INTERVAL {L.sub_threshold_window_days} DAY PRECEDING
                           AND INTERVAL {L.sub_threshold_window_days} DAY FOLLOWING) AS n
        FROM fact_expense e LEFT JOIN dim_employee p ON e.employee_id = p.employee_id
        WHERE e.amount < {L.sub_threshold_amount})
  WHERE n >= {L.sub_threshold_min_count}
), off_days AS (
  SELECT 'weekend_holiday_claim' AS rule_name, 'employee' AS entity_type,
         CAST(e.employee_id AS VARCHAR) AS entity_id, p.employee_name AS entity_name,
         e.trx_date AS signal_date,
         CAST(CASE WHEN c.is_weekend AND c.is_holiday THEN 90 WHEN c.is_weekend THEN 70 ELSE 60 END
              AS DOUBLE) AS score,
         'Expense on ' || CASE WHEN c.is_weekend AND c.is_holiday THEN 'weekend holiday'
           WHEN c.is_weekend THEN 'weekend' ELSE 'holiday' END || ' by ' || p.employee_name AS details
  FROM fact_expense e LEFT JOIN dim_calendar c ON e.trx_date = c.date
  LEFT JOIN dim_employee p ON e.employee_id = p.employee_id
  WHERE c.is_weekend OR c.is_holiday
), round_numbers AS (
  SELECT 'round_number_spikes' AS rule_name, 'department' AS entity_type,
         CAST(dept_id AS VARCHAR) AS entity_id, dept_name AS entity_name, DATE '{AS_OF}' AS signal_date,
         CAST(CASE WHEN pct > {L.round_number_pct * 1.5} THEN 65 ELSE 45 END AS DOUBLE) AS score,
         'Department ' || dept_name || ' has ' || CAST(round(pct, 1) AS VARCHAR) || '% round number expenses in '
           || budget_month_key AS details
  FROM (SELECT e.dept_id, d.dept_name, e.budget_month_key,
               CAST(count(CASE WHEN e.amount % 100 = 0 THEN 1 END) AS DOUBLE) / count(*) * 100 AS pct
        FROM fact_expense e LEFT JOIN dim_department d ON e.dept_id = d.dept_id GROUP BY 1, 2, 3)
  WHERE pct > {L.round_number_pct}
), spend_steps AS (
  SELECT *, lag(cost) OVER w AS prev_cost, lag(conversions) OVER w AS prev_conversions
  FROM fact_campaign_spend
  WINDOW w AS (PARTITION BY campaign_id ORDER BY date, spend_id)
), spikes AS (
  SELECT 'campaign_spend_spike' AS rule_name, 'campaign' AS entity_type,
         CAST(campaign_id AS VARCHAR) AS entity_id, campaign_name AS entity_name, date AS signal_date,
         CAST(score AS DOUBLE) AS score,
         'Campaign ' || campaign_name || ' spend increased ' || CAST(round(cost_up, 1) AS VARCHAR) || '% with only '
           || CAST(round(conv_up, 1) AS VARCHAR) || '% conversion lift' AS details
  FROM (SELECT s.campaign_id, k.campaign_name, s.date, s.cost_up, s.conv_up,
          CASE WHEN s.cost_up >= {L.spike_cost_pct * 1.5} AND s.conv_up <= {L.spike_conversion_pct * 2} THEN 80
               WHEN s.cost_up >= {L.spike_cost_pct} AND s.conv_up <= {L.spike_conversion_pct} THEN 60
               ELSE 0 END AS score
        FROM (SELECT *,
                CASE WHEN prev_cost > 0 THEN CAST(cost - prev_cost AS DOUBLE) / CAST(prev_cost AS DOUBLE) * 100
                     ELSE 0 END AS cost_up,
                CASE WHEN prev_conversions > 0
                     THEN CAST(conversions - prev_conversions AS DOUBLE) / prev_conversions * 100
                     ELSE 0 END AS conv_up
              FROM spend_steps) s
        LEFT JOIN dim_campaign k ON s.campaign_id = k.campaign_id)
  WHERE score > 0
), signals AS (
  SELECT * FROM duplicates UNION ALL SELECT * FROM small_claims UNION ALL SELECT * FROM off_days
  UNION ALL SELECT * FROM round_numbers UNION ALL SELECT * FROM spikes
), variance AS (
  SELECT a.dept_id, a.dept_name, a.budget_month_key,
         CAST(COALESCE(b.budget_amount, 0) AS DOUBLE) AS budget_amount,
         CAST(a.actual AS DOUBLE) AS actual_amount,
         CAST(a.actual - COALESCE(b.budget_amount, 0) AS DOUBLE) AS variance_amount,
         CASE WHEN COALESCE(b.budget_amount, 0) > 0
              THEN CAST(a.actual - b.budget_amount AS DOUBLE) / CAST(b.budget_amount AS DOUBLE) * 100
              ELSE 0 END AS variance_percentage
  FROM (SELECT e.dept_id, d.dept_name, e.budget_month_key, sum(e.amount) AS actual
        FROM fact_expense e LEFT JOIN dim_department d ON e.dept_id = d.dept_id GROUP BY 1, 2, 3) a
  LEFT JOIN budgets b ON a.dept_id = b.dept_id AND a.budget_month_key = b.budget_month
), concentration AS (
  SELECT vendor_id, vendor_name, CAST(total AS DOUBLE) AS total_spend, transaction_count,
         {_mean('total', 'transaction_count')} AS avg_transaction_amount, spend_percentage,
         CAST(CASE WHEN spend_percentage > {L.vendor_high_pct} THEN 90
                   WHEN spend_percentage > {L.vendor_medium_pct} THEN 70
                   WHEN spend_percentage > {L.vendor_low_pct} THEN 50 ELSE 20 END AS DOUBLE)
           AS concentration_score
  FROM (SELECT *, CAST(total AS DOUBLE) / CAST((SELECT sum(amount) FROM fact_expense) AS DOUBLE) * 100
                    AS spend_percentage
        FROM (SELECT e.vendor_id, v.vendor_name, sum(e.amount) AS total, count(*) AS transaction_count
              FROM fact_expense e LEFT JOIN dim_vendor v ON e.vendor_id = v.vendor_id GROUP BY 1, 2))
), vw_budget AS (
  SELECT *, CASE WHEN variance_percentage > 10 THEN 'Over Budget'
                 WHEN variance_percentage < -10 THEN 'Under Budget' ELSE 'On Target' END AS budget_status
  FROM (SELECT dept_name, dept_id, budget_month, CAST(budget AS DOUBLE) AS budget_amount,
               CAST(actual AS DOUBLE) AS actual_amount, CAST(actual - budget AS DOUBLE) AS variance_amount,
               CASE WHEN budget > 0 THEN CAST(actual - budget AS DOUBLE) / CAST(budget AS DOUBLE) * 100
                    ELSE 0 END AS variance_percentage
        FROM (SELECT d.dept_name, d.dept_id, b.budget_month, b.budget_amount AS budget,
                     COALESCE(sum(e.amount), 0) AS actual
              FROM budgets b LEFT JOIN fact_expense e ON b.dept_id = e.dept_id
                AND b.budget_month = e.budget_month_key
              LEFT JOIN dim_department d ON b.dept_id = d.dept_id
              GROUP BY 1, 2, 3, 4))
), vw_vendor AS (
  SELECT *, CASE WHEN spend_percentage > {L.vendor_high_pct} THEN 'High Risk'
                 WHEN spend_percentage > {L.vendor_medium_pct} THEN 'Medium Risk'
                 WHEN spend_percentage > {L.vendor_low_pct} THEN 'Low Risk' ELSE 'Minimal Risk' END
              AS concentration_risk,
         row_number() OVER (ORDER BY total DESC, vendor_id) AS vendor_rank
  FROM (SELECT v.vendor_name, v.vendor_id, v.category, count(e.invoice_id) AS transaction_count,
               sum(e.amount) AS total,
               CAST(sum(e.amount) AS DOUBLE) / CAST((SELECT sum(amount) FROM fact_expense) AS DOUBLE) * 100
                 AS spend_percentage
        FROM fact_expense e JOIN dim_vendor v ON e.vendor_id = v.vendor_id GROUP BY 1, 2, 3)
), vw_flags AS (
  SELECT rule_name, entity_type, entity_name, signal_date, score, details,
         CASE WHEN score >= 80 THEN 'Critical' WHEN score >= 60 THEN 'High' WHEN score >= 40 THEN 'Medium'
              ELSE 'Low' END AS risk_level,
         count(*) OVER (PARTITION BY rule_name) AS rule_count,
         count(*) OVER (PARTITION BY entity_type) AS entity_type_count
  FROM signals WHERE signal_date >= DATE '{AS_OF}' - INTERVAL 3 MONTH
)
"""


SIGNAL = "rule_name, entity_type, entity_id, entity_name, signal_date, score, details"

_EXPENSE_STATS = f"""count(*) AS total_transactions, CAST(sum(amount) AS DOUBLE) AS total_expenses,
  {_mean('sum(amount)', 'count(amount)')} AS avg_transaction_amount,
  CAST(max(amount) AS DOUBLE) AS max_transaction_amount,
  CAST(min(amount) AS DOUBLE) AS min_transaction_amount"""

_SIGNAL_STATS = """count(*) AS total_signals,
  count(CASE WHEN score >= 80 THEN 1 END) AS high_risk_signals,
  count(CASE WHEN score >= 60 AND score < 80 THEN 1 END) AS medium_risk_signals,
  count(CASE WHEN score < 60 THEN 1 END) AS low_risk_signals,
  round(sum(score), 6) AS total_risk_score, round(sum(score) / count(*), 6) AS avg_risk_score"""

_BUDGET_STATS = """CAST(sum(CAST(budget_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_budget,
  CAST(sum(CAST(actual_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_actual,
  CAST(sum(CAST(variance_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_variance,
  round(avg(variance_percentage), 6) AS avg_variance_pct,
  count(CASE WHEN variance_percentage > 10 THEN 1 END) AS over_budget_departments,
  count(CASE WHEN variance_percentage < -10 THEN 1 END) AS under_budget_departments"""

_VENDOR_STATS = """count(*) AS total_vendors,
  CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) AS total_vendor_spend,
  round(avg(spend_percentage), 6) AS avg_spend_percentage,
  round(max(spend_percentage), 6) AS max_spend_percentage,
  count(CASE WHEN concentration_score >= 70 THEN 1 END) AS high_risk_vendors"""

_ESTIMATE = f"""SELECT round(est, 6) AS estimated_potential_leakage,
  round(CASE WHEN total_expenses > 0 THEN est / total_expenses * 100 ELSE 0 END, 6) AS leakage_percentage
FROM (SELECT total_expenses, CASE WHEN high > 0 THEN high * mean * 0.5 ELSE 0 END AS est
      FROM (SELECT CAST(sum(amount) AS DOUBLE) AS total_expenses,
                   {_mean('sum(amount)', 'count(amount)')} AS mean,
                   (SELECT count(*) FROM signals WHERE score >= 80) AS high
            FROM fact_expense))"""


def _dim(name: str, *columns: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {name}"


def _checks(relation: str, table: str, rows: list[tuple[str, str, str, str, str, str, str]]) -> str:
    """Union of check results: (check, column, type, failed rows, low, high, message tail)."""
    parts = []
    for check, column, kind, failed, low, high, tail in rows:
        place = f"{table}.{column}"
        if kind == "row_count":
            parts.append(f"""SELECT '{table}' AS table_name, '{check}' AS check_name, '' AS column_name,
  '{kind}' AS check_type, count(*) >= {low} AS passed, CAST(NULL AS BIGINT) AS failed_rows,
  CAST(NULL AS DOUBLE) AS failed_pct, CAST({low} AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value,
  '{table}: ' || count(*) || ' rows (minimum: {low})' AS message FROM {relation}""")
            continue
        message = f"'{place}: ' || f || ' {tail}'"
        if kind == "not_null":
            message = f"printf('{place}: %d nulls (%.2f%%)', f, p)"
        parts.append(f"""SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name,
  '{kind}' AS check_type, f = 0 AS passed, CAST(f AS BIGINT) AS failed_rows, round(p, 6) AS failed_pct,
  CAST({low} AS DOUBLE) AS min_value, CAST({high} AS DOUBLE) AS max_value, {message} AS message
FROM (SELECT f, CASE WHEN n > 0 THEN CAST(f AS DOUBLE) / n * 100 ELSE 0 END AS p
      FROM (SELECT {failed} AS f, count(*) AS n FROM {relation}))""")
    return "\nUNION ALL\n".join(parts)


def _null(column: str):
    return (f"{column}_not_null", column, "not_null", f"count(*) - count({column})", "NULL", "NULL", "")


def _unique(relation: str, check: str, *columns: str):
    listed = ", ".join(columns)
    failed = f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {listed} FROM {relation}))"
    return (check, ",".join(columns), "unique", failed, "NULL", "NULL", "duplicates")


def _positive(column: str):
    failed = f"count(CASE WHEN {column} <= 0 THEN 1 END)"
    return (f"{column}_positive", column, "positive", failed, "NULL", "NULL", "non-positive values")


_ROWS = ("min_rows", "", "row_count", "", "1", "", "")


def _expense_checks(relation: str, table: str) -> str:
    failed = "count(CASE WHEN amount < 0.01 OR amount > 1000000.0 THEN 1 END)"
    return _checks(relation, table, [
        _null("invoice_id"), _unique(relation, "invoice_id_unique", "invoice_id"), _positive("amount"),
        ("amount_range", "amount", "range", failed, "0.01", "1000000.0",
         "values outside range [0.01, 1000000.0]"),
        _null("trx_date"), _null("vendor_id"), _null("employee_id"), _null("dept_id"), _ROWS,
    ])


_BUDGET_CHECKS = _checks("budgets", "silver.budgets", [
    _null("dept_id"), _null("budget_month"), _positive("budget_amount"),
    _unique("budgets", "dept_month_unique", "dept_id"), _ROWS,
    _unique("budgets", "dept_id_budget_month_unique", "dept_id", "budget_month"),
])
_CAMPAIGN_CHECKS = _checks("campaign_spend", "silver.campaign_spend", [
    _null("spend_id"), _unique("campaign_spend", "spend_id_unique", "spend_id"), _positive("cost"),
    _null("date"), _null("campaign_id"), _ROWS,
])

_CLEAN = """invoice_id, CAST(vendor_id AS BIGINT) AS vendor_id, vendor_name,
  CAST(employee_id AS BIGINT) AS employee_id, employee_name, CAST(dept_id AS BIGINT) AS dept_id, dept_name,
  trx_date, CAST(amount AS DOUBLE) AS amount, currency, payment_method, description"""

_FACT = """invoice_id, CAST(vendor_id AS BIGINT) AS vendor_id, CAST(employee_id AS BIGINT) AS employee_id,
  CAST(dept_id AS BIGINT) AS dept_id, trx_date, CAST(amount AS DOUBLE) AS amount, currency, payment_method,
  budget_month_key, vendor_key, employee_key, dept_key, calendar_key"""

_SPEND = """spend_id, CAST(campaign_id AS BIGINT) AS campaign_id, channel, date, CAST(cost AS DOUBLE) AS cost,
  clicks, impressions, conversions, CAST(attributed_revenue AS DOUBLE) AS attributed_revenue, calendar_key"""

_DIMS = {
    "dim_vendor": ("CAST(vendor_id AS BIGINT) AS vendor_id", "vendor_name", "category", "country", "vendor_key"),
    "dim_employee": (
        "CAST(employee_id AS BIGINT) AS employee_id", "employee_name", "CAST(dept_id AS BIGINT) AS dept_id",
        "title", "location", "employee_key",
    ),
    "dim_department": ("CAST(dept_id AS BIGINT) AS dept_id", "dept_name", "owner", "dept_key"),
    "dim_campaign": (
        "CAST(campaign_id AS BIGINT) AS campaign_id", "campaign_name", "channel", "objective", "campaign_key",
    ),
    "dim_calendar": ("*",),
}

_MONTHLY = """SELECT budget_month_key, CAST(sum(amount) AS DOUBLE) AS total_expenses,
  count(*) AS expense_count, {avg} AS avg_expense_amount FROM fact_expense GROUP BY 1"""
_DEPT = """SELECT CAST(e.dept_id AS BIGINT) AS dept_id, d.dept_name,
  CAST(sum(e.amount) AS DOUBLE) AS total_expenses, count(*) AS expense_count
FROM fact_expense e LEFT JOIN dim_department d ON e.dept_id = d.dept_id GROUP BY 1, 2"""
_CAMPAIGN = """SELECT CAST(campaign_id AS BIGINT) AS campaign_id, CAST(sum(cost) AS DOUBLE) AS total_cost,
  CAST(sum(clicks) AS BIGINT) AS total_clicks, CAST(sum(conversions) AS BIGINT) AS total_conversions,
  CAST(sum(attributed_revenue) AS DOUBLE) AS total_revenue,
  round(CAST(sum(attributed_revenue) AS DOUBLE) / CAST(sum(cost) AS DOUBLE), {digits}) AS roas
FROM fact_campaign_spend GROUP BY 1 HAVING sum(cost) > 0"""

_VARIANCE = """SELECT CAST(dept_id AS BIGINT) AS dept_id, dept_name, budget_month_key, budget_amount,
  actual_amount, variance_amount, round(variance_percentage, 6) AS variance_percentage FROM variance"""

_FALLBACK = """SELECT CAST(a.dept_id AS BIGINT) AS dept_id, a.dept_name, a.budget_month_key,
  CAST(COALESCE(b.budget, 0) AS DOUBLE) AS budget_amount, CAST(a.actual AS DOUBLE) AS actual_amount,
  CAST(a.actual - COALESCE(b.budget, 0) AS DOUBLE) AS variance_amount,
  round(CASE WHEN b.budget > 0 THEN CAST(a.actual - b.budget AS DOUBLE) / b.budget * 100 ELSE 0 END, 6)
    AS variance_percentage
FROM (SELECT e.dept_id, d.dept_name, '2024-01' AS budget_month_key, sum(e.amount) AS actual
      FROM fact_expense e LEFT JOIN dim_department d ON e.dept_id = d.dept_id GROUP BY 1, 2, 3) a
LEFT JOIN (VALUES (1, '2024-01', 150000), (2, '2024-01', 120000), (3, '2024-01', 100000),
  (4, '2024-01', 80000), (5, '2024-01', 60000), (6, '2024-01', 90000), (7, '2024-01', 70000))
  AS b(dept_id, budget_month, budget)
  ON a.dept_id = b.dept_id AND a.budget_month_key = b.budget_month"""

_NEAR = f"""SELECT 'duplicate_invoice_amount' AS rule_name, 'vendor' AS entity_type,
  CAST(m.vendor_id AS VARCHAR) AS entity_id, v.vendor_name AS entity_name, m.trx_date AS signal_date,
  CAST(CASE WHEN m.matches >= 2 THEN 90 ELSE 75 END AS DOUBLE) AS score,
  'Invoice of similar amount for vendor ' || v.vendor_name || ' within {L.duplicate_window_days} days' AS details
FROM (SELECT a.invoice_id, a.vendor_id, a.trx_date, count(*) AS matches
      FROM fact_expense a JOIN fact_expense b ON a.vendor_id = b.vendor_id AND a.invoice_id <> b.invoice_id
        AND abs(date_diff('day', a.trx_date, b.trx_date)) <= {L.duplicate_window_days}
        AND abs(a.amount - b.amount) * 100 <= a.amount * {L.duplicate_tolerance_pct}
      GROUP BY 1, 2, 3) m
LEFT JOIN dim_vendor v ON m.vendor_id = v.vendor_id"""

_TRENDS = """SELECT budget_month_key, dept_name, CAST(spent AS DOUBLE) AS monthly_expenses, transaction_count,
  CAST(spent AS DOUBLE) / transaction_count AS avg_transaction_amount,
  CAST(prev AS DOUBLE) AS prev_month_expenses,
  CASE WHEN prev > 0 THEN CAST(spent - prev AS DOUBLE) / CAST(prev AS DOUBLE) * 100 ELSE 0 END
    AS month_over_month_change
FROM (SELECT *, lag(spent) OVER (PARTITION BY dept_name ORDER BY budget_month_key NULLS FIRST) AS prev
      FROM (SELECT e.budget_month_key, d.dept_name, sum(e.amount) AS spent, count(*) AS transaction_count
            FROM fact_expense e JOIN dim_department d ON e.dept_id = d.dept_id GROUP BY 1, 2))"""

_EMPLOYEES = """SELECT p.employee_name, CAST(p.employee_id AS BIGINT) AS employee_id, d.dept_name,
  count(e.invoice_id) AS expense_count, CAST(sum(e.amount) AS DOUBLE) AS total_expenses,
  CAST(sum(e.amount) AS DOUBLE) / count(e.amount) AS avg_expense_amount,
  CAST(max(e.amount) AS DOUBLE) AS max_expense_amount, min(e.trx_date) AS first_expense_date,
  max(e.trx_date) AS last_expense_date, count(DISTINCT v.vendor_id) AS unique_vendors,
  count(CASE WHEN c.is_weekend OR c.is_holiday THEN 1 END) AS weekend_holiday_expenses,
  count(CASE WHEN e.amount % 100 = 0 THEN 1 END) AS round_number_expenses
FROM fact_expense e JOIN dim_employee p ON e.employee_id = p.employee_id
JOIN dim_department d ON e.dept_id = d.dept_id JOIN dim_vendor v ON e.vendor_id = v.vendor_id
JOIN dim_calendar c ON e.trx_date = c.date GROUP BY 1, 2, 3"""

_ROI = """SELECT *, CASE WHEN roas > 3 THEN 'Excellent' WHEN roas > 2 THEN 'Good' WHEN roas > 1 THEN 'Break-even'
  ELSE 'Poor' END AS roi_category
FROM (SELECT k.campaign_name, CAST(k.campaign_id AS BIGINT) AS campaign_id, k.channel, k.objective,
        count(s.spend_id) AS spend_days, CAST(sum(s.cost) AS DOUBLE) AS total_cost,
        CAST(sum(s.clicks) AS BIGINT) AS total_clicks, CAST(sum(s.impressions) AS BIGINT) AS total_impressions,
        CAST(sum(s.conversions) AS BIGINT) AS total_conversions,
        CAST(sum(s.attributed_revenue) AS DOUBLE) AS total_revenue,
        round(CASE WHEN sum(s.cost) > 0 THEN CAST(sum(s.attributed_revenue) AS DOUBLE)
          / CAST(sum(s.cost) AS DOUBLE) ELSE 0 END, 6) AS roas,
        round(CASE WHEN sum(s.impressions) > 0 THEN CAST(sum(s.clicks) AS DOUBLE) / sum(s.impressions) * 100
          ELSE 0 END, 6) AS ctr_percentage,
        round(CASE WHEN sum(s.clicks) > 0 THEN CAST(sum(s.conversions) AS DOUBLE) / sum(s.clicks) * 100
          ELSE 0 END, 6) AS conversion_rate
      FROM fact_campaign_spend s JOIN dim_campaign k ON s.campaign_id = k.campaign_id GROUP BY 1, 2, 3, 4)"""

_DASHBOARD = """SELECT 'Budget Variance' AS metric_type,
  count(CASE WHEN variance_percentage > 10 THEN 1 END) AS high_risk_count,
  count(CASE WHEN variance_percentage BETWEEN -10 AND 10 THEN 1 END) AS normal_count,
  count(CASE WHEN variance_percentage < -10 THEN 1 END) AS low_risk_count FROM vw_budget
UNION ALL SELECT 'Vendor Concentration', count(CASE WHEN concentration_risk = 'High Risk' THEN 1 END),
  count(CASE WHEN concentration_risk = 'Medium Risk' THEN 1 END),
  count(CASE WHEN concentration_risk IN ('Low Risk', 'Minimal Risk') THEN 1 END) FROM vw_vendor
UNION ALL SELECT 'Leakage Signals', count(CASE WHEN risk_level IN ('Critical', 'High') THEN 1 END),
  count(CASE WHEN risk_level = 'Medium' THEN 1 END), count(CASE WHEN risk_level = 'Low' THEN 1 END)
FROM vw_flags"""

_TOP = """SELECT {columns} FROM (SELECT * FROM concentration ORDER BY total_spend DESC, vendor_id LIMIT {n})"""


def _long(section: str, source: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{section}' AS section, CAST(NULL AS VARCHAR) AS item, '{c}' AS metric, "
        f"round(CAST({c} AS DOUBLE), 4) AS value FROM ({source})"
        for c in columns
    )


def _top_rows() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT 'top_vendors', vendor_name, '{m}', round(CAST({m} AS DOUBLE), 4) FROM ("
        + _TOP.format(columns="*", n=5) + ")"
        for m in ("total_spend", "spend_percentage", "concentration_score")
    )


_REPORT = "\nUNION ALL\n".join([
    _long("expenses", f"SELECT {_EXPENSE_STATS} FROM fact_expense", [
        "total_transactions", "total_expenses", "avg_transaction_amount", "max_transaction_amount",
        "min_transaction_amount",
    ]),
    _long("leakage_detection", f"SELECT {_SIGNAL_STATS} FROM signals", [
        "total_signals", "high_risk_signals", "medium_risk_signals", "low_risk_signals", "avg_risk_score",
    ]),
    "SELECT 'leakage_by_rule', rule_name, 'signal_count', CAST(count(*) AS DOUBLE) FROM signals GROUP BY rule_name",
    _long("budget_analysis", f"SELECT {_BUDGET_STATS} FROM variance", [
        "total_budget", "total_actual", "total_variance", "avg_variance_pct", "over_budget_departments",
        "under_budget_departments",
    ]),
    _long("vendor_analysis", f"SELECT {_VENDOR_STATS} FROM concentration", [
        "total_vendors", "total_vendor_spend", "avg_spend_percentage", "max_spend_percentage",
        "high_risk_vendors",
    ]),
    _top_rows(),
    _long("leakage_estimate", _ESTIMATE, ["estimated_potential_leakage", "leakage_percentage"]),
])

_MONTH_TOTALS = """(SELECT budget_month_key AS m, CAST(sum(amount) AS DOUBLE) AS t FROM fact_expense
  WHERE budget_month_key IS NOT NULL GROUP BY 1)"""
_DAY_COUNTS = "(SELECT signal_date AS d, count(*) AS n FROM signals GROUP BY 1)"
_RULE_COUNTS = "(SELECT rule_name AS r, count(*) AS n FROM signals GROUP BY 1)"
_MONTH_BUDGETS = """(SELECT budget_month_key, CAST(sum(CAST(budget_amount AS DECIMAL(18,2))) AS DOUBLE) AS budget_amount,
  CAST(sum(CAST(actual_amount AS DECIMAL(18,2))) AS DOUBLE) AS actual_amount
  FROM variance WHERE budget_month_key IS NOT NULL GROUP BY 1)"""
_ALL_CHECKS = "\nUNION ALL\n".join([
    _expense_checks("expenses", "silver.expenses"), _BUDGET_CHECKS, _CAMPAIGN_CHECKS,
    _expense_checks("fact_expense", "gold.fact_expense"),
])

BODIES: dict[str, str] = {
    "clean_expenses": f"SELECT {_CLEAN}, source_file FROM expenses",
    "clean_expenses_flawed": f"""SELECT {_CLEAN}, 'lineitem' AS source_file FROM (
  SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY trx_date NULLS FIRST, amount NULLS FIRST,
    vendor_id NULLS FIRST, vendor_name NULLS FIRST, employee_id NULLS FIRST, employee_name NULLS FIRST,
    dept_id NULLS FIRST, dept_name NULLS FIRST, currency NULLS FIRST, payment_method NULLS FIRST,
    description NULLS FIRST) AS rn
  FROM flawed_expenses WHERE invoice_id IS NOT NULL AND amount > 0 AND trx_date IS NOT NULL) WHERE rn = 1""",
    "clean_budgets": """SELECT CAST(dept_id AS BIGINT) AS dept_id, dept_name, budget_month,
  CAST(budget_amount AS DOUBLE) AS budget_amount, currency, source_file FROM budgets""",
    "clean_campaign_spend": """SELECT spend_id, CAST(campaign_id AS BIGINT) AS campaign_id, campaign_name,
  channel, objective, date, CAST(cost AS DOUBLE) AS cost, clicks, impressions, conversions,
  CAST(attributed_revenue AS DOUBLE) AS attributed_revenue, source_file FROM campaign_spend""",
    "clean_calendar": "SELECT * FROM calendar",
    "csv_roundtrip": f"SELECT {_CLEAN} FROM expenses",
    "csv_inferred": """SELECT CAST(dept_id AS BIGINT) AS dept_id, count(*) AS budget_rows,
  CAST(sum(budget_amount) AS DOUBLE) AS budget_total FROM raw_budgets GROUP BY 1""",
    "numeric_coercion": """SELECT CAST(dept_id AS BIGINT) AS dept_id, count(a) AS numbers,
  count(*) - count(a) AS not_numbers, CAST(sum(CAST(a AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM (SELECT dept_id, TRY_CAST(CASE WHEN vendor_id % 2 = 0 THEN CAST(amount AS VARCHAR) ELSE 'n/a' END AS DOUBLE)
        AS a FROM expenses) GROUP BY 1""",
    **{name: _dim(name, *columns) for name, columns in _DIMS.items()},
    "fact_expense": f"SELECT {_FACT} FROM fact_expense",
    "fact_campaign_spend": f"SELECT {_SPEND} FROM fact_campaign_spend",
    "fact_budget": """SELECT CAST(dept_id AS BIGINT) AS dept_id, dept_name, budget_month,
  CAST(budget_amount AS DOUBLE) AS budget_amount, currency FROM budgets""",
    "partitioned_fact_scan": """SELECT budget_month_key, CAST(sum(amount) AS DOUBLE) AS total_expenses,
  count(*) AS expense_count, count(*) AS distinct_ids FROM fact_expense
WHERE budget_month_key >= '1998-01' GROUP BY 1""",
    "partitioned_campaign_scan": """SELECT spend_id, CAST(campaign_id AS BIGINT) AS campaign_id, date,
  CAST(cost AS DOUBLE) AS cost, clicks, impressions, conversions,
  CAST(attributed_revenue AS DOUBLE) AS attributed_revenue
FROM fact_campaign_spend WHERE date >= DATE '2024-01-15'""",
    "summary_monthly": _MONTHLY.format(avg=_mean("sum(amount)", "count(amount)")),
    "summary_dept": _DEPT,
    "summary_campaign": _CAMPAIGN.format(digits=6),
    "rule_duplicate": f"SELECT {SIGNAL} FROM duplicates",
    "rule_duplicate_amount": _NEAR,
    "rule_sub_threshold": f"SELECT {SIGNAL} FROM small_claims",
    "rule_weekend_holiday": f"SELECT {SIGNAL} FROM off_days",
    "rule_round_number": f"SELECT {SIGNAL} FROM round_numbers",
    "rule_campaign_spike": f"SELECT {SIGNAL} FROM spikes",
    "leakage_signals": f"SELECT {SIGNAL} FROM signals",
    "budget_variance": _VARIANCE,
    "budget_fallback": _FALLBACK,
    "vendor_concentration": f"""SELECT CAST(vendor_id AS BIGINT) AS vendor_id, vendor_name, total_spend,
  transaction_count, avg_transaction_amount,
  round(spend_percentage, 6) AS spend_percentage, concentration_score FROM concentration""",
    "metrics_expenses": f"SELECT {_EXPENSE_STATS} FROM fact_expense",
    "metrics_signals": f"SELECT {_SIGNAL_STATS} FROM signals",
    "metrics_by_rule": "SELECT rule_name, count(*) AS signal_count FROM signals GROUP BY 1",
    "metrics_budget": f"SELECT {_BUDGET_STATS} FROM variance",
    "metrics_vendors": f"SELECT {_VENDOR_STATS} FROM concentration",
    "metrics_top5": _TOP.format(
        columns="vendor_name, total_spend, round(spend_percentage, 6) AS spend_percentage, concentration_score", n=5
    ),
    "leakage_estimate": _ESTIMATE,
    "metrics_report": _REPORT,
    "dq_expenses": _expense_checks("expenses", "silver.expenses"),
    "dq_expenses_flawed": _expense_checks("flawed_expenses", "bronze.expenses"),
    "dq_budgets": _BUDGET_CHECKS,
    "dq_campaign": _CAMPAIGN_CHECKS,
    "dq_fact": _expense_checks("fact_expense", "gold.fact_expense"),
    "dq_summary": f"""SELECT count(*) AS total_checks, count(CASE WHEN passed THEN 1 END) AS passed,
  count(CASE WHEN NOT passed THEN 1 END) AS failed,
  round(CAST(count(CASE WHEN passed THEN 1 END) AS DOUBLE) / count(*) * 100, 6) AS pass_rate
FROM ({_ALL_CHECKS})""",
    "vw_budget_vs_actual": """SELECT dept_name, CAST(dept_id AS BIGINT) AS dept_id, budget_month, budget_amount,
  actual_amount, variance_amount, round(variance_percentage, 6) AS variance_percentage, budget_status
FROM vw_budget""",
    "vw_vendor_concentration": f"""SELECT vendor_name, CAST(vendor_id AS BIGINT) AS vendor_id, category,
  transaction_count, CAST(total AS DOUBLE) AS total_spend,
  {_mean('total', 'transaction_count')} AS avg_transaction_amount,
  round(spend_percentage, 6) AS spend_percentage, concentration_risk, vendor_rank FROM vw_vendor""",
    "vw_leakage_flags": "SELECT * FROM vw_flags",
    "vw_campaign_roi": _ROI,
    "vw_monthly_expense_trends": _TRENDS,
    "vw_employee_expense_analysis": _EMPLOYEES,
    "vw_risk_dashboard": _DASHBOARD,
    "insight_monthly_expenses": f"SELECT m AS budget_month_key, t AS total_expenses FROM {_MONTH_TOTALS}",
    "insight_monthly_expense_figures": f"""SELECT count(*) AS months, round(avg(t), 6) AS mean_month,
  (SELECT m FROM {_MONTH_TOTALS} ORDER BY t DESC, m LIMIT 1) AS highest_month, max(t) AS highest_total,
  (SELECT m FROM {_MONTH_TOTALS} ORDER BY t, m LIMIT 1) AS lowest_month, min(t) AS lowest_total,
  round(stddev_samp(t), 6) AS volatility FROM {_MONTH_TOTALS}""",
    "insight_signals_by_rule": f"""SELECT r AS rule_name, n AS signal_count,
  round(CAST(n AS DOUBLE) / (SELECT count(*) FROM signals) * 100, 6) AS share_pct FROM {_RULE_COUNTS}""",
    "insight_signals_by_rule_figures": f"""SELECT CAST(sum(n) AS BIGINT) AS total_signals,
  (SELECT r FROM {_RULE_COUNTS} ORDER BY n DESC, r LIMIT 1) AS top_rule, max(n) AS top_rule_signals,
  round(CAST(max(n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100, 6) AS top_rule_pct, count(*) AS active_rules,
  round(avg(n), 6) AS mean_per_rule FROM {_RULE_COUNTS}""",
    "insight_score_histogram": """SELECT bin, CAST((bin - 1) * 5 AS DOUBLE) AS bin_start, count(*) AS signal_count
FROM (SELECT CAST(floor(score / 5) AS BIGINT) + 1 AS bin FROM signals) GROUP BY 1, 2""",
    "insight_score_figures": """SELECT round(avg(score), 6) AS mean_score, median(score) AS median_score,
  round(stddev_samp(score), 6) AS stddev_score, count(CASE WHEN score >= 80 THEN 1 END) AS high_count,
  round(CAST(count(CASE WHEN score >= 80 THEN 1 END) AS DOUBLE) / count(*) * 100, 6) AS high_pct,
  count(CASE WHEN score >= 60 AND score < 80 THEN 1 END) AS medium_count,
  round(CAST(count(CASE WHEN score >= 60 AND score < 80 THEN 1 END) AS DOUBLE) / count(*) * 100, 6) AS medium_pct,
  count(CASE WHEN score < 60 THEN 1 END) AS low_count,
  round(CAST(count(CASE WHEN score < 60 THEN 1 END) AS DOUBLE) / count(*) * 100, 6) AS low_pct FROM signals""",
    "insight_signals_over_time": f"SELECT d AS signal_date, n AS signal_count FROM {_DAY_COUNTS}",
    "insight_signals_over_time_figures": f"""SELECT min(d) AS first_day, max(d) AS last_day,
  round(avg(n), 6) AS mean_per_day, (SELECT d FROM {_DAY_COUNTS} ORDER BY n DESC, d LIMIT 1) AS peak_day,
  max(n) AS peak_signals, count(*) AS active_days,
  CASE WHEN (SELECT n FROM {_DAY_COUNTS} ORDER BY d DESC LIMIT 1) > (SELECT n FROM {_DAY_COUNTS} ORDER BY d LIMIT 1)
       THEN 'Increasing'
       WHEN (SELECT n FROM {_DAY_COUNTS} ORDER BY d DESC LIMIT 1) < (SELECT n FROM {_DAY_COUNTS} ORDER BY d LIMIT 1)
       THEN 'Decreasing' ELSE 'Stable' END AS trend FROM {_DAY_COUNTS}""",
    "insight_budget_variance_figures": """SELECT n AS department_months, o AS over_budget,
  round(CAST(o AS DOUBLE) / n * 100, 6) AS over_budget_pct, u AS under_budget,
  round(CAST(u AS DOUBLE) / n * 100, 6) AS under_budget_pct, k AS on_target,
  round(CAST(k AS DOUBLE) / n * 100, 6) AS on_target_pct, round(mean, 6) AS mean_variance_pct,
  (SELECT dept_name FROM variance ORDER BY variance_percentage DESC, dept_name LIMIT 1) AS highest_department,
  round(top, 6) AS highest_variance_pct
FROM (SELECT count(*) AS n, count(CASE WHEN variance_percentage > 10 THEN 1 END) AS o,
        count(CASE WHEN variance_percentage < -10 THEN 1 END) AS u,
        count(CASE WHEN variance_percentage >= -10 AND variance_percentage <= 10 THEN 1 END) AS k,
        avg(variance_percentage) AS mean, max(variance_percentage) AS top FROM variance)""",
    "insight_monthly_budget": f"SELECT * FROM {_MONTH_BUDGETS}",
    "insight_monthly_budget_figures": f"""SELECT b AS total_budget, a AS total_actual,
  round(CASE WHEN b > 0 THEN d / b * 100 ELSE 0 END, 6) AS overall_variance_pct,
  round(mb, 6) AS mean_month_budget, round(ma, 6) AS mean_month_actual, n AS months
FROM (SELECT CAST(sum(CAST(budget_amount AS DECIMAL(18,2))) AS DOUBLE) AS b,
        CAST(sum(CAST(actual_amount AS DECIMAL(18,2))) AS DOUBLE) AS a,
        CAST(sum(CAST(actual_amount AS DECIMAL(18,2))) - sum(CAST(budget_amount AS DECIMAL(18,2))) AS DOUBLE) AS d,
        avg(budget_amount) AS mb, avg(actual_amount) AS ma, count(*) AS n FROM {_MONTH_BUDGETS})""",
    "insight_top_vendors": _TOP.format(
        columns="CAST(vendor_id AS BIGINT) AS vendor_id, vendor_name, total_spend, "
        "round(spend_percentage, 6) AS spend_percentage", n=10,
    ),
    "insight_top_vendor_figures": f"""SELECT count(*) AS total_vendors,
  CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) AS all_spend,
  round(CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS mean_vendor_spend,
  max(total_spend) AS top_vendor_spend,
  (SELECT vendor_name FROM concentration ORDER BY total_spend DESC, vendor_id LIMIT 1) AS top_vendor,
  round((SELECT CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) FROM ({_TOP.format(columns='*', n=10)}))
    / CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) * 100, 6) AS listed_share_pct
FROM concentration""",
    "insight_vendor_risk": """SELECT CASE WHEN concentration_score >= 70 THEN 'High'
    WHEN concentration_score >= 50 THEN 'Medium' ELSE 'Low' END AS risk_band, count(*) AS vendor_count,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM concentration) * 100, 6) AS share_pct
FROM concentration GROUP BY 1""",
    "insight_rule_names": "SELECT DISTINCT rule_name FROM signals",
    "insight_signal_listing": """SELECT rule_name, entity_type, entity_name, signal_date, score, details
FROM small_claims WHERE score >= 80""",
    "insight_headline": """SELECT count(*) AS leakage_signals,
  count(CASE WHEN score >= 80 THEN 1 END) AS high_risk_signals,
  (SELECT CAST(sum(amount) AS DOUBLE) FROM fact_expense) AS total_expenses,
  (SELECT count(*) FROM concentration) AS active_vendors FROM signals""",
    **{f"contract_{name}": _dim(name, *columns) for name, columns in _DIMS.items()},
    "contract_fact_expense": f"SELECT {_FACT} FROM fact_expense",
    "contract_fact_campaign_spend": f"SELECT {_SPEND} FROM fact_campaign_spend",
    "contract_fact_leakage_signal": f"SELECT {SIGNAL} FROM signals",
    "contract_summary_monthly": _MONTHLY.format(
        avg=f"CAST(CAST({_decimal_mean('sum(amount)', 'count(amount)')} AS DECIMAL(18,2)) AS DOUBLE)"
    ),
    "contract_summary_dept": _DEPT,
    "contract_summary_campaign": _CAMPAIGN.format(digits=4),
    "load_contract": """SELECT CAST(vendor_id AS BIGINT) AS vendor_id, count(*) AS loaded_rows,
  CAST(sum(amount) AS DOUBLE) AS loaded_amount FROM fact_expense GROUP BY 1""",
    "load_contract_second": """SELECT CAST(dept_id AS BIGINT) AS dept_id, 2 * count(*) AS loaded_rows,
  2 * count(*) AS distinct_keys, CAST(2 * sum(budget_amount) AS DOUBLE) AS loaded_amount FROM budgets GROUP BY 1""",
    "quarantine_rows": """SELECT status, reason, unparsed, count(*) AS row_count, count(CASE WHEN status IN ('rejected', 'repaired') THEN 1 END) AS kept_lines
FROM (
  SELECT CASE WHEN l_quantity IN (1, 2, 3, 6) THEN 'rejected' WHEN l_quantity IN (4, 5) THEN 'repaired' END AS status,
    CASE l_quantity WHEN 1 THEN 'amount does not fit' WHEN 6 THEN 'amount does not fit' WHEN 2 THEN 'trx_date does not fit'
      WHEN 3 THEN 'invoice_id missing' END AS reason,
    CASE l_quantity WHEN 1 THEN 'amount' WHEN 6 THEN 'amount' WHEN 2 THEN 'trx_date' WHEN 4 THEN 'vendor_id' WHEN 5 THEN 'dept_id' ELSE '' END AS unparsed
  FROM raw_expenses WHERE l_quantity <= 6
  UNION ALL
  SELECT CASE nth WHEN 1 THEN 'clean' ELSE 'duplicate' END, NULL, NULL
  FROM (SELECT row_number() OVER (PARTITION BY invoice_id) AS nth FROM raw_expenses WHERE l_quantity NOT IN (1, 2, 3, 6))
) GROUP BY 1, 2, 3""",
    "load_rebuilt": """SELECT budget_month_key, count(*) AS loaded_rows, count(*) AS distinct_keys,
  CAST(sum(amount) AS DOUBLE) AS loaded_amount FROM fact_expense GROUP BY 1""",
    "load_lasting_keys": """SELECT CAST(v.vendor_id AS BIGINT) AS vendor_id,
  row_number() OVER (ORDER BY v.vendor_id % 2 <> 0, v.vendor_id) AS vendor_key, upper(v.vendor_name) AS vendor_name,
  nullif((SELECT count(*) FROM fact_expense e WHERE e.vendor_id = v.vendor_id), 0) AS expense_count FROM dim_vendor v""",
    "clean_rejects": """SELECT 'expenses' AS table_name, reason, count(*) AS row_count FROM (
  SELECT CASE WHEN invoice_id IS NULL THEN 'invoice_id missing' WHEN trx_date IS NULL THEN 'trx_date missing'
    WHEN amount IS NULL THEN 'amount missing' WHEN amount <= 0 THEN 'amount not positive' END AS reason
  FROM flawed_expenses) WHERE reason IS NOT NULL GROUP BY 2""",
    "fallback_budgets": """SELECT CAST(b.dept_id AS BIGINT) AS dept_id, b.dept_name, b.budget_month,
  CAST(b.budget AS DOUBLE) AS budget_amount, (SELECT count(*) FROM fact_expense e WHERE e.dept_id = b.dept_id) AS expense_count
FROM (VALUES (1, 'Engineering', '2024-01', 150000), (2, 'Marketing', '2024-01', 120000), (3, 'Sales', '2024-01', 100000),
  (4, 'Finance', '2024-01', 80000), (5, 'HR', '2024-01', 60000), (6, 'Operations', '2024-01', 90000),
  (7, 'Legal', '2024-01', 70000)) AS b(dept_id, dept_name, budget_month, budget)""",
}


def all_oracles() -> dict[str, str]:
    return {name: f"{BASE}\n{body}" for name, body in BODIES.items()}
