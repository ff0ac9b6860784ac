"""The same queries as SQL over the given tables, for comparison with DuckDB.

Common table expressions are listed once, in dependency order; each query takes
the ones it needs.
"""

from __future__ import annotations

import re

_LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


def _pad(prefix: str, column: str, width: int) -> str:
    """NULL stays NULL, and numbers longer than the width are kept whole."""
    return f"'{prefix}' || lpad({column}::VARCHAR, greatest({width}, length({column}::VARCHAR))::INTEGER, '0')"


# Half-even rounding of a decimal with four places, in whole numbers.
def _half_even(product: str) -> str:
    return f"round_even({product}, 2)::DECIMAL(18,2)"


_CTES: dict[str, str] = {
    "branches": f"""
        SELECT {_pad('BR', 'n_nationkey', 3)} AS branch_id, n_name AS branch_name, r_name AS region
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "products": f"""
        SELECT {_pad('PRD', 'p_partkey', 6)} AS product_id, p_name AS product_name, p_type AS product_type,
               p_size::VARCHAR AS base_rate
        FROM part""",
    "customers": f"""
        SELECT {_pad('CUST', 'c_custkey', 6)} AS customer_id,
               split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               {_pad('BR', 'c_nationkey', 3)} AS branch_id,
               (DATE '2020-01-01' + (c_custkey % 700)::INTEGER)::DATE AS signup_date,
               (c_acctbal::DECIMAL(18,2) * 20)::DECIMAL(18,2) AS monthly_income,
               lower(c_mktsegment) AS employment_status
        FROM customer""",
    "s_customers": """
        SELECT customer_id,
               upper(left(first_name, 1)) || lower(substr(first_name, 2)) AS first_name,
               upper(left(last_name, 1)) || lower(substr(last_name, 2)) AS last_name,
               gender, NULL::DATE AS date_of_birth, '' AS phone_number, '' AS email, '' AS national_id,
               branch_id, signup_date, monthly_income, employment_status
        FROM customers WHERE monthly_income > 0""",
    "loans": f"""
        SELECT {_pad('LN', 'o_orderkey', 7)} AS loan_id, {_pad('CUST', 'o_custkey', 6)} AS customer_id,
               {_pad('PRD', 'p_partkey', 6)} AS product_id, {_pad('BR', 'c_nationkey', 3)} AS branch_id,
               (o_orderdate::DATE - 5)::DATE AS application_date, o_orderdate::DATE AS disbursement_date,
               o_totalprice::DECIMAL(18,2) AS loan_amount, p_size AS interest_rate,
               left(o_orderpriority, 1)::INTEGER * 3 AS term_months,
               CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' WHEN o_orderstatus = 'O' THEN 'ACTIVE'
                    WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'DEFAULTED'
                    WHEN o_orderstatus = 'P' THEN 'OVERDUE' END AS loan_status,
               (o_orderdate::DATE + left(o_orderpriority, 1)::INTEGER * 90)::DATE AS due_date
        FROM orders
        LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS first_part FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
        LEFT JOIN part ON p_partkey = first_part
        LEFT JOIN customer ON c_custkey = o_custkey""",
    "t_loans": """
        SELECT l.*, concat_ws('|',
                 CASE WHEN l.product_id IS NULL THEN 'product_id' END,
                 CASE WHEN l.loan_amount <= 0 THEN 'loan_amount' END,
                 CASE WHEN coalesce(l.interest_rate, 0) <= 0 THEN 'interest_rate' END,
                 CASE WHEN l.term_months <= 0 THEN 'term_months' END,
                 CASE WHEN l.loan_status IS NULL THEN 'loan_status' END,
                 CASE WHEN c.customer_id IS NULL THEN 'unknown_customer_id' END,
                 CASE WHEN p.product_id IS NULL THEN 'unknown_product_id' END,
                 CASE WHEN b.branch_id IS NULL THEN 'unknown_branch_id' END) AS error_reason
        FROM loans l
        LEFT JOIN s_customers c ON c.customer_id = l.customer_id
        LEFT JOIN products p ON p.product_id = l.product_id
        LEFT JOIN branches b ON b.branch_id = l.branch_id""",
    "s_loans": """
        SELECT loan_id, customer_id, product_id, branch_id, application_date, disbursement_date, loan_amount,
               interest_rate::DECIMAL(18,2) AS interest_rate, term_months::BIGINT AS term_months, loan_status, due_date
        FROM t_loans WHERE error_reason = ''""",
    "repayments": f"""
        SELECT {_pad('RP', 'l_orderkey', 7)} || lpad(l_linenumber::VARCHAR, 2, '0') AS repayment_id,
               {_pad('LN', 'l_orderkey', 7)} AS loan_id, {_pad('CUST', 'o_custkey', 6)} AS customer_id,
               l_shipdate::DATE AS repayment_date,
               {_half_even('l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(18,2))')} AS amount_paid,
               CASE WHEN l_returnflag = 'A' THEN 'mpesa' ELSE 'bank_transfer' END AS payment_channel,
               row_number() OVER (ORDER BY {_LINE_ORDER}) AS seq
        FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag <> 'R'""",
    "v_repayments": """
        SELECT r.*, r.amount_paid <= 0 AS bad_amount, l.loan_id IS NULL AS no_loan, c.customer_id IS NULL AS no_customer
        FROM repayments r
        LEFT JOIN s_loans l ON l.loan_id = r.loan_id
        LEFT JOIN s_customers c ON c.customer_id = r.customer_id""",
    "t_repayments": """
        SELECT *, concat_ws('|',
                 CASE WHEN bad_amount THEN 'amount_paid' END,
                 CASE WHEN seq > first_ok THEN 'duplicate_repayment_id' END,
                 CASE WHEN no_loan THEN 'unknown_loan_id' END,
                 CASE WHEN no_customer THEN 'unknown_customer_id' END) AS error_reason
        FROM (SELECT *, min(CASE WHEN NOT bad_amount AND NOT no_loan AND NOT no_customer THEN seq END)
                        OVER (PARTITION BY repayment_id) AS first_ok
              FROM v_repayments)""",
    "s_repayments": """
        SELECT repayment_id, loan_id, customer_id, repayment_date, amount_paid, payment_channel
        FROM t_repayments WHERE error_reason = ''""",
    "collections": f"""
        SELECT {_pad('COL', 'l_orderkey', 7)} || lpad(l_linenumber::VARCHAR, 2, '0') AS collection_id,
               {_pad('LN', 'l_orderkey', 7)} AS loan_id, {_pad('CUST', 'o_custkey', 6)} AS customer_id,
               {_pad('AGT', 'l_suppkey', 4)} AS collector_id, l_shipdate::DATE AS action_date,
               CASE WHEN l_linestatus = 'F' THEN 'call' ELSE 'sms' END AS action_type,
               {_half_even('l_extendedprice::DECIMAL(18,2) * l_tax::DECIMAL(18,2)')} AS amount_recovered,
               CASE WHEN l_linestatus = 'F' THEN 'contacted' ELSE 'no_response' END AS outcome,
               row_number() OVER (ORDER BY {_LINE_ORDER}) AS seq
        FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'""",
    "v_collections": """
        SELECT k.*, k.amount_recovered < 0 AS bad_amount, l.loan_id IS NULL AS no_loan, c.customer_id IS NULL AS no_customer
        FROM collections k
        LEFT JOIN s_loans l ON l.loan_id = k.loan_id
        LEFT JOIN s_customers c ON c.customer_id = k.customer_id""",
    "t_collections": """
        SELECT *, concat_ws('|',
                 CASE WHEN bad_amount THEN 'negative_amount_recovered' END,
                 CASE WHEN seq > first_ok THEN 'duplicate_collection_id' END,
                 CASE WHEN no_loan THEN 'unknown_loan_id' END,
                 CASE WHEN no_customer THEN 'unknown_customer_id' END) AS error_reason
        FROM (SELECT *, min(CASE WHEN NOT bad_amount AND NOT no_loan AND NOT no_customer THEN seq END)
                        OVER (PARTITION BY collection_id) AS first_ok
              FROM v_collections)""",
    "s_collections": """
        SELECT collection_id, loan_id, customer_id, collector_id, action_date, action_type, amount_recovered, outcome
        FROM t_collections WHERE error_reason = ''""",
    "movements": f"""
        SELECT event_id, {_pad('TXN', 'event_id', 8)} AS transaction_id, {_pad('CUST', 'user_id', 6)} AS customer_id,
               ts AS event_time,
               CASE event_type WHEN 'purchase' THEN 'cash_out' WHEN 'click' THEN 'cash_in' WHEN 'view' THEN 'transfer'
                    WHEN 'signup' THEN 'merchant_payment' WHEN 'error' THEN 'loan_repayment' END AS transaction_type,
               (value::DECIMAL(18,2) * 1000)::DECIMAL(18,2) AS amount, 'mobile_app' AS channel,
               json_extract_string(props, '$.k') AS merchant_category
        FROM events""",
    "scored": """
        SELECT *, 20 + CASE WHEN amount >= 150000 THEN 45 WHEN amount >= 80000 THEN 25 ELSE 0 END
                     + CASE WHEN transaction_type = 'cash_out' THEN 15 ELSE 0 END AS base,
               CASE WHEN transaction_type = 'cash_out' AND amount >= 80000 THEN 'risky_cash_out'
                    ELSE 'high_value_transaction' END AS rule_name
        FROM movements""",
    "t_mobile_transactions": """
        SELECT m.*, concat_ws('|',
                 CASE WHEN m.transaction_type IS NULL THEN 'transaction_type' END,
                 CASE WHEN coalesce(m.amount, 0) <= 0 THEN 'amount' END,
                 CASE WHEN c.customer_id IS NULL THEN 'unknown_customer_id' END) AS error_reason
        FROM movements m LEFT JOIN s_customers c ON c.customer_id = m.customer_id""",
    "s_mobile_transactions": """
        SELECT transaction_id, customer_id, event_time::DATE AS transaction_date, transaction_type, amount, channel,
               lower(coalesce(merchant_category, '')) AS merchant_category
        FROM t_mobile_transactions WHERE error_reason = ''""",
    "fraud_alerts": f"""
        SELECT {_pad('ALT', 'event_id', 8)} AS alert_id, transaction_id, customer_id, event_time AS alert_timestamp,
               'large_or_risky_cash_movement' AS rule_name, base AS risk_score, 'OPEN' AS alert_status
        FROM scored WHERE amount >= 150000 OR (transaction_type = 'cash_out' AND amount >= 90000)""",
    "t_fraud_alerts": """
        SELECT f.*, CASE WHEN c.customer_id IS NULL THEN 'unknown_customer_id' ELSE '' END AS error_reason
        FROM fraud_alerts f LEFT JOIN s_customers c ON c.customer_id = f.customer_id""",
    "s_fraud_alerts": """
        SELECT alert_id, transaction_id, customer_id, alert_timestamp, rule_name, risk_score::BIGINT AS risk_score,
               alert_status
        FROM t_fraud_alerts WHERE error_reason = ''""",
    "paid": "SELECT loan_id, sum(amount_paid)::DECIMAL(28,2) AS amount_repaid FROM s_repayments GROUP BY 1",
    "recovered": "SELECT loan_id, sum(amount_recovered)::DECIMAL(28,2) AS amount_recovered FROM s_collections GROUP BY 1",
    "balances": """
        SELECT l.*, coalesce(p.amount_repaid, 0)::DECIMAL(28,2) AS amount_repaid,
               coalesce(r.amount_recovered, 0)::DECIMAL(28,2) AS amount_recovered,
               greatest(l.loan_amount - coalesce(p.amount_repaid, 0) - coalesce(r.amount_recovered, 0), 0)::DECIMAL(18,2)
                 AS outstanding_amount
        FROM s_loans l LEFT JOIN paid p ON p.loan_id = l.loan_id LEFT JOIN recovered r ON r.loan_id = l.loan_id""",
    "rollup_loans": """
        SELECT customer_id, count(*) FILTER (loan_status = 'DEFAULTED') AS defaulted_loans,
               sum(loan_amount)::DECIMAL(28,2) AS total_disbursed
        FROM s_loans GROUP BY 1""",
    "statuses": """
        SELECT loan_status FROM s_loans
        UNION SELECT 'ACTIVE' UNION SELECT 'CLOSED' UNION SELECT 'OVERDUE' UNION SELECT 'DEFAULTED'""",
    "g_dim_customer": """
        SELECT row_number() OVER (ORDER BY c.customer_id) AS customer_key, c.customer_id,
               c.first_name || ' ' || c.last_name AS full_name, c.gender, c.branch_id, c.signup_date, c.monthly_income,
               CASE WHEN coalesce(r.defaulted_loans, 0) > 0 THEN 'high_risk' WHEN c.monthly_income >= 150000 THEN 'premium'
                    WHEN c.monthly_income >= 70000 THEN 'mass_affluent' ELSE 'emerging' END AS customer_segment,
               CASE WHEN coalesce(r.total_disbursed, 0) >= 1000000 THEN 'high_utilization'
                    WHEN coalesce(r.total_disbursed, 0) >= 250000 THEN 'moderate_utilization'
                    WHEN coalesce(r.total_disbursed, 0) > 0 THEN 'low_utilization' ELSE 'no_loans' END AS loan_utilization_band,
               c.signup_date AS effective_from, NULL::DATE AS effective_to, TRUE AS is_current
        FROM s_customers c LEFT JOIN rollup_loans r ON r.customer_id = c.customer_id""",
    "g_dim_product": """
        SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name, product_type,
               base_rate::DECIMAL(18,2) AS base_rate
        FROM products""",
    "g_dim_branch": """
        SELECT row_number() OVER (ORDER BY branch_id) AS branch_key, branch_id, branch_name, region FROM branches""",
    "g_dim_loan_status": """
        SELECT row_number() OVER (ORDER BY loan_status) AS loan_status_key, loan_status FROM statuses""",
    "g_dim_date": """
        SELECT strftime(full_date, '%Y%m%d')::INTEGER AS date_key, full_date, year(full_date)::INTEGER AS year,
               quarter(full_date)::INTEGER AS quarter, month(full_date)::INTEGER AS month,
               day(full_date)::INTEGER AS day, dayname(full_date) AS day_name
        FROM (SELECT disbursement_date AS full_date FROM s_loans UNION SELECT repayment_date FROM s_repayments
              UNION SELECT action_date FROM s_collections UNION SELECT transaction_date FROM s_mobile_transactions)""",
    "g_fact_loan_disbursement": """
        SELECT f.loan_id, c.customer_key, p.product_key, b.branch_key, s.loan_status_key,
               strftime(f.disbursement_date, '%Y%m%d')::INTEGER AS disbursement_date_key, f.loan_amount, f.amount_repaid,
               f.amount_recovered, f.outstanding_amount, f.term_months, f.interest_rate
        FROM balances f
        JOIN (SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key FROM s_customers) c USING (customer_id)
        JOIN g_dim_product p USING (product_id) JOIN g_dim_branch b USING (branch_id)
        JOIN g_dim_loan_status s USING (loan_status)""",
    "customer_keys": """
        SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key FROM s_customers""",
    "g_fact_repayments": """
        SELECT repayment_id, loan_id, customer_key, strftime(repayment_date, '%Y%m%d')::INTEGER AS repayment_date_key,
               amount_paid, payment_channel
        FROM s_repayments JOIN customer_keys USING (customer_id)""",
    "g_fact_collections": """
        SELECT collection_id, loan_id, customer_key, strftime(action_date, '%Y%m%d')::INTEGER AS action_date_key,
               collector_id, action_type, amount_recovered, outcome
        FROM s_collections JOIN customer_keys USING (customer_id)""",
    "g_fact_transactions": """
        SELECT transaction_id, customer_key, strftime(transaction_date, '%Y%m%d')::INTEGER AS transaction_date_key,
               transaction_type, amount, channel, merchant_category
        FROM s_mobile_transactions JOIN customer_keys USING (customer_id)""",
    "totals": """
        SELECT sum(outstanding_amount)::DECIMAL(38,2) AS book, sum(loan_amount)::DECIMAL(38,2) AS disbursed,
               sum(amount_repaid)::DECIMAL(38,2) AS repaid, sum(amount_recovered)::DECIMAL(38,2) AS recovered_sum,
               coalesce(sum(outstanding_amount) FILTER (loan_status = 'OVERDUE'), 0)::DECIMAL(38,2) AS overdue,
               count(*) FILTER (loan_status = 'ACTIVE') AS active, count(*) FILTER (loan_status = 'DEFAULTED') AS defaulted
        FROM balances""",
    "g_portfolio_summary": """
        SELECT 'total_loan_book' AS metric, book::VARCHAR AS value FROM totals
        UNION ALL SELECT 'total_disbursed', disbursed::VARCHAR FROM totals
        UNION ALL SELECT 'total_repaid', repaid::VARCHAR FROM totals
        UNION ALL SELECT 'total_recovered', recovered_sum::VARCHAR FROM totals
        UNION ALL SELECT 'overdue_principal', overdue::VARCHAR FROM totals
        UNION ALL SELECT 'repayment_rate_pct',
          coalesce(round(repaid * 100 / nullif(disbursed, 0), 2), 0)::DECIMAL(38,2)::VARCHAR FROM totals
        UNION ALL SELECT 'recovery_rate_pct',
          CASE WHEN book = 0 THEN 0 ELSE round(recovered_sum * 100 / (recovered_sum + book), 2) END::DECIMAL(38,2)::VARCHAR
          FROM totals
        UNION ALL SELECT 'active_loans', active::VARCHAR FROM totals
        UNION ALL SELECT 'defaulted_loans', defaulted::VARCHAR FROM totals""",
    "q_customers": """
        SELECT customer_id, first_name, last_name, gender, NULL::VARCHAR AS date_of_birth, NULL::VARCHAR AS phone_number,
               NULL::VARCHAR AS email, NULL::VARCHAR AS national_id, branch_id, signup_date::VARCHAR AS signup_date,
               monthly_income::VARCHAR AS monthly_income, employment_status, 'monthly_income' AS error_reason
        FROM customers WHERE monthly_income <= 0""",
    "q_loans": """
        SELECT loan_id, customer_id, product_id, branch_id, application_date::VARCHAR AS application_date,
               disbursement_date::VARCHAR AS disbursement_date, loan_amount::VARCHAR AS loan_amount,
               interest_rate::VARCHAR AS interest_rate, term_months::VARCHAR AS term_months, loan_status,
               due_date::VARCHAR AS due_date, error_reason
        FROM t_loans WHERE error_reason <> ''""",
    "q_repayments": """
        SELECT repayment_id, loan_id, customer_id, repayment_date::VARCHAR AS repayment_date,
               amount_paid::VARCHAR AS amount_paid, payment_channel, error_reason
        FROM t_repayments WHERE error_reason <> ''""",
    "q_collections": """
        SELECT collection_id, loan_id, customer_id, collector_id, action_date::VARCHAR AS action_date, action_type,
               amount_recovered::VARCHAR AS amount_recovered, outcome, error_reason
        FROM t_collections WHERE error_reason <> ''""",
    "q_mobile_transactions": """
        SELECT transaction_id, customer_id, event_time::DATE::VARCHAR AS transaction_date, transaction_type,
               amount::VARCHAR AS amount, channel, merchant_category, error_reason
        FROM t_mobile_transactions WHERE error_reason <> ''""",
    "q_fraud_alerts": """
        SELECT alert_id, transaction_id, customer_id, alert_timestamp::VARCHAR AS alert_timestamp, rule_name,
               risk_score::VARCHAR AS risk_score, alert_status, error_reason
        FROM t_fraud_alerts WHERE error_reason <> ''""",
    "q_products": "SELECT *, '' AS error_reason FROM products WHERE FALSE",
    "q_branches": "SELECT *, '' AS error_reason FROM branches WHERE FALSE",
    "line_rows": f"""
        SELECT *, {_pad('LN', 'l_orderkey', 7)} || '-' || l_linenumber AS line_key FROM lineitem""",
    "latest_lines": f"""
        SELECT line_key, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM line_rows
        QUALIFY row_number() OVER (PARTITION BY line_key ORDER BY l_shipdate DESC, {_LINE_ORDER.split(', ', 1)[1]}) = 1""",
}


_UNKNOWN_CUSTOMER = "customer_id NOT IN (SELECT customer_id FROM s_customers)"


def _alerts(threshold: int, skip: str = _UNKNOWN_CUSTOMER) -> str:
    """Sequential scoring as a recursive walk over each customer's events."""
    return f"""
        WITH RECURSIVE {_needed('scored ' + skip)},
        numbered AS MATERIALIZED (
          SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_time, event_id) AS n
          FROM scored WHERE NOT ({skip}) AND base + 20 >= {threshold}),
        walk AS (
          SELECT n, event_id, transaction_id, customer_id, rule_name, least(base, 99) AS risk_score,
                 (least(base, 99) >= {threshold})::INTEGER AS alerts, least(base, 99) >= {threshold} AS fired
          FROM numbered WHERE n = 1
          UNION ALL
          SELECT e.n, e.event_id, e.transaction_id, e.customer_id, e.rule_name,
                 least(e.base + least(5 * w.alerts, 20), 99),
                 w.alerts + (least(e.base + least(5 * w.alerts, 20), 99) >= {threshold})::INTEGER,
                 least(e.base + least(5 * w.alerts, 20), 99) >= {threshold}
          FROM walk w JOIN numbered e ON e.customer_id = w.customer_id AND e.n = w.n + 1)
        SELECT 'STREAM-' || {_pad('', 'event_id', 12)} AS alert_id, transaction_id, customer_id, rule_name,
               risk_score::INTEGER AS risk_score, 'OPEN' AS alert_status
        FROM walk WHERE fired"""


def _stream_log() -> str:
    """Events of known customers and their alerts, in two periods."""
    second = "(event_time >= TIMESTAMP '2024-01-16')"
    return f"""
        WITH {_needed('scored ' + _UNKNOWN_CUSTOMER)},
        e AS (SELECT transaction_id, 1 + {second}::INTEGER AS run FROM scored WHERE NOT ({_UNKNOWN_CUSTOMER})),
        a AS ({_alerts(75)})
        SELECT run, count(*) AS events_processed, count(a.transaction_id) AS alerts_emitted, 75 AS threshold
        FROM e LEFT JOIN a USING (transaction_id) GROUP BY run"""


def _alerts_of_repeats(threshold: int) -> str:
    """The same walk over events of which every third comes again; an event that has alerted is passed over."""
    return f"""
        WITH RECURSIVE {_needed('movements')},
        twice AS (
          SELECT event_id, transaction_id, customer_id, event_time, transaction_type, amount FROM movements
          UNION ALL
          SELECT event_id, transaction_id, customer_id, event_time + INTERVAL 1 HOUR, 'cash_out', amount * 2
          FROM movements WHERE event_id % 3 = 0),
        rescored AS ({_CTES['scored'].replace('FROM movements', 'FROM twice')}),
        numbered AS MATERIALIZED (
          SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_time, event_id, transaction_id, base) AS n
          FROM rescored WHERE base + 20 >= {threshold}),
        walk AS (
          SELECT n, event_id, transaction_id, customer_id, rule_name, least(base, 99) AS risk_score,
                 least(base, 99) >= {threshold} AS fired,
                 CASE WHEN least(base, 99) >= {threshold} THEN [event_id] ELSE [] END AS seen
          FROM numbered WHERE n = 1
          UNION ALL
          SELECT n, event_id, transaction_id, customer_id, rule_name, score, fired,
                 CASE WHEN fired THEN list_append(seen, event_id) ELSE seen END
          FROM (SELECT e.n, e.event_id, e.transaction_id, e.customer_id, e.rule_name, w.seen,
                       least(e.base + least(5 * len(w.seen), 20), 99) AS score,
                       least(e.base + least(5 * len(w.seen), 20), 99) >= {threshold}
                       AND NOT list_contains(w.seen, e.event_id) AS fired
                FROM walk w JOIN numbered e ON e.customer_id = w.customer_id AND e.n = w.n + 1))
        SELECT 'STREAM-' || {_pad('', 'event_id', 12)} AS alert_id, transaction_id, customer_id, rule_name,
               risk_score::INTEGER AS risk_score, 'OPEN' AS alert_status
        FROM walk WHERE fired"""


def _closure(sql: str) -> list[str]:
    """Names of the expressions that ``sql`` uses, directly or not, in dependency order."""
    wanted: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"[a-z_]+", pending.pop()))
        for name in words & (_CTES.keys() - wanted):
            wanted.add(name)
            pending.append(_CTES[name])
    return [name for name in _CTES if name in wanted]


def _needed(sql: str) -> str:
    return ", ".join(f"{name} AS ({_CTES[name]})" for name in _closure(sql))


def _query(sql: str) -> str:
    with_list = _needed(sql)
    return f"WITH {with_list} {sql}" if with_list else sql


_TABLES = ("branches", "products", "customers", "loans", "repayments", "mobile_transactions", "collections", "fraud_alerts")
_CHECKED = ("customers", "loans", "repayments", "mobile_transactions", "collections", "fraud_alerts")
_GOLD = (
    "dim_customer",
    "dim_product",
    "dim_branch",
    "dim_date",
    "dim_loan_status",
    "fact_loan_disbursement",
    "fact_repayments",
    "fact_collections",
    "fact_transactions",
    "portfolio_summary",
)


def _silver_name(table: str) -> str:
    return f"s_{table}" if table in _CHECKED else table


def _row_counts() -> str:
    parts = []
    for t in _TABLES:
        source = "movements" if t == "mobile_transactions" else t
        parts.append(f"SELECT 'bronze.{t}' AS name, count(*) AS row_count FROM {source}")
        parts.append(f"SELECT 'silver.{t}', count(*) FROM {_silver_name(t)}")
        parts.append(f"SELECT 'quarantine.{t}', count(*) FROM q_{t}")
    parts += [f"SELECT 'gold.{t}', count(*) FROM g_{t}" for t in _GOLD]
    return " UNION ALL ".join(parts)


def _issues() -> str:
    rejected = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n FROM q_{t}" for t in _TABLES)
    return f"""SELECT "table", 'records_quarantined' AS check_name, 'warning' AS severity,
        n || ' rejected records written to quarantine' AS message, n AS failed_count
        FROM ({rejected}) WHERE n > 0"""


def _constraints() -> str:
    from ..operators.quality import NOT_NULL, RELATIONSHIPS, UNIQUE

    parts = [
        f"SELECT 'not_null' AS test, '{t}' AS \"table\", '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS failures FROM g_{t}"
        for t, c in NOT_NULL
    ]
    parts += [
        f"SELECT 'unique', '{t}', '{c}', (SELECT count(*) FROM (SELECT {c} FROM g_{t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
        for t, c in UNIQUE
    ]
    parts += [
        f"SELECT 'relationships', '{t}', '{c}', (SELECT count(*) FROM g_{t} WHERE {c} NOT IN (SELECT {key} FROM g_{p} WHERE {key} IS NOT NULL))"
        for t, c, p, key in RELATIONSHIPS
    ]
    return " UNION ALL ".join(parts)


_LATEST = {
    "latest_customers": """
        SELECT customer_id, upper(left(first_name, 1)) || lower(substr(first_name, 2)) AS first_name,
               upper(left(last_name, 1)) || lower(substr(last_name, 2)) AS last_name, gender, NULL::DATE AS date_of_birth,
               '' AS phone_number, '' AS email, '' AS national_id, branch_id, signup_date, monthly_income, employment_status
        FROM customers""",
    "latest_loans": """
        SELECT loan_id, customer_id, coalesce(product_id, '') AS product_id, branch_id, application_date, disbursement_date,
               loan_amount, coalesce(interest_rate, 0)::DECIMAL(18,2) AS interest_rate, term_months::BIGINT AS term_months,
               loan_status, due_date
        FROM loans WHERE loan_amount > 0""",
    "latest_repayments": """
        SELECT repayment_id, loan_id, customer_id, repayment_date, amount_paid, payment_channel
        FROM repayments WHERE amount_paid > 0
        QUALIFY row_number() OVER (PARTITION BY repayment_id ORDER BY repayment_date DESC, seq) = 1""",
    "latest_mobile_transactions": """
        SELECT transaction_id, customer_id, event_time::DATE AS transaction_date, transaction_type, amount, channel,
               merchant_category
        FROM movements WHERE amount > 0""",
    "latest_collections": """
        SELECT collection_id, loan_id, customer_id, collector_id, action_date, action_type, amount_recovered, outcome
        FROM collections WHERE amount_recovered >= 0
        QUALIFY row_number() OVER (PARTITION BY collection_id ORDER BY action_date DESC, seq) = 1""",
}

_LINE_OUT = "line_key, l_partkey, l_suppkey, l_quantity, l_extendedprice"

ORACLE: dict[str, str] = {
    **{f"silver_{t}": _query(f"SELECT * FROM {_silver_name(t)}") for t in _TABLES},
    **{f"quarantine_{t}": _query(f"SELECT * FROM q_{t}") for t in _TABLES},
    **{name: _query(sql) for name, sql in _LATEST.items()},
    **{t: _query(f"SELECT * FROM g_{t}") for t in _GOLD},
    "dedupe_first_by_key": _query(
        f"SELECT {_LINE_OUT} FROM line_rows QUALIFY row_number() OVER (PARTITION BY line_key ORDER BY {_LINE_ORDER}) = 1"
    ),
    "dedupe_first_by_key_rejects": _query(
        f"SELECT {_LINE_OUT}, 'duplicate_or_missing_line_key' AS error_reason FROM line_rows "
        f"QUALIFY row_number() OVER (PARTITION BY line_key ORDER BY {_LINE_ORDER}) > 1"
    ),
    "duplicate_key_count": _query("SELECT count(*) - count(DISTINCT line_key) AS duplicate_count FROM line_rows"),
    "latest_by_key": _query("SELECT * FROM latest_lines"),
    "incremental_upsert": _query("SELECT * FROM latest_lines"),
    "incremental_collections": _query("SELECT * FROM s_collections"),
    "loan_rollup": _query("SELECT * FROM rollup_loans"),
    "repayments_by_loan": _query("SELECT * FROM paid"),
    "recoveries_by_loan": _query("SELECT * FROM recovered"),
    "loan_balances": _query(
        "SELECT loan_id, loan_amount, amount_repaid, amount_recovered, outstanding_amount FROM balances"
    ),
    "loan_statuses": _query("SELECT * FROM statuses"),
    "surrogate_key_range": f"""
        SELECT row_number() OVER (ORDER BY loan_id) AS loan_key, loan_id
        FROM (SELECT {_pad('LN', 'o_orderkey', 7)} AS loan_id FROM orders)""",
    "segment_bands": _query(
        "SELECT customer_segment, loan_utilization_band, count(*) AS customers FROM g_dim_customer GROUP BY 1, 2"
    ),
    "risk_score": _query(
        "SELECT transaction_id, least(base, 99)::INTEGER AS score_unaided, "
        "least(base + 15, 99)::INTEGER AS score_after_three, rule_name FROM scored"
    ),
    "sql_risk_score": _query(
        "SELECT transaction_id, least(base, 99)::INTEGER AS score_unaided, "
        "least(base + 15, 99)::INTEGER AS score_after_three FROM scored"
    ),
    "large_movements": _query(
        "SELECT transaction_id, customer_id, transaction_type, amount FROM movements "
        "WHERE amount >= 150000 OR (transaction_type = 'cash_out' AND amount >= 90000)"
    ),
    "alerts_batch": _alerts(75),
    "alerts_batch_60": _alerts(60),
    "alerts_incremental": _alerts(60, "base >= 80"),
    "alerts_repeated_events": _alerts_of_repeats(60),
    "alerts_stream": _alerts(75),
    "alerts_stream_log": _stream_log(),
    "quality_row_counts": _query(_row_counts()),
    "csv_run_counts": _query(_row_counts()),
    "quality_issues": _query(_issues()),
    "quality_status": _query(
        f"SELECT CASE WHEN count(*) > 0 THEN 'passed_with_warnings' ELSE 'passed' END AS status FROM ({_issues()})"
    ),
    "gold_constraint_tests": _query(_constraints()),
    "bronze_metadata": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, 'lineitem.parquet' AS source_file
        FROM lineitem""",
    "fact_repayments_by_year": _query(
        "SELECT repayment_date_key // 10000 AS year, count(*) AS repayments, sum(amount_paid)::DECIMAL(38,2) AS amount_paid "
        "FROM g_fact_repayments GROUP BY 1"
    ),
    "line_amounts_half_even": f"""
        SELECT l_orderkey, l_linenumber,
               {_half_even('l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(18,2))')} AS amount
        FROM lineitem""",
    "instalment_schedule": _query("""
        SELECT loan_id, i::INTEGER AS instalment,
               CASE WHEN i = n THEN due_date ELSE (disbursement_date + (30 * i)::INTEGER)::DATE END AS due_date,
               ((cents // n + CASE WHEN 2 * (cents % n) > n OR (2 * (cents % n) = n AND (cents // n) % 2 = 1) THEN 1 ELSE 0 END)
                 * 0.01::DECIMAL(18,2))::DECIMAL(18,2) AS amount_due
        FROM (SELECT loan_id, disbursement_date, due_date, (loan_amount * 100)::BIGINT AS cents,
                     greatest(coalesce((due_date - disbursement_date) // 30, 1), 1) AS n FROM s_loans), unnest(range(1, n + 1)) AS t(i)"""),
    "loan_due_dates": _query("""
        SELECT loan_id, disbursement_date, term_months,
               coalesce(due_date, (disbursement_date + (30 * term_months)::INTEGER)::DATE) AS due_date
        FROM s_loans"""),
}



def _changed(changes: dict[str, str], sql: str) -> str:
    """``sql`` over the expressions, of which those in ``changes`` are put around the usual ones at ``{}``."""
    made = [f"{name} AS ({changes.get(name, '{}').replace('{}', _CTES[name])})" for name in _closure(sql)]
    return f"WITH {', '.join(made)} {sql}"


ORACLE["faulty_rejects"] = _changed(
    {
        "collections": """SELECT * REPLACE (CASE WHEN substr(collection_id, 4)::BIGINT % 9 = 2 THEN -amount_recovered - 1
            ELSE amount_recovered END::DECIMAL(18,2) AS amount_recovered) FROM ({})"""
    },
    """SELECT 'collections' AS "table", collection_id AS key, error_reason FROM q_collections
    UNION ALL SELECT 'fraud_alerts', f.alert_id, concat_ws('|',
        CASE WHEN substr(f.alert_id, 4)::BIGINT % 5 = 1 THEN 'invalid_risk_score' END,
        CASE WHEN c.customer_id IS NULL THEN 'unknown_customer_id' END)
    FROM fraud_alerts f LEFT JOIN s_customers c USING (customer_id)
    WHERE c.customer_id IS NULL OR substr(f.alert_id, 4)::BIGINT % 5 = 1
    UNION ALL SELECT 'branches', branch_id, 'duplicate_branch_id' FROM branches WHERE substr(branch_id, 3)::BIGINT % 3 = 0
    UNION ALL SELECT 'products', ' ', 'product_id' FROM products WHERE substr(product_id, 4)::BIGINT % 50 = 0""",
)
_BROKEN = {
    "b_dim_customer": "SELECT * REPLACE (CASE WHEN customer_key % 10 <> 0 THEN customer_key END AS customer_key) FROM g_dim_customer",
    "b_dim_product": "SELECT p.* FROM g_dim_product p JOIN range(1, 3) AS twice(i) ON i = 1 OR product_key <= 5",
    "b_fact_loan_disbursement": """SELECT * REPLACE (CASE WHEN customer_key % 4 = 0 THEN customer_key + 1000000 ELSE customer_key END
        AS customer_key) FROM g_fact_loan_disbursement""",
}
ORACLE["broken_constraints"] = (
    f"WITH {_needed(_constraints())}, {', '.join(f'{n} AS ({sql})' for n, sql in _BROKEN.items())} "
    + re.sub(r"\bg_(?=dim_customer|dim_product|fact_loan)", "b_", _constraints())
)
ORACLE["audit_issues"] = _query(f"""
    SELECT 'failed' AS status, i.*, n AS bronze_rows
    FROM ({_issues()} UNION ALL SELECT 'repayments', 'row_count_reconciliation', 'error',
          'Accepted plus rejected rows does not equal source rows', 1) i
    JOIN ({" UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n FROM {'movements' if t == 'mobile_transactions' else t}" for t in _TABLES)})
    ON t = "table" """)
ORACLE["jsonl_alerts"] = _alerts(60)
ORACLE["sql_segments"] = _query("SELECT customer_id, customer_segment, loan_utilization_band FROM g_dim_customer")
# Newest date first, and at equal dates the later load.
ORACLE["incremental_load"] = _query("""
    SELECT * EXCLUDE (load), year(action_date)::INTEGER AS year FROM (
        SELECT *, 1 AS load FROM s_collections
        UNION ALL SELECT * REPLACE ((amount_recovered * 2)::DECIMAL(18,2) AS amount_recovered), 2
        FROM s_collections WHERE substr(collection_id, 4)::BIGINT % 7 = 0
        UNION ALL SELECT * REPLACE ((action_date + 400)::DATE AS action_date, (amount_recovered + 1)::DECIMAL(18,2) AS amount_recovered), 2
        FROM s_collections WHERE substr(collection_id, 4)::BIGINT % 11 = 3
        UNION ALL SELECT * REPLACE ((action_date - 400)::DATE AS action_date, 'too_old' AS outcome), 2
        FROM s_collections WHERE substr(collection_id, 4)::BIGINT % 13 = 5)
    QUALIFY row_number() OVER (PARTITION BY collection_id ORDER BY action_date DESC, load DESC) = 1""")
ORACLE["bucketed_segments"] = _query("""
    SELECT customer_segment, count(*) AS repayments, sum(amount_paid)::DECIMAL(38,2) AS amount_paid
    FROM g_fact_repayments JOIN g_dim_customer USING (customer_key) GROUP BY 1""")
ORACLE["customer_statements"] = _query("""
    SELECT customer_key, (repayment_date_key // 10000)::INTEGER AS year, count(*) AS repayments,
           sum(amount_paid)::DECIMAL(38,2) AS amount_paid
    FROM g_fact_repayments WHERE repayment_date_key // 10000 IN (1996, 1997, 2000, 2001) AND customer_key <= 100 GROUP BY 1, 2""")
ORACLE["catalog_summary"] = ORACLE["portfolio_summary"]
# The run over CSV extracts must give what the plans give over the tables.
ORACLE["csv_run_summary"] = ORACLE["portfolio_summary"]
ORACLE["csv_run_repayments_by_year"] = ORACLE["fact_repayments_by_year"]
