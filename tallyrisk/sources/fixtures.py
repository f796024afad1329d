"""Domain relations derived from the driver's star-schema test tables.

Each relation is one portable SQL statement that runs unchanged on Spark SQL
and on DuckDB, so the Spark operators and the independent SQL oracle start
from identical inputs; where ``SPARK_FROM`` has it, Spark makes the same joins in another order.  Base tables appear as ``{lineitem}``-style
placeholders: Spark binds them to DataFrames (``spark.sql(text, lineitem=df)``),
the oracle binds them to the pre-registered view names.

Money derived from sums is built from whole cents so both engines produce the
same doubles regardless of summation order.
"""
from __future__ import annotations

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# customer type of each market segment; 4 is the international type
_CUSTOMER_TYPE_ID = """CASE c.c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'AUTOMOBILE' THEN 2
      WHEN 'MACHINERY' THEN 3 WHEN 'HOUSEHOLD' THEN 4 WHEN 'FURNITURE' THEN 5 END"""

# Contract status options (status_index, type, status, display_name, status_short).
STATUS_OPTIONS = """SELECT * FROM (VALUES
  (0, 1, 'active', 'Active', 'ACT'),
  (1, 1, 'on_hold', 'On hold', 'HLD'),
  (2, 1, 'suspended', 'Suspended', 'SUS'),
  (3, 1, 'terminated', 'Terminated', 'TRM'),
  (0, 2, 'open', 'Open', 'OPN'),
  (1, 2, 'closed', 'Closed', 'CLS')
) AS t(status_index, type, status, display_name, status_short)"""

# Expense accounts of bill lines.
ACCOUNTS = """SELECT * FROM (VALUES
  (0, 'Chargebacks:Spoilage'), (1, 'Chargebacks:Promo'), (2, 'Chargebacks'), (3, 'Freight:In'),
  (4, 'Marketing:Ads'), (5, 'Fees'), (6, 'Chargebacks:Samples:Small')
) AS t(account_id, account_full_name)"""

FIXTURES: dict[str, str] = {}

# invoice x payment rows, as loaded into the warehouse
FIXTURES["invoice_payments"] = f"""
SELECT
  l.l_suppkey AS supplier_id,
  s.s_name AS client_name,
  CAST(o.o_orderdate AS DATE) AS invoice_date,
  l.l_orderkey * 100000 + l.l_suppkey AS invoice_num,
  CONCAT('PO', CAST(l.l_orderkey AS STRING)) AS po_number,
  CONCAT('C', CAST(c.c_custkey AS STRING)) AS quickbooks_id,
  CASE WHEN c.c_nationkey % 6 = 5 THEN NULL ELSE CAST(n.n_nationkey AS BIGINT) END AS ndg_id,
  CASE WHEN c.c_nationkey % 6 = 5 THEN NULL ELSE n.n_name END AS ndg_name,
  c.c_custkey AS customer_id,
  c.c_name AS customer_name,
  {_CUSTOMER_TYPE_ID} AS customer_type_id,
  c.c_mktsegment AS customer_type,
  CASE WHEN o.o_orderstatus = 'O' THEN 0 ELSE 1 END AS ispaid,
  CASE WHEN o.o_orderstatus = 'O' THEN o.o_totalprice ELSE 0.0 END AS balance,
  CAST(SUM(CAST(ROUND(l.l_extendedprice * 100) AS BIGINT))
       OVER (PARTITION BY l.l_orderkey, l.l_suppkey) AS DOUBLE) / 100 AS invoice_amount,
  CASE WHEN l.l_returnflag = 'N' AND o.o_orderstatus = 'O' THEN NULL
       ELSE -(l.l_extendedprice * (1 - l.l_discount)) END AS txn_amount,
  CASE WHEN l.l_returnflag = 'N' AND o.o_orderstatus = 'O' THEN NULL
       ELSE CAST(o.o_orderdate AS DATE) + CAST(20 + l.l_partkey % 40 AS INT) END AS txn_date,
  CASE WHEN l.l_partkey % 20 = 0 THEN 'Early payment advancement'
       WHEN l.l_partkey % 20 = 1 THEN 'factoring advance' END AS memo,
  CASE WHEN l.l_linenumber = 7 THEN 'CreditMemo' ELSE 'Payment' END AS txn_type,
  CASE WHEN l.l_orderkey % 25 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) + 30 END AS duedate,
  n.n_name AS ship_location
FROM {{lineitem}} l
JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey
JOIN {{customer}} c ON c.c_custkey = o.o_custkey
JOIN {{supplier}} s ON s.s_suppkey = l.l_suppkey
JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
"""

# chargeback bills, as loaded into the warehouse
FIXTURES["chargebacks"] = f"""
SELECT
  l.l_orderkey * 1000000 + l.l_partkey AS reference_num,
  s.s_suppkey AS supplier_id,
  s.s_name AS client_name,
  'Main' AS entity,
  'bill' AS type,
  'Chargebacks' AS summary_acct,
  CASE WHEN l.l_linestatus = 'O' THEN 'Open' ELSE 'Paid' END AS bill_status,
  CASE WHEN c.c_nationkey % 6 = 5 THEN NULL ELSE CAST(n.n_nationkey AS BIGINT) END AS ndg_id,
  CASE WHEN c.c_nationkey % 6 = 5 THEN NULL ELSE n.n_name END AS ndg_name,
  c.c_custkey AS customer_id,
  {_CUSTOMER_TYPE_ID} AS customer_type_id,
  c.c_mktsegment AS customer_type,
  CONCAT('Vendor', CAST(o.o_orderkey % 97 AS STRING)) AS vendor,
  c.c_name AS customer_name,
  -(l.l_extendedprice * 0.1) AS total_amount,
  CASE WHEN l.l_linestatus = 'O' THEN l.l_extendedprice * 0.1 ELSE 0.0 END AS open_balance,
  CASE WHEN l.l_linestatus = 'F' THEN l.l_extendedprice * 0.1 ELSE l.l_extendedprice * 0.02 END AS paid_amount,
  CAST(o.o_orderdate AS DATE) AS bill_date,
  CAST(o.o_orderdate AS DATE) + 30 AS cb_duedate,
  CASE WHEN l.l_linestatus = 'F' THEN CAST(o.o_orderdate AS DATE) + CAST(l.l_partkey % 60 AS INT) END AS paid_date
FROM {{lineitem}} l
JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey
JOIN {{customer}} c ON c.c_custkey = o.o_custkey
JOIN {{supplier}} s ON s.s_suppkey = l.l_suppkey + (CASE WHEN l.l_partkey % 5 = 0 THEN 1 ELSE 0 END)
JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
WHERE l.l_returnflag = 'R' AND l.l_quantity <= 10
"""

# supplier contract status (a supplier may have no snapshot or a state without option)
_SUPPLIER_STATUS = f"""
SELECT s.s_suppkey AS supplier_id, s.s_name AS supplier, CONCAT('S', CAST(s.s_suppkey AS STRING)) AS client_id,
       so.status_index, so.status, so.display_name, so.status_short,
       CASE WHEN s.s_suppkey % 10 = 3 THEN NULL WHEN s.s_suppkey % 9 = 0 THEN 0.0 ELSE s.s_acctbal END AS cash_balance,
       s.s_suppkey % 10 <> 3 AS has_snapshot
FROM {{supplier}} s
LEFT JOIN ({STATUS_OPTIONS}) so ON so.status_index = s.s_nationkey % 5 AND so.type = 1 AND s.s_suppkey % 10 <> 3
"""

FIXTURES["crm_classes"] = f"""
SELECT supplier_id, supplier, status_index, status, display_name, status_short FROM ({_SUPPLIER_STATUS}) x
"""

FIXTURES["contract_status"] = f"""
SELECT supplier_id AS id, client_id, supplier AS name, status_short, display_name, status_index, status
FROM ({_SUPPLIER_STATUS}) x
"""

FIXTURES["cash_balance"] = f"""
SELECT supplier_id AS id, client_id, supplier, status_index, status, display_name, status_short, cash_balance
FROM ({_SUPPLIER_STATUS}) x WHERE has_snapshot AND status_index IS NOT NULL
"""

# open supplier invoices (payables) per purchase order
FIXTURES["open_payable"] = f"""
SELECT x.supplier_id AS id, x.client_id, x.supplier AS name, x.status_index, x.status,
       l.l_extendedprice * l.l_tax AS open_payable,
       CAST(o.o_orderdate AS DATE) AS invoice_date, CAST(o.o_orderdate AS DATE) + 45 AS due_date,
       x.status_short, x.display_name
FROM {{lineitem}} l
JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey
JOIN ({_SUPPLIER_STATUS}) x ON x.supplier_id = l.l_suppkey
WHERE l.l_linestatus = 'O'
"""

FIXTURES["unapplied_balance"] = f"""
SELECT x.supplier_id AS id, x.client_id, x.supplier, x.status_index, x.status,
       l.l_extendedprice * 0.25 AS unapplied_amount,
       CAST(o.o_orderdate AS DATE) AS invoice_date, x.status_short, x.display_name
FROM {{lineitem}} l
JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey
JOIN ({_SUPPLIER_STATUS}) x ON x.supplier_id = l.l_suppkey
WHERE l.l_returnflag = 'A'
"""

FIXTURES["credit_memo"] = f"""
SELECT CAST(o.o_orderdate AS DATE) AS creditmemo_date, x.client_id, x.supplier, x.status_index, x.status,
       l.l_extendedprice * l.l_discount AS amount, x.status_short, x.display_name
FROM {{lineitem}} l
JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey
JOIN ({_SUPPLIER_STATUS}) x ON x.supplier_id = l.l_suppkey
WHERE l.l_discount >= 0.09 AND l.l_linestatus = 'O'
"""

FIXTURES["other_open_payables"] = f"""
SELECT CONCAT('OB', CAST(l.l_orderkey AS STRING)) AS reference_num,
       CONCAT('OB', CAST(l.l_orderkey AS STRING)) AS replace_ref_num,
       l.l_extendedprice * 0.03 AS new_total,
       x.supplier_id AS client_id, x.supplier, 'bill' AS type, 'Fees' AS summary_acct, 'Open' AS bill_status,
       CONCAT('Vendor', CAST(o.o_orderkey % 97 AS STRING)) AS vendor,
       -(l.l_extendedprice * 0.03) AS total_amount, l.l_extendedprice * 0.03 AS other_open_payables,
       CAST(0 AS DOUBLE) AS paid_amount, CAST(o.o_orderdate AS DATE) AS bill_date, CAST(o.o_orderdate AS DATE) + 30 AS cb_duedate,
       CAST(NULL AS DATE) AS paid_date, x.supplier_id AS id, x.client_id AS cl_id, x.supplier AS name,
       x.status_index, x.display_name, x.status_short, x.status
FROM {{lineitem}} l
JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey
JOIN ({_SUPPLIER_STATUS}) x ON x.supplier_id = l.l_suppkey
WHERE l.l_returnflag = 'A'
"""

FIXTURES["crm_customers"] = f"""
SELECT CASE WHEN c.c_nationkey % 6 = 5 THEN NULL ELSE n.n_name END AS ndg_name,
       CASE WHEN c.c_nationkey % 6 = 5 THEN NULL ELSE CAST(n.n_nationkey AS BIGINT) END AS ndg_id,
       c.c_custkey AS customer_id, c.c_name AS customer, c.c_mktsegment AS customer_type,
       {_CUSTOMER_TYPE_ID} AS customer_type_id
FROM {{customer}} c JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
"""

FIXTURES["crm_ndg"] = """
SELECT CAST(n.n_nationkey AS BIGINT) AS id, n.n_name AS name, r.r_name AS region
FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""

# human level overrides (latest row per entity wins)
FIXTURES["customer_update_level"] = """
SELECT e.user_id AS customer_id, CAST((e.event_id + 1) % 3 + 1 AS INT) AS previous_level,
       CAST(e.event_id % 3 + 1 AS INT) AS new_level,
       CASE WHEN e.event_id % 2 = 0 THEN 'Reason 13' ELSE 'Reason 07' END AS reason,
       e.ts AS updated_at
FROM {events} e WHERE e.event_type = 'signup'
"""

FIXTURES["supplier_update_level"] = """
SELECT e.user_id AS supplier_id, CAST((e.event_id + 1) % 3 + 1 AS INT) AS previous_level,
       CAST(e.event_id % 3 + 1 AS INT) AS new_level,
       CASE WHEN e.event_id % 2 = 0 THEN 'Reason 13' ELSE 'Reason 07' END AS reason,
       e.ts AS updated_at
FROM {events} e WHERE e.event_type = 'error'
"""

# the list of override reasons, an input table
FIXTURES["override_reasons"] = """
SELECT CONCAT('Reason ', CASE WHEN n.n_nationkey < 9 THEN '0' ELSE '' END, CAST(n.n_nationkey + 1 AS STRING)) AS reason
FROM {nation} n WHERE n.n_nationkey < 14"""

# override reasons already stored with a weight (one row per entity and reason)
for _entity, _etype in (("customer", "signup"), ("supplier", "error")):
    FIXTURES[f"{_entity}_reason"] = f"""
SELECT e.user_id AS {_entity}_id,
       CASE WHEN e.event_id % 2 = 0 THEN 'Reason 13' ELSE 'Reason 07' END AS reason,
       max(CAST(0.1 + (e.event_id % 5) * 0.05 AS DOUBLE)) AS weight
FROM {{events}} e WHERE e.event_type = '{_etype}'
GROUP BY e.user_id, CASE WHEN e.event_id % 2 = 0 THEN 'Reason 13' ELSE 'Reason 07' END
"""

# ---------------------------------------------------------------------------
# Raw source (OLTP-shaped) relations read by the extraction queries
# ---------------------------------------------------------------------------
RAW: dict[str, str] = {}

RAW["raw_suppliers"] = """
SELECT s.s_suppkey AS id, CONCAT('S', CAST(s.s_suppkey AS STRING)) AS quickbooks_id, s.s_name AS name
FROM {supplier} s"""

RAW["raw_customers"] = """
SELECT c.c_custkey AS id, CONCAT('C', CAST(c.c_custkey AS STRING)) AS quickbooks_id, c.c_name AS name,
       CASE WHEN c.c_nationkey % 6 = 5 THEN NULL ELSE CAST(c.c_nationkey AS BIGINT) END AS ndg_id,
       c.c_mktsegment AS customer_type
FROM {customer} c"""

# Customer types.
RAW["raw_customer_types"] = """SELECT * FROM (VALUES
  (1, 'BUILDING'), (2, 'AUTOMOBILE'), (3, 'MACHINERY'), (4, 'HOUSEHOLD'), (5, 'FURNITURE')
) AS t(id, type)"""

RAW["raw_ndg"] = """
SELECT CAST(n.n_nationkey AS BIGINT) AS id, n.n_name AS name, r.r_name AS type
FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey"""

# one invoice per (order, supplier); some rows carry an unknown supplier or an empty customer reference
RAW["raw_invoices"] = """
SELECT l.l_orderkey * 100000 + l.l_suppkey AS txn_id,
       CASE WHEN l.l_suppkey % 50 = 7 THEN CONCAT('X', CAST(l.l_suppkey AS STRING))
            ELSE CONCAT('S', CAST(l.l_suppkey AS STRING)) END AS client_id,
       CASE WHEN o.o_custkey % 97 = 0 THEN '' ELSE CONCAT('C', CAST(o.o_custkey AS STRING)) END AS location_job_id,
       CAST(o.o_orderdate AS DATE) AS invoice_date,
       l.l_orderkey * 100000 + l.l_suppkey AS invoice_num,
       CONCAT('PO', CAST(l.l_orderkey AS STRING)) AS po_number,
       CASE WHEN o.o_orderstatus = 'O' THEN 0 ELSE 1 END AS ispaid,
       CASE WHEN o.o_orderstatus = 'O' THEN o.o_totalprice ELSE CAST(0 AS DOUBLE) END AS balance,
       CAST(SUM(CAST(ROUND(l.l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS amount,
       CASE WHEN l.l_orderkey % 25 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) + 30 END AS duedate,
       'WAREHOUSE' AS ship_location
FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey
GROUP BY l.l_orderkey, l.l_suppkey, o.o_custkey, o.o_orderdate, o.o_orderstatus, o.o_totalprice"""

# payment transactions linked to invoices (several per invoice)
RAW["raw_payments"] = """
SELECT l.l_orderkey * 100000 + l.l_suppkey AS txn_id,
       CAST(o.o_orderdate AS DATE) + CAST(20 + l.l_partkey % 40 AS INT) AS txn_date,
       -(l.l_extendedprice * (1 - l.l_discount)) AS amount,
       CASE WHEN l.l_partkey % 20 = 0 THEN 'Early payment advancement'
            WHEN l.l_partkey % 20 = 1 THEN 'factoring advance' END AS memo,
       CASE WHEN l.l_linenumber = 7 THEN 'CreditMemo' ELSE 'Payment' END AS txn_type
FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey
WHERE NOT (l.l_returnflag = 'N' AND o.o_orderstatus = 'O')"""

RAW["raw_bills"] = """
SELECT o.o_orderkey AS id, o.o_orderkey % 97 AS vendor_id, o.o_orderkey % 6 AS subsidiary_id,
       o.o_orderkey * 10 AS accounting_transaction_id,
       CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_paid,
       CASE WHEN o.o_orderstatus = 'F' THEN CAST(0 AS DOUBLE) ELSE o.o_totalprice * 0.01 END AS balance,
       CASE WHEN o.o_orderkey % 4 = 0 THEN 'credit' ELSE 'bill' END AS transaction_type,
       CONCAT('CR', CAST(o.o_orderkey AS STRING)) AS transaction_number,
       CAST(o.o_orderdate AS DATE) AS transaction_date, CAST(o.o_orderdate AS DATE) + 30 AS due_date,
       CASE WHEN o.o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS archived
FROM {orders} o"""

# bill lines; a few line ids repeat in the source data and are merged first
RAW["raw_bill_lines"] = """
SELECT (l.l_orderkey * 100000 + l.l_partkey) * 10 + l.l_linenumber AS id, l.l_orderkey AS bm_transaction_id,
       min(l.l_suppkey) AS client_class_id, l.l_partkey % 7 AS expense_account_id,
       sum(l.l_extendedprice) AS amount
FROM {lineitem} l
GROUP BY (l.l_orderkey * 100000 + l.l_partkey) * 10 + l.l_linenumber, l.l_orderkey, l.l_partkey % 7"""

RAW["raw_accounts"] = ACCOUNTS

RAW["raw_bill_payments"] = """
SELECT l.l_orderkey AS bm_transaction_id, l.l_extendedprice * 0.05 AS bm_accounting_payment_amount,
       CAST(o.o_orderdate AS DATE) + CAST(l.l_partkey % 50 AS INT) AS bm_accounting_payment_date
FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey
WHERE l.l_linenumber <= 2 AND l.l_linestatus = 'F'"""

RAW["raw_companies"] = """
SELECT DISTINCT o.o_orderkey % 97 AS id, CONCAT('Vendor', CAST(o.o_orderkey % 97 AS STRING)) AS company_name
FROM {orders} o"""

# vendor to company; every tenth vendor belongs to two companies, vendor 5 to none
RAW["raw_vendor_companies"] = """
SELECT DISTINCT o.o_orderkey % 97 AS vendor_id, o.o_orderkey % 97 AS company_id FROM {orders} o WHERE o.o_orderkey % 97 <> 5
UNION ALL
SELECT DISTINCT o.o_orderkey % 97 AS vendor_id, (o.o_orderkey + 1) % 97 AS company_id FROM {orders} o
WHERE o.o_orderkey % 97 % 10 = 0"""

# company to customer: one or two customers each
RAW["raw_company_customers"] = """
SELECT c.c_custkey % 97 AS company_id, c.c_custkey AS customer_id FROM {customer} c WHERE c.c_custkey < 194"""

# subsidiaries that book the bills
RAW["raw_entities"] = """
SELECT CAST(r.r_regionkey AS BIGINT) AS id, r.r_name AS name FROM {region} r"""

# accounting metadata of bills; some bills have two rows
RAW["raw_bill_metadata"] = """
SELECT o.o_orderkey * 10 AS txn_id FROM {orders} o WHERE o.o_orderkey % 3 = 0
UNION ALL SELECT o.o_orderkey * 10 AS txn_id FROM {orders} o WHERE o.o_orderkey % 33 = 0"""

RAW["raw_snapshots"] = """
SELECT CONCAT('S', CAST(s.s_suppkey AS STRING)) AS client_id, s.s_nationkey % 5 AS contract_states,
       CASE WHEN s.s_suppkey % 9 = 0 THEN CAST(0 AS DOUBLE) ELSE s.s_acctbal END AS cash_balance
FROM {supplier} s WHERE s.s_suppkey % 10 <> 3"""

RAW["raw_status_options"] = STATUS_OPTIONS

RAW["raw_supplier_invoice"] = """
SELECT l.l_orderkey * 100000 + l.l_suppkey AS po_num, l.l_suppkey AS client_id,
       l.l_extendedprice * l.l_tax AS balance, l.l_extendedprice AS total_amount,
       CAST(o.o_orderdate AS DATE) AS txn_date, CAST(o.o_orderdate AS DATE) + 45 AS due_date,
       CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 2 END AS invoice_status
FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey
WHERE l.l_quantity > 40"""

RAW["raw_credit_memos"] = """
SELECT CAST(o.o_orderdate AS DATE) AS creditmemo_date, CONCAT('S', CAST(l.l_suppkey AS STRING)) AS client_id,
       l.l_extendedprice * l.l_discount AS amount, CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 2 END AS status_id
FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey
WHERE l.l_discount >= 0.09"""

# constants state of earlier runs, one candidate row per order (latest per id is the stored one)
RAW["raw_constant_values"] = """
SELECT CONCAT('c', CAST(o.o_orderkey % 4 + 1 AS STRING)) AS id, o.o_totalprice / 1000000 AS value,
       CAST(o.o_orderdate AS DATE) AS processing_date
FROM {orders} o"""

FIXTURES.update(RAW)



#: The same inner joins in the order that Spark makes them: customer and nation come to the orders, the supplier to the bare line items, then one shuffle
#: by order meets both and serves the window too.  In the order of the text, once customers are too many for a broadcast, every finished row
#: is shuffled by customer and again for the window.
SPARK_FROM: dict[str, str] = {"invoice_payments": """FROM {lineitem} l
JOIN {supplier} s ON s.s_suppkey = l.l_suppkey
JOIN ({orders} o
      JOIN {customer} c ON c.c_custkey = o.o_custkey
      JOIN {nation} n ON n.n_nationkey = c.c_nationkey) ON o.o_orderkey = l.l_orderkey
"""}


def spark_text(name: str) -> str:
    """Fixture statement with the joins in the order that Spark makes them."""
    text = FIXTURES[name]
    return text[:text.index("FROM {lineitem} l\n")] + SPARK_FROM[name] if name in SPARK_FROM else text


def placeholders(text: str) -> list[str]:
    """Base tables a fixture statement refers to."""
    return [t for t in BASE_TABLES if "{" + t + "}" in text]


def oracle_text(name: str) -> str:
    """Fixture statement with placeholders bound to the oracle's view names."""
    return FIXTURES[name].format(**{t: t for t in BASE_TABLES})


def oracle_prefix(*names: str) -> str:
    """``WITH`` clause defining the named fixture relations for an oracle query."""
    return "WITH " + ",\n".join(f"{n} AS ({oracle_text(n)})" for n in names) + "\n"
