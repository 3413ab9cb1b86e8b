"""Oracle SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark plans, in the most literal form: the join
of J1 is the reference's naive LEFT JOIN ... GROUP BY, percentiles use
``quantile_cont``, modes use count + ordering, cumulative sums use plain
windows. Only the base tables are registered as views, so the mapped tables
and the feature table are inlined as CTEs.
"""

from __future__ import annotations

from ebbflow import schemas as S

BINARY = S.BINARY_COLUMNS
CATEGORICAL = S.CATEGORICAL_COLUMNS
MODE_COLUMNS = BINARY + CATEGORICAL


def _addon(cond: str) -> str:
    return f"CASE WHEN c.c_nationkey % 3 = 0 THEN 'No internet service' WHEN {cond} THEN 'Yes' ELSE 'No' END"


FX_CUSTOMERS = f"""
fx_customers AS (
  SELECT c.c_custkey AS customer_id,
    'City ' || CAST(c.c_nationkey AS VARCHAR) AS city,
    CAST(90000 + c.c_custkey % 1000 AS INTEGER) AS zip_code,
    CAST(30.0 + c.c_nationkey * 0.5 AS DOUBLE) AS latitude,
    CAST(-120.0 + c.c_nationkey * 0.25 AS DOUBLE) AS longitude,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN c.c_nationkey % 5 = 0 THEN 1 ELSE 0 END AS senior_citizen,
    CASE WHEN c.c_custkey % 97 = 0 THEN NULL WHEN c.c_acctbal < 3000 THEN 'No' ELSE 'Yes' END AS partner,
    CASE WHEN c.c_custkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS dependents,
    CAST(c.c_custkey % 73 AS INTEGER) AS tenure_months,
    CASE WHEN c.c_custkey % 10 = 7 THEN 'No' ELSE 'Yes' END AS phone_service,
    CASE WHEN c.c_custkey % 10 = 7 THEN 'No phone service' WHEN c.c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS multiple_lines,
    CASE WHEN c.c_nationkey % 3 = 0 THEN 'No' WHEN c.c_nationkey % 3 = 1 THEN 'DSL' ELSE 'Fiber optic' END AS internet_service,
    {_addon('c.c_acctbal >= 5000')} AS online_security,
    {_addon('c.c_custkey % 2 = 0')} AS online_backup,
    {_addon('c.c_custkey % 5 < 2')} AS device_protection,
    CASE WHEN c.c_nationkey % 3 = 0 THEN 'No internet service' WHEN c.c_custkey % 89 = 0 THEN NULL
         WHEN c.c_acctbal > 7000 THEN 'Yes' ELSE 'No' END AS tech_support,
    {_addon('c.c_custkey % 7 < 3')} AS streaming_tv,
    {_addon('c.c_custkey % 11 < 5')} AS streaming_movies,
    CASE WHEN c.c_mktsegment IN ('AUTOMOBILE','BUILDING') THEN 'Month-to-month' WHEN c.c_mktsegment = 'FURNITURE' THEN 'One year'
         WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Two year' ELSE NULL END AS contract,
    CASE WHEN o.last_order >= TIMESTAMP '2000-06-01 00:00:00' THEN 0 ELSE 1 END AS churn_value
  FROM customer c LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) o
    ON c.c_custkey = o.o_custkey
)"""

FX_PAYMENTS = """
fx_payments AS (
  SELECT o.o_orderkey AS payment_id, o.o_custkey AS customer_id,
    CASE WHEN o.o_orderstatus = 'P' THEN 'Yes' ELSE 'No' END AS paperless_billing,
    o.o_orderpriority AS payment_method,
    o.o_totalprice AS monthly_charges,
    CASE WHEN o.o_custkey % 73 = 0 THEN ' '
         ELSE CAST(CAST(o.o_totalprice AS DECIMAL(14,2)) * (o.o_custkey % 73) AS VARCHAR) END AS total_charges
  FROM orders o JOIN (SELECT o_custkey, min(o_orderkey) AS k FROM orders GROUP BY o_custkey) f ON o.o_orderkey = f.k
)"""

FX_TICKETS = """
fx_tickets AS (
  SELECT event_id AS ticket_id, user_id AS customer_id, event_type AS issue_type,
    CASE WHEN event_id % 3 = 0 THEN 'Low' WHEN event_id % 3 = 1 THEN 'Medium' ELSE 'High' END AS severity,
    value AS resolution_days,
    CASE WHEN event_id % 5 = 0 THEN 'Pending' WHEN event_id % 5 = 1 THEN 'Escalated' ELSE 'Resolved' END AS status,
    ts AS created_at
  FROM events
)"""

BASE = """
features_base AS (
  SELECT c.*, p.monthly_charges, p.total_charges, p.payment_method, p.paperless_billing,
         COUNT(t.ticket_id) AS support_ticket_count
  FROM fx_customers c
  LEFT JOIN fx_payments p ON c.customer_id = p.customer_id
  LEFT JOIN fx_tickets t ON c.customer_id = t.customer_id
  GROUP BY ALL
)"""

CLEANED = """
cleaned AS (
  SELECT * EXCLUDE (city, zip_code, latitude, longitude, total_charges),
         TRY_CAST(total_charges AS DOUBLE) AS total_charges
  FROM features_base
)"""


def _mode_ctes() -> str:
    cols = ", ".join(MODE_COLUMNS)
    pivot = ",\n    ".join(f"max(CASE WHEN column_name = '{c}' THEN val END) AS {c}" for c in MODE_COLUMNS)
    return f"""
value_counts_fit AS (
  SELECT column_name, val, count(*) AS n
  FROM (UNPIVOT (SELECT {cols} FROM cleaned) ON {cols} INTO NAME column_name VALUE val)
  WHERE val IS NOT NULL
  GROUP BY ALL
),
modes AS (
  SELECT {pivot}
  FROM (SELECT column_name, val, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, val) AS rn
        FROM value_counts_fit) WHERE rn = 1
),
cats AS (
  SELECT column_name, val, CAST(row_number() OVER (PARTITION BY column_name ORDER BY val) - 1 AS INTEGER) AS code
  FROM value_counts_fit WHERE column_name IN ({", ".join(f"'{c}'" for c in CATEGORICAL)})
)"""


MEDIANS = """
medians AS (
  SELECT quantile_cont(tenure_months, 0.5) AS tenure_months,
         quantile_cont(monthly_charges, 0.5) AS monthly_charges,
         quantile_cont(total_charges, 0.5) AS total_charges,
         quantile_cont(churn_value, 0.5) AS churn_value
  FROM cleaned
)"""


def _imputed() -> str:
    fills = ",\n    ".join(f"coalesce(x.{c}, m.{c}) AS {c}" for c in MODE_COLUMNS)
    return f"""
imputed AS (
  SELECT x.customer_id, x.gender, x.senior_citizen,
    coalesce(CAST(x.tenure_months AS DOUBLE), md.tenure_months) AS tenure_months,
    coalesce(x.monthly_charges, md.monthly_charges) AS monthly_charges,
    coalesce(x.total_charges, md.total_charges) AS total_charges,
    x.support_ticket_count,
    coalesce(x.churn_value, CAST(round_even(md.churn_value, 0) AS INTEGER)) AS churn_value,
    {fills}
  FROM cleaned x, medians md, modes m
),
threshold AS (SELECT quantile_cont(monthly_charges, 0.75) AS thr FROM imputed)"""


def _binary(c: str) -> str:
    return (f"CASE {c} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No phone service' THEN 0 "
            f"WHEN 'No internet service' THEN 0 END")


def _feature_table() -> str:
    code = {c: f"coalesce((SELECT k.code FROM cats k WHERE k.column_name = '{c}' AND k.val = i.{c}), -1)"
            for c in CATEGORICAL}
    expr = {
        "gender": "CASE i.gender WHEN 'Female' THEN 0 WHEN 'Male' THEN 1 END",
        "senior_citizen": "i.senior_citizen",
        "tenure_months": "i.tenure_months",
        "monthly_charges": "i.monthly_charges",
        "total_charges": "i.total_charges",
        "support_ticket_count": "i.support_ticket_count",
        "average_charges": ("round_even((CASE WHEN i.tenure_months > 0 THEN i.total_charges / i.tenure_months "
                            "ELSE i.monthly_charges END) * 100, 0) / 100"),
        "high_value_customer": "CASE WHEN i.monthly_charges > t.thr THEN 1 ELSE 0 END",
    }
    for c in BINARY:
        expr[c] = _binary(f"i.{c}")
    expr.update(code)
    sel = ",\n    ".join(f"{expr[c]} AS {c}" for c in S.FEATURE_COLUMNS)
    return f"""
feature_table AS (
  SELECT i.customer_id,
    {sel},
    i.churn_value
  FROM imputed i, threshold t
)"""


def ctes(upto: str = "feature_table") -> str:
    """The WITH-list up to a named stage."""
    parts = [FX_CUSTOMERS, FX_PAYMENTS, FX_TICKETS]
    if upto in ("fx",):
        return ",".join(parts)
    parts.append(BASE)
    if upto == "features_base":
        return ",".join(parts)
    parts.append(CLEANED)
    if upto == "cleaned":
        return ",".join(parts)
    parts += [MEDIANS, _mode_ctes()]
    if upto == "fit":
        return ",".join(parts)
    parts.append(_imputed())
    if upto == "imputed":
        return ",".join(parts)
    parts.append(_feature_table())
    return ",".join(parts)


def with_multi(upto: str, *extra: str) -> str:
    """``with_`` over text keys and every order as a billing row."""
    body = with_(upto, *extra)
    for old, new in (("c.c_custkey AS customer_id", "'C-' || c.c_custkey AS customer_id"),
                     ("o.o_custkey AS customer_id", "'C-' || o.o_custkey AS customer_id"),
                     ("user_id AS customer_id", "'C-' || user_id AS customer_id"),
                     ("  FROM orders o JOIN (SELECT o_custkey, min(o_orderkey) AS k FROM orders GROUP BY o_custkey) f ON o.o_orderkey = f.k\n",
                      "  FROM orders o\n")):
        assert old in body
        body = body.replace(old, new)
    return body


def with_(upto: str, *extra: str) -> str:
    """``WITH <ctes up to a stage>, <extra ctes>``."""
    body = ctes(upto)
    if extra:
        body += "," + ",".join(extra)
    return "WITH " + body + "\n"
