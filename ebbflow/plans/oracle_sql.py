"""Oracle SQL per registered query (DuckDB dialect)."""

from __future__ import annotations

from ebbflow import schemas as S
from ebbflow.plans.oracle import with_, with_multi

ORACLE: dict[str, str] = {}

ORACLE["features_base"] = with_("features_base") + "SELECT * FROM features_base"

ORACLE["features_base_fanout"] = with_("fx", """
fx_payments_fanout AS (SELECT o_custkey AS customer_id, o_orderstatus AS order_status FROM orders)""") + """
SELECT c.customer_id, p.order_status, COUNT(t.ticket_id) AS support_ticket_count
FROM fx_customers c
LEFT JOIN fx_payments_fanout p ON c.customer_id = p.customer_id
LEFT JOIN fx_tickets t ON c.customer_id = t.customer_id
GROUP BY c.customer_id, p.order_status"""

ORACLE["feature_table"] = with_("feature_table") + "SELECT * FROM feature_table"

ORACLE["churn_by_contract"] = with_("feature_table", """
labelled AS (
  SELECT coalesce((SELECT k.val FROM cats k WHERE k.column_name = 'contract' AND k.code = f.contract), 'Unknown')
         AS contract_label, f.churn_value
  FROM feature_table f)""") + """
SELECT contract_label, count(*) AS n_customers, avg(CAST(churn_value AS DOUBLE)) AS churn_rate,
       round_even(avg(CAST(churn_value AS DOUBLE)) * 100 * 10, 0) / 10 AS churn_rate_pct
FROM labelled GROUP BY contract_label"""

# --- seeding and cleaning ----------------------------------------------------------------

_TEXT = ["city", "partner", "dependents", "phone_service", "multiple_lines", "internet_service", "online_security",
         "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies"]
RAW_FLAT = """
raw_flat AS (
  SELECT ' ' || CAST(c.customer_id AS VARCHAR) || ' ' AS customer_id,
    CAST(c.zip_code AS VARCHAR) AS zip_code, CAST(c.latitude AS VARCHAR) AS latitude,
    CAST(c.longitude AS VARCHAR) AS longitude, ' ' || c.gender || ' ' AS gender,
    CAST(c.senior_citizen AS VARCHAR) AS senior_citizen, CAST(c.tenure_months AS VARCHAR) AS tenure_months,
    ' ' || c.contract || ' ' AS contract, CAST(c.churn_value AS VARCHAR) AS churn_value,
    """ + ", ".join(f"c.{t}" for t in _TEXT) + """,
    p.paperless_billing, ' ' || p.payment_method || ' ' AS payment_method,
    CAST(p.monthly_charges AS VARCHAR) AS monthly_charges, p.total_charges
  FROM fx_customers c LEFT JOIN fx_payments p ON c.customer_id = p.customer_id
)"""


def _int0(c):
    return f"CAST(trunc(coalesce(TRY_CAST({c} AS DOUBLE), 0)) AS INTEGER)"


BUILD_CUSTOMERS = """
built_customers AS (
  SELECT trim(customer_id) AS customer_id, trim(city) AS city,
    CAST(trunc(TRY_CAST(trim(zip_code) AS DOUBLE)) AS INTEGER) AS zip_code,
    TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
    trim(gender) AS gender, """ + _int0("senior_citizen") + """ AS senior_citizen,
    trim(partner) AS partner, trim(dependents) AS dependents, """ + _int0("tenure_months") + """ AS tenure_months,
    """ + ", ".join(f"trim({t}) AS {t}" for t in _TEXT[3:]) + """,
    trim(contract) AS contract, """ + _int0("churn_value") + """ AS churn_value
  FROM raw_flat
)"""

ORACLE["build_customers"] = with_("fx", RAW_FLAT, BUILD_CUSTOMERS) + "SELECT * FROM built_customers"

ORACLE["build_payments"] = with_("fx", RAW_FLAT, """
typed AS (
  SELECT trim(customer_id) AS customer_id, trim(paperless_billing) AS paperless_billing,
    trim(payment_method) AS payment_method, TRY_CAST(monthly_charges AS DOUBLE) AS monthly_charges,
    TRY_CAST(total_charges AS DOUBLE) AS total_charges FROM raw_flat)""") + """
SELECT customer_id, paperless_billing, payment_method,
  coalesce(monthly_charges, (SELECT quantile_cont(monthly_charges, 0.5) FROM typed)) AS monthly_charges,
  coalesce(total_charges, (SELECT quantile_cont(total_charges, 0.5) FROM typed)) AS total_charges
FROM typed"""

ORACLE["drop_columns"] = with_("features_base") + \
    "SELECT * EXCLUDE (city, zip_code, latitude, longitude) FROM features_base"

ORACLE["coerce_numeric"] = with_("fx") + """
SELECT source, row_id, raw, CASE WHEN NOT isnan(TRY_CAST(raw AS DOUBLE)) THEN TRY_CAST(raw AS DOUBLE) END AS value,
       coalesce(TRY_CAST(trunc(TRY_CAST(raw AS DOUBLE)) AS BIGINT), 0) AS value_int
FROM (SELECT 'payments' AS source, customer_id AS row_id, total_charges AS raw FROM fx_payments
      UNION ALL
      SELECT 'events', event_id, json_extract_string(props, '$.k') FROM events
      UNION ALL
      SELECT 'orders', o_orderkey, (['NaN', 'Infinity', '-Infinity', '30000000000', ' ', 'x', '-7.9'])[1 + o_orderkey % 7] FROM orders)"""

ORACLE["clean_strings"] = with_("fx", RAW_FLAT) + """
SELECT trim(customer_id) AS customer_id, trim(gender) AS gender, trim(contract) AS contract,
       trim(payment_method) AS payment_method, trim(partner) AS partner FROM raw_flat"""

_AVG = ("round_even((CASE WHEN tenure_months > 0 THEN total_charges / tenure_months "
        "ELSE monthly_charges END) * 100, 0) / 100")
ORACLE["average_charges"] = with_("cleaned") + f"SELECT customer_id, tenure_months, {_AVG} AS average_charges FROM cleaned"

ORACLE["avg_charges_unguarded"] = with_("cleaned", """
r AS (SELECT customer_id, CASE WHEN tenure_months = 0 THEN NULL ELSE total_charges / tenure_months END AS a
      FROM cleaned)""") + """
SELECT customer_id, CAST(round(CAST(coalesce(a, (SELECT quantile_cont(a, 0.5) FROM r)) AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_charges FROM r"""

ORACLE["high_value_flag"] = with_("feature_table") + """
SELECT customer_id, monthly_charges, high_value_customer, CAST(round(CAST((SELECT thr FROM threshold) AS DECIMAL(38,12)), 6) AS DOUBLE) AS threshold
FROM feature_table"""


def _bin(c):
    return (f"CASE {c} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No phone service' THEN 0 "
            f"WHEN 'No internet service' THEN 0 END AS {c}")


ORACLE["encode_binary"] = with_("cleaned") + "SELECT customer_id, CASE gender WHEN 'Female' THEN 0 WHEN 'Male' THEN 1 END AS gender, " + \
    ", ".join(_bin(c) for c in S.BINARY_COLUMNS) + " FROM cleaned"

ORACLE["encode_categories"] = with_("fit") + "SELECT x.customer_id, " + ", ".join(
    f"coalesce((SELECT k.code FROM cats k WHERE k.column_name = '{c}' AND k.val = x.{c}), -1) AS {c}"
    for c in S.CATEGORICAL_COLUMNS) + " FROM cleaned x"

ORACLE["category_map"] = with_("fit") + 'SELECT column_name AS "column", code, val AS value FROM cats'

ORACLE["feature_metadata"] = with_("feature_table") + f"""
SELECT '{",".join(S.FEATURE_COLUMNS)}' AS feature_columns, '{S.TARGET}' AS target_column,
  '{",".join(S.NUMERICAL_COLUMNS + ["average_charges"])}' AS numerical_cols,
  'average_charges,high_value_customer' AS engineered_cols,
  (SELECT count(*) FROM feature_table) AS n_rows, {len(S.FEATURE_COLUMNS)} AS n_features,
  CAST((SELECT count(DISTINCT column_name) FROM cats) AS INTEGER) AS n_encoded_columns"""

ORACLE["impute_median"] = with_("fit") + """
SELECT x.customer_id,
  CAST(round(CAST(coalesce(CAST(x.tenure_months AS DOUBLE), m.tenure_months) AS DECIMAL(38,12)), 6) AS DOUBLE) AS tenure_months,
  CAST(round(CAST(coalesce(x.monthly_charges, m.monthly_charges) AS DECIMAL(38,12)), 6) AS DOUBLE) AS monthly_charges,
  CAST(round(CAST(coalesce(x.total_charges, m.total_charges) AS DECIMAL(38,12)), 6) AS DOUBLE) AS total_charges
FROM cleaned x, medians m"""

ORACLE["impute_mode"] = with_("fit") + "SELECT x.customer_id, " + ", ".join(
    f"coalesce(x.{c}, m.{c}) AS {c}" for c in S.BINARY_COLUMNS + S.CATEGORICAL_COLUMNS) + " FROM cleaned x, modes m"


def _encode_scoring() -> str:
    code = {c: f"coalesce((SELECT k.code FROM cats k WHERE k.column_name = '{c}' AND k.val = r.{c}), -1)"
            for c in S.CATEGORICAL_COLUMNS}
    expr = {
        "gender": "CASE r.gender WHEN 'Female' THEN 0 WHEN 'Male' THEN 1 END",
        "senior_citizen": "r.senior_citizen",
        "tenure_months": "CAST(round(CAST(r.tenure_months AS DECIMAL(38,12)), 6) AS DOUBLE)",
        "monthly_charges": "CAST(round(CAST(r.monthly_charges AS DECIMAL(38,12)), 6) AS DOUBLE)",
        "total_charges": "CAST(round(CAST(r.total_charges AS DECIMAL(38,12)), 6) AS DOUBLE)",
        "support_ticket_count": "CAST(0 AS BIGINT)",
        "average_charges": ("round_even((CASE WHEN r.tenure_months > 0 THEN r.total_charges / r.tenure_months "
                            "ELSE r.monthly_charges END) * 100, 0) / 100"),
        "high_value_customer": "CASE WHEN r.monthly_charges > (SELECT thr FROM threshold) THEN 1 ELSE 0 END",
    }
    for c in S.BINARY_COLUMNS:
        expr[c] = f"CASE r.{c} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No phone service' THEN 0 WHEN 'No internet service' THEN 0 END"
    expr.update(code)
    fills = ", ".join(f"coalesce(b.{c}, m.{c}) AS {c}" for c in S.BINARY_COLUMNS + S.CATEGORICAL_COLUMNS
                      if c not in ("paperless_billing", "payment_method"))
    return with_("feature_table", RAW_FLAT, BUILD_CUSTOMERS, f"""
scoring_rows AS (
  SELECT CAST(b.customer_id AS BIGINT) AS customer_id, b.gender, b.senior_citizen,
    coalesce(CAST(b.tenure_months AS DOUBLE), md.tenure_months) AS tenure_months,
    coalesce(TRY_CAST(f.monthly_charges AS DOUBLE), md.monthly_charges) AS monthly_charges,
    coalesce(TRY_CAST(f.total_charges AS DOUBLE), md.total_charges) AS total_charges,
    coalesce(trim(f.paperless_billing), m.paperless_billing) AS paperless_billing,
    coalesce(trim(f.payment_method), m.payment_method) AS payment_method,
    coalesce(b.churn_value, 0) AS churn_value,
    {fills}
  FROM built_customers b JOIN raw_flat f ON b.customer_id = trim(f.customer_id), medians md, modes m
)""") + "SELECT r.customer_id, " + ", ".join(f"{expr[c]} AS {c}" for c in S.FEATURE_COLUMNS) + \
        ", r.churn_value FROM scoring_rows r"


ORACLE["encode_for_scoring"] = _encode_scoring()

# --- data quality ------------------------------------------------------------------------

ORACLE["table_counts"] = with_("fx") + """
SELECT 'customers' AS table_name, count(*) AS n_rows FROM fx_customers
UNION ALL SELECT 'payments', count(*) FROM fx_payments
UNION ALL SELECT 'support_tickets', count(*) FROM fx_tickets"""

ORACLE["min_row_gate"] = with_("fx") + """
SELECT table_name, n_rows, CAST(1000 AS BIGINT) AS min_rows, n_rows >= 1000 AS ok FROM (
SELECT 'customers' AS table_name, count(*) AS n_rows FROM fx_customers
UNION ALL SELECT 'payments', count(*) FROM fx_payments
UNION ALL SELECT 'support_tickets', count(*) FROM fx_tickets)"""

ORACLE["pk_duplicates"] = with_("fx") + """
SELECT 'customers' AS table_name, CAST(customer_id AS VARCHAR) AS key_value, count(*) AS n_rows FROM fx_customers GROUP BY customer_id HAVING count(*) > 1
UNION ALL
SELECT 'payments', CAST(payment_id AS VARCHAR), count(*) FROM fx_payments GROUP BY payment_id HAVING count(*) > 1
UNION ALL
SELECT 'support_tickets', CAST(ticket_id AS VARCHAR), count(*) FROM fx_tickets GROUP BY ticket_id HAVING count(*) > 1
UNION ALL
SELECT 'documents', md5(text), count(*) FROM documents GROUP BY md5(text) HAVING count(*) > 1"""

ORACLE["fk_orphans"] = with_("fx") + """
SELECT 'payments' AS table_name, CAST(payment_id AS VARCHAR) AS row_id, CAST(customer_id AS VARCHAR) AS foreign_key FROM fx_payments p
WHERE NOT EXISTS (SELECT 1 FROM fx_customers c WHERE c.customer_id = p.customer_id)
UNION ALL
SELECT 'support_tickets', CAST(ticket_id AS VARCHAR), CAST(customer_id AS VARCHAR) FROM fx_tickets t
WHERE NOT EXISTS (SELECT 1 FROM fx_customers c WHERE c.customer_id = t.customer_id)
UNION ALL
SELECT 'documents', CAST(doc_id AS VARCHAR), CAST(doc_id AS VARCHAR) FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""

ORACLE["valid_children"] = """
SELECT doc_id, lang, source, n_chars FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""

_CLEANED_COLS = ["customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure_months", "phone_service",
                 "multiple_lines", "internet_service", "online_security", "online_backup", "device_protection",
                 "tech_support", "streaming_tv", "streaming_movies", "contract", "churn_value", "monthly_charges",
                 "payment_method", "paperless_billing", "support_ticket_count", "total_charges"]
ORACLE["null_counts"] = with_("cleaned") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM cleaned" for c in _CLEANED_COLS)


def _checked_ctes() -> str:
    from ebbflow.operators.quality import scoring_rules
    checks = []
    for c, lo, hi, required in scoring_rules(S.FEATURE_COLUMNS):
        x = "coalesce(support_ticket_count, 0)" if c == "support_ticket_count" else c
        if required:
            checks.append(f"CASE WHEN {x} IS NULL THEN '{c}: missing' END")
        if lo is not None:
            checks.append(f"CASE WHEN {x} < {lo} THEN '{c}: below {lo}' END")
        if hi is not None:
            checks.append(f"CASE WHEN {x} > {hi} THEN '{c}: above {hi}' END")
    arr = "list_filter([" + ", ".join(checks) + "], lambda v: v IS NOT NULL)"
    code = {c: f"coalesce((SELECT k.code FROM cats k WHERE k.column_name = '{c}' AND k.val = x.{c}), -1)"
            for c in S.CATEGORICAL_COLUMNS}
    expr = {"gender": "CASE x.gender WHEN 'Female' THEN 0 WHEN 'Male' THEN 1 END", "senior_citizen": "x.senior_citizen",
            "tenure_months": "x.tenure_months", "monthly_charges": "x.monthly_charges", "total_charges": "x.total_charges",
            "support_ticket_count": "x.support_ticket_count",
            "average_charges": ("round_even((CASE WHEN x.tenure_months > 0 THEN x.total_charges / x.tenure_months "
                                "ELSE x.monthly_charges END) * 100, 0) / 100"),
            "high_value_customer": "CASE WHEN x.monthly_charges > (SELECT thr FROM threshold) THEN 1 ELSE 0 END"}
    for c in S.BINARY_COLUMNS:
        expr[c] = f"CASE x.{c} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No phone service' THEN 0 WHEN 'No internet service' THEN 0 END"
    expr.update(code)
    sel = ", ".join(f"{expr[c]} AS {c}" for c in S.FEATURE_COLUMNS)
    return (f"raw_rows AS (SELECT x.customer_id, {sel} FROM cleaned x)",
            f"checked AS (SELECT customer_id, {arr} AS v FROM raw_rows)")


_CHECKED = _checked_ctes()
ORACLE["validate_inputs"] = with_("imputed", *_CHECKED) + """
SELECT customer_id, len(v) = 0 AS is_valid, CAST(len(v) AS INTEGER) AS n_violations, array_to_string(v, ';') AS violations
FROM checked"""


_VC_COLS = ["gender"] + S.BINARY_COLUMNS + S.CATEGORICAL_COLUMNS
_VC = f"""
vc AS (
  SELECT column_name, val AS value, count(*) AS n
  FROM (UNPIVOT (SELECT {", ".join(_VC_COLS)} FROM cleaned) ON {", ".join(_VC_COLS)} INTO NAME column_name VALUE val)
  GROUP BY ALL),
vcs AS (SELECT column_name, value, n, n / sum(n) OVER (PARTITION BY column_name) AS share FROM vc)"""

ORACLE["dominant_columns"] = with_("cleaned", _VC) + """
SELECT column_name AS "column", value AS top_value, share AS top_share, share >= 0.9 AS dominant
FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY share DESC, value) AS rn FROM vcs) WHERE rn = 1"""

# --- KPIs and exploration ----------------------------------------------------------------

ORACLE["churn_kpis"] = with_("feature_table") + """
SELECT count(*) AS total, CAST(coalesce(sum(churn_value), 0) AS BIGINT) AS churned,
  count(*) - CAST(coalesce(sum(churn_value), 0) AS BIGINT) AS retained,
  CAST(sum(churn_value) AS DOUBLE) / count(*) AS churn_rate,
  sum(churn_value) * 100.0 / count(*) AS churn_rate_pct
FROM feature_table"""

ORACLE["churn_by_value_tier"] = with_("feature_table") + """
SELECT tier, count(*) AS n_customers, avg(CAST(churn_value AS DOUBLE)) AS churn_rate,
  round_even(avg(CAST(churn_value AS DOUBLE)) * 100 * 10, 0) / 10 AS churn_rate_pct
FROM (SELECT CASE high_value_customer WHEN 0 THEN 'Standard' WHEN 1 THEN 'High Value' ELSE 'Unknown' END AS tier,
             churn_value FROM feature_table)
GROUP BY tier"""

ORACLE["value_counts"] = with_("cleaned", _VC) + 'SELECT column_name AS "column", value, n, share FROM vcs'

_CORR = ["tenure_months", "monthly_charges", "total_charges", "average_charges", "churn_value"]
ORACLE["correlation_matrix"] = with_("feature_table") + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round_even(covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0) "
    f"* 100, 0) / 100 AS corr FROM feature_table" for a in _CORR for b in _CORR)


def _hist(col: str) -> str:
    return with_("feature_table", f"""
rng AS (SELECT churn_value, min({col}) AS mn, max({col}) AS mx FROM feature_table WHERE {col} IS NOT NULL GROUP BY churn_value),
grid AS (SELECT r.churn_value, r.mn, r.mx, CAST(b.bin AS INTEGER) AS bin
         FROM rng r, LATERAL (SELECT unnest(range(0, CASE WHEN r.mx = r.mn THEN 1 ELSE 30 END)) AS bin) b),
binned AS (
  SELECT f.churn_value, CAST(CASE WHEN r.mx = r.mn THEN 0 ELSE least(floor((f.{col} - r.mn) / (r.mx - r.mn) * 30), 29) END
         AS INTEGER) AS bin, count(*) AS n
  FROM feature_table f JOIN rng r ON f.churn_value = r.churn_value WHERE f.{col} IS NOT NULL GROUP BY ALL)""") + """
SELECT g.churn_value, g.bin,
  CAST(round(CAST(g.mn + g.bin * (CASE WHEN g.mx = g.mn THEN 0.0 ELSE (g.mx - g.mn) / 30 END) AS DECIMAL(38,12)), 6) AS DOUBLE) AS bin_start,
  CAST(round(CAST(CASE WHEN g.mx = g.mn THEN g.mx ELSE g.mn + (g.bin + 1) * ((g.mx - g.mn) / 30) END AS DECIMAL(38,12)), 6) AS DOUBLE) AS bin_end,
  coalesce(b.n, 0) AS n
FROM grid g LEFT JOIN binned b ON g.churn_value = b.churn_value AND g.bin = b.bin"""


ORACLE["hist_tenure"] = _hist("tenure_months")
ORACLE["hist_monthly"] = _hist("monthly_charges")


def _box(col: str, by: str = S.TARGET, source: str = "feature_table", head: str | None = None) -> str:
    return (head or with_("feature_table").rstrip() + ",") + f"""
q AS (SELECT {by}, quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS median,
             quantile_cont({col}, 0.75) AS q3 FROM {source} WHERE {col} IS NOT NULL GROUP BY {by}),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)""" + f"""
SELECT f.{by}, CAST(round(CAST(f.q1 AS DECIMAL(38,12)), 6) AS DOUBLE) AS q1, CAST(round(CAST(f.median AS DECIMAL(38,12)), 6) AS DOUBLE) AS median, CAST(round(CAST(f.q3 AS DECIMAL(38,12)), 6) AS DOUBLE) AS q3, CAST(round(CAST(f.iqr AS DECIMAL(38,12)), 6) AS DOUBLE) AS iqr,
  CAST(round(CAST(f.lower_fence AS DECIMAL(38,12)), 6) AS DOUBLE) AS lower_fence, CAST(round(CAST(f.upper_fence AS DECIMAL(38,12)), 6) AS DOUBLE) AS upper_fence,
  CAST(round(CAST(min(CASE WHEN x.{col} BETWEEN f.lower_fence AND f.upper_fence THEN x.{col} END) AS DECIMAL(38,12)), 6) AS DOUBLE) AS whisker_low,
  CAST(round(CAST(max(CASE WHEN x.{col} BETWEEN f.lower_fence AND f.upper_fence THEN x.{col} END) AS DECIMAL(38,12)), 6) AS DOUBLE) AS whisker_high,
  count(*) FILTER (WHERE NOT (x.{col} BETWEEN f.lower_fence AND f.upper_fence)) AS n_outliers, count(*) AS n
FROM {source} x JOIN f ON x.{by} IS NOT DISTINCT FROM f.{by} WHERE x.{col} IS NOT NULL
GROUP BY f.{by}, f.q1, f.median, f.q3, f.iqr, f.lower_fence, f.upper_fence"""


ORACLE["box_tenure"] = _box("tenure_months")
ORACLE["box_average_charges"] = _box("average_charges")
ORACLE["box_by_order"] = _box("l_extendedprice", "order_id", "items", """WITH
items AS (SELECT CASE WHEN l_orderkey % 50 <> 0 THEN l_orderkey END AS order_id, l_extendedprice FROM lineitem),""")

ORACLE["mean_ci_by_class"] = with_("feature_table") + """
SELECT churn_value, count(monthly_charges) AS n, CAST(round(CAST(avg(monthly_charges) AS DECIMAL(38,12)), 6) AS DOUBLE) AS mean,
  CAST(round(CAST(stddev_samp(monthly_charges) AS DECIMAL(38,12)), 6) AS DOUBLE) AS sd,
  CAST(round(CAST(avg(monthly_charges) - 1.96 * stddev_samp(monthly_charges) / sqrt(count(monthly_charges)) AS DECIMAL(38,12)), 6) AS DOUBLE) AS ci_low,
  CAST(round(CAST(avg(monthly_charges) + 1.96 * stddev_samp(monthly_charges) / sqrt(count(monthly_charges)) AS DECIMAL(38,12)), 6) AS DOUBLE) AS ci_high
FROM feature_table GROUP BY churn_value"""

def _bootstrap_sql() -> str:
    from ebbflow.operators.explore import POISSON_LIMITS
    r6 = lambda x: f"CAST(round(CAST({x} AS DECIMAL(38,12)), 6) AS DOUBLE)"
    times = " + ".join(f"(u >= {p})::INTEGER" for p in POISSON_LIMITS)
    return with_("feature_table", f"""
x AS (SELECT churn_value AS g, customer_id AS k, monthly_charges::DOUBLE AS v FROM feature_table WHERE monthly_charges IS NOT NULL),
u AS (SELECT g, v, b * 4 + i AS r, ('0x' || substr(md5(k::VARCHAR || '-42-' || b), 8 * i + 1, 8))::BIGINT AS u
      FROM x, (SELECT unnest(range(50)) AS b), (SELECT unnest(range(4)) AS i)),
m AS (SELECT g, r, sum(v * ({times})) / nullif(sum({times}), 0) AS m FROM u GROUP BY g, r),
q AS (SELECT g, quantile_cont(m, 0.025) AS lo, quantile_cont(m, 0.975) AS hi FROM m GROUP BY g)""") + f"""
SELECT x.g AS churn_value, count(*) AS n, {r6('avg(v)')} AS mean, {r6('any_value(lo)')} AS ci_low, {r6('any_value(hi)')} AS ci_high
FROM x JOIN q ON x.g = q.g GROUP BY x.g"""


ORACLE["bootstrap_ci_by_class"] = _bootstrap_sql()

ORACLE["scatter_sample"] = with_("feature_table", """
ranked AS (SELECT churn_value, customer_id, average_charges, monthly_charges, count(*) OVER (PARTITION BY churn_value) AS total,
                  row_number() OVER (PARTITION BY churn_value ORDER BY md5(customer_id::VARCHAR || '-42'), customer_id, average_charges, monthly_charges) AS r
           FROM feature_table WHERE average_charges IS NOT NULL AND monthly_charges IS NOT NULL)""") + """
SELECT churn_value, customer_id, CAST(round(CAST(average_charges AS DECIMAL(38,12)), 6) AS DOUBLE) AS average_charges,
  CAST(round(CAST(monthly_charges AS DECIMAL(38,12)), 6) AS DOUBLE) AS monthly_charges,
  CAST(round(CAST(total / least(total, 100) AS DECIMAL(38,12)), 6) AS DOUBLE) AS weight
FROM ranked WHERE r <= 100"""

ORACLE["density_curve"] = with_("feature_table", """
base AS (SELECT CAST(churn_value AS INTEGER) AS grp, average_charges AS v FROM feature_table WHERE average_charges IS NOT NULL
         UNION ALL SELECT -1, average_charges FROM feature_table WHERE average_charges IS NOT NULL),
st AS (SELECT grp, count(*) AS n, min(v) AS mn, max(v) AS mx, stddev_samp(v) AS sd,
              stddev_samp(v) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM base GROUP BY grp),
st2 AS (SELECT * FROM st WHERE h > 0),
binned AS (SELECT b.grp, CAST(least(floor((b.v - s.mn) / (s.mx - s.mn) * 512), 511) AS INTEGER) AS bk, count(*) AS c
           FROM base b JOIN st2 s ON b.grp = s.grp GROUP BY ALL),
contrib AS (
  SELECT s.grp, k.k, s.n, s.h, s.mn, s.mx,
    b.c * exp(-0.5 * pow((((s.mn - 3.0 * s.h) + k.k * (((s.mx + 3.0 * s.h) - (s.mn - 3.0 * s.h)) / 199))
                          - (s.mn + (b.bk + 0.5) * (s.mx - s.mn) / 512)) / s.h, 2)) AS w
  FROM binned b JOIN st2 s ON b.grp = s.grp, (SELECT unnest(range(0, 200)) AS k) k)""") + """
SELECT grp AS churn_value, CAST(k AS INTEGER) AS k,
  CAST(round(CAST(mn - 3.0 * h + k * ((mx + 3.0 * h) - (mn - 3.0 * h)) / 199 AS DECIMAL(38,12)), 6) AS DOUBLE) AS x,
  CAST(round(CAST(sum(w) / (n * h * 2.5066282746310002) AS DECIMAL(38,18)), 12) AS DOUBLE) AS density,
  CAST(round(CAST(sum(w) / (n * h * 2.5066282746310002) * (mx - mn) AS DECIMAL(38,12)), 6) AS DOUBLE) AS density_scaled
FROM contrib GROUP BY grp, k, n, h, mn, mx"""

ORACLE["pair_bins"] = with_("feature_table", """
r AS (SELECT min(tenure_months) AS xmn, max(tenure_months) AS xmx, min(monthly_charges) AS ymn,
             max(monthly_charges) AS ymx FROM feature_table)""") + """
SELECT churn_value,
  CAST(least(floor((tenure_months - xmn) / (xmx - xmn) * 20), 19) AS INTEGER) AS bin_x,
  CAST(least(floor((monthly_charges - ymn) / (ymx - ymn) * 20), 19) AS INTEGER) AS bin_y,
  count(*) AS n
FROM feature_table, r WHERE tenure_months IS NOT NULL AND monthly_charges IS NOT NULL GROUP BY ALL"""

ORACLE["churn_share"] = with_("feature_table") + """
SELECT churn_label, count(*) AS n, count(*) / sum(count(*)) OVER () AS share
FROM (SELECT CASE churn_value WHEN 0 THEN 'Retained' WHEN 1 THEN 'Churned' ELSE 'Unknown' END AS churn_label
      FROM feature_table) GROUP BY churn_label"""

ORACLE["preview_rows"] = with_("feature_table") + "SELECT * FROM feature_table ORDER BY customer_id LIMIT 20"


def _profile_sql() -> str:
    types = {"customer_id": "bigint", "tenure_months": "double", "monthly_charges": "double", "total_charges": "double",
             "average_charges": "double", "support_ticket_count": "bigint"}
    cols = ["customer_id"] + S.FEATURE_COLUMNS + [S.TARGET]
    vals = ", ".join(f"({i}, '{c}', '{types.get(c, 'int')}')" for i, c in enumerate(cols))
    return with_("feature_table") + f"""
SELECT CAST(v.position AS INTEGER) AS position, v.column_name AS "column", v.type_name AS type,
       (SELECT count(*) FROM feature_table) AS n_rows
FROM (VALUES {vals}) v(position, column_name, type_name)"""


ORACLE["profile_columns"] = _profile_sql()

# --- split, folds, scaling, weights ------------------------------------------------------

def split_sql(source: str = "feature_table", key: str = "customer_id", label: str = "churn_value",
              out: str = "split_table", p: str = "") -> str:
    """Stratified hash split (M1) and folds (M2) of ``source`` as CTEs; ``p`` prefixes helper names."""
    return f"""
{p}ranked AS (
  SELECT f.*, row_number() OVER (PARTITION BY {label}
           ORDER BY md5(CAST({key} AS VARCHAR) || '-42') || ':' || CAST({key} AS VARCHAR)) - 1 AS rk
  FROM {source} f),
{p}cnt AS (SELECT {label} AS lab, count(*) AS n_c FROM {source} GROUP BY {label}),
{p}tot AS (SELECT sum(n_c) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n_c)) AS BIGINT) AS n_test FROM {p}cnt),
{p}tr AS (SELECT c.lab, c.n_c, CAST(c.n_c * (t.n - t.n_test) AS DOUBLE) / t.n AS cont, t.n - t.n_test AS draws
       FROM {p}cnt c, {p}tot t),
{p}tr2 AS (SELECT *, floor(cont) AS fl, cont - floor(cont) AS rem FROM {p}tr),
{p}tr3 AS (SELECT lab, n_c, CAST(fl AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY rem DESC, lab)
               <= draws - sum(fl) OVER () THEN 1 ELSE 0 END AS n_train FROM {p}tr2),
{p}te AS (SELECT r.lab, r.n_train, t.n_test,
              CAST((r.n_c - r.n_train) * t.n_test AS DOUBLE) / sum(r.n_c - r.n_train) OVER () AS cont
       FROM {p}tr3 r, {p}tot t),
{p}te2 AS (SELECT *, floor(cont) AS fl, cont - floor(cont) AS rem FROM {p}te),
{p}alloc AS (SELECT lab, n_train, CAST(fl AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY rem DESC, lab)
                 <= n_test - sum(fl) OVER () THEN 1 ELSE 0 END AS n_test_c FROM {p}te2),
{out} AS (
  SELECT r.*, CASE WHEN r.rk < a.n_test_c THEN 'test' ELSE 'train' END AS split,
         CASE WHEN r.rk >= a.n_test_c THEN CAST(floor((r.rk - a.n_test_c) * 5 / a.n_train) AS INTEGER) END AS fold
  FROM {p}ranked r JOIN {p}alloc a ON r.{label} = a.lab)"""


SPLIT = split_sql()


def _scorer_sql():
    from ebbflow.operators.scoring import BASELINE_SCORER
    return BASELINE_SCORER.sql()


def _preds(split: str = "test") -> str:
    p = _scorer_sql()
    return f"""
preds AS (
  SELECT customer_id AS id, churn_value AS label, {p} AS probability, CAST({p} > 0.5 AS INTEGER) AS prediction, fold
  FROM split_table WHERE split = '{split}')"""


ORACLE["stratified_split"] = with_("feature_table", SPLIT) + "SELECT customer_id, churn_value, split FROM split_table"
ORACLE["fold_assign"] = with_("feature_table", SPLIT) + \
    "SELECT customer_id, churn_value, fold FROM split_table WHERE split = 'train'"


def _standardize_sql():
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in S.FEATURE_COLUMNS)
    sel = ", ".join(f"CAST(round(CAST((x.{c} - s.m_{c}) / (CASE WHEN s.s_{c} = 0 OR s.s_{c} IS NULL THEN 1.0 ELSE s.s_{c} END) AS DECIMAL(38,12)), 6) AS DOUBLE) AS {c}"
                    for c in S.FEATURE_COLUMNS)
    return with_("feature_table", SPLIT, f"st AS (SELECT {stats} FROM split_table WHERE split = 'train')") + \
        f"SELECT x.customer_id, {sel} FROM split_table x, st s"


ORACLE["standardize"] = _standardize_sql()

ORACLE["class_weights"] = with_("feature_table", SPLIT) + """
SELECT churn_value, count(*) AS n_class, CAST(round(CAST(sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS DECIMAL(38,12)), 6) AS DOUBLE) AS weight
FROM split_table WHERE split = 'train' GROUP BY churn_value"""

def _logistic_sql(c: float = 10.0, steps: int = 10, scores: bool = False) -> str:
    """Newton's method written out step by step: the normal equations of each step are summed
    over all pairs of columns and solved by Gauss-Jordan elimination on a list of lists."""
    cols = S.FEATURE_COLUMNS
    d = len(cols) + 1
    stats = ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1.0) AS s_{c}" for c in cols)
    z = ", ".join(f"(x.{c} - s.m_{c}) / s.s_{c}" for c in cols)
    ctes = [f"st AS (SELECT {stats} FROM split_table WHERE split = 'train')",
            "cw AS (SELECT churn_value AS lab, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS w FROM split_table WHERE split = 'train' GROUP BY churn_value)",
            f"""zr AS MATERIALIZED (SELECT [{z}, 1.0]::DOUBLE[] AS z, x.churn_value AS y, cw.w FROM split_table x, st s, cw
               WHERE x.split = 'train' AND x.churn_value = cw.lab)""",
            f"ix AS (SELECT unnest(range(1, {d + 1})) AS i)",
            f"b0 AS (SELECT list_transform(range({d}), lambda ii: 0.0::DOUBLE) AS b)"]
    k = "kk[1][1]::BIGINT"
    eliminate = (f"list_transform(mm, lambda rr, ii: CASE WHEN ii = {k} THEN list_transform(rr, lambda vv: vv / rr[{k}]) "
                 f"ELSE list_transform(rr, lambda vv, jj: vv - rr[{k}] * mm[{k}][jj] / mm[{k}][{k}]) END)")
    for t in range(1, steps + 1):
        ctes += [
            f"p{t} AS MATERIALIZED (SELECT z, y, w, b, 1 / (1 + exp(-list_dot_product(z, b))) AS p FROM zr, b{t - 1})",
            f"""h{t} AS MATERIALIZED (SELECT a.i, c.i AS j, sum(w * p * (1 - p) * z[a.i] * z[c.i]) + CASE WHEN a.i = c.i AND a.i < {d} THEN 1 / {c} ELSE 0 END AS v
               FROM p{t}, ix a, ix c GROUP BY a.i, c.i)""",
            f"g{t} AS (SELECT i, sum(w * (p - y) * z[i]) + CASE WHEN i < {d} THEN any_value(b)[i] / {c} ELSE 0 END AS v FROM p{t}, ix GROUP BY i)",
            f"r{t} AS (SELECT h.i, list_append(list(h.v ORDER BY j), any_value(g.v)) AS row FROM h{t} h JOIN g{t} g ON h.i = g.i GROUP BY h.i)",
            f"q{t} AS (SELECT list(row ORDER BY i) AS q FROM r{t})",
            f"""s{t} AS (SELECT list_reduce(list_prepend(q, list_transform(range(1, {d + 1}), lambda kk: [[kk::DOUBLE]])),
               lambda mm, kk: {eliminate}) AS m FROM q{t})""",
            f"b{t} AS MATERIALIZED (SELECT list_transform(b, lambda vv, ii: vv - m[ii][{d + 1}]) AS b FROM b{t - 1}, s{t})"]
    if scores:
        return with_("feature_table", SPLIT, *ctes) + f"""
SELECT customer_id, CAST(round(CAST(p AS DECIMAL(38,12)), 6) AS DOUBLE) AS probability, CAST(p > 0.5 AS INTEGER) AS prediction
FROM (SELECT x.customer_id, 1 / (1 + exp(-list_dot_product([{z}, 1.0]::DOUBLE[], b))) AS p FROM split_table x, st s, b{steps} WHERE x.split = 'test')"""
    names = ", ".join(f"'{c}'" for c in [*cols, "intercept"])
    return with_("feature_table", SPLIT, *ctes) + f"""
SELECT feature, CAST(round(CAST(coefficient AS DECIMAL(38,12)), 6) AS DOUBLE) AS coefficient
FROM (SELECT unnest([{names}]) AS feature, unnest(b) AS coefficient FROM b{steps})"""


ORACLE["logistic_coefficients"] = _logistic_sql()
ORACLE["saved_model_scores"] = _logistic_sql(scores=True)
_DOUBLES = ", ".join(f"CAST(round(CAST({c} AS DECIMAL(38,12)), 6) AS DOUBLE) AS {c}" for c in S.FEATURE_COLUMNS)
ORACLE["model_input"] = with_("feature_table", SPLIT) + f"SELECT customer_id, {_DOUBLES}, churn_value::DOUBLE AS label, split, fold FROM split_table"
ORACLE["dated_features"] = with_("feature_table") + \
    "SELECT customer_id, churn_value, (SELECT CAST(max(ts) AS DATE) FROM events) AS run_date FROM feature_table"
ORACLE["batch_gate"] = with_("fx") + """
SELECT v.severity, count(t.ticket_id) AS n_rows, CASE WHEN count(t.ticket_id) = 0 THEN 'No customers provided.' ELSE 'accepted' END AS status
FROM (VALUES ('Low'), ('Medium'), ('High'), ('Urgent')) v(severity) LEFT JOIN fx_tickets t ON t.severity = v.severity GROUP BY v.severity"""

# --- evaluation --------------------------------------------------------------------------

CURVE = """
st AS (SELECT probability, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM preds GROUP BY probability),
asc_c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM st),
curve AS (
  SELECT probability AS threshold,
    CAST(sum(pos) OVER (ORDER BY probability DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
    CAST(sum(neg) OVER (ORDER BY probability DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp,
    pos, sum(pos) OVER () AS n_pos FROM st),
curve2 AS (
  SELECT threshold, tp, fp, pos, n_pos, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
         CASE WHEN n_pos = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / n_pos END AS recall FROM curve),
curve3 AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-8) AS f1 FROM curve2)"""

_EVAL = lambda *extra: with_("feature_table", SPLIT, _preds(), CURVE, *extra)

_AUC = "(SELECT sum(pos * (neg_before + neg / 2.0)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) FROM asc_c)"
ORACLE["roc_auc"] = _EVAL() + f"SELECT CAST(round(CAST({_AUC} AS DECIMAL(38,12)), 6) AS DOUBLE) AS roc_auc"

CM = """
cm AS (SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
              count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
       FROM preds),
met AS (SELECT *, CAST(tp + tn AS DOUBLE) / nullif(tp + tn + fp + fn, 0) AS accuracy,
               coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision,
               coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall,
               coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0) AS f1_score FROM cm)"""

ORACLE["classification_metrics"] = _EVAL(CM) + """
SELECT tn, fp, fn, tp, CAST(round(CAST(accuracy AS DECIMAL(38,12)), 6) AS DOUBLE) AS accuracy, CAST(round(CAST(precision AS DECIMAL(38,12)), 6) AS DOUBLE) AS precision, CAST(round(CAST(recall AS DECIMAL(38,12)), 6) AS DOUBLE) AS recall,
       CAST(round(CAST(f1_score AS DECIMAL(38,12)), 6) AS DOUBLE) AS f1_score FROM met"""
ORACLE["confusion_matrix"] = _EVAL(CM) + "SELECT tn, fp, fn, tp FROM cm"

ORACLE["classification_report"] = _EVAL(CM, """
pc AS (SELECT coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0.0) AS p0, coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0.0) AS r0,
              coalesce(CAST(2 * tn AS DOUBLE) / nullif(2 * tn + fn + fp, 0), 0.0) AS f0, CAST(tn + fp AS DOUBLE) AS s0,
              precision AS p1, recall AS r1, f1_score AS f1, CAST(tp + fn AS DOUBLE) AS s1,
              CAST(tn + fp + tp + fn AS DOUBLE) AS n, accuracy AS acc FROM met)""") + """
SELECT 'Not Churned' AS class_name, CAST(round(CAST(p0 AS DECIMAL(38,12)), 6) AS DOUBLE) AS precision, CAST(round(CAST(r0 AS DECIMAL(38,12)), 6) AS DOUBLE) AS recall, CAST(round(CAST(f0 AS DECIMAL(38,12)), 6) AS DOUBLE) AS f1_score, CAST(round(CAST(s0 AS DECIMAL(38,12)), 6) AS DOUBLE) AS support FROM pc
UNION ALL SELECT 'Churned', CAST(round(CAST(p1 AS DECIMAL(38,12)), 6) AS DOUBLE), CAST(round(CAST(r1 AS DECIMAL(38,12)), 6) AS DOUBLE), CAST(round(CAST(f1 AS DECIMAL(38,12)), 6) AS DOUBLE), CAST(round(CAST(s1 AS DECIMAL(38,12)), 6) AS DOUBLE) FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, CAST(round(CAST(acc AS DECIMAL(38,12)), 6) AS DOUBLE), CAST(round(CAST(n AS DECIMAL(38,12)), 6) AS DOUBLE) FROM pc
UNION ALL SELECT 'macro avg', CAST(round(CAST((p0 + p1) / 2 AS DECIMAL(38,12)), 6) AS DOUBLE), CAST(round(CAST((r0 + r1) / 2 AS DECIMAL(38,12)), 6) AS DOUBLE), CAST(round(CAST((f0 + f1) / 2 AS DECIMAL(38,12)), 6) AS DOUBLE), CAST(round(CAST(n AS DECIMAL(38,12)), 6) AS DOUBLE) FROM pc
UNION ALL SELECT 'weighted avg', CAST(round(CAST((p0 * s0 + p1 * s1) / n AS DECIMAL(38,12)), 6) AS DOUBLE), CAST(round(CAST((r0 * s0 + r1 * s1) / n AS DECIMAL(38,12)), 6) AS DOUBLE),
                 CAST(round(CAST((f0 * s0 + f1 * s1) / n AS DECIMAL(38,12)), 6) AS DOUBLE), CAST(round(CAST(n AS DECIMAL(38,12)), 6) AS DOUBLE) FROM pc"""

ORACLE["pr_curve"] = _EVAL() + """
SELECT CAST(round(CAST(threshold AS DECIMAL(38,12)), 6) AS DOUBLE) AS threshold, tp, fp, CAST(round(CAST(precision AS DECIMAL(38,12)), 6) AS DOUBLE) AS precision, CAST(round(CAST(recall AS DECIMAL(38,12)), 6) AS DOUBLE) AS recall, CAST(round(CAST(f1 AS DECIMAL(38,12)), 6) AS DOUBLE) AS f1
FROM curve3
UNION ALL SELECT NULL, NULL, NULL, 1.0, 0.0, 0.0"""

ORACLE["threshold_sweep"] = _EVAL() + """
SELECT CAST(round(CAST(threshold AS DECIMAL(38,12)), 6) AS DOUBLE) AS threshold, CAST(round(CAST(precision AS DECIMAL(38,12)), 6) AS DOUBLE) AS precision, CAST(round(CAST(recall AS DECIMAL(38,12)), 6) AS DOUBLE) AS recall, CAST(round(CAST(f1 AS DECIMAL(38,12)), 6) AS DOUBLE) AS f1
FROM curve3"""

_AP = "(SELECT sum(pos * precision) / nullif(max(n_pos), 0) FROM curve3)"
ORACLE["average_precision"] = _EVAL() + f"SELECT CAST(round(CAST({_AP} AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_precision"

BEST = """
allpts AS (SELECT threshold, precision, recall, f1, 0 AS is_end FROM curve3
           UNION ALL SELECT NULL, 1.0, 0.0, 0.0, 1),
best AS (SELECT * FROM allpts ORDER BY f1 DESC, is_end, threshold LIMIT 1)"""
ORACLE["best_threshold"] = _EVAL(BEST) + """
SELECT CAST(round(CAST(coalesce(threshold, 0.5) AS DECIMAL(38,12)), 6) AS DOUBLE) AS best_threshold, CAST(round(CAST(f1 AS DECIMAL(38,12)), 6) AS DOUBLE) AS best_f1,
       CAST(round(CAST(precision AS DECIMAL(38,12)), 6) AS DOUBLE) AS best_precision, CAST(round(CAST(recall AS DECIMAL(38,12)), 6) AS DOUBLE) AS best_recall FROM best"""

ORACLE["evaluation_report"] = _EVAL(CM, BEST) + f"""
SELECT (SELECT count(*) FROM preds) AS test_set_size, tn, fp, fn, tp,
  CAST(round(CAST((SELECT avg(CAST(label AS DOUBLE)) FROM preds) AS DECIMAL(38,12)), 4) AS DOUBLE) AS churn_rate, CAST(round(CAST({_AUC} AS DECIMAL(38,12)), 4) AS DOUBLE) AS roc_auc,
  CAST(round(CAST(accuracy AS DECIMAL(38,12)), 4) AS DOUBLE) AS accuracy, CAST(round(CAST(f1_score AS DECIMAL(38,12)), 4) AS DOUBLE) AS f1_score, CAST(round(CAST(precision AS DECIMAL(38,12)), 4) AS DOUBLE) AS precision,
  CAST(round(CAST(recall AS DECIMAL(38,12)), 4) AS DOUBLE) AS recall, CAST(round(CAST({_AP} AS DECIMAL(38,12)), 4) AS DOUBLE) AS avg_precision,
  CAST(round(CAST((SELECT coalesce(threshold, 0.5) FROM best) AS DECIMAL(38,12)), 4) AS DOUBLE) AS best_threshold,
  CAST(round(CAST((SELECT f1 FROM best) AS DECIMAL(38,12)), 4) AS DOUBLE) AS best_f1_threshold
FROM met"""

ORACLE["cv_scores"] = with_("feature_table", SPLIT, _preds("train"), """
fst AS (SELECT fold, probability, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
        FROM preds GROUP BY fold, probability),
fc AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY probability
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM fst),
fa AS (SELECT fold, sum(pos * (neg_before + neg / 2.0)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS auc
       FROM fc GROUP BY fold)""") + """
SELECT count(*) AS n_folds, CAST(round(CAST(avg(auc) AS DECIMAL(38,12)), 6) AS DOUBLE) AS cv_roc_auc_mean, CAST(round(CAST(stddev_pop(auc) AS DECIMAL(38,12)), 6) AS DOUBLE) AS cv_roc_auc_std FROM fa"""

# --- scoring -----------------------------------------------------------------------------

_RISK = ("CASE WHEN probability >= 0.75 THEN 'High' WHEN probability >= 0.45 THEN 'Medium' ELSE 'Low' END")


def _scored_all(key: str = "customer_id AS id", *more: str) -> str:
    """Every feature row with its unrounded probability."""
    from ebbflow.operators.scoring import BATCH_SCORER
    p = BATCH_SCORER.sql()
    return f"""
preds AS (SELECT {", ".join([key, *more])}, {p} AS probability, CAST({p} > 0.5 AS INTEGER) AS prediction FROM feature_table)"""


_ALL = with_("feature_table", _scored_all())
ORACLE["score_batch"] = _ALL + f"""
SELECT id AS customer_id, row_number() OVER (ORDER BY id) - 1 AS customer_index, prediction AS churn_prediction,
  CAST(round(CAST(probability AS DECIMAL(38,12)), 4) AS DOUBLE) AS churn_probability, {_RISK} AS churn_risk_level,
  CASE WHEN prediction = 1 THEN 'Likely to churn.' ELSE 'Likely to stay.' END AS message
FROM preds"""

ORACLE["risk_bands"] = _ALL + f"""
SELECT id AS customer_id, CAST(round(CAST(probability AS DECIMAL(38,12)), 6) AS DOUBLE) AS probability, {_RISK} AS churn_risk_level,
  CASE WHEN prediction = 1 THEN 'Customer is likely to churn.' ELSE 'Customer is likely to stay.' END AS message
FROM preds"""

ORACLE["batch_summary"] = _ALL + """
SELECT count(*) AS total_customers, CAST(coalesce(sum(prediction), 0) AS BIGINT) AS churned_count,
  count(*) - CAST(coalesce(sum(prediction), 0) AS BIGINT) AS not_churned_count,
  CAST(round(CAST(CAST(sum(prediction) AS DOUBLE) / nullif(count(*), 0) AS DECIMAL(38,12)), 4) AS DOUBLE) AS churn_rate
FROM preds"""

ORACLE["concat_batches"] = with_("feature_table") + """
SELECT customer_id, CASE WHEN contract IN (SELECT code FROM cats WHERE column_name = 'contract') THEN contract ELSE -1 END AS batch,
       contract, churn_value FROM feature_table"""

# --- KNN, model ranking, run summary, stream --------------------------------------------

ORACLE["knn_vote"] = "WITH " + split_sql("embeddings", "vec_id", "label", "emb_split", "e_")[1:] + """,
q AS (SELECT vec_id, embedding, label FROM emb_split WHERE split = 'test'),
t AS (SELECT vec_id, embedding, label FROM emb_split WHERE split = 'train'),
pairs AS (
  SELECT q.vec_id AS qid, t.vec_id AS nid, t.label AS nlabel,
    sqrt(list_sum(list_transform(range(1, len(q.embedding) + 1),
         lambda i: (CAST(q.embedding[i] AS DOUBLE) - CAST(t.embedding[i] AS DOUBLE)) ** 2))) AS dist
  FROM q, t),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, nid) AS rn FROM pairs) WHERE rn <= 11),
wz AS (SELECT *, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qid) AS has_zero FROM nn),
per AS (SELECT qid, nlabel, sum(CASE WHEN has_zero = 1 THEN CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / dist END) AS score,
               count(*) AS votes FROM wz GROUP BY qid, nlabel),
tot AS (SELECT qid, sum(score) AS total FROM per GROUP BY qid),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, nlabel) AS r FROM per) WHERE r = 1)
SELECT q.vec_id, q.label, b.nlabel AS predicted, b.votes, CAST(round(CAST(b.score / t.total AS DECIMAL(38,12)), 6) AS DOUBLE) AS vote_share
FROM q JOIN best b ON q.vec_id = b.qid JOIN tot t ON t.qid = q.vec_id"""


def _all_preds() -> str:
    from ebbflow.operators.scoring import SCORERS
    parts = []
    for s in SCORERS:
        p = s.sql()
        parts.append(f"SELECT '{s.name}' AS model, customer_id AS id, churn_value AS label, {p} AS probability, "
                     f"CAST({p} > 0.5 AS INTEGER) AS prediction, fold, split FROM split_table")
    return "allp AS (" + "\nUNION ALL ".join(parts) + ")"


COMPARISON = """
mst AS (SELECT model, probability, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
        FROM allp WHERE split = 'test' GROUP BY model, probability),
mc AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY probability
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM mst),
mauc AS (SELECT model, sum(pos * (neg_before + neg / 2.0)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS roc_auc
         FROM mc GROUP BY model),
mcm AS (SELECT model, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
               count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
               count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
               count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
        FROM allp WHERE split = 'test' GROUP BY model),
mmet AS (SELECT model, CAST(tp + tn AS DOUBLE) / nullif(tp + tn + fp + fn, 0) AS accuracy,
                coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision,
                coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall,
                coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0) AS f1_score FROM mcm),
fst AS (SELECT model, fold, probability, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
        FROM allp WHERE split = 'train' GROUP BY model, fold, probability),
fc AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, fold ORDER BY probability
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM fst),
fa AS (SELECT model, fold, sum(pos * (neg_before + neg / 2.0)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS auc
       FROM fc GROUP BY model, fold),
cvs AS (SELECT model, avg(auc) AS m, stddev_pop(auc) AS s FROM fa GROUP BY model),
comparison AS (
  SELECT a.model, CAST(round(CAST(a.roc_auc AS DECIMAL(38,12)), 4) AS DOUBLE) AS roc_auc, CAST(round(CAST(m.accuracy AS DECIMAL(38,12)), 4) AS DOUBLE) AS accuracy, CAST(round(CAST(m.f1_score AS DECIMAL(38,12)), 4) AS DOUBLE) AS f1_score,
         CAST(round(CAST(m.precision AS DECIMAL(38,12)), 4) AS DOUBLE) AS precision, CAST(round(CAST(m.recall AS DECIMAL(38,12)), 4) AS DOUBLE) AS recall,
         CAST(round(CAST(c.m AS DECIMAL(38,12)), 4) AS DOUBLE) AS cv_roc_auc_mean, CAST(round(CAST(c.s AS DECIMAL(38,12)), 4) AS DOUBLE) AS cv_roc_auc_std
  FROM mauc a JOIN mmet m ON a.model = m.model LEFT JOIN cvs c ON a.model = c.model),
ranked_models AS (SELECT *, CAST(row_number() OVER (ORDER BY roc_auc DESC, accuracy DESC, model) - 1 AS INTEGER) AS rank FROM comparison)"""

_RANK = lambda *extra: with_("feature_table", SPLIT, _all_preds(), COMPARISON, *extra)
ORACLE["rank_models"] = _RANK() + "SELECT * FROM ranked_models"
ORACLE["best_model"] = _RANK() + "SELECT * EXCLUDE (rank) FROM ranked_models WHERE rank = 0"
ORACLE["best_marks"] = _RANK() + """
SELECT model, roc_auc = max(roc_auc) OVER () AS roc_auc_is_best, accuracy = max(accuracy) OVER () AS accuracy_is_best,
       f1_score = max(f1_score) OVER () AS f1_score_is_best FROM ranked_models"""


def _run_summary_sql() -> str:
    cols = ["customer_id"] + S.FEATURE_COLUMNS + [S.TARGET]
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    return with_("feature_table", SPLIT, _preds(), _all_preds(), COMPARISON, f"""
gate AS (SELECT CASE WHEN (SELECT count(*) FROM fx_customers) >= 1000 AND (SELECT count(*) FROM fx_payments) >= 1000
                      AND (SELECT count(*) FROM fx_tickets) >= 1000 THEN 'passed' ELSE 'failed' END AS validation),
fe AS (SELECT CASE WHEN count(*) > 0 AND ({nulls}) = 0 THEN 'success' ELSE 'failed' END AS feature_engineering
       FROM feature_table),
trn AS (SELECT CASE WHEN count(roc_auc) > 0 THEN 'success' ELSE 'failed' END AS model_training,
              first(model) AS best_model, first(roc_auc) AS roc_auc, first(accuracy) AS accuracy
       FROM ranked_models WHERE rank = 0),
ev AS (SELECT CASE WHEN count(*) > 0 THEN 'success' ELSE 'failed' END AS model_evaluation FROM preds)""") + """
SELECT (SELECT CAST(max(ts) AS DATE) FROM events) AS run_date, validation, feature_engineering, model_training,
  model_evaluation, best_model, roc_auc, accuracy,
  CASE WHEN validation IN ('success', 'passed') AND feature_engineering IN ('success', 'passed')
        AND model_training IN ('success', 'passed') AND model_evaluation IN ('success', 'passed')
       THEN 'SUCCESS' ELSE 'PARTIAL FAILURE' END AS overall_status
FROM gate, fe, trn, ev"""


ORACLE["run_summary"] = _run_summary_sql()

ORACLE["stream_score"] = with_("feature_table", _scored_all(), *_CHECKED) + f"""
SELECT id AS customer_id, prediction AS churn_prediction, CAST(round(CAST(probability AS DECIMAL(38,12)), 4) AS DOUBLE) AS churn_probability,
  {_RISK} AS churn_risk_level, CASE WHEN prediction = 1 THEN 'Likely to churn.' ELSE 'Likely to stay.' END AS message
FROM preds WHERE id IN (SELECT customer_id FROM checked WHERE len(v) = 0)"""

ORACLE["stream_rejected"] = with_("imputed", *_CHECKED) + """
SELECT customer_id, array_to_string(v, ';') AS violations FROM checked WHERE len(v) > 0"""

_BILLING = ["customer_id", "monthly_charges", "total_charges", "payment_method", "paperless_billing"]
ORACLE["split_multi_billing"] = with_multi(
    "feature_table", "custs AS (SELECT DISTINCT customer_id, churn_value FROM feature_table)", split_sql("custs")) + f"""
SELECT {", ".join("f." + c for c in _BILLING)}, f.support_ticket_count, f.churn_value, s.split, s.fold
FROM feature_table f JOIN split_table s ON f.customer_id = s.customer_id"""

ORACLE["score_multi_billing"] = with_multi("feature_table", _scored_all(*_BILLING)) + f"""
SELECT customer_id, monthly_charges, row_number() OVER (ORDER BY {", ".join(_BILLING)}) - 1 AS customer_index,
  prediction AS churn_prediction, CAST(round(CAST(probability AS DECIMAL(38,12)), 4) AS DOUBLE) AS churn_probability,
  {_RISK} AS churn_risk_level, CASE WHEN prediction = 1 THEN 'Likely to churn.' ELSE 'Likely to stay.' END AS message
FROM preds"""

ORACLE["sort_by_metric"] = _RANK() + """
SELECT CAST(row_number() OVER (ORDER BY accuracy, model) - 1 AS INTEGER) AS position, model, roc_auc, accuracy FROM ranked_models"""

# --- sources and sinks -------------------------------------------------------------------

ORACLE["csv_roundtrip"] = ORACLE["feature_table"]
ORACLE["json_roundtrip"] = ORACLE["evaluation_report"]
ORACLE["append_counts"] = with_("fx") + """
SELECT severity, count(*) AS n_rows, count(DISTINCT ticket_id) AS n_tickets FROM fx_tickets GROUP BY severity"""


ORACLE["repeatable_append"] = ORACLE["append_counts"]

ORACLE["upsert_customers"] = with_("fx", """
x AS (SELECT customer_id, city, CASE WHEN customer_id % 5 = 0 THEN 'Moved' ELSE city END AS city2,
             coalesce(churn_value, 0) AS churn_value, customer_id % 3 <> 0 AS first FROM fx_customers),
y AS (SELECT *, first AND (city2 <> city OR churn_value <> 0) AS changed,
             row_number() OVER (PARTITION BY first ORDER BY customer_id::VARCHAR) + CASE WHEN first THEN 0 ELSE (SELECT count(*) FROM x WHERE first) END AS n
      FROM x)""") + """
SELECT n AS row_no, customer_id::VARCHAR AS customer_id, city2 AS city, churn_value::INTEGER AS churn_value,
  CASE WHEN first THEN '2026-01-01 00:00:00' ELSE '2026-02-01 00:00:00' END AS created_at,
  CASE WHEN first AND NOT changed THEN '2026-01-01 00:00:00' ELSE '2026-02-01 00:00:00' END AS updated_at
FROM y"""


def _ddl_sql() -> str:
    parts = []
    for name, view, schema in (("customers", "fx_customers", S.CUSTOMERS), ("payments", "fx_payments", S.PAYMENTS),
                               ("support_tickets", "fx_tickets", S.SUPPORT_TICKETS)):
        for f in schema.fields:
            audit = f.name in ("created_at", "updated_at") and name != "support_tickets"
            n = "count(NULL)" if audit else f"count({f.name})"
            parts.append(f"SELECT '{name}' AS table_name, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, "
                         f"{n} AS n_values FROM {view}")
    return with_("fx") + " UNION ALL ".join(parts)


ORACLE["ddl_tables"] = _ddl_sql()
ORACLE["fallback_source"] = with_("fx") + """
SELECT payment_id, CAST(customer_id AS VARCHAR) AS customer_id, paperless_billing, payment_method, monthly_charges, total_charges FROM fx_payments"""
ORACLE["missing_input"] = """
SELECT 'events' AS table_name, count(*) AS n_rows FROM events UNION ALL SELECT 'support_tickets', 0"""
ORACLE["titled_features"] = with_("feature_table") + "SELECT " + ", ".join(
    f'{c} AS "{c if c in ("average_charges", "high_value_customer") else c.replace("_", " ").title()}"'
    for c in ["customer_id", *S.FEATURE_COLUMNS, S.TARGET]) + " FROM feature_table"
ORACLE["api_rows"] = with_("feature_table") + "SELECT customer_id, " + ", ".join(
    "CAST(0 AS BIGINT) AS support_ticket_count" if c == "support_ticket_count" else c for c in S.FEATURE_COLUMNS) + " FROM feature_table"

ORACLE["label_evaluation"] = """
WITH lab AS (SELECT doc_id, 'quality' AS target, quality AS label FROM labels
             UNION ALL SELECT doc_id, 'toxic', toxic FROM labels),
preds AS (SELECT l.target, d.lang, l.label, CAST(round(CAST(d.n_chars / (d.n_chars + 2000.0) AS DECIMAL(38,12)), 12) AS DOUBLE) AS probability
          FROM lab l JOIN documents d ON l.doc_id = d.doc_id),
st AS (SELECT target, lang, probability, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
       FROM preds GROUP BY ALL),
c AS (SELECT *,
        coalesce(sum(neg) OVER (PARTITION BY target, lang ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before,
        sum(pos) OVER (PARTITION BY target, lang ORDER BY probability DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
        sum(neg) OVER (PARTITION BY target, lang ORDER BY probability DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
      FROM st)
SELECT target, lang, CAST(sum(pos + neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS n_pos,
  CAST(round(CAST(sum(pos * (neg_before + neg / 2.0)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS DECIMAL(38,12)), 6) AS DOUBLE) AS roc_auc,
  CAST(round(CAST(sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / nullif(sum(pos), 0) AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_precision
FROM c GROUP BY target, lang"""
