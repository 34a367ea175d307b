"""DuckDB oracle SQL for the registered queries.

Written independently of the DataFrame code (different phrasing of the same
semantics), so that agreement is evidence.  Every query starts from the
driver tables through the fixture CTEs of FIXTURES.md.  Literals that meet
doubles are cast to DOUBLE, since DuckDB types ``0.7`` as DECIMAL.
"""

from __future__ import annotations

from churnlake.functions.hashing import unit_hash_sql

RUN_TS_SQL = "TIMESTAMP '2024-02-01 00:00:00'"

# --- fixture relations -------------------------------------------------------
CTE_RAW = """
ord AS (
  SELECT o_custkey, COUNT(*) AS n_orders,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spend,
         MAX(o_orderdate) AS last_order
  FROM orders GROUP BY o_custkey
),
b AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
         o.n_orders, o.spend, o.last_order,
         CAST((c.c_custkey*31 + COALESCE(o.n_orders,0)*7) % 73 AS INT) AS t
  FROM customer c LEFT JOIN ord o ON c.c_custkey = o.o_custkey
),
rawk AS (
  SELECT c_custkey,
    c_name AS customerID,
    CAST(CASE WHEN c_nationkey % 5 = 0 THEN 1 ELSE 0 END AS INT) AS SeniorCitizen,
    CASE WHEN (c_custkey*3) % 10 < 5 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN (c_custkey*7) % 10 < 3 THEN 'Yes' ELSE 'No' END AS Dependents,
    t AS tenure,
    CASE WHEN (c_custkey*11) % 10 < 9 THEN 'Yes' ELSE 'No' END AS PhoneService,
    CASE WHEN (c_custkey*11) % 10 >= 9 THEN 'No phone service' WHEN c_custkey % 4 < 2 THEN 'Yes' ELSE 'No' END AS MultipleLines,
    CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 5 < 2 THEN 'DSL' WHEN c_custkey % 5 < 4 THEN 'Fiber optic' ELSE 'No' END AS InternetService,
    CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 5 = 4 THEN 'No internet service' WHEN c_custkey % 7 < 3 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
    CASE WHEN c_custkey % 5 = 4 THEN 'No internet service' WHEN c_custkey % 8 < 3 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
    CASE WHEN c_custkey % 5 = 4 THEN 'No internet service' WHEN c_custkey % 9 < 3 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
    CASE WHEN c_custkey % 5 = 4 THEN 'No internet service' WHEN c_custkey % 11 < 4 THEN 'Yes' ELSE 'No' END AS TechSupport,
    CASE WHEN c_custkey % 5 = 4 THEN 'No internet service' WHEN c_custkey % 13 < 6 THEN 'Yes' ELSE 'No' END AS StreamingTV,
    CASE WHEN c_custkey % 5 = 4 THEN 'No internet service' WHEN c_custkey % 16 < 7 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
    CASE c_custkey % 3 WHEN 0 THEN 'Month-to-month' WHEN 1 THEN 'One year' ELSE 'Two year' END AS Contract,
    CASE WHEN c_custkey % 19 < 11 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    CASE c_mktsegment WHEN 'FURNITURE' THEN 'Electronic check' WHEN 'BUILDING' THEN 'Mailed check'
         WHEN 'MACHINERY' THEN 'Bank transfer (automatic)' ELSE 'Credit card (Automatic)' END AS PaymentMethod,
    18 + (c_acctbal + 1000)/110 AS MonthlyCharges,
    CASE WHEN spend IS NULL OR t = 0 THEN ' ' ELSE CAST(spend AS VARCHAR(40)) END AS TotalCharges,
    CASE WHEN ((last_order IS NULL OR last_order < TIMESTAMP '2000-07-01 00:00:00') AND c_custkey % 3 <> 2)
              OR (c_custkey % 3 = 0 AND t <= 12) THEN 'Yes' ELSE 'No' END AS Churn
  FROM b
),
raw AS (SELECT * EXCLUDE (c_custkey) FROM rawk)"""

CTE_FEATURES = """
eng AS (
  SELECT r.*, COALESCE(TRY_CAST(r.TotalCharges AS DOUBLE), r.MonthlyCharges) AS tc,
    CASE WHEN Contract = 'Month-to-month' THEN 1 ELSE 0 END AS c_m2m,
    CASE WHEN Contract = 'One year' THEN 1 ELSE 0 END AS c_1y,
    CASE WHEN Contract = 'Two year' THEN 1 ELSE 0 END AS c_2y,
    CASE WHEN PaymentMethod = 'Electronic check' THEN 1 ELSE 0 END AS pay_el,
    CASE WHEN lower(PaymentMethod) LIKE '%automatic%' THEN 1 ELSE 0 END AS pay_auto,
    CASE WHEN tenure <= 6 THEN 1 ELSE 0 END AS is_new,
    CASE WHEN tenure >= 24 THEN 1 ELSE 0 END AS is_loyal,
    CASE WHEN TechSupport = 'Yes' THEN 1 ELSE 0 END AS support,
    CASE WHEN InternetService = 'Fiber optic' THEN 1 ELSE 0 END AS fiber
  FROM raw r
),
features AS (
  SELECT customerID,
    tenure AS tenure_months,
    tenure / 12 AS tenure_years,
    MonthlyCharges AS monthly_charges,
    tc AS total_charges,
    tc / (tenure + 1) AS avg_monthly_charge,
    MonthlyCharges / (tenure + 1) AS charge_per_tenure,
    CAST((CASE WHEN PhoneService IN ('Yes','DSL','Fiber optic') THEN 1 ELSE 0 END)
       + (CASE WHEN MultipleLines IN ('Yes','DSL','Fiber optic') THEN 1 ELSE 0 END)
       + (CASE WHEN InternetService IN ('Yes','DSL','Fiber optic') THEN 1 ELSE 0 END)
       + (CASE WHEN OnlineSecurity IN ('Yes','DSL','Fiber optic') THEN 1 ELSE 0 END)
       + (CASE WHEN OnlineBackup IN ('Yes','DSL','Fiber optic') THEN 1 ELSE 0 END)
       + (CASE WHEN DeviceProtection IN ('Yes','DSL','Fiber optic') THEN 1 ELSE 0 END)
       + (CASE WHEN TechSupport IN ('Yes','DSL','Fiber optic') THEN 1 ELSE 0 END)
       + (CASE WHEN StreamingTV IN ('Yes','DSL','Fiber optic') THEN 1 ELSE 0 END)
       + (CASE WHEN StreamingMovies IN ('Yes','DSL','Fiber optic') THEN 1 ELSE 0 END) AS INT) AS total_services,
    CAST(3*c_m2m + 2*pay_el + 2*is_new + (1 - support) + fiber - 2*is_loyal AS INT) AS risk_score,
    CAST(is_new AS INT) AS is_new_customer,
    CAST(is_loyal AS INT) AS is_loyal_customer,
    CAST(c_m2m AS INT) AS contract_month_to_month,
    CAST(c_1y AS INT) AS contract_one_year,
    CAST(c_2y AS INT) AS contract_two_year,
    CAST(pay_el AS INT) AS payment_electronic,
    CAST(pay_auto AS INT) AS payment_auto,
    CAST(CASE WHEN InternetService = 'No' THEN 0 ELSE 1 END AS INT) AS has_internet,
    CAST(fiber AS INT) AS has_fiber,
    SeniorCitizen AS is_senior,
    CAST(CASE WHEN Partner = 'Yes' THEN 1 ELSE 0 END AS INT) AS has_partner,
    CAST(CASE WHEN Dependents = 'Yes' THEN 1 ELSE 0 END AS INT) AS has_dependents,
    CAST(CASE WHEN PaperlessBilling = 'Yes' THEN 1 ELSE 0 END AS INT) AS paperless_billing,
    CAST(CASE WHEN OnlineSecurity = 'Yes' OR OnlineBackup = 'Yes' OR DeviceProtection = 'Yes' THEN 1 ELSE 0 END AS INT) AS has_security,
    CAST(support AS INT) AS has_support,
    CAST(CASE WHEN StreamingTV = 'Yes' OR StreamingMovies = 'Yes' THEN 1 ELSE 0 END AS INT) AS has_streaming,
    CAST(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS INT) AS churn_label,
    """ + RUN_TS_SQL + """ AS feature_timestamp,
    Contract
  FROM eng
)"""

CTE_SCORED = """
scored AS (
  SELECT r.customerID, m.model,
    CAST(CASE WHEN r.Churn = 'Yes' THEN 1 ELSE 0 END AS INT) AS label,
    CAST(0.7 AS DOUBLE) * """ + unit_hash_sql("r.customerID", "m.model", salt_is_sql=True) + """
      + (CAST(0.3 AS DOUBLE) * CAST(CASE WHEN r.Churn = 'Yes' THEN 1 ELSE 0 END AS INT)) * m.s AS probability
  FROM raw r CROSS JOIN (VALUES ('logistic_regression', CAST(0.6 AS DOUBLE)),
                                ('random_forest', CAST(0.8 AS DOUBLE)),
                                ('gradient_boosting', CAST(1.0 AS DOUBLE))) AS m(model, s)
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


RAW = with_ctes(CTE_RAW)
FEAT = with_ctes(CTE_RAW, CTE_FEATURES)
SCORED = with_ctes(CTE_RAW, CTE_SCORED)

CTE_REQUESTS = """
requests AS (
  SELECT customerID AS customer_id,
    CAST(tenure AS DOUBLE) AS tenure_months,
    CASE WHEN c_custkey % 23 = 0 THEN -MonthlyCharges ELSE MonthlyCharges END AS monthly_charges,
    TRY_CAST(TotalCharges AS DOUBLE) AS total_charges,
    Contract AS contract_type, PaymentMethod AS payment_method, InternetService AS internet_service,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE PhoneService = 'Yes' END AS has_phone,
    Partner = 'Yes' AS has_partner, Dependents = 'Yes' AS has_dependents, SeniorCitizen = 1 AS is_senior,
    COALESCE(OnlineSecurity = 'Yes', false) AS has_online_security,
    TechSupport = 'Yes' AS has_tech_support,
    (StreamingTV = 'Yes' OR StreamingMovies = 'Yes') AS has_streaming,
    PaperlessBilling = 'Yes' AS paperless_billing
  FROM rawk
),
checked AS (
  SELECT *, concat_ws(';',
    CASE WHEN customer_id IS NULL THEN 'missing:customer_id' END,
    CASE WHEN tenure_months IS NULL THEN 'missing:tenure_months' END,
    CASE WHEN monthly_charges IS NULL THEN 'missing:monthly_charges' END,
    CASE WHEN total_charges IS NULL THEN 'missing:total_charges' END,
    CASE WHEN contract_type IS NULL THEN 'missing:contract_type' END,
    CASE WHEN payment_method IS NULL THEN 'missing:payment_method' END,
    CASE WHEN internet_service IS NULL THEN 'missing:internet_service' END,
    CASE WHEN tenure_months < 0 THEN 'negative:tenure_months' END,
    CASE WHEN monthly_charges < 0 THEN 'negative:monthly_charges' END,
    CASE WHEN total_charges < 0 THEN 'negative:total_charges' END) AS reasons
  FROM requests
),
valid AS (
  SELECT * EXCLUDE (has_phone, reasons), COALESCE(has_phone, true) AS has_phone FROM checked WHERE reasons = ''
),
rfeat AS (
  SELECT customer_id,
    tenure_months, tenure_months / 12 AS tenure_years, monthly_charges, total_charges,
    total_charges / (tenure_months + 1) AS avg_monthly_charge,
    monthly_charges / (tenure_months + 1) AS charge_per_tenure,
    CAST(has_phone AS INT) + CAST(has_online_security AS INT) + CAST(has_tech_support AS INT)
      + CAST(has_streaming AS INT) + CAST(internet_service <> 'No' AS INT) AS total_services,
    (CASE WHEN contract_type = 'Month-to-month' THEN 3 ELSE 0 END)
      + (CASE WHEN lower(payment_method) LIKE '%electronic%' THEN 2 ELSE 0 END)
      + (CASE WHEN tenure_months <= 6 THEN 2 WHEN tenure_months >= 24 THEN -2 ELSE 0 END)
      + (CASE WHEN NOT has_tech_support THEN 1 ELSE 0 END)
      + (CASE WHEN internet_service = 'Fiber optic' THEN 1 ELSE 0 END) AS risk_score,
    CAST(tenure_months <= 6 AS INT) AS is_new_customer,
    CAST(tenure_months >= 24 AS INT) AS is_loyal_customer,
    CAST(contract_type = 'Month-to-month' AS INT) AS contract_month_to_month,
    CAST(contract_type = 'One year' AS INT) AS contract_one_year,
    CAST(contract_type = 'Two year' AS INT) AS contract_two_year,
    CAST(lower(payment_method) LIKE '%electronic%' AS INT) AS payment_electronic,
    CAST(lower(payment_method) LIKE '%automatic%' AS INT) AS payment_auto,
    CAST(internet_service <> 'No' AS INT) AS has_internet,
    CAST(internet_service = 'Fiber optic' AS INT) AS has_fiber,
    CAST(is_senior AS INT) AS is_senior,
    CAST(has_partner AS INT) AS has_partner,
    CAST(has_dependents AS INT) AS has_dependents,
    CAST(paperless_billing AS INT) AS paperless_billing,
    CAST(has_online_security AS INT) AS has_security,
    CAST(has_tech_support AS INT) AS has_support,
    CAST(has_streaming AS INT) AS has_streaming
  FROM valid
)"""

CTE_PREDICTION_LOG = """
plog AS (
  SELECT event_id AS request_id, ts, CAST(user_id AS VARCHAR(20)) AS customer_id, value AS latency_ms,
    CASE WHEN event_type = 'view' THEN 'batch' ELSE 'predict' END AS endpoint,
    CASE WHEN """ + unit_hash_sql("CAST(user_id AS VARCHAR(20))", "ab") + """ < CAST(0.8 AS DOUBLE)
         THEN 'telco-churn-random_forest' ELSE 'telco-churn-gradient_boosting' END AS model,
    CASE WHEN """ + unit_hash_sql("CAST(user_id AS VARCHAR(20))", "ab") + """ < CAST(0.8 AS DOUBLE)
         THEN 'A' ELSE 'B' END AS ab_group
  FROM events
)"""

CTE_MODEL_VERSIONS = """
mv AS (
  SELECT CASE user_id % 3 WHEN 0 THEN 'telco-churn-logistic_regression'
                          WHEN 1 THEN 'telco-churn-random_forest'
                          ELSE 'telco-churn-gradient_boosting' END AS name,
    CAST(event_id AS VARCHAR(20)) AS version,
    concat('run-', CAST(event_id AS VARCHAR(20))) AS run_id,
    CASE WHEN event_id % 97 = 0 THEN 'Production' WHEN event_id % 7 = 0 THEN 'Archived' ELSE 'None' END AS stage
  FROM events
)"""

REQ = with_ctes(CTE_RAW, CTE_REQUESTS)
PLOG = with_ctes(CTE_PREDICTION_LOG)
MV = with_ctes(CTE_MODEL_VERSIONS)
