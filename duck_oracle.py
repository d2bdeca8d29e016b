"""DuckDB oracle: the model written as plain SQL over the driver's tables.

Each model is one SELECT over the models it depends on; :func:`sql_for` inlines a model and its
dependencies as a WITH chain. The fixture views (raw licences, events, transactions) come first.
The SQL follows the original models with these deliberate, documented corrections, mirrored by the
Spark library: product-scoped counters compare to the canonical product name; transaction product
names are upper-cased; licences are deduplicated before the revenue join; blank product names become
NULL in staging; the health score's as-of date is fixed (2001-08-01) instead of the wall clock.
"""

from __future__ import annotations

import re


_HOSTING = "CASE {n} % 4 WHEN 0 THEN 'Cloud' WHEN 1 THEN ' Server ' WHEN 2 THEN 'Data Center' ELSE ' ' END"

RAW_LICENSES = f"""
SELECT
  CAST(k AS VARCHAR) AS addon_license_id, 'L' || k AS license_id, 'E' || k AS app_entitlement_number,
  'H' || o_custkey AS host_license_id, 'HE' || (k % 997) AS host_entitlement_number,
  CASE WHEN k % 3 = 0 THEN ' cloud-' || o_custkey END AS cloud_id,
  CASE WHEN k % 3 = 0 THEN 'site' || o_custkey || '.example.net' END AS cloud_site_hostname,
  'app.' || (k % 3) AS addon_key,
  CASE k % 3 WHEN 0 THEN 'Alpha Suite' WHEN 1 THEN ' beta suite ' ELSE 'GAMMA SUITE' END AS addon_name,
  {_HOSTING.format(n='k')} AS hosting,
  d + CAST(k % 60 + 90 * copy AS INTEGER) AS last_updated,
  CASE WHEN k % 17 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'Evaluation' ELSE 'COMMERCIAL' END AS license_type,
  d AS maintenance_start_date,
  CASE WHEN k % 29 = 0 THEN NULL ELSE d + CAST(30 * (1 + k % 13) AS INTEGER) END AS maintenance_end_date,
  CASE WHEN k % 37 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'inactive' ELSE 'Active' END AS status,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Free' WHEN 'MACHINERY' THEN 'Standard'
       WHEN 'FURNITURE' THEN 'Professional' WHEN 'BUILDING' THEN 'Premium'
       WHEN 'AUTOMOBILE' THEN CASE c_nationkey % 3 WHEN 1 THEN 'Enterprise' WHEN 2 THEN 'Legacy seat pack' END
       END AS tier,
  CASE WHEN k % 41 = 0 THEN '   ' WHEN k % 4 = 0 THEN '  ' || lower(c_name) || ' ' ELSE c_name END AS company,
  'N' || c_nationkey AS country, 'R' || (c_nationkey % 5) AS region,
  'it' || o_custkey || '@example.net' AS tech_contact_email, 'Contact ' || o_custkey AS tech_contact_name,
  o_orderpriority AS evaluation_opportunity_size, CASE WHEN k % 2 = 0 THEN 'EV' || k END AS evaluation_license,
  CAST(CASE WHEN k % 5 < 2 THEN k % 23 + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END END AS BIGINT) AS days_to_convert_eval,
  CASE WHEN k % 2 = 0 THEN d - 30 END AS evaluation_start_date, CASE WHEN k % 2 = 0 THEN d END AS evaluation_end_date,
  CASE WHEN k % 5 < 2 THEN d - 30 + CAST(k % 23 AS INTEGER) END AS evaluation_sale_date,
  'channel ' || (k % 4) AS channel, 'name ' || (k % 11) AS campaign_name, 'source ' || (k % 13) AS campaign_source,
  'medium ' || (k % 7) AS campaign_medium, 'content ' || (k % 5) AS campaign_content,
  'referrer ' || (k % 19) AS referrer_domain
FROM (SELECT *, o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders JOIN customer ON o_custkey = c_custkey)
JOIN (VALUES (0), (1)) times(copy) ON copy = 0 OR k % 43 = 0
"""

RAW_EVENTS = """
SELECT
  CAST(event_id AS VARCHAR) AS event_id,
  CASE (event_id * 7 + user_id) % 31
    WHEN 0 THEN 'automated_test_run' WHEN 1 THEN 'api_health_check'
    WHEN 2 THEN 'checklist_item_created' WHEN 3 THEN 'checklist_item_completed'
    WHEN 4 THEN 'checklist_template_applied' WHEN 5 THEN 'checklist_exported'
    WHEN 6 THEN 'checklist_shared' WHEN 7 THEN 'timesheet_submitted'
    WHEN 8 THEN 'timesheets_approved' WHEN 9 THEN 'time_logged' WHEN 10 THEN 'timer_started'
    WHEN 11 THEN 'report_generated' WHEN 12 THEN 'onboarding_started'
    WHEN 13 THEN 'onboarding_completed' WHEN 14 THEN 'subscription_activated'
    WHEN 15 THEN 'subscription_cancelled' WHEN 16 THEN 'app_uninstalled'
    ELSE 'page_viewed' END AS event_type,
  ts - (INTERVAL '1' DAY * CAST(8220 + 30 * (event_id % 80) AS INTEGER)) AS event_time,
  'u' || user_id AS user_id, 'device ' || (user_id * 2 + event_id % 2) AS device_id,
  CASE event_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN ' ios' ELSE 'android' END AS platform,
  'source ' || (event_id % 5) AS event_source,
  CASE (event_id * 5 + user_id) % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN ' Beta' ELSE 'gamma' END AS product,
  props AS event_properties,
  CASE WHEN event_id % 53 = 0 THEN ' '
       WHEN user_id % 25 = 0 THEN 'Ghost ' || user_id
       WHEN event_id % 4 = 0 THEN lower(c_name) || ' '
       ELSE c_name END AS user_property_company,
  'plan ' || (user_id % 4) AS user_property_plan, 'tier ' || (user_id % 6) AS user_property_tier,
  CAST(event_id % 1000 AS BIGINT) AS session_id,
  'N' || (user_id % 25) AS country, 'R' || (user_id % 5) AS region
FROM events LEFT JOIN customer ON c_custkey = floor(user_id / 3)
"""

RAW_TRANSACTIONS = f"""
SELECT
  ok || '-' || l_linenumber || '-' || l_partkey AS transaction_id,
  CAST(ok AS VARCHAR) AS addon_license_id, 'L' || ok AS license_id, 'E' || ok AS app_entitlement_number,
  'app.' || (ok % 3) AS addon_key,
  CASE ok % 3 WHEN 0 THEN 'Alpha Suite' WHEN 1 THEN 'Beta Suite' ELSE 'Gamma Suite' END AS addon_name,
  {_HOSTING.format(n='l_suppkey')} AS hosting,
  CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE shipped END AS sale_date,
  CASE WHEN refund THEN 'Refund'
       WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'new'
       WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Upgrade'
       WHEN l_returnflag = 'A' THEN 'Downgrade'
       ELSE 'Renewal' END AS sale_type,
  CAST(cents * 0.01 AS DECIMAL(38,2)) AS purchase_price,
  CAST(CASE WHEN refund AND l_partkey % 2 = 0 THEN -paid ELSE paid END * 0.01 AS DECIMAL(38,2)) AS vendor_amount,
  CASE WHEN l_linenumber % 2 = 0 THEN 'Annual' ELSE ' Monthly' END AS billing_period,
  'tier ' || (l_suppkey % 5) AS tier, shipped AS maintenance_start_date, shipped + 30 AS maintenance_end_date,
  'channel ' || (l_suppkey % 3) AS sale_channel, 'parent ' || (ok % 4) AS parent_product_name,
  'edition ' || (ok % 6) AS parent_product_edition,
  CAST(CAST(round(l_tax * 100) AS DECIMAL(18,0)) * 0.25 AS DECIMAL(38,2)) AS loyalty_discount,
  CAST(CAST(l_quantity AS DECIMAL(18,0)) * 0.10 AS DECIMAL(38,2)) AS marketplace_promotion_discount,
  CAST(l_linenumber * 0.35 AS DECIMAL(38,2)) AS expert_discount,
  CAST((l_suppkey % 10) * 0.15 AS DECIMAL(38,2)) AS manual_discount
FROM (
  SELECT *, l_orderkey AS ok, CAST(l_shipdate AS DATE) AS shipped,
         CAST(round(l_extendedprice * 100) AS DECIMAL(18,0)) AS cents,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) // 100
              AS DECIMAL(18,0)) AS paid,
         l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 1 AS refund
  FROM lineitem)
"""


def _clean(cols: str) -> str:
    return ",\n  ".join(f"nullif(trim(CAST({c} AS VARCHAR)), '') AS {c}" for c in cols.split())


STG_EVENTS = f"""
SELECT
  {_clean('event_id event_type')},
  CAST(event_time AS TIMESTAMP) AS event_time,
  {_clean('user_id device_id platform event_source')},
  CASE WHEN upper(nullif(trim(product), '')) = 'ALPHA' THEN 'ALPHA SUITE'
       WHEN upper(nullif(trim(product), '')) = 'BETA' THEN 'BETA SUITE'
       WHEN upper(nullif(trim(product), '')) = 'GAMMA' THEN 'GAMMA SUITE'
       ELSE upper(nullif(trim(product), '')) END AS product,
  {_clean('event_properties user_property_company user_property_plan user_property_tier')},
  CAST(session_id AS BIGINT) AS session_id,
  {_clean('country region')}
FROM raw_events
"""

STG_LICENSES = f"""
SELECT
  {_clean('addon_license_id license_id app_entitlement_number host_license_id host_entitlement_number cloud_id cloud_site_hostname addon_key')},
  upper(nullif(trim(addon_name), '')) AS addon_name,
  {_clean('hosting')},
  CAST(last_updated AS DATE) AS last_updated,
  {_clean('license_type')},
  CAST(maintenance_start_date AS DATE) AS maintenance_start_date,
  CAST(maintenance_end_date AS DATE) AS maintenance_end_date,
  {_clean('status tier company country region tech_contact_email tech_contact_name evaluation_opportunity_size')},
  nullif(trim(CAST(evaluation_license AS VARCHAR)), '') AS evaluation_license_id,
  CAST(days_to_convert_eval AS BIGINT) AS days_to_convert_eval,
  CAST(evaluation_start_date AS DATE) AS evaluation_start_date,
  CAST(evaluation_end_date AS DATE) AS evaluation_end_date,
  CAST(evaluation_sale_date AS DATE) AS evaluation_sale_date,
  {_clean('channel campaign_name campaign_source campaign_medium campaign_content referrer_domain')}
FROM raw_licenses
"""

STG_TRANSACTIONS = f"""
SELECT
  {_clean('transaction_id addon_license_id license_id app_entitlement_number addon_key')},
  upper(nullif(trim(addon_name), '')) AS addon_name,
  {_clean('hosting')},
  CAST(sale_date AS DATE) AS sale_date,
  {_clean('sale_type')},
  CAST(purchase_price AS DECIMAL(38,0)) AS purchase_price,
  CAST(vendor_amount AS DECIMAL(38,0)) AS vendor_amount,
  {_clean('billing_period tier')},
  CAST(maintenance_start_date AS DATE) AS maintenance_start_date,
  CAST(maintenance_end_date AS DATE) AS maintenance_end_date,
  {_clean('sale_channel parent_product_name parent_product_edition')},
  CAST(loyalty_discount AS DECIMAL(38,0)) AS loyalty_discount,
  CAST(marketplace_promotion_discount AS DECIMAL(38,0)) AS marketplace_promotion_discount,
  CAST(expert_discount AS DECIMAL(38,0)) AS expert_discount,
  CAST(manual_discount AS DECIMAL(38,0)) AS manual_discount
FROM raw_transactions
"""

# Output counter, event, product that it is limited to (any: empty).
COUNTERS = (
    ("checklist_items_created", "checklist_item_created", "ALPHA SUITE"),
    ("checklist_items_completed", "checklist_item_completed", "ALPHA SUITE"),
    ("templates_applied", "checklist_template_applied", "ALPHA SUITE"),
    ("checklists_exported", "checklist_exported", "ALPHA SUITE"),
    ("checklists_shared", "checklist_shared", "ALPHA SUITE"),
    ("timesheets_submitted", "timesheet_submitted", "BETA SUITE"),
    ("timesheets_approved", "timesheets_approved", "BETA SUITE"),
    ("time_logged", "time_logged", "BETA SUITE"),
    ("timers_started", "timer_started", "BETA SUITE"),
    ("reports_generated", "report_generated", "BETA SUITE"),
    ("onboarding_completed", "onboarding_completed", ""),
    ("onboarding_started", "onboarding_started", ""),
    ("subscription_activated", "subscription_activated", ""),
    ("subscription_cancelled", "subscription_cancelled", ""),
    ("app_uninstalled", "app_uninstalled", ""),
)
FEATURES = [name for name, _, product in COUNTERS if product]

INT_FEATURE_USAGE = """
WITH per_day AS (
  SELECT upper(user_property_company) AS company, product, event_time::DATE AS day, user_id, session_id,
         event_type, count(*) AS n
  FROM stg_events WHERE event_type NOT IN ('automated_test_run', 'api_health_check') GROUP BY ALL)
SELECT company, product, sum(n)::BIGINT AS total_events, count(DISTINCT user_id) AS distinct_users,
       count(DISTINCT session_id) AS distinct_sessions, min(day) AS first_event_date,
       max(day) AS last_event_date, count(DISTINCT day) AS active_days,
       """ + ",\n       ".join(
    f"coalesce(sum(n) FILTER (event_type = '{event}'" + (f" AND product = '{product}'" if product else "")
    + f"), 0)::BIGINT AS {name}" for name, event, product in COUNTERS) + """
FROM per_day GROUP BY company, product
"""


INT_CUSTOMER_ENTITY = """
WITH held AS (
  SELECT *, upper(company) AS name FROM stg_licenses WHERE company IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY name, addon_name ORDER BY last_updated DESC NULLS LAST, license_id DESC NULLS LAST) = 1),
seen AS (
  SELECT upper(user_property_company) AS name, product, count(DISTINCT user_id) AS distinct_users,
         count(*) AS total_events, min(event_time) AS first_seen, max(event_time) AS last_seen, TRUE AS used
  FROM stg_events GROUP BY ALL)
SELECT coalesce(held.name, seen.name) AS company, cloud_id, cloud_site_hostname, tech_contact_email,
       coalesce(addon_name, CASE WHEN held.name IS NULL THEN seen.product END) AS addon_name, status, license_type,
       tier, hosting, distinct_users, total_events, first_seen, last_seen,
       CASE WHEN held.name IS NULL THEN 'unresolved' WHEN used THEN 'matched_on_company'
            ELSE 'marketplace_only' END AS match_type
FROM held FULL JOIN seen ON held.name = seen.name AND held.addon_name = seen.product
"""

INT_TRIAL_LIFECYCLE = """
WITH spans AS (FROM stg_licenses SELECT *, evaluation_start_date AS began, evaluation_sale_date AS sold)
FROM spans SELECT upper(company) AS company, addon_name, license_id, evaluation_license_id,
  began IS NOT NULL OR upper(license_type) = 'EVALUATION' AS is_trial, sold IS NOT NULL AS converted,
  (sold - began)::BIGINT AS days_to_convert, began AS trial_start_date, evaluation_end_date AS trial_end_date,
  sold AS converted_date, status AS current_status
WHERE license_type IS NOT NULL
"""

DIM_CUSTOMERS = """
SELECT company, addon_name, cloud_id, cloud_site_hostname, tech_contact_email, status,
       license_type, tier, hosting, distinct_users, total_events, first_seen, last_seen, match_type
FROM int_customer_entity
"""

_LICENCE_SOURCE = """
  SELECT license_id, upper(company) AS company, addon_name, upper(status) = 'ACTIVE' AS is_active,
         maintenance_start_date AS since, coalesce(maintenance_end_date, DATE '2999-12-31') AS until,
         maintenance_end_date AS ended
  FROM stg_licenses
  WHERE company IS NOT NULL AND addon_name IS NOT NULL AND maintenance_start_date IS NOT NULL {only}
"""
_IN_DIM = "AND (upper(company), addon_name) IN (SELECT (company, addon_name) FROM dim_customers WHERE addon_name IS NOT NULL AND company IS NOT NULL)"
_IN_MATCHED = _IN_DIM.replace("WHERE", "WHERE match_type = 'matched_on_company' AND")

_MONTH_SPINE = """
  SELECT date_trunc('month', since)::DATE AS month FROM {src} GROUP BY 1
"""
_ACTIVE_BY_MONTH = """
  SELECT month, addon_name, count(DISTINCT company) AS active_customer_count
  FROM {spine}, {src} WHERE is_active AND last_day(month) BETWEEN since AND until
  GROUP BY month, addon_name
"""
_NEW_CUSTOMERS = """
  SELECT date_trunc('month', since)::DATE AS month, addon_name, count(*) AS new_customers
  FROM (FROM {src} SELECT DISTINCT ON (company, addon_name) * ORDER BY company, addon_name, since) GROUP BY ALL
"""
# The latest start of a valid active licence of the same customer does not come after the end.
_LAST_OF_KEY = """
  SELECT * FROM {src}
  QUALIFY ended IS NOT NULL AND coalesce(max(since) FILTER (is_active AND until >= since)
                                         OVER (PARTITION BY company, addon_name) <= ended, TRUE)
"""

FCT_ACTIVE_CUSTOMERS = f"""
WITH lost AS (
  SELECT date_trunc('month', ended)::DATE AS month, addon_name, count(DISTINCT company) AS n
  FROM ({_LAST_OF_KEY.format(src='ac_source')}) GROUP BY ALL),
counted AS (
  SELECT month, addon_name, active_customer_count, coalesce(new_customers, 0) AS new_customers,
         coalesce(lost.n, 0) AS churned_customers
  FROM ({_ACTIVE_BY_MONTH.format(src='ac_source', spine='ac_spine')})
  LEFT JOIN ({_NEW_CUSTOMERS.format(src='ac_source')}) USING (month, addon_name)
  LEFT JOIN lost USING (month, addon_name))
SELECT *, active_customer_count - lag(active_customer_count) OVER (PARTITION BY addon_name ORDER BY month) AS mom_change
FROM counted
"""

FCT_TRIAL_CONVERSION = """
WITH begun AS (
  SELECT date_trunc('month', trial_start_date)::DATE AS month, addon_name, is_trial, converted,
         days_to_convert AS days
  FROM int_trial_lifecycle WHERE trial_start_date IS NOT NULL),
cohort AS (
  SELECT month, addon_name, count(*) FILTER (is_trial) AS trials_started,
         count(*) FILTER (is_trial AND converted) AS trials_converted,
         avg(days) FILTER (converted) AS avg_days_to_convert, median(days) FILTER (converted) AS median_days_to_convert
  FROM begun GROUP BY ALL)
SELECT *, trials_converted / nullif(trials_started, 0)::DOUBLE AS conversion_rate FROM cohort
"""

FCT_CHURN_AND_NRR = """
WITH owner AS (
  SELECT license_id, addon_name, upper(company) AS company FROM stg_licenses
  WHERE company IS NOT NULL AND (upper(company), addon_name) IN (SELECT (company, addon_name) FROM dim_customers)
  GROUP BY ALL),
sale AS (
  SELECT date_trunc('month', sale_date)::DATE AS month, addon_name, company, upper(sale_type) AS kind, vendor_amount AS amount
  FROM stg_transactions JOIN owner USING (license_id, addon_name)
  WHERE sale_date IS NOT NULL AND vendor_amount IS NOT NULL),
leaving AS (
  SELECT DISTINCT date_trunc('month', event_time)::DATE AS month, upper(user_property_company) AS company, product AS addon_name
  FROM stg_events WHERE event_type = 'subscription_cancelled'),
customer AS (
  SELECT month, addon_name, company, sum(amount) AS total,
         coalesce(sum(amount) FILTER (kind IN ('NEW', 'RENEWAL', 'UPGRADE')), 0) AS recurring,
         coalesce(sum(amount) FILTER (kind = 'UPGRADE'), 0) AS up, coalesce(sum(amount) FILTER (kind = 'DOWNGRADE'), 0) AS down,
         coalesce(sum(amount) FILTER (kind = 'REFUND'), 0) > 0 OR (month, company, addon_name) IN (FROM leaving SELECT (month, company, addon_name)) AS lost
  FROM sale GROUP BY month, addon_name, company),
monthly AS (
  SELECT month, addon_name, sum(recurring) AS mrr, coalesce(sum(total) FILTER (lost), 0) AS churned_mrr,
         sum(up) AS expansion_mrr, sum(down) AS contraction_mrr
  FROM customer GROUP BY month, addon_name),
chained AS (SELECT *, lag(mrr) OVER (PARTITION BY addon_name ORDER BY month) AS beginning_mrr FROM monthly)
SELECT *, (beginning_mrr + expansion_mrr - contraction_mrr - churned_mrr)::DOUBLE / nullif(beginning_mrr::DOUBLE, 0) AS nrr,
       churned_mrr::DOUBLE / nullif(beginning_mrr::DOUBLE, 0) AS churn_rate
FROM chained
"""

FCT_FEATURE_ADOPTION = """
WITH trial AS (
  SELECT company, addon_name AS product, bool_or(converted) AS won, bool_or(upper(current_status) = 'INACTIVE') AS ended
  FROM int_trial_lifecycle GROUP BY ALL),
judged AS (
  SELECT u.* EXCLUDE (product), u.product AS addon_name,
         CASE WHEN won THEN 'converted' WHEN ended OR app_uninstalled > 0 THEN 'churned' ELSE 'active_trial' END AS outcome
  FROM int_feature_usage u LEFT JOIN trial USING (company, product))
SELECT *, """ + ", ".join(f"avg({column}) OVER peers AS {name}" for name, column in (
    ("avg_checklist_items_created", "checklist_items_created"), ("avg_checklist_items_completed", "checklist_items_completed"),
    ("avg_timesheets_submitted", "timesheets_submitted"), ("avg_time_logged", "time_logged"),
    ("avg_days_active", "active_days"), ("avg_distinct_users", "distinct_users"))) + """
FROM judged WINDOW peers AS (PARTITION BY addon_name, outcome)
"""

AS_OF = "DATE '2001-08-01'"

# Part of the tier's name and its user limit; the first that fits holds.
TIER_LIMITS = (("FREE", 10), ("STANDARD", 25), ("PRO", 50), ("PREMIUM", 100), ("ENTERPRISE", 250), ("", 50))

FCT_CUSTOMER_HEALTH = f"""
WITH tiers(part, most, place) AS (VALUES {", ".join(f"('{part}', {most}, {i})" for i, (part, most) in enumerate(TIER_LIMITS))}),
allowance AS (
  SELECT tier, arg_min(most, place) AS seats FROM (SELECT DISTINCT tier FROM dim_customers), tiers
  WHERE contains(upper(tier), part) GROUP BY tier),
trial AS (
  SELECT company, addon_name, max(current_status) AS trial_status, max(trial_end_date) AS covered_to
  FROM int_trial_lifecycle GROUP BY ALL),
points AS (
  SELECT d.company, d.addon_name, d.match_type,
         CASE WHEN {AS_OF} - last_event_date <= 30 THEN 25 WHEN {AS_OF} - last_event_date <= 60 THEN 15
              WHEN {AS_OF} - last_event_date <= 90 THEN 5 ELSE 0 END AS recency_score,
         CASE WHEN seats IS NULL THEN 10::DOUBLE ELSE least(25, coalesce(u.distinct_users, 0)::DOUBLE / seats * 25) END AS engagement_score,
         (5 * least(5, len(list_filter([{", ".join(f"u.{f}" for f in FEATURES)}], lambda x: x > 0))))::INTEGER AS feature_adoption_score,
         CASE WHEN upper(coalesce(d.status, trial_status)) = 'ACTIVE' AND covered_to IS NOT NULL
              THEN CASE WHEN covered_to - {AS_OF} > 30 THEN 25 ELSE 15 END ELSE 0 END AS license_health_score
  FROM dim_customers d LEFT JOIN allowance USING (tier)
  LEFT JOIN int_feature_usage u ON u.company = d.company AND u.product = d.addon_name
  LEFT JOIN trial ON trial.company = d.company AND trial.addon_name = d.addon_name
  WHERE d.addon_name IS NOT NULL),
added AS (SELECT *, recency_score + engagement_score + feature_adoption_score + license_health_score AS health_score FROM points)
SELECT *, CASE WHEN health_score >= 75 THEN 'healthy' WHEN health_score >= 40 THEN 'at_risk' ELSE 'critical' END AS health_tier
FROM added
"""

# The horizon on the latest maintenance end of the customer's licences instead of the latest trial end.
M12B_HEALTH = FCT_CUSTOMER_HEALTH.replace("points AS (", """upkeep AS (
  SELECT upper(company) AS company, addon_name, max(maintenance_end_date) AS kept_to
  FROM stg_licenses WHERE company IS NOT NULL GROUP BY ALL),
points AS (""").replace("covered_to IS", "kept_to IS").replace("covered_to -", "kept_to -").replace(
    "  WHERE d.addon_name", """  LEFT JOIN upkeep ON upkeep.company = d.company AND upkeep.addon_name = d.addon_name
  WHERE d.addon_name""")

INS_CONVERSION_BY_PRODUCT = """
WITH counted AS (
  FROM int_trial_lifecycle SELECT addon_name AS product, count(*) FILTER (is_trial) AS total_trials,
    count(*) FILTER (is_trial AND converted) AS converted, avg(days_to_convert) FILTER (converted) AS avg_days_to_convert
  GROUP BY ALL)
SELECT *, converted / nullif(total_trials, 0)::DOUBLE AS conversion_rate FROM counted
"""

INS_COVERAGE_BY_MATCH_TYPE = """
SELECT match_type, customers, avg_health_score, avg_recency_score,
       CAST(customers AS DOUBLE) / sum(customers) OVER () AS share_of_customers
FROM (
  SELECT match_type, count(*) AS customers,
         CAST(sum(CAST(health_score AS DECIMAL(28,6))) AS DOUBLE) / count(health_score) AS avg_health_score,
         avg(recency_score) AS avg_recency_score
  FROM fct_customer_health GROUP BY 1
) g
"""

INS_ENGAGEMENT_BY_OUTCOME = """
SELECT addon_name AS product, outcome, avg(distinct_users) AS avg_users,
       avg(active_days) AS avg_days_active
FROM fct_feature_adoption
GROUP BY 1, 2
"""

INS_DAYS_TO_CONVERT_CHECK = """
SELECT count(*) AS licenses,
       CAST(count_if(derived IS NOT NULL AND stored IS NOT NULL) AS BIGINT) AS compared,
       CAST(count_if(derived IS DISTINCT FROM stored) AS BIGINT) AS mismatched
FROM (SELECT datediff('day', evaluation_start_date, evaluation_sale_date) AS derived,
             days_to_convert_eval AS stored
      FROM stg_licenses) s
"""

# Building blocks over all licences with a known company, product and start (no dimension).
ALL_SOURCE = _LICENCE_SOURCE.format(only="")
B04_LATEST_PER_KEY = """
SELECT DISTINCT ON (upper(company), addon_name) upper(company) AS company, addon_name, license_id, last_updated, status
FROM stg_licenses WHERE company IS NOT NULL
ORDER BY upper(company), addon_name, last_updated DESC NULLS LAST, license_id DESC NULLS LAST
"""
B07_MONTH_SPINE = _MONTH_SPINE.format(src="all_source")
B08_ACTIVE_BY_MONTH = _ACTIVE_BY_MONTH.format(src="all_source", spine="all_spine")
B09_FIRST_PERIOD = _NEW_CUSTOMERS.format(src="all_source")
B10_WITHOUT_SUCCESSOR = f"""
SELECT company, addon_name, license_id, ended AS maintenance_end_date FROM ({_LAST_OF_KEY.format(src="all_source")})
"""

# The correlated form: no valid active licence of the same customer starts within 30 days after the end.
J05_NOT_RENEWED_WITHIN = """
SELECT company, addon_name, license_id, ended AS maintenance_end_date FROM all_source AS mine
WHERE ended IS NOT NULL AND NOT EXISTS (
  FROM all_source AS next WHERE next.company = mine.company AND next.addon_name = mine.addon_name AND next.is_active
    AND next.until >= next.since AND next.since > mine.ended AND next.since <= mine.ended + 30)
"""

# Text lines of sales, as they are written, and what is wrong with them; crc32 by its bits.
S02_TEXT_LOAD = """
WITH RECURSIVE remainder(byte, bit, value) AS (
  SELECT byte, 0, byte::UBIGINT FROM range(256) t(byte)
  UNION ALL
  SELECT byte, bit + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384::UBIGINT) ELSE value >> 1 END
  FROM remainder WHERE bit < 8),
crc_table AS (SELECT list(value ORDER BY byte) AS v FROM remainder WHERE bit = 8),
sale AS (
  SELECT transaction_id, license_id, sale_date, sale_type, vendor_amount,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(transaction_id, ''), lambda c: ascii(c)::UBIGINT)),
             lambda crc, c: xor(v[(xor(crc, c) & 255)::BIGINT + 1], crc >> 8)), 4294967295::UBIGINT) AS number
  FROM raw_transactions, crc_table),
cell AS (
  SELECT *, number % 101 = 0 AS bad_date, number % 67 = 0 AND vendor_amount IS NOT NULL AS bad_amount,
         CASE WHEN number % 101 = 0 THEN 'soon' ELSE coalesce(sale_date::VARCHAR, '') END AS date_text,
         vendor_amount::DECIMAL(38,2)::VARCHAR || CASE WHEN number % 67 = 0 THEN 'x' ELSE '' END AS amount_text
  FROM sale)
SELECT transaction_id, license_id, sale_date, sale_type, vendor_amount::DECIMAL(38,2) AS vendor_amount,
       NULL::VARCHAR AS raw, NULL::VARCHAR AS reason
FROM cell WHERE NOT bad_date AND NOT bad_amount
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, concat_ws(',', transaction_id, license_id, date_text, sale_type, amount_text),
       concat_ws('; ', CASE WHEN bad_date THEN 'sale_date: not a date: soon' END,
                 CASE WHEN bad_amount THEN 'vendor_amount: not a decimal(38,2): ' || amount_text END)
FROM cell WHERE bad_date OR bad_amount
"""

# A NULL company matches nothing on either side.
B05_RESOLVE_ENTITIES = """
WITH held AS (
  SELECT DISTINCT ON (upper(company), addon_name) upper(company) AS name, addon_name AS app, license_id, last_updated,
         status, 'marketplace_only' AS alone
  FROM stg_licenses ORDER BY upper(company), addon_name, last_updated DESC NULLS LAST, license_id DESC NULLS LAST),
seen AS (
  SELECT upper(user_property_company) AS name, product AS app, count(DISTINCT user_id) AS entity_distinct_users,
         count(*) AS entity_total_events, 'unresolved' AS alone
  FROM stg_events GROUP BY ALL)
SELECT coalesce(held.name, seen.name) AS company, coalesce(held.app, seen.app) AS addon_name, license_id, last_updated,
       status, entity_distinct_users, entity_total_events,
       CASE WHEN held.alone || seen.alone IS NULL THEN coalesce(held.alone, seen.alone) ELSE 'matched_on_company' END
         AS match_type
FROM held FULL JOIN seen ON held.name = seen.name AND held.app = seen.app
"""
B06_CONDITIONAL_COUNTS = """
SELECT addon_name,
       count(*) AS n_sales,
       CAST(count_if(upper(sale_type) = 'NEW') AS BIGINT) AS n_new,
       CAST(count_if(upper(sale_type) = 'RENEWAL') AS BIGINT) AS n_renewal,
       CAST(count_if(upper(sale_type) = 'UPGRADE') AS BIGINT) AS n_upgrade,
       CAST(count_if(upper(sale_type) = 'DOWNGRADE') AS BIGINT) AS n_downgrade,
       CAST(count_if(upper(sale_type) = 'REFUND') AS BIGINT) AS n_refund
FROM stg_transactions
GROUP BY 1
"""
B11_PERIOD_DELTA = """
SELECT month, addon_name, trials_started,
       trials_started - lag(trials_started) OVER (PARTITION BY addon_name ORDER BY month)
         AS trials_started_change
FROM fct_trial_conversion
"""
B14_ATTACH_GROUP_AVG = """
SELECT company, addon_name, match_type, recency_score,
       avg(recency_score) OVER (PARTITION BY match_type) AS avg_recency_of_match_type
FROM fct_customer_health
"""
B18_EXCLUDE_VALUES = """
SELECT event_id, event_type, product, user_property_company
FROM stg_events
WHERE event_type NOT IN ('automated_test_run', 'api_health_check')
"""

MODELS: dict[str, str] = {
    "raw_licenses": RAW_LICENSES,
    "raw_events": RAW_EVENTS,
    "raw_transactions": RAW_TRANSACTIONS,
    "stg_events": STG_EVENTS,
    "stg_licenses": STG_LICENSES,
    "stg_transactions": STG_TRANSACTIONS,
    "m03b_money_scale2": STG_TRANSACTIONS.replace("DECIMAL(38,0)", "DECIMAL(38,2)"),
    "int_feature_usage": INT_FEATURE_USAGE,
    "int_customer_entity": INT_CUSTOMER_ENTITY,
    "int_trial_lifecycle": INT_TRIAL_LIFECYCLE,
    "dim_customers": DIM_CUSTOMERS,
    "ac_source": _LICENCE_SOURCE.format(only=_IN_DIM),
    "ac_spine": _MONTH_SPINE.format(src="ac_source"),
    "fct_active_customers": FCT_ACTIVE_CUSTOMERS,
    "fct_trial_conversion": FCT_TRIAL_CONVERSION,
    "fct_churn_and_nrr": FCT_CHURN_AND_NRR,
    "fct_feature_adoption": FCT_FEATURE_ADOPTION,
    "fct_customer_health": FCT_CUSTOMER_HEALTH,
    "ins_conversion_by_product": INS_CONVERSION_BY_PRODUCT,
    "ins_coverage_by_match_type": INS_COVERAGE_BY_MATCH_TYPE,
    "ins_engagement_by_outcome": INS_ENGAGEMENT_BY_OUTCOME,
    "ins_days_to_convert_check": INS_DAYS_TO_CONVERT_CHECK,
    "all_source": ALL_SOURCE,
    "all_spine": _MONTH_SPINE.format(src="all_source"),
    "b04_latest_per_key": B04_LATEST_PER_KEY,
    "b07_month_spine": B07_MONTH_SPINE,
    "b08_active_by_month": B08_ACTIVE_BY_MONTH,
    "b09_first_period": B09_FIRST_PERIOD,
    "b10_without_successor": B10_WITHOUT_SUCCESSOR,
    "m12b_health_by_maintenance_end": M12B_HEALTH,
    "matched_source": _LICENCE_SOURCE.format(only=_IN_MATCHED),
    "matched_spine": _MONTH_SPINE.format(src="matched_source"),
    "j03_active_of_dimension": FCT_ACTIVE_CUSTOMERS.replace("ac_s", "matched_s"),
    "j09_churn_of_dimension": FCT_CHURN_AND_NRR.replace(
        "FROM dim_customers", "FROM dim_customers WHERE match_type = 'matched_on_company'"),
    "b05_resolve_entities": B05_RESOLVE_ENTITIES,
    "j05_not_renewed_within": J05_NOT_RENEWED_WITHIN,
    "s01_full_refresh": "SELECT * FROM stg_licenses",
    "s02_text_load": S02_TEXT_LOAD,
    "m12c_health_today": FCT_CUSTOMER_HEALTH.replace(AS_OF, "current_date"),
    "s03_named_source": FCT_CUSTOMER_HEALTH,
    "m10b_churn_by_negative_refunds": FCT_CHURN_AND_NRR.replace("kind = 'REFUND'), 0) > 0", "kind = 'REFUND'), 0) < 0"),
    "b06_conditional_counts": B06_CONDITIONAL_COUNTS,
    "b11_period_delta": B11_PERIOD_DELTA,
    "b14_attach_group_avg": B14_ATTACH_GROUP_AVG,
    "b18_exclude_values": B18_EXCLUDE_VALUES,
}

_WORD = re.compile(r"\b[a-z][a-z0-9_]*\b")


def _deps(name: str) -> list[str]:
    text = MODELS[name]
    return [m for m in dict.fromkeys(_WORD.findall(text)) if m in MODELS and m != name]


def sql_for(target: str, stored: bool = False) -> str:
    """``target`` as one statement: its dependencies as a WITH chain in dependency order.

    ``stored``: the raw sources are there as tables and not part of the chain."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _deps(n):
            if d not in order and not (stored and d.startswith("raw_")):
                visit(d)
        if n not in order:
            order.append(n)

    visit(target)
    text = {n: MODELS[n].strip() for n in order}
    if target == "s03_named_source":  # the same model over the events of a window
        text["stg_events"] = f"SELECT * FROM ({text['stg_events']}) WHERE event_time::DATE BETWEEN {AS_OF} - 399 AND {AS_OF}"
    ctes = ",\n".join(f"{n} AS (\n{text[n]}\n)" for n in order[:-1])
    body = MODELS[target].strip()
    return f"WITH {ctes}\nSELECT * FROM (\n{body}\n)" if ctes else body
