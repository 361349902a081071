"""Equivalent ANSI SQL of the registered queries, for comparison on another engine.

The SQL is written from the rules, not from the DataFrame code: shared table
expressions first, then one statement per query.
"""

from __future__ import annotations

# ------------------------------------------------------- shared table expressions
RAW_USERS = """
u_raw AS (
  SELECT concat('u-', c_custkey) AS event_id,
    concat(CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR), 'T08:00:00+00:00') AS event_ts,
    CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 9000 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END
      AS party_id,
    split_part(c_name, '#', 1) AS given_name,
    split_part(c_name, '#', 2) AS family_name,
    concat(split_part(c_name, '#', 2), ' ', split_part(c_name, '#', 1)) AS full_name,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender_code,
    CASE WHEN c_acctbal < -900 THEN NULL WHEN c_acctbal BETWEEN 0 AND 200 THEN 'unknown'
      ELSE CAST(DATE '1940-01-01' + CAST(floor(abs(c_acctbal) * 2.5::DOUBLE) AS INTEGER) AS VARCHAR) END AS birth_date,
    CASE WHEN c_acctbal < -900 THEN NULL
      ELSE CAST(1940 + floor(abs(c_acctbal) * 2.5::DOUBLE / 365.25::DOUBLE) AS INTEGER) END AS birth_year,
    lower(c_mktsegment) AS occupation_title,
    CASE WHEN c_acctbal < -500 THEN NULL ELSE concat('  ', c_name, ' Street ') END AS address_line,
    CASE WHEN c_nationkey % 5 = 3 THEN NULL WHEN c_nationkey % 5 = 4 THEN '??'
      ELSE concat(' ', lower(n_name), ' ') END AS region_code,
    lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS home_postal_hint,
    CASE c_nationkey % 5 WHEN 0 THEN 'VN-HCM-01' WHEN 1 THEN 'VN-HN-01' WHEN 2 THEN 'VN-DN-01'
      WHEN 3 THEN 'XX-NOWHERE-01' END AS location_id_home,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(floor(c_acctbal / 50) AS INTEGER) END AS age,
    CASE c_custkey % 3 WHEN 0 THEN ' 25-34 ' WHEN 1 THEN '65+' END AS age_group,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN ' low' WHEN c_acctbal < 6000 THEN 'Medium '
      WHEN c_acctbal < 9000 THEN 'HIGH' ELSE '' END AS income_level,
    CASE WHEN c_acctbal < 500 THEN NULL ELSE c_nationkey * 5.0::DOUBLE - 60.0::DOUBLE END AS home_latitude,
    CASE WHEN c_acctbal < 500 THEN NULL ELSE c_nationkey * 14.0::DOUBLE - 170.0::DOUBLE END AS home_longitude
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

RAW_CARDS = """
c_raw AS (
  SELECT concat('c-', c_custkey) AS event_id,
    concat(CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR), 'T09:00:00+00:00') AS event_ts,
    CAST(c_custkey AS VARCHAR) AS party_id_fk,
    CASE WHEN c_acctbal < -500 THEN NULL WHEN c_acctbal < 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS card_ref,
    right(lpad(CAST(c_custkey AS VARCHAR), 16, '4'), 4) AS card_pan_last4,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'CREDIT ' WHEN 'BUILDING' THEN ' debit' WHEN 'HOUSEHOLD' THEN ''
      WHEN 'MACHINERY' THEN 'CREDIT' END AS product_type,
    CASE c_nationkey % 4 WHEN 0 THEN 'visa' WHEN 1 THEN 'MC' WHEN 2 THEN '???' END AS brand,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(floor(c_acctbal / 5) AS INTEGER) END AS days_since_issuance,
    CASE c_custkey % 4 WHEN 0 THEN 'new' WHEN 1 THEN ' Recent' WHEN 2 THEN 'ESTABLISHED' END AS card_age_category,
    CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE CAST(c_custkey % 3 AS INTEGER) END AS is_primary_card,
    CASE WHEN c_acctbal > 9900 THEN 999999999 WHEN c_custkey % 17 = 0 THEN NULL
      ELSE CAST(floor(c_acctbal * 10) AS INTEGER) END AS daily_limit_minor
  FROM customer)"""

RAW_MERCHANTS = """
m_raw AS (
  SELECT concat('m-', s_suppkey) AS event_id,
    concat(CAST(DATE '2023-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS VARCHAR), 'T07:00:00+00:00') AS event_ts,
    CASE WHEN s_acctbal < 0 THEN '' ELSE CAST(s_suppkey AS VARCHAR) END AS merchant_id,
    CASE WHEN s_nationkey % 6 = 0 THEN NULL WHEN s_nationkey % 6 = 1 THEN lower(s_name)
      ELSE concat(' ', s_name) END AS merchant_display_name,
    CASE s_suppkey % 8 WHEN 0 THEN 'ELEC' WHEN 1 THEN 'food' WHEN 2 THEN ' TRVL' WHEN 3 THEN 'FASH'
      WHEN 4 THEN 'GROC ' WHEN 5 THEN 'serv' WHEN 6 THEN '' END AS mcc_group,
    CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_nationkey * 8.0::DOUBLE - 95.0::DOUBLE END AS geo_lat,
    CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_nationkey * 15.5::DOUBLE - 185.0::DOUBLE END AS geo_lon,
    CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_acctbal / 8000 END AS risk_score_merchant,
    CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE CAST(floor(s_acctbal * 10) AS INTEGER) END AS avg_txn_amount_minor,
    CASE s_suppkey % 4 WHEN 0 THEN 'retail' WHEN 1 THEN ' Online' WHEN 2 THEN 'BOTH' END AS merchant_type,
    CASE WHEN s_suppkey % 5 = 4 THEN NULL ELSE CAST(s_suppkey % 3 AS INTEGER) END AS is_high_risk
  FROM supplier)"""

RAW_EVENTS = """
e_k AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
t_raw AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_ts,
    CAST(floor(epoch(ts)) AS INTEGER) AS event_epoch_sec,
    CAST(user_id AS VARCHAR) AS card_ref,
    CAST(k AS VARCHAR) AS merchant_ref,
    CASE WHEN event_type = 'error' THEN -CAST(floor(value * 100 + 0.5::DOUBLE) AS INTEGER)
      WHEN event_type = 'signup' AND value > 100 THEN NULL
      ELSE CAST(floor(value * 100 + 0.5::DOUBLE) AS INTEGER) END AS amount_minor,
    CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'purchase' THEN value * 10 ELSE value END
      AS amount_major,
    concat('AUTH-', event_id) AS auth_code,
    CASE event_type WHEN 'error' THEN -1 WHEN 'view' THEN 0 WHEN 'signup' THEN NULL ELSE 1 END AS amount_sign,
    CASE event_type WHEN 'view' THEN ' vnd' WHEN 'click' THEN 'usd' WHEN 'error' THEN ' ' WHEN 'signup' THEN 'VND' END
      AS currency,
    CASE event_type WHEN 'purchase' THEN ' pos ' WHEN 'view' THEN 'ecom' WHEN 'click' THEN 'Mobile'
      WHEN 'signup' THEN '' END AS channel_code,
    CASE k % 5 WHEN 0 THEN 'chip' WHEN 1 THEN 'MAGSTRIPE ' WHEN 2 THEN 'Contactless' WHEN 3 THEN 'MANUAL' END
      AS entry_mode,
    CASE WHEN k = 50 THEN NULL ELSE value / 300 - 0.1::DOUBLE END AS risk_score_online,
    CASE WHEN event_type <> 'error' THEN CAST(hour(ts) AS INTEGER) WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN -1
      ELSE 27 END AS hour_of_day,
    CASE WHEN k % 4 = 0 THEN NULL ELSE value - 50 END AS distance_from_home_km,
    CASE WHEN k % 10 = 9 THEN NULL ELSE k % 3 END AS exceeds_daily_limit,
    CASE WHEN k % 6 = 0 THEN NULL ELSE (50 - value) / 100 END AS amount_deviation_ratio,
    CASE WHEN k = 7 THEN NULL ELSE k - 20 END AS days_since_card_issued,
    ts
  FROM e_k)"""

RAW_LINES = """
l_ts AS (
  SELECT *, l_shipdate + to_hours(CAST(floor(l_quantity) AS INTEGER) % 24) + to_minutes(l_linenumber) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
t_raw AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_ts,
    CAST(floor(epoch(ts)) AS INTEGER) AS event_epoch_sec,
    CAST(o_custkey AS VARCHAR) AS card_ref,
    CAST(l_suppkey AS VARCHAR) AS merchant_ref,
    CASE WHEN l_tax = 0 THEN -CAST(floor(l_extendedprice + 0.5::DOUBLE) AS INTEGER)
      ELSE CAST(floor(l_extendedprice + 0.5::DOUBLE) AS INTEGER) END AS amount_minor,
    CASE WHEN l_tax > 0.06::DOUBLE THEN NULL ELSE floor(l_extendedprice + 0.5::DOUBLE) / 100 END AS amount_major,
    concat('AUTH-', l_partkey) AS auth_code,
    CASE l_returnflag WHEN 'R' THEN -1 ELSE 1 END AS amount_sign,
    'vnd' AS currency,
    CASE l_returnflag WHEN 'R' THEN ' pos' WHEN 'A' THEN 'Ecom' END AS channel_code,
    CASE l_linestatus WHEN 'O' THEN 'chip ' END AS entry_mode,
    l_discount * 12 - 0.1::DOUBLE AS risk_score_online,
    CASE WHEN l_discount = 0 THEN NULL WHEN l_discount > 0.09::DOUBLE THEN 27 ELSE CAST(hour(ts) AS INTEGER) END
      AS hour_of_day,
    CAST(NULL AS DOUBLE) AS distance_from_home_km,
    CAST(NULL AS INTEGER) AS exceeds_daily_limit,
    CAST(NULL AS DOUBLE) AS amount_deviation_ratio,
    CAST(NULL AS INTEGER) AS days_since_card_issued,
    ts
  FROM l_ts)"""

USERS = """
u AS (
  SELECT * REPLACE (
    upper(trim(coalesce(region_code, 'UNK'))) AS region_code,
    trim(coalesce(address_line, '')) AS address_line,
    upper(trim(coalesce(income_level, 'MEDIUM'))) AS income_level,
    CASE WHEN age < 0 THEN 0 WHEN age > 110 THEN 110 ELSE coalesce(age, 0) END AS age,
    upper(trim(coalesce(age_group, 'UNKNOWN'))) AS age_group,
    coalesce(home_latitude, 0.0) AS home_latitude,
    coalesce(home_longitude, 0.0) AS home_longitude)
  FROM u_raw),
city AS (
  SELECT * FROM (VALUES
    ('VN-HCM-01', 'Ho Chi Minh City', 'HCM', '700000', 10.7769::DOUBLE, 106.7009::DOUBLE, 9000000),
    ('VN-HN-01', 'Ha Noi', 'HN', '100000', 21.0278::DOUBLE, 105.8342::DOUBLE, 8000000),
    ('VN-DN-01', 'Da Nang', 'DN', '550000', 16.0544::DOUBLE, 108.2022::DOUBLE, 1200000))
  AS v(location_id, city, region_code, postal_code, lat, "long", population)),
us AS (
  SELECT party_id, given_name AS "first", family_name AS "last", gender_code AS gender, address_line AS street,
    u.region_code AS state, home_postal_hint AS zip, occupation_title AS job, birth_date AS dob, age, age_group,
    income_level, home_latitude, home_longitude, coalesce(city.city, 'Unknown') AS city,
    coalesce(city.lat, 0.0) AS lat, coalesce(city."long", 0.0) AS "long",
    coalesce(city.population, 0) AS city_pop, event_ts, event_id
  FROM u LEFT JOIN city ON u.location_id_home = city.location_id
  WHERE party_id IS NOT NULL AND party_id <> '')"""

CARDS = """
c AS (
  SELECT * REPLACE (
    upper(trim(coalesce(product_type, 'UNKNOWN'))) AS product_type,
    upper(trim(coalesce(brand, 'UNKNOWN'))) AS brand,
    CASE WHEN days_since_issuance < 0 THEN 0 ELSE coalesce(days_since_issuance, 0) END AS days_since_issuance,
    upper(trim(coalesce(card_age_category, 'UNKNOWN'))) AS card_age_category,
    CASE WHEN is_primary_card = 1 THEN 1 ELSE 0 END AS is_primary_card,
    CASE WHEN daily_limit_minor < 0 THEN 0
      ELSE CAST(least(coalesce(daily_limit_minor, 0), 100000000) AS INTEGER) END AS daily_limit_minor)
  FROM c_raw),
cs AS (
  SELECT card_ref, party_id_fk AS party_id, card_pan_last4 AS cc_last4, product_type, brand, days_since_issuance,
    card_age_category, is_primary_card, daily_limit_minor, event_ts, event_id
  FROM c WHERE card_ref IS NOT NULL AND card_ref <> '')"""

MERCHANTS = """
m AS (
  SELECT * REPLACE (
    upper(trim(coalesce(mcc_group, 'UNK'))) AS mcc_group,
    trim(coalesce(merchant_display_name, 'Merchant')) AS merchant_display_name,
    least(greatest(coalesce(geo_lat, 0.0), -90.0), 90.0) AS geo_lat,
    least(greatest(coalesce(geo_lon, 0.0), -180.0), 180.0) AS geo_lon,
    least(greatest(coalesce(risk_score_merchant, 0.0), 0.0), 1.0) AS risk_score_merchant,
    upper(trim(coalesce(merchant_type, 'UNKNOWN'))) AS merchant_type,
    CASE WHEN is_high_risk = 1 THEN 1 ELSE 0 END AS is_high_risk,
    coalesce(avg_txn_amount_minor, 0) AS avg_txn_amount_minor)
  FROM m_raw),
ms AS (
  SELECT merchant_id, merchant_display_name AS merchant, mcc_group AS category, geo_lat AS merch_lat,
    geo_lon AS merch_long, risk_score_merchant, avg_txn_amount_minor, merchant_type, is_high_risk, event_ts, event_id
  FROM m WHERE merchant_id IS NOT NULL AND merchant_id <> '')"""

TXNS = """
t_rules AS (
  SELECT * REPLACE (
    greatest(coalesce(amount_minor, 0), 0) AS amount_minor,
    coalesce(amount_major, greatest(coalesce(amount_minor, 0), 0) / 100.0::DOUBLE) AS amount_major,
    CASE WHEN amount_sign = -1 THEN -1 ELSE 1 END AS amount_sign,
    upper(trim(coalesce(currency, 'VND'))) AS currency,
    upper(trim(coalesce(channel_code, 'POS'))) AS channel_code,
    upper(trim(coalesce(entry_mode, 'CHIP'))) AS entry_mode,
    least(greatest(coalesce(risk_score_online, 0.0), 0.0), 1.0) AS risk_score_online,
    CASE WHEN hour_of_day BETWEEN 0 AND 23 THEN hour_of_day ELSE 0 END AS hour_of_day,
    abs(coalesce(distance_from_home_km, 0.0)) AS distance_from_home_km,
    CASE WHEN exceeds_daily_limit = 1 THEN 1 ELSE 0 END AS exceeds_daily_limit,
    abs(coalesce(amount_deviation_ratio, 0.0)) AS amount_deviation_ratio,
    CASE WHEN days_since_card_issued < 0 THEN 0 ELSE coalesce(days_since_card_issued, 0) END
      AS days_since_card_issued)
  FROM t_raw),
t AS (
  SELECT *,
    CASE WHEN hour_of_day BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_unusual_hour,
    CASE WHEN amount_major < 50 THEN 'SMALL' WHEN amount_major < 200 THEN 'MEDIUM'
      WHEN amount_major < 1000 THEN 'LARGE' ELSE 'XLARGE' END AS amount_category,
    TIMESTAMP '1970-01-01' + to_seconds(event_epoch_sec) AS trans_date_trans_time
  FROM t_rules)"""

ENRICHED = """
j AS (
  SELECT t.*, cs.party_id, cs.cc_last4, cs.product_type, cs.brand, cs.days_since_issuance, cs.card_age_category,
    cs.is_primary_card, cs.daily_limit_minor,
    us."first", us."last", us.gender, us.state, us.city, us.job, us.dob, us.age, us.income_level,
    us.home_latitude, us.home_longitude,
    ms.merchant, ms.category, ms.merch_lat, ms.merch_long, ms.risk_score_merchant, ms.is_high_risk,
    cs.card_ref IS NOT NULL AS card_found, us.party_id IS NOT NULL AS user_found,
    ms.merchant_id IS NOT NULL AS merchant_found
  FROM t LEFT JOIN cs ON t.card_ref = cs.card_ref
    LEFT JOIN us ON cs.party_id = us.party_id
    LEFT JOIN ms ON t.merchant_ref = ms.merchant_id)"""

RISK = """
r0 AS (
  SELECT * REPLACE (
    CASE WHEN home_latitude IS NULL OR home_longitude IS NULL OR merch_lat IS NULL OR merch_long IS NULL THEN 0.0
      ELSE floor(2 * 6371 * asin(sqrt(least(1.0,
        pow(sin(radians(merch_lat - home_latitude) / 2), 2) + cos(radians(home_latitude)) * cos(radians(merch_lat))
        * pow(sin(radians(merch_long - home_longitude) / 2), 2)))) * 100 + 0.5) / 100 END AS distance_from_home_km,
    CASE WHEN amount_minor > coalesce(daily_limit_minor, 5000000) THEN 1 ELSE 0 END AS exceeds_daily_limit,
    floor(abs(amount_minor - coalesce(daily_limit_minor, 1000000))
      / CAST(greatest(coalesce(daily_limit_minor, 1000000), 1) AS DOUBLE) * 1000 + 0.5) / 1000
      AS amount_deviation_ratio,
    coalesce(days_since_issuance, 0) AS days_since_card_issued)
  FROM j),
r AS (
  SELECT *, least(5 + CASE WHEN is_unusual_hour = 1 THEN 50 ELSE 0 END
    + CASE WHEN exceeds_daily_limit = 1 THEN 80 ELSE 0 END
    + CASE WHEN distance_from_home_km > 50 THEN 50 ELSE 0 END
    + CASE WHEN amount_category IN ('LARGE', 'XLARGE') THEN 30 ELSE 0 END, 990) / 1000.0::DOUBLE
    AS txn_fraud_probability
  FROM r0)"""

AGE = "CAST(floor(date_diff('day', TRY_CAST(dob AS DATE), CAST(trans_date_trans_time AS DATE)) / 365) AS INTEGER)"
HOUR = "CAST(hour(trans_date_trans_time) AS INTEGER)"
WEEKDAY = "CAST(isodow(trans_date_trans_time) - 1 AS INTEGER)"
MONTH = "CAST(month(trans_date_trans_time) AS INTEGER)"

BY_RULES = """
s AS (
  SELECT *, CASE WHEN card_found THEN txn_fraud_probability END AS fraud_probability,
    CASE WHEN card_found AND txn_fraud_probability >= 0.1 THEN 1 ELSE 0 END AS predicted_fraud
  FROM r)"""

BY_FORMULAS = f"""
f AS (
  SELECT * REPLACE ({AGE} AS age), {HOUR} AS hour, {WEEKDAY} AS day_of_week, {MONTH} AS month,
    coalesce(amount_major, 0.0) AS amt
  FROM r),
p AS (
  SELECT *, (
    1 / (1 + exp(-(-2.1 + amt * 0.004 + is_unusual_hour * 0.8 + exceeds_daily_limit * 0.9)))
    + 1 / (1 + exp(-(-1.9 + distance_from_home_km * 0.0004 + coalesce(risk_score_merchant, 0) * 1.7
      + coalesce(is_high_risk, 0) * 0.6)))
    + 1 / (1 + exp(-(-0.6 + risk_score_online * 2.3 + coalesce(age, 0) * -0.011 + hour * 0.013
      + day_of_week * 0.07 + month * -0.03)))) / 3 AS p
  FROM f),
s AS (
  SELECT *, CASE WHEN card_found THEN p END AS fraud_probability,
    CASE WHEN card_found AND p >= 0.5 THEN 1 ELSE 0 END AS predicted_fraud
  FROM p)"""


def _points(width: str) -> str:
    """The four series, one point per interval of event time."""
    return f"""
w AS (
  SELECT time_bucket(INTERVAL '{width}', ts) AS ts, count(*) AS n, CAST(sum(predicted_fraud) AS BIGINT) AS fraud,
    CAST(sum(amount_minor) AS BIGINT) AS amount
  FROM s GROUP BY 1),
points AS (
  SELECT 'ts:txn:count' AS series, ts, n AS value FROM w
  UNION ALL SELECT 'ts:txn:fraud', ts, fraud FROM w
  UNION ALL SELECT 'ts:txn:pred', ts, fraud FROM w
  UNION ALL SELECT 'ts:txn:amount_minor', ts, amount FROM w)"""


ENTITIES = [RAW_USERS, RAW_CARDS, RAW_MERCHANTS, USERS, CARDS, MERCHANTS]
EVENT_TXNS = [RAW_EVENTS, TXNS]
LINE_TXNS = [RAW_LINES, TXNS]
EVENT_JOINED = [*EVENT_TXNS, *ENTITIES, ENRICHED]
LINE_JOINED = [*LINE_TXNS, *ENTITIES, ENRICHED]
EVENT_FORMULAS = [*EVENT_JOINED, RISK, BY_FORMULAS]
LINE_RULES = [*LINE_JOINED, RISK, BY_RULES]


def _with(parts: list[str], statement: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + statement.strip()


ENRICHED_SELECT = """
SELECT event_id, card_ref, merchant_ref, party_id, cc_last4, product_type, brand, daily_limit_minor,
  "first", "last", state, city, income_level, age, merchant, category, risk_score_merchant,
  card_found, user_found, merchant_found
FROM j"""

SCORED_SELECT = """
SELECT event_id, floor(fraud_probability * 1000000 + 0.5) / 1000000 AS fraud_probability, predicted_fraud FROM s"""

HISTOGRAM = """
SELECT CAST(b.bucket AS INTEGER) AS bucket, count(s.event_id) AS n
FROM range(10) AS b(bucket)
LEFT JOIN s ON b.bucket = CAST(least(9, greatest(0, floor(s.fraud_probability * 10))) AS BIGINT)
GROUP BY 1"""

ALERTS = """
SELECT event_id AS txn_id, CAST(amount_minor AS BIGINT) AS amount_minor, coalesce(category, 'UNK') AS category,
  channel_code AS channel, event_ts AS ts
FROM s WHERE predicted_fraud = 1"""


def _rule_rows(source: str, topic: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{topic}' AS topic, '{rule}' AS rule, count(*) FILTER (WHERE {test}) AS hits, count(*) AS total "
        f"FROM {source}"
        for rule, test in rules.items()
    )


DQ_PROFILE = "\nUNION ALL\n".join([
    _rule_rows("u_raw", "user_profile", {
        "blank_income_level": "income_level IS NULL OR trim(income_level) = ''",
        "blank_region_code": "region_code IS NULL OR trim(region_code) = ''",
        "unknown_region_code": "trim(region_code) = '??'",
        "padded_address": "address_line <> trim(address_line)",
        "missing_home_latitude": "home_latitude IS NULL",
        "birth_year_mismatch": "year(TRY_CAST(birth_date AS DATE)) <> birth_year",
        "age_out_of_range": "age IS NULL OR age < 0 OR age > 110",
    }),
    _rule_rows("c_raw", "card_account", {
        "blank_product_type": "product_type IS NULL OR trim(product_type) = ''",
        "blank_brand": "brand IS NULL OR trim(brand) = ''",
        "unknown_brand": "trim(brand) = '???'",
        "negative_days_since_issuance": "days_since_issuance < 0",
        "negative_daily_limit": "daily_limit_minor < 0",
        "over_cap_daily_limit": "daily_limit_minor > 100000000",
    }),
    _rule_rows("m_raw", "merchant_profile", {
        "blank_mcc_group": "mcc_group IS NULL OR trim(mcc_group) = ''",
        "latitude_out_of_range": "geo_lat IS NULL OR geo_lat < -90 OR geo_lat > 90",
        "longitude_out_of_range": "geo_lon IS NULL OR geo_lon < -180 OR geo_lon > 180",
        "lower_case_name": "merchant_display_name = lower(merchant_display_name)",
        "risk_out_of_range": "risk_score_merchant IS NULL OR risk_score_merchant < 0 OR risk_score_merchant > 1",
    }),
    _rule_rows("t_raw", "card_txn_auth", {
        "blank_channel_code": "channel_code IS NULL OR trim(channel_code) = ''",
        "blank_currency": "currency IS NULL OR trim(currency) = ''",
        "bad_hour": "hour_of_day IS NULL OR hour_of_day < 0 OR hour_of_day > 23",
        "negative_amount": "amount_minor < 0",
        "missing_amount_major": "amount_major IS NULL",
        "negative_amount_major": "amount_major < 0",
        "risk_out_of_range": "risk_score_online IS NULL OR risk_score_online < 0 OR risk_score_online > 1",
    }),
])

VALID_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{topic}' AS topic, {test} AS is_valid, count(*) AS n FROM {source} GROUP BY 2"
    for topic, source, test in [
        ("user_profile", "u_raw", "party_id IS NOT NULL AND event_id IS NOT NULL AND event_ts IS NOT NULL"),
        ("card_account", "c_raw", "card_ref IS NOT NULL AND party_id_fk IS NOT NULL AND event_id IS NOT NULL"),
        ("merchant_profile", "m_raw", "merchant_id IS NOT NULL AND event_id IS NOT NULL"),
        ("card_txn_auth", "t_raw", "event_id IS NOT NULL AND card_ref IS NOT NULL AND merchant_ref IS NOT NULL "
                                   "AND amount_minor IS NOT NULL"),
    ]
)

MESSAGE_STATE = """
msg AS (
  SELECT *, event_type = 'error' AND value > 15 AND value <= 30 OR event_type = 'error' AND value > 5 AND value <= 15
      AS absent,
    event_type = 'error' AND value > 30 AS broken
  FROM events),
decoded AS (
  SELECT event_id AS message_id, absent AS no_record,
    CASE WHEN NOT absent AND NOT broken THEN CAST(event_id AS VARCHAR) END AS event_id,
    CASE WHEN NOT absent AND NOT broken THEN CAST(user_id AS VARCHAR) END AS card_ref,
    CASE WHEN NOT absent AND NOT broken AND event_type <> 'view' THEN CAST(floor(value * 100 + 0.5) AS INTEGER) END
      AS amount_minor,
    CASE WHEN NOT absent AND NOT broken AND event_type <> 'click' THEN 2.5::DOUBLE END AS amount_major,
    CASE WHEN NOT absent AND NOT broken AND event_type <> 'signup' THEN 7 END AS hour_of_day
  FROM msg)"""

TXN_COLUMNS = """event_id, event_ts, event_epoch_sec, card_ref, merchant_ref, amount_minor, amount_major, auth_code,
  amount_sign, currency, channel_code, entry_mode, risk_score_online, hour_of_day, is_unusual_hour,
  distance_from_home_km, amount_category, exceeds_daily_limit, amount_deviation_ratio, days_since_card_issued,
  trans_date_trans_time"""

AS_OF = _with([*LINE_TXNS, """
versions AS (
  SELECT CAST(o_custkey AS VARCHAR) AS card_ref, o_orderdate AS valid_from,
    concat('o-', lpad(CAST(max(o_orderkey) AS VARCHAR), 12, '0')) AS card_event_id,
    arg_max(CAST(floor(o_totalprice / 4) AS INTEGER), o_orderkey) AS daily_limit_minor
  FROM orders GROUP BY o_custkey, o_orderdate)"""], """
        SELECT t.event_id, t.card_ref, t.ts, t.amount_minor, v.valid_from, v.card_event_id, v.daily_limit_minor
        FROM t ASOF LEFT JOIN versions v ON t.card_ref = v.card_ref AND t.ts >= v.valid_from""")

CATEGORY_DAYS = _with(LINE_RULES, """
        SELECT strftime(ts, '%Y%m%d') AS day, coalesce(category, 'UNK') AS category, count(*) AS n
        FROM s WHERE predicted_fraud = 1 GROUP BY 1, 2""")

BATCH_POINTS = [*LINE_RULES, _points("1 day").replace("points AS", "day_points AS"), """
points AS (
  SELECT series, TIMESTAMP '2020-01-01' + to_seconds(date_diff('day', DATE '1992-01-01', CAST(ts AS DATE))) AS ts, value
  FROM day_points)"""]
VIEW = """
view AS (
  SELECT series, ts, value FROM points WHERE ts >= (SELECT max(ts) FROM points) - INTERVAL 5 MINUTE)"""


def _panel(series: str, how: str) -> str:
    return _with([*BATCH_POINTS, VIEW], f"""
        SELECT time_bucket(INTERVAL '5 seconds', ts) AS bucket_start, CAST({how}(value) AS BIGINT) AS value
        FROM view WHERE series = '{series}' GROUP BY 1""")


# ------------------------------------------------------------------ one per query
ORACLE_SQL: dict[str, str] = {
    "json_decode": _with([MESSAGE_STATE], "SELECT * FROM decoded"),
    "json_projection": _with([MESSAGE_STATE], """
        SELECT count(*) AS "rows", count(event_id) AS with_event_id, CAST(sum(amount_minor) AS BIGINT) AS amount_minor,
          0 AS extra_fields FROM decoded"""),
    "city_dimension": _with([RAW_USERS, USERS], """
        SELECT city.*, count(u_raw.event_id) AS users FROM city
        LEFT JOIN u_raw ON u_raw.location_id_home = city.location_id GROUP BY ALL"""),
    "keyed_messages": _with([RAW_EVENTS], """
        SELECT card_ref AS key, count(*) AS messages, CAST(sum(amount_minor) AS BIGINT) AS amount_minor,
          CAST(0 AS BIGINT) AS key_mismatches FROM t_raw GROUP BY 1"""),
    "clean_user": _with([RAW_USERS, USERS], "SELECT * FROM u"),
    "clean_merchant": _with([RAW_MERCHANTS, MERCHANTS], "SELECT * FROM m"),
    "clean_card": _with([RAW_CARDS, CARDS], "SELECT * FROM c"),
    "clean_txn": _with(EVENT_TXNS, f"SELECT {TXN_COLUMNS} FROM t"),
    "clean_txn_hour_from_event_time": _with(EVENT_TXNS, f"""
        SELECT event_id, {HOUR} AS hour_of_day, CASE WHEN {HOUR} BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_unusual_hour
        FROM t"""),
    "typed_clean": _with([RAW_USERS], """
        SELECT event_id, coalesce(TRY_CAST(nullif(home_postal_hint, '') AS INTEGER), -1) AS postal_number,
          coalesce(TRY_CAST(nullif(birth_date, '') AS INTEGER), -1) AS birth_date_number,
          coalesce(home_latitude, 0.0) AS latitude,
          coalesce(trim(nullif(income_level, '')), 'LOW') AS income_level,
          coalesce(trim(nullif(address_line, '')), 'none') AS address_line
        FROM u_raw"""),
    "dq_profile": _with([RAW_USERS, RAW_CARDS, RAW_MERCHANTS, RAW_EVENTS], DQ_PROFILE),
    "validate_required": _with([RAW_USERS, RAW_CARDS, RAW_MERCHANTS, RAW_EVENTS], VALID_COUNTS),
    "rejected_txns": _with([RAW_EVENTS], """
        SELECT event_id, card_ref, merchant_ref, amount_minor FROM t_raw
        WHERE event_id IS NULL OR card_ref IS NULL OR merchant_ref IS NULL OR amount_minor IS NULL"""),
    "usable_keys": _with([RAW_CARDS], """
        SELECT card_ref, party_id_fk FROM c_raw WHERE card_ref IS NOT NULL AND card_ref <> ''"""),
    "txn_predicates": _with([RAW_EVENTS], """
        SELECT entry_mode, count(*) FILTER (WHERE hour_of_day BETWEEN 0 AND 23) AS valid_hours,
          count(*) FILTER (WHERE hour_of_day IN (0, 1, 2, 3, 4, 5)) AS unusual_hours,
          count(*) FILTER (WHERE amount_sign = -1) AS reversals,
          count(*) FILTER (WHERE amount_minor < 0) AS negative_amounts,
          count(*) FILTER (WHERE exceeds_daily_limit = 1) AS over_limit
        FROM t_raw GROUP BY 1"""),
    "serve_user": _with([RAW_USERS, USERS], "SELECT * FROM us"),
    "city_enrich": _with([RAW_USERS, USERS], """
        SELECT event_id, location_id_home, coalesce(city.city, 'Unknown') AS city, coalesce(city.lat, 0.0) AS lat,
          coalesce(city."long", 0.0) AS "long", coalesce(population, 0) AS city_pop,
          CASE WHEN home_latitude = 0 AND home_longitude = 0 THEN coalesce(city.lat, 0.0) ELSE home_latitude END
            AS home_latitude,
          CASE WHEN home_latitude = 0 AND home_longitude = 0 THEN coalesce(city."long", 0.0) ELSE home_longitude END
            AS home_longitude
        FROM u LEFT JOIN city ON location_id_home = location_id"""),
    "serve_merchant": _with([RAW_MERCHANTS, MERCHANTS], "SELECT * FROM ms"),
    "serve_card": _with([RAW_CARDS, CARDS], "SELECT * FROM cs"),
    "time_features": _with(EVENT_TXNS, f"""
        SELECT event_id, {HOUR} AS hour, {WEEKDAY} AS day_of_week, {MONTH} AS month FROM t"""),
    "iso_hour": _with([RAW_EVENTS], """
        SELECT event_id, CASE WHEN merchant_ref = '13' THEN 0 ELSE CAST(hour(ts) AS INTEGER) END AS hour,
          CASE WHEN merchant_ref = '13' OR hour(ts) <= 5 THEN 1 ELSE 0 END AS is_unusual_hour FROM t_raw"""),
    "age_at_txn": _with(EVENT_JOINED, f"SELECT event_id, dob, {AGE} AS age FROM j"),
    "age_group": _with([RAW_USERS], """
        SELECT event_id, least(100, greatest(0, 2024 - birth_year)) AS age,
          CASE WHEN 2024 - birth_year < 25 THEN '18-24' WHEN 2024 - birth_year < 35 THEN '25-34'
            WHEN 2024 - birth_year < 45 THEN '35-44' WHEN 2024 - birth_year < 55 THEN '45-54'
            WHEN 2024 - birth_year < 65 THEN '55-64' ELSE '65+' END AS age_group
        FROM (SELECT * FROM u_raw WHERE birth_year IS NOT NULL)
        UNION ALL SELECT event_id, NULL, '65+' FROM u_raw WHERE birth_year IS NULL"""),
    "card_age_category": _with([RAW_CARDS, CARDS], """
        SELECT event_id, days_since_issuance,
          CASE WHEN days_since_issuance < 30 THEN 'NEW' WHEN days_since_issuance < 180 THEN 'RECENT'
            WHEN days_since_issuance < 365 THEN 'MODERATE' ELSE 'ESTABLISHED' END AS category
        FROM c"""),
    "haversine_km": _with([RAW_MERCHANTS], """
        SELECT event_id, CASE WHEN geo_lat IS NULL OR geo_lon IS NULL THEN 0.0 ELSE
          floor(2 * 6371 * asin(sqrt(pow(sin(radians(10.7769 - geo_lat) / 2), 2)
          + cos(radians(geo_lat)) * cos(radians(10.7769)) * pow(sin(radians(106.7009 - geo_lon) / 2), 2)))
          * 100 + 0.5) / 100 END AS distance_km
        FROM m_raw"""),
    "amount_category": _with(EVENT_TXNS, """
        SELECT event_id, amount_minor / 100.0::DOUBLE AS major,
          CASE WHEN amount_minor < 5000 THEN 'SMALL' WHEN amount_minor < 20000 THEN 'MEDIUM'
            WHEN amount_minor < 100000 THEN 'LARGE' ELSE 'XLARGE' END AS category
        FROM t"""),
    "limit_and_deviation": _with([*LINE_JOINED, RISK], """
        SELECT channel_code, CAST(sum(exceeds_daily_limit) AS BIGINT) AS over_limit,
          max(amount_deviation_ratio) AS max_deviation, min(amount_deviation_ratio) AS min_deviation,
          CAST(sum(CAST(floor(amount_deviation_ratio * 1000 + 0.5) AS BIGINT)) AS BIGINT) AS deviation_thousandths,
          max(days_since_card_issued) AS oldest_card_days
        FROM r GROUP BY 1"""),
    "rule_score": _with([*EVENT_JOINED, RISK], """
        SELECT event_id, distance_from_home_km, exceeds_daily_limit, amount_deviation_ratio, days_since_card_issued,
          txn_fraud_probability FROM r"""),
    "merchant_risk": _with([RAW_MERCHANTS, MERCHANTS], """
        SELECT event_id, mcc_group, risk AS merchant_risk, CASE WHEN risk > 0.15 THEN 1 ELSE 0 END AS is_high_risk
        FROM (SELECT event_id, mcc_group, CAST(CASE mcc_group WHEN 'ELEC' THEN 0.15 WHEN 'FOOD' THEN 0.05
          WHEN 'TRVL' THEN 0.20 WHEN 'FASH' THEN 0.12 WHEN 'GROC' THEN 0.03 WHEN 'SERV' THEN 0.18 ELSE 0.10 END
          AS DOUBLE) AS risk FROM m)"""),
    "pan_token": """
        SELECT c_custkey, concat('h_', sha256(lpad(CAST(c_custkey AS VARCHAR), 16, '4'))) AS pan_hash,
          right(lpad(CAST(c_custkey AS VARCHAR), 16, '4'), 4) AS last4 FROM customer""",
    "name_and_birth": _with([RAW_USERS], """
        SELECT event_id, concat(family_name, ' ', given_name) AS full_name,
          CAST(year(TRY_CAST(birth_date AS DATE)) AS INTEGER) AS birth_year FROM u_raw"""),
    "latest_by_key_cards": """
        SELECT concat('o-', lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS event_id,
          strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS event_ts, CAST(o_custkey AS VARCHAR) AS party_id_fk,
          CAST(o_custkey AS VARCHAR) AS card_ref,
          right(lpad(CAST(o_orderkey AS VARCHAR), 16, '4'), 4) AS card_pan_last4,
          CASE o_orderstatus WHEN 'P' THEN 'CREDIT ' WHEN 'F' THEN ' debit' END AS product_type,
          CASE WHEN instr(o_orderpriority, '-') = 0 THEN o_orderpriority
            ELSE substr(o_orderpriority, instr(o_orderpriority, '-') + 1) END AS brand,
          CAST(o_orderkey % 1200 AS INTEGER) AS days_since_issuance, CAST(NULL AS VARCHAR) AS card_age_category,
          CAST(o_orderkey % 2 AS INTEGER) AS is_primary_card,
          CAST(floor(o_totalprice / 4) AS INTEGER) AS daily_limit_minor
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders) WHERE rn = 1""",
    "enrich_txn": _with(EVENT_JOINED, ENRICHED_SELECT),
    "enrich_txn_shuffled": _with(EVENT_JOINED, ENRICHED_SELECT),
    "merge_last_wins": _with(EVENT_JOINED, """
        SELECT event_id, currency, CASE WHEN merchant_found THEN 'merchant' WHEN card_found THEN 'card' END AS tier,
          cc_last4 AS brand FROM j"""),
    "asof_enrich": AS_OF,
    "asof_enrich_split": AS_OF,
    "semi_gate": _with([*EVENT_TXNS, RAW_CARDS, CARDS], """
        SELECT event_id, card_ref, amount_minor FROM t WHERE card_ref IN (SELECT card_ref FROM cs)"""),
    "orphan_audit": _with(EVENT_JOINED, """
        SELECT lookup, misses, total, floor(misses / total * 1000000 + 0.5) / 1000000 AS miss_rate FROM (
          SELECT 'card' AS lookup, count(*) FILTER (WHERE NOT card_found) AS misses, count(*) AS total FROM j
          UNION ALL SELECT 'user', count(*) FILTER (WHERE NOT user_found), count(*) FROM j
          UNION ALL SELECT 'merchant', count(*) FILTER (WHERE NOT merchant_found), count(*) FROM j)"""),
    "orphan_cards": _with([*EVENT_TXNS, RAW_CARDS, CARDS], """
        SELECT event_id, card_ref FROM t WHERE NOT EXISTS (SELECT 1 FROM cs WHERE cs.card_ref = t.card_ref)"""),
    "align_features": _with(EVENT_JOINED, f"""
        SELECT event_id, amount_major AS amt, {HOUR} AS hour, {WEEKDAY} AS day_of_week, {MONTH} AS month, {AGE} AS age,
          is_unusual_hour, risk_score_online, risk_score_merchant, daily_limit_minor, category, gender,
          CAST(NULL AS DOUBLE) AS not_in_any_table FROM j"""),
    "align_features_numeric": _with(EVENT_JOINED, f"""
        SELECT event_id, amount_major AS amt, CAST({HOUR} AS DOUBLE) AS hour, CAST({WEEKDAY} AS DOUBLE) AS day_of_week,
          CAST({MONTH} AS DOUBLE) AS month, CAST({AGE} AS DOUBLE) AS age, CAST(is_unusual_hour AS DOUBLE)
          AS is_unusual_hour, risk_score_online, risk_score_merchant,
          CAST(daily_limit_minor AS DOUBLE) AS daily_limit_minor, TRY_CAST(category AS DOUBLE) AS category,
          TRY_CAST(gender AS DOUBLE) AS gender, CAST(NULL AS DOUBLE) AS not_in_any_table FROM j"""),
    "drop_non_features": _with([RAW_USERS, USERS], """
        SELECT party_id, gender, job, age, age_group, income_level, home_latitude, home_longitude, lat, "long",
          city_pop FROM us"""),
    "numeric_coercion": _with([RAW_USERS], """
        SELECT event_id, TRY_CAST(party_id AS DOUBLE) AS party_id,
          TRY_CAST(home_postal_hint AS DOUBLE) AS home_postal_hint, TRY_CAST(birth_date AS DOUBLE) AS birth_date,
          TRY_CAST(income_level AS DOUBLE) AS income_level, home_latitude FROM u_raw"""),
    "ensemble_score": _with(EVENT_FORMULAS, SCORED_SELECT),
    "threshold_flag": _with([*EVENT_JOINED, RISK, BY_RULES], """
        SELECT event_id, fraud_probability, predicted_fraud FROM s"""),
    "flagged_txns": _with(EVENT_FORMULAS, """
        SELECT event_id, card_ref, amount_minor FROM s WHERE predicted_fraud = 1"""),
    "opaque_ensemble_score": _with([*EVENT_TXNS, """
s AS (
  SELECT event_id, p AS fraud_probability, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS predicted_fraud FROM (
    SELECT event_id, (1 / (1 + exp(-(amount_major * 0.004 + is_unusual_hour * 0.8 - 2.0)))
      + 1 / (1 + exp(-(risk_score_online * 2.2 - 1.0)))
      + 1 / (1 + exp(-(amount_major * 0.001 + risk_score_online * 1.1 + is_unusual_hour * 0.4 - 1.2)))) / 3 AS p
    FROM t))"""], SCORED_SELECT),
    "fraud_by_category_day": CATEGORY_DAYS,
    "fraud_by_category_day_shuffled": CATEGORY_DAYS,
    "fraud_by_channel_day": _with(LINE_RULES, """
        SELECT strftime(ts, '%Y%m%d') AS day, channel_code AS channel, count(*) AS n
        FROM s WHERE predicted_fraud = 1 GROUP BY 1, 2"""),
    "batch_metrics": _with([*LINE_RULES, _points("1 day")], "SELECT series, ts, value FROM points"),
    "score_histogram": _with(EVENT_FORMULAS, HISTOGRAM),
    "score_bucket_series": _with(EVENT_FORMULAS, f"""
        SELECT concat('ts:score:bucket_', bucket, '_', bucket + 1) AS series, n AS value FROM ({HISTOGRAM})"""),
    "latest_amount": _with(EVENT_TXNS, """
        SELECT arg_max(amount_minor, ts) / 100.0::DOUBLE AS latest_transaction_amount FROM t"""),
    "alert_feed": _with(EVENT_FORMULAS, ALERTS),
    "recent_alerts": _with(EVENT_FORMULAS, f"{ALERTS} ORDER BY ts DESC, txn_id DESC LIMIT 1000"),
    "rollup_sum_5s_fraud": _with(EVENT_FORMULAS, """
        SELECT time_bucket(INTERVAL '5 seconds', ts) AS bucket_start, CAST(sum(predicted_fraud) AS BIGINT) AS value
        FROM s GROUP BY 1"""),
    "rollup_sum_5s_amount": _with(EVENT_TXNS, """
        SELECT time_bucket(INTERVAL '5 seconds', ts) AS bucket_start, CAST(sum(amount_minor) AS BIGINT) AS value,
          CAST(sum(amount_minor) AS BIGINT) / 100.0::DOUBLE AS value_major FROM t GROUP BY 1"""),
    "rollup_sum_5s_count": """
        SELECT time_bucket(INTERVAL '5 seconds', ts) AS bucket_start, count(*) AS value FROM events GROUP BY 1""",
    "rollup_sum_stored_series": _with(EVENT_TXNS, """
        SELECT time_bucket(INTERVAL '5 seconds', ts) AS bucket_start, CAST(sum(amount_minor) AS BIGINT) AS value
        FROM t GROUP BY 1"""),
    "rollup_max_5s": """
        SELECT time_bucket(INTERVAL '5 seconds', ts) AS bucket_start, max(n) AS value
        FROM (SELECT time_bucket(INTERVAL '1 second', ts) AS ts, count(*) AS n FROM events GROUP BY 1) GROUP BY 1""",
    "rollup_last": _with([*EVENT_FORMULAS, _points("1 second")], """
        SELECT series, ts AS bucket_start, value FROM points"""),
    "gauge_band": _with(LINE_RULES, """
        SELECT value, CASE WHEN value < 5 THEN 'green' WHEN value < 10 THEN 'yellow' ELSE 'red' END AS band,
          least(value, 50) AS display_value
        FROM (SELECT CAST(sum(predicted_fraud) AS BIGINT) AS value FROM s GROUP BY CAST(ts AS DATE)
          ORDER BY CAST(ts AS DATE) DESC LIMIT 1)"""),
    "trailing_5m": _with([*EVENT_FORMULAS, _points("1 second")], """
        SELECT series, ts, value FROM points WHERE ts >= (SELECT max(ts) FROM points) - INTERVAL 5 MINUTE"""),
    "trailing_day": _with(EVENT_TXNS, """
        SELECT event_id, ts, amount_minor FROM t WHERE ts >= (SELECT max(ts) FROM t) - INTERVAL 1 DAY"""),
    "retention_10m": _with([*EVENT_FORMULAS, _points("1 second")], """
        SELECT series, ts, value FROM points
        QUALIFY ts >= max(ts) OVER (PARTITION BY series) - INTERVAL 10 MINUTE"""),
    "series_reducers": _with([*LINE_RULES, _points("1 day")], """
        SELECT series, arg_max(value, ts) AS "last", arg_max(value, ts) AS last_not_null,
          floor(CAST(sum(value) AS BIGINT) / count(*) * 1000) / 1000 AS mean, max(value) AS max
        FROM points GROUP BY 1"""),
    "series_range": _with([*EVENT_FORMULAS, _points("1 second")], """
        SELECT ts, value FROM points WHERE series = 'ts:txn:amount_minor' ORDER BY ts"""),
    "rollup_last_hour": _with([*EVENT_FORMULAS, _points("1 second")], """
        SELECT series, time_bucket(INTERVAL '1 hour', ts) AS bucket_start, arg_max(value, ts) AS value
        FROM points GROUP BY 1, 2"""),
    "retention_batches": _with(BATCH_POINTS, """
        SELECT series, ts, value FROM points
        QUALIFY ts >= max(ts) OVER (PARTITION BY series) - INTERVAL 10 MINUTE"""),
    "trailing_batches": _with([*BATCH_POINTS, VIEW], "SELECT * FROM view"),
    "series_reducers_with_nulls": _with([*BATCH_POINTS, """
n AS (SELECT series, ts, CASE WHEN value % 3 <> 0 THEN value END AS value FROM points)"""], """
        SELECT n.series, max(CASE WHEN n.ts = l.ts THEN n.value END) AS "last", arg_max(n.value, n.ts) AS last_not_null,
          floor(CAST(sum(n.value) AS BIGINT) / count(n.value) * 1000) / 1000 AS mean, max(n.value) AS max
        FROM n JOIN (SELECT series, max(ts) AS ts FROM n GROUP BY 1) l ON n.series = l.series GROUP BY 1"""),
    "panel_fraud_gauge": _with([*BATCH_POINTS, VIEW], """
        SELECT value, CASE WHEN value < 5 THEN 'green' WHEN value < 10 THEN 'yellow' ELSE 'red' END AS band,
          least(value, 50) AS display_value
        FROM (SELECT arg_max(value, ts) AS value FROM view WHERE series = 'ts:txn:fraud')"""),
    "panel_fraud_over_time": _panel("ts:txn:fraud", "sum"),
    "panel_fraud_summary": _with([*BATCH_POINTS, VIEW], """
        SELECT series, arg_max(value, ts) AS "last", arg_max(value, ts) AS last_not_null,
          floor(CAST(sum(value) AS BIGINT) / count(*) * 1000) / 1000 AS mean, max(value) AS max
        FROM view WHERE series = 'ts:txn:fraud' GROUP BY 1"""),
    "panel_amount": _panel("ts:txn:amount_minor", "sum"),
    "panel_throughput": _panel("ts:txn:count", "sum"),
    "panel_total_transactions": _panel("ts:txn:count", "max"),
    "rejected_messages": _with([MESSAGE_STATE], """
        SELECT event_id AS message_id,
          CASE WHEN event_type = 'error' AND value > 60 THEN 'not json' WHEN broken THEN '[1]'
            WHEN event_type = 'error' AND value > 15 THEN '' WHEN absent THEN NULL
            ELSE concat('{"event_id":"', event_id, '","card_ref":"', user_id, '","fraud_flag":1,"amount_minor":',
              CASE WHEN event_type = 'view' THEN 3000000000 ELSE CAST(floor(value * 100 + 0.5::DOUBLE) AS BIGINT) END,
              ',"amount_major":', CASE WHEN event_type = 'click' THEN '"12.34  "' ELSE '2.5' END,
              ',"hour_of_day":', CASE WHEN event_type = 'signup' THEN '""' ELSE '7' END, '}') END AS value,
          concat_ws(',', CASE WHEN absent OR broken THEN 'event_id,card_ref' END, 'merchant_ref',
            CASE WHEN absent OR broken OR event_type = 'view' THEN 'amount_minor' END) AS missing
        FROM msg"""),
    "dedup_events": _with([*LINE_TXNS, """
ids AS (SELECT split_part(event_id, '-', 1) AS event_id, ts, amount_minor FROM t)"""], """
        SELECT event_id, ts, amount_minor FROM ids WHERE ts >= TIMESTAMP '1995-01-01' AND event_id NOT IN (
          SELECT event_id FROM ids WHERE ts < TIMESTAMP '1995-01-01'
            AND ts >= (SELECT min(ts) FROM ids WHERE ts >= TIMESTAMP '1995-01-01') - INTERVAL 30 DAY)
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, amount_minor DESC) = 1"""),
    "counter_partials": _with(LINE_RULES, """
        SELECT strftime(ts, '%Y%m%d') AS day, 'category' AS dimension, coalesce(category, 'UNK') AS value,
          count(*) AS n FROM s WHERE predicted_fraud = 1 GROUP BY 1, 3
        UNION ALL SELECT strftime(ts, '%Y%m%d'), 'channel', channel_code, count(*)
        FROM s WHERE predicted_fraud = 1 GROUP BY 1, 3"""),
    "latest_register": _with(EVENT_TXNS, """
        SELECT amount_minor / 100.0::DOUBLE AS latest_transaction_amount FROM t
        ORDER BY ts DESC, event_id DESC LIMIT 1"""),
    "alert_log": _with(EVENT_FORMULAS, ALERTS.replace(
        "event_ts AS ts", "event_ts AS ts, strftime(trans_date_trans_time, '%Y%m%d') AS day")),
    "store_view": """
        SELECT CAST(o_custkey AS VARCHAR) AS card_ref, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS event_ts,
          concat('o-', lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS event_id,
          CASE WHEN instr(o_orderpriority, '-') = 0 THEN o_orderpriority
            ELSE substr(o_orderpriority, instr(o_orderpriority, '-') + 1) END AS brand,
          CAST(floor(o_totalprice / 4) AS INTEGER) AS daily_limit_minor
        FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "by_key": """
        SELECT CAST(user_id AS VARCHAR) AS card_ref, count(*) AS messages, 1 AS partitions FROM events GROUP BY 1""",
    "opaque_flow_score": _with([*EVENT_JOINED, """
s AS (
  SELECT event_id, CASE WHEN card_found THEN p END AS fraud_probability,
    CASE WHEN card_found AND p >= 0.5 THEN 1 ELSE 0 END AS predicted_fraud
  FROM (SELECT event_id, card_found,
      (1 / (1 + exp(-(coalesce(amount_major, 0) * 0.004 + coalesce(risk_score_merchant, 0) * 0.5 - 2.0)))
      + 1 / (1 + exp(-(risk_score_online * 2.2 - 1.0)))) / 2 AS p FROM j))"""], SCORED_SELECT),
}


# The SQL of the queries in ``live``.
from tillwatch.plans import live_oracle  # noqa: E402

ORACLE_SQL |= live_oracle.SQL
