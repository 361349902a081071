"""Batch tables read as the four record types.

The columns are mapped so that they carry the kinds of dirt the cleaning rules
are for: nulls, blanks, padding, mixed case, values out of range and keys that
are missing. Every row of a table becomes a record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwatch.operators.joins import shuffled_unless_small

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


# Declared, so that no job has to look into the files to plan a query.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{directory}/{name}.parquet")


def raw_users(spark: SparkSession, directory: str, region_names: bool = True) -> DataFrame:
    """One user profile per customer.

    ``region_names=False`` leaves the nation table out for readers that do not
    need ``region_code``, which is null then. An unused left join is not removed
    by the optimizer, which does not know that nations are unique.
    """
    customers = read_table(spark, directory, "customer")
    if region_names:
        nations = read_table(spark, directory, "nation").select("n_nationkey", "n_name")
        named = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    else:
        named = customers.withColumn("n_name", F.lit(None).cast("string"))
    return named.selectExpr(
        "concat('u-', c_custkey) AS event_id",
        "concat(cast(date_add(DATE'2023-01-01', cast(c_custkey % 365 AS int)) AS string), 'T08:00:00+00:00') "
        "AS event_ts",
        "CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 9000 THEN NULL ELSE cast(c_custkey AS string) END "
        "AS party_id",
        "substring_index(c_name, '#', 1) AS given_name",
        "substring_index(c_name, '#', -1) AS family_name",
        "concat_ws(' ', substring_index(c_name, '#', -1), substring_index(c_name, '#', 1)) AS full_name",
        "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender_code",
        "CASE WHEN c_acctbal < -900 THEN NULL WHEN c_acctbal BETWEEN 0 AND 200 THEN 'unknown' "
        "ELSE cast(date_add(DATE'1940-01-01', cast(floor(abs(c_acctbal) * 2.5D) AS int)) AS string) END AS birth_date",
        "CASE WHEN c_acctbal < -900 THEN NULL ELSE cast(1940 + floor(abs(c_acctbal) * 2.5D / 365.25D) AS int) END "
        "AS birth_year",
        "lower(c_mktsegment) AS occupation_title",
        "CASE WHEN c_acctbal < -500 THEN NULL ELSE concat('  ', c_name, ' Street ') END AS address_line",
        "CASE WHEN c_nationkey % 5 = 3 THEN NULL WHEN c_nationkey % 5 = 4 THEN '??' "
        "ELSE concat(' ', lower(n_name), ' ') END AS region_code",
        "lpad(cast(c_nationkey AS string), 6, '0') AS home_postal_hint",
        "CASE c_nationkey % 5 WHEN 0 THEN 'VN-HCM-01' WHEN 1 THEN 'VN-HN-01' WHEN 2 THEN 'VN-DN-01' "
        "WHEN 3 THEN 'XX-NOWHERE-01' END AS location_id_home",
        "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE cast(floor(c_acctbal / 50) AS int) END AS age",
        "CASE c_custkey % 3 WHEN 0 THEN ' 25-34 ' WHEN 1 THEN '65+' END AS age_group",
        "CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN ' low' WHEN c_acctbal < 6000 THEN 'Medium ' "
        "WHEN c_acctbal < 9000 THEN 'HIGH' ELSE '' END AS income_level",
        "CASE WHEN c_acctbal < 500 THEN NULL ELSE c_nationkey * 5.0D - 60.0D END AS home_latitude",
        "CASE WHEN c_acctbal < 500 THEN NULL ELSE c_nationkey * 14.0D - 170.0D END AS home_longitude",
    )


def raw_cards(spark: SparkSession, directory: str) -> DataFrame:
    """One card per customer. Overdrawn customers have no usable card key."""
    return read_table(spark, directory, "customer").selectExpr(
        "concat('c-', c_custkey) AS event_id",
        "concat(cast(date_add(DATE'2023-01-01', cast(c_custkey % 365 AS int)) AS string), 'T09:00:00+00:00') "
        "AS event_ts",
        "cast(c_custkey AS string) AS party_id_fk",
        "CASE WHEN c_acctbal < -500 THEN NULL WHEN c_acctbal < 0 THEN '' ELSE cast(c_custkey AS string) END "
        "AS card_ref",
        "right(lpad(cast(c_custkey AS string), 16, '4'), 4) AS card_pan_last4",
        "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'CREDIT ' WHEN 'BUILDING' THEN ' debit' WHEN 'HOUSEHOLD' THEN '' "
        "WHEN 'MACHINERY' THEN 'CREDIT' END AS product_type",
        "CASE c_nationkey % 4 WHEN 0 THEN 'visa' WHEN 1 THEN 'MC' WHEN 2 THEN '???' END AS brand",
        "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE cast(floor(c_acctbal / 5) AS int) END AS days_since_issuance",
        "CASE c_custkey % 4 WHEN 0 THEN 'new' WHEN 1 THEN ' Recent' WHEN 2 THEN 'ESTABLISHED' END "
        "AS card_age_category",
        "CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE cast(c_custkey % 3 AS int) END AS is_primary_card",
        "CASE WHEN c_acctbal > 9900 THEN 999999999 WHEN c_custkey % 17 = 0 THEN NULL "
        "ELSE cast(floor(c_acctbal * 10) AS int) END AS daily_limit_minor",
    )


def raw_card_versions(spark: SparkSession, directory: str) -> DataFrame:
    """A change log of cards: each order is a new version of its customer's card."""
    return read_table(spark, directory, "orders").selectExpr(
        "concat('o-', lpad(cast(o_orderkey AS string), 12, '0')) AS event_id",
        f"date_format(o_orderdate, \"{ISO}\") AS event_ts",
        "o_orderdate AS valid_from",
        "cast(o_custkey AS string) AS party_id_fk",
        "cast(o_custkey AS string) AS card_ref",
        "right(lpad(cast(o_orderkey AS string), 16, '4'), 4) AS card_pan_last4",
        "CASE o_orderstatus WHEN 'P' THEN 'CREDIT ' WHEN 'F' THEN ' debit' END AS product_type",
        "substring_index(o_orderpriority, '-', -1) AS brand",
        "cast(o_orderkey % 1200 AS int) AS days_since_issuance",
        "cast(NULL AS string) AS card_age_category",
        "cast(o_orderkey % 2 AS int) AS is_primary_card",
        "cast(floor(o_totalprice / 4) AS int) AS daily_limit_minor",
    )


def raw_merchants(spark: SparkSession, directory: str) -> DataFrame:
    """One merchant per supplier. Suppliers with a negative balance have a blank key."""
    return read_table(spark, directory, "supplier").selectExpr(
        "concat('m-', s_suppkey) AS event_id",
        "concat(cast(date_add(DATE'2023-01-01', cast(s_suppkey % 365 AS int)) AS string), 'T07:00:00+00:00') "
        "AS event_ts",
        "CASE WHEN s_acctbal < 0 THEN '' ELSE cast(s_suppkey AS string) END AS merchant_id",
        "CASE WHEN s_nationkey % 6 = 0 THEN NULL WHEN s_nationkey % 6 = 1 THEN lower(s_name) "
        "ELSE concat(' ', s_name) END AS merchant_display_name",
        "CASE s_suppkey % 8 WHEN 0 THEN 'ELEC' WHEN 1 THEN 'food' WHEN 2 THEN ' TRVL' WHEN 3 THEN 'FASH' "
        "WHEN 4 THEN 'GROC ' WHEN 5 THEN 'serv' WHEN 6 THEN '' END AS mcc_group",
        "CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_nationkey * 8.0D - 95.0D END AS geo_lat",
        "CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_nationkey * 15.5D - 185.0D END AS geo_lon",
        "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_acctbal / 8000 END AS risk_score_merchant",
        "CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE cast(floor(s_acctbal * 10) AS int) END AS avg_txn_amount_minor",
        "CASE s_suppkey % 4 WHEN 0 THEN 'retail' WHEN 1 THEN ' Online' WHEN 2 THEN 'BOTH' END AS merchant_type",
        "CASE WHEN s_suppkey % 5 = 4 THEN NULL ELSE cast(s_suppkey % 3 AS int) END AS is_high_risk",
    )


def raw_event_txns(spark: SparkSession, directory: str) -> DataFrame:
    """One transaction per row of the event stream; ``ts`` is the event time."""
    events = read_table(spark, directory, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    return events.selectExpr(
        "cast(event_id AS string) AS event_id",
        f"date_format(ts, \"{ISO}\") AS event_ts",
        "cast(unix_seconds(cast(ts AS timestamp)) AS int) AS event_epoch_sec",
        "cast(user_id AS string) AS card_ref",
        "cast(k AS string) AS merchant_ref",
        "CASE WHEN event_type = 'error' THEN -cast(floor(value * 100 + 0.5D) AS int) "
        "WHEN event_type = 'signup' AND value > 100 THEN NULL "
        "ELSE cast(floor(value * 100 + 0.5D) AS int) END AS amount_minor",
        "CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'purchase' THEN value * 10 ELSE value END "
        "AS amount_major",
        "concat('AUTH-', event_id) AS auth_code",
        "CASE event_type WHEN 'error' THEN -1 WHEN 'view' THEN 0 WHEN 'signup' THEN NULL ELSE 1 END AS amount_sign",
        "CASE event_type WHEN 'view' THEN ' vnd' WHEN 'click' THEN 'usd' WHEN 'error' THEN ' ' "
        "WHEN 'signup' THEN 'VND' END AS currency",
        "CASE event_type WHEN 'purchase' THEN ' pos ' WHEN 'view' THEN 'ecom' WHEN 'click' THEN 'Mobile' "
        "WHEN 'signup' THEN '' END AS channel_code",
        "CASE k % 5 WHEN 0 THEN 'chip' WHEN 1 THEN 'MAGSTRIPE ' WHEN 2 THEN 'Contactless' WHEN 3 THEN 'MANUAL' END "
        "AS entry_mode",
        "CASE WHEN k = 50 THEN NULL ELSE value / 300 - 0.1D END AS risk_score_online",
        "CASE WHEN event_type <> 'error' THEN hour(ts) WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN -1 ELSE 27 END "
        "AS hour_of_day",
        "0 AS is_unusual_hour",
        "CASE WHEN k % 4 = 0 THEN NULL ELSE value - 50 END AS distance_from_home_km",
        "'STALE' AS amount_category",
        "CASE WHEN k % 10 = 9 THEN NULL ELSE k % 3 END AS exceeds_daily_limit",
        "CASE WHEN k % 6 = 0 THEN NULL ELSE (50 - value) / 100 END AS amount_deviation_ratio",
        "CASE WHEN k = 7 THEN NULL ELSE k - 20 END AS days_since_card_issued",
        "ts",
    )


# What is told of an order line without its order: numbers first, then what is only text or constant.
_LINE_VALUES = [
    "l_shipdate + make_dt_interval(0, cast(l_quantity AS int) % 24, l_linenumber) AS ts",
    "CASE WHEN l_tax = 0 THEN -cast(floor(l_extendedprice + 0.5D) AS int) "
    "ELSE cast(floor(l_extendedprice + 0.5D) AS int) END AS amount_minor",
    "CASE WHEN l_tax > 0.06D THEN NULL ELSE floor(l_extendedprice + 0.5D) / 100 END AS amount_major",
    "CASE l_returnflag WHEN 'R' THEN -1 ELSE 1 END AS amount_sign",
    "CASE l_returnflag WHEN 'R' THEN ' pos' WHEN 'A' THEN 'Ecom' END AS channel_code",
    "CASE l_linestatus WHEN 'O' THEN 'chip ' END AS entry_mode",
    "l_discount * 12 - 0.1D AS risk_score_online",
    "l_discount",
]
_LINE_TEXTS = [
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id",
    f"date_format(ts, \"{ISO}\") AS event_ts",
    "cast(unix_seconds(cast(ts AS timestamp)) AS int) AS event_epoch_sec",
    "cast(l_suppkey AS string) AS merchant_ref",
    "amount_minor",
    "amount_major",
    "concat('AUTH-', l_partkey) AS auth_code",
    "amount_sign",
    "'vnd' AS currency",
    "channel_code",
    "entry_mode",
    "risk_score_online",
    "CASE WHEN l_discount = 0 THEN NULL WHEN l_discount > 0.09D THEN 27 ELSE hour(ts) END AS hour_of_day",
    "0 AS is_unusual_hour",
    "cast(NULL AS double) AS distance_from_home_km",
    "cast(NULL AS string) AS amount_category",
    "cast(NULL AS int) AS exceeds_daily_limit",
    "cast(NULL AS double) AS amount_deviation_ratio",
    "cast(NULL AS int) AS days_since_card_issued",
    "ts",
]


def _line_values(spark: SparkSession, directory: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return read_table(spark, directory, "lineitem").selectExpr(*keys, *_LINE_VALUES)


def raw_lines(spark: SparkSession, directory: str) -> DataFrame:
    """The transactions of ``raw_line_txns`` before their card is known: ``order_ref`` leads to it by ``order_cards``.

    Lines without an order are among them.
    """
    return _line_values(spark, directory).selectExpr("l_orderkey AS order_ref", *_LINE_TEXTS)


def order_cards(spark: SparkSession, directory: str) -> DataFrame:
    """(order_ref, card_ref): the card of each order, that of its customer."""
    return read_table(spark, directory, "orders").selectExpr(
        "o_orderkey AS order_ref", "cast(o_custkey AS string) AS card_ref")


def raw_line_txns(spark: SparkSession, directory: str) -> DataFrame:
    """One transaction per order line, with the card of the order's customer.

    Both sides are scans, so a hot order key is left to adaptive skew handling.
    Texts are made after the join, which moves the numbers they are made of.
    """
    orders = shuffled_unless_small(read_table(spark, directory, "orders").select("o_orderkey", "o_custkey"))
    lines = _line_values(spark, directory).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    before = _LINE_TEXTS[:3]
    return lines.selectExpr(*before, "cast(o_custkey AS string) AS card_ref", *_LINE_TEXTS[len(before):])


def event_messages(spark: SparkSession, directory: str) -> DataFrame:
    """The event stream as JSON messages, some of them malformed or with badly typed fields.

    ``event_id`` is kept beside the message so that its outcome can be looked up.
    """
    return read_table(spark, directory, "events").selectExpr(
        "event_id AS message_id",
        "CASE WHEN event_type = 'error' AND value > 60 THEN 'not json' "
        "WHEN event_type = 'error' AND value > 30 THEN '[1]' "
        "WHEN event_type = 'error' AND value > 15 THEN '' "
        "WHEN event_type = 'error' AND value > 5 THEN NULL "
        "ELSE concat('{\"event_id\":\"', event_id, '\",\"card_ref\":\"', user_id, '\",\"fraud_flag\":1', "
        "CASE WHEN event_type = 'view' THEN ',\"amount_minor\":3000000000' "
        "ELSE concat(',\"amount_minor\":', cast(floor(value * 100 + 0.5D) AS bigint)) END, "
        "CASE WHEN event_type = 'click' THEN ',\"amount_major\":\"12.34  \"' ELSE ',\"amount_major\":2.5' END, "
        "CASE WHEN event_type = 'signup' THEN ',\"hour_of_day\":\"\"' ELSE ',\"hour_of_day\":7' END, "
        "'}') END AS value",
    )
