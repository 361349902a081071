"""Equivalent SQL of the queries in ``live``."""

from __future__ import annotations

from tillwatch.plans.oracle import AS_OF, EVENT_FORMULAS, HISTOGRAM, LINE_RULES, ORACLE_SQL, _points, _with

# Kind and value of each field of the messages that are JSON objects.
FIELDS = """
fields AS (
  SELECT event_id AS message_id,
    unnest(['event_id', 'card_ref', 'fraud_flag', 'amount_minor', 'amount_major', 'hour_of_day']) AS field,
    unnest(['string', 'string', 'number', 'number', CASE WHEN event_type = 'click' THEN 'string' ELSE 'number' END,
      CASE WHEN event_type = 'signup' THEN 'string' ELSE 'number' END]) AS kind,
    unnest([NULL, NULL, NULL, NULL, '12.34  ', '']) AS found
  FROM events WHERE event_type <> 'error' OR value <= 5)"""

SQL = {
    "latest_cards_from_state": ORACLE_SQL["latest_by_key_cards"],
    "observed_metrics": _with(EVENT_FORMULAS, """
        SELECT unnest(['ts:txn:count', 'ts:txn:fraud', 'ts:txn:pred', 'ts:txn:amount_minor']) AS series,
          unnest([count(*), CAST(sum(predicted_fraud) AS BIGINT), CAST(sum(predicted_fraud) AS BIGINT),
            CAST(sum(amount_minor) AS BIGINT)]) AS value
        FROM s"""),
    "observed_histogram": _with(EVENT_FORMULAS, HISTOGRAM),
    "counters_after_failure": _with(EVENT_FORMULAS, """
        SELECT strftime(ts, '%Y%m%d') AS day, dimension, value, count(*) AS n
        FROM (SELECT ts, unnest(['category', 'channel']) AS dimension,
            unnest([coalesce(category, 'UNK'), channel_code]) AS value
          FROM s WHERE predicted_fraud = 1)
        GROUP BY 1, 2, 3"""),
    "asof_corrected": AS_OF,
    "enrich_txn_bucketed": ORACLE_SQL["enrich_txn"],
    "stored_series_range": _with([*EVENT_FORMULAS, _points("1 second")], """
        SELECT ts, value FROM points WHERE series = 'ts:txn:amount_minor'
          AND ts BETWEEN (SELECT min(ts) FROM points) + INTERVAL 36 HOUR AND (SELECT min(ts) FROM points) + INTERVAL 72 HOUR"""),
    "stored_retention": ORACLE_SQL["retention_10m"],
    "dyadic_ranges": _with([*EVENT_FORMULAS, _points("1 second")], """
        SELECT range_id, series, count(*) AS n, CAST(sum(value) AS BIGINT) AS sum, max(value) AS max, arg_max(value, ts) AS last
        FROM points JOIN (
          SELECT CAST(n_nationkey AS BIGINT) AS range_id, u + n_nationkey * 40003 AS a,
            u + n_nationkey * 40003 + (n_nationkey + 1) * 30011 AS b
          FROM nation, (SELECT CAST(epoch(min(ts)) AS BIGINT) AS u FROM points)) ON epoch(ts) >= a AND epoch(ts) < b
        GROUP BY 1, 2"""),
    "orphan_cards_filtered": ORACLE_SQL["orphan_cards"],
    "offset_faults": """
        WITH lines AS (SELECT CAST(l_linenumber AS INTEGER) AS p, CAST(l_orderkey AS BIGINT) AS o FROM lineitem),
        messages AS (SELECT * FROM lines WHERE o % 50 NOT IN (7, 8) UNION ALL SELECT * FROM lines WHERE o % 97 = 5),
        counted AS (SELECT p, o, count(*) AS n FROM messages GROUP BY 1, 2),
        nexts AS (SELECT p, o, lead(o) OVER (PARTITION BY p ORDER BY o) AS following FROM counted),
        islands AS (SELECT p, o, o - row_number() OVER (PARTITION BY p ORDER BY o) AS island FROM counted WHERE n > 1)
        SELECT p AS kafka_partition, 'missing' AS fault, o + 1 AS first_offset, following - 1 AS last_offset
        FROM nexts WHERE following > o + 1
        UNION ALL SELECT p, 'repeated', min(o), max(o) FROM islands GROUP BY p, island""",
    "rule_score_auc": _with(LINE_RULES, """
, counts AS (
  SELECT fraud_probability AS score, count(*) FILTER (WHERE amount_sign = -1) AS pos,
    count(*) FILTER (WHERE amount_sign <> -1) AS neg
  FROM s WHERE fraud_probability IS NOT NULL GROUP BY 1),
above AS (
  SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
    sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM counts)
SELECT CAST(floor(CAST(sum(neg * (2 * tp - pos)) AS DOUBLE) / (2 * CAST(any_value(p) AS DOUBLE) * any_value(n)) * 1000000) AS BIGINT)
    AS auc_millionths,
  arg_max(score, (tp * n - fp * p, score)) AS cutoff, CAST(arg_max(tp, (tp * n - fp * p, score)) AS BIGINT) AS true_positives,
  CAST(arg_max(fp, (tp * n - fp * p, score)) AS BIGINT) AS false_positives
FROM above"""),
    "undeclared_fields": _with([FIELDS], """
        SELECT field, kind, count(*) AS n FROM fields GROUP BY 1, 2"""),
    "mistyped_fields": _with([FIELDS], """
        SELECT message_id, field, kind, found FROM fields
        WHERE kind <> 'null' AND kind <> CASE WHEN field IN ('amount_minor', 'amount_major', 'hour_of_day') THEN 'number'
          WHEN field IN ('event_id', 'card_ref') THEN 'string' END"""),
}
