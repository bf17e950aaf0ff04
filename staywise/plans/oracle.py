"""The expected result of each registered query as SQL over the same tables."""

_EVENTS = """
SELECT e.event_id, e.ts AS event_time,
       CAST(e.user_id AS INT) AS customer_id,
       CAST(18 + (e.user_id * 7) % 53 AS INT) AS age,
       CASE WHEN e.user_id % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
       r.r_name AS location,
       CASE WHEN c.c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Basic'
            WHEN c.c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'Standard'
            ELSE 'Premium' END AS subscription_type,
       20.0E0 + CAST(CAST(round(e.value * 100) AS BIGINT) % 13001 AS DOUBLE) / 100.0E0
           AS monthly_charges,
       CAST(1 + e.event_id % 72 AS INT) AS tenure_months,
       CAST(CAST(json_extract_string(e.props, '$.k') AS INT) % 11 AS INT) AS support_tickets,
       CAST((e.event_id + CAST(json_extract_string(e.props, '$.k') AS INT)) % 6 AS INT)
           AS late_payments,
       strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp"
FROM events e
JOIN customer c ON c.c_custkey = e.user_id
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
"""

_FLAGS = """
       CASE WHEN late_payments >= 3 THEN 1 ELSE 0 END AS is_payment_risky,
       CASE WHEN support_tickets >= 7 THEN 1 ELSE 0 END AS is_high_support
"""

_BUCKETS = """
       CASE WHEN tenure_months < 6 THEN 'new' WHEN tenure_months < 24 THEN 'mid'
            ELSE 'loyal' END AS tenure_bucket,
       CASE WHEN monthly_charges < 50 THEN 'low' WHEN monthly_charges < 100 THEN 'medium'
            ELSE 'high' END AS charge_bucket
"""

_RISK = "late_payments + support_tickets AS engagement_risk_score"

_DIRTY = """
SELECT event_id, event_time,
       CASE WHEN event_id % 50 <> 0 THEN customer_id END AS customer_id,
       CASE WHEN event_id % 50 <> 0 THEN age END AS age,
       CASE event_id % 50 WHEN 0 THEN NULL WHEN 1 THEN 'Other' ELSE gender END AS gender,
       CASE WHEN event_id % 50 <> 0 THEN location END AS location,
       CASE event_id % 50 WHEN 0 THEN NULL WHEN 3 THEN 'Gold' ELSE subscription_type END
           AS subscription_type,
       CASE event_id % 50 WHEN 0 THEN NULL WHEN 5 THEN CAST('NaN' AS DOUBLE)
            WHEN 6 THEN CAST('Infinity' AS DOUBLE) ELSE monthly_charges END AS monthly_charges,
       CASE WHEN event_id % 50 NOT IN (0, 2) THEN tenure_months END AS tenure_months,
       CASE WHEN event_id % 50 NOT IN (0, 4) THEN support_tickets END AS support_tickets,
       CASE WHEN event_id % 50 <> 0 THEN late_payments END AS late_payments,
       CASE WHEN event_id % 50 <> 0 THEN "timestamp" END AS "timestamp"
FROM ev
"""

_WITH = f"""
WITH ev AS ({_EVENTS}),
gold AS (SELECT *, {_FLAGS}, {_BUCKETS}, {_RISK} FROM ev),
lab AS (
  SELECT *, CASE WHEN (late_payments >= 3 AND support_tickets >= 7)
                   OR (tenure_months < 6 AND monthly_charges > 100)
                   OR (subscription_type = 'Basic' AND support_tickets >= 5)
                 THEN 1 ELSE 0 END AS churn_label
  FROM gold),
fixed AS (SELECT *, engagement_risk_score / 15.0E0 AS churn_prob FROM lab),
cls AS (SELECT *, CASE WHEN churn_prob >= 0.4E0 THEN 1.0E0 ELSE 0.0E0 END
                    AS prediction_custom FROM fixed),
dirty AS ({_DIRTY})
"""

_RAW_FIELDS = """customer_id, age, gender, location, subscription_type, monthly_charges,
       tenure_months, support_tickets, late_payments, "timestamp" """

_SCORING_FIELDS = """gender, location, subscription_type, tenure_months, monthly_charges,
       support_tickets, late_payments"""

_GOLD_FIELDS = f"""{_SCORING_FIELDS}, tenure_bucket, charge_bucket"""

_GOLD_TAIL = "is_payment_risky, is_high_support, engagement_risk_score"

_MS = "date_trunc('millisecond', event_time)"


def _column(expression: str) -> str:
    return f"{_WITH} SELECT event_id, {expression} FROM lab"


# Falling scores, running counts, trapezoids over the distinct scores.
def _areas(source: str, score: str) -> str:
    return f"""{_WITH},
s AS (SELECT {score} AS p, churn_label AS y FROM {source}),
g AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY p),
c AS (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp,
             sum(pos) OVER () AS P_, sum(neg) OVER () AS N_ FROM g),
l AS (SELECT *, tp * 1.0E0 / P_ AS rec, tp * 1.0E0 / (tp + fp) AS pre,
             lag(tp * 1.0E0 / P_) OVER (ORDER BY p DESC) AS rec0,
             lag(tp * 1.0E0 / (tp + fp)) OVER (ORDER BY p DESC) AS pre0 FROM c),
a AS (SELECT round(sum(neg * (tp - pos / 2.0E0)) / max(P_ * 1.0E0 * N_), 10) AS roc_auc,
             round(sum((rec - coalesce(rec0, 0.0E0)) * (pre + coalesce(pre0, pre)) / 2.0E0), 10)
                 AS pr_auc FROM l)
"""


_CONFUSION = """
SELECT count(*) FILTER (churn_label = 1 AND prediction_custom = 1) AS "TP",
       count(*) FILTER (churn_label = 0 AND prediction_custom = 0) AS "TN",
       count(*) FILTER (churn_label = 0 AND prediction_custom = 1) AS "FP",
       count(*) FILTER (churn_label = 1 AND prediction_custom = 0) AS "FN"
FROM cls
"""

_METRICS = f"""
SELECT *, 2 * (precision_class_1 * recall_class_1) / (precision_class_1 + recall_class_1)
            AS f1_class_1
FROM (SELECT *, CAST("TP" + "TN" AS DOUBLE) / ("TP" + "TN" + "FP" + "FN") AS accuracy,
             CAST("TP" AS DOUBLE) / ("TP" + "FP") AS precision_class_1,
             CAST("TP" AS DOUBLE) / ("TP" + "FN") AS recall_class_1,
             CAST("TN" AS DOUBLE) / ("TN" + "FP") AS specificity
      FROM ({_CONFUSION}))
"""

_CATEGORIES = ("gender", "location", "subscription_type", "tenure_bucket", "charge_bucket")

_PAIRS = " UNION ALL ".join(
    f"""SELECT event_id, '{c}' AS "column", {c} AS value FROM gold""" for c in _CATEGORIES
)

_INDEX = f"""
pairs AS ({_PAIRS}),
idx AS (SELECT "column", value,
               row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, value) - 1 AS i
        FROM pairs GROUP BY "column", value)
"""

# Where each column's block starts in the feature vector.
_BLOCKS = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (SELECT count(*) FROM idx WHERE "column" IN ({prior}))
        AS start"""
    for c, prior in (
        (c, ", ".join(f"'{p}'" for p in _CATEGORIES[:i]) or "''")
        for i, c in enumerate(_CATEGORIES)
    )
)

_VECTOR = f"""{_WITH}, {_INDEX},
blocks AS ({_BLOCKS}),
width AS (SELECT count(*) AS w FROM idx),
hot AS (SELECT p.event_id, b.start + i.i AS position
        FROM pairs p JOIN idx i USING ("column", value) JOIN blocks b USING ("column")),
places AS (SELECT b.start + i.i AS position FROM idx i JOIN blocks b USING ("column"))
SELECT g.event_id, CAST(p.position AS INT) AS position,
       CASE WHEN h.event_id IS NULL THEN 0.0E0 ELSE 1.0E0 END AS value
FROM gold g CROSS JOIN places p
LEFT JOIN hot h ON h.event_id = g.event_id AND h.position = p.position
UNION ALL SELECT event_id, CAST(w AS INT), monthly_charges FROM gold, width
UNION ALL SELECT event_id, CAST(w + 1 AS INT), CAST(tenure_months AS DOUBLE) FROM gold, width
UNION ALL SELECT event_id, CAST(w + 2 AS INT), CAST(support_tickets AS DOUBLE) FROM gold, width
UNION ALL SELECT event_id, CAST(w + 3 AS INT), CAST(late_payments AS DOUBLE) FROM gold, width
"""

_PROFILE_TYPES = {
    "customer_id": "int",
    "age": "int",
    "gender": "string",
    "location": "string",
    "subscription_type": "string",
    "monthly_charges": "double",
    "tenure_months": "int",
    "support_tickets": "int",
    "late_payments": "int",
    "timestamp": "string",
}

_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS type, count("{c}") AS non_null,
        count(DISTINCT "{c}") AS distinct_values, CAST(min("{c}") AS VARCHAR) AS min,
        CAST(max("{c}") AS VARCHAR) AS max FROM ev"""
    for c, t in _PROFILE_TYPES.items()
)

_REASONS = """
SELECT event_id, concat_ws(',',
         CASE WHEN gender IS NULL OR gender NOT IN ('Male', 'Female') THEN 'gender' END,
         CASE WHEN location IS NULL THEN 'location' END,
         CASE WHEN subscription_type IS NULL
                OR subscription_type NOT IN ('Basic', 'Standard', 'Premium')
              THEN 'subscription_type' END,
         CASE WHEN tenure_months IS NULL THEN 'tenure_months' END,
         CASE WHEN monthly_charges IS NULL OR NOT isfinite(monthly_charges)
              THEN 'monthly_charges' END,
         CASE WHEN support_tickets IS NULL THEN 'support_tickets' END,
         CASE WHEN late_payments IS NULL THEN 'late_payments' END) AS reasons
FROM dirty
"""

_REQUIRED = (
    "gender",
    "location",
    "subscription_type",
    "tenure_months",
    "monthly_charges",
    "support_tickets",
    "late_payments",
)

_PRESENCE = " UNION ALL ".join(
    [
        f"""SELECT '{c}' AS field, count({c}) AS present, count(*) - count({c}) AS missing
        FROM dirty"""
        for c in _REQUIRED
    ]
    + [
        f"""SELECT '{c}' AS field, CAST(0 AS BIGINT) AS present, count(*) AS missing
        FROM dirty"""
        for c in ("tenure_bucket", "charge_bucket")
    ]
)

_TRAINING_ROWS = f"{_WITH} SELECT {_RAW_FIELDS} FROM ev"

_INFERRED_ROWS = f"""{_WITH} SELECT CAST(customer_id AS BIGINT) AS customer_id,
       CAST(age AS BIGINT) AS age, gender, location, subscription_type, monthly_charges,
       CAST(tenure_months AS BIGINT) AS tenure_months,
       CAST(support_tickets AS BIGINT) AS support_tickets,
       CAST(late_payments AS BIGINT) AS late_payments, "timestamp" FROM ev"""

_GOLD_ROWS = f"""{_RAW_FIELDS}, is_payment_risky, is_high_support, tenure_bucket,
       charge_bucket, engagement_risk_score"""


def _gold_scoring(time: str = "event_time", source: str = "gold") -> str:
    return f"""SELECT {_GOLD_FIELDS}, {time} AS ingestion_time, {_GOLD_TAIL} FROM {source}"""


_METRIC_ROWS = " UNION ALL ".join(
    f"""SELECT 'metric' AS kind, '{m}' AS key, CAST("{m}" AS DOUBLE) AS number,
        CAST(NULL AS VARCHAR) AS text FROM m"""
    for m in (
        "TP",
        "TN",
        "FP",
        "FN",
        "accuracy",
        "precision_class_1",
        "recall_class_1",
        "specificity",
        "f1_class_1",
    )
)

_STREAM_COUNTS = f"""{_WITH} SELECT reasons, count(*) AS n_rows,
    count(*) FILTER (reasons = '') AS n_scored FROM ({_REASONS}) GROUP BY reasons"""

# Kind of damage, what it does to one field, and the field.
_BROKEN = (
    (5, "tenure_months", "null"),
    (6, "support_tickets", "wrong_type"),
    (7, "customer_id", "overflow"),
    (8, "late_payments", "wrong_type"),
    (9, "monthly_charges", "wrong_type"),
    (10, "monthly_charges", "overflow"),
    (11, "gender", "wrong_type"),
    (12, "location", "wrong_type"),
    (14, "age", "absent"),
    (14, "tenure_months", "null"),
)

_BROKEN_FIELDS = ", ".join(
    f"""CASE WHEN event_id % 50 NOT IN (0, 1, 2, 3, 4{"".join(
        f", {k}" for k, field, _ in _BROKEN if field == c
    )}) THEN "{c}" END AS "{c}\""""
    for c in _PROFILE_TYPES
)

_DEFECTS = f"""{_WITH}, broken AS (
  SELECT event_id AS "offset", {_BROKEN_FIELDS},
    CASE event_id % 50 WHEN 0 THEN 'message:malformed' WHEN 1 THEN 'message:empty'
      WHEN 2 THEN 'message:empty' WHEN 3 THEN 'message:no_object' WHEN 4 THEN 'message:malformed'
      {" ".join(f"WHEN {k} THEN '{c}:{s}'" for k, c, s in _BROKEN if k != 14)}
      WHEN 14 THEN 'age:absent,tenure_months:null' ELSE '' END AS defects,
    CASE WHEN event_id % 50 = 13 THEN 'Age,tier' ELSE '' END AS unknown
  FROM ev)"""

_FANOUT = f"""{_WITH} SELECT s.sink, g.* FROM ({_gold_scoring(_MS)}) g,
    (SELECT 'table' AS sink UNION ALL SELECT 'message') s"""

_JSON_TYPES = {"int": "bigint", "double": "double", "string": "string"}

# Fields that differ from the declared ones: name, type, when there, when null.
_JSON_FIELDS = [
    (c, {"support_tickets": "string", "late_payments": "double"}.get(c, _JSON_TYPES[t]), "true", "false")
    for c, t in _PROFILE_TYPES.items()
] + [
    ("is_gift", "boolean", "k = 3", "false"),
    ("note", "string", "false", "k = 7"),
]

_FIELDS = " UNION ALL ".join(
    f"""SELECT '{c}' AS field, '{t}' AS type, count(*) FILTER ({there}) AS n,
        count(*) FILTER ({null}) AS n_null, count(*) FILTER (NOT ({there}) AND NOT ({null})) AS n_absent
        FROM json HAVING count(*) FILTER (({there}) OR ({null})) > 0"""
    for c, t, there, null in _JSON_FIELDS
)

_DRIFT = " UNION ALL ".join(
    [
        f"""SELECT '{c}' AS field, min(b) AS batch_id, CAST(NULL AS VARCHAR) AS before,
        '{_JSON_TYPES.get(_PROFILE_TYPES.get(c, ""), t)}' AS after
        FROM json WHERE ({there}) OR ({null}) HAVING count(*) > 0"""
        for c, t, there, null in _JSON_FIELDS
    ]
    + [
        f"""SELECT '{c}', min(b), 'bigint', '{t}' FROM json WHERE k = {k} HAVING count(*) > 0"""
        for c, t, k in (("support_tickets", "string", 1), ("late_payments", "double", 5))
    ]
)

_JSON = f"""{_WITH}, lines AS (SELECT *, event_id % 50 AS k, event_id % 2 AS b FROM ev),
json AS (SELECT * FROM lines WHERE k <> 9)"""

ORACLE = {
    "gold_label_counts": f"""{_WITH} SELECT tenure_bucket, charge_bucket, churn_label,
        count(*) AS n FROM lab GROUP BY ALL""",
    "src_json_stream": _TRAINING_ROWS,
    "src_json_batch_inferred": _INFERRED_ROWS,
    "src_json_fields": f"{_JSON} {_FIELDS}",
    "src_json_drift": f"{_JSON} {_DRIFT}",
    "src_json_merged_schema": f"""{_JSON} SELECT """
    + ", ".join(
        f"""CASE WHEN k <> 9 THEN {e} END AS "{c}\""""
        for c, e in [
            *((c, f'"{c}"') for c, t in _PROFILE_TYPES.items() if t != "int"),
            *((c, f"CAST({c} AS BIGINT)") for c in ("customer_id", "age", "tenure_months")),
            ("support_tickets", "CASE k WHEN 1 THEN 'many' ELSE CAST(support_tickets AS VARCHAR) END"),
            ("late_payments", "CASE k WHEN 5 THEN 0.5E0 ELSE CAST(late_payments AS DOUBLE) END"),
            ("is_gift", "CASE k WHEN 3 THEN true END"),
        ]
    )
    + " FROM lines",
    "sink_json_stream": _TRAINING_ROWS,
    "sink_json_batch": f"{_WITH} SELECT event_id, {_GOLD_ROWS} FROM gold",
    "rows_source": f"""{_WITH} SELECT count(*) AS n_events,
        count(DISTINCT location) AS n_locations, max(support_tickets) AS max_tickets
        FROM ev""",
    "bronze_raw": f"""{_WITH} SELECT '{{"customer_id":' || customer_id || ',"age":' || age
        || ',"gender":"' || gender || '","location":"' || location
        || '","subscription_type":"' || subscription_type
        || '","monthly_charges":' || monthly_charges || ',"tenure_months":' || tenure_months
        || ',"support_tickets":' || support_tickets || ',"late_payments":' || late_payments
        || ',"timestamp":"' || "timestamp" || '"}}' AS raw_json FROM ev""",
    "bronze_ingest_stamp": f"""{_WITH} SELECT count(*) AS n_rows, count(*) AS n_stamped,
        CAST(1 AS BIGINT) AS n_clocks FROM ev""",
    "silver_parsed": f'{_WITH} SELECT event_id AS "offset", {_RAW_FIELDS} FROM dirty',
    "silver_conformed": f"""{_WITH} SELECT {_SCORING_FIELDS}, 'new' AS tenure_bucket,
        'high' AS charge_bucket, event_time AS ingestion_time FROM ev""",
    "silver_coerced": _TRAINING_ROWS,
    "silver_defects": f"{_DEFECTS} SELECT * FROM broken",
    "defect_counts": f"""{_DEFECTS} SELECT split_part(d, ':', 1) AS field,
        split_part(d, ':', 2) AS state, count(*) AS n
        FROM (SELECT unnest(string_split(defects, ',')) AS d FROM broken WHERE defects <> '')
        GROUP BY ALL""",
    "gold_overwrites_buckets": f"{_WITH} SELECT event_id, {_GOLD_FIELDS} FROM gold",
    "gold_batch": f"{_WITH} SELECT event_id, {_GOLD_ROWS} FROM gold",
    "gold_message": f"{_WITH} {_gold_scoring(_MS)}",
    "gold_stream": f"{_WITH} {_gold_scoring()}",
    "gold_stream_fanout": _FANOUT,
    "gold_fanout_once": _FANOUT,
    "gold_compacted": f"""{_WITH} SELECT s.sink, g.* FROM ({_gold_scoring()}) g,
        (SELECT 'table' AS sink UNION ALL SELECT 'next') s""",
    "medallion_lane_a": f"{_WITH} SELECT {_GOLD_ROWS} FROM gold",
    "medallion_lane_b": f"{_WITH} {_gold_scoring()}",
    "feat_payment_risky": _column("is_payment_risky"),
    "feat_high_support": _column("is_high_support"),
    "feat_high_support_alt": _column(
        "CASE WHEN support_tickets >= 5 THEN 1 ELSE 0 END AS is_high_support_customer"
    ),
    "feat_tenure_bucket": _column("tenure_bucket"),
    "feat_charge_bucket": _column("charge_bucket"),
    "feat_risk_score": _column("engagement_risk_score"),
    "churn_label": _column("churn_label"),
    "label_counts": f"""{_WITH} SELECT churn_label, count(*) AS "count" FROM lab
        GROUP BY churn_label""",
    "class_balance": f"""{_WITH} SELECT neg, pos,
        CAST(greatest(neg, 1) AS DOUBLE) / greatest(pos, 1) AS balance_ratio
        FROM (SELECT count(*) FILTER (churn_label = 0) AS neg,
                     count(*) FILTER (churn_label = 1) AS pos FROM lab)""",
    "class_weight": f"""{_WITH}, b AS (SELECT
          CAST(greatest(count(*) FILTER (churn_label = 0), 1) AS DOUBLE)
          / greatest(count(*) FILTER (churn_label = 1), 1) AS ratio FROM lab)
        SELECT event_id, churn_label,
               CASE WHEN churn_label = 1 THEN ratio ELSE 1.0E0 END AS class_weight
        FROM lab, b""",
    "validate_events": f"""{_WITH} SELECT event_id AS "offset",
        CASE WHEN reasons = '' THEN 1 ELSE 0 END AS is_valid, reasons FROM ({_REASONS})""",
    "reject_reasons": f"""{_WITH} SELECT reason, count(*) AS n FROM (
          SELECT unnest(string_split(reasons, ',')) AS reason FROM ({_REASONS})
          WHERE reasons <> '') GROUP BY reason""",
    "required_fields": f"{_WITH} {_PRESENCE}",
    "classify_threshold": f"""{_WITH} SELECT event_id, churn_prob, prediction_custom
        FROM cls""",
    "confusion_crosstab": f"""{_WITH} SELECT churn_label, prediction_custom,
        count(*) AS "count" FROM cls GROUP BY ALL""",
    "confusion_matrix": f"{_WITH} {_CONFUSION}",
    "classification_metrics": f"{_WITH} {_METRICS}",
    "roc_auc_exact": f"{_areas('fixed', 'churn_prob')} SELECT roc_auc FROM a",
    "pr_auc_exact": f"{_areas('fixed', 'churn_prob')} SELECT pr_auc FROM a",
    "roc_auc_mllib": f"{_areas('fixed', 'churn_prob')} SELECT roc_auc FROM a",
    "pr_auc_mllib": f"{_areas('fixed', 'churn_prob')} SELECT pr_auc FROM a",
    "score_curve": f"""{_areas('lab', 'monthly_charges')} SELECT p AS score,
        CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, CAST(tp AS BIGINT) AS tp,
        CAST(fp AS BIGINT) AS fp FROM c""",
    "curve_areas_many_scores": f"""{_areas('lab', 'monthly_charges')}
        SELECT roc_auc, pr_auc FROM a""",
    "score_output_record": f"""{_WITH} SELECT event_id, {_GOLD_FIELDS},
        prediction_custom AS prediction FROM cls""",
    "score_response_record": f"""{_WITH} SELECT churn_prob AS churn_probability,
        CAST(prediction_custom AS INT) AS prediction, 0.4E0 AS threshold FROM cls""",
    "run_log_table": f"""{_WITH}, m AS ({_METRICS}), rows_ AS ({_METRIC_ROWS}
        UNION ALL SELECT 'param', 'model_type', NULL, 'fixed'
        UNION ALL SELECT 'param', 'threshold', 0.4E0, NULL
        UNION ALL SELECT 'param', 'maxIter', 20.0E0, NULL)
        SELECT 'run-1' AS run_id, 'fixed_scores' AS run_name, kind, key, number, text
        FROM rows_""",
    "profile_silver": f"{_WITH} {_PROFILE}",
    "head_silver": f"""{_WITH} SELECT event_id, {_RAW_FIELDS} FROM ev
        ORDER BY "timestamp", event_id LIMIT 10""",
    "string_index": f"""{_WITH}, {_INDEX} SELECT event_id, """
    + ", ".join(
        f"""CAST(max(CASE WHEN "column" = '{c}' THEN i END) AS DOUBLE) AS {c}_index"""
        for c in _CATEGORIES
    )
    + """ FROM pairs JOIN idx USING ("column", value) GROUP BY event_id""",
    "string_index_table": f"""{_WITH}, {_INDEX} SELECT "column", value,
        CAST(i AS DOUBLE) AS index FROM idx""",
    "one_hot": f"""{_WITH}, {_INDEX} SELECT event_id, "column", CAST(i AS INT) AS position
        FROM pairs JOIN idx USING ("column", value)""",
    "feature_vector": _VECTOR,
    "split_counts": f"""{_WITH} SELECT
        CASE WHEN (event_id * 7919) % 100 < 80 THEN 'train' ELSE 'test' END AS part,
        churn_label, count(*) AS n FROM lab GROUP BY ALL""",
    "score_saved_model": f"""{_WITH} SELECT count(*) AS n_rows,
        CAST(0 AS BIGINT) AS n_different FROM ev""",
    "score_stream_counts": _STREAM_COUNTS,
    "score_stream_restart": _STREAM_COUNTS,
    "score_stream_redelivered": _STREAM_COUNTS,
    "train_metrics": f"""{_WITH}, {_INDEX} SELECT
        count(*) FILTER ((event_id * 7919) % 100 < 80) AS n_train,
        count(*) FILTER ((event_id * 7919) % 100 >= 80) AS n_test,
        CAST((SELECT count(*) FROM idx WHERE ("column", value) IN (
                SELECT "column", value FROM pairs WHERE (event_id * 7919) % 100 < 80)) + 4 AS INT)
            AS n_features,
        CAST(greatest(count(*) FILTER (churn_label = 0), 1) AS DOUBLE)
          / greatest(count(*) FILTER (churn_label = 1), 1) AS balance_ratio,
        count(*) FILTER ((event_id * 7919) % 100 >= 80) AS n_confusion,
        1 AS recall_rises, 1 AS is_balanced FROM lab""",
    "train_hashed": f"""{_WITH} SELECT 68 AS n_features,
        count(*) FILTER ((event_id * 7919) % 100 < 80) AS n_train,
        count(*) FILTER ((event_id * 7919) % 100 >= 80) AS n_test, 1 AS is_learned FROM lab""",
    "gold_versions": f"""{_WITH}, v AS (
          SELECT 'first' AS step, 'new' AS reader, 3 AS every UNION ALL SELECT 'failed', 'new', 3
          UNION ALL SELECT 'second', 'new', 1 UNION ALL SELECT 'second', 'old', 3)
        SELECT step, reader, churn_label, count(*) AS n FROM v, lab
        WHERE event_id % every = 0 GROUP BY ALL""",
    "confusion_stream": f"""{_WITH}, d AS (SELECT unnest([0, 1, 2]) AS drained)
        SELECT drained, """
    + ", ".join(
        f"""count(*) FILTER (churn_label = {y} AND prediction_custom = {p}) AS "{n}\""""
        for n, y, p in (("TP", 1, 1), ("TN", 0, 0), ("FP", 0, 1), ("FN", 1, 0))
    )
    + " FROM d, cls WHERE drained > 0 OR event_id % 2 = 0 GROUP BY drained",
    "roc_auc_sketched": f"""{_WITH} SELECT count(*) FILTER (churn_label = 1) AS n_pos,
        count(*) FILTER (churn_label = 0) AS n_neg, 1 AS is_near, 1 AS is_pr_close FROM lab""",
    "train_row_counts": f"""{_WITH}, r AS (
          SELECT (event_id * 7919) % 100 < 80 AS train,
            tenure_months IS NULL AS t, support_tickets IS NULL AS s, late_payments IS NULL AS l,
            monthly_charges IS NULL OR NOT isfinite(monthly_charges) AS m FROM dirty)
        SELECT unnest(['n_rows', 'n_train', 'n_test', 'n_rejected', 'rejected_monthly_charges',
                       'rejected_tenure_months', 'rejected_support_tickets',
                       'rejected_late_payments']) AS "count",
               unnest([count(*), count(*) FILTER (train AND NOT (t OR s OR l OR m)),
                       count(*) FILTER (NOT train AND NOT (t OR s OR l OR m)),
                       count(*) FILTER (t OR s OR l OR m), count(*) FILTER (m),
                       count(*) FILTER (t), count(*) FILTER (s), count(*) FILTER (l)]) AS n
        FROM r""",
    "medallion_train": f"""{_WITH} SELECT count(*) AS n_rows, count(*) AS n_used,
        CAST(0 AS BIGINT) AS n_rejected, 1 AS is_split, 1 AS is_learned FROM ev""",
    "score_batch": f"""{_WITH} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_range,
        CAST(0 AS BIGINT) AS n_class_wrong, CAST(0 AS BIGINT) AS n_differs FROM ev""",
    "score_probability": f"""{_WITH} SELECT count(*) AS n_rows, count(*) AS n_second,
        count(*) AS n_whole FROM ev""",
    "score_stream": f"""{_WITH} SELECT count(*) AS n_rows,
        count(*) FILTER (reasons = '') AS n_scored, CAST(0 AS BIGINT) AS n_out_of_range,
        CAST(0 AS BIGINT) AS n_unscored, CAST(0 AS BIGINT) AS n_differs FROM ({_REASONS})""",
    "stream_restart": f"{_WITH} {_gold_scoring()}",
    "stream_await": f"""{_WITH} SELECT sink, count(*) AS n_rows, 0 AS n_running
        FROM ev, (SELECT 'table' AS sink UNION ALL SELECT 'message') s GROUP BY sink""",
}
