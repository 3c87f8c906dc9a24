"""For each query of the catalog that SQL can state, the same result as SQL over the given tables."""

from __future__ import annotations

from riskflow.fixed_values import GRID_ELASTIC_NET_PARAM, GRID_FIT_INTERCEPT, GRID_REG_PARAM
from riskflow.plans.stand_ins import HEADER

_RAW = """
marked AS (
  SELECT *, substr(md5(CAST(event_id AS VARCHAR)), 1, 2) AS mark,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment
  FROM events),
raw AS (
  SELECT CAST(event_id AS VARCHAR) AS tranaction_id,
         CASE mark WHEN '0b' THEN '   ' WHEN '0c' THEN substr(moment, 1, 10) || ' 24:00:00' ELSE moment END AS tx_datetime,
         CASE mark WHEN '09' THEN '0' WHEN '0a' THEN NULL WHEN '15' THEN '17.5'
                   WHEN '16' THEN '12345678901234567890' ELSE CAST(user_id + 1 AS VARCHAR) END AS customer_id,
         CASE mark WHEN '05' THEN '0' WHEN '06' THEN '1000' WHEN '07' THEN 'abc'
                   WHEN '08' THEN ' ' || user_id || ' ' ELSE CAST(user_id AS VARCHAR) END AS terminal_id,
         CASE mark WHEN '00' THEN '' WHEN '01' THEN 'NaN' WHEN '02' THEN '-' || amount
                   WHEN '03' THEN '0' WHEN '04' THEN '0.5' ELSE amount END AS tx_amount,
         CASE WHEN mark = '0e' THEN NULL WHEN mark = '17' THEN '2' WHEN mark = '18' THEN 'x' WHEN event_type = 'error' THEN '1' ELSE '0' END AS tx_fraud,
         CASE mark WHEN '0d' THEN '' ELSE event_type END AS tx_fraud_scenario
  FROM marked JOIN (VALUES (1), (2), (3)) AS copies(n)
    ON n <= CASE mark WHEN '0f' THEN 2 WHEN '10' THEN 3 ELSE 1 END)"""

_COLUMNS = (
    "tranaction_id, tx_datetime, customer_id, terminal_id, tx_amount, tx_fraud, tx_fraud_scenario"
)


def _blank(column: str) -> str:
    return f"({column} IS NULL OR coalesce(isnan(TRY_CAST({column} AS DOUBLE)), false) OR trim({column}) = '')"


_ANY_BLANK = "(" + " OR ".join(_blank(c) for c in _COLUMNS.split(", ")) + ")"
_WHOLE = "coalesce(regexp_full_match(trim(customer_id), '[+-]?[0-9]+') AND TRY_CAST(customer_id AS BIGINT) IS NOT NULL, false)"
_BINARY = "coalesce(trim(tx_fraud) IN ('0', '1'), false)"
_TIME = "try_strptime(tx_datetime, '%Y-%m-%d %H:%M:%S')"

_CHECKS = f"""WHEN NOT coalesce(TRY_CAST(terminal_id AS INTEGER) BETWEEN 1 AND 999, false) THEN 'terminal_out_of_range'
    WHEN NOT coalesce(TRY_CAST(tx_amount AS DOUBLE) > 0, false) THEN 'tx_amount_not_positive'
    WHEN NOT coalesce(TRY_CAST(customer_id AS DOUBLE) > 0, false) THEN 'customer_id_not_positive'
    WHEN {_ANY_BLANK} THEN 'blank_field'
    WHEN NOT {_WHOLE} THEN 'customer_id_unreadable'
    WHEN NOT {_BINARY} THEN 'tx_fraud_not_0_or_1'
    WHEN {_TIME} IS NULL THEN 'bad_timestamp'
    ELSE 'kept'"""

_VERDICT = f"""
distinct_rows AS (SELECT {_COLUMNS}, count(*) AS copies FROM raw GROUP BY {_COLUMNS}),
judged AS (
  SELECT *, CASE {_CHECKS} END AS verdict
  FROM distinct_rows)"""

_CLEAN = f"""
clean AS (
  SELECT DISTINCT {_COLUMNS} FROM raw
  WHERE TRY_CAST(terminal_id AS INTEGER) BETWEEN 1 AND 999
    AND TRY_CAST(tx_amount AS DOUBLE) > 0 AND TRY_CAST(customer_id AS DOUBLE) > 0
    AND NOT {_ANY_BLANK} AND {_WHOLE} AND {_BINARY})"""

_TYPED = f"""
typed AS (
  SELECT tranaction_id, {_TIME} AS moment, CAST(customer_id AS BIGINT) AS customer_id,
         CAST(terminal_id AS INTEGER) AS terminal_id, CAST(tx_amount AS DOUBLE) AS tx_amount,
         CAST(tx_fraud AS INTEGER) AS tx_fraud, tx_fraud_scenario,
         CAST(hour({_TIME}) AS INTEGER) AS hour_tx_datetime
  FROM clean)"""

_TYPED_COLUMNS = """tranaction_id, strftime(moment, '%Y-%m-%d %H:%M:%S') AS tx_datetime, customer_id,
  terminal_id, tx_amount, tx_fraud, tx_fraud_scenario, hour_tx_datetime"""


def _bucket(value: str) -> str:
    return f"""CASE WHEN {value} IS NULL THEN 'Unknown' WHEN isnan({value}) THEN 'NA'
      WHEN {value} < 10 THEN 'Under 10' WHEN {value} <= 25 THEN 'Between 10 and 25'
      WHEN {value} <= 50 THEN 'Between 25,.. and 50' WHEN {value} <= 75 THEN 'Between 50,.. and 50'
      ELSE 'Over 75' END"""


def _rates(source: str, key: str, fraud: str, key_type: str = "INTEGER") -> str:
    percent = (
        "round(cnt_fraud_transactions_on_terminal_id / cnt_transactions_on_terminal_id * 100, 2)"
    )
    return f"""
rates AS (
  SELECT *, {_bucket('percent_fraud_on_terminal')} AS percent_fraud_on_terminal_udf
  FROM (SELECT *, {percent} AS percent_fraud_on_terminal
        FROM (SELECT CAST({key} AS {key_type}) AS terminal_id,
                     count(*) AS cnt_transactions_on_terminal_id,
                     nullif(count(*) FILTER (WHERE {fraud}), 0) AS cnt_fraud_transactions_on_terminal_id
              FROM {source} GROUP BY 1)))"""


_RATE_COLUMNS = """cnt_transactions_on_terminal_id, cnt_fraud_transactions_on_terminal_id,
  percent_fraud_on_terminal, percent_fraud_on_terminal_udf"""

_LINE_ID = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"


def _split_bucket(key: str, bounds: list[str]) -> str:
    draw = f"substr(md5({key}), 1, 8)"
    return " + ".join(f"CASE WHEN {draw} >= '{bound}' THEN 1 ELSE 0 END" for bound in bounds)


_PREDICTIONS = """
predictions AS (
  SELECT 'LR' AS model, event_id, ts, value, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
         CASE WHEN (event_type = 'error' AND value > 2.0) OR (event_type = 'click' AND value > 25.0)
              THEN 1 ELSE 0 END AS guess FROM events
  UNION ALL
  SELECT 'LR_TV', event_id, ts, value, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END,
         CASE WHEN (event_type = 'error' AND value > 1.0) OR (event_type = 'click' AND value > 30.0)
              THEN 1 ELSE 0 END FROM events)"""

_CONFUSION = """
counts AS (
  SELECT model, count(*) FILTER (WHERE label = 1 AND guess = 1) AS tp,
         count(*) FILTER (WHERE label = 0 AND guess = 0) AS tn,
         count(*) FILTER (WHERE label = 0 AND guess = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND guess = 0) AS fn
  FROM predictions GROUP BY model)"""

_METRICS = """(tp + tn) / (tp + tn + fp + fn) AS accuracy, tp / (tp + fp) AS "precision",
  tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1"""

# Weight = number of cumulative Poisson(0.1) probabilities that a uniform draw reaches.
_POISSON_SUMS = (
    "1",
    "1 + 0.1",
    "1 + 0.1 + 0.01/2",
    "1 + 0.1 + 0.01/2 + 0.001/6",
    "1 + 0.1 + 0.01/2 + 0.001/6 + 0.0001/24",
    "1 + 0.1 + 0.01/2 + 0.001/6 + 0.0001/24 + 0.00001/120",
)
_WEIGHT = " + ".join(
    f"CASE WHEN draw >= floor(exp(-0.1) * CAST({total} AS DOUBLE) * 4294967296) THEN 1 ELSE 0 END"
    for total in _POISSON_SUMS
)

_REPLICATES = f"""
draws AS (
  SELECT model, label, guess, replicate,
         CAST('0x' || substr(md5(concat_ws(':', model, CAST(event_id AS VARCHAR), CAST(replicate // 4 AS VARCHAR))),
                             CAST(replicate % 4 * 8 + 1 AS BIGINT), 8) AS BIGINT) AS draw
  FROM predictions, (SELECT CAST(range AS INTEGER) AS replicate FROM range(0, 10))),
weighted AS (SELECT model, replicate, label, guess, {_WEIGHT} AS w FROM draws),
replicates AS (
  SELECT *, {_METRICS} FROM (
    SELECT model, replicate,
           CAST(coalesce(sum(w) FILTER (WHERE label = 1 AND guess = 1), 0) AS BIGINT) AS tp,
           CAST(coalesce(sum(w) FILTER (WHERE label = 0 AND guess = 0), 0) AS BIGINT) AS tn,
           CAST(coalesce(sum(w) FILTER (WHERE label = 0 AND guess = 1), 0) AS BIGINT) AS fp,
           CAST(coalesce(sum(w) FILTER (WHERE label = 1 AND guess = 0), 0) AS BIGINT) AS fn
    FROM weighted GROUP BY model, replicate)),
scores AS (
  SELECT model, replicate, 'f1' AS metric, f1 AS value FROM replicates
  UNION ALL SELECT model, replicate, 'precision', "precision" FROM replicates
  UNION ALL SELECT model, replicate, 'recall', recall FROM replicates
  UNION ALL SELECT model, replicate, 'accuracy', accuracy FROM replicates),
moments AS (
  SELECT model, metric, avg(value) AS mean, stddev_samp(value) AS std, count(value) AS n
  FROM scores GROUP BY model, metric)"""

_BOOTSTRAP = f"WITH {_PREDICTIONS.strip()}, {_REPLICATES.strip()}"

_MESSAGES = """
sent AS (
  SELECT substr(md5(CAST(event_id AS VARCHAR)), 1, 2) AS mark,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment, CAST(user_id AS VARCHAR) AS who,
         json_extract_string(props, '$.k') AS page
  FROM events),
texts AS (
  SELECT CASE mark
    WHEN '00' THEN 'not json'
    WHEN '01' THEN '{"ts":"' || moment || '","user_id":"' || who || '"}'
    WHEN '02' THEN '{"ts":"' || moment || '","user_id":' || who || ',"page_id":"' || page || '"}'
    WHEN '03' THEN '{"ts":"' || moment || '","user_id":null,"page_id":"' || page || '"}'
    WHEN '04' THEN '{"ts":"' || moment || '","extra":1,"user_id":"' || who || '","page_id":"' || page || '"}'
    WHEN '05' THEN NULL
    ELSE '{"ts":"' || moment || '","user_id":"' || who || '","page_id":"' || page || '"}' END AS text
  FROM sent),
objects AS (SELECT CASE WHEN json_valid(text) THEN text END AS text FROM texts)"""

_DECODED = f"""WITH {_MESSAGES.strip()}
SELECT json_extract_string(text, '$.ts') AS ts, json_extract_string(text, '$.user_id') AS user_id,
       json_extract_string(text, '$.page_id') AS page_id
FROM objects"""

_LINES = f"""
lines AS (
  SELECT CASE WHEN trim(coalesce(tx_datetime, '')) = '' THEN '1970-01-01'
              ELSE substr(tx_datetime, 1, 10) END AS day,
         CASE substr(md5(tranaction_id), 1, 2)
           WHEN '12' THEN concat_ws(',', tranaction_id, tx_datetime, coalesce(customer_id, ''), terminal_id, tx_amount, coalesce(tx_fraud, ''))
           WHEN '13' THEN concat_ws(',', tranaction_id, tx_datetime, coalesce(customer_id, ''), terminal_id, tx_amount, coalesce(tx_fraud, ''), tx_fraud_scenario, 'x')
           WHEN '14' THEN '{HEADER}'
           ELSE concat_ws(',', tranaction_id, tx_datetime, coalesce(customer_id, ''), terminal_id, tx_amount, coalesce(tx_fraud, ''), tx_fraud_scenario)
         END AS line
  FROM raw),
fields AS (SELECT day, string_split(line, ',') AS f FROM lines WHERE line <> '{HEADER}')"""

_FIELD_COLUMNS = """f[1] AS tranaction_id, f[2] AS tx_datetime, f[3] AS customer_id, f[4] AS terminal_id,
  f[5] AS tx_amount, f[6] AS tx_fraud, f[7] AS tx_fraud_scenario, CAST(len(f) AS INTEGER) AS n_fields"""

_RANKED = """
ranked AS (
  SELECT {column} AS category, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS INTEGER) AS i,
         CAST(count(*) OVER () AS INTEGER) AS n_categories
  FROM {table} GROUP BY {column})"""


_TOTALS = """SELECT count(*) FILTER (WHERE tx_fraud = 1) AS positives,
  count(*) FILTER (WHERE tx_fraud = 0) AS negatives, true AS sound"""

_GRID = f"""SELECT CAST(r AS DOUBLE) AS reg_param, i AS fit_intercept, CAST(e AS DOUBLE) AS elastic_net_param,
       true AS sound, CAST(1 AS BIGINT) AS n_chosen
FROM unnest({list(GRID_REG_PARAM)}) AS a(r), unnest({list(GRID_FIT_INTERCEPT)}) AS b(i),
     unnest({list(GRID_ELASTIC_NET_PARAM)}) AS c(e)"""

# The parts of a model report. Parameters are those that Spark's logistic regression has set or has a default for.
_PARAMETERS = (
    "aggregationDepth elasticNetParam family featuresCol fitIntercept labelCol maxBlockSizeInMB maxIter "
    "predictionCol probabilityCol rawPredictionCol regParam standardization threshold tol"
).split()
_REPORT = "\nUNION ALL\n".join(
    f"SELECT '{section}' AS section, unnest({names}) AS name"
    for section, names in {
        "metrics LR": ["accuracy", "precision", "recall", "f1", "tp", "tn", "fp", "fn"],
        "metrics LR_TV": ["accuracy", "precision", "recall", "f1", "tp", "tn", "fp", "fn"],
        "t-test f1": ["t", "p_value", "reject"],
        "interval LR": ["low", "mean", "high"],
        "interval LR_TV": ["low", "mean", "high"],
        "parameters": _PARAMETERS,
    }.items()
)


def _profile() -> str:
    measures = {
        "count_all_rows": "sum(copies)",
        "count_duplicates_rows": "sum(copies) - count(*)",
        "count_fraud_rows": "sum(copies) FILTER (WHERE tx_fraud = '1')",
        "count_without_fraud_rows": "sum(copies) - sum(copies) FILTER (WHERE tx_fraud = '1')",
        "missings_tx_datetime": "sum(copies) FILTER (WHERE tx_datetime IS NULL OR TRY_CAST(tx_datetime AS DOUBLE) = 0)",
        "missings_customer_id": "sum(copies) FILTER (WHERE customer_id IS NULL OR TRY_CAST(customer_id AS DOUBLE) = 0)",
        "missings_terminal_id": "sum(copies) FILTER (WHERE terminal_id IS NULL OR TRY_CAST(terminal_id AS DOUBLE) = 0)",
        "missings_tx_amount": "sum(copies) FILTER (WHERE TRY_CAST(tx_amount AS DOUBLE) = 0)",
        "negative_values_tx_amount": "sum(copies) FILTER (WHERE TRY_CAST(tx_amount AS DOUBLE) < 0)",
        "count_null_rows": f"sum(copies) FILTER (WHERE {_ANY_BLANK})",
        "count_del_rows": "sum(copies) - count(*) FILTER (WHERE verdict IN ('kept', 'bad_timestamp'))",
    }
    return f"WITH {_RAW.strip()}, {_VERDICT.strip()}\n" + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS metric, CAST(coalesce({value}, 0) AS BIGINT) AS value FROM judged"
        for name, value in measures.items()
    )


def _missing_by_column() -> str:
    return f"WITH {_RAW.strip()}\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {_blank(c)}) AS missing FROM raw"
        for c in _COLUMNS.split(", ")
    )


def oracle_sql() -> dict[str, str]:
    raw = f"WITH {_RAW.strip()}"
    clean = f"{raw}, {_CLEAN.strip()}"
    typed = f"{clean}, {_TYPED.strip()}"
    typed_rates = f"{typed}, {_rates('typed', 'terminal_id', 'tx_fraud = 1').strip()}"
    line_rates = _rates("lineitem", "l_suppkey", "l_returnflag = 'R'").strip()
    order_rates = _rates("orders", "o_custkey", "o_orderpriority = '1-URGENT'", "BIGINT").strip()
    prepared = f"""{typed},
        prepared AS (
          SELECT tranaction_id, CAST(copies.n AS INTEGER) AS copy_no, tx_fraud,
                 {_split_bucket("tranaction_id || ':' || copies.n || ':'", ['cccccccc'])} AS split
          FROM typed,
               (SELECT count(*) FILTER (WHERE tx_fraud = 0) // count(*) FILTER (WHERE tx_fraud = 1) AS k FROM typed),
               unnest(range(1, CASE WHEN tx_fraud = 1 THEN greatest(k, 1) ELSE 1 END + 1)) AS copies(n)
          WHERE hour_tx_datetime IS NOT NULL)"""
    balance = """balance AS (
      SELECT count(*) FILTER (WHERE l_returnflag <> 'R') AS n0, count(*) FILTER (WHERE l_returnflag = 'R') AS n1,
             greatest(count(*) FILTER (WHERE l_returnflag <> 'R') // count(*) FILTER (WHERE l_returnflag = 'R'), 1) AS k
      FROM lineitem)"""
    oversampled = f"""WITH {balance}
      SELECT {_LINE_ID} AS tranaction_id, CAST(l_returnflag = 'R' AS INTEGER) AS tx_fraud,
             CAST(copies.n AS INTEGER) AS copy_no
      FROM lineitem, balance, unnest(range(1, CASE WHEN l_returnflag = 'R' THEN k ELSE 1 END + 1)) AS copies(n)"""
    mark = "CASE event_type WHEN 'signup' THEN NULL WHEN 'view' THEN CAST('NaN' AS DOUBLE) ELSE value END"
    blacklist = """listed AS (
        SELECT DISTINCT user_id, CAST(ts AS DATE) AS first_day FROM events WHERE event_type = 'error' AND value > 150)"""
    return {
        "text_ingest": f"{raw}, {_LINES.strip()}\nSELECT {_FIELD_COLUMNS} FROM fields",
        "file_ingest": f"{raw}, {_LINES.strip()}\nSELECT {_FIELD_COLUMNS}, day AS source_date, true AS fits FROM fields",
        "profile_report": f"SELECT metric || ' ' || value AS value FROM ({_profile()})",
        "ragged_rows": f"""{raw}, {_LINES.strip()}
            SELECT {_FIELD_COLUMNS} FROM fields WHERE len(f) <> 7""",
        "profile": _profile(),
        "missing_by_column": _missing_by_column(),
        "complete_rows": f"{raw}\nSELECT * FROM raw WHERE NOT {_ANY_BLANK}",
        "clean": f"{clean}\nSELECT * FROM clean",
        "reject_reasons": f"""{raw}, {_VERDICT.strip()}
            SELECT verdict AS reason, CAST(CASE WHEN verdict = 'kept' THEN count(*) ELSE sum(copies) END AS BIGINT) AS n
            FROM judged GROUP BY verdict
            UNION ALL
            SELECT 'duplicate', CAST(sum(copies) - count(*) AS BIGINT) FROM judged WHERE verdict = 'kept'""",
        "quarantine": f"""{raw}, {_VERDICT.strip()}
            SELECT {_COLUMNS}, copies, verdict AS reason FROM judged WHERE verdict <> 'kept'""",
        "quarantine_lines": f"""{raw}, {_LINES.strip()},
            split_lines AS (
              SELECT line, count(*) AS copies, string_split(line, ',') AS f FROM lines
              WHERE line <> '{HEADER}' GROUP BY line),
            rows AS (SELECT {_FIELD_COLUMNS}, copies, line FROM split_lines),
            judged AS (SELECT *, CASE WHEN n_fields <> 7 THEN 'ragged' {_CHECKS} END AS reason FROM rows)
            SELECT * FROM judged WHERE reason <> 'kept'""",
        "typed_features": f"{typed}\nSELECT {_TYPED_COLUMNS} FROM typed",
        "terminal_rate": f"{typed_rates}\nSELECT terminal_id, {_RATE_COLUMNS} FROM rates",
        "terminal_rate_lineitem": f"WITH {line_rates}\nSELECT terminal_id, {_RATE_COLUMNS} FROM rates",
        "risk_bucket": f"""SELECT event_id, {_bucket('percent')} AS bucket
            FROM (SELECT event_id, {mark} AS percent FROM events)""",
        "enrich": f"""{typed_rates}
            SELECT {_TYPED_COLUMNS}, {_RATE_COLUMNS} FROM typed LEFT JOIN rates USING (terminal_id)""",
        "enrich_unbounded": f"""WITH {line_rates}
            SELECT {_LINE_ID} AS tranaction_id, terminal_id, l_extendedprice AS tx_amount,
                   CAST(l_returnflag = 'R' AS INTEGER) AS tx_fraud, l_linestatus AS tx_fraud_scenario, {_RATE_COLUMNS}
            FROM lineitem LEFT JOIN rates ON terminal_id = l_suppkey""",
        "enrich_orders": f"""WITH {order_rates}
            SELECT o_orderkey AS tranaction_id, terminal_id,
                   CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS tx_fraud, {_RATE_COLUMNS}
            FROM orders LEFT JOIN rates ON terminal_id = o_custkey""",
        "fraud_free_terminals": f"""WITH {order_rates}
            SELECT terminal_id, cnt_transactions_on_terminal_id FROM rates
            WHERE cnt_fraud_transactions_on_terminal_id IS NULL""",
        "fraud_free_first": """
            SELECT a.o_custkey AS terminal_id, count(*) AS cnt_transactions_on_terminal_id FROM orders a
            WHERE NOT EXISTS (SELECT 1 FROM orders b
                              WHERE b.o_custkey = a.o_custkey AND b.o_orderpriority = '1-URGENT')
            GROUP BY 1 ORDER BY 1 LIMIT 10""",
        "class_balance": f"""WITH {balance}
            SELECT n0 AS n_negative, n1 AS n_positive, CAST(n0 // n1 AS BIGINT) AS ratio FROM balance""",
        "oversample": oversampled,
        "oversample_by_union": oversampled,
        "hash_split": f"""SELECT event_id,
            {_split_bucket("CAST(event_id AS VARCHAR) || ':'", ['cccccccc'])} AS split FROM events""",
        "hash_split_counts": f"""SELECT split, count(*) AS n
            FROM (SELECT {_split_bucket(_LINE_ID + " || ':42'", ['b3333333'])} AS split FROM lineitem)
            GROUP BY split""",
        # The parts of a random split hold every row once, whatever they are.
        "random_split": """SELECT event_id, CAST(1 AS BIGINT) AS n_parts, true AS same_again, true AS sizes_fit
            FROM events""",
        "hash_sample": f"""WITH draws AS (
              SELECT event_id, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR) || ':'), 1, 8) AS BIGINT) AS draw FROM events)
            SELECT event_id, CAST(copies.n AS INTEGER) AS copy_no
            FROM (SELECT event_id, {_WEIGHT} AS w FROM draws), unnest(range(1, w + 1)) AS copies(n)""",
        "string_index": f"""WITH {_RANKED.format(table='events', column='event_type').strip()}
            SELECT event_id, event_type, CAST(i AS DOUBLE) AS event_type_index
            FROM events JOIN ranked ON category = event_type""",
        "string_index_wide": """WITH counted AS (
              SELECT l_orderkey AS k, row_number() OVER (ORDER BY count(*) DESC, CAST(l_orderkey AS VARCHAR)) - 1 AS i
              FROM lineitem GROUP BY l_orderkey)
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(i AS DOUBLE) AS l_orderkey_index
            FROM lineitem JOIN counted ON k = l_orderkey""",
        "one_hot": f"""WITH {_RANKED.format(table='orders', column='o_orderpriority').strip()}
            SELECT o_orderkey, o_orderpriority,
                   array_to_string(list_transform(range(0, n_categories - 1), lambda k: CASE WHEN k = i THEN 1 ELSE 0 END), ',') AS encoded
            FROM orders JOIN ranked ON category = o_orderpriority""",
        "min_max": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   round((l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()), 9) AS quantity_scaled,
                   round((l_extendedprice - min(l_extendedprice) OVER ()) / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()), 9) AS price_scaled
            FROM lineitem""",
        "assemble_skip": f"{typed}\nSELECT tranaction_id FROM typed WHERE hour_tx_datetime IS NOT NULL",
        "skipped_rows": f"""{typed}
            SELECT count(hour_tx_datetime) AS kept_rows, count(*) - count(hour_tx_datetime) AS skipped_rows FROM typed""",
        "confusion": f"WITH {_PREDICTIONS.strip()}, {_CONFUSION.strip()}\nSELECT * FROM counts",
        "confusion_matrix": f"""WITH {_PREDICTIONS.strip()}
            SELECT model, label AS actual, guess AS predicted, count(*) AS n
            FROM predictions GROUP BY model, label, guess""",
        "metrics": f"""WITH {_PREDICTIONS.strip()}, {_CONFUSION.strip()}
            SELECT *, {_METRICS} FROM counts""",
        "auc": """WITH scores AS (
              SELECT 'tens' AS model, event_type = 'error' AS pos, floor(value / 10) AS score FROM events
              UNION ALL SELECT 'amount', event_type = 'error', value FROM events),
            counted AS (
              SELECT model, score, count(*) FILTER (WHERE pos) AS p, count(*) FILTER (WHERE NOT pos) AS n
              FROM scores GROUP BY model, score),
            below AS (
              SELECT *, coalesce(sum(n) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
              FROM counted)
            SELECT model, CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives,
                   CAST(sum(p * (2 * b + n)) AS DOUBLE) / (2 * CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) AS auc
            FROM below GROUP BY model""",
        "bootstrap": f"{_BOOTSTRAP}\nSELECT * FROM replicates",
        "bootstrap_summary": f"""{_BOOTSTRAP}
            SELECT model, metric, n, round(mean, 9) AS mean, round(std, 9) AS std,
                   round(mean - 3 * std, 9) AS low_3, round(mean - std, 9) AS low_1,
                   round(mean + std, 9) AS high_1, round(mean + 3 * std, 9) AS high_3 FROM moments""",
        "density": f"""{_BOOTSTRAP}
            SELECT model, metric, CAST(i AS INTEGER) AS point,
                   round(mean + (-3 + 6 * i / 99.0) * std, 9) AS x,
                   round(exp(-0.5 * (-3 + 6 * i / 99.0) * (-3 + 6 * i / 99.0)) / (std * sqrt(2 * pi())), 6) AS y
            FROM moments, (SELECT CAST(range AS DOUBLE) AS i FROM range(0, 100))""",
        "histogram": f"""{_BOOTSTRAP}
            SELECT model, metric, CAST(least(floor((value - low) / (high - low) * 10), 9) AS INTEGER) AS bin, count(*) AS n
            FROM (SELECT *, min(value) OVER (PARTITION BY model, metric) AS low,
                         max(value) OVER (PARTITION BY model, metric) AS high FROM scores)
            GROUP BY 1, 2, 3""",
        "ab_test": f"""{_BOOTSTRAP},
            pair AS (
              SELECT a.n + b.n - 2 AS dof,
                     (a.mean - b.mean) / sqrt(((a.n - 1) * a.std * a.std + (b.n - 1) * b.std * b.std)
                                              / (a.n + b.n - 2) * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n)) AS t
              FROM moments a, moments b
              WHERE a.model = 'LR' AND b.model = 'LR_TV' AND a.metric = 'f1' AND b.metric = 'f1'),
            tail AS (
              SELECT t, dof, 1 - abs(t) / sqrt(dof + t * t) * list_sum(list_transform(range(0, dof // 2),
                lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1)) / sqrt(pi()) * pow(dof / (dof + t * t), k))) AS p FROM pair)
            SELECT 'f1' AS metric, round(t, 6) AS t, CAST(dof AS INTEGER) AS dof, round(p, 9) AS p_value, p < 0.01 AS reject FROM tail""",
        # 2.2621571628540993 is the 97.5 % point of Student's t with 9 degrees of freedom.
        "ab_interval": f"""{_BOOTSTRAP}
            SELECT model, metric, round(mean - 2.2621571628540993 * std / sqrt(10), 9) AS low,
                   round(mean, 9) AS mean, round(mean + 2.2621571628540993 * std / sqrt(10), 9) AS high
            FROM moments WHERE metric = 'f1'""",
        "ab_summary": f"WITH {_PREDICTIONS.strip()}, {_CONFUSION.strip()}, measured AS (SELECT *, {_METRICS} FROM counts)\n"
        + "\nUNION ALL\n".join(
            f"SELECT model, '{name}' AS metric, CAST({name} AS DOUBLE) AS value FROM measured"
            for name in ("accuracy", "precision", "recall", "f1", "tp", "tn", "fp", "fn")
        ),
        "json_decode": _DECODED,
        "stream_decode": _DECODED,
        "stream_landing": f"{raw}, {_LINES.strip()}\nSELECT {_FIELD_COLUMNS}, day AS source_date FROM fields",
        "landed_files": f"{raw}, {_LINES.strip()}\nSELECT {_FIELD_COLUMNS}, day AS source_date, true AS fits FROM fields",
        "changed_files": f"""{raw}, {_LINES.strip()}, last AS (SELECT max(day) AS last_day FROM lines)
            SELECT {_FIELD_COLUMNS}, day AS source_date, true AS fits,
                   CAST(CASE WHEN day = last_day THEN 2 ELSE 1 END AS INTEGER) AS times_read
            FROM fields, last WHERE day <> last_day OR len(f) = 7""",
        "fast_credit_stream": """SELECT event_id FROM events c WHERE event_type = 'purchase' AND EXISTS (
              SELECT 1 FROM events a WHERE a.event_type = 'click' AND a.user_id = c.user_id
                AND epoch_us(c.ts) - epoch_us(a.ts) BETWEEN 60000000 AND 300000000)""",
        # A window is out once it ends no later than the watermark, one hour behind the latest event.
        "stream_windows": """WITH windows AS (
              SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS s, event_type, count(*) AS n
              FROM events GROUP BY ALL)
            SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
                   strftime(s + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, event_type, n
            FROM windows WHERE s + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
        "stream_dedupe": f"{raw}\nSELECT DISTINCT {_COLUMNS} FROM raw WHERE {_TIME} IS NOT NULL",
        "stream_blacklist": """WITH period AS (
              SELECT CAST(min(ts) AS DATE) + CAST(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) // 2 AS INTEGER) AS middle
              FROM events),
            listed AS (
              SELECT DISTINCT user_id, CAST(ts AS DATE) AS first_day FROM events WHERE event_type = 'error' AND value > 150)
            SELECT event_id, CASE WHEN CAST(e.ts AS DATE) < middle THEN 1 ELSE 2 END AS list_version
            FROM events e, period WHERE EXISTS (
              SELECT 1 FROM listed l WHERE l.user_id = e.user_id AND CAST(e.ts AS DATE) >= l.first_day
                AND CAST(e.ts AS DATE) < l.first_day + 7
                AND (l.first_day < middle OR CAST(e.ts AS DATE) >= middle))""",
        "runs_compacted": """SELECT 'run-' || event_id % 20 AS run_id, 'LR' AS model, 'metric' AS kind, event_type AS name,
              CAST(count(*) AS VARCHAR) AS value, CAST(1 AS INTEGER) AS n_files
            FROM events GROUP BY event_id % 20, event_type""",
        "train_predict": f"""{prepared}
            SELECT tranaction_id, copy_no, tx_fraud, true AS sound FROM prepared WHERE split = 1""",
        "train_metrics": f"{prepared}\n{_TOTALS} FROM prepared WHERE split = 1",
        "training_summary": "SELECT * FROM (VALUES ('accuracy', true), ('areaUnderROC', true)) AS t(metric, sound)",
        "train_leak_free": f"""{typed}
            {_TOTALS} FROM typed
            WHERE hour_tx_datetime IS NOT NULL AND {_split_bucket("tranaction_id || ':'", ['cccccccc'])} = 1""",
        "grid_search": _GRID,
        "cross_validation": _GRID,
        "score_saved": f"""{typed}
            SELECT count(*) AS rows, count(hour_tx_datetime) AS scored, count(*) - count(hour_tx_datetime) AS skipped,
                   count(*) FILTER (WHERE tx_fraud = 1 AND hour_tx_datetime IS NOT NULL) AS positives,
                   count(*) FILTER (WHERE tx_fraud = 0 AND hour_tx_datetime IS NOT NULL) AS negatives,
                   true AS sound, count(hour_tx_datetime) AS written, CAST(1 AS BIGINT) AS reports FROM typed""",
        "model_comparison": _REPORT,
        "prepared_rows": f"""{typed}
            SELECT split, tx_fraud, count(*) AS n FROM (
              SELECT tx_fraud, {_split_bucket("tranaction_id || ':' || copies.n || ':'", ['cccccccc'])} AS split
              FROM typed,
                   (SELECT count(*) FILTER (WHERE tx_fraud = 0) // count(*) FILTER (WHERE tx_fraud = 1) AS k FROM typed),
                   unnest(range(1, CASE WHEN tx_fraud = 1 THEN greatest(k, 1) ELSE 1 END + 1)) AS copies(n)
              WHERE hour_tx_datetime IS NOT NULL)
            GROUP BY split, tx_fraud""",
        "decision_tiers": f"""SELECT event_id, CASE WHEN value >= 100 THEN 'red' WHEN value >= 40 THEN 'yellow'
            ELSE 'green' END AS decision FROM events""",
        "blacklist_payee": f"""WITH {blacklist}
            SELECT event_id FROM events e WHERE EXISTS (
              SELECT 1 FROM listed l WHERE l.user_id = e.user_id AND CAST(e.ts AS DATE) >= l.first_day
                AND CAST(e.ts AS DATE) < CAST(l.first_day + INTERVAL 3 MONTH AS DATE))""",
        "blacklist_device": f"""WITH {blacklist}
            SELECT event_id FROM events e WHERE EXISTS (
              SELECT 1 FROM listed l WHERE l.user_id = e.user_id AND CAST(e.ts AS DATE) >= l.first_day
                AND CAST(e.ts AS DATE) < l.first_day + 7)""",
        "whitelist": """SELECT event_id, user_id, CASE
              WHEN user_id IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 250) THEN 'green'
              WHEN value >= 100 THEN 'red' WHEN value >= 40 THEN 'yellow' ELSE 'green' END AS decision
            FROM events""",
        "average_fraud_amount": f"""{typed}
            SELECT count(*) AS n_fraud, round(avg(tx_amount), 6) AS avg_fraud_amount FROM typed WHERE tx_fraud = 1""",
        "fast_credit_holds": """WITH fast AS (
              SELECT user_id, ts AS at FROM events c WHERE event_type = 'purchase' AND EXISTS (
                SELECT 1 FROM events a WHERE a.event_type = 'click' AND a.user_id = c.user_id
                  AND epoch_us(c.ts) - epoch_us(a.ts) BETWEEN 60000000 AND 300000000))
            SELECT event_id, EXISTS (
              SELECT 1 FROM fast f WHERE f.user_id = e.user_id AND e.ts > f.at AND e.ts <= f.at + INTERVAL 1 DAY) AS held
            FROM events e""",
        "service_goals": f"""WITH {_PREDICTIONS.strip()}
            SELECT model, month, n, missed_share, false_alarm_share, round(missed_loss, 2) AS missed_loss,
                   missed_share <= 0.02 AS missed_ok, false_alarm_share <= 0.05 AS false_alarm_ok,
                   missed_loss < 500000 AS loss_ok
            FROM (SELECT model, strftime(ts, '%Y-%m') AS month, count(*) AS n,
                         count(*) FILTER (WHERE label = 1 AND guess = 0) / count(*) AS missed_share,
                         count(*) FILTER (WHERE label = 0 AND guess = 1) / count(*) AS false_alarm_share,
                         coalesce(sum(value) FILTER (WHERE label = 1 AND guess = 0), 0) AS missed_loss
                  FROM predictions GROUP BY 1, 2)""",
    }
