"""Fixed values.

Names, labels, formats and parameters that results are compared by. They are data, not logic: changing
one of them changes the meaning of a result.
"""

# Raw file layout.
FIELD_DELIMITER = ","
HEADER_DELIMITER = "|"
HEADER_RENAMES = {"#tranaction_id": "tranaction_id"}
RAW_COLUMNS = (
    "tranaction_id",
    "tx_datetime",
    "customer_id",
    "terminal_id",
    "tx_amount",
    "tx_fraud",
    "tx_fraud_scenario",
)
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Cleaning rules and the columns whose missing values the profile counts.
TERMINAL_RANGE = (1, 999)
MISSING_TEXT_COLUMNS = ("tx_datetime", "customer_id", "terminal_id")
MISSING_NUMERIC_COLUMNS = ("tx_amount",)

# Metric names of the profile of a raw table.
PROFILE_ALL = "count_all_rows"
PROFILE_DUPLICATES = "count_duplicates_rows"
PROFILE_FRAUD = "count_fraud_rows"
PROFILE_LEGITIMATE = "count_without_fraud_rows"
PROFILE_MISSING = "missings_{column}"
PROFILE_NEGATIVE = "negative_values_{column}"
PROFILE_BLANK = "count_null_rows"
PROFILE_REMOVED = "count_del_rows"

# Columns of the terminal profile.
TERMINAL_TOTAL = "cnt_transactions_on_terminal_id"
TERMINAL_FRAUD = "cnt_fraud_transactions_on_terminal_id"
TERMINAL_PERCENT = "percent_fraud_on_terminal"
TERMINAL_BUCKET = "percent_fraud_on_terminal_udf"

# Terminal risk buckets as (upper edge, edge included, label).
# The fourth label repeats "and 50"; downstream encodings depend on the text as it is.
RISK_BUCKETS = (
    (10.0, False, "Under 10"),
    (25.0, True, "Between 10 and 25"),
    (50.0, True, "Between 25,.. and 50"),
    (75.0, True, "Between 50,.. and 50"),
)
RISK_BUCKET_ABOVE = "Over 75"
RISK_BUCKET_NULL = "Unknown"
RISK_BUCKET_NAN = "NA"

# Model features and parameters.
NUMERIC_FEATURES = ("terminal_id", "hour_tx_datetime", "tx_amount")
CATEGORICAL_FEATURES = ("percent_fraud_on_terminal_udf", "tx_fraud_scenario")
LABEL = "tx_fraud"
MAX_ITER = 1
REG_PARAM = 0.2
ELASTIC_NET_PARAM = 0.8
GRID_REG_PARAM = (0.01, 0.1, 0.5)
GRID_FIT_INTERCEPT = (False, True)
GRID_ELASTIC_NET_PARAM = (0.0, 0.5, 1.0)
SPLIT_WEIGHTS = (0.8, 0.2)
REFIT_WEIGHTS = (0.7, 0.3)
REFIT_SEED = 42
TUNING_TRAIN_RATIO = 0.75

# Model comparison.
BOOTSTRAP_REPLICATES = 10
BOOTSTRAP_RATE = 0.1
DENSITY_POINTS = 100
TEST_ALPHA = 0.01
INTERVAL_CONFIDENCE = 0.95

# JSON message fields.
MESSAGE_SCHEMA = "ts string, user_id string, page_id string"

# Service goals (shares of all operations, loss per month in currency units)
# and lifetimes of list entries.
MAX_MISSED_SHARE = 0.02
MAX_FALSE_ALARM_SHARE = 0.05
MAX_MISSED_LOSS = 500_000.0
PAYEE_LISTING_MONTHS = 3
DEVICE_LISTING_DAYS = 7
FAST_CREDIT_SECONDS = (60, 300)
FAST_CREDIT_HOLD_DAYS = 1
